"""Every registered query over whole tables against a plain version."""

import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import plain
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ballast.llm import byte_cnn, host_trust, order_minhash, suffix_tree, target_ratio
from ballast.llm.queries import queries

SMALL = "/root/testdata/sf0.001"
FOLDER = "/root/testdata/sf0.01"


def table(folder: str, name: str, columns: str) -> list[tuple]:
    return duckdb.sql(f"select {columns} from '{folder}/{name}.parquet'").fetchall()


def result(spark, name: str, folder: str = FOLDER) -> list:
    return queries()[name](spark, folder).collect()


@pytest.fixture(scope="module")
def docs():
    return table(FOLDER, "documents", "doc_id, text")


def test_secrets(spark, docs):
    want = {d: plain.secrets(t) for d, t in docs}
    got = result(spark, "op1_secret_ledger")
    assert {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got} == want
    assert len(got) == len(docs) and any(r.n_assign for r in got) and any(r.n_hex for r in got)


def test_packing(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {
        d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for d, t in docs
    }
    pieces = result(spark, "op2_sum_of_squares_packing")
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(want)
    for d, parts in by_doc.items():
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            ids = np.asarray(want[d][p.start : p.start + p.length], "<u4")
            assert p.start == at and len(ids) == p.length > 0 and p.doc_tokens == len(want[d])
            assert p.ids_crc32 == zlib.crc32(ids.tobytes())
            at += p.length
        assert at == len(want[d])
    padding = tokens = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
        tokens += at
    assert padding <= 0.01 * tokens


def test_near_duplicates(spark, docs):
    want, links = plain.near_classes(docs)
    got = result(spark, "op3_order_minhash")
    assert {r.doc_id: r.class_id for r in got} == want
    assert links
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] for r in got)
    assert sorted(r.doc_id for r in got if r.kept) == sorted(sizes)


def test_similarity_is_that_of_the_full_table(docs):
    _, links = plain.near_classes(docs[:300], 0.3)
    number = {}

    def ids(text):
        words = plain.WORD.findall(text)
        return np.array([number.setdefault(w, len(number)) for w in words], np.int32)

    texts = dict(docs)
    for a, b in sorted(links):
        exact = plain.aligned(plain.runs(texts[a]), plain.runs(texts[b]))
        x, y = (order_minhash.labelled(ids(texts[d])) for d in (a, b))
        assert order_minhash.similarity(x, y, 0.3) == pytest.approx(exact)
        assert (order_minhash.similarity(x, y) >= 0.8) == (exact >= 0.8)


def test_hosts(spark):
    pages = table(FOLDER, "pages", "page_id, url, html")
    scores = plain.host_scores(
        pages, host_trust.RULES, host_trust.LINK, host_trust.DAMPING, host_trust.STEPS
    )
    want = {}
    for page, url, _ in pages:
        host, path = plain.url_parts(url)
        rule, verdict = plain.longest_rule(host, path, host_trust.RULES)
        trust, distrust = scores[host]
        share = round(distrust / (trust + distrust), 9) if distrust else 0
        own = "block" if share > 0.5 else "allow"
        want[page] = (host, path, rule, verdict or own)
    got = result(spark, "op4_host_trust")
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == want
    assert {r.verdict for r in got if r.rule is None} == {"allow", "block"}


def test_exact_copies(spark, docs):
    want = plain.copies(docs)
    got = result(spark, "op5_block_naming")
    assert {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in got} == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got) and len(got) == len(docs)


def test_languages(spark):
    rows = table(FOLDER, "documents", "doc_id, text, lang")
    got = {r.doc_id: r for r in result(spark, "op6_byte_cnn")}
    held = [(d, lang) for d, _, lang in rows if plain.crc(d, 4) == 2]
    assert sorted(d for d, r in got.items() if r.held_out) == sorted(d for d, _ in held)
    right = sum(got[d].lang_pred == lang for d, lang in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_responses_are_those_of_a_loop():
    draw = np.random.default_rng(1)
    x = draw.integers(0, 256, (3, 20), dtype=np.uint8)
    net = byte_cnn.train(x, np.array([0, 1, 0]), ["a", "b"])
    for w in byte_cnn.WIDTHS:
        got = net.responses(x, w)
        for n in range(3):
            for at in range(20 - w + 1):
                want = sum(net.tables[w][j][x[n, at + j]] for j in range(w))
                assert np.allclose(got[n, at], want, atol=1e-5)


def test_quality_rules(spark, docs):
    labels = table(FOLDER, "labels", "doc_id, quality, toxic")
    trusted = {d for d, q, t in labels if q == 1 and t == 0}
    held = {d for d in trusted if plain.crc(d, 5) == 0}
    ratios = plain.ratios(docs, trusted - held, target_ratio.BUCKETS)
    sound = {d for d, t in docs for n, *_, rep in [plain.rules(t)] if n >= 50 and 100 * rep <= 50 * n}
    low, mid = np.percentile([round(ratios[d], 4) for d in held & sound], [1, 50])
    least = mid - 2 * (mid - low)
    got = result(spark, "op7_target_ratio")
    assert len(got) == len(docs)
    texts = dict(docs)
    for r in got:
        n, *rest = plain.rules(texts[r.doc_id])
        failed = n < 50 or 100 * rest[-1] > 50 * n
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest)
        assert r.ratio == pytest.approx(ratios[r.doc_id], abs=1e-9)
        assert r.base_failed == failed
        assert r.kept == (not failed and ratios[r.doc_id] >= least)
    kept = {r.doc_id for r in got if r.kept}
    assert len(trusted & sound & kept) >= 0.99 * len(trusted & sound)
    poor = {d for d, q, t in labels if q == 0} & sound
    assert len(poor & kept) <= 0.3 * len(poor)


@pytest.mark.parametrize("folder", [SMALL, FOLDER])
def test_language_model(spark, folder):
    docs = table(folder, "documents", "doc_id, text")
    base = plain.unigrams(docs)
    model = plain.suffix_scores(
        docs,
        suffix_tree.DEPTH,
        suffix_tree.LEAST_COUNT,
        suffix_tree.LEAST_NATS,
        suffix_tree.BACK_OFF,
    )
    got = result(spark, "op9_suffix_tree", folder)
    assert len(got) == len(docs)
    for r in got:
        *counts, score = base[r.doc_id]
        assert [r.n_tokens, r.n_known, r.train_tokens] == counts
        assert r.base_score == pytest.approx(score, rel=1e-9)
        assert r.score == pytest.approx(model[r.doc_id], rel=1e-9)
        assert r.held_out == (plain.crc(r.doc_id, 10) == 0)


def test_model_predicts_held_out_rows_better_than_single_bytes(spark, docs):
    streams = {d: suffix_tree.symbols(t or "")[suffix_tree.DEPTH :] for d, t in docs}
    counts = Counter()
    for d, s in streams.items():
        if plain.crc(d, 10) != 0:
            counts.update(s)
    total = sum(counts.values())
    held = [r for r in result(spark, "op9_suffix_tree") if r.held_out]
    single = sum(
        np.log10((counts[b] + 0.5) / (total + 128)) for r in held for b in streams[r.doc_id]
    )
    assert sum(r.score for r in held) > 0.75 * single  # both are negative


def test_quality_classifier(spark, docs):
    labels = dict(table(FOLDER, "labels", "doc_id, quality"))
    got = result(spark, "op10_pu_quality")
    assert len(got) == len(docs)
    held = [(labels[r.doc_id], r.score, r.predicted) for r in got if r.held_out and r.doc_id in labels]
    good = [s for y, s, _ in held if y == 1]
    bad = [s for y, s, _ in held if y == 0]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    assert wins >= 0.97 * len(good) * len(bad)
    assert sum(p == y for y, _, p in held) >= 0.9 * len(held)
    assert all(r.predicted == (r.score >= 0.3) for r in got)
