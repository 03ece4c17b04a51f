"""The prefix trie against a plain one, in many small blocks."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ballast.llm import prefix_trie
from ballast.llm.queries import queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, words string, key int, task string"


def plain_nodes(seqs: dict[int, tuple]) -> list[tuple]:
    """Sequences of (role, text) to nodes, prefix by prefix."""
    members = defaultdict(list)
    for c, turns in seqs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, ids in members.items():
        words = len([w for w in prefix_words(p[-1][1])]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(ids) - 1) * words
    out = []
    for p, ids in members.items():
        ends = ",".join(map(str, sorted(c for c in ids if len(seqs[c]) == len(p))))
        out.append(
            (
                min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), len(children[p]),
                leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def prefix_words(text: str) -> list[str]:
    for blank in "\t\n\x0b\x0c\r":
        text = text.replace(blank, " ")
    return [w for w in text.split(" ") if w]


def rebuilt(rows: list[tuple]) -> dict[int, tuple]:
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append((turn is not None, turn or 0, name, (role, text)))
    turns = {c: tuple(x[-1] for x in sorted(t)) for c, t in own.items()}
    out = {}
    for c, t in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        out[c] = turns.get(base, ())[:h] + t[h:]
    return out


def result(spark, folder) -> list[tuple]:
    got = queries()["op11_prefix_trie"](spark, str(folder))
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"
    assert got.columns == names.split()
    return sorted((tuple(r) for r in got.collect()), key=repr)


def stored(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/conversations.parquet")


@pytest.fixture(params=[1, 7, 10_000])
def batch_rows(spark, request):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(request.param > 100).lower())
    yield request.param
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_shared_prefixes_hot_copies_and_odd_rows(spark, tmp_path, batch_rows):
    draw = random.Random(9)
    texts = ["hello there", "a b  c", "", None, "x\ty\nz", "é ü"]
    rows = []
    for c in range(140):
        if c % 3 == 0:
            turns = ["same", "start", "and end"]  # a third are copies
        else:
            turns = ["same"] * draw.randrange(3) + [draw.choice(texts) for _ in range(draw.randrange(5))]
        rows += [(c, i, draw.choice(["user", None]) if i > 3 else "user", t) for i, t in enumerate(turns)]
    rows += [(200, None, "user", "no turn"), (200, 0, None, None), (200, 0, None, None)]
    rows += [(201, i, "user", f"t{i % 5}") for i in range(300)]  # long
    rows += [(203, i, "user", f"t{i % 5}") for i in range(299)]
    rows += [(225, 0, "user", "its base is absent"), (None, 0, "user", "lost"), (-7, 0, "user", "x")]
    rows = [(*r, "w", 1, "t") for r in rows]
    stored(spark, tmp_path, rows)
    assert result(spark, tmp_path) == plain_nodes(rebuilt(rows))


def test_turnless_alone_and_nothing(spark, tmp_path):
    one = next(c for c in range(20, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4)
    stored(spark, tmp_path / "one", [(one, 0, "user", "gone", None, None, None)])
    assert result(spark, tmp_path / "one") == [
        (one, 0, None, 1, 0, 1, 0, hashlib.sha256(str(one).encode()).hexdigest())
    ]
    stored(spark, tmp_path / "none", [])
    assert result(spark, tmp_path / "none") == []


def test_given_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    assert result(spark, folder) == plain_nodes(rebuilt(rows))


def test_extents_are_those_of_a_loop():
    draw = np.random.default_rng(2)
    for n in (1, 2, 3, 17, 64, 65):
        values = draw.integers(0, 5, n)
        table = prefix_trie.RangeMin(values)
        at = np.repeat(np.arange(n), 6)
        least = np.tile(np.arange(6), n)
        left, right = table.left(at, least), table.right(at, least)
        for i, d, l, r in zip(at, least, left, right):
            want_r = next((j for j in range(i + 1, n) if values[j] < d), n) - 1
            want_l = next((j for j in range(i, 0, -1) if values[j] < d), 0)
            assert (r, l) == (want_r, want_l)
            assert table.between(np.array([l]), np.array([r]))[0] == values[l : r + 1].min()


def test_names_keep_role_and_text_apart(spark):
    rows = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "abc"), ("", "abc")], "r string, t string")
    names = [r[0] for r in rows.select(prefix_trie.name(F.col("r"), F.col("t"))).collect()]
    assert len(set(names)) == 3 and names[2] == names[3]
