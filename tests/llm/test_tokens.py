"""The ids of every code point, in several surroundings, are the tokenizer's."""

import string

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ballast.llm import packing, suffix_tree


def test_ids_of_every_code_point():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    words = packing.Words(path)
    points = [c for c in range(0x21, 0x30000) if not 0xD800 <= c < 0xE000]
    wrong = []
    for begin in range(0, len(points), 4096):
        texts = []
        for c in points[begin : begin + 4096]:
            c = chr(c)
            texts += [c, f"a{c}", f"{c}.", f"Ab{c}c, {c}́x"]
        got = list(words.ids(pa.array(texts)))
        want = tokenizer.encode_batch(texts, add_special_tokens=False)
        for t, g, w in zip(texts, got, want):
            if memoryview(g).cast("I").tolist() != w.ids:
                wrong.append(t)
    assert wrong == []


def test_marks_behind_a_word_do_not_send_it_to_the_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    words, whole = packing.Words(path), []
    tokenizer = words.tokenizer

    class Counted:
        def encode(self, word, **options):
            whole.append(word)
            return tokenizer.encode(word, **options)

    words.tokenizer = Counted()
    marks = ["###", "%%%", ".!!", ",", "'", "&&&"]
    stems = [a + b for a in ("word", "Na\u00efve", "stra\u00dfe", "UPPER") for b in "abcdefgh"]
    text = " ".join(stem + mark for stem in stems for mark in marks)
    (got,) = words.ids(pa.array([text]))
    assert memoryview(got).cast("I").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert sorted(whole) == sorted(marks)


def test_ids_with_marks_and_added_tokens():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, words = Tokenizer.from_file(path), packing.Words(path)
    texts = [
        "it's. dogs' he'd!! x'S% 5% 10,000.00! \u00b2. \u2163,. \u0130. I\u0307% e\u0301## <\u0338 a<\u0338",
        "\u03a3\u03a3 \u039f\u03a3. \u03bf\u03a3# H\u0331. h\u0331 \u01c5% \ud55c\uae00!! \u1112\u1161\u11ab? \u4e2d\u6587.",
        "<|endoftext|> a<|endoftext|>. <|endoftext|>b# <|ENDOFTEXT|> A<|StartOfText|>! <|endoftext <|endoftext|>>",
        " ".join(a + b for a in ("a", "A", "\u00c9", "7", "a-b", "-", "_") for b in string.punctuation),
    ]
    for text, got in zip(texts, words.ids(pa.array(texts))):
        for word in text.split(" "):
            assert (word, memoryview(words[word]).cast("I").tolist()) == (
                word,
                tokenizer.encode(word, add_special_tokens=False).ids,
            )
        assert memoryview(got).cast("I").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert list(words.ids(pa.array([], pa.string()))) == []


def test_pieces_do_not_depend_on_how_much_is_tokenised_at_a_time(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.range(60).selectExpr(
        "id doc_id", "if(id % 9 = 0, null, repeat(concat('Word ', id, ' naïve; '), cast(id * 5 as int))) text"
    ).coalesce(1)
    whole, sliced = (packing.pack(docs, path, slice_bytes=n).collect() for n in (4_000_000, 100))
    assert sorted(whole, key=repr) == sorted(sliced, key=repr) and len(whole) >= 60


def test_packing_keeps_few_words_and_hands_on_few_ids(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    few = packing.Words(path, kept=50)
    texts = [" ".join(f"word{i}x{j}" for j in range(20)) for i in range(40)]
    got, most = [], 0
    for text in texts:
        got += few.ids(pa.array([text]))
        most = max(most, len(few))
    # Words of the last text come on top, each with its parts.
    assert most <= 50 + 3 * 20 and got == list(packing.Words(path).ids(pa.array(texts)))
    docs = spark.createDataFrame([(i, text * 9) for i, text in enumerate(texts)], "doc_id bigint, text string").coalesce(1)
    many, few = (packing.pack(docs, path, **bounds) for bounds in ({}, {"out_bytes": 100, "kept_words": 50}))
    assert many.collect() == few.collect() and many.count() >= 40


def test_each_text_is_coded_once_when_scored(monkeypatch):
    texts = ["a b", "", "a  c\nd", "b" * 30]
    tree = suffix_tree.Tree(np.log10(np.full(256, 1 / 256)), [])
    coded, symbols = [], suffix_tree.symbols
    monkeypatch.setattr(suffix_tree, "symbols", lambda text: coded.append(text) or symbols(text))
    got = suffix_tree.log_scores(tree, texts)
    assert coded == texts
    assert got == pytest.approx([-n * np.log10(256) for n in (4, 1, 6, 31)])
