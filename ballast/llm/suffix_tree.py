"""Language-model scores from a probabilistic suffix tree over bytes.

A text is the bytes of its words, lower-cased in A-Z and joined by single spaces,
then an end symbol. The tree's nodes are contexts, strings of up to ``DEPTH`` bytes
that come before a symbol. A context is a candidate if it stands before ``LEAST_COUNT``
symbols or more; it is kept if its next-symbol distribution diverges from that of its
suffix one byte shorter by ``LEAST_NATS`` or more (Kullback-Leibler divergence times its
count), and so are the suffixes of what is kept. Both are fixed counts, the same in a
corpus of any size, so a larger corpus has more contexts. Distributions are smoothed
towards the suffix's, down to the root's. Each symbol is scored by its longest kept
context.

All training rows are counted: tasks count their own byte strings, Spark adds them up,
and tests contexts by joins with their suffixes. What is kept is collected and sent to the
executors as sorted arrays, 16 bytes for each symbol seen after a kept context.

The unigram figures beside it count words over all training rows. Words with at least a
``HOT_WORDS``-th of all tokens, so at most that many, go to the tasks, which sum them up
in the same pass over the texts; the others meet their counts in a shuffle in which none
of them is hot.

A null text is empty: one end symbol, one token. Repeated rows are counted and scored
each for itself; rows are told apart by their place in the scan, so ``docs`` is a stored
table. Without training rows all symbols are equally likely. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ballast.functions.sizing import staged
from ballast.llm.shared import tidy, whole, words

DEPTH = 5
LEAST_COUNT = 50
LEAST_NATS = 2.0
BACK_OFF = 4.0  # symbols' worth of the suffix's distribution mixed into a context's
END = 10  # a byte that no word holds; also what stands before a text
HOT_WORDS = 200_000
CHUNK = 4_000_000
BASE_ADD = 0.1

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DOWN = bytes.maketrans(UPPER.encode(), LOWER.encode())


def lowered(word: Column) -> Column:
    """A-Z lower-cased. ``lower`` does that alone where all is ASCII, and much faster."""
    ascii_only = F.octet_length(word) == F.char_length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def symbols(text: str) -> bytes:
    """``DEPTH`` ends before the text, its bytes, one end."""
    words = text.encode().translate(_DOWN).split()  # on the six bytes of white space
    return bytes([END]) * DEPTH + b" ".join(words) + bytes([END])


def _streams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ``symbols`` of all texts, one after the other; where each begins."""
    coded = [symbols(t) for t in texts]
    sizes = np.array([len(c) for c in coded])
    return np.frombuffer(b"".join(coded), np.uint8), np.cumsum(sizes) - sizes


def _unreal(starts: np.ndarray) -> np.ndarray:
    """Places of the leading ends, which are no symbols, of all texts but the first,
    counted from the first symbol."""
    return (starts[1:, None] - DEPTH + np.arange(DEPTH)).ravel()


def _codes(stream: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each symbol of the ``_streams`` of texts the number written by the DEPTH bytes
    before it and itself."""
    total = max(0, len(stream) - DEPTH)
    code = np.zeros(total, np.int64)
    for j in range(DEPTH + 1):
        code <<= 8
        code |= stream[j : j + total]
    return np.delete(code, _unreal(starts)) if len(starts) > 1 else code


def gram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """How often each string of DEPTH + 1 bytes ends in a symbol: context, symbol, n."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, size = [], 0
            texts = batch.column(0).to_pylist()
            for i, t in enumerate(texts):
                part.append(t)
                size += len(t)
                if size >= CHUNK or i == len(texts) - 1:
                    code, n = np.unique(_codes(*_streams(part)), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["gram", "n"])
                    part, size = [], 0

    counted = docs.select(whole(F.col(text)).alias("text")).mapInArrow(tidy(task), "gram bigint, n bigint")
    return (
        counted.groupBy("gram")
        .agg(F.sum("n").alias("n"))
        .select(
            F.shiftright("gram", 8).alias("context"),
            F.col("gram").bitwiseAND(255).cast("int").alias("symbol"),
            "n",
        )
    )


@dataclass
class Level:
    """The kept contexts of one length, and the symbols seen after them, as sorted codes."""

    context: np.ndarray  # its bytes as a number, the last byte lowest
    unseen: np.ndarray  # log10 of what an unseen symbol's chance in the suffix is multiplied by
    gram: np.ndarray  # context and symbol
    chance: np.ndarray  # log10


@dataclass
class Tree:
    root: np.ndarray  # log10 probability by symbol
    levels: list[Level]  # by length, from 1


def _find(codes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the wanted codes are, and whether they are there."""
    if not len(codes):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.searchsorted(codes, wanted).clip(max=len(codes) - 1)
    return at, codes[at] == wanted


def _suffix(context: Column, length: int) -> Column:
    return context.bitwiseAND(F.lit((1 << 8 * length) - 1).cast("bigint"))


def grow(grams: DataFrame) -> Tree:
    """Chooses contexts from ``gram_counts``; ``grams`` should be a stored table."""
    seen = grams.groupBy("symbol").agg(F.sum("n").alias("n")).collect()
    total = sum(r["n"] for r in seen)
    chance = np.full(256, 1 / 256)
    for r in seen:
        chance[r["symbol"]] += r["n"]
    root = np.log10(chance / (1 + total))
    if not total:
        return Tree(root, [])
    own = Window.partitionBy("context")
    # Suffixes are at least as frequent, so those of candidates are among these.
    levels = [
        staged(
            grams.groupBy(_suffix(F.col("context"), d).alias("context"), "symbol")
            .agg(F.sum("n").alias("n"))
            .withColumn("size", F.sum("n").over(own))
            .filter(F.col("size") >= LEAST_COUNT),
            "contexts",
        )
        for d in range(DEPTH + 1)
    ]
    below: DataFrame | None = None
    kept = []
    for d in range(DEPTH, 0, -1):
        up = levels[d - 1].select(
            F.col("context").alias("up"), "symbol", F.col("n").alias("up_n"), F.col("size").alias("up_size")
        )
        odds = F.log(F.col("n") / F.col("size") / (F.col("up_n") / F.col("up_size")))
        keep = (
            levels[d]
            .withColumn("up", _suffix(F.col("context"), d - 1))
            .join(up, ["up", "symbol"])
            .groupBy("context")
            .agg(F.sum(F.col("n") * odds).alias("gain"))
            .filter(F.col("gain") >= LEAST_NATS)
            .select("context")
        )
        if below is not None:
            keep = keep.unionByName(below.select(_suffix(F.col("context"), d).alias("context"))).distinct()
        below = staged(keep, "kept")
        kept.append(
            levels[d]
            .join(below, "context", "left_semi")
            .select((F.shiftleft("context", 8) + F.col("symbol")).alias("gram"), "n", "size")
        )
    tree = Tree(root, [])
    up_gram, up_chance = np.arange(256), 10.0**root
    for d, rows in enumerate(reversed(kept), 1):
        # As Arrow arrays; rows as objects would take many times the memory.
        gram, n, size = (c.to_numpy() for c in rows.toArrow().columns)
        order = np.argsort(gram)
        gram, n, size = gram[order], n[order], size[order]
        above = up_chance[np.searchsorted(up_gram, gram & ((1 << 8 * d) - 1))]
        chance = (n + BACK_OFF * above) / (size + BACK_OFF)
        context, first = np.unique(gram >> 8, return_index=True)
        tree.levels.append(
            Level(context, np.log10(BACK_OFF / (size[first] + BACK_OFF)), gram, np.log10(chance))
        )
        up_gram, up_chance = gram, chance
    return tree


def gram_scores(tree: Tree, code: np.ndarray) -> np.ndarray:
    """log10 probability of the symbol that ends each string of DEPTH + 1 bytes."""
    out = tree.root[code & 255]
    left = np.arange(len(code))
    for d, level in enumerate(tree.levels, 1):
        gram = code[left] & ((1 << 8 * (d + 1)) - 1)
        at, there = _find(level.context, gram >> 8)
        left, gram, at = left[there], gram[there], at[there]
        place, known = _find(level.gram, gram)
        out[left] += level.unseen[at]
        out[left[known]] = level.chance[place[known]]
    return out


def log_scores(tree: Tree, texts: list[str]) -> np.ndarray:
    """log10 probability of each text."""
    out = []
    part, size = [], 0
    for i, t in enumerate(texts):
        part.append(t)
        size += len(t)
        if size < CHUNK // 4 and i < len(texts) - 1:
            continue
        stream, starts = _streams(part)
        code, back = np.unique(_codes(stream, starts), return_inverse=True)
        # Without the leading ends of the texts before.
        out.append(np.add.reduceat(gram_scores(tree, code)[back], starts - DEPTH * np.arange(len(part))))
        part, size = [], 0
    return np.concatenate(out) if out else np.zeros(0)


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    return (
        docs.select(F.explode(words(F.col(text))).alias("word"))
        .groupBy(lowered(F.col("word")).alias("word"))
        .agg(F.count("*").alias("c"))
    )


@dataclass
class Frequent:
    """Words met very often in training, and log10 of their counts plus ``BASE_ADD``."""

    words: pa.Array
    logs: np.ndarray


def frequent(counts: DataFrame, total: int) -> Frequent:
    """Words with at least a ``HOT_WORDS``-th of all tokens, so at most that many."""
    found = counts.filter(F.col("c") >= total / HOT_WORDS).toArrow()
    logs = np.log10(found["c"].to_numpy().astype(float) + BASE_ADD)
    return Frequent(found["word"].combine_chunks().cast(pa.binary()), logs)


def _by_row(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], ends])])


def _unigrams(often: Frequent, texts: list[str]) -> list[pa.Array]:
    """Of each text: words, those of them that are frequent, the sum of their logs, and
    the other words."""
    split = [t.encode().translate(_DOWN).split() for t in texts]
    ends = np.cumsum([len(w) for w in split])
    flat = pa.array([w for some in split for w in some], pa.binary())
    at = pc.index_in(flat, value_set=often.words)
    rare = pc.is_null(at)
    logs = np.concatenate([often.logs, [0.0]])[pc.fill_null(at, -1).to_numpy()]
    hot = _by_row(~rare.to_numpy(zero_copy_only=False), ends)
    sizes = _by_row(np.ones(len(flat), np.int64), ends)
    offsets = np.concatenate([[0], np.cumsum(sizes - hot)]).astype(np.int32)
    others = pa.ListArray.from_arrays(pa.array(offsets), flat.filter(rare).cast(pa.string()))
    return [pa.array(sizes), pa.array(hot.astype(np.int64)), pa.array(_by_row(logs, ends)), others]


def seen(rows: DataFrame, tree: Tree, often: Frequent) -> DataFrame:
    """row_id, doc_id, held_out, score, and each text's words: n, known and logs of the
    frequent ones, ``rare`` with the others. One pass over the texts."""
    shared = rows.sparkSession.sparkContext.broadcast((tree, often))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, often = shared.value
        for batch in batches:
            texts = batch["text"].to_pylist()
            cuts = np.cumsum([len(t) for t in texts]) // (CHUNK // 4)
            edges = [0, *(np.flatnonzero(np.diff(cuts)) + 1).tolist(), len(texts)]
            for first, last in zip(edges[:-1], edges[1:]):
                part = texts[first:last]
                if part:
                    kept = batch.slice(first, last - first)
                    columns = [kept[c] for c in ("row_id", "doc_id", "held_out")]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(log_scores(tree, part)), *_unigrams(often, part)],
                        ["row_id", "doc_id", "held_out", "score", "n", "known", "logs", "rare"],
                    )

    return rows.select("row_id", "doc_id", "held_out", whole(F.col("text")).alias("text")).mapInArrow(
        tidy(task),
        f"row_id bigint, doc_id {kind}, held_out boolean, score double, n bigint, known bigint, "
        "logs double, rare array<string>",
    )


def scores(
    docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(doc_id).alias("doc_id"),
        held_out.alias("held_out"),
        F.col(text).alias("text"),
    )
    train = rows.filter("not held_out")
    grams = staged(gram_counts(train), "grams")
    tree = grow(grams)
    counts = staged(word_counts(train), "words")
    sums = counts.agg(F.sum("c").alias("c"), F.count("*").alias("v")).first()
    ends = train.count()
    total = (sums["c"] or 0) + ends
    distinct = sums["v"] + (1 if ends else 0)
    told = staged(seen(rows, tree, frequent(counts, total)), "seen")
    rare = (
        told.select("row_id", F.explode("rare").alias("word"))
        .join(counts, "word", "left")
        .groupBy("row_id")
        .agg(
            F.count("c").alias("rare_known"),
            F.sum(F.log10(F.coalesce("c", F.lit(0)) + BASE_ADD)).alias("rare_logs"),
        )
    )
    no_chance = F.lit(float(np.log10(total + BASE_ADD * (distinct + 1))))
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) + F.lit(float(np.log10(ends + BASE_ADD)))
    known = F.col("known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(ends > 0))
    tokens = F.col("n") + 1
    return told.join(rare, "row_id", "left").select(
        "doc_id",
        "held_out",
        tokens.alias("n_tokens"),
        known.cast("bigint").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (logs - tokens * no_chance).alias("base_score"),
        "score",
    )
