"""Hard negatives by exact integer products in a residue number system.

Components become whole numbers, ``floor(SCALE * x)``. A score is the inner product of
two such rows. For each of several small primes the component matrices are reduced to
balanced residues and multiplied in float32, where every partial sum is a whole number
below 2^24 and so exact; the residues of the products are put together by Chinese
remaindering (balanced mixed radix digits) to the exact signed score. How many primes
are needed follows from the largest squared length of all rows (Cauchy-Schwarz).

Two passes over cells of an anchor block and a share of the rows: the first finds each
anchor's best rows of its own label, the positives; the second, for each positive, the
best rows of other labels whose score lies in the positive's window. A task holds one
block of at most about ``ANCHORS`` anchors and one Arrow batch of rows; it streams the
rows of its cells and keeps ``k`` rows for each anchor (and positive), which a window
function then merges. All anchors meet all rows; nothing is pruned, so results are exact.

Higher scores come first, of equal ones the smaller id, then the place in the table.
Rows with a null id, label or vector, or a null or non-finite component take no part,
nor do rows of squared length 2^62 or more, whose scores might not fit a long. A shorter
vector counts as filled up with zeros. Repeated rows count each for itself, and an
anchor is not its own positive but a repetition of it may be. An anchor without
positives, or a positive without rows in its window, has no result; an empty table gives
an empty one. Other columns do not interfere. Rows are told apart by their place in the
scan, so ``vectors`` is a stored table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ballast.functions.sizing import staged

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = (80, 100), (100, 100)  # the window as fractions of the positive's score
ANCHORS = 2048  # anchors of one block, about
CELL_ROWS = 1 << 20  # rows of one cell at most, about
LEAST_CELL = 2048
TILE = 256  # anchors or windows whose scores are held at a time
LIMIT = 1 << 62
NONE = np.iinfo(np.int64).min


def primes(below: int = 256) -> list[int]:
    """Odd primes, the largest first."""
    return [p for p in range(below - 1, 2, -1) if all(p % q for q in range(2, int(p**0.5) + 1))]


def moduli(largest: float) -> list[int]:
    """As many primes as tell apart all whole numbers from -largest to largest."""
    chosen, product = [], 1
    for p in primes():
        if product > 2 * largest + 1:
            break
        chosen.append(p)
        product *= p
    return chosen or [primes()[0]]


def balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Residues between -(p - 1) / 2 and (p - 1) / 2."""
    half = p // 2
    return (x + half) % p - half


class Residues:
    """A matrix of whole numbers as one float32 matrix of balanced residues per prime."""

    def __init__(self, rows: np.ndarray, mods: list[int]):
        self.mods = mods
        self.parts = [balanced(rows, p).astype(np.float32) for p in mods]

    def products(self, other: Residues, first: int, last: int) -> np.ndarray:
        """Exact scores of rows ``first`` to ``last`` with all rows of ``other``."""
        total, digits, weight = None, [], 1
        for i, p in enumerate(self.mods):
            digit = _product_mod(self.parts[i][first:last], other.parts[i], p)
            # The mixed radix digit: what is left of the residue after the lower digits.
            known, scale = np.zeros_like(digit), 1
            for lower, q in zip(digits, self.mods):
                known += lower * (scale % p)
                scale = scale * q % p
            digit = balanced((digit - known) * pow(scale, -1, p), p)
            digits.append(digit)
            # Wraps beyond 64 bits on the way; the score itself fits.
            part = digit.astype(np.int64) * np.int64(weight)
            total = part if total is None else total + part
            weight *= p
        return total


def _product_mod(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """Balanced residues of a times b transposed; float32 sums stay below 2^24."""
    most = (1 << 24) // (p // 2) ** 2
    out = np.zeros((len(a), len(b)), np.int32)
    for at in range(0, a.shape[1], most):
        out += (a[:, at : at + most] @ b[:, at : at + most].T).astype(np.int32)
        out = balanced(out, p)
    return out


def matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Rows of at least ``width`` columns, shorter ones filled up with zeros."""
    values = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    width = max(width, int(sizes.max(initial=0)))
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


class Best:
    """The first ``k`` rows of each window so far: score down, id up, place up."""

    def __init__(self, windows: int, k: int):
        self.k = k
        self.least = np.full(windows, NONE)  # the k-th score, once there are k
        self.rows = np.zeros((0, 4), np.int64)  # window, score, id, place

    def add(self, found: np.ndarray) -> None:
        rows = np.concatenate([self.rows, found])
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        starts = np.flatnonzero(np.diff(rows[:, 0], prepend=-1))
        rank = np.arange(len(rows)) - np.repeat(starts, np.diff(np.append(starts, len(rows))))
        self.rows = rows[rank < self.k]
        last = rows[rank == self.k - 1]
        self.least[last[:, 0]] = last[:, 1]


class Cell:
    """One anchor block and the rows that stream past it. Each window belongs to an
    anchor and admits rows of its label (or of the others) with scores from low to high."""

    def __init__(self, table: pa.Table, mods: list[int], k: int, same: bool):
        self.mods, self.same = mods, same
        self.places = table["row_id"].to_numpy()
        self.labels = table["label"].to_numpy()
        self.numbers = matrix(table["comps"].combine_chunks(), 1)
        self.coded = Residues(self.numbers, mods)
        low, high = (table[c].combine_chunks() for c in ("low", "high"))
        self.low, self.high = low.flatten().to_numpy(), high.flatten().to_numpy()
        self.owner = np.repeat(np.arange(len(table)), np.diff(low.offsets.to_numpy()))
        self.slot = np.arange(len(self.owner)) - np.searchsorted(self.owner, self.owner)
        self.best = Best(len(self.owner), k)

    def meet(self, batch: pa.RecordBatch) -> None:
        rows = matrix(batch["comps"], self.numbers.shape[1])
        if rows.shape[1] > self.numbers.shape[1]:
            self.numbers = np.pad(self.numbers, ((0, 0), (0, rows.shape[1] - self.numbers.shape[1])))
            self.coded = Residues(self.numbers, self.mods)
        ids, places = batch["vec_id"].to_numpy(), batch["row_id"].to_numpy()
        labels, coded = batch["label"].to_numpy(), Residues(rows, self.mods)
        for first in range(0, len(self.places), TILE):
            scores = self.coded.products(coded, first, first + TILE)
            begin, end = np.searchsorted(self.owner, [first, first + TILE])
            for at in range(begin, end, TILE):
                windows = np.arange(at, min(at + TILE, end))
                own = self.owner[windows]
                s = scores[own - first]
                fits = (labels == self.labels[own][:, None]) == self.same
                fits &= (s >= self.low[windows][:, None]) & (s <= self.high[windows][:, None])
                fits &= s >= self.best.least[windows][:, None]
                if self.same:
                    fits &= places != self.places[own][:, None]
                s = np.where(fits, s, NONE)
                if s.shape[1] > self.best.k:
                    kth = np.partition(s, s.shape[1] - self.best.k, axis=1)[:, -self.best.k]
                    fits &= s >= kth[:, None]
                w, row = np.nonzero(fits)
                if len(w):
                    self.best.add(np.stack([windows[w], s[w, row], ids[row], places[row]], axis=1))

    def result(self) -> pa.RecordBatch:
        window, score, vec, place = self.best.rows.T
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (self.places[self.owner[window]], self.slot[window], score, vec, place)],
            ["anchor", "slot", "score", "vec_id", "place"],
        )


def _best(
    anchors: DataFrame, rows: DataFrame, blocks: int, cells: int, mods: list[int], k: int, same: bool
) -> DataFrame:
    """anchor (its place), slot, rank, score, vec_id: the first ``k`` rows for each
    entry of the anchors' arrays ``low`` and ``high``."""
    no_bounds = F.array().cast("array<bigint>")

    def share(n: int) -> Column:
        return F.pmod(F.xxhash64("row_id"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    columns = ["block", "cell", "kind", "row_id", "vec_id", "label", "comps", "low", "high"]
    one = anchors.withColumns({"block": share(blocks), "kind": F.lit(0)}).withColumn("cell", every(cells))
    other = rows.withColumns(
        {"cell": share(cells), "kind": F.lit(1), "low": no_bounds, "high": no_bounds}
    ).withColumn("block", every(blocks))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, at, waiting = None, None, []
        for batch in batches:
            # One pass over runs of equal (block, cell, kind).
            marks = np.stack([batch[c].to_numpy() for c in ("block", "cell", "kind")], axis=1)
            edges = [0, *(np.flatnonzero((np.diff(marks, axis=0) != 0).any(axis=1)) + 1).tolist(), len(marks)]
            for first, last in zip(edges[:-1], edges[1:]):
                if first == last:
                    continue
                part, (*key, kind) = batch.slice(first, last - first), marks[first].tolist()
                if key != at:
                    if cell is not None:
                        yield cell.result()
                    cell, at, waiting = None, key, []
                if kind == 0:
                    waiting.append(part)
                elif cell or waiting:
                    if cell is None:
                        cell = Cell(pa.Table.from_batches(waiting), mods, k, same)
                        waiting = []
                    cell.meet(part)
        if cell is not None:
            yield cell.result()

    first = (
        one.select(columns)
        .unionByName(other.select(columns))
        .repartition(max(1, blocks * cells), "block", "cell")
        .sortWithinPartitions("block", "cell", "kind")
        .mapInArrow(task, "anchor bigint, slot bigint, score bigint, vec_id bigint, place bigint")
    )
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id", "place")
    return first.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def whole_numbers(vector: Column, scale: int = SCALE) -> tuple[Column, Column]:
    """Whether a row takes part, and its components as whole numbers."""
    size = F.aggregate(
        vector, F.lit(0.0), lambda s, x: s + F.pow(F.abs(x.cast("double")) * scale + 1, F.lit(2.0))
    )
    # A null makes the sum null, NaN and infinity fail the comparison.
    fits = F.coalesce(~F.isnan(size) & (size < float(LIMIT)), F.lit(False))
    return fits, F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def mine(
    vectors: DataFrame,
    anchor: Column,
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: tuple[int, int] = LOW,
    high: tuple[int, int] = HIGH,
) -> DataFrame:
    """A row for each anchor, positive and negative: anchor_id, positive_id,
    positive_rank, rank, negative_id, positive_score, negative_score. ``anchor`` is a
    condition on the columns of ``vectors``; ``label`` is an integer."""
    fits, comps = whole_numbers(F.col(vector))
    rows = staged(
        vectors.select(
            F.monotonically_increasing_id().alias("row_id"),
            F.col(vec_id).cast("bigint").alias("vec_id"),
            F.col(label).cast("bigint").alias("label"),
            F.when(fits, comps).alias("comps"),
            F.coalesce(anchor, F.lit(False)).alias("anchor"),
        ).filter("vec_id is not null and label is not null and comps is not null"),
        "vectors",
    )
    length = F.aggregate(
        "comps", F.lit(0.0), lambda s, x: s + F.pow(x.cast("double"), F.lit(2.0))
    )
    size = rows.agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors"), F.max(length).alias("most")).first()
    mods = moduli(int((size["most"] or 0.0) * (1 + 1e-6)))
    blocks = max(1, -(-size["anchors"] // ANCHORS))
    # Cells for every core while anchors are few; later only as many as bound a cell.
    wanted = -(-2 * vectors.sparkSession.sparkContext.defaultParallelism // blocks)
    cells = max(1, -(-size["n"] // CELL_ROWS), min(wanted, size["n"] // LEAST_CELL))

    def bounds(x: Column) -> Column:
        return F.array(x.cast("bigint"))

    anchors = rows.filter("anchor")
    plain = rows.drop("anchor")
    open_low, open_high = bounds(F.lit(NONE + 1)), bounds(F.lit(-(NONE + 1)))
    near = staged(
        _best(
            anchors.drop("anchor").withColumns({"low": open_low, "high": open_high}),
            plain, blocks, cells, mods, positives, True,
        ),
        "positives",
    )
    listed = near.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("found")
    )

    def bound(of: tuple[int, int], up: bool) -> Column:
        # As decimals, since a multiple of a score may not fit a long.
        def one(x: Column) -> Column:
            share = x["score"].cast("decimal(20,0)") * F.lit(of[0]).cast("decimal(9,0)")
            exact = share / F.lit(of[1]).cast("decimal(9,0)")
            return (F.ceil(exact) if up else F.floor(exact)).cast("bigint")

        return F.transform("found", one)

    windowed = (
        anchors.drop("anchor")
        .join(listed, F.col("row_id") == listed["anchor"])
        .withColumns({"low": bound(low, True), "high": bound(high, False)})
    )
    far = _best(windowed, plain, blocks, cells, mods, negatives, False).select(
        "anchor", (F.col("slot") + 1).cast("int").alias("positive_rank"), "rank",
        F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"),
    )
    kept = near.select(
        "anchor", F.col("rank").alias("positive_rank"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    names = anchors.select(F.col("row_id").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (
        far.join(kept, ["anchor", "positive_rank"])
        .join(names, "anchor")
        .select(
            "anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score", "negative_score"
        )
    )
