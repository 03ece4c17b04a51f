"""The trie of all conversations, from sorted sequences and range minima.

A turn's name is 16 bytes of the SHA-256 of its role and text; a conversation is the
names of its turns, one after the other. Conversations are sorted by that, so that a
prefix's members are an interval of the order. In a block of neighbouring conversations
the lengths of the common prefixes of neighbours (LCPs, in turns) go into a sparse table
of range minima. Each candidate, a conversation with a depth, searches the table by
halves, to the left and to the right by itself, for the first LCP below its depth; that
gives its interval, without a stack and without an order among candidates. What a node
reports are sums over its interval, taken from running totals, and minima of ids from a
second sparse table.

The order is a range partitioning by (names, id), so copies of one conversation spread
over tasks, too. A block is a part of an Arrow batch of at most about ``BLOCK_TURNS``
turns. A node within a block is final there. Nodes that reach a block's first or last
conversation may go on in the next block; they are prefixes of that conversation, few,
and their sums meet in one shuffle, together with what neighbouring blocks have in
common: where they touch, a child, a leaf and the words of the common prefix.

Text is read once and does not pass a shuffle, only names and word counts do, 28 bytes a
turn. A conversation is one row of that, so it must fit in a task; long ones are not cut.
The ids of equal conversations, however many, reach the digest in order, in pieces, of
which a task holds one at a time.

Null roles and texts are empty. Turns come in the order of ``turn``, null first, equal
ones by their names; repeated rows are turns each. Rows without ``conv_id`` take no part.
Without conversations there are no nodes, not even a root. Other columns do not interfere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ballast.functions.sizing import sized_broadcast, staged
from ballast.llm.shared import whole, words

NAME = 16
BLOCK_TURNS = 1 << 20
NO_ENDS = hashlib.sha256().hexdigest()

NODES = (
    "inner boolean, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, "
    "digest binary, parent_digest binary, ends binary, task bigint, part bigint, "
    "opens boolean, closes boolean, before bigint, upto bigint, last_len bigint"
)


class RangeMin:
    """Sparse table: minima of all stretches whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.n, self.levels = len(values), [values]
        step = 1
        while 2 * step <= self.n:
            low = self.levels[-1]
            self.levels.append(np.minimum(low[:-step], low[step:]))
            step *= 2

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minima of the stretches from first to last, both included."""
        k = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for level in np.unique(k):
            at = np.flatnonzero(k == level)
            table = self.levels[level]
            out[at] = np.minimum(table[first[at]], table[last[at] - (1 << int(level)) + 1])
        return out

    def right(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last place up to which all values after ``at`` are ``least`` or more."""
        at = at.copy()
        for k in reversed(range(len(self.levels))):
            can = at + (1 << k) < self.n
            can[can] = self.levels[k][at[can] + 1] >= least[can]
            at += can.astype(at.dtype) << k
        return at

    def left(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first place from which all values after it, up to ``at``, are ``least`` or more."""
        at = at.copy()
        for k in reversed(range(len(self.levels))):
            can = at >= 1 << k
            can[can] = self.levels[k][at[can] - (1 << k) + 1] >= least[can]
            at -= can.astype(at.dtype) << k
        return at


def common(names: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Turns that each conversation has in common with the one before; -1 for the first."""
    lcp = np.zeros(len(sizes), np.int64)
    lcp[0] = -1
    alive, depth = np.arange(1, len(sizes)), 0
    while len(alive):
        alive = alive[(sizes[alive] > depth) & (sizes[alive - 1] > depth)]
        same = (names[starts[alive] + depth] == names[starts[alive - 1] + depth]).all(axis=1)
        alive = alive[same]
        lcp[alive] += 1
        depth += 1
    return lcp


def _total(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values)])


def block(keys: list[bytes], ids: np.ndarray, n_words: np.ndarray) -> dict[str, np.ndarray | list]:
    """Columns of all nodes of neighbouring conversations; see ``NODES``. ``n_words``
    has the words of all turns of all conversations, one after the other."""
    n = len(keys)
    sizes = np.array([len(k) // NAME for k in keys])
    starts = np.cumsum(sizes) - sizes
    names = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
    upto = _total(n_words)

    def said(row: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """Words in the first so many turns."""
        return upto[starts[row] + np.maximum(turns, 0)] - upto[starts[row]]

    lcp = common(names, starts, sizes)
    # Each node is a candidate of the first conversation that has it.
    new = sizes - lcp
    first = np.cumsum(new) - new
    row = np.repeat(np.arange(n), new)
    depth = np.arange(len(row)) - first[row] + lcp[row] + 1
    table = RangeMin(lcp)

    def node(row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The node that a conversation has at a depth."""
        top = table.left(row, depth)
        return first[top] + depth - lcp[top] - 1

    left, right = table.left(row, depth), table.right(row, depth)
    size = right - left + 1
    parent = np.full(len(row), -1)
    parent[1:] = node(row[1:], depth[1:] - 1)
    leaf = _total(sizes > np.append(lcp[1:], -1))
    shared = _total(said(np.arange(n), lcp))
    before = said(row, depth - 1)
    smallest = RangeMin(ids).between(left, right)

    # Prefixes of the first and of the last conversation may go on beyond the block.
    digest: list[bytes | None] = [None] * len(row)
    opens, closes = np.zeros(len(row), bool), np.zeros(len(row), bool)
    for edge, marks in ((0, opens), (n - 1, closes)):
        steps = np.arange(sizes[edge] + 1)
        hashed = hashlib.sha256()
        for d, at in enumerate(node(np.full(len(steps), edge), steps).tolist()):
            if d:
                hashed.update(keys[edge][NAME * (d - 1) : NAME * d])
            digest[at] = hashed.digest()[:NAME]
            marks[at] = True
    outer = opens | closes
    above = np.where(parent >= 0, parent, 0)
    known = (parent >= 0) & ~outer[above]

    sha, ends = [NO_ENDS] * len(row), [None] * len(row)
    firsts = np.flatnonzero(new)
    for begin, end in zip(firsts.tolist(), [*firsts[1:].tolist(), n]):
        at = first[begin] + new[begin] - 1  # where a conversation ends is its last node
        listed = ",".join(map(str, ids[begin:end].tolist())).encode()
        if outer[at]:
            ends[at] = listed
        else:
            sha[at] = hashlib.sha256(listed).hexdigest()
    return {
        "inner": ~outer,
        "conv_id": smallest,
        "depth": depth,
        "parent_conv_id": np.ma.MaskedArray(smallest[above], ~known),
        "n_convs": size,
        "n_children": np.bincount(parent[parent >= 0], minlength=len(row)),
        "n_leaves": leaf[right + 1] - leaf[left],
        "saved_tokens": shared[right + 1] - shared[left + 1] - (size - 1) * before,
        "ends_sha256": sha,
        "digest": digest,
        "parent_digest": [digest[p] if p >= 0 else None for p in parent.tolist()],
        "ends": ends,
        "opens": opens,
        "closes": closes,
        "before": before,
        "upto": said(row, depth),
        "last_len": np.full(len(row), sizes[-1]),
    }


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, part = TaskContext.get().partitionId(), 0
    for batch in batches:
        turns = np.diff(batch["words"].offsets.to_numpy())
        cuts = np.flatnonzero(np.diff(np.cumsum(turns) // BLOCK_TURNS)) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
            if begin == end:
                continue
            some = batch.slice(begin, end - begin)
            found = block(
                some["key"].to_pylist(),
                some["conv_id"].to_numpy(),
                some["words"].flatten().to_numpy(zero_copy_only=False).astype(np.int64),
            )
            n = len(found["depth"])
            found |= {"task": np.full(n, task), "part": np.full(n, part)}
            part += 1
            columns = []
            for column in NODES.split(", "):
                name, kind = column.split()
                values = found[name]
                type_ = {"bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}[kind]
                mask = values.mask if isinstance(values, np.ma.MaskedArray) else None
                columns.append(pa.array(getattr(values, "data", values) if mask is not None else values, type_, mask=mask))
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in NODES.split(", ")])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each digest's pieces, which come in order."""
    at, state = None, None

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([at], pa.binary()), pa.array([state.hexdigest()])], ["digest", "ends_sha256"]
        )

    for batch in batches:
        for digest, ends in zip(batch["digest"], batch["ends"]):
            if at != digest.as_py():
                if at is not None:
                    yield told()
                at, state = digest.as_py(), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ends.as_buffer())
    if at is not None:
        yield told()


def name(role: Column, text: Column) -> Column:
    """A turn's name in hexadecimal; the length keeps role and text apart."""
    role, text = whole(role), whole(text)
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(told.cast("binary"), 256), 1, 2 * NAME)


def sequences(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, turns: an array of (turn, name, words) in order."""
    return (
        turns.filter(F.col(conv_id).isNotNull())
        .select(
            F.col(conv_id).cast("bigint").alias("conv_id"),
            F.struct(
                F.col(turn).alias("turn"),
                name(F.col(role), F.col(text)).alias("name"),
                F.size(words(F.col(text))).alias("words"),
            ).alias("x"),
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("x")).alias("turns"))
    )


def spliced(found: DataFrame, family: int, most: int, head: Column) -> DataFrame:
    """Every conversation c with its first ``head`` turns (at most ``most``) replaced by
    those of conversation c - c % family."""
    base = F.col("conv_id") - F.col("conv_id") % family
    heads = found.filter(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("lead")
    )
    none = F.slice("turns", 1, 0)
    own = F.slice(F.col("turns"), head + 1, F.greatest(F.size("turns") - head, F.lit(0)))
    return (
        found.withColumn("base", base)
        .join(heads, "base", "left")
        .select("conv_id", F.concat(F.slice(F.coalesce("lead", none), F.lit(1), head), own).alias("turns"))
    )


def nodes(found: DataFrame) -> DataFrame:
    """A row per distinct prefix of ``found`` (conv_id, each once, and turns): conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = staged(
        found.select(
            "conv_id",
            F.unhex(F.array_join(F.transform("turns", lambda x: x["name"]), "")).alias("key"),
            F.transform("turns", lambda x: x["words"]).alias("words"),
        ),
        "sequences",
    )
    ordered = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    local = staged(ordered.mapInArrow(_nodes, NODES), "nodes")
    outer = local.filter("not inner")

    # Which block comes before a task's first: a row per task.
    by_task = Window.orderBy("task")
    tasks = (
        local.groupBy("task")
        .agg(F.max("part").alias("last"))
        .select("task", F.lag("task").over(by_task).alias("prior"), F.lag("last").over(by_task).alias("prior_last"))
    )
    after = (
        outer.filter("opens")
        .join(F.broadcast(tasks), "task")
        .select(
            F.when(F.col("part") > 0, F.col("task")).otherwise(F.col("prior")).alias("task"),
            F.when(F.col("part") > 0, F.col("part") - 1).otherwise(F.col("prior_last")).alias("part"),
            "depth", "digest", "before", "upto",
        )
    )
    edge = Window.partitionBy("task", "part")
    met = (
        after.join(
            outer.filter("closes").select("task", "part", "depth", "digest", "last_len"),
            ["task", "part", "depth", "digest"],
        )
        .withColumn("lcp", F.max("depth").over(edge))
        .withColumn("shared", F.max("upto").over(edge))
    )
    touching = met.select(
        "digest",
        "depth",
        F.lit(None).cast("bigint").alias("conv_id"),
        F.lit(None).cast("binary").alias("parent_digest"),
        F.lit(0).cast("bigint").alias("n_convs"),
        (-(F.col("depth") < F.col("lcp")).cast("bigint")).alias("n_children"),
        (-(F.col("lcp") == F.col("last_len")).cast("bigint")).alias("n_leaves"),
        (F.col("shared") - F.col("before")).alias("saved_tokens"),
    )
    merged = staged(
        outer.select(touching.columns)
        .unionByName(touching)
        .groupBy("digest", "depth")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.max("parent_digest").alias("parent_digest"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        ),
        "outer",
    )
    ended = (
        outer.filter("ends is not null")
        .select("digest", "task", "part", "ends")
        .repartition("digest")
        .sortWithinPartitions("digest", "task", "part")
        .mapInArrow(_hashed, "digest binary, ends_sha256 string")
    )
    tops = sized_broadcast(
        merged.select(F.col("digest").alias("parent_digest"), F.col("conv_id").alias("parent_conv_id"))
    )
    columns = (
        "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"
    ).split()
    inner = local.filter("inner")
    return (
        inner.filter("parent_digest is null")
        .select(columns)
        .unionByName(
            inner.filter("parent_digest is not null")
            .drop("parent_conv_id")
            .join(tops, "parent_digest", "left")
            .select(columns)
        )
        .unionByName(
            merged.join(ended, "digest", "left")
            .join(tops, "parent_digest", "left")
            .na.fill(NO_ENDS, ["ends_sha256"])
            .select(columns)
        )
    )
