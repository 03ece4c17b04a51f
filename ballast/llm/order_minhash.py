"""Near duplicates by Order MinHash and banded alignment.

A text is the sequence of its runs of ``K`` words, each labelled with how often it came
before, so that no two are equal. For each of ``SKETCHES`` hash functions the ``PICKED``
runs with the smallest hashes are taken and kept in text order; together they are a key.
Texts that agree in many such keys share most runs in the same order, that is, are close
in edit distance, not only in their sets of runs.

Texts with a key in common are candidates. A candidate pair is verified by aligning the
two sequences: the longest common subsequence of labelled runs within a diagonal band
that no alignment of the wanted similarity can leave. The similarity is the aligned runs
over all runs of either text, 0.8 or more. Links are closed to classes.

Hot groups: exact copies are combined before anything else. In a key of up to ``SMALL``
texts all pairs are candidates. In a larger one every text is first compared with a hub,
the text that shares most keys with others, so n texts cost n pairs. Keys whose texts are
not of one class then are open, and their texts are joined by rare runs, which misses no
pair: similar texts share one of the rarest fifth, plus one, of the runs of either, and
what follows that run must still hold all the runs the two have to share. First each text
is compared with the hubs of the largest classes in its runs, the texts of most common
runs, and what that links is one class; then, within a run, the texts outside its largest
class with all that this leaves. So of two similar texts with a key in common both are in
one class at the end. Texts of one class, and pairs that were compared before, are not
compared again, and a pair that meets in two runs, one after the other in both texts'
orders, is made once.

Null and blank texts are one class of copies. A text of fewer than ``K`` words is one run.
Texts are compared by words; other white space does not count. Repeated rows are copies.
Null ids are carried along and never represent a class that has another id. Other columns
pass through ``drop_near``. Rows are told apart by their place in the scan, so ``docs`` is
a stored table.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ballast.functions.sizing import sized_broadcast, staged
from ballast.llm.block_naming import normalised
from ballast.llm.shared import free_name, tidy, words

K = 5
LEAST = 0.8
SKETCHES = 16
PICKED = 2
SMALL = 8
# Rounds of stars by rare runs, before all pairs that are left.
ROUNDS = 2
# Numbers of texts, 8 bytes each, that are broadcast at most: some 50 MB as a hash table.
FEW_NODES = 1_000_000

_DRAW = np.random.default_rng(2019)
_ODD = _DRAW.integers(0, 2**63, (SKETCHES, 1), dtype=np.int64).astype(np.uint64) * 2 + 1
_XOR = _DRAW.integers(0, 2**63, (SKETCHES, 1), dtype=np.int64).astype(np.uint64)
_PLACE = _DRAW.integers(0, 2**63, K, dtype=np.int64).astype(np.uint64) * 2 + 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def labelled(ids: np.ndarray) -> np.ndarray:
    """Hashes of the runs of K words in text order, equal ones told apart by their
    number."""
    if not len(ids):
        return np.zeros(0, np.uint64)
    w = ids.astype(np.uint64)
    size = min(K, len(w))
    n = len(w) - size + 1
    run = np.full(n, size, np.uint64)
    for j in range(size):
        run = run + _mix(w[j : j + n] + np.uint64(j)) * _PLACE[j]
    run = _mix(run)
    order = np.argsort(run, kind="stable")
    ranked = run[order]
    new = np.ones(n, bool)
    new[1:] = ranked[1:] != ranked[:-1]
    if new.all():
        return run
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    number = np.empty(n, np.uint64)
    number[order] = np.arange(n) - first
    return np.where(number == 0, run, _mix(run ^ _mix(number)))


def sketch(runs: np.ndarray) -> np.ndarray:
    """A key per hash function; none of an empty text."""
    if not len(runs):
        return np.zeros(0, np.int64)
    hashes = (runs[None] ^ _XOR) * _ODD
    if len(runs) <= PICKED:
        picked = np.tile(np.arange(len(runs)), (SKETCHES, 1))
    else:
        picked = np.sort(np.argpartition(hashes, PICKED - 1, axis=1)[:, :PICKED], axis=1)
    key = np.arange(SKETCHES, dtype=np.uint64)
    for column in runs[picked].T:
        key = _mix(key * np.uint64(31) + column)
    return key.view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> float:
    """Aligned runs over all runs; 0 where that cannot reach ``least``."""
    total = len(a) + len(b)
    need = least / (1 + least) * total - 1e-9
    band = max(len(a), len(b)) - need
    order = np.argsort(b)
    at = np.searchsorted(b[order], a).clip(max=len(b) - 1)
    place = order[at]
    own = np.arange(len(a))
    meets = (b[place] == a) & (np.abs(own - place) <= band)
    chain = place[meets]
    if len(chain) < need:
        return 0.0
    if np.all(chain[1:] > chain[:-1]):
        aligned = len(chain)
    else:
        ends: list[int] = []
        for j in chain.tolist():
            i = bisect_left(ends, j)
            ends[i : i + 1] = [j]
        aligned = len(ends)
    return aligned / (total - aligned)


def distinct_texts(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows (row_id, doc_id, mark) and distinct texts (mark, node, id, copies, ids);
    equal texts have the same mark, ``ids`` are hashes of the words."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
    ).withColumn("mark", F.sha2(F.trim(normalised(F.col("text"))).cast("binary"), 256))
    texts = (
        rows.withColumn("ids", F.transform(words(F.col("text")), lambda w: F.hash(w)))
        .groupBy("mark")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row_id")).alias("k"),
            F.count("*").alias("copies"),
            F.first("ids").alias("ids"),
        )
        .select("mark", F.col("k.row_id").alias("node"), F.col("k.doc_id").alias("id"), "copies", "ids")
    )
    return rows.drop("text"), staged(texts, "texts")


def _arrays(column: pa.ListArray) -> Iterator[np.ndarray]:
    flat, bounds = column.flatten().to_numpy(), column.offsets.to_numpy()
    bounds = bounds - bounds[0]
    return (flat[a:b] for a, b in zip(bounds[:-1], bounds[1:]))


def sketches(texts: DataFrame) -> DataFrame:
    """node, place (of the hash function), key, n (runs), copies."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts = [], []
            for ids in _arrays(batch.column(2)):
                runs = labelled(ids)
                keys.append(sketch(runs))
                counts.append(len(runs))
            times = [len(k) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column(0).to_numpy(), times)),
                    pa.array(np.concatenate([np.arange(t, dtype=np.int32) for t in times] or [np.zeros(0, np.int32)])),
                    pa.array(np.concatenate(keys or [np.zeros(0, np.int64)])),
                    pa.array(np.repeat(np.array(counts, np.int32), times)),
                    pa.array(np.repeat(batch.column(1).to_numpy(), times)),
                ],
                ["node", "place", "key", "n", "copies"],
            )

    return texts.select("node", "copies", "ids").mapInArrow(
        tidy(task), "node bigint, place int, key bigint, n int, copies bigint"
    )


def _plausible(x: Column, y: Column) -> Column:
    """Pairs of rows that are of different classes and not too different in length."""
    shorter, longer = F.least(x["n"], y["n"]), F.greatest(x["n"], y["n"])
    return (x["label"] != y["label"]) & (shorter >= LEAST * longer)


def _ordered(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, from structs x and y."""
    x, y = F.col("x"), F.col("y")
    return pairs.filter(_plausible(x, y)).select(
        F.least(x["node"], y["node"]).alias("a"), F.greatest(x["node"], y["node"]).alias("b")
    )


def _candidates(shared: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, from rows (node, key, n, copies, label, size) of shared keys."""
    # The text most at home among the others is the hub of its keys.
    fame = shared.groupBy("node").agg(F.sum(F.col("size") + F.col("copies")).alias("fame"))
    large = staged(shared.filter(F.col("size") > SMALL).join(fame, "node"), "large")
    hubs = staged(
        large.groupBy("key").agg(
            F.max(
                F.struct("fame", (-F.col("node")).alias("low"), F.struct("node", "n", "label").alias("x"))
            )["x"].alias("y")
        ),
        "hubs",
    )
    stars = large.join(hubs, "key").select(F.struct("node", "n", "label").alias("x"), "y")
    members = (
        shared.filter(F.col("size") <= SMALL)
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("node", "n", "label"))).alias("all"))
    )
    each = members.select(F.posexplode("all").alias("i", "x"), "all")
    pairs = each.select("x", F.explode(F.expr("slice(all, i + 2, size(all))")).alias("y"))
    return _ordered(pairs.unionByName(stars)).distinct()


def _shared(keyed: DataFrame) -> DataFrame:
    """Rows whose key texts of more than one class have, with the number of texts."""
    sizes = staged(
        keyed.groupBy("key")
        .agg(F.count("*").alias("size"), F.min("label").alias("low"), F.max("label").alias("high"))
        .filter("low <> high")
        .select("key", "size"),
        "sizes",
    )
    return staged(keyed.join(sizes, "key"), "shared")


def _open(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts (node, n, label) of the large keys whose texts are still in different classes."""
    large = (
        shared.filter(F.col("size") > SMALL)
        .drop("size", "label")
        .join(labels, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
    )
    rows = staged(large, "labelled")
    keys = (
        rows.groupBy("key")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .filter("low <> high")
        .select("key")
    )
    return staged(rows.join(staged(keys, "open"), "key").select("node", "n", "label").distinct(), "texts")


def _runs(texts: DataFrame) -> DataFrame:
    """node, run, place: the labelled runs of each text in text order."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [labelled(ids).view(np.int64) for ids in _arrays(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column(0).to_numpy(), [len(r) for r in runs])),
                    pa.array(np.concatenate(runs or [np.zeros(0, np.int64)])),
                    pa.array(np.concatenate([np.arange(len(r), dtype=np.int32) for r in runs] or [np.zeros(0, np.int32)])),
                ],
                ["node", "run", "place"],
            )

    return texts.select("node", "ids").mapInArrow(tidy(task), "node bigint, run bigint, place int")


def _reaches(n: Column, at: Column, total: Column) -> Column:
    """Whether the runs from place ``at`` on are as many as two texts of ``total`` runs
    have to share."""
    return n - at + 1e-6 >= LEAST / (1 + LEAST) * total


def _rare(open_texts: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows (run, x) of each text's rarest runs, of which similar texts share one. The runs
    of each text are put in one order, rarest first; ``at`` is a run's place in it, ``prev``
    the run before it that another text has as well. From the first run that an alignment
    of two texts has, all that it has is still to come in both; and that run lies within
    the band, as all aligned runs do."""
    runs = staged(_runs(texts.join(_few(open_texts.select("node")), "node", "left_semi")), "runs")
    # Runs of one text only come first and meet nothing, so they are only counted.
    often = runs.groupBy("run").agg(F.count("*").alias("often")).filter("often > 1")
    own = Window.partitionBy("node")
    ordered = own.orderBy("often", "run")
    placed = (
        runs.join(often, "run")
        .select(
            "node",
            "run",
            "place",
            F.row_number().over(ordered).alias("nth"),
            F.lag("run").over(ordered).alias("prev"),
            F.lag("place").over(ordered).alias("prev_place"),
            F.count("*").over(own).alias("common"),
            F.sum("often").over(own).alias("met"),
        )
        .join(open_texts, "node")
        .withColumn("at", (F.col("n") - F.col("common") + F.col("nth") - 1).cast("int"))
        .withColumn("fame", F.col("met") / F.col("n"))
    )
    # The other text has LEAST of this one's runs at least.
    return staged(
        placed.filter(_reaches(F.col("n"), F.col("at"), (1 + LEAST) * F.col("n"))).select(
            "run", F.struct("node", "n", "label", "at", "place", "prev", "prev_place", "fame").alias("x")
        ),
        "rare",
    )


def _mains(rare: DataFrame) -> DataFrame:
    """Of each run that texts of several classes have: the largest class among them."""
    return staged(
        rare.groupBy("run", F.col("x.label").alias("label"))
        .agg(F.count("*").alias("size"))
        .groupBy("run")
        .agg(F.count("*").alias("labels"), F.max(F.struct("size", "label"))["label"].alias("main"))
        .filter("labels > 1")
        .select("run", "main"),
        "mains",
    )


def _relabelled(rare: DataFrame, labels: DataFrame) -> DataFrame:
    """Rare runs with the classes of ``labels``, without the runs of one class only."""
    named = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    known = rare.join(named, F.col("x.node") == F.col("_node"), "left").select(
        "run", F.col("x").withField("label", F.coalesce("_label", "x.label")).alias("x")
    )
    rows = staged(known, "rare")
    several = rows.groupBy("run").agg(F.min("x.label").alias("low"), F.max("x.label").alias("high"))
    return rows.join(several.filter("low <> high").select("run"), "run", "left_semi")


def _within(x: Column, y: Column, place: str) -> Column:
    """Whether both have the run at places within the band."""
    need = LEAST / (1 + LEAST) * (x["n"] + y["n"])
    return F.abs(x[place] - y[place]) <= F.greatest(x["n"], y["n"]) - need + 1e-6


def _meet(x: Column, y: Column) -> Column:
    """Whether a run that both have may be the first of an alignment."""
    total = x["n"] + y["n"]
    return (
        _reaches(x["n"], x["at"], total)
        & _reaches(y["n"], y["at"], total)
        & _within(x, y, "place")
        & _plausible(x, y)
    )


def _rare_stars(rare: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b: each text with the hub of every class that is the largest in
    one of its runs, so they are no more than the rows. A hub is the text of its class
    whose runs the others have most."""
    x = F.col("x")
    hubs = rare.groupBy(x["label"].alias("main")).agg(
        F.max(F.struct(x["fame"].alias("fame"), (-x["node"]).alias("low"), "x"))["x"].alias("y")
    )
    met = rare.join(_mains(rare), "run").filter(x["label"] != F.col("main"))
    met = met.select(F.struct(x["node"], x["n"], x["label"]).alias("x"), "main").distinct()
    return _ordered(met.join(staged(hubs, "hubs"), "main")).distinct()


def _by_rare_runs(rare: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of different classes, among them all similar ones. A pair that
    meets in the run before, too, is made there."""
    out = rare.join(_mains(rare), "run").filter(F.col("x.label") != F.col("main")).withColumnRenamed("x", "y")
    x, y = F.col("x"), F.col("y")
    # Of two texts outside the largest class one is x.
    once = (x["label"] == F.col("main")) | (x["node"] < y["node"])
    before = (x["prev"] == y["prev"]) & _within(x, y, "prev_place")
    met = rare.join(
        out, (rare["run"] == out["run"]) & once & _meet(x, y) & ~F.coalesce(before, F.lit(False))
    )
    return _ordered(met.select("x", "y")).distinct()


def _links_by_rare_runs(open_texts: DataFrame, texts: DataFrame, links: DataFrame, tested: DataFrame) -> DataFrame:
    """``links`` and those that rare runs add. Stars come first, as long as they link
    anything, up to ``ROUNDS`` times: what they bring into one class needs no more pairs."""
    rare = _rare(open_texts, texts)
    for _ in range(ROUNDS):
        stars = staged(staged(_rare_stars(rare), "stars").join(tested, ["a", "b"], "left_anti"), "pairs")
        found = staged(verified(stars, texts), "verified")
        tested = tested.unionByName(stars)
        if found.isEmpty():
            break
        links = links.unionByName(found)
        rare = _relabelled(rare, components(links))
    pairs = staged(_by_rare_runs(rare), "rest").join(tested, ["a", "b"], "left_anti")
    return links.unionByName(staged(verified(staged(pairs, "pairs"), texts), "verified"))


def _few(nodes: DataFrame) -> DataFrame:
    """Numbers of texts, broadcast up to ``FEW_NODES``, so that the texts themselves
    need not be shuffled to pick some; beyond that both sides are."""
    return sized_broadcast(nodes, FEW_NODES)


def verified(pairs: DataFrame, texts: DataFrame, least: float = LEAST) -> DataFrame:
    """The pairs whose alignment reaches ``least``, with ``similarity``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [
                similarity(labelled(x), labelled(y), least)
                for x, y in zip(_arrays(batch.column(2)), _arrays(batch.column(3)))
            ]
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64())],
                ["a", "b", "similarity"],
            )
            yield out.filter(pa.array([s >= least for s in scores], pa.bool_()))

    wanted = staged(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "wanted")
    texts = texts.join(_few(wanted), "node", "left_semi")
    first = texts.select(F.col("node").alias("a"), F.col("ids").alias("x"))
    second = texts.select(F.col("node").alias("b"), F.col("ids").alias("y"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y")
    return both.mapInArrow(tidy(task), "a bigint, b bigint, similarity double")


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node that links lead to. Each round takes the
    smallest label of the neighbours, then the label of that label."""
    both = staged(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))),
        "links",
    )
    labels = staged(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")),
        "labels",
    )
    while True:
        heard = (
            both.join(labels, both.b == labels.node)
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("heard"))
        )
        near = staged(
            labels.join(heard, "node").select(
                "node", F.col("label").alias("was"), F.least("label", "heard").alias("near")
            ),
            "near",
        )
        of = near.select(F.col("node").alias("near"), F.col("near").alias("label"))
        nxt = staged(near.join(of, "near").select("node", "was", "label"), "labels")
        labels = nxt.drop("was")
        if nxt.filter("was <> label").isEmpty():
            return labels


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``docs``: row_id, doc_id, class_id, class_size, kept.

    ``class_id`` is the smallest id of the class, whose first row is kept.
    """
    rows, texts = distinct_texts(docs, doc_id, text)
    keys = staged(sketches(texts), "keys")
    shared = _shared(keys.withColumn("label", F.col("node")))
    tested = staged(_candidates(shared), "pairs")
    links = staged(verified(tested, texts), "verified")
    labels = components(links)
    open_texts = _open(shared, labels)
    if not open_texts.isEmpty():
        labels = components(_links_by_rare_runs(open_texts, texts, links, tested))
    named = (
        texts.drop("ids")
        .join(labels, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
    )
    heads = named.groupBy("label").agg(
        F.min(F.struct(F.col("id").isNull().alias("n"), "id", "node")).alias("k"),
        F.sum("copies").alias("class_size"),
    )
    known = staged(
        named.join(staged(heads, "heads"), "label").select(
            "mark",
            F.col("k.id").alias("class_id"),
            F.col("k.node").alias("kept_row"),
            "class_size",
        ),
        "classes",
    )
    return rows.join(known, "mark").select(
        "row_id", "doc_id", "class_id", "class_size", (F.col("kept_row") == F.col("row_id")).alias("kept")
    )


def drop_near(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each class."""
    place = free_name(docs, "_place")
    gone = classes(docs, doc_id, text).filter("not kept").select(F.col("row_id").alias(place))
    placed = docs.withColumn(place, F.monotonically_increasing_id())
    return placed.join(staged(gone, "gone"), place, "left_anti").drop(place)
