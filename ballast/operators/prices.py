"""Percentage ticks on prices: gating, the ordered fold, and as-of lookup.

Every tick multiplies the price and rounds it to six digits, so the ticks of one
listing depend on each other in order and no aggregate gives the result. The fold
runs over sorted partitions as Arrow batches, keeping one price at a time.

A listing with very many ticks is not left to one task. Its ticks are cut by a
range partitioning on (listing, time, id) and all pieces are folded at once. The first
round folds each from the stored price, which shows about where each will open. The
second folds each from a bracket of neighbouring opening prices, which makes it a step
function from opening to closing price; chained, they give every piece's exact opening
price. A piece that opens outside its bracket is folded again around the price that the
chain has for it; the first such piece then opens in the middle, so each round settles
at least one more, and the result equals the sequential fold.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ballast.functions.money import AMOUNT, INTEGER, amount, micros
from ballast.functions.sizing import cut_lineage, fits_broadcast, staged
from ballast.functions.tickfold import BRACKET, LISTING, fold, fold_piece, piece_maps
from ballast.operators.quality import reject

# Above the first, a listing is cut into pieces of about the second.
HOT_TICKS = 5_000_000
PIECE_TICKS = 2_000_000

# Up to so many closings a tick carries those of its month; more are merged with the ticks.
INDEX_ROWS = 1000


@dataclass
class PriceUpdate:
    latest: DataFrame
    history: DataFrame
    rejects: DataFrame


def gate_index(gate_closed: DataFrame) -> DataFrame:
    """Closed intervals as one row per currency and month they touch: their starts in
    order, and beside each the latest end of any that started by then, so intervals may
    overlap. ``steps`` are the powers of two that a search over the starts goes through.

    A row holds what one currency closes in one month, however long intervals are, and
    every tick of that month carries it, so this is for few intervals.
    Empty intervals and those with a null close nothing.
    """
    first, last = F.date_trunc("month", "closed_from"), F.date_trunc("month", "closed_to")
    so_far = (
        Window.partitionBy("closed_curr", "month")
        .orderBy("closed_from")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    bounds = F.array_sort(F.collect_set(F.struct("closed_from", "until")))
    top = F.floor(F.log2(F.size("bounds"))).cast("int")
    return (
        gate_closed.filter(F.col("closed_from") < F.col("closed_to"))
        .select(
            F.col("curr_code").alias("closed_curr"),
            "closed_from",
            "closed_to",
            F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("month"),
        )
        .withColumn("until", F.max("closed_to").over(so_far))
        .groupBy("closed_curr", "month")
        .agg(bounds.alias("bounds"))
        .select(
            "closed_curr",
            "month",
            F.col("bounds.closed_from").alias("starts"),
            F.col("bounds.until").alias("until"),
            F.transform(
                F.sequence(top, F.lit(0), F.lit(-1)), lambda k: F.pow(F.lit(2), k).cast("int")
            ).alias("steps"),
        )
    )


def gate_ticks(ticks: DataFrame, gate_closed: DataFrame, index_rows: int = INDEX_ROWS) -> DataFrame:
    """Ticks that arrive while their currency's gate is open.

    Of few closings, each tick meets the one index row of its currency and month, an
    equi-join, and finds the last start at or before it by binary search; so do the ticks
    of a stream, which cannot be sorted. Of many, see :func:`_gate_by_merge`.
    """
    if not ticks.isStreaming and not fits_broadcast(gate_closed.limit(index_rows + 1), index_rows):
        return _gate_by_merge(ticks, gate_closed)

    def further(found: Column, step: Column) -> Column:
        there = F.get("starts", found + step - 1)
        return F.when(there <= F.col("ts"), found + step).otherwise(found)

    started = F.aggregate("steps", F.lit(0), further)
    closed = F.col("ts") < F.get("until", started - 1)
    same = (F.col("curr_code") == F.col("closed_curr")) & (F.date_trunc("month", "ts") == F.col("month"))
    return (
        ticks.join(gate_index(gate_closed), same, "left")
        .filter(~F.coalesce(closed, F.lit(False)))
        .select(*[ticks[name] for name in ticks.columns])
    )


def _gate_by_merge(ticks: DataFrame, gate_closed: DataFrame) -> DataFrame:
    """Closings and ticks are merged in the order of (currency, time): a range partitioning,
    so a row stays as narrow as it is and a currency with very many of either is spread over
    tasks. A tick is closed if any closing that began by then ends after it. Within a
    partition a window carries the latest end on; what crosses the partitions' edges is the
    latest end of those before, a row for each partition and currency.
    """
    place, rank = "_place", "_rank"
    asked = ticks.select(
        "curr_code", F.col("ts").alias("_t"), F.lit(1).alias(rank),
        F.xxhash64(*ticks.columns).alias("_spread"),
        F.lit(None).cast(gate_closed.schema["closed_to"].dataType).alias("_until"),
        F.struct(*ticks.columns).alias("_tick"),
    )
    closings = gate_closed.filter(F.col("closed_from") < F.col("closed_to")).select(
        "curr_code", F.col("closed_from").alias("_t"), F.lit(0).alias(rank),
        F.xxhash64("closed_to").alias("_spread"), F.col("closed_to").alias("_until"),
        F.lit(None).cast(asked.schema["_tick"].dataType).alias("_tick"),
    )
    merged = staged(
        closings.filter(F.col("curr_code").isNotNull())
        .unionByName(asked)
        .repartitionByRange("curr_code", "_t", rank, "_spread")
        .withColumn(place, F.spark_partition_id())
        .drop("_spread"),
        "gated",
    )
    parts = Window.partitionBy("curr_code").orderBy(place)
    before = (
        merged.groupBy("curr_code", place)
        .agg(F.max("_until").alias("_last"))
        .select("curr_code", place, F.max("_last").over(parts.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    )
    own = Window.partitionBy(place, "curr_code").orderBy("_t", rank)
    latest = F.greatest("_before", F.max("_until").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        merged.join(F.broadcast(before), [place, "curr_code"], "left")
        .withColumn("_latest", latest)
        .filter((F.col(rank) == 1) & ~F.coalesce(F.col("_latest") > F.col("_t"), F.lit(False)))
        .select("_tick.*")
    )


def unknown_ticks(ticks: DataFrame, listing_price: DataFrame) -> DataFrame:
    """Ticks for a listing that has no price."""
    return ticks.join(listing_price.select(LISTING), LISTING, "left_anti")


FOLDED = (
    "asset_id bigint, exch_code string, curr_code string, event_id bigint, ts timestamp_ntz,"
    f" pre {INTEGER}, post {INTEGER}"
)
_PIECES = (
    f"piece int, first string, last string, stored {INTEGER}, low {INTEGER}, closings array<{INTEGER}>"
)


def priced_ticks(listing_price: DataFrame, ticks: DataFrame, how: str = "inner") -> DataFrame:
    """Ticks of known listings with the price they start from; with a left join the
    others, too."""
    opening = listing_price.select(*LISTING, micros(F.col("price")).alias("opening"))
    return ticks.select(*LISTING, "event_id", "ts", "variance").join(opening, LISTING, how)


def _fold_by_listing(priced: DataFrame) -> DataFrame:
    """All ticks of a listing in one task; listings spread over the cluster."""
    return (
        priced.repartition(*LISTING)
        .sortWithinPartitions(*LISTING, "ts", "event_id")
        .mapInArrow(fold, FOLDED)
    )


def _chained(pieces: list[Row]) -> tuple[dict[int, int], dict[int, int]]:
    """Opening price of each piece, by chaining their closing prices; and, of the pieces
    that were not folded from it, where to fold them from next."""
    opened: dict[int, int] = {}
    missed: dict[int, int] = {}
    last, price = None, 0
    for piece in pieces:
        opening = price if piece.first == last else int(piece.stored)
        opened[piece.piece] = opening
        last, closings = piece.last, piece.closings
        if piece.first != piece.last:
            price = int(closings[0])
            continue
        at = opening - int(piece.low)
        if 0 <= at < len(closings) and closings[at] is not None:
            price = int(closings[at])
            continue
        # Expected to scale with the opening price.
        missed[piece.piece] = opening
        middle = len(closings) // 2
        used = int(piece.low) + middle
        price = round(Fraction(int(closings[middle]) * opening, used)) if used else 0
    return opened, missed


def piece_openings(ranged: DataFrame, bracket: int = BRACKET) -> tuple[dict[int, int], int]:
    """The exact opening price of every piece, and the rounds that took."""
    ends: dict[int, Row] = {}
    missed: dict[int, int] = {}
    todo, rounds = ranged, 0
    while True:
        # One row per piece, so this is as small as the number of partitions.
        for row in todo.mapInArrow(piece_maps(missed, bracket if rounds else 0), _PIECES).collect():
            ends[row.piece] = row
        rounds += 1
        opened, missed = _chained([ends[piece] for piece in sorted(ends)])
        if not missed:
            return opened, rounds
        todo = ranged.filter(F.col("piece").isin(list(missed)))


def _fold_in_pieces(priced: DataFrame, pieces: int) -> DataFrame:
    """Ticks of a listing over several tasks; see the module text."""
    order = [*LISTING, "ts", "event_id"]
    ranged = priced.repartitionByRange(pieces, *order).sortWithinPartitions(*order)
    ranged = cut_lineage(ranged.withColumn("piece", F.spark_partition_id()))
    opened, _ = piece_openings(ranged)
    return ranged.mapInArrow(fold_piece(opened), FOLDED)


def _from_micros(name: str):
    return (F.col(name).cast("decimal(26,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast(AMOUNT)


def as_changes(folded: DataFrame, *extra: str) -> DataFrame:
    """Folded ticks in the columns of the price log."""
    return folded.select(
        F.col("event_id").alias("id"),
        *LISTING,
        F.col("ts").alias("price_dt"),
        _from_micros("pre").alias("price_pre"),
        _from_micros("post").alias("price_post"),
        *extra,
    )


def fold_ticks(
    listing_price: DataFrame,
    ticks: DataFrame,
    hot_ticks: int = HOT_TICKS,
    piece_ticks: int = PIECE_TICKS,
) -> DataFrame:
    """Every tick of a known listing with the price before and after it; the
    price after is NULL for a tick that is set aside."""
    priced = priced_ticks(listing_price, ticks)
    counts = ticks.groupBy(*LISTING).agg(F.count("*").alias("n"))
    biggest, total = counts.agg(F.max("n"), F.sum("n")).first()
    if (biggest or 0) <= hot_ticks:
        folded = _fold_by_listing(priced)
    else:
        folded = _fold_in_pieces(priced, max(2, -(-total // piece_ticks)))
    return as_changes(folded)


def latest_prices(
    listing_price: DataFrame, history: DataFrame, order: tuple[str, ...] = ("price_dt", "id")
) -> DataFrame:
    """Current price of every listing after the logged ticks."""
    last = history.groupBy(*LISTING).agg(
        F.max(F.struct(*order, "price_post")).alias("last")
    )
    return listing_price.join(last, LISTING, "left").select(
        *LISTING, F.coalesce(F.col("last.price_post"), F.col("price")).alias("price")
    )


def apply_ticks(
    listing_price: DataFrame,
    ticks: DataFrame,
    gate_closed: DataFrame | None = None,
    stage=lambda df, label: df,
    **limits: int,
) -> PriceUpdate:
    """New prices, the log of every change, and the ticks set aside."""
    if gate_closed is not None:
        ticks = gate_ticks(ticks, gate_closed)
    folded = stage(fold_ticks(listing_price, ticks, **limits), "folded")
    history = folded.filter(F.col("price_post").isNotNull())
    rejects = reject(
        unknown_ticks(ticks, listing_price), "apply_ticks", [F.col("event_id")], "unknown listing"
    ).unionByName(
        reject(
            folded.filter(F.col("price_post").isNull()),
            "apply_ticks",
            [F.col("id")],
            "price out of range",
        )
    )
    return PriceUpdate(latest_prices(listing_price, history), history, rejects)


def prices_at(moments: DataFrame, history: DataFrame, listing_price: DataFrame, at: str) -> DataFrame:
    """``moments`` (any columns, with the listing's and a time ``at``) with ``price``: that of
    the last change up to the moment; else what the first later change started from; else
    the current price, or null without one.

    Moments and changes are merged in the order of (listing, time): a range partitioning,
    so a listing with very many of either is spread over tasks. Within a partition a window
    carries the last change on and the next one back; what crosses the partitions' edges
    is one row for each, taken from the partitions before and after.
    """
    place, rank = "_place", "_rank"
    asked = moments.select(
        *LISTING, F.col(at).alias("_t"), F.lit(1).alias(rank), F.lit(None).cast("bigint").alias("_id"),
        F.lit(None).cast(AMOUNT).alias("_post"), F.lit(None).cast(AMOUNT).alias("_pre"),
        F.struct(*moments.columns).alias("_row"),
    )
    changes = history.select(
        *LISTING, F.col("price_dt").alias("_t"), F.lit(0).alias(rank), F.col("id").alias("_id"),
        F.col("price_post").alias("_post"), F.col("price_pre").alias("_pre"),
        F.lit(None).cast(asked.schema["_row"].dataType).alias("_row"),
    )
    order = [*LISTING, "_t", rank, "_id"]
    merged = staged(
        changes.unionByName(asked)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(place, F.spark_partition_id()),
        "merged",
    )
    change = F.when(F.col(rank) == 0, F.struct(*[F.col(c) for c in order], "_post", "_pre"))
    edges = merged.groupBy(place).agg(
        F.max(change).alias("last"), F.min(change).alias("first"),
    )
    # A row per partition.
    parts = Window.orderBy(place)
    around = edges.select(
        place,
        F.last("last", True).over(parts.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.first("first", True).over(parts.rowsBetween(1, Window.unboundedFollowing)).alias("_after"),
    )
    own = Window.partitionBy(place, *LISTING).orderBy("_t", rank, "_id")
    carried = (
        merged.join(F.broadcast(around), place)
        .withColumn("_upto", F.last("_post", True).over(own))
        .withColumn("_next", F.first("_pre", True).over(own.rowsBetween(0, Window.unboundedFollowing)))
        .filter(F.col(rank) == 1)
    )

    def same(edge: str) -> Column:
        return F.struct(*[F.col(f"{edge}.{c}").alias(c) for c in LISTING]) == F.struct(*LISTING)

    found = F.coalesce(
        "_upto",
        F.when(same("_before"), F.col("_before._post")),
        "_next",
        F.when(same("_after"), F.col("_after._pre")),
    )
    return (
        carried.select(*LISTING, found.alias("_found"), "_row")
        .join(listing_price.select(*LISTING, "price"), LISTING, "left")
        .select("_row.*", F.coalesce("_found", "price").alias("price"))
    )


def snapshot_asof(history: DataFrame, listing_price: DataFrame, at: str) -> DataFrame:
    """Price of every listing at a moment: the last change up to then; else what
    the first later change started from; else the current price."""
    moment = F.lit(at).cast("timestamp_ntz")
    known = F.col("price_dt") <= moment
    changes = history.groupBy(*LISTING).agg(
        F.max(F.when(known, F.struct("price_dt", "id", "price_post"))).alias("upto"),
        F.min(F.when(~known, F.struct("price_dt", "id", "price_pre"))).alias("later"),
    )
    price = F.coalesce(F.col("upto.price_post"), F.col("later.price_pre"), F.col("price"))
    return listing_price.join(changes, LISTING, "left").select(
        *LISTING, amount(price).alias("price")
    )
