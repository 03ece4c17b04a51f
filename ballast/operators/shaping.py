"""Numbering, picking and shaping of reference data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ballast.functions.money import MICROS_PER_UNIT, WEIGHT
from ballast.functions.numbering import number_by_id, successor_of

# Groups up to this size may be ordered by one window task.
SMALL_GROUP = 100_000


def numbers(spark: SparkSession, n: int) -> DataFrame:
    """The integers 1..n."""
    return spark.range(1, n + 1).select(F.col("id").alias("n"))


def successor(df: DataFrame, key: str) -> DataFrame:
    """Each distinct key with the next larger one (NULL for the last)."""
    return successor_of(df.select(F.col(key).alias("key")).distinct(), "key", "next_key")


def available_listings(
    model_id: int, model: DataFrame, listing: DataFrame, model_asset: DataFrame
) -> DataFrame:
    """Listings in one model's currency that it does not hold yet."""
    wanted = model.filter(F.col("model_id") == model_id).select("curr_code")
    held = model_asset.filter(F.col("model_id") == model_id).select("asset_id")
    return listing.join(wanted, "curr_code", "left_semi").join(held, "asset_id", "left_anti")


def available_counts(model: DataFrame, listing: DataFrame, model_asset: DataFrame) -> DataFrame:
    """How many listings of its currency each model does not hold yet: all of the
    currency less those held, so the free pairs themselves are never formed."""
    listed = listing.groupBy("curr_code").agg(F.count("*").alias("listed"))
    held = (
        model_asset.join(listing.select("asset_id", "curr_code"), ["asset_id", "curr_code"])
        .groupBy("model_id")
        .agg(F.count_distinct("asset_id").alias("held"))
    )
    return (
        model.select("model_id", "curr_code")
        .join(listed, "curr_code")
        .join(held, "model_id", "left")
        .select(
            "model_id",
            "curr_code",
            (F.col("listed") - F.coalesce(F.col("held"), F.lit(0))).alias("available"),
        )
    )


def number_listings(listing: DataFrame) -> DataFrame:
    """Listings with their position within the currency, by asset id."""
    return number_by_id(listing, "asset_id", "position", ["curr_code"])


def number_accounts(account: DataFrame) -> DataFrame:
    """Work list: accounts numbered from 1 within their fund."""
    return number_by_id(account, "accnt_id", "queue_no", ["fund_id"]).select(
        "queue_no", "fund_id", "curr_code", "accnt_id"
    )


def pick_kth(model: DataFrame, listing: DataFrame, model_asset: DataFrame) -> DataFrame:
    """The ``k``-th listing by asset id that a model does not hold yet.

    ``model`` carries ``model_id, curr_code, k``. Instead of listing every free
    pair, the answer is found by position: with the held positions of a model
    sorted as ``h1 < h2 < ...``, the k-th free one is ``k + i`` where ``i`` is the
    number of held positions with ``h_j - j < k``. Models with fewer than k free
    listings give no row.
    """
    placed = number_listings(listing)
    held = (
        model_asset.select("model_id", "asset_id", "curr_code")
        .join(placed.select("curr_code", "asset_id", "position"), ["curr_code", "asset_id"])
        .withColumn("order", F.col("position"))
    )
    ranked = number_by_id(held, "order", "held_no", ["model_id"])
    skipped = (
        ranked.join(model.select("model_id", "k"), "model_id")
        .filter(F.col("position") - F.col("held_no") < F.col("k"))
        .groupBy("model_id")
        .agg(F.count("*").alias("skipped"))
    )
    wanted = model.join(skipped, "model_id", "left").withColumn(
        "position", F.col("k") + F.coalesce(F.col("skipped"), F.lit(0))
    )
    return wanted.join(placed, ["curr_code", "position"]).select(
        "model_id", "k", "asset_id", "exch_code"
    )


def model_grid(advisor: DataFrame, currency: DataFrame, per_pair: int = 10) -> DataFrame:
    """``per_pair`` models per advisor and currency, with dense ids in that order.

    The currency list is an array in a scalar subquery (codes have three letters,
    so it is small by nature) and is exploded beside each advisor: no join.
    """
    codes = currency.agg(F.array_sort(F.collect_set("curr_code"))).scalar()
    numbered = number_by_id(advisor.select("advisor_id"), "advisor_id", "advisor_no")
    spread = (
        numbered.withColumn("codes", codes)
        .select("advisor_id", "advisor_no", F.size("codes").alias("n"), F.posexplode("codes"))
        .withColumnRenamed("col", "curr_code")
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(per_pair))))
    )
    model_id = (
        (F.col("advisor_no") - 1) * F.col("n") * per_pair + F.col("pos") * per_pair + F.col("k")
    ).cast("bigint")
    return spread.select(
        model_id.alias("model_id"),
        F.concat(F.lit("Model"), model_id.cast("string")).alias("model_name"),
        "advisor_id",
        "curr_code",
    )


def spread_weights(raw: DataFrame, max_group: int | None = None) -> DataFrame:
    """Integer sizes to weights that sum to one: every asset gets its share
    rounded down to six digits, the last asset of a model takes the remainder.

    ``max_group`` is the caller's bound on assets per model. Without one the
    sums are aggregated and joined back, so a huge model is never one task.
    """
    if max_group is not None and max_group <= SMALL_GROUP:
        model = Window.partitionBy("model_id").orderBy("asset_id")
        whole = model.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ahead = model.rowsBetween(Window.unboundedPreceding, -1)
        shares = raw.select(
            "*",
            F.sum("size").over(whole).alias("_total"),
            (F.max("asset_id").over(whole) == F.col("asset_id")).alias("_is_last"),
        ).withColumn("_share", F.expr(f"size * {MICROS_PER_UNIT} div _total"))
        rest = MICROS_PER_UNIT - F.coalesce(F.sum("_share").over(ahead), F.lit(0))
    else:
        totals = raw.groupBy("model_id").agg(
            F.sum("size").alias("_total"), F.max("asset_id").alias("_last")
        )
        shares = (
            raw.join(totals, "model_id")
            .withColumn("_share", F.expr(f"size * {MICROS_PER_UNIT} div _total"))
            .withColumn("_is_last", F.col("asset_id") == F.col("_last"))
        )
        others = (
            shares.filter(~F.col("_is_last"))
            .groupBy("model_id")
            .agg(F.sum("_share").alias("_others"))
        )
        shares = shares.join(others, "model_id", "left")
        rest = MICROS_PER_UNIT - F.coalesce(F.col("_others"), F.lit(0))
    share = F.when(F.col("_is_last"), rest).otherwise(F.col("_share"))
    return shares.select(
        "model_id",
        "asset_id",
        "exch_code",
        "curr_code",
        (share.cast("decimal(20,0)") / MICROS_PER_UNIT).cast(WEIGHT).alias("weighting"),
    )


def listing_counts(listing: DataFrame) -> DataFrame:
    """Listings per exchange."""
    return listing.groupBy("exch_code").agg(F.count("*").alias("list_count"))


def model_asset_counts(model_asset: DataFrame) -> DataFrame:
    """Assets per model."""
    return model_asset.groupBy("model_id").agg(F.count("*").alias("assets_count"))


ISIN_DIGITS = 10


def isin_code(prefix: Column, asset_id: Column) -> Column:
    """Prefix plus the id padded with zeros. A longer id keeps all its digits,
    so codes stay unique."""
    digits = asset_id.cast("string")
    width = F.greatest(F.lit(ISIN_DIGITS), F.length(digits))
    return F.concat(prefix, F.lpad(digits, width, F.lit("0")))


def name_assets(asset: DataFrame, exchange: DataFrame) -> DataFrame:
    """ISIN and display name of each asset (``asset_id, class_code, exch_code``)."""
    prefixes = exchange.select("exch_code", "isin_prefix")
    return asset.join(prefixes, "exch_code").select(
        "asset_id",
        isin_code(F.col("isin_prefix"), F.col("asset_id")).alias("isin_code"),
        F.concat_ws(
            "_",
            "class_code",
            F.col("asset_id").cast("string"),
            isin_code(F.col("isin_prefix"), F.col("asset_id")),
        ).alias("asset_name"),
    )


def cohort_ranges(account: DataFrame, workers: int = 60) -> DataFrame:
    """Split each fund's numbered accounts into contiguous ranges, one per worker.

    Worker ``t`` serves fund ``t % funds + 1``, so fund ids are expected dense
    from 1. The ranges cover a fund exactly where ``funds`` divides ``workers``.
    """
    counts = account.groupBy("fund_id").agg(F.count("*").alias("accnts_count"))
    funds = counts.agg(F.count("*")).scalar()
    threads = numbers(account.sparkSession, workers).select(
        F.col("n").alias("thread_id"),
        F.lit(workers).cast("bigint").alias("max_thread_id"),
        funds.alias("no_of_funds"),
    )
    placed = (
        threads.withColumn("thread_mod", F.expr("thread_id % no_of_funds + 1"))
        .withColumn("fund_id", F.col("thread_mod"))
        .withColumn("base", F.expr("max_thread_id div no_of_funds"))
        .withColumn(
            "threads_per_fund",
            F.when(
                (F.col("thread_mod") != 0)
                & (
                    F.col("base") * F.col("no_of_funds") + F.col("thread_mod")
                    <= F.col("max_thread_id")
                ),
                F.col("base") + 1,
            ).otherwise(F.col("base")),
        )
        .withColumn("nth_thread", F.expr("(thread_id - 1) div no_of_funds + 1"))
    )
    return (
        placed.join(counts, "fund_id")
        .withColumn("accnts_per_thread", F.expr("accnts_count div nullif(threads_per_fund, 0)"))
        .withColumn(
            "queue_no_from", (F.col("nth_thread") - 1) * F.col("accnts_per_thread") + 1
        )
        .withColumn(
            "queue_no_to",
            F.when(
                F.col("thread_id") + F.col("no_of_funds") > F.col("max_thread_id"),
                F.col("accnts_count"),
            ).otherwise(F.col("queue_no_from") + F.col("accnts_per_thread") - 1),
        )
        .select(
            "thread_id",
            "max_thread_id",
            "fund_id",
            "no_of_funds",
            "thread_mod",
            "threads_per_fund",
            "nth_thread",
            "accnts_count",
            "accnts_per_thread",
            "queue_no_from",
            "queue_no_to",
            F.col("queue_no_from").alias("next_queue_no"),
        )
    )
