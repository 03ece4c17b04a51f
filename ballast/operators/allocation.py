"""From a target value to whole units that the account can afford.

The trim takes single units off the cheapest asset until the rounded plan is
affordable. Because it stays with one asset until that is used up, the number
taken from each asset follows from a running sum in (price, asset) order; no
loop is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ballast.functions.money import amount, amount_or_null, micros, or_zero, share_units
from ballast.functions.sizing import MAX_BROADCAST_ROWS, cut_lineage

# Largest model that one window partition handles; bigger ones are cut up.
WINDOW_ROWS = 100_000

# What the rows of an account carry.
_SPREAD = ["rebal_id", "accnt_id", "fund_id", "curr_code", "model_id", "target_invest_value"]

_HELPERS = [
    "_cost",
    "_plan",
    "_trim_price",
    "_first_price",
    "_before",
    "_rows_before",
    "_one_is_enough",
    "_left",
    "_price_micros",
    "planned_cost",
]


def price_models(
    model_asset: DataFrame, snapshot: DataFrame, window_rows: int = WINDOW_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Model assets at the snapshot price, and what they allow per model.

    The first frame has a row per rebalance, model and asset; the second, per
    rebalance and model, the figures :func:`judge` needs. Counting the models
    settles two things: a small result is hinted for broadcast, any other for a shuffle
    of both sides, as accounts are spread over these rows; and if some model
    has more than ``window_rows`` assets, the rows get a ``chunk``, contiguous
    ranges of (price, asset) order of about that size, so that
    :func:`trim_to_budget` never orders a big model in one task.
    """
    priced = model_asset.join(
        snapshot.drop("fund_id"), ["asset_id", "exch_code", "curr_code"]
    ).select("rebal_id", "model_id", "asset_id", "exch_code", "weighting", "price")
    ratio = F.abs(F.try_divide(F.col("weighting"), F.col("price")))
    limits = priced.groupBy("rebal_id", "model_id").agg(
        F.count("*").alias("assets"),
        F.min(F.abs("price")).alias("lowest_price"),
        F.max_by(F.struct("weighting", "price"), ratio).alias("steepest"),
        F.sum(F.abs("weighting")).alias("weights"),
        F.sum(F.abs("price")).alias("prices"),
    )
    biggest, total = limits.agg(
        F.coalesce(F.max("assets"), F.lit(0)), F.coalesce(F.sum("assets"), F.lit(0))
    ).first()
    if biggest > window_rows:
        pieces = max(2, -(-total // window_rows))
        ranged = priced.repartitionByRange(pieces, "rebal_id", "model_id", "price", "asset_id")
        priced = cut_lineage(ranged.withColumn("chunk", F.spark_partition_id()))
    if total <= MAX_BROADCAST_ROWS:
        return F.broadcast(priced), F.broadcast(limits)
    return priced.hint("merge"), limits


def judge(target: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds ``sound``: whether every figure of the account's plan can be stored.

    False where the target is out of range, an asset of the model costs nothing,
    the largest number of units does not fit, or the whole plan, rounded up,
    would not. Decided per account, before its assets are spread out.
    """
    size = F.abs(F.col("target_invest_value"))
    most = share_units(size, F.col("steepest.weighting"), F.col("steepest.price"))
    whole = amount_or_null(size * F.col("weights") + F.col("prices"))
    fits = (F.col("lowest_price") > 0) & most.isNotNull() & whole.isNotNull()
    return (
        target.join(limits, ["rebal_id", "model_id"], "left")
        .withColumn("sound", size.isNotNull() & (F.col("assets").isNull() | fits))
        .drop("assets", "lowest_price", "steepest", "weights", "prices")
    )


def allocate(target: DataFrame, priced: DataFrame) -> DataFrame:
    """One row per account and model asset with the fractional units to hold.

    Of the account only what the rows need is spread over its assets; the other
    figures are joined back per account by :func:`new_balances`.
    """
    spread = target.select(*_SPREAD)
    return spread.join(priced, ["rebal_id", "model_id"]).withColumn(
        "units_target",
        share_units(F.col("target_invest_value"), F.col("weighting"), F.col("price")),
    )


def round_units(allocated: DataFrame) -> DataFrame:
    """Whole units, half away from zero; the value keeps the fractional units."""
    return allocated.withColumn(
        "units_rounded", amount_or_null(F.round(F.col("units_target"), 0))
    ).withColumn("value_target", F.col("units_target") * F.col("price"))


def _planned(trigger: str) -> Column:
    """A row's part of the value that decides whether the trim runs."""
    if trigger == "unrounded":
        return F.when(F.col("units_rounded") > 0, F.col("value_target"))
    if trigger == "rounded":
        return F.when(F.col("units_rounded") >= 1, F.col("units_rounded") * F.col("price"))
    raise ValueError(f"unknown trigger {trigger!r}")


def _with_running_sums(rows: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Account totals plus ``_before`` / ``_rows_before``: cost and number of the
    trimmable rows ahead of this one. One sort within the account; no exchange
    if the rows already sit on ``accnt_id``."""
    ordered = Window.partitionBy("accnt_id").orderBy("price", "asset_id")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ahead = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(
        "*",
        *[expr.over(whole).alias(name) for name, expr in totals.items()],
        F.sum("_cost").over(ahead).alias("_before"),
        F.count("_cost").over(ahead).alias("_rows_before"),
    )


def _with_running_sums_chunked(rows: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """The same for models cut into chunks: sums per (account, chunk) first, then
    over the few chunks of an account, then inside each chunk."""
    partial = {
        "_plan_sum": F.sum("_plan"),
        "_cost_sum": F.sum("_cost"),
        "_cost_rows": F.count("_cost"),
        "_lowest": F.min("_trim_price"),
    }
    chunks = rows.groupBy("accnt_id", "chunk").agg(
        *[expr.alias(name) for name, expr in partial.items()]
    )
    by_chunk = Window.partitionBy("accnt_id").orderBy("chunk")
    whole = by_chunk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ahead = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    context = chunks.select(
        "accnt_id",
        "chunk",
        F.sum("_plan_sum").over(whole).alias("planned_cost"),
        F.sum("_cost_sum").over(whole).alias("rounded_cost"),
        F.min("_lowest").over(whole).alias("_first_price"),
        F.sum("_cost_sum").over(ahead).alias("_chunks_before"),
        F.sum("_cost_rows").over(ahead).alias("_chunk_rows_before"),
    )
    inside = Window.partitionBy("accnt_id", "chunk").orderBy("price", "asset_id")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.join(context, ["accnt_id", "chunk"])
        .withColumn(
            "_before",
            F.coalesce(F.sum("_cost").over(before), F.lit(0))
            + F.coalesce(F.col("_chunks_before"), F.lit(0)),
        )
        .withColumn(
            "_rows_before",
            F.count("_cost").over(before) + F.coalesce(F.col("_chunk_rows_before"), F.lit(0)),
        )
        .drop("_chunks_before", "_chunk_rows_before")
    )


def trim_to_budget(rounded: DataFrame, trigger: str = "unrounded") -> DataFrame:
    """Units the account can afford, plus its rounded plan value.

    Adds ``units_adjusted`` and, where the trim looked, ``units_taken`` per row;
    and per account what the plan costs (``planned_value``, ``rounded_cost``) and
    whether it ``trims``.

    * The trim runs where the planned value exceeds the target.
    * It always takes at least one unit, and goes on while the plan is too dear.
    * An asset that would end at zero gets its rounded units back.
    """
    rows = (
        rounded.withColumn(
            "_cost",
            F.when(F.col("units_rounded") >= 1, F.col("units_rounded") * F.col("price")),
        )
        .withColumn("_plan", _planned(trigger))
        .withColumn("_trim_price", F.when(F.col("units_rounded") >= 1, F.col("price")))
    )
    totals = {
        "planned_cost": F.sum("_plan"),
        "rounded_cost": F.sum("_cost"),
        "_first_price": F.min("_trim_price"),
    }
    summed = (
        _with_running_sums_chunked(rows, totals)
        if "chunk" in rounded.columns
        else _with_running_sums(rows, totals)
    )

    target = F.col("target_invest_value")
    price, units, cost = F.col("price"), F.col("units_rounded"), F.col("_cost")
    first = F.col("_rows_before") == 0
    excess = F.col("rounded_cost") - target
    left = excess - or_zero(F.col("_before"))
    # Whole units that cover what is left, never more than the row has. Both
    # sides are millionths, so the ceiling is exact.
    needed = F.expr("(_left + _price_micros - 1) div _price_micros").cast("decimal(20,0)")
    taken = (
        F.when(F.col("_one_is_enough"), F.when(first, F.lit(1)).otherwise(F.lit(0)))
        .when(~first & (F.col("_left") <= 0), F.lit(0))
        .when((price < 0) | (F.col("_left") >= micros(cost)), units)
        .otherwise(needed)
    )
    touched = F.col("trims") & cost.isNotNull()
    return (
        summed.withColumn("planned_value", or_zero(amount_or_null(F.col("planned_cost"))))
        .withColumn("trims", (F.col("planned_value") > target) & F.col("rounded_cost").isNotNull())
        .withColumn("_one_is_enough", F.col("trims") & (excess <= F.col("_first_price")))
        .withColumn("_left", F.when(touched, micros(left)))
        .withColumn("_price_micros", F.when(touched, micros(price)))
        .withColumn("units_taken", F.when(touched, amount(taken)))
        .withColumn(
            "units_adjusted",
            F.when(touched & (F.col("units_taken") < units), amount(units - F.col("units_taken")))
            .otherwise(units),
        )
        .drop(*_HELPERS)
    )


def cheapest(rounded: DataFrame) -> DataFrame:
    """The asset the trim would take from first, per account."""
    pick = F.min(F.struct("price", "asset_id"))
    return (
        rounded.filter(F.col("units_rounded") >= 1)
        .groupBy("accnt_id")
        .agg(pick.alias("pick"))
        .select("accnt_id", "pick.asset_id", "pick.price")
    )


def new_balances(target: DataFrame, adjusted: DataFrame) -> DataFrame:
    """Every account's figures after the trim: plan value, invested value and the
    cash left, which may be negative. An account without plan keeps all as cash.

    Both sides sit on ``accnt_id`` already, so this adds no exchange.
    """
    sums = adjusted.groupBy("accnt_id").agg(
        F.first("planned_value").alias("planned_value"),
        F.first("trims").alias("trims"),
        F.first("rounded_cost").alias("rounded_cost"),
        F.sum(F.col("units_taken") * F.col("price")).alias("taken_cost"),
        F.sum(F.col("units_adjusted") * F.col("price")).alias("invested"),
    )
    affordable = amount(F.col("rounded_cost") - or_zero(F.col("taken_cost")))
    return (
        target.join(sums, "accnt_id", "left")
        .withColumn(
            "rounded_target_invest_value",
            F.when(F.col("trims"), affordable).otherwise(or_zero(F.col("planned_value"))),
        )
        .withColumn(
            "rebalanced_invest_value", amount(F.coalesce(F.col("invested"), F.lit(0)))
        )
        .withColumn(
            "rebalanced_cash_balance",
            amount(F.col("target_invest_value") - F.col("rebalanced_invest_value")),
        )
        .drop("planned_value", "trims", "rounded_cost", "taken_cost", "invested")
    )
