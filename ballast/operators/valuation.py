"""What an account is worth at the frozen prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballast.functions.money import amount_or_null, zero
from ballast.operators.funds import open_rebalances

DEPOSIT, WITHDRAWAL = 1, 2


def price_snapshot(listing_price: DataFrame, rebalances: DataFrame) -> DataFrame:
    """Prices of every listing in a rebalance's currency, frozen per rebalance."""
    running = open_rebalances(rebalances).select("rebal_id", "fund_id", "curr_code")
    return listing_price.join(running, "curr_code").select(
        "rebal_id", "fund_id", "asset_id", "exch_code", "curr_code", "price"
    )


def queued_cash(queue: DataFrame) -> DataFrame:
    """Waiting deposits and withdrawals per account, summed in one pass; NULL where
    a sum is out of range, so that this account alone is set aside."""
    kind = F.col("tx_type")
    return (
        queue.filter(kind.isin(DEPOSIT, WITHDRAWAL))
        .groupBy("accnt_id")
        .agg(
            _sum_of(kind == DEPOSIT).alias("new_deposits"),
            _sum_of(kind == WITHDRAWAL).alias("new_withdrawals"),
        )
    )


def _sum_of(chosen: Column) -> Column:
    """0 without such rows, NULL where the sum is out of range."""
    total = amount_or_null(F.try_sum(F.when(chosen, F.col("amount"))))
    return F.when(F.count(F.when(chosen, F.col("amount"))) == 0, zero()).otherwise(total)


def match_holdings(holding: DataFrame, due: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Holdings of the due accounts with the snapshot price, NULL where there is
    none. One pass gives both the priced and the unpriced ones."""
    owners = due.select("accnt_id", "rebal_id", "fund_id", "model_id")
    return (
        holding.drop("fund_id")
        .join(owners, "accnt_id")
        .join(
            snapshot.drop("fund_id"), ["rebal_id", "asset_id", "exch_code", "curr_code"], "left"
        )
        .select(
            "rebal_id",
            "accnt_id",
            "asset_id",
            "exch_code",
            "curr_code",
            "fund_id",
            "model_id",
            "units",
            "price",
        )
    )


def price_holdings(matched: DataFrame) -> DataFrame:
    """Holdings that have a price; the others drop out of the valuation."""
    return matched.filter(F.col("price").isNotNull())


def unpriced_holdings(matched: DataFrame) -> DataFrame:
    """Holdings that dropped out."""
    return matched.filter(F.col("price").isNull())


def value_holdings(current: DataFrame) -> DataFrame:
    """Value and number of priced holdings per account; the value is NULL where it is
    out of range."""
    return current.groupBy("accnt_id").agg(
        amount_or_null(F.try_sum(F.col("units") * F.col("price"))).alias("current_holdings_value"),
        F.count("*").alias("current_holdings_count"),
    )


def target_balance(due: DataFrame, value: DataFrame, queued: DataFrame) -> DataFrame:
    """Holdings plus cash plus deposits less withdrawals, per due account; NULL
    where that or a part of it is out of range. What has no rows counts as zero."""
    queued = queued.withColumn("_queued", F.lit(True))
    filled = due.join(value, "accnt_id", "left").join(queued, "accnt_id", "left")
    parts = {
        "current_holdings_value": "current_holdings_count",
        "new_deposits": "_queued",
        "new_withdrawals": "_queued",
    }
    for name, mark in parts.items():
        filled = filled.withColumn(name, F.when(F.col(mark).isNull(), zero()).otherwise(F.col(name)))
    return filled.drop("_queued").withColumn(
        "current_holdings_count",
        F.coalesce(F.col("current_holdings_count"), F.lit(0)).cast("bigint"),
    ).withColumn(
        "target_invest_value",
        amount_or_null(
            F.col("current_holdings_value")
            + F.col("cash_balance")
            + F.col("new_deposits")
            - F.col("new_withdrawals")
        ),
    )
