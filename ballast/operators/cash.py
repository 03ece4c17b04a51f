"""Deposits, withdrawals and settling the queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballast.functions.money import amount
from ballast.operators.valuation import DEPOSIT, WITHDRAWAL

QUEUE = ["tran_id", "accnt_id", "fund_id", "curr_code", "tx_type", "amount", "queued_dt"]
LEDGER = [*QUEUE, "rebal_id", "processed_dt"]


def _typed(requests: DataFrame, kind: int) -> DataFrame:
    return requests.select(
        "tran_id",
        "accnt_id",
        "fund_id",
        "curr_code",
        F.lit(kind).cast("bigint").alias("tx_type"),
        amount(F.col("amount")).alias("amount"),
        "queued_dt",
    )


def as_deposits(requests: DataFrame) -> DataFrame:
    """Requests as queue rows."""
    return _typed(requests, DEPOSIT)


def as_withdrawals(requests: DataFrame, processed_dt: str | None = None) -> DataFrame:
    """Requests as ledger rows: processed at once and attached to no rebalance."""
    stamp = F.lit(processed_dt).cast("timestamp_ntz") if processed_dt else F.col("queued_dt")
    return _typed(requests, WITHDRAWAL).select(
        *QUEUE, F.lit(None).cast("string").alias("rebal_id"), stamp.alias("processed_dt")
    )


def first_per_transaction(rows: DataFrame) -> DataFrame:
    """One row per ``tran_id``; of unequal copies the smallest wins, so that
    reruns agree."""
    rest = [name for name in rows.columns if name != "tran_id"]
    picked = rows.groupBy("tran_id").agg(F.min(F.struct(*rest)).alias("row"))
    return picked.select("tran_id", *[F.col(f"row.{name}").alias(name) for name in rest])


def _new(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per id, and no id that is stored already."""
    fresh = first_per_transaction(rows)
    return fresh.join(stored.select("tran_id"), "tran_id", "left_anti").select(rows.columns)


def new_deposits(queue: DataFrame, requests: DataFrame) -> DataFrame:
    """Queue rows to append."""
    return _new(queue, as_deposits(requests))


def enqueue_deposits(queue: DataFrame, requests: DataFrame) -> DataFrame:
    """The queue with the new deposits."""
    return queue.select(QUEUE).unionByName(new_deposits(queue, requests))


def new_queued_withdrawals(queue: DataFrame, requests: DataFrame) -> DataFrame:
    """Queue rows to append, which count in the next rebalance."""
    return _new(queue, _typed(requests, WITHDRAWAL))


def new_withdrawals(
    ledger: DataFrame, requests: DataFrame, processed_dt: str | None = None
) -> DataFrame:
    """Ledger rows to append."""
    return _new(ledger, as_withdrawals(requests, processed_dt))


def record_withdrawals(
    target: DataFrame, requests: DataFrame, processed_dt: str | None = None, via_queue: bool = False
) -> DataFrame:
    """Withdrawals go straight to the ledger, so they never reduce a target. With
    ``via_queue`` the target is the queue and they count in the next rebalance."""
    if via_queue:
        return target.select(QUEUE).unionByName(new_queued_withdrawals(target, requests))
    return target.select(LEDGER).unionByName(new_withdrawals(target, requests, processed_dt))


def settle_queue(queue: DataFrame, done: DataFrame, as_of: str) -> DataFrame:
    """Ledger rows of the done accounts, stamped with fund and rebalance."""
    owners = done.select("accnt_id", F.col("fund_id").alias("owner_fund"), "rebal_id")
    return (
        queue.filter(F.col("tx_type").isin(DEPOSIT, WITHDRAWAL))
        .join(owners, "accnt_id")
        .select(
            "tran_id",
            "accnt_id",
            F.col("owner_fund").alias("fund_id"),
            "curr_code",
            "tx_type",
            "amount",
            "queued_dt",
            "rebal_id",
            F.lit(as_of).cast("timestamp_ntz").alias("processed_dt"),
        )
    )


def queue_remaining(queue: DataFrame, done: DataFrame) -> DataFrame:
    """What stays queued: other accounts' rows, and types a rebalance ignores."""
    gone = done.select("accnt_id", F.lit(True).alias("settled"))
    ignored = ~F.coalesce(F.col("tx_type").isin(DEPOSIT, WITHDRAWAL), F.lit(False))
    return (
        queue.join(gone, "accnt_id", "left")
        .filter(F.col("settled").isNull() | ignored)
        .select(QUEUE)
    )
