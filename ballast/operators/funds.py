"""Fund rebalances: which are open, how far they are, and closing them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballast.functions.money import amount, or_zero
from ballast.functions.numbering import continue_after, number_by_id

# Fixed value: the end time of a rebalance that is still open.
OPEN_END = "1900-01-01 00:00:00"


def is_open(end: Column) -> Column:
    return end == F.lit(OPEN_END).cast("timestamp_ntz")


def open_rebalances(rebal_fund: DataFrame) -> DataFrame:
    """The open rebalance of each fund."""
    return rebal_fund.filter(is_open(F.col("end_dt")))


def running_rebalances(rebal_fund: DataFrame, gate: DataFrame | None = None) -> DataFrame:
    """Open rebalances whose currency gate is open: ``rebal_id, fund_id``.

    Closed currencies are taken off with a flag per currency, so that a size hint
    on the rebalances still reaches the join above.
    """
    running = open_rebalances(rebal_fund)
    if gate is not None:
        # Currency codes have three letters, so this list is short by nature.
        opened = gate.filter(F.col("gate_status") == 1).agg(F.collect_set("curr_code")).scalar()
        running = running.filter(F.array_contains(opened, F.col("curr_code")))
    return running.select("rebal_id", "fund_id")


def accounts_due(
    balance: DataFrame, running: DataFrame, processed: DataFrame | None = None
) -> DataFrame:
    """Accounts to rebalance: their fund has a running rebalance (see
    :func:`running_rebalances`) that has not handled them yet."""
    due = balance.join(running, "fund_id").select(
        "rebal_id",
        "accnt_id",
        "fund_id",
        "curr_code",
        "model_id",
        or_zero(F.col("inv_balance")).alias("inv_balance"),
        or_zero(F.col("cash_balance")).alias("cash_balance"),
    )
    if processed is not None:
        done = processed.select("rebal_id", "accnt_id")
        due = due.join(done, ["rebal_id", "accnt_id"], "left_anti")
    return due


def rebalance_progress(
    account: DataFrame,
    rebal_fund: DataFrame,
    processed: DataFrame,
    rejected: DataFrame | None = None,
) -> DataFrame:
    """Done and remaining accounts of every open rebalance.

    An account is done if it was processed, or rejected: one that cannot be
    rebalanced does not hold its fund back. A fund without accounts is not complete.
    """
    running = open_rebalances(rebal_fund).select("rebal_id", "fund_id")
    settled = processed.select("rebal_id", "accnt_id")
    if rejected is not None:
        settled = settled.unionByName(rejected.select("rebal_id", "accnt_id"))
    # Of the whole history only the open rebalances matter.
    settled = settled.join(running.select("rebal_id"), "rebal_id", "left_semi")
    settled = settled.distinct().withColumn("settled", F.lit(1))
    counts = (
        account.select("accnt_id", "fund_id")
        .join(running, "fund_id")
        .join(settled, ["rebal_id", "accnt_id"], "left")
        .groupBy("rebal_id")
        .agg(F.count("*").alias("accounts"), F.count("settled").alias("done"))
    )
    done = F.coalesce(F.col("done"), F.lit(0)).cast("bigint")
    remaining = (F.coalesce(F.col("accounts"), F.lit(0)) - done).cast("bigint")
    return running.join(counts, "rebal_id", "left").select(
        "rebal_id",
        "fund_id",
        done.alias("done"),
        remaining.alias("remaining"),
        F.coalesce((F.col("accounts") == F.col("done")).cast("bigint"), F.lit(0).cast("bigint")).alias(
            "complete"
        ),
    )


def fund_totals(balance: DataFrame) -> DataFrame:
    """Invested value plus cash per fund; partial sums keep a big fund cheap."""
    worth = or_zero(F.col("inv_balance")) + or_zero(F.col("cash_balance"))
    return balance.groupBy("fund_id").agg(amount(F.sum(worth)).alias("balance"))


def next_rebal_id(rebal_id: Column) -> Column:
    """The id that follows ``<fund>-<n>``: deterministic, so reruns agree."""
    head = F.regexp_extract(rebal_id, r"^(.*)-(\d+)$", 1)
    count = F.regexp_extract(rebal_id, r"^(.*)-(\d+)$", 2).cast("bigint")
    return F.concat(head, F.lit("-"), (count + 1).cast("string"))


def finished(progress: DataFrame, rebal_fund: DataFrame) -> DataFrame:
    """Header rows of the rebalances that have no account left."""
    done = progress.filter(F.col("complete") == 1).select("rebal_id")
    return open_rebalances(rebal_fund).join(done, "rebal_id", "left_semi")


def roll_rebalances(rebal_fund: DataFrame, closing: DataFrame, as_of: str) -> DataFrame:
    """All header rows after stamping the closing ones and opening their successors."""
    now = F.lit(as_of).cast("timestamp_ntz")
    closed_ids = closing.select("rebal_id", F.lit(True).alias("closing"))
    stamped = rebal_fund.join(closed_ids, "rebal_id", "left").select(
        "rebal_id",
        "fund_id",
        "curr_code",
        "accnts_count",
        "start_dt",
        F.when(F.col("closing"), now).otherwise(F.col("end_dt")).alias("end_dt"),
    )
    opened = closing.select(
        next_rebal_id(F.col("rebal_id")).alias("rebal_id"),
        "fund_id",
        "curr_code",
        F.lit(-1).cast("bigint").alias("accnts_count"),
        now.alias("start_dt"),
        F.lit(OPEN_END).cast("timestamp_ntz").alias("end_dt"),
    )
    return stamped.unionByName(opened)


def fund_balance_history(
    balance: DataFrame, closing: DataFrame, as_of: str, earlier: DataFrame | None = None
) -> DataFrame:
    """Log row per closing rebalance with the fund's total; ids go on from the
    earlier log in fund order."""
    closing = closing.select("fund_id", "rebal_id", "curr_code")
    rows = number_by_id(fund_totals(balance).join(closing, "fund_id"), "fund_id", "number")
    return rows.select(
        (F.col("number") + continue_after(earlier, "id")).alias("id"),
        "fund_id",
        "rebal_id",
        "curr_code",
        F.lit(as_of).cast("timestamp_ntz").alias("log_dt"),
        "balance",
    )


def count_closes(fund_balance: DataFrame, closing: DataFrame) -> DataFrame:
    """The fund counter goes up by one per close; it holds no money."""
    closes = closing.groupBy("fund_id").agg(F.count("*").alias("closes"))
    counted = F.col("balance") + F.coalesce(F.col("closes"), F.lit(0))
    return fund_balance.join(closes, "fund_id", "left").select(
        "fund_id", "curr_code", amount(counted).alias("balance")
    )
