"""Complete jobs from stored tables to stored tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballast.functions.money import zero
from ballast.functions.numbering import continue_after, number_by_pair
from ballast.operators import archive, cash, generate, prices, shaping, valuation
from ballast.operators.funds import OPEN_END
from ballast.plans.cycle import close_rebalances
from ballast.plans.rebalance import Portfolio, Rebalance
from ballast.schemas import TABLES
from ballast.sources.state import (
    Folders,
    moved,
    read_table,
    read_tables,
    write_table,
    write_tables,
)


class _Stage:
    """Writes shared frames below a job's folder. A frame that is an output goes
    to its final place at once and is not written again."""

    def __init__(self, out_dir: str):
        self.out_dir = out_dir
        self.outputs: dict[str, str] = {}

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        if label in TABLES:
            self.outputs[label] = write_table(df, f"{self.out_dir}/{label}", label)
            return read_table(df.sparkSession, {label: [self.outputs[label]]}, label)
        path = f"{self.out_dir}/_stage/{label}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def write(self, tables: Iterable[tuple[str, DataFrame]], folders: Folders) -> Folders:
        rest = ((name, df) for name, df in tables if name not in self.outputs)
        return moved(write_tables(rest, self.out_dir, folders), self.outputs)


def bootstrap(
    spark: SparkSession,
    out_dir: str,
    as_of: str,
    per_cell: int = 200,
    advisors: int = 10,
    per_pair: int = 10,
    per_fund: int = 10_000,
) -> Folders:
    """Domain rows plus generated assets, models, accounts, first deposits, the
    work list, an open rebalance per fund and its price snapshot."""
    domain = generate.domain(spark)
    currency, fund, exchange = domain["currency"], domain["fund"], domain["exchange"]
    now = F.lit(as_of).cast("timestamp_ntz")

    assets = generate.gen_assets(spark, exchange, domain["asset_class"], per_cell)
    advisor = shaping.numbers(spark, advisors).select(
        F.col("n").alias("advisor_id"),
        F.concat(F.lit("Advisor"), F.col("n").cast("string")).alias("advisor_name"),
    )
    folders = write_tables(
        {
            **{name: df for name, df in domain.items() if name != "exchange"},
            "asset": assets,
            "listing": assets,
            "listing_price": assets,
            "advisor": advisor,
            "model": generate.gen_models(advisor, currency, per_pair),
            "rebal_fund": fund.select(
                F.concat(F.lit("R"), F.col("fund_id").cast("string"), F.lit("-1")).alias("rebal_id"),
                "fund_id",
                "curr_code",
                F.lit(-1).alias("accnts_count"),
                now.alias("start_dt"),
                F.lit(OPEN_END).cast("timestamp_ntz").alias("end_dt"),
            ),
        },
        out_dir,
    )
    stored = read_tables(spark, folders, ["model", "listing", "listing_price", "rebal_fund"])
    people = generate.gen_accounts(spark, fund, stored["model"], per_fund)
    balance = people.withColumn("inv_balance", zero()).withColumn("cash_balance", zero())
    deposits = people.select(
        F.concat(F.lit("D"), F.col("accnt_id").cast("string")).alias("tran_id"),
        "accnt_id",
        "fund_id",
        "curr_code",
        F.lit(valuation.DEPOSIT).alias("tx_type"),
        F.col("deposit").alias("amount"),
        now.alias("queued_dt"),
    )
    counts = shaping.listing_counts(stored["listing"])
    return write_tables(
        {
            "exchange": exchange.join(counts, "exch_code", "left").fillna(0, ["list_count"]),
            "model_asset": generate.gen_model_assets(stored["model"], stored["listing"]),
            "investor": people,
            "account": people,
            "balance": balance,
            "transact_queue": deposits,
            "account_queue": shaping.number_accounts(people),
            "price_snapshot": valuation.price_snapshot(
                stored["listing_price"], stored["rebal_fund"]
            ),
        },
        out_dir,
        folders,
    )


def run_rebalance(
    spark: SparkSession, folders: Folders, out_dir: str, as_of: str, **options
) -> Folders:
    """Rebalance all due accounts; accounts this rebalance has done are skipped.
    Without a gate table every gate counts as open."""
    state = Portfolio(
        balance=read_table(spark, folders, "balance"),
        holding=read_table(spark, folders, "holding"),
        model_asset=read_table(spark, folders, "model_asset"),
        queue=read_table(spark, folders, "transact_queue"),
        rebal_fund=read_table(spark, folders, "rebal_fund"),
        snapshot=read_table(spark, folders, "price_snapshot"),
        gate=read_table(spark, folders, "gate") if "gate" in folders else None,
        processed=read_table(spark, folders, "rebal_account"),
        balance_history=read_table(spark, folders, "balance_history"),
        rejected=read_table(spark, folders, "rebal_rejected"),
    )
    stage = _Stage(out_dir)
    return stage.write(Rebalance(state, as_of, stage=stage, **options).outputs(), folders)


def run_close(spark: SparkSession, folders: Folders, out_dir: str, as_of: str) -> Folders:
    """Close the finished rebalances and open their successors."""
    tables = read_tables(
        spark,
        folders,
        ["account", "balance", "fund_balance", "rebal_fund", "rebal_account", "rebal_rejected"]
        + ["listing_price"],
    )
    closed = close_rebalances(
        tables["account"],
        tables["balance"],
        tables["fund_balance"],
        tables["rebal_fund"],
        tables["rebal_account"],
        tables["listing_price"],
        as_of,
        read_table(spark, folders, "fund_balance_history"),
        tables["rebal_rejected"],
    )
    return write_tables(closed.tables(), out_dir, folders)


def run_ticks(
    spark: SparkSession,
    folders: Folders,
    ticks: DataFrame,
    out_dir: str,
    gate_closed: DataFrame | None = None,
    **limits: int,
) -> Folders:
    """Apply a batch of ticks to the current prices and log every change."""
    update = prices.apply_ticks(
        read_table(spark, folders, "listing_price"),
        ticks,
        gate_closed,
        stage=_Stage(out_dir),
        **limits,
    )
    return write_tables(
        {
            "listing_price": update.latest,
            "listing_price_history": update.history,
            "rejects": update.rejects,
        },
        out_dir,
        folders,
    )


def _queued(folders: Folders, rows: DataFrame, out_dir: str) -> Folders:
    """The queue is replaced by a rebalance but added to by requests: their rows become
    one folder more, and what waits already is not written again."""
    path = write_table(rows, f"{out_dir}/transact_queue", "transact_queue")
    return {**folders, "transact_queue": [*folders.get("transact_queue", []), path]}


def run_deposits(
    spark: SparkSession, folders: Folders, requests: DataFrame, out_dir: str
) -> Folders:
    """Add deposits to the queue."""
    queue = read_table(spark, folders, "transact_queue")
    return _queued(folders, cash.new_deposits(queue, requests), out_dir)


def run_withdrawals(
    spark: SparkSession, folders: Folders, requests: DataFrame, out_dir: str, via_queue: bool = False
) -> Folders:
    """Add withdrawals to the ledger, or to the queue."""
    if via_queue:
        queue = read_table(spark, folders, "transact_queue")
        return _queued(folders, cash.new_queued_withdrawals(queue, requests), out_dir)
    ledger = read_table(spark, folders, "transact")
    return write_tables({"transact": cash.new_withdrawals(ledger, requests)}, out_dir, folders)


def run_archive(
    spark: SparkSession, folders: Folders, out_dir: str, keep: int = archive.KEEP
) -> Folders:
    """Move the older per-asset history to the archive; ids stored there already
    are left out."""
    rows = read_table(spark, folders, "account_asset_history")
    stored = read_table(spark, folders, "account_asset_archive")
    old, rest = archive.archive(rows, "history_id", keep)
    return write_tables(
        {
            "account_asset_archive": archive.append_ignore_dup(stored, old, ["history_id"]),
            "account_asset_history": rest,
        },
        out_dir,
        folders,
    )


def log_assets(spark: SparkSession, folders: Folders, source: str, out_dir: str) -> Folders:
    """Give the per-asset rows of one rebalance (folder ``source``) their history
    ids, following the highest id so far."""
    history = read_table(spark, folders, "account_asset_history")
    archived = read_table(spark, folders, "account_asset_archive")
    ids = history.select("history_id").unionByName(archived.select("history_id"))
    top = continue_after(ids, "history_id")
    rows = read_table(spark, {"account_asset": [source]}, "account_asset")
    numbered = number_by_pair(rows, "accnt_id", "asset_id", "history_id")
    added = numbered.withColumn("history_id", F.col("history_id") + top)
    path = write_table(added, f"{out_dir}/account_asset_history", "account_asset_history")
    return {**folders, "account_asset_history": [*folders.get("account_asset_history", []), path]}
