"""Headline timings as one JSON line.

``$BENCH_SF_DIR`` is the data directory, ``$BENCH_CPUS`` the number of cores. Each
query is run once to warm up and then timed; results go to Spark's no-op sink,
except for the two jobs, which write all their tables.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ballast.plans import catalog, jobs
from ballast.session import tune
from ballast.sources.star import StarSource
from ballast.sources.state import Folders, read_table, write_tables

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

QUERIES = [
    "price_snapshot",
    "queued_cash_by_account",
    "holdings_current",
    "holdings_value",
    "target_balance",
    "holdings_target",
    "holdings_adjusted",
    "rebalanced_balances",
    "trades",
    "holdings_replaced",
    "account_asset_audit",
    "account_audit",
    "transact_processed",
    "fund_balance_history",
    "rebalance_roll",
    "price_update_latest",
    "price_update_history",
    "price_gate_filter",
    "price_asof_snapshot",
    "account_queue",
    "model_weights",
    "pk_violations",
    "fk_violations",
]
AS_OF = "2024-02-01 00:00:00"


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def seconds(action: Callable[[], object]) -> float:
    began = time.perf_counter()
    action()
    return time.perf_counter() - began


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def stored_portfolio(spark: SparkSession, home: str) -> Folders:
    """The star schema's portfolio as stored tables."""
    src = StarSource(spark, FOLDER)
    return write_tables(
        {
            "balance": src.balance(),
            "holding": src.holding(),
            "model_asset": src.model_asset(),
            "transact_queue": src.transact_queue(),
            "rebal_fund": src.rebal_fund(),
            "price_snapshot": catalog.queries()["price_snapshot"](spark, FOLDER),
            "listing_price": src.listing_price(),
        },
        f"{home}/state",
    )


def main() -> None:
    spark = session()
    home = tempfile.mkdtemp(prefix="bench-", dir="/tmp")
    registered = catalog.queries()
    times: dict[str, float] = {}

    for name in QUERIES:
        drain(registered[name](spark, FOLDER))
        times[name] = seconds(lambda: drain(registered[name](spark, FOLDER)))

    folders = stored_portfolio(spark, home)
    for attempt in ("warm", "timed"):
        out = f"{home}/{attempt}"
        times["rebalance_all_outputs"] = seconds(
            lambda: jobs.run_rebalance(spark, folders, f"{out}/rebalance", AS_OF)
        )
        ticks = StarSource(spark, FOLDER).ticks()
        times["apply_ticks_all_outputs"] = seconds(
            lambda: jobs.run_ticks(spark, folders, ticks, f"{out}/ticks")
        )

    # The size the reference workload declares: 60,000 accounts, 300 models.
    generated = jobs.bootstrap(spark, f"{home}/generated", AS_OF)
    times["generated_60k_accounts"] = seconds(
        lambda: jobs.run_rebalance(spark, generated, f"{home}/generated_run", AS_OF)
    )

    accounts = read_table(spark, folders, "balance").count()
    events = StarSource(spark, FOLDER).raw("events").count()
    total = sum(times[name] for name in QUERIES)
    print(
        json.dumps(
            {
                "metric": "seconds for the headline queries",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {name: round(spent, 3) for name, spent in times.items()},
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "accounts_per_sec": round(accounts / times["rebalance_all_outputs"], 1),
                "ticks_per_sec": round(events / times["apply_ticks_all_outputs"], 1),
                "generated_accounts_per_sec": round(60_000 / times["generated_60k_accounts"], 1),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
