"""Tables of a portfolio as parquet folders.

State is never changed in place. A job reads the folders that make up the present
state and writes new ones; a table then points at its new folder (state) or at one
folder more (history).

Histories that a rebalance looks into for its own rows are partitioned by rebalance, so
that a job reads the partitions of the open ones, however long the history has become.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballast.schemas import TABLES

# Folders of each table. Plain data, so a caller can keep it as JSON.
Folders = dict[str, list[str]]

# Tables whose rows are added to; every other table is replaced as a whole.
APPENDED = {
    "trade",
    "holding_history",
    "balance_history",
    "fund_balance_history",
    "account_asset",
    "account_audit",
    "rebal_account",
    "rebal_rejected",
    "transact",
    "price_snapshot",
    "listing_price_history",
    "account_asset_archive",
    "rejects",
}

# All folders of these are partitioned by the column, so they come from write_table.
PARTITIONED = {"price_snapshot": "rebal_id", "rebal_account": "rebal_id", "rebal_rejected": "rebal_id"}

WRITERS = 4


def read_table(spark: SparkSession, folders: Folders, name: str) -> DataFrame:
    """The table in its declared schema; empty if nothing was written yet."""
    schema = TABLES[name]
    if not folders.get(name):
        return spark.createDataFrame([], schema)
    scan = spark.read.schema(schema)
    if name not in PARTITIONED:
        return scan.parquet(*folders[name])
    # Spark takes partitioned folders without a common root one by one.
    parts = [scan.parquet(path).select(schema.names) for path in folders[name]]
    return reduce(DataFrame.unionAll, parts)


def write_table(df: DataFrame, path: str, name: str) -> str:
    """Write in the declared column order and types; a value that does not fit
    fails the write, and so does a folder that exists."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name].fields]
    rows, by = df.select(columns), PARTITIONED.get(name)
    if by is None:
        rows.write.parquet(path)
    else:
        # A partition's rows come together, a large one in several tasks: few files each.
        rows.hint("rebalance", by).write.partitionBy(by).parquet(path)
    return path


def write_tables(
    tables: dict[str, DataFrame] | Iterable[tuple[str, DataFrame]],
    out_dir: str,
    folders: Folders | None = None,
) -> Folders:
    """Write every table below ``out_dir`` and return where all tables are now.

    A few writes run side by side, so the tail of one does not idle the cluster;
    tables given one by one are written while the next are still being planned.
    """
    items = tables.items() if isinstance(tables, dict) else tables
    with ThreadPoolExecutor(WRITERS) as pool:
        written = {
            name: pool.submit(write_table, df, f"{out_dir}/{name}", name) for name, df in items
        }
    return moved(folders or {}, {name: job.result() for name, job in written.items()})


def moved(folders: Folders, written: dict[str, str]) -> Folders:
    """Folders after a job: appended tables gain one, the others are replaced."""
    after = {name: list(paths) for name, paths in folders.items()}
    for name, path in written.items():
        after[name] = [*after.get(name, []), path] if name in APPENDED else [path]
    return after


def read_tables(
    spark: SparkSession, folders: Folders, names: Iterable[str]
) -> dict[str, DataFrame]:
    return {name: read_table(spark, folders, name) for name in names}
