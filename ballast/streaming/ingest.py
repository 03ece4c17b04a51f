"""Structured Streaming forms of the cash and price operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ballast.functions.sizing import staged
from ballast.functions.tickfold import LISTING, fold_arrivals
from ballast.operators import cash, prices
from ballast.schemas import TABLES


# Input of one micro-batch, so that the ticks of even the busiest listing within
# it fit a task.
BATCH_BYTES = 256 * 1024 * 1024


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files arriving in a folder, as a stream of bounded micro-batches."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", BATCH_BYTES)
    return reader.parquet(folder)


def _append(rows: DataFrame, folder: str, checkpoint: str) -> None:
    """Append what has arrived to a parquet folder, exactly once, then stop."""
    (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _append_once(rows: DataFrame, folder: str, checkpoint: str, stored: DataFrame | None) -> None:
    """Append each transaction once, then stop.

    The ids seen are not streaming state, which would grow for ever: a micro-batch is
    compared with the stored rows of its own months, which partition the folder. A copy
    carries the date of the transaction it repeats, so however late it comes, its original
    lies in the same month. Each micro-batch has a folder of its own and is written over
    if it is repeated. ``stored`` holds rows from before the stream began.
    """
    spark = rows.sparkSession
    columns = rows.columns
    month = F.date_format("queued_dt", "yyyy-MM")

    def write(batch: DataFrame, number: int) -> None:
        fresh = staged(cash.first_per_transaction(batch).withColumn("queued_month", month), "arrived")
        first, last = fresh.agg(F.min("queued_month"), F.max("queued_month")).first()
        if first is None:
            return
        known = _read_months(spark, folder, batch.select(columns).schema).filter(
            F.col("queued_month").between(first, last) & (F.col("batch") != number)
        )
        fresh = fresh.join(known.select("queued_month", "tran_id"), ["queued_month", "tran_id"], "left_anti")
        if stored is not None:
            fresh = fresh.join(stored.select("tran_id"), "tran_id", "left_anti")
        fresh.select(*columns, "queued_month").write.mode("overwrite").partitionBy("queued_month").parquet(
            f"{folder}/batch={number}"
        )

    (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _read_months(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """What is stored, with its partitions; empty before the first batch."""
    whole = T.StructType([*schema.fields, T.StructField("batch", T.LongType()), T.StructField("queued_month", T.StringType())])
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    if not there:
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).option("basePath", folder).parquet(folder)


def stream_deposits(
    requests: DataFrame, out_dir: str, checkpoint: str, stored: DataFrame | None = None
) -> DataFrame:
    """Deposits into the queue."""
    rows = cash.as_deposits(requests).select(cash.QUEUE)
    folder = f"{out_dir}/transact_queue"
    _append_once(rows, folder, checkpoint, stored)
    return _read_months(requests.sparkSession, folder, TABLES["transact_queue"]).select(cash.QUEUE)


def stream_withdrawals(
    requests: DataFrame, out_dir: str, checkpoint: str, stored: DataFrame | None = None
) -> DataFrame:
    """Withdrawals into the ledger, attached to no rebalance."""
    rows = cash.as_withdrawals(requests).select(cash.LEDGER)
    folder = f"{out_dir}/transact"
    _append_once(rows, folder, checkpoint, stored)
    return _read_months(requests.sparkSession, folder, TABLES["transact"]).select(cash.LEDGER)


def stream_prices(
    ticks: DataFrame,
    listing_price: DataFrame,
    out_dir: str,
    checkpoint: str,
    gate_closed: DataFrame | None = None,
) -> prices.PriceUpdate:
    """Ticks into the price log; returns the latest prices, the log and the ticks set
    aside: those of unknown listings, and those whose price does not fit. All of a
    micro-batch's ticks go to one stored log, so that neither part can be lost alone.

    The current price of a listing is kept as streaming state, so a micro-batch
    costs its own ticks only. Ticks are ordered by time and id within a batch; one
    that comes in a later batch is applied on arrival.
    """
    spark = ticks.sparkSession
    if gate_closed is not None:
        ticks = prices.gate_ticks(ticks, gate_closed)
    folded = (
        prices.priced_ticks(listing_price, ticks, "left")
        .groupBy(*LISTING)
        .applyInPandasWithState(
            fold_arrivals,
            outputStructType=f"{prices.FOLDED}, step bigint",
            stateStructType="price string, step bigint",
            outputMode="append",
            timeoutConf=GroupStateTimeout.NoTimeout,
        )
    )
    changes = prices.as_changes(folded, "step")
    folder = f"{out_dir}/listing_price_history"
    _append(changes, folder, checkpoint)
    log = spark.read.schema(changes.schema).parquet(folder)
    history = log.filter(F.col("price_post").isNotNull())
    aside = log.filter(F.col("price_post").isNull())
    reason = F.when(F.col("price_pre").isNull(), "unknown listing").otherwise("price out of range")
    return prices.PriceUpdate(
        prices.latest_prices(listing_price, history, ("step",)),
        history.drop("step"),
        aside.select(
            F.lit("apply_ticks").alias("operator"), F.col("id").cast("string").alias("key"), reason.alias("reason")
        ),
    )
