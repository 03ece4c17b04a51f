"""Deterministic workload data, of any size, as Spark jobs.

Random draws are integer hashes of the row's own id, so a rerun or a lost
executor gives the same rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ballast.functions.money import WEIGHT, amount
from ballast.functions.numbering import number_by_id
from ballast.functions.sizing import sized_broadcast, sized_lookup
from ballast.operators.shaping import isin_code, model_grid, number_listings
from ballast.schemas import TABLES

# Modulus, multipliers and increments of the hash; share of its
# low digits that is dropped.
MODULUS = 2147483648
FIRST, SECOND = (1103515245, 12345), (69069, 362437)
DROPPED = 1024

MIN_ASSETS, MAX_ASSETS = 5, 20


# The domain rows of the workload.
CURRENCIES = [
    ("GBP", "Great British Pound"),
    ("USD", "United States Dollar"),
    ("AUD", "Australian Dollar"),
]
FUNDS = [
    (1, "Fund 1 UK Members", "GBP"),
    (2, "Fund 2 US Members", "USD"),
    (3, "Fund 3 AU Members", "AUD"),
    (4, "Fund 4 GBP Growth", "GBP"),
    (5, "Fund 5 USD Growth", "USD"),
    (6, "Fund 6 AUD Growth", "AUD"),
]
EXCHANGES = [
    ("FTSE", "Financial Times Stock Exchange", "UK", "GBP"),
    ("NYSE", "New York Stock Exchange", "US", "USD"),
    ("ASX", "Australian Securities Exchange", "AU", "AUD"),
]
CLASSES = [("ST", "Stock"), ("BO", "Bonds"), ("CO", "Commodities"), ("PR", "Property")]
TRADE_TYPES = [(1, "Buy"), (2, "Sell")]
TRANSACT_TYPES = [(1, "Deposit"), (2, "Withdrawal")]


def domain(spark: SparkSession) -> dict[str, DataFrame]:
    """Reference tables with fixed rows; listing counts of exchanges come later."""

    def rows(name: str, values: list[tuple]) -> DataFrame:
        return spark.createDataFrame(values, TABLES[name])

    exchange = T.StructType([f for f in TABLES["exchange"].fields if f.name != "list_count"])
    return {
        "currency": rows("currency", CURRENCIES),
        "gate": rows("gate", [(code, 1) for code, _ in CURRENCIES]),
        "fund": rows("fund", FUNDS),
        "fund_balance": rows(
            "fund_balance", [(fund, code, Decimal(0)) for fund, _, code in FUNDS]
        ),
        "exchange": spark.createDataFrame(EXCHANGES, exchange),
        "asset_class": rows("asset_class", CLASSES),
        "trade_type": rows("trade_type", TRADE_TYPES),
        "transact_type": rows("transact_type", TRANSACT_TYPES),
    }


def draw(key: Column, salt: int) -> Column:
    """A non-negative pseudo-random integer per key."""
    value = (key % MODULUS + salt) % MODULUS
    for factor, increment in (FIRST, SECOND):
        value = (value * factor + increment) % MODULUS
    return F.floor(value / DROPPED).cast("bigint")


def wide_draw(key: Column, high: int, low: int) -> Column:
    """As ``draw``, of twice as many bits, for picks among very many."""
    return draw(key, high) * F.lit(MODULUS // DROPPED) + draw(key, low)


def _positions(df: DataFrame, key: str, out: str) -> DataFrame:
    """Rows of a small reference table numbered from 0 by their code."""
    codes = df.agg(F.array_sort(F.collect_set(key)).alias("codes"))
    return codes.select(F.posexplode("codes")).select(
        F.col("pos").cast("bigint").alias(out), F.col("col").alias(key)
    )


def gen_assets(
    spark: SparkSession, exchange: DataFrame, asset_class: DataFrame, per_cell: int = 200
) -> DataFrame:
    """Assets, listings and opening prices: ``per_cell`` per exchange and class,
    ids dense over exchanges then classes, list numbers restarting per exchange."""
    exchanges = _positions(exchange, "exch_code", "exch_no").join(exchange, "exch_code")
    classes = _positions(asset_class, "class_code", "class_no")
    n_exchanges, n_classes = exchange.count(), classes.count()
    per_exchange = n_classes * per_cell
    number = F.col("id")
    rows = spark.range(n_exchanges * per_exchange).select(
        (number + 1).alias("asset_id"),
        F.expr(f"id div {max(per_exchange, 1)}").alias("exch_no"),
        F.expr(f"id % {max(per_exchange, 1)} div {max(per_cell, 1)}").alias("class_no"),
        (number % max(per_exchange, 1) + 1).alias("list_no"),
    )
    isin = isin_code(F.col("isin_prefix"), F.col("asset_id"))
    price = F.expr("(draw % 8 + 1) div 2 + 1")
    return (
        rows.join(sized_broadcast(exchanges), "exch_no")
        .join(sized_broadcast(classes), "class_no")
        .withColumn("draw", draw(F.col("asset_id"), 1))
        .select(
            "asset_id",
            "exch_code",
            "curr_code",
            "class_code",
            "list_no",
            isin.alias("isin_code"),
            F.concat_ws("_", "class_code", F.col("asset_id").cast("string"), isin).alias("asset_name"),
            amount(price).alias("price"),
        )
    )


def gen_models(advisor: DataFrame, currency: DataFrame, per_pair: int = 10) -> DataFrame:
    """Models per advisor and currency with a number of assets between 5 and 20."""
    span = MAX_ASSETS - MIN_ASSETS + 1
    return model_grid(advisor, currency, per_pair).withColumn(
        "assets_count", (draw(F.col("model_id"), 2) % span + MIN_ASSETS).cast("int")
    )


def gen_model_assets(model: DataFrame, listing: DataFrame) -> DataFrame:
    """Distinct listings of the model's currency with weights that sum to one.

    Positions are ``start + j * stride`` within the currency's numbered listings;
    a stride of at most a twentieth of them keeps up to twenty picks distinct, so
    no pair of model and listing is formed that is not picked. Weights break a
    stick of 100 percent: at least one percent each, the last takes the rest.

    Models are dealt out before each becomes up to twenty rows; they come from one row per
    advisor, and so from few tasks.
    """
    tasks = int(model.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = number_listings(listing.select("asset_id", "exch_code", "curr_code"))
    listed = placed.groupBy("curr_code").agg(F.max("position").alias("listed"))
    sized = (
        model.repartition(tasks, "model_id")
        .join(F.broadcast(listed), "curr_code")
        .withColumn("n", F.least(F.col("assets_count").cast("bigint"), F.col("listed")))
        .withColumn("start", wide_draw(F.col("model_id"), 3, 8) % F.col("listed"))
        .withColumn(
            "stride",
            wide_draw(F.col("model_id"), 4, 9)
            % F.greatest(F.expr(f"listed div {MAX_ASSETS}"), F.lit(1))
            + 1,
        )
    )

    def broken(left: Column, j: Column) -> Column:
        """Left over and weights so far, after the j-th break."""
        free = left["rest"] - (F.col("n") - j)
        cut = draw(F.col("model_id") * (MAX_ASSETS + 1) + j, 5) % free + 1
        weight = F.when(j == F.col("n"), left["rest"]).otherwise(cut)
        return F.struct(
            (left["rest"] - weight).alias("rest"),
            F.concat(left["weights"], F.array(weight)).alias("weights"),
        )

    nothing = F.struct(
        F.lit(100).cast("bigint").alias("rest"),
        F.array().cast("array<bigint>").alias("weights"),
    )
    stick = F.aggregate(F.sequence(F.lit(1).cast("bigint"), F.col("n")), nothing, broken)
    return (
        sized.withColumn("weights", stick["weights"])
        .select("model_id", "curr_code", "listed", "start", "stride", F.posexplode("weights"))
        .withColumn(
            "position", (F.col("start") + F.col("pos") * F.col("stride")) % F.col("listed") + 1
        )
        .join(sized_lookup(placed), ["curr_code", "position"])
        .select(
            "model_id",
            "asset_id",
            "exch_code",
            "curr_code",
            (F.col("col").cast("decimal(9,0)") / 100).cast(WEIGHT).alias("weighting"),
        )
    )


def gen_accounts(
    spark: SparkSession, fund: DataFrame, model: DataFrame, per_fund: int = 10_000
) -> DataFrame:
    """Accounts (id = investor id, dense over funds by id) with a model of their
    currency and a waiting first deposit of whole thousands up to 100,000."""
    funds = number_by_id(fund.select("fund_id", "curr_code"), "fund_id", "fund_no")
    numbered = number_by_id(
        model.select("model_id", "curr_code"), "model_id", "model_no", ["curr_code"]
    )
    choice = numbered.groupBy("curr_code").agg(F.max("model_no").alias("models"))
    rows = spark.range(fund.count() * per_fund).select(
        (F.col("id") + 1).alias("accnt_id"),
        F.expr(f"id div {max(per_fund, 1)} + 1").alias("fund_no"),
    )
    return (
        rows.join(sized_broadcast(funds.join(choice, "curr_code")), "fund_no")
        .withColumn("model_no", wide_draw(F.col("accnt_id"), 6, 10) % F.col("models") + 1)
        .join(sized_broadcast(numbered), ["curr_code", "model_no"])
        .select(
            "accnt_id",
            F.col("accnt_id").alias("inv_id"),
            F.concat(F.lit("Investor"), F.col("accnt_id").cast("string")).alias("inv_name"),
            "curr_code",
            "fund_id",
            "model_id",
            amount((draw(F.col("accnt_id"), 7) % 100 + 1) * 1000).alias("deposit"),
        )
    )

