"""Portfolio tables as views over a sales star schema.

Currencies and exchanges are regions, funds are nations, accounts are customers,
assets are parts, advisors are suppliers, holdings are summed line items, cash
movements are orders and price ticks are events. Every view is a lazy scan with
an explicit schema, so filters and column choices reach the Parquet reader.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ballast.functions.money import amount
from ballast.operators.funds import OPEN_END
from ballast.operators.shaping import spread_weights

# Assets per model and currencies: parts whose ids share `p_partkey div 100`
# and `p_partkey % 5` form one model of at most 20 assets.
CURRENCIES = 5
ASSETS_PER_MODEL = 20
MODEL_SPAN = CURRENCIES * ASSETS_PER_MODEL

FILES: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def curr_code(key: Column) -> Column:
    return F.concat(F.lit("C"), key.cast("string"))


def exch_code(key: Column) -> Column:
    return F.concat(F.lit("X"), key.cast("string"))


def is_listed(size: Column) -> Column:
    """Parts of some sizes have no listing, so unpriced assets occur."""
    return size % 25 != 7


def order_amount() -> Column:
    """Open orders deposit their total, pending ones withdraw a tenth of it."""
    total = amount(F.col("o_totalprice"))
    tenth = amount(F.round(total / F.lit(10), 2))
    return F.when(F.col("o_orderstatus") == "P", tenth).otherwise(total)


def order_events(orders: DataFrame) -> DataFrame:
    """Cash movements of an orders frame (batch or stream)."""
    return orders.select(
        F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("tran_id"),
        F.col("o_custkey").alias("accnt_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit(2)).otherwise(F.lit(1)).cast("bigint").alias("tx_type"),
        order_amount().alias("amount"),
        F.col("o_orderdate").alias("queued_dt"),
    )


def event_ticks(events: DataFrame) -> DataFrame:
    """Percentage ticks of an events frame (batch or stream)."""
    return events.select(
        "event_id",
        "ts",
        F.col("user_id").alias("asset_id"),
        exch_code(F.col("user_id") % CURRENCIES).alias("exch_code"),
        curr_code(F.col("user_id") % CURRENCIES).alias("curr_code"),
        (F.floor(F.col("value")).cast("bigint") % 21 - 10).alias("variance"),
    )


class StarSource:
    """The portfolio tables of one data directory."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            scan = self.spark.read.schema(FILES[name]).parquet(f"{self.path}/{name}.parquet")
            self._raw[name] = scan
        return self._raw[name]

    # reference data

    def currency(self) -> DataFrame:
        return self.raw("region").select(
            curr_code(F.col("r_regionkey")).alias("curr_code"), F.col("r_name").alias("curr_name")
        )

    def exchange(self) -> DataFrame:
        key = F.col("r_regionkey")
        return self.raw("region").select(
            exch_code(key).alias("exch_code"),
            F.col("r_name").alias("exch_name"),
            F.upper(F.substring("r_name", 1, 2)).alias("isin_prefix"),
            curr_code(key).alias("curr_code"),
        )

    def fund(self) -> DataFrame:
        return self.raw("nation").select(
            (F.col("n_nationkey") + 1).cast("bigint").alias("fund_id"),
            F.col("n_name").alias("fund_name"),
            curr_code(F.col("n_regionkey")).alias("curr_code"),
        )

    def advisor(self) -> DataFrame:
        return self.raw("supplier").select(
            (F.col("s_suppkey") + 1).alias("advisor_id"), F.col("s_name").alias("advisor_name")
        )

    def investor(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("inv_id"), F.col("c_name").alias("inv_name")
        )

    def asset_class(self) -> DataFrame:
        return self.raw("part").select(F.col("p_type").alias("class_code")).distinct()

    def asset(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("asset_id"),
            F.col("p_name").alias("asset_name"),
            F.col("p_type").alias("class_code"),
        )

    def _listed(self) -> DataFrame:
        home = F.col("p_partkey") % CURRENCIES
        return (
            self.raw("part")
            .filter(is_listed(F.col("p_size")))
            .select(
                F.col("p_partkey").alias("asset_id"),
                exch_code(home).alias("exch_code"),
                curr_code(home).alias("curr_code"),
                amount(F.col("p_retailprice")).alias("price"),
            )
        )

    def listing(self) -> DataFrame:
        return self._listed().drop("price")

    def listing_price(self) -> DataFrame:
        return self._listed()

    # models

    def model_sizes(self) -> DataFrame:
        """Raw integer sizes of each model's assets, before they become weights."""
        home = F.col("p_partkey") % CURRENCIES
        block = F.expr(f"p_partkey div {MODEL_SPAN}")
        return self.raw("part").select(
            (block * CURRENCIES + home + 1).alias("model_id"),
            F.col("p_partkey").alias("asset_id"),
            exch_code(home).alias("exch_code"),
            curr_code(home).alias("curr_code"),
            F.col("p_size").cast("bigint").alias("size"),
        )

    def model(self) -> DataFrame:
        return self.model_sizes().select("model_id", "curr_code").distinct()

    def model_asset(self) -> DataFrame:
        return spread_weights(self.model_sizes(), max_group=ASSETS_PER_MODEL)

    # accounts

    @cached_property
    def _customers(self) -> DataFrame:
        """Customers with fund, currency and one of their currency's models."""
        blocks = self.raw("part").agg(F.expr(f"max(p_partkey) div {MODEL_SPAN} + 1")).scalar()
        nation = self.raw("nation").select("n_nationkey", "n_regionkey")
        model = F.col("c_custkey") % blocks * CURRENCIES + F.col("n_regionkey") + 1
        return (
            self.raw("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("accnt_id"),
                F.col("c_custkey").alias("inv_id"),
                curr_code(F.col("n_regionkey")).alias("curr_code"),
                (F.col("c_nationkey") + 1).cast("bigint").alias("fund_id"),
                model.alias("model_id"),
                amount(F.lit(0)).alias("inv_balance"),
                amount(F.col("c_acctbal")).alias("cash_balance"),
            )
        )

    def account(self) -> DataFrame:
        return self._customers.drop("inv_balance", "cash_balance")

    def balance(self) -> DataFrame:
        return self._customers

    def holding(self) -> DataFrame:
        """Units per account and asset, where the asset trades in the account's
        currency. Orders learn their currency number first, so that four fifths
        of the line items fall out in the join instead of after it."""
        nation = self.raw("nation").select("n_nationkey", "n_regionkey")
        owners = (
            self.raw("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "c_nationkey", "n_regionkey")
        )
        orders = (
            self.raw("orders")
            .select("o_orderkey", "o_custkey")
            .join(owners, F.col("o_custkey") == F.col("c_custkey"))
        )
        lines = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        return (
            lines.join(
                orders,
                (F.col("l_orderkey") == F.col("o_orderkey"))
                & (F.col("l_partkey") % CURRENCIES == F.col("n_regionkey")),
            )
            .groupBy("c_custkey", "c_nationkey", "n_regionkey", "l_partkey")
            .agg(F.sum(amount(F.col("l_quantity"))).alias("units"))
            .select(
                F.col("c_custkey").alias("accnt_id"),
                F.col("l_partkey").alias("asset_id"),
                (F.col("c_nationkey") + 1).cast("bigint").alias("fund_id"),
                exch_code(F.col("n_regionkey")).alias("exch_code"),
                curr_code(F.col("n_regionkey")).alias("curr_code"),
                amount(F.col("units")).alias("units"),
            )
        )

    # cash

    def queue_events(self) -> DataFrame:
        """Waiting deposits and withdrawals without fund and currency."""
        return order_events(self.raw("orders").filter(F.col("o_orderstatus").isin("O", "P")))

    def with_fund(self, events: DataFrame) -> DataFrame:
        owners = self.account().select("accnt_id", "fund_id", "curr_code")
        return events.join(owners, "accnt_id").select(
            "tran_id", "accnt_id", "fund_id", "curr_code", "tx_type", "amount", "queued_dt"
        )

    def transact_queue(self) -> DataFrame:
        return self.with_fund(self.queue_events())

    def transact(self) -> DataFrame:
        """Finished orders: movements settled by an earlier rebalance."""
        done = order_events(self.raw("orders").filter(F.col("o_orderstatus") == "F"))
        return self.with_fund(done).select(
            "*",
            F.concat(F.lit("R"), F.col("fund_id").cast("string"), F.lit("-0")).alias("rebal_id"),
            F.col("queued_dt").alias("processed_dt"),
        )

    # rebalances and prices

    def rebal_fund(self) -> DataFrame:
        fund = self.fund()
        return fund.select(
            F.concat(F.lit("R"), F.col("fund_id").cast("string"), F.lit("-1")).alias("rebal_id"),
            "fund_id",
            "curr_code",
            F.lit(-1).cast("bigint").alias("accnts_count"),
            F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("start_dt"),
            F.lit(OPEN_END).cast("timestamp_ntz").alias("end_dt"),
        )

    def fund_balance(self) -> DataFrame:
        return self.fund().select("fund_id", "curr_code", amount(F.lit(0)).alias("balance"))

    def gate(self) -> DataFrame:
        """The last currency is being snapshotted, so its gate is closed."""
        status = F.when(F.col("r_regionkey") == CURRENCIES - 1, 0).otherwise(1)
        return self.raw("region").select(
            curr_code(F.col("r_regionkey")).alias("curr_code"),
            status.cast("smallint").alias("gate_status"),
        )

    def gate_closed(self) -> DataFrame:
        """Six hours per currency, one day apart."""
        opened = F.expr("timestamp_ntz'2024-01-05 00:00:00' + make_dt_interval(r_regionkey)")
        return self.raw("region").select(
            curr_code(F.col("r_regionkey")).alias("curr_code"),
            opened.alias("closed_from"),
            (opened + F.expr("interval 6 hours")).alias("closed_to"),
        )

    def ticks(self) -> DataFrame:
        return event_ticks(self.raw("events"))


def stream_schema(name: str) -> T.StructType:
    """Schema of a raw file as a StructType, for streaming reads."""
    return T.StructType.fromDDL(FILES[name])
