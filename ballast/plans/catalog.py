"""The registered queries: every operator over the tables of a data directory."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballast.functions.money import amount
from ballast.functions.numbering import number_by_pair
from ballast.functions.sizing import scratch_path, staged
from ballast.operators import (
    allocation,
    archive,
    cash,
    funds,
    generate,
    prices,
    quality,
    shaping,
    trades,
    valuation,
)
from ballast.plans.cycle import CloseResult, close_rebalances
from ballast.plans.oracle import AS_OF
from ballast.plans.rebalance import Portfolio, Rebalance
from ballast.session import tune
from ballast.sources.star import StarSource, event_ticks, order_events, stream_schema
from ballast.streaming import ingest

Query = Callable[[StarSource], DataFrame]
_QUERIES: dict[str, Query] = {}

PRICE_MOMENT = "2024-01-15 12:00:00"


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def _rebalance(
    src: StarSource, gated: bool = False, trigger: str = "unrounded", store: Sequence[str] = ()
) -> Rebalance:
    """A rebalance of all accounts, or of those whose currency gate is open.
    ``store`` names the frames that the query reads twice: priced holdings, whose
    joins are the dearest part, or judged targets. The others stay lazy."""
    state = Portfolio(
        balance=src.balance(),
        holding=src.holding(),
        model_asset=src.model_asset(),
        queue=src.queue_events(),
        rebal_fund=src.rebal_fund(),
        listing_price=src.listing_price(),
        gate=src.gate() if gated else None,
    )

    def stage(df: DataFrame, label: str) -> DataFrame:
        return staged(df, label) if label in store else df

    return Rebalance(state, AS_OF, trigger, stage=stage if store else None)


HELD = ("matched", "judged")
JUDGED = ("judged",)


# valuation


@query
def price_snapshot(src):
    return valuation.price_snapshot(src.listing_price(), src.rebal_fund())


@query
def queued_cash_by_account(src):
    return valuation.queued_cash(src.queue_events())


@query
def holdings_current(src):
    return _rebalance(src).current


@query
def holdings_value(src):
    return valuation.value_holdings(_rebalance(src).current)


@query
def target_balance(src):
    return _rebalance(src).target.drop("curr_code", "inv_balance")


# allocation


@query
def holdings_target(src):
    return _rebalance(src).rounded.select(
        "rebal_id",
        "accnt_id",
        "model_id",
        "asset_id",
        "exch_code",
        "curr_code",
        amount(F.col("weighting")).alias("weighting"),
        "price",
        "units_target",
    )


@query
def holdings_rounded(src):
    return _rebalance(src).rounded.select(
        "rebal_id",
        "accnt_id",
        "asset_id",
        "units_target",
        amount(F.col("value_target")).alias("value_target"),
        "units_rounded",
    )


def _adjusted(src: StarSource, trigger: str) -> DataFrame:
    return _rebalance(src, trigger=trigger).adjusted.select(
        "rebal_id",
        "accnt_id",
        "asset_id",
        "exch_code",
        "price",
        "units_target",
        "units_rounded",
        "units_adjusted",
    )


@query
def holdings_adjusted(src):
    return _adjusted(src, "unrounded")


@query
def holdings_adjusted_strict(src):
    return _adjusted(src, "rounded")


@query
def cheapest_asset(src):
    return allocation.cheapest(_rebalance(src).rounded)


@query
def rebalanced_balances(src):
    return _rebalance(src, store=JUDGED).account_audit.select(
        "rebal_id",
        "accnt_id",
        "target_invest_value",
        "rounded_target_invest_value",
        "rebalanced_invest_value",
        "rebalanced_cash_balance",
    )


# what a rebalance puts out


@query
def trade(src):
    return _rebalance(src, store=HELD).trade


_QUERIES["trades"] = _QUERIES.pop("trade")


@query
def holdings_replaced(src):
    return _rebalance(src, gated=True, store=JUDGED).holding


@query
def holding_history(src):
    return _rebalance(src).holding_history


@query
def balances_replaced(src):
    return _rebalance(src, gated=True, store=JUDGED).balance


@query
def balance_history(src):
    return _rebalance(src, store=JUDGED).balance_history


@query
def account_asset_audit(src):
    return _rebalance(src, store=HELD).account_asset


@query
def account_audit(src):
    return _rebalance(src, store=JUDGED).account_audit


@query
def rebalance_accounts(src):
    return _rebalance(src).rebal_account


def _gated_due(src: StarSource) -> DataFrame:
    return _rebalance(src, gated=True).due


@query
def transact_processed(src):
    return cash.settle_queue(src.transact_queue(), _gated_due(src), AS_OF)


@query
def transact_queue_remaining(src):
    return cash.queue_remaining(src.transact_queue(), _gated_due(src))


# fund cycle


@query
def rebalance_rerun(src):
    """A run after one that stopped half-way: accounts it has done are marked, others are
    known to be rejected. Only what is left is added, and no rejection twice."""
    first = _rebalance(src, store=JUDGED)
    done = first.rebal_account.filter(F.col("accnt_id") % 10 != 3)
    state = Portfolio(
        **{**vars(first.state), "processed": staged(done, "done"), "rejected": first.rebal_rejected}
    )
    again = Rebalance(state, AS_OF)
    markers = again.rebal_account.select("rebal_id", "accnt_id", F.lit("done").alias("state"))
    return markers.unionByName(
        again.rebal_rejected.select("rebal_id", "accnt_id", F.lit("rejected").alias("state"))
    )


@query
def rebalance_progress_rejected(src):
    """A third of the accounts processed, a third rejected, some of them both."""
    every = trades.rebalance_accounts(_rebalance(src).due)
    processed = every.filter(F.col("accnt_id") % 3 == 0)
    rejected = every.filter((F.col("accnt_id") % 3 == 1) | (F.col("accnt_id") % 6 == 0))
    return funds.rebalance_progress(src.account(), src.rebal_fund(), processed, rejected)


def _processed(src: StarSource) -> DataFrame:
    return trades.rebalance_accounts(_gated_due(src))


def _closed(src: StarSource, balance: DataFrame | None = None) -> CloseResult:
    return close_rebalances(
        src.account(),
        src.balance() if balance is None else balance,
        src.fund_balance(),
        src.rebal_fund(),
        _processed(src),
        src.listing_price(),
        AS_OF,
    )


@query
def open_rebalances(src):
    return funds.open_rebalances(src.rebal_fund())


@query
def rebalance_progress(src):
    return funds.rebalance_progress(src.account(), src.rebal_fund(), _processed(src))


@query
def rebalance_roll(src):
    return _closed(src).rebal_fund


@query
def fund_rebalance_counter(src):
    return _closed(src).fund_balance


@query
def fund_balance_history(src):
    balance = _rebalance(src, gated=True, store=JUDGED).balance
    return _closed(src, balance).fund_balance_history


@query
def next_price_snapshot(src):
    return _closed(src).price_snapshot


# prices


def _folded(src: StarSource) -> prices.PriceUpdate:
    return prices.apply_ticks(src.listing_price(), src.ticks(), src.gate_closed())


@query
def price_update_latest(src):
    return _folded(src).latest


@query
def price_update_history(src):
    return _folded(src).history


@query
def price_gate_filter(src):
    return prices.gate_ticks(src.ticks(), src.gate_closed())


@query
def price_gate_long(src):
    """Every order closes its currency for a while: many short closings that overlap, some
    of two years."""
    key = F.col("o_orderkey")
    began = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    at = key * 433 % 2_592_000
    long_from = F.expr("timestamp_ntz'2022-01-01 00:00:00' + make_dt_interval(cast(o_orderkey % 30 as int))")
    long_to = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(o_orderkey % 11 as int))")
    is_long = key % 97 == 0
    owners = src.account().select(F.col("accnt_id").alias("o_custkey"), "curr_code")
    closed = (
        src.raw("orders")
        .join(owners, "o_custkey")
        .select(
            "curr_code",
            F.when(is_long, long_from).otherwise(began + F.make_dt_interval(secs=at)).alias("closed_from"),
            F.when(is_long, long_to)
            .otherwise(began + F.make_dt_interval(secs=at + key % 100))
            .alias("closed_to"),
        )
    )
    return prices.gate_ticks(src.ticks(), closed)


@query
def price_asof_snapshot(src):
    return prices.snapshot_asof(_folded(src).history, src.listing_price(), PRICE_MOMENT)


@query
def price_hot_listing(src):
    """All ticks on one listing, folded in eight pieces."""
    one = src.listing_price().filter(F.col("asset_id") == src.listing().agg(F.min("asset_id")).scalar())
    ticks = src.ticks().drop("asset_id", "exch_code", "curr_code").crossJoin(F.broadcast(one.drop("price")))
    pieces = max(1, src.raw("events").count() // 8)
    folded = prices.fold_ticks(one, ticks, hot_ticks=0, piece_ticks=pieces)
    return folded.select("id", "price_pre", "price_post")


@query
def price_asof_orders(src):
    """The price of each line item's part when it was ordered."""
    orders = src.raw("orders").select("o_orderkey", "o_orderdate")
    listed = src.listing().withColumnRenamed("asset_id", "l_partkey")
    moments = (
        src.raw("lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(listed, "l_partkey")
        .select(
            "l_orderkey", "l_linenumber", F.col("l_partkey").alias("asset_id"), "exch_code", "curr_code",
            (F.lit("2024-01-01").cast("timestamp_ntz")
             + F.make_dt_interval(F.col("l_orderkey").cast("int") % 30, F.col("l_linenumber"))).alias("at"),
        )
    )
    found = prices.prices_at(moments, _folded(src).history, src.listing_price(), "at")
    return found.select("l_orderkey", "l_linenumber", "asset_id", "at", "price")


# cash


def _requests(src: StarSource, status: str) -> DataFrame:
    orders = src.raw("orders").filter(F.col("o_orderstatus") == status)
    return src.with_fund(order_events(orders))


@query
def deposit_enqueue(src):
    """Open orders arrive as deposits in a queue of withdrawals."""
    requests = _requests(src, "O")
    again = requests.filter(F.xxhash64("tran_id") % 5 == 0)
    return cash.enqueue_deposits(_requests(src, "P"), requests.unionByName(again))


@query
def withdrawal_ledger(src):
    """Pending orders arrive as withdrawals in the ledger of finished ones."""
    requests = _requests(src, "P")
    again = requests.filter(F.xxhash64("tran_id") % 5 == 0).unionByName(
        _requests(src, "F").filter(F.xxhash64("tran_id") % 5 == 1)
    )
    return cash.record_withdrawals(src.transact(), requests.unionByName(again))


# archive


def _asset_history(src: StarSource) -> DataFrame:
    """Numbered per-asset rows. The numbering stores its input and its ranges, and the
    numbers follow from the latter, so reading them more than once costs little."""
    rows = _rebalance(src, store=HELD).account_asset
    return number_by_pair(rows, "accnt_id", "asset_id", "history_id")


@query
def archive_keep_last_n(src):
    return archive.archived(_asset_history(src), "history_id")


@query
def archive_remaining(src):
    return archive.retained(_asset_history(src), "history_id")


@query
def archive_idempotent_append(src):
    """Rows without a current holding are stored already; all rows come, twice."""
    rows = _asset_history(src)
    stored = rows.filter(F.col("units_current").isNull())
    return archive.append_ignore_dup(stored, rows.unionByName(rows), ["history_id"])


# shaping


@query
def account_queue(src):
    return shaping.number_accounts(src.account())


@query
def cohort_ranges(src):
    return shaping.cohort_ranges(src.account())


@query
def numbers(src):
    """A number table as long as the line items."""
    table = shaping.numbers(src.spark, src.raw("lineitem").count())
    return table.agg(
        F.min("n").alias("min_n"), F.max("n").alias("max_n"), F.count("n").alias("count_n")
    )


@query
def model_weights(src):
    """Weights from sizes by the aggregated form, which needs no bound on a model."""
    return shaping.spread_weights(src.model_sizes()).withColumn(
        "weighting", amount(F.col("weighting"))
    )


@query
def available_listings_anti(src):
    return shaping.available_counts(src.model(), src.listing(), src.model_asset())


@query
def ranked_listing_pick(src):
    k = (F.col("model_id") % 7 + 1).alias("k")
    wanted = src.model().select("model_id", "curr_code", k)
    return shaping.pick_kth(wanted, src.listing(), src.model_asset())


@query
def successor_key(src):
    return shaping.successor(src.raw("lineitem"), "l_orderkey")


@query
def advisor_model_grid(src):
    return shaping.model_grid(src.advisor(), src.currency())


@query
def listing_count_by_exchange(src):
    return shaping.listing_counts(src.listing())


@query
def model_assets_count(src):
    return shaping.model_asset_counts(src.model_asset())


@query
def asset_naming(src):
    assets = src.asset().join(src.listing().select("asset_id", "exch_code"), "asset_id")
    return shaping.name_assets(assets, src.exchange())


# quality


@query
def pk_violations(src):
    return quality.pk_violations(src.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def fk_violations(src):
    """Holdings of an asset that the account's model does not contain."""
    models = src.account().select("accnt_id", "model_id")
    child = src.holding().join(models, "accnt_id").select("accnt_id", "model_id", "asset_id")
    return quality.fk_violations(child, src.model_asset(), ["model_id", "asset_id"])


@query
def not_null_violations(src):
    """Trades of assets outside the model have no model price."""
    rows = trades.make_trades(_rebalance(src, store=HELD).account_asset, AS_OF, model_price_only=True)
    return quality.null_violations(rows, ["rebal_id", "accnt_id", "asset_id"], ["units", "price"])


@query
def model_weight_check(src):
    """Weights that are left when unlisted assets drop out of the models."""
    listed = src.model_asset().join(src.listing().select("asset_id"), "asset_id", "left_semi")
    return quality.weight_check(listed)


@query
def declared_violations(src):
    """All declared rules over tables with broken rows of every kind: accounts that occur
    twice or lack a model, a second open rebalance, queued rows of another fund; and held
    and modelled assets without a listing, as the tables have them."""
    account = src.account()
    account = account.withColumn("model_id", F.when(F.col("accnt_id") % 89 != 0, F.col("model_id")))
    headers = src.rebal_fund()
    second = headers.filter("fund_id = 3").withColumn("rebal_id", F.lit("R3-9"))
    queue = src.transact_queue()
    return quality.declared_violations(
        {
            "currency": src.currency(),
            "fund": src.fund(),
            "account": account.unionByName(account.filter("accnt_id % 97 = 0")),
            "rebal_fund": headers.unionByName(second),
            "model_asset": src.model_asset(),
            "listing": src.listing(),
            "holding": src.holding(),
            "transact_queue": queue.withColumn(
                "fund_id", F.when(F.col("accnt_id") % 83 == 0, F.col("fund_id") + 1).otherwise(F.col("fund_id"))
            ),
        }
    )


@query
def rejects(src):
    ticks = prices.apply_ticks(src.listing_price(), src.ticks(), src.gate_closed()).rejects
    return _rebalance(src, store=HELD).rejects.unionByName(ticks)


# streaming


def _stream(src: StarSource, name: str) -> DataFrame:
    return ingest.file_stream(src.spark, src.path, stream_schema(name), f"{name}.parquet")


def _stream_requests(src: StarSource, status: str) -> DataFrame:
    """Orders as requests, every third of which arrives twice."""
    orders = _stream(src, "orders").filter(F.col("o_orderstatus") == status)
    times = F.array_repeat(F.lit(0), F.when(F.col("o_orderkey") % 3 == 0, 2).otherwise(1))
    return src.with_fund(order_events(orders.withColumn("copy", F.explode(times))))


@query
def stream_deposits(src):
    out = scratch_path(src.spark, "deposits")
    return ingest.stream_deposits(_stream_requests(src, "O"), out, f"{out}/checkpoint")


@query
def stream_withdrawals(src):
    out = scratch_path(src.spark, "withdrawals")
    return ingest.stream_withdrawals(_stream_requests(src, "P"), out, f"{out}/checkpoint")


@query
def stream_prices(src):
    return _streamed(src).latest


@query
def stream_rejects(src):
    return _streamed(src).rejects


def _streamed(src: StarSource) -> prices.PriceUpdate:
    out = scratch_path(src.spark, "prices")
    ticks = event_ticks(_stream(src, "events"))
    return ingest.stream_prices(
        ticks, src.listing_price(), out, f"{out}/checkpoint", src.gate_closed()
    )


# generators, sized by the tables


@query
def gen_assets(src):
    per_cell = src.raw("part").count() // 10
    return generate.gen_assets(src.spark, src.exchange(), src.asset_class(), per_cell)


@query
def gen_models(src):
    return generate.gen_models(src.advisor(), src.currency())


@query
def gen_model_assets(src):
    models = generate.gen_models(src.advisor(), src.currency())
    picked = generate.gen_model_assets(models, src.listing())
    return picked.withColumn("weighting", amount(F.col("weighting")))


@query
def gen_accounts(src):
    per_fund = src.raw("customer").count() // 5
    return generate.gen_accounts(src.spark, src.fund(), src.model(), per_fund)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(fn: Query):
        return lambda spark, path: fn(StarSource(tune(spark), path))

    return {name: bound(fn) for name, fn in _QUERIES.items()}
