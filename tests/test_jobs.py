"""The whole cycle on stored tables: generate, rebalance, close, trade again."""

import pytest
from portfolio import THEN, rows_of
from pyspark.sql import functions as F

from ballast.operators import funds, quality
from ballast.plans import jobs
from ballast.plans.rebalance import Portfolio, Rebalance
from ballast.schemas import KEYS, TABLES
from ballast.sources.state import PARTITIONED, read_table, read_tables

DAYS = [f"2024-01-0{n} 00:00:00" for n in range(1, 8)]


@pytest.fixture(scope="module")
def cycle(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("cycle")

    def at(step):
        return str(home / step)

    states = [jobs.bootstrap(spark, at("start"), DAYS[0], per_cell=12, advisors=2, per_pair=3, per_fund=40)]
    states.append(jobs.run_rebalance(spark, states[-1], at("first"), DAYS[1]))
    states.append(jobs.run_close(spark, states[-1], at("close"), DAYS[2]))
    listing = read_table(spark, states[-1], "listing_price")
    ticks = listing.select(
        F.col("asset_id").alias("event_id"),
        F.lit(DAYS[3]).cast("timestamp_ntz").alias("ts"),
        "asset_id",
        "exch_code",
        "curr_code",
        (F.col("asset_id") % 41 - 20).alias("variance"),
    )
    states.append(jobs.run_ticks(spark, states[-1], ticks, at("ticks")))
    accounts = read_table(spark, states[-1], "account")
    deposits = accounts.select(
        F.concat(F.lit("E"), F.col("accnt_id").cast("string")).alias("tran_id"),
        "accnt_id",
        "fund_id",
        "curr_code",
        F.lit(500).alias("amount"),
        F.lit(THEN).cast("timestamp_ntz").alias("queued_dt"),
    )
    states.append(jobs.run_deposits(spark, states[-1], deposits, at("deposits")))
    states.append(jobs.run_rebalance(spark, states[-1], at("second"), DAYS[4]))
    return states


def table(spark, folders, name):
    return read_table(spark, folders, name)


def test_only_partitions_of_open_rebalances_are_read(spark, cycle):
    state = cycle[-1]
    assert len(state["rebal_account"]) > 1 and len(state["price_snapshot"]) > 1
    read = {name: read_table(spark, state, name) for name in ("balance", "rebal_fund", *PARTITIONED)}
    for name in PARTITIONED:
        assert read[name].columns == TABLES[name].names
    portfolio = Portfolio(
        **read_tables(spark, state, ["balance", "holding", "model_asset", "rebal_fund"]),
        queue=read_table(spark, state, "transact_queue"),
        snapshot=read["price_snapshot"],
        processed=read["rebal_account"],
        rejected=read["rebal_rejected"],
    )
    again = Rebalance(portfolio, DAYS[4])
    progress = funds.rebalance_progress(
        read["balance"], read["rebal_fund"], read["rebal_account"], read["rebal_rejected"]
    )
    for plan in (again.due, again.snapshot, progress):
        assert pruned(plan)
    # Nothing of the closed rebalance is in what was read.
    opened = {r.rebal_id for r in funds.open_rebalances(read["rebal_fund"]).collect()}
    every = {r.rebal_id for r in read["price_snapshot"].select("rebal_id").distinct().collect()}
    seen = {r.rebal_id for r in again.snapshot.select("rebal_id").distinct().collect()}
    assert seen == opened and opened < every


def pruned(df) -> bool:
    """Whether a scan's partition filters have a condition known only at run time."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return any("dynamicpruning" in line and "PartitionFilters" in line for line in plan.splitlines())


def test_deposits_are_added_to_the_queue_without_rewriting_it(spark, cycle, tmp_path):
    state = next(s for s in cycle if len(s.get("transact_queue", [])) > 1)
    before = cycle[cycle.index(state) - 1]["transact_queue"]
    assert state["transact_queue"][:-1] == before
    added = read_table(spark, {"transact_queue": state["transact_queue"][-1:]}, "transact_queue")
    again = jobs.run_deposits(
        spark, state, added.drop("tx_type"), str(tmp_path / "again")
    )
    waiting = read_table(spark, state, "transact_queue").count()
    assert added.count() > 0
    assert read_table(spark, again, "transact_queue").count() == waiting


def test_generated_tables_keep_their_keys(spark, cycle):
    names = [name for name in KEYS if name in cycle[0]]
    tables = {name: table(spark, cycle[0], name) for name in names}
    assert rows_of(quality.declared_violations(tables)) == []


def test_generated_models(spark, cycle):
    assets = table(spark, cycle[0], "model_asset")
    assert quality.weight_check(assets).count() == 0
    sizes = [r[0] for r in assets.groupBy("model_id").count().select("count").collect()]
    assert len(sizes) == 18 and 5 <= min(sizes) and max(sizes) <= 20
    listing = table(spark, cycle[0], "listing")
    numbers = listing.groupBy("exch_code").agg(F.min("list_no"), F.max("list_no"), F.count("*"))
    assert rows_of(numbers) == [(e, 1, 48, 48) for e in ("ASX", "FTSE", "NYSE")]
    price = table(spark, cycle[0], "listing_price").agg(F.min("price"), F.max("price")).first()
    assert (price[0], price[1]) == (1, 5)


def test_audit_identities(spark, cycle):
    audit = table(spark, cycle[-1], "account_audit")
    assert audit.count() == 2 * 240
    broken = audit.filter(
        "target_invest_value <> current_holdings_value + current_cash_balance + new_deposits - new_withdrawals"
        " or rebalanced_invest_value + rebalanced_cash_balance <> target_invest_value"
    )
    assert broken.count() == 0


def test_trades_explain_the_change_in_holdings(spark, cycle):
    before = table(spark, cycle[4], "holding").select("accnt_id", "asset_id", F.col("units").alias("b"))
    after = table(spark, cycle[5], "holding").select("accnt_id", "asset_id", F.col("units").alias("a"))
    trade = (
        table(spark, cycle[5], "trade")
        .filter(F.col("rebal_id").endswith("-2"))
        .select("accnt_id", "asset_id", F.col("units").alias("t"), "trtyp_id")
    )
    joined = before.join(after, ["accnt_id", "asset_id"], "full").join(
        trade, ["accnt_id", "asset_id"], "full"
    )
    change = "coalesce(a, 0) - coalesce(b, 0) <> coalesce(t, 0)"
    assert joined.filter(change).count() == 0
    assert trade.filter("trtyp_id = 2 and t >= 0 or trtyp_id = 1 and t <= 0").count() == 0
    assert trade.groupBy("trtyp_id").count().count() == 2


def test_close_opens_the_next_rebalance(spark, cycle):
    headers = table(spark, cycle[2], "rebal_fund")
    assert headers.filter("end_dt = timestamp_ntz'1900-01-01 00:00:00'").count() == 6
    assert headers.count() == 12
    assert [r[0] for r in rows_of(table(spark, cycle[2], "fund_balance"), "balance")] == [1] * 6
    logged = table(spark, cycle[2], "fund_balance_history").agg(F.sum("balance")).first()[0]
    worth = table(spark, cycle[1], "balance").agg(F.sum(F.expr("inv_balance + cash_balance"))).first()[0]
    assert logged == worth


def test_second_rebalance_uses_the_frozen_prices(spark, cycle):
    """Prices moved after the snapshot was taken, so the second rebalance must not see them."""
    audit = table(spark, cycle[5], "account_asset").filter(F.col("rebal_id").endswith("-2"))
    opened = table(spark, cycle[2], "price_snapshot")
    wrong = audit.join(opened.select("rebal_id", "asset_id", F.col("price").alias("p")), ["rebal_id", "asset_id"])
    assert wrong.count() == audit.count()
    assert wrong.filter("price <> p").count() == 0
    moved = table(spark, cycle[3], "listing_price").join(
        opened.select("asset_id", F.col("price").alias("p")), "asset_id"
    )
    assert moved.filter("price <> p").count() > 0


def test_output_keys_are_unique(spark, cycle):
    for name in ("trade", "holding", "holding_history", "balance_history", "account_asset", "rebal_account", "transact"):
        assert quality.pk_violations(table(spark, cycle[-1], name), KEYS[name]).count() == 0, name
    assert table(spark, cycle[-1], "rejects").count() == 0
    ids = table(spark, cycle[-1], "balance_history").agg(F.count_distinct("id"), F.max("id")).first()
    assert tuple(ids) == (480, 480)


def test_rerun_adds_nothing(spark, cycle, tmp_path):
    again = jobs.run_rebalance(spark, cycle[-1], str(tmp_path / "again"), DAYS[5])
    for name in ("trade", "holding", "balance", "transact", "account_audit", "rebal_account"):
        assert table(spark, again, name).count() == table(spark, cycle[-1], name).count(), name


def test_archive_job(spark, cycle, tmp_path):
    folders = cycle[-1]
    for step, source in enumerate(folders["account_asset"]):
        folders = jobs.log_assets(spark, folders, source, str(tmp_path / f"log{step}"))
    history = table(spark, folders, "account_asset_history")
    n = history.count()
    assert n == table(spark, folders, "account_asset").count() > 1000
    assert history.agg(F.max("history_id")).first()[0] == n
    for step in range(2):
        folders = jobs.run_archive(spark, folders, str(tmp_path / f"archive{step}"), keep=1000)
        assert table(spark, folders, "account_asset_archive").count() == n - 1000
        assert table(spark, folders, "account_asset_history").count() == 1000
