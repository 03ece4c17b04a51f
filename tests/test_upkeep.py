"""Cash, archive, quality, progress and closing."""

from datetime import datetime
from types import SimpleNamespace

import pytest
from portfolio import AS_OF, OPEN, THEN, dec, rows_of
from pyspark.sql import functions as F

from ballast.operators import archive, cash, funds, quality
from ballast.plans import catalog

NOW = datetime(2024, 2, 1)


def request(tran, accnt=1, amount=10, kind=0):
    return (tran, accnt, 1, "GBP", kind, dec(amount), THEN)


def test_deposit_is_queued_once(table):
    queue = table("transact_queue", [request("a", kind=1)])
    new = table("transact_queue", [request("a", amount=99), request("b"), request("b"), request("c", amount=3)])
    result = cash.enqueue_deposits(queue, new)
    assert rows_of(result, "tran_id", "tx_type", "amount") == [
        ("a", 1, dec(10)),
        ("b", 1, dec(10)),
        ("c", 1, dec(3)),
    ]


def test_withdrawal_goes_to_ledger_or_queue(table):
    new = table("transact_queue", [request("w"), request("w")])
    ledger = cash.record_withdrawals(table("transact", []), new, AS_OF)
    assert rows_of(ledger, "tran_id", "tx_type", "rebal_id", "processed_dt") == [("w", 2, None, NOW)]
    queue = cash.record_withdrawals(table("transact_queue", [request("a", kind=1)]), new, via_queue=True)
    assert rows_of(queue, "tran_id", "tx_type") == [("a", 1), ("w", 2)]


@pytest.mark.parametrize("top,moved", [(0, 0), (999, 0), (1000, 0), (1001, 1), (1500, 500)])
def test_archive_keeps_the_last_thousand(spark, top, moved):
    rows = spark.range(1, top + 1).withColumnRenamed("id", "history_id")
    old, rest = archive.archive(rows, "history_id")
    assert (old.count(), rest.count()) == (moved, top - moved)
    if moved:
        assert [r[0] for r in rows_of(old.agg({"history_id": "max"}))] == [top - 1000]


def test_archive_with_gaps_counts_ids_not_rows(spark):
    rows = spark.createDataFrame([(1,), (5000,), (5500,)], "history_id long")
    old, rest = archive.archive(rows, "history_id")
    assert (rows_of(old), rows_of(rest)) == ([(1,)], [(5000,), (5500,)])


def test_duplicate_ids_are_ignored(spark):
    stored = spark.createDataFrame([(1, "x")], "id long, v string")
    rows = spark.createDataFrame([(1, "y"), (2, "b"), (2, "a"), (3, None)], "id long, v string")
    assert rows_of(archive.append_ignore_dup(stored, rows, ["id"])) == [(2, "a"), (3, None)]


def test_key_and_null_checks(spark):
    df = spark.createDataFrame([(1, None), (1, "C"), (2, "D")], "k long, code string")
    parent = spark.createDataFrame([("C",), ("C",)], "code string")
    assert rows_of(quality.pk_violations(df, ["k"])) == [(1, 2)]
    assert rows_of(quality.fk_violations(df, parent, ["code"]), "k", "code") == [(2, "D")]
    assert rows_of(quality.null_violations(df, ["k"], ["k", "code"])) == [(1, "code")]


def test_declared_rules_over_tables(spark, table):
    account = table("account", [(1, 1, "GBP", 1, 1), (1, 2, "USD", 1, 1)])
    loose = account.select(
        "accnt_id", F.when(F.col("inv_id") == 1, 1).alias("inv_id"), "curr_code", "fund_id", "model_id"
    )
    fund = table("fund", [(1, "A", "GBP")])
    found = quality.declared_violations({"account": loose, "fund": fund})
    assert rows_of(found) == [
        ("account", "1", "not unique: accnt_id"),
        ("account", "1/1/USD", "no such fund: fund_id,curr_code"),
        ("account", "1/inv_id", "value is missing"),
    ]


def test_weight_check(table):
    rows = [(1, 1, "X", "C", dec(0.4)), (1, 2, "X", "C", dec(0.6)), (2, 1, "X", "C", dec(0.9))]
    assert rows_of(quality.weight_check(table("model_asset", rows))) == [(2, dec(0.9))]


@pytest.fixture
def headers(table):
    return table(
        "rebal_fund",
        [
            ("R1-9", 1, "GBP", -1, THEN, OPEN),
            ("R2-1", 2, "USD", -1, THEN, OPEN),
            ("R1-8", 1, "GBP", -1, THEN, THEN),
        ],
    )


def test_progress_and_roll(table, headers):
    account = table("account", [(1, 1, "GBP", 1, 1), (2, 2, "GBP", 1, 1), (3, 3, "USD", 2, 1)])
    done = table("rebal_account", [("R1-9", 1, a, 1, "GBP", 1) for a in (1, 2)])
    progress = funds.rebalance_progress(account, headers, done)
    assert rows_of(progress, "rebal_id", "done", "remaining", "complete") == [
        ("R1-9", 2, 0, 1),
        ("R2-1", 0, 1, 0),
    ]
    closing = funds.finished(progress, headers)
    rolled = funds.roll_rebalances(headers, closing, AS_OF)
    assert rows_of(rolled, "rebal_id", "start_dt", "end_dt") == [
        ("R1-10", NOW, OPEN),
        ("R1-8", THEN, THEN),
        ("R1-9", THEN, NOW),
        ("R2-1", THEN, OPEN),
    ]
    counter = table("fund_balance", [(1, "GBP", dec(4)), (2, "USD", dec(0))])
    assert rows_of(funds.count_closes(counter, closing), "fund_id", "balance") == [
        (1, dec(5)),
        (2, dec(0)),
    ]
    assert quality.pk_violations(funds.open_rebalances(rolled), ["fund_id", "end_dt"]).count() == 0


def test_fund_total_treats_null_as_zero(table):
    balance = table(
        "balance", [(1, 1, "GBP", 1, 1, dec(5), None), (2, 2, "GBP", 1, 1, None, dec(-2))]
    )
    assert rows_of(funds.fund_totals(balance)) == [(1, dec(3))]


def test_progress_counts_accounts_not_markers(table, headers):
    account = table("account", [(1, 1, "GBP", 1, 1), (2, 2, "GBP", 1, 1)])
    done = table("rebal_account", [("R1-9", 1, a, 1, "GBP", 1) for a in (1, 9)])
    progress = funds.rebalance_progress(account, headers, done)
    assert rows_of(progress, "rebal_id", "done", "remaining", "complete") == [
        ("R1-9", 1, 1, 0),
        ("R2-1", 0, 0, 0),  # a fund without accounts is never complete
    ]


def test_rejected_accounts_do_not_keep_a_fund_open(table, headers):
    account = table("account", [(1, 1, "GBP", 1, 1), (2, 2, "GBP", 1, 1)])
    done = table("rebal_account", [("R1-9", 1, 1, 1, "GBP", 1)])
    rejected = table("rebal_rejected", [("R1-9", 1, 2, "GBP", 1), ("R1-9", 1, 1, "GBP", 1)])
    progress = funds.rebalance_progress(account, headers, done, rejected)
    assert rows_of(funds.finished(progress, headers), "rebal_id") == [("R1-9",)]


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from ballast.functions.sizing import shared_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(ValueError):
        shared_dir(session)


def test_append_sorts_incoming_rows_once(spark):
    stored = spark.createDataFrame([(1, "z"), (None, "z")], "id long, v string")
    rows = spark.createDataFrame([(1, "a"), (2, "c"), (2, "b"), (3, None), (3, "d"), (None, "q"), (None, "p")], "id long, v string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = archive.append_ignore_dup(stored, rows, ["id"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hash") == 2 and plan.count("Sort [") == 2
        assert rows_of(got) == sorted([(2, "b"), (3, None), (None, "p")], key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_archived_history_is_not_stored_again(spark, monkeypatch):
    rows = spark.range(30).selectExpr("id div 3 accnt_id", "id asset_id")
    monkeypatch.setattr(catalog, "_rebalance", lambda src, store: SimpleNamespace(account_asset=rows))
    monkeypatch.setattr(catalog, "staged", lambda df, label: pytest.fail(f"{label} is stored"))
    got = catalog._asset_history(None)
    assert rows_of(got, "asset_id", "history_id") == sorted(((i, i + 1) for i in range(30)), key=repr)
