"""Streams over files that arrive in steps, with restarts in between."""

from datetime import timedelta

from portfolio import THEN, dec, rows_of

from ballast.operators import prices
from ballast.schemas import TABLES
from ballast.streaming import ingest


def arrive(table, name, rows, folder):
    table(name, rows).coalesce(1).write.mode("append").parquet(folder)


def test_deposits_once_across_batches_and_restarts(spark, table, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def request(tran, days=0):
        return (tran, 1, 1, "GBP", 0, dec(10), THEN + timedelta(days=days))

    def run():
        stream = ingest.file_stream(spark, inbox, TABLES["transact_queue"], files_per_batch=1)
        return ingest.stream_deposits(stream, out, state)

    arrive(table, "transact_queue", [request("a"), request("b"), request("b")], inbox)
    arrive(table, "transact_queue", [request("c", 30)], inbox)
    assert rows_of(run(), "tran_id", "tx_type") == [("a", 1), ("b", 1), ("c", 1)]
    # A late copy and a late new one, after a restart.
    arrive(table, "transact_queue", [request("a"), request("d", -90)], inbox)
    assert rows_of(run(), "tran_id") == [("a",), ("b",), ("c",), ("d",)]
    assert rows_of(run(), "tran_id") == [("a",), ("b",), ("c",), ("d",)]


def test_withdrawals_reach_the_ledger(spark, table, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    arrive(table, "transact_queue", [("w", 1, 1, "GBP", 0, dec(10), THEN)], inbox)
    stream = ingest.file_stream(spark, inbox, TABLES["transact_queue"])
    ledger = ingest.stream_withdrawals(stream, out, state)
    assert rows_of(ledger, "tran_id", "tx_type", "rebal_id") == [("w", 2, None)]


def test_prices_carry_over_batches_and_restarts(spark, table, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    listing = table("listing_price", [(a, "X", "C0", dec("10.01")) for a in (1, 2, 3)])
    closed = table("gate_closed", [("C0", THEN + timedelta(hours=90), THEN + timedelta(hours=91))])

    def tick(event, hours, asset, variance):
        return (event, THEN + timedelta(hours=hours), asset, "X", "C0", variance)

    def run():
        stream = ingest.file_stream(spark, inbox, TABLES["price_tick"], files_per_batch=1)
        return ingest.stream_prices(stream, listing, out, state, closed)

    first = [tick(2, 2, 1, -9), tick(1, 1, 1, 7), tick(3, 3, 2, 3), tick(4, 0, 8, 5)]
    second = [tick(5, 4, 1, 5), tick(6, 90, 1, 50)]
    for rows in (first, second):
        arrive(table, "price_tick", rows, inbox)
        update = run()
    latest, history = update.latest, update.history
    batch = prices.apply_ticks(listing, table("price_tick", first + second), closed)
    assert rows_of(latest) == rows_of(batch.latest)
    assert rows_of(history) == rows_of(batch.history)
    assert rows_of(update.rejects) == rows_of(batch.rejects) and update.rejects.count() == 1
    # A tick older than what was applied counts on arrival.
    arrive(table, "price_tick", [tick(7, 1, 2, 10)], inbox)
    update = run()
    latest, history = update.latest, update.history
    log = rows_of(history.filter("id = 7"), "price_pre", "price_post")
    assert log == [(dec("10.3103"), dec("11.34133"))]
    assert dict(rows_of(latest, "asset_id", "price"))[2] == dec("11.34133")
