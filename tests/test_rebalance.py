"""Hand-made accounts, each with a result worked out by hand."""

import pytest
from portfolio import AS_OF, OPEN, THEN, dec, rows_of

from ballast.plans.rebalance import Portfolio, Rebalance

FUND, CURR, EXCH = 1, "GBP", "FTSE"


@pytest.fixture
def world(table):
    """Assets 1..6; models 10 (assets 1, 2 by half), 20 (asset 3 only), 30 (free asset 5),
    40 (asset 6 has no price), 50 (assets 3 and 4 at one price)."""
    prices = {1: 4, 2: 5, 3: 10, 4: 10, 5: 0}
    weights = [
        (10, 1, 0.5),
        (10, 2, 0.5),
        (20, 3, 1),
        (30, 5, 1),
        (40, 1, 0.5),
        (40, 6, 0.5),
        (50, 4, 0.5),
        (50, 3, 0.5),
    ]

    def make(cash=(), holding=(), queue=(), processed=(), gate=1):
        return Portfolio(
            balance=table(
                "balance",
                [(a, a, CURR, FUND, m, None, None if c is None else dec(c)) for a, m, c in cash],
            ),
            holding=table("holding", [(a, s, FUND, EXCH, CURR, dec(u)) for a, s, u in holding]),
            model_asset=table("model_asset", [(m, s, EXCH, CURR, dec(w)) for m, s, w in weights]),
            queue=table(
                "transact_queue", [(t, a, FUND, CURR, k, dec(v), THEN) for t, a, k, v in queue]
            ),
            rebal_fund=table("rebal_fund", [("R1-1", FUND, CURR, -1, THEN, OPEN)]),
            listing_price=table("listing_price", [(s, EXCH, CURR, dec(p)) for s, p in prices.items()]),
            gate=table("gate", [(CURR, gate)]),
            processed=table("rebal_account", [("R1-1", 1, a, FUND, CURR, 10) for a in processed]),
        )

    return make


def units(run):
    return rows_of(run.adjusted, "accnt_id", "asset_id", "units_adjusted")


def test_plain_allocation(world):
    run = Rebalance(world(cash=[(1, 10, 1000)]), AS_OF)
    assert units(run) == [(1, 1, dec(125)), (1, 2, dec(100))]
    assert rows_of(run.trade, "asset_id", "trtyp_id", "units", "price") == [
        (1, 1, dec(125), dec(4)),
        (2, 1, dec(100), dec(5)),
    ]
    assert rows_of(run.balance, "inv_balance", "cash_balance") == [(dec(1000), dec(0))]


def test_account_without_holdings_or_queue(world):
    audit = Rebalance(world(cash=[(1, 10, None)]), AS_OF).account_audit.first()
    assert audit.new_deposits == audit.new_withdrawals == audit.target_invest_value == 0
    assert audit.current_holdings_count == 0


def test_deposits_withdrawals_and_settlement(world):
    queue = [("a", 1, 1, 700), ("b", 1, 2, 200), ("c", 1, 9, 5), ("d", 2, 1, 1)]
    run = Rebalance(world(cash=[(1, 20, 500)], queue=queue), AS_OF)
    audit = run.account_audit.first()
    assert (audit.new_deposits, audit.new_withdrawals) == (dec(700), dec(200))
    assert audit.target_invest_value == dec(1000)
    assert rows_of(run.transact, "tran_id", "rebal_id") == [("a", "R1-1"), ("b", "R1-1")]
    assert rows_of(run.transact_queue, "tran_id") == [("c",), ("d",)]


def test_rounding_up_overspends_without_trim(world):
    # 15 at price 10 rounds to 2 units; the unrounded value does not exceed 15.
    run = Rebalance(world(cash=[(1, 20, 15)]), AS_OF)
    assert units(run) == [(1, 3, dec(2))]
    assert rows_of(run.balance, "inv_balance", "cash_balance") == [(dec(20), dec(-5))]


def test_rounded_trigger_takes_the_unit_off(world):
    run = Rebalance(world(cash=[(1, 20, 15)]), AS_OF, trigger="rounded")
    assert units(run) == [(1, 3, dec(1))]
    assert rows_of(run.balance, "inv_balance", "cash_balance") == [(dec(10), dec(5))]


def test_exhausted_asset_gets_its_units_back(world):
    # 5 at price 10 rounds to 1 unit; the trim takes it, and it is restored.
    run = Rebalance(world(cash=[(1, 20, 5)]), AS_OF, trigger="rounded")
    assert units(run) == [(1, 3, dec(1))]
    audit = run.account_audit.first()
    assert (audit.rounded_target_invest_value, audit.rebalanced_invest_value) == (dec(0), dec(10))


def test_price_tie_trims_the_lower_asset(world):
    # 30 over two assets at 10: 1.5 units each round to 2 and 2; one unit must go.
    run = Rebalance(world(cash=[(1, 50, 30)]), AS_OF, trigger="rounded")
    assert units(run) == [(1, 3, dec(1)), (1, 4, dec(2))]


def test_holding_outside_the_model_is_sold_at_snapshot_price(world):
    state = world(cash=[(1, 20, 0)], holding=[(1, 1, 10)])
    run = Rebalance(state, AS_OF)
    assert rows_of(run.trade, "asset_id", "trtyp_id", "units", "price") == [
        (1, 2, dec(-10), dec(4)),
        (3, 1, dec(4), dec(10)),
    ]
    assert rows_of(run.holding, "asset_id", "units") == [(3, dec(4))]
    strict = Rebalance(state, AS_OF, strict=True)
    assert strict.trade.count() == 0
    assert rows_of(strict.holding, "asset_id", "units") == [(1, dec(10))]
    assert rows_of(strict.rejects, "key") == [("R1-1/1/1",)]


def test_unpriced_rows_vanish_and_are_reported(world):
    run = Rebalance(world(cash=[(1, 40, 100)], holding=[(1, 6, 7)]), AS_OF)
    assert units(run) == [(1, 1, dec(13))]  # 12.5 rounds up, away from zero
    assert rows_of(run.holding, "asset_id") == [(1,)]
    assert rows_of(run.rejects, "operator", "key") == [("price_holdings", "1/6"), ("price_models", "R1-1/40/6")]


def test_zero_price_sets_only_that_account_aside(world):
    state = world(
        cash=[(1, 30, 100), (2, 10, 1000)], holding=[(1, 1, 3)], queue=[("a", 1, 1, 5)]
    )
    run = Rebalance(state, AS_OF)
    assert rows_of(run.rebal_account, "accnt_id") == [(2,)]
    assert {r[0] for r in rows_of(run.trade, "accnt_id")} == {2}
    assert rows_of(run.rejects, "operator", "key") == [("rebalance", "R1-1/1")]
    assert (1, 1, dec(3)) in rows_of(run.holding, "accnt_id", "asset_id", "units")
    assert rows_of(run.transact_queue, "tran_id") == [("a",)]


def test_negative_target_empties_the_account(world):
    state = world(cash=[(1, 10, 0)], holding=[(1, 1, 10)], queue=[("a", 1, 2, 100)])
    run = Rebalance(state, AS_OF)
    audit = run.account_audit.first()
    assert audit.target_invest_value == dec(-60)
    assert audit.rounded_target_invest_value == dec(0)
    assert audit.rebalanced_invest_value == dec(-62)  # -7.5 and -6 units round to -8 and -6
    assert run.holding.count() == 0


def test_done_accounts_are_not_done_again(world):
    run = Rebalance(world(cash=[(1, 10, 10), (2, 10, 10)], processed=[1]), AS_OF)
    assert rows_of(run.rebal_account, "accnt_id") == [(2,)]


def test_closed_gate_stops_everything(world):
    run = Rebalance(world(cash=[(1, 10, 10)], gate=0), AS_OF)
    assert run.rebal_account.count() == 0 and run.trade.count() == 0


def test_selected_funds_only(world):
    state = world(cash=[(1, 10, 10)])
    assert Rebalance(state, AS_OF, funds_only=[2]).rebal_account.count() == 0
    assert Rebalance(state, AS_OF, funds_only=[1]).rebal_account.count() == 1


def test_one_account_leaves_the_others_alone(world):
    state = world(cash=[(1, 10, 1000), (2, 10, 1000)], queue=[("a", 2, 1, 5)])
    run = Rebalance(state, AS_OF, accounts_only=[1])
    assert rows_of(run.rebal_account, "accnt_id") == [(1,)]
    assert rows_of(run.balance, "accnt_id", "inv_balance", "cash_balance") == [
        (1, dec(1000), dec(0)),
        (2, dec(0), dec(1000)),
    ]
    assert run.transact_queue.count() == 1


def test_amount_out_of_range_is_rejected(world):
    big = "99999999999999"
    run = Rebalance(world(cash=[(1, 10, big), (2, 10, 10)], queue=[("a", 1, 1, big)]), AS_OF)
    assert rows_of(run.rebal_account, "accnt_id") == [(2,)]
    assert rows_of(run.rejects, "key") == [("R1-1/1",)]


def test_holdings_beyond_the_range_set_only_that_account_aside(world):
    state = world(
        cash=[(1, 10, 1000), (2, 10, 1000)], holding=[(1, 1, 30_000_000_000_000), (2, 1, 5)]
    )
    run = Rebalance(state, AS_OF)
    assert rows_of(run.rebal_account, "accnt_id") == [(2,)]
    assert rows_of(run.rebal_rejected, "rebal_id", "accnt_id") == [("R1-1", 1)]
    assert rows_of(run.rejects, "key") == [("R1-1/1",)]


def test_deposits_beyond_the_range_set_only_that_account_aside(world):
    most = 99_999_999_999_999
    state = world(
        cash=[(1, 10, 0), (2, 10, 1000)], queue=[("a", 1, 1, most), ("b", 1, 1, most), ("c", 2, 1, 5)]
    )
    run = Rebalance(state, AS_OF)
    assert rows_of(run.rebal_account, "accnt_id") == [(2,)]
    assert rows_of(run.rebal_rejected, "accnt_id") == [(1,)]
