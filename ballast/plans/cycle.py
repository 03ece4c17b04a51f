"""Closing finished rebalances and opening the next ones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ballast.functions.sizing import sized_broadcast
from ballast.operators import funds, valuation


@dataclass
class CloseResult:
    rebal_fund: DataFrame
    fund_balance: DataFrame
    fund_balance_history: DataFrame
    price_snapshot: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(vars(self))


def close_rebalances(
    account: DataFrame,
    balance: DataFrame,
    fund_balance: DataFrame,
    rebal_fund: DataFrame,
    processed: DataFrame,
    listing_price: DataFrame,
    as_of: str,
    earlier: DataFrame | None = None,
    rejected: DataFrame | None = None,
) -> CloseResult:
    """Close every open rebalance without remaining accounts: log the fund total,
    count the close, stamp the header, open the successor and freeze its prices.
    ``earlier`` is the fund log so far; ``rejected`` accounts do not remain."""
    progress = funds.rebalance_progress(account, rebal_fund, processed, rejected)
    closing = funds.finished(progress, rebal_fund)
    rolled = funds.roll_rebalances(rebal_fund, closing, as_of)
    opened = funds.open_rebalances(rolled).join(
        rebal_fund.select("rebal_id"), "rebal_id", "left_anti"
    )
    return CloseResult(
        rebal_fund=rolled,
        fund_balance=funds.count_closes(fund_balance, closing),
        fund_balance_history=funds.fund_balance_history(balance, closing, as_of, earlier),
        price_snapshot=valuation.price_snapshot(listing_price, sized_broadcast(opened)),
    )
