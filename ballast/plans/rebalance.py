"""One rebalance of every due account, as a set of lazy DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballast.functions.sizing import sized_broadcast, sized_lookup
from ballast.operators import allocation, cash, funds, quality, trades, valuation


@dataclass
class Portfolio:
    """State before the rebalance. ``snapshot`` is the frozen price table; where
    it is missing the current listing prices are frozen for the open rebalances."""

    balance: DataFrame
    holding: DataFrame
    model_asset: DataFrame
    queue: DataFrame
    rebal_fund: DataFrame
    listing_price: DataFrame | None = None
    snapshot: DataFrame | None = None
    gate: DataFrame | None = None
    processed: DataFrame | None = None
    balance_history: DataFrame | None = None
    rejected: DataFrame | None = None


class Rebalance:
    """Values, allocates, trims and trades for every due account.

    Each attribute is a DataFrame that is planned when first asked for, so a
    caller who wants the trades pays for nothing else.

    ``trigger``     what the trim compares with the target, see ``trim_to_budget``
    ``strict``      set aside accounts that hold an asset outside their model
                    instead of selling it at the snapshot price
    ``funds_only``, ``accounts_only``  restrict to these ids
    ``stage``       may write a frame that several outputs share and return the
                    stored copy; the label of an output is its table name
    """

    # In the order in which their inputs become ready.
    OUTPUTS = (
        "rebal_account",
        "rebal_rejected",
        "transact",
        "transact_queue",
        "rejects",
        "holding_history",
        "holding",
        "account_asset",
        "trade",
        "account_audit",
        "balance",
        "balance_history",
    )

    def __init__(
        self,
        state: Portfolio,
        as_of: str,
        trigger: str = "unrounded",
        strict: bool = False,
        funds_only: list[int] | None = None,
        accounts_only: list[int] | None = None,
        stage: Callable[[DataFrame, str], DataFrame] | None = None,
        window_rows: int = allocation.WINDOW_ROWS,
    ):
        self.state = state
        self.as_of = as_of
        self.trigger = trigger
        self.strict = strict
        self.stage = stage or (lambda df, label: df)
        self.stored = stage is not None
        self.window_rows = window_rows
        headers = state.rebal_fund
        if funds_only is not None:
            headers = headers.filter(F.col("fund_id").isin(funds_only))
        self.headers = headers
        self.balances = state.balance
        if accounts_only is not None:
            self.balances = self.balances.filter(F.col("accnt_id").isin(accounts_only))

    def outputs(self) -> Iterator[tuple[str, DataFrame]]:
        """New state (``holding``, ``balance``, ``transact_queue``) and rows to append
        (the rest), each planned as it is reached."""
        for name in self.OUTPUTS:
            yield name, getattr(self, name)

    # shared steps

    @cached_property
    def open_headers(self) -> DataFrame:
        """Open rebalances, at most one per fund."""
        return sized_broadcast(funds.open_rebalances(self.headers))

    @cached_property
    def due(self) -> DataFrame:
        state = self.state
        running = funds.running_rebalances(self.open_headers, state.gate)
        processed = state.processed
        if processed is not None:
            # Of the whole history only the open rebalances matter.
            processed = processed.join(self.open_headers, "rebal_id", "left_semi")
        return funds.accounts_due(self.balances, running, processed)

    @cached_property
    def snapshot(self) -> DataFrame:
        """Frozen prices of the open rebalances."""
        frozen = self.state.snapshot
        if frozen is None:
            frozen = valuation.price_snapshot(self.state.listing_price, self.open_headers)
        else:
            frozen = frozen.join(self.open_headers, "rebal_id", "left_semi")
        return sized_lookup(frozen)

    @cached_property
    def matched(self) -> DataFrame:
        matched = valuation.match_holdings(self.state.holding, self.due, self.snapshot)
        return self.stage(matched, "matched")

    @cached_property
    def current(self) -> DataFrame:
        return valuation.price_holdings(self.matched)

    @cached_property
    def priced_models(self) -> tuple[DataFrame, DataFrame]:
        return allocation.price_models(self.state.model_asset, self.snapshot, self.window_rows)

    @cached_property
    def judged(self) -> DataFrame:
        """Target of every due account, and whether its plan can be stored."""
        value = valuation.value_holdings(self.current)
        queued = valuation.queued_cash(self.state.queue)
        target = valuation.target_balance(self.due, value, queued)
        return self.stage(allocation.judge(target, self.priced_models[1]), "judged")

    @cached_property
    def unpriced_models(self) -> DataFrame:
        """Assets without a snapshot price, once per rebalance and model of a due account;
        the accounts are combined before they meet the models' assets."""
        used = self.judged.select("rebal_id", "model_id").distinct()
        prices = self.snapshot.select("rebal_id", "asset_id", "exch_code", "curr_code")
        return (
            self.state.model_asset.select("model_id", "asset_id", "exch_code", "curr_code")
            .join(used, "model_id")
            .join(prices, ["rebal_id", "asset_id", "exch_code", "curr_code"], "left_anti")
        )

    @cached_property
    def outside(self) -> DataFrame:
        """Held assets that the account's model does not contain."""
        modelled = self.state.model_asset.select("model_id", "asset_id")
        return self.current.join(modelled, ["model_id", "asset_id"], "left_anti").select(
            "rebal_id", "accnt_id", "asset_id"
        )

    @cached_property
    def target(self) -> DataFrame:
        """Targets of the accounts that go through. Decided before the assets are
        spread out, so nothing after this has to look back."""
        sound = self.judged.filter("sound").drop("sound")
        if self.strict:
            strays = self.outside.select("accnt_id").distinct()
            sound = sound.join(strays, "accnt_id", "left_anti")
        return sound

    @cached_property
    def done(self) -> DataFrame:
        return self.target.select("rebal_id", "accnt_id", "fund_id", "curr_code", "model_id")

    @cached_property
    def rounded(self) -> DataFrame:
        """One row per account and priced asset of its model."""
        target = self.target
        if self.stored:
            # A stored copy has lost its partitioning. Restoring it here moves one
            # row per account; the trim would otherwise move all their assets.
            target = target.repartition("accnt_id")
        allocated = allocation.allocate(target, self.priced_models[0])
        return allocation.round_units(allocated)

    @cached_property
    def adjusted(self) -> DataFrame:
        trimmed = allocation.trim_to_budget(self.rounded, self.trigger)
        return self.stage(trimmed.drop("target_invest_value", "weighting", "value_target"), "adjusted")

    @cached_property
    def summary(self) -> DataFrame:
        return self.stage(allocation.new_balances(self.target, self.adjusted), "summary")

    @cached_property
    def position(self) -> DataFrame:
        # Holdings of accounts that were set aside must not look like sales.
        held = self.current.join(self.done.select("accnt_id"), "accnt_id", "left_semi")
        return trades.positions(held, self.adjusted)

    # new state

    @cached_property
    def holding(self) -> DataFrame:
        return trades.replace_holdings(self.state.holding, self.adjusted, self.done)

    @cached_property
    def balance(self) -> DataFrame:
        return trades.replace_balances(self.state.balance, self.summary)

    @cached_property
    def transact_queue(self) -> DataFrame:
        return cash.queue_remaining(self.state.queue, self.done)

    # rows to append

    @cached_property
    def trade(self) -> DataFrame:
        return trades.make_trades(self.account_asset, self.as_of)

    @cached_property
    def holding_history(self) -> DataFrame:
        return trades.holding_history(self.adjusted)

    @cached_property
    def balance_history(self) -> DataFrame:
        return trades.balance_history(self.summary, self.state.balance_history)

    @cached_property
    def account_asset(self) -> DataFrame:
        return self.stage(trades.asset_audit(self.position), "account_asset")

    @cached_property
    def account_audit(self) -> DataFrame:
        return trades.account_audit(self.summary, self.as_of)

    @cached_property
    def rebal_account(self) -> DataFrame:
        return trades.rebalance_accounts(self.done)

    @cached_property
    def rebal_rejected(self) -> DataFrame:
        """Accounts set aside, unless an earlier run has stored that. They stay due, but do
        not keep their fund open."""
        columns = ["rebal_id", "fund_id", "accnt_id", "curr_code", "model_id"]
        gone = self.target.select("rebal_id", "accnt_id")
        rows = self.judged.select(columns).join(gone, ["rebal_id", "accnt_id"], "left_anti")
        if self.state.rejected is not None:
            told = self.state.rejected.join(self.open_headers, "rebal_id", "left_semi")
            rows = rows.join(told.select("rebal_id", "accnt_id"), ["rebal_id", "accnt_id"], "left_anti")
        return rows

    @cached_property
    def transact(self) -> DataFrame:
        return cash.settle_queue(self.state.queue, self.done, self.as_of)

    @cached_property
    def rejects(self) -> DataFrame:
        """Accounts set aside, and a warning per holding, and per asset of a model in use,
        without a price."""
        account = [F.col("rebal_id"), F.col("accnt_id")]
        rows = quality.reject(
            self.judged.filter("not sound"),
            "rebalance",
            account,
            "zero price or figure out of range",
        ).unionByName(
            quality.reject(
                valuation.unpriced_holdings(self.matched),
                "price_holdings",
                [F.col("accnt_id"), F.col("asset_id")],
                "warning: no snapshot price",
            )
        )
        rows = rows.unionByName(
            quality.reject(
                self.unpriced_models,
                "price_models",
                [F.col("rebal_id"), F.col("model_id"), F.col("asset_id")],
                "warning: no snapshot price",
            )
        )
        if self.strict:
            rows = rows.unionByName(
                quality.reject(
                    self.outside, "make_trades", [*account, F.col("asset_id")], "asset outside the model"
                )
            )
        return rows
