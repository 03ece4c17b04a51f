"""What a rebalance puts out: trades, holdings, histories and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballast.functions.money import amount, or_zero, zero
from ballast.functions.numbering import continue_after, number_by_id

BUY, SELL = 1, 2


def positions(current: DataFrame, adjusted: DataFrame) -> DataFrame:
    """Current and planned holding of every (account, asset) side by side.

    Both sides are unique on the pair, so the outer join hashes evenly even if
    one account holds a large part of the rows.
    """
    held = current.select(
        "accnt_id",
        "asset_id",
        F.col("rebal_id").alias("c_rebal_id"),
        F.col("model_id").alias("c_model_id"),
        F.col("fund_id").alias("c_fund_id"),
        F.col("exch_code").alias("c_exch_code"),
        F.col("curr_code").alias("c_curr_code"),
        F.col("price").alias("c_price"),
        F.col("units").alias("units_current"),
    )
    planned = adjusted.select(
        "accnt_id",
        "asset_id",
        "rebal_id",
        "model_id",
        "fund_id",
        "exch_code",
        "curr_code",
        F.col("price").alias("t_price"),
        "units_target",
        "units_rounded",
        "units_adjusted",
    )

    def either(name: str) -> Column:
        return F.coalesce(F.col(name), F.col(f"c_{name}")).alias(name)

    return held.join(planned, ["accnt_id", "asset_id"], "full").select(
        either("rebal_id"),
        "accnt_id",
        "asset_id",
        either("model_id"),
        F.coalesce(F.col("c_exch_code"), F.col("exch_code")).alias("exch_code"),
        either("fund_id"),
        either("curr_code"),
        "c_price",
        "t_price",
        "units_current",
        "units_target",
        "units_rounded",
        "units_adjusted",
    )


def asset_audit(position: DataFrame) -> DataFrame:
    """Per asset: current, target, rounded and adjusted units and values."""
    price = F.coalesce("t_price", "c_price")

    def value(units: str) -> Column:
        return amount(F.col(units) * price)

    return position.select(
        "rebal_id",
        "accnt_id",
        "asset_id",
        "model_id",
        "exch_code",
        "fund_id",
        "curr_code",
        price.alias("price"),
        "units_current",
        value("units_current").alias("value_current"),
        "units_target",
        value("units_target").alias("value_target"),
        "units_rounded",
        value("units_rounded").alias("value_rounded"),
        "units_adjusted",
        value("units_adjusted").alias("value_adjusted"),
    )


def make_trades(assets: DataFrame, as_of: str, model_price_only: bool = False) -> DataFrame:
    """Buy (1) or sell (2) the difference between current and adjusted units of
    the rows of :func:`asset_audit`; sold units are negative.

    An asset outside the model is sold at its snapshot price. With
    ``model_price_only`` its price stays NULL, so that the NOT NULL check on
    trades can report it.
    """
    delta = or_zero(F.col("units_adjusted")) - or_zero(F.col("units_current"))
    kind = F.when(F.col("units") > 0, F.lit(BUY)).otherwise(F.lit(SELL))
    price = F.col("price")
    if model_price_only:
        price = F.when(F.col("units_target").isNotNull(), price)
    return (
        assets.withColumn("units", amount(delta))
        .filter(F.col("units") != 0)
        .select(
            "rebal_id",
            "accnt_id",
            "asset_id",
            kind.cast("bigint").alias("trtyp_id"),
            "exch_code",
            "fund_id",
            "curr_code",
            "units",
            price.alias("price"),
            F.lit(as_of).cast("timestamp_ntz").alias("trade_time"),
        )
    )


def _bought(adjusted: DataFrame) -> DataFrame:
    return adjusted.filter(F.col("units_adjusted") > 0)


def new_holdings(adjusted: DataFrame) -> DataFrame:
    """Holdings of the rebalanced accounts: positive adjusted units."""
    return _bought(adjusted).select(
        "accnt_id",
        "asset_id",
        "fund_id",
        "exch_code",
        "curr_code",
        F.col("units_adjusted").alias("units"),
    )


def replace_holdings(holding: DataFrame, adjusted: DataFrame, done: DataFrame) -> DataFrame:
    """Untouched accounts keep their rows; done accounts get the new ones."""
    kept = holding.join(done.select("accnt_id"), "accnt_id", "left_anti")
    return kept.select(
        "accnt_id", "asset_id", "fund_id", "exch_code", "curr_code", "units"
    ).unionByName(new_holdings(adjusted))


def holding_history(adjusted: DataFrame) -> DataFrame:
    """The new holdings stamped with their rebalance."""
    return _bought(adjusted).select(
        "accnt_id",
        "rebal_id",
        "asset_id",
        "fund_id",
        "exch_code",
        "curr_code",
        F.col("units_adjusted").alias("units"),
    )


def replace_balances(balance: DataFrame, summary: DataFrame) -> DataFrame:
    """Balances after the rebalance; accounts that were not done keep theirs."""
    fresh = summary.select(
        "accnt_id",
        F.col("rebalanced_invest_value").alias("new_inv"),
        F.col("rebalanced_cash_balance").alias("new_cash"),
    )
    return balance.join(fresh, "accnt_id", "left").select(
        "accnt_id",
        "inv_id",
        "curr_code",
        "fund_id",
        "model_id",
        F.coalesce("new_inv", "inv_balance", zero()).alias("inv_balance"),
        F.coalesce("new_cash", "cash_balance", zero()).alias("cash_balance"),
    )


def balance_history(summary: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Log row per rebalanced account; ids go on from the earlier log."""
    rows = number_by_id(
        summary.select(
            "rebal_id",
            "accnt_id",
            "fund_id",
            "curr_code",
            F.col("rebalanced_invest_value").alias("inv_balance"),
            F.col("rebalanced_cash_balance").alias("cash_balance"),
        ),
        "accnt_id",
        "number",
    )
    return rows.select(
        (F.col("number") + continue_after(earlier, "id")).alias("id"),
        "rebal_id",
        "accnt_id",
        "fund_id",
        "curr_code",
        "inv_balance",
        "cash_balance",
    )


def account_audit(summary: DataFrame, as_of: str) -> DataFrame:
    """The ten figures of each rebalanced account."""
    now = F.lit(as_of).cast("timestamp_ntz")
    return summary.select(
        "rebal_id",
        "fund_id",
        "curr_code",
        "accnt_id",
        now.alias("start_dt"),
        F.col("inv_balance").alias("current_inv_balance"),
        "current_holdings_count",
        "current_holdings_value",
        F.col("cash_balance").alias("current_cash_balance"),
        "new_deposits",
        "new_withdrawals",
        "target_invest_value",
        "rounded_target_invest_value",
        "rebalanced_invest_value",
        "rebalanced_cash_balance",
        now.alias("end_dt"),
    )


def rebalance_accounts(done: DataFrame) -> DataFrame:
    """Marker: which account was handled by which rebalance."""
    return done.select(
        "rebal_id",
        F.lit(1).cast("bigint").alias("item_no"),
        "accnt_id",
        "fund_id",
        "curr_code",
        "model_id",
    )
