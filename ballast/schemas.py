"""Explicit schemas of every table; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "short": T.ShortType(),
    "string": T.StringType(),
    "time": T.TimestampNTZType(),
    "amount": T.DecimalType(20, 6),
    "weight": T.DecimalType(9, 6),
}


def _table(spec: str) -> T.StructType:
    """``name type`` pairs, comma separated; a trailing ``?`` allows NULL."""
    fields = []
    for item in spec.split(","):
        name, kind = item.split()
        fields.append(T.StructField(name, _TYPES[kind.rstrip("?")], kind.endswith("?")))
    return T.StructType(fields)


_AUDIT_ASSET = (
    "rebal_id string, accnt_id long, asset_id long, model_id long, exch_code string,"
    "fund_id long, curr_code string, price amount?, units_current amount?, value_current amount?,"
    "units_target amount?, value_target amount?, units_rounded amount?, value_rounded amount?,"
    "units_adjusted amount?, value_adjusted amount?"
)

TABLES: dict[str, T.StructType] = {
    "currency": _table("curr_code string, curr_name string"),
    "fund": _table("fund_id long, fund_name string, curr_code string"),
    "fund_balance": _table("fund_id long, curr_code string, balance amount"),
    "investor": _table("inv_id long, inv_name string"),
    "exchange": _table(
        "exch_code string, exch_name string, isin_prefix string, curr_code string, list_count long"
    ),
    "asset_class": _table("class_code string, class_name string"),
    "asset": _table("asset_id long, isin_code string?, asset_name string, class_code string"),
    "listing": _table(
        "asset_id long, exch_code string, isin_code string, curr_code string, list_no long"
    ),
    "listing_price": _table("asset_id long, exch_code string, curr_code string, price amount"),
    "advisor": _table("advisor_id long, advisor_name string"),
    "model": _table(
        "model_id long, model_name string, advisor_id long, curr_code string, assets_count int?"
    ),
    "model_asset": _table(
        "model_id long, asset_id long, exch_code string, curr_code string, weighting weight"
    ),
    "account": _table(
        "accnt_id long, inv_id long, curr_code string, fund_id long, model_id long"
    ),
    "balance": _table(
        "accnt_id long, inv_id long, curr_code string, fund_id long, model_id long,"
        "inv_balance amount?, cash_balance amount?"
    ),
    "holding": _table(
        "accnt_id long, asset_id long, fund_id long, exch_code string, curr_code string,"
        "units amount"
    ),
    "transact_queue": _table(
        "tran_id string, accnt_id long, fund_id long, curr_code string, tx_type long,"
        "amount amount, queued_dt time"
    ),
    "transact": _table(
        "tran_id string, accnt_id long, fund_id long, curr_code string, tx_type long,"
        "amount amount, queued_dt time, rebal_id string?, processed_dt time"
    ),
    "account_queue": _table("queue_no long, fund_id long, curr_code string, accnt_id long"),
    "rebal_fund": _table(
        "rebal_id string, fund_id long, curr_code string, accnts_count long, start_dt time,"
        "end_dt time"
    ),
    "rebal_account": _table(
        "rebal_id string, item_no long, accnt_id long, fund_id long, curr_code string,"
        "model_id long"
    ),
    "rebal_rejected": _table(
        "rebal_id string, fund_id long, accnt_id long, curr_code string, model_id long"
    ),
    "price_snapshot": _table(
        "rebal_id string, fund_id long, asset_id long, exch_code string, curr_code string,"
        "price amount"
    ),
    "gate": _table("curr_code string, gate_status short"),
    "gate_closed": _table("curr_code string, closed_from time, closed_to time"),
    "price_tick": _table(
        "event_id long, ts time, asset_id long, exch_code string, curr_code string, variance long"
    ),
    "listing_price_history": _table(
        "id long, asset_id long, exch_code string, curr_code string, price_dt time,"
        "price_pre amount, price_post amount"
    ),
    "trade_type": _table("trtyp_id long, trtyp_name string"),
    "transact_type": _table("tx_type long, tx_name string"),
    "trade": _table(
        "rebal_id string, accnt_id long, asset_id long, trtyp_id long, exch_code string,"
        "fund_id long, curr_code string, units amount, price amount, trade_time time"
    ),
    "holding_history": _table(
        "accnt_id long, rebal_id string, asset_id long, fund_id long, exch_code string,"
        "curr_code string, units amount"
    ),
    "balance_history": _table(
        "id long, rebal_id string, accnt_id long, fund_id long, curr_code string, inv_balance amount,"
        "cash_balance amount"
    ),
    "fund_balance_history": _table(
        "id long, fund_id long, rebal_id string, curr_code string, log_dt time, balance amount"
    ),
    "account_asset": _table(_AUDIT_ASSET),
    "account_asset_history": _table("history_id long," + _AUDIT_ASSET),
    "account_asset_archive": _table("history_id long," + _AUDIT_ASSET),
    "account_audit": _table(
        "rebal_id string, fund_id long, curr_code string, accnt_id long, start_dt time,"
        "current_inv_balance amount, current_holdings_count long, current_holdings_value amount,"
        "current_cash_balance amount, new_deposits amount, new_withdrawals amount,"
        "target_invest_value amount, rounded_target_invest_value amount,"
        "rebalanced_invest_value amount, rebalanced_cash_balance amount, end_dt time?"
    ),
    "rejects": _table("operator string, key string, reason string"),
}

# Key columns of each stored table; used by the quality checks.
KEYS: dict[str, list[str]] = {
    "currency": ["curr_code"],
    "fund": ["fund_id"],
    "fund_balance": ["fund_id"],
    "investor": ["inv_id"],
    "exchange": ["exch_code"],
    "asset_class": ["class_code"],
    "asset": ["asset_id"],
    "listing": ["asset_id", "exch_code", "curr_code"],
    "listing_price": ["asset_id", "exch_code", "curr_code"],
    "advisor": ["advisor_id"],
    "model": ["model_id"],
    "model_asset": ["model_id", "asset_id"],
    "account": ["accnt_id"],
    "balance": ["accnt_id"],
    "holding": ["accnt_id", "asset_id"],
    "transact_queue": ["tran_id"],
    "transact": ["tran_id"],
    "account_queue": ["fund_id", "queue_no"],
    "rebal_fund": ["fund_id", "end_dt"],
    "rebal_account": ["rebal_id", "accnt_id"],
    "rebal_rejected": ["rebal_id", "accnt_id"],
    "price_snapshot": ["rebal_id", "asset_id", "exch_code", "curr_code"],
    "trade_type": ["trtyp_id"],
    "transact_type": ["tx_type"],
    "gate": ["curr_code"],
    "trade": ["rebal_id", "accnt_id", "asset_id", "trtyp_id"],
    "holding_history": ["rebal_id", "accnt_id", "asset_id"],
    "balance_history": ["accnt_id", "rebal_id"],
    "fund_balance_history": ["fund_id", "rebal_id"],
    "account_asset": ["rebal_id", "accnt_id", "asset_id"],
    "account_asset_history": ["history_id"],
    "account_asset_archive": ["history_id"],
    "account_audit": ["rebal_id", "accnt_id"],
}

# Further columns that must be unique.
UNIQUE: dict[str, list[list[str]]] = {
    "currency": [["curr_name"]],
    "fund": [["fund_name"]],
    "investor": [["inv_name"]],
    "exchange": [["exch_name"]],
    "asset_class": [["class_name"]],
    "asset": [["asset_name"]],
    "advisor": [["advisor_name"]],
    "model": [["model_name"]],
    "trade_type": [["trtyp_name"]],
    # Only one rebalance of a fund is open, as open ones share their end.
    "rebal_fund": [["rebal_id"]],
    "account_asset_archive": [["rebal_id", "accnt_id", "asset_id"]],
}

_ACCOUNT = ["accnt_id", "fund_id", "curr_code"]
_LISTING = ["asset_id", "exch_code", "curr_code"]
_REBAL = ["rebal_id", "fund_id", "curr_code"]
_DONE = ["rebal_id", "accnt_id", "fund_id", "curr_code"]

# Foreign keys: child, parent, shared columns.
FOREIGN_KEYS: list[tuple[str, str, list[str]]] = [
    ("fund", "currency", ["curr_code"]),
    ("fund_balance", "fund", ["fund_id", "curr_code"]),
    ("exchange", "currency", ["curr_code"]),
    ("asset", "asset_class", ["class_code"]),
    ("listing", "asset", ["asset_id"]),
    ("listing", "exchange", ["exch_code", "curr_code"]),
    ("listing_price", "listing", _LISTING),
    ("model", "advisor", ["advisor_id"]),
    ("model_asset", "model", ["model_id", "curr_code"]),
    ("model_asset", "listing", _LISTING),
    ("account", "investor", ["inv_id"]),
    ("account", "currency", ["curr_code"]),
    ("account", "model", ["model_id", "curr_code"]),
    ("account", "fund", ["fund_id", "curr_code"]),
    ("balance", "account", _ACCOUNT),
    ("balance_history", "account", _ACCOUNT),
    ("rebal_fund", "fund", ["fund_id", "curr_code"]),
    ("price_snapshot", "rebal_fund", _REBAL),
    ("price_snapshot", "listing", _LISTING),
    ("fund_balance_history", "fund", ["fund_id", "curr_code"]),
    ("fund_balance_history", "rebal_fund", _REBAL),
    ("rebal_account", "rebal_fund", _REBAL),
    ("rebal_account", "account", _ACCOUNT),
    ("account_audit", "rebal_account", _DONE),
    ("account_asset", "rebal_account", _DONE),
    ("holding", "account", _ACCOUNT),
    ("holding", "listing", _LISTING),
    ("listing_price_history", "listing", _LISTING),
    ("trade", "price_snapshot", ["rebal_id", *_LISTING]),
    ("trade", "trade_type", ["trtyp_id"]),
    ("trade", "rebal_account", _DONE),
    ("transact_queue", "account", _ACCOUNT),
    ("transact_queue", "transact_type", ["tx_type"]),
    ("transact", "account", _ACCOUNT),
    ("transact", "rebal_account", _DONE),
    ("transact", "transact_type", ["tx_type"]),
]
