"""The registered queries once more, as DuckDB SQL over the raw tables.

Amounts are computed as whole millionths (HUGEINT), and the trim takes one unit
per recursion step, so these share no arithmetic and no algorithm with the
Spark operators.
"""

from __future__ import annotations

AS_OF = "2024-02-01 00:00:00"


def money(micros: str) -> str:
    """Whole millionths as DECIMAL(20,6)."""
    return f"CAST(CAST({micros} AS DECIMAL(20,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(20,6))"


def micros(amount: str) -> str:
    return f"CAST(CAST({amount} AS DECIMAL(20,6)) * CAST(1000000 AS DECIMAL(7,0)) AS HUGEINT)"


def half_up(numerator: str, denominator: str) -> str:
    """Half away from zero, for a positive denominator."""
    return (
        f"(CASE WHEN ({numerator}) < 0 THEN -1 ELSE 1 END"
        f" * ((2 * abs({numerator}) + ({denominator})) // (2 * ({denominator}))))"
    )


_VIEWS = f"""
blocks AS (SELECT max(p_partkey) // 100 + 1 AS n FROM part),
account AS (
  SELECT c_custkey AS accnt_id, c_custkey AS inv_id, 'C' || n_regionkey AS curr_code,
         CAST(c_nationkey + 1 AS BIGINT) AS fund_id, n_regionkey AS home,
         CAST((c_custkey % blocks.n) * 5 + n_regionkey + 1 AS BIGINT) AS model_id,
         CAST(0 AS DECIMAL(20,6)) AS inv_balance, CAST(c_acctbal AS DECIMAL(20,6)) AS cash_balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey CROSS JOIN blocks),
fund AS (
  SELECT CAST(n_nationkey + 1 AS BIGINT) AS fund_id, n_name AS fund_name,
         'C' || n_regionkey AS curr_code FROM nation),
listing AS (
  SELECT p_partkey AS asset_id, 'X' || (p_partkey % 5) AS exch_code, 'C' || (p_partkey % 5) AS curr_code,
         CAST(p_retailprice AS DECIMAL(20,6)) AS price, {micros('p_retailprice')} AS p
  FROM part WHERE p_size % 25 <> 7),
sizes AS (
  SELECT (p_partkey // 100) * 5 + p_partkey % 5 + 1 AS model_id, p_partkey AS asset_id,
         'X' || (p_partkey % 5) AS exch_code, 'C' || (p_partkey % 5) AS curr_code,
         CAST(p_size AS BIGINT) AS size FROM part),
shares AS (
  SELECT *, (1000000 * size) // (sum(size) OVER (PARTITION BY model_id)) AS share,
         row_number() OVER (PARTITION BY model_id ORDER BY asset_id DESC) AS from_end FROM sizes),
model_asset AS (
  SELECT model_id, asset_id, exch_code, curr_code,
         CASE WHEN from_end = 1 THEN 1000000 - (sum(share) OVER (PARTITION BY model_id)) + share
              ELSE share END AS w FROM shares),
model AS (SELECT DISTINCT model_id, curr_code FROM sizes),
holding AS (
  SELECT accnt_id, l_partkey AS asset_id, fund_id, 'X' || home AS exch_code, curr_code,
         CAST(sum(CAST(l_quantity AS DECIMAL(20,6))) AS DECIMAL(20,6)) AS units
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN account ON accnt_id = o_custkey AND l_partkey % 5 = home
  GROUP BY accnt_id, l_partkey, fund_id, home, curr_code),
movement AS (
  SELECT 'T' || o_orderkey AS tran_id, o_custkey AS accnt_id, fund_id, curr_code, o_orderstatus AS status,
         CAST(CASE o_orderstatus WHEN 'P' THEN 2 ELSE 1 END AS BIGINT) AS tx_type,
         CASE o_orderstatus
           WHEN 'P' THEN 10000 * ((CAST(round(o_totalprice * 100) AS HUGEINT) + 5) // 10)
           ELSE {micros('o_totalprice')} END AS a,
         o_orderdate AS queued_dt
  FROM orders JOIN account ON accnt_id = o_custkey),
queue AS (
  SELECT tran_id, accnt_id, fund_id, curr_code, tx_type, a, {money('a')} AS amount, queued_dt
  FROM movement WHERE status IN ('O', 'P')),
rebal AS (
  SELECT 'R' || fund_id || '-1' AS rebal_id, fund_id, curr_code, CAST(-1 AS BIGINT) AS accnts_count,
         TIMESTAMP '2024-01-01 00:00:00' AS start_dt, TIMESTAMP '1900-01-01 00:00:00' AS end_dt
  FROM fund),
snapshot AS (
  SELECT rebal_id, fund_id, asset_id, exch_code, listing.curr_code, price, p
  FROM rebal JOIN listing ON rebal.curr_code = listing.curr_code
  WHERE end_dt = TIMESTAMP '1900-01-01 00:00:00'),
held AS (
  SELECT s.rebal_id, h.accnt_id, h.asset_id, h.exch_code, h.curr_code, h.fund_id, a.model_id,
         h.units, s.price, s.p, {micros('h.units')} AS u
  FROM holding h JOIN account a USING (accnt_id)
  JOIN snapshot s ON s.fund_id = h.fund_id AND s.asset_id = h.asset_id
       AND s.exch_code = h.exch_code AND s.curr_code = h.curr_code),
worth AS (
  SELECT accnt_id, {half_up('sum(u * p)', '1000000')} AS v, count(*) AS n FROM held GROUP BY accnt_id),
queued AS (
  SELECT accnt_id, coalesce(sum(a) FILTER (WHERE tx_type = 1), 0) AS dep,
         coalesce(sum(a) FILTER (WHERE tx_type = 2), 0) AS wd FROM queue GROUP BY accnt_id),
target AS (
  SELECT r.rebal_id, c.accnt_id, c.fund_id, c.curr_code, c.model_id, c.inv_balance, c.cash_balance,
         coalesce(v, 0) AS v, coalesce(n, 0) AS n, coalesce(dep, 0) AS dep, coalesce(wd, 0) AS wd,
         coalesce(v, 0) + {micros('c.cash_balance')} + coalesce(dep, 0) - coalesce(wd, 0) AS t
  FROM account c JOIN rebal r ON r.fund_id = c.fund_id
  LEFT JOIN worth ON worth.accnt_id = c.accnt_id LEFT JOIN queued ON queued.accnt_id = c.accnt_id),
alloc AS (
  SELECT t.rebal_id, t.accnt_id, t.fund_id, t.curr_code, t.model_id, m.asset_id, m.exch_code, m.w, s.price,
         s.p, t.t, {half_up('t.t * m.w', 's.p')} AS u
  FROM target t JOIN model_asset m ON m.model_id = t.model_id
  JOIN snapshot s ON s.fund_id = t.fund_id AND s.asset_id = m.asset_id
       AND s.exch_code = m.exch_code AND s.curr_code = m.curr_code),
whole AS (SELECT *, {half_up('u', '1000000')} AS r, {half_up('u * p', '1000')} AS v9 FROM alloc),
plan AS (
  SELECT accnt_id, any_value(t) AS t, {half_up('coalesce(sum(v9) FILTER (WHERE r > 0), 0)', '1000')} AS unrounded,
         coalesce(sum(r * p) FILTER (WHERE r >= 1), 0) AS rounded,
         count(*) FILTER (WHERE r >= 1) AS trimmable
  FROM whole GROUP BY accnt_id),
ranked AS (
  SELECT accnt_id, asset_id, r, p,
         row_number() OVER (PARTITION BY accnt_id ORDER BY p, asset_id) AS k FROM whole WHERE r >= 1)
"""


# Ticks outside the closed gates, folded one after the other per listing.
_TICKS = f"""
closed AS (
  SELECT 'C' || r_regionkey AS curr_code,
         TIMESTAMP '2024-01-05 00:00:00' + to_days(CAST(r_regionkey AS INTEGER)) AS closed_from,
         TIMESTAMP '2024-01-05 06:00:00' + to_days(CAST(r_regionkey AS INTEGER)) AS closed_to
  FROM region),
tick AS (
  SELECT event_id, ts, user_id AS asset_id, 'X' || (user_id % 5) AS exch_code,
         'C' || (user_id % 5) AS curr_code, CAST(floor(value) AS BIGINT) % 21 - 10 AS variance
  FROM events),
passed AS (
  SELECT tick.* FROM tick WHERE NOT EXISTS (
    SELECT 1 FROM closed WHERE closed.curr_code = tick.curr_code
    AND tick.ts >= closed.closed_from AND tick.ts < closed.closed_to)),
nth AS (
  SELECT passed.*, row_number() OVER (PARTITION BY passed.asset_id ORDER BY ts, event_id) AS k
  FROM passed JOIN listing ON listing.asset_id = passed.asset_id),
walk AS (
  SELECT asset_id, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS event_id, p AS pre, p AS post FROM listing
  UNION ALL
  SELECT w.asset_id, n.k, n.event_id, w.post, {half_up('w.post * (100 + n.variance)', '100')}
  FROM walk w JOIN nth n ON n.asset_id = w.asset_id AND n.k = w.k + 1),
final AS (SELECT asset_id, arg_max(post, k) AS post FROM walk GROUP BY asset_id),
history AS (
  SELECT n.event_id AS id, n.asset_id, n.exch_code, n.curr_code, n.ts AS price_dt, w.pre, w.post
  FROM walk w JOIN nth n ON n.asset_id = w.asset_id AND n.k = w.k)
"""


def _trim(trigger: str, name: str) -> str:
    """One unit off per step, cheapest first, until affordable."""
    return f"""
{name}_steps AS (
  SELECT plan.accnt_id, ranked.k, CAST(1 AS HUGEINT) AS taken, ranked.r, plan.trimmable AS last_k,
         plan.rounded - ranked.p AS s, plan.t, 1 AS step
  FROM plan JOIN ranked ON ranked.accnt_id = plan.accnt_id AND ranked.k = 1
  WHERE plan.{trigger} > plan.t
  UNION ALL
  SELECT x.accnt_id, y.k, CASE WHEN y.k = x.k THEN x.taken + 1 ELSE 1 END, y.r, x.last_k, x.s - y.p, x.t, x.step + 1
  FROM {name}_steps x JOIN ranked y ON y.accnt_id = x.accnt_id
       AND y.k = CASE WHEN x.taken < x.r THEN x.k ELSE x.k + 1 END
  WHERE x.s > x.t),
{name}_end AS (
  SELECT accnt_id, arg_max(k, step) AS k, arg_max(taken, step) AS taken, arg_max(s, step) AS s
  FROM {name}_steps GROUP BY accnt_id),
{name} AS (
  SELECT w.*, CASE WHEN e.k = q.k AND e.taken < w.r THEN w.r - e.taken ELSE w.r END AS adj
  FROM whole w LEFT JOIN ranked q ON q.accnt_id = w.accnt_id AND q.asset_id = w.asset_id
  LEFT JOIN {name}_end e ON e.accnt_id = w.accnt_id)"""


_RESULT = f"""
invested AS (SELECT accnt_id, sum(adj * p) AS inv FROM trimmed GROUP BY accnt_id),
summary AS (
  SELECT t.*, coalesce(e.s, p.unrounded, 0) AS plan_value, coalesce(i.inv, 0) AS inv,
         t.t - coalesce(i.inv, 0) AS cash
  FROM target t LEFT JOIN invested i ON i.accnt_id = t.accnt_id
  LEFT JOIN plan p ON p.accnt_id = t.accnt_id LEFT JOIN trimmed_end e ON e.accnt_id = t.accnt_id),
position AS (
  SELECT coalesce(h.rebal_id, t.rebal_id) AS rebal_id, coalesce(h.accnt_id, t.accnt_id) AS accnt_id,
         coalesce(h.asset_id, t.asset_id) AS asset_id, coalesce(t.model_id, h.model_id) AS model_id,
         coalesce(h.exch_code, t.exch_code) AS exch_code, coalesce(t.fund_id, h.fund_id) AS fund_id,
         coalesce(t.curr_code, h.curr_code) AS curr_code, coalesce(t.p, h.p) AS p, t.p AS t_p,
         h.u AS cur, t.u AS tgt, t.r AS rnd, t.adj AS adj
  FROM held h FULL JOIN trimmed t ON t.accnt_id = h.accnt_id AND t.asset_id = h.asset_id),
audit AS (
  SELECT rebal_id, accnt_id, asset_id, model_id, exch_code, fund_id, curr_code,
         {money('p')} AS price, {money('cur')} AS units_current,
         {money(half_up('cur * p', '1000000'))} AS value_current,
         {money('tgt')} AS units_target,
         {money(half_up(half_up('tgt * p', '1000'), '1000'))} AS value_target,
         {money('rnd * 1000000')} AS units_rounded, {money('rnd * p')} AS value_rounded,
         {money('adj * 1000000')} AS units_adjusted, {money('adj * p')} AS value_adjusted
  FROM position)
"""


def over_views(select: str) -> str:
    """A select over the portfolio views."""
    return f"WITH RECURSIVE {_VIEWS}\n{select}"


def over_result(select: str) -> str:
    """A select over the views and a whole rebalance."""
    return f"WITH RECURSIVE {_VIEWS}, {_trim('unrounded', 'trimmed')}, {_RESULT}\n{select}"


def over_rounded_trigger(select: str) -> str:
    return f"WITH RECURSIVE {_VIEWS}, {_trim('rounded', 'trimmed')}\n{select}"


def over_ticks(select: str) -> str:
    """A select over the views and the folded ticks."""
    return f"WITH RECURSIVE {_VIEWS}, {_TICKS}\n{select}"


_LATEST = f"""SELECT l.asset_id, l.exch_code, l.curr_code, {money('f.post')} AS price
FROM listing l JOIN final f ON f.asset_id = l.asset_id"""

_ADJUSTED = f"""
SELECT rebal_id, accnt_id, asset_id, exch_code, {money('p')} AS price, {money('u')} AS units_target,
       {money('r * 1000000')} AS units_rounded, {money('adj * 1000000')} AS units_adjusted FROM trimmed"""

def draw(key: str, salt: int) -> str:
    """The generators' hash: two congruential steps, low digits dropped."""
    value = f"((({key}) % 2147483648 + {salt}) % 2147483648)"
    for factor, increment in ((1103515245, 12345), (69069, 362437)):
        value = f"(({value} * {factor} + {increment}) % 2147483648)"
    return f"({value} // 1024)"


def wide_draw(key: str, high: int, low: int) -> str:
    return f"({draw(key, high)} * 2097152 + {draw(key, low)})"


_GRID = """
grid AS (
  SELECT row_number() OVER (ORDER BY s_suppkey, r_regionkey, k) AS model_id,
         s_suppkey + 1 AS advisor_id, 'C' || r_regionkey AS curr_code
  FROM supplier CROSS JOIN region CROSS JOIN range(1, 11) x(k))"""

_STICKS = f"""
placed AS (
  SELECT asset_id, exch_code, curr_code, row_number() OVER (PARTITION BY curr_code ORDER BY asset_id) AS position
  FROM listing),
sized AS (
  SELECT model_id, grid.curr_code, listed, least({draw('model_id', 2)} % 16 + 5, listed) AS n,
         {wide_draw('model_id', 3, 8)} % listed AS start,
         {wide_draw('model_id', 4, 9)} % greatest(listed // 20, 1) + 1 AS stride
  FROM grid JOIN (SELECT curr_code, count(*) AS listed FROM listing GROUP BY curr_code) c
    ON c.curr_code = grid.curr_code),
stick AS (
  SELECT model_id, CAST(0 AS BIGINT) AS j, CAST(100 AS BIGINT) AS rest, CAST(0 AS BIGINT) AS weight FROM sized
  UNION ALL
  SELECT model_id, j + 1, rest - cut, cut FROM (
    SELECT stick.model_id, j, rest, CASE WHEN j + 1 = n THEN rest
           ELSE {draw('stick.model_id * 21 + j + 1', 5)} % (rest - (n - (j + 1))) + 1 END AS cut
    FROM stick JOIN sized ON sized.model_id = stick.model_id WHERE j < n))
"""

# Which accounts a gated rebalance has marked, and which rebalances that completes.
_CYCLE = """, gate AS (
  SELECT 'C' || r_regionkey AS curr_code, CASE WHEN r_regionkey = 4 THEN 0 ELSE 1 END AS gate_status FROM region),
marked AS (
  SELECT t.rebal_id, t.accnt_id, t.fund_id FROM target t JOIN rebal r ON r.rebal_id = t.rebal_id
  JOIN gate g ON g.curr_code = r.curr_code WHERE g.gate_status = 1),
progress AS (
  SELECT r.rebal_id, r.fund_id, count(m.accnt_id) AS done, count(a.accnt_id) - count(m.accnt_id) AS remaining,
         CAST(CASE WHEN count(a.accnt_id) > 0 AND count(m.accnt_id) = count(a.accnt_id) THEN 1 ELSE 0 END AS BIGINT) AS complete
  FROM rebal r LEFT JOIN account a ON a.fund_id = r.fund_id
  LEFT JOIN marked m ON m.rebal_id = r.rebal_id AND m.accnt_id = a.accnt_id GROUP BY r.rebal_id, r.fund_id),
closing AS (SELECT rebal_id, fund_id FROM progress WHERE complete = 1)"""


ORACLES: dict[str, str] = {
    # valuation
    "price_snapshot": over_views(
        "SELECT rebal_id, fund_id, asset_id, exch_code, curr_code, price FROM snapshot"
    ),
    "queued_cash_by_account": over_views(
        f"SELECT accnt_id, {money('dep')} AS new_deposits, {money('wd')} AS new_withdrawals FROM queued"
    ),
    "holdings_current": over_views(
        "SELECT rebal_id, accnt_id, asset_id, exch_code, curr_code, fund_id, model_id, units, price FROM held"
    ),
    "holdings_value": over_views(
        f"SELECT accnt_id, {money('v')} AS current_holdings_value, n AS current_holdings_count FROM worth"
    ),
    "target_balance": over_views(
        f"""SELECT rebal_id, accnt_id, fund_id, model_id, cash_balance,
        {money('v')} AS current_holdings_value, CAST(n AS BIGINT) AS current_holdings_count,
        {money('dep')} AS new_deposits, {money('wd')} AS new_withdrawals,
        {money('t')} AS target_invest_value FROM target"""
    ),
    # allocation
    "holdings_target": over_views(
        f"""SELECT rebal_id, accnt_id, model_id, asset_id, exch_code, curr_code,
        {money('w')} AS weighting, price, {money('u')} AS units_target FROM alloc"""
    ),
    "holdings_rounded": over_views(
        f"""SELECT rebal_id, accnt_id, asset_id, {money('u')} AS units_target,
        {money(half_up('v9', '1000'))} AS value_target, {money('r * 1000000')} AS units_rounded FROM whole"""
    ),
    "holdings_adjusted": over_result(_ADJUSTED),
    "holdings_adjusted_strict": over_rounded_trigger(_ADJUSTED),
    "cheapest_asset": over_views(
        f"SELECT accnt_id, asset_id, {money('p')} AS price FROM ranked WHERE k = 1"
    ),
    "rebalanced_balances": over_result(
        f"""SELECT rebal_id, accnt_id, {money('t')} AS target_invest_value,
        {money('plan_value')} AS rounded_target_invest_value, {money('inv')} AS rebalanced_invest_value,
        {money('cash')} AS rebalanced_cash_balance FROM summary"""
    ),
    # outputs
    "trades": over_result(
        f"""SELECT rebal_id, accnt_id, asset_id,
        CAST(CASE WHEN coalesce(adj, 0) * 1000000 > coalesce(cur, 0) THEN 1 ELSE 2 END AS BIGINT) AS trtyp_id,
        exch_code, fund_id, curr_code, {money('coalesce(adj, 0) * 1000000 - coalesce(cur, 0)')} AS units,
        {money('p')} AS price, TIMESTAMP '{AS_OF}' AS trade_time
        FROM position WHERE coalesce(adj, 0) * 1000000 <> coalesce(cur, 0)"""
    ),
    "holdings_replaced": over_result(
        f"""SELECT accnt_id, asset_id, fund_id, exch_code, curr_code, {money('adj * 1000000')} AS units
        FROM trimmed WHERE adj > 0 AND curr_code <> 'C4'
        UNION ALL SELECT accnt_id, asset_id, fund_id, exch_code, curr_code, units FROM holding
        WHERE accnt_id NOT IN (SELECT accnt_id FROM target WHERE curr_code <> 'C4')"""
    ),
    "holding_history": over_result(
        f"""SELECT accnt_id, rebal_id, asset_id, fund_id, exch_code, curr_code,
        {money('adj * 1000000')} AS units FROM trimmed WHERE adj > 0"""
    ),
    "balances_replaced": over_result(
        f"""SELECT accnt_id, inv_id, curr_code, fund_id, model_id,
        CASE WHEN curr_code <> 'C4' THEN {money('inv')} ELSE a.inv_balance END AS inv_balance,
        CASE WHEN curr_code <> 'C4' THEN {money('cash')} ELSE a.cash_balance END AS cash_balance
        FROM account a JOIN (SELECT accnt_id, inv, cash FROM summary) s USING (accnt_id)"""
    ),
    "balance_history": over_result(
        f"""SELECT row_number() OVER (ORDER BY accnt_id) AS id, rebal_id, accnt_id, fund_id, curr_code,
        {money('inv')} AS inv_balance, {money('cash')} AS cash_balance FROM summary"""
    ),
    "account_asset_audit": over_result("SELECT * FROM audit"),
    "account_audit": over_result(
        f"""SELECT rebal_id, fund_id, curr_code, accnt_id, TIMESTAMP '{AS_OF}' AS start_dt,
        inv_balance AS current_inv_balance, CAST(n AS BIGINT) AS current_holdings_count,
        {money('v')} AS current_holdings_value, cash_balance AS current_cash_balance,
        {money('dep')} AS new_deposits, {money('wd')} AS new_withdrawals,
        {money('t')} AS target_invest_value, {money('plan_value')} AS rounded_target_invest_value,
        {money('inv')} AS rebalanced_invest_value, {money('cash')} AS rebalanced_cash_balance,
        TIMESTAMP '{AS_OF}' AS end_dt FROM summary"""
    ),
    "rebalance_accounts": over_views(
        """SELECT rebal_id, CAST(1 AS BIGINT) AS item_no, accnt_id, fund_id, curr_code, model_id FROM target"""
    ),
    "transact_processed": over_views(
        f"""{_CYCLE} SELECT q.tran_id, q.accnt_id, m.fund_id, q.curr_code, q.tx_type, q.amount, q.queued_dt, m.rebal_id,
        TIMESTAMP '{AS_OF}' AS processed_dt FROM queue q JOIN marked m ON m.accnt_id = q.accnt_id"""
    ),
    "transact_queue_remaining": over_views(
        f"""{_CYCLE} SELECT tran_id, accnt_id, fund_id, curr_code, tx_type, amount, queued_dt FROM queue
        WHERE accnt_id NOT IN (SELECT accnt_id FROM marked)"""
    ),
    # fund cycle
    "open_rebalances": over_views(
        "SELECT rebal_id, fund_id, curr_code, accnts_count, start_dt, end_dt FROM rebal"
        " WHERE end_dt = TIMESTAMP '1900-01-01 00:00:00'"
    ),
    "rebalance_progress": over_views(f"{_CYCLE} SELECT rebal_id, fund_id, done, remaining, complete FROM progress"),
    "rebalance_rerun": over_views(
        "SELECT rebal_id, accnt_id, 'done' AS state FROM target WHERE accnt_id % 10 = 3"
    ),
    "rebalance_progress_rejected": over_views(
        """, settled AS (SELECT rebal_id, accnt_id FROM target WHERE accnt_id % 3 = 0
          UNION SELECT rebal_id, accnt_id FROM target WHERE accnt_id % 3 = 1 OR accnt_id % 6 = 0),
        counted AS (SELECT r.rebal_id, r.fund_id, count(a.accnt_id) AS accounts, count(s.accnt_id) AS done
          FROM rebal r LEFT JOIN account a ON a.fund_id = r.fund_id
          LEFT JOIN settled s ON s.rebal_id = r.rebal_id AND s.accnt_id = a.accnt_id GROUP BY ALL)
        SELECT rebal_id, fund_id, done, accounts - done AS remaining,
        CAST(CASE WHEN accounts > 0 AND accounts = done THEN 1 ELSE 0 END AS BIGINT) AS complete FROM counted"""
    ),
    "rebalance_roll": over_views(
        f"""{_CYCLE} SELECT rebal_id, fund_id, curr_code, accnts_count, start_dt,
        CASE WHEN rebal_id IN (SELECT rebal_id FROM closing) THEN TIMESTAMP '{AS_OF}' ELSE end_dt END AS end_dt FROM rebal
        UNION ALL
        SELECT 'R' || fund_id || '-2', fund_id, curr_code, accnts_count, TIMESTAMP '{AS_OF}', end_dt
        FROM rebal WHERE rebal_id IN (SELECT rebal_id FROM closing)"""
    ),
    "fund_rebalance_counter": over_views(
        f"""{_CYCLE} SELECT f.fund_id, f.curr_code, CAST(count(c.rebal_id) AS DECIMAL(20,6)) AS balance
        FROM fund f LEFT JOIN closing c ON c.fund_id = f.fund_id GROUP BY f.fund_id, f.curr_code"""
    ),
    "fund_balance_history": over_result(
        f"""{_CYCLE}, worths AS (SELECT s.fund_id, sum(CASE WHEN m.accnt_id IS NULL
            THEN {micros('s.inv_balance')} + {micros('s.cash_balance')} ELSE s.inv + s.cash END) AS v
          FROM summary s LEFT JOIN marked m ON m.accnt_id = s.accnt_id GROUP BY s.fund_id)
        SELECT row_number() OVER (ORDER BY c.fund_id) AS id, c.fund_id, c.rebal_id, r.curr_code,
        TIMESTAMP '{AS_OF}' AS log_dt, {money('v')} AS balance
        FROM closing c JOIN rebal r ON r.rebal_id = c.rebal_id JOIN worths w ON w.fund_id = c.fund_id"""
    ),
    "next_price_snapshot": over_views(
        f"""{_CYCLE} SELECT 'R' || fund_id || '-2' AS rebal_id, fund_id, asset_id, exch_code, curr_code, price
        FROM snapshot WHERE rebal_id IN (SELECT rebal_id FROM closing)"""
    ),
    # prices
    "price_update_latest": over_ticks(_LATEST),
    "price_update_history": over_ticks(
        f"""SELECT id, asset_id, exch_code, curr_code, price_dt, {money('pre')} AS price_pre,
        {money('post')} AS price_post FROM history"""
    ),
    "price_gate_filter": over_ticks(
        "SELECT event_id, ts, asset_id, exch_code, curr_code, variance FROM passed"
    ),
    "price_gate_long": over_ticks(
        """SELECT event_id, ts, asset_id, exch_code, curr_code, variance FROM tick WHERE NOT EXISTS (
          SELECT 1 FROM orders JOIN customer ON c_custkey = o_custkey
          WHERE 'C' || (c_nationkey % 5) = tick.curr_code
          AND CASE WHEN o_orderkey % 97 = 0
            THEN tick.ts >= TIMESTAMP '2022-01-01 00:00:00' + to_days(CAST(o_orderkey % 30 AS INTEGER))
             AND tick.ts < TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(o_orderkey % 11 AS INTEGER))
            ELSE tick.ts >= TIMESTAMP '2024-01-01 00:00:00' + to_seconds(o_orderkey * 433 % 2592000)
             AND tick.ts < TIMESTAMP '2024-01-01 00:00:00' + to_seconds(o_orderkey * 433 % 2592000 + o_orderkey % 100)
            END)"""
    ),
    "price_asof_snapshot": over_ticks(
        f"""SELECT l.asset_id, l.exch_code, l.curr_code, {money("""coalesce(
          (SELECT arg_max(h.post, (h.price_dt, h.id)) FROM history h
           WHERE h.asset_id = l.asset_id AND h.price_dt <= TIMESTAMP '2024-01-15 12:00:00'),
          (SELECT arg_min(h.pre, (h.price_dt, h.id)) FROM history h
           WHERE h.asset_id = l.asset_id AND h.price_dt > TIMESTAMP '2024-01-15 12:00:00'), l.p)""")} AS price
        FROM listing l"""
    ),
    "price_hot_listing": over_ticks(
        f""", one AS (SELECT p FROM listing ORDER BY asset_id LIMIT 1),
        listed AS (SELECT list(variance ORDER BY ts, event_id) AS vs, list(event_id ORDER BY ts, event_id) AS ids FROM tick),
        chain AS (
          SELECT CAST(0 AS BIGINT) AS k, CAST(NULL AS HUGEINT) AS pre, CAST(p AS HUGEINT) AS post FROM one
          UNION ALL
          SELECT k + 1, post, CAST({half_up('post * (100 + vs[k + 1])', '100')} AS HUGEINT)
          FROM chain, listed WHERE k < len(vs))
        SELECT ids[k] AS id, {money('pre')} AS price_pre, {money('post')} AS price_post FROM chain, listed WHERE k > 0"""
    ),
    "price_asof_orders": over_ticks(
        f""", moment AS (SELECT l_orderkey, l_linenumber, l_partkey AS asset_id, l.p AS p,
          TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(l_orderkey % 30 AS INTEGER)) + to_hours(l_linenumber) AS at
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN listing l ON l.asset_id = l_partkey)
        SELECT l_orderkey, l_linenumber, m.asset_id AS asset_id, m.at AS at, {money("""coalesce(
          (SELECT arg_max(h.post, (h.price_dt, h.id)) FROM history h
           WHERE h.asset_id = m.asset_id AND h.price_dt <= m.at),
          (SELECT arg_min(h.pre, (h.price_dt, h.id)) FROM history h
           WHERE h.asset_id = m.asset_id AND h.price_dt > m.at), m.p)""")} AS price FROM moment m"""
    ),
    # cash
    "deposit_enqueue": over_views(
        "SELECT tran_id, accnt_id, fund_id, curr_code, tx_type, amount, queued_dt FROM queue"
    ),
    "withdrawal_ledger": over_views(
        f"""SELECT tran_id, accnt_id, fund_id, curr_code, tx_type, {money('a')} AS amount, queued_dt,
        CASE status WHEN 'F' THEN 'R' || fund_id || '-0' END AS rebal_id, queued_dt AS processed_dt
        FROM movement WHERE status IN ('F', 'P')"""
    ),
    # archive
    "archive_keep_last_n": over_result(
        """SELECT * FROM (SELECT row_number() OVER (ORDER BY accnt_id, asset_id) AS history_id, audit.* FROM audit)
        WHERE history_id <= (SELECT count(*) - 1000 FROM audit)"""
    ),
    "archive_remaining": over_result(
        """SELECT * FROM (SELECT row_number() OVER (ORDER BY accnt_id, asset_id) AS history_id, audit.* FROM audit)
        WHERE history_id > (SELECT CASE WHEN count(*) > 1000 THEN count(*) - 1000 ELSE 0 END FROM audit)"""
    ),
    "archive_idempotent_append": over_result(
        """SELECT * FROM (SELECT row_number() OVER (ORDER BY accnt_id, asset_id) AS history_id, audit.* FROM audit)
        WHERE units_current IS NOT NULL"""
    ),
    # shaping
    "account_queue": over_views(
        """SELECT row_number() OVER (PARTITION BY fund_id ORDER BY accnt_id) AS queue_no, fund_id, curr_code, accnt_id
        FROM account"""
    ),
    "cohort_ranges": over_views(
        """, counts AS (SELECT fund_id, count(*) AS accnts_count FROM account GROUP BY fund_id),
        base AS (SELECT t AS thread_id, CAST(60 AS BIGINT) AS max_thread_id,
                 (SELECT count(*) FROM counts) AS no_of_funds FROM range(1, 61) x(t)),
        thread AS (SELECT *, thread_id % no_of_funds + 1 AS thread_mod, max_thread_id // no_of_funds AS base,
                   (thread_id - 1) // no_of_funds + 1 AS nth_thread FROM base),
        sized AS (SELECT thread.*, fund_id, accnts_count,
                  CASE WHEN thread_mod <> 0 AND base * no_of_funds + thread_mod <= max_thread_id
                       THEN base + 1 ELSE base END AS threads_per_fund
                  FROM thread JOIN counts ON fund_id = thread_mod),
        placed AS (SELECT *, accnts_count // threads_per_fund AS accnts_per_thread,
                   (nth_thread - 1) * (accnts_count // threads_per_fund) + 1 AS queue_no_from FROM sized)
        SELECT thread_id, max_thread_id, fund_id, no_of_funds, thread_mod, threads_per_fund, nth_thread,
        accnts_count, accnts_per_thread, queue_no_from,
        CASE WHEN thread_id + no_of_funds > max_thread_id THEN accnts_count
             ELSE queue_no_from + accnts_per_thread - 1 END AS queue_no_to, queue_no_from AS next_queue_no FROM placed"""
    ),
    "numbers": "SELECT min(n) AS min_n, max(n) AS max_n, count(n) AS count_n"
    " FROM (SELECT row_number() OVER () AS n FROM lineitem)",
    "model_weights": over_views(
        f"SELECT model_id, asset_id, exch_code, curr_code, {money('w')} AS weighting FROM model_asset"
    ),
    "available_listings_anti": over_views(
        """SELECT m.model_id, m.curr_code, count(*) AS available FROM model m
        JOIN listing l ON l.curr_code = m.curr_code
        WHERE NOT EXISTS (SELECT 1 FROM model_asset a WHERE a.model_id = m.model_id AND a.asset_id = l.asset_id)
        GROUP BY m.model_id, m.curr_code"""
    ),
    "ranked_listing_pick": over_views(
        """SELECT model_id, k, asset_id, exch_code FROM (
          SELECT m.model_id, m.model_id % 7 + 1 AS k, l.asset_id, l.exch_code,
                 row_number() OVER (PARTITION BY m.model_id ORDER BY l.asset_id) AS n
          FROM model m JOIN listing l ON l.curr_code = m.curr_code
          WHERE NOT EXISTS (SELECT 1 FROM model_asset a WHERE a.model_id = m.model_id AND a.asset_id = l.asset_id))
        WHERE n = k"""
    ),
    "successor_key": "SELECT key, lead(key) OVER (ORDER BY key) AS next_key"
    " FROM (SELECT DISTINCT l_orderkey AS key FROM lineitem)",
    "advisor_model_grid": """SELECT model_id, 'Model' || model_id AS model_name, advisor_id, curr_code FROM (
        SELECT row_number() OVER (ORDER BY s_suppkey, r_regionkey, k) AS model_id,
               s_suppkey + 1 AS advisor_id, 'C' || r_regionkey AS curr_code
        FROM supplier CROSS JOIN region CROSS JOIN range(1, 11) x(k))""",
    "listing_count_by_exchange": over_views(
        "SELECT exch_code, count(*) AS list_count FROM listing GROUP BY exch_code"
    ),
    "model_assets_count": over_views(
        "SELECT model_id, count(*) AS assets_count FROM model_asset GROUP BY model_id"
    ),
    "asset_naming": over_views(
        """SELECT asset_id, isin AS isin_code, p_type || '_' || asset_id || '_' || isin AS asset_name FROM (
        SELECT asset_id, p_type, upper(left(r_name, 2)) || lpad(CAST(asset_id AS VARCHAR), 10, '0') AS isin
        FROM listing JOIN part ON p_partkey = asset_id JOIN region ON 'X' || r_regionkey = exch_code)"""
    ),
    # quality
    "pk_violations": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem"
    " GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    "fk_violations": over_views(
        """SELECT accnt_id, a.model_id, h.asset_id FROM holding h JOIN account a USING (accnt_id)
        WHERE NOT EXISTS (SELECT 1 FROM model_asset m WHERE m.model_id = a.model_id AND m.asset_id = h.asset_id)"""
    ),
    "not_null_violations": over_result(
        """SELECT rebal_id, accnt_id, asset_id, 'price' AS column_name FROM position
        WHERE t_p IS NULL AND coalesce(adj, 0) * 1000000 <> coalesce(cur, 0)"""
    ),
    "model_weight_check": over_views(
        f"""SELECT model_id, {money('sum(w)')} AS weight FROM model_asset
        WHERE asset_id IN (SELECT asset_id FROM listing) GROUP BY model_id HAVING sum(w) <> 1000000"""
    ),
    "declared_violations": over_views(
        """, twice AS (SELECT accnt_id, fund_id, curr_code, CASE WHEN accnt_id % 89 <> 0 THEN model_id END AS model_id
          FROM account UNION ALL
          SELECT accnt_id, fund_id, curr_code, CASE WHEN accnt_id % 89 <> 0 THEN model_id END
          FROM account WHERE accnt_id % 97 = 0),
        shifted AS (SELECT tran_id, accnt_id, curr_code,
          fund_id + CASE WHEN accnt_id % 83 = 0 THEN 1 ELSE 0 END AS fund_id FROM queue)
        SELECT 'account' AS operator, accnt_id::VARCHAR AS key, 'not unique: accnt_id' AS reason
          FROM twice GROUP BY accnt_id HAVING count(*) > 1
        UNION ALL SELECT 'rebal_fund', '3/1900-01-01 00:00:00', 'not unique: fund_id,end_dt' FROM rebal WHERE fund_id = 3
        UNION ALL SELECT 'account', accnt_id || '/model_id', 'value is missing' FROM twice WHERE model_id IS NULL
        UNION ALL SELECT 'model_asset', model_id || '/' || asset_id || '/' || asset_id || '/' || exch_code || '/' || curr_code,
          'no such listing: asset_id,exch_code,curr_code' FROM model_asset
          WHERE asset_id NOT IN (SELECT asset_id FROM listing)
        UNION ALL SELECT 'holding', accnt_id || '/' || asset_id || '/' || asset_id || '/' || exch_code || '/' || curr_code,
          'no such listing: asset_id,exch_code,curr_code' FROM holding
          WHERE asset_id NOT IN (SELECT asset_id FROM listing)
        UNION ALL SELECT 'transact_queue', tran_id || '/' || accnt_id || '/' || fund_id || '/' || curr_code,
          'no such account: accnt_id,fund_id,curr_code' FROM shifted s
          WHERE NOT EXISTS (SELECT 1 FROM account a WHERE a.accnt_id = s.accnt_id AND a.fund_id = s.fund_id)"""
    ),
    "stream_rejects": over_ticks(
        """SELECT 'apply_ticks' AS operator, CAST(event_id AS VARCHAR) AS key, 'unknown listing' AS reason FROM passed
        WHERE asset_id NOT IN (SELECT asset_id FROM listing)"""
    ),
    "rejects": over_ticks(
        """SELECT 'price_holdings' AS operator, accnt_id || '/' || asset_id AS key,
        'warning: no snapshot price' AS reason FROM holding
        WHERE asset_id NOT IN (SELECT asset_id FROM listing)
        UNION ALL SELECT DISTINCT 'price_models', t.rebal_id || '/' || m.model_id || '/' || m.asset_id,
        'warning: no snapshot price' FROM target t JOIN model_asset m ON m.model_id = t.model_id
        WHERE NOT EXISTS (SELECT 1 FROM snapshot s WHERE s.rebal_id = t.rebal_id AND s.asset_id = m.asset_id
          AND s.exch_code = m.exch_code AND s.curr_code = m.curr_code)
        UNION ALL SELECT 'apply_ticks', CAST(event_id AS VARCHAR), 'unknown listing' FROM passed
        WHERE asset_id NOT IN (SELECT asset_id FROM listing)"""
    ),
    # streaming: the batch results
    "stream_deposits": over_views(
        "SELECT tran_id, accnt_id, fund_id, curr_code, tx_type, amount, queued_dt FROM queue WHERE tx_type = 1"
    ),
    "stream_withdrawals": over_views(
        """SELECT tran_id, accnt_id, fund_id, curr_code, tx_type, amount, queued_dt,
        CAST(NULL AS VARCHAR) AS rebal_id, queued_dt AS processed_dt FROM queue WHERE tx_type = 2"""
    ),
    "stream_prices": over_ticks(_LATEST),
    # generators
    "gen_assets": over_views(
        f""", dims AS (SELECT (SELECT count(*) // 10 FROM part) AS per_cell),
        classes AS (SELECT p_type AS class_code, row_number() OVER (ORDER BY p_type) - 1 AS class_no,
                    count(*) OVER () AS n FROM (SELECT DISTINCT p_type FROM part)),
        cells AS (
          SELECT (r_regionkey * n + class_no) * per_cell + c AS asset_id, class_no * per_cell + c AS list_no,
                 'X' || r_regionkey AS exch_code, 'C' || r_regionkey AS curr_code, class_code,
                 upper(left(r_name, 2)) AS prefix
          FROM region CROSS JOIN classes CROSS JOIN dims CROSS JOIN LATERAL range(1, per_cell + 1) x(c))
        SELECT asset_id, exch_code, curr_code, class_code, list_no,
               prefix || lpad(CAST(asset_id AS VARCHAR), 10, '0') AS isin_code,
               class_code || '_' || asset_id || '_' || prefix || lpad(CAST(asset_id AS VARCHAR), 10, '0') AS asset_name,
               CAST(({draw('asset_id', 1)} % 8 + 1) // 2 + 1 AS DECIMAL(20,6)) AS price FROM cells"""
    ),
    "gen_models": f"""WITH {_GRID} SELECT model_id, 'Model' || model_id AS model_name, advisor_id, curr_code,
        CAST({draw('model_id', 2)} % 16 + 5 AS INTEGER) AS assets_count FROM grid""",
    "gen_model_assets": over_views(
        f""", {_GRID}, {_STICKS}
        SELECT s.model_id, p.asset_id, p.exch_code, p.curr_code, CAST(CAST(weight AS DECIMAL(9,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(20,6))
          AS weighting FROM stick s JOIN sized USING (model_id)
        JOIN placed p ON p.curr_code = sized.curr_code AND p.position = (start + (j - 1) * stride) % listed + 1
        WHERE j > 0"""
    ),
    "gen_accounts": over_views(
        f""", per AS (SELECT count(*) // 5 AS per_fund FROM customer),
        choice AS (SELECT model_id, curr_code, row_number() OVER (PARTITION BY curr_code ORDER BY model_id) AS model_no,
                   count(*) OVER (PARTITION BY curr_code) AS models FROM model),
        people AS (SELECT (fund_id - 1) * per_fund + n AS accnt_id, fund_id, curr_code
                   FROM fund CROSS JOIN per CROSS JOIN LATERAL range(1, per_fund + 1) x(n))
        SELECT accnt_id, accnt_id AS inv_id, 'Investor' || accnt_id AS inv_name, people.curr_code, fund_id, model_id,
               CAST(({draw('accnt_id', 7)} % 100 + 1) * 1000 AS DECIMAL(20,6)) AS deposit
        FROM people JOIN choice ON choice.curr_code = people.curr_code
         AND model_no = {wide_draw('accnt_id', 6, 10)} % models + 1"""
    ),
}
