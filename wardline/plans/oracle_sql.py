"""SQL for each stand-in query, in DuckDB's dialect.

Each question is stated anew, in another form than the Spark plan's: correlated
counts and EXISTS instead of pre-aggregated joins, lists instead of self joins,
windows instead of scalar maxima, closed forms instead of walks, so the check
compares two formulations.  Exact-rounding expressions mirror
``wardline.functions.numeric``.
"""

from __future__ import annotations


def _scaled(num: str, den: str, digits: int, times: int = 1) -> str:
    """SQL for round(num * times / den * 10**digits) half away from zero, as an integer."""
    k = 10**digits * times
    return f"(CASE WHEN ({den}) > 0 THEN SIGN({num}) * ((2 * {k} * ABS(CAST({num} AS HUGEINT)) + ({den})) // (2 * ({den}))) END)"


def _ratio(num: str, den: str, digits: int, times: int = 1) -> str:
    return f"(CAST({_scaled(num, den, digits, times)} AS DOUBLE) / {10**digits})"


def _dialect_avg(total: str, count: str, digits: int) -> str:
    four = _scaled(total, count, 4)
    if digits >= 4:
        return f"(CAST({four} AS DOUBLE) / 10000)"
    step = 10 ** (4 - digits)
    return f"(CAST(SIGN({four}) * ((2 * ABS({four}) + {step}) // {2 * step}) AS DOUBLE) / {10**digits})"


def _money_sum(expr: str) -> str:
    return f"CAST(SUM(CAST({expr} AS DECIMAL(12,2))) AS DECIMAL(38,2))"


def _key(*cols: str) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in cols) + ")"


ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["revenue_rollup"] = """
WITH buyer AS (SELECT c_custkey AS k, c_mktsegment, (SELECT n_name FROM nation WHERE n_nationkey = c_nationkey) AS n_name FROM customer),
fact AS (
    SELECT l_orderkey, CAST(EXTRACT(YEAR FROM l_shipdate) AS INTEGER) AS ship_year, p_type, n_name, c_mktsegment,
           CAST(p_retailprice AS DECIMAL(12,2)) AS base, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
           CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) - p_size AS late
    FROM orders, lineitem, part, buyer
    WHERE o_orderkey = l_orderkey AND p_partkey = l_partkey AND k = o_custkey AND n_name IS NOT NULL AND l_shipdate IS NOT NULL)
SELECT n_name, ship_year, p_type, c_mktsegment, COUNT(l_orderkey) AS total_items,
       CAST(SUM(base) AS DECIMAL(38,2)) AS total_basic_cost,
       CAST(SUM(CASE WHEN late > 0 THEN late * base ELSE 0 END) AS DECIMAL(38,2)) AS total_extra_cost,
       CAST(SUM(price) AS DECIMAL(38,2)) AS final_total_revenue
FROM fact GROUP BY ALL
"""

ORACLE_SQL["roster_flag"] = """
SELECT c_custkey, c_name, c_mktsegment,
       IF(EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
                    AND o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1999-01-01'), 'YES', 'NO') AS had_order_in_year,
       (SELECT COUNT(DISTINCT event_id) FROM events WHERE user_id = c_custkey) AS events_count
FROM customer WHERE c_mktsegment = 'BUILDING'
"""

ORACLE_SQL["frequent_groups"] = """
WITH counted AS (
    SELECT DISTINCT o_custkey, o_orderstatus, COUNT(*) OVER g AS total_orders,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) OVER g AS DECIMAL(38,2)) AS total_cost
    FROM orders WINDOW g AS (PARTITION BY o_custkey, o_orderstatus))
SELECT c_custkey, c_name, o_orderstatus, total_orders, total_cost
FROM counted, customer WHERE c_custkey = o_custkey AND total_orders > 3
"""

ORACLE_SQL["bridge_average"] = f"""
WITH item AS (
    SELECT l_suppkey, SUM(CAST(CAST(l_quantity AS DECIMAL(12,2)) * 100 AS HUGEINT)) AS q, COUNT(l_quantity) * 100 AS nq,
           SUM(l_linenumber) AS l, COUNT(l_linenumber) AS nl
    FROM lineitem WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey) GROUP BY l_suppkey)
SELECT s_suppkey, s_name, {_ratio('q', 'nq', 4)} AS avg_quantity, {_dialect_avg('l', 'nl', 4)} AS avg_linenumber
FROM item, supplier WHERE s_suppkey = l_suppkey
"""

ORACLE_SQL["filtered_leaderboard"] = """
SELECT * FROM (
    SELECT c_custkey, c_name, c_acctbal,
           (SELECT COUNT(*) FROM events WHERE user_id = c_custkey AND event_type = 'purchase') AS total_purchases
    FROM customer WHERE c_acctbal < 1000)
WHERE total_purchases > 0
"""

ORACLE_SQL["entity_timeline"] = """
WITH rated AS (SELECT doc_id, quality, toxic, (quality + toxic)::DOUBLE / 2.0 AS score FROM labels)
SELECT doc_id, source, n_chars, quality, toxic, score AS avg_label_score FROM documents JOIN rated USING (doc_id)
UNION ALL
SELECT doc_id, source, n_chars, NULL, NULL, NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM rated)
"""

ORACLE_SQL["entity_timeline_reduced"] = """
SELECT doc_id, lang, n_chars, (SELECT (quality + toxic)::DOUBLE / 2.0 FROM labels l WHERE l.doc_id = d.doc_id) AS avg_score
FROM documents d
"""

ORACLE_SQL["dual_role_lookup"] = """
WITH home AS (SELECT n_nationkey, n_name FROM nation),
buyer AS (SELECT c_custkey, n_name AS customer_nation FROM customer, home WHERE n_nationkey = c_nationkey),
seller AS (SELECT s_suppkey, (SELECT n_name FROM home WHERE n_nationkey = s_nationkey) AS supplier_nation FROM supplier)
SELECT o_orderkey, l_linenumber, o_orderdate, customer_nation,
       (SELECT supplier_nation FROM seller WHERE s_suppkey = l_suppkey) AS supplier_nation, l_extendedprice
FROM lineitem, orders, buyer WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey
"""

ORACLE_SQL["dual_optional_counts"] = """
SELECT c_custkey, c_name,
       (SELECT COUNT(DISTINCT o_orderkey) FROM orders WHERE o_custkey = c_custkey) AS orders_count,
       (SELECT COUNT(DISTINCT event_id) FROM events WHERE user_id = c_custkey) AS events_count
FROM customer
"""

ORACLE_SQL["not_assigned"] = """
WITH idle AS (
    SELECT c_custkey FROM customer
    EXCEPT SELECT o_custkey FROM orders
    WHERE o_orderstatus = 'F' AND o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01')
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey IN (SELECT c_custkey FROM idle)
"""

_YEAR_TOTALS = """
    SELECT o_custkey, CAST(EXTRACT(YEAR FROM o_orderdate) AS INTEGER) AS order_year,
           CAST(SUM(DATE '2001-12-31' - CAST(o_orderdate AS DATE)) AS BIGINT) AS total_days
    FROM orders GROUP BY 1, 2"""

# members of equal totals as one sorted list, then every place with every later place of the list
ORACLE_SQL["equal_measure_pairs"] = f"""
WITH grouped AS (
    SELECT order_year, total_days, list(o_custkey ORDER BY o_custkey) AS members
    FROM ({_YEAR_TOTALS}) WHERE total_days > 15 GROUP BY order_year, total_days),
placed AS (SELECT order_year, total_days, members, unnest(range(1, len(members) + 1)) AS i FROM grouped)
SELECT members[i] AS customer_a, unnest(members[i + 1:]) AS customer_b, total_days, order_year FROM placed
"""

ORACLE_SQL["equal_measure_groups"] = f"""
SELECT order_year, total_days, COUNT(*) OVER (PARTITION BY order_year, total_days) AS group_size, o_custkey
FROM ({_YEAR_TOTALS}) WHERE total_days > 15
QUALIFY group_size > 1
"""

ORACLE_SQL["pair_cooccurrence"] = """
WITH basket AS (
    SELECT l_orderkey, list(DISTINCT p_brand) AS brands FROM lineitem, part WHERE p_partkey = l_partkey GROUP BY l_orderkey),
first AS (SELECT brands, unnest(brands) AS brand_1 FROM basket),
pair AS (SELECT brand_1, unnest(list_filter(brands, lambda x: x > brand_1)) AS brand_2 FROM first)
SELECT brand_1, brand_2, COUNT(*) AS co_occurrence_count FROM pair
GROUP BY ALL ORDER BY co_occurrence_count DESC, brand_1, brand_2 LIMIT 3
"""

ORACLE_SQL["gap_to_max"] = """
SELECT o_custkey, COUNT(*) AS num_orders, MAX(COUNT(*)) OVER () AS max_orders
FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'
GROUP BY o_custkey
QUALIFY max_orders - num_orders >= 5
"""

ORACLE_SQL["weekly_roster"] = """
WITH site AS (SELECT s_suppkey, n_nationkey, n_name FROM supplier, nation WHERE n_nationkey = s_nationkey)
SELECT n_nationkey, n_name, CAST(l_shipdate AS DATE) AS ship_date, l_returnflag, l_linestatus, COUNT(l_orderkey) AS assigned_count
FROM lineitem, site
WHERE s_suppkey = l_suppkey AND date_trunc('week', l_shipdate) = date_trunc('week', DATE '1997-05-20')
GROUP BY ALL
"""

# the parent of k is k // 10, so the ancestor at level v is k // 10**v, down to 0
ORACLE_SQL["ancestor_closure"] = """
WITH up AS (
    SELECT c_custkey AS customer_key, c_name AS customer_name,
           unnest(range(1, len(CAST(c_custkey AS VARCHAR)) + 1)) AS v
    FROM customer WHERE c_custkey <> 0)
SELECT customer_key, customer_name, c_custkey AS supervisor_key, c_name AS supervisor_name,
       c_mktsegment AS supervisor_segment, CAST(v AS INTEGER) AS hierarchy_level
FROM up, customer WHERE c_custkey = customer_key // CAST(10 ** v AS BIGINT)
"""

# turns of a conversation are numbered without gaps, so the ancestors of a turn are all turns before it
ORACLE_SQL["reply_chain"] = """
SELECT late.conv_id, late.turn, early.turn AS ancestor_turn, early.role AS ancestor_role,
       CAST(late.turn - early.turn AS INTEGER) AS hierarchy_level
FROM conversations late, conversations early
WHERE early.conv_id = late.conv_id AND early.turn < late.turn
"""

ORACLE_SQL["consecutive_equal"] = """
WITH yearly AS (
    SELECT p_brand, p_type, CAST(EXTRACT(YEAR FROM l_shipdate) AS INTEGER) AS year_1, COUNT(*) AS n_items
    FROM lineitem, part WHERE p_partkey = l_partkey GROUP BY ALL)
SELECT p_brand, p_type, year_1, year_1 + 1 AS year_2, n_items
FROM yearly WHERE n_items >= 5
WINDOW line AS (PARTITION BY p_brand, p_type ORDER BY year_1)
QUALIFY lead(year_1) OVER line = year_1 + 1 AND lead(n_items) OVER line = n_items
"""

# per visit the list of departments that took its patient within a day; a visit without one has a list of one NULL
ORACLE_SQL["triage_referral"] = f"""
WITH visit AS (
    SELECT event_id, user_id, ts, event_type, CAST(floor(value / 50) AS INTEGER) AS emergency_level,
           CAST(props ->> '$.k' AS INTEGER) >= 50 AS kept,
           datesub('minute', ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS wait
    FROM events),
sent AS (
    SELECT emergency_level, event_id, wait, kept, unnest(coalesce(
        (SELECT list(s.event_type) FROM events s WHERE s.user_id = v.user_id AND s.event_type IN ('purchase', 'signup')
            AND s.ts BETWEEN v.ts AND v.ts + INTERVAL 1 DAY), [NULL])) AS department
    FROM visit v WHERE v.event_type = 'error'),
per AS (
    SELECT emergency_level, department, COUNT(DISTINCT event_id) AS total_visits, SUM(wait) AS waits, COUNT(wait) AS n_waits,
           COUNT(*) FILTER (WHERE kept) AS n_kept, COUNT(department) AS referrals_count
    FROM sent GROUP BY ALL)
SELECT emergency_level, total_visits, {_dialect_avg('waits', 'n_waits', 2)} AS avg_wait_time_mins,
       {_ratio('n_kept', 'total_visits', 2, 100)} AS hosp_percentage,
       coalesce(department, 'NO_ADMISSION') AS referred_department, referrals_count
FROM per
"""

ORACLE_SQL["audit_primary_key"] = f"""
SELECT 'primary_key' AS rule, 'lineitem' AS table_name, {_key('l_orderkey', 'l_linenumber')} AS key_value,
       'rows=' || CAST(COUNT(*) AS VARCHAR) AS detail
FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
UNION ALL
SELECT 'primary_key', 'lineitem', {_key('l_orderkey', 'l_linenumber')}, 'null key'
FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL
"""

ORACLE_SQL["audit_unique"] = f"""
SELECT 'unique(o_custkey,o_orderdate)' AS rule, 'orders' AS table_name, {_key('o_custkey', 'o_orderdate')} AS key_value,
       'rows=' || CAST(COUNT(*) AS VARCHAR) AS detail
FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
GROUP BY o_custkey, o_orderdate HAVING COUNT(*) > 1
UNION ALL
SELECT 'unique(c_name)', 'customer', {_key('c_name')}, 'rows=' || CAST(COUNT(*) AS VARCHAR)
FROM customer WHERE c_name IS NOT NULL GROUP BY c_name HAVING COUNT(*) > 1
"""

_LINEITEM_COLS = ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
                  "l_returnflag l_linestatus l_shipdate").split()
ORACLE_SQL["audit_not_null"] = "\nUNION ALL\n".join(
    f"SELECT 'not_null({c})' AS rule, 'lineitem' AS table_name, {_key('l_orderkey', 'l_linenumber')} AS key_value, "
    f"'null' AS detail FROM lineitem WHERE {c} IS NULL"
    for c in _LINEITEM_COLS
) + "".join(
    f"\nUNION ALL SELECT 'not_null({c})', 'customer', {_key('c_custkey', 'event_id')}, 'null' "
    f"FROM customer LEFT JOIN events ON user_id = c_custkey WHERE {c} IS NULL"
    for c in ("c_name", "event_id", "value")
)

ORACLE_SQL["audit_check"] = f"""
SELECT 'ship_after_order' AS rule, 'lineitem' AS table_name, {_key('l.l_orderkey', 'l.l_linenumber')} AS key_value,
       'check failed' AS detail
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE NOT (l.l_shipdate >= o.o_orderdate)
UNION ALL
SELECT 'supplier_acctbal_nonneg', 'supplier', {_key('s_suppkey')}, 'check failed' FROM supplier WHERE NOT (s_acctbal >= 0)
UNION ALL
SELECT 'customer_acctbal_nonneg', 'customer', {_key('c_custkey')}, 'check failed' FROM customer WHERE NOT (c_acctbal >= 0)
"""

_CLOCKED = "SELECT event_id, event_type, value, strftime(ts, '%H:%M:%S') AS clock, c_acctbal FROM events LEFT JOIN customer ON user_id = c_custkey"
_FORMS = {
    "value_between": "value < 5 OR value > 95",
    "type_in": "event_type = 'error'",
    "balance_null_or_positive": "c_acctbal <= 0",
    "type_and_clock": "event_type = 'view' AND NOT (clock >= '07:00:00' AND clock < '15:00:00')"
                      " OR event_type = 'click' AND NOT (clock >= '15:00:00' AND clock < '23:00:00')",
}
ORACLE_SQL["audit_check_forms"] = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS rule, 'events' AS table_name, {_key('event_id')} AS key_value, 'check failed' AS detail "
    f"FROM ({_CLOCKED}) WHERE {cond}" for name, cond in _FORMS.items())

ORACLE_SQL["default_values"] = """
SELECT event_id, coalesce(c_acctbal, 0.0) AS balance, coalesce(c_mktsegment, 'NONE') AS segment
FROM events LEFT JOIN customer ON user_id = c_custkey
"""

ORACLE_SQL["audit_unique_collated"] = """
SELECT 'unique(p_name)' AS rule, 'part' AS table_name, min(shown) AS key_value, 'rows=' || CAST(COUNT(*) AS VARCHAR) AS detail
FROM (SELECT CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS shown FROM part)
GROUP BY rtrim(lower(strip_accents(shown))) HAVING COUNT(*) > 1
"""

# the clock stands still within a statement; what is asked changes at midnight only
ORACLE_SQL["roster_flag_now"] = """
SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderdate >= DATE '1998-01-02') THEN 'YES' ELSE 'NO' END AS had_recent_order,
       coalesce((SELECT current_date - max(o.o_orderdate)::DATE FROM orders o WHERE o.o_custkey = c.c_custkey), 0) AS days_since,
       CAST(year(current_date) AS INTEGER) AS this_year
FROM customer c
"""

_ALL_KEYS = {"customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"],
             "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"]}
_ALL_UNIQUES = [("orders", "o_custkey,o_orderdate"), ("customer", "c_name"), ("part", "p_name"), ("part", "p_brand,p_type,p_size"),
                ("events", "user_id,event_type"), ("lineitem", "l_partkey,l_suppkey,l_shipdate")]
_ALL_FKS = ["orders o_custkey customer c_custkey", "lineitem l_orderkey orders o_orderkey", "lineitem l_suppkey supplier s_suppkey",
            "lineitem l_partkey part p_partkey", "events user_id customer c_custkey", "part p_partkey customer c_custkey",
            "customer c_custkey events user_id", "customer c_custkey,c_nationkey supplier s_suppkey,s_nationkey"]
_ALL_ROWS = [
    *[("lineitem", f"not_null({c})", f"{c} IS NULL", "null") for c in ("l_orderkey", "l_suppkey", "l_shipdate")],
    *[("events", f"not_null({c})", f"{c} IS NULL", "null") for c in ("user_id", "ts")],
    ("supplier", "balance", "s_acctbal < 0", "check failed"), ("customer", "balance", "c_acctbal < 0", "check failed"),
    ("events", "value", "value < 5 OR value > 95", "check failed"),
    ("part", "length(p_name)<=10", "length(p_name) > 10", "too long"), ("part", "length(p_brand)<=10", "length(p_brand) > 10", "too long"),
    ("customer", "length(c_name)<=18", "length(c_name) > 18", "too long"),
    ("customer", "decimal(c_acctbal,5,2)", "abs(c_acctbal) >= 999.995 OR round(c_acctbal, 2) <> c_acctbal", "does not fit"),
]
ORACLE_SQL["audit_all"] = "\nUNION ALL\n".join([
    *[f"SELECT 'primary_key' AS rule, '{t}' AS table_name, {_key(*k)} AS key_value, CASE WHEN {' OR '.join(c + ' IS NULL' for c in k)} "
      f"THEN 'null key' ELSE 'rows=' || COUNT(*) END AS detail FROM {t} GROUP BY {', '.join(k)} HAVING COUNT(*) > 1 OR {' OR '.join(c + ' IS NULL' for c in k)}"
      for t, k in _ALL_KEYS.items()],
    *[f"SELECT 'unique({u})', '{t}', {_key(*u.split(','))}, 'rows=' || COUNT(*) FROM {t} WHERE {' AND '.join(c + ' IS NOT NULL' for c in u.split(','))} "
      f"GROUP BY {u} HAVING COUNT(*) > 1" for t, u in _ALL_UNIQUES],
    *[f"SELECT 'foreign_key({cols})->{p}', '{c}', {_key(*('c.' + k for k in _ALL_KEYS[c]))}, 'missing ' || {_key(*('c.' + x for x in cols.split(',')))} FROM {c} c "
      f"WHERE {' AND '.join(f'c.{x} IS NOT NULL' for x in cols.split(','))} AND NOT EXISTS (SELECT 1 FROM {p} p WHERE "
      f"{' AND '.join(f'p.{y} = c.{x}' for x, y in zip(cols.split(','), pcols.split(','), strict=True))})" for c, cols, p, pcols in map(str.split, _ALL_FKS)],
    *[f"SELECT '{rule}', '{t}', {_key(*_ALL_KEYS[t])}, '{detail}' FROM {t} WHERE {cond}" for t, rule, cond, detail in _ALL_ROWS],
])

ORACLE_SQL["audit_length"] = f"""
SELECT 'length(p_name)<=10' AS rule, 'part' AS table_name, {_key('p_partkey')} AS key_value, 'too long' AS detail
FROM part WHERE length(p_name) > 10
UNION ALL
SELECT 'length(p_brand)<=10', 'part', {_key('p_partkey')}, 'too long' FROM part WHERE length(p_brand) > 10
UNION ALL
SELECT 'length(c_name)<=18', 'customer', {_key('c_custkey')}, 'too long' FROM customer WHERE length(c_name) > 18
"""

ORACLE_SQL["audit_decimal"] = f"""
SELECT 'decimal(c_acctbal,5,2)' AS rule, 'customer' AS table_name, {_key('c_custkey')} AS key_value,
       'does not fit' AS detail
FROM customer
WHERE c_acctbal IS NOT NULL
  AND (TRY_CAST(c_acctbal AS DECIMAL(5,2)) IS NULL
       OR CAST(TRY_CAST(c_acctbal AS DECIMAL(5,2)) AS DOUBLE) <> c_acctbal)
"""

ORACLE_SQL["audit_foreign_key"] = f"""
SELECT 'foreign_key(l_orderkey)' AS rule, 'lineitem' AS table_name, {_key('l_orderkey', 'l_linenumber')} AS key_value,
       'missing ' || {_key('l_orderkey')} AS detail
FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL
SELECT 'foreign_key(c_custkey)', 'customer', {_key('c_custkey')}, 'missing ' || {_key('c_custkey')}
FROM customer WHERE c_custkey IS NOT NULL AND c_custkey NOT IN (SELECT user_id FROM events)
"""

ORACLE_SQL["propagate_delete"] = """
WITH rr AS (SELECT * FROM region WHERE r_name = 'AFRICA'),
     rn AS (SELECT * FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM rr)),
     rc AS (SELECT * FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM rn)),
     ro AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM rc)),
     rl AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM ro)),
     bs AS (SELECT * FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM rn))
SELECT 'region' AS table_name, (SELECT COUNT(*) FROM rr) AS removed_rows, CAST(0 AS BIGINT) AS blocking_rows
UNION ALL SELECT 'nation', (SELECT COUNT(*) FROM rn), 0
UNION ALL SELECT 'customer', (SELECT COUNT(*) FROM rc), 0
UNION ALL SELECT 'supplier', 0, (SELECT COUNT(*) FROM bs)
UNION ALL SELECT 'orders', (SELECT COUNT(*) FROM ro), 0
UNION ALL SELECT 'lineitem', (SELECT COUNT(*) FROM rl), 0
"""

ORACLE_SQL["propagate_key_change"] = """
WITH moved AS (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'AFRICA')
SELECT 'region' AS table_name, CAST(0 AS BIGINT) AS changed_rows
UNION ALL SELECT 'nation', (SELECT COUNT(*) FROM nation WHERE n_nationkey IN (SELECT n_nationkey FROM moved))
UNION ALL SELECT 'customer', (SELECT COUNT(*) FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM moved))
UNION ALL SELECT 'supplier', (SELECT COUNT(*) FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM moved))
UNION ALL SELECT 'orders', 0
UNION ALL SELECT 'lineitem', 0
"""

ORACLE_SQL["propagate_delete_rows"] = f"""
WITH gone AS (SELECT n_nationkey FROM nation, region WHERE n_regionkey = r_regionkey AND r_name = 'AFRICA')
SELECT 'region' AS table_name, 'survives' AS outcome, CAST(r_regionkey AS VARCHAR) AS key_value FROM region WHERE r_name <> 'AFRICA'
UNION ALL SELECT 'nation', 'survives', CAST(n_nationkey AS VARCHAR) FROM nation WHERE n_nationkey NOT IN (FROM gone)
UNION ALL SELECT 'customer', 'survives', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_nationkey NOT IN (FROM gone)
UNION ALL SELECT 'supplier', 'survives', CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_nationkey NOT IN (FROM gone)
UNION ALL SELECT 'lineitem', 'blocks', {_key('l_orderkey', 'l_linenumber')} FROM lineitem
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
      AND (l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (FROM gone))
           OR l_orderkey IN (SELECT o_orderkey FROM orders, customer WHERE c_custkey = o_custkey AND c_nationkey IN (FROM gone)))
"""

_RENUMBERED = "CASE WHEN {c} IN (SELECT n_nationkey FROM nation, region WHERE n_regionkey = r_regionkey AND r_name = 'AFRICA') THEN {c} + 100 ELSE {c} END::BIGINT"
ORACLE_SQL["propagate_key_change_rows"] = f"""
SELECT 'customer' AS table_name, c_custkey::BIGINT AS row_key, {_RENUMBERED.format(c='c_nationkey')} AS nation_key FROM customer
UNION ALL SELECT 'supplier', s_suppkey::BIGINT, {_RENUMBERED.format(c='s_nationkey')} FROM supplier
UNION ALL SELECT 'nation', NULL, {_RENUMBERED.format(c='n_nationkey')} FROM nation
"""

ORACLE_SQL["assign_ids"] = """
SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS seq_id FROM events
"""

# Walk every chain 2n steps: a node never reaching a root is cyclic; it is on
# its cycle if it comes back to itself; the cycle's smallest key shows up in
# the second half of the walk.
_CYCLE_WALK = """
WITH RECURSIVE g AS ({graph}),
known AS (SELECT g.v, CASE WHEN g.p IN (SELECT v FROM g) THEN g.p END AS p FROM g),
n AS (SELECT COUNT(*) AS n FROM known),
walk AS (
    SELECT v, p AS cur, 1 AS step FROM known WHERE p IS NOT NULL
    UNION ALL
    SELECT w.v, k.p, w.step + 1
    FROM walk w JOIN known k ON w.cur = k.v
    WHERE k.p IS NOT NULL AND w.step < 2 * (SELECT n FROM n))
SELECT v AS {node},
       bool_or(cur = v) AS on_cycle,
       min(cur) FILTER (WHERE step > (SELECT n FROM n)) AS cycle_id
FROM walk
GROUP BY v
HAVING max(step) = 2 * (SELECT n FROM n)
"""

ORACLE_SQL["find_cycles"] = _CYCLE_WALK.format(
    graph="SELECT l_partkey AS v, CASE WHEN max(l_orderkey) % 97 > 0 THEN max(l_orderkey * 1000000000 + l_suppkey) % 1000000000 END AS p FROM lineitem GROUP BY l_partkey",
    node="l_partkey",
)
ORACLE_SQL["find_cycles_orders"] = _CYCLE_WALK.format(
    graph="SELECT c.c_custkey AS v, o.o_custkey AS p FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_orderkey",
    node="c_custkey",
)

ORACLE_SQL["find_cycles_repeated"] = _CYCLE_WALK.format(
    graph="SELECT o_custkey AS v, min((o_orderkey * 3) // 40) FILTER (WHERE o_orderkey % 7 <> 0) AS p FROM orders GROUP BY o_custkey",
    node="o_custkey",
)

ORACLE_SQL["conflict_pairs"] = """
SELECT l.l_orderkey, l.l_linenumber, o.o_custkey AS c_custkey, l.l_suppkey AS s_suppkey,
       s.s_nationkey AS shared_nationkey
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_nationkey = s.s_nationkey)
"""

_EVENT_INTERVALS = "SELECT event_id, user_id, ts AS start_ts, ts + INTERVAL 30 MINUTE AS end_ts FROM events"

ORACLE_SQL["overlap_pairs"] = f"""
WITH iv AS ({_EVENT_INTERVALS})
SELECT a.user_id, a.event_id AS event_id_a, b.event_id AS event_id_b
FROM iv a JOIN iv b
  ON a.user_id = b.user_id AND a.event_id < b.event_id
 AND a.start_ts < b.end_ts AND a.end_ts > b.start_ts
"""

ORACLE_SQL["overlap_flags"] = f"""
WITH iv AS ({_EVENT_INTERVALS})
SELECT a.event_id, a.user_id, a.start_ts
FROM iv a
WHERE EXISTS (
    SELECT 1 FROM iv b
    WHERE b.user_id = a.user_id
      AND (b.start_ts < a.start_ts OR (b.start_ts = a.start_ts AND b.event_id < a.event_id))
      AND b.end_ts > a.start_ts)
"""

ORACLE_SQL["mismatch_lookup"] = """
SELECT l.l_orderkey, l.l_linenumber, o.o_orderstatus AS required_status, l.l_linestatus AS actual_status
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderstatus = 'F' AND l.l_linestatus <> 'F'
"""

ORACLE_SQL["cross_overlap"] = f"""
WITH iv AS ({_EVENT_INTERVALS}), typed AS (SELECT iv.*, e.event_type FROM iv JOIN events e USING (event_id))
SELECT p.user_id, p.event_id AS purchase_event_id, v.event_id AS view_event_id
FROM typed p JOIN typed v
  ON p.user_id = v.user_id AND p.start_ts < v.end_ts AND p.end_ts > v.start_ts
WHERE p.event_type = 'purchase' AND v.event_type = 'view'
"""

ORACLE_SQL["supervision_checks"] = f"""
WITH tree AS (
    SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey <> 0 THEN c_custkey // 10 END AS parent_key FROM customer)
SELECT 'no_self_parent' AS rule, 'customer' AS table_name, {_key('c_custkey')} AS key_value, 'check failed' AS detail
FROM tree WHERE parent_key = c_custkey
UNION ALL
SELECT 'building_needs_parent', 'customer', {_key('c_custkey')}, 'check failed'
FROM tree WHERE c_mktsegment = 'BUILDING' AND parent_key IS NULL
UNION ALL
SELECT 'automobile_has_no_parent', 'customer', {_key('c_custkey')}, 'check failed'
FROM tree WHERE c_mktsegment = 'AUTOMOBILE' AND parent_key IS NOT NULL
"""

_EARLIER = """
SELECT {out} FROM ({iv}) a
WHERE EXISTS (SELECT 1 FROM ({iv}) b WHERE b.key = a.key AND (b.s < a.s OR (b.s = a.s AND b.id < a.id)) AND b.e > a.s)
"""
ORACLE_SQL["place_overlap"] = _EARLIER.format(
    out="a.id AS event_id, a.key AS place",
    iv="SELECT event_id AS id, event_type || '-' || hour(ts) AS key, ts AS s, ts + INTERVAL 10 MINUTE AS e FROM events")
ORACLE_SQL["chief_overlap"] = _EARLIER.format(
    out="a.id AS o_orderkey, a.key AS o_custkey",
    iv="SELECT o_orderkey AS id, o_custkey AS key, o_orderdate AS s, o_orderdate + INTERVAL 30 DAY AS e FROM orders")
_SUPPLY = ("SELECT DISTINCT o_orderkey AS id, l_suppkey AS key, o_orderdate AS s, o_orderdate + INTERVAL 12 HOUR AS e "
           "FROM orders, lineitem WHERE l_orderkey = o_orderkey")
ORACLE_SQL["participant_overlap"] = _EARLIER.format(out="a.id AS event, a.key AS person", iv=_SUPPLY)
ORACLE_SQL["busy_chief"] = f"""
SELECT id AS event, key AS person FROM ({_SUPPLY}) a
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = a.key AND o.o_orderkey <> a.id
              AND o.o_orderdate < a.e AND o.o_orderdate + INTERVAL 12 HOUR > a.s)
"""

# the first delivery (views, clicks) meets the stored rows; the second meets those and what the first left accepted
# one event after the other: a step looks at the user's next event and the list of what the user has occupied
ORACLE_SQL["ingest_gate"] = """
WITH RECURSIVE iv AS (SELECT event_id AS id, user_id AS u, ts AS s, ts + INTERVAL 30 MINUTE AS e, user_id NOT IN (SELECT c_custkey FROM customer) AS unknown,
                   CASE WHEN event_type IN ('purchase', 'signup') THEN 0 WHEN event_type IN ('view', 'click') THEN 1 ELSE 2 END AS d FROM events),
todo AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY d, id) AS k FROM iv WHERE d > 0),
walk(u, k, id, hit, held) AS (
    SELECT u, 0::BIGINT, NULL::BIGINT, false, coalesce(list({'s': s, 'e': e}) FILTER (WHERE d = 0), []) FROM iv GROUP BY u
    UNION ALL
    SELECT u, k, id, hit, CASE WHEN hit OR unknown THEN held ELSE list_append(held, {'s': s, 'e': e}) END FROM (
        SELECT t.*, w.held, len(list_filter(w.held, lambda h: h.s < t.e AND h.e > t.s)) > 0 AS hit FROM walk w JOIN todo t ON t.u = w.u AND t.k = w.k + 1))
SELECT id AS event_id, 'overlaps' AS rule FROM walk WHERE hit
UNION ALL SELECT id, 'unknown_user' FROM todo WHERE unknown
"""

ORACLE_SQL["accept_in_order"] = """
WITH RECURSIVE todo AS (SELECT event_id AS id, user_id AS u, ts AS s, ts + INTERVAL 6 HOUR AS e, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
walk(u, k, id, hit, held) AS (
    SELECT DISTINCT u, 0::BIGINT, NULL::BIGINT, false, [{'s': NULL::TIMESTAMP, 'e': NULL::TIMESTAMP}] FROM todo
    UNION ALL
    SELECT u, k, id, hit, CASE WHEN hit THEN held ELSE list_append(held, {'s': s, 'e': e}) END FROM (
        SELECT t.*, w.held, len(list_filter(w.held, lambda h: h.s < t.e AND h.e > t.s)) > 0 AS hit FROM walk w JOIN todo t ON t.u = w.u AND t.k = w.k + 1))
SELECT id AS event_id, u AS user_id, CASE WHEN hit THEN 'overlaps' END AS rule FROM walk WHERE id IS NOT NULL
"""

ORACLE_SQL["role_conflict"] = """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey AS person_key
FROM lineitem l
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_custkey = l.l_suppkey)
"""

ORACLE_SQL["forbidden_member"] = """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey
FROM lineitem l
WHERE l.l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)
"""
