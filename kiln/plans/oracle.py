"""DuckDB SQL equivalent of each catalogue query (the correctness oracle).

Written against the driver's views (``events``, ``lineitem``, ...).  The
derived inputs of :mod:`kiln.plans.views` are repeated here as CTEs.  Types
are cast to what Spark returns (DuckDB sums ints to HUGEINT and returns
BIGINT from ``year``), and every computed column carries the Spark alias.
"""

from __future__ import annotations

from kiln.plans.views import (
    AIRPORTS,
    DISTANCE_PER_USER,
    FUNDED_PER_NATION,
    LOAN_NULL_PAID_EVERY,
    ORIGIN_BY_EVENT,
)
from kiln.sources.literal import _CHAR_STEPS, _USAGE_STEP, NAME_ALPHABET, NAME_LENGTH, NAME_PREFIX, USAGE_RANGE

_ORIGIN = "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{c}'" for e, c in ORIGIN_BY_EVENT) + " END"
_N_AIR = len(AIRPORTS)
_DEST = "[" + ", ".join(f"'{a}'" for a in AIRPORTS) + f"][((user_id % {_N_AIR}) + {_N_AIR}) % {_N_AIR} + 1]"

FLIGHTS = f"""flights AS (
  SELECT strftime(ts, '%m%d%H%M') AS date,
         TRY_CAST(floor(value) AS INTEGER) AS delay,
         user_id * {DISTANCE_PER_USER} AS distance,
         {_ORIGIN} AS origin,
         {_DEST} AS destination
  FROM events)"""


LOANS = f"""loans AS (
  SELECT c_custkey AS loan_id,
         CAST(c_nationkey * {FUNDED_PER_NATION} AS INTEGER) AS funded_amnt,
         CASE WHEN c_custkey % {LOAN_NULL_PAID_EVERY} = 0 THEN NULL ELSE c_acctbal END AS paid_amnt,
         c_mktsegment AS addr_state
  FROM customer)"""


def _usage_cte(seed: int = 42) -> str:
    n = len(NAME_ALPHABET)
    chars = [
        f"substr('{NAME_ALPHABET}', CAST(((c_custkey * {step} + {seed + 13 * i}) % {n} + {n}) % {n} + 1 AS INTEGER), 1)"
        for i, step in enumerate(_CHAR_STEPS[:NAME_LENGTH])
    ]
    uname = f"concat('{NAME_PREFIX}', " + ", ".join(chars) + ")"
    usage = (
        f"CAST(((c_custkey * {_USAGE_STEP} + {seed * 31}) % {USAGE_RANGE} + {USAGE_RANGE}) % {USAGE_RANGE} AS INTEGER)"
    )
    return f"usage AS (SELECT c_custkey AS uid, {uname} AS uname, {usage} AS usage FROM customer)"


USAGE = _usage_cte()
COST = "CASE WHEN usage > 750 THEN usage * CAST(0.15 AS DOUBLE) ELSE usage * CAST(0.50 AS DOUBLE) END"

EVENTS_ALL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
PROMO = "p_type LIKE 'PRO%' AND p_size > 20 AND p_name LIKE '%ring'"
PARTS = "SELECT p_partkey, p_name, p_type, p_size FROM part"
# as ranges with gaps: quantities on a bound, negatives and NULL have no band
BAND = """coalesce((SELECT max(b.label) FROM (VALUES ('bulk', 40, 1e18), ('large', 25, 40), ('medium', 10, 25), ('small', 0, 10)) b(label, lo, hi)
  WHERE quantity > b.lo AND quantity < b.hi), CASE WHEN quantity = 0 THEN 'none' END, 'edge')"""
BANDED = f"""WITH q AS (SELECT l_returnflag, nullif(replace(l_quantity::INT::VARCHAR || '#', '#', ''), '50')::DOUBLE AS q0, l_orderkey, l_linenumber FROM lineitem),
q1 AS (SELECT l_returnflag, if(q0 = 1, 0::DOUBLE, q0) AS quantity, l_orderkey, l_linenumber FROM q)
SELECT *, {BAND} AS band FROM q1 ORDER BY l_returnflag NULLS FIRST, quantity DESC NULLS LAST, l_orderkey, l_linenumber"""
SUPPLIED = "sup AS (SELECT l_returnflag, l_suppkey, SUM(l_quantity) AS supplied FROM lineitem WHERE l_returnflag = 'A' OR l_returnflag = 'R' GROUP BY ALL)"
TOP5 = f"""WITH {SUPPLIED}
SELECT a.l_returnflag, a.l_suppkey, a.supplied, CAST(1 + count(DISTINCT b.supplied) AS INTEGER) AS place
FROM sup a LEFT JOIN sup b ON a.l_returnflag = b.l_returnflag AND b.supplied > a.supplied
GROUP BY ALL HAVING place <= 5 ORDER BY a.l_returnflag, place, a.l_suppkey"""
PRICED = "SELECT l_orderkey, l_linenumber, l_tax, nullif(l_discount, 0.07) AS discount, if(coalesce(nullif(l_discount, 0.07), 1) > 0.04, 'reduced', 'list') AS status FROM lineitem"
TYPED_LINES = """SELECT l_orderkey AS line_order, l_linenumber AS line_no, CAST(l_quantity / 8 AS FLOAT) AS quantity, l_extendedprice AS price,
  l_returnflag = 'R' AS returned, l_linestatus AS status, strftime(l_shipdate, '%m/%d/%Y') AS ship_day, l_shipdate AS shipped FROM lineitem"""
SHIP_MONTHS = """sm AS (
  SELECT l_suppkey, CAST(substr(strftime(l_shipdate, '%m%d%H%M'), 1, 2) AS INTEGER) AS month, l_quantity
  FROM lineitem WHERE l_returnflag = 'R')"""


def _dec42(x: str) -> str:
    # Spark rounds the decimal text of the double half-up; round the
    # 10-digit decimal form the same way before the narrow (overflowing) cast.
    return f"TRY_CAST(ROUND(CAST({x} AS DECIMAL(38, 10)), 2) AS DECIMAL(4, 2))"


def _pivot(avg_expr) -> str:
    cols = []
    for label, m in (("JAN", 1), ("FEB", 2)):
        cols.append(f"{avg_expr(f'AVG(l_quantity) FILTER (WHERE month = {m})')} AS {label}_AvgQuantity")
        cols.append(f"MAX(l_quantity) FILTER (WHERE month = {m}) AS {label}_MaxQuantity")
    return f"WITH {SHIP_MONTHS} SELECT l_suppkey, {', '.join(cols)} FROM sm GROUP BY l_suppkey ORDER BY l_suppkey"


# Loan table states after each step (see catalog.loan_table_flow).
UPDATES_VALUES = "(VALUES (1111111, 1000, 1000.0, 'TX', false), (2222222, 2000, 0.0, 'CA', true))"
_V0 = f"WITH {LOANS} SELECT * FROM loans"
_V1 = f"""WITH {LOANS},
u(loan_id, funded_amnt, paid_amnt, addr_state, closed) AS {UPDATES_VALUES},
v1 AS (
  SELECT loan_id, funded_amnt, paid_amnt, addr_state, CAST(NULL AS BOOLEAN) AS closed FROM loans
  UNION ALL
  SELECT CAST(loan_id AS BIGINT), CAST(funded_amnt AS INTEGER), CAST(paid_amnt AS DOUBLE), addr_state, closed FROM u),
v2 AS (
  SELECT loan_id, funded_amnt, paid_amnt,
         CASE WHEN addr_state = 'HOUSEHOLD' THEN 'FURNITURE' ELSE addr_state END AS addr_state, closed
  FROM v1),
v3 AS (SELECT * FROM v2 WHERE NOT coalesce(funded_amnt >= paid_amnt, false)),
v4 AS (
  SELECT * FROM v3 WHERE loan_id IS NULL OR loan_id NOT IN (SELECT loan_id FROM u)
  UNION ALL
  SELECT CAST(loan_id AS BIGINT), CAST(funded_amnt AS INTEGER), CAST(paid_amnt AS DOUBLE), addr_state, closed FROM u)"""


ORACLE: dict[str, str] = {
    "group_sum_desc": """SELECT l_returnflag, l_linestatus, SUM(l_quantity) AS Total FROM lineitem
GROUP BY l_returnflag, l_linestatus ORDER BY Total DESC, l_returnflag, l_linestatus""",
    # ------------------------------------------------------------- scans
    "csv_infer_scan": EVENTS_ALL,
    "csv_roundtrip": EVENTS_ALL,
    "csv_declared_scan": EVENTS_ALL,
    "csv_typed_scan": TYPED_LINES,
    "float_stats": f"""SELECT MIN(quantity) AS MinQuantity, MAX(quantity) AS MaxQuantity,
       AVG(CAST(quantity AS DOUBLE)) AS AvgQuantity, SUM(CAST(quantity AS DOUBLE)) AS SumQuantity FROM ({TYPED_LINES})""",
    "bucketed_join": "SELECT o.*, c.* FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey",
    "bucketed_join_hot": """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE 1 END AS account, c_custkey, c_name
FROM orders JOIN customer ON c_custkey = CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE 1 END""",
    "csv_split_malformed": """WITH e AS (SELECT event_id, event_type,
  CASE WHEN event_id % 50 = 0 THEN 'n/a' WHEN event_id % 77 = 0 THEN '99999999999' ELSE CAST(user_id AS VARCHAR) END AS n FROM events)
SELECT event_id, event_type, CAST(n AS INTEGER) AS n, CAST(NULL AS VARCHAR) AS line FROM e WHERE event_id % 50 <> 0 AND event_id % 77 <> 0
UNION ALL SELECT NULL, NULL, NULL, event_id || ',' || event_type || ',' || n FROM e WHERE event_id % 50 = 0 OR event_id % 77 = 0""",
    "cached_join": """WITH j AS (SELECT c_custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey),
k AS (SELECT c_custkey, count(*) AS orders FROM j GROUP BY c_custkey)
SELECT 'customers' AS kind, CAST(orders AS VARCHAR) AS name, count(*) AS n FROM k GROUP BY orders
UNION ALL SELECT 'segment', c_mktsegment, count(*) FROM j GROUP BY c_mktsegment""",
    "tsv_scan": EVENTS_ALL,
    "json_infer_scan": EVENTS_ALL,
    "json_roundtrip": EVENTS_ALL,
    "csv_string_cast": f"""WITH {FLIGHTS}
SELECT date, delay, CAST(distance AS INTEGER) AS distance, origin, destination FROM flights""",
    "json_declared_array": """SELECT event_id AS Id, event_type AS Kind, user_id AS Hits,
       event_type AS FirstCampaign, 2 AS NumCampaigns, event_type || '|user-' || user_id AS AllCampaigns FROM events""",
    "parquet_roundtrip": "SELECT * FROM orders",
    "sorted_write_join": """SELECT o.*, c.* FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    # ---------------------------------------------------- project / filter
    "project_filter_ne": "SELECT event_id, ts, event_type FROM events WHERE event_type <> 'view'",
    "count_distinct_nonnull": """SELECT COUNT(DISTINCT event_type) AS DistinctEventTypes
FROM events WHERE event_type IS NOT NULL""",
    "distinct_values": "SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL",
    "rename_filter": "SELECT l_quantity AS QuantityOrdered FROM lineitem WHERE l_quantity > 5",
    "parse_timestamps": """SELECT event_id, date_trunc('day', ts) AS IncidentDate,
       date_trunc('second', ts) AS AvailableDtTS FROM events""",
    "distinct_years": "SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS Year FROM lineitem ORDER BY Year",
    "top_groups_by_count": """SELECT user_id, COUNT(*) AS count FROM events WHERE user_id IS NOT NULL
GROUP BY user_id ORDER BY count DESC, user_id LIMIT 10""",
    "global_stats": """SELECT CAST(SUM(l_linenumber) AS BIGINT) AS SumLineNumbers, AVG(l_quantity) AS AvgQuantity,
       MIN(l_quantity) AS MinQuantity, MAX(l_quantity) AS MaxQuantity FROM lineitem""",
    "typed_filter_and": "SELECT * FROM lineitem WHERE l_quantity > 30 AND l_discount > 0.05",
    "typed_filter_project": """SELECT l_quantity, l_returnflag, l_orderkey, l_suppkey
FROM lineitem WHERE l_quantity > 25""",
    "column_select_where": """SELECT l_quantity, l_returnflag, l_orderkey, l_suppkey
FROM lineitem WHERE l_quantity > 25""",
    "first_row": """SELECT l_quantity, l_returnflag, l_orderkey, l_suppkey FROM lineitem WHERE l_quantity > 25
ORDER BY l_quantity NULLS FIRST, l_returnflag NULLS FIRST, l_orderkey NULLS FIRST, l_suppkey NULLS FIRST LIMIT 1""",
    # ------------------------------------------------------------ flights
    "normalize_flight_ts": f"""WITH {FLIGHTS}
SELECT CAST(date AS INTEGER) AS date, delay, CAST(distance AS INTEGER) AS distance, origin, destination,
       try_strptime('2010' || lpad(CAST(CAST(date AS INTEGER) AS VARCHAR), 8, '0'), '%Y%m%d%H%M') AS flight_ts
FROM flights""",
    "sql_filter_sort": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 250000 ORDER BY 3 DESC, 1, 2",
    "sql_conjunction": """SELECT l_orderkey, l_linenumber, l_partkey, l_discount FROM lineitem
WHERE l_linestatus = 'F' AND l_returnflag = 'R' AND l_quantity >= 40 ORDER BY 4 DESC, 1, 2, 3""",
    "df_filter_topk": f"""WITH {FLIGHTS}
SELECT distance, origin, destination FROM flights WHERE distance > 1000
ORDER BY distance DESC, origin NULLS FIRST, destination NULLS FIRST LIMIT 10""",
    "sql_case_buckets": BANDED,
    "case_buckets_df": BANDED,
    "sql_limit_view": "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    # ------------------------------------------------------------- delays
    "expr_like_filter": f"{PARTS} WHERE {PROMO}",
    "union_all_df": f"{PARTS} UNION ALL {PARTS} WHERE {PROMO}",
    "union_all_sql": f"{PARTS} UNION ALL {PARTS} WHERE {PROMO}",
    "join_dimension": """SELECT n.n_name, n.n_regionkey, s.s_suppkey, s.s_name, s.s_acctbal
FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey""",
    "join_dimension_sql": """SELECT n.n_name, n.n_regionkey, s.s_suppkey, s.s_name, s.s_acctbal
FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey""",
    "in_list_group_sum": f"WITH {SUPPLIED} SELECT * FROM sup",
    "top_per_group_sql": TOP5,
    "top_per_group_df": TOP5,
    "top_values_per_group": """SELECT * FROM (SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice,
  CAST(dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC) AS INTEGER) AS place FROM lineitem) WHERE place <= 5000""",
    "add_status_column": PRICED,
    "drop_column": f"SELECT * EXCLUDE (l_tax) FROM ({PRICED})",
    "rename_column": f"SELECT * EXCLUDE (l_tax, status), status AS price_status FROM ({PRICED})",
    "pivot_sql": """SELECT l_suppkey,
  """ + ", ".join(f"{_dec42(f'AVG(l_quantity * 4) FILTER (WHERE year(l_shipdate) = {y})')} AS Y{y % 100}_mean_quarters, 4 * MIN(l_quantity) FILTER (WHERE year(l_shipdate) = {y}) AS Y{y % 100}_least_quarters" for y in (1996, 1998)) + """
FROM lineitem GROUP BY l_suppkey ORDER BY l_suppkey""",
    "pivot_df": _pivot(lambda x: x),
    # -------------------------------------------------------------- usage
    "synthetic_usage": f"WITH {USAGE} SELECT * FROM usage",
    "filter_lambda": f"WITH {USAGE} SELECT * FROM usage WHERE usage > 900 ORDER BY usage DESC",
    "filter_named_fn": f"WITH {USAGE} SELECT * FROM usage WHERE usage > 900 ORDER BY usage DESC",
    "map_to_value": f"WITH {USAGE} SELECT {COST} AS value FROM usage",
    "map_to_value_fn": f"WITH {USAGE} SELECT {COST} AS value FROM usage",
    "map_to_record": f"WITH {USAGE} SELECT *, {COST} AS cost FROM usage",
    "top_cost": f"WITH {USAGE} SELECT *, {COST} AS cost FROM usage ORDER BY cost DESC, uid LIMIT 10",
    "literal_join": """WITH users(uid, name, user_state) AS (
  VALUES (1, 'Alice', 'CO'), (2, 'Bob', 'NY'), (3, 'Charlie', 'TX'), (4, 'Diana', 'CA'), (22, 'Eve', 'CO'))
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, o.o_orderstatus,
       CAST(u.uid AS INTEGER) AS uid, u.name, u.user_state
FROM orders o JOIN users u ON o.o_custkey = u.uid""",
    # ------------------------------------------------------ versioned table
    "table_load_count": f"WITH {LOANS} SELECT COUNT(*) AS count FROM loans",
    "table_preview": f"WITH {LOANS} SELECT * FROM loans ORDER BY loan_id LIMIT 5",
    "append_enforced": _V0,
    "append_evolved": _V1 + " SELECT * FROM v1",
    "table_update": _V1 + " SELECT * FROM v2",
    "table_delete": _V1 + " SELECT * FROM v3",
    "table_merge_upsert": _V1 + " SELECT * FROM v4",
    "append_stored_schema": _V1 + """ SELECT * FROM v1
UNION ALL SELECT loan_id, funded_amnt, paid_amnt, addr_state, NULL FROM loans WHERE loan_id % 2 = 0""",
    "partitioned_update": f"""WITH {LOANS} SELECT loan_id, funded_amnt, paid_amnt,
       CASE WHEN addr_state = 'HOUSEHOLD' THEN 'FURNITURE' ELSE addr_state END AS addr_state FROM loans""",
    "partitioned_delete": f"WITH {LOANS} SELECT * FROM loans WHERE NOT coalesce(addr_state = 'BUILDING' AND funded_amnt >= paid_amnt, false)",
    "partitioned_merge": f"""WITH {LOANS},
ch AS (SELECT loan_id, funded_amnt, paid_amnt, CASE WHEN loan_id % 30 = 0 THEN 'MACHINERY' ELSE addr_state END AS addr_state
       FROM loans WHERE addr_state = 'BUILDING' AND loan_id % 10 = 0)
SELECT * FROM loans WHERE loan_id NOT IN (SELECT loan_id FROM ch)
UNION ALL SELECT loan_id, CAST(funded_amnt + 1 AS INTEGER), paid_amnt, addr_state FROM ch
UNION ALL SELECT loan_id + 10000000, CAST(funded_amnt + 1 AS INTEGER), NULL, addr_state FROM ch""",
    # ------------------------------------------------------------ stream
    "stream_batch_table": "SELECT * FROM orders",
    "stream_drift": "SELECT *, CASE WHEN NOT coalesce(o_orderdate < TIMESTAMP '1998-01-01', false) THEN CAST(trunc(o_totalprice * 100) AS BIGINT) END AS cents FROM orders",
    "stream_append": "SELECT * FROM orders",
    "stream_timed": "SELECT * FROM orders",
}
