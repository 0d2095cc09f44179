"""The same results in plain SQL, one statement per query."""

from __future__ import annotations

FACT = """(SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS search_date,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS found_at,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS depart_date,
  l_linenumber AS number_of_changes, l_tax AS trip_class, l_extendedprice AS value,
  l_returnflag AS origin, l_partkey AS destination, l_suppkey AS airline FROM lineitem)"""

WIDE = f"""SELECT replace(f.found_at, '-', '/') AS found_at,
  CASE WHEN f.value > 100000 THEN 'A' WHEN f.value >= 15000 THEN 'B' ELSE 'C' END AS class,
  f.value, f.number_of_changes, f.depart_date, f.search_date,
  CAST(s_suppkey AS VARCHAR) AS airline_code,
  replace(s_name, '#', ' ') AS airline_name_translations,
  f.origin, CAST(f.destination AS VARCHAR) AS destination, p_brand AS country_code,
  replace(p_type, ' ', '/') AS time_zone, p_size <= 10 AS flightable, p_type AS iata_type,
  p_name AS airport_name, p_retailprice AS airport_latitude,
  CAST(p_size AS DOUBLE) AS airport_longitude, '2024-01-01' AS process_date
FROM (SELECT DISTINCT search_date, found_at, depart_date, number_of_changes, value, origin,
        destination, airline FROM {FACT}) f
JOIN supplier ON f.airline = s_suppkey AND s_acctbal > 0
JOIN part ON f.destination = p_partkey AND p_size <= 25
WHERE f.origin = 'A'"""

NAMED = f"""SELECT f.*, s_suppkey, s_name, part.*
FROM {FACT} f
JOIN supplier ON f.airline = s_suppkey AND s_acctbal > 0
JOIN part ON f.destination = p_partkey AND p_size <= 25
WHERE p_name <> 'small ring'"""

NULLED = "(SELECT nullif(l_returnflag, 'N') AS flag, nullif(l_linenumber, 7) AS num FROM lineitem)"

RULES = (
    ("changes", "l_linenumber >= 4"),
    ("quantity", "l_quantity >= 51"),
    ("discount", "l_discount > 0.09"),
)
VERDICTS = " UNION ALL ".join(
    f"SELECT '{name}' AS rule, '{test}' AS message, count(*) AS n_rows, "
    f"count(*) FILTER (WHERE {test}) AS n_violations, "
    f"count(*) FILTER (WHERE {test}) = 0 AS passed FROM lineitem"
    for name, test in RULES
)


def _each(template: str, columns) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in columns)


def _describe(columns: dict[str, str], source: str) -> str:
    """columns: name -> expression; a leading ~ marks text."""
    parts = []
    for name, expr in columns.items():
        if expr.startswith("~"):
            e = expr[1:]
            stats = (
                f"NULL AS mean, NULL AS stddev, NULL AS min, NULL AS max, "
                f"min({e}) AS min_text, max({e}) AS max_text"
            )
        else:
            e = expr
            stats = (
                f"round(avg({e}), 4) AS mean, round(stddev_samp({e}), 4) AS stddev, "
                f"CAST(min({e}) AS DOUBLE) AS min, CAST(max({e}) AS DOUBLE) AS max, "
                "NULL AS min_text, NULL AS max_text"
            )
        parts.append(f"SELECT '{name}' AS \"column\", count({e}) AS n, {stats} FROM {source}")
    return " UNION ALL ".join(parts)


def _spearman(x: str, y: str) -> str:
    def rank(c: str) -> str:
        return (
            f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"
        )

    return (
        f"SELECT '{x}' AS column_x, '{y}' AS column_y, round(corr(rx, ry), 6) AS r "
        f"FROM (SELECT {rank(x)} AS rx, {rank(y)} AS ry FROM lineitem)"
    )


def _cramers_v(x: str, y: str) -> str:
    """On the full grid of categories, empty cells included."""
    return f"""SELECT * FROM (WITH t AS (SELECT {x} AS a, {y} AS b,
  count(*)::DOUBLE AS c FROM lineitem GROUP BY 1, 2),
ra AS (SELECT a, sum(c) AS x FROM t GROUP BY a), rb AS (SELECT b, sum(c) AS y FROM t GROUP BY b),
z AS (SELECT sum(c) AS n FROM t),
s AS (SELECT sum(power(coalesce(c, 0) - x * y / n, 2) / (x * y / n)) / max(n) AS phi2,
  max(n) AS n, count(DISTINCT ra.a) AS r, count(DISTINCT rb.b) AS k
  FROM ra CROSS JOIN rb CROSS JOIN z LEFT JOIN t ON t.a = ra.a AND t.b = rb.b)
SELECT '{x}' AS column_x, '{y}' AS column_y, round(sqrt(phi2 / (least(r, k) - 1)), 6) AS v,
  round(sqrt(greatest(0, phi2 - (r - 1) * (k - 1) / (n - 1))
    / (least(r - power(r - 1, 2) / (n - 1), k - power(k - 1, 2) / (n - 1)) - 1)), 6) AS v_corrected
FROM s)"""


ORACLES: dict[str, str] = {
    "tickets_wide": WIDE,
    "tickets_explore": f"""SELECT found_at,
  CASE WHEN value > 100000 THEN 'A' WHEN value >= 15000 THEN 'B' ELSE 'C' END AS class,
  value, number_of_changes, depart_date, search_date,
  CAST(s_suppkey AS VARCHAR) AS airline_code,
  replace(s_name, '#', '''') AS airline_name_translations, origin,
  CAST(destination AS VARCHAR) AS destination, p_brand AS country_code,
  replace(p_type, ' ', '-') AS time_zone, p_size <= 10 AS flightable, p_type AS iata_type,
  p_name AS airport_name, replace(p_name, ' ', '''') AS airport_name_translations,
  p_retailprice AS airport_latitude, CAST(p_size AS DOUBLE) AS airport_longitude
FROM ({NAMED}) WHERE number_of_changes < 5""",
    "explore_description": _describe(
        {
            "number_of_changes": "number_of_changes",
            "value": "value",
            "origin": "~origin",
            "destination": "~CAST(destination AS VARCHAR)",
            "airline_code": "~CAST(s_suppkey AS VARCHAR)",
            "airline_name_translations": "~replace(s_name, '#', '''')",
            "airport_name": "~p_name",
            "airport_name_translations": "~replace(p_name, ' ', '''')",
            "airport_latitude": "p_retailprice",
            "airport_longitude": "p_size",
            "country_code": "~p_brand",
            "time_zone": "~replace(p_type, ' ', '/')",
            "iata_type": "~p_type",
        },
        f"({NAMED})",
    ),
    "batch_result": f"""SELECT * REPLACE (
  CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) AS value,
  CAST(CAST(airport_latitude AS DECIMAL(10,2)) AS VARCHAR) AS airport_latitude,
  CAST(CAST(airport_longitude AS DECIMAL(10,2)) AS VARCHAR) AS airport_longitude)
FROM ({WIDE}) WHERE number_of_changes < 4""",
    "batch_blocked": f"""SELECT 'changes' AS rule, 'number_of_changes >= 4' AS message,
  count(*) AS n_violations FROM ({WIDE}) WHERE number_of_changes >= 4 HAVING count(*) > 0""",
    "json_struct_scan": """SELECT CAST(p_partkey AS VARCHAR) AS code,
  nullif(p_name, 'small ring') AS name, replace(p_name, ' ', '''') AS "name_translations.en",
  p_retailprice AS "coordinates.lat", CAST(p_size AS DOUBLE) AS "coordinates.lon",
  p_brand AS country_code, replace(p_type, ' ', '/') AS time_zone, p_type AS iata_type,
  p_size <= 10 AS flightable FROM part""",
    "json_field_extract": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT)
  AS "props.k" FROM events""",
    "flatten_struct": """SELECT p_partkey, p_name AS "names.en",
  CASE WHEN p_size > 25 THEN p_retailprice END AS "coords.point.lat",
  CASE WHEN p_size > 25 THEN p_size END AS "coords.size" FROM part""",
    "csv_roundtrip": """SELECT event_id, CAST(ts AS VARCHAR) AS ts,
  nullif(event_type, 'error') AS event_type, value, props FROM events""",
    "partition_replace": """SELECT o_orderkey,
  CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) AS o_totalprice,
  CASE o_orderstatus WHEN 'P' THEN '2024-01-01' ELSE '2024-01-02' END AS process_date
FROM orders WHERE o_orderstatus IN ('O', 'P')""",
    "bucketed_join": """SELECT o_orderkey, o_orderstatus, o_custkey, count(*) AS n_lines,
  CAST(sum(l_suppkey) AS BIGINT) AS suppliers, max(l_linenumber) AS last_line
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL""",
    "sql_steps": """SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0
GROUP BY c_mktsegment""",
    "replace_literals": """SELECT doc_id, replace(replace(text, '''', ' '), '-', '/') AS text,
  replace(replace(source, 'src', 's/'), '/', '-') AS source FROM documents""",
    "slash_dates": """SELECT event_id, replace(CAST(ts AS VARCHAR), '-', '/') AS found_at
FROM events""",
    "cast_columns": """SELECT event_id, CAST(floor(value) AS INT) AS v_int,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS day, try_cast(event_type AS INT) AS bad_int FROM events""",
    "cast_failures": """SELECT 'o_totalprice' AS "column",
  count(*) FILTER (WHERE o_totalprice >= 99999.995) AS n_failed FROM orders
UNION ALL SELECT 'o_orderpriority', count(*) FILTER (WHERE length(o_orderpriority) > 8) FROM orders
UNION ALL SELECT 'o_orderstatus', count(o_orderstatus) FROM orders""",
    "conform_schema": """SELECT o_orderkey,
  CASE WHEN o_totalprice < 99999.995
    THEN CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) END AS o_totalprice,
  CASE WHEN length(o_orderpriority) <= 8 THEN o_orderpriority END AS o_orderpriority
FROM orders""",
    "project_rename_drop": """SELECT CAST(p_partkey AS VARCHAR) AS code,
  p_retailprice AS latitude, replace(p_name, ' ', '''') AS english FROM part""",
    "price_band": """SELECT o_orderkey, v AS value,
  CASE WHEN v > 100000 THEN 'A' WHEN v >= 15000 THEN 'B' ELSE 'C' END AS class,
  CASE WHEN v < 250000 THEN 'low' ELSE 'high' END AS half
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS v FROM orders)""",
    "batch_date_column": "SELECT o_orderkey, o_custkey, '2024-01-01' AS process_date FROM orders",
    "filter_eq": """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_returnflag = 'A'""",
    "filter_lt": "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_linenumber < 5",
    "drop_nulls": """SELECT c_custkey, c_mktsegment, c_nationkey FROM customer
WHERE c_mktsegment <> 'MACHINERY' AND c_nationkey <> 3""",
    "local_batch_date": """SELECT event_id, strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d')
  AS process_date FROM events""",
    "join_dim_inner": """SELECT l_orderkey, l_linenumber, l_partkey, s_name FROM lineitem
JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal > 0""",
    "star_join": """SELECT l_orderkey, l_linenumber, s_name, p_name FROM lineitem
JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
WHERE s_acctbal > 0 AND p_size <= 25""",
    "star_join_orders": """SELECT o_orderkey, o_totalprice, c_name AS name, n_name AS nation
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE c_acctbal > 0 AND n_regionkey <> 2""",
    "unmatched_keys": """SELECT l_suppkey AS key, count(*) AS n FROM lineitem WHERE NOT EXISTS
  (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal > 0) GROUP BY l_suppkey""",
    "dedupe_rows": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "dedupe_subset": """SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_extendedprice, l_partkey) AS r FROM lineitem) WHERE r = 1""",
    "duplicate_report": """SELECT CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_distinct,
  CAST(sum(c) - count(*) AS BIGINT) AS n_duplicates
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "distinct_values": "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem",
    "duplicate_keys": """SELECT l_orderkey AS key, count(*) AS n FROM lineitem GROUP BY l_orderkey
HAVING count(*) > 1""",
    "duplicate_rows": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY n DESC, 1, 2 LIMIT 20""",
    "value_counts": f"""SELECT 'trip_class' AS "column", CAST(trip_class AS VARCHAR) AS value,
  count(*) AS n FROM {FACT} GROUP BY trip_class
UNION ALL SELECT 'origin', nullif(origin, 'N'), count(*) FROM {FACT} GROUP BY origin
UNION ALL SELECT 'number_of_changes', CAST(CAST(number_of_changes AS DOUBLE) AS VARCHAR), count(*)
  FROM {FACT} GROUP BY number_of_changes
UNION ALL SELECT 'destination', CAST(destination AS VARCHAR), count(*) FROM {FACT}
  GROUP BY destination
UNION ALL SELECT 'airline', CAST(airline AS VARCHAR), count(*) FROM {FACT} GROUP BY airline""",
    "null_flag_counts": f"""SELECT 'l_returnflag' AS "column", count(*) - count(flag) AS n_null,
  count(flag) AS n_not_null FROM {NULLED}
UNION ALL SELECT 'l_linenumber', count(*) - count(num), count(num) FROM {NULLED}""",
    "shape": "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem",
    "describe_columns": _describe(
        {
            "l_extendedprice": "l_extendedprice",
            "l_quantity": "l_quantity",
            "l_linenumber": "nullif(l_linenumber, 7)",
            "l_returnflag": "~nullif(l_returnflag, 'A')",
        },
        "lineitem",
    ),
    "cluster_sample": """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE CAST(l_shipdate AS DATE) IN (SELECT d FROM
  (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
  ORDER BY md5(concat('0', '|', CAST(d AS VARCHAR))), d LIMIT 100)""",
    "profile_sample": f"""WITH s AS (SELECT * FROM {FACT} WHERE found_at IN (SELECT k FROM
  (SELECT DISTINCT found_at AS k FROM {FACT}) ORDER BY md5(concat('7|', k)), k LIMIT 500))
SELECT 'value' AS "column", count(value) AS n, round(avg(value), 2) AS mean,
  round(sum(value), 2) AS sum FROM s
UNION ALL SELECT 'number_of_changes', count(number_of_changes), round(avg(number_of_changes), 2),
  CAST(sum(number_of_changes) AS DOUBLE) FROM s""",
    "threshold_violations": " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, l_partkey, '{test}' AS message FROM lineitem WHERE {test}"
        for _, test in RULES
    ),
    "gate_report": VERDICTS,
    "alert_rows": f"SELECT rule, message, n_violations FROM ({VERDICTS}) WHERE NOT passed",
    "profile_overview": f"""WITH t AS (SELECT count(*) AS n,
  CAST(sum((flag IS NULL)::INT + (num IS NULL)::INT) AS BIGINT) AS m FROM {NULLED}),
d AS (SELECT count(*) AS k FROM (SELECT DISTINCT flag, num FROM {NULLED}))
SELECT n AS n_rows, 2 AS n_columns, m AS missing_cells,
  round(CAST(m AS DOUBLE) / (n * 2), 6) AS missing_share, n - k AS duplicate_rows,
  round(CAST(n - k AS DOUBLE) / n, 6) AS duplicate_share FROM t, d""",
    "profile_types": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CASE WHEN count(DISTINCT {c}) <= 2 THEN 'boolean' "
        f"ELSE '{kind}' END AS kind, count(DISTINCT {c}) AS n_distinct FROM lineitem"
        for c, kind in (
            ("l_orderkey", "numeric"),
            ("l_linestatus", "categorical"),
            ("l_returnflag", "categorical"),
            ("l_shipdate", "datetime"),
            ("l_tax", "numeric"),
        )
    ),
    "profile_columns": """SELECT 'c_acctbal' AS "column", count(DISTINCT c_acctbal) AS n_distinct,
  count(*) FILTER (WHERE c_acctbal IS NULL) AS n_missing,
  count(*) FILTER (WHERE c_acctbal = 0) AS n_zero,
  count(*) FILTER (WHERE c_acctbal < 0) AS n_negative,
  count(*) FILTER (WHERE isinf(c_acctbal)) AS n_infinite FROM customer
UNION ALL SELECT 'c_nationkey', count(DISTINCT nullif(c_nationkey, 3)),
  count(*) FILTER (WHERE c_nationkey = 3), count(*) FILTER (WHERE c_nationkey = 0),
  count(*) FILTER (WHERE c_nationkey < 0), 0 FROM customer
UNION ALL SELECT 'c_mktsegment', count(DISTINCT c_mktsegment), 0, 0, 0, 0 FROM customer""",
    "profile_quantiles": _each(
        """SELECT '{c}' AS "column", round(min({c}), 4) AS min,
  round(quantile_cont({c}, 0.05), 4) AS q05, round(quantile_cont({c}, 0.25), 4) AS q25,
  round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75,
  round(quantile_cont({c}, 0.95), 4) AS q95, round(max({c}), 4) AS max,
  round(max({c}) - min({c}), 4) AS range,
  round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 4) AS iqr,
  round(stddev_samp({c}) / avg({c}), 4) AS cv, (SELECT round(quantile_cont(abs({c} - m), 0.5), 4)
    FROM lineitem, (SELECT quantile_cont({c}, 0.5) AS m FROM lineitem)) AS mad FROM lineitem""",
        ("l_extendedprice", "l_quantity"),
    ),
    "profile_moments": _each(
        """SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS stddev, round(var_samp({c}), 2) AS variance,
  round(sum({c}), 2) AS sum,
  round(avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5), 4) AS skewness,
  round(avg(power({c} - m, 4)) / power(avg(power({c} - m, 2)), 2) - 3, 4) AS kurtosis
FROM lineitem, (SELECT avg({c}) AS m FROM lineitem)""",
        ("l_extendedprice", "l_quantity"),
    ),
    "profile_states": _each(
        """SELECT '{c}' AS "column", count(*) AS n_rows, count({c}) AS n, count(*) - count({c}) AS n_missing,
  round(min({c}), 2) AS min, round(max({c}), 2) AS max, round(avg({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS stddev, round(var_samp({c}), 2) AS variance, round(sum({c}), 2) AS sum,
  round(avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5), 4) AS skewness,
  round(avg(power({c} - m, 4)) / power(avg(power({c} - m, 2)), 2) - 3, 4) AS kurtosis
FROM lineitem, (SELECT avg({c}) AS m FROM lineitem)""",
        ("l_extendedprice", "l_quantity"),
    ),
    "profile_histogram": _each(
        """SELECT '{c}' AS "column", CAST(g AS INT) AS bin, round(lo + w * (g - 1), 4) AS bin_start,
  round(lo + w * g, 4) AS bin_end, coalesce(n, 0) AS n
FROM (SELECT min({c}) AS lo, (max({c}) - min({c})) / 10.0 AS w FROM lineitem)
CROSS JOIN range(1, 11) r(g)
LEFT JOIN (SELECT least(CAST(floor(({c} - lo) / w) AS INT) + 1, 10) AS b, count(*) AS n
  FROM lineitem, (SELECT min({c}) AS lo, (max({c}) - min({c})) / 10.0 AS w FROM lineitem)
  GROUP BY 1) ON b = g""",
        ("l_quantity", "l_linenumber"),
    ),
    "top_values": """SELECT l_partkey AS value, count(*) AS n FROM lineitem GROUP BY 1
ORDER BY n DESC, value LIMIT 10""",
    "top_values_by_column": " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n "
        "FROM lineitem GROUP BY 2 ORDER BY n DESC, value LIMIT 5)"
        for c in ("l_returnflag", "l_partkey", "l_linenumber")
    ),
    "extreme_values_by_column": " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{side}' AS side, '{c}' AS \"column\", {c} AS value, "
        f"count(*) AS n FROM lineitem GROUP BY {c} ORDER BY {c} {order} LIMIT 5)"
        for side, order in (("min", "ASC"), ("max", "DESC"))
        for c in ("l_extendedprice", "l_quantity")
    ),
    "extreme_values": """SELECT * FROM (SELECT 'min' AS side, l_extendedprice AS value,
  count(*) AS n FROM lineitem GROUP BY 2 ORDER BY 2 LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'max' AS side, l_extendedprice AS value,
  count(*) AS n FROM lineitem GROUP BY 2 ORDER BY 2 DESC LIMIT 5)""",
    "profile_text_lengths": _each(
        """SELECT '{c}' AS "column", min(length({c})) AS min_len,
  round(avg(length({c})), 4) AS mean_len, max(length({c})) AS max_len FROM documents""",
        ("text", "lang", "source"),
    ),
    "corr_pearson": " UNION ALL ".join(
        f"SELECT '{x}' AS column_x, '{y}' AS column_y, round(corr({x}, {y}), 6) AS r FROM lineitem"
        for x, y in (
            ("l_quantity", "l_extendedprice"),
            ("l_quantity", "l_linenumber"),
            ("l_extendedprice", "l_linenumber"),
        )
    ),
    "corr_spearman": " UNION ALL ".join(
        _spearman(x, y)
        for x, y in (
            ("l_quantity", "l_extendedprice"),
            ("l_quantity", "l_linenumber"),
            ("l_extendedprice", "l_linenumber"),
        )
    ),
    "cramers_v": " UNION ALL ".join(
        _cramers_v(x, y)
        for x, y in (
            ("l_returnflag", "l_shipdate"),
            ("l_returnflag", "l_linenumber"),
            ("l_shipdate", "l_linenumber"),
        )
    ),
    "missing_patterns": f"""SELECT flag IS NULL AS l_returnflag_missing,
  num IS NULL AS l_linenumber_missing, count(*) AS n FROM {NULLED} GROUP BY 1, 2""",
    "profile_alerts": """SELECT 'o_orderkey' AS "column", NULL AS other, 'unique' AS alert,
  CAST(count(DISTINCT o_orderkey) AS DOUBLE) AS value FROM orders
  HAVING count(DISTINCT o_orderkey) = count(*)
UNION ALL SELECT 'o_totalprice', NULL, 'unique', count(DISTINCT o_totalprice) FROM orders
  HAVING count(DISTINCT o_totalprice) = count(*)
UNION ALL SELECT 'twice', NULL, 'unique', count(DISTINCT o_totalprice * 2 + 1) FROM orders
  HAVING count(DISTINCT o_totalprice * 2 + 1) = count(*)
UNION ALL SELECT 'o_orderstatus', NULL, 'missing',
  round(CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) / count(*), 4) FROM orders
  HAVING count(*) FILTER (WHERE o_orderstatus = 'F') > 0.05 * count(*)
UNION ALL SELECT 'fixed', NULL, 'constant', 1 FROM orders HAVING count(*) > 0
UNION ALL SELECT 'customer', NULL, 'high_cardinality', count(DISTINCT o_custkey) FROM orders
  HAVING count(DISTINCT o_custkey) > 50
UNION ALL SELECT 'o_totalprice', 'twice', 'correlated',
  round(corr(o_totalprice, o_totalprice * 2 + 1), 4) FROM orders
  HAVING abs(corr(o_totalprice, o_totalprice * 2 + 1)) > 0.9
UNION ALL SELECT 'o_orderkey', 'o_totalprice', 'correlated',
  round(corr(o_orderkey, o_totalprice), 4) FROM orders
  HAVING abs(corr(o_orderkey, o_totalprice)) > 0.9""",
    "head_rows": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 10",
    "tail_rows": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey DESC LIMIT 10",
}

ORACLES |= {
    "json_array_scan": ORACLES["json_struct_scan"],
    "json_parse_failures": """SELECT 'props' AS "column", count(*) AS n_failed FROM events
WHERE event_id % 7 IN (0, 1)""",
    "csv_text_roundtrip": """SELECT doc_id,
  concat(text, chr(92), 'n', chr(92), chr(10), chr(13), source) AS text FROM documents""",
    "key_report": f"""SELECT 'airlines' AS dimension, count(*) FILTER (WHERE NOT EXISTS
    (SELECT 1 FROM supplier WHERE s_suppkey = f.airline AND s_acctbal > 0)) AS n_unmatched,
  0 AS n_duplicate_keys FROM {FACT} f
UNION ALL SELECT 'airports', count(*) FILTER (WHERE NOT EXISTS
    (SELECT 1 FROM part WHERE p_partkey = f.destination AND p_size <= 25)), 0 FROM {FACT} f""",
    "batch_sampled": f"""WITH w AS (SELECT * FROM ({WIDE}) WHERE number_of_changes < 4)
SELECT found_at, count(*) AS n, count(*) AS n_csv,
  round(CAST(sum(CAST(value AS DECIMAL(10,2))) AS DOUBLE), 2) AS value
FROM w WHERE found_at IN (SELECT k FROM (SELECT DISTINCT found_at AS k FROM w)
  ORDER BY md5(concat('0|', k)), k LIMIT 1000) GROUP BY found_at""",
    "value_counts_wide": " UNION ALL ".join(
        f"SELECT 'c{i}' AS \"column\", CAST((l_linenumber * {i + 1} + l_partkey) % 5 AS VARCHAR) AS value, "
        "count(*) AS n FROM lineitem GROUP BY 2"
        for i in range(70)
    ),
    "profile_histogram_bounded": """SELECT 'l_quantity' AS "column", CAST(g AS INT) AS bin,
  count(l_quantity) AS n, (SELECT count(*) FROM lineitem WHERE l_quantity < 10 OR l_quantity > 30) AS n_out
FROM range(1, 5) r(g) LEFT JOIN lineitem ON l_quantity BETWEEN 10 AND 30
  AND least(CAST(floor((l_quantity - 10) / 5.0) AS INT) + 1, 4) = g GROUP BY g""",
    "corr_spearman_approx": f"SELECT column_x, column_y, round(r, 1) + 0.0 AS r FROM ({ORACLES['corr_spearman']})",
}


def _figures(section: str, column: str, source: str, **figures: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, '{column}' AS \"column\", '{figure}' AS figure, "
        f"round(CAST({sql} AS DOUBLE), 3) AS value FROM {source}"
        for figure, sql in figures.items()
    )


_JOB = """(SELECT l_quantity AS q, nullif(l_linenumber, 7) AS n, nullif(l_returnflag, 'N') AS f,
  l_linestatus AS s, (SELECT quantile_cont(l_quantity, 0.5) FROM lineitem) AS qm,
  (SELECT quantile_cont(nullif(l_linenumber, 7), 0.5) FROM lineitem) AS nm,
  (SELECT avg(l_quantity) FROM lineitem) AS qa, (SELECT avg(nullif(l_linenumber, 7)) FROM lineitem) AS na
  FROM lineitem)"""
_COLUMNS = {"l_quantity": "q", "l_linenumber": "n", "l_returnflag": "f", "l_linestatus": "s"}
_NUMBERS = {"l_quantity": "q", "l_linenumber": "n"}

ORACLES["profile_job"] = " UNION ALL ".join(
    [
        *(
            _figures(
                "columns",
                name,
                _JOB,
                n_distinct=f"count(DISTINCT {c})",
                n_missing=f"count(*) - count({c})",
                n_zero=f"count(*) FILTER (WHERE {c} = 0)" if c in "qn" else "0 * count(*)",
                n_negative=f"count(*) FILTER (WHERE {c} < 0)" if c in "qn" else "0 * count(*)",
                n_infinite="0 * count(*)",
            )
            for name, c in _COLUMNS.items()
        ),
        *(
            _figures("nulls", name, _JOB, n_null=f"count(*) - count({c})", n_not_null=f"count({c})")
            for name, c in _COLUMNS.items()
        ),
        *(
            _figures(
                "quantiles",
                name,
                _JOB,
                min=f"min({c})",
                **{f"q{p:02d}": f"quantile_cont({c}, {p / 100})" for p in (5, 25, 50, 75, 95)},
                max=f"max({c})",
                mad=f"quantile_cont(abs({c} - {c}m), 0.5)",
            )
            for name, c in _NUMBERS.items()
        ),
        *(
            _figures(
                "moments",
                name,
                _JOB,
                n=f"count({c})",
                mean=f"avg({c})",
                stddev=f"stddev_samp({c})",
                skewness=f"avg(power({c} - {c}a, 3)) / power(avg(power({c} - {c}a, 2)), 1.5)",
                kurtosis=f"avg(power({c} - {c}a, 4)) / power(avg(power({c} - {c}a, 2)), 2) - 3",
            )
            for name, c in _NUMBERS.items()
        ),
        *(
            _figures(
                "text_lengths",
                name,
                _JOB,
                min_len=f"min(length({c}))",
                mean_len=f"avg(length({c}))",
                max_len=f"max(length({c}))",
            )
            for name, c in (("l_returnflag", "f"), ("l_linestatus", "s"))
        ),
    ]
)

ORACLES |= {
    "frequent_values": """SELECT concat_ws('/', l_returnflag, l_linestatus, l_linenumber) AS value, count(*) AS n
FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 10""",
    "frequent_values_tied": ORACLES["top_values"],
    "join_audit_keys": """WITH d AS (SELECT c_custkey AS key, CASE WHEN c_mktsegment = 'BUILDING' THEN 2 ELSE 1 END AS n
  FROM customer WHERE c_acctbal > 0),
f AS (SELECT o_custkey AS key, count(*) AS n FROM orders GROUP BY 1),
b AS (SELECT coalesce(f.key, d.key) AS key, coalesce(f.n, 0) AS n_facts, coalesce(d.n, 0) AS n_dimension
  FROM f FULL JOIN d ON f.key = d.key)
SELECT key, n_facts, n_dimension, CASE WHEN n_dimension > 0 THEN 0 ELSE n_facts END AS n_lost,
  CASE WHEN n_dimension > 0 THEN n_facts * (n_dimension - 1) ELSE 0 END AS n_added
FROM b WHERE n_dimension <> 1""",
}
