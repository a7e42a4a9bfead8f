"""Independent SQL for each registered query (DuckDB dialect).

Written from the operator semantics, not generated from the Spark plans, so
the driver's comparison is a real cross-check. Views over the driver tables
are pre-registered under their table names.
"""

from __future__ import annotations

from tabforge.functions.numeric import NUMERIC_PATTERN

RAW_ORDERS = """
raw AS (
  SELECT o_orderkey AS id,
         CASE WHEN o_orderkey % 6 = 0 THEN 'NA'
              WHEN o_orderkey % 13 = 0 THEN '10d'
              ELSE CAST(o_custkey % 97 + 20 AS VARCHAR) END AS frontage,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL
              ELSE CAST(o_custkey % 500 AS DOUBLE) END AS veneer_area,
         CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS priority,
         o_orderstatus AS status,
         CAST(year(o_orderdate) AS INTEGER) AS year_built,
         o_custkey AS cust_id,
         o_totalprice AS target
  FROM orders
)"""


def _num(x: str) -> str:
    return (f"CASE WHEN regexp_full_match({x}, '{NUMERIC_PATTERN}') "
            f"THEN TRY_CAST(trim({x}) AS DOUBLE) END")


COERCED = RAW_ORDERS + f""",
coerced AS (
  SELECT id, {_num('frontage')} AS frontage, veneer_area, priority, status, year_built, cust_id, target
  FROM raw
)"""

CLEAN = COERCED + """,
clean AS (
  SELECT coalesce(priority, 'None') AS priority,
         coalesce(status, 'None') AS status,
         coalesce(frontage, (SELECT avg(frontage) FROM coerced)) AS frontage,
         coalesce(veneer_area, CAST(0 AS DOUBLE)) AS veneer_area,
         year_built,
         target,
         CAST(id AS VARCHAR) AS id,
         cust_id
  FROM coerced
)"""

CLEAN_COLS = "priority, status, frontage, veneer_area, year_built, target, id"

SPLIT = CLEAN + """,
hashed AS (SELECT *, md5('42:' || id) AS h FROM clean),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY h, id) AS rn, count(*) OVER () AS n FROM hashed
),
tagged AS (
  SELECT *, CASE WHEN rn <= ceil(CAST(0.2 AS DOUBLE) * n) THEN 'test' ELSE 'train' END AS split
  FROM ranked
)"""

PART_SPLIT = """
phashed AS (SELECT *, md5('42:' || CAST(p_partkey AS VARCHAR)) AS h FROM part),
pranked AS (SELECT *, row_number() OVER (ORDER BY h, p_partkey) AS rn, count(*) OVER () AS n FROM phashed),
ptagged AS (
  SELECT *, CASE WHEN rn <= ceil(CAST(0.2 AS DOUBLE) * n) THEN 'test' ELSE 'train' END AS split
  FROM pranked
)"""

SNAPSHOTS = """
old_s AS (
  SELECT o_orderkey AS id,
         CASE WHEN o_orderdate >= TIMESTAMP '1998-10-03' THEN 'O' ELSE o_orderstatus END AS status,
         o_totalprice AS total
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
),
new_s AS (
  SELECT o_orderkey AS id,
         CASE WHEN o_orderdate >= TIMESTAMP '2001-06-03' THEN 'O' ELSE o_orderstatus END AS status,
         o_totalprice AS total
  FROM orders WHERE o_orderdate < TIMESTAMP '2001-09-01' AND o_orderdate >= TIMESTAMP '1996-09-01'
)"""

RUN_LATEST = """
latest AS (
  SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS key,
         arg_max(value, event_id) AS value, max(event_id) AS step
  FROM events GROUP BY ALL
)"""

RUNS = RUN_LATEST + """,
head AS (
  SELECT CAST(user_id AS VARCHAR) AS run_id, min(ts) AS start_time, max(ts) AS end_time,
         arg_max(event_type, event_id) AS last_type, arg_min(props, event_id) AS first_props
  FROM events GROUP BY ALL
),
runs AS (
  SELECT h.run_id, h.last_type || '-run-' || h.run_id AS run_name,
         CASE WHEN h.last_type = 'error' THEN 'FAILED' ELSE 'FINISHED' END AS status,
         h.start_time, h.end_time,
         json_extract_string(h.first_props, '$.k') AS tag_k,
         (SELECT l.value FROM latest l WHERE l.run_id = h.run_id AND l.key = 'purchase') AS m_purchase
  FROM head h
)"""

METRICS_LINEITEM = """
m AS (
  SELECT count(*) AS n,
         round(avg((l_extendedprice - l_quantity * 1500) * (l_extendedprice - l_quantity * 1500)), 2) AS mse,
         round(avg(abs(l_extendedprice - l_quantity * 1500)), 6) AS mae,
         round(1 - sum((l_extendedprice - l_quantity * 1500) * (l_extendedprice - l_quantity * 1500))
                   / (var_pop(l_extendedprice) * count(*)), 9) AS r2
  FROM lineitem
)"""


def _with(*blocks: str) -> str:
    return "WITH " + ",".join(b.strip() for b in blocks) + "\n"


def _stumps(train: str, rows: str, key: str, label: str, num: list[str], cat: list[str], rounds: int = 1,
            rate: float = 0.1, missing: str = "-1.0e15") -> str:
    """CTEs of squared-error boosting with one split a round; ``scored`` has ``prediction`` per row of ``rows``.

    The first tree fits the label and weighs 1, later ones fit twice the
    residual and weigh ``rate``. Every round takes the split with the largest
    sum of squares over counts of both sides: numbers at midpoints between neighbouring values,
    categories one against the rest. A missing number lies below all others.
    """
    value = "CASE b.col " + " ".join(f"WHEN '{c}' THEN coalesce(CAST({c} AS DOUBLE), {missing})" for c in num) + " END"
    name = "CASE b.col " + " ".join(f"WHEN '{c}' THEN {c}" for c in cat) + " END"
    right = f"CASE WHEN b.cat IS NULL THEN {value} > b.thr ELSE coalesce({name} = b.cat, false) END"
    out = [f"f0 AS (SELECT *, CAST(0 AS DOUBLE) AS margin FROM {train})", f"s0 AS (SELECT *, CAST(0 AS DOUBLE) AS margin FROM {rows})"]
    for k in range(1, rounds + 1):
        target = label if k == 1 else f"2 * ({label} - margin)"
        weight = "1.0" if k == 1 else str(rate)
        out.append(f"t{k} AS (SELECT *, CAST({target} AS DOUBLE) AS r FROM f{k - 1})")
        out.append(f"tot{k} AS (SELECT count(*) AS n, sum(r) AS s FROM t{k})")
        parts = []
        for c in num:
            parts.append(f"""SELECT '{c}' AS col, CAST(NULL AS VARCHAR) AS cat, (x + lead(x) OVER (ORDER BY x)) / 2 AS thr,
                 sum(n) OVER (ORDER BY x) AS nl, sum(s) OVER (ORDER BY x) AS sl
          FROM (SELECT coalesce(CAST({c} AS DOUBLE), {missing}) AS x, count(*) AS n, sum(r) AS s FROM t{k} GROUP BY 1)""")
        for c in cat:
            parts.append(f"""SELECT '{c}', {c}, CAST(NULL AS DOUBLE), (SELECT n FROM tot{k}) - count(*), (SELECT s FROM tot{k}) - sum(r)
          FROM t{k} WHERE {c} IS NOT NULL GROUP BY {c}""")
        out.append(f"c{k} AS (" + " UNION ALL ".join(parts) + ")")
        out.append(f"""b{k} AS (SELECT col, cat, thr, sl / nl AS lm, (t.s - sl) / (t.n - nl) AS rm FROM c{k}, tot{k} t
          WHERE nl > 0 AND nl < t.n AND (thr IS NOT NULL OR cat IS NOT NULL)
          ORDER BY sl * sl / nl + (t.s - sl) * (t.s - sl) / (t.n - nl) DESC LIMIT 1)""")
        for x in ("f", "s"):
            out.append(f"{x}{k} AS (SELECT d.* EXCLUDE (margin), margin + {weight} * CASE WHEN {right} THEN b.rm ELSE b.lm END "
                       f"AS margin FROM {x}{k - 1} d, b{k} b)")
    out.append(f"scored AS (SELECT *, margin AS prediction FROM s{rounds})")
    return ",\n".join(out)


# Text cells that a pandas CSV reader takes as missing.
_NA_CELLS = ("'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', "
             "'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'")


def _na(x: str) -> str:
    return f"CASE WHEN {x} IN ({_NA_CELLS}) THEN NULL ELSE {x} END"


PART_TRAIN = ("ptrain AS (SELECT p_partkey, p_size, p_brand, p_type, p_retailprice FROM ptagged WHERE split = 'train'), "
              "ptest AS (SELECT p_partkey, p_size, p_brand, p_type, p_retailprice FROM ptagged WHERE split = 'test')")
_PART_TREE = ("p_partkey", "p_retailprice", ["p_size"], ["p_brand", "p_type"])
PART_SCORED = _with(PART_SPLIT, PART_TRAIN, _stumps("ptrain", "ptest", *_PART_TREE))

LOOKUP_SCORED = _with("""
req AS (
  SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_partkey AS k, 'g' || CAST(p_partkey % 3 AS VARCHAR) AS p_mfgr_group,
         p_retailprice FROM part
),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || p_partkey), p_partkey) AS rn, count(*) OVER () AS n FROM req
),
full_rows AS (
  SELECT r.p_partkey, r.p_mfgr_group, r.p_retailprice, r.rn <= ceil(CAST(0.2 AS DOUBLE) * r.n) AS is_test,
         CASE WHEN p.p_partkey % 7 <> 0 THEN p.p_size END AS p_size,
         CASE WHEN p.p_partkey % 11 <> 0 THEN p.p_brand END AS p_brand,
         2025 - (1950 + (p.p_partkey % 1000) // 20) AS house_age
  FROM ranked r LEFT JOIN (SELECT * FROM part WHERE p_partkey % 10 <> 3) p ON p.p_partkey = r.k
),
ltrain AS (SELECT * EXCLUDE (is_test) FROM full_rows WHERE NOT is_test),
ltest AS (SELECT * EXCLUDE (is_test) FROM full_rows WHERE is_test)""",
    _stumps("ltrain", "ltest", "p_partkey", "p_retailprice", ["p_size", "house_age"], ["p_brand", "p_mfgr_group"]))

ORDERS_IDENTITY = f"""
WITH parts AS (
  SELECT *, CAST(floor(log2(abs(nullif(o_totalprice, 0)))) AS INTEGER) AS e0 FROM orders
), scaled AS (
  SELECT *, abs(o_totalprice) / pow(2.0, CAST(e0 AS DOUBLE)) AS m0 FROM parts
), price AS (
  SELECT *, CASE WHEN o_totalprice = 0 THEN '0' ELSE (CASE WHEN o_totalprice < 0 THEN '-' ELSE '' END)
         || CAST(CAST(CASE WHEN m0 >= 2 THEN m0 / 2 WHEN m0 < 1 THEN m0 * 2 ELSE m0 END * CAST(4503599627370496 AS DOUBLE) AS BIGINT) AS VARCHAR)
         || 'p' || CAST(CASE WHEN m0 >= 2 THEN e0 + 1 WHEN m0 < 1 THEN e0 - 1 ELSE e0 END AS VARCHAR) END AS price_text
  FROM scaled
), h AS (
  SELECT md5({" || ".join(
      f"'{len(c)}:{c}=' || coalesce('V' || CAST(length({t}) AS VARCHAR) || ':' || {t}, 'N') || ';'"
      for c, t in (("o_orderkey", "CAST(o_orderkey AS VARCHAR)"), ("o_custkey", "CAST(o_custkey AS VARCHAR)"),
                   ("o_orderstatus", "o_orderstatus"), ("o_totalprice", "price_text"),
                   ("o_orderdate", "CAST(o_orderdate AS VARCHAR)"), ("o_orderpriority", "o_orderpriority")))}) AS h
  FROM price
)
SELECT count(*) AS n_rows, {" || '-' || ".join(
    f"CAST(sum(CAST('0x' || substr(h, {1 + 8 * i}, 8) AS BIGINT)) AS VARCHAR)" for i in range(4))} AS fingerprint
FROM h"""

ORACLE: dict[str, str] = {
    "record_run_full": "WITH d AS (" + ORDERS_IDENTITY + """)
SELECT 'eval-orders' AS run_id, kind, key, value FROM (
  SELECT 'tag' AS kind, 'branch' AS key, 'main' AS value UNION ALL SELECT 'param', 'model_type', 'formula'
  UNION ALL SELECT 'param', 'factor', '1500'
  UNION ALL SELECT 'metric', 'n', CAST(count(*) AS VARCHAR) || '.0' FROM lineitem
  UNION ALL SELECT 'dataset', 'context', 'training' UNION ALL SELECT 'dataset', 'dataset_name', 'orders'
  UNION ALL SELECT 'dataset', 'dataset_version', '0' UNION ALL SELECT 'dataset', 'n_rows', CAST(n_rows AS VARCHAR) FROM d
  UNION ALL SELECT 'dataset', 'fingerprint', fingerprint FROM d)""",
    "feature_table_replaced": _with(SPLIT) + """
SELECT id, frontage + CASE WHEN split = 'test' THEN 1 ELSE 0 END AS frontage, veneer_area, year_built FROM tagged""",
    "score_latest_lookup": LOOKUP_SCORED + "SELECT p_partkey, round(prediction, 6) AS prediction FROM scored",
    "train_register_lookup": LOOKUP_SCORED + """,
e AS (SELECT avg((p_retailprice - prediction) * (p_retailprice - prediction)) AS mse,
             avg(abs(p_retailprice - prediction)) AS mae,
             1 - sum((p_retailprice - prediction) * (p_retailprice - prediction)) / (var_pop(p_retailprice) * count(*)) AS r2
      FROM scored)
SELECT 'mse' AS key, round(mse, 4) AS value, CAST(1 AS INTEGER) AS version FROM e
UNION ALL SELECT 'mae', round(mae, 6), 1 FROM e UNION ALL SELECT 'r2', round(r2, 6), 1 FROM e""",
    "train_gbt": _with(PART_SPLIT, PART_TRAIN, _stumps("ptrain", "ptrain", *_PART_TREE)) + """
SELECT p_partkey, p_retailprice, round(prediction, 6) AS prediction FROM scored""",
    "boost_blocks": _with(_stumps("part", "part", *_PART_TREE, rounds=4, rate=0.5)) + """
SELECT p_partkey, p_retailprice, round(prediction, 6) AS prediction FROM scored""",
    "batch_score": PART_SCORED + "SELECT p_partkey, p_retailprice, round(prediction, 6) AS prediction FROM scored",
    "model_roundtrip": PART_SCORED + "SELECT p_partkey, round(prediction, 6) AS prediction FROM scored",
    "score_latest": PART_SCORED + "SELECT p_partkey, round(prediction, 6) AS prediction FROM scored",
    "score_adjusted": PART_SCORED + """
SELECT p_partkey, CAST(round_even(prediction * CAST(100 AS DOUBLE), 0) AS DOUBLE) / CAST(100 AS DOUBLE) AS prediction
FROM scored""",
    "model_metrics": PART_SCORED + """
SELECT count(*) AS n, round(avg((p_retailprice - prediction) * (p_retailprice - prediction)), 4) AS mse,
       round(avg(abs(p_retailprice - prediction)), 6) AS mae,
       round(1 - sum((p_retailprice - prediction) * (p_retailprice - prediction)) / (var_pop(p_retailprice) * count(*)), 9) AS r2
FROM scored""",
    "prepare_training": _with(SPLIT) + """
SELECT t.id, t.priority, t.status, t.frontage, t.veneer_area, t.year_built,
       CAST(2025 - t.year_built AS INTEGER) AS house_age,
       c.c_acctbal, c.c_mktsegment, t.target, t.split
FROM tagged t LEFT JOIN customer c ON t.cust_id = c.c_custkey""",
    "preprocess": _with(CLEAN) + f"SELECT {CLEAN_COLS} FROM clean",
    "to_numeric": _with(COERCED) + "SELECT id, frontage FROM coerced",
    "impute_mean": _with(COERCED) + """
SELECT id, coalesce(frontage, (SELECT avg(frontage) FROM coerced)) AS frontage FROM coerced""",
    "impute_constant": _with(RAW_ORDERS) + """
SELECT id, coalesce(veneer_area, CAST(0 AS DOUBLE)) AS veneer_area FROM raw""",
    "impute_median": _with(COERCED) + """
SELECT id, coalesce(frontage, (SELECT median(frontage) FROM coerced)) AS frontage FROM coerced""",
    "fill_category": _with(RAW_ORDERS) + """
SELECT id, coalesce(priority, 'None') AS priority, coalesce(status, 'None') AS status FROM raw""",
    "nan_to_null": """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price
FROM orders""",
    "select_features": _with(RAW_ORDERS) + """
SELECT priority, status, frontage, veneer_area, year_built, target, CAST(id AS VARCHAR) AS id FROM raw""",
    "feature_label": _with(CLEAN) + """
SELECT id, frontage, veneer_area, year_built, priority, status, target FROM clean""",
    "drop_columns": _with(CLEAN) + "SELECT priority, status, target, id FROM clean",
    "cast_columns": _with(RAW_ORDERS) + """
SELECT CAST(id AS VARCHAR) AS id, TRY_CAST(frontage AS INTEGER) AS frontage,
       CAST(year_built AS VARCHAR) AS year_built FROM raw""",
    "audit_stamp": _with(CLEAN) + f"""
SELECT {CLEAN_COLS}, TIMESTAMP '2025-01-01 00:00:00' AS update_timestamp_utc FROM clean""",
    "schema_conform": _with(RAW_ORDERS) + """
SELECT CAST(id AS VARCHAR) AS id, CAST(year_built AS BIGINT) AS year_built, veneer_area, status FROM raw""",
    "agg_mean": _with(COERCED) + """
SELECT avg(frontage) AS mean_frontage, avg(veneer_area) AS mean_veneer_area FROM coerced""",
    "agg_median": _with(COERCED) + """
SELECT median(frontage) AS median_frontage, CAST(median(year_built) AS DOUBLE) AS median_year_built
FROM coerced""",
    "agg_quantiles": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{label}' AS quantile, quantile_cont(CAST({c} AS DOUBLE), {q}) AS value FROM lineitem"
        for c in ("l_extendedprice", "l_quantity", "l_discount")
        for label, q in (("p00", 0.0), ("p01", 0.01), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p99", 0.99), ("p100", 1.0))),
    "null_counts": _with(COERCED) + """
SELECT column_name, n_missing FROM (
  SELECT 'id' AS column_name, CAST(count_if(id IS NULL) AS BIGINT) AS n_missing FROM coerced
  UNION ALL SELECT 'frontage', CAST(count_if(frontage IS NULL OR isnan(frontage)) AS BIGINT) FROM coerced
  UNION ALL SELECT 'veneer_area', CAST(count_if(veneer_area IS NULL OR isnan(veneer_area)) AS BIGINT) FROM coerced
  UNION ALL SELECT 'priority', CAST(count_if(priority IS NULL) AS BIGINT) FROM coerced
  UNION ALL SELECT 'status', CAST(count_if(status IS NULL) AS BIGINT) FROM coerced
  UNION ALL SELECT 'year_built', CAST(count_if(year_built IS NULL) AS BIGINT) FROM coerced
  UNION ALL SELECT 'cust_id', CAST(count_if(cust_id IS NULL) AS BIGINT) FROM coerced
  UNION ALL SELECT 'target', CAST(count_if(target IS NULL OR isnan(target)) AS BIGINT) FROM coerced
)""",
    "conditional_counts": _with(CLEAN) + """
SELECT CAST(count_if(priority = 'None') AS BIGINT) AS n_priority_none, CAST(count_if(veneer_area = 0) AS BIGINT) AS n_veneer_zero,
       CAST(count_if(status = 'O') AS BIGINT) AS n_status_o FROM clean""",
    "table_shape": _with(CLEAN) + "SELECT count(*) AS n_rows, CAST(7 AS BIGINT) AS n_columns FROM clean",
    "category_domains": _with(CLEAN) + """
SELECT feature, category, CAST(dense_rank() OVER (PARTITION BY feature ORDER BY category) - 1 AS INTEGER) AS idx
FROM (SELECT DISTINCT 'priority' AS feature, priority AS category FROM clean
      UNION SELECT DISTINCT 'status', status FROM clean)""",
    "category_domains_large": _with(CLEAN) + """
SELECT feature, category, CAST(dense_rank() OVER (PARTITION BY feature ORDER BY category) - 1 AS INTEGER) AS idx
FROM (SELECT DISTINCT 'priority' AS feature, priority AS category FROM clean
      UNION SELECT DISTINCT 'status', status FROM clean)""",
    "dictionary_encode": _with(CLEAN) + """,
dp AS (SELECT priority AS v, CAST(row_number() OVER (ORDER BY priority) - 1 AS INTEGER) AS i
       FROM (SELECT DISTINCT priority FROM clean)),
ds AS (SELECT status AS v, CAST(row_number() OVER (ORDER BY status) - 1 AS INTEGER) AS i
       FROM (SELECT DISTINCT status FROM clean))
SELECT c.id, dp.i AS priority, ds.i AS status
FROM clean c JOIN dp ON c.priority = dp.v JOIN ds ON c.status = ds.v""",
    "dictionary_encode_large": _with(CLEAN) + """,
dp AS (SELECT priority AS v, CAST(row_number() OVER (ORDER BY priority) - 1 AS INTEGER) AS i
       FROM (SELECT DISTINCT priority FROM clean)),
ds AS (SELECT status AS v, CAST(row_number() OVER (ORDER BY status) - 1 AS INTEGER) AS i
       FROM (SELECT DISTINCT status FROM clean))
SELECT c.id, dp.i AS priority, ds.i AS status
FROM clean c JOIN dp ON c.priority = dp.v JOIN ds ON c.status = ds.v""",
    "regression_metrics": _with(METRICS_LINEITEM) + "SELECT n, mse, mae, r2 FROM m",
    "dataset_fingerprint": ORDERS_IDENTITY,
    "key_violations": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows,
       CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'null_key' ELSE 'duplicate_key' END AS violation
FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "param_conflicts": """
SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS key,
       count(DISTINCT json_extract_string(props, '$.k')) AS n_values,
       min(json_extract_string(props, '$.k')) AS min_value,
       max(json_extract_string(props, '$.k')) AS max_value
FROM events GROUP BY ALL HAVING count(DISTINCT json_extract_string(props, '$.k')) > 1""",
    "snapshot_diff": _with(SNAPSHOTS) + """
SELECT coalesce(n.id, o.id) AS id, coalesce(n.status, o.status) AS status, coalesce(n.total, o.total) AS total,
       CASE WHEN o.id IS NULL THEN 'insert' ELSE 'delete' END AS _change_type
FROM old_s o FULL JOIN new_s n ON o.id = n.id
WHERE o.id IS NULL OR n.id IS NULL
UNION ALL
SELECT o.id, o.status, o.total, 'update_preimage'
FROM old_s o JOIN new_s n ON o.id = n.id
WHERE o.status IS DISTINCT FROM n.status OR o.total IS DISTINCT FROM n.total
UNION ALL
SELECT n.id, n.status, n.total, 'update_postimage'
FROM old_s o JOIN new_s n ON o.id = n.id
WHERE o.status IS DISTINCT FROM n.status OR o.total IS DISTINCT FROM n.total""",
    "snapshot_diff_bucketed": _with(SNAPSHOTS) + """
SELECT coalesce(n.id, o.id) AS id, coalesce(n.status, o.status) AS status, coalesce(n.total, o.total) AS total,
       CASE WHEN o.id IS NULL THEN 'insert' ELSE 'delete' END AS _change_type
FROM old_s o FULL JOIN new_s n ON o.id = n.id
WHERE o.id IS NULL OR n.id IS NULL
UNION ALL
SELECT o.id, o.status, o.total, 'update_preimage'
FROM old_s o JOIN new_s n ON o.id = n.id
WHERE o.status IS DISTINCT FROM n.status OR o.total IS DISTINCT FROM n.total
UNION ALL
SELECT n.id, n.status, n.total, 'update_postimage'
FROM old_s o JOIN new_s n ON o.id = n.id
WHERE o.status IS DISTINCT FROM n.status OR o.total IS DISTINCT FROM n.total""",
    "snapshot_diff_keyless": _with(SNAPSHOTS) + """,
oo AS (SELECT CASE WHEN id % 10 <> 0 THEN id END AS id, status, total FROM old_s),
nn AS (SELECT CASE WHEN id % 10 <> 0 THEN id END AS id, status, total FROM new_s),
gone AS (SELECT * FROM oo EXCEPT ALL SELECT * FROM nn), come AS (SELECT * FROM nn EXCEPT ALL SELECT * FROM oo)
SELECT g.*, CASE WHEN EXISTS (SELECT 1 FROM come c WHERE c.id IS NOT DISTINCT FROM g.id) THEN 'update_preimage' ELSE 'delete' END AS _change_type
FROM gone g
UNION ALL
SELECT c.*, CASE WHEN EXISTS (SELECT 1 FROM gone g WHERE g.id IS NOT DISTINCT FROM c.id) THEN 'update_postimage' ELSE 'insert' END
FROM come c""",
    "train_test_split": _with(SPLIT) + f"SELECT {CLEAN_COLS}, split FROM tagged",
    "split_missing_keys": """
WITH k AS (
  SELECT CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_custkey % 400 AS VARCHAR) END AS cust, o_orderkey AS id,
         o_orderpriority AS priority FROM orders
), h AS (
  SELECT *, md5('42#4:cust=' || coalesce('V' || length(cust) || ':' || cust, 'N') || ';2:id=V' || length(CAST(id AS VARCHAR))
                || ':' || id || ';8:priority=' || coalesce('V' || length(priority) || ':' || priority, 'N') || ';') AS row_hash FROM k
), r AS (
  SELECT *, row_number() OVER (ORDER BY coalesce(md5('42:' || cust), row_hash), row_hash) AS rn, count(*) OVER () AS n FROM h
)
SELECT cust, id, priority, CASE WHEN rn <= ceil(CAST(0.2 AS DOUBLE) * n) THEN 'test' ELSE 'train' END AS split FROM r""",
    "bucket_split": _with(CLEAN) + f"""
SELECT {CLEAN_COLS},
       CASE WHEN CAST(('0x' || substr(md5('42:' || id), 1, 8)) AS BIGINT) % 100 < 20
            THEN 'test' ELSE 'train' END AS split
FROM clean""",
    "split_check": _with(SPLIT) + """
SELECT CAST(count_if(split = 'train') AS BIGINT) AS n_train, CAST(count_if(split = 'test') AS BIGINT) AS n_test, count(*) AS n_total,
       CAST(0 AS BIGINT) AS n_overlap, true AS sizes_add_up, true AS same_columns
FROM tagged""",
    "feature_lookup": _with(RAW_ORDERS) + """
SELECT r.cust_id, r.id, r.target, c.c_acctbal, c.c_mktsegment
FROM raw r LEFT JOIN customer c ON r.cust_id = c.c_custkey""",
    "feature_union": _with(CLEAN) + "SELECT id, frontage, veneer_area, year_built FROM clean",
    "feature_table": _with(CLEAN) + "SELECT id, frontage, veneer_area, year_built FROM clean",
    "training_set": _with(SPLIT) + """
SELECT id, priority, status, target, frontage, veneer_area, year_built,
       CAST(2025 - year_built AS INTEGER) AS house_age
FROM tagged WHERE split = 'train'""",
    "training_set_bucketed": _with(SPLIT) + """
SELECT id, priority, status, target, frontage, veneer_area, year_built,
       CAST(2025 - year_built AS INTEGER) AS house_age
FROM tagged WHERE split = 'train'""",
    "score_lookup": _with(SPLIT) + """
SELECT id, priority, status, frontage, veneer_area, year_built,
       CAST(2025 - year_built AS INTEGER) AS house_age
FROM tagged WHERE split = 'test'""",
    "house_age": _with(RAW_ORDERS) + """
SELECT id, year_built, CAST(2025 - year_built AS INTEGER) AS house_age FROM raw""",
    "sql_udf": _with(RAW_ORDERS) + """
SELECT id, year_built, CAST(2025 - year_built AS INTEGER) AS house_age FROM raw""",
    "adjust_cents": """
SELECT o_orderkey AS id, CAST(round_even((o_totalprice / 7) * CAST(100 AS DOUBLE), 0) AS DOUBLE)
                         / CAST(100 AS DOUBLE) AS adjusted FROM orders""",
    "adjust_scaled": """
SELECT o_orderkey AS id,
       CAST(round_even(((o_totalprice / 7) * CAST(1.3 AS DOUBLE)) * CAST(100 AS DOUBLE), 0) AS DOUBLE)
       / CAST(100 AS DOUBLE) AS adjusted FROM orders""",
    "map_scorer": """
SELECT p_partkey, CAST(900.0 AS DOUBLE) + CAST(2.5 AS DOUBLE) * p_size + length(p_type) * CAST(10.0 AS DOUBLE)
       AS prediction FROM part""",
    "one_hot": _with(PART_SPLIT) + """,
dom AS (
  SELECT DISTINCT 'p_brand' AS feature, p_brand AS category FROM ptagged WHERE split = 'train'
  UNION SELECT DISTINCT 'p_type', p_type FROM ptagged WHERE split = 'train'
)
SELECT t.p_partkey, d.feature, d.category, CAST(1.0 AS DOUBLE) AS value
FROM ptagged t JOIN dom d
  ON (d.feature = 'p_brand' AND d.category = t.p_brand) OR (d.feature = 'p_type' AND d.category = t.p_type)
WHERE t.split = 'test'""",
    "one_hot_large": _with(PART_SPLIT) + """,
dom AS (
  SELECT DISTINCT 'p_brand' AS feature, p_brand AS category FROM ptagged WHERE split = 'train'
  UNION SELECT DISTINCT 'p_type', p_type FROM ptagged WHERE split = 'train'
)
SELECT t.p_partkey, d.feature, d.category, CAST(1.0 AS DOUBLE) AS value
FROM ptagged t JOIN dom d
  ON (d.feature = 'p_brand' AND d.category = t.p_brand) OR (d.feature = 'p_type' AND d.category = t.p_type)
WHERE t.split = 'test'""",
    "assemble": _with(PART_SPLIT) + """,
db AS (SELECT p_brand AS v, CAST(row_number() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS i
       FROM (SELECT DISTINCT p_brand FROM ptagged WHERE split = 'train')),
dt AS (SELECT p_type AS v, CAST(row_number() OVER (ORDER BY p_type) - 1 AS INTEGER) AS i
       FROM (SELECT DISTINCT p_type FROM ptagged WHERE split = 'train')),
n1 AS (SELECT CAST(count(*) AS INTEGER) AS n FROM db),
n2 AS (SELECT CAST(count(*) AS INTEGER) AS n FROM dt)
SELECT t.p_partkey, db.i AS pos, CAST(1.0 AS DOUBLE) AS value
FROM ptagged t JOIN db ON t.p_brand = db.v WHERE t.split = 'test'
UNION ALL
SELECT t.p_partkey, (SELECT n FROM n1) + dt.i, CAST(1.0 AS DOUBLE)
FROM ptagged t JOIN dt ON t.p_type = dt.v WHERE t.split = 'test'
UNION ALL
SELECT p_partkey, (SELECT n FROM n1) + (SELECT n FROM n2), CAST(p_size AS DOUBLE)
FROM ptagged WHERE split = 'test' AND p_size <> 0""",
    "metric_latest": _with(RUN_LATEST) + "SELECT run_id, key, value, step FROM latest",
    "run_maps": _with(RUN_LATEST) + """
SELECT run_id, count(*) OVER (PARTITION BY run_id) AS n_keys, key, value FROM latest""",
    "run_search": _with(RUNS) + """
SELECT run_id, run_name, status, start_time, m_purchase
FROM runs
WHERE status = 'FINISHED' AND start_time < TIMESTAMP '2024-01-29 23:00:00'
  AND run_name LIKE '%-run-%' AND m_purchase > 20 AND tag_k IS DISTINCT FROM '50'""",
    "latest_runs": _with(RUNS) + """
SELECT run_id, run_name, end_time FROM runs ORDER BY end_time DESC, run_id ASC LIMIT 10""",
    "latest_per_status": _with(RUNS) + """
SELECT status, arg_max(run_id, (end_time, run_id)) AS run_id, max(end_time) AS end_time
FROM runs GROUP BY status""",
    "latest_version": """
SELECT 'model_' || event_type AS name, max(event_id) AS version,
       arg_max('models/' || event_type || '/v' || CAST(event_id AS VARCHAR), event_id) AS path,
       arg_max(CAST(user_id AS VARCHAR), event_id) AS run_id,
       max(event_id) + 1 AS next_version
FROM events GROUP BY event_type""",
    "record_run": _with(METRICS_LINEITEM) + """
SELECT 'eval-lineitem' AS run_id, key, value, CAST(0 AS BIGINT) AS step FROM (
  SELECT 'mse' AS key, CAST(mse AS DOUBLE) AS value FROM m
  UNION ALL SELECT 'mae', CAST(mae AS DOUBLE) FROM m
  UNION ALL SELECT 'r2', CAST(r2 AS DOUBLE) FROM m)""",
    "csv_scan": "SELECT * FROM customer",
    "na_tokens": _with(RAW_ORDERS) + f"""
SELECT id, {_na('frontage')} AS frontage, {_na('priority')} AS priority, {_na('status')} AS status
FROM raw""",
    "csv_types": """
WITH n AS (SELECT count(*) AS n FROM orders), m AS (
  SELECT count(*) FILTER (o_orderkey % 6 = 0) AS frontage, count(*) FILTER (o_orderkey % 11 = 0) AS veneer_area,
         count(*) FILTER (o_orderkey % 13 = 0) AS flag, count(*) FILTER (o_orderkey % 7 = 0 AND o_orderkey % 5 <> 0) AS note,
         count(*) FILTER (o_orderkey % 3 = 0) AS price, count(*) AS nothing FROM orders)
SELECT column_name, type, n AS n_rows, CAST(n_missing AS BIGINT) AS n_missing FROM n, (
  SELECT 'id' AS column_name, 'bigint' AS type, 0 AS n_missing UNION ALL SELECT 'frontage', 'string', frontage FROM m
  UNION ALL SELECT 'veneer_area', 'double', veneer_area FROM m UNION ALL SELECT 'code', 'bigint', 0
  UNION ALL SELECT 'flag', 'boolean', flag FROM m UNION ALL SELECT 'note', 'string', note FROM m
  UNION ALL SELECT 'padded', 'bigint', 0 UNION ALL SELECT 'price', 'double', price FROM m
  UNION ALL SELECT 'ident', 'string', 0 UNION ALL SELECT 'nothing', 'double', nothing FROM m)""",
    "csv_inferred": """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '10d'
            ELSE CAST(o_custkey % 97 + 20 AS VARCHAR) END AS frontage,
       CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_custkey % 500 AS DOUBLE) END AS veneer_area,
       CAST(o_custkey % 1000 AS BIGINT) AS code,
       CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey % 2 = 0 END AS flag,
       CASE WHEN o_orderkey % 5 = 0 THEN ' NA ' WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS note,
       CAST(o_custkey AS BIGINT) AS padded,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS price,
       '99999999999999999999' || CAST(o_orderkey AS VARCHAR) AS ident, CAST(NULL AS DOUBLE) AS nothing
FROM orders""",
    "table_properties": """
SELECT key, value, n_rows FROM (
  SELECT 'feed.enabled' AS key, 'true' AS value UNION ALL SELECT 'owner''s note', 'kept as it''s') t,
  (SELECT count(*) AS n_rows FROM customer) c""",
    "catalog_tables": _with(SPLIT) + """
SELECT 'spark_catalog.' || split || '_set' AS table_name, count(*) AS n_rows, CAST(sum(CAST(id AS BIGINT)) AS BIGINT) AS id_sum
FROM tagged GROUP BY split""",
    "column_check": _with(RAW_ORDERS) + """
SELECT * FROM (
  SELECT 'priority' AS column_name, true AS expected, true AS present, CAST(count_if(priority IS NULL) AS BIGINT) AS n_missing FROM raw
  UNION ALL SELECT 'status', true, true, CAST(count_if(status IS NULL) AS BIGINT) FROM raw
  UNION ALL SELECT 'frontage', true, true, CAST(count_if(frontage IS NULL) AS BIGINT) FROM raw
  UNION ALL SELECT 'veneer_area', true, true, CAST(count_if(veneer_area IS NULL) AS BIGINT) FROM raw
  UNION ALL SELECT 'year_built', true, true, CAST(count_if(year_built IS NULL) AS BIGINT) FROM raw
  UNION ALL SELECT 'target', true, true, CAST(count_if(target IS NULL) AS BIGINT) FROM raw
  UNION ALL SELECT 'id', true, true, CAST(count_if(id IS NULL) AS BIGINT) FROM raw
  UNION ALL SELECT 'garage_year', true, false, NULL)""",
    "tree_numbers": _with(COERCED) + """
SELECT id, coalesce(frontage, CAST(-1.0e15 AS DOUBLE)) AS frontage, coalesce(veneer_area, CAST(-1.0e15 AS DOUBLE)) AS veneer_area,
       CAST(frontage IS NULL AS INTEGER) AS frontage_missing, CAST(veneer_area IS NULL AS INTEGER) AS veneer_area_missing
FROM coerced""",
    "table_scan": "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer",
    "table_exists": "SELECT count(*) AS n_rows, true AS table_exists FROM customer",
    "save_overwrite": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "save_append": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders""",
    "local_rows": """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'
       WHEN '3-MEDIUM' THEN 'medium' WHEN '4-NOT SPECIFIED' THEN 'unspecified' WHEN '5-LOW' THEN 'low'
       END AS label FROM orders""",
    "preview": _with(CLEAN) + f"SELECT {CLEAN_COLS} FROM clean ORDER BY id LIMIT 10",
    "process_data": _with(SPLIT) + f"""
SELECT {CLEAN_COLS}, TIMESTAMP '2025-01-01 00:00:00' AS update_timestamp_utc, split FROM tagged""",
}
