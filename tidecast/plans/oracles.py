"""The registered queries again, as SQL for an independent engine."""

from __future__ import annotations

from tidecast.operators.usage import INSTANCE_FAMILY_RATES, WAREHOUSE_SIZE_RATES

EVENTS = """
    SELECT printf('U%05d', user_id) AS PARTITION_ID, ts AS TS,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS K, CAST(hour(ts) AS INTEGER) AS HOUR,
           CAST(event_type = 'click' AS INTEGER) AS IS_CLICK,
           CAST(event_type = 'error' AS INTEGER) AS IS_ERROR,
           CAST(event_type = 'purchase' AS INTEGER) AS IS_PURCHASE,
           CAST(event_type = 'signup' AS INTEGER) AS IS_SIGNUP,
           CAST(event_type = 'view' AS INTEGER) AS IS_VIEW,
           dayofyear(ts) / 365.0::DOUBLE AS DOY_RATIO,
           (isodow(ts) - 1) / 6.0::DOUBLE AS DOW_RATIO, value AS TARGET
    FROM events"""

ALL_FEATURES = ["K", "HOUR", "IS_CLICK", "IS_ERROR", "IS_PURCHASE", "IS_SIGNUP", "IS_VIEW", "DOY_RATIO", "DOW_RATIO"]
SHORT = f"SELECT PARTITION_ID, TS, K, HOUR, TARGET FROM ({EVENTS})"


def mean_cents(column: str) -> str:
    return f"CAST(sum(CAST(round({column} * 100) AS BIGINT)) AS DOUBLE) / 100.0::DOUBLE / count(*)"


DAILY = f"""
    SELECT printf('S%04d', l_suppkey) AS PARTITION_ID, l_shipdate AS TS,
           {mean_cents('l_quantity')} AS QUANTITY, {mean_cents('l_discount')} AS DISCOUNT,
           {mean_cents('l_tax')} AS TAX,
           dayofyear(l_shipdate) / 365.0::DOUBLE AS DOY_RATIO,
           (isodow(l_shipdate) - 1) / 6.0::DOUBLE AS DOW_RATIO,
           CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100.0::DOUBLE AS TARGET
    FROM lineitem GROUP BY l_suppkey, l_shipdate"""


def split(panel: str, pct: str = "0.1", grain: str = "PARTITION_ID", order: str = "TS ASC NULLS LAST") -> str:
    return f"""
    SELECT * EXCLUDE (rn, n), rn <= CAST(floor(n * (1.0::DOUBLE - {pct}::DOUBLE)) AS BIGINT) AS IS_TRAIN
    FROM (SELECT *, row_number() OVER (PARTITION BY {grain} ORDER BY {order}) AS rn,
                 count(*) OVER (PARTITION BY {grain}) AS n
          FROM ({panel}) AS panel WHERE {grain} IS NOT NULL)"""


LINE_ORDER = (
    "l_shipdate ASC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_quantity, "
    "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
)

# Least squares on K and HOUR by Cramer's rule, on float32 targets as the learners see them.
LINEAR = f"""
WITH labelled AS ({split(SHORT)}),
train AS (SELECT PARTITION_ID, TS, K::DOUBLE AS a, HOUR::DOUBLE AS b, CAST(TARGET AS FLOAT)::DOUBLE AS y
          FROM labelled WHERE IS_TRAIN),
test AS (SELECT * EXCLUDE (IS_TRAIN) FROM labelled WHERE NOT IS_TRAIN),
m AS (SELECT PARTITION_ID, count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my,
             covar_pop(a, a) AS saa, covar_pop(a, b) AS sab, covar_pop(b, b) AS sbb,
             covar_pop(a, y) AS say, covar_pop(b, y) AS sby
      FROM train GROUP BY PARTITION_ID),
slopes AS (SELECT *, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS ca,
                  (sby * saa - say * sab) / (saa * sbb - sab * sab) AS cb FROM m),
coef AS (SELECT *, my - ca * ma - cb * mb AS c0 FROM slopes),
quality AS (SELECT PARTITION_ID, count(*) AS TRAIN_ROWS, avg(abs(y - (c0 + ca * a + cb * b))) AS mae,
                   sqrt(avg((y - (c0 + ca * a + cb * b)) ** 2)) AS rmse
            FROM train JOIN coef USING (PARTITION_ID) GROUP BY PARTITION_ID),
scored AS (SELECT PARTITION_ID, TS, TARGET, c0 + ca * K + cb * HOUR AS p FROM test JOIN coef USING (PARTITION_ID)),
share AS (SELECT PARTITION_ID, abs(ca) * sqrt(saa) AS wa, abs(cb) * sqrt(sbb) AS wb FROM coef)
"""

EVALUATED = """
SELECT PARTITION_ID, round(avg(abs(TARGET - p)), 5) AS MAE,
       round(sqrt(avg((TARGET - p) ** 2)), 5) AS RMSE, count(*) AS ROWS
FROM scored GROUP BY PARTITION_ID"""

RUN_AT = "TIMESTAMP '2024-03-02 12:30:00'"
RUN = "'training_v20240302_1230' AS RUN_ID, 'v20240302_1230' AS MODEL_VERSION"
STAGE = "'models/training_v20240302_1230/' || PARTITION_ID AS STAGE_PATH"
READY = "(SELECT PARTITION_ID FROM quality WHERE TRAIN_ROWS >= 60)"

VERSIONS = """
    SELECT PARTITION_ID, TRAINED_AT, o_orderpriority, strftime(TRAINED_AT, 'v%Y%m%d_%H%M') AS MODEL_VERSION,
           'training_' || strftime(TRAINED_AT, 'v%Y%m%d_%H%M') AS RUN_ID
    FROM (SELECT printf('C%06d', o_custkey) AS PARTITION_ID, o_orderpriority,
                 o_orderdate + to_minutes(o_orderkey % 1440) AS TRAINED_AT FROM orders)"""

ACTIVE = f"""
    SELECT *, TRAINED_AT = max(TRAINED_AT) OVER (PARTITION BY PARTITION_ID) AS IS_ACTIVE,
           'models/' || RUN_ID || '/' || PARTITION_ID AS STAGE_PATH
    FROM ({VERSIONS})"""

CUSTOMERS = "SELECT printf('C%06d', c_custkey) AS PARTITION_ID, c_acctbal FROM customer"

# A tree with one split: every threshold of every feature, best gain first.
def stump(train: str, features: list[str]) -> str:
    cells = " UNION ALL ".join(
        f"SELECT PARTITION_ID, {i} AS f, CAST({c} AS FLOAT) AS x, y FROM {train}" for i, c in enumerate(features)
    )
    return f"""
base AS (SELECT PARTITION_ID, avg(y) AS b, count(*) AS h FROM {train} GROUP BY PARTITION_ID),
sums AS (SELECT PARTITION_ID, f, x, sum(b - y) AS g, count(*) AS h
         FROM ({cells}) AS cells JOIN (SELECT PARTITION_ID, b FROM base) USING (PARTITION_ID) GROUP BY PARTITION_ID, f, x),
below AS (SELECT PARTITION_ID, f, x,
                 sum(g) OVER w - g AS lg, sum(h) OVER w - h AS lh,
                 sum(g) OVER (PARTITION BY PARTITION_ID, f) AS tg, sum(h) OVER (PARTITION BY PARTITION_ID, f) AS th
          FROM sums WINDOW w AS (PARTITION BY PARTITION_ID, f ORDER BY x)),
gains AS (SELECT *, CAST(lg * lg / (lh + 1) + (tg - lg) * (tg - lg) / (th - lh + 1) - tg * tg / (th + 1) AS FLOAT) AS gain
          FROM below WHERE lh > 0),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY PARTITION_ID ORDER BY gain DESC, f, x) AS r
                        FROM gains WHERE gain > 0.000001) WHERE r = 1),
tree AS (SELECT base.PARTITION_ID, b, f, x,
                CAST(-0.3::DOUBLE * lg / (lh + 1) AS FLOAT) AS lv,
                CAST(-0.3::DOUBLE * (tg - lg) / (th - lh + 1) AS FLOAT) AS rv
         FROM base LEFT JOIN best ON base.PARTITION_ID = best.PARTITION_ID)"""


def stump_value(features: list[str]) -> str:
    picked = " ".join(f"WHEN {i} THEN CAST({c} AS FLOAT)" for i, c in enumerate(features))
    return f"b + CASE WHEN f IS NULL THEN 0 WHEN CASE f {picked} END < x THEN lv ELSE rv END"


def forest(rows: str, width: int, rounds: int, depth: int) -> str:
    """CTEs that grow whole trees, level by level, on ``rows`` with x0.., y, is_train and pred.

    A threshold is the next training value of the whole series above the last value on the
    left. Held-out rows walk down with the others; the last CTE, ``grown``, has their predictions.
    """
    seen = " UNION ".join(f"SELECT PARTITION_ID, {i} AS f, x{i} AS x FROM {rows} WHERE is_train" for i in range(width))
    out = [f"""
above AS MATERIALIZED (
    SELECT *, lead(x) OVER (PARTITION BY PARTITION_ID, f ORDER BY x) AS threshold FROM ({seen}))"""]
    current = rows
    for t in range(rounds):
        out.append(f"r{t}_0 AS MATERIALIZED (SELECT *, 0 AS node FROM {current})")
        for d in range(depth):
            at, name = f"r{t}_{d}", f"{t}_{d}"
            cells = " UNION ALL ".join(
                f"SELECT PARTITION_ID, node, {i} AS f, x{i} AS x, pred - y AS g FROM {at} WHERE is_train" for i in range(width)
            )
            own = " ".join(f"WHEN {i} THEN x{i}" for i in range(width))
            out.append(f"""
b{name} AS MATERIALIZED (
    SELECT PARTITION_ID, node, f, threshold FROM (
        SELECT *, row_number() OVER (PARTITION BY PARTITION_ID, node ORDER BY gain DESC, f, x) AS rank FROM (
            SELECT *, CAST(lg * lg / (lh + 1) + (tg - lg) * (tg - lg) / (th - lh + 1) - tg * tg / (th + 1) AS FLOAT) AS gain
            FROM (SELECT PARTITION_ID, node, f, x, sum(g) OVER w AS lg, sum(h) OVER w AS lh,
                         sum(g) OVER p AS tg, sum(h) OVER p AS th
                  FROM (SELECT PARTITION_ID, node, f, x, sum(g) AS g, count(*) AS h FROM ({cells}) GROUP BY ALL)
                  WINDOW p AS (PARTITION BY PARTITION_ID, node, f), w AS (PARTITION BY PARTITION_ID, node, f ORDER BY x))
            WHERE lh < th) WHERE gain > 0.000001) JOIN above USING (PARTITION_ID, f, x) WHERE rank = 1),
r{t}_{d + 1} AS MATERIALIZED (
    SELECT r.* EXCLUDE (node), 2 * node + CASE WHEN b.f IS NULL OR CASE b.f {own} END < b.threshold THEN 0 ELSE 1 END AS node
    FROM {at} AS r LEFT JOIN b{name} AS b USING (PARTITION_ID, node))""")
        current = f"p{t}" if t < rounds - 1 else "grown"
        out.append(f"""
{current} AS MATERIALIZED (
    SELECT r.* EXCLUDE (pred, node), pred + v AS pred
    FROM r{t}_{depth} AS r
    JOIN (SELECT PARTITION_ID, node, CAST(-0.3::DOUBLE * sum(pred - y) / (count(*) + 1) AS FLOAT) AS v
          FROM r{t}_{depth} WHERE is_train GROUP BY PARTITION_ID, node) USING (PARTITION_ID, node))""")
    return ",".join(out)


LONG_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def uniform(key: str) -> str:
    return f"(('0x' || substr(md5({key}), 1, 8))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4294967296.0::DOUBLE"


def normal(key: str, mean: int, sd: int) -> str:
    radius = f"sqrt(-2.0::DOUBLE * ln({uniform(key + " || '/r'")}))"
    return f"({mean} + {sd} * {radius} * cos(2.0::DOUBLE * pi() * ({uniform(key + " || '/a'")})))"


SEASONAL = "(1.0::DOUBLE + 0.2::DOUBLE * sin(2.0::DOUBLE * pi() * dayofyear({0}) / 365.0::DOUBLE))"
WEEKDAY = "(CASE WHEN isodow({0}) IN (5, 6) THEN 1.1::DOUBLE ELSE 1.0::DOUBLE END)"

SCAFFOLD = """
    SELECT PARTITION_ID, STEP, TIMESTAMP '2024-03-02' + to_days(STEP) AS TS
    FROM (SELECT printf('P%04d', s_suppkey) AS PARTITION_ID, CAST(unnest(range(730)) AS INTEGER) AS STEP FROM supplier)"""

SERIES_KEY = "'42|' || PARTITION_ID"
ROW_KEY = f"{SERIES_KEY} || '|' || STEP"

GENERATED = f"""
    SELECT TS, PARTITION_ID, FEATURE_1, FEATURE_2, FEATURE_3, FEATURE_4, FEATURE_5, FEATURE_6,
           greatest(0.0::DOUBLE, round(base * effect * seasonal * weekday + noise
             + 0.3::DOUBLE / 1 * FEATURE_1 + 0.3::DOUBLE / 2 * FEATURE_2 + 0.3::DOUBLE / 3 * FEATURE_3
             + 0.3::DOUBLE / 4 * FEATURE_4 + 0.3::DOUBLE / 5 * FEATURE_5 + 0.3::DOUBLE / 6 * FEATURE_6, 2)) AS TARGET
    FROM (SELECT *,
                 round({normal(f"({ROW_KEY} || '|1')", 50, 10)} * effect, 4) AS FEATURE_1,
                 round({normal(f"({ROW_KEY} || '|2')", 30, 5)} * seasonal, 4) AS FEATURE_2,
                 round(100 * ({uniform(f"{ROW_KEY} || '|3'")}), 4) AS FEATURE_3,
                 round(dayofyear(TS) / 365.0::DOUBLE, 4) AS FEATURE_4,
                 round((isodow(TS) - 1) / 6.0::DOUBLE, 4) AS FEATURE_5,
                 round({normal(f"({ROW_KEY} || '|6')", 0, 1)}, 4) + 0.0::DOUBLE AS FEATURE_6,
                 {normal(f"({ROW_KEY} || '|noise')", 0, 3)} AS noise
          FROM (SELECT *, 20 + 80 * ({uniform(f"{SERIES_KEY} || '|base'")}) AS base,
                       0.7::DOUBLE + 0.6::DOUBLE * ({uniform(f"{SERIES_KEY} || '|effect'")}) AS effect,
                       {SEASONAL.format('TS')} AS seasonal, {WEEKDAY.format('TS')} AS weekday
                FROM ({SCAFFOLD})))"""


def values(rates: dict, key: str) -> str:
    rows = ", ".join(f"('{k}', {round(v * 100)})" for k, v in rates.items())
    return f"(SELECT * FROM (VALUES {rows}) AS card({key}, cents))"


def names(rates: dict, *more: str) -> str:
    return "[" + ", ".join(f"'{k}'" for k in [*rates, *more]) + "]"


QUERY_LOG = f"""
    SELECT event_type AS QUERY_TAG,
           CASE WHEN event_type IN ('click', 'view') THEN 'Inference' ELSE 'Training' END AS JOB,
           ({names(WAREHOUSE_SIZE_RATES, 'Unlisted')})[user_id % {len(WAREHOUSE_SIZE_RATES) + 2} + 1] AS WAREHOUSE_SIZE,
           CAST(round(value * 1000) AS BIGINT) AS EXECUTION_TIME
    FROM events"""

RUN_LOG = f"""
    SELECT o_orderkey AS RUN_ID, CASE WHEN o_orderstatus = 'F' THEN 'Training' ELSE 'Inference' END AS JOB,
           CASE WHEN o_orderpriority = '5-LOW' THEN 'warehouse' ELSE 'container' END AS ROUTE,
           ({names(INSTANCE_FAMILY_RATES, 'UNLISTED')})[o_custkey % {len(INSTANCE_FAMILY_RATES) + 1} + 1] AS INSTANCE_FAMILY,
           CAST(o_orderkey % 5 + 1 AS INTEGER) AS NODES, o_orderdate AS STARTED,
           o_orderdate + to_microseconds(CAST(round(o_totalprice * 1000000) AS BIGINT)) AS ENDED
    FROM orders"""

USAGE = f"""
WITH runs AS (SELECT *, epoch_us(ENDED) - epoch_us(STARTED) AS MICROS FROM ({RUN_LOG})),
costed AS (SELECT runs.*, CASE WHEN ROUTE = 'container'
                               THEN CAST(MICROS AS HUGEINT) * coalesce(cents, 0) * NODES ELSE 0 END AS units
           FROM runs LEFT JOIN {values(INSTANCE_FAMILY_RATES, 'INSTANCE_FAMILY')} USING (INSTANCE_FAMILY)),
used AS (SELECT q.*, CAST(EXECUTION_TIME AS HUGEINT) * 1000 * coalesce(cents, 0) AS units
         FROM ({QUERY_LOG}) AS q LEFT JOIN {values(WAREHOUSE_SIZE_RATES, 'WAREHOUSE_SIZE')} USING (WAREHOUSE_SIZE)
         WHERE WAREHOUSE_SIZE IS NOT NULL),
jobs AS (SELECT JOB, sum(CAST(MICROS AS HUGEINT)) AS m, sum(units) AS c FROM costed GROUP BY JOB),
houses AS (SELECT JOB, sum(units) AS w FROM used GROUP BY JOB),
summed AS (SELECT coalesce(JOB, 'Total') AS JOB, sum(m) AS m, sum(c) AS c, sum(w) AS w
           FROM jobs JOIN houses USING (JOB) GROUP BY GROUPING SETS ((JOB), ())),
summary AS (SELECT JOB, CAST((m + 5000) // 10000 AS DOUBLE) / 100.0::DOUBLE AS DURATION_SECS,
                   CAST((m + 300000) // 600000 AS DOUBLE) / 100.0::DOUBLE AS DURATION_MINS,
                   CAST((c + 180000) // 360000 AS DOUBLE) / 1000000.0::DOUBLE AS CONTAINER_CREDITS,
                   CAST((w + 180000) // 360000 AS DOUBLE) / 1000000.0::DOUBLE AS WAREHOUSE_CREDITS,
                   CAST((c + w + 180000) // 360000 AS DOUBLE) / 1000000.0::DOUBLE AS TOTAL_CREDITS FROM summed)
"""


def order_spine(unit: str) -> str:
    step = f"to_{unit}s(CAST(STEP AS BIGINT))" if unit == "day" else f"to_{unit}s(CAST(STEP AS INTEGER))"
    return f"""
SELECT o_custkey, STEP, first + {step} AS TS
FROM (SELECT o_custkey, first, CAST(unnest(range(n)) AS INTEGER) AS STEP
      FROM (SELECT o_custkey, min(o_orderdate) AS first, count(*) AS n FROM orders GROUP BY o_custkey))"""


UNITS = " UNION ALL ".join(
    f"SELECT s_suppkey, '{u}' AS UNIT, STEP, TIMESTAMP '2024-01-31' + INTERVAL (STEP) {u} AS TS FROM steps"
    for u in ("second", "minute", "hour", "day", "week", "month")
)

ORACLES = {
    "panel_build_daily": f"""
        SELECT PARTITION_ID, TS, round(QUANTITY, 6) AS QUANTITY, round(DISCOUNT, 6) AS DISCOUNT, round(TAX, 6) AS TAX,
               round(DOY_RATIO, 6) AS DOY_RATIO, round(DOW_RATIO, 6) AS DOW_RATIO, TARGET FROM ({DAILY})""",
    "panel_features_events": f"""
        SELECT * REPLACE (round(DOY_RATIO, 6) AS DOY_RATIO, round(DOW_RATIO, 6) AS DOW_RATIO) FROM ({EVENTS})""",
    "panel_model_input": "SELECT PARTITION_ID, TS, round(CAST(TARGET AS FLOAT)::DOUBLE, 4) AS TARGET, "
    + ", ".join(
        f"round(CAST({c} AS FLOAT)::DOUBLE, 4) AS {c}"
        for c in ("K", "HOUR", "IS_CLICK", "IS_ERROR", "IS_PURCHASE", "IS_SIGNUP", "IS_VIEW", "DOY_RATIO", "DOW_RATIO")
    )
    + f" FROM ({EVENTS})",
    "panel_summary": """
        SELECT count(*) AS TOTAL_ROWS, count(DISTINCT l_suppkey) AS PARTITIONS,
               min(l_shipdate) AS MIN_DATE, max(l_shipdate) AS MAX_DATE FROM lineitem""",
    "rows_per_partition": "SELECT l_suppkey, count(*) AS PARTITION_COUNT FROM lineitem GROUP BY l_suppkey",
    "rank_in_time_events": f"""
        SELECT PARTITION_ID, TS, row_number() OVER (PARTITION BY PARTITION_ID ORDER BY TS ASC NULLS LAST) AS ROW_NUM
        FROM ({EVENTS})""",
    "rank_in_time_ties": f"""
        SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {LINE_ORDER}) AS ROW_NUM FROM lineitem""",
    "split_train": f"SELECT * EXCLUDE (IS_TRAIN) FROM ({split(SHORT)}) WHERE IS_TRAIN",
    "split_test": f"SELECT * EXCLUDE (IS_TRAIN) FROM ({split(SHORT)}) WHERE NOT IS_TRAIN",
    "split_ties": split("SELECT * FROM lineitem", grain="l_suppkey", order=LINE_ORDER),
    "split_daily": split(f"SELECT PARTITION_ID, TS, TARGET FROM ({DAILY})", "0.25"),
    "split_cutoffs": """
        SELECT l_suppkey, PARTITION_COUNT, TEST_PCT,
               CAST(floor(PARTITION_COUNT * (1.0::DOUBLE - TEST_PCT)) AS BIGINT) AS TRAIN_CUTOFF
        FROM (SELECT l_suppkey, count(*) AS PARTITION_COUNT FROM lineitem GROUP BY l_suppkey),
             (SELECT unnest([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]::DOUBLE[]) AS TEST_PCT)""",
    "split_counts": f"SELECT IS_TRAIN, count(*) AS ROWS FROM ({split(SHORT)}) GROUP BY IS_TRAIN",
    "split_boundaries": f"""
        SELECT PARTITION_ID, max(TS) FILTER (WHERE IS_TRAIN) AS LAST_TRAIN, min(TS) FILTER (WHERE NOT IS_TRAIN) AS FIRST_TEST,
               count(*) FILTER (WHERE IS_TRAIN) AS TRAIN_ROWS, count(*) FILTER (WHERE NOT IS_TRAIN) AS TEST_ROWS
        FROM ({split(SHORT)}) GROUP BY PARTITION_ID""",
    "split_roundtrip": f"""
        WITH p AS ({SHORT}), s AS ({split(SHORT)}),
        b AS (SELECT * EXCLUDE (IS_TRAIN) FROM s WHERE IS_TRAIN
              UNION ALL SELECT * EXCLUDE (IS_TRAIN) FROM s WHERE NOT IS_TRAIN)
        SELECT (SELECT count(*) FROM (SELECT * FROM p EXCEPT ALL SELECT * FROM b)) AS LOST,
               (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM p)) AS GAINED""",
    "linreg_fit": LINEAR + """
        SELECT PARTITION_ID, round(c0, 6) AS INTERCEPT, round(ca, 6) AS COEF_K, round(cb, 6) AS COEF_HOUR FROM coef""",
    "linreg_predict": LINEAR + "SELECT PARTITION_ID, TS, TARGET, round(p, 5) AS PREDICTION FROM scored",
    "linreg_eval": LINEAR + EVALUATED,
    "eval_linear": LINEAR + EVALUATED,
    "train_models_linear": LINEAR + f"""
        SELECT PARTITION_ID, {RUN}, 'linear' AS ALGORITHM, {RUN_AT} AS TRAINED_AT, 'ok' AS STATUS, TRAIN_ROWS,
               round(mae, 5) AS TRAIN_MAE, round(rmse, 5) AS TRAIN_RMSE FROM quality""",
    "metrics_by_feature": LINEAR + """
        SELECT PARTITION_ID, 'K' AS FEATURE, round(wa / (wa + wb), 5) AS IMPORTANCE FROM share
        UNION ALL SELECT PARTITION_ID, 'HOUR', round(wb / (wa + wb), 5) FROM share""",
    "metrics_variant": LINEAR + """
        SELECT PARTITION_ID, TRAIN_ROWS, round(mae, 5) AS TRAIN_MAE, round(wa / (wa + wb), 5) AS IMPORTANCE_K
        FROM quality JOIN share USING (PARTITION_ID)""",
    "score_gbt_stump": LINEAR.rstrip() + f""",
        fitted AS (SELECT PARTITION_ID, a AS K, b AS HOUR, y FROM train), {stump('fitted', ['K', 'HOUR'])}
        SELECT PARTITION_ID, TS, TARGET, round({stump_value(['K', 'HOUR'])}, 4) AS PREDICTION
        FROM test JOIN tree USING (PARTITION_ID)""",
    "score_gbt_small": f"""
        WITH labelled AS ({split(SHORT)}),
        rows AS MATERIALIZED (
            SELECT PARTITION_ID, TS, TARGET, IS_TRAIN AS is_train, CAST(K AS FLOAT) AS x0, CAST(HOUR AS FLOAT) AS x1,
                   CAST(TARGET AS FLOAT)::DOUBLE AS y,
                   avg(CAST(TARGET AS FLOAT)::DOUBLE) FILTER (WHERE IS_TRAIN) OVER (PARTITION BY PARTITION_ID) AS pred
            FROM labelled),
        {forest('rows', 2, 4, 3)}
        SELECT PARTITION_ID, TS, TARGET, round(pred, 4) AS PREDICTION FROM grown WHERE NOT is_train""",
    "train_long_series": f"""
        WITH lines AS (SELECT l_returnflag AS PARTITION_ID, {', '.join(LONG_FEATURES)},
                              CAST(l_extendedprice AS FLOAT)::DOUBLE AS y FROM lineitem),
        {stump('lines', LONG_FEATURES)}
        SELECT PARTITION_ID, round({stump_value(LONG_FEATURES)}, 2) AS PREDICTION, count(*) AS ROWS
        FROM lines JOIN tree USING (PARTITION_ID) GROUP BY ALL""",
    "udtf_train": LINEAR + """
        SELECT PARTITION_ID, count(*) AS TRAIN_ROWS, min(TS) AS FIRST_TS, max(TS) AS LAST_TS,
               round(regr_slope(y, a), 6) AS SLOPE, round(regr_intercept(y, a), 6) AS INTERCEPT
        FROM train GROUP BY PARTITION_ID""",
    "udtf_score": f"""
        WITH labelled AS ({split(EVENTS)}),
        fitted AS (SELECT * EXCLUDE (IS_TRAIN), CAST(TARGET AS FLOAT)::DOUBLE AS y FROM labelled WHERE IS_TRAIN),
        {stump('fitted', ALL_FEATURES)}
        SELECT PARTITION_ID, TS, TARGET, round({stump_value(ALL_FEATURES)}, 4) AS PREDICTION
        FROM labelled JOIN tree USING (PARTITION_ID) WHERE NOT IS_TRAIN""",
    "catalog_build": LINEAR + f"""
        SELECT PARTITION_ID, {RUN_AT} AS TRAINED_AT, 'v20240302_1230' AS MODEL_VERSION, true AS IS_ACTIVE,
               {STAGE}, TRAIN_ROWS FROM quality""",
    "catalog_active_per_grain": f"SELECT PARTITION_ID, TRAINED_AT, MODEL_VERSION, IS_ACTIVE FROM ({ACTIVE})",
    "catalog_latest_version": f"""
        SELECT MODEL_VERSION FROM ({ACTIVE}) WHERE IS_ACTIVE ORDER BY TRAINED_AT DESC, MODEL_VERSION DESC LIMIT 1""",
    "run_versions": f"""
        SELECT PARTITION_ID, MODEL_VERSION, RUN_ID, strftime(TRAINED_AT, 'inference_%Y%m%d_%H%M') AS INFERENCE_RUN_ID,
               strftime(TRAINED_AT, '%Y-%m-%d') AS TRAINED_ON FROM ({VERSIONS})""",
    "version_of_run": f"SELECT RUN_ID, min(MODEL_VERSION) AS MODEL_VERSION FROM ({VERSIONS}) GROUP BY RUN_ID",
    "times_from_text": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN date_trunc('minute', CAST(o_orderdate AS TIMESTAMP)) END AS TS
        FROM orders""",
    "artifact_paths": f"""
        SELECT PARTITION_ID, 'stage/' || RUN_ID || '/' || PARTITION_ID AS STAGE_PATH FROM ({VERSIONS})""",
    "catalog_attach_paths": f"""
        SELECT c.PARTITION_ID, c.c_acctbal, a.STAGE_PATH FROM ({CUSTOMERS}) AS c
        JOIN (SELECT DISTINCT PARTITION_ID, STAGE_PATH FROM ({ACTIVE}) WHERE IS_ACTIVE) AS a USING (PARTITION_ID)""",
    "catalog_without_artifact": f"""
        SELECT * FROM ({CUSTOMERS}) WHERE PARTITION_ID NOT IN
              (SELECT PARTITION_ID FROM ({ACTIVE}) WHERE IS_ACTIVE AND o_orderpriority = '1-URGENT')""",
    "manifest_map": LINEAR + f"SELECT PARTITION_ID, {STAGE} FROM quality",
    "rows_to_score": LINEAR + f"SELECT test.*, {STAGE} FROM test WHERE PARTITION_ID IN {READY}",
    "registry_default_version": f"""
        SELECT MODEL_NAME, MODEL_VERSION, RUN_ID
        FROM (SELECT o_orderpriority AS MODEL_NAME, MODEL_VERSION, RUN_ID,
                     row_number() OVER (PARTITION BY o_orderpriority ORDER BY TRAINED_AT DESC, MODEL_VERSION DESC) AS r
              FROM ({VERSIONS})) WHERE r = 1""",
    "registry_conform": "SELECT PARTITION_ID, TS, "
    + ", ".join(
        f"round(CAST({c} AS FLOAT)::DOUBLE, 4) AS {c}"
        for c in ("K", "HOUR", "IS_CLICK", "IS_ERROR", "IS_PURCHASE", "IS_SIGNUP", "IS_VIEW", "DOY_RATIO", "DOW_RATIO")
    )
    + f" FROM ({EVENTS})",
    "score_drop_missing": LINEAR + f"""
        SELECT PARTITION_ID, TS, TARGET, round(p, 5) AS PREDICTION FROM scored WHERE PARTITION_ID IN {READY}""",
    "score_strict": LINEAR + "SELECT PARTITION_ID, TS, TARGET, round(p, 5) AS PREDICTION FROM scored",
    "score_registry": LINEAR + """
        SELECT PARTITION_ID AS OUTPUT_PARTITION_ID, TS AS OUTPUT_TS, round(CAST(p AS FLOAT)::DOUBLE, 3) AS PRED_TARGET
        FROM scored""",
    "predictions_join_actuals": LINEAR + """
        SELECT PARTITION_ID, TS, TARGET, round(CAST(p AS FLOAT)::DOUBLE, 3) AS PREDICTION FROM scored""",
    "missing_models": LINEAR + f"SELECT * FROM test WHERE PARTITION_ID NOT IN {READY}",
    "sample_predictions": LINEAR + """
        SELECT PARTITION_ID, TS, TARGET, round(p, 5) AS PREDICTION FROM scored ORDER BY PARTITION_ID, TS LIMIT 5""",
    "summary_appended": f"""
        SELECT count(*) AS TOTAL_ROWS, count(DISTINCT PARTITION_ID) AS PARTITIONS, min(TS) AS MIN_DATE, max(TS) AS MAX_DATE
        FROM ({SHORT})""",
    "split_appended": split(SHORT),
    "eval_colocated": LINEAR + EVALUATED,
    "gbt_sanity": f"""
        WITH l AS ({split(DAILY)})
        SELECT PARTITION_ID, 'ok' AS STATUS, count(*) FILTER (IS_TRAIN) AS TRAIN_ROWS, 1.0::DOUBLE AS SHARES,
               count(*) FILTER (NOT IS_TRAIN) AS ANSWERED, true AS BEATS_MEAN
        FROM l GROUP BY PARTITION_ID""",
    "export_reload": SHORT,
    "load_ledger": SHORT,
    "score_by_path": LINEAR + "SELECT PARTITION_ID, TS, TARGET, round(p, 5) AS PREDICTION FROM scored",
    "job_predictions": LINEAR + "SELECT PARTITION_ID, TS, TARGET, round(p, 5) AS PREDICTION FROM scored",
    "artifact_reload": LINEAR + """
        SELECT PARTITION_ID AS SERIES, 'linear' AS ALGORITHM, 'K,HOUR' AS FEATURES, PARTITION_ID AS LAST, TRAIN_ROWS,
               round(mae, 5) AS TRAIN_MAE FROM quality""",
    "missing_artifacts": LINEAR + f"SELECT PARTITION_ID FROM quality WHERE PARTITION_ID NOT IN {READY}",
    "job_catalog": LINEAR + """
        SELECT name AS MODEL_NAME, 'v20240302_1230' AS MODEL_VERSION, 'training_v20240302_1230_' || name AS RUN_ID,
               count(*) AS MODELS, 'Training' AS JOB
        FROM quality, (SELECT unnest(['demand', 'price']) AS name) GROUP BY name""",
    "scoring_coverage": LINEAR + f"""
        SELECT PARTITION_ID, count(*) AS TO_SCORE, count(*) FILTER (PARTITION_ID IN {READY}) AS ANSWERED,
               count(*) FILTER (PARTITION_ID IN {READY}) AS SCORED
        FROM test GROUP BY PARTITION_ID""",
    "predictions_paired": """
        WITH l AS (SELECT l_suppkey, CASE WHEN l_orderkey % 9 <> 0 THEN l_shipdate END AS l_shipdate, l_quantity, l_extendedprice
                   FROM lineitem),
        a AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY l_quantity) AS k FROM l),
        b AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY l_extendedprice) AS k FROM l)
        SELECT a.l_suppkey, a.l_shipdate, b.l_extendedprice, a.l_quantity AS PREDICTION
        FROM a JOIN b ON a.l_suppkey = b.l_suppkey AND a.l_shipdate IS NOT DISTINCT FROM b.l_shipdate AND a.k = b.k""",
    "eval_merged": """
        WITH r AS (SELECT l_returnflag AS PARTITION_ID, CAST(l_quantity AS FLOAT)::DOUBLE AS a, CAST(l_discount AS FLOAT)::DOUBLE AS b,
                          CAST(l_extendedprice AS FLOAT)::DOUBLE AS y, l_extendedprice AS t FROM lineitem),
        m AS (SELECT PARTITION_ID, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, covar_pop(a, a) AS saa, covar_pop(a, b) AS sab,
                     covar_pop(b, b) AS sbb, covar_pop(a, y) AS say, covar_pop(b, y) AS sby FROM r GROUP BY PARTITION_ID),
        s AS (SELECT *, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS ca, (sby * saa - say * sab) / (saa * sbb - sab * sab) AS cb FROM m)
        SELECT PARTITION_ID, round(avg(abs(t - (my + ca * (a - ma) + cb * (b - mb)))), 4) AS MAE,
               round(sqrt(avg((t - (my + ca * (a - ma) + cb * (b - mb))) ** 2)), 4) AS RMSE, count(*) AS ROWS,
               'ridge' AS ALGORITHM, 'ok' AS STATUS, count(*) AS TRAIN_ROWS
        FROM r JOIN s USING (PARTITION_ID) GROUP BY PARTITION_ID""",
    "udtf_typed": LINEAR + """,
        one AS (SELECT PARTITION_ID, a, y, my + say / saa * (a - ma) AS p FROM train JOIN m USING (PARTITION_ID))
        SELECT 1 AS WIDTH, PARTITION_ID, count(*) AS TRAIN_ROWS, round(avg(abs(y - p)), 5) AS TRAIN_MAE,
               round(sqrt(avg((y - p) ** 2)), 5) AS TRAIN_RMSE, 'ok' AS STATUS, 1.0::DOUBLE AS IMPORTANCE_K, NULL::DOUBLE AS IMPORTANCE_HOUR
        FROM one GROUP BY PARTITION_ID
        UNION ALL
        SELECT 2, PARTITION_ID, TRAIN_ROWS, round(mae, 5), round(rmse, 5), 'ok', round(wa / (wa + wb), 5), round(wb / (wa + wb), 5)
        FROM quality JOIN share USING (PARTITION_ID)""",
    "usage_of_event_log": """
        WITH e AS (SELECT event_id, event_type, epoch_us(ts) // 1000 AS s, CAST(round(value * 1000) AS BIGINT) AS ms FROM events),
        q AS (SELECT event_type, event_id // 2 AS q, count(*) AS n, greatest(max(s + ms) - min(s), 0) AS wall,
                     sum(ms + 3) AS run, sum(ms * 500000 + 1500000) // 1000000 AS cpu
              FROM e GROUP BY ALL)
        SELECT event_type AS QUERY_TAG, count(*) AS QUERIES, sum(n)::BIGINT AS JOBS, sum(wall)::BIGINT AS EXECUTION_TIME,
               sum(run)::BIGINT AS TASK_TIME, sum(cpu)::BIGINT AS CPU_TIME, 0::BIGINT AS FAILED
        FROM q GROUP BY event_type""",
    "load_by_name": f"""
        SELECT TARGET AS target, CAST(NULL AS VARCHAR) AS absent, PARTITION_ID AS partition_id, TS AS ts FROM ({EVENTS})""",
    "staged_series": f"SELECT DISTINCT PARTITION_ID FROM ({EVENTS})",
    "spine_daily": order_spine("day"),
    "spine_monthly": order_spine("month"),
    "spine_units": f"""
        WITH steps AS (SELECT s_suppkey, CAST(unnest(range(s_nationkey + 1)) AS INTEGER) AS STEP FROM supplier) {UNITS}""",
    "panel_scaffold": SCAFFOLD,
    "seasonal_features": f"""
        SELECT o_orderkey, round({SEASONAL.format('o_orderdate')}, 6) AS SEASONAL, {WEEKDAY.format('o_orderdate')} AS WEEKDAY_EFFECT,
               round(dayofyear(o_orderdate) / 365.0::DOUBLE, 6) AS DOY_RATIO,
               round((isodow(o_orderdate) - 1) / 6.0::DOUBLE, 6) AS DOW_RATIO FROM orders""",
    "panel_generate": GENERATED,
    "panel_generate_summary": f"""
        SELECT count(*) AS TOTAL_ROWS, count(DISTINCT PARTITION_ID) AS PARTITIONS, min(TS) AS MIN_DATE, max(TS) AS MAX_DATE
        FROM ({SCAFFOLD})""",
    "usage_by_size": f"""
        SELECT QUERY_TAG, WAREHOUSE_SIZE, CAST(sum(EXECUTION_TIME) AS DOUBLE) / 1000.0::DOUBLE AS TOTAL_EXEC_SECS
        FROM ({QUERY_LOG}) WHERE WAREHOUSE_SIZE IS NOT NULL GROUP BY ALL""",
    "usage_of_tag": f"""
        SELECT WAREHOUSE_SIZE, CAST(sum(EXECUTION_TIME) AS DOUBLE) / 1000.0::DOUBLE AS TOTAL_EXEC_SECS
        FROM ({QUERY_LOG}) WHERE WAREHOUSE_SIZE IS NOT NULL AND QUERY_TAG = 'purchase' GROUP BY ALL""",
    "usage_of_tag_sql": f"""
        SELECT WAREHOUSE_SIZE, CAST(sum(EXECUTION_TIME) AS DOUBLE) / 1000.0::DOUBLE AS TOTAL_EXEC_SECS
        FROM ({QUERY_LOG}) WHERE WAREHOUSE_SIZE IS NOT NULL AND QUERY_TAG = 'purchase' GROUP BY ALL""",
    "wh_credits": USAGE + """
        SELECT QUERY_TAG, CAST((sum(units) + 180000) // 360000 AS DOUBLE) / 1000000.0::DOUBLE AS CREDITS FROM used GROUP BY QUERY_TAG""",
    "container_credits": USAGE + """
        SELECT RUN_ID, INSTANCE_FAMILY, NODES, MICROS,
               CAST((units + 180000) // 360000 AS DOUBLE) / 1000000.0::DOUBLE AS CREDITS FROM costed""",
    "run_durations": USAGE + """
        SELECT RUN_ID, MICROS / 1000000.0::DOUBLE AS SECONDS, MICROS / 1000000.0::DOUBLE / 60.0::DOUBLE AS MINUTES FROM runs""",
    "usage_summary": USAGE + "SELECT * FROM summary",
    "usage_overview": USAGE + """
        SELECT JOB, coalesce(family, '-') AS INSTANCE_FAMILY, coalesce(nodes, '-') AS NODES, DURATION_SECS, DURATION_MINS,
               CONTAINER_CREDITS, WAREHOUSE_CREDITS, TOTAL_CREDITS
        FROM summary LEFT JOIN (SELECT JOB, CASE WHEN min(INSTANCE_FAMILY) = max(INSTANCE_FAMILY) THEN max(INSTANCE_FAMILY) ELSE '-' END AS family,
                                       CASE WHEN min(NODES) = max(NODES) THEN CAST(max(NODES) AS VARCHAR) ELSE '-' END AS nodes
                                FROM runs GROUP BY JOB) USING (JOB)""",
    "run_id_from_log": r"""
        SELECT conv_id, turn, trim(regexp_extract(
                   CASE WHEN role = 'assistant' THEN text || chr(10) || 'RUN_ID=training_' || conv_id || ' ' || chr(10) || 'done'
                        ELSE text END, 'RUN_ID=(.+)', 1)) AS RUN_ID
        FROM conversations""",
}


def oracle_sql():
    return dict(ORACLES)
