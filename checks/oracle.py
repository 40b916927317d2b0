"""For each registered query the same result in DuckDB SQL.

The layers are spelled out as common table expressions and use plain windows
where the Spark jobs aggregate first, so the two sides share no method.
"""

from __future__ import annotations

_RAW = """
violation_texts AS (
  SELECT l_orderkey, string_agg(part, ' | ' ORDER BY part) AS violations
  FROM (SELECT l_orderkey,
               concat(l_linenumber, '. QTY ', CAST(trunc(l_quantity) AS INTEGER)) AS part
        FROM lineitem WHERE l_returnflag <> 'N')
  GROUP BY ALL
),
keyed AS (
  SELECT o_orderkey AS k, o_custkey AS u, CAST(o_orderdate AS DATE) AS ordered,
         left(o_orderpriority, 1) AS priority, c_name, c_custkey, c_nationkey, c_mktsegment, violations
  FROM orders JOIN customer ON c_custkey = o_custkey
  LEFT JOIN violation_texts ON l_orderkey = o_orderkey
),
raw AS (
  SELECT
    k AS inspection_id,
    concat('  ', CASE WHEN u % 7 <> 0 THEN c_name
                      ELSE replace(c_name, '#', if(k % 2 = 0, '''S ', 'S ')) END, ' ') AS dba_name,
    if(k % 5 = 0, NULL, c_name) AS aka_name,
    if(k % 41 = 0, NULL, CAST(u AS VARCHAR)) AS license_number,
    CASE WHEN k % 37 = 0 THEN NULL
         WHEN k % 500 = 3 THEN concat('rare type ', (k - 3) // 500)
         WHEN k % 53 = 7 THEN concat('kind ', k % 6)
         ELSE concat(' ', lower(c_mktsegment), ' ') END AS facility_type,
    CASE priority WHEN '1' THEN 'Risk 1 (High)' WHEN '2' THEN 'Risk 2 (Medium)'
                  WHEN '3' THEN 'Risk 3 (Low)' WHEN '4' THEN 'All' END AS risk,
    concat(c_custkey, ' W MAIN ST ') AS address,
    CASE k % 23 WHEN 0 THEN 'chicago ' WHEN 1 THEN 'CCHICAGO' WHEN 2 THEN 'EVANSTON'
                WHEN 3 THEN NULL WHEN 4 THEN 'Chicago' ELSE 'CHICAGO' END AS city,
    if(k % 23 = 2, 'in', 'IL') AS state,
    CAST(60600 + c_nationkey AS VARCHAR) AS zip,
    strftime(if(k % 4 = 0, CAST(date_trunc('month', ordered) AS DATE), ordered)
             + if(k % 11 = 0, INTERVAL 15 YEAR, INTERVAL 25 YEAR), '%m/%d/%Y') AS inspection_date,
    CASE k % 4 WHEN 0 THEN 'Canvass' WHEN 1 THEN 'Complaint ' WHEN 2 THEN 'License' END AS inspection_type,
    CASE WHEN k % 10 < 4 THEN 'Pass' WHEN k % 10 < 6 THEN 'Pass w/ Conditions'
         WHEN k % 10 < 8 THEN 'Fail' WHEN k % 10 = 9 THEN 'Out of Business'
         WHEN k % 40 = 8 THEN 'Not Ready' WHEN k % 40 = 18 THEN 'Business Not Located'
         ELSE 'No Entry' END AS results,
    violations,
    CAST(41600 + u % 400 AS DOUBLE) / CAST(1000 AS DOUBLE) AS latitude,
    CAST(u % 300 - 87900 AS DOUBLE) / CAST(1000 AS DOUBLE) AS longitude,
    TIMESTAMP '2026-01-01 06:00:00' AS ingested_at
  FROM keyed
)"""

_STG = _RAW + """,
stg AS (
  SELECT
    inspection_id, license_number, trim(dba_name) AS dba_name, trim(aka_name) AS aka_name,
    upper(trim(facility_type)) AS facility_type,
    coalesce(list_extract(['HIGH', 'MEDIUM', 'LOW'], risk_digit), 'UNKNOWN') AS risk_level,
    risk_digit AS risk_rank,
    trim(address) AS address, upper(trim(city)) AS city, upper(trim(state)) AS state, trim(zip) AS zip,
    CAST(try_strptime(inspection_date, '%m/%d/%Y') AS DATE) AS inspection_date,
    upper(trim(inspection_type)) AS inspection_type, trim(results) AS results,
    violations AS violations_raw,
    CAST(coalesce(len(string_split(violations, '|')), 0) AS INTEGER) AS violation_count,
    latitude, longitude, ingested_at,
    upper(trim(city)) IS NOT NULL AND upper(trim(city)) IS DISTINCT FROM 'CHICAGO' AS flag_out_of_jurisdiction,
    violations IS NULL AND trim(results) IS NOT DISTINCT FROM 'Fail' AS flag_fail_without_violations,
    risk IS NOT NULL AND risk_digit IS NULL AS flag_invalid_risk,
    license_number IS NULL AS flag_missing_license
  FROM (SELECT *, CAST(coalesce(if(contains(risk, '1'), 1, NULL), if(contains(risk, '2'), 2, NULL),
                                if(contains(risk, '3'), 3, NULL)) AS INTEGER) AS risk_digit FROM raw)
)"""

_MART = _STG + """,
historic AS (
  SELECT *,
    count(*) OVER (PARTITION BY facility_type) AS type_rows,
    count(*) OVER licence AS visits,
    count(*) FILTER (results = 'Fail') OVER licence AS visits_failed,
    count(*) FILTER (starts_with(results, 'Pass')) OVER licence AS visits_passed,
    lag(inspection_date) OVER (PARTITION BY license_number ORDER BY inspection_date NULLS LAST, inspection_id)
      AS visited_before
  FROM stg WHERE NOT flag_out_of_jurisdiction
  WINDOW licence AS (PARTITION BY license_number)
),
mart AS (
  SELECT
    inspection_id, license_number, dba_name, aka_name,
    if(facility_type IS NULL, 'UNKNOWN', if(type_rows >= 10, facility_type, 'OTHER')) AS facility_type_grouped,
    facility_type AS facility_type_original,
    risk_level, risk_rank, address, city, zip, latitude, longitude, inspection_date,
    CAST(year(inspection_date) AS INTEGER) AS inspection_year,
    CAST(month(inspection_date) AS INTEGER) AS inspection_month,
    CAST(quarter(inspection_date) AS INTEGER) AS inspection_quarter,
    strftime(inspection_date, '%Y-%m') AS inspection_year_month,
    inspection_type, results,
    CAST(coalesce(starts_with(results, 'Pass'), false) AS INTEGER) AS pass_flag,
    CAST(coalesce(results = 'Fail', false) AS INTEGER) AS fail_flag,
    violation_count, violations_raw,
    if(license_number IS NULL, 1, visits) AS license_total_inspections,
    if(license_number IS NULL, 0, visits_failed) AS license_total_fails,
    if(license_number IS NULL, 0, visits_passed) AS license_total_passes,
    license_number IS NOT NULL AND visits_failed >= 2 AS repeat_fail_flag,
    if(license_number IS NULL, NULL, CAST(inspection_date - visited_before AS INTEGER))
      AS days_since_previous_inspection,
    flag_fail_without_violations, flag_invalid_risk, flag_missing_license, ingested_at
  FROM historic
)"""

_EDA = _MART + """,
eda AS (SELECT * FROM mart WHERE inspection_year >= 2015)"""

_MODEL = _EDA + """,
modelled AS (
  SELECT inspection_id, inspection_date, facility_type_grouped, risk_level, risk_rank, inspection_type,
         results, violation_count, inspection_year, inspection_month, inspection_quarter,
         license_total_inspections, license_total_fails, repeat_fail_flag,
         days_since_previous_inspection, pass_flag AS label
  FROM eda WHERE pass_flag + fail_flag = 1
)"""

_FILLED = _MODEL + """,
filled AS (
  SELECT * REPLACE (
    coalesce(inspection_type, 'UNKNOWN') AS inspection_type,
    coalesce(risk_rank, 0) AS risk_rank,
    coalesce(days_since_previous_inspection, -1) AS days_since_previous_inspection,
    CAST(repeat_fail_flag AS INTEGER) AS repeat_fail_flag)
  FROM modelled
),
cells AS (UNPIVOT (SELECT facility_type_grouped, risk_level, inspection_type FROM filled)
          ON facility_type_grouped, risk_level, inspection_type INTO NAME column_name VALUE value),
codes AS (
  SELECT column_name, value,
         CAST(row_number() OVER (PARTITION BY column_name ORDER BY value) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT column_name, value FROM cells)
)"""

_SCORED = _MODEL + """,
points AS (
  SELECT -violation_count AS score, sum(label) AS pos, sum(1 - label) AS neg FROM modelled GROUP BY ALL
),
ranked AS (
  SELECT *,
    coalesce(sum(pos) OVER lower_scores, 0) AS pos_below, coalesce(sum(neg) OVER lower_scores, 0) AS neg_below,
    sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM points
  WINDOW lower_scores AS (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)"""

_PREDICTED = _MODEL + """,
predicted AS (SELECT label, CAST(violation_count < 2 AS INTEGER) AS prediction FROM modelled)"""


def _suite(source: str, null_columns: list[str], domains: dict[str, tuple], id_column: str = "inspection_id") -> str:
    parts = [
        f"SELECT 'not_null' AS test, '{c}' AS column_name, count(*) - count({c}) AS failures FROM {source}"
        for c in null_columns
    ]
    parts.append(
        f"SELECT 'unique', '{id_column}', count(*) FROM"
        f" (SELECT {id_column} FROM {source} GROUP BY ALL HAVING count({id_column}) > 1)"
    )
    for c, values in domains.items():
        listed = ", ".join(repr(v) for v in values)
        parts.append(
            f"SELECT 'accepted_values', '{c}', count(DISTINCT {c}) FROM {source} WHERE {c} NOT IN ({listed})"
        )
    return f"SELECT *, failures = 0 AS passed FROM ({' UNION ALL '.join(parts)})"


def _profile(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls,"
        f" CAST(count(*) - count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100 AS null_pct,"
        f" count(DISTINCT {c}) AS distinct_values"
        f" FROM {source}"
        for c in columns
    )


def _pct(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100"


def _variants(column: str) -> str:
    return f"""
SELECT regexp_replace(upper({column}), '[^A-Z0-9]', '', 'g') AS normal_form,
       count(*) AS spellings, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n) - max(n) AS BIGINT) AS affected_rows
FROM (SELECT {column}, count(*) AS n FROM raw WHERE regexp_matches(upper({column}), '[A-Z0-9]') GROUP BY ALL)
GROUP BY normal_form HAVING count(*) > 1"""


_RAW_COLUMNS = """inspection_id, dba_name, aka_name, license_number, facility_type, risk, address, city, state,
zip, inspection_date, inspection_type, results, violations, latitude, longitude"""

STAGING_COLUMNS = [
    "inspection_id", "license_number", "dba_name", "aka_name", "facility_type", "risk_level", "risk_rank",
    "address", "city", "state", "zip", "inspection_date", "inspection_type", "results", "violations_raw",
    "violation_count", "latitude", "longitude", "ingested_at", "flag_out_of_jurisdiction",
    "flag_fail_without_violations", "flag_invalid_risk", "flag_missing_license",
]
_RESULTS = (
    "Pass", "Fail", "Pass w/ Conditions", "Out of Business", "No Entry", "Not Ready", "Business Not Located",
)
_LEVELS = ("HIGH", "MEDIUM", "LOW", "UNKNOWN")
_STAGING_SUITE = (
    ["inspection_id", "inspection_date", "results", "violation_count", "flag_out_of_jurisdiction",
     "flag_fail_without_violations", "flag_invalid_risk", "flag_missing_license"],
    {"results": _RESULTS, "risk_level": _LEVELS},
)
_MART_SUITE = (
    ["inspection_id", "inspection_date", "results", "pass_flag", "fail_flag", "violation_count",
     "repeat_fail_flag", "inspection_year", "facility_type_grouped"],
    {"pass_flag": (0, 1), "fail_flag": (0, 1), "risk_level": _LEVELS},
)

_TREND = f"""
SELECT inspection_year, count(inspection_id) AS total, CAST(sum(pass_flag) AS BIGINT) AS passes,
       CAST(sum(fail_flag) AS BIGINT) AS fails,
       {_pct('sum(pass_flag)', 'count(inspection_id)')} AS pass_rate,
       {_pct('sum(fail_flag)', 'count(inspection_id)')} AS fail_rate
FROM eda WHERE inspection_year IS NOT NULL GROUP BY inspection_year"""

_TYPE_RATES = f"""
SELECT facility_type_grouped, count(inspection_id) AS total, CAST(sum(fail_flag) AS BIGINT) AS fails,
       {_pct('sum(fail_flag)', 'count(inspection_id)')} AS fail_rate
FROM {{source}} GROUP BY facility_type_grouped"""

_FLAGS = ["flag_fail_without_violations", "flag_missing_license", "repeat_fail_flag"]

_REPORT = """
, cell AS (
  SELECT CAST(count(*) FILTER (label = 0 AND prediction = 0) AS DOUBLE) AS a,
         CAST(count(*) FILTER (label = 0 AND prediction = 1) AS DOUBLE) AS b,
         CAST(count(*) FILTER (label = 1 AND prediction = 0) AS DOUBLE) AS c,
         CAST(count(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS d
  FROM predicted
),
classes AS (
  SELECT a / (a + c) AS p0, a / (a + b) AS r0, 2 * a / (a + b + (a + c)) AS f0, a + b AS s0,
         d / (b + d) AS p1, d / (c + d) AS r1, 2 * d / (c + d + (b + d)) AS f1, c + d AS s1,
         (a + d) / (a + b + (c + d)) AS acc
  FROM cell
)
SELECT "row", precision, recall, f1, CAST(support AS BIGINT) AS support FROM (
  SELECT 'Fail' AS "row", p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM classes
  UNION ALL SELECT 'Compliant', p1, r1, f1, s1 FROM classes
  UNION ALL SELECT 'accuracy', acc, acc, acc, s0 + s1 FROM classes
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM classes
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
                   (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 FROM classes)"""

_FOLDS = """
, training AS (SELECT inspection_id, inspection_date, label FROM modelled WHERE inspection_year <= 2023),
class_order AS (
  SELECT label, row_number() OVER (ORDER BY first_row) AS seen
  FROM (SELECT label, min(row(inspection_date, inspection_id)) AS first_row FROM training GROUP BY label)
),
in_order AS (
  SELECT inspection_id, label,
         row_number() OVER (PARTITION BY label ORDER BY inspection_date, inspection_id) - 1 AS position,
         row_number() OVER (ORDER BY seen, inspection_date, inspection_id) - 1 AS place
  FROM training JOIN class_order USING (label)
),
ends AS (
  SELECT label, fold, sum(taken) OVER (PARTITION BY label ORDER BY fold) AS fold_end
  FROM (SELECT label, place % 5 AS fold, count(*) AS taken FROM in_order GROUP BY ALL)
)
SELECT inspection_id, label, CAST(min(fold) AS INTEGER) AS fold
FROM in_order JOIN ends USING (label) WHERE position < fold_end GROUP BY inspection_id, label"""


_ENCODED = (
    "f.code AS facility_type_enc", "risk_rank", "r.code AS risk_level_enc", "i.code AS inspection_type_enc",
    "violation_count", "inspection_year", "inspection_month", "inspection_quarter", "license_total_inspections",
    "license_total_fails", "repeat_fail_flag", "days_since_previous_inspection",
)
_FROM_CODES = (
    " FROM filled JOIN codes f ON f.column_name = 'facility_type_grouped' AND f.value = facility_type_grouped"
    " JOIN codes r ON r.column_name = 'risk_level' AND r.value = risk_level"
    " JOIN codes i ON i.column_name = 'inspection_type' AND i.value = inspection_type"
)


_SKETCHED = [
    "inspection_id", "license_number", "dba_name", "aka_name", "facility_type_grouped", "facility_type_original",
    "risk_level", "risk_rank", "address", "city", "zip", "latitude", "longitude", "inspection_date", "inspection_month",
    "inspection_quarter", "inspection_year_month", "inspection_type", "results", "pass_flag", "fail_flag",
    "violation_count", "violations_raw", "license_total_inspections", "license_total_fails", "license_total_passes",
    "repeat_fail_flag", "days_since_previous_inspection", "flag_fail_without_violations", "flag_invalid_risk",
    "flag_missing_license",
]


def _collated(column: str) -> str:
    return f"""
SELECT min(form) AS form, count(*) AS spellings, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n) - max(n) AS BIGINT) AS affected_rows
FROM (SELECT upper(regexp_replace({column}, '[^\\p{{L}}\\p{{M}}\\p{{N}}]', '', 'g')) AS form, count(*) AS n
      FROM raw WHERE {column} IS NOT NULL GROUP BY {column})
WHERE form <> '' GROUP BY lower(strip_accents(form)) HAVING count(*) > 1"""


def _boosted(features: list[str], rounds: int, bins: int, rate: float) -> str:
    """Trees of depth 2 by joins and sums over (row, feature) cells; one block of steps for each level of each tree."""
    cells = " UNION ALL ".join(
        f"SELECT inspection_id AS id, {k} AS f, CAST({c} AS DOUBLE) AS v FROM weighted" for k, c in enumerate(features)
    )
    steps = [
        "weighted AS (SELECT *, if(label = 0, CAST(1 AS DOUBLE), CAST(sum(1 - label) OVER () AS DOUBLE)"
        " / CAST(sum(label) OVER () AS DOUBLE)) AS w FROM modelled WHERE inspection_year <= 2023)",
        f"cells AS ({cells})",
        "valued AS (SELECT f, v, count(*) AS n FROM cells WHERE v IS NOT NULL GROUP BY f, v)",
        "ranked_values AS (SELECT f, v, n, sum(n) OVER (PARTITION BY f ORDER BY v) AS upto,"
        " sum(n) OVER (PARTITION BY f) AS total, count(*) OVER (PARTITION BY f) AS many FROM valued)",
        f"cuts AS (SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) - 1 AS b FROM ranked_values"
        f" WHERE many <= {bins} OR upto * {bins} // total > (upto - n) * {bins} // total)",
        "binned AS (SELECT id, f, v IS NULL AS lost, (SELECT count(*) FROM cuts c WHERE c.f = x.f AND c.v < x.v) AS b FROM cells x)",
        "m0 AS (SELECT inspection_id AS id, CAST(0 AS DOUBLE) AS m FROM weighted)",
    ]
    for t in range(rounds):
        steps += [
            f"g{t} AS (SELECT id, CAST(round_even(w * (p - label) * 1073741824, 0) AS HUGEINT) AS g,"
            f" CAST(round_even(w * p * (1 - p) * 1073741824, 0) AS HUGEINT) AS h"
            f" FROM (SELECT id, w, label, 1 / (1 + exp(-m)) AS p FROM m{t} JOIN weighted ON id = inspection_id))",
            f"at{t}_0 AS (SELECT id, 1 AS node FROM g{t})",
        ]
        for level in range(2):
            here = f"{t}_{level}"
            steps += [
                f"sum{here} AS (SELECT node, CAST(sum(g) AS DOUBLE) / 1073741824 AS g, CAST(sum(h) AS DOUBLE) / 1073741824 AS h"
                f" FROM at{here} JOIN g{t} USING (id) WHERE node >= {1 << level} GROUP BY node)",
                f"hist{here} AS (SELECT node, f, lost, b, sum(g) AS g, sum(h) AS h"
                f" FROM at{here} JOIN g{t} USING (id) JOIN binned USING (id) WHERE node >= {1 << level} GROUP BY ALL)",
                f"left{here} AS (SELECT s.node, c.f, c.b, c.v, side.ml,"
                f" coalesce(CAST(sum(x.g) AS DOUBLE), 0) / 1073741824 AS gl, coalesce(CAST(sum(x.h) AS DOUBLE), 0) / 1073741824 AS hl,"
                f" any_value(s.g) AS g, any_value(s.h) AS h"
                f" FROM sum{here} s JOIN cuts c ON true JOIN (VALUES (true), (false)) side(ml) ON true"
                f" LEFT JOIN hist{here} x ON x.node = s.node AND x.f = c.f AND if(x.lost, side.ml, x.b <= c.b) GROUP BY ALL)",
                f"gain{here} AS (SELECT node, f, b, v, ml, (gl * gl) / (hl + 1.0::DOUBLE) + ((g - gl) * (g - gl)) / ((h - hl) + 1.0::DOUBLE)"
                f" - (g * g) / (h + 1.0::DOUBLE) AS gain FROM left{here} WHERE hl >= 1 AND h - hl >= 1)",
                f"best{here} AS (SELECT * FROM gain{here} WHERE gain > 1e-6::DOUBLE"
                f" QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, b, ml DESC) = 1)",
                f"at{t}_{level + 1} AS (SELECT a.id, if(s.node IS NULL, a.node,"
                f" 2 * a.node + if(if(x.lost, s.ml, x.b <= s.b), 0, 1)) AS node"
                f" FROM at{here} a LEFT JOIN best{here} s USING (node) LEFT JOIN binned x ON x.id = a.id AND x.f = s.f)",
            ]
        steps += [
            f"leaf{t} AS (SELECT node, -(CAST(sum(g) AS DOUBLE) / 1073741824) / (CAST(sum(h) AS DOUBLE) / 1073741824 + 1.0::DOUBLE)"
            f" * {rate}::DOUBLE AS value FROM at{t}_2 JOIN g{t} USING (id) GROUP BY node)",
            f"m{t + 1} AS (SELECT id, m + value AS m FROM m{t} JOIN at{t}_2 USING (id) JOIN leaf{t} USING (node))",
        ]
    names = "[" + ", ".join(f"'{c}'" for c in features) + "]"
    nodes = []
    for t in range(rounds):
        # A node's sums are those of the rows below it.
        for level in range(3):
            up = 2 - level
            inside = f"SELECT id, node >> if(node >= 4, {up}, if(node >= 2, {max(up - 1, 0)}, 0)) AS node FROM at{t}_2"
            best = f"best{t}_{level}" if level < 2 else f"(SELECT * FROM best{t}_0 WHERE false)"
            nodes.append(
                f"SELECT {t} AS tree, node, {names}[f + 1] AS feature, v AS cut, ml AS missing_left, gradient, hessian FROM"
                f" (SELECT node, CAST(sum(g) AS BIGINT) AS gradient, CAST(sum(h) AS BIGINT) AS hessian FROM ({inside})"
                f" JOIN g{t} USING (id) WHERE node >= {1 << level} AND node < {2 << level} GROUP BY node) LEFT JOIN {best} USING (node)"
            )
    return ",\n" + ",\n".join(steps) + "\n" + " UNION ALL ".join(nodes)


def _q(layers: str, body: str) -> str:
    return f"WITH {layers.strip()}\n{body.strip()}"


def oracle_sql() -> dict[str, str]:
    found = _oracle_sql()
    same = {"bucketed_previous": "previous_inspection", "bucketed_history_asof": "license_history_asof"}
    return found | {name: found[like] for name, like in same.items()}


def _oracle_sql() -> dict[str, str]:
    in_staging = "FROM stg WHERE NOT flag_out_of_jurisdiction"
    return {
        "raw_inspections": _q(_RAW, "SELECT * FROM raw"),
        "null_tokens": _q(
            _RAW,
            "SELECT inspection_id, if(k5 = 0, NULL, dba_name) AS dba_name,"
            " if(priority_missing, NULL, aka_name) AS aka_name"
            " FROM (SELECT *, inspection_id % 5 AS k5, risk IS NULL OR risk = 'All' AS priority_missing FROM raw)",
        ),
        "stg_inspections": _q(_STG, "SELECT * FROM stg"),
        "quality_flags": _q(
            _STG,
            "SELECT flag_out_of_jurisdiction, flag_fail_without_violations, flag_invalid_risk,"
            " flag_missing_license, count(*) AS rows FROM stg GROUP BY ALL",
        ),
        "risk_parse": _q(
            _STG,
            "SELECT raw.risk, risk_level, risk_rank, flag_invalid_risk, count(*) AS rows"
            " FROM stg JOIN raw USING (inspection_id) GROUP BY ALL",
        ),
        "violation_count": _q(
            _STG, "SELECT violation_count, count(*) AS rows, count(violations_raw) AS with_text FROM stg GROUP BY ALL"
        ),
        "facility_type_counts": _q(
            _STG, f"SELECT facility_type, count(*) AS type_count {in_staging} GROUP BY facility_type"
        ),
        "facility_grouping": _q(
            _MART, "SELECT facility_type_grouped, facility_type_original, count(*) AS rows FROM mart GROUP BY ALL"
        ),
        "license_history": _q(
            _STG,
            "SELECT license_number, count(*) FILTER (results = 'Fail') AS total_fails,"
            " count(*) FILTER (starts_with(results, 'Pass')) AS total_passes, count(*) AS total_inspections"
            f" {in_staging} AND license_number IS NOT NULL GROUP BY license_number",
        ),
        "previous_inspection": _q(
            _MART,
            "SELECT inspection_id, license_number, inspection_date, visited_before AS previous_inspection_date"
            " FROM historic WHERE license_number IS NOT NULL",
        ),
        "days_since_previous": _q(
            _MART,
            "SELECT days_since_previous_inspection, count(*) AS rows FROM mart GROUP BY ALL",
        ),
        "mart_inspections": _q(_MART, "SELECT * FROM mart"),
        "row_counts": _q(
            _MART,
            "SELECT 'raw' AS table_name, count(*) AS rows FROM raw"
            " UNION ALL SELECT 'staging', count(*) FROM stg UNION ALL SELECT 'mart', count(*) FROM mart",
        ),
        "explore_scan": _q(
            _EDA,
            "SELECT inspection_id, facility_type_grouped, risk_level, risk_rank, inspection_type, results,"
            " pass_flag, fail_flag, violation_count, inspection_year, inspection_month, inspection_quarter, zip,"
            " license_total_inspections, license_total_fails, repeat_fail_flag, days_since_previous_inspection,"
            " flag_fail_without_violations, flag_missing_license FROM eda",
        ),
        "year_span": _q(
            _EDA, "SELECT min(inspection_year) AS first_year, max(inspection_year) AS last_year FROM eda"
        ),
        "inspection_type_counts": _q(
            _EDA, "SELECT inspection_type, count(*) AS n FROM eda WHERE inspection_type IS NOT NULL GROUP BY ALL"
        ),
        "results_distribution": _q(
            _EDA,
            f"SELECT results, count(*) AS n, {_pct('count(*)', 'sum(count(*)) OVER ()')} AS pct"
            " FROM eda WHERE results IS NOT NULL GROUP BY results",
        ),
        "top_types": _q(
            _EDA,
            "SELECT facility_type_original FROM eda WHERE facility_type_original IS NOT NULL"
            " GROUP BY ALL ORDER BY count(*) DESC, facility_type_original LIMIT 10",
        ),
        "top_type_rows": _q(
            _EDA,
            "SELECT inspection_id, facility_type_original FROM eda WHERE facility_type_original IN"
            " (SELECT facility_type_original FROM eda WHERE facility_type_original IS NOT NULL"
            "  GROUP BY ALL ORDER BY count(*) DESC, facility_type_original LIMIT 10)",
        ),
        "fail_rate_top_types": _q(
            _EDA,
            f"{_TYPE_RATES.format(source='eda')} ORDER BY count(*) DESC, facility_type_grouped LIMIT 10",
        ),
        "fail_rate_all_types": _q(_MART, _TYPE_RATES.format(source="mart")),
        "yearly_trend": _q(_EDA, _TREND),
        "yearly_trend_rounded": _q(
            _EDA,
            "SELECT inspection_year, total, round_even(pass_rate, 2) AS pass_rate,"
            f" round_even(fail_rate, 2) AS fail_rate FROM ({_TREND})",
        ),
        "violations_by_risk": _q(
            _EDA,
            "SELECT risk_level, CAST(sum(violation_count) AS DOUBLE) / CAST(count(violation_count) AS DOUBLE)"
            " AS avg_violations, CAST(median(violation_count) AS DOUBLE) AS median_violations,"
            " count(inspection_id) AS total FROM eda WHERE risk_level <> 'UNKNOWN' GROUP BY risk_level",
        ),
        "flag_summary": _q(
            _EDA,
            " UNION ALL ".join(
                f"SELECT '{f}' AS flag, count(*) FILTER ({f}) AS set_rows,"
                f" {_pct(f'count(*) FILTER ({f})', 'count(*)')} AS pct FROM eda"
                for f in _FLAGS
            ),
        ),
        "dq_staging_suite": _q(_STG, _suite("stg", *_STAGING_SUITE)),
        "dq_mart_suite": _q(_MART, _suite("mart", *_MART_SUITE)),
        "dq_duplicates_injected": _q(
            _STG
            + """,
spoiled AS (
  SELECT * REPLACE (
    if(results = 'No Entry', 'Closed', results) AS results,
    if(flag_invalid_risk, 'ALL', risk_level) AS risk_level,
    if(flag_missing_license, NULL, inspection_date) AS inspection_date)
  FROM (SELECT * FROM stg UNION ALL SELECT * FROM stg WHERE results = 'Not Ready')
)""",
            _suite("spoiled", *_STAGING_SUITE),
        ),
        "column_profile": _q(_STG, _profile("stg", STAGING_COLUMNS)),
        "domain_violations": _q(
            _RAW,
            "SELECT 'risk' AS column_name, risk AS value, count(*) AS rows FROM raw"
            " WHERE risk NOT IN ('Risk 1 (High)', 'Risk 2 (Medium)', 'Risk 3 (Low)') GROUP BY risk"
            " UNION ALL SELECT 'state', state, count(*) FROM raw WHERE state <> 'IL' GROUP BY state"
            " UNION ALL SELECT 'city', city, count(*) FROM raw WHERE city <> 'CHICAGO' GROUP BY city",
        ),
        "name_variants": _q(_RAW, _variants("dba_name")),
        "city_variants": _q(_RAW, _variants("city")),
        "collated_name_variants": _q(_RAW, _collated("dba_name")),
        "collated_city_variants": _q(_RAW, _collated("city")),
        "sketched_profile": _q(
            _MART,
            "SELECT column_name, nulls, null_pct, true AS close FROM ("
            + _profile("(SELECT * EXCLUDE (inspection_year, ingested_at) FROM mart WHERE inspection_year <= 2019)", _SKETCHED)
            + ")",
        ),
        "point_lookup": _q(_STG, "SELECT * FROM stg WHERE NOT flag_out_of_jurisdiction AND license_number = '37'"),
        "reload_digests": _q(
            _STG,
            "SELECT results, count(*) AS rows, true AS same_after_reload,"
            " coalesce(results = 'Fail', false) AND count(zip) > 0 AS changed FROM stg GROUP BY results",
        ),
        "roc_corners": _q(
            _SCORED,
            "SELECT CAST(score AS DOUBLE) AS threshold, CAST(n - neg_below AS DOUBLE) / CAST(n AS DOUBLE) AS fpr,"
            " CAST(p - pos_below AS DOUBLE) / CAST(p AS DOUBLE) AS tpr FROM (SELECT *,"
            " lead(if(pos = 0, 'right', if(neg = 0, 'up', NULL))) OVER (ORDER BY score DESC) AS after,"
            " if(pos = 0, 'right', if(neg = 0, 'up', NULL)) AS kind FROM ranked)"
            " WHERE kind IS NULL OR after IS NULL OR kind <> after"
            " UNION ALL SELECT CAST('Infinity' AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)",
        ),
        "kpis": _q(
            _MART,
            "SELECT count(*) AS inspections, CAST(sum(pass_flag) AS BIGINT) AS passes,"
            " CAST(sum(fail_flag) AS BIGINT) AS fails,"
            " count(*) FILTER (repeat_fail_flag) AS repeat_fail_inspections,"
            f" {_pct('sum(pass_flag)', 'count(*)')} AS compliance_rate,"
            f" {_pct('sum(fail_flag)', 'count(*)')} AS fail_rate,"
            f" {_pct('count(*) FILTER (repeat_fail_flag)', 'count(*)')} AS repeat_fail_share FROM mart",
        ),
        "calendar": _q(
            _MART,
            "SELECT day, CAST(year(day) AS INTEGER) AS year, CAST(quarter(day) AS INTEGER) AS quarter,"
            " CAST(month(day) AS INTEGER) AS month, CAST(day(day) AS INTEGER) AS day_of_month,"
            " strftime(day, '%Y-%m') AS year_month FROM (SELECT CAST(unnest(generate_series("
            "min(inspection_date), max(inspection_date), INTERVAL 1 DAY)) AS DATE) AS day FROM mart)",
        ),
        "exclusion_audit": _q(
            _STG,
            "SELECT count(*) AS rows_in, count(*) FILTER (flag_out_of_jurisdiction) AS rows_excluded,"
            " count(*) FILTER (NOT flag_out_of_jurisdiction) AS rows_kept,"
            " 'flag_out_of_jurisdiction' AS criterion FROM stg",
        ),
        "license_history_asof": _q(
            _STG,
            "SELECT inspection_id, license_number, inspection_date,"
            " if(license_number IS NULL, 0, count(*) OVER earlier) AS prior_inspections,"
            " if(license_number IS NULL, 0, count(*) FILTER (results = 'Fail') OVER earlier) AS prior_fails,"
            " if(license_number IS NULL, 0, count(*) FILTER (starts_with(results, 'Pass')) OVER earlier)"
            f" AS prior_passes {in_staging}"
            " WINDOW earlier AS (PARTITION BY license_number ORDER BY inspection_date NULLS LAST, inspection_id"
            " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
        ),
        "modelling_set": _q(_MODEL, "SELECT * FROM modelled"),
        "modelling_set_asof": _q(
            _MODEL,
            "SELECT * EXCLUDE (seen, seen_failed) REPLACE (coalesce(seen, 0) AS license_total_inspections,"
            " CAST(coalesce(seen_failed, 0) AS BIGINT) AS license_total_fails,"
            " coalesce(seen_failed, 0) > 1 AS repeat_fail_flag)"
            " FROM modelled LEFT JOIN (SELECT inspection_id, count(*) OVER earlier AS seen,"
            "  sum(fail_flag) OVER earlier AS seen_failed FROM mart WHERE license_number IS NOT NULL"
            "  WINDOW earlier AS (PARTITION BY license_number ORDER BY inspection_date NULLS LAST, inspection_id"
            "  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) USING (inspection_id)",
        ),
        "label_codes": _q(_FILLED, "SELECT * FROM codes"),
        "encoded_features": _q(_FILLED, f"SELECT inspection_id, label, {', '.join(_ENCODED)}{_FROM_CODES}"),
        "temporal_split_counts": _q(
            _MODEL,
            "SELECT if(inspection_year > 2023, 'test', 'train') AS part, count(*) AS rows,"
            " CAST(sum(label) AS BIGINT) AS positives FROM modelled GROUP BY ALL",
        ),
        "class_weight": _q(
            _MODEL,
            "SELECT sum(1 - label)::BIGINT AS negatives, sum(label)::BIGINT AS positives,"
            " CAST(sum(label) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100 AS positive_pct,"
            " CAST(sum(1 - label) AS DOUBLE) / CAST(sum(label) AS DOUBLE) AS positive_weight"
            " FROM modelled WHERE inspection_year <= 2023",
        ),
        "weighted_rows": _q(
            _MODEL,
            "SELECT inspection_id, label, if(label = 0, CAST(1 AS DOUBLE), CAST(sum(1 - label) OVER () AS DOUBLE)"
            " / CAST(sum(label) OVER () AS DOUBLE)) AS weight FROM modelled WHERE inspection_year <= 2023",
        ),
        "stratified_folds": _q(_MODEL, _FOLDS.lstrip()),
        "roc_auc_exact": _q(
            _SCORED,
            "SELECT CAST(any_value(p) AS BIGINT) AS positives, CAST(any_value(n) AS BIGINT) AS negatives,"
            " CAST(sum(pos * (2 * neg_below + neg)) AS DOUBLE)"
            " / (2 * CAST(any_value(p) AS DOUBLE) * CAST(any_value(n) AS DOUBLE)) AS roc_auc FROM ranked",
        ),
        "roc_points": _q(
            _SCORED,
            "SELECT CAST(score AS DOUBLE) AS threshold,"
            " CAST(n - neg_below AS DOUBLE) / CAST(n AS DOUBLE) AS fpr,"
            " CAST(p - pos_below AS DOUBLE) / CAST(p AS DOUBLE) AS tpr FROM ranked"
            " UNION ALL SELECT CAST('Infinity' AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)",
        ),
        "confusion": _q(
            _PREDICTED,
            "SELECT label, count(*) FILTER (prediction = 0) AS predicted_0,"
            " count(*) FILTER (prediction = 1) AS predicted_1 FROM predicted GROUP BY label",
        ),
        "classification_report": _q(_PREDICTED, _REPORT.lstrip()),
        "csv_roundtrip": _q(
            _RAW,
            f"SELECT {_RAW_COLUMNS}, '(\"' || latitude || '\",' || chr(10) || longitude || ')' AS location,"
            " ingested_at FROM raw",
        ),
        "csv_split": _q(
            _RAW,
            f"SELECT {_RAW_COLUMNS}, '(\"' || latitude || '\",' || chr(10) || longitude || ')' AS location,"
            " ingested_at FROM raw",
        ),
        "csv_bad_records": _q(
            _RAW,
            "SELECT coalesce(reject_reason, 'none') AS reject_reason, count(*) AS rows FROM (SELECT CASE results"
            " WHEN 'Not Ready' THEN 'too many fields' WHEN 'Business Not Located' THEN"
            " 'inspection_id is not a number' END AS reject_reason FROM raw) GROUP BY ALL",
        ),
        "csv_skip": _q(
            _RAW,
            "SELECT count(*) FILTER (good) AS landed, count(*) FILTER (good) AS loaded,"
            " count(*) FILTER (NOT good) AS rejected, CAST(0 AS BIGINT) AS set_aside"
            " FROM (SELECT results NOT IN ('Not Ready', 'Business Not Located') AS good FROM raw)",
        ),
        "table_roundtrip": _q(_MART, "SELECT * FROM mart"),
        "table_year_scan": _q(_MART, "SELECT * FROM mart WHERE inspection_year >= 2015"),
        "daily_job": _q(
            _MART,
            "SELECT (SELECT count(*) FROM raw) AS loaded, CAST(0 AS BIGINT) AS rejected,"
            " CAST(24 AS BIGINT) AS tests_passed, count(*) AS mart_rows,"
            " (SELECT count(*) > 0 FROM raw WHERE results = 'Not Ready') AS spoiled_stopped,"
            " true AS first_still_published FROM mart",
        ),
        "staging_view": _q(_STG, "SELECT * FROM stg"),
        "features_vector": _q(
            _FILLED,
            "SELECT inspection_id, "
            + ", ".join(f"CAST({c.split(' AS ')[0]} AS DOUBLE) AS {c.split(' AS ')[-1]}" for c in _ENCODED)
            + _FROM_CODES,
        ),
        "gbt_scores_checked": _q(
            _MODEL,
            "SELECT inspection_id, label, true AS is_probability, true AS agrees"
            " FROM modelled WHERE inspection_year > 2023 OR inspection_year IS NULL",
        ),
        "gbt_importances_checked": "SELECT CAST(12 AS BIGINT) AS features, true AS none_negative,"
        " true AS sum_is_one, true AS largest_first",
        "model_roundtrip": _q(
            _MODEL,
            "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS different"
            " FROM modelled WHERE inspection_year > 2023 OR inspection_year IS NULL",
        ),
        "boosted_scores_checked": _q(
            _MODEL,
            "SELECT inspection_id, label, true AS is_probability, true AS agrees"
            " FROM modelled WHERE inspection_year > 2023 OR inspection_year IS NULL",
        ),
        "boosted_nodes": "WITH "
        + _MODEL.strip()
        + _boosted(
            ["violation_count", "inspection_month", "license_total_fails", "days_since_previous_inspection"], 2, 16, 0.3
        ),
        "cv_checked": _q(
            _MODEL,
            _FOLDS.lstrip().replace(
                "SELECT inspection_id, label, CAST(min(fold) AS INTEGER) AS fold\nFROM", ", folded AS (SELECT inspection_id, label, CAST(min(fold) AS INTEGER) AS fold\nFROM"
            )
            + ") SELECT fold, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives, true AS auc_in_range,"
            " true AS mean_agrees, true AS std_agrees FROM folded GROUP BY fold",
        ),
    }
