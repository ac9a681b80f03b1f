"""The registered queries once more, as SQL over the same tables for DuckDB.

Written in the plain form of each query: joins before counts, distinct over whole
rows, key counts as count minus distinct count.
"""

from __future__ import annotations

STAR = """
WITH joined AS (
  SELECT *, CAST(o_orderdate AS DATE) AS arr_day,
         date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS day_no
  FROM orders JOIN customer ON o_custkey = c_custkey
),
once AS (
  SELECT
    o_orderkey,
    CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderkey AS DOUBLE) END
      + CASE WHEN o_orderkey % 101 = 0 THEN 0.5 ELSE 0.0 END AS admnum,
    CAST(year(arr_day) AS DOUBLE) AS i94yr,
    CAST(month(arr_day) AS DOUBLE) AS i94mon,
    CAST(c_nationkey AS DOUBLE) AS i94cit,
    CASE WHEN o_orderkey % 71 <> 0 THEN 'S' || CAST(o_custkey % 8 AS VARCHAR) END AS i94addr,
    CASE WHEN o_orderkey % 73 <> 0 THEN 'P' || CAST(o_orderkey % 30 AS VARCHAR) END AS i94port,
    CASE WHEN o_orderkey % 53 <> 0 THEN CAST(day_no AS DOUBLE) END AS arrdate,
    CASE WHEN o_orderkey % 11 <> 0 THEN CAST(day_no + o_orderkey % 90 AS DOUBLE) END AS depdate,
    CASE WHEN o_orderkey % 67 <> 0 THEN CAST(o_orderkey % 5 AS DOUBLE) END AS i94mode,
    CASE WHEN o_orderkey % 89 = 0 THEN CAST('NaN' AS DOUBLE)
         WHEN o_orderkey % 13 <> 0 THEN CAST(o_custkey % 80 AS DOUBLE) END AS i94bir,
    CASE WHEN o_orderkey % 79 = 0 THEN CAST(1e12 AS DOUBLE) WHEN o_orderkey % 13 <> 0
         THEN CAST(year(arr_day) - o_custkey % 80 AS DOUBLE) END AS biryear,
    CAST(1 + o_orderkey % 4 AS DOUBLE) AS i94visa,
    CASE WHEN o_orderkey % 7 <> 0 THEN 'V' || substr(o_orderpriority, 1, 1) END AS visatype,
    CASE WHEN o_orderkey % 3 <> 0 THEN c_mktsegment END AS dtaddto,
    CASE WHEN o_orderkey % 6 <> 0 THEN o_orderstatus END AS gender
  FROM joined
),
raw AS (
  SELECT * EXCLUDE (o_orderkey) FROM once
  UNION ALL
  SELECT * EXCLUDE (o_orderkey) FROM once WHERE o_orderkey % 50 = 0
),
port AS (
  SELECT 'P' || CAST(n_nationkey AS VARCHAR) AS port_code, n_name AS port_city,
         'S' || CAST(n_regionkey AS VARCHAR) AS port_state_code
  FROM nation
),
destination AS (
  SELECT 'S' || CAST(r_regionkey AS VARCHAR) AS known_state, r_name AS dest_state_name FROM region
),
origin AS (
  SELECT CASE WHEN n_nationkey >= 20 THEN 'N' ELSE '' END || CAST(n_nationkey AS VARCHAR) AS origin_code,
         'C_' || n_name AS origin_country
  FROM nation
),
typed AS (
  SELECT DISTINCT
    CAST(trunc(admnum) AS BIGINT) AS admnum, CAST(trunc(i94yr) AS INTEGER) AS i94yr,
    CAST(trunc(i94mon) AS INTEGER) AS i94mon, CAST(trunc(i94cit) AS INTEGER) AS i94cit,
    i94addr, i94port,
    CAST(trunc(arrdate) AS INTEGER) AS arrdate, CAST(trunc(depdate) AS INTEGER) AS depdate,
    CAST(trunc(i94mode) AS INTEGER) AS i94mode,
    CASE WHEN isfinite(i94bir) THEN CAST(trunc(i94bir) AS INTEGER) END AS i94bir,
    TRY_CAST(trunc(biryear) AS INTEGER) AS biryear, CAST(trunc(i94visa) AS INTEGER) AS i94visa,
    visatype, dtaddto, gender
  FROM raw
),
identified AS (SELECT * FROM typed WHERE admnum IS NOT NULL),
filled AS (
  SELECT * REPLACE (
    coalesce(i94bir, -1) AS i94bir, coalesce(biryear, -1) AS biryear,
    coalesce(arrdate, 0) AS arrdate, coalesce(depdate, 0) AS depdate,
    coalesce(visatype, 'N/R') AS visatype, coalesce(dtaddto, 'N/R') AS dtaddto,
    coalesce(gender, 'N/R') AS gender)
  FROM identified
),
decoded AS (
  SELECT filled.*,
    coalesce(port_city, 'Other') AS port_city,
    coalesce(port_state_code, 'Other') AS port_state_code,
    coalesce(known_state, 'Other') AS dest_state_code,
    coalesce(dest_state_name, 'Other') AS dest_state_name,
    coalesce(origin_country, 'Other') AS origin_country
  FROM filled
  LEFT JOIN port ON i94port = port_code
  LEFT JOIN destination ON i94addr = known_state
  LEFT JOIN origin ON i94cit = TRY_CAST(origin_code AS INTEGER)
),
visits AS (
  SELECT
    admnum AS admission_id,
    CAST(i94yr * 100 + i94mon AS INTEGER) AS year_month,
    DATE '1960-01-01' + arrdate AS arrival_date,
    DATE '1960-01-01' + depdate AS departure_date,
    i94bir AS visitor_age, biryear AS visitor_birth_year, visatype, gender,
    port_city, port_state_code, dest_state_code, origin_country,
    CASE i94mode WHEN 1 THEN 'Air' WHEN 2 THEN 'Sea' WHEN 3 THEN 'Land' ELSE 'N/R' END
      AS entry_mode,
    CASE i94visa WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure' WHEN 3 THEN 'Student'
                 ELSE 'N/R' END AS visa_category,
    dtaddto AS visa_expire_date,
    CASE WHEN dest_state_code = port_state_code THEN 'Y' ELSE 'N' END AS port_dest_equal_flag
  FROM decoded
),
visitor_analysis AS (
  SELECT admission_id, year_month, arrival_date, dest_state_code, port_city, port_state_code,
         entry_mode, visa_category, origin_country, port_dest_equal_flag
  FROM visits
),
visitors AS (
  SELECT admission_id, year_month, origin_country, dest_state_code, port_city, port_state_code,
         entry_mode, visitor_age, visitor_birth_year, arrival_date, departure_date,
         visa_category, visatype, visa_expire_date, gender
  FROM visits
),
arrival_date AS (
  SELECT DISTINCT arrival_date,
    CAST(year(arrival_date) AS INTEGER) AS "year", CAST(month(arrival_date) AS INTEGER) AS "month",
    CAST(day(arrival_date) AS INTEGER) AS "day",
    CAST(dayofweek(arrival_date) + 1 AS INTEGER) AS weekday,
    CAST(weekofyear(arrival_date) AS INTEGER) AS weeknum
  FROM visits
),
placed AS (
  SELECT n_nationkey AS k, n_name AS city,
         CASE WHEN n_nationkey < 22 THEN 'S' || CAST(n_regionkey AS VARCHAR) ELSE 'Z' END AS state_code,
         r_name AS state, c_mktsegment AS race
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
city AS (
  SELECT k, city, state_code, state, CAST(count(*) AS BIGINT) AS total_population
  FROM placed GROUP BY ALL
),
measured AS (
  SELECT city, state_code, state,
    CAST(30 + CAST(k AS DOUBLE) / 2 AS DOUBLE) AS median_age,
    CAST(total_population // 2 AS BIGINT) AS male_population,
    CAST(total_population - total_population // 2 AS BIGINT) AS female_population,
    total_population,
    CAST(k * 100 AS BIGINT) AS number_of_veterans, CAST(k * 1000 AS BIGINT) AS foreign_born,
    2 + CAST(k % 10 AS DOUBLE) / 10 AS average_household_size
  FROM city
),
state_demographics AS (
  SELECT * REPLACE (
    CAST(CAST(median_age AS DECIMAL(3,1)) AS DOUBLE) AS median_age,
    CAST(CAST(average_household_size AS DECIMAL(4,2)) AS DOUBLE) AS average_household_size)
  FROM measured
),
state_demographics_by_race AS (
  SELECT city, state_code, state, race, CAST(count(*) AS BIGINT) AS "count"
  FROM placed GROUP BY ALL
)
"""

ROW_COUNTS = """
SELECT 'row_count' AS check_name, 'visitor_analysis' AS table_name, '' AS subject,
       CAST(count(*) AS BIGINT) AS value, count(*) > 0 AS passed FROM visitor_analysis
UNION ALL SELECT 'row_count', 'visitors', '', count(*), count(*) > 0 FROM visitors
UNION ALL SELECT 'row_count', 'arrival_date', '', count(*), count(*) > 0 FROM arrival_date
UNION ALL SELECT 'row_count', 'state_demographics', '', count(*), count(*) > 0
          FROM state_demographics
UNION ALL SELECT 'row_count', 'state_demographics_by_race', '', count(*), count(*) > 0
          FROM state_demographics_by_race
"""


def _unique_key(table: str, key: str) -> str:
    surplus = f"count(*) - count(DISTINCT ({key}))"
    return (
        f"SELECT 'unique_key' AS check_name, '{table}' AS table_name, "
        f"'{key.replace(', ', ',')}' AS subject, "
        f"CAST({surplus} AS BIGINT) AS value, {surplus} = 0 AS passed FROM {table}"
    )


def _required(table: str, column: str) -> str:
    nulls = f"count(*) - count({column})"
    return (
        f"SELECT 'required' AS check_name, '{table}' AS table_name, '{column}' AS subject, "
        f"CAST({nulls} AS BIGINT) AS value, {nulls} = 0 AS passed FROM {table}"
    )


UNIQUE_KEYS = " UNION ALL ".join(
    _unique_key(table, key)
    for table, key in (
        ("visitor_analysis", "admission_id, arrival_date"),
        ("visitors", "admission_id, arrival_date"),
        ("arrival_date", "arrival_date"),
        ("state_demographics", "city, state_code"),
        ("state_demographics_by_race", "city, state_code, race"),
    )
)

REQUIRED = " UNION ALL ".join(
    _required(table, column)
    for table, columns in (
        ("visitor_analysis", ("admission_id", "year_month", "arrival_date")),
        ("visitors", ("admission_id", "year_month", "arrival_date")),
        ("arrival_date", ("arrival_date",)),
        ("state_demographics", ("city", "state_code", "total_population")),
        ("state_demographics_by_race", ("city", "state_code", '"count"')),
    )
    for column in columns
).replace("""'"count"'""", "'count'")

FIT = " UNION ALL ".join(
    f"""SELECT 'fit' AS check_name, 'state_demographics' AS table_name, '{column}' AS subject,
        CAST(count(*) FILTER ({bad}) AS BIGINT) AS value, count(*) FILTER ({bad}) = 0 AS passed
        FROM measured"""
    for column, bad in (
        ("city", "length(city) > 256"),
        ("state_code", "length(state_code) > 2"),
        ("state", "length(state) > 256"),
        ("median_age", "abs(median_age) >= 99.95"),
        ("average_household_size", "abs(average_household_size) >= 99.995"),
    )
)

FACT = "SELECT * FROM visitor_analysis"

# Queries over the star; each is put behind the common table expressions above.
OVER_STAR = {
    "arrivals_typed_distinct": "SELECT * FROM typed",
    "arrivals_with_id": "SELECT * FROM identified",
    "arrivals_filled": "SELECT * FROM filled",
    "decode_port": """SELECT admnum, i94port, coalesce(port_city, 'Other') AS port_city,
                             coalesce(port_state_code, 'Other') AS port_state_code
                      FROM filled LEFT JOIN port ON i94port = port_code""",
    "decode_destination": """SELECT admnum, i94addr,
                                    coalesce(known_state, 'Other') AS dest_state_code,
                                    coalesce(dest_state_name, 'Other') AS dest_state_name
                             FROM filled LEFT JOIN destination ON i94addr = known_state""",
    "decode_origin": """SELECT admnum, i94cit, coalesce(origin_country, 'Other') AS origin_country
                        FROM filled
                        LEFT JOIN origin ON i94cit = TRY_CAST(origin_code AS INTEGER)""",
    "derive_dates": """SELECT admnum, DATE '1960-01-01' + arrdate AS arrival_date,
                              DATE '1960-01-01' + depdate AS departure_date FROM filled""",
    "derive_year_month": """SELECT admnum, CAST(i94yr * 100 + i94mon AS INTEGER) AS year_month,
                                   CAST(i94yr AS VARCHAR) || CAST(i94mon AS VARCHAR)
                                     AS year_month_text FROM filled""",
    "derive_categories": "SELECT admission_id, entry_mode, visa_category FROM visits",
    "derive_same_state_flag": """SELECT admission_id, dest_state_code, port_state_code,
                                        port_dest_equal_flag FROM visits""",
    "visits": "SELECT * FROM visits",
    "visit_fact": FACT,
    "visitor_dim": "SELECT * FROM visitors",
    "arrival_date_dim": "SELECT * FROM arrival_date",
    "demographics_flat": """SELECT m.*, r.race, r."count" FROM measured m
                            JOIN state_demographics_by_race r USING (city, state_code)""",
    "demographics_total": "SELECT * FROM state_demographics",
    "demographics_race": "SELECT * FROM state_demographics_by_race",
    "top_ports": """SELECT port_city, count(admission_id) AS visitor_cnt FROM visitor_analysis
                    GROUP BY port_city ORDER BY visitor_cnt DESC, port_city LIMIT 10""",
    "visits_by_month_gender": """
        SELECT "year", "month", gender, count(*) AS visitor_cnt
        FROM visitor_analysis
        JOIN visitors USING (admission_id, arrival_date)
        JOIN arrival_date USING (arrival_date)
        GROUP BY ALL""",
    "top_ports_population": """
        SELECT port_city, total_population, count(*) AS visitor_cnt
        FROM visitor_analysis
        LEFT JOIN state_demographics d ON port_city = city AND port_state_code = d.state_code
        GROUP BY ALL
        ORDER BY visitor_cnt DESC, port_city, total_population NULLS LAST LIMIT 10""",
    "visits_by_visa": """SELECT visa_category, count(admission_id) AS visitor_cnt
                         FROM visitor_analysis GROUP BY visa_category""",
    "top_origins": """SELECT origin_country, count(admission_id) AS visitor_cnt
                      FROM visitor_analysis GROUP BY origin_country
                      ORDER BY visitor_cnt DESC, origin_country LIMIT 10""",
    "visits_by_month": """SELECT year_month, count(admission_id) AS visitor_cnt
                          FROM visitor_analysis GROUP BY year_month""",
    "visits_by_mode": """SELECT entry_mode, count(admission_id) AS visitor_cnt
                         FROM visitor_analysis GROUP BY entry_mode""",
    "port_diversity": """
        SELECT port_city, port_state_code, visitor_cnt, average_household_size, race,
               r."count" AS race_population
        FROM (SELECT port_city, port_state_code, count(*) AS visitor_cnt
              FROM visitor_analysis GROUP BY ALL)
        LEFT JOIN state_demographics d ON port_city = d.city AND port_state_code = d.state_code
        LEFT JOIN state_demographics_by_race r
          ON port_city = r.city AND port_state_code = r.state_code""",
    "dq_row_counts": ROW_COUNTS,
    "dq_unique_keys": UNIQUE_KEYS,
    "dq_required": REQUIRED,
    "dq_fit": FIT,
    "lookup_csv_roundtrip": """
        SELECT port_city, port_state_code, dest_state_code, dest_state_name, origin_country,
               count(*) AS visitor_cnt FROM decoded GROUP BY ALL""",
    "fact_json_roundtrip": FACT,
    "arrivals_csv_roundtrip": "SELECT * FROM visits",
    "star_from_json": "SELECT * FROM visitors",
    "publish_month_twice": FACT,
    "publish_month_append": "SELECT * FROM visitors",
    "published_dates": "SELECT * FROM arrival_date",
    "refresh_demographics": "SELECT * FROM state_demographics",
    "refresh_demographics_race": "SELECT * FROM state_demographics_by_race",
}

OVER_STAR |= {
    "decode_large_lookups": "SELECT * FROM decoded",
    "decode_hot_codes": "SELECT * FROM decoded",
    "arrivals_parquet_roundtrip": OVER_STAR["visits"],
    "rejected_values": """
        SELECT 'rejected' AS check_name, 'arrivals' AS table_name, subject,
               CAST(value AS BIGINT) AS value, true AS passed
        FROM (UNPIVOT (
            SELECT 0 AS admnum, 0 AS i94yr, 0 AS i94mon, 0 AS i94cit, 0 AS arrdate, 0 AS depdate,
                   0 AS i94mode, CAST(count(*) FILTER (isnan(i94bir)) AS INTEGER) AS i94bir,
                   CAST(count(*) FILTER (biryear = 1e12) AS INTEGER) AS biryear, 0 AS i94visa
            FROM raw) ON COLUMNS(*) INTO NAME subject VALUE value)""",
    "publish_across_months": """
        SELECT 'new_key' AS check_name, 'visitor_analysis' AS table_name,
               'admission_id,arrival_date' AS subject,
               CAST(count(DISTINCT (admission_id, arrival_date)) AS BIGINT) AS value,
               false AS passed FROM visitor_analysis""",
    "published_top_ports": OVER_STAR["top_ports"],
    "published_month_gender": OVER_STAR["visits_by_month_gender"],
    "published_month_gender_gated": OVER_STAR["visits_by_month_gender"],
    "published_top_ports_population": OVER_STAR["top_ports_population"],
    "published_visits_by_visa": OVER_STAR["visits_by_visa"],
    "published_top_origins": OVER_STAR["top_origins"],
    "tables_dropped": """
        SELECT table_name, CAST(n_rows AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_left FROM (
            SELECT 'visitor_analysis' AS table_name, count(*) AS n_rows FROM visitor_analysis
            UNION ALL SELECT 'visitors', count(*) FROM visitors
            UNION ALL SELECT 'arrival_date', count(*) FROM arrival_date
            UNION ALL SELECT 'state_demographics', count(*) FROM state_demographics
            UNION ALL SELECT 'state_demographics_by_race', count(*) FROM state_demographics_by_race
            UNION ALL SELECT 'visit_keys', count(*) FROM visits
            UNION ALL SELECT 'date_visits', count(DISTINCT (arrival_date, year_month)) FROM visits
            UNION ALL SELECT 'month_counts', count(DISTINCT (year_month, port_city, port_state_code))
                + count(DISTINCT (year_month, visa_category)) + count(DISTINCT (year_month, entry_mode))
                + count(DISTINCT (year_month, origin_country)) FROM visits)""",
    "arrivals_distinct_by_digest": OVER_STAR["arrivals_typed_distinct"],
    "load_counts": """
        SELECT what, CAST(n AS BIGINT) AS n FROM (
            SELECT 'read' AS what, count(*) AS n FROM raw
            UNION ALL SELECT 'without_id', count(*) FROM raw WHERE admnum IS NULL
            UNION ALL SELECT 'copies', (SELECT count(admnum) FROM raw) - count(*) FROM visits
            UNION ALL SELECT 'staged', count(*) FROM visits
            UNION ALL SELECT 'rejected i94bir', count(*) FROM raw WHERE isnan(i94bir)
            UNION ALL SELECT 'rejected biryear', count(*) FROM raw WHERE biryear = 1e12
            UNION ALL SELECT 'rejected ' || unnest(['admnum', 'i94yr', 'i94mon', 'i94cit', 'arrdate',
                'depdate', 'i94mode', 'i94visa']), 0)""",
    "arrivals_layouts": """
        SELECT CASE WHEN i94mon <= 6 THEN '' ELSE 'i94visa,gender' END AS lacks,
               CAST(count(*) AS BIGINT) AS rows
        FROM raw GROUP BY ALL""",
    "dq_offending_dates": """
        , arrivals AS (
            SELECT CAST(trunc(admnum) AS BIGINT) AS admission_id,
                   DATE '1960-01-01' + CAST(trunc(arrdate) AS INTEGER) AS arrival_date FROM raw
        ), per_key AS (
            SELECT *, count(*) AS copies FROM arrivals GROUP BY ALL
        ), bad AS (
            SELECT 'unique_key' AS check_name, 'admission_id,arrival_date' AS subject, copies - 1 AS n, *
            FROM per_key WHERE copies > 1
            UNION ALL SELECT 'required', 'admission_id', copies, * FROM per_key WHERE admission_id IS NULL
            UNION ALL SELECT 'required', 'arrival_date', copies, * FROM per_key WHERE arrival_date IS NULL
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY check_name, subject
                ORDER BY admission_id NULLS FIRST, arrival_date NULLS FIRST) AS rank FROM bad
        )
        SELECT check_name, 'arrivals' AS table_name, subject, CAST(sum(n) AS BIGINT) AS value,
               false AS passed,
               string_agg(coalesce(CAST(admission_id AS VARCHAR), 'null') || ','
                   || coalesce(CAST(arrival_date AS VARCHAR), 'null'), ';' ORDER BY rank)
                   FILTER (WHERE rank <= 3) AS keys
        FROM ranked GROUP BY check_name, subject""",
    "published_less": """SELECT * FROM arrival_date
                         WHERE arrival_date IN (SELECT arrival_date FROM visits
                                                WHERE day(arrival_date) <= 15)""",
    "published_key_index": """
        SELECT admission_id, arrival_date, true AS in_visitor_analysis, true AS in_visitors,
               year_month, CAST(year(arrival_date) * 100 + month(arrival_date) AS INTEGER)
                   AS arrival_month
        FROM visits""",
    "staged_together": FACT,
    "kept_counts": """
        SELECT CASE WHEN grouping(port_city) = 0 THEN 'port' WHEN grouping(visa_category) = 0 THEN 'visa'
                    WHEN grouping(origin_country) = 0 THEN 'origin' ELSE 'mode' END AS counted_by,
               port_city, port_state_code, visa_category, origin_country, entry_mode, year_month,
               count(*) AS visitor_cnt
        FROM visits
        GROUP BY GROUPING SETS ((year_month, port_city, port_state_code), (year_month, visa_category),
                                (year_month, origin_country), (year_month, entry_mode))""",
    "kept_reports": " UNION ALL ".join(
        f"SELECT '{name}' AS report, CAST({key} AS VARCHAR) AS key, visitor_cnt "
        f"FROM ({OVER_STAR[name]})"
        for name, key in (
            ("top_ports", "port_city"),
            ("top_origins", "origin_country"),
            ("visits_by_visa", "visa_category"),
            ("visits_by_month", "year_month"),
            ("visits_by_mode", "entry_mode"),
            ("top_ports_population", "port_city"),
        )
    ),
    "kept_port_diversity": OVER_STAR["port_diversity"],
    "demographics_from_json": OVER_STAR["demographics_total"],
    "demographics_race_from_json": OVER_STAR["demographics_race"],
}

# Checks of a table whose key repeats.
ON_LINEITEM = {
    "dq_key_surplus": """SELECT CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber))
                                AS BIGINT) AS surplus FROM lineitem""",
    "dq_duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
                            GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_offending_keys": """
        WITH per_key AS (
            SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL
        ), first AS (
            SELECT * FROM per_key WHERE copies > 1 ORDER BY l_orderkey, l_linenumber LIMIT 5
        )
        SELECT 'row_count' AS check_name, 'lineitem' AS table_name, '' AS subject,
               CAST(sum(copies) AS BIGINT) AS value, sum(copies) > 0 AS passed, '' AS keys
        FROM per_key
        UNION ALL
        SELECT 'unique_key', 'lineitem', 'l_orderkey,l_linenumber',
               CAST(sum(copies - 1) AS BIGINT), sum(copies - 1) = 0,
               (SELECT string_agg(l_orderkey || ',' || l_linenumber, ';'
                                  ORDER BY l_orderkey, l_linenumber) FROM first)
        FROM per_key""",
    "gate_blocks_duplicates": """
        SELECT 'unique_key' AS check_name, 'lineitem' AS table_name,
               'l_orderkey,l_linenumber' AS subject,
               CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS value,
               false AS passed
        FROM lineitem""",
}


def oracle_sql() -> dict[str, str]:
    return {name: STAR + sql for name, sql in OVER_STAR.items()} | ON_LINEITEM
