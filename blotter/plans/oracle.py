"""DuckDB oracle SQL for the registered queries.

Each query is written independently of the Spark code, in the plainest
SQL that states the reference's semantics (global windows, cross joins and
recursive CTEs are fine here: the oracle runs on the small test scale).
"""

from __future__ import annotations

from blotter.schema import OFFENSE_CLASSES
from blotter.sources.fixtures import fixture_sql

SQL: dict[str, str] = {}


def _lit_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _values(values) -> str:
    return "(VALUES " + ", ".join("('" + v.replace("'", "''") + "')" for v in values) + ")"


CLASSES_IN = _lit_list(OFFENSE_CLASSES)


def with_(*ctes: str) -> str:
    """WITH <fixture incidents>, <ctes...>"""
    body = fixture_sql().strip()
    extra = ",\n".join(c.strip() for c in ctes if c.strip())
    return "WITH " + body + ("," + extra if extra else "") + "\n"


SQL["incidents_typed"] = with_() + "SELECT * FROM incidents"

SQL["offense_distribution"] = with_() + """
SELECT offense_category_name AS "Crime Type", count(*) AS "Count"
FROM incidents WHERE offense_category_name IS NOT NULL
GROUP BY 1 HAVING count(*) > 0
"""

SQL["offense_distribution_by_city_year"] = with_() + """
SELECT city AS "City", year, offense_category_name AS "Crime Type", count(*) AS "Count"
FROM incidents WHERE city IS NOT NULL AND offense_category_name IS NOT NULL
GROUP BY 1, 2, 3
"""

SQL["offense_distribution_partial"] = with_(
    """crime_distribution AS (
  SELECT city, year, offense_category_name, count(*) AS count FROM incidents GROUP BY ALL)"""
) + """
SELECT city AS "City", offense_category_name AS "Crime Type", CAST(sum(count) AS BIGINT) AS "Count"
FROM crime_distribution
WHERE offense_category_name IS NOT NULL
GROUP BY 1, 2 HAVING sum(count) > 0
"""

SQL["incident_totals"] = with_() + """
SELECT city AS scope, count(*) AS total FROM incidents WHERE city IS NOT NULL GROUP BY city
UNION ALL
SELECT 'Statewide', count(*) FROM incidents
"""

_ALIGN = """
dist AS (
  SELECT {dist_scope} offense_category_name AS ct, count(*) AS n
  FROM incidents WHERE offense_category_name IS NOT NULL {where}
  GROUP BY ALL),
folded AS (
  SELECT {scope} CASE WHEN ct IN ({classes}) THEN ct ELSE 'Other' END AS ct, n FROM dist),
sums AS (SELECT {scope} ct, sum(n) AS n FROM folded GROUP BY ALL),
classes AS (SELECT * FROM {values} t(ct)),
scopes AS (SELECT DISTINCT {scope_only} FROM folded),
aligned AS (
  SELECT {scope_out} c.ct AS "Crime Type", CAST(coalesce(s.n, 0) AS BIGINT) AS "Count"
  FROM scopes sc CROSS JOIN classes c
  LEFT JOIN sums s ON s.ct = c.ct {scope_join})
"""


def _align(scope: bool, where: str = "") -> str:
    if scope:
        return _ALIGN.format(
            dist_scope="city AS City,",
            scope="City,",
            where=where,
            classes=CLASSES_IN,
            values=_values(OFFENSE_CLASSES),
            scope_only="City",
            scope_out='sc.City AS "City",',
            scope_join="AND s.City = sc.City",
        )
    return _ALIGN.format(
        dist_scope="",
        scope="",
        where=where,
        classes=CLASSES_IN,
        values=_values(OFFENSE_CLASSES),
        scope_only="1 AS one",
        scope_out="",
        scope_join="",
    )


SQL["offense_13"] = with_(_align(False)) + "SELECT * FROM aligned"

SQL["offense_13_by_city"] = with_(_align(True, "AND city IS NOT NULL")) + "SELECT * FROM aligned"

SQL["offense_13_by_city_of_year"] = with_(_align(True, "AND city IS NOT NULL AND year = 2000")) + "SELECT * FROM aligned"

SQL["offense_pivot"] = with_(_align(True, "AND city IS NOT NULL")) + 'SELECT "Crime Type", ' + ", ".join(
    f"""CAST(coalesce(sum("Count") FILTER (WHERE "City" = 'NATION_{k}'), 0) AS BIGINT) AS "NATION_{k}\"""" for k in range(25)
) + """, CAST(sum("Count") AS BIGINT) AS "Total" FROM aligned GROUP BY 1
"""

SQL["offense_share"] = with_(_align(True, "AND city IS NOT NULL")) + """
SELECT "City", "Crime Type", "Count",
  CASE WHEN sum("Count") OVER (PARTITION BY "City") > 0
       THEN CAST("Count" AS DOUBLE) / sum("Count") OVER (PARTITION BY "City") ELSE 0.0 END * 100.0 AS "Share (%)",
  CASE WHEN sum("Count") OVER (PARTITION BY "City") > 0
        AND CAST("Count" AS DOUBLE) / sum("Count") OVER (PARTITION BY "City") >= 0.02
       THEN printf('%.1f%%', round_even(CAST("Count" AS DOUBLE) / sum("Count") OVER (PARTITION BY "City") * 100.0, 1))
       ELSE '' END AS label
FROM aligned
"""


# --- dense daily series ------------------------------------------------------

_STATS = ["population", "total_officers", "male_officer", "female_officer",
          "officers_per_1000_people", "crime_rate_per_1000_people"]
_STATS_SEL = ", ".join(_STATS)

DAILY_CTES = f"""
counts AS (SELECT date, city, count(*) AS crime_count FROM incidents WHERE city IS NOT NULL GROUP BY ALL),
bounds AS (SELECT min(date) AS lo, max(date) AS hi FROM incidents),
cities AS (SELECT DISTINCT city FROM incidents WHERE city IS NOT NULL),
days AS (SELECT CAST(g.d AS DATE) AS date FROM bounds, generate_series(bounds.lo, bounds.hi, INTERVAL 1 DAY) g(d)),
dense AS (
  SELECT d.date, c.city, coalesce(n.crime_count, 0) AS crime_count, CAST(year(d.date) AS INTEGER) AS year
  FROM days d CROSS JOIN cities c LEFT JOIN counts n ON n.date = d.date AND n.city = c.city),
stats AS (
  SELECT year, city, {_STATS_SEL} FROM (
    SELECT *, row_number() OVER (PARTITION BY year, city ORDER BY row_order) AS rn
    FROM incidents WHERE city IS NOT NULL) WHERE rn = 1),
joined AS (SELECT d.*, {", ".join("s." + c for c in _STATS)} FROM dense d LEFT JOIN stats s USING (city, year)),
ff AS (
  SELECT date, city, crime_count, year,
    {", ".join(f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in _STATS)}
  FROM joined WINDOW w AS (PARTITION BY city ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
bf AS (
  SELECT date, city, crime_count, year,
    {", ".join(f"first_value({c} IGNORE NULLS) OVER w AS {c}" for c in _STATS)}
  FROM ff WINDOW w AS (ORDER BY date, city ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
bf_city AS (
  SELECT date, city, crime_count, year,
    {", ".join(f"first_value({c} IGNORE NULLS) OVER w AS {c}" for c in _STATS)}
  FROM ff WINDOW w AS (PARTITION BY city ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
daily_city AS (SELECT * FROM bf WHERE {" AND ".join(c + " IS NOT NULL" for c in _STATS)})
"""

SQL["daily_city_counts"] = with_(DAILY_CTES) + "SELECT * FROM counts"
SQL["daily_city_dense"] = with_(DAILY_CTES) + "SELECT * FROM dense"
SQL["city_year_stats"] = with_(DAILY_CTES) + "SELECT * FROM stats"
SQL["daily_city_filled"] = with_(DAILY_CTES) + "SELECT * FROM daily_city"
SQL["daily_city_filled_per_city"] = with_(DAILY_CTES) + (
    "SELECT * FROM bf_city WHERE " + " AND ".join(c + " IS NOT NULL" for c in _STATS)
)

# --- staffing -------------------------------------------------------------------

TREND_CTES = """
trends AS (
  SELECT CAST(date_trunc('month', date) AS DATE) AS month_start, city, population, total_officers, male_officer,
         female_officer, officers_per_1000_people, min(row_order) AS first_order
  FROM incidents GROUP BY ALL),
statewide AS (
  SELECT month_start, CAST(sum(population) AS BIGINT) AS population,
    CAST(sum(total_officers) AS BIGINT) AS total_officers,
    CAST(sum(male_officer) AS BIGINT) AS male_officer, CAST(sum(female_officer) AS BIGINT) AS female_officer,
    CAST(sum(total_officers) AS DOUBLE) / nullif(CAST(sum(population) AS DOUBLE), 0) * 1000.0
      AS officers_per_1000_people
  FROM trends GROUP BY month_start),
per_month AS (
  SELECT month_start, city, arg_max(male_officer, first_order) AS male_officer,
    arg_max(female_officer, first_order) AS female_officer,
    arg_max(total_officers, first_order) AS total_officers
  FROM trends WHERE city IS NOT NULL GROUP BY ALL)
"""

SQL["officer_trends"] = with_(TREND_CTES) + "SELECT * FROM trends"
SQL["statewide_staffing"] = with_(TREND_CTES) + "SELECT * FROM statewide"
SQL["city_staffing"] = with_(TREND_CTES) + (
    "SELECT city, month_start, population, total_officers, male_officer, female_officer, "
    "officers_per_1000_people, first_order FROM trends "
    "WHERE city IN (SELECT city FROM incidents WHERE city IS NOT NULL)"
)
SQL["gender_by_month"] = with_(TREND_CTES) + "SELECT * FROM per_month"
SQL["gender_text_by_month"] = with_(TREND_CTES) + """
SELECT month_start,
  string_agg(city || ': ' || format('{:,}', male_officer), chr(10) ORDER BY city) AS male_text,
  string_agg(city || ': ' || format('{:,}', female_officer), chr(10) ORDER BY city) AS female_text
FROM per_month GROUP BY month_start
"""
SQL["force_status"] = with_(TREND_CTES) + """
SELECT city, month_start, total_officers, male_officer, female_officer, officers_per_1000_people,
  strftime((SELECT max(month_start) FROM trends WHERE city IS NOT NULL), '%B %Y') AS as_of
FROM (
  SELECT *, row_number() OVER (PARTITION BY city ORDER BY month_start DESC, first_order DESC) AS rn
  FROM trends WHERE city IS NOT NULL) WHERE rn = 1
"""
SQL["statewide_status"] = with_(TREND_CTES) + """
SELECT month_start, population, total_officers, male_officer, female_officer, officers_per_1000_people,
  strftime(month_start, '%B %Y') AS as_of
FROM statewide ORDER BY month_start DESC LIMIT 1
"""
SQL["city_cards"] = with_(DAILY_CTES) + """
SELECT city, date, total_officers, population, officers_per_1000_people, crime_rate_per_1000_people
FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY date DESC) AS rn FROM daily_city) WHERE rn = 1
"""

# --- lookups ------------------------------------------------------------------

_LSTATS = ["population", "total_officers", "officers_per_1000_people", "crime_rate_per_1000_people"]

SQL["city_stats_latest"] = with_(DAILY_CTES) + (
    "SELECT city, "
    + ", ".join(f"arg_max({c}, date) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _LSTATS)
    + " FROM daily_city GROUP BY city"
)
SQL["city_stats_last_row"] = with_() + (
    "SELECT city, "
    + ", ".join(f"arg_max({c}, row_order) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _LSTATS)
    + " FROM incidents WHERE city IS NOT NULL GROUP BY city"
)
SQL["location_totals"] = with_() + """
SELECT location_area, CAST(count(*) AS DOUBLE) AS location_total_crimes
FROM incidents WHERE location_area IS NOT NULL GROUP BY 1
"""
SQL["location_daily_mean"] = with_() + """
SELECT location_area, count(*) / (SELECT CAST(count(DISTINCT date) AS DOUBLE) FROM incidents) AS avg_location_daily_freq
FROM incidents WHERE location_area IS NOT NULL GROUP BY 1
"""

LOOKUP_CTES = """
dom AS (
  SELECT c.city, h.hour FROM (SELECT DISTINCT city FROM incidents WHERE city IS NOT NULL) c
  CROSS JOIN (SELECT DISTINCT hour FROM incidents) h),
obs AS (SELECT DISTINCT city, hour FROM incidents WHERE city IS NOT NULL),
cnt AS (
  SELECT city, hour, offense_category_clean AS o, count(*) AS n FROM incidents
  WHERE city IS NOT NULL AND offense_category_clean IS NOT NULL GROUP BY ALL),
top AS (
  SELECT city, hour, o FROM (
    SELECT *, row_number() OVER (PARTITION BY city, hour ORDER BY n DESC, o ASC) AS rn FROM cnt) WHERE rn = 1),
typ AS (SELECT obs.city, obs.hour, coalesce(top.o, 'Other') AS hour_typical_crime FROM obs LEFT JOIN top USING (city, hour)),
hour_typical AS (SELECT dom.city, dom.hour, typ.hour_typical_crime FROM dom LEFT JOIN typ USING (city, hour)),
div_day AS (
  SELECT date, hour, city, count(DISTINCT offense_category_clean) AS k FROM incidents
  WHERE city IS NOT NULL GROUP BY ALL),
div_obs AS (
  SELECT city, hour, sum(k) / (SELECT CAST(count(DISTINCT date) AS DOUBLE) FROM incidents) AS v
  FROM div_day GROUP BY ALL),
hour_diversity AS (
  SELECT dom.city, dom.hour, coalesce(div_obs.v, 0.0) AS avg_crime_diversity FROM dom LEFT JOIN div_obs USING (city, hour))
"""

SQL["hour_typical"] = with_(LOOKUP_CTES) + "SELECT * FROM hour_typical"
SQL["hour_diversity"] = with_(LOOKUP_CTES) + "SELECT * FROM hour_diversity"
SQL["domains"] = with_(LOOKUP_CTES) + """
SELECT 'city' AS domain, v AS value, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS pos
FROM (SELECT DISTINCT city AS v FROM incidents WHERE city IS NOT NULL)
UNION ALL
SELECT 'location_area', v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER)
FROM (SELECT DISTINCT location_area AS v FROM incidents WHERE location_area IS NOT NULL)
UNION ALL
SELECT 'hour_typical_crime', v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER)
FROM (SELECT DISTINCT hour_typical_crime AS v FROM hour_typical WHERE hour_typical_crime IS NOT NULL)
UNION ALL
SELECT 'year', CAST(v AS VARCHAR), CAST(row_number() OVER (ORDER BY v DESC) - 1 AS INTEGER)
FROM (SELECT DISTINCT year AS v FROM incidents)
"""


# --- scalar features -----------------------------------------------------------------

from blotter.functions.calendar import holiday_name_sql, holiday_sql  # noqa: E402
from blotter.schema import LOCATION_TYPE_KEYWORDS, PROPERTY_CLASSES, VIOLENT_CLASSES  # noqa: E402


def _loc_type_sql(x: str) -> str:
    whens = []
    for t, kws in LOCATION_TYPE_KEYWORDS:
        cond = " OR ".join(f"contains(lower({x}), '{k}')" for k in kws)
        whens.append(f"WHEN {cond} THEN '{t}'")
    return f"coalesce(CASE {' '.join(whens)} ELSE 'other' END, 'other')"


def _class_sql(x: str) -> str:
    return f"(CASE WHEN {x} IN ({CLASSES_IN}) THEN {x} ELSE 'Other' END)"


def _broad_sql(x: str) -> str:
    return (
        f"(CASE WHEN {x} IN ({_lit_list(VIOLENT_CLASSES)}) THEN 'Violent' "
        f"WHEN {x} IN ({_lit_list(PROPERTY_CLASSES)}) THEN 'Property' ELSE 'Other' END)"
    )


SQL["location_types"] = with_() + f"""
SELECT location_area, {_loc_type_sql('location_area')} AS location_type
FROM (SELECT DISTINCT location_area FROM incidents)
"""
SQL["broad_classes"] = with_() + f"""
SELECT offense_category_name, {_class_sql('offense_category_name')} AS offense_class,
  {_broad_sql(_class_sql('offense_category_name'))} AS broad_class
FROM (SELECT DISTINCT offense_category_name FROM incidents)
"""
SQL["payday_features"] = with_() + """
SELECT date,
  CAST(day(date) IN (1, 15) OR day(date) = day(last_day(date)) AS INTEGER) AS is_payday,
  CAST(least(abs(day(date) - 1), abs(day(date) - 15), abs(day(date) - day(last_day(date)))) AS INTEGER) AS days_from_payday
FROM (SELECT DISTINCT date FROM incidents)
"""


def _sincos(x: str, n: int, name: str) -> str:
    return (f"sin(2 * pi() * CAST({x} AS DOUBLE) / {float(n)}) AS {name}_sin, "
            f"cos(2 * pi() * CAST({x} AS DOUBLE) / {float(n)}) AS {name}_cos")


SQL["calendar_features"] = with_() + f"""
SELECT date, CAST(isodow(date) - 1 AS INTEGER) AS dayofweek, CAST(month(date) AS INTEGER) AS month,
  CAST(day(date) AS INTEGER) AS day_of_month, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
  CAST(dayofyear(date) AS INTEGER) AS day_of_year, CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(isodow(date) IN (6, 7) AS INTEGER) AS is_weekend, CAST(isodow(date) = 1 AS INTEGER) AS is_monday,
  CAST(isodow(date) = 5 AS INTEGER) AS is_friday,
  {_sincos('month(date)', 12, 'month')}, {_sincos('isodow(date) - 1', 7, 'dow')},
  {_sincos('day(date)', 31, 'day_of_month')}, {_sincos('weekofyear(date)', 52, 'week')}
FROM (SELECT DISTINCT date FROM incidents)
"""
SQL["holiday_flags"] = with_(DAILY_CTES) + f"""
SELECT date, CAST({holiday_sql('date')} AS INTEGER) AS is_holiday,
  CAST({holiday_sql('CAST(date + INTERVAL 1 DAY AS DATE)')} AS INTEGER) AS is_day_before_holiday,
  CAST({holiday_sql('CAST(date - INTERVAL 1 DAY AS DATE)')} AS INTEGER) AS is_day_after_holiday,
  {holiday_name_sql('date')} AS holiday_name
FROM days
"""

# --- forecast -------------------------------------------------------------------------

from blotter.operators.forecast import (  # noqa: E402
    DEMO_CITY_MODELS,
    DEMO_GLOBAL,
    DYNAMIC_FEATURES,
    STATIC_FEATURES,
)
from blotter.plans.demo import (  # noqa: E402
    DEMO_STATIC,
    DEMO_TREE_CITIES,
    INDEX_OWN,
    INDEX_PATHS,
    INDEX_SHARED,
    SPLIT_BINS,
    SPLIT_FEATURES,
    SPLIT_REG,
    SPLIT_ROWS,
    tree_sql,
)
from blotter.schema import FORECAST_FEATURES  # noqa: E402

_COEF_COLS = ["intercept", *FORECAST_FEATURES]


def _coef_values(city_models: dict[str, float] = DEMO_CITY_MODELS) -> str:
    rows = ["(NULL, " + ", ".join(repr(float(DEMO_GLOBAL[c])) for c in _COEF_COLS) + ")"]
    for city, scale in city_models.items():
        rows.append(f"('{city}', " + ", ".join(repr(float(DEMO_GLOBAL[c] * scale)) for c in _COEF_COLS) + ")")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") t(city, " + ", ".join(_COEF_COLS) + ")"


def _static_feature_sql(d: str) -> dict[str, str]:
    dow = f"(isodow({d}) - 1)"
    mon = f"month({d})"
    return {
        "day_of_week": dow,
        "month": mon,
        "quarter": f"quarter({d})",
        "day_of_year": f"dayofyear({d})",
        "is_weekend": f"CAST(isodow({d}) IN (6, 7) AS INTEGER)",
        "is_monday": f"CAST(isodow({d}) = 1 AS INTEGER)",
        "is_friday": f"CAST(isodow({d}) = 5 AS INTEGER)",
        "month_sin": f"sin(2 * pi() * CAST({mon} AS DOUBLE) / 12.0)",
        "month_cos": f"cos(2 * pi() * CAST({mon} AS DOUBLE) / 12.0)",
        "dow_sin": f"sin(2 * pi() * CAST({dow} AS DOUBLE) / 7.0)",
        "dow_cos": f"cos(2 * pi() * CAST({dow} AS DOUBLE) / 7.0)",
        "is_holiday": f"CAST({holiday_sql(d)} AS INTEGER)",
        "is_day_before_holiday": f"CAST({holiday_sql(f'CAST({d} + INTERVAL 1 DAY AS DATE)')} AS INTEGER)",
        "is_day_after_holiday": f"CAST({holiday_sql(f'CAST({d} - INTERVAL 1 DAY AS DATE)')} AS INTEGER)",
        "population": "l.population",
        "total_officers": "l.total_officers",
        "officers_per_1000_people": "l.officers_per_1000_people",
        "crime_rate_per_1000_people": "l.crime_rate_per_1000_people",
    }


def _static_sql() -> str:
    feats = _static_feature_sql("t.date")
    expr = "m.intercept"
    for f in STATIC_FEATURES:
        expr = f"({expr} + m.{f} * CAST({feats[f]} AS DOUBLE))"
    return expr


FORECAST_CTES = """
params AS (SELECT CAST(max(date) + INTERVAL 1 DAY AS DATE) AS origin FROM daily_city),
hist AS (
  SELECT h.date, h.city, h.crime_count, h.population, h.total_officers, h.officers_per_1000_people,
    h.crime_rate_per_1000_people, CAST(month(h.date) AS INTEGER) AS month, CAST(isodow(h.date) - 1 AS INTEGER) AS dow,
    CAST(dayofyear(h.date) AS INTEGER) AS doy
  FROM daily_city h, params p WHERE h.date < p.origin),
city_avg AS (SELECT city, avg(crime_count) AS city_avg FROM hist GROUP BY city),
md AS (SELECT city, month, dow, avg(crime_count) AS md_avg FROM hist GROUP BY ALL),
dw AS (SELECT city, dow, avg(crime_count) AS dow_avg FROM hist GROUP BY ALL),
flagged AS (
  SELECT h.*, h.month IN (month(p.origin), month(CAST(p.origin + INTERVAL 29 DAY AS DATE))) AS in_m
  FROM hist h, params p),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY city ORDER BY date DESC) AS rn_all,
    row_number() OVER (PARTITION BY city, in_m ORDER BY date DESC) AS rn_m
  FROM flagged),
seed_n AS (SELECT city, sum(CAST(in_m AS INTEGER)) AS n_m FROM ranked GROUP BY city),
seeds AS (
  SELECT r.city, list(CAST(r.crime_count AS DOUBLE) ORDER BY r.date) AS seed
  FROM ranked r JOIN seed_n s USING (city)
  WHERE (s.n_m >= 7 AND r.in_m AND r.rn_m <= 14) OR (s.n_m < 7 AND r.rn_all <= 14)
  GROUP BY r.city),
recent AS (SELECT city, avg(crime_count) AS recent FROM ranked WHERE rn_all <= 14 GROUP BY city),
latest AS (
  SELECT city, population, total_officers, officers_per_1000_people, crime_rate_per_1000_people
  FROM ranked WHERE rn_all = 1),
tgt AS (
  SELECT c.city, CAST(g.i AS INTEGER) AS step, CAST(p.origin + CAST(g.i AS INTEGER) * INTERVAL 1 DAY AS DATE) AS date
  FROM (SELECT DISTINCT city FROM hist) c, params p, range(0, 30) g(i)),
analog AS (
  SELECT t.city, t.date, avg(h.crime_count) AS analog
  FROM tgt t JOIN hist h ON h.city = t.city
   AND least(abs(h.doy - dayofyear(t.date)), 366 - abs(h.doy - dayofyear(t.date))) <= 14
  GROUP BY ALL),
coef AS (__COEF__),
model AS (
  SELECT c.city, cc.city IS NOT NULL AS use_city,
    __MODEL_COLS__
  FROM (SELECT DISTINCT city FROM hist) c LEFT JOIN coef cc ON cc.city = c.city
  CROSS JOIN (SELECT * FROM coef WHERE city IS NULL) g),
fdays AS (
  SELECT t.city, t.step, t.date, __STATIC__ AS static,
    coalesce(a.analog, coalesce(md.md_avg, dw.dow_avg, ca.city_avg)) AS analog,
    coalesce(r.recent, coalesce(md.md_avg, dw.dow_avg, ca.city_avg)) AS recent,
    coalesce(md.md_avg, dw.dow_avg, ca.city_avg) AS seasonal,
    CAST(__HOLIDAY__ AS INTEGER) AS is_holiday
  FROM tgt t JOIN latest l ON l.city = t.city JOIN model m ON m.city = t.city
  JOIN recent r ON r.city = t.city JOIN city_avg ca ON ca.city = t.city
  LEFT JOIN md ON md.city = t.city AND md.month = month(t.date) AND md.dow = isodow(t.date) - 1
  LEFT JOIN dw ON dw.city = t.city AND dw.dow = isodow(t.date) - 1
  LEFT JOIN analog a ON a.city = t.city AND a.date = t.date),
rec(city, step, buf, pred) AS (
  SELECT city, -1, seed, CAST(NULL AS DOUBLE) FROM seeds
  UNION ALL
  SELECT city, step,
    CASE WHEN len(list_append(buf, pred)) > 14
         THEN list_slice(list_append(buf, pred), len(buf) + 1 - 13, len(buf) + 1)
         ELSE list_append(buf, pred) END,
    pred
  FROM (
    SELECT city, step, buf,
      CASE WHEN use_city THEN model
           ELSE greatest(0.6 * model + 0.25 * analog + 0.1 * recent + 0.05 * seasonal + trend, 0.0) END AS pred
    FROM (
      SELECT *, greatest(__DYN__, 0.0) AS model,
        CASE WHEN len(buf) >= 14
             THEN (list_avg(list_slice(buf, len(buf) - 6, len(buf)))
                   - list_avg(list_slice(buf, len(buf) - 13, len(buf) - 7))) * 0.08
             ELSE 0.0 END AS trend
      FROM (
        SELECT *, CASE WHEN n7 >= 1 THEN b7[n7] ELSE 0.0 END AS lag_1,
          CASE WHEN n7 >= 3 THEN b7[n7 - 2] WHEN n7 >= 1 THEN b7[n7] ELSE 0.0 END AS lag_3,
          CASE WHEN n7 >= 7 THEN b7[n7 - 6] ELSE b7[1] END AS lag_7,
          CASE WHEN n7 >= 1 THEN list_avg(b7) ELSE 0.0 END AS roll,
          CASE WHEN n7 >= 2 THEN list_aggregate(b7, 'stddev_pop') ELSE 0.0 END AS std,
          CASE WHEN n7 >= 1 THEN list_max(b7) ELSE 0.0 END AS mx,
          CASE WHEN n7 >= 1 THEN list_min(b7) ELSE 0.0 END AS mn
        FROM (
          SELECT r.city, d.step, r.buf, d.static, d.analog, d.recent, d.seasonal, m.use_city,
            __MCOEF__,
            list_slice(r.buf, greatest(len(r.buf) - 6, 1), len(r.buf)) AS b7,
            len(list_slice(r.buf, greatest(len(r.buf) - 6, 1), len(r.buf))) AS n7
          FROM rec r JOIN fdays d ON d.city = r.city AND d.step = r.step + 1
          JOIN model m ON m.city = r.city))))),
forecast AS (
  SELECT r.city AS "City", d.date AS "Date", r.pred AS "Predicted Count", d.is_holiday,
    CASE WHEN m.use_city THEN 'City-specific' ELSE 'Statewide' END AS policy
  FROM rec r JOIN fdays d ON d.city = r.city AND d.step = r.step JOIN model m ON m.city = r.city
  WHERE r.step >= 0)
"""

_DYN_VALUE = {
    "lag_1": "lag_1", "lag_3": "lag_3", "lag_7": "lag_7", "roll_mean_7": "roll", "rolling_mean_7": "roll",
    "roll_std_7": "std", "rolling_std_7": "std", "roll_max_7": "mx", "roll_min_7": "mn",
}


def _forecast_ctes(city_models: dict[str, float] = DEMO_CITY_MODELS) -> str:
    dyn = "static"
    for f in DYNAMIC_FEATURES:
        dyn = f"({dyn} + c_{f} * {_DYN_VALUE[f]})"
    return (
        FORECAST_CTES.replace("__COEF__", _coef_values(city_models))
        .replace("__MODEL_COLS__", ", ".join(
            f"CASE WHEN cc.city IS NOT NULL THEN coalesce(cc.{c}, 0.0) ELSE coalesce(g.{c}, 0.0) END AS {c}"
            for c in _COEF_COLS))
        .replace("__STATIC__", _static_sql())
        .replace("__HOLIDAY__", holiday_sql("t.date"))
        .replace("__MCOEF__", ", ".join(f"m.{f} AS c_{f}" for f in DYNAMIC_FEATURES))
        .replace("__DYN__", dyn)
    )


def with_recursive(*ctes: str) -> str:
    return "WITH RECURSIVE " + with_(*ctes)[len("WITH "):]


SQL["forecast_history_features"] = with_(DAILY_CTES) + """
SELECT date, city, crime_count, lag_1,
  CASE WHEN n7 >= 3 THEN lag3 ELSE lag_1 END AS lag_3,
  CASE WHEN n7 >= 7 THEN lag7 ELSE coalesce(first7, 0.0) END AS lag_7,
  coalesce(mean7, 0.0) AS roll_mean_7,
  CASE WHEN n7 >= 2 THEN std7 ELSE 0.0 END AS roll_std_7,
  coalesce(max7, 0.0) AS roll_max_7, coalesce(min7, 0.0) AS roll_min_7,
  CASE WHEN n14 >= 14 THEN (mean7 - mean_prev) * 0.08 ELSE 0.0 END AS trend
FROM (
  SELECT date, city, crime_count,
    count(x) OVER (PARTITION BY city ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS n7,
    count(x) OVER (PARTITION BY city ORDER BY date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS n14,
    coalesce(lag(x, 1) OVER (PARTITION BY city ORDER BY date), 0.0) AS lag_1,
    lag(x, 3) OVER (PARTITION BY city ORDER BY date) AS lag3,
    lag(x, 7) OVER (PARTITION BY city ORDER BY date) AS lag7,
    first_value(x) OVER (PARTITION BY city ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS first7,
    avg(x) OVER (PARTITION BY city ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS mean7,
    stddev_pop(x) OVER (PARTITION BY city ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS std7,
    max(x) OVER (PARTITION BY city ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS max7,
    min(x) OVER (PARTITION BY city ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS min7,
    avg(x) OVER (PARTITION BY city ORDER BY date ROWS BETWEEN 14 PRECEDING AND 8 PRECEDING) AS mean_prev
  FROM (SELECT *, CAST(crime_count AS DOUBLE) AS x FROM daily_city))
"""

SQL["seasonal_profile"] = with_(DAILY_CTES, FORECAST_CTES.split("flagged AS")[0].rstrip().rstrip(",")) + """
SELECT md.city, md.month, md.dow AS day_of_week, md.md_avg, dw.dow_avg, ca.city_avg
FROM md JOIN dw USING (city, dow) JOIN city_avg ca USING (city)
"""
SQL["analog_profile"] = with_recursive(DAILY_CTES, _forecast_ctes()) + "SELECT city, date, analog FROM analog"
SQL["recent_level"] = with_recursive(DAILY_CTES, _forecast_ctes()) + "SELECT city, recent FROM recent"
SQL["forecast_seed"] = with_recursive(DAILY_CTES, _forecast_ctes()) + """
SELECT city, CAST(i - 1 AS INTEGER) AS pos, seed[i] AS value
FROM seeds, range(1, 15) g(i) WHERE i <= len(seed)
"""
SQL["forecast_30d"] = with_recursive(DAILY_CTES, _forecast_ctes()) + "SELECT * FROM forecast"


def _tree_forecast_ctes() -> str:
    """The forecast with each model's trees as nested CASE expressions in the recursive member."""
    names = {**_DYN_VALUE, **{f: f"x_{f}" for f in DEMO_STATIC}}
    feats = _static_feature_sql("t.date")
    per_city = " ".join(f"WHEN city = '{c}' THEN {tree_sql(names, k)}" for c, k in DEMO_TREE_CITIES.items())
    dyn_start = FORECAST_CTES.replace("__DYN__", f"CASE {per_city} ELSE {tree_sql(names, 1.0)} END")
    body = dyn_start.replace("__STATIC__ AS static", ", ".join(["0.0 AS static"] + [f"{feats[f]} AS x_{f}" for f in DEMO_STATIC]))
    body = body.replace("d.static,", ", ".join(["d.static"] + [f"d.x_{f}" for f in DEMO_STATIC]) + ",")
    return (
        body.replace("__COEF__", _coef_values())
        .replace("__MODEL_COLS__", "0.0 AS none")
        .replace("__HOLIDAY__", holiday_sql("t.date"))
        .replace("__MCOEF__", "m.none AS none")
    )


SQL["forecast_tree_30d"] = with_recursive(DAILY_CTES, _tree_forecast_ctes()) + "SELECT * FROM forecast"


def _first_splits_sql() -> str:
    """Equal-width bins, sums per bin, running sums, and the highest gain, for each city and for all together."""
    n = len(SPLIT_FEATURES)
    bounds = ", ".join(f"min({f})::DOUBLE AS lo_{i}, max({f})::DOUBLE AS hi_{i}" for i, f in enumerate(SPLIT_FEATURES))
    long = " UNION ALL ".join(
        f"SELECT scope, label, {i} AS fi, '{f}' AS feature, (SELECT count(*) FROM range(1, {SPLIT_BINS}) g(k) WHERE hi_{i} > lo_{i} "
        f"AND lo_{i} + (hi_{i} - lo_{i}) * k / {SPLIT_BINS} < {f}::DOUBLE) AS bin FROM scoped, bounds_"
        for i, f in enumerate(SPLIT_FEATURES)
    )
    assert n > 1
    return f"""
    WITH feats AS (
        SELECT h.*, CAST(h.crime_count AS DOUBLE) AS label, isodow(h.date) - 1 AS day_of_week, month(h.date) AS month, s.total_officers
        FROM ({SQL["forecast_history_features"]}) h JOIN ({SQL["daily_city_filled"]}) s ON s.date = h.date AND s.city = h.city),
    bounds_ AS (SELECT {bounds} FROM feats),
    scoped AS (SELECT city AS scope, * FROM feats UNION ALL SELECT 'Statewide' AS scope, * FROM feats),
    long_ AS ({long}),
    hist AS (SELECT scope, fi, feature, bin, sum(label) AS g, count(*) AS n FROM long_ GROUP BY ALL),
    run AS (SELECT scope, fi, feature, bin, sum(g) OVER w AS gl, sum(n) OVER w AS nl, sum(g) OVER p AS g, sum(n) OVER p AS n
            FROM hist WINDOW p AS (PARTITION BY scope, fi), w AS (PARTITION BY scope, fi ORDER BY bin ROWS UNBOUNDED PRECEDING)),
    gains AS (SELECT *, gl * gl / (nl + {SPLIT_REG}) + (g - gl) * (g - gl) / (n - nl + {SPLIT_REG}) - g * g / (n + {SPLIT_REG}) AS gain
              FROM run WHERE nl >= {SPLIT_ROWS} AND n - nl >= {SPLIT_ROWS})
    SELECT scope, feature, CAST(bin AS INTEGER) AS bin, gain FROM gains WHERE gain > 1e-9
    QUALIFY row_number() OVER (PARTITION BY scope ORDER BY gain DESC, fi, bin) = 1"""



def _backtest_sql() -> str:
    """The forecast's CTEs with (origin, city) in place of the city."""
    text = _forecast_ctes()
    for old, new in (
        ("params AS (SELECT CAST(max(date) + INTERVAL 1 DAY AS DATE) AS origin FROM daily_city)",
         "params AS (SELECT k AS oid, CAST(max(date) - k * INTERVAL 1 DAY AS DATE) AS origin FROM daily_city, (VALUES (89), (59), (29)) t(k) GROUP BY k)"),
        ("SELECT h.date, h.city, h.crime_count,", "SELECT h.date, p.oid || '|' || h.city AS city, p.oid, h.crime_count,"),
        ("FROM hist h, params p)", "FROM hist h JOIN params p ON p.oid = h.oid)"),
        ("FROM (SELECT DISTINCT city FROM hist) c, params p, range(0, 30) g(i))",
         "FROM (SELECT DISTINCT city, oid FROM hist) c JOIN params p USING (oid), range(0, 30) g(i))"),
        ("LEFT JOIN coef cc ON cc.city = c.city", "LEFT JOIN coef cc ON cc.city = split_part(c.city, '|', 2)"),
    ):
        assert text.count(old) == 1, old
        text = text.replace(old, new)
    return with_recursive(DAILY_CTES, text) + """
SELECT origin, city AS "City", policy, avg(abs(p - y)) AS mae, corr(p, p_lag7) AS lag7_autocorr, count(*) AS days
FROM (
  SELECT pr.origin, split_part(f."City", '|', 2) AS city, f."Date" AS date, f.policy, f."Predicted Count" AS p,
    lag(f."Predicted Count", 7) OVER (PARTITION BY f."City" ORDER BY f."Date") AS p_lag7
  FROM forecast f JOIN params pr ON pr.oid = CAST(split_part(f."City", '|', 1) AS INTEGER)) x
JOIN (SELECT city, date, CAST(crime_count AS DOUBLE) AS y FROM daily_city) a USING (city, date)
GROUP BY origin, city, policy"""


SQL["backtest"] = _backtest_sql()

_GRAM = ["1", "lag_1", "lag_7", "roll_max_7", "day_of_week", "month", "total_officers", "label"]
SQL["gram_as_of"] = f"""
WITH feats AS (
    SELECT h.*, h.crime_count AS label, isodow(h.date) - 1 AS day_of_week, month(h.date) AS month, s.total_officers
    FROM ({SQL["forecast_history_features"]}) h JOIN ({SQL["daily_city_filled"]}) s ON s.date = h.date AND s.city = h.city),
origins AS (SELECT o, max(date) - (89 - 30 * o) * INTERVAL 1 DAY AS origin FROM feats, range(0, 3) r(o) GROUP BY o),
scoped AS (SELECT city AS scope, * FROM feats UNION ALL SELECT 'Statewide' AS scope, * FROM feats)
""" + " UNION ALL ".join(
    f"SELECT CAST(o AS INTEGER) AS origin_id, scope, {i} AS i, {j} AS j, sum(CAST({a} AS DOUBLE) * CAST({b} AS DOUBLE)) AS total "
    "FROM scoped JOIN origins ON date < origin GROUP BY o, scope"
    for i, a in enumerate(_GRAM) for j, b in enumerate(_GRAM) if i <= j
)
SQL["tree_first_splits"] = _first_splits_sql()
SQL["forecast_totals"] = with_recursive(DAILY_CTES, _forecast_ctes()) + """
SELECT "City", CAST(round_even(sum("Predicted Count"), 0) AS BIGINT) AS total FROM forecast GROUP BY 1
"""
SQL["forecast_missing"] = with_recursive(DAILY_CTES, _forecast_ctes()) + """
SELECT DISTINCT city FROM incidents WHERE city IS NOT NULL AND city NOT IN (SELECT "City" FROM forecast)
"""


# --- risk -----------------------------------------------------------------------------------

from blotter.operators.risk import demo_classifier_rows  # noqa: E402
from blotter.schema import LOCATION_TYPES, RISK_FEATURES, UNIVERSITY_CITIES  # noqa: E402


def _models_values() -> str:
    rows = []
    for model, city, k, label, icpt, w in demo_classifier_rows():
        c = "NULL" if city is None else f"'{city}'"
        lab = label.replace("'", "''")
        rows.append(f"('{model}', {c}, {k}, '{lab}', {icpt!r}, [{', '.join(repr(float(x)) for x in w)}]::DOUBLE[])")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") t(model, city, class_id, label, intercept, weights)"


_LT_VALUES = "(VALUES " + ", ".join(f"('{v}', {i})" for i, v in enumerate(LOCATION_TYPES)) + ") t(value, pos)"

RISK_CTES = f"""
city_stats AS (
  SELECT city, {", ".join(f"arg_max({c}, row_order) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _LSTATS)}
  FROM incidents WHERE city IS NOT NULL GROUP BY city),
loc_total AS (SELECT location_area, CAST(count(*) AS DOUBLE) AS v FROM incidents WHERE location_area IS NOT NULL GROUP BY 1),
loc_daily AS (
  SELECT location_area, count(*) / (SELECT CAST(count(DISTINCT date) AS DOUBLE) FROM incidents) AS v
  FROM incidents WHERE location_area IS NOT NULL GROUP BY 1),
city_cats AS (SELECT v AS value, row_number() OVER (ORDER BY v) - 1 AS pos FROM (SELECT DISTINCT city AS v FROM incidents WHERE city IS NOT NULL)),
loc_cats AS (SELECT v AS value, row_number() OVER (ORDER BY v) - 1 AS pos FROM (SELECT DISTINCT location_area AS v FROM incidents WHERE location_area IS NOT NULL)),
htc_cats AS (SELECT v AS value, row_number() OVER (ORDER BY v) - 1 AS pos FROM (SELECT DISTINCT hour_typical_crime AS v FROM hour_typical WHERE hour_typical_crime IS NOT NULL)),
lt_cats AS (SELECT * FROM {_LT_VALUES}),
scen AS (
  SELECT DISTINCT city, location_area, hour, date AS input_date FROM incidents
  WHERE city IS NOT NULL AND location_area IS NOT NULL),
f0 AS (
  SELECT s.city, s.location_area, CAST(NULL AS VARCHAR) AS location_type_in, s.hour, s.input_date,
    CASE WHEN lower({_loc_type_sql('s.location_area')}) IN ({_lit_list(LOCATION_TYPES)})
         THEN lower({_loc_type_sql('s.location_area')}) ELSE 'other' END AS location_type,
    {_sincos('s.hour', 24, 'hour')},
    CAST(isodow(s.input_date) - 1 AS INTEGER) AS dayofweek,
    {_sincos('isodow(s.input_date) - 1', 7, 'dow')},
    CAST(month(s.input_date) AS INTEGER) AS month,
    {_sincos('month(s.input_date)', 12, 'month')},
    CAST(day(s.input_date) AS INTEGER) AS day_of_month,
    {_sincos('day(s.input_date)', 31, 'day_of_month')},
    CAST(weekofyear(s.input_date) AS INTEGER) AS week_of_year,
    {_sincos('weekofyear(s.input_date)', 52, 'week')},
    CAST(isodow(s.input_date) IN (6, 7) AS INTEGER) AS is_weekend,
    CAST({holiday_sql('s.input_date')} AS INTEGER) AS is_holiday,
    CAST(day(s.input_date) IN (1, 15) OR day(s.input_date) = day(last_day(s.input_date)) AS INTEGER) AS is_payday,
    CAST(least(abs(day(s.input_date) - 1), abs(day(s.input_date) - 15),
      abs(day(s.input_date) - day(last_day(s.input_date)))) AS INTEGER) AS days_from_payday,
    CAST(coalesce(s.city IN ({_lit_list(UNIVERSITY_CITIES)}), false) AS INTEGER) AS is_university,
    CASE WHEN hd.city IS NULL THEN 1.5 ELSE hd.avg_crime_diversity END AS crime_diversity,
    CASE WHEN ld.location_area IS NULL THEN 5.0 ELSE ld.v END AS location_daily_freq,
    CASE WHEN lt.location_area IS NULL THEN 100.0 ELSE lt.v END AS location_total_crimes,
    {", ".join(f"CASE WHEN cs.city IS NULL THEN 0.0 ELSE CAST(cs.{c} AS DOUBLE) END AS {c}" for c in _LSTATS)},
    CASE WHEN ht.city IS NULL THEN 'Other' ELSE coalesce(ht.hour_typical_crime, 'nan') END AS htc_raw
  FROM scen s
  LEFT JOIN city_stats cs ON cs.city = s.city
  LEFT JOIN loc_total lt ON lt.location_area = s.location_area
  LEFT JOIN loc_daily ld ON ld.location_area = s.location_area
  LEFT JOIN hour_typical ht ON ht.city = s.city AND ht.hour = s.hour
  LEFT JOIN hour_diversity hd ON hd.city = s.city AND hd.hour = s.hour),
f1 AS (
  SELECT f0.* EXCLUDE (htc_raw),
    CASE WHEN f0.htc_raw IN (SELECT value FROM htc_cats) THEN f0.htc_raw
         ELSE coalesce((SELECT value FROM htc_cats WHERE pos = 0), 'Other') END AS hour_typical_crime
  FROM f0),
risk_features AS (
  SELECT f1.*,
    CAST(coalesce(cc.pos, CASE WHEN (SELECT count(*) FROM city_cats) > 0 THEN 0 ELSE -1 END) AS INTEGER) AS city_code,
    CAST(coalesce(lc.pos, CASE WHEN (SELECT count(*) FROM loc_cats) > 0 THEN 0 ELSE -1 END) AS INTEGER) AS location_area_code,
    CAST(coalesce(tc.pos, 3) AS INTEGER) AS location_type_code,
    CAST(coalesce(hc.pos, CASE WHEN (SELECT count(*) FROM htc_cats) > 0 THEN 0 ELSE -1 END) AS INTEGER) AS hour_typical_crime_code
  FROM f1
  LEFT JOIN city_cats cc ON cc.value = f1.city
  LEFT JOIN loc_cats lc ON lc.value = f1.location_area
  LEFT JOIN lt_cats tc ON tc.value = f1.location_type
  LEFT JOIN htc_cats hc ON hc.value = f1.hour_typical_crime),
xv AS (
  SELECT city, location_area, hour, input_date,
    [{", ".join(f"CAST({(f + '_code') if f in ('city', 'location_area', 'location_type', 'hour_typical_crime') else f} AS DOUBLE)" for f in RISK_FEATURES)}] AS x
  FROM risk_features),
models AS ({_models_values()}),
spec_cities AS (SELECT DISTINCT city FROM models WHERE model = 'specific' AND city IS NOT NULL),
logits AS (
  SELECT x.city, x.location_area, x.hour, x.input_date, m.model, m.class_id AS pos, m.label,
    m.intercept + list_dot_product(m.weights, x.x) AS z,
    CASE WHEN x.city IN (SELECT city FROM spec_cities) THEN 'City-specific' ELSE 'Statewide' END AS model_source
  FROM xv x JOIN models m
    ON (m.model = 'broad' AND m.city IS NULL)
    OR (m.model = 'specific' AND ((x.city IN (SELECT city FROM spec_cities) AND m.city = x.city)
         OR (x.city NOT IN (SELECT city FROM spec_cities) AND m.city IS NULL)))),
shifted AS (
  SELECT *, exp(z - max(z) OVER (PARTITION BY city, location_area, hour, input_date, model)) AS e FROM logits),
probs AS (
  SELECT *, e / sum(e) OVER (PARTITION BY city, location_area, hour, input_date, model) AS p FROM shifted)
"""

SQL["risk_features"] = with_(LOOKUP_CTES, RISK_CTES) + "SELECT * FROM risk_features"
SQL["risk_probabilities"] = with_(LOOKUP_CTES, RISK_CTES) + """
SELECT city, location_area, hour, input_date, model, CAST(pos AS INTEGER) AS pos, label, p AS "Probability" FROM probs
"""
SQL["risk_top5"] = with_(LOOKUP_CTES, RISK_CTES) + """
SELECT city, location_area, hour, input_date, CAST(pos AS INTEGER) AS pos, label, p AS "Probability", rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY city, location_area, hour, input_date ORDER BY p DESC, pos DESC) AS INTEGER) AS rank
  FROM probs WHERE model = 'specific') WHERE rank <= 5
"""
SQL["risk_headline"] = with_(LOOKUP_CTES, RISK_CTES) + """
SELECT b.city, b.location_area, b.hour, b.input_date, s.model_source,
  b.label AS broad_label, b.p AS broad_probability, s.label AS specific_label, s.p AS specific_probability
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY city, location_area, hour, input_date ORDER BY p DESC, pos ASC) AS rn
      FROM probs WHERE model = 'broad') WHERE rn = 1) b
JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY city, location_area, hour, input_date ORDER BY p DESC, pos ASC) AS rn
      FROM probs WHERE model = 'specific') WHERE rn = 1) s
USING (city, location_area, hour, input_date)
"""


# --- training, sources, streaming ---------------------------------------------------------

SQL["rare_label_fold"] = with_() + """
, params AS (SELECT CAST(max(date) - INTERVAL 365 DAY AS DATE) AS train_end FROM incidents),
train AS (SELECT i.* FROM incidents i, params p WHERE i.date < p.train_end AND i.offense_category_name IS NOT NULL)
SELECT offense_category_name, count(*) AS train_count,
  CASE WHEN count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM train) < 0.02 THEN 'Other'
       ELSE offense_category_name END AS folded
FROM train GROUP BY offense_category_name
""".replace("\n, params", ", params", 1)

SQL["class_quality"] = with_(LOOKUP_CTES, RISK_CTES) + """
, truth AS (
  SELECT city, location_area, hour, date AS input_date,
    CASE WHEN offense_category_name IN (""" + CLASSES_IN + """) THEN offense_category_name ELSE 'Other' END AS y13,
    count(*) AS w
  FROM incidents WHERE city IS NOT NULL AND location_area IS NOT NULL AND offense_category_name IS NOT NULL
  GROUP BY ALL),
spec AS (SELECT * FROM probs WHERE model = 'specific'),
yhat AS (
  SELECT city, location_area, hour, input_date, label AS yhat FROM (
    SELECT *, row_number() OVER (PARTITION BY city, location_area, hour, input_date ORDER BY p DESC, pos ASC) AS rn
    FROM spec) WHERE rn = 1),
per AS (
  SELECT t.city, t.location_area, t.hour, t.input_date, t.y13, t.w,
    max(CASE WHEN s.label = t.y13 THEN s.p END) AS p_true,
    sum((s.p - CASE WHEN s.label = t.y13 THEN 1.0 ELSE 0.0 END) ^ 2) AS brier
  FROM truth t JOIN spec s USING (city, location_area, hour, input_date)
  GROUP BY ALL),
rows AS (SELECT per.*, y.yhat FROM per JOIN yhat y USING (city, location_area, hour, input_date)),
classes AS (
  SELECT c, sum(tp) AS tp, sum(t) AS support, sum(pp) AS predicted FROM (
    SELECT y13 AS c, CASE WHEN y13 = yhat THEN w ELSE 0 END AS tp, w AS t, 0 AS pp FROM rows
    UNION ALL SELECT yhat, 0, 0, w FROM rows) GROUP BY c)
SELECT CAST(sum(w) AS BIGINT) AS n,
  sum(CASE WHEN y13 = yhat THEN w ELSE 0 END) / CAST(sum(w) AS DOUBLE) AS accuracy,
  (SELECT avg(CASE WHEN support + predicted > 0 THEN 2.0 * tp / (support + predicted) ELSE 0.0 END)
   FROM classes WHERE support > 0) AS macro_f1,
  sum(w * -ln(greatest(p_true, 1e-15))) / sum(w) AS log_loss,
  sum(w * brier) / sum(w) AS brier
FROM rows
""".replace("\n, truth", ", truth", 1)

SQL["bundle_daily_city"] = SQL["daily_city_filled"]
SQL["bundle_increments_daily"] = SQL["daily_city_filled"]
SQL["bundle_increments_lookups"] = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, {cols} FROM ({SQL[key]})"
    for kind, key, cols in (
        ("loc_total", "location_totals", "NULL AS city, NULL AS hour, location_area, location_total_crimes AS amount, NULL AS label"),
        ("avg_loc", "location_daily_mean", "NULL AS city, NULL AS hour, location_area, avg_location_daily_freq AS amount, NULL AS label"),
        ("hour_typical", "hour_typical", "city, hour, NULL AS location_area, NULL AS amount, hour_typical_crime AS label"),
        ("avg_div", "hour_diversity", "city, hour, NULL AS location_area, avg_crime_diversity AS amount, NULL AS label"),
    )
)
SQL["bundle_offense_distribution"] = SQL["offense_distribution_partial"]

SQL["per_city_index"] = with_() + """
SELECT 'forecasters' AS asset_group, city, 'per_city/forecasters/' || city || '.parquet' AS path, true AS usable
FROM (SELECT DISTINCT city FROM incidents WHERE city IS NOT NULL)
UNION ALL
SELECT 'classifiers', city, 'per_city/classifiers/' || city || '.parquet', true
FROM (SELECT DISTINCT city FROM incidents WHERE city IS NOT NULL)
"""

SQL["streaming_daily_counts"] = SQL["daily_city_counts"]
SQL["streaming_merged_counts"] = SQL["daily_city_counts"]
SQL["streaming_late_counts"] = with_(DAILY_CTES) + """
SELECT * FROM counts
WHERE month(date) % 2 = 0
  AND date + INTERVAL 1 DAY <= (SELECT max(date) FROM counts WHERE month(date) % 2 = 1) - INTERVAL 2 DAY
"""

SQL["forecast_holiday_points"] = with_recursive(DAILY_CTES, _forecast_ctes()) + "SELECT * FROM forecast WHERE is_holiday = 1"
SQL["risk_class_order"] = with_(LOOKUP_CTES, RISK_CTES) + """
SELECT model, label, total_probability,
  CAST(row_number() OVER (PARTITION BY model ORDER BY total_probability DESC, label ASC) AS INTEGER) AS rank
FROM (SELECT model, label, sum(p) AS total_probability FROM probs GROUP BY model, label)
"""

# --- lookups as of a date: each scenario joined to all earlier rows of its keys ------------------

_ASOF_STATS = ",\n  ".join(
    f"CASE WHEN st.city IS NULL THEN 0.0 ELSE CAST(st.{c} AS DOUBLE) END AS {c}" for c in _LSTATS
)
_ASOF_LAST = ", ".join(
    f"(arg_max(i.{c}, i.row_order) FILTER (WHERE i.{c} IS NOT NULL)) AS {c}" for c in _LSTATS
)
SQL["lookups_as_of"] = with_(f"""
asked AS (SELECT DISTINCT city, location_area, hour, date AS d FROM incidents WHERE city IS NOT NULL AND location_area IS NOT NULL),
day_list AS (SELECT DISTINCT date FROM incidents),
n_before AS (SELECT a.d, count(l.date) AS n FROM (SELECT DISTINCT d FROM asked) a LEFT JOIN day_list l ON l.date < a.d GROUP BY a.d),
place AS (
  SELECT a.location_area, a.d, count(*) AS total FROM (SELECT DISTINCT location_area, d FROM asked) a
  JOIN incidents i ON i.location_area = a.location_area AND i.date < a.d GROUP BY ALL),
pairs AS (SELECT DISTINCT city, hour, d FROM asked),
past AS (
  SELECT p.city, p.hour, p.d, i.date, i.offense_category_clean AS o FROM pairs p
  JOIN incidents i ON i.city = p.city AND i.hour = p.hour AND i.date < p.d),
per_day AS (SELECT city, hour, d, date, count(DISTINCT o) AS k FROM past GROUP BY ALL),
div AS (SELECT city, hour, d, sum(k) AS k FROM per_day GROUP BY ALL),
typ AS (
  SELECT city, hour, d, coalesce(first(o ORDER BY (o IS NULL), n DESC, o), 'Other') AS o
  FROM (SELECT city, hour, d, o, count(*) AS n FROM past GROUP BY ALL) GROUP BY ALL),
st AS (
  SELECT a.city, a.d, {_ASOF_LAST} FROM (SELECT DISTINCT city, d FROM asked) a
  JOIN incidents i ON i.city = a.city AND i.date < a.d GROUP BY ALL),
hours AS (SELECT hour, min(date) AS lo FROM incidents GROUP BY hour)""") + f"""
SELECT a.city, a.location_area, a.hour, a.d AS input_date,
  coalesce(CAST(place.total AS DOUBLE), 100.0) AS location_total_crimes,
  coalesce(CAST(place.total AS DOUBLE) / n.n, 5.0) AS location_daily_freq,
  CASE WHEN div.k IS NOT NULL THEN CAST(div.k AS DOUBLE) / n.n WHEN st.city IS NOT NULL AND hours.lo < a.d THEN 0.0 ELSE 1.5 END AS crime_diversity,
  CASE WHEN typ.o IS NOT NULL THEN typ.o WHEN st.city IS NOT NULL AND hours.lo < a.d THEN NULL ELSE 'Other' END AS hour_typical_crime,
  {_ASOF_STATS}
FROM asked a JOIN n_before n USING (d) LEFT JOIN place USING (location_area, d) LEFT JOIN div USING (city, hour, d)
LEFT JOIN typ USING (city, hour, d) LEFT JOIN st USING (city, d) LEFT JOIN hours USING (hour)"""

SQL["rare_labels_applied"] = with_("""
train AS (SELECT offense_category_name AS o FROM incidents, (SELECT min(date) AS lo FROM incidents)
          WHERE date < lo + INTERVAL 4 DAY AND offense_category_name IS NOT NULL),
kept AS (SELECT o FROM train GROUP BY o HAVING count(*) / (SELECT count(*) FROM train) >= 0.04)""") + """
SELECT offense_category_name,
  CASE WHEN offense_category_name IS NULL THEN NULL WHEN offense_category_name IN (SELECT o FROM kept) THEN offense_category_name
       ELSE 'Other' END AS label, count(*) AS n
FROM incidents GROUP BY ALL"""

_INDEX_STATUS = {"NATION_12": "foreign path", "NATION_3": "no artifact", "NATION_5": "weights don''t fit the list", "NATION_99": "own model"}
SQL["forecast_from_index"] = with_recursive(DAILY_CTES, _forecast_ctes(dict.fromkeys(INDEX_OWN, DEMO_CITY_MODELS[INDEX_SHARED]))) + """
SELECT r.city AS "City", CASE r.city """ + " ".join(
    f"WHEN '{c}' THEN '{_INDEX_STATUS.get(c, 'own model')}'" for c in INDEX_PATHS) + """ ELSE 'no entry' END AS status,
  f."Date", f."Predicted Count", f.is_holiday, f.policy
FROM (SELECT city FROM incidents WHERE city IS NOT NULL UNION SELECT 'NATION_99') r LEFT JOIN forecast f ON f."City" = r.city"""

SQL["probability_quality"] = SQL["class_quality"].split("yhat AS (")[0] + """
events AS (
  SELECT s.label, s.p, s.label = t.y13 AS event, t.w FROM truth t JOIN spec s USING (city, location_area, hour, input_date)
  WHERE input_date >= (SELECT max(date) - INTERVAL 365 DAY FROM incidents)),
cells AS (
  SELECT label, least(CAST(floor(p * 4096) AS BIGINT), 4095) AS cell, sum(w) AS w, sum(w * p) AS wp, sum(CASE WHEN event THEN w ELSE 0 END) AS we
  FROM events GROUP BY ALL),
ranked AS (
  SELECT *, sum(w) OVER (PARTITION BY label ORDER BY cell) - w AS before, sum(w) OVER (PARTITION BY label) AS total FROM cells),
bins AS (
  SELECT 'width' AS kind, label, cell * 10 // 4096 AS bin, w, wp, we FROM cells
  UNION ALL SELECT 'weight', label, least((2 * before + w) * 10 // (2 * total), 9), w, wp, we FROM ranked)
SELECT kind, label, CAST(bin AS INTEGER) AS bin, CAST(sum(w) AS BIGINT) AS n, sum(wp) / sum(w) AS mean_probability,
  sum(we) / CAST(sum(w) AS DOUBLE) AS observed, sum(wp) / sum(w) - sum(we) / CAST(sum(w) AS DOUBLE) AS gap
FROM bins GROUP BY 1, 2, 3"""

SQL["incidents_csv_rejects"] = with_() + """
SELECT CASE WHEN day = 13 THEN 'malformed' WHEN day = 30 AND month IN (4, 6, 9, 11) THEN 'no such date' ELSE 'read' END AS kind,
  city, count(*) AS n
FROM incidents GROUP BY ALL"""

SQL["forecast_requested"] = with_recursive(DAILY_CTES, _forecast_ctes()) + """
SELECT r.ord, r.city, CAST(round_even(sum(f."Predicted Count"), 0) AS BIGINT) AS total
FROM (VALUES (0, 'NATION_7'), (1, 'NATION_99'), (2, 'NATION_12')) r(ord, city) LEFT JOIN forecast f ON f."City" = r.city
GROUP BY r.ord, r.city"""

SQL["offense_distribution_of_city"] = with_() + """
SELECT offense_category_name AS "Crime Type", count(*) AS "Count",
  CAST(row_number() OVER (ORDER BY count(*) DESC, offense_category_name) - 1 AS INTEGER) AS pos
FROM incidents WHERE city = 'NATION_7' AND year = 1999 AND offense_category_name IS NOT NULL GROUP BY 1"""
