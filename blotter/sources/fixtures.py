"""Adapter: incident rows in the reference's 13-column contract, made from the
driver's TPC-H-shaped tables (mapping in FIXTURES.md section 2).

One pass over lineitem; orders get their customer's nation first, so that the
lineitem rows are shuffled by order and by part only and carry keys and days, not
names and timestamps. Orders are hashed a partition, so that lineitem is streamed by
them and neither sorted nor spilled; the other joins are shuffle joins at scale, which
AQE may turn into broadcasts. What the order key tells is worked out before the part comes in.
nation is a fixed 25-row dimension and is broadcast last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the test mapping (FIXTURES.md section 2)
# ---------------------------------------------------------------------------

# location_area by p_size % 13, index 0..11 (12 -> null).
FIXTURE_LOCATIONS = [
    "Residence/Home",
    "Highway/Road/Alley/Street/Sidewalk",
    "Parking/Drop Lot/Garage",
    "Commercial/Office Building",
    "School-Elementary/Secondary",
    "Bar/Nightclub",
    "Grocery/Supermarket",
    "Department/Discount Store",
    "Shelter-Mission/Homeless",
    "Field/Woods",
    "Convenience Store",
    "Hotel/Motel",
]

# offense by brand number 1..24 (25 -> null): the 13 classes, then eleven that fold into Other.
FIXTURE_OFFENSES = [
    "Assault Offenses",
    "Burglary/Breaking & Entering",
    "Counterfeiting/Forgery",
    "Destruction/Damage/Vandalism of Property",
    "Drug/Narcotic Offenses",
    "Fraud Offenses",
    "Larceny/Theft Offenses",
    "Motor Vehicle Theft",
    "Other",
    "Robbery",
    "Sex Offenses",
    "Stolen Property Offenses",
    "Weapon Law Violations",
    "Arson",
    "Bribery",
    "Embezzlement",
    "Extortion/Blackmail",
    "Gambling Offenses",
    "Homicide Offenses",
    "Kidnapping/Abduction",
    "Animal Cruelty",
    "Prostitution Offenses",
    "Human Trafficking",
    "Pornography/Obscene Material",
]


def _pick(index: Column, values: list[str], base: int) -> Column:
    """values[index - base] or null when out of range."""
    arr = F.array(*[F.lit(v) for v in values])
    pos = index - F.lit(base) + F.lit(1)
    return F.when((pos >= 1) & (pos <= len(values)), F.try_element_at(arr, pos.cast("int")))


def _round4(x: Column) -> Column:
    """``round(x, 4)``, whose decimal arithmetic only large values and those next to a tie need."""
    shifted = x * F.lit(10000.0)
    tie = F.abs(shifted - F.floor(shifted) - F.lit(0.5)) < F.lit(1e-4)
    return F.when(~tie & (F.abs(x) < 1e6), F.floor(shifted + F.lit(0.5)) / F.lit(10000.0)).otherwise(F.round(x, 4))


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incident rows in the raw contract plus ``row_order`` (file-order stand-in)."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("day")
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey", (F.col("p_size") % 13).alias("place"), F.substring(F.col("p_brand"), 7, 10).alias("brand")
    )

    d = F.col("day")
    y = F.year(d)
    nk = F.col("c_nationkey")
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    keyed = (
        li.join(placed.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
        .where(~((nk == 0) & (y < 1997)) & ~((nk == 24) & (y > 2000)))
        .select(
            "l_partkey",
            "day",
            "c_nationkey",
            F.when(F.col("l_orderkey") % 50 == 0, F.lit(None).cast("int"))
            .otherwise((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 24)
            .cast("tinyint")
            .alias("hour"),
            (F.col("l_orderkey") % 211 == 0).alias("unnamed"),
        )
    )
    base = keyed.join(part, F.col("l_partkey") == F.col("p_partkey")).join(
        F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")
    )
    nk = F.col("n_nationkey")
    years_in = y - F.lit(1995)
    pop_formula = F.lit(20000) + F.lit(1500) * nk + F.lit(250) * years_in
    officers = (
        F.lit(50) + F.lit(3) * nk + F.lit(2) * years_in + F.when(F.dayofmonth(d) >= 16, 1).otherwise(0)
    ).cast("int")
    female = F.floor(officers / F.lit(5)).cast("int")
    rate_null = (nk == 7) & (y < 1998)
    brand_n = F.col("brand").cast("int")
    return base.select(
        y.cast("int").alias("year"),
        F.month(d).cast("int").alias("month"),
        F.dayofmonth(d).cast("int").alias("day"),
        F.col("hour").cast("int").alias("hour"),
        F.when(F.col("unnamed"), F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("city"),
        _pick(F.col("place"), FIXTURE_LOCATIONS, 0).alias("location_area"),
        _pick(brand_n, FIXTURE_OFFENSES, 1).alias("offense_category_name"),
        F.when((nk == 3) & (y == 1996), F.lit(None).cast("int")).otherwise(pop_formula.cast("int")).alias("population"),
        officers.alias("total_officers"),
        (officers - female).cast("int").alias("male_officer"),
        female.alias("female_officer"),
        F.when(rate_null, F.lit(None).cast("double"))
        .otherwise(_round4(officers * F.lit(1000.0) / pop_formula).cast("double"))
        .alias("officers_per_1000_people"),
        F.when(rate_null, F.lit(None).cast("double"))
        .otherwise((F.lit(10) + nk + years_in).cast("double"))
        .alias("crime_rate_per_1000_people"),
        d.alias("row_order"),
    )


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed incidents (S2) over the adapter."""
    from blotter.sources.incidents import type_incidents

    return type_incidents(raw_incidents(spark, sf_dir))


# DuckDB text of the same mapping, used by the oracle SQL.
FIXTURE_SQL_RAW = """
raw_incidents AS (
  SELECT
    CAST(year(CAST(l.l_shipdate AS DATE)) AS INTEGER) AS year,
    CAST(month(CAST(l.l_shipdate AS DATE)) AS INTEGER) AS month,
    CAST(day(CAST(l.l_shipdate AS DATE)) AS INTEGER) AS day,
    CASE WHEN l.l_orderkey % 50 = 0 THEN NULL
         ELSE CAST((l.l_orderkey * 7 + l.l_linenumber) % 24 AS INTEGER) END AS hour,
    CASE WHEN l.l_orderkey % 211 = 0 THEN NULL ELSE n.n_name END AS city,
    ({loc_list})[CAST(p.p_size % 13 AS INTEGER) + 1] AS location_area,
    CASE WHEN CAST(substring(p.p_brand, 7) AS INTEGER) BETWEEN 1 AND 24
         THEN ({off_list})[CAST(substring(p.p_brand, 7) AS INTEGER)] END AS offense_category_name,
    CASE WHEN n.n_nationkey = 3 AND year(l.l_shipdate) = 1996 THEN NULL
         ELSE CAST(20000 + 1500 * n.n_nationkey + 250 * (year(l.l_shipdate) - 1995) AS INTEGER) END AS population,
    CAST(50 + 3 * n.n_nationkey + 2 * (year(l.l_shipdate) - 1995)
         + CASE WHEN day(l.l_shipdate) >= 16 THEN 1 ELSE 0 END AS INTEGER) AS total_officers,
    CAST(50 + 3 * n.n_nationkey + 2 * (year(l.l_shipdate) - 1995)
         + CASE WHEN day(l.l_shipdate) >= 16 THEN 1 ELSE 0 END AS INTEGER)
      - CAST(floor((50 + 3 * n.n_nationkey + 2 * (year(l.l_shipdate) - 1995)
         + CASE WHEN day(l.l_shipdate) >= 16 THEN 1 ELSE 0 END) / 5) AS INTEGER) AS male_officer,
    CAST(floor((50 + 3 * n.n_nationkey + 2 * (year(l.l_shipdate) - 1995)
         + CASE WHEN day(l.l_shipdate) >= 16 THEN 1 ELSE 0 END) / 5) AS INTEGER) AS female_officer,
    CASE WHEN n.n_nationkey = 7 AND year(l.l_shipdate) < 1998 THEN NULL
         ELSE CAST(round((50 + 3 * n.n_nationkey + 2 * (year(l.l_shipdate) - 1995)
           + CASE WHEN day(l.l_shipdate) >= 16 THEN 1 ELSE 0 END) * 1000.0
           / (20000 + 1500 * n.n_nationkey + 250 * (year(l.l_shipdate) - 1995)), 4) AS DOUBLE) END
      AS officers_per_1000_people,
    CASE WHEN n.n_nationkey = 7 AND year(l.l_shipdate) < 1998 THEN NULL
         ELSE CAST(10 + n.n_nationkey + (year(l.l_shipdate) - 1995) AS DOUBLE) END AS crime_rate_per_1000_people,
    CAST(l.l_shipdate AS DATE) AS row_order
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
  WHERE NOT (n.n_nationkey = 0 AND year(l.l_shipdate) < 1997)
    AND NOT (n.n_nationkey = 24 AND year(l.l_shipdate) > 2000)
),
incidents AS (
  SELECT
    make_date(year, month, day) AS date,
    year, month, day,
    coalesce(hour, 0) AS hour,
    city, location_area, offense_category_name,
    offense_category_name AS offense_category_clean,
    coalesce(population, 0) AS population,
    coalesce(total_officers, 0) AS total_officers,
    coalesce(male_officer, 0) AS male_officer,
    coalesce(female_officer, 0) AS female_officer,
    officers_per_1000_people,
    crime_rate_per_1000_people,
    row_order
  FROM raw_incidents
)
"""


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def fixture_sql() -> str:
    """CTE text defining ``raw_incidents`` and ``incidents`` for DuckDB."""
    return FIXTURE_SQL_RAW.format(loc_list=_sql_list(FIXTURE_LOCATIONS), off_list=_sql_list(FIXTURE_OFFENSES))
