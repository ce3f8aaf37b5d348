"""Schemas and fixed domains.

Everything under "Fixed values" must equal the reference's contract for
results to match; it is written out plainly, in the reference's order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's contract)
# ---------------------------------------------------------------------------

# Raw incident columns, in contract order.
INCIDENT_COLUMNS = [
    "year",
    "month",
    "day",
    "hour",
    "city",
    "location_area",
    "offense_category_name",
    "population",
    "total_officers",
    "male_officer",
    "female_officer",
    "officers_per_1000_people",
    "crime_rate_per_1000_people",
]

# Staffing columns carried on the daily series.
STAT_COLS = [
    "population",
    "total_officers",
    "male_officer",
    "female_officer",
    "officers_per_1000_people",
    "crime_rate_per_1000_people",
]

# Staffing columns used by lookups and forecasts.
LOOKUP_STAT_COLS = [
    "population",
    "total_officers",
    "officers_per_1000_people",
    "crime_rate_per_1000_people",
]

# Broad location types (the encoder's domain, in this order).
LOCATION_TYPES = [
    "commercial",
    "education",
    "nightlife",
    "other",
    "residential",
    "retail",
    "street",
]

# Keyword rules for location types: checked in this order, first hit wins.
LOCATION_TYPE_KEYWORDS = [
    ("commercial", ["office", "building", "bank", "company", "business"]),
    ("education", ["school", "college", "university", "campus"]),
    ("nightlife", ["bar", "restaurant", "nightclub", "club", "tavern"]),
    ("retail", ["store", "shop", "market", "mall", "retail"]),
    ("residential", ["residence", "home", "apartment", "house", "roof"]),
    ("street", ["street", "highway", "road", "alley", "sidewalk", "parking"]),
]

# The 13 specific offense classes.
OFFENSE_CLASSES = [
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
]

# Broad offense classes (label order of the broad encoder) and their members.
BROAD_CLASSES = ["Other", "Property", "Violent"]
VIOLENT_CLASSES = ["Assault Offenses", "Sex Offenses", "Robbery"]
PROPERTY_CLASSES = [
    "Larceny/Theft Offenses",
    "Burglary/Breaking & Entering",
    "Motor Vehicle Theft",
    "Stolen Property Offenses",
]

# Campus "cities".
UNIVERSITY_CITIES = [
    "Yale University",
    "Southern Connecticut State University",
    "Western Connecticut State University",
    "Eastern Connecticut State University",
    "Central Connecticut State University",
    "University of Connecticut:",
    "University of Connecticut: Trumbull",
]

# Forecast constants.
FORECAST_DAYS = 30
BLEND_WEIGHTS = {"model": 0.60, "analog": 0.25, "recent": 0.10, "seasonal": 0.05}
TREND_WEIGHT = 0.08
TREND_MIN_BUFFER = 14
ANALOG_HALF_WINDOW = 14
DOY_BASE = 366
RECENT_DAYS = 14
SEED_ROWS = 30
SEED_BUFFER = 14
SEED_MIN = 7

# Lookup defaults when a key is absent.
DEFAULT_LOCATION_TOTAL = 100.0
DEFAULT_LOCATION_DAILY = 5.0
DEFAULT_DIVERSITY = 1.5
DEFAULT_TYPICAL_OFFENSE = "Other"
DEFAULT_STAT = 0.0

TOP_SPECIFIC = 5
MAX_COMPARE = 2

# Forecast model features, in model order.
FORECAST_FEATURES = [
    "lag_1",
    "lag_3",
    "lag_7",
    "roll_mean_7",
    "rolling_mean_7",
    "roll_std_7",
    "rolling_std_7",
    "roll_max_7",
    "roll_min_7",
    "day_of_week",
    "month",
    "quarter",
    "day_of_year",
    "is_weekend",
    "is_monday",
    "is_friday",
    "month_sin",
    "month_cos",
    "dow_sin",
    "dow_cos",
    "is_holiday",
    "is_day_before_holiday",
    "is_day_after_holiday",
    "population",
    "total_officers",
    "officers_per_1000_people",
    "crime_rate_per_1000_people",
]

# Risk classifier features, in model order.
RISK_FEATURES = [
    "city",
    "location_area",
    "location_type",
    "hour",
    "hour_sin",
    "hour_cos",
    "dayofweek",
    "dow_sin",
    "dow_cos",
    "month",
    "month_sin",
    "month_cos",
    "day_of_month",
    "day_of_month_sin",
    "day_of_month_cos",
    "week_of_year",
    "week_sin",
    "week_cos",
    "is_weekend",
    "is_holiday",
    "is_payday",
    "days_from_payday",
    "is_university",
    "crime_diversity",
    "location_daily_freq",
    "location_total_crimes",
    "population",
    "total_officers",
    "officers_per_1000_people",
    "crime_rate_per_1000_people",
    "hour_typical_crime",
]

BUNDLE_TABLES = ["daily_city", "officer_trends", "crime_distribution", "location_areas", "years"]
BUNDLE_SCHEMA_MAJOR = "2"
MODEL_GROUPS = ["forecasters", "classifiers"]
PER_CITY_PREFIX = "per_city/"

# ---------------------------------------------------------------------------
# Spark schemas
# ---------------------------------------------------------------------------

RAW_INCIDENT_SCHEMA = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("city", T.StringType()),
        T.StructField("location_area", T.StringType()),
        T.StructField("offense_category_name", T.StringType()),
        T.StructField("population", T.IntegerType()),
        T.StructField("total_officers", T.IntegerType()),
        T.StructField("male_officer", T.IntegerType()),
        T.StructField("female_officer", T.IntegerType()),
        T.StructField("officers_per_1000_people", T.DoubleType()),
        T.StructField("crime_rate_per_1000_people", T.DoubleType()),
    ]
)
