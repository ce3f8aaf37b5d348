"""Calendar features (F2-F6, S9, J8) as pure Column expressions.

The holiday calendar is a predicate on a date column built from rules
(fixed dates with weekend observance, n-th weekday rules, Good Friday from
the Gregorian computus), so d, d+1 and d-1 flags need no join at all, and
``holidays(spark, ...)`` materialises the same rules as a dimension table.
The reference takes its calendar from a package that is not available
here; this rule set is ours, and a caller table can replace it
(``holiday_flags_from_table``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The holiday rules (US federal + Connecticut)
# ---------------------------------------------------------------------------

# (name, month, day, first year or None); observed on Friday/Monday when on Saturday/Sunday.
FIXED_HOLIDAYS = [
    ("New Year's Day", 1, 1, None),
    ("Lincoln's Birthday", 2, 12, None),
    ("Juneteenth National Independence Day", 6, 19, 2021),
    ("Independence Day", 7, 4, None),
    ("Veterans Day", 11, 11, None),
    ("Christmas Day", 12, 25, None),
]

# (name, month, weekday Monday=0, n-th occurrence or -1 for the last, first year or None).
WEEKDAY_HOLIDAYS = [
    ("Martin Luther King Jr. Day", 1, 0, 3, 1986),
    ("Washington's Birthday", 2, 0, 3, None),
    ("Memorial Day", 5, 0, -1, None),
    ("Labor Day", 9, 0, 1, None),
    ("Columbus Day", 10, 0, 2, None),
    ("Thanksgiving", 11, 3, 4, None),
]

GOOD_FRIDAY = "Good Friday"

TWO_PI = 2.0 * math.pi


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- F4 / F5 / F3 -------------------------------------------------------------


def weekday(d: Column | str) -> Column:
    """Monday = 0 (Q11)."""
    return F.weekday(_c(d))


def quarter(d: Column | str) -> Column:
    return F.quarter(_c(d))


def iso_week(d: Column | str) -> Column:
    """ISO week number (Q12)."""
    return F.weekofyear(_c(d))


def cyclic(x: Column, period: float) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*x/period."""
    angle = F.lit(TWO_PI) * x.cast("double") / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def weekend_flags(d: Column | str) -> dict[str, Column]:
    """is_weekend, is_monday, is_friday as 0/1."""
    wd = weekday(d)
    return {
        "is_weekend": wd.isin(5, 6).cast("int"),
        "is_monday": (wd == 0).cast("int"),
        "is_friday": (wd == 4).cast("int"),
    }


# --- F2 -------------------------------------------------------------------------


def payday_features(d: Column | str) -> dict[str, Column]:
    """is_payday (day 1, 15 or the month's last) and days to the nearest of them."""
    dom = F.dayofmonth(_c(d))
    last = F.dayofmonth(F.last_day(_c(d)))
    return {
        "is_payday": (dom.isin(1, 15) | (dom == last)).cast("int"),
        "days_from_payday": F.least(F.abs(dom - 1), F.abs(dom - 15), F.abs(dom - last)),
    }


# --- F6 -------------------------------------------------------------------------


def circular_doy_distance(a: Column, b: Column, base: int = 366) -> Column:
    """min(|a-b|, base-|a-b|), base 366 always."""
    d = F.abs(a - b)
    return F.least(d, F.lit(base) - d)


# --- S9 / J8: holidays ----------------------------------------------------------


def _idiv(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b)).cast("int")


def easter(year: Column) -> Column:
    """Gregorian Easter Sunday (anonymous computus) for a year column."""
    y = year.cast("int")
    a = y % 19
    b = _idiv(y, 100)
    c = y % 100
    d = _idiv(b, 4)
    e = b % 4
    f = _idiv(b + 8, 25)
    g = _idiv(b - f + 1, 3)
    h = (19 * a + b - d - g + 15) % 30
    i = _idiv(c, 4)
    k = c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = _idiv(a + 11 * h + 22 * l_, 451)
    month = _idiv(h + l_ - 7 * m + 114, 31)
    day = (h + l_ - 7 * m + 114) % 31 + 1
    return F.make_date(y, month, day)


def _fixed_on(d: Column, month: int, day: int, since: int | None) -> Column:
    cond = (F.month(d) == month) & (F.dayofmonth(d) == day)
    if since is not None:
        cond = cond & (F.year(d) >= since)
    return cond


def _nth_weekday(d: Column, month: int, wd: int, n: int, since: int | None) -> Column:
    dom = F.dayofmonth(d)
    cond = (F.month(d) == month) & (weekday(d) == wd)
    if n > 0:
        cond = cond & (dom > 7 * (n - 1)) & (dom <= 7 * n)
    else:
        cond = cond & (F.date_add(d, 7) > F.last_day(d))
    if since is not None:
        cond = cond & (F.year(d) >= since)
    return cond


def _holiday_rules(d: Column) -> list[tuple[Column, str]]:
    wd = weekday(d)
    rules = [(_fixed_on(d, month, day, since), name) for name, month, day, since in FIXED_HOLIDAYS]
    rules += [(_nth_weekday(d, month, wdn, n, since), name) for name, month, wdn, n, since in WEEKDAY_HOLIDAYS]
    # Easter only matters in March/April; the guard short-circuits the computus elsewhere
    rules.append((F.month(d).isin(3, 4) & (d == F.date_sub(easter(F.year(d)), 2)), GOOD_FRIDAY))
    for name, month, day, since in FIXED_HOLIDAYS:
        rules.append(((wd == 4) & _fixed_on(F.date_add(d, 1), month, day, since), f"{name} (observed)"))
        rules.append(((wd == 0) & _fixed_on(F.date_sub(d, 1), month, day, since), f"{name} (observed)"))
    return rules


def holiday_name(d: Column | str) -> Column:
    """Name of the holiday on d (observed days get ' (observed)'), else null."""
    expr = None
    for cond, name in _holiday_rules(_c(d)):
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def is_holiday(d: Column | str) -> Column:
    """0/1: any rule matches (a plain disjunction, cheaper than the named CASE)."""
    cond = None
    for c, _ in _holiday_rules(_c(d)):
        cond = c if cond is None else (cond | c)
    return cond.cast("int")


def holiday_flags(d: Column | str) -> dict[str, Column]:
    """Holiday on d, on d+1 (day before a holiday), on d-1 (day after)."""
    d = _c(d)
    return {
        "is_holiday": is_holiday(d),
        "is_day_before_holiday": is_holiday(F.date_add(d, 1)),
        "is_day_after_holiday": is_holiday(F.date_sub(d, 1)),
    }


def holiday_flag_table(spark: SparkSession, first: Column, last: Column) -> DataFrame:
    """J8 for a date range as a small table (date, is_holiday, is_day_before_holiday,
    is_day_after_holiday): the predicate is evaluated once per day of the range
    (plus one day each side) and the neighbour flags come from lead/lag over
    the range, which is bounded by the horizon, not by the data."""
    days = spark.range(1).select(F.explode(F.sequence(F.date_sub(first, 1), F.date_add(last, 1))).alias("date"))
    h = days.select("date", is_holiday("date").alias("h"))
    w = Window.orderBy("date")
    return h.select(
        "date",
        F.col("h").alias("is_holiday"),
        F.coalesce(F.lead("h").over(w), F.lit(0)).alias("is_day_before_holiday"),
        F.coalesce(F.lag("h").over(w), F.lit(0)).alias("is_day_after_holiday"),
    ).where((F.col("date") >= first) & (F.col("date") <= last))


def holidays(spark: SparkSession, first_year: int | Column, last_year: int | Column) -> DataFrame:
    """The holiday dimension (date, name) for a year range; the range may be
    scalar-subquery Columns derived from data."""
    lo = first_year if isinstance(first_year, Column) else F.lit(first_year)
    hi = last_year if isinstance(last_year, Column) else F.lit(last_year)
    days = spark.range(1).select(
        F.explode(F.sequence(F.make_date(lo, F.lit(1), F.lit(1)), F.make_date(hi, F.lit(12), F.lit(31)))).alias("date")
    )
    return days.select("date", holiday_name("date").alias("name")).where(F.col("name").isNotNull())


def holiday_flags_from_table(df: DataFrame, date_col: str, table: DataFrame) -> DataFrame:
    """J8 against a caller-supplied holiday table (date, name): three left joins
    on the holiday dimension, broadcast behind a row-count check."""

    h = table.select(F.col("date").alias("_h")).distinct()
    out = df
    for name, shift in (("is_holiday", 0), ("is_day_before_holiday", 1), ("is_day_after_holiday", -1)):
        key = F.date_add(F.col(date_col), shift)
        out = out.join(h.withColumnRenamed("_h", f"_h_{name}"), key == F.col(f"_h_{name}"), "left")
        out = out.withColumn(name, F.col(f"_h_{name}").isNotNull().cast("int")).drop(f"_h_{name}")
    return out


# --- DuckDB text of the same rules (oracle side) --------------------------------


def holiday_sql(d: str) -> str:
    """DuckDB boolean expression: is d a holiday under the rules above."""
    return "(" + " OR ".join(c for c, _ in _holiday_sql_rules(d)) + ")"


def holiday_name_sql(d: str) -> str:
    """DuckDB CASE expression: the holiday's name on d, else NULL (first rule wins)."""
    whens = " ".join(f"WHEN {c} THEN '{n.replace(chr(39), chr(39) * 2)}'" for c, n in _holiday_sql_rules(d))
    return f"(CASE {whens} END)"


def _holiday_sql_rules(d: str) -> list[tuple[str, str]]:

    def fixed(x, month, day, since):
        s = f"(month({x}) = {month} AND day({x}) = {day}"
        if since is not None:
            s += f" AND year({x}) >= {since}"
        return s + ")"

    def nth(x, month, wd, n, since):
        s = f"(month({x}) = {month} AND isodow({x}) - 1 = {wd}"
        if n > 0:
            s += f" AND day({x}) > {7 * (n - 1)} AND day({x}) <= {7 * n}"
        else:
            s += f" AND CAST({x} + INTERVAL 7 DAY AS DATE) > last_day({x})"
        if since is not None:
            s += f" AND year({x}) >= {since}"
        return s + ")"

    y = f"year({d})"
    a = f"({y} % 19)"
    b = f"({y} // 100)"
    c = f"({y} % 100)"
    dd = f"({b} // 4)"
    e = f"({b} % 4)"
    f_ = f"(({b} + 8) // 25)"
    g = f"(({b} - {f_} + 1) // 3)"
    h = f"((19 * {a} + {b} - {dd} - {g} + 15) % 30)"
    i = f"({c} // 4)"
    k = f"({c} % 4)"
    l_ = f"((32 + 2 * {e} + 2 * {i} - {h} - {k}) % 7)"
    m = f"(({a} + 11 * {h} + 22 * {l_}) // 451)"
    em = f"(({h} + {l_} - 7 * {m} + 114) // 31)"
    ed = f"((({h} + {l_} - 7 * {m} + 114) % 31) + 1)"
    good_friday = f"({d} = CAST(make_date(CAST({y} AS INTEGER), CAST({em} AS INTEGER), CAST({ed} AS INTEGER)) - INTERVAL 2 DAY AS DATE))"

    nxt = f"CAST({d} + INTERVAL 1 DAY AS DATE)"
    prv = f"CAST({d} - INTERVAL 1 DAY AS DATE)"
    rules = [(fixed(d, mo, da, s), n) for n, mo, da, s in FIXED_HOLIDAYS]
    rules += [(nth(d, mo, wd, k, s), n) for n, mo, wd, k, s in WEEKDAY_HOLIDAYS]
    rules.append((good_friday, GOOD_FRIDAY))
    for n, mo, da, s in FIXED_HOLIDAYS:
        rules.append((f"(isodow({d}) = 5 AND {fixed(nxt, mo, da, s)})", f"{n} (observed)"))
        rules.append((f"(isodow({d}) = 1 AND {fixed(prv, mo, da, s)})", f"{n} (observed)"))
    return rules
