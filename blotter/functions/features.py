"""Scalar column functions.

All are built-in Column expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter.schema import (
    LOCATION_TYPE_KEYWORDS,
    OFFENSE_CLASSES,
    PROPERTY_CLASSES,
    UNIVERSITY_CITIES,
    VIOLENT_CLASSES,
)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def location_type(location_area: Column | str) -> Column:
    """broad location type by substring keyword, rules in list order, else 'other'.

    A null label is the text 'none'/'nan' in the reference and matches no keyword.
    """
    text = F.lower(_c(location_area).cast("string"))
    expr = None
    for loc_type, keywords in LOCATION_TYPE_KEYWORDS:
        cond = None
        for k in keywords:
            hit = text.contains(k)
            cond = hit if cond is None else (cond | hit)
        expr = F.when(cond, F.lit(loc_type)) if expr is None else expr.when(cond, F.lit(loc_type))
    return F.coalesce(expr.otherwise(F.lit("other")), F.lit("other"))


def offense_class(offense: Column | str) -> Column:
    """F8: fold a raw offense label into the 13 classes; anything else (and null) -> 'Other'."""
    c = _c(offense).cast("string")
    return F.when(c.isin(*OFFENSE_CLASSES), c).otherwise(F.lit("Other"))


def broad_class(offense_13: Column | str) -> Column:
    """Violent / Property / Other from a 13-class label."""
    c = _c(offense_13)
    return (
        F.when(c.isin(*VIOLENT_CLASSES), F.lit("Violent"))
        .when(c.isin(*PROPERTY_CLASSES), F.lit("Property"))
        .otherwise(F.lit("Other"))
    )


def is_university(city: Column | str) -> Column:
    """campus flag as 0/1."""
    return F.coalesce(_c(city).isin(*UNIVERSITY_CITIES), F.lit(False)).cast("int")


def per_1000(numerator: Column | str, denominator: Column | str) -> Column:
    """rate per 1000; null when the denominator is 0 (ANSI-safe)."""
    return F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double")) * F.lit(1000.0)


def clamp0(x: Column) -> Column:
    """max(x, 0)."""
    return F.greatest(x, F.lit(0.0))


def capitalize(text: Column | str) -> Column:
    """F16: Python's str.capitalize: first character upper, the rest lower."""
    c = _c(text).cast("string")
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def share_label(share: Column) -> Column:
    """'12.3%' for shares >= 2 %, else ''."""
    pct = F.bround(share * F.lit(100.0), 1)
    return F.when(share >= F.lit(0.02), F.format_string("%.1f%%", pct)).otherwise(F.lit(""))


def month_label(d: Column | str) -> Column:
    """'November 2001'."""
    return F.date_format(_c(d), "MMMM yyyy")


def day_label(d: Column | str) -> Column:
    """'Nov 05, 2001'."""
    return F.date_format(_c(d), "MMM dd, yyyy")


def horizon_end(start: Column | str, steps: int) -> Column:
    """last day of an n-day horizon."""
    return F.date_add(_c(start), steps - 1)
