"""Column expressions shared by the operators. All JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's output text) -----------------
# Day names for DayOfWeek 0..6, Monday first.
WEEKDAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday",
                 "Saturday", "Sunday"]
# Month names for Month 1..12.
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December"]
# Name given to a product code that has no usable description.
UNKNOWN_PRODUCT = "Unknown Product"
# Text shown for an item missing from the product lookup ("no description").
NO_DESCRIPTION = "Không có mô tả"
# Segment labels for RFM_Score bins (0,3], (3,6], (6,9].
SEGMENTS = ["Low Value", "Mid Value", "High Value"]
# -----------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_sum(c) -> Column:
    """Sum of a money column, as double.

    Values are added as decimals with six places (38 digits in all), so the
    result does not depend on partitioning or row order, keeps parts of a
    cent and can't overflow; it becomes a double once, at the end. What no
    such decimal holds (over 10**22, not finite) is added as doubles.
    """
    value = _c(c)
    exact = value.try_cast("decimal(28,6)")
    rest = F.sum(F.when(exact.isNull(), value.cast("double")))
    whole = F.sum(exact).cast("double")
    return F.when(rest.isNull(), whole).otherwise(F.coalesce(whole, F.lit(0.0)) + rest)


def weekday_name(c) -> Column:
    """Monday=0 .. Sunday=6 -> English day name."""
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), _c(c) + 1)


def year_month_label(year, month) -> Column:
    """``YYYY-MM`` label."""
    return F.format_string("%d-%02d", _c(year), _c(month))


def month_year_label(year, month) -> Column:
    """``January 2011`` label."""
    return F.concat_ws(" ", F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), _c(month)),
                       _c(year).cast("string"))


def truncate_text(c, width: int = 75) -> Column:
    """Cut text longer than ``width`` characters to ``width`` + ``...``."""
    c = _c(c)
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit("..."))).otherwise(c)


def list_repr(arr) -> Column:
    """Render an array of strings the way a Python list prints: ``['a', 'b']``,
    double quotes for an item that holds apostrophes only, escapes for
    backslashes, line feeds, tabs and returns."""
    def quoted_item(x: Column) -> Column:
        for plain, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            x = F.replace(x, F.lit(plain), F.lit(shown))
        double = F.contains(x, F.lit("'")) & ~F.contains(x, F.lit('"'))
        single = F.concat(F.lit("'"), F.replace(x, F.lit("'"), F.lit("\\'")), F.lit("'"))
        return F.when(double, F.concat(F.lit('"'), x, F.lit('"'))).otherwise(single)

    quoted = F.transform(_c(arr), quoted_item)
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
