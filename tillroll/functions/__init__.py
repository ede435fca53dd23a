"""Column -> Column helpers.  All of them are built-in Spark expressions, so
Catalyst folds them into whole-stage codegen; no Python UDFs anywhere.

Parity rules with the SQL oracle (see SURVEY 2.13): every amount is turned
into whole units of 1/10000 by one rule (:func:`money_units`), units are summed
exactly and rounded as decimals; doubles are only produced at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: Column | str) -> Column:
    """md5 of the parts cast to string and joined with '-'.

    NULL parts count as empty strings (the warehouse's ``concat`` skips NULLs),
    so a single NULL key hashes to md5('').  Parts are not escaped: ('a-b','c')
    and ('a','b-c') collide, as in the original macro.
    """
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("-"))
        parts.append(F.coalesce(col(c).cast("string"), F.lit("")))
    return F.md5(F.concat(*parts))


def cents_to_dollars(cents: Column | str) -> Column:
    return col(cents).cast("double") / F.lit(100.0)


MONEY_SCALE = 10000


def _units(c: Column | str) -> Column:
    x = col(c) * F.lit(float(MONEY_SCALE))
    return F.signum(x) * F.floor(F.abs(x) + F.lit(0.5)).cast("double")


def money_units(c: Column | str) -> Column:
    """A money amount as a whole number of 1/10000 units (bigint).

    The one rounding rule of all money: the amount times 10^4, in double
    arithmetic, to the nearest unit, halves away from zero.  For amounts below
    9.2e14 (larger ones raise an error); see :func:`money_units_wide`."""
    return _units(c).cast("bigint")


def _wide_units(c: Column | str) -> Column:
    x = col(c) * F.lit(float(MONEY_SCALE))
    # From 2^53 units on a double is a whole number of units already.
    whole = F.when(F.abs(x) < F.lit(2.0 ** 53), F.abs(x)).otherwise(F.lit(0.0))
    return F.when(F.abs(x) < F.lit(2.0 ** 53), F.signum(x) * F.floor(whole + F.lit(0.5)).cast("double")).otherwise(x)


def money_units_wide(c: Column | str) -> Column:
    """The same units as DECIMAL(38,0), for amounts of any size (totals that
    are summed again).  The branch only picks the cheaper exact cast."""
    u = _wide_units(c)
    small = F.abs(u) < F.lit(9.0e18)
    return F.when(small, F.when(small, u).cast("bigint").cast("decimal(38,0)")).otherwise(u.cast("decimal(38,0)"))


def money_sum(c: Column | str, weight: Column | str | None = None) -> Column:
    """Exact, order-independent sum of money as DECIMAL(38,4), each amount
    counted ``weight`` times when a weight is given.

    Units are added as decimals built from longs, which Spark keeps on its
    64-bit path until a running total passes 10^18 units and then widens, so
    the sum never overflows; it is scaled back once per group."""
    units = money_units_wide(c)
    if weight is not None:
        units = (units * col(weight).cast("decimal(18,0)")).cast("decimal(38,0)")
    return (F.sum(units) / F.lit(MONEY_SCALE)).cast("decimal(38,4)")


def units_to_double(units: Column | str) -> Column:
    """Units back to a double: the nearest double to the 4-decimal amount."""
    return col(units).cast("double") / F.lit(float(MONEY_SCALE))


def to_double(c: Column | str) -> Column:
    return col(c).cast("double")


def round2(c: Column | str) -> Column:
    """Round a decimal half away from zero to cents, returned as double."""
    return F.round(col(c), 2).cast("double")


def ratio2(num: Column | str, den: Column | str) -> Column:
    """round(num / den, 2) half away from zero, exactly; NULL when den is 0.

    ``num`` has at most four decimals.  Computed in integers: with u the
    numerator in 1/10000 units, cents = (|u| + 50|d|) div (100|d|), signed.
    (A decimal quotient keeps only 6 to 14 decimals and can round twice when
    the divisor is large, e.g. an average over 10^11 orders.)"""
    units = (col(num).cast("decimal(38,4)") * F.lit(MONEY_SCALE)).cast("decimal(38,0)")
    d = col(den).cast("decimal(38,0)")
    d_abs = F.abs(F.when(d != 0, d))
    cents = F.call_function("div", F.abs(units) + d_abs * F.lit(50), d_abs * F.lit(100))
    negative = (units < 0) != (d < 0)
    return F.when(negative, -cents).otherwise(cents).cast("double") / F.lit(100.0)


def pct2(part: Column | str, whole: Column | str) -> Column:
    """round(100 * part / whole, 2) exactly; NULL when whole is 0."""
    return ratio2(col(part).cast("decimal(30,0)") * F.lit(100), whole)


def whole(c: Column | str) -> Column:
    """Cast to a whole number, halves to even, like the warehouse's ``::INT``,
    but BIGINT: counts pass 2^31 at large scale (F5)."""
    return F.bround(col(c)).cast("bigint")


def day_diff(end: Column | str, start: Column | str) -> Column:
    """Whole calendar days from start to end (two-argument ``datediff``)."""
    return F.datediff(col(end), col(start)).cast("bigint")


def trunc_ts(unit: str, c: Column | str) -> Column:
    """``date_trunc`` that returns a zone-free timestamp."""
    return F.date_trunc(unit, col(c)).cast("timestamp_ntz")


def money_text(c: Column | str) -> Column:
    """'$1,234.56'; NULL renders as '$0.00'.  Rounded to cents first, so the
    formatting itself never has to round."""
    cents = F.round(F.coalesce(col(c).cast("decimal(38,4)"), F.lit(0).cast("decimal(38,4)")), 2)
    return F.concat(F.lit("$"), F.format_number(cents, 2))


def money_text_or_dash(c: Column | str) -> Column:
    """Like :func:`money_text`, but '-' for a value that is NULL or no number (F16)."""
    v = F.round(col(c).try_cast("decimal(38,4)"), 2)
    return F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.lit("$"), F.format_number(v, 2)))


def pct_text(c: Column | str) -> Column:
    """'12.34%'; NULL renders as '0.00%'."""
    v = F.round(F.coalesce(col(c).cast("decimal(38,4)"), F.lit(0).cast("decimal(38,4)")), 2)
    return F.concat(v.cast("decimal(38,2)").cast("string"), F.lit("%"))


def count_text(c: Column | str) -> Column:
    """Thousands separators for counts: 1234567 -> '1,234,567'."""
    return F.format_number(col(c).cast("decimal(38,0)"), 0)


def label_or_unknown(c: Column | str, width: int) -> Column:
    """Cut to ``width`` characters; NULL or empty becomes 'Unknown'."""
    s = col(c)
    return F.when(s.isNull() | (F.length(s) == 0), F.lit("Unknown")).otherwise(F.substring(s, 1, width))


def plural(n: Column | str, singular: str, plural_form: str) -> Column:
    return F.when(col(n) == 1, F.lit(singular)).otherwise(F.lit(plural_form))


def pad_label(label: Column | str, width: int = 22) -> Column:
    """Left-aligned label padded to ``width`` (never cut), then ': '."""
    s = col(label)
    return F.concat(F.when(F.length(s) >= width, s).otherwise(F.rpad(s, width, " ")), F.lit(": "))
