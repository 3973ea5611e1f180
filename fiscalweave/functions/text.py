"""Names, period labels, number parsing and display formatting as built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# -- owner names -------------------------------------------------------------------------------


def normalize_name(name: Column) -> Column:
    """Lower-case, apostrophes dropped, commas and periods read as blanks, blanks collapsed."""
    text = F.translate(F.coalesce(name, F.lit("")), ",.'’", "  ")
    return F.lower(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))


def token_key(name: Column) -> Column:
    """Word tokens of the normalised name in sorted order: equal for pure reorderings."""
    return F.array_join(F.array_sort(F.split(normalize_name(name), " ")), " ")


def email_alias(email: Column) -> Column:
    """Local part of an address as a name; NULL when there is no '@'."""
    return F.when(F.contains(email, F.lit("@")),
                  F.translate(F.substring_index(email, "@", 1), "_", " "))


# -- week and period labels --------------------------------------------------------------------

# The label forms in use.
_WEEK = r"(?i)W\s*K?\s*(\d+)"
_PERIOD = r"(?i)FY\s*(\d+)\s*Q\s*(\d+)"
_QUARTER = r"Q\d+"


def week_number(label: Column) -> Column:
    """'W40', 'WK1' and 'W40 May 1-2' to their week number, anything else to NULL."""
    return F.regexp_extract(label, _WEEK, 1).try_cast("int")


def fold_label(label: Column) -> Column:
    """Comparable column label: no blanks, lower case, a leading 'wk<n>' read as 'w<n>'."""
    return F.regexp_replace(F.lower(F.regexp_replace(label, r"\s+", "")), r"^wk(\d)", "w$1")


def parse_period(label: Column) -> tuple[Column, Column]:
    """(fiscal year as written, quarter) of a label such as 'FY27 Q1'; NULLs when absent."""
    return (F.regexp_extract(label, _PERIOD, 1).try_cast("int"),
            F.regexp_extract(label, _PERIOD, 2).try_cast("int"))


def short_year(fy: Column) -> Column:
    """Two-digit fiscal year: 2026 and 26 both become 26."""
    return F.when(fy >= 2000, fy - 2000).otherwise(fy)


def next_quarter(fy: Column, qtr: Column) -> tuple[Column, Column]:
    return F.when(qtr < 4, fy).otherwise(fy + 1), F.when(qtr < 4, qtr + 1).otherwise(F.lit(1))


def period_rank(fy: Column, qtr: Column) -> Column:
    return fy * 10 + qtr


def period_label(fy: Column, qtr: Column) -> Column:
    return F.concat(F.lit("FY"), short_year(fy).cast("string"), F.lit(" Q"), qtr.cast("string"))


def date_range_label(start: Column, end: Column) -> Column:
    """'May 1-2', 'May 31-Jun 6', or 'May 1' when the end is unknown; '' without a start."""
    first = F.date_format(start, "MMM d")
    same_month = F.date_format(start, "MMM") == F.date_format(end, "MMM")
    last = F.when(same_month, F.date_format(end, "d")).otherwise(F.date_format(end, "MMM d"))
    return (F.when(start.isNull(), "").when(end.isNull(), first)
            .otherwise(F.concat(first, F.lit("-"), last)))


def day_count_label(days: Column, full_week: int = 7) -> Column:
    """'N days' over a partial week, blank over a full one."""
    return F.when((days > 0) & (days < full_week),
                  F.concat(days.cast("string"), F.lit(" days"))).otherwise("")


def week_header(week: Column, start: Column, end: Column, days: Column, full_week: int = 7) -> Column:
    """'W41', with the date range added on partial weeks."""
    name = F.concat(F.lit("W"), week.cast("string"))
    return F.when(days < full_week,
                  F.concat(name, F.lit(" "), date_range_label(start, end))).otherwise(name)


def relabel_period(label: Column, old: Column, new: Column) -> Column:
    """The label with every occurrence of the old period tag replaced."""
    return F.replace(label, old, new)


def names_other_period(label: Column, old: Column, also: Sequence[str] = ()) -> Column:
    """True where a label mentions some period, but not the one being replaced.

    A period is a fiscal year before a quarter, or before one of the words in ``also``, which are
    regular expressions.
    """
    mentions = F.regexp_like(label, F.lit(rf"(?i)FY\d+\s*({'|'.join([_QUARTER, *also])})"))
    return mentions & ~F.contains(label, old)


# -- numbers as text ---------------------------------------------------------------------------


def parse_number(text: Column) -> Column:
    """Number behind thousands separators, currency and percent signs; NULL when not a number.

    Strict: trailing garbage makes the whole value NULL rather than a numeric prefix. Words such
    as 'NaN' or 'Infinity', which Spark would cast to doubles, are NULL as well.
    """
    bare = F.regexp_replace(text, r"[,%$\s]", "")
    return F.when(F.regexp_like(bare, F.lit(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")), bare
                  ).try_cast("double")


def half_up(x: Column) -> Column:
    """Nearest whole number, halves towards positive infinity (display rounding)."""
    return F.floor(x + 0.5)


def format_percent(text: Column) -> Column:
    """Percent text: magnitudes below 2 are ratios and get multiplied by 100."""
    n = parse_number(text)
    scaled = F.when((F.abs(n) < 2) & (n != 0), n * 100).otherwise(n)
    return (F.when(text.isNull() | (text == ""), "")
            .when(F.contains(text, F.lit("%")) | n.isNull(), text)
            .otherwise(F.concat(half_up(scaled).cast("string"), F.lit("%"))))


def format_number(text: Column) -> Column:
    """Whole-number text, one decimal for small fractions; placeholders and formatted text pass."""
    n = parse_number(text)
    keep = F.contains(text, F.lit("%")) | F.contains(text, F.lit(",")) | n.isNull()
    tenths = half_up(n * 10)
    small = F.when(tenths % 10 == 0, F.floor(tenths / 10).cast("string")).otherwise(
        (tenths / 10).cast("string"))
    return (F.when(text.isNull() | (text == ""), "").when(keep, text)
            .when((F.abs(n) < 10) & (n != F.floor(n)), small)
            .otherwise(half_up(n).cast("string")))


def format_whole(text: Column) -> Column:
    """Text with a decimal point rounded to a whole number; everything else as it is."""
    n = parse_number(text)
    return (F.when(text.isNull(), "").when(F.contains(text, F.lit(".")) & n.isNotNull(),
                                           half_up(n).cast("string")).otherwise(text))


def format_thousands(text: Column) -> Column:
    """Cell text: whole numbers with thousands separators, all other text trimmed."""
    n = parse_number(text)
    trimmed = F.trim(text)
    return (F.when(text.isNull() | trimmed.isin("", "."), "")
            .when(~F.contains(text, F.lit("%")) & (n == F.floor(n)), F.format_number(n, 0))
            .otherwise(trimmed))


def signed(n: Column, zero: str = "0") -> Column:
    """'+3', '-3', and ``zero`` for nothing; NULL in gives NULL out."""
    text = n.cast("string")
    return F.when(n > 0, F.concat(F.lit("+"), text)).when(n < 0, text).when(n == 0, F.lit(zero))


def signed_variance(actual: Column, forecast: Column) -> Column:
    """Signed difference of two displayed numbers ('+0' when equal), '' when either is not one."""
    diff = F.round(parse_number(actual) - parse_number(forecast), 10)
    plain = F.regexp_replace(diff.cast("decimal(38,10)").cast("string"), "0+$", "")
    text = F.when(diff == F.floor(diff), diff.cast("long").cast("string")).otherwise(plain)
    return F.coalesce(F.when(diff >= 0, F.concat(F.lit("+"), text)).when(diff < 0, text), F.lit(""))
