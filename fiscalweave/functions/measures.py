"""Ratios, indexes, flags and red/amber/green bands."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from fiscalweave.functions.text import parse_number


def safe_div(num: Column, den: Column) -> Column:
    """Quotient as double; 0 when either side is missing or the denominator is 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def index_to(actual: Column, base: Column) -> Column:
    """100 x actual / base; NULL when the base is missing or 0."""
    return F.try_divide(F.lit(100.0) * actual.cast("double"), base.cast("double"))


def recency(d: Column, low: int, high: int, origin: Column) -> Column:
    """True when ``d`` lies between ``low`` and ``high`` days after ``origin``."""
    return F.datediff(d, origin).between(low, high)


def yes_no(condition: Column) -> Column:
    return F.when(condition, "Y").otherwise("N")


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def not_future(d: Column, as_of: dt.date) -> Column:
    return F.to_date(d) <= F.lit(as_of)


# Text that stands for "no figure" on the report, compared without regard to case.
BLANKS = ("", "-", "n/a", "#div/0!")


def _banded_number(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.when(~F.lower(trimmed).isin(*BLANKS), parse_number(trimmed))


def index_band(text: Column, green: float = 100.0, amber: float = 95.0,
               zero_is_blank: bool = False) -> Column:
    """'green', 'amber' or 'red' for an index; 'none' for anything that is not a number.

    With ``zero_is_blank`` the text '0' counts as no figure.
    """
    n = _banded_number(text)
    if zero_is_blank:
        n = F.when(text != "0", n)
    return (F.when(n >= green, "green").when(n >= amber, "amber").when(n < amber, "red")
            .otherwise("none"))


@dataclass(frozen=True)
class BandRule:
    """One ordered band condition; ``high`` is used by the two between operators only."""

    op: str
    low: float
    band: str
    high: float | None = None

    def matches(self, n: Column) -> Column:
        tests = {
            ">": lambda: n > self.low,
            ">=": lambda: n >= self.low,
            "<": lambda: n < self.low,
            "<=": lambda: n <= self.low,
            "=": lambda: n == self.low,
            "!=": lambda: n != self.low,
            "between": lambda: n.between(self.low, self.high),
            "not between": lambda: ~n.between(self.low, self.high),
        }
        if self.op not in tests:
            raise ValueError(f"unknown band operator: {self.op}")
        return tests[self.op]()


def rule_band(text: Column, rules: Sequence[BandRule]) -> Column:
    """Band of the first matching rule, 'none' without a match; no rules means ``index_band``."""
    if not rules:
        return index_band(text)
    n = _banded_number(text)
    chain = F.when(n.isNull(), "none")
    for rule in rules:
        chain = chain.when(rule.matches(n), rule.band)
    return chain.otherwise("none")
