"""Fiscal calendar arithmetic.

The calendar is a pure function of the date, so facts never need a lookup to be bucketed and a
fiscal period can be turned into a plain date range that reaches the scan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FiscalRule:
    """Fiscal year named after the year it ends in; weeks restart with every fiscal year.

    ``week_start`` uses Spark's ``dayofweek`` numbering (1 = Sunday). Week 1 is the possibly short
    week holding the first day of the fiscal year, and a week across a quarter end belongs, day by
    day, to both quarters.
    """

    start_month: int = 8
    week_start: int = 1

    @property
    def _year_shift(self) -> int:
        return 0 if self.start_month == 1 else 1

    # -- columns; ``d`` is the SQL text of a date, as in "event_date" or "to_date(ts)" ---------------

    def _year(self, d: str) -> str:
        if self._year_shift == 0:
            return f"year({d})"
        return f"(year({d}) + CASE WHEN month({d}) >= {self.start_month} THEN 1 ELSE 0 END)"

    def _year_start(self, d: str) -> str:
        return f"make_date({self._year(d)} - {self._year_shift}, {self.start_month}, 1)"

    def _months_in(self, d: str) -> str:
        return f"((month({d}) + {12 - self.start_month}) % 12)"

    def _quarter(self, d: str) -> str:
        return f"CAST({self._months_in(d)} DIV 3 + 1 AS INT)"

    def _quarter_start(self, d: str) -> str:
        return f"trunc(add_months({d}, -({self._months_in(d)} % 3)), 'MONTH')"

    def _back(self, d: str) -> str:
        """Days since the last start of a week."""
        return f"((dayofweek({d}) - {self.week_start} + 7) % 7)"

    def _week_begin(self, d: str) -> str:
        return f"date_sub({d}, {self._back(d)})"

    def year(self, d: str) -> Column:
        return F.expr(self._year(d))

    def quarter(self, d: str) -> Column:
        return F.expr(self._quarter(d))

    def quarter_start(self, d: str) -> Column:
        return F.expr(self._quarter_start(d))

    def quarter_end(self, d: str) -> Column:
        return F.expr(f"date_sub(add_months({self._quarter_start(d)}, 3), 1)")

    def week(self, d: str) -> Column:
        start = self._year_start(d)
        return F.expr(f"CAST((datediff({d}, {start}) + {self._back(start)}) DIV 7 + 1 AS INT)")

    def week_begin(self, d: str) -> Column:
        """First day of the unbroken seven-day week around ``d`` (ignores fiscal-year ends)."""
        return F.expr(self._week_begin(d))

    def year_age(self, d: str, as_of: dt.date) -> Column:
        return F.expr(f"{self.position(as_of)[0]} - {self._year(d)}")

    def quarter_age(self, d: str, as_of: dt.date) -> Column:
        fy, qtr, _ = self.position(as_of)
        return F.expr(f"{fy * 4 + qtr} - ({self._year(d)} * 4 + {self._quarter(d)})")

    def week_age(self, d: str, as_of: dt.date) -> Column:
        back = (as_of.isoweekday() % 7 + 1 - self.week_start + 7) % 7
        begin = as_of - dt.timedelta(days=back)
        return F.expr(f"CAST(datediff(DATE'{begin}', {self._week_begin(d)}) DIV 7 AS INT)")

    # -- scalars, for parameters only --------------------------------------------------------------

    def first_day(self, fy: int) -> dt.date:
        return dt.date(fy - self._year_shift, self.start_month, 1)

    def position(self, day: dt.date) -> tuple[int, int, int]:
        """(fiscal year, quarter, week) of a parameter date."""
        fy = day.year + (self._year_shift if day.month >= self.start_month else 0)
        start = self.first_day(fy)
        offset = (start.isoweekday() % 7 + 1 - self.week_start + 7) % 7
        week = ((day - start).days + offset) // 7 + 1
        return fy, (day.month - self.start_month) % 12 // 3 + 1, week

    def weeks(self, fy: int, qtr: int | None = None) -> list[int]:
        """The week numbers of a fiscal year or quarter."""
        first, last = (self.position(d)[2] for d in self.bounds(fy, qtr))
        return list(range(first, last + 1))

    def bounds(self, fy: int, qtr: int | None = None) -> tuple[dt.date, dt.date]:
        """First and last day of a fiscal year or quarter."""
        def month_at(n: int) -> dt.date:
            m = self.start_month - 1 + n
            return dt.date(fy - self._year_shift + m // 12, m % 12 + 1, 1)

        lo, hi = (0, 12) if qtr is None else ((qtr - 1) * 3, qtr * 3)
        return month_at(lo), month_at(hi) - dt.timedelta(days=1)


def quarter_progress(qtr_start: Column, qtr_end: Column, as_of: Column) -> tuple[Column, Column]:
    """Fractional weeks completed (at least 1) and weeks remaining (at least 0) in a quarter."""
    completed = F.greatest(F.lit(1.0), F.datediff(as_of, qtr_start) / F.lit(7.0))
    remaining = F.greatest(F.lit(0.0), F.datediff(qtr_end, as_of) / F.lit(7.0))
    return completed, remaining
