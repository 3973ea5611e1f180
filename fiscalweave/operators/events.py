"""Tagging sales events and building the flat weekly event table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalweave.config import RegionRules, TagRule, broadest, exclude_firms, literal
from fiscalweave.functions.calendar import FiscalRule
from fiscalweave.functions.measures import not_future
from fiscalweave.operators.calendar import date_spine, fiscal_calendar
from fiscalweave.schemas import WEEKLY_EVENTS, conform

OPEN_END = dt.date(2999, 12, 31)


# -- projections and filters -----------------------------------------------------------------------


def region_bucket(df: DataFrame, regions: RegionRules, country: str = "country") -> DataFrame:
    return df.withColumn("region", regions.region(F.col(country)))


def filter_event(df: DataFrame, event_type: str, offering: str, category: str,
                 product: str | None = None) -> DataFrame:
    """Equality filter on the event header, with an optional product."""
    rule = TagRule("filter", event_type=event_type, offering=offering, category=category,
                   product=product)
    return df.filter(rule.predicate())


def filter_allowlist(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    return df.filter(F.col(column).isin(list(allowed)))


def filter_exclude_firms(df: DataFrame, firms: Sequence, firm: str = "firm_id") -> DataFrame:
    """Rows of firms outside the list; a non-empty list also drops rows without a firm."""
    keep = exclude_firms(F.col(firm), firms)
    return df if keep is None else df.filter(keep)


def filter_offer_like(df: DataFrame, contains: Sequence[str] = (),
                      contains_any_case: Sequence[str] = ()) -> DataFrame:
    """Offer names holding every given substring."""
    rule = TagRule("offer", offer_contains=tuple(contains),
                   offer_contains_any_case=tuple(contains_any_case))
    return df.filter(rule.predicate())


# -- tags --------------------------------------------------------------------------------------


def implied_filter(rules: Sequence[TagRule]) -> Column | None:
    """A filter every tagged row meets, in the simple form that reaches a scan.

    A field counts when every rule fixes it; the allowed values are those of the rules.
    """
    terms = []
    for name in ("event_type", "offering", "category", "product"):
        values = {getattr(r, name) for r in rules}
        if None not in values:
            terms.append(F.col(name).isin(sorted(values)))
    return reduce(Column.__and__, terms) if terms else None


def any_rule(rules: Sequence[TagRule], excluded_firms: Sequence = ()) -> Column:
    """Rows that get at least one tag. Rules inside a broader one add nothing and are left out."""
    matched = F.expr(" OR ".join(r.condition(excluded_firms) for r in broadest(rules)))
    implied = implied_filter(rules)
    return matched if implied is None else implied & matched


def multi_rule_tag(df: DataFrame, rules: Sequence[TagRule], excluded_firms: Sequence = ()
                   ) -> DataFrame:
    """One output row per matching rule, from a single pass over the input."""
    return _unfold(df.filter(any_rule(rules, excluded_firms)), rules,
                   [r.condition(excluded_firms) for r in rules])


def _unfold(df: DataFrame, rules: Sequence[TagRule], conditions: Sequence[str]) -> DataFrame:
    """One row per rule whose condition holds, the rule's tag in ``table_type``."""
    cases = ", ".join(f"CASE WHEN {cond} THEN {literal(r.tag)} END"
                      for r, cond in zip(rules, conditions))
    return df.withColumn("table_type", F.expr(f"explode(array_compact(array({cases})))"))


#: Rules per mask column; a long has one more bit, its sign.
MASK_BITS = 63


def tag_masks(rules: Sequence[TagRule], excluded_firms: Sequence = ()) -> dict[str, Column]:
    """Mask columns mask0, mask1, ...: bit i of a mask is set where its rule i matches."""
    return {f"mask{k // MASK_BITS}": F.expr(" | ".join(
        f"CASE WHEN {r.condition(excluded_firms)} THEN {1 << i}L ELSE 0L END"
        for i, r in enumerate(rules[k:k + MASK_BITS])))
        for k in range(0, len(rules), MASK_BITS)}


def explode_masks(df: DataFrame, rules: Sequence[TagRule]) -> DataFrame:
    return _unfold(df, rules, [f"(mask{i // MASK_BITS} & {1 << i % MASK_BITS}L) <> 0"
                               for i in range(len(rules))])


# -- the event table -------------------------------------------------------------------------------

EVENT_KEYS = ("fy", "qtr", "week", "event_date", "super_channel", "channel", "country", "team_raw",
              "full_name", "event_type", "account_id", "firm_id", "product", "offer_name",
              "offering")


def in_period(df: DataFrame, date: str, rule: FiscalRule, fy: int, qtr: int | None,
              years: int = 1) -> DataFrame:
    """Rows of a fiscal year or quarter, or of ``years`` years up to it, as a date range the scan
    can use."""
    first, last = _range(rule, fy, qtr, years)
    return df.filter(F.col(date).between(F.lit(first), F.lit(last)))


def _range(rule: FiscalRule, fy: int, qtr: int | None, years: int):
    if years > 1 and qtr is not None:
        raise ValueError("several years or one quarter, not both")
    return rule.bounds(fy - years + 1, qtr)[0], rule.bounds(fy, qtr)[1]


def join_calendar(fact: DataFrame, calendar: DataFrame, fy: int, qtr: int | None = None,
                  date: str = "event_date", years: int = 1) -> DataFrame:
    """Attach fy, qtr and week by date, keeping the given period only."""
    wanted = F.col("fy").between(fy - years + 1, fy)
    if qtr is not None:
        wanted = wanted & (F.col("qtr") == qtr)
    cal = calendar.withColumnRenamed("date", date)
    return fact.join(cal, date, "left").filter(wanted)


def period_calendar(df: DataFrame, rule: FiscalRule, fy: int, qtr: int | None, years: int = 1
                    ) -> DataFrame:
    """Calendar of the period: at most 366 rows a year, so it is always safe to broadcast."""
    days = date_spine(df.sparkSession, *_range(rule, fy, qtr, years))
    return F.broadcast(fiscal_calendar(days, rule))


def current_version(dim: DataFrame, open_end: dt.date = OPEN_END) -> DataFrame:
    return dim.filter(F.col("rec_end") == F.lit(open_end))


def join_scd_current(fact: DataFrame, dim: DataFrame, key: str = "agent_id",
                     columns: Sequence[str] = ("full_name",)) -> DataFrame:
    """Inner join to the current version of a slowly changing dimension."""
    return fact.join(current_version(dim).select(key, *columns), key)


def dedupe_event_rows(df: DataFrame, keys: Sequence[str], output: Sequence[str]) -> DataFrame:
    """One row per key combination, then the output columns; a key need not be an output.

    Equal output rows are therefore possible and count separately.
    """
    return df.select(*keys).distinct().select(*output)


def weekly_events(bookings: DataFrame, agents: DataFrame, rule: FiscalRule,
                  rules: Sequence[TagRule], regions: RegionRules, fy: int, qtr: int | None = None,
                  teams: Sequence[str] | None = None, excluded_firms: Sequence = (),
                  years: int = 1) -> DataFrame:
    """The flat event table for every rule, from one scan of the bookings.

    Rows are distinct per tag over ``EVENT_KEYS``. That is the same as OR-ing the tag bits of all
    rows sharing the keys, so each key combination is shuffled once, after a map-side combine,
    however many tags or copies it has; tags are unfolded only afterwards. ``years`` fiscal years
    up to ``fy`` come from the same scan.
    """
    fact = in_period(bookings, "event_date", rule, fy, qtr, years)
    if teams is not None:
        fact = filter_allowlist(fact, "team_raw", teams)
    fact = fact.filter(any_rule(rules, excluded_firms))
    masks = tag_masks(rules, excluded_firms)
    fact = fact.withColumns(masks)
    fact = join_calendar(fact, period_calendar(fact, rule, fy, qtr, years), fy, qtr, years=years)
    fact = join_scd_current(fact, agents)
    merged = fact.groupBy(*EVENT_KEYS).agg(*[F.bit_or(m).alias(m) for m in masks])
    return as_contract(region_bucket(explode_masks(merged, rules), regions))


def as_contract(df: DataFrame) -> DataFrame:
    """Bring de-duplicated event rows to the flat contract's names and types."""
    return conform(df.select(
        "fy", "qtr", F.col("week").alias("fweek"), "event_date", "super_channel", "channel",
        "region", "team_raw", F.col("full_name").alias("account_owner"),
        F.col("event_type").alias("event"), "account_id", "firm_id",
        F.col("product").alias("sku"), "offer_name", F.col("offering").alias("product"),
        F.lit(1).alias("cnt"), "table_type"), WEEKLY_EVENTS)


def cancel_contract(df: DataFrame, regions: RegionRules, table_type: str = "CANCELS") -> DataFrame:
    """Cancelled accounts in the contract's shape: event columns they lack are typed NULLs."""
    return conform(region_bucket(df, regions).select(
        "fy", "qtr", F.col("week").alias("fweek"), F.col("cancel_date").alias("event_date"),
        "region", "team_raw", "account_owner", F.lit("active_cancel").alias("event"),
        "account_id", "firm_id", F.lit(1).alias("cnt"), F.lit(table_type).alias("table_type"),
    ), WEEKLY_EVENTS)


def cancel_events_snapshot(activations: DataFrame, rule: FiscalRule, regions: RegionRules,
                           as_of: dt.date, fy: int, qtr: int | None = None) -> DataFrame:
    """Cancels from an activation snapshot, in the fiscal week of the cancel date."""
    df = activations.filter(F.col("cancel_date").isNotNull()
                            & not_future(F.col("cancel_date"), as_of))
    df = in_period(df, "cancel_date", rule, fy, qtr)
    df = join_calendar(df, period_calendar(df, rule, fy, qtr), fy, qtr, "cancel_date")
    return cancel_contract(df.withColumnRenamed("division", "team_raw"), regions)


def union_tagged(frames: dict[str, DataFrame]) -> DataFrame:
    """Stack differently sourced event frames, each under its own table_type."""
    tagged = [conform(df.withColumn("table_type", F.lit(tag)), WEEKLY_EVENTS)
              for tag, df in frames.items()]
    return reduce(DataFrame.unionByName, tagged)
