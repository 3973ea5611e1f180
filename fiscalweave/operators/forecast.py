"""Forecast inputs, run-rate and pipeline measures, and the 22-measure team summary."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalweave.config import MotionRules, OpportunityRules, ProductRules
from fiscalweave.functions.calendar import FiscalRule
from fiscalweave.functions.measures import flag, recency, safe_div, yes_no
from fiscalweave.schemas import require_columns

log = logging.getLogger(__name__)

# -- forecast sheet ----------------------------------------------------------------------------------


def forecast_unpivot(wide: DataFrame, teams: Mapping[str, str]) -> DataFrame:
    """Wide forecast (one text column per team) to (fy, qtr, week, team, forecast).

    Rows without a year are dropped, unreadable numbers become 0, and a configured column the
    sheet lacks is skipped with a warning.
    """
    require_columns(wide, ["year_fy", "quarter_fy", "Week_FY"])
    present = {c: t for c, t in teams.items() if c in wide.columns}
    for c in teams.keys() - present.keys():
        log.warning("forecast sheet has no column %r; skipped", c)
    if not present:
        raise ValueError("the forecast sheet holds none of the configured team columns")
    pairs = [F.lit(x) for kv in present.items() for x in kv]
    rows = wide.filter(F.length(F.trim(F.col("year_fy").cast("string"))) > 0)
    long = rows.unpivot(["year_fy", "quarter_fy", "Week_FY"], list(present), "source", "text")
    return long.select(
        F.col("year_fy").try_cast("int").alias("fy"),
        F.col("quarter_fy").try_cast("int").alias("qtr"),
        F.col("Week_FY").try_cast("int").alias("week"),
        F.element_at(F.create_map(*pairs), F.col("source")).alias("team"),
        F.coalesce(F.col("text").try_cast("double"), F.lit(0.0)).alias("forecast"))


def filtered_sum(forecast: DataFrame, fy: int, qtr: int, week: int) -> DataFrame:
    """Forecast per team for the whole quarter and up to the current week."""
    quarter = forecast.filter((F.col("fy") == fy) & (F.col("qtr") == qtr))
    return quarter.groupBy("team").agg(
        F.coalesce(F.sum(F.when(F.col("week") <= week, F.col("forecast"))), F.lit(0.0))
        .alias("qtd_forecast"),
        F.sum("forecast").alias("total_finance_fcst"))


# -- sales base ----------------------------------------------------------------------------------------


def motion_type(division: Column, offer_id: Column, category: Column, rules: MotionRules) -> Column:
    """Run-rate or agent-added.

    Comparisons are plain SQL ones: a missing offer id or category fails both sides and ends up
    agent-added.
    """
    direct = division == rules.direct_division
    by_agent = offer_id.isin(list(rules.agent_offer_ids))
    return (F.when(direct & by_agent, rules.agent_added)
            .when(direct & ~by_agent, rules.run_rate)
            .when((division != rules.direct_division) & (category != rules.agent_category),
                  rules.run_rate)
            .otherwise(rules.agent_added))


def product_flags(df: DataFrame, rules: ProductRules, recent: bool = False) -> DataFrame:
    """0/1 advanced, payroll and core flags.

    The quarter-to-date variant counts every payroll family, the ``recent`` (13-week) one a single
    family.
    """
    families = [rules.payroll_family_recent] if recent else list(rules.payroll_families)
    return df.withColumns({
        "advanced_flag": flag(F.col("product") == rules.advanced_product),
        "payroll_flag": flag(F.col("product_family").isin(families)),
        "core_flag": flag(F.col("product_family") == rules.core_family)})


def with_ages(df: DataFrame, rule: FiscalRule, as_of: dt.date, date: str = "event_date"
              ) -> DataFrame:
    """Fiscal period, its age relative to ``as_of`` and the recency flags of an event."""
    d = date
    start = rule.quarter_start(d)
    week_age = rule.week_age(d, as_of)
    return df.withColumns({
        "fy": rule.year(d), "qtr": rule.quarter(d), "week": rule.week(d),
        "fiscal_year_age": rule.year_age(d, as_of), "fiscal_qtr_age": rule.quarter_age(d, as_of),
        "week_age": week_age, "qtr_start": start,
        "flag_28days": flag(recency(F.col(d), 0, 28, start)),
        "last_4_week_flag": yes_no(week_age.between(1, 4)),
        "last_13_week_flag": yes_no(week_age.between(1, 13))})


def join_parent_rollup(df: DataFrame, accounts: DataFrame, account: str, key: str = "company_id"
                       ) -> DataFrame:
    """Attach the top-level parent's company by way of the account's parent id; inner both times.

    ``key`` is the account column that ``account`` refers to: its company or its own id.
    """
    child = accounts.select(F.col(key).alias(account), F.col("parent_id"))
    parent = accounts.select(F.col("id").alias("parent_id"),
                             F.col("company_id").alias("parent_company_id"))
    rollup = child.join(parent, "parent_id").drop("parent_id")  # at most one row per account
    return df.join(rollup, account)


def sales_base(bookings: DataFrame, accounts: DataFrame, product_offer: DataFrame,
               offers: DataFrame, rule: FiscalRule, as_of: dt.date, divisions: Sequence[str],
               event_type: str, super_channels: Sequence[str], motion: MotionRules,
               weeks: int = 13, company: str = "account_id") -> DataFrame:
    """Completed weeks of the current fiscal year with parent account, offer and motion.

    ``company`` names the booking column that the parent roll-up goes by; what the measures count
    is ``account_id``, which may be another one.

    Holds the rows of the current quarter (``in_qtd``) and of the last ``weeks`` weeks
    (``in_recent``), so both windows come from one scan. Bookings are cut by a plain date range
    before any join.
    """
    fy, qtr, _ = rule.position(as_of)
    first, last = rule.bounds(fy)
    quarter_start, _ = rule.bounds(fy, qtr)
    # No window reaches further back, and nothing after as_of has a week age above 0.
    first = max(first, min(quarter_start, as_of - dt.timedelta(days=7 * (weeks + 1))))
    df = bookings.filter(F.col("event_date").between(F.lit(first), F.lit(min(last, as_of)))
                         & (F.col("event_type") == event_type)
                         & F.col("super_channel").isin(list(super_channels))
                         & F.col("division_l4").isin(list(divisions)))
    df = (with_ages(df, rule, as_of).filter(F.col("week_age") > 0)
          .withColumns({"in_qtd": F.col("fiscal_qtr_age") == 0,
                        "in_recent": F.col("week_age") <= weeks})
          .filter("in_qtd OR in_recent"))
    offer_of = (product_offer.select("offer_key", "src_offer_id")
                .withColumn("offer_id", F.col("src_offer_id").cast("string")))
    df = df.join(offer_of, "offer_key")
    df = join_parent_rollup(df, accounts, company)
    df = df.join(offers.select(F.col("offer_id").cast("string").alias("offer_id"),
                               "signup_category", "promotion", "use"), "offer_id", "left")
    return df.withColumn("motion", motion_type(F.col("division_name"), F.col("offer_id"),
                                               F.col("signup_category"), motion)
                         ).withColumn("team", F.col("division_l3"))


def qtd_sales(base: DataFrame, products: ProductRules) -> DataFrame:
    """Quarter-to-date rows of ``sales_base`` with the quarter's product flags."""
    return product_flags(base.filter("in_qtd"), products)


def recent_sales(base: DataFrame, products: ProductRules) -> DataFrame:
    """Rows of the last 13 weeks of ``sales_base`` with the 13-week product flags."""
    return product_flags(base.filter("in_recent"), products, recent=True)


def runrate_itf(base: DataFrame, slices: Mapping[str, str], run_rate: str = "Runrate") -> DataFrame:
    """Run-rate and total distinct accounts per team and product slice.

    ``slices`` maps a slice label to its 0/1 flag column; a row counts in every slice it belongs
    to, all from one pass.
    """
    tags = F.array_compact(F.array(*[F.when(F.col(c) == 1, F.lit(name))
                                     for name, c in slices.items()]))
    # One row per account, slice and motion first: the distinct counts then work on small groups.
    seen = (base.select("team", "account_id", "motion", F.explode(tags).alias("rr_type"))
            .groupBy("team", "rr_type", "account_id")
            .agg(F.bool_or(F.col("motion") == run_rate).alias("is_rr")))
    return seen.groupBy("team", "rr_type").agg(
        F.count_if(F.col("is_rr") & F.col("account_id").isNotNull()).alias("rr_sales"),
        F.count("account_id").alias("total_sales"))


def conditional_distinct(base: DataFrame, keys: Sequence[str], condition: Column,
                         account: str = "account_id") -> DataFrame:
    """Distinct accounts meeting a condition beside all distinct accounts."""
    return base.groupBy(*keys).agg(
        F.count_distinct(F.when(condition, F.col(account))).alias("rr_sales"),
        F.count_distinct(account).alias("total_sales"))


def team_distinct(sales: DataFrame, run_rate: str = "Runrate") -> DataFrame:
    """Distinct accounts per team, all and run-rate."""
    counted = conditional_distinct(sales, ["team"], F.col("motion") == run_rate)
    return counted.select("team", F.col("total_sales").alias("qtd_sales"),
                          F.col("rr_sales").alias("qtd_runrate_sales"))


def run_rate_columns(weeks: int = 13) -> list[Column]:
    """Weekly run-rate, always over the full window length, and run-rate share of all accounts."""
    return [(F.col("rr_sales") / F.lit(float(weeks))).alias("avg_weekly_rr"),
            safe_div(F.col("rr_sales"), F.col("total_sales")).alias("rr_rate")]


def avg_weekly_rr(runrate: DataFrame, core: str, weeks: int = 13) -> DataFrame:
    """Run-rate figures of the core product slice."""
    return runrate.filter(F.col("rr_type") == core).select("team", *run_rate_columns(weeks))


def sales_measures(base: DataFrame, products: ProductRules, run_rate: str = "Runrate",
                   weeks: int = 13) -> DataFrame:
    """Quarter-to-date accounts and the core run-rate per team, from one pass over the base.

    Rows fold to one per team and account before anything is counted, so no distinct aggregate has
    to expand them.
    """
    rr = F.col("motion") == run_rate
    core = F.col("in_recent") & (F.col("product_family") == products.core_family)
    seen = (base.filter(F.col("account_id").isNotNull()).groupBy("team", "account_id")
            .agg(F.bool_or("in_qtd").alias("q"), F.bool_or(F.col("in_qtd") & rr).alias("q_rr"),
                 F.bool_or(core).alias("c"), F.bool_or(core & rr).alias("c_rr")))
    counted = seen.groupBy("team").agg(
        F.count_if("q").alias("qtd_sales"), F.count_if("q_rr").alias("qtd_runrate_sales"),
        F.count_if("c").alias("total_sales"), F.count_if("c_rr").alias("rr_sales"))
    return counted.select("team", "qtd_sales", "qtd_runrate_sales", *run_rate_columns(weeks))


# -- opportunities ---------------------------------------------------------------------------------------


def product_group(name: Column, rules: OpportunityRules) -> Column:
    """First matching pattern; a missing name has its own group, everything else the default."""
    lower = F.lower(name)
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for pattern, group in rules.groups:
        chain = chain.when(F.regexp_like(lower, F.lit(pattern)), group)
    chain = chain.when(name.isNull(), rules.no_line)
    for pattern, group in rules.groups_after_null:
        chain = chain.when(F.regexp_like(lower, F.lit(pattern)), group)
    return chain.otherwise(rules.default_group)


def filter_live_lines(df: DataFrame, deleted: str = "isdeleted", name: str = "price_name",
                      excluded: str = "upgrade") -> DataFrame:
    """Lines that are not deleted and whose product name lacks a word.

    A missing deletion flag counts as live; a missing name does not pass the NOT LIKE, so outer
    joins in front of this filter become inner ones.
    """
    return df.filter(~F.coalesce(F.col(deleted), F.lit(False))
                     & ~F.contains(F.lower(F.col(name)), F.lit(excluded)))


def join_scd_asof(df: DataFrame, dim: DataFrame, key: str, date: str, columns: Sequence[str]
                  ) -> DataFrame:
    """Point-in-time inner join: the version valid on the row's date, both ends included.

    An equi join with the validity range as a residual; never a nested loop.
    """
    d = dim.alias("d")
    f = df.alias("f")
    on = ((F.col(f"f.{key}") == F.col(f"d.{key}"))
          & F.col(f"f.{date}").between(F.col("d.rec_start"), F.col("d.rec_end")))
    return f.join(d, on).select("f.*", *[f"d.{c}" for c in columns])


def join_role_playing(df: DataFrame, ext: DataFrame) -> DataFrame:
    """The calendar joined twice: by close date and by created date."""
    close = ext.select(F.col("date").alias("close_date"), F.col("fy").alias("close_fy"),
                       F.col("qtr").alias("close_qtr"),
                       F.col("fiscal_year_age").alias("close_year_age"))
    created = ext.select(F.col("date").alias("created_date"),
                         F.col("fiscal_year_age").alias("created_year_age"))
    return df.join(close, "close_date").join(created, "created_date")


def opportunity_pipeline(opps: DataFrame, lines: DataFrame, prices: DataFrame, users: DataFrame,
                         agents: DataFrame, accounts: DataFrame, ext: DataFrame,
                         rule: FiscalRule, as_of: dt.date, divisions: Sequence[str],
                         rules: OpportunityRules) -> DataFrame:
    """Opportunity lines of this and the last fiscal year with team, parent and product group."""
    # The two years by creation date, as a range the scan can use, before the calendar says so too.
    fy = rule.position(as_of)[0]
    recent = opps.filter(F.col("created_date").between(F.lit(rule.bounds(fy - 1)[0]),
                                                       F.lit(rule.bounds(fy)[1])))
    dated = join_role_playing(recent, ext).filter(F.col("created_year_age").isin(0, 1))
    keyed = users.select(F.col("id").alias("owner_id"),
                         F.col("federation_id").try_cast("bigint").alias("agent_id"))
    dated = dated.join(keyed, "owner_id")
    owned = join_scd_asof(dated, agents.filter(F.col("division_l4").isin(list(divisions))),
                          "agent_id", "close_date", ["division_l3"])
    owned = join_parent_rollup(owned, accounts, "account_id", key="id")
    # A line without a name is dropped, so both joins are inner; the lines meet the opportunities of
    # the two years first, and only those that are left meet the prices.
    sold = lines.select(F.col("opp_id").alias("id"), "price_entry_id", "quantity", "total",
                        "isdeleted")
    priced = owned.join(sold, "id").join(
        prices.select(F.col("id").alias("price_entry_id"), F.col("name").alias("price_name")),
        "price_entry_id")
    live = filter_live_lines(priced, excluded=rules.excluded_name_part)
    return live.select(
        "id", "account_id", "parent_company_id", "stage", "amount",
        "probability", "close_date", "isclosed", "iswon", "created_date", "agent_id",
        F.col("division_l3").alias("team"),
        F.when(F.col("stage").isin(list(rules.closed_stages)), "Closed").otherwise("Open")
        .alias("opp_status"),
        yes_no(F.datediff(F.lit(as_of), F.col("created_date")).between(0, 60))
        .alias("created_0_60_flag"),
        "quantity", "total", "close_fy", "close_qtr", "close_year_age",
        product_group(F.col("price_name"), rules).alias("product_group"),
        flag(F.col("stage").isin(list(rules.late_stages))).alias("latestage_flag")).distinct()


def _conversion(recent: Column) -> Column:
    def hits(name: str) -> Column:
        return F.coalesce(F.sum(F.when(recent, F.col(name).cast("int"))), F.lit(0))

    return hits("iswon") / F.greatest(hits("isclosed"), F.lit(1))


def _closing_since(as_of: dt.date, days: int) -> Column:
    return F.col("close_date") >= F.lit(as_of - dt.timedelta(days=days))


def conversion_rate(pipeline: DataFrame, as_of: dt.date, days: int = 60,
                    distinct_ids: bool = False) -> DataFrame:
    """Won over closed per team for rows closing from ``days`` before ``as_of`` on.

    Counts pipeline rows (one per line item) and sets no upper date; ``distinct_ids`` counts each
    opportunity once instead.
    """
    recent = pipeline.filter(_closing_since(as_of, days))
    if distinct_ids:
        recent = recent.select("team", "id", "iswon", "isclosed").distinct()
    return recent.groupBy("team").agg(_conversion(F.lit(True)).alias("opp_conv_rate"))


def open_opportunities(pipeline: DataFrame) -> DataFrame:
    return (pipeline.filter(F.col("opp_status") == "Open").groupBy("team")
            .agg(F.count_distinct("id").alias("qtg_open_opps")))


def pipeline_measures(pipeline: DataFrame, as_of: dt.date, days: int = 60) -> DataFrame:
    """Conversion rate and open opportunities per team from one pass over the pipeline."""
    is_open = F.col("opp_status") == "Open"
    return pipeline.groupBy("team").agg(
        _conversion(_closing_since(as_of, days)).alias("opp_conv_rate"),
        F.count_distinct(F.when(is_open, F.col("id"))).alias("qtg_open_opps"))


# -- team summary ----------------------------------------------------------------------------------------


def join_align_teams(measures: Sequence[DataFrame]) -> DataFrame:
    """Per-team measures side by side, 0 where a team lacks one.

    Every frame holds ``team`` and measure columns of its own. They are stacked and regrouped, one
    shuffle for all of them instead of a chain of outer joins.
    """
    names = [c for df in measures for c in df.columns if c != "team"]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                     [df.select("team", *[F.col(c).cast("double") for c in df.columns
                                          if c != "team"]) for df in measures])
    return stacked.groupBy("team").agg(*[F.coalesce(F.max(c), F.lit(0.0)).alias(c) for c in names])


RATIOS = ("qtd_itf", "qtd_rr_pct", "qtd_forecast_rr_pct", "qtd_runrate_itf", "qtd_pipeline_itf",
          "opp_conv_rate", "fcst_itf")


def team_forecast_summary(base: DataFrame, products: ProductRules, pipeline: DataFrame,
                          forecast: DataFrame, rule: FiscalRule, as_of: dt.date) -> DataFrame:
    """The 22 measures per team.

    Inputs: the shared sales base, opportunity lines and the long forecast. Ratios are plain (not
    x100); rounding is half-even.
    """
    fy, qtr, week = rule.position(as_of)
    _, quarter_end = rule.bounds(fy, qtr)
    weeks_left = max(0.0, (quarter_end - as_of).days / 7)
    s = join_align_teams([
        sales_measures(base, products), filtered_sum(forecast, fy, qtr, week),
        pipeline_measures(pipeline, as_of)])
    c = F.col
    s = s.withColumn("qtd_runrate_forecast", F.bround(c("qtd_forecast") * c("rr_rate"), 0))
    s = s.withColumns({
        "qtd_pipeline_sales": c("qtd_sales") - c("qtd_runrate_sales"),
        "qtd_pipeline_forecast": c("qtd_forecast") - c("qtd_runrate_forecast"),
        "qtg_fcst_runrate": F.bround(c("avg_weekly_rr") * weeks_left, 0),
        "qtg_fcst_opps": F.bround(c("qtg_open_opps") * c("opp_conv_rate"), 0)})
    s = s.withColumn("qtg_fcst_sales", c("qtg_fcst_runrate") + c("qtg_fcst_opps"))
    s = s.withColumn("total_fcst_sales", c("qtd_sales") + c("qtg_fcst_sales"))
    return s.select(
        "team", "qtd_sales", "qtd_forecast",
        safe_div(c("qtd_sales"), c("qtd_forecast")).alias("qtd_itf"),
        "qtd_runrate_sales", "qtd_pipeline_sales",
        safe_div(c("qtd_runrate_sales"), c("qtd_sales")).alias("qtd_rr_pct"),
        safe_div(c("qtd_runrate_forecast"), c("qtd_forecast")).alias("qtd_forecast_rr_pct"),
        "qtd_runrate_forecast",
        safe_div(c("qtd_runrate_sales"), c("qtd_runrate_forecast")).alias("qtd_runrate_itf"),
        "qtd_pipeline_forecast",
        safe_div(c("qtd_pipeline_sales"), c("qtd_pipeline_forecast")).alias("qtd_pipeline_itf"),
        (c("total_finance_fcst") - c("qtd_sales")).alias("qtg_sales"),
        "qtg_open_opps", "opp_conv_rate", "avg_weekly_rr", "qtg_fcst_runrate", "qtg_fcst_opps",
        "qtg_fcst_sales", "total_finance_fcst", "total_fcst_sales",
        (c("total_fcst_sales") - c("total_finance_fcst")).alias("fcst_gap"),
        safe_div(c("total_fcst_sales"), c("total_finance_fcst")).alias("fcst_itf"))
