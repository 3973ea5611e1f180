"""Every operator as a runnable query over the driver's tables, beside the SQL it must agree with.

A query reads whole tables; its SQL is composed from the views in ``oracle.py``.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fiscalweave.functions import measures as ms
from fiscalweave.functions import text as tx
from fiscalweave.operators import asof
from fiscalweave.operators import bitmaps as bm
from fiscalweave.operators import calendar as cal
from fiscalweave.operators import counts as cnt
from fiscalweave.operators import events as ev
from fiscalweave.operators import forecast as fc
from fiscalweave.operators import freeze as fz
from fiscalweave.operators import incremental as inc
from fiscalweave.operators import kpi
from fiscalweave.operators import owners as ow
from fiscalweave.operators import report as rp
from fiscalweave.operators import rule_index as ri
from fiscalweave.operators import state as st
from fiscalweave.plans import dashboard as db
from fiscalweave.plans import oracle as sql
from fiscalweave.plans.binding import (AS_OF, CANCELS, DIVISIONS_L4, EXCLUDED_FIRMS, FORECAST_TEAMS,
                                       FY, MOTION, OPPORTUNITIES, OWNERS, PACKAGE_ROWS, PRODUCTS,
                                       QTR, REGIONS, RULE, TAG_RULES, TEAMS, WEEK, Tables)
from fiscalweave.plans.increment import CountStore, apply_changes
from fiscalweave.schemas import RUN_META, WEEKLY_EVENTS
from fiscalweave.session import tune
from fiscalweave.sources import layout as lay
from fiscalweave.sources import sinks
from fiscalweave.sources.tables import sheet_as_table

c = F.col
Plan = Callable[[Tables], DataFrame]
_PLANS: dict[str, Plan] = {}
_SQL: dict[str, str] = {}


def query(name: str, oracle: str | None) -> Callable[[Plan], Plan]:
    def add(plan: Plan) -> Plan:
        _PLANS[name] = plan
        if oracle is not None:
            _SQL[name] = oracle
        return plan

    return add


def _n(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


# -- sources and sinks -------------------------------------------------------------------------------


@query("scan_bookings", """
    SELECT event_date, account_id, firm_id, event_type, offering, product, team_raw FROM v_bookings
    WHERE event_type = 'new'""")
def _(t):
    return t.bookings.filter(c("event_type") == "new").select(
        "event_date", "account_id", "firm_id", "event_type", "offering", "product", "team_raw")


@query("bookings_by_period", f"""
    SELECT e.fy, e.qtr, e.week, e.fiscal_qtr_age, event_type, count(*) AS n
    FROM v_bookings b JOIN v_ext e ON e.date = b.event_date
    WHERE e.fiscal_qtr_age IN (0, 1) GROUP BY ALL""")
def _(t):
    target = sinks.scratch_path(t.spark, "bookings-by-period")
    lay.write_by_period(t.bookings.select("event_date", "event_type"), target, RULE)
    ages = t.date_ext.filter(c("fiscal_qtr_age").isin(0, 1))
    rows = lay.in_calendar(lay.read_by_period(t.spark, target), ages)
    return _n(rows, "fy", "qtr", "week", "fiscal_qtr_age", "event_type")


@query("sheet_as_table", """
    SELECT row_no, Segment AS segment, Agent AS agent, L3 AS l3, AgentEmail AS agent_email
    FROM v_roster WHERE length(trim(Agent)) > 0""")
def _(t):
    sheet = sheet_as_table(t.roster, ["Segment", "L3", "AgentEmail"], key="Agent")
    return sheet.select("row_no", c("Segment").alias("segment"), c("Agent").alias("agent"),
                        c("L3").alias("l3"), c("AgentEmail").alias("agent_email"))


@query("snapshot_overwrite",
       "SELECT account, user_id, type, start_date, end_date, isdeleted FROM v_history")
def _(t):
    target = sinks.scratch_path(t.spark, "snapshot")
    sinks.write_snapshot(t.owner_history.filter("isdeleted"), target)
    sinks.write_snapshot(t.owner_history, target)  # replaces the first one
    return sinks.read_snapshot(t.spark, target)


def _freeze_inputs(t: Tables) -> tuple[DataFrame, DataFrame]:
    """A store with closed weeks, gaps, another quarter and a stale open week; fresh rows."""
    cancels = t.materialize(t.snapshot_cancels(), "cancels")  # as a store would be: a written table
    key = c("account_id").cast("bigint")
    store = cancels.filter(
        ((c("qtr") == QTR) & ~c("fweek").isin(44, 45) & (key % 5 != 0))
        | ((c("qtr") == 3) & (key % 2 == 0)))
    return store, cancels.filter(c("qtr") == QTR)


@query("freeze_store_write", f"""
    SELECT {sql.CONTRACT} FROM v_frozen WHERE qtr = 4 AND fweek < 46
    UNION ALL SELECT {sql.CONTRACT} FROM v_store WHERE qtr = 3""")
def _(t):
    store, fresh = _freeze_inputs(t)
    target, meta = (sinks.scratch_path(t.spark, n) for n in ("freeze", "freeze-meta"))
    log = sinks.run_log(t.spark, meta)
    read = lambda: sinks.read_freeze(t.spark, target, log.read(), WEEKLY_EVENTS)

    def run(rows: DataFrame, run_id: str, qtr: int, day: int) -> None:
        attempt, base = sinks.new_attempt(run_id), log.head()
        sinks.write_freeze(rows, target, attempt, FY, qtr)
        sinks.append_run_meta(t.spark, meta, run_id, FY, qtr, dt.datetime(2000, 6, day),
                              attempt=attempt, store_attempt=attempt, base=base)

    for qtr in (3, QTR):
        run(store, "first", qtr, 8)
    for _ in range(2):  # a run that is repeated extends the store that it has replaced
        run(fz.weekly_freeze(read(), fresh, FY, QTR, WEEK).store, "second", QTR, 15)
    # A later run whose freeze failed commits without moving the store.
    sinks.append_run_meta(t.spark, meta, "third", FY, QTR, dt.datetime(2000, 6, 22))
    return read()


def _run_meta(t: Tables) -> DataFrame:
    """One run per order priority and fiscal quarter, finished on its last order date."""
    d = "to_date(o_orderdate)"
    return (t.raw("orders").groupBy(c("o_orderpriority").alias("run_id"), RULE.year(d).alias("fy"),
                                    RULE.quarter(d).alias("qtr"))
            .agg(F.max("o_orderdate").cast("timestamp").alias("finished_at"),
                 F.count(F.lit(1)).cast("string").alias("summary_text"))
            .withColumns({"attempt": c("run_id"), "store_attempt": F.lit(None).cast("string")})
            .select(*RUN_META.names))


_D = "CAST(o_orderdate AS DATE)"
_META = f"""(SELECT o_orderpriority AS run_id, {sql.fy(_D)} AS fy, {sql.qtr(_D)} AS qtr,
    max(o_orderdate) AS finished_at, CAST(count(*) AS VARCHAR) AS summary_text
    FROM orders GROUP BY 1, 2, 3)"""


_STEP = "fy, qtr, fweek, team, table_type"
_TAGGED = " UNION ALL ".join(
    f"SELECT fy, qtr, week AS fweek, coalesce(team_raw, '') AS team, '{tag}' AS table_type, "
    f"({sql.EVENT_KEYS}) AS event, l_orderkey % 4 AS part, firm_id FROM v_dated "
    f"WHERE {cond} AND qtr >= 2" for tag, cond in sql.TAGS.items())


def _state(upto: int) -> str:
    return (f"(SELECT {_STEP}, event FROM all{upto} GROUP BY {_STEP}, event HAVING sum(change) > 0)")


def _open(weeks: int, upto: int) -> str:
    return (f"(fweek >= {weeks} OR (fy, qtr, fweek) NOT IN (SELECT (fy, qtr, fweek) "
            f"FROM {_state(upto)} s WHERE s.fweek < {weeks}))")


@query("incremental_week_counts", f"""
    WITH tagged AS ({_TAGGED}),
    all1 AS (SELECT *, 1 AS change FROM tagged WHERE part < 2),
    all2 AS (SELECT * FROM all1 UNION ALL
             SELECT * FROM (SELECT *, 1 AS change FROM tagged WHERE part = 2 UNION ALL
                            SELECT *, -1 FROM tagged WHERE part < 2 AND firm_id % 10 = 3)
             WHERE {_open(30, 1)}),
    all3 AS (SELECT * FROM all2 UNION ALL
             SELECT *, 1 FROM tagged WHERE part = 3 AND {_open(42, 2)})
    SELECT {_STEP}, count(*) AS n FROM {_state(3)} GROUP BY ALL""")
def _(t):
    store = CountStore(sinks.scratch_path(t.spark, "counts"))
    part = c("l_orderkey") % 4
    start = RULE.bounds(FY, 2)[0]
    facts = t.materialize(ev.in_period(t.bookings, "event_date", RULE, FY, None)
                          .filter(c("event_date") >= F.lit(start)), "bookings")
    taken_back = facts.filter((part < 2) & (c("firm_id") % 10 == 3))
    batches = [  # (rows, their sign, current week of the run)
        ([(facts.filter(part < 2), 1)], 30),
        ([(facts.filter(part == 2), 1), (taken_back, -1)], 42),
        ([(facts.filter(part == 3), 1)], WEEK)]
    for i, (rows, week) in enumerate(batches):
        signed = reduce(DataFrame.unionByName,
                        [df.withColumn("change", F.lit(sign)) for df, sign in rows])
        changes = inc.event_changes(signed, t.agents, RULE, TAG_RULES, FY, None, TEAMS,
                                    EXCLUDED_FIRMS)
        apply_changes(store, changes, f"run{i}", FY, week)
    return store.cells(t.spark)


@query("run_meta_append", f"""
    SELECT fy, qtr, run_id, CAST(finished_at AS DATE) AS finished_on, summary_text
    FROM (SELECT *, row_number() OVER (PARTITION BY fy, qtr ORDER BY finished_at DESC, run_id DESC)
          AS rn FROM {_META}) WHERE rn = 1""")
def _(t):
    log = sinks.run_log(t.spark, sinks.scratch_path(t.spark, "run-meta"))
    runs = _run_meta(t)
    early = c("fy") < 1999
    log.commit(runs.filter(early), 0)
    log.commit(runs.filter(~early), 0)  # starts from the same state, but shares no quarter with it
    latest = sinks.latest_run(log.read())
    return latest.select("fy", "qtr", "run_id", F.to_date("finished_at").alias("finished_on"),
                         "summary_text")


@query("export_text", """
    SELECT CAST(id AS VARCHAR) AS id, stage, CAST(amount AS VARCHAR) AS amount,
        CASE WHEN id % 10 = 0 THEN '0' ELSE CAST(probability AS VARCHAR) END AS probability,
        strftime(close_date, '%Y-%m-%d') AS close_date, CAST(isclosed AS VARCHAR) AS isclosed,
        coalesce(CASE WHEN iswon THEN CAST(CAST(floor(amount) AS BIGINT) AS VARCHAR) END, '')
            AS won_amount
    FROM (SELECT * REPLACE (amount + 0.5 - (amount - floor(amount)) AS amount) FROM v_opps)""")
def _(t):
    opps = t.opportunities.withColumn("amount", F.floor("amount") + 0.5)
    return sinks.stringify(opps.select(
        "id", "stage", "amount", "probability", "close_date", "isclosed",
        F.when(c("iswon"), F.floor("amount").cast("double")).alias("won_amount")))


_RATIOS = ", ".join(f"round_even({r}, 3) AS {r}" for r in fc.RATIOS)
_WHOLE = ("qtd_sales", "qtd_forecast", "qtd_runrate_sales", "qtd_pipeline_sales",
          "qtd_runrate_forecast", "qtd_pipeline_forecast", "qtg_sales", "qtg_open_opps",
          "avg_weekly_rr", "qtg_fcst_runrate", "qtg_fcst_opps", "qtg_fcst_sales",
          "total_finance_fcst", "total_fcst_sales", "fcst_gap")


_ROUNDED = (f"SELECT team, {_RATIOS}, "
            f"{', '.join(f'CAST(round_even({m}, 0) AS BIGINT) AS {m}' for m in _WHOLE)} FROM v_summary")


@query("export_rounded", _ROUNDED)
def _(t):
    return sinks.round_for_export(_summary(t), fc.RATIOS, ["team"])


@query("forecast_summary_run", _ROUNDED)
def _(t):
    return db.publish_forecast_summary(t.sales_base, PRODUCTS, t.pipeline, t.forecast, RULE, AS_OF,
                                       sinks.scratch_path(t.spark, "summary"))


# -- projections, filters, predicates ------------------------------------------------------------------


@query("project_typed_nulls", f"""
    SELECT {sql.fy('cancel_date')} AS fy, {sql.qtr('cancel_date')} AS qtr,
        {sql.week('cancel_date')} AS fweek, cancel_date AS event_date,
        CAST(NULL AS VARCHAR) AS super_channel, CAST(NULL AS VARCHAR) AS channel,
        {sql.region('country')} AS region, division AS team_raw, account_owner,
        'active_cancel' AS event, CAST(account_id AS VARCHAR) AS account_id,
        CAST(firm_id AS VARCHAR) AS firm_id, CAST(NULL AS VARCHAR) AS sku,
        CAST(NULL AS VARCHAR) AS offer_name, CAST(NULL AS VARCHAR) AS product, 1 AS cnt,
        'CANCELS' AS table_type
    FROM v_activations""")
def _(t):
    d = "cancel_date"
    return ev.cancel_contract(t.activations.withColumnsRenamed({"division": "team_raw"}).withColumns(
        {"fy": RULE.year(d), "qtr": RULE.quarter(d), "week": RULE.week(d)}), REGIONS)


@query("region_bucket", f"""
    SELECT country, {sql.region('country')} AS region, count(*) AS n FROM v_bookings GROUP BY 1, 2""")
def _(t):
    return _n(ev.region_bucket(t.bookings, REGIONS), "country", "region")


@query("filter_event", f"""
    SELECT event_date, account_id, firm_id, offer_name FROM v_bookings WHERE {sql.TAGS['ADV']}""")
def _(t):
    return ev.filter_event(t.bookings, "new", "CORE", "F", "PROMO").select(
        "event_date", "account_id", "firm_id", "offer_name")


@query("filter_allowlist", """
    SELECT division_l4, team_raw, count(*) AS n FROM v_bookings
    WHERE division_l4 IN ('L4_0', 'L4_1', 'L4_2') GROUP BY 1, 2""")
def _(t):
    return _n(ev.filter_allowlist(t.bookings, "division_l4", DIVISIONS_L4), "division_l4", "team_raw")


@query("filter_exclude_firms", """
    SELECT firm, count(*) AS n FROM (
        SELECT CASE WHEN firm_id % 20 <> 0 THEN firm_id END AS firm FROM v_bookings)
    WHERE NOT (firm IN (7, 13)) GROUP BY 1""")
def _(t):
    firms = t.bookings.select(F.when(c("firm_id") % 20 != 0, c("firm_id")).alias("firm"))
    return _n(ev.filter_exclude_firms(firms, EXCLUDED_FIRMS, "firm"), "firm")


@query("filter_offer_like", """
    SELECT offer_name, count(*) AS n FROM v_bookings
    WHERE offer_name LIKE '%old%' AND lower(offer_name) LIKE '%gear%' GROUP BY 1""")
def _(t):
    return _n(ev.filter_offer_like(t.bookings, ["old"], ["GEAR"]), "offer_name")


@query("multi_rule_tag", " UNION ALL ".join(
    f"SELECT '{tag}' AS table_type, team_raw, count(*) AS n FROM v_bookings WHERE {cond} GROUP BY 2"
    for tag, cond in sql.TAGS.items()))
def _(t):
    return _n(ev.multi_rule_tag(t.bookings, TAG_RULES, EXCLUDED_FIRMS), "table_type", "team_raw")


@query("multi_rule_tag_indexed", _SQL["multi_rule_tag"])
def _(t):
    return _n(ri.multi_rule_tag(t.bookings, TAG_RULES, EXCLUDED_FIRMS), "table_type", "team_raw")


@query("filter_not_future", f"""
    SELECT account_id, cancel_date FROM v_activations WHERE cancel_date <= {sql.AS_OF}""")
def _(t):
    return t.activations.filter(ms.not_future(c("cancel_date"), AS_OF)).select(
        "account_id", "cancel_date")


@query("cancel_eligibility", "SELECT account_id, firm_id, cancel_date, country FROM v_eligible")
def _(t):
    status = t.account_status.join(t.company_status, "account_id")
    return ow.cancel_eligibility(status, CANCELS, AS_OF).select(
        "account_id", "firm_id", "cancel_date", "country")


def _priced_lines(t: Tables) -> DataFrame:
    prices = t.price_entries.select(c("id").alias("price_entry_id"), c("name").alias("price_name"))
    return t.opportunity_lines.join(prices, "price_entry_id", "left")


@query("filter_live_lines", """
    SELECT price_name, count(*) AS n, sum(quantity) AS quantity FROM v_lines
    WHERE (isdeleted = FALSE OR isdeleted IS NULL) AND lower(price_name) NOT LIKE '%cold%'
    GROUP BY 1""")
def _(t):
    return fc.filter_live_lines(_priced_lines(t), excluded="cold").groupBy("price_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity"))


@query("product_group", """
    SELECT CASE WHEN regexp_matches(price_name, 'widget|ring') THEN 'Advanced'
        WHEN price_name LIKE 'red %' THEN 'Payroll' WHEN price_name IS NULL THEN 'No Product Line'
        WHEN price_name LIKE '%gear' THEN 'Hardware' ELSE 'Core' END AS product_group, count(*) AS n
    FROM v_lines GROUP BY 1""")
def _(t):
    return _n(_priced_lines(t).select(fc.product_group(c("price_name"), OPPORTUNITIES)
                                      .alias("product_group")), "product_group")


@query("recency_flags", f"""
    SELECT {sql.fy('event_date')} AS fy,
        CASE WHEN date_diff('day', {sql.qtr_start('event_date')}, event_date) BETWEEN 0 AND 28
            THEN 1 ELSE 0 END AS flag_28days,
        CASE WHEN {sql.week_age('event_date')} BETWEEN 1 AND 4 THEN 'Y' ELSE 'N' END
            AS last_4_week_flag,
        CASE WHEN {sql.week_age('event_date')} BETWEEN 1 AND 13 THEN 'Y' ELSE 'N' END
            AS last_13_week_flag,
        count(*) AS n
    FROM v_bookings GROUP BY 1, 2, 3, 4""")
def _(t):
    return _n(fc.with_ages(t.bookings, RULE, AS_OF), "fy", "flag_28days", "last_4_week_flag",
              "last_13_week_flag")


@query("motion_type", """
    SELECT division_name, signup_category, motion, count(*) AS n FROM v_motion GROUP BY 1, 2, 3""")
def _(t):
    offers = t.offers.select("offer_id", "signup_category")
    df = (t.bookings.join(t.product_offer, "offer_key")
          .withColumn("offer_id", c("src_offer_id").cast("string")).join(offers, "offer_id", "left"))
    return _n(df.withColumn("motion", fc.motion_type(
        c("division_name"), c("offer_id"), c("signup_category"), MOTION)),
        "division_name", "signup_category", "motion")


@query("product_flags", """
    SELECT product, product_family, CASE WHEN product = 'PROMO' THEN 1 ELSE 0 END AS advanced_flag,
        CASE WHEN product_family IN ('Brand#7', 'Brand#9') THEN 1 ELSE 0 END AS payroll_flag,
        CASE WHEN product_family = 'Brand#7' THEN 1 ELSE 0 END AS payroll_flag_recent,
        CASE WHEN product_family = 'Brand#3' THEN 1 ELSE 0 END AS core_flag, count(*) AS n
    FROM v_bookings GROUP BY 1, 2""")
def _(t):
    recent = fc.product_flags(t.bookings, PRODUCTS, recent=True)
    both = fc.product_flags(recent.withColumnRenamed("payroll_flag", "payroll_flag_recent"), PRODUCTS)
    return _n(both, "product", "product_family", "advanced_flag", "payroll_flag",
              "payroll_flag_recent", "core_flag")


@query("relative_age", """
    SELECT date, fiscal_year_age, fiscal_qtr_age, week_age FROM v_ext""")
def _(t):
    return t.order_ext.select("date", "fiscal_year_age", "fiscal_qtr_age", "week_age")


# -- joins -------------------------------------------------------------------------------------------


@query("join_calendar", """
    SELECT fy, qtr, week, event_type, count(*) AS n FROM v_bookings
    LEFT JOIN v_cal ON event_date = date WHERE fy = 2000 GROUP BY 1, 2, 3, 4""")
def _(t):
    booked = ev.in_period(t.bookings, "event_date", RULE, FY, None)
    return _n(ev.join_calendar(booked, t.calendar, FY), "fy", "qtr", "week", "event_type")


@query("join_scd_current", """
    SELECT a.full_name, count(*) AS n FROM v_bookings b JOIN v_agents a ON a.agent_id = b.agent_id
    WHERE a.rec_end = DATE '2999-12-31' GROUP BY 1""")
def _(t):
    return _n(ev.join_scd_current(t.bookings, t.agents), "full_name")


@query("join_scd_asof", """
    SELECT a.division_l3, b.event_type, count(*) AS n FROM v_bookings b JOIN v_agents a
      ON a.agent_id = b.agent_id AND b.event_date BETWEEN a.rec_start AND a.rec_end GROUP BY 1, 2""")
def _(t):
    facts = t.bookings.select("agent_id", "event_date", "event_type")
    return _n(fc.join_scd_asof(facts, t.agents, "agent_id", "event_date", ["division_l3"]),
              "division_l3", "event_type")


@query("join_scd_asof_sorted", _SQL["join_scd_asof"])
def _(t):
    facts = t.bookings.select("agent_id", "event_date", "event_type")
    return _n(asof.join_scd_asof_sorted(facts, t.agents, "agent_id", "event_date",
                                        ["division_l3"]), "division_l3", "event_type")


@query("join_parent_rollup", """
    SELECT p.company_id AS parent_company_id, count(*) AS n,
        count(DISTINCT b.account_id) AS accounts
    FROM v_bookings b JOIN v_accounts a ON b.account_id = a.company_id
    JOIN v_accounts p ON a.parent_id = p.id GROUP BY 1""")
def _(t):
    return fc.join_parent_rollup(t.bookings, t.accounts, "account_id").groupBy(
        "parent_company_id").agg(F.count(F.lit(1)).alias("n"),
                                 F.count_distinct("account_id").alias("accounts"))


@query("join_coerced_key", f"""
    SELECT u.id, u.federation_id, a.name AS agent_name FROM v_users u LEFT JOIN v_agents a
      ON TRY_CAST(u.federation_id AS BIGINT) = a.agent_id AND a.rec_end > {sql.AS_OF}""")
def _(t):
    return ow.join_coerced_key(t.users, ow.current_agents(t.agents, AS_OF)).select(
        "id", "federation_id", "agent_name")


@query("join_owner_chain", """
    SELECT coalesce(n.agent_name, 'Unmanaged') AS account_owner, count(*) AS n,
        count(DISTINCT s.account_id) AS accounts
    FROM v_account_status s LEFT JOIN v_accounts a ON s.firm_id = a.company_id
    LEFT JOIN v_history h ON a.id = h.account AND h.type = 'Owner' AND h.isdeleted = FALSE
    LEFT JOIN v_names n ON n.user_id = h.user_id GROUP BY 1""")
def _(t):
    chain = ow.join_owner_chain(t.account_status, t.accounts, t.owner_history, t.users, t.agents,
                                AS_OF)
    return chain.groupBy("account_owner").agg(F.count(F.lit(1)).alias("n"),
                                              F.count_distinct("account_id").alias("accounts"))


#: Pairs of owner and account that one task of the bucketed chain tells apart.
PAIRS_A_TASK = 500_000


def _stored_alike(t: Tables, key: str, buckets: int, frames: dict[str, DataFrame]) -> list[DataFrame]:
    """The frames as tables in as many buckets of the key, rows without one spread over them."""
    return [t.spark.table(lay.write_bucketed(lay.spread_missing(df, key), [key, lay.SPREAD], buckets,
                                             name)) for name, df in frames.items()]


@query("owner_chain_bucketed", _SQL["join_owner_chain"])
def _(t):
    keyed = t.accounts.select(c("company_id").alias("firm_id"), c("id").alias("account"))
    live = ow.owner_history_rows(t.owner_history)
    accounts, history = _stored_alike(t, "account", lay.bucket_count(keyed, live), {
        "accounts_by_account": keyed, "history_by_account": live})
    intervals = accounts.join(history, ["account", lay.SPREAD], "left").drop(lay.SPREAD)  # bucket by bucket
    # An interval has its owner's name before the companies repeat it, so only they fan out.
    named = intervals.join(ow.user_names(t.users, t.agents, AS_OF), "user_id", "left")
    companies, intervals = _stored_alike(t, "firm_id", lay.bucket_count(t.account_status, intervals), {
        "companies_by_firm": t.account_status, "intervals_by_firm": named})
    chain = (companies.join(intervals, ["firm_id", lay.SPREAD], "left")
             .select("account_id", F.coalesce("agent_name", F.lit("Unmanaged")).alias("account_owner")))
    # A task that tells pairs apart holds them all, so there are as many tasks as the chain needs.
    parts = max(8, math.ceil(chain.count() / PAIRS_A_TASK))
    return (chain.repartition(parts, "account_owner", "account_id").groupBy("account_owner")
            .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("account_id").alias("accounts")))


@query("join_align_teams", """
    SELECT team, qtd_sales, qtd_runrate_sales, qtd_forecast, total_finance_fcst, opp_conv_rate,
        qtg_open_opps FROM v_measures""")
def _(t):
    aligned = fc.join_align_teams([
        fc.team_distinct(t.sales), fc.filtered_sum(t.forecast, FY, QTR, WEEK),
        fc.pipeline_measures(t.pipeline, AS_OF)])
    return aligned.select("team", "qtd_sales", "qtd_runrate_sales", "qtd_forecast",
                          "total_finance_fcst", "opp_conv_rate", "qtg_open_opps")


@query("join_role_playing", """
    SELECT cc.fy AS close_fy, cc.qtr AS close_qtr, dd.fiscal_year_age AS created_year_age,
        count(*) AS n
    FROM v_opps o JOIN v_place cc ON o.close_date = cc.date
    JOIN v_place dd ON o.created_date = dd.date
    GROUP BY 1, 2, 3""")
def _(t):
    return _n(fc.join_role_playing(t.opportunities, t.date_ext), "close_fy", "close_qtr",
              "created_year_age")


@query("join_membership", """
    SELECT fweek, team_raw, count(*) AS n FROM v_fresh
    WHERE fweek NOT IN (SELECT fweek FROM v_store WHERE qtr = 4) GROUP BY 1, 2""")
def _(t):
    store, fresh = _freeze_inputs(t)
    return _n(fz.not_in_weeks(fresh, store.filter(c("qtr") == QTR)), "fweek", "team_raw")


@query("join_multi_dim", """
    SELECT c.fy, c.qtr, o.promotion, o.use, p.company_id AS parent_company_id, count(*) AS n
    FROM v_bookings b LEFT JOIN v_cal c ON b.event_date = c.date
    JOIN part pp ON b.offer_key = pp.p_partkey
    LEFT JOIN v_offers o ON CAST(b.offer_key AS VARCHAR) = o.offer_id
    JOIN v_accounts a ON b.account_id = a.company_id JOIN v_accounts p ON a.parent_id = p.id
    WHERE c.fy = 2000 GROUP BY 1, 2, 3, 4, 5""")
def _(t):
    df = ev.join_calendar(ev.in_period(t.bookings, "event_date", RULE, FY, None), t.calendar, FY)
    df = (df.join(t.product_offer, "offer_key")
          .withColumn("offer_id", c("src_offer_id").cast("string"))
          .join(t.offers.select("offer_id", "promotion", "use"), "offer_id", "left"))
    return _n(fc.join_parent_rollup(df, t.accounts, "account_id"), "fy", "qtr", "promotion", "use",
              "parent_company_id")


# -- aggregations --------------------------------------------------------------------------------------


@query("dedupe_event_rows", """
    SELECT event_date, team_raw, event_type FROM (
        SELECT event_date, team_raw, event_type, country FROM v_bookings GROUP BY 1, 2, 3, 4)""")
def _(t):
    return ev.dedupe_event_rows(t.bookings, ["event_date", "team_raw", "event_type", "country"],
                                ["event_date", "team_raw", "event_type"])


_A2 = ("fy", "qtr", "week", "event_date", "super_channel", "channel", "region", "country",
       "team_raw", "event_type", "firm_id", "product", "offer_name", "offering", "category",
       "division_l4", "division_name", "product_family")


@query("distinct_accounts", f"""
    SELECT {', '.join(k for k in _A2)}, count(DISTINCT account_id) AS distinct_accounts
    FROM (SELECT *, {sql.region('country')} AS region FROM v_bookings
          LEFT JOIN v_cal ON event_date = date WHERE fy = 2000 AND qtr = 4)
    GROUP BY ALL""")
def _(t):
    df = ev.in_period(t.bookings, "event_date", RULE, FY, QTR)
    df = ev.join_calendar(df, ev.period_calendar(df, RULE, FY, QTR), FY, QTR)
    return cnt.distinct_accounts(ev.region_bucket(df, REGIONS), _A2)


_KNOWN = "(SELECT DISTINCT fy, qtr, week, team_raw, account_id FROM v_dated WHERE qtr = 4)"


@query("distinct_accounts_bitmap", f"""
    WITH k AS {_KNOWN},
    t AS (SELECT fy, qtr, week, team_raw AS team, account_id FROM k
          UNION ALL SELECT fy, qtr, week, '*', account_id FROM k),
    first AS (SELECT fy, qtr, team, account_id, min(week) AS week FROM t GROUP BY ALL),
    w AS (SELECT fy, qtr, team, week, count(DISTINCT account_id) AS accounts FROM t GROUP BY ALL)
    SELECT w.fy, w.qtr, w.team, w.week, w.accounts,
        (SELECT count(*) FROM first f WHERE f.team = w.team AND f.fy = w.fy AND f.qtr = w.qtr
             AND f.week <= w.week) AS accounts_to_date,
        (SELECT count(*) FROM first f WHERE f.team = w.team AND f.fy = w.fy AND f.qtr = w.qtr)
            AS accounts_in_quarter
    FROM w""")
def _(t):
    df = ev.in_period(t.bookings, "event_date", RULE, FY, QTR)
    df = ev.join_calendar(df, ev.period_calendar(df, RULE, FY, QTR), FY, QTR)
    df = ev.join_scd_current(df, t.agents)
    keys = ["fy", "qtr", "team", "week"]
    facts = t.materialize(df.select("fy", "qtr", c("team_raw").alias("team"), "week", "account_id")
                          .distinct(), "accounts")  # the one scan of the facts
    maps = bm.account_bitmaps(facts, bm.dense_ids(facts, "account_id"), keys)
    whole = bm.merged(maps.withColumn("team", F.lit("*")), keys)
    maps = t.materialize(maps.unionByName(whole), "bitmaps")
    quarter = bm.counted(maps, keys[:3], "accounts_in_quarter")
    return (bm.counted(maps, keys).join(bm.counted_to_date(maps, keys[:3], "week"), keys)
            .join(quarter, keys[:3]))


@query("conditional_distinct", """
    SELECT team, product, count(DISTINCT CASE WHEN motion = 'Runrate' THEN account_id END) AS rr_sales,
        count(DISTINCT account_id) AS total_sales FROM v_sales GROUP BY 1, 2""")
def _(t):
    return fc.conditional_distinct(t.sales, ["team", "product"], c("motion") == "Runrate")


@query("calendar_weeks", "SELECT * FROM v_weeks")
def _(t):
    return t.order_weeks


@query("team_distinct", """
    SELECT team, count(DISTINCT account_id) AS qtd_sales,
        count(DISTINCT CASE WHEN motion = 'Runrate' THEN account_id END) AS qtd_runrate_sales
    FROM v_sales GROUP BY 1""")
def _(t):
    return fc.team_distinct(t.sales)


@query("filtered_sum", """
    SELECT team, coalesce(sum(CASE WHEN week <= 46 THEN forecast END), 0.0) AS qtd_forecast,
        sum(forecast) AS total_finance_fcst
    FROM v_forecast WHERE fy = 2000 AND qtr = 4 GROUP BY 1""")
def _(t):
    return fc.filtered_sum(t.forecast, FY, QTR, WEEK)


@query("conversion_rate", "SELECT team, opp_conv_rate FROM v_conv")
def _(t):
    return fc.conversion_rate(t.pipeline, AS_OF)


@query("week_team_type_counts", "SELECT fy, qtr, fweek, team, table_type, n FROM v_counts")
def _(t):
    return t.counts


_LABELS = {"AUTOMOBILE": "Direct", "BUILDING": "Direct", "FURNITURE": "Partner",
           "HOUSEHOLD": "Partner"}


@query("weekly_series", """
    SELECT table_type, CASE WHEN team IN ('AUTOMOBILE', 'BUILDING') THEN 'Direct' ELSE 'Partner' END
        AS label, fy, qtr, fweek, CAST(sum(n) AS BIGINT) AS n
    FROM v_teams WHERE team <> 'MACHINERY' GROUP BY 1, 2, 3, 4, 5""")
def _(t):
    return cnt.weekly_series(t.events(), _LABELS)


@query("type_row_counts", "SELECT table_type, count(*) AS n FROM v_weekly GROUP BY 1")
def _(t):
    return cnt.type_row_counts(t.events())


@query("best_worst_week", """
    SELECT table_type, fy, qtr,
        min(fweek) FILTER (n = lo) AS best_week, min(lo) AS best_n,
        min(fweek) FILTER (n = hi) AS worst_week, max(hi) AS worst_n
    FROM (SELECT *, min(n) OVER w AS lo, max(n) OVER w AS hi FROM v_series
          WINDOW w AS (PARTITION BY table_type, fy, qtr)) GROUP BY 1, 2, 3""")
def _(t):
    return cnt.best_worst_week(cnt.weekly_series(t.events()))


@query("weekly_average", """
    SELECT s.table_type, s.fy, s.qtr, a.avg_n, s.fweek, s.n, s.n - a.avg_n AS vs_avg
    FROM v_series s JOIN (SELECT table_type, fy, qtr, max(fweek) AS fweek,
        CAST(round_even(avg(n), 0) AS BIGINT) AS avg_n FROM v_series GROUP BY 1, 2, 3) a
      ON s.table_type = a.table_type AND s.fy = a.fy AND s.qtr = a.qtr AND s.fweek = a.fweek""")
def _(t):
    return cnt.weekly_average(cnt.weekly_series(t.events()))


@query("firm_concentration", """
    SELECT fy, qtr, count(*) AS firms, CAST(sum(n) AS BIGINT) AS cancels,
        CAST(sum(n) AS DOUBLE) / count(*) AS avg_per_firm, count(*) FILTER (n >= 2) AS firms_many,
        count(*) FILTER (n = 1) AS firms_one
    FROM (SELECT fy, qtr, firm_id, count(*) AS n FROM v_snapshot GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def _(t):
    return cnt.firm_concentration(t.snapshot_cancels(), many=2)


@query("top_owners", """
    SELECT * FROM (
        SELECT account_owner, outcome, count(*) AS n, CAST(row_number() OVER (
            PARTITION BY outcome ORDER BY count(*) DESC, account_owner) AS INTEGER) AS rank
        FROM v_outcomes WHERE outcome <> 'matched' GROUP BY 1, 2) WHERE rank <= 40""")
def _(t):
    return ow.top_owners(t.classified(t.cancels()), ["unmanaged", "dropped"])


# -- windows and sequences ------------------------------------------------------------------------------


@query("latest_owner", """
    SELECT account, user_id, start_date, end_date FROM (
        SELECT *, row_number() OVER (PARTITION BY account
            ORDER BY coalesce(end_date, DATE '2999-12-31') DESC, start_date DESC, user_id DESC) AS rn
        FROM v_history WHERE type = 'Owner' AND isdeleted = FALSE) WHERE rn = 1""")
def _(t):
    return ow.latest_owner(t.owner_history)


@query("wow_change", """
    SELECT table_type, team, fy, qtr, fweek, n, lag(n) OVER w AS prev_n, n - lag(n) OVER w AS wow
    FROM (SELECT k.table_type, k.team, k.fy, k.qtr, d.fweek, coalesce(x.n, 0) AS n
          FROM (SELECT DISTINCT table_type, team, fy, qtr FROM v_teams) k
          JOIN (SELECT DISTINCT fy, qtr, fweek FROM v_teams WHERE table_type = 'SALES') d
            ON k.fy = d.fy AND k.qtr = d.qtr
          LEFT JOIN v_teams x ON x.table_type = k.table_type AND x.team = k.team AND x.fy = d.fy
            AND x.qtr = d.qtr AND x.fweek = d.fweek)
    WINDOW w AS (PARTITION BY table_type, team, fy, qtr ORDER BY fweek)""")
def _(t):
    return cnt.wow_change(kpi.team_counts(t.saved_counts()), "SALES")


@query("qtd_running", """
    SELECT fy, qtr, fweek, team, table_type, n, CAST(sum(n) OVER (
        PARTITION BY table_type, team, fy, qtr ORDER BY fweek
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS qtd FROM v_teams""")
def _(t):
    return cnt.qtd_running(kpi.team_counts(t.counts))


_DENSE = """(SELECT k.table_type, k.team, k.fy, k.qtr, w.week AS fweek, coalesce(x.n, 0) AS n
    FROM (SELECT DISTINCT table_type, team, fy, qtr FROM v_teams) k
    JOIN v_weeks w ON k.fy = w.fy AND k.qtr = w.qtr
    LEFT JOIN v_teams x ON x.table_type = k.table_type AND x.team = k.team AND x.fy = w.fy
      AND x.qtr = w.qtr AND x.fweek = w.week)"""


@query("trailing_avg_index", f"""
    SELECT d.table_type, d.team, d.fy, d.qtr, d.fweek, d.n, avg(d.n) OVER (
            PARTITION BY d.table_type, d.team, d.fy, d.qtr ORDER BY d.fweek
            ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS trailing_avg,
        p.prior_qtr_avg, 100.0::DOUBLE * avg(d.n) OVER (
            PARTITION BY d.table_type, d.team, d.fy, d.qtr ORDER BY d.fweek
            ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) / nullif(p.prior_qtr_avg, 0)
            AS index_to_prior_qtr
    FROM {_DENSE} d
    LEFT JOIN (SELECT table_type, team, fy, qtr, avg(n) AS prior_qtr_avg FROM {_DENSE}
               GROUP BY 1, 2, 3, 4) p
      ON p.table_type = d.table_type AND p.team = d.team
      AND p.fy * 4 + p.qtr + 1 = d.fy * 4 + d.qtr""")
def _(t):
    return cnt.trailing_avg_index(kpi.team_counts(t.saved_counts()), t.weeks)


@query("avg_weekly_l13", """
    SELECT team, rr_sales / 13.0::DOUBLE AS avg_weekly_rr,
        coalesce(CAST(rr_sales AS DOUBLE) / nullif(total_sales, 0), 0.0) AS rr_rate
    FROM v_runrate WHERE rr_type = 'Core'""")
def _(t):
    return fc.avg_weekly_rr(t.runrate, "Core")


def _headers(t: Tables) -> DataFrame:
    """Week headers per quarter: some blank, some in the WK form, some carrying dates."""
    w = c("week").cast("string")
    return t.order_weeks.select(
        F.concat(F.lit("FY"), c("fy").cast("string"), F.lit(" Q"), c("qtr").cast("string"))
        .alias("sheet"),
        F.row_number().over(W.partitionBy("fy", "qtr").orderBy("week")).alias("pos"),
        F.when(c("week") % 12 == 0, "").when(c("week") % 7 == 0, F.concat(F.lit("WK"), w))
        .when(c("week") % 7 == 1, F.concat(F.lit("w "), w, F.lit(" May 1-2")))
        .when(c("week") % 11 == 0, "QTD").otherwise(F.concat(F.lit("W"), w)).alias("label"))


_PARSED = "TRY_CAST(regexp_extract(label, '(?i)W\\s*K?\\s*(\\d+)', 1) AS INTEGER)"


@query("fill_week_gap", f"""
    SELECT sheet, pos, label, CASE WHEN p IS NULL AND lead(p) OVER w - lag(p) OVER w = 2
        THEN lag(p) OVER w + 1 ELSE p END AS week
    FROM (SELECT *, {_PARSED} AS p FROM v_headers) WINDOW w AS (PARTITION BY sheet ORDER BY pos)""")
def _(t):
    return st.fill_week_gap(_headers(t), first_week=40)


@query("mix_share", f"""
    SELECT fy, qtr, fweek, team, part_n, whole_n, {sql.ratio('part_n', 'whole_n')} AS share
    FROM (SELECT fy, qtr, fweek, CASE WHEN team = '*' THEN 'TOTAL' ELSE team END AS team,
            CAST(coalesce(sum(n) FILTER (table_type = 'ADV'), 0) AS BIGINT) AS part_n,
            CAST(coalesce(sum(n) FILTER (table_type = 'SALES'), 0) AS BIGINT) AS whole_n
          FROM v_counts GROUP BY 1, 2, 3, 4)""")
def _(t):
    return kpi.mix_share(t.counts, "ADV", "SALES")


_PARTS = "('PKG_A', 'PKG_B', 'PKG_C', 'PKG_LEDGER')"


@query("mix_within_week", f"""
    SELECT fy, qtr, fweek, table_type, n, CAST(n AS DOUBLE) / sum(n) OVER (
        PARTITION BY fy, qtr, fweek) AS share FROM v_series WHERE table_type IN {_PARTS}""")
def _(t):
    return kpi.share_within(t.counts, ["PKG_A", "PKG_B", "PKG_C", "PKG_LEDGER"])


# -- sorts, top-k, set operations -------------------------------------------------------------------------


@query("quarter_weeks", "SELECT * FROM v_weeks WHERE fy = 2000 AND qtr = 4")
def _(t):
    return cal.quarter_weeks(t.order_weeks, FY, QTR)


@query("current_week", "SELECT fy, qtr, week FROM v_now")
def _(t):
    return cal.current_week(t.order_weeks, AS_OF)


@query("driver_weeks", """
    SELECT d.fy, d.qtr, d.driver, max(s.fweek) AS current_week,
        max(s.fweek) FILTER (s.fweek < d.top) AS prior_week
    FROM (SELECT fy, qtr, CASE WHEN count(*) FILTER (table_type = 'PKG_B_ESS') > 0
                THEN 'PKG_B_ESS' ELSE 'SALES' END AS driver,
            coalesce(max(fweek) FILTER (table_type = 'PKG_B_ESS'),
                     max(fweek) FILTER (table_type = 'SALES')) AS top
          FROM v_series WHERE table_type IN ('PKG_B_ESS', 'SALES') GROUP BY 1, 2) d
    JOIN v_series s ON s.fy = d.fy AND s.qtr = d.qtr AND s.table_type = d.driver
    GROUP BY 1, 2, 3""")
def _(t):
    return cnt.driver_weeks(cnt.weekly_series(t.events()), "PKG_B_ESS", "SALES")


@query("union_measure_types", "SELECT team, rr_type, rr_sales, total_sales FROM v_runrate")
def _(t):
    return t.runrate


@query("union_tagged_queries", """
    SELECT table_type, region, count(*) AS n FROM (
        SELECT region, 'SALES' AS table_type FROM v_weekly WHERE table_type = 'SALES'
        UNION ALL SELECT region, 'ALL_CANCELS' FROM v_snapshot
        UNION ALL SELECT region, 'LIVE_CANCELS' FROM v_cancels) GROUP BY 1, 2""")
def _(t):
    frames = {"SALES": t.events(rules=TAG_RULES[:1]), "ALL_CANCELS": t.snapshot_cancels(),
              "LIVE_CANCELS": t.cancels()}
    return _n(ev.union_tagged(frames), "table_type", "region")


@query("select_distinct", """
    SELECT DISTINCT team, stage, product_group, opp_status FROM v_pipeline""")
def _(t):
    return t.pipeline.select("team", "stage", "product_group", "opp_status").distinct()


# -- scalar functions -------------------------------------------------------------------------------------


def _name_forms(t: Tables) -> DataFrame:
    """Agent names in several spellings, with apostrophes, initials and stray blanks."""
    return (t.agents.select("agent_id", F.explode(F.array(
        c("full_name"), c("name"), F.concat(F.lit("  O'"), c("name"), F.lit(" J.  ")),
        F.concat(F.upper("name"), F.lit(",É"))))
        .alias("name")).distinct())


_FORMS = """(SELECT DISTINCT agent_id, form AS name FROM (
    SELECT agent_id, full_name AS form FROM v_agents UNION ALL SELECT agent_id, name FROM v_agents
    UNION ALL SELECT agent_id, '  O''' || name || ' J.  ' FROM v_agents
    UNION ALL SELECT agent_id, upper(name) || ',É' FROM v_agents))"""


@query("normalize_name", f"SELECT agent_id, name, {sql.norm('name')} AS norm FROM {_FORMS}")
def _(t):
    return _name_forms(t).withColumn("norm", tx.normalize_name(c("name")))


@query("token_key", f"SELECT agent_id, name, {sql.tokens('name')} AS tokens FROM {_FORMS}")
def _(t):
    return _name_forms(t).withColumn("tokens", tx.token_key(c("name")))


@query("email_alias", """
    SELECT row_no, AgentEmail AS email, CASE WHEN AgentEmail LIKE '%@%'
        THEN replace(split_part(AgentEmail, '@', 1), '_', ' ') END AS alias FROM v_roster""")
def _(t):
    return t.roster.select("row_no", c("AgentEmail").alias("email"),
                           tx.email_alias(c("AgentEmail")).alias("alias"))


@query("week_label", f"""
    SELECT sheet, pos, {_PARSED} AS week, regexp_replace(lower(regexp_replace(label, '\\s+', '', 'g')),
        '^wk(\\d)', 'w\\1') AS folded FROM v_headers""")
def _(t):
    return _headers(t).select("sheet", "pos", tx.week_number(c("label")).alias("week"),
                              tx.fold_label(c("label")).alias("folded"))


@query("fy_quarter_label", """
    SELECT DISTINCT sheet, fy, CASE WHEN fy >= 2000 THEN fy - 2000 ELSE fy END AS short_fy, qtr,
        CASE WHEN qtr < 4 THEN fy ELSE fy + 1 END AS next_fy,
        CASE WHEN qtr < 4 THEN qtr + 1 ELSE 1 END AS next_qtr, fy * 10 + qtr AS rank
    FROM (SELECT sheet, CAST(split_part(substr(sheet, 3), ' Q', 1) AS INTEGER) AS fy,
            CAST(split_part(sheet, ' Q', 2) AS INTEGER) AS qtr FROM v_headers)""")
def _(t):
    fy, qtr = tx.parse_period(c("sheet"))
    df = _headers(t).select("sheet").distinct().select("sheet", fy.alias("fy"), qtr.alias("qtr"))
    next_fy, next_qtr = tx.next_quarter(c("fy"), c("qtr"))
    return df.select("sheet", "fy", tx.short_year(c("fy")).alias("short_fy"), "qtr",
                     next_fy.alias("next_fy"), next_qtr.alias("next_qtr"),
                     tx.period_rank(c("fy"), c("qtr")).alias("rank"))


@query("date_range_label", """
    SELECT fy, qtr, week, CASE WHEN month(week_start_date) = month(week_end_date)
            THEN strftime(week_start_date, '%b %-d') || '-' || strftime(week_end_date, '%-d')
            ELSE strftime(week_start_date, '%b %-d') || '-' || strftime(week_end_date, '%b %-d') END
            AS range_label,
        CASE WHEN day_count_in_qtr < 7 THEN CAST(day_count_in_qtr AS VARCHAR) || ' days' ELSE '' END
            AS day_label
    FROM v_weeks""")
def _(t):
    return t.order_weeks.select(
        "fy", "qtr", "week",
        tx.date_range_label(c("week_start_date"), c("week_end_date")).alias("range_label"),
        tx.day_count_label(c("day_count_in_qtr")).alias("day_label"))


def _texts(t: Tables) -> DataFrame:
    """Figures as report text, one form per order: money, percent, placeholder, garbage, decimal."""
    k = c("o_orderkey")

    def s(x):
        return x.cast("string")

    m = k % 12
    txt = (F.when(m == 0, F.concat(F.lit("$"), s(k % 900 + 1), F.lit(",020.50")))
           .when(m == 1, F.concat(s(k % 130), F.lit("%"))).when(m == 2, "n/a").when(m == 3, "")
           .when(m == 4, "12abc").when(m == 5, "-").when(m == 6, s(k % 16 / 8))
           .when(m == 7, s(k % 25 + 80)).when(m == 8, "#DIV/0!").when(m == 9, s(k * 37))
           .when(m == 10, s(k % 256 / 16 - 8)))
    return t.raw("orders").select(k.alias("id"), txt.alias("txt"))


@query("parse_number", f"SELECT id, {sql.number('txt')} AS value FROM v_texts")
def _(t):
    return _texts(t).select("id", tx.parse_number(c("txt")).alias("value"))


_HALF_UP = "CAST(CAST(floor({} + 0.5) AS BIGINT) AS VARCHAR)"


@query("format_metric", f"""
    SELECT id, txt,
        CASE WHEN txt IS NULL OR txt = '' THEN '' WHEN txt LIKE '%\\%%' ESCAPE '\\' OR n IS NULL
            THEN txt ELSE {_HALF_UP.format('CASE WHEN abs(n) < 2 AND n <> 0 THEN n * 100 ELSE n END')}
            || '%' END AS percent_text,
        CASE WHEN txt IS NULL OR txt = '' THEN ''
            WHEN txt LIKE '%\\%%' ESCAPE '\\' OR txt LIKE '%,%' OR n IS NULL THEN txt
            WHEN abs(n) < 10 AND n <> floor(n) THEN CASE
                WHEN CAST(floor(n * 10 + 0.5) AS BIGINT) % 10 = 0
                THEN CAST(CAST(floor(n * 10 + 0.5) AS BIGINT) // 10 AS VARCHAR)
                ELSE CAST(floor(n * 10 + 0.5) / 10 AS VARCHAR) END
            ELSE {_HALF_UP.format('n')} END AS number_text,
        CASE WHEN txt IS NULL OR trim(txt) IN ('', '.') THEN ''
            WHEN txt NOT LIKE '%\\%%' ESCAPE '\\' AND n = floor(n)
            THEN format('{{:,}}', CAST(n AS BIGINT)) ELSE trim(txt) END AS cell_text,
        CASE WHEN txt IS NULL THEN '' WHEN txt LIKE '%.%' AND n IS NOT NULL
            THEN {_HALF_UP.format('n')} ELSE txt END AS whole_text
    FROM (SELECT *, {sql.number('txt')} AS n FROM v_texts)""")
def _(t):
    return _texts(t).select("id", "txt", tx.format_percent(c("txt")).alias("percent_text"),
                            tx.format_number(c("txt")).alias("number_text"),
                            tx.format_thousands(c("txt")).alias("cell_text"),
                            tx.format_whole(c("txt")).alias("whole_text"))


@query("signed_delta", f"""
    SELECT a.id, CASE WHEN d > 0 THEN '+' || CAST(d AS VARCHAR) WHEN d < 0 THEN CAST(d AS VARCHAR)
            ELSE '0' END AS wow_text,
        CASE WHEN v IS NULL THEN '' WHEN v = floor(v) THEN CASE WHEN v >= 0 THEN '+' ELSE '' END
                || CAST(CAST(v AS BIGINT) AS VARCHAR)
            ELSE CASE WHEN v >= 0 THEN '+' ELSE '' END || CAST(v AS VARCHAR) END AS variance_text
    FROM (SELECT id, id % 7 - 3 AS d, round({sql.number('txt')} - CAST(id % 5 AS DOUBLE), 10) AS v
          FROM v_texts) a""")
def _(t):
    return _texts(t).select(
        "id", tx.signed(c("id") % 7 - 3).alias("wow_text"),
        tx.signed_variance(c("txt"), (c("id") % 5).cast("string")).alias("variance_text"))


@query("safe_div", f"""
    SELECT fy, qtr, fweek, team, {sql.ratio('adv', 'ledger')} AS share FROM (
        SELECT fy, qtr, fweek, team, sum(n) FILTER (table_type = 'ADV') AS adv,
            coalesce(sum(n) FILTER (table_type = 'PKG_LEDGER'), 0) AS ledger
        FROM v_teams GROUP BY 1, 2, 3, 4)""")
def _(t):
    wide = kpi.team_counts(t.counts).groupBy("fy", "qtr", "fweek", "team").agg(
        F.sum(F.when(c("table_type") == "ADV", c("n"))).alias("adv"),
        F.coalesce(F.sum(F.when(c("table_type") == "PKG_LEDGER", c("n"))), F.lit(0)).alias("ledger"))
    return wide.select("fy", "qtr", "fweek", "team",
                       ms.safe_div(c("adv"), c("ledger")).alias("share"))


@query("quarter_progress", f"""
    SELECT fy, qtr, week,
        greatest(1.0::DOUBLE, date_diff('day', qtr_start, {sql.AS_OF}) / 7.0::DOUBLE)
            AS weeks_completed,
        greatest(0.0::DOUBLE, date_diff('day', {sql.AS_OF}, qtr_end) / 7.0::DOUBLE)
            AS weeks_remaining
    FROM v_ext WHERE date = {sql.AS_OF}""")
def _(t):
    return cal.progress(t.order_ext, AS_OF)


def _band_sql(zero: str = "FALSE") -> str:
    n = (f"CASE WHEN trim(txt) NOT IN ('', '-', '#DIV/0!', 'n/a') AND NOT ({zero}) "
         f"THEN {sql.number('txt')} END")
    return (f"CASE WHEN {n} >= 100 THEN 'green' WHEN {n} >= 95 THEN 'amber' "
            f"WHEN {n} IS NOT NULL THEN 'red' ELSE 'none' END")


@query("index_band", f"""
    SELECT id, {_band_sql()} AS band, {_band_sql("txt = '0'")} AS cancel_band FROM v_texts""")
def _(t):
    return _texts(t).select("id", ms.index_band(c("txt")).alias("band"),
                            ms.index_band(c("txt"), zero_is_blank=True).alias("cancel_band"))


_BANDS = (ms.BandRule(">", 100000, "huge"), ms.BandRule("between", 95, "near", 104),
          ms.BandRule("=", 0, "zero"), ms.BandRule("<", 0, "negative"),
          ms.BandRule("not between", 1, "outer", 1000), ms.BandRule("<=", 1, "one"),
          ms.BandRule("!=", 90, "rest"))


@query("rule_band", f"""
    SELECT id, CASE WHEN n IS NULL THEN 'none' WHEN n > 100000 THEN 'huge'
        WHEN n >= 95 AND n <= 104 THEN 'near' WHEN n = 0 THEN 'zero' WHEN n < 0 THEN 'negative'
        WHEN n < 1 OR n > 1000 THEN 'outer' WHEN n <= 1 THEN 'one' WHEN n <> 90 THEN 'rest'
        ELSE 'none' END AS band
    FROM (SELECT id, {sql.number('txt')} AS n FROM v_texts)""")
def _(t):
    return _texts(t).select("id", ms.rule_band(c("txt"), _BANDS).alias("band"))


@query("relabel_period", """
    SELECT id, label, replace(label, 'FY26 Q4', 'FY27 Q1') AS relabelled,
        regexp_matches(label, '(?i)FY\\d+\\s*(Q\\d+|PKGs|WSB)') AND label NOT LIKE '%FY26 Q4%'
            AS needs_review
    FROM (SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN 'FY26 Q4 ' || p_name
            WHEN 1 THEN 'FY26 Q3 ' || p_name WHEN 2 THEN 'FY26  PKGs ' || p_name
            WHEN 3 THEN 'FY26 Q4 vs FY26 Q4 ' || p_type ELSE p_name END AS label FROM part)""")
def _(t):
    k = c("p_partkey") % 5
    label = (F.when(k == 0, F.concat(F.lit("FY26 Q4 "), "p_name"))
             .when(k == 1, F.concat(F.lit("FY26 Q3 "), "p_name"))
             .when(k == 2, F.concat(F.lit("FY26  PKGs "), "p_name"))
             .when(k == 3, F.concat(F.lit("FY26 Q4 vs FY26 Q4 "), "p_type")).otherwise(c("p_name")))
    old = F.lit("FY26 Q4")
    return t.raw("part").select(c("p_partkey").alias("id"), label.alias("label")).select(
        "id", "label", tx.relabel_period(c("label"), old, F.lit("FY27 Q1")).alias("relabelled"),
        tx.names_other_period(c("label"), old, ["PKGs", "WSB"]).alias("needs_review"))


# -- composite operators ------------------------------------------------------------------------------------


@query("weekly_events", f"SELECT {sql.CONTRACT} FROM v_weekly")
def _(t):
    return t.events()


@query("cancel_events_snapshot", f"SELECT {sql.CONTRACT} FROM v_snapshot")
def _(t):
    return t.snapshot_cancels()


@query("cancel_events", f"SELECT {sql.CONTRACT} FROM v_cancels")
def _(t):
    return t.cancels()


@query("roster_keys", """
    SELECT 'exact' AS kind, key, team FROM v_exact
    UNION ALL SELECT 'token', key, team FROM v_token""")
def _(t):
    return t.roster_keys


@query("classify_owner", f"""
    SELECT {sql.CONTRACT} FROM (SELECT * REPLACE (team AS team_raw) FROM v_classified
                                WHERE team IS NOT NULL)""")
def _(t):
    return ow.classify_owner(t.cancels(), t.roster_keys, OWNERS)


@query("classify_audit", """
    SELECT outcome, count(*) AS n_rows, count(DISTINCT account_owner) AS n_owners
    FROM v_outcomes GROUP BY 1""")
def _(t):
    return ow.classify_audit(t.classified(t.cancels()))


@query("weekly_freeze", f"""
    SELECT 'events' AS target, {sql.CONTRACT} FROM v_frozen
    UNION ALL SELECT 'store', {sql.CONTRACT} FROM v_frozen WHERE fweek < 46
    UNION ALL SELECT 'store', {sql.CONTRACT} FROM v_store WHERE qtr <> 4""")
def _(t):
    frozen = fz.weekly_freeze(*_freeze_inputs(t), FY, QTR, WEEK)
    return frozen.events.withColumn("target", F.lit("events")).unionByName(
        frozen.store.withColumn("target", F.lit("store")))


@query("week_cap", "SELECT fy, qtr, cap, reliable FROM v_caps")
def _(t):
    return st.week_cap(t.order_weeks, t.weeks, AS_OF)


def _resolved(t: Tables) -> DataFrame:
    return st.actual_or_forecast(t.grid(), kpi.team_counts(t.counts), t.caps, ["ADV_UPGRADES"])


@query("actual_or_forecast", "SELECT * FROM v_resolved")
def _(t):
    return _resolved(t)


@query("resolve_state_only", """
    SELECT section, table_type, label, fy, qtr, week, value,
        CASE WHEN future THEN 'forecast' WHEN was AND filled THEN 'actual' ELSE state END AS state,
        is_manual, was AND filled AS changed, NOT (future OR (was AND NOT filled)) AS resolved
    FROM (SELECT *, state = 'forecast' AND NOT is_manual AND NOT future AS was,
            coalesce(value <> 0, FALSE) AS filled
          FROM (SELECT *, coalesce(week > 46, FALSE) AND NOT is_manual AS future FROM v_grid))""")
def _(t):
    return st.resolve_state_only(t.grid(), t.caps)


_BOARD = """(
    SELECT * FROM v_resolved
    UNION ALL
    SELECT section, table_type, label, fy, qtr, week, value,
        CASE WHEN future THEN 'forecast' WHEN was AND filled THEN 'actual' ELSE state END AS state,
        is_manual, was AND filled AS changed, NOT (future OR (was AND NOT filled)) AS resolved
    FROM (SELECT *, state = 'forecast' AND NOT is_manual AND NOT future AS was,
            coalesce(value <> 0, FALSE) AS filled
          FROM (SELECT * REPLACE ('Outside' AS section, CASE WHEN week % 3 = 0 THEN 0.0
                    ELSE value * 2 END AS value),
                  coalesce(week > 46, FALSE) AND NOT is_manual AS future
                FROM v_grid WHERE section = 'Sales')))"""


def _board(t: Tables) -> db.Dashboard:
    """The grid filled from counts, beside rows that come with their values."""
    outside = t.grid().filter(c("section") == "Sales").withColumns({
        "section": F.lit("Outside"), "value": F.when(c("week") % 3 == 0, 0.0).otherwise(c("value") * 2)})
    return db.dashboard_run(t.grid(), outside, kpi.team_counts(t.counts), t.caps, ["ADV_UPGRADES"])


@query("completed_week_flags", f"""
    SELECT fy, qtr, week, bool_and(resolved) AS complete FROM {_BOARD} WHERE week IS NOT NULL
    GROUP BY 1, 2, 3""")
def _(t):
    return _board(t).weeks


@query("dashboard_run", f"""
    SELECT section, table_type, label, b.fy, b.qtr, b.week, value,
        CASE WHEN hit THEN 'actual' ELSE state END AS state, is_manual, changed, resolved,
        hit AS closed_now, coalesce(w.complete, FALSE) AS complete
    FROM (SELECT *, coalesce(week <= 46 AND NOT is_manual AND state = 'forecast', FALSE) AS hit
          FROM {_BOARD}) b
    LEFT JOIN (SELECT fy, qtr, week, bool_and(resolved) AS complete FROM {_BOARD}
               WHERE week IS NOT NULL GROUP BY 1, 2, 3) w
      ON w.fy = b.fy AND w.qtr = b.qtr AND w.week = b.week""")
def _(t):
    return db.cells_with_markers(_board(t))


_GRID_LABELS = {TEAMS[0]: ("First", "All"), TEAMS[1]: ("First", "All"), TEAMS[2]: "All"}


@query("grid_label_counts", f"""
    SELECT g.fy, g.qtr, g.week, g.label, g.forecast, coalesce(n.n, 0) AS actual
    FROM (SELECT fy, qtr, week, x.label, sum(forecast) AS forecast FROM v_forecast f
          JOIN (VALUES {', '.join(f"('{k}', '{x}')" for k, v in _GRID_LABELS.items()
                                  for x in ([v] if isinstance(v, str) else v))}) AS x(team, label)
            ON x.team = f.team WHERE fy = 2000 AND qtr = 4 AND week IS NOT NULL GROUP BY 1, 2, 3, 4) g
    LEFT JOIN (SELECT fy, qtr, fweek, x.label, CAST(sum(n) AS BIGINT) AS n FROM v_teams f
          JOIN (VALUES {', '.join(f"('{k}', '{x}')" for k, v in _GRID_LABELS.items()
                                  for x in ([v] if isinstance(v, str) else v))}) AS x(team, label)
            ON x.team = f.team WHERE table_type = 'SALES' GROUP BY 1, 2, 3, 4) n
      ON n.fy = g.fy AND n.qtr = g.qtr AND n.fweek = g.week AND n.label = g.label""")
def _(t):
    plan = (t.forecast.filter((c("fy") == FY) & (c("qtr") == QTR) & c("week").isNotNull())
            .select("fy", "qtr", c("week").alias("fweek"), "team", F.lit("SALES").alias("table_type"),
                    c("forecast").alias("n")))
    grid = cnt.relabel_teams(plan, _GRID_LABELS).withColumnRenamed("n", "forecast")
    sales = kpi.team_counts(t.counts).filter(c("table_type") == "SALES")
    both = grid.join(cnt.relabel_teams(sales, _GRID_LABELS), ["fy", "qtr", "fweek", "team", "table_type"], "left")
    return both.select("fy", "qtr", c("fweek").alias("week"), c("team").alias("label"), "forecast",
                       F.coalesce("n", F.lit(0).cast("long")).alias("actual"))


@query("transition_audit", """
    SELECT CASE WHEN changed THEN 'flipped' ELSE 'still_forecast' END AS status, section, table_type,
        label, fy, qtr, week, value FROM v_resolved WHERE changed OR NOT resolved""")
def _(t):
    return st.transition_audit(_resolved(t))


@query("close_through_cap", """
    SELECT section, table_type, label, fy, qtr, week, value,
        CASE WHEN hit THEN 'actual' ELSE state END AS state, is_manual, hit AS closed_now
    FROM (SELECT *, coalesce(week <= 46 AND NOT is_manual AND state = 'forecast', FALSE) AS hit
          FROM v_grid)""")
def _(t):
    return st.close_through_cap(t.grid(), t.caps)


@query("quarter_rollover", """
    WITH src AS (SELECT *, row_number() OVER (PARTITION BY section, label ORDER BY week) AS pos
                 FROM (SELECT * REPLACE ('FY0 Q4 ' || label AS label) FROM v_grid
                       WHERE week IS NOT NULL)),
         nxt AS (SELECT *, row_number() OVER (ORDER BY week) AS pos FROM v_weeks
                 WHERE fy = 2001 AND qtr = 1)
    SELECT r.section, r.table_type, replace(r.label, 'FY0 Q4', 'FY1 Q1') AS label,
        n.fy, n.qtr, n.week, s.value,
        CASE WHEN r.is_manual THEN coalesce(s.state, 'forecast') ELSE 'forecast' END AS state,
        r.is_manual,
        'W' || CAST(n.week AS VARCHAR) || CASE WHEN n.day_count_in_qtr < 7 THEN ' '
            || strftime(n.week_start_date, '%b %-d') || '-' || CASE
                WHEN month(n.week_start_date) = month(n.week_end_date)
                THEN strftime(n.week_end_date, '%-d') ELSE strftime(n.week_end_date, '%b %-d') END
            ELSE '' END AS week_header,
        CASE WHEN n.day_count_in_qtr < 7 THEN CAST(n.day_count_in_qtr AS VARCHAR) || ' days' ELSE ''
            END AS day_label,
        FALSE AS needs_review
    FROM (SELECT DISTINCT section, table_type, label, is_manual FROM src) r, nxt n
    LEFT JOIN src s ON s.section = r.section AND s.label = r.label AND s.pos = n.pos""")
def _(t):
    grid = t.grid().withColumn("label", F.concat(F.lit("FY0 Q4 "), "label"))
    return st.quarter_rollover(grid, t.weeks, FY, QTR)


@query("forecast_unpivot", "SELECT fy, qtr, week, team, forecast FROM v_forecast")
def _(t):
    return fc.forecast_unpivot(t.forecast_wide, FORECAST_TEAMS)


def _summary(t: Tables) -> DataFrame:
    return fc.team_forecast_summary(t.sales_base, PRODUCTS, t.pipeline, t.forecast, RULE, AS_OF)


@query("team_forecast_summary", "SELECT * FROM v_summary")
def _(t):
    return _summary(t)


def _index(t: Tables) -> DataFrame:
    """Sales, advanced, upgrade and payroll indexes; last year's sales are the prior-year base."""
    names = {"SALES": "sales", "ADV": "advanced", "ADV_UPGRADES": "upgrades", "PAYROLL": "payroll"}
    label = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])

    # Both years from one scan and one pass; last year only its sales are compared with.
    kind, value = c("table_type"), c("n").cast("double").alias("value")
    roles = F.array_compact(F.array(
        F.when((c("fy") == FY) & kind.isin(list(names)), F.lit("actual")),
        F.when((c("fy") == FY - 1) & (kind == TAG_RULES[0].tag), F.lit("prior"))))
    counted = (kpi.team_counts(cnt.week_team_type_counts(t.events(years=2)))
               .withColumn("role", F.explode(roles))
               .select(label[kind].alias("metric"), F.lit(FY).alias("fy"), "qtr", "team",
                       c("fweek").alias("week"), value, "role"))
    plan = (t.forecast.filter(c("fy") == FY)
            .withColumn("metric", F.explode(F.array(F.lit("sales"), F.lit("upgrades"))))
            .select("metric", "fy", "qtr", "team", "week", c("forecast").alias("value"),
                    F.lit("forecast").alias("role")))
    return kpi.indexes(counted.unionByName(plan), t.weeks)


@query("index_metrics", "SELECT * FROM v_index")
def _(t):
    return _index(t)


@query("attach_rate", f"""
    SELECT fy, qtr, week, team, attached_n, core_n, {sql.ratio('attached_n', 'core_n')} AS attach,
        {sql.ratio('sum(attached_n) OVER w', 'sum(core_n) OVER w')} AS attach_qtd
    FROM (SELECT fy, qtr, fweek AS week, CASE WHEN team = '*' THEN 'TOTAL' ELSE team END AS team,
            CAST(coalesce(sum(n) FILTER (table_type = 'PAYROLL'), 0) AS BIGINT) AS attached_n,
            CAST(coalesce(sum(n) FILTER (table_type = 'SALES'), 0) AS BIGINT) AS core_n
          FROM (SELECT fy, qtr, fweek, team, table_type, n FROM v_counts
                UNION ALL
                SELECT k.fy, k.qtr, w.week, k.team, 'SALES', 0
                FROM (SELECT DISTINCT fy, qtr, team FROM v_counts) k
                JOIN v_weeks w ON w.fy = k.fy AND w.qtr = k.qtr) GROUP BY 1, 2, 3, 4)
    WINDOW w AS (PARTITION BY fy, qtr, team ORDER BY week
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def _(t):
    return kpi.attach_rate(t.counts, "PAYROLL", "SALES", t.weeks)


@query("combined_sales_upgrades", """
    SELECT fy, qtr, fweek, CASE WHEN team = '*' THEN 'TOTAL' ELSE team END AS team,
        CAST(coalesce(sum(n) FILTER (table_type = 'SALES'), 0) AS BIGINT) AS sales_n,
        CAST(coalesce(sum(n) FILTER (table_type = 'ADV_UPGRADES'), 0) AS BIGINT) AS upgrades_n,
        CAST(coalesce(sum(n) FILTER (table_type IN ('SALES', 'ADV_UPGRADES')), 0) AS BIGINT)
            AS combined_n
    FROM v_counts GROUP BY 1, 2, 3, 4""")
def _(t):
    return kpi.combined_sales_upgrades(t.counts, "SALES", "ADV_UPGRADES")


@query("qtd_qtg", "SELECT * FROM v_qtd_qtg")
def _(t):
    return kpi.qtd_qtg(_resolved(t), WEEK)


def _scenarios(t: Tables) -> DataFrame:
    """Scenario inputs per row of the quarter: the forecast, scaled."""
    scale = F.create_map(*[F.lit(x) for x in ("best", 1.25, "most_likely", 1.0, "worst", 0.75,
                                              "target", 1.5)])
    quarter = t.grid().groupBy("section", "label", "fy", "qtr").agg(F.sum("value").alias("v"))
    return quarter.select("section", "label", "fy", "qtr", F.explode(scale).alias("scenario", "k"),
                          "v").select("*", (c("v") * c("k")).alias("value"))


@query("scenario_table", """
    SELECT s.section, s.label, s.fy, s.qtr, v * 1.25::DOUBLE AS best, v AS most_likely,
        v * 0.75::DOUBLE AS worst, v * 1.5::DOUBLE AS target, q.qtd, q.qtg, q.qtd - q.qtg AS delta
    FROM (SELECT section, label, fy, qtr, sum(value) AS v FROM v_grid GROUP BY 1, 2, 3, 4) s
    LEFT JOIN v_qtd_qtg q ON s.section = q.section AND s.label = q.label""")
def _(t):
    return kpi.scenario_table(_scenarios(t), kpi.qtd_qtg(_resolved(t), WEEK))


_WEEKS = RULE.weeks(FY, QTR)


@query("week_grid", f"""
    SELECT section, label, fy, qtr,
        {', '.join(f'max(value) FILTER (week = {w}) AS w{w}' for w in _WEEKS)},
        any_value(q.quarter_total) AS quarter_total, any_value(q.qtd) AS qtd,
        any_value(q.qtg) AS qtg, any_value(q.qtd_average) AS qtd_average
    FROM v_resolved JOIN v_qtd_qtg q USING (section, label, fy, qtr) GROUP BY 1, 2, 3, 4""")
def _(t):
    return rp.week_grid(_resolved(t).filter(c("week").isNotNull()), _WEEKS, WEEK)


_ALL_WEEKS = sorted({*RULE.weeks(FY, 3), *RULE.weeks(FY, QTR)})


@query("package_grid", f"""
    SELECT q.fy, q.qtr, r.row_no, r.label, r.table_type,
        {', '.join(f'max(s.n) FILTER (s.fweek = {w}) AS w{w}' for w in _ALL_WEEKS)},
        CAST(coalesce(sum(s.n), 0) AS BIGINT) AS quarter_total
    FROM (VALUES {', '.join(f"({i}, '{k}', '{v}')" for i, (k, v) in enumerate(PACKAGE_ROWS, 1))})
        AS r(row_no, table_type, label)
    CROSS JOIN (VALUES (2000, 3), (2000, 4)) AS q(fy, qtr)
    LEFT JOIN v_series s ON s.table_type = r.table_type AND s.fy = q.fy AND s.qtr = q.qtr
    GROUP BY 1, 2, 3, 4, 5""")
def _(t):
    return rp.package_grid(t.counts, PACKAGE_ROWS, [(FY, 3), (FY, QTR)], _ALL_WEEKS)


_CARDS = {"sales": rp.SCORECARD, "advanced": rp.SCORECARD, "upgrades": ("actual", "target", "itf"),
          "payroll": rp.SCORECARD}


@query("team_scorecard", """
    SELECT fy, qtr, team, metric, line_no, measure, this_week, qtd FROM (
        SELECT *, bool_or(this_week IS NOT NULL OR qtd IS NOT NULL)
            OVER (PARTITION BY fy, qtr, team, metric) AS filled
        FROM (SELECT fy, qtr, team, metric, 1 AS line_no, 'actual' AS measure, actual AS this_week,
                actual_qtd AS qtd FROM v_index WHERE week = 46
              UNION ALL SELECT fy, qtr, team, metric, 2, 'target', forecast, forecast_qtd
                FROM v_index WHERE week = 46
              UNION ALL SELECT fy, qtr, team, metric, 3, 'itf', itf, itf_qtd
                FROM v_index WHERE week = 46
              UNION ALL SELECT fy, qtr, team, metric, 4, 'itpy', itpy, itpy_qtd
                FROM v_index WHERE week = 46 AND metric <> 'upgrades'))
    WHERE filled""")
def _(t):
    return rp.team_scorecard(_index(t), WEEK, _CARDS)


def _cancel_kinds(t: Tables) -> DataFrame:
    """Cancels with a kind: some passive, some reactivated."""
    key = c("account_id").cast("bigint") % 4
    return t.snapshot_cancels().withColumn(
        "event", F.when(key == 0, "passive_cancel").when(key == 1, "reactivation")
        .otherwise(c("event")))


_KINDS = """(SELECT * REPLACE (CASE CAST(account_id AS BIGINT) % 4 WHEN 0 THEN 'passive_cancel'
    WHEN 1 THEN 'reactivation' ELSE event END AS event) FROM v_snapshot)"""


@query("cancel_breakdown", f"""
    SELECT coalesce(k.fy, p.fy) AS fy, coalesce(k.qtr, p.qtr) AS qtr,
        coalesce(k.fweek, p.week) AS fweek, coalesce(active, 0) AS active,
        coalesce(passive, 0) AS passive, coalesce(reactivated, 0) AS reactivated,
        coalesce(active + passive - reactivated, 0) AS total_cancels, p.forecast
    FROM (SELECT fy, qtr, fweek, count(*) FILTER (event = 'active_cancel') AS active,
            count(*) FILTER (event = 'passive_cancel') AS passive,
            count(*) FILTER (event = 'reactivation') AS reactivated FROM {_KINDS} GROUP BY 1, 2, 3) k
    FULL JOIN (SELECT fy, qtr, week, sum(forecast) AS forecast FROM v_forecast WHERE fy = 2000
               GROUP BY 1, 2, 3) p ON k.fy = p.fy AND k.qtr = p.qtr AND k.fweek = p.week""")
def _(t):
    plan = t.forecast.filter(c("fy") == FY).withColumnRenamed("week", "fweek")
    return rp.cancel_breakdown(_cancel_kinds(t), plan)


@query("cancels_by_team", f"""
    SELECT fy, qtr, fweek, team_raw AS team, count(*) AS n FROM {_KINDS}
    WHERE event = 'active_cancel' GROUP BY 1, 2, 3, 4
    UNION ALL SELECT fy, qtr, fweek, 'TOTAL', count(*) FROM {_KINDS}
    WHERE event = 'active_cancel' GROUP BY 1, 2, 3""")
def _(t):
    return rp.cancels_by_team(_cancel_kinds(t))


@query("validate_expected", """
    SELECT x.table_type, x.week, x.label, x.expected, coalesce(a.n, 0) AS actual,
        coalesce(a.n, 0) = x.expected AS ok,
        bool_and(coalesce(a.n, 0) = x.expected) OVER (PARTITION BY x.table_type, x.week) AS all_ok
    FROM (SELECT 'SALES' AS table_type, week, team AS label,
            CAST(CASE WHEN team = 'BUILDING' THEN 0 ELSE forecast END AS BIGINT) AS expected
          FROM v_forecast WHERE fy = 2000 AND week < 12
          UNION ALL SELECT 'PKG_A', week, team, CAST(0 AS BIGINT) FROM v_forecast
          WHERE fy = 2000 AND week BETWEEN 41 AND 45) x
    LEFT JOIN (SELECT table_type, fweek, team, CAST(sum(n) AS BIGINT) AS n FROM v_teams
        GROUP BY 1, 2, 3) a
      ON a.table_type = x.table_type AND a.fweek = x.week AND a.team = x.label""")
def _(t):
    plan = t.forecast.filter(c("fy") == FY)
    expected = plan.filter(c("week") < 12).select(
        F.lit("SALES").alias("table_type"), "week", c("team").alias("label"),
        F.when(c("team") == "BUILDING", 0).otherwise(c("forecast")).cast("bigint").alias("expected")
    ).unionByName(plan.filter(c("week").between(41, 45)).select(
        F.lit("PKG_A").alias("table_type"), "week", c("team").alias("label"),
        F.lit(0).cast("bigint").alias("expected")))
    return rp.validate_expected(t.events(), expected)


@query("freshness_check", f"""
    SELECT CAST(max(finished_at) - INTERVAL 7 HOUR AS DATE) AS local_date,
        CAST(max(finished_at) - INTERVAL 7 HOUR AS DATE) = DATE '2001-07-31' AS fresh
    FROM {_META}""")
def _(t):
    runs = _run_meta(t).withColumn("finished_at", c("finished_at").cast("timestamp_ntz"))
    return rp.freshness_check(runs, dt.date(2001, 7, 31), "America/Los_Angeles")


_FACT_TYPES = (("SALES", "Total sales"), ("PAYROLL", "Payroll"), ("PKG_C", "Package C"))
_CANCEL_LABELS = TEAMS + ("NOBODY",)
_SGN = "CASE WHEN {0} > 0 THEN '+' ELSE '' END || CAST({0} AS VARCHAR)"


def _facts_sql() -> str:
    names = ", ".join(f"({i}, '{k}', '{v}')" for i, (k, v) in enumerate(_FACT_TYPES))
    teams = ", ".join(f"({i}, '{k}')" for i, k in enumerate(TEAMS))
    labels = ", ".join(f"({i}, '{k}')" for i, k in enumerate(_CANCEL_LABELS))

    def pick(view: str, cond: str, wk: str) -> str:
        return (f"(SELECT coalesce(CAST(sum(n) AS BIGINT), 0) FROM {view} x WHERE x.fy = w.fy "
                f"AND x.qtr = w.qtr AND {cond}{f' AND x.fweek = w.{wk}' if wk else ''})")

    team, kind = "x.table_type = 'SALES' AND x.team = l.name", "x.table_type = l.name"
    wow = _SGN.format("(cur - prev)")
    return f"""
    WITH cx AS (SELECT fy, qtr, fweek, team_raw AS team, count(*) AS n FROM v_snapshot GROUP BY ALL),
    all_series AS (SELECT table_type, fy, qtr, fweek, n FROM v_series
        UNION ALL SELECT 'CANCELS', fy, qtr, fweek, CAST(sum(n) AS BIGINT) FROM cx GROUP BY ALL),
    w AS (SELECT fy, qtr, max(fweek) AS cur_w, (SELECT max(b.fweek) FROM v_series b
            WHERE b.table_type = 'SALES' AND b.fy = a.fy AND b.qtr = a.qtr
              AND b.fweek < max(a.fweek)) AS prior_w
          FROM v_series a WHERE table_type = 'SALES' GROUP BY fy, qtr),
    tr AS (SELECT w.*, {pick('cx', 'TRUE', 'cur_w')} AS cur, {pick('cx', 'TRUE', 'prior_w')} AS prev,
            s.* EXCLUDE (fy, qtr)
        FROM w JOIN (SELECT fy, qtr, string_agg('W' || fweek || ': ' || n, ', ' ORDER BY fweek) AS ls,
                CAST(round_even(avg(n), 0) AS BIGINT) AS av, arg_min(fweek, n * 100 + fweek) AS bw,
                min(n) AS bn, arg_max(fweek, n * 100 - fweek) AS ww, max(n) AS wn
              FROM all_series WHERE table_type = 'CANCELS' GROUP BY fy, qtr) s
          ON s.fy = w.fy AND s.qtr = w.qtr)
    SELECT fy, qtr, 1 AS block, pos AS line_no, name || ': ' || cur || ' this week (last week '
            || prev || ', WoW ' || {wow} || ')' AS fact
    FROM (SELECT w.fy, w.qtr, l.pos, l.name, {pick('v_teams', team, 'cur_w')} AS cur,
            {pick('v_teams', team, 'prior_w')} AS prev FROM w, (VALUES {teams}) AS l(pos, name))
    UNION ALL
    SELECT fy, qtr, 2, pos, title || ': ' || cur || ' this week, WoW ' || {wow} || '; QTD ' || qtd
    FROM (SELECT w.fy, w.qtr, l.pos, l.title, {pick('all_series', kind, 'cur_w')} AS cur,
            {pick('all_series', kind, 'prior_w')} AS prev, {pick('all_series', kind, '')} AS qtd
          FROM w, (VALUES {names}) AS l(pos, name, title))
    UNION ALL
    SELECT fy, qtr, 3, pos, name || ': ' || cur FROM (
        SELECT w.fy, w.qtr, l.pos, l.name, {pick('cx', 'x.team = l.name', 'cur_w')} AS cur
        FROM w, (VALUES {labels}) AS l(pos, name)) WHERE cur > 0
    UNION ALL
    SELECT fy, qtr, 3, 0, '(none)' FROM w WHERE {pick('cx', 'TRUE', 'cur_w')} = 0
    UNION ALL SELECT fy, qtr, 4, 0, 'Total by week: ' || ls FROM tr
    UNION ALL SELECT fy, qtr, 4, 1, 'Quarter weekly average: ' || av FROM tr
    UNION ALL SELECT fy, qtr, 4, 2, 'This week (W' || cur_w || '): ' || cur || ' (WoW '
        || {_SGN.format('(cur - prev)')} || '; vs quarter average ' || {_SGN.format('(cur - av)')}
        || ')' FROM tr
    UNION ALL SELECT fy, qtr, 4, 3, 'Best week (fewest): W' || bw || ' (' || bn
        || '); Worst week (most): W' || ww || ' (' || wn || ')' FROM tr
    UNION ALL SELECT fy, qtr, 4, 0, '(no data)' FROM w
        WHERE NOT EXISTS (SELECT 1 FROM tr WHERE tr.fy = w.fy AND tr.qtr = w.qtr)"""


@query("narrative_facts", _facts_sql())
def _(t):
    events = t.events().select(*WEEKLY_EVENTS.names).unionByName(t.snapshot_cancels())
    cells = t.materialize(cnt.cell_counts(events), "cells")
    series = cells.groupBy("table_type", "fy", "qtr", "fweek").agg(F.sum("n").alias("n"))
    labelled = cells.withColumnRenamed("team", "label")
    return rp.narrative_facts(
        series, labelled.filter(c("table_type") == "SALES"),
        labelled.filter(c("table_type") == "CANCELS"), "SALES", "CANCELS", _FACT_TYPES, TEAMS,
        _CANCEL_LABELS)


_N = "coalesce(CAST({} AS VARCHAR), 'n/a')"


@query("template_summary", f"""
    SELECT *, 'Week 46: ' || {_N.format('total_actual')} || ' against a forecast of '
            || {_N.format('total_forecast')} || ' (' || total_variance || '), index '
            || {_N.format('itf')} || ', to last year ' || {_N.format('itpy')} || chr(10)
            || 'Advanced ' || advanced_actual || ' (' || advanced_mix || ' %), upgrades '
            || upgrades_actual || ', payroll ' || payroll_actual || '; to date '
            || {_N.format('qtd_actual')} || ' (index ' || {_N.format('qtd_itf')} || ')' || chr(10)
            || 'Bright: ' || at_or_over || chr(10) || 'Hot: ' || below AS text
    FROM (SELECT *, CASE WHEN total_actual > 0 THEN CAST(round_even(
                100.0::DOUBLE * advanced_actual / total_actual, 0) AS BIGINT) ELSE 0 END AS advanced_mix
          FROM (SELECT fy, qtr,
            CAST(max(actual) FILTER (t AND s) AS BIGINT) AS total_actual,
            CAST(max(forecast) FILTER (t AND s) AS BIGINT) AS total_forecast,
            CASE WHEN max(variance) FILTER (t AND s) >= 0 THEN '+' ELSE '' END
                || CAST(CAST(max(variance) FILTER (t AND s) AS BIGINT) AS VARCHAR) AS total_variance,
            CAST(round_even(max(itf) FILTER (t AND s), 0) AS BIGINT) AS itf,
            CAST(round_even(max(itpy) FILTER (t AND s), 0) AS BIGINT) AS itpy,
            coalesce(string_agg(team, ', ' ORDER BY team)
                FILTER (s AND NOT t AND actual >= coalesce(forecast, 0)), 'none') AS at_or_over,
            coalesce(string_agg(team, ', ' ORDER BY team)
                FILTER (s AND NOT t AND actual < forecast), 'none') AS below,
            CAST(coalesce(max(actual) FILTER (t AND metric = 'advanced'), 0) AS BIGINT)
                AS advanced_actual,
            CAST(coalesce(max(actual) FILTER (t AND metric = 'upgrades'), 0) AS BIGINT)
                AS upgrades_actual,
            CAST(coalesce(max(actual) FILTER (t AND metric = 'payroll'), 0) AS BIGINT)
                AS payroll_actual,
            CAST(max(actual_qtd) FILTER (t AND s) AS BIGINT) AS qtd_actual,
            CAST(round_even(max(itf_qtd) FILTER (t AND s), 0) AS BIGINT) AS qtd_itf
          FROM (SELECT *, team = 'TOTAL' AS t, metric = 'sales' AS s FROM v_index WHERE week = 46)
          GROUP BY 1, 2 HAVING bool_or(s)))""")
def _(t):
    return rp.template_summary(_index(t), WEEK, "sales", TEAMS)


@query("opportunity_pipeline", "SELECT * FROM v_pipeline")
def _(t):
    return t.pipeline


@query("open_opportunities", """
    SELECT team, count(DISTINCT id) AS qtg_open_opps FROM v_pipeline WHERE opp_status = 'Open'
    GROUP BY 1""")
def _(t):
    return fc.open_opportunities(t.pipeline)


@query("runrate_itf", "SELECT team, rr_type, rr_sales, total_sales FROM v_runrate")
def _(t):
    base = fc.recent_sales(t.sales_base, PRODUCTS)
    return fc.runrate_itf(base, {"Core": "core_flag", "Advanced": "advanced_flag",
                                 "Payroll": "payroll_flag"})


@query("runrate_bitmap", _SQL["runrate_itf"])
def _(t):
    slices = {"Core": "core_flag", "Advanced": "advanced_flag", "Payroll": "payroll_flag"}
    tags = F.array_compact(F.array(*[F.when(c(flag) == 1, F.lit(k)) for k, flag in slices.items()]))
    tagged = fc.recent_sales(t.sales_base, PRODUCTS).withColumn("rr_type", F.explode(tags))
    facts = t.materialize(tagged.select("team", "rr_type", "motion", "account_id").distinct(),
                          "accounts")  # the one scan of the facts
    maps = bm.account_bitmaps(facts, bm.dense_ids(facts, "account_id"),
                              ["team", "rr_type", "motion"])
    keys = ["team", "rr_type"]
    run_rate = bm.counted(maps.filter(c("motion") == MOTION.run_rate), keys, "rr_sales")
    return bm.counted(maps, keys, "total_sales").join(run_rate, keys, "left").select(
        *keys, F.coalesce("rr_sales", F.lit(0)).alias("rr_sales"), "total_sales")


@query("qtd_motion_events", """
    SELECT event_date, account_id, parent_company_id, team, product, product_family, offer_id,
        signup_category, promotion, use, motion, advanced_flag, payroll_flag, core_flag, fy, qtr,
        week, week_age FROM v_sales""")
def _(t):
    return t.sales.select(
        "event_date", "account_id", "parent_company_id", "team", "product", "product_family",
        "offer_id", "signup_category", "promotion", "use", "motion", "advanced_flag", "payroll_flag",
        "core_flag", "fy", "qtr", "week", "week_age")


@query("event_type_counts", """
    SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2""")
def _(t):
    return _n(t.raw("events").select("event_type", F.to_date("ts").alias("day")), "event_type", "day")


# -- the registry ---------------------------------------------------------------------------------------------


def _bind(plan: Plan) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, root: plan(Tables(tune(spark), root))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(plan) for name, plan in _PLANS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql.statement(body) for name, body in _SQL.items()}
