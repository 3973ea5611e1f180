"""Logical tables over the driver's star-schema parquet files, and the rule set used with them.

``oracle.py`` states the same expressions in SQL. Everything here is lazy and column-pruned: a
query that needs three booking columns scans what those three need.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalweave.config import (CancelRules, MotionRules, OpportunityRules, OwnerRules,
                                ProductRules, RegionRules, TagRule)
from fiscalweave.functions.calendar import FiscalRule
from fiscalweave.operators import calendar as cal
from fiscalweave.operators import counts as cnt
from fiscalweave.operators import events as ev
from fiscalweave.operators import forecast as fc
from fiscalweave.operators import owners as ow
from fiscalweave.sources.sinks import rewritten
from fiscalweave.sources.tables import read_table

AS_OF = dt.date(2000, 6, 15)
RULE = FiscalRule()
FY, QTR, WEEK = RULE.position(AS_OF)
# First and last day of the calendar: all years the data may name, and the next one.
CALENDAR = RULE.bounds(FY - 5)[0], RULE.bounds(FY + 2)[1]

TEAMS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
EXCLUDED_FIRMS = (7, 13)
REGIONS = RegionRules(
    groups={"LATAM": ("NATION_1", "NATION_6", "NATION_11", "NATION_16", "NATION_21")},
    standalone=("NATION_3",))

_SALES = dict(event_type="new", offering="CORE", category="F")
_PKG = dict(event_type="new", keep_excluded_firms=False)
TAG_RULES = (
    TagRule("SALES", **_SALES),
    TagRule("PAYROLL", event_type="new", offering="PAY"),
    TagRule("ADV", **_SALES, product="PROMO"),
    TagRule("ADV_SALES", **_SALES, product="PROMO"),
    TagRule("ADV_UPGRADES", event_type="upgrade", category="O", product="PROMO"),
    TagRule("SIGNUP", event_type="signup", offering="PMT"),
    TagRule("PKG_ANY", **_SALES, offer_contains_any_case=("WIDGET",), keep_excluded_firms=False),
    TagRule("PKG_A", **_PKG, offer_contains=("gear", "hot"), product_not="MEDIUM"),
    TagRule("PKG_A_ADV", **_PKG, offer_contains=("gear", "hot"), product="PROMO"),
    TagRule("PKG_A_ESS", **_PKG, offer_contains=("gear", "hot"), product="ECONOMY"),
    TagRule("PKG_B", **_PKG, offer_contains=("gear", "blue"), product_not="MEDIUM"),
    TagRule("PKG_B_ADV", **_PKG, offer_contains=("gear", "blue"), product="PROMO"),
    TagRule("PKG_B_ESS", **_PKG, offer_contains=("gear", "blue"), product="ECONOMY"),
    TagRule("PKG_C", **_PKG, offer_contains=("gear", "large")),
    TagRule("PKG_LEDGER", **_PKG, offer_contains=("gear",), product="MEDIUM"),
)
PACKAGE_ROWS = (
    ("PKG_A", "A (12m)"), ("PKG_A_ADV", "   2 Adv"), ("PKG_A_ESS", "   2 Ess"),
    ("PKG_B", "B (9m)"), ("PKG_B_ADV", "   2 Adv"), ("PKG_B_ESS", "   5 Ess"),
    ("PKG_LEDGER", "Ledger"), ("PKG_C", "C"),
)

CANCELS = CancelRules(countries=REGIONS.groups["LATAM"] + ("NATION_3", "NATION_8", "NATION_13"),
                      super_channel="DIRECT", channels=("1-URGENT", "2-HIGH"))
OWNERS = OwnerRules(
    division_teams={"L3 ALPHA": "Alpha", "L3 BETA": "Beta", "L3 GAMMA": "Gamma",
                    "L3 DELTA": "Delta"},
    segment_teams={"NAT": "Alpha", "REGIONAL": "Beta", "GROW": "Echo"},
    overrides={"Supplier 000000012": "Gamma", "supplier, 000000014": "DROP",
               "Hub Integration 000000003": "Delta"})
MOTION = MotionRules(direct_division="NATIONALS",
                     agent_offer_ids=("3", "11", "19", "27", "35", "43"))
PRODUCTS = ProductRules(advanced_product="PROMO", core_family="Brand#3",
                        payroll_families=("Brand#7", "Brand#9"), payroll_family_recent="Brand#7")
OPPORTUNITIES = OpportunityRules(
    excluded_name_part="cold",
    groups=(("widget|ring", "Advanced"), ("^red ", "Payroll")),
    groups_after_null=(("gear$", "Hardware"),))
DIVISIONS_L4 = ("L4_0", "L4_1", "L4_2")
FORECAST_TEAMS = {f"{t} FCST": t for t in TEAMS} | {"RETIRED FCST": "RETIRED"}


# Column types of the driver's files; stating them spares a schema-reading job per table.
_INT, _LONG, _DOUBLE, _TEXT, _TIME = (T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(),
                                      T.TimestampNTZType())
SCHEMAS = {name: T.StructType([T.StructField(c, t) for c, t in fields.items()]) for name, fields in {
    "nation": {"n_nationkey": _INT, "n_name": _TEXT, "n_regionkey": _INT},
    "customer": {"c_custkey": _LONG, "c_name": _TEXT, "c_nationkey": _INT, "c_acctbal": _DOUBLE,
                 "c_mktsegment": _TEXT},
    "supplier": {"s_suppkey": _LONG, "s_name": _TEXT, "s_nationkey": _INT, "s_acctbal": _DOUBLE},
    "part": {"p_partkey": _LONG, "p_name": _TEXT, "p_brand": _TEXT, "p_type": _TEXT, "p_size": _INT,
             "p_retailprice": _DOUBLE},
    "orders": {"o_orderkey": _LONG, "o_custkey": _LONG, "o_orderstatus": _TEXT,
               "o_totalprice": _DOUBLE, "o_orderdate": _TIME, "o_orderpriority": _TEXT},
    "lineitem": {"l_orderkey": _LONG, "l_partkey": _LONG, "l_suppkey": _LONG, "l_linenumber": _INT,
                 "l_quantity": _DOUBLE, "l_extendedprice": _DOUBLE, "l_discount": _DOUBLE,
                 "l_tax": _DOUBLE, "l_returnflag": _TEXT, "l_linestatus": _TEXT,
                 "l_shipdate": _TIME},
    "events": {"event_id": _LONG, "ts": _TIME, "user_id": _LONG, "event_type": _TEXT,
               "value": _DOUBLE, "props": _TEXT},
}.items()}


class Tables:
    """Logical tables of one data folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.root, name, SCHEMAS.get(name))

    def materialize(self, df: DataFrame, name: str) -> DataFrame:
        """A written table for a frame that several branches of one query read."""
        return rewritten(df, name)

    # -- facts -------------------------------------------------------------------------------------

    @cached_property
    def bookings(self) -> DataFrame:
        o = self.raw("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("account_id"),
            F.to_date("o_orderdate").alias("event_date"), F.col("o_orderpriority").alias("channel"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), "DIRECT")
            .otherwise("PARTNER").alias("super_channel"))
        c = self.raw("customer").select(
            F.col("c_custkey").alias("account_id"), F.col("c_mktsegment").alias("team_raw"),
            F.col("c_mktsegment").alias("division_l3"),
            F.concat(F.lit("L4_"), (F.col("c_nationkey") % 5).cast("string")).alias("division_l4"),
            F.when(F.col("c_nationkey") % 2 == 0, "NATIONALS").otherwise("PARTNERS")
            .alias("division_name"), F.col("c_nationkey").alias("n_nationkey"))
        n = self.raw("nation").select("n_nationkey", F.col("n_name").alias("country"))
        p = self.raw("part").select(
            F.col("p_partkey").alias("offer_key"), F.col("p_type").alias("product"),
            F.col("p_brand").alias("product_family"), F.col("p_name").alias("offer_name"),
            F.when(F.col("p_size") <= 30, "CORE").when(F.col("p_size") <= 40, "PAY")
            .otherwise("PMT").alias("offering"))
        li = self.raw("lineitem").select(
            "l_orderkey", F.col("l_partkey").alias("offer_key"),
            F.col("l_suppkey").alias("firm_id"), F.col("l_suppkey").alias("agent_id"),
            F.when(F.col("l_returnflag") == "N", "new").when(F.col("l_returnflag") == "A", "upgrade")
            .when(F.col("l_returnflag") == "R", "signup").alias("event_type"),
            F.col("l_linestatus").alias("category"))
        headers = o.join(c, "account_id").join(n, "n_nationkey").drop("n_nationkey")
        return li.join(headers, "l_orderkey").join(p, "offer_key")

    # -- calendar ------------------------------------------------------------------------------------

    @cached_property
    def calendar(self) -> DataFrame:
        return cal.fiscal_calendar(cal.date_spine(self.spark, *CALENDAR), RULE)

    @cached_property
    def date_ext(self) -> DataFrame:
        return cal.date_ext(cal.date_spine(self.spark, *CALENDAR), RULE, AS_OF)

    @cached_property
    def weeks(self) -> DataFrame:
        return cal.calendar_weeks(self.calendar, FY - 1, FY + 1)

    @cached_property
    def order_days(self) -> DataFrame:
        """The calendar that the orders span, carried on to the end of the next fiscal year; for
        reports on the calendar itself."""
        return cal.date_spine_of(self.raw("orders"), F.to_date("o_orderdate"),
                                 RULE.bounds(FY + 1)[1])

    @cached_property
    def order_ext(self) -> DataFrame:
        return cal.date_ext(self.order_days, RULE, AS_OF)

    @cached_property
    def order_weeks(self) -> DataFrame:
        return cal.calendar_weeks(cal.fiscal_calendar(self.order_days, RULE), FY - 1, FY + 1)

    # -- dimensions ----------------------------------------------------------------------------------

    @cached_property
    def agents(self) -> DataFrame:
        digits = F.lpad(F.col("s_suppkey").cast("string"), 9, "0")
        versions = F.array(
            F.struct(F.lit(0).alias("v"), F.lit(dt.date(1995, 1, 1)).alias("rec_start"),
                     F.lit(dt.date(1998, 6, 30)).alias("rec_end")),
            F.struct(F.lit(1).alias("v"), F.lit(dt.date(1998, 7, 1)).alias("rec_start"),
                     F.lit(dt.date(2999, 12, 31)).alias("rec_end")))
        name = (F.when(F.col("s_suppkey") % 29 == 3, F.concat(F.lit("Hub Integration "), digits))
                .when(F.col("s_suppkey") % 31 == 5, F.concat(F.lit("Visitor "), digits))
                .when(F.col("s_suppkey") % 6 == 1, F.concat(digits, F.lit(", Supplier")))
                .otherwise(F.concat(F.lit("Supplier "), digits)))
        l3 = F.element_at(F.array(*[F.lit(t) for t in TEAMS]),
                          (F.col("s_nationkey") + F.col("ver.v")) % 4 + 1)
        return (self.raw("supplier")
                .select("s_suppkey", "s_nationkey", F.explode(versions).alias("ver"))
                .select(F.col("s_suppkey").alias("agent_id"),
                        F.concat(digits, F.lit(", Supplier")).alias("full_name"),
                        name.alias("name"), l3.alias("division_l3"),
                        F.concat(F.lit("L4_"), ((F.col("s_nationkey") + F.col("ver.v")) % 5)
                                 .cast("string")).alias("division_l4"),
                        "ver.rec_start", "ver.rec_end"))

    @cached_property
    def accounts(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.raw("customer").select(k.alias("id"), k.alias("company_id"),
                                           (k - k % 10).alias("parent_id"))

    @cached_property
    def owner_history(self) -> DataFrame:
        d = F.to_date("o_orderdate")
        return self.raw("orders").select(
            F.col("o_custkey").alias("account"), (F.col("o_orderkey") % 100).alias("user_id"),
            F.when(F.col("o_orderpriority") == "5-LOW", "Team").otherwise("Owner").alias("type"),
            d.alias("start_date"),
            F.when(F.col("o_orderstatus") != "O", F.date_add(d, 90)).alias("end_date"),
            (F.col("o_orderkey") % 11 == 0).alias("isdeleted"))

    @cached_property
    def users(self) -> DataFrame:
        text = F.col("s_suppkey").cast("string")
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("id"),
            F.when(F.col("s_suppkey") % 7 == 0, F.concat(F.lit("x"), text)).otherwise(text)
            .alias("federation_id"))

    @cached_property
    def account_status(self) -> DataFrame:
        k, d = F.col("o_orderkey"), F.to_date("o_orderdate")
        return self.raw("orders").select(
            k.alias("account_id"), d.alias("first_login"),
            F.when(k % 13 != 0, F.col("o_custkey")).alias("firm_id"),
            F.when(k % 17 != 0, d).alias("sold_date"))

    @cached_property
    def company_status(self) -> DataFrame:
        """Subscription status per order; the cancel date is the last shipment of a finished one."""
        k = F.col("o_orderkey")
        o = self.raw("orders").filter(F.col("o_orderstatus") == "F").select(
            k.alias("account_id"), F.col("o_orderpriority").alias("channel"), "o_custkey",
            F.when(k % 19 == 0, "Trial").when(k % 23 != 0, "Paid").alias("subscription_type"))
        c = self.raw("customer").select(F.col("c_custkey").alias("o_custkey"),
                                        F.col("c_nationkey").alias("n_nationkey"))
        n = self.raw("nation").select("n_nationkey", F.col("n_name").alias("country"))
        last = (self.raw("lineitem").groupBy(F.col("l_orderkey").alias("account_id"))
                .agg(F.to_date(F.max("l_shipdate")).alias("cancel_date")))
        return (o.join(c, "o_custkey").join(n, "n_nationkey").join(last, "account_id")
                .select("account_id", "country",
                        F.when(F.col("channel").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), "DIRECT")
                        .otherwise("PARTNER").alias("super_channel"),
                        "channel", "subscription_type", "cancel_date"))

    @cached_property
    def activations(self) -> DataFrame:
        k = F.col("o_orderkey")
        o = self.raw("orders").select(
            k.alias("account_id"), F.col("o_custkey").alias("firm_id"),
            F.concat(F.lit("Supplier "), F.lpad((k % 100).cast("string"), 9, "0"))
            .alias("account_owner"))
        c = self.raw("customer").select(F.col("c_custkey").alias("firm_id"),
                                        F.col("c_mktsegment").alias("division"))
        status = self.company_status.select("account_id", "country", "cancel_date")
        return o.join(c, "firm_id").join(status, "account_id")

    @cached_property
    def roster(self) -> DataFrame:
        k, nat = F.col("s_suppkey"), F.col("s_nationkey")
        digits = F.lpad((k - F.when(k % 10 == 9, 1).otherwise(0)).cast("string"), 9, "0")
        own = F.lpad(k.cast("string"), 9, "0")
        l3 = F.element_at(F.array(*[F.lit(x) for x in (
            "L3 ALPHA", " L3  BETA ", "L3 GAMMA", "L3 DELTA", "", "L3 ELSEWHERE")]), nat % 6 + 1)
        segment = F.element_at(F.array(*[F.lit(x) for x in (
            "nat", " Regional ", "", "grow")]), nat % 4 + 1)
        return self.raw("supplier").select(
            k.cast("string").alias("row_no"), segment.alias("Segment"),
            F.when(k % 37 == 36, "  ").when(k % 5 == 0, F.concat(digits, F.lit(" Supplier")))
            .otherwise(F.concat(F.lit("Supplier "), digits)).alias("Agent"), l3.alias("L3"),
            F.when(k % 9 == 0, own).otherwise(F.concat(own, F.lit("_supplier@x.org")))
            .alias("AgentEmail"))

    @cached_property
    def offers(self) -> DataFrame:
        size = F.col("p_size")
        return self.raw("part").filter(F.col("p_partkey") % 8 != 0).select(
            F.col("p_partkey").cast("string").alias("offer_id"),
            F.when(size < 10, "AGENT").when(size <= 45, "SELF").alias("signup_category"),
            F.concat(F.lit("PROMO_"), (size % 3).cast("string")).alias("promotion"),
            F.when(size % 2 == 0, "RETAIL").otherwise("WHOLESALE").alias("use"))

    @cached_property
    def product_offer(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.raw("part").select(k.alias("offer_key"), k.alias("src_offer_id"))

    # -- opportunities and forecast --------------------------------------------------------------------

    @cached_property
    def opportunities(self) -> DataFrame:
        k, d, status = F.col("o_orderkey"), F.to_date("o_orderdate"), F.col("o_orderstatus")
        stage = (F.when(status == "F", "Closed Won").when(status == "O", "Commit")
                 .when(k % 2 == 0, "Closed Lost").otherwise("Value"))
        return self.raw("orders").select(
            k.alias("id"), (k % 100).alias("owner_id"), F.col("o_custkey").alias("account_id"),
            stage.alias("stage"), F.col("o_totalprice").alias("amount"),
            (k % 10 / 10.0).alias("probability"), F.date_add(d, 30).alias("close_date"),
            d.alias("created_date"), stage.isin("Closed Won", "Closed Lost").alias("isclosed"),
            (stage == "Closed Won").alias("iswon"))

    @cached_property
    def opportunity_lines(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("opp_id"), F.col("l_partkey").alias("price_entry_id"),
            F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("total"),
            F.when(F.col("l_linenumber") == 7, True).when(F.col("l_linenumber") < 6, False)
            .alias("isdeleted"))

    @cached_property
    def price_entries(self) -> DataFrame:
        return self.raw("part").filter(F.col("p_partkey") % 9 != 0).select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))

    @cached_property
    def forecast_wide(self) -> DataFrame:
        """Last year's orders as next year's plan: text cells, some unreadable, some rows blank."""
        o = self.raw("orders").select("o_custkey", F.to_date("o_orderdate").alias("d"))
        c = self.raw("customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
        d = "d"
        wide = (o.join(c, "o_custkey")
                .groupBy((RULE.year(d) + 1).alias("fy"), RULE.quarter(d).alias("qtr"),
                         RULE.week(d).alias("week"))
                .pivot("c_mktsegment", list(TEAMS)).agg(F.count(F.lit(1))))
        bad = F.col("week") % 10 == 0
        return wide.select(
            F.when(F.col("week") % 17 != 0, F.col("fy").cast("string")).otherwise(" ")
            .alias("year_fy"), F.col("qtr").cast("string").alias("quarter_fy"),
            F.col("week").cast("string").alias("Week_FY"),
            *[(F.when(bad, "abc").otherwise(F.col(t).cast("string")) if t == "BUILDING"
               else F.col(t).cast("string")).alias(f"{t} FCST") for t in TEAMS])

    # -- derived -----------------------------------------------------------------------------------------

    def events(self, fy: int = FY, qtr: int | None = None, rules=TAG_RULES, years: int = 1
               ) -> DataFrame:
        return ev.weekly_events(self.bookings, self.agents, RULE, rules, REGIONS, fy, qtr, TEAMS,
                                EXCLUDED_FIRMS, years)

    def cancels(self, fy: int = FY, qtr: int | None = None) -> DataFrame:
        """Live cancel events, before owners are classified."""
        return ow.cancel_events(self.account_status, self.company_status, self.accounts,
                                self.owner_history, self.users, self.agents, RULE, CANCELS, REGIONS,
                                AS_OF, fy, qtr)

    def snapshot_cancels(self, fy: int = FY, qtr: int | None = None) -> DataFrame:
        return ev.cancel_events_snapshot(self.activations, RULE, REGIONS, AS_OF, fy, qtr)

    @cached_property
    def roster_keys(self) -> DataFrame:
        return ow.roster_keys(self.roster, OWNERS)

    def classified(self, events: DataFrame) -> DataFrame:
        return ow.with_owner_outcome(events, self.roster_keys, OWNERS)

    @cached_property
    def counts(self) -> DataFrame:
        """Counts of the whole fiscal year by (week, team, type) and '*'."""
        return cnt.week_team_type_counts(self.events())

    def saved_counts(self) -> DataFrame:
        """The same counts as a written table, for queries that read them several times."""
        return self.materialize(self.counts, "counts")

    @cached_property
    def forecast(self) -> DataFrame:
        return fc.forecast_unpivot(self.forecast_wide, FORECAST_TEAMS)

    @cached_property
    def sales_base(self) -> DataFrame:
        return fc.sales_base(self.bookings, self.accounts, self.product_offer, self.offers, RULE,
                             AS_OF, DIVISIONS_L4, "new", ("DIRECT",), MOTION)

    @cached_property
    def sales(self) -> DataFrame:
        return fc.qtd_sales(self.sales_base, PRODUCTS)

    @cached_property
    def runrate(self) -> DataFrame:
        return fc.runrate_itf(fc.recent_sales(self.sales_base, PRODUCTS), {
            "Core": "core_flag", "Advanced": "advanced_flag", "Payroll": "payroll_flag"})

    @cached_property
    def pipeline(self) -> DataFrame:
        return fc.opportunity_pipeline(
            self.opportunities, self.opportunity_lines, self.price_entries, self.users, self.agents,
            self.accounts, self.date_ext, RULE, AS_OF, DIVISIONS_L4, OPPORTUNITIES)

    def grid(self) -> DataFrame:
        """Forecast grid of the current quarter: SALES and ADV_UPGRADES rows per team.

        Some cells already show actuals, one label is entered by hand, and one column has no week.
        """
        rows = (self.forecast.filter((F.col("fy") == FY) & (F.col("qtr") == QTR)
                                     & F.col("week").isNotNull())
                .withColumn("e", F.explode(F.array(
                    F.struct(F.lit("Sales").alias("section"), F.lit("SALES").alias("table_type")),
                    F.struct(F.lit("Upgrades").alias("section"),
                             F.lit("ADV_UPGRADES").alias("table_type"))))))
        return rows.select(
            "e.section", "e.table_type", F.col("team").alias("label"), "fy", "qtr",
            F.when(F.col("week") != 53, F.col("week")).alias("week"),
            F.col("forecast").alias("value"),
            F.when(F.col("week") <= 42, "actual").otherwise("forecast").alias("state"),
            (F.col("team") == "MACHINERY").alias("is_manual"))

    @cached_property
    def caps(self) -> DataFrame:
        from fiscalweave.operators import state as st

        return st.week_cap(self.weeks, self.weeks, AS_OF)
