"""Report tables: grids, scorecards, checks and ready-made text lines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fiscalweave.functions.text import signed
from fiscalweave.operators.counts import ANY_TEAM, best_worst_week, driver_weeks
from fiscalweave.operators.kpi import GRID_KEYS, TOTAL, by_team_and_total, quarter_measures

# -- grids -------------------------------------------------------------------------------------------


def week_columns(weeks: Sequence[int], week: str, value: str) -> list[Column]:
    """One aggregate per listed week: the pivot of a grid with a known column list.

    Written out rather than pivoted so that totals over all weeks share the same aggregate.
    """
    return [F.expr(f"max({value}) FILTER (WHERE {week} = {int(w)}) AS w{int(w)}") for w in weeks]


def _listed(week: str, weeks: Sequence[int]) -> Column:
    """The week itself; a week that has no column is an error, as it would vanish from the grid."""
    message = F.concat(F.lit("week without a column: "), F.col(week).cast("string"))
    return F.when(F.col(week).isin(list(weeks)), F.col(week)).otherwise(
        F.raise_error(message).cast("int"))


def week_grid(cells: DataFrame, weeks: Sequence[int], current_week: int,
              keys: Sequence[str] = GRID_KEYS) -> DataFrame:
    """One row per label: a column per week, then quarter total, to date, to go and average.

    ``weeks`` are those of the quarters shown (``FiscalRule.weeks``), so no extra pass looks for the
    distinct values; a cell of any other week is an error.
    """
    wide = (cells.filter(F.col("week").isNotNull())
            .withColumn("week", _listed("week", weeks)).groupBy(*keys)
            .agg(*week_columns(weeks, "week", "value"), *quarter_measures(current_week)))
    return wide.select(*keys, *[f"w{w}" for w in weeks], "quarter_total", "qtd", "qtg",
                       "qtd_average")


def package_grid(counts: DataFrame, rows: Sequence[tuple[str, str]], quarters: Sequence[tuple],
                 weeks: Sequence[int]) -> DataFrame:
    """Package rows and sub-rows over the weeks of one or more quarters, in a fixed row order.

    ``rows`` lists (table_type, label); a row without sales still shows, with empty cells.
    ``weeks`` are those of the quarters; a count of any other week in them is an error.
    """
    spark = counts.sparkSession
    wanted = [(i, t, label, fy, qtr) for fy, qtr in quarters
              for i, (t, label) in enumerate(rows, 1)]
    frame = spark.createDataFrame(
        wanted, "row_no INT, table_type STRING, label STRING, fy INT, qtr INT")
    shown = reduce(Column.__or__, [(F.col("fy") == fy) & (F.col("qtr") == qtr)
                                   for fy, qtr in quarters])
    wide = (counts.filter(F.col("table_type").isin([t for t, _ in rows]) & shown
                          & (F.col("team") == ANY_TEAM) & F.col("fweek").isNotNull())
            .withColumn("fweek", _listed("fweek", weeks))
            .groupBy("table_type", "fy", "qtr")
            .agg(*week_columns(weeks, "fweek", "n"), F.sum("n").alias("quarter_total")))
    # `frame` is the configured row list: a few dozen rows.
    return (F.broadcast(frame).join(wide, ["table_type", "fy", "qtr"], "left")
            .select("fy", "qtr", "row_no", "label", "table_type", *[f"w{w}" for w in weeks],
                    F.coalesce("quarter_total", F.lit(0).cast("long")).alias("quarter_total")))


SCORECARD = ("actual", "target", "itf", "itpy")


def team_scorecard(indexes: DataFrame, week: int, metrics: Mapping[str, Sequence[str]],
                   prefix: str = "") -> DataFrame:
    """Per team and measure, one column per metric for the week and one for quarter to date.

    ``metrics`` lists the measures each metric shows. A metric without any figure for a team is
    left out of that team's card.
    """
    picked = indexes.filter((F.col("week") == week) & F.col("metric").isin(list(metrics)))
    pairs = {"actual": ("actual", "actual_qtd"), "target": ("forecast", "forecast_qtd"),
             "itf": ("itf", "itf_qtd"), "itpy": ("itpy", "itpy_qtd")}
    shown = F.create_map(*[x for m, names in metrics.items()
                           for x in (F.lit(m), F.array(*[F.lit(n) for n in names]))])
    lines = F.array(*[F.struct(F.lit(i).alias("line_no"), F.lit(n).alias("measure"),
                               F.col(pairs[n][0]).alias("this_week"),
                               F.col(pairs[n][1]).alias("qtd"))
                      for i, n in enumerate(SCORECARD, 1)])
    kept = F.filter(lines, lambda x: F.array_contains(shown[F.col("metric")], x["measure"]))
    full = F.exists(kept, lambda x: x["this_week"].isNotNull() | x["qtd"].isNotNull())
    return (picked.filter(full).select("fy", "qtr", "team", "metric", F.explode(kept).alias("l"))
            .select("fy", "qtr", "team", "metric", "l.*")
            .select("fy", "qtr", "team", "metric", "line_no",
                    F.concat(F.lit(prefix), F.col("measure")).alias("measure"), "this_week", "qtd"))


def cancel_breakdown(cancels: DataFrame, forecast: DataFrame) -> DataFrame:
    """Active, passive, reactivated and total cancels beside the forecast, per week."""
    kinds = cancels.groupBy("fy", "qtr", "fweek").agg(
        *[F.count_if(F.col("event") == e).alias(n) for e, n in (
            ("active_cancel", "active"), ("passive_cancel", "passive"),
            ("reactivation", "reactivated"))])
    plan = forecast.groupBy("fy", "qtr", "fweek").agg(F.sum("forecast").alias("forecast"))
    return (kinds.withColumn("total_cancels",
                             F.col("active") + F.col("passive") - F.col("reactivated"))
            .join(plan, ["fy", "qtr", "fweek"], "full")
            .fillna(0, ["active", "passive", "reactivated", "total_cancels"]))


def cancels_by_team(cancels: DataFrame) -> DataFrame:
    """Active cancels per week and team with a total."""
    active = cancels.filter((F.col("event") == "active_cancel") & F.col("fweek").isNotNull())
    cells = active.groupBy("fy", "qtr", "fweek", F.col("team_raw").alias("team")).agg(
        F.count(F.lit(1)).alias("n"))
    return by_team_and_total(cells, ["fy", "qtr", "fweek"], {"n": F.sum("n")})


# -- checks ------------------------------------------------------------------------------------------


def validate_expected(events: DataFrame, expected: DataFrame,
                      label_map: Mapping[str, str] | None = None) -> DataFrame:
    """Expected against actual row counts per (table_type, week, label), with a verdict per group.

    Labels absent from the events count 0; labels without an expectation are not listed.
    """
    label = F.col("team_raw")
    if label_map is not None:
        pairs = [F.lit(x) for kv in label_map.items() for x in kv]
        label = F.try_element_at(F.create_map(*pairs), label)
    actual = (events.groupBy("table_type", F.col("fweek").alias("week"), label.alias("label"))
              .agg(F.count(F.lit(1)).alias("n")))
    verdict = F.bool_and("ok").over(W.partitionBy("table_type", "week"))
    return (expected.join(actual, ["table_type", "week", "label"], "left")
            .withColumn("actual", F.coalesce("n", F.lit(0).cast("long")))
            .withColumn("ok", F.col("actual").eqNullSafe(F.col("expected")))
            .select("table_type", "week", "label", "expected", "actual", "ok",
                    verdict.alias("all_ok")))


def freshness_check(run_meta: DataFrame, as_of: dt.date, zone: str) -> DataFrame:
    """Did the latest run finish on ``as_of``, seen in the given time zone? Stamps are UTC."""
    latest = F.max(F.col("finished_at").cast("timestamp_ntz"))
    local = F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), latest))
    return run_meta.agg(latest.alias("latest"), local.alias("local_date")).select(
        "local_date", F.coalesce(F.col("local_date") == F.lit(as_of), F.lit(False)).alias("fresh"))


# -- text ----------------------------------------------------------------------------------------------


def narrative_facts(series: DataFrame, teams: DataFrame, cancel_teams: DataFrame, driver: str,
                    cancels: str, toplines: Sequence[tuple[str, str]], labels: Sequence[str],
                    cancel_labels: Sequence[str]) -> DataFrame:
    """Ordered, pre-signed fact lines per quarter; no arithmetic is left to the reader.

    ``series`` counts per (table_type, fy, qtr, fweek); ``teams`` the driver type and
    ``cancel_teams`` the cancels per (label, fy, qtr, fweek). Empty without any driver week.
    """
    weeks = driver_weeks(series, driver, cancels)
    q = ["fy", "qtr"]

    def at(value: Column, week: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("fweek") == F.col(week), value)), F.lit(0)).cast("long")

    def around(df: DataFrame, *keys: str) -> DataFrame:
        """Current, previous and to-date count per key. The driver weeks are a row per quarter."""
        return (df.join(weeks, q).groupBy(*q, *keys, "current_week", "prior_week")
                .agg(at(F.col("n"), "current_week").alias("cur"),
                     at(F.col("n"), "prior_week").alias("prev"), F.sum("n").alias("qtd")))

    has_prior = F.col("prior_week").isNotNull()
    change = signed(F.col("cur") - F.col("prev"))

    def listed(names: Sequence[str]) -> DataFrame:
        """Every configured name once per quarter, in order. The list is a literal array."""
        entries = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(n).alias("name"))
                            for i, n in enumerate(names)])
        return weeks.select(*q, "current_week", "prior_week",
                            F.explode(entries).alias("e")).select("*", "e.*").drop("e")

    def zero(df: DataFrame) -> DataFrame:
        return df.fillna(0, ["cur", "prev", "qtd"])

    def lines(df: DataFrame, block: int, text: Column) -> DataFrame:
        return df.select(*q, F.lit(block).alias("block"), F.col("pos").alias("line_no"),
                         text.alias("fact"))

    def counts_for(names: Sequence[str], df: DataFrame, key: str) -> DataFrame:
        found = around(df, key).select(*q, F.col(key).alias("name"), "cur", "prev", "qtd")
        return zero(listed(names).join(found, [*q, "name"], "left"))

    team_rows = counts_for(labels, teams, "label")
    team_text = F.when(has_prior, F.format_string(
        "%s: %d this week (last week %d, WoW %s)", "name", "cur", "prev", change)
    ).otherwise(F.format_string("%s: %d this week", "name", "cur"))

    kinds = [t for t, _ in toplines]
    top = counts_for(kinds, series, "table_type")
    titles = F.create_map(*[F.lit(x) for kv in toplines for x in kv])
    top_text = F.concat(
        F.format_string("%s: %d this week", titles[F.col("name")], F.col("cur")),
        F.when(has_prior, F.concat(F.lit(", WoW "), change)).otherwise(""),
        F.format_string("; QTD %d", F.col("qtd")))

    cancel_rows = counts_for(cancel_labels, cancel_teams, "label").filter(F.col("cur") > 0)
    cancel_text = F.format_string("%s: %d", "name", "cur")
    some = cancel_rows.select(*q).distinct()
    none_rows = weeks.join(some, q, "left_anti").withColumn("pos", F.lit(0))

    trend = series.filter(F.col("table_type") == cancels)
    by_week = F.array_sort(F.collect_list(F.struct("fweek", "n")))
    listing = F.array_join(F.transform(by_week, lambda x: F.format_string(
        "W%d: %d", x["fweek"], x["n"])), ", ")
    total = trend.groupBy(*q).agg(listing.alias("listing"),
                                  F.bround(F.avg("n"), 0).cast("long").alias("avg_n"))
    now = around(trend).select(*q, "current_week", "prior_week", "cur", "prev")
    joined = (total.join(now, q).join(best_worst_week(trend).drop("table_type"), q))
    wow = F.when(has_prior, F.concat(F.lit("WoW "), change, F.lit("; "))).otherwise("")
    trend_lines = F.array(
        F.concat(F.lit("Total by week: "), F.col("listing")),
        F.format_string("Quarter weekly average: %d", "avg_n"),
        F.concat(F.format_string("This week (W%d): %d (", "current_week", "cur"), wow,
                 F.lit("vs quarter average "), signed(F.col("cur") - F.col("avg_n")), F.lit(")")),
        F.format_string("Best week (fewest): W%d (%d); Worst week (most): W%d (%d)",
                        "best_week", "best_n", "worst_week", "worst_n"))
    trend_rows = joined.select(*q, F.posexplode(trend_lines).alias("pos", "fact"))
    no_trend = weeks.join(trend.select(*q).distinct(), q, "left_anti").withColumn("pos", F.lit(0))

    return (lines(team_rows, 1, team_text)
            .unionByName(lines(top, 2, top_text))
            .unionByName(lines(cancel_rows, 3, cancel_text))
            .unionByName(lines(none_rows, 3, F.lit("(none)")))
            .unionByName(lines(trend_rows, 4, F.col("fact")))
            .unionByName(lines(no_trend, 4, F.lit("(no data)"))))


def template_summary(indexes: DataFrame, week: int, metric: str, teams: Sequence[str],
                     advanced: str = "advanced", upgrades: str = "upgrades",
                     payroll: str = "payroll") -> DataFrame:
    """Deterministic summary per quarter: figures of the week and to date, and a text of them.

    Total against forecast and last year, teams at or over and below their forecast, the other
    metrics of the week, and the quarter to date. An index without a base reads 'n/a'.
    """
    c = F.col
    rows = indexes.filter((c("week") == week)
                          & c("metric").isin(metric, advanced, upgrades, payroll))
    listed = {t: i for i, t in enumerate(teams)}
    order = F.create_map(*[F.lit(x) for kv in listed.items() for x in kv])
    over = c("actual") >= F.coalesce("forecast", F.lit(0.0))
    is_team = (c("metric") == metric) & c("team").isin(list(teams))

    def names(condition: Column) -> Column:
        picked = F.array_sort(F.collect_list(F.when(
            is_team & condition,
            F.struct(F.try_element_at(order, c("team")).alias("pos"), c("team").alias("name")))))
        text = F.array_join(F.transform(picked, lambda x: x["name"]), ", ")
        return F.when(text == "", "none").otherwise(text)

    def of_total(name: str, kind: str = metric) -> Column:
        return F.max(F.when((c("team") == TOTAL) & (c("metric") == kind), c(name)))

    def whole(value: Column) -> Column:
        return F.bround(value, 0).cast("long")

    sums = rows.groupBy("fy", "qtr").agg(
        of_total("actual").cast("long").alias("total_actual"),
        of_total("forecast").cast("long").alias("total_forecast"),
        signed(F.coalesce(of_total("variance"), F.lit(0.0)).cast("long"), zero="+0")
        .alias("total_variance"),
        whole(of_total("itf")).alias("itf"), whole(of_total("itpy")).alias("itpy"),
        names(over).alias("at_or_over"), names(~over).alias("below"),
        *[F.coalesce(of_total("actual", kind), F.lit(0.0)).cast("long").alias(name)
          for kind, name in ((advanced, "advanced_actual"), (upgrades, "upgrades_actual"),
                             (payroll, "payroll_actual"))],
        of_total("actual_qtd").cast("long").alias("qtd_actual"),
        whole(of_total("itf_qtd")).alias("qtd_itf"),
        F.count_if(c("metric") == metric).alias("rows")).filter("rows > 0").drop("rows")
    mix = F.when(c("total_actual") > 0, whole(100.0 * c("advanced_actual") / c("total_actual"))
                 ).otherwise(F.lit(0).cast("long"))
    shown = lambda name: F.coalesce(c(name).cast("string"), F.lit("n/a"))
    line = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    text = F.concat_ws(
        "\n",
        line(f"Week {week}: ", shown("total_actual"), " against a forecast of ",
             shown("total_forecast"), " (", c("total_variance"), "), index ", shown("itf"),
             ", to last year ", shown("itpy")),
        line("Advanced ", shown("advanced_actual"), " (", shown("advanced_mix"), " %), upgrades ",
             shown("upgrades_actual"), ", payroll ", shown("payroll_actual"), "; to date ",
             shown("qtd_actual"), " (index ", shown("qtd_itf"), ")"),
        line("Bright: ", c("at_or_over")), line("Hot: ", c("below")))
    return sums.withColumn("advanced_mix", mix).withColumn("text", text)
