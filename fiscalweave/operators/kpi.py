"""Indexes, mixes, attach rates and quarter-to-date figures over weekly counts.

All inputs are counts or forecasts per (team, week); event rows never reach this module.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fiscalweave.functions.measures import index_to, safe_div
from fiscalweave.operators.counts import ANY_TEAM

TOTAL = "TOTAL"


def team_counts(counts: DataFrame) -> DataFrame:
    """The per-team rows of ``counts.week_team_type_counts``."""
    return counts.filter(F.col("team") != ANY_TEAM)


def _of_type(types: Sequence[str] | str) -> Column:
    wanted = [types] if isinstance(types, str) else list(types)
    return F.coalesce(F.sum(F.when(F.col("table_type").isin(wanted), F.col("n"))),
                      F.lit(0)).cast("long")


def by_team_and_total(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]
                      ) -> DataFrame:
    """Measures per (keys, team) with a TOTAL team over all of them."""
    keys = list(keys)
    return (df.groupingSets([[*keys, "team"], keys], *keys, "team")
            .agg(*[m.alias(n) for n, m in measures.items()], F.grouping("team").alias("_total"))
            .withColumn("team", F.when(F.col("_total") == 1, TOTAL).otherwise(F.col("team")))
            .drop("_total"))


def _to_date(*keys: str) -> W:
    return (W.partitionBy(*keys).orderBy("week")
            .rowsBetween(W.unboundedPreceding, W.currentRow))


def on_calendar(cells: DataFrame, weeks: DataFrame, keys: Sequence[str],
                missing: Mapping[str, Column]) -> DataFrame:
    """The cells of each (keys, team) on all weeks of its quarter, and on any other weeks it has.

    ``weeks`` is the calendar (fy, qtr, week); ``missing`` lists the measures and what they are in
    a week without a cell. The cells of a team and quarter, a few dozen, meet in one map, so the
    counts behind them are computed once.
    """
    by = [*keys, "team"]
    none = F.lit(-1)  # stands for a cell without a week
    packed = cells.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct(
        F.coalesce("week", none).alias("week"), F.struct(*missing).alias("m")))).alias("cells"))
    listed = weeks.groupBy("fy", "qtr").agg(F.collect_set("week").alias("listed"))
    all_ = F.array_union(F.map_keys("cells"), F.coalesce("listed", F.array().cast("array<int>")))
    spread = (packed.join(listed, ["fy", "qtr"], "left")
              .select(*by, "cells", F.explode(all_).alias("week"))
              .withColumn("m", F.try_element_at("cells", F.col("week"))))
    return spread.select(
        *by, F.nullif("week", none).alias("week"),
        *[F.when(F.col("m").isNull(), value).otherwise(F.col(f"m.{name}")).alias(name)
          for name, value in missing.items()])


# -- shares ------------------------------------------------------------------------------------------


def mix_share(counts: DataFrame, part: str, whole: str) -> DataFrame:
    """Share of one type in another per (fy, qtr, week, team or total); 0 over nothing."""
    sums = by_team_and_total(team_counts(counts), ["fy", "qtr", "fweek"],
                             {"part_n": _of_type(part), "whole_n": _of_type(whole)})
    return sums.withColumn("share", safe_div(F.col("part_n"), F.col("whole_n")))


def share_within(counts: DataFrame, types: Sequence[str]) -> DataFrame:
    """Share of each listed type among all listed types of a week."""
    cells = (team_counts(counts).filter(F.col("table_type").isin(list(types)))
             .groupBy("fy", "qtr", "fweek", "table_type").agg(F.sum("n").alias("n")))
    week = W.partitionBy("fy", "qtr", "fweek")
    return cells.withColumn("share", safe_div(F.col("n"), F.sum("n").over(week)))


def attach_rate(counts: DataFrame, attached: str, core: str, weeks: DataFrame) -> DataFrame:
    """Attached over core sales per team and total, for the week and quarter to date.

    On every calendar week of the quarter: a week without a sale still has its figures to date.
    """
    sums = by_team_and_total(team_counts(counts), ["fy", "qtr", "fweek"],
                             {"attached_n": _of_type(attached), "core_n": _of_type(core)}
                             ).withColumnRenamed("fweek", "week")
    zero = F.lit(0).cast("long")
    sums = on_calendar(sums, weeks, ["fy", "qtr"], {"attached_n": zero, "core_n": zero})
    upto = _to_date("fy", "qtr", "team")
    return (sums.withColumn("attach", safe_div(F.col("attached_n"), F.col("core_n")))
            .withColumn("attach_qtd", safe_div(F.sum("attached_n").over(upto),
                                               F.sum("core_n").over(upto))))


def combined_sales_upgrades(counts: DataFrame, sales: str, upgrades: str) -> DataFrame:
    """New sales, upgrades and both together per team, total and week."""
    return by_team_and_total(
        team_counts(counts), ["fy", "qtr", "fweek"],
        {"sales_n": _of_type(sales), "upgrades_n": _of_type(upgrades),
         "combined_n": _of_type([sales, upgrades])})


# -- indexes -----------------------------------------------------------------------------------------


def index_metrics(actual: DataFrame, forecast: DataFrame, prior_year: DataFrame,
                  weeks: DataFrame, keys: Sequence[str] = ("metric", "fy", "qtr")) -> DataFrame:
    """Actual, forecast, variance, index to forecast and to prior year; week and quarter to date.

    Inputs are long frames of (keys, team, week, value); ``prior_year`` already carries the fiscal
    year it is compared with. They are stacked and regrouped in one shuffle. An index over a
    missing or zero base is NULL. ``weeks`` is the calendar: every week of a quarter has a row, so
    a team without a sale in a week keeps its figures to date.
    """
    def role(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, "team", "week", F.col("value").cast("double").alias("value"),
                         F.lit(name).alias("role"))

    return indexes(role(actual, "actual").unionByName(role(forecast, "forecast"))
                   .unionByName(role(prior_year, "prior")), weeks, keys)


def indexes(stacked: DataFrame, weeks: DataFrame, keys: Sequence[str] = ("metric", "fy", "qtr")
            ) -> DataFrame:
    """``index_metrics`` of one stacked frame, whose ``role`` is actual, forecast or prior; rows of
    several roles may then come from one pass over their source."""
    keys = list(keys)

    def total(name: str) -> Column:
        return F.sum(F.when(F.col("role") == name, F.col("value")))

    cells = by_team_and_total(
        stacked, [*keys, "week"],
        {"actual": F.coalesce(total("actual"), F.lit(0.0)), "forecast": total("forecast"),
         "prior": total("prior")})
    nothing = F.lit(None).cast("double")
    cells = on_calendar(cells, weeks, keys,
                        {"actual": F.lit(0.0), "forecast": nothing, "prior": nothing})
    upto = _to_date(*keys, "team")
    cells = cells.withColumns({f"{c}_qtd": F.sum(c).over(upto)
                               for c in ("actual", "forecast", "prior")})
    c = F.col
    return cells.select(
        *keys, "team", "week", "actual", "forecast",
        (c("actual") - c("forecast")).alias("variance"),
        index_to(c("actual"), c("forecast")).alias("itf"),
        index_to(c("actual"), c("prior")).alias("itpy"),
        "actual_qtd", "forecast_qtd", (c("actual_qtd") - c("forecast_qtd")).alias("variance_qtd"),
        index_to(c("actual_qtd"), c("forecast_qtd")).alias("itf_qtd"),
        index_to(c("actual_qtd"), c("prior_qtd")).alias("itpy_qtd"))


# -- quarter figures ---------------------------------------------------------------------------------


GRID_KEYS = ("section", "label", "fy", "qtr")


def quarter_measures(week: int) -> list[Column]:
    """Aggregates of grid cells: to date, to go, total and weekly average to date."""
    done = f"week <= {int(week)}"
    total = "coalesce(sum(coalesce(value, 0.0)) FILTER (WHERE {}), 0.0)"
    to_date = total.format(done)
    return [F.expr(x) for x in (
        f"{to_date} AS qtd", f"{total.format('week > ' + str(int(week)))} AS qtg",
        "sum(coalesce(value, 0.0)) AS quarter_total",
        f"coalesce(try_divide({to_date}, CAST(count_if({done}) AS DOUBLE)), 0.0) AS qtd_average")]


def qtd_qtg(cells: DataFrame, week: int, keys: Sequence[str] = GRID_KEYS) -> DataFrame:
    """Quarter to date, to go, total and weekly average to date of each grid row."""
    return (cells.filter(F.col("week").isNotNull()).groupBy(*keys)
            .agg(*quarter_measures(week)))


def scenario_table(scenarios: DataFrame, quarter: DataFrame,
                   names: Sequence[str] = ("best", "most_likely", "worst", "target"),
                   keys: Sequence[str] = GRID_KEYS) -> DataFrame:
    """Scenario columns beside quarter-to-date, to-go and their difference per row."""
    wide = scenarios.groupBy(*keys).pivot("scenario", list(names)).agg(F.sum("value"))
    return (wide.join(quarter.select(*keys, "qtd", "qtg"), list(keys), "left")
            .withColumn("delta", F.col("qtd") - F.col("qtg")))
