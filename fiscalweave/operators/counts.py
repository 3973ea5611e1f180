"""Counts per week, team and type, and the week-over-week sequences built on them.

Event rows are reduced to counts in one map-side-combined aggregate; totals, windows and pivots
all run on those counts, whose number is set by weeks x teams x types rather than by the events.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fiscalweave.functions.measures import index_to

ANY_TEAM = "*"


def distinct_accounts(df: DataFrame, keys: Sequence[str], account: str = "account_id") -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(account).alias("distinct_accounts"))


def cell_counts(events: DataFrame) -> DataFrame:
    """Row count per (fy, qtr, fweek, team_raw, table_type); rows without a week are left out."""
    return (events.filter(F.col("fweek").isNotNull())
            .groupBy("fy", "qtr", "fweek", F.coalesce("team_raw", F.lit("")).alias("team"),
                     "table_type")
            .agg(F.count(F.lit(1)).alias("n")))


def week_team_type_counts(events: DataFrame) -> DataFrame:
    """Counts by (week, team, type), and by (week, type) under the team label '*'."""
    cells = cell_counts(events)
    keys = ["fy", "qtr", "fweek", "table_type"]
    return (cells.groupingSets([[*keys, "team"], keys], *keys, "team")
            .agg(F.sum("n").alias("n"), F.grouping("team").alias("is_total"))
            .select("fy", "qtr", "fweek",
                    F.when(F.col("is_total") == 1, ANY_TEAM).otherwise(F.col("team")).alias("team"),
                    "table_type", "n"))


def relabel_teams(counts: DataFrame, label_map: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """Counts per report label. Several teams may share a label, a team may count under several of
    them, and teams without a label are left out."""
    pairs = [x for team, labels in label_map.items() for x in (F.lit(team), F.array(*[
        F.lit(v) for v in ([labels] if isinstance(labels, str) else labels)]))]
    labels = F.try_element_at(F.create_map(*pairs), F.col("team"))
    return (counts.withColumn("team", F.explode(labels))
            .groupBy("fy", "qtr", "fweek", "team", "table_type").agg(F.sum("n").alias("n")))


def weekly_series(events: DataFrame, label_map: dict[str, str] | None = None) -> DataFrame:
    """Count per type and week, or per type, team label and week through a label map."""
    cells = cell_counts(events)
    if label_map is not None:
        return relabel_teams(cells, label_map).select(
            "table_type", F.col("team").alias("label"), "fy", "qtr", "fweek", "n")
    return cells.groupBy("table_type", "fy", "qtr", "fweek").agg(F.sum("n").alias("n"))


def type_row_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("table_type").agg(F.count(F.lit(1)).alias("n"))


def best_worst_week(series: DataFrame) -> DataFrame:
    """Week with the fewest and with the most rows per type and quarter; ties go to the earlier."""
    return series.groupBy("table_type", "fy", "qtr").agg(
        F.min_by("fweek", F.struct("n", "fweek")).alias("best_week"), F.min("n").alias("best_n"),
        F.max_by("fweek", F.struct(F.col("n"), -F.col("fweek"))).alias("worst_week"),
        F.max("n").alias("worst_n"))


def weekly_average(series: DataFrame) -> DataFrame:
    """Mean weekly count of the weeks present, halves to even, and the latest week against it."""
    avg = F.bround(F.avg("n"), 0).cast("long")
    return (series.groupBy("table_type", "fy", "qtr")
            .agg(avg.alias("avg_n"), F.max("fweek").alias("fweek"),
                 F.max_by("n", "fweek").alias("n"))
            .withColumn("vs_avg", F.col("n") - F.col("avg_n")))


def firm_concentration(cancels: DataFrame, many: int = 10) -> DataFrame:
    """Firms with cancels, cancels per firm, and firms with ``many`` or more or exactly one."""
    per_firm = (cancels.filter(F.col("firm_id").isNotNull())
                .groupBy("fy", "qtr", "firm_id").agg(F.count(F.lit(1)).alias("n")))
    return per_firm.groupBy("fy", "qtr").agg(
        F.count(F.lit(1)).alias("firms"), F.sum("n").alias("cancels"),
        (F.sum("n") / F.count(F.lit(1))).alias("avg_per_firm"),
        F.count_if(F.col("n") >= many).alias("firms_many"),
        F.count_if(F.col("n") == 1).alias("firms_one"))


# -- sequences over the weeks of a quarter -----------------------------------------------------------


def driver_weeks(series: DataFrame, driver: str, fallback: str) -> DataFrame:
    """Latest and previous week present, per quarter, of the driver type or else the fallback."""
    ranked = (series.filter(F.col("table_type").isin(driver, fallback))
              .groupBy("fy", "qtr", "table_type")
              .agg(F.sort_array(F.collect_set("fweek"), asc=False).alias("weeks")))
    chosen = F.max_by(F.struct("table_type", "weeks"), F.col("table_type") == driver)
    return (ranked.groupBy("fy", "qtr").agg(chosen.alias("d"))
            .select("fy", "qtr", F.col("d.table_type").alias("driver"),
                    F.element_at("d.weeks", 1).alias("current_week"),
                    F.try_element_at("d.weeks", F.lit(2)).alias("prior_week")))


def on_weeks(counts: DataFrame, weeks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts on a given list of weeks per quarter, 0 where a key has no rows.

    ``weeks`` holds (fy, qtr, fweek) once each; a quarter has at most a few dozen.
    """
    spine = counts.select(*keys, "fy", "qtr").distinct().join(weeks, ["fy", "qtr"])
    return (spine.join(counts.select(*keys, "fy", "qtr", "fweek", "n"),
                       [*keys, "fy", "qtr", "fweek"], "left")
            .withColumn("n", F.coalesce("n", F.lit(0).cast("long"))))


def wow_change(counts: DataFrame, driver: str, keys: Sequence[str] = ("table_type", "team")
               ) -> DataFrame:
    """Change against the previous week present in the driver type, a missing count being 0.

    The first week has no previous week and no change.
    """
    present = counts.filter(F.col("table_type") == driver).select("fy", "qtr", "fweek").distinct()
    w = W.partitionBy(*keys, "fy", "qtr").orderBy("fweek")
    return (on_weeks(counts, present, keys)
            .withColumn("prev_n", F.lag("n").over(w))
            .withColumn("wow", F.col("n") - F.col("prev_n")))


def qtd_running(counts: DataFrame, keys: Sequence[str] = ("table_type", "team")) -> DataFrame:
    """Quarter-to-date total up to every week."""
    w = (W.partitionBy(*keys, "fy", "qtr").orderBy("fweek")
         .rowsBetween(W.unboundedPreceding, W.currentRow))
    return counts.withColumn("qtd", F.sum("n").over(w))


def trailing_avg_index(counts: DataFrame, weeks: DataFrame,
                       keys: Sequence[str] = ("table_type", "team"), window: int = 4) -> DataFrame:
    """Trailing average over calendar weeks and its index to the prior quarter's weekly average.

    ``weeks`` is the full calendar of the quarters, so weeks without rows count as 0 on both sides.
    """
    dense = on_weeks(counts, weeks.select("fy", "qtr", F.col("week").alias("fweek")), keys)
    trailing = (W.partitionBy(*keys, "fy", "qtr").orderBy("fweek")
                .rowsBetween(-(window - 1), W.currentRow))
    quarter = dense.groupBy(*keys, "fy", "qtr").agg(F.avg("n").alias("prior_qtr_avg"))
    prior = quarter.withColumn("fy", F.when(F.col("qtr") == 4, F.col("fy") + 1)
                               .otherwise(F.col("fy"))
                               ).withColumn("qtr", F.col("qtr") % 4 + 1)
    return (dense.withColumn("trailing_avg", F.avg("n").over(trailing))
            .join(prior, [*keys, "fy", "qtr"], "left")
            .withColumn("index_to_prior_qtr",
                        index_to(F.col("trailing_avg"), F.col("prior_qtr_avg"))))
