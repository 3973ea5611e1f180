"""The dashboard run: fill the week grid, close what is done, and say what changed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fiscalweave.functions.calendar import FiscalRule
from fiscalweave.config import ProductRules
from fiscalweave.operators import forecast as fc
from fiscalweave.operators import state as st
from fiscalweave.sources import sinks


@dataclass(frozen=True)
class Dashboard:
    """``cells`` to show, ``weeks`` that are complete, and the ``audit`` of the run."""

    cells: DataFrame
    weeks: DataFrame
    audit: DataFrame


def dashboard_run(counted: DataFrame, external: DataFrame, counts: DataFrame, caps: DataFrame,
                  write_zero_types: Sequence[str] = ()) -> Dashboard:
    """Both passes over the grid and what follows from them, as one plan.

    ``counted`` rows are filled from ``counts``; ``external`` rows come with their values and only
    change state. A week is complete when neither pass left a forecast in it. At last every
    forecast up to a reliable cap is closed.
    """
    first = st.actual_or_forecast(counted, counts, caps, write_zero_types)
    second = st.resolve_state_only(external, caps)
    resolved = first.unionByName(second.select(first.columns))
    return Dashboard(st.close_through_cap(resolved, caps), st.completed_week_flags(resolved),
                     st.transition_audit(resolved))


def cells_with_markers(board: Dashboard) -> DataFrame:
    """The cells beside the marker of their week, from one pass over the cells.

    Closing forecasts changes no ``resolved``, so the closed cells still tell which weeks are
    complete. Cells without a week belong to no marker.
    """
    week = Window.partitionBy("fy", "qtr", "week")
    done = F.bool_and("resolved").over(week) & F.col("week").isNotNull()
    return board.cells.withColumn("complete", F.coalesce(done, F.lit(False)))


def publish_forecast_summary(base: DataFrame, products: ProductRules, pipeline: DataFrame,
                             forecast: DataFrame, rule: FiscalRule, as_of: dt.date, target: str
                             ) -> DataFrame:
    """The forecast-summary run: team summary, rounded for export, written as a full snapshot;
    returns the published table."""
    summary = fc.team_forecast_summary(base, products, pipeline, forecast, rule, as_of)
    rounded = sinks.round_for_export(summary, fc.RATIOS, ["team"])
    sinks.write_snapshot(rounded, target)
    return sinks.read_snapshot(base.sparkSession, target)
