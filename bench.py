"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES
(comma-separated names; default the headline list, 'all' for every registered query).
"""

from __future__ import annotations

import json
import os
import sys
import time
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame

from fiscalweave.config import TagRule
from fiscalweave.operators import rule_index
from fiscalweave.plans import registry
from fiscalweave.plans.binding import EXCLUDED_FIRMS, TAG_RULES, Tables
from fiscalweave.session import local_session

HEADLINE = (
    "weekly_events", "multi_rule_tag", "week_team_type_counts", "distinct_accounts",
    "join_scd_asof", "join_owner_chain", "latest_owner", "cancel_events", "roster_keys",
    "classify_owner", "weekly_freeze", "actual_or_forecast", "forecast_unpivot", "runrate_itf",
    "opportunity_pipeline", "team_forecast_summary", "trailing_avg_index", "index_metrics",
    "week_grid", "narrative_facts",
)


def timed(build, runs: int = 2) -> float:
    """Seconds to plan a query and compute every row and column of it; the better of two runs.

    The first run of a query compiles its generated code, the second is what a longer job sees.
    """
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - start)
    return round(min(seconds), 3)


def one_scan_per_rule(spark, root: str) -> DataFrame:
    """The event table as one query per rule, united: what the single-scan operator replaces."""
    tables = Tables(spark, root)
    return reduce(DataFrame.unionByName, [tables.events(rules=(r,)) for r in TAG_RULES])


def many_rules(n: int) -> list[TagRule]:
    """The rule set and variants of it for products that nothing sells, ``n`` rules in all."""
    kinds = list(TAG_RULES)
    return kinds + [replace(kinds[i % len(kinds)], tag=f"{kinds[i % len(kinds)].tag}_{i}",
                            product=f"none {i}", product_not=None)
                    for i in range(n - len(kinds))]


def tag_counts(spark, root: str, tag, rules: list[TagRule]) -> DataFrame:
    tagged = tag(Tables(spark, root).bookings, rules, EXCLUDED_FIRMS)
    return tagged.groupBy("table_type").count()


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    known = registry.queries()
    names = (list(known) if chosen == "all" else chosen.split(",") if chosen else list(HEADLINE))

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    timed(lambda: known["type_row_counts"](spark, root))  # start executors, warm the JVM
    timings = {n: timed(lambda n=n: known[n](spark, root)) for n in names}
    extra = {}
    if not chosen:
        extra["weekly_events_one_scan_per_rule"] = timed(lambda: one_scan_per_rule(spark, root))
        for n in (len(TAG_RULES), 1_000):
            extra[f"rule_index_{n}_rules"] = timed(
                lambda n=n: tag_counts(spark, root, rule_index.multi_rule_tag, many_rules(n)))
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "compared": extra,
        "sf": os.path.basename(root.rstrip("/")).removeprefix("sf")}))
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
