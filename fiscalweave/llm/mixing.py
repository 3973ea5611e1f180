"""Mixing sources to target weights by Pfair scheduling.

The documents of a source are cut into blocks. With target weight w, block j (from 1) of a source
may not come before slot floor((j-1)/w) and has to come before slot ceil(j/w). Among the blocks
that are released, the one with the earliest deadline takes each slot. With weights that add up to
one every deadline is met, so after any number of slots each source is less than one block off its
target, as long as it has documents.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalweave.llm.store import Scratch, free_name

#: Documents of a block, slots of a period (the grid that weights are rounded to), sources at most,
#: documents of a bucket that are numbered in one go, on average.
BLOCK, PERIOD, SOURCES, BUCKET = 64, 10_000, 4_000, 10_000


def shares(weights: Mapping[str, float], period: int = PERIOD) -> dict[str, int]:
    """Whole slots per period: largest remainders, one at least for each positive weight."""
    weights = {s: w for s, w in weights.items() if w > 0}
    total = math.fsum(weights.values())
    exact = {s: w / total * period for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (out[s] - exact[s], str(s)))
    step, i = (1 if sum(out.values()) < period else -1), 0
    while sum(out.values()) != period:
        s = order[i % len(order)] if step > 0 else order[-1 - i % len(order)]
        if step > 0 or out[s] > 1:
            out[s] += step
        i += 1
    return out


def schedule(slots: Mapping[str, int]) -> dict[str, list[int]]:
    """Slots of each source's blocks within one period, earliest deadline first."""
    period = sum(slots.values())
    due = {s: -(-period // n) for s, n in slots.items()}
    released = [(due[s], str(s), s, 1) for s in slots]
    heapq.heapify(released)
    waiting: list[tuple] = []
    out: dict[str, list[int]] = {s: [] for s in slots}
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, s, j = heapq.heappop(waiting)[1:]
            heapq.heappush(released, (-(-j * period // slots[s]), str(s), s, j))
        _, _, s, j = heapq.heappop(released)
        out[s].append(slot)
        if j < slots[s]:
            heapq.heappush(waiting, (j * period // slots[s], str(s), s, j + 1))
    return out


def mixed(docs: DataFrame, weights: Mapping[str, float] | None = None, id_col: str = "doc_id",
          source_col: str = "source", block: int = BLOCK, seed: int = 3, period: int = PERIOD,
          sources: int = SOURCES, bucket: int = BUCKET) -> DataFrame:
    """Every row with (mix_block, mix_release, mix_deadline, mix_slot, mix_row), all long.

    Order by (mix_slot, mix_row) to read the mixture; a slot is one block of one source. Within a
    source, documents are shuffled by a hash and cut into blocks of ``block``. ``weights`` gives
    each source its share; sources that are not in it, and null as a source of its own, get the
    mean of the given weights, and without weights all sources count the same. Weights are rounded
    to the grid of ``period`` slots, and a positive weight below one slot counts as one. When a source has no block left its slots stay empty; the
    others go on in their proportions. No row is lost or repeated, whatever the weights; a source
    of weight 0 comes after all others.

    The schedule of one period repeats, so a block's slot follows from its number. Rows are
    numbered per bucket of a source's hash range, with prefix sums over buckets, so a source with a
    third of all rows is split among tasks. Rows equal in identifier may swap places; rows without
    identifier are shuffled by a hash of all they hold, so they do not meet in one bucket. An empty
    table gives no rows. More than ``sources`` sources, whose schedule the driver makes, are an
    error, not a cut.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    name = {c: free_name(docs, c) for c in ("src", "h", "b", "nr", "ahead", "period", "slots")}
    src, h, b, nr, ahead = (name[c] for c in ("src", "h", "b", "nr", "ahead"))
    clash = {"mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_row"} & {
        c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"documents already have columns {sorted(clash)}")

    key = F.coalesce(F.concat(F.lit("s:"), F.col(source_col).cast("string")), F.lit("null"))
    counts = docs.groupBy(key.alias("s")).agg(F.count("*").alias("n")).limit(sources + 1).collect()
    if len(counts) > sources:
        raise ValueError(f"more than {sources} sources")
    given = {f"s:{s}": float(w) for s, w in (weights or {}).items()}
    mean = math.fsum(given.values()) / len(given) if given else 1.0
    target = {r.s: given.get(r.s, mean) for r in counts}
    total = sum(r.n for r in counts)
    if target and not any(w > 0 for w in target.values()):
        target = dict.fromkeys(target, 1.0)
    slots = shares(target, period) if target else {}
    plan = schedule(slots) if target else {}
    table = spark.createDataFrame(
        [(s, slots.get(s, 0), plan.get(s, [])) for s in target],
        "s string, share long, places array<long>")  # at most ``sources`` rows, ``period`` places

    buckets = max(1, math.ceil(total / bucket))
    content = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in docs.columns], F.lit(seed))
    hashed = F.when(F.col(id_col).isNull(), content).otherwise(F.xxhash64(id_col, F.lit(seed)))
    rows = docs.withColumn(src, key).withColumn(h, hashed).withColumn(
        b, F.floor((F.shiftrightunsigned(F.col(h), 1) / F.lit(float(1 << 63))) * buckets)
        .cast("int"))
    per = rows.groupBy(F.col(src).alias("s"), F.col(b).alias("k")).agg(F.count("*").alias("n"))
    upto = Window.partitionBy("s").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    per = scratch.write(per.select("s", "k", F.coalesce(F.sum("n").over(upto), F.lit(0))
                                   .alias(ahead)), "buckets")
    inside = Window.partitionBy(src, b).orderBy(h, id_col)
    numbered = rows.withColumn(nr, F.row_number().over(inside))
    numbered = numbered.join(per, (F.col(src) == per.s) & (F.col(b) == per.k)).drop("s", "k") \
        if not {"s", "k"} & {c.lower() for c in docs.columns} else numbered.join(
            per.withColumnsRenamed({"s": f"{src}_2", "k": f"{b}_2"}),
            (F.col(src) == F.col(f"{src}_2")) & (F.col(b) == F.col(f"{b}_2"))
        ).drop(f"{src}_2", f"{b}_2")
    place = table.select(F.col("s").alias(f"{src}_3"), F.col("share").alias(name["slots"]),
                         F.col("places").alias(name["period"]))
    numbered = numbered.join(F.broadcast(place), F.col(src) == F.col(f"{src}_3")).drop(f"{src}_3")
    index = F.col(ahead) + F.col(nr) - 1
    j = F.floor(index / block).cast("long")
    share, places = F.col(name["slots"]), F.col(name["period"])
    size = int(sum(slots.values())) or 1
    live = share > 0
    turn = F.when(live, F.expr(f"`mix_block` div `{name['slots']}`"))
    slot = turn * size + F.element_at(
        places, F.when(live, F.expr(f"`mix_block` % `{name['slots']}`") + 1).cast("int"))
    last = F.lit(1 << 60) + F.col("mix_block")
    out = (numbered.withColumn("mix_block", j)
           .withColumn("mix_row", index % block)
           .withColumn("mix_slot", F.when(live, slot).otherwise(last))
           .withColumn("mix_release", F.when(live, F.expr(
               f"(`mix_block` * {size}L) div `{name['slots']}`")))
           .withColumn("mix_deadline", F.when(live, F.expr(
               f"((`mix_block` + 1) * {size}L + `{name['slots']}` - 1) div `{name['slots']}`"))))
    made = ["mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_row"]
    return out.select(*docs.columns, *[F.col(c).cast(T.LongType()) for c in made])


def in_mixed_order(docs: DataFrame, weights: Mapping[str, float] | None = None, **options
                   ) -> DataFrame:
    """The rows with their own columns, sorted into the mixture: a reader that takes the written
    files in order gets each source at its target weight."""
    return mixed(docs, weights, **options).orderBy("mix_slot", "mix_row").select(*docs.columns)
