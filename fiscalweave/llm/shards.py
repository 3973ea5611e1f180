"""Contiguous shards of nearly equal byte size from global prefix sums."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fiscalweave.llm.store import Scratch

#: Rows of a range, on average; there are as many ranges as that takes.
ROWS = 250_000
#: Ranges whose totals are summed up in one go.
RUN = 1024


def byte_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per input row: (id, size, text_crc32, law, shard, slot, grown_shard).

    Documents are taken in the order of their identifiers (then size and checksum), and cut into
    ranges of about ``ROWS`` rows by sampled splitters. Every range gets the total of its sizes;
    running sums over runs of ranges, over the ranges of a run and inside each range give every row
    its place in the global byte sequence. Cutting that sequence at equal targets gives ``shards``
    contiguous shards: a row belongs to the shard that holds its middle byte, so no shard is off
    its target by more than one document. ``slot`` numbers the rows of a shard without gaps. Only
    (id, size, checksum) are shuffled, never the text. Rows equal in all three are told apart by a
    row number, so an identifier that repeats on a third of all rows fills many ranges.

    size is the UTF-8 length plus 1; null text has size 1 and checksum 0. Null identifiers come
    first. Rows equal in identifier, size and checksum may swap slots. An empty table gives no
    rows; a shard stays empty when one document is larger than its target. Other columns of the
    table are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    scratch = Scratch(docs.sparkSession, "shards")
    sizes = scratch.write(docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
        F.monotonically_increasing_id().alias("tie")), "sizes")
    order = [F.col("id").asc_nulls_first(), "size", "crc", "tie"]
    slim = scratch.write(
        sizes.repartitionByRange(max(1, math.ceil(sizes.count() / ROWS)), *order)
        .withColumn("part", F.spark_partition_id()), "ranges")
    scratch.drop(sizes)

    # Prefix sums over the totals, by runs of ranges: what lies ahead of each range.
    totals = slim.groupBy("part").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    totals = totals.withColumn("run", F.floor(F.col("part") / RUN))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    in_run, over_runs = before(Window.partitionBy("run").orderBy("part")), before(Window.orderBy("run"))
    ahead_of = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    runs = totals.groupBy("run").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).select(
        "run", ahead_of("size", over_runs).alias("run_bytes"), ahead_of("n", over_runs).alias("run_rows"))
    ahead = totals.select("part", "run", ahead_of("size", in_run).alias("bytes_ahead"),
                          ahead_of("n", in_run).alias("rows_ahead")).join(runs, "run").select(
        "part", (F.col("bytes_ahead") + F.col("run_bytes")).alias("bytes_ahead"),
        (F.col("rows_ahead") + F.col("run_rows")).alias("rows_ahead"))

    inside = Window.partitionBy("part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = 2 * (F.col("bytes_ahead") + F.col("end")) - F.col("size")
    placed = (slim.withColumn("end", F.sum("size").over(upto))
              .withColumn("nr", F.row_number().over(inside))
              .join(ahead, "part")
              .select("id", "size", "crc", middle.alias("middle"),
                      (F.col("rows_ahead") + F.col("nr") - 1).alias("row")))
    total = slim.agg(F.sum("size").alias("all_bytes")).first().all_bytes or 1
    shard = F.least(F.lit(shards - 1), F.expr(f"(middle * {int(shards)}L) div {2 * int(total)}L"))
    placed = scratch.write(placed.withColumn("shard", shard.cast("int")).drop("middle"), "placed")
    scratch.drop(slim)
    opening = placed.groupBy("shard").agg(F.min("row").alias("opening"))  # a row per shard
    return placed.join(F.broadcast(opening), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("opening")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
