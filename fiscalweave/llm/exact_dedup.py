"""Exact deduplication by content sort: equal texts meet as neighbours of one sorted sequence."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscalweave.llm.store import Scratch

#: A text is hot when its copies hold at least this share of the rows; at most 1/share texts are.
HOT_SHARE = 0.002
#: A hot text is dealt over this many sort keys.
SALTS = 64
#: Leading characters of a text in its sort key, and keys that splitters are drawn from.
HEAD, SAMPLE = 64, 20_000


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else; null is the empty text."""
    text = F.coalesce(text, F.lit(""))
    plain = F.length(text) == F.octet_length(text)
    return (F.when(plain, F.lower(text))
            .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase)))


def range_of(value: Column, cuts: list) -> Column:
    """How many of the sorted cuts are at most ``value``, by a search over two levels."""
    if not cuts:
        return F.lit(0)
    step = max(1, round(len(cuts) ** 0.5))
    tiles = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    heads = F.array(*[F.lit(t[0]) for t in tiles])
    tails = F.array(*[F.array(*[F.lit(x) for x in t]) for t in tiles])
    tile = F.size(F.filter(heads, lambda c: c <= value))
    inner = F.size(F.filter(F.element_at(tails, F.greatest(tile, F.lit(1))), lambda c: c <= value))
    return F.when(tile == 0, F.lit(0)).otherwise((tile - 1) * step + inner)


def _splitters(keys: DataFrame, parts: int) -> list[str]:
    """Up to ``parts`` - 1 cuts of the sort keys at equal shares of a bounded sample."""
    rows = keys.count()
    share = min(1.0, SAMPLE / max(1, rows))
    drawn = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = sorted(r.key for r in keys.filter(drawn).select("key").collect())
    return sorted({sample[len(sample) * i // parts] for i in range(1, parts)} if sample else [])


def _grouped(docs: DataFrame, id_col: str, text_col: str, keep: str, partitions: int | None,
             carry: dict[str, Column]) -> DataFrame:
    """``carry`` and (id_, text_, salt_, group_, keep_, size_) of every row, the text normalised.

    Equal texts are neighbours in one sorted part and are told apart from the text before them by
    comparing both in full. ``group_`` is the row number of one row of a group, ``keep_`` the
    identifier to keep, ``size_`` the rows. Groups of hot texts are one for each salt.
    """
    spark = docs.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    scratch = Scratch(spark, "exact")
    text = lower_ascii(F.col(text_col))
    head = F.concat(F.left("text_", F.lit(HEAD)), F.lit("\0"), F.hex("mark_"))

    # First pass over the texts: sort keys, for the hot texts and the splitters.
    keys = docs.select(text.alias("text_")).withColumn("mark_", F.xxhash64("text_"))
    keys = scratch.write(keys.select("mark_", head.alias("key"),
                                     F.monotonically_increasing_id().alias("row")), "keys")
    counts = keys.groupBy("mark_").agg(F.count("*").alias("n"))
    floor = max(2, int(keys.count() * HOT_SHARE))
    hot = [r.mark_ for r in counts.filter(F.col("n") >= floor).select("mark_").collect()]
    cuts = _splitters(keys, parts)
    scratch.drop(keys)

    # Second pass: a text goes to the range of its key; a hot one to as many places as it has salts.
    rows = docs.select(*[c.alias(f"carry_{n}") for n, c in carry.items()],
                       F.col(id_col).alias("id_"), text.alias("text_"),
                       F.monotonically_increasing_id().alias("row_")).withColumn(
        "mark_", F.xxhash64("text_"))
    is_hot = F.col("mark_").isin(hot) if hot else F.lit(False)
    salt = F.when(is_hot, F.pmod(F.xxhash64("id_"), F.lit(SALTS)) + 1).otherwise(0).cast("int")
    rows = rows.withColumn("salt_", salt)
    part = F.when(F.col("salt_") == 0, range_of(head, cuts)).otherwise(
        F.pmod(F.xxhash64("mark_", "salt_"), F.lit(parts)))
    rows = rows.withColumn("part_", part.cast("int")).drop("mark_")
    best = F.max if keep == "max" else F.min
    group = Window.partitionBy("part_", "salt_", "text_")  # sorted by text within a part
    return (rows.repartitionById(parts, F.col("part_"))
            .withColumns({"keep_": best("id_").over(group), "size_": F.count("*").over(group),
                          "group_": F.min("row_").over(group)}))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: str = "max", partitions: int | None = None) -> DataFrame:
    """One row per input row: (id, keep_id, group_size long, kept, text_sha256).

    Splitters drawn from a bounded sample of sort keys (``SAMPLE`` keys of the first ``HEAD``
    characters and a 64-bit fingerprint) cut the normalised texts into ranges; each range is sorted
    by the whole text, spilling to disk where needed. Equal texts are then neighbours: every text
    is compared in full with the one before it, which numbers the groups, and the rows of a group
    get its size and the identifier that stays without the text being needed again. Texts cross the
    network once.

    Texts that hold ``HOT_SHARE`` of all rows, found by a count per fingerprint, are dealt over
    ``SALTS`` places; their partial groups, ``SALTS`` for each of at most 1/``HOT_SHARE`` texts, are
    put together by full text and given back by group number.

    ``keep`` is 'max' or 'min': which identifier of a group stays. Null text is the empty text.
    A null identifier never wins over another one; a group of nulls only keeps them all. Rows that
    repeat an identifier within a group are kept or dropped alike. An empty table gives no rows.
    Other columns of the table are not looked at.
    """
    best = F.max if keep == "max" else F.min
    scratch = Scratch(docs.sparkSession, "exact")
    one = F.when((F.col("row_") == F.col("group_")) & (F.col("salt_") > 0), F.col("text_"))
    slim = scratch.write(_grouped(docs, id_col, text_col, keep, partitions, {}).select(
        "id_", "salt_", "group_", "keep_", "size_", F.sha2("text_", 256).alias("text_sha256"),
        one.alias("text_")), "groups")
    hot = F.broadcast(_put_together(slim.filter(F.col("text_").isNotNull()), best))
    keep_id = F.when(F.col("salt_") > 0, F.col("all_keep")).otherwise(F.col("keep_"))
    return (slim.join(hot, "group_", "left").select(
        F.col("id_").alias(id_col), keep_id.alias("keep_id"),
        F.coalesce("all_size", "size_").alias("group_size"),
        F.col("id_").eqNullSafe(keep_id).alias("kept"), "text_sha256"))


def _put_together(partial: DataFrame, best) -> DataFrame:
    """The whole of each hot text for its partial groups; at most SALTS / HOT_SHARE rows."""
    whole = Window.partitionBy("text_")
    return partial.select("group_", best("keep_").over(whole).alias("all_keep"),
                          F.sum("size_").over(whole).alias("all_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "max") -> DataFrame:
    """The rows that stay, with all their columns, which travel with the text through the sort. Of
    rows that repeat identifier and text, all stay: nothing tells them apart."""
    best = F.max if keep == "max" else F.min
    scratch = Scratch(docs.sparkSession, "exact")
    grouped = _grouped(docs, id_col, text_col, keep, None,
                       {str(i): F.col(f"`{c}`") for i, c in enumerate(docs.columns)})
    carried = [f"carry_{i}" for i in range(len(docs.columns))]
    hot_text = F.when(F.col("salt_") > 0, F.col("text_")).alias("text_")
    kept = scratch.write(grouped.filter(F.col("id_").eqNullSafe(F.col("keep_"))).select(
        *carried, "id_", "salt_", "group_", "keep_", "size_", hot_text), "kept")
    partial = kept.filter("salt_ > 0").groupBy("group_").agg(
        *[F.first(c).alias(c) for c in ("text_", "keep_", "size_")])
    hot = F.broadcast(_put_together(partial, best))
    stays = (F.col("salt_") == 0) | F.col("id_").eqNullSafe(F.col("all_keep"))
    return (kept.join(hot, "group_", "left").filter(stays)
            .select(*[F.col(c).alias(name) for c, name in zip(carried, docs.columns, strict=True)]))
