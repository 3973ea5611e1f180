"""Substring deduplication by seed and extend.

Anchors are winnowed word k-grams: in every run of ``length`` words the smallest k-gram hash (the
rightmost of equal ones) is the run's anchor, so runs with the same words have the same anchor at
the same place. Documents meet on anchors that occur more than once. From there matches are
extended both ways over all runs that an anchor stands for: first as a whole (most anchors lie
inside a long repeat, where the whole surroundings agree), and run by run where surroundings differ.
Overlapping repeated runs make up the maximal repeats.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalweave.llm import textbytes as tb
from fiscalweave.llm.store import Scratch

#: Words of a k-gram.
GRAM = 16
#: Bits of the map of repeated anchors that is broadcast (8 MB whatever the data). It only spares
#: rows: an anchor that it lets through wrongly is found to be alone by the exact count.
MAP_BITS = 1 << 26
#: Bytes of text whose anchors are counted together.
SHARD_BYTES = 32 << 20
#: Anchors a task gathers before it counts them and sends them on.
FLUSH = 4_000_000


def anchors(block: tb.Block, length: int, only_hashes: bool = False):
    """(anchor hash, text, place, first run, last run, surroundings hash) for every anchor; or the
    hashes alone, where nothing else is needed.

    Places are word positions in the block. The anchor stands for the runs that start at
    ``first run .. last run``; the surroundings are all words of these runs and the anchor's place
    among them.
    """
    gram = min(GRAM, length)
    window, n = length - gram + 1, len(block.starts)
    runs = block.counts - (length - 1)
    texts = np.flatnonzero(runs > 0)
    if not len(texts):
        return None
    words = block.hashes()
    at = np.arange(n - gram + 1)
    value = tb.run_hashes(words, at, at + gram)
    best, width = at, 1
    while width < window:
        step = min(width, window - width)
        left, right = best[:-step], best[step:]
        best = np.where(value[right] <= value[left], right, left)
        width += step
    runs = runs[texts]
    owner = np.repeat(texts, runs)
    start = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs)
    start += block.first[owner]
    place = best[start]
    new = np.ones(len(place), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(place)) - 1
    owner, place, lo, hi = owner[lo], place[lo], start[lo], start[hi]
    if only_hashes:
        return value[place]
    around = tb.run_hashes(block.hashes(1), lo, hi + length, 1)
    around = tb.mix(around + (place - lo).astype(np.uint64) * np.uint64(tb.BASES[0]))
    return value[place], owner, place, lo, hi, around


def _slot(anchor: np.ndarray) -> np.ndarray:
    return (anchor & np.uint64(MAP_BITS - 1)).astype(np.int64)


def repeated_anchors(texts: DataFrame, length: int, shards: int) -> DataFrame:
    """(shard, map slots) of the anchors with two occurrences or more."""
    def partial(batches):
        parts, held = [], 0

        def flushed():
            keys, n = np.unique(np.concatenate(parts), return_counts=True)
            parts.clear()
            shard = (keys >> np.uint64(32)) % np.uint64(shards)
            order = np.argsort(shard, kind="stable")
            keys, n, shard = keys[order], np.minimum(n[order], 2).astype(np.int8), shard[order]
            edges = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
            full = [i for i in range(shards) if edges[i + 1] > edges[i]]
            cut = [slice(edges[i], edges[i + 1]) for i in full]
            return pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([keys[c].tobytes() for c in cut]),
                 pa.array([n[c].tobytes() for c in cut])], ["shard", "keys", "n"])

        for batch in batches:
            for block in tb.blocks(batch.column(0), lower=False):
                found = anchors(block, length, only_hashes=True)
                if found is not None:
                    parts.append(found)
                    held += len(found)
                if held > FLUSH:
                    yield flushed()
                    held = 0
        if parts:
            yield flushed()

    def merge(table):
        keys, n = (np.concatenate([np.frombuffer(v.as_buffer(), kind) for v in table.column(c)])
                   for c, kind in (("keys", np.uint64), ("n", np.int8)))
        order = np.argsort(keys)
        keys, n = keys[order], n[order].astype(np.int64)
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        twice = keys[at][np.add.reduceat(n, at) > 1]
        slots = np.unique(_slot(twice)).astype(np.uint32)
        return pa.table({"slots": pa.array([slots.tobytes()], pa.binary())})

    return (texts.mapInArrow(partial, "shard int, keys binary, n binary")
            .repartition(shards, "shard").groupBy("shard").applyInArrow(merge, "slots binary"))


def anchor_map(slots: DataFrame) -> np.ndarray:
    """The map of repeated anchors as bytes of bits; a few partial maps of fixed size meet here."""
    def joined(batches):
        bits = np.zeros(MAP_BITS, dtype=bool)
        for batch in batches:
            for value in batch.column(0):
                bits[np.frombuffer(value.as_buffer(), np.uint32)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()])], ["bits"])

    total = np.zeros(MAP_BITS // 8, dtype=np.uint8)
    for row in slots.coalesce(4).mapInArrow(joined, "bits binary").collect():
        total |= np.frombuffer(row.bits, np.uint8)
    return total


def repeated_spans(docs: DataFrame, length: int = 35, text_col: str = "text",
                   keys: tuple[str, str] = ("key", "mark")) -> DataFrame:
    """(key, mark, spans array<struct<lo int, hi int>>): the first words ``lo .. hi`` of repeated
    runs, for the rows of ``docs`` that have any. Rows with the same two keys are copies and get
    the same spans."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    size = docs.select(F.sum(F.octet_length(text_col))).first()[0] or 0
    shards = max(8, math.ceil(size / SHARD_BYTES))  # a shard's anchors fit a task at any size
    rows = docs.select(*keys, text_col)
    found = scratch.write(repeated_anchors(docs.select(text_col), length, shards), "anchors")
    sent = spark.sparkContext.broadcast(anchor_map(found))

    def occurrences(batches):
        for batch in batches:
            for block in tb.blocks(batch.column(2), lower=False):
                got = anchors(block, length)
                if got is None:
                    continue
                anchor, owner, _, lo, hi, around = got
                slot = _slot(anchor)
                twice = (sent.value[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1
                anchor, owner, around = anchor[twice], owner[twice], around[twice]
                base = block.first[owner]
                lo, hi = ((x[twice] - base).astype(np.int32) for x in (lo, hi))
                row = pa.array(owner + block.rows.start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tb.signed(anchor)), pa.array(tb.signed(around)),
                     batch.column(0).take(row), batch.column(1).take(row),
                     pa.array(lo), pa.array(hi)], ["anchor", "around", *keys, "lo", "hi"])

    ints = "lo int, hi int"
    seeds = scratch.write(rows.mapInArrow(
        occurrences, f"anchor long, around long, {keys[0]} long, {keys[1]} long, {ints}"), "seeds")
    scratch.drop(found)
    scratch.release()

    where = F.struct(*keys, "lo", "hi")
    classes = scratch.write(seeds.groupBy("anchor", "around").agg(
        F.count("*").alias("n"), F.min(where).alias("at")), "classes")
    whole = (seeds.join(classes.filter("n > 1").select("anchor", "around"), ["anchor", "around"])
             .select(*keys, "lo", "hi"))
    # Anchors whose surroundings differ: one occurrence of each kind is extended run by run.
    mixed = (classes.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
             .filter("kinds > 1 AND least = 1").select("anchor"))
    open_ = (classes.join(mixed, "anchor")
             .select(F.col("at." + keys[0]).alias(keys[0]), F.col("at." + keys[1]).alias(keys[1]),
                     F.struct(F.col("at.lo").alias("lo"), F.col("at.hi").alias("hi"),
                              (F.col("n") == 1).alias("alone")).alias("x"))
             .groupBy(*keys).agg(F.collect_list("x").alias("open")))

    def runs(batches):
        for batch in batches:
            lists = batch.column(3)
            ends = np.array(lists.offsets)
            flat = lists.values
            lo_all, hi_all, alone_all = (np.array(flat.field(i)) for i in range(3))
            for block in tb.blocks(batch.column(2), lower=False):
                a, b = ends[block.rows.start], ends[block.rows.stop]
                per = np.diff(ends[block.rows.start:block.rows.stop + 1])
                owner = np.repeat(np.arange(block.n), per)
                lo, hi = lo_all[a:b].astype(np.int64), hi_all[a:b].astype(np.int64)
                many = hi - lo + 1
                start = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
                start += np.repeat(lo, many)
                text, alone = np.repeat(owner, many), np.repeat(alone_all[a:b], many)
                at = start + block.first[text]
                row = pa.array(text + block.rows.start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tb.signed(tb.run_hashes(block.hashes(f), at, at + length, f)))
                     for f in (0, 1)]
                    + [batch.column(0).take(row), batch.column(1).take(row),
                       pa.array(start.astype(np.int32)), pa.array(alone)],
                    ["run", "run2", *keys, "lo", "alone"])

    one = rows.join(open_, list(keys)).select(*keys, text_col, "open")
    tried = scratch.write(one.mapInArrow(
        runs, f"run long, run2 long, {keys[0]} long, {keys[1]} long, lo int, alone boolean"),
        "runs")
    scratch.release()
    twice = tried.groupBy("run", "run2").agg(F.count("*").alias("n")).filter("n > 1")
    single = (tried.filter("alone").join(twice.select("run", "run2"), ["run", "run2"])
              .select(*keys, "lo", F.col("lo").alias("hi")))
    spans = scratch.write(whole.unionByName(single).groupBy(*keys).agg(
        F.collect_set(F.struct("lo", "hi")).alias("spans")), "spans")
    scratch.drop(seeds, classes, tried)
    return spans


def remove_repeats(docs: DataFrame, result: Callable, made: T.StructType, length: int = 35,
                   text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of every row and what ``result(words, keep mask)`` gives for ``made``.

    A word goes when a run of ``length`` words that covers it starts at another place too, in the
    same or another text. Runs are judged on the input. Words are bytes between blanks (0x20,
    0x09-0x0D), compared unchanged. Null and empty texts have no words. Rows that repeat identifier
    and text are copies of each other and lose what they share, as any copies do. An empty table
    gives no rows; other columns are not looked at.

    Runs are told apart by 128 bits, anchor and surroundings or two hashes of the run, which start
    from two independent hashes of each word. Matches are kept as the runs that an anchor stands
    for and not joined into longer ones: the words that overlapping runs cover are those of the
    maximal repeats.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ids = [F.col(c) for c in keep]
    rows = docs.select(*[c.alias(f"c{i}") for i, c in enumerate(ids)], text.alias("text"),
                       F.xxhash64(text, *ids).alias("key"), F.xxhash64(*ids, text).alias("mark"))
    spans = repeated_spans(rows, length)
    k = len(keep)

    def cut(batches):
        for batch in batches:
            out = []
            lists = batch.column(k + 1)
            for text, spans in zip(batch.column(k), lists, strict=True):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                kept = np.ones(len(words), dtype=bool)
                for span in spans.as_py() or ():
                    kept[span["lo"]:span["hi"] + length] = False
                out.append(result(words, kept))
            cols = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], *cols], names)

    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [to_arrow_type(f.dataType) for f in made.fields]
    names = [*keep, *[f.name for f in made.fields]]
    joined = rows.join(spans, ["key", "mark"], "left")
    return joined.select(*[f"c{i}" for i in range(k)], "text", "spans").mapInArrow(
        cut, T.StructType([*[docs.schema[c] for c in keep], *made.fields]))


def repeat_digests(docs: DataFrame, length: int = 35, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per input row: (id, n_words, n_removed, kept_sha256)."""
    def result(words, kept):
        gone = int(len(kept) - kept.sum())
        left = b" ".join(words) if not gone else b" ".join(
            [w for w, k in zip(words, kept, strict=True) if k])
        return len(words), gone, hashlib.sha256(left).hexdigest()

    made = T.StructType([T.StructField("n_words", T.LongType()),
                         T.StructField("n_removed", T.LongType()),
                         T.StructField("kept_sha256", T.StringType())])
    return remove_repeats(docs, result, made, length, text_col, (id_col,))


def repeat_free_texts(docs: DataFrame, length: int = 35, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(id, text, n_removed): each text without its repeats, words parted by one blank."""
    def result(words, kept):
        left = [w for w, k in zip(words, kept, strict=True) if k]
        return b" ".join(left).decode("utf-8"), int(len(words) - len(left))

    made = T.StructType([T.StructField("text", T.StringType()),
                         T.StructField("n_removed", T.LongType())])
    return remove_repeats(docs, result, made, length, text_col, (id_col,))
