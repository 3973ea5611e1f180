"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Training counts words and word pairs over all training texts. A count c is quantised to a level on
a logarithmic scale, and the n-gram is put into a Bloom filter once for every level up to its own.
Asking for level 1, 2, ... until the first miss gives the level back: never too low, and too high
only with the filter's error rate. The filter is sent to the workers, which score whole texts with
probabilities that mix the pair's relative frequency with the word's.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalweave.llm import textbytes as tb
from fiscalweave.llm.store import Scratch

#: Hashes that stand for the end of a text and for what is before its first word.
END, BEGIN = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_PAIR = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))


@dataclass(frozen=True)
class Settings:
    """``base`` of the count scale; ``bits`` of filter per stored level, at any size; ``probes`` per
    level; ``pair_weight`` of the pair's relative frequency. A filter of up to ``max_bytes`` is
    broadcast as a whole; a larger one is sent in slices of about ``slice_bytes`` to the tasks that
    hold the slice's n-grams. The bits are the same, and so are the scores. ``hot_words`` bounds the exact counts of frequent words that are broadcast
    for the base score; other words are joined. ``shard_bytes`` of text fill one shard of the
    counting, so shards grow in number and not in size."""

    base: float = 1.5
    bits: float = 8.0
    probes: int = 5
    pair_weight: float = 0.4
    max_bytes: int = 1 << 27
    slice_bytes: int = 1 << 22
    hot_words: int = 1 << 18
    shard_bytes: int = 6 << 20
    flush: int = 3_000_000

    def values(self) -> np.ndarray:
        """The smallest count of each level from 0 on; level 0 is 'never seen'."""
        steps = np.ceil(self.base ** np.arange(0, 120)).astype(np.float64)
        return np.concatenate([[0.0], np.unique(steps)])


def token_stream(block: tb.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, the token before each, text number of each): the words of each text and an end."""
    n = block.n
    tokens = np.empty(len(block.starts) + n, dtype=np.uint64)
    ends = block.first[1:] + np.arange(n)
    words = np.ones(len(tokens), dtype=bool)
    words[ends] = False
    tokens[ends] = END
    tokens[words] = block.hashes()
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[block.first[:-1] + np.arange(n)] = BEGIN
    return tokens, before, np.repeat(np.arange(n), block.counts + 1)


def pair_keys(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return tb.mix(before * _PAIR[0] + tokens * _PAIR[1])


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
    return keys[at], np.add.reduceat(counts[order], at) if len(keys) else counts


def packed(counts: np.ndarray) -> bytes:
    """Counts in the narrowest of three widths that holds them all."""
    top = int(counts.max(initial=0))
    return counts.astype(np.uint8 if top < 1 << 8 else np.uint32 if top < 1 << 32 else np.int64
                         ).tobytes()


def unpacked(data, n: int) -> np.ndarray:
    kind = {1: np.uint8, 4: np.uint32, 8: np.int64}[len(data) // max(n, 1)]
    return np.frombuffer(data, kind).astype(np.int64)


def _bit_places(keys: np.ndarray, level: int, sizes: np.ndarray, probes: int) -> np.ndarray:
    """Bit numbers within filters of the given sizes, one row of places for each probe."""
    h = tb.mix(keys + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)))
    low, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    spots = [((low + np.uint64(i) * step) & np.uint64(0xFFFFFFFF)) * sizes >> np.uint64(32)
             for i in range(probes)]
    return np.stack(spots)


def build_filter(keys: np.ndarray, counts: np.ndarray, s: Settings, bits: float) -> np.ndarray:
    """The bytes of a filter of one shard; 64 bits at least."""
    levels = np.searchsorted(s.values(), counts, "right") - 1
    size = min(max(64, int(np.ceil(levels.sum() * bits / 64)) * 64), (1 << 32) - 64)
    found = np.zeros(size, dtype=bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        some = keys[levels >= level]
        found[_bit_places(some, level, np.full(1, size, np.uint64), s.probes).ravel()] = True
    return np.packbits(found, bitorder="little")


def shard_of(keys: np.ndarray, shard_bits: int) -> np.ndarray:
    return ((keys >> np.uint64(64 - shard_bits)).astype(np.int64) if shard_bits
            else np.zeros(len(keys), np.int64))


def levels_of(keys: np.ndarray, model: dict) -> np.ndarray:
    """The level of each key by asking for one level after the other until it is missed."""
    shard = shard_of(keys, model["shard_bits"]) - model["first"]
    sizes, starts, data = model["sizes"][shard], model["starts"][shard], model["data"]
    out, alive = np.zeros(len(keys), np.int64), np.arange(len(keys))
    for level in range(1, len(model["values"])):
        spots = _bit_places(keys[alive], level, sizes[alive], model["probes"])
        hit = np.ones(len(alive), dtype=bool)
        for row in spots:
            byte = data[starts[alive] + (row >> np.uint64(3)).astype(np.int64)]
            hit &= (byte >> (row & np.uint64(7)).astype(np.uint8)) & 1 == 1
        alive = alive[hit]
        if not len(alive):
            break
        out[alive] = level
    return out


def held_out(id_col: Column, folds: int = 7, fold: int = 2) -> Column:
    """Whether a row is kept from learning: crc32 of the identifier as text, by its remainder."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds))
                      == fold, F.lit(False))


def count_ngrams(texts: DataFrame, s: Settings, shard_bits: int) -> DataFrame:
    """(shard, pairs, keys, counts) rows of packed partial counts, from every text of column 0."""
    def count(batches):
        waiting = {False: [], True: []}

        def flushed():
            for pairs, parts in waiting.items():
                if not parts:
                    continue
                keys, n = summed(np.concatenate([p[0] for p in parts]),
                                 np.concatenate([p[1] for p in parts]))
                parts.clear()
                cut = np.arange(1, 1 << shard_bits, dtype=np.uint64) << np.uint64(64 - shard_bits) \
                    if shard_bits else np.zeros(0, np.uint64)
                edges = [0, *np.searchsorted(keys, cut), len(keys)]
                full = [i for i in range(1 << shard_bits) if edges[i + 1] > edges[i]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(full, pa.int32()), pa.array([pairs] * len(full), pa.bool_()),
                    pa.array([keys[edges[i]:edges[i + 1]].tobytes() for i in full], pa.binary()),
                    pa.array([packed(n[edges[i]:edges[i + 1]]) for i in full], pa.binary()),
                ], ["shard", "pairs", "keys", "counts"])

        held = 0
        for batch in batches:
            for block in tb.blocks(batch.column(0), lower=True):
                tokens, before, _ = token_stream(block)
                firsts = np.full(block.n, BEGIN)
                for pairs, keys in ((False, np.concatenate([tokens, firsts])),
                                    (True, pair_keys(before, tokens))):
                    waiting[pairs].append(summed(keys, np.ones(len(keys), np.int64)))
                    held += len(waiting[pairs][-1][0])
                if held > s.flush:
                    yield from flushed()
                    held = 0
        yield from flushed()

    return texts.mapInArrow(count, "shard int, pairs boolean, keys binary, counts binary")


def train(texts: DataFrame, settings: Settings = Settings()
          ) -> tuple[dict, DataFrame, DataFrame]:
    """(model, exact word counts, filters) of a frame with one string column.

    The model has the number N of tokens and V of distinct tokens; the counts are a written table
    (word, c), the filters one of (shard, pairs, data), of about as many bytes as levels are stored.
    """
    s, spark = settings, texts.sparkSession
    scratch = Scratch(spark, "bloom-lm")
    size = texts.select(F.sum(F.octet_length(texts.columns[0]))).first()[0] or 0
    shard_bits = max(0, int(np.ceil(np.log2(max(1, size) / s.shard_bytes))))
    shards = 1 << shard_bits

    def merge(table):
        shard, rows = table.column("shard")[0].as_py(), []
        for pairs in (False, True):
            at = np.flatnonzero(np.array(table.column("pairs")) == pairs)
            if not len(at):
                continue
            part = table.take(pa.array(at))
            keys = [np.frombuffer(v.as_buffer(), np.uint64) for v in part.column("keys")]
            counts = [unpacked(v.as_buffer(), len(k)) for k, v in zip(keys, part.column("counts"),
                                                                      strict=True)]
            keys, counts = summed(np.concatenate(keys), np.concatenate(counts))
            levels = int((np.searchsorted(s.values(), counts, "right") - 1).sum())
            rows.append((shard, pairs, levels, keys, counts))
        return pa.table({
            "shard": pa.array([r[0] for r in rows], pa.int32()),
            "pairs": pa.array([r[1] for r in rows], pa.bool_()),
            "levels": pa.array([r[2] for r in rows], pa.int64()),
            "keys": pa.array([r[3].tobytes() for r in rows], pa.binary()),
            "counts": pa.array([packed(r[4]) for r in rows], pa.binary())})

    counted = scratch.write(
        count_ngrams(texts, s, shard_bits).repartition(shards, "shard").groupBy("shard")
        .applyInArrow(merge, "shard int, pairs boolean, levels long, keys binary, counts binary"),
        "ngrams")
    def filters(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                keys = np.frombuffer(batch.column("keys")[i].as_buffer(), np.uint64)
                counts = unpacked(batch.column("counts")[i].as_buffer(), len(keys))
                data = build_filter(keys, counts, s, s.bits)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("shard")[i:i + 1], batch.column("pairs")[i:i + 1],
                     pa.array([data.tobytes()], pa.binary())], ["shard", "pairs", "data"])

    built = scratch.write(
        counted.mapInArrow(filters, "shard int, pairs boolean, data binary"), "filters")
    model = {"shard_bits": shard_bits, "probes": s.probes, "values": s.values(),
             "pair_weight": s.pair_weight}

    def unpack(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                keys = np.frombuffer(batch.column("keys")[i].as_buffer(), np.uint64)
                counts = unpacked(batch.column("counts")[i].as_buffer(), len(keys))
                real = keys != BEGIN
                for lo in range(0, len(keys), 1 << 16):
                    at = slice(lo, lo + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tb.signed(keys[at][real[at]])), pa.array(counts[at][real[at]])],
                        ["word", "c"])

    words = scratch.write(counted.filter("NOT pairs").mapInArrow(unpack, "word long, c long"),
                          "words")
    got = words.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    model["N"], model["V"] = int(got.n or 0), int(got.v)
    scratch.drop(counted)
    return model, words, built


def placed_filters(rows, shards: int, first: int = 0) -> dict:
    """{'data', 'sizes', 'starts'} of the filters of ``shards`` shards from ``first`` on, of rows
    (shard, data); a shard without a row has an empty filter."""
    sizes = np.full(shards, 8, np.int64)
    rows = [(shard - first, data) for shard, data in rows]
    for at, data in rows:
        sizes[at] = len(data)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(starts[-1]), np.uint8)
    for at, data in rows:
        out[starts[at]:starts[at + 1]] = np.frombuffer(data, np.uint8)
    return {"data": out, "sizes": (8 * sizes).astype(np.uint64), "starts": starts[:-1],
            "first": first}


def fetched(built: DataFrame, shards: int) -> dict[str, dict]:
    """The filters of words and pairs on the driver, a partition at a time."""
    return {"pairs" if pairs else "words": placed_filters(
        ((r.shard, r.data) for r in built.filter(F.col("pairs") == pairs)
         .toLocalIterator()), shards) for pairs in (False, True)}


def hot_counts(words: DataFrame, most: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(floor, words, counts): all words of at least ``floor`` occurrences, at most ``most``."""
    grade = F.floor(F.log2("c") * 8).cast("int")
    steps = words.groupBy(grade.alias("g")).agg(F.count("*").alias("n"),
                                                F.min("c").alias("c")).collect()
    floor, total = 1 << 62, 0
    for r in sorted(steps, key=lambda r: -r.g):  # a few hundred grades at most
        total += r.n
        if total > most:
            break
        floor = r.c
    got = words.filter(F.col("c") >= floor).toArrow()
    keys = tb.unsigned(np.array(got.column("word"), dtype=np.int64))
    order = np.argsort(keys)
    return floor, keys[order], np.array(got.column("c"), dtype=np.int64)[order]


def distinct_keys(block: tb.Block):
    """(words, their places, pairs, their places) of a block: the sorted distinct n-grams, where
    each token has its own, and the stand-in for what is before a text among the words."""
    tokens, before, text = token_stream(block)
    kinds, of = np.unique(np.append(tokens, BEGIN), return_inverse=True)
    pairs, of_pair = np.unique(pair_keys(before, tokens), return_inverse=True)
    return kinds, of, pairs, of_pair, text


def scored_block(block: tb.Block, keys, level: np.ndarray, pair_level: np.ndarray, known: dict):
    """(tokens, score, gain of frequent words, known frequent words, other words and their number
    per text, the other words, how often each occurs) of the texts of a block."""
    kinds, of, _, of_pair, text = keys
    low, m = known["values"], block.n
    high = np.append(low[1:], low[-1] * 2) - 1
    begin, of = of[-1], of[:-1]
    ahead = np.empty(len(of), np.int64)
    ahead[1:] = level[of][:-1]
    ahead[block.first[:-1] + np.arange(m)] = level[begin]
    chance = known["weight"] * low[pair_level][of_pair] / np.maximum(high[ahead], 1.0)
    chance = chance + (1 - known["weight"]) * ((low[level] + 1) / known["total"])[of]
    score = np.bincount(text, np.log10(np.minimum(chance, 1.0)), m)

    hot = known["hot"]
    place = np.searchsorted(hot, kinds)
    place[place == len(hot)] = 0
    is_hot = (hot[place] == kinds) if len(hot) else np.zeros(len(kinds), bool)
    per = np.where(is_hot, known["gain"][place] if len(hot) else 0.0, 0.0)
    # A filter never misses what it holds: level 0 is a count of 0 for certain.
    open_ = ((level > 0) & ~is_hot)[of]
    owner, which, times = tb.distinct(text[open_], of[open_])
    return (block.counts + 1, score, np.bincount(text, per[of], m),
            np.bincount(text, is_hot[of], m).astype(np.int64),
            np.bincount(owner, minlength=m), kinds[which], times)


_NAMES = ["id", "held", "row", "n_tokens", "n_known", "hot_base", "score", "rare", "rare_n"]


def _scored_schema(id_type: T.DataType) -> T.StructType:
    long, double = T.LongType(), T.DoubleType()
    kinds = [id_type, T.BooleanType(), long, long, long, double, double, T.ArrayType(long),
             T.ArrayType(long)]
    return T.StructType([T.StructField(n, k) for n, k in zip(_NAMES, kinds, strict=True)])


def _result(ids, held, row, blocks: list) -> pa.RecordBatch:
    tokens, score, base, hot, lengths, rare, rare_n = (
        np.concatenate([b[i] for b in blocks]) if blocks else np.zeros(0, np.int64) for i in range(7))
    ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int64)))
             for x in (tb.signed(rare.astype(np.uint64)), rare_n)]
    return pa.RecordBatch.from_arrays(
        [ids, held, row, pa.array(tokens.astype(np.int64)), pa.array(hot.astype(np.int64)),
         pa.array(base.astype(float)), pa.array(score.astype(float)), *lists], _NAMES)


def _scored_whole(rows: DataFrame, model: dict, known: dict, id_type: T.DataType) -> DataFrame:
    """Scores with the whole filter sent to every worker."""
    sent = rows.sparkSession.sparkContext.broadcast({"model": model, "known": known})

    def score(batches):
        model, known = sent.value["model"], sent.value["known"]
        common = {k: model[k] for k in ("shard_bits", "probes", "values")}
        ask = {k: common | model[k] for k in ("words", "pairs")}
        for batch in batches:
            done = []
            for block in tb.blocks(batch.column(2), lower=True):
                keys = distinct_keys(block)
                done.append(scored_block(block, keys, levels_of(keys[0], ask["words"]),
                                         levels_of(keys[2], ask["pairs"]), known))
            yield _result(batch.column(0), batch.column(1), batch.column(3), done)

    return rows.mapInArrow(score, _scored_schema(id_type))


def _scored_in_slices(rows: DataFrame, model: dict, built: DataFrame, size: int, known: dict,
                      id_type: T.DataType, s: Settings, scratch: Scratch) -> DataFrame:
    """Scores with a filter of any size, none of which passes the driver.

    Texts are put into blocks. The distinct n-grams of a block, which are sorted by their hash and
    so by shard, go to the tasks that hold the slice of the filter they belong to, and their levels
    come back to the block, a byte each. An n-gram moves once per block, however often it occurs.
    """
    shards = 1 << model["shard_bits"]
    per = 1  # shards of a slice, a power of two
    while per < shards and size * per / shards < s.slice_bytes:
        per *= 2
    names, shard_bits, probes, values = rows.columns, model["shard_bits"], model["probes"], model["values"]

    def pack(batches):
        for batch in batches:
            for block in tb.blocks(batch.column(2), lower=False):
                some = batch.slice(block.rows.start, block.rows.stop - block.rows.start)
                ends = pa.array([0, some.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [some.column(3).slice(0, 1), *[pa.ListArray.from_arrays(
                        ends, pa.concat_arrays([c])) for c in some.columns]], ["block", *names])

    lists = T.StructType([T.StructField("block", T.LongType()), *[
        T.StructField(f.name, T.ArrayType(f.dataType)) for f in rows.schema.fields]])
    packed = scratch.write(rows.mapInArrow(pack, lists), "blocks")

    def ask(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                keys = distinct_keys(next(tb.blocks(batch.column("text")[i].values, True, 1 << 62)))
                for pairs, found in ((False, keys[0]), (True, keys[2])):
                    part = shard_of(found, shard_bits) // per
                    cuts = np.flatnonzero(np.diff(part)) + 1
                    lo, hi = [0, *cuts], [*cuts, len(found)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(np.array(batch.column("block")[i].as_py()), len(lo))),
                         pa.array(part[lo].astype(np.int32)), pa.array([pairs] * len(lo)),
                         pa.array([found[a:b].tobytes() for a, b in zip(lo, hi, strict=True)],
                                  pa.binary())], ["block", "slice", "pairs", "keys"])

    asked = packed.select("block", "text").mapInArrow(
        ask, "block long, slice int, pairs boolean, keys binary")

    def probe(key, filters, asked):
        first = key[0].as_py() * per
        got = filters.to_pylist()
        parts = {pairs: {"shard_bits": shard_bits, "probes": probes, "values": values}
                 | placed_filters(((r["shard"], r["data"]) for r in got if r["pairs"] == pairs),
                                  per, first) for pairs in (False, True)}
        levels = [levels_of(np.frombuffer(k.as_buffer(), np.uint64), parts[p]).astype(np.uint8)
                  .tobytes() for p, k in zip(asked.column("pairs").to_pylist(),
                                             asked.column("keys"), strict=True)]
        return pa.table({"block": asked.column("block"), "slice": asked.column("slice"),
                         "pairs": asked.column("pairs"), "levels": pa.array(levels, pa.binary())})

    sliced = built.withColumn("slice", F.floor(F.col("shard") / per).cast("int"))
    levels = sliced.groupBy("slice").cogroup(asked.groupBy("slice")).applyInArrow(
        probe, "block long, slice int, pairs boolean, levels binary")

    def score(key, block, levels):
        row = block.slice(0, 1)
        texts = row.column("text").combine_chunks().flatten()
        whole = next(tb.blocks(texts, True, 1 << 62))
        levels = levels.sort_by("slice")
        flag = np.array(levels.column("pairs"))
        found = levels.column("levels").to_pylist()
        level, pair = (np.frombuffer(b"".join(x for x, p in zip(found, flag, strict=True)
                                              if p == pairs), np.uint8).astype(np.int64)
                       for pairs in (False, True))
        done = scored_block(whole, distinct_keys(whole), level, pair, known)
        ids, held, number = (row.column(c).combine_chunks().flatten() for c in ("id", "held", "row"))
        return pa.Table.from_batches([_result(ids, held, number, [done])])

    return packed.groupBy("block").cogroup(levels.groupBy("block")).applyInArrow(
        score, _scored_schema(id_type))


def lm_scores(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text",
              settings: Settings = Settings()) -> DataFrame:
    """One row per input row: (id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Learns from the rows where ``held`` is false. ``score`` is the log10 probability of the text:
    each token has pair_weight * low(pair) / high(before) + (1 - pair_weight) * (low(word) + 1) /
    (N + V + 1), with low and high the smallest and largest count of the level found; so apart from
    filter errors the probabilities after any word add up to 1 at most. ``base_score`` takes exact
    word counts. Null and empty texts have one token, the end. Without training rows N = V = 0 and
    every word has probability 1 after that formula. An empty table gives no rows; repeated rows
    are scored each; other columns are not looked at.

    Words are told apart by 64-bit hashes of their bytes.
    """
    s, spark = settings, docs.sparkSession
    scratch = Scratch(spark, "lm-scores")
    rows = docs.select(F.col(id_col).alias("id"), held.alias("held"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    model, words, built = train(rows.filter(~F.col("held")).select("text"), s)
    floor, hot, hot_n = hot_counts(words, s.hot_words)
    known = {"hot": hot, "gain": np.log10(hot_n + 1.0), "values": model["values"],
             "weight": model["pair_weight"], "total": model["N"] + model["V"] + 1.0}
    id_type = docs.schema[id_col].dataType
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    size = built.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    if size <= s.max_bytes:
        scored = _scored_whole(rows, model | fetched(built, 1 << model["shard_bits"]), known, id_type)
    else:
        scored = _scored_in_slices(rows, model, built, size, known, id_type, s, scratch)
    scored = scratch.write(scored, "scores")

    seen = scored.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x"))
    seen = seen.select("row", F.col("x.rare").alias("word"), F.col("x.rare_n").alias("n"))
    rest = (seen.join(words.filter(F.col("c") < floor), "word")
            .groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("gain"),
                                F.sum("n").alias("known")))
    total = float(np.log10(model["N"] + model["V"] + 1.0))
    gain = F.col("hot_base") + F.coalesce("gain", F.lit(0.0))
    return scored.join(rest, "row", "left").select(
        F.col("id").alias(id_col), F.col("held").alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model["N"]).cast("long").alias("train_tokens"),
        (gain - F.col("n_tokens") * F.lit(total)).alias("base_score"), "score")
