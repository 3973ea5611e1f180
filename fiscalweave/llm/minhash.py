"""Near-duplicate documents by min-max hashing.

Each permutation of the shingles gives two signature values, the smallest and the largest hash, so
a signature of 80 values costs 40 hash evaluations per shingle. Bands of values put similar
documents into the same bucket; candidates are then compared on their full shingle sets, and the
confirmed links make up groups.

Groups of thousands need no pairs among all members. Documents with the same set are one from the
start. In a bucket every document is compared with a leader first; a second look at a bucket
concerns only documents that are not yet in one group with the rest of it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalweave.llm import textbytes as tb
from fiscalweave.llm.components import components
from fiscalweave.llm.store import Scratch, free_name


#: Partners of a leader that are compared in one go, on average.
GROUP = 256


@dataclass(frozen=True)
class Settings:
    """Links are pairs with 100 * intersection >= percent * union of their sets of ``words``-word
    shingles. ``bands`` buckets of four values each: a pair at 85 % shares none of 20 with
    probability 4e-7, a pair at 80 % with 3e-5 (at 28 bands: 5e-7). Candidates whose signatures
    agree in less than ``agree`` of the values are not compared: at the threshold that is five
    standard deviations below the mean. ``tile`` documents of a bucket are compared at a time."""

    words: int = 3
    percent: int = 85
    bands: int = 20
    agree: float = 0.65
    tile: int = 512
    seed: int = 7

    @property
    def permutations(self) -> int:
        return 2 * self.bands


def shingle_sets(block: tb.Block, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle hash) pairs, distinct and ordered; a text with fewer words is one shingle."""
    hashes = block.hashes()
    many = np.where(block.counts >= words, block.counts - words + 1, np.minimum(block.counts, 1))
    text = np.repeat(np.arange(block.n), many)
    start = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    start += block.first[text]
    end = np.minimum(start + words, block.first[text + 1])
    text, values, _ = tb.distinct(text, tb.run_hashes(hashes, start, end))
    return text, values


def signatures(values: np.ndarray, starts: np.ndarray, s: Settings) -> np.ndarray:
    """A row of 2 * permutations values for each set; sets are runs that begin at ``starts``."""
    rng = np.random.default_rng(s.seed)
    factors = rng.integers(1, 1 << 63, s.permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, s.permutations, dtype=np.uint64)
    out = np.empty((len(starts), 2 * s.permutations), dtype=np.uint64)
    for i, (a, b) in enumerate(zip(factors, shifts, strict=True)):
        permuted = values * a + b
        out[:, 2 * i] = np.minimum.reduceat(permuted, starts)
        out[:, 2 * i + 1] = np.maximum.reduceat(permuted, starts)
    return out


def sketches(docs: DataFrame, id_col: str, text_col: str, s: Settings) -> DataFrame:
    """(id, n, s1, s2, bands array<long>, sig binary, mark) per row; n = 0 has no bands.

    s1 and s2 identify the set; sig has one byte of each signature value; mark tells the texts of
    one identifier apart.
    """
    def sketch(batches):
        for batch in batches:
            for block in tb.blocks(batch.column(1), lower=True):
                text, values = shingle_sets(block, s.words)
                n = np.bincount(text, minlength=block.n)
                full = np.flatnonzero(n)
                s1, s2 = np.zeros(block.n, np.uint64), np.zeros(block.n, np.uint64)
                sig = [None] * block.n
                per = np.zeros(block.n, np.int32)
                keys = np.zeros(0, np.uint64)
                if len(full):
                    starts = np.searchsorted(text, full)
                    s1[full] = np.add.reduceat(tb.mix(values), starts)
                    s2[full] = np.add.reduceat(tb.mix(values ^ np.uint64(tb.BASES[1])), starts)
                    table = signatures(values, starts, s)
                    mixed = tb.mix(table)
                    small = (mixed >> np.uint64(56)).astype(np.uint8)
                    for i, at in enumerate(full):
                        sig[at] = small[i].tobytes()
                    quads = mixed.reshape(len(full), s.bands, 4)
                    factor = np.array([1, 3, 5, 7], np.uint64) * np.uint64(tb.BASES[0])
                    keys = tb.mix((tb.mix(quads * factor)).sum(axis=2, dtype=np.uint64)
                                  + np.arange(s.bands, dtype=np.uint64)).ravel()
                    per[full] = s.bands
                ends = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(tb.signed(keys)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[block.rows], pa.array(n.astype(np.int64)),
                     pa.array(tb.signed(s1)), pa.array(tb.signed(s2)), bands,
                     pa.array(sig, pa.binary()), batch.column(2)[block.rows]],
                    ["id", "n", "s1", "s2", "bands", "sig", "mark"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long"), text, F.xxhash64(text)).mapInArrow(
        sketch, "id long, n long, s1 long, s2 long, bands array<long>, sig binary, mark long")


def agreement(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """In how many signature bytes ``one`` agrees with each row of ``many``."""
    return (many == one).sum(axis=1)


def _signature_table(column: pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(v.as_buffer(), np.uint8) for v in column])


def confirmed(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """Those of the pairs (a, b) that are links, by the full sets of both texts.

    A text goes to each leader ``a`` that it is paired with; a leader with many partners is
    repeated for every ``GROUP`` of them, so no group grows with the data.
    """
    uses = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"))
    dealt = (pairs.join(uses, "a")
             .withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
             .select("a", "part", F.col("b").alias("id")))
    right = texts.join(dealt, "id").select("a", "part", F.col("id").alias("b"), "text")
    leaders = uses.select(F.col("a").alias("id"),
                          F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    left = texts.join(leaders, "id").select(F.col("id").alias("a"), "part",
                                            F.col("text").alias("text_a"))

    def compare(key, first, second):
        hit = [np.zeros(0, np.int64)]
        ids = np.array(second.column("b"), dtype=np.int64)
        for row in range(first.num_rows if second.num_rows else 0):
            base = next(tb.blocks(first.column("text_a").slice(row, 1), True))
            mine = shingle_sets(base, s.words)[1]
            if not len(mine):
                continue
            for block in tb.blocks(second.column("text"), True):
                text, values = shingle_sets(block, s.words)
                at = np.searchsorted(mine, values)
                at[at == len(mine)] = 0
                common = np.bincount(text[mine[at] == values], minlength=block.n)
                size = np.bincount(text, minlength=block.n)
                linked = 100 * common >= s.percent * (size + len(mine) - common)
                hit.append(ids[block.rows][linked])
        b = np.concatenate(hit)
        return pa.table({"a": pa.array(np.full(len(b), key[0].as_py(), np.int64)),
                         "b": pa.array(b)})

    return (left.groupBy("a", "part").cogroup(right.groupBy("a", "part"))
            .applyInArrow(compare, "a long, b long"))


def first_pairs(members: DataFrame) -> DataFrame:
    """Each document with the best leader of its buckets."""
    led = (members.filter("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b"))
           .groupBy("a", "b").agg(F.count("*").alias("shared")))
    # The leader with most buckets in common; of equals the smallest.
    best = led.groupBy("b").agg(F.max(F.struct("shared", -F.col("a"))).alias("x"))
    return best.select((-F.col("x.col2")).alias("a"), "b")


def _sets(column, words: int) -> list[np.ndarray]:
    """The sorted shingle set of each text."""
    out = []
    for block in tb.blocks(column, True):
        text, values = shingle_sets(block, words)
        cuts = np.searchsorted(text, np.arange(block.n + 1))
        out += [values[cuts[i]:cuts[i + 1]] for i in range(block.n)]
    return out


def _linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    at = np.searchsorted(one, two)
    at[at == len(one)] = 0
    common = int((one[at] == two).sum())
    return 100 * common >= percent * (len(one) + len(two) - common)


def later_links(members: DataFrame, sigs: DataFrame, texts: DataFrame, roots: DataFrame,
                s: Settings, across: bool) -> DataFrame:
    """Links across groups within buckets: a task returns fewer links than it holds groups.

    Members of a bucket are dealt into tiles. Those outside the bucket's largest group meet the
    members of their own tile; with ``across`` they are dealt into parts of the same size instead,
    and every part meets every tile of the buckets with more than one. A document is compared with
    the members of other groups whose signatures agree enough, on the full sets and the most similar
    first. A link makes two groups of the task one, so only links that join groups leave it.
    """
    named = (members.join(roots, "id", "left")
             .select("bucket", "id", "mark", F.coalesce("root", F.col("id")).alias("root")))
    sizes = named.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    split = (sizes.groupBy("bucket")
             .agg(F.sum("n").alias("all"), F.count("*").alias("groups"),
                  F.max(F.struct("n", "root")).alias("top"))
             .filter("groups > 1")
             .select("bucket", F.col("top.root").alias("main"),
                     F.ceil(F.col("all") / s.tile).cast("int").alias("tiles"),
                     F.ceil((F.col("all") - F.col("top.n")) / s.tile).cast("int").alias("parts")))
    if across:
        split = split.filter("tiles > 1")
    held = named.join(split, "bucket").join(sigs, ["id", "mark"]).join(texts, ["id", "mark"])
    cols = ["bucket", "tile", "part", "id", "root", "sig", "text"]
    tile = F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    here = held.withColumn("tile", tile).withColumn("part", every("parts") if across else F.lit(0))
    asks = (held.filter("root <> main").withColumn("part", part if across else F.lit(0))
            .withColumn("tile", every("tiles") if across else tile))
    here, asks = (x.select(*[F.col(c).alias(c) for c in cols]) for x in (here, asks))
    need = s.agree * 2 * s.permutations

    def look(key, mine, others):
        a, b = [], []
        if mine.num_rows and others.num_rows:
            sig = _signature_table(others.column("sig").combine_chunks())
            ids, groups = (others.column(c).to_numpy().copy() for c in ("id", "root"))
            sets = _sets(others.column("text"), s.words)
            own = _sets(mine.column("text"), s.words)
            now: dict[int, int] = {}  # the group that a joined group is part of
            for row, (one, id_, root) in enumerate(zip(
                    mine.column("sig"), mine.column("id").to_pylist(),
                    mine.column("root").to_pylist(), strict=True)):
                score = agreement(np.frombuffer(one.as_buffer(), np.uint8), sig)
                root = now.get(root, root)
                fit = np.flatnonzero((score >= need) & (groups != root))
                for i in fit[np.argsort(-score[fit], kind="stable")]:
                    if groups[i] != root and len(sets[i]) and _linked(own[row], sets[i], s.percent):
                        gone = int(groups[i])
                        groups[groups == gone] = root
                        now.update({k: root for k, v in now.items() if v == gone})
                        now[gone] = root
                        a.append(min(int(ids[i]), id_))
                        b.append(max(int(ids[i]), id_))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    keys = ["bucket", "tile", "part"]
    return (asks.groupBy(*keys).cogroup(here.groupBy(*keys))
            .applyInArrow(look, "a long, b long").distinct())


def near_groups(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per input row: (id, n_shingles, component_id, kept).

    A document's component is the smallest identifier that links reach from it; it is kept when
    that is its own. Null and blank texts have no shingles and are linked with nothing. Rows
    without identifier are a component of their own, without an id, and kept. Rows that repeat an
    identifier are taken as one document: its links are those of any of its texts. An empty table
    gives no rows; other columns are not looked at.

    Shingles are told apart by 64-bit hashes, sets of them by 128 bits.
    """
    s, spark = settings, docs.sparkSession
    scratch = Scratch(spark, "minhash")
    drawn = scratch.write(sketches(docs, id_col, text_col, s), "sketches")
    full = drawn.filter("n > 0 AND id IS NOT NULL")
    # Documents with the same set, and the same document with several sets, are linked already.
    sets = full.groupBy("s1", "s2").agg(F.min("id").alias("first"), F.count("*").alias("copies"),
                                        F.first(F.struct("bands", "sig", "mark", "id")).alias("x"))
    sets = scratch.write(sets, "sets")
    same = (full.select("id", "s1", "s2").join(
        sets.filter("copies > 1").select("s1", "s2", "first"), ["s1", "s2"])
        .filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")))
    # A set is looked at through one of its texts, whose document is linked with all others of it.
    sigs = sets.select("x.id", "x.mark", "x.sig").distinct()
    dealt = sets.select("x.id", "x.mark", F.explode("x.bands").alias("bucket"))
    shared = (dealt.groupBy("bucket").agg(F.min("id").alias("leader"), F.max("id").alias("other"))
              .filter("leader <> other").select("bucket", "leader"))
    members = scratch.write(dealt.join(shared, "bucket"), "members")
    texts = scratch.write(
        docs.select(F.col(id_col).cast("long").alias("id"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
        .withColumn("mark", F.xxhash64("text"))
        .join(members.select("id", "mark").distinct(), ["id", "mark"], "left_semi"), "texts")
    if texts.groupBy("id", "mark").count().filter("count > 1").head(1):
        # Rows that repeat identifier and text are one.
        texts = scratch.write(texts.groupBy("id", "mark").agg(F.first("text").alias("text")), "texts")

    found = scratch.write(same.unionByName(
        confirmed(scratch.write(first_pairs(members), "pairs"), texts, s)), "links")
    roots = scratch.write(components(found, scratch), "roots")
    for across in (False, True):
        more = scratch.write(later_links(members, sigs, texts, roots, s, across), "links")
        if not more.isEmpty():
            found = scratch.write(found.unionByName(more), "links")
            roots = scratch.write(components(found, scratch), "roots")
    scratch.drop(texts, members)
    root = F.coalesce("root", F.col("id"))
    return drawn.select("id", "n").join(roots, "id", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), root.alias("component_id"),
        root.eqNullSafe(F.col("id")).alias("kept"))


def near_dedup(docs: DataFrame, settings: Settings = Settings(words=5, percent=80, bands=28,
                                                              agree=0.58),
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, one of each group, with their own columns. Rows that repeat an
    identifier stay or go together."""
    gone = near_groups(docs, settings, id_col, text_col).filter("NOT kept")
    gone = gone.select(F.col(id_col).cast("long").alias("gone_id")).distinct()
    name = free_name(docs, "gone_id")
    gone = gone.withColumnRenamed("gone_id", name)
    return docs.join(gone, docs[id_col].cast("long") == gone[name], "left_anti")
