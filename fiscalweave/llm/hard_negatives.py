"""Hard negatives by exact inner products from subset-sum tables and packed bit planes."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscalweave.llm.store import Scratch

#: Candidates of a shard, anchors of a block, blocks that visit a shard together, candidates that
#: are scored at a time.
SHARD, BLOCK, CROWD, CHUNK = 8192, 512, 8, 1024
#: Labels with more than this share of the rows get shards of their own, and all other labels are
#: dealt over as many homes; so there are at most twice as many homes as this, at any size.
HOMES = 1024


# -- scoring -------------------------------------------------------------------------------------


def bit_planes(matrix: np.ndarray) -> np.ndarray:
    """(bits, groups of eight dimensions, rows): byte [b, g, i] holds bit b of eight components.

    Components are two's complement of as many bits as the widest needs, the last being the sign.
    """
    n, width = matrix.shape
    groups = -(-width // 8)
    wide = np.zeros((n, groups * 8), np.int64)
    wide[:, :width] = matrix
    low, high = (int(wide.min()), int(wide.max())) if wide.size else (0, 0)
    bits = max((-low - 1).bit_length() if low < 0 else 0, high.bit_length()) + 1
    out = np.zeros((bits, groups, n), np.uint8)
    for b in range(bits):
        bit = ((wide >> b) & 1).astype(np.uint8)
        out[b] = np.packbits(bit, axis=1, bitorder="little").T
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): the sum of the components that a byte selects, per group of eight.

    The narrowest integers are taken that hold every sum over whole vectors.
    """
    n, width = anchors.shape
    groups = -(-width // 8)
    wide = np.zeros((n, groups * 8), np.int64)
    wide[:, :width] = anchors
    most = int(np.abs(wide).sum(axis=1).max()) if wide.size else 0
    kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
    tables = np.zeros((groups, 256, n), kind)
    for g in range(groups):
        for bit in range(8):  # a byte with this highest bit: the sum without it, plus one component
            step = 1 << bit
            tables[g, step:2 * step] = tables[g, :step] + wide[:, g * 8 + bit].astype(kind)
    return tables


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products, (anchors, rows): planes select sums, and shifts weigh the planes.

    Starts at the sign plane, whose weight is negative, and doubles before each lower plane.
    """
    bits, groups, n = planes.shape
    wide = int(np.abs(tables.astype(np.int64)).max(initial=0)) * max(groups, 1) << bits
    kind = np.int32 if wide < 1 << 31 else np.int64
    out = np.zeros((tables.shape[2], n), kind)
    for lo in range(0, n, CHUNK):
        total = np.zeros((min(n, lo + CHUNK) - lo, tables.shape[2]), kind)
        for b in reversed(range(bits)):
            plane = np.zeros(total.shape, tables.dtype)
            for g in range(groups):
                plane += tables[g][planes[b, g, lo:lo + CHUNK]]
            if b == bits - 1:
                total -= plane
            else:
                total <<= 1
                total += plane
        out[:, lo:lo + CHUNK] = total.T
    return out


def best(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, fit: np.ndarray, k: int):
    """Positions of the k highest scores among ``fit``, ties to smaller ids, then rows."""
    at = np.flatnonzero(fit)
    if len(at) > k:
        kth = np.partition(score[at], len(at) - k)[len(at) - k]
        at = at[score[at] >= kth]
    return at[np.lexsort((rows[at], ids[at], -score[at].astype(np.int64)))[:k]]


# -- packed rows ---------------------------------------------------------------------------------


def _blob(array: np.ndarray) -> pa.Array:
    return pa.array([np.ascontiguousarray(array).tobytes()], pa.binary())


def _read(table: pa.Table, column: str, row: int, kind=np.int64) -> np.ndarray:
    return np.frombuffer(table.column(column)[row].as_buffer(), kind)


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    flat = table.column("v").combine_chunks().flatten()
    return np.array(flat, dtype=np.int64).reshape(table.num_rows, width)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return np.array(table.column(name), dtype=np.int64)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column | None = None,
                   positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x) with x as double; a score is the integer inner product with
    the anchor; higher scores come first, ties by smaller identifier. Anchors are the rows for
    which ``is_anchor`` holds. An anchor's positives are its first ``positives`` other rows of the
    same label. For each of them come the first ``negatives`` rows of another label whose score is
    from ``low`` to ``high`` percent of the positive's, numbered from 1; there may be none.

    Four-Russians scoring: an anchor's components are cut into groups of eight, and a table holds
    the sums of all 256 subsets of a group. A candidate keeps, per bit of its components, the byte
    of that bit in each group. Looking those bytes up in the tables, adding over groups and
    shifting over bits gives the exact score; it is exact as long as scores fit 64 bits.

    Rows are dealt into homes by label: labels with more than 1/``HOMES`` of the rows have one of
    their own, the others share. A home has shards of about ``SHARD`` candidates, so a label with a
    third of all rows is many shards. Blocks of about ``BLOCK`` anchors visit first the shards of
    their own home, for the positives, then all shards that can hold other labels, for the
    negatives; together about one pass over all pairs of an anchor and a row. A visit returns no
    more than ``positives`` (or ``positives`` x ``negatives``) rows per anchor.

    Rows with a null identifier, label or vector, or with a null or non-finite component take no
    part. Vectors of different length do not meet. Rows are told apart by row, not by identifier:
    another row with the anchor's identifier can be its positive, and every row of a repeated
    anchor identifier has results of its own. Labels are compared as 64-bit integers, or by a
    64-bit hash when they are of another type. An empty table, or no anchor, gives no rows. Other
    columns are not looked at.
    """
    scratch = Scratch(vectors.sparkSession, "negatives")
    x = F.col(vector_col)
    wrong = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    mark = (F.col(label_col) if label is None else label).alias("label")
    kind = vectors.select(mark).schema["label"].dataType.typeName()
    whole_number = kind in ("byte", "short", "integer", "long")
    rows = (vectors.filter(F.col(id_col).isNotNull() & x.isNotNull() & ~F.exists(x, wrong))
            .select(F.col(id_col).cast("long").alias("id"), mark,
                    F.coalesce(is_anchor, F.lit(False)).alias("asks"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
                    .alias("v"))
            .filter(F.col("label").isNotNull()))
    code = F.col("label").cast("long") if whole_number else F.xxhash64("label")
    whole = scratch.write(rows.select("id", code.alias("label"), "asks", "v",
                                      F.size("v").alias("dim"),
                                      F.monotonically_increasing_id().alias("row")), "vectors")

    # Homes: at most HOMES labels of their own and HOMES shared ones, whatever the table holds.
    kinds = whole.groupBy("dim", "label").agg(F.count("*").alias("n"))
    total = kinds.agg(F.sum("n")).first()[0] or 0
    own = kinds.filter(F.col("n") > max(SHARD, total // HOMES)).drop("n").collect()
    numbers = {(r.dim, r.label): i for i, r in enumerate(own)}
    shared = max(1, min(HOMES, math.ceil(total / SHARD)))
    home = F.lit(-1) - F.pmod(F.xxhash64("dim", "label"), F.lit(shared)).cast("int")
    if numbers:
        known = F.create_map(*[F.lit(y) for (d, c), i in numbers.items() for y in (f"{d}/{c}", i)])
        home = F.coalesce(F.try_element_at(known, F.concat_ws("/", "dim", "label")), home)
    placed = whole.withColumn("home", home)
    sizes = {(r.home, r.dim): r for r in placed.groupBy("home", "dim").agg(
        F.count("*").alias("n"), F.count_if("asks").alias("q")).collect()}

    def dealt(rows: DataFrame, size: int, of: str, name: str) -> DataFrame:
        """Rows with the number of their part: as many parts per home as its count asks for."""
        parts = {f"{h}/{d}": math.ceil(getattr(r, of) / size) for (h, d), r in sizes.items()}
        split = [F.lit(y) for k, p in parts.items() if p > 1 for y in (k, p)]
        many = F.lit(1)
        if split:
            many = F.coalesce(F.try_element_at(F.create_map(*split),
                                               F.concat_ws("/", "home", "dim")), many)
        return rows.withColumn(name, F.pmod(F.xxhash64("row", F.lit(name)), many).cast("int"))

    def pack_shard(key, table):
        home, part, width = (k.as_py() for k in key)
        planes = bit_planes(_matrix(table, width))
        return pa.table({
            "home": pa.array([home], pa.int32()), "part": pa.array([part], pa.int32()),
            "dim": pa.array([width], pa.int32()), "bits": pa.array([len(planes)], pa.int32()),
            "ids": _blob(_column(table, "id")), "rows": _blob(_column(table, "row")),
            "labels": _blob(_column(table, "label")), "planes": _blob(planes)})

    def pack_block(key, table):
        home, part, width = (k.as_py() for k in key)
        return pa.table({
            "home": pa.array([home], pa.int32()), "part": pa.array([part], pa.int32()),
            "dim": pa.array([width], pa.int32()),
            "ids": _blob(_column(table, "id")), "rows": _blob(_column(table, "row")),
            "labels": _blob(_column(table, "label")), "v": _blob(_matrix(table, width))})

    part_of = "home int, part int, dim int"
    shards = scratch.write(
        dealt(placed, SHARD, "n", "part").groupBy("home", "part", "dim").applyInArrow(
            pack_shard, f"{part_of}, bits int, ids binary, rows binary, labels binary, "
                        "planes binary"), "shards")
    blocks = scratch.write(
        dealt(placed.filter("asks"), BLOCK, "q", "part").groupBy("home", "part", "dim")
        .applyInArrow(pack_block, f"{part_of}, ids binary, rows binary, labels binary, v binary"),
        "blocks")

    def visits(asked: DataFrame, same_home: bool, work, schema: str) -> DataFrame:
        """Every shard with the blocks that look at it, a crowd of blocks at a time.

        Which block meets which shard is decided on their keys alone; then a shard is copied once
        per crowd and a block once per shard.
        """
        block = asked.select(F.col("home").alias("b_home"), F.col("part").alias("b_part"), "dim",
                             (F.col("part") / CROWD).cast("int").alias("crowd"))
        if same_home:
            meet = (F.col("b_home") == F.col("home"))
        else:  # a home of one label holds no other label for its own anchors
            meet = (F.col("b_home") != F.col("home")) | (F.col("home") < 0)
        salt = 32  # all shards of a dimension meet its blocks: deal the keys over several tasks
        keys = (shards.select("home", "part", "dim",
                              F.pmod(F.xxhash64("home", "part"), F.lit(salt)).alias("salt"))
                .join(block.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))),
                      ["dim", "salt"]).filter(meet).drop("salt"))
        tile = ["home", "part", "dim", "crowd_home", "crowd"]
        meets = keys.withColumn("crowd_home", F.col("b_home"))
        left = shards.join(meets.select(*tile).distinct(), ["home", "part", "dim"])
        found = asked.select(F.col("home").alias("b_home"), F.col("part").alias("b_part"), "dim",
                             *[c for c in asked.columns if c not in ("home", "part", "dim")])
        right = meets.join(found, ["b_home", "b_part", "dim"])
        right = right.toDF(*right.columns)  # columns of its own, as both sides come from ``meets``
        return left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInArrow(work, schema)

    def scored(shard, asked):
        """(ids, rows, labels, block row, its anchors' ids, rows, labels, their scores)."""
        width, bits = shard.column("dim")[0].as_py(), shard.column("bits")[0].as_py()
        ids, rows, labels = (_read(shard, c, 0) for c in ("ids", "rows", "labels"))
        planes = _read(shard, "planes", 0, np.uint8).reshape(bits, -(-width // 8), len(ids))
        for i in range(asked.num_rows):
            own = [_read(asked, c, i) for c in ("ids", "rows", "labels")]
            tables = subset_sums(_read(asked, "v", i).reshape(len(own[0]), width))
            yield ids, rows, labels, i, *own, scores(tables, planes)

    def find_positives(key, shard, asked):
        out = {c: [np.zeros(0, np.int64)] for c in ("anchor", "id", "row", "score")}
        if shard.num_rows and asked.num_rows:
            for ids, rows, labels, _, _, a_rows, a_labels, score in scored(shard, asked):
                for j, (own, mark) in enumerate(zip(a_rows, a_labels, strict=True)):
                    at = best(score[j], ids, rows, (labels == mark) & (rows != own), positives)
                    out["anchor"].append(np.full(len(at), own))
                    out["id"].append(ids[at])
                    out["row"].append(rows[at])
                    out["score"].append(score[j][at].astype(np.int64))
        return pa.table({c: pa.array(np.concatenate(v), pa.int64()) for c, v in out.items()})

    near = visits(blocks, True, find_positives, "anchor long, id long, row long, score long")
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "row")
    near = scratch.write(near.withColumn("nr", F.row_number().over(order))
                         .filter(F.col("nr") <= positives), "positives")

    # A block learns the positives of its anchors: one flat list per block, ordered by anchor.
    member = dealt(placed.filter("asks"), BLOCK, "q", "part").select(
        F.col("row").alias("anchor"), "home", "part", "dim")
    known = (near.join(member, "anchor").groupBy("home", "part", "dim")
             .agg(F.array_sort(F.collect_list(F.struct("anchor", "nr", "score"))).alias("near")))
    asked = blocks.join(known.select("home", "part", "dim",
                                     F.col("near.anchor").alias("of"), F.col("near.nr").alias("nr"),
                                     F.col("near.score").alias("wanted")), ["home", "part", "dim"])

    def find_negatives(key, shard, asked):
        out = {c: [np.zeros(0, np.int64)] for c in ("anchor", "nr", "id", "row", "score")}
        if shard.num_rows and asked.num_rows:
            for ids, rows, labels, i, _, a_rows, a_labels, score in scored(shard, asked):
                where = {int(r): j for j, r in enumerate(a_rows)}
                lists = [asked.column(c)[i].as_py() for c in ("of", "nr", "wanted")]
                for own, nr, wanted in zip(*lists, strict=True):
                    j = where[own]
                    least, most = -(-low * wanted // 100), high * wanted // 100
                    if least > most:
                        continue
                    fit = (score[j] >= least) & (score[j] <= most) & (labels != a_labels[j])
                    at = best(score[j], ids, rows, fit, negatives)
                    out["anchor"].append(np.full(len(at), own))
                    out["nr"].append(np.full(len(at), nr))
                    out["id"].append(ids[at])
                    out["row"].append(rows[at])
                    out["score"].append(score[j][at].astype(np.int64))
        return pa.table({c: pa.array(np.concatenate(v), pa.int64()) for c, v in out.items()})

    far = visits(asked, False, find_negatives,
                 "anchor long, nr long, id long, row long, score long")
    order = Window.partitionBy("anchor", "nr").orderBy(F.desc("score"), "id", "row")
    far = (far.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
           .select("anchor", "nr", "rank", F.col("id").alias("negative_id"),
                   F.col("score").alias("negative_score")))
    names = whole.filter("asks").select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    pairs = near.select("anchor", "nr", F.col("id").alias("positive_id"),
                        F.col("score").alias("positive_score")).join(names, "anchor")
    return far.join(pairs, ["anchor", "nr"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
