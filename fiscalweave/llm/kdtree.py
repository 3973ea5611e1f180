"""Exact top-k inner products by a KD-tree per shard, shards being parts of space."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscalweave.llm.store import Scratch

#: Vectors of a shard, queries of a block, vectors of a leaf.
SHARD, BLOCK, LEAF = 4096, 256, 128
#: Parts that space is cut into at most, vectors that the cuts are drawn from at most; root boxes
#: that are looked at together, blocks of queries that share one copy of a tree.
CELLS, SAMPLE, BOXES, FAN = 1024, 16_384, 1024, 16


def build(matrix: np.ndarray, leaf: int = LEAF):
    """(row order, nodes, low corners, high corners) of a tree over the rows of a matrix.

    A node is (first row, end, left child, right child), children -1 for leaves. Splits are at the
    median of the widest side; boxes are the tight ones of the rows below.
    """
    order = np.arange(len(matrix))
    nodes, low, high = [], [], []

    def add(lo: int, hi: int) -> int:
        rows = matrix[order[lo:hi]]
        me = len(nodes)
        nodes.append([lo, hi, -1, -1])
        low.append(rows.min(axis=0))
        high.append(rows.max(axis=0))
        width = high[me] - low[me]
        if hi - lo > leaf and width.size and width.max() > 0:
            side, half = int(width.argmax()), (hi - lo) // 2
            part = np.argpartition(rows[:, side], half)
            order[lo:hi] = order[lo:hi][part]
            nodes[me][2] = add(lo, lo + half)
            nodes[me][3] = add(lo + half, hi)
        return me

    add(0, len(matrix))
    return order, np.array(nodes, np.int64), np.stack(low), np.stack(high)


def search(query: np.ndarray, own: int, floor: int | None, k: int, ids: np.ndarray,
           rows: np.ndarray, matrix: np.ndarray, nodes: np.ndarray, low: np.ndarray,
           high: np.ndarray):
    """Places and scores of up to k best rows other than row ``own``, best box first.

    A box is left out when even its best corner scores less than the k-th best so far, or than
    ``floor``, the k-th best found elsewhere. Equal scores count: a smaller id may win them.
    """
    bound = np.maximum(query * low, query * high).sum(axis=1)
    best_at, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
    kth = floor
    heap = [(-int(bound[0]), 0)]
    while heap:
        top, node = heapq.heappop(heap)
        if kth is not None and -top < kth:
            break
        lo, hi, left, right = nodes[node]
        if left >= 0:
            heapq.heappush(heap, (-int(bound[left]), int(left)))
            heapq.heappush(heap, (-int(bound[right]), int(right)))
            continue
        score = matrix[lo:hi] @ query
        fit = rows[lo:hi] != own
        if kth is not None:
            fit &= score >= kth
        if not fit.any():
            continue
        best_at = np.concatenate([best_at, lo + np.flatnonzero(fit)])
        best = np.concatenate([best, score[fit]])
        if len(best) > k:
            cut = np.lexsort((rows[best_at], ids[best_at], -best))[:k]
            best_at, best = best_at[cut], best[cut]
        if len(best) == k:
            kth = max(int(best.min()), floor) if floor is not None else int(best.min())
    return best_at, best


def splits(sample: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """(side, cut) of the 2**levels - 1 median splits of a sample, in heap order.

    A vector whose component on ``side`` is below ``cut`` goes left. Where a part of the sample
    has no two different vectors left, both children take over its split.
    """
    sides, cuts = np.zeros((1 << levels) - 1, np.int64), np.zeros((1 << levels) - 1, np.int64)
    parts = {0: sample}
    for node in range(len(sides)):
        rows = parts.pop(node)
        if len(rows) and rows.shape[1]:
            side = int((rows.max(axis=0) - rows.min(axis=0)).argmax())
            sides[node], cuts[node] = side, int(np.sort(rows[:, side])[len(rows) // 2])
            left = rows[:, side] < cuts[node]
        else:
            left = np.zeros(len(rows), bool)
        parts[2 * node + 1], parts[2 * node + 2] = rows[left], rows[~left]
    return sides, cuts


def cells(matrix: np.ndarray, tree: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The part of space, by the splits, that each row lies in."""
    sides, cuts = tree
    node = np.zeros(len(matrix), np.int64)
    for _ in range((len(sides) + 1).bit_length() - 1):
        right = matrix[np.arange(len(matrix)), sides[node]] >= cuts[node]
        node = 2 * node + 1 + right
    return node - len(sides)


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(queries, boxes): the highest score that a vector in the box can have."""
    kind = np.float64  # exact, and much faster, as long as sums stay below 2**53
    reach = max((int(np.abs(x).max(initial=0)) for x in (low, high)))
    if int(np.abs(queries).max(initial=0)) * reach * max(1, queries.shape[1]) >= 1 << 53:
        kind = np.int64
    up, down = np.maximum(queries, 0).astype(kind), np.minimum(queries, 0).astype(kind)
    return (up @ high.T.astype(kind) + down @ low.T.astype(kind)).astype(np.int64)


def _packed(array: np.ndarray) -> pa.Array:
    return pa.array([np.ascontiguousarray(array).tobytes()], pa.binary())


def _read_row(table: pa.Table, column: str, row: int, kind=np.int64) -> np.ndarray:
    return np.frombuffer(table.column(column)[row].as_buffer(), kind)


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    flat = table.column("v").combine_chunks().flatten()
    return np.array(flat, dtype=np.int64).reshape(table.num_rows, width)


def _numbers(table: pa.Table, column: str) -> np.ndarray:
    return np.array(table.column(column), dtype=np.int64)


def _empty(*columns: str) -> dict[str, list[np.ndarray]]:
    return {c: [np.zeros(0, np.int64)] for c in columns}


def _table(columns: dict[str, list[np.ndarray]]) -> pa.Table:
    return pa.table({c: pa.array(np.concatenate(v), pa.int64()) for c, v in columns.items()})


def in_cells(whole: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``whole`` with ``cell``, the part of space of each vector, by splits of a bounded sample."""
    trees = {}
    for dim, n in counts.items():
        levels = min(CELLS.bit_length() - 1, max(0, math.ceil(math.log2(max(1, n / SHARD)))))
        share = min(1.0, SAMPLE / n)
        drawn = F.pmod(F.xxhash64("row", F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30))
        sample = whole.filter((F.col("dim") == dim) & drawn).select("row", "v").toArrow()
        sample = sample.take(pc.sort_indices(sample.column("row")))
        trees[dim] = splits(_matrix(sample, dim), levels)

    def place(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            width, cell = _numbers(table, "dim"), np.zeros(batch.num_rows, np.int64)
            for dim, tree in trees.items():
                at = np.flatnonzero(width == dim)
                if len(at):
                    cell[at] = cells(_matrix(table.take(pa.array(at)), dim), tree)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))],
                                             [*batch.schema.names, "cell"])

    fields = "row long, id long, asks boolean, v array<long>, dim int, cell int"
    return whole.select("row", "id", "asks", "v", "dim").mapInArrow(place, fields)


def top_inner_products(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024,
                       id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the highest integer inner products.

    Components become floor(scale * x) with x as double. Queries are the rows for which
    ``is_query`` holds; candidates are all other rows of the same dimension. Ties go to the smaller
    identifier; with fewer than k candidates all are given.

    Median splits of a bounded sample (``SAMPLE`` vectors, at most ``CELLS`` parts) cut space;
    a part is one shard, or several where it holds more than ``SHARD`` vectors, and each shard has
    a KD-tree with tight boxes. Every query goes to the shard whose root box promises most; the
    k-th score it finds there is its floor. Blocks of queries from the same part then meet the root
    boxes again, and a block visits a shard only with those queries that the box may still offer
    something. No vector is skipped unseen except by a bound, so the result is exact as long as
    scores fit 64 bits.

    Vectors that are null or hold null or non-finite components take no part, nor do rows without
    identifier. Rows are told apart by row, not by identifier: other rows with the query's
    identifier are candidates, and every row of a repeated query identifier gets ranks of its own.
    An empty table, or no query, gives no rows. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "kdtree")
    x = F.col(vector_col)
    wrong = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    whole = scratch.write(
        vectors.filter(F.col(id_col).isNotNull() & x.isNotNull() & ~F.exists(x, wrong))
        .select(F.col(id_col).cast("long").alias("id"),
                F.coalesce(is_query, F.lit(False)).alias("asks"),
                F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"))
        .withColumns({"dim": F.size("v"), "row": F.monotonically_increasing_id()}), "vectors")
    counts = {r.dim: r.n for r in whole.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    placed = scratch.write(in_cells(whole, counts), "placed")

    # At most CELLS counts a dimension. Cells become shards, and runs of cells blocks of queries.
    held = sorted(placed.groupBy("dim", "cell").agg(
        F.count("*").alias("n"), F.count_if("asks").alias("q")).collect())
    layout, shards, asked = [], dict.fromkeys(counts, 0), dict.fromkeys(counts, 0)
    for dim, cell, n, q in held:
        parts = math.ceil(n / SHARD)
        layout.append((dim, cell, shards[dim], parts, asked[dim], max(q, 1)))
        shards[dim] += parts
        asked[dim] += q
    layout = F.broadcast(spark.createDataFrame(
        layout, "dim int, cell int, first long, parts long, before long, q long"))
    deal = lambda n: F.pmod(F.xxhash64("row"), F.col(n))
    laid = placed.join(layout, ["dim", "cell"]).select(
        "row", "id", "asks", "v", "dim", (F.col("first") + deal("parts")).cast("int").alias("shard"),
        ((F.col("before") + deal("q")) / BLOCK).cast("int").alias("block"))

    def grow(key, table):
        width, shard = (c.as_py() for c in key)
        matrix = _matrix(table, width)
        order, nodes, low, high = build(matrix)
        ids, rows = _numbers(table, "id"), _numbers(table, "row")
        return pa.table({"dim": pa.array([width], pa.int32()), "shard": pa.array([shard], pa.int32()),
                         "ids": _packed(ids[order]), "rows": _packed(rows[order]),
                         "m": _packed(matrix[order]), "nodes": _packed(nodes),
                         "low": _packed(low), "high": _packed(high),
                         "box_low": _packed(low[0]), "box_high": _packed(high[0])})

    blob = ", ".join(f"{c} binary" for c in ("ids", "rows", "m", "nodes", "low", "high", "box_low",
                                             "box_high"))
    trees = scratch.write(laid.groupBy("dim", "shard").applyInArrow(
        grow, f"dim int, shard int, {blob}"), "trees")

    def pack(key, table):
        width, block = (c.as_py() for c in key)
        return pa.table({"dim": pa.array([width], pa.int32()), "block": pa.array([block], pa.int32()),
                         "rows": _packed(_numbers(table, "row")), "m": _packed(_matrix(table, width))})

    blocks = scratch.write(laid.filter("asks").groupBy("dim", "block").applyInArrow(
        pack, "dim int, block int, rows binary, m binary"), "blocks")
    boxes = trees.select("dim", "shard", "box_low", "box_high",
                         F.floor(F.col("shard") / BOXES).cast("int").alias("page"))
    pages = F.broadcast(spark.createDataFrame(
        [(d, p) for d, n in shards.items() for p in range(math.ceil(n / BOXES))],
        "dim int, page int"))  # one row for BOXES shards
    crowd = F.floor(F.col("block") / FAN).cast("int").alias("crowd")
    crowds = F.broadcast(spark.createDataFrame(
        [(d, g) for d, q in asked.items() for g in range(math.ceil(math.ceil(q / BLOCK) / FAN))],
        "dim int, crowd int"))  # one row for FAN * BLOCK queries

    def promises(asked_blocks: DataFrame, work, schema: str) -> DataFrame:
        """Blocks of queries against pages of root boxes."""
        keys = ["dim", "page", "crowd"]
        left = boxes.join(crowds, "dim")
        right = asked_blocks.withColumn("crowd", crowd).join(pages, "dim")
        right = right.toDF(*right.columns)
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, schema)

    def corners(page, width):
        count = page.num_rows
        low = np.concatenate([_read_row(page, "box_low", i) for i in range(count)])
        high = np.concatenate([_read_row(page, "box_high", i) for i in range(count)])
        return _numbers(page, "shard"), low.reshape(count, width), high.reshape(count, width)

    def promise_most(key, page, blocks_):
        out = _empty("row", "shard", "bound")
        if page.num_rows and blocks_.num_rows:
            width = key[0].as_py()
            number, low, high = corners(page, width)
            for i in range(blocks_.num_rows):
                rows = _read_row(blocks_, "rows", i)
                top = bounds(_read_row(blocks_, "m", i).reshape(len(rows), width), low, high)
                best = top.argmax(axis=1)
                out["row"].append(rows)
                out["shard"].append(number[best])
                out["bound"].append(top[np.arange(len(rows)), best])
        return _table(out)

    def found_in(tree, rows, matrix, floors):
        """(query rows, ids, candidate rows, scores) of some queries in one tree."""
        ids, own = _read_row(tree, "ids", 0), _read_row(tree, "rows", 0)
        width = matrix.shape[1]
        m = _read_row(tree, "m", 0).reshape(len(ids), width)
        nodes = _read_row(tree, "nodes", 0).reshape(-1, 4)
        low, high = (_read_row(tree, c, 0).reshape(len(nodes), width) for c in ("low", "high"))
        for row, query, floor in zip(rows.tolist(), matrix, floors, strict=True):
            at, score = search(query, row, floor, k, ids, own, m, nodes, low, high)
            yield np.full(len(at), row), ids[at], own[at], score

    home = scratch.write(
        promises(blocks, promise_most, "row long, shard long, bound long").groupBy("row")
        .agg(F.max_by("shard", F.struct("bound", -F.col("shard"))).cast("int").alias("shard")), "home")
    result = "row long, vec_id long, other long, score long"

    def probe_home(key, tree, queries):
        out = _empty("row", "vec_id", "other", "score")
        if tree.num_rows and queries.num_rows:
            matrix = _matrix(queries, key[0].as_py())
            for found in found_in(tree, _numbers(queries, "row"), matrix, [None] * len(matrix)):
                for name, values in zip(out, found, strict=True):
                    out[name].append(values)
        return _table(out)

    own = laid.filter("asks").select("row", "dim", "v", "block").join(home, "row")
    own = own.select("row", "dim", "v", "shard", crowd)
    copies = trees.join(own.select("dim", "shard", "crowd").distinct(), ["dim", "shard"])
    own = own.toDF(*own.columns)
    keys = ["dim", "shard", "crowd"]
    first = scratch.write(copies.groupBy(*keys).cogroup(own.groupBy(*keys))
                          .applyInArrow(probe_home, result), "first")

    # The floor of each query, beside its block; then what each box may still offer.
    floors = (laid.filter("asks").select("row", "dim", "block").join(home, "row")
              .join(first.groupBy("row").agg(
                  F.when(F.count("*") >= k, F.min("score")).alias("floor")), "row", "left")
              .groupBy("dim", "block").agg(F.collect_list(F.struct("row", "shard", "floor")).alias("f"))
              .select("dim", "block", F.col("f.row").alias("of"), F.col("f.shard").alias("home"),
                      F.col("f.floor").alias("floor")))
    blocks = scratch.write(blocks.join(floors, ["dim", "block"]), "floors")
    _least = np.iinfo(np.int64).min

    def by_row(blocks_, i, rows):
        where = {r: j for j, r in enumerate(blocks_.column("of")[i].as_py())}
        home, floor = (blocks_.column(c)[i].as_py() for c in ("home", "floor"))
        order = [where[r] for r in rows.tolist()]
        return [home[j] for j in order], [floor[j] for j in order]

    def still_offer(key, page, blocks_):
        out = {"block": [], "shard": [], "wanted": []}
        if page.num_rows and blocks_.num_rows:
            width = key[0].as_py()
            number, low, high = corners(page, width)
            for i in range(blocks_.num_rows):
                rows = _read_row(blocks_, "rows", i)
                home_of, floor = by_row(blocks_, i, rows)
                top = bounds(_read_row(blocks_, "m", i).reshape(len(rows), width), low, high)
                least = np.array([_least if f is None else f for f in floor], np.int64)
                want = ((top >= least[:, None])
                        & (number[None, :] != np.array(home_of, np.int64)[:, None]))
                for j in np.flatnonzero(want.any(axis=0)):
                    out["block"].append(blocks_.column("block")[i].as_py())
                    out["shard"].append(int(number[j]))
                    out["wanted"].append(np.flatnonzero(want[:, j]).astype(np.int32).tobytes())
        n = len(out["block"])
        return pa.table({"dim": pa.array([key[0].as_py()] * n, pa.int32()),
                         "block": pa.array(out["block"], pa.int32()),
                         "shard": pa.array(out["shard"], pa.int32()),
                         "wanted": pa.array(out["wanted"], pa.binary())})

    visits = scratch.write(promises(blocks, still_offer,
                                    "dim int, block int, shard int, wanted binary"), "visits")

    def probe(key, tree, visitors):
        out = _empty("row", "vec_id", "other", "score")
        if tree.num_rows:
            width = key[0].as_py()
            for i in range(visitors.num_rows):
                rows = _read_row(visitors, "rows", i)
                _, floor = by_row(visitors, i, rows)
                matrix = _read_row(visitors, "m", i).reshape(len(rows), width)
                at = _read_row(visitors, "wanted", i, np.int32)
                for found in found_in(tree, rows[at], matrix[at], [floor[j] for j in at]):
                    for name, values in zip(out, found, strict=True):
                        out[name].append(values)
        return _table(out)

    visitors = visits.withColumn("crowd", crowd)
    copies = trees.join(visitors.select(*keys).distinct(), ["dim", "shard"])
    visitors = visitors.join(blocks, ["dim", "block"])
    visitors = visitors.toDF(*visitors.columns)
    rest = (copies.groupBy(*keys).cogroup(visitors.groupBy(*keys)).applyInArrow(probe, result))
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id", "other")
    best = (first.unionByName(rest).withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k))
    return best.join(whole.filter("asks").select("row", F.col("id").alias("query_id")), "row").select(
        "query_id", "rank", "vec_id", "score")
