"""The trie of common conversation openings, by burst containers under trie heads."""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscalweave.llm.store import Scratch

#: Turns below its head that a container may hold before it bursts.
LIMIT = 65_536
#: Bytes of a turn id.
ID = 16
#: A head with more children than this, and than 1/512 of all heads, is joined by broadcast.
HOT = 10_000
NONE = hashlib.sha256(b"").hexdigest()

_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends_sha256 string")


def turn_id(role: Column, text: Column) -> Column:
    """128 bits in hex that name a turn: equal for equal role and text."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def rebuilt(turns: DataFrame, scratch: Scratch, base: Column | None = None,
            taken: Column | None = None) -> DataFrame:
    """One row per conversation: (conv, path binary, words array<int>).

    ``path`` holds the turn ids of the rebuilt conversation, 16 bytes each, in order; ``words`` the
    words of each turn. A conversation takes the first ``taken`` turns of conversation ``base``
    (all of them if it has fewer, none if it is absent), then its own turns after the first
    ``taken``. Both are columns over ``conv``; without them a conversation is as it is.

    ``turns`` has conv long, turn, role, text. Texts become ids where they are read; only ids and
    word counts are shuffled. Turns come by turn, null first; rows of one turn by role, the first 64
    characters of the text and id.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    words = F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("int")
    slim = turns.filter(F.col("conv").isNotNull()).select(
        "conv", "turn", F.when(F.length(role) < 64, role).otherwise(F.md5(role)).alias("role"),
        F.left(text, F.lit(64)).alias("head"), turn_id(role, text).alias("id"),
        words.alias("words"))
    place = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "role", "head", "id")
    placed = scratch.write(slim.withColumn("pos", F.row_number().over(place).cast("int"))
                           .select("conv", "pos", "id", "words"), "turns")
    if base is None:
        base, taken = F.col("conv"), F.lit(0)
    step = F.struct("pos", "id", "words")
    most = placed.withColumn("h", taken).withColumn("base", base)
    own = (most.groupBy("conv", "h", "base")
           .agg(F.array_sort(F.collect_list(F.when(F.col("pos") > F.col("h"), step))).alias("own")))
    # The opening of a conversation others may take: its first turns, as many as any may take.
    longest = most.agg(F.max("h")).first()[0] or 0
    opening = (placed.filter(F.col("pos") <= longest).groupBy(F.col("conv").alias("base"))
               .agg(F.array_sort(F.collect_list(step)).alias("opening")))
    joined = own.join(opening, "base", "left") if longest else own.withColumn(
        "opening", F.array().cast("array<struct<pos:int,id:string,words:int>>"))
    steps = F.concat(F.filter(F.coalesce("opening", F.array().cast(
        "array<struct<pos:int,id:string,words:int>>")), lambda s: s["pos"] <= F.col("h")), "own")
    return joined.select("conv", steps.alias("steps")).select(
        "conv", F.unhex(F.array_join("steps.id", "")).alias("path"),
        F.col("steps.words").alias("words"))


def _ends(strings: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of the comma-joined, ascending conversation ids of equal strings.

    The ids of a string arrive sorted and are hashed as they come, so a string that a third of all
    conversations share takes one task's time but no memory.
    """
    def stream(batches):
        key, digest = None, None
        for batch in batches:
            keys = batch.column("key").to_pylist()
            ids = np.array(batch.column("conv"), dtype=np.int64).astype(str)
            cuts = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
            done = []
            for lo, hi in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if lo == hi:
                    continue
                if keys[lo] != key:
                    if key is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = keys[lo], hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(",".join(ids[lo:hi]).encode())
            if done:
                yield pa.record_batch([pa.array([k for k, _ in done], pa.binary()),
                                       pa.array([d for _, d in done])], ["key", "ends"])
        if key is not None:
            yield pa.record_batch([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])],
                                  ["key", "ends"])

    return (strings.select("key", "conv").repartition("key")
            .sortWithinPartitions("key", "conv").mapInArrow(stream, "key binary, ends string"))


def _lcp(a: bytes, b: bytes) -> int:
    """Turns that two paths share at their start."""
    n = min(len(a), len(b)) // ID
    if a[:n * ID] == b[:n * ID]:
        return n
    x, y = (np.frombuffer(p, np.uint64, 2 * n).reshape(n, 2) for p in (a, b))
    return int(np.argmax((x != y).any(axis=1)))


def swept(depth: int, strings: list[tuple]):
    """The nodes of one container below its head, and what the head gathers from them.

    ``strings`` are (path, words, members, smallest member, ends) of distinct paths below a head of
    ``depth`` turns. Sorted, they are swept once with the open nodes of the current path on a
    stack. Returns rows of nodes and (members, smallest, children, leaves, saved, ends).
    """
    strings = sorted(strings, key=lambda s: s[0])
    nodes: list[list] = []  # conv, depth, parent's place, members, children, leaves, saved, ends

    def opened(d: int, parent: int) -> int:
        nodes.append([None, d, parent, 0, 0, 0, 0, None])
        return len(nodes) - 1

    def closed(at: int, words: int) -> None:
        conv, _, parent, members, children, leaves, saved, _ = node = nodes[at]
        node[5] = leaves = leaves if children else 1
        node[6] = saved = saved + (members - 1) * words
        up = nodes[parent]
        up[0] = conv if up[0] is None else min(up[0], conv)
        up[3] += members
        up[4] += 1
        up[5] += leaves
        up[6] += saved

    stack, last, counts = [opened(depth, -1)], b"", []
    for path, words, members, low, ends in strings:
        keep = _lcp(last, path)
        while len(stack) - 1 > keep:
            closed(stack.pop(), counts[len(stack) - 1])
        for d in range(len(stack), len(path) // ID + 1):
            stack.append(opened(depth + d, stack[-1]))
        here = nodes[stack[-1]]
        here[0] = low if here[0] is None else min(here[0], low)
        here[3] += members
        here[7] = ends
        last, counts = path, words
    while len(stack) > 1:
        closed(stack.pop(), counts[len(stack) - 1])
    conv, _, _, members, children, leaves, saved, ends = nodes[0]
    rows = [(n[0], n[1], nodes[n[2]][0], n[3], n[4], n[5], n[6], n[7] or NONE) for n in nodes[1:]]
    return rows, (members, conv, children, leaves, saved, ends)


def prefix_trie(strings: DataFrame, scratch: Scratch, limit: int = LIMIT) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)
    of every node of the trie over (conv, path, words).

    Equal strings fold to one first, so a group of copies is one string with a count. A string then
    goes to the container under the head of its first turn. A container with more than ``limit``
    turns below its head, and more than one string, bursts: its strings go to containers by their
    next turn ids, twice as many turns deep each time, so that long common openings take few
    rounds; a string that ends on the way is a container of its own. Containers are sorted and
    swept into nodes, one group each; the few numbers of each container's head are then summed up
    along the heads above it. A container is bounded by ``limit`` turns or one conversation.

    A node's saved_tokens are the sum over its subtree of (members - 1) x words of the last turn.
    Strings are told apart by 128 bits of hash per turn. No strings, no rows.
    """
    spark = strings.sparkSession
    keyed = scratch.write(strings.withColumn("key", F.unhex(F.md5("path"))), "strings")
    folded = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("conv").alias("low"),
                                      F.first("path").alias("path"), F.first("words").alias("words"))
    folded = folded.join(_ends(keyed), "key").withColumn(
        "t", (F.octet_length("path") / ID).cast("int"))
    folded = scratch.write(folded, "folded")

    # Bursting. Each round reads only the strings of the containers that burst in the last one.
    settled, depth = [], 1
    active = folded.filter("t > 0")
    while True:
        active = active.withColumn("d", F.least(F.lit(depth), F.col("t")))
        active = active.withColumn("head", F.unhex(F.md5(F.expr(f"substring(path, 1, {ID} * d)"))))
        heavy = (active.groupBy("d", "head").agg(F.sum(F.col("t") - F.col("d")).alias("turns"),
                                                 F.count("*").alias("many"))
                 .filter((F.col("turns") > limit) & (F.col("many") > 1)).select("d", "head"))
        heavy = scratch.write(heavy, "heavy")
        if not heavy.head(1):
            settled.append(active)
            break
        settled.append(active.join(heavy, ["d", "head"], "left_anti"))
        active = scratch.write(active.join(heavy, ["d", "head"], "left_semi")
                               .drop("d", "head"), "burst")
        depth *= 2
    contained = reduce(DataFrame.unionByName, [s.select(
        "d", "head", "path", "words", "n", "low", "ends", "t") for s in settled])
    # A container holds suffixes; the path of its head is kept once, beside it.
    suffixes = contained.select(
        "d", "head", F.expr(f"substring(path, {ID} * d + 1)").alias("path"),
        F.slice("words", F.col("d") + 1, F.col("t") - F.col("d")).alias("words"),
        "n", "low", "ends")
    head_paths = contained.groupBy("d", "head").agg(
        F.first(F.expr(f"substring(path, 1, {ID} * d)")).alias("head_path"),
        F.first(F.slice("words", F.lit(1), F.col("d"))).alias("head_words"))

    out_type = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()),
                          ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
                          ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                          ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
                          ("head", pa.binary())])

    def sweep(key, table):
        depth, head = (k.as_py() for k in key)
        lists = [table.column(c).to_pylist() for c in ("path", "words", "n", "low", "ends")]
        rows, (members, conv, children, leaves, saved, ends) = swept(
            depth, list(zip(*lists, strict=True)))
        rows = [(*r, None) for r in rows]
        rows.append((conv, depth, None, members, children, leaves, saved, ends, head))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), out_type.types,
                                                        strict=True)], schema=out_type)

    swept_rows = scratch.write(
        suffixes.groupBy("d", "head").applyInArrow(sweep, f"{_NODE}, head binary"), "nodes")
    inner = swept_rows.filter("head IS NULL").drop("head")
    heads = scratch.write(
        swept_rows.filter("head IS NOT NULL").withColumn("d", F.col("depth").cast("int"))
        .join(head_paths, ["d", "head"]).withColumn("cid", F.hex("head")), "containers")

    # Heads: every container counts for the heads on its path, depth 1 to its own.
    level = F.explode(F.sequence(F.lit(1), F.col("depth").cast("int")))
    on_path = heads.withColumn("j", level).select(
        "cid", "j", F.md5(F.expr(f"substring(head_path, 1, {ID} * j)")).alias("hp"),
        F.md5(F.expr(f"substring(head_path, 1, {ID} * (j - 1))")).alias("up"),
        F.element_at("head_words", F.col("j")).alias("words"), "n_convs", "conv_id",
        F.when(F.col("j") == F.col("depth"), F.col("n_children")).alias("inside"),
        F.when(F.col("j") == F.col("depth"), F.col("ends_sha256")).alias("ends"))
    found = on_path.groupBy("j", "hp").agg(
        F.first("up").alias("up"), F.first("words").alias("words"),
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.sum("inside").alias("inside"), F.max("ends").alias("ends"), F.min("cid").alias("cid"))
    found = scratch.write(found, "heads")
    below = found.filter("j > 1").groupBy((F.col("j") - 1).alias("j"), F.col("up").alias("hp")).agg(
        F.count("*").alias("under"))
    found = scratch.write(
        found.join(below, ["j", "hp"], "left")
        .withColumn("n_children", F.coalesce("inside", F.lit(0)) + F.coalesce("under", F.lit(0)))
        .withColumn("under", F.coalesce("under", F.lit(0))), "heads")
    # A head gives what it holds itself to one container below it; a container sums up from its
    # end to each level of its path; the levels are then added over containers.
    given = found.select("cid", "j", F.when(F.col("n_children") == 0, 1).otherwise(0).alias("leaf"),
                         ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    within = heads.select("cid", F.col("depth").cast("int").alias("j"), F.lit(0).alias("leaf"),
                          F.lit(0).cast("long").alias("saved"),
                          F.when(F.col("n_children") > 0, F.col("n_leaves")).otherwise(0)
                          .alias("in_leaf"), F.col("saved_tokens").alias("in_saved"))
    parts = given.withColumns({"in_leaf": F.lit(0).cast("long"),
                               "in_saved": F.lit(0).cast("long")}).unionByName(within)
    upward = Window.partitionBy("cid").orderBy(F.desc("j")).rangeBetween(
        Window.unboundedPreceding, 0)
    levels = on_path.select("cid", "j", "hp").join(
        parts.groupBy("cid", "j").agg(F.sum(F.col("leaf") + F.col("in_leaf")).alias("leaves"),
                                      F.sum(F.col("saved") + F.col("in_saved")).alias("saved")),
        ["cid", "j"], "left")
    sums = (levels.withColumns({"l": F.sum("leaves").over(upward),
                                "s": F.sum("saved").over(upward)})
            .groupBy("j", "hp").agg(F.sum("l").alias("n_leaves"), F.sum("s").alias("saved_tokens")))
    found = scratch.write(found.join(sums, ["j", "hp"]), "heads")

    # The smallest member of a head's parent: heads with very many children are looked up in a
    # broadcast table of at most 512 rows, the others by an ordinary join.
    count = found.count()
    bar = max(HOT, count // 512)
    parent = found.filter("under > 0").select((F.col("j") + 1).alias("j"), F.col("hp").alias("up"),
                                              F.col("conv_id").alias("parent"), "under")
    hot = F.broadcast(parent.filter(F.col("under") > bar).select("j", "up",
                                                                 F.col("parent").alias("hot")))
    apart = found.filter("j > 1").join(hot, ["j", "up"], "left")
    key = F.when(F.col("hot").isNull(), F.col("up")).otherwise(F.col("hp"))
    apart = apart.withColumn("look", key)
    cold = parent.filter(F.col("under") <= bar).select("j", F.col("up").alias("look"), "parent")
    tree = apart.join(cold, ["j", "look"], "left").select(
        "conv_id", F.col("j").cast("long").alias("depth"),
        F.coalesce("hot", "parent").alias("parent_conv_id"), "n_convs",
        F.col("n_children").cast("long").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"), "saved_tokens",
        F.coalesce("ends", F.lit(NONE)).alias("ends_sha256"))

    # The root: one row, from the heads of depth 1 and the conversations without a turn.
    bare = folded.filter("t = 0")
    top = found.filter("j = 1").agg(
        F.count("*").alias("n_children"), F.sum("n_convs").alias("n"),
        F.min("conv_id").alias("low"), F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved")).first()
    lone = bare.agg(F.sum("n").alias("n"), F.min("low").alias("low"),
                    F.max("ends").alias("ends")).first()
    lows = [r.low for r in (top, lone) if r.low is not None]
    if not lows:
        return spark.createDataFrame([], _NODE)
    root = spark.createDataFrame(
        [(min(lows), 0, None, (top.n or 0) + (lone.n or 0), top.n_children,
          top.leaves if top.n_children else 1, top.saved or 0, lone.ends or NONE)], _NODE)
    first = found.filter("j = 1").select(
        "conv_id", F.col("j").cast("long").alias("depth"),
        F.lit(min(lows)).cast("long").alias("parent_conv_id"), "n_convs",
        F.col("n_children").cast("long").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"), "saved_tokens",
        F.coalesce("ends", F.lit(NONE)).alias("ends_sha256"))
    return root.unionByName(first).unionByName(tree).unionByName(inner)


def conversation_trie(turns: DataFrame, base: Column | None = None, taken: Column | None = None,
                      limit: int = LIMIT, conv_col: str = "conv_id", turn_col: str = "turn",
                      role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The prefix trie of the conversations of a table of turns; see ``rebuilt`` and
    ``prefix_trie``.

    ``base`` and ``taken`` are columns over ``conv``, the conversation's id. Null role or text is
    empty; rows without conversation id take no part; repeated rows are repeated turns, and rows of
    one turn have the fixed order that ``rebuilt`` states. A conversation is one row of ids and
    word counts, 20 bytes a turn. An empty table gives no rows. Other columns are not looked at.
    """
    scratch = Scratch(turns.sparkSession, "trie")
    slim = turns.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                        F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    return prefix_trie(rebuilt(slim, scratch, base, taken), scratch, limit)
