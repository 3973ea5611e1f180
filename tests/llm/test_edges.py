"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import brute
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from fiscalweave.llm import (bloom_lm, bpe, exact_dedup, kdtree, minhash, mixing, shards,
                             substring_dedup, token_counts, toxicity)

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
#: Names that the operators use inside, as columns of the input.
CLASH = ("id", "key", "mark", "part", "row", "n", "size", "bucket", "root", "sig", "a", "b", "h",
         "salt", "head", "middle", "s", "k", "src", "spans", "tile", "score_", "text_mark")

LONG = " ".join(f"w{i % 900}" for i in range(30_000)) + " " + "x" * 20_000
PASSAGE = " ".join(f"p{i}" for i in range(40))
TEXTS = ["Hello World", "hello world", "HELLO wörld É", "hello wörld É", "hello wörld é", "", None,
         " \t\n ", LONG, LONG, PASSAGE, "before " + PASSAGE + " after", PASSAGE + " tail",
         " ".join(["again"] * 80), "one two", "one  two", "ΑΣ Σ İ ǅ \x1c <|endoftext|> it's 42",
         " no break line", " ".join(f"u{i}" for i in range(36))]
ROWS = [(i, t) for i, t in enumerate(TEXTS, 1)]


def frame(spark, rows):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           *[T.StructField(c, T.StringType()) for c in CLASH]])
    return spark.createDataFrame([(i, t, None, "s" if i and i % 3 else None, *[None] * len(CLASH))
                                  for i, t in rows], schema)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def got(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def same(df, cols, want):
    assert got(df, *cols) == sorted(want, key=repr)


# -- exact dedup ---------------------------------------------------------------------------------

EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact(spark, docs, empty):
    same(exact_dedup.exact_groups(docs), EXACT, brute.exact(ROWS))
    same(exact_dedup.exact_groups(docs, keep="min"), EXACT, brute.exact(ROWS, min))
    assert exact_dedup.exact_groups(empty).collect() == []
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, k, *_ in brute.exact(ROWS) if i == k}
    twice = [(1, "a"), (1, "A"), (None, "a"), (None, "b"), (2, "c"), (2, "d")]
    marks = {(r.doc_id, r.text_sha256): (r.keep_id, r.group_size, r.kept)
             for r in exact_dedup.exact_groups(frame(spark, twice)).collect()}
    assert marks[1, brute.sha("a")] == (1, 3, True) and marks[None, brute.sha("a")] == (1, 3, False)
    assert marks[None, brute.sha("b")] == (None, 1, True)
    assert exact_dedup.exact_dedup(frame(spark, twice)).count() == 5


def test_links_of_any_text_of_a_repeated_identifier(spark):
    def near(name, other=()):
        return " ".join(f"{name}{i}" for i in range(80) if i not in other)

    rows = []
    for k in range(12):  # one document with several texts, each of which has a near copy elsewhere
        rows += [(1, near(f"t{k}_"))] * 2 + [(100 + k, near(f"t{k}_", (79,))), (200 + k, near(f"t{k}_", (0,)))]
    rows += [(900, near("alone"))]
    out = {(r.doc_id, r.component_id) for r in minhash.near_groups(frame(spark, rows)).collect()}
    assert out == {(i, 1) for i, _ in rows[:-1]} | {(900, 900)}


def test_exact_over_many_ranges(spark):
    """Texts that share their first characters, and groups on both sides of every splitter."""
    rows = [(i, "the same beginning of a text, longer than the head of the sort key " * (i % 2)
             + f"{i * 7 % 41:03d}") for i in range(900)] + [(None, "x"), (None, "x"), (5, "X")]
    for parts in (1, 3, 40):
        for keep in ("max", "min"):
            out = exact_dedup.exact_groups(frame(spark, rows), keep=keep, partitions=parts)
            groups = {}
            for i, t in rows:
                groups.setdefault(brute.lower(t), []).append(i)
            best = {t: (max if keep == "max" else min)([i for i in g if i is not None])
                    for t, g in groups.items()}
            same(out, EXACT, [(i, best[t], len(groups[t]), i == best[t], brute.sha(t))
                              for i, raw in rows for t in (brute.lower(raw),)])


def test_exact_sorts_and_joins_no_digest(spark, docs):
    seen = exact_dedup._grouped(docs, "doc_id", "text", "max", 6, {})
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan  # one shuffle of the texts
    whole = exact_dedup.exact_groups(docs)._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in whole.splitlines() if "Join" in x]
    assert len(joins) == 1 and "Join [group_" in joins[0] and "sha2(" not in whole


def test_exact_with_a_hot_text(spark):
    rows = [(i, "copy" if i % 3 == 0 else "Copy" if i % 3 == 1 and i % 2 else f"t{i}")
            for i in range(2_000)]
    same(exact_dedup.exact_groups(frame(spark, rows)), EXACT, brute.exact(rows))
    kept = exact_dedup.exact_dedup(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(
        (i, dict(rows)[i]) for i, k, *_ in brute.exact(rows) if i == k)


# -- substring dedup -----------------------------------------------------------------------------

REPEAT = ("doc_id", "n_words", "n_removed", "kept_sha256")


def test_repeats(spark, docs, empty):
    same(substring_dedup.repeat_digests(docs), REPEAT, brute.repeats(ROWS, 35))
    same(substring_dedup.repeat_digests(docs, 5), REPEAT, brute.repeats(ROWS, 5))
    assert substring_dedup.repeat_digests(empty).collect() == []
    copies = [(1, PASSAGE), (1, PASSAGE), (None, PASSAGE + " x"), (3, "short")]
    same(substring_dedup.repeat_digests(frame(spark, copies)), REPEAT, brute.repeats(copies, 35))
    texts = {r.doc_id: r.text for r in substring_dedup.repeat_free_texts(docs).collect()}
    assert texts[12] == "before after" and texts[14] == ""


def test_repeats_shared_by_many_with_edits(spark):
    rows = []
    for i in range(60):
        words = [f"c{j}" for j in range(120)]
        words[(7 * i) % 120] = f"edit{i}"
        rows.append((i, " ".join([f"own{i}"] * (i % 5) + words + [f"end{i}"])))
    same(substring_dedup.repeat_digests(frame(spark, rows)), REPEAT, brute.repeats(rows, 35))


# -- near dedup ----------------------------------------------------------------------------------

NEAR = ("doc_id", "n_shingles", "component_id", "kept")


def test_near(spark, docs, empty):
    same(minhash.near_groups(docs), NEAR, brute.near(ROWS, 3, 85))
    assert minhash.near_groups(empty).collect() == []
    kept = minhash.near_dedup(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, _, k in brute.near(ROWS, 5, 80) if k}
    odd = minhash.near_groups(frame(spark, [(None, "a b c"), (None, "a b c"), (4, "a b c"), (5, None)]))
    assert got(odd, "doc_id", "component_id", "kept") == [
        (4, 4, True), (5, 5, True), (None, None, True), (None, None, True)]


def test_near_chains_and_borderline_rings(spark):
    """Copies that drift away from each other, so that no leader is linked with all of them."""
    rows, words = [], [f"w{i}" for i in range(300)]
    for i in range(150):
        words = list(words)
        for j in range(3):
            words[(i * 37 + j * 101) % 300] = f"n{i}_{j}"
        rows.append((1000 - i, " ".join(words)))
    for i in range(150):
        base = [f"z{k}" for k in range(200)]
        base[(i * 13) % 200], base[(i * 29 + 7) % 200], base[(i * 5 + 90) % 200] = f"q{i}", f"r{i}", f"s{i}"
        rows.append((2000 + i, " ".join(base)))
    same(minhash.near_groups(frame(spark, rows)), NEAR, brute.near(rows, 3, 85))
    small = minhash.Settings(tile=16)
    same(minhash.near_groups(frame(spark, rows), small), NEAR, brute.near(rows, 3, 85))


# -- sharding, mixing ----------------------------------------------------------------------------

SHARD = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def test_shards(spark, docs, empty, monkeypatch):
    same(shards.byte_shards(docs), SHARD, brute.shard(ROWS, 8))
    same(shards.byte_shards(docs, 3), SHARD, brute.shard(ROWS, 3))
    with monkeypatch.context() as m:
        m.setattr(shards, "ROWS", 3)
        m.setattr(shards, "RUN", 2)
        same(shards.byte_shards(docs), SHARD, brute.shard(ROWS, 8))
    assert shards.byte_shards(empty).collect() == []
    rows = [(i // 3, "x" * (i % 50)) for i in range(3000)]
    same(shards.byte_shards(frame(spark, rows)), SHARD, brute.shard(rows, 8))
    nulls = shards.byte_shards(frame(spark, [(None, "b"), (1, "a"), (None, None)]), 2).collect()
    assert sorted((r.shard, r.slot) for r in nulls if r.doc_id is None)[0] == (0, 0)


def test_ranges_follow_the_rows(spark, monkeypatch):
    """More rows, more ranges; rows that are equal in all that is compared fill several of them."""
    from fiscalweave.llm import store

    written = {}
    write = store.Scratch.write

    def watch(self, df, name):
        out = write(self, df, name)
        if name == "ranges":
            written["n"] = [r[0] for r in out.groupBy("part").count().select("count").collect()]
        return out

    monkeypatch.setattr(store.Scratch, "write", watch)
    monkeypatch.setattr(shards, "ROWS", 100)
    monkeypatch.setattr(shards, "RUN", 4)
    for n, hot in ((500, 0), (2000, 0), (2000, 900)):
        rows = [(7, "same")] * hot + [(i, "x" * (i % 9)) for i in range(n - hot)]
        same(shards.byte_shards(frame(spark, rows)), SHARD, brute.shard(rows, 8))
        assert len(written["n"]) >= 0.7 * n / 100 and max(written["n"]) < 400


def test_mixing_deviation(spark, docs, empty):
    slots = mixing.shares({"a": 5, "b": 3, "c": 0.01}, 1000)
    plan = mixing.schedule(slots)
    owner = {t: s for s, ts in plan.items() for t in ts}
    seen = dict.fromkeys(slots, 0)
    assert sorted(owner) == list(range(1000))
    for t in range(1000):
        seen[owner[t]] += 1
        assert all(abs(seen[s] - slots[s] * (t + 1) / 1000) < 1 for s in slots)
    rows = mixing.mixed(docs, {"s": 2.0}, block=2).collect()
    assert sorted(r.doc_id for r in rows) == [i for i, _ in ROWS]
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in rows)
    assert len({(r.mix_slot, r.mix_row) for r in rows}) == len(rows)
    assert mixing.mixed(empty).collect() == []
    ordered = mixing.in_mixed_order(docs, {"s": 1.0})
    assert ordered.columns == docs.columns and ordered.count() == len(ROWS)
    last = mixing.mixed(docs, {"s": 1.0, "": 0.0}, block=2)
    assert last.count() == len(ROWS)
    zero = mixing.mixed(docs.fillna("t", ["source"]), {"s": 1.0, "t": 0.0}).collect()
    top = max(r.mix_slot for r in zero if r.source == "s")
    assert all(r.mix_slot > top for r in zero if r.source == "t")
    with pytest.raises(ValueError):
        mixing.mixed(docs.withColumn("MIX_slot", F.lit(1)))


# -- language model, toxicity --------------------------------------------------------------------


def test_lm(spark, docs, empty):
    held = lambda i: i % 4 == 0
    want = brute.base_scores(ROWS, held)
    for hot in (1 << 18, 3):  # with few exact counts broadcast, the rest is joined
        rows = bloom_lm.lm_scores(docs, F.col("doc_id") % 4 == 0,
                                  settings=bloom_lm.Settings(hot_words=hot, shard_bytes=4096)).collect()
        assert len(rows) == len(ROWS)
        for r in rows:
            h, n, known, total, base = want[r.doc_id]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, total)
            assert r.base_score == pytest.approx(base, rel=1e-9) and r.score <= 0
    assert bloom_lm.lm_scores(empty, F.lit(False)).collect() == []
    none = bloom_lm.lm_scores(docs, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in none)
    twice = bloom_lm.lm_scores(frame(spark, [(1, "a b"), (1, "a b"), (None, "a")]), F.lit(False))
    assert twice.count() == 3


def test_lm_scores_from_exact_counts(spark, docs):
    """With next to no filter errors the scores are those of the exact, quantised counts; at the
    usual size they stay close."""
    want = brute.lm_scores(ROWS, lambda i: i % 4 == 0)
    held = F.col("doc_id") % 4 == 0
    for bits in (200.0, 8.0):
        rows = bloom_lm.lm_scores(docs, held, settings=bloom_lm.Settings(bits=bits, shard_bytes=1 << 16)).collect()
        assert sum(r.score for r in rows) == pytest.approx(sum(want.values()), rel=0.02)
        off = [abs(r.score - want[r.doc_id]) / r.n_tokens for r in rows]  # per token, in log10
        assert max(off) < (1e-9 if bits > 100 else 0.5)


@pytest.mark.parametrize("slice_bytes", [1 << 30, 1 << 14, 1])
def test_lm_scores_do_not_depend_on_the_slices(spark, docs, empty, slice_bytes):
    """The filter whole, in one slice, in a few, and in one for every shard."""
    held = F.col("doc_id") % 4 == 0
    cols = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    whole = bloom_lm.lm_scores(docs, held, settings=bloom_lm.Settings(shard_bytes=1 << 16))
    cut = bloom_lm.Settings(shard_bytes=1 << 16, max_bytes=0, slice_bytes=slice_bytes)
    same(bloom_lm.lm_scores(docs, held, settings=cut), cols, got(whole, *cols))
    twice = frame(spark, [(1, "a b"), (1, "a b"), (None, None), (2, "")])
    assert bloom_lm.lm_scores(twice, F.lit(False), settings=cut).count() == 4
    assert bloom_lm.lm_scores(empty, F.lit(False), settings=cut).collect() == []


def test_filter_never_misses_and_seldom_invents():
    import numpy as np

    s = bloom_lm.Settings()
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    counts = rng.geometric(0.1, 20_000)
    data = bloom_lm.build_filter(keys, counts, s, s.bits)
    model = {"shard_bits": 0, "probes": s.probes, "values": s.values(), "data": data,
             "sizes": np.array([8 * len(data)], np.uint64), "starts": np.array([0]), "first": 0}
    level, true = bloom_lm.levels_of(keys, model), np.searchsorted(s.values(), counts, "right") - 1
    assert (level >= true).all() and (level > true).mean() < 0.04
    assert (bloom_lm.levels_of(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64), model) > 0).mean() < 0.04
    assert (bloom_lm.unpacked(bloom_lm.packed(counts), len(counts)) == counts).all()


def test_toxicity_learns_a_pair_of_terms(spark, empty):
    """Either word alone is harmless; only both together are labelled."""
    import random

    rng = random.Random(3)
    rows, labels = [], []
    for i in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [f"f{rng.randrange(40)}" for _ in range(12)] + ["insult"] * a + ["group"] * b
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(a and b), None))
    docs = frame(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    out = {r.doc_id: r.tox for r in toxicity.toxicity(
        docs, marks, score_col="tox", settings=toxicity.Settings(epochs=40)).collect()}
    test = [(out[i], y) for i, y, _ in labels if brute.crc(i) % 5 == 0]
    assert sum((p >= 0.5) == bool(y) for p, y in test) / len(test) > 0.95


def test_toxicity_edges(spark, docs, empty):
    marks = spark.createDataFrame([(i, i % 2, None) for i in range(1, 20)] + [(None, 1, None), (3, None, None)],
                                  "doc_id long, toxic int, quality int")
    out = toxicity.toxicity(docs, marks, score_col="tox")
    assert out.columns == [*docs.columns, "tox"] and out.count() == len(ROWS)
    assert all(0 <= r.tox <= 1 for r in out.collect())
    assert toxicity.toxicity(empty, marks).collect() == []
    flat = toxicity.toxicity(docs, marks.limit(0)).collect()
    assert len({r.score for r in flat}) == 1
    kept = toxicity.toxic_rows_removed(docs, marks)
    assert kept.columns == docs.columns
    with pytest.raises(ValueError):
        toxicity.toxicity(docs, marks, score_col="SCORE_")


# -- tokens --------------------------------------------------------------------------------------


def test_tokens(spark, docs, empty):
    rows = ROWS + [(90, "a" * 3000), (91, "<|endoftext|><|endoftext|> x<|endoftext|>"), (92, "ab\x85 \x85  c"),
                   (93, "日本語 😀 ½ ² é ​"), (None, "null id"), (1, "again")]
    df = frame(spark, rows)
    known = Tokenizer.from_file(BYTE)
    want = [(i, len((t or "").encode()), n, n > 5) for i, t in rows
            for n in (len(known.encode(t or "", add_special_tokens=False).ids),)]
    same(token_counts.token_counts(df, BYTE, 5), ("doc_id", "n_bytes", "n_tokens", "over_limit"), want)
    assert token_counts.token_counts(empty, BYTE).collect() == []


def test_bpe(spark, docs, empty):
    rows = ROWS + [(90, "a" * 3000), (91, "<|endoftext|>A<|startoftext|> x<|endoftext|>"),
                   (92, "日本語 😀 ½ ² é İ"), (None, "null id"), (1, "again")]
    df = frame(spark, rows)
    known = Tokenizer.from_file(WORD)
    want = []
    for i, t in rows:
        ids = known.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), brute.sha(" ".join(map(str, ids))),
                     brute.sha(known.decode(ids, skip_special_tokens=False))))
    cols = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    same(bpe.bpe_digests(df, WORD), cols, want)
    same(bpe.bpe_ids_and_digests(df, WORD), cols, want)
    assert bpe.bpe_digests(empty, WORD).collect() == []
    ids = {r.doc_id: list(r.ids) for r in bpe.bpe_encoded(df, WORD, keep=("lang",)).collect()}
    assert ids[2] == known.encode("hello world", add_special_tokens=False).ids and ids[7] == []


# -- vectors -------------------------------------------------------------------------------------


def test_vectors(spark, monkeypatch):
    import random

    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(400)]
    rows += [(400, rows[0][1]), (401, rows[0][1]), (402, None), (403, [0.1] * 5 + [None]),
             (404, [float("nan")] + [0.0] * 5), (405, [float("inf")] + [0.0] * 5), (500, [0.0] * 6)]
    rows = [(i, None if v is None else v) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit(1))
    cols = ("query_id", "rank", "vec_id", "score")
    ask = F.col("vec_id") % 100 == 0
    want = brute.top(rows, 10, 100)
    same(kdtree.top_inner_products(df, ask), cols, want)
    for small in ({"SHARD": 64, "BLOCK": 2}, {"SHARD": 16, "BLOCK": 1, "BOXES": 3, "FAN": 2},
                  {"SHARD": 20, "CELLS": 4, "SAMPLE": 30}):
        with monkeypatch.context() as m:
            for name, value in small.items():
                m.setattr(kdtree, name, value)
            same(kdtree.top_inner_products(df, ask), cols, want)
    assert kdtree.top_inner_products(df.limit(0), ask).collect() == []
    # Rows that repeat an identifier are candidates, and queries, of their own.
    twice = rows + [(0, rows[7][1]), (0, rows[0][1]), (5, rows[6][1]), (5, rows[6][1])]
    df = spark.createDataFrame(twice, "vec_id long, embedding array<double>")
    same(kdtree.top_inner_products(df, ask), cols, brute.top(twice, 10, 100))
    near = spark.createDataFrame([(0, [1.0]), (1, [0.5]), (1, [2.0])],
                                 "vec_id long, embedding array<float>")
    assert got(kdtree.top_inner_products(near, ask), *cols) == [(0, 1, 1, 2048 * 1024), (0, 2, 1, 512 * 1024)]
    mixed = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0]), (2, [3.0, 1.0]), (None, [1.0, 1.0])],
                                  "vec_id long, embedding array<float>")
    assert got(kdtree.top_inner_products(mixed, ask), "query_id", "vec_id") == [(0, 2)]


def test_tree_with_equal_rows():
    import numpy as np

    m = np.zeros((1000, 3), np.int64)
    order, nodes, low, high = kdtree.build(m, 10)
    at, score = kdtree.search(np.array([1, 2, 3]), 5, None, 4, order, order, m, nodes, low, high)
    assert list(order[at]) == [0, 1, 2, 3] and not score.any()


def test_boxes_bound_what_they_hold():
    import numpy as np

    rng = np.random.default_rng(2)
    m = rng.integers(-900, 900, (3000, 8))
    tree = kdtree.splits(m[:500], 4)
    cell = kdtree.cells(m, tree)
    assert np.bincount(cell, minlength=16).min() > 100  # median splits of a sample
    low = np.stack([m[cell == c].min(0) for c in range(16)])
    high = np.stack([m[cell == c].max(0) for c in range(16)])
    for q in (m[:50], m[:50] << 40):
        top = kdtree.bounds(q, low, high)
        assert (top[:, cell] >= q @ m.T).all()
    same_ = kdtree.splits(np.zeros((40, 3), np.int64), 3)
    assert set(kdtree.cells(np.zeros((5, 3), np.int64), same_)) == {7}


@pytest.mark.parametrize("letters", ["\u1c89", "\ua7cb", "\U00010d50", "\U00016ea0", "\u0558\u208f\ua7ce",
                                     "İΣς\u1e9e\u0345", "\U0001faea \u0897"])
def test_bpe_of_letters_that_python_does_not_know(spark, letters):
    known = Tokenizer.from_file(WORD)
    texts = [letters, f"a{letters}b {letters}{letters}1{letters} !{letters}", f"Plain {letters} TEXT it's"]
    want = [(i, len(ids), brute.sha(" ".join(map(str, ids)))) for i, t in enumerate(texts)
            for ids in (known.encode(t, add_special_tokens=False).ids,)]
    same(bpe.bpe_digests(frame(spark, list(enumerate(texts))), WORD),
         ("doc_id", "n_tokens", "ids_sha256"), want)
