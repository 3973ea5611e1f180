"""The five stages one by one and as a whole, on odd inputs."""

import os

import brute
import corpus_pipeline as pipeline
import duckdb
import public_tokenizers
import pytest
from conftest import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, s string, id int"
STAGES = dict(pipeline.STAGES)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, None, None) for i, t, s in rows], SCHEMA)


ROWS = [(i, f"text number {i} with some words of its own w{i} x{i} y{i}", f"s{i % 3}") for i in range(60)]
ROWS += [(100, ROWS[3][1].upper(), "s1"), (101, ROWS[3][1], None), (102, None, None), (103, "", "s0"),
         (None, "no identifier here", "s1"), (None, "no identifier either", "s1"),
         (104, " ".join(f"near{k}" for k in range(60)), "s2"),
         (105, " ".join(f"near{k}" for k in range(59)) + " other", "s2"), (4, ROWS[4][1], "s1"),
         (106, "long " * 20_000, "s0")]


def root(spark, tmp_path, rows, labels=()):
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=repr)


def test_stages_keep_columns_and_take_empty_tables(spark, tmp_path):
    where = root(spark, tmp_path, [])
    for name, stage in pipeline.STAGES:
        out = stage(spark, frame(spark, []), where)
        assert out.collect() == []
        if name != "bpe_encoding":
            assert out.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(
                " int", "").split(", ")
    assert pipeline.run(spark, where).collect() == []


def test_whole_run_on_odd_documents(spark, tmp_path):
    where = root(spark, tmp_path, ROWS, [(i, 1, 0) for i in range(30)] + [(None, 1, 1), (31, 1, None)])
    out = pipeline.run(spark, where).collect()
    # Equal texts: the largest identifier; near ones: the smallest; empty texts are one group.
    kept = sorted([i for i, _, _ in ROWS if i not in (3, 100, 102, 105)], key=repr)
    assert sorted((r.doc_id for r in out), key=repr) == kept
    known = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {i: t or "" for i, t, _ in ROWS if i is not None}
    for r in out:
        assert r.n_tokens == len(r.ids)
        if r.doc_id is not None:
            want = known.encode(texts[r.doc_id], add_special_tokens=False).ids
            assert list(r.ids) == want and r.ids_sha256 == brute.sha(" ".join(map(str, want)))
    places = [(r.mix_slot, r.mix_row) for r in out]
    assert len(set(places)) == len(places)


def test_toxic_documents_go(spark, tmp_path):
    bad = [(1000 + i, f"you are a moron and some w{i} v{i % 7}", "s") for i in range(120)]
    good = [(2000 + i, f"you are a friend and some w{i} v{i % 7}", "s") for i in range(240)]
    where = root(spark, tmp_path, bad + good, [(i, 1, 1) for i, *_ in bad] + [(i, 1, 0) for i, *_ in good])
    left = ids(STAGES["toxicity"](spark, frame(spark, bad + good), where))
    assert left == [i for i, *_ in good]


def test_order_of_the_mixture_reaches_the_end(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = STAGES["source_mixing"](spark, docs, SF)
    order = [r.doc_id for r in mixed.collect()]
    # The encoding works the places out from the documents in any order they are read.
    out = STAGES["bpe_encoding"](spark, mixed.repartition(7, F.rand(3)), SF)
    by_place = [r.doc_id for r in out.orderBy("mix_slot", "mix_row").collect()]
    assert by_place == order


def test_run_on_the_smallest_tables(spark):
    out = pipeline.run(spark, SF)
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    kept = {r.doc_id for r in out.collect()}
    assert kept <= {i for i, _ in docs} and len(kept) > 0.5 * len(docs)
    groups = {}
    for i, t in docs:
        groups.setdefault(brute.lower(t), []).append(i)
    assert all(len(kept & set(g)) <= 1 for g in groups.values())


def test_tables_of_earlier_stages_are_deleted(spark, tmp_path, monkeypatch):
    where = root(spark, tmp_path, ROWS)
    seen = []

    class Watched(pipeline.Scratch):
        def write(self, df, name):
            out = super().write(df, name)
            seen.append(out.scratch_path)
            return out

    monkeypatch.setattr(pipeline, "Scratch", Watched)
    pipeline.run(spark, where)
    assert len(seen) == 5
    assert [os.path.exists(p.removeprefix("file:")) for p in seen] == [False] * 4 + [True]


@pytest.mark.parametrize("weights", [None, {"s0": 3, "s1": 1}, {"s9": 1}, {"s0": 0}])
def test_mixing_of_rows_without_identifier(spark, weights):
    from fiscalweave.llm import mixing

    rows = [(None, f"t{i}", "s0" if i % 2 else None) for i in range(500)] + ROWS
    out = mixing.mixed(frame(spark, rows), weights, block=4, bucket=50).collect()
    assert sorted(((r.doc_id, r.text, r.source) for r in out), key=repr) == sorted(rows, key=repr)
    assert len({(r.mix_slot, r.mix_row) for r in out}) == len(rows)
