"""The registered queries on the driver's smallest tables, against plain-Python versions."""

import itertools

import brute
import duckdb
import public_tokenizers
import pytest
from conftest import SF
from tokenizers import Tokenizer

from fiscalweave.llm import queries

Q = queries.queries()


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


def got(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def auc(scored):
    """Share of (labelled, unlabelled) pairs that are in order; ties count half."""
    ranked = sorted(scored)
    bad, wins, seen = sum(y for _, y in ranked), 0.0, 0
    for value, group in itertools.groupby(ranked, key=lambda r: r[0]):
        group = [y for _, y in group]
        good = len(group) - sum(group)
        wins += sum(group) * (seen + good / 2)
        seen += good
    return wins / (bad * (len(scored) - bad))


def test_toxicity_finds_held_out_toxic_texts(spark):
    root = SF.replace("0.001", "0.1")  # 825 labelled rows are held out there
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{root}/labels.parquet'").fetchall())
    rows = Q["op1_toxicity"](spark, root).collect()
    assert all(r.held_out == (brute.crc(r.doc_id) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    for held in (True, False):
        known = [(r.score, labels[r.doc_id]) for r in rows
                 if r.doc_id in labels and r.held_out == held]
        caught = [s >= 0.5 for s, y in known if y]
        alone = [s < 0.5 for s, y in known if not y]
        assert len(caught) > 80 and auc(known) > 0.95
        assert sum(caught) / len(caught) > 0.8 and sum(alone) / len(alone) > 0.95


def test_mixing_covers_every_document_within_a_block(spark, docs):
    rows = Q["op2_source_mixing"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in docs)
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in rows)
    assert len({(r.mix_slot, r.mix_row) for r in rows}) == len(rows)
    assert len({(r.mix_slot, r.source, r.mix_block) for r in rows}) == len(
        {r.mix_slot for r in rows})


def test_lm_scores(spark, docs):
    want = brute.base_scores(docs, lambda i: brute.crc(i) % 7 == 2)
    rows = Q["op3_lm_scores"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        held, n, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-6 * n)
        assert r.score < 0
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_substring_dedup(spark, docs):
    cols = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert got(Q["op4_substring_dedup"](spark, SF), *cols) == sorted(brute.repeats(docs, 35))


def test_minhash(spark, docs):
    cols = ("doc_id", "n_shingles", "component_id", "kept")
    assert got(Q["op5_minhash"](spark, SF), *cols) == sorted(brute.near(docs, 3, 85))


def test_exact_dedup(spark, docs):
    cols = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got(Q["op6_exact_dedup"](spark, SF), *cols) == sorted(brute.exact(docs))


def test_sharding(spark, docs):
    cols = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    assert got(Q["op7_sharding"](spark, SF), *cols) == sorted(brute.shard(docs, 8))


def test_top_k(spark):
    vectors = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    cols = ("query_id", "rank", "vec_id", "score")
    assert got(Q["op8_top_k"](spark, SF), *cols) == sorted(brute.top(vectors, 10, 100))


def test_token_counts(spark, docs):
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = [(i, len((t or "").encode()), n, n > 1024) for i, t in docs
            for n in (len(known.encode(t or "", add_special_tokens=False).ids),)]
    assert got(Q["op9_token_counts"](spark, SF), "doc_id", "n_bytes", "n_tokens",
               "over_limit") == sorted(want)


def test_bpe(spark, docs):
    known = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, t in docs:
        ids = known.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), brute.sha(" ".join(map(str, ids))),
                     brute.sha(known.decode(ids, skip_special_tokens=False))))
    assert got(Q["op10_bpe"](spark, SF), "doc_id", "n_tokens", "ids_sha256",
               "decoded_sha256") == sorted(want)
