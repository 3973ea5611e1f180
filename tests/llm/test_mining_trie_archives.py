"""Hard negatives, the conversation trie and archives against plain Python, with odd inputs."""

import gzip
import io
import os
import random
import zlib

import brute
import compare
import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from fiscalweave.llm import hard_negatives, prefix_trie, queries, warc
from fiscalweave.llm.store import Scratch

Q, SQL = queries.queries(), queries.oracle_sql()


def got(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def same(df, cols, want):
    assert got(df, *cols) == sorted(want, key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    assert compare.differences(Q[name](spark, SF), compare.connect(SF), SQL[name]) == []


# -- hard negatives ------------------------------------------------------------------------------

NEGATIVES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
VECTORS = "vec_id long, embedding array<float>, label int, id int, home string, part string, score int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, m, None, None, None, None) for i, v, m in rows], VECTORS)


def mined(df):
    i, m = F.col("vec_id"), F.col("label")
    return hard_negatives.hard_negatives(
        df, i % 50 == 0, F.when(i % 7 == 0, (m + 1) % 10).otherwise(m))


def drawn(n, labels, width=12, seed=5):
    rnd = random.Random(seed)
    return [(i, [rnd.gauss(0.2, 0.4) for _ in range(width)], rnd.choice(labels)) for i in range(n)]


def test_subset_sums_give_inner_products():
    rnd = np.random.default_rng(3)
    for width, most in ((1, 1), (8, 200), (13, 5_000), (64, 1 << 20), (9, 1 << 27)):
        a, c = (rnd.integers(-most, most + 1, (n, width)) for n in (7, 1500))
        found = hard_negatives.scores(hard_negatives.subset_sums(a), hard_negatives.bit_planes(c))
        assert (found == a @ c.T).all()


def test_hard_negatives(spark, monkeypatch):
    rows = drawn(400, [0, 1, 2, 3])
    rows += [(i, rows[100][1], 2) for i in range(400, 560)]            # one vector, many times
    rows += [(600, None, 1), (601, [0.1, None], 1), (602, [float("nan")] * 12, 1), (650, rows[3][1], None),
             (None, rows[3][1], 1), (700, [float("inf")] * 12, 2), (750, [0.5, 0.5], 1),
             (751, [0.25, 0.25], 2), (752, [0.5, 0.4], 1), (800, [], 1), (801, [], 2)]
    want = brute.negatives(rows)
    same(mined(vectors(spark, rows)), NEGATIVES, want)
    # Many shards, blocks and labels give the same as one.
    for name, value in (("SHARD", 32), ("BLOCK", 3), ("CROWD", 2), ("CHUNK", 7)):
        monkeypatch.setattr(hard_negatives, name, value)
    same(mined(vectors(spark, rows)), NEGATIVES, want)
    monkeypatch.setattr(hard_negatives, "HOMES", 2)
    same(mined(vectors(spark, rows)), NEGATIVES, want)


def test_hard_negatives_of_repeated_ids_and_nothing(spark):
    rows = drawn(60, [0, 1], 5) + [(50, [0.3] * 5, 0), (50, [0.2] * 5, 1), (50, [0.3] * 5, 0)]
    same(mined(vectors(spark, rows)), NEGATIVES, brute.negatives(rows))
    assert mined(vectors(spark, [])).collect() == []
    assert mined(vectors(spark, [(1, [1.0], 1)])).collect() == []
    assert mined(vectors(spark, [(50, [1.0], 1)])).collect() == []


# -- trie ----------------------------------------------------------------------------------------

NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256")


def turns(spark, rows):
    return spark.createDataFrame(
        [(*r, None, None) for r in rows],
        "conv_id long, turn int, role string, text string, path string, words int")


def grown(df, limit=prefix_trie.LIMIT, opening=True):
    conv = F.col("conv")
    how = {"base": conv - conv % 20, "taken": (F.crc32(conv.cast("string").cast("binary")) % 4)
           .cast("int")} if opening else {}
    return prefix_trie.conversation_trie(df, limit=limit, **how)


def talks(n, depth, words, seed):
    rnd = random.Random(seed)
    return [(c, t, rnd.choice(["user", "bot"]) if t % 2 else "user", rnd.choice(words))
            for c in range(n) for t in range(rnd.randint(1, depth))]


@pytest.mark.parametrize("limit", [prefix_trie.LIMIT, 40, 1, 0])
def test_trie(spark, limit):
    rows = talks(150, 9, ["a b", "c", "", "d e f"], 1)
    for opening in (True, False):
        same(grown(turns(spark, rows), limit, opening), NODE, brute.trie(rows, opening))


def test_trie_of_odd_conversations(spark):
    long = [(300 + c, t, "user", "same words here") for c in range(4) for t in range(60 + 5 * c)]
    rows = [(0, 1, None, None), (0, None, "user", "first"), (0, 1, "", ""), (20, 2, "u", "x" * 5000),
            (20, 2, "u", "x" * 5000 + "y"), (20, 2, "u", "x" * 5000), (None, 1, "u", "lost"),
            (41, 1, "user", "alone"), (43, 1, "user", "alone"), *long,
            *[(500 + c, t, "user", f"t{t}") for c in range(120) for t in range(3)]]
    for limit in (prefix_trie.LIMIT, 5):
        same(grown(turns(spark, rows), limit), NODE, brute.trie(rows))
    assert grown(turns(spark, [])).collect() == []
    assert grown(turns(spark, [(None, 1, "u", "x")])).collect() == []
    # Conversation 41 takes more turns than its absent base has, and has no more of its own.
    taken = 1 if brute.crc(41) % 4 else 0
    bare = grown(turns(spark, [(41, 1, "u", "x")])).collect()
    assert len(bare) == 2 - taken and bare[0].n_leaves == 1


# -- archives ------------------------------------------------------------------------------------

PAGE = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def pages(spark, rows):
    return spark.createDataFrame(
        [(i, u, h, None, None) for i, u, h in rows],
        "page_id long, url string, html string, mark string, page string")


def odd_pages():
    rnd = random.Random(8)
    noise = "".join(chr(rnd.randrange(0x21, 0x2FFF)) for _ in range(200_000))
    rows = [(i, f"http://h/{i}", f"<p>{i % 37}</p>" * (i % 90)) for i in range(400)]
    return rows + [(500, None, None), (501, "", ""), (502, "http://x/\r\nX: y", "é" * 70_000),
                   (503, "http://ü/ ü", noise), (504, "u", noise), (None, "u", noise),
                   (None, "u", "only"), (None, "u", "only"), (7, "u", "again"), (7, "u", "again"),
                   (505, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n")]


def test_archives(spark):
    rows = odd_pages()
    want = brute.archive([(i, h) for i, _, h in rows])
    same(warc.archived(pages(spark, rows)), PAGE, want)
    # Ranges far smaller than a record: every record is read once, by the range it begins in.
    same(warc.archived(pages(spark, rows), split=1000), PAGE, want)
    assert warc.archived(pages(spark, [])).collect() == []
    texts = {r.page_id: r.payload for r in warc.archived(pages(spark, rows)).collect()
             if r.record_type == "response" and r.page_id is not None}
    html = {i: (h or "").encode() for i, _, h in rows}
    assert texts and all(html[i] == payload for i, payload in texts.items())


def test_small_payloads_are_responses(spark):
    rows = [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "long enough"), (4, "u", "long enough")]
    found = got(warc.archived(pages(spark, rows), least=5), "page_id", "record_type", "refers_to")
    assert found == [(1, "response", None), (2, "response", None), (3, "response", None),
                     (4, "revisit", 3)]


def test_hot_payload(spark):
    rows = [(i, "u", "copy" if i % 3 else f"page {i}") for i in range(3_000)]
    same(warc.archived(pages(spark, rows)), PAGE, brute.archive([(i, h) for i, _, h in rows]))


def test_archives_are_gzip_members_any_reader_knows(spark, tmp_path):
    files = warc.write_archives(
        spark.createDataFrame([(1, "http://a", bytearray(b"x" * 9), None),
                               (2, "http://b", bytearray(b"x" * 9), 1)],
                              "page long, url string, payload binary, refers_to long"),
        str(tmp_path / "w"), Scratch(spark, "test"), size=1)
    assert files.agg(F.sum("records")).first()[0] == 2
    listed = warc.archives_in(spark, str(tmp_path / "w"))
    assert got(warc.read_archives(listed), "record_id") == [("urn:page:1",), ("urn:page:2",)]
    text = b"".join(gzip.open(tmp_path / "w" / f).read() for f in sorted(os.listdir(tmp_path / "w"))
                    if f.endswith(".gz"))
    assert text.count(b"WARC-Type: response") == 1 and text.count(b"WARC-Refers-To: <urn:page:1>") == 1


def test_reader_takes_only_whole_records():
    made = [warc.record(i, f"http://{i}", os.urandom(3000 * (i % 5)), None, "d") for i in range(40)]
    data = b"junk" + b"".join(made) + b"\x1f\x8b\x08tail"
    for split in (1, 2, 3, 701, 4096, len(data)):
        seen = []
        for start in range(0, len(data), split):
            source = warc.Ranges(io.BytesIO(data), len(data), window=512)
            seen += [f["warc-record-id"] for _, f, _ in
                     warc.records(source, start, min(start + split, len(data)))]
        assert seen == [f"<urn:page:{i}>" for i in range(40)]
    # A member that is no record, one whose header breaks off, and broken data of a real record.
    plain = zlib.compressobj(6, zlib.DEFLATED, 31)
    other = plain.compress(b"WARC/1.1\r\nno fields\r\n\r\n") + plain.flush()
    source = warc.Ranges(io.BytesIO(other + made[1]), len(other) + len(made[1]))
    assert [at for at, _, _ in warc.records(source, 0, source.size)] == [len(other)]
    cut = made[4][:-20]
    with pytest.raises(ValueError):
        list(warc.records(warc.Ranges(io.BytesIO(cut), len(cut)), 0, len(cut)))
