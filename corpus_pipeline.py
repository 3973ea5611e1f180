"""From raw documents to token ids: five stages, each on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fiscalweave.llm import bpe, exact_dedup, minhash, mixing, toxicity
from fiscalweave.llm.store import Scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5, by a model of the labelled documents of
    ``docs`` that are not held out.

    Null and empty texts have the score of a text without known terms and stay unless most of the
    labelled texts are toxic. Without labels, or with one kind of label, all documents have one
    score. Columns stay as they are; an empty table gives an empty one.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxic_rows_removed(docs, labels)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (A-Z lower-cased), that with the largest
    identifier. Null and empty texts are equal. Rows that repeat identifier and text all stay.
    Columns stay as they are; an empty table gives an empty one."""
    return exact_dedup.exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more, that
    with the smallest identifier. Texts without words are linked with nothing and stay, as do rows
    without identifier. Columns stay as they are; an empty table gives an empty one."""
    return minhash.near_dedup(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, sorted into the order that gives every source the same weight while it lasts.

    Read file by file, what is written of it is the mixture; the next stage gives the order as
    columns. A null source is a source of its own. Columns stay as they are; an empty table gives an
    empty one.
    """
    return mixing.in_mixed_order(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256, mix_slot, mix_row) of every document.

    Order by (mix_slot, mix_row) to read the mixture of the stage before: its schedule follows from
    the documents alone, so it is the same when it is worked out from what that stage kept. Null and
    empty texts have no tokens; other columns are left behind; an empty table gives an empty one.
    """
    encoded = bpe.bpe_ids_and_digests(mixing.mixed(docs), public_tokenizers.path("word_bpe_49k.json"),
                                      keep=("mix_slot", "mix_row"))
    return encoded.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256", "mix_slot",
                          "mix_row")


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("minhash_near_dedup", near_stage),
    ("source_mixing", mixing_stage),
    ("bpe_encoding", encoding_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``.

    Every stage is written and reread, and its table deleted once the next one is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch, before = Scratch(spark, "pipeline"), None
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
