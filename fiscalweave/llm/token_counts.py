"""Token counts of a byte-level BPE vocabulary by the whole-token shortcut.

Most pieces that the splitting pattern finds are themselves vocabulary entries. For each entry it
is proved beforehand, by running the merges, whether it encodes alone as one token. A piece among
the proved ones counts as one and needs no merging; only the rest is merged.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalweave.llm import bpe_tables, textbytes

#: The splitting pattern of the vocabulary (fixed value).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Merged pieces a task remembers before it starts anew; longer pieces are not remembered.
MEMO, MEMO_LENGTH = 200_000, 64


def proved_single(tables: dict) -> frozenset[str]:
    """The texts of the vocabulary entries that alone encode as exactly that one token."""
    back = {c: b for b, c in bpe_tables.byte_chars().items()}
    single = set()
    for token in tables["vocab"]:
        try:
            text = bytes(back[c] for c in token).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue  # part of a character: never a piece of its own
        if bpe_tables.merge(list(token), tables["ranks"]) == [token]:
            single.add(text)
    return frozenset(single)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: (id, n_bytes, n_tokens, over_limit) for the tokenizer file.

    Special strings inside a text count as their one token, as the library does by default. Null
    and empty texts have no bytes and no tokens. Texts of any length are counted whole; a piece
    without breaks is merged in n log n steps. Repeated rows give repeated rows, an empty table
    gives none, and other columns are not looked at.
    """
    tables = bpe_tables.load(tokenizer)
    sent = docs.sparkSession.sparkContext.broadcast(  # bounded by the vocabulary
        {"single": proved_single(tables), "ranks": tables["ranks"],
         "special": list(tables["special"])})

    def count(batches):
        single, ranks = sent.value["single"], sent.value["ranks"]
        char = bpe_tables.byte_chars()
        pieces = regex.compile(PATTERN).findall
        special = sent.value["special"]
        cut = regex.compile("|".join(map(regex.escape, special))) if special else None
        memo: dict[str, int] = {}

        def merged(piece: str) -> int:
            n = memo.get(piece)
            if n is None:
                n = len(bpe_tables.merge([char[b] for b in piece.encode("utf-8")], ranks))
                if len(piece) <= MEMO_LENGTH:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[piece] = n
            return n

        def tokens(text: str) -> int:
            if cut is not None and "<" in text:
                parts = cut.split(text)
                if len(parts) > 1:
                    return len(parts) - 1 + sum(map(tokens, filter(None, parts)))
            found = Counter(pieces(text))
            total = sum(found.values())
            for piece in found.keys() - single:
                total += found[piece] * (merged(piece) - 1)
            return total

        for batch in batches:
            _, offsets = textbytes.string_bytes(batch.column(1))
            n = [tokens(t) if t else 0 for t in map(pa.StringScalar.as_py, batch.column(1))]
            n = np.array(n, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)],
                [id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("over_limit", T.BooleanType())])
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(count, schema)
