"""BPE encoding by dynamic programming over prefixes, and decoding.

The encoding of every prefix of a word ends in exactly one token. For each position the tokens that
end there are found by a suffix automaton of the vocabulary; the one that fits behind the last
token of the prefix before it is that last token. Following these back from the end of the word
gives the exact ids, without simulating the merges of the word.
"""

from __future__ import annotations

import functools
import hashlib
import re
import sys
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalweave.llm import bpe_tables

#: The splitting pattern of the vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words a task remembers before it starts anew; longer words are not remembered.
MEMO, MEMO_LENGTH = 200_000, 64
#: Bytes of text that are encoded at a time, unless a single text is longer.
PIECE = 1 << 20
_NEVER = 1 << 60


class Encoder:
    """Encodes words of a vocabulary whose last symbol carries a word-end suffix.

    Symbols are written as one character each: the stand-in of a byte, or that plus 512 for a byte
    with the suffix; so a token is a plain string and equals the concatenation of its symbols.
    """

    def __init__(self, tables: dict):
        self.end, self.ranks = tables["end"], {}
        char = bpe_tables.byte_chars()
        self.inner = {b: c for b, c in char.items()}
        self.final = {b: chr(ord(c) + 512) for b, c in char.items()}
        self.ids = {self._plain(t): i for t, i in tables["vocab"].items()}
        self.names = {i: t for t, i in tables["vocab"].items()}
        self.names.update({i: t for t, i in tables["special"].items()})
        # Where two merges give the same token, the earlier one comes first in every encoding.
        self.parts: dict[str, tuple[str, str, int]] = {}
        for (a, b), rank in tables["ranks"].items():
            left, right = self._plain(a), self._plain(b)
            self.ranks[left, right] = rank
            self.parts.setdefault(left + right, (left, right, rank))
        self.tails: dict[str, list] = {}
        self.heads: dict[str, list] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for token in self.ids:
            if self._reachable(token):
                self.automaton.add_word(token, token)
        self.automaton.make_automaton()

    def _plain(self, token: str) -> str:
        if self.end and token.endswith(self.end):
            token = token[:-len(self.end)]
            return token[:-1] + chr(ord(token[-1]) + 512)
        return token

    def _reachable(self, token: str) -> bool:
        """Whether the token is what its own symbols merge to."""
        if len(token) == 1:
            return True
        part = self.parts.get(token)
        return (part is not None and self._reachable(part[0]) and self._reachable(part[1])
                and self.compatible(part[0], part[1], part[2]))

    def _edge(self, token: str, side: int) -> list[tuple[str, int, int]]:
        """The symbols that stand at one edge of the token while it is being merged, each with
        the ranks between which it stands there."""
        cache = self.heads if side == 0 else self.tails
        found = cache.get(token)
        if found is None:
            found, gone = [], _NEVER
            while True:
                part = self.parts.get(token)
                made = -1 if part is None else part[2]
                found.append((token, made, gone))
                if part is None:
                    break
                token, gone = part[side], made
            cache[found[0][0]] = found
        return found

    def compatible(self, left: str, right: str, before: int = _NEVER) -> bool:
        """Whether no merge of a lower rank than ``before`` joins the two across their border.

        A pair of edge symbols merges at its rank if both stand there then. Of equal ranks the
        merge further left comes first: it takes the left symbol away, but not the right one.
        """
        for a, made_a, gone_a in self._edge(left, 1):
            for b, made_b, gone_b in self._edge(right, 0):
                rank = self.ranks.get((a, b))
                if (rank is not None and rank < before and made_a < rank < gone_a
                        and made_b < rank <= gone_b):
                    return False
        return True

    def word(self, word: str) -> list[int]:
        """The ids of one pre-token."""
        data = word.encode("utf-8")
        symbols = "".join([self.inner[b] for b in data[:-1]]) + self.final[data[-1]]
        last: list[str | None] = [None] * (len(symbols) + 1)
        for stop, token in self.automaton.iter(symbols):
            end = stop + 1
            if last[end] is not None:
                continue  # the last token of a prefix is unique
            start = end - len(token)
            if start == 0:
                last[end] = token
            elif (previous := last[start]) is not None:
                pair = previous, token
                fits = self.fits.get(pair)
                if fits is None:
                    if len(self.fits) >= MEMO:
                        self.fits.clear()
                    fits = self.fits[pair] = self.compatible(*pair)
                if fits:
                    last[end] = token
        ids, at = [], len(symbols)
        while at:
            token = last[at]
            if token is None:
                raise ValueError(f"no encoding of {word!r}")
            ids.append(self.ids[token])
            at -= len(token)
        return ids[::-1]


def normalise(text: str) -> str:
    """Composed form, then lower case letter by letter (a final sigma stays an inner one)."""
    text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()


@functools.cache
def unlike(steps: str) -> str:
    """A pattern for the characters that Python and the library of the tokenizer file may not treat
    alike: those that Python's tables do not know yet, and those they lower-case otherwise."""
    theirs = bpe_tables.steps_of(steps)[0]
    odd = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000
           and (unicodedata.category(chr(c)) == "Cn"
                or (not chr(c).isspace() and unicodedata.category(chr(c)) != "Co"
                    and theirs(chr(c)) != normalise(chr(c))))]
    cuts = [i for i in range(1, len(odd)) if odd[i] != odd[i - 1] + 1]
    spans = [(odd[i], odd[j - 1]) for i, j in zip([0, *cuts], [*cuts, len(odd)], strict=True)]
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans) + "]"


class Unlike:
    """Whether a text has a character of the pattern of ``unlike``: the class of a character is
    looked up once, and characters before the first one of the pattern not at all."""

    def __init__(self, pattern: str):
        first = int(pattern[3:11], 16)
        self.odd, self.known = re.compile(pattern).match, {}
        self.beyond = re.compile(f"[\\U{first:08x}-\\U0010ffff]").search

    def __call__(self, text: str) -> bool:
        at = None if text.isascii() else self.beyond(text)
        if at is None:
            return False
        for c in set(text[at.start():]):
            hit = self.known.get(c)
            if hit is None:
                hit = self.known[c] = self.odd(c) is not None
            if hit:
                return True
        return False


def encode_rows(docs: DataFrame, tokenizer: str, text_col: str, schema: T.StructType, result,
                keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every row and what ``result(id strings, token strings)`` gives.

    The two arguments are lists of strings, a string for each pre-token of the text, in which ids
    and tokens are parted by blanks.
    """
    tables = bpe_tables.load(tokenizer)
    tables["unlike"] = unlike(tables["steps"])
    sent = docs.sparkSession.sparkContext.broadcast(tables)  # bounded by the vocabulary
    names = [f.name for f in schema.fields][len(keep):]
    kinds = [f.dataType for f in schema.fields][len(keep):]

    def encode(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        encoder, special = Encoder(sent.value), sent.value["special"]
        words = regex.compile(PATTERN).findall
        odd, theirs = Unlike(sent.value["unlike"]), None
        cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        memo: dict[str, tuple[str, str, int]] = {}

        def known(word: str):
            got = memo.get(word)
            if got is None:
                ids = encoder.word(word)
                got = (" ".join(map(str, ids)), " ".join([encoder.names[i] for i in ids]),
                       len(ids))
                if len(word) <= MEMO_LENGTH:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[word] = got
            return got

        def split(part: str) -> list[str]:
            """The pre-tokens; by the tokenizer file's own steps where Python's tables differ."""
            nonlocal theirs
            if not odd(part):
                return words(normalise(part))
            theirs = theirs or bpe_tables.splitter(sent.value["steps"])
            return theirs(part)

        def row(text: str):
            got = []
            parts = cut.split(text) if cut is not None and "<|" in text else [text]
            for part in parts:
                if part in special:
                    got.append((str(special[part]), part, 1))
                elif part:
                    got += [memo.get(w) or known(w) for w in split(part)]
            return result([g[0] for g in got], [g[1] for g in got], sum([g[2] for g in got]))

        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(
                zero_copy_only=False), dtype=np.int64)
            lo = 0
            while lo < batch.num_rows:  # what a batch makes is far larger than its text
                done = ends[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, done + PIECE, "right")))
                some = batch.slice(lo, hi - lo)
                rows = [row(t or "") for t in map(pa.StringScalar.as_py, some.column(0))]
                made = [pa.array([r[i] for r in rows], to_arrow_type(k))
                        for i, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*some.columns[1:], *made], [*keep, *names])
                lo = hi

    return (docs.select(F.col(text_col).cast("string"), *[docs[c] for c in keep])
            .mapInArrow(encode, schema))


def bpe_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
                ) -> DataFrame:
    """One row per input row: (id, n_tokens, ids_sha256, decoded_sha256).

    Texts are encoded whole, without begin or end tokens; special strings inside become their own
    token. Decoding puts one blank between tokens and leaves none out, as a tokenizer without a
    decoder does. Null and empty texts have no tokens. Repeated rows give repeated rows, an empty
    table none; other columns are not looked at.
    """
    def digest(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8")).hexdigest()

    def result(ids, tokens, n):
        return n, digest(" ".join(ids)), digest(" ".join(tokens))

    schema = T.StructType([docs.schema[id_col], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])
    return encode_rows(docs, tokenizer, text_col, schema, result, [id_col])


def bpe_ids_and_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id",
                        text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """What ``bpe_digests`` gives, the ``keep`` columns, and the ids themselves as array<int>."""
    made = bpe_encoded(docs, tokenizer, id_col, text_col, keep)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return made.select(id_col, *keep, "n_tokens", "ids", F.sha2(joined, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def bpe_encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, the ``keep`` columns, n_tokens long, ids array<int>, decoded string) of every row."""
    def result(ids, tokens, n):
        return n, [int(i) for part in ids for i in part.split(" ")], " ".join(tokens)

    kept = [id_col, *keep]
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.StringType())])
    return encode_rows(docs, tokenizer, text_col, schema, result, kept)
