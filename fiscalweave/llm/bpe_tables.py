"""Byte-pair vocabularies read from a tokenizer file, and the merge procedure they define."""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable


def byte_chars() -> dict[int, str]:
    """The printable stand-in for each byte in vocabulary files: printable Latin-1 bytes stand for
    themselves, the others for 256, 257, ... in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in own}
    rest = [b for b in range(256) if b not in table]
    return table | {b: chr(256 + i) for i, b in enumerate(rest)}


def load(path: str) -> dict:
    """{'vocab': token -> id, 'ranks': (left, right) -> rank, 'special': string -> id,
    'end': word-end suffix, 'steps': definitions of normaliser and pre-tokenizer} of a BPE
    tokenizer file; plain values only."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    return {"vocab": model["vocab"], "ranks": {p: i for i, p in enumerate(pairs)},
            "special": {t["content"]: t["id"] for t in spec["added_tokens"]},
            "end": model.get("end_of_word_suffix") or "",
            "steps": json.dumps([spec.get("normalizer"), spec.get("pre_tokenizer")])}


def steps_of(steps: str) -> tuple[Callable[[str], str], Callable[[str], list]]:
    """The normalisation and the pre-tokenization that a file defines, as its library does them."""
    from tokenizers import Tokenizer

    first, second = json.loads(steps)
    known = Tokenizer.from_str(json.dumps({
        "version": "1.0", "added_tokens": [], "normalizer": first, "pre_tokenizer": second,
        "post_processor": None, "decoder": None,
        "model": {"type": "BPE", "vocab": {}, "merges": []}}))
    return known.normalizer.normalize_str, known.pre_tokenizer.pre_tokenize_str


def splitter(steps: str) -> Callable[[str], list[str]]:
    """From a text to its pre-tokens, by the library."""
    normal, cut = steps_of(steps)

    def split(text: str) -> list[str]:
        text = normal(text)
        return [text[lo:hi] for _, (lo, hi) in cut(text)]

    return split


def merge(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The symbols after all merges: always the lowest rank, the leftmost place first.

    A heap over a linked list: n log n steps for a run of n symbols, however long.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    part = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, part[i], part[i + 1]) for i in range(n - 1)
            if (r := ranks.get((part[i], part[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if part[i] != left or j >= n or part[j] != right:
            continue  # one of the two has been merged since
        part[i], part[j] = left + right, ""
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((part[i], part[k]))) is not None:
                heapq.heappush(heap, (r, i, part[i], part[k]))
        if (h := before[i]) >= 0 and (r := ranks.get((part[h], part[i]))) is not None:
            heapq.heappush(heap, (r, h, part[h], part[i]))
    return [p for p in part if p]
