"""Plain-Python versions of what the operators compute, for small inputs."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return _WORD.findall(text or "")


def sha(text):
    data = text if isinstance(text, bytes) else text.encode("utf-8")
    return hashlib.sha256(data).hexdigest()


def crc(value):
    return zlib.crc32(str(value).encode())


def exact(rows, best=max):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    return [(i, best(g), len(g), i == best(g), sha(lower(t)))
            for i, t in rows for g in (groups[lower(t)],)]


def repeats(rows, length):
    where = defaultdict(int)
    split = [(i, words(t)) for i, t in rows]
    for _, w in split:
        for s in range(len(w) - length + 1):
            where[tuple(w[s:s + length])] += 1
    out = []
    for i, w in split:
        kept = [True] * len(w)
        for s in range(len(w) - length + 1):
            if where[tuple(w[s:s + length])] > 1:
                kept[s:s + length] = [False] * length
        left = [x for x, k in zip(w, kept, strict=True) if k]
        out.append((i, len(w), len(w) - len(left), sha(" ".join(left))))
    return out


def shingles(text, k):
    w = words(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[s:s + k]) for s in range(max(1, len(w) - k + 1)))


def near(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    by = defaultdict(list)
    for n, (_, s) in enumerate(sets):
        for x in s:
            by[x].append(n)
    root = list(range(len(sets)))

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for n, (_, s) in enumerate(sets):
        common = Counter(m for x in s for m in by[x] if m < n)
        for m, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[m][1]) - c):
                root[find(n)] = find(m)
    least = defaultdict(lambda: 1 << 62)
    for n, (i, _) in enumerate(sets):
        least[find(n)] = min(least[find(n)], i)
    return [(i, len(s), least[find(n)], i == least[find(n)]) for n, (i, s) in enumerate(sets)]


def base_scores(rows, held):
    counts = Counter()
    streams = {}
    for i, t in rows:
        streams[i] = [*words(lower(t)), None]
        if not held(i):
            counts.update(streams[i])
    n, v = sum(counts.values()), len(counts)
    return {i: (held(i), len(s), sum(counts[x] > 0 for x in s), n,
                sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in s))
            for i, s in streams.items()}


def lm_scores(rows, held, base=1.5, weight=0.4):
    """log10 probabilities from exact counts, brought down or up to the levels of a log scale."""
    tokens, pairs, streams = Counter(), Counter(), {}
    for i, t in rows:
        streams[i] = [0, *words(lower(t)), None]  # 0 for what is before a text, None for its end
        if not held(i):
            tokens.update(streams[i])
            pairs.update(zip(streams[i], streams[i][1:]))
    total = sum(c for w, c in tokens.items() if w != 0) + sum(1 for w in tokens if w != 0) + 1
    steps = [0, *sorted({math.ceil(base ** k) for k in range(120)})]

    def level(c):
        return max(k for k in range(len(steps)) if steps[k] <= c)

    def chance(before, word):
        high = max(steps[level(tokens[before]) + 1] - 1, 1)
        pair, low = steps[level(pairs[before, word])], steps[level(tokens[word])]
        return min(1.0, weight * pair / high + (1 - weight) * (low + 1) / total)

    return {i: sum(math.log10(chance(a, b)) for a, b in zip(s, s[1:])) for i, s in streams.items()}


def shard(rows, shards):
    sized = sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
                   for i, t in rows)
    total, at, out, slot = sum(r[1] for r in sized), 0, [], Counter()
    for i, size, c in sized:
        s = min(shards - 1, (2 * at + size) * shards // (2 * total))
        out.append((i, size, c, "bytes", s, slot[s], None))
        slot[s] += 1
        at += size
    return out


def top(vectors, k, step):
    """Every row is a candidate of every other row, whatever their identifiers."""
    q = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors
         if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, v) in enumerate(q):
        if i % step == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j)
                          for m, (j, w) in enumerate(q) if m != n)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return out


def negatives(rows, positives=5, negatives_=3):
    """(anchor, positive, rank, negative, positive score, negative score) from all pairs of rows."""
    live = [(i, (m + 1) % 10 if i % 7 == 0 else m, [math.floor(256 * float(x)) for x in v])
            for i, v, m in rows if i is not None and m is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (a, mark, va) in enumerate(live):
        if a % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(va, v)), i, c == mark)
                  for k, (i, c, v) in enumerate(live) if k != n and len(v) == len(va)]
        for p, i, _ in sorted(s for s in scored if s[2])[:positives]:
            fit = sorted(s for s in scored if not s[2] and -50 * p <= -100 * s[0] <= -95 * p)
            out += [(a, i, r, j, -p, -q) for r, (q, j, _) in enumerate(fit[:negatives_], 1)]
    return out


def trie(rows, opening=True):
    """Nodes of the trie over (conv, turn, role, text), from every prefix of every conversation."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    plain = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    full = {}
    for c, ts in plain.items():
        h = crc(c) % 4 if opening else 0
        full[c] = plain.get(c - c % 20, [])[:h] + ts[h:]
    at, ends = {}, {}
    for c, ts in full.items():
        for d in range(len(ts) + 1):
            at.setdefault(tuple(ts[:d]), []).append(c)
        ends.setdefault(tuple(ts), []).append(c)
    kids = Counter(p[:-1] for p in at if p)
    leaves, saved = Counter(), Counter()
    for p, members in at.items():
        n_words = len(words(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(members) - 1) * n_words
    return [(min(m), len(p), min(at[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
             sha(",".join(map(str, sorted(ends.get(p, [])))))) for p, m in at.items()]


def archive(rows):
    """(page, payload bytes, payload digest, record type, refers to) of (page, html)."""
    first = {}
    for i, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, html in rows:
        data, best = (html or "").encode(), first.get(html or "")
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "response" if best == i else "revisit",
                    None if best == i else best))
    return out
