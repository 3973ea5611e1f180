"""Toxicity by a factorisation machine over hashed terms.

A linear model adds up what single words say. The factorisation machine also learns a small vector
per term; the product of two vectors is the weight of both terms in one text, so an insult beside
the mention of a group can count for more than the two apart. Terms are whole words and the
beginnings of words, so that forms of a word that were never seen share what is known of its stem.

Almost all terms of a language say nothing about the label, and a model that may give each of them
a weight learns its rows by heart. So a term takes part only if its share of labelled texts departs
from the average by more than chance would have it; how much more, how strongly weights are held
back, when to stop and where to cut are settled on rows that the model in question has not seen.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalweave.llm import textbytes as tb
from fiscalweave.llm.store import Scratch, free_name


@dataclass(frozen=True)
class Settings:
    """``max_rows`` bounds the labelled sample, a fair draw by a hash of the identifier; only the
    numbers of the terms that take part reach the driver, never a text.

    ``beginnings`` are the lengths in bytes of the word beginnings that are terms. Terms that fewer
    than ``min_docs`` sampled texts use take no part. ``departures`` (in standard deviations) and
    ``l2`` are what the inner folds choose from, ``epochs`` is the most that they may ask for.
    ``least_clean`` is the share of unlabelled texts that the cut at 0.5 has to leave alone.
    """

    bits: int = 20
    factors: int = 4
    max_rows: int = 20_000
    min_docs: int = 10
    beginnings: tuple[int, ...] = (4, 5, 6, 7, 8)
    departures: tuple[float, ...] = (3.0, 4.5, 6.0)
    l2: tuple[float, ...] = (1e-5, 1e-4, 1e-3)
    folds: int = 3
    epochs: int = 12
    batch: int = 256
    rate: float = 0.1
    least_clean: float = 0.96
    seed: int = 11


#: Bytes of text whose terms are looked up at a time, unless a single text is longer.
BLOCK = 1 << 19

# Letters and digits, and all bytes of other scripts, make up terms; the rest parts them.
_TERM = np.zeros(256, dtype=np.uint8) + 0x20
_TERM[0x80:] = np.arange(0x80, 0x100)
_TERM[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = [*range(0x30, 0x3A), *range(0x61, 0x7B)]
_TERM[0x41:0x5B] = np.arange(0x61, 0x7B)


def term_slots(column: pa.Array, s: Settings, known: np.ndarray | None = None):
    """(rows, text numbers, slots) per block: the distinct hashed terms of every whole text.

    With ``known``, an array over all slots, terms are numbered by it and those below 0 left out.
    """
    data, offs = tb.string_bytes(column)
    n, lo = len(offs) - 1, 0
    shift = np.uint64(64 - s.bits)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + BLOCK, "right")) - 1)
        block = tb.Block(_TERM[data[offs[lo]:offs[hi]]], offs[lo:hi + 1] - offs[lo],
                         slice(lo, hi), False)
        texts, starts, ends = block.text_of_word(), block.starts, block.ends
        keys = []
        for length in (None, *s.beginnings):
            longer = slice(None) if length is None else ends - starts > length
            begin = starts[longer]
            end = ends if length is None else begin + length
            found = (tb.span_hashes(block.data, begin, end) >> shift).astype(np.int64)
            owner = texts[longer]
            if known is not None:
                found = known[found].astype(np.int64)
                owner, found = owner[found >= 0], found[found >= 0]
            keys.append((owner << s.bits) | found)
        keys = np.unique(np.concatenate(keys))
        yield block.rows, keys >> s.bits, keys & ((1 << s.bits) - 1)
        lo = hi


# -- the model -----------------------------------------------------------------------------------


class Rows:
    """Texts as one flat array of term numbers with offsets."""

    def __init__(self, flat: np.ndarray, offsets: np.ndarray):
        self.flat, self.offsets = flat, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def take(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(owner, term) of the picked texts."""
        lo, sizes = self.offsets[pick], self.offsets[pick + 1] - self.offsets[pick]
        owner = np.repeat(np.arange(len(pick)), sizes)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return owner, self.flat[np.repeat(lo, sizes) + at]


def margins(model, texts: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
    """bias + sum of weights + sum over pairs of <v_i, v_j>, for n texts."""
    bias, weight, vector = model
    out = np.bincount(texts, weight[terms], n) + bias
    for f in range(vector.shape[1]):
        v = vector[terms, f]
        out += 0.5 * (np.bincount(texts, v, n) ** 2 - np.bincount(texts, v * v, n))
    return out


def balanced_loss(z: np.ndarray, labels: np.ndarray) -> float:
    """Logistic loss in which both classes weigh the same."""
    loss = np.logaddexp(0, np.where(labels == 1, -z, z))
    return float(loss[labels == 1].mean() + loss[labels == 0].mean())


def fit(rows: Rows, labels: np.ndarray, pick: np.ndarray, used: np.ndarray, l2: float, s: Settings,
        epochs: int, check: np.ndarray | None = None):
    """(model, best number of epochs, its loss): logistic loss, mini-batches, AdaGrad.

    Learns from the texts ``pick`` with the terms ``used``; both classes weigh the same. With
    ``check``, the model of the epoch that does best on those texts is returned.
    """
    rng = np.random.default_rng(s.seed)
    m = len(used)
    weight, vector = np.zeros(m), np.zeros((m, s.factors))
    if not used.any():  # nothing but the balance of the classes
        model = (0.0, weight, vector)
        return model, 0, balanced_loss(np.zeros(len(pick)), labels[pick])
    vector[used] = rng.normal(0, 0.05, (int(used.sum()), s.factors))
    bias, gb, gw, gv = 0.0, 1e-8, np.full(m, 1e-8), np.full((m, s.factors), 1e-8)
    share = labels[pick].mean()
    best = (None, 0, np.inf)
    for epoch in range(1, epochs + 1):
        order = rng.permutation(pick)
        for i in range(0, len(order), s.batch):
            some = order[i:i + s.batch]
            n = len(some)
            owner, terms = rows.take(some)
            keep = used[terms]
            owner, terms = owner[keep], terms[keep]
            v = vector[terms]
            sums = np.stack([np.bincount(owner, v[:, f], n) for f in range(s.factors)], 1)
            pairs = 0.5 * (sums ** 2).sum(1) - 0.5 * np.bincount(owner, (v * v).sum(1), n)
            z = np.clip(bias + np.bincount(owner, weight[terms], n) + pairs, -30, 30)
            cost = np.where(labels[some] == 1, 0.5 / share, 0.5 / (1 - share))
            g = (1 / (1 + np.exp(-z)) - labels[some]) * cost / n
            at, where = np.unique(terms, return_inverse=True)
            dw = np.bincount(where, g[owner], len(at)) + l2 * weight[at]
            per = g[owner][:, None] * (sums[owner] - v)
            dv = np.stack([np.bincount(where, per[:, f], len(at)) for f in range(s.factors)], 1)
            dv += l2 * vector[at]
            gb += g.sum() ** 2
            bias -= s.rate * g.sum() / np.sqrt(gb)
            gw[at] += dw ** 2
            weight[at] -= s.rate * dw / np.sqrt(gw[at])
            gv[at] += dv ** 2
            vector[at] -= 0.5 * s.rate * dv / np.sqrt(gv[at])
        if check is not None:
            now = (bias, np.where(used, weight, 0), np.where(used[:, None], vector, 0))
            loss = balanced_loss(margins(now, *rows.take(check), len(check)), labels[check])
            if loss < best[2]:
                best = (now, epoch, loss)
    if check is not None:
        return best
    return (bias, np.where(used, weight, 0), np.where(used[:, None], vector, 0)), epochs, np.nan


def departure(n: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    """How many standard deviations the labelled texts of a term are from their expected number."""
    return np.abs(toxic - n * share) / np.sqrt(np.maximum(n * share * (1 - share), 1e-12))


def balanced_cut(z: np.ndarray, labels: np.ndarray, least_clean: float) -> float:
    """The margin that parts the classes best, of those that leave enough of the others alone."""
    order = np.argsort(z, kind="stable")
    z, y = z[order], labels[order]
    caught = 1 - np.cumsum(y) / y.sum()          # texts up to i are below a cut after i
    alone = np.cumsum(1 - y) / (1 - y).sum()
    worth = np.where(alone >= least_clean, caught + alone, -1)
    worth[:-1][z[1:] == z[:-1]] = -1             # no cut between equal margins
    i = int(worth.argmax())
    return float(z[i] + 1e-9 if i == len(z) - 1 else (z[i] + z[i + 1]) / 2)


def learn(rows: Rows, labels: np.ndarray, fold: np.ndarray, n: np.ndarray, toxic: np.ndarray,
          s: Settings):
    """The model of all rows, with what the inner folds say is best.

    ``n`` and ``toxic`` are texts and labelled texts per (fold, term). A fold is judged by models
    whose terms were chosen without it, as the choice itself can learn rows by heart.
    """
    everyone = np.arange(len(labels))
    least = min(s.min_docs, max(1, len(labels) // 20))

    def terms(without: int | None, bar: float) -> np.ndarray:
        keep = [f for f in range(s.folds) if f != without]
        share = labels[np.isin(fold, keep)].mean()
        return ((n[keep].sum(0) >= least)
                & (departure(n[keep].sum(0), toxic[keep].sum(0), share) >= bar))

    splits = [(np.flatnonzero(fold != f), np.flatnonzero(fold == f)) for f in range(s.folds)]
    if any(len(set(labels[part])) < 2 for split in splits for part in split):
        model, _, _ = fit(rows, labels, everyone, terms(None, s.departures[0]), s.l2[-1], s, s.epochs)
        return model
    inner, outer = splits[0]
    bar, l2, epochs = min(
        ((loss, bar, l2, epochs) for bar in s.departures for l2 in s.l2
         for _, epochs, loss in [fit(rows, labels, inner, terms(0, bar), l2, s, s.epochs, outer)]),
        key=lambda c: c[0])[1:]
    unseen = np.zeros(len(labels))
    for f, (inner, outer) in enumerate(splits):
        model, _, _ = fit(rows, labels, inner, terms(f, bar), l2, s, epochs)
        unseen[outer] = margins(model, *rows.take(outer), len(outer))
    bias, weight, vector = fit(rows, labels, everyone, terms(None, bar), l2, s, epochs)[0]
    return bias - balanced_cut(unseen, labels, s.least_clean), weight, vector


# -- tables --------------------------------------------------------------------------------------

_PARTS = 64


def term_table(sample: DataFrame, s: Settings) -> DataFrame:
    """(slot, n array, toxic array): per inner fold the texts and labelled texts of each term that
    any set of folds finds to depart from the average.

    Every task counts its texts into arrays over all slots; the arrays are added up by ranges of
    slots. What is shuffled depends on ``bits`` and the tasks of the bounded sample alone.
    """
    dims, step = 1 << s.bits, (1 << s.bits) // _PARTS

    def count(batches):
        got = np.zeros((s.folds, 2, dims), np.uint32)
        rows = np.zeros((s.folds, 2), np.int64)
        for batch in batches:
            label = np.array(batch.column("label"), dtype=np.int64)
            fold = np.array(batch.column("fold"), dtype=np.int64)
            np.add.at(rows, (fold, label), 1)
            for at, texts, slots in term_slots(batch.column("text"), s):
                which = (fold[at] * 2 + label[at])[texts]
                for w in np.unique(which):
                    got.reshape(-1, dims)[w] += np.bincount(slots[which == w],
                                                            minlength=dims).astype(np.uint32)
        yield pa.record_batch([
            pa.array(range(_PARTS), pa.int32()),
            pa.array([got[:, :, i * step:(i + 1) * step].tobytes() for i in range(_PARTS)]),
            pa.array([rows.tobytes()] * _PARTS)], ["part", "counts", "rows"])

    def screen(key, table):
        total = sum(np.frombuffer(x, np.int64) for x in table.column("rows").to_pylist())
        total = total.reshape(s.folds, 2)
        counts = sum(np.frombuffer(x, np.uint32).astype(np.int64)
                     for x in table.column("counts").to_pylist()).reshape(s.folds, 2, step)
        n, toxic = counts.sum(1), counts[:, 1]
        bar, keep = min(s.departures), np.zeros(step, bool)
        for without in (None, *range(s.folds)):
            in_ = [f for f in range(s.folds) if f != without]
            share = total[in_, 1].sum() / max(1, total[in_].sum())
            keep |= (n[in_].sum(0) > 0) & (departure(n[in_].sum(0), toxic[in_].sum(0), share) >= bar)
        keep &= n.sum(0) >= min(s.min_docs, max(1, int(total.sum()) // 20))
        at = np.flatnonzero(keep)
        return pa.table({"slot": pa.array(key[0].as_py() * step + at, pa.int32()),
                         "n": pa.array(list(n[:, at].T), pa.list_(pa.int64())),
                         "toxic": pa.array(list(toxic[:, at].T), pa.list_(pa.int64()))})

    return (sample.mapInArrow(count, "part int, counts binary, rows binary").groupBy("part")
            .applyInArrow(screen, "slot int, n array<long>, toxic array<long>"))


def train(labelled: DataFrame, id_col: str, text_col: str, label_col: str,
          settings: Settings = Settings()):
    """(bias, slots, weights, vectors) of a labelled frame. Rows without identifier or label are
    left out; one class alone, or no row, gives a model without terms.

    The sample's texts are written once. The driver gets the table of the terms that depart from
    the average and, per text, the numbers of those terms: a few dozen integers.
    """
    s, scratch = settings, Scratch(labelled.sparkSession, "toxicity")
    rows = labelled.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    order = F.xxhash64(F.col(id_col), F.col(text_col), F.col(label_col))
    sample = scratch.write(rows.select(
        F.col(text_col).cast("string").alias("text"), (F.col(label_col) > 0).cast("int").alias("label"),
        F.pmod(F.xxhash64(F.col(id_col), F.lit(s.seed + 1)), F.lit(s.folds)).cast("int").alias("fold"),
        order.alias("order")).repartition(8), "sample")
    found = term_table(sample, s).toArrow()
    found = found.take(pa.compute.sort_indices(found.column("slot")))
    slots = np.array(found.column("slot"), dtype=np.int64)
    n, toxic = (np.array(found.column(c).combine_chunks().flatten(), dtype=np.int64)
                .reshape(-1, s.folds).T for c in ("n", "toxic"))

    def numbers(batches):
        known = np.full(1 << s.bits, -1, np.int32)
        known[slots] = np.arange(len(slots))
        for batch in batches:
            out = [b""] * batch.num_rows
            for at, texts, terms in term_slots(batch.column("text"), s, known):
                cuts = np.searchsorted(texts, np.arange(at.stop - at.start + 1))
                for i in range(at.stop - at.start):
                    out[at.start + i] = terms[cuts[i]:cuts[i + 1]].astype(np.int32).tobytes()
            yield pa.record_batch([pa.array(out, pa.binary()), batch.column("label"),
                                   batch.column("fold"), batch.column("order")],
                                  ["terms", "label", "fold", "order"])

    got = sample.mapInArrow(numbers, "terms binary, label int, fold int, order long").toArrow()
    scratch.drop(sample)
    got = got.take(pa.compute.sort_indices(got, [("order", "ascending"), ("label", "ascending")]))
    labels = np.array(got.column("label"), dtype=float)
    if len(set(labels)) < 2:
        rate = (labels.sum() + 0.5) / (len(labels) + 1.0)
        return (np.log(rate / (1 - rate)), slots[:0], np.zeros(0, np.float32),
                np.zeros((0, s.factors), np.float32))
    texts = got.column("terms").to_pylist()
    sizes = np.array([len(t) // 4 for t in texts], dtype=np.int64)
    flat = Rows(np.frombuffer(b"".join(texts), np.int32).astype(np.int64),
                np.concatenate([[0], np.cumsum(sizes)]))
    fold = np.array(got.column("fold"), dtype=np.int64)
    bias, weight, vector = learn(flat, labels, fold, n, toxic, s)
    used = (weight != 0) | (vector != 0).any(1)
    return bias, slots[used], weight[used].astype(np.float32), vector[used].astype(np.float32)


def drawn(labels: DataFrame, id_col: str, s: Settings) -> DataFrame:
    """About ``max_rows`` of the label rows, or all if there are no more: a fair draw that any
    rerun repeats."""
    total = labels.count()
    if total <= s.max_rows:
        return labels
    share = int(s.max_rows / total * 2 ** 31)
    return labels.filter(
        F.pmod(F.xxhash64(F.col(id_col), F.lit(s.seed)), F.lit(2 ** 31)) < share)


def score(docs: DataFrame, model, text_col: str, out_col: str, settings: Settings = Settings()
          ) -> DataFrame:
    """All columns of ``docs`` and the probability of the label in ``out_col`` (double).

    Null and empty texts get the probability of a text without known terms. Every term of a text
    counts, however long the text is.
    """
    s, k = settings, docs.columns.index(text_col)
    bias, slots, weight, vector = model  # as many numbers as terms take part, some thousands

    def scored(batches):
        known = np.full(1 << s.bits, -1, np.int32)
        known[slots] = np.arange(len(slots))
        for batch in batches:
            z = np.zeros(batch.num_rows)
            for at, texts, terms in term_slots(batch.column(k), s, known):
                z[at] = margins((bias, weight, vector), texts, terms, at.stop - at.start)
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)],
                                             [*batch.schema.names, out_col])

    schema = T.StructType([*docs.schema.fields, T.StructField(out_col, T.DoubleType(), False)])
    return docs.mapInArrow(scored, schema)


def held_out(id_col: Column, folds: int = 5) -> Column:
    """Whether a row is kept from learning: crc32 of the identifier as text, by its remainder."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds)) == 0,
                      F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", score_col: str = "score", train_docs: DataFrame | None = None,
             settings: Settings = Settings()) -> DataFrame:
    """``docs`` with ``score_col``, from a model of the labelled rows that are not held out.

    ``train_docs`` has the labelled texts where ``docs`` is already filtered. A document with
    several labels counts once per label row; without any label all scores are the same. An empty
    table gives no rows; a clash of ``score_col`` with a column of ``docs`` is an error.
    """
    if score_col.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"documents already have a column {score_col}")
    source = (train_docs if train_docs is not None else docs)
    source = source.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    marks = marks.filter(F.col("label").isNotNull() & F.col("id").isNotNull()
                         & ~held_out(F.col("id")))
    # The draw is bounded, so the labels go to the texts and not the other way round.
    known = source.join(F.broadcast(drawn(marks, "id", settings)), "id")
    model = train(known, "id", "text", "label", settings)
    return score(docs, model, text_col, score_col, settings)


def toxic_rows_removed(docs: DataFrame, labels: DataFrame, threshold: float = 0.5,
                       **options) -> DataFrame:
    """The documents scored below ``threshold``, with their own columns."""
    name = free_name(docs, "toxicity_score")
    return toxicity(docs, labels, score_col=name, **options).filter(
        F.col(name) < threshold).select(*docs.columns)
