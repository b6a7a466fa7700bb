"""P8: the subjects that each document is about - none, one or several.

Which words speak for a subject is learned from the documents that raters labelled and
carried on to all documents: a sentence counts for the subject its words speak for, and a
word's weight follows from the other sentences of the documents that use it. How far the
frame of a sentence can be trusted (a passing comparison cannot) is learned alike, from how
often such sentences agree with the rest of their document. Over these term, structure and
source features a classifier chain is trained, a classifier for each subject that sees the
subjects before it and how often they go together; its calibrated probabilities are decoded
by beam search over whole combinations of labels.

Texts are read once. What is kept of them are the numbers of their words and of the pairs of
neighbouring words, sentence by sentence; every round is array arithmetic over these.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle, small_side
from .glyphs import unify_arrow

ROUNDS = 3
PURE = 0.45  # how far from the subject's prior share towards 1 the share of a word's documents must be
SHARE = 1e-6  # of all word uses; so a million words at most are known
USES = 3
SHRINK = 2.0
STRONG = 0.7  # log lift a sentence needs
SAMPLE = 20_000  # labelled documents that train the chain, at most
BEAM = 8
RIDGE, OWN_RIDGE = 0.3, 3.0  # of the weights all subjects share, and of what a subject adds to them
SOURCES = 100_000  # whose features may be broadcast, of a hundred bytes each

_MARKUP = re.compile(r"<[^<>\x1e]{1,80}>|&\w{1,8};|https?://\S+")
_TOKEN = re.compile(r"[^\W\d_]+|[.!?](?=\s)|[\n\x1e]")
_ENDS = {".": 0, "!": 0, "?": 0, "\n": 0, "\x1e": 1}


class _Hashes(dict):
    """The hash of a word; 0 where a sentence ends, 1 where a document does."""

    def __missing__(self, word: str) -> int:
        h = _ENDS[word] if word in _ENDS else xxhash.xxh64_intdigest(word) - 2**63
        if len(self) < 1_000_000:
            self[word] = h
        return h


def words_of(texts: list[str | None], hashes: _Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of some documents all word hashes, the words in each sentence, and the sentences of each document.

    A sentence ends at its mark before white space or at a line end; one of a single word doesn't count.
    """
    whole = "\x1e".join(t.replace("\x1e", " ") if t and "\x1e" in t else t or "" for t in texts)
    if "<" in whole or "&" in whole or "://" in whole:
        whole = _MARKUP.sub(" ", whole)
    found = _TOKEN.findall(whole.lower())
    seq = np.fromiter(map(hashes.__getitem__, found), np.int64, len(found))
    end = (seq == 0) | (seq == 1)
    doc_of = np.cumsum(seq == 1)[~end]
    part = np.cumsum(end)[~end]
    seq = seq[~end]
    if not len(seq):
        return seq, np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    begins = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    sizes = np.diff(np.append(begins, len(seq)))
    keep = sizes > 1
    return seq[np.repeat(keep, sizes)], sizes[keep], np.bincount(doc_of[begins][keep], minlength=len(texts))


def with_pairs(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words and the pairs of neighbours in a sentence as hashes, and the sentence of each."""
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    inner = sentence[1:] == sentence[:-1]
    w = words.view(np.uint64)
    both = w[:-1][inner] * np.uint64(0x9E3779B97F4A7C15) + w[1:][inner] * np.uint64(0xC2B2AE3D27D4EB4F)
    both ^= both >> np.uint64(29)
    return np.concatenate((words, both.view(np.int64))), np.concatenate((sentence, sentence[:-1][inner]))


def _distinct(x: np.ndarray) -> np.ndarray:
    """Sorted and each once; a sort is many times as fast here as the table that np.unique makes."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))[: len(x)]]


class _Index:
    """Where each of some distinct hashes stands, by open addressing; -1 for any other."""

    def __init__(self, known: np.ndarray):
        self.bits = max(int(len(known) * 4).bit_length(), 1)
        self.hash, self.at = np.zeros(1 << self.bits, np.int64), np.full(1 << self.bits, -1, np.int64)
        left, slot = np.arange(len(known)), self._slot(known)
        while len(left):
            first = np.zeros(len(left), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = first & (self.at[slot] < 0)
            self.hash[slot[put]], self.at[slot[put]] = known[left[put]], left[put]
            left, slot = left[~put], (slot[~put] + 1) & (1 << self.bits) - 1

    def _slot(self, x: np.ndarray) -> np.ndarray:
        return (x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, x: np.ndarray) -> np.ndarray:
        slot, out, todo = self._slot(x), np.full(len(x), -1, np.int64), np.arange(len(x))
        while len(todo):
            there = self.at[slot]
            hit = (there >= 0) & (self.hash[slot] == x[todo])
            out[todo[hit]] = there[hit]
            more = (there >= 0) & ~hit
            todo, slot = todo[more], (slot[more] + 1) & (1 << self.bits) - 1
        return out


# --- arrays in columns ---
def _column(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary column: of each row so many of the values."""
    at = np.concatenate(([0], np.cumsum(sizes))) * values.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(values.tobytes())]).cast(pa.binary())


def _values(column: pa.Array, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows, and how many each has."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) else np.int32, len(column) + 1, column.offset * (8 if pa.types.is_large_binary(column.type) else 4)).astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(raw.tobytes(), dtype), np.diff(at) // np.dtype(dtype).itemsize


class Docs:
    """Some documents as arrays: their distinct terms, and sentence by sentence which of them occur."""

    def __init__(self, batch: pa.RecordBatch):
        self.term, terms = _values(batch.column("terms"), np.int32)  # of each document its distinct terms
        at, uses = _values(batch.column("uses"), np.int32)  # of each sentence its terms, by place among the document's
        size, self.sentences = _values(batch.column("sizes"), np.int32)
        self.n = batch.num_rows
        self.doc_of_term = np.repeat(np.arange(self.n), terms)
        self.use = at + np.repeat(np.concatenate(([0], np.cumsum(terms)))[:-1], uses)
        self.doc = np.repeat(np.arange(self.n), self.sentences)
        self.sentence = np.repeat(np.arange(len(size)), size)
        self.word = self.term[self.use]


def tokenised(texts: DataFrame, keep: list[str]) -> DataFrame:
    """keep, words, sizes: of each text its word hashes and the words in each sentence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches:
            words, sizes, per = words_of(unify_arrow(b.column("text"))[0].to_pylist(), hashes)
            doc = np.repeat(np.arange(len(per)), per)
            lengths = np.bincount(doc, sizes, len(per)).astype(np.int64)
            yield pa.record_batch([*(b.column(c) for c in keep), _column(words, lengths), _column(sizes.astype(np.int32), per)], [*keep, "words", "sizes"])

    kept = ", ".join(f"`{c}` {t}" for c, t in texts.select(*keep).dtypes)
    return texts.select(*keep, "text").mapInArrow(run, f"{kept}, words binary, sizes binary")


def _merged(sums: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    u, inverse = np.unique(np.concatenate([u for u, _ in sums]), return_inverse=True)
    return u, np.bincount(inverse, np.concatenate([n for _, n in sums]), len(u)).astype(np.int64)


def term_counts(docs: DataFrame) -> DataFrame:
    """(term, n): the uses of every word and pair, by its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            sums.append(np.unique(with_pairs(_values(b.column("words"), np.int64)[0], _values(b.column("sizes"), np.int32)[0])[0], return_counts=True))
            if len(sums) > 8:
                sums = [_merged(sums)]
            if len(sums[0][0]) > 2_000_000:
                yield pa.record_batch([pa.array(sums[0][0]), pa.array(sums[0][1].astype(np.int64))], ["term", "n"])
                sums = sums[1:]
        if sums:
            u, n = _merged(sums)
            yield pa.record_batch([pa.array(u), pa.array(n)], ["term", "n"])

    return docs.select("words", "sizes").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def encoded(docs: DataFrame, known: np.ndarray, keep: list[str]) -> DataFrame:
    """keep, terms, uses, sizes: the known terms (sorted hashes) of each text as Docs takes them, distinct in each sentence."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _Index(shared.value)
        v = max(len(shared.value), 1)
        for b in batches:
            sizes, per = _values(b.column("sizes"), np.int32)
            found, sentence = with_pairs(_values(b.column("words"), np.int64)[0], sizes)
            at = terms.find(found)
            ok = at >= 0
            use = _distinct(sentence[ok] * v + at[ok])
            sentence, word = use // v, use % v
            doc = np.repeat(np.arange(b.num_rows), per)[sentence]
            pair, where = np.unique(doc * v + word, return_inverse=True)
            own = np.bincount(pair // v, minlength=b.num_rows)
            place = where - np.concatenate(([0], np.cumsum(own)))[:-1][doc]
            yield pa.record_batch(
                [*(b.column(c) for c in keep), _column((pair % v).astype(np.int32), own), _column(place.astype(np.int32), np.bincount(doc, minlength=b.num_rows)),
                 _column(np.bincount(sentence, minlength=len(sizes)).astype(np.int32), per)],
                [*keep, "terms", "uses", "sizes"],
            )

    kept = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes)
    return docs.select(*keep, "words", "sizes").mapInArrow(run, f"{kept}, terms binary, uses binary, sizes binary")


# --- terms and frames ---
class Terms:
    """Of every known term the subject it speaks for (-1: none) and how much."""

    def __init__(self, subject: np.ndarray, weight: np.ndarray, subjects: int):
        self.subject, self.weight, self.k = subject, weight, subjects

    def scores(self, docs: Docs) -> np.ndarray:
        """(sentences, subjects): what the terms of each sentence say for each subject."""
        of = self.subject[docs.word]
        said = of >= 0
        at = docs.sentence[said] * self.k + of[said]
        return np.bincount(at, self.weight[docs.word[said]], len(docs.doc) * self.k).reshape(-1, self.k)

    def of(self, docs: Docs, scores: np.ndarray | None = None) -> np.ndarray:
        """The subject of each sentence, -1 for none."""
        s = self.scores(docs) if scores is None else scores
        return np.where(s.max(1, initial=0) > STRONG, s.argmax(1), -1) if self.k else np.full(len(docs.doc), -1)


def _summed(docs: DataFrame, step, size: int, width: int) -> DataFrame:
    """(f, s0, ...): sums over all documents of what step(Docs, batch, sums) adds for each term; added up per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((width, size))
        for b in batches:
            step(Docs(b), b, sums)
        f = np.flatnonzero(sums.any(0))
        yield pa.record_batch([pa.array(f.astype(np.int32)), *(pa.array(s[f]) for s in sums)], ["f", *(f"s{i}" for i in range(width))])

    schema = "f int, " + ", ".join(f"s{i} double" for i in range(width))
    return docs.mapInArrow(run, schema).groupBy("f").agg(*(F.sum(f"s{i}").alias(f"s{i}") for i in range(width)))


def _from_labels(size: int, k: int):
    def step(docs: Docs, batch: pa.RecordBatch, sums: np.ndarray) -> None:
        y = np.zeros((docs.n, k))
        for d, own in enumerate(batch.column("subjects").to_pylist()):
            y[d, own] = 1 / len(own)
        for i in range(k):
            sums[i] += np.bincount(docs.term, y[docs.doc_of_term, i], size)
        sums[k] += np.bincount(docs.term, minlength=size)

    return step


def _from_others(terms: Terms):
    """For each term, how much the other sentences of its documents are of each subject."""
    k, size = terms.k, len(terms.subject)

    def step(docs: Docs, _: pa.RecordBatch, sums: np.ndarray) -> None:
        z = terms.of(docs)
        told = z >= 0
        total = np.bincount(docs.doc[told] * k + z[told], minlength=docs.n * k).reshape(docs.n, k)
        # Every term beside every subject that its document has, of which most have one or two.
        there = total > 0
        d, i = np.nonzero(there)
        has = there.sum(1)
        reps = has[docs.doc_of_term]
        start = np.cumsum(reps) - reps
        pair = np.repeat(np.arange(len(docs.term)), reps)
        at = (np.cumsum(has) - has)[docs.doc_of_term[pair]] + np.arange(len(pair)) - start[pair]
        of = z[docs.sentence]
        own = docs.use[of >= 0]
        place = start[own] + (np.cumsum(there, 1) - 1)[docs.doc_of_term[own], of[of >= 0]]
        rest = total[d, i][at] - np.bincount(place, minlength=len(pair))
        m = np.bincount(pair, rest, len(docs.term))
        tells = m[pair] > 0
        pair, at = pair[tells], at[tells]
        sums[:k] += np.bincount(i[at] * size + docs.term[pair], rest[tells] / m[pair], k * size).reshape(k, size)
        sums[k] += np.bincount(docs.term[m > 0], minlength=size)
        sums[k + 1] += np.bincount(docs.term, minlength=size)

    return step


def _terms(sums: DataFrame, size: int, k: int, prior: np.ndarray, uses: float, pure: float, shrink: float) -> Terms:
    """The terms at least so pure, from their sums: s0..s(k-1) by subject, sk documents that tell, s(k+1) all documents."""
    counted = F.greatest(F.col(f"s{k}"), F.lit(1e-9))
    ratios = [(F.col(f"s{i}") + float(shrink * prior[i])) / (counted + shrink) for i in range(k)]
    above = [(r - float(prior[i])) / float(max(1 - prior[i], 1e-9)) for i, r in enumerate(ratios)]
    best = F.greatest(*above) if k > 1 else above[0]
    # At most 1 / SHARE terms are known.
    rows = sums.filter(F.greatest(f"s{k}", f"s{k + 1}") >= uses).filter(best >= pure).select("f", *(r.alias(f"r{i}") for i, r in enumerate(ratios))).toPandas()
    subject, weight = np.full(size, -1, np.int64), np.zeros(size)
    if len(rows):
        table = rows[[f"r{i}" for i in range(k)]].to_numpy()
        which = ((table - prior) / np.maximum(1 - prior, 1e-9)).argmax(1)
        f = rows["f"].to_numpy()
        subject[f], weight[f] = which, np.log(table[np.arange(len(f)), which] / prior[which])
    return Terms(subject, weight, k)


def _frames(terms: Terms):
    """For each word beside the terms: sentences of a subject, and how many agree with the rest of their document."""
    k, size = terms.k, len(terms.subject)

    def step(docs: Docs, _: pa.RecordBatch, sums: np.ndarray) -> None:
        z = terms.of(docs)
        told = z >= 0
        n = np.bincount(docs.doc[told] * k + z[told], minlength=docs.n * k).reshape(docs.n, k)
        counts = told & (n.sum(1)[docs.doc] > 1)
        agree = counts & (n[docs.doc, z] > 1)
        beside = terms.subject[docs.word] < 0
        for i, which in enumerate((counts, agree)):
            sums[i] += np.bincount(docs.word[beside & which[docs.sentence]], minlength=size)

    return step


# --- the chain ---
FEATURES = 9


class Model:
    """Everything that turns documents into labels."""

    def __init__(self, terms: Terms, trust: np.ndarray, usual: float, prior: np.ndarray):
        self.terms, self.trust, self.usual, self.prior = terms, trust, usual, prior
        self.k = terms.k
        self.order: list[int] = list(range(self.k))
        self.weights: np.ndarray | None = None  # of each subject
        self.lift = np.zeros((self.k, self.k))
        self.scale = (1.0, 0.0)

    def features(self, docs: Docs, source: np.ndarray) -> np.ndarray:
        """(documents, subjects, FEATURES): the evidence for each subject by terms and frames, the structure, the source."""
        k, n = self.k, docs.n
        scores = self.terms.scores(docs)
        z = self.terms.of(docs, scores)
        told = np.flatnonzero(z >= 0)
        trust = np.full(len(z), np.inf)
        np.minimum.at(trust, docs.sentence, self.trust[docs.word])
        r = np.where(np.isfinite(trust), trust, self.usual)[told]
        at = docs.doc[told] * k + z[told]
        firm = r >= 0.5 * self.usual
        grid = lambda x: x.reshape(n, k)
        seen, sure = grid(np.bincount(at, minlength=n * k)), grid(np.bincount(at[firm], minlength=n * k))
        best, power = np.zeros(n * k), np.zeros(n * k)
        np.maximum.at(best, at, r)
        np.maximum.at(power, at[firm], scores[told, z[told]][firm])
        evidence = np.stack([np.bincount(docs.doc, scores[:, i], n) for i in range(k)], 1) if k else np.zeros((n, 0))
        x = np.zeros((n, k, FEATURES))
        x[..., 0] = np.log1p(sure)
        x[..., 1] = sure > 0
        x[..., 2] = sure / np.maximum(sure.sum(1, keepdims=True), 1)
        x[..., 3] = grid(best)
        x[..., 4] = np.minimum(grid(power), 6) / 6
        x[..., 5] = (seen > 0) & (sure == 0)
        x[..., 6] = (sure == 1) * np.log1p(docs.sentences)[:, None]
        x[..., 7] = source
        x[..., 8] = np.log1p(evidence)
        return x

    def link(self, x: np.ndarray, j: int, before: np.ndarray) -> np.ndarray:
        """The inputs of the chain's link for subject j: its features, and the subjects already chosen (..., k)."""
        b = before.astype(float)
        more = [b.sum(-1), b @ self.lift[:, j], np.full(b.shape[:-1], np.log(self.prior[j])), np.ones(b.shape[:-1])]
        return np.concatenate((np.broadcast_to(x[..., j, :], (*b.shape[:-1], FEATURES)), np.stack(more, -1)), -1)

    def logit(self, x: np.ndarray, j: int, before: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return np.clip(a * (self.link(x, j, before) @ self.weights[j]) + b, -30, 30)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, subjects): whether each is in the likeliest combination, by beam search along the whole chain, and its probability there."""
        n = len(x)
        score = np.zeros((n, 1))
        chosen = np.zeros((n, 1, self.k), bool)
        for j in self.order:
            t = self.logit(x[:, None], j, chosen)
            taken = chosen.copy()
            taken[..., j] = True
            score = np.concatenate((score - np.logaddexp(0, -t), score - np.logaddexp(0, t)), 1)
            chosen = np.concatenate((taken, chosen), 1)
            top = np.argsort(-score, axis=1, kind="stable")[:, :BEAM]
            score, chosen = np.take_along_axis(score, top, 1), np.take_along_axis(chosen, top[..., None], 1)
        best = chosen[:, 0]
        p = np.zeros((n, self.k))
        before = np.zeros((n, self.k), bool)
        for j in self.order:
            p[:, j] = 1 / (1 + np.exp(-self.logit(x, j, before)))
            before[:, j] = best[:, j]
        return best, p

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        """Trains the chain by Newton steps with a ridge, then its calibration on held-out folds.

        What a subject's classifier adds to the weights that all share is held small where it has few labels.
        """
        k = self.k
        single, n = y.sum(0), max(len(y), 1)
        pair = y.T.astype(float) @ y
        np.fill_diagonal(pair, 0)
        self.lift = np.log((pair + 1) / (np.outer(single, single) / n + 1))
        self.order = sorted(range(k), key=lambda j: (-single[j], j))
        rows = np.zeros((k, len(y), FEATURES + 4))
        before = np.zeros((len(y), k), bool)
        for j in self.order:
            rows[j] = self.link(x, j, before)
            before[:, j] = y[:, j]
        fold = np.arange(len(y)) % 5
        held = np.zeros((k, len(y)))
        for f in range(5):
            part = fold != f
            if part.any() and (~part).any():
                w = _chain(rows[:, part], y[part])
                held[:, ~part] = np.einsum("jnf,jf->jn", rows[:, ~part], w)
        self.weights = _chain(rows, y)
        flat = held.ravel()
        w = _logistic(np.stack([flat, np.ones_like(flat)], 1), y.T.ravel().astype(float), 1e-3)
        self.scale = (float(max(w[0], 0.1)), float(w[1]))


def _chain(rows: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The weights of each subject's classifier: those that serve all, and what its own labels add."""
    k, n, m = rows.shape
    shared = _logistic(rows.reshape(k * n, m), y.T.ravel().astype(float), RIDGE)
    return np.stack([shared + _logistic(rows[j], y[:, j].astype(float), OWN_RIDGE, offset=rows[j] @ shared) for j in range(k)]) if k else np.zeros((0, m))


def _logistic(a: np.ndarray, t: np.ndarray, ridge: float = RIDGE, steps: int = 30, offset: np.ndarray | float = 0.0) -> np.ndarray:
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w + offset, -30, 30)))
        g = a.T @ (p - t) + ridge * w
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        d = np.linalg.solve(h, g)
        w -= d
        if np.abs(d).max() < 1e-6:
            break
    return w


# --- Spark ---
def source_name(source: Column) -> Column:
    """A source in its one spelling; NULL for NULL or blank."""
    x = F.regexp_replace(F.lower(F.trim(source)), r"[\s\-]+", "_")
    return F.when(x != "", x)


def read(documents: DataFrame) -> tuple[DataFrame, int]:
    """doc_id, source and the known terms of every text that is not empty, and how many terms are known.

    Known are the words and pairs used USES times and a share SHARE of all uses.
    """
    texts = documents.select("doc_id", source_name(F.col("source")).alias("source"), "text").filter(F.length("text") > 0)
    docs = settle(tokenised(texts, ["doc_id", "source"]))
    counts = settle(term_counts(docs))
    least = max(USES, SHARE * (counts.agg(F.sum("n")).first()[0] or 0))
    known = np.sort(counts.filter(F.col("n") >= least).select("term").toPandas()["term"].to_numpy(np.int64))  # at most 1 / SHARE
    return settle(encoded(docs, known, ["doc_id", "source"])), len(known)


def _with_source(docs: DataFrame, by_source: DataFrame) -> DataFrame:
    """docs with lift, the feature of each one's source."""
    return docs.join(small_side(by_source, SOURCES), "source", "left")


def _lift(batch: pa.RecordBatch, k: int) -> np.ndarray:
    return np.array([x or [0.0] * k for x in batch.column("lift").to_pylist()], float).reshape(batch.num_rows, k)


def train(docs: DataFrame, size: int, ratings: DataFrame, areas: DataFrame) -> tuple[Model, DataFrame, list[int]]:
    """The model, the features (source, lift) of the sources, and the subject_id behind each of its indices.

    docs, size: from read. Ratings of unknown documents or subjects are left out, repeated ones
    count once. Without any rating the model finds no subject.
    """
    spark = docs.sparkSession
    ids = sorted(r[0] for r in areas.select("subject_id").filter(F.col("subject_id").isNotNull()).distinct().collect())  # the list of subjects, small by its nature
    k = len(ids)
    index = F.array_position(F.array(*map(F.lit, ids)), F.col("subject_id")) - 1 if ids else F.lit(-1)
    rated = ratings.filter(F.col("doc_id").isNotNull()).select("doc_id", index.cast("int").alias("s")).filter("s >= 0").groupBy("doc_id").agg(F.array_sort(F.collect_set("s")).alias("subjects"))
    labelled = settle(docs.join(rated, "doc_id"))
    freq = {r[0]: r[1] for r in labelled.select(F.explode("subjects").alias("s")).groupBy("s").count().collect()}
    prior = np.array([freq.get(i, 0) + 0.5 for i in range(k)])
    prior /= max(prior.sum(), 1.0)
    if not freq or not size:
        return Model(Terms(np.full(size, -1), np.zeros(size), k), np.full(size, np.inf), 1.0, prior), spark.createDataFrame([], "source string, lift array<double>"), ids
    rate = lambda row: (np.array([row[i] or 0.0 for i in range(k)]) + 1e-3) / ((row[k] or 0.0) + k * 1e-3)
    first = settle(_summed(labelled, _from_labels(size, k), size, k + 2))
    terms = _terms(first, size, k, rate(first.agg(*(F.sum(f"s{i}") for i in range(k + 1))).first()), 2, 0.35, 1.0)
    for _ in range(ROUNDS):
        sums = settle(_summed(docs, _from_others(terms), size, k + 2))
        # Measured against the share that each subject has just now, no subject can draw the common words to it.
        terms = _terms(sums, size, k, rate(sums.agg(*(F.sum(f"s{i}") for i in range(k + 1))).first()), USES, PURE, SHRINK)
    agree = settle(_summed(docs, _frames(terms), size, 2))
    usual, seen = agree.agg(F.sum("s1") / F.sum("s0"), F.sum("s0")).first()
    usual = usual or 1.0
    known = agree.filter(F.col("s0") >= max(10, SHARE * (seen or 0))).select("f", ((F.col("s1") + usual * 5) / (F.col("s0") + 5)).alias("r")).filter(F.col("r") < 0.8 * usual).toPandas()
    trust = np.full(size, np.inf)
    trust[known["f"].to_numpy(np.int64)] = known["r"].to_numpy(float)
    model = Model(terms, trust, usual, prior)
    counted = labelled.filter(F.col("source").isNotNull()).groupBy("source").agg(F.count("*").alias("of"), *(F.count_if(F.array_contains("subjects", i)).alias(f"c{i}") for i in range(k)))
    lift = F.array(*(F.when(F.col(f"c{i}") > 0, F.log((F.col(f"c{i}") + 5 * float(prior[i])) / (F.col("of") + 5) / float(prior[i]))).otherwise(F.lit(0.0)) for i in range(k)))
    by_source = settle(counted.select("source", lift.alias("lift")))
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = shared.value.features(Docs(b), _lift(b, k))
            yield pa.record_batch({"doc_id": b.column("doc_id"), "x": pa.array(x.reshape(b.num_rows, -1).tolist(), pa.list_(pa.float64())), "subjects": b.column("subjects")})

    by_hash = lambda df, n: df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    sample = by_hash(labelled, SAMPLE)
    # Raters tell of no document that it is about nothing: as many others are taken, and of them those that no sentence speaks for.
    others = by_hash(docs.join(rated, "doc_id", "left_anti"), min(SAMPLE, labelled.count())).withColumn("subjects", F.array().cast("array<int>"))
    rows = _with_source(sample.unionByName(others), by_source).mapInArrow(run, "doc_id long, x array<double>, subjects array<int>").orderBy("doc_id").collect()
    rows = [r for r in rows if r["subjects"] or not np.array(r["x"]).reshape(k, FEATURES)[:, :7].any()]
    x, y = np.array([r["x"] for r in rows]).reshape(len(rows), k, FEATURES), np.zeros((len(rows), k), bool)
    for d, r in enumerate(rows):
        y[d, r["subjects"]] = True
    model.fit(x, y)
    return model, by_source, ids


def assign_subjects(documents: DataFrame, ratings: DataFrame, areas: DataFrame) -> DataFrame:
    """(doc_id, subject_id, probability): each subject that a document is about.

    Documents with a NULL or empty text, or about none, give no row; exact copies get the same
    subjects. The probability is that of the subject given the others chosen before it.
    """
    docs, size = read(documents)
    model, by_source, ids = train(docs, size, ratings, areas)
    k = len(ids)
    shared = documents.sparkSession.sparkContext.broadcast((model, np.array(ids, np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, names = shared.value
        for b in batches:
            if m.weights is None:
                continue
            best, p = m.decode(m.features(Docs(b), _lift(b, k)))
            d, j = np.nonzero(best)
            yield pa.record_batch({"doc_id": b.column("doc_id").take(pa.array(d)), "subject_id": pa.array(names[j]), "probability": pa.array(p[d, j])})

    return _with_source(docs, by_source).mapInArrow(run, "doc_id long, subject_id int, probability double")


def composition(documents: DataFrame, ratings: DataFrame, areas: DataFrame) -> DataFrame:
    """(subject_id, subject, docs, share): how many documents are about each subject, and their share of those about any."""
    found = settle(assign_subjects(documents, ratings, areas))
    about = found.select("doc_id").distinct().count()
    per = found.groupBy("subject_id").agg(F.count("*").alias("docs"))
    return areas.select("subject_id", "subject").join(per, "subject_id", "left").select("subject_id", "subject", F.coalesce("docs", F.lit(0)).alias("docs"), (F.coalesce("docs", F.lit(0)) / F.lit(max(about, 1))).alias("share"))
