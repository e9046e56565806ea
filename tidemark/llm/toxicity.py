"""Toxicity by a convolutional text classifier.

A word's embedding is the mean of hashed embeddings of the word and its first letters,
each looked up by two independent hashes, so that one collision moves it half way only.
Filters of several widths run over the words of a whole text, the largest answer of each
filter is kept, and a logistic layer reads these. Embeddings, filters and layer are
trained with Adam in numpy on a bounded, balanced sample of labelled documents. The
embeddings' first column starts from how much likelier a hashed feature is in toxic
documents, so that training begins with the words that matter.

Thresholds are calibrated on labelled documents kept out of training, one for each
language; at scoring the language is estimated from the text's own words. A score is the
logistic function of the distance to the threshold, so 0.5 is the border everywhere.

A null or empty text has no word and scores like one: below the border. Without toxic or
without clean labelled documents there is nothing to learn and every score is 0. Rows are
scored alone: ties, repeated rows and other columns change nothing; a text of any length
is read whole. A document labelled more than once is toxic if one label says so.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts, remainder, texts_of, word_starts

#: Labelled documents of each class that are learned from, each as a whole, and the length
#: from which one is not drawn; together they bound what the driver holds.
SAMPLE_ROWS = 2500
LONGEST = 200_000
SLOTS = 1 << 16
WIDTH = 12
FILTERS = 8
WIDTHS = (1, 2, 3)
PASSES = 6
BATCH = 96
RATE = 0.01
#: Labelled documents of a class that a language needs for a threshold of its own.
LEAST_CALIBRATION = 15
#: Words whose embedding a task remembers.
REMEMBERED = 200_000
TRIM = ".,;:!?\"'()[]{}<>|*#$%&-_=+/\\"

SCHEMA = "doc_id bigint, score double, predicted int"


#: Two places for the word and for its first 3, 4, 5 and 6 letters.
MOST_SLOTS = 2 * 5


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS,
           longest: int = LONGEST) -> list[tuple[str, str | None, int]]:
    """(whole text, lang, toxic) of at most ``rows`` labelled documents of each class of at most
    ``longest`` characters, chosen by hash.

    ``labels`` are the ones that may be learned from.
    """
    known = (labels.select(F.col("doc_id").cast("bigint").alias("id"),
                           F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("id").isNotNull() & F.col("toxic").isNotNull())
             .groupBy("id").agg(F.max("toxic").alias("toxic")))
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col("lang").cast("string").alias("lang")).filter(F.char_length("text") <= longest)
    known = known.join(texts.select("id"), "id", "left_semi")
    drawn = None
    for kind in (0, 1):
        part = known.filter(F.col("toxic") == kind).orderBy(
            F.xxhash64("id", F.lit(5)), "id").limit(rows)
        drawn = part if drawn is None else drawn.unionByName(part)
    # At most 2 * rows ids: small whatever the table's size.
    joined = texts.join(F.broadcast(drawn), "id").orderBy(
        F.xxhash64("id", "text"), "id").limit(2 * rows)
    return [(r["text"], r["lang"], r["toxic"]) for r in joined.collect()]


@dataclass
class Toxicity:
    """Embeddings, filters, layer and thresholds; languages by hashed word counts."""

    embed: np.ndarray
    filters: dict[int, np.ndarray] = field(default_factory=dict)
    offset: dict[int, np.ndarray] = field(default_factory=dict)
    layer: np.ndarray = field(default_factory=lambda: np.zeros(1))
    bias: float = 0.0
    languages: list[str] = field(default_factory=list)
    speech: np.ndarray = field(default_factory=lambda: np.zeros((SLOTS, 0), np.float32))
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(1))
    trained: bool = False

    def vectors(self, table: np.ndarray) -> np.ndarray:
        """Embeddings of words from their padded slots (-1: none)."""
        there = table >= 0
        got = self.embed[np.where(there, table, 0)] * there[:, :, None]
        return got.sum(axis=1) / np.maximum(1, there.sum(axis=1))[:, None]

    def pooled(self, words: np.ndarray, counts: np.ndarray):
        """The largest answer of each filter in each text, and the place it came from.

        ``words`` holds the texts' embeddings one after another.
        """
        starts = word_starts(counts)
        out, where = [], []
        owner = np.repeat(np.arange(len(counts)), counts)
        left = np.repeat(starts + counts, counts) - np.arange(len(owner))
        some = counts > 0
        # All filters at all words in one product; a filter adds what its words give.
        given = words @ np.concatenate([k for w in WIDTHS for k in self.filters[w]], axis=1)
        at = 0
        for width in WIDTHS:
            answer = given[:, at:at + FILTERS] + self.offset[width]
            for k in range(1, width):
                column = at + k * FILTERS
                part = given[k:, column:column + FILTERS] * (left[:-k] > k)[:, None]
                answer[:len(part)] += part  # past a text's end a filter sees nothing
            at += width * FILTERS
            top = np.full((len(counts), FILTERS), -4.0, np.float32)
            if len(words):
                top[some] = np.maximum.reduceat(answer, starts[some], axis=0)
            out.append(top)
            where.append((answer, owner))
        return np.concatenate(out, axis=1), where

    def logits(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        top, _ = self.pooled(words, counts)
        return np.tanh(top) @ self.layer + self.bias

    def spoken(self, speech: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Language of each text, from the sum over its words."""
        total = np.zeros((len(counts), max(1, len(self.languages))))
        some = counts > 0
        if len(speech) and self.languages:
            total[some] = np.add.reduceat(speech, word_starts(counts)[some], axis=0)
        return total.argmax(axis=1)


def _padded(words: list[str]) -> np.ndarray:
    """Places of each word's features in the embedding table, two for each; -1: none."""
    names, sizes = [], []
    for word in words:
        word = word.lower().strip(TRIM)
        names.append("w " + word)
        n = len(word)
        if n >= 3:
            names.append(word[:3])
            if n >= 4:
                names.append(word[:4])
                if n >= 5:
                    names.append(word[:5])
                    if n >= 6:
                        names.append(word[:6])
        sizes.append(1 + min(max(n - 2, 0), 4))
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(n.encode()) for n in names])
    value = np.frombuffer(raw, ">u4").reshape(-1, 2) % SLOTS
    table = np.full((len(words), MOST_SLOTS // 2, 2), -1, np.int32)
    counts = np.array(sizes, np.int64)
    row = np.repeat(np.arange(len(words)), counts)
    table[row, np.arange(len(row)) - np.repeat(word_starts(counts), counts)] = value
    return table.reshape(len(words), MOST_SLOTS)


def train(rows: list[tuple[str, str | None, int]], seed: int = 7) -> Toxicity:
    """Fit the classifier on labelled texts; the same rows give the same model."""
    rng = np.random.default_rng(seed)
    model = Toxicity(rng.normal(0, 0.05, (SLOTS, WIDTH)).astype(np.float32))
    labels = np.array([r[2] for r in rows], np.float64)
    if not len(rows) or not 0 < labels.sum() < len(rows):
        return model
    vocabulary: dict[str, int] = {}
    texts = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in r[0].split()], np.int64)
             for r in rows]
    table = _padded(list(vocabulary))
    if not len(table):
        return model
    in_calibration = np.arange(len(rows)) % 4 == 0
    _begin_with_evidence(model, texts, labels, table, ~in_calibration)
    _learn_languages(model, texts, [r[1] for r in rows], table)
    for width in WIDTHS:
        model.filters[width] = rng.normal(0, 0.3, (width, WIDTH, FILTERS)).astype(np.float32)
        model.filters[width][:, 0, :FILTERS // 2] = 1.0 / width
        model.offset[width] = np.full(FILTERS, -0.5, np.float32)
    model.layer = rng.normal(0.3, 0.1, FILTERS * len(WIDTHS))
    _fit(model, texts, labels, table, np.flatnonzero(~in_calibration), rng)
    model.trained = True
    _calibrate(model, texts, labels, table, in_calibration)
    return model


def _slots_of(text: np.ndarray, table: np.ndarray) -> np.ndarray:
    found = table[np.unique(text)].ravel()
    return np.unique(found[found >= 0])


def _begin_with_evidence(model, texts, labels, table, used) -> None:
    """Column 0: how much likelier a slot is filled in toxic documents, as a logarithm."""
    counts = np.zeros((2, SLOTS))
    for text, label, use in zip(texts, labels, used):
        if use and len(text):
            counts[int(label), _slots_of(text, table)] += 1
    n = [max(1, int((used & (labels == k)).sum())) for k in (0, 1)]
    share = [(counts[k] + 0.5 * n[k] / max(n)) / (n[k] + 1) for k in (0, 1)]
    evidence = np.log(share[1] / share[0])
    # A slot of few documents says little.
    evidence *= np.minimum(1, counts.sum(axis=0) / 8)
    model.embed[:, 0] = evidence


def _learn_languages(model, texts, langs, table) -> None:
    """Naive Bayes over slots: the logarithm of a slot's share of a language's words."""
    model.languages = sorted({x for x in langs if x is not None})
    speech = np.full((SLOTS, len(model.languages)), 0.5)
    for text, lang in zip(texts, langs):
        if lang is not None and len(text):
            found = table[text].ravel()
            np.add.at(speech, (found[found >= 0], model.languages.index(lang)), 1)
    if len(model.languages):
        speech = np.log(speech / speech.sum(axis=0))
        speech -= speech.mean(axis=1, keepdims=True)
    model.speech = speech.astype(np.float32)


def _fit(model, texts, labels, table, rows, rng) -> None:
    share = np.clip(labels[rows].mean(), 0.05, 0.95)
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    names = ["embed", "layer", "bias", *(("filters", w) for w in WIDTHS),
             *(("offset", w) for w in WIDTHS)]

    def get(name):
        return getattr(model, name[0])[name[1]] if isinstance(name, tuple) else getattr(model, name)

    def put(name, value):
        if isinstance(name, tuple):
            getattr(model, name[0])[name[1]] = value
        else:
            setattr(model, name, value)
    first = {n: np.zeros_like(np.asarray(get(n), np.float32)) for n in names}
    second = {n: np.zeros_like(v) for n, v in first.items()}
    step = 0
    for _ in range(PASSES):
        order = rng.permutation(rows)
        for lo in range(0, len(order), BATCH):
            step += 1
            grads = _gradient(model, [texts[i] for i in order[lo:lo + BATCH]],
                              labels[order[lo:lo + BATCH]], weight[order[lo:lo + BATCH]], table)
            rate = RATE * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for name in names:
                at, grad = slice(None), grads[name]
                if name == "embed":
                    at, grad = grad  # only slots that this batch touched
                m = first[name]
                v = second[name]
                if m.ndim:
                    m[at] += 0.1 * (grad - m[at])
                    v[at] += 0.001 * (grad * grad - v[at])
                    now = np.asarray(get(name))
                    now[at] -= (rate * m[at] / (np.sqrt(v[at]) + 1e-6)).astype(now.dtype)
                else:
                    first[name] = m = m + 0.1 * (grad - m)
                    second[name] = v = v + 0.001 * (grad * grad - v)
                    put(name, float(get(name) - rate * m / (np.sqrt(v) + 1e-6)))


def _gradient(model, texts, labels, weight, table) -> dict:
    counts = np.array([len(t) for t in texts])
    ids, back = np.unique(np.concatenate(texts), return_inverse=True) if counts.sum() else (
        np.zeros(0, np.int64), np.zeros(0, np.int64))
    known = model.vectors(table[ids])
    words = known[back].astype(np.float32)
    top, answers = model.pooled(words, counts)
    soft = np.tanh(top)
    logit = soft @ model.layer + model.bias
    error = weight * (1 / (1 + np.exp(-logit)) - labels) / len(labels)
    grads = {"layer": soft.T @ error + 1e-4 * model.layer, "bias": error.sum()}
    into = (error[:, None] * model.layer) * (1 - soft ** 2)
    word_grad = np.zeros((len(words), WIDTH), np.float32)
    starts = word_starts(counts)
    ends = starts + counts
    for i, width in enumerate(WIDTHS):
        answer, owner = answers[i]
        flow = into[:, i * FILTERS:(i + 1) * FILTERS]
        kernel = model.filters[width]
        kernel_grad = np.zeros_like(kernel)
        hit = answer == np.repeat(top[:, i * FILTERS:(i + 1) * FILTERS], counts, axis=0)
        at, f = np.nonzero(hit)
        # The first place of each largest answer gets the gradient.
        _, once = np.unique(owner[at] * FILTERS + f, return_index=True) if len(at) else (
            None, np.zeros(0, np.int64))
        at, f = at[once], f[once]
        amount = flow[owner[at], f] if len(at) else np.zeros(0)
        for k in range(width):
            inside = at + k < ends[owner[at]] if len(at) else np.zeros(0, bool)
            a, g, v = at[inside] + k, f[inside], amount[inside]
            np.add.at(kernel_grad, (k, slice(None), g), v[:, None] * words[a])
            np.add.at(word_grad, a, v[:, None] * kernel[k][:, g].T)
        grads["filters", width] = kernel_grad + 1e-4 * kernel
        grads["offset", width] = flow[counts > 0].sum(axis=0)
    moved = np.flatnonzero(word_grad.any(axis=1))
    slot_table = table[ids[back[moved]]]
    there = slot_table >= 0
    share = word_grad[moved] / np.maximum(1, there.sum(axis=1))[:, None]
    found = slot_table[there]
    spread = np.repeat(share, there.sum(axis=1), axis=0)
    unique, place = np.unique(found, return_inverse=True)
    grad = np.zeros((len(unique), WIDTH), np.float32)
    np.add.at(grad, place, spread)
    grads["embed"] = (unique, grad)
    return grads


def _calibrate(model, texts, labels, table, used) -> None:
    """The threshold that parts the classes best, over all and for each language."""
    rows = np.flatnonzero(used)
    logit, spoken = np.zeros(len(rows)), np.zeros(len(rows), np.int64)
    for lo in range(0, len(rows), BATCH):
        part = [texts[i] for i in rows[lo:lo + BATCH]]
        counts = np.array([len(t) for t in part])
        words = np.concatenate(part)
        ids, back = np.unique(words, return_inverse=True)
        logit[lo:lo + BATCH] = model.logits(
            model.vectors(table[ids])[back].astype(np.float32), counts)
        spoken[lo:lo + BATCH] = model.spoken(_speech(model, table[ids])[back], counts)
    truth = labels[rows] == 1
    overall = best_threshold(logit, truth)
    model.thresholds = np.full(max(1, len(model.languages)), overall)
    for k in range(len(model.languages)):
        own = spoken == k
        if min((own & truth).sum(), (own & ~truth).sum()) >= LEAST_CALIBRATION:
            model.thresholds[k] = best_threshold(logit[own], truth[own])


def best_threshold(logit: np.ndarray, truth: np.ndarray) -> float:
    """The middle of the widest gap at which hits less false alarms are most."""
    if not truth.any() or truth.all():
        return 0.0
    order = np.argsort(logit, kind="stable")
    value, toxic = logit[order], truth[order]
    hits = 1 - np.concatenate(([0], np.cumsum(toxic))) / toxic.sum()
    alarms = 1 - np.concatenate(([0], np.cumsum(~toxic))) / (~toxic).sum()
    edges = np.concatenate(([value[0] - 1], value, [value[-1] + 1]))
    # Clean texts are the many: an alarm weighs more than a miss.
    gain = hits - 2 * alarms
    gap = np.diff(edges)
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    best = best[np.argmax(gap[best])]
    return float((edges[best] + edges[best + 1]) / 2)


def _speech(model, table: np.ndarray) -> np.ndarray:
    there = table >= 0
    return (model.speech[np.where(there, table, 0)] * there[:, :, None]).sum(axis=1)


class _Words(dict):
    """Rows of a growing table for words; new ones wait until their row is made."""

    def __init__(self):
        self.waiting: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = row = len(self)
        self.waiting.append(word)
        return row


class Scorer:
    """Scores texts in batches, with the embeddings of known words at hand."""

    def __init__(self, model: Toxicity):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.known = _Words()
        self.words = np.zeros((1024, WIDTH), np.float32)
        self.speech = np.zeros((1024, self.model.speech.shape[1]), np.float32)

    def _make_rows(self) -> None:
        new, self.known.waiting = self.known.waiting, []
        if not new:
            return
        start = len(self.known) - len(new)
        while len(self.words) < len(self.known):
            self.words = np.concatenate([self.words, np.zeros_like(self.words)])
            self.speech = np.concatenate([self.speech, np.zeros_like(self.speech)])
        table = _padded(new)
        self.words[start:len(self.known)] = self.model.vectors(table)
        self.speech[start:len(self.known)] = _speech(self.model, table)

    def score(self, texts: list[str]) -> np.ndarray:
        if not self.model.trained:
            return np.zeros(len(texts))
        if len(self.known) > REMEMBERED:
            self._clear()
        out = np.zeros(len(texts))
        lo = 0
        while lo < len(texts):
            ids, counts, total = [], [], 0
            while lo + len(counts) < len(texts) and total < 60_000:
                split = texts[lo + len(counts)].split()
                ids.append(np.fromiter(map(self.known.__getitem__, split), np.int64, len(split)))
                counts.append(len(split))
                total += len(split)
            self._make_rows()
            rows, sizes = np.concatenate(ids), np.array(counts)
            logit = self.model.logits(self.words[rows], sizes)
            border = self.model.thresholds[self.model.spoken(self.speech[rows], sizes)]
            out[lo:lo + len(counts)] = 1 / (1 + np.exp(-np.clip(logit - border, -30, 30)))
            lo += len(counts)
        return out


def score(docs: DataFrame, model: Toxicity) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` for every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(shared.value)

        def work(batch):
            got = scorer.score(batch.column("text").to_pylist())
            return {"doc_id": batch.column("doc_id"), "score": got,
                    "predicted": (got >= 0.5).astype(np.int32)}
        return work
    return map_texts(texts_of(docs), SCHEMA, make, limit=4 << 20)


def learnable(labels: DataFrame) -> DataFrame:
    """Labels to learn from: remainder 0 of 5 is held out."""
    return labels.filter(remainder(5) != 0)
