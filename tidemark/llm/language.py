"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is parsed
against it from left to right into the longest matches that occur in that text;
a language whose sample shares long passages with the text needs few phrases.
Phrases cost the logarithm of the sample's length, so the language with the fewest
normalised phrases wins; equal costs go to the smaller name.

Every letter and combining mark of the samples is a symbol of its own, in any number
and script; one that no sample has can match nothing. The automata are built once,
on the driver, and packed: the transitions of all states share one array, shifted so
that none collide, and an entry names its state. A task steps through many segments of
texts at once. Segments have a fixed length, so a text of any length is parsed whole.

What unseen text of a language costs is measured by reading each part of its sample
against the other parts, for every language alike.

Null texts and texts without a letter are ``und`` with score 0. Without labelled
text every text is ``und``. Rows are judged alone: ties, repeated rows, empty tables and
other columns, whatever their names, change nothing.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    map_batches, map_texts, parts, remainder, ship, texts_of, word_starts,
)

UNKNOWN = "und"
#: Bounds of the labelled sample: pieces and characters of text for a language.
SAMPLE_PIECES = 400
SAMPLE_CHARS = 30_000
PIECE_CHARS = 400
SEGMENT = 1024
LANES = 4096
#: Parts of a sample that are read against the others to see what unseen text costs.
FOLDS = 3
#: Places tried for a state before the search gives the front of the array up.
TRIES = 64
#: A text whose best language costs more bits a symbol than this many times the
#: language's own unseen text is not in a learned language.
REJECT_AT = 2.2

SCHEMA = "doc_id bigint, lang_pred string, score double, bits double, known boolean"
LETTER = regex.compile(r"\p{L}").search


def labelled_sample(docs: DataFrame, pieces: int = SAMPLE_PIECES, chars: int = PIECE_CHARS
                    ) -> dict[str, list[str]]:
    """A bounded sample of text for each language, the same on every run.

    Rows compete by a hash inside (language, slot), with as many slots as pieces, so
    that no task holds a language; a row enters with a piece from its middle.
    """
    text = F.col("text").cast("string")
    length = F.char_length(text)
    rows = (
        docs.filter(F.col("lang").isNotNull() & (F.trim(text) != ""))
        .select(F.col("lang").cast("string").alias("lang"), F.xxhash64(text).alias("rank"),
                F.substr(text, F.greatest(F.lit(1), (length / 2 - chars / 2).cast("int")),
                         F.lit(chars)).alias("piece")))
    kept = (
        rows.groupBy("lang", F.pmod("rank", F.lit(pieces)).alias("slot"))
        .agg(F.min(F.struct("rank", "piece")).alias("best"))
        .select("lang", "best.rank", "best.piece"))
    found: dict[str, list[str]] = {}
    for row in kept.orderBy("lang", "rank").collect():
        found.setdefault(row["lang"], []).append(row["piece"])
    return found


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that reads every substring of ``symbols``."""
    steps: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for symbol in symbols:
        new = len(steps)
        steps.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in steps[at]:
            steps[at][symbol] = new
            at = link[at]
        if at >= 0:
            old = steps[at][symbol]
            if length[old] == length[at] + 1:
                link[new] = old
            else:
                copy = len(steps)
                steps.append(dict(steps[old]))
                length.append(length[at] + 1)
                link.append(link[old])
                while at >= 0 and steps[at].get(symbol) == old:
                    steps[at][symbol] = copy
                    at = link[at]
                link[old] = link[new] = copy
        last = new
    return steps


def symbols_of(samples: dict[str, list[str]]) -> tuple[np.ndarray, int]:
    """The symbol of every code point, and how many symbols there are. Frequent letters come
    first; letters that differ in case only are one."""
    counts: Counter[str] = Counter()
    for pieces in samples.values():
        for piece in pieces:
            counts.update(piece.lower())
    own = {c: i for i, c in enumerate(
        sorted((c for c in counts if is_letter(c)), key=lambda c: (-counts[c], c)), 2)}
    symbol = np.zeros(0x110000, np.int32)
    for point in range(0x110000):
        char = chr(point)
        if is_letter(char):
            symbol[point] = own.get(char.lower()[0], 1)
    return symbol, len(own) + 2


def is_letter(char: str) -> bool:
    """Letters, and the marks that belong to them."""
    return unicodedata.category(char)[0] in "LM"


def left_out(texts: list[np.ndarray]) -> float:
    """Median bits a symbol that parts of a sample cost against the other parts; a sample of
    one piece is cut into halves."""
    if len(texts) == 1:
        texts = np.array_split(texts[0], 2)
    folds = min(FOLDS, len(texts))
    bits = []
    for k in range(folds):
        read = np.concatenate([t for i, t in enumerate(texts) if i % folds != k])[:SAMPLE_CHARS]
        steps = suffix_automaton(read.tolist())
        for text in texts[k::folds]:
            state, count = 0, 1
            for symbol in text.tolist():
                into = steps[state].get(symbol)
                if into is None:
                    into = steps[0].get(symbol)
                    count += 1 if into is not None or not state else 2
                    into = into or 0
                state = into
            bits.append(count * np.log2(max(2, len(read))) / max(1, len(text)))
    return float(np.median(bits))


def packed(automata: list[list[dict[int, int]]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """``base`` of each state and the array of transitions: entry ``base[state] + symbol`` is
    ``state << 32 | into`` where the state has that transition. States of all automata are
    numbered one after another."""
    rows, offset = [], 0
    for steps in automata:
        rows += [(offset + i, offset, to) for i, to in enumerate(steps)]
        offset += len(steps)
    base = np.zeros(offset, np.int64)
    filled = bytearray(width + sum(len(to) for _, _, to in rows) * 2 + width)
    entries: list[tuple[int, int]] = []
    many = sorted((r for r in rows if len(r[2]) > 1), key=lambda r: (-len(r[2]), r[0]))
    front = width  # bases are never negative
    for state, first, to in many:
        symbols = sorted(to)
        at, tries = front, 0
        while True:
            at = filled.find(0, at)
            if at < 0 or at + width > len(filled):
                filled.extend(bytes(len(filled) + width))
                at = front if at < 0 else at
                continue
            begin = at - symbols[0]
            if not any(filled[begin + s] for s in symbols):
                break
            at, tries = at + 1, tries + 1
        if tries > TRIES:
            front = at
        base[state] = begin
        for s in symbols:
            filled[begin + s] = 1
            entries.append((begin + s, state << 32 | first + to[s]))
    single = [r for r in rows if len(r[2]) == 1]
    filled.extend(bytes(len(single)))
    free = np.flatnonzero(np.frombuffer(bytes(filled), np.uint8)[width:] == 0)[:len(single)] + width
    for (state, first, to), at in zip(single, free.tolist()):
        symbol, into = next(iter(to.items()))
        base[state] = at - symbol
        entries.append((at, state << 32 | first + into))
    size = max((int(base.max()) if len(base) else 0) + width, len(filled))
    moves = np.full(size, -1, np.int64)
    if entries:
        at, value = np.array(entries, np.int64).T
        moves[at] = value
    used = int(max(base.max() + width, np.flatnonzero(moves >= 0).max(initial=0) + 1)) if len(base) else 0
    return base, moves[:used].copy()


@dataclass
class LanguageModel:
    """Sample texts by language, and what ``build`` makes of them."""

    samples: dict[str, list[str]]

    def __post_init__(self):
        self.names = sorted(self.samples)
        self.moves: np.ndarray | None = None

    def build(self) -> LanguageModel:
        """Symbol 0 is anything but letters and marks, 1 a letter that no sample has."""
        if self.moves is not None or not self.names:
            return self
        self.symbol, self.width = symbols_of(self.samples)
        automata, cost, usual = [], [], []
        for name in self.names:
            texts = [self._squeeze(p) for p in self.samples[name]]
            read = np.concatenate(texts)[:SAMPLE_CHARS]
            automata.append(suffix_automaton(read.tolist()))
            cost.append(np.log2(max(2, len(read))))
            usual.append(left_out(texts))
        # Pieces that are near copies of each other cost less than other text of their
        # language does, so what is usual in most languages is the least.
        self.usual = np.maximum(usual, max(0.5, float(np.median(usual))))
        self.cost = np.array(cost)
        self.roots = word_starts(np.array([len(a) for a in automata])).astype(np.int32)
        self.base, self.moves = packed(automata, self.width)
        # Where no transition goes on, a phrase ends and the next begins at the root; a
        # symbol that the sample lacks is a phrase of its own. Entries: state, phrases.
        self.restart = np.empty((len(automata), self.width), np.int64)
        for i, (root, steps) in enumerate(zip(self.roots.tolist(), automata)):
            self.restart[i] = root * 4 + 2
            for s, to in steps[0].items():
                self.restart[i, s] = (root + to) * 4 + 1
        return self

    def _squeeze(self, text: str) -> np.ndarray:
        codes = self.symbol[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        keep = codes != 0
        keep[1:] |= codes[:-1] != 0
        return codes[keep]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text against each language's sample."""
        sizes = np.array([len(t) for t in texts], np.int64)
        codes = np.concatenate(texts) if texts else np.zeros(0, np.int32)
        n_segments = (sizes + SEGMENT - 1) // SEGMENT
        owner = np.repeat(np.arange(len(texts)), n_segments)
        nth = np.arange(len(owner)) - np.repeat(word_starts(n_segments), n_segments)
        begin = word_starts(sizes)[owner] + nth * SEGMENT if len(owner) else nth
        length = np.minimum(SEGMENT, sizes[owner] - nth * SEGMENT)
        order = np.argsort(-length, kind="stable")
        counts = np.zeros((len(self.names), len(owner)), np.int32)
        for lo in range(0, len(order), LANES):
            lanes = order[lo:lo + LANES]
            counts[:, lanes] = self._walk(codes, begin[lanes], length[lanes])
        out = np.zeros((len(texts), len(self.names)), np.int64)
        for i in range(len(self.names)):
            out[:, i] = np.bincount(owner, counts[i], len(texts))
        return out

    def _walk(self, codes: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Phrases of segments in descending order of length."""
        found = np.ones((len(self.names), len(begin)), np.int32)
        active = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0),
                                 side="left")
        states = np.repeat(self.roots[:, None].astype(np.int64), len(begin), 1)
        for step, n in enumerate(active):
            now = codes[begin[:n] + step]
            state = states[:, :n]
            entry = self.moves.take(self.base.take(state) + now)
            missed = (entry >> 32) != state
            into = entry & 0xFFFFFFFF
            again = self.restart.take(now, axis=1)[missed]
            root, ended = again >> 2, again & 3
            ended[(ended == 2) & (root == state[missed])] = 1  # no phrase was begun
            into[missed] = root
            found[:, :n][missed] += ended.astype(np.int32)
            states[:, :n] = into
        return found

    def _bits(self, texts: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([max(1, len(t)) for t in texts])
        return self.phrases(texts) * self.cost / sizes[:, None]

    def judge(self, texts: list[str | None]) -> dict[str, list]:
        """Language, score and bits a symbol of each text."""
        n = len(texts)
        names, score = [UNKNOWN] * n, np.zeros(n)
        bits, known = np.zeros(n), np.zeros(n, bool)
        rows = [i for i, t in enumerate(texts) if t and LETTER(t)]
        if rows and self.names:
            codes = [self._squeeze(texts[i]) for i in rows]
            cost = self._bits(codes)
            best = np.argmin(cost, axis=1)
            least = cost[np.arange(len(rows)), best]
            # How much likelier the winner is, from a bounded part of the code length.
            weight = np.minimum(64, [len(c) for c in codes])[:, None]
            sure = 1 / np.exp2(-(cost - least[:, None]) * weight).sum(axis=1)
            for k, i in enumerate(rows):
                names[i] = self.names[best[k]]
            score[rows], bits[rows] = sure, least
            known[rows] = least <= REJECT_AT * self.usual[best]
        return {"lang_pred": names, "score": score, "bits": bits, "known": known}


def train(docs: DataFrame) -> LanguageModel:
    """Learn from the non-null ``lang`` of the given documents."""
    return LanguageModel(labelled_sample(docs))


def _shipped(docs: DataFrame, model: LanguageModel):
    """The finished model, sent to every executor once: arrays of a size that the bound on
    the sample sets."""
    ready = model.build()
    light = LanguageModel({name: [] for name in ready.names})
    if ready.moves is not None:
        for name in ("symbol", "width", "usual", "cost", "roots", "base", "moves", "restart"):
            setattr(light, name, getattr(ready, name))
    ship(docs.sparkSession)
    return docs.sparkSession.sparkContext.broadcast(light)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per document: ``lang_pred``, ``score``, ``bits`` a symbol, and ``known``:
    whether the text costs about what text of that language does."""
    shipped = _shipped(docs, model)

    def make():
        def work(batch):
            return {"doc_id": batch.column("doc_id"),
                    **shipped.value.judge(batch.column("text").to_pylist())}
        return work
    return map_texts(texts_of(docs), SCHEMA, make)


def held_out(docs: DataFrame) -> DataFrame:
    """Documents to learn from; those with remainder 2 of 4 are held out, and a null id is not."""
    return docs.filter(F.coalesce(remainder(4) != 2, F.lit(True)))


def reject_unknown(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Whole rows of ``docs`` in a learned language; texts without letters, null texts
    and texts in no learned language go."""
    shipped = _shipped(docs, model)

    def keep(batches):
        for batch in batches:
            for part in parts(batch):
                verdict = shipped.value.judge(part.column("text").to_pylist())["known"]
                yield part.filter(pa.array(verdict))
    return map_batches(docs, keep, docs.schema)
