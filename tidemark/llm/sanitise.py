"""Information-theoretic sanitisation of personal data.

Base spans come from fixed patterns: e-mail addresses, IP addresses, payment cards
with a valid check digit, phone numbers. Their values are the protected entities.
Words that stand beside an entity, within ``NEAR`` words in its line, are terms that may
reveal it; pairs of all words and entities of a text would be too many. Over the whole
corpus the term's disclosure is the share of the entity's information that the term gives
away:

    PMI(term, entity) / IC(entity) = 1 + log2(n(term, entity) / n(term)) / IC(entity)

with n(term) the documents that hold the term, n(term, entity) those in which it stands
beside the entity, and IC(entity) = log2(documents / n(entity)); all are counted in
documents, copies included, so a group of copies weighs alike on both sides. It is 1 for a
term seen only beside the entity. Terms of high disclosure are removed, those below but over
a lower limit are generalised; a term needs ``SUPPORT`` different contexts. What a term is
rated holds wherever it stands: all its occurrences in all whole texts are spans, also in
other lines and in documents without the entity.

A null text is empty: no span. Rows that are equal in id and text get equal spans;
rows of one id with different texts are kept apart by a hash of the text. Texts of
any length are searched whole, and an entity costs no more in a text with many. Other
columns, whatever their names, do not matter; an empty table gives no row.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, map_texts, parts, stored, texts_of

#: Kinds in the order of the span list, the term kinds last.
KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("removed", "generalised")
#: A mail's local part is found from its @, leftwards.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is entered at its start only; other starts match no more than this one.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = regex.compile(r"\p{L}+").finditer
WORDS = regex.compile(r"\p{L}+").findall

OCCURRENCES = "doc_id bigint, mark bigint, term string, start int, end int"
#: Words on either side of an entity, in its line, that are its context.
NEAR = 8
SUPPORT = 3
REMOVE = 0.98
GENERALISE = 0.90
LEAST_LETTERS = 3
#: Slots of the table that says which words need counting.
SLOTS = 1 << 20
#: Words that a task keeps at once.
REMEMBERED = 300_000
REPLACED = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]",
            "removed": "", "generalised": "[TERM]"}

SCHEMA = ("doc_id bigint, mark bigint, n_email bigint, n_ip bigint, n_card bigint, "
          "n_phone bigint, base string, owners array<bigint>, entities array<bigint>, terms array<string>, "
          "contexts array<bigint>")


def emails(text: str) -> list[tuple[int, int]]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        match = DOMAIN.match(text, at)
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if match and start < at:
            found.append((start, match.end()))
            done = match.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]


def cards(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CARD.finditer(text)
            if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]


FINDERS = dict(zip(KINDS, (emails, ips, cards, phones)))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("email", *s) for s in (emails(text) if "@" in text else ())]
    if text.isascii() and not any(map(text.__contains__, "0123456789")):
        return found
    return found + [(kind, *s) for kind in KINDS[1:] for s in FINDERS[kind](text)]


def entity_of(text: str, span: tuple[str, int, int]) -> int:
    """The hash of what a span names."""
    kind, a, b = span
    value = text[a:b].lower() if kind == "email" else _digits(text[a:b])
    return _signed(xxhash.xxh64_intdigest(f"{kind}:{value}".encode()))


def context(text: str, spans: list[tuple[str, int, int]]):
    """(entity, term, context) of words near each span in its line; words that a span covers
    are none."""
    covered = _cover(spans)
    for kind, a, b in spans:
        entity = entity_of(text, (kind, a, b))
        # A window of characters bounds the search in lines without end.
        low = max(text.rfind("\n", 0, a) + 1, a - 40 * NEAR)
        high = text.find("\n", b)
        high = min(len(text) if high < 0 else high, b + 40 * NEAR)
        before = [(m.start() + low, m.end() + low) for m in WORD(text[low:a])][-NEAR:]
        after = [(m.start() + b, m.end() + b) for m in WORD(text[b:high])][:NEAR]
        near = [(s, e) for s, e in before + after if e - s >= LEAST_LETTERS
                and not covered(s, e)]
        if near:
            words = [text[s:e].lower() for s, e in near]
            whole = _signed(xxhash.xxh64_intdigest(" ".join(words).encode()))
            for word in words:
                yield entity, word, whole


def _cover(spans: list[tuple[str, int, int]]) -> Callable[[int, int], bool]:
    """Whether some span overlaps an interval, by bisection."""
    taken: list[tuple[int, int]] = []
    for a, b in sorted((a, b) for _, a, b in spans):
        if taken and a < taken[-1][1]:
            taken[-1] = taken[-1][0], max(taken[-1][1], b)
        else:
            taken.append((a, b))
    begins = [a for a, _ in taken]

    def covered(start: int, end: int) -> bool:
        i = bisect_left(begins, end) - 1
        return i >= 0 and taken[i][1] > start
    return covered


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _mark():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("mark")


def find(docs: DataFrame) -> DataFrame:
    """Base spans of every document, and the words near them."""
    def make():
        def work(batch):
            out: dict[str, list] = {n: [] for n in (
                "base", "owners", "entities", "terms", "contexts",
                *(f"n_{k}" for k in KINDS))}
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                for kind in KINDS:
                    out[f"n_{kind}"].append(sum(s[0] == kind for s in spans))
                out["base"].append(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
                out["owners"].append(sorted({entity_of(text, span) for span in spans}))
                near = sorted(set(context(text, spans))) if spans else []
                for i, name in enumerate(("entities", "terms", "contexts")):
                    out[name].append([row[i] for row in near])
            return {"doc_id": batch.column("doc_id"), "mark": batch.column("mark"), **out}
        return work
    return map_texts(texts_of(docs, _mark()), SCHEMA, make)


def _marked_slots(docs: DataFrame, wanted: DataFrame):
    """A shipped table of a fixed number of slots that says which words may be in ``wanted``
    (term)."""
    slots = np.zeros(SLOTS, bool)
    slot = F.pmod(F.xxhash64("term"), F.lit(SLOTS)).alias("slot")
    # At most as many rows as there are slots come back.
    slots[wanted.select(slot).distinct().toArrow().column("slot").to_numpy()] = True
    return docs.sparkSession.sparkContext.broadcast(np.packbits(slots))


def occurrences(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc_id``, ``mark``, ``term``, ``start`` and ``end`` of every occurrence of the words
    in ``wanted`` (term), and of some others, in all whole texts, outside base spans."""
    marked = _marked_slots(docs, wanted)

    def make():
        open_slots = np.unpackbits(marked.value).astype(bool)
        known: dict[str, bool] = {}

        def may_be(word: str) -> bool:
            found = known.get(word)
            if found is None:
                if len(known) > REMEMBERED:
                    known.clear()
                found = known[word] = bool(
                    open_slots[xxhash.xxh64_intdigest(word.encode(), 42) % SLOTS])
            return found

        def work(batch):
            out: dict[str, list] = {n: [] for n in ("doc_id", "mark", "term", "start", "end")}
            for doc_id, mark, text in zip(*(batch.column(c).to_pylist()
                                            for c in ("doc_id", "mark", "text"))):
                hits = {w for w in map(str.lower, set(WORDS(text))) if may_be(w)}
                if not hits:
                    continue
                covered = _cover(base_spans(text))
                for m in WORD(text):
                    term = m[0].lower()
                    if term in hits and not covered(*m.span()):
                        for name, value in zip(out, (doc_id, mark, term, *m.span())):
                            out[name].append(value)
            return out
        return work
    return map_texts(texts_of(docs, _mark()), OCCURRENCES, make)


def document_counts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``word`` and ``n``, the documents that hold it, for all words in ``wanted`` (term) and
    some others.

    A table of a fixed number of slots says which words are counted at all; every
    document is read. A task adds its documents up before anything is shuffled.
    """
    marked = _marked_slots(docs, wanted)

    def run(batches):
        open_slots = np.unpackbits(marked.value).astype(bool)
        known: dict[str, bool] = {}
        counts: Counter[str] = Counter()
        digest = xxhash.xxh64_intdigest

        def counted() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                names=["word", "n"])
            counts.clear()
            return rows
        for batch in batches:
            for part in parts(batch):
                for text in part.column("text").to_pylist():
                    for word in set(WORDS(text.lower())):
                        wanted = known.get(word)
                        if wanted is None:
                            if len(known) > REMEMBERED:
                                known.clear()
                            wanted = known[word] = bool(
                                open_slots[digest(word.encode(), 42) % SLOTS])
                        if wanted:
                            counts[word] += 1
                if len(counts) > REMEMBERED:
                    yield counted()
        yield counted()
    return (map_batches(texts_of(docs), run, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")))


def revealing(found: DataFrame, docs: DataFrame, support: int = SUPPORT,
              remove: float = REMOVE, generalise: float = GENERALISE) -> DataFrame:
    """``entity``, ``term`` and ``kind`` of the terms that disclose an entity."""
    each = F.explode(F.arrays_zip("entities", "terms", "contexts")).alias("x")
    near = found.filter(F.size("terms") > 0).select(each).groupBy(
        F.col("x.entities").alias("entity"), F.col("x.terms").alias("term"),
        F.col("x.contexts").alias("context")).agg(F.count("*").alias("times"))
    supported = near.groupBy("entity", "term").agg(F.count("*").alias("contexts")).filter(
        F.col("contexts") >= support).select("entity", "term")
    supported = stored(supported, "supported")
    schema = "entity bigint, term string, kind string"
    if supported.isEmpty():
        return docs.sparkSession.createDataFrame([], schema)
    # Documents, each once, in which the pair stands together, and that hold the entity.
    both = found.filter(F.size("terms") > 0).select(F.explode(F.array_distinct(
        F.arrays_zip("entities", "terms"))).alias("x")).groupBy(
        F.col("x.entities").alias("entity"), F.col("x.terms").alias("term")).agg(
        F.count("*").alias("together"))
    together = stored(both.join(supported, ["entity", "term"], "left_semi"), "together")
    alone = found.select(F.explode(F.array_distinct("owners")).alias("entity")).groupBy(
        "entity").agg(F.count("*").alias("holders"))
    counts = document_counts(docs, together)
    total = float(docs.count())
    information = F.greatest(F.lit(1e-9), F.log2(F.lit(total) / F.col("holders")))
    share = F.least(F.lit(1.0), F.col("together") / F.col("n"))
    joined = (together.join(counts, together["term"] == counts["word"]).drop("word")
              .join(alone, "entity")
              .withColumn("disclosure", 1 + F.log2(share) / information))
    kind = F.when(F.col("disclosure") >= remove, F.lit(TERM_KINDS[0])).when(
        F.col("disclosure") >= generalise, F.lit(TERM_KINDS[1]))
    return stored(joined.select("entity", "term", kind.alias("kind"))
                  .filter(F.col("kind").isNotNull()), "revealing")


def spans(docs: DataFrame, **limits) -> DataFrame:
    """One row per document: counts of base spans, their digest, and all spans."""
    found = stored(find(docs), "spans")
    terms = revealing(found, docs, **limits)
    rated = terms.groupBy("term").agg(F.max("kind").alias("kind"))  # removed wins
    places = (occurrences(docs, rated) if not rated.isEmpty() else
              docs.sparkSession.createDataFrame([], OCCURRENCES))
    # Rows that are equal in id and text have equal places.
    extra = (places.join(rated, "term").select("doc_id", "mark", "start", "end", "kind").distinct()
             .groupBy("doc_id", "mark").agg(F.array_sort(F.collect_list(F.struct(
                 F.when(F.col("kind") == TERM_KINDS[0], 0).otherwise(1).alias("nth"),
                 "start", "end", "kind"))).alias("more")))
    extra = extra.select(
        F.col("doc_id").alias("id"), F.col("mark").alias("its"),
        F.array_join(F.transform("more", lambda m: F.concat_ws(
            ":", m["kind"], m["start"], m["end"])), ",").alias("more"))
    both = found.join(extra, found["doc_id"].eqNullSafe(extra["id"])
                      & (found["mark"] == extra["its"]), "left")
    return both.select(
        "doc_id", "mark", *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"),
        F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), "more").alias("spans"))


def apply_spans(text: str, listed: str) -> str:
    """Put each kind's replacement in the place of its spans; where spans overlap, their
    union is replaced once, by the kind that begins first."""
    cuts: list[list] = []
    for a, b, kind in sorted((int(a), int(b), k) for k, a, b in
                             (s.split(":") for s in listed.split(",") if s)):
        if cuts and a < cuts[-1][1]:
            cuts[-1][1] = max(cuts[-1][1], b)
        else:
            cuts.append([a, b, kind])
    out, at = [], 0
    for a, b, kind in cuts:
        out += [text[at:a], REPLACED[kind]]
        at = b
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, **limits) -> DataFrame:
    """Whole rows of ``docs`` with all spans replaced; ``n_chars``, if there, follows."""
    listed = spans(docs, **limits).filter("spans <> ''").select(
        F.col("doc_id").alias("id"), F.col("mark").alias("its"), "spans").distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("own"), _mark(), whole)
    joined = rows.join(listed, rows["own"].eqNullSafe(listed["id"])
                       & (rows["mark"] == listed["its"]), "left")

    extra = "spans"
    while extra in map(str.lower, docs.columns):
        extra += "_"
    at = docs.columns.index("text")
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else -1
    columns = docs.columns

    def run(batches):
        for batch in batches:
            for part in parts(batch):
                rows = pa.Table.from_batches([part])
                marks = rows.column(extra).to_pylist()
                arrays = [rows.column(i).combine_chunks() for i in range(len(columns))]
                if any(marks):
                    texts = [apply_spans(t, m) if m else t for t, m in
                             zip(arrays[at].to_pylist(), marks)]
                    if chars >= 0:
                        counts = arrays[chars].to_pylist()
                        arrays[chars] = pa.array(
                            [len(t) if m else n for t, m, n in zip(texts, marks, counts)],
                            arrays[chars].type)
                    arrays[at] = pa.array(texts, arrays[at].type)
                yield pa.RecordBatch.from_arrays(arrays, names=columns)
    flat = joined.select("whole.*", F.col("spans").alias(extra))
    return map_batches(flat, run, docs.schema)
