"""Spelling variants by a bit-sliced position index.

Words are counted over all texts; two words are near if one inserted, deleted or replaced
code point turns one into the other. Near words share a half: of two words of which the
shorter has n code points, an edit behind the first n // 2 leaves these as a common
beginning, any other edit leaves the last n - n // 2 as a common ending. So words meet in
groups keyed by (n, beginning) and (n, ending), and a pair belongs to its beginning's group
if it has one. A group too large for one task is split the same way, by a half of what its
words do not share yet, until one code point is left; that bounds a group by the alphabet.

In a group each (position, letter) has a bitset of the words with that letter there. A word
is looked up in all others at once: reading it letter by letter, one bitset holds the words
without an error so far and three hold those with one, read in step, one position ahead or
one behind. Bits are ordered by falling count and rising spelling, so the lowest bit of the
result is the word's form and the number of bits its near words; no pair is ever written.

Null texts have no word. Rows without an id are altered as if the id were empty. Rows are
counted as often as they occur; ties between forms go to the smaller word in code-point
order; texts and words of any length are read whole. Other columns and empty tables change
nothing.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, parts, stored, texts_of

LEAST_LETTERS = 5
LEAST_COUNT = 3
#: A run of letters loses one where this divides its checksum.
ALTER = 97
#: A word's form occurs at least so many times as often.
AS_OFTEN = 2
#: Words in a group before it is split further.
CROWD = 2048
#: Different words that a task counts before it hands them on.
REMEMBERED = 200_000
#: Maximal runs; shorter ones never become words.
RUNS = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}").findall


def altered(doc_id: int | None, run: str) -> str:
    """The word that a lower-cased run of a document stands for."""
    own = "" if doc_id is None else doc_id
    check = zlib.crc32(f"{own}:{run}".encode())
    if check % ALTER:
        return run
    at = check % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` of every word of at least ``LEAST_LETTERS`` code points, altered as
    documents alter it. Tasks add up before anything is shuffled."""
    def run(batches):
        total: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())],
                names=["word", "n"])
            total.clear()
            return rows
        for batch in batches:
            for part in parts(batch):
                for doc_id, text in zip(part.column("doc_id").to_pylist(),
                                        part.column("text").to_pylist()):
                    found = Counter(RUNS(text.encode().lower().decode()))
                    for one, n in found.items():
                        word = altered(doc_id, one)
                        if len(word) >= LEAST_LETTERS:
                            total[word] += n
                    if len(total) > REMEMBERED:
                        yield counted()
        yield counted()
    return (map_batches(texts_of(docs), run, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")))


# --- one group ----------------------------------------------------------------------------

class PositionIndex:
    """Bitsets over words (in the order of preference) by position and letter."""

    def __init__(self, words: list[str]):
        self.words = words
        self.has: dict[tuple[int, str], int] = {}
        self.long: dict[int, int] = {}
        for i, word in enumerate(words):
            bit = 1 << i
            self.long[len(word)] = self.long.get(len(word), 0) | bit
            for place in enumerate(word):
                self.has[place] = self.has.get(place, 0) | bit

    def near(self, word: str, shorter: int, apart: int) -> int:
        """The words at one edit from ``word``, where the shorter of both has ``shorter`` code
        points and, if ``apart`` is not 0, they differ within the first ``apart``."""
        has = self.has.get
        exact = (1 << len(self.words)) - 1
        replaced = ahead = behind = 0
        for i, letter in enumerate(word):
            if i == apart and apart:
                same = exact
            here = has((i, letter), 0)
            # A letter more in the other word, read one position ahead from here on; a letter
            # more in this one, read one behind; or one in the place of another.
            ahead = (ahead | exact) & has((i + 1, letter), 0)
            behind = behind & has((i - 1, letter), 0) | exact
            replaced = replaced & here | exact & ~here
            exact &= here
        if apart == len(word):
            same = exact
        n, long = len(word), self.long.get
        hits = (replaced & long(n, 0)) if n == shorter else 0
        if n == shorter:
            hits |= (ahead | exact) & long(n + 1, 0)
        if n == shorter + 1:
            hits |= behind & long(n - 1, 0)
        return hits & ~same if apart else hits


def looked_up(words: list[str], counts: list[int], shorter: int, apart: int
              ) -> tuple[list[str], list[int], list[str], list[int]]:
    """``word``, ``n_near``, ``best`` and ``best_n`` of the words of a group that have near ones."""
    order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
    index = PositionIndex([words[i] for i in order])
    out: tuple[list, list, list, list] = ([], [], [], [])
    for word in index.words:
        hits = index.near(word, shorter, apart)
        if hits:
            best = order[(hits & -hits).bit_length() - 1]
            for column, value in zip(out, (word, hits.bit_count(), words[best], counts[best])):
                column.append(value)
    return out


# --- groups -------------------------------------------------------------------------------

def _halves(words: DataFrame) -> DataFrame:
    """Every word in its groups: ``shorter``, the code points that all share in front (``x``)
    and behind (``y``), ``apart``, and the shared text itself."""
    size = F.char_length("word")
    both = F.explode(F.array(size, size - 1)).alias("shorter")
    # No word is shorter than the least, so a pair's shorter word is not either.
    each = (words.select("word", "n", both).filter(F.col("shorter") >= LEAST_LETTERS)
            .withColumn("half", F.expr("shorter div 2")))
    nothing = F.lit(0)
    sides = F.array(
        F.struct(F.col("half").alias("x"), nothing.alias("y"), nothing.alias("apart")),
        F.struct(nothing.alias("x"), (F.col("shorter") - F.col("half")).alias("y"),
                 F.col("half").alias("apart")))
    return _keyed(each.select("word", "n", "shorter", F.explode(sides).alias("s"))
                  .select("word", "n", "shorter", "s.*"))


def _keyed(rows: DataFrame) -> DataFrame:
    ahead = F.substring(F.col("word"), F.lit(1), F.col("x"))
    behind = F.substring(F.col("word"), F.char_length("word") - F.col("y") + 1, F.col("y"))
    return rows.withColumn("ahead", ahead).withColumn("behind", behind)


_GROUP = ["shorter", "x", "y", "apart", "ahead", "behind"]


def _split(rows: DataFrame) -> DataFrame:
    """Rows of crowded groups in groups that share half of the rest besides."""
    rest = F.col("shorter") - F.col("x") - F.col("y")
    front = F.expr("(shorter - x - y) div 2")
    sides = F.array(
        F.struct((F.col("x") + front).alias("x"), F.col("y").alias("y"), F.col("apart").alias("apart")),
        F.struct(F.col("x").alias("x"), (F.col("y") + rest - front).alias("y"),
                 (F.col("x") + front).alias("apart")))
    return _keyed(rows.select("word", "n", "shorter", F.explode(sides).alias("s"))
                  .select("word", "n", "shorter", "s.*"))


def groups(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Words in groups of at most ``crowd``, or of words that differ in one place at most."""
    rows, whole = _halves(words), []
    while True:
        sizes = rows.groupBy(*_GROUP).agg(F.count("*").alias("words"))
        splits = (F.col("words") > crowd) & (F.col("shorter") - F.col("x") - F.col("y") > 1)
        large = stored(sizes.filter(splits).select(*_GROUP), "crowded")
        if large.isEmpty():
            whole.append(rows)
            break
        whole.append(rows.join(large, _GROUP, "left_anti"))
        rows = _split(rows.join(large, _GROUP, "left_semi"))
    found = whole[0]
    for more in whole[1:]:
        found = found.unionByName(more)
    return found


def near_words(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``word``, ``n_near``, ``best`` and ``best_n`` (its near word of largest count) of every
    word of ``words`` (word, n) that has near ones."""
    width = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = groups(words, crowd).select("word", "n", *_GROUP)
    dealt = rows.repartition(width, *_GROUP).sortWithinPartitions(*_GROUP)

    def run(batches):
        def members():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("word", "n", *_GROUP)))
        out: list[list] = [[], [], [], []]
        for key, group in groupby(members(), key=lambda r: r[2:]):
            rows = list(group)
            if len(rows) > 1:
                more = looked_up([r[0] for r in rows], [r[1] for r in rows], key[0], key[3])
                for column, values in zip(out, more):
                    column.extend(values)
            if len(out[0]) > 50_000:
                yield batch_of(out)
                out = [[], [], [], []]
        yield batch_of(out)
    found = map_batches(dealt, run, "word string, n_near bigint, best string, best_n bigint")
    # A pair meets in one group only, so counts add up.
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best"))).alias("first")).select(
        "word", "n_near", F.col("first.best").alias("best"), (-F.col("first.less")).alias("best_n"))


def batch_of(columns: list[list]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "n_near", "best", "best_n"])


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of a table (word, form) without cycles, by pointer doubling: the
    rounds are the logarithm of the longest chain."""
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        nxt = at.select(F.col("word").alias("by"), F.col("root").alias("further"))
        at = stored(at.join(nxt, at["root"] == nxt["by"], "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")), "roots")
        if at.filter("moved").isEmpty():
            return at.select("word", "root")
        at = at.drop("moved")


def variants(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """One row per word: its form, the root of its chain of forms, and counts."""
    words = stored(word_counts(docs).filter(F.col("n") >= LEAST_COUNT), "words")
    near = near_words(words, crowd).withColumnRenamed("word", "its")
    often = F.col("best_n") >= AS_OFTEN * F.col("n")
    placed = stored(words.join(near, words["word"] == near["its"], "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(often, F.col("best")).alias("form"),
        F.when(often, F.col("best_n")).alias("form_n")), "forms")
    chained = roots(placed.filter("form IS NOT NULL")).withColumnRenamed("word", "its")
    return placed.join(chained, placed["word"] == chained["its"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
