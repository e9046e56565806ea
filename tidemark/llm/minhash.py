"""MinHash document fingerprints.

A text's shingles are its runs of five words (fewer words: the whole sequence). Each of
``PERMUTATIONS`` universal hash functions h(x) = a x + b modulo 2^64, whose upper half
counts, orders the shingles anew, and the least value under each makes the signature; the
share of equal components estimates the Jaccard similarity of two texts' shingle sets. A
fingerprint writes sixteen bits of every component in hex.

``neighbours`` compares each text with a successor in id order. Ids are cut into ranges
from a sketch of their distribution; a range's first row also goes to the range before, so
one shuffle brings each row to its successor and no task holds more than its ranges.
``similar`` joins signature bands in Spark and verifies the Jaccard similarity exactly.

A null text is empty and has no shingle; all such texts share one fingerprint. Rows of one
id follow each other by a hash of the text; a null id comes after all others. A single
row is its own successor. Long texts are hashed whole, in blocks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, map_texts, parts, ship, stored, texts_of

PERMUTATIONS = 128
SHINGLE = 5
#: Signature rows in a band, and bands: a pair at 0.8 shares a band in all but 1 of 20,000.
BAND_ROWS = 5
BANDS = 25
SIMILARITY = 0.8
BLOCK = 2048
REMEMBERED = 300_000
LAST = -(1 << 63)

SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word.encode())
        if len(self) < REMEMBERED:
            self[word] = value
        return value


class Sketcher:
    """Signatures of texts, many at once."""

    def __init__(self, permutations: int = PERMUTATIONS, shingle: int = SHINGLE, seed: int = 1):
        rng = np.random.default_rng(seed)
        top = np.iinfo(np.uint64).max
        self.a = rng.integers(1, top, permutations, np.uint64) | np.uint64(1)
        self.b = rng.integers(0, top, permutations, np.uint64)
        self.mix = rng.integers(1, top, shingle, np.uint64) | np.uint64(1)
        self.shingle = shingle
        self.known = _WordHashes()

    def words(self, text: str) -> np.ndarray:
        split = text.split()
        return np.fromiter(map(self.known.__getitem__, split), np.uint64, len(split))

    def shingles(self, words: np.ndarray) -> np.ndarray:
        """32-bit hashes of the shingles of hashed words, in order."""
        if not len(words):
            return words
        size = min(self.shingle, len(words))
        n = len(words) - size + 1
        code = np.full(n, size, np.uint64)
        for k in range(size):
            code += words[k:n + k] * self.mix[k]
        code ^= code >> np.uint64(29)
        code *= np.uint64(0x9E3779B97F4A7C15)
        return code >> np.uint64(32)

    def least(self, groups: list[np.ndarray]) -> np.ndarray:
        """For each group of shingles the least value under each permutation (all ones for none)."""
        sizes = np.array([len(g) for g in groups], np.int64)
        out = np.full((len(groups), len(self.a)), np.iinfo(np.uint64).max, np.uint64)
        some = np.flatnonzero(sizes)
        if not len(some):
            return out
        codes = np.concatenate([groups[i] for i in some])
        ends = np.cumsum(sizes[some])
        block = np.empty((BLOCK, len(self.a)), np.uint64)
        for lo in range(0, len(codes), BLOCK):
            part = codes[lo:lo + BLOCK]
            values = block[:len(part)]
            np.multiply(part[:, None], self.a, out=values)
            values += self.b
            first = int(np.searchsorted(ends, lo, side="right"))
            last = int(np.searchsorted(ends, lo + len(part) - 1, side="right"))
            starts = np.concatenate(([0], ends[first:last] - lo))
            rows = some[first:last + 1]
            out[rows] = np.minimum(out[rows], np.minimum.reduceat(values, starts, axis=0))
        return out

    @staticmethod
    def short(least: np.ndarray) -> np.ndarray:
        """The sixteen bits of each component that a fingerprint holds."""
        return (least >> np.uint64(32)).astype(np.uint16)

    def signature(self, text: str) -> np.ndarray:
        return self.short(self.least([self.shingles(self.words(text))]))[0]


def written(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def edit(text: str, after: str) -> str:
    """The last third of ``text`` replaced by as much of the beginning of ``after``."""
    cut = len(text) // 3
    return text[:len(text) - cut] + after[:cut]


def fingerprint_pairs(sketcher: Sketcher, pairs: list[tuple[str, str]]) -> dict[str, list]:
    """Fingerprints of texts, of their edited texts, and likeness to these and to the successors.

    Successive pairs usually share a text; shingles that a text shares with its edited text
    are hashed once.
    """
    order: dict[str, int] = {}
    for pair in pairs:
        for text in pair:
            order.setdefault(text, len(order))
    words = [sketcher.words(t) for t in order]
    codes = [sketcher.shingles(w) for w in words]
    edited = [edit(a, b) for a, b in pairs]
    shared: dict[int, int] = {}
    rest = []
    own = [order[a] for a, _ in pairs]
    for text, i in zip(edited, own):
        new = sketcher.words(text)
        m = min(len(new), len(words[i]))
        differ = np.flatnonzero(new[:m] != words[i][:m])
        same = int(differ[0]) if len(differ) else m
        fresh = sketcher.shingles(new)
        keep = same - sketcher.shingle + 1
        if keep < 1 or i in shared:
            # No common shingle, or the text has been split already for an equal text.
            rest.append((-1, fresh))
        else:
            shared[i] = keep
            rest.append((i, fresh[keep:]))
    heads = sketcher.least([c[:shared.get(i, 0)] for i, c in enumerate(codes)])
    tails = sketcher.least([c[shared.get(i, 0):] for i, c in enumerate(codes)])
    whole = sketcher.short(np.minimum(heads, tails))
    after = sketcher.least([r for _, r in rest])
    for k, (i, _) in enumerate(rest):
        if i >= 0:
            after[k] = np.minimum(after[k], heads[i])
    after = sketcher.short(after)
    follower = [order[b] for _, b in pairs]
    hexes = {i: written(whole[i]) for i in set(own)}
    return {
        "n_chars": [len(a) for a, _ in pairs],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        "fingerprint": [hexes[i] for i in own],
        "edited_fingerprint": [written(s) for s in after],
        "near_edited": (whole[own] == after).mean(axis=1) if pairs else [],
        "near_next": (whole[own] == whole[follower]).mean(axis=1) if pairs else [],
    }


def successors(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows (range, extra, doc_id, text), sorted inside partitions by descending id in each
    range; the row marked ``extra`` that ends a range is the successor of its last row."""
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or 4 * width
    key = F.coalesce("doc_id", F.lit(LAST))
    rows = texts_of(docs).select("doc_id", "text", key.alias("key"),
                                 F.xxhash64("text").alias("mark"))
    found = rows.agg(F.percentile_approx(
        "key", F.array(*[F.lit(i / ranges) for i in range(1, ranges)]), F.lit(20 * ranges))).first()
    bounds = np.unique(np.array(found[0] or [], np.int64))
    ship(spark)

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy(), side="left").astype(np.int32))

    # One row for each range: its first one, highest id and least mark.
    tops = (rows.select("key", "mark").withColumn("range", place("key")).groupBy("range")
            .agg(F.min(F.struct((F.lit(-1) - F.col("key")).alias("down"), "mark")).alias("top"))
            .orderBy("range").collect())
    target = [(-1 - tops[i]["top"]["down"], tops[i]["top"]["mark"],
               tops[(i + 1) % len(tops)]["range"]) for i in range(len(tops))]
    firsts = spark.createDataFrame(target, "k bigint, m bigint, before int")
    placed = rows.withColumn("range", place("key")).join(
        F.broadcast(firsts), (F.col("key") == F.col("k")) & (F.col("mark") == F.col("m")), "left")
    copies = F.array(F.struct(F.col("range"), F.lit(0).alias("extra")),
                     F.struct(F.col("before").alias("range"), F.lit(1).alias("extra")))
    dealt = placed.select("doc_id", "text", "key", "mark", F.explode(copies).alias("at")).filter(
        F.col("at.range").isNotNull())
    return (dealt.select(F.col("at.range").alias("range"), F.col("at.extra").alias("extra"),
                         "doc_id", "text", "key", "mark")
            .repartition(width, "range")
            .sortWithinPartitions("range", "extra", F.col("key").desc(), "mark")
            .select("range", "extra", "doc_id", "text"))


def neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, with likeness to it and to the next text."""
    def run(batches):
        sketcher = Sketcher()
        held = None
        for batch in batches:
            for part in parts(batch):
                rows = list(zip(*(part.column(c).to_pylist()
                                  for c in ("range", "extra", "doc_id", "text"))))
                rows = ([held] if held else []) + rows
                held = rows[-1]
                pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[1] and a[0] == b[0]]
                out = fingerprint_pairs(sketcher, [(a[3], b[3]) for a, b in pairs])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a[2] for a, _ in pairs], pa.int64()),
                     pa.array(out["n_chars"], pa.int64()),
                     *(pa.array(out[n], pa.string()) for n in
                       ("edited_sha256", "fingerprint", "edited_fingerprint")),
                     *(pa.array(out[n], pa.float64()) for n in ("near_edited", "near_next"))],
                    names=[c.split()[0] for c in SCHEMA.split(", ")])
    return map_batches(successors(docs), run, SCHEMA)


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """``doc_id``, ``fingerprint``, ``bands`` (a hash of each band) and ``shingles`` (the sorted
    set of shingle hashes) of every text."""
    def make():
        sketcher = Sketcher()

        def work(batch):
            texts = batch.column("text").to_pylist()
            codes = [sketcher.shingles(sketcher.words(t)) for t in texts]
            short = sketcher.short(sketcher.least(codes))
            keys = [[xxhash.xxh64_intdigest(s[k * rows:(k + 1) * rows].tobytes(), k) >> 1
                     for k in range(bands)] for s in short]
            return {"doc_id": batch.column("doc_id"), "fingerprint": [written(s) for s in short],
                    "bands": keys,
                    "shingles": [np.unique(c).astype(np.int64).tolist() for c in codes]}
        return work
    return map_texts(texts_of(docs),
                     "doc_id bigint, fingerprint string, bands array<bigint>, "
                     "shingles array<bigint>", make)


def similar(docs: DataFrame, at_least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Membership (doc_id, class_id) and verified pairs (left_id, right_id, similarity).

    Texts with equal shingle sets are a class, named by its smallest id; pairs are between
    classes that share a band and whose Jaccard similarity is at least ``at_least``. Texts
    without a word are one class. Null ids have no class.
    """
    marked = stored(signatures(docs).filter(F.col("doc_id").isNotNull())
                    .withColumn("set", F.sha2(F.array_join("shingles", ","), 256)), "signatures")
    named = stored(marked.groupBy("set").agg(F.min("doc_id").alias("class_id")), "named")
    members = marked.join(named, "set").select("doc_id", "class_id")
    heads = stored(marked.join(named, "set").filter(F.col("doc_id") == F.col("class_id"))
                   .dropDuplicates(["class_id"]).select("class_id", "bands", "shingles"), "heads")
    dealt = heads.select("class_id", F.size("shingles").alias("n"),
                         F.posexplode("bands").alias("nth", "band"))
    left = dealt.select(F.col("class_id").alias("left_id"), F.col("n").alias("n1"), "nth", "band")
    right = dealt.select(F.col("class_id").alias("right_id"), F.col("n").alias("n2"),
                         "nth", "band")
    # Sets whose sizes differ too much cannot be that similar.
    near = (left.join(right, ["nth", "band"]).filter(
        (F.col("left_id") < F.col("right_id"))
        & (F.least("n1", "n2") >= at_least * F.greatest("n1", "n2")))
        .select("left_id", "right_id").distinct())
    sets = heads.select("class_id", "shingles")
    both = (near.join(sets.withColumnsRenamed({"class_id": "left_id", "shingles": "s1"}), "left_id")
            .join(sets.withColumnsRenamed({"class_id": "right_id", "shingles": "s2"}), "right_id"))
    common = F.size(F.array_intersect("s1", "s2"))
    score = F.when(F.size("s1") + F.size("s2") == 0, F.lit(1.0)).otherwise(
        common / (F.size("s1") + F.size("s2") - common))
    pairs = both.select("left_id", "right_id", score.alias("similarity")).filter(
        F.col("similarity") >= at_least)
    return members, pairs
