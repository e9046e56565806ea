"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint bit is set where more than half of a text's shingle hashes have it.
Fingerprints link when at most ``LIMIT`` bits differ. To find them the 64 bits are
dealt into parts, bits that vary together into the same part, and each part ``i``
gets a threshold ``t_i``, -1 for a part that is not probed. When the thresholds add
up to ``LIMIT - parts + 1``, any two linked fingerprints differ in at most ``t_i``
bits of some part ``i``. Number of parts and thresholds come from a dynamic programme
over costs estimated from a sample of fingerprints; the choice changes the work,
never the result.

Only different fingerprints are compared, so exact copies cost one row. Fingerprints
that agree on a probed part meet in a run of the key. A key with many fingerprints is
dealt in blocks, and every pair of blocks is one small run: no task holds a key, and
of a run's links only a spanning forest leaves it.

A null text is empty; all texts without a word have fingerprint zero and are linked
like any other. Repeated rows and ids get the component of their fingerprint. A
component made of null ids alone has a null id.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, map_texts, stored, texts_of
from tidemark.llm.components import components

BITS = 64
LIMIT = 3
SHINGLE = 3
SEED = 42
#: Fingerprints that the estimate of costs looks at; nothing else is sampled.
SAMPLE = 4096
#: Fingerprints in a block of a key that many share.
BLOCK = 1024
#: Keys of a part that one fingerprint may be dealt by.
MOST_KEYS = 2000
#: Cost of a row that is dealt out, in comparisons of two fingerprints.
ROW_COST = 400


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The majority of each bit over the XXH64 values of all shingles, repeats included."""
    words = text.encode().lower().split()  # ASCII letters and white space
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[:n].tolist()
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, stops)])
    rows = np.frombuffer(raw, np.uint8).reshape(n, 8)
    total = np.zeros(BITS, np.int64)
    for lo in range(0, n, 255):  # a byte holds the count of 255 rows
        total += np.add.reduce(np.unpackbits(rows[lo:lo + 255], axis=1), axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text) and ``fp``, the fingerprint as a signed
    64-bit number."""
    def make():
        def work(batch):
            found = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            return {"doc_id": batch.column("doc_id"), "mark": batch.column("mark"),
                    "fp": pa.array(np.array(found, np.uint64).view(np.int64))}
        return work
    return map_texts(texts_of(docs, _mark()), "doc_id bigint, mark bigint, fp bigint", make)


def _mark():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("mark")


@dataclass
class Probe:
    """Positions of the bits of a part, and how many of them may differ."""

    bits: list[int]
    threshold: int


def _parts(sample: np.ndarray, n: int) -> list[list[int]]:
    """``n`` parts of nearly equal width; a bit joins the part it varies with most."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float)
    spread = bits - bits.mean(axis=0) if len(bits) else bits
    scale = np.sqrt((spread ** 2).sum(axis=0))
    scale[scale == 0] = 1
    tied = np.abs(spread.T @ spread) / np.outer(scale, scale)
    np.fill_diagonal(tied, 0)
    room = [BITS // n + (i < BITS % n) for i in range(n)]
    free, parts = set(range(BITS)), []
    for size in room:
        # Begin with the free bit least tied to the others, then add its relatives.
        first = min(free, key=lambda b: (tied[b, sorted(free)].sum(), b))
        part = [first]
        free.discard(first)
        while len(part) < size:
            best = max(free, key=lambda b: (tied[b, part].sum(), -b))
            part.append(best)
            free.discard(best)
        parts.append(sorted(part))
    return parts


def _meetings(sample: np.ndarray, bits: list[int], threshold: int) -> float:
    """How often two fingerprints of the sample share a key of the part, on average."""
    mask = np.uint64(sum(1 << b for b in bits))
    masked, near, pairs = sample & mask, 0, 0
    for lo in range(0, len(masked), 256):
        apart = np.bitwise_count(masked[lo:lo + 256, None] ^ masked[None, :])
        for d in range(threshold + 1):
            near += int((apart == d).sum()) * comb(len(bits) - d, threshold - d)
        pairs += apart.size
    near, pairs = near - len(masked) * comb(len(bits), threshold), pairs - len(masked)
    chance = comb(len(bits), threshold) / 2.0 ** (len(bits) - threshold)
    return max(chance, near / pairs if pairs > 0 else 0.0)


def plan_probes(sample: np.ndarray, n: int, limit: int = LIMIT) -> list[Probe]:
    """The cheapest parts and thresholds for ``n`` fingerprints."""
    best: tuple[float, list[Probe]] | None = None
    for m in range(1, limit + 2):
        parts = _parts(sample, m)
        budget = limit - m + 1
        # table[s]: least cost of the parts so far with thresholds adding up to s.
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for k, part in enumerate(parts):
            grown: dict[int, tuple[float, list[int]]] = {}
            for threshold in range(-1, limit + 1):
                cost = 0.0
                if threshold >= 0:
                    if comb(len(part), threshold) > MOST_KEYS:
                        continue
                    cost = (ROW_COST * n * comb(len(part), threshold)
                            + _meetings(sample, part, threshold) * n * n / 2)
                for total, (before, chosen) in table.items():
                    step = (before + cost, [*chosen, threshold])
                    if total + threshold not in grown or step < grown[total + threshold]:
                        grown[total + threshold] = step
            table = grown
        if budget in table:
            cost, chosen = table[budget]
            if best is None or cost < best[0]:
                best = (cost, [Probe(p, t) for p, t in zip(parts, chosen)])
    return [p for p in best[1] if p.threshold >= 0]


def probe_keys(probes: list[Probe]) -> list[tuple[int, int]]:
    """(number, mask) of each key: a part's bits less as many as may differ there."""
    masks = []
    for probe in probes:
        for out in combinations(probe.bits, probe.threshold):
            masks.append(sum(1 << b for b in probe.bits if b not in out))
    return list(enumerate(masks))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _forest(fps: np.ndarray, limit: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links among a few fingerprints (positions)."""
    left, right = [], []
    todo = np.arange(len(fps))
    while len(todo):
        front, todo = todo[:1], todo[1:]
        while len(front) and len(todo):
            near = np.bitwise_count(fps[todo][None, :] ^ fps[front][:, None]) <= limit
            hit = near.any(axis=0)
            left.extend(front[near.argmax(axis=0)[hit]].tolist())
            right.extend(todo[hit].tolist())
            front, todo = todo[hit], todo[~hit]
    return left, right


def _links(rows: DataFrame, limit: int) -> DataFrame:
    """Verified links of sorted rows (probe, key, a, b, fp): a run is a small group."""
    def run(batches):
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            if not table.num_rows:
                continue
            cols = np.stack([table.column(c).to_numpy() for c in ("probe", "key", "a", "b")])
            change = np.flatnonzero((cols[:, 1:] != cols[:, :-1]).any(axis=0)) + 1
            last = int(change[-1]) if len(change) else 0
            yield _run_links(table.slice(0, last), change[:-1], limit)
            rest = table.slice(last)
        if rest is not None and rest.num_rows:
            yield _run_links(rest, np.zeros(0, np.int64), limit)
    return map_batches(rows, run, "u bigint, v bigint")


def _run_links(table: pa.Table, change: np.ndarray, limit: int) -> pa.RecordBatch:
    fps = table.column("fp").to_numpy().astype(np.int64).view(np.uint64)
    starts = np.concatenate(([0], change)).astype(np.int64)
    sizes = np.diff(np.concatenate((starts, [len(fps)]))).astype(np.int64)
    run = np.repeat(np.arange(len(sizes)), sizes)
    u, v = [], []
    small = int(sizes[sizes <= 8].max(initial=0))
    for step in range(1, small):  # short runs: all of them at once
        near = np.flatnonzero((run[step:] == run[:-step]) & (sizes[run[step:]] <= 8)
                              & (np.bitwise_count(fps[step:] ^ fps[:-step]) <= limit))
        u.append(fps[near])
        v.append(fps[near + step])
    for start, size in zip(starts[sizes > 8], sizes[sizes > 8]):
        part = fps[start:start + size]
        left, right = _forest(part, limit)
        u.append(part[left])
        v.append(part[right])
    both = [np.concatenate(x).view(np.int64) if x else np.zeros(0, np.int64) for x in (u, v)]
    keep = both[0] != both[1]
    return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in both], names=["u", "v"])


def links(distinct: DataFrame, limit: int = LIMIT, block: int = BLOCK) -> DataFrame:
    """Links (u, v) whose components are those of all fingerprints at most ``limit`` apart.

    ``distinct`` is a stored table with one row for each ``fp``.
    """
    spark = distinct.sparkSession
    n = distinct.count()
    drawn = distinct.orderBy(F.xxhash64("fp")).limit(SAMPLE).toArrow().column("fp").to_numpy()
    keys = probe_keys(plan_probes(drawn.astype(np.int64).view(np.uint64), n, limit))
    # One small expression whatever the number of keys: the masks are an array literal.
    masks = F.array(*[F.lit(_signed(m)).cast("bigint") for _, m in keys])
    dealt = distinct.select("fp", F.posexplode(masks).alias("probe", "mask")).select(
        "fp", "probe", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    crowded = (dealt.groupBy("probe", "key").agg(F.count("*").alias("n"))
               .filter(F.col("n") > block)
               .select("probe", "key", F.ceil(F.col("n") / block).alias("blocks")))
    crowded = stored(crowded, "crowded")
    rows = dealt.select("fp", "probe", "key", F.lit(0).cast("bigint").alias("a"),
                        F.lit(0).cast("bigint").alias("b"))
    if not crowded.isEmpty():
        own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks"))
        joined = dealt.join(crowded, ["probe", "key"], "left").withColumn(
            "own", F.when(F.col("blocks").isNull(), F.lit(0)).otherwise(own))
        joined = joined.withColumn("other", F.explode(
            F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("blocks"), F.lit(1)) - 1)))
        rows = joined.select("fp", "probe", "key", F.least("own", "other").alias("a"),
                             F.greatest("own", "other").alias("b"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = (rows.repartition(width, "probe", "key", "a", "b")
                   .sortWithinPartitions("probe", "key", "a", "b", "fp"))
    return _links(sorted_rows, limit).distinct()


def classes(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``mark``, ``fp`` and ``root``, the least fingerprint of its component."""
    marked = stored(fingerprints(docs), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct, limit))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        F.col("fp").alias("its"), "least", F.coalesce("root", "fp").alias("root"))
    lowest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(placed.join(lowest, "root").select("its", "root", "component_id"), "classes")
    return marked.join(named, marked["fp"] == named["its"], "left").drop("its")


def near_duplicates(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``fingerprint`` in hex and ``component_id`` of every document: the
    smallest ``doc_id`` that links of at most ``limit`` different bits reach."""
    return classes(docs, limit).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Whole rows of ``docs``, one for each component: the one with the smallest id.

    A null id comes after all others. Rows that share the id differ by the hash of
    their text, the smallest stays; of equal rows one.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    # Hashes are never null, so the join and the last step share one shuffle.
    own = F.xxhash64(F.col("doc_id").cast("bigint")).alias("own")
    rows = docs.select(own, _mark(), whole)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "mark")
    chosen = classes(docs, limit).groupBy("root").agg(F.min(order).alias("first")).select(
        F.xxhash64("first.doc_id").alias("own"), F.col("first.mark").alias("mark"))
    kept = rows.join(chosen, ["own", "mark"], "left_semi")
    return kept.groupBy("own", "mark").agg(F.first("whole").alias("whole")).select("whole.*")
