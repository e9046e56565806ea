"""Exact Jaccard join of shingle sets by vertical partitioning.

A set holds a text's different runs of five words (fewer words: the whole sequence), as
64-bit hashes. All shingles have one global order, rare ones first: how frequent a shingle
is comes from counts by hash slot over the whole table, in a table of fixed size, so the
order is the same in every task and any order gives the same result. The order is cut into
``FRAGMENTS`` ranges that hold about as many shingles each, and with it every set into
segments. Overlaps are counted segment by segment and summed for each pair.

Which pairs are counted: sets that are this similar share one of the first shingles (their
prefix), so the prefixes, about a fifth of all shingles, are grouped by shingle. A pair goes
on if sizes and positions allow it and the number of shared prefix shingles, a first partial
overlap, leaves room for the rest. Equal sets are one class and are compared as one. Before that each
class is tried against one hub: of the classes that it shares MinHash bands with, the one
whose rarest shingle is most frequent, as the text that a family of near copies was made
from has no shingle of its own. Of the pairs that are left open, each class is first counted
with the best one of each other component, and what that joins is not counted again; at last
all that is still open is. So a family costs links, not pairs. A shingle that very many
prefixes hold is dealt in blocks, every pair of blocks a group of its own.

Classes are told apart by 64-bit hashes of whole sets. A null text is empty; texts without a
word link with nothing. Repeated rows and ids are in the class of their text, a component of
null ids alone has a null id. Texts of any length are read whole; other columns, whatever
their names, and an empty table change nothing.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, map_texts, parts, stored, texts_of
from tidemark.llm.components import components

SHINGLE = 5
PERCENT = 80
FRAGMENTS = 16
#: Slots of the counts that order shingles, and rows in which they are shipped.
SLOTS = 1 << 20
CHUNKS = 64
#: Bits of an order key that say how frequent its slot is; the others are the hash.
BAND_SHIFT = 56
#: Classes that share a prefix shingle before they are dealt in blocks.
CROWD = 1024
HUB_BANDS, HUB_ROWS = 6, 3
#: Rounds in which a class is counted with the best one of each other component.
ROUNDS = 3
REMEMBERED = 200_000
BLOCK = 1 << 16
#: Slots of the table that says which documents a verification reads.
WANTED = 1 << 22


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = value
        return value


class Shingles:
    """Sets of shingle hashes of texts."""

    def __init__(self, size: int = SHINGLE):
        drawn = np.random.default_rng(13)
        top = np.iinfo(np.uint64).max
        self.size = size
        self.mix = drawn.integers(1, top, size, np.uint64) | np.uint64(1)
        self.a = drawn.integers(1, top, HUB_BANDS * HUB_ROWS, np.uint64) | np.uint64(1)
        self.b = drawn.integers(0, top, HUB_BANDS * HUB_ROWS, np.uint64)
        self.known = _WordHashes()

    def of(self, text: str) -> np.ndarray:
        split = text.encode().lower().split()  # ASCII letters and white space
        words = np.fromiter(map(self.known.__getitem__, split), np.uint64, len(split))
        if not len(words):
            return words
        size = min(self.size, len(words))
        n = len(words) - size + 1
        code = np.full(n, size, np.uint64)
        for k in range(size):
            code += words[k:n + k] * self.mix[k]
            code ^= code >> np.uint64(31)
        code *= np.uint64(0x9E3779B97F4A7C15)
        return np.unique(code ^ code >> np.uint64(29))

    def heads(self, codes: np.ndarray) -> list[int]:
        """Hashes of the MinHash bands of a set."""
        least = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for lo in range(0, len(codes), BLOCK):
            least = np.minimum(least, (codes[lo:lo + BLOCK, None] * self.a + self.b).min(axis=0))
        return [xxhash.xxh64_intdigest(least[k * HUB_ROWS:(k + 1) * HUB_ROWS].tobytes(), k) >> 1
                for k in range(HUB_BANDS)]


# --- the global order ---------------------------------------------------------------------

def slot_bands(docs: DataFrame, size: int = SHINGLE) -> np.ndarray:
    """How frequent the shingles of each slot are: eight steps for each doubling."""
    def count(batches):
        shingles = Shingles(size)
        counts = np.zeros(SLOTS, np.uint32)
        for batch in batches:
            for part in parts(batch):
                codes = [shingles.of(t) for t in part.column("text").to_pylist()]
                if codes:
                    at = (np.concatenate(codes) & np.uint64(SLOTS - 1)).astype(np.int64)
                    counts += np.bincount(at, minlength=SLOTS).astype(np.uint32)
        pack = zstandard.ZstdCompressor(level=1).compress
        rows = [(i, pack(c.tobytes())) for i, c in enumerate(np.split(counts, CHUNKS)) if c.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
            names=["chunk", "counts"])

    def add(batches):
        found: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for chunk, packed in zip(*(c.to_pylist() for c in batch.columns)):
                counts = np.frombuffer(unpack(packed), np.uint32).astype(np.int64)
                found[chunk] = found[chunk] + counts if chunk in found else counts
        bands = [np.minimum(255, 8 * np.log2(1 + c)).astype(np.uint8).tobytes()
                 for c in found.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.keys(), pa.int32()), pa.array(bands, pa.binary())],
            names=["chunk", "counts"])
    schema = "chunk int, counts binary"
    each = map_batches(texts_of(docs).select("text"), count, schema)
    bands = np.zeros((CHUNKS, SLOTS // CHUNKS), np.uint8)
    # A row for each chunk: the whole table is SLOTS bytes.
    for chunk, packed in map_batches(each.repartition(CHUNKS, "chunk"), add, schema).collect():
        bands[chunk] = np.frombuffer(packed, np.uint8)
    return bands.ravel()


def ordered(codes: np.ndarray, bands: np.ndarray) -> np.ndarray:
    """The sorted order keys of a set."""
    band = bands[(codes & np.uint64(SLOTS - 1)).astype(np.int64)].astype(np.uint64)
    return np.sort(band << np.uint64(BAND_SHIFT) | codes >> np.uint64(64 - BAND_SHIFT))


def cuts(bands: np.ndarray, fragments: int = FRAGMENTS) -> np.ndarray:
    """Order keys at which fragments begin, so that all hold about as many shingles."""
    mass = np.bincount(bands, np.exp2(bands / 8) - 1, 256)
    upto = np.concatenate(([0], np.cumsum(mass)))
    out = []
    for k in range(1, fragments):
        goal = upto[-1] * k / fragments
        band = min(255, int(np.searchsorted(upto, goal, side="right")) - 1)
        share = (goal - upto[band]) / mass[band] if mass[band] else 0
        out.append(band << BAND_SHIFT | min(int(share * (1 << BAND_SHIFT)), (1 << BAND_SHIFT) - 1))
    return np.array(out, np.uint64)


def prefix_length(n, percent: int = PERCENT):
    """Shingles in front of a set of ``n`` of which two similar sets share one."""
    return n - (percent * n + 99) // 100 + 1


# --- pairs --------------------------------------------------------------------------------

def _classes(docs: DataFrame, shipped, size: int, percent: int, keep: tuple[str, ...] = ()
             ) -> DataFrame:
    """``doc_id``, ``cls`` (the hash of its set), ``n``, ``rare`` (the place of its rarest shingle
    in the order), ``prefix`` and ``heads`` of each document, and its bigint columns ``keep``."""
    def make():
        shingles = Shingles(size)

        def work(batch):
            out: dict[str, list] = {"cls": [], "n": [], "rare": [], "prefix": [], "heads": []}
            for text in batch.column("text").to_pylist():
                codes = shingles.of(text)
                keys = ordered(codes, shipped.value)
                out["cls"].append(_class_of(keys))
                out["n"].append(len(keys))
                out["rare"].append(int(keys[0] >> np.uint64(1)) if len(keys) else None)
                out["prefix"].append(
                    keys[:prefix_length(len(keys), percent)].view(np.int64) if len(keys) else [])
                out["heads"].append(shingles.heads(codes) if len(keys) else [])
            return {**{c: batch.column(c) for c in ("doc_id", *keep)}, **out}
        return work
    kept = "".join(f"{c} bigint, " for c in ("doc_id", *keep))
    return map_texts(texts_of(docs, *keep), kept + "cls bigint, n bigint, rare bigint, "
                     "prefix array<bigint>, heads array<bigint>", make)


def _class_of(keys: np.ndarray) -> int | None:
    if not len(keys):
        return None
    value = xxhash.xxh64_intdigest(keys.tobytes())
    return value - (1 << 64) if value >> 63 else value


def _hub_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """One pair (u, v) for each class that shares a MinHash band with another one whose rarest
    shingle is more frequent: with that of which it shares most bands."""
    rows = sets.select("cls", "n", "rare", F.explode("heads").alias("head"))
    hubs = rows.groupBy("head").agg(F.max(F.struct("rare", "cls", "n")).alias("hub"),
                                    F.count("*").alias("k")).filter("k > 1")
    hubs = hubs.select("head", F.col("hub.rare").alias("central"), F.col("hub.cls").alias("u"),
                       F.col("hub.n").alias("m"))
    near = rows.join(hubs, "head").filter(
        (F.col("u") != F.col("cls"))
        & (100 * F.least("n", "m") >= percent * F.greatest("n", "m")))
    best = near.groupBy("cls", "u", "central").agg(F.count("*").alias("k")).groupBy("cls").agg(
        F.max(F.struct("k", "central", "u")).alias("best"))
    return best.select(F.col("best.u").alias("u"), F.col("cls").alias("v"))


def _required(n, m, percent: int):
    """Common shingles that two sets of these sizes need."""
    return -(-percent * (n + m) // (100 + percent))


def group_pairs(cols: dict[str, np.ndarray], starts: np.ndarray, percent: int
                ) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, k) of the pairs that groups of rows sharing a shingle leave open."""
    sizes = np.diff(np.concatenate((starts, [len(cols["cls"])])))
    group = np.repeat(np.arange(len(starts)), sizes)
    left, right = [], []

    def fits(i, k):
        n, m, at, to = cols["n"][i], cols["n"][k], cols["pos"][i], cols["pos"][k]
        need = _required(n, m, percent)
        # Blocks of one side meet only the other side, unless there is one side alone.
        apart = (cols["a"][i] == cols["b"][i]) | (cols["side"][i] != cols["side"][k])
        return ((cols["root"][i] != cols["root"][k]) & apart
                & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
                # Sets with that much in common share a shingle this far in front in both.
                & (at <= n - need) & (to <= m - need))
    small = sizes[group] <= 16
    for step in range(1, int(sizes[sizes <= 16].max(initial=0))):
        i = np.flatnonzero((group[step:] == group[:-step]) & small[step:])
        i = i[fits(i, i + step)]
        left.append(i)
        right.append(i + step)
    for start, size in zip(starts[sizes > 16], sizes[sizes > 16]):
        if (cols["root"][start:start + size] == cols["root"][start]).all():
            continue
        for one in range(start, start + size - 1):
            k = np.arange(one + 1, start + size)
            k = k[fits(np.full(len(k), one), k)]
            left.append(np.full(len(k), one))
            right.append(k)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


_GROUP = ["token", "a", "b"]


def _open_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(u, v, nu, nv) for the first shared shingles of sets that may be similar, from rows sorted
    by group."""
    names = ["token", "a", "b", "side", "cls", "n", "pos", "root"]

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            if not table.num_rows:
                continue
            keys = np.stack([table.column(c).to_numpy() for c in _GROUP])
            change = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            last = int(change[-1]) if len(change) else 0
            if last:
                yield paired(table.slice(0, last), np.concatenate(([0], change[:-1])))
            rest = table.slice(last)
        if rest is not None and rest.num_rows:
            yield paired(rest, np.zeros(1, np.int64))

    def paired(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        cols = {c: table.column(c).to_numpy() for c in names}
        i, k = group_pairs(cols, starts.astype(np.int64), percent)
        swap = cols["cls"][i] > cols["cls"][k]
        i, k = np.where(swap, k, i), np.where(swap, i, k)
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[c][j], pa.int64()) for c, j in (("cls", i), ("cls", k), ("n", i), ("n", k))],
            names=["u", "v", "nu", "nv"])
    return map_batches(rows.select(names), run, "u bigint, v bigint, nu bigint, nv bigint")


def _candidates(sets: DataFrame, percent: int, crowd: int) -> DataFrame:
    """Pairs (u, v) of classes of different roots whose prefixes leave ``room`` for the overlap
    they need. ``sets`` has cls, n, prefix and root."""
    width = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = sets.select("cls", "n", "root", F.posexplode("prefix").alias("pos", "token"))
    zero = F.lit(0).cast("bigint")
    # A slot's count is at least that of each of its shingles, so others need no counting.
    least = int(8 * np.log2(1 + crowd))
    maybe = F.shiftrightunsigned("token", BAND_SHIFT) >= least
    by_root = rows.filter(maybe).groupBy("token", "root").agg(F.count("*").alias("k"))
    large = by_root.groupBy("token").agg(
        F.sum("k").alias("k"), F.max(F.struct("k", "root")).alias("main")).filter(
        F.col("k") > crowd)
    # Classes of a shingle's most frequent root are linked: their blocks meet only others.
    large = stored(large.select(
        "token", F.col("main.root").alias("main"),
        F.ceil((F.col("k") - F.col("main.k")) / crowd).alias("others"),
        F.ceil(F.col("main.k") / crowd).alias("mains")), "crowded")
    plain = rows.withColumns({"a": zero, "b": zero, "side": zero})
    if not large.isEmpty():
        plain = plain.join(large.select("token"), "token", "left_anti")
        is_main = F.col("root") == F.col("main")
        deal = F.xxhash64("cls", F.lit(7))
        own = F.when(is_main, F.col("others") + F.pmod(deal, F.col("mains"))).otherwise(
            F.pmod(deal, F.greatest("others", F.lit(1))))
        meets = F.sequence(zero, F.when(is_main, F.col("others")).otherwise(
            F.col("others") + F.col("mains")) - 1)
        dealt = (rows.join(large.filter("others > 0"), "token").withColumn("own", own)
                 .withColumn("other", F.explode(meets)))
        plain = plain.unionByName(dealt.select(
            "cls", "n", "root", "pos", "token", F.least("own", "other").alias("a"),
            F.greatest("own", "other").alias("b"),
            (F.col("own") > F.col("other")).cast("bigint").alias("side")))
    ready = plain.withColumn("pos", F.col("pos").cast("bigint")).repartition(
        width, *_GROUP).sortWithinPartitions(*_GROUP)
    shared = stored(_open_pairs(ready, percent).distinct(), "shared")
    for end in ("u", "v"):
        shared = shared.join(sets.select(
            F.col("cls").alias(end), F.col("prefix").alias("prefix_" + end)), end)
    shared = shared.select("u", "v", "nu", "nv", F.size(
        F.array_intersect("prefix_u", "prefix_v")).alias("c"))
    beyond = F.greatest(*[F.expr(f"{n} - ({prefix_sql(n, percent)})") for n in ("nu", "nv")])
    need = F.expr(f"({percent} * (nu + nv) + {99 + percent}) div {100 + percent}")
    return shared.withColumn("room", F.col("c") + beyond - need).filter("room >= 0").select(
        "u", "v", "room")


def prefix_sql(n: str, percent: int) -> str:
    return f"{n} - ({percent} * {n} + 99) div 100 + 1"


def segments(docs: DataFrame, pairs: DataFrame, sets: DataFrame, shipped, size: int = SHINGLE,
             fragments: int = FRAGMENTS) -> DataFrame:
    """``cls``, ``size``, ``fragment`` and ``segment`` of the classes in ``pairs`` (u, v), written.
    ``sets`` has the smallest id (``least``) of each class."""
    spark = docs.sparkSession
    ends = pairs.select(F.col("u").alias("cls")).unionByName(pairs.select(F.col("v").alias("cls")))
    wanted = sets.join(ends.distinct(), "cls", "left_semi").select("least")
    slot = F.pmod(F.xxhash64(F.col("least")), F.lit(WANTED)).alias("slot")
    bits = np.zeros(WANTED, bool)
    # At most as many rows as there are slots come back; a slot may hold documents that no
    # pair has, which the join drops.
    bits[wanted.select(slot).distinct().toArrow().column("slot").to_numpy()] = True
    marked = spark.sparkContext.broadcast(np.packbits(bits))
    at = cuts(shipped.value, fragments)

    def run(batches):
        shingles, kept = Shingles(size), np.unpackbits(marked.value).astype(bool)
        for batch in batches:
            batch = batch.filter(pa.array(kept[batch.column("slot").to_numpy()]))
            for part in parts(batch):
                cls, n, fragment, segment = [], [], [], []
                for text in part.column("text").to_pylist():
                    keys = ordered(shingles.of(text), shipped.value)
                    for k, piece in enumerate(np.split(keys, np.searchsorted(keys, at))):
                        if len(piece):
                            cls.append(_class_of(keys))
                            n.append(len(keys))
                            fragment.append(k)
                            segment.append(piece.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cls, pa.int64()), pa.array(n, pa.int64()),
                     pa.array(fragment, pa.int32()), pa.array(segment, pa.list_(pa.int64()))],
                    names=["cls", "size", "fragment", "segment"])
    rows = texts_of(docs).withColumn("least", F.col("doc_id"))
    found = map_batches(rows.select("text", slot), run,
                        "cls bigint, size bigint, fragment int, segment array<bigint>")
    return stored(found.dropDuplicates(["cls", "fragment"]), "segments")


def overlaps(pairs: DataFrame, cut: DataFrame, fragments: int = FRAGMENTS) -> DataFrame:
    """``u``, ``v``, ``nu``, ``nv`` and ``common``, the sum of the partial overlaps of the
    segments ``cut``, of the pairs (u, v) of classes that share a shingle."""
    each = pairs.select("u", "v", F.explode(
        F.sequence(F.lit(0), F.lit(fragments - 1))).alias("fragment"))

    def side(name):
        return cut.select(F.col("cls").alias(name), "fragment", F.col("size").alias("n" + name),
                          F.col("segment").alias("of_" + name))
    partial = each.join(side("u"), ["u", "fragment"]).join(side("v"), ["v", "fragment"]).select(
        "u", "v", "nu", "nv", F.size(F.array_intersect("of_u", "of_v")).alias("part"))
    return partial.groupBy("u", "v", "nu", "nv").agg(F.sum("part").alias("common"))


def _linked(counted: DataFrame, percent: int) -> DataFrame:
    union = F.col("nu") + F.col("nv") - F.col("common")
    return counted.filter(100 * F.col("common") >= percent * union).select("u", "v")


def joined(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, crowd: int = CROWD,
           fragments: int = FRAGMENTS, keep: tuple[str, ...] = (),
           tries: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, cls, n and the bigint columns ``keep``) and links (u, v) between
    classes, verified, whose components are those of all pairs of sets at least ``percent`` alike.

    ``tries`` gives, for the documents, more pairs of classes to try first. They change the
    work, never the components.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(slot_bands(docs, size))
    members = stored(_classes(docs, shipped, size, percent, keep), "members")
    sets = stored(members.filter("n > 0").groupBy("cls").agg(
        F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("rare").alias("rare"),
        F.first("prefix").alias("prefix"), F.first("heads").alias("heads")), "sets")
    tried = _hub_pairs(sets, percent)
    if tries is not None:
        tried = tried.unionByName(tries(members)).distinct()
    tried = stored(tried, "tried")
    cut = segments(docs, tried, sets, shipped, size, fragments)
    links = stored(_linked(overlaps(tried, cut, fragments), percent), "links")
    roots = components(links)
    its = roots.withColumnRenamed("node", "its")
    rooted = sets.join(its, sets["cls"] == its["its"], "left").select(
        "cls", "n", "prefix", F.coalesce("root", "cls").alias("root"))
    open_ = stored(_candidates(rooted, percent, crowd), "candidates")
    cut = segments(docs, open_, sets, shipped, size, fragments)
    for left in range(ROUNDS, -1, -1):
        open_ = stored(_apart(open_, roots), "open")
        if open_.isEmpty():
            break
        now = stored(_best_of_each(open_), "now") if left else open_
        more = _linked(overlaps(now, cut, fragments), percent)
        links = stored(links.unionByName(more), "links")
        if left:
            roots = components(links)
            open_ = open_.join(now, ["u", "v"], "left_anti")
    return members.select("doc_id", *keep, "cls", "n"), links


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (u, v, room) whose ends have different roots, with these."""
    named = pairs.select("u", "v", "room")
    for end in ("u", "v"):
        of = roots.select(F.col("node").alias(end), F.col("root").alias("root_" + end))
        named = named.join(of, end, "left").withColumn("root_" + end, F.coalesce("root_" + end, end))
    return named.filter("root_u <> root_v")


def _best_of_each(pairs: DataFrame) -> DataFrame:
    """For each class and each other root the pair with most room."""
    best = [pairs.groupBy(one, "root_" + other).agg(F.max(F.struct("room", "u", "v")).alias("best"))
            .select("best.u", "best.v") for one, other in (("u", "v"), ("v", "u"))]
    return best[0].unionByName(best[1]).distinct()


def linked_documents(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE,
                     crowd: int = CROWD, fragments: int = FRAGMENTS) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every document: the smallest
    ``doc_id`` that links reach."""
    members, links = joined(docs, percent, size, crowd, fragments)
    roots = components(links).withColumnRenamed("node", "its")
    least = members.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"))
    rooted = stored(least.join(roots, least["cls"] == roots["its"], "left").select(
        F.col("cls").alias("of"), "least", F.coalesce("root", "cls").alias("root")), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(rooted.join(lowest, "root").select("of", "component_id"), "named")
    return members.join(named, members["cls"] == named["of"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLE = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'), '[\\x20\\x09-\\x0D]+'),
    lambda w: w <> '') AS words FROM documents),
each_word AS (
  SELECT doc_id, length(words) AS k, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM split),
runs AS (
  SELECT doc_id, i, k, concat_ws(' ', w, {", ".join(f"lead(w, {j}) OVER d" for j in range(1, SHINGLE))}) AS shingle
  FROM each_word WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
distinct_runs AS (
  SELECT DISTINCT doc_id, shingle FROM runs WHERE i <= greatest(1, k - {SHINGLE - 1})),
each AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM distinct_runs),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM each a JOIN each b
    ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS u, doc_id AS v FROM documents
  UNION
  SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v)
SELECT r.u AS doc_id, coalesce(max(e.n), 0) AS n_shingles, min(r.v) AS component_id
FROM reach r LEFT JOIN (SELECT DISTINCT doc_id, n FROM each) e ON e.doc_id = r.u GROUP BY r.u
"""
