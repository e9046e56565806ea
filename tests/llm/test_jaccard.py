"""The Jaccard join against all pairs."""

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import samples  # noqa: E402
from test_near import planted, shingles  # noqa: E402

from tidemark.llm import jaccard  # noqa: E402


def plain(rows):
    """(doc_id, n_shingles, component_id) from all pairs of sets."""
    by_set = {}
    for r in rows:
        by_set.setdefault(frozenset(shingles(r[1])), []).append(r[0])
    sets = [s for s in by_set if s]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for k, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(k)
    least = {}
    for i, s in enumerate(sets):
        ids = [x for x in by_set[s] if x is not None]
        least[find(i)] = min([*ids, *([least[find(i)]] if least.get(find(i)) is not None else [])],
                             default=None)
    at = {s: least[find(i)] for i, s in enumerate(sets)}
    return sorted(((r[0], len(s), at[s] if s else r[0]) for r in rows
                   for s in [frozenset(shingles(r[1]))]), key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def family(n=60):
    """Near copies that are not all alike, texts that share one long passage, and outsiders."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(n):
        words = list(base)
        for at in rng.sample(range(120), 1 + i % 5):
            words[at] = f"z{rng.randrange(9)}"
        rows.append((30_000 + i, " ".join(words), "en", "s", 0))
    passage = [f"p{i}" for i in range(60)]
    for i in range(n):
        rows.append((40_000 + i, " ".join(passage + [f"q{i}x{k}" for k in range(i % 20)]), "en", "s", 0))
        rows.append((50_000 + i, " ".join([f"r{i}y{k}" for k in range(70)] + passage), "en", "s", 0))
    return rows


@pytest.mark.parametrize("crowd,fragments", [(1024, 16), (3, 16), (8, 1)])
def test_components_equal_all_pairs(spark, crowd, fragments):
    rows = planted() + family() + [(60_000, "w" + " w" * 5000, "en", "s", 0)]
    docs = samples.table(spark, rows)
    expected = plain(rows)
    assert got(jaccard.linked_documents(docs, crowd=crowd, fragments=fragments)) == expected
    assert len({r[2] for r in expected}) < len(expected) - 80


def test_awkward_rows(spark):
    docs = samples.table(spark, clashes=True)
    assert got(jaccard.linked_documents(docs)) == plain(samples.documents())
    assert jaccard.linked_documents(samples.table(spark, [])).count() == 0


def test_partial_overlaps_add_up(spark):
    rows = planted()[:30]
    docs = samples.table(spark, rows)
    shipped = spark.sparkContext.broadcast(jaccard.slot_bands(docs))
    members = jaccard._classes(docs, shipped, 5, 80)
    of = {r.cls: next(x[1] for x in rows if x[0] == r.doc_id) for r in members.collect()}
    classes = sorted(of)
    pairs = spark.createDataFrame([(a, b) for a in classes for b in classes if a < b],
                                  "u bigint, v bigint")
    sets = members.selectExpr("cls", "doc_id AS least")
    for fragments in (1, 7, 64):
        cut = jaccard.segments(docs, pairs, sets, shipped, fragments=fragments)
        found = {(r.u, r.v): r.common for r in jaccard.overlaps(pairs, cut, fragments).collect()}
        for a in classes:
            for b in classes:
                if a < b:
                    both = len(shingles(of[a]) & shingles(of[b]))
                    assert found.get((a, b), 0) == both


def test_fragments_hold_about_as_many_shingles():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, np.iinfo(np.uint64).max, 400_000, np.uint64)
    counts = np.bincount((codes & np.uint64(jaccard.SLOTS - 1)).astype(np.int64),
                         minlength=jaccard.SLOTS)
    bands = np.minimum(255, 8 * np.log2(1 + counts)).astype(np.uint8)
    keys = jaccard.ordered(codes, bands)
    sizes = np.diff([0, *np.searchsorted(keys, jaccard.cuts(bands)), len(keys)])
    assert len(sizes) == jaccard.FRAGMENTS and sizes.min() > 0.4 * len(keys) / jaccard.FRAGMENTS


@pytest.mark.parametrize("n", [1, 2, 5, 6, 10, 99, 1000])
def test_similar_sets_share_a_prefix_shingle(n):
    # The least overlap that two sets of n shingles can have and be similar.
    common = -(-80 * 2 * n // 180)
    assert jaccard.prefix_length(n) > n - common


@pytest.mark.parametrize("crowd", [1, 8, 1024])
def test_candidates_hold_every_similar_pair_of_different_roots(spark, crowd):
    rows = planted() + family(30)
    docs = samples.table(spark, rows)
    shipped = spark.sparkContext.broadcast(jaccard.slot_bands(docs))
    members = {r.cls: r for r in jaccard._classes(docs, shipped, 5, 80).collect() if r.n}
    text = {r[0]: r[1] for r in rows}
    of = {c: frozenset(shingles(text[r.doc_id])) for c, r in members.items()}
    # Some classes have been joined before, whether they are alike or not.
    root = {c: min(members) if i % 3 == 0 else c for i, c in enumerate(sorted(members))}
    sets = spark.createDataFrame([(c, r.n, r.prefix, root[c]) for c, r in members.items()],
                                 "cls bigint, n bigint, prefix array<bigint>, root bigint")
    wanted = {(a, b) for a in of for b in of if a < b and root[a] != root[b]
              and 100 * len(of[a] & of[b]) >= 80 * len(of[a] | of[b])}
    found = {(r.u, r.v) for r in jaccard._candidates(sets, 80, crowd).collect()}
    assert wanted and wanted <= found
