"""Near copies by exact similarity, as the pipeline drops them."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import samples  # noqa: E402

import corpus_pipeline  # noqa: E402
from tidemark.llm import near, simhash  # noqa: E402


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_classes(rows):
    """The first row (by id) of each class, from all pairs."""
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for k in range(i):
            both = len(sets[i] | sets[k])
            if not both or len(sets[i] & sets[k]) / both >= 0.8:
                a, b = sorted((find(i), find(k)))
                root[b] = a
    return {rows[find(i)][0] for i in range(len(rows))}


def planted():
    """Texts with up to four words of 100 changed, chains of them, copies, and no words."""
    rng, rows = random.Random(3), []
    for i in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(100)]
        rows.append((i, " ".join(words), "en", "s", 0))
        for step in range(1 + i % 3):
            words = list(words)
            for at in rng.sample(range(100), i % 5):
                words[at] = f"n{rng.randrange(5000)}"
            rows.append((1000 * (step + 1) + i, " ".join(words).upper(), "en", "s", 0))
    return rows + [(9000, None, "en", "s", 0), (9001, " ", "en", "s", 0), (9002, "a b", "en", "s", 0),
                   (9003, "A  B", "en", "s", 0), (9004, "a c", "en", "s", 0)]


def test_stage_drops_near_copies_that_differ_in_many_bits(spark):
    rows = planted()
    fps = {r[0]: simhash.fingerprint(r[1] or "") for r in rows}
    assert sum((fps[i] ^ fps[1000 + i]).bit_count() > simhash.LIMIT for i in range(40)) > 10
    docs = spark.createDataFrame(rows, samples.SCHEMA)
    kept = sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())
    assert kept == sorted(plain_classes(rows))


@pytest.mark.parametrize("block", [2, 256])
def test_crowded_buckets_lose_no_link(spark, block):
    rows = planted()
    base = rows[0][1].split()
    for i in range(30):  # a family of copies that are not all alike
        changed = list(base)
        for at in random.Random(i).sample(range(100), 1 + i % 4):
            changed[at] = f"z{i}"
        rows.append((20_000 + i, " ".join(changed), "en", "s", 0))
    docs = spark.createDataFrame(rows, samples.SCHEMA)
    found = near.classes(docs, block=block).collect()
    least = {}
    for r in found:
        least[r.root] = min(least.get(r.root, r.doc_id), r.doc_id)
    assert set(least.values()) == plain_classes(rows) and len(found) == len(rows)


#: Nine words that no 32 bands of four MinHash values, as the stage once took, held together
#: with the first eight of them; their sets are 0.8 alike.
NINE = ("w2946 w406 w1698 w4348 w104 w1029 w360 w3624 w1724",
        "w3323 w1540 w2835 w1977 w3814 w4505 w656 w1187 w4124",
        "w4541 w4363 w1266 w1804 w3291 w129 w2313 w4404 w1387")


def test_stage_loses_no_link_to_chance(spark):
    rows = [(10 * i + k, " ".join(t.split()[:9 - k]), "en", "s", 0)
            for i, t in enumerate(NINE) for k in range(2)]
    docs = spark.createDataFrame(rows, samples.SCHEMA)
    kept = sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())
    assert kept == [0, 10, 20] == sorted(plain_classes(rows))


@pytest.mark.parametrize("block", [2, 1024])
def test_candidates_are_those_of_the_fingerprints(spark, block):
    rows = planted()
    fp = {r[0]: simhash.fingerprint(r[1] or "", near.SHINGLE) for r in rows}
    texts = spark.createDataFrame(rows, samples.SCHEMA).select("doc_id", "text", near._mark())
    members = texts.selectExpr("mark", "doc_id AS cls", "CAST(text > ' ' AS BIGINT) AS n").cache()
    root = {r.cls: r.cls for r in members.filter("n > 0").dropDuplicates(["mark"]).collect()}
    members = members.filter(members["cls"].isin(*root))

    def joined(pairs):
        at = dict(root)
        for u, v in pairs:
            low, high = sorted((at[u], at[v]))
            at = {k: low if r == high else r for k, r in at.items()}
        return at
    found = list(map(tuple, near.candidates(texts, members, block=block).collect()))
    everyone = [(a, b) for a in root for b in root
                if a < b and (fp[a] ^ fp[b]).bit_count() <= near.LIMIT]
    assert joined(found) == joined(everyone) and len(everyone) > 10
    assert set(found) <= set(everyone) and len(found) < len(root)
