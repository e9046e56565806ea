"""Spelling variants against all pairs of words."""

import os
import random
import re
import sys
import zlib
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import samples  # noqa: E402

from tidemark.llm import variants  # noqa: E402


def plain_counts(rows):
    out = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 3}


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows):
    n = plain_counts(rows)
    form, near = {}, {}
    for word in n:
        around = [w for w in n if one_edit(word, w)]
        near[word] = len(around)
        best = min(around, key=lambda w: (-n[w], w), default=None)
        form[word] = best if best and n[best] >= 2 * n[word] else None
    out = []
    for word in n:
        root = word
        while form[root]:
            root = form[root]
        out.append((word, form[word], root, n[word], near[word],
                    n[form[word]] if form[word] else None))
    return sorted(out)


def written(seed, stems=40, alphabet="abé"):
    """Texts of words that are edits of edits of a few stems, and of each other."""
    rng, words = random.Random(seed), []
    for _ in range(stems):
        word = "".join(rng.choice(alphabet) for _ in range(rng.randint(5, 9)))
        for _ in range(rng.randint(1, 6)):
            words += [word] * rng.choice([1, 3, 4, 8, 20])
            at, kind = rng.randrange(len(word)), rng.randrange(3)
            word = word[:at] + ("" if kind == 0 else rng.choice(alphabet)) + word[at + (kind < 2):]
    rng.shuffle(words)
    return [(i, " ".join(words[i::30]).upper() if i % 3 else "-".join(words[i::30]), "en", "s", 0)
            for i in range(30)]


LONG = [(5000 + i, "x" * n + " " + ("y" * 20_000 + "z" * (i % 2)), "en", "s", 0)
        for i, n in enumerate([9, 9, 9, 10, 10, 10, 10])]


def got(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("crowd", [1, 3, 40, 2048])
def test_forms_equal_all_pairs(spark, crowd):
    rows = written(1) + written(2, 20, "ab") + LONG + [(None, "eight eight eight eighty", None, None, None)]
    rows = [(i if r[0] is not None and r[0] < 5000 else r[0], *r[1:]) for i, r in enumerate(rows)]
    expected = plain(rows)
    assert sum(r[1] is not None for r in expected) > 20 and any(r[1] != r[2] for r in expected if r[1])
    assert got(variants.variants(samples.table(spark, rows, clashes=True), crowd)) == expected


def test_awkward_rows(spark):
    assert got(variants.variants(samples.table(spark))) == plain(samples.documents())
    assert variants.variants(samples.table(spark, [])).count() == 0


def test_letters_are_deleted_by_checksum():
    runs = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)]
    changed = [r for r in runs if variants.altered(7, r) != r]
    assert changed and all(len(variants.altered(7, r)) == len(r) - 1 for r in changed)
    assert all(zlib.crc32(f"7:{r}".encode()) % 97 == 0 for r in changed)


def test_index_tracks_one_error():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(5, 7))) for _ in range(90)})
    index = variants.PositionIndex(words)
    for word in words:
        for shorter in {len(word), len(word) - 1}:
            for apart in range(shorter):
                hits = index.near(word, shorter, apart)
                assert {w for i, w in enumerate(words) if hits >> i & 1} == {
                    w for w in words if one_edit(word, w) and min(len(w), len(word)) == shorter
                    and not (apart and w[:apart] == word[:apart])}
