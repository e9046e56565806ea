"""The Merkle manifest against a plain recomputation."""

import hashlib
import os
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import samples  # noqa: E402

from tidemark.llm import merkle  # noqa: E402


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes):
    """The levels over some nodes, the last one of a single node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([H(*at[i:i + 8]) for i in range(0, len(at), 8)])
    return levels


def route(levels, i):
    """(left, right) siblings of node ``i``, level by level."""
    steps = []
    for at in levels[:-1]:
        run = i - i % 8
        steps.append(("".join(at[run:i]), "".join(at[i + 1:run + 8])))
        i //= 8
    return steps


def plain(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    def leaf(r, text):
        return H(*map(written, (r[0], r[3], r[2], r[4], text)))
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: climb([x[2] for x in sorted(langs[lang], key=lambda x: x[:3])]) for lang in order}
    top = climb([trees[lang][-1][0] for lang in order])
    out = []
    for n, lang in enumerate(order):
        for i, (_, _, own, r) in enumerate(sorted(langs[lang], key=lambda x: x[:3])):
            steps = route(trees[lang], i) + route(top, n)
            text = r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                text = text.encode().lower().decode()
            now = leaf(r, text)
            for left, right in steps:
                now = H(left, now, right)
            root = top[-1][0]
            out.append((r[0], own, trees[lang][-1][0], root, H(*(a + b for a, b in steps)), now,
                        now == root))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def of_languages(n, sizes):
    rows, at = [], 0
    for k, size in enumerate(sizes):
        for _ in range(size):
            rows.append((at * 7 % 1009 if n else at, f"Text {at} É", f"l{k:02}", "s", at))
            at += 1
    return rows


@pytest.mark.parametrize("rows", [
    samples.documents(), of_languages(0, [1]), of_languages(0, [2]), of_languages(1, [65]),
    of_languages(1, [1, 8, 9, 64, 73, 3, 2, 1, 1, 1]), of_languages(0, [520, 1])],
    ids=["awkward", "one", "two", "nine-eights", "ten-languages", "deep"])
def test_manifest_equals_plain(spark, rows):
    docs = samples.table(spark, rows, clashes=len(rows) > 70)
    assert got(merkle.manifest(docs)) == plain(rows)


def test_empty_table(spark):
    assert merkle.manifest(samples.table(spark, [])).count() == 0


def test_every_tampered_row_is_found(spark):
    rows = of_languages(1, [40, 30])
    for r in merkle.manifest(samples.table(spark, rows)).collect():
        assert r.verified == bool(zlib.crc32(str(r.doc_id).encode()) % 3)
