"""Languages with few documents, and with other scripts."""

import os
import random
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import samples  # noqa: E402

from tidemark.llm import language  # noqa: E402

ES = "el la de que y en un ser se no haber por con su para como estar tener le lo".split()


def spanish(n, seed):
    return samples.prose("en", n, seed).translate(str.maketrans("thwaei", "ñjkoau")) + " " + ES[seed % 20]


@pytest.mark.parametrize("few", [1, 2, 7, 19])
@pytest.mark.parametrize("copies", [False, True])
def test_documents_of_a_rare_language_stay(spark, few, copies):
    rows = [(i, samples.prose(lang, 600, i), lang, "s", 0)
            for i in range(60) for lang in [("en", "fr")[i % 2]]]
    rows += [(1000 + i, spanish(600, 5 if copies else 5 + i) + f" {'abcdefghijklmnopqrs'[i]}",
              "es", "s", 0) for i in range(few)]
    docs = spark.createDataFrame(rows, samples.SCHEMA)
    kept = {r.doc_id for r in language.reject_unknown(docs, language.train(docs)).collect()}
    assert {r[0] for r in rows} == kept


def test_only_one_language_with_one_document(spark):
    docs = spark.createDataFrame([(1, samples.prose("en", 600, 1), "en", "s", 0)], samples.SCHEMA)
    assert language.reject_unknown(docs, language.train(docs)).count() == 1


SCRIPTS = {  # first code point and number of letters
    "han_one": (0x4E00, 900), "han_two": (0x6E00, 900), "kana": (0x3042, 80),
    "hangul": (0xAC00, 700), "devanagari": (0x0905, 70), "thai": (0x0E01, 58),
    "latin": (0x61, 26), "greek": (0x3B1, 24), "cyrillic": (0x430, 32), "hebrew": (0x5D0, 27)}


def written(script, n, seed):
    """Words of a vocabulary that belongs to the script, marks and all."""
    first, letters = SCRIPTS[script]
    words = random.Random(script)
    vocabulary = ["".join(chr(first + words.randrange(letters)) for _ in range(words.randint(2, 6)))
                  for _ in range(400)]
    drawn = random.Random(seed)
    return " ".join(vocabulary[int(400 * drawn.random() ** 2)] for _ in range(n))


def test_no_letter_of_any_script_is_merged(spark):
    rows = [(i, written(script, 120, i), script, "s", 0)
            for i in range(300) for script in [list(SCRIPTS)[i % len(SCRIPTS)]]]
    docs = spark.createDataFrame(rows, samples.SCHEMA)
    model = language.train(language.held_out(docs))
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    out = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    for script in SCRIPTS:
        mine = [r for r in out if r[2] == script]
        assert mine and sum(got[r[0]].lang_pred == script for r in mine) >= 0.95 * len(mine), script
    # A script that no sample has is not taken for one that is there.
    odd = spark.createDataFrame([(1, "".join(chr(0x10D0 + i % 30) for i in range(300)), "x", "s", 0)],
                                samples.SCHEMA)
    assert language.reject_unknown(odd, model).count() == 0


def test_packed_transitions_equal_the_automata():
    drawn = random.Random(7)
    automata = [language.suffix_automaton([drawn.randrange(2, k) for _ in range(500)])
                for k in (4, 30, 400)]
    base, moves = language.packed(automata, 400)
    offset = 0
    for steps in automata:
        for state, to in enumerate(steps):
            for symbol in range(400):
                entry = int(moves[base[offset + state] + symbol])
                mine = entry >> 32 == offset + state
                assert mine == (symbol in to)
                assert not mine or entry & 0xFFFFFFFF == offset + to[symbol]
        offset += len(steps)
