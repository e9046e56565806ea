"""Small tables with every awkward row the operators promise a result for."""

import random

WORDS = {
    "en": "the of and to in is that it was for on are with as his they at be this from".split(),
    "fr": "le la de et les des en un une que est pour dans qui par sur avec pas au plus".split(),
}
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use inside; as columns of the input they must not matter.
CLASHES = ("mark", "whole", "own", "id", "its", "spans", "fp", "size", "target", "position",
           "positions", "range", "extra", "key", "fingerprint", "score", "lang_pred", "nth",
           "root", "component_id", "of", "at", "first", "__spans")


def prose(lang: str, n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "s", "er"]) for _ in range(n)) + "."


def documents(n: int = 60):
    """Clean rows, then nulls, empty and long texts, exact and near copies, repeated rows."""
    rows = []
    for i in range(n):
        lang = ("en", "fr")[i % 2]
        rows.append((i, prose(lang, 60 + i, i), lang, f"s{i % 4}"))
    base = prose("en", 400, 999)
    rows += [(100 + i, base, "en", "s0") for i in range(8)]
    rows += [(120 + i, base + f" tail{i}", "en", "s0") for i in range(5)]
    rows += [(200, None, "en", "s1"), (201, "", None, None), (202, " \n\t ", "fr", "s1"),
             (203, "12 34 !?", None, "s2"), (None, "a row without an id", None, None),
             (None, "a row without an id", None, None), (204, "é" * 30_000, None, "s3"),
             (205, prose("en", 30_000, 5), "en", "s3"), (7, prose("fr", 30, 77), "fr", "s9"),
             (3, rows[3][1], "fr", "s3"), (206, "Mail ann.lee@mail.example.com or 10.0.0.256, "
             "10.1.2.3, 4111 1111 1111 1111, +1 (555) 010-9999 😀 x@y", "en", "s2")]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


def table(spark, rows=None, clashes: bool = False):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(3)
    if clashes:
        df = df.select("*", *[F.lit(None).cast("string").alias(c) for c in CLASHES])
    return df
