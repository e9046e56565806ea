"""Sums of narrow decimals equal plain decimal sums, to the last digit."""

import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import exact_avg, exact_sum, narrow_decimal


@pytest.mark.parametrize("precision, scale", [(15, 0), (15, 2), (15, 4), (14, 2), (6, 4), (3, 1), (15, 8), (8, 8),
                                              (15, 9), (15, 15)])
def test_limb_sums_are_exact(spark, precision, scale):
    rng = random.Random(precision * 100 + scale)
    top = 10 ** precision - 1
    units = [0, top, -top, 1, -1] + [rng.randint(-top, top) for _ in range(400)]
    values = [D(u).scaleb(-scale) for u in units] + [None, None]
    rows = [(i % 3, v) for i, v in enumerate(values)] + [(9, None)]
    df = spark.createDataFrame(rows, f"g int, v decimal({precision},{scale})")
    assert narrow_decimal(df.schema["v"].dataType) == (scale <= 8)
    got = {r.g: r for r in df.groupBy("g").agg(
        exact_sum(df, "v").alias("fast"), F.sum("v").alias("plain"),
        exact_avg(df, "v").alias("mean"), F.count("v").alias("n")).collect()}
    assert len(got) == 4
    for row in got.values():
        assert row.fast == row.plain
        assert row.mean == (float(row.plain) / row.n if row.n else None)


def test_wide_decimals_and_other_types_use_the_plain_sum(spark):
    df = spark.createDataFrame([(D("1" * 18 + ".25"), 2, 0.5), (D("2.50"), 3, 0.25)],
                               "w decimal(20,2), i bigint, d double")
    row = df.agg(exact_sum(df, "w").alias("w"), exact_sum(df, "i").alias("i"),
                 exact_avg(df, "d").alias("d")).first()
    assert (row.w, row.i, row.d) == (D("111111111111111113.75"), 5, 0.375)
