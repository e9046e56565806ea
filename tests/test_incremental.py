"""Incremental marts, staged publishing, learned profiles and global numbers."""

import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tidemark.operators import documents as docs_ops, profiles
from tidemark.operators.incremental import IncrementalMart, Retractable
from tidemark.operators.sequence import numbered
from tidemark.sources import sinks
from tidemark.sources.files import ContractError

LOG = ("id bigint, grp string, day date, who string, amount decimal(9,2), open boolean, "
       "_pg_change_type string, _pg_lsn bigint, _pg_xid int, _timestamp timestamp_ntz, _sort_by bigint")
MEASURES = (
    Retractable("first_day", "low", "day"), Retractable("last_day", "high", "day"),
    Retractable("n", "count", "id"), Retractable("people", "distinct", "who"),
    Retractable("amount", "total", "amount"), Retractable("mean", "mean", "amount"),
    Retractable("n_open", "count_if", "open"))


def full_mart(live):
    """The mart of (grp, day, who, amount, open) rows by plain Python."""
    groups = {}
    for row in live:
        groups.setdefault(row[0], []).append(row[1:])
    out = []
    for grp, rows in groups.items():
        days = [r[0] for r in rows if r[0] is not None]
        amounts = [r[2] for r in rows if r[2] is not None]
        out.append((grp, min(days, default=None), max(days, default=None), len(rows),
                    len({r[1] for r in rows if r[1] is not None}),
                    sum(amounts, D(0)) if amounts else None,
                    float(sum(amounts, D(0))) / len(amounts) if amounts else None,
                    sum(bool(r[3]) for r in rows)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("every", [2, 16])
def test_batches_equal_the_full_mart(spark, tmp_path, every):
    import datetime
    rng, stored, mart = random.Random(every), {}, None
    for batch_id in range(6):
        rows = []
        for _ in range(25):
            key, at = rng.randrange(20), rng.randrange(10 * batch_id + 10)
            kind = rng.choice(["insert", "update", "update", "delete"])
            image = (rng.choice(["a", "b", "c", None]),
                     rng.choice([None, datetime.date(2024, 1, 1 + rng.randrange(9))]),
                     rng.choice([None, "x", "y", "z"]),
                     rng.choice([None, D(rng.randrange(1000)) / 100]), rng.choice([True, False, None]))
            # Ties are settled by a column, here by the position, which is unique.
            at = at * 1000 + batch_id * 100 + len(rows)
            rows.append((key, *image, kind, at, None, None, at))
            if key not in stored or stored[key][0] < at:
                stored[key] = (at, kind, image)
        batch = spark.createDataFrame(rows, LOG)
        mart = mart or IncrementalMart(f"{tmp_path}/mart", batch.schema, "id", "grp", MEASURES, every)
        mart.apply(batch, batch_id)
        if batch_id in (2, 4):
            mart.apply(batch, batch_id)  # a replay after a failure
        expected = full_mart([v[2] for v in stored.values() if v[1] != "delete"])
        assert sorted(map(tuple, mart.current(spark).collect()), key=repr) == expected


def test_only_touched_keys_are_written(spark, tmp_path):
    schema = spark.createDataFrame([], LOG).schema
    mart = IncrementalMart(f"{tmp_path}/mart", schema, "id", "grp", MEASURES)
    row = lambda i, grp, at: (i, grp, None, "x", D("1.00"), True, "insert", at, None, None, at)
    mart.apply(spark.createDataFrame([row(i, f"g{i}", 1) for i in range(50)], schema), 0)
    mart.apply(spark.createDataFrame([row(3, "g4", 2)], schema), 1)
    changed = spark.read.parquet(f"{tmp_path}/mart/served/delta/batch=1").collect()
    assert {(r.grp, r._pg_change_type) for r in changed} == {("g3", "delete"), ("g4", "update")}
    assert {r.grp: r.n for r in mart.current(spark).collect()}["g4"] == 2
    mart.apply(spark.createDataFrame([row(3, "g9", 1)], schema), 2)  # late: nothing changes
    assert not spark.read.parquet(f"{tmp_path}/mart/sums/batch=2").where("__rows <> 0").count()
    assert mart.current(spark).count() == 49


def test_what_was_folded_goes_when_the_next_batch_begins(spark, tmp_path):
    schema = spark.createDataFrame([], LOG).schema
    mart = IncrementalMart(f"{tmp_path}/mart", schema, "id", "grp", MEASURES, 2)
    row = lambda i, grp, at: (i, grp, None, f"w{at}", D("1.00"), True, "update", at, None, None, at)
    for batch_id in range(5):
        rows = [row(i, f"g{(i + batch_id) % 3}", batch_id) for i in range(batch_id, 6)]
        for _ in range(2):  # every batch is replayed
            mart.apply(spark.createDataFrame(rows, schema), batch_id)
        last = {i: min(i, batch_id) for i in range(6)}
        assert {r.grp: r.n for r in mart.current(spark).collect()} == {
            g: n for g in ("g0", "g1", "g2")
            if (n := sum(f"g{(i + b) % 3}" == g for i, b in last.items()))}
        left = {str(p.relative_to(tmp_path / "mart")) for p in (tmp_path / "mart").glob("*/*=*")}
        left |= {str(p.relative_to(tmp_path / "mart")) for p in (tmp_path / "mart").glob("facts/*/*=*")}
        folds = batch_id % 2
        since = [batch_id] if batch_id == 0 or not folds else [batch_id - 1, batch_id]
        base = since[0] - 1
        upto = [f"upto={b}" for b in ([base] if base >= 0 else []) + ([batch_id] if folds else [])]
        parts = [f"batch={b}" for b in since] + upto
        assert left == {f"{name}/{p}" for name in ("sums", "values-day", "values-who") for p in parts} | {
            f"facts/{'delta' if p[0] == 'b' else 'base'}/{p}" for p in parts}
        assert not list((tmp_path / "mart").glob("signed-*"))


def test_one_part_of_a_target_is_read_as_it_is(spark, tmp_path):
    schema = spark.createDataFrame([], LOG).schema
    mart = IncrementalMart(f"{tmp_path}/mart", schema, "id", "grp", MEASURES)
    mart.apply(spark.createDataFrame(
        [(1, "g", None, "x", None, True, "insert", at, None, None, at) for at in range(3)], schema), 0)
    images = mart.facts.images(spark)
    assert [r._sort_by for r in images.collect()] == [2]
    assert "Exchange" not in images._jdf.queryExecution().executedPlan().toString()


def test_float_sums_are_refused(spark, tmp_path):
    schema = spark.createDataFrame([], LOG.replace("decimal(9,2)", "double")).schema
    with pytest.raises(ContractError):
        IncrementalMart(str(tmp_path), schema, "id", "grp", MEASURES)


# -- publishing ------------------------------------------------------------------
def test_a_refused_copy_leaves_the_one_before(spark, tmp_path):
    path = f"{tmp_path}/served"
    assert sinks.served_copy(spark, path) is None and sinks.published_source(spark, path) is None
    good = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    sinks.publish_snapshot(good, ["k"], path, "first")
    reader = sinks.served_copy(spark, path)
    for bad in (good.union(good), good.withColumn("k", F.lit(" "))):
        with pytest.raises(sinks.PrimaryKeyError):
            sinks.publish_snapshot(bad, ["k"], path, "bad")
        assert sinks.served_copy(spark, path).count() == 2
        assert sinks.published_source(spark, path) == "first"
    sinks.publish_snapshot(good.limit(1), ["k"], path, "second")
    # A reader that has begun keeps its version until the publish after the next.
    assert reader.count() == 2 and sinks.served_copy(spark, path).count() == 1
    sinks.publish_snapshot(good, ["k"], path, "third")
    kept = [p.name for p in (tmp_path / "served").iterdir() if p.name.startswith("version-")]
    assert len(kept) == 2 and sinks.published_source(spark, path) == "third"


def test_a_publisher_that_dies_before_the_pointer_changes_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/served"
    sinks.publish_snapshot(spark.range(3), ["id"], path)
    monkeypatch.setattr(sinks, "_write_pointer", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        sinks.publish_snapshot(spark.range(9), ["id"], path)
    assert sinks.served_copy(spark, path).count() == 3


# -- buckets ---------------------------------------------------------------------
def test_bucketed_facts_are_not_exchanged(spark, sf_dir):
    from tidemark.plans.domains import domain_spec
    from tidemark.workload.finance import bucketed_sales
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                "spark.sql.bucketing.coalesceBucketsInJoin.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    sales, agreements = bucketed_sales(spark, sf_dir)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        spec = domain_spec("finance")
        for out in (spec.detail(sales, agreements), spec.mart_direct(sales, agreements)):
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
            assert out.count() > 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# -- learned profiles ------------------------------------------------------------
def test_a_class_that_is_only_in_the_data_is_predicted(spark):
    words = {"de": "der die und nicht", "en": "the and of not", "xx": "zorg blim quax frob"}
    rows = [(i, label, " ".join(random.Random(i).choices((words[label] + " a b c").split(), k=30)))
            for i in range(90) for label in [list(words)[i % 3]]]
    docs = spark.createDataFrame(rows + [(900, None, "blim quax"), (901, "en", " "), (902, "de", None),
                                         (903, None, "nothing known")],
                                 "id int, source_class string, parsed_text string")
    learned = profiles.learn_profiles(docs)
    assert {r.term for r in learned.where("label = 'xx'").collect()} == set(words["xx"].split())
    got = {r.id: r.doc_class for r in docs_ops.classify(
        docs, profiles.collected(learned), fallback=profiles.most_frequent(docs)).collect()}
    assert all(got[i] == label for i, label, _ in rows)
    assert got[900] == "xx" and got[901] is None and got[902] is None
    assert got[903] == profiles.most_frequent(docs) == "de"


def test_profiles_are_bounded_and_without_labels_empty(spark):
    docs = spark.createDataFrame([(f"c{i % 2}", " ".join(f"t{chr(97 + k)}{'xy'[i % 2]}" for k in range(26)))
                                  for i in range(20)], "source_class string, parsed_text string")
    assert {r["count"] for r in profiles.learn_profiles(docs, terms=5).groupBy("label").count().collect()} == {5}
    none = docs.withColumn("source_class", F.lit(None).cast("string"))
    assert profiles.learn_profiles(none).count() == 0 and profiles.most_frequent(none) is None
    assert {r.doc_class for r in docs_ops.classify(none, []).collect()} == {None}


def test_too_many_classes_are_refused(spark, monkeypatch):
    monkeypatch.setattr(profiles, "CLASSES", 3)
    with pytest.raises(ValueError):
        profiles.collected(spark.createDataFrame([(f"c{i}", "t", 1) for i in range(4)],
                                                 "label string, term string, weight bigint"))


# -- numbers ---------------------------------------------------------------------
def test_numbers_equal_a_window(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, "hot", "hot", "hot", f"g{rng.randrange(20)}"]), i * 37 % 1000)
            for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, `odd name` bigint").repartition(7)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    first, last = {}, {}
    for i, r in enumerate(order):
        first.setdefault(r[0], i)
        last[r[0]] = i + 1
    got = numbered(df, [F.col("odd name")], "nth", ["g"], "start", "stop").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        ((*r, i - first[r[0]], first[r[0]], last[r[0]]) for i, r in enumerate(order)), key=repr)
    whole = numbered(df, [F.col("odd name")]).collect()
    assert sorted(r.nth for r in whole) == list(range(1000))
    assert [r["odd name"] for r in sorted(whole, key=lambda r: r.nth)] == sorted(r[1] for r in rows)


def test_numbers_of_an_empty_table(spark):
    assert numbered(spark.range(0), [F.col("id")]).count() == 0
