"""Change logs: latest image, synthesis, round trip, and incremental apply."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc
from tidemark.sources.files import CHANGE_COLUMNS, ContractError
from tidemark.streaming.apply import ChangeTarget, apply_changes, file_stream

LOG = "k string, v int, _pg_change_type string, _pg_lsn bigint, _pg_xid int, " \
      "_timestamp timestamp_ntz, _sort_by bigint"


def event(key, value, change, position):
    return (key, value, change, position, None, None, position)


def events(n=400, keys=20, seed=7):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(keys)}"
        out.append(event(key, i, rng.choice(["insert", "update", "update", "delete"]), i))
    return out


def brute_force(rows):
    newest = {}
    for row in rows:
        if row[0] not in newest or row[6] > newest[row[0]][6]:
            newest[row[0]] = row
    return sorted((r[0], r[1]) for r in newest.values() if r[2] is not None and r[2] != "delete")


def state(df):
    return sorted((r.k, r.v) for r in df.collect())


def test_latest_live_image_per_key(spark):
    rows = events()
    random.Random(1).shuffle(rows)
    got = cdc.current_state(spark.createDataFrame(rows, LOG), "k")
    assert got.columns == ["k", "v"]
    assert state(got) == brute_force(rows)


def test_unknown_change_type_is_not_live(spark):
    log = spark.createDataFrame([event("a", 1, "insert", 1), event("a", 2, None, 2),
                                 event("b", 3, "insert", 3)], LOG)
    assert state(cdc.current_state(log, "k")) == [("b", 3)]


def test_ties_do_not_depend_on_arrival(spark):
    rows = [event("a", v, "update", 5) for v in range(50)]
    results = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        log = spark.createDataFrame(rows, LOG).repartition(4)
        results.add(tuple(state(cdc.current_state(log, "k"))))
    assert len(results) == 1
    log = spark.createDataFrame(rows, LOG)
    assert state(cdc.current_state(log, "k", tie_break=["v"])) == [("a", 49)]


def test_missing_metadata_columns(spark):
    with pytest.raises(ContractError, match="_pg_change_type.*_sort_by"):
        cdc.current_state(spark.createDataFrame([("a", 1)], "k string, v int"), "k")


def test_missing_contract_column(spark):
    with pytest.raises(ContractError, match="nope"):
        cdc.current_state(spark.createDataFrame(events(5), LOG), "k", ["k", "nope"])


def test_synthesis_shape_and_round_trip(spark):
    snapshot = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "k string, v int")
    log = cdc.synthesize_log(snapshot, F.ascii("k"))
    assert log.columns == ["k", "v", *CHANGE_COLUMNS]
    types = dict(log.dtypes)
    assert (types["_pg_lsn"], types["_pg_xid"], types["_timestamp"], types["_sort_by"]) == (
        "bigint", "int", "timestamp_ntz", "bigint")
    rows = log.collect()
    assert {r._pg_change_type for r in rows} == {"insert"}
    assert all(r._pg_lsn == r._sort_by and r._pg_xid is None for r in rows)
    diff = cdc.row_differences(snapshot, cdc.current_state(log, "k")).first()
    assert tuple(diff) == (3, 0, 0)


def test_synthesis_of_an_empty_snapshot(spark):
    empty = spark.createDataFrame([], "k string, v int")
    log = cdc.synthesize_log(empty, F.lit(1))
    assert log.count() == 0 and cdc.current_state(log, "k").count() == 0


def test_row_differences_count_repeats(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (3,)], "x int")
    assert tuple(cdc.row_differences(a, b).first()) == (3, 2, 1)


def test_combines_before_the_shuffle(spark):
    plan = cdc.current_state(spark.createDataFrame(events(), LOG), "k") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


# -- streaming -------------------------------------------------------------------
def write_batch(spark, rows, path):
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(path)


def run(spark, path, target, checkpoint):
    stream = file_stream(spark, path, target.schema, max_files=1)
    apply_changes(stream, target, checkpoint).awaitTermination()


@pytest.mark.parametrize("compact_every", [2, 100])
def test_out_of_order_batches_give_the_batch_result(spark, tmp_path, compact_every):
    rows = events()
    shuffled = rows[:]
    random.Random(3).shuffle(shuffled)
    log = f"{tmp_path}/log"
    for i in range(5):
        write_batch(spark, shuffled[i::5], log)
    schema = spark.createDataFrame([], LOG).schema
    target = ChangeTarget(f"{tmp_path}/target", ("k",), schema, compact_every)
    run(spark, log, target, f"{tmp_path}/checkpoint")
    assert target.last_batch(spark) == 4
    assert state(target.current(spark)) == brute_force(rows)
    # More files after a stop: the query goes on where it was.
    later = [event("hot", -1, "delete", 1000), event("new", 5, "insert", 1001),
             event("k1", -2, "update", -5)]
    write_batch(spark, later, log)
    run(spark, log, target, f"{tmp_path}/checkpoint")
    assert state(target.current(spark)) == brute_force(rows + later)
    # Nothing new: nothing changes.
    run(spark, log, target, f"{tmp_path}/checkpoint")
    assert state(target.current(spark)) == brute_force(rows + later)


def test_replayed_batch_changes_nothing(spark, tmp_path):
    rows = events(60)
    schema = spark.createDataFrame([], LOG).schema
    target = ChangeTarget(f"{tmp_path}/target", ("k",), schema, 2)
    for batch_id, part in enumerate((rows[:20], rows[20:40], rows[40:])):
        frame = spark.createDataFrame(part, LOG)
        target.write_batch(frame, batch_id)
        target.write_batch(frame, batch_id)
    assert state(target.current(spark)) == brute_force(rows)


def test_old_event_does_not_revive_a_deleted_key(spark, tmp_path):
    schema = spark.createDataFrame([], LOG).schema
    target = ChangeTarget(f"{tmp_path}/target", ("k",), schema, 2)
    target.write_batch(spark.createDataFrame([event("a", 9, "delete", 9)], LOG), 0)
    target.write_batch(spark.createDataFrame([event("a", 3, "update", 3)], LOG), 1)
    assert state(target.current(spark)) == []
    assert target.images(spark).count() == 1


def test_empty_target(spark, tmp_path):
    schema = spark.createDataFrame([], LOG).schema
    target = ChangeTarget(f"{tmp_path}/none", ("k",), schema)
    assert target.last_batch(spark) == -1 and target.current(spark).count() == 0
