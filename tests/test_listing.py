"""Files listed and read by tasks, against Spark's own source, which lists in the driver."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import paperwork
from tidemark.plans.doc_contracts import CONTRACTS
from tidemark.sources import files, sinks
from tidemark.streaming.apply import each_batch


def own_source(spark, path, glob):
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).load(path))


def rows(df):
    return sorted((r.path, r.modificationTime, r.length, bytes(r.content)) for r in df.collect())


def write(root, bodies):
    for name, body in bodies.items():
        target = root / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(body)


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    write(root, {
        "top.txt": b"1", "a/one.txt": b"\xff\x00", "a/b/c/two.txt": b"22", "a/three.pdf": b"333",
        "a/empty.txt": b"", "a/.hidden.txt": b"4", "a/_left.txt": b"5", "_gone/six.txt": b"6",
        ".gone/seven.txt": b"7", "k=1/eight.txt": b"8", "_k=1/nine.txt": b"9", "none/.x": b"1",
        "a/x.txt._COPYING_": b"1", "a/with space (1).txt": b"10", "a/été.txt": b"11"})
    return str(root)


@pytest.mark.parametrize("glob", ["*", "*.txt", "t*", "{one,two}.txt", "[!o]*.[tp]?[tf]", "?o*", "a+b"])
def test_the_same_files_as_the_own_source(spark, tree, glob):
    assert rows(files.binary_files(spark, tree, glob)) == rows(own_source(spark, tree, glob))
    assert rows(files.binary_files(spark, f"file://{tree}/", glob)) == rows(
        own_source(spark, f"file://{tree}/", glob))


def test_the_driver_lists_nothing(spark, tree):
    plan = files.binary_files(spark, tree)._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and "top.txt" not in plan


@pytest.mark.parametrize("domain", sorted(CONTRACTS))
def test_the_documents_of_a_domain_are_listed_by_tasks(spark, sf_dir, tmp_path, domain):
    paperwork.write_documents(spark, sf_dir, domain, str(tmp_path / "files"))
    landed = paperwork.scanned_documents(spark, str(tmp_path / "files"), domain)
    assert "binaryFile" not in landed._jdf.queryExecution().executedPlan().toString()
    made = paperwork.landed_documents(spark, sf_dir, domain).select(
        "path", "filename", "source_class", F.octet_length("content").cast("bigint"), "content")
    assert sorted(map(tuple, landed.collect())) == sorted(map(tuple, made.collect()))


def test_patterns_and_single_files_go_by_the_own_source(spark, tree):
    for path in (f"{tree}/a/*/c", f"{tree}/top.txt"):
        assert rows(files.binary_files(spark, path)) == rows(own_source(spark, path, "*")) != []


def test_bytes_are_read_only_where_they_are_asked_for(spark, tree, tmp_path):
    write(tmp_path, {"x/1": b"1", "x/2": b"2"})
    found = files.binary_files(spark, str(tmp_path / "x"))
    (tmp_path / "x/1").unlink()
    assert found.select("path", "length").count() == 2
    assert found.where("path LIKE '%2'").select(F.sha2("content", 256)).count() == 1
    with pytest.raises(Exception, match="FileNotFound"):
        found.select("content").collect()


def test_contents_larger_than_what_is_held_at_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "HELD_BYTES", 100)
    bodies = {f"{i % 3}/{i}": bytes([i]) * (i % 7 * 40 + 1) for i in range(60)}
    write(tmp_path / "x", bodies)
    found = files.binary_files(spark, str(tmp_path / "x")).coalesce(1)
    assert {r.path.split("/x/")[1]: bytes(r.content) for r in found.collect()} == bodies


def test_many_files_are_dealt_to_few_tasks(spark, tmp_path):
    docs = spark.range(3000).select(F.concat(F.col("id") % 2, F.lit("/"), "id").alias("path"),
                                    F.col("id").cast("string").alias("content"))
    sinks.write_files(docs, str(tmp_path / "x"))
    found = files.binary_files(spark, str(tmp_path / "x"))
    assert found.rdd.getNumPartitions() <= 8  # Spark's own source makes some hundred here
    assert found.where(F.element_at(F.split("path", "/"), -1) == F.col("content").cast("string")).count() == 3000


# -- new files ---------------------------------------------------------------------------
def run_of(spark, root, checkpoint, glob="*.txt", max_files=None):
    """The batches of one run of the stream: (path below the folder, content) of each."""
    batches = []
    stream = files.new_binary_files(spark, f"{root}/in", glob, max_files)
    each_batch(stream, lambda batch, _: batches.append(
        {(r.path.split("/in/")[1], bytes(r.content), r.length) for r in batch.collect()}),
        str(checkpoint)).awaitTermination()
    return batches


def test_a_run_takes_what_came_since_the_last(spark, tmp_path):
    write(tmp_path / "in", {"a/1.txt": b"1", "a/2.txt": b"22", "a/3.pdf": b"3", "a/empty.txt": b""})
    assert run_of(spark, tmp_path, tmp_path / "mark") == [{("a/1.txt", b"1", 1), ("a/2.txt", b"22", 2)}]
    assert run_of(spark, tmp_path, tmp_path / "mark") == []
    write(tmp_path / "in", {"b/c/1.txt": b"333", "a/1.txt": b"changed"})
    assert run_of(spark, tmp_path, tmp_path / "mark") == [{("b/c/1.txt", b"333", 3)}]
    # Another stream of the folder begins at the start; other files are another glob's.
    assert len(run_of(spark, tmp_path, tmp_path / "other")[0]) == 3
    assert run_of(spark, tmp_path, tmp_path / "pdf", "*.pdf") == [{("a/3.pdf", b"3", 1)}]
    assert rows(files.binary_files(spark, str(tmp_path / "in"), "1.txt")) == rows(
        own_source(spark, str(tmp_path / "in"), "1.txt"))


def test_a_bound_on_the_files_of_a_batch(spark, tmp_path):
    write(tmp_path / "in", {f"{i}.txt": b"x" for i in range(7)})
    batches = run_of(spark, tmp_path, tmp_path / "mark", max_files=3)
    assert max(map(len, batches)) <= 3 and len(batches) == 3
    assert len(set().union(*batches)) == 7
    write(tmp_path / "in", {"8.txt": b"x"})
    assert run_of(spark, tmp_path, tmp_path / "mark", max_files=3) == [{("8.txt", b"x", 1)}]


def test_an_empty_folder_has_no_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert run_of(spark, tmp_path, tmp_path / "mark") == []
    write(tmp_path / "in", {"8.txt": b"x"})
    assert run_of(spark, tmp_path, tmp_path / "mark") == [{("8.txt", b"x", 1)}]


def test_a_checkpoint_remembers_listings_not_files(spark, tmp_path):
    write(tmp_path / "in", {f"{i}.txt": b"x" for i in range(200)})
    assert len(run_of(spark, tmp_path, tmp_path / "mark")[0]) == 200
    sources = "".join(p.read_text() for p in (tmp_path / "mark/sources").rglob("[0-9]*") if p.is_file())
    assert 0 < sources.count('"path"') <= 8
