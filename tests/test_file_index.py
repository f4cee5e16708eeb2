"""The file index: the same rows as Spark's file source, listing in tasks, pushed paths and the stream."""

import os
import time

import pytest
from pyspark.sql.datasource import EqualTo, In, IsNotNull, StringStartsWith
from pyspark.sql.types import _parse_datatype_string

from trialmill.sources import file_index as I
from trialmill.sources.files import read_files, trial_rows


def write(root, contents, seconds=None):
    for path, text in contents.items():
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(text.encode() if isinstance(text, str) else text)
        if seconds is not None:
            os.utime(target, (seconds, seconds))


@pytest.fixture
def tree(tmp_path):
    files = {f"r{i}/{v}/job/t{t}/result.json": '{"verifier_result":{"reward":%s}}' % (i / 10) for i in range(9) for v in ("treatment", "control") for t in range(3)}
    write(tmp_path / "in", files | {"r1/treatment/job/notes.txt": "x", "top.json": "{}", "r2/empty.json": "", "r3/odd é.json": b"\xff\xfe", "r4/deep/a/b/c/d.json": "d"})
    return str(tmp_path / "in")


EMPTY = ("r2/empty.json", 0, "")  # Spark's file source leaves empty files out, the index does not


def rows(df):
    return sorted((r.path, r.size, r.content) for r in df.collect())


def test_same_rows_as_the_file_source(spark, tree):
    want = read_files(spark, tree, "*.json")
    for partitions in (1, 4, 100):
        got = I.indexed_files(spark, tree, "*.json", partitions=partitions)
        assert rows(got) == sorted([*rows(want), EMPTY]) and got.dtypes == want.dtypes
    time_ = "date_trunc('MILLISECOND', modified) AS t"
    assert sorted(got.where("size > 0").selectExpr("path", time_).collect()) == sorted(want.selectExpr("path", time_).collect())
    assert rows(trial_rows(got).selectExpr("trial_name path", "1 size", "pipeline_run_id content")) == rows(trial_rows(want).selectExpr("trial_name path", "1 size", "pipeline_run_id content"))


def test_folders_without_files(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert I.indexed_files(spark, str(tmp_path / "none"), "*").collect() == []
    assert I.indexed_files(spark, f"file://{tmp_path}/none").collect() == []


def reader(kind, root, **options):
    return kind(_parse_datatype_string(I.SCHEMA), {"path": root} | options)


def test_the_driver_plans_ranges_of_names_and_no_files(tree, monkeypatch):
    listed = []
    real = I.fs.LocalFileSystem

    class Watched:
        def __init__(self):
            self.inner = real()

        def get_file_info(self, what):
            listed.append((what.base_dir, what.recursive))
            return self.inner.get_file_info(what)

    monkeypatch.setattr(I.fs, "LocalFileSystem", Watched)
    parts = reader(I.FileReader, tree, partitions="3").partitions()
    assert listed == [(tree, False)]  # the first level only
    assert len(parts) == 3 and all(set(vars(p)) == {"first", "last", "after", "until", "value"} for p in parts)
    assert parts[0].first == "r0" and parts[-1].last == "top.json"


def test_paths_are_pushed(spark, tree):
    r = reader(I.PushingFileReader, tree, partitions="100")
    kept = list(r.pushFilters([StringStartsWith(("path",), "r1/tre"), In(("path",), ("r1/treatment/job/t0/result.json", "r5/x")), IsNotNull(("path",)), EqualTo(("size",), 3)]))
    assert [type(f).__name__ for f in kept] == ["In", "IsNotNull", "EqualTo"]
    assert [(p.first, p.last) for p in r.partitions()] == [("r1", "r1")]
    assert [path for p in r.partitions() for _, _, path in r.listed(p)] == ["r1/treatment/job/t0/result.json"]
    old = spark.conf.get(I.PUSHDOWN, "false")
    spark.conf.set(I.PUSHDOWN, "true")
    try:
        df = I.indexed_files(spark, tree, "*.json")
        for wanted in ("path like 'r1/%'", "path = 'top.json'", "path in ('r2/empty.json', 'top.json')", "path like 'r1/%' and size > 5", "content = ''", "content like 'd%'"):
            assert [r for r in rows(df.where(wanted)) if r != EMPTY] == rows(read_files(spark, tree, "*.json").where(wanted))
        assert rows(df.where("path like 'r2/empty%'")) == [EMPTY]
    finally:
        spark.conf.set(I.PUSHDOWN, old)


def test_stream_reads_each_file_once(spark, tmp_path):
    root, state, out = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "out")
    now = time.time()

    def run():
        files = I.file_stream(spark, str(root), "*.json", settle_seconds=5)
        files.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()
        return sorted((r.path, r.content) for r in spark.read.parquet(out).collect())

    write(root, {"a/1.json": "one", "b/2.json": "two", "b/x.txt": "no"}, now - 100)
    write(root, {"c/young.json": "not settled"}, now + 3600)
    assert run() == [("a/1.json", "one"), ("b/2.json", "two")]
    write(root, {"a/3.json": "three", "new/4.json": "four"}, time.time() - 5.5)
    time.sleep(0.5)
    first = run()
    assert first in ([("a/1.json", "one"), ("b/2.json", "two")], sorted([("a/1.json", "one"), ("b/2.json", "two"), ("a/3.json", "three"), ("new/4.json", "four")]))
    write(root, {"z/5.json": "five"})
    time.sleep(6)
    assert [p for p, _ in run()] == [p for p, _ in first] + ["z/5.json"]


def test_stream_positions_are_times(tree):
    r = reader(I.FileStreamReader, tree, partitions="2", settleSeconds="0")
    parts = r.partitions(r.initialOffset(), r.latestOffset())
    assert len(parts) == 2 and len(str(r.latestOffset())) < 60
    assert sum(1 for p in parts for _ in r.listed(p)) == 59  # every file has been modified by now
