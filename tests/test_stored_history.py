"""Partitioned history: commits, reruns, overlapping writers, interrupted attempts, merges and the filters before the join."""

import pytest
from pyspark.sql import functions as F

from trialmill.sinks import history as H
from trialmill.sinks import tables
from trialmill.sinks.history import HistoryStore


def runs(spark, ids, word="x"):
    rows = [(i, f"s-{i}", word) for i in ids]
    return spark.createDataFrame(rows, "pipeline_run_id string, submission_name string, recommendation string")


def trials(spark, ids, n=2):
    return spark.createDataFrame([(i, "treatment", t, 0.5) for i in ids for t in range(n)], "pipeline_run_id string, variant string, trial_no int, reward double")


def batch(spark, ids, word="x"):
    return {"evaluation_runs": runs(spark, ids, word), "trials": trials(spark, ids)}


def stored(history, table="evaluation_runs", column="recommendation"):
    return sorted((r.pipeline_run_id, r[column]) for r in history.read(table).collect())


@pytest.fixture
def history(spark, tmp_path):
    return HistoryStore(spark, str(tmp_path / "history"), buckets=4, slots=1)


def test_reruns_and_repeats_add_nothing(spark, history):
    assert history.read("trials") is None and history.version() == 0
    ids = ["a", "b", "c"]
    double = {k: v.union(v) for k, v in batch(spark, ids).items()}
    assert history.store(double, "one") == 1
    assert history.store(double, "one") == 1 and history.version() == 1  # the id is known
    assert history.store(batch(spark, ids, "later")) == 1  # nothing is new
    assert history.store(batch(spark, ["c", "d", None], "later"), "two") == 2
    assert stored(history) == [("a", "x"), ("b", "x"), ("c", "x"), ("d", "later")]
    assert history.read("trials").count() == 8
    with pytest.raises(ValueError, match="no table"):
        history.store({"other": runs(spark, ["a"])})


def test_overlapping_writers_store_a_run_once(spark, history, tmp_path):
    history.store(batch(spark, ["old"]))
    other = HistoryStore(spark, history.folder, buckets=4, slots=1)
    turns = iter([["b", "c"], ["z"], []])

    def between():  # what another writer commits between staging and commit
        if ids := next(turns):
            other.store(batch(spark, ids, "other"))

    history.before_commit = between
    history.store(batch(spark, ["a", "b", "old"], "mine"))
    assert stored(history) == [("a", "mine"), ("b", "other"), ("c", "other"), ("old", "x"), ("z", "other")]
    assert history.read("trials").count() == 10


def test_two_first_writers(spark, history):
    other = HistoryStore(spark, history.folder, buckets=4, slots=1)
    once = iter([True])
    history.before_commit = lambda: next(once, False) and other.store(batch(spark, ["a"], "other"), "same")
    assert history.store(batch(spark, ["a"], "mine"), "same") == 1  # the other one has stored this batch
    assert stored(history) == [("a", "other")] and history.read("trials").count() == 2


def test_all_tables_appear_together(spark, history):
    class Lost(Exception):
        pass

    def fail():
        raise Lost

    history.store(batch(spark, ["a"]))
    history.before_commit = fail
    with pytest.raises(Lost):
        history.store(batch(spark, ["b"]), "two")
    assert spark.read.parquet(f"{history.folder}/trials").where("pipeline_run_id = 'b'").count() == 2  # written, named by no commit
    assert stored(history) == [("a", "x")] and history.read("trials").count() == 2
    history.before_commit = lambda: None
    history.store(batch(spark, ["b"]), "two")
    assert stored(history) == [("a", "x"), ("b", "x")] and history.read("trials").count() == 4


def test_a_reader_lists_only_its_partitions(spark, history):
    ids = [f"r{i}" for i in range(40)]
    history.store(batch(spark, ids))
    one = history.read("trials", runs=["r7"])
    assert one.count() == 2
    plan = one._jdf.queryExecution().executedPlan().toString()
    bucket = spark.range(1).select(history.bucket_of(F.lit("r7"))).first()[0]
    assert "PartitionFilters: [isnotnull(bucket#" in plan or "PartitionFilters: [(bucket#" in plan
    assert f"= {bucket})" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(r.pipeline_run_id for r in history.read("evaluation_runs", runs=["r1", "r2", "no"]).collect()) == ["r1", "r2"]


def test_filters_pass_what_is_stored_and_little_else(spark, history):
    ids = [f"r{i}" for i in range(3000)]
    history.store({"evaluation_runs": runs(spark, ids)})
    asked = spark.createDataFrame([("evaluation_runs", f"r{i}") for i in range(6000)], "table string, pipeline_run_id string")
    asked = asked.withColumn("bucket", history.bucket_of(F.col("pipeline_run_id")))
    passed = {r.pipeline_run_id for r in history.perhaps_stored(asked, [0, 1, 2, 3]).collect()}
    assert set(ids) <= passed and len(passed) < 3000 + 60
    new = {r.pipeline_run_id for r in history.perhaps_stored(asked.withColumn("table", F.lit("mcpchecker_results")), [0, 1, 2, 3]).collect()}
    assert len(new) < 60


def report(name):
    import json

    trial = [{"trial_name": "t", "reward": 1.0}]
    return json.dumps({"submission_name": name, "summary": {"recommendation": "pass"}, "trials": {"treatment": trial, "control": trial}})


def test_stream_stores_every_batch_once(spark, history, tmp_path):
    """Stopped between writing the tables and the commit, and between the commit and the checkpoint."""
    from trialmill.streaming import ingest

    def write(name):
        folder = tmp_path / "in" / name
        folder.mkdir(parents=True)
        (folder / "report.json").write_text(report(name))

    def run(store):
        reports = ingest.report_stream(spark, str(tmp_path / "in"), 1)
        return ingest.ingest_history(reports, store, str(tmp_path / "state"), once=True).awaitTermination()

    class Stopped(HistoryStore):
        def store(self, rows, batch_id=None):
            out = super().store(rows, batch_id)
            if self.after:
                raise RuntimeError("stopped after the commit")
            return out

    write("r1")
    run(history)
    write("r2")
    write("r3")
    broken = Stopped(spark, history.folder, 4, 1)
    broken.after, broken.before_commit = False, lambda: 1 / 0
    with pytest.raises(Exception, match="division"):
        run(broken)
    assert [r for r, _ in stored(history)] == ["r1"]
    broken.after, broken.before_commit = True, lambda: None
    with pytest.raises(Exception, match="stopped after"):
        run(broken)
    assert len(stored(history)) == 2
    run(history)
    assert stored(history) == [("r1", "pass"), ("r2", "pass"), ("r3", "pass")] and history.read("trials").count() == 6
    ids = [r.batch_id for r in history.commits().collect()]
    assert len(set(ids)) == len(ids) == 3 and all(i.endswith(("-0", "-1", "-2")) and len(i) > 30 for i in ids)


def scan_rows(spark, rows):
    return spark.createDataFrame(rows, "pipeline_run_id string, scanner string, findings_count int")


def test_scans_are_guarded_by_themselves(spark, history):
    history.store({"security_scans": scan_rows(spark, [("a", "x", 1), ("a", "y", 2)])})
    both = batch(spark, ["a", "b"]) | {"security_scans": scan_rows(spark, [("a", "z", 9), ("b", "x", 3), ("b", "x", 3), ("b", "y", 4)])}
    history.store(both)
    got = sorted((r.pipeline_run_id, r.scanner) for r in history.read("security_scans").collect())
    assert got == [("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")] and len(stored(history)) == 2
    # scans of a run that is skipped are skipped with it
    history.store(batch(spark, ["n"]))
    history.store(batch(spark, ["n"]) | {"security_scans": scan_rows(spark, [("n", "x", 1)])})
    assert history.read("security_scans", runs=["n"]).count() == 0


def test_other_engine_runs_have_their_own_ids(spark, history):
    results = spark.createDataFrame([("a", 0.5)], "pipeline_run_id string, overall_score double")
    tasks = spark.createDataFrame([("a", 0, "t"), ("a", 1, "t"), ("q", 0, "t")], "pipeline_run_id string, task_no int, task_id string")
    history.store(batch(spark, ["a"]))
    history.store({"mcpchecker_results": results, "mcpchecker_tasks": tasks})
    history.store({"mcpchecker_results": results, "mcpchecker_tasks": tasks})
    assert history.read("mcpchecker_results").count() == 1 and history.read("mcpchecker_tasks").count() == 2


SCAN = "pipeline_run_id string, scanner string, scan_mode string, created_at string, passed boolean, findings_count int, findings array<string>, seq int"


def test_merge_rewrites_only_touched_buckets(spark, history):
    first = [(f"r{i}", "x", "warn", "d1", True, 1, ["old"], 1) for i in range(12)]
    history.merge("security_scans", spark.createDataFrame(first, SCAN), H.merge_scans)
    before = {r.bucket: r.batch for r in history.visible("security_scans").collect()}
    change = [("r3", "x", "block", "d2", False, 5, ["new"], 2), ("r3", "x", "block", "d2", False, 4, ["older"], 0), ("r3", "y", "warn", "d3", True, 0, [], 1)]
    history.merge("security_scans", spark.createDataFrame(change, SCAN), H.merge_scans)
    after = {r.bucket: r.batch for r in history.visible("security_scans").collect()}
    touched = spark.range(1).select(history.bucket_of(F.lit("r3"))).first()[0]
    assert {b for b in after if after[b] != before.get(b)} == {touched}
    got = {(r.pipeline_run_id, r.scanner): r for r in history.read("security_scans").collect()}
    assert len(got) == 13 and got["r5", "x"].findings == ["old"]
    r = got["r3", "x"]
    assert (r.scan_mode, r.created_at, r.findings_count, r.passed, r.findings) == ("block", "d2", 5, False, ["new"])  # seq 0 came first
    assert (got["r3", "y"].scan_mode, got["r5", "x"].scan_mode) == ("warn", "warn")
    history.compact("security_scans")
    assert history.read("security_scans").count() == 13


def test_merge_sees_what_another_writer_stored_meanwhile(spark, history):
    other = HistoryStore(spark, history.folder, buckets=4, slots=1)
    row = lambda n, seq: spark.createDataFrame([("a", "x", "warn", f"d{seq}", True, n, [str(n)], seq)], SCAN)
    history.merge("security_scans", row(1, 1), H.merge_scans)
    once = iter([True])
    history.before_commit = lambda: next(once, False) and other.merge("security_scans", row(3, 3), H.merge_scans)
    history.merge("security_scans", row(2, 2), H.merge_scans)
    got = history.read("security_scans").collect()
    assert [(r.findings_count, r.created_at) for r in got] == [(3, "d1")]
    # a scan that was merged guards the run like any other
    history.store({"security_scans": scan_rows(spark, [("a", "z", 9)])})
    assert history.read("security_scans").count() == 1


def test_compaction_keeps_rows(spark, history):
    for i in range(4):
        history.store(batch(spark, [f"r{i}{j}" for j in range(5)]))
    history.compact("trials")
    assert history.visible("trials").groupBy("bucket").count().where("count > 1").isEmpty()
    assert history.read("trials").count() == 40 and len(stored(history)) == 20
    history.store(batch(spark, ["r00", "new"]))
    assert history.read("trials").count() == 42


def test_documents_give_gate_and_certification_rows(spark):
    text = """{"pipeline_run_id":"r","submission_name":"s","eval_engine":"harbor","recommendation":"warn","recommendation_reason":"why",
      "policy":{"combination":"weighted"},"gates_passed":1,"gates_failed":2,"blocking_gates_passed":0,"blocking_gates_failed":1,"highest_certification":"foundational",
      "gates":[{"gate_name":"security","gate_type":"security","policy_key":"cisco","passed":false,"score":0.25,"mode":"block","threshold":0.5,
                "findings":[{"a":1},{"a":2}],"message":"m","details":{"k":[1]}},
               {"gate_name":"quality","gate_type":"quality","policy_key":"","passed":true,"score":1,"details":{}}],
      "certification":{"foundational":{"level":"foundational","passed":true,"checks_total":2,"checks_passed":2,"checks":[{"check_id":"c1","passed":true}]},
                       "trusted":{"level":"trusted","passed":false,"checks_total":2,"checks_passed":1,"checks":[{"check_id":"c2","passed":false},{"check_id":"c3","passed":true}]}}}"""
    docs = spark.createDataFrame([("r", text), ("bad", "{"), ("none", "{}")], "pipeline_run_id string, artifact_text string")
    docs = docs.withColumn("doc", F.try_parse_json("artifact_text"))
    card = tables.scorecard_document_rows(docs).where("pipeline_run_id = 'r'").first()
    assert (card.combination_mode, card.gates_failed, card.highest_certification) == ("weighted", 2, "foundational")
    gates = {r.gate_no: r for r in tables.gate_result_rows(docs).collect()}
    assert [(g.policy_key, g.mode, g.findings_count, g.details_json, g.threshold) for g in (gates[0], gates[1])] == [
        ("cisco", "block", 2, '{"k":[1]}', 0.5), ("quality", "warn", 0, None, None)]
    levels = {r.level: (r.passed, r.checks_failed, r.failed_checks) for r in tables.certification_rows(docs).collect()}
    assert levels == {"foundational": (True, 0, None), "trusted": (False, 1, ["c2"])}


def test_a_bucket_of_runs_is_written_by_several_tasks(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path), buckets=8)
    runs = spark.range(2000).selectExpr("concat('r', id) AS pipeline_run_id").union(spark.sql("SELECT 'r1'"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.store({"evaluation_runs": runs})
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = {(p.parent, p.name) for p in tmp_path.glob("evaluation_runs/bucket=*/batch=*/*.parquet")}
    assert len(files) > 8
    assert store.read("evaluation_runs").count() == 2000


def test_documents_are_made_once_for_all_tables_of_a_batch(spark, tmp_path):
    from trialmill.plans import history_queries as hq

    lines = "id AS l_orderkey, 1 AS l_partkey, cast(1 + id % 4 AS int) AS l_linenumber, 41.0D AS l_quantity, 9.5D AS l_extendedprice, 0.1D AS l_discount, 0.0D AS l_tax, 'N' AS l_returnflag"
    spark.sql(f"SELECT {lines} FROM range(20)").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT id AS o_orderkey, id AS o_custkey, 'F' AS o_orderstatus, '1-URGENT' AS o_orderpriority FROM range(20)").write.parquet(f"{tmp_path}/orders.parquet")
    for rows in (hq.run_reports(hq.run_trials(spark, str(tmp_path)), "x"), hq.gate_documents(spark, str(tmp_path))):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan
        assert rows.where("doc is not null").count() == 20
