"""Metadata files as rows of path and scalar, and what is read from them."""

import pytest

from trialmill.sources import metadata as md

DOC = '''# a comment
---
name: demo   # trailing
"quoted key": "a # b: \\"c\\""
single: 'it''s: fine'
url: http://x/y#z
empty:
nothing: ~
flag: Yes
gate_policy:
  # inner comment

  default_mode: warn
  gates:
    evaluation:
      mode: block
      threshold: 1e-1
    security: {mode: block, threshold: 0.5, tags: [a, 'b c', 3], "on": true}
    quality:
      mode: "0.5"
list:
- one
- key: v
  other: w
-   - nested
    - 2
indented:
  - x
  - y: |
      line one
        deeper

      line three
  - z
folded: >-
  joins these
  lines

  not these
continued: this goes
  on here   # not this
name: last
'''
PATHS = [
    ("name", "string", "demo"), ("quoted key", "string", 'a # b: "c"'), ("single", "string", "it's: fine"), ("url", "string", "http://x/y#z"),
    ("empty", "null", None), ("nothing", "null", None), ("flag", "bool", "true"), ("gate_policy/default_mode", "string", "warn"),
    ("gate_policy/gates/evaluation/mode", "string", "block"), ("gate_policy/gates/evaluation/threshold", "number", "1e-1"),
    ("gate_policy/gates/security/mode", "string", "block"), ("gate_policy/gates/security/on", "bool", "true"),
    ("gate_policy/gates/security/tags/0", "string", "a"), ("gate_policy/gates/security/tags/1", "string", "b c"),
    ("gate_policy/gates/security/tags/2", "number", "3"), ("gate_policy/gates/security/threshold", "number", "0.5"),
    ("gate_policy/gates/quality/mode", "string", "0.5"), ("list/0", "string", "one"), ("list/1/key", "string", "v"), ("list/1/other", "string", "w"),
    ("list/2/0", "string", "nested"), ("list/2/1", "number", "2"), ("indented/0", "string", "x"),
    ("indented/1/y", "string", "line one\n  deeper\n\nline three\n"), ("indented/2", "string", "z"),
    ("folded", "string", "joins these lines\nnot these"), ("continued", "string", "this goes on here"), ("name", "string", "last"),
]


def paths(spark, *texts):
    files = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, content string")
    rows = md.document_paths(files).orderBy("id", "line").collect()
    return [[("/".join(r.path), r.kind, r.value) for r in rows if r.id == i] for i in range(len(texts))]


def test_every_scalar_with_its_path(spark):
    got, windows = paths(spark, DOC, DOC.replace("\n", "\r\n"))
    assert sorted(got, key=str) == sorted(PATHS, key=str) and windows == got
    assert [x for x in got if x[0] == "name"] == [("name", "string", "demo"), ("name", "string", "last")]


def test_odd_documents(spark):
    got = paths(spark, None, "", "\n \n# only\n", "a:\n\tb: 1\n", "a: &x 1\nb: *x\n", "a: {b: [c,\n  d]}\nx: {k: 1,\n  l: 2}\n", "- - 1\n  - 2\n-\n  k: v\n", "plain text\n", "a: {b: {c: {d: 1}}, e: {f: {g: {h: 1}}}, \"i\":2}", "a: |\n", "x: [ ]")
    assert got[:3] == [[], [], []]
    assert [k for _, k, _ in got[3]] == ["unknown"]
    assert [(p, k) for p, k, _ in got[4]] == [("a", "unknown"), ("b", "unknown")]
    assert got[5][:3] == [("a/b/0", "string", "c"), ("a/b/1", "string", "d"), ("x", "unknown", "{k: 1,")]
    assert got[6] == [("0/0", "number", "1"), ("0/1", "number", "2"), ("1/k", "string", "v")]
    assert got[7] == [("", "string", "plain text")]
    assert [x[:2] for x in got[8]] == [("a/b/c/d", "number"), ("a/e/f/g", "unknown"), ("a/i", "number")] and got[9] == [("a", "string", "")] and got[10] == []


def test_gate_policies_block_flow_and_unreadable(spark):
    block = "name: a\ngate_policy:\n  combination: weighted\n  gates:\n    evaluation:\n      threshold: 0.4\n      push_fact: true\n    cisco: {mode: disabled, weight: 2}\n"
    flow = "gate_policy: {default_mode: block, gates: {evaluation: {threshold: .75, mode: block}}}\n"
    rows = [("block", block), ("flow", flow), ("none", "name: x\n"), ("word", "gate_policy:\n  gates:\n    evaluation:\n      threshold: high\n"),
            ("elsewhere", "gates:\n  evaluation:\n    threshold: 0.3\n"), ("alias", "gate_policy:\n  default_mode: *x\n"), ("null", None)]
    items, defaults = md.gate_policy_documents(spark.createDataFrame(rows, "submission_name string, content string"))
    assert sorted(tuple(r) for r in items.collect()) == [
        ("block", "cisco", "disabled", None, 2.0, False), ("block", "evaluation", "warn", 0.4, 1.0, True), ("flow", "evaluation", "block", 0.75, 1.0, False),
    ]
    assert {r.submission_name: tuple(r)[1:] for r in defaults.collect()} == {
        "block": ("weighted", "warn", 0.4, "own"), "flow": ("all_pass", "block", 0.75, "own"), "none": ("all_pass", "warn", None, "default"),
        "word": ("all_pass", "warn", None, "unreadable"), "elsewhere": ("all_pass", "warn", None, "default"),
        "alias": ("all_pass", "warn", None, "unreadable"), "null": ("all_pass", "warn", None, "default"),
    }


PROFILES = """default_profile: two
profiles:
  one:
    foundational:
      checks: [metadata_compliance]
      thresholds: {instruction_quality: 0.6}
  two:
    trusted:
      checks:
        - evaluation_assets   # why
        # - not_this_one
"""


def test_profiles_are_joined_as_a_table(spark):
    profiles = md.profile_policies(spark.createDataFrame([(PROFILES,)], "content string"))
    got = {r.profile: r for r in profiles.collect()}
    assert got["two"].is_default and not got["one"].is_default and got["two"].trusted_checks == ["evaluation_assets"]
    assert got["one"].foundational_checks == ["metadata_compliance"] and got["one"].foundational_thresholds == {"instruction_quality": 0.6}
    assert got["one"].trusted_checks is None
    own = md.certification_policies(spark.createDataFrame([("a", "certification_policy:\n  certified:\n    checks: [functional_validation]\n"), ("b", "name: b\n")], "submission_name string, content string"))
    subs = spark.createDataFrame([("a", "one"), ("b", "two"), ("c", None)], "submission_name string, profile string")
    rows = {r.submission_name: r for r in md.with_profile(own, subs, profiles).collect()}
    assert set(rows) == {"a", "b"} and rows["a"].certified_checks == ["functional_validation"] and rows["a"].foundational_checks is None
    assert rows["b"].trusted_checks == ["evaluation_assets"]
    with pytest.raises(Exception, match="unknown certification profile: three"):
        md.with_profile(own, spark.createDataFrame([("d", "three")], "submission_name string, profile string"), profiles).collect()
    with pytest.raises(Exception, match="unknown certification checks: no_such"):
        md.profile_policies(spark.createDataFrame([(PROFILES.replace("metadata_compliance", "no_such"),)], "content string")).collect()


def test_runs_from_their_files(spark):
    summary = "run_id: r\nmean_reward: 0.5\nrun_metrics:\n  cost: 1.5\n  turns: {max: 3}\nper_case:\n  - {case: c}\n"
    result = '{"mean_reward": 0.25, "duration_s": 2, "cost_usd": 0.1, "token_usage": {"in": 1}, "num_turns": 4, "n_infra_errors": 1, "n_trial_errors": 0}'
    rows = [("both", "summary.yaml", summary), ("both", "run_result.json", result), ("summary", "summary.yaml", summary + "pairwise:\n  wins: 1\n"),
            ("null", "summary.yaml", summary), ("null", "run_result.json", '{"mean_reward": null}'), ("bad", "summary.yaml", "a: {"), ("bad", "run_result.json", "{"), ("x", "other", "")]
    got = {r.run_dir: r for r in md.run_summaries(spark.createDataFrame(rows, "run_dir string, name string, content string")).collect()}
    assert {k: (r.mean_reward, r.mode) for k, r in got.items()} == {"both": (0.25, "single"), "summary": (0.5, "pairwise"), "null": (None, "single"), "bad": (0.0, "single")}
    assert (got["both"].num_turns, got["both"].n_infra_errors, got["both"].n_trial_errors, got["both"].tokens) == (4, 1, 0, '{"in":1}')
    assert [tuple(m) for m in got["both"].run_metrics] == [("cost", "1.5"), ("turns.max", "3")]

def test_few_files_of_short_rows_are_read_by_many_tasks(spark, tmp_path):
    from trialmill.plans import metadata_queries

    spark.range(100).selectExpr("id AS p_partkey", "'n' AS p_name", "1 AS p_size").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    files = metadata_queries.metadata_files(spark, str(tmp_path))
    assert files.count() == 100
    assert files.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_lines_of_every_shape_keep_their_paths(spark):
    text = "a:\r\n- - x # c\n  - 'it''s'\n- {k: [1, {m: yes}], n: \"q\\n\"}\nb: |\n  one\n   two # kept\n\nc: plain\n  goes on\n#d: no\ne: {\"j\": null}\n"
    df = spark.createDataFrame([("f", text), ("g", None)], "f string, content string")
    rows = [(".".join(r.path), r.kind, r.value) for r in md.document_paths(df).collect()]
    assert rows == [
        ("a.0.0", "string", "x"), ("a.0.1", "string", "it's"), ("a.1.k.0", "number", "1"), ("a.1.k.1.m", "bool", "true"), ("a.1.n", "string", "q\n"),
        ("b", "string", "one\n two # kept\n"), ("c", "string", "plain goes on"), ("e.j", "null", None),
    ]
