"""Queries on submissions: references, policy, structure, reviews, prompts and payload rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialmill.functions import text as tx
from trialmill.operators import facts, history, policy, references, reviews, validate
from trialmill.plans import gate_queries
from trialmill.plans import relations as rel
from trialmill.plans.gate_queries import CARDS, GATES, ITEMS, JUDGED
from trialmill.plans.registry import Registry, rounded
from trialmill.plans.run_queries import RUNS, degradation_sql

registry = Registry()
SUB = "submission_name"


def linked_skills(spark, sf):
    """Documents as skills, five per submission: a ring of five, a chain, or two rings of two."""
    k = F.col("doc_id")
    group, place = F.floor(k / 5), k % 5
    ring = group * 5 + (place + 1) % 5
    pair = group * 5 + F.when(place % 2 == 0, place + 1).otherwise(place - 1)
    target = F.when(group % 3 == 0, ring).when((group % 3 == 1) & (place < 4), k + 1).when((group % 3 == 2) & (place < 4), pair)
    return rel.table(spark, sf, "documents").select(
        F.concat(F.lit("sub-"), group).alias(SUB),
        F.concat(F.lit("skills/sk-"), k, F.lit("/SKILL.md")).alias("file_path"),
        F.concat("text", F.coalesce(F.concat(F.lit("\nThen invoke sk-"), target, F.lit(" and /unknown-one now")), F.lit(""))).alias("content"),
    )


LINKED = """nodes AS (SELECT doc_id AS k, doc_id // 5 AS g, doc_id % 5 AS p, max(doc_id) OVER () AS top FROM documents),
  edges AS (SELECT g, k, CASE WHEN g % 3 = 0 THEN g * 5 + (p + 1) % 5 WHEN g % 3 = 1 AND p < 4 THEN k + 1
    WHEN g % 3 = 2 AND p < 4 THEN CASE WHEN p % 2 = 0 THEN k + 1 ELSE k - 1 END END AS t, top FROM nodes)"""


@registry.add(
    "skill_references",
    f"WITH {LINKED} SELECT 'sub-' || g AS submission_name, 'sk-' || k AS src, 'sk-' || t AS dst FROM edges WHERE t IS NOT NULL AND t <= top",
)
def skill_references(spark, sf):
    return references.skill_edges(linked_skills(spark, sf))


IN_CYCLES = f"""{LINKED}, c AS (SELECT g, g AS cycle, k, t FROM edges WHERE g % 3 = 0
          UNION ALL SELECT g, least(k, t) + 1000000, k, t FROM edges WHERE g % 3 = 2 AND t IS NOT NULL),
        whole AS (SELECT g, cycle, list(k ORDER BY k) AS ks, min('sk-' || k) AS first FROM c GROUP BY g, cycle
          HAVING max(t) <= (SELECT max(doc_id) FROM documents))"""


@registry.add(
    "cycle_members",
    f"""WITH {IN_CYCLES} SELECT 'sub-' || g AS submission_name, len(ks) AS n_nodes,
          array_to_string(list_sort(list_transform(ks, lambda k: 'sk-' || k)), ',') AS nodes FROM whole""",
)
def cycle_members(spark, sf):
    members = references.cycle_components(references.skill_edges(linked_skills(spark, sf)))
    return members.groupBy(SUB, "component").agg(
        F.count(F.lit(1)).alias("n_nodes"), F.array_join(F.array_sort(F.collect_set("node")), ",").alias("nodes")
    ).drop("component")


@registry.add(
    "circular_references",
    f"""WITH {IN_CYCLES}, placed AS (SELECT *, list_position(list_transform(ks, lambda k: 'sk-' || k), first) AS i FROM whole)
        SELECT 'sub-' || g AS submission_name, 'skills/' || first || '/SKILL.md' AS file_path, 'medium' AS severity, 'quality-circular-reference' AS rule_id,
          'circular_reference' AS category, 'Circular reference detected: ' ||
          array_to_string(list_transform(ks[i:] || ks[:i], lambda k: 'sk-' || k), ' -> ') AS message FROM placed""",
)
def circular_references(spark, sf):
    return references.circular_references(linked_skills(spark, sf)).drop("line")


def part_metadata(spark, sf):
    k = F.col("p_partkey")
    return rel.table(spark, sf, "part").select(
        F.concat(F.lit("sub-"), k).alias(SUB),
        (k % 3 != 0).alias("enabled"),
        F.when(k % 2 == 0, (k % 8).cast("int")).alias("cpus"),
        F.when(k % 5 != 0, (k % 12 * 1000).cast("int")).alias("memory_mb"),
        F.when(k % 7 != 0, (k % 9 * 500).cast("double")).alias("agent_timeout_sec"),
    )


def part_sources(spark, sf):
    k = F.col("p_partkey")
    bad = F.lit("def test():\n    try:\n        run()\n    except Exception:\n        pass\n    assert True\n")
    worse = F.lit("try:\n    a()\nexcept:\n    ...\ntry:\n    b()\nexcept Exception as e: pass\n")
    good = F.lit("try:\n    a()\nexcept Exception:\n    pass\n    log()\nexcept ValueError:\n    pass\nassert 1\n")
    tests = rel.table(spark, sf, "part").select(
        F.concat(F.lit("sub-"), k).alias(SUB), F.lit("tests/test_outputs.py").alias("file_path"),
        F.when(k % 4 == 0, bad).when(k % 4 == 1, worse).otherwise(good).alias("content"),
    )
    skills = rel.table(spark, sf, "part").select(
        F.concat(F.lit("sub-"), k).alias(SUB), F.lit("SKILL.md").alias("file_path"),
        F.when(k % 6 == 0, "Do not log this. Turn off logging too\n> disable logging\n")
        .otherwise("Do not log passwords\n```\nno logging\n```\n").alias("content"),
    )
    return tests.unionByName(skills)


@registry.add(
    "operational_policy",
    """WITH m AS (SELECT p_partkey AS k, p_partkey % 3 <> 0 AS enabled,
          coalesce(CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 8 END, 1) > 4 AS c,
          coalesce(CASE WHEN p_partkey % 5 <> 0 THEN p_partkey % 12 * 1000 END, 2048) > 8192 AS mem,
          coalesce(CASE WHEN p_partkey % 7 <> 0 THEN p_partkey % 9 * 500 END, 600) > 3600 AS t,
          p_partkey % 2 <> 0 OR p_partkey % 5 = 0 OR p_partkey % 7 = 0 AS undeclared FROM part),
        i AS (SELECT k, CASE WHEN enabled THEN c::INT + mem::INT + t::INT + CASE k % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END ELSE 0 END AS h,
          CASE WHEN enabled THEN undeclared::INT + CASE WHEN k % 6 = 0 THEN 2 ELSE 0 END ELSE 0 END AS l FROM m)
       SELECT 'sub-' || k AS submission_name, h = 0 AS passed, (greatest(0.0, 1.0 - (0.35 * h + 0.15 * l)))::DOUBLE AS score,
         h::BIGINT AS high_issues, l::BIGINT AS low_issues FROM i""",
)
def operational_policy(spark, sf):
    meta = part_metadata(spark, sf)
    return rounded(policy.operational_policy(meta.select(SUB, "enabled"), meta.drop("enabled"), part_sources(spark, sf)))


@registry.add(
    "metadata_errors",
    """WITH e AS (SELECT c_custkey AS k, unnest(list_filter([
          CASE WHEN c_custkey % 5 = 0 THEN 'name must be OCI-safe' END, CASE WHEN c_custkey % 7 = 0 THEN 'schema_version must be MAJOR.MINOR' END,
          CASE WHEN c_custkey % 4 = 0 THEN 'cpus must be above 0' END, CASE WHEN c_custkey % 130 NOT BETWEEN 1 AND 100 THEN 'n_trials must be in 1..100' END,
          CASE WHEN c_custkey % 12 > 10 THEN 'threshold must be in [0, 1]' END, CASE WHEN c_custkey % 6 = 1 THEN 'dest must be absolute' END,
          CASE WHEN c_custkey % 6 = 2 THEN 'duplicate src' END, CASE WHEN c_custkey % 6 = 3 THEN 'src must be relative' END], lambda x: x IS NOT NULL)) AS error FROM customer)
       SELECT 'sub-' || k AS submission_name, error FROM e""",
)
def metadata_errors(spark, sf):
    k = F.col("c_custkey")

    def copy(src, dest):
        return F.struct(F.lit(src).alias("src"), F.lit(dest).alias("dest"))

    rows = rel.table(spark, sf, "customer").select(
        F.concat(F.lit("sub-"), k).alias(SUB),
        F.concat(F.when(k % 5 == 0, "Sub_").otherwise("sub."), k).alias("name"),
        F.when(k % 7 == 0, "1").when(k % 7 == 1, None).otherwise("1.0").alias("schema_version"),
        (k % 4).alias("cpus"),
        (k % 130).alias("n_trials"),
        (k % 12 / 10.0).alias("threshold"),
        F.when(k % 6 == 1, F.array(copy("skills", "skills"))).when(k % 6 == 2, F.array(copy("a", "/a"), copy("a/", "/b")))
        .when(k % 6 == 3, F.array(copy("../x", "/x"))).otherwise(F.array(copy("skills/", "/skills"))).alias("copies"),
    )
    return validate.metadata_errors(rows)


def part_files(spark, sf):
    """A manifest per part: which files there are follows from the part's number."""
    k = F.col("p_partkey")
    engines = F.array(*[F.lit(e) for e in ("harbor", "ase", "both", "mcpchecker", "a2a", "aeh")])

    def file(path, content, when=F.lit(True), size=10):
        return F.when(when, F.struct(F.lit(path).alias("file_path"), F.lit(size).cast("bigint").alias("size"), F.lit(content).alias("content")))

    rows = F.array_compact(
        F.array(
            file("metadata.yaml", "name: part\neval_engine: x\n", k % 10 != 0),
            file("skills/one/SKILL.md", "---\nname: one\n---\nbody", k % 4 == 1),
            file("skills/SKILL.md", " \n", k % 4 == 2),
            file("skills/readme.md", "x", k % 4 == 3),
            file("instruction.md", "do", k % 3 != 0),
            file("tests/test_outputs.py", "assert 1", k % 5 != 0),
            file("edge_cases/a.txt", "x", k % 7 == 0),
            file("evals/evals.json", '{"evals":[{"prompt":"p"},{"assertions":["a"]}]}', k % 2 == 0),
            file("eval.yaml", "kind: Eval\napiVersion: mcpchecker/v1\nmetadata:\n  name: x\nskill: other\nmodels:\n  skill: m\njudges:\n  - name: j\n", k % 8 != 0),
            file("tasks/t.yaml", "kind: Job\nspec:\n  prompt: go\n", k % 9 != 0),
            file("cases/c1/input.yaml", "a: 1", k % 11 != 0),
            file("cases/c2/annotations.yaml", "a: 1", k % 2 == 0),
            file("supportive/big.bin", "", k % 13 == 0, 60 * 1024 * 1024),
        )
    )
    return rel.spread(rel.table(spark, sf, "part").select("p_partkey")).select(
        F.concat(F.lit("sub-"), k).alias(SUB), F.element_at(engines, (k % 6 + 1).cast("int")).alias("eval_engine"),
        F.lit("single").alias("mode"), F.inline(rows),
    )


@registry.add(
    "validation_errors",
    """WITH p AS (SELECT p_partkey AS k, p_partkey % 6 AS e FROM part),
        r AS (SELECT k, unnest(list_filter([
          CASE WHEN k % 10 = 0 THEN 'metadata.yaml is missing' END,
          CASE WHEN e < 3 AND k % 4 = 0 THEN 'skills/ directory is missing' END,
          CASE WHEN e < 3 AND k % 4 = 3 THEN 'skills/ must contain at least one SKILL.md' END,
          CASE WHEN e < 3 AND k % 4 = 2 THEN 'skills/SKILL.md is empty' END,
          CASE WHEN e IN (0, 2) AND k % 3 = 0 THEN 'instruction.md is missing' END,
          CASE WHEN e IN (0, 2) AND k % 5 = 0 THEN 'test_outputs.py is missing' END,
          CASE WHEN e IN (0, 2) AND k % 7 = 0 THEN 'edge_cases/ directory exists but contains no .md files' END,
          CASE WHEN e IN (0, 2) AND k % 7 = 0 THEN 'edge_cases/ contains a non-.md file: a.txt' END,
          CASE WHEN e IN (1, 2) AND k % 4 IN (0, 3) THEN 'No SKILL.md found under skills/' END,
          CASE WHEN e IN (1, 2) AND k % 4 = 2 THEN 'skills/SKILL.md is missing YAML frontmatter' END,
          CASE WHEN e IN (1, 2) AND k % 2 = 0 THEN 'evals/evals.json: must have ''assertions'' or ''expected_output''' END,
          CASE WHEN e IN (1, 2) AND k % 2 = 0 THEN 'evals/evals.json: missing required ''prompt'' field' END,
          CASE WHEN e = 3 AND k % 8 = 0 THEN 'eval.yaml is required' END,
          CASE WHEN e = 3 THEN 'mcp-config.yaml is required' END,
          CASE WHEN e = 3 AND k % 9 = 0 THEN 'tasks/ directory is required' END,
          CASE WHEN e = 3 AND k % 9 <> 0 THEN 'tasks/t.yaml: ''kind'' must be ''Task''' END,
          CASE WHEN e = 4 AND k % 3 = 0 AND k % 9 = 0 THEN 'instruction.md, task.toml, or tasks/ is required' END,
          CASE WHEN e = 5 AND k % 8 = 0 THEN 'eval.yaml is required' END,
          CASE WHEN e = 5 AND k % 8 <> 0 AND k % 10 <> 0 THEN 'skill must match metadata.name' END,
          CASE WHEN e = 5 AND k % 11 = 0 AND k % 2 = 1 THEN 'cases/ directory is required' END,
          CASE WHEN e = 5 AND k % 2 = 0 THEN 'cases/c2: missing required input.yaml' END,
          CASE WHEN e < 3 AND k % 13 = 0 THEN 'supportive/ exceeds 50 MB limit' END], lambda x: x IS NOT NULL)) AS error FROM p)
       SELECT 'sub-' || k AS submission_name, error FROM r""",
)
def validation_errors(spark, sf):
    return validate.validate_submissions(part_files(spark, sf))


@registry.add(
    "harness_detection",
    """SELECT 'sub-' || p_partkey AS submission_name, p_partkey % 6 = 5 OR p_partkey % 8 <> 0 AS is_harness,
         CASE WHEN p_partkey % 6 = 5 OR p_partkey % 8 <> 0 THEN nullif(concat_ws(', ', CASE WHEN p_partkey % 10 = 0 THEN 'metadata.yaml' END,
           CASE WHEN p_partkey % 8 = 0 THEN 'eval.yaml or eval-control/treatment.yaml' END,
           CASE WHEN p_partkey % 11 = 0 AND p_partkey % 2 = 1 THEN 'cases/' END), '') END AS missing FROM part""",
)
def harness_detection(spark, sf):
    files = part_files(spark, sf)
    subs = rel.table(spark, sf, "part").select(
        F.concat(F.lit("sub-"), "p_partkey").alias(SUB), F.when(F.col("p_partkey") % 6 == 5, "aeh").otherwise("x").alias("eval_engine")
    )
    return reviews.detect_harness(subs, files).select(SUB, "is_harness", "missing")


@registry.add(
    "main_skill_file",
    """WITH f AS (SELECT doc_id, 'sub-' || (doc_id // 5) AS s, CASE WHEN doc_id % 3 = 0 THEN 'skills/SKILL.md'
          WHEN doc_id % 3 = 1 THEN 'skills/n' || doc_id || '/SKILL.md' ELSE 'a' || doc_id || '/SKILL.md' END AS p, doc_id % 3 AS r FROM documents)
       SELECT s AS submission_name, p AS file_path FROM f QUALIFY row_number() OVER (PARTITION BY s ORDER BY r, p) = 1""",
)
def main_skill_file(spark, sf):
    k = F.col("doc_id")
    files = rel.table(spark, sf, "documents").select(
        F.concat(F.lit("sub-"), F.floor(k / 5)).alias(SUB),
        F.when(k % 3 == 0, "skills/SKILL.md").when(k % 3 == 1, F.concat(F.lit("skills/n"), k, F.lit("/SKILL.md")))
        .otherwise(F.concat(F.lit("a"), k, F.lit("/SKILL.md"))).alias("file_path"),
    )
    return reviews.main_skill_file(files)


@registry.add(
    "review_input",
    """WITH f AS (SELECT 'sub-' || (doc_id // 20) AS submission_name, 'd' || doc_id || '.md' AS file_path, length(text) AS n FROM documents),
        s AS (SELECT *, sum(n) OVER (PARTITION BY submission_name ORDER BY file_path) AS upto FROM f)
       SELECT submission_name, file_path, n AS n_chars, upto::BIGINT AS chars_upto FROM s""",
)
def review_input(spark, sf):
    files = rel.table(spark, sf, "documents").select(
        F.concat(F.lit("sub-"), F.floor(F.col("doc_id") / 20)).alias(SUB),
        F.concat(F.lit("d"), "doc_id", F.lit(".md")).alias("file_path"), F.col("text").alias("content"),
    )
    return reviews.review_input(files)


@registry.add(
    "shown_findings",
    """SELECT l_suppkey AS scan_id, (row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice))::INT AS shown_no,
         CASE WHEN l_returnflag = 'R' THEN 'high' ELSE 'low' END AS severity, 'rule-' || l_linenumber AS rule_id,
         'part ' || l_partkey || ' of order ' || l_orderkey AS message, 0::BIGINT AS more FROM lineitem""",
)
def shown_findings(spark, sf):
    rows = rel.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("scan_id"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("finding_no"),
        F.when(F.col("l_returnflag") == "R", "high").otherwise("low").alias("severity"),
        F.concat(F.lit("rule-"), "l_linenumber").alias("rule_id"), F.concat(F.lit("part "), "l_partkey", F.lit(" of order "), "l_orderkey").alias("message"),
    )
    return reviews.shown_findings(rows, ["scan_id"])


@registry.add(
    "first_cases",
    """WITH c AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey::VARCHAR) AS n FROM orders)
       SELECT o_custkey AS submission, o_orderkey::VARCHAR AS case_id, n::INT AS case_no FROM c""",
)
def first_cases(spark, sf):
    cases = rel.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("submission"), F.col("o_orderkey").cast("string").alias("case_id")
    )
    return reviews.first_cases(cases, ["submission"])


VERDICT_WORDS = """a AS (SELECT conv_id, turn, regexp_replace(text, '^\\s+', '') || ' ' || CASE (conv_id + turn) % 6 WHEN 0 THEN '{"pass": true, "issues": []}'
    WHEN 1 THEN 'Here it is: {"pass": false, "issues": ["bad"]} done' WHEN 2 THEN 'This looks GOOD' WHEN 3 THEN 'I reject this, it cannot pass'
    WHEN 4 THEN '{"pass": false}' ELSE 'no idea' END AS answer FROM conversations)"""


def answers(spark, sf):
    k = (F.col("conv_id") + F.col("turn")) % 6
    text = (
        F.when(k == 0, '{"pass": true, "issues": []}').when(k == 1, 'Here it is: {"pass": false, "issues": ["bad"]} done')
        .when(k == 2, "This looks GOOD").when(k == 3, "I reject this, it cannot pass").when(k == 4, '{"pass": false}').otherwise("no idea")
    )
    return rel.table(spark, sf, "conversations").select(
        F.col("conv_id").alias("submission"), F.concat(F.lit("r"), "turn").alias("reviewer"), reviews.parse_verdict(F.concat("text", F.lit(" "), text)).alias("v")
    ).select("submission", "reviewer", "v.*")


@registry.add(
    "reviewer_verdicts",
    f"""WITH {VERDICT_WORDS} SELECT conv_id AS submission, 'r' || turn AS reviewer, (conv_id + turn) % 6 IN (0, 2, 5) AS passed,
          CASE (conv_id + turn) % 6 WHEN 1 THEN 'bad' WHEN 3 THEN answer ELSE '' END AS issues FROM a""",
)
def reviewer_verdicts(spark, sf):
    return answers(spark, sf).withColumn("issues", F.array_join("issues", ";"))


@registry.add(
    "combined_reviewers",
    f"""WITH {VERDICT_WORDS} SELECT conv_id AS submission, count(*) FILTER (WHERE (conv_id + turn) % 6 IN (1, 3)) = 0 AS passed,
          coalesce(string_agg('[r' || turn || '] ' || CASE (conv_id + turn) % 6 WHEN 1 THEN 'bad' ELSE answer END, ';'
            ORDER BY '[r' || turn || '] ') FILTER (WHERE (conv_id + turn) % 6 IN (1, 3)), '') AS issues FROM a GROUP BY ALL""",
)
def combined_reviewers(spark, sf):
    return reviews.combine_reviewers(answers(spark, sf), ["submission"]).withColumn("issues", F.array_join("issues", ";"))


@registry.add(
    "normalized_reviews",
    """WITH r AS (SELECT o_orderkey AS k, (o_orderkey % 100) / 100.0 AS a, (o_orderkey * 7 % 100) / 100.0 AS b FROM orders),
        s AS (SELECT k, CASE WHEN k % 2 = 0 THEN a ELSE (a + b) / 2 END AS score FROM r)
       SELECT k AS run_id, (score)::DOUBLE AS overall_score, CASE WHEN k % 3 = 0 THEN 'fail' WHEN score >= 0.6 THEN 'pass' WHEN score >= 0.4 THEN 'warn' ELSE 'fail' END AS recommendation,
         k % 5 = 0 OR NOT (k % 3 = 0 OR score < 0.4) AS passed FROM s""",
)
def normalized_reviews(spark, sf):
    k = F.col("o_orderkey")
    a, b = F.format_string("%.2f", (k % 100) / 100.0), F.format_string("%.2f", (k * 7 % 100) / 100.0)
    doc = F.concat(
        F.lit("{"), F.when(k % 2 == 0, F.concat(F.lit('"overall_score":'), a, F.lit(","))).otherwise(""),
        F.when(k % 3 == 0, '"recommendation":"fail",').otherwise(""), F.lit('"dimensions":{"x":{"score":'), a, F.lit('},"y":{"score":'), b, F.lit("}}}"),
    )
    rows = rel.table(spark, sf, "orders").select(
        k.alias("run_id"), F.when(k % 5 == 0, "aeh").otherwise("harbor").alias("eval_engine"), F.parse_json(doc).alias("doc")
    )
    return rounded(reviews.normalize_review(rows, ["run_id"]))


@registry.add(
    "response_scores",
    """SELECT conv_id, turn, CASE WHEN starts_with(t, 'ERROR:') THEN 0.0 WHEN length(t) <= 10 THEN 0.1 ELSE 0.5 END::DOUBLE AS score
       FROM (SELECT conv_id, turn, regexp_replace(unnest([text, ' ERROR: ' || text, ' ' || role]), '^\\s+|\\s+$', '', 'g') AS t FROM conversations)""",
)
def response_scores(spark, sf):
    forms = F.array(F.col("text"), F.concat(F.lit(" ERROR: "), "text"), F.concat(F.lit(" "), "role"))
    rows = rel.table(spark, sf, "conversations").select("conv_id", "turn", F.explode(forms).alias("text"))
    return rows.select("conv_id", "turn", reviews.fallback_score(F.col("text")).alias("score"))


@registry.add(
    "unfenced_output",
    """SELECT doc_id, length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS n FROM documents""",
)
def unfenced_output(spark, sf):
    wrapped = F.concat(F.lit(" ```json\n"), tx.strip(F.col("text")), F.lit("\n``` \n"))
    return rel.table(spark, sf, "documents").select("doc_id", F.length(tx.strip_fences(wrapped)).cast("bigint").alias("n"))


@registry.add(
    "generated_files",
    """SELECT doc_id % 5 AS kind, count(*) AS n, count(*) FILTER (WHERE CASE doc_id % 5 WHEN 0 THEN true WHEN 1 THEN doc_id % 2 = 0
         WHEN 2 THEN true WHEN 3 THEN doc_id % 3 = 0 ELSE false END) AS n_generated FROM documents GROUP BY ALL""",
)
def generated_files(spark, sf):
    k = F.col("doc_id")
    kind = k % 5
    path = F.when(kind == 0, "x/scenario_brief.json").when(kind == 1, "a.py").when(kind == 2, "a.md").when(kind == 3, "a.json").otherwise("a.txt")
    content = (
        F.when(kind == 1, F.concat(F.when(k % 2 == 0, "# Generated by AI").otherwise("x # Generated by AI"), "text"))
        .when(kind == 2, F.concat("text", F.lit("<!-- Generated by AI -->")))
        .when(kind == 3, F.concat(F.lit('{"_generated_by":"'), F.when(k % 3 == 0, "ai").otherwise("me"), F.lit('"}')))
        .otherwise(F.concat(F.lit("# Generated by AI"), "text"))
    )
    return rel.table(spark, sf, "documents").groupBy(kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(reviews.is_generated(path, content)).alias("n_generated")
    )


@registry.add(
    "edge_case_prompts",
    """SELECT 'sub-' || (doc_id // 5) AS submission_name, 'edge-no_input_' || doc_id AS id, 'Edge case: no input ' || doc_id AS name,
         length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS n_chars FROM documents WHERE regexp_matches(text, '\\S')""",
)
def edge_case_prompts(spark, sf):
    k = F.col("doc_id")
    forms = F.explode(F.create_map(F.lit("no_input_"), F.col("text"), F.lit("blank_"), F.lit(" \n"))).alias("stem", "content")
    files = rel.table(spark, sf, "documents").select("doc_id", forms).select(
        F.concat(F.lit("sub-"), F.floor(k / 5)).alias(SUB), F.concat(F.lit("edge_cases/"), "stem", k, F.lit(".md")).alias("file_path"), "content"
    )
    prompts = reviews.edge_case_prompts(files)
    return prompts.select(SUB, "id", "name", F.length("prompt").cast("bigint").alias("n_chars"))


@registry.add(
    "quality_criteria",
    # a heading's pattern may start at an earlier heading, so the first section repeats what stands before it
    """SELECT doc_id, unnest([length(text), length('## Common Issues.none.## Else.skip.## My Workflow.steps') + 2
         + length('## Common Issues.none') + length(text)])::BIGINT AS n FROM documents""",
)
def quality_criteria(spark, sf):
    headed = "---\nname: x\n---\n## Common Issues\nnone\n## Else\nskip\n## My Workflow\nsteps"
    forms = F.array(F.col("text"), F.concat(F.lit(headed), "text", F.lit("\n## Last\nskip\n")))
    rows = rel.table(spark, sf, "documents").select("doc_id", F.explode(forms).alias("body"))
    return rows.select("doc_id", F.length(reviews.quality_criteria(F.col("body"))).cast("bigint").alias("n"))


@registry.add(
    "scenario_gaps",
    """SELECT 'sub-' || doc_id AS submission_name, CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'p/f.py' END AS files_missing,
         CASE WHEN doc_id % 3 = 0 THEN 'k=v' || doc_id || '!' ELSE '' END AS outputs_missing_in_tests,
         'k=v' || doc_id || '!' AS outputs_missing_in_instruction FROM documents""",
)
def scenario_gaps(spark, sf):
    k = F.col("doc_id")
    name = F.concat(F.lit("sub-"), k).alias(SUB)
    value = F.concat(F.lit("v"), k, F.lit("!"))
    docs = rel.table(spark, sf, "documents")
    briefs = docs.select(
        name, F.array(F.lit("p/f.py")).alias("project_files"),
        F.create_map(F.lit("k"), value, F.lit("none"), F.lit("None")).alias("expected_outputs"),
    )
    texts = docs.select(
        name, F.concat("text", F.when(k % 2 == 0, " see f.py").otherwise("")).alias("instruction"),
        F.concat("text", F.when(k % 3 != 0, value).otherwise("")).alias("tests"),
    )
    df = reviews.scenario_gaps(briefs, texts)
    return df.select(SUB, *[F.array_join(c, ",").alias(c) for c in df.columns if c != SUB])


@registry.add(
    "alert_headers",
    f"""WITH {RUNS}, alerts AS (SELECT * FROM (WITH {degradation_sql('submission_name, eval_engine', '0.85::DOUBLE')}))
        SELECT submission_name, current_run_id, CASE WHEN degraded THEN chr(128680) || ' [' || upper(eval_engine) || '] Performance Degradation Detected'
          ELSE chr(9989) || ' [' || upper(eval_engine) || '] Monitoring Pass' END AS header,
        to_json({{'blocks': [
          to_json({{'type': 'header', 'text': {{'type': 'plain_text', 'text': header, 'emoji': true}}}}),
          to_json({{'type': 'section', 'fields': list_transform(['*Skill:*' || chr(10) || submission_name, '*Run ID:*' || chr(10) || current_run_id,
            '*Score:*' || chr(10) || coalesce(printf('%.1f%%', current_score * 100), 'N/A')] || CASE WHEN previous_score IS NULL THEN [] ELSE
            ['*Baseline:*' || chr(10) || printf('%.1f%%', previous_score * 100), '*Ratio:*' || chr(10) || coalesce(printf('%.2f', ratio), 'N/A'),
             '*Threshold:*' || chr(10) || threshold] END, lambda x: {{'type': 'mrkdwn', 'text': x}})}}),
          to_json({{'type': 'context', 'elements': [{{'type': 'mrkdwn', 'text': message}}]}})]}})::VARCHAR AS payload FROM alerts""",
)
def alert_headers(spark, sf):
    df = history.degradation(rel.runs(spark, sf), by=("submission_name", "eval_engine"))
    return facts.alert_payload(df)


@registry.add(
    "gate_fact_refs",
    f"""WITH {ITEMS}, {CARDS}, {GATES}, {JUDGED} SELECT scorecard_id, 'facts:demo_' || gate_name || CASE WHEN gate_order % 2 = 0 THEN '_impl' ELSE '' END AS fact_ref,
        to_json({{'facts': [{{'factRef': fact_ref, 'entityRef': 'component:demo', 'data': {{'gate_name': gate_name, 'passed': passed, 'score': score::DOUBLE,
          'mode': mode, 'message': ''}}}}]}})::VARCHAR AS payload FROM judged WHERE push_fact""",
)
def gate_fact_refs(spark, sf):
    named = gate_queries.judged_gates(spark, sf).withColumn(
        "policy_key", F.when(F.col("gate_order") % 2 == 0, "impl").otherwise(F.col("gate_name"))
    )
    return facts.gate_facts(named, ["scorecard_id"], "facts:demo_", "component:demo")


@registry.add(
    "certification_fact_refs",
    f"""WITH {GATES}, {gate_queries.FACTS}, {gate_queries.CHECKS} SELECT k AS scorecard_id, level, 'facts:demo_' || level AS fact_ref,
          CASE WHEN NOT passed AND checks_total > 0 AND checks_passed = checks_total THEN 'prerequisite_level_failed' END AS failure_reason FROM hier
        UNION ALL SELECT k, 'summary', 'facts:demo_certification', NULL FROM facts""",
)
def certification_fact_refs(spark, sf):
    df = facts.certification_facts(gate_queries.certified_runs(spark, sf), ["scorecard_id"], "facts:demo_", "component:demo")
    return df.drop("payload")


@registry.add(
    "push_outcomes",
    """SELECT o_custkey AS submission, count(*) FILTER (WHERE o_orderstatus <> 'P') AS pushed, count(*) FILTER (WHERE o_orderstatus = 'P') AS failed
       FROM orders GROUP BY ALL""",
)
def push_outcomes(spark, sf):
    rows = rel.table(spark, sf, "orders").select(F.col("o_custkey").alias("submission"), (F.col("o_orderstatus") != "P").alias("success"))
    return facts.push_outcomes(rows, ["submission"])


@registry.add(
    "model_labels",
    """SELECT user_id, CASE event_type WHEN 'view' THEN 'Claude Sonnet 4.6 (vertex_ai)' WHEN 'click' THEN NULL ELSE event_type END AS label,
         CASE WHEN event_type <> 'error' THEN 'https://git.example/o/r/pull/' || user_id END AS url, count(*) AS n FROM events GROUP BY ALL""",
)
def model_labels(spark, sf):
    kind = F.col("event_type")
    model = F.when(kind == "view", "claude-sonnet-x").when(kind == "click", "").otherwise(kind)
    repo = F.when(kind == "error", "").otherwise("o/r")
    url = facts.change_url("https://git.example/", repo, F.col("user_id").cast("string"))
    return rel.table(spark, sf, "events").groupBy("user_id", facts.model_label(model).alias("label"), url.alias("url")).agg(
        F.count(F.lit(1)).alias("n")
    )


@registry.add(
    "artifact_prefixes",
    "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') || '_sub-' || user_id || '_r' || event_id AS prefix FROM events",
)
def artifact_prefixes(spark, sf):
    name = reviews.artifact_prefix(F.col("ts"), F.concat(F.lit("sub-"), "user_id"), F.concat(F.lit("r"), "event_id"))
    return rel.table(spark, sf, "events").select("event_id", name.alias("prefix"))
