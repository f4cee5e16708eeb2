"""Queries on metadata and summary documents, whose texts the SQL side reads line by line."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialmill.plans import relations as rel
from trialmill.plans.registry import Registry
from trialmill.sources import metadata

registry = Registry()
SUB = "submission_name"

# every part has a metadata file: its policy in blocks, some gates in flow style, comments, an empty line, a folded text
_TEXT = """concat('name: part-', p_partkey, chr(10), 'description: >-', chr(10), '  ', p_name, chr(10),
  CASE WHEN p_partkey % 4 = 0 THEN '' ELSE concat('gate_policy:', chr(10), '  default_mode: ', CASE WHEN p_partkey % 3 = 0 THEN 'block' ELSE '"warn"  # usual' END, chr(10),
    CASE WHEN p_partkey % 5 = 0 THEN concat('  combination: weighted', chr(10), chr(10)) ELSE '' END, '  gates:', chr(10),
    '    evaluation:', chr(10), '      mode: block', chr(10), '      # by size', chr(10), '      threshold: 0.', p_size, chr(10),
    CASE WHEN p_partkey % 2 = 0 THEN concat('    security: {mode: disabled, weight: ', p_size, ', push_fact: true}', chr(10)) ELSE '' END,
    '    quality:', chr(10), '      weight: 1.5', chr(10), CASE WHEN p_partkey % 7 = 0 THEN concat('      push_fact: yes', chr(10)) ELSE '' END) END,
  'owner: x', chr(10))"""

# a line's gate is the last key before it with an indentation of four
_LINES = f"""texts AS (SELECT 'sub-' || p_partkey AS submission_name, {_TEXT} AS t FROM part),
  split AS (SELECT submission_name, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM texts),
  keyed AS (SELECT submission_name, pos, length(l) - length(ltrim(l)) AS ind, split_part(trim(l), ':', 1) AS key,
      trim(regexp_replace(substr(trim(l), strpos(trim(l), ':') + 1), '  #.*', ''), ' "') AS val FROM split WHERE trim(l) <> '' AND trim(l)[1] <> '#'),
  placed AS (SELECT *, last_value(CASE WHEN ind = 0 THEN key END IGNORE NULLS) OVER w AS top,
      last_value(CASE WHEN ind = 2 THEN key END IGNORE NULLS) OVER w AS mid, last_value(CASE WHEN ind = 4 THEN key END IGNORE NULLS) OVER w AS gate
    FROM keyed WINDOW w AS (PARTITION BY submission_name ORDER BY pos))"""


def metadata_files(spark, sf):
    return rel.spread(rel.table(spark, sf, "part").select("p_partkey", "p_name", "p_size")).select(F.concat(F.lit("sub-"), "p_partkey").alias(SUB), F.expr(_TEXT.replace("chr(10)", "'\\n'")).alias("content"))


@registry.add(
    "metadata_policy_items",
    f"""WITH {_LINES}, inside AS (SELECT * FROM placed WHERE top = 'gate_policy' AND mid = 'gates' AND ind >= 4)
        SELECT submission_name, gate AS gate_name,
          coalesce(max(CASE WHEN ind = 6 AND key = 'mode' THEN val END), max(nullif(regexp_extract(val, '\\{{.*mode: ([a-z]+)', 1), '')), 'warn') AS mode,
          max(CASE WHEN ind = 6 AND key = 'threshold' THEN val::DOUBLE END) AS threshold,
          coalesce(max(CASE WHEN ind = 6 AND key = 'weight' THEN val::DOUBLE END), max(nullif(regexp_extract(val, '\\{{.*weight: ([0-9.]+)', 1), '')::DOUBLE), 1.0::DOUBLE) AS weight,
          coalesce(bool_or(CASE WHEN ind = 6 AND key = 'push_fact' THEN val IN ('true', 'yes') WHEN val LIKE '{{%' THEN val LIKE '%push_fact: true%' END), false) AS push_fact
        FROM inside GROUP BY ALL""",
)
def metadata_policy_items(spark, sf):
    return metadata.gate_policy_documents(metadata_files(spark, sf))[0]


@registry.add(
    "metadata_policy_defaults",
    f"""WITH {_LINES} SELECT submission_name, coalesce(max(CASE WHEN top = 'gate_policy' AND ind = 2 AND key = 'combination' THEN val END), 'all_pass') AS combination,
          coalesce(max(CASE WHEN top = 'gate_policy' AND ind = 2 AND key = 'default_mode' THEN val END), 'warn') AS default_mode,
          max(CASE WHEN top = 'gate_policy' AND mid = 'gates' AND gate = 'evaluation' AND ind = 6 AND key = 'threshold' THEN val::DOUBLE END) AS evaluation_threshold,
          CASE WHEN bool_or(key = 'gate_policy') THEN 'own' ELSE 'default' END AS policy_state
        FROM placed GROUP BY ALL""",
)
def metadata_policy_defaults(spark, sf):
    return metadata.gate_policy_documents(metadata_files(spark, sf))[1]


_SUMMARY = "concat('run_id: r', c_custkey, chr(10), 'mean_reward: ', c_custkey % 100, '.5', chr(10), CASE WHEN c_custkey % 6 = 0 THEN concat('pairwise:', chr(10), '  wins: 1', chr(10)) ELSE '' END)"
_RESULT = """concat('{"num_turns": ', c_nationkey, ', "n_infra_errors": ', c_custkey % 4, CASE WHEN c_custkey % 5 = 0 THEN concat(', "mean_reward": 0.', c_nationkey) ELSE '' END, '}')"""


@registry.add(
    "summary_run_files",
    f"""WITH t AS (SELECT 'run-' || c_custkey AS run_dir, CASE WHEN c_custkey % 7 <> 0 THEN {_SUMMARY} END AS s, CASE WHEN c_custkey % 3 <> 0 THEN {_RESULT} END AS r FROM customer)
        SELECT run_dir, coalesce(json_extract_string(r, '$.mean_reward')::DOUBLE, nullif(regexp_extract(s, 'mean_reward: ([0-9.]+)', 1), '')::DOUBLE, 0.0::DOUBLE) AS mean_reward,
          CASE WHEN s LIKE '%pairwise:%' THEN 'pairwise' ELSE 'single' END AS mode, json_extract_string(r, '$.num_turns')::BIGINT AS num_turns,
          json_extract_string(r, '$.n_infra_errors')::BIGINT AS n_infra_errors, json_extract_string(r, '$.n_trial_errors')::BIGINT AS n_trial_errors
        FROM t WHERE s IS NOT NULL OR r IS NOT NULL""",
)
def summary_run_files(spark, sf):
    customers = rel.spread(rel.table(spark, sf, "customer").select("c_custkey", "c_nationkey"))
    run, number = F.concat(F.lit("run-"), "c_custkey").alias("run_dir"), F.col("c_custkey")

    def written(name: str, text: str, when):
        return customers.where(when).select(run, F.lit(name).alias("name"), F.expr(text.replace("chr(10)", "'\\n'")).alias("content"))

    files = written("summary.yaml", _SUMMARY, number % 7 != 0).unionByName(written("run_result.json", _RESULT, number % 3 != 0))
    return metadata.run_summaries(files).select("run_dir", "mean_reward", "mode", "num_turns", "n_infra_errors", "n_trial_errors")
