"""Queries on submission texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialmill.functions import text as tx
from trialmill.operators import rules as R
from trialmill.operators import textscan
from trialmill.plans import relations as rel
from trialmill.plans.registry import Registry

registry = Registry()


def quoted(text: str) -> str:
    """SQL string expression; characters outside printable ASCII by code point."""
    out, plain = [], ""
    for ch in text:
        if " " <= ch <= "~":
            plain += "''" if ch == "'" else ch
        else:
            out += [f"'{plain}'", f"chr({ord(ch)})"]
            plain = ""
    return " || ".join([x for x in [*out, f"'{plain}'"] if x != "''"] or ["''"])


CASES = " ".join(f"WHEN {i} THEN {quoted(x)}" for i, x in enumerate(rel.INJECTED))
FILES = f"""files AS (
  SELECT doc_id, 'sub-' || (doc_id // 5) AS submission_name,
    CASE WHEN doc_id % 11 = 0 THEN 'vendor/d' || doc_id || '.md' WHEN doc_id % 3 = 0 THEN 'skills/s' || doc_id || '/SKILL.md'
         WHEN doc_id % 3 = 1 THEN 'skills/n' || doc_id || '.md' ELSE 'docs/d' || doc_id || '.md' END AS file_path,
    CASE doc_id % 7 WHEN 0 THEN '---' || chr(10) || 'name: s' || doc_id || chr(10) || 'description: Handles files of all kinds' || chr(10) || '---' || chr(10)
      WHEN 1 THEN '---' || chr(10) || 'name: s' || doc_id || chr(10) || 'description: short' || chr(10) || '---' || chr(10)
      WHEN 2 THEN '---' || chr(10) || 'description: Handles files of all kinds' || chr(10) || '---' || chr(10)
      WHEN 3 THEN '---' || chr(10) || 'name: The same text here' || chr(10) || 'description: the same text here' || chr(10) || '---' || chr(10)
      WHEN 4 THEN '---' || chr(10) || 'name: nothing else' || chr(10) || '---' || chr(10) ELSE '' END
    || text || chr(10) || CASE doc_id % {len(rel.INJECTED)} {CASES} END AS content FROM documents)"""
BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"
LINES = f"""raw_lines AS (SELECT submission_name, file_path, unnest(regexp_split_to_array(content, '{BREAK}')) AS line,
    generate_subscripts(regexp_split_to_array(content, '{BREAK}'), 1)::INT AS line_no FROM files WHERE file_path NOT LIKE 'vendor/%'),
  marked AS (SELECT *, regexp_matches(line, '^\\s*```') AS fence FROM raw_lines),
  lines AS (SELECT * FROM (SELECT *, sum(fence::INT) OVER (PARTITION BY submission_name, file_path ORDER BY line_no) % 2 = 1 AS in_fence
    FROM marked) WHERE NOT fence)"""
# DuckDB has no look-ahead: what follows the prefix is extracted and tested
WITHOUT_LOOKAHEAD = {
    "markdown image exfiltration": r"""len(list_filter(regexp_extract_all(line, '!\[.*?\]\(https?://([^\)]*)', 1, 'i'),
      lambda u: NOT regexp_matches(u, '^(?:docs\.|github\.|imgur\.|i\.stack|shields\.io|raw\.githubusercontent\.)', 'i'))) > 0""",
    "translate evasion": r"""len(list_filter(regexp_extract_all(line, 'translate\s+(?:this|the\s+following)\s+(?:to|into)\s+(\w*)', 1, 'i'),
      lambda u: lower(u) NOT IN ('english', 'spanish', 'french', 'german', 'chinese', 'japanese', 'korean'))) > 0""",
}


def rule_sql(rules, first: bool) -> str:
    cases = []
    for r in rules:
        plain = f"regexp_matches(line, {quoted(r.pattern)}, '{'i' if r.ignore_case else 'c'}')"
        test = WITHOUT_LOOKAHEAD.get(r.label, plain)
        cases.append(f"CASE WHEN {test} THEN {{'c': {quoted(r.category)}, 'l': {quoted(r.label)}}} END")
    return f"coalesce({', '.join(cases)})" if first else f"unnest(list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL))"


EXAMPLE = "regexp_matches(line, '^\\s*[>\"]') OR regexp_matches(line, '(?:for\\s+example|e\\.g\\.|such\\s+as|like:)', 'i')"
FINDING = ["submission_name", "file_path", "line", "severity", "rule_id", "category"]


@registry.add(
    "security_findings",
    f"""WITH {FILES}, {LINES}, hits AS (SELECT *, {rule_sql(R.SECURITY_RULES, False)} AS h FROM lines)
        SELECT submission_name, file_path, line_no AS line, CASE WHEN in_fence OR {EXAMPLE} THEN 'low' ELSE 'high' END AS severity,
          h.c || '-' || trim(regexp_replace(lower(h.l), '[^a-z0-9]+', '-', 'g'), '-') AS rule_id, h.c AS category FROM hits""",
)
def security_findings(spark, sf):
    return textscan.security_findings(rel.skill_files(spark, sf)).select(*FINDING)


def wording_sql(rules, severity: str, name: str) -> str:
    return f"""WITH {FILES}, {LINES}, hits AS (SELECT *, {rule_sql(rules, True)} AS h FROM lines
          WHERE NOT in_fence AND NOT regexp_matches(line, '^\\s*>'))
        SELECT submission_name, file_path, line_no AS line, '{severity}' AS severity,
          'quality-{name.replace("_", "-")}' AS rule_id, '{name}' AS category, h.l AS label FROM hits WHERE h IS NOT NULL"""


def with_label(df):
    return df.withColumn("label", F.regexp_extract("message", "'(.*)'", 1)).drop("message")


@registry.add("imprecise_instructions", wording_sql(R.IMPRECISE_RULES, "low", "imprecise_instruction"))
def imprecise_instructions(spark, sf):
    return with_label(textscan.imprecise_instructions(rel.skill_files(spark, sf)))


@registry.add("unfinished_content", wording_sql(R.UNFINISHED_RULES, "medium", "unfinished_content"))
def unfinished_content(spark, sf):
    return with_label(textscan.unfinished_content(rel.skill_files(spark, sf)))


@registry.add("generic_advice", wording_sql(R.GENERIC_RULES, "low", "generic_advice"))
def generic_advice(spark, sf):
    return with_label(textscan.generic_advice(rel.skill_files(spark, sf)))


@registry.add(
    "logging_suppression",
    f"""WITH {FILES}, {LINES}, hits AS (SELECT *, {rule_sql(R.LOGGING_RULES, False)} AS h FROM lines
          WHERE NOT in_fence AND NOT regexp_matches(line, '^\\s*>') AND NOT regexp_matches(line, {quoted(R.SECURITY_WORDS)}, 'i')
          AND regexp_matches(file_path, '^skills/[^/]*\\.md$'))
        SELECT submission_name, file_path, line_no AS line, h.l AS label FROM hits""",
)
def logging_suppression(spark, sf):
    found = textscan.logging_suppression(rel.skill_files(spark, sf))
    return with_label(found).select("submission_name", "file_path", "line", "label")


@registry.add(
    "fenced_lines",
    f"""WITH {FILES}, {LINES}, n AS (SELECT *, max(line_no) OVER (PARTITION BY submission_name, file_path) AS last FROM lines)
        SELECT submission_name, file_path, count(*) AS n_lines, count(*) FILTER (WHERE in_fence) AS n_fenced,
        sum(line_no)::BIGINT AS numbers, sum(length(line))::BIGINT AS n_chars FROM n WHERE NOT (line = '' AND line_no = last) GROUP BY ALL""",
)
def fenced_lines(spark, sf):
    lines = textscan.file_lines(textscan.scanned_files(rel.skill_files(spark, sf)))
    return lines.groupBy("submission_name", "file_path").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if("in_fence").alias("n_fenced"),
        F.sum("line_no").alias("numbers"),
        F.sum(F.length("line")).cast("bigint").alias("n_chars"),
    )


@registry.add(
    "description_quality",
    f"""WITH {FILES}, s AS (SELECT *, doc_id % 7 AS k FROM files WHERE file_path LIKE 'skills/%/SKILL.md')
        SELECT submission_name, file_path, CASE k WHEN 3 THEN 'low' ELSE 'medium' END AS severity,
          CASE k WHEN 1 THEN 'quality-short-description' WHEN 2 THEN 'quality-missing-name'
            WHEN 3 THEN 'quality-description-equals-name' WHEN 4 THEN 'quality-missing-description'
            ELSE 'quality-no-frontmatter' END AS rule_id FROM s WHERE k <> 0""",
)
def description_quality(spark, sf):
    found = textscan.description_quality(rel.skill_files(spark, sf))
    return found.select("submission_name", "file_path", "severity", "rule_id")


@registry.add(
    "broken_references",
    f"""WITH {FILES}, {LINES} SELECT submission_name, file_path, line_no AS line, 'medium' AS severity,
          'quality-broken-reference' AS rule_id, 'broken_reference' AS category FROM lines
        WHERE line LIKE '[one](missing.md)%'""",
)
def broken_references(spark, sf):
    return textscan.broken_references(rel.skill_files(spark, sf)).select(*FINDING)


@registry.add(
    "thin_instructions",
    """SELECT 'sub-' || conv_id || '-' || turn AS submission_name, CASE WHEN length(b) < 10 THEN 'high' ELSE 'low' END AS severity
       FROM (SELECT conv_id, turn, regexp_replace(unnest([text, role, role || ' speaks in turn ' || turn]), '^\\s+|\\s+$', '', 'g') AS b FROM conversations)
       WHERE length(b) < 50""",
)
def thin_instructions(spark, sf):
    forms = F.array(F.col("text"), F.col("role"), F.concat("role", F.lit(" speaks in turn "), "turn"))
    files = rel.table(spark, sf, "conversations").select("conv_id", "turn", F.explode(forms).alias("body")).select(
        F.concat_ws("-", F.lit("sub"), "conv_id", "turn").alias("submission_name"),
        F.lit("instruction.md").alias("file_path"),
        F.concat(F.lit("---\nname: x\n---\n# Title\n"), "body").alias("content"),
    )
    return textscan.file_completeness(files).select("submission_name", "severity")


def severities(name: str) -> str:
    return f"SELECT submission_name, severity FROM ({registry.sql[name]})"


QUALITY = ("imprecise_instructions", "unfinished_content", "generic_advice", "description_quality", "broken_references")


@registry.add(
    "quality_severity_counts",
    f"SELECT submission_name, severity, count(*) AS n FROM ({' UNION ALL '.join(map(severities, QUALITY))}) GROUP BY ALL",
)
def quality_severity_counts(spark, sf):
    return textscan.severity_counts(textscan.quality_findings(rel.skill_files(spark, sf)))


@registry.add(
    "rule_slugs",
    """SELECT DISTINCT 'source-' || trim(regexp_replace(lower(source || ' (' || lang || ') '), '[^a-z0-9]+', '-', 'g'), '-') AS rule_id
       FROM documents""",
)
def rule_slugs(spark, sf):
    label = F.concat("source", F.lit(" ("), "lang", F.lit(") "))
    return rel.table(spark, sf, "documents").select(F.concat(F.lit("source-"), tx.slug(label)).alias("rule_id")).distinct()


