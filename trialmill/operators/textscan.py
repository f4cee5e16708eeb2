"""Line-level rules over submission files, without a shuffle.

A file is split at its fence lines in its own row; the pieces between them are alternately outside and
inside a fence. Pieces and then lines are exploded, so every line knows its number and fence state
without a window over the file. Files without any rule hit are dropped before they are exploded.

``files``: submission_name, file_path (relative), content.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmill.functions import text as tx
from trialmill.functions.stats import let
from trialmill.operators import rules as R

FILE = ["submission_name", "file_path"]


def scanned_files(files: DataFrame) -> DataFrame:
    """Markdown files outside excluded directories."""
    parts = F.split("file_path", "/")
    excluded = F.array(*[F.lit(d) for d in R.EXCLUDED_DIRS])
    return files.where(F.col("file_path").endswith(".md") & ~F.arrays_overlap(parts, excluded))


def regex(rule: R.Rule) -> str:
    return ("(?iU)" if rule.ignore_case else "(?U)") + rule.pattern


def words_in(text: Column, rules: list[R.Rule]) -> Column:
    """Those of the rules' words that occur in a text; the folded text is made once per row."""
    words = sorted({h for r in rules for h in r.hints})
    if not words:
        return F.array().cast("array<string>")
    listed = F.array(*[F.lit(w) for w in words])
    none = F.array().cast("array<string>")

    def found(v: Column) -> Column:
        # most files have no word at all, which the first search settles
        some = tx.contains_any(v["low"], words)
        return F.when(some, F.filter(listed, lambda w: v["low"].contains(w))).otherwise(none)

    return let({"low": tx.folded(text)}, found)


def matches_without_words(text: Column, rules: list[R.Rule]) -> Column:
    """Whether a rule that has no words matches."""
    tests = [text.rlike(regex(r)) for r in rules if not r.hints]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def file_lines(files: DataFrame, rules: list[R.Rule] | None = None) -> DataFrame:
    """Lines with number and fence state; fence lines themselves are left out.

    With ``rules``, files and lines that cannot match any of them are dropped: the rules' words are looked
    for in the whole file, and in its lines only the words that the file has. A file to drop is given no
    pieces instead of being filtered, because a filter would repeat the search.
    """
    df = files
    keep = F.lit(True)
    if rules is not None:
        df = files.select(
            *FILE, "content",
            words_in(F.col("content"), rules).alias("_words"),
            matches_without_words(F.col("content"), rules).alias("_bare"),
        )
        keep = (F.size("_words") > 0) | F.col("_bare")
    carried = [] if rules is None else ["_words", "_bare"]
    counts = F.transform("_pieces", lambda p: F.size(tx.lines(p)))
    offsets = F.aggregate(
        counts, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n + 1))
    )
    none = F.array().cast("array<string>")
    df = df.withColumn("_pieces", F.when(keep, tx.pieces(F.col("content"))).otherwise(none))
    df = df.select(
        *FILE, *carried,
        F.posexplode(F.arrays_zip(F.col("_pieces").alias("text"), offsets.alias("offset"))).alias("_piece", "_p"),
    ).where(F.col("_p.text").isNotNull())
    df = df.select(
        *FILE, *carried,
        (F.col("_piece") % 2 == 1).alias("in_fence"),
        F.col("_p.offset").alias("_offset"),
        F.posexplode(tx.lines(F.col("_p.text"))).alias("_n", "line"),
    )
    if rules is not None:
        has_word = let({"low": tx.folded(F.col("line"))}, lambda v: F.exists("_words", lambda w: v["low"].contains(w)))
        df = df.where(has_word | (F.col("_bare") & matches_without_words(F.col("line"), rules)))
    return df.select(*FILE, (F.col("_offset") + F.col("_n") + 1).alias("line_no"), "in_fence", "line")


def _stripped_starts(prefix: str) -> Column:
    return F.col("line").rlike(rf"\A[{tx.SPACE}]*{prefix}")


def is_quote() -> Column:
    return _stripped_starts(">")


def in_example() -> Column:
    """Quoted lines and lines that announce an example."""
    return _stripped_starts('[>"]') | F.col("line").rlike("(?iU)" + R.EXAMPLE_WORDS)


def _every_hit(lines: DataFrame, rules: list[R.Rule]) -> DataFrame:
    hits = [
        F.when(
            F.col("line").rlike(regex(r)),
            F.struct(F.lit(i).alias("rule_no"), F.lit(r.category).alias("category"), F.lit(r.label).alias("label")),
        )
        for i, r in enumerate(rules)
    ]
    return lines.withColumn("_hit", F.explode(F.array_compact(F.array(*hits)))).select(
        *lines.columns, "_hit.*"
    )


def _first_hit(lines: DataFrame, rules: list[R.Rule]) -> DataFrame:
    hits = [
        F.when(F.col("line").rlike(regex(r)), F.struct(F.lit(r.category).alias("category"), F.lit(r.label).alias("label")))
        for r in rules
    ]
    found = lines.withColumn("_hit", F.coalesce(*hits)).where(F.col("_hit").isNotNull())
    return found.select(*lines.columns, "_hit.*")


def finding(df: DataFrame, severity: Column, rule_id: Column, message: Column, category: Column, line: Column) -> DataFrame:
    return df.select(
        *FILE, line.cast("int").alias("line"), severity.alias("severity"), rule_id.alias("rule_id"),
        category.alias("category"), message.alias("message"),
    )


def security_findings(files: DataFrame, rules: list[R.Rule] | None = None) -> DataFrame:
    """Every matching rule of every line; high, but low inside fences, quotes and examples."""
    rules = R.SECURITY_RULES if rules is None else rules
    hits = _every_hit(file_lines(scanned_files(files), rules), rules)
    severity = F.when(F.col("in_fence") | in_example(), "low").otherwise("high")
    rule_id = F.concat_ws("-", "category", tx.slug(F.col("label")))
    message = F.concat(
        F.lit("Line "), "line_no", F.lit(": "), F.replace("category", F.lit("_"), F.lit(" ")),
        F.lit(" pattern '"), "label", F.lit("'"),
    )
    return finding(hits, severity, rule_id, message, F.col("category"), F.col("line_no"))


def _wording(files: DataFrame, rules: list[R.Rule], severity: str, name: str, tail: Column) -> DataFrame:
    prose = file_lines(scanned_files(files), rules).where(~F.col("in_fence") & ~is_quote())
    hits = _first_hit(prose, rules)
    message = F.concat(F.lit("Line "), "line_no", F.lit(": '"), "label", F.lit("'"), tail)
    return finding(
        hits, F.lit(severity), F.lit("quality-" + name.replace("_", "-")), message, F.lit(name), F.col("line_no")
    )


def imprecise_instructions(files: DataFrame) -> DataFrame:
    tail = F.concat(F.lit(" ("), F.col("category"), F.lit(")"))
    return _wording(files, R.IMPRECISE_RULES, "low", "imprecise_instruction", tail)


def unfinished_content(files: DataFrame) -> DataFrame:
    return _wording(files, R.UNFINISHED_RULES, "medium", "unfinished_content", F.lit(" marker found"))


def generic_advice(files: DataFrame) -> DataFrame:
    return _wording(files, R.GENERIC_RULES, "low", "generic_advice", F.lit(" is generic filler"))


def logging_suppression(files: DataFrame, rules: list[R.Rule] | None = None) -> DataFrame:
    """Every match outside fences and quotes on lines without a security word.

    Looks at ``SKILL.md`` of the submission and the files directly in ``skills/``.
    """
    rules = R.LOGGING_RULES if rules is None else rules
    chosen = files.where((F.col("file_path") == "SKILL.md") | F.col("file_path").rlike(r"\Askills/[^/]*\.md\z"))
    prose = file_lines(chosen, rules).where(~F.col("in_fence") & ~is_quote())
    hits = _every_hit(prose, rules).where(~F.col("line").rlike("(?iU)" + R.SECURITY_WORDS))
    return finding(
        hits, F.lit("low"), F.lit("logging-suppression"),
        F.concat(F.lit("Logging suppression pattern found: '"), "label", F.lit("'")), F.col("category"), F.col("line_no"),
    )


FRONT_MATTER = rf"\A---[{tx.SPACE}]*\n((?s:.*?))\n---"


def front_matter(content: Column) -> Column:
    """Text between the leading dashes, null without such a block."""
    return F.when(content.rlike(FRONT_MATTER), F.regexp_extract(content, FRONT_MATTER, 1))


def yaml_scalar(block: Column, key: str) -> Column:
    """Top-level ``key: value`` on one line, or a folded or literal block; quotes are removed; null if absent."""
    pattern = rf"(?m)^{key}[ \t]*:(?:[ \t]+(.*?))?[ \t]*$"
    folded = rf"(?m)^{key}[ \t]*:[ \t]+[|>][-+0-9]*[ \t]*\n((?:[ \t]+.*(?:\n|\z)|[ \t]*\n)*)"
    raw = F.regexp_extract(block, pattern, 1)
    body = F.trim(F.regexp_replace(F.regexp_extract(block, folded, 1), r"\s*\n\s*", " "))
    plain = F.regexp_replace(raw, r"[ \t]+#.*$|^#.*$", "")
    unquoted = F.regexp_replace(plain, r"""^"(.*)"$|^'(.*)'$""", "$1$2")
    value = F.when(raw.rlike(r"^[|>][-+0-9]*$"), body).otherwise(unquoted)
    return F.when(block.rlike(pattern), F.when(value.isin("null", "~"), "").otherwise(value))


def description_quality(files: DataFrame) -> DataFrame:
    """Front matter of skill files: none, invalid, no name, no, short or repeated description."""
    skills = scanned_files(files).where(F.substring_index("file_path", "/", -1) == "SKILL.md")
    block = front_matter(F.col("content"))
    # a top-level line that is neither a key, a list item, a comment nor a continuation is no mapping
    valid = ~F.col("_block").rlike(r"(?m)^(?![ \t#-])(?![^\n:]+:(?:[ \t]|$))(?=\S)") & ~F.col("_block").rlike(
        r"(?m)^[^\s:#][^\n:]*:[ \t]+[\[{][^\]}\n]*$"
    )
    df = skills.withColumn("_block", block).withColumn("_valid", valid)
    df = df.withColumn("_name", yaml_scalar(F.col("_block"), "name")).withColumn(
        "_description", yaml_scalar(F.col("_block"), "description")
    )
    some, empty = F.col("_block").isNotNull(), F.coalesce("_description", F.lit("")) == ""
    readable = some & F.col("_valid") & (F.trim("_block") != "")

    def issue(when: Column, severity: str, rule: str, message: Column) -> Column:
        return F.when(
            when,
            F.struct(F.lit(severity).alias("severity"), F.lit(f"quality-{rule}").alias("rule_id"), message.alias("message")),
        )

    size = F.length("_description")
    same = F.lower(tx.strip(F.col("_name"))) == F.lower(tx.strip(F.col("_description")))
    issues = F.array_compact(
        F.array(
            issue(~some, "medium", "no-frontmatter", F.lit("SKILL.md has no YAML frontmatter")),
            issue(some & ~F.col("_valid"), "medium", "invalid-frontmatter", F.lit("SKILL.md frontmatter is not valid YAML")),
            issue(readable & F.col("_name").isNull(), "medium", "missing-name", F.lit("SKILL.md frontmatter is missing 'name' field")),
            issue(readable & empty, "medium", "missing-description", F.lit("SKILL.md frontmatter is missing 'description' field")),
            issue(
                readable & ~empty & (size < 10), "medium", "short-description",
                F.concat(F.lit("SKILL.md description is "), size, F.lit(" characters, too short to be meaningful")),
            ),
            issue(
                readable & ~empty & (F.col("_name") != "") & same, "low", "description-equals-name",
                F.lit("SKILL.md description is identical to the name"),
            ),
        )
    )
    found = df.select(*FILE, F.inline(issues))
    return finding(
        found, F.col("severity"), F.col("rule_id"), F.col("message"), F.lit("description_quality"), F.lit(None)
    )


LINK = r"\[.*?\]\(([^)]+)\)"


def relative_links(files: DataFrame) -> DataFrame:
    """Relative links of every file, each once with its first line, and the path they lead to."""
    lines = file_lines(scanned_files(files).where(F.col("content").contains("]("))).where(
        ~F.col("in_fence") & ~_stripped_starts(">")
    )
    raw = lines.where(F.col("line").contains("](")).select(
        *FILE, "line_no", F.explode(F.regexp_extract_all("line", F.lit(LINK), 1)).alias("_raw")
    )
    ref = tx.strip(F.col("_raw"))
    outside = ref.rlike(r"\A(?:https?://|#|mailto:)") | ref.contains("$") | ref.contains("{{")
    links = raw.where(~outside).withColumn("ref", F.substring_index(ref, "#", 1)).where(F.col("ref") != "")
    # combining minimum per file and link: no window, and a file with many repeated links stays small
    first = links.groupBy(*FILE, "ref").agg(F.min("line_no").alias("line_no"))
    folder = F.regexp_replace("file_path", r"[^/]*\z", "")
    joined = F.when(F.col("ref").startswith("/"), F.col("ref")).otherwise(F.concat(folder, "ref"))
    return first.withColumn("target", normal_path(joined))


def normal_path(path: Column) -> Column:
    """Without ``.``, empty and ``..`` parts; a path that leaves its root keeps a leading ``..``."""
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    empty = F.array().cast("array<string>")

    def step(acc: Column, p: Column) -> Column:
        back = (p == "..") & (F.size(acc) > 0) & (F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit("")) != "..")
        return F.when(back, F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(p)))

    plain = F.array_join(F.aggregate(parts, empty, step), "/")
    return F.when(path.startswith("/"), F.concat(F.lit("/"), plain)).otherwise(plain)


def existing_paths(manifest: DataFrame) -> DataFrame:
    """Files and all their directories, per submission; directories repeat, which an anti-join does not mind."""
    parts = F.split("file_path", "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return manifest.select("submission_name", F.explode(prefixes).alias("target"))


def broken_references(files: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """Relative links whose target is neither a file nor a directory of the submission."""
    present = existing_paths(files if manifest is None else manifest)
    missing = relative_links(files).where(F.col("target") != "").join(present, ["submission_name", "target"], "left_anti")
    message = F.concat(
        F.lit("Line "), "line_no", F.lit(": link to '"), "ref", F.lit("' points to a file that does not exist")
    )
    return finding(
        missing, F.lit("medium"), F.lit("quality-broken-reference"), message, F.lit("broken_reference"), F.col("line_no")
    )


def file_completeness(files: DataFrame) -> DataFrame:
    """Thin instructions, and test files without an assertion."""
    body = tx.strip(F.regexp_replace("content", rf"\A---(?s:.*?)---[{tx.SPACE}]*", ""))
    body = tx.strip(F.regexp_replace(body, r"\A#[^\n]*\n?", ""))
    size = F.length(body)
    thin = files.where(F.col("file_path") == "instruction.md").withColumn("_size", size).where(F.col("_size") < 50)
    bare = files.where(
        F.col("file_path").rlike(r"\Atests/[^/]+\.py\z")
        & ~F.col("content").contains("assert")
        & ~F.col("content").contains("pytest.raises")
    )
    return finding(
        thin,
        F.when(F.col("_size") < 10, "high").otherwise("low"),
        F.lit("quality-thin-instruction"),
        F.concat(F.lit("instruction.md has only "), "_size", F.lit(" characters of body text")),
        F.lit("file_completeness"),
        F.lit(None),
    ).unionByName(
        finding(
            bare, F.lit("medium"), F.lit("quality-no-assertions"), F.concat("file_path", F.lit(" has no assert statements")),
            F.lit("file_completeness"), F.lit(None),
        )
    )


def quality_findings(files: DataFrame, cycles: DataFrame | None = None, external: DataFrame | None = None) -> DataFrame:
    """All deterministic quality checks; cycles and findings from elsewhere are added where given."""
    checks = [description_quality, broken_references, imprecise_instructions, unfinished_content, generic_advice,
              file_completeness]
    parts = [check(files) for check in checks]
    parts += [x for x in (cycles, external) if x is not None]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def severity_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("submission_name", "severity").agg(F.count(F.lit(1)).alias("n"))


# an except clause for everything, its only statement, and no further line as deep as its body
SWALLOWED = (
    r"(?m)^([ \t]*)except[ \t]*(Exception|BaseException)?(?:[ \t]+as[ \t]+\w+)?[ \t]*:[ \t]*(?:#[^\n]*)?"
    r"(?:\n(?:[ \t]*(?:#[^\n]*)?\n)*[ \t]+)?(?:pass|\.\.\.)[ \t]*(?:#[^\n]*)?$"
    r"(?!(?:\n[ \t]*(?:#[^\n]*)?)*\n\1[ \t]+[^\s#])"
)


def swallowed_errors(files: DataFrame) -> DataFrame:
    """Handlers of everything whose whole body is ``pass`` or ``...``, in the tests of a submission.

    Works on the source text; a handler written inside a string literal is counted as well.
    """
    tests = files.where(F.col("file_path").rlike(r"\Atests/[^/]+\.py\z"))
    found = tests.select(*FILE, F.explode(F.regexp_extract_all("content", F.lit(SWALLOWED), 2)).alias("_kind"))
    message = F.concat(
        F.when(F.col("_kind") == "", "Bare 'except: pass'").otherwise(F.concat(F.lit("'except "), "_kind", F.lit(": pass'"))),
        F.lit(" hides all errors"),
    )
    return finding(found, F.lit("high"), F.lit("swallowed-error"), message, F.lit("error_handling"), F.lit(None))
