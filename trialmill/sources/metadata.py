"""Block-structured metadata as rows: every scalar of a file with the path of keys that leads to it.

One relation serves gate policies, certification policies, profiles and run summaries. A file stays one row while its
lines are read; nothing is shuffled. Read are nested mappings and lists, compact list items, plain and quoted scalars,
scalars that go on over several lines, literal and folded blocks, flow collections and comments. Of keys that occur twice the
last counts. Anchors, aliases, tags, flow collections deeper than ``FLOW_DEPTH`` or with keys on further lines come as
rows of kind "unknown", so that a reader can tell them from absent keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmill.functions.stats import let
from trialmill.operators.certify import CHECK_IDS, LEVELS

ROWS = "array<struct<path:array<string>,kind:string,value:string,line:int>>"
#: Levels of a flow collection that become rows.
FLOW_DEPTH = 3

_COMMENT = r"(?:#.*)?\z"
_DASHES = r"\A((?:-(?:[ \t]+|\z))*)"
_KEY = r"""\A("(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[^\s"'\[\]{}#&*!|>%@`,].*?)[ \t]*:(?:[ \t]+(.*))?\z"""
_BLOCK = rf"\A[|>][-+0-9]*[ \t]*{_COMMENT}"
_DOUBLE = rf'\A"((?:[^"\\]|\\.)*)"[ \t]*{_COMMENT}'
_SINGLE = rf"\A'((?:[^']|'')*)'[ \t]*{_COMMENT}"
_NUMBER = r"\A[-+]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][-+]?\d+)?\z"
_FLOW_TOKEN = r""""(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[\[\]{},]|:(?=[\s\[{]|\z)|(?<=["']):|(?:[^\s\[\]{},:"']|:(?=[^\s\[{])|[ \t]+(?=[^\s\[\]{},:]))+"""
_JSON = r"""\A(?:\[|\{\s*["}])"""
# Fixed values
NULLS = ("", "~", "null", "Null", "NULL")
TRUE = ("true", "True", "TRUE", "yes", "Yes", "YES", "on", "On", "ON")
FALSE = ("false", "False", "FALSE", "no", "No", "NO", "off", "Off", "OFF")


def _plain(raw: Column) -> Column:
    bare = F.when(raw.contains("#"), F.regexp_replace(raw, r"(?:\A|[ \t]+)#.*\z", "")).otherwise(raw)
    return F.regexp_replace(bare, r"[ \t]+\z", "")


def _unescaped(text: Column) -> Column:
    """Inside of double quotes; a JSON string of the same text has the same escapes but for rare ones."""
    return F.coalesce(F.get_json_object(F.concat(F.lit('{"v":"'), text, F.lit('"}')), "$.v"), text)


def _unquoted(raw: Column) -> Column:
    double, single = F.regexp_extract(raw, _DOUBLE, 1), F.regexp_extract(raw, _SINGLE, 1)
    return (
        F.when(raw.startswith('"') & raw.rlike(_DOUBLE), _unescaped(double))
        .when(raw.startswith("'") & raw.rlike(_SINGLE), F.replace(single, F.lit("''"), F.lit("'"))).otherwise(_plain(raw))
    )


def _kind(raw: Column, value: Column) -> Column:
    return (
        F.when((raw.startswith('"') & raw.rlike(_DOUBLE)) | (raw.startswith("'") & raw.rlike(_SINGLE)), "string")
        .when(value.isin(*NULLS), "null")
        .when(value.isin(*TRUE, *FALSE), "bool")
        .when(value.rlike(_NUMBER), "number")
        .when(value.rlike(r"\A[\[{&*!]"), "unknown")
        .otherwise("string")
    )


def _normal(kind: Column, value: Column) -> Column:
    """Nulls have no value; flags are true or false."""
    flag = F.when(value.isin(*TRUE), "true").otherwise("false")
    return F.when(kind == "null", F.lit(None).cast("string")).when(kind == "bool", flag).otherwise(value)


def _lines(text: Column) -> Column:
    """The lines of a text: number, indentation, list dashes, whether a key follows, its raw value, the column below which a
    block that it opens lies (null: it opens none). Patterns are matched here, once per line."""

    def line(x: Column, i: Column) -> Column:
        spaces = F.length(x) - F.length(F.ltrim(x))
        return F.struct(i.cast("int").alias("no"), spaces.alias("indent"), F.regexp_replace(F.ltrim(x), r"[ \t]+\z", "").alias("text"))

    def cut(x: Column) -> Column:
        dashes = F.when(x["text"].startswith("-"), F.regexp_extract(x["text"], _DASHES, 1)).otherwise("")
        return let({"x": x, "dashes": dashes}, lambda v: v["x"].withField("dashes", v["dashes"]).withField("rest", F.substr(v["x"]["text"], F.length(v["dashes"]) + 1)))

    def keyed(x: Column) -> Column:
        return x.withField("keyed", x["rest"].contains(":") & x["rest"].rlike(_KEY))

    def valued(x: Column) -> Column:
        return x.withField("raw", F.when(x["keyed"], F.regexp_extract(x["rest"], _KEY, 2)).otherwise(x["rest"]))

    def opening(x: Column) -> Column:
        may = (x["keyed"] | (x["dashes"] != "")) & (x["raw"].startswith("|") | x["raw"].startswith(">")) & ~x["text"].startswith("#")
        column = x["indent"] + F.length(x["dashes"]) - F.when(x["keyed"], 0).otherwise(1)
        return x.withField("opens", F.when(may & x["raw"].rlike(_BLOCK), column).cast("int"))

    lines = F.transform(F.split(text, "\n", -1), line)
    for step in (cut, keyed, valued, opening):
        lines = F.transform(lines, step)
    return lines


def _marks(lines: Column) -> Column:
    """For every line of a literal or folded block the number of the line that opens it, else null; no marks without blocks."""
    start = F.struct(F.lit(None).cast("int").alias("at"), F.lit(None).cast("int").alias("head"), F.array().cast("array<int>").alias("marks"))

    def step(s: Column, line: Column) -> Column:
        inside = F.coalesce((line["text"] == "") | (line["indent"] > s["at"]), F.lit(False))
        return F.struct(
            F.when(inside, s["at"]).otherwise(line["opens"]).alias("at"),
            F.when(inside, s["head"]).when(line["opens"].isNotNull(), line["no"]).alias("head"),
            F.concat(s["marks"], F.array(F.when(inside, s["head"]))).alias("marks"),
        )

    opened = F.exists(lines, lambda line: line["opens"].isNotNull())
    return F.when(opened, F.aggregate(lines, start, step, lambda s: s["marks"])).otherwise(F.array().cast("array<int>"))


def _entries(line: Column) -> Column:
    """List dashes, keys and scalars of one line, each with its column."""
    none = F.lit(None).cast("string")

    def entry(at: Column, what: str | Column, key: Column, raw: Column) -> Column:
        what = F.lit(what) if isinstance(what, str) else what
        return F.struct(at.cast("int").alias("at"), what.alias("what"), key.alias("key"), raw.alias("raw"), line["no"].alias("no"))

    dashes, rest, keyed = line["dashes"], line["rest"], line["keyed"]
    places = F.filter(F.sequence(F.lit(0), F.length(dashes) - 1), lambda i: F.substr(dashes, i + 1, F.lit(1)) == "-")
    items = F.transform(places, lambda i: entry(line["indent"] + i, "item", none, none))
    key = F.when(keyed, _unquoted(F.regexp_extract(rest, _KEY, 1)))
    last = F.array(entry(line["indent"] + F.length(dashes), F.when(keyed, "key").otherwise("scalar"), key, line["raw"]))
    shown = (rest != "") & ~rest.startswith("#")
    return F.when(dashes == "", F.when(shown, last).otherwise(F.slice(last, 1, 0))).when(shown, F.concat(items, last)).otherwise(items)


def _pathed(entries: Column) -> Column:
    """The entries that carry a scalar, each with its path; a stack holds the open keys and list items."""
    stack_type = "array<struct<at:int,name:string,item:boolean>>"
    out_type = "array<struct<path:array<string>,raw:string,no:int>>"
    start = F.struct(F.array().cast(stack_type).alias("stack"), F.array().cast(out_type).alias("out"))

    def step(s: Column, e: Column) -> Column:
        item = e["what"] == "item"
        kept = F.filter(s["stack"], lambda o: (o["at"] < e["at"]) | (item & (o["at"] == e["at"]) & ~o["item"]))
        before = F.filter(s["stack"], lambda o: o["item"] & (o["at"] == e["at"]))
        place = F.coalesce(F.get(before, F.lit(0))["name"].cast("int") + 1, F.lit(0)).cast("string")
        top = F.struct(e["at"].alias("at"), F.when(item, place).otherwise(e["key"]).alias("name"), item.alias("item"))
        stack = F.when(e["what"] == "scalar", kept).otherwise(F.concat(kept, F.array(top)))

        def added(v: Column) -> Column:
            path = F.transform(v["stack"], lambda o: o["name"])
            last = F.get(s["out"], F.size(s["out"]) - 1)
            goes_on = F.coalesce((e["what"] == "scalar") & (last["path"] == path), F.lit(False))
            joined = F.struct(last["path"].alias("path"), F.trim(F.concat(_plain(last["raw"]), F.lit(" "), e["raw"])).alias("raw"), last["no"].alias("no"))
            new = F.struct(path.alias("path"), F.coalesce(e["raw"], F.lit("")).alias("raw"), e["no"].alias("no"))
            longer = F.when(goes_on, F.concat(F.slice(s["out"], F.lit(1), F.size(s["out"]) - 1), F.array(joined))).otherwise(F.concat(s["out"], F.array(new)))
            return F.struct(v["stack"].alias("stack"), F.when(item, s["out"]).otherwise(longer).alias("out"))

        return let({"stack": stack}, added)

    return F.aggregate(entries, start, step, lambda s: s["out"])


def _block_text(lines: Column, marks: Column, no: Column, header: Column) -> Column:
    own = F.filter(lines, lambda x: F.coalesce(F.get(marks, x["no"]) == no, F.lit(False)))
    least = F.array_min(F.transform(F.filter(own, lambda x: x["text"] != ""), lambda x: x["indent"]))
    body = F.array_join(F.transform(own, lambda x: F.concat(F.repeat(F.lit(" "), F.greatest(x["indent"] - least, F.lit(0))), x["text"])), "\n")
    body = F.regexp_replace(body, r"\n+\z", "")
    folded = F.regexp_replace(F.regexp_replace(body, r"(?<!\n)\n(?!\n)", " "), r"\n\n", "\n")
    text = F.when(header.startswith(">"), folded).otherwise(body)
    return F.when(header.rlike(r"\A[|>]\d*-") | (text == ""), text).otherwise(F.concat(text, F.lit("\n")))


def _flow_json(raw: Column) -> Column:
    """A flow collection on one line as JSON text."""
    tokens = F.filter(F.transform(F.regexp_extract_all(raw, F.lit(_FLOW_TOKEN), F.lit(0)), lambda t: F.trim(t)), lambda t: t != "")

    def quoted(text: Column) -> Column:
        return F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r'(?s)\A\{"v":(.*)\}\z', 1)

    def one(tokens: Column, t: Column, i: Column) -> Column:
        is_key = F.coalesce(F.get(tokens, i + 1) == ":", F.lit(False))

        def scalar(v: Column) -> Column:
            number = F.coalesce(v["value"].try_cast("bigint").cast("string"), v["value"].try_cast("double").cast("string"))
            text = F.when(v["is_key"], quoted(v["value"])).when(v["kind"] == "null", "null").when(v["kind"] == "bool", _normal(v["kind"], v["value"]))
            return text.when(v["kind"] == "number", number).otherwise(quoted(v["value"]))

        typed = let({"value": _unquoted(t)}, lambda v: let({"value": v["value"], "kind": _kind(t, v["value"]), "is_key": is_key}, scalar))
        return F.when(t.isin("[", "]", "{", "}", ",", ":"), t).otherwise(typed)

    joined = let({"tokens": tokens}, lambda v: F.array_join(F.transform(v["tokens"], lambda t, i: one(v["tokens"], t, i)), ""))
    return F.regexp_replace(joined, r",(?=[\]}])", "")


def _leaves(found: Column, path: Column, line: Column, depth: int) -> Column:
    """Rows below a VARIANT, down to ``depth`` levels; what lies deeper is one row of kind unknown."""
    def below(v: Column) -> Column:
        kind_of, text = v["kind_of"], F.try_variant_get(found, "$", "string")
        is_map, is_list = kind_of.startswith("OBJECT"), kind_of.startswith("ARRAY")
        kind = (
            F.when(is_map | is_list, "unknown").when(kind_of == "VOID", "null").when(kind_of == "STRING", "string").when(kind_of == "BOOLEAN", "bool").otherwise("number")
        )
        leaf = F.array(F.struct(path.alias("path"), kind.alias("kind"), text.alias("value"), line.alias("line"))).cast(ROWS)
        if depth == 0:
            return leaf
        pairs = F.map_entries(F.try_variant_get(found, "$", "map<string,variant>"))
        items = F.try_variant_get(found, "$", "array<variant>")
        mapped = F.flatten(F.transform(pairs, lambda p: _leaves(p["value"], F.concat(path, F.array(p["key"])), line, depth - 1)))
        listed = F.flatten(F.transform(items, lambda x, i: _leaves(x, F.concat(path, F.array(i.cast("string"))), line, depth - 1)))
        return F.when(is_map, mapped).when(is_list, listed).otherwise(leaf)

    return let({"kind_of": F.schema_of_variant(found)}, below)


def document_rows(content: Column) -> Column:
    """Array of (path, kind, value, line): the scalars of one document in order, ``line`` from 0.

    Kinds: string, number, bool (true or false), null, unknown. List items have their place, from 0, in the path. An
    empty text has no rows, a null one gives null; an indentation by tabs gives a row of kind unknown without path.
    """
    text = F.when(content.contains("\r"), F.regexp_replace(content, r"\r\n?", "\n")).otherwise(content)

    def structured(v: Column) -> Column:
        used = F.filter(
            v["lines"], lambda x: F.get(v["marks"], x["no"]).isNull() & (x["text"] != "") & ~x["text"].startswith("#") & ~x["text"].isin("---", "...")
        )
        entries = F.flatten(F.transform(used, _entries))

        def resolved(w: Column) -> Column:
            def is_parent(r: Column, i: Column) -> Column:
                after = F.get(w["out"], i + 1)["path"]
                below = (F.size(after) > F.size(r["path"])) & (F.slice(after, F.lit(1), F.size(r["path"])) == r["path"])
                return F.coalesce(below & (_plain(r["raw"]) == ""), F.lit(False))

            def rows(r: Column) -> Column:
                block = (r["raw"].startswith("|") | r["raw"].startswith(">")) & r["raw"].rlike(_BLOCK)

                def typed(x: Column) -> Column:
                    kind = F.when(x["block"], "string").otherwise(_kind(r["raw"], x["value"]))
                    flow = F.when(r["raw"].rlike(r"\A[\[{]"), F.coalesce(F.when(x["value"].rlike(_JSON), F.try_parse_json(x["value"])), F.try_parse_json(_flow_json(x["value"]))))

                    def row(f: Column) -> Column:
                        text = F.when(x["block"], _block_text(v["lines"], v["marks"], r["no"], r["raw"])).otherwise(_normal(f["kind"], x["value"]))
                        plain = F.array(F.struct(r["path"].alias("path"), f["kind"].alias("kind"), text.alias("value"), r["no"].alias("line"))).cast(ROWS)
                        return F.when(f["flow"].isNotNull(), _leaves(f["flow"], r["path"], r["no"], FLOW_DEPTH)).otherwise(plain)

                    return let({"kind": kind, "flow": flow}, row)

                return let({"block": block, "value": _unquoted(r["raw"])}, typed)

            return F.flatten(F.transform(F.filter(w["out"], lambda r, i: ~is_parent(r, i)), rows))

        tabs = F.exists(used, lambda x: x["text"].startswith("\t"))
        none = F.lit(None).cast("string")
        odd = F.array(F.struct(F.array().cast("array<string>").alias("path"), F.lit("unknown").alias("kind"), none.alias("value"), F.lit(0).alias("line"))).cast(ROWS)
        return F.when(tabs, odd).otherwise(let({"out": _pathed(entries)}, resolved))

    return let({"lines": _lines(text)}, lambda v: let({"lines": v["lines"], "marks": _marks(v["lines"])}, structured))


def document_paths(files: DataFrame, content: str = "content") -> DataFrame:
    """One row per scalar: the other columns of ``files``, path, kind, value, line."""
    others = [c for c in files.columns if c != content]
    return files.select(*others, F.inline(document_rows(F.col(content))))


def scalar_at(rows: Column, path: Sequence[str], kind: str | None = None) -> Column:
    """The last scalar at a path as text (of one kind, if named); null where there is none."""
    wanted = F.array(*[F.lit(p) for p in path])
    found = F.filter(rows, lambda r: (r["path"] == wanted) & (F.lit(True) if kind is None else r["kind"] == kind))
    return F.get(found, F.size(found) - 1)["value"]


def _below(rows: Column, *path: str) -> Column:
    """Rows under a path, with the rest of their paths."""
    n = len(path)
    wanted = F.array(*[F.lit(p) for p in path])
    found = F.filter(rows, lambda r: (F.size(r["path"]) > n) & (F.slice(r["path"], 1, n) == wanted))
    return F.transform(found, lambda r: r.withField("path", F.slice(r["path"], F.lit(n + 1), F.size(r["path"]))))


def _listed(rows: Column) -> Column:
    """Values of a list of scalars, null where the list is absent."""
    plain = F.filter(rows, lambda r: (F.size(r["path"]) == 1) & r["value"].isNotNull())
    return F.when(F.size(plain) > 0, F.transform(plain, lambda r: r["value"]))


def gate_policy_documents(metadata: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, defaults) of the gate policies in metadata files (submission_name, content).

    Items: submission_name, gate_name, mode, threshold, weight, push_fact, as JSON policies give them. Defaults:
    submission_name, combination, default_mode, evaluation_threshold, policy_state. A file whose policy has rows of kind
    unknown, or numbers that are none, counts as unreadable: it has the defaults, no items, and the state "unreadable".
    """
    rows = metadata.select("submission_name", document_rows(F.col("content")).alias("rows"))
    rows = rows.withColumn("policy", _below(F.col("rows"), "gate_policy")).withColumn("gates", _below(F.col("policy"), "gates"))
    number = lambda r: F.element_at(r["path"], -1).isin("threshold", "weight") & (F.size(r["path"]) == 2) & ~r["kind"].isin("number", "null") & r["value"].try_cast("double").isNull()
    broken = F.exists("rows", lambda r: r["kind"] == "unknown") | F.exists("gates", number)
    state = F.when(F.coalesce(broken, F.lit(False)), "unreadable").when(F.size("policy") > 0, "own").otherwise("default")
    rows = rows.withColumn("policy_state", state)
    usable = F.when(F.col("policy_state") == "own", F.col("policy"))
    defaults = rows.select(
        "submission_name",
        F.coalesce(scalar_at(usable, ["combination"]), F.lit("all_pass")).alias("combination"),
        F.coalesce(scalar_at(usable, ["default_mode"]), F.lit("warn")).alias("default_mode"),
        scalar_at(usable, ["gates", "evaluation", "threshold"]).try_cast("double").alias("evaluation_threshold"),
        "policy_state",
    )
    names = F.array_distinct(F.transform(F.col("gates"), lambda r: r["path"][0]))
    # an outer explode, as a condition on the names would make Spark read the documents once more for a filter
    named = F.when(F.col("policy_state") == "own", names)
    items = rows.select("submission_name", "gates", F.explode_outer(named).alias("gate_name")).where("gate_name is not null")

    def field(name: str) -> Column:
        wanted = F.array(F.col("gate_name"), F.lit(name))
        found = F.filter("gates", lambda r: r["path"] == wanted)
        return F.get(found, F.size(found) - 1)["value"]

    return items.select(
        "submission_name", "gate_name", F.coalesce(field("mode"), F.lit("warn")).alias("mode"), field("threshold").try_cast("double").alias("threshold"),
        F.coalesce(field("weight").try_cast("double"), F.lit(1.0)).alias("weight"), F.coalesce(field("push_fact").try_cast("boolean"), F.lit(False)).alias("push_fact"),
    ), defaults


def _levels(rows: Column, *path: str) -> dict[str, Column]:
    """``<level>_checks`` and ``<level>_thresholds`` below a path; null where a level leaves them out."""
    columns = {}
    for level in LEVELS:
        checks = _listed(_below(rows, *path, level, "checks"))
        unknown = F.filter(checks, lambda c: ~c.isin(*CHECK_IDS))
        wrong = F.raise_error(F.concat(F.lit("unknown certification checks: "), F.array_join(unknown, ", "))).cast("array<string>")
        columns[f"{level}_checks"] = F.when(F.size(unknown) > 0, wrong).otherwise(checks)
        limits = F.transform(_below(rows, *path, level, "thresholds"), lambda r: F.struct(r["path"][0].alias("key"), r["value"].try_cast("double").alias("value")))
        last = F.filter(limits, lambda x, i: ~F.exists(F.slice(limits, i + 2, F.size(limits)), lambda y: y["key"] == x["key"]))
        columns[f"{level}_thresholds"] = F.map_from_entries(last)
    return columns


def certification_policies(metadata: DataFrame) -> DataFrame:
    """Own certification policies of metadata files, as ``certify.resolve_policy`` takes them; files without one give no row."""
    rows = metadata.select("submission_name", document_rows(F.col("content")).alias("rows"))
    rows = rows.where(F.size(_below(F.col("rows"), "certification_policy")) > 0)
    return rows.select("submission_name", *[c.alias(n) for n, c in _levels(F.col("rows"), "certification_policy").items()])


def profile_policies(profiles: DataFrame) -> DataFrame:
    """Profiles of configuration files (content): profile, is_default and the levels' checks and thresholds.

    An unknown check raises. The columns of the levels are those of :func:`certification_policies`.
    """
    rows = profiles.select(document_rows(F.col("content")).alias("rows"))
    names = F.array_distinct(F.transform(_below(F.col("rows"), "profiles"), lambda r: r["path"][0]))
    default = F.coalesce(scalar_at(F.col("rows"), ["default_profile"]), F.lit("skill")).alias("chosen")
    each = rows.select("rows", default, F.explode(names).alias("profile"))
    mine = F.transform(
        F.filter("rows", lambda r: (F.size(r["path"]) > 2) & (r["path"][0] == "profiles") & (r["path"][1] == F.col("profile"))),
        lambda r: r.withField("path", F.slice(r["path"], F.lit(3), F.size(r["path"]))),
    )
    each = each.withColumn("mine", mine)
    return each.select("profile", (F.col("profile") == F.col("chosen")).alias("is_default"), *[c.alias(n) for n, c in _levels(F.col("mine")).items()])


def with_profile(own: DataFrame, submissions: DataFrame, profiles: DataFrame) -> DataFrame:
    """Each submission's policy: its own, else that of its named profile; those with neither give no row.

    ``submissions``: submission_name, profile (null: none named). A profile that no file has raises. Profiles are
    joined as a table; few rows as they are, Spark broadcasts them by their size.
    """
    levels = [f"{x}_{what}" for x in LEVELS for what in ("checks", "thresholds")]
    named = profiles.select(F.col("profile").alias("_name"), F.struct(*levels).alias("_theirs"))
    chosen = submissions.join(named, F.col("profile") == F.col("_name"), "left")
    chosen = chosen.join(own.select("submission_name", F.struct(*levels).alias("_own")), "submission_name", "left")
    missing = F.raise_error(F.concat(F.lit("unknown certification profile: "), "profile")).cast(chosen.schema["_theirs"].dataType)
    policy = F.when(F.col("_own").isNotNull(), F.col("_own")).when(F.col("profile").isNotNull() & F.col("_name").isNull(), missing).otherwise(F.col("_theirs"))
    return chosen.withColumn("_policy", policy).where("_policy is not null").select("submission_name", "_policy.*")


def run_summaries(files: DataFrame) -> DataFrame:
    """Harness runs from their ``summary.yaml`` and ``run_result.json`` (run_dir, name, content), one row per run folder.

    The result's mean reward wins wherever its key exists, also as null; a run without either has 0. Files that cannot
    be read count as absent. A folder's two files meet in one aggregation; only fields are shuffled, not texts.
    ``run_metrics`` are the summary's, as pairs of a path joined by dots and a text.
    """
    rows = document_rows(F.when(F.col("name") == "summary.yaml", F.col("content")))
    doc = F.try_parse_json(F.when(F.col("name") == "run_result.json", F.col("content")))
    read = files.where(F.col("name").isin("summary.yaml", "run_result.json")).select("run_dir", rows.alias("rows"), doc.alias("doc"))

    def get(name: str, kind: str) -> Column:
        return F.try_variant_get("doc", f"$.{name}", kind)

    keys = F.map_keys(F.try_variant_get("doc", "$", "map<string,variant>"))
    mean = F.when(F.array_contains(keys, "mean_reward"), F.struct(get("mean_reward", "double").alias("v")))
    result = F.struct(
        get("duration_s", "double").alias("duration_s"), get("cost_usd", "decimal(12,6)").alias("cost_usd"), F.to_json(get("token_usage", "variant")).alias("tokens"),
        get("harbor_job_dir", "string").alias("harbor_job_dir"), get("num_turns", "bigint").alias("num_turns"),
        get("n_infra_errors", "bigint").alias("n_infra_errors"), get("n_trial_errors", "bigint").alias("n_trial_errors"), mean.alias("own_mean"),
    )
    clear = ~F.exists("rows", lambda r: r["kind"] == "unknown")
    summary = F.struct(
        scalar_at(F.col("rows"), ["mean_reward"]).try_cast("double").alias("mean"), F.exists("rows", lambda r: r["path"] == F.array(F.lit("mean_reward"))).alias("has"),
        F.exists("rows", lambda r: F.get(r["path"], F.lit(0)) == "pairwise").alias("pairwise"),
        F.transform(_below(F.col("rows"), "run_metrics"), lambda r: F.struct(F.array_join(r["path"], ".").alias("name"), r["value"].alias("value"))).alias("metrics"),
    )
    fields = read.select("run_dir", F.when(F.col("doc").isNotNull(), result).alias("r"), F.when(clear, summary).alias("s"))
    runs = fields.groupBy("run_dir").agg(F.first("r", ignorenulls=True).alias("r"), F.first("s", ignorenulls=True).alias("s"))
    from_summary = F.when(F.col("s.has"), F.col("s.mean")).otherwise(0.0)
    return runs.select(
        "run_dir", F.when(F.col("r.own_mean").isNotNull(), F.col("r.own_mean.v")).otherwise(from_summary).alias("mean_reward"),
        F.when(F.col("s.pairwise"), "pairwise").otherwise("single").alias("mode"),
        *[f"r.{c}" for c in ("duration_s", "cost_usd", "tokens", "harbor_job_dir", "num_turns", "n_infra_errors", "n_trial_errors")],
        F.col("s.metrics").alias("run_metrics"),
    )
