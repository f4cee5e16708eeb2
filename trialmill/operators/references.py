"""References between the skills of a submission, and the cycles among them."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmill.operators.textscan import front_matter, yaml_scalar
from trialmill.session import reliable_checkpoint

# Fixed values
REFERENCE_PATTERNS = (
    r"(?U)/(\w[\w-]+)(?:\s|$|[),\]])",
    r"""(?iU)(?:skill|command)[:\s]+["']?(\w[\w-]+)["']?""",
    r"""(?iU)(?:invokes?|calls?|triggers?|runs?)\s+["'`]?/?(\w[\w-]+)["'`]?""",
)
SUB = "submission_name"
#: References of one submission that a task searches at once (about 40 MB of names). Larger submissions are searched by joins.
MOST_EDGES = 200_000
_CYCLES = f"{SUB} string, members array<string>, chain array<string>"


def skills(files: DataFrame) -> DataFrame:
    """Skill files under ``skills/`` with their name (front matter, else folder) and body."""
    own = files.where(F.col("file_path").rlike(r"\Askills/(?:.*/)?SKILL\.md\z"))
    folder = F.element_at(F.split("file_path", "/"), -2)
    name = F.coalesce(
        yaml_scalar(front_matter(F.col("content")), "name"), F.when(folder == "skills", "root").otherwise(folder)
    )
    body = F.regexp_replace("content", r"\A---(?s:.*?)---\s*", "")
    return own.select(SUB, "file_path", name.alias("skill"), body.alias("body"))


def skill_edges(files: DataFrame) -> DataFrame:
    """Distinct references (submission, src, dst) to other skills of the same submission."""
    named = skills(files)
    refs = F.array_distinct(F.flatten(F.array(*[F.regexp_extract_all("body", F.lit(p), 1) for p in REFERENCE_PATTERNS])))
    raw = named.select(SUB, F.col("skill").alias("src"), F.explode(refs).alias("dst")).where(
        (F.col("dst") != F.col("src")) & (F.length("dst") > 1)
    )
    known = named.select(SUB, F.col("skill").alias("dst"))
    return raw.join(known, [SUB, "dst"], "left_semi").select(SUB, "src", "dst").distinct()


def _ends(edges: DataFrame, column: str, as_name: str) -> DataFrame:
    return edges.select(SUB, F.col(column).alias(as_name)).distinct()


def trim(edges: DataFrame) -> DataFrame:
    """Drop edges that cannot lie on a cycle until none is left to drop."""
    left = reliable_checkpoint(edges)
    size = left.count()
    while size:
        kept = left.join(_ends(left, "dst", "src"), [SUB, "src"], "left_semi").join(
            _ends(left, "src", "dst"), [SUB, "dst"], "left_semi"
        )
        left = reliable_checkpoint(kept.select(SUB, "src", "dst"))
        after = left.count()
        if after == size:
            break
        size = after
    return left


def _spread_colors(edges: DataFrame) -> DataFrame:
    """Every node's largest ancestor (or itself)."""
    nodes = _ends(edges, "src", "node").union(_ends(edges, "dst", "node")).distinct()
    colors = reliable_checkpoint(nodes.withColumn("color", F.col("node")))
    while True:
        arriving = edges.join(colors.withColumnRenamed("node", "src"), [SUB, "src"]).select(
            SUB, F.col("dst").alias("node"), F.col("color").alias("_new")
        )
        best = arriving.groupBy(SUB, "node").agg(F.max("_new").alias("_new"))
        joined = colors.join(best, [SUB, "node"], "left").withColumn("_up", F.coalesce(F.col("_new") > F.col("color"), F.lit(False)))
        step = reliable_checkpoint(
            joined.select(SUB, "node", F.when(F.col("_up"), F.col("_new")).otherwise(F.col("color")).alias("color"), "_up")
        )
        colors = step.drop("_up")
        if step.where("_up").isEmpty():
            return colors


def _backward(edges: DataFrame, colors: DataFrame) -> DataFrame:
    """Nodes that lead to the root of their color inside that color: one component per root."""
    inside = edges.join(colors.withColumnsRenamed({"node": "src", "color": "_a"}), [SUB, "src"]).join(
        colors.withColumnsRenamed({"node": "dst", "color": "_b"}), [SUB, "dst"]
    ).where("_a = _b").select(SUB, "src", "dst", F.col("_a").alias("color"))
    inside = reliable_checkpoint(inside)
    reached = reliable_checkpoint(colors.where("node = color").select(SUB, "node", "color"))
    fresh = reached
    while not fresh.isEmpty():
        back = inside.join(fresh.withColumnRenamed("node", "dst"), [SUB, "dst", "color"]).select(
            SUB, F.col("src").alias("node"), "color"
        ).distinct()
        fresh = reliable_checkpoint(back.join(reached, [SUB, "node", "color"], "left_anti"))
        reached = reliable_checkpoint(reached.unionByName(fresh))
    return reached


def _joined_components(edges: DataFrame) -> DataFrame:
    """Strongly connected groups of at least two skills: submission, component, node.

    Each round trims, lets the largest name spread forwards and collects what leads back to it. State
    between rounds is written to the shared checkpoint folder.
    """
    left = trim(edges)
    found = None
    while not left.isEmpty():
        reached = _backward(left, _spread_colors(left))
        groups = reached.select(SUB, F.col("color").alias("component"), "node")
        found = groups if found is None else found.unionByName(groups)
        rest = left.join(reached.select(SUB, F.col("node").alias("src")), [SUB, "src"], "left_anti").join(
            reached.select(SUB, F.col("node").alias("dst")), [SUB, "dst"], "left_anti"
        )
        left = trim(rest)
    if found is None:
        return edges.select(SUB, F.col("src").alias("component"), F.col("src").alias("node")).limit(0)
    sizes = found.groupBy(SUB, "component").agg(F.count(F.lit(1)).alias("_size")).where("_size > 1")
    return found.join(sizes.drop("_size"), [SUB, "component"], "left_semi")


def _groups(after: dict[str, list[str]]) -> list[list[str]]:
    """Strongly connected groups of at least two nodes; an explicit stack, as chains may be long."""
    seen: dict[str, int] = {}
    low: dict[str, int] = {}
    held: list[str] = []
    inside: set[str] = set()
    out = []
    for top in after:
        if top in seen:
            continue
        work = [(top, iter(after[top]))]
        seen[top] = low[top] = len(seen)
        held.append(top)
        inside.add(top)
        while work:
            node, rest = work[-1]
            for n in rest:
                if n not in seen:
                    seen[n] = low[n] = len(seen)
                    held.append(n)
                    inside.add(n)
                    work.append((n, iter(after.get(n, ()))))
                    break
                if n in inside:
                    low[node] = min(low[node], seen[n])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[node])
                if low[node] == seen[node]:
                    group = []
                    while not group or group[-1] != node:
                        group.append(held.pop())
                        inside.discard(group[-1])
                    if len(group) > 1:
                        out.append(group)
    return out


def _chain(group: list[str], after: dict[str, list[str]]) -> list[str]:
    """The shortest cycle through the group's smallest name; see :func:`reference_cycles`."""
    start, members = min(group), set(group)
    before: dict[str, str | None] = {start: None}
    level = [start]
    while True:
        back = [n for n in level if start in after[n]]
        if back and level != [start]:
            path, node = [], min(back)
            while node is not None:
                path.append(node)
                node = before[node]
            return [*reversed(path), start]
        found: dict[str, str] = {}
        for n in level:
            for m in after[n]:
                if m in members and m not in before and (m not in found or n < found[m]):
                    found[m] = n
        before |= found
        level = list(found)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cycles of one submission after the other; rows arrive sorted by submission."""
    current, after = None, defaultdict(list)

    def done() -> pa.RecordBatch:
        rows = [(current, sorted(g), _chain(g, after)) for g in _groups(dict(after))]
        columns = zip(*rows, strict=True) if rows else ((), (), ())
        kinds = (pa.string(), pa.list_(pa.string()), pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[SUB, "members", "chain"])

    for batch in batches:
        subs = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(subs[1:] != subs[:-1]) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(subs)], strict=True):
            if lo == hi:
                continue
            if subs[lo] != current and current is not None:
                yield done()
                after = defaultdict(list)
            current = subs[lo]
            for src, dst in zip(*(batch.column(i).slice(lo, hi - lo).to_pylist() for i in (1, 2)), strict=True):
                after[src].append(dst)
    if current is not None:
        yield done()


def _joined_chains(edges: DataFrame, members: DataFrame) -> DataFrame:
    """The chains of :func:`_chain` by joins, a level a round: parent pointers forwards, then the path read back."""
    key = [SUB, "component"]
    of = members.select(SUB, F.col("node").alias("src"), "component")
    inside = edges.join(of, [SUB, "src"]).join(of.withColumnsRenamed({"src": "dst", "component": "_b"}), [SUB, "dst"]).where("component = _b")
    inside = reliable_checkpoint(inside.select(*key, "src", "dst"))
    start = members.groupBy(*key).agg(F.min("node").alias("start"))
    back = reliable_checkpoint(inside.join(start, key).where("dst = start").select(*key, F.col("src").alias("node")))
    reached = reliable_checkpoint(start.select(*key, F.col("start").alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).alias("level")))
    fresh, ends, level = reached, None, 0
    while not fresh.isEmpty():
        level += 1
        step = inside.join(fresh.select(*key, F.col("node").alias("src")), [*key, "src"]).groupBy(*key, F.col("dst").alias("node"))
        step = step.agg(F.min("src").alias("parent"), F.lit(level).alias("level")).join(reached, [*key, "node"], "left_anti")
        fresh = reliable_checkpoint(step.select(*key, "node", "parent", "level"))
        reached = reliable_checkpoint(reached.unionByName(fresh))
        end = fresh.join(back, [*key, "node"]).groupBy(*key).agg(F.min("node").alias("node"))
        ends = reliable_checkpoint(end if ends is None else ends.unionByName(end))
        fresh = fresh.join(ends, key, "left_anti")  # groups whose way back is known are done
    path = reliable_checkpoint(ends.select(*key, "node", F.array("node").alias("chain")))
    done = []
    while not path.isEmpty():
        path = reliable_checkpoint(path.join(reached, [*key, "node"]).select(*key, F.col("parent").alias("node"), "chain"))
        done.append(path.where("node is null").select(*key, F.concat("chain", F.array(F.element_at("chain", 1))).alias("chain")))
        path = path.where("node is not null").select(*key, "node", F.concat(F.array("node"), "chain").alias("chain"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def reference_cycles(edges: DataFrame, most_edges: int = MOST_EDGES) -> DataFrame:
    """One row per strongly connected group of at least two skills: submission, members (sorted) and chain.

    The chain is a real cycle that begins and ends with the group's smallest name: a shortest one, of these the
    one whose last names are smallest. Submissions are searched each in one task, which reads its references as
    a stream; those with more than ``most_edges`` are searched by joins instead, level by level, with the same result.
    """
    edges = reliable_checkpoint(edges.select(SUB, "src", "dst"))  # texts are searched once
    sizes = edges.groupBy(SUB).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most_edges).select(SUB)
    large = reliable_checkpoint(sizes)
    plain = edges if large.isEmpty() else edges.join(large, SUB, "left_anti")
    small = plain.repartition(SUB).sortWithinPartitions(SUB, "src", "dst").mapInArrow(_search, _CYCLES)
    if large.isEmpty():
        return small
    rest = reliable_checkpoint(edges.join(large, SUB, "left_semi"))
    members = reliable_checkpoint(_joined_components(rest))
    if members.isEmpty():
        return small
    chains = _joined_chains(rest, members)
    groups = members.groupBy(SUB, "component").agg(F.array_sort(F.collect_set("node")).alias("members"))
    return small.unionByName(groups.join(chains, [SUB, "component"]).select(SUB, "members", "chain"))


def cycle_components(edges: DataFrame) -> DataFrame:
    """Strongly connected groups of at least two skills: submission, component (the largest name), node."""
    cycles = reference_cycles(edges)
    return cycles.select(SUB, F.element_at("members", -1).alias("component"), F.explode("members").alias("node"))


def circular_references(files: DataFrame) -> DataFrame:
    """One medium finding per group of skills that refer to each other in a circle, with a chain that does so."""
    cycles = reference_cycles(skill_edges(files)).withColumn("skill", F.element_at("chain", 1))
    paths = skills(files).groupBy(SUB, "skill").agg(F.max("file_path").alias("file_path"))
    message: Column = F.concat(F.lit("Circular reference detected: "), F.array_join("chain", " -> "))
    return cycles.join(paths, [SUB, "skill"], "left").select(
        SUB, "file_path", F.lit(None).cast("int").alias("line"), F.lit("medium").alias("severity"),
        F.lit("quality-circular-reference").alias("rule_id"), F.lit("circular_reference").alias("category"),
        message.alias("message"),
    )
