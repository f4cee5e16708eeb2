"""Cycles of references: groups, real chains, and both ways of searching."""

import itertools
import random

import pytest

from trialmill.operators import references as R

SCHEMA = "submission_name string, src string, dst string"


def reach(after, start):
    seen, todo = set(), list(after.get(start, ()))
    while todo:
        n = todo.pop()
        if n not in seen:
            seen.add(n)
            todo += after.get(n, ())
    return seen


def brute(edges):
    """Groups by mutual reach, and of all cycles through the smallest name the first by length, then by the names read backwards."""
    out = set()
    for sub in {e[0] for e in edges}:
        after = {}
        for s, a, b in edges:
            if s == sub:
                after.setdefault(a, set()).add(b)
        far = {n: reach(after, n) for n in {*after, *itertools.chain(*after.values())}}
        groups = {frozenset(m for m in far[n] if n in far[m]) for n in far} - {frozenset()}
        for g in (g for g in groups if len(g) > 1):
            start, paths = min(g), [[min(g)]]
            while True:
                closed = [p for p in paths if start in after[p[-1]] and len(p) > 1]
                if closed:
                    break
                paths = [[*p, n] for p in paths for n in after[p[-1]] if n in g and n not in p]
            out.add((sub, tuple(sorted(g)), tuple(min(closed, key=lambda p: p[::-1])) + (start,)))
    return out


def got(df):
    rows = [(r.submission_name, tuple(r.members), tuple(r.chain)) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def graphs():
    rnd = random.Random(4)
    edges = set()
    for s in range(12):
        names = [f"n{i}" for i in range(rnd.choice([2, 4, 9]))]
        for _ in range(rnd.choice([1, len(names), 2 * len(names)])):
            a, b = rnd.sample(names, 2)
            edges.add((f"s{s}", a, b))
    edges |= {("ring", f"r{i:02}", f"r{(i + 1) % 30:02}") for i in range(30)} | {("both", f"b{i}", f"b{i + d}") for i in range(1, 8) for d in (1, -1)}
    edges |= {("two", a, b) for a, b in ("ab", "ba", "bc", "cd", "dc", "xy")} | {("dag", a, b) for a, b in ("ab", "ac", "bd", "cd")}
    return sorted(edges)


@pytest.mark.parametrize("most", [10**6, 5])
def test_chains_equal_brute_force(spark, most):
    edges = [e for e in graphs() if most > 5 or e[0] in ("s1", "s2", "two", "dag")]  # by joins every level is a round
    found = got(R.reference_cycles(spark.createDataFrame(edges, SCHEMA).repartition(3), most_edges=most))
    assert found == brute(edges)
    known = set(edges)
    for sub, members, chain in found:
        assert chain[0] == chain[-1] == min(members) and set(chain) <= set(members)
        assert all((sub, a, b) in known for a, b in zip(chain, chain[1:], strict=False))


def test_no_references(spark):
    for most in (10, 0):
        assert R.reference_cycles(spark.createDataFrame([], SCHEMA), most).collect() == []
        assert R.reference_cycles(spark.createDataFrame([("s", "a", "b")], SCHEMA), most).collect() == []


def test_a_long_chain_and_ring_take_few_jobs(spark):
    n = 20_000
    edges = [("s", f"c{i:05}", f"c{i + 1:05}") for i in range(n)] + [("t", f"r{i:05}", f"r{(i + 1) % n:05}") for i in range(n)]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("cycles", "cycles")
    try:
        df = R.reference_cycles(spark.createDataFrame(edges, SCHEMA))
        rows = df.collect()
        jobs = len(tracker.getJobIdsForGroup("cycles"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert len(rows) == 1 and len(rows[0].chain) == n + 1 and jobs < 10
