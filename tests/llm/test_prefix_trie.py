"""Prefix trie against a brute-force trie, over one and many shards, and the parentheses themselves."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from trialmill.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, shard int, kind int, part int, position long, path string, n long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, group=20, most=4):
    turns = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, x) for _, r, x in sorted(t)] for c, t in turns.items()}
    path = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % most
        path[c] = tuple(own.get(c - c % group, [])[:h] + own[c][h:])
    members = collections.defaultdict(list)
    for c, p in path.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    kids = collections.defaultdict(set)
    for p in members:
        if p:
            kids[p[:-1]].add(p)
    out = collections.Counter()
    leaves, saved = collections.Counter(), collections.Counter()
    for p, cs in members.items():
        gain = (len(cs) - 1) * len(WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += gain
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(path[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out[min(cs), len(p), parent, len(cs), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def got(df):
    return collections.Counter(
        (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()
    )


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, "x", 5) for r in rows], SCHEMA).repartition(3)


def odd_rows(seed=3, convs=90):
    rnd = random.Random(seed)
    said = [None, "", "a", "a b", " a  b ", "é 日本", "long " * 300]
    rows = []
    for c in range(convs):
        if c % 20 == 0 and c % 40:
            continue  # some groups have no first conversation
        for t in range(rnd.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, t, rnd.choice(["user", "assistant", None]), rnd.choice(said[: rnd.choice([2, 7])])))
    rows += [(7, None, "user", "first"), (7, None, "user", "first"), (7, 1, "user", "tie b"), (7, 1, "user", "tie a"), (None, 1, "user", "nobody")]
    rows += [(10**15, 1, "u", "far")] + [(2**40 + 3, t, "u", f"deep {t // 3}") for t in range(40)] + [(2**40 + 23, t, "u", f"deep {t // 3}") for t in range(41)]
    return rows


@pytest.fixture
def many_shards(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


@pytest.mark.parametrize("chunk", [T.CHUNK, 16])
def test_nodes_equal_brute_force(spark, many_shards, chunk):
    rows = odd_rows()
    assert got(T.prefix_nodes(table(spark, rows), chunk=chunk)) == brute(rows)


def test_one_shard_and_odd_tables(spark):
    rows = odd_rows(5, 30)
    assert got(T.prefix_nodes(table(spark, rows))) == brute(rows)
    assert T.prefix_nodes(table(spark, [])).collect() == []
    assert T.prefix_nodes(table(spark, [(None, 1, "u", "x")])).collect() == []
    one = [(next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 4 == 3), 1, "u", "x")]
    assert got(T.prefix_nodes(table(spark, one))) == brute(one) and len(brute(one)) == 1  # the root alone


def test_copies_and_a_hot_conversation(spark, many_shards):
    rows = [(20 * c, t, "u", f"copied {t}") for c in range(200) for t in range(5)] + [(7, t, "u", f"w {t}") for t in range(130)]
    for chunk in (T.CHUNK, 64):
        assert got(T.prefix_nodes(table(spark, rows), chunk=chunk)) == brute(rows)


@pytest.mark.parametrize("size", [1, 2, 5, 31, 32, 33, 700, 5000])
def test_findclose(size):
    rnd = random.Random(size)
    for bias in (0.5, 0.02, 0.98):
        steps, depth, left = [], 0, size
        while left or depth:
            up = left and (not depth or rnd.random() < bias)
            steps.append(1 if up else -1)
            depth += steps[-1]
            left -= bool(up)
        want, stack = {}, []
        for i, s in enumerate(steps):
            stack.append(i) if s > 0 else want.__setitem__(stack.pop(), i)
        tree = T.Parentheses(np.array(steps, np.int8))
        opened = np.flatnonzero(tree.steps > 0)
        assert [want[int(i)] for i in opened] == tree.findclose(opened).tolist()


def test_range_min():
    values = np.random.default_rng(1).integers(0, 100, 77)
    low = T.RangeMin(values)
    first, last = np.triu_indices(77)
    assert (low(first, last) == [values[a : b + 1].min() for a, b in zip(first, last, strict=True)]).all()
