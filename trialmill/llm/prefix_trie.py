"""Prefix trie of conversations as balanced parentheses, a shard at a time.

Conversations with the same turns are one weighted path. Paths are sorted and dealt by ranges into shards. A
shard writes its trie as a string of parentheses in depth-first order (a node opens, its subtree follows, it
closes) without any pointers: the common prefix of neighbouring paths tells what closes and opens between them.
Blocks of the string keep the range of the excess (opened less closed) in them, with a binary tree of ranges
above, so ``findclose`` skips whatever does not hold the excess it looks for. A node's subtree is what lies between
its parentheses: leaves are pairs '()' and are counted by rank, members, tokens and savings are differences of
cumulative arrays over the opened nodes.

Only nodes on a shard's first and last path can occur in other shards as well. Each shard is given the last path
before it and the first one behind it: nodes that it shares with the path before are counted there (as nodes and
as leaves), those shared with the path behind are no leaves because of what follows. The shared spines are then
added up by node id; everything else is final in its shard.

Nodes are named by 128-bit hashes: the exclusive or of one hash per (depth, turn), which Spark and numpy compute
alike. Paths are cut into chunks of ``CHUNK`` turns, so that a conversation of any length is no single row; the
trie of a deeper chunk hangs below the node where the chunk above ends and hands its totals up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialmill.functions.ranks import positions
from trialmill.llm.store import saved

#: A conversation c takes its first turns from c - c % GROUP: crc32(c) % MOST of them.
GROUP, MOST = 20, 4
#: Turns of a path that are one row.
CHUNK = 4096
#: Parentheses in a block of the range min-max structure.
BLOCK = 64
WORD = r"[^\\x20\\x09-\\x0D]+"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class Parentheses:
    """A string of balanced parentheses (+1, -1) with blocks of excess ranges and a tree over them."""

    def __init__(self, steps: np.ndarray):
        self.steps = steps
        self.excess = np.cumsum(steps, dtype=np.int64)
        n = -(-len(steps) // BLOCK) * BLOCK
        last = self.excess[-1] if len(steps) else 0
        padded = np.concatenate([self.excess, np.full(n - len(steps), last, np.int64)]).reshape(-1, BLOCK)
        self.ranges = [(padded.min(axis=1), padded.max(axis=1))]
        while len(self.ranges[-1][0]) > 1:
            low, high = self.ranges[-1]
            if len(low) % 2:
                low, high = np.append(low, low[-1]), np.append(high, high[-1])
                self.ranges[-1] = low, high
            self.ranges.append((np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2])))

    def _holds(self, level: int, block: np.ndarray, value: np.ndarray) -> np.ndarray:
        low, high = self.ranges[level]
        inside = block < len(low)
        block = np.minimum(block, len(low) - 1)
        return inside & (low[block] <= value) & (value <= high[block])

    def _scan(self, start: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The first place from ``start`` to the end of its block with that excess; -1 if there is none."""
        out = np.full(len(start), -1)
        todo, at = np.arange(len(start)), start.copy()
        end = np.minimum((start // BLOCK + 1) * BLOCK, len(self.excess))
        while len(todo := todo[at[todo] < end[todo]]):
            hit = self.excess[at[todo]] == value[todo]
            out[todo[hit]] = at[todo[hit]]
            todo = todo[~hit]
            at[todo] += 1
        return out

    def findclose(self, opened: np.ndarray) -> np.ndarray:
        """The places of the parentheses that close those at ``opened``."""
        value = self.excess[opened] - 1
        out = np.full(len(opened), -1)
        inside = (opened + 1) % BLOCK != 0  # else the block ends here
        out[inside] = self._scan(opened[inside] + 1, value[inside])
        todo = np.flatnonzero(out < 0)
        block, level = opened // BLOCK + 1, np.full(len(opened), -1)
        for up in range(len(self.ranges)):
            here = self._holds(up, block[todo], value[todo])
            level[todo[here]] = up
            todo = todo[~here]
            beside = (block[todo] % 2 == 0) & self._holds(up, block[todo] + 1, value[todo])
            block[todo[beside]] += 1
            level[todo[beside]] = up
            todo = todo[~beside]
            block[todo] = block[todo] // 2 + 1
        for down in range(len(self.ranges) - 1, 0, -1):
            at = np.flatnonzero(level == down)
            left = self._holds(down - 1, 2 * block[at], value[at])
            block[at] = 2 * block[at] + ~left
            level[at] = down - 1
        far = np.flatnonzero(level == 0)
        out[far] = self._scan(block[far] * BLOCK, value[far])
        return out


class RangeMin:
    """Smallest value of ranges [first, last], by tables of powers of two."""

    def __init__(self, values: np.ndarray):
        self.tables = [values]
        while 2 << (len(self.tables) - 1) <= len(values):
            t, half = self.tables[-1], 1 << (len(self.tables) - 1)
            self.tables.append(np.minimum(t[:-half], t[half:]))

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        power = np.frexp((last - first + 1).astype(float))[1] - 1
        out = np.empty(len(first), np.int64)
        for p in np.unique(power):
            at = power == p
            out[at] = np.minimum(self.tables[p][first[at]], self.tables[p][last[at] - (1 << p) + 1])
        return out


_SEGMENT = ("shard", "kind", "r1", "r2", "path", "w", "n", "least", "c_leaves", "c_kids", "c_nw", "c_w")
_NODE = (
    "shard int, shared boolean, id1 long, id2 long, p1 long, p2 long, depth long, n long, least long, parent_least long, "
    "kids long, leaves long, nw long, w long"
)
_NOBODY = np.iinfo(np.int64).max


def shard_nodes(rows: pa.Table, first_depth: int) -> pa.RecordBatch:
    """The trie nodes of one shard's sorted rows (see ``_SEGMENT``); kind 0 is the path before, 2 the one behind it."""
    kind = rows["kind"].to_numpy()
    paths = rows["path"].combine_chunks()
    size = pc.list_value_length(paths).to_numpy().astype(np.int64)
    keys = paths.flatten()
    z1, z2 = (np.asarray(keys.field(i)).astype(np.int64) for i in (0, 1))
    words = np.asarray(pc.list_flatten(rows["w"].combine_chunks())).astype(np.int64)
    root = [rows[c].to_numpy() for c in ("r1", "r2")]
    count, start = len(size), np.concatenate([[0], np.cumsum(size)])
    # keys in common with the path before; -1 below another root
    both = np.minimum(size[1:], size[:-1])
    inner = np.arange(both.sum()) - np.repeat(np.cumsum(both) - both, both)
    a, b = np.repeat(start[:-2], both) + inner, np.repeat(start[1:-1], both) + inner
    common = both.copy()
    differ = np.flatnonzero((z1[a] != z1[b]) | (z2[a] != z2[b]))
    np.minimum.at(common, np.repeat(np.arange(count - 1), both)[differ], inner[differ])
    common[(root[0][1:] != root[0][:-1]) | (root[1][1:] != root[1][:-1])] = -1
    common = np.concatenate([[-1], common])
    opens = size - common
    closes = np.append(size[:-1] - common[1:], size[-1] + 1)
    steps = np.repeat(np.tile(np.array([1, -1], np.int8), count), np.stack([opens, closes], axis=1).ravel())
    tree = Parentheses(steps)
    opened = np.flatnonzero(steps > 0)
    nodes = np.arange(len(opened))
    below = (tree.findclose(opened) - opened + 1) // 2  # nodes of the subtree, its top included
    last = nodes + below - 1
    row = np.repeat(np.arange(count), opens)
    level = np.repeat(common + 1, opens) + nodes - np.repeat(np.cumsum(opens) - opens, opens)
    # parent: the node before, or for a path's first new node the latest one a level up
    parent = nodes - 1
    fresh = np.flatnonzero((np.concatenate([[-1], row[:-1]]) != row) & (level > 0))
    by_level = np.lexsort((nodes, level))
    place = level[by_level] * len(nodes) + by_level
    parent[fresh] = by_level[np.searchsorted(place, (level[fresh] - 1) * len(nodes) + fresh) - 1]
    parent[level == 0] = -1
    # ids by running exclusive or
    ids = []
    at = start[row] + level - 1
    for z, r in zip((z1, z2), root, strict=True):
        run = np.concatenate([[0], np.bitwise_xor.accumulate(z)]) if len(z) else np.zeros(1, np.int64)
        ids.append(run[at + 1] ^ run[start[row]] ^ r[row])
    own = np.zeros(len(nodes), np.int64)
    inside = level > 0
    own[inside] = words[at[inside]]

    def below_sum(values: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(values)])
        return run[last + 1] - run[nodes]

    end = np.cumsum(opens) - 1  # a path's last node is new, as no two paths are equal
    real = kind == 1
    weight, carried = np.zeros(len(nodes), np.int64), {}
    weight[end] = np.where(real, rows["n"].to_numpy(), 0)
    deeper = np.zeros(len(nodes), bool)
    deeper[end] = real & np.asarray(pc.is_valid(rows["c_kids"]))
    for c in ("c_leaves", "c_kids", "c_nw", "c_w"):
        carried[c] = np.zeros(len(nodes), np.int64)
        carried[c][end] = np.where(real, pc.fill_null(rows[c], 0).to_numpy(), 0)
    n = below_sum(weight)
    here = n > 0
    counted = here & (kind[row] == 1)  # nodes of the path before are counted by its shard
    pair = (tree.steps[opened + 1] < 0) & counted & ~deeper
    nw = below_sum(n * own + carried["c_nw"])
    w = below_sum(own * counted + carried["c_w"])
    leaves = below_sum(pair + carried["c_leaves"])
    kids = np.bincount(parent[counted & (parent >= 0)], minlength=len(nodes)) + carried["c_kids"]
    least = RangeMin(np.where(real, rows["least"].to_numpy(), _NOBODY))(row, row[last])
    shared = (kind[row] == 0) | (kind[row[last]] == 2)
    out = np.flatnonzero(here)
    up = parent[out]
    top = up < 0
    up = np.maximum(up, 0)
    columns = [
        np.full(len(out), rows["shard"][0].as_py()), shared[out], ids[0][out], ids[1][out], (ids[0][up], top), (ids[1][up], top),
        level[out] + first_depth, n[out], least[out], (least[up], top | shared[up]), kids[out], leaves[out], nw[out], w[out],
    ]
    kinds = {"int": pa.int32(), "boolean": pa.bool_(), "long": pa.int64()}
    fields = [f.split() for f in _NODE.split(", ")]
    arrays = [pa.array(c[0], kinds[t], mask=c[1]) if isinstance(c, tuple) else pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _read_shards(first_depth: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One shard after the other; a shard is a partition of the range sort and its rows arrive together."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            shard = batch.column(0).to_numpy()
            cuts = np.flatnonzero(shard[1:] != shard[:-1]) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(shard)], strict=True):
                if held and lo < hi and held[-1].column(0)[0].as_py() != shard[lo]:
                    yield shard_nodes(pa.Table.from_batches(held), first_depth)
                    held = []
                if lo < hi:
                    held.append(batch.slice(lo, hi - lo))
        if held:
            yield shard_nodes(pa.Table.from_batches(held), first_depth)

    return read


def rebuilt_turns(conversations: DataFrame, group: int = GROUP, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """((conv_id, depth, z1, z2, w) of each rebuilt turn, (conv_id) of all conversations).

    Turns are ordered by turn (null first), then role and text. Conversation c has the first h turns of c - c % group
    (all if fewer) and its own after the first h; h is crc32(c) % most. z1 and z2 are hashes of depth, role and text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", role.alias("role"), text.alias("text"))
    key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    kept = [F.col("conv_id"), key.alias("key"), F.expr(f"regexp_count(text, '{WORD}')").cast("long").alias("w")]
    turns = positions(rows, ["conv_id"], [F.asc_nulls_first("turn"), F.col("role"), F.col("text")], kept, lambda df: saved(df, "turns"))
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most))
    parts = turns.groupBy("conv_id", "part").agg(F.max("rows_of_key").alias("own"))
    convs = parts.groupBy("conv_id").agg(F.max("own").alias("own"))
    base = (F.col("conv_id") - F.pmod("conv_id", F.lit(group))).alias("base")
    convs = saved(convs.select("conv_id", "own", base, head.alias("h")), "convs")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    taken = convs.join(bases, "base", "left").select("conv_id", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken"))
    # by part as well, so that one conversation with most turns is no single task
    parts = parts.select("conv_id", "part").join(taken, "conv_id")
    own = turns.join(parts, ["conv_id", "part"]).where("position > h")
    own = own.select("conv_id", (F.col("position") - F.col("h") + F.col("taken")).alias("depth"), "key", "w")
    first = turns.where((F.col("position") < most) & (F.pmod("conv_id", F.lit(group)) == 0))
    first = first.select(F.col("conv_id").alias("base"), F.col("position").alias("depth"), "key", "w")
    lent = first.join(convs.where("h > 0"), "base").where("depth <= h").select("conv_id", "depth", "key", "w")
    depth = F.col("depth").cast("long")
    marks = [F.xxhash64(F.lit(i), depth, F.col("key")).alias(f"z{i}") for i in (1, 2)]
    return saved(own.unionByName(lent).select("conv_id", depth.alias("depth"), *marks, "w"), "rebuilt"), convs.select("conv_id")


def segments(turns: DataFrame, convs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Distinct chunks of paths: level, root (r1, r2), end (e1, e2), path, w, n (conversations) and least (conv_id)."""
    level = F.floor((F.col("depth") - 1) / chunk).cast("int")
    turn = F.struct("depth", "z1", "z2", "w")
    rows = turns.groupBy("conv_id", level.alias("level")).agg(F.array_sort(F.collect_list(turn)).alias("t"), F.bit_xor("z1").alias("x1"), F.bit_xor("z2").alias("x2"))
    before = Window.partitionBy("conv_id").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    for i in (1, 2):
        rows = rows.withColumn(f"r{i}", F.coalesce(F.bit_xor(f"x{i}").over(before), F.lit(0).cast("long")))
    none = convs.join(turns.select("conv_id").distinct(), "conv_id", "left_anti").select("conv_id", F.lit(0).alias("level"))
    none = none.select("*", *(F.lit(0).cast("long").alias(c) for c in ("x1", "x2", "r1", "r2")))
    rows = rows.unionByName(none, allowMissingColumns=True)
    ends = [F.col(f"r{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"e{i}") for i in (1, 2)]
    path = F.coalesce(F.transform("t", lambda x: F.struct(x["z1"].alias("z1"), x["z2"].alias("z2"))), F.array().cast("array<struct<z1:bigint,z2:bigint>>"))
    w = F.coalesce(F.transform("t", lambda x: x["w"]), F.array().cast("array<bigint>"))
    rows = rows.select("conv_id", "level", "r1", "r2", *ends, path.alias("path"), w.alias("w"))
    return rows.groupBy("level", "r1", "r2", "e1", "e2").agg(
        F.first("path").alias("path"), F.first("w").alias("w"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")
    )


def level_nodes(rows: DataFrame, first_depth: int) -> DataFrame:
    """The nodes of one level, whole: rows are its segments with what deeper levels carry (c_...)."""
    spark = rows.sparkSession
    by = ["r1", "r2", "path"]
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    rows = saved(rows.select(F.spark_partition_id().alias("shard"), F.lit(1).alias("kind"), *_SEGMENT[2:]), "shards")
    at = F.struct(*by, "w")
    ends = rows.groupBy("shard").agg(F.min(at).alias("first"), F.max(at).alias("last"))
    used = sorted(r.shard for r in rows.select("shard").distinct().collect())  # one number per partition
    if len(used) > 1:
        ends = saved(ends, "bounds")
        beside = [(b, a, 0) for a, b in zip(used, used[1:], strict=False)] + [(a, b, 2) for a, b in zip(used, used[1:], strict=False)]
        beside = F.broadcast(spark.createDataFrame(beside, "to int, shard int, kind int"))
        ghosts = ends.join(beside, "shard").withColumn("g", F.when(F.col("kind") == 0, F.col("last")).otherwise(F.col("first")))
        ghosts = ghosts.select(F.col("to").alias("shard"), "kind", *(f"g.{c}" for c in (*by, "w")))
        rows = rows.unionByName(ghosts.select("*", F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("least")), allowMissingColumns=True)
        rows = rows.withColumn("least", F.coalesce("least", F.lit(0).cast("long")))
    dealt = rows.repartition("shard").sortWithinPartitions("shard", "kind", *by).select(*_SEGMENT)
    nodes = saved(dealt.mapInArrow(_read_shards(first_depth), _NODE), "nodes")
    if len(used) < 2:
        return nodes
    sums = [F.sum(c).alias(c) for c in ("n", "kids", "leaves", "nw", "w")]
    spine = nodes.where("shared")
    merged = spine.groupBy("id1", "id2").agg(F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("depth").alias("depth"), F.min("least").alias("least"), *sums)
    merged = saved(merged, "spines")
    up = merged.select(F.col("id1").alias("p1"), F.col("id2").alias("p2"), F.col("least").alias("over"))
    # a parent with many children is looked up shard by shard
    local = spine.select("shard", F.col("id1").alias("p1"), F.col("id2").alias("p2")).join(up, ["p1", "p2"])
    rest = nodes.where("not shared").join(local, ["shard", "p1", "p2"], "left").withColumn("parent_least", F.coalesce("parent_least", "over"))
    merged = merged.join(up, ["p1", "p2"], "left").withColumnRenamed("over", "parent_least")
    names = ["id1", "id2", "p1", "p2", "depth", "n", "least", "parent_least", "kids", "leaves", "nw", "w"]
    return rest.select(*names).unionByName(merged.select(*names))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined conv_ids of each node; rows arrive sorted and only the hash's state is held."""
    node, state = None, None
    for batch in batches:
        id1, id2, conv = (batch.column(i) for i in range(3))
        done = []
        a, b = id1.to_numpy(), id2.to_numpy()
        cuts = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
        texts = conv.cast(pa.string())
        for lo, hi in zip([0, *cuts], [*cuts, len(a)], strict=True):
            if lo == hi:
                continue
            here = (int(a[lo]), int(b[lo]))
            joined = ",".join(texts.slice(lo, hi - lo).to_pylist()).encode()
            if here == node:
                state.update(b"," + joined)
            else:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = here, hashlib.sha256(joined)
        yield _hash_rows(done)
    if node is not None:
        yield _hash_rows([(*node, state.hexdigest())])


def _hash_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["id1", "id2", "ends_sha256"])


def ends_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(id1, id2, ends_sha256): of the conversations that end at a node, the hash of their ids in numerical order.

    The hash is sequential by definition, so a node's ids go through one task; they are sorted by Spark and streamed.
    """
    last = turns.groupBy("conv_id").agg(F.bit_xor("z1").alias("id1"), F.bit_xor("z2").alias("id2"))
    zero = F.lit(0).cast("long")
    rows = convs.join(last, "conv_id", "left").select(F.coalesce("id1", zero).alias("id1"), F.coalesce("id2", zero).alias("id2"), "conv_id")
    return rows.repartition("id1", "id2").sortWithinPartitions("id1", "id2", "conv_id").mapInArrow(_hashed, "id1 long, id2 long, ends_sha256 string")


def prefix_nodes(conversations: DataFrame, group: int = GROUP, most: int = MOST, chunk: int = CHUNK) -> DataFrame:
    """One row per trie node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null role or text is empty; a null turn comes first; rows of one turn are ordered by role and text, and repeated
    rows are turns of their own. Rows with a null conv_id belong to no conversation and are left out. A conversation
    whose turns all fall away still is a member of the root. An empty table gives no rows, not even a root. A very
    long text is only hashed and counted; a conversation of any number of turns is cut into chunks. Other columns,
    of whatever name, are ignored.
    """
    turns, convs = rebuilt_turns(conversations, group, most)
    paths = saved(segments(turns, convs, chunk), "segments")
    deepest = paths.agg(F.max("level")).first()[0]
    nodes, carry = None, None
    for level in range(0 if deepest is None else deepest, -1, -1):
        rows = paths.where(F.col("level") == level)
        if carry is not None:
            rows = rows.join(carry, ["e1", "e2"], "left")
        else:
            rows = rows.select("*", *(F.lit(None).cast("long").alias(c) for c in ("c_leaves", "c_kids", "c_nw", "c_w")))
        found = level_nodes(rows, level * chunk)
        if level:
            found = saved(found, "level")
            root = found.where(F.col("depth") == level * chunk)
            carry = root.select(F.col("id1").alias("e1"), F.col("id2").alias("e2"), *(F.col(c[2:]).alias(c) for c in ("c_leaves", "c_kids", "c_nw", "c_w")))
            found = found.where(F.col("depth") > level * chunk)
        nodes = found.drop("shard", "shared") if nodes is None else nodes.unionByName(found.drop("shard", "shared"))
    if deepest:  # a chunk's first nodes have their parents in the level above
        nodes = saved(nodes, "nodes")
        above = nodes.where(F.col("depth") % chunk == 0).select(F.col("id1").alias("p1"), F.col("id2").alias("p2"), F.col("least").alias("over"))
        nodes = nodes.join(above, ["p1", "p2"], "left").withColumn("parent_least", F.coalesce("over", "parent_least"))
    return nodes.join(ends_of(turns, convs), ["id1", "id2"], "left").select(
        F.col("least").alias("conv_id"), "depth", F.col("parent_least").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), (F.col("nw") - F.col("w")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )
