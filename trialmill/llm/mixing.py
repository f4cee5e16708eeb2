"""Mixing sources to target weights, in blocks of words, with DataFrame operations only.

Each source is one stream of words: its documents in a fixed order, packed into blocks of ``BLOCK_WORDS``. The
mix has a number of slots per source, so that the source reaches its target. For each output shard the
number of slots of each source is drawn: every slot of a source falls to a shard at random, which is the
multinomial draw, given the sources' totals. A source's slots in shard order are mapped through a pseudorandom
permutation of its block numbers (swap-or-not, so that any number of blocks is permuted exactly; a new one for
each pass over the source), and the blocks are joined to documents by block number.

All draws are hashes of a seed, so the same rows give the same mix. A source is spread over tasks by buckets
of documents, by block numbers and by pieces of its slots, so one that holds most rows is no bottleneck.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialmill.llm.store import saved

BLOCK_WORDS, SHARD_SLOTS, ROUNDS, SEED = 128, 4096, 24, 20240229
WEIGHTS = (3, 1, 2)
#: Words of the mix per word of all sources, and how often a source may be used.
SHARE, MOST_PASSES = 1.5, 2.0
BUCKET_ROWS = 4096
#: Shards whose permutations one task computes.
SHARDS_PER_TASK = 16
WORD = r"[^\\x20\\x09-\\x0D]+"


def with_sizes(docs: DataFrame, *columns: str) -> DataFrame:
    """Rows with a number of their own, their source's key and their words; written down, so that the number holds."""
    key = F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), F.col("source")))
    size = F.expr(f"coalesce(regexp_count(text, '{WORD}'), 0)").cast("long")
    rows = docs.select(*columns, "doc_id", key.alias("s"), "source", size.alias("size"))
    return saved(rows.withColumn("row", F.monotonically_increasing_id()), "sizes")


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: float = MOST_PASSES) -> DataFrame:
    """Per source: s, source_size, target, blocks and slots.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` times all words; a target
    stops at ``passes`` times its source, what is too much is shared by weight among the others. Sources sorted
    by the level at which they stop give that level in closed form from running sums.
    """
    by = rows.groupBy("s").agg(F.sum("size").alias("source_size"))
    every = F.array(*(F.lit(float(w)) for w in weights))
    by = by.withColumn("weight", F.element_at(every, (F.row_number().over(Window.orderBy("s")) - 1) % len(weights) + 1))
    by = by.withColumn("stop", passes * F.col("source_size"))
    before = Window.orderBy(F.col("stop") / F.col("weight"), "s").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    spent, used = (F.coalesce(F.sum(c).over(before), F.lit(0.0)) for c in ("stop", "weight"))
    level = (share * F.sum("source_size").over(everything) - spent) / (F.sum("weight").over(everything) - used)
    by = by.withColumn("level", level)
    open_ = F.when(F.col("level") * F.col("weight") <= F.col("stop"), F.struct(F.col("stop") / F.col("weight"), "s"))
    level = F.min_by("level", open_).over(everything)  # of the first source that does not stop
    by = by.withColumn("target", F.coalesce(F.least("stop", level * F.col("weight")), F.col("stop")))
    blocks = F.ceil(F.col("source_size") / BLOCK_WORDS)
    slots = F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * blocks)).otherwise(0)
    return by.select("s", "source_size", "target", blocks.cast("long").alias("blocks"), slots.cast("long").alias("slots"))


def permuted(index: Column, size: Column, *keys: Column) -> Column:
    """A pseudorandom permutation of 0 .. size-1 for each key: swap or not, by a hash, with a reflected partner."""

    def partner(x: Column, k: Column) -> Column:
        return (F.pmod(F.xxhash64(F.lit(SEED), *keys, k), size) + size - x) % size

    def turn(x: Column, k: Column) -> Column:
        y = partner(x, k)
        return F.when(F.xxhash64(F.lit(SEED + 1), *keys, k, F.greatest(x, y)).bitwiseAND(F.lit(1)) == 0, x).otherwise(y)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), index, turn)


def draw(by_source: DataFrame) -> DataFrame:
    """Slots of the mix: s, shard, pass, block."""
    shards = by_source.agg(F.sum("slots")).first()[0] or 0
    shards = 1 + shards // SHARD_SLOTS
    pieces = by_source.where("slots > 0").select("s", "slots", F.explode(F.expr(f"sequence(0, (slots - 1) div {SHARD_SLOTS})")).alias("piece"))
    first = F.col("piece") * SHARD_SLOTS
    last = F.least(first + SHARD_SLOTS, F.col("slots")) - 1
    single = pieces.repartition("s", "piece").select("s", F.explode(F.sequence(first, last)).alias("slot"))
    shard = F.pmod(F.xxhash64(F.lit(SEED + 2), "s", "slot"), F.lit(shards))
    counts = single.groupBy("s", shard.alias("shard")).agg(F.count(F.lit(1)).alias("drawn"))
    before = Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("start", F.coalesce(F.sum("drawn").over(before), F.lit(0).cast("long")))
    counts = counts.join(by_source.select("s", "blocks"), "s").repartition(1 + shards // SHARDS_PER_TASK, "s", "shard")
    ranks = counts.select("s", "shard", "blocks", F.explode(F.expr("sequence(start, start + drawn - 1)")).alias("rank"))
    ranks = ranks.withColumn("pass", F.expr("rank div blocks")).withColumn("index", F.col("rank") % F.col("blocks"))
    return ranks.select("s", "shard", "pass", permuted(F.col("index"), F.col("blocks"), F.col("s"), F.col("pass")).alias("block"))


def blocks_of(rows: DataFrame) -> DataFrame:
    """Pieces of documents by block: row, s, block, start (word of the document), words."""
    buckets = 1 + rows.count() // BUCKET_ROWS
    rows = rows.where("size > 0").withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    order = Window.partitionBy("s", "bucket").orderBy("doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.select("row", "s", "bucket", "size", F.coalesce(F.sum("size").over(order), F.lit(0).cast("long")).alias("inside"))
    sums = rows.groupBy("s", "bucket").agg(F.sum("size").alias("total"))
    before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("s", "bucket", F.coalesce(F.sum("total").over(before), F.lit(0).cast("long")).alias("before"))
    placed = inside.join(sums, ["s", "bucket"]).select("row", "s", "size", (F.col("before") + F.col("inside")).alias("at"))
    n = BLOCK_WORDS
    placed = placed.select("*", F.explode(F.expr(f"sequence(at div {n}, (at + size - 1) div {n})")).alias("block"))
    start = F.greatest(F.col("at"), F.col("block") * n)
    end = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * n)
    return placed.select("row", "s", "block", (start - F.col("at")).alias("start"), (end - start).alias("words"))


def pieces_of(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Pieces of documents in the slots of the mix: s, block, row, start, words, shard, pass.

    Spark takes the slots for as small as the counts that they are made of and would gather all of them in the driver to
    broadcast them, so the kind of join is named.
    """
    return blocks_of(rows).join(draw(sources).hint("merge"), ["s", "block"])


def mix(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, sources, pieces): pieces has a line for each part of a document in each slot of the mix.

    pieces: shard, pass, s, block, row, start, words. A null text has no words; a null source is a source of its own, the last;
    rows that repeat are documents of their own; an empty table gives empty tables.
    """
    rows = with_sizes(docs)
    sources = saved(targets(rows), "sources")
    return rows, sources, pieces_of(rows, sources)


def words_taken(docs: DataFrame) -> DataFrame:
    """Each document with its size, its source's size and target, and the words that the mix takes of it."""
    rows, sources, pieces = mix(docs)
    taken = pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    found = rows.join(taken, "row", "left").join(sources.select("s", "source_size", "target"), "s")
    return found.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents with the columns of ``docs``: a row for each pass in which it takes words of a document.

    The text is what the mix takes, in order and with the white space before each word, the whole text where it
    takes all; ``n_chars``, if there, follows the text.
    """
    names = docs.columns
    kept = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    rows = with_sizes(docs.select("doc_id", "source", "text", *kept), "text", *(f"c{i}" for i in range(len(names))))
    plain = rows.select("row", "doc_id", "s", "size")
    sources = saved(targets(plain), "sources")
    parts = pieces_of(plain, sources).groupBy("row", "pass").agg(F.sort_array(F.collect_list(F.struct("start", "words"))).alias("parts"), F.sum("words").alias("taken"))
    found = rows.join(parts, "row")
    lead = F.expr(r"regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+', 0)")
    found = found.withColumn("spaced", F.when(F.col("taken") < F.col("size"), lead))
    cut = F.expr("array_join(flatten(transform(parts, p -> slice(spaced, cast(p.start + 1 as int), cast(p.words as int)))), '')")
    found = found.withColumn("mixed", F.when(F.col("taken") < F.col("size"), cut).otherwise(F.col("text")))
    values = {"text": F.col("mixed"), "n_chars": F.char_length("mixed").cast("long")}
    return found.select(*(values.get(c, F.col(f"c{i}")).alias(c) for i, c in enumerate(names)))
