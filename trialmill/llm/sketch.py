"""Document fingerprints: bottom-k sketches of shingle hashes, with DataFrame operations only.

A sketch is the sorted array of the k smallest hashes of a text's distinct five-word shingles (of lower-cased
words; with fewer words the whole sequence is one shingle). Sketches of parts merge into that of the whole, and
two sketches estimate resemblance, containment and the number of distinct shingles; below k shingles exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, BITS, SHINGLE = 128, 48, 5
#: A table of this many ids or fewer (16 bytes each) is sent to all tasks, a longer one is joined.
BROADCAST_ROWS = 500_000
BUCKET_BITS, LEVEL_BITS = 8, 18


def with_sketch(df: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """``df`` with the sketch of column ``text`` (null: empty, an empty array)."""
    mask = (1 << BITS) - 1
    spread = ", ".join(f"__words[i + {j}]" for j in range(SHINGLE))
    return (
        df.withColumn("__words", F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
        .withColumn(
            "__hashes",
            F.expr(
                f"case when size(__words) >= {SHINGLE} then transform(sequence(0, size(__words) - {SHINGLE}), i -> xxhash64({spread}) & {mask}L) "
                f"when size(__words) > 0 then array(xxhash64(array_join(__words, ' '), size(__words)) & {mask}L) else cast(array() as array<bigint>) end"
            ),
        )
        .withColumn(name, F.slice(F.sort_array(F.array_distinct("__hashes")), 1, k))
        .drop("__words", "__hashes")
    )


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_by(df: DataFrame, keys: list[str], sketch: str, k: int = K) -> DataFrame:
    """One sketch per group: keys and ``sketch``. Groups are ranked in 64 parts first, so that a large one is spread."""
    rows = df.select(*keys, F.explode(sketch).alias("hash")).distinct()
    for part in (["part"], []):
        rank = F.row_number().over(Window.partitionBy(*keys, *part).orderBy("hash"))
        rows = rows.withColumn("part", F.pmod("hash", F.lit(64))).withColumn("rank", rank).where(F.col("rank") <= k)
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_list("hash")).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity; 1 of two empty sketches."""
    low = merged(a, b, k)
    both = F.size(F.array_intersect(low, F.array_intersect(a, b)))
    return F.when(F.size(low) == 0, 1.0).otherwise(both / F.size(low))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * F.lit(float(1 << BITS)) / F.element_at(a, k))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first text's shingles that the second has; 1 if the first has none."""
    share = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k) / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(share, F.lit(1.0)))


def as_text(sketch: Column) -> Column:
    """A sketch as a string: its hashes in hexadecimal, 12 digits each."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), BITS // 4, "0")), "")


def following(keys: DataFrame, depth: int = 3) -> DataFrame:
    """(key, next): each distinct long and the next greater one, null for the last.

    Keys are compared within runs of 2**18 values, then the runs' first keys are, so no window is long.
    """
    if depth == 0:
        return keys.select("key", F.lead("key").over(Window.orderBy("key")).alias("next"))
    run = F.shiftright("key", LEVEL_BITS)
    inside = keys.select("key", run.alias("run"), F.lead("key").over(Window.partitionBy(run).orderBy("key")).alias("inside"))
    firsts = keys.groupBy(run.alias("run")).agg(F.min("key").alias("first"))
    after = following(firsts.select(F.col("run").alias("key")), depth - 1)
    after = after.join(firsts.select(F.col("run").alias("next"), "first"), "next").select(F.col("key").alias("run"), "first")
    return inside.join(after, "run", "left").select("key", F.coalesce("inside", "first").alias("next"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, sketch, next_text, next_sketch of each row; next by doc_id, then text (null ids first; after the last the first).

    Rows are dealt by ranges of ids. Each range also gets a copy of the first row of the next one.
    """
    bucket = F.coalesce(F.shiftright("doc_id", BUCKET_BITS), F.lit(-(1 << 62)))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), bucket.alias("bucket"))
    firsts = rows.groupBy("bucket").agg(F.min("doc_id").alias("first"))
    order = following(firsts.select(F.col("bucket").alias("key")))
    # after the last range comes the first: one row joined with one row
    least = order.groupBy(F.lit(1).alias("one")).agg(F.min("key").alias("next"))
    last = order.where("next is null").withColumn("one", F.lit(1)).select("key", "one").join(least, "one").select("key", "next")
    order = order.where("next is not null").unionByName(last)
    order = order.join(firsts.select(F.col("bucket").alias("next"), "first"), "next").select("next", "first", F.col("key").alias("target"))
    if order.count() <= BROADCAST_ROWS:
        order = F.broadcast(order)
    copies = rows.join(order, (rows["bucket"] == order["next"]) & rows["doc_id"].eqNullSafe(order["first"]))
    copies = copies.select("doc_id", "text", F.col("target").alias("bucket"), F.lit(1).alias("copy"))
    every = with_sketch(rows.withColumn("copy", F.lit(0)).unionByName(copies), "text", "sketch")
    here = Window.partitionBy("bucket").orderBy("copy", "doc_id", "text")
    every = every.select("doc_id", "text", "sketch", "copy", F.lead("text").over(here).alias("next_text"), F.lead("sketch").over(here).alias("next_sketch"))
    return every.where("copy = 0").drop("copy")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each row's whole text and of its edited text, with their likeness.

    The edited text ends, in place of its last quarter of code points, with the first as many of the next
    document. A null text counts as empty; repeated rows follow one another; one document follows itself; an
    empty table gives no rows; other columns are left out.
    """
    rows = with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    edited = F.expr("concat(left(text, cast(n_chars - n_chars div 4 as int)), left(next_text, cast(n_chars div 4 as int)))")
    rows = with_sketch(rows.withColumn("edited", edited), "edited", "edited_sketch")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        distinct_shingles(F.col("sketch")).alias("distinct_shingles"),
    )
