"""Chat formatting by quotation linking, with DataFrame operations only.

Lines that start with '>' are quoted, once per '>'. A run of lines of one level is a passage; its lines are joined,
normalised (words of letters and digits, lower case) and hashed: the passage as a whole, and its runs of ``RUN`` words,
so that line breaks do not matter and a part of a message is found too. Lines of fewer words are runs of their own,
so is a passage of fewer words. Each hash is joined to the nearest earlier message of its conversation that says the
same unquoted; the source of a passage is the message that is equal to it as a whole, else the one with most of its
words. A message replies to the source of its longest passage of level one. Conversations are then put in reply
order: threads by their first message, and within one the messages by turn; quotes are taken out of the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialmill.llm.store import saved

QUOTE = r"^\s*((?:>[ \t]*)+)"
WORD = r"[\p{L}\p{N}\p{M}]+"
#: Words of a run by which parts of a passage are found.
RUN = 5
#: Parts into which the messages of a conversation are dealt for a join, and turns that are counted together.
SALTS, BLOCK_BITS = 32, 10


def quote_level(line: Column) -> Column:
    """How often a line is quoted."""
    return F.length(F.regexp_replace(F.regexp_extract(line, QUOTE, 1), "[^>]", ""))


def without_quotes(text: Column) -> Column:
    """The lines that are not quoted, without empty lines at either end; null stays null."""
    lines = F.filter(F.split(text, "\r?\n"), lambda x: quote_level(x) == 0)
    return F.regexp_replace(F.array_join(lines, "\n"), r"\A(?:[ \t]*\n)+|(?:\n[ \t]*)+\z", "")


def passages(messages: DataFrame, *keep: str) -> DataFrame:
    """conv_id, turn, row, passage (first line), level, parts (words of each line) and words of every run of lines
    of one level that has a word, of messages with a place, and the columns to keep; ``row`` tells rows that repeat
    a turn apart."""
    lines = F.split("text", "\r?\n")
    rows = messages.where("conv_id is not null and turn is not null and text is not null").select(
        "conv_id", "turn", *keep, F.xxhash64("text").alias("row"), lines.alias("lines"), F.transform(lines, quote_level).alias("levels")
    )
    new = F.filter(F.sequence(F.lit(0), F.size("levels") - 1), lambda i: (i == 0) | (F.get("levels", i) != F.get("levels", i - 1)))
    rows = rows.withColumn("starts", new)

    def passage(start: Column, nth: Column) -> Column:
        end = F.coalesce(F.get("starts", nth + 1), F.size("lines"))
        return F.struct(start.alias("passage"), F.get("levels", start).alias("level"), F.slice("lines", start + 1, end - start).alias("said"))

    found = rows.select("conv_id", "turn", *keep, "row", F.inline(F.transform("starts", passage)))
    parts = F.transform("said", lambda x: F.regexp_extract_all(F.lower(F.regexp_replace(x, QUOTE, "")), F.lit(WORD), 0))
    found = found.select("conv_id", "turn", *keep, "row", "passage", "level", parts.alias("parts"))
    return found.withColumn("words", F.flatten("parts")).where(F.size("words") > 0)


def _run(size: Column, words: Column) -> Column:
    return F.struct(size.cast("int").alias("n"), F.xxhash64(words).alias("hash"))


def _runs(words: Column, size: Column) -> Column:
    """Every run of ``size`` words, at most RUN; none where there are fewer. The hash is that of the array of its words."""

    def run(i: Column) -> Column:
        return F.struct(size.cast("int").alias("n"), F.xxhash64(*(F.when(size > j, F.get(words, i + j)) for j in range(RUN))).alias("hash"))

    return F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - size, F.lit(0))), run))


def quoted_passages(messages: DataFrame) -> DataFrame:
    """conv_id, turn, row, passage (first line), level, words and source (turn of the original, or null) of each passage.

    Originals give runs of those lengths only that a quote of their conversation has. Originals and quotes of a run
    meet in one sorted pass, so a run that is said a thousand times gives each quote one source and no more.
    """
    words, n = F.col("words"), F.size("words")
    whole = _run(F.lit(0), words)
    short = F.filter("parts", lambda x: (F.size(x) > 0) & (F.size(x) < RUN) & (F.size(x) < n))
    runs = F.concat(
        F.coalesce(_runs(words, F.lit(RUN)), F.array(_run(n, words))),
        F.transform(short, lambda x: _run(F.size(x), x)), F.array(whole),
    )
    quotes = passages(messages.where(F.contains("text", F.lit(">")))).where("level > 0")
    quotes = quotes.select("conv_id", "turn", "row", "passage", "level", n.alias("length"), runs.alias("runs"))
    quotes = saved(quotes.select("conv_id", "turn", "row", "passage", "level", F.col("length").alias("words"), F.inline("runs")), "quotes")
    sizes = quotes.groupBy("conv_id").agg(F.collect_set("n").alias("sizes"))  # at most RUN + 1 numbers
    # a conversation's messages are dealt to SALTS parts, so that a long one is not joined in one task
    sizes = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = messages.select("conv_id", "turn", "text", F.pmod(F.xxhash64("turn", "text"), F.lit(SALTS)).cast("int").alias("salt"))
    said = passages(salted.join(sizes, ["conv_id", "salt"]), "sizes").where("level = 0")
    none = F.array().cast("array<struct<n:int,hash:bigint>>")
    of_size = F.transform("sizes", lambda k: F.when(k == 0, F.array(whole)).otherwise(F.coalesce(_runs(words, k), none)))
    said = said.select("conv_id", "turn", F.inline(F.flatten(of_size))).withColumn("said", F.col("turn"))
    both = quotes.unionByName(said, allowMissingColumns=True)
    same = Window.partitionBy("conv_id", "n", "hash").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    both = both.withColumn("source", F.max("said").over(same)).where("said is null")
    key = ["conv_id", "turn", "row", "passage", "level", "words"]
    both = both.dropDuplicates([*key, "n", "hash"])  # no shuffle: dealt by conversation and run already
    found = both.groupBy(*key, "source").agg(F.max(F.col("n") == 0).alias("equal"), F.sum("n").alias("n"))
    best = F.max_by("source", F.struct(F.col("source").isNotNull(), "equal", "n", "source"))
    return found.groupBy(*key).agg(best.alias("source"))


def threads(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, thread, depth) of messages that reply: pointers are doubled until all reach a first message."""
    now = saved(replies.select("conv_id", "turn", "reply_to", F.col("reply_to").alias("thread"), F.lit(1).cast("long").alias("depth")), "replies")
    while True:
        up = now.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("above"), F.col("depth").alias("more"))
        now = saved(
            now.join(up, ["conv_id", "thread"], "left").select(
                "conv_id", "turn", "reply_to", F.coalesce("above", "thread").alias("thread"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("above").isNotNull().alias("moved"),
            ),
            "replies",
        )
        if now.where("moved").isEmpty():
            return now.drop("moved")


def positioned(rows: DataFrame) -> DataFrame:
    """The rows with their position in the conversation, by thread and turn.

    Rows are counted by blocks of turns and of threads, so that no task orders a whole conversation or thread.
    """
    rows = rows.withColumn("block", F.shiftright(F.col("turn").cast("long"), BLOCK_BITS))
    order = Window.partitionBy("conv_id", "thread", "block").orderBy("turn", "role", F.xxhash64("text"))
    rows = rows.withColumn("inside", F.row_number().over(order))
    group = F.shiftright(F.col("thread").cast("long"), BLOCK_BITS).alias("group")
    cells = rows.groupBy("conv_id", "thread", "block").agg(F.count(F.lit(1)).alias("n")).select("*", group)
    groups = cells.groupBy("conv_id", "group").agg(F.sum("n").alias("n"))

    def earlier(keys: list[str], *order: str) -> Column:
        rows_before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(rows_before), F.lit(0))

    groups = groups.select("conv_id", "group", earlier(["conv_id"], "group").alias("ahead"))
    cells = cells.withColumn("before", earlier(["conv_id", "group"], "thread", "block")).drop("n").join(groups, ["conv_id", "group"])
    rows = rows.join(cells.drop("group"), ["conv_id", "thread", "block"])
    return rows.withColumn("position", F.col("ahead") + F.col("before") + F.col("inside")).drop("block", "inside", "before", "ahead")


def linked_conversations(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without quotes, quote_levels, passages, linked, reply_to, thread, depth, position of each row.

    position counts the rows of a conversation in reply order from 1. Null texts stay null; a row without
    conv_id or turn is cleaned but neither linked nor placed; rows that repeat a turn share its links and
    stand together; an empty table gives no rows; other columns are left out.
    """
    found = saved(quoted_passages(messages), "passages")
    about = found.groupBy("conv_id", "turn").agg(
        F.max("level").alias("quote_levels"),
        F.count(F.lit(1)).alias("passages"),
        F.count("source").alias("linked"),
        F.max_by("source", F.when((F.col("level") == 1) & F.col("source").isNotNull(), F.struct("words", "source"))).alias("reply_to"),
    )
    about = saved(about, "about")
    replies = threads(about.where("reply_to is not null"))
    place = about.join(replies.select("conv_id", "turn", "thread", "depth"), ["conv_id", "turn"], "left")
    found = messages.select("conv_id", "turn", "role", "text").join(place, ["conv_id", "turn"], "left")
    found = found.withColumn("thread", F.coalesce("thread", "turn")).withColumn("depth", F.coalesce("depth", F.lit(0)))
    placed = positioned(found.where("conv_id is not null and turn is not null"))
    lost = found.where("conv_id is null or turn is null").withColumn("position", F.lit(None).cast("long"))
    columns = [
        "conv_id", "turn", "role", without_quotes(F.col("text")).alias("text"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("quote_levels", "passages", "linked")),
        F.col("reply_to").cast("long").alias("reply_to"), F.col("thread").cast("long").alias("thread"), F.col("depth").cast("long").alias("depth"), "position",
    ]
    return placed.select(*columns).unionByName(lost.select(*columns))
