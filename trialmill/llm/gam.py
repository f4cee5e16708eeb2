"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are cut into bins. Shallow trees on one feature at a time, boosted in a cycle over the
features, add up to one lookup table per feature; the pairs that explain most of what is left get a table of
two features each. A score is the logistic function of a sum of table entries, so scoring is a few array
look-ups per document. Labels, language, source and id are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmill.llm.compression import repeated_lines, repeated_words
from trialmill.llm.words import Words, slices

#: Most labelled rows that are learnt from; beyond it, those with the smallest hash of their id.
LABELLED_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
CYCLES, PAIR_CYCLES, RATE, SMALLEST_LEAF = 120, 60, 0.15, 5.0
THRESHOLD = 0.3

FEATURES = (
    "log_words", "word_length", "symbols", "digits", "upper_case", "stops", "exclamations", "bars",
    "repeated_words", "distinct_words", "equal_neighbours", "repeated_lines", "words_per_line", "plain_ends", "other_bytes",
)


def features(w: Words) -> np.ndarray:
    """One row per text. ``w`` holds the texts as they are; an empty text has zeros."""
    raw, n = w.raw, np.maximum(w.count, 1).astype(float)
    solid = np.maximum(w.per_text(w.solid), 1).astype(float)
    table = np.zeros((256, 6), bool)
    for i, chars in enumerate((b"#*$%&<>@^~_=+{}[]\\/", b"0123456789", bytes(range(65, 91)), b".,;:", b"!?", b"|")):
        table[list(chars), i] = True
    shares = [w.per_text(table[raw, i]) / solid for i in range(6)]
    code_points = w.per_text(((raw & 0xC0) != 0x80) & w.solid)
    order = np.lexsort((w.hash, w.doc))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (w.hash[order][1:] != w.hash[order][:-1]) | (w.doc[order][1:] != w.doc[order][:-1])
    distinct = np.bincount(w.doc[order][fresh], minlength=w.n)
    equal = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    last = raw[w.end - 1] if len(w.end) else np.zeros(0, np.uint8)
    plain = ((last >= 97) & (last <= 122)) | (last >= 128) | (last == 46) | (last == 44)
    lines = w.per_text(raw == 10) + 1
    columns = [
        np.log1p(w.count), code_points / n, *shares, repeated_words(w) / n, distinct / n,
        np.bincount(w.doc[1:][equal], minlength=w.n) / n, repeated_lines(w) / lines, np.log1p(w.count / lines),
        np.bincount(w.doc[plain], minlength=w.n) / n, w.per_text(raw >= 128) / solid,
    ]
    return np.stack(columns, 1).astype(float)


@dataclass
class Model:
    base: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for i, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, x[:, i], side="right")]
        small = {i: np.searchsorted(self.pair_cuts[i], x[:, i], side="right") for pair in self.pairs for i in pair[:2]}
        for i, j, table in self.pairs:
            total += table[small[i], small[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _gain(g, h):
    return g * g / (h + 1.0)


def _best_cut(g: np.ndarray, h: np.ndarray) -> int:
    """Where to cut a run of bins in two, or 0."""
    if len(g) < 2:
        return 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = _gain(left_g, left_h) + _gain(right_g, right_h) - _gain(g.sum(), h.sum())
    gain[(left_h < SMALLEST_LEAF * 0.05) | (right_h < SMALLEST_LEAF * 0.05)] = 0
    at = int(np.argmax(gain))
    return at + 1 if gain[at] > 1e-9 else 0


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values by bin of a tree of depth two on one feature."""
    middle = _best_cut(g, h)
    edges = sorted({0, middle, _best_cut(g[:middle], h[:middle]), middle + _best_cut(g[middle:], h[middle:]), len(g)})
    out = np.zeros(len(g))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1.0)
    return out


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best pair of cuts, one on each feature."""
    sg, sh = (np.pad(np.cumsum(np.cumsum(v, 0), 1), ((1, 0), (1, 0))) for v in (g, h))
    best, where = -1.0, (0, 0)
    for i in range(1, g.shape[0]):
        for j in range(1, g.shape[1]):
            gain = sum(
                _gain(sg[b, d] - sg[a, d] - sg[b, c] + sg[a, c], sh[b, d] - sh[a, d] - sh[b, c] + sh[a, c])
                for a, b in ((0, i), (i, -1)) for c, d in ((0, j), (j, -1))
            )
            if gain > best:
                best, where = gain, (i, j)
    out = np.zeros_like(g)
    i, j = where
    for rows in (slice(None, i), slice(i, None)):
        for cols in (slice(None, j), slice(j, None)):
            out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + 1.0)
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Learn from rows of features and labels 0 or 1. Without rows every score is one half; of one label, near it."""
    model = Model()
    if not len(y):
        return model
    rate = (y.sum() + 0.5) / (len(y) + 1)
    model.base = float(np.log(rate / (1 - rate)))
    model.cuts = [_cuts(x[:, i], BINS) for i in range(x.shape[1])]
    bins = [np.searchsorted(c, x[:, i], side="right") for i, c in enumerate(model.cuts)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    total = np.full(len(y), model.base)
    for _ in range(CYCLES):
        for i, b in enumerate(bins):
            p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            size = len(model.tables[i])
            step = RATE * np.clip(_tree(np.bincount(b, y - p, size), np.bincount(b, p * (1 - p), size)), -4, 4)
            model.tables[i] += step
            total += step[b]
    model.pair_cuts = [_cuts(x[:, i], PAIR_BINS) for i in range(x.shape[1])]
    small = [np.searchsorted(c, x[:, i], side="right") for i, c in enumerate(model.pair_cuts)]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        shape = len(model.pair_cuts[i]) + 1, len(model.pair_cuts[j]) + 1
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        at = small[i] * shape[1] + small[j]
        return tuple(np.bincount(at, v, shape[0] * shape[1]).reshape(shape) for v in (y - p, p * (1 - p)))

    usable = [i for i, c in enumerate(model.pair_cuts) if len(c)]
    ranked = sorted(combinations(usable, 2), key=lambda ij: -_quarters(*grid(*ij))[0])[:PAIRS]
    tables = {ij: np.zeros((len(model.pair_cuts[ij[0]]) + 1, len(model.pair_cuts[ij[1]]) + 1)) for ij in ranked}
    for _ in range(PAIR_CYCLES):
        for (i, j), table in tables.items():
            step = RATE * np.clip(_quarters(*grid(i, j))[1], -4, 4)
            table += step
            total += step[small[i], small[j]]
    model.pairs = [(i, j, t) for (i, j), t in tables.items()]
    return model


def _map(position: int, make):
    """Batches with the columns but that at ``position``, and those that ``make`` gives of the texts there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(position)):
                part = batch.slice(lo, hi - lo)
                new = make(features(Words(part.column(position), lower=False)))
                kept = {n: c for i, (n, c) in enumerate(zip(part.schema.names, part.columns, strict=True)) if i != position}
                yield pa.RecordBatch.from_pydict(kept | new)

    return run


def _schema(plain: DataFrame, added: list[str]) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields] + [f"{n} double" for n in added])


def training_rows(docs: DataFrame, labels: DataFrame, most: int = LABELLED_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Features and quality of at most ``most`` labelled documents outside the held-out fifth; repeated rows of an id count once."""
    chosen = (
        labels.where("doc_id is not null and quality is not null").where(~held_out())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")
    names = [f"f{i}" for i in range(len(FEATURES))]
    make = _map(2, lambda x: {n: pa.array(x[:, i]) for i, n in enumerate(names)})
    found = rows.mapInArrow(make, _schema(rows.drop("text"), names))
    found = found.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min(F.struct(*names)).alias("f"))
    found = found.select("quality", "f.*").toPandas().sort_values(["quality", *names])
    return found[names].to_numpy(float), found["quality"].to_numpy(float)


def held_out():
    """Whether crc32 of the id as text leaves no remainder by 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each row's whole text.

    A null text counts as empty. Null labels are not learnt from; of several labels of a document the lowest
    counts. Repeated rows are scored each; an empty table gives no rows; other columns are left out.
    """
    model = fit(*training_rows(docs, labels))
    schema = _schema(docs.select("doc_id"), ["score"])
    scored = docs.select("doc_id", "text").mapInArrow(_map(1, lambda x: {"score": pa.array(model.score(x))}), schema)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted to be good, with all their columns; scored in the row, without a shuffle."""
    model = fit(*training_rows(docs, labels))
    names = docs.columns
    plain = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)), F.col("text").alias("whole text"))
    judged = plain.mapInArrow(_map(len(names), lambda x: {"score": pa.array(model.score(x))}), _schema(plain.drop("whole text"), ["score"]))
    return judged.where(F.col("score") >= THRESHOLD).select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)))
