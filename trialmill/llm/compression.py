"""Quality rules by compression bands: zstandard ratios of whole documents and of fixed chunks.

A ratio is compressed size by size in UTF-8 bytes. Repetitive text compresses far below ordinary prose,
incompressible text (encoded data, noise) far above. What is ordinary depends on the length, because a short
text has little to refer back to; each length class has limits of its own. The last chunk may be shorter and has
the limits of its own length, so every byte of a text longer than a chunk is tested.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmill.llm.words import Words, slices

Bands = tuple[tuple[int, float, float], ...]

LEVEL = 3
CHUNK_BYTES = 4096
#: (from this many bytes on, ratios below reject, ratios above reject), wide enough for any writing
BANDS = ((0, 0.0, 10.0), (64, 0.25, 1.25), (256, 0.22, 0.95), (1024, 0.20, 0.75), (4096, 0.18, 0.72), (65536, 0.16, 0.70))
#: Limits of running text as the given corpus has it, a class for every power of two: the low limit lies below the least
#: ratio of 2641 labelled good documents outside the held-out fifth (from 256 bytes on by 0.02 at most), the high limit about a
#: fifth above their greatest.
#: Beyond 32 KB, where labels are few, the limits go on evenly. Lists of made-up words may fall below them.
TEXT_BANDS = (
    (0, 0.0, 10.0), (64, 0.70, 1.35), (128, 0.60, 1.10), (256, 0.57, 0.89), (512, 0.50, 0.82), (1024, 0.465, 0.70),
    (2048, 0.445, 0.63), (4096, 0.42, 0.57), (8192, 0.405, 0.54), (16384, 0.395, 0.52), (32768, 0.38, 0.52), (65536, 0.36, 0.52),
)
#: Share of a document's bytes whose chunks may lie outside the limits of their length.
CHUNKS_OUTSIDE = 0.25

SYMBOLS = b"#*$%&|<>"
FEATURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_bytes long, "
    "ratio double, chunks long, chunks_low long, chunks_high long, band_verdict string"
)


def limits(n_bytes: int, bands: Bands = BANDS) -> tuple[float, float]:
    """Least and greatest ordinary ratio of a text of so many bytes."""
    return next((low, high) for start, low, high in reversed(bands) if n_bytes >= start)


def compression(data: bytes, engine: zstandard.ZstdCompressor, bands: Bands = BANDS) -> tuple[float | None, int, int, int, str]:
    """Whole ratio, chunks, chunks below and above their limits, and the verdict; an empty text is 'ok'.

    A text no longer than a chunk has no chunks. The verdict weighs chunks by their bytes.
    """
    if not data:
        return None, 0, 0, 0, "ok"
    ratio = len(engine.compress(data)) / len(data)
    low, high = limits(len(data), bands)
    starts = range(0, len(data), CHUNK_BYTES) if len(data) > CHUNK_BYTES else ()
    below = above = bytes_below = bytes_above = 0
    for at in starts:
        chunk = data[at : at + CHUNK_BYTES]
        part = len(engine.compress(chunk)) / len(chunk)
        least, most = limits(len(chunk), bands)
        below += part < least
        above += part > most
        bytes_below += len(chunk) * (part < least)
        bytes_above += len(chunk) * (part > most)
    if ratio < low or bytes_below > CHUNKS_OUTSIDE * len(data):
        verdict = "repetitive"
    elif ratio > high or bytes_above > CHUNKS_OUTSIDE * len(data):
        verdict = "incompressible"
    else:
        verdict = "ok"
    return ratio, len(starts), below, above, verdict


def _inside(words: Words, flags: np.ndarray) -> np.ndarray:
    """How many of the flagged bytes lie in words, by text."""
    return words.per_text(flags & words.solid)


def repeated_lines(words: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text, by text."""
    breaks = np.flatnonzero(words.raw == 10)
    start = np.unique(np.concatenate([words.offsets[:-1], breaks + 1]))
    start = start[start < len(words.raw)]
    if not len(start):
        return np.zeros(words.n, np.int64)
    owner = np.searchsorted(words.offsets[1:], start, side="right")
    end = np.minimum(np.append(start[1:], len(words.raw)), words.offsets[1:][owner])
    end -= (end > start) & (words.raw[np.maximum(end - 1, 0)] == 10)
    solid = np.concatenate([[0], np.cumsum(words.solid)])
    full = solid[end] > solid[start]
    owner, line = owner[full], words.span_hash(start[full], end[full])
    order = np.lexsort((line, owner))
    owner, line = owner[order], line[order]
    again = (owner[1:] == owner[:-1]) & (line[1:] == line[:-1])
    return np.bincount(owner[1:][again], minlength=words.n)


def repeated_words(words: Words) -> np.ndarray:
    """Words inside five-word windows that occur twice or more in their text, by text."""
    at, window = words.windows()
    if not len(at):
        return np.zeros(words.n, np.int64)
    owner = words.doc[at]
    order = np.lexsort((window, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (window[order][1:] == window[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(edges, at[twice], 1)
    np.add.at(edges, at[twice] + 5, -1)
    covered = np.cumsum(edges)[:-1] > 0
    return np.bincount(words.doc[covered], minlength=words.n)


def _features(batches: Iterator[pa.RecordBatch], position: int, limit: Bands) -> Iterator[pa.RecordBatch]:
    engine = zstandard.ZstdCompressor(level=LEVEL)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    for batch in batches:
        for lo, hi in slices(batch.column(position)):
            part = batch.slice(lo, hi - lo)
            w = Words(part.column(position), lower=False)
            data = w.raw.tobytes()
            bands = [compression(data[a:b], engine, limit) for a, b in zip(w.offsets[:-1], w.offsets[1:], strict=True)]
            ratio, chunks, low, high, verdict = zip(*bands, strict=True)
            columns = [
                pa.array(x, pa.int64())
                for x in (w.count, _inside(w, (w.raw & 0xC0) != 0x80), w.per_text(symbol[w.raw]), repeated_lines(w), repeated_words(w), np.diff(w.offsets))
            ]
            columns += [pa.array(ratio, pa.float64()), *(pa.array(x, pa.int64()) for x in (chunks, low, high)), pa.array(verdict)]
            names = [x.split()[0] for x in FEATURES.split(", ")]
            keys = [(n, c) for i, (n, c) in enumerate(zip(part.schema.names, part.columns, strict=True)) if i != position]
            yield pa.RecordBatch.from_arrays([c for _, c in keys] + columns, names=[n for n, _ in keys] + names)


def compression_features(docs: DataFrame, bands: Bands = TEXT_BANDS) -> DataFrame:
    """doc_id with the counts and ratios of each row's whole text, and its verdict by ``bands``.

    A null text counts as empty (no words, no ratio, verdict 'ok'); repeated rows are judged each; an empty
    table gives no rows; other columns are left out.
    """
    return docs.select("doc_id", "text").mapInArrow(lambda it: _features(it, 1, bands), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {FEATURES}")


def quality_rules(docs: DataFrame, bands: Bands = TEXT_BANDS) -> DataFrame:
    """The features with base_failed (under 10 words, or over a fifth of them repeated) and kept."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return compression_features(docs, bands).withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("band_verdict") == "ok"))


def keep_by_rules(docs: DataFrame, bands: Bands = TEXT_BANDS) -> DataFrame:
    """The documents that pass, with all their columns; the decision is made in the row, without a shuffle."""
    names = docs.columns
    plain = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)), F.col("text").alias("whole text"))
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    judged = plain.mapInArrow(lambda it: _features(it, len(names), bands), f"{schema}, {FEATURES}")
    kept = judged.where("n_words >= 10 and 100 * n_repeat_words <= 20 * n_words and band_verdict = 'ok'")
    return kept.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)))
