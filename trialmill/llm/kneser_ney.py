"""Interpolated modified Kneser-Ney language model, counted in Spark and memory-mapped by the workers.

Order two. Tasks count the bigrams of the texts they read, in slices, and send packed blocks keyed by a part of
the context's hash. One task then merges all blocks of a part, sorts them by bigram hash and appends two sorted
arrays to a file in the shared folder: bigrams with their counts, and contexts with the figures that their
discounts need. How often a word follows different words is added up the same way for the unigrams. Scoring
maps those files and looks up the distinct bigrams of each slice of text in sorted order.

The number of parts grows with the input, so that a part stays near ``PART_BYTES`` of text; only a task's
file name and eight sums per task reach the driver. Frequent contexts are added up before they travel.
Words are identified by 56-bit hashes, bigrams by 64-bit hashes.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmill.llm.store import saved, shared_folder
from trialmill.llm.words import Words, mix, released, slices

END, BEGIN = np.uint64(1), np.uint64(2)
#: Text that a task counts before it sends blocks, and text per part of the bigrams and of the words.
SLICE_BYTES, PART_BYTES, WORD_PART_BYTES = 4_000_000, 2_500_000, 16_000_000
#: Words of which a task gathers figures before it sends them on.
WORDS_HELD = 3_000_000


def part_of(key: np.ndarray, parts: int) -> np.ndarray:
    return ((mix(key) >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)


def bigram_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(context * np.uint64(0xD6E8FEB86659FD93) + word)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, context, word) of every token: the words and an end, each after its predecessor or the begin."""
    w = Words(texts)
    at = w.first + np.arange(w.n + 1)
    size = len(w.hash) + w.n
    word = np.full(size, END, np.uint64)
    place = np.arange(len(w.hash)) + w.doc
    word[place] = w.hash >> np.uint64(8)
    context = np.empty(size, np.uint64)
    context[1:] = word[:-1]
    context[at[:-1]] = BEGIN
    return np.repeat(np.arange(w.n), w.count + 1), context, word


def _seven(x: np.ndarray) -> bytes:
    """56-bit numbers as 7 bytes each."""
    return np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def _from_seven(data: np.ndarray) -> np.ndarray:
    out = np.zeros((len(data) // 7, 8), np.uint8)
    out[:, :7] = data.reshape(-1, 7)
    return out.view("<u8").ravel()


def _split(part: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(part, from, to) of each run of a sorted array."""
    cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else []
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        yield int(part[a]), int(a), int(b)


def _rows(parts: list[int], data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"part": pa.array(parts, pa.int64()), "data": pa.array(data, pa.binary())})


def _count(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(0), SLICE_BYTES):
                _, context, word = tokens(batch.column(0).slice(lo, hi - lo))
                _, first, count = np.unique(bigram_key(context, word), return_index=True, return_counts=True)
                context, word = context[first], word[first]
                part = part_of(context, parts)
                order = np.lexsort((context, part))
                context, word, count, part = context[order], word[order], count[order], part[order]
                names, data = [], []
                for p, a, b in _split(part):
                    head = np.flatnonzero(np.concatenate([[True], context[a + 1 : b] != context[a : b - 1]]))
                    runs = np.diff(np.append(head, b - a)).astype(np.uint32)
                    names.append(p)
                    data.append(
                        np.array([b - a, len(head)], np.int64).tobytes() + runs.tobytes() + count[a:b].astype(np.uint32).tobytes()
                        + _seven(context[a:b][head]) + _seven(word[a:b])
                    )
                yield _rows(names, data)

    return run


def _bigrams(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, m = np.frombuffer(data, np.int64, 2)
    runs = np.frombuffer(data, np.uint32, m, 16)
    count = np.frombuffer(data, np.uint32, n, 16 + 4 * m)
    rest = np.frombuffer(data, np.uint8, -1, 16 + 4 * (m + n))
    return np.repeat(_from_seven(rest[: 7 * m]), runs), _from_seven(rest[7 * m :]), count.astype(np.int64)


def _sum_by(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return (key[head], *(np.add.reduceat(v[order], head) if len(head) else v[:0] for v in values), order[head])


class PartFile:
    """A file of sorted arrays, part after part, and a directory of (part, offset, entries, contexts) at its end."""

    def __init__(self, folder: str):
        self.name = f"{folder}/{uuid.uuid4().hex}"
        self.system, path = pa.fs.FileSystem.from_uri(folder)
        self.system.create_dir(path, recursive=True)
        self.out = self.system.open_output_stream(f"{path}/{os.path.basename(self.name)}")
        self.directory: list[tuple[int, int, int, int]] = []
        self.at = 0

    def add(self, part: int, n: int, m: int, arrays: list[np.ndarray]) -> None:
        self.directory.append((part, self.at, n, m))
        for a in arrays:
            raw = a.tobytes()
            raw += bytes(-len(raw) % 8)
            self.out.write(raw)
            self.at += len(raw)

    def close(self) -> str:
        self.out.write(np.array(self.directory, np.int64).tobytes() + np.array([len(self.directory)], np.int64).tobytes())
        self.out.close()
        return self.name


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """The blocks of one part after the other; they arrive sorted by part."""
    current, held = None, []
    for batch in batches:
        for part, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if part != current and held:
                yield current, held
                held = []
            current = part
            held.append(data)
    if held:
        yield current, held


def _classes(count: np.ndarray) -> list[int]:
    """How many entries have a count of 1, 2, 3 and 4."""
    return [int((count == k).sum()) for k in (1, 2, 3, 4)]


_SUMS = "entries long, total long, n1 long, n2 long, n3 long, n4 long"


def _summary(path: str | None, sums: np.ndarray) -> dict[str, pa.Array]:
    out = {"path": pa.array([path], pa.string())}
    return out | {n.split()[0]: pa.array([int(v)], pa.int64()) for n, v in zip(_SUMS.split(", "), sums, strict=True)}


def _merge_bigrams(folder: str, word_parts: int):
    """Writes bigrams and contexts of its parts; gives a summary row, and blocks of word figures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, sums = None, np.zeros(6, np.int64)
        words: list[tuple[np.ndarray, ...]] = []

        def emit(part, data, summary):
            n = len(part)
            return pa.RecordBatch.from_pydict({"part": pa.array(part, pa.int64()), "data": pa.array(data, pa.binary())} | (summary or {
                "path": pa.nulls(n, pa.string()), **{x.split()[0]: pa.nulls(n, pa.int64()) for x in _SUMS.split(", ")}}))

        def word_blocks() -> pa.RecordBatch:
            word, times, follows, _ = _sum_by(*(np.concatenate(x) for x in zip(*words, strict=True)))
            words.clear()
            part = part_of(word, word_parts)
            order = np.argsort(part, kind="stable")
            word, times, follows = word[order], times[order], follows[order]
            names, data = [], []
            for p, a, b in _split(part[order]):
                names.append(p)
                data.append(np.array([b - a], np.int64).tobytes() + times[a:b].tobytes() + follows[a:b].astype(np.uint32).tobytes() + _seven(word[a:b]))
            return emit(names, data, None)

        for part, held in _parts(batches):
            context, word, count = (np.concatenate(x) for x in zip(*map(_bigrams, held), strict=True))
            key, count, first = _sum_by(bigram_key(context, word), count)
            context, word = context[first], word[first]
            owner, one, two, more, total, _ = _sum_by(context, count == 1, count == 2, count > 2, count)
            file = file or PartFile(folder)
            figures = [owner, total, *(x.astype(np.uint32) for x in (one, two, more))]
            file.add(part, len(key), len(owner), [key, count.astype(np.uint32), *figures])
            sums += [len(key), int(count.sum()), *_classes(count)]
            w, times, follows, _ = _sum_by(word, count, np.ones(len(word), np.int64))
            words.append((w, times, follows))
            if sum(len(x[0]) for x in words) > WORDS_HELD:
                yield word_blocks()
        if file:
            if words:
                yield word_blocks()
            yield emit([None], [None], _summary(file.close(), sums))

    return run


def _merge_words(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, sums = None, np.zeros(6, np.int64)
        for part, held in _parts(batches):
            word, times, follows = [], [], []
            for data in held:
                n = int(np.frombuffer(data, np.int64, 1)[0])
                times.append(np.frombuffer(data, np.int64, n, 8))
                follows.append(np.frombuffer(data, np.uint32, n, 8 + 8 * n).astype(np.int64))
                word.append(_from_seven(np.frombuffer(data, np.uint8, -1, 8 + 12 * n)))
            word, times, follows, _ = _sum_by(*(np.concatenate(x) for x in (word, times, follows)))
            file = file or PartFile(folder)
            file.add(part, len(word), 0, [word, times, follows.astype(np.uint32)])
            sums += [len(word), int(times.sum()), *_classes(follows)]
        if file:
            yield pa.RecordBatch.from_pydict(_summary(file.close(), sums))

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """What is taken off counts of 0, 1, 2 and 3 or more; within 0 and the count also where classes are empty."""
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    n = (n1, n2, n3, n4)
    d = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k * 0.5 for k in (1, 2, 3)]
    return np.array([0.0, *(min(max(v, 0.05), k - 0.05) for k, v in zip((1, 2, 3), d, strict=True))])


@dataclass
class KneserNey:
    """What workers need to score: file names, sums and discounts."""

    bigram_files: list[str]
    word_files: list[str]
    bigram_parts: int
    word_parts: int
    vocabulary: int
    tokens: int
    bigrams: int
    bigram_discounts: np.ndarray
    word_discounts: np.ndarray
    word_classes: tuple[int, int, int]

    def reader(self) -> Reader:
        return Reader(self)


_mapped: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _map(path: str) -> tuple[np.ndarray, np.ndarray]:
    """A file's bytes, memory-mapped, and its directory. A file that is not on a mounted folder is fetched once per process."""
    if path not in _mapped:
        where = urlparse(path)
        local = where.path
        if where.scheme not in ("", "file"):
            system, name = pa.fs.FileSystem.from_uri(path)
            local = tempfile.NamedTemporaryFile(delete=False).name  # noqa: SIM115
            with system.open_input_stream(name) as a, open(local, "wb") as b:
                while block := a.read(1 << 24):
                    b.write(block)
        data = np.memmap(local, np.uint8, "r")
        n = int(data[-8:].view(np.int64)[0])
        _mapped[path] = data, np.array(data[len(data) - 8 - 32 * n : len(data) - 8].view(np.int64).reshape(n, 4))
    return _mapped[path]


class Reader:
    """Looks up words and bigrams in the mapped files."""

    def __init__(self, model: KneserNey):
        self.model = model
        self.bigram_at, self.word_at = self._places(model.bigram_files), self._places(model.word_files)

    @staticmethod
    def _places(paths: list[str]) -> dict[int, tuple[np.ndarray, int, int, int]]:
        return {int(p): (data, int(at), int(n), int(m)) for data, rows in map(_map, paths) for p, at, n, m in rows}

    @staticmethod
    def _arrays(data: np.ndarray, at: int, layout: list[tuple[type, int]]) -> list[np.ndarray]:
        out = []
        for kind, n in layout:
            size = n * np.dtype(kind).itemsize
            out.append(data[at : at + size].view(kind))
            at += size + -size % 8
        return out

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def words(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each word and its unigram probability."""
        m = self.model
        times, follows = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        part = part_of(word, m.word_parts)
        order = np.lexsort((word, part))
        for p, a, b in _split(part[order]):
            if p in self.word_at:
                data, at, n, _ = self.word_at[p]
                keys, t, f = self._arrays(data, at, [(np.uint64, n), (np.int64, n), (np.uint32, n)])
                place, hit = self._find(keys, word[order[a:b]])
                times[order[a:b]] = np.where(hit, t[place], 0)
                follows[order[a:b]] = np.where(hit, f[place], 0)
        if not m.bigrams:
            return times, np.ones(len(word))
        d = m.word_discounts
        left = d[1] * m.word_classes[0] + d[2] * m.word_classes[1] + d[3] * m.word_classes[2]
        p = (np.maximum(follows - d[np.minimum(follows, 3)], 0) + left / (m.vocabulary + 1)) / m.bigrams
        return times, p

    def bigram_probability(self, context: np.ndarray, word: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Probability of each word after its context; ``lower``: its unigram probability."""
        m, d = self.model, self.model.bigram_discounts
        key = bigram_key(context, word)
        part = part_of(context, m.bigram_parts)
        order = np.lexsort((key, part))
        out = lower.copy()
        for p, a, b in _split(part[order]):
            if p not in self.bigram_at:
                continue
            data, at, n, k = self.bigram_at[p]
            layout = [(np.uint64, n), (np.uint32, n), (np.uint64, k), (np.int64, k), *[(np.uint32, k)] * 3]
            keys, counts, owners, totals, one, two, more = self._arrays(data, at, layout)
            own = order[a:b]
            place, hit = self._find(keys, key[own])
            c = np.where(hit, counts[place], 0).astype(np.int64)
            place, known = self._find(owners, context[own])
            left = d[1] * one[place] + d[2] * two[place] + d[3] * more[place]
            p2 = (np.maximum(c - d[np.minimum(c, 3)], 0) + left * lower[own]) / totals[place]
            out[own] = np.where(known, p2, lower[own])
        return out


def train(docs: DataFrame) -> KneserNey:
    """Count all ``text`` of the rows (null: empty, an end alone) and write the model to the shared folder."""
    spark = docs.sparkSession
    texts = docs.select("text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, word_parts = 1 + size // PART_BYTES, 1 + size // WORD_PART_BYTES
    blocks = texts.mapInArrow(released(_count(parts)), "part long, data binary")
    merged = blocks.repartition("part").sortWithinPartitions("part")
    folder = shared_folder(spark, "model")
    merged = saved(merged.mapInArrow(released(_merge_bigrams(f"{folder}/bigrams", word_parts)), f"part long, data binary, path string, {_SUMS}"), "words")
    words = merged.where("part is not null").select("part", "data").repartition("part").sortWithinPartitions("part")
    words = saved(words.mapInArrow(released(_merge_words(f"{folder}/words")), f"path string, {_SUMS}"), "manifest")
    bigram_rows, word_rows = merged.where("path is not null").drop("part", "data").collect(), words.collect()
    n, w = ([sum(r[k] for r in rows) for k in ("entries", "total", "n1", "n2", "n3", "n4")] for rows in (bigram_rows, word_rows))
    return KneserNey(
        [r.path for r in bigram_rows], [r.path for r in word_rows], parts, word_parts, w[0], w[1], n[0],
        discounts(*n[2:]), discounts(*w[2:]), (w[2], w[3], w[0] - w[2] - w[3]),
    )


def _score(model: KneserNey):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = model.reader()
        for batch in batches:
            for lo, hi in slices(batch.column(1), SLICE_BYTES):
                owner, context, word = tokens(batch.column(1).slice(lo, hi - lo))
                kinds, place = np.unique(word, return_inverse=True)
                times, lower = reader.words(kinds)
                _, first, again = np.unique(bigram_key(context, word), return_index=True, return_inverse=True)
                p = reader.bigram_probability(context[first], word[first], lower[place[first]])[again]
                times = times[place]
                n = hi - lo
                base = np.log10((times + 1) / (model.tokens + model.vocabulary + 1))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(0).slice(lo, n),
                        "n_tokens": pa.array(np.bincount(owner, minlength=n)),
                        "n_known": pa.array(np.bincount(owner[times > 0], minlength=n)),
                        "base_score": pa.array(np.bincount(owner, base, n)),
                        "score": pa.array(np.bincount(owner, np.log10(p), n)),
                    }
                )

    return run


def scored(docs: DataFrame, model: KneserNey) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score (log10 probabilities) of each row's whole text.

    A null text counts as empty: one end token. Rows are scored each, also if they repeat; an empty table gives
    no rows; other columns are left out. A model of no texts gives every token probability 1.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double"
    return docs.select("doc_id", "text").mapInArrow(released(_score(model)), schema)


def held_out():
    """Whether crc32 of the id as text leaves 2 by 7; a null id is learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))


def held_out_scores(docs: DataFrame) -> DataFrame:
    """Scores of all rows under a model of those that are not held out."""
    model = train(docs.where(~held_out()))
    return scored(docs, model).select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
