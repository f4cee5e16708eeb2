"""Packing token sequences into windows: non-negative least squares over shallow length combinations.

Each document becomes its token ids and one end id. Whole windows are cut off first. Of the remainders a task
gathers a group of about ``GROUP_TOKENS`` tokens, enumerates combinations of two and three lengths that fill a
window, solves for non-negative repeat counts whose lengths come closest to the group's histogram, rounds
them, and packs what is left greedily, longest first, cutting a piece where nothing fits. What then remains
of a group is less than one window and is cut into sequences of powers of two, so nothing is padded.

Documents are packed where they are read: no shuffle, and a task holds the ids of one group and one document.
A task that runs again gives the same sequences, because groups follow the rows of its partition.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from trialmill.llm.words import slices

WINDOW, END_ID = 2048, 1
GROUP_TOKENS = 4_000_000
#: Triples combine two of so many of the commonest lengths with the length that is missing.
COMMON_LENGTHS = 64
ROUNDS = 150
CACHE_WORDS = 200_000
VOCABULARY, MERGES, SPECIAL = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "<|endoftext|>"


class TokenIds:
    """Token ids of whole texts as 16-bit arrays, with the ids of recent words kept.

    A space between two other characters always starts a token of this vocabulary, so a text's ids are those of
    its space-separated parts. Parts with white space at an end send the whole text to the encoder.
    """

    def __init__(self):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(MERGES), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoder = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(1 << 16, np.int64)
        for piece, rank in ranks.items():
            self.width[rank] = len(piece)
        self.path, self.tokenizer, self._load = public_tokenizers.path(VOCABULARY), None, Tokenizer.from_file
        self.first: dict[str, bytes | None] = {}
        self.later: dict[str, bytes | None] = {}

    def whole(self, text: str) -> bytes:
        if SPECIAL in text:
            self.tokenizer = self.tokenizer or self._load(self.path)
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint16).tobytes()
        return np.array(self.encoder.encode_ordinary(text), np.uint16).tobytes()

    def _learn(self, parts: list[str]) -> None:
        """Encode independent parts, each after a space, in one go; byte lengths tell whose ids are whose."""
        if not parts:
            return
        ids = np.array(self.encoder.encode_ordinary(" " + " ".join(parts)), np.uint16)
        ends = np.cumsum(self.width[ids])
        stops = np.searchsorted(ends, np.cumsum([len(p.encode()) + 1 for p in parts]), side="right") * 2
        raw, start = ids.tobytes(), 0
        for p, stop in zip(parts, stops.tolist(), strict=True):
            self.later[p] = raw[start:stop]
            start = stop

    def many(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.later) > CACHE_WORDS:
            self.later = {}
        if len(self.first) > CACHE_WORDS // 4:
            self.first = {}
        first, later = self.first, self.later
        parts = [t.split(" ") for t in texts]
        for p in {p[0] for p in parts}.difference(first):
            first[p] = None if p == "" or p[-1].isspace() or SPECIAL in p else self.whole(p)
        new = set().union(*(p[1:] for p in parts)).difference(later)
        bound = {p for p in new if p == "" or p[0].isspace() or p[-1].isspace() or SPECIAL in p}
        later.update(dict.fromkeys(bound))
        self._learn([p for p in new if p not in bound])
        out = []
        for text, p in zip(texts, parts, strict=True):
            try:
                ids = first[p[0]] + b"".join(map(later.__getitem__, p[1:]))
            except TypeError:  # a part that is not independent of its neighbours
                ids = self.whole(text)
            out.append(np.frombuffer(ids, np.uint16))
        return out


_encoders: list[TokenIds] = []


def encoder() -> TokenIds:
    """The process's encoder: the next task of a worker finds the words of the last."""
    if not _encoders:
        _encoders.append(TokenIds())
    return _encoders[0]


def combinations(histogram: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Rows of two or three lengths of the histogram that fill a window; a third of 0 is none."""
    there = histogram > 0
    a = np.flatnonzero(there[: window // 2 + 1])
    pairs = a[there[window - a] & (a > 0)]
    rows = [np.stack([pairs, window - pairs, np.zeros_like(pairs)], 1)]
    common = np.sort(np.argsort(-histogram, kind="stable")[:COMMON_LENGTHS])
    common = common[histogram[common] > 0]
    x, y = np.meshgrid(common, common, indexing="ij")
    x, y = x[x <= y], y[x <= y]
    z = window - x - y
    fits = (z > 0) & there[np.clip(z, 0, window)]
    rows.append(np.unique(np.sort(np.stack([x, y, z], 1)[fits], 1), axis=0))
    return np.concatenate(rows)


def repeat_counts(histogram: np.ndarray, combos: np.ndarray) -> np.ndarray:
    """Non-negative repeat counts with the least squared distance to the histogram, by projected gradients."""
    if not len(combos):
        return np.zeros(0)
    n, size = len(combos), len(histogram)
    target = histogram.astype(float)
    target[0] = 0
    uses = np.bincount(combos.ravel(), minlength=size)
    step = 1.0 / (3.0 * max(1, uses[1:].max()))  # 3 entries a column, so many columns a row
    x = y = np.zeros(n)
    t = 1.0
    for _ in range(ROUNDS):
        gap = np.bincount(combos.ravel(), np.repeat(y, 3), minlength=size)
        gap[0] = 0
        gap -= target
        gap[0] = 0
        new = np.maximum(0.0, y - step * gap[combos].sum(1))
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        y, x = new + (last - 1) / t * (new - x), new
    return x


def layout(lengths: np.ndarray, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (piece, from, length) that hold every token of the pieces (1 to window-1 long) once."""
    histogram = np.bincount(lengths, minlength=window + 1)
    order = np.argsort(lengths, kind="stable")
    ends = np.cumsum(histogram)
    used = np.zeros(window + 1, np.int64)
    combos = combinations(histogram, window)
    counts = repeat_counts(histogram, combos)
    left = histogram.copy()
    sequences = []

    def take(length: int) -> int:
        used[length] += 1
        return int(order[ends[length] - used[length]])

    for c in np.argsort(-counts, kind="stable"):
        times = int(np.rint(counts[c]))
        if times == 0:
            break
        parts = [int(v) for v in combos[c] if v]
        need = np.bincount(parts, minlength=window + 1)
        kinds = np.flatnonzero(need)
        times = min(times, int((left[kinds] // need[kinds]).min()))
        left -= times * need
        sequences += [[(take(v), 0, v) for v in parts] for _ in range(times)]
    # the rest: longest first, then the longest that fits, then a cut
    rest = [(int(v), take(int(v)), 0) for v in np.repeat(np.arange(window + 1), left)]
    return sequences + greedy(rest, window)


def greedy(rest: list[tuple[int, int, int]], window: int) -> list[list[tuple[int, int, int]]]:
    """rest: (length, piece, from). Fills each window exactly; the last tokens become powers of two."""
    by: dict[int, list[tuple[int, int]]] = {}
    for v, piece, start in rest:
        by.setdefault(v, []).append((piece, start))
    heap = [-v for v in by]
    heapq.heapify(heap)
    present = np.zeros(window + 1, bool)
    present[list(by)] = True
    total = sum(v for v, _, _ in rest)

    def pop(v: int) -> tuple[int, int]:
        piece = by[v].pop()
        if not by[v]:
            del by[v]
            present[v] = False
        return piece

    def push(v: int, piece: int, start: int) -> None:
        if v not in by:
            by[v] = []
            present[v] = True
            heapq.heappush(heap, -v)
        by[v].append((piece, start))

    def longest() -> int:
        while -heap[0] not in by:
            heapq.heappop(heap)
        return -heap[0]

    sequences = []
    while total:
        size = window if total >= window else 1 << (total.bit_length() - 1)
        total -= size
        room, parts = size, []
        while room:
            fit = np.flatnonzero(present[1 : room + 1])
            if len(fit):
                v = int(fit[-1]) + 1
                piece, start = pop(v)
                parts.append((piece, start, v))
                room -= v
            else:
                v = longest()
                piece, start = pop(v)
                parts.append((piece, start, room))
                push(v - room, piece, start + room)
                room = 0
        sequences.append(parts)
    return sequences


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class _Group:
    """Documents waiting to be packed; ``pack`` gives the rows of their pieces."""

    def __init__(self, number: int, with_ids: bool):
        self.next, self.with_ids = number << 32, with_ids
        self.clear()

    def clear(self) -> None:
        self.docs: list[tuple[object, np.ndarray]] = []
        self.tokens = 0

    def add(self, doc: object, ids: np.ndarray) -> None:
        self.docs.append((doc, ids))
        self.tokens += len(ids)

    def pack(self) -> dict[str, list]:
        rows: dict[str, list] = {k: [] for k in ("doc_id", *(x.split()[0] for x in PIECES.split(", ")), *(["ids"] * self.with_ids))}

        def put(at: int, start: int, length: int, offset: int) -> None:
            doc, ids = self.docs[at]
            raw = ids[start : start + length].astype("<u4").tobytes()
            for k, v in zip(rows, (doc, start, length, zlib.crc32(raw), len(ids), self.next, offset, raw), strict=False):
                rows[k].append(v)

        tails, cut = [], []
        for i, (_, ids) in enumerate(self.docs):
            full = len(ids) // WINDOW * WINDOW
            for start in range(0, full, WINDOW):
                put(i, start, WINDOW, 0)
                self.next += 1
            if len(ids) > full:
                tails.append(i)
                cut.append(full)
        if tails:
            sizes = np.array([len(self.docs[i][1]) - f for i, f in zip(tails, cut, strict=True)])
            for parts in layout(sizes):
                offset = 0
                for piece, start, length in parts:
                    put(tails[piece], cut[piece] + start, length, offset)
                    offset += length
                self.next += 1
        self.clear()
        return rows


def _pack(with_ids: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_of = encoder()
        group = _Group(TaskContext.get().partitionId(), with_ids)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, hi in slices(batch.column(1)):
                texts = [t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                for doc, tokens in zip(ids[lo:hi], tokens_of.many(texts), strict=True):
                    group.add(doc, np.append(tokens, np.uint16(END_ID)))
                    if group.tokens >= GROUP_TOKENS:
                        yield pa.RecordBatch.from_pydict(group.pack(), schema=schema)
        if group.docs:
            yield pa.RecordBatch.from_pydict(group.pack(), schema=schema)

    return run


def packed(docs: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids: 32-bit little-endian).

    A null or empty text is its end id alone. Every row of ``docs`` is a document of its own, also where doc_ids
    repeat or are null. An empty table gives no rows; other columns are left out.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow = pa.schema(
        [("doc_id", {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind])]
        + [(x.split()[0], pa.int64()) for x in PIECES.split(", ")]
        + [("ids", pa.binary())] * with_ids
    )
    return docs.select("doc_id", "text").mapInArrow(_pack(with_ids, arrow), f"doc_id {kind}, {PIECES}" + ", ids binary" * with_ids)
