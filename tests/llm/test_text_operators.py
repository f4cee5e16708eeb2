"""Operators on documents against brute force on a small table of odd rows."""

import collections
import math
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

from trialmill.llm import compression, gam, jaccard_join, kneser_ney, packing, sketch, token_count
from trialmill.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = [shingles(r.text) for r in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                up[top(i)] = top(j)
    known = collections.defaultdict(list)
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            known[top(i)].append(r.doc_id)
    return collections.Counter((r.doc_id, len(sets[i]), min(known[top(i)], default=None)) for i, r in enumerate(rows))


def test_jaccard_join_equals_all_pairs(odd_docs):
    got = collections.Counter(map(tuple, jaccard_join.similar_documents(odd_docs).collect()))
    assert got == brute_components(odd_docs.collect())


def test_jaccard_join_with_common_passages_and_chains(spark):
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(120):  # all share a passage; documents 0-9 form a chain of near copies
        own = [f"c{(i // 10 if i < 10 else i)}_{k}" for k in range(70)]
        if i < 10:
            own[:i] = [f"new{k}" for k in range(i)]
        rows.append((i, " ".join(passage + own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = collections.Counter(map(tuple, jaccard_join.similar_documents(docs).collect()))
    assert got == brute_components(docs.collect())


def test_rows_without_id_and_ids_of_several_texts_are_compared(spark):
    def text(name, changed=0):  # of 200 words; 10 changed words at either end leave 0.8 or more in common, 20 do not
        w = [f"{name}{i}" for i in range(200)]
        w[: max(changed, 0)] = [f"{name}new{i}" for i in range(max(changed, 0))]
        if changed < 0:
            w[changed:] = [f"{name}end{i}" for i in range(-changed)]
        return " ".join(w)

    rows = [
        (1, text("a")), (None, text("a")), (None, text("a", 9)),  # an exact and a near copy without id
        (2, text("b", 16)), (None, text("b")), (3, text("b", -16)),  # id - null - id
        (None, text("c")), (None, text("c", 9)), (None, text("c").upper()),  # no id at all
        (None, "alone without an id"), (None, None), (None, " "), (None, " "), (4, None),
        (5, text("d")), (5, text("e")), (5, ""), (6, text("e", 9)), (7, text("d", 9)), (0, text("e", -9)),  # id 5 links both
        (8, text("f")), (8, text("f")), (9, text("f", 9)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = collections.defaultdict(set)
    for r in jaccard_join.similar_documents(docs).collect():
        got[r.doc_id].add(r.component_id)
    assert got == {None: {1, 2, None}, 1: {1}, 2: {2}, 3: {2}, 4: {4}, 5: {0}, 6: {0}, 7: {0}, 0: {0}, 8: {8}, 9: {8}}
    kept = [(r.doc_id, r.text) for r in jaccard_join.one_of_each(docs).collect()]
    assert sorted(k for k, _ in kept if k is not None) == [0, 1, 2, 4, 8]
    loose = collections.Counter((t or "").strip()[:5].lower() for k, t in kept if k is None)
    assert loose == {"c0 c1": 1, "alone": 1, "": 2} or loose == {"cnew0": 1, "alone": 1, "": 2}


@pytest.mark.parametrize("gain", [1, 2])
def test_similar_sets_share_an_entry_under_every_allocation(gain):
    rnd = np.random.default_rng(gain)
    for common in (np.zeros(0, np.uint64), np.sort(rnd.integers(0, 400, 150).astype(np.uint64))):
        for share in (0.05, 0.45, 0.8, 2.0):
            plan = {b: (gain, max(1, math.ceil(share * 2**b))) for b in range(65)}
            for size in (4, 5, 7, 9, 16, 31, 33, 40, 65):
                for _ in range(12):
                    a = rnd.choice(400, size, replace=False)
                    drop = int(rnd.integers(0, size // 9 + 2))
                    b = np.union1d(rnd.choice(a, size - drop, replace=False), rnd.choice(np.arange(400, 800), int(rnd.integers(0, size // 9 + 2))))
                    both = len(np.intersect1d(a, b))
                    if 5 * both >= 4 * (len(a) + len(b) - both) and len(np.setxor1d(a, b)):
                        sig, who = jaccard_join.entries([np.sort(a).astype(np.uint64), b.astype(np.uint64)], plan, common)
                        assert set(sig[who == 0]) & set(sig[who == 1]), (size, share, a, b)


def test_allocation_spends_more_entries_on_larger_bands():
    few, many = jaccard_join.allocate({9: 1000}), jaccard_join.allocate({9: 10**10})
    assert few[9][0] == 1 and many[9][0] == 2


def test_one_of_each_keeps_columns_and_the_smallest(odd_docs):
    kept = jaccard_join.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    first = {r.component_id for r in jaccard_join.similar_documents(odd_docs).collect() if r.doc_id is not None}
    assert sorted(i for i in ids if i is not None) == sorted(first) and ids.count(None) == 1


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 9), (5, 5), (None, 4), *((100 + i, 101 + i) for i in range(40))], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 5: 5} | {100 + i: 100 for i in range(41)}
    assert components(edges.where("a < 0")).count() == 0


def test_language_model_equals_formula(odd_docs):
    got = kneser_ney.held_out_scores(odd_docs).collect()
    rows = odd_docs.collect()
    words = lambda t: [*WORD.findall((t or "").translate(LOWER)), "</s>"]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count, pairs = collections.Counter(), collections.Counter()
    for r in rows:
        if not held(r.doc_id):
            count.update(words(r.text))
            pairs.update(zip(["<s>", *words(r.text)], words(r.text), strict=False))
    n, v = sum(count.values()), len(count)
    follows, about = collections.Counter(w for _, w in pairs), collections.defaultdict(lambda: [0, 0, 0, 0])
    for (c, _), k in pairs.items():
        about[c][3] += k
        about[c][min(k, 3) - 1] += 1
    classes = lambda values: [sum(x == k for x in values) for k in (1, 2, 3, 4)]
    d, e = kneser_ney.discounts(*classes(pairs.values())), kneser_ney.discounts(*classes(follows.values()))
    one, two, *_ = classes(follows.values())

    def low(w):
        return (max(follows[w] - e[min(follows[w], 3)], 0) + (e[1] * one + e[2] * two + e[3] * (v - one - two)) / (v + 1)) / len(pairs)

    def high(c, w):
        if c not in about:
            return low(w)
        k, a = pairs[c, w], about[c]
        return (max(k - d[min(k, 3)], 0) + (d[1] * a[0] + d[2] * a[1] + d[3] * a[2]) * low(w)) / a[3]

    want = collections.defaultdict(list)
    for r in rows:
        w = words(r.text)
        score = sum(math.log10(high(a, b)) for a, b in zip(["<s>", *w], w, strict=False))
        want[r.doc_id].append((held(r.doc_id), len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), score))
    assert len(got) == len(rows)
    for r in got:
        assert any(tuple(r)[1:5] == x[:4] and abs(r.base_score - x[4]) < 1e-6 and abs(r.score - x[5]) < 1e-6 for x in want[r.doc_id])
    assert abs(sum(high("one", w) for w in count) + high("one", "unseen") - 1) < 1e-9


def test_rules_equal_brute_force(odd_docs):
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in compression.quality_rules(odd_docs).collect())
    want = collections.Counter()
    for r in odd_docs.collect():
        text = r.text or ""
        w = WORD.findall(text)
        seen, again = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                again += line in seen
                seen.add(line)
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        times, inside = collections.Counter(windows), set()
        for i, x in enumerate(windows):
            if times[x] > 1:
                inside.update(range(i, i + 5))
        failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
        want[r.doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), again, len(inside), failed] += 1
    assert got == want


def test_bands_reject_repetition_and_noise_and_keep_prose():
    import zstandard

    engine, rnd = zstandard.ZstdCompressor(level=compression.LEVEL), np.random.default_rng(1)
    prose = " ".join(rnd.choice([f"word{i}" for i in range(900)], 3000)).encode()
    noise = bytes(rnd.integers(33, 126, 20_000, dtype=np.uint8))
    assert compression.compression(prose, engine)[4] == "ok"
    assert compression.compression(b"again and again " * 400, engine)[4] == "repetitive"
    assert compression.compression(noise, engine)[4] == "incompressible"
    assert compression.compression(prose + b"spam " * 4000, engine)[4] == "repetitive"  # by its chunks
    assert compression.compression(b"", engine)[4] == "ok"


def test_bands_test_the_tail_too():
    import base64

    import zstandard

    engine, rnd = zstandard.ZstdCompressor(level=compression.LEVEL), np.random.default_rng(2)
    vocabulary = ["".join(chr(97 + c) for c in rnd.integers(0, 26, rnd.integers(2, 9))) for _ in range(400)]
    prose = " ".join(rnd.choice(vocabulary, 2000)).encode()
    noise = base64.b64encode(rnd.bytes(8000))
    low, high = compression.limits(8191)
    for tail in (4095, 4096, 3000):  # 8191 bytes end in a shorter chunk, 8192 in a full one
        data = prose[:4096] + noise[:tail]
        ratio, *chunks, verdict = compression.compression(data, engine)
        assert low < ratio < high and chunks == [2, 0, 1] and verdict == "incompressible", (tail, ratio)
        assert compression.compression(prose[:4096] + b"spam " * (tail // 5 + 1), engine)[4] == "repetitive"
        assert compression.compression(prose[: 4096 + tail], engine)[1:] == (2, 0, 0, "ok")
    # a tail weighs its bytes: 1024 of 5120 bytes are under a quarter
    assert compression.compression(prose[:4096] + noise[:1024], engine)[1:] == (2, 0, 1, "ok")
    assert compression.compression(prose[:4096], engine)[1:] == (0, 0, 0, "ok")
    assert compression.compression(prose[:4097], engine)[1:] == (2, 0, 0, "ok")


def test_bands_reject_given_documents_that_the_base_rule_keeps(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality").distinct()
    rows = compression.quality_rules(docs).where("not base_failed").join(labels, "doc_id", "left").collect()
    bands = {}
    for r in rows:
        assert r.kept == (r.band_verdict == "ok")
        low, high = compression.limits(r.n_bytes, compression.TEXT_BANDS)
        assert r.kept or not low <= r.ratio <= high or r.chunks_low + r.chunks_high > 0
        bands.setdefault(r.quality, collections.Counter())[r.kept] += 1
    rejected = sum(c[False] for c in bands.values())
    assert 0 < rejected < 0.1 * len(rows)
    assert bands[0][False] > bands[0][True]  # most poor documents that the base rule keeps
    assert bands[1][False] <= 0.005 * bands[1][True]  # hardly any good one
    wide = compression.quality_rules(docs, compression.BANDS).where("not base_failed and not kept").count()
    assert wide < rejected


def test_token_counts_equal_the_tokenizer(odd_docs):
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.Unigram(token_count.vocabulary(), unk_id=0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    texts = {(r.doc_id, r.text) for r in odd_docs.collect()}
    want = collections.Counter((r.doc_id, len(t.encode(r.text or "", add_special_tokens=False).ids)) for r in odd_docs.collect())
    assert collections.Counter((r.doc_id, r.n_tokens) for r in token_count.token_counts(odd_docs).collect()) == want and texts
    counter = token_count.UnigramCounter(token_count.vocabulary())
    for text in ["  a", "<s> <0x41>", "a▁b", "\0x", "𝒳" * 9, "aaaaaaaaaaaaaaaaaaaa", "\n\n"]:
        assert counter.text(text)[0] == len(t.encode(text, add_special_tokens=False).ids), text


def test_token_count_ties():
    counter = token_count.UnigramCounter([("▁", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -1.0)])
    assert counter.text("ab") == (2, -2.0)  # of the three best paths, the one whose last piece starts first: ▁ + ab


def test_packed_pieces_cover_every_id_once(odd_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.packed(odd_docs, with_ids=True).collect()
    want = collections.Counter((r.doc_id, struct.pack(f"<{n}I", *ids)) for r in odd_docs.collect() for ids in [[*t.encode(r.text or "", add_special_tokens=False).ids, 1]] for n in [len(ids)])
    parts = collections.defaultdict(lambda: collections.defaultdict(list))
    sequences = collections.defaultdict(list)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        parts[r.doc_id][r.start].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)
    got = collections.Counter()
    for doc, starts in parts.items():
        copies = len(starts[0])  # equal rows are cut on their own, so put pieces together by length
        assert copies == sum(n for (d, _), n in want.items() if d == doc)
        if copies == 1:
            got[doc, b"".join(starts[k][0].ids for k in sorted(starts))] += 1
    assert all(want[k] == n for k, n in got.items()) and sum(got.values()) > 50
    assert sum(r.length for r in rows) == sum(len(ids) // 4 * n for (_, ids), n in want.items())


def test_layout_uses_whole_windows():
    lengths = np.random.default_rng(3).integers(1, 2048, 700)
    sequences = packing.layout(lengths)
    seen = collections.defaultdict(list)
    for parts in sequences:
        for piece, start, length in parts:
            seen[piece].append((start, length))
    for i, n in enumerate(lengths):
        at = 0
        for start, length in sorted(seen[i]):
            assert start == at
            at += length
        assert at == n
    assert sum(sum(x[2] for x in p) == 2048 for p in sequences) == lengths.sum() // 2048
    counts = packing.repeat_counts(np.bincount([1000, 1000, 1048, 1048], minlength=2049), np.array([[1000, 1048, 0]]))
    assert abs(counts[0] - 2) < 1e-6


def test_sketches(spark, odd_docs):
    rows = sketch.fingerprints(odd_docs).collect()
    docs = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, (r.text or "").encode()))
    import hashlib

    want = collections.Counter()
    for a, b in zip(docs, docs[1:] + docs[:1], strict=True):
        text, after = a.text or "", b.text or ""
        q = len(text) // 4
        want[a.doc_id, len(text), hashlib.sha256((text[: len(text) - q] + after[:q]).encode()).hexdigest()] += 1
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    by = collections.defaultdict(set)
    for r in odd_docs.join(spark.createDataFrame([(r.doc_id, r.fingerprint) for r in rows], "doc_id long, f string"), "doc_id").collect():
        by[r.text or ""].add(r.f)
    assert all(len(f) == 1 for f in by.values())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)


def test_sketch_estimates_and_merges(spark):
    a, b = [f"w{i}" for i in range(2000)], [f"w{i}" for i in range(400, 2400)]
    df = spark.createDataFrame([("g", " ".join(a), " ".join(b)), ("h", "x y", "")], "k string, a string, b string")
    df = sketch.with_sketch(sketch.with_sketch(df, "a", "x"), "b", "y")
    r, h = df.select(
        "k", sketch.resemblance(df.x, df.y).alias("j"), sketch.containment(df.x, df.y).alias("c"), sketch.distinct_shingles(df.x).alias("n"), sketch.merged(df.x, df.y).alias("m")
    ).orderBy("k").collect()
    assert abs(r.j - 1596 / 2396) < 0.15 and abs(r.c - 0.8) < 0.2 and abs(r.n - 1996) < 500
    assert (h.j, h.c, h.n) == (0.0, 0.0, 1.0)
    parts = df.selectExpr("k", "x as s").union(df.selectExpr("k", "y as s"))
    assert {x.k: x.s for x in sketch.merge_by(parts, ["k"], "s").collect()} == {"g": r.m, "h": h.m}


def test_following(spark):
    keys = [-(2**62), -5, 0, 1, 2**18, 2**18 + 1, 2**40, 2**62]
    got = {r.key: r.next for r in sketch.following(spark.createDataFrame([(k,) for k in keys], "key long")).collect()}
    assert got == dict(zip(keys, [*keys[1:], None], strict=True))


def test_classifier_learns_and_handles_odd_rows(spark, odd_docs):
    rnd = np.random.default_rng(0)
    good = [" ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "rho"], 60)) + "." for _ in range(300)]
    bad = [" | ".join(rnd.choice(["ALPHA", "beta$$$", "9999"], 60)) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(x for pair in zip(good, bad, strict=True) for x in pair)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i, _ in rows] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = gam.quality_scores(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(r.predicted == 1 - r.doc_id % 2 for r in got if r.held_out)
    odd = gam.quality_scores(odd_docs, labels.where("doc_id < 0")).collect()
    assert len(odd) == odd_docs.count() and {r.score for r in odd} == {0.5}
    kept = gam.keep_good(odd_docs, labels.where("doc_id < 0"))
    assert kept.columns == odd_docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, odd_docs.collect()))


def test_pairs_are_learnt():
    x = np.random.default_rng(2).random((4000, len(gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def test_empty_tables(no_docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for df in (
        jaccard_join.similar_documents(no_docs), jaccard_join.one_of_each(no_docs), kneser_ney.held_out_scores(no_docs), compression.quality_rules(no_docs),
        compression.keep_by_rules(no_docs), token_count.token_counts(no_docs), packing.packed(no_docs), sketch.fingerprints(no_docs),
        gam.quality_scores(no_docs, labels), gam.keep_good(no_docs, labels),
    ):
        assert df.count() == 0


def test_counting_bigrams_keeps_few_arrays_of_a_slice():
    import tracemalloc

    rng = np.random.default_rng(1)
    texts = [" ".join(map(str, rng.integers(0, 50_000, 1000))) for _ in range(1700)]
    tracemalloc.start()
    try:
        counted = sum(len(b) for b in kneser_ney._count(4)(iter([pa.RecordBatch.from_pydict({"text": texts})])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert counted and peak < 270e6  # 329 MB with slices of 8 MB, for 10 MB of text
