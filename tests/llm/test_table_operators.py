"""Mixing, url filters, quotation linking, the pipeline and the registered queries."""

import collections
import os
import re

import numpy as np
import pytest

import corpus_pipeline
from trialmill.llm import link_trust, mixing, queries, quotes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def brute_targets(sizes, share=1.5, passes=2.0):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    fixed, total = {}, share * sum(sizes.values())
    while True:
        open_ = [n for n in names if n not in fixed]
        left = total - sum(fixed.values())
        want = {n: left * weight[n] / sum(weight[m] for m in open_) for n in open_}
        over = {n: passes * sizes[n] for n in open_ if want[n] > passes * sizes[n]}
        if not over:
            return fixed | want
        fixed |= over


def test_mix_meets_targets_and_limits(odd_docs):
    rows = mixing.words_taken(odd_docs).collect()
    sizes = collections.Counter()
    for r in odd_docs.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    want, taken = brute_targets(sizes), collections.Counter()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * (1 + r.target)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1.5 * mixing.BLOCK_WORDS for s in sizes)
    again = mixing.words_taken(odd_docs.repartition(7)).collect()
    assert collections.Counter(map(tuple, rows)) == collections.Counter(map(tuple, again))


@pytest.mark.parametrize("job", [mixing.words_taken, mixing.mixed_documents])
def test_slots_of_the_mix_are_not_broadcast(odd_docs, job):
    found = job(odd_docs)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    joins = re.findall(r"(\w+Join) \[s#\d+, block#", plan)
    assert "isFinalPlan=true" in plan and joins == ["SortMergeJoin"]


def test_permutation(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 3, 97, 1000):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit("k")).alias("x"))
        values = [r.x for r in got.collect()]
        assert sorted(values) == list(range(n)) and (n < 50 or values != sorted(values))


def test_mixed_documents_hold_the_words_taken(odd_docs):
    mixed = mixing.mixed_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    got, want = collections.Counter(), collections.Counter()
    texts = collections.defaultdict(set)
    for r in odd_docs.collect():
        texts[r.doc_id].add(r.text or "")
    for r in mixed.collect():
        got[r.doc_id] += len(WORD.findall(r.text))
        assert r.n_chars == len(r.text)
        assert any(set(WORD.findall(r.text)) <= set(WORD.findall(t)) for t in texts[r.doc_id])
    for r in mixing.words_taken(odd_docs).collect():
        want[r.doc_id] += r.taken
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_rules(spark):
    urls = [
        (1, "http://A.Example.com/en/1"), (2, "http://www.example.com/en/1?x=/de/"), (3, "https://x.net/es/1"), (4, "https://x.net/en/1"),
        (5, None), (6, "nothing"), (7, "http://notexample.com"), (8, "http://mycom/"), (9, "http://example.com/fr/1#a"), (10, "http://"), (11, "http://x.net?/es/"),
    ]
    got = {r.page_id: tuple(r)[1:4] for r in link_trust.judged_by_rules(spark.createDataFrame(urls, "page_id long, url string")).collect()}
    assert got == {
        1: ("a.example.com", "/en/1", "example.com/en/"), 2: ("www.example.com", "/en/1", "www.example.com/en/"), 3: ("x.net", "/es/1", "net/es/"),
        4: ("x.net", "/en/1", None), 5: ("", "", None), 6: ("", "", None), 7: ("notexample.com", "", None), 8: ("mycom", "/", None),
        9: ("example.com", "/fr/1", "com/"), 10: ("", "", None), 11: ("x.net", "", None),
    }


def brute_ranks(edges, seed, rounds, d):
    names = sorted({x for e in edges for x in e[:2]} | set(seed))
    at = {n: i for i, n in enumerate(names)}
    w = np.zeros((len(names),) * 2)
    for a, b, n in edges:
        w[at[a], at[b]] += n
    ahead = w / np.maximum(w.sum(1, keepdims=True), 1e-300)
    back = (w / np.maximum(w.sum(0, keepdims=True), 1e-300)).T
    t0, d0 = (np.array([(1 - d) * seed.get(n, (0, 0))[k] for n in names]) for k in (0, 1))
    t, u = t0, d0
    for _ in range(rounds):
        t, u = t0 + d * ahead.T @ t, d0 + d * back.T @ u
    return {n: (t[at[n]], u[at[n]]) for n in names}


def test_propagation_and_verdicts(spark):
    link = lambda *hosts: "".join(f'<a class="x" HREF="https://{h}/p">x</a><a href="/own">y</a>' for h in hosts)
    pages = [
        (1, "http://bad.net/es/", link("worse.org")), (2, "http://feeder.org/", link("bad.net", "bad.net")), (3, "http://good.com/", link("friend.org")),
        (4, "http://friend.org/", link("third.org")), (5, "http://third.org/a", None), (6, "http://lonely.org/", ""), (7, None, link("good.com")), (6, "http://lonely.org/", ""),
        (8, "http://second.org/", link("feeder.org", "good.com")), (9, "http://worse.org/", '<a href="//bad.net/q">'),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumnRenamed("nothing", "x")
    ruled = link_trust.judged_by_rules(df)
    edges = {(r.a, r.b): r.n for r in link_trust.host_edges(df).collect()}
    assert edges == {("bad.net", "worse.org"): 1, ("feeder.org", "bad.net"): 2, ("good.com", "friend.org"): 1, ("friend.org", "third.org"): 1, ("second.org", "feeder.org"): 1, ("second.org", "good.com"): 1, ("worse.org", "bad.net"): 1}
    want = brute_ranks([(*k, n) for k, n in edges.items()], {"bad.net": (0, 1), "good.com": (1, 0)}, link_trust.ROUNDS, link_trust.DAMPING)
    ranks = {r.host: (r.trust, r.distrust) for r in link_trust.propagated(link_trust.seeds(ruled), link_trust.host_edges(df)).collect()}
    assert all(np.allclose(ranks.get(h, (0, 0)), want[h]) for h in want)
    got = collections.Counter((r.page_id, r.verdict) for r in link_trust.filtered_urls(df).collect())
    host = {3: "good.com", 4: "friend.org", 5: "third.org", 6: "lonely.org", 8: "second.org", 9: "worse.org", 2: "feeder.org"}
    lead = {p: want.get(h, (0, 0))[1] - want.get(h, (0, 0))[0] for p, h in host.items()}
    method = {p: "block" if v >= link_trust.THRESHOLD else "allow" for p, v in lead.items()}
    assert method[2] == "block" and method[4] == method[6] == "allow"
    assert got == collections.Counter([(1, "block"), (3, "allow"), (7, "allow"), (6, method[6]), *((p, method[p]) for p in (2, 4, 5, 6, 8, 9))])
    assert link_trust.filtered_urls(df.where("page_id < 0")).count() == 0


def test_seeds_weigh_judged_pages_only(spark):
    urls = [(i, f"http://few.net/{'es' if i < 2 else 'en'}/{i}") for i in range(10)]  # 2 blocked, 8 without a rule
    urls += [(20 + i, f"http://mixed.example.com/{'en' if i < 3 else 'fr'}/{i}") for i in range(4)]  # 3 blocked, 1 allowed
    urls += [(30, "http://even.example.com/en/"), (31, "http://even.example.com/fr/"), (40, "http://plain.org/")]
    df = spark.createDataFrame([(*u, None) for u in urls], "page_id long, url string, html string")
    seeds = {r.host: (r.trust, r.distrust) for r in link_trust.seeds(link_trust.judged_by_rules(df)).collect()}
    assert seeds == {"few.net": (0, 1), "mixed.example.com": (0, 0.5), "even.example.com": (0, 0)}
    got = {r.page_id: r.verdict for r in link_trust.filtered_urls(df).collect()}
    assert all(got[i] == "block" for i in range(10)) and got[23] == got[31] == got[40] == "allow"


def test_quotes_are_linked_and_taken_out(spark):
    rows = [
        (1, 0, "user", "How do I sort?\nThanks"), (1, 1, "assistant", "Use order by."), (1, 2, "user", "> Use  ORDER by.\n\nAscending?"),
        (1, 3, "user", ">> use order by.\n> Ascending?\nI ask too"), (1, 4, "user", "Other topic"), (1, 5, "user", "> how do I sort?\r\n> never said\n"),
        (1, 6, "user", "> nobody said this\nhm"), (2, 0, "user", None), (2, 1, None, ""), (2, 1, None, ""), (None, 0, "user", "> x\nlost"), (3, None, "user", "y"),
        (3, 1, "user", "same"), (3, 2, "user", "same"), (3, 4, "user", "> same\nwhich?"), (3, 5, "user", "> > same\nnested only"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(((r.conv_id, r.turn, r.text, r.quote_levels, r.reply_to, r.thread, r.depth, r.position) for r in quotes.linked_conversations(df).collect()), key=str)
    want = sorted(
        [
            (1, 0, "How do I sort?\nThanks", 0, None, 0, 0, 1), (1, 5, "", 1, 0, 0, 1, 2), (1, 1, "Use order by.", 0, None, 1, 0, 3),
            (1, 2, "Ascending?", 1, 1, 1, 1, 4), (1, 3, "I ask too", 2, 2, 1, 2, 5), (1, 4, "Other topic", 0, None, 4, 0, 6), (1, 6, "hm", 1, None, 6, 0, 7),
            (2, 0, None, 0, None, 0, 0, 1), (2, 1, "", 0, None, 1, 0, 2), (2, 1, "", 0, None, 1, 0, 3), (None, 0, "lost", 0, None, 0, 0, None), (3, None, "y", 0, None, None, 0, None),
            (3, 1, "same", 0, None, 1, 0, 1), (3, 2, "same", 0, None, 2, 0, 2), (3, 4, "which?", 1, 2, 2, 1, 3), (3, 5, "nested only", 2, None, 5, 0, 4),
        ],
        key=str,
    )
    assert got == want
    assert quotes.linked_conversations(df.where("turn < 0")).count() == 0


QUOTED = "conv_id long, turn long, role string, text string, thread string, row long, n long, source string, block int"


def brute_links(rows):
    """The source of each quoted passage of {(conv, turn): text}, run by run in plain loops."""

    def runs_of_lines(text):
        out = []
        for at, line in enumerate(re.split("\r?\n", text)):
            marks = re.match(r"\s*((?:>[ \t]*)+)", line)
            level = marks.group(1).count(">") if marks else 0
            words = re.findall(r"[^\W_]+", line.lower()) if not marks else re.findall(r"[^\W_]+", line[marks.end() :].lower())
            if out and out[-1][1] == level:
                out[-1][2].append(words)
            else:
                out.append((at, level, [words]))
        return [(at, level, parts, sum(parts, [])) for at, level, parts in out if sum(parts, [])]

    found = {place: runs_of_lines(text) for place, text in rows.items()}
    links = {}
    for (conv, turn), own in found.items():
        earlier = sorted(((t, words) for (c, t), ps in found.items() if c == conv and t < turn for _, level, _, words in ps if level == 0), reverse=True)
        for at, level, parts, words in own:
            if not level:
                continue
            runs = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
            runs |= {tuple(p) for p in parts if 0 < len(p) < 5}
            score = collections.defaultdict(lambda: [False, 0])
            for run in runs:
                near = next((t for t, w in earlier if any(tuple(w[i : i + len(run)]) == run for i in range(len(w) - len(run) + 1))), None)
                if near is not None:
                    score[near][1] += len(run)
            same = next((t for t, w in earlier if w == words), None)
            if same is not None:
                score[same][0] = True
            links[conv, turn, at] = max(((*v, t) for t, v in score.items()), default=(None,))[-1]
    return links


def test_passages_are_found_rewrapped_in_part_and_nested(spark):
    first = "The engine reads every file of the folder, then sorts\nthem by their names and writes one table."
    rows = [
        (1, 0, "u", first), (1, 1, "a", "Which folder do you mean here? I know three of them."),
        (1, 2, "u", "> The engine reads every file\n> of the folder, then sorts them\n> by their names and writes one table.\nAll of them?"),
        (1, 3, "u", "> sorts them by their names\nWhy?"), (1, 4, "a", ">> every file of the folder, then sorts\n> All of them?\nYes"),
        (1, 5, "u", "> Which folder do you mean here? I know three of them.\n> reads every file of the folder\nMixed"), (1, 6, "u", "> folder\n\n> nothing of this was ever said\n"),
        (1, 6, "u", "> three of them\n"), (1, 6, "u", "> three of them\n"),
    ]
    df = spark.createDataFrame([(*r, "x", 1, 2, "y", 3) for r in rows], QUOTED)
    got = {(r.turn, r.level, r.words): r.source for r in quotes.quoted_passages(df).collect()}
    assert got == {(2, 1, 18): 0, (3, 1, 5): 0, (4, 2, 7): 0, (4, 1, 3): 2, (5, 1, 17): 1, (6, 1, 1): 1, (6, 1, 6): None, (6, 1, 3): 1}
    placed = {(r.turn, r.text): r for r in quotes.linked_conversations(df).collect()}
    assert placed[2, "All of them?"].reply_to == 0 and placed[4, "Yes"].reply_to == 2 and placed[4, "Yes"].thread == 0
    assert quotes.linked_conversations(df).columns == quotes.linked_conversations(df.select("conv_id", "turn", "role", "text")).columns


def test_links_agree_with_brute_force(spark):
    rnd = np.random.default_rng(3)
    rows, vocabulary = {}, [f"w{i}" for i in range(12)] + ["Öl", "né"]
    for conv in range(12):
        for turn in range(rnd.integers(2, 9)):
            lines = []
            for _ in range(rnd.integers(1, 5)):
                level = rnd.integers(0, 3) if turn else 0
                lines.append("> " * level + " ".join(rnd.choice(vocabulary, rnd.integers(0, 7))))
                if level and rnd.random() < 0.7:  # a part of an earlier message, wrapped anew
                    said = re.sub(r"(?m)^[> ]*", "", rows[conv, int(rnd.integers(0, turn))]).split()
                    at = rnd.integers(0, len(said) + 1)
                    piece = said[at : at + rnd.integers(1, 15)]
                    lines += ["> " * level + " ".join(piece[i : i + 4]) for i in range(0, len(piece), 4)]
            rows[conv, turn] = "\n".join(lines)
    df = spark.createDataFrame([(c, t, "u", x) for (c, t), x in rows.items()], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn, r.passage): r.source for r in quotes.quoted_passages(df).collect()}
    want = brute_links(rows)
    assert got == want and sum(v is not None for v in want.values()) > 25


def test_long_messages_and_long_threads(spark):
    """A message of 20,000 lines of alternating levels, and a conversation in which thousands answer one message."""
    long = "\n".join(f"> word{i} and some more here\nanswer {i}" for i in range(10_000))
    said = "\n".join(f"word{i} and some more here" for i in range(10_000))
    rows = [(1, 0, "u", said), (1, 1, "u", long)] + [(2, t, "u", "> the one and only start of it\nme too" if t else "the one and only start of it") for t in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): r for r in quotes.linked_conversations(df).collect()}
    assert got[1, 1].passages == got[1, 1].linked == 10_000 and got[1, 1].reply_to == 0
    assert all(got[2, t].position == t + 1 and got[2, t].thread == 0 for t in range(3000))


def test_stages_handle_odd_rows_and_keep_columns(spark, odd_docs, no_docs, tmp_path):
    labels = [(i * 7, i % 2, 0) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns or name == "packing"
            assert (out.count() > 0) == (docs is odd_docs)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_pipeline_takes_effect(spark):
    out = corpus_pipeline.run(spark, SF)
    ids = {r.doc_id for r in out.collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
    assert 0.5 * docs.count() < len(ids) < docs.count() and len(ids & junk) <= 0.1 * len(junk)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_queries_agree_with_sql(spark, name):
    from tests.oracle_check import duck, rows_of

    df = queries.queries()[name](spark, SF)
    result = duck(SF).execute(queries.oracle_sql()[name])
    assert rows_of(df.columns, df.collect()) == rows_of([c[0] for c in result.description], result.fetchall())
