import random

import pytest

ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, s string, row long, size long, set_id long, bucket long, id long, part long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, ties, repeated rows, near copies, a very long text, and clashing columns."""
    rnd = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "bcdfghklmn" for b in ("a", "e", "io", "uran", "ént", "öl")]
    texts = [None, "", " \t\n ", "one", "One two", "ONE TWO", "a b c d e", "a b c d e f", "x" * 3000, "日本語 テキスト", "> quoted | | $$$"]
    for i in range(40):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randrange(3, 160))]
        texts.append(" ".join(words))
        if i % 4 == 0:
            copy = list(words)
            copy[rnd.randrange(len(copy))] = "changed"
            texts += ["  ".join(copy), " ".join(words).upper() + "\n"]
    long = [rnd.choice(vocabulary) for _ in range(30_000)]
    texts += [" ".join(long), "\n".join([*long, "end"])]
    texts += ["same line here and more words\n" * 12, "Wort Wort Wort Wort Wort Wort Wort Wort Wort Wort Wort Wort"]
    sources = ["hot"] * 3 + ["b", None, "é"]
    rows = [(i * 7, t, "en", sources[i % 6], None, "s", 1, 2, 3, 4, 5, 6) for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], (None, "no id but some words in a row", None, None, None) + (None,) * 7]
    return spark.createDataFrame(rows, ODD_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
