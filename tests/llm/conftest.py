import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Cases that every operator over texts meets: null, empty, blank, odd white space, ties, repeated rows, a null id, a long text.
ODD = [None, "", " \n\t ", "word", "two words", "É  ü\n\nx\x0by", "A b c A b c\nA b c\n", "same text here", "same text here", "x" * 5000, "ab " * 4000, "naïve 日本語 テキスト ½ «q»"]


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, n_words, part): extra columns whose names the operators use themselves."""
    return [(i, t, -1, "p") for i, t in enumerate(ODD)] + [(None, "no id", -1, "p"), (3, "word", -1, "p")]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, "doc_id long, text string, n_words int, part string")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def corpus(spark):
    """Synthetic texts with copies, near copies and shared passages."""
    rnd = random.Random(1)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(400)]
    passage = [rnd.choice(words) for _ in range(60)]
    rows = []
    for i in range(120):
        w = [rnd.choice(words) for _ in range(rnd.randint(0, 160))]
        if i % 7 == 0:
            at = rnd.randint(0, len(w))
            w = w[:at] + passage[: rnd.randint(45, 60)] + w[at:]
        if i % 11 == 10:
            w = rows[-3][1].split()
            if i % 2:
                w = w[: len(w) // 2] + ["changed"] + w[len(w) // 2 + 1 :]
        rows.append((i, " ".join(w) if i % 5 else "\n".join(w)))
    return rows


@pytest.fixture(scope="session")
def corpus_df(spark, corpus):
    return spark.createDataFrame(corpus, "doc_id long, text string").repartition(3)
