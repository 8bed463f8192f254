import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _words string, quality string, mix string, pii string"


def corpus():
    """Small documents with copies, near copies, junk, nulls, ties and a long text."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9)))
    prose = lambda n: ". ".join(" ".join(word() for _ in range(9)).capitalize() for _ in range(max(1, n // 9))) + "."
    texts = [None, "", " \n\t ", "one two three", "one two three", "Ünïcode wörds – here too"]
    base = prose(200)
    texts += [base, base]
    for changes in (1, 2, 3, 4, 6, 9, 30):
        w = base.split()
        for _ in range(changes):
            w[r.randrange(len(w))] = word()
        texts.append(" ".join(w))
    texts += [prose(r.randint(10, 120)) for _ in range(40)]
    texts += ["a b c d e f g h i j " * 30, "SHOUT!! LOUD!! " * 30, "### $$$ % & | < > x y z w v u", prose(30000)]
    texts += [prose(40) + "\n" + "Line that repeats here.\n" * 3]
    return [(i, t, r.choice(["en", "de", None]), r.choice(["src0", "src1", None]), 7, "x", "y", "z", "p") for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark):
    rows = corpus()
    return spark.createDataFrame([*rows, rows[9], (None, rows[6][1], None, None, None, None, None, None, None)], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
