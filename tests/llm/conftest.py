import random

import pytest

TEXTS = "doc_id long, text string, lang string, source string, n_chars long, id long, rep long, u long, words string"


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefg") for _ in range(rnd.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text): nulls, empty and blank texts, short and long ones, copies, near copies, shared passages, ties."""
    rnd = random.Random(11)
    base, passage = words(rnd, 160), words(rnd, 70)
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one two"), (4, "one two"), (5, "One  two\n")]
    rows += [(10 + i, base) for i in range(4)] + [(20 + i, base.replace(" ", " x ", 1 + i % 2)) for i in range(4)]
    rows += [(30 + i, f"{words(rnd, 30 + i)}\n{passage}\n{words(rnd, 25)}") for i in range(5)]
    rows += [(40, "same same " * 300), (41, "same same " * 200), (42, words(rnd, 6000)), (43, "é" * 500 + " ñandú. " + words(rnd, 60))]
    lines = [words(rnd, 8) for _ in range(9)]
    rows += [(50, "\n".join(lines)), (51, "\n".join([words(rnd, 5), "", *lines[2:7], words(rnd, 5)])), (52, "\n".join(["a"] * 7))]
    rows += [(60 + i, words(rnd, 40)) for i in range(20)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with clashing extra columns, and one repeated row."""
    rows = [(i, t, ("en", "de", None)[i % 3], "s", len(t or ""), 7, 8, 9, "w") for i, t in [*texts, texts[6]]]
    return spark.createDataFrame(rows, TEXTS).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], TEXTS)
