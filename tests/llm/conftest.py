from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice("bcdfgl") + rng.choice("aeiou") + str(rng.randrange(40)) for _ in range(words))


def cases() -> list[tuple]:
    """Copies, near copies, shared passages, nulls, empty, odd white space, a long text."""
    rng = random.Random(7)
    texts = [". ".join(sentence(rng, 9) for _ in range(rng.randrange(1, 14))) + "." for _ in range(40)]
    shared = sentence(rng, 70)
    texts[3] = texts[2]
    texts[5] = texts[4].replace(" ", "\n", 1)
    texts[6] = texts[7] + " " + shared
    texts[8] = shared + " " + texts[9]
    texts[10] = " ".join(texts[11].split(" ")[:-1] + ["changed"])
    texts[12] = "again " * 200
    texts[13] = "  two  spaces\t\tand one é中\U0001f600 "
    texts[14], texts[15], texts[16] = None, "", "\n \n"
    texts[17] = ". ".join(sentence(rng, 12) for _ in range(900))
    texts[18] = "WORD Word word wOrd"
    rows = [(i, t, "en", f"s{i % 4}" if i % 9 else None, len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[2], rows[14]]


@pytest.fixture(scope="session")
def rows():
    return cases()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The cases, with a column whose name an operator might use itself."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.withColumn("key", F.lit("x")).withColumn("tid", F.lit(1)).withColumn("sha", F.lit(None).cast("string"))


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
