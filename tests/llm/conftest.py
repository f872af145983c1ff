import random

import pytest
from pyspark.sql import Row

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


@pytest.fixture(scope="session")
def hard_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows, several scripts."""
    long = prose(30_000, 1)
    texts = {
        1: "Same Text here, and more of it.", 2: "same text HERE, and more of it.", 3: None, 4: "", 5: " \t\n\x0b", 6: long, 7: long + " end",
        8: "É é ß Ünï", 9: "é é ß ünï", 10: "日本語 テキスト 😀 emoji", 11: "one", 12: "one two", 13: prose(200, 2), 14: prose(200, 2) + "x",
        15: "\x1c odd \x85 spaces here too", 16: prose(60, 3), 17: prose(60, 4), 2**40: prose(60, 3),
    }
    rows = [(i, t, "en", ("b", "a", None, "c")[i % 4], None if i % 5 == 0 else 7) for i, t in texts.items()]
    rows += [rows[0], rows[0], (None, "no id", None, None, None), (None, "Same text here, and more of it.", None, "a", None), (13, "other text under the same id", "en", "a", 3)]
    return rows


@pytest.fixture(scope="session")
def hard(spark, hard_rows):
    """The rows with further columns that carry names an operator might use itself."""
    extra = ["id", "digest", "sha", "node", "ids", "fp", "key", "size", "kept", "best", "length", "bucket", "copy", "label", "score", "tag", "rules", "hash", "found", "__row"]
    frame = spark.createDataFrame(hard_rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return frame.selectExpr("*", *[f"cast(null as string) as `{c}`" for c in extra])


@pytest.fixture(scope="session")
def none(hard):
    return hard.limit(0)


def plain(rows: list[Row]) -> list[tuple]:
    """Rows as tuples in an order that nulls do not upset."""
    return sorted((tuple(r) for r in rows), key=repr)
