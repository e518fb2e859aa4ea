"""A small table with everything that is awkward: NULLs, empties, ties, repeats, clashing names."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " _doc string, _text long, node int, kept string, size double, start int, score string"
)
WORDS = "the of and tion ing ent ever there mañana über naïve end stone river light".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(words))


def texts() -> list[tuple[int | None, str | None, str | None]]:
    """(doc_id, text, source)."""
    base = prose(1, 120)
    some = base.split(" ")
    near = [" ".join(some[:i] + ["changed"] + some[i + 1 :]) for i in (5, 60, 115)]
    long = "\n".join(prose(100 + i, 40) for i in range(400))
    found: list[tuple[int | None, str | None, str | None]] = [
        (1, base, "b"), (2, base, "a"), (3, near[0], "a"), (4, near[1], None), (5, near[2], "b"),
        (6, None, "a"), (7, "", "a"), (8, " \n\t ", None), (9, "one two three", "c"), (10, "One\ttwo THREE", "c"),
        (11, long, "a"), (12, prose(2, 30) + "\n" + "Shared line\n" * 3, "a"), (None, base, "b"), (None, None, None),
        (13, prose(3, 50), "a"), (13, prose(3, 50), "a"), (14, "x " * 60, "z"), (15, "A! " * 40, "z"), (-7, prose(4, 25), "a"),
    ]
    found += [(20 + i, prose(200 + i, 22) + "\n  SHARED line \t\n" + prose(300 + i, 5), "src") for i in range(12)]
    return found


def messy(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    made = [
        (i, t, None, s, None if t is None else len(t), "x", None, 1, "kept", 0.5, None, "s")
        for i, t, s in (texts() if rows is None else rows)
    ]
    return spark.createDataFrame(made, COLUMNS).repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return messy(spark, [])
