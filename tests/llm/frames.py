"""Small document tables with every awkward case."""

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, tag int, score string, h int, cut string, passes int, place string, row int"


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows are (doc_id, text) or (doc_id, text, source); the other columns have names that operators use inside."""
    full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None, "x", 1, "y", 2, "z", 3, "p", 4) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def awkward() -> list[tuple]:
    words = [f"w{k}" for k in range(120)]
    long = " ".join(f"v{k % 977}x{k % 13}" for k in range(30_000))
    return [
        (1, " ".join(words)),
        (2, "\n".join(words[:110]) + "\tother  end"),
        (3, None),
        (4, ""),
        (5, " \t\n\x0b\x0c\r "),
        (6, "one"),
        (7, "one two three four five six"),
        (8, long),
        (9, long + " tail"),
        (10, "a b " * 60),
        (11, "Ünïcode ﻿x y   z ß İ . ,.,! don't a.b"),
        (None, "one two three four five six"),
        (None, None),
        (7, "one two three four five six"),
        (7, "another text under a known number"),
        (12, "onetwothreefourfivesix"),
        (13, " ".join(words)),
        (-5, " ".join(words)),
    ]
