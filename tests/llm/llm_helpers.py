"""Frames for the training-data operators' tests."""

import random

from pyspark.sql import types as T

from meteocube.llm import common

WORDS = "the river carries small boats past quiet houses where people read letters near open windows every calm evening".split()


def prose(n, seed=0):
    """n words that vary with the seed."""
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ly", "ed", "ing", "er"]) for _ in range(n))


def ship(spark):
    """The package's folder on the Python workers' path, as table() puts it there."""
    try:
        common.table(spark, "/nonexistent", "x")
    except Exception:
        pass


def docs_df(spark, rows, **extra):
    """documents with (doc_id, text) rows; extra: further columns with a constant text."""
    ship(spark)
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), *[(k, T.StringType()) for k in extra]]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    return spark.createDataFrame([(i, t, *extra.values()) for i, t in rows], schema)


#: Nulls, empty and blank texts, an unsplit run, a long text, repeated rows, white space of many kinds.
EDGE = [
    (1, prose(80)),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b\x0c\r "),
    (5, "x" * 30000),
    (6, prose(12000, 3)),
    (7, prose(80, 1)),
    (7, prose(80, 1)),
    (None, prose(60, 2)),
    (8, "a  b   c\n\n d\te f g \u0085h  "),
    (9, " leading and trailing "),
    (10, "don't WE'LL I'm <|endoftext|> x<|startoftext|>y 12345 ٣٤ ½ é é ﬁ Σας ΟΔΟΣ 漢字かな 👩‍👩‍👧 � ~0~1"),
    (11, "line one here\nline one here\n\nline one here\n  \nother"),
]


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: [(x is not None, str(x)) for x in r])
