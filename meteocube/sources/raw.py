"""Raw observation readers.

CSV is read exactly as text (every column STRING, header on), like a raw
drop of station files, and then typed with ``try_cast``: a bad number becomes
NULL instead of failing the job (D11), and ``typed_with_bad_text`` counts
how many did.  Rows whose key fields (time or a coordinate) are NULL after typing are
rejects (D10, see ``operators.hourly.split_rejects``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RAW_SCHEMA


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, all columns as text (schema from the header, no inference)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def _typed(text_df: DataFrame, schema: T.StructType) -> dict[str, F.Column]:
    return {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields if f.name in text_df.columns}


def type_raw(text_df: DataFrame, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Cast the known raw columns to their types; other columns pass through as text."""
    return text_df.withColumns(_typed(text_df, schema))


def read_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Header CSV directory -> typed raw observations."""
    return type_raw(read_csv_text(spark, path), schema)


def typed_with_bad_text(text_df: DataFrame, schema: T.StructType = RAW_SCHEMA) -> tuple[DataFrame, list[str], dict[str, F.Column]]:
    """The typed rows with mask columns of their bad texts; the masks' names; and per typed column the count of its bad texts.

    A text is bad when it is not blank and did not parse.  A mask holds one bit for each of 63 columns, so that the
    counts can be taken wherever the rows pass, without reading the text again.
    """
    typed = _typed(text_df, schema)
    masks, counts, names = {}, {}, list(typed)
    for at in range(0, len(names), 63):
        mask = f"_bad_text_{at}"
        while mask in text_df.columns:
            mask += "_"
        bits = [F.when((F.trim(c) != "") & typed[c].isNull(), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")) for k, c in enumerate(names[at : at + 63])]
        masks[mask] = reduce(lambda a, b: a + b, bits)
        counts |= {c: F.count_if(F.col(mask).bitwiseAND(F.lit(1 << k).cast("long")) != 0) for k, c in enumerate(names[at : at + 63])}
    return text_df.withColumns({**masks, **typed}), list(masks), counts


def register_views(tables: dict[str, DataFrame]) -> None:
    """Expose tables to ``spark.sql`` under the given names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
