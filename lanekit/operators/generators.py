"""Generators: array explode and text-to-lines flat map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_values(df: DataFrame, array_col: str, out: str) -> DataFrame:
    """``LATERAL VIEW explode(array_col) t AS out``: rows with a null or empty
    array produce no output row."""
    return df.select("*", F.explode(F.col(array_col)).alias(out))


def flat_map_lines(df: DataFrame, text_col: str, out: str = "line", sep: str = "\n",
                   with_position: bool = False) -> DataFrame:
    """One row per line of a text column (literal separator)."""
    parts = F.split(F.col(text_col), "\\Q" + sep + "\\E")
    if with_position:
        return df.select("*", F.posexplode(parts).alias("line_no", out))
    return df.select("*", F.explode(parts).alias(out))
