"""Helpers shared by the operators: word rules, staging, column access."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lanekit.sources.scratch import materialize

#: A word is a run of characters other than blank and U+0009-U+000D.
#: ``bytes.split()`` without arguments cuts on exactly these six characters.
WORD = r"[^\x20\x09-\x0D]+"


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and scanned back."""
    return materialize(df, f"llm-{name}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(prefix: str) -> str:
    """A column name that cannot clash with a caller's column."""
    return f"__{prefix}_{uuid.uuid4().hex[:8]}"


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def learnable(doc_id: Column) -> Column:
    """Rows a classifier may learn from: crc32 of the id's text, modulo 3, is
    not 1 (a null id is never learned from)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1, F.lit(False))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def first_by_hash(rows: DataFrame, group: str, sizes: dict, n: int, salt: str, key: str = "doc_id") -> DataFrame:
    """The ``n`` rows of each group that come first in an order by a hash of
    ``key``, numbered in column ``turn``. ``sizes`` has the rows per group.

    Hashes are uniform, so about ``4 * n`` rows per group pass a threshold
    that follows from its size, wherever they lie; only these are ranked.
    (That fewer than ``n`` pass is beyond chance for ``n`` of some dozens.)
    Rows must differ in the key within a group, or one hot key passes whole.
    """
    code = F.xxhash64(F.lit(salt), key)
    share = F.pmod(code, F.lit(1 << 31)) / F.lit(float(1 << 31))
    kind = rows.schema[group].dataType.simpleString()
    limits = rows.sparkSession.createDataFrame(
        [(value, min(1.0, 4.0 * max(n, 100) / size)) for value, size in sizes.items()], f"{group} {kind}, __limit double")
    order = W.partitionBy(group).orderBy(code, key)
    # a number per group
    return (rows.join(F.broadcast(limits), group).filter(share < F.col("__limit")).select(*rows.columns)
            .withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= n))
