"""Table export / restore / publish.

Export layout (one directory per table)::

    {out}/{name}/json/   data as JSON lines (optionally compressed)
    {out}/{name}/ddl/    one JSON record: table name, schema JSON, partition columns,
                         format, location, comment and the number of exported rows

The saved schema replaces DDL text: restore reads the data *with* it, so
decimal, date, timestamp, binary, map, struct and all-null columns come back
with their exact types and in their original order; timestamps keep their
microseconds, and maps whose keys are no strings travel as lists of entries.
Damaged lines fail the read, and a restore fails unless it has as many rows as
were exported; what it would replace or add to is only touched once all rows
have arrived. All data movement is done by Spark writers and readers (one
task per input split); only the one-record definition is read on the driver.
An earlier definition is removed before the data is replaced and the new one
written after it, so a failed export leaves none behind.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Iterable, Mapping, Sequence, TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanekit.functions.columns import rewrite_text
from lanekit.operators.filters import apply_conditions
from lanekit.operators.projections import derive_month
from lanekit.sources.scratch import materialize, remember_database, scratch_path, unique_name
from lanekit.sources.tables import spread

# JSON codecs accepted by Spark's text-based writers.
JSON_CODECS = ("none", "gzip", "snappy", "bzip2", "deflate", "lz4")

DEFINITION_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("schema", T.StringType()),
    T.StructField("partition_cols", T.StringType()),
    T.StructField("format", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("comment", T.StringType()),
    T.StructField("row_count", T.LongType()),
])

# Tables of a batch that are moved at the same time.
BATCH_JOBS = 4

# Patterns with all six digits of a timestamp's fraction.
TIMESTAMPS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
              "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


A, B = TypeVar("A"), TypeVar("B")


@dataclass(frozen=True)
class Definition:
    table: str
    schema: T.StructType
    partition_cols: tuple[str, ...]
    format: str | None = None
    location: str | None = None
    comment: str | None = None
    row_count: int | None = None


# ------------------------------------------------------ types JSON has no form for

def _plain_type(kind: T.DataType) -> T.DataType:
    """The type a value travels as: maps with keys other than strings are
    lists of (key, value)."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain_type(f.dataType), f.nullable) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain_type(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        value = _plain_type(kind.valueType)
        if isinstance(kind.keyType, T.StringType):
            return T.MapType(kind.keyType, value, kind.valueContainsNull)
        return T.ArrayType(T.StructType([T.StructField("key", _plain_type(kind.keyType), False),
                                         T.StructField("value", value, kind.valueContainsNull)]))
    return kind


def _convert(c: Column, kind: T.DataType, back: bool) -> Column:
    """A value of type ``kind`` to its plain form, or ``back``."""
    if _plain_type(kind) == kind:
        return c
    if isinstance(kind, T.StructType):
        fields = F.struct(*[_convert(c[f.name], f.dataType, back).alias(f.name) for f in kind.fields])
        return F.when(c.isNotNull(), fields)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _convert(x, kind.elementType, back))
    if isinstance(kind.keyType, T.StringType):
        return F.transform_values(c, lambda k, v: _convert(v, kind.valueType, back))
    entries = c if back else F.map_entries(c)
    entries = F.transform(entries, lambda e: F.struct(
        _convert(e["key"], kind.keyType, back).alias("key"), _convert(e["value"], kind.valueType, back).alias("value")))
    return F.map_from_entries(entries) if back else entries


def _converted(df: DataFrame, schema: T.StructType, back: bool) -> DataFrame:
    return df.select(*[_convert(F.col(f"`{f.name}`"), f.dataType, back).alias(f.name) for f in schema.fields])


def _frame(spark: SparkSession, table: str | DataFrame) -> DataFrame:
    return spark.table(table) if isinstance(table, str) else table


def partition_columns(spark: SparkSession, table: str | DataFrame) -> tuple[str, ...]:
    """Partition columns of a catalog table (none for a DataFrame)."""
    if not isinstance(table, str):
        return ()
    return tuple(c.name for c in spark.catalog.listColumns(table) if c.isPartition)


def export_table(spark: SparkSession, table: str | DataFrame, out_dir: str, name: str | None = None,
                 conditions: Mapping[str, Sequence[str]] | None = None, limit: int | None = None,
                 order_by: Sequence[str] | None = None, codec: str | None = None,
                 columns: Sequence[str] | None = None, min_files: int | None = None) -> str:
    """Export a table (or DataFrame) as JSON lines plus its definition.

    Conditions are applied first (``where`` then ``having``), then the
    optional ordering and row limit; the target directory is replaced.
    Compressed JSON is not splittable, so the file count bounds how many
    tasks can read the export back: a plain scan with fewer splits than
    ``min_files`` (default: the cluster's default parallelism) is spread to
    that many writers first. An ordered export keeps its order: file by file,
    and inside each. Returns the export directory ``{out_dir}/{name}``.
    """
    if name is None:
        if not isinstance(table, str):
            raise ValueError("name is required when exporting a DataFrame")
        name = table
    codec = (codec or "none").lower()
    if codec not in JSON_CODECS:
        raise ValueError(f"unsupported JSON codec {codec!r}; use one of {JSON_CODECS}")
    df = _frame(spark, table)
    if columns:
        df = df.select(*columns)
    df = apply_conditions(df, conditions)
    if order_by:
        df = df.orderBy(*order_by)
    if limit is not None:
        df = df.limit(int(limit))
    elif not order_by:
        df = spread(df, min_files)
    parts = [c for c in partition_columns(spark, table) if c in df.columns]
    about = table_properties(spark, table)
    target = f"{out_dir.rstrip('/')}/{name}"
    written = Observation()
    delete_path(spark, f"{target}/ddl")
    # ignoreNullFields=false keeps all-null columns visible in the files too
    _converted(df, df.schema, back=False).observe(written, F.count(F.lit(1)).alias("n")) \
        .write.mode("overwrite").option("compression", codec).option("ignoreNullFields", "false") \
        .options(**TIMESTAMPS).json(f"{target}/json")
    definition = spark.createDataFrame(
        [(name, df.schema.json(), json.dumps(parts), about.get("Provider"), about.get("Location"),
          about.get("Comment"), written.get["n"])], DEFINITION_SCHEMA)
    definition.coalesce(1).write.mode("overwrite").json(f"{target}/ddl")
    return target


def table_properties(spark: SparkSession, table: str | DataFrame) -> dict[str, str]:
    """Format, location and comment of a catalog table (none for a DataFrame
    or a view without them)."""
    if not isinstance(table, str):
        return {}
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    at = next((i for i, r in enumerate(rows) if r["col_name"].startswith("# Detailed")), len(rows))
    return {r["col_name"]: r["data_type"] for r in rows[at:] if r["col_name"] in ("Provider", "Location", "Comment")}


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or directory of any file system, if it is there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def side_by_side(move: Callable[[A], B], items: Iterable[A], jobs: int = BATCH_JOBS) -> list[B]:
    """``move`` of every item, ``jobs`` at a time, each with Spark jobs of its
    own; the results in the items' order. An error is raised once the items
    under way have ended; those not begun are left out."""
    with ThreadPoolExecutor(max(1, jobs)) as pool:
        running = [pool.submit(move, item) for item in items]
        try:
            return [r.result() for r in running]
        except BaseException:
            for r in running:
                r.cancel()
            raise


def export_all(spark: SparkSession, tables: Iterable[str | tuple[str, DataFrame]], out_dir: str,
               conditions: Mapping[str, Mapping[str, Sequence[str]]] | None = None, jobs: int = BATCH_JOBS,
               codec: str = "gzip", **kwargs) -> dict[str, str]:
    """Export several tables, ``jobs`` at a time; returns name -> directory.
    ``conditions`` has the conditions of each table by its name; a table
    without an entry is exported whole. JSON lines repeat every column's name,
    so a batch is compressed unless ``codec`` says otherwise."""
    named = dict(t if isinstance(t, tuple) else (t, t) for t in tables)
    found = side_by_side(lambda name: export_table(spark, named[name], out_dir, name=name,
                                                   conditions=(conditions or {}).get(name), codec=codec, **kwargs), named, jobs)
    return dict(zip(named, found))


def read_definition(spark: SparkSession, src: str,
                    rename_rules: Sequence[tuple[str, str]] = ()) -> Definition:
    """The saved definition; ``rename_rules`` (literal old -> new, each applied
    once, in order) rewrite the table name, the location and the comment."""
    d = spark.read.schema(DEFINITION_SCHEMA).json(f"{src.rstrip('/')}/ddl")
    for field in ("table", "location", "comment") if rename_rules else ():
        d = d.withColumn(field, rewrite_text(field, rename_rules))
    row = d.first()
    if row is None:
        raise FileNotFoundError(f"no table definition under {src}/ddl")
    return Definition(row["table"], T.StructType.fromJson(json.loads(row["schema"])),
                      tuple(json.loads(row["partition_cols"] or "[]")), row["format"], row["location"],
                      row["comment"], row["row_count"])


def read_export(spark: SparkSession, src: str, definition: Definition | None = None) -> DataFrame:
    """Exported rows read with the saved schema (no inference pass); a line
    that does not parse is an error."""
    d = definition or read_definition(spark, src)
    rows = spark.read.schema(_plain_type(d.schema)).options(mode="FAILFAST", **TIMESTAMPS).json(f"{src.rstrip('/')}/json")
    return _converted(rows, d.schema, back=True)


def read_json_inferred(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with an inferred schema (codec detected from the file
    extension). Inference costs an extra pass and widens types: ints become
    bigint, decimals double, dates/timestamps/binary strings."""
    return spark.read.json(path)


def ensure_database(spark: SparkSession, table: str, location: str | None = None) -> None:
    if "." in table:
        db = table.rsplit(".", 1)[0]
        loc = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")


def save_table(df: DataFrame, table: str, mode: str = "overwrite", fmt: str = "parquet",
               partition_cols: Sequence[str] = (), dynamic: bool = False, location: str | None = None,
               cluster: bool = True) -> None:
    """``saveAsTable`` with optional partitioning. ``dynamic=True`` with
    overwrite replaces only the partitions present in ``df`` (an insert into
    the existing table; ``saveAsTable`` itself would replace the table).
    ``cluster=False`` is for rows of one partition value: every task writes
    into that one anyway, so they are not shuffled by it."""
    spark = df.sparkSession
    if dynamic and mode == "overwrite" and spark.catalog.tableExists(table):
        # inserts into tables know the mode as a session setting only, which
        # would hold for others too; writers of files take it as an option
        about, parts = table_properties(spark, table), partition_columns(spark, table)
        df.select(*spark.table(table).columns).write.format(about["Provider"]).mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).save(about["Location"])
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        spark.catalog.refreshTable(table)
        return
    if partition_cols and cluster:
        # cluster rows by partition value before a partitioned write so each
        # task writes few partitions (not tasks x partitions small files);
        # REBALANCE lets adaptive execution split a hot partition value over
        # several writers and merge small ones
        df = df.hint("rebalance", *partition_cols)
    w = df.write.mode(mode).format(fmt)
    if location:
        w = w.option("path", location)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.saveAsTable(table)


def restore_table(spark: SparkSession, src: str, target: str | None = None,
                  rename_rules: Sequence[tuple[str, str]] = (), mode: str = "overwrite",
                  fmt: str | None = None, month_from: str | None = None, dynamic: bool = False,
                  create_database: bool = True, keep_location: bool = False) -> str:
    """Load an export into a table (partitioned like the source).

    The target name is ``target`` or the saved name rewritten by
    ``rename_rules``; the format is ``fmt``, the saved one or parquet. With
    ``keep_location`` the table lies at the saved location, rewritten by the
    same rules. With ``month_from`` (e.g. ``"dt"``) a ``month`` column of the
    saved schema is recomputed as ``substr(dt, 1, 6)``; a table without one
    gets none. Returns the table name.

    Fails if a line is damaged or unless as many rows arrive as were exported,
    and then leaves the target as it was. A table that is replaced is written
    beside and takes the name of the old one when it is whole. Rows for an
    existing table (append, dynamic) or a location are written to the shared
    folder first. A new table that turns out short is dropped.
    """
    d = read_definition(spark, src, rename_rules)
    name = target or d.table
    df = read_export(spark, src, d)
    if month_from and "month" in d.schema.names:
        df = derive_month(df, month_from, "month")
    parts = list(d.partition_cols)
    if parts:
        df = df.select(*[c for c in df.columns if c not in parts], *parts)
    if create_database:
        ensure_database(spark, name)
    arrived = Observation()
    df = df.observe(arrived, F.count(F.lit(1)).alias("n"))
    how = dict(fmt=fmt or d.format or "parquet", partition_cols=parts)
    location = d.location if keep_location else None

    def check_count():
        if d.row_count is not None and arrived.get["n"] != d.row_count:
            raise ValueError(f"{src}: {d.row_count} rows were exported, {arrived.get['n']} arrived for {name}")

    there = spark.catalog.tableExists(name)
    if location or there and (mode != "overwrite" or dynamic or not is_managed(spark, name)):
        whole = materialize(df, "restore")
        check_count()
        save_table(whole, name, mode=mode, dynamic=dynamic, location=location, **how)
        return name
    beside = unique_name(f"{name}__new") if there else name
    try:
        save_table(df, beside, mode="error" if there else mode, dynamic=dynamic and not there, **how)
        check_count()
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {beside}")
        raise
    if there:
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
    return name


def is_managed(spark: SparkSession, table: str) -> bool:
    return spark.catalog.getTable(table).tableType == "MANAGED"


def restore_all(spark: SparkSession, sources: Mapping[str, str] | Iterable[str],
                targets: Mapping[str, str] | None = None, jobs: int = BATCH_JOBS, **kwargs) -> dict[str, str]:
    """Restore several exports, ``jobs`` at a time: directories, or name ->
    directory as :func:`export_all` returns; ``targets`` has target tables by
    name. Returns name -> table."""
    named = dict(sources) if isinstance(sources, Mapping) else {s.rstrip("/").rsplit("/", 1)[-1]: s for s in sources}
    found = side_by_side(lambda n: restore_table(spark, named[n], target=(targets or {}).get(n), **kwargs), named, jobs)
    return dict(zip(named, found))


def preview(spark: SparkSession, table: str | DataFrame, n: int = 20, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows of a table, by ``order_by`` if given (a distributed
    top-n), with every value as text: what a person looks at beside
    :func:`describe_table`."""
    df = _frame(spark, table)
    df = df.orderBy(*order_by) if order_by else df
    return df.limit(int(n)).select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if not isinstance(
        f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.to_json(f"`{f.name}`").alias(f.name) for f in df.schema.fields])


def clone_definition(spark: SparkSession, schema: T.StructType, target: str,
                     partition_cols: Sequence[str] = (), fmt: str = "parquet", location: str | None = None) -> bool:
    """Create an empty table with this schema unless it exists. Returns True
    when it was created."""
    if spark.catalog.tableExists(target):
        return False
    ensure_database(spark, target)
    empty = spark.createDataFrame([], schema)
    cols = [f.name for f in schema.fields if f.name not in partition_cols] + list(partition_cols)
    save_table(empty.select(*cols), target, mode="ignore", fmt=fmt, partition_cols=partition_cols, location=location)
    return True


def create_from_export(spark: SparkSession, src: str, target: str | None = None,
                       rename_rules: Sequence[tuple[str, str]] = (), keep_location: bool = False) -> tuple[str, bool]:
    """Create the empty table that an export's saved definition describes
    (columns, partitions, format, comment; with ``keep_location`` also the
    rewritten location) unless it exists: (table name, created)."""
    d = read_definition(spark, src, rename_rules)
    name = target or d.table
    created = clone_definition(spark, d.schema, name, d.partition_cols, d.format or "parquet",
                               d.location if keep_location else None)
    if created and d.comment:
        text = d.comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {name} IS '{text}'")
    return name, created


def insert_rows(spark: SparkSession, df: DataFrame, target: str, overwrite: bool = False) -> None:
    """Insert by column *name*: the frame is reordered to the table's column
    order (partition columns last) before the positional ``insertInto``."""
    cols = spark.table(target).columns
    df.select(*cols).write.insertInto(target, overwrite=overwrite)


def publish(df: DataFrame, table: str, partition_cols: Sequence[str] = ("dt",), fmt: str = "orc",
            mode: str = "append", cluster: bool = True) -> None:
    """Append a result to a partitioned (ORC by default) table; the table is
    created on first use. ``cluster`` as in :func:`save_table`."""
    save_table(df, table, mode=mode, fmt=fmt, partition_cols=partition_cols, cluster=cluster)


def describe_table(spark: SparkSession, table: str | DataFrame) -> DataFrame:
    """One row per column: name, type, nullability, position, whether it is
    a partition column, and the table's row count (a distributed count)."""
    df = _frame(spark, table)
    parts = set(partition_columns(spark, table))
    n = df.count()
    rows = [(f.name, f.dataType.simpleString(), f.nullable, i + 1, f.name in parts, n)
            for i, f in enumerate(df.schema.fields)]
    schema = "col_name string, data_type string, nullable boolean, ordinal int, " \
             "is_partition boolean, row_count bigint"
    return spark.createDataFrame(rows, schema)


def scratch_database(spark: SparkSession, prefix: str = "lanekit") -> str:
    """A new, uniquely named database located below the shared scratch root."""
    name = unique_name(prefix)
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    remember_database(spark, name)
    return name


def use_database(spark: SparkSession, database: str) -> str:
    """Make ``database`` current; returns the one that was."""
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)
    return before


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Catalog listing as a DataFrame: name, database, type and whether it is
    a temp view, of ``database`` or the current one."""
    rows = [(t.name, t.database, t.tableType, t.isTemporary)
            for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "name string, database string, table_type string, "
                                       "is_temporary boolean")
