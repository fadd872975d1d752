"""Ordered, switchable SQL view steps.

Each enabled, non-blank step is analysed by ``spark.sql`` and registered as a
temp view under its name; nothing executes until the caller acts on a result,
so all steps are optimised together as one Catalyst plan (views are inlined,
filters and projections pushed through them).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lanekit.plans.step_functions import Aggregate, register_aggregates, register_table_functions


@dataclass(frozen=True)
class Step:
    """One named step. ``materialize=True`` writes the step's result once to
    the shared checkpoint folder and registers the view over those files: a
    step read by many later steps is then computed once, and its lineage is
    cut (a fault-tolerant counterpart of ``CACHE TABLE``)."""

    name: str
    sql: str | Callable[[SparkSession], DataFrame]
    enabled: bool = True
    description: str = ""
    materialize: bool = False

    @property
    def blank(self) -> bool:
        if not self.name or not self.name.strip():
            return True
        return isinstance(self.sql, str) and not self.sql.strip()


# SQL body of ``route_segments(schedule, factor)``: the same rule as
# :func:`lanekit.functions.columns.route_segments`, as a SQL function so SQL
# steps can call it without a Python UDF. The stops, their distinct names and
# the pattern are lambda arguments: each is computed once for a schedule.
ROUTE_SEGMENTS_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION route_segments(schedule STRING, factor DOUBLE)
RETURNS ARRAY<STRING>
RETURN CASE
  WHEN schedule IS NULL THEN CAST(NULL AS ARRAY<STRING>)
  ELSE get(transform(array(split(schedule, '-')), stops -> CASE
    WHEN size(stops) >= 2 THEN get(transform(
      transform(array(array_distinct(stops)), names -> array_join(transform(
        transform(stops, s -> array_position(names, s)),
        at -> concat(chr((at - 1) % 26 + 65),
                     CASE WHEN at > 26 THEN CAST((at - 1) DIV 26 AS STRING) ELSE '' END)), '-')),
      mode -> transform(sequence(1, size(stops) - 1),
        k -> concat_ws('*', mode, concat(get(stops, k - 1), '-', get(stops, k)),
                       CAST(CAST(factor AS DOUBLE) AS STRING), CAST(k AS STRING)))), 0)
    ELSE CAST(array() AS ARRAY<STRING>) END), 0)
END
"""


def register_sql_functions(spark: SparkSession) -> None:
    """Register lanekit's SQL-bodied functions (JVM-side, no Python)."""
    spark.sql(ROUTE_SEGMENTS_SQL)


def register_udfs(spark: SparkSession, udfs: Mapping[str, object] | None) -> None:
    """Register user functions for SQL steps. Values are either a SQL
    ``CREATE ... FUNCTION`` statement (kept on the JVM), a Spark UDF / Pandas
    UDF object, or ``(python_function, return_type)``."""
    for name, fn in (udfs or {}).items():
        if isinstance(fn, str):
            spark.sql(fn)
        elif isinstance(fn, tuple):
            func, rtype = fn
            spark.udf.register(name, func, rtype if isinstance(rtype, T.DataType) else T._parse_datatype_string(rtype))
        else:
            spark.udf.register(name, fn)


def run_views(spark: SparkSession, steps: Iterable[Step | tuple | Mapping],
              udfs: Mapping[str, object] | None = None, table_functions: Mapping[str, object] | None = None,
              aggregates: Mapping[str, Aggregate] | None = None) -> dict[str, DataFrame]:
    """Register every enabled, non-blank step as a temp view, in order.

    Steps may be :class:`Step`, ``(name, sql)`` / ``(name, sql, enabled)``
    tuples or mappings with ``name``, ``sql``, ``enabled`` and
    ``description``. Returns the step DataFrames by name (in order).
    ``table_functions`` and ``aggregates`` (see ``step_functions``) can be
    called by name in the steps.
    """
    register_sql_functions(spark)
    register_udfs(spark, udfs)
    register_table_functions(spark, table_functions)
    register_aggregates(spark, aggregates)
    out: dict[str, DataFrame] = {}
    for raw in steps:
        step = _as_step(raw)
        if not step.enabled or step.blank:
            continue
        df = step.sql(spark) if callable(step.sql) else spark.sql(step.sql)
        if step.materialize:
            from lanekit.sources.scratch import materialize
            df = materialize(df, f"step_{step.name}")
        df.createOrReplaceTempView(step.name)
        out[step.name] = df
    return out


# The element names of a step file.
STEP_TAGS = {"step": "property", "name": "sql.name", "sql": "sql.value", "enabled": "sql.enable",
             "description": "sql.description"}


def steps_from_xml(source: str) -> list[Step]:
    """Read SQL steps from an XML property file (path or text): each
    ``<property>`` holds ``sql.name``, ``sql.value``, ``sql.enable`` and
    ``sql.description``. Steps keep file order; blank and disabled ones are
    skipped later by :func:`run_views`. This parses a small config file on
    the driver; the steps themselves run on Spark."""
    import os
    import xml.etree.ElementTree as ET

    text = open(source, encoding="utf-8").read() if os.path.exists(source) else source
    steps = []
    for prop in ET.fromstring(text).iter(STEP_TAGS["step"]):
        def field(tag: str) -> str:
            node = prop.find(STEP_TAGS[tag])
            return (node.text or "").strip() if node is not None else ""
        enabled = field("enabled").lower() != "false"
        steps.append(Step(field("name"), field("sql"), enabled, field("description")))
    return steps


def last_view(views: Mapping[str, DataFrame]) -> DataFrame:
    if not views:
        raise ValueError("no enabled step")
    return list(views.values())[-1]


def _as_step(raw) -> Step:
    if isinstance(raw, Step):
        return raw
    if isinstance(raw, Mapping):
        enabled = raw.get("enabled", True)
        if isinstance(enabled, str):
            enabled = enabled.strip().lower() == "true"
        return Step(raw.get("name") or "", raw.get("sql") or "", bool(enabled),
                    raw.get("description") or "", bool(raw.get("materialize", False)))
    name, sql, *rest = raw
    return Step(name or "", sql or "", bool(rest[0]) if rest else True)
