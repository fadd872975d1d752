"""Aggregates and table functions written in Python, called by name in SQL steps.

A table function (a class that ``pyspark.sql.functions.udtf`` takes, with its
return type) is called on a table and, with ``PARTITION BY``, sees each group's
rows in order::

    SELECT * FROM first_alerts(TABLE(events) PARTITION BY (cust, day) ORDER BY ts)

An aggregate ``f`` becomes two of them. ``f_partial`` sums up the rows of a task
before they move, ``f`` merges what the tasks have of a group::

    SELECT * FROM f(TABLE(SELECT * FROM f_partial(TABLE(SELECT k AS key, v AS value FROM t))) PARTITION BY key)

so that of a hot key one state a task is shuffled, not its rows. Prefer the
built-in aggregates: a row costs a call in Python here. Rows reach Python in
Arrow batches, a column at a time; only ``add`` is called per row.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.conversion import ArrowTableToRowsConversion, LocalDataToArrowConversion
from pyspark.sql.pandas.types import from_arrow_schema

PARTIAL = "_partial"


@dataclass(frozen=True)
class Aggregate:
    """``add(state, value)`` takes in a row (``state`` is None at first),
    ``merge(state, state)`` must give what adding the rows of both would, in
    any order, and ``finish(state)`` is the result. States must stay small.

    ``key`` and ``returns`` are SQL types. A task holds ``held`` groups and
    passes all on when there are more. A null key is a group; null values are
    given to ``add``."""

    add: Callable[[Any, Any], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], Any]
    returns: str
    key: str = "bigint"
    held: int = 50_000


def _column(batch: pa.RecordBatch, name: str) -> list:
    """Python values of a column, as a function called by rows would get them."""
    column = batch.column(name)
    if pa.types.is_nested(column.type) or pa.types.is_timestamp(column.type):
        one = pa.table({name: column})
        return [r[0] for r in ArrowTableToRowsConversion.convert(one, from_arrow_schema(one.schema))]
    if not column.null_count and (pa.types.is_integer(column.type) or pa.types.is_floating(column.type)):
        return column.to_numpy(zero_copy_only=False).tolist()
    return column.to_pylist()


def partial_function(spec: Aggregate):
    schema = T.StructType.fromDDL(f"key: {spec.key}, state: binary")

    class Partial:
        def __init__(self):
            self.states = {}

        def _passed_on(self):
            rows = [(key, pickle.dumps(state)) for key, state in self.states.items()]
            self.states = {}
            return LocalDataToArrowConversion.convert(rows, schema, False)

        def eval(self, batch):
            add, states, held = spec.add, self.states, spec.held
            for key, value in zip(_column(batch, "key"), _column(batch, "value")):
                states[key] = add(states.get(key), value)
                if len(states) >= held:
                    yield self._passed_on()
                    states = self.states

        def terminate(self):
            if self.states:
                yield self._passed_on()

    return F.arrow_udtf(Partial, returnType=schema)


def merging_function(spec: Aggregate):
    schema = T.StructType.fromDDL(f"key: {spec.key}, result: {spec.returns}")

    class Merged:
        def __init__(self):
            self.key, self.state, self.any = None, None, False

        def eval(self, batch):
            for packed in batch.column("state").to_pylist():
                state = pickle.loads(packed)
                self.state = spec.merge(self.state, state) if self.any else state
                self.any = True
            if batch.num_rows:
                self.key = _column(batch.slice(0, 1), "key")[0]
            return iter(())

        def terminate(self):
            if self.any:
                yield LocalDataToArrowConversion.convert([(self.key, spec.finish(self.state))], schema, False)

    return F.arrow_udtf(Merged, returnType=schema)


def register_table_functions(spark: SparkSession, functions: Mapping[str, object] | None) -> None:
    """Registers table functions by name: what ``F.udtf`` gives, or a pair of
    a class and its return type."""
    for name, fn in (functions or {}).items():
        spark.udtf.register(name, F.udtf(fn[0], returnType=fn[1]) if isinstance(fn, tuple) else fn)


def register_aggregates(spark: SparkSession, aggregates: Mapping[str, Aggregate] | None) -> None:
    """Registers ``name_partial`` and ``name`` for each aggregate."""
    for name, spec in (aggregates or {}).items():
        register_table_functions(spark, {name + PARTIAL: partial_function(spec), name: merging_function(spec)})


def call(name: str, rows: str) -> str:
    """SQL that applies the aggregate ``name`` to ``rows``, a query of ``key``
    and ``value``."""
    return f"SELECT * FROM {name}(TABLE(SELECT * FROM {name}{PARTIAL}(TABLE({rows}))) PARTITION BY key)"
