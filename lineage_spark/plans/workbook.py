"""Workbooks: user transforms ``f(df1, ..., dfn) -> df`` bound by dataset name.

Transforms are registered with a decorator and resolved lazily by name, so a
whole workbook becomes one Spark plan that Catalyst optimizes end to end (filters
of a late step reach the scans of an early one). Only the steps needed for the
requested outputs are built. A step that several of them read (its out-degree in the needed part of the step graph,
a requested output counting as a reader) is written once and read back; any other step stays part of its reader's plan, unless it
asks to be materialized.

Arguments are bound by name: the name of a parameter is the name of the dataset it reads, or ``inputs`` maps
parameters to datasets. Parameters that are named otherwise take the remaining datasets in order.

Example::

    wb = Workbook(spark)
    wb.dataset("orders", orders_df)

    @wb.transform(output="finished", inputs=["orders"])
    def finished(orders):
        return orders.filter("o_orderstatus = 'F'")

    wb.resolve("finished")
"""

from __future__ import annotations

import inspect
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineage_spark.operators import lineage
from lineage_spark.session import scratch_path


@dataclass
class Step:
    name: str
    output: str
    inputs: list[str]  # datasets in the order of ``args``
    fn: Callable[..., object]
    idx: int
    materialize: bool = False
    schema: object = None
    args: list[str] = field(default_factory=list)


def bind(fn: Callable[..., object], inputs: list[str] | dict[str, str]) -> tuple[list[str], list[str]]:
    """Parameters and datasets of a transform, in signature order.

    A mapping binds parameters to datasets. Of a list, a dataset named like a parameter is bound to it, wherever it stands,
    and the others fill the remaining parameters in order. Every parameter without a default must be bound. A function with
    positional-only or starred parameters takes the datasets as listed.
    """
    parameters = list(inspect.signature(fn).parameters.values())
    if any(p.kind in (p.VAR_POSITIONAL, p.POSITIONAL_ONLY) for p in parameters):
        if isinstance(inputs, dict):
            raise ValueError(f"{fn.__name__}: parameters without names cannot be bound by name")
        return [], list(inputs)
    names = [p.name for p in parameters if p.kind != p.VAR_KEYWORD]
    if not isinstance(inputs, dict):
        named = [i for i in dict.fromkeys(inputs) if i in names]
        rest = list(inputs)
        for i in named:
            rest.remove(i)
        free = [n for n in names if n not in named]
        if len(rest) > len(free):
            raise ValueError(f"{fn.__name__}({', '.join(names)}): no parameter for {rest[len(free):]}")
        inputs = {**{i: i for i in named}, **dict(zip(free, rest))}
    unknown = [a for a in inputs if a not in names]
    missing = [p.name for p in parameters if p.name in names and p.default is p.empty and p.name not in inputs]
    if unknown or missing:
        raise ValueError(f"{fn.__name__}({', '.join(names)}): no parameter {unknown}, nothing bound to {missing}")
    bound = [n for n in names if n in inputs]
    return bound, [inputs[n] for n in bound]


@dataclass
class Workbook:
    spark: SparkSession
    datasets: dict[str, DataFrame] = field(default_factory=dict)
    steps: dict[str, Step] = field(default_factory=dict)
    _cache: dict[str, DataFrame] = field(default_factory=dict)
    _stored: set[str] = field(default_factory=set)

    def dataset(self, name: str, df, schema=None) -> None:
        """Register an external input (a DataFrame, or pandas/list rows; ``schema`` for rows that may be empty)."""
        self.datasets[name] = as_table(self.spark, df, schema)

    def transform(self, output: str, inputs: list[str] | dict[str, str] | None = None, materialize: bool = False, schema=None):
        """Decorator registering ``fn`` as the producer of ``output`` (see :func:`bind`); ``schema`` is that of returned rows."""

        def register(fn):
            if output in self.steps:
                raise ValueError(f"dataset {output!r} already has a producer")
            args, bound = bind(fn, inputs or [])
            if output in bound:
                raise ValueError(f"step {fn.__name__!r} reads its own output {output!r}")
            self.steps[output] = Step(fn.__name__, output, bound, fn, len(self.steps) + 1, materialize, schema, args)
            return fn

        return register

    def transforms_table(self) -> DataFrame:
        """The workbook as a transform table (see :mod:`lineage_spark.operators.lineage`)."""
        rows = [
            (s.name, s.idx, s.output, [(i + 1, a, d) for i, (a, d) in enumerate(zip(s.args or s.inputs, s.inputs))])
            for s in self.steps.values()
        ]
        schema = T.StructType([
            T.StructField("name", T.StringType()),
            T.StructField("idx", T.IntegerType()),
            T.StructField("output_rid", T.StringType()),
            T.StructField("inputs", T.ArrayType(T.StructType([
                T.StructField("pos", T.IntegerType()),
                T.StructField("arg", T.StringType()),
                T.StructField("rid", T.StringType()),
            ]))),
        ])
        return self.spark.createDataFrame(rows, schema)

    def order(self) -> DataFrame:
        """Run order of the steps, ``(step, idx, pass, seq)``."""
        return lineage.topological_order(self.transforms_table())

    def verify(self, targets: dict[str, object]) -> DataFrame:
        """Compare produced datasets with target copies: one report row per name
        (see :func:`lineage_spark.operators.compare.verify_report`). A name this
        workbook cannot produce gets the default status."""
        from lineage_spark.operators.compare import verify_report

        known = {name for name in targets if name in self.steps or name in self.datasets}
        shared = self.shared([n for n in targets if n in known])
        # made inside the report, so that a step that fails costs only its own row
        pairs = [(name, target, (lambda n=name: self._made(n, shared)) if name in known else None) for name, target in targets.items()]
        return verify_report(self.spark, pairs)

    def shared(self, names: list[str]) -> set[str]:
        """Steps that more than one of the needed steps and requested ``names`` read."""
        readers, seen, todo = Counter(dict.fromkeys(names, 1)), set(), list(names)
        while todo:
            name = todo.pop()
            if name in seen or name not in self.steps:
                continue
            seen.add(name)
            used = set(self.steps[name].inputs)  # a step that reads a dataset twice is one reader
            readers.update(used)
            todo += used
        return {name for name, n in readers.items() if n > 1 and name in self.steps}

    def resolve(self, name: str) -> DataFrame:
        """The DataFrame of dataset ``name``, building producers on demand."""
        return self.resolve_all([name])[name]

    def resolve_all(self, names: list[str]) -> dict[str, DataFrame]:
        """The DataFrames of several datasets; what they share is computed once."""
        shared = self.shared(names)
        return {name: self._made(name, shared) for name in names}

    def _made(self, name: str, shared: set[str], _stack: tuple[str, ...] = ()) -> DataFrame:
        if name in self._cache and (name not in shared or name in self._stored):
            return self._cache[name]
        if name in _stack:
            raise ValueError("cycle: " + " -> ".join((*_stack, name)))
        if name in self.steps:
            step = self.steps[name]
            out = self._cache.get(name)
            if out is None:
                values = [self._made(i, shared, (*_stack, name)) for i in step.inputs]
                out = step.fn(**dict(zip(step.args, values))) if step.args else step.fn(*values)
                out = as_table(self.spark, out, step.schema)
            if step.materialize or name in shared:
                path = scratch_path(self.spark, step.output)
                out.write.parquet(path)
                out = self.spark.read.schema(out.schema).parquet(path)
                self._stored.add(name)
        elif name in self.datasets:
            out = self.datasets[name]
        else:
            raise KeyError(f"no dataset or producer named {name!r}")
        self._cache[name] = out
        return out


def as_table(spark: SparkSession, value, schema=None) -> DataFrame:
    """Tabular coercion of a step input/output.

    A DataFrame passes; pandas frames and lists of rows become DataFrames, categorical (factor) columns as strings; a scalar
    becomes a one-row ``value`` column. An empty list has no columns of its own, so it needs a ``schema``. Anything else is rejected.
    """
    if isinstance(value, DataFrame):
        return value
    try:
        import pandas as pd

        if isinstance(value, pd.DataFrame):
            factors = [c for c in value.columns if isinstance(value[c].dtype, pd.CategoricalDtype)]
            texts = {c: value[c].astype(object).map(str, na_action="ignore").astype(object).where(value[c].notna(), None) for c in factors}
            return spark.createDataFrame(value.assign(**texts), **({"schema": schema} if schema is not None else {}))
    except ImportError:  # pragma: no cover
        pass
    if isinstance(value, list) and (not value or isinstance(value[0], (tuple, list, dict))):
        if not value and schema is None:
            raise ValueError("an empty list of rows needs a schema")
        return spark.createDataFrame(value, schema) if schema is not None else spark.createDataFrame(value)
    if isinstance(value, (str, int, float, bool)):
        return spark.createDataFrame([(value,)], ["value"]).select(F.col("value"))
    raise TypeError(f"a step must produce a table, got {type(value).__name__}")
