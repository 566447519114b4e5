"""Model registry: layers, materialisation, contracts, selective rebuild.

A model is a function from its inputs (by name) to a DataFrame. Staging and
intermediate models are temp views (lazy; Catalyst plans them into their
consumers). Core, marts and serving models are published as Parquet tables in
the warehouse folder - partitioned by instance, each build a version of its own
that readers get only when it is whole (``publish``) - and read back, which makes
them the lineage cut points. A serving model may declare a contract; a
breaking change (removed or retyped column) fails the build, additive
changes pass. ``run`` builds all models or only those downstream of changed
sources, in dependency order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.quality import RESULT_SCHEMA, ROW_LEVEL, Check, Observed, contract_diff, is_breaking, run_checks
from .publish import ContractError, publish

VIEW_LAYERS = ("staging", "intermediate")
TABLE_LAYERS = ("core", "marts", "serving")


@dataclass
class Model:
    name: str
    layer: str
    build: Callable[..., DataFrame]
    deps: Sequence[str] = ()
    partition_by: Sequence[str] = ()
    contract: T.StructType | None = None


@dataclass
class Registry:
    models: dict[str, Model] = field(default_factory=dict)
    sources: set[str] = field(default_factory=set)

    def source(self, *names: str) -> None:
        self.sources.update(names)

    def add(self, model: Model) -> Model:
        if model.name in self.models or model.name in self.sources:
            raise ValueError(f"duplicate name {model.name}")
        for d in model.deps:
            if d not in self.models and d not in self.sources:
                raise ValueError(f"{model.name} depends on unknown {d}")
        self.models[model.name] = model
        return model

    def order(self) -> list[str]:
        """Dependency order (models are added after their dependencies)."""
        return list(self.models)

    def downstream(self, changed: Iterable[str]) -> list[str]:
        """The models that read (directly or not) any of ``changed``."""
        hit = set(changed)
        out = []
        for name in self.order():
            if any(d in hit for d in self.models[name].deps):
                hit.add(name)
                out.append(name)
        return out


def materialize(spark: SparkSession, model: Model, df: DataFrame, warehouse: str) -> DataFrame:
    """Views for staging/intermediate, written tables for the rest."""
    if model.layer in VIEW_LAYERS:
        df.createOrReplaceTempView(f"{model.layer}__{model.name}")
        return df
    if model.layer not in TABLE_LAYERS:
        raise ValueError(f"unknown layer {model.layer}")
    # a rebuilt core table may change; what is promised to readers is the model's contract
    out = publish(df, f"{warehouse.rstrip('/')}/{model.layer}/{model.name}", model.partition_by, model.contract, additive=False)
    out.createOrReplaceTempView(f"{model.layer}__{model.name}")
    return out


def check_contract(model: Model, df: DataFrame) -> list[tuple[str, str]]:
    """Fail on a breaking change to a published column list."""
    if model.contract is None:
        return []
    diff = contract_diff(model.contract, df.schema)
    if is_breaking(diff):
        raise ContractError(f"{model.name}: {diff}")
    return diff


def run(
    spark: SparkSession,
    registry: Registry,
    inputs: Mapping[str, DataFrame],
    warehouse: str,
    changed_sources: Iterable[str] | None = None,
    built: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Build every model (or only those downstream of ``changed_sources``).

    Models that are not rebuilt are taken from ``built`` (the previous run's
    tables). Returns every model's DataFrame by name.
    """
    frames: dict[str, DataFrame] = dict(inputs)
    if built:
        frames.update(built)
    todo = registry.order() if changed_sources is None else registry.downstream(changed_sources)
    for name in todo:
        m = registry.models[name]
        df = m.build(*[frames[d] for d in m.deps])
        check_contract(m, df)
        frames[name] = materialize(spark, m, df, warehouse)
    return frames


def run_checked(
    spark: SparkSession, registry: Registry, inputs: Mapping[str, DataFrame], warehouse: str, checks: Sequence[Check]
) -> tuple[dict[str, DataFrame], DataFrame]:
    """``run``, and the result of every declared test as one table (as ``run_checks`` gives it).

    Row-level tests of a written model are measured by the write itself; those of views
    and the keyed tests are run afterwards, each table's row-level tests in one pass.
    """
    frames: dict[str, DataFrame] = dict(inputs)
    found: list[tuple] = []
    seen: set[int] = set()
    for name in registry.order():
        m = registry.models[name]
        df = m.build(*[frames[d] for d in m.deps])
        check_contract(m, df)
        mine = [(i, c) for i, c in enumerate(checks) if c.table == name and c.kind in ROW_LEVEL]
        if m.layer in TABLE_LAYERS and mine:
            observed = Observed([c for _, c in mine])
            frames[name] = materialize(spark, m, observed.attach(df), warehouse)
            found += observed.results()
            seen.update(i for i, _ in mine)
        else:
            frames[name] = materialize(spark, m, df, warehouse)
    measured = spark.createDataFrame(found, RESULT_SCHEMA)
    rest = [c for i, c in enumerate(checks) if i not in seen]
    return frames, measured.unionByName(run_checks(rest, frames)) if rest else measured
