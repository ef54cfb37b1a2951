"""Named models and the relations they read."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from municare.operators import bounded
from municare.sources.lookups import SEED_SCHEMAS, read_seed, reference_municipalities

SCOPE = "municipios_referencia"


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    reads: tuple[str, ...]
    build: Callable[..., DataFrame]
    small: bool


MODELS: dict[str, Model] = {}


def model(name: str, *reads: str, small: bool = False):
    """Register a builder that receives one DataFrame per relation it reads. ``small``
    relations are broadcast wherever their size, checked first, allows it."""
    layer = {"stg": "staging", "int": "intermediate"}.get(name.split("_")[0], "marts")

    def register(build: Callable[..., DataFrame]):
        MODELS[name] = Model(name, layer, reads, build, small)
        return build

    return register


class Workspace:
    """Resolves relation names to DataFrames: given tables first, then models and seeds. A
    table may be given as a function that makes it when it is first read."""

    def __init__(
        self, spark: SparkSession, tables: Mapping[str, DataFrame | Callable[[], DataFrame]]
    ):
        self.spark = spark
        self._given = tables
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self._make(name)
        return self._known[name]

    def put(self, name: str, table: DataFrame) -> None:
        """Use a stored table from here on."""
        found = MODELS.get(name)
        self._known[name] = bounded(table) if found and found.small else table

    def _make(self, name: str) -> DataFrame:
        if name in self._given:
            given = self._given[name]
            return given() if callable(given) else given
        if name in SEED_SCHEMAS:
            return read_seed(self.spark, name)
        if name == SCOPE:
            return reference_municipalities(self.spark)
        found = MODELS[name]
        table = found.build(*[self[r] for r in found.reads])
        return bounded(table) if found.small else table


def build_order(names: Iterable[str] | None = None) -> list[str]:
    """Models in reading order, each after the models it reads."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in MODELS and name not in ordered:
            for read in MODELS[name].reads:
                visit(read)
            ordered.append(name)

    for name in names if names is not None else MODELS:
        visit(name)
    return ordered
