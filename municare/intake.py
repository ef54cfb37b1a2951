"""Load landed files into the raw tables and open the raw tables again."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from municare.functions import period_month, period_year
from municare.schemas import RAW_SCHEMAS, not_null, raw_schema
from municare.sinks import loads, read_table, read_upserted, replace_partitions, table_path, upsert
from municare.sources import (
    annual_prefix,
    find_parts,
    monthly_prefix,
    normalize,
    provenance,
    read_parts,
    require_rows,
)
from municare.sources.landing import POSITION, SOURCE_FILE, watched_records
from municare.sinks.tables import Guard
from municare.sources.lookups import REFERENCE_CODES
from municare.sources.raw import SOURCES, facility_counts, place_scope, population, territory
from municare.sources.validate import watch_rows, watch_values

# File group of each register, how its API answers are wrapped, page limits.
FILE_GROUPS = {
    "raw_cnes.estabelecimentos": "ST",
    "raw_cnes.rede_porte_municipio": "ST",
    "raw_cnes.equipes_aps": "EP",
    "raw_sia.producao_ambulatorial": "PA",
    "raw_sih.internacoes": "RD",
    "raw_sim.obitos": "DO",
    "raw_sinasc.nascidos_vivos": "DN",
}
JSON_LAYOUTS = {
    "raw_ibge.municipios": ("array", None),
    "raw_cnes.estabelecimentos_detalhados": ("envelope", "estabelecimentos"),
    "raw_fns.repasses": ("array", None),
    "raw_portaltransparencia.recursos_recebidos_saude": ("array", None),
    "raw_siops.rreo_anexo14": ("envelope", "items"),
    "raw_sisab.indicador_desempenho": ("envelope", "sisab_indicador_desempenho"),
    "raw_sisab.cadastro_vinculado": ("envelope", "sisab_cadastro_vinculado"),
}
PAGE_LIMITS = {"raw_fns.repasses": 10_000, "raw_sisab.indicador_desempenho": 1_000}
UPSERT_KEYS = {
    "raw_ibge.municipios": ("id_municipio",),
    "raw_ibge.populacao_estimada": ("id_municipio", "ano_referencia"),
    **{name: s.keys for name, s in SOURCES.items() if s.write == "upsert"},
}

# Upserted tables whose key holds a period: a load rewrites its own periods only.
PERIOD_IN_KEY = {
    "raw_ibge.populacao_estimada": "ano_referencia",
    "raw_cnes.estabelecimentos": "competencia",
}


def raw_path(root: str, table: str) -> str:
    return table_path(root, *table.split("."))


def _upsert(rows: DataFrame, root: str, table: str, guard: Guard | None = None) -> None:
    """The last record of a key wins: by load time, then file, then place in the file."""
    names = raw_schema(table).names
    place = [c for c in (SOURCE_FILE, POSITION) if c in rows.columns and c not in names]
    whole, complete = watch_values(rows, not_null(table), table)
    upsert(
        whole.select(*names, *place),
        raw_path(root, table),
        UPSERT_KEYS[table],
        within=PERIOD_IN_KEY.get(table),
        order_only=place,
        guard=_all(guard, complete),
    )


def _replace(
    rows: DataFrame,
    root: str,
    table: str,
    partitions: Sequence[Mapping[str, object]],
    guard: Guard | None = None,
) -> None:
    whole, complete = watch_values(rows, not_null(table), table)
    ordered = whole.select(*raw_schema(table).names)
    replace_partitions(ordered, raw_path(root, table), partitions, guard=_all(guard, complete))


def _all(*guards: Guard | None) -> Guard:
    """One guard that calls each in turn."""

    def call() -> None:
        for guard in guards:
            if guard is not None:
                guard()

    return call


def ingest_file(
    spark: SparkSession,
    landing: str,
    root: str,
    table: str,
    uf: str,
    year: int,
    month: int | None = None,
    extension: str = "parquet",
    scope: Sequence[str] = REFERENCE_CODES,
) -> None:
    """Load one register file, all its parts, into its raw table.

    Facilities, teams and admissions are upserted; production replaces its arrival period,
    network size its period, deaths and births their year and municipalities in scope. Only
    records of the municipalities in ``scope`` are loaded where the source is loaded in part.
    """
    group = FILE_GROUPS[table]
    name = annual_prefix(group, uf, year) if month is None else monthly_prefix(group, uf, year, month)
    parts = read_parts(spark, find_parts(spark, landing, name, extension), extension)
    landed, guard = watch_rows(parts, name)
    stamp = partial(provenance, loaded_at=_now(spark))
    if table == "raw_cnes.rede_porte_municipio":
        counts = facility_counts(require_rows(parts, name))
        periods = [r[0] for r in counts.select("competencia").distinct().collect()]  # one per file
        _replace(stamp(counts, source=name), root, table, [{"competencia": p} for p in periods])
        return
    rows = normalize(landed, table, place_scope(table, scope))
    if table == "raw_sia.producao_ambulatorial":
        arrival = f"{year}{month:02d}"
        stamped = stamp(rows, year=period_year("competencia"), month=period_month("competencia"))
        _replace(stamped.withColumn("competencia_arquivo", F.lit(arrival)), root, table,
                 [{"competencia_arquivo": arrival}], guard)
    elif SOURCES[table].write == "replace":
        place = SOURCES[table].keys[1]
        _replace(stamp(rows, year=year), root, table,
                 [{"_reference_year": year, place: code} for code in scope], guard)
    else:
        _upsert(stamp(rows, year=year, month=month), root, table, guard)


def ingest_json(
    spark: SparkSession,
    path: str,
    root: str,
    table: str,
    url: str,
    year: int | None = None,
    partitions: Sequence[Mapping[str, object]] | None = None,
) -> None:
    """Load saved API answers into their raw table. Tables that replace need ``partitions``,
    the municipality and period that were asked for."""
    if table not in UPSERT_KEYS and not partitions:
        raise ValueError(f"{table} is replaced by partition: name the partitions")
    guard = None
    if table == "raw_ibge.populacao_estimada":
        answers = spark.read.text(path, wholetext=True)
        answers = answers.select("value", F.col("_metadata.file_name").alias(SOURCE_FILE))
        rows = population(answers, keep_place=True)
    else:
        layout = JSON_LAYOUTS[table]
        records, guard = watched_records(spark, path, *layout, PAGE_LIMITS.get(table), table)
        territorial = table == "raw_ibge.municipios"
        rows = territory(records, keep_place=True) if territorial else normalize(records, table)
    stamped = provenance(
        rows, url, year, loaded_at=_now(spark), source_column="_source_url"
    )
    if table in UPSERT_KEYS:
        _upsert(stamped, root, table, guard)
    else:
        _replace(stamped, root, table, partitions, guard)


def _now(spark: SparkSession) -> Column:
    """One load, one time: the clock is read once, not by every job of the load."""
    return F.lit(spark.sql("select current_timestamp()").first()[0])


class RawTables(Mapping[str, DataFrame]):
    """The raw tables under a root, each opened when it is read."""

    def __init__(self, spark: SparkSession, root: str, may_be_empty: Sequence[str] = ()):
        self._spark, self._root, self._may_be_empty = spark, root, may_be_empty

    def __getitem__(self, name: str) -> DataFrame:
        path, schema = raw_path(self._root, name), raw_schema(name)
        empty = name in self._may_be_empty
        if name in UPSERT_KEYS:
            return read_upserted(self._spark, path, schema, PERIOD_IN_KEY.get(name), empty)
        return read_table(self._spark, path, schema, empty)

    def ledger(self, name: str, partition: str) -> dict[object, int | None]:
        """Newest load of each partition of a table that is replaced by partition; reads no rows."""
        path, kind = raw_path(self._root, name), raw_schema(name)[partition].dataType
        return {value: part.newest for value, part in loads(self._spark, path, partition, kind).items()}

    def __contains__(self, name: object) -> bool:
        return name in RAW_SCHEMAS

    def __iter__(self) -> Iterator[str]:
        return iter(RAW_SCHEMAS)

    def __len__(self) -> int:
        return len(RAW_SCHEMAS)


def open_raw(spark: SparkSession, root: str, may_be_empty: Sequence[str] = ()) -> RawTables:
    """Every raw table under its declared columns. A table never loaded is an error when it is
    read, unless it is named in ``may_be_empty``."""
    return RawTables(spark, root, may_be_empty)
