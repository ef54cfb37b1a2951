"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the local cores. Query times cover
the whole plan from the Parquet scan to a sink that discards rows, the better of two runs
(three for the stored ones). The two ``stored_*``
entries are the ones comparable with the published timings: the incremental backfill of the
production fact from a stored raw table, and the group mart over the stored fact.
"""

from __future__ import annotations

import json
import os
import time

from municare.catalog import QUERIES
from municare.catalog.landed import raw_tables
from municare.plans import MODELS, Workspace
from municare.session import build_session, shared_folder
from municare.sinks import read_table, refresh_incremental, replace_partitions

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "fct_producao_ambulatorial",
    "mart_producao_grupo_municipio",
    "mart_icsap_municipio",
    "mart_historico_rede_cnes",
    "dim_estabelecimento",
    "mart_financiamento_saude_uniao",
    "mart_alertas_saude",
    "q02_role_playing_join",
    "q03_grouped_production",
    "q04_range_lookup_distinct",
    "q05_share_by_area_year",
    "q06_latest_per_key",
    "q07_presence_status",
    "q23_upsert_last_wins",
    "q25_incremental_arrival_vs_event",
)


def discard(rows) -> None:
    rows.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    settings = {"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "8g"}
    spark = build_session("bench", f"local[{CPUS}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    passes = [
        {name: timed(lambda: discard(QUERIES[name](spark, FOLDER))) for name in HEADLINE}
        for _ in range(2)
    ]
    seconds = {name: min(p[name] for p in passes) for name in HEADLINE}

    root = shared_folder(spark, "bench")
    raw = raw_tables(spark, FOLDER)["raw_sia.producao_ambulatorial"]()
    arrivals = [r[0] for r in raw.select("competencia_arquivo").distinct().collect()]
    replace_partitions(raw, f"{root}/raw", [{"competencia_arquivo": a} for a in arrivals])
    stored = read_table(spark, f"{root}/raw", raw.schema)
    lines = stored.count()
    space = Workspace(spark, {**raw_tables(spark, FOLDER), "raw_sia.producao_ambulatorial": stored})
    fact = MODELS["fct_producao_ambulatorial"]
    staged, bridge = (space[name] for name in fact.reads)

    def backfill(target: str) -> None:
        build = lambda rows: fact.build(rows, bridge)
        refresh_incremental(staged, target, build, "competencia_arquivo", aligned=True)

    seconds["stored_backfill"] = min(timed(lambda: backfill(f"{root}/fact{i}")) for i in range(3))
    schema = fact.build(staged, bridge).schema
    mart = MODELS["mart_producao_grupo_municipio"]
    groups = space["seed_sigtap_grupo"]
    seconds["stored_group_mart"] = min(
        timed(lambda: discard(mart.build(read_table(spark, f"{root}/fact0", schema), groups)))
        for _ in range(3)
    )
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
                "rows_per_sec": {
                    "stored_backfill": round(lines / seconds["stored_backfill"]),
                    "stored_group_mart": round(lines / seconds["stored_group_mart"]),
                },
            }
        )
    )


if __name__ == "__main__":
    main()
