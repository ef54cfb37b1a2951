import json

import pytest
import records as rec
from test_intake import answer, land

from municare.__main__ import main, parser
from municare.intake import open_raw
from municare.plans import open_marts


def test_ingest_and_build_from_the_command_line(spark, folder):
    land(spark, folder, "PARJ2501a", rec.PRODUCTION)
    answer(spark, f"{folder}/places", [rec.place(3304557, "Rio", 33, 3), rec.place(3303807, "Paraty", 33, 3)])
    answer(spark, f"{folder}/budget", {"items": [rec.BUDGET]})
    root = f"{folder}/lake"
    main(["ingest-file", "--root", root, "--landing", folder, "--table", "raw_sia.producao_ambulatorial",
          "--uf", "rj", "--year", "2025", "--month", "1"])
    main(["ingest-json", "--root", root, "--path", f"{folder}/places", "--table", "raw_ibge.municipios",
          "--url", "https://x"])
    asked = [{"id_municipio": 3304557, "ano_exercicio": 2025, "periodo_bimestre": 6}]
    main(["ingest-json", "--root", root, "--path", f"{folder}/budget", "--table", "raw_siops.rreo_anexo14",
          "--url", "https://x", "--partitions", json.dumps(asked)])
    assert open_raw(spark, root)["raw_siops.rreo_anexo14"].count() == 1
    main(["build", "--root", root, "--models", "mart_producao_grupo_municipio"])
    mart = open_marts(spark, open_raw(spark, root), root, ["mart_producao_grupo_municipio"])["mart_producao_grupo_municipio"]
    assert mart.first().id_municipio == 3304557


def test_unknown_table_is_refused():
    with pytest.raises(SystemExit):
        parser().parse_args(["ingest-file", "--root", "r", "--landing", "l", "--table", "x", "--year", "2025"])
