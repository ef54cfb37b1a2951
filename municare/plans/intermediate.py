"""Intermediate views: the code bridge and the diagnosis classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from municare.functions import complete_category, prefix
from municare.operators import resolve_codes
from municare.plans.registry import model


@model("int_ibge__municipio_codigo6", "dim_municipio", small=True)
def code_bridge(municipalities: DataFrame) -> DataFrame:
    """Seven-digit municipality id next to the six-digit code without its check digit."""
    return municipalities.select(
        "id_municipio",
        prefix("id_municipio", 6).alias("cod_municipio_ibge6"),
        "nome_municipio",
    )


@model("int_sih__diagnostico_icsap", "fct_internacoes", "seed_icsap_cid10")
def sensitive_diagnoses(admissions: DataFrame, ranges: DataFrame) -> DataFrame:
    """Each distinct diagnosis with its group of conditions sensitive to primary care."""
    found = resolve_codes(
        admissions,
        "diagnostico_principal",
        complete_category("diagnostico_principal"),
        ranges,
        "cid_inicio",
        "cid_fim",
        {"grupo_icsap": "grupo_icsap", "descricao_grupo": "descricao_grupo_icsap"},
    )
    return found.withColumn("is_icsap", F.col("grupo_icsap").isNotNull())
