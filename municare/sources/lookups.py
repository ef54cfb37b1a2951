"""Small fixed relations shipped with the package."""

from __future__ import annotations

from importlib import resources

import pyarrow as pa
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Code columns are text: leading zeros matter.
SEED_SCHEMAS = {
    "seed_cnes_natureza_juridica": "codigo_natureza_juridica string, descricao_natureza_juridica string",
    "seed_cnes_tipo_unidade": "codigo_tipo_unidade string, descricao_tipo_unidade string",
    "seed_fns_ente_municipio": "cnpj_ente string, id_municipio int, nome_municipio string",
    "seed_icsap_cid10": "grupo_icsap int, descricao_grupo string, cid_inicio string, cid_fim string",
    "seed_previne_brasil_meta": (
        "numero_indicador int, parametro_percentual int, meta_percentual int,"
        " numero_nota_tecnica string"
    ),
    "seed_sigtap_grupo": "codigo_grupo string, descricao_grupo string",
    "seed_sisab_tipo_indicador": (
        "codigo_tipo_indicador int, numero_indicador int, descricao_indicador string"
    ),
}

# The municipalities in scope, as 7-digit id, 6-digit code and tax id.
REFERENCE_MUNICIPALITIES = (3304557, 3303807, 3303500)
REFERENCE_CODES = ("330455", "330380", "330350")
REFERENCE_TAX_IDS = ("42498733000148", "29172475000147", "29138278000101")


def read_seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """A code table of at most 106 rows, marked for broadcast.

    The shipped copy is read on the driver and travels inside the plan; give ``path`` to
    read a copy on shared storage, which Spark broadcasts or not by its size.
    """
    schema = SEED_SCHEMAS[name]
    if path:
        options = {"header": "true", "comment": "#", "encoding": "UTF-8"}
        return spark.read.schema(schema).options(**options).csv(path)
    fields = T.StructType.fromDDL(schema)
    types = {f.name: "int32" if f.dataType == T.IntegerType() else "string" for f in fields}
    with resources.files("municare.seeds").joinpath(f"{name}.csv").open("rb") as text:
        table = pacsv.read_csv(
            text,
            read_options=pacsv.ReadOptions(skip_rows=1),
            convert_options=pacsv.ConvertOptions(column_types=types),
        )
    return F.broadcast(spark.createDataFrame(table, fields))


def reference_municipalities(spark: SparkSession, ids=REFERENCE_MUNICIPALITIES) -> DataFrame:
    """Inline relation of the municipalities in scope."""
    return F.broadcast(spark.createDataFrame(pa.table({"id_municipio": pa.array(ids, pa.int32())})))
