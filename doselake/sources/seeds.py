"""Fixed reference tables (S9): federative units, age bands, official targets.

Their size is a constant of the code, so this library broadcasts them by hint, as it
does small tables of counted size and the months of files; everything else derived
from data is left to Catalyst and AQE, which broadcast by measured size.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: must equal the published reference tables ------------------
UF_ROWS = [
    (11, "RO", "Rondônia"), (12, "AC", "Acre"), (13, "AM", "Amazonas"),
    (14, "RR", "Roraima"), (15, "PA", "Pará"), (16, "AP", "Amapá"),
    (17, "TO", "Tocantins"), (21, "MA", "Maranhão"), (22, "PI", "Piauí"),
    (23, "CE", "Ceará"), (24, "RN", "Rio Grande do Norte"), (25, "PB", "Paraíba"),
    (26, "PE", "Pernambuco"), (27, "AL", "Alagoas"), (28, "SE", "Sergipe"),
    (29, "BA", "Bahia"), (31, "MG", "Minas Gerais"), (32, "ES", "Espírito Santo"),
    (33, "RJ", "Rio de Janeiro"), (35, "SP", "São Paulo"), (41, "PR", "Paraná"),
    (42, "SC", "Santa Catarina"), (43, "RS", "Rio Grande do Sul"),
    (50, "MS", "Mato Grosso do Sul"), (51, "MT", "Mato Grosso"), (52, "GO", "Goiás"),
    (53, "DF", "Distrito Federal"),
]

AGE_BAND_ROWS = [
    (0, None, None, "Sem informação"),
    (1, 0, 0, "Menor de 1 ano"),
    (2, 1, 1, "1 ano"),
    (3, 2, 4, "2 a 4 anos"),
    (4, 5, 9, "5 a 9 anos"),
    (5, 10, 19, "10 a 19 anos"),
    (6, 20, 59, "20 a 59 anos"),
    (7, 60, 150, "60 anos ou mais"),
]

TARGET_ROWS = [
    (1, "BCG", "Dose única", 0.90),
    (2, "Hepatite B", "Ao nascer (<30 dias)", 0.95),
    (3, "Penta (DTP/Hib/Hepatite B)", "Esquema básico", 0.95),
    (4, "Pneumocócica 10", "Esquema básico", 0.95),
    (5, "Pneumocócica 10", "1º reforço", 0.95),
    (6, "VIP (Poliomielite inativada)", "Esquema básico", 0.95),
    (7, "Rotavírus", "Esquema básico", 0.90),
    (8, "Meningocócica C", "Esquema básico", 0.95),
    (9, "Meningocócica C", "1º reforço", 0.95),
    (10, "VOP (Poliomielite oral)", "Reforço", 0.95),
    (11, "Febre amarela", "Dose única/reforço", 0.95),
    (12, "Tríplice viral (SCR)", "1ª dose", 0.95),
    (13, "Tríplice viral (SCR)", "2ª dose", 0.95),
    (14, "Hepatite A", "Dose única", 0.95),
    (15, "DTP", "1º reforço", 0.95),
    (16, "Varicela", "Dose única", 0.95),
    (17, "HPV", "Esquema", 0.90),
    (18, "Meningocócica ACWY", "Reforço adolescente", 0.80),
    (19, "Influenza", "Campanha anual", 0.90),
]
# -------------------------------------------------------------------------------


def _seed(spark: SparkSession, rows: list[tuple], schema: pa.Schema) -> DataFrame:
    # An Arrow table becomes a local relation: no Python worker at scan time.
    columns = [pa.array(values, f.type) for values, f in zip(zip(*rows), schema)]
    return spark.createDataFrame(pa.table(columns, schema=schema))


def uf_ibge(spark: SparkSession) -> DataFrame:
    schema = pa.schema([("co_uf", pa.int32()), ("sg_uf", pa.string()), ("nome_uf", pa.string())])
    return _seed(spark, UF_ROWS, schema)


def faixa_etaria(spark: SparkSession) -> DataFrame:
    schema = pa.schema(
        [
            ("ordem", pa.int32()),
            ("idade_min", pa.int32()),
            ("idade_max", pa.int32()),
            ("nome_faixa_etaria", pa.string()),
        ]
    )
    return _seed(spark, AGE_BAND_ROWS, schema)


def meta_vacinal(spark: SparkSession) -> DataFrame:
    schema = pa.schema(
        [
            ("ordem", pa.int32()),
            ("vacina", pa.string()),
            ("dose", pa.string()),
            ("meta_cobertura", pa.float64()),
        ]
    )
    return _seed(spark, TARGET_ROWS, schema)


def display_order(seed: DataFrame) -> DataFrame:
    """Rows in presentation order."""
    return seed.orderBy(F.col("ordem"))
