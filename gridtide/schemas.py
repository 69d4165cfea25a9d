"""Input tables of the domain."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _schema(columns: str) -> T.StructType:
    """`name TYPE, name TYPE, ...`; unlike the DDL parser it needs no running session."""
    pairs = (c.strip().rsplit(" ", 1) for c in columns.split(","))
    return T.StructType([T.StructField(name.strip("`"), TYPES[kind]) for name, kind in pairs])


# Weather variables, in output order.
WEATHER = [
    "temp_max",
    "temp_min",
    "temp_mean",
    "precipitation",
    "humidity_min",
    "humidity_mean",
    "windvelo_mean",
]

PANEL = _schema(
    "cod_alim STRING, ano INT, mes INT, chi_total DOUBLE, cons_conjunto DOUBLE, "
    "qtde_cliente_total DOUBLE, qtde_cliente_ru DOUBLE, qtde_cliente_ub DOUBLE, "
    "dec_cj DOUBLE, vlr_qtd_arvore DOUBLE"
)
FEEDER_SET = _schema("sigla_conjunto STRING, alimentador STRING")
STATIONS = _schema("station_code STRING, longitude DOUBLE, latitude DOUBLE, state_initials STRING")
FEEDER_POINTS = _schema("code STRING, longitude DOUBLE, latitude DOUBLE")
STATION_HISTORY = _schema(
    "station_code STRING, year INT, month INT, " + ", ".join(f"{v} DOUBLE" for v in WEATHER)
)
OUTAGES = _schema(
    "cod_alim STRING, id_interrupcao BIGINT, dat_inicio TIMESTAMP_NTZ, cod_grupo INT, "
    "cod_causa INT, chi_tot DOUBLE, tag_urb_rur STRING"
)
CAUSES = _schema("num_idt_grupo_causas INT, num_idt_causa_interrupcao INT, grupo STRING")
MAINTENANCE = _schema(
    "cod_alim STRING, dat_execucao TIMESTAMP_NTZ, grupo_dataset_servico STRING, "
    "us_pontos DOUBLE, vlr_us_servico DOUBLE"
)
INSPECTIONS = _schema(
    "idservico BIGINT, idnsmanut STRING, `status servico` STRING, dispositivo STRING, se STRING, "
    "alimentador STRING, descricao STRING, quantidade STRING, `us servico` STRING, "
    "prioridade STRING, `data cadastro` STRING, `hora do cadastro` STRING, causa DOUBLE, "
    "`descricao da causa` STRING, `causa ciga` STRING"
)

# Names under which the tables are stored in the database.
DATABASE_NAMES = {
    "panel": "dataset",
    "feeder_set": "conjunto_alimentador",
    "stations": "inmet_autostations",
    "feeder_points": "geo_lat_long_alimentador",
    "goals": "metas_chi",
    "outages": "predit_interrupcoes",
    "causes": "predit_causa_interrupcoes_grupo",
    "maintenance": "predit_servicos_manutencao",
}
