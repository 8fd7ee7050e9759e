"""The given tables seen as trusted flow and accident rows, in Spark and in SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SENSOR_KM, SPEED_CLASSES
from ..runwindow import RunWindow
from .registry import table

AS_OF = date(2001, 6, 30)
RUN = RunWindow.of(AS_OF)
DT_PROC = 20010630120000

SPEEDS = [*SPEED_CLASSES, "N/A"]
VEHICLES = ["Comercial", "Passeio", "Moto", "Ônibus", "Outro"]


def _pick(values: list, index) -> F.Column:
    return F.element_at(F.array(*map(F.lit, values)), index.cast("int") + 1)


def _two_way(key: str):
    return F.when(F.col(key) % 2 == 0, "Crescente").otherwise("Decrescente")


def _state(key: str):
    return F.when(F.col(key) % 7 == 0, "SP").otherwise("MG")


def _month(column: str):
    return F.year(column) * 100 + F.month(column)


def flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_fluxo"),
        F.lpad(F.col("l_partkey").cast("string"), 14, "0").alias("dt_proc"),
        _month("l_shipdate").alias("ref"),
        F.col("l_shipdate").cast("date").alias("data_fluxo"),
        _pick(list(SENSOR_KM), F.col("l_suppkey") % 15).cast("decimal(14,3)").alias("km_fluxo"),
        F.lit(40).alias("br_fluxo"),
        _two_way("l_suppkey").alias("sentido_fluxo"),
        _state("l_suppkey").alias("uf_fluxo"),
        _pick(SPEEDS, F.col("l_quantity").cast("int") % 9).alias("velocidade_fluxo"),
        _pick(VEHICLES, F.col("l_partkey") % 5).alias("tipo_de_veiculo_fluxo"),
        (F.col("l_quantity") * 6).cast("bigint").alias("volume_total_fluxo"),
    )


def accidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    position = (F.lit(525000) + (F.col("o_orderkey") * 7) % 20000).cast("double") / 1000
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id_acidente"),
        F.lpad(F.col("o_custkey").cast("string"), 14, "0").alias("dt_proc"),
        _month("o_orderdate").alias("ref"),
        F.col("o_orderdate").cast("date").alias("data_acidente"),
        position.cast("decimal(14,3)").alias("km_acidente"),
        F.lit(40).alias("br_acidente"),
        _two_way("o_custkey").alias("sentido_acidente"),
        _state("o_custkey").alias("uf_acidente"),
        F.col("o_orderpriority").alias("causa_acidente"),
        F.col("o_orderstatus").alias("tipo_acidente"),
        F.when(F.col("o_totalprice") > 250000, "Com Vítimas").otherwise("Sem Vítimas")
        .alias("classificacao_acidente"),
        F.lit(None).cast("string").alias("condicao_metereologica_acidente"),
        (F.col("o_custkey") % 4 + 1).cast("int").alias("veiculos_acidente"),
    )


# --- the same in DuckDB SQL ---------------------------------------------------------


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


SENSORS_SQL = "[" + ", ".join(f"cast({km} as decimal(14,3))" for km in SENSOR_KM) + "]"


def _sql_two_way(key: str) -> str:
    return f"case when {key} % 2 = 0 then 'Crescente' else 'Decrescente' end"


def _sql_state(key: str) -> str:
    return f"case when {key} % 7 = 0 then 'SP' else 'MG' end"


FLOW_SQL = f"""
select l_orderkey * 10 + l_linenumber as id_fluxo,
       lpad(cast(l_partkey as varchar), 14, '0') as dt_proc,
       cast(strftime(l_shipdate, '%Y%m') as integer) as ref,
       cast(l_shipdate as date) as data_fluxo,
       {SENSORS_SQL}[l_suppkey % 15 + 1] as km_fluxo,
       40 as br_fluxo,
       {_sql_two_way('l_suppkey')} as sentido_fluxo,
       {_sql_state('l_suppkey')} as uf_fluxo,
       {_sql_list(SPEEDS)}[cast(trunc(l_quantity) as integer) % 9 + 1] as velocidade_fluxo,
       {_sql_list(VEHICLES)}[l_partkey % 5 + 1] as tipo_de_veiculo_fluxo,
       cast(trunc(l_quantity * 6) as bigint) as volume_total_fluxo
from lineitem
"""

ACCIDENTS_SQL = f"""
select o_orderkey as id_acidente,
       lpad(cast(o_custkey as varchar), 14, '0') as dt_proc,
       cast(strftime(o_orderdate, '%Y%m') as integer) as ref,
       cast(o_orderdate as date) as data_acidente,
       cast(cast(525000 + (o_orderkey * 7) % 20000 as double) / 1000 as decimal(14,3))
         as km_acidente,
       40 as br_acidente,
       {_sql_two_way('o_custkey')} as sentido_acidente,
       {_sql_state('o_custkey')} as uf_acidente,
       o_orderpriority as causa_acidente,
       o_orderstatus as tipo_acidente,
       case when o_totalprice > 250000 then 'Com Vítimas' else 'Sem Vítimas' end
         as classificacao_acidente,
       cast(null as varchar) as condicao_metereologica_acidente,
       cast(o_custkey % 4 + 1 as integer) as veiculos_acidente
from orders
"""

# Fixed values in the next three: bounds, labels and class names.
VOLUME_CASE = """case when volume_total_fluxo between 1 and 108 then 'FLUXO_BAIXO'
       when volume_total_fluxo between 109 and 216 then 'FLUXO_MEDIO'
       when volume_total_fluxo > 216 then 'FLUXO_ALTO' end"""

SPEED_CASE = """case when velocidade_fluxo in ('<= 20 KM/h', '21 - 50 KM', '51 - 80 KM')
         then 'VELOCIDADE_BAIXA'
       when velocidade_fluxo in ('81 - 100 K', '101 - 120 ') then 'VELOCIDADE_MEDIA'
       when velocidade_fluxo in ('121 - 140 ', '141 - 160 ', '> 160 KM/h')
         then 'VELOCIDADE_ALTA' end"""

VEHICLE_CASE = """case tipo_de_veiculo_fluxo when 'Comercial' then 'VEICULO_COMERCIAL'
       when 'Passeio' then 'VEICULO_PASSEIO' when 'Moto' then 'VEICULO_MOTO'
       when 'Ônibus' then 'VEICULO_ONIBUS' end"""


def latest_sql(source: str, key: str) -> str:
    """Highest version by aggregate and join, ties kept."""
    return f"""select a.* from {source} a
join (select {key} as k, max(ref || dt_proc) as v from {source} group by 1) b
  on a.{key} = b.k and a.ref || a.dt_proc = b.v"""


# Nearest sensor by brute force: smallest distance, the higher sensor on a tie.
NEAREST_SQL = f"""case when km_acidente between 525.25 and 544.55 then
    (select s.km from (select unnest({SENSORS_SQL}) as km) s
     order by abs(s.km - km_acidente), s.km desc limit 1) end"""


def stage_ctes(flow_sql: str = FLOW_SQL, accidents_sql: str = ACCIDENTS_SQL) -> str:
    """CTEs up to ``stage`` for the run of ``RUN``; other inputs keep the same columns."""
    months = f"ref between {RUN.first_ref} and {RUN.ref}"
    return f"""with flow_all as ({flow_sql}),
accidents_all as ({accidents_sql}),
flow_run as (select * from flow_all where {months}),
accidents_run as (select * from accidents_all where {months}),
flow_latest as ({latest_sql('flow_run', 'id_fluxo')}),
accidents_latest as ({latest_sql('accidents_run', 'id_acidente')}),
accidents_placed as (
  select *, {NEAREST_SQL} as km_sensor from accidents_latest where uf_acidente = 'MG'),
joined as (
  select id_fluxo, km_fluxo, data_fluxo,
         {VOLUME_CASE} as fbc_classificacao_volume,
         {SPEED_CASE} as fbc_classificacao_velocidade,
         {VEHICLE_CASE} as fbc_classificacao_tipo_veiculo,
         volume_total_fluxo as flv_volume_fluxo,
         id_acidente, data_acidente, causa_acidente, tipo_acidente, classificacao_acidente,
         condicao_metereologica_acidente, veiculos_acidente
  from flow_latest left join accidents_placed
    on km_fluxo = km_sensor and br_fluxo = br_acidente
   and data_fluxo = data_acidente and sentido_fluxo = sentido_acidente
  where uf_fluxo = 'MG'),
numbered as (
  select *, row_number() over (
    partition by data_fluxo
    order by id_acidente nulls last, id_fluxo nulls last, km_fluxo nulls last,
             fbc_classificacao_volume nulls last, fbc_classificacao_velocidade nulls last,
             fbc_classificacao_tipo_veiculo nulls last, flv_volume_fluxo nulls last,
             causa_acidente nulls last, tipo_acidente nulls last,
             classificacao_acidente nulls last, veiculos_acidente nulls last) as rn
  from joined),
per_day as (
  select data_fluxo as day, count(distinct id_acidente) as accidents from joined group by 1),
stage as (
  select id_fluxo, km_fluxo, cast({DT_PROC} as bigint) as dt_proc,
         cast({RUN.ref} as integer) as ref, data_fluxo,
         fbc_classificacao_volume, fbc_classificacao_velocidade,
         fbc_classificacao_tipo_veiculo, flv_volume_fluxo,
         case when rn = 1 then accidents end as fvl_acidentes_dia,
         id_acidente, data_acidente, causa_acidente, tipo_acidente, classificacao_acidente,
         condicao_metereologica_acidente, veiculos_acidente
  from numbered left join per_day on data_fluxo = day)
"""


def months_between_sql(later: str, earlier: str) -> str:
    """Spark's ``months_between`` for two dates."""
    months = (f"(year({later}) - year({earlier})) * 12 + month({later}) - month({earlier})")
    return f"""case when day({later}) = day({earlier})
        or ({later} = last_day({later}) and {earlier} = last_day({earlier}))
      then cast({months} as double)
      else round({months} + (day({later}) - day({earlier})) / 31.0, 8) end"""


def flags_sql(day: str, months=(1, 3, 6, 9, 12)) -> str:
    ref_date = f"date '{RUN.ref_date.isoformat()}'"
    age = months_between_sql(ref_date, day)
    return ",\n".join(
        f"case when {age} <= {m} then 1 else 0 end as flg_u{m}m" for m in months
    )
