"""Projections, filters, joins, aggregates and windows over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SENSOR_KM
from ..operators import (
    anchor_measure,
    assign_nearest,
    attach_events,
    bitmap_counts,
    distinct_bitmaps,
    duplicate_report,
    enrich,
    latest_version,
    nearest_sensor,
    numbered_rows,
    segment_table,
    top_duplicates,
)
from ..plans import conform_accidents, conform_flow
from ..plans.stage import loaded_version
from ..scratch import materialize, new_folder
from ..sinks.layers import write_counted
from . import bindings as B
from .registry import check, plain, table
from .scalar import murmur3_sql

# --- projections ---------------------------------------------------------------------


@check("project_conform", """select l_orderkey as id_pedido, l_linenumber as linha,
  l_returnflag as retorno, cast(l_suppkey as integer) as fornecedor from lineitem""")
def project_conform(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id_pedido"),
        F.col("l_linenumber").alias("linha"),
        F.col("l_returnflag").alias("retorno"),
        F.col("l_suppkey").cast("int").alias("fornecedor"),
    )


@check("project_extend", """select s_suppkey, s_name, s_nationkey, s_acctbal,
  case when s_acctbal < 0 then 1 else 0 end as in_debt from supplier""")
def project_extend(spark, sf_dir):
    in_debt = F.when(F.col("s_acctbal") < 0, 1).otherwise(0)
    return table(spark, sf_dir, "supplier").withColumns({"in_debt": in_debt})


@check("project_qualified_star",
       "select a.* from orders a join customer b on a.o_custkey = b.c_custkey")
def project_qualified_star(spark, sf_dir):
    a = table(spark, sf_dir, "orders").alias("a")
    b = table(spark, sf_dir, "customer").alias("b")
    return a.join(b, F.col("a.o_custkey") == F.col("b.c_custkey")).select("a.*")


@check("project_constants", f"""select o_orderkey, cast({B.DT_PROC} as bigint) as dt_proc,
  cast({B.RUN.ref} as integer) as ref from orders""")
def project_constants(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.lit(B.DT_PROC).cast("long").alias("dt_proc"),
        F.lit(B.RUN.ref).cast("int").alias("ref"),
    )


def raw_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flow rows from ``lineitem``, all columns; some fields unusable."""
    key = F.col("l_orderkey")
    return table(spark, sf_dir, "lineitem").select(
        F.when(key % 23 != 0, F.date_format("l_shipdate", "yyyy-MM-dd")).alias("data_da_passagem"),
        F.lit("Via").alias("concessionaria"),
        F.concat(F.lit("R"), F.col("l_suppkey").cast("string")).alias("identificador"),
        F.when(key % 29 == 0, F.col("l_returnflag"))
        .otherwise(F.concat(F.lit("BR-"), F.lpad((key % 400).cast("string"), 3, "0")))
        .alias("rodovia"),
        F.when(key % 7 == 0, "SP").otherwise("MG").alias("uf"),
        (F.col("l_extendedprice") / 100).alias("km_m"),
        F.col("l_linestatus").alias("municipio"),
        F.lit("Principal").alias("tipo_de_pista"),
        F.col("l_discount").alias("latitude"),
        F.col("l_tax").alias("longitude"),
        F.when(F.col("l_suppkey") % 2 == 0, "Crescente").otherwise("Decrescente")
        .alias("sentido_da_passagem"),
        F.col("l_linenumber").cast("string").alias("faixa_da_passagem"),
        F.lit("51 - 80 KM").alias("velocidade"),
        F.when(F.col("l_partkey") % 2 == 0, "Moto").otherwise("Passeio").alias("tipo_de_veiculo"),
        F.col("l_quantity").cast("long").alias("volume_total"),
    )


# The record's six columns in their order; the position is the number it spells.
CONFORM_ID = " || ".join(
    ("day", "vehicle", "'51 - 80 KM'", "cast(l_extendedprice / 100 as varchar)", "l_linestatus", "direction")
)


@check("conform_flow", f"""
with raw as materialized (
  select row_number() over () as id, case when l_orderkey % 23 <> 0 then strftime(l_shipdate, '%Y-%m-%d') end as day,
         case when l_orderkey % 29 = 0 then l_returnflag
              else 'BR-' || lpad(cast(l_orderkey % 400 as varchar), 3, '0') end as road,
         case when l_suppkey % 2 = 0 then 'Crescente' else 'Decrescente' end as direction,
         case when l_partkey % 2 = 0 then 'Moto' else 'Passeio' end as vehicle, *
  from lineitem),
keyed as (select id, {CONFORM_ID} as key from raw),
ids as (with {murmur3_sql("key").strip()})
select surrogate_id as id_fluxo,
       '20010630120000' as dt_proc, cast(replace(substring(day, 1, 7), '-', '') as integer) as ref,
       'Via' as concessionaria_fluxo, 'R' || l_suppkey as identificador_fluxo,
       try_cast(substring(road, 4) as integer) as br_fluxo,
       case when l_orderkey % 7 = 0 then 'SP' else 'MG' end as uf_fluxo,
       cast(cast(cast(l_extendedprice / 100 as varchar) as decimal(14,3)) as double) as km_fluxo,
       l_linestatus as municipio_fluxo, 'Principal' as tipo_de_pista,
       l_discount as latitude_fluxo, l_tax as longitude_fluxo, day as data_fluxo,
       direction as sentido_fluxo,
       cast(l_linenumber as varchar) as faixa_da_passagem_fluxo,
       '51 - 80 KM' as velocidade_fluxo,
       vehicle as tipo_de_veiculo_fluxo,
       cast(trunc(l_quantity) as bigint) as volume_total_fluxo
from raw join ids using (id)""")
def conform_flow_check(spark, sf_dir):
    return plain(conform_flow(raw_flow(spark, sf_dir), str(B.DT_PROC)))


def raw_accidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw accident rows from ``orders``, all columns, numbers with decimal commas."""
    key = F.col("o_orderkey")
    km = F.concat_ws(
        ",", (525 + key % 20).cast("string"), F.lpad((key % 1000).cast("string"), 3, "0")
    )
    coordinate = F.replace(F.col("o_totalprice").cast("decimal(12,2)").cast("string"),
                           F.lit("."), F.lit(","))

    def text(column: str):
        return F.col(column)

    small = (F.col("o_custkey") % 5).cast("int")
    columns = {
        "id": F.when(key % 31 == 0, text("o_orderpriority")).otherwise(key.cast("string")),
        "data_inversa": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "dia_semana": F.date_format("o_orderdate", "E"),
        "horario": F.lit("12:00:00"),
        "uf": F.when(F.col("o_custkey") % 7 == 0, "SP").otherwise("MG"),
        "br": F.lit(40),
        "km": F.when(key % 37 == 0, text("o_orderstatus")).otherwise(km),
        "latitude": F.concat(F.lit("-"), coordinate),
        "longitude": F.when(key % 41 == 0, text("o_orderpriority")).otherwise(coordinate),
    }
    for name in ("municipio", "causa_acidente", "tipo_acidente", "classificacao_acidente",
                 "fase_dia", "sentido_via", "condicao_metereologica", "tipo_pista",
                 "tracado_via", "uso_solo", "regional", "delegacia", "uop"):
        columns[name] = F.concat(F.lit(f"{name} "), text("o_orderstatus"))
    for name in ("pessoas", "mortos", "feridos_leves", "feridos_graves", "ilesos",
                 "ignorados", "feridos", "veiculos"):
        columns[name] = small
    return table(spark, sf_dir, "orders").select(
        *(column.alias(name) for name, column in columns.items())
    )


def _accident_sql() -> str:
    labels = {
        "municipio": "municipio_acidente", "causa_acidente": "causa_acidente",
        "tipo_acidente": "tipo_acidente", "classificacao_acidente": "classificacao_acidente",
        "fase_dia": "fase_dia_acidente", "sentido_via": "sentido_acidente",
        "condicao_metereologica": "condicao_metereologica_acidente",
        "tipo_pista": "tipo_pista_acidente", "tracado_via": "tracado_via_acidente",
        "uso_solo": "uso_solo", "regional": "regional", "delegacia": "delegacia", "uop": "uop",
    }
    counts = ("pessoas", "mortos", "feridos_leves", "feridos_graves", "ilesos", "ignorados",
              "feridos", "veiculos_acidente")
    price = "try_cast(cast(o_totalprice as decimal(12,2)) as double)"
    return ",\n".join(
        ["case when o_orderkey % 31 <> 0 then cast(o_orderkey as integer) end as id_acidente",
         "'20010630120000' as dt_proc",
         "cast(strftime(o_orderdate, '%Y%m') as integer) as ref",
         "strftime(o_orderdate, '%Y-%m-%d') as data_acidente",
         "strftime(o_orderdate, '%a') as dia_semana_acidente",
         "'12:00:00' as horario_acidente",
         "case when o_custkey % 7 = 0 then 'SP' else 'MG' end as uf_acidente",
         "40 as br_acidente",
         "case when o_orderkey % 37 <> 0 then cast(cast(525 + o_orderkey % 20 as varchar) || '.'"
         " || lpad(cast(o_orderkey % 1000 as varchar), 3, '0') as double) end as km_acidente",
         f"-{price} as latitude_acidente",
         f"case when o_orderkey % 41 <> 0 then {price} end as longitude_acidente"]
        + [f"'{raw} ' || o_orderstatus as {name}" for raw, name in labels.items()]
        + [f"cast(o_custkey % 5 as integer) as {name}" for name in counts]
    )


@check("conform_accidents", f"select {_accident_sql()} from orders")
def conform_accidents_check(spark, sf_dir):
    return plain(conform_accidents(raw_accidents(spark, sf_dir), str(B.DT_PROC)))


# --- filters and joins ---------------------------------------------------------------

PLACED_SQL = f"select *, {B.NEAREST_SQL} as km_sensor from ({B.ACCIDENTS_SQL})"

ON = (
    ("km_fluxo", "km_sensor"),
    ("data_fluxo", "data_acidente"),
    ("sentido_fluxo", "sentido_acidente"),
)
ON_SQL = "km_fluxo = km_sensor and data_fluxo = data_acidente and sentido_fluxo = sentido_acidente"


def placed_accidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    accidents = B.accidents(spark, sf_dir)
    return accidents.withColumn("km_sensor", nearest_sensor(F.col("km_acidente"), SENSOR_KM))


@check("filter_pre_join", f"""
select id_fluxo, id_acidente from ({B.FLOW_SQL}) f
left join (select * from ({PLACED_SQL}) where uf_acidente = 'MG') a on {ON_SQL}""")
def filter_pre_join(spark, sf_dir):
    events = placed_accidents(spark, sf_dir).where(F.col("uf_acidente") == "MG")
    return attach_events(B.flow(spark, sf_dir), events, ON).select("id_fluxo", "id_acidente")


@check("filter_post_left_join", f"""
select id_fluxo, id_acidente from ({B.FLOW_SQL}) f
left join ({PLACED_SQL}) a on {ON_SQL} where uf_fluxo = 'MG'""")
def filter_post_left_join(spark, sf_dir):
    joined = attach_events(B.flow(spark, sf_dir), placed_accidents(spark, sf_dir), ON)
    return joined.where(F.col("uf_fluxo") == "MG").select("id_fluxo", "id_acidente")


@check("left_join_multikey", f"""
select id_fluxo, cast(km_fluxo as double) as km_fluxo, id_acidente, causa_acidente
from ({B.FLOW_SQL}) f left join ({PLACED_SQL}) a on br_fluxo = br_acidente and {ON_SQL}""")
def left_join_multikey(spark, sf_dir):
    """Both sides are written first, as a run does with its accidents, and typed before rows are repeated."""
    keys = (("br_fluxo", "br_acidente"), *ON)
    lefts, rights = zip(*keys)
    flow = B.flow(spark, sf_dir).select("id_fluxo", F.col("km_fluxo").cast("double").alias("km"), *lefts)
    events = placed_accidents(spark, sf_dir).select("id_acidente", "causa_acidente", *rights)
    joined = attach_events(materialize(flow, "flow"), materialize(events, "accidents"), keys)
    return joined.select("id_fluxo", F.col("km").alias("km_fluxo"), "id_acidente", "causa_acidente")


@check("left_join_enrich", f"""
with f as ({B.FLOW_SQL}),
d as (select data_fluxo as day, count(distinct km_fluxo) as sensors from f group by 1)
select id_fluxo, strftime(data_fluxo, '%Y-%m-%d') as data_fluxo, sensors
from f left join d on data_fluxo = day""")
def left_join_enrich(spark, sf_dir):
    flow = B.flow(spark, sf_dir)
    per_day = flow.groupBy("data_fluxo").agg(F.countDistinct("km_fluxo").alias("sensors"))
    return plain(enrich(flow, per_day, "data_fluxo").select("id_fluxo", "data_fluxo", "sensors"))


NEAREST_OUT_SQL = f"""select id_acidente, cast(km_acidente as double) as km_acidente,
  cast(km_sensor as double) as sensor_km from ({PLACED_SQL})"""


@check("nearest_sensor_case", NEAREST_OUT_SQL)
def nearest_sensor_case(spark, sf_dir):
    accidents = B.accidents(spark, sf_dir)
    sensor = nearest_sensor(F.col("km_acidente"), SENSOR_KM)
    return plain(accidents.select("id_acidente", "km_acidente", sensor.alias("sensor_km")))


@check("nearest_sensor_join", NEAREST_OUT_SQL)
def nearest_sensor_join(spark, sf_dir):
    seen = B.flow(spark, sf_dir).select(F.col("br_fluxo").alias("road"), "km_fluxo")
    stretches = segment_table(seen, "road", "km_fluxo")
    accidents = B.accidents(spark, sf_dir).withColumn("road", F.col("br_acidente"))
    placed = assign_nearest(accidents, "road", "km_acidente", stretches)
    return plain(placed.select("id_acidente", "km_acidente", "sensor_km"))


@check("dedup_latest", f"""
with f as ({B.FLOW_SQL}) select id_fluxo, dt_proc, ref, volume_total_fluxo
from (select *, rank() over (partition by id_fluxo order by ref || dt_proc desc) as r from f)
where r = 1""")
def dedup_latest(spark, sf_dir):
    latest = latest_version(B.flow(spark, sf_dir), "id_fluxo", loaded_version())
    return latest.select("id_fluxo", "dt_proc", "ref", "volume_total_fluxo")


@check("dedup_latest_skewed", f"""
with f as (select * replace (case when volume_total_fluxo % 3 = 0 then -1 else id_fluxo end as id_fluxo)
           from ({B.FLOW_SQL}))
select id_fluxo, dt_proc, ref, volume_total_fluxo
from (select *, rank() over (partition by id_fluxo order by ref || dt_proc desc) as r from f)
where r = 1""")
def dedup_latest_skewed(spark, sf_dir):
    """One key holds about a third of all rows."""
    crowded = F.when(F.col("volume_total_fluxo") % 3 == 0, F.lit(-1)).otherwise(F.col("id_fluxo"))
    flow = B.flow(spark, sf_dir).withColumn("id_fluxo", crowded.cast("int"))
    latest = latest_version(flow, "id_fluxo", loaded_version())
    return latest.select("id_fluxo", "dt_proc", "ref", "volume_total_fluxo")


# --- aggregates ----------------------------------------------------------------------


@check("agg_max_per_key", f"""select id_fluxo, max(ref || dt_proc) as max_version
  from ({B.FLOW_SQL}) group by 1""")
def agg_max_per_key(spark, sf_dir):
    flow = B.flow(spark, sf_dir)
    return flow.groupBy("id_fluxo").agg(F.max(loaded_version()).alias("max_version"))


@check("agg_count_distinct_day", """
select strftime(o_orderdate, '%Y-%m-%d') as day,
       count(distinct case when o_custkey % 3 = 0 then o_custkey end) as customers
from orders group by 1""")
def agg_count_distinct_day(spark, sf_dir):
    customer = F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey"))
    return table(spark, sf_dir, "orders").groupBy(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    ).agg(F.countDistinct(customer).alias("customers"))


@check("agg_row_count", "select count(*) as qtd_registros from lineitem")
def agg_row_count(spark, sf_dir):
    """The count taken while the rows are written."""
    lines = table(spark, sf_dir, "lineitem")
    rows = write_counted(lines, new_folder(spark, "counted")).rows
    return spark.range(1).select(F.lit(rows).cast("long").alias("qtd_registros"))


@check("group_by_keys", f"""select cast(km_fluxo as double) as km_fluxo, ref, count(*) as n
  from (select nullif(km_fluxo, 534.25) as km_fluxo, ref from ({B.FLOW_SQL})) t
  group by t.km_fluxo, ref""")
def group_by_keys(spark, sf_dir):
    km = F.when(F.col("km_fluxo") != F.lit("534.25").cast("decimal(14,3)"), F.col("km_fluxo"))
    flow = B.flow(spark, sf_dir).withColumn("km_fluxo", km)
    return plain(flow.groupBy("km_fluxo", "ref").agg(F.count(F.lit(1)).alias("n")))


@check("duplicate_check_top5", f"""select id_fluxo, count(*) as qtd from ({B.FLOW_SQL})
  group by 1 order by 2 desc, 1 limit 5""")
def duplicate_check_top5(spark, sf_dir):
    return duplicate_report(B.flow(spark, sf_dir), "id_fluxo")


DAY_CUSTOMERS_SQL = """
select strftime(o_orderdate, '%Y-%m-%d') as day,
       count(distinct case when o_custkey % 3 = 0 then o_custkey end) as customers
from orders group by 1"""


@check("distinct_merged", DAY_CUSTOMERS_SQL)
def distinct_merged(spark, sf_dir):
    """Three loads counted one by one; their stored bitmaps merged."""
    orders = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey")).alias("customer"),
        (F.col("o_orderkey") % 3).alias("load"),
    )
    path = new_folder(spark, "day-customers")
    for load in range(3):
        part = distinct_bitmaps(orders.where(F.col("load") == load), ["day"], F.col("customer"))
        part.write.mode("append").parquet(path)
    return bitmap_counts(spark.read.parquet(path), ["day"], "customers")


@check("duplicate_top5_skewed", f"""
with f as (select case when volume_total_fluxo % 3 = 0 then -1 when volume_total_fluxo % 7 = 0 then id_fluxo % 50
                       else id_fluxo end as id_fluxo from ({B.FLOW_SQL}))
select id_fluxo, count(*) as qtd from f group by 1 order by 2 desc, 1 limit 5""")
def duplicate_top5_skewed(spark, sf_dir):
    volume, key = F.col("volume_total_fluxo"), F.col("id_fluxo")
    crowded = F.when(volume % 3 == 0, F.lit(-1)).when(volume % 7 == 0, key % 50).otherwise(key)
    return top_duplicates(B.flow(spark, sf_dir).select(crowded.alias("id_fluxo")), "id_fluxo")


@check("duplicate_top5_flat", f"""select id_fluxo, count(*) as qtd from ({B.FLOW_SQL})
  group by 1 order by 2 desc, 1 limit 5""")
def duplicate_top5_flat(spark, sf_dir):
    """No key stands out, so the bound proves nothing."""
    return top_duplicates(B.flow(spark, sf_dir), "id_fluxo")


# --- windows -------------------------------------------------------------------------

DAY_ORDER = ("o_custkey", "o_orderkey")

ORDERS_SQL = """select cast(o_orderdate as date) as day, o_orderkey,
  case when o_custkey % 5 <> 0 then o_custkey end as o_custkey from orders"""


def orders_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("day"),
        "o_orderkey",
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey")).alias("o_custkey"),
    )


@check("row_number_nulls_last", f"""select o_orderkey, cast(row_number() over (
  partition by day order by o_custkey nulls last, o_orderkey) as integer) as rn
  from ({ORDERS_SQL})""")
def row_number_nulls_last(spark, sf_dir):
    order = [F.asc_nulls_last(c) for c in DAY_ORDER]
    return numbered_rows(orders_by_day(spark, sf_dir), "day", order).select("o_orderkey", "rn")


@check("anchor_day_measure", f"""
select o_orderkey, case when rn = 1 then customers end as day_customers
from (select *, row_number() over (
        partition by day order by o_custkey nulls last, o_orderkey) as rn from ({ORDERS_SQL}))
join (select day, count(distinct o_custkey) as customers from ({ORDERS_SQL}) group by 1)
using (day)""")
def anchor_day_measure(spark, sf_dir):
    per_day = F.countDistinct("o_custkey")
    orders = orders_by_day(spark, sf_dir)
    anchored = anchor_measure(orders, "day", DAY_ORDER, per_day, "day_customers")
    return anchored.select("o_orderkey", "day_customers")
