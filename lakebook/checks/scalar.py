"""Column expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SPEED_CLASSES, VEHICLE_CLASSES, VOLUME_CLASSES
from ..functions import (
    decimal_comma,
    iso_date,
    label_class,
    month_key,
    natural_key_hash,
    natural_key_md5,
    parse_day_first,
    tail,
    threshold_class,
    to_date,
    to_decimal,
    to_double,
    to_int,
    version_key,
)
from ..operators import collisions
from ..runwindow import RunWindow
from . import bindings as B
from .registry import check, plain, table

def orders_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), iso_date(F.col("o_orderdate")).alias("iso")
    )


def road_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``BR-040``-like road names, with unusable ones among them."""
    key = F.col("c_custkey")
    number = F.lpad((key % 500).cast("string"), 3, "0")
    road = F.when(key % 11 == 0, F.concat(F.lit("BR-"), F.col("c_mktsegment"))).when(
        key % 13 != 0, F.concat(F.lit("BR-"), number)
    )
    return table(spark, sf_dir, "customer").select(key.alias("id"), road.alias("road"))


ROADS_SQL = """select c_custkey as id,
  case when c_custkey % 11 = 0 then 'BR-' || c_mktsegment
       when c_custkey % 13 <> 0 then 'BR-' || lpad(cast(c_custkey % 500 as varchar), 3, '0')
  end as road from customer"""


def comma_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices as text with a decimal comma, with words and missing values among them."""
    key = F.col("p_partkey")
    price = F.concat_ws(
        ",", F.floor("p_retailprice").cast("string"), F.lpad((key % 10000).cast("string"), 4, "0")
    )
    text = F.when(key % 17 == 0, F.col("p_type")).when(key % 19 != 0, price)
    return table(spark, sf_dir, "part").select(key.alias("id"), text.alias("price"))


PRICES_SQL = """select p_partkey as id,
  case when p_partkey % 17 = 0 then p_type
       when p_partkey % 19 <> 0 then cast(cast(floor(p_retailprice) as bigint) as varchar) || ','
         || lpad(cast(p_partkey % 10000 as varchar), 4, '0')
  end as price from part"""


@check("str_substring", """select o_orderkey as id,
  substring(strftime(o_orderdate, '%Y-%m-%d'), 1, 4) as year_text,
  substring(o_orderpriority, 3, 4) as priority_text from orders""")
def str_substring(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.substring(iso_date(F.col("o_orderdate")), 1, 4).alias("year_text"),
        F.substring("o_orderpriority", 3, 4).alias("priority_text"),
    )


@check("str_substring_tail",
       f"select id, substring(road, 4) as road_tail from ({ROADS_SQL})")
def str_substring_tail(spark, sf_dir):
    return road_names(spark, sf_dir).select("id", tail(F.col("road"), 4).alias("road_tail"))


@check("str_replace", """select o_orderkey as id,
  replace(strftime(o_orderdate, '%Y-%m-%d'), '-', '') as compact from orders""")
def str_replace(spark, sf_dir):
    compact = F.replace(F.col("iso"), F.lit("-"), F.lit(""))
    return orders_iso(spark, sf_dir).select("id", compact.alias("compact"))


@check("str_regexp_replace", f"""select id, regexp_replace(price, ',', '.', 'g') as price_text
  from ({PRICES_SQL})""")
def str_regexp_replace(spark, sf_dir):
    return comma_prices(spark, sf_dir).select(
        "id", F.regexp_replace("price", ",", ".").alias("price_text")
    )


@check("str_concat_pipe", f"select id_fluxo as id, ref || dt_proc as version from ({B.FLOW_SQL})")
def str_concat_pipe(spark, sf_dir):
    return B.flow(spark, sf_dir).select(
        F.col("id_fluxo").alias("id"), version_key(F.col("ref"), F.col("dt_proc")).alias("version")
    )


@check("str_concat_nulls", f"""select id, road || '/' || cast(id as varchar) as joined
  from ({ROADS_SQL})""")
def str_concat_nulls(spark, sf_dir):
    joined = F.concat(F.col("road"), F.lit("/"), F.col("id"))
    return road_names(spark, sf_dir).select("id", joined.alias("joined"))


def natural_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six text columns; one is missing in some rows."""
    return B.flow(spark, sf_dir).select(
        "id_fluxo",
        iso_date(F.col("data_fluxo")).alias("day"),
        F.when(F.col("tipo_de_veiculo_fluxo") != "Outro", F.col("tipo_de_veiculo_fluxo"))
        .alias("vehicle"),
        F.col("velocidade_fluxo").alias("speed"),
        F.col("km_fluxo").cast("string").alias("km"),
        F.col("uf_fluxo").alias("town"),
        F.col("sentido_fluxo").alias("direction"),
    )


KEY_PARTS = ("day", "vehicle", "speed", "km", "town", "direction")
KEY_SQL = f"""select id_fluxo, strftime(data_fluxo, '%Y-%m-%d') as day,
  nullif(tipo_de_veiculo_fluxo, 'Outro') as vehicle, velocidade_fluxo as speed,
  cast(km_fluxo as varchar) as km, uf_fluxo as town, sentido_fluxo as direction
  from ({B.FLOW_SQL})"""


def _mod32(value: str) -> str:
    return f"(({value}) % 4294967296)"


def _rotate(value: str, bits: int) -> str:
    return _mod32(f"{value} * {1 << bits} + {value} // {1 << (32 - bits)}")


def murmur3_sql(text: str) -> str:
    """The public 32-bit Murmur3 hash (seed 42) of a text column, as Spark defines it.

    Four bytes at a time, little end first; the last bytes one by one, sign-extended.
    All arithmetic is on unsigned 64-bit numbers modulo 2**32.
    """
    mixed_k = _mod32(_rotate(_mod32("k * 3432918353"), 15) + " * 461845907")
    mixed_h = _mod32(_rotate(f"xor(h, {mixed_k})", 13) + " * 5 + 3864292196")
    steps = f"""
      bytes as (select id, {text} is null as missing,
                [cast('0x' || substring(hex({text}), 2 * i + 1, 2) as ubigint)
                 for i in range(octet_length(encode({text})))] as b from keyed),
      words as (select id, missing, len(b) as n, list_concat(
          [b[4*i+1] + b[4*i+2] * 256 + b[4*i+3] * 65536 + b[4*i+4] * 16777216
           for i in range(len(b) // 4)],
          [case when b[i] > 127 then b[i] + 4294967040 else b[i] end
           for i in range(len(b) // 4 * 4 + 1, len(b) + 1)]) as w from bytes),
      h0 as (select id, missing, xor(list_reduce(list_concat([cast(42 as ubigint)], w),
                 lambda h, k: {mixed_h}), cast(n as ubigint)) as h from words),
      h1 as (select id, missing, {_mod32("xor(h, h // 65536) * 2246822507")} as h from h0),
      h2 as (select id, missing, {_mod32("xor(h, h // 8192) * 3266489909")} as h from h1),
      h3 as (select id, missing, xor(h, h // 65536) as h from h2)
    select id, cast(case when missing then 42
                    when h > 2147483647 then cast(h as bigint) - 4294967296
                    else cast(h as bigint) end as integer) as surrogate_id from h3"""
    return steps


@check("surrogate_id_hash", f"""with keyed as (
  select id_fluxo as id, {" || ".join(KEY_PARTS)} as key from ({KEY_SQL})),
  {murmur3_sql("key")}""")
def surrogate_id_hash(spark, sf_dir):
    parts = map(F.col, KEY_PARTS)
    return natural_key(spark, sf_dir).select(
        F.col("id_fluxo").alias("id"), natural_key_hash(*parts).alias("surrogate_id")
    )


@check("id_collisions", f"""with keyed as (
  select row_number() over () as id, {" || ".join(KEY_PARTS)} as key, {" , ".join(KEY_PARTS)} from ({KEY_SQL})),
  ids as (with {murmur3_sql("key").strip()})
select surrogate_id, count(*) as qtd
from (select id, row({", ".join(KEY_PARTS)}) as record from keyed) join ids using (id)
group by 1 having count(distinct record) > 1""".replace("with keyed as (", "with keyed as materialized ("))
def id_collisions(spark, sf_dir):
    """32-bit ids under which different records meet, that of missing parts among them."""
    parts = [F.col(p) for p in KEY_PARTS]
    hashed = natural_key(spark, sf_dir).withColumn("surrogate_id", natural_key_hash(*parts))
    return collisions(hashed, "surrogate_id", parts)


MD5_SQL = " || '|' || ".join(
    f"coalesce(cast(length({p}) as varchar) || ':' || {p}, '~')" for p in KEY_PARTS
)


@check("surrogate_id_md5", f"""select id_fluxo as id, md5({MD5_SQL}) as surrogate_id
  from ({KEY_SQL})""")
def surrogate_id_md5(spark, sf_dir):
    parts = map(F.col, KEY_PARTS)
    return natural_key(spark, sf_dir).select(
        F.col("id_fluxo").alias("id"), natural_key_md5(*parts).alias("surrogate_id")
    )


@check("cast_date", """select o_orderkey as id, strftime(try_cast(
    case when o_custkey % 10 = 0 then o_orderpriority
         else strftime(o_orderdate, '%Y-%m-%d') end as date), '%Y-%m-%d') as day from orders""")
def cast_date(spark, sf_dir):
    text = F.when(F.col("o_custkey") % 10 == 0, F.col("o_orderpriority")).otherwise(
        iso_date(F.col("o_orderdate"))
    )
    return plain(table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), to_date(text).alias("day")
    ))


@check("cast_int", f"""select 'road' as source, id, try_cast(substring(road, 4) as integer) as number
  from ({ROADS_SQL})
  union all select 'price', id, try_cast(split_part(price, ',', 1) as integer) from ({PRICES_SQL})""")
def cast_int(spark, sf_dir):
    roads = road_names(spark, sf_dir).select(
        F.lit("road").alias("source"), "id", to_int(tail(F.col("road"), 4)).alias("number")
    )
    prices = comma_prices(spark, sf_dir).select(
        F.lit("price").alias("source"), "id", to_int(decimal_comma(F.col("price"))).alias("number")
    )
    return roads.unionByName(prices)


@check("cast_decimal", f"""select id, cast(try_cast(replace(price, ',', '.') as decimal(14,3))
  as varchar) as km_text from ({PRICES_SQL})""")
def cast_decimal(spark, sf_dir):
    km = to_decimal(decimal_comma(F.col("price")))
    return comma_prices(spark, sf_dir).select("id", km.cast("string").alias("km_text"))


@check("cast_double", f"""select id, try_cast(regexp_replace(price, ',', '.', 'g') as double)
  as latitude from ({PRICES_SQL})""")
def cast_double(spark, sf_dir):
    latitude = to_double(F.regexp_replace("price", ",", "."))
    return comma_prices(spark, sf_dir).select("id", latitude.alias("latitude"))


@check("month_key", """select o_orderkey as id, strftime(o_orderdate, '%Y%m') as ref
  from orders""")
def month_key_text(spark, sf_dir):
    return orders_iso(spark, sf_dir).select("id", month_key(F.col("iso")).alias("ref"))


@check("date_to_iso", "select event_id, strftime(ts, '%Y-%m-%d') as iso from events")
def date_to_iso(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", iso_date(F.col("ts").cast("date")).alias("iso"))


@check("date_parse_dayfirst", """select o_orderkey as id,
  case when o_custkey % 10 <> 0 then strftime(o_orderdate, '%Y-%m-%d') end as day from orders""")
def date_parse_dayfirst(spark, sf_dir):
    text = F.when(F.col("o_custkey") % 10 == 0, F.col("o_orderstatus")).otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy")
    )
    return plain(table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), parse_day_first(text).alias("day")
    ))


@check("months_between_fn", f"""
with d as (select o_orderkey as id, cast(o_orderdate as date) as day,
           last_day(cast(o_orderdate as date) + cast(o_custkey % 400 as integer)) as month_end
           from orders)
select id, {B.months_between_sql('month_end', 'day')} as months from d""")
def months_between_fn(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    month_end = F.last_day(F.date_add(day, (F.col("o_custkey") % 400).cast("int")))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.months_between(month_end, day).alias("months")
    )


@check("bin_thresholds", f"""select id_fluxo as id, volume_total_fluxo as volume,
  {B.VOLUME_CASE} as volume_class
  from (select * replace (volume_total_fluxo - 6 as volume_total_fluxo) from ({B.FLOW_SQL}))""")
def bin_thresholds(spark, sf_dir):
    volume = F.col("volume_total_fluxo") - 6
    return B.flow(spark, sf_dir).select(
        F.col("id_fluxo").alias("id"),
        volume.alias("volume"),
        threshold_class(volume, VOLUME_CLASSES).alias("volume_class"),
    )


@check("map_labels", f"""select id_fluxo as id, velocidade_fluxo as label, {B.SPEED_CASE}
  as speed_class from ({B.FLOW_SQL})""")
def map_labels(spark, sf_dir):
    label = F.col("velocidade_fluxo")
    return B.flow(spark, sf_dir).select(
        F.col("id_fluxo").alias("id"), label.alias("label"),
        label_class(label, SPEED_CLASSES).alias("speed_class"),
    )


@check("map_vehicle", f"""select id_fluxo as id, tipo_de_veiculo_fluxo as label, {B.VEHICLE_CASE}
  as vehicle_class from ({B.FLOW_SQL})""")
def map_vehicle(spark, sf_dir):
    label = F.col("tipo_de_veiculo_fluxo")
    return B.flow(spark, sf_dir).select(
        F.col("id_fluxo").alias("id"), label.alias("label"),
        label_class(label, VEHICLE_CLASSES).alias("vehicle_class"),
    )


@check("run_window", """
select o_orderkey as id, strftime(month_end, '%Y-%m-%d') as ref_date,
       strftime(month_end, '%Y%m') as ref,
       strftime(cast(month_end - interval 12 month as date), '%Y%m') as first_ref,
       strftime(day, '%Y%m%d') || '120000' as dt_proc
from (select o_orderkey, cast(o_orderdate as date) as day,
             last_day(cast(o_orderdate as date)) as month_end from orders)""")
def run_window(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), day.alias("day"))
    # One run window for each day of the calendar that occurs.
    days = [r.day for r in orders.where("day is not null").select("day").distinct().collect()]
    runs = [(day, RunWindow.of(day)) for day in days]
    windows = spark.createDataFrame(
        [(day, run.ref_date.isoformat(), str(run.ref), str(run.first_ref)) for day, run in runs],
        "day date, ref_date string, ref string, first_ref string",
    )
    stamp = F.to_timestamp(F.concat(iso_date(F.col("day")), F.lit(" 12:00:00")))
    return orders.join(F.broadcast(windows), "day", "left").select(
        "id", "ref_date", "ref", "first_ref", F.date_format(stamp, "yyyyMMddHHmmss").alias("dt_proc")
    )
