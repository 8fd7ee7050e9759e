"""Scans, sinks, state, increments and the monthly run, on files written for the purpose."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import iso_date, to_int, to_number
from ..operators import enrich, filter_new, next_hwm
from ..plans import LakePaths, Subject, ingest_subject, run_month
from ..schemas import ACCIDENTS_TRANSIENT, CONTROL, FLOW_TRANSIENT, STATE
from ..scratch import new_folder
from ..sinks import append_by_ref, put_hwm, write_raw
from ..sources import latest_marks, read_delimited, read_layer, read_refs, scan_records
from . import bindings as B
from .registry import check, plain, table

# --- scans ---------------------------------------------------------------------------

LINES = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
    ]
)


# Lines of one file: a packed file is read by one task.
FILE_LINES = 1_000_000


def write_delimited(df: DataFrame, path: str) -> None:
    """Packed files with a header line each; as plain text they are some six times as large."""
    writer = df.write.option("sep", ";").option("header", True).option("encoding", "UTF-8")
    writer = writer.option("compression", "gzip").option("maxRecordsPerFile", FILE_LINES)
    # speed labels may end in a space, which the writer would drop
    writer = writer.option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).csv(path)


@check("scan_delimited", """select l_orderkey, l_linenumber, l_quantity, l_returnflag
  from lineitem""")
def scan_delimited(spark, sf_dir):
    path = new_folder(spark, "delimited")
    write_delimited(table(spark, sf_dir, "lineitem"), path)
    return read_delimited(spark, path, LINES)


MIXED = T.StructType([T.StructField(n, T.StringType()) for n in ("l_orderkey", "l_partkey", "l_tax")])


@check("scan_delimited_mixed_numbers", """select cast(l_orderkey as bigint) as order_key,
  cast(l_partkey as integer) as part_key, l_tax as tax from lineitem""")
def scan_delimited_mixed_numbers(spark, sf_dir):
    """Whole numbers spelled ``40``, ``40.0`` and with blanks around, typed after the scan."""
    lines, path = table(spark, sf_dir, "lineitem"), new_folder(spark, "delimited")

    def spelled(name: str, turn: str):
        text, way = F.col(name).cast("bigint").cast("string"), F.col(turn) % 3
        blanks = F.concat(F.lit(" "), text, F.lit(" "))
        return F.when(way == 0, text).when(way == 1, F.concat(text, F.lit(".0"))).otherwise(blanks).alias(name)

    write_delimited(lines.select(spelled("l_orderkey", "l_partkey"), spelled("l_partkey", "l_suppkey"), "l_tax"), path)
    return read_delimited(spark, path, MIXED).select(
        to_int(F.col("l_orderkey"), "bigint").alias("order_key"),
        to_int(F.col("l_partkey")).alias("part_key"),
        to_number(F.col("l_tax")).alias("tax"),
    )


# Which lines are spoiled, and how; the others are whole.
SPOILED = {
    "l_orderkey % 41 = 0": ("fields", "l_orderkey || ';' || l_linenumber || ';' || l_quantity_text"),
    "l_orderkey % 43 = 0": ("fields", "l_orderkey || ';' || l_linenumber || ';' || l_quantity_text || ';R;more'"),
    "l_orderkey % 47 = 0": ("quotes", "l_orderkey || ';' || l_linenumber || ';' || l_quantity_text || ';\"R'"),
}
WHOLE_LINE = "l_orderkey || ';' || l_linenumber || ';' || l_quantity_text || ';\"' || l_returnflag || '\"'"


def _spoiled(what: int | None) -> str:
    """A CASE over ``SPOILED``: the reason (0) or the line (1); of whole lines, NULL or the line."""
    cases = " ".join(f"when {rule} then {v[what] if what else repr(v[what])}" for rule, v in SPOILED.items())
    return f"case {cases} else {WHOLE_LINE if what else 'null'} end"


@check("scan_delimited_broken", f"""
select reason, case when reason is not null then line end as text,
       case when reason is null then l_orderkey end as l_orderkey,
       case when reason is null then l_linenumber end as l_linenumber,
       case when reason is null then cast(trunc(l_quantity) as double) end as l_quantity,
       case when reason is null then l_returnflag end as l_returnflag
from (select *, {_spoiled(0)} as reason, {_spoiled(1)} as line
      from (select *, cast(cast(trunc(l_quantity) as bigint) as varchar) as l_quantity_text from lineitem))""")
def scan_delimited_broken(spark, sf_dir):
    """Lines with a field too few or too many, or an open quote, among whole ones."""
    path = new_folder(spark, "broken")
    lines = table(spark, sf_dir, "lineitem").withColumn("l_quantity_text", F.col("l_quantity").cast("bigint").cast("string"))
    # One column whose name is the header line, and nothing that the writer would quote.
    text = lines.select(F.expr(_spoiled(1)).alias(";".join(LINES.fieldNames())))
    text.write.option("sep", "\u0001").option("quote", "\u0000").option("header", True).csv(path)
    scan = scan_records(spark, path, LINES)
    rows, broken = scan.rows(), scan.broken()
    return rows.select(F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("text"), "*").unionByName(
        broken.select("reason", "text"), allowMissingColumns=True
    )


@check("scan_parquet", """select l_orderkey, l_linenumber, l_quantity, l_returnflag
  from lineitem""")
def scan_parquet(spark, sf_dir):
    return read_layer(spark, f"{sf_dir}/lineitem.parquet", LINES)


MONTHLY = T.StructType(
    [
        T.StructField("id_acidente", T.LongType()),
        T.StructField("causa_acidente", T.StringType()),
        T.StructField("ref", T.IntegerType()),
    ]
)


def accidents_by_month(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    path = new_folder(spark, "accidents_by_month")
    rows = B.accidents(spark, sf_dir).select(*MONTHLY.fieldNames())
    append_by_ref(rows, path, rebalance=True)
    return path, rows


@check("scan_ref_range", f"""select id_acidente, causa_acidente, ref from ({B.ACCIDENTS_SQL})
  where ref between {B.RUN.first_ref} and {B.RUN.ref}""")
def scan_ref_range(spark, sf_dir):
    path, _ = accidents_by_month(spark, sf_dir)
    return read_refs(spark, path, MONTHLY, B.RUN.first_ref, B.RUN.ref)


# --- sinks ---------------------------------------------------------------------------


@check("sink_partitioned_roundtrip",
       f"select id_acidente, causa_acidente, ref from ({B.ACCIDENTS_SQL})")
def sink_partitioned_roundtrip(spark, sf_dir):
    path, rows = accidents_by_month(spark, sf_dir)
    # one month again: replaced, not doubled
    append_by_ref(rows.where(F.col("ref") == B.RUN.ref), path, mode="overwrite")
    return read_layer(spark, path, MONTHLY)


def dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", iso_date(F.col("ts")).alias("day")
    )


@check("sink_raw_roundtrip", """
select event_id, event_type, strftime(ts, '%Y-%m-%d') as day, '20240131000000' as dt_proc,
       (select strftime(max(ts), '%Y-%m-%d') from events) as hwm from events""")
def sink_raw_roundtrip(spark, sf_dir):
    path = new_folder(spark, "raw")
    load = dated_events(spark, sf_dir)
    written = write_raw(load, path, "20240131000000", "day")
    layout = T.StructType([*load.schema.fields, T.StructField("dt_proc", T.StringType())])
    return read_layer(spark, path, layout).withColumn("hwm", F.lit(written.metrics["hwm"]))


@check("one_row_relation", f"""select 'tb_trusted_acidentes' as tb_name,
  cast({B.DT_PROC} as bigint) as dt_proc, (select count(*) from orders) as qtd_registros""")
def one_row_relation(spark, sf_dir):
    return spark.sql(
        """select :tb_name as tb_name, :dt_proc as dt_proc,
                  (select count(*) from {rows}) as qtd_registros""",
        args={"tb_name": "tb_trusted_acidentes", "dt_proc": B.DT_PROC},
        rows=table(spark, sf_dir, "orders"),
    )


# --- increments ----------------------------------------------------------------------

MARK = "2024-01-15"


@check("hwm_read", """select event_type as subject, strftime(max(ts), '%Y-%m-%d') as hwm
  from events group by 1""")
def hwm_read(spark, sf_dir):
    """Every event type loaded day by day, the marks read back."""
    loads = dated_events(spark, sf_dir).groupBy("event_type", "day").agg(F.count(F.lit(1)))
    path = new_folder(spark, "state")
    loads.select(
        F.col("event_type").alias("subject"),
        F.col("day").alias("hwm"),
        F.concat(F.replace("day", F.lit("-"), F.lit("")), F.lit("000000")).alias("dt_proc"),
    ).write.parquet(path)
    return latest_marks(read_layer(spark, path, STATE))


@check("incremental_filter", f"""select event_id, strftime(ts, '%Y-%m-%d') as day from events
  where cast(ts as date) > date '{MARK}'""")
def incremental_filter(spark, sf_dir):
    return filter_new(dated_events(spark, sf_dir), "day", MARK).select("event_id", "day")


@check("hwm_advance", f"""select strftime(max(ts), '%Y-%m-%d') as hwm from events
  where cast(ts as date) > date '{MARK}'""")
def hwm_advance(spark, sf_dir):
    return next_hwm(filter_new(dated_events(spark, sf_dir), "day", MARK), "day")


EVENTS = Subject(
    "eventos",
    "tb_raw_eventos",
    T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("day", T.StringType()),
            T.StructField("event_type", T.StringType()),
        ]
    ),
    "day",
    day_first=True,
)


@check("ingest_increment", f"""
select event_id, strftime(ts, '%Y-%m-%d') as day, event_type, '20240131000000' as dt_proc,
       (select strftime(max(ts), '%Y-%m-%d') from events) as hwm_after,
       (select count(*) from events where cast(ts as date) > date '{MARK}') as qtd_registros
from events where cast(ts as date) > date '{MARK}'""")
def ingest_increment(spark, sf_dir):
    root = new_folder(spark, "ingest")
    events = table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "dd/MM/yyyy").alias("day"), "event_type"
    )
    write_delimited(events, f"{root}/source")
    put_hwm(spark, f"{root}/state", EVENTS.name, MARK, "20240115000000")
    ingest_subject(
        spark, EVENTS, f"{root}/source", f"{root}/raw", f"{root}/state", f"{root}/control",
        "20240131000000",
    )
    layout = T.StructType([*EVENTS.schema.fields, T.StructField("dt_proc", T.StringType())])
    state = read_layer(spark, f"{root}/state", STATE)
    audit = read_layer(spark, f"{root}/control", CONTROL)
    return read_layer(spark, f"{root}/raw", layout).withColumns(
        {
            "hwm_after": latest_marks(state).select("hwm").scalar(),
            "qtd_registros": audit.agg(F.sum("qtd_registros")).scalar(),
        }
    )


# --- the monthly run -----------------------------------------------------------------


def transient_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow text columns from ``lineitem`` in the layout of the delimited source."""
    flow = B.flow(spark, sf_dir)
    columns = {
        "data_da_passagem": F.date_format("data_fluxo", "dd/MM/yyyy"),
        "concessionaria": F.lit("Via"),
        "identificador": F.col("id_fluxo").cast("string"),
        "rodovia": F.lit("BR-040"),
        "uf": F.col("uf_fluxo"),
        "km_m": F.col("km_fluxo"),
        "municipio": F.col("id_fluxo").cast("string"),
        "tipo_de_pista": F.lit("Principal"),
        "latitude": F.lit(-20.5),
        "longitude": F.lit(-43.5),
        "sentido_da_passagem": F.col("sentido_fluxo"),
        "faixa_da_passagem": F.lit("1"),
        "velocidade": F.col("velocidade_fluxo"),
        "tipo_de_veiculo": F.col("tipo_de_veiculo_fluxo"),
        "volume_total": F.col("volume_total_fluxo"),
    }
    return flow.select(*(columns[name].alias(name) for name in FLOW_TRANSIENT.fieldNames()))


def transient_accidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accident text columns from ``orders``; positions and directions as in the bindings."""
    accidents = B.accidents(spark, sf_dir)
    given = {
        "id": F.col("id_acidente").cast("string"),
        "data_inversa": iso_date(F.col("data_acidente")),
        "uf": F.col("uf_acidente"),
        "br": F.col("br_acidente"),
        "km": F.replace(F.col("km_acidente").cast("string"), F.lit("."), F.lit(",")),
        "sentido_via": F.col("sentido_acidente"),
        "causa_acidente": F.col("causa_acidente"),
        "tipo_acidente": F.col("tipo_acidente"),
        "classificacao_acidente": F.col("classificacao_acidente"),
        "veiculos": F.col("veiculos_acidente"),
        "latitude": F.lit("-20,5"),
        "longitude": F.lit("-43,5"),
    }
    return accidents.select(
        *(
            given.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
            for f in ACCIDENTS_TRANSIENT
        )
    )


def monthly_lake(spark: SparkSession, sf_dir: str) -> LakePaths:
    """A whole run, sources included, under a fresh root."""
    root = new_folder(spark, "lake")
    lake = LakePaths(root, f"{root}/01_transient/fluxo", f"{root}/01_transient/acidentes")
    write_delimited(transient_flow(spark, sf_dir), lake.flow_source)
    write_delimited(transient_accidents(spark, sf_dir), lake.accidents_source)
    run_month(spark, lake, B.AS_OF, str(B.DT_PROC), id_mode="md5")
    return lake


# The six natural-key columns hold id_fluxo (as the town), so equal keys are equal ids
# with equal day, vehicle, speed, position and direction; all rows carry one load stamp.
RUN_FLOW_SQL = f"""
select * replace (id_fluxo || '/' || data_fluxo || '/' || tipo_de_veiculo_fluxo || '/'
                  || velocidade_fluxo || '/' || km_fluxo || '/' || sentido_fluxo as id_fluxo,
                  '{B.DT_PROC}' as dt_proc)
from ({B.FLOW_SQL})"""
RUN_ACCIDENTS_SQL = f"select * replace ('{B.DT_PROC}' as dt_proc) from ({B.ACCIDENTS_SQL})"
RUN_CTES = B.stage_ctes(RUN_FLOW_SQL, RUN_ACCIDENTS_SQL)


@check("control_rows", RUN_CTES + f"""
select tb_name, '{B.DT_PROC}' as dt_proc, qtd_registros from (
  select 'tb_raw_fluxo' as tb_name, count(*) as qtd_registros from flow_all
  union all select 'tb_raw_acidentes', count(*) from accidents_all
  union all select 'tb_trusted_fluxo', count(*) from flow_all
  union all select 'tb_trusted_acidentes', count(*) from accidents_all
  union all select 'tb_refined_stage', count(*) from stage
  union all select 'tb_refined_book', count(distinct km_fluxo) from stage)""")
def control_rows(spark, sf_dir):
    lake = monthly_lake(spark, sf_dir)
    layers = [read_layer(spark, lake.control(c), CONTROL) for c in ("raw", "trusted", "refined")]
    return layers[0].unionByName(layers[1]).unionByName(layers[2])


MONTH_STAGE_SQL = RUN_CTES + """
select cast(km_fluxo as double) as km_fluxo, ref, strftime(data_fluxo, '%Y-%m-%d') as data_fluxo,
       fbc_classificacao_tipo_veiculo, fbc_classificacao_velocidade, fbc_classificacao_volume,
       count(*) as n, cast(sum(flv_volume_fluxo) as bigint) as volume, count(id_acidente) as hits,
       cast(max(day_accidents) as bigint) as day_accidents
from (select *, sum(fvl_acidentes_dia) over (partition by data_fluxo) as day_accidents from stage) s
group by s.km_fluxo, ref, s.data_fluxo, fbc_classificacao_tipo_veiculo,
         fbc_classificacao_velocidade, fbc_classificacao_volume"""


def stored_stage(spark: SparkSession, lake: LakePaths) -> DataFrame:
    """Counts by class of the stored stage, with the day's measure, wherever it stands."""
    stage = spark.read.parquet(lake.stage)
    days = stage.groupBy("data_fluxo").agg(F.sum("fvl_acidentes_dia").alias("day_accidents"))
    return plain(
        enrich(stage, days, "data_fluxo")
        .groupBy(
            "km_fluxo", "ref", "data_fluxo", "fbc_classificacao_tipo_veiculo",
            "fbc_classificacao_velocidade", "fbc_classificacao_volume",
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("flv_volume_fluxo").alias("volume"),
            F.count("id_acidente").alias("hits"),
            F.max("day_accidents").alias("day_accidents"),
        )
    )


@check("run_month_stage", MONTH_STAGE_SQL)
def run_month_stage(spark, sf_dir):
    return stored_stage(spark, monthly_lake(spark, sf_dir))
