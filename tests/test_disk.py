"""What the jobs leave on disk: packed sources and layers, no shuffles of finished writes, no copy of a join."""

import time
from datetime import date

from pyspark.sql import functions as F

from lakebook import scratch
from lakebook.checks import lake as lake_checks
from lakebook.operators import anchor_measure
from lakebook.plans import build_stage
from lakebook.runwindow import RunWindow
from lakebook.scratch import materialize, new_folder, scratch_root
from lakebook.sinks.layers import write_counted
from lakebook.storage import children


def shuffle_files(spark) -> set[str]:
    """The shuffle data this process holds."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def test_a_finished_write_keeps_no_shuffle(spark):
    rows = spark.range(10_000).repartition(5, "id")
    for write in (lambda: materialize(rows, "dealt"), lambda: write_counted(rows, new_folder(spark, "counted"))):
        before, setting = shuffle_files(spark), spark.conf.get(scratch.CLEANUP, None)
        write()
        until = time.time() + 20
        while shuffle_files(spark) - before and time.time() < until:
            time.sleep(0.2)
        assert not shuffle_files(spark) - before
        assert spark.conf.get(scratch.CLEANUP, None) == setting


def test_sources_and_layers_are_packed(spark, monkeypatch):
    monkeypatch.setattr(lake_checks, "FILE_LINES", 40)
    path = new_folder(spark, "packed")
    lake_checks.write_delimited(spark.range(100).coalesce(1).selectExpr("id", "' x ' as x"), path)
    files = children(spark, path)
    assert len(files) == 3 and all(name.endswith(".csv.gz") for name in files)
    back = spark.read.option("sep", ";").option("header", True).csv(path)
    assert sorted((int(r.id), r.x) for r in back.collect()) == [(i, " x ") for i in range(100)]
    write_counted(spark.range(10), path := new_folder(spark, "layer"))
    assert all(".zstd." in name for name in children(spark, path))


def test_the_joined_rows_are_not_written(spark):
    """60 flow rows and 50 accidents of one sensor and day make 3,000 rows."""
    flow = spark.range(60).select(
        F.col("id").cast("int").alias("id_fluxo"), F.lit("1").alias("dt_proc"), F.lit(202401).alias("ref"),
        F.lit(date(2024, 1, 5)).alias("data_fluxo"), F.lit("527.200").cast("decimal(14,3)").alias("km_fluxo"),
        F.lit(40).alias("br_fluxo"), F.lit("Crescente").alias("sentido_fluxo"), F.lit("MG").alias("uf_fluxo"),
        F.lit("Moto").alias("tipo_de_veiculo_fluxo"), F.lit("> 160 KM/h").alias("velocidade_fluxo"),
        F.lit(7).cast("bigint").alias("volume_total_fluxo"),
    )
    accidents = spark.range(50).select(
        (F.col("id") + 3).cast("int").alias("id_acidente"), F.lit("1").alias("dt_proc"), F.lit(202401).alias("ref"),
        F.lit(date(2024, 1, 5)).alias("data_acidente"), F.lit("527.200").cast("decimal(14,3)").alias("km_acidente"),
        F.lit(40).alias("br_acidente"), F.lit("Crescente").alias("sentido_acidente"), F.lit("MG").alias("uf_acidente"),
        *(F.lit("x").alias(c) for c in ("causa_acidente", "tipo_acidente", "classificacao_acidente")),
        F.lit(None).cast("string").alias("condicao_metereologica_acidente"), F.lit(1).alias("veiculos_acidente"),
    )
    # Each row twice: copies are told apart, and one of them is marked.
    twice = accidents.union(accidents)
    folder = f"{scratch_root(spark)}/lakebook"
    before = set(children(spark, folder))
    stage = build_stage(flow.union(flow), twice, RunWindow.of(date(2024, 1, 31)), 1)
    written = set(children(spark, folder)) - before
    assert sum(spark.read.parquet(f"{folder}/{name}").count() for name in written) < 500
    marked = stage.where("fvl_acidentes_dia is not null").collect()
    assert stage.count() == 4 * 3_000
    assert [(r.id_fluxo, r.id_acidente, r.fvl_acidentes_dia) for r in marked] == [(0, 3, 50)]


def test_groups_may_be_found_in_fewer_rows(spark):
    rows = materialize(
        spark.range(400).select(
            "id", F.when(F.col("id") % 9 != 0, F.col("id") % 4).alias("day"),
            F.when(F.col("id") % 3 != 0, F.col("id") % 50).alias("acc"), (F.col("id") % 7).alias("x"),
        ),
        "told",
    )
    measure = F.countDistinct("acc")
    plainly = anchor_measure(rows.drop("id"), "day", ("acc", "x"), measure, "n")
    few = rows.dropDuplicates(["day", "acc", "x"])
    told = anchor_measure(rows, "day", ("acc", "x"), measure, "n", ("id",), few)
    assert told.columns == plainly.columns
    assert sorted(map(str, told.collect())) == sorted(map(str, plainly.collect()))
    assert told.where("n is not null").count() == 4
