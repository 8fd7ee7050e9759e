"""The stage and book written the obvious way, as a yardstick for ``lakebook``.

``python tools/plain_month.py SF_DIR``: same inputs, same result. Latest rows by an
aggregate and a join back; row numbers by a window over whole days; one conditional
aggregate per feature; nothing kept between the four actions (count and write of the
stage, write and count of the book). Prints the seconds of both.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lakebook.checks import bindings as B  # noqa: E402
from lakebook.config import ProductConfig  # noqa: E402
from lakebook.functions import label_class, threshold_class  # noqa: E402
from lakebook.operators import nearest_sensor, with_lookback  # noqa: E402
from lakebook.plans import BOOK_SPEC, build_book, build_stage  # noqa: E402
from lakebook.plans.stage import ACCIDENT_COLUMNS, ANCHOR_ORDER, loaded_version  # noqa: E402
from lakebook.scratch import new_folder  # noqa: E402
from lakebook.sinks import write_month  # noqa: E402
from tests.support import local_spark  # noqa: E402
from tools.direct_book import feature_book_direct  # noqa: E402


def latest(df: DataFrame, key: str) -> DataFrame:
    keyed = df.withColumn("v", loaded_version())
    best = keyed.groupBy(key).agg(F.max("v").alias("best"))
    return keyed.join(best, key).where("v = best").drop("v", "best")


def plain_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = ProductConfig()
    run = F.col("ref").between(B.RUN.first_ref, B.RUN.ref)
    flow = latest(B.flow(spark, sf_dir).where(run), "id_fluxo").where(F.col("uf_fluxo") == "MG")
    accidents = latest(B.accidents(spark, sf_dir).where(run), "id_acidente").where(
        F.col("uf_acidente") == "MG"
    )
    sensor = nearest_sensor(F.col("km_acidente"), cfg.sensors)
    on = (
        (F.col("km_fluxo") == F.col("km_sensor"))
        & (F.col("br_fluxo") == F.col("br_acidente"))
        & (F.col("data_fluxo") == F.col("data_acidente"))
        & (F.col("sentido_fluxo") == F.col("sentido_acidente"))
    )
    joined = (
        flow.drop("ref", "dt_proc")
        .join(accidents.withColumn("km_sensor", sensor).drop("ref", "dt_proc"), on, "left")
        .withColumns(
            {
                "fbc_classificacao_volume": threshold_class(
                    F.col("volume_total_fluxo"), cfg.volume_classes
                ),
                "fbc_classificacao_velocidade": label_class(
                    F.col("velocidade_fluxo"), cfg.speed_classes
                ),
                "fbc_classificacao_tipo_veiculo": label_class(
                    F.col("tipo_de_veiculo_fluxo"), cfg.vehicle_classes
                ),
                "flv_volume_fluxo": F.col("volume_total_fluxo"),
            }
        )
    )
    day = Window.partitionBy("data_fluxo").orderBy(*(F.asc_nulls_last(c) for c in ANCHOR_ORDER))
    numbered = joined.withColumn("rn", F.row_number().over(day))
    per_day = joined.groupBy("data_fluxo").agg(F.countDistinct("id_acidente").alias("n"))
    return numbered.join(per_day, "data_fluxo", "left").select(
        "id_fluxo", "km_fluxo", F.lit(B.DT_PROC).alias("dt_proc"), F.lit(B.RUN.ref).alias("ref"),
        "data_fluxo", "fbc_classificacao_volume", "fbc_classificacao_velocidade",
        "fbc_classificacao_tipo_veiculo", "flv_volume_fluxo",
        F.when(F.col("rn") == 1, F.col("n")).alias("fvl_acidentes_dia"), *ACCIDENT_COLUMNS,
    )


def plain_month(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    stage = plain_stage(spark, sf_dir)
    stage.count()
    stage.write.partitionBy("ref").parquet(f"{root}/stage")
    flagged = with_lookback(stage, "data_fluxo", B.RUN.ref_date, (1, 3, 6, 9, 12))
    book = feature_book_direct(flagged, BOOK_SPEC)
    book.write.partitionBy("ref").parquet(f"{root}/book")
    book.count()
    return spark.read.parquet(f"{root}/book")


def our_month(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    stage = build_stage(B.flow(spark, sf_dir), B.accidents(spark, sf_dir), B.RUN, B.DT_PROC)
    write_month(stage, f"{root}/stage", B.RUN.ref)
    stored = spark.read.schema(stage.schema).parquet(f"{root}/stage")
    write_month(build_book(stored, B.RUN), f"{root}/book", B.RUN.ref)
    return spark.read.parquet(f"{root}/book")


def main(sf_dir: str) -> None:
    spark = local_spark()
    results = {}
    for round_number in range(3):
        for label, job in (("plain", plain_month), ("lakebook", our_month)):
            root = new_folder(spark, label)
            start = time.perf_counter()
            results[label] = job(spark, sf_dir, root)
            print(f"round {round_number} {label} {time.perf_counter() - start:.2f}s", flush=True)
    a, b = (sorted(map(str, r.select(sorted(r.columns)).collect())) for r in results.values())
    print("same book:", a == b)


if __name__ == "__main__":
    main(sys.argv[1])
