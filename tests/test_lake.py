"""Files in, files out: ingest, month folders, reruns, and the whole monthly run."""

from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebook.__main__ import main
from lakebook.plans import LakePaths, Subject, conform_accidents, conform_flow, ingest_subject, run_month
from lakebook.plans.month import conform_month, ingest_month, read_book, refine_month
from lakebook.schemas import ACCIDENTS_TRANSIENT, ACCIDENTS_TRUSTED, CONTROL, FLOW_TRANSIENT, FLOW_TRUSTED
from lakebook.scratch import materialize, scratch_scope
from lakebook.sinks import append_by_ref, write_raw
from lakebook.sources import get_hwm, read_delimited, read_layer, read_raw, read_refs


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


TINY = T.StructType([T.StructField("day", T.StringType()), T.StructField("n", T.IntegerType())])


def test_columns_are_found_by_name(spark, tmp_path):
    path = put(tmp_path / "a.csv", "n;extra;day\n1;x;01/02/2024\nbad;y;02/02/2024\n")
    got = read_delimited(spark, path, TINY).collect()
    assert [tuple(r) for r in got] == [("01/02/2024", 1), ("02/02/2024", None)]


def test_missing_column_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="n"):
        read_delimited(spark, put(tmp_path / "a.csv", "day\n1\n"), TINY)


def test_trailing_spaces_and_accents_survive(spark, tmp_path):
    path = put(tmp_path / "a.csv", "day;n\n101 - 120 ;1\nÔnibus;2\n")
    assert [r.day for r in read_delimited(spark, path, TINY).collect()] == ["101 - 120 ", "Ônibus"]


def test_missing_texts_and_doubled_quotes(spark, tmp_path):
    schema = T.StructType([T.StructField("t", T.StringType()), T.StructField("x", T.DoubleType())])
    path = put(tmp_path / "a.csv", 't;x\nNA;1.5\n"a ""b"" c;d";NaN\nNAN;bad\nnull;2\n')
    assert [tuple(r) for r in read_delimited(spark, path, schema).collect()] == [
        (None, 1.5), ('a "b" c;d', None), ("NAN", None), (None, 2.0)]


def test_scratch_scope_drops_only_its_own_tables(spark):
    before = materialize(spark.range(3), "kept")
    with scratch_scope(spark):
        inside = materialize(spark.range(4), "dropped")
        assert inside.count() == 4
        folder = Path(inside.inputFiles()[0].removeprefix("file:")).parent
        assert folder.exists()
    assert not folder.exists() and before.count() == 3


class Lake:
    def __init__(self, spark, tmp_path):
        self.spark, self.root = spark, tmp_path
        self.subject = Subject("tiny", "tb_raw_tiny", TINY, "day", day_first=True)

    def load(self, text, dt_proc):
        source = put(self.root / f"in-{dt_proc}.csv", text)
        at = {n: str(self.root / n) for n in ("raw", "state", "control")}
        return ingest_subject(self.spark, self.subject, source, at["raw"], at["state"],
                              at["control"], dt_proc)

    def raw(self):
        layout = T.StructType([*TINY.fields, T.StructField("dt_proc", T.StringType())])
        read = read_layer(self.spark, str(self.root / "raw"), layout)
        return sorted(tuple(r) for r in read.collect())

    def mark(self):
        return get_hwm(self.spark, str(self.root / "state"), "tiny")

    def audit(self):
        read = read_layer(self.spark, str(self.root / "control"), CONTROL)
        return [tuple(r) for r in read.orderBy("dt_proc").collect()]


def test_increments(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    assert lake.mark() is None
    first = "day;n\n30/01/2024;1\n31/01/2024;2\nxx;3\n"
    assert lake.load(first, "20240131000000").rows == 2
    assert lake.mark() == "2024-01-31"
    # the same file with one later row: only that one is new, late rows are not
    assert lake.load(first + "29/01/2024;4\n01/02/2024;5\n", "20240201000000").rows == 1
    assert lake.mark() == "2024-02-01"
    # nothing new: mark and data unchanged, audited as 0
    before = lake.raw()
    assert lake.load(first, "20240202000000").rows == 0
    assert (lake.mark(), lake.raw()) == ("2024-02-01", before)
    assert before == [("2024-01-30", 1, "20240131000000"), ("2024-01-31", 2, "20240131000000"),
                      ("2024-02-01", 5, "20240201000000")]
    assert [a[2] for a in lake.audit() if a[0] == "tb_raw_tiny"] == [2, 1, 0]
    assert [a[2] for a in lake.audit() if a[0] == "tb_raw_tiny_rejected"] == [1, 1, 1]


def test_retries_and_old_stamps(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    first = "day;n\n30/01/2024;1\n31/01/2024;2\n"
    assert lake.mark() is None and not (tmp_path / "state").exists()
    lake.load(first, "20240131000000")
    # a committed stamp is not loaded again, an older stamp moves the mark on
    assert lake.load(first + "01/02/2024;3\n", "20240131000000").rows == 0
    assert lake.load(first + "01/02/2024;3\n", "20240101000000").rows == 1
    assert lake.mark() == "2024-02-01"
    assert lake.load(first + "01/02/2024;3\n", "20240301000000").rows == 0
    assert not (tmp_path / "raw" / "dt_proc=20240301000000").exists()


def test_uncommitted_load_counts_for_nothing(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lost = spark.createDataFrame([("2024-01-30", 1), ("2024-01-30", 1)], TINY)
    write_raw(lost, str(tmp_path / "raw"), "20240131000000", "day")  # and then the run died
    args = (str(tmp_path / "raw"), TINY, str(tmp_path / "state"), "tiny")
    assert read_raw(spark, *args).count() == 0
    lake.load("day;n\n30/01/2024;1\n", "20240131000000")
    assert [tuple(r) for r in read_raw(spark, *args).collect()] == [
        ("2024-01-30", 1, "20240131000000", "2024-01-30")]


def test_unusable_dates_are_kept_apart(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.subject = Subject("tiny", "tb_raw_tiny", TINY, "day")
    assert lake.load("day;n\n2024-10-09;1\n31/12/2024;2\n;3\n", "20241009000000").rows == 1
    assert lake.mark() == "2024-10-09"
    assert lake.load("day;n\n2024-10-10;4\n", "20241010000000").rows == 1
    layout = T.StructType([*TINY.fields, T.StructField("dt_proc", T.StringType())])
    kept = read_layer(spark, str(tmp_path / "raw_rejected"), layout).collect()
    assert {(r.day, r.n) for r in kept} == {("31/12/2024", 2), (None, 3)}
    assert ("tb_raw_tiny_rejected", "20241009000000", 2) in lake.audit()


def test_month_written_twice(spark, tmp_path):
    df = spark.createDataFrame([(1, 202401), (2, 202401), (3, 202402)], "x int, ref int")
    january = df.where("ref = 202401")

    def count(path):
        return read_layer(spark, path, df.schema).count()

    for rebalance in (False, True):
        path = str(tmp_path / f"layer-{rebalance}")
        assert append_by_ref(df, path, rebalance=rebalance).rows == 3
        assert append_by_ref(january, path, mode="overwrite", rebalance=rebalance).rows == 2
        assert count(path) == 3
        assert append_by_ref(january, path, rebalance=rebalance).rows == 2
        assert count(path) == 5
        assert read_refs(spark, path, df.schema, 202402, 202403).count() == 1


def test_conformed_schemas(spark):
    flow = conform_flow(spark.createDataFrame([], FLOW_TRANSIENT), "20240101000000")
    accidents = conform_accidents(spark.createDataFrame([], ACCIDENTS_TRANSIENT), "20240101000000")
    for df, schema in ((flow, FLOW_TRUSTED), (accidents, ACCIDENTS_TRUSTED)):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


def delimited(schema, records):
    names = schema.fieldNames()
    lines = [";".join(names)]
    lines += [";".join(str(r.get(n, "")) for n in names) for r in records]
    return "\n".join(lines) + "\n"


def flow_record(day, km, volume, vehicle="Moto", speed="51 - 80 KM", direction="Crescente", uf="MG"):
    return dict(data_da_passagem=day, rodovia="BR-040", uf=uf, km_m=km, municipio="Sete Lagoas",
                sentido_da_passagem=direction, velocidade=speed, tipo_de_veiculo=vehicle,
                volume_total=volume)


def accident_record(number, day, km, direction="Crescente", uf="MG"):
    return dict(id=number, data_inversa=day, uf=uf, br=40, km=km, sentido_via=direction,
                causa_acidente="Chuva", latitude="-20,5", longitude="-43,5", veiculos=2)


@pytest.fixture(scope="module")
def flow_records():
    return [
        flow_record("10/09/2024", 527.2, 50),
        flow_record("10/09/2024", 529.1, 300, vehicle="Ônibus"),
        flow_record("11/09/2024", 527.2, 120, speed="101 - 120 "),
        flow_record("15/10/2023", 527.2, 108),
        flow_record("10/09/2024", 527.2, 70, uf="SP", vehicle="Passeio"),
    ]


@pytest.fixture(scope="module")
def accident_records():
    return [
        accident_record(7, "2024-09-10", "527,3"),
        accident_record(5, "2024-09-10", "526,9"),
        accident_record(8, "2024-09-11", "527,2", direction="Decrescente"),
        accident_record(9, "2024-09-10", "527,2", uf="SP"),
    ]


def lake_at(tmp_path, flow_records, accident_records):
    flow = put(tmp_path / "in" / "flow.csv", delimited(FLOW_TRANSIENT, flow_records))
    accidents = put(tmp_path / "in" / "acc.csv", delimited(ACCIDENTS_TRANSIENT, accident_records))
    return LakePaths(str(tmp_path / "lake"), flow, accidents)


def stage_rows(spark, lake):
    return spark.read.parquet(lake.stage)


def test_monthly_run(spark, tmp_path, flow_records, accident_records):
    lake = lake_at(tmp_path, flow_records, accident_records)
    report = run_month(spark, lake, date(2024, 9, 5), "20240930120000")
    assert report.rows == {
        "tb_raw_fluxo": 5, "tb_raw_acidentes": 4, "tb_trusted_fluxo": 5,
        "tb_trusted_acidentes": 4, "tb_refined_stage": 5, "tb_refined_book": 2,
    }
    audit = spark.read.parquet(*(lake.control(c) for c in ("raw", "trusted", "refined")))
    assert {r.tb_name: r.qtd_registros for r in audit.collect()} == report.rows

    stage = stage_rows(spark, lake).collect()
    # accidents 5 and 7 both meet the flow of km 527.2; the anchor of the day is on 5
    tenth = {(r.km_fluxo, r.id_acidente): r.fvl_acidentes_dia
             for r in stage if r.data_fluxo == date(2024, 9, 10)}
    assert tenth == {(Decimal("527.200"), 5): 2, (Decimal("527.200"), 7): None,
                     (Decimal("529.100"), None): None}
    others = {r.data_fluxo: r.fvl_acidentes_dia for r in stage if r.data_fluxo != date(2024, 9, 10)}
    assert others == {date(2024, 9, 11): 0, date(2023, 10, 15): 0}

    book = {r.km_fluxo: r for r in read_book(spark, lake).collect()}
    at_527 = book[Decimal("527.200")]
    # low volume: rows 50 (twice, fan-out) and 108; day counts 2 and 0
    assert (at_527.VAR_0, at_527.VAR_1, at_527.VAR_2, at_527.VAR_3) == (2, 1.0, 0, 2)
    assert at_527.VAR_4 == 2  # last month only
    # slow vehicles, volume: 50 + 50 + 108
    assert (at_527.VAR_72, at_527.VAR_73, at_527.VAR_74, at_527.VAR_75) == (208, 208 / 3, 50, 108)
    assert book[Decimal("529.100")].VAR_360 == 300
    assert at_527.VAR_360 is None


def test_steps_one_by_one_from_the_command_line(spark, tmp_path, flow_records, accident_records):
    lake = lake_at(tmp_path, flow_records, accident_records)
    common = ["--root", lake.root, "--dt-proc", "20240930120000", "--as-of", "2024-09-05"]
    sources = ["--flow", lake.flow_source, "--accidents", lake.accidents_source]
    assert main(["ingest", *common, *sources]) == {"tb_raw_fluxo": 5, "tb_raw_acidentes": 4}
    assert main(["conform", *common]) == {"tb_trusted_fluxo": 5, "tb_trusted_acidentes": 4}
    assert main(["refine", *common]) == {"tb_refined_stage": 5, "tb_refined_book": 2}
    with pytest.raises(SystemExit):
        main(["ingest", *common])


def test_rerun_replaces_and_append_doubles(spark, tmp_path, flow_records, accident_records):
    lake = lake_at(tmp_path, flow_records, accident_records)
    as_of = date(2024, 9, 5)
    run_month(spark, lake, as_of, "20240930120000")
    again = run_month(spark, lake, as_of, "20240930130000", conform="all")
    # nothing new to ingest; trusted received all raw rows a second time
    assert again.rows["tb_raw_fluxo"] == 0 and again.rows["tb_trusted_fluxo"] == 5
    assert (stage_rows(spark, lake).count(), read_book(spark, lake).count()) == (5, 2)
    added = run_month(spark, lake, as_of, "20240930140000", mode="append")
    assert added.rows["tb_refined_stage"] == 5
    assert (stage_rows(spark, lake).count(), read_book(spark, lake).count()) == (10, 4)


def test_new_loads_only(spark, tmp_path, flow_records, accident_records):
    lake = lake_at(tmp_path, flow_records, accident_records)
    run_month(spark, lake, date(2024, 9, 5), "20240930120000")
    later = flow_records + [flow_record("02/10/2024", 529.1, 10)]
    lake = lake_at(tmp_path, later, accident_records)
    report = run_month(spark, lake, date(2024, 10, 5), "20241031120000")
    assert report.rows["tb_trusted_fluxo"] == 1 and report.rows["tb_refined_stage"] == 6


def test_conforming_twice_changes_nothing(spark, tmp_path, flow_records, accident_records):
    lake = lake_at(tmp_path, flow_records, accident_records)
    stamp = "20240930120000"
    run = run_month(spark, lake, date(2024, 9, 5), stamp).run
    before = sorted(map(str, stage_rows(spark, lake).collect()))
    assert conform_month(spark, lake, stamp)["tb_trusted_fluxo"] == 5
    refine_month(spark, lake, run, stamp)
    assert sorted(map(str, stage_rows(spark, lake).collect())) == before


def test_load_of_a_run_that_died_is_conformed_later(spark, tmp_path, flow_records, accident_records):
    lake = lake_at(tmp_path, flow_records, accident_records)
    ingest_month(spark, lake, "20240930120000")  # and then the run died
    report = run_month(spark, lake, date(2024, 9, 5), "20240930130000")
    assert report.rows["tb_raw_fluxo"] == 0 and report.rows["tb_trusted_fluxo"] == 5
    assert run_month(spark, lake, date(2024, 9, 5), "20240930140000").rows["tb_trusted_fluxo"] == 0
    assert stage_rows(spark, lake).count() == 5


def test_a_month_without_any_data(spark, tmp_path, flow_records, accident_records):
    lake = lake_at(tmp_path, flow_records, accident_records)
    report = run_month(spark, lake, date(2030, 1, 1), "20300131120000")
    assert report.rows["tb_refined_stage"] == 0 and report.rows["tb_refined_book"] == 0


def test_day_counts_add_up(spark, sf_dir):
    """The sum over rows of the day measure is the sum of distinct accidents per day."""
    from lakebook.checks.features import stage

    rows = stage(spark, sf_dir)
    per_day = rows.groupBy("data_fluxo").agg(F.countDistinct("id_acidente").alias("n"))
    assert rows.agg(F.sum("fvl_acidentes_dia")).first()[0] == per_day.agg(F.sum("n")).first()[0]
