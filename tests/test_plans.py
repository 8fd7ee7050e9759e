"""Physical plans: what is pushed down, what is shuffled, and that no Python runs."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from lakebook.checks import CHECKS
from lakebook.checks import bindings as B
from lakebook.checks.lake import MONTHLY, accidents_by_month
from lakebook.config import ProductConfig
from lakebook.operators import attach_events, feature_book, latest_version, with_lookback
from lakebook.operators.book import partial_sums
from lakebook.plans import BOOK_SPEC
from lakebook.plans.stage import JOIN_KEYS, loaded_version, placed_accidents
from lakebook.scratch import materialize
from lakebook.sources import read_refs


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_month_range_prunes_folders(spark, sf_dir):
    path, _ = accidents_by_month(spark, sf_dir)
    text = plan(read_refs(spark, path, MONTHLY, 200006, 200106))
    filters = text.split("PartitionFilters: ")[1].split("]")[0]
    assert "ref" in filters and "200006" in filters and "200106" in filters


def test_dedup_has_one_plan_without_hints(spark, sf_dir):
    flow = B.flow(spark, sf_dir)
    text = plan(latest_version(flow, "id_fluxo", loaded_version()))
    assert text.count("Join") >= 1 and "Window" not in text and "ResolvedHint" not in text


def test_crowded_dedup_key_is_split(spark, sf_dir):
    """A third of the rows on one key, written first so that sizes are known."""
    tight = spark.newSession()
    for name, value in TIGHT.items():
        tight.conf.set(name, value)
    crowded = F.when(F.col("volume_total_fluxo") % 3 == 0, F.lit(-1)).otherwise(F.col("id_fluxo"))
    flow = B.flow(tight, sf_dir).repartition(8).withColumn("id_fluxo", crowded.cast("int"))
    one_version = (F.col("volume_total_fluxo") % 1).cast("string")
    latest = latest_version(materialize(flow, "crowded"), "id_fluxo", one_version)
    assert "skew=true" in executed_plan(tight, latest)


TIGHT = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


def executed_plan(spark, df) -> str:
    """Final plan of ``df`` after AQE, from the listing of the last executed query."""
    df.write.format("noop").mode("overwrite").save()
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    return runs.apply(runs.size() - 1).physicalPlanDescription()


def test_crowded_join_key_is_split(spark, sf_dir):
    """A third of the flow on one sensor, day and direction, accidents too big to broadcast."""
    tight = spark.newSession()
    for name, value in TIGHT.items():
        tight.conf.set(name, value)
    crowd = F.col("id_fluxo") % 3 == 0
    flow = B.flow(tight, sf_dir).repartition(8).withColumns(
        {
            "data_fluxo": F.when(crowd, F.lit("2001-05-01").cast("date"))
            .otherwise(F.col("data_fluxo")),
            "km_fluxo": F.when(crowd, F.lit("531.800").cast("decimal(14,3)"))
            .otherwise(F.col("km_fluxo")),
            "sentido_fluxo": F.when(crowd, "Crescente").otherwise(F.col("sentido_fluxo")),
        }
    )
    events = materialize(placed_accidents(B.accidents(tight, sf_dir), ProductConfig()), "events")
    joined = attach_events(materialize(flow, "crowded"), events, JOIN_KEYS)
    assert "SortMergeJoin(skew=true) LeftOuter" in executed_plan(tight, joined)


def test_small_events_leave_the_flow_in_place(spark, sf_dir):
    flow = B.flow(spark, sf_dir)
    events = materialize(placed_accidents(B.accidents(spark, sf_dir), ProductConfig()), "events")
    text = plan(attach_events(flow, events, JOIN_KEYS))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_book_reads_rows_in_one_hash_aggregate(spark, sf_dir):
    from lakebook.checks.features import stage

    flagged = with_lookback(stage(spark, sf_dir), "data_fluxo", B.RUN.ref_date, (1, 3, 6, 9, 12))
    assert "SortAggregate" not in plan(partial_sums(flagged, BOOK_SPEC))
    assert "NestedLoop" not in plan(feature_book(flagged, BOOK_SPEC))


# Their last step only reads what a monthly run wrote.
WHOLE_RUNS = {"control_rows", "run_month_stage"}


@pytest.mark.parametrize("name", sorted(set(CHECKS) - WHOLE_RUNS))
def test_no_python_and_no_cross_join(name, spark):
    text = plan(CHECKS[name].run(spark, "/root/testdata/sf0.001"))
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert word not in text
