"""The folder of intermediate tables where executors may run on other machines."""

import pytest

from lakebook import scratch


@pytest.fixture()
def cluster(spark, monkeypatch):
    """The session, as one whose master is not local; no folder was tried yet."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(scratch, "_tried", set(), raising=False)
    return spark


def test_a_mounted_folder_that_all_share_is_taken(cluster):
    assert scratch.located(cluster, scratch.scratch_root(cluster))[0].getScheme() == "file"
    kept = scratch.materialize(cluster.createDataFrame([(1,), (None,), (1,)], "k int"), "kept")
    assert sorted(str(r.k) for r in kept.collect()) == ["1", "1", "None"]


def _unseen(tmp_path):
    """``located`` of a driver that has an empty folder where tasks wrote into theirs."""
    located = scratch.located
    return lambda spark, path: located(spark, str(tmp_path) if "/tried-" in path else path)


def test_a_folder_of_one_machine_is_refused(cluster, monkeypatch, tmp_path):
    monkeypatch.setattr(scratch, "located", _unseen(tmp_path))
    with pytest.raises(ValueError, match="all executors share"):
        scratch.new_folder(cluster, "kept")


def test_a_folder_is_tried_once(cluster, monkeypatch, tmp_path):
    scratch.scratch_root(cluster)
    monkeypatch.setattr(scratch, "located", _unseen(tmp_path))
    assert scratch.new_folder(cluster, "kept")


def test_a_folder_is_tried_through_a_file_system_without_a_scheme_of_its_own(cluster, monkeypatch):
    conf, jvm = cluster._jsc.hadoopConfiguration(), cluster._jvm
    files = jvm.org.apache.hadoop.fs.RawLocalFileSystem()
    files.initialize(jvm.java.net.URI.create("file:///"), conf)
    monkeypatch.setattr(scratch, "located", lambda spark, path: (files, jvm.org.apache.hadoop.fs.Path(path)))
    root = scratch.scratch_root(cluster)
    assert scratch._tried == {(cluster.sparkContext.applicationId, root)}
    kept = scratch.materialize(cluster.createDataFrame([(2,), (None,), (2,)], "k int"), "kept")
    assert sorted(str(r.k) for r in kept.collect()) == ["2", "2", "None"]
