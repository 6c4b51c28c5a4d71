"""Compaction of the metric log: few files, every run once, also after a replay or a lost job."""

import pytest

from fixtures import EMPLOYEES_CSV
from statlens.plans import metric_log
from statlens.plans.metric_log import archive_path, compact_metrics, read_metrics
from statlens.plans.snapshot_job import TablePaths, run_snapshot_job


def _log(spark, root):
    return sorted((r.run_id, r.metric, r.value) for r in read_metrics(spark, root).collect())


def test_many_runs_become_few_files(spark, tmp_path):
    root, runs = str(tmp_path / "tables"), 1000
    paths = TablePaths(root)
    rows = spark.range(runs * 2).selectExpr("'n' AS run_name", "'s' AS source", "concat('m', id % 2) AS metric", "cast(id AS double) AS value",
                                            "format_string('r%04d', cast(id div 2 AS int)) AS run_id")
    rows.repartition(1).write.partitionBy("run_id").parquet(paths.metrics)
    want = _log(spark, root)
    assert len(want) == 2 * runs and compact_metrics(spark, root, file_rows=500) == runs
    assert _log(spark, root) == want
    assert not list((tmp_path / "tables" / "run_metrics").glob("run_id=*"))
    assert 2 <= len(list((tmp_path / "tables" / "run_metrics_archive").glob("*.parquet"))) <= 4
    assert compact_metrics(spark, root) == 0 and _log(spark, root) == want


def test_replay_and_new_runs_after_compaction(spark, tmp_path):
    csv, root = tmp_path / "snap.csv", str(tmp_path / "tables")
    csv.write_text(EMPLOYEES_CSV)
    for r in ("r1", "r2", "007"):
        run_snapshot_job(spark, str(csv), root, run_id=r)
    assert {r for r, _, _ in _log(spark, root)} == {"r1", "r2", "007"}
    want = _log(spark, root)
    assert compact_metrics(spark, root) == 3 and _log(spark, root) == want
    run_snapshot_job(spark, str(csv), root, run_id="r1")  # a replay adds nothing
    assert _log(spark, root) == want
    run_snapshot_job(spark, str(csv), root, run_id="r3")
    assert len(_log(spark, root)) == 40
    assert compact_metrics(spark, root) == 2 and len(_log(spark, root)) == 40 and compact_metrics(spark, root) == 0


def test_a_job_lost_after_the_archive_shows_each_run_once(spark, tmp_path, monkeypatch):
    csv, root = tmp_path / "snap.csv", str(tmp_path / "tables")
    csv.write_text(EMPLOYEES_CSV)
    run_snapshot_job(spark, str(csv), root, run_id="r1")
    want = _log(spark, root)

    def lost(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(metric_log, "delete", lost)
        with pytest.raises(KeyboardInterrupt):
            compact_metrics(spark, root)
    assert _log(spark, root) == want and spark.read.parquet(archive_path(TablePaths(root))).count() == 10
    assert compact_metrics(spark, root) == 1 and _log(spark, root) == want


def test_no_log(spark, tmp_path):
    assert compact_metrics(spark, str(tmp_path)) == 0
    with pytest.raises(FileNotFoundError):
        read_metrics(spark, str(tmp_path))
