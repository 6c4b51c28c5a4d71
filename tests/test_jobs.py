"""Batch chain (W1) and the streaming refresh."""

import os
import uuid

import pytest

from fixtures import EMPLOYEES_CSV, EMPLOYEES_STATS
from statlens.plans.snapshot_job import SnapshotDataError, TablePaths, run_snapshot_job
from statlens.sources.tables import EmptySnapshotError
from statlens.streaming.refresh import start_refresh


def _stats(spark, root):
    return {r["department"]: (r["total_salary"], r["staff_count"], r["average_salary"])
            for r in spark.read.parquet(TablePaths(root).stats).collect()}


def test_batch_chain(spark, tmp_path):
    csv = tmp_path / "snap.csv"
    csv.write_text(EMPLOYEES_CSV)
    root = str(tmp_path / "tables")
    run_snapshot_job(spark, str(csv), root, run_id="r1")
    paths = TablePaths(root)
    assert spark.read.parquet(paths.employees).count() == 25
    assert _stats(spark, root) == EMPLOYEES_STATS
    report = spark.read.option("header", True).csv(paths.report)
    assert report.columns == ["department", "total_salary", "staff_count", "average_salary"]
    assert report.count() == 5
    metrics = spark.read.parquet(paths.metrics)
    assert metrics.where("run_id = 'r1'").count() == 10
    # Re-running the same run replaces its metrics instead of duplicating them.
    run_snapshot_job(spark, str(csv), root, run_id="r1")
    assert spark.read.parquet(paths.metrics).where("run_id = 'r1'").count() == 10


def test_empty_and_bad_snapshots_leave_tables(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text(EMPLOYEES_CSV)
    root = str(tmp_path / "tables")
    run_snapshot_job(spark, str(good), root, run_id="r1")
    empty = tmp_path / "empty.csv"
    empty.write_text("id,name,salary,department\n")
    with pytest.raises(EmptySnapshotError):
        run_snapshot_job(spark, str(empty), root, run_id="r2")
    assert _stats(spark, root) == EMPLOYEES_STATS
    bad = tmp_path / "bad.csv"
    bad.write_text("id,name,salary,department\n1,a,abc,x\n")
    with pytest.raises(SnapshotDataError):
        run_snapshot_job(spark, str(bad), root, run_id="r3")
    assert _stats(spark, root) == EMPLOYEES_STATS
    assert spark.read.parquet(TablePaths(root).employees).count() == 25


def test_streaming_refresh(spark, tmp_path):
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    lines = EMPLOYEES_CSV.strip().split("\n")
    header, body = lines[0], lines[1:]
    snaps = [body[:10], body[:3], body]     # three snapshots; the last is the full file
    for i, b in enumerate(snaps):
        p = incoming / f"snap_{i}.csv"
        p.write_text("\n".join([header, *b]) + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    (incoming / "snap_3_empty.csv").write_text(header + "\n")
    os.utime(incoming / "snap_3_empty.csv", (1_700_000_010, 1_700_000_010))
    root = str(tmp_path / "tables")
    # The checkpoint goes under the session's spark.checkpoint.dir; a fresh
    # query name per run keeps runs apart.
    name = f"refresh_test_{uuid.uuid4().hex[:12]}"
    q = start_refresh(spark, str(incoming), root, name=name, available_now=True, backfill=True)
    q.awaitTermination(300)
    assert q.exception() is None
    # The empty snapshot was skipped: tables hold the last non-empty one.
    assert _stats(spark, root) == EMPLOYEES_STATS
    metrics = spark.read.parquet(TablePaths(root).metrics)
    per_run = {r["run_id"]: r["n"] for r in metrics.groupBy("run_id").count().withColumnRenamed("count", "n").collect()}
    # Each batch published the statistics of its own snapshot only.
    # rows 1-10 cover all five departments, rows 1-3 three of them.
    assert sorted(per_run.values()) == sorted([2 * 5, 2 * 3, 2 * 5])


def test_streaming_refresh_latest_only(spark, tmp_path):
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    lines = EMPLOYEES_CSV.strip().split("\n")
    header, body = lines[0], lines[1:]
    for i, b in enumerate([body, body[:3], body[:10]]):   # the newest file is rows 1-10
        p = incoming / f"snap_{i}.csv"
        p.write_text("\n".join([header, *b]) + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    root = str(tmp_path / "tables")
    q = start_refresh(spark, str(incoming), root, name=f"refresh_latest_{uuid.uuid4().hex[:12]}",
                      available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    # No backfill: one batch, holding only the newest snapshot.
    assert spark.read.parquet(TablePaths(root).employees).count() == 10
    metrics = spark.read.parquet(TablePaths(root).metrics)
    assert metrics.select("run_id").distinct().count() == 1


def test_streaming_refresh_rejects_bad_snapshot(spark, tmp_path):
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    good = incoming / "snap_0.csv"
    good.write_text(EMPLOYEES_CSV)
    os.utime(good, (1_700_000_000, 1_700_000_000))
    bad = incoming / "snap_1.csv"
    bad.write_text("id,name,salary,department\n1,a,abc,x\n")
    os.utime(bad, (1_700_000_001, 1_700_000_001))
    root = str(tmp_path / "tables")
    q = start_refresh(spark, str(incoming), root, name=f"refresh_bad_{uuid.uuid4().hex[:12]}",
                      available_now=True, backfill=True)
    q.awaitTermination(300)
    assert q.exception() is None                    # the stream survives the bad snapshot
    assert _stats(spark, root) == EMPLOYEES_STATS   # tables keep the good snapshot
    rejected = spark.read.parquet(TablePaths(root).rejected).collect()
    assert len(rejected) == 1 and "'abc'" in rejected[0]["reason"]


def test_command_line_snapshot_job(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    repo = Path(__file__).resolve().parent.parent
    csv = tmp_path / "snap.csv"
    csv.write_text(EMPLOYEES_CSV)
    root = tmp_path / "tables"
    res = subprocess.run([sys.executable, "-m", "statlens.plans.snapshot_job", str(csv), str(root), "--run-id", "cli"],
                         cwd=repo, capture_output=True, text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    assert (root / "department_stats").exists() and (root / "run_metrics" / "run_id=cli").exists()
