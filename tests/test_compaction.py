"""Rows of a compacted ledger stay the same, also when a run is killed between its steps."""

import pytest
from pyspark.sql import functions as F

from response_ledger.session import scratch_path
from response_ledger.sources import compaction
from response_ledger.sources.compaction import compact, live_files, read_compacted, vacuum
from response_ledger.sources.ledger import append_ledger, read_ledger
from response_ledger.table_ledgers import ledger_rows


class Killed(Exception):
    pass


def append(spark, path, first, rows=120, files=12, paged=False):
    frame = spark.range(first, first + rows).withColumn("content", F.concat(F.lit("body "), F.col("id"))).repartition(files)
    columns = {"start": F.col("id")} if paged else {"path_id": F.col("id")}
    kind = F.lit("RECALLS" if paged else "EVENT")
    append_ledger(ledger_rows(frame, request_type=kind, content=F.col("content"), **columns), f"{path}/run_id=a b")


def held(frame):
    return sorted(map(repr, frame.select("request_type", "path_id", "start", "content", "filters").collect()))


@pytest.fixture
def ledger(spark):
    path = scratch_path(spark, "compacted")
    append(spark, path, 0)
    append(spark, path, 60)
    append(spark, path, 0, rows=30, paged=True)
    return path


def kill(monkeypatch, name, after=0):
    real, calls = getattr(compaction, name), []

    def killed(*args):
        calls.append(args)
        if len(calls) > after:
            raise Killed
        return real(*args)

    monkeypatch.setattr(compaction, name, killed)


def test_rows_stay_and_files_are_few(spark, ledger):
    rows = held(read_ledger(spark, ledger))
    assert held(read_compacted(spark, ledger)) == rows
    assert compact(spark, ledger) == 36
    assert live_files(spark, ledger).count() == 2 and held(read_compacted(spark, ledger)) == rows
    # Old files are there for readers that began before.
    assert held(read_ledger(spark, ledger)) == rows
    assert compact(spark, ledger) == 0
    assert vacuum(spark, ledger) == 36 and vacuum(spark, ledger) == 0
    assert held(read_compacted(spark, ledger)) == rows
    # New runs are read along, and merged with what was compacted before.
    append(spark, ledger, 500)
    more = held(read_compacted(spark, ledger))
    assert len(more) == len(rows) + 120 and compact(spark, ledger) == 14
    assert live_files(spark, ledger).count() == 2 and vacuum(spark, ledger) == 14
    assert held(read_compacted(spark, ledger)) == more


def test_large_files_stay(spark, ledger):
    files = {one["file"]: one["length"] for one in live_files(spark, ledger).collect()}
    assert compact(spark, ledger, target_bytes=2 * min(files.values())) == 0
    assert compact(spark, ledger, target_bytes=8 * max(files.values())) == 36
    assert live_files(spark, ledger).count() <= 2 * (-(-sum(files.values()) // (8 * max(files.values()))))


@pytest.mark.parametrize(("step", "after"), [("append_ledger", 0), ("append_ledger", 1), ("_record", 0)])
def test_killed_before_the_manifest(spark, ledger, monkeypatch, step, after):
    rows = held(read_ledger(spark, ledger))
    with monkeypatch.context() as patch:
        kill(patch, step, after)
        with pytest.raises(Killed):
            compact(spark, ledger)
    assert held(read_compacted(spark, ledger)) == rows and vacuum(spark, ledger) == 0
    assert compact(spark, ledger) == 36 and held(read_compacted(spark, ledger)) == rows


def test_killed_while_files_are_removed(spark, ledger, monkeypatch):
    rows = held(read_ledger(spark, ledger))
    compact(spark, ledger)
    with monkeypatch.context() as patch:
        kill(patch, "_removed", 5)
        with pytest.raises(Killed):
            vacuum(spark, ledger)
    assert held(read_compacted(spark, ledger)) == rows
    assert vacuum(spark, ledger) == 31 and held(read_compacted(spark, ledger)) == rows


def test_a_ledger_without_files(spark):
    path = scratch_path(spark, "none")
    append(spark, path, 0, rows=0, files=1)
    assert compact(spark, path) == 0 and read_compacted(spark, path).count() == 0


def test_a_task_sorts_bounded_bytes(spark, ledger, monkeypatch):
    """Bodies that compress well fit one file of the target's size, but not one task's memory."""
    rows = held(read_ledger(spark, ledger))
    monkeypatch.setattr(compaction, "SORTED_BYTES", 50 * compaction.ROW_BYTES)
    assert compact(spark, ledger) == 36 and held(read_compacted(spark, ledger)) == rows
    counts = [one["count"] for one in read_compacted(spark, ledger).groupBy("_metadata.file_path").count().collect()]
    assert len(counts) > 4 and max(counts) < 120
    # What was dealt into more files for that is not merged again.
    assert vacuum(spark, ledger) == 36 and compact(spark, ledger) == 0
