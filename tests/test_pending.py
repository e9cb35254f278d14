"""The stream of pending ids: what it requests, and that its state shrinks."""

from pyspark.sql import functions as F

from response_ledger.sources.ledger import append_ledger
from response_ledger.streaming.pending import read_requested, stream_pending
from response_ledger.table_ledgers import failed_rows, ledger_rows
from tests.test_ledgers import body
from tests.test_ledgers import pages as page_rows


class Ledgers:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root

    def name(self, *ids):
        append_ledger(page_rows(self.spark, body([{"PRODUCTID": str(one)} for one in ids])), f"{self.root}/pages")

    def land(self, *ids, kind="PRODUCT"):
        rows = self.spark.createDataFrame([(one,) for one in ids], "id long").withColumn("content", F.lit("{}"))
        append_ledger(
            ledger_rows(rows, request_type=F.lit(kind), path_id=F.col("id"), content=F.col("content")),
            f"{self.root}/target",
        )

    def fail(self, *ids):
        rows = self.spark.createDataFrame([(one,) for one in ids], "id long")
        failed_rows(rows, "PRODUCT").write.mode("append").parquet(f"{self.root}/failures")

    def run(self):
        """The requests so far as (id, tries), and how many ids wait."""
        query = stream_pending(
            self.spark, f"{self.root}/pages", f"{self.root}/target", f"{self.root}/failures", "PRODUCT",
            f"{self.root}/requests", f"{self.root}/state",
        )
        query.awaitTermination()
        waiting = [one["stateOperators"][0]["numRowsTotal"] for one in query.recentProgress if one["stateOperators"]]
        found = read_requested(self.spark, f"{self.root}/requests").collect()
        return sorted((one["id"], one["tries"]) for one in found), waiting[-1] if waiting else None


def test_landed_ids_leave_and_failed_ones_return(spark, tmp_path):
    ledgers = Ledgers(spark, tmp_path)
    assert ledgers.run()[0] == []
    ledgers.name(1, 2, 2, 3, 4)
    assert ledgers.run() == ([(1, 1), (2, 1), (3, 1), (4, 1)], 4)
    ledgers.land(1, 2, 9)
    ledgers.land(3, kind="EVENT")
    ledgers.fail(3, 8)
    assert ledgers.run() == ([(1, 1), (2, 1), (3, 1), (3, 2), (4, 1)], 2)
    # A response counts before a failure that lands with it; pages change nothing for an id that waits.
    ledgers.fail(3, 4)
    ledgers.land(4)
    ledgers.name(3, 5)
    found = [(1, 1), (2, 1), (3, 1), (3, 2), (3, 3), (4, 1), (5, 1)]
    assert ledgers.run() == (found, 2)


def test_ids_named_again_after_they_landed_do_not_stay(spark, tmp_path):
    ledgers = Ledgers(spark, tmp_path)
    ledgers.name(1, 2)
    ledgers.run()
    ledgers.land(1)
    assert ledgers.run()[1] == 1
    ledgers.name(1, 2)
    assert ledgers.run() == ([(1, 1), (2, 1)], 2)
    assert ledgers.run() == ([(1, 1), (2, 1)], 1)


def test_a_replayed_micro_batch_requests_nothing_twice(spark, tmp_path):
    ledgers = Ledgers(spark, tmp_path)
    ledgers.name(1, 2)
    ledgers.run()
    ledgers.fail(2)
    found = ledgers.run()[0]
    assert found == [(1, 1), (2, 1), (2, 2)]
    commits = sorted((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda one: int(one.name))
    for one in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        one.unlink(missing_ok=True)
    assert ledgers.run()[0] == found


def test_many_ids_share_a_state_row_and_none_is_lost(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("response_ledger.streaming.pending.GROUPS", 3)
    ledgers, ids = Ledgers(spark, tmp_path), list(range(-50, 50))
    ledgers.name(*ids)
    found, rows = ledgers.run()
    assert found == [(one, 1) for one in ids] and rows == 3
    ledgers.land(*ids[:40])
    ledgers.fail(*ids[30:60])
    ledgers.name(*ids, 1000)
    again = [(one, 2) for one in ids[40:60]]
    assert ledgers.run()[0] == sorted([*found, *again, (1000, 1)])
    ledgers.land(*ids[40:], 1000)
    assert ledgers.run() == (sorted([*found, *again, (1000, 1)]), 0)
