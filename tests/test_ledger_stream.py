"""The stream over the ledger's events, through restarts."""

from datetime import datetime

import pytest

from conftest import rows
from occrisk.plans.loads import FAILED, LEDGER_SCHEMA, RUNNING, SUCCESS
from occrisk.streaming.ledger import STUCK, known_outcomes, watch_ledger


def clock(hour, minute=0):
    return datetime(2024, 1, 1, hour, minute)


@pytest.fixture()
def ledger(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    spark.createDataFrame([], LEDGER_SCHEMA).write.parquet(folder)

    def add(*events):
        data = [(i, "t", None, f"file-{i}", "c", start, end, status, None, None) for i, status, start, end in events]
        spark.createDataFrame(data, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    def run():
        """A stream that starts anew from its checkpoint; what is known after it."""
        watch_ledger(spark, folder, str(tmp_path / "out"), str(tmp_path / "checkpoint"), 3600)
        return rows(known_outcomes(spark, str(tmp_path / "out")).select("id", "file_name", "status", "started_at", "finished_at"))

    return add, run


def test_outcomes_through_restarts(ledger):
    add, run = ledger
    add(("a", RUNNING, clock(0), None), ("b", RUNNING, clock(0, 5), None))
    assert run() == []
    add(("a", SUCCESS, clock(0), clock(0, 30)))
    done = ("a", "file-a", SUCCESS, clock(0), clock(0, 30))
    assert run() == [done]
    # another load of the same file, started and ended between two runs
    add(("c", RUNNING, clock(0, 40), None), ("c", FAILED, clock(0, 40), clock(0, 50)))
    failed = ("c", "file-c", FAILED, clock(0, 40), clock(0, 50))
    assert run() == [done, failed]
    assert run() == [done, failed]
    # an hour after its start, by the ledger's own time, b is stuck
    add(("d", RUNNING, clock(2), None))
    run()
    stuck = ("b", "file-b", STUCK, clock(0, 5), None)
    assert run() == [done, stuck, failed]
    # and may end after all
    add(("b", SUCCESS, clock(0, 5), clock(2, 10)))
    assert run() == sorted([done, stuck, failed, ("b", "file-b", SUCCESS, clock(0, 5), clock(2, 10))], key=str)
