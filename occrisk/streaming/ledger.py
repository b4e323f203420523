"""Outcome of every load, kept by a stream over the ledger's events.

The ledger only ever gains events.  The stream holds, per load, what has been seen of
it, through restarts; it tells a load's outcome once its final event has come, and
that a load is stuck when the ledger's time has passed its patience without one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from occrisk.plans.loads import LEDGER_SCHEMA, RUNNING
from occrisk.session import shipped

STUCK = "stuck"
OUTCOME = "id string, table_name string, file_name string, status string, started_at timestamp, finished_at timestamp"
_SEEN = "table_name string, file_name string, started bigint"


def _moment(millis: int) -> pd.Timestamp:
    return pd.Timestamp(millis, unit="ms")


def _millis(moment: pd.Timestamp) -> int:
    return int(moment.value // 1_000_000)


def _outcomes(patience: int):
    """One group of events, or one timer, of a load."""

    def row(key: tuple, table: str, file: str, status: str, started: int, finished: pd.Timestamp | None) -> pd.DataFrame:
        values = (key[0], table, file, status, _moment(started), finished)
        return pd.DataFrame([values], columns=[f.split()[0] for f in OUTCOME.split(", ")]).astype({"started_at": "datetime64[ns]", "finished_at": "datetime64[ns]"})

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            table, file, started = state.get
            state.remove()  # a final event may still come, and is told then
            yield row(key, table, file, STUCK, started, None)
            return
        events = pd.concat(list(frames)).sort_values(["at", "status"])
        started = _millis(events["started_at"].min())
        final = events[events["status"] != RUNNING]
        if len(final):
            if state.exists:
                started = min(started, state.get[2])
                state.remove()
            last = final.iloc[-1]
            yield row(key, last["table_name"], last["file_name"], last["status"], started, last["finished_at"])
            return
        first = events.iloc[0]
        if started + patience <= state.getCurrentWatermarkMs():
            yield row(key, first["table_name"], first["file_name"], STUCK, started, None)
            return
        state.update((first["table_name"], first["file_name"], started))
        state.setTimeoutTimestamp(started + patience)

    return step


def outcomes(events: DataFrame, patience_seconds: int) -> DataFrame:
    """Outcomes (``OUTCOME``) from a stream of ledger events."""
    at = F.coalesce("finished_at", "started_at")
    timed = events.select("id", "table_name", "file_name", "status", "started_at", "finished_at", at.alias("at"))
    return (
        timed.withWatermark("at", "0 seconds")
        .groupBy("id")
        .applyInPandasWithState(_outcomes(1000 * patience_seconds), OUTCOME, _SEEN, "append", GroupStateTimeout.EventTimeTimeout)
    )


def watch_ledger(spark: SparkSession, ledger: str, target: str, checkpoint: str, patience_seconds: int = 7200) -> None:
    """Append the outcomes that have become known since the last run to ``target`` and stop.

    The checkpoint remembers the events that were read and the loads that still
    run; a batch repeated after a failure replaces its own folder.
    """

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    shipped(spark)
    events = spark.readStream.schema(LEDGER_SCHEMA).parquet(ledger)
    query = outcomes(events, patience_seconds).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def known_outcomes(spark: SparkSession, target: str) -> DataFrame:
    """All outcomes told so far."""
    return spark.read.schema(f"{OUTCOME}, batch bigint").parquet(target).drop("batch")
