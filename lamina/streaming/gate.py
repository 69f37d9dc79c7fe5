"""Arrival gate: runs are released when all they wait for has arrived, and given up when their time is over.

Each run is a key with state of its own: the names still awaited, their number, and a timer at the time it is due. Nothing is polled; a
run is looked at when something of it arrives, or when the watermark passes its time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

COMPLETE = "complete"
EXPIRED = "expired"

# State that is kept outside the heap, by key.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

VERDICT = "run_id string, status string, n_expected long, n_missing long"


def run_gate(arrivals: DataFrame, expected: DataFrame) -> DataFrame:
    """One row per run of ``expected``, once it is decided: ``run_id, status, n_expected, n_missing``.

    ``expected`` is a table of ``run_id, name, due``, repeated rows once, the latest time of a run being its own; ``arrivals`` a stream of ``run_id, name, at`` with a
    watermark on ``at``. A run is complete as soon as each of its names has arrived, by ``at`` no later than it is due, whatever batch
    brings it. It is expired when the watermark has passed its time without that. What is not expected, comes
    again or comes late changes nothing, and rows without a run, name or time are passed over.

    The query has to be started with ``STATE_STORE`` as its state store provider. Rows of one run are taken by one task, one by
    one; the state of a run is one entry per awaited name.
    """
    from pyspark.sql import Row
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    complete, expired = COMPLETE, EXPIRED

    class Gate(StatefulProcessor):
        """Defined here, so that it travels with the query and executors need no copy of this package."""

        def init(self, handle):
            self.handle = handle
            self.awaited = handle.getMapState("awaited", "name string", "n int")
            self.run = handle.getValueState("run", "due long, expected long, missing long")

        def handleInitialState(self, key, initialState, timerValues):
            due = int(initialState["due"])
            expected = self.run.get()[1] if self.run.exists() else 0
            if not expected:
                # The watermark has to pass the time, not only to reach it.
                self.handle.registerTimer(due + 1)
            self.awaited.updateValue((initialState["name"],), (1,))
            self.run.update((due, expected + 1, expected + 1))

        def handleInputRows(self, key, rows, timerValues):
            if not self.run.exists():
                return
            due, many, missing = self.run.get()
            before = missing
            for row in rows:
                if row["at"] <= due and self.awaited.containsKey((row["name"],)):
                    self.awaited.removeKey((row["name"],))
                    missing -= 1
            if not missing:
                self.run.clear()
                self.handle.deleteTimer(due + 1)
                yield Row(run_id=key[0], status=complete, n_expected=many, n_missing=0)
            elif missing < before:
                self.run.update((due, many, missing))

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            if self.run.exists():
                _, many, missing = self.run.get()
                self.run.clear()
                self.awaited.clear()
                yield Row(run_id=key[0], status=expired, n_expected=many, n_missing=missing)

        def close(self):
            pass

    # As a number the time drives the watermark, but no row is taken for late before the run has seen it.
    millis = F.unix_millis(F.col("at").cast("timestamp"))
    known = arrivals.filter(F.col("run_id").isNotNull() & F.col("name").isNotNull() & F.col("at").isNotNull())
    rows = known.select(F.col("run_id").cast("string").alias("run_id"), F.col("name").cast("string").alias("name"), millis.alias("at"))
    once = expected.select(
        F.col("run_id").cast("string").alias("run_id"), F.col("name").cast("string").alias("name"), F.unix_millis(F.col("due").cast("timestamp")).alias("due")
    ).dropna()
    due = once.groupBy("run_id").agg(F.max("due").alias("due"))
    first = once.select("run_id", "name").distinct().join(due, "run_id")
    return rows.groupBy("run_id").transformWithState(Gate(), VERDICT, "Append", "EventTime", first.groupBy("run_id"))
