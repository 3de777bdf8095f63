"""Exact totals of streaming queries, summed as their progress is reported."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

METRIC = "tidegate_progress"


def observed(stream: DataFrame, n_bytes: str = "n_bytes") -> DataFrame:
    """``stream`` that reports rows and bytes of every micro-batch while it runs, without a pass of its own."""
    return stream.observe(
        METRIC, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(n_bytes), F.lit(0)).alias("bytes")
    )


class Totals(StreamingQueryListener):
    """Micro-batches, late rows and observed sums of each run.

    A query keeps its last hundred progress reports only; a listener sees every one of them.
    """

    def __init__(self):
        self.changed = threading.Condition()
        self.runs: dict[str, dict] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self.changed:
            run = self.runs.setdefault(str(progress.runId), {"batches": 0, "late_rows": 0})
            run["batches"] += 1
            run["late_rows"] += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
            row = progress.observedMetrics.get(METRIC)
            for name, value in (row.asDict() if row else {}).items():
                run[name] = run.get(name, 0) + (value or 0)

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def of(self, run_id: str, seconds: float = 60) -> dict:
        """Totals of a run that has ended; its end is reported after all its progress."""
        with self.changed:
            if not self.changed.wait_for(lambda: str(run_id) in self.ended, seconds):
                raise TimeoutError("the end of the query was not reported")
            return dict(self.runs.get(str(run_id), {"batches": 0, "late_rows": 0}))
