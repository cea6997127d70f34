"""Exact row counts of what a job writes, taken while it runs."""

from __future__ import annotations

import threading
from collections import Counter, defaultdict

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class RowCounts:
    """Counts rows of registered DataFrames during the next action on each of them."""

    def __init__(self) -> None:
        self._observed: dict[str, Observation] = {}

    def register(self, df: DataFrame, name: str = "rows") -> DataFrame:
        """Use the returned DataFrame from here on."""
        if name in self._observed:
            raise ValueError(f"{name!r} is registered already")
        self._observed[name] = Observation(name)
        return df.observe(self._observed[name], F.count(F.lit(1)).alias("rows"))

    def value(self, name: str = "rows") -> int:
        """Rows seen; waits for the action to finish."""
        return int(self._observed[name].get["rows"])

    def counts(self) -> dict[str, int]:
        return {name: self.value(name) for name in self._observed}


class StreamRowCounts(StreamingQueryListener):
    """Counts the rows of streams, micro-batch by micro-batch, while it is entered as a context.

    Spark reports a micro-batch when it is committed, so one that is tried again counts once.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._seen: dict[str, dict[int, Counter]] = defaultdict(dict)
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def __enter__(self) -> StreamRowCounts:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *error: object) -> None:
        self._spark.streams.removeListener(self)

    def register(self, df: DataFrame, name: str = "rows") -> DataFrame:
        """Use the returned DataFrame from here on."""
        return df.observe(name, F.count(F.lit(1)).alias("rows"))

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        rows = Counter({name: int(row["rows"]) for name, row in (progress.observedMetrics or {}).items() if "rows" in row.asDict()})
        if rows or progress.numInputRows:
            self._seen[str(progress.runId)][progress.batchId] = rows

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._ended[str(event.runId)].set()

    def totals(self, query: StreamingQuery, timeout: float = 30) -> dict[str, int]:
        """Rows per registered name. Of a query that has ended all micro-batches are in it."""
        if not query.isActive:
            # Reports come one after the other, the end last.
            self._ended[str(query.runId)].wait(timeout)
        total: Counter = Counter()
        for rows in self._seen[str(query.runId)].values():
            total.update(rows)
        return dict(total)

    def batches(self, query: StreamingQuery) -> int:
        """Micro-batches seen."""
        return len(self._seen[str(query.runId)])
