"""What each micro-batch did, counted while it runs: ticks put out, ticks too late, and rejects by reason.

The counts are observed metrics: Spark gathers them in the tasks that produce the rows and reports them with the
progress of the batch, so no row is read again for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickloom.operators.quality import REASONS

#: What comes out of a micro-batch: ticks with statistics, ticks that came too late, messages set aside.
EMIT, TOO_LATE, REJECT = "emit", "too_late", "reject"
NAME = "quality"


def observed(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``role`` and ``reject_reason``), counted as they pass."""
    counts = [F.count_if(F.col("role") == role).alias(role) for role in (EMIT, TOO_LATE)]
    counts += [F.count_if(F.col("reject_reason") == reason).alias(reason) for reason in REASONS]
    return rows.observe(NAME, *counts)


def batch_counts(progress) -> dict[str, int] | None:
    """Counts of the batch that a progress report is about, with its number as ``batch``; None if it has none."""
    found = progress["observedMetrics"].get(NAME)
    if found is None:
        return None
    counts = found if isinstance(found, dict) else found.asDict()
    return {"batch": progress["batchId"], **{name: int(n or 0) for name, n in counts.items()}}


def counts_of(query: StreamingQuery) -> list[dict[str, int]]:
    """Counts of the query's latest batches, as many as Spark keeps reports of, each batch once."""
    found = [c for c in map(batch_counts, query.recentProgress) if c is not None]
    return [c for c in {c["batch"]: c for c in found}.values()]


class QualityListener(StreamingQueryListener):
    """Hands the counts of every batch to ``report``; add it with ``spark.streams.addListener``."""

    def __init__(self, report: Callable[[dict[str, int]], None]) -> None:
        self.report = report

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        counts = batch_counts({"observedMetrics": progress.observedMetrics, "batchId": progress.batchId})
        if counts is not None:
            self.report(counts)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
