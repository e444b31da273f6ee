"""Counts of a running stream, taken from the batches themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

ROW = "stage string, batch_id long, at string, n long"


def watched(stream: DataFrame, stage: str, **metrics: Column) -> DataFrame:
    """``stream`` with ``metrics`` over the rows that pass here, gathered in the pass that handles each batch."""
    return stream.observe(stage, *[value.alias(name) for name, value in metrics.items()])


class StageProgress(StreamingQueryListener):
    """Keeps the metric ``n`` of every watched stage and batch; ``spark.streams.addListener`` turns it on.

    One row per stage and batch stays on the driver. A batch that had no rows for a stage counts 0.
    """

    def __init__(self, name: str = "n") -> None:
        self.name, self.rows = name, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for stage, metrics in progress.observedMetrics.items():
            self.rows.append((stage, int(progress.batchId), progress.timestamp, int(metrics[self.name] or 0)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def table(self, spark: SparkSession) -> DataFrame:
        """(stage, batch_id, at, n), from which :func:`broadsheet.operators.reports.stage_progress` makes running counts."""
        return spark.createDataFrame(list(self.rows), ROW)
