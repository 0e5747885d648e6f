"""Progress of running queries."""

from __future__ import annotations

from pyspark.sql.streaming.listener import StreamingQueryListener


class IngestTotals(StreamingQueryListener):
    """Adds up the ``ingest`` totals that decoded streams observe."""

    def __init__(self) -> None:
        self.totals = {"received": 0, "sent": 0, "errors": 0}
        self.batches = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get("ingest")
        self.batches += 1
        if row is not None:
            for name in self.totals:
                self.totals[name] += row[name]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
