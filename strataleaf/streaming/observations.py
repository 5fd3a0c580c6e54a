"""Observations as a stream: versions, late arrivals and event-time counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUT = "document string, seen timestamp, content string, outcome string, version long"


def ingest(stream: DataFrame) -> DataFrame:
    """Outcome of each observation (document, seen, content): new, amended, unchanged or skipped.

    The state of a document is its current content, the time it was last seen, and its version. An observation
    older than the last one is skipped, whatever it holds.
    """
    from pyspark.sql.streaming.state import GroupStateTimeout

    def step(key, batches, state):
        import pandas as pd

        content, last, version = state.get if state.exists else (None, None, 0)
        for batch in batches:
            out = []
            for seen, now in batch.sort_values("seen")[["seen", "content"]].itertuples(index=False):
                if last is not None and seen < pd.Timestamp(last):
                    out.append((key[0], seen, now, "skipped", version))
                    continue
                last = str(seen)
                if version and now == content:
                    out.append((key[0], seen, now, "unchanged", version))
                    continue
                outcome = "amended" if version else "new"
                content, version = now, version + 1
                out.append((key[0], seen, now, outcome, version))
            state.update((content, last, version))
            yield pd.DataFrame(out, columns=["document", "seen", "content", "outcome", "version"])

    return stream.groupBy("document").applyInPandasWithState(step, OUT, "content string, last string, version long", "append", GroupStateTimeout.NoTimeout)


def counts(stream: DataFrame, late: str = "1 hour", width: str = "1 hour") -> DataFrame:
    """Observations by window of event time; those later than the watermark are dropped by the engine."""
    return stream.withWatermark("seen", late).groupBy(F.window("seen", width)).agg(F.count(F.lit(1)).alias("n"))
