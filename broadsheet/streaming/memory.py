"""What a stream of stories has covered before: keyed state that forgets by event time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.text import fingerprint
from ..session import SETTINGS

#: The one kind of state store that holds values and timers side by side; Spark's default cannot.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
SEEN = T.StructType([T.StructField("last_us", T.LongType())])


class Coverage(StatefulProcessor):
    """Per fingerprint the last time it was seen, until ``gap_us`` have passed since. ``columns`` come out, among them ``_first_us``."""

    def __init__(self, gap_us: int, columns: list[str]) -> None:
        self.gap_us, self.columns = gap_us, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", SEEN)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows))
        # Names that are no Python identifiers do not arrive, so columns go by place.
        arrived.columns = [*self.columns, "_last_us"]
        arrived = arrived.sort_values(["_first_us", "_last_us"])
        last = self.seen.get()[0] if self.seen.exists() else None
        fresh = []
        for first_us, last_us in zip(arrived["_first_us"], arrived["_last_us"]):
            fresh.append(last is None or first_us - last >= self.gap_us)
            last = int(last_us) if last is None else max(last, int(last_us))
        if key[0] is not None:  # a text that is null is no story
            self.seen.update((last,))
            self.handle.registerTimer((last + self.gap_us) // 1000 + 1)
            if any(fresh):
                yield arrived.loc[fresh, self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.seen.exists() and self.seen.get()[0] + self.gap_us < expiredTimerInfo.getExpiryTimeInMs() * 1000:
            self.seen.clear()
        yield from ()

    def close(self) -> None:
        pass


def first_coverage(
    stream: DataFrame, text: str, keep: tuple[str, ...] = (), days: int = 7, at: str = "received_at", delay: str = "1 hour",
) -> DataFrame:
    """A story text only when it was not seen in the ``days`` before: (fingerprint, at, *keep) of the first row.

    Rows count in the order of ``at``, whatever files or batches bring them, as long as they are not later than
    ``delay``; of rows at one time the one with the smallest kept columns comes first. A row is told
    once the watermark has passed its hour: first and last row of every text and hour are found before texts meet
    their state, so a text that floods in moves as one row per task and hour. State holds one number
    per text and is dropped by a timer when the text may be told again. Rows without text or time are no stories.
    The session's state store is set to the one this needs; streams started before keep theirs.
    """
    stream.sparkSession.conf.set(STATE_STORE, SETTINGS[STATE_STORE])
    # Times travel as numbers: a stream has one event time column, the end of the hour, and pandas has no time after the year 2262.
    # The state needs no event time, as a row comes to it when the watermark has passed its hour.
    micros = F.unix_micros(at)
    hourly = (
        stream.withColumn("fingerprint", fingerprint(F.col(text))).withWatermark(at, delay)
        .groupBy(F.window(at, "1 hour").alias("_hour"), "fingerprint")
        .agg(F.min(F.struct(micros.alias("_us"), *keep)).alias("_first"), F.max(micros).alias("_last_us"))
        .select("fingerprint", *[F.col("_first")[c].alias(c) for c in keep], F.col("_first._us").alias("_first_us"), "_last_us")
    )
    out = hourly.select("fingerprint", *keep, "_first_us").schema
    told = hourly.groupBy("fingerprint").transformWithStateInPandas(
        Coverage(days * 86_400_000_000, out.fieldNames()), outputStructType=out, outputMode="Append", timeMode="EventTime")
    return told.select("fingerprint", F.timestamp_micros("_first_us").alias(at), *keep)
