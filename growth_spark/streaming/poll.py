"""Following a live series: each micro-batch is a poll, and the rules of emission live in ``foreachBatch``."""

from __future__ import annotations

import asyncio
import inspect
import json
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.align import last_rows

Result = DataFrame


class Poll:
    """One followed series.

    ``distinct_by`` gives a key of a batch; a batch is emitted only if its key differs from the one emitted last (keys
    that come back later pass). ``until`` stops after the batch that satisfies it, which is still emitted; ``max_polls``
    counts every attempt, failed and suppressed ones too. A failed batch goes to ``on_error`` (or is passed over) and
    following goes on. The last key is kept in a file beside the query's checkpoint, so a restart doesn't repeat it.

    With ``last_n`` each poll gives the last ``last_n`` rows by ``time`` of each ``item`` of all that has come so far. Those
    rows are kept in the folder ``kept``, in two places in turn, so that a batch that is run again starts from the one before.
    """

    def __init__(
        self,
        on_result: Callable[[Result, int], None],
        *,
        distinct_by: Callable[[Result], object] | None = None,
        until: Callable[[Result], bool] | None = None,
        max_polls: int | None = None,
        on_error: Callable[[Exception], None] | None = None,
        state: str | None = None,
        last_n: int | None = None,
        item: tuple[str, ...] = (),
        time: str = "time_us",
        kept: str | None = None,
    ) -> None:
        if last_n is not None and (last_n < 1 or kept is None):
            raise ValueError("last_n must be at least 1 and needs the folder kept")
        self.last_n, self.item, self.time, self.kept = last_n, item, time, kept
        self.on_result, self.distinct_by, self.until, self.max_polls, self.on_error, self.state = on_result, distinct_by, until, max_polls, on_error, state
        self.polls, self.done = 0, False
        self.last: object = _NOTHING
        self.query: StreamingQuery | None = None

    def _stored(self, spark) -> None:
        """The key emitted last, read from the shared folder through Spark."""
        if self.last is _NOTHING and self.state:
            try:
                rows = spark.read.text(self.state).collect()
            except Exception as e:
                if "PATH_NOT_FOUND" not in str(e):
                    raise
                return
            if rows:
                self.last = json.loads(rows[0][0])

    def _last_rows(self, df: Result, number: int) -> Result:
        """The last rows of the batches before and of this one, written to the place that those before are not in."""
        found = []
        for place in (0, 1):
            try:
                rows = df.sparkSession.read.parquet(f"{self.kept}/{place}")
            except Exception as e:
                if "PATH_NOT_FOUND" not in str(e):
                    raise
                continue
            at = rows.agg(F.max("_batch")).first()[0]
            if at is not None and at < number:
                found.append((at, place, rows.drop("_batch")))
        _, place, before = max(found, key=lambda x: x[0], default=(None, 1, None))
        rows = df if before is None else before.unionByName(df)
        path = f"{self.kept}/{1 - place}"
        last_rows(rows, list(self.item), self.time, self.last_n).withColumn("_batch", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def batch(self, df: Result, number: int) -> None:
        if self.done:
            return
        self.polls += 1
        try:
            self._stored(df.sparkSession)
            if self.last_n is not None:
                df = self._last_rows(df, number)
            key = self.distinct_by(df) if self.distinct_by else None
            if self.distinct_by is None or key != self.last:
                answer = self.on_result(df, number)
                if inspect.isawaitable(answer):
                    asyncio.run(_awaited(answer))
                if self.distinct_by:
                    self.last = key
                    if self.state:
                        df.sparkSession.createDataFrame([(json.dumps(key),)], "value string").write.mode("overwrite").text(self.state)
                if self.until and self.until(df):
                    self.done = True
        except Exception as e:
            if self.on_error:
                self.on_error(e)
        if self.max_polls is not None and self.polls >= self.max_polls:
            self.done = True

    def start(self, stream: DataFrame, checkpoint: str, interval: float | None = 1.0, fire_immediately: bool = True) -> StreamingQuery:
        """Follow ``stream`` every ``interval`` seconds (None: take what there is and end); the handle stops it."""
        if not fire_immediately and interval:
            time.sleep(interval)
        writer = stream.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint)
        writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=f"{interval} seconds")
        self.query = writer.start()
        threading.Thread(target=self._watch, daemon=True).start()
        return self.query

    def _watch(self) -> None:
        """Stops the query once a rule has ended it (a batch can't stop the query it runs in)."""
        while self.query is not None and self.query.isActive:
            if self.done:
                self.query.stop()
                return
            time.sleep(0.05)


async def _awaited(answer):
    return await answer


class _Nothing:
    def __eq__(self, other: object) -> bool:
        return False

    __hash__ = None


_NOTHING = _Nothing()
