"""Live series followed item by item: Spark keeps what each item needs between polls.

One stream holds any number of items. A micro-batch is a poll of every item that has new rows in it; an item's state is its
last rows and the key emitted last, kept by Spark in its state store and checkpointed with the query, so a restart goes on where
it ended and nothing of an item passes the driver. Rows of an item, or of a bucket of items, in one batch are bounded by the
source's limit a trigger.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

if TYPE_CHECKING:
    import pandas as pd

POLL = "poll"
#: Rows of an item that are taken in at a time.
PART = 4096
#: Column with, and number of, the buckets of items that share a state.
BUCKET, BUCKETS = "_bucket", 1024


def session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose queries keep state in RocksDB, which state by item needs."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own


def _missing(x: object) -> bool:
    return x is None or (isinstance(x, float) and x != x)


def _plain(values: Iterable) -> tuple:
    """Values as the state and keys take them; missing ones as None."""
    return tuple(None if _missing(x) else x for x in values)


def _place(columns: list[str], order: list[str]) -> Callable[[tuple], tuple]:
    """The key by which rows are sorted; missing values come last."""
    at = [columns.index(c) for c in order]
    return lambda row: tuple((True, 0) if _missing(row[i]) else (False, row[i]) for i in at)


class LastRows(StatefulProcessor):
    """Each poll of an item gives its last rows of all that has come so far, where the rules let it pass."""

    def __init__(self, schema: StructType, order: list[str], last_n: int, distinct_by: Callable[[pd.DataFrame], object] | None, until: Callable[[pd.DataFrame], bool] | None, max_polls: int | None) -> None:
        self.schema, self.order, self.last_n, self.distinct_by, self.until, self.max_polls = schema, order, last_n, distinct_by, until, max_polls

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getListState("kept", self.schema)
        self.said = handle.getValueState("said", "emitted string, polls bigint, done boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        emitted, polls, done = self.said.get() or (None, 0, False)
        ring, place = list(map(tuple, self.kept.get())) if polls else [], _place(self.schema.names, self.order)
        while part := list(itertools.islice(rows, PART)):  # never more than the last rows and one part at a time
            ring = sorted([*ring, *map(tuple, part)], key=place)[-self.last_n :]
        if done:
            return
        polls += 1
        frame = None
        if self.distinct_by or self.until:
            import pandas as pd

            frame = pd.DataFrame(ring, columns=self.schema.names)
        found = None if self.distinct_by is None else json.dumps(self.distinct_by(frame), default=str)
        passes = self.distinct_by is None or found != emitted
        if passes:
            emitted = found
            done = bool(self.until and self.until(frame))
        done = done or (self.max_polls is not None and polls >= self.max_polls)
        self.kept.put([_plain(r) for r in ring])
        self.said.update((emitted, polls, done))
        if passes:
            named = Row(*self.schema.names, POLL)
            yield from (named(*r, polls) for r in ring)

    def close(self) -> None:
        pass


class Changes(StatefulProcessor):
    """Rows of a bucket's items whose key is not that of the row of their item that was emitted or passed over last.

    The state is one value for all items of the bucket, read and written once a batch: calls to the state store cost more than the
    rows of an ordinary item.
    """

    def __init__(self, columns: list[str], order: list[str], by: list[str], item: Sequence[str] = ()) -> None:
        self.columns, self.order, self.by, self.item = columns, order, by, item

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "keys string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state = self.last.get()
        keys: dict[str, str] = json.loads(state[0]) if state else {}
        own, at = ([self.columns.index(c) for c in names] for names in (self.item, self.by))
        for row in sorted(rows, key=_place(self.columns, self.order)):
            name = json.dumps([row[i] for i in own], default=str)
            found = json.dumps(_plain(row[i] for i in at), default=str)
            if keys.get(name) != found:
                yield row
            keys[name] = found
        self.last.update((json.dumps(keys),))

    def close(self) -> None:
        pass


def follow(stream: DataFrame, item: list[str], order: list[str], last_n: int, *, distinct_by: Callable[[pd.DataFrame], object] | None = None, until: Callable[[pd.DataFrame], bool] | None = None, max_polls: int | None = None) -> DataFrame:
    """The last ``last_n`` rows by ``order`` of each item at each of its polls, with the number of the poll.

    ``distinct_by`` gives the key of an item's rows; they are emitted only if it is not the key emitted last (keys that come back
    later pass). ``until`` ends an item after the rows that satisfy it, which are still emitted; ``max_polls`` counts
    suppressed polls too. An item that has ended takes no more rows; the others go on.
    """
    if last_n < 1:
        raise ValueError("last_n must be at least 1")
    if max_polls is not None and max_polls < 1:
        raise ValueError("max_polls must be at least 1")
    out = StructType([*stream.schema.fields, StructField(POLL, LongType())])
    return stream.groupBy(*item).transformWithState(LastRows(stream.schema, order, last_n, distinct_by, until, max_polls), out, "Update", "None")


def changes(stream: DataFrame, item: list[str], order: list[str], by: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Rows whose key ``by`` is not that of the row before of their item, over all batches. Within a batch rows go by
    ``order``; batches go as they come. Items are kept together in ``buckets`` of state, a number that a query's checkpoint fixes."""
    dealt = stream.withColumn(BUCKET, F.pmod(F.xxhash64(*item), F.lit(buckets)))
    return dealt.groupBy(BUCKET).transformWithState(Changes(dealt.schema.names, order, by, item), dealt.schema, "Update", "None").drop(BUCKET)
