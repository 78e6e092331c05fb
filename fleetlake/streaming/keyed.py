"""Edge detection on Spark's keyed state: rows may come in any order within a delay."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.timegrid import micros
from ..operators.edges import never_both, threshold_flags, thresholds

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def use_rocksdb(spark: SparkSession) -> SparkSession:
    """Keyed state needs this store; it keeps what it holds on disk and in the checkpoint."""
    spark.conf.set(_PROVIDER, ROCKSDB)
    return spark


@dataclass
class Flags:
    """What a series remembers of the rows it has gone through; see ``operators.edges``."""

    seen_below: bool = False
    seen_above: bool = False
    below: bool | None = None
    above: bool | None = None
    risen: bool = False
    fallen: bool = False

    def step(self, below: bool, above: bool) -> tuple[bool, bool]:
        """Whether the next row is a rising and a falling edge: the first of its run to qualify."""
        if below != self.below:
            self.risen = False
        if above != self.above:
            self.fallen = False
        rising = above and self.seen_below and not self.risen
        falling = below and self.seen_above and not self.fallen
        self.risen |= rising
        self.fallen |= falling
        self.seen_below |= below
        self.seen_above |= above
        self.below, self.above = below, above
        return rising, falling


_FLAGS = "seen_below boolean, seen_above boolean, below boolean, above boolean, risen boolean, fallen boolean"


class EdgeProcessor(StatefulProcessor):
    """Holds a series' rows until the watermark has passed them, then takes them in order of time."""

    def __init__(self, held: T.StructType, output: list[str], rising_as_start: bool, forget_after_ms: int | None):
        self.held_schema, self.output = held, output
        self.rising_as_start, self.forget_after_ms = rising_as_start, forget_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.flags = handle.getValueState("flags", _FLAGS, self.forget_after_ms)
        self.held = handle.getListState("held", self.held_schema)
        self.timer = handle.getValueState("timer", "at long")

    def _wake_at(self, us: int) -> None:
        """One timer a series, for its earliest held row."""
        at = us // 1000 + 1
        known = self.timer.get()
        if known is not None:
            if known[0] <= at:
                return
            self.handle.deleteTimer(known[0])
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: ANN001, N802, N803
        fresh = [tuple(row) for row in rows]
        self.held.appendList(fresh)
        self._wake_at(min(row[0] for row in fresh))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: ANN001, N802, N803
        # A row at or before the watermark can't come any more.
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = sorted((tuple(row) for row in self.held.get()), key=lambda row: row[0])
        due = [row for row in held if row[0] <= passed]
        rest = held[len(due) :]
        known = self.flags.get()
        flags = Flags(*known) if known is not None else Flags()
        edge = Row(*self.output)
        for row in due:
            us, below, above, *values = row
            rising, falling = flags.step(below, above)
            start, stop = (rising, falling) if self.rising_as_start else (falling, rising)
            if start:
                yield edge(*values, "Start", 1)
            if stop:
                yield edge(*values, "Stop", 0)
        if due:
            self.flags.update((flags.seen_below, flags.seen_above, flags.below, flags.above, flags.risen, flags.fallen))
        self.timer.clear()
        if rest:
            self.held.put(rest)
            self._wake_at(rest[0][0])
        else:
            self.held.clear()

    def close(self) -> None:
        pass


def stream_edges(
    stream: DataFrame,
    signal: str,
    lower: float,
    upper: float,
    exact: bool = False,
    rising_as_start: bool = True,
    keys: Sequence[str] = ("device", "message"),
    t: str = "t",
    late: str = "1 hour",
    forget_after: int | None = None,
) -> DataFrame:
    """The rows of an endless stream that are edges, with ``EventType`` and ``EventValue``, in append mode.

    Rows may come in any order as long as none is more than ``late`` behind the latest row seen; they
    are held until the watermark has passed them; it follows the rows beyond a threshold, as no others
    are looked at where both thresholds exclude each other. So the edges are those of ``detect_edges``
    over all rows up to the watermark. A series keeps six flags and the held rows that lie beyond a threshold:
    its state is bounded by the delay. ``forget_after`` (milliseconds, wall-clock) drops the flags of a
    series that nothing has come of for so long. Rows without a time are dropped, missing values are
    neither below nor above. The session must use the store of ``use_rocksdb``.

    Expects distinct times within a series. All rows of a series go to one task of a batch; where one
    device holds most rows, ``EdgeDetector`` splits it.
    """
    value = F.col(signal)
    rows = stream.where(F.col(t).isNotNull())
    if never_both(lower, upper, exact):
        # Rows between the thresholds influence no edge; bare comparisons can be pushed to the scan.
        low, high = thresholds(value, lower, upper, exact)
        rows = rows.where(low | high)
    rows = rows.withWatermark(t, late)
    below, above = threshold_flags(value, lower, upper, exact)
    flagged = rows.select(micros(t).alias("_us"), below.alias("_below"), above.alias("_above"), *stream.columns)
    output = T.StructType([*stream.schema.fields, T.StructField("EventType", T.StringType()), T.StructField("EventValue", T.LongType())])
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in flagged.schema.fields])
    processor = EdgeProcessor(nullable, output.names, rising_as_start, forget_after)
    return flagged.groupBy(*keys).transformWithState(processor, output, "Append", "EventTime")
