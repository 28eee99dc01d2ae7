"""Streams of queue messages: identity, deduplication, retries, dependencies, backpressure, alerts.

Stateless operators and window forms take batch or stream frames. The lateness policy of the
domain is that messages for finished scenes are ignored; watermarks bound the state.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues


#: The queues, the seconds that a message may wait in one, and where it goes then. Only the dead-letter queue keeps messages for ever.
QUEUES = (
    "ie.jobs.submit", "ie.scene.plan", "ie.tile.preprocess", "ie.tile.infer", "ie.tile.done", "ie.block.ready", "ie.block.vectorize", "ie.block.done",
    "ie.scene.merge", "ie.job.finalize", "ie.events", "ie.dead_letter",
)
DEAD_LETTER, QUEUE_TTL = "ie.dead_letter", 7 * 24 * 60 * 60


def topology(spark: SparkSession) -> DataFrame:
    """(queue, durable, ttl_sec, dead_letter) of all queues."""
    rows = [(q, True, None if q == DEAD_LETTER else QUEUE_TTL, None if q == DEAD_LETTER else DEAD_LETTER) for q in QUEUES]
    return spark.createDataFrame(rows, "queue string, durable boolean, ttl_sec bigint, dead_letter string")


def dead_lettered(queue: Column, age: Column) -> Column:
    """Where a message of so many seconds is: in its queue, or in the dead-letter queue once it has waited too long."""
    return F.when(age > QUEUE_TTL, F.lit(DEAD_LETTER)).otherwise(queue)


def message_id(*parts: Column) -> Column:
    """Non-empty parts joined by slashes."""
    return F.array_join(F.filter(F.array(*(p.cast("string") for p in parts)), lambda p: p.isNotNull() & (p != "")), "/")


def deduplicated(stream: DataFrame, id_col: str = "message_id", ts_col: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """The first message of each id; the state of an id is dropped when the watermark has passed it."""
    return stream.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([id_col])


def retry_route(attempt: Column, most: int) -> Column:
    """Where a failed message goes: back to its queue, or to the dead letters."""
    return F.when(attempt + 1 < most, "retry").otherwise("dead_letter")


def ready_blocks(done: DataFrame, needs: DataFrame) -> DataFrame:
    """(scene, block, ready_ts): the time of the last tile a block waits for, for blocks whose tiles are all done; each block once."""
    first = done.groupBy("scene", "tile").agg(F.min("ts").alias("ts"))
    told = needs.join(first, ["scene", "tile"], "left").groupBy("scene", "block").agg(F.max("ts").alias("ready_ts"), F.count_if(F.col("ts").isNull()).alias("open"))
    return told.filter("open = 0").drop("open")


#: State of the stateful streams below lives in this store, which their sessions must name in spark.sql.streaming.stateStore.providerClass.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class ReadyBlocks(StatefulProcessor):
    """One block of a scene: the tiles that are done and when, until all are; then only that it was told, until a timer clears that too.

    hold: milliseconds of event time for which a finished block ignores repeated messages, and after which a block that hears nothing is given up.
    Times are microseconds. All of a block's state is one value, as each call of the store takes longer than a message does.
    """

    def __init__(self, hold: int):
        self.hold = hold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("block", "told boolean, until bigint, tiles array<bigint>, at array<bigint>")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        was = self.state.get()
        told, until, tiles = (was[0], was[1], dict(zip(was[2], was[3], strict=True))) if was else (False, None, {})
        last, need = None, 0
        for r in rows:
            us, need = r.us, r.n_tiles
            last = us if last is None else max(last, us)
            if not told:
                tiles[r.tile] = min(us, tiles.get(r.tile, us))
        if last is None:
            return
        ready = not told and len(tiles) >= need
        again = max(last // 1000, timerValues.getCurrentWatermarkInMs()) + self.hold
        if until != again:
            if until is not None:
                self.handle.deleteTimer(until)
            self.handle.registerTimer(again)
        kept = {} if told or ready else tiles
        self.state.update((told or ready, again, list(kept), list(kept.values())))
        if ready:
            yield Row(scene=key[0], block=key[1], ready_us=max(tiles.values()))

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        yield from ()

    def close(self) -> None:
        pass


def ready_blocks_stream(done: DataFrame, needs: DataFrame, delay: str = "10 minutes", hold_minutes: int = 24 * 60) -> DataFrame:
    """(scene, block, ready_ts) of a stream (scene, tile, ts) with a static table of needs (scene, tile, block, n_tiles).

    A block is told once, when its last tile comes, with the time of the last tile's first message, over however many micro-batches.
    Messages later than the watermark are ignored; a block's state shrinks when it is told, and goes by a timer.
    """
    joined = done.withWatermark("ts", delay).join(needs, ["scene", "tile"]).select("scene", "block", "tile", "n_tiles", "ts", F.unix_micros("ts").alias("us"))
    told = joined.groupBy("scene", "block").transformWithState(ReadyBlocks(hold_minutes * 60_000), "scene bigint, block bigint, ready_us bigint", "Append", "EventTime")
    return told.select("scene", "block", F.timestamp_micros("ready_us").alias("ready_ts"))


class Batches(StatefulProcessor):
    """A key's rows in order of time and id, handed on in batches of `size` rows, or fewer where the first has waited for `wait` milliseconds."""

    def __init__(self, size: int, wait: int):
        self.size, self.wait = size, wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "ts timestamp, event_id bigint")
        self.made = handle.getValueState("made", "n bigint")

    def _settle(self, key: tuple, upto: int) -> Iterator[pd.DataFrame]:
        """Batches of which it is settled by this time which rows are in them."""
        held = sorted((pd.Timestamp(ts), int(i)) for ts, i in self.rows.get())
        n = int(self.made.get()[0]) if self.made.exists() else 0
        out = []
        at = lambda r: int(r[0].timestamp() * 1000)
        gone = 0
        while gone < len(held):
            end = at(held[gone]) + self.wait
            inside = [r for r in held[gone : gone + self.size] if at(r) < end]
            whole = len(inside) == self.size and at(inside[-1]) < upto
            if not whole and end > upto:
                break
            out.append((n, len(inside), inside[0][0], inside[-1][0]))
            n, gone = n + 1, gone + len(inside)
        held = held[gone:]
        self.rows.clear()
        if held:
            self.rows.put([(ts.to_pydatetime(), i) for ts, i in held])
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if held:
            # the next batch is settled by the end of its wait, or once the watermark has passed the row that fills it
            full = at(held[self.size - 1]) + 1 if len(held) >= self.size else at(held[0]) + self.wait
            self.handle.registerTimer(max(min(full, at(held[0]) + self.wait), upto + 1))
        self.made.update((n,))
        if out:
            k = list(zip(*out, strict=True))
            yield pd.DataFrame({"stage": key[0], "scene": key[1], "batch": k[0], "n": k[1], "first_ts": k[2], "last_ts": k[3]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        for f in rows:
            self.rows.appendList([(ts.to_pydatetime(), int(i)) for ts, i in zip(f["ts"], f["event_id"], strict=True)])
        yield from self._settle(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settle(key, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def micro_batches_stream(rows: DataFrame, size: int, wait_ms: int, delay: str = "10 minutes") -> DataFrame:
    """(stage, scene, batch, n, first_ts, last_ts) of a stream (stage, scene, ts, event_id): the batches that a worker takes.

    A batch opens with a row and takes rows in order of time until it has `size` of them or its first one has waited for wait_ms; it is handed on
    when the watermark has settled which. What is open when the stream stops stays in its state.
    """
    return rows.withWatermark("ts", delay).groupBy("stage", "scene").transformWithStateInPandas(
        Batches(size, wait_ms), "stage string, scene bigint, batch bigint, n bigint, first_ts timestamp, last_ts timestamp", "Append", "EventTime"
    )


def hysteresis(samples: DataFrame, key: list[str], order: list[str], pause: Column, resume: Column) -> DataFrame:
    """samples with `paused`: set by the last sample at which pause or resume held (pause wins), not paused before the first."""
    w = Window.partitionBy(*key).orderBy(*order)
    said = F.when(pause, F.lit(True)).when(resume, F.lit(False))
    return samples.withColumn("paused", F.coalesce(F.last(said, ignorenulls=True).over(w), F.lit(False)))


def alerts(samples: DataFrame, key: list[str], ts: str, on: Column, seconds: int) -> DataFrame:
    """(key, start, end) of runs of samples at which the condition holds for at least so many seconds."""
    w = Window.partitionBy(*key).orderBy(ts, "event_id")
    marked = samples.withColumn("on", on)
    runs = marked.withColumn("run", F.sum((~F.col("on")).cast("int")).over(w)).filter("on")
    told = runs.groupBy(*key, "run").agg(F.min(ts).alias("start"), F.max(ts).alias("end"))
    return told.filter(F.unix_micros(F.col("end").cast("timestamp")) - F.unix_micros(F.col("start").cast("timestamp")) >= seconds * 1_000_000).drop("run")


def micro_batches(rows: DataFrame, key: list[str], order: list[str], size: int) -> DataFrame:
    """Batches of at most size rows of a key, in order: first, last and number of rows."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1
    return rows.withColumn("batch", F.floor(place / size).cast("bigint")).groupBy(*key, "batch").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def after_terminal(messages: DataFrame, finished: DataFrame, key: list[str]) -> DataFrame:
    """Messages of scenes that are not finished; of a stream, joined with the static table of finished ones."""
    return messages.join(finished.select(*key), key, "left_anti")


def event_time(stream: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Test tables hold timestamps without a zone, which watermarks do not take."""
    return stream.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
