"""Speaker turns and windows as streams."""

from __future__ import annotations

import math
import threading
from bisect import bisect_right
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUT = "recording LONG, speaker STRING, start_time DOUBLE, end_time DOUBLE, turns LONG, late BOOLEAN"
OPEN = "speaker STRING, start_time DOUBLE, end_time DOUBLE, turns LONG"
NAMES = ["recording", "speaker", "start_time", "end_time", "turns", "late"]
ROWS = "starts ARRAY<DOUBLE>, seqs ARRAY<LONG>, speakers ARRAY<STRING>, ends ARRAY<DOUBLE>"
#: Seconds of one slot of a recording's waiting rows.
SLOT = 60.0
#: Rows of an entry of several slots, at most: what a timer that finds one ready may keep in the head.
ENTRY = 256
#: The state store that TurnMerger needs.
ROCKSDB = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class TurnMerger(StatefulProcessor):
    """Rows of a recording wait in slots of SLOT seconds until the watermark has passed the slot's end, so
    rows which come late, but not later than that, are merged in their place. Slots that follow each other share an entry
    of a map, keyed by its first slot, as long as it has no more than ENTRY rows: where slots have few rows, calls to the state
    store take the time. A timer reads each entry whose first slot is ready once, and keeps what is not ready yet of the
    last one in the head. The head also has the open turn, the last slot left behind and the first slots of the entries; while
    ENTRY rows or fewer wait, it has them all. The open turn is closed by a row of another speaker or after a gap, or once
    the slot is ready that the turn's end and the gap reach into. A row whose slot has been left behind goes out by
    itself, marked late."""

    def __init__(self, gap: float):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", f"done LONG, {OPEN}, firsts ARRAY<LONG>, {ROWS}")
        self.slots = handle.getMapState("slots", "slot LONG", ROWS)

    def _read(self) -> tuple[int | None, tuple | None, list[int], list[tuple]]:
        """Last slot left behind, open turn, first slots of the entries, and the rows that are in the head: all of them before
        the first entry."""
        if not self.head.exists():
            return None, None, [], []
        done, *held, firsts, starts, seqs, speakers, ends = self.head.get()
        return done, tuple(held) if held[-1] is not None else None, list(firsts), list(zip(starts, seqs, speakers, ends, strict=True))

    def _write(self, done: int | None, held: tuple | None, firsts: list[int], near: list[tuple]) -> None:
        self.head.update((done, *(held or (None,) * 4), firsts, *_columns(near)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        done, held, firsts, near = self._read()
        late, least, places = [], None, {}
        for part in rows:
            for start, seq, speaker, end in zip(*(part[c].tolist() for c in ("start_time", "seq", "speaker", "end_time")), strict=True):
                row, slot = (start, seq, speaker if isinstance(speaker, str) else None, end), _slot(start)
                if done is not None and slot <= done:
                    late.append((key[0], row[2], start, end, 1, True))
                else:
                    least = slot if least is None else min(least, slot)
                    places.setdefault(bisect_right(firsts, slot), []).append(row)
        for n in sorted(places, reverse=True):  # from the last one, so that new entries leave the places before as they are
            old = list(zip(*self.slots.getValue((firsts[n - 1],)), strict=True)) if n else near
            pieces = _entries(old + places[n])
            if n:
                self.slots.updateValue((firsts[n - 1],), _columns(pieces.pop(0)))
            elif near or not firsts and len(pieces) == 1:
                near = pieces.pop(0)
            firsts[n:n] = [_slot(x[0][0]) for x in pieces]
            for x in pieces:
                self.slots.updateValue((_slot(x[0][0]),), _columns(x))
        if least is not None:
            self._write(done, held, firsts, near)
            self.handle.registerTimer(_after(least))
        if late:
            yield pd.DataFrame(late, columns=NAMES)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        done, held, firsts, near = self._read()
        out = []
        while True:
            near.sort(key=lambda r: r[:2])
            ready = bisect_right(near, mark, key=lambda r: _after(_slot(r[0])))
            for start, _, speaker, end in near[:ready]:
                if held is not None and speaker is not None and held[0] == speaker and start - held[2] <= self.gap:
                    held = (speaker, held[1], end, held[3] + 1)
                else:
                    out += [held] if held is not None else []
                    held = (speaker, start, end, 1)
            if ready:
                done = max(_slot(near[ready - 1][0]), done) if done is not None else _slot(near[ready - 1][0])
            near = near[ready:]
            if near or not firsts or _after(firsts[0]) > mark:
                break
            first = (firsts.pop(0),)
            near = list(zip(*self.slots.getValue(first), strict=True))
            self.slots.removeKey(first)
        reach = math.floor((held[2] + self.gap) / SLOT) if held is not None else None
        if held is not None and _after(reach) <= mark:  # all that could follow has been there
            out.append(held)
            held, done, reach = None, max(done, reach) if done is not None else reach, None
        for slot in [*([_slot(near[0][0])] if near else firsts[:1]), *([reach] if held is not None else [])]:
            self.handle.registerTimer(_after(slot))
        self._write(done, held, firsts, near)
        if out:
            speakers, starts, ends, turns = zip(*out, strict=True)
            yield pd.DataFrame({"recording": key[0], "speaker": speakers, "start_time": starts, "end_time": ends, "turns": turns, "late": False})

    def close(self) -> None:
        pass


def _slot(start: float) -> int:
    return math.floor(start / SLOT)


def _columns(rows: list[tuple]) -> tuple[list, ...]:
    return tuple(map(list, zip(*rows, strict=True))) if rows else ([],) * 4


def _entries(rows: list[tuple]) -> list[list[tuple]]:
    """Rows by time, cut between slots into entries of at most ENTRY rows; a slot of more rows is one entry."""
    out = []
    for _, own in groupby(sorted(rows, key=lambda r: r[0]), lambda r: _slot(r[0])):
        own = list(own)
        if out and len(out[-1]) + len(own) <= ENTRY:
            out[-1] += own
        else:
            out.append(own)
    return out


def _after(slot: int) -> int:
    """The millisecond after a slot's end."""
    return math.ceil((slot + 1) * SLOT * 1000) + 1


def merge_stream(turns: DataFrame, gap: float, late: str = "10 minutes") -> DataFrame:
    """Turn merging over a stream (recording, speaker, start_time, end_time, seq, ts), where start_time is ts in seconds. Rows that
    come after later ones have been merged, which the watermark of `late` allows, come out alone with late = true (write
    the result partitioned by late to have them in a table of their own); none is dropped. Needs the RocksDB state
    store: the session must name it as spark.sql.streaming.stateStore.providerClass (ROCKSDB)."""
    marked = turns.withWatermark("ts", late).drop("ts")  # without its time column a row is not dropped for its lateness
    return marked.groupBy("recording").transformWithStateInPandas(TurnMerger(gap), OUT, "append", "EventTime")


def window_stream(events: DataFrame, size: str = "30 seconds", slide: str | None = None, late: str = "1 minute") -> DataFrame:
    """Counts and sums of event-time windows."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return events.withWatermark("ts", late).groupBy(w.alias("w"), "speaker").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "speaker", "n", "total")


class Counter(StreamingQueryListener):
    """Input rows of each run, added up batch by batch: a query's own progress keeps the last hundred batches only."""

    def __init__(self):
        self.rows, self.ended, self.news = {}, set(), threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self.news:
            run = str(event.progress.runId)
            self.rows[run] = self.rows.get(run, 0) + event.progress.numInputRows

    def onQueryTerminated(self, event) -> None:
        with self.news:
            self.ended.add(str(event.runId))
            self.news.notify_all()

    def of(self, run: str, seconds: float = 60) -> int:
        """Rows of a run once its end has been reported."""
        with self.news:
            if not self.news.wait_for(lambda: run in self.ended, seconds):
                raise TimeoutError(f"the end of run {run} was not reported")
            return self.rows.get(run, 0)


def ingest(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, files: int | None = None) -> int:
    """Copy files that have not been seen yet from a folder to a table, each exactly once, at most so many files a
    batch; returns the new rows."""
    counter = Counter()
    spark.streams.addListener(counter)
    try:
        rows = spark.readStream.schema(schema).options(**({"maxFilesPerTrigger": files} if files else {})).parquet(source)
        q = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        return counter.of(str(q.runId))
    finally:
        spark.streams.removeListener(counter)
