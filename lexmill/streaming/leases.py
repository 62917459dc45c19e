"""Leases on queue rows: workers come and go, a claim that is not kept alive runs out, and its row can be claimed again.

Workers write requests; nothing else tells them apart, so their number may change at any time. The requests of one row
meet in keyed state: the first claim of a free row wins, later ones are passed over (they are not waited for), a beat of the
holder puts the end of the lease off, and a mark counts only while its worker holds the row. A timer gives the row back when
the lease ends. Every row is so done once in effect, although each request may be delivered many times.

The same steps run over a log (:func:`lease_log`: rows of a key are streamed in order, none are collected) and over a stream (:func:`leased`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

CLAIM, BEAT, DONE, FAIL = "claim", "beat", "done", "fail"
GRANTED, BUSY, KEPT, LOST, MARKED, FREED, EXPIRED, OVER = "granted", "busy", "kept", "lost", "marked", "freed", "expired", "over"
#: Requests: row, time in microseconds, an id that orders requests of one time, who asks, and what for.
REQUEST = "id long, at long, request_id long, worker string, kind string"
OUTCOME = f"{REQUEST}, outcome string"
STATE = "worker string, until long, done boolean, last_at long, last_request long"
ROCKSDB = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@dataclass
class Lease:
    """A row's state: who holds it until when (exclusive), and whether it is done."""

    worker: str | None = None
    until: int = 0
    done: bool = False

    def expired(self, at: int) -> tuple[int, str] | None:
        """When and from whom the row came back, if its lease has ended by ``at``."""
        if self.worker is None or at < self.until:
            return None
        told = (self.until, self.worker)
        self.worker = None
        return told

    def step(self, at: int, worker: str, kind: str, length: int) -> str:
        """What becomes of a request; a lease that has ended by then must have been taken back."""
        if self.done:
            return OVER
        if kind == CLAIM:
            if self.worker is not None:
                return BUSY
            self.worker, self.until = worker, at + length
            return GRANTED
        if self.worker != worker:
            return LOST
        if kind == BEAT:
            self.until = at + length
            return KEPT
        self.worker = None
        if kind == DONE:
            self.done = True
            return MARKED
        return FREED


def lease_log(requests: DataFrame, length: int, end: int | None = None) -> DataFrame:
    """``OUTCOME`` of a log of requests, and a row for each lease that ran out (its worker, with the time of its end; the
    request's id is null). ``end``: when the log ends, for leases still held then.

    Rows are dealt by their id and pass in order; only one row's state is held at a time. A request that repeats an earlier one
    (equal id) is left out."""
    once = requests.select("id", "at", "request_id", "worker", "kind").dropDuplicates(["id", "request_id"])
    dealt = once.repartition(int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id").sortWithinPartitions("id", "at", "request_id")
    names = ["id", "at", "request_id", "worker", "kind", "outcome"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, lease = None, Lease()

        def given_back(at: int | None, out: list) -> None:
            if at is not None and (told := lease.expired(at)):
                out.append((key, told[0], None, told[1], None, EXPIRED))

        for batch in batches:
            out: list[tuple] = []
            for row_id, at, request, worker, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row_id != key:
                    given_back(end, out)
                    key, lease = row_id, Lease()
                given_back(at, out)
                out.append((row_id, at, request, worker, kind, lease.step(at, worker, kind, length)))
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], ARROW)
        out = []
        given_back(end, out)
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], ARROW)

    return dealt.mapInArrow(run, OUTCOME)


ARROW = pa.schema([("id", pa.int64()), ("at", pa.int64()), ("request_id", pa.int64()), ("worker", pa.string()), ("kind", pa.string()), ("outcome", pa.string())])


class _Leases(StatefulProcessor):
    """Keyed state with a timer in event time for the end of each lease."""

    def __init__(self, length: int) -> None:
        self.length = length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("lease", STATE)

    def _load(self) -> tuple[Lease, tuple[int, int]]:
        if not self.state.exists():
            return Lease(), (-1, -1)
        worker, until, done, at, request = self.state.get()
        return Lease(worker, until, done), (at, request)

    def _save(self, lease: Lease, last: tuple[int, int]) -> None:
        self.state.update((lease.worker, lease.until, lease.done, *last))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if lease.worker is not None:
            self.handle.registerTimer(-(-lease.until // 1000))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        lease, last = self._load()
        asked = sorted((int(r.at), int(r.request_id), r.worker, r.kind) for part in rows for r in part.itertuples())
        out = []
        for at, request, worker, kind in asked:
            if (at, request) <= last:  # delivered before
                continue
            if told := lease.expired(at):
                out.append((key[0], told[0], None, told[1], None, EXPIRED))
            out.append((key[0], at, request, worker, kind, lease.step(at, worker, kind, self.length)))
            last = (at, request)
        self._save(lease, last)
        yield _told(out)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        lease, last = self._load()
        told = lease.expired(expiredTimerInfo.getExpiryTimeInMs() * 1000)
        self._save(lease, last)
        yield _told([(key[0], told[0], None, told[1], None, EXPIRED)] if told else [])

    def close(self) -> None:
        pass


def _told(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["id", "at", "request_id", "worker", "kind", "outcome"])
    return out.astype({"id": "Int64", "at": "Int64", "request_id": "Int64", "worker": object, "kind": object, "outcome": object})


def leased(requests: DataFrame, length: int, late: str = "0 seconds") -> DataFrame:
    """``OUTCOME`` of a stream of requests. The watermark is ``late`` behind the newest request: leases run out when it passes their
    end, and requests of one row must not be later than that to be in order. Streams of the session keep their state in RocksDB from
    then on, which timers need."""
    requests.sparkSession.conf.set(*ROCKSDB)
    timed = requests.withColumn("time", F.timestamp_micros("at")).withWatermark("time", late)
    return timed.groupBy("id").transformWithStateInPandas(statefulProcessor=_Leases(length), outputStructType=OUTCOME, outputMode="Append", timeMode="EventTime")


def statuses(outcomes: DataFrame) -> DataFrame:
    """``id, status, worker`` as the outcomes leave each row: ``done``, ``working`` or ``pending``; of equal times the request
    that came last counts, and what ran out came before it."""
    changes = outcomes.where(F.col("outcome").isin(GRANTED, MARKED, FREED, EXPIRED))
    last = changes.groupBy("id").agg(F.max(F.struct("at", F.coalesce("request_id", F.lit(-1)).alias("request_id"), "outcome", "worker")).alias("last"))
    status = F.when(F.col("last.outcome") == MARKED, "done").when(F.col("last.outcome") == GRANTED, "working").otherwise("pending")
    return last.select("id", status.alias("status"), F.when(F.col("last.outcome").isin(MARKED, GRANTED), F.col("last.worker")).alias("worker"))
