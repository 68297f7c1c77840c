"""Job status reads and tool calls as they arrive."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from maskloom import schemas as C
from maskloom.functions import codes
from maskloom.streaming.texts import ROCKSDB

WATCHED = "job_id string, outcome string, code string, last_status string, reads bigint"
_TOLD = [c.split()[0] for c in WATCHED.split(", ")]

#: Groups of jobs or documents that share a state: one call of Python for each in a micro-batch, not one for each job.
BUCKETS = 1024


def _bucketed(rows: DataFrame, key: str, buckets: int):
    """Grouped by the bucket of their key."""
    return rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets))).groupBy("bucket")


class _Bucket(StatefulProcessor):
    """A state that holds a record for each key of a bucket, as one JSON text: [[key, record], ...]."""

    def _open(self, handle: StatefulProcessorHandle, ttl_ms: int | None = None) -> None:
        self._handle = handle
        self._state = handle.getValueState("records", "records string", ttl_ms)

    def _records(self) -> dict:
        return dict(json.loads(self._state.get()[0])) if self._state.exists() else {}

    def _keep(self, records: dict) -> None:
        if records:
            self._state.update((json.dumps(list(records.items())),))
        else:
            self._state.clear()

    def close(self) -> None:
        pass


class _Watch(_Bucket):
    """The jobs of a bucket: each one's earliest end, its latest read and latest readable one, and a timer for what is due first.

    A record: deadline, told, reads, end (at, no, outcome, code, status), latest (at, no, ok, code), readable (at, no, status),
    and whether it is but a mark that the job was told, until no read can be taken for the first of another watch.
    """

    def __init__(self, budget: int, tell: str, forget: int) -> None:
        self._budget_ms, self._at_end, self._forget_ms = budget * 1000, tell == "end", forget * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._open(handle)
        self._due = handle.getValueState("due", "ms bigint")

    def _wait(self, jobs: dict) -> None:
        """A timer for the job that is due first, in the place of the one there was."""
        due = min((job[0] + self._forget_ms if job[6] else job[0] for job in jobs.values()), default=None)
        before = self._due.get()[0] if self._due.exists() else None
        if due == before:
            return
        if before is not None:
            self._handle.deleteTimer(before)
        if due is None:
            self._due.clear()
        else:
            self._handle.registerTimer(due)
            self._due.update((due,))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        jobs, met, over = self._records(), set(), timerValues.getCurrentWatermarkInMs()
        for some in rows:
            columns = [some[c].tolist() for c in ("job_id", "started", "at", "read_no", "ok", "final", "retryable", "code", "status")]
            for job_id, started, at, no, ok, final, retryable, code, status in zip(*columns):
                job = jobs.get(job_id)
                if job is None:
                    deadline = int(started) + self._budget_ms
                    # A first read long after its watch was over and forgotten begins no other.
                    if deadline + self._forget_ms < over:
                        continue
                    job = jobs[job_id] = [deadline, False, 0, None, None, None, False]
                order = [int(at), int(no)]
                if job[6] or not job[0] - self._budget_ms <= order[0] / 1000 < job[0]:
                    continue
                met.add(job_id)
                job[2] += 1
                code, status = (v if isinstance(v, str) else None for v in (code, status))
                outcome = "settled" if ok and final else "fatal" if not ok and not retryable else None
                if outcome and (job[3] is None or order < job[3][:2]):
                    job[3] = [*order, outcome, code, status]
                if job[4] is None or order > job[4][:2]:
                    job[4] = [*order, bool(ok), code]
                if ok and (job[5] is None or order > job[5][:2]):
                    job[5] = [*order, status]
        told = []
        if self._at_end:
            for job_id in met:
                job = jobs[job_id]
                if job[3] is not None and not job[1]:
                    job[1] = True
                    told.append(self._row(job_id, job))
        self._keep(jobs)
        self._wait(jobs)
        if told:
            yield pd.DataFrame(told, columns=_TOLD)

    def _row(self, job_id: Any, job: list) -> tuple:
        _, _, reads, end, latest, readable, _ = job
        if end is not None:
            outcome, code = end[2], end[3] if end[2] == "fatal" else None
        elif latest is not None and not latest[2]:
            outcome, code = "outage", latest[3]
        else:
            outcome, code = "running", "timeout"
        status = end[4] if outcome == "settled" else readable[2] if readable is not None else None
        return job_id, outcome, code, status, reads

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        """All of the bucket that is due by now."""
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        jobs, told = {}, []
        for job_id, job in self._records().items():
            if not job[6] and job[0] <= now:
                if not job[1]:
                    told.append(self._row(job_id, job))
                job = [job[0], True, 0, None, None, None, True]
            if not job[6] or job[0] + self._forget_ms > now:
                jobs[job_id] = job
        self._due.clear()
        self._keep(jobs)
        self._wait(jobs)
        if told:
            yield pd.DataFrame(told, columns=_TOLD)


def stream_job_watch(reads: DataFrame, budget: int = C.WAIT_BUDGET_SECONDS, late: str = "10 minutes", tell: str = "end",
                     forget: int = 7 * 86_400, buckets: int = BUCKETS) -> DataFrame:
    """How watching each job ended, told once. Columns as the batch operator's, with ``started_at`` on each read.

    ``tell`` "end" tells a final status or lasting error as soon as it is read, with what was read until then,
    else when event time passes the budget. "budget" tells all at the end of their budget: then every column is
    the batch operator's, in whatever order the reads came. A job's state shrinks to a mark when its budget is
    over and goes ``forget`` seconds later. Jobs share a state with others of their bucket: many jobs want more ``buckets``.
    """
    reads.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = reads.withWatermark("ts", late).withColumns({"at": F.unix_micros("ts"), "started": F.unix_millis("started_at")})
    return _bucketed(timed, "job_id", buckets).transformWithStateInPandas(_Watch(budget, tell, forget), WATCHED, "append", "eventTime")


def stream_call_rates(log: DataFrame, length: str = "1 minute", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Calls and errors per tumbling (or, with ``slide``, sliding) window and tool, told once it is closed."""
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    return _rates(log.withWatermark("ts", late).groupBy(window, "tool"))


def stream_call_sessions(log: DataFrame, gap: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Calls and errors per burst of a tool: calls no further apart than ``gap``."""
    return _rates(log.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("window"), "tool"))


def _rates(grouped) -> DataFrame:
    return grouped.agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(F.col("outcome") == "error").alias("errors")
    ).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "tool", "calls", "errors")


def stream_latest_status(events: DataFrame, length: str = "1 day", late: str = "10 minutes") -> DataFrame:
    """Last status per document and window by event time; a stale read never overrides a newer one.

    Reads later than the watermark are dropped. A final status stays, as in the batch operator.
    """
    order = F.struct("ts", "event_id")
    final = codes.is_terminal_status(F.col("status"))
    return events.withWatermark("ts", late).groupBy(F.window("ts", length), "document_id").agg(
        F.min_by(F.when(final, F.col("status")), F.when(final, order)).alias("_final"),
        F.max_by("status", order).alias("_last"),
    ).select(F.col("window.start").alias("window_start"), "document_id", F.coalesce("_final", "_last").alias("status"))


CURRENT = "document_id string, status string, at bigint, revision bigint"
#: The place in time of a read without one.
NEVER = -(1 << 62)


class _Status(_Bucket):
    """The documents of a bucket: each one's first final status and last status by event order, how often its answer changed, when it was heard of."""

    def __init__(self, ttl_ms: int | None) -> None:
        self._ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._open(handle, self._ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs() if self._ttl_ms else 0
        documents = {d: r for d, r in self._records().items() if not self._ttl_ms or r[3] + self._ttl_ms > now}
        before = {}
        for some in rows:
            columns = [some[c].tolist() for c in ("document_id", "at", "event_id", "status", "final")]
            for document, at, no, status, final in zip(*columns):
                record = documents.get(document)
                if record is None:
                    record = documents[document] = [None, None, 0, now]
                if document not in before:
                    before[document] = record[0] or record[1]
                    record[3] = now
                found = [int(at), int(no), status]
                if final and (record[0] is None or found[:2] < record[0][:2]):
                    record[0] = found
                if record[1] is None or found[:2] > record[1][:2]:
                    record[1] = found
        changed = []
        for document, answer in before.items():
            record = documents[document]
            if (record[0] or record[1]) != answer:
                at, _, status = record[0] or record[1]
                record[2] += 1
                changed.append((document, status, at, record[2]))
        self._keep(documents)
        if changed:
            yield pd.DataFrame(changed, columns=["document_id", "status", "at", "revision"])


def stream_status(events: DataFrame, ttl_hours: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(document_id, status, ts, revision) whenever a document's status changes; the highest revision is the batch operator's row.

    A final status absorbs: later reads change nothing, only an earlier final one that comes late takes its place.
    No read is too late. With ``ttl_hours`` a document not heard of for so long is forgotten; one read again then
    starts anew, from revision 1. Documents share a state with others of their bucket: many documents want more ``buckets``.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = events.select(
        "document_id", "event_id", "status", F.coalesce(F.unix_micros("ts"), F.lit(NEVER)).alias("at"),
        codes.is_terminal_status(F.col("status")).alias("final"),
    )
    ttl = None if ttl_hours is None else ttl_hours * 3_600_000
    told = _bucketed(timed, "document_id", buckets).transformWithStateInPandas(_Status(ttl), CURRENT, "append", "ProcessingTime" if ttl else "none")
    return told.select("document_id", "status", F.when(F.col("at") > NEVER, F.timestamp_micros("at")).alias("ts"), "revision")
