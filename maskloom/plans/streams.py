"""Streaming queries, run over all that is there and read back; each agrees with its batch twin."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.plans import names, work
from maskloom.plans import texts  # noqa: F401  (its queries come first)
from maskloom.plans.common import KEY_SQL, ORACLES, Tables, checked, hits_sql, query, rewritten_sql
from maskloom.session import checkpoint_dir
from maskloom.streaming import jobs as J
from maskloom.streaming import texts as X


def _stream(t: Tables, name: str) -> DataFrame:
    """A table as a stream, be it a file or a folder of them: a pattern may stand for either, a plain path for a folder only."""
    return X.read_text_stream(t.spark, f"{t.sf_dir}/{name}[.]parquet", getattr(t, name).schema, "*")


def _batches(t: Tables, name: str, part, count: int = 4) -> DataFrame:
    """A table as a stream of ``count`` micro-batches, by the number ``part`` gives each row."""
    table, place = getattr(t, name), f"{checkpoint_dir(t.spark)}/{name}-{uuid.uuid4().hex}"
    for n in range(count):
        table.where(part == n).repartition(1).write.mode("append").parquet(place)
    return X.read_text_stream(t.spark, place, table.schema, files_per_trigger=1)


@query(ORACLES["redact_documents"])
def stream_redact(t: Tables) -> DataFrame:
    """Documents redacted as they arrive."""
    docs = _stream(t, "documents").select("doc_id", "text")
    return X.run_available(X.stream_redact(docs), "redact")


# Ten documents as the turns of a conversation.
_TURNS = "SELECT CAST(floor(doc_id / 10) AS BIGINT) AS conv_id, doc_id % 10 AS turn, 'en' AS lang, text FROM documents"


@query(f"""WITH {hits_sql(_TURNS, 'conv_id, turn, lang')},
keyed AS (SELECT s.*, {KEY_SQL} AS key FROM spans AS s),
firsts AS (SELECT *, min(turn * 1000000 + first) OVER (PARTITION BY conv_id, category, key) AS seen FROM keyed),
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY conv_id, category ORDER BY seen) AS number FROM firsts),
tagged AS (SELECT *, CASE WHEN category IS NOT NULL THEN '[' || {names.LABEL_SQL} || ' ' || number || ']' END AS tag FROM ranked),
{rewritten_sql(_TURNS, 'tag', 'conv_id, turn, lang', 'tagged')} SELECT conv_id, turn, text FROM rewritten""")
def stream_tags(t: Tables) -> DataFrame:
    """Conversations tagged as their turns arrive; an entity keeps its tag."""
    turns = _stream(t, "documents").select(
        F.floor(F.col("doc_id") / 10).alias("conv_id"), (F.col("doc_id") % 10).alias("turn"), "text"
    )
    return X.run_available(X.stream_pseudonymize(turns), "tags")


@query("SELECT DISTINCT 'k' || CAST(user_id AS STRING) AS job_key FROM events")
def stream_dedupe(t: Tables) -> DataFrame:
    """The keys of the jobs that requests open as they arrive."""
    return X.run_available(X.stream_dedupe_jobs(_asked(t)).select("job_key"), "dedupe").distinct()


@query(f"SELECT request_id, job_key FROM ({ORACLES['dedupe_jobs']}) AS j WHERE billed")
def stream_openers(t: Tables) -> DataFrame:
    """Requests that open a job as they arrive: the billed ones of the batch query."""
    return X.run_available(X.stream_dedupe_jobs(_asked(t)).select("request_id", "job_key"), "openers")


def _asked(t: Tables) -> DataFrame:
    return _stream(t, "events").select(
        F.col("event_id").alias("request_id"), F.concat(F.lit("k"), "user_id").alias("job_key"), F.col("ts").cast("timestamp").alias("ts")
    )


def _reads(t: Tables, events: DataFrame | None = None) -> DataFrame:
    """The reads of the batch query on a stream; a watch starts at the day's first possible read."""
    return (_stream(t, "events") if events is None else events).withColumn("ts", F.col("ts").cast("timestamp")).select(
        F.concat_ws("/", F.col("user_id"), F.to_date("ts")).alias("job_id"), "ts", F.col("event_id").alias("read_no"),
        (F.col("event_type") != "error").alias("ok"), ((F.col("event_type") == "purchase") & (F.col("value") < 10)).alias("final"),
        (F.col("value") < 20).alias("retryable"),
        F.when(F.col("event_type") == "error", F.when(F.col("value") < 20, "rate_limited").otherwise("unauthorized")).alias("code"),
        F.when(F.col("event_type") != "error", F.when((F.col("event_type") == "purchase") & (F.col("value") < 10), "redacted").otherwise(F.col("event_type"))).alias("status"),
        F.date_trunc("day", "ts").alias("started_at"),
    )


# Only watches whose budget the watermark (last read less ten minutes) has passed are told, or that ended.
@query(f"""WITH r AS ({checked(work.READS)}), w AS (SELECT *, date_trunc('day', ts) AS started_at FROM r),
t AS (SELECT *, CASE WHEN ok AND final THEN 'settled' WHEN NOT ok AND NOT retryable THEN 'fatal' END AS ending FROM w),
i AS (SELECT * FROM t WHERE ts < started_at + INTERVAL 12 HOUR),
g AS (SELECT job_id, first(ending ORDER BY ts, read_no) FILTER (ending IS NOT NULL) AS ending, first(code ORDER BY ts, read_no) FILTER (ending IS NOT NULL) AS end_code,
  last(ok ORDER BY ts, read_no) AS last_ok, last(code ORDER BY ts, read_no) AS last_code FROM i GROUP BY job_id),
j AS (SELECT job_id, min(started_at) + INTERVAL 12 HOUR AS deadline FROM w GROUP BY job_id)
SELECT job_id, coalesce(ending, CASE WHEN last_ok IS NULL OR last_ok THEN 'running' ELSE 'outage' END) AS outcome,
  CASE WHEN ending = 'settled' THEN NULL WHEN ending = 'fatal' THEN end_code WHEN last_ok IS NULL OR last_ok THEN 'timeout' ELSE last_code END AS code
FROM j LEFT JOIN g USING (job_id) WHERE ending IS NOT NULL OR deadline <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM w)""")
def stream_job_watch(t: Tables) -> DataFrame:
    """How watches ended, told as they end or as their budget passes."""
    return X.run_available(J.stream_job_watch(_reads(t), budget=12 * 3600), "watch").select("job_id", "outcome", "code")


@query(f"""WITH r AS ({checked(work.READS)}), w AS (SELECT *, date_trunc('day', ts) AS started_at FROM r),
t AS (SELECT *, CASE WHEN ok AND final THEN 'settled' WHEN NOT ok AND NOT retryable THEN 'fatal' END AS ending FROM w WHERE ts < started_at + INTERVAL 12 HOUR),
g AS (SELECT job_id, first(ending ORDER BY ts, read_no) FILTER (ending IS NOT NULL) AS ending, first(code ORDER BY ts, read_no) FILTER (ending IS NOT NULL) AS end_code,
  first(status ORDER BY ts, read_no) FILTER (ending IS NOT NULL) AS end_status, last(ok ORDER BY ts, read_no) AS last_ok, last(code ORDER BY ts, read_no) AS last_code,
  last(status ORDER BY ts, read_no) FILTER (ok) AS last_status, count(*) AS reads FROM t GROUP BY job_id),
j AS (SELECT job_id, min(started_at) + INTERVAL 12 HOUR AS deadline FROM w GROUP BY job_id)
SELECT job_id, coalesce(ending, CASE WHEN coalesce(last_ok, true) THEN 'running' ELSE 'outage' END) AS outcome,
  CASE WHEN ending = 'settled' THEN NULL WHEN ending = 'fatal' THEN end_code WHEN coalesce(last_ok, true) THEN 'timeout' ELSE last_code END AS code,
  CASE WHEN ending = 'settled' THEN end_status ELSE last_status END AS last_status, coalesce(reads, 0) AS reads
FROM j LEFT JOIN g USING (job_id) WHERE deadline <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM w)""")
def stream_job_watch_all(t: Tables) -> DataFrame:
    """How watches ended, told at the end of their budget over several micro-batches: the batch operator on all columns."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    first, last = t.events.agg(F.min(seconds), F.max(seconds)).first()
    part = F.floor((seconds - F.lit(first or 0)) * 4 / F.lit((last or 0) - (first or 0) + 1))
    return X.run_available(J.stream_job_watch(_reads(t, _batches(t, "events", part)), budget=12 * 3600, tell="budget"), "watch-all")


def _calls(t: Tables) -> DataFrame:
    return _stream(t, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.split_part(F.lit("redact,status,download,restore,preview"), F.lit(","), (F.col("user_id") % 5).cast("int") + 1).alias("tool"),
        F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("outcome"),
    )


@query(f"""WITH c AS ({checked(work.CALLS)})
SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS window_start, epoch_us(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR) AS window_end, tool, count(*) AS calls, CAST(count_if(outcome = 'error') AS BIGINT) AS errors
FROM c WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM c) GROUP BY ALL""")
def stream_call_rates(t: Tables) -> DataFrame:
    """Calls per hour and tool, each hour told once the watermark has passed it."""
    return X.run_available(J.stream_call_rates(_calls(t), "1 hour"), "rates")


@query(f"""WITH c AS ({checked(work.CALLS)}), s AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) - k * INTERVAL 30 MINUTE + INTERVAL 30 MINUTE AS ws, ts, tool, outcome FROM c, (SELECT unnest([0, 1, 2]) AS k) AS ks)
SELECT epoch_us(ws) AS window_start, epoch_us(ws + INTERVAL 1 HOUR) AS window_end, tool, count(*) AS calls, CAST(count_if(outcome = 'error') AS BIGINT) AS errors
FROM s WHERE ws <= ts AND ts < ws + INTERVAL 1 HOUR AND ws + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM c) GROUP BY ALL""")
def stream_sliding_rates(t: Tables) -> DataFrame:
    """The same for an hour, every half hour."""
    return X.run_available(J.stream_call_rates(_calls(t), "1 hour", "30 minutes"), "sliding")


@query(f"""WITH c AS ({checked(work.CALLS)}), b AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY tool ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM c),
g AS (SELECT *, sum(new) OVER (PARTITION BY tool ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM b)
SELECT epoch_us(min(ts)) AS window_start, epoch_us(max(ts) + INTERVAL 30 MINUTE) AS window_end, tool, count(*) AS calls, CAST(count_if(outcome = 'error') AS BIGINT) AS errors
FROM g GROUP BY tool, n HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM c)""")
def stream_call_sessions(t: Tables) -> DataFrame:
    """Bursts of calls of a tool, half an hour apart."""
    return X.run_available(J.stream_call_sessions(_calls(t), "30 minutes"), "sessions")


@query(f"""WITH e AS ({checked(work._STATUS_EVENTS)}), d AS (SELECT *, date_trunc('day', ts) AS day FROM e),
r AS (SELECT *, row_number() OVER (PARTITION BY day, document_id ORDER BY status NOT IN ('redacted', 'error'),
  CASE WHEN status IN ('redacted', 'error') THEN epoch_us(ts) ELSE -epoch_us(ts) END, CASE WHEN status IN ('redacted', 'error') THEN event_id ELSE -event_id END) AS n FROM d)
SELECT epoch_us(day) AS window_start, document_id, status FROM r WHERE n = 1 AND day + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM e)""")
def stream_latest_status(t: Tables) -> DataFrame:
    """Last status per document and day, told once the day is closed."""
    return X.run_available(J.stream_latest_status(_statuses(_stream(t, "events"))), "status")


@query(ORACLES["latest_status"])
def stream_status(t: Tables) -> DataFrame:
    """Last status of each document, over micro-batches that come in no order of time: the batch operator's."""
    events = _batches(t, "events", F.col("event_id") * 7 % 4)
    told = X.run_available(J.stream_status(_statuses(events), ttl_hours=24 * 90), "statuses", idle=False)
    last = F.max_by(F.struct("status", "ts"), "revision")
    return told.groupBy("document_id").agg(last.alias("_last")).select("document_id", "_last.status", "_last.ts")


def _statuses(events: DataFrame) -> DataFrame:
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    status = F.expr(
        "CASE WHEN event_type = 'purchase' AND value < 3 THEN 'redacted' WHEN event_type = 'error' AND value < 2 THEN 'error' "
        "WHEN event_type = 'click' THEN 'redacting' WHEN event_type = 'view' THEN 'analyzing' ELSE 'uploaded' END"
    )
    return events.select(
        "event_id", F.concat(F.lit("d"), F.col("user_id") * 7 + F.col("event_id") % 7).alias("document_id"), "ts", status.alias("status")
    )
