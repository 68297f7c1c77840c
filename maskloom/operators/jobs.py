"""Jobs as tables: keys, batches, slots, status, usage, call logs.

Per-job work is aggregation, so a job or account that holds much of the table is combined before
it travels; where rows must be numbered or listed, the group is bounded by a checked limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskloom import schemas as C
from maskloom.functions import codes, files
from maskloom.operators import ordered
from maskloom.session import kept


def check_batch(jobs: DataFrame, uploads: DataFrame) -> DataFrame:
    """Per job: file count, refused files, and ``code`` (no files, too many, else that of a refused file)."""
    check = files.file_check(F.col("filename"), F.col("content_type"), F.col("size"))
    counted = uploads.select("job_id", check["code"].alias("_code")).groupBy("job_id").agg(
        F.count(F.lit(1)).alias("files"), F.count("_code").alias("refused"), F.min("_code").alias("_code")
    )
    count = F.coalesce("files", F.lit(0))
    return jobs.select("job_id").join(counted, "job_id", "left").select(
        "job_id", count.alias("files"), F.coalesce("refused", F.lit(0)).alias("refused"),
        F.when((count == 0) | (count > C.MAX_FILES_PER_JOB), "invalid_request").otherwise(F.col("_code")).alias("code"),
    )


def match_slots(slots: DataFrame, uploads: DataFrame, width: int = ordered.WIDTH) -> DataFrame:
    """Upload slots (job_id, slot_no, document_id, filename) with the file (job_id, file_no, filename) for each.

    By name only, the k-th slot of a name to its k-th file; ``code`` is set where no file is left.
    """
    named = ordered.numbered(slots.where("filename IS NOT NULL"), ["job_id", "filename"], "slot_no", "_k", width)
    unnamed = slots.where("filename IS NULL").withColumn("_k", F.lit(None).cast("bigint"))
    numbered = ordered.numbered(
        uploads.where("filename IS NOT NULL").select("job_id", "filename", "file_no"), ["job_id", "filename"], "file_no", "_k", width
    )
    return named.unionByName(unnamed).join(numbered, ["job_id", "filename", "_k"], "left").select(
        *slots.columns, "file_no", F.when(F.col("file_no").isNull(), "error").alias("code"),
        F.col("file_no").isNull().alias("retryable"),
    )


def _sorted_list(name: str) -> Column:
    return F.coalesce(F.to_json(F.array_sort(F.col(name))), F.lit("null"))


def job_key(uploads: DataFrame, rules: DataFrame) -> DataFrame:
    """(job_id, job_key): equal for equal files and rules, in any order of files and list items.

    Omitted and empty lists differ; retention defaults to ephemeral; an explicit redact mode is no
    difference. Jobs over the file limit have a key too; refusing them is up to check_batch.
    """
    file_hash = F.sha2(F.concat(F.encode("filename", "UTF-8"), F.lit(b"\x00"), F.col("bytes"), F.lit(b"\x00")), 256)
    hashed = uploads.select("job_id", "filename", file_hash.alias("_hash"))
    per_job = hashed.groupBy("job_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("filename", "_hash"))), lambda f: f["_hash"]), "").alias("_files")
    )
    mode = F.when(F.coalesce("mode", F.lit("redact")) != "redact", F.col("mode")).otherwise("")
    text = F.concat_ws(
        "|", "_files", _sorted_list("pii_categories"), _sorted_list("pii_included_terms"),
        _sorted_list("pii_excluded_terms"), F.coalesce("retention", F.lit("ephemeral")), mode,
    )
    joined = per_job.join(rules, "job_id", "left")
    return joined.select("job_id", F.concat(F.lit("job-"), F.left(F.sha2(text, 256), F.lit(48))).alias("job_key"))


def dedupe_jobs(requests: DataFrame, hours: int = C.KEY_LIFETIME_HOURS) -> DataFrame:
    """Each request (request_id, job_key, ts, params) with the request it repeats.

    The first request of a key opens a job; repeats within ``hours`` join it, the next one opens
    another. ``billed`` marks the opener; ``conflict`` a repeat with other parameters. Requests
    without a key or time repeat nothing and are left out.
    """
    requests = requests.withColumn("ts", F.col("ts").cast("timestamp"))
    openers = _openers(requests.select("job_key", "ts"), hours)
    first = requests.join(openers, ["job_key", "ts"]).groupBy("job_key", F.col("ts").alias("opened_at")).agg(
        F.min_by(F.struct("request_id", "params"), "request_id").alias("_opener")
    )
    until = F.col("opened_at") + F.make_interval(hours=F.lit(hours))
    # Openers of a key are at least `hours` apart, so a request falls into one of two stretches.
    stretch = F.floor(F.unix_micros("ts") / F.lit(hours * 3_600_000_000))
    asked = requests.withColumn("_at", F.explode(F.array(stretch, stretch - 1)))
    opened = first.withColumn("_at", F.floor(F.unix_micros("opened_at") / F.lit(hours * 3_600_000_000)))
    joined = asked.join(opened, ["job_key", "_at"]).where((F.col("ts") >= F.col("opened_at")) & (F.col("ts") < until))
    is_opener = F.col("request_id") == F.col("_opener.request_id")
    return joined.select(
        *requests.columns, F.col("_opener.request_id").alias("job_request_id"), is_opener.alias("billed"),
        (~F.col("params").eqNullSafe(F.col("_opener.params"))).alias("conflict"),
    )


#: Buckets a key's lifetime is cut into, so that no task gets all requests of a key or of its day.
_BUCKETS = 64


def _next_times(times: DataFrame, hours: int) -> DataFrame:
    """(job_key, ts, next): for each time of a key the first one a lifetime or more after it, where there is one.

    Times and the times asked for meet in buckets; behind the last time of a bucket comes the first of the
    next bucket that has any, found among one row per bucket.
    """
    width = hours * 3_600_000_000 // _BUCKETS
    bucket = lambda at: F.floor(F.col(at) / F.lit(width))
    own = times.select("job_key", F.unix_micros("ts").alias("at"))
    asked = own.select("job_key", (F.col("at") + F.lit(hours * 3_600_000_000)).alias("at"), F.col("at").alias("from"))
    both = own.select("job_key", "at", F.lit(None).cast("bigint").alias("from")).unionByName(asked).withColumn("_bucket", bucket("at"))
    later = Window.partitionBy("job_key", "_bucket").orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = F.min(F.when(F.col("from").isNull(), F.col("at"))).over(later)
    met = both.withColumn("_inside", inside).where("from IS NOT NULL")
    # Both windows run from the latest time back: looking ahead row by row would read the rest of a bucket for each.
    # One row per bucket that holds times or is asked about, with the first time behind it.
    buckets = both.groupBy("job_key", "_bucket").agg(F.min(F.when(F.col("from").isNull(), F.col("at"))).alias("_first"))
    behind = Window.partitionBy("job_key").orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("_behind", F.min("_first").over(behind)).drop("_first")
    found = met.join(buckets, ["job_key", "_bucket"]).select(
        "job_key", F.timestamp_micros("from").alias("ts"), F.timestamp_micros(F.coalesce("_inside", "_behind")).alias("next")
    )
    return found.where("next IS NOT NULL")


def _openers(asked: DataFrame, hours: int) -> DataFrame:
    """(job_key, ts) of the requests that open a job, for keys of any number of requests.

    The openers of a key are its first time and what following the pointers of ``_next_times`` reaches from
    there. In each round all that is reached jumps ahead by as many openers as are reached, and jumps are
    put together two by two, so the rounds are as many as the number of openers of one key has binary digits.
    """
    times = kept(asked.where("job_key IS NOT NULL AND ts IS NOT NULL").distinct())
    jumps = kept(_next_times(times, hours))
    reached = kept(times.groupBy("job_key").agg(F.min("ts").alias("ts")))
    while not jumps.isEmpty():
        ahead = reached.join(jumps, ["job_key", "ts"]).select("job_key", F.col("next").alias("ts"))
        reached = kept(reached.unionByName(ahead))
        further = jumps.select("job_key", F.col("ts").alias("next"), F.col("next").alias("_further"))
        jumps = kept(jumps.join(further, ["job_key", "next"]).select("job_key", "ts", F.col("_further").alias("next")))
    return reached


def pack_jobs(uploads: DataFrame, keys: list[str], order: str, size: int = C.MAX_FILES_PER_JOB,
              width: int = ordered.WIDTH) -> DataFrame:
    """Adds ``job_no``: files of a request in order, at most ``size`` to a job."""
    numbered = ordered.numbered(uploads, keys, order, "_k", width)
    return numbered.withColumn("job_no", F.floor((F.col("_k") - 1) / size)).drop("_k")


def choose_upload_route(uploads: DataFrame) -> DataFrame:
    """Per job: direct upload if all files are PDFs and one is large, else multipart."""
    all_pdf = F.bool_and(F.coalesce(F.col("content_type") == files.TYPES["pdf"], F.lit(False)))
    large = F.bool_or(F.col("size") > C.DIRECT_UPLOAD_BYTES)
    return uploads.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("files"), F.when(all_pdf & large, "direct").otherwise("multipart").alias("route")
    )


def job_accepted(jobs: DataFrame, documents: DataFrame) -> DataFrame:
    """Jobs the server took no file of, as errors."""
    return jobs.join(documents.select("job_id").distinct(), "job_id", "left_anti").select(
        "job_id", F.lit("invalid_request").alias("code")
    )


def job_summary(jobs: DataFrame, documents: DataFrame) -> DataFrame:
    """One row per job: settings, documents by status, pages, is_final, next step."""
    counted = documents.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("documents"),
        *[F.count_if(F.col("status") == s).alias(s) for s in C.STATUSES],
        F.sum("page_count").alias("pages"),
        F.bool_and(codes.is_terminal_status(F.col("status"))).alias("_settled"),
    )
    final = F.coalesce("_settled", codes.is_terminal_status(F.col("job_status")))
    return jobs.select(
        "job_id", F.col("status").alias("job_status"), "retention", F.coalesce("mode", F.lit("redact")).alias("mode"), "created_at"
    ).join(counted, "job_id", "left").select(
        "job_id", "job_status", "retention", "mode", "created_at",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("documents", *C.STATUSES, "pages")],
        final.alias("is_final"),
        F.when(final, "download").otherwise("wait").alias("next_step"),
    )


def nest_documents(documents: DataFrame) -> DataFrame:
    """(job_id, documents): the snapshot form, with every document of a job."""
    document = F.struct("document_id", "file_name", "status", "page_count", "error_message")
    return documents.groupBy("job_id").agg(F.array_sort(F.collect_list(document)).alias("documents"))


def latest_status(events: DataFrame) -> DataFrame:
    """(document_id, status, ts): the last one known, where the first final status stays.

    Events of one time count in order of event_id.
    """
    order = F.struct("ts", "event_id")
    value = F.struct("status", "ts")
    final = codes.is_terminal_status(F.col("status"))
    return events.groupBy("document_id").agg(
        F.min_by(F.when(final, value), F.when(final, order)).alias("_final"),
        F.max_by(value, order).alias("_last"),
    ).select("document_id", F.coalesce("_final", "_last").alias("_s")).select("document_id", "_s.status", "_s.ts")


def job_watch(jobs: DataFrame, reads: DataFrame, budget: int = C.WAIT_BUDGET_SECONDS) -> DataFrame:
    """How watching each job (job_id, started_at) ended, by its log of status reads.

    Reads: (job_id, ts, read_no, ok, final, retryable, code, status). The first final status settles
    it and the first error that cannot pass ends it; otherwise, at the end of the budget, a failed
    latest read is an outage (an older status would be stale) and anything else still runs.
    """
    started = jobs.select("job_id", "started_at")
    columns = ["job_id", "ts", "read_no", "ok", "final", "retryable", "code", "status"]
    in_time = reads.select(*columns).join(started, "job_id").where(
        (F.col("ts") >= F.col("started_at"))
        & (F.col("ts") < F.col("started_at") + F.make_interval(secs=F.lit(budget)))
    )
    order = F.struct("ts", "read_no")
    ends = F.when(F.col("ok") & F.col("final"), "settled").when(~F.col("ok") & ~F.col("retryable"), "fatal")
    seen = in_time.groupBy("job_id").agg(
        F.min_by(F.when(ends.isNotNull(), F.struct(ends.alias("outcome"), "code", "status")),
                 F.when(ends.isNotNull(), order)).alias("_end"),
        F.max_by(F.struct("ok", "code"), order).alias("_latest"),
        F.max_by(F.when(F.col("ok"), F.col("status")), F.when(F.col("ok"), order)).alias("_status"),
        F.count(F.lit(1)).alias("reads"),
    )
    failed = F.coalesce(~F.col("_latest.ok"), F.lit(False))
    outcome = F.coalesce(F.col("_end.outcome"), F.when(failed, "outage").otherwise("running"))
    return started.join(seen, "job_id", "left").select(
        "job_id", outcome.alias("outcome"),
        F.when(outcome.isin("fatal", "outage"), F.coalesce("_end.code", "_latest.code"))
        .when(outcome == "running", "timeout").alias("code"),
        F.when(outcome == "settled", F.col("_end.status")).otherwise(F.col("_status")).alias("last_status"),
        F.coalesce("reads", F.lit(0)).alias("reads"),
    )


def page_usage(documents: DataFrame, accounts: DataFrame) -> DataFrame:
    """Per account (account_id, quota): pages, free pages, billed pages, pages left, out of quota.

    Documents: (account_id, document_id, created_at, page_count, replay). Repeats are not billed;
    an account's first document is free if it has at most 5 pages.
    """
    new = documents.where(~F.col("replay"))
    used = new.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("page_count").alias("pages"),
        F.min_by("page_count", F.struct("created_at", "document_id")).alias("_first"),
    )
    free = F.when(F.col("_first") <= C.FREE_PAGES, F.col("_first")).otherwise(0)
    joined = accounts.select("account_id", "quota").join(used, "account_id", "left")
    pages, freed = F.coalesce("pages", F.lit(0)), F.coalesce(free, F.lit(0))
    billed = pages - freed
    return joined.select(
        "account_id", F.coalesce("documents", F.lit(0)).alias("documents"), pages.cast("bigint").alias("pages"),
        freed.cast("bigint").alias("free_pages"), billed.cast("bigint").alias("billed_pages"),
        F.greatest(F.col("quota") - billed, F.lit(0)).cast("bigint").alias("pages_left"),
        (billed > F.col("quota")).alias("quota_exceeded"),
    )


def call_log_summary(log: DataFrame) -> DataFrame:
    """Per tool: calls, errors, exact duration percentiles, error codes seen.

    Durations are whole milliseconds, so what is counted and travels is each different one, not each call.
    """
    percentile = lambda share: F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY durationMs)").cast("bigint")
    return log.groupBy("tool").agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(F.col("outcome") == "error").alias("errors"),
        percentile(0.5).alias("p50_ms"),
        percentile(0.95).alias("p95_ms"),
        F.max("durationMs").alias("max_ms"),
        # There are 14 codes, so this set is small whatever the calls.
        F.array_sort(F.collect_set("code")).alias("codes"),
    )


def call_log_cube(log: DataFrame) -> DataFrame:
    """Calls and time by tool and outcome with all totals (NULL marks a total)."""
    return log.cube("tool", "outcome").agg(
        F.count(F.lit(1)).alias("calls"), F.sum("durationMs").alias("total_ms"), F.grouping_id().alias("level")
    )


def call_rates(log: DataFrame, length: str = "1 minute", slide: str | None = None) -> DataFrame:
    """Calls and errors per window and tool; the batch twin of the streaming rates."""
    return log.groupBy(F.window("ts", length, slide) if slide else F.window("ts", length), "tool").agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(F.col("outcome") == "error").alias("errors")
    ).select(F.col("window.start").alias("window_start"), "tool", "calls", "errors")


def mode_of_record(requests: DataFrame, jobs: DataFrame) -> DataFrame:
    """Adds ``mode_of_record``: what the job says was done, whatever the request asked for."""
    made = jobs.select("job_id", F.col("mode").alias("_mode"))
    return requests.join(made, "job_id", "left").select(
        *requests.columns, F.coalesce("_mode", F.lit("redact")).alias("mode_of_record")
    )


def stale_outputs(outputs: DataFrame, edits: DataFrame) -> DataFrame:
    """Outputs (document_id, produced_at) older than the last edit of their document."""
    last = edits.groupBy("document_id").agg(F.max("edited_at").alias("edited_at"))
    return outputs.join(last, "document_id").where(F.col("edited_at") > F.col("produced_at"))
