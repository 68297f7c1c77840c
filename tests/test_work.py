"""Jobs, files, addresses, streams: fixtures, busy keys, and streams against their batch twins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from maskloom.functions import codes, files, net
from maskloom.operators import jobs as J
from maskloom.operators import urls as U
from maskloom.sources import documents as D
from maskloom.sources import jobs as SJ
from maskloom.sources import outputs
from maskloom.streaming import jobs as XJ
from maskloom.streaming import texts as XT

T0 = dt.datetime(2024, 1, 1)


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first().r


PUBLIC = ["93.184.216.34", "8.8.8.8", "172.32.0.1", "192.0.1.1", "2606:2800:220:1:248:1893:25c8:1946", "::ffff:8.8.8.8", "64:ff9b::8.8.8.8", "2002:808:808::", "::ffff:808:808"]
NOT_PUBLIC = [
    "0.0.0.0", "10.0.0.1", "100.64.0.1", "127.0.0.1", "169.254.169.254", "172.16.0.1", "192.0.0.1", "192.0.2.1", "192.88.99.1", "192.168.1.1",
    "198.18.0.1", "224.0.0.1", "255.255.255.255", "::", "::1", "::ffff:127.0.0.1", "::ffff:7f00:1", "::ffff:0:10.0.0.1", "::127.0.0.1",
    "64:ff9b::10.0.0.1", "64:ff9b:1::8.8.8.8", "2002:7f00:1::", "2001:0:1::", "fe80::1%eth0", "fec0::1", "FD00::1", "ff02::1",
    "1.2.3", "1.2.3.4.5", "01.2.3.4", "256.1.1.1", ":::", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1::2::3", "1::2:3:4:5:6:7:8", "host", "", None,
]


def test_addresses(spark):
    df = spark.createDataFrame([(a, a in PUBLIC) for a in PUBLIC + NOT_PUBLIC], "a string, public boolean")
    wrong = df.where(net.is_public_address(F.col("a")) != F.col("public")).collect()
    assert wrong == []


@pytest.mark.parametrize("url, host, shown", [
    ("https://User:pw@Example.com:8443/a/b?token=1#f", "example.com", "https://example.com:8443/a/b"),
    ("HTTP://2130706433/", "127.0.0.1", "http://127.0.0.1/"),
    ("http://0x7f.1:80", "127.0.0.1", "http://127.0.0.1/"),
    ("http://[::1]/x", "::1", "http://[::1]/x"),
    ("https://1.example.com?x", "1.example.com", "https://1.example.com/"),
])
def test_url_parts(spark, url, host, shown):
    assert (one(spark, net.host, url), one(spark, net.strip_url, url)) == (host, shown)


def test_host_with_one_private_address_is_refused(spark):
    resolved = spark.createDataFrame([("a.com", "8.8.8.8"), ("a.com", "10.0.0.1"), ("B.com", "8.8.8.8")], "host string, address string")
    urls = spark.createDataFrame([("http://a.com/",), ("http://b.com/",), ("http://none.com/",), ("file:///etc/passwd",), ("http://169.254.169.254/",)], "url string")
    got = {r.url: r.refused for r in U.refuse_private_urls(urls, resolved).collect()}
    assert list(got.values()).count(None) == 1 and got["http://b.com/"] is None and got["file:///etc/passwd"] == "unsupported_scheme"


@pytest.mark.parametrize("name, kind", [("a.PDF", "application/pdf"), ("x/b.jpeg", "image/jpeg"), ("a.docx", None), ("noextension", None), (".pdf", None), ("a.b.png", "image/png")])
def test_types(spark, name, kind):
    assert one(spark, files.supported_type, name) == kind


def test_limits_and_messages(spark):
    mb = 1024 * 1024
    df = spark.createDataFrame(
        [("a.pdf", 51 * mb), ("a.png", 11 * mb), ("a.pdf", 0), ("a.pdf", 50 * mb), ("a.gif", 5)], "filename string, size bigint"
    ).withColumn("content_type", files.supported_type(F.col("filename")))
    got = [(r.ok, r.code, r.message) for r in D.check_limits(df).collect()]
    assert got == [
        (False, "payload_too_large", "file a.pdf has 51.0 MB of 50 allowed in a PDF"),
        (False, "payload_too_large", "file a.png has 11.0 MB of 10 allowed in an image"),
        (False, "invalid_request", "file a.pdf holds no bytes"), (True, None, None), (False, "invalid_request", "no type is known for file a.gif"),
    ]


@pytest.mark.parametrize("value, data", [("QUJD", b"ABC"), ("QU\n J D", b"ABC"), ("QUI=", b"AB"), ("QU_-", None), ("A!QID===", None), ("QUJ", None), ("  ", None)])
def test_base64(spark, value, data):
    got = one(spark, files.decode_base64, value)
    assert (bytes(got) if got is not None else None) == data


def test_text_size_counts_bytes(spark):
    df = spark.createDataFrame([("d", "## Page 1\n\nRené\n")], "doc_id string, text string")
    assert outputs.route_document_text(df, max_inline=17).first().inline and not outputs.route_document_text(df, max_inline=16).first().inline


def test_outputs_are_never_overwritten(spark, tmp_path):
    df = spark.range(3)
    outputs.write_outputs(df, str(tmp_path / "o"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        outputs.write_outputs(df, str(tmp_path / "o"))


def test_files_and_job_snapshots_are_read(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_bytes(b"x" * 10)
    (tmp_path / "in" / "b.txt").write_bytes(b"abc")
    (tmp_path / "in" / "c.pdf").write_bytes(b"")
    got = {(r.filename, r.content_type, r.size) for r in D.read_files(spark, str(tmp_path / "in")).collect()}
    # Spark's file listing leaves empty files out.
    assert got == {("a.pdf", "application/pdf", 10), ("b.txt", None, 3)}
    (tmp_path / "jobs.json").write_text(
        '{"job_id":"j1","status":"redacted","created_at":"2024-01-01T00:00:00Z","documents":[{"id":"d1","status":"redacted","page_count":2}]}\n'
        '{"job_id":"j2","status":"error","mode":"pseudonymize","documents":[]}\n'
    )
    rows = {r.job_id: r for r in SJ.flatten_jobs(SJ.read_job_snapshots(spark, str(tmp_path / "jobs.json"))).collect()}
    assert (rows["j1"].mode, rows["j1"].page_count, rows["j2"].mode, rows["j2"].document_id) == ("redact", 2, "pseudonymize", None)


def test_call_log_round_trip(spark, tmp_path):
    from maskloom.schemas import CALL_LOG

    log = spark.createDataFrame([(T0, "engine", "redact", "ok", 12, None, None, None, None, "r")], CALL_LOG)
    SJ.write_call_log(log, str(tmp_path / "log"))
    assert "null" not in spark.read.text(str(tmp_path / "log")).first().value
    assert SJ.read_call_log(spark, str(tmp_path / "log")).first() == log.first()


@pytest.mark.parametrize("status, documents, final", [
    ("analyzing", ["redacted", "analyzing"], False), ("analyzing", ["redacted", "error"], True), ("analyzing", [], False), ("error", [], True), ("x", ["uploading"], False),
])
def test_terminal(spark, status, documents, final):
    df = spark.createDataFrame([(status, [(s,) for s in documents])], "status string, documents array<struct<status:string>>")
    assert df.select(codes.is_terminal(F.col("status"), F.col("documents"))).first()[0] is final


def test_job_keys(spark):
    base = dict(files=[("a", b"1"), ("b", b"2")], pii_categories=["Email", "Date"], pii_included_terms=None, retention=None, mode=None)
    jobs = {
        "same": {}, "order": {"files": base["files"][::-1], "pii_categories": ["Date", "Email"]}, "defaults": {"retention": "ephemeral", "mode": "redact"},
        "bytes": {"files": [("a", b"1"), ("b", b"3")]}, "empty": {"pii_included_terms": []}, "mode": {"mode": "pseudonymize"},
        "retention": {"retention": "studio"}, "categories": {"pii_categories": ["Email"]},
    }
    made = {k: {**base, **v} for k, v in jobs.items()}
    uploads = spark.createDataFrame([(k, n, bytearray(b)) for k, v in made.items() for n, b in v["files"]], "job_id string, filename string, bytes binary")
    rules = spark.createDataFrame(
        [(k, v["pii_categories"], v["pii_included_terms"], None, v["retention"], v["mode"]) for k, v in made.items()],
        "job_id string, pii_categories array<string>, pii_included_terms array<string>, pii_excluded_terms array<string>, retention string, mode string",
    )
    keys = {r.job_id: r.job_key for r in J.job_key(uploads, rules).collect()}
    assert keys["same"] == keys["order"] == keys["defaults"]
    assert len({keys[k] for k in ("same", "bytes", "empty", "mode", "retention", "categories")}) == 6


def test_slots_take_each_file_once(spark):
    slots = spark.createDataFrame([("j", 1, "d1", "a"), ("j", 2, "d2", "a"), ("j", 3, "d3", "a"), ("j", 4, "d4", None), ("j", 5, "d5", "z")], "job_id string, slot_no bigint, document_id string, filename string")
    uploads = spark.createDataFrame([("j", 1, "a"), ("j", 2, "b"), ("j", 3, "a")], "job_id string, file_no bigint, filename string")
    for width in (1, 1000):
        got = {r.document_id: (r.file_no, r.code) for r in J.match_slots(slots, uploads, width).collect()}
        assert got == {"d1": (1, None), "d2": (3, None), "d3": (None, "error"), "d4": (None, "error"), "d5": (None, "error")}


def test_busy_keys_are_deduped_like_calm_ones(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("event_id").alias("request_id"), F.when(F.col("user_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("user_id"))).alias("job_key"),
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("params"),
    )
    calm = J.dedupe_jobs(events)
    expected = {}
    for key, rows in __import__("itertools").groupby(sorted(events.collect(), key=lambda r: (r.job_key, r.ts, r.request_id)), key=lambda r: r.job_key):
        opener = None
        for r in rows:
            if opener is None or r.ts >= opener.ts + dt.timedelta(hours=24):
                opener = r
            expected[r.request_id] = (opener.request_id, r.request_id == opener.request_id, r.params != opener.params)
    assert {r.request_id: (r.job_request_id, r.billed, r.conflict) for r in calm.collect()} == expected


def test_one_key_of_most_requests(spark):
    """200,000 requests of one key over 230 days, among others: each finds its opener."""
    rows = spark.range(200_000).select(
        F.col("id").alias("request_id"), F.when(F.col("id") % 40 == 0, F.concat(F.lit("k"), F.col("id") % 1000)).otherwise("hot").alias("job_key"),
        F.timestamp_seconds(F.col("id") * 100 + F.col("id") * 7919 % 97).alias("ts"), F.lit("p").alias("params"),
    )
    expected, opener = {}, {}
    for r in sorted(rows.collect(), key=lambda r: (r.ts, r.request_id)):
        if r.job_key not in opener or r.ts >= opener[r.job_key][0] + dt.timedelta(hours=24):
            opener[r.job_key] = (r.ts, r.request_id)
        expected[r.request_id] = opener[r.job_key][1]
    assert len(set(expected.values())) > 2000
    assert {r.request_id: r.job_request_id for r in J.dedupe_jobs(rows).collect()} == expected


def test_packs_hold_at_most_their_size(spark):
    df = spark.range(1050).select(F.lit("r").alias("request"), F.col("id").alias("file_no"))
    for width in (10, 10_000):
        got = J.pack_jobs(df, ["request"], "file_no", width=width).groupBy("job_no").count().orderBy("job_no").collect()
        assert [r["count"] for r in got] == [100] * 10 + [50]


READS = [
    ("a", 0, 0, True, True, False, None, "redacted"), ("a", 5, 1, False, False, False, "x", None),
    ("b", 3, 0, True, False, False, None, "analyzing"), ("b", 9, 1, False, False, True, "rate_limited", None),
    ("c", 1, 0, True, False, False, None, "analyzing"), ("c", 2, 1, False, False, False, "unauthorized", None),
    ("d", 1, 0, True, False, False, None, "redacting"), ("d", 400, 1, True, True, False, None, "redacted"),
]
READ = "job_id string, ts timestamp, read_no int, ok boolean, final boolean, retryable boolean, code string, status string, started_at timestamp"


def reads(spark, rows):
    return spark.createDataFrame([(j, T0 + dt.timedelta(seconds=s), n, ok, f, r, c, st, T0) for j, s, n, ok, f, r, c, st in rows], READ)


def test_watch_in_batch_and_stream(spark, tmp_path):
    expected = {("a", "settled", None, "redacted"), ("b", "outage", "rate_limited", "analyzing"), ("c", "fatal", "unauthorized", "analyzing"), ("d", "running", "timeout", "redacting")}
    batch = reads(spark, READS)
    started = batch.groupBy("job_id").agg(F.min("started_at").alias("started_at"))
    assert {tuple(r)[:4] for r in J.job_watch(started, batch).collect()} == expected
    folder = str(tmp_path / "in")
    # A much later read of another job lets the watermark pass the budgets.
    batch.unionByName(reads(spark, [("late", 100_000, 9, True, True, False, None, "redacted")])).coalesce(1).write.parquet(folder)
    out = XT.run_available(XJ.stream_job_watch(XT.read_text_stream(spark, folder, batch.schema)), "watch")
    assert {tuple(r)[:4] for r in out.where("job_id <> 'late'").collect()} == expected


def test_tags_last_over_batches(spark, tmp_path):
    import time

    folder = str(tmp_path / "in")
    turns = [(1, 0, "a@x.co wrote to b@x.co"), (2, 0, "b@x.co"), (1, 1, "b@x.co answered A@x.co, c@x.co")]
    for n, part in enumerate((turns[:2], turns[2:])):
        spark.createDataFrame(part, "conv_id bigint, turn bigint, text string").coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1 - n)
    stream = XT.read_text_stream(spark, folder, "conv_id bigint, turn bigint, text string", files_per_trigger=1)
    out = {(r.conv_id, r.turn): r.text for r in XT.run_available(XT.stream_pseudonymize(stream), "tags").collect()}
    assert out == {(1, 0): "[Email 1] wrote to [Email 2]", (2, 0): "[Email 1]", (1, 1): "[Email 2] answered [Email 1], [Email 3]"}
    batch = XT.pseudonymize_turns(spark.createDataFrame(turns, "conv_id bigint, turn bigint, text string"))
    assert {(r.conv_id, r.turn): r.text for r in batch.collect()} == out


def test_stale_read_does_not_win(spark):
    events = spark.createDataFrame(
        [(1, "d", T0, "redacting"), (2, "d", T0 - dt.timedelta(hours=1), "analyzing"), (3, "e", T0, "redacted"), (4, "e", T0 + dt.timedelta(hours=1), "analyzing")],
        "event_id bigint, document_id string, ts timestamp, status string",
    )
    assert {r.document_id: r.status for r in J.latest_status(events).collect()} == {"d": "redacting", "e": "redacted"}


def test_stream_openers_over_micro_batches(spark, tmp_path):
    at = lambda h: T0 + dt.timedelta(hours=h)
    parts = [
        [(1, "a", at(0)), (2, "a", at(23)), (4, "a", at(24)), (3, "a", at(24)), (5, "b", at(5)), (2 ** 60 + 1, None, at(1))],
        [(6, "a", at(47)), (7, "a", at(60)), (8, "b", at(40)), (9, "c", at(60))],
        [(10, "a", at(70)), (11, "a", at(84)), (12, "b", at(100)), (13, "c", at(83)), (14, "c", at(84)), (15, "a", None)],
    ]
    schema = "request_id bigint, job_key string, ts timestamp, params string"
    for n, rows in enumerate(parts):
        spark.createDataFrame([(*r, "p") for r in rows], schema).coalesce(1).write.parquet(str(tmp_path / f"in/part={n}"))
    stream = XT.read_text_stream(spark, str(tmp_path / "in/part=*"), schema, files_per_trigger=1)
    got = XT.run_available(XT.stream_dedupe_jobs(stream), "openers").collect()
    rows = spark.createDataFrame([(*r, "p") for rows in parts for r in rows], schema)
    want = J.dedupe_jobs(rows.where("job_key is not null")).where("billed").select("request_id", "job_key", "ts", "params").collect()
    assert sorted(r for r in got if r.job_key) == sorted(want)
    assert sorted(r.request_id for r in got) == [1, 3, 5, 7, 8, 9, 11, 12, 14, 2 ** 60 + 1]


@pytest.mark.parametrize("url, shown", [
    ("  HTTP://EXAMPLE.com:80/%2e/a/../b?x#y ", "http://example.com/b"), ("https://a.b/..", "https://a.b/"), ("https://a.b/c/.", "https://a.b/c/"),
    ("http://0300.0250.1/", "http://192.168.0.1/"), ("http://[1:0:0:2:0:0:0:3]/", "http://[1:0:0:2::3]/"), ("http://[::]:080", "http://[::]/"),
    ("http://a%62c.com", "http://abc.com/"), ("http://1.2.3.256/", None), ("http://a b.com/", None), ("http://x:99999/", None), ("http://x:9a/", None),
    ("https:\\\\h\\p", "https://h/p"), ("", None), ("no url", None), ("ftp://u:p@h:21/f", "ftp://h/f"), ("http://h?q", "http://h/"), (None, None),
])
def test_urls_have_one_form(spark, url, shown):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(net.strip_url(F.col("u"))).first()[0] == shown


@pytest.mark.parametrize("target, expected", [
    ("../x", "https://h.org/x"), ("x?y#z", "https://h.org/a/x?y#z"), ("//O.org/./p", "https://o.org/p"), ("/p/../q", "https://h.org/q"), ("?n", "https://h.org/a/b?n"),
    ("#f", "https://h.org/a/b?q#f"), ("HTTP://I:80", "http://i/"), ("mailto:x", None), ("", "https://h.org/a/b?q"), (None, None), ("http://1.2.3.4.5/", None),
])
def test_redirect_targets(spark, target, expected):
    df = spark.createDataFrame([("https://H.org:443/a/b?q", target)], "b string, t string")
    assert df.select(net.join_url(F.col("b"), F.col("t"))).first()[0] == expected


def test_percentiles_of_many_calls_are_exact(spark):
    """A million different durations of one tool: more than an approximate percentile tells apart."""
    log = spark.range(1_000_003).select(
        F.lit("t").alias("tool"), F.lit("ok").alias("outcome"), (F.col("id") * 7919 % 1_000_003).alias("durationMs"), F.lit(None).cast("string").alias("code"),
    )
    assert J.call_log_summary(log).select("p50_ms", "p95_ms", "max_ms").first()[:] == (500_001, 950_002, 1_000_002)


def test_limits_of_odd_files(spark):
    """Halves of a tenth of a megabyte, an unknown size, no name."""
    mb = 1024 * 1024
    files_ = [("a.pdf", 52 * mb + mb // 4), ("b.pdf", 52 * mb + 3 * mb // 4), ("c.pdf", None), (None, 0), ("d.pdf", 1)]
    df = spark.createDataFrame(files_, "filename string, size bigint").withColumn("content_type", files.supported_type(F.col("filename")))
    assert [(r.ok, r.code, r.message) for r in D.check_limits(df).collect()] == [
        (False, "payload_too_large", "file a.pdf has 52.2 MB of 50 allowed in a PDF"), (False, "payload_too_large", "file b.pdf has 52.8 MB of 50 allowed in a PDF"),
        (None, None, None), (False, "invalid_request", None), (True, None, None),
    ]


@pytest.mark.parametrize("name", ["stream_redact", "stream_tags"])
def test_streams_read_tables_of_several_files(spark, tmp_path, name):
    from maskloom.plans import catalogue

    documents = spark.createDataFrame([(i, f"a{i % 3}@x.co", "en", "s", 7) for i in range(40)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    documents.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    assert catalogue.QUERIES[name](spark, str(tmp_path)).count() == 40


@pytest.mark.parametrize("tell", ["end", "budget"])
def test_watches_of_one_bucket_over_micro_batches(spark, tmp_path, tell):
    """Thousands of watches in few states: due at different times, read on late, told once; like the batch operator."""
    rows = spark.range(6000).select(
        F.concat(F.lit("j"), F.col("id") % 3000).alias("job_id"), F.timestamp_seconds(1_704_067_200 + F.col("id") % 3000 + F.floor(F.col("id") / 3000) * 400).alias("ts"),
        F.col("id").cast("int").alias("read_no"), (F.col("id") % 5 != 0).alias("ok"), (F.col("id") % 7 == 0).alias("final"), (F.col("id") % 3 == 0).alias("retryable"),
        F.when(F.col("id") % 5 == 0, "x").alias("code"), F.when(F.col("id") % 5 != 0, "s").alias("status"), F.timestamp_seconds(1_704_067_200 + F.col("id") % 3000).alias("started_at"),
    )
    last = reads(spark, [("late", 100_000, 9, True, True, False, None, "redacted")])
    for n, part in enumerate((rows.where("read_no < 3000"), rows.where("read_no >= 3000"), last)):
        part.coalesce(1).write.parquet(str(tmp_path / f"in/part={n}"))
    stream = XT.read_text_stream(spark, str(tmp_path / "in/part=*"), rows.schema, files_per_trigger=1)
    out = XT.run_available(XJ.stream_job_watch(stream, budget=500, tell=tell, buckets=2), "watches")
    columns = ["job_id", "outcome", "code", "last_status", "reads"] if tell == "budget" else ["job_id", "outcome", "code"]
    want = J.job_watch(rows.groupBy("job_id").agg(F.min("started_at").alias("started_at")), rows, budget=500)
    assert sorted(map(repr, out.where("job_id <> 'late'").select(columns).collect())) == sorted(map(repr, want.select(columns).collect()))


def test_documents_of_one_bucket_over_micro_batches(spark, tmp_path):
    rows = spark.range(9000).select(
        F.concat(F.lit("d"), F.col("id") % 1500).alias("document_id"), F.col("id").alias("event_id"),
        F.when(F.col("id") % 1500 > 0, F.timestamp_seconds(F.col("id") * 7919 % 9001)).alias("ts"),
        F.when(F.col("id") % 11 == 0, "redacted").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("status"),
    )
    for n in range(3):
        rows.where(F.col("event_id") % 7 % 3 == n).coalesce(1).write.parquet(str(tmp_path / f"in/part={n}"))
    stream = XT.read_text_stream(spark, str(tmp_path / "in/part=*"), rows.schema, files_per_trigger=1)
    told = XT.run_available(XJ.stream_status(stream, buckets=2), "statuses", idle=False).collect()
    last = {}
    for r in sorted(told, key=lambda r: r.revision):
        assert r.revision == last.get(r.document_id, (None, None, 0))[2] + 1
        last[r.document_id] = (r.status, r.ts, r.revision)
    assert {d: v[:2] for d, v in last.items()} == {r.document_id: (r.status, r.ts) for r in J.latest_status(rows).collect()}
