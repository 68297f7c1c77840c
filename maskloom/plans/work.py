"""Queries over jobs, files, rules, status events, usage and call logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom import schemas as C
from maskloom.functions import codes
from maskloom.operators import jobs as J
from maskloom.operators import rules as R
from maskloom.plans.common import Tables, checked, query
from maskloom.sources import jobs as S

# ---- Inputs: an order is a job, its lines are documents (jobs of customers have none), an event is a read, a call or a request -----

JOBS = """SELECT 'j' || CAST(o_orderkey AS STRING) AS job_id, o_custkey AS account_id,
  CASE o_orderstatus WHEN 'F' THEN 'redacted' WHEN 'O' THEN 'analyzing' ELSE 'error' END AS status,
  CASE WHEN o_orderpriority LIKE '1%' THEN 'studio' ELSE 'ephemeral' END AS retention,
  CASE o_orderkey % 3 WHEN 0 THEN 'pseudonymize' WHEN 1 THEN 'redact' END AS mode, o_orderdate AS created_at FROM {orders}
UNION ALL SELECT 'e' || CAST(c_custkey AS STRING), c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'redacted' WHEN 1 THEN 'analyzing' ELSE 'error' END,
  CASE c_custkey % 4 WHEN 0 THEN 'studio' ELSE 'ephemeral' END, CAST(NULL AS STRING), CAST('1998-05-25' AS DATE) FROM {customer}"""
# Every line is a row of its own: lines of one order with the same number are told apart by all their columns.
LINES = """(SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
    l_returnflag, l_linestatus, l_shipdate) AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus, l_shipdate
  FROM {lineitem}) AS lines"""
DOCUMENTS = f"""SELECT 'j' || CAST(l_orderkey AS STRING) AS job_id, 'd' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS document_id,
  'f' || CAST(l_partkey % 3 AS STRING) || '.pdf' AS file_name,
  CASE WHEN l_returnflag = 'R' THEN 'error' WHEN l_returnflag = 'A' THEN 'redacted' WHEN l_linestatus = 'O' THEN 'analyzing' ELSE 'redacting' END AS status,
  CAST(l_quantity AS INT) AS page_count,
  CASE l_partkey % 4 WHEN 0 THEN 'The Upload was not completed.' WHEN 1 THEN 'PDF is password protected' WHEN 2 THEN 'File exceeds the maximum allowed size' END AS error_message
FROM {LINES}"""
UPLOADS = f"""SELECT 'j' || CAST(l_orderkey AS STRING) AS job_id, CAST(l_linenumber AS BIGINT) AS file_no,
  'f' || CAST(l_partkey % 3 AS STRING) || CASE l_returnflag WHEN 'R' THEN '.png' WHEN 'A' THEN '.pdf' ELSE '.PDF' END AS filename,
  CASE l_returnflag WHEN 'R' THEN 'image/png' ELSE 'application/pdf' END AS content_type,
  CASE WHEN l_partkey % 50 = 0 THEN 0 ELSE CAST(l_extendedprice * 300 AS BIGINT) END AS size
FROM {LINES}"""

_J, _D, _U = checked(JOBS), checked(DOCUMENTS), checked(UPLOADS)

# ---- Rules --------------------------------------------------------------------------------------

_ARRAY = {"spark": "array", "check": "list_value"}
REQUESTS = """SELECT CAST(c_custkey AS STRING) AS request_id, c_nationkey AS account_id,
  CASE c_custkey % 6 WHEN 0 THEN {array}('Email', ' ', 'Person') WHEN 1 THEN {array}('  ', CAST(NULL AS STRING)) WHEN 2 THEN {array}('SocialSecurity')
    WHEN 3 THEN {array}('Person', 'Email', 'PhoneNumber', 'Address', 'Organization', 'Date', 'IBAN', 'CreditCard', 'Email') END AS pii_categories,
  CASE c_custkey % 5 WHEN 0 THEN {array}('Project ' || c_mktsegment, '   ') WHEN 1 THEN {array}('', ' ') WHEN 2 THEN {array}(repeat('x', 400 + CAST(c_custkey % 200 AS INT))) END AS pii_included_terms,
  CASE c_custkey % 4 WHEN 0 THEN {array}(' ' || c_name || ' ') WHEN 1 THEN {array}('') END AS pii_excluded_terms,
  CASE c_custkey % 3 WHEN 0 THEN 'studio' WHEN 1 THEN 'forever' END AS retention,
  CASE c_custkey % 7 WHEN 0 THEN 'pseudonymize' WHEN 1 THEN 'blur' WHEN 2 THEN '' END AS mode,
  repeat('k', 150 + CAST(c_custkey % 100 AS INT)) AS idempotency_key
FROM {customer}"""
_REQ, _REQ_CHECK = REQUESTS.replace("{array}", "array"), checked(REQUESTS).replace("{array}", "list_value")


def _kept(name: str) -> str:
    return f"(SELECT string_agg(t, ',' ORDER BY n) FROM (SELECT unnest({name}) AS t, generate_subscripts({name}, 1) AS n) AS u WHERE trim(t) <> '')"


@query(f"""WITH r AS ({_REQ_CHECK})
SELECT request_id, {_kept('pii_categories')} AS pii_categories, {_kept('pii_included_terms')} AS pii_included_terms, {_kept('pii_excluded_terms')} AS pii_excluded_terms,
  retention, nullif(mode, '') AS mode, CASE WHEN pii_categories IS NOT NULL AND {_kept('pii_categories')} IS NULL THEN 'invalid_request' END AS error FROM r""")
def clean_rules(t: Tables) -> DataFrame:
    """Requests' rule lists without blanks; an unusable category list is an error."""
    return R.clean_rules(t.sql(_REQ)).drop("account_id", "idempotency_key")


_BROKEN = [
    ("categories_count", "len(pii_categories) NOT BETWEEN 1 AND 8"),
    ("categories_unknown", "len(list_filter(pii_categories, lambda c: coalesce(c, '') NOT IN ('Person','Email','PhoneNumber','Address','Organization','Date','IBAN','CreditCard'))) > 0"),
    ("included_count", "len(pii_included_terms) > 500"),
    ("included_length", "len(list_filter(pii_included_terms, lambda c: length(c) > 500)) > 0"),
    ("excluded_count", "len(pii_excluded_terms) > 500"),
    ("excluded_length", "len(list_filter(pii_excluded_terms, lambda c: length(c) > 500)) > 0"),
    ("key_length", "length(idempotency_key) > 200"),
    ("mode_unknown", "mode NOT IN ('redact', 'pseudonymize')"),
    ("retention_unknown", "retention NOT IN ('ephemeral', 'studio')"),
]


@query(f"""WITH r AS ({_REQ_CHECK}), v AS ({' UNION ALL '.join(f"SELECT request_id, '{code}' AS code FROM r WHERE {test}" for code, test in _BROKEN)})
SELECT request_id, coalesce(string_agg(code, ',' ORDER BY code), '') AS violations FROM r LEFT JOIN v USING (request_id) GROUP BY request_id""")
def validate_rules(t: Tables) -> DataFrame:
    """Which limits each request breaks."""
    return R.validate_rules(t.sql(_REQ)).select("request_id", "violations")


_ACCOUNTS = """SELECT n_nationkey AS account_id, CASE WHEN n_nationkey % 2 = 0 THEN {array}('Date') END AS pii_categories,
  CASE WHEN n_nationkey % 3 = 0 THEN {array}(n_name) END AS pii_included_terms, CAST(NULL AS STRING) AS none,
  CASE WHEN n_nationkey % 4 = 0 THEN 'studio' END AS retention, CASE WHEN n_nationkey % 5 = 0 THEN 'pseudonymize' END AS mode FROM {nation}"""
_ACC, _ACC_CHECK = _ACCOUNTS.replace("{array}", "array"), checked(_ACCOUNTS).replace("{array}", "list_value")


@query(f"""WITH r AS ({_REQ_CHECK}), a AS ({_ACC_CHECK})
SELECT request_id, array_to_string(CASE WHEN r.pii_categories IS NULL THEN a.pii_categories ELSE r.pii_categories END, ',') AS pii_categories,
  array_to_string(CASE WHEN r.pii_included_terms IS NULL THEN a.pii_included_terms ELSE r.pii_included_terms END, ',') AS pii_included_terms,
  CASE WHEN r.retention IS NOT NULL THEN r.retention WHEN a.retention IS NOT NULL THEN a.retention ELSE 'ephemeral' END AS retention,
  CASE WHEN r.mode IS NOT NULL THEN r.mode WHEN a.mode IS NOT NULL THEN a.mode ELSE 'redact' END AS mode
FROM r LEFT JOIN a USING (account_id)""")
def resolve_rules(t: Tables) -> DataFrame:
    """What requests omit, from their account or the defaults."""
    accounts = t.sql(_ACC).withColumn("pii_excluded_terms", F.lit(None).cast("array<string>"))
    done = R.resolve_rules(t.sql(_REQ), accounts)
    return done.select("request_id", "pii_categories", "pii_included_terms", "retention", "mode")


# ---- Batches, keys, slots -----------------------------------------------------------------------

# Jobs of a customer's lines, so that some have none and some too many files.
_BATCH_JOBS = "SELECT 'c' || CAST(c_custkey AS STRING) AS job_id FROM {customer}"
_BATCHES = """SELECT 'c' || CAST(o_custkey AS STRING) AS job_id, 'f' || CAST(l_partkey AS STRING) AS filename,
  CASE l_returnflag WHEN 'R' THEN 'image/png' ELSE 'application/pdf' END AS content_type,
  CASE WHEN l_partkey % 97 = 0 THEN 0 ELSE CAST(l_extendedprice * 110 AS BIGINT) END AS size FROM {orders}, {lineitem} WHERE o_orderkey = l_orderkey"""


@query(f"""WITH u AS (SELECT job_id, size = 0 AS empty, size > CASE content_type WHEN 'image/png' THEN 10485760 ELSE 52428800 END AS big FROM ({checked(_BATCHES)}) AS b),
g AS (SELECT job_id, count(*) AS files, count_if(empty OR big) AS refused, bool_or(empty) AS any_empty FROM u GROUP BY job_id)
SELECT job_id, coalesce(files, 0) AS files, CAST(coalesce(refused, 0) AS BIGINT) AS refused,
  CASE WHEN files IS NULL OR files > 100 OR any_empty THEN 'invalid_request' WHEN refused > 0 THEN 'payload_too_large' END AS code
FROM ({checked(_BATCH_JOBS)}) AS j LEFT JOIN g USING (job_id)""")
def batch_limits(t: Tables) -> DataFrame:
    """Jobs refused for having no, too many, empty or too large files."""
    return J.check_batch(t.sql(_BATCH_JOBS), t.sql(_BATCHES))


_KEY_FILES = f"""SELECT CAST(l_orderkey AS STRING) AS job_id, 'f' || CAST(l_linenumber AS STRING) AS filename, l_returnflag || l_linestatus AS content FROM {LINES}"""
_KEY_RULES = """SELECT CAST(o_orderkey AS STRING) AS job_id, CASE o_orderkey % 3 WHEN 0 THEN {array}('Email', 'Date') WHEN 1 THEN {array}('Date', 'Email') END AS pii_categories,
  CASE WHEN o_orderkey % 5 = 0 THEN {array}(o_orderstatus) END AS pii_included_terms, CASE o_orderkey % 2 WHEN 0 THEN 'redact' END AS mode,
  CASE WHEN o_orderkey % 7 = 0 THEN 'ephemeral' WHEN o_orderkey % 7 = 1 THEN 'studio' END AS retention FROM {orders}"""


@query(f"""WITH f AS (SELECT job_id, string_agg(filename || '=' || content, ';' ORDER BY filename) AS files FROM ({checked(_KEY_FILES)}) AS k GROUP BY job_id),
r AS (SELECT job_id, coalesce(array_to_string(list_sort(pii_categories), ','), 'none') || '/' || coalesce(pii_included_terms[1], 'none') || '/' || coalesce(retention, 'ephemeral') AS rules
  FROM ({checked(_KEY_RULES).replace('{array}', 'list_value')}) AS q)
SELECT job_id, min(job_id) OVER (PARTITION BY files, rules) AS same_as FROM f JOIN r USING (job_id)""")
def job_keys(t: Tables) -> DataFrame:
    """Jobs with the first of those that have the same key."""
    files = t.sql(_KEY_FILES).withColumn("bytes", F.encode("content", "UTF-8"))
    rules = t.sql(_KEY_RULES.replace("{array}", "array")).withColumn("pii_excluded_terms", F.lit(None).cast("array<string>"))
    keys = J.job_key(files, rules)
    first = keys.groupBy("job_key").agg(F.min("job_id").alias("same_as"))
    return keys.join(first, "job_key").select("job_id", "same_as")


_ASKED = "SELECT event_id AS request_id, 'k' || CAST(user_id AS STRING) AS job_key, ts, CASE WHEN event_type = 'error' THEN 'other' ELSE 'same' END AS params FROM {events}"


@query(f"""WITH RECURSIVE asked AS ({checked(_ASKED)}),
openers AS (
  SELECT job_key, min(ts) AS ts FROM asked GROUP BY job_key
  UNION ALL
  SELECT job_key, ts FROM (SELECT o.job_key, min(a.ts) AS ts FROM openers AS o JOIN asked AS a ON a.job_key = o.job_key AND a.ts >= o.ts + INTERVAL 24 HOUR GROUP BY o.job_key, o.ts) AS n),
first AS (SELECT o.job_key, o.ts, min(request_id) AS opener, arg_min(params, request_id) AS params FROM openers AS o JOIN asked AS a USING (job_key, ts) GROUP BY o.job_key, o.ts)
SELECT a.request_id, a.job_key, epoch_us(a.ts) AS ts, a.params, f.opener AS job_request_id, a.request_id = f.opener AS billed, a.params <> f.params AS conflict
FROM asked AS a ASOF JOIN first AS f ON a.job_key = f.job_key AND a.ts >= f.ts""")
def dedupe_jobs(t: Tables) -> DataFrame:
    """Requests that repeat one of the last 24 hours join its job."""
    return J.dedupe_jobs(t.sql(_ASKED))


@query("""SELECT user_id, event_id, CAST((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 20 AS BIGINT) AS job_no FROM events""")
def pack_jobs(t: Tables) -> DataFrame:
    """Files of each user into jobs of at most 20."""
    return J.pack_jobs(t.events.select("user_id", "event_id"), ["user_id"], "event_id", size=20)


@query(f"""SELECT job_id, count(*) AS files, CASE WHEN count_if(content_type <> 'application/pdf') = 0 AND max(size) > 8 * 1024 * 1024 THEN 'direct' ELSE 'multipart' END AS route
FROM ({_U}) AS u GROUP BY job_id""")
def upload_route(t: Tables) -> DataFrame:
    return J.choose_upload_route(t.sql(UPLOADS))


# Slots a server asks for: in another order than the files, some unknown, some without a name.
_SLOTS = f"""SELECT 'j' || CAST(l_orderkey AS STRING) AS job_id, CAST(10 - l_linenumber AS BIGINT) AS slot_no,
  'd' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS document_id,
  CASE WHEN l_suppkey % 11 = 0 THEN NULL WHEN l_suppkey % 13 = 0 THEN 'stranger.pdf' ELSE 'f' || CAST(l_partkey % 3 AS STRING) || CASE l_returnflag WHEN 'R' THEN '.png' WHEN 'A' THEN '.pdf' ELSE '.PDF' END END AS filename
FROM {LINES}"""


@query(f"""WITH s AS (SELECT *, row_number() OVER (PARTITION BY job_id, filename ORDER BY slot_no) AS k FROM ({checked(_SLOTS)}) AS x),
u AS (SELECT job_id, filename, file_no, row_number() OVER (PARTITION BY job_id, filename ORDER BY file_no) AS k FROM ({_U}) AS y)
SELECT s.job_id, s.slot_no, s.document_id, s.filename, u.file_no, CASE WHEN u.file_no IS NULL THEN 'error' END AS code, u.file_no IS NULL AS retryable
FROM s LEFT JOIN u ON u.job_id = s.job_id AND u.filename = s.filename AND u.k = s.k""")
def match_slots(t: Tables) -> DataFrame:
    """Slots paired with files by name, each file once."""
    return J.match_slots(t.sql(_SLOTS), t.sql(UPLOADS))


# ---- Status -------------------------------------------------------------------------------------


@query(f"""WITH j AS ({_J}), d AS ({_D})
SELECT j.job_id, any_value(j.status) AS job_status, any_value(retention) AS retention, coalesce(any_value(mode), 'redact') AS mode, epoch_us(any_value(created_at)) AS created_at,
  count(d.document_id) AS documents, {', '.join(f"count(d.document_id) FILTER (d.status = '{s}') AS {s}" for s in C.STATUSES)}, CAST(coalesce(sum(page_count), 0) AS BIGINT) AS pages,
  CASE WHEN count(d.document_id) = 0 THEN any_value(j.status) IN ('redacted', 'error') ELSE count(d.document_id) FILTER (d.status NOT IN ('redacted', 'error')) = 0 END AS is_final,
  CASE WHEN CASE WHEN count(d.document_id) = 0 THEN any_value(j.status) IN ('redacted', 'error') ELSE count(d.document_id) FILTER (d.status NOT IN ('redacted', 'error')) = 0 END
    THEN 'download' ELSE 'wait' END AS next_step
FROM j LEFT JOIN d ON d.job_id = j.job_id GROUP BY j.job_id""")
def job_summary(t: Tables) -> DataFrame:
    return J.job_summary(t.sql(JOBS), t.sql(DOCUMENTS))


def _nested(t: Tables) -> DataFrame:
    """Jobs in snapshot form: documents nested, none for some."""
    none = F.array().cast("array<struct<document_id:string,file_name:string,status:string,page_count:int,error_message:string>>")
    joined = t.sql(JOBS).join(J.nest_documents(t.sql(DOCUMENTS)), "job_id", "left")
    return joined.withColumn("documents", F.coalesce("documents", none))


@query(f"""WITH j AS ({_J}), d AS ({_D})
SELECT j.job_id, CASE WHEN count(d.document_id) = 0 THEN any_value(j.status) IN ('redacted', 'error')
  ELSE bool_and(d.status IN ('redacted', 'error')) END AS is_final, count(d.document_id) AS documents FROM j LEFT JOIN d ON d.job_id = j.job_id GROUP BY j.job_id""")
def terminal_jobs(t: Tables) -> DataFrame:
    """Settled or not, by the documents nested in each snapshot."""
    nested = _nested(t)
    return nested.select("job_id", codes.is_terminal(F.col("status"), F.col("documents")).alias("is_final"), F.size("documents").alias("documents"))


@query(f"""WITH j AS ({_J}), d AS ({_D})
SELECT j.job_id, j.status AS job_status, j.retention, coalesce(mode, 'redact') AS mode, epoch_us(created_at) AS created_at, d.document_id, d.file_name, d.status,
  CAST(d.page_count AS BIGINT) AS page_count, d.error_message FROM j LEFT JOIN d ON d.job_id = j.job_id""")
def flatten_jobs(t: Tables) -> DataFrame:
    """Snapshots as rows, one per document; jobs without documents stay."""
    renamed = F.transform("documents", lambda d: F.struct(
        d["document_id"].alias("id"), d["file_name"].alias("file_name"), d["status"].alias("status"),
        d["page_count"].alias("page_count"), d["error_message"].alias("error_message"),
    ))
    return S.flatten_jobs(S.with_defaults(_nested(t).withColumn("documents", renamed).drop("account_id")))


@query(f"SELECT document_id, status = 'error' AND regexp_matches(coalesce(error_message, ''), '(?i)upload was not completed|verify uploaded file size|exceeds the maximum allowed size') AS recommit FROM ({_D}) AS d")
def needs_recommit(t: Tables) -> DataFrame:
    return t.sql(DOCUMENTS).select("document_id", codes.needs_recommit(F.col("status"), F.col("error_message")).alias("recommit"))


@query(f"SELECT job_id, 'invalid_request' AS code FROM ({_J}) AS j WHERE NOT EXISTS (SELECT 1 FROM ({_D}) AS d WHERE d.job_id = j.job_id)")
def job_accepted(t: Tables) -> DataFrame:
    """Jobs none of whose files was taken."""
    return J.job_accepted(t.sql(JOBS), t.sql(DOCUMENTS))


_STATUS_EVENTS = """SELECT event_id, 'd' || CAST(user_id * 7 + event_id % 7 AS STRING) AS document_id, ts,
  CASE WHEN event_type = 'purchase' AND value < 3 THEN 'redacted' WHEN event_type = 'error' AND value < 2 THEN 'error' WHEN event_type = 'click' THEN 'redacting' WHEN event_type = 'view' THEN 'analyzing' ELSE 'uploaded' END AS status FROM {events}"""


@query(f"""WITH e AS ({checked(_STATUS_EVENTS)}), r AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY status NOT IN ('redacted', 'error'),
  CASE WHEN status IN ('redacted', 'error') THEN epoch_us(ts) ELSE -epoch_us(ts) END, CASE WHEN status IN ('redacted', 'error') THEN event_id ELSE -event_id END) AS n FROM e)
SELECT document_id, status, epoch_us(ts) AS ts FROM r WHERE n = 1""")
def latest_status(t: Tables) -> DataFrame:
    """Last status of each document, where a final one stays."""
    return J.latest_status(t.sql(_STATUS_EVENTS))


# A watch per user and day, of twelve hours.
READS = """SELECT CAST(user_id AS STRING) || '/' || CAST(CAST(ts AS DATE) AS STRING) AS job_id, ts, event_id AS read_no, event_type <> 'error' AS ok,
  event_type = 'purchase' AND value < 10 AS final, value < 20 AS retryable, CASE WHEN event_type = 'error' THEN CASE WHEN value < 20 THEN 'rate_limited' ELSE 'unauthorized' END END AS code,
  CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'purchase' AND value < 10 THEN 'redacted' ELSE event_type END AS status FROM {events}"""
WATCHED = "SELECT job_id, min(ts) AS started_at FROM ({reads}) AS r GROUP BY job_id"


@query(f"""WITH r AS ({checked(READS)}), w AS (SELECT *, min(ts) OVER (PARTITION BY job_id) AS started_at FROM r),
t AS (SELECT *, CASE WHEN ok AND final THEN 'settled' WHEN NOT ok AND NOT retryable THEN 'fatal' END AS ending FROM w WHERE ts < started_at + INTERVAL 12 HOUR),
g AS (SELECT job_id, first(ending ORDER BY ts, read_no) FILTER (ending IS NOT NULL) AS ending, first(code ORDER BY ts, read_no) FILTER (ending IS NOT NULL) AS end_code,
  first(status ORDER BY ts, read_no) FILTER (ending IS NOT NULL) AS end_status, last(ok ORDER BY ts, read_no) AS last_ok, last(code ORDER BY ts, read_no) AS last_code,
  last(status ORDER BY ts, read_no) FILTER (ok) AS last_status, count(*) AS reads FROM t GROUP BY job_id)
SELECT job_id, coalesce(ending, CASE WHEN last_ok THEN 'running' ELSE 'outage' END) AS outcome,
  CASE WHEN ending = 'settled' THEN NULL WHEN ending = 'fatal' THEN end_code WHEN last_ok THEN 'timeout' ELSE last_code END AS code,
  CASE WHEN ending = 'settled' THEN end_status ELSE last_status END AS last_status, reads FROM g""")
def job_watch(t: Tables) -> DataFrame:
    """How watching each job ended, by its status reads."""
    return J.job_watch(t.sql(WATCHED.replace("{reads}", READS)), t.sql(READS), budget=12 * 3600)


@query(f"""SELECT request_id, coalesce(mode, 'redact') AS mode_of_record, asked FROM
  (SELECT o_orderkey AS request_id, 'j' || o_orderkey AS job_id, CASE WHEN o_orderkey % 2 = 0 THEN 'pseudonymize' ELSE 'redact' END AS asked FROM orders) AS r JOIN ({_J}) AS j USING (job_id)""")
def mode_of_record(t: Tables) -> DataFrame:
    """What each job was done as, whatever was asked."""
    asked = t.sql("SELECT o_orderkey AS request_id, 'j' || CAST(o_orderkey AS STRING) AS job_id, CASE WHEN o_orderkey % 2 = 0 THEN 'pseudonymize' ELSE 'redact' END AS asked FROM {orders}")
    return J.mode_of_record(asked, t.sql(JOBS)).drop("job_id")


# ---- Responses ----------------------------------------------------------------------------------

RESPONSES = """SELECT event_id, CAST(split_part('400,401,402,403,404,409,413,422,429,500,503,418,302', ',', CAST(event_id % 13 AS INT) + 1) AS INT) AS status,
  CASE event_id % 4 WHEN 0 THEN CAST(event_id % 90 AS STRING) WHEN 1 THEN 'soon' WHEN 2 THEN '-5' END AS retry_after,
  CASE event_id % 3 WHEN 0 THEN chr(123) || '"error": "' || event_type || ' failed", "code": "x", "request_id": "r' || CAST(event_id AS STRING) || '"' || chr(125) WHEN 1 THEN '<html>Bad ' || event_type || '</html>' ELSE '' END AS body,
  split_part('job,text,correspondence', ',', CAST(event_id % 3 AS INT) + 1) AS route FROM {events}"""


@query(f"""WITH r AS ({checked(RESPONSES)})
SELECT event_id, CASE status WHEN 400 THEN 'invalid_request' WHEN 401 THEN 'unauthorized' WHEN 402 THEN 'quota_exceeded' WHEN 403 THEN 'forbidden' WHEN 404 THEN 'not_found'
    WHEN 409 THEN 'conflict' WHEN 413 THEN 'payload_too_large' WHEN 422 THEN 'invalid_request' WHEN 429 THEN 'rate_limited' WHEN 500 THEN 'internal_error' WHEN 503 THEN 'internal_error' ELSE 'error' END AS code,
  status IN (429, 500, 503) AS retryable, CASE WHEN status IN (429, 500, 503) AND regexp_full_match(retry_after, '[0-9]+') THEN CAST(retry_after AS BIGINT) END AS retry_after_seconds,
  CASE WHEN body LIKE '{{%' THEN json_extract_string(body, '$.error') WHEN body = '' THEN 'Unknown error' ELSE body END AS detail,
  CASE WHEN body LIKE '{{%' THEN json_extract_string(body, '$.request_id') END AS request_id FROM (SELECT * REPLACE (CASE WHEN retry_after IS NULL OR NOT regexp_full_match(retry_after, '[0-9]+') THEN NULL ELSE retry_after END AS retry_after) FROM r) AS r2""")
def status_codes(t: Tables) -> DataFrame:
    """Failed responses as error codes with what to do."""
    parsed = codes.classify_status(F.col("status"), F.col("retry_after"), F.col("body"))
    return t.sql(RESPONSES).select("event_id", parsed.alias("e")).select("event_id", "e.*")


@query(f"""WITH r AS ({checked(RESPONSES)})
SELECT event_id, (route = 'correspondence' AND status IN (404, 409, 422)) OR (route = 'text' AND status IN (404, 409)) AS settled,
  status IN (429, 500, 503) AS retryable FROM r""")
def route_status(t: Tables) -> DataFrame:
    """Statuses that are settled on the table and text routes."""
    parsed = codes.classify_route_status(F.col("route"), F.col("status"))
    return t.sql(RESPONSES).select("event_id", parsed["settled"].alias("settled"), parsed["retryable"].alias("retryable"))


_FAILURES = """SELECT event_id, CASE WHEN event_id % 3 > 0 THEN 'j' || CAST(user_id AS STRING) END AS job_id, CASE WHEN event_id % 6 > 2 THEN 'd' || CAST(event_id AS STRING) END AS document_id FROM {events}"""


@query(f"""WITH f AS ({checked(_FAILURES)})
SELECT event_id, CASE WHEN job_id IS NULL THEN NULL WHEN document_id IS NULL THEN 'get_job_status' ELSE 'download_redacted' END AS tool,
  CASE WHEN document_id IS NULL THEN job_id END AS job_id, CASE WHEN job_id IS NOT NULL THEN document_id END AS document_id,
  CASE WHEN job_id IS NOT NULL THEN true END AS do_not_re_upload FROM f""")
def resume_plan(t: Tables) -> DataFrame:
    """How to go on after failures that already cost pages."""
    return t.sql(_FAILURES).select("event_id", codes.resume_plan(F.col("job_id"), F.col("document_id")).alias("r")).select("event_id", "r.*")


# ---- Usage, retention, logs ---------------------------------------------------------------------

_BILLED = "SELECT o_custkey AS account_id, o_orderkey AS document_id, o_orderdate AS created_at, 1 + o_orderkey % 9 AS page_count, o_orderkey % 7 = 0 AS replay FROM {orders}"


@query(f"""WITH d AS (SELECT * FROM ({checked(_BILLED)}) AS b WHERE NOT replay),
n AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY created_at, document_id) AS k FROM d),
g AS (SELECT account_id, count(*) AS documents, sum(page_count) AS pages, coalesce(sum(page_count) FILTER (k = 1 AND page_count <= 5), 0) AS free FROM n GROUP BY account_id)
SELECT c_custkey AS account_id, coalesce(documents, 0) AS documents, CAST(coalesce(pages, 0) AS BIGINT) AS pages, CAST(coalesce(free, 0) AS BIGINT) AS free_pages,
  CAST(coalesce(pages - free, 0) AS BIGINT) AS billed_pages, CAST(greatest(30 + c_custkey % 40 - coalesce(pages - free, 0), 0) AS BIGINT) AS pages_left,
  coalesce(pages - free, 0) > 30 + c_custkey % 40 AS quota_exceeded FROM customer LEFT JOIN g ON account_id = c_custkey""")
def page_usage(t: Tables) -> DataFrame:
    """Pages billed per account; the first short document is free, repeats are not billed."""
    return J.page_usage(t.sql(_BILLED), t.sql("SELECT c_custkey AS account_id, 30 + c_custkey % 40 AS quota FROM {customer}"))


_ARTIFACTS = f"""SELECT job_id, kind, retention, created_at, CASE WHEN status = 'redacted' THEN created_at END AS processed_at
FROM (SELECT *, {{each}} AS kind FROM ({JOBS}) AS j) AS k"""
_ARTIFACTS_SPARK = _ARTIFACTS.replace("{each}", "explode(array('original', 'masks', 'output'))")
_ARTIFACTS_CHECK = checked(_ARTIFACTS).replace("{each}", "unnest(['original', 'masks', 'output'])")
_DELETED = "SELECT 'j' || CAST(o_orderkey AS STRING) AS job_id FROM {orders} WHERE o_orderkey % 17 = 0"


@query(f"""WITH a AS ({_ARTIFACTS_CHECK})
SELECT job_id, kind FROM a WHERE job_id NOT IN (SELECT job_id FROM ({checked(_DELETED)}) AS x) AND (retention = 'studio'
  OR (kind = 'output' AND created_at >= TIMESTAMP '1998-06-01' - INTERVAL 14 DAY) OR (kind <> 'output' AND processed_at IS NULL) OR (kind <> 'output' AND processed_at > TIMESTAMP '1998-06-01'))""")
def expire_outputs(t: Tables) -> DataFrame:
    """What is left of the jobs' files after retention and deletions."""
    now = F.lit("1998-06-01 00:00:00").cast("timestamp")
    return S.keep_outputs(t.sql(_ARTIFACTS_SPARK), t.sql(_DELETED), now).select("job_id", "kind")


@query("""SELECT o_orderkey AS document_id, epoch_us(o_orderdate + INTERVAL 60 DAY) AS produced_at, epoch_us(max(l_shipdate)) AS edited_at FROM orders JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY o_orderkey, o_orderdate HAVING max(l_shipdate) > o_orderdate + INTERVAL 60 DAY""")
def stale_outputs(t: Tables) -> DataFrame:
    """Outputs older than the last edit of their document."""
    outputs = t.sql("SELECT o_orderkey AS document_id, o_orderdate + INTERVAL 60 DAY AS produced_at FROM {orders}")
    return J.stale_outputs(outputs, t.sql("SELECT l_orderkey AS document_id, l_shipdate AS edited_at FROM {lineitem}"))


CALLS = """SELECT ts, 'engine' AS svc, split_part('redact,status,download,restore,preview', ',', CAST(user_id % 5 AS INT) + 1) AS tool,
  CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS outcome, CAST(floor(value * 100) AS BIGINT) AS durationMs,
  CASE WHEN event_type = 'error' THEN split_part('timeout,not_found,conflict', ',', CAST(event_id % 3 AS INT) + 1) END AS code,
  CAST(event_id AS STRING) AS requestId FROM {events}"""


@query(f"""SELECT tool, count(*) AS calls, CAST(count_if(outcome = 'error') AS BIGINT) AS errors, quantile_disc(durationMs, 0.5) AS p50_ms, quantile_disc(durationMs, 0.95) AS p95_ms,
  max(durationMs) AS max_ms, coalesce(string_agg(DISTINCT code, ',' ORDER BY code), '') AS codes FROM ({checked(CALLS)}) AS c GROUP BY tool""")
def call_log_summary(t: Tables) -> DataFrame:
    return J.call_log_summary(t.sql(CALLS))


@query(f"SELECT tool, outcome, count(*) AS calls, CAST(sum(durationMs) AS BIGINT) AS total_ms, CAST(grouping(tool, outcome) AS BIGINT) AS level FROM ({checked(CALLS)}) AS c GROUP BY CUBE (tool, outcome)")
def call_log_cube(t: Tables) -> DataFrame:
    return J.call_log_cube(t.sql(CALLS))


@query(f"""SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS window_start, tool, count(*) AS calls, CAST(count_if(outcome = 'error') AS BIGINT) AS errors FROM ({checked(CALLS)}) AS c GROUP BY ALL""")
def call_rates(t: Tables) -> DataFrame:
    """Calls per hour and tool."""
    return J.call_rates(t.sql(CALLS), "1 hour")


@query(f"""WITH c AS ({checked(CALLS)})
SELECT requestId, CAST(to_json(struct_pack(tool := tool, outcome := outcome, durationMs := durationMs)) AS VARCHAR) AS line FROM c WHERE code IS NULL
UNION ALL SELECT requestId, CAST(to_json(struct_pack(tool := tool, outcome := outcome, durationMs := durationMs, code := code)) AS VARCHAR) FROM c WHERE code IS NOT NULL""")
def call_log_lines(t: Tables) -> DataFrame:
    """Call records as JSON lines without empty fields."""
    log = t.sql(CALLS).select("requestId", "tool", "outcome", "durationMs", "code")
    return log.select("requestId", F.to_json(F.struct("tool", "outcome", "durationMs", "code")).alias("line"))
