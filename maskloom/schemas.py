"""Row shapes and the fixed values every module shares."""

from __future__ import annotations

# Category, mode, retention, status and error names.
CATEGORIES = ["Person", "Email", "PhoneNumber", "Address", "Organization", "Date", "IBAN", "CreditCard"]
MODES = ["redact", "pseudonymize"]
RETENTIONS = ["ephemeral", "studio"]
STATUSES = ["uploading", "uploaded", "analyzing", "redacting", "redacted", "error"]
TERMINAL = ["redacted", "error"]

# Limits.
MB = 1024 * 1024
MAX_PDF_BYTES = 50 * MB
MAX_IMAGE_BYTES = 10 * MB
MAX_PREVIEW_BYTES = 5 * MB
MAX_FILES_PER_JOB = 100
DIRECT_UPLOAD_BYTES = 8 * MB
MAX_INLINE_BYTES = 6 * MB
MAX_INLINE_TEXT_BYTES = 32 * 1024
MAX_TERMS = 500
MAX_TERM_LENGTH = 500
MAX_KEY_LENGTH = 200
MAX_REDIRECTS = 3
WAIT_BUDGET_SECONDS = 300
RETENTION_DAYS = 14
KEY_LIFETIME_HOURS = 24
FREE_PAGES = 5

# Category given to always-redact terms; it never becomes a tag.
CUSTOM = "Custom"

SPAN = "struct<start:int,end:int,category:string,surface:string,priority:int>"
SPANS = f"array<{SPAN}>"

FILE = "filename STRING, content_type STRING, bytes BINARY, size BIGINT"
RULES = (
    "request_id STRING, pii_categories ARRAY<STRING>, pii_included_terms ARRAY<STRING>, "
    "pii_excluded_terms ARRAY<STRING>, retention STRING, mode STRING"
)
JOB = (
    "job_id STRING, status STRING, retention STRING, mode STRING, created_at TIMESTAMP, "
    "documents ARRAY<STRUCT<id: STRING, file_name: STRING, status: STRING, page_count: INT, "
    "error_message: STRING>>"
)
CALL_LOG = (
    "ts TIMESTAMP, svc STRING, tool STRING, outcome STRING, durationMs BIGINT, code STRING, "
    "httpStatus INT, jobId STRING, documentId STRING, requestId STRING"
)
ERROR_BODY = "error STRING, code STRING, request_id STRING"
CORRESPONDENCE = "placeholder STRING, label STRING, category STRING, original STRING"
