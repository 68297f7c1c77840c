"""Queries over addresses, URLs, redirects and response headers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.functions import files, net
from maskloom.operators import urls as U
from maskloom.plans.common import Tables, checked, query

# Addresses of every kind out of the event numbers: four octets, and IPv6 spellings that carry them.
QUADS = """SELECT event_id, a, b, c, d, CAST(a AS STRING) || '.' || CAST(b AS STRING) || '.' || CAST(c AS STRING) || '.' || CAST(d AS STRING) AS quad FROM
  (SELECT event_id, CAST(split_part('0,8,10,93,100,127,169,172,192,198,224,255,256,203', ',', CAST(event_id % 14 AS INT) + 1) AS BIGINT) AS a,
    CAST(split_part('0,15,16,18,31,32,64,88,127,128,168,254', ',', CAST(floor(event_id / 14) % 12 AS INT) + 1) AS BIGINT) AS b,
    CAST(split_part('0,1,2,99', ',', CAST(floor(event_id / 168) % 4 AS INT) + 1) AS BIGINT) AS c, event_id % 200 AS d FROM {events}) AS octets"""
ADDRESSES = f"""SELECT *, CASE event_id % 11 WHEN 1 THEN '::ffff:' || quad WHEN 2 THEN '::' || quad WHEN 3 THEN '64:ff9b::' || quad
  WHEN 4 THEN '2606:2800:220:1::' || CAST(d AS STRING) WHEN 5 THEN 'fe80::' || CAST(d AS STRING) || '%eth0' WHEN 6 THEN 'FD00:1::' || CAST(b AS STRING)
  WHEN 7 THEN quad || '.1' WHEN 8 THEN '::ffff:0:' || quad WHEN 9 THEN '2001:0:1::' || CAST(d AS STRING) WHEN 10 THEN '1:2:3:4:5:6:7:8:9' ELSE quad END AS address
FROM ({QUADS}) AS q"""
_PRIVATE = """(a IN (0, 10, 127) OR a >= 224 OR (a = 100 AND b BETWEEN 64 AND 127) OR (a = 169 AND b = 254) OR (a = 172 AND b BETWEEN 16 AND 31)
  OR (a = 192 AND b = 168) OR (a = 192 AND b = 0 AND c IN (0, 2)) OR (a = 192 AND b = 88 AND c = 99) OR (a = 198 AND b IN (18, 19)))"""


@query(f"""WITH x AS ({checked(ADDRESSES)})
SELECT event_id, CASE WHEN event_id % 11 IN (0, 1, 2, 3, 8) THEN a <= 255 AND NOT {_PRIVATE} ELSE event_id % 11 = 4 END AS public FROM x""")
def public_addresses(t: Tables) -> DataFrame:
    """Which addresses, in any spelling, are on the public internet."""
    return t.sql(ADDRESSES).select("event_id", net.is_public_address(F.col("address")).alias("public"))


# Hosts of the pages with the addresses they resolve to: one public, for some a private one too, for some none.
_HOST = "split_part(split_part(url, '/', 3), ':', 1)"
RESOLVED = f"""SELECT host, '93.184.' || CAST(length(host) AS STRING) || '.34' AS address FROM (SELECT DISTINCT {_HOST} AS host FROM {{pages}}) AS h WHERE length(host) % 7 <> 0
UNION ALL SELECT host, '10.0.0.' || CAST(length(host) AS STRING) FROM (SELECT DISTINCT {_HOST} AS host FROM {{pages}}) AS h WHERE length(host) % 5 = 0"""
# The pages' URLs, with some that name an address, another scheme, a port, a user.
URLS = """SELECT page_id, CASE page_id % 9 WHEN 0 THEN 'http://10.1.2.' || CAST(page_id % 250 AS STRING) || '/x?token=1' WHEN 1 THEN 'ftp' || substr(url, instr(url, ':'))
  WHEN 2 THEN 'https://[::ffff:8.8.8.8]/a#f' WHEN 3 THEN 'HTTP://2130706433/' WHEN 4 THEN replace(url, '.example.', ':8443.example.') ELSE url END AS url FROM {pages}"""
URLS = URLS.replace("replace(url, '.example.', ':8443.example.')", "'https://user:pw@' || split_part(url, '/', 3) || ':8443/p?q=1'")


@query(f"""WITH u AS ({checked(URLS)}), r AS ({checked(RESOLVED)}), h AS (SELECT host, bool_and(address LIKE '93.%') AS ok FROM r GROUP BY host),
p AS (SELECT page_id, url, lower(split_part(url, ':', 1)) AS scheme, regexp_replace(split_part(split_part(url, '/', 3), '@', -1), ':[0-9]+$', '') AS host FROM u)
SELECT page_id, url, CASE WHEN page_id % 9 = 2 THEN 'https://[::ffff:808:808]/a' WHEN page_id % 9 = 3 THEN 'http://127.0.0.1/' WHEN page_id % 9 = 4 THEN 'https://' || p.host || ':8443/p'
    ELSE scheme || '://' || p.host || CASE WHEN regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) END END AS shown,
  CASE WHEN scheme NOT IN ('http', 'https') THEN 'unsupported_scheme' WHEN page_id % 9 IN (0, 3) THEN 'not_public' WHEN page_id % 9 = 2 THEN NULL
    WHEN coalesce(ok, false) THEN NULL ELSE 'not_public' END AS refused
FROM p LEFT JOIN h ON p.host = h.host""")
def safe_urls(t: Tables) -> DataFrame:
    """URLs refused unless every address of their host is public."""
    return U.refuse_private_urls(t.sql(URLS), t.sql(RESOLVED))


@query("""SELECT page_id, CASE WHEN strpos(url, '?') > 0 THEN split_part(url, '?', 1) ELSE split_part(url, '#', 1) END AS shown FROM pages""")
def stripped_urls(t: Tables) -> DataFrame:
    """The pages' URLs without query and fragment."""
    return t.pages.select("page_id", net.strip_url(F.col("url")).alias("shown"))


# Spellings of one place: case, default ports, numbers for an address, dots and slashes in the path, blanks and tabs.
_SPELT = [
    ("' HTTPS://User@EXAMPLE-' || {k} || '.Org:443/a/./b/../' || {k} || '?q'", "'https://example-' || {k} || '.org/a/' || {k}"),
    ("'http:' || {b} || {b} || 'host' || {k} || '.example' || {b} || 'x' || {b} || '..' || {b} || 'y z'", "'http://host' || {k} || '.example/y%20z'"),
    ("'http://0x7f.' || {k} || '/%2e%2E/..'", "'http://127.0.' || CAST(floor(page_id / 256) AS INT) || '.' || CAST(page_id % 256 AS STRING) || '/'"),
    ("'https://[2001:DB8:0:0:1:0:0:' || {k} || ']:0443'", "'https://[2001:db8::1:0:0:' || CASE WHEN page_id = 0 THEN '0' ELSE ltrim({k}, '0') END || ']/'"),
    ("'http://h.example:80' || {k} || '/é'", "CASE WHEN CAST('80' || {k} AS BIGINT) <= 65535 THEN 'http://h.example:' || CAST(CAST('80' || {k} AS BIGINT) AS STRING) || '/%C3%A9' END"),
    ("'http://1.2.3.4.' || {k}", "CAST(NULL AS STRING)"),
    ("'https:/one.example/' || {k} || chr(9) || '/..#f'", "'https://one.example/'"),
    ("'mailto:' || {k} || '@x.example'", "'mailto://' || {k} || '@x.example'"),
]


def _spelt(side: int) -> str:
    return f"CASE page_id % {len(_SPELT)} " + " ".join(f"WHEN {i} THEN {pair[side].format(k='CAST(page_id AS STRING)', b='chr(92)')}" for i, pair in enumerate(_SPELT)) + " END"


@query(f"""WITH p AS (SELECT *, {_spelt(1)} AS shown FROM pages)
SELECT page_id, CASE WHEN page_id % 8 = 3 THEN replace(shown, ':0:0:0]', '::]') ELSE shown END AS shown FROM p""")
def one_form_urls(t: Tables) -> DataFrame:
    """Many spellings of URLs in the one form they are shown in; what is no URL has none."""
    return t.sql(f"SELECT page_id, {_spelt(0)} AS url FROM {{pages}}").select("page_id", net.strip_url(F.col("url")).alias("shown"))


# Fetches with up to five redirects per page, relative or absolute; some break off or stray.
HOPS = f"""SELECT page_id AS chain_id, hop_no, split_part(url, '/', 1) || '//' || {_HOST} || '/h' || CAST(CASE WHEN page_id % 11 = 5 AND hop_no = 2 THEN 99 ELSE hop_no END AS STRING) AS url,
  CASE WHEN hop_no < page_id % 6 THEN 302 WHEN page_id % 13 = 0 THEN 404 ELSE 200 END AS status,
  CASE WHEN hop_no >= page_id % 6 THEN NULL WHEN page_id % 7 = 0 AND hop_no = 1 THEN NULL WHEN page_id % 11 = 4 AND hop_no = 0 THEN 'mailto:x'
    WHEN hop_no % 2 = 0 THEN '/h' || CAST(hop_no + 1 AS STRING) WHEN hop_no % 3 = 0 THEN split_part(url, '/', 1) || '//' || {_HOST} || '/h' || CAST(hop_no + 1 AS STRING) ELSE 'h' || CAST(hop_no + 1 AS STRING) END AS location
FROM (SELECT page_id, url, explode(sequence(CAST(0 AS BIGINT), page_id % 6)) AS hop_no FROM {{pages}}) AS hops"""


@query(f"""WITH p AS (SELECT page_id AS chain_id, page_id % 6 AS n, {_HOST} AS host FROM pages), h AS (SELECT host, bool_and(address LIKE '93.%') AS ok FROM ({checked(RESOLVED)}) AS r GROUP BY host),
e AS (SELECT chain_id, n, coalesce(ok, false) AS ok, CASE WHEN chain_id % 7 = 0 AND n > 1 THEN 1 ELSE 100 END AS missing, CASE WHEN chain_id % 11 = 4 AND n > 0 THEN 0 ELSE 100 END AS invalid,
  CASE WHEN chain_id % 11 = 5 AND n >= 2 THEN 2 ELSE 100 END AS stray, CASE WHEN n > 3 THEN 3 ELSE 100 END AS many FROM p LEFT JOIN h ON p.host = h.host),
f AS (SELECT *, least(missing, invalid, stray, many, n) AS stop FROM e)
SELECT chain_id, CASE WHEN NOT ok THEN 'not_public' WHEN stray = stop THEN 'unexpected_hop' WHEN missing = stop THEN 'redirect_without_target' WHEN invalid = stop THEN 'invalid_redirect'
  WHEN many = stop AND n > 3 THEN 'too_many_redirects' WHEN chain_id % 13 = 0 THEN 'http_error' ELSE 'fetched' END AS outcome, CASE WHEN NOT ok THEN 0 ELSE stop END AS hops FROM f""")
def redirect_audit(t: Tables) -> DataFrame:
    """How each chain of redirects ended, every hop checked."""
    return U.audit_redirects(t.sql(HOPS), t.sql(RESOLVED))


_FETCHED = """SELECT page_id, url, CASE page_id % 6 WHEN 0 THEN 'attachment; filename="report ' || CAST(page_id AS STRING) || '.pdf"' WHEN 1 THEN 'inline; filename*=UTF-8''''r%C3%A9sum%C3%A9+' || CAST(page_id AS STRING) || '.pdf'
  WHEN 2 THEN 'attachment; filename=bad%zz' || CAST(page_id AS STRING) || '.png' WHEN 3 THEN 'attachment; FileName="../../etc/x' || CAST(page_id AS STRING) || '.jpg"' END AS disposition,
  CASE page_id % 4 WHEN 0 THEN 'application/pdf; charset=x' WHEN 1 THEN 'text/html' WHEN 2 THEN ' image/png' END AS served FROM {pages}"""


@query(f"""WITH f AS ({checked(_FETCHED)}), n AS (SELECT page_id, served, CASE page_id % 6 WHEN 0 THEN 'report ' || page_id || '.pdf' WHEN 1 THEN 'résumé+' || page_id || '.pdf' WHEN 2 THEN 'bad%zz' || page_id || '.png'
    WHEN 3 THEN 'x' || page_id || '.jpg' ELSE CASE WHEN contains(regexp_extract(split_part(split_part(url, '?', 1), '#', 1), '([^/]*)/*$', 1), '.') AND length(replace(split_part(split_part(url, '?', 1), '#', 1), '/', '')) < length(split_part(split_part(url, '?', 1), '#', 1)) - 2
      THEN regexp_extract(split_part(split_part(url, '?', 1), '#', 1), '([^/]*)/*$', 1) ELSE 'document.pdf' END END AS filename FROM f)
SELECT page_id, filename, CASE WHEN page_id % 4 = 0 THEN 'application/pdf' WHEN page_id % 4 = 2 THEN 'image/png' WHEN filename LIKE '%.pdf' THEN 'application/pdf' WHEN filename LIKE '%.png' THEN 'image/png'
  WHEN filename LIKE '%.jpg' THEN 'image/jpeg' END AS content_type FROM n""")
def response_filenames(t: Tables) -> DataFrame:
    """Names and types of fetched files by their headers, else by their URL."""
    name = files.filename_from_response(F.col("url"), F.col("disposition"))
    return t.sql(_FETCHED).withColumn("filename", name).select(
        "page_id", "filename", files.content_type_of(F.col("served"), F.col("filename")).alias("content_type")
    )
