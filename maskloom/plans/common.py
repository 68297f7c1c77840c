"""How queries are registered, and the inputs derived from the tables.

Inputs that the tables do not hold (notes with names, jobs, reads, …) are written once in SQL that
both engines read, so a query and its check start from the same rows; what is checked is then
computed twice, by the operators here and by an independent SQL formulation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.functions import patterns as P
from maskloom.session import tune
from maskloom.sources.documents import read_documents, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


class Tables:
    """The tables of a folder, read when asked for; ``sql`` derives inputs from them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = tune(spark), sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return read_documents(self.spark, f"{self.sf_dir}/{name}.parquet")

    def texts(self, name: str, key: str, *columns: str) -> DataFrame:
        """A text table with only the columns needed, over all cores while it is small."""
        return spread(getattr(self, name).select(key, *columns), key)

    def notes(self) -> DataFrame:
        """The composed notes, over all cores while they are few."""
        return spread(self.sql(NOTES), "doc_id")

    def sql(self, text: str) -> DataFrame:
        used = {name: getattr(self, name) for name in TABLES if "{" + name + "}" in text}
        return self.spark.sql(text, **used)


def checked(text: str) -> str:
    """The same SQL for the checking engine, where tables go by their names."""
    for name in TABLES:
        text = text.replace("{" + name + "}", name)
    return text


def plain(df: DataFrame) -> DataFrame:
    """Values as two engines compare them: whole numbers as BIGINT, times as microseconds, lists as text."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.unix_micros(column.cast("timestamp"))
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), ",")
        out.append(column.alias(field.name))
    return df.select(*out)


def query(sql: str | None = None):
    """Register a query by its function's name; without SQL only its rows are checked."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[build.__name__] = lambda spark, sf_dir: plain(build(Tables(spark, sf_dir)))
        if sql is not None:
            ORACLES[build.__name__] = checked(sql)
        return build

    return register


def quoted(text: str) -> str:
    return text.replace("'", "''")


# ---- Inputs -------------------------------------------------------------------------------------

_GIVEN = "split_part('Anna,Jean,Maria,Paul,Laura,Peter,Sofia,Hugo', ',', CAST({k} % 8 AS INT) + 1)"
_SURNAME = "split_part('Keller,Marsh,Diaz,Weber,Moreau,Smith,Okafor', ',', CAST({k} % 7 AS INT) + 1)"


def given(key: str) -> str:
    return _GIVEN.replace("{k}", key)


def surname(key: str) -> str:
    return _SURNAME.replace("{k}", key)


# One note per order: a customer with mail, phone, date, card (one in ten passes its check) and an
# account number (every other one does), written by name in several ways.
NOTES = f"""
SELECT o_orderkey AS doc_id,
  split_part('en,fr,de,es', ',', CAST(o_orderkey % 4 AS INT) + 1) AS lang,
  'Order of ' || CAST(CAST(o_orderdate AS DATE) AS STRING) || ' for {{full}} (mail '
    || lower({given('c_custkey')}) || CAST(c_custkey AS STRING) || '@mail' || CAST(c_custkey % 5 AS STRING) || '.example.com, phone +1 ('
    || CAST(200 + c_custkey % 700 AS STRING) || ') 555-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') || ').'
    || ' Card ' || lpad(CAST(400000000000000 + (o_orderkey * 7919) % 99999999 AS STRING), 15, '0') || CAST(o_orderkey % 10 AS STRING)
    || ', account DE' || CASE WHEN o_orderkey % 2 = 0 THEN lpad(CAST(98 - (((c_custkey % 97) * 62 + 131400 % 97) % 97) AS STRING), 2, '0') ELSE '00' END
    || lpad(CAST(c_custkey AS STRING), 18, '0')
    || '. ' || split_part('Mr,Ms,Dr', ',', CAST(o_orderkey % 3 AS INT) + 1) || ' ' || {surname('c_custkey')}
    || ' of NATION_' || CAST(c_nationkey AS STRING) || ' wrote to ' || lower({given('c_custkey')}) || CAST(c_custkey AS STRING)
    || '@mail' || CAST(c_custkey % 5 AS STRING) || '.example.com again.' AS text
FROM {{orders}}, {{customer}} WHERE o_custkey = c_custkey
""".replace("{full}", f"' || {given('c_custkey')} || ' ' || {surname('c_custkey')} || '")

# Mentions of people in an order: suppliers by full name, title, initial or bare surname.
MENTIONS = f"""
SELECT l_orderkey AS doc_id, CAST(l_linenumber AS BIGINT) AS pos, 'Person' AS category,
  CASE CAST((l_partkey + l_linenumber) % 4 AS INT)
    WHEN 0 THEN {given('l_suppkey')} || ' ' || {surname('l_suppkey % 3')}
    WHEN 1 THEN 'Ms ' || {surname('l_suppkey % 3')}
    WHEN 2 THEN substr({given('l_suppkey')}, 1, 1) || '. ' || {surname('l_suppkey % 3')}
    ELSE {surname('l_suppkey % 3')} END AS surface
FROM (SELECT l_orderkey, l_partkey, l_suppkey,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS BIGINT) AS l_linenumber FROM {{lineitem}}) AS lines
"""

PATTERN = P.pattern(portable=True)


def hits_sql(source: str, keys: str = "doc_id", text: str = "text") -> str:
    """CTEs ``found`` and ``spans`` (keys, i, gap, hit, first, category) of all pattern matches of a source."""
    pat = quoted(PATTERN)
    date, card = quoted(P.PATTERNS["Date"]), quoted(P.PATTERNS["CreditCard"])
    return f"""
found AS (
  SELECT {keys}, regexp_extract_all({text}, '{pat}') AS hits, string_split_regex({text}, '{pat}') AS gaps
  FROM ({source}) AS src WHERE regexp_matches({text}, '[0-9@]')),
placed AS (
  SELECT {keys}, unnest(hits) AS hit, unnest(gaps[:len(hits)]) AS gap, generate_subscripts(hits, 1) AS i
  FROM found WHERE len(hits) > 0),
formed AS (
  SELECT *, regexp_replace(hit, '[ -]', '', 'g') AS digits,
    sum(length(gap) + length(hit)) OVER (PARTITION BY {keys} ORDER BY i) - length(hit) AS first,
    CASE WHEN contains(hit, '@') THEN 'Email'
         WHEN regexp_matches(hit, '^[A-Z]{{2}}[0-9]') THEN 'IBAN'
         WHEN regexp_full_match(hit, '{date}') THEN 'Date'
         WHEN regexp_full_match(hit, '{card}') THEN 'CreditCard' ELSE 'PhoneNumber' END AS kind
  FROM placed),
spans AS (
  SELECT {keys}, i, gap, hit, CAST(first AS BIGINT) AS first, CASE
    WHEN kind = 'CreditCard' THEN CASE WHEN length(digits) <= 19 AND list_sum(list_transform(range(1, length(digits) + 1),
      lambda p: CASE WHEN (length(digits) - p) % 2 = 1
        THEN (CAST(digits[p] AS INT) * 2) % 10 + (CAST(digits[p] AS INT) * 2) // 10 ELSE CAST(digits[p] AS INT) END)) % 10 = 0
      THEN kind END
    WHEN kind = 'IBAN' THEN CASE WHEN length(digits) BETWEEN 15 AND 34 AND list_reduce(
      list_transform(string_split(digits[5:] || digits[:4], ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN CAST(ascii(c) - 48 AS BIGINT)
        ELSE CAST(ascii(c) - 55 AS BIGINT) END), lambda a, b: (a * (CASE WHEN b > 9 THEN 100 ELSE 10 END) + b) % 97) = 1
      THEN kind END
    ELSE kind END AS category
  FROM formed)"""


KEY_SQL = """CASE WHEN category IN ('PhoneNumber', 'CreditCard') THEN regexp_replace(hit, '[^0-9+]', '', 'g')
  WHEN category = 'IBAN' THEN upper(replace(hit, ' ', '')) ELSE lower(trim(hit)) END"""


def rewritten_sql(source: str, replacement: str, keys: str = "doc_id", spans: str = "spans") -> str:
    """CTE ``rewritten`` (keys, text): every span's hit as ``replacement`` (SQL; NULL keeps it)."""
    on = " AND ".join(f"w.{k.strip()} = src.{k.strip()}" for k in keys.split(","))
    found_on = " AND ".join(f"w.{k.strip()} = f.{k.strip()}" for k in keys.split(","))
    return f"""
woven AS (SELECT {keys}, string_agg(gap || coalesce({replacement}, hit), '' ORDER BY i) AS body FROM {spans} GROUP BY {keys}),
ended AS (SELECT w.*, f.gaps[len(f.hits) + 1] AS tail FROM woven AS w JOIN found AS f ON {found_on}),
rewritten AS (SELECT src.* EXCLUDE (text), coalesce(w.body || w.tail, src.text) AS text
  FROM ({source}) AS src LEFT JOIN ended AS w ON {on})"""
