"""Word documents as tables of parts (file_id, part, xml) and of text runs.

A tag may be cut over several runs, so tags are looked for in the joined text of a part. A part is
one value of the table, which bounds its runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.functions import spans as S
from maskloom.operators import restore as R

# Which parts hold text, and how a run is written.
TEXT_PART = r"^word/(document|header\d*|footer\d*|footnotes|endnotes|comments)\.xml$"
MAIN_PART = "word/document.xml"
_RUN = r"<w:t(\s[^>]*)?>([^<]*)</w:t>"
_KEYS = ["file_id", "part"]

# Runs and hits meet by position in stretches of this many characters.
_STRETCH = 1024

# The named entities, and how any entity is written.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'"}
_ENTITY = r"&(?:#x[0-9a-fA-F]+|#[0-9]+|amp|lt|gt|quot|apos);"


def decode_xml(text: Column) -> Column:
    """Named and numeric entities to characters, in one pass so ``&amp;lt;`` stays ``&lt;``."""
    entity = F.lit(_ENTITY)

    def char(ref: Column) -> Column:
        named = F.when(ref == "&amp;", "&")
        for name, value in ENTITIES.items():
            named = named.when(ref == name, value)
        number = F.when(ref.startswith("&#x"), F.conv(F.regexp_extract(ref, "x([0-9a-fA-F]+)", 1), 16, 10)).otherwise(
            F.regexp_extract(ref, "([0-9]+)", 1)
        )
        # A code point as UTF-32 bytes reads back as its character.
        bytes4 = F.unhex(F.lpad(F.hex(number.try_cast("bigint")), 8, "0"))
        return F.when(ref.startswith("&#"), F.decode(bytes4, "UTF-32")).otherwise(named)

    found = F.regexp_extract_all(text, entity, F.lit(0))
    pieces = F.zip_with(F.split(text, entity, -1), found, lambda gap, ref: F.concat(gap, F.coalesce(char(ref), F.lit(""))))
    return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)


def encode_xml(text: Column) -> Column:
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def extract_runs(parts: DataFrame) -> DataFrame:
    """(file_id, part, run_no, attrs, text): the runs of the parts a reader sees, in order."""
    xml = F.col("xml")
    runs = F.arrays_zip(
        F.regexp_extract_all(xml, F.lit(_RUN), F.lit(1)).alias("attrs"),
        F.regexp_extract_all(xml, F.lit(_RUN), F.lit(2)).alias("raw"),
    )
    return parts.where(F.col("part").rlike(TEXT_PART)).select(*_KEYS, F.posexplode(runs).alias("run_no", "_r")).select(
        *_KEYS, "run_no", F.col("_r.attrs").alias("attrs"), decode_xml(F.col("_r.raw")).alias("text")
    )


def _joined(runs: DataFrame) -> DataFrame:
    """Per part: its text and where each run starts in it."""
    ordered = F.array_sort(F.collect_list(F.struct("run_no", "text")))
    parts = runs.groupBy(*_KEYS).agg(ordered.alias("_runs"))
    starts = S.running_starts(F.transform("_runs", lambda r: F.length(r["text"])))
    return parts.withColumn("_starts", starts).withColumn(
        "text", F.array_join(F.transform("_runs", lambda r: r["text"]), "")
    )


def _stretches(start: Column, end: Column) -> Column:
    return F.sequence(F.floor(start / _STRETCH), F.floor(F.greatest(end - 1, start) / _STRETCH))


def restore_runs(runs: DataFrame, table: DataFrame, key: str = "file_id") -> DataFrame:
    """Runs after restore, with ``changed``: the original goes where its tag starts, the rest of the tag goes."""
    parts = _joined(runs)
    hits = R.text_hits(R.tag_rows(parts.select(*_KEYS, "text"), table, _KEYS, key), _KEYS)
    hit_rows = hits.select(*_KEYS, F.inline("hits")).withColumn(
        "_stretch", F.explode(_stretches(F.col("start"), F.col("end")))
    )
    placed = parts.select(
        *_KEYS, F.inline(F.arrays_zip(F.col("_runs").alias("run"), F.col("_starts").alias("at")))
    ).select(*_KEYS, "run.run_no", "at", (F.col("at") + F.length("run.text")).alias("_to"))
    # Runs without text are touched only inside a tag; they have nothing to give up.
    stretched = placed.where("_to > at").withColumn("_stretch", F.explode(_stretches(F.col("at"), F.col("_to"))))
    met = stretched.join(hit_rows, [*_KEYS, "_stretch"]).where((F.col("start") < F.col("_to")) & (F.col("end") > F.col("at")))
    local = F.struct(
        F.greatest(F.col("start") - F.col("at"), F.lit(0)).alias("start"),
        (F.least("end", "_to") - F.col("at")).alias("end"),
        F.when(F.col("start") >= F.col("at"), F.col("original")).otherwise("").alias("original"),
    )
    changes = met.groupBy(*_KEYS, "run_no").agg(F.array_sort(F.collect_set(local)).alias("_changes"))
    joined = runs.join(changes, [*_KEYS, "run_no"], "left")
    return joined.select(
        *_KEYS, "run_no", "attrs",
        S.rewrite(F.col("text"), F.col("_changes"), lambda c: c["original"]).alias("text"),
        F.col("_changes").isNotNull().alias("changed"),
    )


def rebuild_part_xml(parts: DataFrame, runs: DataFrame) -> DataFrame:
    """Parts with the changed runs written in; all else keeps its bytes."""
    keeps_space = F.col("attrs").contains("xml:space=")
    attrs = F.when(keeps_space, F.col("attrs")).otherwise(F.concat("attrs", F.lit(' xml:space="preserve"')))
    node = F.concat(F.lit("<w:t"), attrs, F.lit(">"), encode_xml(F.col("text")), F.lit("</w:t>"))
    written = runs.groupBy(*_KEYS).agg(
        F.array_sort(F.collect_list(F.struct("run_no", F.when(F.col("changed"), node).alias("node")))).alias("_nodes"),
        F.bool_or("changed").alias("_any"),
    ).where("_any")
    joined = parts.join(written, _KEYS, "left")
    old = F.regexp_extract_all(F.col("xml"), F.lit(_RUN), F.lit(0))
    new = F.zip_with(F.col("_nodes"), old, lambda n, was: F.coalesce(n["node"], was))
    pieces = F.zip_with(F.split(F.col("xml"), _RUN, -1), new, lambda gap, n: F.concat(gap, F.coalesce(n, F.lit(""))))
    return joined.withColumn("xml", F.when(F.col("_any"), F.array_join(pieces, "")).otherwise(F.col("xml"))).select(
        *parts.columns
    )


def restore_report(parts: DataFrame, table: DataFrame, key: str = "file_id") -> DataFrame:
    """Per file: status, replacements, tags_restored and the tags left, never an original.

    Replacements add up over the parts, tags count once per file; a file without a main part is refused.
    """
    main = parts.groupBy("file_id").agg(F.bool_or(F.col("part") == MAIN_PART).alias("_is_word"))
    texts = _joined(extract_runs(parts)).select(*_KEYS, "text")
    per_part = R.text_hits(R.tag_rows(texts, table, _KEYS, key), _KEYS)
    rows = per_part.select(
        "file_id", F.size("hits").alias("_n"),
        F.transform("hits", lambda h: h["tag"]).alias("_tags"), "unresolved_tags", "ambiguous_tags",
    )
    one = rows.select("file_id", "_n", F.explode_outer(
        F.concat(
            F.transform("_tags", lambda t: F.struct(F.lit("restored").alias("kind"), t.alias("tag"))),
            F.transform("unresolved_tags", lambda t: F.struct(F.lit("unresolved").alias("kind"), t.alias("tag"))),
            F.transform("ambiguous_tags", lambda t: F.struct(F.lit("ambiguous").alias("kind"), t.alias("tag"))),
        )
    ).alias("_t"))
    tags = one.groupBy("file_id").agg(
        F.countDistinct(F.when(F.col("_t.kind") == "restored", F.col("_t.tag"))).alias("tags_restored"),
        F.array_sort(F.collect_set(F.when(F.col("_t.kind") == "unresolved", F.col("_t.tag")))).alias("unresolved_tags"),
        F.array_sort(F.collect_set(F.when(F.col("_t.kind") == "ambiguous", F.col("_t.tag")))).alias("ambiguous_tags"),
    )
    counts = rows.groupBy("file_id").agg(F.sum("_n").alias("replacements"))
    none = F.array().cast("array<string>")
    ok = F.col("_is_word")
    return main.join(counts, "file_id", "left").join(tags, "file_id", "left").select(
        "file_id", F.when(ok, "restored").otherwise("invalid_request").alias("status"),
        F.when(ok, F.coalesce("replacements", F.lit(0))).alias("replacements"),
        F.when(ok, F.coalesce("tags_restored", F.lit(0))).alias("tags_restored"),
        F.when(ok, F.coalesce("unresolved_tags", none)).alias("unresolved_tags"),
        F.when(ok, F.coalesce("ambiguous_tags", none)).alias("ambiguous_tags"),
    )
