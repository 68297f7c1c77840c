"""Documents as pages, and the preview of the first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.operators import redact as R
from maskloom.functions import spans as S

_HEADING = r"(?m)^## Page [0-9]+[ \t]*$\n?"


def split_pages(docs: DataFrame) -> DataFrame:
    """(doc_id, page_no, text …) of texts with ``## Page N`` headings; without any, page 1 is the text.

    What stands before the first heading is page 0. Of the blank lines around a page, those that
    ``assemble_pages`` writes go, others stay.
    """
    text = F.col("text")
    numbers = F.transform(
        F.regexp_extract_all(text, F.lit(r"(?m)^## Page ([0-9]+)[ \t]*$"), F.lit(1)), lambda n: n.cast("int")
    )
    bodies = F.transform(F.split(text, _HEADING, -1), lambda t, i: F.when(
        i < F.size(numbers), F.regexp_replace(F.when(i > 0, F.regexp_replace(t, r"^\n", "")).otherwise(t), r"\n{1,2}\z", "")
    ).otherwise(F.regexp_replace(t, r"^\n|\n\z", "")))
    pages = F.when(
        F.size(numbers) > 0,
        S.let(bodies, lambda all_: F.filter(
            F.zip_with(F.concat(F.array(F.lit(0)), numbers), all_, lambda n, t: F.struct(n.alias("page_no"), t.alias("text"))),
            lambda p, i: (i > 0) | (p["text"].rlike(r"\S")),
        )),
    ).otherwise(F.array(F.struct(F.lit(1).alias("page_no"), text.alias("text"))))
    others = [c for c in docs.columns if c != "text"]
    return docs.select(*others, F.inline(pages))


# Pages of one volume of an assembled text.
VOLUME = 10_000


def assemble_pages(pages: DataFrame, volume: int = VOLUME) -> DataFrame:
    """(doc_id, volume, text): the pages in order under their headings.

    Documents of up to ``volume`` pages are one text; longer ones go on in further volumes, so no
    group or value grows without bound.
    """
    joined = F.array_sort(F.collect_list(F.struct("page_no", "text")))
    with_headings = F.transform(
        joined, lambda p: F.concat(F.when(p["page_no"] > 0, F.concat(F.lit("## Page "), p["page_no"], F.lit("\n\n"))).otherwise(""), p["text"], F.lit("\n"))
    )
    part = F.floor(F.greatest(F.col("page_no") - 1, F.lit(0)) / volume).alias("volume")
    return pages.groupBy("doc_id", part).agg(F.array_join(with_headings, "\n").alias("text"))


def first_page_preview(pages: DataFrame, mode: str = "redact", lang: str | None = None) -> DataFrame:
    """Only page 1 done: text, total_pages, redacted_pages, masks by category, tags in tag order."""
    totals = pages.groupBy("doc_id").agg(F.count_if(F.col("page_no") > 0).alias("total_pages"))
    done = R.pseudonymize(pages.where("page_no = 1").withColumn("_original", F.col("text")), lang=lang)
    if mode == "redact":
        done = done.withColumn("text", S.rewrite(F.col("_original"), F.col("spans"), lambda s: F.lit(S.MASK)))
    categories = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["category"])))
    detected = F.transform(
        categories,
        lambda c: F.struct(
            c.alias("category"), F.size(F.filter("spans", lambda s: s["category"] == c)).alias("masks")
        ),
    )
    number = lambda t: F.regexp_extract(t, r" ([0-9]+)\]$", 1).cast("int")
    tags = F.array_distinct(F.filter(F.transform("spans", lambda s: s["tag"]), lambda t: t.isNotNull()))
    ordered = F.transform(
        F.array_sort(F.transform(
            tags, lambda t: F.struct(F.regexp_replace(t, r" [0-9]+\]$", "").alias("l"), number(t).alias("n"), t.alias("t"))
        )),
        lambda t: t["t"],
    )
    return done.join(totals, "doc_id").select(
        "doc_id", "text", "total_pages", F.lit(1).alias("redacted_pages"), detected.alias("detected_pii"),
        (F.lit(None).cast("array<string>") if mode == "redact" else ordered).alias("tags"),
    )
