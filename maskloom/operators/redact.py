"""Text with its personal data removed or replaced, one row in, one row out.

Patterns, terms and lists of names are found, reduced, linked and written over inside the row, so these
plans have no exchange. Spans of a model come as a table and are joined in (``found``, ``apply_spans``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom import schemas as C
from maskloom.functions import patterns as P
from maskloom.functions import phrases as PH
from maskloom.functions import spans as S
from maskloom.functions import tagging as TG


def _check_detectors(categories: Sequence[str] | None, found: DataFrame | None, phrases: DataFrame | None) -> None:
    missing = sorted(set(categories or ()) - set(P.PATTERNS))
    if missing and found is None and phrases is None:
        raise ValueError(f"no pattern finds {', '.join(missing)}: give their spans as found, or their phrases")


def _with_found(docs: DataFrame, found: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """``docs`` with ``_found``: the spans a table holds for each text, which the text bounds."""
    if found is None:
        return docs.withColumn("_found", S.no_spans())
    span = F.struct("start", "end", "category", "surface", "priority")
    grouped = found.select(*keys, span.alias("_span")).groupBy(*keys).agg(F.collect_set("_span").cast(S.SPANS).alias("_found"))
    return docs.join(grouped, list(keys), "left").withColumn("_found", F.coalesce("_found", S.no_spans()))


def _done(docs: DataFrame, form: str, categories: Sequence[str] | None, found: DataFrame | None, keys: Sequence[str],
          phrases: DataFrame | None, lang: Column) -> DataFrame:
    """``docs`` with the spans to remove worked out as ``_done``: patterns, list, table and terms by the rules of each document.

    ``form`` as in ``tagging.all_spans``.
    """
    text, named = F.col("text"), found is not None or phrases is not None
    automaton = None
    if phrases is not None:
        automaton = PH.phrase_automaton(phrases)
        if automaton is None:
            from maskloom.operators import detect

            joined = detect.join_dictionary(docs, phrases, keys)
            found = joined if found is None else found.select(*joined.columns).unionByName(joined)
    # Names of a list need not be chosen where only the patterns are (an empty choice of patterns, say).
    if categories and found is not None:
        found = found.where(F.col("category").isin(list(categories)))
    spanned = _with_found(docs, found, keys)
    none = F.lit(None).cast("array<string>")
    allowed = never = none
    if "pii_categories" in docs.columns:
        allowed = F.col("pii_categories")
        if not named:
            known = F.array(*[F.lit(c) for c in P.PATTERNS])
            allowed = F.when(
                F.size(F.array_except("pii_categories", known)) > 0,
                F.raise_error("a rule chooses a category that no pattern finds: give its spans as found").cast("array<string>"),
            ).otherwise(allowed)
    if "pii_excluded_terms" in docs.columns:
        never = F.col("pii_excluded_terms")
    terms = S.no_spans()
    if "pii_included_terms" in docs.columns:
        terms = S.term_spans(text, S.term_pattern(F.col("pii_included_terms")), C.CUSTOM, S.INCLUDE)
    # Not deterministic as far as the planner knows, so that they stay a column of their own: Spark does not always
    # recognise a Python function again whose arguments are more than columns.
    asked = F.struct(*[value.alias(name) for name, value in zip(TG.ASKED, (text, F.col("_found"), terms, allowed, never, lang))])
    spanned = spanned.withColumn("_asked", F.when(F.sqrt(F.rand()) >= 0, asked))
    return spanned.withColumn("_done", TG.all_spans(F.col("_asked"), categories, automaton, form, named))


def with_spans(docs: DataFrame, categories: Sequence[str] | None = None, found: DataFrame | None = None,
               phrases: DataFrame | None = None, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Adds ``spans``: what to remove from ``text``, in order and apart.

    Rule columns are followed where the documents have them: ``pii_categories`` (NULL is all),
    ``pii_included_terms`` (whole words, always), ``pii_excluded_terms`` (never, unless included).
    """
    _check_detectors(categories, found, phrases)
    return _done(docs, "spans", categories, found, keys, phrases, F.lit("en")).select(*docs.columns, F.col("_done").alias("spans"))


def _has_rules(docs: DataFrame) -> bool:
    return any(c in docs.columns for c in ("pii_categories", "pii_included_terms", "pii_excluded_terms"))


def redact(docs: DataFrame, categories: Sequence[str] | None = None, found: DataFrame | None = None,
           keys: Sequence[str] = ("doc_id",), phrases: DataFrame | None = None) -> DataFrame:
    """``text`` with personal data removed; the mask is of one length, so it does not tell the original's.

    ``phrases`` is a (phrase, category) list and ``found`` a span table of a model, joined by ``keys`` (Person,
    Organization, Address, …); rules and overlaps treat their spans like those of the patterns. A chosen
    category that nothing given can have is an error, never a text left as it was.
    """
    _check_detectors(categories, found, phrases)
    if _has_rules(docs) or found is not None or phrases is not None:
        done = _done(docs, "masked", categories, found, keys, phrases, F.lit("en"))
        return done.withColumn("text", F.col("_done")).select(*docs.columns)
    return docs.withColumn("text", S.rewrite_matches(
        F.col("text"), categories, lambda hit: F.when(P.category_of(hit, categories).isNotNull(), F.lit(S.MASK))
    ))


def pseudonymize(docs: DataFrame, categories: Sequence[str] | None = None, lang: str | None = None,
                 found: DataFrame | None = None, keys: Sequence[str] = ("doc_id",), phrases: DataFrame | None = None) -> DataFrame:
    """``text`` with each entity as a tag, plus ``spans`` with their tags (personal data: keep apart).

    Always-redact terms are no category and stay black. ``phrases`` and ``found`` as in ``redact``. Variants of
    a person's name are one entity (``variants``), other things are where they are spelled alike. An empty
    choice of categories leaves the patterns out.
    """
    _check_detectors(categories, found, phrases)
    language = F.col(lang) if lang else F.lit("en")
    done = _done(docs, "tagged", categories, found, keys, phrases, language)
    done = done.withColumn("text", F.col("_done.text")).withColumn("spans", F.col("_done.spans"))
    return done.select(*docs.columns, *[c for c in ["spans"] if c not in docs.columns])


def apply_spans(docs: DataFrame, spans: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Write over the (resolved) spans of a table: with their ``tag`` if they have one, else the mask."""
    tag = F.col("tag") if "tag" in spans.columns else F.lit(None).cast("string")
    grouped = spans.select(*keys, F.struct("start", "end", tag.alias("tag")).alias("_span")).groupBy(*keys).agg(
        F.array_sort(F.collect_list("_span")).alias("_spans")
    )
    return docs.join(grouped, list(keys), "left").withColumn(
        "text", S.rewrite(F.col("text"), F.col("_spans"), lambda s: F.coalesce(s["tag"], F.lit(S.MASK)))
    ).select(*docs.columns)


def pii_summary(spans: DataFrame) -> DataFrame:
    """Per category: boxes drawn and documents with any. Boxes are counted, not entities."""
    return spans.groupBy("category").agg(
        F.count(F.lit(1)).alias("masks"), F.countDistinct("doc_id").alias("documents")
    )


def pii_rollup(spans: DataFrame, docs: DataFrame) -> DataFrame:
    """Boxes by source, language and category with all subtotals (NULL marks a total)."""
    counted = spans.groupBy("doc_id", "category").agg(F.count(F.lit(1)).alias("_n"))
    return (
        counted.join(docs.select("doc_id", "source", "lang"), "doc_id")
        .rollup("source", "lang", "category")
        .agg(F.sum("_n").alias("masks"), F.grouping_id().alias("level"))
    )
