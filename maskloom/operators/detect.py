"""Where personal data is: by pattern, by a list of names, by a model of your own.

Span tables hold (keys of the text, start, end, category, surface, priority).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom import schemas as C
from maskloom.functions import phrases as PH
from maskloom.functions import spans as S
from maskloom.functions import tagging as TG
from maskloom.functions.titles import TITLES

_TOKEN = r"[\p{L}\p{N}]+"


def detect_patterns(docs: DataFrame, categories: Sequence[str] | None = None, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Span table of the categories with a written form: Email, PhoneNumber, Date, IBAN, CreditCard."""
    return docs.select(*keys, F.inline(TG.find_patterns(F.col("text"), categories)))


def detect_terms(docs: DataFrame, terms: str = "pii_included_terms", keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Span table of the always-redact terms in a column of each document; whole words, case-blind."""
    return docs.where(F.size(terms) > 0).select(
        *keys, F.inline(S.term_spans(F.col("text"), S.term_pattern(F.col(terms)), C.CUSTOM, S.INCLUDE))
    )


def words(text: Column) -> Column:
    """The words of a text in lower case, one blank between them: how phrases are compared."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), F.lower), " ")


def name_phrases(people: DataFrame, name: str = "name") -> DataFrame:
    """Phrases (phrase, category) a person may be named by: full name, initial or title and surname, surname."""
    parts = people.select(F.split(F.trim(F.col(name)), r"\s+").alias("_p")).where(F.size("_p") >= 2)
    surname = F.element_at("_p", -1)
    forms = F.array(
        F.array_join("_p", " "), surname, F.concat(F.left(F.get("_p", 0), F.lit(1)), F.lit(" "), surname),
        *[F.concat(F.lit(f"{t} "), surname) for t in TITLES],
    )
    return parts.select(F.explode(forms).alias("phrase"), F.lit("Person").alias("category")).distinct()


def detect_dictionary(docs: DataFrame, gazetteer: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Span table of the phrases of a (phrase, category) table: Person, Organization, Address, …

    Phrases are compared word by word, so case and what stands between the words do not count. A list
    of bounded size is an automaton run over each text where it lies; the texts may be a stream. A
    larger one is joined (``join_dictionary``), with the same result.
    """
    spans = PH.phrase_spans(gazetteer)
    if spans is None:
        return join_dictionary(docs, gazetteer, keys)
    return docs.select(*keys, F.inline(spans(F.col("text"))))


def join_dictionary(docs: DataFrame, gazetteer: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """As ``detect_dictionary`` for lists of any size.

    Words are first joined with the first words of the phrases, and only those that start one
    become phrases to look up. Both joins are left to the planner: broadcast while the phrases are
    small, else shuffled with skewed words split.
    """
    phrases = gazetteer.select(words(F.col("phrase")).alias("_phrase"), "category").where("_phrase <> ''")
    # One category per phrase, so a word that is both does not double.
    phrases = phrases.groupBy("_phrase").agg(F.min("category").alias("category"))
    phrases = phrases.withColumn("_n", F.size(F.split("_phrase", " ")))
    firsts = phrases.groupBy(F.split_part("_phrase", F.lit(" "), F.lit(1)).alias("_first")).agg(
        F.array_sort(F.collect_set("_n")).alias("_lengths")
    )
    # The longest phrase sets how many words travel with each first word.
    longest = phrases.agg(F.max("_n")).first()[0] or 0
    if longest == 0:
        return docs.select(*keys, F.inline(S.no_spans())).where(F.lit(False))
    # Cut in the row, so that what travels with a word is the few words after it and not the text.
    tokens = S.let(
        F.regexp_extract_all("text", F.lit(_TOKEN), F.lit(0)),
        lambda found: F.when(F.size(found) > 0, S.located(F.col("text"), found, F.lit(_TOKEN))),
    )
    ahead = S.let(tokens, lambda all_: F.transform(all_, lambda t, i: F.struct(
        F.lower(t["hit"]).alias("_first"), F.slice(all_, i + 1, longest).alias("_next")
    )))
    starts = docs.select(*keys, F.inline(ahead))
    tries = starts.join(firsts, "_first").select(
        *keys, "_next", F.explode(F.filter("_lengths", lambda n: n <= F.size("_next"))).alias("_len")
    )
    used = F.slice("_next", 1, F.col("_len"))
    looked = tries.select(
        *keys, used.alias("_used"),
        F.array_join(F.transform(used, lambda t: F.lower(t["hit"])), " ").alias("_phrase"),
    )
    hits = looked.join(phrases.drop("_n"), "_phrase")
    surface = F.array_join(
        F.transform("_used", lambda t, i: F.when(i == 0, t["hit"]).otherwise(F.concat(t["gap"], t["hit"]))), ""
    )
    end = F.element_at("_used", -1)["start"] + F.length(F.element_at("_used", -1)["hit"])
    return hits.select(
        *keys, F.get("_used", 0)["start"].cast("int").alias("start"), end.cast("int").alias("end"), "category",
        surface.alias("surface"), F.lit(S.DETECTED).alias("priority"),
    )


def detect_with(docs: DataFrame, detector: Callable[[str], Sequence[tuple[int, int, str]]],
                keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Span table of a model: ``detector(text)`` gives (start, end, category) for one whole text."""
    schema = T.StructType([docs.schema[k] for k in keys] + T._parse_datatype_string(C.SPAN).fields)
    columns, chosen = [f.name for f in schema.fields], list(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (*row[:-1], start, end, category, row[-1][start:end], S.DETECTED)
                for row in batch[[*chosen, "text"]].itertuples(index=False, name=None)
                if row[-1] is not None
                for start, end, category in detector(row[-1])
            ]
            yield pd.DataFrame(rows, columns=columns)

    return docs.select(*keys, "text").mapInPandas(run, schema)


def resolve_spans(spans: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One span per overlap, over all it covers, with the category of the strongest member.

    ``keys`` must name one text, so a group is never more than the spans of one row's text;
    repeats of a span are dropped before they travel.
    """
    columns = ["start", "end", "category", "surface", "priority"]
    unique = spans.select(*keys, *columns).distinct()
    grouped = unique.groupBy(*keys).agg(F.collect_list(F.struct(*columns)).alias("_spans"))
    return grouped.select(*keys, F.inline(S.reduce_overlaps(F.col("_spans"))))
