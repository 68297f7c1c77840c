"""Mentions to entities, entities to tags, tags to the table that gives the originals back.

A mention table holds (doc_id, pos, category, surface …); ``pos`` orders the mentions of a
document over all its pages, so documents of any number of pages share one numbering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom import schemas as C
from maskloom.functions import labels as L
from maskloom.functions import patterns as P
from maskloom.functions import tagging as TG
from maskloom.functions.titles import TITLES
from maskloom.operators import ordered, redact


def parse_name(surface: Column) -> Column:
    """``struct(given, initial, surname, full)`` of a person's mention; NULL given for a bare surname."""
    plain = F.trim(F.regexp_replace(surface, r"^(?:" + "|".join(TITLES) + r")(?:\.\s*|\s+)(?=\S)", ""))
    parts = F.split(plain, r"\s+")
    first = F.when(F.size(parts) > 1, F.get(parts, 0))
    is_initial = F.coalesce(first.rlike(r"^\p{L}\.?$"), F.lit(False))
    surname = F.lower(F.element_at(parts, -1))
    given = F.when(first.isNotNull() & ~is_initial, F.lower(F.array_join(F.slice(parts, 1, F.size(parts) - 1), " ")))
    return F.struct(
        given.alias("given"), F.lower(F.left(first, F.lit(1))).alias("initial"), surname.alias("surname"),
        F.when(given.isNotNull(), F.concat(given, F.lit(" "), surname)).alias("full"),
    )


def link_mentions(mentions: DataFrame, width: int = ordered.WIDTH) -> DataFrame:
    """Adds ``entity``: variants of a name share one.

    Full names are entities. A surname, alone or after a title, is the full name with that surname
    mentioned last before it (else the first one after); with an initial, only a full name whose
    given name starts so. What fits no full name is an entity of its own.
    """
    parsed = mentions.withColumn("_name", F.when(F.col("category") == "Person", parse_name(F.col("surface"))))
    people = parsed.where(F.col("category") == "Person").select(
        *mentions.columns, F.col("_name.surname").alias("_surname"),
        F.coalesce("_name.initial", F.lit("")).alias("_initial"), F.col("_name.full").alias("_full"),
    )
    people = ordered.as_of(people, ["doc_id", "_surname"], "pos", F.col("_full"), "_by_surname", width)
    people = ordered.as_of(people, ["doc_id", "_surname", "_initial"], "pos", F.col("_full"), "_by_initial", width)
    alone = F.trim(F.concat_ws(" ", F.nullif(F.col("_initial"), F.lit("")), F.col("_surname")))
    entity = F.coalesce(
        F.col("_full"),
        F.when(F.col("_initial") == "", F.col("_by_surname"))
        # "M. Keller" may be an initial or the French title.
        .when(F.col("_initial") == "m", F.coalesce("_by_initial", "_by_surname"))
        .otherwise(F.col("_by_initial")),
        alone,
    )
    others = mentions.where(F.col("category") != "Person").withColumn(
        "entity", P.entity_key(F.col("category"), F.col("surface"))
    )
    return people.select(*mentions.columns, entity.alias("entity")).unionByName(others)


def assign_tags(mentions: DataFrame, width: int = ordered.WIDTH) -> DataFrame:
    """One row per entity: (doc_id, category, entity, first_pos, number), numbered from 1 per category.

    Entities are numbered in order of first mention, over all pages of a document.
    """
    tagged = mentions.where(F.col("category") != C.CUSTOM)
    entities = tagged.groupBy("doc_id", "category", "entity").agg(F.min("pos").alias("first_pos"))
    return ordered.numbered(entities, ["doc_id", "category"], "first_pos", "number", width)


def localise_labels(tags: DataFrame, langs: DataFrame) -> DataFrame:
    """Adds ``tag`` in the language of the document ((doc_id, lang) table; English if unknown)."""
    spoken = tags.join(langs.select("doc_id", "lang"), "doc_id", "left")
    return spoken.withColumn("tag", L.tag(F.col("category"), F.coalesce("lang", F.lit("en")), F.col("number")))


def tag_mentions(mentions: DataFrame, tags: DataFrame) -> DataFrame:
    """Each mention with the tag of its entity."""
    return mentions.join(tags.select("doc_id", "category", "entity", "tag"), ["doc_id", "category", "entity"], "left")


def pseudonymize_names(docs: DataFrame, phrases: DataFrame, lang: str | None = None) -> DataFrame:
    """Documents with what a (phrase, category) list names as tags, variants of a person under one."""
    return redact.pseudonymize(docs, [], lang, phrases=phrases).select(*docs.columns)


def document_mentions(tagged_docs: DataFrame) -> DataFrame:
    """Mentions (doc_id, pos, category, surface, entity, tag) out of ``pseudonymize``'s spans."""
    mentions = F.transform(
        F.filter("spans", lambda s: s["tag"].isNotNull()),
        lambda s: F.struct(
            s["start"].alias("pos"), s["category"].alias("category"), s["surface"].alias("surface"),
            s["key"].alias("entity"), s["tag"].alias("tag"),
        ),
    )
    return tagged_docs.select("doc_id", F.inline(mentions))


def correspondence_table(mentions: DataFrame) -> DataFrame:
    """(doc_id, placeholder, label, category, original): the original is the longest form, the first of these."""
    longest = F.max_by("surface", F.struct(F.length("surface"), -F.col("pos")))
    return mentions.groupBy("doc_id", F.col("tag").alias("placeholder")).agg(
        F.min("category").alias("category"), longest.alias("original")
    ).select("doc_id", "placeholder", F.lit("").alias("label"), "category", "original")


def pattern_mentions(docs: DataFrame, lang: str) -> DataFrame:
    """Of ``document_mentions`` of the documents tagged by patterns alone, all that ``correspondence_table`` needs.

    A tag comes once per row, with its longest form; nothing is written and no text travels.
    """
    found = docs.select("doc_id", TG.pattern_entities(F.col("text"), F.col(lang)).alias("_found"))
    return found.select("doc_id", F.inline("_found"))


def apply_renames(table: DataFrame, renames: DataFrame) -> DataFrame:
    """Fill ``label`` from a (doc_id, placeholder, label) table; either column restores."""
    named = renames.groupBy("doc_id", "placeholder").agg(F.max("label").alias("_label"))
    joined = table.join(named, ["doc_id", "placeholder"], "left")
    return joined.withColumn("label", F.coalesce("_label", "label")).select(*table.columns)


def unrestorable_tags(table: DataFrame) -> DataFrame:
    """Tags without a stored original."""
    return table.where(F.coalesce("original", F.lit("")) == "").select("doc_id", "placeholder", "label", "category")


def unrestorable_mentions(mentions: DataFrame) -> DataFrame:
    """``unrestorable_tags`` of the table of these mentions, whose surface is NULL or empty where it was not stored.

    Lengths are all that is added up, so originals do not travel and tags are counted by hash, not sorted. Each
    category of a tag counts apart; the labels give no tag two of them, so the rows are the table's.
    """
    lengths = mentions.groupBy("doc_id", F.col("tag").alias("placeholder"), "category").agg(
        F.max(F.coalesce(F.length("surface"), F.lit(0))).alias("_length")
    )
    return lengths.where("_length = 0").select("doc_id", "placeholder", F.lit("").alias("label"), "category")


def export_masks(spans: DataFrame) -> DataFrame:
    """Detected spans as the masks a person may review: (doc_id, start, end, category, surface, entity)."""
    key = P.entity_key(F.col("category"), F.col("surface"))
    return spans.select("doc_id", "start", "end", "category", "surface", key.alias("entity"))


def apply_review(masks: DataFrame, decisions: DataFrame) -> DataFrame:
    """Masks (doc_id, start, end, category, surface, entity) after a person's review.

    Decisions (doc_id, start, end, action, category, surface, entity): ``remove`` drops a mask,
    ``add`` brings a new one, ``merge`` and ``split`` give a mask another entity. Number the tags
    again afterwards.
    """
    place = ["doc_id", "start", "end"]
    decided = decisions.where("action IN ('remove', 'merge', 'split')").groupBy(*place).agg(
        F.max(F.when(F.col("action") != "remove", F.col("entity"))).alias("_entity"),
        F.max(F.col("action") == "remove").alias("_removed"),
    )
    left = masks.join(decided, place, "left").where(~F.coalesce("_removed", F.lit(False)))
    kept = left.withColumn("entity", F.coalesce("_entity", "entity")).select(*masks.columns)
    added = decisions.where("action = 'add'").select(*masks.columns).distinct()
    return kept.unionByName(added)
