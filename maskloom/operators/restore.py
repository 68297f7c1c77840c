"""Originals put back into texts that carry tags; only tags and counts are ever reported.

Tags are looked up, not searched for: every bracketed candidate of a text is looked up among the tags of its
document, in one call of Python where these are few and by a join where they are many. So a table of any number of tags costs a join and never becomes one pattern, one
map or one group, and a tag that a third of all texts use is a skewed join key, which is split.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import lru_cache
from itertools import pairwise

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.functions import files, grams
from maskloom.functions import spans as S

# "[...]" without brackets or backslashes inside; either bracket may carry a Markdown backslash.
_BRACKETED = r"\\?\[[^\[\]\\]++\\?\]"
# Fixed value: what a default tag looks like inside its brackets.
TAG_SHAPE = r"^\p{L}[\p{L}\p{M}.' -]{0,40} \d{1,4}$"

CANDIDATE = "struct<start:int,end:int,tag:string,plain:boolean>"


def is_tag(value: Column) -> Column:
    return (F.length(value) > 2) & value.startswith("[") & value.endswith("]")


# Tags with brackets or backslashes inside, which the bracket scan cannot see.
_NESTED = r"[\[\]\\]"


def _inner(tag: Column) -> Column:
    return F.substr(tag, F.lit(2), F.length(tag) - 2)


def candidates(text: Column, nested_lengths: Column) -> Column:
    """Places of a text that may be a tag: (start, end, tag, plain = it stands there unescaped).

    ``nested_lengths`` are the lengths of tags the bracket scan cannot see; these are tried at every "[".
    """
    none = F.array().cast(f"array<{CANDIDATE}>")
    scanned = S.let(
        F.regexp_extract_all(text, F.lit(_BRACKETED), F.lit(0)),
        lambda found: F.when(
            F.size(found) > 0,
            F.transform(S.located(text, found, F.lit(_BRACKETED)), lambda p: _candidate(p["start"], p["hit"])),
        ).otherwise(none),
    )
    opening = F.lit(r"\\?\[")
    places = S.let(F.regexp_extract_all(text, opening, F.lit(0)), lambda found: S.located(text, found, opening))
    tries = F.flatten(F.transform(
        places, lambda p: F.transform(nested_lengths, lambda n: _nested_candidate(text, p["start"], p["hit"], n))
    ))
    nested = F.filter(tries, lambda c: c["tag"].isNotNull())
    return F.concat(scanned, F.when(F.size(nested_lengths) > 0, nested).otherwise(none))


def _candidate(start: Column, raw: Column) -> Column:
    tag = F.replace(raw, F.lit("\\"), F.lit(""))
    return F.struct(
        start.cast("int").alias("start"), (start + F.length(raw)).cast("int").alias("end"), tag.alias("tag"),
        raw.endswith(tag).alias("plain"),
    )


def _nested_candidate(text: Column, start: Column, opening: Column, length: Column) -> Column:
    """The tag of that length at a "[", its NULL if nothing closes it there."""
    after = start + F.length(opening)
    inner = F.substr(text, after + 1, length - 2)
    closing = F.substr(text, after + length - 1, F.lit(2))
    plain = closing.startswith("]")
    fits = (plain | (closing == "\\]")) & inner.rlike(_NESTED)
    return F.struct(
        start.cast("int").alias("start"),
        (after + length - F.when(plain, 1).otherwise(0)).cast("int").alias("end"),
        F.when(fits, F.concat(F.lit("["), inner, F.lit("]"))).alias("tag"),
        plain.alias("plain"),
    )


def prepare_lookup(table: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per tag a table names: (key, tag, original, state).

    Placeholder and label both restore. ``state`` is known (one original), ambiguous (several
    different ones) or missing (none stored); ``original`` is set for known tags only.
    """
    original = F.nullif(F.col("original"), F.lit(""))
    named = table.select(key, original.alias("_original"), F.explode(F.array("placeholder", "label")).alias("tag"))
    tags = named.where(is_tag(F.col("tag"))).groupBy(key, "tag").agg(
        F.min("_original").alias("_least"), F.max("_original").alias("_most")
    )
    state = F.when(F.col("_least").isNull(), "missing").when(F.col("_least") == F.col("_most"), "known").otherwise("ambiguous")
    # Backslashes are taken for escapes when a tag is read back, so a tag with one inside never restores.
    restores = (state == "known") & ~F.col("tag").contains("\\")
    return tags.select(key, "tag", F.when(restores, F.col("_least")).alias("original"), state.alias("state"))


def _nested_lengths(lookup: DataFrame, key: str) -> DataFrame:
    """Lengths of the tags the bracket scan cannot see, for the documents that have any: a few small numbers."""
    nested = lookup.where(_inner(F.col("tag")).rlike(_NESTED)).select(key, F.length("tag").alias("_n")).distinct()
    return nested.groupBy(key).agg(F.collect_list("_n").alias("_nested"))


def _candidate_rows(texts: DataFrame, lengths: DataFrame, keys: Sequence[str], key: str) -> DataFrame:
    """Candidates of the texts."""
    extra = [key] if key not in keys else []
    joined = texts.select(*keys, *extra, "text").join(lengths, key, "left")
    nested = F.coalesce("_nested", F.array().cast("array<int>"))
    return joined.select(*keys, *extra, F.inline(S.let(nested, lambda n: candidates(F.col("text"), n))))


def tag_rows(texts: DataFrame, table: DataFrame, keys: Sequence[str] = ("doc_id",), key: str = "doc_id") -> DataFrame:
    """Every candidate of the texts with what its document's table says.

    Columns: keys, start, end, tag, original (NULL unless it restores), report (unresolved,
    ambiguous or NULL). What occurs inside an original is never reported: it may be a name.
    """
    lookup = prepare_lookup(table, key)
    lengths = _nested_lengths(lookup, key)
    originals = table.where(F.col("original").contains("[")).select(key, F.col("original").alias("text"))
    inside = _candidate_rows(originals, lengths, [key], key).where("plain").select(key, "tag").distinct()
    known = lookup.join(inside.withColumn("_inside", F.lit(True)), [key, "tag"], "full_outer")
    found = _candidate_rows(texts, lengths, keys, key)
    joined = found.join(known, [key, "tag"], "left")
    # Reported: tag-shaped text, and tags the table names if they are there unescaped.
    seen = _inner(F.col("tag")).rlike(TAG_SHAPE) | (F.col("state").isNotNull() & F.col("plain"))
    open_ = (F.coalesce("state", F.lit("none")) != "known") & F.col("_inside").isNull() & seen
    report = F.when(open_, F.when(F.col("state") == "ambiguous", "ambiguous").otherwise("unresolved"))
    return joined.select(*keys, "start", "end", "tag", "original", report.alias("report"))


def _leftmost(hits: Column) -> Column:
    """Hits apart, leftmost first and the longest at one place.

    Only hits of one run, each of which starts before the others of it have ended, are weighed against each
    other; runs are found in one pass.
    """
    inorder = F.array_sort(
        hits, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"])
    )

    def apart(ordered: Column) -> Column:
        reach = S.scanned(F.transform(ordered, lambda h: h["end"]), "int", F.greatest)
        return S.let(reach, lambda ends: S.let(S._group_starts(ordered, ends), lambda firsts: F.flatten(F.transform(
            firsts, lambda first, g: _chain(F.slice(ordered, first + 1, F.coalesce(F.get(firsts, g + 1), F.size(ordered)) - first))
        ))))

    return S.let(inorder, lambda ordered: F.when(S.any_touch(ordered), apart(ordered)).otherwise(ordered))


def _chain(run: Column) -> Column:
    """Of hits that hang together, those met when each is followed by the first that starts behind it."""
    shape = "array<struct<start:int,end:int,tag:string,original:string>>"
    return F.aggregate(run, F.array().cast(shape), lambda acc, h: F.when(
        (F.size(acc) == 0) | (h["start"] >= F.try_element_at(acc, F.lit(-1))["end"]), F.array_append(acc, h)
    ).otherwise(acc))


def text_hits(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per text: ``hits`` to write over, in order and apart, and the tags to report.

    A text is one row, so its candidates are bounded by its length.
    """
    restores = F.col("original").isNotNull()
    grouped = rows.groupBy(*keys).agg(
        F.collect_list(F.when(restores, F.struct("start", "end", "tag", "original"))).alias("hits"),
        F.array_sort(F.collect_set(F.when(F.col("report") == "unresolved", F.col("tag")))).alias("unresolved_tags"),
        F.array_sort(F.collect_set(F.when(F.col("report") == "ambiguous", F.col("tag")))).alias("ambiguous_tags"),
    )
    return grouped.withColumn("hits", _leftmost(F.col("hits")))


#: Rows of a document's table that travel with each of its texts; longer tables are joined by tag.
FEW = 500
_SCAN, _OPENING, _HIDDEN = re.compile(_BRACKETED), re.compile(r"\\?\["), re.compile(_NESTED)
# ``TAG_SHAPE`` as Java reads it: digits are ASCII, and the end is also before a last line end.
_SHAPE = regex.compile(TAG_SHAPE.replace(r"\d", "[0-9]").removesuffix("$") + r"(?:\r\n|[\n\r\u0085\u2028\u2029])?\Z")


@lru_cache(1 << 12)
def _shaped(tag: str) -> bool:
    return _SHAPE.search(tag[1:-1]) is not None


def _places(text: str, nested: Iterable[int]) -> list[tuple[int, int, str, bool]]:
    """``candidates`` for one text."""
    found = []
    for m in _SCAN.finditer(text):
        raw = m.group()
        tag = raw.replace("\\", "")
        found.append((*m.span(), tag, raw.endswith(tag)))
    if nested:
        for m in _OPENING.finditer(text):
            after = m.end()
            for n in nested:
                inner, closing = text[after : after + n - 2], text[after + n - 2 : after + n]
                plain = closing.startswith("]")
                if (plain or closing == "\\]") and _HIDDEN.search(inner):
                    found.append((m.start(), after + n - plain, f"[{inner}]", plain))
    return found


def _restore(text: str, table: Sequence[tuple[str | None, str | None, str | None]]) -> tuple[str, int, int, list[str], list[str]]:
    """A text with the originals of its document's table back: ``prepare_lookup``, ``tag_rows`` and ``text_hits`` for one text."""
    known: dict[str, set[str]] = {}
    for placeholder, label, original in table:
        for tag in (placeholder, label):
            if tag and len(tag) > 2 and tag[0] == "[" and tag[-1] == "]":
                known.setdefault(tag, set()).update((original,) if original else ())
    nested = {len(tag) for tag in known if _HIDDEN.search(tag, 1, len(tag) - 1)}
    inside = {c[2] for _, _, original in table if original and "[" in original for c in _places(original, nested) if c[3]}
    hits, unresolved, ambiguous = [], set(), set()
    for start, end, tag, plain in _places(text, nested):
        originals = known.get(tag)
        if originals is not None and len(originals) == 1:
            if "\\" not in tag:
                hits.append((start, -end, tag, next(iter(originals))))
        elif tag not in inside and ((originals is not None and plain) or _shaped(tag)):
            (ambiguous if originals else unresolved).add(tag)
    pieces, at, met = [], 0, []
    for start, end, tag, original in sorted(hits):
        if start >= at:
            pieces += (text[at:start], original)
            at = -end
            met.append(tag)
    return "".join((*pieces, text[at:])), len(met), len(set(met)), sorted(unresolved), sorted(ambiguous)


RESTORED = "struct<text:string,replacements:int,tags_restored:int,unresolved_tags:array<string>,ambiguous_tags:array<string>>"


def _restored_here(texts: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``restore_text`` where the table of a document goes along with each of its texts."""

    @F.arrow_udf(RESTORED)
    def done(values: pa.Array, tables: pa.Array) -> pa.Array:
        offsets, rows = tables.offsets.to_pylist(), list(zip(*(tables.values.field(i).to_pylist() for i in range(3))))
        out = [
            (None, 0, 0, [], []) if text is None else _restore(text, rows[a:b])
            for text, (a, b) in zip(values.to_pylist(), pairwise(offsets))
        ]
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.string()))
        names = ("text", "replacements", "tags_restored", "unresolved_tags", "ambiguous_tags")
        return pa.StructArray.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], list(names))

    rows = table.select(key, F.struct(*[F.col(c).cast("string").alias(c) for c in ("placeholder", "label", "original")]).alias("_row"))
    lists = rows.groupBy(key).agg(F.collect_list("_row").alias("_table"))
    none = F.array().cast("array<struct<placeholder:string,label:string,original:string>>")
    joined = texts.join(lists, key, "left").withColumn("_table", F.coalesce("_table", none))
    restored = joined.withColumn("_done", done.asNondeterministic()(F.col("text"), F.col("_table"))).withColumn("text", F.col("_done.text"))
    return restored.select(*texts.columns, "_done.replacements", "_done.tags_restored", "_done.unresolved_tags", "_done.ambiguous_tags")


def restore_text(texts: DataFrame, table: DataFrame, keys: Sequence[str] = ("doc_id",), key: str = "doc_id", few: int = FEW) -> DataFrame:
    """``text`` with originals for tags, plus replacements, tags_restored, unresolved_tags, ambiguous_tags.

    ``keys`` name a text, ``key`` (one of its columns) the document whose table applies. The table of a document of up to
    ``few`` rows goes along with its texts; tags of longer ones are joined, with the same result.
    """
    large = table.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > few).select(key)
    if large.isEmpty():
        return _restored_here(texts, table, key)
    here = _restored_here(texts.join(large, key, "left_anti").select(*texts.columns), table.join(large, key, "left_anti"), key)
    return here.unionByName(_restored_by_tag(texts.join(large, key, "left_semi").select(*texts.columns), table.join(large, key, "left_semi"), keys, key))


def _restored_by_tag(texts: DataFrame, table: DataFrame, keys: Sequence[str], key: str) -> DataFrame:
    """``restore_text`` where the tags of the texts are joined with those of the tables."""
    hits = text_hits(tag_rows(texts, table, keys, key), keys)
    none = F.array().cast("array<string>")
    joined = texts.join(hits, list(keys), "left")
    return joined.withColumn("text", S.rewrite(F.col("text"), F.col("hits"), lambda h: h["original"])).select(
        *texts.columns,
        F.greatest(F.size("hits"), F.lit(0)).alias("replacements"),
        F.greatest(F.size(F.array_distinct(F.transform("hits", lambda h: h["tag"]))), F.lit(0)).alias("tags_restored"),
        F.coalesce("unresolved_tags", none).alias("unresolved_tags"),
        F.coalesce("ambiguous_tags", none).alias("ambiguous_tags"),
    )


def combine_tag_sets(*tags: Column) -> Column:
    """Tag lists as one, distinct and sorted."""
    return F.array_sort(F.array_distinct(F.flatten(F.array(*tags))))


def check_restorable(requests: DataFrame, tables: DataFrame) -> DataFrame:
    """Adds ``code`` and ``problem`` to (file_path, correspondence_path, output_path) requests.

    ``tables`` holds the rows of the correspondence tables by ``correspondence_path``.
    """
    rows = tables.groupBy("correspondence_path").agg(F.count(F.lit(1)).alias("_rows"))
    output = F.coalesce("output_path", files.restored_path(F.col("file_path")))
    joined = requests.join(rows, "correspondence_path", "left")
    problem = (
        F.when(~files.restorable(F.col("file_path")), "unsupported_type")
        .when((output == F.col("file_path")) | (output == F.col("correspondence_path")), "output_is_input")
        .when(F.coalesce("_rows", F.lit(0)) == 0, "empty_table")
    )
    return joined.select(
        *requests.columns, output.alias("restored_path"), problem.alias("problem"),
        F.when(problem.isNotNull(), "invalid_request").alias("code"),
    )


#: Categories whose originals are names, so that a part of one tells who is meant; the shortest part that does.
NAMES, SHORTEST = ("Person", "Organization", "Address"), 3
#: Originals of one document that are looked for together; more go in several lists, each met with the text once.
LISTED = 20_000
_TOKEN, _LETTER = regex.compile(r"[\p{L}\p{N}]+"), regex.compile(r"\p{L}")
_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"))


@lru_cache(1 << 14)
def _parts(name: str) -> tuple[str, ...]:
    """The words of a name that tell who is meant."""
    return tuple(w for w in _TOKEN.findall(name) if len(w) >= SHORTEST and w != name and _LETTER.search(w))


def _needles(original: str, category: str | None, fragments: bool) -> list[tuple[str, bool]]:
    """(string, whether it is a part only) of what must not be seen: an original, as written in XML too, and parts of a name."""
    if not fragments:
        return [(original, False)]
    escaped = original
    for char, entity in _ESCAPES:
        escaped = escaped.replace(char, entity)
    parts = _parts(original) if category in NAMES else ()
    return [(needle, False) for needle in dict.fromkeys((original, escaped))] + [(w, True) for w in parts]


def leak_scan(outputs: DataFrame, table: DataFrame, key: str = "doc_id", fragments: bool = False, listed: int = LISTED) -> DataFrame:
    """Outputs (key, text) that hold an original of their document: (key, placeholder). None should.

    With ``fragments`` also those that hold a part of one (a word of a person's, organisation's or place's name,
    standing alone) or an original as XML escapes it; then ``whole`` tells whether all of it was there. The originals
    of a document travel in lists of ``listed``; what is looked for in each text follows from its list (``functions.grams``):
    one way for any number of originals, and no pairs of text and original are made.
    """
    named = table.where(F.coalesce("original", F.lit("")) != "")
    counts = named.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / listed).alias("_lists")).where("_lists > 1")
    category = F.col("category") if fragments else F.lit(None).cast("string")
    place = F.pmod(F.xxhash64("placeholder", "original"), F.coalesce("_lists", F.lit(1)))
    lists = named.join(counts, key, "left").groupBy(key, place.alias("_list")).agg(
        F.collect_set(F.struct("placeholder", "original", category.alias("category"))).alias("_listed")
    )

    @F.arrow_udf("array<struct<placeholder:string,whole:boolean>>")
    def held(texts: pa.Array, rows: pa.Array) -> pa.Array:
        offsets = rows.offsets.to_pylist()
        placeholders, originals, categories = (rows.values.field(i).to_pylist() for i in range(3))
        asked = [_needles(o, c, fragments) for o, c in zip(originals, categories)]
        wanted = [[n for some in asked[a:b] for n in some] for a, b in pairwise(offsets)]
        sizes, names, whole = [0], [], []
        for first, last, met in zip(offsets, offsets[1:], grams.find(texts.to_pylist(), wanted)):
            if any(met):
                there = iter(met)
                for i in range(first, last):
                    parts = {part for (_, part), found in zip(asked[i], there) if found}
                    if parts:
                        names.append(placeholders[i])
                        whole.append(False in parts)
            sizes.append(len(names))
        found = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(whole, pa.bool_())], ["placeholder", "whole"])
        return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), found)

    once = held.asNondeterministic()
    met = outputs.join(lists, key).withColumn("_held", once(F.col("text"), F.col("_listed")))
    rows = met.select(key, F.inline("_held"))
    if not fragments:
        return rows.select(key, "placeholder").distinct()
    return rows.groupBy(key, "placeholder").agg(F.bool_or("whole").alias("whole"))


def leak_scan_words(outputs: DataFrame, originals: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Outputs that hold an original of *any* document, found word by word: (keys, phrase)."""
    from maskloom.operators.detect import detect_dictionary, words

    phrases = originals.select(F.col("original").alias("phrase"), F.lit("original").alias("category"))
    found = detect_dictionary(outputs, phrases, keys)
    return found.select(*keys, words(F.col("surface")).alias("phrase")).distinct()


def round_trip_check(docs: DataFrame, restored: DataFrame, key: str = "doc_id") -> DataFrame:
    """Adds ``same``: whether what was tagged and restored is the text it was."""
    back = restored.select(key, F.col("text").alias("_back"))
    return docs.join(back, key, "left").select(key, F.col("text").eqNullSafe(F.col("_back")).alias("same"))
