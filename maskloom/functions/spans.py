"""Spans inside one row: found, reduced and written over without leaving the row.

A span is ``[start, end)`` in characters. All work is on arrays that one text bounds, so no
exchange is needed and no group can grow beyond its row. Every value used twice is bound by
``let``: each result is one expression, which stays cheap even where the planner copies it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from maskloom.functions import patterns as P
from maskloom.schemas import SPANS

MASK = "█████"

INCLUDE, DETECTED = 0, 1


def no_spans() -> Column:
    return F.array().cast(SPANS)


_BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value worked out once: inside lambdas Spark repeats whatever is written twice."""
    return F.get(F.transform(F.array(value), body), 0)


def scanned(values: Column, shape: str, combine: Callable[[Column, Column], Column]) -> Column:
    """Running results of an associative ``combine`` over an array: the n-th is that of the first n values.

    Worked out in blocks, then over the blocks' last results, so an array of many thousand values does
    not copy a growing array for every one of them. ``shape`` is the type of a value; no value may be NULL.
    """

    def grown(acc: Column, value: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        return F.array_append(acc, F.when(F.size(acc) > 0, combine(last, value)).otherwise(value))

    def running(part: Column) -> Column:
        return F.aggregate(part, F.array().cast(f"array<{shape}>"), grown)

    def based(blocks: Column) -> Column:
        lasts = F.transform(blocks, lambda b: F.element_at(b, -1))
        return let(running(lasts), lambda ends: F.flatten(F.transform(blocks, lambda b, i: F.when(i == 0, b).otherwise(
            let(F.get(ends, i - 1), lambda before: F.transform(b, lambda x: combine(before, x)))
        ))))

    def cut(all_: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / _BLOCK).cast("int")),
            lambda b: running(F.slice(all_, b * _BLOCK + 1, _BLOCK)),
        )
        return F.when(F.size(all_) > _BLOCK, let(blocks, based)).otherwise(running(all_))

    return let(values, cut)


def running_starts(lengths: Column) -> Column:
    """Where each of a row of pieces starts, from their lengths."""
    def starts(sizes: Column) -> Column:
        ends = scanned(sizes, "int", lambda a, b: a + b)
        return F.zip_with(ends, sizes, lambda end, size: end - size)

    return let(lengths, starts)


def located(text: Column, found: Column, regex: Column) -> Column:
    """``array<struct<start, gap, hit>>`` of the matches ``found`` (a column) by a regex in a text.

    ``gap`` is the text between the match before and this one.
    """
    pieces = F.zip_with(
        F.slice(F.split(text, regex, -1), 1, F.size(found)), found,
        lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")),
    )

    def placed(gaps: Column) -> Column:
        starts = running_starts(F.transform(gaps, lambda p: F.length(p["gap"]) + F.length(p["hit"])))
        return F.zip_with(
            starts, gaps,
            lambda at, p: F.struct((at + F.length(p["gap"])).alias("start"), p["gap"].alias("gap"), p["hit"].alias("hit")),
        )

    return let(pieces, placed)


def _located(text: Column, found: Column, regex: Column, to_span: Callable[[Column, Column], Column]) -> Column:
    spans = F.transform(located(text, found, regex), lambda p: to_span(p["start"], p["hit"]))
    return F.when(F.size(found) > 0, spans).otherwise(no_spans())


def _span(start: Column, surface: Column, category: Column, priority: int) -> Column:
    return F.struct(
        start.cast("int").alias("start"),
        (start + F.length(surface)).cast("int").alias("end"),
        category.cast("string").alias("category"),
        surface.alias("surface"),
        F.lit(priority).cast("int").alias("priority"),
    )


def matches(text: Column, categories: Sequence[str] | None = None) -> Column:
    """All pattern matches of a text, checked or not; no scan for texts that cannot hold any."""
    regex = P.pattern(categories)
    if regex is None:
        return F.array().cast("array<string>")
    return F.when(text.rlike(P.MAY_MATCH), F.regexp_extract_all(text, F.lit(regex), F.lit(0))).otherwise(
        F.array().cast("array<string>")
    )


def pattern_spans(text: Column, categories: Sequence[str] | None = None) -> Column:
    """Spans of the pattern categories in a text."""
    regex = P.pattern(categories)
    if regex is None:
        return no_spans()
    spans = let(matches(text, categories), lambda found: _located(
        text, found, F.lit(regex),
        lambda start, hit: _span(start, hit, P.category_of(hit, categories), DETECTED),
    ))
    return F.filter(spans, lambda s: s["category"].isNotNull())


def term_pattern(terms: Column) -> Column:
    """Whole-word, case-blind alternation over an array of terms, longest first; NULL if empty."""
    longest_first = F.array_sort(
        F.array_distinct(terms),
        lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1)
        .when(a < b, -1).when(a > b, 1).otherwise(0),
    )
    quoted = F.transform(
        longest_first,
        lambda t: F.concat(F.lit("\\Q"), F.replace(t, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")),
    )
    return F.when(
        F.size(terms) > 0,
        F.concat(
            F.lit(r"(?iu)(?<![\p{L}\p{N}_])(?:"), F.array_join(quoted, "|"), F.lit(r")(?![\p{L}\p{N}_])")
        ),
    )


def term_spans(text: Column, regex: Column, category: str, priority: int) -> Column:
    """Spans of the terms in ``regex`` (see ``term_pattern``); none where it is NULL."""
    def spans(rx: Column) -> Column:
        return let(
            F.regexp_extract_all(text, rx, F.lit(0)),
            lambda found: _located(text, found, rx, lambda start, hit: _span(start, hit, F.lit(category), priority)),
        )

    return let(regex, lambda rx: F.when(rx.isNotNull(), spans(rx)).otherwise(no_spans()))


def reduce_overlaps(spans: Column) -> Column:
    """Overlapping spans become one over all they cover, so nothing detected is left beside a mask.

    Its category is that of the strongest member: priority, then longest, then leftmost; its
    surface is put together from those of the members. In order of place. Work grows with the
    number of spans (and the sorting of them), however they overlap.
    """
    ranked = F.array_sort(F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            F.struct(
                s["priority"].alias("priority"), (s["start"] - s["end"]).alias("size"),
                s["start"].alias("first"), s["category"].alias("category"),
            ).alias("best"),
            s["surface"].alias("surface"),
        ),
    ))

    def joined(inorder: Column) -> Column:
        """Runs of spans that hang together: each begins where all before have ended."""
        reach = scanned(F.transform(inorder, lambda s: s["end"]), "int", F.greatest)
        return let(reach, lambda ends: let(_group_starts(inorder, ends), lambda firsts: F.transform(
            firsts, lambda first, g: _merged(inorder, ends, first, F.coalesce(F.get(firsts, g + 1), F.size(inorder)))
        )))

    return F.transform(
        let(ranked, lambda inorder: F.when(any_touch(inorder), joined(inorder)).otherwise(inorder)),
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["best"]["category"].alias("category"),
            s["surface"].alias("surface"), s["best"]["priority"].alias("priority"),
        ),
    )


def _group_starts(inorder: Column, reach: Column) -> Column:
    """Places in an array of spans in order that start at or behind the end of all before."""
    places = F.transform(inorder, lambda s, i: F.when((i == 0) | (s["start"] >= F.get(reach, i - 1)), i))
    return F.filter(places, lambda i: i.isNotNull())


def _merged(inorder: Column, reach: Column, first: Column, after: Column) -> Column:
    """The spans from place ``first`` to before ``after`` as one; each adds to the surface what reaches further."""
    return let(F.slice(inorder, first + 1, after - first), lambda run: F.struct(
        F.get(run, 0)["start"].alias("start"), F.get(reach, after - 1).alias("end"),
        F.array_min(F.transform(run, lambda s: s["best"])).alias("best"),
        F.array_join(F.transform(run, lambda s, i: let(F.get(reach, first + i - 1), lambda ended: F.when(i == 0, s["surface"]).when(
            s["end"] > ended, F.substr(s["surface"], ended - s["start"] + 1)
        ).otherwise(""))), "").alias("surface"),
    ))


def any_touch(inorder: Column) -> Column:
    """Whether any of the spans (an array in order, bound by ``let``) starts before its neighbour ends."""
    touches = F.transform(inorder, lambda s, i: s["start"] < F.get(inorder, i - 1)["end"])
    return F.coalesce(F.exists(touches, lambda t: t), F.lit(False))


#: Spans written over together: places in a text are counted from its start, so a text is first cut into stretches.
_STRETCH = 64


def rewrite(text: Column, spans: Column, replacement: Callable[[Column], Column]) -> Column:
    """The text with each span (sorted, apart) replaced; the new text is inserted as it is."""
    def stretch(whole: Column, base: Column, some: Column) -> Column:
        """A piece of the text that starts at ``base`` and ends with the last of some spans, with these replaced."""
        def piece(s: Column, i: Column) -> Column:
            before = F.coalesce(F.get(some, i - 1)["end"], base)
            return F.concat(F.substr(whole, before - base + 1, s["start"] - before), replacement(s))

        return F.array_join(F.transform(some, piece), "")

    def cut(sp: Column, n: Column) -> Column:
        base = F.coalesce(F.get(sp, n * _STRETCH - 1)["end"], F.lit(0))
        some = F.slice(sp, n * _STRETCH + 1, _STRETCH)
        return let(base, lambda at: let(some, lambda own: let(
            F.substr(text, at + 1, F.element_at(own, -1)["end"] - at), lambda whole: stretch(whole, at, own)
        )))

    def written(sp: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(sp) - 1) / _STRETCH).cast("int"))
        done = F.when(F.size(sp) > _STRETCH, F.array_join(F.transform(numbers, lambda n: cut(sp, n)), "")).otherwise(
            stretch(text, F.lit(0), sp)
        )
        tail = F.substr(text, F.try_element_at(sp, F.lit(-1))["end"] + 1)
        return F.when(F.size(sp) > 0, F.concat(done, tail)).otherwise(text)

    return let(spans, written)


def rewrite_matches(text: Column, categories: Sequence[str] | None, replacement: Callable[[Column], Column]) -> Column:
    """As ``rewrite`` where patterns are the only source: one pass, no offsets.

    ``replacement(surface)`` is NULL for a match to be left as it is.
    """
    regex = P.pattern(categories)
    if regex is None:
        return text

    def written(found: Column) -> Column:
        pieces = F.zip_with(
            F.split(text, F.lit(regex), -1), found,
            lambda gap, hit: F.concat(gap, F.coalesce(replacement(hit), hit, F.lit(""))),
        )
        return F.when(F.size(found) > 0, F.array_join(pieces, "")).otherwise(text)

    return let(matches(text, categories), written)
