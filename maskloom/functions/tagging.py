"""Spans of one text found, reduced, numbered and written over in a batch of rows at once.

A small helper of ``operators.redact`` and ``operators.detect``: a scan with the patterns over a batch, then per
text a sort of the spans and one pass over them. The same work as nested lambdas of Spark took several times as long for a short text,
as each is interpreted for every element. Rules, term lists and joined spans are prepared by Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column
from pyspark.sql import functions as F

from maskloom import schemas as C
from maskloom.functions import patterns as P
from maskloom.functions.labels import LABELS
from maskloom.functions.phrases import Automaton, find_phrases
from maskloom.functions.spans import DETECTED, MASK
from maskloom.functions.variants import link_names

#: (start, end, category, surface, priority)
Span = tuple[int, int, str | None, str, int]

TAGGED = "array<struct<start:int,end:int,category:string,surface:string,key:string,tag:string>>"

#: An entity of a text, as ``entities.document_mentions`` has it, without its key.
ENTITIES = "array<struct<pos:int,category:string,surface:string,tag:string>>"

_PLUS = re.compile("[^0-9+]")
# Digits doubled, their own digits added.
_DOUBLED = bytes.maketrans(b"0123456789", b"0246813579")


def luhn_ok(surface: str) -> bool:
    digits = surface.replace(" ", "").replace("-", "").encode()
    if not 13 <= len(digits) <= 19:
        return False
    return (sum(digits[-1::-2]) + sum(digits[-2::-2].translate(_DOUBLED)) - len(digits) * ord("0")) % 10 == 0


# Letters as 10..35, for the check digits of an account number.
_LETTERS = {ord("A") + i: str(10 + i) for i in range(26)}


def iban_ok(surface: str) -> bool:
    plain = surface.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return False
    head, rest = plain[:4], plain[4:]
    return int((rest if rest.isdigit() else rest.translate(_LETTERS)) + head.translate(_LETTERS)) % 97 == 1


_CHECKS = {"CreditCard": luhn_ok, "IBAN": iban_ok}


# Characters put around a match; a text that holds one is searched alone.
_OPEN, _SHUT = "\x02", "\x03"


def _scanner(chosen: Sequence[str]) -> re.Pattern:
    # A group per category: the first that matches at a place is also the first that a match is a full match of.
    return re.compile("|".join(f"({P.PATTERNS[c]})" for c in chosen))


def find_all(texts: pa.Array, categories: Sequence[str] | None = None) -> list[list[Span]]:
    """Spans of the patterns in each text, in order and apart (``spans.pattern_spans`` for a batch).

    One vectorised search marks the matches of all texts; only these are looked at one by one.
    """
    chosen = [c for c in P.PATTERN_CATEGORIES if categories is None or c in categories]
    if not chosen or not len(texts):
        return [[]] * len(texts)
    scan, checks = _scanner(chosen), [(None, None), *((c, _CHECKS.get(c)) for c in chosen)]
    kind_of, last = scan.match, {c: i for i, c in enumerate(chosen, 1)}
    # No other pattern has a match with "@", or one of digits only.
    email, card = last.get("Email"), last.get("CreditCard")
    values = texts.to_pylist()
    marks = pc.match_substring_regex(texts, f"[{_OPEN}{_SHUT}]").to_pylist()
    marked = pc.replace_substring_regex(texts, P.pattern(chosen, portable=True), f"{_OPEN}\\0{_SHUT}").to_pylist()
    out = []
    for value, alone, some in zip(values, marks, marked):
        found: list[Span] = []
        out.append(found)
        if not value or (not alone and len(some) == len(value)):
            continue
        # Matches and the gaps after them, in turn; places are those before the text was marked.
        first, *pieces = _apart(value, scan) if alone else some.split(_OPEN)
        start = len(first)
        for piece in pieces:
            hit, _, gap = piece if alone else piece.partition(_SHUT)
            end = start + len(hit)
            category, check = checks[email if "@" in hit else card if hit.isdigit() else kind_of(hit).lastindex]
            if check is None or check(hit):
                found.append((start, end, category, hit, DETECTED))
            start = end + len(gap)
    return out


def _apart(text: str, scan: re.Pattern) -> Iterator[str | tuple[str, str, str]]:
    """The text before the first match, then each match and the gap after it, as ``partition`` gives them."""
    places = [m.span() for m in scan.finditer(text)] + [(len(text), len(text))]
    yield text[: places[0][0]]
    for (start, end), (after, _) in pairwise(places):
        yield text[start:end], "", text[end:after]


def reduce_spans(spans: Sequence[Span]) -> list[Span]:
    """``spans.reduce_overlaps`` for the spans of one text."""
    if all(a[1] <= b[0] for a, b in pairwise(spans)):
        return list(spans)

    def best(s: Span) -> tuple:
        return s[4], s[0] - s[1], s[0], s[2] is not None, s[2] or ""

    out: list[list] = []
    for s in sorted(spans, key=lambda s: (s[0], s[1], best(s), s[3])):
        if not out or s[0] >= out[-1][1]:
            out.append([s[0], s[1], s, [s[3]]])
            continue
        run = out[-1]
        if s[1] > run[1]:
            run[3].append(s[3][run[1] - s[0] :])
            run[1] = s[1]
        if best(s) < best(run[2]):
            run[2] = s
    return [(start, end, top[2], "".join(pieces), top[4]) for start, end, top, pieces in out]


def entity_key(category: str | None, surface: str) -> str:
    """``patterns.entity_key`` for one surface."""
    if category in ("PhoneNumber", "CreditCard"):
        return surface if surface.isascii() and surface.isdigit() else _PLUS.sub("", surface)
    return surface.replace(" ", "").upper() if category == "IBAN" else surface.strip(" ").lower()


def number_spans(spans: list[Span], lang: str | None, named: bool) -> tuple[list[str], list[str | None]]:
    """Keys and tags of spans in order of place; numbers go by category in order of first appearance."""
    people = iter(link_names([s[3] for s in spans if s[2] == "Person"]) if named else ())
    known: dict[tuple[str | None, str], str | None] = {}
    counts: dict[str | None, int] = {}
    keys, tags = [], []
    for _, _, category, surface, _ in spans:
        key = next(people) if named and category == "Person" else entity_key(category, surface)
        entity = category, key
        if entity not in known:
            counts[category] = number = counts.get(category, 0) + 1
            labels = LABELS.get(category)
            known[entity] = labels and f"[{labels.get(lang) or labels['en']} {number}]"
        keys.append(key)
        tags.append(known[entity])
    return keys, tags


def rewritten(text: str | None, spans: list[Span], replacements: Iterable[str]) -> str | None:
    """The text with each span (in order, apart) replaced."""
    if text is None or not spans:
        return text
    pieces, at = [], 0
    for s, new in zip(spans, replacements):
        pieces += (text[at : s[0]], new)
        at = s[1]
    return "".join((*pieces, text[at:]))


def _nested(rows: list[list], fields: list[tuple[str, pa.Array]]) -> pa.Array:
    """Lists as long as the rows of structs of the fields."""
    offsets = np.concatenate([[0], np.cumsum([len(some) for some in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([a for _, a in fields], [n for n, _ in fields]))


def _lists(rows: list[list[Span]], last: list[tuple[str, pa.Array]]) -> pa.Array:
    """The spans of all texts as an array of lists of structs; ``last`` are its fields after ``surface``."""
    columns = list(zip(*chain.from_iterable(rows))) or [()] * 5
    kinds = (("start", pa.int32()), ("end", pa.int32()), ("category", pa.string()), ("surface", pa.string()))
    return _nested(rows, [*((name, pa.array(values, kind)) for (name, kind), values in zip(kinds, columns)), *last])


def _entities(spans: list[Span], lang: str | None) -> list[tuple[int, str | None, str, str]]:
    """(pos, category, surface, tag) of each tag ``number_spans`` gives the spans of a text: its longest form, the first of these."""
    longest: dict[tuple[str | None, str], Span] = {}
    for s in spans:
        entity = s[2], entity_key(s[2], s[3])
        known = longest.get(entity)
        if known is None or len(s[3]) > len(known[3]):
            longest[entity] = s  # a key keeps its place, so entities stay in order of first appearance
    counts: dict[str, int] = {}
    out = []
    for start, _, category, surface, _ in longest.values():
        labels = LABELS.get(category)
        if labels:
            counts[category] = number = counts.get(category, 0) + 1
            out.append((start, category, surface, f"[{labels.get(lang) or labels['en']} {number}]"))
    return out


def _entity_lists(rows: list[list[tuple]]) -> pa.Array:
    columns = list(zip(*chain.from_iterable(rows))) or [()] * 4
    kinds = (("pos", pa.int32()), ("category", pa.string()), ("surface", pa.string()), ("tag", pa.string()))
    return _nested(rows, [(name, pa.array(values, kind)) for (name, kind), values in zip(kinds, columns)])


def _spans_of(spans: list[list[Span]]) -> pa.Array:
    return _lists(spans, [("priority", pa.array([s[4] for some in spans for s in some], pa.int32()))])


def _tuples(listed: pa.Array) -> list[list[Span]]:
    if not len(listed.values):
        return [[]] * len(listed)
    return [[(s["start"], s["end"], s["category"], s["surface"], s["priority"]) for s in some or ()] for some in listed.to_pylist()]


def find_patterns(text: Column, categories: Sequence[str] | None = None) -> Column:
    """Spans of the pattern categories in a text."""
    chosen = None if categories is None else list(categories)

    @F.arrow_udf(C.SPANS)
    def found(texts: pa.Array) -> pa.Array:
        return _spans_of(find_all(texts, chosen))

    # So the planner leaves the search in a projection of its own and does not copy it where its result is used.
    return found.asNondeterministic()(text)


def pattern_entities(text: Column, lang: Column, categories: Sequence[str] | None = None) -> Column:
    """Tags of what the patterns find in a text, each with its longest form: nothing is written and no span handed on."""
    chosen = None if categories is None else list(categories)

    @F.arrow_udf(ENTITIES)
    def found(texts: pa.Array, langs: pa.Array) -> pa.Array:
        return _entity_lists([_entities(spans, spoken) for spans, spoken in zip(find_all(texts, chosen), langs.to_pylist())])

    return found.asNondeterministic()(text, lang)


#: Fields of what ``all_spans`` is asked for.
ASKED = ("text", "more", "terms", "allowed", "never", "lang")


def all_spans(asked: Column, categories: Sequence[str] | None, automaton: Broadcast[Automaton] | None, form: str, named: bool) -> Column:
    """What is found in a text, reduced: ``form`` is 'spans', 'masked' (the text) or 'tagged' (text and spans with tags).

    ``asked`` is a struct of ``ASKED``: ``more`` are spans found elsewhere, ``terms`` those that are always to go;
    ``allowed`` are the categories chosen (NULL: all) and ``never`` the terms, in any case, that stay unless they are
    among ``terms``. ``named`` links the variants of persons' names.
    """
    chosen = None if categories is None else list(categories)
    returned = {"spans": C.SPANS, "masked": "string", "tagged": f"struct<text:string,spans:{TAGGED}>"}[form]

    def ruled(spans: list[Span], allow: list[str | None] | None, no: list[str | None] | None) -> list[Span]:
        if allow is not None:
            spans = [s for s in spans if s[2] is not None and s[2] in allow]
        if no:
            # A NULL among the terms leaves nothing certain, as in SQL.
            stay = None if None in no else {term.lower() for term in no}
            spans = [] if stay is None else [s for s in spans if s[3].lower() not in stay]
        return spans

    @F.arrow_udf(returned)
    def done(rows: pa.Array) -> pa.Array:
        texts, others, always, allow, no, langs = (rows.field(name) for name in ASKED)
        values = texts.to_pylist()
        listed = [[]] * len(values) if automaton is None else find_phrases(automaton.value, values)
        spans = []
        for text_, hits, some, phrases, first, a, n in zip(values, find_all(texts, chosen), _tuples(others), listed, _tuples(always), allow.to_pylist(), no.to_pylist()):
            found = hits + some + [
                (s, e, c, text_[s:e], DETECTED) for s, e, c in phrases if not chosen or c in chosen
            ]
            if phrases:
                found.sort(key=itemgetter(0, 1))
            spans.append(reduce_spans(first + ruled(found, a, n)))
        if form == "spans":
            return _spans_of(spans)
        if form == "masked":
            return pa.array([rewritten(t, some, [MASK] * len(some)) for t, some in zip(values, spans)], pa.string())
        keyed = [number_spans(some, lang_, named) for some, lang_ in zip(spans, langs.to_pylist())]
        out = [rewritten(t, some, [tag or MASK for tag in tags]) for t, some, (_, tags) in zip(values, spans, keyed)]
        last = [(name, pa.array(list(chain.from_iterable(row[i] for row in keyed)), pa.string())) for i, name in enumerate(("key", "tag"))]
        return pa.StructArray.from_arrays([pa.array(out, pa.string()), _lists(spans, last)], ["text", "spans"])

    return done.asNondeterministic()(asked)
