"""Licence notices in documents: word bigrams of passages against templates by Dice coefficient.

Text is normalised to lower-case words of letters and digits. Passages are all runs of one to ``spanning``
lines that begin and end with a line that has words. The bigrams of a passage count as often as they occur, so
their number s is known from the words alone (one less); those of a template are distinct. A passage is
compared only with templates whose number t of bigrams lets the coefficient 2 * both / (s + t) reach the
threshold d, that is d / (2 - d) * t <= s <= (2 - d) / d * t; passages out of the bounds of all are
passed over unread. DataFrame functions only.

Cases: null or empty texts have no passages; a single word counts as a bigram; templates that tie are all
reported; repeated rows are scanned each; without templates nothing is found; other columns are ignored.

``find_notices`` takes runs of words instead of lines, so a notice counts in mid-line and over any number of
lines. A run that begins or ends with a bigram foreign to the template, or one it has already, scores less than the run
without it, so runs are read only from one bigram of a template to another, and only where enough of them lie close together.
Of runs that share words only the one with the greatest coefficient is reported, the others giving way from the
greatest down; licences that tie are all reported, each with its leftmost, then shortest run.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.functions.spans import let

THRESHOLD, SPANNING = 0.8, 4

# Licence names (SPDX) and the notices they are announced with.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
]


def bigrams_of(text: str) -> list[str]:
    """The distinct bigrams of a template, as the column expression has them."""
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])} or set(words))


def words(text: Column) -> Column:
    """Lower-case words of ASCII letters and digits; other scripts stay words of their own."""
    clean = F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(F.length(clean) > 0, F.split(clean, " ")).otherwise(F.array().cast("array<string>"))


def bigrams(parts: Column) -> Column:
    def made(w: Column) -> Column:
        pairs = F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat_ws(" ", a, b))
        return F.when(F.size(w) > 1, pairs).otherwise(w)

    return let(parts, made)


def find_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, spanning: int = SPANNING) -> DataFrame:
    """One row per row of ``docs``: doc_id, hits (license, dice, first line and number of lines of each matching passage)."""
    known = [(name, bigrams_of(text)) for name, text in templates]
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    bounds = sorted({(low * len(own), high * len(own)) for _, own in known})
    empty = F.array().cast("array<struct<license:string,dice:double,line:int,lines:int>>")

    def hit(grams: Column, line: Column, lines: int, name: str, own: list[str]) -> Column:
        found = F.struct(F.lit(name).alias("license"), F.lit(0.0).alias("dice"), line.alias("line"), F.lit(lines).alias("lines"))
        dice = 2.0 * F.size(F.array_intersect(grams, F.lit(own))) / (F.size(grams) + len(own))
        near = let(dice, lambda d: F.when(d >= threshold, found.withField("dice", d)))
        return F.when(F.size(grams).between(low * len(own), high * len(own)), near)

    def hits(grams: Column, line: Column, lines: int) -> Column:
        return F.filter(F.array(*[hit(grams, line, lines, *template) for template in known]), lambda h: h.isNotNull())

    def runs(rows: Column, sizes: Column, lines: int) -> Column:
        """The hits of all passages of so many lines."""

        def passage(n: Column, i: Column) -> Column:
            ends = (n > 0) & (F.get(sizes, i + (lines - 1)) > 0)
            total = reduce(lambda a, b: a + b, [F.get(sizes, i + k) for k in range(lines)])
            run = F.get(rows, i) if lines == 1 else F.flatten(F.slice(rows, i + 1, lines))
            fits = let(F.greatest(total - 1, F.lit(1)), lambda s: reduce(lambda a, b: a | b, [s.between(*x) for x in bounds]))
            return F.when(ends & fits, let(bigrams(run), lambda g: hits(g, i, lines)))

        return F.flatten(F.filter(F.transform(sizes, passage), lambda h: h.isNotNull()))

    def passages(rows: Column, sizes: Column) -> Column:
        return F.concat(*[runs(rows, sizes, lines) for lines in range(1, spanning + 1)])

    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), words)
    result = let(lines, lambda rows: let(F.transform(rows, F.size), lambda sizes: passages(rows, sizes))) if known else empty
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(result, empty).alias("hits"))


NOTICES = "array<struct<license:string,dice:double,word:int,words:int>>"


def best(hits: Column) -> Column:
    """The hits that share no word with a greater one, nor with an equal one of their licence before them."""

    def shared(a: Column, b: Column) -> Column:
        return (a["word"] < b["word"] + b["words"]) & (b["word"] < a["word"] + a["words"])

    def chosen(kept: Column, h: Column) -> Column:
        beaten = F.exists(kept, lambda k: shared(k, h) & ((k["down"] < h["down"]) | (k["license"] == h["license"])))
        return F.when(beaten, kept).otherwise(F.array_append(kept, h))

    down = F.transform(hits, lambda h: F.struct((-h["dice"]).alias("down"), h["word"].alias("word"), h["words"].alias("words"), h["license"].alias("license")))
    none = F.array().cast("array<struct<down:double,word:int,words:int,license:string>>")
    kept = F.aggregate(F.array_sort(down), none, chosen)
    return F.transform(kept, lambda h: F.struct(h["license"].alias("license"), (-h["down"]).alias("dice"), h["word"].alias("word"), h["words"].alias("words")))


def find_notices(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, hits (license, dice, first word and number of words of each notice), greatest dice first."""
    known = [(name, own) for name, text in templates if (own := bigrams_of(text))]
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    pairs = sorted({g for _, own in known for g in own if " " in g})
    singles = sorted({g for _, own in known for g in own if " " not in g})
    empty = F.array().cast(NOTICES)

    def marks(w: Column) -> Column:
        """Places of all bigrams (or words) of templates."""

        def mark(i: Column, gram: Column, wanted: list[str]) -> Column:
            return let(gram, lambda g: F.when(g.isin(wanted), F.struct(i.alias("at"), g.alias("gram"))))

        firsts = sorted({g.split(" ")[0] for g in pairs})
        two = F.transform(w, lambda x, i: F.when(x.isin(firsts), mark(i, F.concat_ws(" ", x, F.get(w, i + 1)), pairs)))
        one = F.transform(w, lambda x, i: mark(i, x, singles))
        return F.filter(F.concat(*([two] if pairs else []), *([one] if singles else [])), lambda m: m.isNotNull())

    def runs(found: Column, name: str, own: list[str]) -> Column:
        """All runs from one bigram of a template to another that reach the threshold."""
        alone, n = " " not in own[0], len(own)
        need, most = max(1, math.ceil(low * n - 1e-9)), 1 if alone else math.floor(high * n + 1e-9)

        def ends(first: Column, near: Column) -> Column:
            def hit(last: Column, e: Column) -> Column:
                size = last["at"] - first["at"] + 1
                both = F.size(F.array_distinct(F.transform(F.slice(near, 1, e + 1), lambda m: m["gram"])))
                said = F.struct(F.lit(name).alias("license"), F.lit(0.0).alias("dice"), first["at"].alias("word"), (size + (0 if alone else 1)).alias("words"))
                return let(2.0 * both / (size + n), lambda d: F.when(d >= threshold, said.withField("dice", d)))

            return F.filter(F.transform(near, hit), lambda h: h.isNotNull())

        def begun(m: Column, first: Column, a: Column) -> Column:
            near = F.filter(F.slice(m, a + 1, most), lambda x: x["at"] - first["at"] < most)
            return F.when(F.get(m, a + (need - 1))["at"] - first["at"] < most, let(near, lambda x: ends(first, x)))

        mine = F.filter(found, lambda m: m["gram"].isin(own))
        return let(mine, lambda m: F.flatten(F.filter(F.transform(m, lambda first, a: begun(m, first, a)), lambda h: h.isNotNull())))

    def hits(found: Column) -> Column:
        return F.flatten(F.array(*[runs(found, *template) for template in known]))

    result = let(let(words(F.col("text")), marks), lambda m: F.when(F.size(m) > 0, best(hits(m)))) if known else empty
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(result, empty).alias("hits"))
