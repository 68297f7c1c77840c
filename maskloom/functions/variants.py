"""Variants of a person's name inside one text: which entity each mention stands for.

The rule is that of ``entities.link_mentions`` (which works on tables of mentions of any size): a full name is
an entity; a surname, alone or after a title, is the full name with that surname met last before it, else the
first one after; with an initial, only a full name whose given name starts so; what fits none is its own.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import lru_cache

from maskloom.functions.titles import TITLES

_TITLE = re.compile(r"^(?:" + "|".join(TITLES) + r")(?:\.[ \t\n\x0b\f\r]*|[ \t\n\x0b\f\r]+)(?=[^ \t\n\x0b\f\r])")
_SPACE = re.compile(r"[ \t\n\x0b\f\r]+")


@lru_cache(1 << 14)
def name_parts(surface: str) -> tuple[str, str, str | None]:
    """(initial, surname, full name or None) of a mention, in lower case; '' for no initial."""
    parts = _SPACE.split(_TITLE.sub("", surface, count=1).strip(" "))
    surname = parts[-1].lower()
    if len(parts) == 1:
        return "", surname, None
    first = parts[0]
    if (len(first) == 1 or (len(first) == 2 and first[1] == ".")) and first[0].isalpha():
        return first[0].lower(), surname, None
    return first[:1].lower(), surname, f"{' '.join(parts[:-1]).lower()} {surname}"


def link_names(surfaces: Sequence[str]) -> list[str]:
    """The entity of each mention of one text, in order of place."""
    named = [name_parts(s) for s in surfaces]
    first: dict[tuple[str, ...], str] = {}
    for initial, surname, full in named:
        if full is not None:
            first.setdefault((surname,), full)
            first.setdefault((surname, initial), full)
    last: dict[tuple[str, ...], str] = {}
    out = []
    for initial, surname, full in named:
        if full is not None:
            last[(surname,)] = last[(surname, initial)] = full
            out.append(full)
            continue
        by_surname = last.get((surname,)) or first.get((surname,))
        by_initial = last.get((surname, initial)) or first.get((surname, initial))
        # "M. Keller" may be an initial or the French title.
        known = by_surname if not initial else (by_initial or by_surname) if initial == "m" else by_initial
        out.append(known or f"{initial} {surname}".strip(" "))
    return out
