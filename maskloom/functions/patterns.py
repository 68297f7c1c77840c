"""Patterns for the categories that have a written form, and checks on what they find.

The patterns keep to syntax that Java and RE2 read alike (no look-around, no ``\\b``), so results
can be checked with another engine. Accepted spellings are this package's own choice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names in the four languages of the corpus.
MONTHS = [
    "January", "February", "March", "April", "May", "June", "July", "August", "September",
    "October", "November", "December",
    "janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre",
    "octobre", "novembre", "décembre",
    "Januar", "Februar", "März", "Mai", "Juni", "Juli", "Oktober", "Dezember",
    "enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre",
    "octubre", "noviembre", "diciembre",
]

_DAY = "(?:0?[1-9]|[12][0-9]|3[01])"
# English alone puts the month first. By first letter, as this is tried at every position.
_MONTH_FIRST = (
    "(?:J(?:anuary|une|uly)|February|M(?:arch|ay)|A(?:pril|ugust)|September|October|November|December)"
)
_MONTH = "(?:" + "|".join(sorted(set(MONTHS), key=lambda m: (-len(m), m))) + ")"

# In the order they are tried at one position.
PATTERNS = {
    "Email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "IBAN": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
    "Date": "|".join([
        r"[0-9]{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])",
        _DAY + r"[./](?:0?[1-9]|1[0-2])[./][0-9]{4}",
        _DAY + r"\.? (?:de )?" + _MONTH + r" (?:de )?[0-9]{4}",
        _MONTH_FIRST + " " + _DAY + r", [0-9]{4}",
    ]),
    "CreditCard": r"[0-9]{13,}|[0-9]{4}(?:[ -][0-9]{4}){3}|3[47][0-9]{2}[ -][0-9]{6}[ -][0-9]{5}",
    "PhoneNumber": "|".join([
        r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}",
        r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}",
        r"0[0-9]{1,3}(?:[ .-][0-9]{2,4}){2,4}",
    ]),
}
PATTERN_CATEGORIES = list(PATTERNS)

# Every pattern needs one of these characters: a cheap first look that spares most texts the scan.
MAY_MATCH = "[0-9@]"

# Where a match of any pattern can start, for searches that take one look ahead for all of them.
MAY_START = "(?:[0-9+(A-Z]|[a-z._%-][A-Za-z0-9._%+-]*+@)"


# What a match of a pattern can start with: one look instead of trying its every branch.
_STARTS = {"Date": "[0-9ADFJMNOS]", "CreditCard": "[0-9]", "PhoneNumber": "[+(0]"}


def pattern(categories: Sequence[str] | None = None, portable: bool = False) -> str | None:
    """One alternation for the chosen categories; None when none of them has a pattern.

    ``portable`` leaves out what only speeds up the search and other engines do not know.
    """
    chosen = [c for c in PATTERN_CATEGORIES if categories is None or c in categories]
    gates = {} if portable else {c: f"(?={first})" for c, first in _STARTS.items()}
    return "|".join(f"(?:{gates.get(c, '')}(?:{PATTERNS[c]}))" for c in chosen) or None


def luhn_ok(surface: Column) -> Column:
    digits = F.regexp_replace(surface, "[ -]", "")
    return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)


def iban_ok(surface: Column) -> Column:
    """Check digits: country and check moved behind, letters as 10..35, remainder 1 on 97."""
    plain = F.replace(surface, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))
    remainder = F.aggregate(
        F.transform(F.split(turned, ""), F.ascii),
        F.lit(0),
        lambda acc, code: F.when(code < ord("A"), (acc * 10 + code - ord("0")) % 97).otherwise(
            (acc * 100 + code - ord("A") + 10) % 97
        ),
    )
    return F.length(plain).between(15, 34) & (remainder == 1)


def category_of(surface: Column, categories: Sequence[str] | None = None) -> Column:
    """The category of a match, NULL where the digits fail their check (then it is plain text)."""
    result = F.lit(None).cast("string")
    chosen = [c for c in PATTERN_CATEGORIES if categories is None or c in categories]
    for name in reversed(chosen):
        hit = surface.rlike(f"^(?:{PATTERNS[name]})$")
        value = F.lit(name)
        if name == "CreditCard":
            value = F.when(luhn_ok(surface), value)
        elif name == "IBAN":
            value = F.when(iban_ok(surface), value)
        result = F.when(hit, value).otherwise(result)
    return result


def entity_key(category: Column, surface: Column) -> Column:
    """Spellings of one thing share a key: case, blanks and separators do not count."""
    return (
        F.when(category.isin("PhoneNumber", "CreditCard"), F.regexp_replace(surface, "[^0-9+]", ""))
        .when(category == "IBAN", F.upper(F.replace(surface, F.lit(" "), F.lit(""))))
        .otherwise(F.lower(F.trim(surface)))
    )
