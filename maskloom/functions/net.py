"""Addresses and URLs as columns: what is public, what a URL may show."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from maskloom.functions.spans import let

# IPv4 ranges that are not public (network, prefix length).
PRIVATE_V4 = [
    ("0.0.0.0", 8), ("10.0.0.0", 8), ("100.64.0.0", 10), ("127.0.0.0", 8), ("169.254.0.0", 16),
    ("172.16.0.0", 12), ("192.0.0.0", 24), ("192.0.2.0", 24), ("192.88.99.0", 24),
    ("192.168.0.0", 16), ("198.18.0.0", 15), ("224.0.0.0", 3),
]

_OCTET = "(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
_QUAD = rf"{_OCTET}(?:\.{_OCTET}){{3}}"


def is_ipv4(address: Column) -> Column:
    return address.rlike(f"^{_QUAD}$")


def ipv4_number(address: Column) -> Column:
    """Dotted quad to its 32-bit number, NULL for anything else."""

    def number(text: Column) -> Column:
        octets = F.transform(F.split(text, r"\."), lambda p: p.try_cast("bigint"))
        return F.when(is_ipv4(text), F.aggregate(octets, F.lit(0).cast("bigint"), lambda acc, p: acc * 256 + p))

    return let(address, number)


def _private_number(number: Column) -> Column:
    def in_range(n: Column) -> Column:
        hit = F.lit(False)
        for network, prefix in PRIVATE_V4:
            a, b, c, d = (int(part) for part in network.split("."))
            low = ((a * 256 + b) * 256 + c) * 256 + d
            hit = hit | n.between(low, low + 2 ** (32 - prefix) - 1)
        return hit

    return let(number, in_range)


def _spelled_out(text: Column) -> Column:
    """A dotted quad at the end of an IPv6 address as two groups."""

    def groups(quad: Column) -> Column:
        lead = F.left(text, F.length(text) - F.length(quad))
        return F.when(quad != "", let(ipv4_number(quad), lambda n: F.concat(
            lead, F.lower(F.hex(F.shiftright(n, 16))), F.lit(":"), F.lower(F.hex(n % 65536))
        ))).otherwise(text)

    return let(F.regexp_extract(text, rf":({_QUAD})$", 1), groups)


def ipv6_groups(address: Column) -> Column:
    """The eight 16-bit groups of an IPv6 address in any spelling, NULL if it is not one."""
    group = "[0-9a-f]{1,4}"
    side = f"(?:{group}(?::{group})*)?"

    def named(part: Column) -> Column:
        return F.filter(F.split(F.coalesce(part, F.lit("")), ":"), lambda g: g != "")

    def filled(text: Column, head: Column, tail: Column) -> Column:
        missing = F.lit(8) - F.size(head) - F.size(tail)
        good = text.rlike(f"^{group}(?::{group}){{7}}$") | (text.rlike(f"^{side}::{side}$") & (missing >= 1))
        groups = F.concat(head, F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), tail)
        return F.when(good, F.transform(groups, lambda g: F.conv(g, 16, 10).cast("int")))

    def expanded(text: Column) -> Column:
        return let(F.split(text, "::"), lambda halves: let(named(F.get(halves, 0)), lambda head: let(
            named(F.get(halves, 1)), lambda tail: filled(text, head, tail)
        )))

    plain = F.lower(F.regexp_replace(address, r"%[0-9a-zA-Z.:-]+$", ""))
    return let(plain, lambda text: let(_spelled_out(text), expanded))


def _private_v6(groups: Column) -> Column:
    g = [F.get(groups, i) for i in range(8)]

    def quad(i: int) -> Column:
        return g[i].cast("bigint") * 65536 + g[i + 1]

    def zero(end: int, start: int = 0) -> Column:
        return F.forall(F.slice(groups, start + 1, end - start), lambda n: n == 0)

    nat64 = (g[0] == 0x64) & (g[1] == 0xFF9B)
    carried = (
        F.when(zero(5) & (g[5] == 0xFFFF), quad(6))  # mapped
        .when(zero(4) & (g[4] == 0xFFFF) & (g[5] == 0), quad(6))  # translated
        .when(zero(6), quad(6))  # compatible
        .when(nat64 & zero(6, 2), quad(6))
        .when(g[0] == 0x2002, quad(1))  # 6to4
    )
    own = (
        nat64  # local use
        | ((g[0] == 0x2001) & (g[1] == 0))  # Teredo
        | (g[0] >= 0xFE80)  # link-local, site-local, multicast
        | g[0].between(0xFC00, 0xFDFF)  # unique local
    )
    loopback = zero(7) & (g[7] < 256)  # and unspecified
    return loopback | let(carried, lambda n: F.when(n.isNotNull(), _private_number(n)).otherwise(own))


def is_address(address: Column) -> Column:
    return F.coalesce(is_ipv4(address) | ipv6_groups(address).isNotNull(), F.lit(False))


def is_public_address(address: Column) -> Column:
    """True only for an address routable on the public internet; anything unreadable is not."""

    def public(text: Column) -> Column:
        v6 = let(ipv6_groups(text), lambda groups: F.when(groups.isNotNull(), ~_private_v6(groups)))
        return F.coalesce(F.when(is_ipv4(text), ~_private_number(ipv4_number(text))).otherwise(v6), F.lit(False))

    return let(address, public)


# ---- URLs as browsers read them: every spelling of an address has one form -------------------------

# Scheme, user, host, port, path, and the rest; schemes with hosts may have any number of slashes, either way round.
_SPECIAL = r"(?is)^(https?|ftp|wss?):[/\\]*([^/\\?#]*@)?(\[[^\]/\\?#]*\]|[^/\\?#:@]*)(?::([^/\\?#]*))?([^?#]*)(.*)$"
_OTHER = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/?#]*))?([^?#]*)(.*)$"
# Ports that are left out, and characters no host may hold.
_PORTS = {"http": "80", "https": "443", "ftp": "21", "ws": "80", "wss": "443"}
_NO_HOST = r"[\x00-\x20\x7f#%/:<>?@\[\\\]^|]"
_ENCODED = r"[^\x21-\x7e]|[\"<>`{}^]"


def _clean(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+|[\x00-\x20]+$", ""), r"[\t\n\r]", "")


def _host_of(raw: Column) -> Column:
    """A host as written: names in lower case, numbers as a dotted quad, IPv6 in its short form; NULL if it is none."""
    inner = F.regexp_replace(raw, r"^\[|\]$", "")
    short = let(ipv6_groups(inner), lambda groups: F.when(groups.isNotNull(), F.concat(F.lit("["), _short_v6(groups), F.lit("]"))))
    decoded = F.when(raw.contains("%"), F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))).otherwise(raw)
    name = F.lower(decoded)
    return F.when(raw.startswith("["), short).when(
        name.rlike(r"(?:^|\.)(?:0x[0-9a-f]*|[0-9]+)\.?$"), let(name, _quad_of)
    ).when((name != "") & ~name.rlike(_NO_HOST), name)


def _short_v6(groups: Column) -> Column:
    """Groups in hexadecimal, the first of the longest runs of at least two zeros left out."""
    def short(text: Column) -> Column:
        out = text
        for n in range(2, 9):
            run = "(?:^|:)0" + ":0" * (n - 1) + "(?:$|:)"
            out = F.when(text.rlike(run), F.concat(
                F.get(F.split(text, run, 2), 0), F.lit("::"), F.get(F.split(text, run, 2), 1)
            )).otherwise(out)
        return out

    return let(F.array_join(F.transform(groups, lambda g: F.lower(F.hex(g))), ":"), short)


def _port_of(scheme_: Column, raw: Column) -> Column:
    """':port' where it is not the scheme's own, '' where it is left out, NULL where it is none."""
    number = F.when(raw.rlike("^[0-9]+$"), raw.try_cast("bigint"))
    usual = F.lit(None).cast("string")
    for name, port in _PORTS.items():
        usual = F.when(scheme_ == name, port).otherwise(usual)
    return F.when(raw == "", "").when(number > 65_535, None).when(number.cast("string") == usual, "").otherwise(
        F.concat(F.lit(":"), number.cast("string"))
    )


def _path_of(raw: Column) -> Column:
    """A path without dot segments, with what may not stand in it as %XX."""
    parts = F.split(F.regexp_replace(F.replace(raw, F.lit("\\"), F.lit("/")), "^/", ""), "/", -1)
    marked = let(parts, lambda all_: F.transform(all_, lambda p, i: F.struct(p.alias("part"), (i == F.size(all_) - 1).alias("last"))))

    def step(acc: Column, p: Column) -> Column:
        up = p["part"].rlike(r"(?i)^(?:\.|%2e){2}$")
        end = F.when(p["last"], F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        return F.when(up, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), end)).when(
            p["part"].rlike(r"(?i)^(?:\.|%2e)$"), F.concat(acc, end)
        ).otherwise(F.array_append(acc, p["part"]))

    plain = F.concat(F.lit("/"), F.array_join(F.aggregate(marked, F.array().cast("array<string>"), step), "/"))
    return let(plain, lambda path: F.when(path.rlike(_ENCODED), F.array_join(F.transform(F.split(path, ""), lambda c: F.when(
        c.rlike(_ENCODED), F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")
    ).otherwise(c)), "")).otherwise(path))


def parse_url(url: Column) -> Column:
    """``struct(scheme, user, host, port, path, rest)`` of an absolute URL in its one form; NULL where it is none."""
    def special(text: Column) -> Column:
        group = lambda i: F.regexp_extract(text, _SPECIAL, i)
        scheme_ = F.lower(group(1))
        return F.struct(
            scheme_.alias("scheme"), group(2).alias("user"), _host_of(group(3)).alias("host"), _port_of(scheme_, group(4)).alias("port"),
            _path_of(group(5)).alias("path"), group(6).alias("rest"),
        )

    def other(text: Column) -> Column:
        group = lambda i: F.regexp_extract(text, _OTHER, i)
        return F.struct(
            F.lower(group(1)).alias("scheme"), F.lit("").alias("user"), group(2).alias("host"), F.lit("").alias("port"),
            group(3).alias("path"), group(4).alias("rest"),
        )

    def parsed(text: Column) -> Column:
        return F.when(text.rlike(_SPECIAL), let(special(text), lambda u: F.when(u["host"].isNotNull() & u["port"].isNotNull(), u))).when(
            text.rlike(_OTHER), other(text)
        )

    return let(_clean(url), parsed)


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(_clean(url), r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def host(url: Column) -> Column:
    """Host in its one form, without brackets."""
    return F.regexp_replace(parse_url(url)["host"], r"^\[|\]$", "")


def _quad_of(name: Column) -> Column:
    """``127.1``, ``0x7f.1``, ``2130706433`` are spellings of one address."""
    numbers = F.transform(
        F.split(F.regexp_replace(name, r"\.$", ""), r"\."),
        lambda p: F.when(p.rlike("^0x[0-9a-f]*$"), F.conv(F.concat(F.lit("0"), F.substr(p, F.lit(3))), 16, 10))
        .when(p.rlike("^0[0-7]+$"), F.conv(p, 8, 10))
        .when(p.rlike("^(?:0|[1-9][0-9]*)$"), p)
        .try_cast("bigint"),
    )

    def total(parts: Column) -> Column:
        """The last number fills all octets that are not written out."""
        lead = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
        last = F.try_element_at(parts, F.lit(-1))
        span = F.pow(F.lit(256), F.lit(5) - F.size(parts)).cast("bigint")
        good = (
            (F.size(parts) <= 4) & F.forall(parts, lambda n: n.isNotNull())
            & F.forall(lead, lambda n: n <= 255) & (last < span)
        )
        top = F.aggregate(lead, F.lit(0).cast("bigint"), lambda acc, n: acc * 256 + n)
        return F.when(good, top * span + last)

    def dotted(n: Column) -> Column:
        octets = [(F.shiftright(n, shift) % 256).cast("string") for shift in (24, 16, 8, 0)]
        return F.when(n.isNotNull(), F.concat_ws(".", *octets))

    return let(let(numbers, total), dotted)


def strip_url(url: Column) -> Column:
    """Scheme, host with port, and path in their one form: user, query and fragment may hold a token."""
    return let(parse_url(url), lambda u: F.when(
        u.isNotNull(), F.concat(u["scheme"], F.lit("://"), u["host"], u["port"], u["path"])
    ))


def href(url: Column) -> Column:
    """A whole absolute URL in its one form; NULL where it is none."""
    between = lambda u: F.when(u["scheme"].isin(*_PORTS) | (u["host"] != ""), "://").otherwise(":")
    return let(parse_url(url), lambda u: F.when(
        u.isNotNull(), F.concat(u["scheme"], between(u), u["user"], u["host"], u["port"], u["path"], u["rest"])
    ))


def join_url(base: Column, target: Column) -> Column:
    """A redirect target seen from the page it came from, in its one form; NULL where it is no usable URL."""
    def joined(page: Column, plain: Column) -> Column:
        origin = F.concat(page["scheme"], F.lit("://"), page["user"], page["host"], page["port"])
        folder = F.regexp_extract(page["path"], "^(.*/)", 1)
        query = F.regexp_extract(page["rest"], r"^(\?[^#]*)", 1)
        slashed = F.replace(F.substring(plain, 1, 2), F.lit("\\"), F.lit("/"))
        whole = (
            F.when(plain == "", F.concat(origin, page["path"], query))
            .when(plain.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.when(plain.rlike(r"(?i)^(?:https?|ftp|wss?):"), plain))
            .when(slashed == "//", F.concat(page["scheme"], F.lit(":"), plain))
            .when(slashed.startswith("/"), F.concat(origin, plain))
            .when(plain.startswith("?"), F.concat(origin, page["path"], plain))
            .when(plain.startswith("#"), F.concat(origin, page["path"], query, plain))
            .otherwise(F.concat(origin, folder, plain))
        )
        return href(whole)

    return F.when(target.isNotNull(), let(parse_url(base), lambda page: let(_clean(target), lambda plain: joined(page, plain))))
