"""Rules of a request: cleaned, checked, completed from the account, applied to spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom import schemas as C

# Blank by the Unicode notion of the rule lists, not only the ASCII space.
_BLANK = r"^[\s\p{Z}\uFEFF]*$"
LISTS = ["pii_categories", "pii_included_terms", "pii_excluded_terms"]


def _usable(items: Column) -> Column:
    """Without NULL and blank items (the rest is kept untrimmed); NULL when nothing is left."""
    kept = F.filter(items, lambda t: t.isNotNull() & ~t.rlike(_BLANK))
    return F.when(F.size(kept) > 0, kept)


def clean_rules(requests: DataFrame) -> DataFrame:
    """Blank items dropped, empty lists omitted, and ``error`` where categories were given but none is usable.

    An empty category list would read as "redact nothing", so it is an error and never a default.
    """
    cleaned = {name: _usable(F.col(name)) for name in LISTS}
    nothing = F.col("pii_categories").isNotNull() & cleaned["pii_categories"].isNull()
    return requests.select(
        *[cleaned[c].alias(c) if c in cleaned else F.nullif(F.col(c), F.lit("")).alias(c)
          if c in ("retention", "mode") else F.col(c) for c in requests.columns],
        F.when(nothing, "invalid_request").alias("error"),
    )


def validate_rules(requests: DataFrame) -> DataFrame:
    """Adds ``violations``: which limits a request breaks, sorted; empty when it is fine."""
    categories = F.col("pii_categories")
    checks = {
        "categories_count": ~F.size(categories).between(1, len(C.CATEGORIES)),
        "categories_unknown": F.exists(categories, lambda c: ~F.coalesce(c.isin(*C.CATEGORIES), F.lit(False))),
        "mode_unknown": ~F.col("mode").isin(*C.MODES),
        "retention_unknown": ~F.col("retention").isin(*C.RETENTIONS),
    }
    for short, name in (("included", "pii_included_terms"), ("excluded", "pii_excluded_terms")):
        checks[f"{short}_count"] = F.size(F.col(name)) > C.MAX_TERMS
        checks[f"{short}_length"] = F.exists(F.col(name), lambda t: F.length(t) > C.MAX_TERM_LENGTH)
    if "idempotency_key" in requests.columns:
        checks["key_length"] = F.length("idempotency_key") > C.MAX_KEY_LENGTH
    given = {
        "categories_count": categories.isNotNull(),
        "included_count": F.col("pii_included_terms").isNotNull(),
        "excluded_count": F.col("pii_excluded_terms").isNotNull(),
    }
    found = [F.when(given.get(code, F.lit(True)) & broken, F.lit(code)) for code, broken in checks.items()]
    return requests.withColumn("violations", F.array_sort(F.array_compact(F.array(*found))))


def resolve_rules(requests: DataFrame, accounts: DataFrame, key: str = "account_id") -> DataFrame:
    """What a request omits comes from its account, then from the defaults."""
    names = [*LISTS, "retention", "mode"]
    defaults = accounts.select(key, *[F.col(n).alias(f"_{n}") for n in names])
    last = {"retention": F.lit("ephemeral"), "mode": F.lit("redact")}
    joined = requests.join(defaults, key, "left")
    return joined.select(
        *[F.coalesce(F.col(c), F.col(f"_{c}"), *([last[c]] if c in last else [])).alias(c) if c in names else F.col(c)
          for c in requests.columns]
    )


def attach_rules(docs: DataFrame, rules: DataFrame, key: str = "request_id") -> DataFrame:
    """Documents with the rule lists of their request as columns, ready for ``redact``."""
    return docs.join(rules.select(key, *LISTS), key, "left")


def filter_categories(spans: DataFrame, rules: DataFrame, key: str = "request_id") -> DataFrame:
    """Spans of the categories their request chose; no choice means all. Custom terms always stay."""
    chosen = rules.select(key, F.col("pii_categories").alias("_chosen"))
    kept = F.col("_chosen").isNull() | (F.col("category") == C.CUSTOM) | F.array_contains("_chosen", F.col("category"))
    return spans.join(chosen, key, "left").where(kept).drop("_chosen")


def exclude_terms(spans: DataFrame, rules: DataFrame, key: str = "request_id") -> DataFrame:
    """Without spans whose whole text is an excluded term, case-blind; included terms win."""
    never = rules.select(key, F.explode("pii_excluded_terms").alias("_term")).select(
        key, F.lower("_term").alias("_surface")
    ).distinct()
    # Only detected spans can be excluded, so included ones carry a key that matches nothing.
    marked = spans.withColumn("_surface", F.when(F.col("category") != C.CUSTOM, F.lower("surface")))
    return marked.join(never, [key, "_surface"], "left_anti").select(*spans.columns)
