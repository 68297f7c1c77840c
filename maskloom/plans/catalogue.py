"""All queries by name, with the SQL that checks them."""

from maskloom.plans import names, streams, texts, urls, work  # noqa: F401  (register their queries)
from maskloom.plans.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
