"""URLs checked over tables: hosts against the addresses they resolve to, redirects hop by hop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom import schemas as C
from maskloom.functions import net

# Statuses that redirect.
REDIRECTS = [301, 302, 303, 307, 308]


def host_verdicts(resolved: DataFrame) -> DataFrame:
    """(host, public) of a (host, address) table: every address of a host must be public."""
    return resolved.groupBy(F.lower("host").alias("host")).agg(
        F.bool_and(F.coalesce(net.is_public_address(F.col("address")), F.lit(False))).alias("public")
    )


def refuse_private_urls(urls: DataFrame, resolved: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``shown`` (the URL without query and fragment) and ``refused`` (why, NULL if it may be fetched).

    Refusals do not tell a private host from an unknown one, so they cannot be used to look around.
    """
    verdicts = host_verdicts(resolved).select(F.col("host").alias("_host"), F.col("public").alias("_public"))
    joined = urls.withColumn("_host", net.host(F.col(url))).join(verdicts, "_host", "left")
    # Hosts that are addresses are judged as such, other names by what they resolve to.
    public = F.when(net.is_address(F.col("_host")), net.is_public_address(F.col("_host"))).otherwise(
        F.coalesce("_public", F.lit(False))
    )
    refused = F.when(~net.scheme(F.col(url)).isin("http", "https"), "unsupported_scheme").when(~public, "not_public")
    return joined.select(*urls.columns, net.strip_url(F.col(url)).alias("shown"), refused.alias("refused"))


def audit_redirects(hops: DataFrame, resolved: DataFrame) -> DataFrame:
    """Per chain of a fetch log (chain_id, hop_no from 0, url, status, location): outcome and hops.

    Every hop is checked as its own URL. The first that fails decides; a chain still redirecting
    after three redirects, or whose next hop is not where the last one pointed, is refused.
    """
    checked = refuse_private_urls(hops, resolved).withColumn("_target", net.join_url(F.col("url"), F.col("location")))
    target = F.col("_target")
    redirect = F.col("status").isin(*REDIRECTS)
    steps = checked.select(
        "chain_id", "hop_no", net.href(F.col("url")).alias("_here"),
        (
            F.when(F.col("refused").isNotNull(), F.col("refused"))
            .when(redirect & (F.coalesce("location", F.lit("")) == ""), "redirect_without_target")
            .when(redirect & target.isNull(), "invalid_redirect")
            .when(redirect & (F.col("hop_no") >= C.MAX_REDIRECTS), "too_many_redirects")
            .when(~redirect & ~F.col("status").between(200, 299), "http_error")
            .when(~redirect, "fetched")
        ).alias("outcome"),
        F.when(redirect, target).alias("target"),
    )
    # The hop before, by an equality join: hop n+1 must be where hop n pointed.
    before = steps.select("chain_id", (F.col("hop_no") + 1).alias("hop_no"), F.col("target").alias("expected"))
    linked = steps.join(before, ["chain_id", "hop_no"], "left")
    strayed = (F.col("hop_no") > 0) & ~F.coalesce(F.col("expected") == F.col("_here"), F.lit(False))
    outcome = F.when(strayed, "unexpected_hop").otherwise(F.col("outcome"))
    return linked.groupBy("chain_id").agg(
        F.min_by(F.when(outcome.isNotNull(), outcome), F.when(outcome.isNotNull(), F.col("hop_no"))).alias("_outcome"),
        F.min(F.when(outcome.isNotNull(), F.col("hop_no"))).alias("_end"),
        F.max("hop_no").alias("_last"),
    ).select(
        "chain_id", F.coalesce("_outcome", F.lit("incomplete")).alias("outcome"),
        F.coalesce("_end", "_last").alias("hops"),
    )
