"""One-permutation MinHash fingerprints of whole texts, by DataFrame functions only.

Words are what stands between white space, in lower case; a text's shingles are its runs of five
words (fewer words: all of them as one). Each shingle is hashed once. The top bits of a hash name its
bin, the least hash stays in each bin. An empty bin borrows by optimal densification: it tries bins
drawn by a hash of its own number and the attempt, the first that was filled lends; after ``TRIES``
misses the order goes on through all filled bins by another such hash, so it always ends. The
lowest 8 bits of each bin are packed, eight bins to a long, and written in hex.

Two fingerprints agree in a bin by chance once in 256, so likeness is (m - r) / (1 - r), m the share of
agreeing bins and r = 1/256, at least 0.

Cases: a text without words has the fingerprint '' (null words), is 1 like another such text and 0 like
any other; a null text counts as empty; repeated rows each get theirs; equal texts have equal
fingerprints; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskloom.functions.spans import let
from maskloom.llm.store import stored

BINS_LOG, WORDS, LOW, TRIES = 7, 5, 8, 3
BINS = 1 << BINS_LOG
_PER_LONG = 64 // LOW
_CHANCE = 1 / (1 << LOW)
_SPACE = " \t\n\x0b\f\r"


def shingle_hashes(text: Column) -> Column:
    """The hashes of all shingles, repeated ones too; empty without words."""
    trimmed = F.btrim(F.lower(text), F.lit(_SPACE))
    words = F.transform(F.split(trimmed, "[ \\t-\\r]+"), lambda w: F.xxhash64(w))

    def runs(w: Column) -> Column:
        def run(i: Column) -> Column:
            return F.xxhash64(*[F.get(w, i + k) for k in range(WORDS)])

        return F.when(F.size(w) >= WORDS, F.transform(F.sequence(F.lit(0), F.size(w) - WORDS), run)).otherwise(F.array(F.xxhash64(w)))

    return F.when(F.length(trimmed) > 0, let(words, runs)).otherwise(F.array().cast("array<bigint>"))


def _bin(value: Column) -> Column:
    return F.shiftrightunsigned(value, 64 - BINS_LOG).cast("int")


def fingerprint_words(text: Column) -> Column:
    """The fingerprint as packed longs; null without words."""

    def least(hashes: Column) -> Column:
        return F.filter(hashes, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(hashes, i - 1))))

    def filled(lows: Column) -> Column:
        numbers = F.transform(lows, _bin)
        return let(numbers, lambda bins: spread(lows, bins))

    def spread(lows: Column, bins: Column) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.try_element_at(lows, F.nullif(F.array_position(bins, b.cast("int")), F.lit(0)).cast("int")))
        return let(every, lambda own: F.transform(own, lambda x, b: F.coalesce(x, *[drawn(own, b, t) for t in range(TRIES)], last(lows, bins, b))))

    def drawn(own: Column, b: Column, attempt: int) -> Column:
        return F.get(own, F.pmod(F.xxhash64(b, F.lit(attempt)), F.lit(BINS)).cast("int"))

    def last(lows: Column, bins: Column, b: Column) -> Column:
        return F.array_min(F.zip_with(bins, lows, lambda j, x: F.struct(F.xxhash64(b, F.lit(-1), j).alias("rank"), x.alias("low"))))["low"]

    def packed(values: Column) -> Column:
        def one(i: Column) -> Column:
            out = F.lit(0).cast("bigint")
            for k in range(_PER_LONG):
                low = F.get(values, (i * _PER_LONG + k).cast("int")).bitwiseAND(F.lit((1 << LOW) - 1).cast("bigint"))
                out = out.bitwiseOR(F.shiftleft(low, LOW * (_PER_LONG - 1 - k)))
            return out

        return F.transform(F.sequence(F.lit(0), F.lit(BINS // _PER_LONG - 1)), one)

    hashes = F.sort_array(shingle_hashes(text))
    lows = let(hashes, least)
    return let(lows, lambda v: F.when(F.size(v) > 0, let(filled(v), packed)))


def as_text(words: Column) -> Column:
    return F.coalesce(F.array_join(F.transform(words, lambda w: F.lower(F.lpad(F.hex(w), 16, "0"))), ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 for two packed fingerprints, corrected for chance."""

    def differing(x: Column, y: Column) -> Column:
        def folded(z: Column) -> Column:
            # Every byte that is not zero leaves a one in its lowest bit.
            for step in (1, 2, 4):
                z = z.bitwiseOR(F.shiftrightunsigned(z, step))
            return F.bit_count(z.bitwiseAND(F.lit(0x0101010101010101)))

        return folded(x.bitwiseXOR(y))

    apart = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda n, x: n + x)
    share = F.lit(1.0) - apart / F.lit(float(BINS))
    return (
        F.when(a.isNull() & b.isNull(), 1.0)
        .when(a.isNull() | b.isNull(), 0.0)
        .otherwise(F.greatest(F.lit(0.0), (share - _CHANCE) / (1 - _CHANCE)))
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint (hex) and its packed words, of every row."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.char_length(text).cast("long").alias("n_chars"), fingerprint_words(text).alias("words")
    ).select("doc_id", "n_chars", as_text(F.col("words")).alias("fingerprint"), "words")


def next_ids(ids: DataFrame) -> DataFrame:
    """For each distinct non-null doc_id the next one in falling order (after the least: the greatest).

    Ranges of ids, each ordered by itself, then one small row per range ordered over all.
    """
    ranged = ids.repartitionByRange(F.desc("doc_id")).withColumn("range", F.spark_partition_id())
    ranged = stored(ranged, "id-ranges")
    falling = F.desc("doc_id")
    inside = Window.partitionBy("range").orderBy(falling)
    ends = ranged.groupBy("range").agg(F.max("doc_id").alias("head"))
    ends = ends.select(
        "range", F.coalesce(F.lead("head").over(Window.orderBy("range")), F.first("head").over(Window.orderBy("range"))).alias("following")
    )
    return (
        ranged.withColumn("next_id", F.lead("doc_id").over(inside))
        .join(ends, "range")
        .select(*ids.columns, F.coalesce("next_id", "following").alias("next_id"))
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and how like they are.

    Edited: the last third (floor) of the characters gives way to as many first ones of the next document
    in falling doc_id (after the last: the first), or all it has. Rows that share a doc_id
    have one place in the order and lend their least text; a null doc_id has no next document.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    third = F.floor(F.char_length("text") / 3)
    # Both joins below deal out the same rows by doc_id, so they share one exchange.
    placed = texts.where(F.col("doc_id").isNotNull())
    ids = placed.groupBy("doc_id").agg(F.max(third).cast("int").alias("third"))
    order = stored(next_ids(ids), "next-ids")
    heads = (
        order.join(placed.withColumnRenamed("doc_id", "next_id"), "next_id")
        .select("doc_id", "next_id", F.substring("text", F.lit(1), F.col("third")).alias("head"))
        .groupBy("doc_id", "next_id").agg(F.min("head").alias("head"))
    )
    length, cut = F.char_length("text"), F.floor(F.char_length("text") / 3).cast("int")
    alone = texts.where(F.col("doc_id").isNull()).select("doc_id", "text", F.lit(None).cast("long").alias("next_id"), F.lit("").alias("head"))
    both = placed.join(heads, "doc_id", "left").unionByName(alone).select(
        "doc_id", "next_id", length.cast("long").alias("n_chars"), "text",
        F.concat(F.substring("text", F.lit(1), length - cut), F.substring(F.coalesce("head", F.lit("")), F.lit(1), cut)).alias("edited"),
    )
    made = both.select(
        "doc_id", "next_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint_words(F.col("text")).alias("words"), fingerprint_words(F.col("edited")).alias("edited_words"),
    )
    made = stored(made, "fingerprints")
    following = made.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("next_id")).agg(F.min(F.struct(F.col("words").isNull().alias("bare"), F.col("words").alias("words"))).alias("next"))
    return made.join(following, "next_id", "left").select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("words")).alias("fingerprint"),
        as_text(F.col("edited_words")).alias("edited_fingerprint"), likeness(F.col("words"), F.col("edited_words")).alias("near_edited"),
        F.when(F.col("next").isNull(), 0.0).otherwise(likeness(F.col("words"), F.col("next.words"))).alias("near_next"),
    )
