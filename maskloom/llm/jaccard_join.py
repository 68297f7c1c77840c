"""Exact Jaccard join of shingle sets in their metric space: pivots, Voronoi regions, windows.

The distance of two sets is 1 - |both| / |either|, a metric. Documents with nothing in common are all
at distance 1, where the triangle inequality tells nothing, so the first pivots are the single
shingles: a set of n is at 1 - 1/n from each of its own shingles, at 1 from all others, ties go by a fixed order.
A partner within the threshold shares all but a fifth of a set's shingles, so each set is replicated into
the regions of its first n - ceil(0.8 n) + 1 shingles, and every linked pair meets in one. Shingles that
many documents have come last in the order (a bit table of fixed size says which; any table gives
the same links). Regions with the same least set are joined to one.

Small regions are joined directly: histograms of the shingles' hashes (their L1 distance never exceeds the
number of differing shingles) leave the sets that may have a partner, only those are fetched and
compared. Large regions recurse: some of their documents become pivots. A document within 0.6 of one goes to
the cell of its nearest pivot, at d, and into every other cell within the window d + 2 * 0.2 (and 0.8)
that the triangle inequality leaves; documents beyond 0.4 of all pivots make a cell of their own, since a partner of one
beyond 0.6 is beyond 0.4. Links to pivots are kept, and cells whose documents all hang together by them are done. Regions that
windows would only multiply, and what is still large after ``LEVELS``, are joined block against block, but not within the part that hangs together. Links make components by alternating large and
small stars. All of it works on one row per distinct set; copies follow their set.

Sets go by 64-bit hashes, shingles by 48 bits of theirs (two of a set of 500 fall together once in
some 2 * 10^9 sets). Cases: a null text, or one without words, has an empty set, links
with nothing and is its own component; fewer than five words are one shingle; repeated rows and copies share a
component; a null doc_id takes part, but names no component unless all of it is null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from maskloom.llm.store import lean, stored

WORDS = 5
#: Sets joined at once in one task; pivots of a large region; Voronoi levels before blocks; sets measured at once.
LEAF, PIVOTS, LEVELS, SHARE = 256, 16, 2, 512
#: A shingle is common from so many documents on; log2 of the bits that say so.
COMMON, TABLE_LOG = 32, 24
#: Shingles in which a task looks for those that occur twice, at once.
COUNTED = 4_000_000
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
# Odd multipliers, one per word of a shingle.
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15 + 2 * i * 0x5851F42D4C957F2D & 2**64 - 1 | 1 for i in range(WORDS)], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    for shift, factor in ((29, 0xBF58476D1CE4E5B9), (32, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingles of a text as sorted hashes, the upper 48 bits of 64."""
    words = text.encode("utf-8").translate(_LOWER).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out += hashes[i : i + n] * _MULTIPLIERS[i]
    return np.unique(_mixed(out) & ~np.uint64(0xFFFF))


def packed(shingles: np.ndarray) -> bytes:
    """The 48 bits of each."""
    return shingles.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    whole = np.zeros((len(data) // 6, 8), np.uint8)
    whole[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return whole.view("<u8").reshape(-1)


def sketch(shingles: np.ndarray) -> bytes:
    """How many shingles begin with each run of bits: some four to a bucket, 255 at most in one."""
    bits = _sketch_bits(len(shingles))
    return np.minimum(np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def _sketch_bits(n: int) -> int:
    return min(12, max(3, (int(n) // 4).bit_length() - 1))


def may_link(sizes: np.ndarray, sketches: list[bytes]) -> np.ndarray:
    """Which sets have another one that their sizes and histograms leave as a partner."""
    bits = np.array([_sketch_bits(n) for n in sizes])
    out = np.zeros(len(sizes), bool)
    for level in np.unique(bits):
        # Partners differ in size by a quarter at most, so by one level at most: the finer is folded.
        at = np.flatnonzero((bits == level) | (bits == level + 1))
        if len(at) < 2:
            continue
        counts = np.zeros((len(at), 1 << level), np.int32)
        for row, i in enumerate(at):
            own = np.frombuffer(sketches[i], np.uint8)
            counts[row] = own if bits[i] == level else np.minimum(own.reshape(-1, 2).astype(np.int32).sum(1), 255)
        n, own = sizes[at], bits[at] == level
        for row in range(len(at)):
            near = (n[row + 1 :] * 5 >= n[row] * 4) & (n[row] * 5 >= n[row + 1 :] * 4) & (own[row] | own[row + 1 :])
            others = row + 1 + np.flatnonzero(near)
            if len(others):
                apart = np.abs(counts[others] - counts[row]).sum(1)
                hits = others[9 * apart <= n[others] + n[row]]
                if len(hits):
                    out[at[hits]] = out[at[row]] = True
    return out


def shared(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """How many shingles each set shares with each other one (itself: those that another one has too)."""
    both = [*sets, *(others or [])]
    _, place = np.unique(np.concatenate(both), return_inverse=True)
    owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
    often = np.bincount(place)[place] > 1
    _, place = np.unique(place[often], return_inverse=True)
    owner, width = owner[often], int(place.max()) + 1 if often.any() else 0
    out = np.zeros((len(sets), len(others) if others else len(sets)), np.float32)
    for first in range(0, width, 4096):
        inside = (place >= first) & (place < first + 4096)
        held = np.zeros((len(both), 4096), np.float32)
        held[owner[inside], place[inside] - first] = 1
        out += held[: len(sets)] @ (held[len(sets) :] if others else held).T
    return np.rint(out).astype(np.int64)


def linked(both: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 100 * both >= 80 * (n[:, None] + m[None, :] - both)


_SETS = "doc_id long, key long, n int, sketch binary, shingles binary"


def shingle_sets(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the set; null if empty), n; histogram and shingles where a batch first holds the set."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n", pa.int32()), ("sketch", pa.binary()), ("shingles", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part, rows, seen = batch.slice(first, 1024), [], set()
                for text in part.column(1):
                    found = shingle_set(text.as_py())
                    if not len(found):
                        rows.append((None, 0, None, None))
                        continue
                    data = packed(found)
                    key = xxh3_64_intdigest(data) - (1 << 63)
                    rows.append((key, len(found), None, None) if key in seen else (key, len(found), sketch(found), data))
                    seen.add(key)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[1:]))], schema=schema
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(make), _SETS)


def _common_table(sets: DataFrame, common: int) -> np.ndarray:
    """A bit for each common shingle (found where some thousand sets hold it twice), by its first bits: 2 MB, whatever the table."""
    schema = pa.schema([("n", pa.int64()), ("shingle", pa.int64())])

    def often(sets: list[np.ndarray]) -> pa.RecordBatch:
        found = np.sort(np.concatenate(sets))
        again = np.append(found[1:] == found[:-1], False)
        starts = np.flatnonzero(again & ~np.append(False, again[:-1]))
        n = np.add.reduceat(again, starts, dtype=np.int64) + 1 if len(starts) else starts
        return pa.RecordBatch.from_arrays([pa.array(n), pa.array(found[starts].view(np.int64))], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for value in (v for batch in batches for v in batch.column(0)):
            held.append(unpacked(value.as_py()))
            size += len(held[-1])
            if size > COUNTED:
                yield often(held)
                held, size = [], 0
        if held:
            yield often(held)

    counted = sets.select("shingles").where(F.col("shingles").isNotNull()).mapInArrow(lean(count), "n long, shingle long")
    words = _bit_words(counted.groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= common), "shingle").toPandas()
    table = np.zeros(1 << TABLE_LOG - 6, np.int64)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return table


def _word(value: Column) -> Column:
    return F.shiftrightunsigned(value, 64 - TABLE_LOG + 6)


def _bit(value: Column) -> Column:
    return F.shiftrightunsigned(value, 64 - TABLE_LOG).bitwiseAND(F.lit(63)).cast("int")


def _bit_words(rows: DataFrame, column: str) -> DataFrame:
    """(word, bits) of a bit table of the hashes in a column: at most 2^18 rows, whatever the table."""
    at = rows.select(_word(F.col(column)).alias("word"), _bit(F.col(column)).alias("bit"))
    return at.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))


def _held(sets: DataFrame, wanted: DataFrame, column: str = "shingles") -> DataFrame:
    """key, n, shingles (or sketch) of the wanted keys and few others, so that the rest never travels."""
    have = sets.where(F.col("shingles").isNotNull()).select("key", "n", column)  # copies: once per batch
    words = F.broadcast(_bit_words(wanted, "key"))  # of bounded size
    return have.join(words, _word(F.col("key")) == F.col("word")).where(F.expr("shiftright(bits, cast(shiftrightunsigned(key, %d) & 63 as int)) & 1 = 1" % (64 - TABLE_LOG))).select("key", "n", column).dropDuplicates(["key"])


def _is_common(table: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    bit = (shingles >> np.uint64(64 - TABLE_LOG)).astype(np.int64)
    return (table[bit >> 6] >> (bit & 63)) & 1 == 1


def _first_shingles(sets: DataFrame, table) -> DataFrame:
    """(shingle, key, common): the regions each set goes to."""
    schema = pa.schema([("shingle", pa.int64()), ("key", pa.int64()), ("common", pa.bool_())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                out, keys, commons = [], [], []
                for key, value in zip(part.column(0).to_pylist(), part.column(1)):
                    own = unpacked(value.as_buffer())
                    common = _is_common(table.value, own)
                    order = np.argsort(common, kind="stable")[: len(own) - (4 * len(own) + 4) // 5 + 1]
                    out.append(own[order])
                    commons.append(common[order])
                    keys.append(np.full(len(order), key, np.int64))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(out).view(np.int64)), pa.array(np.concatenate(keys)), pa.array(np.concatenate(commons))], schema=schema
                    )

    return sets.where(F.col("shingles").isNotNull()).select("key", "shingles").mapInArrow(lean(deal), "shingle long, key long, common boolean")


def _regions(firsts: DataFrame) -> DataFrame:
    """(region, key), distinct: the sets of each shingle that at least two sets have, under the least of them."""
    schema = pa.schema([("region", pa.int64()), ("key", pa.int64())])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come by shingle and key; of a run that goes on in the next batch its shingle, least and last key are kept.
        shingle = least = last = None
        for batch in batches:
            s, k = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(s):
                continue
            if shingle is not None:
                s, k = np.append(shingle, s), np.append(last, k)
            new = np.append(True, s[1:] != s[:-1])
            heads = k[np.flatnonzero(new)].copy()
            if shingle is not None:
                heads[0] = least
            head = heads[np.cumsum(new) - 1]
            other = k != head
            if shingle is not None and len(other):
                other[0] = False  # told before
            region, key = head[other], k[other]
            starts = np.unique(region)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(region, starts)), pa.array(np.append(key, starts))], schema=schema)
            shingle, least, last = s[-1], head[-1], k[-1]

    rare = (
        firsts.where(~F.col("common")).select("shingle", "key").repartition("shingle").sortWithinPartitions("shingle", "key")
        .mapInArrow(lean(runs), "region long, key long")
    )
    common = firsts.where("common").select("shingle", "key").distinct()
    least = common.groupBy("shingle").agg(F.min("key").alias("region"), F.max("key").alias("_most")).where("region < _most")
    return rare.unionByName(common.join(least.select("shingle", "region"), "shingle").select("region", "key")).distinct()


def _sized(regions: DataFrame) -> DataFrame:
    return regions.join(regions.groupBy("region").agg(F.count(F.lit(1)).alias("size")), "region")


def _per_region(rows: DataFrame, columns: list[str], work, schema: pa.Schema) -> DataFrame:
    """``work(region, columns...)`` for every region; regions are small, a task takes one after the other."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            table = pa.Table.from_batches(held).combine_chunks()
            regions = table.column("region").to_numpy()
            starts = np.flatnonzero(np.append(True, regions[1:] != regions[:-1]))
            ends = np.append(starts[1:], len(regions))
            whole = len(starts) if last else len(starts) - 1  # the last region may go on
            values = [table.column(c).to_pylist() if pa.types.is_binary(table.column(c).type) else table.column(c).to_numpy() for c in columns]
            out = [work(int(regions[a]), *(v[a:b] for v in values)) for a, b in zip(starts[:whole], ends[:whole])]
            held = [] if last else table.slice(int(starts[-1])).to_batches()
            for x in out:
                if len(x[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(x, schema)], schema=schema)

        def together(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            made = list(parts)
            if made:
                yield from pa.Table.from_batches(made).combine_chunks().to_batches()

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                yield from together(flush(False))
        if held:
            yield from together(flush(True))

    kinds = ", ".join(f"{f.name} long" for f in schema)
    return rows.select("region", *columns).repartition("region").sortWithinPartitions("region", "key").mapInArrow(lean(stream), kinds)


def _joined(regions: DataFrame, sets: DataFrame) -> DataFrame:
    """The links (a, b) within small regions: each set with the least of those it hangs together with."""

    def possible(region: int, keys: np.ndarray, sizes: np.ndarray, sketches: list[bytes]) -> tuple:
        one = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))  # a set may be held more than once
        keep = one[may_link(sizes[one], [sketches[i] for i in one])]
        return np.full(len(keep), region), keys[keep]

    def links(region: int, keys: np.ndarray, sizes: np.ndarray, shingles: list[bytes]) -> tuple:
        one = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        if len(one) < 2:
            return [], []
        keys, n = keys[one], sizes[one].astype(np.int64)
        near = linked(shared([unpacked(shingles[i]) for i in one]), n, n)
        np.fill_diagonal(near, True)
        label = np.arange(len(n))
        while True:
            least = np.where(near, label[None, :], len(n)).min(1)
            if (least == label).all():
                break
            label = least
        moved = label != np.arange(len(n))
        return keys[label[moved]], keys[moved]

    pairs = pa.schema([("region", pa.int64()), ("key", pa.int64())])
    left = stored(_per_region(regions.join(_held(sets, regions, "sketch"), "key"), ["key", "n", "sketch"], possible, pairs), "possible")
    ends = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    return _per_region(left.join(_held(sets, left), "key"), ["key", "n", "shingles"], links, ends)


def _cells(large: DataFrame, sets: DataFrame, level: int, pivots: int, share: int) -> DataFrame:
    """One Voronoi level: (of, cell as region, key, a, near) for each document, cell it goes to, and its pivot (itself in the far cell)."""
    have = _held(sets, large)
    rank = Window.partitionBy("region").orderBy(F.xxhash64("key", F.lit(level)), "key")
    chosen = large.withColumn("_n", F.row_number().over(rank)).where(F.col("_n") <= pivots).select("region", "key", "size")
    shares = F.ceil(F.col("size") / share).cast("long")
    chosen = chosen.join(have, "key").select(
        F.col("region").alias("of"), F.explode(F.sequence(F.lit(0).cast("long"), shares - 1)).alias("part"),
        F.col("key").alias("centre"), F.col("n").alias("m"), F.col("shingles").alias("held"),
    )
    members = large.join(have, "key").select("region", F.pmod(F.xxhash64("key", F.lit(-1)), shares).alias("share"), "key", "n", "shingles")

    def measure(key: tuple, own: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        own, centres = own.drop_duplicates("key"), centres.drop_duplicates("centre").sort_values("centre", ignore_index=True)
        if not len(own) or not len(centres):
            return pd.DataFrame({"of": [], "region": [], "key": [], "a": [], "near": []}).astype("int64")
        n, m = own["n"].to_numpy().astype(np.int64), centres["m"].to_numpy().astype(np.int64)
        both = shared([unpacked(s) for s in own["shingles"]], [unpacked(s) for s in centres["held"]])
        apart = 1 - both / (n[:, None] + m[None, :] - both)
        near = linked(both, n, m)
        # All bounds a hair wider than the triangle inequality needs.
        least, hair = apart.min(1, keepdims=True), 1e-9
        row, cell = np.nonzero((least <= 0.6 + hair) & (apart <= np.minimum(least + 0.4, 0.8) + hair))
        far = np.flatnonzero(least[:, 0] > 0.4 - hair)
        keys, heads = own["key"].to_numpy(), centres["centre"].to_numpy()
        seed = np.array([xxh3_64_intdigest(f"{key[0]}:{level}:{p}".encode()) - (1 << 63) for p in [*heads, "far"]], np.int64)
        return pd.DataFrame({
            "of": np.full(len(row) + len(far), key[0], np.int64), "region": np.append(seed[cell], np.full(len(far), seed[-1])), "key": np.append(keys[row], keys[far]),
            "a": np.append(heads[cell], keys[far]), "near": np.append(near[row, cell], np.zeros(len(far), bool)).astype("int64"),
        })

    return members.groupBy("region", "share").cogroup(chosen.groupBy("of", "part")).applyInPandas(
        measure, "of long, region long, key long, a long, near long"
    )


def links(sets: DataFrame, common: int = COMMON, leaf: int = LEAF, pivots: int = PIVOTS, levels: int = LEVELS, share: int = SHARE) -> DataFrame:
    """Pairs (a, b) of keys that hang together; any two linked sets are connected by them."""
    spark = sets.sparkSession
    table = spark.sparkContext.broadcast(_common_table(sets, common))
    regions = stored(_sized(_regions(_first_shingles(sets, table))), "regions")
    found = [_joined(regions.where(F.col("size") <= leaf).select("region", "key"), sets)]
    large = regions.where(F.col("size") > leaf).select("region", "key", "size")
    for level in range(levels):
        if large.isEmpty():
            break
        cells = stored(_cells(large, sets, level, pivots, share), "cells")
        near = cells.where("near = 1 AND a <> key").select("a", F.col("key").alias("b"))
        found.append(near)
        roots = components(near)
        # Where the windows reach into most cells, cells only multiply the work: such regions stay whole.
        copies = cells.groupBy("of").agg(F.count(F.lit(1)).alias("copies"))
        told = large.join(copies, large["region"] == copies["of"]).withColumn("split", F.col("copies") <= 2 * F.col("size"))
        whole = _open(told.where("NOT split").select("region", "key"), roots)
        found.append(_joined(_blocks(whole, max(1, leaf // 2)), sets))
        split = told.where("split").select(F.col("region").alias("of")).distinct()
        rest = stored(_open(cells.join(split, "of").select("region", "key"), roots), "rest")
        found.append(_joined(rest.where(F.col("size") <= leaf).select("region", "key"), sets))
        large = rest.where(F.col("size") > leaf)
    found.append(_joined(_blocks(large, max(1, leaf // 2)), sets))
    return _all(found).distinct()


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _open(cells: DataFrame, roots: DataFrame) -> DataFrame:
    """(region, key, size, odd) of the cells that hold sets not yet known to hang together; odd: not in the largest part."""
    named = cells.distinct().join(roots, F.col("key") == F.col("node"), "left").select("region", "key", F.coalesce("root", "key").alias("part"))
    parts = named.groupBy("region", "part").agg(F.count(F.lit(1)).alias("n"))
    most = parts.groupBy("region").agg(F.sum("n").alias("size"), F.max(F.struct("n", "part"))["part"].alias("main"), F.count(F.lit(1)).alias("parts"))
    return named.join(most.where("parts > 1"), "region").select("region", "key", "size", (F.col("part") != F.col("main")).alias("odd"))


def _blocks(large: DataFrame, half: int) -> DataFrame:
    """(region, key): large regions dealt over blocks, a region for each pair of blocks but those within the largest part."""
    odd = F.col("odd") if "odd" in large.columns else F.lit(True)
    large = large.select("region", "key", odd.alias("odd"))
    counts = large.groupBy("region").agg(*[F.ceil(F.count(F.when(x, 1)) / half).cast("long").alias(n) for x, n in ((F.col("odd"), "odds"), (~F.col("odd"), "evens"))])
    hashed = F.xxhash64("key", F.lit(-2))
    own = F.when(F.col("odd"), F.pmod(hashed, F.col("odds"))).otherwise(F.col("odds") + F.pmod(hashed, F.col("evens")))
    others = F.when(F.col("odd"), F.col("odds") + F.col("evens")).otherwise(F.col("odds"))
    dealt = large.join(counts, "region").select("region", "key", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), others - 1)).alias("other"))
    return dealt.select(F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other")).alias("region"), "key")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge: the least node it hangs together with, by large and small stars."""
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id that links reach) of every row of ``docs``."""
    sets = stored(shingle_sets(docs), "shingle-sets")
    roots = components(links(sets, **options))
    known = sets.select("doc_id", "key", F.col("n").cast("long").alias("n_shingles"))
    known = known.join(roots, known["key"] == roots["node"], "left").select("doc_id", "n_shingles", F.coalesce("root", "key").alias("set"))
    known = stored(known, "set-of-doc")
    least = known.where(F.col("set").isNotNull()).groupBy("set").agg(F.min("doc_id").alias("least"))
    return known.join(least, "set", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the least of its component (or null), all columns as they are."""
    found = near_duplicates(docs.select("doc_id", "text"), **options)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
