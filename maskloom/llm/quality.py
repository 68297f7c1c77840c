"""Quality and toxicity of documents: a text classifier's evidence, shrunk over sites.

Classifier: shape features of the text (shares of letters, capitals, digits and marks, words per line,
repeated words and lines, ...) and words that labelled documents of one class hold unusually often, in a
logistic regression each for quality and toxicity. It is fitted on at most ``sample`` labelled documents
(the bound; those with the smallest hash of doc_id), whole texts.

Sites: a document's path lies in a host, the host in the whole. The classifier's probabilities of all
documents are summed by path, paths by host, hosts over all. A host's posterior is
(sum + m * prior) / (n + m) with the whole's rate as prior, a path's the same with its host's posterior; m,
how many documents a prior counts for, comes from how much the rates of the units of that level vary (moments of a beta
distribution). So sparse sites lean on what is above them. A document's answer is its classifier's log
odds moved by how far its path's log odds lie from the whole's.

Cases: a null or empty text has shape features of 0; a null source is a site of its own; without labelled
rows every probability is 1/2 and everything is kept; repeated rows count each and are scored each;
labels that contradict each other each count; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.llm.store import lean, stored

SAMPLE, LEXICON = 12_000, 1_000
#: How far from chance (standard deviations) and how frequent a word must be to count as evidence.
SIGNIFICANT, LEAST = 5.5, 4
_WORD = re.compile(r"[^\W\d_]+")
_SHAPES = 12
TARGETS = ["quality", "toxic"]


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def shape(text: str | None) -> list[float]:
    """Features of a text's form, each about 0 to 3."""
    if not text:
        return [0.0] * _SHAPES
    n = len(text)
    words, lines = text.split(), text.split("\n")
    count = max(len(words), 1)
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    upper = int(((data >= 65) & (data <= 90)).sum())
    lower = int(((data >= 97) & (data <= 122)).sum())
    digits = int(((data >= 48) & (data <= 57)).sum())
    spaces = int(((data == 32) | (data == 10)).sum())
    beyond = int((data >= 128).sum())
    marks = len(data) - upper - lower - digits - spaces - beyond
    following = sum(a == b for a, b in zip(words, words[1:]))
    return [
        math.log10(n + 1) / 2, upper / n * 3, digits / n * 10, marks / n * 10, text.count("|") / count * 3, text.count("!") / count * 3,
        len(set(words)) / count, following / count * 3, n / count / 10, min(count / len(lines) / 30, 3.0),
        1 - len(set(lines)) / len(lines), beyond / n * 5,
    ]


#: Shares a site's documents are dealt over when its posterior is joined to them, and the labelled ones when they are counted.
SALTS = 32


class Classifier:
    """Two logistic regressions over shape features and lexicon sums; ``None`` weights say 1/2."""

    def __init__(self, lexicons: list[dict[str, float]], weights: list[np.ndarray | None]) -> None:
        self.lexicons, self.weights = lexicons, weights

    def log_odds(self, text: str | None) -> list[float]:
        shapes, words = shape(text), words_of(text)
        return [
            0.0 if w is None else float(np.clip(np.dot(w, features(shapes, words, own)), -30, 30)) for w, own in zip(self.weights, self.lexicons)
        ]


def features(shapes: list[float], words: set[str], own: dict[str, float]) -> list[float]:
    """What one regression weighs: its constant, the text's form, and evidence of the lexicon's words for and against."""
    found = sorted(own[w] for w in words if w in own)
    return [1.0, *shapes, min(sum(x for x in found if x > 0), 20.0) / 5, max(sum(x for x in found if x < 0), -20.0) / 5]


def lexicons_of(rows: DataFrame, known: list[tuple[int, int]]) -> list[dict[str, float]]:
    """For each target the log odds of the words whose share of positive documents is far from the whole's.

    Tasks count the words of the (labelled) rows; ``known`` are how many rows have a label, and a positive one.
    """
    schema = pa.schema([("target", pa.int64()), ("word", pa.string()), ("n", pa.int64()), ("positive", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, positive = Counter(), Counter()
        for batch in batches:
            for text, *marks in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                for t, mark in enumerate(marks):
                    if mark is not None:
                        total.update((t, w) for w in words)
                        if mark:
                            positive.update((t, w) for w in words)
        met = list(total)
        for i in range(0, len(met), 10_000):
            some = met[i : i + 10_000]
            columns = [t for t, _ in some], [w for _, w in some], [total[m] for m in some], [positive[m] for m in some]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    counted = rows.select("text", *TARGETS).mapInArrow(lean(count), "target long, word string, n long, positive long")
    words = counted.groupBy("target", "word").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive")).where(F.col("n") >= LEAST)
    out = []
    for t, (n, ones) in enumerate(known):
        if ones in (0, n):
            out.append({})
            continue
        rate = ones / n
        far = F.abs((F.col("positive") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate)))
        best = words.where((F.col("target") == t) & (far >= SIGNIFICANT)).orderBy(far.desc(), "word").limit(LEXICON).collect()
        shares = {r["word"]: (r["positive"] + rate) / (r["n"] + 1) for r in best}
        out.append({word: math.log(p / (1 - p)) - math.log(rate / (1 - rate)) for word, p in shares.items()})
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights by Newton's method with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += move
        if np.abs(move).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """The classifier of a bounded sample, sent to the tasks (bounded by ``LEXICON``).

    Texts and their words stay in the tasks: to the driver go the lexicons and a short row of numbers a document.
    """
    chosen = labels.select("doc_id", *TARGETS).where(F.col("doc_id").isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id", *TARGETS).limit(sample)
    marks = chosen.groupBy("doc_id").agg(F.min(F.struct(*TARGETS)).alias("marks")).select("doc_id", "marks.*")
    texts = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")  # ``sample`` rows at most
    rows = stored(texts.orderBy("doc_id", "text").limit(sample).repartition(SALTS, "doc_id"), "labelled")
    sums = rows.agg(*[f(F.col(t)).alias(f"{t}_{n}") for t in TARGETS for n, f in (("n", F.count), ("sum", lambda c: F.sum(F.when(c != 0, 1).otherwise(0))))]).first()
    lexicons = lexicons_of(rows, [(sums[f"{t}_n"], sums[f"{t}_sum"] or 0) for t in TARGETS])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            formed = [(shape(t), words_of(t)) for t in batch.column(1).to_pylist()]
            columns = [pa.array([np.array(features(s, w, own)).tobytes() for s, w in formed], pa.binary()) for own in lexicons]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], *columns], names=["doc_id", *TARGETS, *(f"{t}_x" for t in TARGETS)])

    schema = "doc_id long, quality int, toxic int, quality_x binary, toxic_x binary"
    weighed = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[F.col(t).cast("int").alias(t) for t in TARGETS]).mapInArrow(lean(weigh), schema)
    found = weighed.orderBy("doc_id", "quality_x", "toxic_x").collect()
    weights: list[np.ndarray | None] = []
    for t in TARGETS:
        known = [r for r in found if r[t] is not None]
        y = np.array([r[t] for r in known], float)
        weights.append(logistic(np.array([np.frombuffer(r[f"{t}_x"]) for r in known]), y) if len(y) and y.min() < y.max() else None)
    return docs.sparkSession.sparkContext.broadcast(Classifier(lexicons, weights))


def evidence(docs: DataFrame, classifier, host: Column, path: Column) -> DataFrame:
    """doc_id, host, path and the classifier's log odds of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("quality", pa.float64()), ("toxic", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odds = [classifier.value.log_odds(t.as_py()) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array([o[t] for o in odds], pa.float64()) for t in range(2))], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"), "text")
    return rows.mapInArrow(lean(score), "doc_id long, host string, path string, quality double, toxic double")


def _probability(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def _odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(rate: Column, unit: Column, n: Column) -> Column:
    """How many documents a prior counts for, from the spread of the rates of the units below it (1 to 1000)."""
    spread = F.sum(n * (unit - rate) * (unit - rate)) / F.sum(n)
    return F.greatest(F.lit(1.0), F.least(F.lit(1000.0), F.max(rate * (1 - rate)) / F.greatest(spread, F.lit(1e-9)) - 1))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """path, host and for each target the whole's rate and the path's posterior."""
    site = scored.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(_probability(F.col(t))).alias(f"{t}_sum") for t in TARGETS]
    )
    hosts = site.groupBy("host").agg(F.sum("n").alias("host_n"), *[F.sum(f"{t}_sum").alias(f"{t}_host") for t in TARGETS])
    whole = hosts.agg(F.sum("host_n").alias("all_n"), *[F.sum(f"{t}_host").alias(f"{t}_all") for t in TARGETS])
    whole = whole.select(*[(F.col(f"{t}_all") / F.col("all_n")).alias(f"{t}_rate") for t in TARGETS])
    hosts = hosts.join(F.broadcast(whole))  # one row
    spread = hosts.agg(*[_strength(F.col(f"{t}_rate"), F.col(f"{t}_host") / F.col("host_n"), F.col("host_n")).alias(f"{t}_m") for t in TARGETS])
    hosts = hosts.join(F.broadcast(spread)).select(  # one row
        "host", *[F.col(f"{t}_rate") for t in TARGETS],
        *[((F.col(f"{t}_host") + F.col(f"{t}_m") * F.col(f"{t}_rate")) / (F.col("host_n") + F.col(f"{t}_m"))).alias(f"{t}_above") for t in TARGETS],
    )
    site = site.withColumnRenamed("host", "_host").join(hosts, F.col("_host").eqNullSafe(F.col("host"))).drop("_host")
    spread = site.agg(*[_strength(F.col(f"{t}_above"), F.col(f"{t}_sum") / F.col("n"), F.col("n")).alias(f"{t}_m") for t in TARGETS])
    return site.join(F.broadcast(spread)).select(  # one row
        "host", "path", *[F.col(f"{t}_rate") for t in TARGETS],
        *[((F.col(f"{t}_sum") + F.col(f"{t}_m") * F.col(f"{t}_above")) / (F.col("n") + F.col(f"{t}_m"))).alias(f"{t}_site") for t in TARGETS],
    )


def assess(docs: DataFrame, labels: DataFrame, host: Column, path: Column, sample: int = SAMPLE) -> DataFrame:
    """doc_id, host, path, p_quality, p_toxic, and keep: likely good and not likely toxic."""
    scored = stored(evidence(docs, fit(docs, labels, sample), host, path), "evidence")
    sites = stored(site_posteriors(scored), "sites").select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"),
        *[F.col(f"{t}_{x}") for t in TARGETS for x in ("rate", "site")],
    )
    rows = scored.withColumn("salt", F.pmod(F.xxhash64("doc_id", "quality"), F.lit(SALTS)).cast("int"))
    joined = rows.join(
        sites, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")) & (F.col("salt") == F.col("_salt"))
    )
    moved = [
        _probability(F.col(t) + _odds(_inner(F.col(f"{t}_site"))) - _odds(_inner(F.col(f"{t}_rate")))).alias(f"p_{t}") for t in TARGETS
    ]
    return joined.select("doc_id", "host", "path", *moved).withColumn("keep", (F.col("p_quality") >= 0.5) & (F.col("p_toxic") <= 0.5))


def _inner(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
