"""Texts as they arrive: removed or tagged with tags that last over a conversation."""

from __future__ import annotations

import bisect
import uuid
from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from maskloom import schemas as C
from maskloom.functions import labels as L
from maskloom.functions import patterns as P
from maskloom.functions import spans as S
from maskloom.operators import redact as R
from maskloom.session import checkpoint_dir, kept

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def read_text_stream(spark: SparkSession, folder: str, schema: StructType | str, pattern: str = "*.parquet",
                     files_per_trigger: int | None = None) -> DataFrame:
    """New parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def run_available(stream: DataFrame, name: str, mode: str = "append", idle: bool = True) -> DataFrame:
    """Run a stream over all that is there now and give the rows it wrote.

    Output and offsets go to the shared checkpoint folder, under a new name for each run. ``idle`` lets it go on
    without new rows, which event-time timers need at the end; with state that ages by the clock it would never stop.
    """
    spark = stream.sparkSession
    base = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{base}/state")
    before = spark.conf.get(_NO_DATA, "true")
    spark.conf.set(_NO_DATA, str(idle).lower())
    try:
        query = writer.format("parquet").option("path", f"{base}/rows").start()
    finally:
        spark.conf.set(_NO_DATA, before)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def stream_redact(texts: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """Stateless: the batch operator on a stream."""
    return R.redact(texts, categories)


class _Tagger(StatefulProcessor):
    """Entities of one conversation and their numbers, kept for as long as it goes on."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._numbers = handle.getMapState("numbers", "entity string", "number int")
        self._counts = handle.getMapState("counts", "category string", "number int")

    def _number(self, category: str, key: str) -> int:
        entity = (f"{category}|{key}",)
        if self._numbers.containsKey(entity):
            return self._numbers.getValue(entity)[0]
        count = (self._counts.getValue((category,))[0] if self._counts.containsKey((category,)) else 0) + 1
        self._counts.updateValue((category,), (count,))
        self._numbers.updateValue(entity, (count,))
        return count

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        # Numbers follow the turns within a micro-batch, and arrival between micro-batches.
        batch = pd.concat(list(rows)).sort_values("turn", kind="stable")
        texts = []
        for text, spans in zip(batch["text"], batch["spans"]):
            out, at = [], 0
            for s in spans if spans is not None else []:
                tag = f"[{s['label']} {self._number(s['category'], s['key'])}]"
                out += [text[at:s["start"]], tag]
                at = s["end"]
            texts.append(text if text is None else "".join(out) + text[at:])
        yield pd.DataFrame({"conv_id": batch["conv_id"], "turn": batch["turn"], "text": texts})

    def close(self) -> None:
        pass


def stream_pseudonymize(turns: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """(conv_id, turn, text) with tags that stay the same over all turns of a conversation.

    Spans are found in the JVM; only their numbering is stateful, and the state holds entities, not texts.
    """
    spark = turns.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spans = F.transform(
        S.pattern_spans(F.col("text"), categories),
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["category"].alias("category"),
            P.entity_key(s["category"], s["surface"]).alias("key"),
            L.label(s["category"], F.lit("en")).alias("label"),
        ),
    )
    return turns.select("conv_id", "turn", "text", spans.alias("spans")).groupBy("conv_id").transformWithStateInPandas(
        _Tagger(), "conv_id bigint, turn bigint, text string", "append", "none"
    )


def pseudonymize_turns(turns: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """The batch twin: one numbering per conversation, by turn and place, for conversations of any length.

    The mentions, few beside the texts, are kept: texts are searched once and written once.
    """
    from maskloom.operators import detect, entities

    spans = detect.detect_patterns(turns, categories, ["conv_id", "turn"]).withColumn(
        "entity", P.entity_key(F.col("category"), F.col("surface"))
    )
    # Places of a turn fit 31 bits, so turn and place make one ordered number.
    place = F.shiftleft(F.col("turn").cast("bigint"), 31) + F.col("start")
    mentions = kept(spans.withColumn("pos", place).withColumnRenamed("conv_id", "doc_id"))
    # Numbered in buckets of a thousand turns.
    tags = entities.assign_tags(mentions, width=2 ** 31 * 1024)
    tags = tags.withColumn("tag", L.tag(F.col("category"), F.lit("en"), F.col("number")))
    tagged = entities.tag_mentions(mentions, tags).withColumnRenamed("doc_id", "conv_id")
    return R.apply_spans(turns, tagged, ["conv_id", "turn"])


class _Openers(StatefulProcessor):
    """Times at which requests of one key opened a job, each kept until no request in time can fall near it."""

    def __init__(self, hours: int) -> None:
        self._life = hours * 3_600_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._openers = handle.getListState("openers", "at long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        batch["id"] = [r["request_id"] for r in batch["rest"]]
        batch = batch.sort_values(["asked_at", "id"], kind="stable").drop_duplicates("asked_at")
        known = sorted(at for (at,) in self._openers.get())
        opens = []
        for at in map(int, batch["asked_at"]):
            i = bisect.bisect_right(known, at)
            new = (i == 0 or at >= known[i - 1] + self._life) and (i == len(known) or known[i] >= at + self._life)
            if new:
                known.insert(i, at)
                self._handle.registerTimer(-(-(at + self._life) // 1000))
            opens.append(new)
        if any(opens):
            self._openers.put([(at,) for at in known])
        yield batch.loc[opens, ["job_key", "asked_at", "rest"]]

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        gone = expiredTimerInfo.getExpiryTimeInMs() * 1000 - self._life
        known = [(at,) for (at,) in self._openers.get() if at > gone]
        if known:
            self._openers.put(known)
        else:
            self._openers.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_dedupe_jobs(requests: DataFrame, hours: int = C.KEY_LIFETIME_HOURS) -> DataFrame:
    """The requests (request_id, job_key, ts, …) that open a job; repeats within ``hours`` of an opener are dropped.

    A key asked for again after that opens another job. Within a micro-batch requests count by time, then request_id, as in
    the batch operator; between micro-batches by arrival: one that comes late, less than ``hours`` before an opener, repeats
    it. A request without a time opens nothing. Openers go once the watermark (``hours`` behind) has passed their life.
    """
    requests.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rest = [c for c in requests.columns if c not in ("job_key", "ts")]
    asked = requests.where(F.col("ts").isNotNull()).withWatermark("ts", f"{hours} hours")
    asked = asked.select("job_key", "ts", F.unix_micros("ts").alias("asked_at"), F.struct(*rest).alias("rest"))
    out = StructType([asked.schema[c] for c in ("job_key", "asked_at", "rest")])
    opened = asked.groupBy("job_key").transformWithStateInPandas(_Openers(hours), out, "append", "EventTime")
    return opened.select(*(F.timestamp_micros("asked_at").alias(c) if c == "ts" else F.col(c if c == "job_key" else f"rest.{c}") for c in requests.columns))
