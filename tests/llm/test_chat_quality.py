"""Chat windows and site quality."""

import hashlib
from collections import defaultdict

import pytest
from edge import documents, empty
from pyspark.sql import functions as F

from maskloom.llm import chat, quality

SCHEMA = "conv_id long, turn long, role string, text string, window int, tokens string, number int"


def _conversations(spark):
    rows = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows += [(1, 0, "system", "be brief"), *((1, i, "user" if i % 2 else "assistant", f"turn {i} " + "word " * (i * 7 % 40)) for i in range(1, 60))]
    rows += [(2, 0, None, None), (2, 0, "assistant", ""), (2, None, "assistant", "<|end|>\n<|user|>\nno \\ [x] |>"), (2, 1, "assistant", "w " * 5000)]
    rows += [(3, 1, "a<|b\nc", "x")] * 2 + [(None, 0, "user", "lost"), (None, 1, "assistant", "found")]
    return spark.createDataFrame([(*r, 1, "t", 2) for r in rows], SCHEMA)


def _said(conversations):
    held = defaultdict(list)
    for r in conversations.collect():
        held[r["conv_id"]].append(((r["turn"] is not None, r["turn"] or 0), r["role"] or "", r["text"] or ""))
    return {k: [t[1:] for t in sorted(v)] for k, v in held.items()}


@pytest.mark.parametrize("budget, history, history_tokens", [(1024, 2, 256), (60, 3, 30), (1, 1, 5)])
def test_windows(spark, budget, history, history_tokens):
    conversations = _conversations(spark)
    windows = chat.windows(conversations, budget, history, history_tokens)
    want = _said(conversations)
    for r in chat.read_back(windows).collect():
        own = want[r["conv_id"]]
        loss = "".join(text for role, text in own if role == "assistant")
        assert r["n_turns"] == len(own)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    rows = windows.select("*", chat.turns_of(F.col("formatted")).alias("turns")).collect()
    for r in rows:
        assert r["n_tokens"] <= budget or r["n_turns"] - r["n_repeated"] == 1
        assert len(r["turns"]) == r["n_turns"] and r["n_repeated"] <= history + 1
        for control in ("</s>", "[INST]", "[/INST]"):
            assert control not in r["formatted"]
    later = [r for r in rows if r["conv_id"] == 1 and (r["stretch"], r["window"]) != min((x["stretch"], x["window"]) for x in rows if x["conv_id"] == 1)]
    assert all(r["turns"][0]["text"] == "be brief" for r in later) and (later or budget > 1000)
    assert chat.windows(conversations.limit(0)).count() == 0


def test_quality_catches_toxic_and_keeps_clean(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    # Labels of one half teach, the other half is held out.
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    found = quality.assess(docs, labels.where(half == 0), F.col("source"), F.concat_ws("/", "source", "lang"))
    held = found.join(labels.where(half == 1), "doc_id")
    right = held.groupBy("quality", "toxic").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()
    kept = {(r["quality"], r["toxic"]): r["kept"] for r in right}
    assert kept[1, 0] > 0.97 and kept[0, 0] < 0.1 and kept[1, 1] < 0.15


def test_quality_of_awkward_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (8, 0, 1), (11, None, 1), (None, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        rows = quality.assess(docs, some, F.col("source"), F.col("lang")).collect()
        assert len(rows) == docs.count() and all(0 <= r["p_quality"] <= 1 and 0 <= r["p_toxic"] <= 1 for r in rows)
    assert all(r["keep"] for r in rows)
    assert quality.assess(empty(spark), labels, F.col("source"), F.col("lang")).count() == 0


def test_sparse_sites_lean_on_what_is_above(spark):
    scored = spark.createDataFrame(
        [(i, f"h{i % 20}", f"h{i % 20}/p{i % 3}", 3.0 if i % 20 < 10 else -3.0, 0.0) for i in range(600)] + [(9999, "rare", "rare/x", 3.0, 0.0)],
        "doc_id long, host string, path string, quality double, toxic double",
    )
    site = {r["path"]: r for r in quality.site_posteriors(scored).collect()}
    assert site["h1/p1"]["quality_site"] > 0.9 and site["h11/p2"]["quality_site"] < 0.1
    assert 0.5 < site["rare/x"]["quality_site"] < site["h1/p1"]["quality_site"]


def test_quality_keeps_texts_off_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    docs = spark.createDataFrame([(i, "good words here" if i % 2 else "bad!!! words") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    collect, sent = DataFrame.collect, []
    monkeypatch.setattr(DataFrame, "collect", lambda self: sent.append(self.columns) or collect(self))
    monkeypatch.setattr(DataFrame, "toLocalIterator", lambda self, *a: sent.append(self.columns) or iter(collect(self)))
    odds = [quality.fit(docs, labels).value.log_odds(t)[0] for t in ("good words here", "bad!!! words")]
    assert odds[0] > 0 > odds[1] and sent and not any("text" in columns for columns in sent)
