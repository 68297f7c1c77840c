"""Registered queries of this subpackage against their SQL, and the pipeline against plain Python."""

import sys
from pathlib import Path

import public_tokenizers
import pytest
from edge import shingles
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402
from compare import KINDS, connect  # noqa: E402

from maskloom.llm import queries, secrets  # noqa: E402
from test_near import _components  # noqa: E402
from test_scans import _hits  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_agrees_with_its_sql(spark, name):
    df, rel = queries.QUERIES[name](spark, SF), connect(SF).sql(queries.ORACLES[name])
    assert sorted(rel.columns) == sorted(df.columns)
    assert {c: KINDS[str(t)] for c, t in zip(rel.columns, rel.types)} == dict(df.dtypes)
    rows = [tuple(r) for r in df.select(*rel.columns).collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, rel.fetchall()))


def test_every_operator_has_a_query(spark):
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {i: t for i, t in docs.items() if t and any(c.isalpha() for c in t)}
    component, _ = _components(left)
    left = {i: t for i, t in left.items() if component[i] == i and not _hits(t, items)[1]}
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: len(whole.encode(secrets.masked(t), add_special_tokens=False).ids) + 1 for i, t in left.items()}
    got, held = {}, {}
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r["doc_id"]] = r["doc_tokens"]
        held[r["doc_id"]] = held.get(r["doc_id"], 0) + r["length"]
    assert got == want == held


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "jaccard_join", "decontaminate", "secrets", "pack"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
