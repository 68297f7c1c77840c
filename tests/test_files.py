"""Files of documents: created whole, never over others, gone when the job fails, kept by a task that runs again."""

import os

import pytest
from pyspark.sql import functions as F

from maskloom.sources import correspondence, document_files


def write(df, folder):
    document_files.write_document_files(df, str(folder), F.col("name"), F.col("content"), F.col("line"))


def files(folder):
    return {e.name: (folder / e.name).read_text() for e in os.scandir(folder)}


def test_each_document_is_one_file(spark, tmp_path):
    rows = [(f"d{i % 40}.txt", f"line {i}\n", i) for i in range(400)] + [("ünï.txt", "é", 0), ("none.txt", None, 0)]
    write(spark.createDataFrame(rows, "name string, content string, line int"), tmp_path)
    got = files(tmp_path)
    assert len(got) == 42 and got["d3.txt"] == "".join(f"line {i}\n" for i in range(3, 400, 40)) and got["ünï.txt"] == "é" and got["none.txt"] == ""


@pytest.mark.parametrize("taken", ["b.txt", "../b.txt", "", None, ".hidden"])
def test_a_refused_job_leaves_nothing(spark, tmp_path, taken):
    folder = tmp_path / "out"
    folder.mkdir()
    (folder / "b.txt").write_text("mine")
    rows = [(f"n{i}.txt", "x", 0) for i in range(30)] + [(taken, "theirs", 0)]
    with pytest.raises(Exception, match="not written over" if taken == "b.txt" else "not the name"):
        write(spark.createDataFrame(rows, "name string, content string, line int"), folder)
    assert files(folder) == {"b.txt": "mine"} and os.listdir(tmp_path) == ["out"]


def test_a_task_that_runs_again_knows_its_files(tmp_path):
    rows = [{"name": "a", "content": "1"}, {"name": "a", "content": "2"}, {"name": "b", "content": b"3"}]
    writer = document_files.DocumentFilesWriter(str(tmp_path), "job")
    done = [writer.write(iter(rows)), writer.write(iter(rows))]
    other = document_files.DocumentFilesWriter(str(tmp_path), "other")
    with pytest.raises(FileExistsError, match="not written over"):
        other.write(iter([{"name": "c", "content": "4"}, *rows]))
    other.abort([None])
    writer.commit(done)
    assert files(tmp_path) == {"a": "12", "b": "3"}


def test_tables_come_back(spark, tmp_path):
    rows = [("d1", "[Person 1]", "", "Person", 'Ann "A", O\'Neil\nof X'), ("d1", "[Org 1]", "[Firm]", "Organization", "=Sum & Co"), ("d2", "[Date 1]", None, "Date", None)]
    table = spark.createDataFrame(rows, "doc string, placeholder string, label string, category string, original string")
    correspondence.write_tables(table, str(tmp_path / "t"), "doc")
    back = correspondence.read_correspondence(spark, str(tmp_path / "t"))
    got = {(r.file.split("/")[-1], r.placeholder, r.label, r.category, r.original) for r in back.collect()}
    assert got == {(f"{d}.csv", p, label or "", c, o or "") for d, p, label, c, o in rows}


def test_many_tables_are_read_by_as_many_tasks_as_there_are_cores(spark, tmp_path):
    """a task for every few files, and a list of all of them on the driver, took most of the time."""
    table = spark.range(300).selectExpr("id", "'[A 1]' AS placeholder", "'' AS label", "'Person' AS category", "concat('é,', id) AS original")
    correspondence.write_tables(table, str(tmp_path), "id")
    (tmp_path / ".job").mkdir()
    (tmp_path / ".draft.csv").write_text("not a table")
    assert (tmp_path / "7.csv").read_bytes() == '\ufeffplaceholder,label,category,original\r\n[A 1],,Person,"é,7"\r\n'.encode()
    back = correspondence.read_tables(spark, str(tmp_path))
    assert back.rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
    assert sorted((r.file.split("/")[-1], r.original) for r in back.collect()) == sorted((f"{i}.csv", f"é,{i}") for i in range(300))
    old = correspondence.read_correspondence(spark, str(tmp_path))
    assert sorted(tuple(r)[1:] for r in back.collect()) == sorted(tuple(r)[1:] for r in old.collect())
