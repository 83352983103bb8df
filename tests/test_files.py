import gzip
import os

import pytest

from vistaframe.session import local_path, scratch_path
from vistaframe.sources import files as FS


def written(path):
    return [(d, f) for d, _, names in os.walk(local_path(path).removeprefix("file://")) for f in names]


def test_a_file_a_document_in_few_folders(spark, monkeypatch):
    monkeypatch.setattr(FS, "FOLDER_FILES", 50)
    rows = [(i, f"text {i}\nline\n") for i in range(-100, 300)]
    path = scratch_path(spark, "test", "docs")
    FS.write_documents(spark.createDataFrame(rows, "doc_id long, text string"), path, "doc_id", "text")
    files = written(path)
    assert sorted(f for _, f in files) == sorted(f"doc-{i}.txt" for i, _ in rows)
    assert len({d for d, _ in files}) < 20  # not one a document
    got = FS.read_documents(spark, path, "doc_id", "text")
    assert dict(got.dtypes) == {"doc_id": "bigint", "text": "string"}
    assert sorted(map(tuple, got.collect())) == rows


def test_odd_documents(spark):
    rows = [(1, None), (2, ""), (None, "no id"), (3, "ü\r\n\n"), (4, "twice"), (4, "twice")]
    path = scratch_path(spark, "test", "odd")
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for _ in range(2):  # the second time over the first
        FS.write_documents(frame, path, "doc_id", "text")
    got = FS.read_documents(spark, path, "doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, ""), (2, ""), (None, "no id"), (3, "ü\r\n\n"), (4, "twice\ntwice")], key=str)


def test_no_documents(spark):
    path = scratch_path(spark, "test", "none")
    FS.write_documents(spark.createDataFrame([], "doc_id long, text string"), path, "doc_id", "text")
    assert FS.read_documents(spark, path, "doc_id", "text").collect() == []


def test_tasks_list_the_files(spark, monkeypatch):
    """No reader that holds all files' names on the driver; several files and bytes a batch and a task."""
    for name, value in {"FOLDER_FILES": 20, "TASK_FILES": 15, "BATCH_FILES": 4, "BATCH_BYTES": 30}.items():
        monkeypatch.setattr(FS, name, value)
    rows = [(i, "x" * (i % 50) + f"\r\n{i} ü\n") for i in range(300)]
    path = scratch_path(spark, "test", "listed")
    FS.write_documents(spark.createDataFrame(rows, "doc_id long, text string"), path, "doc_id", "text")
    got = FS.read_documents(spark, path, "doc_id", "text")
    plan = got._jdf.queryExecution().toString()
    assert "FileScan" not in plan and "Relation [" not in plan
    assert got.rdd.getNumPartitions() >= 20
    assert sorted(map(tuple, got.collect())) == rows


def test_nested_hidden_and_empty_files(spark):
    base = local_path(scratch_path(spark, "test", "nested")).removeprefix("file://")
    bodies = {"doc-1.txt": b"top\n", "a/doc-2.txt": b"one\n", "a/b/c/doc--3.txt": b"deep\n", "a/_SUCCESS": b"no\n", "a/.doc-5.txt": b"no\n",
              "_temporary/doc-6.txt": b"no\n", "a/doc-7.txt": b"", "b/other.txt": b"no id\n", "b/doc-8.txt.gz": gzip.compress(b"packed\n")}
    for name, body in bodies.items():
        os.makedirs(os.path.dirname(f"{base}/{name}"), exist_ok=True)
        with open(f"{base}/{name}", "wb") as f:
            f.write(body)
    got = sorted(map(tuple, FS.read_documents(spark, base, "doc_id", "text").collect()), key=str)
    assert got == sorted([(1, "top"), (2, "one"), (-3, "deep"), (None, "no id"), (8, "packed")], key=str)
    with pytest.raises(FileNotFoundError):
        FS.read_documents(spark, f"{base}/none", "doc_id", "text")
