from __future__ import annotations

import math
import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from plaza.llm.queries import ORACLES, QUERIES

ROOT = Path(__file__).resolve().parents[2]
SMALL = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "embeddings", "labels", "benchmark", "conversations")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    found = QUERIES[name](spark, SMALL)
    wanted = connection.sql(ORACLES[name])
    columns = sorted(found.columns)
    assert sorted(wanted.columns) == columns
    key = lambda row: tuple((x is not None, str(x)) for x in row)
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=key) == sorted(wanted.select(*columns).fetchall(), key=key)


def test_one_query_for_each_number():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


def test_stages_in_turn(spark, tmp_path):
    """Each stage works on what its predecessor kept; all but the last return documents' columns."""
    read = docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    sizes = [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        sizes.append(docs.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.dtypes == read.dtypes
    assert sizes[0] == sizes[1] > sizes[2] == sizes[3]
    found = docs.collect()
    used = {}
    for r in found:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert max(used.values()) <= 2048 and len(used) <= math.ceil(sum(used.values()) / 2048) + 2
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).select("doc_id", "piece", "start", "length", "ids_crc32").collect())) == sorted(
        (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found
    )


def test_pipeline_of_nothing(spark, docs):
    frame = docs()
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SMALL)
    assert frame.collect() == []


def test_the_rest_imports_without_this_package(tmp_path):
    for name in ("plaza", "checks", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(ROOT / name) if name != "plaza" else (tmp_path / name).mkdir()
    for item in (ROOT / "plaza").iterdir():
        if item.name not in ("llm", "__pycache__"):
            (tmp_path / "plaza" / item.name).symlink_to(item)
    code = "import sys; sys.path.insert(0, '.'); exec(open('__spark_entry__.py').read().replace('__file__', repr('./x'))); print(len(queries()), any(q.startswith('op') for q in queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and done.stdout.split()[-1] == "False", done.stderr
