import importlib
import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import corpus_pipeline

REPO = Path(__file__).parents[2]


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, last = docs.columns, docs
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = Counter(r.doc_id for r in last.select("doc_id").collect())
        result = corpus_pipeline.written(stage(spark, last, sf_dir), "test-stage")
        after = Counter(r.doc_id for r in result.select("doc_id").collect())
        assert set(after) <= set(before)
        if name != "token_ids":
            assert result.columns == columns
        if name in ("near_dedup", "decontamination"):
            assert sum(after.values()) < sum(before.values())
        if name == "token_ids":
            assert after == before
        last = result
        seen.append(name)
    assert len(seen) == 5
    run = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, last.collect()))


def test_stages_take_odd_documents(spark, sf_dir):
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(None,) * 5, (1, "", None, None, 0)], source.schema)
    for rows in (odd, source.limit(0), source.limit(30).unionByName(odd)):
        docs = rows
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, sf_dir), "test-odd")
        docs.collect()


def test_language_stage_takes_texts_of_few_bytes(spark, sf_dir):
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    short = ["a", "De", "De.", "Von.", "Avec."]
    rows = [(10**9 + i, short[i % 5], "de", "src0", len(short[i % 5])) for i in range(40)]
    docs = source.limit(30).unionByName(spark.createDataFrame(rows, source.schema))
    kept = corpus_pipeline.identify_language(spark, docs, sf_dir)
    assert {r.doc_id for r in kept.collect()} >= {i for i, *_ in rows}


def test_entry_works_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    keep = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__")
    shutil.copytree(REPO, copy, ignore=keep)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True)


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert set(entry.oracle_sql()) <= set(entry.queries())
