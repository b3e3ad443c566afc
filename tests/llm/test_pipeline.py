import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import probminhash
from ledgerlake.llm.decontaminate import contamination

ROOT = Path(corpus_pipeline.__file__).parent


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, step in corpus_pipeline.STAGES:
        kept = step(spark, docs, sf)
        if name != "sentencepiece":
            assert kept.columns == docs.columns
            assert kept.count() <= docs.count()
        kept.write.mode("overwrite").parquet(path := str(tmp_path / name))
        after = spark.read.parquet(path)
        assert after.join(docs, docs.columns, "left_anti").isEmpty()
        if name == "near_dedup":
            again = probminhash.classes(after)
            assert again.where("class_id != doc_id").isEmpty()
        if name == "decontamination":
            assert contamination(after, spark.read.parquet(f"{sf}/benchmark.parquet")).where("contaminated").isEmpty()
        if name == "sentencepiece":
            assert after.count() == docs.count() and after.where(~F.col("lossless")).isEmpty()
        docs = after


def made(spark, folder, docs, names="doc_id bigint, text string, score string, digest string, n int"):
    labels = [(i, i % 2, (i // 2) % 2) for i in range(60)]
    spark.createDataFrame(docs, names).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([("a", "one two three")], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_odd_rows(spark, tmp_path):
    docs = [(i, f"text number {i} has a few words of its own", "x", None, 1) for i in range(40)]
    docs += [(None, None, None, None, None), (None, "", "x", "y", 2), (41, None, "x", "y", 2), (42, "", "x", "y", 2)]
    docs += [(43, "repeated row of some words", "x", "y", 2)] * 3 + [(44, "long words " * 30_000, "x", "y", 2)]
    got = corpus_pipeline.run(spark, made(spark, tmp_path, docs)).collect()
    assert all(r["lossless"] and r["score"] in ("x", None) for r in got)
    assert len([r for r in got if r["doc_id"] == 43]) <= 1
    assert len([r for r in got if not r["text"]]) <= 1
    for r in got:
        assert (r["doc_id"], r["text"], r["score"], r["digest"], r["n"]) in docs


def test_empty_tables(spark, tmp_path):
    got = corpus_pipeline.run(spark, made(spark, tmp_path, []))
    assert got.count() == 0 and got.columns == ["doc_id", "text", "score", "digest", "n", "ids", "lossless"]


def test_own_names_are_refused(spark, tmp_path):
    folder = made(spark, tmp_path, [(1, "a", "b", "c", 1)], "doc_id bigint, text string, ids string, digest string, n int")
    with pytest.raises(ValueError):
        corpus_pipeline.run(spark, folder)


def test_run_is_the_registered_query(spark, sf):
    from ledgerlake.llm.queries import QUERIES

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_dedup", "decontamination", "sentencepiece"]
    assert QUERIES["pipeline"](spark, sf).count() > 0


def test_entry_point_without_this_subpackage():
    hide = (
        "import sys, importlib.abc\n"
        "class Hide(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('ledgerlake.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Hide())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 150 and not any(k.startswith('op1_') or k == 'pipeline' for k in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", hide], cwd=ROOT, check=True)
