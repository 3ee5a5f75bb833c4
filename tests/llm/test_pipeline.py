"""The pipeline's stages, each against what it was given."""

from __future__ import annotations

import sys
from pathlib import Path

import sentencepiece
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from warcaudit.llm import credentials, quality, queries, tiling  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = queries.documents(spark, FOLDER)
    columns = docs.columns
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        rows = after.collect()
        if number < 4:
            assert after.columns == columns
        if name == "quality":
            verdict = quality.classify(docs, quality.fit(docs, queries.table(spark, FOLDER, "labels")), "source", "lang")
            assert {r.doc_id for r in rows} == {r.doc_id for r in verdict.filter("verdict.keep").collect()} and len(rows) < len(before)
        elif name == "near_duplicates":
            want = brute.jaccard_components([(r.doc_id, r.text) for r in before], 5, 80)
            assert {r.doc_id for r in rows} == {i for i, (_, c) in want.items() if c == i}
        elif name == "decontamination":
            bad = {r.doc_id for r in tiling.contaminated(docs, queries.table(spark, FOLDER, "benchmark")).collect()}
            assert {r.doc_id for r in rows} == {r.doc_id for r in before} - bad
        elif name == "secrets":
            texts = {r.doc_id: r.text for r in before}
            assert all(brute.base_spans(r.text) == "" and r.n_chars == len(r.text) for r in rows) and len(rows) == len(before)
            assert all(r.text == texts[r.doc_id] or credentials.MASK in r.text for r in rows)
        else:
            texts = {r.doc_id: r.text for r in before}
            for r in rows:
                assert list(memoryview(r.ids).cast("I")) == [1, *library.encode(texts[r.doc_id]), 2]
        docs = after


def test_a_text_goes_to_one_worker_of_a_task(spark):
    """A filter on a worked-out column made Spark work it out twice, in two Python workers of the same task."""
    docs = queries.documents(spark, FOLDER)
    for number, most in ((0, 1), (1, 2)):
        plan = corpus_pipeline.STAGES[number][1](spark, docs, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
        assert 1 <= plan.count("ArrowEvalPython") <= most


def test_run_takes_odd_tables(spark, tmp_path):
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "token=abcdefghijklmnop", None, "s", 22)],
                                "doc_id long, text string, lang string, source string, n_chars long")
    real = queries.documents(spark, FOLDER)
    real.unionByName(odd).write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        queries.table(spark, FOLDER, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path))
    assert rows.select("decoded_sha256").count() > 100 and rows.filter(F.col("n_tokens") < 2).count() == 0
    folder = tmp_path / "empty"
    for name in ("documents", "labels", "benchmark"):
        queries.table(spark, FOLDER, name).limit(0).write.parquet(str(folder / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(folder)).count() == 0
