"""The pipeline's stages against brute-force versions of their decisions."""

import re

import corpus_pipeline
import sentencepiece
from pyspark.sql import functions as F
from test_decontam import brute as leaks
from test_pii import brute as spans
from test_simhash import brute_groups
from tidemark.llm import pieces

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert kept.columns == cols
    one = {r.doc_id: r.text for r in kept.collect()}
    assert len(one) >= 0.97 * len(texts) and all(texts[d] == t for d, t in one.items())
    deduped = corpus_pipeline.STAGES[1][1](spark, kept, SF)
    assert deduped.columns == cols
    two = {r.doc_id: r.text for r in deduped.collect()}
    assert set(two) == {d for d, _, low in brute_groups(list(one.items())) if d == low} and all(one[d] == t for d, t in two.items())
    clean = corpus_pipeline.STAGES[2][1](spark, deduped, SF)
    assert clean.columns == cols
    three = {r.doc_id: r.text for r in clean.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(three) == set(two) - {d for d, _ in leaks(list(two.items()), items)}
    red = corpus_pipeline.STAGES[3][1](spark, clean, SF)
    assert red.columns == cols and red.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    four = {r.doc_id: r for r in red.collect()}
    assert set(four) == set(three)
    for d, t in three.items():
        found = [x.split(":") for x in spans(t)]
        assert all(t[int(a):int(b)] not in four[d].text for _, a, b in found)
        assert four[d].n_chars == len(four[d].text)
        if not found and not re.search("[0-9]", t):
            assert four[d].text == t
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    for r in corpus_pipeline.STAGES[4][1](spark, red, SF).collect():
        assert r.ids == lib.encode(four[r.doc_id].text) and r.round_trip


def test_run_and_empty_and_clashing(spark):
    whole = corpus_pipeline.run(spark, SF)
    assert whole.count() > 100 and whole.where("not round_trip").count() == 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    odd = docs.withColumns({"row": F.lit(1), "fp": F.lit("a"), "_text": F.lit(None).cast("string"), "kept": F.lit(3), "ids": F.lit(2.0)})
    odd = odd.union(odd.limit(3)).withColumn("lang", F.when(F.col("doc_id") % 7 != 0, F.col("lang")))
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, odd, SF)
        assert step(spark, odd.limit(0), SF).count() == 0, name
        assert out.count() > 0
        if name != "sentencepiece":
            assert out.columns == odd.columns, name
