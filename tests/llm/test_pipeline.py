"""The pipeline over a small table, stage by stage, against brute force."""

from __future__ import annotations

import numpy as np
import sentencepiece

import corpus_pipeline
from blotter.llm import latent_leaks, quality_gbt, secrets_markov
from blotter.llm.token_counts import tokenizer_path


def _tables(spark, folder):
    rng = np.random.default_rng(6)
    vocabulary = ["".join(rng.choice(list("abcdefghijklm"), rng.integers(2, 8))) for _ in range(2000)]
    prose = lambda n: " ".join(rng.choice(vocabulary, n))
    docs = [(i, prose(120), "en", "s", 1) for i in range(60)]
    docs += [(100 + i, docs[i][1], "en", "s", 1) for i in range(5)]  # copies
    docs += [(200 + i, docs[i][1].replace(" ", "  ", 3), "en", "s", 1) for i in range(5, 10)]  # near copies
    item = prose(30)
    docs += [(300, prose(50) + " " + item + " " + prose(50), "en", "s", 1), (301, "short", "en", "s", 1), (302, None, None, None, None), (303, "", "", "", 0)]
    docs += [(304, prose(80) + ' password = "Xk29vLq8Zt41" ' + prose(20), "en", "s", 1)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs, item


def test_run(spark, tmp_path):
    docs, item = _tables(spark, tmp_path)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    # with one kind of label the trees reject nothing: the base rule, copies and the leak decide
    expected = set(range(60)) | {304}
    assert set(got) == expected
    for i, text, *_ in docs:
        if i in expected and i != 304:
            assert got[i].text == text and got[i].ids == library.encode(text)
    assert "Xk29vLq8Zt41" not in got[304].text and got[304].ids == library.encode(got[304].text)
    assert got[304].n_chars == len(got[304].text)


def test_stages_on_an_empty_table_keep_their_columns(spark, tmp_path):
    _tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == (columns if name != "token_ids" else [*columns, "ids"])
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.count() == 0
