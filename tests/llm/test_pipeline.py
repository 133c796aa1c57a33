"""The pipeline against its stages' plain meaning on a small corpus."""

import random

from tests.llm import data


def corpus(spark, path):
    rnd = random.Random(21)
    texts = ["\n".join(data.prose(rnd, 40) for _ in range(3)) for _ in range(60)]
    leak = " ".join(f"exam{i}" for i in range(30))
    texts[5] += " " + leak
    texts[10] = texts[9]
    rows = [(i, t + (" vilest wretch scoundrel" if i % 6 == 1 else ""), "en", "s", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 1)) for i in range(60)], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return rows


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    rows = corpus(spark, str(tmp_path))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    clean = {d for d, *_ in rows if d % 6 != 1} - {5}
    # the copy keeps no line, so its text is empty and no other document is
    assert set(got) == clean and got[10].n_tokens == 0
    assert all(len(r.ids) == r.n_tokens for r in got.values())


def test_stages_return_the_columns_of_documents(spark, tmp_path):
    import corpus_pipeline
    corpus(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
