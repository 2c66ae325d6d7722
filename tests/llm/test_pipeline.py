"""The corpus pipeline on a small corpus with one case for each stage."""

import random

import corpus_pipeline


def test_each_stage_decides(spark, tmp_path):
    source = random.Random(8)
    plain = lambda: ". ".join(" ".join(source.choice("river stone bridge winter forest letter garden candle market window".split()) for _ in range(12)) for _ in range(9))
    clean = {i: plain() for i in range(300)}
    toxic = {i: plain() + " slurrat. " + plain() for i in range(300, 420)}
    passage = plain()
    special = {500: clean[5], 501: "too few words", 502: plain() + " " + passage, 503: None, 504: ""}
    rows = [(i, t, "en", "s", 1) for i, t in {**clean, **toxic, **special}.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i >= 300)) for i in (*clean, *toxic)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()}
    assert not kept & {*toxic, *special}
    assert len(kept & set(clean)) >= 295
