"""The stages over a small table with cases planted in it."""

import random

import corpus_pipeline as pipeline
from folioloom.llm import bpe


def test_stages(spark, tmp_path):
    rng = random.Random(4)
    vocab = ["".join(rng.choices("abcdefghijklmn", k=6)) for _ in range(3000)]
    texts = [" ".join(rng.choices(vocab, k=rng.randint(80, 200))) for _ in range(240)]
    item = " ".join(rng.choices(vocab, k=40))
    toxic = set(range(0, 120))
    for k in toxic:
        w = texts[k].split()
        for at in rng.sample(range(len(w)), 6):
            w[at] = "scoundrel"
        texts[k] = " ".join(w)
    texts[130] = texts[129]
    texts[131] = texts[129] + " end"
    texts[140] += " " + item
    texts[150] += ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" end'
    texts += [None, ""]
    docs = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)] + [(200, texts[200], "en", "s", len(texts[200]))]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k in toxic)) for k in range(240)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        stage(spark, df, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = sorted(r["doc_id"] for r in df.collect())
        if name != "bpe":
            assert df.columns == pipeline.COLUMNS
        if name == "secret_scan":
            assert df.where("doc_id = 150").first()["text"].endswith('token = "[SECRET]" end')
    clean = [k for k in range(242) if k not in toxic]
    assert sorted(set(kept["toxicity"])) == clean
    lost = {130, 131, 241}  # copies, and the empty text beside the null one
    assert kept["simhash_dedup"] == [k for k in clean if k not in lost]
    assert kept["decontamination"] == kept["secret_scan"] == kept["bpe"] == [k for k in clean if k not in lost | {140}]
    assert df.where("NOT decodes").count() == 0
    own = bpe.tokenizer(bpe.default_path())
    assert list(df.where("doc_id = 125").first()["ids"]) == own.encode(texts[125])
    assert [len(r["ids"]) for r in df.where("doc_id = 240").collect()] == [0]
