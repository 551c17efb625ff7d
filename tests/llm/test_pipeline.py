"""The pipeline stage by stage on a small corpus with one case for each stage."""

import random

import corpus_pipeline

VOCAB = ["".join(random.Random(k).choice("abcdefgh") for _ in range(2 + k % 6)) for k in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) for _ in range(n))


def test_stages(spark, tmp_path):
    item = prose(30, 1)
    base = prose(200, 2).split()
    copy = list(base)
    copy[7] = "changed"
    docs = [(1, " ".join(base)), (2, " ".join(copy)), (3, " ".join(base).upper()), (4, prose(60, 3) + " " + item), (5, "short text"), (6, prose(80, 4) + " token = abcdefabcdefabcd1234"), (7, prose(90, 5)), (7, prose(90, 5)), (8, None)]
    spark.createDataFrame([(i, t, "en", f"src{i % 2}", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, str(tmp_path))
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        df.write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = sorted(r.doc_id for r in df.collect())
    assert seen == {"quality": [1, 2, 3, 4, 6, 7, 7], "duplicates": [1, 4, 6, 7], "benchmark": [1, 6, 7], "secrets": [1, 6, 7]}
    text = {r.doc_id: r.text for r in df.collect()}
    assert text[6].endswith(" [SECRET]") and text[1] == " ".join(base)
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted({r.doc_id for r in packed.collect()}) == [1, 6, 7]
