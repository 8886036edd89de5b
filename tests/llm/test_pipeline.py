"""The pipeline's stages against what their operators say row by row."""

import corpus_pipeline
from pyspark.sql import functions as F
from test_darts import brute_classes

from tallyrow.llm import clauses, mixing, subwords
from tallyrow.llm.queries import fold


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_every_stage_works_on_what_its_predecessor_kept(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "toxicity", "near_duplicates", "mix", "pack"]
    rows = {}
    for name, stage in stages.items():
        rows[name] = docs
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), name)
        if name != "pack":
            assert docs.columns == rows["quality"].columns
    table = rows["quality"]
    model = subwords.fit(table, labels, "quality", fold(3) != 1)
    assert ids(rows["toxicity"]) == ids(subwords.score(table, model, "p").where("p >= 0.5"))
    weights = clauses.fit(rows["toxicity"], labels, "toxic", fold(5) != 0)
    assert ids(rows["near_duplicates"]) == ids(clauses.score(rows["toxicity"], weights, "p").where("p < 0.5"))
    texts = [tuple(r) for r in rows["near_duplicates"].select("doc_id", "text").collect()]
    assert ids(rows["mix"]) == sorted(set(brute_classes(texts).values()))
    total = lambda df: df.select(F.sum(mixing.n_tokens())).first()[0]
    assert set(ids(rows["pack"])) <= set(ids(rows["mix"])) and abs(total(rows["pack"]) / total(rows["mix"]) - 1) < 0.5
    assert ids(docs) == ids(rows["pack"])
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, docs.collect()))


def test_odd_rows_and_empty_tables_pass(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, bucket int, copies string"
    rows = [(1, None, None, None, None, 1, "x"), (2, "", "en", "src1", 0, 1, "x"), (3, "a b c", "en", "srcx", 5, 1, "x"), (3, "a b c", "en", "srcx", 5, 1, "x"), (None, "long " * 9999, None, "src0", 1, 1, "x")]
    for n in (0, len(rows)):
        path = f"{tmp_path}/{n}"
        spark.createDataFrame(rows[:n], schema).write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        got = corpus_pipeline.run(spark, path).collect()
        assert len(got) == 0 if n == 0 else len(got) >= 1
