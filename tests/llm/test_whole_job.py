"""Cases that the training-data operators once left out."""

import numpy as np
from pyspark.sql import functions as F

from tabula.llm import common, toxicity


# toxicity

def test_toxic_documents_are_found_in_every_language(spark):
    docs, labels = common.tables(spark, "/root/testdata/sf0.1", "documents", "labels")
    model = toxicity.fit(docs, labels.filter("doc_id % 3 != 0"))
    out = toxicity.predict(docs, model).withColumnRenamed("toxic", "flag").join(labels.filter("doc_id % 3 = 0"), "doc_id")
    out = out.join(docs.select("doc_id", "lang"), "doc_id").filter("toxic = 1").groupBy("lang").agg(F.avg(F.col("flag").cast("int")).alias("recall"))
    recall = {r.lang: r.recall for r in out.collect()}
    assert set(recall) == {"de", "en", "es", "fr"} and min(recall.values()) > 0.6, recall


def test_stems_inside_varying_words_are_features():
    words = ["xa", "yo", "zu", "ke"]
    clean = [toxicity.features(" ".join(f"{a}lorem{b}" for a in words for b in words[:1 + i % 4])) for i in range(80)]
    toxic = [toxicity.features(" ".join(f"{a}réeux{a}{i}" for a in words)) for i in range(40)]
    idx, cnt = zip(*clean, *toxic)
    label = np.repeat([0, 1], [80, 40])
    grade = toxicity.grade_rows(idx, cnt, label)
    assert (grade[80:] >= 2).all() and (grade[:80] == 0).all()
    model = toxicity.fit_ordinal(list(idx), grade, cnt=list(cnt))
    i, c = toxicity.features("neréeuxbi taréeuxso poréeuxmi")
    j, d = toxicity.features("neloremso taloremge poloremmi")
    score = [(model.weights[b] * toxicity.values(b, n)).sum() for b, n in ((i, c), (j, d))]
    flag = model.above(np.array(score))[:, 0] >= 0.5
    assert flag.tolist() == [True, False]


# samples

def test_samples_are_never_empty_and_hold_a_repeated_row_once(spark):
    for n in (10 ** 6, 10 ** 9, 10 ** 12, 10 ** 15):
        assert abs((common.hash_bound(400, n) + (1 << 63)) / (1 << 64) * n - 400) < 1
    unique = spark.range(20_000).select(F.concat(F.lit("text "), "id").alias("text"))
    many = unique.unionByName(spark.range(10_000).select(F.lit("the same").alias("text")))
    many = many.unionByName(spark.range(5_000).select(F.lit(None).cast("string").alias("text")))
    for seed in range(3):
        got = [r.text for r in common.hash_sample(many, 400, seed).collect()]
        assert 400 <= len(got) == len(set(got)) < 700
    assert common.hash_sample(many, 30_000).count() == 20_002
    assert common.hash_sample(many, 1).count() >= 1
