import numpy as np
from pyspark.sql import functions as F

from tallyline.llm import quality as module
from tallyline.llm.quality import bag, features, held_out, quality


def test_features_of_a_word_and_of_repeats():
    assert len(list(features(b"ab"))) == 1 + 2 + 1 and list(features(b"ab")) != list(features(b"AB"))
    held, share = bag(b"ab ab ab cd")
    assert held[-1] == module.BUCKETS and np.isclose(share.sum(), 1) and np.isclose(share[-1], 2 / (4 * 4 + 2))
    assert [len(c) for c in bag(b" \n")] == [0, 0]


def test_scores_equal_the_softmax_of_the_mean():
    """The table of additions gives what vectors, mean, layer and softmax would."""
    texts = [b"good words here", b"bad!!! words!!!", b"good good things", b"worse!!! things!!!"] * 20
    adds, constant = module.train([bag(t) for t in texts], np.array([1, 0, 1, 0] * 20))
    known = module._Known(adds)
    for text in texts[:4]:
        held, share = bag(text)
        total = known.text(text)
        assert np.isclose(total.real / total.imag, share @ adds[held], rtol=1e-4, atol=1e-6)
        assert (share @ adds[held] + constant > 0) == (b"!" not in text)


def test_quality_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = quality(docs, labels).select("doc_id", "score", held_out("doc_id").alias("held_out"))
    rows = [(r["score"] >= 0.5, r["quality"] == 1) for r in scored.join(labels, "doc_id").where("held_out").collect()]
    assert sum(p for p, y in rows if y) / sum(y for _, y in rows) > 0.98
    assert sum(not p for p, y in rows if not y) / sum(not y for _, y in rows) > 0.9
    turned = labels.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r["doc_id"]: r["score"] for r in quality(docs, turned).collect()} == {r["doc_id"]: r["score"] for r in scored.collect()}


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 11)] + [(1, 0, 0), (None, 1, 0), (3, None, 0), (4, 7, 0)],
                                   "doc_id long, quality int, id int")
    rows = quality(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (2, 3, 4)}) == 1
    assert all(r["score"] == 0.5 for r in quality(odd_docs, labels.limit(0)).collect())
    assert quality(no_docs, labels).count() == 0


def test_one_label_teaches_no_difference(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    scores = {r["score"] for r in quality(docs, labels).collect()}
    assert len(scores) == 1 and scores.pop() > 0.5
