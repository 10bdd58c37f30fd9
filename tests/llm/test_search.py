import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import difference, duck
from tallyline.llm import bloom
from tallyline.llm import toxicity as toxicity_module
from tallyline.llm.queries import oracle_sql, queries
from tallyline.llm.topk_search import bounded_scores, top_k
from tallyline.llm.toxicity import BlockMaxIndex, Examples, held_out, isotonic, toxicity
from tallyline.llm.url_filter import judge_urls

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name, monkeypatch):
    import __spark_entry__

    monkeypatch.setattr("checks.compare.queries", __spark_entry__.queries)
    monkeypatch.setattr("checks.compare.oracle_sql", __spark_entry__.oracle_sql)
    assert difference(spark, SF_DIR, name, duck(SF_DIR)) is None


def test_bloom_holds_every_key(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("hash"))
    table = bloom.build(keys)
    held = np.array([r[0] for r in keys.collect()])
    others = np.array([r[0] for r in spark.range(10_000, 40_000).select(F.xxhash64("id")).collect()])
    assert bloom.may_hold(table, held).all() and bloom.may_hold(table, others).mean() < 0.02
    assert not bloom.may_hold(bloom.build(keys.limit(0)), others).any()


def test_urls(spark):
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), (None, "/", "block"), ("b.c", "", "block")],
                                  "host string, path string, verdict string")
    urls = ["http://EXAMPLE.net/en/1?x#y", "https://example.net/EN/1", "http://notexample.net/en/", "http://net", "http://net/", "net/",
            None, "", "://", "x://a.b.c", "http://user@b.c", "http://a.b.c?u://z.net/", "http://example.net\n/en/", "http://é.net/é",
            "http://" + "a." * 300 + "net/x"]
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)] + [(None, urls[0], "own")], "page_id int, url string, rule string")
    rows = judge_urls(pages, rules).collect()
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in rows}
    block, allow = ("net/", "block"), (None, "allow")
    assert [found[i] for i in range(len(urls))] == [
        ("example.net/en/", "allow"), block, block, allow, block, allow, allow, allow, allow, ("b.c", "block"), allow,
        ("b.c", "block"), allow, block, block]
    assert found[None] == ("example.net/en/", "allow") and len(rows) == len(urls) + 1
    odd = pages.selectExpr("*", "1 AS _best", "2 AS _h", "3 AS _p", "4 AS _key", "5 AS _pass", "6 AS _verdict")
    names = ["_best", "_h", "_p", "_key", "_pass", "_verdict"]
    assert {tuple(r[n] for n in names) for r in judge_urls(odd, rules).collect()} == {(1, 2, 3, 4, 5, 6)}
    assert judge_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_bounded_scores_equal_brute_force():
    rnd = np.random.default_rng(1)
    block, queries_ = rnd.integers(-20, 20, (700, 12)).astype(float), rnd.integers(-20, 20, (40, 12)).astype(float)
    own = np.array([5, *[-1] * 39])
    for floors in (np.full(40, -np.inf), np.full(40, 900.0)):
        for q, (hit, scores) in enumerate(bounded_scores(block, queries_, floors, 7, own)):
            exact = block @ queries_[q]
            assert (exact[hit] == scores).all() and own[q] not in hit
            best = [i for i in np.lexsort((np.arange(700), -exact)) if i != own[q]][:7]
            assert {i for i in best if exact[i] >= floors[q]} <= set(hit)


def test_top_k(spark):
    rnd = np.random.default_rng(4)
    values = rnd.standard_normal((9000, 8)).round(1)  # ties, and more than two blocks
    rows = [(i, v.tolist()) for i, v in enumerate(values)]
    odd = [(9000, None), (9001, [float("inf")] * 8), (9002, [None] * 8), (None, [1.0] * 8), (9003, [1.0]), (9003, [1.0]), (9100, [])]
    docs = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("score", F.lit("own"))
    found = {}
    for r in top_k(docs, F.col("id") % 100 == 0, k=5).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    whole = np.floor(64 * values)
    for q in range(0, 9000, 100):
        scores = whole @ whole[q]
        best = [i for i in np.lexsort((np.arange(9000), -scores)) if i != q][:5]
        assert found[q] == {n: (i, int(scores[i])) for n, i in enumerate(best, 1)}
    assert set(found) == set(range(0, 9000, 100))
    assert top_k(docs.limit(0), F.col("id") % 100 == 0).count() == 0


def test_block_max_index_is_exact():
    rnd, vectors = np.random.default_rng(0), []
    for _ in range(1000):
        terms = np.sort(rnd.choice(40, rnd.integers(1, 6), replace=False))
        w = rnd.random(len(terms))
        vectors.append((terms, w / np.linalg.norm(w)))
    dense = np.zeros((1000, 40))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    index = BlockMaxIndex(vectors, 40)
    for terms, weights in vectors[:50]:
        exact = np.round(dense[:, terms] @ weights, 12)
        entries, cosines = index.nearest(terms, weights, 10)
        assert entries.tolist() == np.lexsort((np.arange(1000), -exact))[:10].tolist()
        assert np.allclose(cosines, exact[entries])
    assert BlockMaxIndex([], 3).nearest(np.array([1]), np.array([1.0]), 5)[0].tolist() == []


def test_isotonic_rises():
    x, y = isotonic(np.array([0.1, 0.2, 0.3, 0.9]), np.array([0.0, 1.0, 0.0, 1.0]), np.ones(4))
    assert (np.diff(y) > 0).all() and y[0] == 0 and y[-1] == 1 and np.isclose(y[1], 0.5)


def test_toxicity_on_held_out_rows(spark):
    """Held-out accuracy on the given data, and labels of held-out rows change nothing."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity(docs, labels).select("doc_id", "score", held_out("doc_id").alias("held_out"))
    rows = scored.join(labels, "doc_id").collect()
    right = [(r["score"] >= 0.3) == (r["toxic"] == 1) for r in rows if r["held_out"]]
    assert all(0 <= r["score"] <= 1 for r in rows) and sum(right) / len(right) > 0.9
    turned = labels.withColumn("toxic", F.when(held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r["doc_id"]: r["score"] for r in toxicity(docs, turned).collect()} == {r["doc_id"]: r["score"] for r in scored.collect()}


@pytest.mark.parametrize("labelled", [24, 400])
def test_few_or_many_separable_texts_are_told_apart(spark, labelled):
    rnd = np.random.default_rng(labelled)
    docs = [(i, f"{('kind sweet words', 'vile nasty words')[i % 2]} {' '.join(f'u{n}' for n in rnd.integers(0, 10**6, 12))}") for i in range(600)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(labelled)], "doc_id long, toxic int")
    scored = toxicity(spark.createDataFrame(docs, "doc_id long, text string"), labels).collect()
    assert all((r["score"] >= 0.3) == (r["doc_id"] % 2 == 1) for r in scored)


def test_frequencies_are_one_row_per_term_and_task(spark):
    rows = spark.createDataFrame([([0, 2],), ([2],), ([],)] * 40, "terms array<int>").repartition(3)
    counted = rows.mapInArrow(toxicity_module._frequencies(4), "term int, n long")
    assert counted.count() <= 6 and {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()} == {0: 40, 2: 80}


def test_toxicity_keeps_examples_with_a_common_passage(spark):
    """Texts that share most of their words, but less than 3/4 of their shingles, are examples of their own."""
    rnd, passage = np.random.default_rng(1), " ".join(f"p{n}" for n in range(60))
    docs, labels = [], []
    for i in range(400):
        own = [f"u{n}" for n in rnd.integers(0, 10**6, 24)]
        own[5] = own[15] = "vile" if i % 4 < 2 else "kind"
        docs.append((i, f"{passage} {' '.join(own)}"))
        labels.append((i, int(i % 4 < 2)))
    scored = toxicity(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert all((r["score"] >= 0.5) == (r["doc_id"] % 4 < 2) for r in scored.collect())


def test_near_copies_keep_their_number_and_labels(spark):
    words = [f"w{n}" for n in range(100)]
    texts = {5: words, 3: ["x"] + words[1:], 8: words[:99] + ["y"], 9: words, 20: words[:50] + [f"z{n}" for n in range(50)]}
    rows = [(k, 0, " ".join(t)) for k, t in texts.items()]
    sketched = spark.createDataFrame(rows, "id long, toxic int, text string").mapInArrow(toxicity_module._sketched, "id long, toxic int, text string, items array<long>, minima array<long>")
    joined = toxicity_module.near_copies(sketched)
    assert joined == {5: 3, 8: 3, 9: 3}
    model = Examples([(3, 0, [0], [1]), (5, 1, [0, 1], [1, 1]), (8, 1, [1], [2]), (9, 0, [], []), (20, 1, [1], [1])],
                     np.ones(2), 9, joined)
    assert dict(zip(model.keys, zip(model.n, model.toxic))) == {3: (4, 2), 20: (1, 1)} and model.prior == 0.6


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 11)] + [(1, 0, 0), (None, 1, 0), (3, None, 0), (4, 7, 0)],
                                   "doc_id long, toxic int, id int")
    rows = toxicity(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] == 0 for r in toxicity(odd_docs, labels.limit(0)).collect())
    assert toxicity(no_docs, labels).count() == 0
