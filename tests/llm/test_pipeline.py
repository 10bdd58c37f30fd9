from collections import defaultdict

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyline.llm.toxicity import toxicity
from tests.llm.test_dedup import brute_near

SF_DIR = "/root/testdata/sf0.001"


def without_repeats(rows):
    """Texts by id after deleting runs of three lines, or lines of 50 words, that occur earlier."""
    first, gone, lines_of = {}, defaultdict(set), {}
    for key, text in sorted((k, t) for k, t in rows if t is not None):
        lines = lines_of[key] = text.split("\n")
        kept = [n for n, line in enumerate(lines) if line.strip(" \t\r\v\f")]
        units = [(i, 3, tuple(lines[n].strip(" \t\r\v\f") for n in kept[i:i + 3]), kept[i], kept[i + 2]) for i in range(len(kept) - 2)]
        units += [(i, 1, lines[n].strip(" \t\r\v\f"), n, n) for i, n in enumerate(kept) if len(lines[n].split()) >= 50]
        for place, size, unit, a, b in sorted(units):
            at = first.setdefault(unit, (key, place))
            if at[0] != key or place >= at[1] + size:
                gone[key].update(range(a, b + 1))
    return {key: "\n".join(line for n, line in enumerate(lines) if n not in gone[key]) for key, lines in lines_of.items()}


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    scored = toxicity(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    toxic = {r["doc_id"] for r in scored.where("score >= 0.3").collect()}
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    clean = {k: t for k, t in rows.items() if k not in toxic}
    texts = without_repeats(clean.items())
    texts = {k: t for k, t in texts.items() if t.strip() or not clean[k].strip()}
    kept = {k for k, found in brute_near(texts.items()).items() if found[2]}

    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {p["doc_id"] for p in pieces} == kept
    library, found = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), defaultdict(int)
    for p in pieces:
        found[p["doc_id"]] += p["length"]
    assert found == {k: len(library.encode(texts[k], add_special_tokens=False).ids) + 1 for k in kept}


def test_stages_keep_odd_rows_and_columns(spark, odd_docs, tmp_path):
    labels = spark.createDataFrame([(i, 0, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = odd_docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.length("text")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        docs = out
    left = [r["doc_id"] for r in docs.collect()]
    assert sorted(left, key=str) == sorted([1, 2, 3, 4, 5, 7, 8, None, 9], key=str)  # 6 and 10 are copies
    empty = odd_docs.limit(0).withColumns({"n_chars": F.lit(1)})
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, str(tmp_path))
        assert out.count() == 0


def test_stages_send_texts_in_small_batches(spark, odd_docs, tmp_path):
    spark.createDataFrame([(i, 0, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = odd_docs.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text")})
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for _, stage in corpus_pipeline.STAGES:  # each alone, as another caller may take them
            for given, want in (("10000", "1000"), ("0", "1000"), ("7", "7")):
                spark.conf.set(name, given)
                stage(spark, docs, str(tmp_path))
                assert spark.conf.get(name) == want
    finally:
        spark.conf.set(name, before)
