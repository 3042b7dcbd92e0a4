import regex
from pyspark.sql import functions as F

import corpus_pipeline
from fleetmart.llm import secretscan
from fleetmart.llm.staging import staged

FOLDER = "/root/testdata/sf0.01"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(10 ** 6, None, "en", "s", 0), (10 ** 6 + 1, "12 34 !", "en", "s", 7), (10 ** 6 + 2, "", None, None, None)], docs.schema)
    docs = staged(docs.unionByName(odd))
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    named = dict(corpus_pipeline.STAGES)
    assert list(named) == ["language_id", "toxicity", "jaccard_join", "secret_scan", "packing"]
    one = staged(named["language_id"](spark, docs, FOLDER))
    assert one.schema == docs.schema and one.count() == docs.count() - 3
    two = staged(named["toxicity"](spark, one, FOLDER))
    gone = one.join(two, "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.where("toxic = 0").count() <= 2
    assert two.join(labels, "doc_id").where("toxic = 1").count() <= 0.2 * labels.where("toxic = 1").count()
    three = staged(named["jaccard_join"](spark, two, FOLDER))
    assert three.columns == docs.columns and three.select("text").distinct().count() == three.count()
    first = two.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    assert three.join(first, ["doc_id", "text"], "left_anti").count() == 0
    four = staged(named["secret_scan"](spark, three, FOLDER))
    assert four.columns == docs.columns and four.count() == three.count()
    texts = [r["text"] for r in four.collect()]
    assert not any(regex.search(r'(?i)token = "[0-9a-f]{40}"', t) for t in texts)
    assert any(secretscan.REDACTED in t for t in texts)
    assert four.where(F.length("text") != F.col("n_chars")).count() == three.where(F.length("text") != F.col("n_chars")).count()
    five = named["packing"](spark, four, FOLDER)
    assert five.select("doc_id").distinct().count() == four.count()
    assert five.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_near_duplicates_go_by_text(spark, docs_of):
    def text(k, change=0):
        return " ".join(f"w{k}x{i}" for i in range(60)) + " changed" * change

    rows = [(3, text(1)), (7, text(1, 1)), (7, text(2)), (None, text(3)), (None, text(1)), (None, text(4)), (None, text(4, 1)), (9, text(5)),
            (9, text(5)), (11, text(6)), (11, text(6, 1)), (12, text(6)), (None, text(7)), (None, text(7)), (13, "!!"), (14, "!!"), (None, "??")]
    docs = docs_of(rows)
    got = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert got.schema == docs.schema
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    sure = [(3, text(1)), (7, text(2)), (None, text(3)), (9, text(5)), (None, text(7)), (13, "!!"), (14, "!!"), (None, "??")]
    open_pairs = [{(None, text(4)), (None, text(4, 1))}, {(11, text(6)), (11, text(6, 1))}]
    assert all(kept.count(x) == 1 for x in sure) and len(kept) == len(sure) + len(open_pairs)
    assert all(len(pair & set(kept)) == 1 for pair in open_pairs)


def test_stages_take_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        got = staged(stage(spark, docs, FOLDER))
        assert got.count() == 0, name
        docs = got if "text" in got.columns else docs
