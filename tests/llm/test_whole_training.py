"""The quality model counts every trusted document that trains, however many a language has."""

from pyspark.sql import functions as F

from shelfprice.llm import quality


def test_every_trusted_document_is_used(spark, monkeypatch):
    n = 24_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.concat(F.lit("item "), F.col("id") % 97).alias("text"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    counted, plain = [], quality.kneser_ney
    monkeypatch.setattr(quality, "kneser_ney", lambda top: counted.append(int(top.sum())) or plain(top))
    quality.fit(spark, docs, labels)
    training = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(4)) != 0)
    assert counted == [training.agg(F.sum(F.octet_length("text"))).first()[0]] * 2      # of the language, of all


def test_counts_are_passed_on_before_they_overflow(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(quality, "MAX_COUNTED", 100)
    b = pd.DataFrame({"lang": ["en", "de"] * 30, "text": ["some words"] * 60})
    whole = pd.concat(quality.count_grams(iter([b] * 3)))
    assert whole["n"].sum() == 3 * 60 * 10 and str(whole["n"].dtype) == "int64"
    assert whole.groupby("lang")["n"].sum().to_dict() == {"en": 900, "de": 900}


def test_thresholds_are_read_off_one_python_function(spark, monkeypatch):
    """Two in a row hold two Python workers a task; the thresholds are those of the texts scored one by one."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 300, "en").otherwise("de").alias("lang"),
                                   F.concat(F.lit("item "), F.col("id") * 7919, F.lit(" of "), F.col("id") % 13).alias("text"))
    labels = spark.range(400).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    plans, plain = [], type(docs).toPandas
    monkeypatch.setattr(type(docs), "toPandas", lambda df: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or plain(df))
    model = quality.fit(spark, docs, labels, quantile=1)
    assert [p.count("ArrowEvalPython") for p in plans if "ArrowEvalPython" in p] == [1]
    held = plain(docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(4)) == 0))
    for key, own in (("en", held[held["lang"] == "en"]), ("de", held[held["lang"] == "de"]), (quality.POOLED, held)):
        assert model.thresholds[key] == max(model.perplexities(own["text"].reset_index(drop=True), [key] * len(own)))
