"""Language, toxicity and quality: held-out accuracy on the synthetic documents, and the edges of a table."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cadastra.llm import langid, quality, sample, toxicity
from cadastra.llm.zdict import Dictionaries

LARGER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score string"


@pytest.mark.skipif(not Path(LARGER).exists(), reason="needs the synthetic tables")
def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang"), spark.read.parquet(f"{LARGER}/labels.parquet")
    lang = langid.op4(spark, LARGER).where("held_out").join(docs, "doc_id")
    assert lang.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.93
    good = quality.op10(spark, LARGER).where("held_out").join(labels, "doc_id")
    assert good.agg(F.avg((F.col("quality") == F.col("predicted")).cast("double"))).first()[0] > 0.9
    toxic = toxicity.op6(spark, LARGER).where("held_out").join(labels, "doc_id")
    assert toxic.agg(F.avg((F.col("toxic") == F.col("predicted")).cast("double"))).first()[0] > 0.9
    assert toxic.where("toxic = 0").agg(F.avg("predicted")).first()[0] < 0.03


def _docs(spark):
    rows = [(i, ("der die das und nicht " if i % 2 else "the and of that with ") * (5 + i % 7), "de" if i % 2 else "en", "x") for i in range(60)]
    return spark.createDataFrame([*rows, (100, None, "en", None), (101, "", None, None), (102, "1234 !!", "de", None), (None, "the and", "en", None), (0, rows[0][1], "en", "x"), (103, "the of " * 50_000, None, None)], SCHEMA)


def test_language_edges(spark):
    docs = _docs(spark)
    rows = langid.predict(docs, langid.fit(docs), [F.col("doc_id")]).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == docs.count() and by[100].lang_pred == by[101].lang_pred == by[102].lang_pred == "und"
    assert by[0].lang_pred == "en" and by[1].lang_pred == "de" and by[103].lang_pred == "en" and all(0 <= r.score <= 1 for r in rows)
    none = docs.where("false")
    assert langid.predict(docs, langid.fit(none), [F.col("doc_id")]).where("lang_pred <> 'und'").count() == 0
    assert langid.predict(none, langid.fit(docs), [F.col("doc_id")]).count() == 0


@pytest.mark.parametrize(("module", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_label_edges(spark, module, label):
    docs = _docs(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(0, 0), (None, 1), (5, None), (999, 1), (7, 3)], f"doc_id long, {label} int")
    rows = module.score(docs, module.fit(docs, labels), [F.col("doc_id")]).collect()
    by = {r.doc_id: r.score for r in rows}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows) and by[1] > by[2]
    for part in (labels.where("false"), labels.where(f"{label} = 1")):
        assert module.score(docs, module.fit(docs, part), [F.col("doc_id")]).where("score between 0 and 1").count() == docs.count()
    assert module.score(docs.where("false"), module.fit(docs, labels), [F.col("doc_id")]).count() == 0


def test_any_number_of_languages(spark):
    rows = [(i, f"word{i % 400} and sign{i % 400} " * 9, f"l{i % 400}", None) for i in range(800)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = langid.fit(docs)
    assert len(model.dictionaries.labels) == 400
    assert langid.predict(docs.limit(20), model, [F.col("doc_id")]).where("score between 0 and 1").count() == 20
    assert sample.bounds(2, 512, 4096) == (512, 4096) and sample.bounds(1 << 20, 512, 4096) == (1, 64) and sample.bounds(0, 5, 6) == (5, 6)


def test_ties_go_to_the_first_language():
    model = langid.LanguageModel({"b": ["same text here"] * 3, "a": ["same text here"] * 3})
    assert model.predict("same text here")[0] == "a" and model.predict("same text here")[3]


def test_dictionaries_take_pieces_from_all_over_the_texts():
    texts = ["".join(f"<{i}:{k}>" for k in range(400)) for i in range(100)]
    raw = Dictionaries.content(texts, 20_000).decode()
    assert len(raw) <= 20_000 and sum(f"<{i}:" in raw for i in range(100)) > 90
    assert sum(f":{k}>" in raw for k in range(200, 400)) > 100
    assert Dictionaries.content(["x" * 500] * 50, 10_000) == b"x" * 200


def test_toxic_share_of_uneven_labels():
    """Where labels exceed the sample, scores are those of the corpus's share, not of the even sample."""
    clean, toxic = [f"fine words number {i}" for i in range(40)], [f"bad words number {i}" for i in range(40)]
    even, rare = toxicity.ToxicityModel(clean, toxic, 40, 40), toxicity.ToxicityModel(clean, toxic, 40_000, 40)
    assert rare.bias < even.bias - 6 and rare.score("words number 7") < even.score("words number 7")
