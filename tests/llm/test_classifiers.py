"""Operators 4 and 6: held-out accuracy, calibration, odd tables."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from statlake.llm.common import least
from statlake.llm.language_id import fit_temperature, identify_languages, language_report, softmax, train_language_model
from statlake.llm.quality import Logistic, co_train, good_documents, score_quality, train_quality, views

from ..conftest import SF_CHECK
from .conftest import odd_rows


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = language_report(docs).collect()
    assert {r.doc_id for r in got if r.held_out} == {d for d in lang if zlib.crc32(str(d).encode()) % 4 == 2}
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_language_learns_nothing_from_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").limit(300).cache()
    lied = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 'xx' ELSE lang END AS lang")
    assert sorted(map(tuple, language_report(docs).collect())) == sorted(map(tuple, language_report(lied).collect()))


def test_language_odd_rows(spark, odd, empty):
    model = train_language_model(odd)
    got = identify_languages(odd, model).collect()
    assert len(got) == 11
    for r, (_, text, *_) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id)), sorted(odd_rows(), key=lambda r: (r[0] is None, r[0]))):
        letters = any(c.isalpha() for c in text or "")
        assert (r.lang_pred == "und") == (not letters) and (r.score > 0) == letters
    assert identify_languages(empty, model).count() == 0
    nothing = train_language_model(empty)
    assert {(r.lang_pred, r.score) for r in identify_languages(odd, nothing).collect()} == {("und", 0.0)}
    assert language_report(empty).count() == 0


def test_temperature_finds_the_scale():
    rng = np.random.default_rng(0)
    logits = rng.normal(size=(4000, 3)) * 2
    y = np.array([rng.choice(3, p=softmax(v)) for v in logits])
    assert 0.9 < fit_temperature(logits, y) < 1.1
    assert 2.7 < fit_temperature(3 * logits, y) < 3.3


def test_quality_keeps_clean_and_rejects_junk(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    # learn from half of the labels, judge by the others
    model = train_quality(docs, labels.filter("doc_id % 2 = 0"))
    got = {r.doc_id: r for r in score_quality(docs, model).collect()}
    held = [r for r in labels.collect() if r.doc_id % 2]
    assert np.mean([got[r.doc_id].kept for r in held if r.quality == 1]) >= 0.99
    assert np.mean([got[r.doc_id].kept for r in held if r.quality == 0]) <= 0.02
    kept = good_documents(docs, model)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {d for d, r in got.items() if r.kept}


def test_quality_odd_rows(spark, odd, empty):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    model = train_quality(docs, labels)
    rows = score_quality(odd, model).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 for r in rows)
    assert good_documents(odd, model).columns == odd.columns
    assert score_quality(empty, model).count() == 0 and good_documents(empty, model).count() == 0
    # no label, or labels of one class only: nothing is learned and nothing rejected
    for some in (labels.limit(0), labels.filter("quality = 1")):
        none = train_quality(docs, some)
        assert none is None and good_documents(odd, none).count() == 11
    assert train_quality(empty, labels) is None


@pytest.mark.parametrize("n_bad", [1, 3, 40])
def test_a_rare_class_is_learned(spark, n_bad):
    """A handful of bad labels among many more good ones than the bound admits."""
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    quality = {r.doc_id: r.quality for r in labels.collect()}
    bad = sorted(d for d, q in quality.items() if q == 0)[:n_bad]
    some = labels.filter(F.col("quality") == 1).unionByName(labels.filter(F.col("doc_id").isin(bad)))
    model = train_quality(docs, some, max_labelled=400, max_pool=800)
    got = sorted(score_quality(docs, model).select("doc_id", "kept", "score").collect())
    assert model is not None and not any(r.kept for r in got if r.doc_id in bad)
    assert np.mean([r.kept for r in got if quality.get(r.doc_id) == 1]) >= 0.95
    again = train_quality(docs.repartition(7), some.repartition(3), max_labelled=400, max_pool=800)
    assert sorted(score_quality(docs, again).select("doc_id", "kept", "score").collect()) == got


def test_labels_of_ids_without_documents_take_no_places(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    labels = labels.select("doc_id", "quality")
    strangers = spark.range(10**9, 10**9 + 20_000).select(F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("quality"))
    one, other = train_quality(docs, labels, max_labelled=600), train_quality(docs, labels.unionByName(strangers), max_labelled=600)
    assert np.array_equal(one.both.w, other.both.w)


@pytest.mark.parametrize("total", [10, 10**6, 5 * 10**10, 10**16])
def test_the_least_hashes_are_admitted_at_any_total(spark, total):
    n = 4000
    edge = min(1.0, (2 * n + 40) / total) * 2.0**64
    inside, outside = -(2**63) + int(edge * 0.99), -(2**63) + int(edge * 1.01)
    rows = [(-(2**63), True), (inside, True)] + ([(outside, False), (2**63 - 1, False)] if total > 10 * n else [(2**63 - 1, True)])
    df = spark.createDataFrame(rows, "h long, want boolean")
    assert all(r.got == r.want for r in df.select("want", least(F.col("h"), n, total).alias("got")).collect())


def test_a_rare_language_is_learned(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text", "lang").filter("length(text) > 100")
    rare = [r.doc_id for r in docs.filter("lang = 'de'").orderBy("doc_id").limit(6).collect()]
    some = docs.filter((F.col("lang") == "en") | F.col("doc_id").isin(rare))
    model = train_language_model(some, max_rows=40)
    assert model.langs == ["de", "en"]
    again = train_language_model(some.repartition(5), max_rows=40)
    assert np.array_equal(model.weights, again.weights) and model.temperature == again.temperature


def test_views_do_not_depend_on_neighbours():
    rows = [r for r in odd_rows()]
    whole = pa.RecordBatch.from_arrays(
        [pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows]), pa.array([r[3] for r in rows]), pa.array([r[4] for r in rows], pa.int64())],
        ["text", "lang", "source", "n_chars"],
    )
    t, m = views(whole)
    for i in range(len(rows)):
        u, v = views(whole.slice(i, 1))
        assert np.allclose(t[i], u[0]) and np.allclose(m[i], v[0])


def test_views_exchange_labels():
    """One view is weak on its few labels; the other's pseudo-labels mend it."""
    rng = np.random.default_rng(4)
    n, few = 3000, 60
    y = rng.integers(0, 2, n).astype(float)
    strong = np.column_stack([y * 4 + rng.normal(size=n) * 0.5])
    weak = np.column_stack([y[:, None] + rng.normal(size=(n, 1)) * 0.8, rng.normal(size=(n, 30))])
    held = np.zeros(few, bool)
    held[::3] = True
    alone = Logistic.fit(weak[:few][~held], y[:few][~held])
    model = co_train(strong[:few], weak[:few], y[:few], held, strong[few:], weak[few:])
    right = lambda m: np.mean((m.logit(weak[few:]) > 0) == y[few:])
    assert right(model.meta) > right(alone) + 0.05
