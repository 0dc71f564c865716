"""Quality rules and language filters by held-out accuracy."""

from __future__ import annotations

import zlib

import numpy as np

from parcelflow.llm import language, quality
from parcelflow.llm.common import table
from parcelflow.llm.rules import fit

LARGER = "/root/testdata/sf0.01"


def test_quality_of_held_out_rows(spark):
    docs, labels = table(spark, LARGER, "documents"), table(spark, LARGER, "labels")
    model = quality.learn(docs, labels)
    rows = {r.doc_id: r for r in quality.scored(docs, model).collect()}
    assert len(rows) == docs.count()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(rows[x.doc_id].predicted, x.quality) for x in labels.collect() if rows[x.doc_id].held_out]
    assert np.mean([p == q for p, q in held]) >= 0.95
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in rows.values())


def test_compiled_rules_score_as_the_model(spark):
    rng = np.random.default_rng(1)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.4) & (x[:, 2] < 0.7)).astype(float)
    model = fit(x, y, ("f0", "f1", "f2"))
    assert 0 < len(model.rules) < 200
    assert ((model.score(x) > 0.5) == y).mean() > 0.97
    df = spark.createDataFrame(x.tolist(), "f0 double, f1 double, f2 double")
    got = [r[0] for r in df.select(model.column()).collect()]
    assert np.allclose(got, model.score(x))


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    model = quality.learn(odd_docs, none)
    rows = quality.scored(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(r.score == 0.5 for r in rows)
    assert quality.scored(no_docs, model).count() == 0


def test_columns_named_like_statistics_pass_the_filter(spark):
    docs = table(spark, LARGER, "documents")
    model = quality.learn(docs, table(spark, LARGER, "labels"))
    odd = docs
    for name in ("upper", "digits", "spaces", "commas", "marks", "k0", "log_chars"):
        odd = odd.withColumn(name, docs["source"])
    kept = quality.accepted(odd, model)
    assert kept.columns == odd.columns and kept.where("upper = source AND k0 = source").count() == quality.accepted(docs, model).count()


def test_no_text_is_shuffled_for_the_fit(spark, sf_dir, monkeypatch):
    from parcelflow.llm import text_stats

    seen = []
    monkeypatch.setattr(quality, "with_statistics", lambda df, keys: seen.append(df) or text_stats.with_statistics(df, keys))
    quality.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_language_of_held_out_rows(spark):
    docs = table(spark, LARGER, "documents")
    rows = language.predicted(docs, language.learn(docs)).collect()
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]) >= 0.95


def test_filter_returns_all_languages_of_a_gram():
    keys, _, _ = language.grams(["abc def"])
    model = language.LanguageFilter.build(("x", "y"), np.r_[keys, keys[:2]], np.r_[np.full(len(keys), 1), [2, 2]].astype(np.uint64))
    assert model.shares(["abc def", "zzz"]).round(3).tolist()[0] == [1.0, round(2 / len(keys), 3)]


def test_language_of_odd_rows(odd_docs, no_docs):
    model = language.learn(odd_docs)
    rows = {(r.doc_id): r for r in language.predicted(odd_docs, model).collect() if r.doc_id is not None}
    assert all(rows[i].lang_pred == "und" for i in (2, 3, 4, 6))
    assert rows[8].lang_pred in {"en", "de", "fr", "es"}
    assert language.predicted(odd_docs, model).count() == odd_docs.count()
    assert language.predicted(no_docs, language.learn(no_docs)).count() == 0


def test_rows_that_share_a_labelled_id_stay_within_the_bound(spark, monkeypatch):
    ids = [i for i in range(1, 60) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, f"text {i}") for i in ids] + [(ids[0], f"other text {k}") for k in range(300)] + [(ids[1], f"text {ids[1]}")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y, names, **options: seen.append(len(x)))
    quality.learn(docs, labels, sample_rows=100)
    quality.learn(docs, labels)
    assert seen == [100, len(ids) + 300]
