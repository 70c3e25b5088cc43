from __future__ import annotations

import zlib

import duckdb
import edge
import pytest
from conftest import SF
from pyspark.sql import functions as F

from wardlens.llm import language_id, mixing


def by_statement(docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "source", "text").toPandas().astype({"doc_id": "Int64"}))
    return sorted(map(str, con.execute(mixing.statement()).fetchall()))


def test_mix_equals_the_statement(spark):
    fixture = spark.read.parquet(f"{SF}/documents.parquet")
    for docs in (fixture, edge.documents(spark, repeat=True, null_id=True)):
        out = mixing.mix_sources(docs)
        key = "_copy" if "copy" in docs.columns else "copy"
        got = out.select("doc_id", "source", F.col(key), "text", "shuffle_key").collect()
        assert sorted(str(tuple(r)) for r in got) == by_statement(docs)
        assert out.columns[: len(docs.columns)] == docs.columns


def test_weights_are_reached_on_average(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") % 7 + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("source"),
    )
    size = docs.where("source <> 'c'").agg(F.sum(F.length("text"))).first()[0]
    out = mixing.mix_sources(docs, {"hot": 1.0, "b": 4.0}).groupBy("source").agg(F.sum(F.length("text")).alias("n"))
    got = {r.source: r.n for r in out.collect()}
    assert set(got) == {"hot", "b"}
    assert abs(got["hot"] - size / 5) < 0.1 * size / 5 and abs(got["b"] - 4 * size / 5) < 0.05 * size


def test_high_rates_are_sums_of_chunks(spark):
    rates = spark.range(3000).select(mixing.repetitions(F.lit(100.0), F.col("id").cast("string")).alias("k"))
    row = rates.agg(F.avg("k"), F.var_samp("k")).first()
    assert abs(row[0] - 100) < 1 and abs(row[1] - 100) < 12


def test_empty_mix(spark):
    assert mixing.mixed_documents(edge.empty(spark)).count() == 0
    nothing = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert mixing.mix_sources(nothing).count() == 0


def test_mix_is_native(spark):
    plan = mixing.mix_sources(edge.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Cartesian" not in plan


@pytest.fixture(scope="module")
def predicted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, language_id.identify_languages(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()


def test_held_out_accuracy(predicted):
    _, rows = predicted
    held = [r for r in rows if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    spoiled = docs.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    assert language_id.train(docs) == language_id.train(spoiled)


def test_language_edges(spark):
    docs = edge.documents(spark, repeat=True, null_id=True)
    out = {(r.doc_id, r.lang_pred) for r in language_id.identify_languages(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    for i, lang in out:
        if i in texts:
            assert (lang == "und") == (not any(c.isalpha() for c in texts[i] or "")), texts[i]
    kept = language_id.with_known_language(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert language_id.identify_languages(edge.empty(spark)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language_id.identify_languages(unlabelled).collect()} == {("und", 0.0)}


def test_a_table_that_teaches_no_language_is_refused_instead_of_dropped(spark):
    unlabelled = edge.documents(spark).withColumn("lang", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="no labelled document"):
        language_id.with_known_language(unlabelled)
    assert language_id.with_known_language(unlabelled.where("text is null or text = ''")).count() == 0


def test_back_off_goes_from_words_to_shorter_ngrams():
    import numpy as np

    table = lambda names, rows: (tuple(names), np.array(rows, float).tobytes())
    model = language_id.Model(
        ("a", "b"), 1,
        (table(["known"], [[-1, -9]]), table(["<new"], [[-9, -2]]), table(["<xy"], [[-3, -8]]), table([], np.zeros((0, 2))), table(["q"], [[-7, -1]])),
    )
    scorer = language_id.Scorer(model)
    assert scorer.predict("known")[0] == "a"
    assert scorer.predict("news")[0] == "b"
    assert scorer.predict("xyz")[0] == "a"
    assert scorer.predict("oqo")[0] == "b"
    assert scorer.predict("zzz") == ("b", 0.5)
    assert scorer.predict("123 ²") == ("und", 0.0)


def test_memory_of_words_is_bounded(predicted, spark, monkeypatch):
    docs, rows = predicted
    model = language_id.train(docs)
    whole = language_id.Scorer(model)
    monkeypatch.setattr(language_id, "MEMO_WORDS", 40)
    small = language_id.Scorer(model)
    for r in rows[:60]:
        assert small.predict(r.text)[0] == whole.predict(r.text)[0]
    assert len(small.vectors) <= len(small.known) + 41


def brute_languages(docs, words_kept, grams_kept):
    """doc_id -> (language, score), from the definition: counts of all languages of every string that is frequent in any."""
    import math
    import re
    from collections import Counter

    def words_of(text):
        return re.findall(r"[^\W\d_]+", (text or "").lower())

    def strings(word, order):
        marked = word if order == 1 else f"<{word}>"
        return [word] if order == 0 else [marked[k : k + order] for k in range(len(marked) - order + 1)]

    counts, rows = {}, docs.select("doc_id", "text", "lang").collect()
    taught = [r for r in rows if r.lang is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 5]
    for r in taught:
        for word in words_of(r.text):
            for order in range(5):
                counts.setdefault((r.lang, order), Counter()).update(strings(word, order))
    languages = sorted({r.lang for r in taught})
    kept = {}
    for order in range(5):
        top = set()
        for lang in languages:
            own = counts.get((lang, order), Counter())
            top |= set(sorted(own, key=lambda g: (-own[g], g))[: words_kept if order == 0 else grams_kept])
        kept[order] = top

    def vector(string, order):
        out = []
        for lang in languages:
            own = counts.get((lang, order), Counter())
            out.append(math.log((own[string] + 0.5) / (sum(own.values()) + 0.5 * (len(kept[order]) + 1))))
        return out

    def of_word(word):
        for order in (0, 4, 3, 2, 1):
            found = [vector(s, order) for s in strings(word, order) if s in kept[order]]
            if found:
                return [sum(v) / len(found) for v in zip(*found)]
        return None

    default = max(languages, key=lambda lang: (sum(r.lang == lang for r in taught), -languages.index(lang)))
    memo, out = {}, {}
    for r in rows:
        words = words_of(r.text)
        used = [memo.setdefault(w, of_word(w)) for w in words]
        used = [v for v in used if v is not None]
        if not words:
            out[r.doc_id] = ("und", 0.0)
        elif not used:
            out[r.doc_id] = (default, 1 / len(languages))
        else:
            mean = [sum(v) / len(used) for v in zip(*used)]
            odds = [math.exp(m - max(mean)) for m in mean]
            out[r.doc_id] = (languages[odds.index(max(odds))], max(odds) / sum(odds))
    return out


@pytest.mark.parametrize("kept", [None, 12])
def test_predictions_equal_the_definition(spark, monkeypatch, kept):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    if kept:  # few strings, so that most words back off and some end in a single letter or nothing
        monkeypatch.setattr(language_id, "WORDS", kept)
        monkeypatch.setattr(language_id, "GRAMS", kept)
        extra = [(10_000 + k, t, "fr" if k == 1 else None) for k, t in enumerate(["日本語 テキスト", "ñandú ž", "1 2", "日 the"])]
        docs = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(extra, "doc_id long, text string, lang string"))
    want = brute_languages(docs, kept or language_id.WORDS, kept or language_id.GRAMS)
    for r in language_id.identify_languages(docs).collect():
        assert r.lang_pred == want[r.doc_id][0] and r.score == pytest.approx(want[r.doc_id][1], abs=1e-9)


def test_a_script_that_was_never_seen_is_not_known(spark):
    scorer = language_id.Scorer(language_id.train(spark.read.parquet(f"{SF}/documents.parquet")))
    language, score = scorer.predict("日本語 テキスト")
    assert score == 1 / len(scorer.model.languages) and language == scorer.model.languages[scorer.model.default]


def test_too_many_languages_are_refused(spark):
    docs = spark.range(40).selectExpr("id doc_id", "'some text' text", "concat('l', id) lang")
    with pytest.raises(ValueError, match="most_languages"):
        language_id.train(docs, most_languages=10)


def test_the_stage_fills_languages_by_the_prediction(spark):
    """A constant model, or one that predicts at random, fails here."""
    given = spark.read.parquet(f"{SF}/documents.parquet")
    hidden = given.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), F.lit(None)).otherwise(F.col("lang")))
    truth = {r.doc_id: r.lang for r in given.collect()}
    told = {r.doc_id: r.lang for r in language_id.with_known_language(hidden).collect()}
    held = [i for i in told if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len({truth[i] for i in held}) > 1
    assert sum(told[i] == truth[i] for i in held) >= 0.97 * len(held)
    assert all(told[i] == truth[i] for i in told if i not in held)
