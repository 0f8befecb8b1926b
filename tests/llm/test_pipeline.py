"""The pipeline, stage by stage, against plain Python over the same rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from larkspur.llm import decontaminate, langid, ngram_join, packing, pii, registry
from larkspur.llm.common import written
from larkspur.llm.tokens import tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "personal_data", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "123 456", None, None, None), (-3, docs.first().text, "en", "s", 1)], docs.schema)
    at = written(docs.union(extra), "in")
    seen = [at]
    for _, stage in corpus_pipeline.STAGES:
        at = written(stage(spark, at, sf), "stage")
        seen.append(at)
    for df in seen[1:5]:
        assert df.columns == COLUMNS
    rows = [{r.doc_id: r for r in df.collect()} for df in seen[:5]]

    assert set(rows[0]) - set(rows[1]) <= {-1, -2} | {i for i, r in rows[0].items() if not any(c.isalpha() for c in r.text or "")} | _mixed(seen[0])
    assert {-1, -2}.isdisjoint(rows[1])

    sets = {i: _shingles(r.text) for i, r in rows[1].items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = list(sets)
    for n, i in enumerate(order):
        for j in order[:n]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    assert set(rows[2]) == {i for i in sets if find(i) == i} and -3 in rows[2]

    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    index = decontaminate.ItemIndex([(r.item_id, r.text) for r in items], decontaminate.Options(least_words=corpus_pipeline.LEAST_WORDS))
    order = list(rows[2])
    leaks = {order[x[0]] for x in index.search([rows[2][i].text for i in order])}
    assert {i for i, r in rows[2].items() if any(x.text in r.text for x in items)} <= leaks
    assert set(rows[3]) == set(rows[2]) - leaks

    for i, r in rows[3].items():
        masked = pii.masked(r.text, pii.find(r.text))
        assert (rows[4][i].text, rows[4][i].n_chars) == (masked, len(masked))
    assert set(rows[4]) == set(rows[3])

    t = tokenizer(public_tokenizers.path(registry.TOKENIZER))
    expected = {i: t.encode([r.text])[0] for i, r in rows[4].items()}
    pieces: dict = {}
    for p in sorted(seen[5].collect(), key=lambda p: p.start):
        pieces[p.doc_id] = pieces.get(p.doc_id, b"") + bytes(p.ids)
        assert p.length in packing.piece_lengths(p.doc_tokens, 2048)
    assert pieces == expected


def test_mixtures_go_and_clean_texts_stay(spark):
    """Long texts of stretches in all languages are rejected, long and short texts in one are not."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.where("length(text) between 400 and 3000 and lang is not null").orderBy("doc_id").collect()
    words = {}
    for r in rows:
        words.setdefault(r.lang, []).extend(r.text.split())
    mixed = [" ".join(w for part in range(3) for x in sorted(words) for w in words[x][k * 150 + part * 20 : k * 150 + part * 20 + 20]) for k in range(10)]
    short = [(-100 - i, " ".join(words[x][i * 9 : i * 9 + 8]), x) for x in sorted(words) for i in range(10)]
    extra = [(-1 - i, t, "en", "s", len(t)) for i, t in enumerate(mixed)] + [(i, t, x, "s", len(t)) for i, t, x in short]
    given = docs.union(spark.createDataFrame(extra, docs.schema))
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, given, "").collect()}
    assert kept.isdisjoint(range(-10, 0))
    assert sum(i in kept for i, _, _ in short) >= len(short) - 1
    assert sum(r.doc_id in kept for r in rows) >= 0.995 * len(rows)


def test_columns_that_clash(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40).selectExpr("*", "0.5 score", "'x' lang_pred", "doc_id component_id", "'y' _text", "1 spans")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.columns == docs.columns and after.count() <= 40, name


def _shingles(text):
    from tests.llm.test_ngram_join import shingles

    return shingles(text)


def _mixed(df):
    """Rows in which no language rules."""
    model = langid.train(langid.training_rows(df.where(~registry.held_out("doc_id"))))
    found = langid.predict(df, model, keys=("doc_id", "text"))
    return {r.doc_id for r in found.where(F.col("score") < corpus_pipeline.least_share(len(model.labels), F.length("text"))).collect()}


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0
    assert ngram_join.PART == 80
