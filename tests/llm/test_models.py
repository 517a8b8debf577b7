"""Models by held-out accuracy and recomputation; chat by exact round trips."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from pacegrid.llm import chat, language, queries, rule_quality
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.01"


def test_quality_on_the_held_out_fold(spark, odd_docs, no_docs):
    out = queries.QUERIES["op5_rule_quality"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = out.where("held_out").join(labels, "doc_id")
    assert held.where("predicted = quality").count() >= 0.97 * held.count() > 0
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = rule_quality.fit(docs, labels, sample_rows=100)
    odd = rule_quality.scored(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert rule_quality.scored(no_docs, model).isEmpty()
    assert rule_quality.good(odd_docs, model).columns == odd_docs.columns


def test_rules_as_columns_score_as_in_memory(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    model = rule_quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = docs.select(rule_quality.statistics(F.col("text")).alias("s"), model.score(F.col("text")).alias("score")).select("s.*", "score").toPandas()
    values = rows[list(rule_quality.STATISTICS)].to_numpy(float)
    total = model.intercept + sum(w * r.holds(values) for w, r in model.rules)
    assert np.allclose(1 / (1 + np.exp(-total)), rows["score"])


def test_no_labels_and_one_class(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in rule_quality.scored(odd_docs, rule_quality.fit(odd_docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1) for i in range(8)], "doc_id long, quality int")
    assert all(r.predicted == 1 for r in rule_quality.scored(odd_docs, rule_quality.fit(odd_docs, one)).collect())


def test_repeated_ids_dont_widen_the_quality_sample(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(rule_quality, "fit_rules", lambda values, labels: sizes.append(len(labels)))
    docs = spark.createDataFrame([(i % 20, f"text {i}") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    rule_quality.fit(docs, labels, sample_rows=8)
    assert sizes == [8]


def test_language_frequencies_are_those_of_the_corpus(spark, monkeypatch):
    held, train = [], language.train
    monkeypatch.setattr(language, "train", lambda rows, *corpus: held.append((rows, *corpus)) or train(rows, *corpus))
    rows = [(1, "one row again", "en")] * 300 + [(7, f"mot {i} aa", "fr") for i in range(200)] + [(7, "ein", "de")]
    language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=20)
    ((sample, seen, documents),) = held
    expected = np.zeros(language.BUCKETS)
    for _, text, _ in rows:
        codes = language.folded(text)
        expected[np.unique(np.concatenate([language.grams(codes, order) for order in language.ORDERS]))] += 1
    assert documents == len(rows) and (seen == expected).all()
    drawn = [lang for lang, _, _ in sample]
    assert drawn.count("en") == 1 and drawn.count("de") == 1 and 5 <= drawn.count("fr") <= 50


def test_language_on_the_held_out_fold(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = queries.QUERIES["op10_language"](spark, SF).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert out.where("lang_pred = lang").count() >= 0.97 * out.count() > 0
    model = language.fit(docs, per_language=30)
    odd = {(r.doc_id, r.lang_pred == "und", r.score == 0) for r in language.identified(odd_docs, model).collect()}
    assert {(i, True, True) for i in (0, 1, 2)} <= odd and (3, False, False) in odd
    assert language.identified(no_docs, model).isEmpty()
    assert {r.lang_pred for r in language.identified(odd_docs, language.fit(no_docs)).collect()} == {"und"}
    assert language.told(odd_docs, model).columns == odd_docs.columns


def test_only_so_many_languages_are_learned(spark):
    rows = [(3 * i, f"texte numero {i}", f"l{i % 7}" if i % 3 else "en") for i in range(90)]
    docs = spark.createDataFrame([r for r in rows], "doc_id long, text string, lang string")
    assert len(language.fit(docs, languages=2).languages) == 2


def test_kept_rows_are_those_that_score(spark, odd_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    both = docs.unionByName(docs.limit(20))
    quality = rule_quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = rule_quality.scored(both, quality)
    assert rule_quality.good(both, quality).count() == scores.where("score >= 0.5").count()
    model = language.fit(docs, per_language=30)
    sure = language.identified(both, model).where("lang_pred <> 'und' AND score >= 0.7").count()
    assert language.told(both, model, 0.7).count() == sure


def test_null_turns_come_first(spark):
    rows = [(1, 1, "user", "b"), (1, None, "assistant", "a"), (1, 0, "user", "c")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (row,) = chat.digests(chat.format_conversations(turns)).collect()
    assert row.turns_sha256 == hashlib.sha256(b"assistant\na\nuser\nc\nuser\nb\n").hexdigest()


def test_trial_rows_are_made_without_python(spark):
    plan = queries.QUERIES["op8_chat_format"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ExistingRDD" not in plan and "Arrow" not in plan


def test_numerals_are_no_letters():
    one = language.train([("en", np.array([1], "<u4"), np.array([2.0])), ("fr", np.array([2], "<u4"), np.array([1.0]))])
    names, scores = one.predict([None, "", "²", "½ Ⅷ _ 12", "٣ ٤", "²a", "日"])
    assert names[:5] == ["und"] * 5 and scores[:5] == [0.0] * 5
    assert "und" not in names[5:] and all(0 < s <= 1 for s in scores[5:])


def test_logits_are_those_of_single_texts(spark):
    model = language.fit(spark.read.parquet(f"{SF}/documents.parquet"), per_language=30)
    texts = ["the thing", "le la été", "x", "der die das und 12 !!", "a" * 5_000]
    whole = model.logits(texts)
    assert np.allclose(whole, np.concatenate([model.logits([t]) for t in texts]))


def test_chat_round_trip(spark):
    texts = [t for t in ODD if t is None or len(t) < 100] + [queries.TRIAL_TEXT, "\n### user: x</turn>", "</turn", ": ", "\\", "a\\", "\\c</turn>\\"]
    rows = [(c, i, role, t) for c, roles in ((1, ["user", "assistant"]), (None, ["a: b", "</turn>", None, ""])) for i, (t, role) in enumerate((t, r) for t in texts for r in roles)]
    turns = spark.createDataFrame([(*r, "x", 1) for r in [*rows, rows[0]]], "conv_id long, turn long, role string, text string, line string, tries int")
    formatted = chat.format_conversations(turns)
    back = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    for conv in (1, None):
        listed = sorted((r[1], r[2] or "", r[3] or "") for r in [*rows, rows[0]] if r[0] == conv)
        assert [(t.role, t.text) for t in back[conv].turns] == [(r, t) for _, r, t in listed]
        assert back[conv].loss_text == "".join(t for _, r, t in listed if r == "assistant")
    digest = {r.conv_id: r for r in chat.digests(formatted).collect()}
    assert digest[1].loss_sha256 == hashlib.sha256(back[1].loss_text.encode()).hexdigest()
    assert chat.format_conversations(turns.limit(0)).isEmpty()
    assert chat.turn_lines(turns.where(F.col("text") == queries.TRIAL_TEXT)).where("tries = 1").isEmpty()
    plan = chat.digests(formatted)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
