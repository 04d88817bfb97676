import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackmart.llm import gam, lm

from .cases import PROSE, TEXTS, documents, empty, rows_of


def test_tables_learn_main_effects_and_an_interaction():
    rng = np.random.default_rng(1)
    x = np.zeros((6000, len(gam.FEATURES)))
    x[:, :4] = rng.uniform(-1, 1, (6000, 4))
    margin = 3 * np.sign(x[:, 0] - 0.2) + 3 * np.sign(x[:, 1] * x[:, 2])  # the product has no main effect
    y = (rng.uniform(size=6000) < 1 / (1 + np.exp(-margin))).astype(float)
    true = (margin > 0) | ((margin == 0) & (y > 0))
    model = gam.fit(x[:4000], y[:4000])
    assert ((model.score(x[4000:]) >= 0.5) == true[4000:])[margin[4000:] != 0].mean() > 0.95
    assert (1, 2) in model.pairs


def test_scores_of_every_text(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(i * 3, int(i % 2)) for i in range(len(TEXTS))] + [(3, None), (999, 1), (None, 0), (6, 7)], "doc_id long, label int")
    got = gam.classify(docs, labels).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows_of(docs))
    assert all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in gam.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert gam.classify(empty(spark), labels).collect() == []


def test_quality_is_learnt_from_other_rows(spark):
    from trackmart.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.1"
    scored = QUERIES["op1_quality_gam"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    held = scored.filter("held_out").join(labels, "doc_id").toPandas()
    assert (held["predicted"] == held["quality"]).mean() > 0.97
    ranks = held["score"].rank()
    good, bad = held["quality"].sum(), (1 - held["quality"]).sum()
    assert (ranks[held["quality"] == 1].sum() - good * (good + 1) / 2) / (good * bad) > 0.98


def test_a_bounded_fit_takes_the_smallest_hashes(spark, monkeypatch):
    table = spark.range(5000).select(F.col("id").alias("doc_id"), *[(F.col("id") * (i + 1) % 97).cast("double").alias(f) for i, f in enumerate(gam.FEATURES)])
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("label"))
    taken = []
    monkeypatch.setattr(gam, "fit", lambda x, y: taken.append(sorted(map(tuple, x))))
    for fit_rows in (300, 4990, 9000):
        gam.train(table, labels, fit_rows)
        expected = table.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows).drop("doc_id").collect()
        assert taken.pop() == sorted(map(tuple, expected))


def base_scores(rows, held_out):
    counts = Counter()
    for doc_id, text in rows:
        if not held_out(doc_id):
            counts.update(lm.tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    out = Counter()
    for doc_id, text in rows:
        words = lm.tokens(text)
        score = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        out[doc_id, len(words), sum(counts[w] > 0 for w in words), total, round(score, 6)] += 1
    return out


@pytest.mark.parametrize("word_classes,hot_words", [(384, 1 << 16), (3, 5)])
def test_unigram_base(spark, word_classes, hot_words):
    docs = documents(spark)
    got = lm.score_texts(docs, F.col("doc_id") % 2 == 1, word_classes, hot_words, rounds=1).collect()
    expected = base_scores(rows_of(docs), lambda i: i is not None and i % 2 == 1)
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == expected
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_hot_words_are_whole_steps_of_counts(spark):
    rows = [(f"w{i}".encode(), 1 + 40 * (i < 9)) for i in range(500)] + [(b"", 7)]
    counts = spark.createDataFrame(rows, "word binary, n long")
    vocab = lm.vocabulary(counts, word_classes=4, hot_words=100)
    assert vocab.hot[:4] == [b"", b"w0", b"w1", b"w2"] and set(vocab.hot) == {b"", *[f"w{i}".encode() for i in range(9)]}
    assert (vocab.total, vocab.distinct, vocab.singles) == (sum(n for _, n in rows), 501, 4)
    assert len(lm.vocabulary(counts, word_classes=30, hot_words=100).hot) == 30  # classes come first


def test_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(lm, "TRAINER_TOKENS", 1 << 16)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    gains = []
    for parts in (2, 64):
        held = lm.score_texts(docs.repartition(parts), F.crc32(F.col("doc_id").cast("string")) % 7 == 2).filter("held_out")
        sums = held.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base"), F.sum("n_tokens").alias("n")).first()
        gains.append((sums["score"] - sums["base"]) / sums["n"])
    print(gains)
    assert min(gains) > 0.1 and abs(gains[0] - gains[1]) < 0.01


def test_nothing_to_learn_from(spark):
    assert lm.score_texts(empty(spark), F.lit(False)).collect() == []
    got = lm.score_texts(documents(spark, ["a b", None]), F.lit(True), rounds=1).filter("doc_id = 0").first()
    assert (got["n_known"], got["train_tokens"], got["base_score"]) == (0, 0, 0.0)


def test_probabilities_add_up_to_one(spark):
    """Over all known words, the end, and one unseen word per ending class, after any context."""
    text = (PROSE + "a b c d ") * 5
    docs = documents(spark, [text] * 3)
    counts = lm.count_words(docs.filter("doc_id IS NOT NULL"))
    vocab = lm.vocabulary(counts, word_classes=6, hot_words=8)
    source = docs.withColumn("held_out", F.lit(False)).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "held_out")
    model = lm.train(lm.code(source, vocab).cache(), vocab, rounds=2)
    near, far, sums = model.vectors @ model.near, model.vectors @ model.far, model.log_sums()
    n = len(model.targets)
    known = {bytes(r["word"]): r["n"] for r in counts.collect()}
    units = 10 ** vocab.unit_logs()
    classes = {w: i for i, w in enumerate(vocab.hot[: vocab.singles])}
    for before, earlier in ((0, 1), (n, n), (n - 1, 2)):
        log = (near[before] + far[earlier]) @ model.targets.T + model.bias - sums[before, earlier]
        share = np.exp(log)
        total = sum(share[classes[w]] for w in classes)
        for word, count in known.items():
            if word not in classes:
                k = vocab.singles + lm.ending_class(word)
                total += share[k] * units[k] * (count + 1)
        total += sum(share[k] * units[k] for k in range(vocab.singles, n))  # unseen words
        assert total == pytest.approx(1, abs=1e-4)


def test_model_beats_the_base_on_held_out_text(spark):
    from trackmart.llm.queries import QUERIES

    held = QUERIES["op5_log_bilinear"](spark, "/root/testdata/sf0.01").filter("held_out")
    sums = held.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base"), F.sum("n_tokens").alias("n")).first()
    assert (sums["score"] - sums["base"]) / sums["n"] > 0.05
