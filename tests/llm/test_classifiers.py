import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerlake.llm import labelled, quality, toxicity
from tickerlake.llm.queries import op5_toxicity, op7_quality_gam
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.helpers import LONG, docs_of, rng, sentence

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark, n=400):
    r = rng()
    docs, labels = [], []
    for i in range(n):
        toxic, good = i % 8 == 0, i % 5 != 0
        words = sentence(r, 40).split()
        if toxic and i % 16 == 0:
            words[3], words[9] = "idiot", "Scum,"
        elif toxic:
            words[5] = "zorg" + words[5]            # a stem that only labels tell
            words[25] = "zorg" + words[25]
        text = " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words)
        docs.append((i, text, "s"))
        labels.append((i, int(good), int(toxic)))
    return docs, spark.createDataFrame(labels, LABELS)


def test_toxicity_learns_and_holds_out(spark):
    docs, labels = corpus(spark)
    more = [(900, "", "s"), (901, None, "s"), (902, LONG, "s"), (903, LONG + " you moron scum idiot", "s"), (None, "nice words here", None), (905, "dup idiot", "s"), (905, "dup idiot", "s")]
    df = docs_of(spark, docs + more).withColumn("_score", F.lit("clash"))
    model = toxicity.fit(df, labels)
    scored = toxicity.score(df, model, "tox").collect()
    assert len(scored) == len(docs) + len(more) and all(0 <= r.tox <= 1 for r in scored)
    wrong = [r.doc_id for r in scored if r.doc_id is not None and r.doc_id < 900 and (r.tox >= 0.5) != (r.doc_id % 8 == 0)]
    assert len(wrong) <= 4
    by = {r.doc_id: r.tox for r in scored}
    assert by[900] == by[901] < 0.5 and by[902] < 0.5 <= by[903]
    assert len({r.tox for r in scored if r.doc_id == 905}) == 1
    held = {r.doc_id for r in df.where(labelled.held_out(F.col("doc_id"))).collect()}
    assert not held & {r.doc_id for r in labelled.labelled_sample(df, labels, "toxic").collect()}
    assert 40 < len(held) < 120
    # Labels of held-out rows change nothing.
    other = labels.withColumn("toxic", F.when(labelled.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.fit(df, other)
    assert again["terms"] == model["terms"] and np.allclose(again["w"], model["w"])


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([(None, None, None), (1, None, None)], LABELS)
    df = docs_of(spark, [(i, f"plain words {i}", "s") for i in range(30)] + [(50, "you stupid idiot scum", "s"), (51, None, "s")])
    scored = {r.doc_id: r.t for r in toxicity.score(df, toxicity.fit(df, none), "t").collect()}
    assert scored[50] > scored[0]
    assert {r.q for r in quality.score(df, quality.fit(df, none), "q").collect()} == {0.5}
    gone = df.limit(0)
    assert toxicity.score(gone, toxicity.fit(gone, none), "t").collect() == []
    assert quality.score(gone, quality.fit(gone, none), "q").collect() == []


def test_label_model_finds_accuracies():
    r = np.random.default_rng(0)
    y = r.random(4000) < 0.3
    right = [0.9, 0.8, 0.6]
    votes = np.stack([np.where(r.random(4000) < p, y, ~y) for p in right], 1).astype(np.int8)
    votes = np.concatenate([votes, votes[:, :1]], 1)       # a voter that repeats the first
    gold = np.where(np.arange(4000) < 400, y, -1)
    model = toxicity.label_model(votes, gold)
    for j, p in enumerate(right):
        assert model["theta"][1][2][j] == pytest.approx(p, abs=0.1)
    assert model["weight"][0] < 0.75 and model["weight"][3] < 0.75 and model["weight"][2] > 0.8
    assert ((model["posterior"] > 0.5) == y).mean() > 0.85


def test_label_model_sees_all_texts(spark, monkeypatch):
    """Voters that fire in few unlabelled texts count; and sums in Spark are those of the driver."""
    docs, labels = corpus(spark, 300)
    docs += [(1000 + i, f"plain {i} words" + (" vermin filth" if i % 30 == 0 else ""), "s") for i in range(300)]
    df = docs_of(spark, docs)
    model = toxicity.fit(df, labels)
    got, at = model["label_model"], model["terms"].index(" vermin ")
    texts = got["prior"] * got["theta"][1][2][at] + (1 - got["prior"]) * got["theta"][0][2][at]
    assert texts * 600 == pytest.approx(10, abs=1.5)
    monkeypatch.setattr(toxicity, "DRIVER_PATTERNS", 0)
    again = toxicity.fit(df.repartition(3), labels)
    assert all(np.array_equal(got[k], again["label_model"][k]) for k in ("theta", "weight", "prior"))
    assert all(np.array_equal(model[k], again[k]) for k in ("w", "d")) and model["b"] == again["b"]


def test_linear_classifier_learns_from_all_texts(spark):
    """Patterns with counts give the weights of a plain regression over every single text."""
    r = np.random.default_rng(3)
    codes, voters = toxicity.codes_of(5, 3), 3
    model = {"theta": r.uniform(0.1, 0.6, (2, 3, voters + 6)), "weight": np.ones(voters + 6), "prior": 0.2}
    seen = [(int(r.integers(-1, 2)), sorted(r.choice(11, r.integers(0, 6), replace=False).tolist()), int(r.integers(1, 40))) for _ in range(60)]
    patterns = spark.createDataFrame(seen, "y int, found array<int>, texts long")
    w = toxicity.linear_fit(patterns, model, codes)
    x = np.array([[float(j in f) for j in range(11)] + [1.0] for _, f, n in seen for _ in range(n)])
    ratio = np.log(model["theta"][1] / model["theta"][0])
    t = []
    for y, f, n in seen:
        cast = {codes[j] // 2: codes[j] % 2 for j in f if codes[j] >= 0}
        z = math.log(0.2 / 0.8) + sum(ratio[1 + cast[v] if v in cast else 0][v] for v in range(voters + 6)) + {1: 4.0, 0: -4.0, -1: 0.0}[y]
        t += [1 / (1 + math.exp(-z))] * n
    slope = x.T @ (1 / (1 + np.exp(-x @ w)) - np.array(t)) / len(t) + 1e-4 * np.append(w[:-1], 0)
    assert np.abs(slope).max() < 1e-5


def test_many_copies_under_one_id_change_nothing_but_counts(spark):
    docs, labels = corpus(spark, 200)
    df = docs_of(spark, docs + [(5000, "one plain text", "s")] * 3000)
    model = toxicity.fit(df, labels)
    patterns = toxicity.feature_patterns(df, labelled.labelled_sample(df, labels, "toxic"), model["terms"], model["voters"])
    assert patterns.count() < 250 and patterns.agg(F.sum("texts")).first()[0] == 3200


def test_tables_learn_an_interaction():
    r = np.random.default_rng(0)
    x = r.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.boost(x, y)
    assert (0, 1) in [(i, j) for i, j, _ in model["pairs"]]
    assert ((quality.apply_tables(model, x) > 0.5) == y).mean() > 0.95


def test_quality_scores(spark):
    docs, labels = corpus(spark)
    more = [(900, "", "s"), (901, None, "s"), (902, LONG, "s"), (None, "nice words here.", None)]
    df = docs_of(spark, docs + more)
    model = quality.fit(df, labels)
    got = {r.doc_id: r.q for r in quality.score(df, model, "q").collect()}
    assert all((got[i] >= 0.3) == (i % 5 != 0) for i in range(400))
    assert got[900] == got[901] and not math.isnan(got[902])


def test_held_out_accuracy(spark):
    """On the given documents: rows whose labels were not learned from."""
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    for query, column, least in ((op5_toxicity, "toxic", 0.95), (op7_quality_gam, "quality", 0.97)):
        rows = query(spark, SF_MID).collect()
        assert len(rows) == 1000 and all(r.predicted == int(r.score >= (0.5 if column == "toxic" else 0.3)) for r in rows)
        held = [r for r in rows if r.held_out and r.doc_id in labels]
        assert len(held) > 40
        assert np.mean([r.predicted == labels[r.doc_id][column] for r in held]) >= least


def test_copies_are_no_evidence(spark):
    """Words of a toxic text that is copied many times, with small changes, are not mined; the stem of many texts is."""
    docs, labels = corpus(spark, 400)
    r = rng()
    base = sentence(r, 120).split()
    for i in range(300):
        words = list(base)
        words[i % 120] = f"other{i}"
        words[60] = "quibblefax"
        docs.append((2000 + i, " ".join(words) + " idiot" * (i % 2), "s"))
    more = spark.createDataFrame([(2000 + i, 1, 1) for i in range(300)], LABELS)
    df = docs_of(spark, docs)
    sample = labelled.labelled_sample(df, labels.union(more), "toxic")
    kept = toxicity.without_copies(sample)
    assert kept.where("doc_id >= 2000").count() <= 10 < 200 < sample.where("doc_id >= 2000").count()
    assert kept.where("doc_id < 2000").count() >= 0.95 * sample.where("doc_id < 2000").count()
    mined = toxicity.mine_terms(kept, [f" {w} " for w in toxicity.LEXICON], 100)
    assert not any("quib" in t for t in mined)
    assert toxicity.band_keys("") == toxicity.band_keys(None) != toxicity.band_keys("a")
