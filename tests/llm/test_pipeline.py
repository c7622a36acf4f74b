import corpus_pipeline
from pyspark.sql import functions as F

from tickerlake.llm import stages
from tests.conftest import SF_MID
from tests.llm.helpers import LONG, WORD, docs_of, words_of
from tests.llm.test_jaccard import brute


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_near_duplicates_keep_one_of_each(spark):
    base = " ".join(f"w{i}" for i in range(100))
    rows = [(9, base), (4, base), (6, base + " end"), (1, "other words that stand alone here"), (2, ""), (3, None), (2, ""), (None, "no id at all in this one"),
            (8, base.replace("w50 ", "")), (11, LONG)]
    docs = docs_of(spark, [(i, t, "s") for i, t in rows]).withColumn("_key", F.lit("clash"))
    for part in (docs, docs.where("doc_id in (9, 4, 6, 1, 3, 8)")):
        out = stages.one_of_each(spark, part, SF_MID)
        assert out.columns == part.columns
        own = [(i, t) for i, t in texts(part)]
        groups = len({c for _, c in brute([(k, t) for k, (_, t) in enumerate(own)], 5, 80).values()})
        assert out.count() == groups
    assert {i for i, _ in texts(stages.one_of_each(spark, docs.where("doc_id in (9, 4, 6, 1, 3, 8)"), SF_MID))} == {1, 3, 4}


def test_mixing_cuts_documents_by_words(spark):
    rows = [(i, " \n".join(f"d{i}w{k}" for k in range(i * 53 % 700)), f"s{i % 4}") for i in range(60)] + [(70, None, None), (71, "x  y", None), (70, "x  y", None)]
    docs = docs_of(spark, rows)
    out = stages.mix_sources(spark, docs, SF_MID)
    assert out.columns == docs.columns
    whole = {}
    for i, t, s in rows:
        whole.setdefault((i, s), []).append(t or "")
    sizes, taken = {}, {}
    for r in out.collect():
        assert any(r.text in t for t in whole[(r.doc_id, r.source)]) and r.text and r.n_chars == len(r.text)
        taken[r.source] = taken.get(r.source, 0) + len(words_of(r.text))
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words_of(t))
    from tickerlake.llm import mixing

    names = sorted(sizes, key=lambda s: (s is None, s))
    want = mixing.targets([sizes[s] for s in names], [mixing.WEIGHTS[k % 3] for k in range(len(names))])
    assert all(abs(taken.get(s, 0) - w) <= 1 for s, w in zip(names, want))


def test_packing_holds_every_word(spark):
    rows = [(i % 20, " \t".join(f"d{i % 20}w{k}" for k in range(i % 20 * 53 % 700)), f"s{i % 4}") for i in range(60)] + [(70, None, None), (71, LONG, None)]
    out = stages.pack_bins(spark, docs_of(spark, rows), SF_MID).collect()
    words = sorted(w for _, t, _ in rows for w in words_of(t))
    assert sorted(w for r in out for w in WORD.findall(r.text)) == words
    assert all(len(words_of(r.text)) == r.words for r in out)
    seen = [(r.group_no, r.bin_no, r.doc_id) for r in out]
    assert len(seen) == len(set(seen))


def test_texts_are_cut_in_small_batches(spark, monkeypatch):
    """The cutting plans are run where Arrow batches are small (they were run by whoever wrote the result, in batches of 64 MB),
    the setting comes back, and what served them alone is deleted."""
    docs = docs_of(spark, [(i, " ".join(f"d{i}w{k}" for k in range(400)), f"s{i % 3}") for i in range(30)])
    name, made, gone = "spark.sql.execution.arrow.maxBytesPerBatch", [], []
    before = spark.conf.get(name)
    real = stages.written
    monkeypatch.setattr(stages, "written", lambda df, *a, **how: (made.append((a[0], spark.conf.get(name))), real(df, *a, **how))[1])
    monkeypatch.setattr("tickerlake.llm.common.remove", lambda spark, path: gone.append(path))
    for stage, kept in ((stages.mix_sources, "mixed"), (stages.pack_bins, "packed")):
        gone.clear()
        out = stage(spark, docs, SF_MID)
        assert made[-1] == (kept, "2m") and spark.conf.get(name) == before
        assert "MapInArrow" not in out._jdf.queryExecution().toString()
        assert gone and not any(kept in path for path in gone)
        assert out.count() >= 30


def test_filters_carry_other_columns(spark):
    docs = docs_of(spark, [(1, "a nice text", "s"), (1, "a nice text", "s"), (None, None, None)]).withColumn("_score", F.lit(3)).withColumn("y", F.lit("x"))
    for stage in (stages.drop_toxic, stages.keep_quality):
        out = stage(spark, docs, SF_MID)
        assert out.columns == docs.columns and out.count() in (0, 1, 2, 3)
        assert stage(spark, docs.limit(0), SF_MID).collect() == []


def test_empty_tables(spark):
    empty = docs_of(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_MID).collect() == []


def test_run(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    out = corpus_pipeline.run(spark, SF_MID).collect()
    bins = {}
    for r in out:
        assert r.text in docs[r.doc_id].text and docs[r.doc_id].source == r.source
        bins.setdefault((r.group_no, r.bin_no), []).append(r)
    for own in bins.values():
        assert sum(r.words for r in own) <= 2048
        assert len({r.doc_id for r in own}) == len({r.source for r in own}) == len(own)
    ids = {r.doc_id for r in out}
    bad = [i for i in ids if i in labels and (labels[i].quality == 0 or labels[i].toxic == 1)]
    clean = [i for i, x in labels.items() if x.quality == 1 and x.toxic == 0]
    assert len(bad) <= 0.05 * len(ids) and len(clean) > 100
    groups = brute([(i, docs[i].text) for i in ids], 5, 80)
    assert len({c for _, c in groups.values()}) == len(ids)
