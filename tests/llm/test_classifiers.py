"""Quality and toxicity: held-out accuracy, and odd inputs."""

import zlib

import numpy as np
import pytest
import zstandard

from formweave.llm import toxicity
from formweave.llm.quality import above_quantile, fit_ranker, measures, score_quality
from formweave.llm.toxicity import Model, _convolved, best_cut, calibrate, fit, score_texts, score_toxicity, scores, train, word_rows, _Hashes, _unpacked
from formweave.session import materialise

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").repartition(4), spark.read.parquet(f"{DATA}/labels.parquet")


def held_out(scored, labels, name):
    d = scored.filter("held_out").join(labels, "doc_id").select("score", name).toPandas()
    return d["score"].to_numpy(), d[name].to_numpy() == 1


def auc(score, mark):
    rank = np.empty(len(score))
    rank[np.argsort(score, kind="stable")] = np.arange(1, len(score) + 1)
    return (rank[mark].sum() - mark.sum() * (mark.sum() + 1) / 2) / (mark.sum() * (~mark).sum())


def test_quality_of_held_out_rows(given):
    score, good = held_out(score_quality(*given), given[1], "quality")
    assert auc(score, good) > 0.98
    assert ((score >= 0.3) == good).mean() > 0.97


def test_toxicity_of_held_out_rows(given):
    scored, cuts = score_toxicity(*given)
    score, toxic = held_out(scored, given[1], "toxic")
    assert auc(score, toxic) > 0.9
    called = score >= 0.7
    assert (called & toxic).sum() > 0.75 * toxic.sum() and (called & ~toxic).sum() < 0.02 * (~toxic).sum()
    assert set(cuts) == {"de", "en", "es", "fr"} and all(0 < c < 1 for c in cuts.values())


def test_toxicity_does_not_depend_on_the_sample(spark):
    """A sample that holds all toxic rows and a tenth of the others gives the same scores as all rows."""
    picks = np.random.default_rng(2)
    rows = []
    for i in range(3000):
        toxic = int(picks.random() < 0.1)
        bad = picks.random() < (0.7 if toxic else 0.1)
        rows.append((i, f"plain words {i % 7} and then {'awful' if bad else 'nice'} ones", "en", toxic))
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    docs, labels = given.select("doc_id", "text", "lang"), given.select("doc_id", "toxic")
    means = []
    for sample in (3000, 240):
        model, cuts = train(docs, labels, sample=sample)
        score = score_texts(docs, model).toPandas()["score"].to_numpy()
        means.append((score.mean(), np.quantile(score, 0.99)))
        assert abs(score.mean() - 0.1) < 0.04
    assert np.allclose(means[0], means[1], atol=0.12)


def test_weights_stand_for_rows():
    """Rows counted by weight give the curve and the threshold of the same rows repeated."""
    hashes = _Hashes()
    texts = [word_rows(f"some {'awful' if i % 3 == 0 else 'plain'} words {i % 5}", hashes) for i in range(90)]
    toxic = np.arange(90) % 4 == 0
    many = np.where(toxic, 1, 9)
    one, two = (fit(texts, toxic) for _ in range(2))
    calibrate(one, texts, toxic, many.astype(float))
    calibrate(two, [t for t, n in zip(texts, many) for _ in range(n)], np.repeat(toxic, many))
    assert np.allclose([one.slope, one.offset], [two.slope, two.offset], atol=1e-6)
    score = scores(one, texts)
    assert best_cut(score, toxic, many) == best_cut(np.repeat(score, many), np.repeat(toxic, many))


def test_odd_rows(spark):
    texts = [None, "", "   ", "word", "!!!", "x" * 100000, "word"]
    docs = spark.createDataFrame([(i, t, None, 0.5) for i, t in enumerate(texts)] + [(None, "word", "en", 0.1)], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 1), (5, None, None), (9, 1, 1), (None, 1, 1), (4, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    for one, none in ((labels, labels.limit(0)),):
        for marks in (one, none):
            for scored in (score_quality(docs, marks), score_toxicity(docs, marks)[0]):
                got = scored.collect()
                assert len(got) == 8 and all(0 <= r.score <= 1 for r in got)
                assert len({r.score for r in got if r.doc_id in (3, 6)}) == 1
    assert score_quality(docs.limit(0), labels).count() == 0
    assert score_toxicity(docs.limit(0), labels)[0].count() == 0


def test_ranker_orders_and_quantile_cuts(spark):
    rows = np.random.default_rng(0).normal(size=(400, 15))
    good = rows[:, 2] + 0.1 * rows[:, 5] > 0.3
    model = fit_ranker(rows, good, pairs=5000)
    assert auc(model.expand(rows) @ model.weights, good) > 0.97
    assert len(measures("")) == len(measures("Some words, here.\nAnd here")) == 15
    scored = spark.range(100).selectExpr("id AS doc_id", "id / 100 AS score")
    assert above_quantile(scored, 0.75).count() in (25, 26)


def test_convolution_and_training():
    hashes = _Hashes()
    texts = [word_rows(f"some plain words {i} follow", hashes) for i in range(60)]
    texts += [word_rows(f"some plain awful words {i} follow", hashes) for i in range(60)]
    toxic = np.arange(120) >= 60
    model = fit(texts, toxic)
    score = scores(model, texts)
    assert score[toxic].min() > score[~toxic].max()
    assert best_cut(score, toxic) > score[~toxic].max()
    one = Model(model.table, model.filters, model.shifts, model.out, model.bias)
    words = np.random.default_rng(1).normal(size=(7, 8)).astype(np.float32)
    for filters, shift, got in zip(one.filters, one.shifts, _convolved(one, words)):
        width = len(filters)
        want = [sum(words[i + j] @ filters[j] for j in range(width)) + shift for i in range(7 - width + 1)]
        assert np.allclose(got[: 7 - width + 1], want, atol=1e-5)


def test_toxicity_learns_from_every_labelled_row(spark):
    """A word found in one toxic text alone, among more rows than a task takes, moves the model."""
    rows = [(i, f"plain words {i % 7} nice", "en", 0) for i in range(400)]
    rows += [(1000 + i, f"awful{i} words", "en", 1) for i in range(60)]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model, _ = train(given.select("doc_id", "text", "lang"), given.select("doc_id", "toxic"), sample=10)
    used = [i for i in range(60) if zlib.crc32(b"%d" % (1000 + i)) % 3 != 1 and zlib.crc32(b"back %d" % (1000 + i)) % 5]
    whole = np.array([_unpacked(word_rows(f"awful{i}", _Hashes()))[0, 0] for i in range(60)])
    assert len(used) > 20 and (model.table[whole[used], 0] > 0.05).mean() > 0.95
    score = score_texts(given, model).toPandas().set_index("doc_id")["score"]
    assert score[score.index >= 1000].min() > score[score.index < 1000].max()


def test_toxicity_sends_words_compressed(spark, monkeypatch):
    """No text crosses the network in training: its words do, compressed, whatever the number of labels."""
    rows = [(i, f"Some plain words, and the {i % 50}th of many more of them; " * 20, "en", i % 9 == 0) for i in range(900)]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic boolean").selectExpr("doc_id", "text", "lang", "int(toxic) toxic")
    written = []
    monkeypatch.setattr(toxicity, "materialise", lambda df: written.append(df) or materialise(df))
    train(given.select("doc_id", "text", "lang"), given.select("doc_id", "toxic"))
    plan = written[-1]._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join") :].splitlines()[0]
    assert "merge" in join and "text#" not in plan[: plan.index("MapInArrow run")]
    sent = toxicity.squeezed(given).collect()
    assert sum(len(r.words) for r in sent) * 2 < sum(len(t) for _, t, _, _ in rows)
    hashes = _Hashes()
    for r in sent[:50]:
        words = zstandard.decompress(r.words).split()
        assert (toxicity._rows_of(words, hashes) == word_rows(rows[r.doc_id][1], hashes)).all()
    odd = spark.createDataFrame([(1, "", None), (2, " \n!", "en"), (3, "É a", "fr")], "doc_id long, text string, lang string")
    assert [zstandard.decompress(r.words) for r in toxicity.squeezed(odd).orderBy("doc_id").collect()] == [b"", b"", "É a".encode()]
