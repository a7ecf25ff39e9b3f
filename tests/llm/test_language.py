"""Language prediction: held-out accuracy, the network against plain loops, and odd rows."""

import numpy as np

from formweave.llm.language import FILTERS, WIDTHS, WINDOW, Scorer, fit, predict_language, windows

DATA = "/root/testdata/sf0.1"


def test_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").repartition(4)
    got = predict_language(docs).filter("held_out").join(docs.select("doc_id", "lang", "n_chars"), "doc_id").toPandas()
    good = (got["lang_pred"] == got["lang"]).to_numpy()
    assert len(got) > 1500 and good.mean() > 0.98
    assert good[got["n_chars"] < 300].mean() > 0.9
    assert ((got["score"] >= 0) & (got["score"] <= 1)).all()


def test_network_against_plain_loops():
    random = np.random.default_rng(0)
    texts = [bytes(random.integers(97, 105, n).astype(np.uint8)) for n in (1, 5, 128, 129, 400)] + [b""]
    rows, counts = windows(texts)
    assert counts.tolist() == [1, 1, 1, 2, 4, 1] and b"".join(r.tobytes() for r in rows[5:9]).rstrip(b"\0") == texts[4]
    network = fit(rows, np.arange(len(rows)) % 3, ["a", "b", "c"], epochs=2)
    got = Scorer(network).texts(texts)
    at = 0
    for text, n, p in zip(texts, counts, got):
        mean = np.zeros(3)
        for k in range(n):
            row = rows[at + k]
            pooled = []
            for width, filters in zip(WIDTHS, network.filters):
                places = [sum(network.embedding[row[i + j]] @ filters[j] for j in range(width)) for i in range(WINDOW - max(WIDTHS) + 1)]
                pooled.append(np.max(places, axis=0))
            part = max(len(text), 1) - k * WINDOW
            mean += network.probabilities(np.concatenate(pooled)[None])[0] * min(part, WINDOW)
        assert np.allclose(p, mean / max(len(text), 1), atol=1e-4)
        at += n
    assert network.out.shape == (FILTERS * len(WIDTHS), 3)


def test_odd_rows(spark):
    words = {"aa": "lorem ipsum dolor sit amet", "bb": "żółć gęślą jaźń zażółć", "cc": "σοφία λόγος ψυχή"}
    rows = [(i, " ".join([words[lang]] * (1 + i % 4)), lang, "en", 0.5) for i in range(300) for lang in [list(words)[i % 3]]]
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, " 12 !? ", None), (1003, "σοφία λόγος " * 50_000, None), (1004, "lorem", "cc"), (1004, "lorem", "cc"), (None, "dolor sit", "bb")]
    docs = spark.createDataFrame(rows + [(*r, None, None) for r in odd], "doc_id long, text string, lang string, lang_pred string, score double").repartition(3)
    out = predict_language(docs).collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == len(rows) + len(odd)
    assert [got[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1000].score == 0
    assert got[1003].lang_pred == "cc" and got[None].lang_pred == "aa" and got[None].held_out
    assert np.mean([got[i].lang_pred == lang for i, _, lang, *_ in rows]) > 0.98
    assert predict_language(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in predict_language(docs.withColumn("lang", docs["lang_pred"].substr(9, 1))).collect()} <= {"und", ""}
    none = predict_language(docs.selectExpr("doc_id", "text", "cast(null AS string) AS lang")).collect()
    assert {r.lang_pred for r in none} == {"und"}


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    changed = docs.selectExpr("doc_id", "text", "IF(crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0, 'zz', lang) AS lang")
    key = lambda d: sorted((r.doc_id, r.lang_pred, r.score) for r in predict_language(d).collect())
    assert key(docs) == key(changed)
