"""The pipeline, stage by stage, each against brute force on its own input."""

import corpus_pipeline
from formweave.llm.common import table
from formweave.llm.quality import score_quality
from tests.llm.test_near_dedup import brute as near_brute
from tests.llm.test_near_dedup import shared_ids
from tests.llm.test_packing import check as packing_check
from tests.llm.test_passages import brute as passages_brute

DATA = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = table(spark, DATA, "documents")
    columns, seen = docs.columns, []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(number))
        stage(spark, docs, DATA).write.parquet(path)
        seen.append(docs)
        docs = spark.read.parquet(path)
        if number + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns, name
    seen.append(docs)
    rows = [{r.doc_id: r.text for r in d.collect()} for d in seen[:-1]]

    scores = {r.doc_id: r.score for r in score_quality(seen[0], table(spark, DATA, "labels")).collect()}
    assert set(rows[1]) == {i for i in rows[0] if scores[i] >= 0.3}
    latest = {t: i for i, t in sorted(rows[1].items())}
    assert set(rows[2]) == set(latest.values())
    classes = near_brute(list(rows[2].items()))
    assert set(rows[3]) == {low for _, low in classes}
    removed = {i: (n, gone) for i, n, gone, _, _ in passages_brute(list(rows[3].items()))}
    assert set(rows[4]) == {i for i, (n, gone) in removed.items() if gone < n or not n}
    for i, text in rows[4].items():
        assert 0 <= len(text.encode()) - (removed[i][0] - removed[i][1]) <= 6 * 20
    assert packing_check(list(rows[4].items()), seen[5].collect()) < 0.05
    assert all(r.n_chars == len(r.text) for r in seen[4].collect())


def test_edges(spark):
    """Nulls, repeated rows and rows of one id with different texts pass every stage."""
    good = " ".join(f"word{i} of the text number {i}." for i in range(40))
    rows = [(1, good), (1, good), (2, good + " more"), (None, "short but fine text here."), (3, None), (4, ""), (5, good[:300]), (5, "other words, same id.")]
    docs = spark.createDataFrame([(i, t, None, "s", 0, 7) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, key int")
    for name, stage in corpus_pipeline.STAGES:
        for some in (docs, docs.limit(0)):
            out = stage(spark, some, DATA)
            assert out.count() <= 4 * some.count(), name
    exact = {(r.doc_id, r.text) for r in corpus_pipeline.exact(spark, docs, DATA).collect()}
    assert exact == {(1, good), (2, good + " more"), (None, rows[3][1]), (4, ""), (5, good[:300]), (5, rows[7][1])}


def test_near_copies_of_one_id(spark):
    """Only the row that is a near copy goes, not all rows of its id or all rows without one."""
    rows, kept, _ = shared_ids()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.text) for r in corpus_pipeline.near(spark, docs, DATA).collect()} == kept


def test_columns_named_like_helpers(spark):
    """Extra columns of any name pass through the filtering stages unchanged."""
    names = ["features", "features_", "copy_id", "copy_key", "copy_sha", "copy_kept", "__id", "__key", "__sha", "__kept", "key", "score", "class", "kept", "group_size"]
    good = " ".join(f"word{i} of the text number {i}." for i in range(40))
    texts = [good, good, good.replace("word7", "other"), "An entirely different but fine text, with some words."]
    rows = [(i, t, None, "s", len(t), *[f"{n}{i}" for n in names]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns, name
        kept = [tuple(r) for r in out.collect()]
        assert kept and all(tuple(r)[4 if name.startswith("suffix") else 0 :][1:] == rows[r[0]][4 if name.startswith("suffix") else 0 :][1:] for r in kept), name
