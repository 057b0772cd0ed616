import re

import pytest

import corpus_pipeline
from segloom.llm import exact_dedup, packing, quality, secrets


@pytest.fixture(scope="module")
def small(spark, sf, tmp_path_factory):
    """The smallest documents with labels, exact and near copies, and secrets."""
    d = tmp_path_factory.mktemp("small")
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 120")
    extra = docs.where("doc_id < 20")
    near = extra.selectExpr("doc_id + 1000 as doc_id", "concat(text, ' one more') as text", "lang", "source", "n_chars")
    docs.unionByName(extra.selectExpr("doc_id + 2000 as doc_id", "text", "lang", "source", "n_chars")).unionByName(near).write.parquet(f"{d}/documents.parquet")
    spark.read.parquet(f"{sf}/labels.parquet").write.parquet(f"{d}/labels.parquet")
    return str(d)


def test_stages_equal_brute_force(spark, small, tokenizer, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = quality.fit_quality(docs, spark.read.parquet(f"{small}/labels.parquet"))
    import numpy as np

    rows = {i: t for i, t in rows.items() if model.score(np.array([quality.features(t.encode())]))[0] >= 0.5}
    seen: dict = {}
    for i in sorted(rows):
        seen.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i]), i)
    rows = {i: rows[i] for i in seen.values()}
    from test_duplicates import brute

    ids = sorted(rows)
    groups = brute([rows[i] for i in ids], 5, 80)
    rows = {i: rows[i] for k, i in enumerate(ids) if groups[k][1] == k}
    rows = {i: secrets.redact(t, secrets.scan(t.encode())) for i, t in rows.items()}
    want = packing.pack(spark.createDataFrame(list(rows.items()), "doc_id long, text string"), tokenizer)
    got = corpus_pipeline.run(spark, small)
    pick = lambda df: sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert pick(got) == pick(want)
    assert not any(i >= 2000 for i in rows)  # exact copies
    assert sum(i >= 1000 for i in rows) < 20  # most near copies


def test_stages_keep_columns_and_stand_nothing(spark, empty, small):
    spark.read.parquet(f"{small}/labels.parquet")
    docs = empty
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == empty.columns
        assert docs.count() == 0
        docs = empty
    assert exact_dedup.drop_exact(empty).count() == 0


def test_near_stage_tells_rows_of_one_id_apart(spark):
    a, b = "one two three four five six seven eight", "quite another text of more than five words"
    rows = [(3, a), (3, a), (7, a), (7, b), (7, b), (None, a), (None, b), (9, None), (9, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_stage(spark, docs, "")
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted([(3, a), (7, b), (9, None), (9, "")], key=repr)


def test_registered():
    import __spark_entry__ as e

    names = e.queries()
    assert "pipeline" in names
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if re.match(r"op\d+_", n)) == list(range(1, 14))
