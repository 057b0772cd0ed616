import random
import re

import pytest

from segloom.llm import exact_dedup, jaccard
from segloom.llm.graphs import connected_components

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def normal(t):
    return SPACE.sub(" ", t or "")


def test_exact_groups(documents, texts):
    groups: dict = {}
    for i, t in enumerate(texts):
        groups.setdefault(normal(t), []).append(i)
    got = {r["doc_id"]: r for r in exact_dedup.exact_groups(documents).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        g = groups[normal(t)]
        assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (min(g), len(g), i == min(g))
    kept = exact_dedup.drop_exact(documents)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(min(g) for g in groups.values())
    assert kept.columns == documents.columns


@pytest.mark.parametrize("limit", [600, 5_000, 1 << 30])
def test_trie_with_spill(limit):
    rng = random.Random(limit)
    keys = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))) for _ in range(500)]
    keys += [b"shared prefix " * 20 + k for k in keys] + [b"", b"x" * 5000, b"x" * 5000]
    want: dict = {}
    trie = exact_dedup.PatriciaOwners(limit)
    for i, k in enumerate(keys):
        owner = None if i % 11 == 0 else i
        trie.add(k, owner)
        low, n = want.get(k, (None, 0))
        want[k] = (owner if low is None else low if owner is None else min(low, owner), n + 1)
    got = list(trie.items())
    assert len(got) == len(want)
    assert {k: (o, n) for k, o, n in got} == want


def test_common_prefix():
    assert [exact_dedup.common_prefix(a, b) for a, b in ((b"", b"a"), (b"abc", b"abd"), (b"abc", b"abc"), (b"abcd", b"ab"))] == [0, 2, 3, 2]


def test_exact_odd_rows(empty, clashing):
    assert exact_dedup.exact_groups(empty).count() == 0
    got = sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_groups(clashing).collect()), key=repr)
    assert got == [(3, 3, 4, True), (7, 3, 4, False), (7, 3, 4, False), (7, 7, 1, True), (None, 3, 4, False)]
    assert exact_dedup.drop_exact(clashing).count() == 2


def test_exact_repeated_rows(spark):
    rows = [(7, "a  b", 1), (7, "a b", 2), (7, "a b", 2), (9, "a b", 3), (7, "c", 4), (None, "d", 5), (None, "d", 6), (None, "a b", 7)]
    df = spark.createDataFrame([(*r, {"k": r[0]}) for r in rows], "doc_id long, text string, text_sha256 int, key map<string,long>")
    got = exact_dedup.drop_exact(df)
    assert got.columns == df.columns
    kept = got.collect()
    assert sorted(((r["doc_id"], normal(r["text"])) for r in kept), key=repr) == sorted([(7, "a b"), (7, "c"), (None, "d")], key=repr)
    assert all((r["doc_id"], r["text"], r["text_sha256"]) in rows and r["key"] == {"k": r["doc_id"]} for r in kept)
    assert sorted(got.collect(), key=repr) == sorted(exact_dedup.drop_exact(df.repartition(3)).collect(), key=repr)
    with pytest.raises(TypeError, match="whole number"):
        exact_dedup.drop_exact(df.selectExpr("cast(doc_id as string) as doc_id", "text"))


def brute(texts, words, percent):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return [(len(s), root(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 80), (1, 50), (2, 100)])
def test_jaccard_equals_all_pairs(documents, texts, words, percent):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(documents, words, percent).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, words, percent)


def test_jaccard_hot_groups(spark, monkeypatch):
    """Many near copies of two texts that share a passage, in batches in which shingles count as frequent."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for g in "ab":
        body = [f"{g}{i}" for i in range(90)]
        for _ in range(90):
            w = body + passage
            for _ in range(rng.randrange(5)):
                w[rng.randrange(len(w))] = f"e{rng.random()}"
            texts.append(" ".join(w))
    texts += [" ".join([f"{k}{i}" for i in range(30)] + passage) for k in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 4, 85)


def test_jaccard_odd_rows(empty, clashing):
    assert jaccard.jaccard_components(empty).count() == 0
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(clashing).collect()), key=repr)
    assert got == [(3, 2, 3), (7, 0, 7), (7, 2, 3), (7, 2, 3), (None, 2, 3)]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 141))
    assert all(got[k] == 7 for k in range(200, 260))
    assert 5 not in got


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_jaccard_of_shuffled_input(spark, parts):
    """Counts near the mark from which a batch calls a shingle frequent, in rows that a shuffle dealt."""
    rng = random.Random(6)
    body = [f"c{i}" for i in range(200)]
    texts = [" ".join(body[:k] + [f"x{k}"] + body[k:]) for k in range(130)]
    texts += [" ".join(f"o{rng.randrange(10**6)}" for _ in range(30)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 4, 85)


@pytest.mark.parametrize("bytes_", [200, 1 << 14])
def test_jaccard_in_many_ranges(documents, texts, monkeypatch, bytes_):
    """The number of ranges follows from the shingles; no result depends on it."""
    monkeypatch.setattr(jaccard, "_RANGE_BYTES", bytes_)
    shingles = sum(n for n, _ in brute(texts, 4, 85))
    assert shingles * 8 / bytes_ < 1 << jaccard.range_bits(documents.sparkSession, shingles)
    if bytes_ > 200:
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(documents).collect()}
        assert [got[i] for i in range(len(texts))] == brute(texts, 4, 85)


@pytest.mark.parametrize("limit", [4500, 5500])
def test_jaccard_batches_cut_by_bytes(spark, limit):
    """Batches that end by bytes hold other rows with the id column than without it; no link may depend on that."""
    body = " ".join(f"w{i}" for i in range(16))
    texts = [f"{body} e{i:03}" for i in range(260)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, limit)
    try:
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df).collect()}
    finally:
        spark.conf.set(key, old)
    assert [got[i] for i in range(len(texts))] == brute(texts, 4, 85)


def test_jaccard_shingle_in_every_part(spark, monkeypatch):
    """A passage that a few texts of every part hold: no batch finds it frequent, the count over the table does."""
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(12))
    own = [" ".join(f"o{rng.randrange(10**6)}" for _ in range(30)) for _ in range(400)]
    texts = [f"{t} {passage}" for t in own] + [f"{t} more {passage}" for t in own[:150]] + [f"{passage} {passage} e{i % 7}" for i in range(90)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(12)
    most = {}
    for seen in (40, 10**6):
        monkeypatch.setattr(jaccard, "_SHARE", 1)
        monkeypatch.setattr(jaccard, "_SEEN", seen)
        documents = jaccard.text_sets(df, 4, "doc_id", "text")
        shared = jaccard.shared_shingles(df, 4, "text", 4, jaccard.hot_shingles(documents, 4))
        most[seen] = shared.where("hash IS NOT NULL").groupBy("hash").count().agg({"count": "max"}).first()[0]
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df).collect()}
        assert [got[i] for i in range(len(texts))] == brute(texts, 4, 85)
    assert most[40] < 40 < 500 < most[10**6]


def test_jaccard_hot_list_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "_SEEN", 2)
    monkeypatch.setattr(jaccard, "_MOST", 8)
    rows = [(k, [k, *range(100, 140)]) for k in range(10)] + [(0, [0, *range(100, 140)])] * 50 + [(99, None)]
    documents = spark.createDataFrame(rows, "name long, counted array<long>")
    assert len(jaccard.hot_shingles(documents, 8)) == 0  # 40 shingles of 10 sets each: more than 8 of them can't be held
    monkeypatch.setattr(jaccard, "_MOST", 64)
    assert jaccard.hot_shingles(documents, 8).tolist() == list(range(100, 140))


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_prefix_pairs_of_all_sizes(spark, percent):
    """Sets that contain each other, so sizes alone decide, also at the very threshold; the join finds every pair."""
    texts = [" ".join(f"w{i}" for i in range(n)) for n in range(1, 61)] + [" ".join(f"w{i}" for i in range(n)) + " x" for n in range(1, 41, 3)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    documents = jaccard.text_sets(df, 1, "doc_id", "text")
    sets = jaccard.prefixes(jaccard.shared_shingles(df, 1, "text", 4, jaccard.hot_shingles(documents, 4)), percent)
    none = spark.createDataFrame([], "node long, component long")
    ids = {r["name"]: r["doc_id"] for r in documents.withColumnRenamed("id", "doc_id").collect()}
    got = {tuple(sorted((ids[r["a"]], ids[r["b"]]))) for r in jaccard.verified(jaccard.prefix_pairs(sets, none, percent), sets, percent).collect()}
    words = [set(t.split()) for t in texts]
    assert got == {(i, j) for j, b in enumerate(words) for i, a in enumerate(words[:j]) if 100 * len(a & b) >= percent * len(a | b)}
