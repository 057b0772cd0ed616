import hashlib
import json
import os
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from segloom.llm import bpe, packing, token_store


@pytest.fixture(scope="module")
def library(tokenizer):
    return Tokenizer.from_file(tokenizer)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def raw(ids):
    return np.array(ids, "<u4").tobytes()


def test_encode_and_decode_equal_the_library(spark, documents, texts, tokenizer, library):
    got = {r["doc_id"]: r for r in bpe.bpe_digests(documents, tokenizer).collect()}
    encoded = bpe.bpe_encode(documents, tokenizer)
    decoded = {r["doc_id"]: r["text"] for r in bpe.bpe_decode(encoded, tokenizer).collect()}
    for i, t in enumerate(texts):
        ids = ids_of(library, t)
        text = library.decode(ids, skip_special_tokens=False)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(raw(ids)).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert decoded[i] == text


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aAéÉΣσ' 's<|>\n\u0301"))))
def test_any_text(text):
    from segloom.llm.queries import tokenizer_path

    for make in (bpe.tree_encoder, bpe.library_encoder):
        got = np.frombuffer(next(make(tokenizer_path()).encode([text.encode()])), "<u4").tolist()
        assert got == ids_of(LIBRARY(), text)


_kept = []


def LIBRARY():
    from segloom.llm.queries import tokenizer_path

    if not _kept:
        _kept.append(Tokenizer.from_file(tokenizer_path()))
    return _kept[0]


def other_files(tokenizer, folder):
    """The contract's file without its normaliser, with another pre-tokenizer, and a byte-level one with a decoder."""
    with open(tokenizer) as f:
        spec = json.load(f)
    plain, digits = {**spec, "normalizer": None}, json.loads(json.dumps(spec))
    digits["pre_tokenizer"]["pretokenizers"].insert(0, {"type": "Digits", "individual_digits": False})
    for name, x in (("plain", plain), ("digits", digits)):
        with open(folder / name, "w") as f:
            json.dump(x, f)
    return [str(folder / "plain"), str(folder / "digits"), os.path.join(os.path.dirname(tokenizer), "byte_bpe_50k.json")]


def test_other_tokenizer_files_equal_the_library(spark, documents, tokenizer, texts, tmp_path):
    for path in other_files(tokenizer, tmp_path):
        own = Tokenizer.from_file(path)
        got = {r["doc_id"]: r for r in bpe.bpe_digests(documents, path).collect()}
        for i, t in enumerate([*texts[:40], "Hello World <|endoftext|> 12 x"]):
            ids = own.encode(t or "", add_special_tokens=False).ids
            for make in (bpe.tree_encoder, bpe.library_encoder):
                assert np.frombuffer(next(make(path).encode([(t or "").encode()])), "<u4").tolist() == ids
            if i in got and i < 40:
                assert got[i]["decoded_sha256"] == hashlib.sha256(own.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_unknown_models_are_refused(tokenizer, tmp_path):
    with open(tokenizer) as f:
        spec = json.load(f)
    spec["model"]["byte_fallback"] = True
    (tmp_path / "odd").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="byte_fallback"):
        bpe.Vocabulary(str(tmp_path / "odd"))


def test_decoding_any_number(spark, tokenizer, library):
    df = spark.createDataFrame([(1, [1_000_000, 320, -1, None, 321]), (2, None), (3, []), (4, [-5])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in bpe.bpe_decode(df, tokenizer).collect()} == {1: library.decode([320, 321], skip_special_tokens=False), 2: "", 3: "", 4: ""}


def test_one_encoder_a_worker(tokenizer):
    assert bpe.library_encoder(tokenizer) is bpe.library_encoder(tokenizer, 300_000)
    bpe.tree_encoder(tokenizer)
    assert len(bpe._held) == 1


def test_caches_stay_bounded(tokenizer, library):
    v = bpe.Vocabulary(tokenizer)
    cache = bpe.ChunkCache(v, library, v.merge, limit=50)
    rng = random.Random(1)
    text = [" ".join(str(rng.random()) for _ in range(40)).encode() for _ in range(40)]
    fresh = bpe.ChunkCache(v, library, v.merge)
    assert list(cache.encode(text)) == list(fresh.encode(text))
    assert len(cache.chunks) < 200


def test_first_fit_decreasing_equals_plain_search():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 50, 700):
        sizes = rng.integers(1, 101, n)
        bins, offsets = packing.first_fit_decreasing(sizes, 100)
        room: list[int] = []
        for i in np.argsort(-sizes, kind="stable"):
            b = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
            if b == len(room):
                room.append(100)
            assert (bins[i], offsets[i]) == (b, 100 - room[b])
            room[b] -= sizes[i]


@pytest.mark.parametrize("group_size", [2000, 7])
def test_packing_holds_every_id_once(spark, documents, texts, tokenizer, library, group_size):
    rows = packing.pack(documents, tokenizer, group_size=group_size).collect()
    pieces: dict = {}
    sequences: dict = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert len(pieces) == len(texts)
    for i, t in enumerate(texts):
        ids, at = [*ids_of(library, t), 1], 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at
            assert r["ids_crc32"] == zlib.crc32(raw(ids[at : at + r["length"]]))
            assert r["doc_tokens"] == len(ids)
            at += r["length"]
        assert at == len(ids)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048


def test_store_round_trip(spark, documents, texts, tokenizer, library, tmp_path):
    target = f"file://{tmp_path}/store"
    token_store.write_tokens(documents, target, tokenizer, shard_bytes=4000)
    got = sorted(token_store.read_tokens(spark, target).collect())
    at = 0
    for i, (r, t) in enumerate(zip(got, texts, strict=True)):
        ids = [*ids_of(library, t), 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(ids), zlib.crc32(raw(ids)))
        at += len(ids)
    shards = spark.read.parquet(f"{target}/shards").collect()
    assert sum(r["shard_tokens"] for r in shards) == at
    for r in shards:  # only the last frame may go beyond
        assert r["offsets"][-1] < 4000 and r["ids"] == sorted(r["ids"])
        assert (r["first_id"], r["last_id"]) == (r["ids"][0], r["ids"][-1])
    for i in (0, 5, 30, len(texts) - 1):
        assert token_store.fetch_tokens(spark, target, i).collect() == [(i, [*ids_of(library, texts[i]), 2])]
    assert token_store.fetch_tokens(spark, target, 10**9).count() == 0


def test_dictionary_sample_spans_the_table(spark, tokenizer):
    """Rows of all parts of the table are sampled, not those of its head; a shared id stays within the bound."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    data = token_store.train_dictionary(docs, tokenizer, 2, 1 << 20, 100, 50, "doc_id", "text", 2)
    ids = np.frombuffer(data, "<u2").tolist()
    texts = Tokenizer.from_file(tokenizer).decode(ids).replace("</w>", "").split("text")
    found = [int("".join(c for c in x if c.isdigit())) for x in texts if x.strip()]
    assert 50 < len(found) <= 200 and min(found) < 800 and max(found) > 3200
    same = docs.select(F.lit(7).alias("doc_id"), "text")
    assert len(token_store.train_dictionary(same, tokenizer, 2, 1 << 20, 100, 50, "doc_id", "text", 2)) <= 200 * 2 * 8


def test_packing_wastes_little(spark, sf, tokenizer):
    packed = packing.pack(spark.read.parquet(f"{sf}/documents.parquet"), tokenizer)
    total, sequences = packed.agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    assert total > 0.97 * 2048 * sequences or sequences - total / 2048 < 1


def test_rows_of_one_id_spread_over_groups(spark, tokenizer):
    docs = spark.range(300).select(F.lit(5).alias("doc_id"), F.lit("one text").alias("text"))
    groups = packing.pack(docs, tokenizer, group_size=30).groupBy((F.col("sequence_id") / (1 << 28)).cast("long")).count().collect()
    assert len(groups) == 10 and max(r["count"] for r in groups) < 60


def test_store_of_large_ids(spark, tokenizer, tmp_path):
    """Ids above 65,535 are kept whole."""
    with open(tokenizer) as f:
        spec = json.load(f)
    first = len(spec["model"]["vocab"])
    spec["added_tokens"] += [spec["added_tokens"][0] | {"id": i, "content": f"<extra{i}>"} for i in range(first + 2, 70_000)]
    path = tmp_path / "large.json"
    path.write_text(json.dumps(spec))
    assert token_store.id_width(tokenizer, 2) == 2
    assert token_store.id_width(tokenizer, 70_000) == token_store.id_width(str(path), 2) == 4
    target = f"file://{tmp_path}/store"
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    token_store.write_tokens(docs, target, tokenizer, end_id=70_000)
    assert [token_store.fetch_tokens(spark, target, i).first()["ids"][-1] for i in (1, 2)] == [70_000, 70_000]
    assert [r["n_tokens"] for r in token_store.read_tokens(spark, target).orderBy("start").collect()] == [3, 1]


def test_trained_dictionary_is_used(spark, tokenizer, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    target = f"file://{tmp_path}/store"
    token_store.write_tokens(docs, target, tokenizer, dictionary_bytes=4096)
    digest, data = token_store._load_dictionary(spark, target)
    assert data[:4] == b"\x37\xa4\x30\xec"  # the mark of a trained dictionary
    assert hashlib.sha256(data).hexdigest() == digest
    assert token_store.read_tokens(spark, target).count() == docs.count()


def test_empty_and_clashing(spark, empty, clashing, tokenizer, tmp_path):
    assert packing.pack(empty, tokenizer).count() == 0
    assert bpe.bpe_digests(empty, tokenizer).count() == 0
    token_store.write_tokens(empty, f"file://{tmp_path}/e", tokenizer)
    assert token_store.read_tokens(spark, f"file://{tmp_path}/e").count() == 0
    packed = packing.pack(clashing, tokenizer).collect()
    assert len(packed) == 5
    assert len({(r["sequence_id"], r["offset"]) for r in packed}) == 5
    token_store.write_tokens(clashing, f"file://{tmp_path}/c", tokenizer)
    got = token_store.read_tokens(spark, f"file://{tmp_path}/c").orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 3, 7, 7, 7]
    assert bpe.bpe_encode(clashing, tokenizer).count() == 5
