"""Licence scan and collocations against brute force, and their SQL."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import assert_same, connect

from segloom.llm import collocations as c
from segloom.llm import licenses as lic
from segloom.llm import queries as q

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", ["op11_license_scan", "op12_collocations"])
def test_query_equals_sql(spark, sf, name):
    assert_same(q.QUERIES[name](spark, sf), connect(sf), q.ORACLES[name])


# --- licences


def licensed(rng):
    filler = "alpha Beta gamma, the of license under mit software a to public".split()
    out = [None, "", "mit", "Under the MIT License", "under the mit; LICENSE under the mit license under the mit license", "cc-by-nc 4.0 CC BY\x00NC", "apache license version 2.0"]
    for label_words in [t.words for t in lic.templates()]:
        for lost in (0, 1, 2, 3, 8):
            w = list(label_words)
            for _ in range(min(lost, len(w) - 1)):
                w.pop(rng.randrange(len(w)))
            rng.shuffle(w) if lost == 2 else None
            out.append(" ".join([rng.choice(filler) for _ in range(rng.randrange(90))] + w + [rng.choice(filler) for _ in range(rng.randrange(90))]))
    out += [" ".join(rng.choice(filler) for _ in range(3000)), "x" * 5000, "Ünder the mit lİcense", "under the mit license " * 40]
    return out


def expected_licenses(text, known, percent):
    words = re.findall(lic.WORD, (text or "").translate(FOLD))
    places, base, labels, score = [], set(), set(), 0.0
    for t in known:
        own = set(t.words)
        for at in range(0, len(words), 32):
            block = words[at : at + 64]
            if t.phrase:
                here = [at + i for i in range(32) if tuple(block[i : i + len(t.words)]) == t.words]
                places += here
                base |= {t.label} if here else set()
                found = 1.0 if here else 0.0
            else:
                shared = len(own & set(block))
                found = shared / len(own) if 100 * shared >= percent * len(own) else 0.0
            labels |= {t.label} if found else set()
            score = max(score, found)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


@pytest.mark.parametrize("percent", [80, 55, 100])
def test_licenses_equal_brute_force(spark, percent):
    texts = licensed(random.Random(percent))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in lic.scan_licenses(df, percent=percent).collect()}
    assert got == {i: expected_licenses(t, lic.templates(), percent) for i, t in enumerate(texts)}
    assert {"mit", "apache-2", "gpl-3", "bsd"} <= {x for r in got.values() for x in r[5].split(",")}


def test_license_words_equal_plain_search(spark, texts):
    """Places of phrases in the whole text, without any blocks."""
    plain = ["".join(random.Random(i).choice(["under ", "the ", "mit ", "license ", "cc ", "by ", "nc "]) for _ in range(300)) for i in range(6)] + texts
    df = spark.createDataFrame(list(enumerate(plain)), "doc_id long, text string")
    for r in lic.scan_licenses(df).collect():
        words = re.findall(lic.WORD, (plain[r["doc_id"]] or "").translate(FOLD))
        places = [i for _, p in lic.PHRASES for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        assert (r["n_base"], r["first_word"], r["last_word"]) == (len(places), min(places, default=None), max(places, default=None))


def test_license_blocks(spark):
    df = spark.createDataFrame([(5, "w " * 70 + "Released under the MIT License.")], "doc_id long, text string")
    rows = lic.license_blocks(df).collect()
    assert [(r["doc_id"], r["label"], r["places"]) for r in rows if r["places"]] == [(5, "mit", [71])]


def test_license_odd_rows(clashing, empty):
    rows = lic.scan_licenses(clashing).collect()
    assert len(rows) == 5 and sorted(r["n_words"] for r in rows) == [0, 5, 5, 5, 5]
    assert lic.scan_licenses(empty).collect() == []
    with pytest.raises(ValueError):
        lic.scan_licenses(empty, [lic.Template("long", ("w",) * 40)])


# --- collocations


def expected_collocations(rows, least, longest, percent, top):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = lang or "und"
        n[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            if any(len(z) > len(p) and 100 * b >= percent * a and any(z[i : i + len(p)] == p for i in range(len(z))) for z, b in cand.items()):
                continue
            score, _, left, right = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def phrases_of(rng, n):
    vocabulary = ["the", "The", "of", "new", "york", "city", "é", "ÉA", ".", "\n", "\x0b", "\t", "a\x00b", "\x1cx", "日本"] + [f"w{i}" for i in range(40)]
    return [(rng.choice(["en", "de", None, "und"]), " ".join(rng.choice(vocabulary) if rng.random() < 0.7 else "New York City, hall" for _ in range(rng.randrange(60)))) for _ in range(n)]


@pytest.mark.parametrize("chunk_words,partition_bytes,bits", [(2_000_000, 8 << 20, 27), (200, 1500, 15)])
def test_collocations_equal_brute_force(spark, chunk_words, partition_bytes, bits):
    rows = phrases_of(random.Random(bits), 250) + [("en", None), (None, ""), ("fr", "x x x x x x x x"), ("fr", "a b" * 4000)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = c.collocations(df, least=4, top=25, chunk_words=chunk_words, partition_bytes=partition_bytes, filter_bits=bits).collect()
    assert sorted(map(tuple, got)) == expected_collocations(rows, 4, 4, 80, 25)


def test_full_filters_change_nothing(spark):
    rows = phrases_of(random.Random(9), 120)
    df = spark.createDataFrame(rows, "lang string, text string")
    phrases, totals = c.frequent_phrases(df, least=1, filter_bits=15)
    assert phrases.where("a < 1").count() == 0
    want = expected_collocations(rows, 1, 4, 80, 10**9)
    assert sorted(map(tuple, c.collocations(df, least=1, top=10**6, filter_bits=15).collect())) == want
    assert {r["lang"]: r["n"] for r in totals.collect()} == {w[0]: w[6] for w in want}


def test_summary_keeps_frequent_ones():
    rng = np.random.default_rng(1)
    for _ in range(30):
        stream = np.concatenate([np.repeat(np.arange(5, dtype=np.uint64), 30), rng.integers(100, 1000, 5000).astype(np.uint64)])
        rng.shuffle(stream)
        s = c.Summary(len(stream) // 30 + 1)
        for part in np.array_split(stream, 17):
            s.merge(*np.unique(part, return_counts=True))
            assert len(s.counts) <= s.capacity
        assert set(range(5)) <= set(s.hashes.tolist())
        held = dict(zip(s.hashes.tolist(), s.counts.tolist(), strict=True))
        assert s.lost < 30
        for h, n in zip(*np.unique(stream, return_counts=True), strict=True):
            assert n - s.lost <= held.get(int(h), 0) <= n


def test_a_task_hands_over_a_phrase_once():
    """The rows of the exact count follow the different phrases of a task, not its chunks."""
    rows = phrases_of(random.Random(4), 200)
    batch = pa.RecordBatch.from_arrays([pa.array([lang or "und" for lang, _ in rows]), pa.array([t.encode() for _, t in rows])], names=["lang", "text"])
    want = Counter()
    chunks = list(c._chunks([batch], 100))
    for chunk in chunks:
        words = list(chunk.numbers)
        want[chunk.lang, "", 0] += int((chunk.ids > 0).sum())
        for n, _, counts, places in chunk.phrases(3, [], 15):
            for a, at in zip(counts, places, strict=True):
                want[chunk.lang, b" ".join(words[w] for w in chunk.ids[at : at + n]).decode(), n] += int(a)
    assert len(chunks) > 50
    lists = list(c.counted(chunks, 3, [], 15, 4))
    held = [(r["lang"], p.decode(), r["words"]) for b in lists for r in b.to_pylist() for p in r["phrases"].split(b"\n")]
    assert len(held) == len(set(held)) == len(want)
    assert len(lists) <= 4 * len({x[::2] for x in held})
    for batches in (lists, c.counted(chunks, 3, [], 15, 4, held=300)):
        got = [tuple(r.values()) for b in c.added_up(batches, 3) for r in b.to_pylist()]
        assert len(got) == len({r[:3] for r in got}) and {r[:3]: r[3] for r in got} == {k: v for k, v in want.items() if v >= 3 or not k[2]}


def test_packed_hashes_keep_48_bits():
    hashes = np.random.default_rng(5).integers(0, 2**64, 1000, np.uint64)
    assert (c._unpacked(c._packed(hashes)) == hashes >> np.uint64(16) << np.uint64(16)).all() and len(c._packed(hashes)) == 6000
    assert len(c._unpacked(b"")) == 0


def test_large_counts_do_not_overflow(spark):
    big = 10**16
    df = spark.createDataFrame([(big, big + 3, big + 10**12)], "a long, l1 long, r1 long")
    row = df.selectExpr("(cast(a as decimal(20, 0)) * 2000000) div (cast(l1 as decimal(20, 0)) + r1) as s").first()
    assert row["s"] == 2000000 * big // (2 * big + 3 + 10**12)


def test_collocations_odd_rows(spark, clashing, empty):
    df = clashing.selectExpr("*", "cast(null as string) as lang")
    assert [tuple(r)[:4] for r in c.collocations(df, least=4, top=3).collect()] == [("und", 1, "same text here and", 4), ("und", 2, "text here and there", 4)]
    assert c.collocations(empty).collect() == []
