import hashlib
import math
import random
import re
import struct
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from segloom.llm import lm, media, quality, queries, secrets, url_filter


# --- media


def test_media_round_trip(documents, texts):
    rows = media.media_features(media.store_media(documents), payload=True).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        data = (t or "").encode()
        held = data.ljust(max(1, -(-len(data) // 64)) * 64, b"\0")
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"]) == (len(data), len(held))
        assert r["payload_sha256"] == hashlib.sha256(held).hexdigest()
        assert r["tail_crc32"] == zlib.crc32(held[-64:])
        assert r["width"] % 8 == r["height"] % 8 == 0


def bits_of(symbols):
    s = "".join(symbols)
    data = int(s + "1" * (-len(s) % 8), 2).to_bytes(-(-len(s) // 8))
    return data.replace(b"\xff", b"\xff\0")


def jpeg(width, height, scan, components=((1, 0x11, 0),), restart=0, q=16):
    """A file with the tables: DC sizes 0 to 3 as 00 01 10 110, AC end 0, run 0 size 1 10, run 1 size 2 110, sixteen zeros 1110."""
    dc = bytes([0, 3, 1] + [0] * 13) + bytes([0, 1, 2, 3])
    ac = bytes([1, 1, 1, 1] + [0] * 12) + bytes([0x00, 0x01, 0x12, 0xF0])
    seg = media._segment
    out = b"\xff\xd8" + seg(0xDB, b"\0" + bytes([q] * 64)) + seg(0xC0, struct.pack(">BHHB", 8, height, width, len(components)) + b"".join(bytes(c) for c in components))
    out += seg(0xC4, b"\0" + dc) + seg(0xC4, b"\x10" + ac)
    if restart:
        out += seg(0xDD, struct.pack(">H", restart))
    return out + seg(0xDA, bytes([len(components)]) + b"".join(bytes([c[0], 0]) for c in components) + b"\0\x3f\0") + scan + b"\xff\xd9"


def test_foreign_jpegs():
    # two blocks: DC 3 then -1 more; AC: one coefficient, a run of one, sixteen zeros, end
    first = ["10", "11", "10", "1", "110", "10", "1110", "0"]
    second = ["01", "0", "0"]
    grey = media.decode_many([jpeg(16, 8, bits_of(first + second))])[0]
    blocks = grey["blocks"][:, 0]
    assert blocks[:, 0].tolist() == [3, 2]
    assert (blocks[0, 1], blocks[0, 3], np.count_nonzero(blocks)) == (1, 2, 4)
    assert media.thumbnail(grey).tolist() == [[128 + 6, 128 + 4]]
    # the same with a restart between them: the second block's difference counts from zero
    parts = media.decode_many([jpeg(16, 8, bits_of(first) + b"\xff\xd0" + bits_of(second), restart=1)])[0]
    assert parts["blocks"][:, 0, 0].tolist() == [3, -1]
    # colour, luminance twice as wide: per MCU two luminance blocks, then the others
    mcu = ["01", "1", "0"] * 2 + ["00", "0"] + ["00", "0"]
    colour = media.decode_many([jpeg(16, 8, bits_of(mcu), components=((1, 0x21, 0), (2, 0x11, 0), (3, 0x11, 0)))])[0]
    assert media.thumbnail(colour).tolist() == [[128 + 2, 128 + 4]]


def test_broken_files(spark):
    good = media.encode_many([b"text"])[0]
    files = [None, b"", b"no", good[:50], good.replace(b"\xff\xc0", b"\xff\xc2"), good[:-20] + b"\xff\xd9", good]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(files)], "doc_id long, media binary")
    got = {r["doc_id"]: r for r in media.media_features(df, payload=True).collect()}
    assert [got[i]["width"] for i in range(5)] == [None] * 5
    assert got[6]["n_bytes"] == 4
    assert (got[2]["media_bytes"], got[0]["media_bytes"]) == (2, None)


# --- secrets


def token():
    body = b"abcdefghijABCDEFGHIJ0123456789"
    return b"ghp_" + body + secrets.base62_crc(body)


KIND = [
    ("assign", re.compile(r"""((?i:(?a:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def base_spans(text):
    return sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(KIND) for m in p.finditer(text) if ok(m))


SECRETS = [
    'PassWord = "hunter2" token:abc secret : s3cr3t== api_key=\'A/b+c_9\'', "é" * 5 + "apikey=abcdef " + "AKIA" + "Z" * 15 + " AKIA" + "Q" * 16, "passwordpassword=abcdef tokentoken = zzzzzz",
    "0123456789abcdef" * 3 + "g" + "a" * 23 + "G" + "b" * 24, "ſecret=abcdef toKen=abcdef", "secret=secret=secret1", "token=token=12", token().decode() + " " + token().decode()[:-1] + "x",
    "4111111111111111 4111111111111112", "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxIn0.c2ln eyJub3BlIjoxfQ.a.b", "-----BEGIN RSA PRIVATE KEY-----",
]


def test_base_spans_equal_plain_search(spark, documents, texts):
    df = documents.union(spark.createDataFrame([(1000 + i, t, "en", "s", 0) for i, t in enumerate(SECRETS)], documents.schema))
    all_ = dict(enumerate(texts)) | {1000 + i: t for i, t in enumerate(SECRETS)}
    for r in secrets.find_secrets(df).collect():
        want = base_spans(all_[r["doc_id"]] or "")
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == n for _, k, _ in want) for n in range(3)]
        joined = ",".join(f"{KIND[k][0]}:{a}:{z}" for a, k, z in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s.split(":")[0] in ("assign", "access", "hex")] == [s for s in joined.split(",") if s]


def test_checksums():
    kinds = lambda t: [secrets.KINDS[k] for _, k, _ in secrets.scan(t.encode())]
    assert kinds(SECRETS[7]) == ["checked"]
    assert kinds(SECRETS[8]) == ["card"]
    assert kinds(SECRETS[9]) == ["jwt"]
    assert kinds(SECRETS[10]) == ["key"]


def test_redaction(spark, clashing):
    text = "é token=abcdef and " + "a" * 30
    assert secrets.redact(text, secrets.scan(text.encode())) == "é [assign] and [hex]"
    df = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    assert secrets.redact_secrets(df).collect() == [(1, "é [assign] and [hex]"), (2, None)]
    assert secrets.redact_secrets(clashing).columns == clashing.columns


def test_hostile_headers():
    """Deeply nested headers are no tokens; runs of marks take time in proportion to their length."""
    import base64

    deep = base64.urlsafe_b64encode(b'{"a":' + b"[" * 200_000).rstrip(b"=")
    assert secrets.scan(b"eyJ" + deep[3:] + b".eyJx.sig") == []
    began = time.process_time()
    for bomb in (b"eyJ", b"eyJ.", b"token", b"password = ", b"AKIA", b"-----BEGIN ", b"ghp_", b"0123456789abcdef"):
        secrets.scan(bomb * 60_000)
    assert time.process_time() - began < 8
    header = base64.urlsafe_b64encode(b'{"alg":"HS256"}').rstrip(b"=")
    text = b"eyJeyJ eyJa.eyJb " + header + b".eyJx.sig"
    assert secrets.spans_text([s for s in secrets.scan(text) if s[1] == 4]) == f"jwt:17:{len(text)}"


def test_secrets_odd_rows(empty, clashing):
    assert secrets.find_secrets(empty).count() == 0
    rows = secrets.find_secrets(clashing).collect()
    assert len(rows) == 5 and all(r["n_hex"] == 0 and r["spans"] == "" for r in rows)


# --- urls


def test_host_path_and_rule(spark):
    urls = {"http://WWW.Example.org/es/1?x#y": ("www.example.org", "/es/1", "example.org/es/"), "https://example.org/en/12": ("example.org", "/en/12", "example.org/en/1"), "x://a.org": ("a.org", "", None),
            "http://corg/": ("corg", "/", None), "http://a.com/fr/?": ("a.com", "/fr/", "com/fr/"), "http://é.org/\n": ("é.org", "/\n", "org/"), "no scheme": ("", "", None), None: ("", "", None), "a://b://c/d": ("b:", "//c/d", None)}
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = sorted(url_filter.judge_urls(df).collect())
    assert [(r["host"], r["path"], r["rule"]) for r in got] == list(urls.values())
    assert [r["verdict"] for r in got[:2]] == ["block", "block"]
    assert all(r["verdict"] in ("allow", "block") for r in got)


def test_viterbi_equals_all_splits():
    counts, total = {"the": 50, "then": 20, "end": 30, "en": 5, "d": 2, "hend": 1}, 500
    name = "thend"

    def cost(w):
        return math.log(counts[w]) - math.log(total + 1) if w in counts else -math.log(total + 1) - len(w) * math.log(10)

    best = max(([name[a:b] for a, b in zip((0, *cuts), (*cuts, 5), strict=True)] for cuts in ([c for k, c in enumerate(range(1, 5)) if m >> k & 1] for m in range(16))), key=lambda ws: sum(map(cost, ws)))
    edges = [(a, b - a, counts[name[a:b]]) for a in range(5) for b in range(a + 1, 6) if name[a:b] in counts]
    assert url_filter.viterbi(name, edges, total) == best


def test_classifier_learns_from_rules(spark):
    pages = [(i, f"http://good{i}.example.org/aa/{i}", "<p>good bad news</p>") for i in range(30)] + [(100 + i, f"http://bad{i}.example.com/de/zz", "x") for i in range(30)]
    pages += [(200, "http://goodnews.net/aa/5", None), (201, "http://bad.net/zz", ""), (202, None, None)]
    got = {r["page_id"]: r for r in url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert (got[200]["verdict"], got[201]["verdict"]) == ("allow", "block")
    assert got[200]["host_words"].split()[:2] == ["good", "news"]
    assert len(got) == 63


def test_verdicts_equal_plain_naive_bayes(spark):
    """Odds, verdicts and scores of all pages, recomputed with dictionaries."""
    rng = random.Random(4)
    stems = ["good", "news", "bad", "spam", "shop", "web"]
    pages = []
    for i in range(220):
        host = "".join(rng.choice(stems) for _ in range(2)) + rng.choice([".example.org", ".com", ".net", ".org"])
        path = rng.choice(["/fr/", "/de/", "/es/", "/en/1", "/x/"]) + rng.choice(stems) + rng.choice(["", "/12", "-77x"])
        pages.append((i, f"http://{host}{path}", f"<p>{rng.choice(stems)} {rng.choice(stems)}<script>x</script></p>" if i % 3 else None))
    pages += [(1000, None, ""), (1001, "no", None), (0, pages[0][1], None)]
    got = url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert len(got) == len(pages)

    def tokens(r):
        parts = re.findall("[a-z]+|[0-9]+", r["path"].lower())
        return [*r["host_words"].split(), *("/" + (f"#{len(t)}" if t.isdigit() else t) for t in parts)]

    good, bad, ups, downs = Counter(), Counter(), 0, 0
    for r in got:
        if r["rule"] is not None:
            up = dict((text, verdict) for verdict, text in url_filter.RULES)[r["rule"]] == "allow"
            (good if up else bad).update(tokens(r))
            ups, downs = ups + up, downs + (not up)
    known = set(good) | set(bad)
    assert ups and downs and sum(r["rule"] is None for r in got) > 20
    kinds = set()
    for r in got:
        s = math.log((ups + 1) / (downs + 1))
        for t in tokens(r):
            if t in known:
                s += math.log((good[t] + 1) / (sum(good.values()) + len(known) + 1)) - math.log((bad[t] + 1) / (sum(bad.values()) + len(known) + 1))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-s)), rel=1e-6)
        if r["rule"] is None:
            kinds.add(r["verdict"])
            assert r["verdict"] == ("allow" if s >= 0 else "block")
    assert kinds == {"allow", "block"}


def test_visible_text():
    old = re.compile(rb"<(?:script|style)\b.*?</(?:script|style)>|<[^>]*>", re.I | re.S)
    rng = random.Random(1)
    parts = [b"<script>", b"</SCRIPT>", b"<style a>", b"</style>", b"<", b">", b"text ", b"<b>", b"scripted", b"<scripty>", b"x<y"]
    for _ in range(2000):
        html = b"".join(rng.choice(parts) for _ in range(rng.randrange(9)))
        assert url_filter.visible(html).split() == old.sub(b" ", html).lower().split()
    began = time.process_time()
    for bomb in (b"<script", b"<", b"<script>"):
        url_filter.visible(bomb * 200_000)
    assert time.process_time() - began < 5


def test_urls_odd_rows(spark):
    names = ["host", "path", "rule", "verdict", "score", "words", "token", "odds", "id"]
    long = "http://" + "ab" * 400 + ".net/" + "c" * 3000
    rows = [(7, long, "<p>ab " * 50_000), (7, long, None), (None, None, None), (None, "http://x.com/de/", "")]
    df = spark.createDataFrame([(*r, *names) for r in rows], f"page_id long, url string, html string, {', '.join(f'{n} string' for n in names)}")
    got = url_filter.judge_urls(df).collect()
    assert sorted((str(r["page_id"]), r["rule"] or "") for r in got) == [("7", ""), ("7", ""), ("None", ""), ("None", "com/de/")]
    assert len({(r["host"], r["verdict"], r["score"]) for r in got if r["page_id"] == 7}) == 1


def test_no_pages(spark):
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- language model


def test_lm_base_scores(documents, texts):
    rows = lm.score_documents(documents, head=40, words=30).collect()
    train, n = Counter(), 0
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 7 != 2:
            train.update((t or "").encode().lower().split())
            n += 1
    total, distinct = sum(train.values()) + n, len(train) + 1
    assert len(rows) == len(texts)
    for r in rows:
        words = (texts[r["doc_id"]] or "").encode().lower().split()
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words) + 1, sum(train[w] > 0 for w in words) + 1, total)
        base = sum(math.log10((train[w] + 1) / (total + distinct + 1)) for w in words) + math.log10((n + 1) / (total + distinct + 1))
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0


def test_softmax_equals_a_plain_one():
    """Logs and gradients of the factored softmax against sums written out in 64 bits."""
    rng = np.random.default_rng(8)
    net = lm.Network.fresh(lm.Shape(30, 5, 6), np.arange(30, 0, -1) * 3, 5)
    net.p.update({k: rng.standard_normal(net.p[k].shape).astype(np.float32) for k in ("c", "cb", "o", "ob")})
    h, y = rng.uniform(-1, 1, (400, 6)).astype(np.float32), rng.integers(0, 30, 400)
    grads = {k: np.zeros_like(v) for k, v in net.p.items()}
    logs, dh = net.log_probabilities(h, y, grads)
    want, wanted = np.zeros(400), {k: np.zeros(net.p[k].shape) for k in ("c", "cb", "o", "ob")}
    far = np.zeros((400, 6))
    for i, (state, word) in enumerate(zip(h.astype(np.float64), y.tolist(), strict=True)):
        k = int(net.class_of[word])
        a, b = int(net.bounds[k]), int(net.bounds[k + 1])
        for weights, bias, own, names, at in ((net.p["c"].T, net.p["cb"], k, ("c", "cb"), slice(None)), (net.p["o"][a:b], net.p["ob"][a:b], word - a, ("o", "ob"), slice(a, b))):
            e = np.exp(weights.astype(np.float64) @ state + bias)
            want[i] += np.log(e[own] / e.sum())
            d = e / e.sum() - (np.arange(len(e)) == own)
            far[i] += d @ weights
            outer = np.outer(d, state)
            wanted[names[0]][at] += outer.T if names[0] == "c" else outer
            wanted[names[1]][at] += d
    assert logs == pytest.approx(want, abs=1e-4) and dh == pytest.approx(far, abs=1e-4)
    assert net.log_probabilities(h, y)[0] == pytest.approx(want, abs=1e-4)
    for k, v in wanted.items():
        assert grads[k] == pytest.approx(v, abs=2e-3)


def test_softmax_of_classes_of_one_word():
    """Classes of one word beside larger ones: gradients against differences of the loss, in 64 bits."""
    rng = np.random.default_rng(4)
    net = lm.Network.fresh(lm.Shape(7, 3, 4), np.array([900, 400, 3, 2, 1, 1, 1]), 3)
    assert 1 in np.diff(net.bounds) and np.diff(net.bounds).max() > 1
    net.p = {k: v.astype(np.float64) + rng.standard_normal(v.shape) * 0.3 for k, v in net.p.items()}
    h, y = rng.uniform(-1, 1, (40, 4)), rng.integers(0, 6, 40)
    grads = {k: np.zeros_like(v) for k, v in net.p.items()}
    logs, dh = net.log_probabilities(h, y, grads)
    assert net.log_probabilities(h, y)[0] == pytest.approx(logs)
    for values, got in [(h, dh), *((net.p[k], grads[k]) for k in ("c", "cb", "o", "ob"))]:
        for i in np.ndindex(values.shape):
            old = values[i]
            sides = []
            for step in (1e-5, -1e-5):
                values[i] = old + step
                sides.append(-net.log_probabilities(h, y)[0].sum())
            values[i] = old
            assert got[i] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=1e-6)


def test_lm_gradients_and_learning():
    rng = np.random.default_rng(0)
    net = lm.Network.fresh(lm.Shape(30, 5, 6), np.arange(30, 0, -1) * 3, 5)
    net.p = {k: v.astype(np.float64) + rng.standard_normal(v.shape) * 0.1 for k, v in net.p.items()}
    x, y, h = rng.integers(0, 30, (7, 4)), rng.integers(0, 30, (7, 4)), np.zeros((4, 6))
    grads, _, _ = net.gradients(x, y, np.zeros((7, 4), bool), h)

    def loss():
        hs, _ = net.states(x, h)
        return -net.log_probabilities(hs.reshape(-1, 6).astype(np.float64), y.ravel())[0].sum() / y.size

    for k, v in net.p.items():
        i = tuple(rng.integers(0, s) for s in v.shape)
        old = v[i]
        v[i] = old + 1e-3
        up = loss()
        v[i] = old - 1e-3
        down = loss()
        v[i] = old
        assert grads[k][i] == pytest.approx((up - down) / 2e-3, abs=1e-6)
    sizes = net.bounds
    every = np.arange(30)
    state = np.tile(rng.standard_normal((1, 6)), (30, 1))
    assert np.exp(net.log_probabilities(state, every)[0]).sum() == pytest.approx(1)
    assert sizes[0] == 0
    ids = np.tile([2, 3, 4, 5, 0], 4000)
    start = lm.Network.fresh(lm.Shape(30, 5, 6), np.ones(30), 5)
    trainer = lm.Trainer(start, streams=16, steps=10, rate=0.02)
    trainer.train(ids)
    text = [np.array([2, 3, 4, 5, 0])]
    assert lm.score_texts(trainer.net, text)[0] > lm.score_texts(start, text)[0] + 5


@pytest.mark.parametrize("copies", [1, 5])
def test_lm_learns_from_every_document(spark, copies):
    """Words that stand in one document each: the embedding of each has had a gradient, however many copies are trained."""
    texts = spark.createDataFrame([(i, False, i, f"v{i} v{i} v{i}".encode()) for i in range(40)], "id long, held_out boolean, key long, text binary").withColumn("row", F.xxhash64("id"))
    counts = lm.corpus_counts(texts.select("text"), 100)
    ids, by_id, others = lm._vocabulary(counts, 100)
    encoded = lm.encode_documents(texts, counts, ids, math.log10(others))
    assert {r[0] for r in encoded.select(F.pmod(F.xxhash64("row"), F.lit(8))).distinct().collect()} == set(range(8))
    fresh = lm.Network.fresh(lm.Shape(len(by_id)), by_id, 4)
    net = lm.train_rounds(encoded.select("row", "ids"), counts.tokens, fresh, 8, -(-counts.tokens // (8 * copies)), 100)
    moved = (net.p["embed"] != fresh.p["embed"]).any(1)
    assert moved[2:].sum() == 40
    trainer = lm.Trainer(fresh, streams=16, steps=10)
    trainer.train(np.tile(np.array([2, 3, 4, 5, 0], np.int32), 401))
    assert trainer.tokens == 2005


@pytest.mark.parametrize("head", [1, 5, 20, 10_000])
def test_lm_head_is_bounded_whatever_the_counts(spark, head):
    rng = np.random.default_rng(head)
    counts = [*rng.integers(1, 9, 300).tolist(), *rng.integers(1, 10**12, 300).tolist(), *[101_000] * 10, 1, 10**17]
    words = spark.createDataFrame([(f"w{i}".encode(), n) for i, n in enumerate(counts)], "word binary, n long")
    least = lm.least_count(words, head)
    assert sum(n >= least for n in counts) <= head
    assert least == 1 or sum(n >= least - 1 for n in counts) > head
    assert lm.least_count(words.limit(0), head) == 1


def test_lm_scores_do_not_depend_on_partitions(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60")
    got = [{r["doc_id"]: r["score"] for r in lm.score_documents(rows.repartition(k), copy_tokens=2000, words=200, classes=8).collect()} for k in (1, 3, 7)]
    assert got[0] == pytest.approx(got[1], rel=1e-6)
    assert got[0] == pytest.approx(got[2], rel=1e-6)


def test_lm_copies_are_averaged_by_tokens(spark):
    """A round equals the plain mean of separately trained networks, weighted by their tokens."""
    net = lm.Network.fresh(lm.Shape(50), np.ones(50), 4)
    rng = np.random.default_rng(5)
    arrays = {i: np.append(rng.integers(1, 50, 40 + 9 * i), 0).astype(np.uint16) for i in range(12)}
    rows = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in arrays.items()], "row long, ids binary")
    placed = rows.select("row", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(3)).alias("p")).collect()
    total, tokens = np.zeros(len(net.flat())), 0
    for p in {r["p"] for r in placed}:
        trainer = lm.Trainer(net)
        trainer.train(np.concatenate([arrays[r["row"]].astype(np.int32) for r in placed if r["p"] == p]))
        total += trainer.net.flat().astype(np.float64) * trainer.tokens
        tokens += trainer.tokens
    assert lm.average_round(rows, net, 3).flat() == pytest.approx(total / tokens, abs=2e-3)


def test_lm_scores_equal_plain_loops(documents, texts, monkeypatch):
    """Each score recomputed word by word in plain Python from the network that was used."""
    held = {}

    def perturbed(training, tokens, net, *_):
        rng = np.random.default_rng(2)
        held["net"] = lm.Network(net.shape, net.bounds, {k: (v + 0.3 * rng.standard_normal(v.shape)).astype(np.float32) for k, v in net.p.items()})
        return held["net"]

    monkeypatch.setattr(lm, "train_rounds", perturbed)
    rows = {r["doc_id"]: r["score"] for r in lm.score_documents(documents, head=60, words=30, classes=5).collect()}
    net = held["net"]
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    train = Counter()
    ends = 0
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 7 != 2:
            train.update((t or "").encode().lower().split())
            ends += 1
    known = sorted(((w, c) for w, c in train.items() if len(w) <= 64), key=lambda x: (-x[1], x[0]))
    levels = Counter(c for _, c in known)
    size = max((sum(n for c, n in levels.items() if c >= least) for least in levels if sum(n for c, n in levels.items() if c >= least) <= 60), default=0)
    vocabulary = {w: i + 2 for i, (w, _) in enumerate(known[: min(28, size)])}
    others = sum(c for w, c in train.items() if w not in vocabulary) + sum(w not in vocabulary for w in train) + 1

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    n = net.shape.hidden
    for i in (0, 3, 4, 6, 12, 13, 20, 31, 40, 55):
        h, last, total = np.zeros(n), 0, 0.0
        for w in [*(texts[i] or "").encode().lower().split(), None]:
            x = p["embed"][last] @ p["wx"] + p["b"]
            u = h @ p["wh"]
            z, r = sigmoid(x[:n] + u[:n]), sigmoid(x[n : 2 * n] + u[n : 2 * n])
            h = (1 - z) * np.tanh(x[2 * n :] + r * u[2 * n :]) + z * h
            y = 0 if w is None else vocabulary.get(w, 1)
            k = int(np.searchsorted(net.bounds, y, "right")) - 1
            one = h @ p["c"] + p["cb"]
            total += one[k] - np.log(np.exp(one).sum())
            a, b = net.bounds[k], net.bounds[k + 1]
            two = p["o"][a:b] @ h + p["ob"][a:b]
            total += two[y - a] - np.log(np.exp(two).sum())
            if y == 1:
                total += math.log((train[w] + 1) / others)
            last = y
        assert rows[i] == pytest.approx(total / math.log(10), rel=1e-3)


def test_lm_windows_carry_the_state():
    rng = np.random.default_rng(1)
    net = lm.Network.fresh(lm.Shape(20, 4, 5), np.ones(20), 4)
    texts = [np.append(rng.integers(1, 20, n), 0) for n in (0, 1, 5, 33, 64, 200)]
    whole = lm.score_texts(net, texts, window=10_000)
    for window in (1, 7, 64):
        assert lm.score_texts(net, texts, window) == pytest.approx(whole, rel=1e-4)


def test_lm_long_texts_meet_the_softmax_in_few_windows(monkeypatch):
    """The work of a call is not spent on a handful of positions where few texts are left."""
    rng = np.random.default_rng(3)
    net = lm.Network.fresh(lm.Shape(20, 4, 5), np.ones(20), 4)
    texts = [np.append(rng.integers(1, 20, n), 0) for n in (20_000, 90, 30, 0)]
    whole, plain, sizes = lm.score_texts(net, texts), lm.Network.log_probabilities, []
    monkeypatch.setattr(lm.Network, "log_probabilities", lambda self, h, y, *a: (sizes.append(len(y)), plain(self, h, y, *a))[1])
    assert lm.score_texts(net, texts) == pytest.approx(whole)
    assert sum(sizes) == sum(map(len, texts)) and len(sizes) <= 20
    alone = [lm.score_texts(net, [t])[0] for t in texts]
    assert whole == pytest.approx(alone, rel=1e-4)


def test_lm_words_are_those_of_split():
    texts = [b"", b"  A b\x0b\x0cB\r\n", b" ", "\u00c4\u00e4 \u00a0x\x1c\x00y\u2003Z".encode(), b"a", b"\t"]
    for column in (pa.array(texts, pa.binary()), pa.array([b"zz", *texts], pa.binary()).slice(1), pa.array(texts, pa.large_binary())):
        row, code, words = lm._words(column)
        got = [[] for _ in texts]
        for r, w in zip(row.tolist(), code.tolist(), strict=True):
            got[r].append(words[w].as_py())
        assert got == [t.lower().split() for t in texts]
    assert [len(x) for x in lm._words(pa.array([b"", b" "], pa.binary()))[:2]] == [0, 0]


def test_lm_odd_rows(empty, clashing):
    assert lm.score_documents(empty).count() == 0
    rows = lm.score_documents(clashing, words=10).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"]) for r in rows) == [(False, None), (True, 3), (True, 7), (True, 7), (True, 7)]
    assert all(r["score"] < 0 and r["n_known"] <= r["n_tokens"] for r in rows)


# --- quality


def test_quality_held_out(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = queries.op10_quality(spark, sf).join(labels, "doc_id").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in scored)
    held = [r for r in scored if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.9 * len(held)
    assert docs.count() == queries.op10_quality(spark, sf).count()


def test_quality_scores_recomputed(spark, sf):
    """Scores from the fitted numbers by plain loops; the slope is that of the greatest likelihood."""
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.fit_quality(docs, labels)
    got = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, model).collect()}
    for r in docs.limit(50).collect():
        x = quality.features((r["text"] or "").encode())
        raw = sum(max(-8.0, min(8.0, (v - m) / s)) * w for v, m, s, w in zip(x, model.mean, model.scale, model.weights, strict=True))
        assert got[r["doc_id"]] == pytest.approx(1 / (1 + math.exp(-max(-30.0, min(30.0, model.slope * (raw - model.cut))))), rel=1e-9)
    rng = np.random.default_rng(3)
    margins = rng.normal(0, 2, 4000)
    good = (rng.random(4000) < 1 / (1 + np.exp(-1.7 * margins))).astype(int)
    assert quality.fit_slope(margins, good) == pytest.approx(1.7, rel=0.1)
    assert quality.fit_slope(np.array([1.0, -1.0]), np.array([1, 0])) == pytest.approx(20, rel=1e-3)


def test_quality_learns_from_one_row_an_id(spark):
    """An id that repeats without bound is one learning row; what is learnt does not depend on the order."""
    texts = {0: "a b c", 3: "x 1 2 3 !!", 6: "some more words here", 9: "!! ?? 1"}
    rows = [(i, t) for i, t in texts.items()] + [(0, f"copy {k}") for k in range(300)]
    labels = [(i, int(i % 2 == 0)) for i in texts] * 3
    one = quality.fit_quality(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int"))
    two = quality.fit_quality(spark.createDataFrame(rows[::-1], "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert one.mean == pytest.approx(two.mean) and one.weights == pytest.approx(two.weights)


def test_quality_without_labels(spark, documents, empty, clashing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit_quality(documents, none)
    assert {r["predicted"] for r in quality.score_quality(documents, model).collect()} == {1}
    assert quality.score_quality(empty, model).count() == 0
    bad = spark.createDataFrame([(i, 0) for i in range(20)], "doc_id long, quality int")
    assert quality.keep_good(clashing, quality.fit_quality(documents, bad)).count() == 0
    assert quality.score_quality(clashing, model).count() == 5


def test_media_odd_rows(clashing, empty):
    rows = media.media_features(media.store_media(clashing), payload=True).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == ["3", "7", "7", "7", "None"]
    assert sorted(r["n_bytes"] for r in rows) == [0, 24, 24, 24, 24]
    assert len({tuple(r)[1:] for r in rows}) == 2  # equal texts, equal values
    assert media.store_media(empty).collect() == []
    assert media.media_features(media.store_media(empty), payload=True).collect() == []
