import random

import pytest

ODD = [None, "", " \t\n", "a", "ΑΣ ΟΔΟΣ Σ", "áȩ İstanbul", "<|endoftext|>x<|startoftext|>", "it's 12345 ½²", "\x1c\x00 a b　c", "日本語 👩‍👩‍👧", "x" * 3000, "word " * 4000]


def prose(rng, n):
    return " ".join(rng.choice("the of and to in is it that for on with as".split()) + rng.choice(["", "x", "yz", "."]) + str(rng.randrange(60)) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Odd texts, prose, exact copies (also but for white space), near copies and a very long one."""
    rng = random.Random(3)
    base = [prose(rng, rng.randrange(1, 120)) for _ in range(60)]
    near = []
    for t in base[:20]:
        words = t.split()
        for _ in range(3):
            w = list(words)
            w[rng.randrange(len(w))] = "changed"
            near.append(" ".join(w))
    return [*ODD, *base, *base[:15], *(t.replace(" ", "\n ") for t in base[:5]), *near, prose(rng, 20_000)]


@pytest.fixture(scope="session")
def documents(spark, texts):
    rows = [(i, t, "en", f"s{i % 3}", len(t) if t is not None else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def clashing(spark):
    """Null and repeated ids, repeated rows, and columns named as the operators' own."""
    names = ["id", "key", "name", "n", "hash", "group", "salt", "part", "seq", "score", "kept", "start", "length", "component", "features", "sha256"]
    row = {"doc_id": 7, "text": "same text here and there", **{n: n for n in names}}
    rows = [row, row, {**row, "doc_id": None}, {**row, "doc_id": 3}, {**row, "doc_id": 7, "text": None}]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))


@pytest.fixture(scope="session")
def tokenizer():
    from segloom.llm.queries import tokenizer_path

    return tokenizer_path()
