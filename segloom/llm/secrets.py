"""Secrets in texts.

Method: an Aho-Corasick automaton over the keywords goes once over each text; regular expressions, anchored at
a keyword, run only there; candidates that carry a checksum are kept only if it is right. Runs of hex digits
have no keyword of letters: the text is mapped to one class byte, in which 24 class bytes are the keyword.

All work is on UTF-8 bytes (every pattern is ASCII); places are turned into code points at the end. One narrow
stage: nothing is shuffled or broadcast.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import re
import zlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes

#: Kinds in the order in which equal starts are listed; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "checked", "jwt", "card", "key")

_ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_CHECKED = re.compile(rb"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
_JWT = re.compile(rb"(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)")
_RUN = re.compile(rb"[A-Za-z0-9_-]*")
_KEY = re.compile(rb"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")
_CARD = re.compile(rb"[0-9]{13,19}(?![0-9])")
_DIGITS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_HEX = bytes(120 if c in b"0123456789abcdef" else 46 for c in range(256))
_NUMBER = bytes(120 if c in b"0123456789" else 46 for c in range(256))

#: Keyword in lower case to its kind.
_KEYWORDS = {w: "assign" for w in ("password", "passwd", "secret", "token", "apikey", "api_key")} | {"akia": "access", "eyj": "jwt", "-----begin ": "key"} | {w: "checked" for w in ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")}


@functools.cache
def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for word, kind in _KEYWORDS.items():
        a.add_word(word, (len(word), kind))
    a.make_automaton()
    return a


def base62_crc(data: bytes) -> bytes:
    """The six characters that end a token: crc32 of what comes before in base 62, filled with zeros."""
    n, out = zlib.crc32(data), bytearray()
    while n:
        n, r = divmod(n, 62)
        out.append(_DIGITS[r])
    return bytes(out[::-1]).rjust(6, b"0")


def luhn(digits: bytes) -> bool:
    odd = digits[-1::-2]
    even = digits[-2::-2]
    return (sum(c - 48 for c in odd) + sum(sum(divmod(2 * (c - 48), 10)) for c in even)) % 10 == 0


def is_jwt(header: bytes) -> bool:
    """The first part decodes to a JSON object that names an algorithm."""
    try:
        found = json.loads(base64.urlsafe_b64decode(header + b"=" * (-len(header) % 4)))
    except (ValueError, RecursionError):  # a header may be nested as deep as its writer likes
        return False
    return isinstance(found, dict) and "alg" in found


def _valid(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m[2]) >= 6
    if kind == "access":
        return len(m[0]) >= 20
    if kind == "checked":
        return base62_crc(m[1]) == m[2]
    return kind != "jwt" or is_jwt(m[1])


_PATTERNS = {"assign": _ASSIGN, "access": _ACCESS, "checked": _CHECKED, "jwt": _JWT, "key": _KEY}


def _runs(mapped: bytes, least: int):
    """Maximal runs of the class byte of at least that length."""
    word, at = b"x" * least, 0
    while (at := mapped.find(word, at)) >= 0:
        end = mapped.find(b".", at)
        end = len(mapped) if end < 0 else end
        yield at, end
        at = end


def scan(text: bytes) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) in code points, sorted; leftmost and non-overlapping for each kind."""
    found: list[tuple[int, int, int]] = []
    low = text.lower()  # bytes: ASCII letters only, so places stay
    ends = dict.fromkeys(_PATTERNS, 0)
    hits = sorted({(end - size + 1, kind) for end, (size, kind) in _automaton().iter(low.decode("latin-1"))})
    for start, kind in hits:
        if start >= ends[kind] and (m := _PATTERNS[kind].match(text, start)):
            ends[kind] = m.end()
            if _valid(kind, m):
                found.append((start, KINDS.index(kind), m.end()))
        elif kind == "jwt" and start >= ends[kind]:
            ends[kind] = _RUN.match(text, start).end()  # what fails here fails from every place in this run
    found += [(a, 2, z) for a, z in _runs(text.translate(_HEX), 24)]
    for a, z in _runs(text.translate(_NUMBER), 13):
        if z - a <= 19 and _CARD.match(text, a) and luhn(text[a:z]):
            found.append((a, KINDS.index("card"), z))
    found.sort()
    if not found or text.isascii():
        return found
    points = {}
    at = n = 0
    for x in sorted({x for a, _, z in found for x in (a, z)}):
        n += len(text[at:x].decode("utf-8", "replace"))
        points[x], at = n, x
    return [(points[a], k, points[z]) for a, k, z in found]


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in spans)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span (overlapping ones merged) replaced by ``[kind]`` of the first."""
    out, at = [], 0
    for a, k, z in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k]}]"]
        at = max(at, z)
    return "".join([*out, text[at:]])


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of each whole text.

    A null text counts as empty and has no span (the hash is that of the empty text). Repeated rows give
    repeated results; other columns are ignored; an empty table gives no rows.
    """

    def run(batches):
        names = ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
        for b in batches:
            counts, digests, texts = ([], [], []), [], []
            for text in b.column(1).to_pylist():
                spans = scan(text)
                base = [s for s in spans if s[1] < 3]
                for k, c in enumerate(counts):
                    c.append(sum(s[1] == k for s in base))
                digests.append(hashlib.sha256(spans_text(base).encode()).hexdigest())
                texts.append(spans_text(spans))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(texts, pa.string())], names=names)

    source = df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    kind = df.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string").withColumnRenamed("id", id_col)


def redact_secrets(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with secrets in the text replaced by their kind; null texts stay null, other columns as they are."""

    def run(batches):
        for b in batches:
            at = b.schema.get_field_index(text_col)
            texts = [x if x is None else redact(x, scan(x.encode())) for x in b.column(at).to_pylist()]
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))

    return df.mapInArrow(run, df.schema)
