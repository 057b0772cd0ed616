"""BPE encoding and decoding.

Method: a segment tree over the ranks of adjacent pairs. The root holds the lowest rank; going down to the
left whenever the left half holds it yields the leftmost such pair. A merge changes at most three leaves,
each updated in logarithmic time, until no pair can be merged.

The vocabulary file is a parameter and is read, never trained. Words repeat, so each Python worker keeps the
ids of white-space separated chunks in a bounded cache; a chunk's ids do not depend on what surrounds it. That and the
rebuilt cutting of texts hold for one normaliser and pre-tokenizer only (``REBUILT``); with any other file the library
normalises and cuts whole texts, and the cache keeps pieces.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import text_bytes

_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
_ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
_NONE = 1 << 60
#: Entries of each cache of a Python worker, about 250 bytes each; twice as many are held at most.
CACHE_ENTRIES = 300_000


def byte_alphabet() -> list[str]:
    """A printable character for each byte: itself where it is printable, else the next from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


_ALPHABET = byte_alphabet()

#: The normaliser and pre-tokenizer that ``pieces`` rebuilds, as a tokenizer file states them.
REBUILT = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)
_MODEL_OPTIONS = ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
_TOKEN_OPTIONS = ("single_word", "lstrip", "rstrip", "normalized")


def pieces(text: str) -> list[str]:
    """Normalised text (NFC, lower case) cut into words, digits and runs of signs, in the byte alphabet."""
    if text.isascii():
        found = _ASCII_PIECES.findall(text.lower())
        if text.isprintable():  # the alphabet maps printable ASCII, space aside, to itself
            return found
    else:
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # else lower() looks at the neighbours
        found = _PIECES.findall(text.lower())
    return ["".join([_ALPHABET[b] for b in p.encode()]) for p in found]


class Vocabulary:
    """The vocabulary, merges and special tokens of a tokenizer file in JSON.

    A model that isn't BPE or whose options or special tokens the encoder doesn't know is refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        odd = [o for o in _MODEL_OPTIONS if model.get(o)] + [o for t in spec["added_tokens"] for o in _TOKEN_OPTIONS if t.get(o)]
        if model.get("type", "BPE") != "BPE" or odd:
            raise ValueError(f"{path}: only plain BPE is encoded, not {model.get('type')} with {sorted(set(odd))}")
        self.rebuilt: bool = (spec.get("normalizer"), spec.get("pre_tokenizer")) == REBUILT
        self.decoder: bool = spec.get("decoder") is not None
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.specials: dict[str, int] = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.ids[a], self.ids[b]] = (rank, self.ids[a + b])
        self.tokens: list[bytes | None] = [None] * (max([*self.ids.values(), *self.specials.values()]) + 1)
        for t, i in [*self.ids.items(), *self.specials.items()]:
            self.tokens[i] = t.encode()
        self.split_specials = re.compile("|".join(sorted(map(re.escape, self.specials), key=len, reverse=True))) if self.specials else None

    def merge(self, word: str) -> list[int]:
        """The ids of one piece: merges by the segment tree."""
        if not word:
            return []
        symbols = [*word[:-1], word[-1] + self.end]
        ids = [self.ids[s] for s in symbols if s in self.ids]
        n = len(ids)
        if n < 2:
            return ids
        merges = self.merges.get
        size = 1 << (n - 2).bit_length() if n > 2 else 1
        tree = [_NONE] * (2 * size)
        for i in range(n - 1):
            if m := merges((ids[i], ids[i + 1])):
                tree[size + i] = m[0]
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a <= b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(i: int, rank: int) -> None:
            k = size + i
            if tree[k] == rank:
                return
            tree[k] = rank
            k >>= 1
            while k:
                a, b = tree[2 * k], tree[2 * k + 1]
                low = a if a <= b else b
                if tree[k] == low:
                    return
                tree[k] = low
                k >>= 1

        while (low := tree[1]) != _NONE:
            k = 1
            while k < size:
                k *= 2
                if tree[k] != low:
                    k += 1
            i = k - size
            j = after[i]
            ids[i] = merges((ids[i], ids[j]))[1]
            ids[j] = -1
            after[i] = nxt = after[j]
            if j < n - 1:
                put(j, _NONE)
            if nxt < n:
                before[nxt] = i
                m = merges((ids[i], ids[nxt]))
                put(i, m[0] if m else _NONE)
            else:
                put(i, _NONE)
            if (p := before[i]) >= 0:
                m = merges((ids[p], ids[i]))
                put(p, m[0] if m else _NONE)
        return [x for x in ids if x >= 0]

    def decode(self, ids: list[int]) -> bytes:
        """Token strings joined by a space, as a tokenizer file without a decoder asks for; numbers of no token are left out."""
        n = len(self.tokens)
        found = [self.tokens[i] for i in ids if 0 <= i < n]
        return b" ".join([t for t in found if t is not None] if None in found else found)


class ChunkCache:
    """Ids of white-space separated chunks, as bytes of unsigned 32-bit little-endian numbers.

    Splitting at ASCII white space changes no id: no piece, composition or special token spans it. Each of
    the two levels keeps at most twice ``limit`` entries, of which the older half goes when the newer is
    full, so memory stays bounded on any corpus.
    """

    def __init__(self, vocabulary: Vocabulary, library: Tokenizer, merge, limit: int = CACHE_ENTRIES):
        self.vocabulary, self.library, self.merge, self.limit = vocabulary, library, merge, limit
        self.chunks: dict[bytes, bytes] = {}
        self.words: dict[str | bytes, bytes] = {}  # by piece, or by the UTF-8 of a lower-cased Latin word
        self.old_chunks: dict[bytes, bytes] = {}
        self.old_words: dict[str | bytes, bytes] = {}

    def _word(self, word: str | bytes) -> bytes:
        if (ids := self.words.get(word)) is None:
            if (ids := self.old_words.get(word)) is None:
                piece = word if isinstance(word, str) else "".join([_ALPHABET[b] for b in word])
                ids = array("I", self.merge(piece)).tobytes()
            if len(word) <= 64:
                self.words[word] = ids
        return ids

    def _latin(self, text: str) -> bytes | None:
        """The ids of one run of composed Latin letters, a single piece that NFC leaves alone; else None."""
        if text.isalpha() and max(text) < "\u0250" and (low := text.lower()).isalpha():
            return self._word(low.encode())
        return None

    def _text(self, text: str) -> bytes:
        if not text.isprintable() and any(unicodedata.category(c) == "Cn" for c in text):
            # signs of a later Unicode than Python's: only the library knows its own classes of them
            found = [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]
        else:
            found = pieces(text)
        return b"".join([self._word(p) for p in found])

    def _library_text(self, text: str) -> bytes:
        """The ids of a text that the library normalises and cuts."""
        clean = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        cut = self.library.pre_tokenizer.pre_tokenize_str(clean) if self.library.pre_tokenizer else [(clean, None)]
        return b"".join([self._word(p) for p, _ in cut if p])

    def decode(self, ids: list[int]) -> bytes:
        """The text of some ids as the file's decoder has it; numbers of no token are left out."""
        if not self.vocabulary.decoder:
            return self.vocabulary.decode(ids)
        tokens = self.vocabulary.tokens
        return self.library.decode([i for i in ids if 0 <= i < len(tokens) and tokens[i] is not None], skip_special_tokens=False).encode()

    def _apart(self, text: str, encode) -> bytes:
        """Special tokens by their ids, what lies between by ``encode``."""
        v, at, out = self.vocabulary, 0, []
        for m in v.split_specials.finditer(text) if v.split_specials else ():
            out += [encode(text[at : m.start()]), v.specials[m[0]].to_bytes(4, "little")]
            at = m.end()
        return b"".join([*out, encode(text[at:])])

    def _chunk(self, chunk: bytes) -> bytes:
        if chunk.isalpha():  # ASCII letters only
            return self._word(chunk.lower().decode())
        if chunk[-1] in b".,!:;" and chunk[:-1].isalpha():
            return self._word(chunk[:-1].lower().decode()) + self._word(chr(chunk[-1]))
        text, v = chunk.decode("utf-8", "replace"), self.vocabulary
        if not chunk.isascii():
            if (ids := self._latin(text)) is not None:
                return ids
            if text[-1] in ".,!:;" and (ids := self._latin(text[:-1])) is not None:
                return ids + self._word(text[-1])
        if b"<" not in chunk or not v.split_specials:
            return self._text(text)
        return self._apart(text, self._text)

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        for text in texts:
            if len(self.chunks) > self.limit:
                self.chunks, self.old_chunks = {}, self.chunks
            if len(self.words) > self.limit:
                self.words, self.old_words = {}, self.words
            if not self.vocabulary.rebuilt:
                yield self._apart(text.decode("utf-8", "replace"), self._library_text)
                continue
            chunks, old = self.chunks, self.old_chunks
            words = text.split()
            found, i = list(map(chunks.get, words)), -1
            while True:
                try:
                    i = found.index(None, i + 1)
                except ValueError:
                    break
                w = words[i]
                if (ids := chunks.get(w)) is None:
                    if (ids := old.get(w)) is None:
                        ids = self._chunk(w)
                    if len(w) <= 64:
                        chunks[w] = ids
                found[i] = ids
            yield b"".join(found)


_held: dict[tuple[str, bool], ChunkCache] = {}


def _encoder(path: str, tree: bool, entries: int) -> ChunkCache:
    """The encoder of a Python worker, which holds one at a time."""
    if (path, tree) not in _held:
        _held.clear()
        v, library = Vocabulary(path), Tokenizer.from_file(path)
        model = library.model
        _held[path, tree] = ChunkCache(v, library, v.merge if tree else lambda word: [t.id for t in model.tokenize(word)])
    _held[path, tree].limit = entries
    return _held[path, tree]


def tree_encoder(path: str) -> ChunkCache:
    """One encoder for each Python worker and file; merges by the segment tree."""
    return _encoder(path, True, CACHE_ENTRIES)


def library_encoder(path: str, entries: int = CACHE_ENTRIES) -> ChunkCache:
    """The same with the merges of the tokenizers library."""
    return _encoder(path, False, entries)


def bpe_encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of each row's whole text, by the segment tree.

    A null text counts as empty and has no ids; ids and rows may repeat or be null; other columns are ignored.
    """

    def run(batches):
        encoder = tree_encoder(path)
        for b in batches:
            ids = [memoryview(x).cast("I").tolist() for x in encoder.encode(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    source = df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    return source.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, ids array<int>").withColumnRenamed("id", id_col)


def bpe_decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) from ids; a null or empty array gives the empty text. Nulls and numbers of no token are left out."""

    def run(batches):
        encoder = tree_encoder(path)
        for b in batches:
            texts = [encoder.decode([i for i in x or () if i is not None]).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    source = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return source.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, text string").withColumnRenamed("id", id_col)


def bpe_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encodes and decodes in one pass, without the arrays.

    A null text counts as empty. One narrow stage: nothing is shuffled.
    """

    def run(batches):
        encoder = tree_encoder(path)
        decode = encoder.decode
        for b in batches:
            n, a, d = [], [], []
            for raw in encoder.encode(b.column(1).to_pylist()):
                n.append(len(raw) // 4)
                a.append(hashlib.sha256(raw).hexdigest())
                d.append(hashlib.sha256(decode(memoryview(raw).cast("I").tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    source = df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    kind = df.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
