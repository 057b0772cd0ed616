"""Phrases whose words stand together far more often than their parts stand apart.

Method: mergeable Misra-Gries summaries. The contiguous phrases of 1, 2, 3 and 4 words are summarised in turn. Each map
task counts those of its chunk and deals the counts to partitions by ranges of the phrases' hashes; each partition
merges them into one summary whose capacity exceeds the partition's mass divided by the threshold (``SLACK`` times), so
every frequent phrase keeps a counter. A counter falls short by no more than the summary has taken off; one that can't
reach the threshold with that is dropped. What survives is a bit in a filter of fixed size, which prunes the next length: a phrase
is frequent only if both phrases of one word less are. A last pass over the texts counts what the filters let through
exactly, by its text, and keeps the frequent ones; neither a false survivor nor a shared hash can change a result.
There a task adds up its chunks before it hands over, so a phrase leaves it once and not once a chunk, and what it
hands to a partition travels as lists, not as a row a phrase.

The number of hash partitions follows the text's bytes, so a partition's summary stays small. A chunk sends a phrase
once whatever its count, so a phrase that a third of all rows repeat is no hot key.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, partitions, text_bytes

#: A-Z to a-z, and the signs that end a piece to one of them. Fixed values of the contract.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9)
_BREAK = b"."  # as a word of its own it can't occur: the fold takes every full stop

#: Words that a map task gathers before it counts, and bytes of text behind one hash partition.
CHUNK_WORDS, PARTITION_BYTES = 2_000_000, 8 << 20
#: Times the least capacity that a summary has: more counters, fewer taken off, so fewer phrases survive by chance.
SLACK = 4
_ROWS = 50_000
#: Phrases that a task of the exact count holds before it hands over, and phrases behind one of its partitions.
HELD, PARTITION_PHRASES = 1 << 20, 50_000


def words_and_breaks(text: bytes) -> list[bytes]:
    """The words in lower case, with a full stop where a piece ends."""
    return text.translate(_FOLD).replace(b"\n", b" . ").split()


class Summary:
    """Misra-Gries counters by 64-bit hash: of ``mass`` occurrences no count falls short by mass / (capacity + 1) or more."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        """Adds another summary's counters; over capacity, all give up the count of the first one that is too many."""
        self.hashes, place = np.unique(np.concatenate([self.hashes, hashes]), return_inverse=True)
        self.counts = np.bincount(place, np.concatenate([self.counts, counts]), len(self.hashes)).astype(np.int64)
        if len(self.counts) > self.capacity:
            over = len(self.counts) - self.capacity - 1
            off = np.partition(self.counts, over)[over]
            self.counts, self.lost = self.counts - off, self.lost + int(off)
            self.hashes, self.counts = self.hashes[self.counts > 0], self.counts[self.counts > 0]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class _Chunk:
    """The words of one language in some documents, as numbers; 0 where a piece or document ends."""

    def __init__(self, lang: str):
        self.lang, self.parts = lang, []
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)
        self.numbers[_BREAK]

    def add(self, text: bytes) -> int:
        ids = np.fromiter(map(self.numbers.__getitem__, words_and_breaks(text)), np.int64)
        self.parts += [ids, np.zeros(1, np.int64)]
        return len(ids)

    def phrases(self, longest: int, filters: list[np.ndarray], bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each length: (length, hashes, counts, a place of each) of its distinct phrases that the filters let through.

        A phrase is looked at only if both phrases of one word less passed. Phrases are told apart exactly, by the
        numbers of their words; hashes only name them to filters and partitions.
        """
        words = list(self.numbers)
        seed = zlib.crc32(self.lang.encode())
        word_hash = np.array([xxhash.xxh3_64_intdigest(w, seed) for w in words], np.uint64)
        counts = np.bincount(self.ids, minlength=len(words))
        at = np.zeros(len(words), np.int64)
        at[self.ids] = np.arange(len(self.ids))  # some place of each word
        counts[0] = 0  # the breaks
        found, starts, number = word_hash, np.arange(len(self.ids)), self.ids
        for n in range(1, longest + 1):
            if n > 1:
                both = alive[:-1] & alive[1:]
                starts = np.flatnonzero(both)
                key = own[starts] * len(words) + self.ids[starts + n - 1]
                order = np.argsort(key)
                ordered = key[order]
                edges = np.flatnonzero(np.concatenate([ordered[:1] >= 0, ordered[1:] != ordered[:-1]]))
                counts = np.diff(np.append(edges, len(ordered)))
                at = starts[order[edges]]
                found = _mixed(hashes[own[at]] * np.uint64(3) + word_hash[self.ids[at + n - 1]])
                if n < longest:
                    number = np.empty(len(order), np.int64)
                    number[order] = np.repeat(np.arange(len(edges)), counts)
            good = (passes(filters[n - 1], found, bits) if n <= len(filters) else np.ones(len(found), bool)) & (counts > 0)
            yield n, found[good], counts[good], at[good]
            if n == longest:
                return
            kept = good[number]
            alive, own, hashes = np.zeros(len(self.ids) - n + 1, bool), np.zeros(len(self.ids) - n + 1, np.int64), found
            alive[starts[kept]], own[starts[kept]] = True, number[kept]
            if n > len(self.ids) - 1:
                return

    def seal(self) -> None:
        self.ids = np.concatenate(self.parts)
        self.parts = []


def passes(bitmap: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Whether the bit of each hash, that of its first ``bits`` binary digits, is set."""
    at = hashes >> np.uint64(64 - bits)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _chunks(batches, chunk_words: int) -> Iterator[_Chunk]:
    """Columns lang and text of all batches, gathered by language."""
    open_: dict[str, _Chunk] = {}
    gathered = 0
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            if lang not in open_:
                open_[lang] = _Chunk(lang)
            gathered += open_[lang].add(text.as_py())
            if gathered >= chunk_words:
                for c in open_.values():
                    c.seal()
                    yield c
                open_.clear()
                gathered = 0
    for c in open_.values():
        c.seal()
        yield c


def _packed(hashes: np.ndarray) -> bytes:
    """The upper 48 bits of each hash; phrases that share them are told apart by the exact count only."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64, copy=False)


def _sums(tables: list[pa.Table]) -> pa.Table:
    """(phrase, a) with the counts of equal phrases added up."""
    if len(tables) == 1:
        return tables[0]
    return pa.TableGroupBy(pa.concat_tables(tables), "phrase", use_threads=False).aggregate([("a", "sum")]).rename_columns({"a_sum": "a"}).select(["phrase", "a"])


def counted(chunks, longest: int, filters: list[np.ndarray], bits: int, parts: int, held: int = HELD) -> Iterator[pa.RecordBatch]:
    """(part, lang, words, phrases, counts): counts of the phrases that the filters let through, and all words as the phrase of none.

    Chunks are added up; more than ``held`` different phrases are handed over and begun anew. A row lists the phrases
    of one length for one of ``parts`` partitions, dealt by a hash of their text: joined by line ends, which no word
    holds, beside 64-bit numbers.
    """
    kept: dict[tuple[str, int], pa.Table] = {}

    def out():
        for (lang, n), t in kept.items():
            phrases, counts = t.column("phrase").to_pylist(), t.column("a").to_numpy()
            part = np.fromiter(map(xxhash.xxh3_64_intdigest, phrases), np.uint64, len(phrases)) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order], prepend=part[order[:1]])).tolist()
            for i, j in zip([0, *cuts], [*cuts, len(order)], strict=True):
                for k in range(i, j, _ROWS):
                    some = order[k : min(k + _ROWS, j)]
                    columns = [[int(part[some[0]])], [lang], [n], [b"\n".join([phrases[x] for x in some.tolist()])], [counts[some].tobytes()]]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, (pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["part", "lang", "words", "phrases", "counts"])
        kept.clear()

    for chunk in chunks:
        words = list(chunk.numbers)
        found = [(0, [pa.table({"phrase": pa.array([b""]), "a": pa.array([int((chunk.ids > 0).sum())])})])]
        for n, _, counts, places in chunk.phrases(longest, filters, bits):
            tables = []
            for i in range(0, len(places), _ROWS):
                columns = [[words[w] for w in chunk.ids[places[i : i + _ROWS] + k]] for k in range(n)]
                tables.append(pa.table({"phrase": pa.array(map(b" ".join, zip(*columns, strict=True)), pa.binary()), "a": pa.array(counts[i : i + _ROWS], pa.int64())}))
            found.append((n, tables))
        for n, tables in found:
            if tables:
                before = [kept[chunk.lang, n]] if (chunk.lang, n) in kept else []
                kept[chunk.lang, n] = _sums(before + tables) if before else pa.concat_tables(tables)
        if sum(t.num_rows for t in kept.values()) > held:
            yield from out()
    yield from out()


def added_up(batches, least: int) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, words, a) from the lists of ``counted``: sums of ``least`` or more, and those of the phrase of none."""
    kept: dict[tuple[str, int], list[pa.Table]] = defaultdict(list)
    for b in batches:
        for lang, n, phrases, counts in zip(*(b.column(i).to_pylist() for i in range(1, 5)), strict=True):
            tables = kept[lang, n]
            tables.append(pa.table({"phrase": pa.array(phrases.split(b"\n"), pa.binary()), "a": pa.array(np.frombuffer(counts, np.int64))}))
            if sum(t.num_rows for t in tables[1:]) > max(tables[0].num_rows, _ROWS):
                tables[:] = [_sums(tables)]
    for (lang, n), tables in kept.items():
        t = _sums(tables)
        t = t.filter(pc.greater_equal(t.column("a"), least)) if n else t
        for b in t.to_batches(max_chunksize=_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(b)), b.column(0).cast(pa.string()), pa.array([n] * len(b), pa.int32()), b.column(1)], names=["lang", "phrase", "words", "a"])


def _opened(filters: list) -> list[np.ndarray]:
    return [np.frombuffer(zlib.decompress(f.value), np.uint8) for f in filters]


def _survivors(texts: DataFrame, n: int, filters: list, least: int, bits: int, parts: int, chunk_words: int) -> bytes:
    """The filter of length n, packed: a bit set for each phrase that keeps a counter. ``filters``: those of shorter ones, as broadcasts."""

    def summarise(batches):
        bitmaps = _opened(filters)
        for chunk in _chunks(batches, chunk_words):
            for m, hashes, counts, _ in chunk.phrases(n, bitmaps, bits):
                if m < n or not len(hashes):
                    continue
                order = np.argsort(hashes)
                hashes, counts = hashes[order], counts[order]
                part = ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
                present, at = np.unique(part, return_index=True)
                pieces = list(zip(at, [*at[1:], len(part)], strict=True))
                rows = [present, [_packed(hashes[i:j]) for i, j in pieces], [counts[i:j].tobytes() for i, j in pieces]]
                yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["part", "hashes", "counts"])

    def merge(table: pa.Table) -> pa.Table:
        counts = [np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist()]
        summary = Summary(SLACK * sum(int(c.sum()) for c in counts) // least + 1)
        room, waiting = 2 * summary.capacity + 100_000, []
        for h, c in zip(table.column("hashes").to_pylist(), counts, strict=True):
            waiting.append((_unpacked(h), c))
            if sum(len(x[1]) for x in waiting) > room:
                summary.merge(*map(np.concatenate, zip(*waiting, strict=True)))
                waiting.clear()
        if waiting:
            summary.merge(*map(np.concatenate, zip(*waiting, strict=True)))
        kept = summary.hashes[summary.counts + summary.lost >= least]
        return pa.table({"place": pa.array(np.unique(kept >> np.uint64(64 - bits)).astype(np.int64) + 1)})

    places = texts.mapInArrow(summarise, "part long, hashes binary, counts binary").groupBy("part").applyInArrow(merge, "place long")
    maps = places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    bitmap = np.zeros(max(1 << bits >> 3, 4096), np.uint8)
    for r in maps.collect():  # 2 ** bits bits at most, whatever the input
        bitmap[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return zlib.compress(bitmap.tobytes(), 1)


def frequent_phrases(df: DataFrame, least: int = 30, longest: int = 4, text_col: str = "text", lang_col: str = "lang", filter_bits: int = 26, chunk_words: int = CHUNK_WORDS, partition_bytes: int = PARTITION_BYTES) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, a), (lang, n)): contiguous phrases of up to ``longest`` words with their counts, and all words.

    Only phrases of at least ``least`` occurrences within pieces in their language are returned, all of them and exactly.
    ``filter_bits`` (15 or more) sets the size of each filter, 2 ** filter_bits bits, which is broadcast; a full filter
    prunes less but loses nothing. Null texts count as empty, a null language as ``und``; repeated rows count each.
    An empty table gives no rows.
    """
    spark = df.sparkSession
    texts = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_bytes(text_col).alias("text"))
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    filters: list = []
    for n in range(1, longest + 1):
        filters.append(spark.sparkContext.broadcast(_survivors(texts, n, filters, least, filter_bits, size // partition_bytes + 1, chunk_words)))

    # survivors, as far as the filters tell them apart; beyond that the parts follow the text
    survivors = sum(int(np.bitwise_count(f).sum()) for f in _opened(filters))
    parts = max(survivors // PARTITION_PHRASES, size // (16 * partition_bytes)) + 1

    def exact(batches):
        yield from counted(_chunks(batches, chunk_words), longest, _opened(filters), filter_bits, parts)

    lists = texts.mapInArrow(exact, "part long, lang string, words int, phrases binary, counts binary").repartition(parts, "part")
    stored = materialize(lists.mapInArrow(lambda batches: added_up(batches, least), "lang string, phrase string, words int, a long"), "phrases")
    for f in filters:
        f.destroy()
    return stored.where("words > 0"), stored.where("words = 0").select("lang", F.col("a").alias("n"))


def _part(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(df: DataFrame, least: int = 30, longest: int = 4, percent: int = 80, top: int = 2000, text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """The ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    The score is floor(2000000 a / (l + r)) at the cut into parts of l and r occurrences that makes it lowest, of equal
    ones the first; 1000000 is that of a phrase whose parts occur nowhere else. A phrase inside a longer candidate that has ``percent`` of its occurrences is dropped. Order: score, a
    (both descending), phrase by bytes. Counts multiply as decimals, so nothing overflows. Odd rows: see
    ``frequent_phrases``.
    """
    phrases, totals = frequent_phrases(df, least, longest, text_col, lang_col, **options)
    candidates = phrases.where("words > 1").withColumn("each", F.split("phrase", " "))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    sides = F.explode(F.array(F.struct(F.lit("l").alias("side"), _part(F.col("each"), F.lit(1), F.col("k")).alias("part")), F.struct(F.lit("r").alias("side"), _part(F.col("each"), F.col("k") + 1, F.col("words") - F.col("k")).alias("part"))))
    parts = cuts.select("lang", "phrase", "a", "k", sides.alias("s")).select("lang", "phrase", "a", "k", "s.side", "s.part")
    counted = parts.join(phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")), ["lang", "part"])

    def of(k: int, side: str) -> Column:
        return F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("f"))).alias(f"{side}{k}")

    wide = counted.groupBy("lang", "phrase", "a").agg(*(of(k, s) for k in range(1, longest) for s in "lr"))
    score = [F.expr(f"(cast(a as decimal(20, 0)) * 2000000) div (cast(l{k} as decimal(20, 0)) + r{k})") for k in range(1, longest)]
    possible = [F.when(s.isNotNull(), F.struct(s.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k, s in enumerate(score, 1)]
    scored = wide.withColumn("best", F.array_min(F.array_compact(F.array(*possible)))).select("lang", "phrase", "a", "best.l", "best.r", "best.score")

    longer = candidates.where("words > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = longer.withColumn("s", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1))).select("lang", _part(F.col("each"), F.col("s"), F.col("m")).alias("phrase"), "a")
    outer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("outer"))
    mostly_inside = F.col("outer").cast("decimal(20, 0)") * 100 >= F.col("a").cast("decimal(20, 0)") * percent
    kept = scored.join(outer, ["lang", "phrase"], "left").where(F.col("outer").isNull() | ~mostly_inside)

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(partitions(df.sparkSession)))).orderBy(*order)
    first = kept.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)  # so no task sorts a whole language
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
