"""Similarity join of texts on the Jaccard similarity of their word n-grams.

Method: adaptive multi-match prefixes. Shingles are ordered from rare to frequent. Two sets that overlap by
at least ``a`` share at least ``k`` shingles among the first ``n - a + k`` of each, so a document may lengthen
its prefix by ``k - 1`` if ``k`` shared shingles are then asked for before a pair is verified. Each document
takes the ``k`` of least estimated cost: entries scanned plus candidates verified.

1. Every task hashes the shingles of its documents in numpy and deals them, as packed arrays, by hash range.
   A task of such a range sees all occurrences and returns only shingles of two or more different sets. One
   that occurs in a single set can match nothing: it counts as the rarest and never travels again. Shingles that
   are frequent in a batch, or in the whole table by an exact count over one set in 4,096, need no such range:
   they are shared for sure and count as the most frequent. So no range grows with the table.
2. Sets of which too few shingles are shared for any link drop out; the rest get their ordered shingles.
3. Star links: sets with the same smallest (largest) shared shingle are compared with one hub, the set with
   the fewest shingles of its own. Groups of near copies thus become connected by a number of links in
   proportion to their size.
4. The prefix join looks only for links between different components of step 3, of which the largest on a
   shingle is not joined with itself; all of those are found, so no link that joins components is lost. Only
   sets of sizes that can match meet: the join's key is the shingle and a cell of the size's logarithm.

Equal sets are one node from the start, named by a 64-bit hash of the set; a shingle keeps 48 bits of its hash and
those of its range. Two of m different sets share a name with odds of about m * m / 2 ** 65.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, partitions, text_bytes
from .graphs import connected_components

_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20))
_LETTERS = _RNG.integers(1, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)
_LETTERS[65:91] = _LETTERS[97:123]  # A-Z count as a-z
_BASE = _U(0x9E3779B97F4A7C15) | _U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A set as ranges name it, and the bytes of shingles that a range should hold.
_SET = np.dtype([("name", "<i8"), ("n", "<i4")])
_RANGE_BYTES = 24 << 20
#: Occurrences in one batch from which a shingle is frequent: its sets are then not sent to a hash range.
_FREQUENT = 64
#: One set in ``_SHARE`` (by its name) is counted to find the shingles that are frequent in the whole table: those of
#: ``_SEEN`` counted sets, so of about 2 ** 20, or of more where there would be over ``_MOST`` of them. One of twice as many
#: sets is missed with odds of e ** -64. Which shingles count as frequent changes no result.
_SHARE, _SEEN, _MOST = 4096, 256, 1 << 22
_LAST = (1 << 31) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text.

    Words are runs without white space, A-Z as a-z. A text with fewer words than a shingle has its whole
    sequence as one; one without words has none.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    blank = _SPACE[data]
    solid = ~blank
    starts = np.flatnonzero(solid & np.concatenate([[True], blank[:-1]]))
    ends = np.flatnonzero(blank & np.concatenate([[False], solid[:-1]]))
    n = len(starts)
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(starts, bounds)  # the first word of each text
    if not n:
        return [np.zeros(0, _U)] * len(texts)
    # polynomial hash of a word: its letters' numbers against powers of the base from its own first letter
    place = np.arange(len(data)) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(data)]])))
    longest = int((ends - starts).max())
    powers = np.ones(longest + 1, _U)
    np.multiply.accumulate(np.concatenate([[_U(1)], np.full(longest, _BASE)]), out=powers)
    sums = np.concatenate([[_U(0)], np.cumsum(np.where(solid, _LETTERS[data] * powers[np.minimum(place, longest)], _U(0)), dtype=_U)])
    word = _mix(sums[ends] - sums[starts] + (ends - starts).astype(_U))
    run = np.zeros(n, _U)
    for k in range(words):  # the word at each place and the next ones; runs past a text's end are not used
        run = _mix(run * _U(3) + np.concatenate([word[k:], np.zeros(min(k, n), _U)]) + _U(k + 1))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(run[a : b - words + 1]))
        elif b > a:
            h = np.array([b - a], _U)
            for k in range(a, b):
                h = _mix(h * _U(5) + word[k : k + 1])
            out.append(h)
        else:
            out.append(np.zeros(0, _U))
    return out


def set_name(s: np.ndarray) -> int:
    """A 64-bit hash of a set of hashes, as a signed number."""
    h = _mix(_mix(s + _U(0x1234567)).sum(dtype=_U, keepdims=True) + np.array([len(s)], _U) * _BASE)
    return int(h.astype(np.int64)[0])


def _parts(texts: list[bytes], limit: int = 2 << 20):
    """Ranges of rows of about ``limit`` bytes. No result may depend on where they end: two passes may cut apart."""
    a, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield a, i
            a, size = i, 0
        size += len(t)
    if texts:
        yield a, len(texts)


def _batch(texts: list[bytes], words: int):
    """Sets, their names, the rows of different non-empty sets, and all their shingles sorted with the row of each."""
    sets = shingle_sets(texts, words)
    names = [set_name(s) for s in sets]
    once = list({name: i for i, name in reversed(list(enumerate(names))) if len(sets[i])}.values())
    if not once:
        return sets, names, once, np.zeros(0, _U), np.zeros(0, np.int64)
    hashes = np.concatenate([sets[i] for i in once])
    owner = np.repeat(np.arange(len(once)), [len(sets[i]) for i in once])
    order = np.argsort(hashes, kind="stable")
    return sets, names, once, hashes[order], owner[order]


def _frequent(hashes: np.ndarray, hot: np.ndarray, kept: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """(mask of occurrences of frequent shingles, those that only this batch knows as such).

    hot: sorted shingles, as ``kept`` bits, that every batch knows.
    """
    edges = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate([edges, [len(hashes)]]))
    often, known = counts > _FREQUENT, np.zeros(len(edges), bool)
    if len(hot):
        low = hashes[edges] & kept
        known = hot[np.minimum(np.searchsorted(hot, low), len(hot) - 1)] == low
    return np.repeat(often | known, counts), hashes[edges[often & ~known]]


def text_sets(df: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, name, counted array<long>): a row a document.

    ``counted``: the shingles of one set in ``_SHARE``, once a task; else null.
    """
    share = _SHARE

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            texts = b.column(1).to_pylist()
            for a, z in _parts(texts):
                sets = shingle_sets(texts[a:z], words)
                names = [set_name(s) for s in sets]
                counted = []
                for s, name in zip(sets, names, strict=True):
                    first = len(s) > 0 and name % share == 0 and name not in seen
                    if first:
                        seen.add(name)
                    counted.append(s.view(np.int64) if first else None)
                columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.int64()), pa.array(counted, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), *columns], names=["id", "n", "name", "counted"])

    source = df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    return source.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, n long, name long, counted array<long>")


def kept_bits(bits: int) -> np.uint64:
    """The bits that name a shingle: 48 low ones and those of the range, so they grow with the cluster."""
    return _U((1 << 48) - 1 | ((1 << bits) - 1) << (64 - bits))


def hot_shingles(documents: DataFrame, bits: int) -> np.ndarray:
    """The sorted ``kept_bits`` of shingles that are frequent in the whole table: at most ``_MOST``, so 32 MB."""
    counted = materialize(documents.where(F.col("counted").isNotNull()).dropDuplicates(["name"]).select("counted"), "counted")
    least = max(_SEEN, -(-(counted.agg(F.sum(F.size("counted"))).first()[0] or 0) // _MOST))
    shingle = F.col("hash").bitwiseAND(F.lit(int(kept_bits(bits).astype(np.int64))))
    counts = counted.select(F.explode("counted").alias("hash")).groupBy(shingle.alias("hash")).count()
    return np.sort(np.array([r["hash"] for r in counts.where(F.col("count") >= least).collect()], np.int64).view(_U))


def range_bits(spark, shingles: int) -> int:
    """Ranges, as a power of two: as many as the session's shuffles have and enough for ``_RANGE_BYTES`` in each."""
    return max(4, (partitions(spark) - 1).bit_length(), (-(-8 * shingles // _RANGE_BYTES)).bit_length())


def shared_shingles(df: DataFrame, words: int, text_col: str, bits: int, hot: np.ndarray) -> DataFrame:
    """(name, n, hash, df, frequent array<long>): the shingles that two or more different sets have.

    A row is one shingle with its df, or all those that the set's own batch found frequent and did not send to their
    hash ranges; they go to ranges of set names. Both come from one pass: what is left out here is named here.
    df counts the sets; it is the largest number where a batch found the shingle frequent or it is one of ``hot``.
    There are 2 ** bits ranges.
    """
    shift = _U(64 - bits)
    kept = kept_bits(bits)

    def owners(local: np.ndarray, used: np.ndarray) -> bytes:
        return local.astype(np.uint16 if len(used) <= 1 << 16 else np.uint32).tobytes()

    def deal(batches):
        for b in batches:
            texts = b.column(0).to_pylist()
            for a, z in _parts(texts):
                sets, names, once, hashes, owner = _batch(texts[a:z], words)
                if not once:
                    continue
                mask, frequent = _frequent(hashes, hot, kept)
                unsent, unsent_owner = hashes[mask] & kept, owner[mask]
                hashes, owner = hashes[~mask], owner[~mask]
                heads = np.arange(1 << bits, dtype=_U) << shift
                cut, often = np.append(np.searchsorted(hashes, heads), len(hashes)), np.append(np.searchsorted(frequent, heads), len(frequent))
                table = np.array([(names[i], len(sets[i])) for i in once], _SET)
                rows = []
                for r in range(1 << bits):
                    x, y = cut[r], cut[r + 1]
                    if x == y and often[r] == often[r + 1]:
                        continue
                    used, local = np.unique(owner[x:y], return_inverse=True)
                    rows.append((r, hashes[x:y].view(np.uint8).reshape(-1, 8)[:, :6].tobytes(), owners(local, used), table[used].tobytes(), frequent[often[r] : often[r + 1]].tobytes()))
                place = (np.ascontiguousarray(table["name"]).view(_U) >> shift).astype(np.int64)[unsent_owner]
                for r in np.unique(place).tolist():
                    here = place == r
                    used, local = np.unique(unsent_owner[here], return_inverse=True)
                    rows.append(((1 << bits) + r, unsent[here].tobytes(), owners(local, used), table[used].tobytes(), b""))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32(), *[pa.binary()] * 4], strict=True)], names=["range", "hashes", "owners", "sets", "frequent"])

    schema = pa.schema([("name", pa.int64()), ("n", pa.int64()), ("hash", pa.int64()), ("df", pa.int32()), ("frequent", pa.list_(pa.int64()))])

    def named(rows: list[dict]) -> pa.Table:
        tables = [schema.empty_table()]
        for r in rows:
            own = np.frombuffer(r["sets"], _SET)
            local = np.frombuffer(r["owners"], np.uint16 if len(own) <= 1 << 16 else np.uint32)
            order = np.argsort(local, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(local, minlength=len(own)))])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(r["hashes"], np.int64)[order]))
            tables.append(pa.table({"name": own["name"], "n": own["n"].astype(np.int64), "hash": pa.nulls(len(own), pa.int64()), "df": pa.nulls(len(own), pa.int32()), "frequent": lists}, schema=schema))
        return pa.concat_tables(tables)

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        if key[0].as_py() >> bits:
            return named(rows)
        top = _U(key[0].as_py()) << shift
        names, sizes, low = [], [], []
        for r in rows:
            own = np.frombuffer(r["sets"], _SET)
            n = len(r["hashes"]) // 6
            local = np.frombuffer(r["owners"], np.uint16 if len(own) <= 1 << 16 else np.uint32)
            names.append(own["name"][local])
            sizes.append(own["n"][local])
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :6] = np.frombuffer(r["hashes"], np.uint8).reshape(-1, 6)
            low.append(wide.view(_U).ravel())
        names, sizes, low = np.concatenate(names), np.concatenate(sizes), np.concatenate(low)
        often = np.unique(np.concatenate([np.frombuffer(r["frequent"], _U) for r in rows])) & _U((1 << 48) - 1)
        order = np.lexsort((names, low))
        low, names, sizes = low[order], names[order], sizes[order]
        keep = np.ones(len(low), bool)
        keep[1:] = (low[1:] != low[:-1]) | (names[1:] != names[:-1])  # equal sets of other batches
        low, names, sizes = low[keep], names[keep], sizes[keep]
        _, counts = np.unique(low, return_counts=True)
        df_ = np.repeat(counts, counts)
        df_[np.isin(low, often)] = _LAST
        shared = df_ > 1
        return pa.table({"name": names[shared], "n": sizes[shared].astype(np.int64), "hash": (low[shared] | top).astype(np.int64), "df": df_[shared].astype(np.int32), "frequent": pa.nulls(int(shared.sum()), pa.list_(pa.int64()))}, schema=schema)

    source = df.select(text_bytes(text_col).alias("text"))
    dealt = source.mapInArrow(deal, "range int, hashes binary, owners binary, sets binary, frequent binary")
    return dealt.groupBy("range").applyInArrow(meet, "name long, n long, hash long, df int, frequent array<long>")


def prefixes(shared: DataFrame, percent: int, verify_cost: int = 40, most: int = 8) -> DataFrame:
    """(name, n, m, shingles array<long>, k, prefix array<long>) of the sets that can have a link.

    ``shared``: (name, n, hash, df, frequent array<long>), in which each batch names in ``frequent`` what it did not
    send, so one array of a set is enough. ``shingles`` are the shared ones from rare to frequent, m of n.
    ``k`` shared prefix shingles are asked for.
    """
    rows = shared.select("name", "n", F.when(F.col("hash").isNotNull(), F.struct("df", "hash")).alias("one"), "frequent")
    grouped = rows.groupBy("name", "n").agg(F.collect_set("one").alias("s"), F.max_by("frequent", F.struct(F.size("frequent"), "frequent")).alias("f"))
    able = grouped.where((F.size("s") + F.coalesce(F.size("f"), F.lit(0))) * 100 >= F.col("n") * percent).select("name", "n", F.col("s.df").alias("df"), F.col("s.hash").alias("hash"), "f")

    def run(batches):
        for b in batches:
            m, sets, ks, starts = [], [], [], []
            for n, df, h, f in zip(*(b.column(i).to_pylist() for i in (1, 2, 3, 4)), strict=True):
                f = f or []
                df, h = np.array(df + [_LAST] * len(f), np.int64), np.array(h + f, np.int64)
                order = np.lexsort((h, df))
                df, h = df[order], h[order]
                same = np.ones(len(h), bool)
                by_hash = np.argsort(h, kind="stable")  # one that only some batches found frequent may come twice
                same[by_hash[1:]] = h[by_hash[1:]] != h[by_hash[:-1]]
                df, h = df[same], h[same]
                least = -(-percent * n // 100)
                one = len(h) - least + 1
                if one < 1:
                    one, k = 0, 1
                else:
                    tries = np.arange(1, min(most, least) + 1)
                    scanned = np.cumsum(np.minimum(df, 1 << 20), dtype=np.float64)[one + tries - 2]
                    k = int(tries[np.argmin(scanned * (1 + verify_cost / tries))])
                m.append(len(h))
                sets.append(h)
                ks.append(k)
                starts.append(h[: one + k - 1] if one else h[:0])
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (sets, starts)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(m, pa.int64()), lists[0], pa.array(ks, pa.int32()), lists[1]], names=["name", "n", "m", "shingles", "k", "prefix"])

    return able.mapInArrow(run, "name long, n long, m long, shingles array<long>, k int, prefix array<long>").where(F.col("m") * 100 >= F.col("n") * percent)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose similarity is ``percent`` or more."""
    one = sets.select(F.col("name").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    two = sets.select(F.col("name").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    both = F.size(F.array_intersect("s_a", "s_b"))
    joined = pairs.join(one, "a").join(two, "b").withColumn("both", both)
    return joined.where(F.col("both") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("both")) * percent).select("a", "b")


def star_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): each set with the hub of the sets that have the same smallest, or largest, shared shingle."""
    keys = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.array_min("shingles").alias("hash")), F.struct(F.lit(1).alias("side"), F.array_max("shingles").alias("hash"))))
    keyed = sets.select("name", "n", "m", keys.alias("key")).select("name", "n", "m", "key.*")
    order = F.struct(F.col("m") / F.col("n"), "n", "name")
    hubs = keyed.groupBy("side", "hash").agg(F.max_by(F.struct("name", "n", "m"), order).alias("hub"), F.count("*").alias("c")).where("c > 1")
    hubs = materialize(hubs, "hubs")  # the join below then has two shuffles of its own, of which hot keys can be split
    pairs = keyed.join(hubs, ["side", "hash"]).where(F.col("name") != F.col("hub.name"))
    possible = F.least("m", "hub.m") * (100 + percent) >= (F.col("n") + F.col("hub.n")) * percent
    return pairs.where(possible).select(F.col("name").alias("a"), F.col("hub.name").alias("b")).distinct()


def prefix_pairs(sets: DataFrame, components: DataFrame, percent: int) -> DataFrame:
    """(a, b) of different components that share as many prefix shingles as both ask for and may be long enough.

    Sizes of a pair differ by a factor of 100 / percent at most, so their cells of the logarithm by one at most.
    """
    cell = F.floor(F.log("n") / (max(math.log(100 / percent), 1e-9) * (1 + 1e-9)))
    sizes = components.groupBy("component").agg(F.count("*").alias("members"))
    placed = sets.select("name", "n", "m", "k", "prefix").join(components.join(sizes, "component").withColumnRenamed("node", "name"), "name", "left")
    placed = placed.select("name", "n", "m", "k", F.posexplode("prefix").alias("at", "hash"), F.coalesce("component", "name").alias("component"), F.coalesce("members", F.lit(1)).alias("members"))
    spots = placed.groupBy("hash").agg(F.max_by("component", F.struct("members", "component")).alias("top"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    met = placed.join(spots.select("hash", "top"), "hash").join(sets.select("name", "prefix"), "name")
    own = ("name", "n", "m", "k", "at", "component", "prefix")
    one = met.where("component <> top").select("hash", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"), *(F.col(c).alias(f"{c}_a") for c in own))
    two = met.select("hash", cell.alias("cell"), "top", *(F.col(c).alias(f"{c}_b") for c in own))
    # of the shingles before this one the farther one has some that the other lacks
    ahead = F.col("at_a") - F.col("at_b")
    most = F.least(F.col("m_a") - F.greatest(ahead, F.lit(0)), F.col("m_b") - F.greatest(-ahead, F.lit(0)))
    enough = most * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
    # a pair appears at the first of its common prefix shingles only
    common = F.array_intersect("prefix_a", "prefix_b")
    matches = (common[0] == F.col("hash")) & (F.size(common) >= F.least("k_a", "k_b"))
    fits = (F.col("component_a") != F.col("component_b")) & ((F.col("component_b") == F.col("top")) | (F.col("name_a") < F.col("name_b"))) & enough & matches
    return one.join(two, ["hash", "cell"]).where(fits).select(F.least("name_a", "name_b").alias("a"), F.greatest("name_a", "name_b").alias("b"))


def jaccard_components(df: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row.

    Two documents link when 100 * intersection >= percent * union of their distinct word n-grams; component_id
    is the smallest id that links reach, the own one included. Null and empty texts have no shingles and no
    link. Rows with equal sets are linked if they have shingles, also where ids repeat: each row is a document of its
    own, and an id that repeats may name several. Ids may be of any ordered type. A null id counts
    only where its component has no other. An empty table gives no rows.
    """
    documents = materialize(text_sets(df, words, id_col, text_col), "sets")
    bits = range_bits(df.sparkSession, documents.agg(F.sum("n")).first()[0] or 0)
    hot = hot_shingles(documents, bits)
    sets = materialize(prefixes(shared_shingles(df, words, text_col, bits, hot), percent), "prefixes")
    star = materialize(verified(star_pairs(sets, percent), sets, percent), "star")
    first = connected_components(star)
    rest = materialize(verified(prefix_pairs(sets, first, percent), sets, percent), "rest")
    links = first.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")).union(rest)
    components = first if rest.isEmpty() else connected_components(links)
    classes = documents.where("n > 0").groupBy("name").agg(F.min("id").alias("id"))
    named = classes.join(components.withColumnRenamed("node", "name"), "name", "left").select("name", "id", F.coalesce("component", "name").alias("component"))
    named = materialize(named, "named")  # as with hubs, a join on two shuffles of its own can split a large component
    smallest = materialize(named.groupBy("component").agg(F.min("id").alias("component_id")), "smallest")
    labels = named.join(smallest, "component").select("name", "component_id")
    full = documents.where("n > 0").join(labels, "name").select("id", "n", "component_id")
    empty = documents.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return full.unionByName(empty).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
