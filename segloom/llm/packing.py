"""Packing of token ids into sequences of a fixed length.

Method: first-fit decreasing, run independently in randomised groups of documents. A tournament tree over
the bins' free room (the winner of each match is the larger) finds the leftmost bin with room in logarithmic
time. Documents longer than a sequence are cut; a piece that fills a sequence is a sequence of its own.

Only (id, start, length, checksum) rows are shuffled, never token ids. Groups hold about ``group_size``
documents whatever the input, so no group grows with it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import CACHE_ENTRIES, library_encoder
from .common import text_bytes


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item. Lengths must be from 0 to capacity; ties keep the given order."""
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = np.argsort(-lengths, kind="stable")
    full = int(np.searchsorted(-lengths[order], -capacity, side="right"))
    bins[order[:full]] = np.arange(full)
    rest = order[full:]
    if not len(rest):
        return bins, offsets
    size = 1 << (len(rest) - 1).bit_length()
    tree = [capacity] * (2 * size)
    for item, length in zip(rest.tolist(), lengths[rest].tolist(), strict=True):
        k = 1
        while k < size:  # the left half whenever its winner has room
            k *= 2
            if tree[k] < length:
                k += 1
        offsets[item], bins[item] = capacity - tree[k], full + k - size
        tree[k] -= length
        k >>= 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            winner = a if a >= b else b
            if tree[k] == winner:
                break
            tree[k] = winner
            k >>= 1
    return bins, offsets


def token_pieces(df: DataFrame, path: str, capacity: int, end_id: int, id_col: str, text_col: str, cache_entries: int = CACHE_ENTRIES) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, salt): the whole text's ids and one end id, cut at each capacity.

    salt tells the rows apart: the partition in the high bits, the row's place in it in the low ones.
    """

    def run(batches):
        from pyspark import TaskContext

        encoder = library_encoder(path, cache_entries)
        end, step, first = end_id.to_bytes(4, "little"), 4 * capacity, TaskContext.get().partitionId() << 33
        names = ["id", "start", "length", "ids_crc32", "doc_tokens", "salt"]
        for b in batches:
            row, start, length, crc, total = [], [], [], [], []
            for i, raw in enumerate(encoder.encode(b.column(1).to_pylist())):
                raw += end
                for at in range(0, len(raw), step):
                    piece = raw[at : at + step]
                    row.append(i)
                    start.append(at // 4)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(len(raw) // 4)
            rows = np.array(row, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), *(pa.array(x, pa.int64()) for x in (start, length, crc, total, first + rows))], names=names)
            first += b.num_rows

    source = df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    kind = df.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, salt long")


def pack(
    df: DataFrame,
    path: str,
    capacity: int = 2048,
    end_id: int = 1,
    group_size: int = 2000,
    id_col: str = "doc_id",
    text_col: str = "text",
    cache_entries: int = CACHE_ENTRIES,
) -> DataFrame:
    """Pieces with their place: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A null or empty text is its end id alone. Repeated rows are packed each on its own; a null id is kept.
    The hash that deals documents to groups has the row's place in the table as salt, so rows that share an id
    spread over many groups; the pieces of one document stay in one. An empty table gives no rows.
    ``cache_entries`` bounds the memory of the encoder in each Python worker; it changes no result.
    """
    groups = -(-max(1, df.count()) // group_size)
    kind = df.schema[id_col].dataType.simpleString()

    def place(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "start", "salt"], kind="stable", ignore_index=True)
        bins, offsets = first_fit_decreasing(pdf["length"].to_numpy(), capacity)
        out = pdf[["id", "start", "length", "ids_crc32", "doc_tokens"]].copy()
        out["sequence_id"] = (int(key[0]) << 28) + bins
        out["offset"] = offsets
        return out

    dealt = token_pieces(df, path, capacity, end_id, id_col, text_col, cache_entries).withColumn("group", F.pmod(F.xxhash64("id", "salt"), F.lit(groups)))
    packed = dealt.groupBy("group").applyInPandas(place, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return packed.withColumnRenamed("id", id_col)
