"""Token ids as compressed binary shards with random access.

Method: one zstandard dictionary, trained on serialized id arrays, is shared by all documents; each document
is a frame of its own, so a short document is read without its neighbours. A shard row holds the frames of
consecutive documents in one payload, the hash of the dictionary, and the offset index.

Texts are encoded and compressed where they are read; the frames, not the texts, are then range-partitioned by
id. Each task writes shards of bounded size through Spark's Parquet writer (any file system, committed once, safe
when executors are lost), and global starts come from sums per shard. Ids are stored as 16-bit numbers where the vocabulary allows it, else as 32-bit numbers; the dictionary
table says which.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import library_encoder
from .common import materialize, text_bytes


def id_width(path: str, end_id: int) -> int:
    """Bytes of an id: 2 where the largest id of the vocabulary fits, else 4."""
    return 2 if max(end_id, *Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values()) < 1 << 16 else 4


def serialize(raw: bytes, width: int) -> bytes:
    ids = np.frombuffer(raw, "<u4")
    return ids.astype("<u2").tobytes() if width == 2 else raw


def train_dictionary(df: DataFrame, path: str, end_id: int, size: int, documents: int, chars: int, id_col: str, text_col: str, width: int) -> bytes:
    """A dictionary from about ``documents`` texts (at most twice as many), one slice of at most ``chars`` each.

    The rows are those whose id's hash falls into one of n / documents parts, so they come from the whole table.
    The sample changes the stored size only. With too few samples the samples themselves are the dictionary.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    room = F.greatest(F.length(text) - chars, F.lit(0)) + 1
    chosen = df.where(F.pmod(F.xxhash64(id_col), F.lit(max(1, df.count() // documents))) == 0)
    slices = chosen.select(F.substring(text, F.pmod(F.xxhash64(text), room.cast("long")).cast("int") + 1, chars).alias("s")).limit(2 * documents).collect()
    end = end_id.to_bytes(4, "little")
    encoded = library_encoder(path).encode([r["s"].encode() for r in slices])
    samples = [serialize(raw + end, width) for raw in encoded if raw]
    if sum(map(len, samples)) >= 20 * size and len(samples) >= 16:
        try:
            return zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:
            pass  # the trainer asks for more variety
    return b"".join(samples)[-size:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write_tokens(
    df: DataFrame,
    target: str,
    path: str,
    end_id: int = 2,
    shard_bytes: int = 4 << 20,
    level: int = 3,
    dictionary_bytes: int = 64 << 10,
    sample_documents: int = 1000,
    sample_chars: int = 16384,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the ids of every whole text, in ascending order of id, below ``target``.

    ``target/shards`` has a row a shard, ``target/dictionary`` the dictionary, its hash and the bytes of an id. A null text counts
    as empty (its end id alone); null ids come first; repeated ids keep the order of the input; an empty
    table gives no shard.
    """
    spark = df.sparkSession
    width = id_width(path, end_id)
    data = train_dictionary(df, path, end_id, dictionary_bytes, sample_documents, sample_chars, id_col, text_col, width)
    digest = hashlib.sha256(data).hexdigest()
    kind = df.schema[id_col].dataType
    spark.createDataFrame([(digest, bytearray(data), width)], "dictionary_sha256 string, dictionary binary, width int").coalesce(1).write.parquet(f"{target}/dictionary")
    names = ["part", "seq", "first_id", "last_id", "dictionary_sha256", "ids", "offsets", "tokens", "shard_tokens", "payload"]

    def encode(batches):
        encoder, end = library_encoder(path), end_id.to_bytes(4, "little")
        compress = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(data), write_content_size=True).compress
        for b in batches:
            frames, tokens = [], []
            for raw in encoder.encode(b.column(2).to_pylist()):
                raw += end
                frames.append(compress(serialize(raw, width)))
                tokens.append(len(raw) // 4)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(tokens, pa.int64()), pa.array(frames, pa.binary())], names=["id", "salt", "tokens", "frame"])

    def shards(batches):
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        ids, frames, offsets, tokens, at = [], [], [], [], 0

        def shard():
            row = [[part], [seq], [ids[0]], [ids[-1]], [digest], [ids], [offsets], [tokens], [sum(tokens)], [b"".join(frames)]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], names=names)

        for b in batches:
            own = b.schema.field(0).type
            types = [pa.int64(), pa.int64(), own, own, pa.string(), pa.list_(own), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary()]
            for key, n, frame in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                ids.append(key)
                frames.append(frame)
                offsets.append(at)
                tokens.append(n)
                at += len(frame)
                if at >= shard_bytes:
                    yield shard()
                    seq += 1
                    ids, frames, offsets, tokens, at = [], [], [], [], 0
        if ids:
            yield shard()

    k = kind.simpleString()
    schema = f"part long, seq long, first_id {k}, last_id {k}, dictionary_sha256 string, ids array<{k}>, offsets array<long>, tokens array<long>, shard_tokens long, payload binary"
    source = df.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("salt"), text_bytes(text_col).alias("text"))
    # written once: the range partitioner samples its input, which must not encode the texts again
    encoded = materialize(source.mapInArrow(encode, f"id {k}, salt long, tokens long, frame binary"), "frames")
    ordered = encoded.repartitionByRange("id", "salt").sortWithinPartitions("id", "salt").select("id", "tokens", "frame")
    ordered.mapInArrow(shards, schema).write.option("compression", "none").parquet(f"{target}/shards")


def _load_dictionary(spark: SparkSession, target: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{target}/dictionary").first()
    return row["dictionary_sha256"], bytes(row["dictionary"])


def _load_width(spark: SparkSession, target: str) -> int:
    return spark.read.parquet(f"{target}/dictionary").first().asDict().get("width", 2)  # older stores have 2


def _ids(frame: bytes, decompress, width: int) -> np.ndarray:
    return np.frombuffer(decompress(frame), "<u2" if width == 2 else "<u4").astype("<u4")


def read_tokens(spark: SparkSession, target: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of each stored document; start counts the ids of all documents before it."""
    digest, data = _load_dictionary(spark, target)
    width = _load_width(spark, target)
    shards = spark.read.parquet(f"{target}/shards")
    kind = shards.schema["first_id"].dataType.simpleString()

    def run(batches):
        decompress = zstandard.ZstdDecompressor(dict_data=_dictionary(data)).decompress
        names = ["id", "part", "seq", "at", "n_tokens", "ids_crc32"]
        for b in batches:
            for r in b.to_pylist():
                if r["dictionary_sha256"] != digest:
                    raise ValueError("the shard was written with another dictionary")
                bounds, at, starts, sizes, crc = [*r["offsets"], len(r["payload"])], 0, [], [], []
                for i in range(len(r["ids"])):
                    ids = _ids(r["payload"][bounds[i] : bounds[i + 1]], decompress, width)
                    starts.append(at)
                    sizes.append(len(ids))
                    crc.append(zlib.crc32(ids.tobytes()))
                    at += len(ids)
                n = len(starts)
                columns = [pa.array(r["ids"], b.schema.field("first_id").type), *(pa.array(x, pa.int64()) for x in ([r["part"]] * n, [r["seq"]] * n, starts, sizes, crc))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    stored = shards.select("part", "seq", "first_id", "dictionary_sha256", "ids", "offsets", "payload")
    documents = stored.mapInArrow(run, f"id {kind}, part long, seq long, at long, n_tokens long, ids_crc32 long")
    sums = shards.select("part", "seq", "shard_tokens")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a task that wrote
    parts = sums.groupBy("part").agg(F.sum("shard_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("inside", F.coalesce(F.sum("shard_tokens").over(inside), F.lit(0))).join(parts, "part").select("part", "seq", (F.col("base") + F.col("inside")).alias("shard_start"))
    joined = documents.join(starts, ["part", "seq"])
    return joined.select(F.col("id").alias(id_col), (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def fetch_tokens(spark: SparkSession, target: str, doc_id: int) -> DataFrame:
    """(id, ids array<int>) of one document: Parquet statistics pick its shards, the index its frame."""
    _, data = _load_dictionary(spark, target)
    width = _load_width(spark, target)
    shards = spark.read.parquet(f"{target}/shards").where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    kind = shards.schema["first_id"].dataType.simpleString()
    ends = F.array_append(F.slice("offsets", 2, F.greatest(F.size("offsets"), F.lit(1))), F.length("payload").cast("long"))
    frames = shards.select("payload", F.explode(F.arrays_zip(F.col("ids").alias("id"), F.col("offsets").alias("a"), ends.alias("b"))).alias("f")).where(F.col("f.id") == doc_id)
    frame = frames.select(F.col("f.id").alias("id"), F.expr("substring(payload, cast(f.a + 1 as int), cast(f.b - f.a as int))").alias("frame"))

    def run(batches):
        decompress = zstandard.ZstdDecompressor(dict_data=_dictionary(data)).decompress
        for b in batches:
            ids = [_ids(x, decompress, width).astype("i4") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    return frame.mapInArrow(run, f"id {kind}, ids array<int>")
