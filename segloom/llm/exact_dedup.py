"""Exact duplicates of whole texts.

Method: Patricia-trie owners. Texts are dealt by length and content hash; each task inserts the full byte
strings into a compressed radix trie whose terminal nodes keep the smallest id and a count. Equality is that
of the bytes: the hash only deals the rows out. A trie over its memory limit spills its largest subtree.

A first trie in each map task merges the copies it meets, so a text that a third of all rows share reaches
the shuffle once a task. Rows get their owner back by a join on (length, hash), which adaptive execution
splits where a key is hot; no list of a group's rows is ever made.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import SPACE, identity, rows_of


class _Node:
    __slots__ = ("children", "count", "label", "owner")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner, self.count = label, {}, None, 0


def _smaller(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class PatriciaOwners:
    """Byte strings to (smallest id, count); over ``limit`` bytes the largest subtree goes to a file."""

    _NODE = 200  # bytes of a node, about

    def __init__(self, limit: int = 64 << 20, skip: int = 0):
        self.limit, self.skip = limit, skip
        self.root, self.sizes, self.total = _Node(b""), {}, 0
        self.spilled: dict[int, tuple] = {}

    def add(self, key: bytes, owner: int | None, count: int = 1) -> None:
        first = key[self.skip] if len(key) > self.skip else -1
        if first in self.spilled:
            return self._write(first, key, owner, count)
        node, at, grown = self.root, self.skip, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = _Node(key[at:])
                node, at, grown = child, len(key), grown + self._NODE + len(child.label)
                break
            if key.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            n = common_prefix(child.label, key[at : at + len(child.label)])
            split = _Node(child.label[:n])
            node.children[key[at]] = split
            child.label = child.label[n:]
            split.children[child.label[0]] = child
            node, at, grown = split, at + n, grown + self._NODE
        node.owner = _smaller(node.owner, owner) if node.count else owner
        node.count += count
        if grown:
            self.sizes[first] = self.sizes.get(first, 0) + grown
            self.total += grown
            while self.total > self.limit and self._spill():
                pass

    def _walk(self, node: _Node, prefix: bytes) -> Iterator[tuple[bytes, int | None, int]]:
        todo = [(node, prefix)]
        while todo:
            node, prefix = todo.pop()
            prefix += node.label
            if node.count:
                yield prefix, node.owner, node.count
            todo += [(x, prefix) for x in node.children.values()]

    def _write(self, first: int, key: bytes, owner: int | None, count: int) -> None:
        f, lead = self.spilled[first]
        f.write(struct.pack("<q?qq", len(key), owner is None, owner or 0, count) + key)
        n = len(key) if lead is None else common_prefix(lead, key)
        self.spilled[first] = (f, key if lead is None else lead[:n])

    def _spill(self) -> bool:
        first = max((k for k in self.sizes if k >= 0), key=self.sizes.get, default=None)
        if first is None:
            return False
        self.spilled[first] = (tempfile.TemporaryFile(), None)  # noqa: SIM115  gone with the task
        prefix = self._prefix
        for key, owner, count in self._walk(self.root.children.pop(first), b""):
            self._write(first, prefix + key, owner, count)
        self.total -= self.sizes.pop(first)
        return True

    _prefix = b""

    def items(self) -> Iterator[tuple[bytes, int | None, int]]:
        """Each string once; spilled subtrees after the others, one at a time."""
        yield from self._walk(self.root, self._prefix)
        self.root, self.sizes, self.total = _Node(b""), {}, 0
        for first in sorted(self.spilled):
            f, lead = self.spilled[first]
            f.seek(0)
            below = PatriciaOwners(self.limit, len(lead))
            below._prefix = lead
            head = struct.calcsize("<q?qq")
            while raw := f.read(head):
                n, no_owner, owner, count = struct.unpack("<q?qq", raw)
                below.add(f.read(n), None if no_owner else owner, count)
            f.close()
            yield from below.items()


def normalised(text_col: str):
    return F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE, " ").cast("binary")


def text_owners(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 64 << 20) -> DataFrame:
    """(n_bytes, sha256, keep_id, group_size): a row for each distinct text."""
    schema = "n_bytes long, sha256 binary, text binary, keep_id long, group_size long"

    def rows(entries, with_text: bool):
        def batch(x):
            columns = [pa.array(c, t) for c, t in zip(zip(*x, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        types, names = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()], ["n_bytes", "sha256", "text", "keep_id", "group_size"]
        if not with_text:
            del types[2], names[2]
        held, size = [], 0
        for text, owner, count in entries:
            row = [len(text), hashlib.sha256(text).digest(), text, owner, count]
            if not with_text:
                del row[2]
            held.append(row)
            size += len(text) if with_text else 64
            if size > 4 << 20:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)

    def combine(batches):
        trie = PatriciaOwners(limit)
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                trie.add(text, key)
            if trie.total > limit // 2:  # these go on as they are; the next trie merges them
                yield from rows(trie.items(), True)
                trie = PatriciaOwners(limit)
        yield from rows(trie.items(), True)

    def merge(batches):
        trie = PatriciaOwners(limit)
        for b in batches:
            for text, owner, count in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                trie.add(text, owner, count)
        yield from rows(trie.items(), False)

    source = df.select(F.col(id_col).cast("long").alias("id"), normalised(text_col).alias("text"))
    local = source.mapInArrow(combine, schema)
    dealt = local.repartition("n_bytes", "sha256").select("text", "keep_id", "group_size")
    return dealt.mapInArrow(merge, "n_bytes long, sha256 binary, keep_id long, group_size long")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every row, dropped ones too.

    Texts are equal when identical after each run of white space becomes one space; null counts as empty. Of
    equal texts the smallest id stays; a null id only where the group has no other. Rows that repeat the
    owner's id are the owner's record as well and count as kept. An empty table gives no rows. Ids are whole numbers
    or null; other types raise a TypeError.
    """
    if not isinstance(df.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must be a whole number, not {df.schema[id_col].dataType.simpleString()}")
    kind = df.schema[id_col].dataType.simpleString()
    owners = text_owners(df, id_col, text_col)
    text = normalised(text_col)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), F.unhex(F.sha2(text, 256)).alias("sha256"))
    joined = rows.join(owners, ["n_bytes", "sha256"])
    return joined.select(
        F.col("id").cast(kind).alias(id_col),
        F.col("keep_id").cast(kind).alias("keep_id"),
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"),
    )


def drop_exact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df without the rows whose text another row owns; its columns stay as they are.

    One row of each text is left, also where rows repeat the owner's id (``rows_of`` says which). The decision joins
    back on (id, text hash), so rows that share an id but not the text are told apart. Ids are whole numbers or null.
    """
    kept = exact_groups(df, id_col, text_col).where("kept").select(identity(id_col).alias("key"), F.col("text_sha256").alias("text")).distinct()
    return rows_of(df, F.sha2(normalised(text_col), 256), kept, id_col)
