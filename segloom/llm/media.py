"""Baseline JPEG media columns.

Method: the reader parses the markers, Huffman-decodes the scan and rebuilds a luminance thumbnail from the DC
coefficients alone, all in numpy; it stores dimensions and a hash of the thumbnail. Restart segments are
independent, so one decoding step takes one symbol of every segment of every image in a batch.

The writer stores arbitrary bytes without loss: 64 bytes are one 8x8 block, each byte one quantised
coefficient (in zigzag order, all quantisers 1, the value never zero), with a restart marker after each
block. A comment segment holds the number of bytes and of padded bytes.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes

#: Sizes of coefficients by the length of their codes, for text: letters lie close to the centre.
_CODES = {2: (3, 4), 3: (2, 7), 4: (1, 5), 5: (6, 8), 6: (0,)}
_CENTRE = 104
_STEP = 1 << 14  # blocks in one numpy step


def canonical(lengths: dict[int, tuple[int, ...]]) -> dict[int, tuple[int, int]]:
    """Symbol to (code, length), as a DHT segment defines it."""
    out, code = {}, 0
    for n in range(1, 17):
        for symbol in lengths.get(n, ()):
            out[symbol] = (code, n)
            code += 1
        code <<= 1
    return out


def _value(b: np.ndarray) -> np.ndarray:
    v = b.astype(np.int32) - _CENTRE
    return np.where(v >= 0, v + 1, v)


def _byte(v: np.ndarray) -> np.ndarray:
    return np.where(v > 0, v + _CENTRE - 1, v + _CENTRE).astype(np.uint8)


@functools.cache
def _write_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes, bytes]:
    """Bits, their mask and number for each byte and for 0 to 7 padding ones; an empty block; the DHT lists."""
    codes = canonical(_CODES)
    bits, used, length = np.zeros((264, 16), np.uint8), np.zeros((264, 16), bool), np.zeros(264, np.int32)
    for b, v in enumerate(_value(np.arange(256)).tolist()):
        size = abs(v).bit_length()
        code, n = codes[size]
        word = format(code, f"0{n}b") + format(v if v > 0 else v + (1 << size) - 1, f"0{size}b")
        bits[b, : len(word)], used[b, : len(word)], length[b] = list(map(int, word)), True, len(word)
    for k in range(8):
        bits[256 + k, :k], used[256 + k, :k], length[256 + k] = 1, True, k
    code, n = codes[0]
    empty = format(code, f"0{n}b") * 2
    empty += "1" * (-len(empty) % 8)
    table = bytes(len(_CODES.get(i, ())) for i in range(1, 17)) + bytes(s for i in range(1, 17) for s in _CODES.get(i, ()))
    return bits, used, length, int(empty, 2).to_bytes(len(empty) // 8), table


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + struct.pack(">H", len(body) + 2) + body


def encode_many(payloads: list[bytes]) -> list[bytes]:
    """A JPEG file for each byte string; zero bytes fill it up to a positive multiple of 64."""
    bits, used, length, empty, table = _write_tables()
    sizes = [len(p) for p in payloads]
    blocks = [max(1, -(-n // 64)) for n in sizes]
    grid = np.frombuffer(b"".join([p.ljust(64 * n, b"\0") for p, n in zip(payloads, blocks, strict=True)]), np.uint8).reshape(-1, 64)
    first = np.cumsum([0, *blocks])
    place = np.arange(len(grid)) - np.repeat(first[:-1], blocks)  # a block's number in its image
    parts, ends, total = [], [], 0
    for a in range(0, len(grid), _STEP):
        part = grid[a : a + _STEP]
        n_bits = length[part].sum(1)
        symbols = np.concatenate([part.astype(np.int16), (256 + (-n_bits & 7)).astype(np.int16)[:, None]], 1)
        coded = np.packbits(bits[symbols][used[symbols]])
        n_bytes = (n_bits + 7) >> 3
        block = np.repeat(np.arange(len(part)), n_bytes)
        stuffed = coded == 255
        at = np.arange(len(coded)) + np.cumsum(stuffed) - stuffed + 2 * block
        end = np.cumsum(n_bytes + 2 + np.bincount(block[stuffed], minlength=len(part)))
        out = np.zeros(end[-1], np.uint8)
        out[at] = coded
        out[end - 2], out[end - 1] = 0xFF, 0xD0 + (place[a : a + _STEP] & 7)
        parts.append(out)
        ends.append(end + total)
        total += int(end[-1])
    stream, ends, at, files = np.concatenate(parts).tobytes(), np.concatenate(ends), 0, []
    for i, (size, n) in enumerate(zip(sizes, blocks, strict=True)):
        wide = min(int(np.ceil(np.sqrt(n))), 8191)
        high = -(-n // wide)
        end = int(ends[first[i + 1] - 1])
        spare = wide * high - n
        scan = stream[at : end - 2] if not spare else stream[at:end] + b"".join([empty + (bytes([0xFF, 0xD0 + ((n + k) & 7)]) if k < spare - 1 else b"") for k in range(spare)])
        at = end
        files.append(
            b"\xff\xd8"
            + _segment(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0")
            + _segment(0xFE, b"bytes=%d padded=%d" % (size, 64 * n))
            + _segment(0xDB, b"\0" + b"\1" * 64)
            + _segment(0xC0, struct.pack(">BHHB", 8, 8 * high, 8 * wide, 1) + b"\1\x11\0")
            + _segment(0xC4, b"\0" + table)
            + _segment(0xC4, b"\x10" + table)
            + _segment(0xDD, b"\0\1")
            + _segment(0xDA, b"\1\1\0\0\x3f\0")
            + scan
            + b"\xff\xd9"
        )
    return files


class JpegError(ValueError):
    """Not a baseline JPEG file with one scan."""


def parse_markers(data: bytes) -> dict:
    """Dimensions, tables, components of the scan, restart interval, comment and the place of the scan."""
    if data[:2] != b"\xff\xd8":
        raise JpegError("no start of image")
    out, at = {"quantisers": {}, "huffman": {}, "restart": 0, "comment": b""}, 2
    try:
        while True:
            if data[at] != 0xFF:
                raise JpegError("no marker")
            marker = data[at + 1]
            if marker == 0xFF:
                at += 1
                continue
            (n,) = struct.unpack_from(">H", data, at + 2)
            body, at = data[at + 4 : at + 2 + n], at + 2 + n
            if marker == 0xC0:
                bits, out["height"], out["width"], n = struct.unpack_from(">BHHB", body)
                out["frame"] = {body[6 + 3 * i]: (body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)}
                if bits != 8 or not out["height"] or not out["width"]:
                    raise JpegError("not 8 bits a sample, or no size")
            elif marker in (0xC1, 0xC2, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
                raise JpegError("not baseline")
            elif marker == 0xDB:
                i = 0
                while i < len(body):
                    wide = body[i] >> 4
                    out["quantisers"][body[i] & 15] = struct.unpack_from(">64H" if wide else ">64B", body, i + 1)
                    i += 129 if wide else 65
            elif marker == 0xC4:
                i = 0
                while i < len(body):
                    n = sum(body[i + 1 : i + 17])
                    out["huffman"][body[i]] = body[i + 1 : i + 17 + n]
                    i += 17 + n
            elif marker == 0xDD:
                (out["restart"],) = struct.unpack(">H", body)
            elif marker == 0xFE:
                out["comment"] = body
            elif marker == 0xDA:
                out["scan"] = [(body[1 + 2 * i], body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])]
                out["begin"], out["end"] = at, data.rfind(b"\xff\xd9")
                if out["end"] < at or set(out["frame"]) != {c for c, _, _ in out["scan"]}:
                    raise JpegError("cut off, or several scans")
                return out
    except (IndexError, KeyError, struct.error) as e:
        raise JpegError("cut off") from e


@functools.lru_cache(64)
def _read_table(spec: bytes) -> np.ndarray:
    """For the next 16 bits: value << 16 | kind << 12 | run << 8 | bits.

    Kind 0: the value is within the 16 bits; 1: its (value field) bits follow; 2: end of block; 3: no code.
    """
    lengths, at = {}, 16
    for n in range(1, 17):
        lengths[n] = tuple(spec[at : at + spec[n - 1]])
        at += spec[n - 1]
    table = np.full(1 << 16, 3 << 12 | 16, np.int32)
    for symbol, (code, n) in canonical(lengths).items():
        run, size = symbol >> 4, symbol & 15
        a, b = code << (16 - n), (code + 1) << (16 - n)
        if not size:
            table[a:b] = (0 if run == 15 else 2 << 12) | run << 8 | n
        elif n + size <= 16:
            raw = (np.arange(a, b) >> (16 - n - size)) & ((1 << size) - 1)
            table[a:b] = np.where(raw >> (size - 1), raw, raw - (1 << size) + 1) << 16 | run << 8 | (n + size)
        else:
            table[a:b] = size << 16 | 1 << 12 | run << 8 | n
    return table


def _decode_segments(stream: np.ndarray, start: np.ndarray, mcus: np.ndarray, plan: list[tuple[int, bytes, bytes]]) -> np.ndarray:
    """Quantised coefficients, (segments, MCUs, blocks of an MCU, 64 in zigzag order), DC as differences summed."""
    padded = np.concatenate([stream, np.zeros(8, np.uint8)]).astype(np.uint32)
    words = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
    last = len(words) - 1
    out = np.zeros((len(start), int(mcus.max()), len(plan), 64), np.int16)
    pos, dc = start.astype(np.int64) * 8, np.zeros((len(start), max(c for c, _, _ in plan) + 1), np.int32)

    def peek(p: np.ndarray) -> np.ndarray:
        return (words[np.minimum(p >> 3, last)] >> (16 - (p & 7)).astype(np.uint32)) & 0xFFFF

    def take(p: np.ndarray, table: np.ndarray):
        e = table[peek(p)]
        kind = (e >> 12) & 7
        value, used = e >> 16, e & 255
        if (late := kind == 1).any():
            size = np.where(late, value, 1)
            raw = (peek(p + used) >> (16 - size).astype(np.uint32)).astype(np.int32)
            value = np.where(late, np.where(raw >> (size - 1), raw, raw - (1 << size) + 1), value)
            used = np.where(late, used + size, used)
        if (kind == 3).any():
            raise JpegError("no such code")
        return value, (e >> 8) & 15, p + (used & 31), kind == 2

    for m in range(out.shape[1]):
        alive = np.flatnonzero(mcus > m)
        for j, (component, dc_spec, ac_spec) in enumerate(plan):
            own = alive
            value, _, p, none = take(pos[own], _read_table(dc_spec))
            dc[own, component] += np.where(none, 0, value)
            out[own, m, j, 0] = dc[own, component]
            table, k, flat = _read_table(ac_spec), np.ones(len(own), np.int64), out[:, m, j]
            while len(own):
                value, run, p, ended = take(p, table)
                k += run
                if (k > 63).any() and ((k > 63) & ~ended).any():
                    raise JpegError("too many coefficients")
                flat[own, np.minimum(k, 63)] = np.where(ended, flat[own, np.minimum(k, 63)], value)
                k += 1
                if (gone := ended | (k > 63)).any():
                    pos[own[gone]] = p[gone]
                    own, p, k = own[~gone], p[~gone], k[~gone]
    return out


def decode_many(files: list[bytes]) -> list[dict | None]:
    """Per file: its markers, ``blocks`` (MCUs, blocks of an MCU, 64) and the ``plan``; None where it can't be read."""
    out: list[dict | None] = [None] * len(files)
    alike: dict[tuple, list[int]] = {}
    for i, data in enumerate(files):
        try:
            head = parse_markers(data)
            alone = len(head["scan"]) == 1
            plan, places = [], []
            for c, (name, dc, ac) in enumerate(head["scan"]):
                h, v, _ = head["frame"][name]
                for y in range(1 if alone else v):
                    for x in range(1 if alone else h):
                        plan.append((c, head["huffman"][dc], head["huffman"][16 | ac]))
                        places.append((c, y, x))
            hmax, vmax = (1, 1) if alone else (max(h for h, _, _ in head["frame"].values()), max(v for _, v, _ in head["frame"].values()))
            across, down = -(-head["width"] // (8 * hmax)), -(-head["height"] // (8 * vmax))
            out[i] = head | {"plan": places, "across": across, "down": down, "sampling": (hmax, vmax)}
            alike.setdefault(tuple(plan), []).append(i)
        except (JpegError, KeyError):
            pass
    for plan, members in alike.items():
        group: list[int] = []
        size = 0
        for i in [*members, -1]:
            if group and (i < 0 or size > 64 * _STEP):
                _decode_group(files, out, group, list(plan))
                group, size = [], 0
            if i >= 0:
                group.append(i)
                size += len(files[i])
    return out


def _decode_group(files: list[bytes], out: list, group: list[int], plan: list) -> None:
    """Images with the same tables: all their restart segments together; a bad file alone becomes None."""
    scans = [files[i][out[i]["begin"] : out[i]["end"]] for i in group]
    raw = np.frombuffer(b"".join(scans), np.uint8)
    follows = np.concatenate([[False], raw[:-1] == 255])
    restart, stuffing = follows & (raw >= 0xD0) & (raw <= 0xD7), follows & (raw == 0)
    drop = restart | stuffing
    drop[:-1] |= restart[1:]
    new_at = np.concatenate([[0], np.cumsum(~drop)])
    begin = np.cumsum([0, *map(len, scans)])
    marks = np.flatnonzero(restart) + 1
    starts, mcus, owners, bad = [], [], [], []
    for g, i in enumerate(group):
        own = marks[np.searchsorted(marks, begin[g], "right") : np.searchsorted(marks, begin[g + 1], "right")]
        n = out[i]["across"] * out[i]["down"]
        each = out[i]["restart"] or n
        if len(own) + 1 != -(-n // each):
            bad.append(i)
            continue
        starts.append(new_at[np.concatenate([[begin[g]], own])])
        mcus.append(np.minimum(each, n - each * np.arange(len(own) + 1)))
        owners.append(i)
    for i in bad:
        out[i] = None
    if not owners:
        return
    stream, start, count = raw[~drop], np.concatenate(starts), np.concatenate(mcus)
    try:
        blocks = [_decode_segments(stream, start[a : a + _STEP], count[a : a + _STEP], plan) for a in range(0, len(start), _STEP)]
    except JpegError:
        if len(owners) == 1:
            out[owners[0]] = None
            return
        for i in owners:
            _decode_group(files, out, [i], plan)
        return
    if len({b.shape[1] for b in blocks}) == 1:
        whole = np.concatenate(blocks) if len(blocks) > 1 else blocks[0]
        at = 0
        for i, m in zip(owners, mcus, strict=True):
            part = whole[at : at + len(m)]
            at += len(m)
            out[i]["blocks"] = part.reshape(-1, len(plan), 64) if (m == part.shape[1]).all() else np.concatenate([p[:k] for p, k in zip(part, m, strict=True)])
    else:
        rows = [x for b in blocks for x in b]
        at = 0
        for i, m in zip(owners, mcus, strict=True):
            out[i]["blocks"] = np.concatenate([p[:k] for p, k in zip(rows[at : at + len(m)], m, strict=True)])
            at += len(m)


def thumbnail(image: dict) -> np.ndarray:
    """Luminance at an eighth of the size: a sample for each block of the first component."""
    name = image["scan"][0][0]
    h, v, q = image["frame"][name] if len(image["scan"]) > 1 else (1, 1, image["frame"][name][2])
    across, down = image["across"], image["down"]
    first = [(j, y, x) for j, (c, y, x) in enumerate(image["plan"]) if c == 0]
    grid = np.zeros((down * v, across * h), np.float64)
    for j, y, x in first:
        grid[y::v, x::h] = image["blocks"][:, j, 0].reshape(down, across)
    grid = np.clip(np.rint(grid * image["quantisers"][q][0] / 8 + 128), 0, 255).astype(np.uint8)
    hmax, vmax = image["sampling"]
    return grid[: -(-image["height"] * v // (8 * vmax)), : -(-image["width"] * h // (8 * hmax))]


def thumbnail_hash(grid: np.ndarray) -> str:
    """64 bits in hexadecimal: which of 8x8 area means exceed the mean of all."""
    rows, columns = (np.linspace(0, n, 9).astype(int) for n in grid.shape)
    sums = np.pad(grid.astype(np.int64).cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    r0, c0 = np.minimum(rows[:-1], grid.shape[0] - 1), np.minimum(columns[:-1], grid.shape[1] - 1)
    r1, c1 = np.maximum(rows[1:], r0 + 1), np.maximum(columns[1:], c0 + 1)
    cells = (sums[np.ix_(r1, c1)] - sums[np.ix_(r0, c1)] - sums[np.ix_(r1, c0)] + sums[np.ix_(r0, c0)]) / np.outer(r1 - r0, c1 - c0)
    return np.packbits((cells > cells.mean()).ravel()).tobytes().hex()


def payload_of(image: dict) -> tuple[bytes, int]:
    """The stored bytes with their padding, and the number of bytes without it."""
    fields = dict(x.split(b"=") for x in image["comment"].split())
    padded = int(fields[b"padded"])
    return _byte(image["blocks"][: padded // 64, 0].astype(np.int32)).tobytes(), int(fields[b"bytes"])


def _slices(values: list[bytes], limit: int = 1 << 20):
    """Ranges of rows of about ``limit`` bytes."""
    a, size = 0, 0
    for i, x in enumerate(values):
        if size and size + len(x) > limit:
            yield a, i
            a, size = i, 0
        size += max(64, len(x))
    if values:
        yield a, len(values)


def store_media(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, media binary): each whole text in UTF-8 as a JPEG file. A null text counts as empty: one block of zeros.

    Every row is stored on its own: rows and ids may repeat or be null, equal texts give equal files. Other columns are
    ignored; an empty table gives no rows.
    """

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            for a, z in _slices(texts):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), pa.array(encode_many(texts[a:z]), pa.binary())], names=["id", "media"])

    source = df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    return source.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, media binary").withColumnRenamed("id", id_col)


def media_features(df: DataFrame, id_col: str = "doc_id", media_col: str = "media", payload: bool = False) -> DataFrame:
    """(id, width, height, thumbnail binary, thumbnail_hash[, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256]).

    Works for any baseline JPEG; with ``payload`` also the digests of bytes that store_media put there. A null
    or unreadable file gives nulls, and its size and hash where it has any.
    """
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, width int, height int, thumbnail binary, thumbnail_hash string"
    if payload:
        schema += ", n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string"
    types = [pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = [x.strip().split()[0] for x in schema.split(",")]

    def row(data: bytes | None, image: dict | None) -> tuple:
        stored = (None, None) if data is None else (len(data), hashlib.sha256(data).hexdigest())
        if image is None:
            return (None,) * 8 + stored
        small = thumbnail(image)
        out = (image["width"], image["height"], small.tobytes(), thumbnail_hash(small))
        if not payload:
            return out
        try:
            held, n = payload_of(image)
        except (KeyError, ValueError):  # not written by store_media
            return (*out, None, None, None, None, *stored)
        return (*out, n, len(held), hashlib.sha256(held).hexdigest(), zlib.crc32(held[-64:]), *stored)

    def run(batches):
        for b in batches:
            files = b.column(1).to_pylist()
            for a, z in _slices([x or b"" for x in files]):
                part = files[a:z]
                rows = [row(x, image)[: len(names) - 1] for x, image in zip(part, decode_many([x or b"" for x in part]), strict=True)]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=False)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), *columns], names=names)

    return df.select(F.col(id_col).alias("id"), F.col(media_col).alias("media")).mapInArrow(run, schema).withColumnRenamed("id", id_col)
