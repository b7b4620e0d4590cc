"""Record files as TensorFlow writes them, read and written without it.

A file is a sequence of records: length (8 bytes), masked CRC-32C of it, the bytes, masked CRC-32C of them. A record is
an ``Example``: a map from feature names to lists of bytes, floats or integers, in protocol buffer encoding.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from framemill.sources.files import filesystem, walk

EXAMPLE = "file string, record bigint, features map<string, struct<kind: string, bytes: array<binary>, floats: array<float>, ints: array<bigint>>>"
# Kinds of lists by their field number; the polynomial and the mask of checksums.
KINDS = {1: "bytes", 2: "floats", 3: "ints"}
POLYNOMIAL, MASK = 0x82F63B78, 0xA282EAD8


class RecordError(ValueError):
    """A file that isn't a whole sequence of records."""


@lru_cache(maxsize=1)
def _crc_table() -> list[int]:
    table = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (POLYNOMIAL if value & 1 else 0)
        table.append(value)
    return table


def masked_crc(data: bytes) -> int:
    """The checksum that records carry."""
    table, crc = _crc_table(), 0xFFFFFFFF
    for byte in data:
        crc = table[(crc ^ byte) & 255] ^ (crc >> 8)
    crc ^= 0xFFFFFFFF
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def records(read: object, verify: bool) -> Iterator[bytes]:
    """The records of an open file, one at a time; lengths are always checked against their sums, contents if ``verify``."""
    while head := read(12):
        if len(head) < 12 or masked_crc(head[:8]) != struct.unpack("<I", head[8:])[0]:
            raise RecordError("a record's length is damaged")
        (size,) = struct.unpack("<Q", head[:8])
        body = read(size + 4)
        if len(body) < size + 4:
            raise RecordError("a record is cut short")
        if verify and masked_crc(body[:size]) != struct.unpack("<I", body[size:])[0]:
            raise RecordError("a record's content is damaged")
        yield body[:size]


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int, object]]:
    """(number, wire type, value) of each field of a message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            value, at = _varint(data, at)
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            value, at = data[at : at + size], at + size
        elif wire == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            raise RecordError(f"wire type {wire}")
        yield number, wire, value


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def parse_example(data: bytes) -> dict[str, tuple[str, list]]:
    """``{name: (kind, values)}`` of an Example; a feature without a list has the kind ``none``."""
    out: dict[str, tuple[str, list]] = {}
    for number, _, features in _fields(data):
        if number != 1:
            continue
        for _, _, entry in _fields(features):
            parts = {n: v for n, _, v in _fields(entry)}
            kind, values = "none", []
            for list_number, _, body in _fields(parts.get(2, b"")):
                kind = KINDS.get(list_number, "none")
                for n, wire, value in _fields(body):
                    if n != 1:
                        continue
                    if kind == "bytes":
                        values.append(value)
                    elif kind == "floats":
                        values += np.frombuffer(value, "<f4").tolist()  # packed or one at a time
                    elif wire == 0:
                        values.append(_signed(value))
                    else:
                        at = 0
                        while at < len(value):
                            one, at = _varint(value, at)
                            values.append(_signed(one))
            out[parts[1].decode()] = (kind, values)
    return out


def _packed(value: int) -> bytes:
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes(out) + bytes([value])


def _sized(number: int, data: bytes) -> bytes:
    return _packed(number << 3 | 2) + _packed(len(data)) + data


def make_example(features: dict[str, tuple[str, list]]) -> bytes:
    """An Example of ``{name: (kind, values)}``."""
    entries = b""
    for name, (kind, values) in sorted(features.items()):
        if kind == "bytes":
            body = _sized(1, b"".join(_sized(1, v) for v in values))
        elif kind == "floats":
            body = _sized(2, _sized(1, np.asarray(values, "<f4").tobytes()))
        else:
            body = _sized(3, _sized(1, b"".join(_packed(int(v)) for v in values)))
        entries += _sized(1, _sized(1, name.encode()) + _sized(2, body))
    return _sized(1, entries)


def framed(data: bytes) -> bytes:
    """A record with its length and checksums."""
    head = struct.pack("<Q", len(data))
    return head + struct.pack("<I", masked_crc(head)) + data + struct.pack("<I", masked_crc(data))


def read_examples(spark: SparkSession, root: str, suffix: str = "", verify: bool = True) -> DataFrame:
    """``file, record, features`` of every record of the files under ``root``; a file is read by one task, a record at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = filesystem(root)
        kind = pa.map_(pa.string(), pa.struct([("kind", pa.string()), ("bytes", pa.list_(pa.binary())), ("floats", pa.list_(pa.float32())), ("ints", pa.list_(pa.int64()))]))
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with system.open_input_stream(f"{base}/{path}") as f:
                    for i, data in enumerate(records(f.read, verify)):
                        row = [(n, {"kind": k, "bytes": v if k == "bytes" else None, "floats": v if k == "floats" else None, "ints": v if k == "ints" else None}) for n, (k, v) in parse_example(data).items()]
                        yield pa.record_batch([pa.array([path]), pa.array([i], pa.int64()), pa.array([row], kind)], names=["file", "record", "features"])

    return walk(spark, root, suffix).select("path").repartition("path").mapInArrow(read, EXAMPLE)


def write_examples(df: DataFrame, root: str) -> DataFrame:
    """``file, n_records``: a file for each partition of ``df``, a record a row; columns are integers, floats, texts, bytes, or arrays of them.

    Nulls make a feature without values. Files appear whole; the result must be acted on for them to appear.
    """
    names, kinds = df.columns, [_kind(t) for _, t in df.dtypes]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = filesystem(root)
        system.create_dir(base, recursive=True)
        name, n = f"{uuid.uuid4().hex}.tfrecord", 0
        with system.open_output_stream(f"{base}/.{name}") as f:
            for batch in batches:
                for row in batch.to_pylist():
                    features = {c: (k, [x.encode() if isinstance(x, str) else x for x in (v if isinstance(v, list) else [] if v is None else [v])]) for c, k, v in zip(names, kinds, (row[c] for c in names), strict=True)}
                    f.write(framed(make_example(features)))
                    n += 1
        if n:
            system.move(f"{base}/.{name}", os.path.join(base, name))
            yield pa.record_batch([pa.array([name]), pa.array([n], pa.int64())], names=["file", "n_records"])
        else:
            system.delete_file(f"{base}/.{name}")

    return df.mapInArrow(write, "file string, n_records bigint")


def _kind(kind: str) -> str:
    kind = kind.removeprefix("array<").removesuffix(">")
    return {"string": "bytes", "binary": "bytes", "float": "floats", "double": "floats"}.get(kind, "ints")
