"""Arrays of a unit of texts as one compressed value.

A unit's arrays are far too long for columns: readers take thousands of rows at once. As
one binary value a unit is moved and stored in a few bytes per token.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

_OPTIONS = pa.ipc.IpcWriteOptions(compression="zstd")
_CODEC = pa.Codec("zstd")


def pack(**arrays: np.ndarray | list) -> bytes:
    """Named arrays as compressed bytes."""
    values = {name: pa.array(array) for name, array in arrays.items()}
    lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in values.values()]
    batch = pa.RecordBatch.from_arrays(lists, names=list(values))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=_OPTIONS) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes | None) -> dict[str, np.ndarray]:
    """The arrays of ``pack``; none of nothing."""
    if data is None:
        return {}
    batch = pa.ipc.open_stream(data).read_next_batch()
    return {name: batch.column(i)[0].values.to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names)}


def narrow(values: np.ndarray) -> np.ndarray:
    """The same whole numbers in 32 bits where all fit."""
    return values.astype(np.int32) if not len(values) or max(-int(values.min()), int(values.max())) < 1 << 31 else values


def pack_keys(keys: np.ndarray) -> np.ndarray:
    """Ascending 64-bit keys as bytes that compress well: all first bytes of the gaps, then all second ones."""
    gaps = np.diff(keys.view(np.uint64), prepend=np.uint64(0))
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).ravel()


def unpack_keys(data: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(data.reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def shrink(**arrays: np.ndarray) -> bytes:
    """Named arrays of whole numbers or flags in fewer bytes than ``pack``, above all where they are short.

    Of numbers, the least is stored apart; of the differences from it, all lowest bytes come
    first, then all second ones, as many as the largest needs.
    """
    head, body = [struct.pack("<B", len(arrays))], []
    for name, array in arrays.items():
        kind, low, width = {"bool": 0, "uint8": 1}.get(array.dtype.name, 2), 0, 1
        if kind < 2:
            body.append(array.tobytes())
        elif len(array):
            low, high = int(array.min()), int(array.max())
            width = ((high - low).bit_length() + 7) // 8
            size = next(size for size in (1, 2, 4, 8) if size >= width)
            rest = (array - low if low else array).astype(f"<u{size}", order="C")
            body.append(np.ascontiguousarray(rest.view(np.uint8).reshape(-1, size)[:, :width].T).tobytes())
        label = name.encode()
        head.append(struct.pack("<BBBqq", len(label), kind, width, low, len(array)) + label)
    data = b"".join(head + body)
    return struct.pack("<q", len(data)) + _CODEC.compress(data, asbytes=True)


def grow(data: bytes) -> dict[str, np.ndarray]:
    """The arrays of ``shrink``; numbers in 64 bits."""
    raw = _CODEC.decompress(memoryview(data)[8:], struct.unpack_from("<q", data)[0], asbytes=True)
    at, fields, out = 1, [], {}
    for _ in range(raw[0]):
        length, kind, width, low, count = struct.unpack_from("<BBBqq", raw, at)
        at += struct.calcsize("<BBBqq") + length
        fields.append((raw[at - length:at].decode(), kind, width, low, count))
    for name, kind, width, low, count in fields:
        planes = np.frombuffer(raw, np.uint8, width * count, at)
        at += width * count
        if kind < 2:
            out[name] = planes.astype(bool) if kind == 0 else planes
            continue
        size = next(size for size in (1, 2, 4, 8) if size >= width)
        rest = np.zeros((count, size), np.uint8)
        rest[:, :width] = planes.reshape(width, count).T
        out[name] = rest.view(f"<u{size}").ravel().astype(np.int64)
        if low:
            out[name] += low
    return out
