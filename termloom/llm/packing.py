"""Small integers as compressed bytes, and columns of a slice as one binary value."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_HEAD = 9  # a byte for the width, eight for the length


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0, in the narrowest type that holds them, byte planes apart, compressed."""
    narrow = values.astype(np.min_scalar_type(int(values.max(initial=0))))
    planes = narrow.view(np.uint8).reshape(len(narrow), narrow.itemsize).T
    head = bytes([narrow.itemsize]) + len(narrow).to_bytes(8, "little")
    return head + pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    width, n = data[0], int.from_bytes(data[1:_HEAD], "little")
    raw = pa.decompress(data[_HEAD:], width * n, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(n).astype(np.int64)


def pack_text(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpack_text(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def pack_rows(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(rows)
    return sink.getvalue().to_pybytes()


def unpack_rows(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()
