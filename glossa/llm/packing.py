"""Arrays and strings of many rows as one compressed value."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def pack(arrays: list[np.ndarray], strings: pa.Array) -> dict:
    """Arrays and an array of strings as one compressed value with its sizes."""
    lens = pc.binary_length(strings).to_numpy(zero_copy_only=False).astype(np.int32)
    data = strings.buffers()[2]
    lo = int(np.frombuffer(strings.buffers()[1], np.int32)[strings.offset]) if len(strings) else 0
    text = data.slice(lo, int(lens.sum(dtype=np.int64))).to_pybytes() if data is not None else b""
    raw = b"".join([*(a.tobytes() for a in arrays), lens.tobytes(), text])
    return {"packed": pa.compress(raw, "zstd", asbytes=True), "size": len(raw),
            "counts": [*map(len, arrays), len(lens)]}


def unpack(packed: bytes, size: int, counts: list[int], kinds: list) -> list:
    """The arrays of :func:`pack`, of the given types, and the strings."""
    raw = pa.decompress(packed, size, "zstd", asbytes=True) if size else b""
    out, at = [], 0
    for n, kind in zip(counts, [*kinds, np.int32]):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    lens = out.pop()
    offsets = np.append(0, np.cumsum(lens)).astype(np.int32)
    strings = pa.StringArray.from_buffers(len(lens), pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw[at:]))
    return [*out, strings]


PACKED = [("packed", pa.binary()), ("size", pa.int64()), ("counts", pa.list_(pa.int64()))]
PACKED_SQL = "packed binary, size long, counts array<long>"


def record(rows: list[dict], fields) -> pa.RecordBatch:
    schema = pa.schema(fields)
    return pa.RecordBatch.from_pydict({n: [r[n] for r in rows] for n in schema.names}, schema=schema)


def rows_of(batches):
    """The rows of Arrow batches as dictionaries, one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def spans(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every span, one after the other."""
    ends = np.cumsum(lens)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lens), lens)
