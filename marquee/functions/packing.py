"""Arrays of small whole numbers as few bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CODEC = "zstd"
KINDS = (np.uint8, np.uint16, np.uint32, np.uint64)


def packed(arrays: list[np.ndarray]) -> bytes:
    """Arrays of numbers from 0 up, each in the narrowest type that holds it, compressed together."""
    narrow = [a.astype(np.min_scalar_type(int(a.max())) if len(a) else np.uint8) for a in arrays]
    head = np.array([[KINDS.index(a.dtype), len(a)] for a in narrow], dtype="<u4")
    plain = b"".join([head.tobytes(), *[a.tobytes() for a in narrow]])
    return len(plain).to_bytes(8, "little") + pa.compress(plain, codec=CODEC, asbytes=True)


def unpacked(data: bytes, n: int) -> list[np.ndarray]:
    """The ``n`` arrays that ``packed`` was given, as int64."""
    plain = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec=CODEC, asbytes=True)
    head = np.frombuffer(plain, dtype="<u4", count=2 * n).reshape(n, 2)
    found, at = [], head.nbytes
    for kind, size in head.tolist():
        part = np.frombuffer(plain, dtype=KINDS[kind], count=size, offset=at)
        found.append(part.astype(np.int64))
        at += part.nbytes
    return found
