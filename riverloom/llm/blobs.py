"""Arrays of numbers as values of binary columns, in few bytes.

Spark holds several copies of a row while it is written, read, sorted or sent to a worker, so a
row of some MB weighs many times as much in an executor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_CODEC = pa.Codec("zstd", 1)


def packed(values: np.ndarray) -> bytes:
    """Numbers from 0 on, each in as few bytes as the largest needs (how many comes first)."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return bytes([kind.itemsize]) + values.astype(kind.newbyteorder("<")).tobytes()


def unpacked(blob: bytes, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[0]}", offset=1).astype(kind)


def squeezed(values: np.ndarray) -> bytes:
    """The same for many small numbers, compressed (behind the size before)."""
    raw = packed(values)
    return len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True)


def unsqueezed(blob: bytes) -> np.ndarray:
    return unpacked(_CODEC.decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True))
