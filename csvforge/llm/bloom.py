"""A Bloom filter over 64-bit keys, built by a bitwise aggregate.

Its size is a parameter: where the keys outgrow it, it lets more rows pass, and the
exact join behind it still decides.  ``bits_for`` gives eight bits a key within bounds."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 25
MOST_BITS = 28                # 32 MiB in every worker
PROBES = 4
SLICE = 1 << 16
U = np.uint64


def _cells(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    with np.errstate(over="ignore"):
        return [((keys >> U(16 * j)) * U(0x9E3779B97F4A7C15) >> U(64 - bits)).astype(np.int64) for j in range(PROBES)]


def bits_for(n: int) -> int:
    """Bits of a filter of ``n`` keys that few others pass."""
    return min(MOST_BITS, max(FILTER_BITS, (8 * n - 1).bit_length()))


def key_filter(keys: DataFrame, column: str = "key", bits: int = FILTER_BITS) -> np.ndarray:
    """Words of the filter of a long column (at most 2**bits bits reach the driver)."""
    def run(it):
        words = np.zeros(1 << (bits - 6), np.int64)
        for batch in it:
            c = np.concatenate(_cells(batch.column(0).to_numpy().view(U), bits))
            np.bitwise_or.at(words, c >> 6, np.left_shift(np.int64(1), c & 63))
        hit = np.flatnonzero(words)
        for at in range(0, len(hit), SLICE):
            w = hit[at:at + SLICE]
            yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(words[w])], names=["w", "v"])

    got = (keys.select(column).mapInArrow(run, "w long, v long").groupBy("w")
           .agg(F.expr("bit_or(v)").alias("v")).toArrow())
    out = np.zeros(1 << (bits - 6), np.int64)
    out[got["w"].to_numpy()] = got["v"].to_numpy()
    return out


def passes(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which uint64 keys may be in the filter."""
    seen = np.ones(len(keys), bool)
    for c in _cells(keys, int(len(words) * 64).bit_length() - 1):
        seen &= ((words[c >> 6] >> (c & 63)) & 1).astype(bool)
    return seen
