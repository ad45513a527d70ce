"""Numpy kernels over Arrow text: words, word hashes and shingle hashes.

Whole record batches are handled at once; texts are worked through in pieces of
about a megabyte (a long text is cut at white space), so the working memory does
not grow with a text.  Hashes are 64-bit: a polynomial over the bytes of a word
followed by the splitmix64 finalizer."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BASE = U(0x9E3779B97F4A7C15 | 1)
BASE_INV = U(pow(int(BASE), -1, 1 << 64))
PIECE = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_POW = [np.ones(1, U), np.ones(1, U)]


def _powers(n: int):
    """BASE**i and BASE**-i for i < n (grown on demand, kept per worker)."""
    if len(_POW[0]) < n:
        size = max(n, PIECE + 4096)
        with np.errstate(over="ignore"):
            for k, b in ((0, BASE), (1, BASE_INV)):
                steps = np.full(size, b, U)
                steps[0] = 1
                _POW[k] = np.multiply.accumulate(steps)
    return _POW[0][:n], _POW[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finalizer (public constants)."""
    with np.errstate(over="ignore"):
        x = x + U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def text_buffers(arr) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string array; nulls are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return off - off[0], data[off[0]:off[-1]]


def _pieces(off: np.ndarray, data: np.ndarray):
    """Cut points: text starts, and white space inside texts longer than a piece."""
    at, n = 0, len(data)
    while at < n:
        if n - at <= PIECE:
            yield at, n
            return
        k = int(np.searchsorted(off, at + PIECE, "right")) - 1
        end = int(off[k])
        if end <= at:                        # one long text: cut it at white space
            nxt = int(off[k + 1]) if k + 1 < len(off) else n
            end, look = nxt, at + PIECE
            while look < nxt:
                hit = np.flatnonzero(SPACE[data[look:min(look + 65536, nxt)]])
                if len(hit):
                    end = look + int(hit[0])
                    break
                look += 65536
        yield at, end
        at = end


def word_spans(off: np.ndarray, data: np.ndarray):
    """Start and end byte of every word, and the first word of each text."""
    starts, ends = [], []
    for a, b in _pieces(off, data):
        w = ~SPACE[data[a:b]]
        first = w.copy()
        first[1:] &= ~w[:-1]
        i, j = np.searchsorted(off, [a, b])
        cut = off[i:j] - a                   # a text always begins a new word
        cut = cut[cut < b - a]
        first[cut] = w[cut]
        last = w.copy()
        last[:-1] &= ~w[1:] | first[1:]
        starts.append(np.flatnonzero(first) + a)
        ends.append(np.flatnonzero(last) + a + 1)
    s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    e = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    return s, e, np.searchsorted(s, off)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span (spans ordered, not overlapping)."""
    out = np.zeros(len(starts), U)
    k, n = 0, len(starts)
    with np.errstate(over="ignore"):
        while k < n:
            a = int(starts[k])
            m = max(k + 1, int(np.searchsorted(ends, a + PIECE, "right")))
            d = data[a:int(ends[m - 1])].astype(U) + U(1)
            p, q = _powers(len(d) + 1)
            d *= p[:-1]
            c = np.zeros(len(d) + 1, U)
            np.cumsum(d, out=c[1:])
            s, e = starts[k:m] - a, ends[k:m] - a
            out[k:m] = (c[e] - c[s]) * q[s] + (e - s).astype(U)
            k = m
    return mix(out)


def word_hashes(arr, lower: bool = True):
    """Hashes of all words of a text column and, per text, its first word (n + 1 marks)."""
    off, data = text_buffers(arr)
    if lower:
        data = LOWER[data]
    s, e, first = word_spans(off, data)
    return span_hashes(data, s, e), first


_MULT = mix(np.arange(1, 65, dtype=U)) | U(1)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k consecutive words at every position (texts not told apart)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    acc = np.zeros(n, U)
    with np.errstate(over="ignore"):
        for i in range(k):
            acc += words[i:i + n] * _MULT[i]
    return mix(acc)


def shingle_sets(words: np.ndarray, first: np.ndarray, k: int):
    """For each text, the sorted distinct hashes of its k-word shingles; a text of
    fewer words has its whole word sequence as the only one."""
    grams = gram_hashes(words, k)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            yield np.unique(grams[a:b - k + 1])
        elif b > a:
            yield gram_hashes(words[a:b], b - a) ^ U(b - a)
        else:
            yield np.zeros(0, U)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def list_array(parts, kind=pa.int64()):
    """Arrow list array from numpy arrays."""
    n = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    off = np.zeros(len(parts) + 1, np.int32)
    off[1:] = np.cumsum(n)
    flat = np.concatenate(parts) if len(parts) else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat, kind))


def slices(batch: pa.RecordBatch, column: str, size: int = 4 * PIECE):
    """Row ranges of a batch holding about ``size`` bytes of text each."""
    off, _ = text_buffers(batch.column(batch.schema.get_field_index(column)))
    a, n = 0, batch.num_rows
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + size, "right")) - 1)
        yield batch.slice(a, min(b, n) - a)
        a = b
