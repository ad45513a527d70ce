"""Task-side byte scanning helpers (numpy / plain Python, no Spark).

They run inside ``mapInPandas`` tasks that Spark schedules one per chunk.
"""
from __future__ import annotations

from typing import NamedTuple

import numpy as np

LF, CR = 0x0A, 0x0D
READ_BLOCK = 1 << 20
TAIL_BLOCK = 1 << 14       # first read when the end of one record is searched
WINDOW_HEAD = 1 << 13     # bytes of a window that are searched for a split point first
MAX_LINE_BYTES = 1 << 30   # a longer line cannot become one Spark string anyway


FIELD, PLAIN, QUOTED, SEEN, SPACED = range(5)      # states of a CSV reader between two bytes
STATES = range(5)


class Dialect(NamedTuple):
    """What a byte scan needs to know: ``rec`` is the byte that ends a record, or None for
    LF, CR and CRLF alike."""
    quote: int
    sep: int
    rec: int | None = None
    trim: bool = True


def terminators(data: bytes, arr: np.ndarray, after: bytes, rec: int | None) -> np.ndarray:
    """Positions of the bytes that end a line; of CR LF that is the LF.  ``after`` is what
    stands behind the buffer (empty at the end of the file)."""
    if rec is not None:
        return np.flatnonzero(arr == rec)
    lf = np.flatnonzero(arr == LF)
    if b"\r" not in data:
        return lf
    cr = np.flatnonzero(arr == CR)
    following = np.append(arr, np.frombuffer(after[:1] or b"\x00", np.uint8))[cr + 1]
    return np.sort(np.concatenate([lf, cr[following != LF]]))


class Scan:
    """One buffer read by the field automaton of a CSV parser, for any state at its start.

    FIELD: at a field's start (blanks before a quote are skipped when ``trim``); a quote
    here opens a quoted field.  PLAIN: in an unquoted field, where quotes are ordinary
    characters.  QUOTED: inside quotes.  SEEN: behind a quote inside quotes; one more quote
    is an escaped quote, a delimiter or line end closes the field, anything else turns the
    rest of the field into unquoted text.  SPACED: blanks behind a closing quote.

    Bytes are not walked one by one.  Between two runs of adjacent quotes only one bit is
    carried (inside quotes or not), and every run acts on it as one of three functions:
    a run of odd length toggles it where a quoted field may open, and clears it elsewhere
    (only a closing quote can stand there); a run of even length keeps it.  So the bit
    after a run is the parity of the toggles since the last clearing run."""

    def __init__(self, data: bytes, after: bytes, d: Dialect):
        self.d, self.arr = d, np.frombuffer(data, dtype=np.uint8)
        self.after = after[0] if after else 0
        self.terms = terminators(data, self.arr, after, d.rec)
        self.last_cut = max(data.rfind(bytes([d.sep])), int(self.terms[-1]) if self.terms.size else -1)
        quotes = np.flatnonzero(self.arr == d.quote) if bytes([d.quote]) in data else np.zeros(0, np.int64)
        self.n = 0
        if quotes.size:
            self._runs(quotes)

    def _runs(self, quotes: np.ndarray) -> None:
        first = np.flatnonzero(np.append(True, np.diff(quotes) != 1))
        size = np.diff(np.append(first, quotes.size))
        self.n, self.begin = len(first), quotes[first]
        self.stop, self.odd = self.begin + size, (size & 1) == 1
        cut = self.arr == self.d.sep
        cut[self.terms] = True
        cuts = np.append(-1, np.flatnonzero(cut))
        before = cuts[np.searchsorted(cuts, self.begin) - 1]       # delimiter or line end before each run
        since = np.append(0, self.stop[:-1])
        self.fresh = before >= since                               # ... that follows the run before
        low = np.where(self.fresh, before + 1, since)
        self.near = self._blank(low, self.begin)                   # nothing but blanks in between
        opens = self.fresh & self.near
        toggle, clear = self.odd & opens, self.odd & ~opens
        toggle[0] = clear[0] = False                               # the first run depends on the start state
        total = np.cumsum(toggle)
        last = np.maximum.accumulate(np.where(clear, np.arange(self.n), 0))
        self.free = last == 0                                      # no clearing run since the first one
        self.bit = ((total - total[last]) & 1).astype(bool)
        self.opens = opens
        self.run_of = np.searchsorted(self.begin, self.terms) - 1

    def _blank(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether the bytes [low, high) are blanks that may precede a quote."""
        out = low == high
        if self.d.trim:
            unsure = np.flatnonzero(~out & (self.arr[high - 1] <= 0x20))
            if unsure.size:
                solid = np.append(-1, np.flatnonzero(self.arr > 0x20))
                out[unsure] = solid[np.searchsorted(solid, high[unsure]) - 1] < low[unsure]
        return out

    def _first(self, start: int) -> tuple[bool, bool, bool]:
        """Of the first run: the bit before it, whether it may open a field, the bit behind it."""
        opens = bool(self.near[0]) and (bool(self.fresh[0]) or start == FIELD)
        bit, odd = start == QUOTED, bool(self.odd[0])
        if start == SEEN and self.begin[0] == 0:                   # the run began before this buffer
            bit, odd = True, not odd
        return bit, opens, (not odd) if bit else (odd and opens)

    def bits(self, start: int) -> np.ndarray:
        """Behind every run: inside quotes or not."""
        return self.bit ^ (self.free & self._first(start)[2])

    def inside(self, start: int) -> np.ndarray:
        """For every line end: whether it lies inside quotes."""
        if not self.n:
            return np.full(len(self.terms), start == QUOTED)
        bits = np.append(self.bits(start), start == QUOTED)         # index -1: before the first run
        return bits[self.run_of]

    def spaced(self, start: int) -> int:
        """Closing quotes with a blank behind them."""
        at = np.zeros(1 if start == SEEN else 0, np.int64)          # a quote closed before this buffer, if none follows
        if self.n:
            bits, (before, opens, _) = self.bits(start), self._first(start)
            behind = np.append(before, bits[:-1])
            opened = np.append(opens, self.opens[1:])
            closing = ~bits & (behind | (opened & ~self.odd))
            at = np.append(at, self.stop[closing])
        at = at[at < len(self.arr)]
        byte = self.arr[at]
        blank = (byte <= 0x20) & (byte != self.d.sep) & (byte != LF if self.d.rec is None else byte != self.d.rec)
        pair = at[blank & (byte == CR)]                            # CRs before an LF, and those that end a line
        following = np.append(self.arr, self.after)[pair + 1]
        return int(blank.sum()) - int(((following == LF) | (self.d.rec is None)).sum())

    def ends(self, start: int) -> np.ndarray:
        """Offsets just after every line end that ends a record."""
        return self.terms[~self.inside(start)].astype(np.int64) + 1

    def state(self, start: int) -> int:
        """State behind the buffer."""
        state, low = start, 0
        if self.n:
            bits = self.bits(start)
            if bits[-1]:
                return QUOTED
            before, opens, _ = self._first(start)
            if self.n > 1:
                before, opens = bool(bits[-2]), bool(self.opens[-1])
            state, low = SEEN if before or opens else PLAIN, int(self.stop[-1])
        if state == QUOTED:
            return QUOTED
        if self.last_cut >= low:
            state, low = FIELD, self.last_cut + 1
        if low == len(self.arr):
            return state
        if state == PLAIN or bool((self.arr[low:] > 0x20).any()):
            return PLAIN
        if state == FIELD:
            return FIELD if self.d.trim else PLAIN
        return SPACED


def transitions(f, start: int, end: int, d: Dialect) -> tuple[list[int], list[int], int]:
    """The bytes [start, end) as a function of the state before them: the state behind them
    and, for every start state, how often a reader of single lines may go wrong (a line end
    inside quotes, or a blank behind a closing quote, which the CSV parser reads
    differently at the end of its input); and the CRs that end no line."""
    states, unsafe, lone, pos = list(STATES), [0] * len(STATES), 0, start
    while pos < end:
        k = min(READ_BLOCK * 8, end - pos)
        data = f.read_at(k + 1, pos)                # one byte more: CR and LF may be apart
        scan = Scan(data[:k], data[k:], d)
        seen = {s: (scan.state(s), int(scan.inside(s).sum()) + scan.spaced(s)) for s in set(states)}
        unsafe = [n + seen[s][1] for n, s in zip(unsafe, states)]
        states = [seen[s][0] for s in states]
        if d.rec is not None and b"\r" in data:
            following = np.append(scan.arr[1:], np.frombuffer(data[k:] or b"\x00", np.uint8))
            lone += int(((scan.arr == CR) & (following != LF)).sum())
        pos += k
    return states, unsafe, lone


def first_end(f, pos: int, size: int, d: Dialect, state: int, limit: int | None = None) -> int:
    """Absolute offset after the first record end at or after ``pos`` (``state`` = state
    before ``pos``); ``size`` at the end of the file.  Reads start small and grow.  With
    ``limit``, give up (ValueError) after that many bytes."""
    stop, step = size if limit is None else min(size, pos + limit), TAIL_BLOCK
    while pos < stop:
        n = min(step, size - pos)
        data = f.read_at(n + 1, pos)
        scan = Scan(data[:n], data[n:], d)
        ends = scan.ends(state)
        if ends.size:
            return pos + int(ends[0])
        state, pos, step = scan.state(state), pos + n, min(step * 4, READ_BLOCK * 8)
    if stop < size:
        raise ValueError(f"no record end outside quotes within {limit} bytes")
    return size


class LineReader:
    """Line reader over a seekable file: a line ends at LF, CR or CRLF and is
    returned without its terminator; ``pos`` is the offset after it."""

    def __init__(self, f, pos: int, size: int):
        self.f, self.pos, self.size = f, pos, size
        self._buf, self._buf_start = b"", pos

    def _fill(self, at: int) -> bool:
        if at >= self.size:
            return False
        n = min(READ_BLOCK, self.size - at)
        self._buf, self._buf_start = self.f.read_at(n, at), at
        return True

    def _byte(self, at: int):
        rel = at - self._buf_start
        if rel < 0 or rel >= len(self._buf):
            if not self._fill(at):
                return None
            rel = 0
        return self._buf[rel]

    def read_line(self, limit: int | None = None) -> bytes:
        """Next line without its terminator; ValueError past ``limit`` bytes.
        Terminators are found with ``bytes.find`` on buffered blocks."""
        out = bytearray()
        at = self.pos
        while True:
            rel = at - self._buf_start
            if rel < 0 or rel >= len(self._buf):
                if not self._fill(at):
                    self.pos = at
                    return bytes(out)
                rel = 0
            buf, base = self._buf, self._buf_start
            i_lf, i_cr = buf.find(b"\n", rel), buf.find(b"\r", rel)
            hits = [i for i in (i_lf, i_cr) if i >= 0]
            stop = min(hits) if hits else len(buf)
            out += buf[rel:stop]
            if limit is not None and len(out) > limit:
                raise ValueError(f"line at byte {self.pos} is longer than {limit} bytes")
            if not hits:
                at = base + len(buf)
                continue
            if buf[stop] == LF:
                self.pos = base + stop + 1
            else:                                   # CR, maybe followed by LF
                self.pos = base + stop + (2 if self._byte(base + stop + 1) == LF else 1)
            return bytes(out)


def java_split_count(line: bytes, sep: int) -> int:
    """Number of fields ``String.split`` gives for a literal one-byte delimiter:
    trailing empty fields are dropped, and no delimiter at all gives one field."""
    parts = line.split(bytes([sep]))
    if len(parts) == 1:
        return 1
    while parts and parts[-1] == b"":
        parts.pop()
    return len(parts)


OPEN, CLOSED, UNKNOWN = 1, 2, 0


def classify_quotes(arr: np.ndarray, quote: int, sep: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and kinds of all quotes of a buffer.  Only one side of a quote that
    touches a delimiter (or a line or buffer end) tells what it does: delimiter on the
    left OPEN, on the right CLOSED; both, neither or a neighbouring quote UNKNOWN."""
    edge = np.concatenate(([LF], arr, [LF])).astype(np.uint8)
    delimiter = (edge == sep) | (edge == LF) | (edge == CR)
    at = np.flatnonzero(arr == quote)
    left, right = delimiter[at], delimiter[at + 2]
    doubled = (edge[at] == quote) | (edge[at + 2] == quote)
    kinds = np.where(left & ~right, OPEN, np.where(right & ~left, CLOSED, UNKNOWN))
    return at, np.where(doubled, UNKNOWN, kinds)


def _line_table(arr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of every line and of what follows it (lines end at LF, CR or CRLF)."""
    following = np.append(arr[1:], 0)
    stops = np.flatnonzero((arr == LF) | ((arr == CR) & (following != LF))) + 1
    starts = np.concatenate(([0], stops[stops < len(arr)]))
    return starts, np.append(starts[1:], len(arr))


def split_counts(arr: np.ndarray, starts: np.ndarray, ends: np.ndarray, sep: int) -> np.ndarray:
    """Fields of every line, trailing empty ones not counted; an empty line has one."""
    body = (arr != LF) & (arr != CR)
    full = np.concatenate(([-1], np.flatnonzero(body & (arr != sep))))
    last = full[np.searchsorted(full, ends) - 1]                 # last byte that is no delimiter
    seps = np.flatnonzero(arr == sep)
    inner = np.searchsorted(seps, last) - np.searchsorted(seps, starts)
    size = np.add.reduceat(body.astype(np.int64), starts) if len(starts) else starts
    return np.where(last >= starts, inner + 1, np.where(size == 0, 1, 0))


def heuristic_split_point(f, start: int, end: int, size: int, n_headers: int,
                          sep: int, quote: int):
    """First place in ``[start, end)`` that looks like a record boundary, or ``None``.

    All lines that begin behind the first line end are judged at once: a line is a
    record's first if its first quote opens a field, a record's last if its last quote
    closes one; a quote-free line begins a record if it and the quote-free line above it
    have more than ``n_headers + 1`` fields together.  The window's first whole lines
    are judged before the rest of it is read: a line is judged by itself and the one above."""
    if start + WINDOW_HEAD < min(end, size):
        head = f.read_at(WINDOW_HEAD, start)
        point = _first_fit(head[:head.rfind(b"\n") + 1], start, end, n_headers, sep, quote)
        if point is not None:
            return point
    data, step = f.read_at(min(end, size) - start, start), READ_BLOCK
    while start + len(data) < size:                    # finish the line that crosses the window's end
        more = f.read_at(min(step, size - start - len(data)), start + len(data))
        hit = [k for k in (more.find(b"\n"), more.find(b"\r")) if k >= 0]
        data += more[:min(hit) + 2] if hit else more
        if hit or not more:
            break
        if len(data) > MAX_LINE_BYTES + (end - start):
            raise ValueError(f"no line end within {MAX_LINE_BYTES} bytes at byte {start}")
        step *= 2
    return _first_fit(data, start, end, n_headers, sep, quote)


def _first_fit(data: bytes, start: int, end: int, n_headers: int, sep: int, quote: int):
    """:func:`heuristic_split_point` of the lines ``data`` that stand at ``start``."""
    arr = np.frombuffer(data, dtype=np.uint8)
    if not len(arr):
        return None
    starts, ends = _line_table(arr)
    at, kinds = classify_quotes(arr, quote, sep)
    low, high = np.searchsorted(at, starts), np.searchsorted(at, ends)
    quoted = high > low
    pad = np.append(kinds, UNKNOWN)
    opens = quoted & (pad[np.minimum(low, len(kinds))] == OPEN)
    closes = quoted & (pad[np.maximum(high, 1) - 1] == CLOSED)
    fields = split_counts(arr, starts, ends, sep)
    empty = np.isin(arr[starts], (LF, CR))
    plain = np.zeros(len(starts), bool)
    plain[2:] = (~quoted[2:] & ~quoted[1:-1] & ~empty[1:-1]
                 & (fields[2:] + fields[1:-1] > n_headers + 1))
    fit = opens | closes | plain
    fit[0] = False                                     # the window may begin inside this line
    fit &= starts + start < end
    if not fit.any():
        return None
    k = int(np.argmax(fit))
    return start + int(starts[k] if opens[k] or plain[k] else ends[k])


def utf8_lead(data: bytes) -> int:
    """Number of UTF-8 continuation bytes at the start of ``data`` (to skip)."""
    i = 0
    while i < len(data) and i < 3 and (data[i] & 0xC0) == 0x80:
        i += 1
    return i
