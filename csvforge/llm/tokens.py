"""Operator 7: token counts by batch encoding in Arrow functions.

Texts never leave their partition: each Arrow batch is cut into slices balanced
by bytes, long texts are split at safe boundaries, and only lengths come back.

For a tokenizer that drops white space (``boundary="space"``), a space or line
feed is always a token boundary, so the slices are split there by Arrow, which also
numbers the distinct words of a slice.  Every distinct word is encoded once by the
library itself; a bounded table keeps the words met recently.  New words go to the
library joined by a special token of the vocabulary, whose id marks where one word's
ids end; without such a token, and for words that hold it, one by one.  Words of
letters that the vocabulary's normalizer and splitter treat alike in every word (see
``piece_encoder``) go to the library's model piece by piece, each piece once.  What a text's
words add up to is array code.  Otherwise (``boundary=None``) whole texts are encoded in
byte-balanced batches.  The default is what the vocabulary allows: a file is tried for
dropping white space when it is loaded.

Nulls count as empty texts (0 tokens).  Rows are kept one for one, repeated rows
too; other columns are passed through unread, and a clash with a result name is
resolved in favour of the result.
"""
from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import CACHES, SMALL_BATCH, prepare, table, tidy
from .textnum import PIECE, slices, text_buffers

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048                  # tokens; longer texts are over the limit
BATCH_BYTES = 1 << 20         # bytes of text in one call of the library
WORD_BYTES = 1 << 17          # characters of words in one call of the library
RUN_BYTES = 2 << 20           # text split into words at a time; longer texts go in parts
KEPT_WORDS = 150_000          # words in each of the two generations of the table
LONG_WORD = 64                # longer words are encoded anew each time

_LOADED: dict = {}


def _path(vocabulary: str) -> str:
    if os.path.isabs(vocabulary):
        return vocabulary
    import public_tokenizers
    return public_tokenizers.path(vocabulary)


def load(vocabulary: str):
    """``encode(list of str) -> list of id lists`` of a vocabulary file (a path, or
    the name of one of the installed public files)."""
    if vocabulary not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = _path(vocabulary)
        if path.endswith(".model"):
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            _LOADED[vocabulary] = lambda texts: sp.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer
            tk = Tokenizer.from_file(path)
            tk.no_truncation()
            tk.no_padding()
            _LOADED[vocabulary] = lambda texts: [e.ids for e in tk.encode_batch_fast(
                texts, add_special_tokens=False)]
    return _LOADED[vocabulary]


def batches(texts: list[str], size: int = BATCH_BYTES):
    """Consecutive runs of texts holding about ``size`` characters each."""
    run, n = [], 0
    for t in texts:
        run.append(t)
        n += len(t) + 1
        if n >= size:
            yield run
            run, n = [], 0
    if run:
        yield run


def _parts(text: str, size: int):
    """A text in parts of about ``size`` characters, cut at spaces or line feeds."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(" ", at, at + size), text.rfind("\n", at, at + size))
        if cut < 0:
            after = [k for k in (text.find(" ", at + size), text.find("\n", at + size)) if k >= 0]
            if not after:
                break
            cut = min(after)
        yield text[at:cut]
        at = cut + 1
    yield text[at:] if at else text


def separator(vocabulary: str):
    """``(text, id)`` of a special token that can stand between words, or None."""
    key = (vocabulary, "separator")
    if key not in _LOADED:
        encode, found = load(vocabulary), None
        for text, number in _special_tokens(vocabulary):
            a, both, b = encode(["ab", f"ab{text}cd", "cd"])
            if not any(c.isspace() for c in text) and both == [*a, number, *b]:
                found = (text, number)
        _LOADED[key] = found
    return _LOADED[key]


def _special_tokens(vocabulary: str):
    path = _path(vocabulary)
    if path.endswith(".json"):
        from tokenizers import Tokenizer
        for number, token in Tokenizer.from_file(path).get_added_tokens_decoder().items():
            if token.special and not token.normalized and not token.lstrip and not token.rstrip and not token.single_word:
                yield token.content, number


def boundary_of(vocabulary: str) -> str | None:
    """``space`` if the vocabulary drops white space between words, else None."""
    key = (vocabulary, "boundary")
    if key not in _LOADED:
        encode = load(vocabulary)
        one = [encode([w])[0] for w in ("two", "Words,", "3")]
        drops = all(encode([gap.join(("two", "Words,", "3"))])[0] == [i for ids in one for i in ids]
                    for gap in (" ", "\n", "  ", " \n "))
        _LOADED[key] = "space" if drops and not any(encode([" ", "\n"])) else None
    return _LOADED[key]


#: Printable ASCII and the letters of Latin-1: NFC leaves them, they lower one to one, none is white space.
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
PLAIN_RUN = re.compile(PLAIN.pattern.replace("[", "[\\n"))
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|\n|[^a-z\u00df-\u00f6\u00f8-\u00ff0-9\n]+")
STEPS = ({"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]})


def piece_encoder(vocabulary: str):
    """``(encode, special)``: the library's model for one piece of a word (as ``PLAIN_PIECE``
    cuts lowered ``PLAIN`` words, one a line), and the strings that no such word may hold.

    None unless the file's normalizer and splitter are ``STEPS``: what they do to a plain word
    is lowering and that cut, so the library's slow part, tracing every character, is spared."""
    key = (vocabulary, "pieces")
    if key not in _LOADED:
        _LOADED[key] = None
        path = _path(vocabulary)
        if path.endswith(".json"):
            with open(path, encoding="utf-8") as f:
                file = json.load(f)
            model = file["model"]
            if (file["normalizer"], file["pre_tokenizer"]) == STEPS and model["type"] == "BPE" and not model["dropout"]:
                _LOADED[key] = _piece_encoder(path)
    return _LOADED[key]


def _piece_encoder(path: str):
    from tokenizers import Tokenizer, pre_tokenizers
    tk = Tokenizer.from_file(path)
    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    chars = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
    tokenize = tk.model.tokenize

    def encode(piece: str) -> bytes:
        if piece == "\n":                              # the end of a word
            return b""
        return array("I", [t.id for t in tokenize(piece if piece.isascii() else piece.translate(chars))]).tobytes()

    return encode, [t.content for t in tk.get_added_tokens_decoder().values()]


class WordTable(dict):
    """word -> its ids as bytes (32-bit), for the words of the run at hand and recent ones."""

    def __init__(self, vocabulary: str):
        self.vocabulary, self.old, self.pieces = vocabulary, {}, {}

    def values_of(self, words: list[str]) -> list[bytes]:
        if len(self) > KEPT_WORDS:
            self.old = dict(self)
            self.clear()
        got, old = list(map(self.get, words)), self.old
        missing = [i for i, v in enumerate(got) if v is None]
        new = []
        for i in missing:
            v = old.get(words[i])
            if v is None:
                new.append(i)
            else:
                got[i] = self[words[i]] = v
        rest = self._by_piece(words, new, got)
        for i, v in zip(rest, self._encoded([words[i] for i in rest])):
            got[i] = v
        self.update([(words[i], got[i]) for i in new if len(words[i]) <= LONG_WORD])
        return got

    def _by_piece(self, words: list[str], new: list[int], got: list) -> list[int]:
        """Fills in the plain ones of the words ``new`` and returns the others."""
        plain = piece_encoder(self.vocabulary)
        if plain is None:
            return new
        encode, special = plain
        run = "\n".join([words[i] for i in new])
        rest = []
        if not PLAIN_RUN.fullmatch(run) or any(t in run for t in special):
            rest = [i for i in new if not PLAIN.fullmatch(words[i]) or any(t in words[i] for t in special)]
            other = set(rest)
            new = [i for i in new if i not in other]
            run = "\n".join([words[i] for i in new])
        if not new:
            return rest
        cut, pieces = PLAIN_PIECE.findall(run.lower()), self.pieces
        values = list(map(pieces.get, cut))
        made = {p: encode(p) for p in {p for p, v in zip(cut, values) if v is None}}
        values = [made[p] if v is None else v for p, v in zip(cut, values)]
        if len(pieces) > KEPT_WORDS:
            pieces.clear()
        pieces.update(made if max(map(len, made), default=0) <= LONG_WORD else
                      {p: v for p, v in made.items() if len(p) <= LONG_WORD})
        raw, end = b"".join(values), np.cumsum(np.fromiter(map(len, values), np.int64, len(values)))
        at = 0
        for i, e in zip(new, [*end[[k for k, p in enumerate(cut) if p == "\n"]].tolist(), len(raw)]):
            got[i] = raw[at:e]
            at = e
        return rest

    def _encoded(self, words: list[str]):
        encode, sep = load(self.vocabulary), separator(self.vocabulary)
        for run in batches(words, WORD_BYTES):
            if sep is None or any(sep[0] in w for w in run):
                yield from (np.asarray(ids, np.uint32).tobytes() for ids in encode(run))
                continue
            ids = np.asarray(encode([sep[0].join(run)])[0], np.uint32)
            cut = np.flatnonzero(ids == sep[1])
            raw = ids.tobytes()
            yield from (raw[4 * a:4 * b] for a, b in zip([0, *(cut + 1).tolist()], [*cut.tolist(), len(ids)]))


_TABLES: dict = {}
CACHES.append(_TABLES)


def _runs(texts: list[str]):
    """``(owners, parts)``: parts of consecutive texts, together about RUN_BYTES characters."""
    owners, parts, n = [], [], 0
    for i, t in enumerate(texts):
        for p in (_parts(t, RUN_BYTES) if len(t) > RUN_BYTES else (t,)):
            owners.append(i)
            parts.append(p)
            n += len(p) + 1
            if n >= RUN_BYTES:
                yield np.array(owners), parts
                owners, parts, n = [], [], 0
    if parts:
        yield np.array(owners), parts


def _words(parts: list[str], vocabulary: str):
    """Of some parts: word offsets, the number of every word's distinct form, and the forms' ids
    (joined, with their lengths)."""
    flat = pc.replace_substring(pa.array(parts, pa.large_string()), pattern="\n", replacement=" ")
    lists = pc.split_pattern(flat, pattern=" ")
    coded = lists.flatten().dictionary_encode()
    values = _TABLES.setdefault(vocabulary, WordTable(vocabulary)).values_of(coded.dictionary.to_pylist())
    size = np.fromiter(map(len, values), np.int64, len(values)) >> 2
    off = np.asarray(lists.offsets, dtype=np.int64)
    return off - off[0], coded.indices.to_numpy(), values, size


def count_words(texts: list[str], vocabulary: str) -> np.ndarray:
    out = np.zeros(len(texts), np.int64)
    for owners, parts in _runs(texts):
        off, codes, _, size = _words(parts, vocabulary)
        total = np.concatenate(([0], np.cumsum(size[codes])))
        np.add.at(out, owners, total[off[1:]] - total[off[:-1]])
    return out


def encode_words(texts: list[str], vocabulary: str):
    """The ids of every text, in order, as 32-bit arrays."""
    at, kept = 0, []
    for owners, parts in _runs(texts):
        off, codes, values, size = _words(parts, vocabulary)
        begin, n = np.cumsum(size) - size, size[codes]
        total = np.concatenate(([0], np.cumsum(n)))
        ids = np.frombuffer(b"".join(values), np.uint32)
        ids = ids[np.repeat(begin[codes] - total[:-1], n) + np.arange(total[-1])]
        for owner, a, b in zip(owners.tolist(), total[off[:-1]].tolist(), total[off[1:]].tolist()):
            if owner != at:
                yield kept[0] if len(kept) == 1 else np.concatenate(kept)
                at, kept = owner, []
            kept.append(ids[a:b])
    if kept:
        yield kept[0] if len(kept) == 1 else np.concatenate(kept)


AUTO = "auto"


def count_texts(texts: list[str], vocabulary: str, boundary: str | None = AUTO) -> list[int]:
    if boundary == AUTO:
        boundary = boundary_of(vocabulary)
    if boundary == "space":
        return count_words(texts, vocabulary).tolist()
    encode = load(vocabulary)
    return [len(ids) for run in batches(texts) for ids in encode(run)]


def token_counts(df: DataFrame, text: str = "text", vocabulary: str = VOCABULARY,
                 limit: int = LIMIT, boundary: str | None = AUTO,
                 columns: tuple = ("doc_id",)) -> DataFrame:
    """``columns`` of every row with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    One narrow pass, no shuffle; memory is bounded by one Arrow batch and the word
    table.  An empty input gives an empty result."""
    prepare(df.sparkSession, SMALL_BATCH)
    made = {"n_bytes", "n_tokens", "over_limit"}
    keep = [c for c in columns if c.lower() not in made]
    src = df.select(*keep, F.col(text).alias("__text"))
    schema = src.select(*keep).schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")

    def run(it):
        for whole in it:
            for b in slices(whole, "__text", PIECE):
                col = b.column(b.num_columns - 1)
                off, _ = text_buffers(col)
                n = count_texts([t or "" for t in col.to_pylist()], vocabulary, boundary)
                yield pa.RecordBatch.from_arrays(
                    [b.column(i) for i in range(b.num_columns - 1)]
                    + [pa.array(off[1:] - off[:-1], pa.int64()), pa.array(n, pa.int64()),
                       pa.array([x > limit for x in n], pa.bool_())],
                    names=keep + ["n_bytes", "n_tokens", "over_limit"])

    return src.mapInArrow(tidy(run), schema)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


QUERIES = {"op7_token_counts": op7_token_counts}
SQL: dict = {}
