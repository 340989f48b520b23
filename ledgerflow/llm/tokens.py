"""Token ids and token counts of whole texts (operator 10, and the token source of packing).

Texts are cut at *safe boundaries*: in front of a space between two characters that are no
white space.  Both supported pre-tokenizers always end a piece there, so the ids of a text are
the ids of its parts in order, whatever the parts are batched with.  Parts repeat a lot, so a
worker encodes each distinct part once and keeps what it got in a bounded table.  Batches for
the encoder are balanced by bytes, and a long text is cut into slices of bounded size.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_batches

#: A safe boundary; Python's \S is never true where a tokenizer sees white space.
SAFE = re.compile(r"(?<=\S)(?= )")
#: Entries at which a worker's table of encoded parts keeps only its short parts (or none).
TABLE_ENTRIES = 600_000
SHORT_PART = 8
#: Characters of text taken at a time, and of parts for one call of the encoder.
SLICE_CHARS = 1 << 20
BATCH_CHARS = 1 << 20
#: Pieces of letters below this are cut alike by both libraries that read the byte-level file.
PLAIN_BELOW = "\u0250"


def slices(text: str, size: int = SLICE_CHARS) -> Iterator[str]:
    """``text`` in runs of about ``size`` characters that end at safe boundaries."""
    at = 0
    while len(text) - at > size:
        cut = SAFE.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def parts_of(text: str) -> list[str]:
    """``text`` cut at all its safe boundaries."""
    parts = text.split(" ")
    if "" in parts or any(p[0].isspace() or p[-1].isspace() for p in parts):
        return SAFE.split(text)
    return [parts[0], *[" " + p for p in parts[1:]]]


def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def trimmed(known: dict) -> None:
    """Makes room: keeps the short parts, which are the frequent ones, unless those fill the table."""
    short = {k: v for k, v in known.items() if len(k) <= SHORT_PART}
    known.clear()
    if len(short) <= TABLE_ENTRIES // 2:
        known.update(short)


class LengthEncoder:
    """Numbers of tokens by batch encoding of the parts that are not known yet."""

    def __init__(self, path: str):
        self.tokenizer = library(path)
        self.known: dict[str, int] = {}

    def _learn(self, parts: list[str]) -> None:
        at = 0
        while at < len(parts):
            end, size = at, 0
            while end < len(parts) and (size == 0 or size + len(parts[end]) <= BATCH_CHARS):
                size += len(parts[end])
                end += 1
            encoded = self.tokenizer.encode_batch_fast(parts[at:end], add_special_tokens=False)
            self.known.update(zip(parts[at:end], map(len, encoded), strict=True))
            at = end

    def counts(self, texts: list[str]) -> list[int]:
        totals, batch, size = [0] * len(texts), [], 0
        for k, text in enumerate(texts):
            for part in slices(text) if text else ():
                batch.append((k, part))
                size += len(part)
                if size >= SLICE_CHARS:
                    self._add(batch, totals)
                    batch, size = [], 0
        self._add(batch, totals)
        return totals

    def _add(self, batch: list[tuple[int, str]], totals: list[int]) -> None:
        cut = [(k, parts_of(text)) for k, text in batch]
        new = {p for _, parts in cut for p in parts}.difference(self.known)
        if len(self.known) + len(new) > TABLE_ENTRIES:
            trimmed(self.known)
            new = {p for _, parts in cut for p in parts}.difference(self.known)
        self._learn(list(new))
        for k, parts in cut:
            totals[k] += sum(map(self.known.__getitem__, parts))


class Irregular(Exception):
    """A text's spaces are not all safe boundaries."""


class IdEncoder(dict):
    """Ids of a byte-level file as little-endian bytes; the entries are the words known so far,
    each for a space and the word.

    ``tokenizers`` defines the ids.  The file's vocabulary is in the order of its merges, so
    merging by rank gives the same ids several times faster; this is used for parts of plain
    letters without special strings, and the library for all others.
    """

    def __init__(self, path: str):
        import tiktoken

        self.tokenizer = library(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = [s[:2] for s in special]
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = "<u2" if size <= 1 << 16 else "<u4"
        unshown = {c: bytes([b]) for b, c in enumerate(byte_letters())}
        ranks = {b"".join(map(unshown.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.ranked = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, part: str) -> bytes:
        import numpy as np

        if part and max(part) < PLAIN_BELOW and not any(s in part for s in self.special):
            ids = self.ranked.encode_ordinary(part)
        else:
            ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        return np.array(ids, dtype=self.width).tobytes()

    def __missing__(self, word: str) -> bytes:
        if not word or word[-1].isspace():
            raise Irregular
        if len(self) >= TABLE_ENTRIES:
            trimmed(self)
        self[word] = got = self.encode(" " + word)
        return got

    def _slice(self, text: str) -> bytes:
        words = text.split(" ")
        head = words[0]
        if head[-1:].isspace() or len(words) == 1:
            return b"".join(map(self.encode, SAFE.split(text)))
        try:  # a slice behind another one starts with its space
            rest = b"".join(map(self.__getitem__, words[1:]))
            return self.encode(head) + rest if head else rest
        except Irregular:
            return b"".join(map(self.encode, SAFE.split(text)))

    def ids(self, text: str) -> bytes:
        return b"".join(map(self._slice, slices(text))) if text else b""


def byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary shows for each byte: itself where it prints."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256))
    return [chr(b) if b in prints else chr(256 + next(others)) for b in range(256)]


@functools.lru_cache(maxsize=2)
def encoder(kind: type, path: str):
    """One for each Python worker, so that later tasks find the parts of earlier ones."""
    return kind(path)


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """Rows ``(id, n_bytes, n_tokens, over_limit)``, one for each row of ``df``.

    ``n_tokens`` is what the library gives for the whole text without added special tokens;
    special strings inside a text count as the library treats them by default.  Null text
    counts as empty (0 bytes, 0 tokens); null ids, repeated rows and empty input pass through;
    other columns are not read.  Only lengths leave the Arrow function.
    """
    id_type = df.schema[id_col].dataType.simpleString()

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            counts = encoder(LengthEncoder, path).counts(texts.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(texts.cast(pa.binary())).cast(pa.int64()),
                 pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return text_batches(df).select(id_col, text_col).mapInArrow(
        lengths, f"`{id_col}` {id_type}, n_bytes long, n_tokens long, over_limit boolean")
