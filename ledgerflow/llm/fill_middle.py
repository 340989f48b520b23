"""Fill-in-the-middle transformation by block rotation in place (operator 11).

A text is taken as one bytearray.  Its line ends are scanned for two cuts, the three sentinels
are inserted in front of prefix, middle and suffix, and the segments are exchanged by a rotation:
both blocks are reversed, then the whole, each in place through a window of bounded size.
The inverse rotation and the removal of the sentinels give the text back exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_batches
from .marks import any_of, checked_marks, code_points

#: A unit is a line with its end, or what follows the last line end.
LINE_END = re.compile(rb"\n")
#: Bytes exchanged at a time by a reversal.
WINDOW = 1 << 16


@dataclass(frozen=True)
class Rules:
    """Share of texts that are transformed, share of those with the suffix first, and the marks."""

    seed: int = 7
    rate: int = 100
    suffix_first: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    marks: tuple[bytes, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "marks", checked_marks((self.prefix, self.suffix, self.middle)))


def reverse(buf: bytearray, start: int, stop: int) -> None:
    """Reverse ``buf[start:stop]`` in place."""
    while stop - start > 1:
        n = min(WINDOW, (stop - start) // 2)
        head = buf[start:start + n]
        head.reverse()
        tail = buf[stop - n:stop]
        tail.reverse()
        buf[start:start + n], buf[stop - n:stop] = tail, head
        start, stop = start + n, stop - n


def rotate(buf: bytearray, start: int, cut: int, stop: int) -> None:
    """Exchange the neighbouring blocks ``[start, cut)`` and ``[cut, stop)`` by three reversals."""
    reverse(buf, start, cut)
    reverse(buf, cut, stop)
    reverse(buf, start, stop)


def ends_of_units(data: bytes | bytearray) -> list[int]:
    ends = [m.end() for m in LINE_END.finditer(data)]
    if len(data) > (ends[-1] if ends else 0):
        ends.append(len(data))
    return ends


def transform_text(buf: bytearray, h: tuple[int, int, int, int], rules: Rules) -> tuple[int, str, int | None, int | None]:
    """Transform ``buf`` in place; units, form, and characters of prefix and middle (None if plain)."""
    ends = ends_of_units(buf)
    n = len(ends)
    if not buf or any_of(rules.marks).search(buf) or h[2] % 100 >= rules.rate:
        return n, "plain", None, None
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = ([0, *ends][k] for k in (first, second))
    chars = code_points(buf[:a]), code_points(buf[a:b])
    p, s, m = rules.marks
    buf[b:b] = s
    buf[a:a] = m
    buf[0:0] = p  # now prefix, middle, suffix, each behind its mark
    at_middle, at_suffix = len(p) + a, len(p) + len(m) + b
    form = "spm" if h[3] % 100 < rules.suffix_first else "psm"
    rotate(buf, 0 if form == "spm" else at_middle, at_suffix, len(buf))
    return n, form, *chars


def restore_text(buf: bytearray, form: str, rules: Rules) -> None:
    """Turn an output of ``transform_text`` back into its text, in place."""
    if form == "plain":
        return
    p, s, m = rules.marks
    if form == "spm":
        start, cut = 0, buf.index(p)
    else:
        start, cut = buf.index(s), buf.index(m)
    rotate(buf, start, cut, len(buf))
    for mark in (s, m, p):  # from the right, so that little is moved
        at = buf.index(mark)
        del buf[at:at + len(mark)]


def draws(id_col: Column, seed: int) -> list[Column]:
    """The first four 8-digit groups of the SHA-256 of ``seed:id`` as longs; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """Rows ``(id, n, form, prefix_chars, middle_chars, output)``, one for each row of ``df``.

    Null texts count as empty; empty texts and texts that hold a sentinel stay plain (the two
    counts are null).  A row depends on its own id and text alone, so repeated rows give repeated
    results and the table needs no shuffle; a null id draws like an empty one.  Other columns of
    ``df`` are not read.  Empty input gives no rows.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, n long, form string, prefix_chars long, middle_chars long, output binary"

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hs = list(zip(*[batch.column(k).to_pylist() for k in range(2, 6)], strict=True))
            facts, outputs = [], []
            for text, h in zip(batch.column(1), hs, strict=True):
                buf = bytearray(text.as_py() or b"")
                facts.append(transform_text(buf, h, rules))
                outputs.append(bytes(buf))
            n, form, prefix, middle = zip(*facts, strict=True) if facts else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(outputs, pa.binary())],
                names=[id_col, "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = text_batches(df).select(F.col(id_col), F.col(text_col).cast("binary"),
                                   *[h.alias(f"h{k}") for k, h in enumerate(draws(F.col(id_col), rules.seed))])
    return rows.mapInArrow(moved, schema).withColumn("output", F.col("output").cast("string"))


def restore(df: DataFrame, output_col: str = "output", form_col: str = "form", restored_col: str = "restored",
            rules: Rules = Rules()) -> DataFrame:
    """``df`` with the exact text of each output in ``restored_col`` (replaced if it is there).

    A null output counts as empty, a null form as plain.  All other columns and all rows stay.
    """
    names = [c for c in df.columns if c != restored_col]
    schema = df.select(*[F.col(f"`{c}`") for c in names]).schema.add(restored_col, "binary")

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for output, form in zip(batch.column(len(names)), batch.column(len(names) + 1), strict=True):
                buf = bytearray(output.as_py() or b"")
                restore_text(buf, form.as_py() or "plain", rules)
                texts.append(bytes(buf))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(texts, pa.binary())],
                                             names=[*names, restored_col])

    rows = text_batches(df).select(*[F.col(f"`{c}`") for c in names], F.col(output_col).cast("binary").alias("__output"), F.col(form_col).alias("__form"))
    return rows.mapInArrow(back, schema).withColumn(restored_col, F.col(restored_col).cast("string"))
