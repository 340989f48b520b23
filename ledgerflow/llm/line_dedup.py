"""Substring dedup by hashing units below the line (operator 4).

A line is cut into units at the punctuation of every script, so a passage that stands inside a longer
line shares all but its outermost units with its copies.  Units are normalised (case, white space, end marks)
and hashed to 64 bits.  Digests are grouped globally with partial aggregation; the earliest ranked text keeps a
unit, and within a text its first place.  A unit alone says little, common clauses repeat by chance: what is cut
out are runs of neighbouring units that all occur earlier and together have MIN_CHARS characters.  Removed spans
keep their offsets in the original.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_keyed, stored, text_batches

#: Characters of a repeated run, with one space a unit; about 25 words, or a passage without spaces as long.
MIN_CHARS = 150
#: Marks that end a unit (fixed: sentence and clause marks of Latin, Greek, Arabic, Indic, Ethiopic and East Asian scripts).
MARKS = ".,;:!?…。、，；：！？·،؛؟।॥፣፤፥።"
UNIT = re.compile(f"[^{MARKS}]*[{MARKS}]+|[^{MARKS}]+")


def units_of(line: str) -> Iterator[tuple[str, int, int]]:
    """``(normalised unit, start, stop)`` of a line; units of marks and white space alone are left out."""
    for m in UNIT.finditer(line):
        unit = " ".join(m[0].rstrip(MARKS).lower().split())
        if unit:
            yield unit, m.start(), m.end()


def digest(unit: str) -> int:
    from xxhash import xxh3_64_intdigest

    h = xxh3_64_intdigest(unit.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def repeated_spans(text: str, elsewhere: set[int], min_chars: int) -> list[tuple[int, int]]:
    """The spans, one a line at most for each run, of ``text``'s runs of repeated units.

    A unit repeats if its digest is ``elsewhere`` (it stands in an earlier text) or stood before in this one.
    """
    spans: list[tuple[int, int]] = []
    seen: set[int] = set()
    run: list[tuple[int, int]] = []  # the open run's span in each of its lines
    size = at = 0

    def close() -> None:
        nonlocal run, size
        if size >= min_chars:
            spans.extend(run)
        run, size = [], 0

    for line in text.split("\n"):
        fresh = True  # no span of the open run in this line yet
        for unit, start, stop in units_of(line):
            d = digest(unit)
            if d in elsewhere or d in seen:
                run = [*run, (at + start, at + stop)] if fresh else [*run[:-1], (run[-1][0], at + stop)]
                size, fresh = size + len(unit) + 1, False
            else:
                seen.add(d)
                close()
                fresh = True
        at += len(line) + 1
    close()
    return spans


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the spans; a line that loses all but white space goes with its line end."""
    kept, at, k = [], 0, 0
    for line in text.split("\n"):
        rest, pos, cut = [], 0, False
        while k < len(spans) and spans[k][0] < at + len(line) + 1:
            rest.append(line[pos:spans[k][0] - at])
            pos, cut, k = spans[k][1] - at, True, k + 1
        rest = "".join([*rest, line[pos:]])
        if not cut or rest.strip():
            kept.append(rest)
        at += len(line) + 1
    return "\n".join(kept)


def text_units(rows: DataFrame) -> DataFrame:
    """``(row_id, row_hash, digest)``: the distinct units of every text."""
    id_type = rows.schema["row_id"].dataType.simpleString()

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, digests = [], []
            for k, text in enumerate(batch.column(2)):
                found = {digest(u) for line in (text.as_py() or "").split("\n") for u, _, _ in units_of(line)}
                row += [k] * len(found)
                digests += found
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(digests, pa.int64())],
                                             names=["row_id", "row_hash", "digest"])

    return text_batches(rows).mapInArrow(units, f"row_id {id_type}, row_hash long, digest long")


def earlier_units(rows: DataFrame) -> DataFrame:
    """``(row_id, row_hash, digests)``: the units of each text that an earlier ranked text has too."""
    units = stored(text_units(rows))
    place = F.struct("row_id", "row_hash")
    first = units.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = join_keyed(units, first, "digest", "n", units.count()).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("row_id", "row_hash").agg(F.collect_set("digest").alias("digests"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``df`` with repeated runs cut out of ``text_col``, and ``removed``: their original spans.

    Texts rank by id (null first), then by the text's hash where ids repeat; the first one with a unit keeps it,
    and in a text its first place does.  ``removed`` holds (start, stop) in code points of the original text, in
    order, one span for each line that a run touches.  A line that loses all its text goes with its line end.
    Null text stays null and loses nothing; rows equal in id and text are one text and lose the same; other
    columns pass through, but for one named ``removed``.  Empty input gives no rows.
    """
    keyed = df.select(F.col(id_col).alias("row_id"), F.xxhash64(text_col).alias("row_hash"), F.col(text_col).alias("text"))
    found = earlier_units(keyed).select(F.col("row_id").alias("__id"), F.col("row_hash").alias("__hash"), F.col("digests").alias("removed"))
    rest = df.drop("removed") if "removed" in df.columns else df
    joined = rest.join(found, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__hash")), "left")
    joined = joined.drop("__id", "__hash")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            texts, spans = [], []
            for text, digests in zip(batch.column(text_col), batch.column("removed"), strict=True):
                text = text.as_py()
                gone = [] if text is None else repeated_spans(text, set(digests.as_py() or ()), min_chars)
                texts.append(without(text, gone) if gone else text)
                spans.append([{"start": a, "stop": b} for a, b in gone])
            k = batch.schema.get_field_index(text_col)
            batch = batch.set_column(k, text_col, pa.array(texts, batch.column(k).type))
            yield batch.set_column(batch.schema.get_field_index("removed"), "removed", pa.array(spans, span))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema]
    return text_batches(joined).mapInArrow(cut, ", ".join([*fields, "removed array<struct<start:bigint,stop:bigint>>"]))
