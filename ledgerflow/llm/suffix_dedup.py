"""Removal of long repeated byte strings by suffix sorting (operator 7).

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere else.  Suffixes
are sorted in shards, and what must be sorted is first narrowed down without losing a repeat:

1. Every window of ``length`` bytes contains an *anchor*: the k-gram whose hash is the window's
   smallest.  Equal windows have equal anchors, so only anchors that occur twice matter.
2. An occurrence's *context* is all that windows with this anchor can reach.  Equal contexts are
   carried once, with their number.
3. Contexts are dealt to shards by where their anchor occurs first, so that neighbouring contexts
   stay together and overlapping ones merge; all contexts of an anchor meet in one shard.
4. Contexts of one place that do not fit a shard are cut up: their windows fall into runs by how far
   they start before the anchor, and each run has a longer anchor, the bytes that all its windows
   hold.  What still does not fit is cut into single windows; those of one anchor are all equal.
5. Each shard's suffixes are sorted by induction (``induced``); neighbours in suffix order with
   a common prefix of at least ``length`` are repeats.
6. What is found for a context holds for all its occurrences, and is cut out of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_batches
from .induced import sorted_suffixes

LENGTH = 400
#: Bytes of the first occurrence's text that share a shard, and context bytes meant for a bucket.
HOME_BLOCK = 1024
BUCKET_BYTES = 12_000_000
#: Bytes of different contexts above which those of a place are cut up, and the window starts of a run at each step.
HOT_BYTES = BUCKET_BYTES
RUN_STARTS = (16, 1)
#: Windows of a text whose anchors are looked for at a time.
RUN_WINDOWS = 1 << 20
SEPARATOR, FIRST_BYTE, SYMBOLS = 1, 2, 258


def kgram(length: int) -> int:
    """Width of an anchor: a power of two, about five eighths of the length."""
    k = 1
    while 2 * k <= max(1, length * 5 // 8 + 6):
        k *= 2
    return min(k, length)


def _sliding(x, width: int, op):
    """``op`` over every ``width`` neighbours of ``x``."""
    n, y = 1, x
    while 2 * n <= width:
        y, n = op(y[:-n], y[n:]), 2 * n
    if n < width:
        last = len(x) - width + 1
        y = op(y[:last], y[width - n:width - n + last])
    return y


def anchors(data: bytes, length: int):
    """Positions and hashes of the k-grams that are the smallest of some window of ``length``.

    A long text is taken in runs of windows, so that memory does not grow with it.
    """
    import numpy as np

    windows = len(data) - length + 1
    if windows <= RUN_WINDOWS:
        return _anchors(data, length)
    at, h = [], []
    for start in range(0, windows, RUN_WINDOWS):
        own, hashes = _anchors(data[start:min(len(data), start + RUN_WINDOWS + length - 1)], length)
        at.append(own + start)
        h.append(hashes)
    at, first = np.unique(np.concatenate(at), return_index=True)
    return at, np.concatenate(h)[first]


def _anchors(data: bytes, length: int):
    import numpy as np

    k = kgram(length)
    w = length - k + 1
    with np.errstate(over="ignore"):
        h = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        m, n = np.uint64(0x9E3779B97F4A7C15), 1
        while n < k:
            h = h[:-n] * m + h[n:]
            m, n = m * m, 2 * n
        h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    lowest = _sliding(h, w, np.minimum)
    pad = np.zeros(w - 1, np.uint64)
    at = np.flatnonzero(h == _sliding(np.concatenate((pad, lowest, pad)), w, np.maximum))
    return at, h[at]


def _anchor_rows(rows: DataFrame, length: int) -> DataFrame:
    """``(anchor, ctx, id, h, lo, hi, lead)`` of every anchor: its hash, its context's hash and bounds, its place therein."""
    id_type = rows.schema["id"].dataType.simpleString()
    k = kgram(length)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from xxhash import xxh3_64_intdigest

        for batch in batches:
            take, hashes, ctx, los, his, leads = [], [], [], [], [], []
            for j, text in enumerate(batch.column(2)):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                if len(data) < length:
                    continue
                at, h = anchors(data, length)
                lo, hi = np.maximum(at - (length - k), 0), np.minimum(at + length, len(data))
                take.append(np.full(len(at), j))
                hashes.append(h)
                los.append(lo)
                his.append(hi)
                leads.append(at - lo)
                ctx += [xxh3_64_intdigest(data[a:e], q - a) for q, a, e in zip(at.tolist(), lo.tolist(), hi.tolist(), strict=True)]
            join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
            index = pa.array(join(take, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(join(hashes, np.uint64).view(np.int64)), pa.array(np.array(ctx, np.uint64).view(np.int64)),
                 batch.column(0).take(index), batch.column(1).take(index), pa.array(join(los, np.int32)), pa.array(join(his, np.int32)),
                 pa.array(join(leads, np.int32))],
                names=["anchor", "ctx", "id", "h", "lo", "hi", "lead"])

    return text_batches(rows).mapInArrow(found, f"anchor long, ctx long, id {id_type}, h long, lo int, hi int, lead int")


def _cut_up(length: int, starts: int):
    """Rows of the contexts' parts: one for each run of ``starts`` windows, counted back from the anchor.

    A part's own anchor is what all windows of the run hold, whether or not the text reaches far
    enough for each of them, so parts of different contexts meet wherever they share a window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        signed = lambda x: x - (x >> 63 << 64)
        for batch in batches:
            out: list[list] = [[] for _ in PARTS]
            for key, h, text, marks in zip(*(batch.column(c) for c in ("id", "h", "text", "marks")), strict=True):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                for m in marks.as_py():
                    lo, hi, q = m["lo"], m["hi"], m["lo"] + m["lead"]
                    for back in range((q - hi + length) // starts * starts, q - lo + 1, starts):
                        core = data[q - back:q - back - starts + 1 + length]
                        a, e = max(lo, q - back - starts + 1), min(hi, q - back + length)
                        row = (m["anchor"], m["ctx"], a - lo, signed(xxh3_64_intdigest(core, starts)),
                               signed(xxh3_64_intdigest(data[a:e], q - a & (1 << 64) - 1)), key.as_py(), h.as_py(), a, e, q - a, m["n"])
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), batch.schema.field("id").type, pa.int64(),
                     pa.int32(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=PARTS)

    return run


PARTS = ["whole_anchor", "whole_ctx", "at", "anchor", "ctx", "id", "h", "lo", "hi", "lead", "n"]


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts each text's wanted contexts out; those of one bucket that overlap are one region."""
    for batch in batches:
        out: list[list] = [[], [], []]
        for text, marks in zip(batch.column("text"), batch.column("marks"), strict=True):
            data = (text.as_py() or "").encode("utf-8", "surrogatepass")
            open_: dict = {}
            for m in sorted(marks.as_py(), key=lambda m: (m["bucket"], m["lo"], m["hi"], m["ctx"])):
                last = open_.get(m["bucket"])
                if last is not None and m["lo"] < last[1]:
                    last[1] = max(last[1], m["hi"])
                    last[2].append(m)
                    continue
                if last is not None:
                    _close(out, m["bucket"], last, data)
                open_[m["bucket"]] = [m["lo"], m["hi"], [m]]
            for bucket, last in open_.items():
                _close(out, bucket, last, data)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()), pa.array(out[2], MARKS)], names=["bucket", "region", "marks"])


def _close(out: list[list], bucket: int, region: list, data: bytes) -> None:
    lo, hi, marks = region
    out[0].append(bucket)
    out[1].append(data[lo:hi])
    out[2].append([{"anchor": m["anchor"], "ctx": m["ctx"], "lo": m["lo"] - lo, "hi": m["hi"] - lo, "n": m["n"]} for m in marks])


MARKS = pa.list_(pa.struct([("anchor", pa.int64()), ("ctx", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("n", pa.int64())]))
MARKS_DDL = "array<struct<anchor:bigint,ctx:bigint,lo:int,hi:int,n:bigint>>"


def repeats_in(regions: list[bytes], marks: list[list[dict]], length: int) -> Iterator[tuple[int, int, int, int]]:
    """``(anchor, ctx, from, to)``: spans of each context that repeated windows cover."""
    import numpy as np

    sizes = np.array([len(r) + 1 for r in regions])
    starts = np.concatenate(([0], np.cumsum(sizes)))
    text = np.empty(starts[-1] + 1, np.uint16)
    room = np.empty(starts[-1] + 1, np.int32)  # bytes up to the region's end
    for r, at in zip(regions, starts, strict=False):
        n = len(r)
        text[at:at + n] = np.frombuffer(r, np.uint8)
        text[at:at + n] += FIRST_BYTE
        text[at + n] = SEPARATOR
        room[at:at + n + 1] = np.arange(n, -1, -1)
    text[-1], room[-1] = 0, 0
    flag = np.zeros(len(text) + 1, bool)
    for positions, prefixes in sorted_suffixes(text, SYMBOLS, length):
        near = prefixes >= length
        near[:-1] |= near[1:]
        near &= room[positions] >= length
        flag[positions[near]] = True
    for at, own in zip(starts, marks, strict=False):
        for m in own:
            if m["n"] > 1 and m["hi"] - m["lo"] >= length:
                flag[at + m["lo"]:at + m["hi"] - length + 1] = True
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flag)).astype(np.int8)))
    first, past = edges[::2], edges[1::2]
    for at, own in zip(starts, marks, strict=False):
        for m in own:
            lo, hi = int(at) + m["lo"], int(at) + m["hi"]
            k = int(np.searchsorted(past, lo, side="right"))
            while k < len(first) and first[k] <= hi - length:
                a, b = max(int(first[k]), lo), min(int(past[k]) - 1, hi - length) + length
                yield m["anchor"], m["ctx"], a - lo, b - lo
                k += 1


def _sorted_shards(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(regions, marks):
            rows = list(zip(*repeats_in(regions, marks, length), strict=True)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=["anchor", "ctx", "a", "b"])

        bucket, regions, marks = None, [], []
        for batch in batches:
            for b, r, m in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                if b.as_py() != bucket and regions:
                    yield result(regions, marks)
                    regions, marks = [], []
                bucket = b.as_py()
                regions.append(r.as_py())
                marks.append(m.as_py())
        if regions:
            yield result(regions, marks)

    return run


def _repeated(rows: DataFrame, place=None) -> DataFrame:
    """Those of ``rows`` whose anchor occurs twice or more, with their ``place`` (else that of its first occurrence)."""
    homes = rows.groupBy("anchor").agg(F.sum("n").alias("times"), F.min(F.struct("id", "h", "lo")).alias("home")).where("times > 1")
    if place is None:
        place = F.xxhash64("home.id", "home.h", F.floor(F.col("home.lo") / HOME_BLOCK))
    homes = stored(homes.select("anchor", place.alias("place")))  # a plain side: a hot anchor's join can be split
    return stored(rows.join(homes, "anchor"))


def _contexts(rows: DataFrame) -> DataFrame:
    """Different contexts of ``rows``: one to stand for the equal ones, and their number."""
    return stored(rows.groupBy("anchor", "ctx").agg(
        F.min(F.struct("id", "h", "lo", "hi", "lead")).alias("rep"), F.sum("n").alias("n"), F.min("place").alias("place")))


def _bytes():
    return F.sum(F.col("rep.hi") - F.col("rep.lo"))


def _marked(rows: DataFrame, contexts: DataFrame, *more) -> DataFrame:
    """``(id, h, text, marks)`` of the texts that stand for contexts."""
    mark = F.struct("anchor", "ctx", F.col("rep.lo").alias("lo"), F.col("rep.hi").alias("hi"), "n", *more)
    wanted = contexts.groupBy(F.col("rep.id").alias("rep_id"), F.col("rep.h").alias("rep_h")).agg(F.collect_list(mark).alias("marks"))
    return rows.join(wanted, F.col("id").eqNullSafe(F.col("rep_id")) & (F.col("h") == F.col("rep_h"))).select("id", "h", "text", "marks")


def repeated_spans(rows: DataFrame, length: int, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """``(id, h, spans)`` of ``rows (id, h, text)``: covered byte spans, not merged."""
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"whole_anchor long, whole_ctx long, at int, anchor long, ctx long, id {id_type}, h long, lo int, hi int, lead int, n long"
    occurrences = _repeated(_anchor_rows(rows, length).withColumn("n", F.lit(1).cast("long")))
    contexts, settled, steps, alike = _contexts(occurrences), [], [], None
    for starts in RUN_STARTS:
        hot = stored(contexts.groupBy("place").agg(_bytes().alias("size")).where(F.col("size") > hot_bytes).select("place"))
        if hot.isEmpty():
            break
        settled.append(contexts.join(hot, "place", "left_anti"))
        whole = _marked(rows, contexts.join(hot, "place", "left_semi"), F.col("rep.lead").alias("lead"))
        parts = stored(text_batches(whole).mapInArrow(_cut_up(length, starts), schema))
        steps.append(_repeated(parts, F.xxhash64("anchor")))
        contexts = _contexts(steps[-1])
        if starts == 1:  # a window each: nothing to sort, equal ones with the anchor at one place are counted
            alike = contexts.where("n > 1").select("anchor", "ctx", F.lit(0).alias("a"), F.lit(length).alias("b"))
            contexts = settled.pop()
    for earlier in settled:
        contexts = contexts.unionByName(earlier)
    size = contexts.agg(_bytes()).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    once = _marked(rows, contexts, F.pmod("place", F.lit(buckets)).cast("int").alias("bucket")).select("text", "marks")
    regions = once.mapInArrow(_regions, f"bucket int, region binary, marks {MARKS_DDL}")
    shards = regions.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    spans = shards.mapInArrow(_sorted_shards(length), "anchor long, ctx long, a int, b int")
    if alike is not None:
        spans = spans.unionByName(alike)
    if steps:
        spans = stored(spans)
    for parts in reversed(steps):  # what is found for a part holds for the contexts that it was cut from
        of_parts = parts.select("whole_anchor", "whole_ctx", "at", "anchor", "ctx").join(spans, ["anchor", "ctx"])
        spans = spans.unionByName(of_parts.select(F.col("whole_anchor").alias("anchor"), F.col("whole_ctx").alias("ctx"),
                                                  (F.col("at") + F.col("a")).alias("a"), (F.col("at") + F.col("b")).alias("b")))
    return (occurrences.join(spans, ["anchor", "ctx"])
            .groupBy("id", "h").agg(F.collect_set(F.struct((F.col("lo") + F.col("a")).alias("start"), (F.col("lo") + F.col("b")).alias("stop"))).alias("spans")))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   hot_bytes: int = HOT_BYTES) -> DataFrame:
    """Rows ``(id, n_bytes, spans, kept)``, one for each row of ``df``.

    ``spans`` are the maximal removed (start, stop) runs in bytes of the whole text's UTF-8 form,
    judged on the input; ``kept`` is what is left.  Null text counts as empty.  Repeated rows are
    occurrences like any other, so both lose what they share.  Other columns are not read.
    The result does not depend on ``hot_bytes`` (see the module).
    """
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    spans = repeated_spans(rows, length, hot_bytes).select(F.col("id").alias("span_id"), F.col("h").alias("span_h"), "spans")
    joined = rows.join(spans, F.col("id").eqNullSafe(F.col("span_id")) & (F.col("h") == F.col("span_h")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            sizes, merged, kept = [], [], []
            for text, found in zip(batch.column(1), batch.column(2), strict=True):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                runs: list[dict] = []
                for s in sorted((x["start"], x["stop"]) for x in found.as_py() or ()):
                    if runs and s[0] <= runs[-1]["stop"]:
                        runs[-1]["stop"] = max(runs[-1]["stop"], s[1])
                    else:
                        runs.append({"start": s[0], "stop": s[1]})
                at, left = 0, []
                for r in runs:
                    left.append(data[at:r["start"]])
                    at = r["stop"]
                sizes.append(len(data))
                merged.append(runs)
                kept.append(b"".join(left) + data[at:])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(merged, span), pa.array(kept, pa.binary())],
                                             names=[id_col, "n_bytes", "spans", "kept"])

    id_type = df.schema[id_col].dataType.simpleString()
    return joined.select("id", "text", "spans").mapInArrow(
        cut, f"`{id_col}` {id_type}, n_bytes long, spans array<struct<start:bigint,stop:bigint>>, kept binary")
