"""Importance resampling towards a target distribution (operator 13).

Runs of one to three words fall into hashed buckets.  Both collections are counted once per
bucket; the gains of all buckets make one small array, by which a document's weight is the sum over
its features.  Documents are drawn without replacement by adding Gumbel noise that is hashed from
their id and taking the largest scores.

The k-th largest score is found by distributed quickselect: each round takes pivot keys at random
from the rows that are still in question, counts exactly how many rows lie before, at and
behind each pivot, and narrows to the part that holds the k-th.  Only the rows up to it, the
winners, are then sorted and ranked.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import stored, text_batches

#: A word, in UTF-8 after A-Z are made small: digits, a-z and everything beyond ASCII.
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
#: Words hashed at a time, which bounds the memory for a very long text.
CHUNK = 1 << 16
#: Pivots tried in a round of the selection.
PIVOTS = 16


@dataclass(frozen=True)
class Sampling:
    buckets: int = 10_000
    longest: int = 3       # words in a feature
    least_words: int = 20  # documents with fewer are never drawn
    percent: int = 5
    seed: int = 42


def features(text: bytes, sampling: Sampling) -> Iterator[tuple[int, list[int]]]:
    """``(words, buckets of the features that end in them)``, for runs of a text's words."""
    from zlib import crc32

    words = WORD.findall(text.lower())  # bytes: A-Z only
    for at in range(0, len(words), CHUNK):
        back = max(0, at - sampling.longest + 1)
        part = words[back:at + CHUNK]
        spaced = [b" " + w for w in part]
        ending, hashes = list(map(crc32, part)), []
        for length in range(1, sampling.longest + 1):  # ending[i]: the feature of this length that begins at i
            if length > 1:
                ending = list(map(crc32, spaced[length - 1:], ending))
            hashes += ending[max(0, at - back - length + 1):]
        yield min(CHUNK, len(words) - at), hashes


def bucket_counts(df: DataFrame, text_col: str, sampling: Sampling) -> DataFrame:
    """``(bucket, n)``: features of all texts per bucket; every task sends at most one row a bucket."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        sums = np.zeros(sampling.buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, hashes in features(text.as_py() or b"", sampling):
                    sums += np.bincount(np.array(hashes, np.uint32) % sampling.buckets, minlength=sampling.buckets)
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(sums[seen], pa.int64())], names=["bucket", "n"])

    texts = text_batches(df).select(F.col(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, sampling: Sampling) -> list[int]:
    """The gain of each bucket; one row a bucket comes to the driver."""
    s, t = [0] * sampling.buckets, [0] * sampling.buckets
    both = raw.withColumn("of", F.lit(0)).unionByName(target.withColumn("of", F.lit(1)))
    for r in both.collect():
        (t if r["of"] else s)[r["bucket"]] = r["n"]
    smooth = sampling.buckets
    raw_total, target_total = float(sum(s) + smooth), float(sum(t) + smooth)
    return [math.floor(1000 * math.log((b + 1.0) * raw_total / ((a + 1.0) * target_total))) for a, b in zip(s, t, strict=True)]


def weights(df: DataFrame, id_col: str, text_col: str, table: Sequence[int], sampling: Sampling) -> DataFrame:
    """``(id, n_words, n_features, weight)`` of every row, the weights summed by array look-up."""
    id_type = df.schema[id_col].dataType.simpleString()

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        gain = np.array(table, np.int64)
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            for i, text in enumerate(batch.column(1)):
                for n, hashes in features(text.as_py() or b"", sampling):
                    out[:, i] += n, len(hashes), gain[np.array(hashes, np.uint32) % sampling.buckets].sum()
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out)], names=[id_col, "n_words", "n_features", "weight"])

    texts = text_batches(df).select(F.col(id_col), F.col(text_col).cast("binary").alias("__text"))
    return texts.mapInArrow(weighed, f"`{id_col}` {id_type}, n_words long, n_features long, weight long")


def noise(id_col: Column, seed: int) -> Column:
    """Thousandths of a Gumbel draw hashed from the id; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def kth_key(rows: DataFrame, key: str, k: int) -> Row | None:
    """The ``k``-th smallest value of the struct column ``key`` (None if there are fewer), by quickselect.

    Keys are ordered as Spark orders structs, null members first.  A round is two aggregations over
    the rows in question: one random key a part, then the rows before, at and behind each of them.
    """
    kind, inside, before = rows.schema[key].dataType, rows.select(key), 0
    if not 0 < k <= inside.count():
        return None
    for turn in itertools.count():
        # a random key of each part: the one with the smallest hash of the round
        drawn, part = F.xxhash64(F.lit(turn), key), F.pmod(F.xxhash64(F.lit(-1 - turn), key), F.lit(PIVOTS))
        pivots = [r["pivot"] for r in inside.groupBy(part).agg(F.min_by(key, drawn).alias("pivot")).collect()]
        at = [_literal(p, kind) for p in pivots]
        counts = inside.agg(*[F.count_if(F.col(key) < p).alias(f"less_{i}") for i, p in enumerate(at)],
                            *[F.count_if(F.col(key) == p).alias(f"same_{i}") for i, p in enumerate(at)]).first()
        low, high = (before, None), (math.inf, None)
        for i, p in enumerate(at):
            less = before + counts[f"less_{i}"]
            same = less + counts[f"same_{i}"]
            if less < k <= same:
                return pivots[i]
            if same < k:
                low = max(low, (same, i), key=lambda x: x[0])
            else:
                high = min(high, (less, i), key=lambda x: x[0])
        if low[1] is not None:
            inside, before = inside.where(F.col(key) > at[low[1]]), low[0]
        if high[1] is not None:
            inside = inside.where(F.col(key) < at[high[1]])


def _literal(value: Row, kind) -> Column:
    return F.struct(*[F.lit(value[f.name]).cast(f.dataType).alias(f.name) for f in kind.fields])


def ranked(winners: DataFrame, key: str) -> DataFrame:
    """``winners`` with ``rank`` 1, 2, 3... in the order of ``key``.

    Rows are dealt to ordered slices and numbered there; a slice starts behind the rows of the slices
    before it (one row a slice is broadcast).
    """
    place = F.monotonically_increasing_id()  # slice number above 33 bits of place in the slice
    dealt = stored(winners.repartitionByRange(key).sortWithinPartitions(key).withColumn("__place", place))
    part, inner = F.shiftright("__place", 33), F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = dealt.groupBy(part.alias("__slice")).agg(F.count("*").alias("n"))
    starts = sizes.select("__slice", (F.sum("n").over(Window.orderBy("__slice")) - F.col("n")).alias("__start"))
    return (dealt.withColumn("__slice", part).join(F.broadcast(starts), "__slice")
            .withColumn("rank", F.col("__start") + inner + 1).drop("__slice", "__start", "__place"))


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             sampling: Sampling = Sampling()) -> DataFrame:
    """Rows ``(id, n_features, weight, score, rank)``, one for each row of ``df``; ``rank`` is null if not drawn.

    Of the N rows with ``least_words`` words or more, ``floor(percent * N / 100)`` with the highest
    scores are drawn, ties to the smaller id (a null id before all others), then to fewer features,
    then to either of two repeated rows.  Null and empty texts have no features, weight 0 and are
    not drawn.  An empty target gives every bucket the gain of no count; an empty table no rows.
    Other columns are not read.
    """
    table = gains(bucket_counts(df, text_col, sampling), bucket_counts(target, target_text, sampling), sampling)
    scored = weights(df, id_col, text_col, table, sampling).withColumn("score", F.col("weight") + noise(F.col(id_col), sampling.seed))
    key = F.struct((-F.col("score")).alias("down"), F.col(id_col).alias("id"), F.col("n_features").alias("n"),
                   F.monotonically_increasing_id().alias("row"))
    rows = stored(scored.withColumn("__key", key))
    able = F.col("n_words") >= sampling.least_words
    n = rows.where(able).count()
    last = kth_key(rows.where(able), "__key", sampling.percent * n // 100)
    columns = [F.col(id_col), F.col("n_features"), F.col("weight"), F.col("score")]
    none = F.lit(None).cast("long").alias("rank")
    if last is None:
        return rows.select(*columns, none)
    wins = able & (F.col("__key") <= _literal(last, rows.schema["__key"].dataType))
    won = ranked(rows.where(wins), "__key").select(*columns, F.col("rank").cast("long"))
    return won.unionByName(rows.where(~wins).select(*columns, none))
