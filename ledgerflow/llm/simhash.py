"""SimHash near-duplicate detection with pigeonring candidate search (operator 9).

The 64 fingerprint bits lie in a ring of DISTANCE + 1 segments.  If two fingerprints differ in
at most DISTANCE bits, some segment starts a chain in which the differences of every prefix of
l segments add up to at most l * DISTANCE / segments.  The first two prefixes make the join
key: a segment that is equal, and a next one with at most as many differing bits as the budget
leaves; one side of the join is expanded by those few variants of its own key.  Pairs that meet
are held against the budget of every prefix and the full Hamming distance.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_keyed, stored, text_batches
from .components import components

SHINGLE_WORDS = 3
DISTANCE = 2
SEED = 42
#: Shingles hashed at a time, which bounds the memory for a very long text.
CHUNK = 1 << 16


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles; 0 if it has no words."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(itertools.accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends[:-1]]
    ends = ends[shingle_words - 1:] or [ends[-1]]
    total, ones = 0, np.zeros(64, np.int64)
    for at in range(0, len(ends), CHUNK):
        hashes = np.array([xxh64_intdigest(joined[a:b - 1], SEED) for a, b in
                           zip(starts[at:at + CHUNK], ends[at:at + CHUNK], strict=False)], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(id, fp)``: fp holds the fingerprint's bits as a signed long."""
    id_type = df.schema[id_col].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            fps = np.array([fingerprint(t.as_py() or "", shingle_words) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64), pa.int64())],
                                             names=[id_col, "fp"])

    return text_batches(df).select(id_col, text_col).mapInArrow(hashed, f"`{id_col}` {id_type}, fp long")


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment of the ring."""
    n = distance + 1
    widths = [64 // n + (k < 64 % n) for k in range(n)]
    return [(sum(widths[:k]), w) for k, w in enumerate(widths)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _budget(length: int, distance: int) -> int:
    return length * distance // (distance + 1)


def _keys(fp: Column, distance: int, variants: bool) -> Column:
    """Join keys of a fingerprint, one for each segment that can start a chain (and variant)."""
    ring, out = segments(distance), []
    for i, (at, width) in enumerate(ring):
        nxt_at, nxt_width = ring[(i + 1) % len(ring)]
        mask = ((1 << width) - 1) << at | ((1 << nxt_width) - 1) << nxt_at
        spare = _budget(2, distance) if variants and len(ring) > 1 else 0
        flips = [sum(1 << (nxt_at + b) for b in bits)
                 for k in range(spare + 1) for bits in itertools.combinations(range(nxt_width), k)]
        out += [(i, _signed(mask), _signed(flip)) for flip in flips]
    table = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).alias("m"), F.lit(x).alias("x")) for i, m, x in out])
    return F.explode(table)


def _close(a: Column, b: Column, distance: int) -> Column:
    """Within the distance, with a chain whose prefixes all keep to their budgets."""
    ring, diff = segments(distance), a.bitwiseXOR(b)
    counts = [F.bit_count(diff.bitwiseAND(F.lit(_signed(((1 << w) - 1) << at)))) for at, w in ring]
    n, chains = len(ring), F.lit(False)
    for i in range(n):
        total, chain = F.lit(0), F.lit(True)
        for length in range(1, n + 1):
            total = total + counts[(i + length - 1) % n]
            chain = chain & (total <= _budget(length, distance))
        chains = chains | chain
    return chains & (F.bit_count(diff) <= distance)


def linked_pairs(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``(a, b)``, a < b: all pairs of the distinct longs ``fp`` within the distance."""
    key = F.xxhash64("k.i", F.col("fp").bitwiseAND(F.col("k.m")).bitwiseXOR(F.col("k.x")))
    index = fps.select("fp", _keys(F.col("fp"), distance, False).alias("k")).select(key.alias("key"), F.col("fp").alias("a"))
    probe = fps.select("fp", _keys(F.col("fp"), distance, True).alias("k")).select(key.alias("key"), F.col("fp").alias("b"))
    # the planner takes the sides before explode for small and would broadcast them
    return (index.hint("merge").join(probe.hint("merge"), "key").where((F.col("a") < F.col("b")) & _close(F.col("a"), F.col("b"), distance))
            .select("a", "b").distinct())


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """Rows ``(id, fingerprint, component_id)``, one for each row of ``df``.

    ``component_id`` is the smallest id reachable over links.  Null and empty texts have
    fingerprint 0 and link like any other; repeated rows each get their row; a null id gets the
    smallest id of its component, null if that has none.  Empty input gives no rows.
    """
    rows = stored(fingerprints(df, id_col, text_col, shingle_words))
    total = rows.count()
    classes = rows.groupBy("fp").agg(F.min(id_col).alias("rep"), F.count("*").alias("n_rows"))
    classes = stored(classes)
    roots = components(linked_pairs(classes.select("fp"), distance), "a", "b")
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "n_rows", "component_id")
    found = join_keyed(rows, named, "fp", "n_rows", total)
    return found.select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle_words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """One row of each component of near copies: the one with the smallest id, then the smallest hash of the text.

    A row that is no near copy of another always stays, whatever its id: a null id counts as larger than
    any other, rows of one id and unlike texts are told apart by their texts, and of rows that are equal in
    id and text one stays.  Null and empty texts are near copies of each other.
    """
    key = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"))
    keyed = df.select(key.alias("__key"), F.col(text_col).alias("__text"))
    found = near_duplicates(keyed, "__key", "__text", shingle_words, distance)
    keep = stored(found.where(F.col("__key") == F.col("component_id")).select("__key.id", "__key.hash").distinct())
    keep = keep.select(F.col("id").alias("__id"), F.col("hash").alias("__hash"))
    kept = df.join(keep, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__hash")), "left_semi")
    return kept.dropDuplicates([id_col, text_col])
