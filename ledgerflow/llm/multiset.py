"""Document fingerprints by a homomorphic multiset hash (operator 3, DataFrame functions only).

A text is the multiset of its paragraphs (lines).  Each paragraph is hashed to a wide vector and
the vectors are summed lane by lane modulo 2**32, so the order of paragraphs does not matter, and
a paragraph is inserted or deleted by adding or subtracting its vector (``combine``).

A paragraph's vector has two blocks.  EXACT lanes are hashes of the whole paragraph; they decide
equality.  SKETCH lanes are sums of +1/-1 signs hashed from the paragraph's phrases (pairs of
neighbouring words, or of letters in long runs without white space), and serve likeness: the inner product of two such sums estimates what the multisets share.  A sum of signs
is kept as the number of +1 in each lane beside the number of phrases.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: 32-bit lanes of whole paragraphs, and lanes of signs (64 for each 64-bit hash).
EXACT_LANES = 8
SKETCH_HASHES = 2
SKETCH_LANES = 64 * SKETCH_HASHES
#: Two 32-bit lanes share a long while they are summed; no text has 2**31 phrases.
PAIR = (1 << 32) | 1
MODULUS = 1 << 32
#: What parts words, and the UTF-8 bytes beyond which a run without it is taken letter by letter.
SPACES = r"[\s\u00a0\u2000-\u200a\u3000]+"
LONG_RUN_BYTES = 24
#: Rows in a block of neighbouring ids; quantiles of the ids that divide them, and parts of each.
#: Both bounds together keep the table of blocks under 65,536 rows; beyond, blocks hold more rows.
BLOCK_ROWS = 2048
MAX_CUTS = 256
MAX_PARTS = 256

#: Column names of the summed lanes.
EXACT = [f"e{k}" for k in range(EXACT_LANES // 2)]
SKETCH = [f"s{k}" for k in range(SKETCH_LANES // 2)]


def units_of(paragraph: Column) -> Column:
    """Words of a paragraph; where there are long runs, their letters instead."""
    words = F.split(paragraph, SPACES)
    long = lambda w: F.octet_length(w) > LONG_RUN_BYTES
    letters = F.flatten(F.transform(words, lambda w: F.when(long(w), F.split(w, "")).otherwise(F.array(w))))
    return F.when(F.exists(words, long), letters).otherwise(words)


def phrases_of(units: Column) -> Column:
    """Pairs ``(x, y)`` of neighbouring units; a single one by itself, with a null beside it."""
    first = F.slice(units, F.lit(1), F.greatest(F.size(units) - 1, F.lit(1)))
    return F.arrays_zip(first.alias("x"), F.slice(units, F.lit(2), F.size(units)).alias("y"))


def paragraph_rows(df: DataFrame, text: Column, keys: list[str]) -> DataFrame:
    """One row a phrase: ``keys``, the paragraph's hashes, ``at`` (0 on its first phrase) and ``phrase``."""
    return phrase_rows(df.select(*keys, F.explode(F.split(text, "\n")).alias("paragraph")), keys)


def phrase_rows(paragraphs: DataFrame, keys: list[str]) -> DataFrame:
    """``paragraph_rows`` of rows that hold one paragraph each."""
    # the lane comes first: after the paragraph it would only hash the paragraph's one hash again
    hashes = [F.xxhash64(F.lit(k + 101), "paragraph").alias(name) for k, name in enumerate(EXACT)]
    rows = paragraphs.select(*keys, *hashes, units_of(F.col("paragraph")).alias("units"))
    return rows.select(*keys, *EXACT, F.posexplode(phrases_of(F.col("units"))).alias("at", "phrase"))


def summed_lanes() -> list[Column]:
    """Aggregates that sum the vectors of a text's paragraphs."""
    first = F.col("at") == 0
    out = [F.sum(F.when(first, F.lit(1)).otherwise(0)).alias("paragraphs"), F.count("*").alias("phrases")]
    for name in EXACT:
        # both halves of a 64-bit hash, summed apart: 31 bits each keep the packed sum in range
        h = F.col(name)
        out.append(F.sum(F.when(first, h.bitwiseAND(F.lit(MODULUS - 1)))).alias(f"{name}_lo"))
        out.append(F.sum(F.when(first, F.shiftrightunsigned(h, 32))).alias(f"{name}_hi"))
    for k, name in enumerate(SKETCH):
        h = F.col(f"h{k // 32}")
        out.append(F.sum(F.shiftrightunsigned(h, k % 32).bitwiseAND(F.lit(PAIR))).alias(name))
    return out


def vector() -> Column:
    """Array of all lanes modulo 2**32: exact lanes, signs' +1 counts, phrases, paragraphs."""
    m = F.lit(MODULUS)
    exact = [F.pmod(F.col(f"{n}_{half}"), m) for n in EXACT for half in ("lo", "hi")]
    signs = []
    for n in SKETCH:
        signs += [F.col(n).bitwiseAND(F.lit(MODULUS - 1)), F.shiftrightunsigned(F.col(n), 32)]
    return F.array(*exact, *signs, F.pmod(F.col("phrases"), m), F.pmod(F.col("paragraphs").cast("long"), m))


def text_vectors(df: DataFrame, text: Column, keys: list[str]) -> DataFrame:
    """``keys`` and ``lanes``: the summed vector of ``text`` for each distinct ``keys``."""
    return paragraph_vectors(df.select(*keys, F.explode(F.split(text, "\n")).alias("paragraph")), keys)


def paragraph_vectors(paragraphs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``lanes``: the summed vector of the column ``paragraph`` for each distinct ``keys``."""
    rows = phrase_rows(paragraphs, keys)
    hashes = [F.xxhash64(F.lit(k + 1), "phrase.x", "phrase.y").alias(f"h{k}") for k in range(SKETCH_HASHES)]
    rows = rows.select(*keys, *EXACT, "at", *hashes)
    return rows.groupBy(*keys).agg(*summed_lanes()).select(*keys, vector().alias("lanes"))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Vector of the union (sign 1) of two multisets, or of ``a`` without ``b`` (sign -1)."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + sign * y, F.lit(MODULUS)))


def shown(lanes: Column) -> Column:
    """The fingerprint as a string: 8 hexadecimal digits a lane."""
    return F.array_join(F.transform(lanes, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated cosine of two texts' phrase counts, from their vectors; 1 for equal vectors."""
    phrases = EXACT_LANES + SKETCH_LANES + 1

    def signs(v: Column) -> Column:
        n = F.element_at(v, phrases)
        return F.transform(F.slice(v, EXACT_LANES + 1, SKETCH_LANES), lambda x: (2 * x - n).cast("double"))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    sa, sb = signs(a), signs(b)
    norm = F.sqrt(dot(sa, sa)) * F.sqrt(dot(sb, sb))
    value = F.when(norm > 0, dot(sa, sb) / norm).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def neighbour_blocks(df: DataFrame, id_col: str) -> DataFrame:
    """``df`` in blocks of neighbouring ids (descending), each followed by the next block's first rows.

    Adds ``block`` and ``guest``: 0 for a block's own rows, 1 for copies of the rows that come
    next in descending order of id (after the last block: those of the first).  Blocks follow the
    ids' quantiles and are divided evenly within.  Null ids come last.
    """
    total, low = df.agg(F.count("*"), F.min(id_col)).first()
    cuts_wanted = max(1, min(MAX_CUTS, total // BLOCK_ROWS))
    within = max(1, min(MAX_PARTS, math.ceil(total / (cuts_wanted * BLOCK_ROWS))))
    share = [k / cuts_wanted for k in range(cuts_wanted + 1)]
    cuts = df.agg(F.percentile_approx(id_col, share, 10_000)).first()[0] if low is not None else None
    if cuts is None:
        block = F.lit(0).cast("long")
    else:
        cuts = sorted(set(cuts) | {low})
        c = F.array(*[F.lit(x).cast("long") for x in cuts])
        slot = F.size(F.filter(c, lambda x: x <= F.col(id_col)))
        lo = F.element_at(c, slot)
        hi = F.element_at(c, F.least(slot + 1, F.lit(len(cuts))))
        step = F.when(hi > lo, F.floor((F.col(id_col).cast("double") - lo) / (hi.cast("double") - lo) * within)).otherwise(0)
        block = F.when(F.col(id_col).isNull(), F.lit(-1)).otherwise(
            slot * within + F.least(F.greatest(step, F.lit(0)), F.lit(within - 1))).cast("long")
    ordered = df.withColumn("block", block)
    # one row a block: its first id, and the block that comes before it (the first block follows the last)
    firsts = ordered.groupBy("block").agg(F.max(id_col).alias("first_id"))
    line = Window.orderBy(F.desc("block"))
    firsts = firsts.select("first_id", F.coalesce(F.lag("block").over(line), F.min("block").over(Window.partitionBy())).alias("host"))
    marked = ordered.join(F.broadcast(firsts), F.col(id_col).eqNullSafe(F.col("first_id")), "left")
    place = F.struct(F.col("block"), F.lit(0).alias("guest"))
    guest = F.struct(F.col("host").alias("block"), F.lit(1).alias("guest"))
    placed = F.when(F.col("host").isNull(), F.array(place)).otherwise(F.array(place, guest))
    return marked.withColumn("place", F.explode(placed)).drop("block", "host", "first_id").select("*", "place.*").drop("place")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every text, of its edited text, and their likeness; one row for each row.

    Each paragraph is hashed once: the edited text's vector is the sum of the paragraphs it keeps, of
    those it takes and of the joint between them (``combine``).

    The edited text is the first half with the last floor(n/2) code points replaced by the first
    as many of the next document's (descending id; after the last, the first).  Null text counts
    as empty; repeated ids follow each other by text; a single row is its own next.  Other columns
    are not read.  Returns ``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)``.
    """
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    order = Window.partitionBy("block").orderBy("guest", F.desc_nulls_last("id"), "text")
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    placed = neighbour_blocks(docs, "id").select("block", "guest", "id", "text", n.alias("n"), half.alias("half"))
    rows = placed.select("*", F.row_number().over(order).alias("pos"), F.coalesce(F.lead("text").over(order), F.lit("")).alias("next_text"),
                         F.coalesce(F.lag("half").over(order), F.lit(0)).alias("lent"))
    rows = rows.withColumn("kept", F.substring("text", F.lit(1), F.col("n") - F.col("half")))
    rows = rows.withColumn("put", F.substring("next_text", F.lit(1), F.col("half")))
    rows = rows.withColumn("sha", F.sha2(F.concat("kept", "put").cast("binary"), 256))
    keys = ["block", "pos", "guest", "id", "n", "sha"]
    # every paragraph is hashed once; the edited text's vector is put together from sums over parts of both texts
    parts = rows.select(*keys, F.explode(_marked_paragraphs()).alias("p")).select(*keys, "p.part", "p.paragraph")
    sums = paragraph_vectors(parts, [*keys, "part"])
    by_part = sums.groupBy(*keys).agg(*[F.max(F.when(F.col("part") == k, F.col("lanes"))).alias(f"v{k}") for k in range(JOINT + 1)])
    none = F.array_repeat(F.lit(0).cast("long"), EXACT_LANES + SKETCH_LANES + 2)
    v = [F.coalesce(f"v{k}", none) for k in range(JOINT + 1)]
    both = by_part.select(*keys, combine(combine(v[0], v[KEPT]), combine(v[LENT], v[KEPT + LENT])).alias("own"),
                          combine(combine(v[KEPT], v[KEPT + LENT]), v[JOINT]).alias("stays"), combine(v[LENT], v[KEPT + LENT]).alias("lent"))
    following = Window.partitionBy("block").orderBy("pos")
    both = both.withColumn("after", F.lead("own").over(following)).withColumn("comes", F.coalesce(F.lead("lent").over(following), none))
    both = both.where("guest = 0").withColumn("changed", combine(F.col("stays"), F.col("comes")))
    return both.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_chars"), F.col("sha").alias("edited_sha256"),
                       shown(F.col("own")).alias("fingerprint"), shown(F.col("changed")).alias("edited_fingerprint"),
                       likeness(F.col("own"), F.col("changed")).alias("near_edited"),
                       likeness(F.col("own"), F.col("after")).alias("near_next"))


#: Parts of a text's paragraphs: those its edit keeps, those it lends to the edit of the text before it (the sum of
#: both marks: either), and the paragraphs of its edit that are whole in neither text.
KEPT, LENT, JOINT = 1, 2, 4


def _marked_paragraphs() -> Column:
    """``(paragraph, part)`` of a text and, if it is no guest, of the joint of its edit.

    Whole paragraphs before the cut are kept; whole paragraphs inside what the text before takes are lent.  At the
    joint the cut paragraph runs on into the first one taken, and the last one taken may be cut off.
    """
    kept, put = F.split("kept", "\n"), F.split("put", "\n")
    whole = F.size(kept) - 1
    taken = F.size(F.split(F.substring("text", F.lit(1), F.col("lent")), "\n"))
    own = F.transform(F.split("text", "\n"), lambda x, i: F.struct(
        x.alias("paragraph"), (F.when(i < whole, KEPT).otherwise(0) + F.when((i > 0) & (i < taken - 1), LENT).otherwise(0)).alias("part")))
    seam = F.concat(F.element_at(kept, -1), F.element_at(put, 1))
    joint = F.when(F.size(put) > 1, F.array(seam, F.element_at(put, -1))).otherwise(F.array(seam))
    joint = F.transform(joint, lambda x: F.struct(x.alias("paragraph"), F.lit(JOINT).alias("part")))
    return F.when(F.col("guest") == 0, F.concat(own, joint)).otherwise(own)
