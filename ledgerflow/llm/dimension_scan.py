"""Approximate nearest neighbours by cosine with an adaptive dimension scan (operator 6).

Equal vectors form one class.  Classes are dealt to inverted lists by their nearest of a few
centroids, which are fitted on a bounded sample; every class is indexed.  Vectors are scaled to
length one and rotated at random, so that the distance over the first d of D dimensions, times
D / d, estimates the whole.  Within a probed list the vectors lie in blocks of columns: after
each block a test drops the candidates whose estimate is too far beyond the query's current k-th
distance to be a chance result.  What survives all blocks is scored exactly on the original
vectors in double precision.

How many lists a query probes is fitted too: the share that finds RECALL of the sample's true
neighbours.  Data without clusters so lead to many probes rather than to lost neighbours.  Where the
probed lists hold too few vectors, a query goes on to its next nearest list until they are enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_keyed, stored

#: Rows of the sample that centroids and probes are fitted on, its queries, and k-means rounds.
SAMPLE_ROWS, SAMPLE_QUERIES, ROUNDS = 20_000, 200, 8
LIST_ROWS, MOST_LISTS = 512, 1024
#: Recall on the sample at which the number of probed lists is set.
RECALL = 0.97
#: Columns of a block, and the width of the test in its standard errors.
BLOCK, EPSILON = 16, 2.1
#: Rows of a list, and queries, that meet in one task's group.
CELL_ROWS, CELL_QUERIES = 4096, 2048


def unit(x):
    """Rows of ``x`` scaled to length one, also where squares would overflow or vanish."""
    import numpy as np

    x = np.asarray(x, np.float64)
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def cosine(a, b):
    """Cosine of the rows of ``a`` and ``b`` in double precision."""
    import numpy as np

    a, b = np.asarray(a, np.float64), np.asarray(b, np.float64)
    norms = np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1)
    plain = (norms > 1e-100) & (norms < 1e100)
    out = np.einsum("ij,ij->i", unit(a), unit(b)) if not plain.all() else np.empty(len(a))
    out[plain] = np.einsum("ij,ij->i", a[plain], b[plain]) / norms[plain]
    return out


def rotation(dims: int, seed: int = 11):
    import numpy as np

    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def fit_lists(sample, lists: int, k: int, seed: int = 5):
    """Centroids of the sample's unit rows, and the number of lists to probe."""
    import numpy as np

    rng = np.random.default_rng(seed)
    x = unit(sample)
    lists = max(1, min(lists, len(x) // 8))
    centroids = x[rng.choice(len(x), lists, replace=False)]
    for _ in range(ROUNDS):
        own = (x @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centroids)
    own = (x @ centroids.T).argmax(axis=1)
    rows = rng.choice(len(x), min(SAMPLE_QUERIES, len(x)), replace=False)
    near = x[rows] @ x.T
    near[np.arange(len(rows)), rows] = -2
    true = np.argsort(-near, axis=1)[:, :k]
    place = np.argsort(np.argsort(-(x[rows] @ centroids.T), axis=1), axis=1)
    ranks = np.sort(np.take_along_axis(place, own[true], axis=1).ravel())
    probes = int(ranks[min(len(ranks) - 1, int(np.ceil(RECALL * len(ranks))))]) + 1
    return centroids, min(lists, probes)


def lists_to_probe(near, sizes, probes: int, wanted: int):
    """Lists that each query probes, as (query's row, list): the ``probes`` nearest ones, and further
    ones in order of nearness until they hold ``wanted`` rows or no list is left.

    ``near``: nearness of each query (row) to each list; ``sizes``: rows of each list.
    """
    import numpy as np

    order = np.argsort(-near, axis=1, kind="stable")
    reach = (sizes[order].cumsum(axis=1) < wanted).sum(axis=1) + 1
    taken = np.arange(near.shape[1]) < np.minimum(np.maximum(reach, probes), near.shape[1])[:, None]
    return np.nonzero(taken)[0], order[taken]


def scan(queries, rows, k: int):
    """For each query (unit, rotated) the indexes of its ``k`` nearest ``rows``, by adaptive scan."""
    import numpy as np

    n, dims = rows.shape
    bounds = list(range(0, dims, BLOCK)) + [dims]
    blocks = [np.ascontiguousarray(rows[:, a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for q in queries:
        first = np.arange(min(n, 4 * k))
        d = ((rows[first] - q) ** 2).sum(axis=1)
        best = first[np.argsort(d, kind="stable")[:k]]
        best_d = np.sort(d, kind="stable")[:k]
        for start in range(len(first), n, 1024):
            alive = np.arange(start, min(n, start + 1024))
            partial = np.zeros(len(alive))
            limit = best_d[-1] if len(best_d) == k else np.inf
            for block, a, b in zip(blocks, bounds[:-1], bounds[1:], strict=True):
                diff = block[alive] - q[a:b]
                partial += np.einsum("ij,ij->i", diff, diff)
                # estimate of the whole distance against the limit, widened by its error
                stays = partial * (dims / b) <= limit * ((1 + EPSILON / np.sqrt(b)) ** 2 if b < dims else 1) + 1e-9
                if not stays.all():
                    alive, partial = alive[stays], partial[stays]
                    if not len(alive):
                        break
            if len(alive):
                both, both_d = np.concatenate((best, alive)), np.concatenate((best_d, partial))
                order = np.argsort(both_d, kind="stable")[:k]
                best, best_d = both[order], both_d[order]
        yield best


def _matrix(column, dims: int):
    import numpy as np

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(-1, dims)


def nearest(df: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query row's ``k`` nearest other rows by cosine.

    ``is_query``: condition on the id column.  Ties go to the smaller id.  Rows with a null id and
    vectors that are null, zero, hold null or non-finite components, or have another length than
    most, take no part.  Repeated rows count once.  A query has ``k`` neighbours wherever there are as
    many other rows, and all other rows where there are fewer.
    """
    sound = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(vector_col, lambda x: x != 0)
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
                     F.size(vector_col).alias("dims"), F.coalesce(is_query, F.lit(False)).alias("asks")).where(F.col("id").isNotNull() & sound)
    common = rows.groupBy("dims").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    id_type = df.schema[id_col].dataType.simpleString()
    empty = df.sparkSession.createDataFrame([], f"query_id {id_type}, rank int, vec_id {id_type}, score double")
    if common is None:
        return empty
    dims, total = common["dims"], common["n"]
    rows = rows.where(F.col("dims") == dims).select("id", "asks", F.sha2(F.to_json("v").cast("binary"), 256).alias("digest"), "v")
    # classes of equal vectors: the k + 1 smallest ids of each are all that any query can be given
    order = Window.partitionBy("digest").orderBy("id")
    least = rows.select("digest", "id", "v").distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    classes = stored(least.groupBy("digest").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.first("v").alias("v")))
    asking = stored(rows.where("asks").select("id", "digest").distinct())

    sample = classes.orderBy("digest").limit(SAMPLE_ROWS).select("v").toArrow().column("v")
    sample = _matrix(sample, dims)
    n_classes = classes.count()
    centroids, probes = fit_lists(sample, min(MOST_LISTS, max(1, n_classes // LIST_ROWS)), k + 1)
    shared = df.sparkSession.sparkContext.broadcast((centroids, rotation(dims)))  # at most MOST_LISTS rows

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = unit(_matrix(batch.column("v"), dims)) @ shared.value[0].T
            yield pa.RecordBatch.from_arrays([pa.array(near.argmax(axis=1), pa.int32()), *batch.columns], names=["list", *batch.schema.names])

    listed = classes.mapInArrow(dealt, f"list int, digest string, ids array<{id_type}>, v array<double>")
    sizes = {r["list"]: r["n"] for r in listed.groupBy("list").agg(F.count("*").alias("n")).collect()}  # at most MOST_LISTS rows
    held = [sizes.get(x, 0) for x in range(len(centroids))]

    def probing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            near = unit(_matrix(batch.column("v"), dims)) @ shared.value[0].T
            rows_of, lists = lists_to_probe(near, np.array(held), probes, k + 1)
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int32()), *[c.take(pa.array(rows_of)) for c in batch.columns]],
                                             names=["list", *batch.schema.names])

    seekers = classes.join(asking.select("digest").distinct(), "digest", "left_semi").select("digest", "v")
    asked = seekers.mapInArrow(probing, "list int, digest string, v array<double>").where(F.col("list").isin(list(sizes)))
    probed = {r["list"]: r["n"] for r in asked.groupBy("list").agg(F.count("*").alias("n")).collect()}  # at most MOST_LISTS rows
    # rows and queries of one list meet in pieces of bounded size: a list is copied as often as its own queries need
    pieces = F.create_map(*[F.lit(x) for key, n in sizes.items()
                            for x in (key, F.struct(F.lit(-(-n // CELL_ROWS)).alias("cells"), F.lit(-(-probed.get(key, 0) // CELL_QUERIES)).alias("groups")))])
    listed = listed.withColumn("p", pieces[F.col("list")]).where(F.col("p.groups") > 0)
    listed = listed.withColumn("cell", F.pmod(F.xxhash64("digest"), F.col("p.cells")).cast("int")) \
        .withColumn("seekers", F.explode(F.sequence(F.lit(0), F.col("p.groups") - 1))).drop("p")
    asked = asked.withColumn("p", pieces[F.col("list")]).withColumn("seekers", F.pmod(F.xxhash64("digest"), F.col("p.groups")).cast("int")) \
        .withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("p.cells") - 1))).drop("p")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        import numpy as np

        q, r, ids = [], [], []
        if left.num_rows and right.num_rows:
            x, y = _matrix(left.column("v"), dims), _matrix(right.column("v"), dims)
            turn = shared.value[1]
            for i, best in enumerate(scan(unit(x) @ turn, unit(y) @ turn, k + 1)):
                q.append(np.full(len(best), i))
                r.append(best)
            q, r = np.concatenate(q), np.concatenate(r)
            scores, ids = cosine(x[q], y[r]), right.column("ids").take(pa.array(r))
            digests = left.column("digest").take(pa.array(q))
            return pa.table({"digest": digests, "ids": ids, "score": pa.array(scores)})
        return pa.table({"digest": pa.array([], pa.string()), "ids": pa.array([], right.schema.field("ids").type), "score": pa.array([], pa.float64())})

    keys = ["list", "cell", "seekers"]
    found = asked.groupBy(keys).cogroup(listed.groupBy(keys)).applyInArrow(meet, f"digest string, ids array<{id_type}>, score double")
    ranked = Window.partitionBy("digest").orderBy(F.desc("score"), "vec_id")
    found = (found.select("digest", F.explode("ids").alias("vec_id"), "score")
             .withColumn("n", F.row_number().over(ranked)).where(F.col("n") <= k + 1)
             .groupBy("digest").agg(F.collect_list(F.struct("score", "vec_id")).alias("near")))
    sizes_of = asking.groupBy("digest").agg(F.count("*").alias("n_asking"))
    found = stored(found.join(sizes_of, "digest"))
    each = join_keyed(asking.withColumnRenamed("id", "query_id"), found, "digest", "n_asking", max(1, asking.count()))
    each = each.select("query_id", F.explode("near").alias("e")).select("query_id", "e.vec_id", "e.score").where("vec_id <> query_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
