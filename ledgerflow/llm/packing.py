"""Lexical retrieval packing (operator 5).

Documents are tokenized where they are read and dealt to shards of bounded size in reading
order, so nothing is shuffled.  Each shard builds a BM25 inverted index over the token ids of
its documents.  A seed document asks the index for unused neighbours until its window is full or
no other document of the shard shares a term with it; they fill the window best first, and the neighbour that crosses the window's end is cut there and is
the next seed, so no position is lost to padding.  The last window of a shard is cut into
sequences whose lengths are powers of two, which need no padding either.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_batches
from .tokens import IdEncoder, encoder

#: Documents and tokens at which a shard is closed (a longer document makes a shard by itself).
SHARD_DOCS = 2048
SHARD_TOKENS = 4_000_000
#: A seed is first looked up by its so many terms of most BM25 weight, and neighbours come back so many at a time;
#: where these do not fill the window, the others follow, and then what shares any other term.
QUERY_TERMS = 24
NEIGHBOURS = 16
K1, BM25_B = 1.2, 0.75


class ShardIndex:
    """BM25 inverted index of one shard: postings by term in arrays."""

    def __init__(self, docs: list):
        import numpy as np

        self.np = np
        terms, freqs, owner = [], [], []
        self.lengths = np.array([len(d) for d in docs], dtype=np.float64)
        self.by_doc = []
        for k, d in enumerate(docs):
            t = np.sort(d)
            first = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1]))) if len(t) else np.zeros(0, np.int64)
            tf = np.diff(np.append(first, len(t))).astype(np.float32)
            terms.append(t[first])
            freqs.append(tf)
            owner.append(np.full(len(first), k, np.int32))
        sizes = np.array([len(t) for t in terms])
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        all_terms, tf, owner = np.concatenate(terms), np.concatenate(freqs), np.concatenate(owner)
        df = np.bincount(all_terms, minlength=1).astype(np.float64)
        n = len(docs)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - BM25_B + BM25_B * self.lengths / max(1.0, self.lengths.mean()))
        weight = (idf[all_terms] * tf * (K1 + 1) / (tf + norm[owner])).astype(np.float32)
        self.doc_terms, self.doc_weight = all_terms, weight
        order = np.argsort(all_terms, kind="stable")
        self.post_doc, self.post_weight = owner[order], weight[order]
        self.post_at = np.concatenate(([0], np.cumsum(df.astype(np.int64))))
        self.df, self.n = df, n

    def neighbours(self, doc: int, used, query_terms: int | None = QUERY_TERMS) -> list[int]:
        """The best unused documents that share one of the seed's ``query_terms`` of most weight (None: any), best first."""
        np = self.np
        a, b = self.starts[doc], self.starts[doc + 1]
        terms, weight = self.doc_terms[a:b], self.doc_weight[a:b]
        alone = self.df[terms] > 1
        terms, weight = terms[alone], weight[alone]
        if not len(terms):
            return []
        if query_terms is not None and len(terms) > query_terms:
            terms = terms[np.argpartition(-weight, query_terms)[:query_terms]]
        spans = [slice(self.post_at[t], self.post_at[t + 1]) for t in terms]
        scores = np.bincount(np.concatenate([self.post_doc[s] for s in spans]),
                             np.concatenate([self.post_weight[s] for s in spans]), minlength=self.n)
        scores[used] = 0
        found = np.flatnonzero(scores)
        if len(found) > NEIGHBOURS:
            found = found[np.argpartition(-scores[found], NEIGHBOURS)[:NEIGHBOURS]]
        return found[np.lexsort((found, -scores[found]))].tolist()


def packing_order(docs: list, window: int) -> list[int]:
    """All documents of a shard in the order in which they fill windows."""
    import numpy as np

    index, used, order, room, fresh = ShardIndex(docs), np.zeros(len(docs), bool), [], window, 0

    def place(doc: int) -> bool:
        """Appends the document; whether it reached or crossed the end of the window."""
        nonlocal room
        used[doc] = True
        order.append(doc)
        room -= len(docs[doc])
        if over := room <= 0:
            room = window - (-room) % window
        return over

    seed = None
    while len(order) < len(docs):
        if seed is None:
            while used[fresh]:
                fresh += 1
            seed = fresh
            place(seed)
        crossed = None
        for query_terms in (QUERY_TERMS, None):  # first by the terms of most weight, then by any
            while crossed is None and (found := index.neighbours(seed, used, query_terms)):
                crossed = next((doc for doc in found if place(doc)), None)
        seed = crossed
    return order


def lengths_of(total: int, window: int) -> list[int]:
    """Sequence lengths for ``total`` tokens: full windows, then the powers of two of the rest."""
    full, rest = divmod(total, window)
    return [window] * full + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = 1024,
         end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of every document, placed in sequences of at most ``window`` (a power of two) tokens.

    One row a piece: ``(id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` and,
    with ``with_ids``, the piece's ids as ``array<int>``.  A document is its ids and ``end_id``;
    null and empty texts are that one id.  Repeated rows are documents of their own.  Empty
    input gives no rows.  Columns of other names are not read.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def shard_rows(keys: list, docs: list, first_sequence: int):
        import numpy as np

        order = packing_order(docs, window)
        lengths = iter(lengths_of(sum(map(len, docs)), window))
        rows: list[list] = [[] for _ in names]
        sequence, offset, room = first_sequence - 1, 0, 0
        for doc in order:
            ids, start = docs[doc], 0
            while start < len(ids):
                if room == 0:
                    sequence, offset, room = sequence + 1, 0, next(lengths)
                n = min(room, len(ids) - start)
                piece = ids[start:start + n].astype("<u4")
                for column, value in zip(rows, (keys[doc], start, n, zlib.crc32(piece), len(ids), sequence, offset), strict=False):
                    column.append(value)
                if with_ids:
                    rows[-1].append(piece.astype(np.int32))
                start, offset, room = start + n, offset + n, room - n
        return rows, sequence + 1

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        source = encoder(IdEncoder, path)
        sequence = TaskContext.get().partitionId() << 40
        keys: list = []
        docs: list = []
        tokens = 0
        id_field = pa.null()

        def flush():
            nonlocal keys, docs, tokens, sequence
            rows, sequence = shard_rows(keys, docs, sequence)
            kinds = [id_field, *[pa.int64()] * 6, *[pa.list_(pa.int32())] * with_ids]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=names)
            keys, docs, tokens = [], [], 0
            return out

        end = np.array([end_id], dtype=source.width).tobytes()
        for batch in batches:
            id_field = batch.schema.field(0).type
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                docs.append(np.frombuffer(source.ids(text.as_py() or "") + end, dtype=source.width))
                keys.append(key.as_py())
                tokens += len(docs[-1])
                if len(docs) >= SHARD_DOCS or tokens >= SHARD_TOKENS:
                    yield flush()
        if docs:
            yield flush()

    schema = f"`{id_col}` {id_type}, " + ", ".join(f"{c} long" for c in names[1:7]) + ", ids array<int>" * with_ids
    return text_batches(df).select(id_col, text_col).mapInArrow(packed, schema)
