"""SentencePiece encoding and decoding (operator 2).

Unigram search (``Pieces``): the pieces are put into a double-array trie over bytes, all new parts of
a batch are segmented together, the trie is walked for all of them at once in numpy, and the Viterbi
score of every later position is updated.  It needs log scores.  A unigram model's file has them; a
BPE model's scores are minus the rank of a merge and must not be added up, so ``fit`` learns log
scores for its pieces from the whole corpus: Viterbi rounds over the counted parts of all texts, from
scores that fall with the rank by Zipf's law.

``MergedPieces`` is the search of a BPE model itself, which gives the ids of the library:
neighbours that make a piece are merged, the best score first, the leftmost of equal ones.  It is
what ``encode`` and ``round_trip`` use for such a file if they are given no scores.

A text is marked (space becomes the marker, one marker in front) and cut where no piece can cross,
so its segmentation is that of its parts.  A letter that no piece covers becomes its bytes, and
decoding joins bytes again.
"""

from __future__ import annotations

import functools
import heapq
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_batches

MARK = "▁"
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Trainer type of a model whose scores are ranks of merges.
BPE = 2
#: Parts of more letters are merged with a queue.
QUEUE_LETTERS = 100
#: An unknown letter scores this much below the lowest piece.
UNKNOWN_PENALTY = 10.0
CUT = re.compile(f"(?<=[^{MARK}])(?={MARK})")
TABLE_ENTRIES, SLICE_CHARS = 600_000, 1 << 20
#: Different parts, and letters of texts, that a task counts before it passes the counts on.
COUNTED_PARTS, COUNTED_CHARS = 500_000, 1 << 25
#: Viterbi rounds of ``fit``.
ROUNDS = 1


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a serialized message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, data[at:at + n]
            at += n
        else:
            n = 4 if kind == 5 else 8
            yield tag >> 3, struct.unpack("<f" if n == 4 else "<d", data[at:at + n])[0]
            at += n


def read_model(path: str) -> tuple[list[tuple[str, float, int]], bool]:
    """Pieces (text, score, kind) in the order of their ids, and whether a marker is put in front."""
    pieces, prefix = [], True
    with open(path, "rb") as f:
        data = f.read()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append((piece[1].decode("utf-8"), float(piece.get(2, 0.0)), int(piece.get(3, NORMAL))))
        elif number == 3:
            prefix = bool(dict(_fields(value)).get(3, 1))
    return pieces, prefix


def model_type(path: str) -> int:
    """Trainer type of a model file; 1 (unigram) where it names none."""
    with open(path, "rb") as f:
        return next((int(dict(_fields(value)).get(3, 1)) for number, value in _fields(f.read()) if number == 2), 1)


class DoubleArray:
    """Trie over bytes in two arrays: child of state s by byte b is base[s] + b + 1 if check names s."""

    def __init__(self, words: list[bytes], values: list[int]):
        import numpy as np

        order = sorted(range(len(words)), key=words.__getitem__)
        size = 1 << 16
        base, check, value = [0] * size, [-1] * size, [-1] * size
        check[0], free = 0, 1
        todo = [(0, 0, len(order), 0)]
        while todo:
            state, lo, hi, depth = todo.pop()
            if lo < hi and len(words[order[lo]]) == depth:
                value[state] = values[order[lo]]
                lo += 1
            edges = []
            while lo < hi:
                b, start = words[order[lo]][depth], lo
                while lo < hi and words[order[lo]][depth] == b:
                    lo += 1
                edges.append((b, start, lo))
            if not edges:
                continue
            slot, taken, first = max(free, edges[0][0] + 1), 0, True
            while True:
                if slot + 258 > len(check):
                    base += [0] * size
                    check += [-1] * size
                    value += [-1] * size
                if check[slot] == -1:
                    if first:
                        free, first = max(free, slot if slot > 258 else free), False
                    at = slot - edges[0][0] - 1
                    if all(check[at + b + 1] == -1 for b, _, _ in edges):
                        break
                else:
                    taken += 1
                slot += 1
                if taken * 20 >= 19 * (slot - free) and slot - free > 512:
                    free, taken = slot, 0  # what lies behind is nearly full: look there no more
            base[state] = at
            for b, start, end in edges:
                check[at + b + 1] = state
                todo.append((at + b + 1, start, end, depth + 1))
        self.base, self.check, self.value = (np.array(x + [y] * 258, np.int32) for x, y in ((base, 0), (check, -1), (value, -1)))


class Pieces:
    """Encoder and decoder of one model file, by best sum of log scores (``scores``, or the file's own)."""

    def __init__(self, path: str, scores=None):
        self.given = scores
        self.pieces, self.prefix = read_model(path)
        plain = [k for k, (_, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER, UNUSED)]
        self.unknown = next((k for k, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)
        self.byte_ids = {int(p[0][3:5], 16): k for k, p in enumerate(self.pieces) if p[2] == BYTE}
        self.bytes_of = {k: bytes([b]) for b, k in self.byte_ids.items()}
        self.shown = [p[0].replace(MARK, " ") for p in self.pieces]
        self.ordinary = frozenset(plain)
        self.known: dict[str, bytes] = {}
        self._prepare(plain)

    def _prepare(self, plain: list[int]) -> None:
        import numpy as np

        self.trie = DoubleArray([self.pieces[k][0].encode("utf-8") for k in plain], plain)
        self.scores = np.array([s for _, s, _ in self.pieces] if self.given is None else self.given, np.float32)
        normal = [float(s) for s, (_, _, kind) in zip(self.scores, self.pieces, strict=True) if kind == NORMAL]
        self.scores[[k for k in plain if self.pieces[k][2] == UNUSED]] = -np.inf
        top = max(normal, default=0.0)
        for k in plain:  # a user's piece wins over any segmentation of its letters
            if self.pieces[k][2] == USER:
                self.scores[k] = len(self.pieces[k][0]) * top - 0.1
        self.unknown_score = np.float32(min(normal, default=0.0) - UNKNOWN_PENALTY)

    def parts(self, text: str) -> list[str]:
        if self.prefix and text and MARK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return [MARK + word for word in text.split(" ")]  # what the cut gives where spaces are single
        return CUT.split(self.marked(text)) if text else []

    def marked(self, text: str) -> str:
        return (MARK if self.prefix else "") + text.replace(" ", MARK) if text else ""

    def segment(self, parts: list[bytes]) -> list[bytes]:
        """Ids of the best segmentation of each part (UTF-8 bytes, none empty), all side by side."""
        import numpy as np

        if not parts:
            return []
        lengths = np.array([len(p) for p in parts])
        width = int(lengths.max())
        # a row for each position, a column for each part: a step reads its row in order
        letters = np.zeros((width + 1, len(parts)), np.int32)
        for n in np.unique(lengths):
            which = np.flatnonzero(lengths == n)
            letters[:n, which] = np.frombuffer(b"".join([parts[k] for k in which]), np.uint8).reshape(len(which), n).T
        best = np.full((width + 1, len(parts)), -np.inf, np.float32)
        best[0] = 0
        via = np.full((width + 1, len(parts)), -1, np.int32)  # piece that ends here, -2: unknown letter
        back = np.zeros((width + 1, len(parts)), np.int32)
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        starts = (letters & 0xC0) != 0x80
        step = np.where(letters < 0x80, 1, np.where(letters < 0xE0, 2, np.where(letters < 0xF0, 3, 4)))
        for i in range(width):
            rows = np.flatnonzero((lengths > i) & starts[i])
            if not len(rows):
                continue
            score, size, single = best[i][rows], step[i][rows], np.zeros(len(rows), bool)
            live, who, state, at = np.arange(len(rows)), rows, np.zeros(len(rows), np.int32), i
            while len(live):
                nxt = base[state] + letters[at][who] + 1
                fits = np.flatnonzero((check[nxt] == state) & (at < lengths[who]))
                live, who, state = live[fits], who[fits], nxt[fits]
                at += 1
                piece = value[state]
                ends = np.flatnonzero(piece >= 0)
                if len(ends):
                    k, r, piece = live[ends], who[ends], piece[ends]
                    single[k] |= at - i == size[k]
                    total = score[k] + self.scores[piece]
                    better = np.flatnonzero(total > best[at][r])
                    r = r[better]
                    best[at][r], via[at][r], back[at][r] = total[better], piece[better], i
                if at > width:
                    break
            lone = rows[~single]
            if len(lone):
                end = i + step[i][lone]
                total = best[i][lone] + self.unknown_score
                better = total > best[end, lone]
                r, end = lone[better], end[better]
                best[end, r], via[end, r], back[end, r] = total[better], -2, i
        # all parts back from their ends at once; unknown letters are opened up part by part
        rows, at, taken = np.arange(len(parts)), lengths.copy(), []
        while (at > 0).any():
            piece = np.where(at > 0, via[at, rows], -1)
            taken.append(piece)
            at = np.where(at > 0, back[at, rows], 0)
        steps = np.stack(taken[::-1], axis=1)
        there = steps != -1
        data = steps[there].astype("<u4").tobytes()
        ends = (4 * np.cumsum(there.sum(axis=1))).tolist()
        out = [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        for k in np.flatnonzero((steps == -2).any(axis=1)):
            ids: list[int] = []
            pos = int(lengths[k])
            while pos:
                piece, start = int(via[pos, k]), int(back[pos, k])
                if piece >= 0:
                    ids.append(piece)
                elif self.byte_ids:
                    ids += [self.byte_ids[b] for b in reversed(parts[k][start:pos])]
                else:
                    ids.append(self.unknown)
                pos = start
            out[k] = np.array(ids[::-1], "<u4").tobytes()
        return out

    def learn(self, parts: set[str]) -> None:
        data = sorted(((p.encode("utf-8"), p) for p in parts), key=lambda x: len(x[0]))
        at = 0
        while at < len(data):  # parts of like length together, so that little is padded
            end = at + 1
            while end < len(data) and len(data[end][0]) <= len(data[at][0]) + 8 and (end - at) * len(data[end][0]) < 400_000:
                end += 1
            self.known.update(zip([p for _, p in data[at:end]], self.segment([b for b, _ in data[at:end]]), strict=True))
            at = end

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        group: list[list[str]] = []
        size = 0
        for text in texts:
            group.append(self.parts(text))
            size += len(text)
            if size >= SLICE_CHARS:
                out += self._group(group)
                group, size = [], 0
        return out + self._group(group)

    def _group(self, group: list[list[str]]) -> list[bytes]:
        new = set().union(*group).difference(self.known)
        if len(self.known) + len(new) > TABLE_ENTRIES:
            short = {p: v for p, v in self.known.items() if len(p) <= 8}
            self.known = short if len(short) < TABLE_ENTRIES // 2 else {}
            new = set().union(*group).difference(self.known)
        self.learn(new)
        return [b"".join(map(self.known.__getitem__, parts)) for parts in group]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: bytes are joined, markers become spaces, the marker in front goes."""
        if self.ordinary.issuperset(ids):
            text = "".join(map(self.shown.__getitem__, ids))
            return text[1:] if self.prefix and text.startswith(" ") else text
        out, run = [], []

        def flush() -> None:
            if run:
                out.append(b"".join(run).decode("utf-8", "replace"))
                run.clear()

        for k in ids:
            text, _, kind = self.pieces[k]
            if kind == BYTE:
                run.append(self.bytes_of[k])
                continue
            flush()
            if kind == UNKNOWN:
                out.append(" ⁇ ")
            elif kind != CONTROL:
                out.append(text)
        flush()
        text = "".join(out).replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


class MergedPieces(Pieces):
    """Encoder and decoder of one model file, by its order of merges."""

    def _prepare(self, plain: list[int]) -> None:
        text = {k: self.pieces[k][0] for k in plain}
        user = sorted((t for k, t in text.items() if self.pieces[k][2] == USER), key=len, reverse=True)
        self.id_of = {t: k for k, t in text.items()}
        self.rank = {t: -self.pieces[k][1] for k, t in text.items()}
        self.unused = {t for k, t in text.items() if self.pieces[k][2] == UNUSED}
        self.user = re.compile(f"({'|'.join(map(re.escape, user))})") if user else None
        # a letter in no piece of several letters is a part by itself, like a user's piece
        merging = {c for t in text.values() if len(t) > 1 for c in t}
        inner = "".join(map(re.escape, sorted(merging - {MARK})))
        if any(CUT.search(t) for t in text.values()) or not inner:
            self.cut = re.compile(f"[{inner}{MARK}]+|.", re.S)
        else:
            self.cut = re.compile(f"{MARK}*[{inner}]+|{MARK}+|.", re.S)

    def parts(self, text: str) -> list[str]:
        if not text:
            return []
        if self.user is None:
            return self.cut.findall(self.marked(text))
        out: list[str] = []
        for k, stretch in enumerate(self.user.split(self.marked(text))):
            out += [stretch] if k % 2 else self.cut.findall(stretch)
        return out

    def learn(self, parts: set[str]) -> None:
        self.known.update((p, self._ids(p)) for p in parts)

    def _ids(self, part: str) -> bytes:
        ids: list[int] = []
        whole = self.user is not None and self.user.fullmatch(part)
        for symbol in [part] if whole else self.merge(part):
            k = self.id_of.get(symbol)
            if k is not None:
                ids.append(k)
            elif self.byte_ids:
                ids += [self.byte_ids[b] for b in symbol.encode("utf-8")]
            else:
                ids.append(self.unknown)
        return struct.pack(f"<{len(ids)}I", *ids)

    def merge(self, part: str) -> list[str]:
        """The part's symbols when no two neighbours make a piece any more."""
        rank, never = self.rank, float("inf")
        made: dict[str, tuple[str, str]] = {}
        if len(part) > QUEUE_LETTERS:
            out = self._merge_long(part, made)
        else:
            out = list(part)
            ranks = [rank.get(x + y, never) for x, y in zip(out, out[1:], strict=False)]
            while ranks:
                best = min(ranks)
                if best == never:
                    break
                k = ranks.index(best)
                if self.unused:
                    made[out[k] + out[k + 1]] = out[k], out[k + 1]
                out[k:k + 2] = [out[k] + out[k + 1]]
                del ranks[k]
                if k:
                    ranks[k - 1] = rank.get(out[k - 1] + out[k], never)
                if k < len(ranks):
                    ranks[k] = rank.get(out[k] + out[k + 1], never)
        return [s for x in out for s in self._opened(x, made)] if self.unused else out

    def _merge_long(self, part: str, made: dict[str, tuple[str, str]]) -> list[str]:
        symbols, n = list(part), len(part)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue: list[tuple[float, int, str, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (r := self.rank.get(symbols[a] + symbols[b])) is not None:
                heapq.heappush(queue, (r, a, symbols[a] + symbols[b], b))

        for k in range(n - 1):
            offer(k, k + 1)
        while queue:
            _, a, piece, b = heapq.heappop(queue)
            if not symbols[a] or after[a] != b or symbols[a] + symbols[b] != piece:
                continue  # one of the two has been merged since
            if self.unused:
                made[piece] = symbols[a], symbols[b]
            symbols[a], symbols[b], after[a] = piece, "", after[b]
            if after[a] >= 0:
                before[after[a]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [s for s in symbols if s]

    def _opened(self, symbol: str, made: dict[str, tuple[str, str]]) -> list[str]:
        if symbol not in self.unused or symbol not in made:
            return [symbol]
        return [s for x in made[symbol] for s in self._opened(x, made)]


@functools.lru_cache(maxsize=2)
def pieces_of(path: str, scores: bytes | None = None) -> Pieces:
    """One for each Python worker; ``scores``: fitted log scores as doubles."""
    if scores is not None:
        import numpy as np

        return Pieces(path, np.frombuffer(scores))
    return MergedPieces(path) if model_type(path) == BPE else Pieces(path)


def first_scores(path: str):
    """Log scores to fit from: a unigram file's own; for a BPE file log(1 / (rank * total)) by merge rank."""
    import numpy as np

    pieces, _ = read_model(path)
    scores = np.array([s for _, s, _ in pieces], np.float64)
    if model_type(path) == BPE:
        normal = np.array([k for k, p in enumerate(pieces) if p[2] == NORMAL])
        rank = np.empty(len(normal))
        rank[np.argsort(-scores[normal], kind="stable")] = np.arange(1, len(normal) + 1)
        scores[normal] = -np.log(rank) - np.log((1 / rank).sum())
    return scores


def count_parts(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``(part, n)``: the parts that the search cuts the texts into, counted over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, counts, chars = pieces_of(path, first), Counter(), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(pieces.parts(text or ""))
                chars += len(text or "")
                if len(counts) >= COUNTED_PARTS or chars >= COUNTED_CHARS:
                    yield _counted(counts)
                    counts, chars = Counter(), 0
        yield _counted(counts)

    first = first_scores(path).tobytes()
    partial = text_batches(df).select(text_col).mapInArrow(run, "part string, n long")
    return partial.groupBy("part").agg(F.sum("n").alias("n"))


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["part", "n"])


def count_pieces(parts: DataFrame, path: str, scores: bytes) -> dict[int, int]:
    """How often the best segmentation under ``scores`` uses each piece; at most one entry a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        pieces = pieces_of(path, scores)
        used = np.zeros(len(pieces.pieces), np.int64)

        def add(rows: list[tuple[str, int]]) -> None:
            rows.sort(key=lambda x: len(x[0]))
            at = 0
            while at < len(rows):  # parts of like length together, in slices of bounded size
                end, longest = at + 1, len(rows[at][0]) + 8
                while end < len(rows) and len(rows[end][0]) <= longest and (end - at) * longest < SLICE_CHARS // 4:
                    end += 1
                found = pieces.segment([p.encode("utf-8") for p, _ in rows[at:end]])
                each = np.repeat([n for _, n in rows[at:end]], [len(f) // 4 for f in found])
                np.add.at(used, np.frombuffer(b"".join(found), "<u4"), each)
                at = end

        held, chars = [], 0  # small Arrow batches are put together
        for batch in batches:
            for part, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.append((part, n))
                chars += len(part)
                if chars >= SLICE_CHARS:
                    add(held)
                    held, chars = [], 0
        add(held)
        ids = np.flatnonzero(used)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(used[ids])], names=["piece", "n"])

    counted = parts.mapInArrow(run, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return {r["piece"]: r["n"] for r in counted.collect()}  # at most one row a piece of the file


def fit(df: DataFrame, path: str, text_col: str = "text", rounds: int = ROUNDS):
    """Log scores of a file's pieces, fitted to all texts of ``df`` (an array by piece id).

    Each round segments every part of every text under the present scores and takes a piece's share
    of all pieces used, with the first scores as prior (one piece of prior for each piece of the
    file).  Counts are exact, so the scores do not depend on the layout of the table.  Without any
    text (an empty table, null or empty texts) the first scores are the result.
    """
    import numpy as np

    first = first_scores(path)
    normal = np.array([k for k, p in enumerate(read_model(path)[0]) if p[2] == NORMAL])
    prior = np.exp(first[normal])
    parts = count_parts(df, path, text_col)
    if rounds > 1:
        parts = stored(parts)
    scores = first.copy()
    for _ in range(rounds):
        used = count_pieces(parts, path, scores.tobytes())
        n = np.array([used.get(k, 0) for k in normal.tolist()], np.float64) + len(normal) * prior / prior.sum()
        scores[normal] = np.log(n / n.sum())
    return scores


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", scores=None) -> DataFrame:
    """``(id, ids)``: the pieces' ids of every text, by ``scores`` of ``fit`` or else by the file's own
    search.  Null and empty texts have none; repeated rows each get theirs; other columns are not read."""
    id_type = df.schema[id_col].dataType.simpleString()
    fitted = None if scores is None else scores.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            found = pieces_of(path, fitted).encode_all([t or "" for t in batch.column(1).to_pylist()])
            at = np.concatenate(([0], np.cumsum([len(b) // 4 for b in found]))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(at), pa.array(np.frombuffer(b"".join(found), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[id_col, "ids"])

    return text_batches(df).select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, ids array<int>")


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, text)``: the text of every list of ids; null or empty lists give empty texts."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [pieces_of(path).decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return text_batches(df).select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {id_type}, text string")


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", scores=None) -> DataFrame:
    """``(id, n_pieces, n_byte_pieces, ids_crc32, restored)`` of every text, encoded (see ``encode``)
    and decoded in one pass; ``restored``: decoding gave the text back.

    Null and empty texts have no pieces and are restored as empty; a null id and repeated rows each
    keep their row; other columns, whatever their names, are not read; an empty table gives no rows.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    fitted = None if scores is None else scores.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        pieces = pieces_of(path, fitted)
        is_byte = np.array([p[2] == BYTE for p in pieces.pieces])
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n, n_bytes, crc, same = [], [], [], []
            for text, data in zip(texts, pieces.encode_all(texts), strict=True):
                ids = np.frombuffer(data, "<u4")
                n.append(len(ids))
                n_bytes.append(int(is_byte[ids].sum()))
                crc.append(zlib.crc32(data))
                same.append(pieces.decode(ids.tolist()) == text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(crc, pa.int64()),
                                              pa.array(same, pa.bool_())], names=[id_col, "n_pieces", "n_byte_pieces", "ids_crc32", "restored"])

    return text_batches(df).select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, n_pieces long, n_byte_pieces long, ids_crc32 long, restored boolean")
