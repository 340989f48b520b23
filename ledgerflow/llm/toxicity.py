"""Convolutional text classifier for toxicity (operator 8).

A word is embedded as the mean of a few hashed rows (the word itself and its first letters).
Filters over one, two and three words slide over the whole text; each keeps its maximum, and a
logistic layer weighs the maxima.  The weights start from a bounded sample that is trained in numpy;
then every labelled document is learned from in tasks, whose weights are averaged.  A fold of the labelled
documents is kept from training: all of it, counted by logit, fixes the scale of the scores and one decision
threshold for each language.  The classifier scores every document where it is read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches

#: Labelled documents of each class from which the weights start, and the most words of one of them.
SAMPLE_OF_CLASS = 1500
SAMPLE_WORDS = 50_000
#: Labelled documents that a task learns from, and its learning rate.
TASK_DOCS = 4096
TASK_RATE = 0.002
#: Bits of the filter for labelled ids: so many for each label, and the most (128 MB); with fewer it only lets more through.
BITS_PER_LABEL, MOST_BITS = 8, 1 << 30
#: Weights are averaged as whole multiples of this, so that the sum has no order.
WEIGHT_STEP = 2.0 ** -24
#: Logits are counted in bins of this width, up to the bound.
LOGIT_STEP, LOGIT_BOUND = 1 / 256, 100.0
#: A language needs so many positive validation documents for a threshold of its own.
LANGUAGE_POSITIVES = 20
BUCKETS, DIMS, FILTERS, WIDTHS = 1 << 17, 16, 16, (1, 2, 3)
PREFIXES = (5, 4)
EPOCHS, BATCH, RATE = 8, 32, 0.01
#: Rows of the embedding drawn or moved at a time, which bounds what training holds besides the weights.
BLOCK_ROWS = 4096
#: Words scored at a time.
SLICE_WORDS = 60_000
PAD = max(WIDTHS) - 1
WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def buckets_of(words: list[str]):
    """Hashed rows of each word: itself and its prefixes."""
    import numpy as np

    rows = np.empty((len(words), 1 + len(PREFIXES)), np.int64)
    for k, w in enumerate(words):
        b = w.encode("utf-8", "surrogatepass")
        rows[k, 0] = zlib.crc32(b, 1)
        for j, n in enumerate(PREFIXES, 1):
            rows[k, j] = zlib.crc32(w[:n].encode("utf-8", "surrogatepass"), n + 1)
    return rows % BUCKETS


def slices_of(words: list[str]) -> list[list[str]]:
    """A text's words in overlapping slices, one where they fit."""
    return [words[at:at + SLICE_WORDS + PAD] for at in range(0, max(1, len(words)), SLICE_WORDS)]


@dataclass
class Model:
    embedding: object
    filters: list  # one of (width, DIMS, FILTERS) for each width
    bias: object
    out: object
    out_bias: float
    scale: tuple = (1.0, 0.0)
    thresholds: dict = field(default_factory=dict)
    threshold: float = 0.5
    constant: float | None = None

    def maxima(self, codes, vectors, starts, lengths):
        """Largest filter values over each text's windows, which may reach into the padding.

        ``codes`` number the rows of ``vectors`` word by word, PAD codes of padding after each text.
        """
        import numpy as np

        parts = []
        bounds = np.stack([starts, starts + np.maximum(lengths, 1)], axis=1).ravel()
        for w, f in zip(WIDTHS, self.filters, strict=True):
            z = (vectors @ f[0])[codes]
            for k in range(1, w):
                z[:-k] += (vectors @ f[k])[codes[k:]]
            parts.append((z, np.maximum.reduceat(z, bounds, axis=0)[::2]))
        return parts

    def logits(self, codes, vectors, starts, lengths):
        import numpy as np

        pooled = np.concatenate([p for _, p in self.maxima(codes, vectors, starts, lengths)], axis=1)
        return np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias

    def score(self, texts: list[str | None]):
        """Scores of whole texts; a text longer than a slice is the maximum over overlapping slices."""
        import numpy as np

        if self.constant is not None:
            return np.full(len(texts), self.constant)
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.raw(texts) + b, -60, 60)))

    def raw(self, texts: list[str | None]):
        """Logits of whole texts before their scale."""
        import numpy as np

        logits, group, owners, size = np.full(len(texts), -np.inf), [], [], 0
        for k, text in enumerate(texts):
            for part in slices_of(words_of(text)):
                group.append(part)
                owners.append(k)
                size += len(part)
                if size >= SLICE_WORDS:
                    np.maximum.at(logits, owners, self._group(group))
                    group, owners, size = [], [], 0
        if group:
            np.maximum.at(logits, owners, self._group(group))
        return logits

    def _group(self, group: list[list[str]]):
        import numpy as np

        seen: dict[str, int] = {}
        lengths = np.array([len(w) for w in group])
        starts = np.concatenate(([0], np.cumsum(lengths + PAD)[:-1]))
        codes = []
        for words in group:
            codes += [seen.setdefault(w, len(seen) + 1) for w in words]
            codes += [0] * PAD
        codes.append(0)
        vectors = np.zeros((len(seen) + 1, DIMS), np.float32)
        if seen:
            vectors[1:] = self.embedding[buckets_of(list(seen))].mean(axis=1)
        return self.logits(np.array(codes), vectors, starts, lengths)


class Adam:
    def __init__(self, *params, rate: float = RATE):
        import numpy as np

        self.params, self.t, self.rate = params, 0, rate
        self.m = [np.zeros_like(p) for p in params]
        self.v = [np.zeros_like(p) for p in params]

    def step(self, *grads):
        import numpy as np

        self.t += 1
        for whole in zip(self.params, grads, self.m, self.v, strict=True):
            for at in range(0, len(whole[0]), BLOCK_ROWS):
                p, g, m, v = (x[at:at + BLOCK_ROWS] for x in whole)
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= self.rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.999 ** self.t)) + 1e-8)


def gradients(model: Model, emb, texts: list, y):
    """Gradients of the mean loss: of ``emb``, the filters, bias, output and output bias; ``texts`` hold rows of ``emb``."""
    import numpy as np

    n_rows = 1 + len(PREFIXES)
    lengths = np.array([len(t) for t in texts])
    starts = np.concatenate(([0], np.cumsum(lengths + PAD)[:-1]))
    rows = np.full((int((lengths + PAD).sum()) + 1, n_rows), -1)
    for t, s in zip(texts, starts, strict=True):
        rows[s:s + len(t)] = t
    vectors = emb[rows].mean(axis=1) if len(emb) else np.zeros((len(rows), DIMS), np.float32)
    vectors[rows[:, 0] < 0] = 0
    parts = model.maxima(np.arange(len(rows)), vectors, starts, lengths)
    hidden = np.concatenate([p for _, p in parts], axis=1) + model.bias
    logit = np.maximum(hidden, 0) @ model.out + model.out_bias
    g = (1 / (1 + np.exp(-logit)) - y) / len(texts)
    d_hidden = (g[:, None] * model.out) * (hidden > 0)
    d_emb, d_filters = np.zeros_like(emb), [np.zeros_like(f) for f in model.filters]
    for j, (w, (z, _)) in enumerate(zip(WIDTHS, parts, strict=True)):
        d = d_hidden[:, j * FILTERS:(j + 1) * FILTERS]
        best = np.stack([s + z[s:s + max(n, 1)].argmax(axis=0) for s, n in zip(starts, lengths, strict=True)])
        for k in range(w):
            at_word = best + k
            d_filters[j][k] += np.einsum("bfd,bf->df", vectors[at_word], d)
            flow = d[:, :, None] * model.filters[j][k].T[None] / n_rows
            real = rows[at_word][:, :, 0] >= 0
            for r in range(n_rows):
                np.add.at(d_emb, rows[at_word][:, :, r][real], flow[real])
    return (d_emb, *d_filters, d_hidden.sum(axis=0), (np.maximum(hidden, 0) * g[:, None]).sum(axis=0),
            g.sum(keepdims=True))


class TaskTrainer:
    """Learns from a task's documents batch by batch, from given weights on; only touched embedding rows move."""

    def __init__(self, model: Model):
        import numpy as np

        self.model = Model(model.embedding.copy(), [f.copy() for f in model.filters], model.bias.copy(), model.out.copy(), model.out_bias)
        self.out_bias = np.array([model.out_bias], np.float32)
        self.dense = Adam(*self.model.filters, self.model.bias, self.model.out, self.out_bias, rate=TASK_RATE)
        self.m, self.v = np.zeros_like(model.embedding), np.zeros_like(model.embedding)
        self.touched = np.zeros(len(model.embedding), np.int64)
        self.docs = 0

    def learn(self, texts: list, labels: list) -> None:
        import numpy as np

        # of a text in slices, the one that gives the score
        parts = [max(s, key=lambda w: self.model.raw([" ".join(w)])[0]) if len(s) > 1 else s[0]
                 for s in (slices_of(words_of(t)) for t in texts)]
        seen: dict[str, int] = {}
        codes = [np.array([seen.setdefault(w, len(seen)) for w in words], np.int64) for words in parts]
        used, rows = np.unique(buckets_of(list(seen)), return_inverse=True)
        rows = rows.reshape(-1, 1 + len(PREFIXES))
        emb = self.model.embedding[used]
        d_emb, *rest = gradients(self.model, emb, [rows[c] for c in codes], np.asarray(labels, np.float32))
        moved = np.flatnonzero(np.abs(d_emb).sum(axis=1))
        at, g = used[moved], d_emb[moved]
        self.touched[at] += 1
        self.m[at] += 0.1 * (g - self.m[at])
        self.v[at] += 0.001 * (g * g - self.v[at])
        t = self.touched[at][:, None]
        self.model.embedding[at] -= TASK_RATE * (self.m[at] / (1 - 0.9 ** t)) / (np.sqrt(self.v[at] / (1 - 0.999 ** t)) + 1e-8)
        self.dense.step(*rest)
        self.model.out_bias = float(self.out_bias[0])
        self.docs += len(texts)

    def weights(self):
        """``(row, part, share, values)`` of what moved: embedding rows from 0, everything else in parts of row -1."""
        import numpy as np

        at = np.flatnonzero(self.touched)
        flat = np.concatenate([*[f.ravel() for f in self.model.filters], self.model.bias, self.model.out, self.out_bias])
        flat = np.append(flat, np.zeros(-len(flat) % DIMS, np.float32)).reshape(-1, DIMS)
        row = np.concatenate([at, np.full(len(flat), -1)])
        part = np.concatenate([np.zeros(len(at), np.int64), np.arange(len(flat))])
        share = np.concatenate([self.touched[at], np.full(len(flat), self.docs)])
        return row, part, share, np.concatenate([self.model.embedding[at], flat])


def learn_from_all(model: Model, rows: DataFrame, n: int) -> None:
    """Moves the weights by every one of the ``n`` labelled ``rows`` (id, text, y): each task learns from its share, and the
    weights are averaged, those of an embedding row over the tasks that moved it.

    Rows are dealt and ordered by hash, and weights are added as whole numbers, so the outcome does not hang on how
    the rows lay.
    """
    import numpy as np

    shared = rows.sparkSession.sparkContext.broadcast(model)
    columns = [f"w{k}" for k in range(DIMS)]

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, texts, labels = TaskTrainer(shared.value), [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            labels += batch.column("y").to_pylist()
            while len(texts) >= BATCH:
                trainer.learn(texts[:BATCH], labels[:BATCH])
                del texts[:BATCH], labels[:BATCH]
        if texts:
            trainer.learn(texts, labels)
        if trainer.docs:
            row, part, share, values = trainer.weights()
            whole = np.rint(values.astype(np.float64) / WEIGHT_STEP).astype(np.int64) * share[:, None]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (row, part, share, *whole.T)], names=["row", "part", "share", *columns])

    key = F.xxhash64(*rows.columns)  # with the id, so that copies of a text are spread
    dealt = rows.repartition(max(1, -(-n // TASK_DOCS)), key).sortWithinPartitions(key).select("text", "y")
    moved = text_batches(dealt).mapInArrow(learned, "row long, part long, share long, " + ", ".join(f"{c} long" for c in columns))
    means = [(F.sum(F.col(c).cast("decimal(38,0)")).cast("double") * F.lit(WEIGHT_STEP) / F.sum("share")).cast("float").alias(c) for c in columns]
    # at most the weights of one model
    got = moved.groupBy("row", "part").agg(*means).select(F.col("row").cast("int").alias("row"), F.col("part").cast("int").alias("part"), *columns).toArrow()
    shared.destroy()
    if not got.num_rows:
        return
    flat = np.zeros((sum(f.size for f in [*model.filters, model.bias, model.out]) // DIMS + 1, DIMS), np.float32)
    for batch in got.to_batches():
        row, part = batch.column("row").to_numpy(), batch.column("part").to_numpy()
        values = np.stack([batch.column(c).to_numpy() for c in columns], axis=1)
        model.embedding[row[row >= 0]] = values[row >= 0]
        flat[part[row < 0]] = values[row < 0]
    flat, at = flat.ravel(), 0
    for f in [*model.filters, model.bias, model.out]:
        f[...] = flat[at:at + f.size].reshape(f.shape)
        at += f.size
    model.out_bias = float(flat[at])


def train(texts: list, labels, seed: int = 7) -> Model:
    """Model from texts given as arrays of hashed rows (words x rows) and their 0/1 labels."""
    import numpy as np

    rng = np.random.default_rng(seed)
    y = np.asarray(labels, np.float32)
    embedding = np.empty((BUCKETS, DIMS), np.float32)
    for at in range(0, BUCKETS, BLOCK_ROWS):
        block = embedding[at:at + BLOCK_ROWS]
        block[...] = rng.normal(0, 0.3, block.shape)
    model = Model(embedding,
                  [rng.normal(0, 0.3, (w, DIMS, FILTERS)).astype(np.float32) for w in WIDTHS],
                  np.zeros(FILTERS * len(WIDTHS), np.float32),
                  rng.normal(0, 0.1, FILTERS * len(WIDTHS)).astype(np.float32), 0.0)
    out_bias = np.zeros(1, np.float32)
    # rows of the embedding that the sample uses; the others are never read in training
    is_used = np.zeros(BUCKETS, bool)
    for t in texts:
        is_used[t] = True
    used, place = np.flatnonzero(is_used), (np.cumsum(is_used) - 1).astype(np.int32)
    texts = [place[t] for t in texts]
    emb = model.embedding[used]
    adam = Adam(emb, *model.filters, model.bias, model.out, out_bias)
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            batch = order[at:at + BATCH]
            model.out_bias = float(out_bias[0])
            adam.step(*gradients(model, emb, [texts[i] for i in batch], y[batch]))
    model.embedding[used] = emb
    model.out_bias = float(out_bias[0])
    return model


def calibrate(model: Model, logits, labels, langs: list, counts, positive_share: float) -> None:
    """Scale so that scores follow the labels' frequency, and the threshold of each language.

    ``counts`` documents of the held-back fold have the same logit, label and language.
    """
    import numpy as np

    y, counts, logits = np.asarray(labels, np.float64), np.asarray(counts, np.float64), np.asarray(logits, np.float64)
    if len(y) == 0 or y.min() == y.max():
        return
    share = y @ counts / counts.sum()
    weight = counts * np.where(y == 1, positive_share / share, (1 - positive_share) / (1 - share))
    a, b = 1.0, 0.0
    for _ in range(30):  # damped Newton steps; the prior a ~ 1 keeps separable data finite
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
        r, h = weight * (p - y), weight * p * (1 - p) + 1e-9
        grad = np.array([r @ logits + 0.1 * (a - 1), r.sum() + 0.01 * b])
        hess = np.array([[h @ logits ** 2 + 0.1, h @ logits], [h @ logits, h.sum() + 0.01]])
        step = np.clip(np.linalg.solve(hess, grad), -1, 1)
        a, b = max(0.05, a - step[0]), b - step[1]
    score = 1 / (1 + np.exp(-np.clip(a * logits + b, -60, 60)))
    cut = _best_cut(score, y, weight)
    b -= float(np.log(cut / (1 - cut)))  # the best cut over all languages is at 0.5
    model.scale = (float(a), float(b))
    score = 1 / (1 + np.exp(-np.clip(a * logits + b, -60, 60)))
    langs = np.array([x or "" for x in langs])
    for lang in sorted(set(langs)):
        own = langs == lang
        if y[own] @ counts[own] >= LANGUAGE_POSITIVES and (y[own] == 0).any():
            model.thresholds[lang] = _best_cut(score[own], y[own], weight[own])


def _best_cut(score, y, weight) -> float:
    """The cut with the best F1, in the middle of the gap around it."""
    import numpy as np

    order = np.argsort(-score, kind="stable")
    s, hit, miss = score[order], np.cumsum((y * weight)[order]), np.cumsum(((1 - y) * weight)[order])
    f1 = 2 * hit / (hit + miss + (y * weight).sum())
    f1[:-1][s[:-1] == s[1:]] = -1
    k = int(f1.argmax())
    below = s[k + 1] if k + 1 < len(s) else 0.0
    logit = lambda v: np.log(np.clip(v, 1e-9, 1 - 1e-9) / (1 - np.clip(v, 1e-9, 1 - 1e-9)))
    return float(1 / (1 + np.exp(-(logit(s[k]) + logit(below)) / 2)))


def logit_counts(model: Model, docs: DataFrame, known: DataFrame, id_col: str):
    """``(lang, y, bin, n)`` of all ``docs`` (id, text, lang) with a label in ``known`` (id, y): how many have a logit in the
    bin, in steps of LOGIT_STEP.  Logits are taken where the texts are read; only they are joined with the labels."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            logits = np.clip(shared.value.raw(batch.column("text").to_pylist()), -LOGIT_BOUND, LOGIT_BOUND)
            yield pa.RecordBatch.from_arrays([batch.column(id_col), batch.column("lang"), pa.array(np.rint(logits / LOGIT_STEP).astype(np.int64))],
                                             names=[id_col, "lang", "bin"])

    id_type = docs.schema[id_col].dataType.simpleString()
    found = (text_batches(docs).select(id_col, "text", "lang").mapInArrow(binned, f"`{id_col}` {id_type}, lang string, bin long")
             .join(known.select(id_col, F.col("y").cast("int").alias("y")), id_col)
             .groupBy("lang", "y", "bin").agg(F.count("*").alias("n")).collect())
    shared.destroy()
    return found


def likely_known(docs: DataFrame, known: DataFrame, id_col: str, n: int) -> DataFrame:
    """``docs`` without most of those that have no row in ``known`` (``n`` rows), dropped where they are read.

    The ids of ``known`` set bits by hash, BITS_PER_LABEL as many as ids and MOST_BITS at most, which are broadcast.  No
    document with a label is dropped; an exact join has to follow.
    """
    if docs.schema[id_col].dataType != known.schema[id_col].dataType:
        return docs  # equal ids of two types may have two hashes
    bits = min(MOST_BITS, max(1 << 15, 1 << (BITS_PER_LABEL * n).bit_length()))
    slot = F.pmod(F.xxhash64(id_col), F.lit(bits))
    place = F.bitmap_bit_position(slot)
    marks = known.groupBy(F.bitmap_bucket_number(slot).alias("__bucket")).agg(F.bitmap_construct_agg(place).alias("__bits"))
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    is_set = F.getbit(byte, (place % 8).cast("int")) == 1
    return docs.join(F.broadcast(marks), (F.bitmap_bucket_number(slot) == F.col("__bucket")) & is_set, "left_semi")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str | None = "lang", label_col: str = "toxic", of_class: int = SAMPLE_OF_CLASS) -> Model:
    """Train on every labelled document; the weights start from at most ``of_class`` of each class.

    Only labels of ids whose crc32 mod 5 is not 0 are read; remainder 1 calibrates, the rest
    trains, whatever a text's length.  The language serves the calibration of thresholds, never a score.  With labels of
    one class or none, every text gets that share as its score.
    """
    import numpy as np

    fold = F.crc32(F.col(id_col).cast("string")) % 5
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).where(fold != 0)
             .groupBy(id_col).agg(F.max(label_col).alias("y")))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return Model(None, [], None, None, 0.0, constant=float(max(counts, default=0)))
    order = F.xxhash64(F.col(id_col).cast("string"))
    sample = None
    for y in (0, 1):
        part = known.where((F.col("y") == y) & (fold > 1)).orderBy(order, id_col).limit(of_class)
        sample = part if sample is None else sample.unionByName(part)
    lang = F.col(lang_col) if lang_col else F.lit(None)
    texts_of = text_batches(docs).select(id_col, F.col(text_col).alias("text"), lang.cast("string").alias("lang"))
    rows = texts_of.join(F.broadcast(sample), id_col)  # at most 2 * of_class rows

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], []]
            for text, y in zip(batch.column("text"), batch.column("y"), strict=True):
                words = words_of(text.as_py())
                if len(words) <= SAMPLE_WORDS:
                    out[0].append(buckets_of(words).astype("<i4").tobytes())
                    out[1].append(y.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int32())], names=["rows", "y"])

    got = rows.select("text", F.col("y").cast("int").alias("y")).mapInArrow(hashed, "rows binary, y int").toArrow()
    found = sorted(zip(*(got.column(c).to_pylist() for c in ("rows", "y")), strict=True), key=lambda r: (zlib.crc32(r[0]), r[1]))
    del got  # the sample's words are held once
    # the labels grow with the documents, so they are not broadcast at any size
    likely = likely_known(texts_of, known, id_col, sum(counts.values()))
    learn = likely.where(fold > 1).join(known.hint("merge"), id_col).select(id_col, "text", F.col("y").cast("int").alias("y"))
    learned = {r["y"]: r["n"] for r in texts_of.select(id_col).join(known, id_col).where(fold > 1).groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(learned) < 2:
        return Model(None, [], None, None, 0.0, constant=counts[1] / sum(counts.values()))
    labels_of, found = [r[1] for r in found], [np.frombuffer(r[0], "<i4").reshape(-1, 1 + len(PREFIXES)) for r in found]
    model = train(found, labels_of)
    del found
    learn_from_all(model, learn, sum(learned.values()))
    tune = logit_counts(model, likely.where(fold == 1), known, id_col)
    tune = sorted(tune, key=lambda r: (r["bin"], r["y"], r["lang"] or "", r["lang"] is None))
    calibrate(model, [r["bin"] * LOGIT_STEP for r in tune], [r["y"] for r in tune], [r["lang"] for r in tune], [r["n"] for r in tune],
              counts[1] / sum(counts.values()))
    return model


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str | None = "lang") -> DataFrame:
    """``docs`` with ``score`` and ``rejected`` (score at or over its language's threshold).

    Null and empty texts are scored as texts without words; ties, repeated rows and other
    columns pass through (columns named score or rejected are replaced).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = docs.drop("score", "rejected")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            scores = m.score(batch.column(text_col).to_pylist())
            langs = batch.column(lang_col).to_pylist() if lang_col else [None] * batch.num_rows
            rejected = [bool(s >= m.thresholds.get(lg or "", m.threshold)) for s, lg in zip(scores, langs, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                                             names=[*batch.schema.names, "score", "rejected"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema]
    return text_batches(rest).mapInArrow(scored, ", ".join([*fields, "score double", "rejected boolean"]))
