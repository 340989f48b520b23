"""Each operator against a brute-force version, and on nulls, empty and odd inputs."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerflow.llm import (
    components, dimension_scan, induced, line_dedup, multiset, packing, sentence_pieces, simhash, suffix_dedup, tokens, toxicity, wrappers,
)
from ledgerflow.llm.queries import ORACLES, QUERIES, vocabulary

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and thion anst erly inged hathe ofthe onhe thly reou and sting edhe".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(n))


def odd_texts():
    return [None, "", " ", "\n\n", "a", "word " * 5000, "x" * 30000, prose(1, 300), prose(1, 300), "Ünïcödé ß İ tab\there 𝔘 🙂",
            "<|endoftext|> a <|startoftext|>", "a  b\n c \n\n d ", "don't we'll 's", "日本語テキスト 中文", "line one\nline one\nline two"]


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", None, None) for i, t in zip(ids, texts, strict=True)], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, odd_texts()).repartition(3)


@pytest.fixture(scope="module")
def given(spark):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


# ---------------------------------------------------------------- tokens and packing

def test_token_counts_equal_the_library(spark, docs, given):
    path = vocabulary("word_bpe_49k.json")
    library = tokens.library(path)
    for df, texts in ((docs, list(enumerate(odd_texts()))), (spark.read.parquet(f"{SF}/documents.parquet"), given)):
        got = {r["doc_id"]: r for r in tokens.count_tokens(df, path, limit=100).collect()}
        assert len(got) == len(texts)
        for k, t in texts:
            n = len(library.encode(t or "", add_special_tokens=False).ids)
            assert (got[k]["n_tokens"], got[k]["n_bytes"], got[k]["over_limit"]) == (n, len((t or "").encode()), n > 100)


def test_ids_equal_the_library(given):
    path = vocabulary("byte_bpe_50k.json")
    library, own = tokens.library(path), tokens.IdEncoder(path)
    for t in [x or "" for x in odd_texts()] + [t for _, t in given]:
        assert np.frombuffer(own.ids(t), own.width).tolist() == library.encode(t, add_special_tokens=False).ids


def test_long_text_is_cut_at_safe_boundaries(monkeypatch):
    path = vocabulary("word_bpe_49k.json")
    text = prose(3, 4000) + "y" * 500 + " " + prose(4, 100)
    assert "".join(tokens.slices(text, 100)) == text
    whole = tokens.LengthEncoder(path).counts([text])
    monkeypatch.setattr(tokens, "SLICE_CHARS", 200)
    monkeypatch.setattr(tokens, "TABLE_ENTRIES", 50)
    assert tokens.LengthEncoder(path).counts([text]) == whole


def test_packing_holds_every_id_once_without_gaps(spark, docs):
    path = vocabulary("byte_bpe_50k.json")
    library = tokens.library(path)
    want = {k: library.encode(t or "", add_special_tokens=False).ids + [0] for k, t in enumerate(odd_texts())}
    rows = packing.pack(docs, path, window=64, with_ids=True).collect()
    at = dict.fromkeys(want, 0)
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        assert r["start"] == at[r["doc_id"]] and r["doc_tokens"] == len(want[r["doc_id"]])
        piece = want[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert list(r["ids"]) == piece and r["ids_crc32"] == zlib.crc32(np.array(piece, "<u4").tobytes())
        at[r["doc_id"]] += r["length"]
    assert at == {k: len(v) for k, v in want.items()}
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        end = 0
        for r in group:
            assert r["offset"] == end
            end += r["length"]
        assert end == 64 or end & (end - 1) == 0  # full, or a power of two


def test_neighbours_are_the_best_by_bm25():
    rng = np.random.default_rng(2)
    docs = [np.append(rng.integers(1, 40, rng.integers(5, 60)), 0).astype(np.uint16) for _ in range(30)]
    index = packing.ShardIndex(docs)
    df = Counter(t for d in docs for t in set(d.tolist()))
    mean = np.mean([len(d) for d in docs])

    def weight(t, d):
        tf = d.tolist().count(t)
        idf = np.log1p((30 - df[t] + 0.5) / (df[t] + 0.5))
        return idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))

    used = np.zeros(30, bool)
    used[[3, 7, 9]] = True
    seed = 3
    query = sorted((t for t in set(docs[seed].tolist()) if df[t] > 1), key=lambda t: -weight(t, docs[seed]))[:packing.QUERY_TERMS]
    score = {k: sum(weight(t, docs[k]) for t in query) for k in range(30) if not used[k]}
    best = sorted(score, key=lambda k: -score[k])[:5]
    assert index.neighbours(seed, used)[:5] == best
    order = packing.packing_order(docs, 64)
    assert sorted(order) == list(range(30))


def test_a_window_takes_neighbours_beyond_the_first_ones():
    """A seed with more neighbours than come back at once, one of which shares only a term of little weight, takes them
    all before a document that shares nothing."""
    own = [np.array([1, 2], np.uint16) for _ in range(packing.NEIGHBOURS + 9)]
    seed = np.arange(1, packing.QUERY_TERMS + 40, dtype=np.uint16)
    rare = [np.array([t], np.uint16) for t in seed[2:]]  # each of the seed's other terms, in one more document
    strangers = [np.array([999, 998], np.uint16) for _ in range(5)]
    docs = [seed, *strangers, *own, *rare]
    order = packing.packing_order(docs, 1 << 12)
    assert sorted(order) == list(range(len(docs)))
    assert set(order[-5:]) == set(range(1, 6))


# ---------------------------------------------------------------- SimHash

def naive_fingerprint(text):
    from xxhash import xxh64_intdigest

    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_groups_equal_brute_force(spark):
    base = prose(5, 200).split(" ")
    texts = odd_texts() + [" ".join(base)]
    for k in range(60):
        words = list(base)
        for j in range(k % 5):
            words[(k * 37 + j * 11) % 200] = "changed"
        texts.append(" ".join(words))
    fps = [naive_fingerprint(t) for t in texts]
    root = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 2:
            ra, rb = root[a], root[b]
            root = [min(ra, rb) if r in (ra, rb) else r for r in root]
    got = {r[0]: (r[1], r[2]) for r in simhash.near_duplicates(frame(spark, texts)).collect()}
    assert got == {k: (f"{fps[k]:016x}", root[k]) for k in range(len(texts))}
    kept = {r["doc_id"] for r in simhash.keep_one_of_each(frame(spark, texts)).collect()}
    assert kept == set(root)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_pigeonring_loses_no_pair(spark, distance):
    rng = random.Random(8)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for f in list(fps):
        for k in range(1, 5):
            fps.add(f ^ sum(1 << b for b in rng.sample(range(64), k)))
    fps = sorted(simhash._signed(f) for f in fps)
    want = {(a, b) for a, b in itertools.combinations(fps, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= distance}
    got = simhash.linked_pairs(spark.createDataFrame([(f,) for f in fps], "fp long"), distance).collect()
    assert {(r[0], r[1]) for r in got} == want and len(got) == len(want)


def test_components_of_chain_star_and_loop(spark):
    pairs = [(k, k + 1) for k in range(20)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = dict(components.components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect())
    assert got == {k: 0 for k in range(1, 21)} | {k: 100 for k in range(101, 140)} | {201: 200, 202: 200}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# ---------------------------------------------------------------- line dedup

def dedup_brute(rows, min_chars):
    """Runs of repeated units by their definition: every unit of the table in rank order, then maximal runs."""
    units = []  # (rank, place in the text, line, start, stop, unit)
    for rank, (_, text) in enumerate(sorted(rows, key=lambda r: r[0])):
        at = place = 0
        for n, line in enumerate((text or "").split("\n")):
            for m in re.finditer(f"[^{line_dedup.MARKS}]*[{line_dedup.MARKS}]+|[^{line_dedup.MARKS}]+", line):
                unit = " ".join(m[0].rstrip(line_dedup.MARKS).lower().split())
                if unit:
                    units.append((rank, place, n, at + m.start(), at + m.end(), unit))
                    place += 1
            at += len(line) + 1
    first = {}
    for u in units:
        first.setdefault(u[5], u[:2])
    out = []
    for rank, (i, text) in enumerate(sorted(rows, key=lambda r: r[0])):
        mine, spans = [u for u in units if u[0] == rank], []
        for again, run in itertools.groupby(mine, key=lambda u: first[u[5]] != u[:2]):
            run = list(run)
            if again and sum(len(u[5]) + 1 for u in run) >= min_chars:
                for _, part in itertools.groupby(run, key=lambda u: u[2]):
                    part = list(part)
                    spans.append((part[0][3], part[-1][4]))
        gone = {c for a, b in spans for c in range(a, b)}
        kept, at = [], 0
        for line in (text or "").split("\n"):
            rest = "".join(ch for k, ch in enumerate(line) if at + k not in gone)
            if rest.strip() or not gone & set(range(at, at + len(line))):
                kept.append(rest)
            at += len(line) + 1
        out.append((i, None if text is None else "\n".join(kept), spans))
    return out


def dedup_found(df, **kw):
    return sorted((r["doc_id"], r["text"], [tuple(s) for s in r["removed"]]) for r in line_dedup.dedup_lines(df, **kw).collect())


PASSAGE = ("the first clause of it stands here, and another one comes after that; then a third one: with more words in it. "
           "A new sentence begins at this place, runs on for a while, and ends. One more of them closes the passage, as it must!")


def test_passages_inside_lines_in_wrapped_text_and_without_spaces(spark):
    own = [f"{prose(50 + k, 30)} , only in {k}" for k in range(8)]
    cjk = "".join(chr(0x4E00 + 7 * k % 3000) + ("\u3002" if k % 17 == 16 else "\uff0c" if k % 6 == 5 else "") for k in range(260))
    wrapped = PASSAGE.replace("; ", ";\n").replace(". ", ".\n")
    texts = [f"{own[0]} {PASSAGE} {own[1]}", f"{own[2]}, {PASSAGE.upper()} {own[3]}", f"{own[4]}.\n{wrapped}\n\n{own[5]}", f"{own[6]}\n{cjk}",
             f"{own[7]}, {cjk}", PASSAGE, f"{PASSAGE}\n{PASSAGE}", None, "", own[0], "and another one comes after that, at this place."]
    df = frame(spark, texts).withColumnRenamed("source", "removed")  # a clashing name
    got = dedup_found(df)
    assert got == dedup_brute(list(enumerate(texts)), line_dedup.MIN_CHARS)
    words = lambda t: set(re.findall(r"\w+", (t or "").lower()))
    assert got[0][2] == [] and got[10][2] == []  # the first place stays, and so do a few common clauses
    for k in (1, 2, 5, 6):
        left = words(got[k][1])
        assert got[k][2] and len(words(PASSAGE) & left) < 0.35 * len(words(PASSAGE)), k
    assert got[4][2] and len(got[4][1]) < len(texts[4]) - 0.8 * len(cjk)
    assert got[5][1] == "" and got[6][1] == "" and got[7][1] is None


@pytest.mark.parametrize("min_chars", [1, 20, 60])
def test_line_dedup_equals_brute_force(spark, min_chars):
    rng = random.Random(min_chars)
    bits = ["alpha beta", "gamma, delta", "one two three.", "x", " ", ",", "\n", "\n\n", "!", "last words here", "AL\tpha  beta;"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 25))) for _ in range(60)]
    rows = [(k, t) for k, t in enumerate(texts)]
    df = frame(spark, texts).repartition(4)
    assert dedup_found(df, min_chars=min_chars) == dedup_brute(rows, min_chars)


def test_line_dedup_query_equals_its_sql(spark):
    from ledgerflow.plans.compare import compare, duckdb_connection

    found = compare(QUERIES["op4_line_dedup"](spark, SF), ORACLES["op4_line_dedup"], duckdb_connection(SF))
    assert found["ok"], found


def test_line_dedup_of_repeated_ids(spark):
    a, b = ", ".join(f"alpha {k} of them all" for k in range(12)), ", ".join(f"beta {k} of them all" for k in range(12))
    got = line_dedup.dedup_lines(frame(spark, [a, a, b + "\n" + a, a], [1, 1, 1, None])).collect()
    assert sorted(r["text"] for r in got if r["doc_id"] == 1) == sorted(["", "", b]) and [r["text"] for r in got if r["doc_id"] is None] == [a]


# ---------------------------------------------------------------- suffixes

def test_suffix_order_and_common_prefixes():
    rng = random.Random(3)
    for _ in range(150):
        data = bytes(rng.choice(rng.choice([b"ab", b"abc", b"a"])) for _ in range(rng.randint(0, 60)))
        data = data[:20] * rng.randint(0, 4) + data
        depth = rng.choice([4, 9, 300])
        text = np.append(np.frombuffer(data, np.uint8).astype(np.uint16) + 2, 0).astype(np.uint16)
        parts = list(induced.sorted_suffixes(text, 258, depth))
        order, common = np.concatenate([p for p, _ in parts]).tolist(), np.concatenate([c for _, c in parts]).tolist()
        assert sorted(order) == list(range(len(text)))
        for x, y, c in zip(order, order[1:], common[1:], strict=False):
            a, b = text[x:x + depth].tolist(), text[y:y + depth].tolist()
            assert a <= b
            assert c == next((k for k, (p, q) in enumerate(zip(a, b, strict=False)) if p != q), min(len(a), len(b)))


def test_queue_spills_and_keeps_order(tmp_path):
    queue = induced.SuffixQueue(str(tmp_path), 4, budget=10)
    for k in range(20):
        queue.push(k % 3, np.arange(k, k + 4), np.full(4, k, np.int32))
    assert queue.files
    for c in range(3):
        p, x = queue.pop(c)
        assert p.tolist() == [v for k in range(c, 20, 3) for v in range(k, k + 4)]
        assert queue.pop(c) is None
    assert not list(tmp_path.iterdir())


def naive_removal(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[k:k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if count[d[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        out.append((sum(gone), sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1])), bytes(c for c, g in zip(d, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize(("length", "hot_bytes"), [(12, 1 << 20), (50, 1 << 20), (50, 600), (50, 0)])
def test_suffix_dedup_equals_brute_force(spark, length, hot_bytes):
    """With a low limit, anchors of several contexts are cut up; with none, all are, down to single windows."""
    rng = random.Random(length)
    shared = [prose(100 + k, 30) for k in range(4)]
    texts = odd_texts()[:5] + ["ab" * 100, "é" * 80, "abcabcabd" * 9]
    for k in range(30):
        texts.append(prose(k, rng.randint(0, 30)) + rng.choice(shared)[rng.randint(0, 20):] + prose(k + 50, 20))
    texts += texts[-3:]
    got = {r[0]: r for r in suffix_dedup.remove_repeats(frame(spark, texts), length=length, hot_bytes=hot_bytes).collect()}
    for k, (removed, spans, kept) in enumerate(naive_removal(texts, length)):
        assert bytes(got[k]["kept"]) == kept, k
        assert (sum(s["stop"] - s["start"] for s in got[k]["spans"]), len(got[k]["spans"])) == (removed, spans)


def test_a_hot_anchor_is_cut_up(spark, monkeypatch):
    """A line that all texts share: its contexts do not meet in one shard, and being short it stays."""
    line = prose(7, 100)[:300]
    texts = [prose(1000 + k, 60) + line + prose(2000 + k, 60) for k in range(120)]
    largest = []
    whole = suffix_dedup._contexts

    def watched(rows):
        contexts = whole(rows)
        largest.append(contexts.where("n = 1").groupBy("place").agg(suffix_dedup._bytes().alias("n")).agg({"n": "max"}).first()[0] or 0)
        return contexts

    monkeypatch.setattr(suffix_dedup, "_contexts", watched)
    got = suffix_dedup.remove_repeats(frame(spark, texts), hot_bytes=20_000).collect()
    assert largest[0] > 20_000 >= largest[-1]
    assert len(got) == 120 and not any(r["spans"] for r in got)


def test_anchors_of_a_long_text_are_those_of_its_windows(monkeypatch):
    data = (prose(1, 400) + "ab" * 60 + prose(2, 200)).encode()
    at, h = suffix_dedup.anchors(data, 50)
    monkeypatch.setattr(suffix_dedup, "RUN_WINDOWS", 37)
    again, hashes = suffix_dedup.anchors(data, 50)
    assert again.tolist() == at.tolist() and hashes.tolist() == h.tolist()
    assert all(any(p <= q <= p + 50 - suffix_dedup.kgram(50) for q in at.tolist()) for p in range(len(data) - 49))


# ---------------------------------------------------------------- fingerprints

def test_multiset_fingerprints(spark):
    texts = ["one.\ntwo.\nthree.", "three.\none.\ntwo.", "one.\ntwo.", None, "", prose(1, 400), "last one\nof all"]
    rows = {r["doc_id"]: r for r in multiset.fingerprints(frame(spark, texts)).collect()}
    order = sorted(range(len(texts)), reverse=True)
    for k, i in enumerate(order):
        t, nxt = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        assert rows[i]["n_chars"] == len(t) and rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[i]["near_edited"] <= 1 and 0 <= rows[i]["near_next"] <= 1
    assert rows[0]["fingerprint"] == rows[1]["fingerprint"] != rows[2]["fingerprint"]
    assert rows[3]["fingerprint"] == rows[4]["fingerprint"]
    single = multiset.fingerprints(frame(spark, ["alone here\nx"], [5])).collect()[0]
    assert single["near_next"] == 1.0  # it follows itself
    twice = multiset.fingerprints(frame(spark, ["same", "same", "other"], [1, 1, None])).collect()
    assert len(twice) == 3


def test_likeness_of_half_edited_texts_in_every_script(spark):
    def text(seed, letters, space, n):
        rng = random.Random(seed)
        return space.join("".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(n))

    han = "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏"
    scripts = [(han, "、", 60), (han, "", 60), ("กขคงจฉชซญดตถทนบปผพฟมยรลวสหอ", "", 60), ("абвгдежзиклмнопрстуфхцчшщ", " ", 120),
               ("ابتثجحخدذرزسشصضطظعغفقكلمنهوي", " ", 120), ("abcdfghijklm", " ", 24)]
    # two unrelated texts of each; in descending order of id the second of a script is followed by the first
    texts = [text(2 * k + j, *script) for k, script in enumerate(scripts) for j in range(2)]
    for r in multiset.fingerprints(frame(spark, texts)).collect():
        if r["doc_id"] % 2:
            assert 0.25 < r["near_edited"] < 0.95 and r["near_edited"] > r["near_next"] + 0.1, r["doc_id"]


def test_exact_lanes_are_hashed_apart(spark):
    from pyspark.sql import functions as F

    rows = multiset.paragraph_rows(spark.createDataFrame([(1, "some words")], "k int, t string"), F.col("t"), ["k"])
    chained = rows.select(*multiset.EXACT, *[F.xxhash64(F.lit("some words"), F.lit(k + 101)).alias(f"c{k}") for k in range(4)]).first()
    assert len(set(chained)) == 2 * len(multiset.EXACT)


def test_edited_fingerprint_is_that_of_the_edited_text(spark):
    """Put together from parts, it equals the fingerprint of the whole edited text, likeness included."""
    from pyspark.sql import functions as F

    rng = random.Random(9)
    texts = odd_texts() + ["".join(rng.choices(["word", " ", "\n", "é", "\n\n", "more of it", "日本"], k=rng.randint(0, 40))) for _ in range(60)]
    texts += ["one line\nx", "one line\nx", None]
    ids = [*range(len(texts) - 3), 7, 7, None]
    rows = multiset.fingerprints(frame(spark, texts, ids).repartition(3)).collect()
    by_text = {t or "": None for t in texts}
    order = sorted(zip(ids, [t or "" for t in texts], strict=True), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    edited = [t[:len(t) - len(t) // 2] + order[(k + 1) % len(order)][1][:len(t) // 2] for k, (_, t) in enumerate(order)]
    every = list(dict.fromkeys([*by_text, *edited]))
    whole = multiset.text_vectors(spark.createDataFrame(list(enumerate(every)), "k int, t string"), F.col("t"), ["k"])
    lanes = {every[r["k"]]: r["lanes"] for r in whole.collect()}
    shown = lambda v: "".join(f"{x:08x}" for x in v)
    signs = lambda v: [2 * x - v[multiset.EXACT_LANES + multiset.SKETCH_LANES] for x in v[multiset.EXACT_LANES:multiset.EXACT_LANES + multiset.SKETCH_LANES]]

    def like(a, b):
        x, y = np.array(signs(lanes[a]), float), np.array(signs(lanes[b]), float)
        norm = np.linalg.norm(x) * np.linalg.norm(y)
        return 1.0 if lanes[a] == lanes[b] else min(1.0, max(0.0, float(x @ y) / norm if norm else 0.0))

    want = sorted((repr(i), len(t), hashlib.sha256(e.encode()).hexdigest(), shown(lanes[t]), shown(lanes[e]), round(like(t, e), 9),
                   round(like(t, order[(k + 1) % len(order)][1]), 9)) for k, ((i, t), e) in enumerate(zip(order, edited, strict=True)))
    got = sorted((repr(r["doc_id"]), r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9),
                  round(r["near_next"], 9)) for r in rows)
    assert got == want


def test_multiset_hash_is_homomorphic(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "a b.\nc d.\ne"), (2, "a b.\ne"), (3, "c d.")], "k int, t string")
    v = {r["k"]: r["lanes"] for r in multiset.text_vectors(df, F.col("t"), ["k"]).collect()}
    both = spark.createDataFrame([(v[2], v[3], v[1])], "x array<long>, y array<long>, z array<long>")
    row = both.select((multiset.combine(F.col("x"), F.col("y")) == F.col("z")).alias("added"),
                      (multiset.combine(F.col("z"), F.col("y"), -1) == F.col("x")).alias("taken")).first()
    assert row["added"] and row["taken"]


# ---------------------------------------------------------------- toxicity

def test_toxicity_learns_and_keeps_folds_apart(spark):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    texts, labels = [], []
    for k in range(400):
        toxic = k % 4 == 0
        words = prose(k, rng.randint(5, 60)).split(" ")
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["vilewort", "vileheit", "vilear", "scurf"])
        texts.append(" ".join(words))
        labels.append((k, int(toxic)))
    df = frame(spark, texts + [None, ""], [*range(400), 400, None])
    marks = spark.createDataFrame(labels + [(0, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    rows = toxicity.classify(df, toxicity.fit(df, marks)).collect()
    held = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 400 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    right = sum((r["score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in held)
    assert right >= 0.95 * len(held)
    assert len(rows) == 402 and all(0 <= r["score"] <= 1 for r in rows)
    # labels of the held-out fold change nothing
    flipped = marks.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in toxicity.classify(df, toxicity.fit(df, flipped)).collect()}
    assert all(again[r["doc_id"]] == r["score"] for r in rows)
    empty = toxicity.fit(df, marks.limit(0))
    assert {r["score"] for r in toxicity.classify(df, empty).collect()} == {0.0}


def test_unlabelled_texts_are_dropped_where_they_are_read(spark):
    """op8 disk: texts without a label are not shuffled to the labels, and logits are counted without moving texts."""
    known = spark.createDataFrame([(i * 37, i % 2) for i in range(500)], "doc_id long, y int")
    docs = spark.createDataFrame([(i, f"text {i}", "en" if i % 3 else None) for i in [*range(20000), 37, 37]] + [(None, "x", "en")],
                                 "doc_id long, text string, lang string")
    left = toxicity.likely_known(docs, known, "doc_id", 500)
    ids = Counter(r["doc_id"] for r in left.select("doc_id").collect())
    assert all(ids[i * 37] == (3 if i == 1 else 1) for i in range(500)) and ids.total() < 6000
    assert "Exchange hashpartitioning(doc_id" not in left._jdf.queryExecution().toString()
    ints = docs.selectExpr("cast(doc_id AS int) AS doc_id", "text", "lang")
    assert toxicity.likely_known(ints, known, "doc_id", 500).count() == 20003
    model = toxicity.train([toxicity.buckets_of(["text", str(k)]) for k in range(8)], [0, 1] * 4)
    got = Counter({(r["lang"], r["y"], r["bin"]): r["n"] for r in toxicity.logit_counts(model, left, known, "doc_id")})
    label = {r["doc_id"]: r["y"] for r in known.collect()}
    rows = [r for r in docs.collect() if r["doc_id"] in label]
    bins = np.rint(np.clip(model.raw([r["text"] for r in rows]), -toxicity.LOGIT_BOUND, toxicity.LOGIT_BOUND) / toxicity.LOGIT_STEP)
    assert got == Counter((r["lang"], label[r["doc_id"]], int(b)) for r, b in zip(rows, bins, strict=True))


def test_toxicity_learns_from_documents_outside_the_sample(spark):
    """A mark that no sampled document has, and one behind the longest sampled text, are learned all the same."""
    rng = random.Random(6)
    texts, labels = [], []
    for k in range(1500):
        words = prose(k, rng.randint(5, 30)).split(" ")
        if k % 2 == 0:
            words[rng.randrange(len(words))] = "vileword"
        texts.append(" ".join(words))
        labels.append((k, int(k % 2 == 0)))
    df = frame(spark, texts)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    few = toxicity.fit(df, marks, of_class=8)
    held = [k for k in range(1500) if zlib.crc32(str(k).encode()) % 5 == 0]
    scores = few.score([texts[k] for k in held])
    assert sum((s >= 0.5) == (k % 2 == 0) for k, s in zip(held, scores, strict=True)) >= 0.95 * len(held)


def test_task_trainer_takes_texts_of_any_length(monkeypatch):
    rng = np.random.default_rng(1)
    model = toxicity.train([toxicity.buckets_of(["a", "b"]), toxicity.buckets_of(["bad"])], [0, 1])
    trainer = toxicity.TaskTrainer(model)
    monkeypatch.setattr(toxicity, "SLICE_WORDS", 50)
    texts = [None, "", " ".join(f"w{n}" for n in rng.integers(0, 40, 400)) + " bad"]
    for _ in range(5):
        trainer.learn(texts, [0, 0, 1])
    row, part, share, values = trainer.weights()
    assert trainer.docs == 15 and (share > 0).all() and np.isfinite(values).all() and (row >= 0).any()
    assert not np.array_equal(trainer.model.embedding, model.embedding)


def test_training_holds_little_besides_the_weights():
    """Five arrays of the embedding's size and one batch, though the sample touches every row of it."""
    import tracemalloc

    per_text = 3 * 512
    texts = [np.arange(at, at + per_text).reshape(-1, 3) % toxicity.BUCKETS for at in range(0, toxicity.BUCKETS, per_text)]
    size = toxicity.BUCKETS * toxicity.DIMS * 4
    tracemalloc.start()
    try:
        model = toxicity.train(texts, [k % 2 for k in range(len(texts))])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model.embedding.nbytes == size
    assert peak < 6.5 * size


def test_calibration_counts_as_rows():
    """Equal logits counted together give what the rows one by one give."""
    rng = np.random.default_rng(3)
    logits = np.repeat(np.round(rng.normal(size=60), 2), 5)
    y = (logits + rng.normal(size=300) > 0.5).astype(int)
    langs = ["en" if k % 2 else "de" for k in range(300)]
    single, counted = toxicity.Model(None, [], None, None, 0.0), toxicity.Model(None, [], None, None, 0.0)
    toxicity.calibrate(single, logits, y, langs, [1] * 300, 0.3)
    cells = Counter(zip(logits.tolist(), y.tolist(), langs, strict=True))
    toxicity.calibrate(counted, [c[0] for c in cells], [c[1] for c in cells], [c[2] for c in cells], list(cells.values()), 0.3)
    assert np.allclose(single.scale, counted.scale) and single.thresholds.keys() == counted.thresholds.keys()
    assert np.allclose(list(single.thresholds.values()), [counted.thresholds[k] for k in single.thresholds])


def test_long_text_scores_as_its_slices(monkeypatch):
    model = toxicity.Model(np.random.default_rng(0).normal(size=(toxicity.BUCKETS, toxicity.DIMS)).astype(np.float32),
                           [np.random.default_rng(w).normal(size=(w, toxicity.DIMS, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS],
                           np.zeros(48, np.float32), np.eye(48, dtype=np.float32)[0], 0.0)
    text = prose(9, 500)
    whole = model.score([text, None, "a"])
    monkeypatch.setattr(toxicity, "SLICE_WORDS", 40)
    assert np.allclose(model.score([text, None, "a"]), whole, atol=1e-5)


# ---------------------------------------------------------------- nearest neighbours

def test_dimension_scan(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 24)) * 3
    x = centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 24))
    x[100:140] = x[100]  # copies
    rows = [(k, x[k].tolist()) for k in range(3000)]
    odd = [(5000, None), (5050, [0.0] * 24), (5100, [float("nan")] * 24), (5150, [1.0, None] + [0.0] * 22), (5200, [1.0]), (None, x[0].tolist())]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").repartition(4)
    from pyspark.sql import functions as F

    got: dict = {}
    for r in dimension_scan.nearest(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 50):
        s = unit @ unit[q]
        s[q] = -2
        want = np.lexsort((np.arange(3000), -np.round(s, 12)))[:5]
        assert sorted(got[q]) == [1, 2, 3, 4, 5]
        assert all(abs(s[v] - score) < 1e-12 for v, score in got[q].values())
        hits += len(set(want.tolist()) & {v for v, _ in got[q].values()})
    assert set(got) == set(range(0, 3000, 50)) and hits >= 0.95 * 300
    assert [got[100][k][0] for k in range(1, 6)] == [101, 102, 103, 104, 105]
    assert dimension_scan.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert dimension_scan.nearest(df.where("vec_id = 50"), F.col("vec_id") % 50 == 0).count() == 0


def test_lonely_vectors_get_all_their_neighbours(spark, monkeypatch):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 16)) * 5
    x = centres[rng.integers(0, 8, 2000)] + 0.1 * rng.normal(size=(2000, 16))
    x = np.concatenate((x, -50 * centres.sum(axis=0) + 0.01 * rng.normal(size=(3, 16))))
    ids = [*(100 * np.arange(2000) + 1).tolist(), 0, 50, 75]
    df = spark.createDataFrame(list(zip(ids, x.tolist(), strict=True)), "vec_id long, embedding array<double>").repartition(3)
    monkeypatch.setattr(dimension_scan, "LIST_ROWS", 100)
    monkeypatch.setattr(dimension_scan, "CELL_ROWS", 64)
    got: dict = {}
    for r in dimension_scan.nearest(df, F.col("vec_id") % 25 == 0).collect():
        got.setdefault(r["query_id"], []).append(r["rank"])
    assert {q: sorted(ranks) for q, ranks in got.items()} == {q: [1, 2, 3, 4, 5] for q in (0, 50, 75)}
    few = dimension_scan.nearest(df.where("vec_id in (0, 50, 75)"), F.col("vec_id") % 25 == 0).groupBy("query_id").count().collect()
    assert {r[0]: r[1] for r in few} == {0: 2, 50: 2, 75: 2}


def test_lists_to_probe_go_on_until_enough():
    near = np.array([[0.9, 0.5, 0.1, 0.0], [0.0, 0.1, 0.2, 0.3]])
    rows, lists = dimension_scan.lists_to_probe(near, np.array([1, 0, 2, 9]), 1, 3)
    assert list(zip(rows.tolist(), lists.tolist(), strict=True)) == [(0, 0), (0, 1), (0, 2), (1, 3)]
    rows, lists = dimension_scan.lists_to_probe(near, np.array([1, 0, 2, 9]), 2, 99)
    assert np.bincount(rows).tolist() == [4, 4]


# ---------------------------------------------------------------- pages

def test_wrappers_find_optional_and_repeated_parts():
    pages = ["<div class=x><h1>A one</h1><p>t1</p><p>t2</p><p>t3</p></div>", "<div class=x><h1>A two</h1><h2>s</h2><p>t9</p></div>",
             "<div class=x><h1>A six</h1><p>t4<p>t5</div>"]
    w = None
    for p in pages:
        one = wrappers.wrapper_of(wrappers.parse(p))
        w = wrappers.merged(w, one) if w else one
    div = w[2][0]
    assert div[0] == "div.x" and [(c[0], c[1]) for c in div[2]] == [("h1", ""), ("h2", "?"), ("p", "+")]
    assert div[2][0][2][0][2] is None  # an open slot


def test_extraction(spark):
    def page(k, body):
        return (f"<!DOCTYPE html><html><head><title>t{k}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
                f"<nav><ul><li><a href='/a'>menu {k}</a></li></ul></nav><div class='ad'>buy {k}</div>{body}"
                f"<div class='comments'><p>reader says {k}</p></div><footer>&copy; us {k}</footer></body></html>")

    bodies = [(f"<article><h1>Head &amp; {k}</h1><p>One\n  two&nbsp;{k}<br>three</p><p><b>Open {k}<p>Next &lt;{k}&gt; <form>f<input></form></article>") for k in range(6)]
    rows = [(k, f"http://h.example/{k}", page(k, b)) for k, b in enumerate(bodies)]
    plain = "<html><body><div id=top>x menu</div><div class=box><p>" + "long text " * 30 + "</p><p>more of it here</p></div></body></html>"
    rows += [(10, None, None), (11, "", ""), (12, "http://other.example/", plain), (13, "not a url", "just words < here"), (14, "http://h.example/z", plain)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in wrappers.extract(df).collect()}
    for k in range(6):
        assert got[k] == f"Head & {k}\nOne two {k} three\nOpen {k}\nNext <{k}>"
    assert got[10] == got[11] == "" and got[13] == "just words < here"
    assert got[12] == got[14] == ("long text " * 30).strip() + "\nmore of it here"
    assert wrappers.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("shell", [
    "<body class='has-sidebar'>{}</body>", "<body class=sidebar>{}</body>", "<article class='post no-comments'>{}</article>",
    "<div class='content-with-sidebar'>{}</div>", "<div class='entry social-science'>{}</div>", "<div class='content-sidebar-wrap'>{}</div>",
    "<div data-id='search'>{}</div>", "<div title='a class=menu'>{}</div>", "<div class='entry social'>{}</div>"])
def test_names_that_mention_furniture_keep_their_text(shell):
    inner = ("<div class='site-footer'>foot</div><div class='share-buttons'>share</div><div class=comments>said</div>"
             "<h1>Head</h1><p>" + "body text " * 20 + "</p><svg width='3' /><p>after svg</p><video-player>clip</video-player><script src='a.js'/><p>end</p>"
             "<svg/><svg><text>drawn</text></svg><p>last</p>")
    page = "<html>" + shell.format(inner) + "</html>"
    assert wrappers.article(page, *wrappers.region(wrappers.wrapper_of(wrappers.parse(page)))).split("\n") == [
        "Head", ("body text " * 20).strip(), "after svg", "clip", "end", "last"]


def _main_text(page):
    return wrappers.article(page, *wrappers.region(wrappers.wrapper_of(wrappers.parse(page))))


@pytest.mark.parametrize("body, want", [
    ("<p title=it's>alpha</p><p>second para don't</p><p>third</p>", ["alpha", "second para don't", "third"]),
    ("<p title=it's>alpha</p><p>beta</p>", ["alpha", "beta"]),
    ("<p title=\"a > b\" class='x > y'>alpha</p><p data-x = '>'>beta</p>", ["alpha", "beta"]),
    ("<p title=\"open>alpha</p><p>beta</p>", ["alpha", "beta"]),
    ("<p a'b\"c>alpha</p><p =\"x\">beta</p>", ["alpha", "beta"]),
    ("<p>alpha<svg><path d='M0'><p>beta</p><p>third</p>", ["alpha", "beta", "third"]),
    ("<p>alpha <svg><g><text>drawn</text></g><foreignObject><div>drawn</div></foreignObject></svg>beta</p>", ["alpha beta"]),
    ("<video src=a><source src=b></video><p>alpha</p><video src=c><p>beta</p>", ["alpha", "beta"]),
    ("<canvas><p>alpha</p><object data=x>none</object><p>beta</p>", ["alpha", "beta"]),
    ("<p>alpha <select><option>one<option>two</select>beta</p><math><mi>x</mi></math><p>third</p>", ["alpha beta", "third"]),
    ("<!-->alpha<!-- <p>no</p> --!><p>beta</p></ x><p>third</p><p>fourth <b", ["alpha", "beta", "third", "fourth"]),
    ("<a href=/x/>alpha</a> beta<p>1 < 2 && 3 > 2</p>", ["alpha beta", "1 < 2 && 3 > 2"]),
    ("<script>if (a < b) '</p>'</SCRIPT ><p>alpha</p><textarea><p>no</textarea><p>beta</p>", ["alpha", "beta"]),
])
def test_broken_markup_keeps_its_text(body, want):
    assert _main_text("<html><body>" + body).split("\n") == want


@pytest.mark.parametrize("shell", ["{}", "<article>{}</article>"])
def test_deep_pages(spark, shell):
    deep = "<html><body>" + shell.format("<div>" * 5000 + "<p>alpha</p><span>" * 700 + "beta" + "</div>" * 5000 + "<p>omega</p>") + "</body></html>"
    rows = [(k, "http://deep.example/", deep) for k in (1, 1, None)] + [(4, None, "")]
    got = sorted((str(r[0]), r[2]) for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    assert [i for i, _ in got] == ["1", "1", "4", "None"]
    texts = [t.split("\n") for i, t in got if i != "4"]
    # without an article the region is the element that holds most of the text
    want = ["alpha"] * 700 + ["beta"] + ["omega"] * ("article" in shell)
    assert all(t == want for t in texts) and ("4", "") in got


def test_wrappers_survive_their_json():
    w = wrappers.wrapper_of(wrappers.parse("<ul class=a><li>x<li>y</ul><p>one <b>two</b><p>" + "long " * 99))
    assert wrappers._load(wrappers._dump(w)) == w


def test_partial_wrappers_passed_on_early_give_the_same_text(spark, monkeypatch):
    rows = [(k, f"http://h{k % 3}.example/", f"<body><div class=menu>m</div><article><h1>T{k}</h1>" + "<p>text" * (k % 5) + "</article>") for k in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    want = {r[0]: r[2] for r in wrappers.extract(df).collect()}
    monkeypatch.setattr(wrappers, "PASS_ON_CHARS", 100)
    assert {r[0]: r[2] for r in wrappers.extract(df).collect()} == want
    assert want[4] == "T4" + "\ntext" * 4


@pytest.mark.parametrize("n", [3, 9, 12])
def test_constant_article_text_stays_at_every_host_size(spark, n):
    def page(k):
        return (f"<html><body><nav>menu</nav><article><h1>Cake {k}</h1><h2>Ingredients</h2><p>flour {k} {'and so on ' * 9}</p>"
                f"<div class='notice'>we use cookies</div><h2>Method</h2><p>bake {k} minutes</p></article><footer>us</footer></body></html>")

    rows = [(k, f"http://h.example/{k}", page(k)) for k in range(n)] + [(100 + k, f"http://mirror.example/{k}", page(0)) for k in range(n)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    got = {r["page_id"]: r["text"] for r in wrappers.extract(df).collect()}
    for k in range(n):
        assert got[k].split("\n") == [f"Cake {k}", "Ingredients", f"flour {k} {'and so on ' * 9}".strip(), "Method", f"bake {k} minutes"]
        assert got[100 + k] == got[0]


# ---------------------------------------------------------------- pieces

@pytest.mark.parametrize("fitted", [False, True])
def test_pieces_are_the_best_segmentation_and_decode(spark, docs, given, fitted):
    path = vocabulary("piece_bpe_32k.model")
    scores = sentence_pieces.fit(docs, path) if fitted else None
    pieces = sentence_pieces.Pieces(path, scores)
    score = {p[0]: s for p, s in zip(pieces.pieces, pieces.scores.tolist(), strict=True) if p[2] == sentence_pieces.NORMAL}

    def best(text):
        s = pieces.marked(text)
        total = [0.0] + [-np.inf] * len(s)
        for i in range(len(s)):
            for j in range(i + 1, min(len(s), i + 48) + 1):
                v = score.get(s[i:j], float(pieces.unknown_score) if j == i + 1 else -np.inf)
                total[j] = max(total[j], total[i] + v)
        return total[-1]

    texts = [t for t in odd_texts() if t and len(t) < 3000] + [t[:600] for _, t in given[:30]]
    for text, data in zip(texts, pieces.encode_all(texts), strict=True):
        ids = np.frombuffer(data, "<u4").tolist()
        assert pieces.decode(ids) == text
        got, k = 0.0, 0
        while k < len(ids):
            if ids[k] in pieces.bytes_of:  # bytes of one unknown letter
                n = len(bytes([b for b in pieces.bytes_of[ids[k]]]).decode("utf-8", "ignore")) or next(
                    n for n in (1, 2, 3, 4) if _decodes(b"".join(pieces.bytes_of[i] for i in ids[k:k + n])))
                got, k = got + float(pieces.unknown_score), k + n
            else:
                got, k = got + score[pieces.pieces[ids[k]][0]], k + 1
        assert abs(got - best(text)) <= 1e-5 * abs(got) + 1e-3, text[:60]
    encoded = sentence_pieces.encode(docs, path, scores=scores)
    back = {r[0]: r[1] for r in sentence_pieces.decode(encoded, path).collect()}
    assert back == {k: t or "" for k, t in enumerate(odd_texts())}
    assert all(r["restored"] for r in sentence_pieces.round_trip(docs, path, scores=scores).collect())


def test_fitted_scores_are_shares_of_the_pieces_used(spark, given, monkeypatch):
    path = vocabulary("piece_bpe_32k.model")
    texts = [*odd_texts(), *[t for _, t in given[:40]], given[0][1], None, ""]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, part string")
    first = sentence_pieces.first_scores(path)
    normal = [k for k, p in enumerate(sentence_pieces.read_model(path)[0]) if p[2] == sentence_pieces.NORMAL]
    assert abs(np.exp(first[normal]).sum() - 1) < 1e-9

    def plain(rounds):
        scores = first
        for _ in range(rounds):
            used = Counter(np.frombuffer(b"".join(sentence_pieces.Pieces(path, scores).encode_all([t or "" for t in texts])), "<u4").tolist())
            n = np.array([used[k] for k in normal]) + len(normal) * np.exp(first[normal])
            scores = first.copy()
            scores[normal] = np.log(n / n.sum())
        return scores

    for rounds, slices in ((1, 1), (2, 5)):
        if slices > 1:
            monkeypatch.setattr(sentence_pieces, "COUNTED_PARTS", 50)  # counts are passed on in many pieces
        got = sentence_pieces.fit(df.repartition(slices), path, rounds=rounds)
        assert np.allclose(got, plain(rounds), rtol=0, atol=1e-12)
    assert np.allclose(sentence_pieces.fit(df.limit(0), path), first, rtol=0, atol=1e-9)
    twice = sentence_pieces.round_trip(df.selectExpr("null AS doc_id", "text", "part AS n_pieces").union(df.select("doc_id", "text", "part")), path, scores=got)
    assert twice.count() == 2 * len(texts) and twice.where("restored").count() == 2 * len(texts)


def _decodes(data):
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


def test_ids_of_a_merge_model_equal_the_library(given, monkeypatch):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = vocabulary("piece_bpe_32k.model")
    library, pieces = sentencepiece.SentencePieceProcessor(model_file=path), sentence_pieces.pieces_of(path)
    texts = [t or "" for t in odd_texts()] + [t[:1500] for _, t in given[:60]] + [
        "information about the", "   " * 50 + "x  \t y\n\n z", "\u4e00\u65e5\u672c\u8a9e" * 90, "abcdefghij" * 40, "e\u0301 \ufb01 \u2581x \u2581\u2581 y"]
    for queue in (sentence_pieces.QUEUE_LETTERS, 1):
        monkeypatch.setattr(sentence_pieces, "QUEUE_LETTERS", queue)
        pieces.known.clear()
        for text, data in zip(texts, pieces.encode_all(texts), strict=True):
            assert np.frombuffer(data, "<u4").tolist() == library.encode(text), text[:60]


def test_trie_holds_exactly_its_words():
    words = sorted({w.encode() for w in ["a", "ab", "abc", "b", "bcd", "ü", "▁t", "▁the", "the", "zz"]})
    trie = sentence_pieces.DoubleArray(words, list(range(len(words))))

    def find(w):
        s = 0
        for b in w:
            t = int(trie.base[s]) + b + 1
            if trie.check[t] != s:
                return -1
            s = t
        return int(trie.value[s])

    assert [find(w) for w in words] == list(range(len(words)))
    assert all(find(w) == -1 for w in (b"ac", b"abcd", b"x", b"\xe2", b"bc"))


# ---------------------------------------------------------------- all queries

@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_give_one_row_a_document(spark, name, duck):
    got = QUERIES[name](spark, SF).toPandas()
    key = {"op1_wrapper_extraction": "page_id", "op12_chat_formatting": "conv_id"}.get(name, "doc_id")
    if key in got and name not in ("op5_retrieval_packing", "op12_chat_formatting"):
        table = "pages" if key == "page_id" else "documents"
        assert sorted(got[key]) == sorted(r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect())
    if name in ORACLES:
        want = duck.execute(ORACLES[name]).fetchdf()[list(got.columns)]
        by = [key]
        assert want.sort_values(by).reset_index(drop=True).equals(got.astype(want.dtypes.to_dict()).sort_values(by).reset_index(drop=True))


@pytest.mark.parametrize("run", [
    lambda d: tokens.count_tokens(d, vocabulary("word_bpe_49k.json")), lambda d: packing.pack(d, vocabulary("byte_bpe_50k.json")),
    simhash.near_duplicates, simhash.keep_one_of_each, line_dedup.dedup_lines, suffix_dedup.remove_repeats, multiset.fingerprints,
    lambda d: sentence_pieces.round_trip(d, vocabulary("piece_bpe_32k.model")),
])
def test_empty_tables_give_no_rows(spark, run):
    assert run(frame(spark, [])).count() == 0


def test_no_row_is_lost_that_is_no_near_copy(spark):
    texts = [prose(100 + k, 60) for k in range(5)]
    kept = simhash.keep_one_of_each(frame(spark, texts, [3, 3, None, None, 7])).collect()
    assert sorted(r["text"] for r in kept) == sorted(texts)
    kept = simhash.keep_one_of_each(frame(spark, [texts[0], texts[0], texts[0], texts[1], None, "", None], [None, 5, 5, 5, 1, 2, None])).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(5, texts[0]), (5, texts[1]), (1, None)], key=repr) or \
        sorted((repr(r["doc_id"]), repr(r["text"])) for r in kept) == sorted([("5", repr(texts[0])), ("5", repr(texts[1])), ("1", "None")])


def test_null_ids_and_repeated_rows_pass(spark):
    df = frame(spark, ["a b c d", "a b c d", None, "x"], [None, 3, 3, None])
    assert simhash.near_duplicates(df).count() == 4
    assert tokens.count_tokens(df, vocabulary("word_bpe_49k.json")).count() == 4
    assert suffix_dedup.remove_repeats(df).count() == 4
    assert line_dedup.dedup_lines(df).count() == 4
    assert simhash.keep_one_of_each(df).count() == 3
