"""Fill-in-the-middle, chat formatting and importance resampling against brute force, and on odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from ledgerflow.llm import chat, fill_middle, importance
from ledgerflow.llm.marks import checked_marks
from ledgerflow.llm.queries import ORACLES, QUERIES
from ledgerflow.plans.compare import duckdb_connection

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, n string, output string, rank string, weight string"


@pytest.fixture
def spread(spark):
    """Small tables stay in as many partitions as asked for."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def odd_texts():
    return [None, "", "a", "\n", "\n\n\n", "one\ntwo\nthree\n", "one\ntwo\nthree", "<P>", "x<P\n>y<\n<S", "<S> in\nthe text", "é\n日本\n🙂\n", "<\n<\n>\n",
            "line\n" * 40000, "z" * 300000 + "\n" + "y" * 300001, "one\ntwo\nthree\n", "a\r\nb\x00c\n"]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", "x", "x", "x") for i, t in rows], DOCS)


def same_rows(spark, name):
    got = QUERIES[name](spark, SF)
    con = duckdb_connection(SF)
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    key = lambda rows: sorted(rows, key=repr)
    rows = key([tuple(r[c] for c in names) for r in got.collect()])
    assert rows == key([tuple(r) for r in want.fetchall()]) and rows


# ---------------------------------------------------------------- marks

def test_marks_that_could_be_mistaken_are_refused():
    assert checked_marks(("<P>", "<S>")) == (b"<P>", b"<S>")
    for bad in (("aa", "b"), ("aba",), ("ab", "bc"), ("abc", "b"), ("", "x"), ("x", "x")):
        with pytest.raises(ValueError):
            checked_marks(bad)


# ---------------------------------------------------------------- fill in the middle

def fim_brute(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, d = len(units), sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h = [int(d[8 * k:8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < spm else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return n, form, len(p), len(m), out


def test_rotation_by_reversals(monkeypatch):
    monkeypatch.setattr(fill_middle, "WINDOW", 3)
    for n in range(12):
        for cut in range(n + 1):
            buf = bytearray(range(n))
            fill_middle.rotate(buf, 0, cut, n)
            assert buf == bytes([*range(cut, n), *range(cut)])


@pytest.mark.parametrize("rules", [fill_middle.Rules(), fill_middle.Rules(seed=3, rate=40, suffix_first=10)])
def test_fill_in_middle_equals_brute_force(spark, rules):
    rows = [(7 * i + k, t) for k in range(7) for i, t in enumerate(odd_texts())] + [(5, "one\ntwo\n"), (5, "one\ntwo\n"), (None, "a\nb\nc"), (None, None)]
    df = frame(spark, rows).repartition(3)
    got = fill_middle.restore(fill_middle.transform(df, rules=rules), rules=rules).collect()
    want = Counter((i, *fim_brute(i, t, rules.seed, rules.rate, rules.suffix_first), t or "") for i, t in rows)
    assert Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["restored"]) for r in got) == want
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fill_middle.restore(fill_middle.transform(df.limit(0))).collect() == []


def test_fill_in_middle_query(spark):
    same_rows(spark, "op11_fill_in_middle")


# ---------------------------------------------------------------- chat formatting

def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_parts_become_placeholders_in_order(spark):
    parts = [part("text", "see <"), part("text", "s> \\"), part("image", None, "a.png", 57, 28), part(None, "and"), part("audio", None, "b.wav", seconds=1.5),
             part("document", "its text </s>", "c.pdf", pages=3), part("video", None, "d.mp4"), None]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", [part("text", "ok")]), (1, 2, None, None), (None, None, "x[INST]", [])],
                               f"conv_id long, turn int, role string, parts {chat.PARTS}")
    rows = {(r["conv_id"], r["turn"]): r for r in chat.format_turns(df).collect()}
    first = rows[1, 0]
    assert first["formatted"] == r"<s>user[INST]see <\s> \\<image>and<audio><document>its text <\/s><file></s>"
    assert [(a["kind"], a["ref"], a["tokens"], first["formatted"][a["start"]:].split(">")[0]) for a in first["attachments"]] == [
        ("image", "a.png", 3, "<image"), ("audio", "b.wav", 38, "<audio"), ("document", "c.pdf", 768, "<document"), ("video", "d.mp4", 0, "<file")]
    assert first["tokens"] == 3 + 38 + 768 and first["loss_start"] == first["loss_stop"]
    reply = rows[1, 1]
    assert reply["formatted"][reply["loss_start"]:reply["loss_stop"]] == "ok"
    assert rows[1, 2]["formatted"] == "<s>[INST]</s>" and rows[None, None]["formatted"] == r"<s>x[\INST][INST]</s>"
    template = chat.Template()
    read = list(chat.read_turns("".join(rows[1, k]["formatted"] for k in range(3)).encode(), template))
    assert read == [(b"user", rb"see <s> \<image>and<audio><document>its text </s><file>", False), (b"assistant", b"ok", True), (b"", b"", False)]


def chat_brute(rows, conv):
    turns = [(r[2] or "", r[3] or "") for r in rows if r[0] == conv]
    loss = "".join(t for role, t in turns if role == "assistant")
    return len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)), len(loss), sha(loss)


@pytest.mark.parametrize("chunk", [1 << 20, 40])
def test_conversations_read_back(spark, spread, monkeypatch, chunk):
    monkeypatch.setattr(chat, "CHUNK_BYTES", chunk)
    rng = random.Random(1)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "s>", "<image>", "é🙂", "\n", "", " word", "<\\s>", "x" * 3000]
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), "".join(rng.choices(bits, k=6))) for c in range(60) for t in range(rng.randint(1, 7))]
    rows += [(77, t, "assistant" if t % 2 else "user", f"{t} {bits[t % 14]}") for t in range(3000)]  # two thirds of all rows
    rows += [(88, 0, None, None), (88, 1, "a\nb</s>", ""), (None, 0, "user", "who"), (None, None, "assistant", "first")]
    rows += [(99, 5, "assistant", "again")] * 50
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    df = df.withColumn("parts", chat.text_parts(df["text"])).withColumn("slice", df["turn"]).withColumn("formatted", df["text"])
    got = {r["conv_id"]: r for r in chat.digests(chat.conversations(chat.format_turns(df))).collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0))
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == chat_brute(ordered, conv), conv
    assert chat.digests(chat.conversations(chat.format_turns(df.limit(0)))).collect() == []


def test_chat_query(spark):
    same_rows(spark, "op12_chat_formatting")


# ---------------------------------------------------------------- importance resampling

def grams(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    return words, [zlib.crc32(b" ".join(words[i:i + n])) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def importance_brute(rows, wanted, least=20, percent=5, seed=42):
    s, t = (Counter(b for x in texts for b in grams(x)[1]) for texts in ([r[1] for r in rows], wanted))
    S, T = sum(s.values()), sum(t.values())
    out = []
    for k, (i, text) in enumerate(rows):
        words, found = grams(text)
        w = sum(math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in found)
        h = int(sha(f"{seed}:{'' if i is None else i}")[:8], 16)
        out.append((i, len(found), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= least, k))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    rank = {r[5]: k + 1 for k, r in enumerate(able[:percent * len(able) // 100])}
    return Counter((*r[:4], rank.get(r[5])) for r in out)


def found(df):
    return Counter(tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in df.collect())


def test_importance_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    wanted = [r[0] for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    assert found(QUERIES["op13_importance_resampling"](spark, SF)) == importance_brute(docs, wanted)


@pytest.mark.parametrize("percent", [0, 5, 60, 100])
def test_importance_on_odd_rows(spark, spread, monkeypatch, percent):
    monkeypatch.setattr(importance, "CHUNK", 7)
    rng = random.Random(2)
    words = ["the", "of", "é", "日本", "a1", "B", "\x7f", "-", "zz", "\n"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(150)]
    rows += [(500, " ".join(words * 4))] * 90 + [(500, " ".join(words * 5))] * 3 + [(None, " ".join(words * 4)), (None, None), (900, None), (901, ""), (902, "x" * 5000)]
    wanted = ["the of é", None, "", "zz a1 b the"]
    df, target = frame(spark, rows).repartition(4), spark.createDataFrame([(t,) for t in wanted], "text string")
    got = found(importance.resample(df, target, sampling=importance.Sampling(percent=percent)))
    assert got == importance_brute(rows, wanted, percent=percent)


def test_importance_of_empty_tables(spark):
    df, none = frame(spark, [(i, "some words " * 15) for i in range(40)]), spark.createDataFrame([], "text string")
    assert found(importance.resample(df, none)) == importance_brute([(i, "some words " * 15) for i in range(40)], [])
    assert importance.resample(df.limit(0), none).collect() == []


def test_kth_key_of_repeated_keys(spark):
    rng = random.Random(4)
    values = [(rng.randint(0, 30), rng.choice([None, 1, 2])) for _ in range(700)] + [(9, 1)] * 300
    rows = spark.createDataFrame([(v,) for v in values], "key struct<a: int, b: int>").repartition(4)
    ordered = sorted(values, key=lambda v: (v[0], v[1] is not None, v[1] or 0))
    for k in (1, 2, 350, 500, 999, 1000):
        assert tuple(importance.kth_key(rows, "key", k)) == ordered[k - 1]
    assert importance.kth_key(rows, "key", 0) is None and importance.kth_key(rows, "key", 1001) is None
