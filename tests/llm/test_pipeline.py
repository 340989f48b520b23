"""The corpus pipeline, stage by stage, on the given documents."""

import numpy as np

import corpus_pipeline
from ledgerflow.llm import line_dedup, tokens
from ledgerflow.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "substring_dedup", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF))
        assert docs.columns == columns
    left = {r["doc_id"]: r for r in docs.collect()}
    assert set(left) < set(before) and len(left) > len(before) // 2
    assert all(r["n_chars"] == len(r["text"]) for r in left.values() if r["text"] is not None)
    exact: dict = {}
    for k, r in before.items():
        exact.setdefault(r["text"], []).append(k)
    assert all(sum(k in left for k in ids) <= 1 for ids in exact.values())
    lines = [" ".join(x.lower().split()) for r in left.values() for x in (r["text"] or "").split("\n")]
    lines = [x for x in lines if len(x) >= 2 * line_dedup.MIN_CHARS]  # a long line that came twice went, whatever its units
    assert len(lines) == len(set(lines))
    library = tokens.library(vocabulary("byte_bpe_50k.json"))
    want = sum(len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in left.values())
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert sum(r["length"] for r in pieces) == want and {r["doc_id"] for r in pieces} == set(left)
    ends: dict = {}
    for r in pieces:
        ends[r["sequence_id"]] = max(ends.get(r["sequence_id"], 0), r["offset"] + r["length"])
    assert all(e == 1024 or np.log2(e) % 1 == 0 for e in ends.values())


def test_stages_with_nulls_extra_columns_and_empty_tables(spark):
    text = " ".join(f"{'abcdefgh'[k % 8]}{k * k}q," for k in range(120))  # no shingle twice, which would rule the fingerprint
    own = "Other words first. " + " ".join(f"{'stuvwxyz'[k % 8]}{k * k + 5}m." for k in range(200))
    # ids without a label, so that the classifier says nothing
    rows = [(None, None, None, None, None, "r"), (9_000_001, text, "en", "s", None, "r"), (9_000_001, text, "en", "s", None, "r"), (9_000_002, "", "en", None, 0, None),
            (9_000_003, f"{own} {text}", None, "s", 5, "x"), (None, "a text without an id", "en", "s", 1, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, removed string"  # a clashing name
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.stored(stage(spark, docs, SF).select(*[c for c in docs.columns if c in ("doc_id", "text", "lang", "source", "n_chars")]))
        left = {(r["doc_id"], r["text"]) for r in docs.collect()}
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
        if not given:
            assert left == set() and pieces == []
            continue
        assert (9_000_001, text) in left and (None, "a text without an id") in left and (9_000_002, "") in left
        third = next(t for i, t in left if i == 9_000_003)
        assert own in third and len(third) < len(own) + 0.2 * len(text)
        assert {r["doc_id"] for r in pieces} == {i for i, _ in left}
