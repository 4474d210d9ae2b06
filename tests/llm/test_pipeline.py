"""The pipeline against a brute-force version of its five stages."""

from __future__ import annotations

import zlib

import corpus_pipeline as cp
import numpy as np
import pytest
from test_documents import brute_components, brute_contamination, brute_lines, check_packing

from minegrain.llm import queries as q
from minegrain.llm.packing import load_encoder


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    """Some documents with copies, contaminated ones, null and letterless texts, and a repeated row."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id < 60 and length(text) < 6000")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    item = bench.filter("length(text) > 120").first()["text"]
    first = docs.orderBy("doc_id").first()
    extra = [
        (900, first["text"], first["lang"]),
        (901, first["text"].replace(" ", "  ", 1), first["lang"]),
        (902, item, "en"),
        (903, item + "\n" + item.upper(), None),
        (904, None, "en"),
        (905, "12 -- 34", "en"),
        (906, "", "fr"),
    ]
    more = spark.createDataFrame(extra, "doc_id long, text string, lang string").selectExpr(
        "doc_id", "text", "lang", "'x' as source", "cast(length(text) as bigint) as n_chars"
    )
    path = tmp_path_factory.mktemp("tables")
    every = docs.select(*more.columns).union(more).union(docs.select(*more.columns).filter(f"doc_id = {first['doc_id']}"))
    every.write.parquet(f"{path}/documents.parquet")
    bench.write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "simhash_dedup", "decontamination", "packing"]
    stages = dict(cp.STAGES)

    one = stages["language_id"](spark, docs, folder)
    want = sorted(((d, t) for d, t in pairs(docs) if any(c.isalpha() for c in t or "")), key=str)
    assert one.columns == docs.columns and pairs(one) == want

    two = stages["line_dedup"](spark, one, folder)
    kept = {(d, i) for d, i, *_, k in brute_lines(want) if k}
    want = [(d, "\n".join(s for i, s in enumerate(t.split("\n")) if len(s) < 20 or (d, i) in kept)) for d, t in want]
    assert two.columns == docs.columns and pairs(two) == sorted(want, key=str)
    assert all(r.n_chars == len(r.text) for r in two.collect())

    three = stages["simhash_dedup"](spark, two, folder)
    named = {d: c for d, _, c in brute_components(want)}
    want = sorted({(d, t) for d, t in want if named[d] == d}, key=str)
    assert three.columns == docs.columns and pairs(three) == want

    four = stages["decontamination"](spark, three, folder)
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    dirty = {r[0] for r in brute_contamination(want, items) if r[-1]}
    want = [(d, t) for d, t in want if d not in dirty]
    assert dirty & {902, 903} and four.columns == docs.columns and pairs(four) == want

    five = stages["packing"](spark, four, folder)
    encode = load_encoder(*q.bpe_encoder())
    assert check_packing(want, five.collect(), encode) == 0

    whole = cp.run(spark, folder)
    crcs = {}
    for d, t in want:
        crcs[d] = zlib.crc32(np.append(encode([t])[0], np.uint32(1)).astype("<u4").tobytes())
    found = {r.doc_id: r.ids_crc32 for r in whole.collect() if r.length == r.doc_tokens}
    assert set(found) <= set(crcs) and all(crcs[d] == c for d, c in found.items())
    assert whole.groupBy("doc_id").count().count() == len(want)


def test_stages_on_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("false")
    for _, stage in cp.STAGES:
        assert stage(spark, docs, folder).count() == 0
