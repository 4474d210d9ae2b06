"""Phrase collocations, ranked search and source mixing against SQL, brute force and edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from decimal import Decimal

import numpy as np
import pytest
from check_queries import compare, connect
from pyspark.sql import functions as F

from minegrain.llm import collocations as col
from minegrain.llm import mixing as mix
from minegrain.llm import queries as q
from minegrain.llm import ranked_search as rs

LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.mark.parametrize("name", ["op11_collocations", "op12_ranked_search", "op13_source_mix"])
def test_sql(spark, sf, name):
    con = connect(sf)
    assert compare(q.QUERIES[name](spark, sf).toPandas(), con.execute(q.SQL[name]).df()) == ""


# --- phrase collocations


def brute_collocations(rows, min_count, longest, top, share):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    f = {x: c for x, c in f.items() if c >= min_count}
    inside = defaultdict(int)
    for (lang, words), c in f.items():
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                if j - i < len(words):
                    inside[lang, words[i:j]] = max(inside[lang, words[i:j]], c)
    by = defaultdict(list)
    for (lang, words), a in f.items():
        if len(words) > 1 and not 100 * inside[lang, words] >= share * a:
            cuts = [(f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
            score, k = min(((1000 * a * n[lang]) // (l * r), k) for k, (l, r) in enumerate(cuts))
            by[lang].append((-score, -a, " ".join(words).encode(), *cuts[k]))
    return {
        (lang, i + 1, p.decode(), -a, l, r, n[lang], -s)
        for lang, found in by.items()
        for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])
    }


def collocation_rows(seed, n=150):
    rng = random.Random(seed)
    words = ["a", "B", "the", "New", "york", "é", "漢", "x\x1cy", "|", "-", " ", "zz"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?"]) for _ in range(rng.randint(0, 60)))
        rows.append((text, rng.choice(["en", "en", "fr", None, "und"])))
    return rows + [(None, "en"), ("", None), (rows[0][0], rows[0][1])] + [("new york city hall in new york", "de"), ("new york", "")] * 5


@pytest.mark.parametrize("longest, share, top", [(5, 100, 2000), (3, 60, 10), (2, 100, 5)])
def test_collocations_against_brute_force(spark, longest, share, top):
    rows = collocation_rows(longest)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    found = {tuple(r) for r in col.collocations(docs, min_count=4, longest=longest, share=share, top=top).collect()}
    assert found == brute_collocations(rows, 4, longest, top, share)


def test_collocations_of_long_texts_and_full_filters(spark, monkeypatch):
    rng = random.Random(3)
    text = "".join(f"w{int(rng.random() ** 3 * 300)}" + rng.choice([" ", " ", " ", ". "]) for _ in range(20_000))
    rows = [(text, "en"), (text[:50_000], "fr"), ("x" * 100_000, "en")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    expected = brute_collocations(rows, 5, 4, 2000, 100)
    # Texts in many blocks, counts handed over often, and a filter that lets most pairs through.
    monkeypatch.setattr(col, "_BLOCK_BYTES", 1000)
    monkeypatch.setattr(col, "_CHUNK_WORDS", 3000)
    monkeypatch.setattr(col, "_FILTER_BITS", (8, 8))
    assert {tuple(r) for r in col.collocations(docs, min_count=5, longest=4).collect()} == expected


def test_filter_ends_windows_early(spark):
    docs = spark.createDataFrame([("a b c. " * 10 + " ".join(f"rare{i}" for i in range(500)), "en")], "text string, lang string")
    bits = col._frequent_slots(docs, 10)
    sent = spark.sparkContext.broadcast(bits)
    rows = docs.mapInArrow(col._lead_windows(sent, 3), "lang string, w1 string, w2 string, w3 string, n long").collect()
    assert sum(r.n for r in rows) == 530
    assert {(r.w1, r.w2, r.w3): r.n for r in rows if r.n >= 10}.items() >= {("a", "b", "c"): 10, ("b", "c", ""): 10, ("c", "", ""): 10}.items()
    assert len(rows) < 20


def test_score_is_exact_beyond_64_bits(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(200):
        n = rng.randint(10**12, 10**15)
        l, r = rng.randint(10**9, 10**12), rng.randint(10**9, 10**12)
        rows.append((rng.randint(100, min(l, r)), l, r, n))
    out = col.with_score(spark.createDataFrame(rows, "a long, l long, r long, n long")).collect()
    assert all(x.score == 1000 * x.a * x.n // (x.l * x.r) for x in out)
    assert max(1000 * Decimal(x.a) * x.n for x in out) > 2**64


def test_collocation_edges(spark, edge_docs, no_docs):
    out = col.collocations(edge_docs)
    rows = [(r.text, r.lang) for r in edge_docs.select("text", "lang").collect()]
    assert {tuple(r) for r in out.collect()} == brute_collocations(rows, 100, 5, 2000, 100)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert col.collocations(no_docs).count() == 0
    clash = edge_docs.selectExpr("text", "lang", "1 as n", "2 as w1", "3 as rolled", "4 as f", "5 as phrase", "6 as slot")
    assert sorted(col.collocations(clash).collect()) == sorted(out.collect())


# --- ranked search


def brute_search(docs, items, k):
    terms = lambda t: re.findall(rs.TERM, (t or "").translate(LOWER))
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    size, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = {}
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    for i, ts in wanted.items():
        scored = []
        for d, c in held:
            m = 50 + (50 * sum(c.values()) * size) // total
            s = 0
            for t in ts & c.keys():
                s += math.floor(1000 * math.log((2 * size + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out[i] = [(None if null else d, -s) for s, null, d in sorted(scored)[:k]]
    return {i: v for i, v in out.items() if v}


def by_item(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: r.rank):
        out[r.item_id].append((r.doc_id, r.score))
        assert r.rank == len(out[r.item_id])
    return dict(out)


@pytest.mark.parametrize("block_bytes", [rs.BLOCK_BYTES, 400])
def test_search_against_brute_force(spark, block_bytes):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(200)] + ["É", "漢字", "A1", "x_y", "don't"]
    text = lambda n: rng.choice([" ", "\n", "--"]).join(rng.choice(words[: rng.randint(1, len(words))]) for _ in range(n))
    docs = [(i, text(rng.randint(0, 60))) for i in range(500)]
    docs += [(1000 + i, docs[7][1]) for i in range(30)] + [(None, docs[7][1]), (3, "w1 w2"), (4, None), (5, "...")]
    items = [(i, text(rng.randint(1, 120))) for i in range(12)] + [(3, "w0 w1"), (None, "w5"), (99, None), (98, "?!"), (97, "nowhere")]
    found = rs.ranked_search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string"),
        k=20,
        block_bytes=block_bytes,
    )
    assert by_item(found) == brute_search(docs, items, 20)


def test_search_stops_at_safe_masks():
    rng = np.random.default_rng(0)
    n = 5000
    rare, common = np.sort(rng.choice(n, 60, replace=False)), np.arange(n)
    terms, parts = [rare, common], [np.full(60, 10**6), rng.integers(1, 1000, n)]
    best = rs._Best(50)
    seen = rs._rank_batch(best, terms, parts, np.arange(n), np.zeros(n, bool))
    score = np.zeros(n, np.int64)
    score[rare] += parts[0]
    score += parts[1]
    order = np.lexsort((np.arange(n), -score))[:50]
    assert seen < n and best.ids.tolist() == order.tolist() and best.scores.tolist() == score[order].tolist()


def test_masks_of_many_terms():
    rng = np.random.default_rng(1)
    held = [np.sort(rng.choice(300, rng.integers(1, 200), replace=False)) for _ in range(150)]
    masks, code = rs._masks(held, 300)
    for doc in range(300):
        bits = {i for i in range(150) if int(masks[i // 64][code[doc]]) >> (i % 64) & 1}
        assert bits == {i for i, h in enumerate(held) if doc in h}
    assert masks.shape == (3, len(set(code)))


def test_search_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame([("a", "word X"), ("b", None), (None, "tie")], "item_id string, text string")
    found = by_item(rs.ranked_search(edge_docs, items))
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    assert found == brute_search(rows, [("a", "word X"), ("b", None), (None, "tie")], 50)
    assert rs.ranked_search(no_docs, items).count() == 0
    assert rs.ranked_search(edge_docs, items.filter("false")).count() == 0
    clash = edge_docs.selectExpr("doc_id", "text", "1 as item", "2 as score", "3 as m", "4 as lot", "5 as tf", "6 as item_id")
    assert by_item(rs.ranked_search(clash, items)) == found


# --- source mixing


def uniform(seed, doc):
    digits = hashlib.md5(f"{seed}|{'' if doc is None else doc}".encode()).hexdigest()[:10]
    return (int(digits, 16) + 0.5) / float(1 << 40)


def brute_targets(sizes, weights, copies):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(copies * sizes[s] for s in full)
        share = sum(w[s] for s in order if s not in full)
        target = {s: float(copies * sizes[s]) if s in full else w[s] * float(rest) / share for s in order}
        above = {s for s in order if s not in full and target[s] >= copies * sizes[s]}
        if not above:
            return target
        full |= above


def brute_mix(rows, seed=13):
    """Copies for rows (doc_id, text, source) with different ids."""
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, _ in rows}
    sizes = Counter()
    for d, _, s in rows:
        sizes[s] += size[d]
    target, out = brute_targets(sizes, mix.WEIGHTS, 3), {}
    for s in sizes:
        docs = [d for d, _, x in rows if x == s]
        expected = min(target[s] / sizes[s], 3.0) if sizes[s] else 0.0
        whole, p = math.floor(expected), expected - math.floor(expected)
        rest, others = target[s] - sum(whole * size[d] for d in docs), []
        key = lambda d: (uniform(seed, d) / (1 - uniform(seed, d))) * ((1 - p) / p) if p else 0.0  # noqa: B023, E731
        copies = dict.fromkeys(docs, whole)
        for n, d in enumerate(sorted([d for d in docs if p and size[d]], key=lambda d: (key(d), str(d)))):
            if size[d] <= rest:
                rest, copies[d] = rest - size[d], whole + 1
            else:
                others.append((size[d], n, d))
        if others and min(others)[0] < 2 * rest:
            copies[min(others)[2]] += 1
        out |= {d: (size[d], sizes[s], round(target[s], 6), c * size[d]) for d, c in copies.items()}
    return out


def mix_rows(seed=0, n=600, tail=0.8):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["hot"] * 6 + [f"s{rng.randint(0, 9)}", None, "", "Ä"])
        rows.append((i, " ".join(["w"] * int(rng.paretovariate(tail) * 5)), source))
    return rows + [(n, None, "hot"), (n + 1, "", "empty"), (n + 2, " \n", "empty"), (n + 3, "one", "single")]


def mixed(df):
    return {r.doc_id: (r["size"], r.source_size, round(r.target, 6), r.taken) for r in df.collect()}


def test_mix_against_brute_force(spark):
    rows = mix_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixed(mix.mix_sources(docs.repartition(7)))
    assert found == brute_mix(rows)
    assert found == mixed(mix.mix_sources(docs.repartition(3, "source")))  # reruns agree


def test_mix_comes_near_its_targets(spark):
    """What a source lacks is at most half of the smallest document that could still be taken; what it has too much is less
    than half of one of its documents."""
    rows = mix_rows(seed=4, tail=1.5)
    found = mixed(mix.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    by = defaultdict(list)
    for d, _, s in rows:
        by[s].append(found[d])
    for s, docs in by.items():
        size, target = docs[0][1:3]
        lacks = target - sum(x[3] for x in docs)
        fewer = [x[0] for x in docs if x[0] and x[3] <= math.floor(target / size) * x[0]]
        assert lacks <= min(fewer) / 2 + 1e-6 if lacks > 0 and fewer else -lacks < max(x[0] for x in docs) / 2 + 1
    assert sum(x[3] for x in by["hot"]) == pytest.approx(by["hot"][0][2], rel=0.002)


def test_mix_looks_ahead_within_a_bound(spark, monkeypatch):
    monkeypatch.setattr(mix, "LOOK_AHEAD", 16)
    rows = [(i, " ".join(["w"] * (1 + i % 40)), ("big", "small")[i % 10 == 0]) for i in range(5000)]
    out = mix.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    sums = out.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max(F.col("taken") - 3 * F.col("size")).alias("over"))
    for r in sums.collect():
        assert abs(r.taken - r.target) <= 20 and r.over <= 0


def test_unequal_inclusion(spark):
    """Over many seeds a document is drawn about as often as its weight asks for, and is never above the limit."""
    rows = [(i, "w " * (1 + i % 7), "s", float(i % 5)) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, weight double").cache()
    taken = defaultdict(float)
    for seed in range(3):
        for r in mix.mix_sources(docs, weight_col="weight", copies=2, seed=seed).collect():
            assert r.taken <= 2 * r["size"]
            taken[r.weight] += r.taken / r["size"] / 3 / 200
    # Level 0.5 for weights 1 to 4 would be half of the words, 1, 1.5 and 2 copies; words, not rows, fill the target.
    assert taken[0.0] == 0
    level = taken[2.0] / 2
    assert taken[1.0] == pytest.approx(level, abs=0.12) and taken[3.0] == pytest.approx(min(2, 3 * level), abs=0.12)


def test_water_levels(spark):
    rng = random.Random(2)
    rows = [(g, float(rng.randint(0, 5)), rng.randint(0, 50), float(60 + 10 * g)) for g in range(4) for _ in range(30)]
    df = spark.createDataFrame(rows, "g long, share double, most long, total double")
    levels = mix.water_levels(df, "g", "share", "most", "total")
    out = df.join(levels, "g").withColumn("amount", mix.amount_at(F.col("share"), F.col("most"), F.col("total"))).collect()
    for g in range(4):
        mine = [r for r in out if r.g == g]
        assert sum(r.amount for r in mine) == pytest.approx(60 + 10 * g)
        level = max(r.amount / r.share for r in mine if r.share and r.amount < r.most)
        assert all(r.amount == pytest.approx(min(level * r.share, r.most)) for r in mine)


def test_mix_edges(spark, edge_docs, no_docs):
    out = mix.mix_sources(edge_docs)
    rows = out.collect()
    assert len(rows) == edge_docs.count() and all(r.taken <= 3 * r["size"] and r.target >= 0 for r in rows)
    assert {"size", "source_size", "target", "taken", "doc_id", "kept", "__id"} <= set(out.columns) and "text" not in out.columns
    assert sorted(map(str, rows)) == sorted(map(str, mix.mix_sources(edge_docs.repartition(4)).collect()))
    assert mix.mix_sources(no_docs).count() == 0
    clash = edge_docs.selectExpr("doc_id", "text", "source", "1 as size", "2 as `group`", "3 as __row", "4 as row", "5 as Target", "6 as p")
    assert mix.mix_sources(clash).columns == ["doc_id", "source", "group", "__row", "row", "p", "size", "source_size", "target", "taken"]
