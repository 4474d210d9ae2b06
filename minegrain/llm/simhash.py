"""SimHash near-duplicates: fingerprints, a binary trie self-join under a Hamming budget, components."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minegrain.llm.common import connected_components, fresh, row_key, stored

BITS = 64
# Rows of one trie forest; the number of forests follows the number of fingerprints.
FOREST_ROWS = 200_000
# A bucket with more fingerprints is dealt again by further bits.
BUCKET_ROWS = 4096
# Times that buckets are dealt again; each time a bucket's rows go to five.
MAX_DEALS = 2
# Node pairs that are expanded at once.
FRONTIER = 500_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_LOT = 65_536


def _hashes(text: str, words: int) -> Iterator[np.ndarray]:
    """XXH64 of each shingle, in lots."""
    found = _WORD.findall(text.translate(_LOWER))
    if not found:
        return
    joined = " ".join(found).encode("utf-8", "replace")
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], spaces + 1))
    ends = np.append(spaces, len(joined))
    if len(starts) > words:
        starts, ends = starts[: 1 - words], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    starts, ends = starts.tolist(), ends.tolist()
    for at in range(0, len(starts), _LOT):
        lot = [digest(joined[s:e], 42) for s, e in zip(starts[at : at + _LOT], ends[at : at + _LOT])]
        yield np.array(lot, np.uint64)


def fingerprint(text: str | None, words: int = 4) -> int:
    """The 64-bit SimHash: a bit is 1 if it is set in over half of the shingles' hashes; 0 for a text without words."""
    ones, n = np.zeros(BITS, np.int64), 0
    for lot in _hashes(text or "", words):
        ones += np.unpackbits(lot.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        n += len(lot)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """(id, fp): whole texts; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fps = np.array([fingerprint(t, words) for t in b["__text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"__id": b["__id"], "fp": fps})

    narrow = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    kind = narrow.schema["__id"].dataType.simpleString()
    # Ids travel as text, so that a null does not turn a batch of longs into doubles.
    out = narrow.withColumn("__id", F.col("__id").cast("string")).mapInPandas(run, "__id string, fp bigint")
    return out.select(F.col("__id").cast(kind).alias(id_col), "fp")


def _split_mask(free: int, parts: int) -> list[int]:
    """The set bits of `free` cut into `parts` runs."""
    bits = [1 << b for b in range(BITS - 1, -1, -1) if free >> b & 1]
    return [sum(bits[len(bits) * i // parts : len(bits) * (i + 1) // parts]) for i in range(parts)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _roots(fps: np.ndarray, starts: np.ndarray, budget: int) -> np.ndarray:
    """For each fingerprint of a forest the index of its root after all links inside a bucket were followed.

    `fps` is sorted inside each bucket [starts[i], starts[i + 1]). A node is a range of equal leading bits; pairs of nodes
    go down bit by bit with the errors so far, and a pair beyond the budget is dropped. Pairs of single leaves are compared
    whole. Links are merged at once, so they are never listed.
    """
    n = len(fps)
    root = np.arange(n)

    def merge(i: np.ndarray, j: np.ndarray) -> None:
        nonlocal root
        while len(i):
            a, b = root[i], root[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up

    lo, hi = starts[:-1], starts[1:]
    many = hi - lo > 1
    lo, hi = lo[many], hi[many]
    work = [(0, lo, hi, lo.copy(), hi.copy(), np.zeros(len(lo), np.int64))]
    while work:
        depth, alo, ahi, blo, bhi, err = work.pop()
        if len(alo) > FRONTIER:
            for part in np.array_split(np.arange(len(alo)), -(-len(alo) // FRONTIER)):
                work.append((depth, alo[part], ahi[part], blo[part], bhi[part], err[part]))
            continue
        leaf = (ahi - alo == 1) & (bhi - blo == 1)
        if leaf.any():
            i, j = alo[leaf], blo[leaf]
            near = np.bitwise_count(fps[i] ^ fps[j]) <= budget
            merge(i[near], j[near])
            rest = ~leaf
            alo, ahi, blo, bhi, err = alo[rest], ahi[rest], blo[rest], bhi[rest], err[rest]
        if not len(alo) or depth == BITS:
            continue
        amid, bmid = _middle(fps, alo, ahi, depth), _middle(fps, blo, bhi, depth)
        same = (alo == blo) & (ahi == bhi)
        sides = [
            (alo, amid, blo, bmid, err),
            (amid, ahi, bmid, bhi, err),
            (alo, amid, bmid, bhi, err + 1),
            (amid[~same], ahi[~same], blo[~same], bmid[~same], err[~same] + 1),
        ]
        cols = [np.concatenate(c) for c in zip(*sides)]
        own = (cols[0] == cols[2]) & (cols[1] - cols[0] == 1)  # a leaf with itself
        go = (cols[1] > cols[0]) & (cols[3] > cols[2]) & (cols[4] <= budget) & ~own
        if go.any():
            work.append((depth + 1, *(c[go] for c in cols)))
    return root


def _middle(fps: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where the bit at `depth` turns to 1 in each node: a binary search over all nodes at once."""
    lo, hi = lo.copy(), hi.copy()
    shift = np.uint64(BITS - 1 - depth)
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        one = ((fps[np.minimum(mid, len(fps) - 1)] >> shift) & np.uint64(1)).astype(bool)
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)


def fingerprint_links(fps: DataFrame, budget: int = 4) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) within `budget` bits, as a spanning forest per bucket.

    Two fingerprints within the budget agree in one of budget + 1 runs of bits, so every pair meets in a bucket of equal
    bits. Buckets above BUCKET_ROWS are dealt again by runs of the remaining bits, with the same guarantee, up to MAX_DEALS
    times; what is still large then agrees in half of all bits and stays whole. Buckets are dealt to forests, whose tries are
    joined with themselves.
    """
    full = (1 << BITS) - 1
    masks = _split_mask(full, budget + 1)
    rows = fps.select("fp").distinct()
    done = None
    for deal in range(MAX_DEALS + 1):
        keyed = rows.withColumn("mask", F.explode(F.array(*[F.lit(_signed(m)) for m in masks]))) if done is None else rows
        keyed = stored(keyed.withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))).select("fp", "mask", "key"), "buckets")
        if deal < MAX_DEALS:
            big = keyed.groupBy("mask", "key").count().filter(F.col("count") > BUCKET_ROWS).select("mask", "key")
            big = stored(big, "hot-buckets")
            hot_masks = [r[0] for r in big.select("mask").distinct().collect()]  # of a fixed set
        else:
            hot_masks = []
        again = {m: _split_mask(full & ~(m % (1 << BITS)), budget + 1) for m in hot_masks}
        if not again:
            small = keyed
        else:
            small = keyed.join(big, ["mask", "key"], "left_anti")
        done = small if done is None else done.unionByName(small)
        if not again:
            break
        finer = F.create_map(
            *[x for m, parts in again.items() for x in (F.lit(m), F.array(*[F.lit(_signed(p)) for p in parts]))]
        )
        rows = (
            keyed.join(big, ["mask", "key"], "left_semi")
            .select("fp", F.col("mask").alias("__m"), F.explode(finer[F.col("mask")]).alias("__p"))
            .select("fp", F.col("__m").bitwiseOR(F.col("__p")).alias("mask"))
        )

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)  # one forest, sized below
        if not parts:
            return
        b = pd.concat(parts, ignore_index=True)
        fp, mask, key = (b[c].to_numpy(np.int64).view(np.uint64) for c in ("fp", "mask", "key"))
        order = np.lexsort((fp, key, mask))
        fp, mask, key = fp[order], mask[order], key[order]
        # Two ways of dealing may lead to one mask; equal leaves would hide each other's links.
        first = np.concatenate(([True], (np.diff(fp) != 0) | (np.diff(mask) != 0) | (np.diff(key) != 0)))
        fp, mask, key = fp[first], mask[first], key[first]
        new = np.flatnonzero((np.diff(mask) != 0) | (np.diff(key) != 0)) + 1
        root = _roots(fp, np.concatenate(([0], new, [len(fp)])).astype(np.int64), budget)
        moved = root != np.arange(len(fp))
        yield pd.DataFrame({"a": fp[root[moved]].view(np.int64), "b": fp[moved].view(np.int64)})

    forests = max(fps.sparkSession.sparkContext.defaultParallelism, -(-done.count() // FOREST_ROWS))
    return done.repartition(forests, "mask", "key").mapInPandas(join, "a bigint, b bigint").distinct()


def fingerprint_components(marked: DataFrame, budget: int) -> DataFrame:
    """(fp, component_id) for each different fingerprint of `marked` (__id, fp)."""
    nodes = stored(marked.groupBy("fp").agg(F.min("__id").alias("__low")), "nodes")
    roots = connected_components(fingerprint_links(nodes, budget), "a", "b").withColumnRenamed("node", "fp")
    nodes = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = nodes.groupBy("root").agg(F.min("__low").alias("component_id"))
    return nodes.join(names, "root").select("fp", "root", "component_id")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, budget: int = 4
) -> DataFrame:
    """Per row: id, fingerprint (16 hex digits) and component_id, the smallest id among all that links reach.

    Null, empty and wordless texts have fingerprint zero and link like any other. Copies share a fingerprint and are one
    node, so no pair of them is made. Null ids are members but never name a component unless all ids in it are null.
    Repeated rows give repeated rows. An empty table gives an empty result; other columns are ignored.
    """
    marked = stored(with_fingerprints(docs, id_col, text_col, words).withColumnRenamed(id_col, "__id"), "fingerprints")
    named = fingerprint_components(marked, budget)
    return marked.join(named, "fp").select(
        F.col("__id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one_per_component(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, budget: int = 4
) -> DataFrame:
    """`docs` with one row of each component: that with the smallest id; of rows that share it, one by the hash of its text.

    Rows without an id stay only if their whole component has none, and then one of them. All columns stay. Fingerprints
    travel with a key of id and text, and only the rows' keys are compared; equal rows are told apart at the end.
    """
    key = fresh(docs, "__key")
    keyed = docs.withColumn(key, F.base64(row_key(id_col, text_col)))
    width = 24  # characters of a key
    named = keyed.select(F.concat(key, F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("both"), F.col(text_col).alias("t"))
    marked = with_fingerprints(named, "both", "t", words)
    name = F.substring("both", width + 1, 64)
    marked = marked.select(
        F.substring("both", 1, width).alias("key"),
        F.when(name != "", name).cast(docs.schema[id_col].dataType).alias("__id"),
        "fp",
    )
    marked = stored(marked, "fingerprints")
    found = marked.join(fingerprint_components(marked, budget), "fp").filter(F.col("__id").eqNullSafe(F.col("component_id")))
    first = found.groupBy("root").agg(F.min("key").alias(key)).select(key)
    return keyed.join(first, key).dropDuplicates([key]).select(*docs.columns)
