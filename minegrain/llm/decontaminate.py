"""Benchmark decontamination with suffix arrays over the training text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minegrain.llm.common import fresh, row_key, stored

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
# Words of one suffix-array shard; a longer document is a shard of its own.
SHARD_WORDS = 2_000_000
# Bytes of benchmark text that are sent to the tasks at once; more text goes in further blocks.
BLOCK_BYTES = 16_000_000
# Keys of contaminated texts that are sent to every task, 24 bytes each; more of them are joined by key.
BROADCAST_ROWS = 200_000


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").translate(_LOWER))


class TestSide:
    """Windows of the benchmark: vocabulary, and windows as rows of word numbers (from 1), zero-padded to the width."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str | None]], width: int) -> None:
        self.width = width
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        self.vocabulary: dict[str, int] = {}
        seen: dict[tuple[int, ...], set[int]] = {}
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if ids:
                for at in range(max(1, len(ids) - width + 1)):
                    seen.setdefault(tuple(ids[at : at + width]), set()).add(number[name])
        windows = sorted(seen)
        self.owners = [sorted(seen[w]) for w in windows]
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.rows = np.zeros((len(windows), width), np.uint32)
        for i, w in enumerate(windows):
            self.rows[i, : len(w)] = w


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort like the rows."""
    rows = np.ascontiguousarray(rows.astype(">u4"))
    return rows.view(f"S{rows.shape[1] * 4}").ravel()


class SuffixShard:
    """The sorted suffixes of a run of documents, cut at `width` words: those that a test window may start.

    ids holds the word numbers, 0 for words outside the test vocabulary and after each document. A suffix whose run of known
    words is shorter than the shortest window cannot match and is left out.
    """

    def __init__(self, ids: np.ndarray, width: int, shortest: int) -> None:
        stop = np.append(np.flatnonzero(ids == 0), len(ids))
        run = stop[np.searchsorted(stop, np.arange(len(ids)))] - np.arange(len(ids))
        self.at = np.flatnonzero(run >= shortest)
        padded = np.concatenate((ids, np.zeros(width, ids.dtype)))
        rows = padded[self.at[:, None] + np.arange(width)] if len(self.at) else np.zeros((0, width), np.uint32)
        rows[np.arange(width) >= run[self.at][:, None]] = 0
        keys = _keys(rows)
        order = np.argsort(keys, kind="stable")
        self.at, self.keys = self.at[order], keys[order]

    def ranges(self, test: TestSide) -> tuple[np.ndarray, np.ndarray]:
        """For each test window the range of suffixes that begin with it, by binary search."""
        low = np.searchsorted(self.keys, _keys(test.rows), "left")
        top = test.rows.copy()
        top[np.arange(test.width) >= test.lengths[:, None]] = np.uint32(0xFFFFFFFF)
        return low, np.searchsorted(self.keys, _keys(top), "right")


def longest_matches(ids: np.ndarray, tests: list[np.ndarray]) -> list[tuple[int, int, int]]:
    """(start in the test, length, start in ids) of the longest verbatim match of each test's suffixes.

    Each test suffix is searched in the suffix array of `ids`; its longest match is at one of the two neighbours.
    """
    out = []
    n = max([len(t) for t in tests], default=0)
    if not n:
        return [(0, 0, 0) for _ in tests]
    shard = SuffixShard(ids, n, 1)
    for t in tests:
        best = (0, 0, 0)
        rows = np.zeros((len(t), n), np.uint32)
        for s in range(len(t)):
            rows[s, : len(t) - s] = t[s:]
        place = np.searchsorted(shard.keys, _keys(rows)) if len(t) else []
        for s, p in enumerate(place):
            for q in (p - 1, p):
                if 0 <= q < len(shard.at):
                    other = ids[shard.at[q] : shard.at[q] + len(t) - s]
                    same = other == t[s : s + len(other)]
                    length = int(np.argmin(np.append(same, False)))
                    if length > best[1]:
                        best = (s, length, int(shard.at[q]))
        out.append(best)
    return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> list[DataFrame]:
    """The benchmark in blocks below BLOCK_BYTES, by the hash of the item id; one block as a rule."""
    b = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"), F.col(text_col).cast("string").alias("text")
    )
    size = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 if size <= BLOCK_BYTES else -(-2 * size // BLOCK_BYTES)
    if n == 1:
        return [b]
    b = stored(b, "benchmark")
    return [b.filter(F.pmod(F.xxhash64("name"), F.lit(n)) == i) for i in range(n)]


def _hits(docs: DataFrame, spark: SparkSession, items: list[tuple[str, str | None]], width: int, spans: bool) -> DataFrame:
    """(__key, n_words, n_hit, names[, spans]) per document against one block of the benchmark."""
    sent = spark.sparkContext.broadcast(vars(TestSide(items, width)))  # below BLOCK_BYTES of text

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        side = SimpleNamespace(**sent.value)
        get = side.vocabulary.get
        shortest = int(side.lengths.min()) if len(side.lengths) else 1

        def search(keys: list, lots: list[np.ndarray]) -> pd.DataFrame:
            counts = np.array([len(x) for x in lots], np.int64)
            gap = np.zeros(1, np.uint32)
            ids = np.concatenate([part for x in lots for part in (x, gap)])
            starts = np.concatenate(([0], np.cumsum(counts + 1)[:-1]))
            hit = np.zeros(len(ids) + 1, np.int64)
            names: list[set[int]] = [set() for _ in lots]
            if len(side.lengths):
                shard = SuffixShard(ids, side.width, shortest)
                low, high = shard.ranges(side)
                for w in np.flatnonzero(high > low):
                    at = shard.at[low[w] : high[w]]
                    np.add.at(hit, at, 1)
                    np.add.at(hit, at + side.lengths[w], -1)
                    for d in np.unique(np.searchsorted(starts, at, "right") - 1):
                        names[d].update(side.owners[w])
            covered = (np.cumsum(hit)[:-1] > 0).astype(np.int64)
            n_hit = np.add.reduceat(covered, starts)
            frame = {
                "__key": keys,
                "n_words": counts,
                "n_hit": n_hit,
                "names": [sorted(side.names[i] for i in s) for s in names],
            }
            if spans:
                frame["spans"] = [_runs(covered[s : s + n]) for s, n in zip(starts, counts)]
            return pd.DataFrame(frame)

        keys, lots, size = [], [], 0
        for b in batches:
            for key, text in zip(b["__key"], b["__text"]):
                lots.append(np.array([get(w, 0) for w in words_of(text)], np.uint32))
                keys.append(key)
                size += len(lots[-1])
                if size >= SHARD_WORDS:
                    yield search(keys, lots)
                    keys, lots, size = [], [], 0
        if keys:
            yield search(keys, lots)

    kind = docs.schema["__key"].dataType.simpleString()
    schema = f"__key {kind}, n_words long, n_hit long, names array<string>"
    return docs.mapInPandas(run, schema + (", spans array<struct<start:int,stop:int>>" if spans else ""))


def _runs(covered: np.ndarray) -> list[dict[str, int]]:
    edge = np.diff(np.concatenate(([0], covered, [0])))
    return [{"start": int(a), "stop": int(b)} for a, b in zip(np.flatnonzero(edge > 0), np.flatnonzero(edge < 0))]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    width: int = 13,
) -> DataFrame:
    """Per row: id, n_words, n_hit, n_items, items (sorted as strings), items_sha256, contaminated.

    A window is `width` consecutive words of an item; an item of fewer words, but not none, is one window. Tasks build
    suffix arrays over shards of their documents and search every test window there; a document word inside any occurrence
    is hit. A document is contaminated if hits reach a twentieth of its words. Documents are not shuffled. A benchmark above
    BLOCK_BYTES goes against all documents block by block; the hits of the blocks are then joined as word spans per row.

    Null and wordless texts have no words and no hits. Items without text have no window; a null item id counts as the empty
    string; repeated items count once. Repeated documents give repeated rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).cast("string").alias("__id"), F.col(text_col).cast("string").alias("__text"))
    blocks = _blocks(benchmark, item_col, item_text)
    if len(blocks) == 1:
        items = [(r[0], r[1]) for r in blocks[0].collect()]  # below BLOCK_BYTES
        found = _hits(narrow.withColumnRenamed("__id", "__key"), spark, items, width, False)
        found = found.withColumnRenamed("__key", "__id")
    else:
        keyed = narrow.withColumn("__key", F.base64(row_key("__id", "__text")))
        rows = stored(keyed.select("__key", "__id"), "rows")
        parts = []
        for block in blocks:
            items = [(r[0], r[1]) for r in block.collect()]  # below BLOCK_BYTES
            part = _hits(keyed.select("__key", "__text").dropDuplicates(["__key"]), spark, items, width, True)
            parts.append(stored(part, "block-hits"))
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        cells = every.select("__key", F.explode("spans").alias("s")).select(
            "__key", F.explode(F.sequence(F.col("s.start"), F.col("s.stop") - 1)).alias("w")
        )
        hits = cells.distinct().groupBy("__key").agg(F.count(F.lit(1)).alias("n_hit"))
        named = every.select("__key", F.explode("names").alias("name")).distinct()
        named = named.groupBy("__key").agg(F.array_sort(F.collect_list("name")).alias("names"))
        total = parts[0].select("__key", "n_words")
        found = (
            rows.join(total, "__key")
            .join(hits, "__key", "left")
            .join(named, "__key", "left")
            .withColumn("n_hit", F.coalesce("n_hit", F.lit(0)))
            .withColumn("names", F.coalesce("names", F.array().cast("array<string>")))
        )
    return found.select(
        F.col("__id").cast(kind).alias(id_col),
        "n_words",
        F.col("n_hit").cast("long").alias("n_hit"),
        F.size("names").cast("long").alias("n_items"),
        F.col("names").alias("items"),
        F.sha2(F.array_join("names", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` without the rows that `contamination` finds contaminated; all columns stay. Equal texts share their verdict."""
    key = fresh(docs, "__key")
    keyed = docs.withColumn(key, F.base64(row_key(text_col)))
    found = contamination(keyed, benchmark, key, text_col).filter("contaminated").select(key).distinct()
    found = stored(found, "contaminated")
    found = F.broadcast(found) if found.count() <= BROADCAST_ROWS else found
    return keyed.join(found, key, "left_anti").select(*docs.columns)
