"""Ranked lexical search: documents of an item are grouped by the mask of its terms that they hold."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from minegrain.llm.common import lower_ascii, stored
from minegrain.runtime import broadcast_if_small

# A term: digits, letters and everything outside ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256)).lower()
# Bytes of the items' terms that are looked up in one pass over the documents; more of them take further passes.
BLOCK_BYTES = 16_000_000
# Lots by which the best documents of the tasks are reduced before those of an item meet.
_LOTS = 64
_SLICE_BYTES = 4_000_000
_FIRST_LOT = 256


def _slices(raw: bytes) -> Iterator[bytes]:
    """A folded text in parts of some _SLICE_BYTES, cut between terms."""
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + _SLICE_BYTES)
        end = len(raw) if end < 0 else end
        yield raw[at:end]
        at = end


def _postings(sent):
    """(doc_id, n, terms, tf) of each document with a term: its number of terms, and those of the items with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value
        for batch in batches:
            n, terms, counts, lengths, kept = [], [], [], [], []
            for row, text in enumerate(batch.column("text").cast(pa.binary())):
                size, found = 0, []
                for part in _slices(text.as_py().translate(_FOLD)):
                    words = part.split()
                    size += len(words)
                    at = np.fromiter((number.get(w, -1) for w in words), np.int32, len(words))
                    found.append(at[at >= 0])
                if size:
                    different, tf = np.unique(np.concatenate(found), return_counts=True)
                    kept.append(row)
                    n.append(size)
                    terms.append(different)
                    counts.append(tf)
                    lengths.append(len(different))
            if not kept:
                continue
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x), pa.int32())) for x in (terms, counts)]
            ids = batch.column("doc_id").take(pa.array(kept))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tf"])

    return run


class _Best:
    """The k best documents of an item so far: highest score, then lowest id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.null = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self) -> int:
        """A score that a further document must reach."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        keep = scores >= self.least()
        scores, ids, null = (np.concatenate([old, new[keep]]) for old, new in ((self.scores, scores), (self.ids, ids), (self.null, null)))
        order = np.lexsort((ids, null, -scores))[: self.k]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]


def _masks(terms: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(words x masks, mask of each document): a bit for each of an item's terms, set for the documents that hold it."""
    words = np.zeros((-(-len(terms) // 64), size), np.uint64)
    for i, docs in enumerate(terms):
        words[i // 64][docs] |= np.uint64(1 << (i % 64))
    code = np.zeros(size, np.int64)
    for w in words:
        code = pd.factorize(w)[0].astype(np.int64) + code * size
        code = pd.factorize(code)[0].astype(np.int64)
    first = np.zeros(int(code.max()) + 1, np.int64)
    first[code[::-1]] = np.arange(size)[::-1]
    return words[:, first], code


def _rank_batch(best: _Best, terms: list[np.ndarray], parts: list[np.ndarray], ids: np.ndarray, null: np.ndarray) -> int:
    """Adds the best documents of a batch; the documents looked at.

    The mask of a document bounds its score by the sum of the highest parts of its terms. Masks are evaluated by falling
    bound, until the next one is below the score that a document must reach.
    """
    masks, code = _masks(terms, len(ids))
    bound = np.zeros(masks.shape[1], np.int64)
    for i, part in enumerate(parts):
        bound += ((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).astype(np.int64) * part.max()
    reach = bound[code]
    order = np.argsort(-reach, kind="stable")
    reach = reach[order]
    at, lot = 0, _FIRST_LOT
    while at < len(order) and reach[at] >= best.least():
        end = min(at + lot, int(np.searchsorted(-reach, -best.least(), "right")))
        docs = order[at:end]
        scores = np.zeros(len(docs), np.int64)
        for held, part in zip(terms, parts, strict=True):
            place = np.minimum(np.searchsorted(held, docs), len(held) - 1)
            scores += np.where(held[place] == docs, part[place], 0)
        best.add(scores, ids[docs], null[docs])
        at, lot = end, lot * 2
    return at


def _best_documents(sent, k: int):
    """(item, doc_id, score): the k best documents of a task for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = sent.value
        best = [_Best(k) for _ in items]
        for batch in batches:
            lists = batch.column("terms")
            term = lists.flatten().to_numpy()
            doc = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            tf = batch.column("tf").flatten().to_numpy().astype(np.int64)
            m = batch.column("m").to_numpy()
            part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
            order = np.argsort(term, kind="stable")
            term, doc, part = term[order], doc[order], part[order]
            cuts = np.searchsorted(term, np.arange(len(weight) + 1))
            column = batch.column("doc_id")
            null = column.is_null().to_numpy(zero_copy_only=False)
            ids = column.fill_null(0).to_numpy()
            for own, of in zip(best, items, strict=True):
                held = [t for t in of if cuts[t] < cuts[t + 1]]
                if held:
                    spans = [slice(cuts[t], cuts[t + 1]) for t in held]
                    _rank_batch(own, [doc[s] for s in spans], [part[s] for s in spans], ids, null)
        sizes = [len(b.ids) for b in best]
        out = [np.concatenate([getattr(b, c) for b in best]) if best else np.zeros(0) for c in ("ids", "null", "scores")]
        item = pa.array(np.repeat(np.arange(len(best)), sizes), pa.int32())
        ids = pa.array(out[0].astype(np.int64), mask=out[1].astype(bool))
        yield pa.RecordBatch.from_arrays([item, ids, pa.array(out[2].astype(np.int64))], ["item", "doc_id", "score"])

    return run


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item its k documents of highest score above 0, equal scores by id.

    A term's weight follows from the documents that hold it; a document adds, for each of the item's terms, its weight times
    a part that grows with the term's occurrences and falls with the document's length. Weights come from all documents.
    Tasks write the counts of the items' terms once, rank their documents and hand over k an item; those meet in lots.

    Null texts hold no term; items without a term have no row. Rows that share an item id are one item with all their terms,
    those without an id as well. Every row of documents ranks by itself, repeated ones too; documents without an id come last
    among equal scores. Empty tables give an empty result; other columns, whatever their names, are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = F.regexp_extract_all(lower_ascii(F.coalesce(F.col(item_text_col), F.lit(""))), F.lit(TERM), F.lit(0))
    wanted = items.select(F.col(item_col).alias("item_id"), F.explode(words).alias("term")).distinct()
    wanted = wanted.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms"))  # terms of one item
    wanted = stored(wanted.withColumn("bytes", F.expr("aggregate(terms, 0L, (s, t) -> s + octet_length(t) + 16)")), "item-terms")
    total = wanted.agg(F.sum("bytes")).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    best = None
    for block in range(blocks):
        own = wanted.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        rows = own.select("item_id", "terms").collect()  # a block
        terms = sorted({t for r in rows for t in r.terms})
        number = {t.encode(): i for i, t in enumerate(terms)}
        held = [[number[t.encode()] for t in ts] for ts in (r.terms for r in rows)]
        looked_up = spark.sparkContext.broadcast(number)
        found = texts.mapInArrow(_postings(looked_up), "doc_id bigint, n bigint, terms array<int>, tf array<int>")
        found = stored(found, "postings")
        size = found.agg(F.count(F.lit(1)), F.sum("n")).first()
        n_docs, n_terms = size[0], size[1] or 1
        df = np.zeros(len(terms), np.int64)
        for t, c in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row per term of the block
            df[t] = c
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        sent = spark.sparkContext.broadcast((held, weight))
        length = F.lit(50).cast("decimal(2,0)") * F.col("n").cast("decimal(18,0)") * F.lit(n_docs).cast("decimal(18,0)")
        measured = found.withColumn("up", length).withColumn("down", F.lit(n_terms).cast("decimal(20,0)"))
        measured = measured.select("doc_id", "terms", "tf", F.expr("50 + (up div down)").cast("long").alias("m"))
        ranked = measured.mapInArrow(_best_documents(sent, k), "item int, doc_id bigint, score bigint")
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        lots = W.partitionBy("item", "lot").orderBy(*order)
        ranked = ranked.withColumn("lot", F.pmod(F.xxhash64("doc_id"), F.lit(_LOTS)))
        ranked = ranked.withColumn("r", F.row_number().over(lots)).filter(F.col("r") <= k)
        ranked = ranked.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"item int, item_id {dict(wanted.dtypes)['item_id']}")
        ranked = ranked.join(broadcast_if_small(names), "item").select("item_id", "rank", "doc_id", "score")
        best = ranked if best is None else best.unionByName(ranked)
    return best
