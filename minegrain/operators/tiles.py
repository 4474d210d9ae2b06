"""Products of sparse matrices by tiles.

Rows are hashed into blocks and the shared dimension into stripes, so a tile holds a bounded number of cells however
skewed the data is: (row, inner) is unique, a hot row is cut by stripes and a hot inner key by blocks. Tiles are packed
into arrays, paired by block and stripe, and multiplied in memory; only summed cells leave a task, never the
products of one inner key.

Tiles reach their partners in one of two ways, whichever is counted to move fewer cells: whole to every partner block, or cut
to the inner keys that both blocks have. With sparse rows the second one moves a cell as often as blocks share its key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minegrain.runtime import broadcast_if_small, cut_lineage

BLOCK_ROWS = (512, 4096)
TILE_CELLS = 500_000
# Block count from which the ways to the partners are counted, and the advantage at which tiles are cut to shared keys:
# whole tiles are packed once, cut ones for each partner.
COUNTED_BLOCKS, CUT_ADVANTAGE = 8, 4
# Most rows of an inner key whose products may be listed one by one.
LISTED_ROWS = 2_000
_CHUNK_PRODUCTS = 4_000_000


def _place(m: DataFrame, block_rows: int | None, tile_cells: int) -> tuple[DataFrame, int, bool]:
    """Cells with their block, stripe and the block's stripe count (a power of two); the block count; any stripes?"""
    m = cut_lineage(m)
    n_rows = m.select("row").distinct().count()
    blocks = _block_count(n_rows, block_rows)
    cells = m.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    load = cells.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    power = F.greatest(F.lit(0.0), F.ceil(F.log2(F.col("n") / float(tile_cells))).cast("double"))
    load = load.select("block", F.pow(F.lit(2.0), power).cast("int").alias("stripes"))
    most = load.agg(F.max("stripes")).first()[0] or 1
    if most == 1:
        return cells.withColumn("stripes", F.lit(1)).withColumn("stripe", F.lit(0)), blocks, False
    placed = cells.join(load, "block")
    return placed.withColumn("stripe", F.pmod(F.xxhash64("inner"), F.col("stripes")).cast("int")), blocks, True


def _pack(placed: DataFrame, keys: tuple[str, ...] = ("block", "stripe", "stripes"), end: str = "") -> DataFrame:
    """One row per tile with its cells as arrays, which get names that end in `end`; a tile is bounded by the placement."""
    names = {"row": "rows", "inner": "inners", "value": "vals", "length": "lengths"}
    own = [c for c in names if c in placed.columns]
    tiles = placed.groupBy(*keys).agg(F.collect_list(F.struct(*own)).alias("t"))
    return tiles.select(*keys, *[F.col(f"t.{c}").alias(names[c] + end) for c in own])


def _multiply(ra, ca, va, rb, cb, vb) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Non-zero cells of the product of two tiles over their common inner keys."""
    ids_a, ia = np.unique(ra, return_inverse=True)
    ids_b, ib = np.unique(rb, return_inverse=True)
    oa, ob = np.argsort(ca, kind="stable"), np.argsort(cb, kind="stable")
    ia, va, ib, vb = ia[oa], va[oa], ib[ob], vb[ob]
    keys_a, start_a, n_a = np.unique(ca[oa], return_index=True, return_counts=True)
    keys_b, start_b, n_b = np.unique(cb[ob], return_index=True, return_counts=True)
    _, pa, pb = np.intersect1d(keys_a, keys_b, assume_unique=True, return_indices=True)
    start_a, n_a, start_b, n_b = start_a[pa], n_a[pa], start_b[pb], n_b[pb]
    shape = (len(ids_a), len(ids_b))
    total = np.zeros(shape[0] * shape[1])
    seen = np.zeros(shape[0] * shape[1], dtype=bool)
    products = n_a * n_b
    lot = np.cumsum(products) // _CHUNK_PRODUCTS
    for cut in np.unique(lot):
        pick = lot == cut
        count_a, count_b = n_a[pick], n_b[pick]
        # Positions of the left cells of these inner keys, each repeated for every right cell of its key.
        left = np.repeat(start_a[pick] - np.cumsum(count_a) + count_a, count_a) + np.arange(count_a.sum())
        width = np.repeat(count_b, count_a)
        base = np.repeat(start_b[pick], count_a)
        left_rep = np.repeat(left, width)
        right = np.repeat(base - np.cumsum(width) + width, width) + np.arange(width.sum())
        cell = ia[left_rep].astype(np.int64) * shape[1] + ib[right]
        total += np.bincount(cell, weights=va[left_rep] * vb[right], minlength=len(total))
        seen[cell] = True
    hit = np.flatnonzero(seen & (np.abs(total) > 0))
    return ids_a[hit // shape[1]], ids_b[hit % shape[1]], total[hit]


def _lengths(rows: np.ndarray, vals: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Euclidean lengths of the rows `of` of a tile that holds all of their cells."""
    ids, at = np.unique(rows, return_inverse=True)
    return np.sqrt(np.bincount(at, weights=vals * vals))[np.searchsorted(ids, of)]


def _product_batches(symmetric: bool, cosine: bool = False):
    """Products of tile pairs; with `cosine`, of tiles that are not striped, divided by the lengths of both rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for t in pdf.itertuples(index=False):
                left, right, value = _multiply(t.rows, t.inners, t.vals, t.rows_r, t.inners_r, t.vals_r)
                if cosine:
                    value = value / (_lengths(t.rows, t.vals, left) * _lengths(t.rows_r, t.vals_r, right))
                if symmetric:
                    keep = left < right if t.block == t.block_r else np.ones(len(left), dtype=bool)
                    left, right, value = left[keep], right[keep], value[keep]
                    left, right = np.minimum(left, right), np.maximum(left, right)
                yield pd.DataFrame({"left": left, "right": right, "value": value})

    return run


def _rank_products(k: int, digits: int):
    """From the products of a block pair: per row its k best positive and k best negative partners, and how many there were.

    A pair of rows meets in one block pair only, so the best k of a row are among the best k of its block pairs.
    """

    def run(left: np.ndarray, right: np.ndarray, value: np.ndarray) -> pd.DataFrame:
        row, partner, value = np.concatenate([left, right]), np.concatenate([right, left]), np.tile(value, 2)
        level = np.round(value, digits)
        order = np.lexsort((partner, -level, value < 0, row))
        row, partner, value, negative = row[order], partner[order], value[order], (value < 0)[order]
        fresh = np.ones(len(row), dtype=bool)
        fresh[1:] = (row[1:] != row[:-1]) | (negative[1:] != negative[:-1])
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(row)), 0))
        best = np.arange(len(row)) - start < k
        ids, at = np.unique(row, return_inverse=True)
        n_neg = np.bincount(at, weights=negative, minlength=len(ids))
        total = np.bincount(at, minlength=len(ids))
        n = int(best.sum())
        return pd.DataFrame(
            {
                "row": np.concatenate([row[best], ids]).astype(np.int64),
                "neighbour": pd.array(np.concatenate([partner[best], np.full(len(ids), -1)]), dtype="int64"),
                "sim": np.concatenate([value[best], np.zeros(len(ids))]),
                "counted": np.concatenate([np.zeros(n, dtype=bool), np.ones(len(ids), dtype=bool)]),
                "n_pos": np.concatenate([np.zeros(n), total - n_neg]).astype(np.int64),
                "n_neg": np.concatenate([np.zeros(n), n_neg]).astype(np.int64),
            }
        )

    return run


def _best_batches(k: int, digits: int, cosine: bool):
    """The best partners from symmetric tile pairs that are not striped."""
    products, best = _product_batches(True, cosine), _rank_products(k, digits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cells in products(batches):
            yield best(*(cells[c].to_numpy() for c in ("left", "right", "value")))

    return run


def _packed_products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(block, block_r, left, right, value, scale): the products of one symmetric tile pair as one row; scale is the product
    of the lengths of both rows, or 1."""
    for pdf in batches:
        for t in pdf.itertuples(index=False):
            left, right, value = _multiply(t.rows, t.inners, t.vals, t.rows_r, t.inners_r, t.vals_r)
            keep = left < right if t.block == t.block_r else np.ones(len(left), dtype=bool)
            left, right, value = left[keep], right[keep], value[keep]
            scale = np.ones(len(left))
            if hasattr(t, "lengths"):
                for of, rows, lengths in ((left, t.rows, t.lengths), (right, t.rows_r, t.lengths_r)):
                    ids, at = np.unique(rows, return_index=True)
                    scale = scale * np.asarray(lengths)[at][np.searchsorted(ids, of)]
            yield pd.DataFrame(
                {"block": [t.block], "block_r": [t.block_r], "left": [left], "right": [right], "value": [value], "scale": [scale]}
            )


def _best_of_sums(k: int, digits: int):
    """The best partners of the rows of a block pair, from the partial products of its stripes."""
    best = _rank_products(k, digits)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right, value, scale = (np.concatenate(pdf[c].to_list()) for c in ("left", "right", "value", "scale"))
        order = np.lexsort((right, left))
        left, right, value, scale = left[order], right[order], value[order], scale[order]
        first = np.ones(len(left), dtype=bool)
        first[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        start = np.flatnonzero(first)
        value = np.add.reduceat(value, start) if len(start) else value
        left, right, scale = left[start], right[start], scale[start]
        some = value != 0
        return best(np.minimum(left, right)[some], np.maximum(left, right)[some], value[some] / scale[some])

    return run


_BEST = "row bigint, neighbour bigint, sim double, counted boolean, n_pos bigint, n_neg bigint"


def tiled_best(m: DataFrame, k: int, digits: int, cosine: bool, block_rows: int | None = None) -> DataFrame:
    """Candidates for the k nearest rows of a matrix (row, inner, value) by dot product or cosine, in one pass over its tiles.

    Rows (row, neighbour, sim) with counted = false, and rows with counted = true that carry the numbers n_pos, n_neg of
    partners by sign. Where a hot row forces stripes, a pair's sum is spread over several tile pairs: their products, packed
    per tile pair, meet in one group for each pair of (smaller) blocks. Similar pairs are never listed.
    """
    work, striped = _tile_pairs(m, None, block_rows, TILE_CELLS)
    if not striped:
        return work.mapInPandas(_best_batches(k, digits, cosine), _BEST)
    if cosine:
        length = m.groupBy("row").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("length"))
        m = m.join(broadcast_if_small(length), "row")
    work, _ = _tile_pairs(m, None, min(block_rows or BLOCK_ROWS[0], BLOCK_ROWS[0]), TILE_CELLS)
    schema = "block int, block_r int, left array<bigint>, right array<bigint>, value array<double>, scale array<double>"
    parts = work.mapInPandas(_packed_products, schema)
    return parts.groupBy("block", "block_r").applyInPandas(_best_of_sums(k, digits), _BEST)


def tiled_product(
    left: DataFrame,
    right: DataFrame | None = None,
    block_rows: int | None = None,
    tile_cells: int = TILE_CELLS,
) -> DataFrame:
    """(left, right, value): sums over `inner` of left.value * right.value for frames (row, inner, value).

    Without a right side: the product of the matrix with its own transpose, each unordered pair of distinct rows once
    (left < right). Only sums that are exactly 0 are left out.
    """
    if right is None:
        left = cut_lineage(left)
        if _listing_moves_less(left, block_rows):
            return _listed_products(left)
    work, striped = _tile_pairs(left, right, block_rows, tile_cells)
    cells = work.mapInPandas(_product_batches(right is None), "left bigint, right bigint, value double")
    if striped:  # otherwise each pair of rows comes from one tile pair and its sum is final
        cells = cells.groupBy("left", "right").agg(F.sum("value").alias("value"))
    return cells.filter("value <> 0")


def _block_count(n_rows: int, block_rows: int | None) -> int:
    if block_rows is None:  # small blocks for parallelism, large ones so that tiles are sent to fewer partners
        block_rows = min(max(n_rows // 64, BLOCK_ROWS[0]), BLOCK_ROWS[1])
    return max(1, -(-n_rows // block_rows))


def _listing_moves_less(m: DataFrame, block_rows: int | None) -> bool:
    """Whether the products of all inner keys are fewer rows than the cells that tiles would move, and no key is hot."""
    blocks = _block_count(m.select("row").distinct().count(), block_rows)
    if blocks < COUNTED_BLOCKS:
        return False
    n = m.groupBy("inner").agg(F.count(F.lit(1)).cast("double").alias("n"))
    cells, products, most = n.agg(F.sum("n"), F.sum(F.col("n") * (F.col("n") - 1) / 2), F.max("n")).first()
    return cells is not None and most <= LISTED_ROWS and products <= cells * (blocks + 1) / 2


def _listed_products(m: DataFrame) -> DataFrame:
    """The product of a sparse matrix with its transpose from one row for each pair of cells of an inner key."""
    m = m.select(F.col("row").cast("bigint"), F.col("inner").cast("bigint"), F.col("value").cast("double"))
    a = m.select("inner", F.col("row").alias("left"), F.col("value").alias("a"))
    b = m.select("inner", F.col("row").alias("right"), F.col("value").alias("b")).hint("merge")
    pairs = a.join(b, "inner").filter("left < right")
    summed = pairs.groupBy("left", "right").agg(F.sum(F.col("a") * F.col("b")).alias("value"))
    return summed.filter("value <> 0")


def _tile_pairs(
    left: DataFrame, right: DataFrame | None, block_rows: int | None, tile_cells: int
) -> tuple[DataFrame, bool]:
    """One row per pair of tiles that can share inner keys, with both tiles' arrays; and whether blocks are striped."""
    symmetric = right is None
    cast = lambda m: m.select(
        F.col("row").cast("bigint"), F.col("inner").cast("bigint"), F.col("value").cast("double"), *[c for c in m.columns if c == "length"]
    )
    placed_l, blocks, striped = _place(cast(left), block_rows, tile_cells)
    placed_r = placed_l
    if not symmetric:
        placed_r, blocks, striped_r = _place(cast(right), block_rows, tile_cells)
        striped = striped or striped_r
    if blocks >= COUNTED_BLOCKS and _cutting_moves_less(placed_l, None if symmetric else placed_r, blocks):
        work = _cut_to_shared(placed_l, placed_r, symmetric)
    else:
        work = _sent_whole(placed_l, placed_r, symmetric, blocks, striped)
    return work, striped


def _cutting_moves_less(left: DataFrame, right: DataFrame | None, blocks: int) -> bool:
    """Whether fewer cells move if a cell goes to every block that has its inner key, which are no more than the key's rows."""
    n = left.groupBy("inner").agg(F.count(F.lit(1)).alias("n")).withColumn("m", F.col("n"))
    if right is not None:
        n = n.drop("m").join(right.groupBy("inner").agg(F.count(F.lit(1)).alias("m")), "inner", "left").fillna(0, "m")
    cells, shared = n.agg(F.sum("n"), F.sum(F.col("n") * F.least("m", F.lit(blocks)))).first()
    return cells is not None and shared * CUT_ADVANTAGE < cells * blocks


def _cut_to_shared(left: DataFrame, right: DataFrame, symmetric: bool) -> DataFrame:
    """Tile pairs whose tiles hold the inner keys that both blocks have; blocks without a common key do not meet.

    A hot key is one row of the lists of blocks, and its cells are spread by their partner blocks.
    """

    def holders(m: DataFrame, end: str) -> DataFrame:
        held = m.select("inner", F.struct(F.col("block").alias("b"), F.col("stripes").alias("s")).alias("h")).distinct()
        return held.groupBy("inner").agg(F.collect_list("h").alias(end))

    def sent(m: DataFrame, partners: DataFrame, keep, names: tuple[str, str], end: str) -> DataFrame:
        own, other = names
        cells = m.join(partners, "inner").withColumn("p", F.explode(F.filter("partners", keep)))
        cells = cells.withColumn("stripe", F.pmod(F.xxhash64("inner"), F.greatest("stripes", "p.s")).cast("int"))
        cells = cells.withColumn("__own", F.col("block")).drop("block")
        cells = cells.withColumn(own, F.col("__own")).withColumn(other, F.col("p.b"))
        return _pack(cells, ("block", "block_r", "stripe"), end)

    later = (lambda h: h["b"] >= F.col("block")) if symmetric else (lambda h: F.lit(True))
    earlier = (lambda h: h["b"] <= F.col("block")) if symmetric else (lambda h: F.lit(True))
    a = sent(left, holders(right, "partners"), later, ("block", "block_r"), "")
    b = sent(right, holders(left, "partners"), earlier, ("block_r", "block"), "_r")
    return a.join(b, ["block", "block_r", "stripe"]).drop("stripe")


def _sent_whole(left: DataFrame, right: DataFrame, symmetric: bool, blocks: int, striped: bool) -> DataFrame:
    """Every left tile goes to each right block; there it meets the stripes that can share inner keys with it."""
    partner = F.sequence(F.col("block") if symmetric else F.lit(0), F.lit(blocks - 1))
    sent = _pack(left).withColumn("block_r", F.explode(partner))
    if striped:
        head = right.select(
            F.col("block").alias("block_r"), F.col("stripe").alias("stripe_r"), F.col("stripes").alias("stripes_r")
        ).distinct()
        shared = F.least("stripes", "stripes_r")
        sent = sent.join(head, "block_r").filter(F.pmod("stripe", shared) == F.pmod("stripe_r", shared)).drop("stripes_r")
    else:
        sent = sent.withColumn("stripe_r", F.lit(0))
    tiles = _pack(right, end="_r").withColumnsRenamed({"block": "block_r", "stripe": "stripe_r"}).drop("stripes")
    return sent.join(tiles, ["block_r", "stripe_r"]).drop("stripe", "stripe_r", "stripes")
