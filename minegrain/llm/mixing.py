"""Mixing of sources to target weights by whole copies and Pareto order samples."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from minegrain.functions.ordering import with_row_index
from minegrain.functions.vectors import seeded_uniform
from minegrain.llm.common import fresh, stored
from minegrain.runtime import broadcast_if_small

# Weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)
# Most copies of a document.
COPIES = 3
# Steps of the search for the place where a source's sample ends: each tells 2^12 places apart.
_DIGIT_BITS, _DIGITS = 12, 2
# Documents behind that place which may fill what is left of the target.
LOOK_AHEAD = 1024
_LOTS = 64


def water_levels(rows: DataFrame, group: str, share: str, most: str, total: str) -> DataFrame:
    """(group, capped, open_share): per group, what its rows at their `most` hold together and the shares of the others.

    Each row gets (total - capped) / open_share times its share, or `most` if that is less. Rows above it are put at it and
    what they leave goes to the others by share, until none is above: one aggregate per round.
    """
    rows = stored(rows.select(group, share, most, total), "shares")
    levels = None
    while True:
        full = F.lit(False) if levels is None else full_at(F.col(share), F.col(most), F.col(total))
        joined = rows if levels is None else rows.join(broadcast_if_small(levels), group)
        new = joined.groupBy(group).agg(
            F.sum(F.when(full, F.col(most)).otherwise(F.lit(0))).cast("double").alias("capped"),
            F.sum(F.when(full, F.lit(0)).otherwise(F.col(share))).cast("double").alias("open_share"),
            F.count_if(full).alias("n_full"),
        )
        new = stored(new, "levels")
        seen = new.agg(F.sum("n_full")).first()[0] or 0
        if levels is not None and seen == before:
            return new.drop("n_full")
        levels, before = new.drop("n_full"), seen


def full_at(share, most, total):
    """Whether a row is not below its `most` at the level of its group's columns `capped` and `open_share`."""
    above = (F.col("open_share") <= 0) | (share * (total - F.col("capped")) >= most * F.col("open_share"))
    return (share > 0) & above


def amount_at(share, most, total):
    level = F.when(F.col("open_share") > 0, share * (total - F.col("capped")) / F.col("open_share")).otherwise(F.lit(0.0))
    return F.when(full_at(share, most, total), most.cast("double")).otherwise(level)


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = COPIES) -> DataFrame:
    """(place, source, source_size, target) for (source, source_size): all words, shared by weight, at most `copies` times a source."""
    order = [F.col("source").isNull(), F.col("source")]
    cycle = F.array(*[F.lit(w) for w in weights])
    rows = with_row_index(sources, order, "place").withColumn("share", F.get(cycle, F.pmod("place", F.lit(len(weights))).cast("int")))
    rows = rows.withColumn("most", copies * F.col("source_size")).withColumn("all", F.lit(0))
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    rows = stored(rows.withColumn("total", F.lit(total).cast("double")), "sources")
    levels = water_levels(rows, "all", "share", "most", "total")
    rows = rows.join(F.broadcast(levels), "all")  # one row
    return rows.select("place", "source", "source_size", amount_at(F.col("share"), F.col("most"), F.col("total")).alias("target"))


def pareto_key(u, p):
    """Random odds over inclusion odds, as a number of (0, 1) that keeps their order; the smallest are drawn."""
    odds = (u / (1.0 - u)) * ((1.0 - p) / p)
    return odds / (1.0 + odds)


def _sample_ends(able: DataFrame, group: str, room: DataFrame) -> DataFrame:
    """(group, high, rest): documents of (group, key, size) below `high` fit into `room` (group, room) together.

    What is left of the room is `rest`. Digit by digit of the key, words are added up per digit, and the search goes on in
    the digit where the room ends. The last digit's documents are not told apart here.
    """
    ends = room.select(group, F.lit(0).cast("long").alias("high"), F.col("room").alias("rest"))
    for d in range(_DIGITS):
        unit = 1 << (_DIGIT_BITS * (_DIGITS - 1 - d))
        bits = F.floor(F.col("key") * float(1 << (_DIGIT_BITS * _DIGITS))).cast("long")
        rows = able.select(group, "size", bits.alias("place")).join(broadcast_if_small(ends), group)
        inside = (F.col("place") >= F.col("high")) & (F.col("place") < F.col("high") + unit * (1 << _DIGIT_BITS))
        sums = rows.filter(inside).groupBy(group, ((F.col("place") - F.col("high")) / unit).cast("long").alias("digit"))
        sums = sums.agg(F.sum("size").alias("words"))
        # At most 2^12 rows a group.
        upto = F.sum("words").over(W.partitionBy(group).orderBy("digit").rowsBetween(W.unboundedPreceding, 0))
        sums = sums.withColumn("upto", upto).join(broadcast_if_small(ends), group)
        over = sums.filter("upto > rest").groupBy(group).agg(F.min(F.struct("digit", "words", "upto")).alias("x"))
        moved = ends.join(over, group, "left")
        # Without a digit that is over, all documents fit.
        last = F.when(F.col("x").isNull(), F.lit(1 << _DIGIT_BITS)).otherwise(F.col("x.digit"))
        fit = sums.groupBy(group).agg(F.max("upto").alias("whole"))
        moved = moved.join(fit, group, "left").select(
            group,
            (F.col("high") + last * unit).alias("high"),
            (F.col("rest") - F.coalesce(F.col("x.upto") - F.col("x.words"), "whole", F.lit(0))).alias("rest"),
        )
        ends = stored(moved, "ends")
    return ends


def _fill(pdf: pd.DataFrame) -> pd.DataFrame:
    """The documents at the end of one source's sample that it takes: in order, each that still fits; then the smallest of
    the others if that comes nearer to the room."""
    pdf = pdf.sort_values(["key", "doc_id", "size", "text_hash"], kind="stable", na_position="last")
    rest, taken, others = float(pdf["rest"].iloc[0]), [], []
    for row, size in enumerate(pdf["size"]):
        if size <= rest:
            rest -= size
            taken.append(row)
        else:
            others.append((size, row))
    if others and min(others)[0] < 2 * rest:
        taken.append(min(others)[1])
    return pdf.iloc[taken][["row"]]


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight_col: str | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    copies: int = COPIES,
    seed: int = 13,
) -> DataFrame:
    """`docs` without its text column, with size, source_size, target and taken: the words the mix takes of each document.

    A document's expected copies are its source's target over the source's words, or in proportion to `weight_col` (null
    counts as 0) with `copies` at most. Their whole part is taken for certain; the rest is the inclusion probability of a
    Pareto sample: documents rank by random odds over inclusion odds, and the first ones are taken until what is left of the
    source's target is used up. Where the next document does not fit, up to LOOK_AHEAD further ones in order may, and the
    smallest of the others is added if that comes nearer to the target. Random numbers are hashes of seed and id.

    Null texts have no words and nothing is taken of them. Rows without a source form one, the last in order. Rows that
    share an id have the same random number; size and text tell them apart, and equal rows stand in for each other. An empty
    table gives an empty result. Other columns stay; a column that is called like a result is left out.
    """
    made = ("size", "source_size", "target", "taken")
    names = [c for c in docs.columns if c.lower() not in made and c != text_col]
    row = fresh(docs, "__row")
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    weight = F.lit(1.0) if weight_col is None else F.greatest(F.coalesce(F.col(weight_col).cast("double"), F.lit(0.0)), F.lit(0.0))
    kept = docs.select(
        *names,
        F.struct(
            F.col(id_col).cast("string").alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            words.alias("size"),
            F.xxhash64(text_col).alias("text_hash"),
            weight.alias("weight"),
            seeded_uniform(seed, F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("u"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(row),
    )
    kept = stored(kept, "sizes")
    flat = kept.select(f"{row}.*")
    sources = flat.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources).withColumnsRenamed({"source": "of", "place": "group"})
    known = flat.join(broadcast_if_small(targets), F.col("source").eqNullSafe(F.col("of"))).drop("source", "of")
    known = known.withColumns({"share": F.col("weight") * F.col("size"), "most": copies * F.col("size")})
    if weight_col is None:  # one level for the whole source
        expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    else:
        levels = water_levels(known, "group", "share", "most", "target")
        known = known.join(broadcast_if_small(levels), "group")
        amount = amount_at(F.col("share"), F.col("most"), F.col("target"))
        expected = F.when(F.col("size") > 0, amount / F.col("size")).otherwise(F.lit(0.0))
    known = known.withColumn("expected", F.least(expected, F.lit(float(copies))))
    known = known.withColumn("whole", F.floor("expected")).withColumn("p", F.col("expected") - F.col("whole"))
    known = stored(
        known.select("row", "group", "doc_id", "text_hash", "size", "target", "source_size", "whole", "p", "u"), "copies"
    )
    able = known.filter("p > 0 and size > 0").withColumn("key", pareto_key(F.col("u"), F.col("p")))
    sure = known.groupBy("group").agg((F.max("target") - F.sum(F.col("whole") * F.col("size"))).alias("room"))
    ends = _sample_ends(able, "group", sure)
    place = F.floor(F.col("key") * float(1 << (_DIGIT_BITS * _DIGITS))).cast("long")
    placed = able.withColumn("place", place).join(broadcast_if_small(ends), "group")
    order = ["key", F.asc_nulls_last("doc_id"), "size", "text_hash"]
    near = placed.filter("place >= high").withColumn("lot", F.pmod("row", F.lit(_LOTS)))
    for of in (["group", "lot"], ["group"]):  # first within lots, so that few rows of a source meet
        near = near.withColumn("n", F.row_number().over(W.partitionBy(*of).orderBy(*order))).filter(F.col("n") <= LOOK_AHEAD)
    near = near.select("group", "row", "key", "doc_id", "size", "text_hash", "rest")
    filled = near.groupBy("group").applyInPandas(_fill, "row bigint")
    drawn = placed.filter("place < high").select("row").unionByName(filled).withColumn("drawn", F.lit(1))
    out = known.join(drawn, "row", "left").select(
        "row", "size", "source_size", "target", ((F.col("whole") + F.coalesce("drawn", F.lit(0))) * F.col("size")).cast("long").alias("taken")
    )
    own = out.withColumnRenamed("row", fresh(docs, "__own")).select(F.struct("*").alias("x"))
    joined = kept.join(own, F.col(f"{row}.row") == F.col(f"x.{fresh(docs, '__own')}"))
    return joined.select(*names, *[F.col(f"x.{c}").alias(c) for c in made])
