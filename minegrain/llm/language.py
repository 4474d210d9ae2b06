"""Language identification with bit-sliced Bloom filters over character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minegrain.llm.common import fresh, stored

# Slots of the smallest filter and of the largest one that is sent to the tasks (8 bytes each).
SLOTS_LOG2 = 18
MAX_SLOTS_LOG2 = 24
# False-positive rate of the language with the most n-grams, which the filter may not pass.
FALSE_RATE = 0.01
# Odd multipliers of the hash functions (multiply, keep the top bits).
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
MAX_LANGUAGES = 64
# An n-gram belongs to a language if it is seen this often there, and at this share of its highest rate in any language.
MIN_COUNT = 3
MIN_SHARE = 0.35
# Characters that are looked at together; a longer text is a row of slices.
SLICE = 1 << 20


def _letters() -> np.ndarray:
    """Whether each code point is a letter; made once per worker."""
    if "table" not in _CACHE:
        _CACHE["table"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _CACHE["table"]


_CACHE: dict[str, np.ndarray] = {}


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Codes of the character trigrams of each slice: lower case, every run of other characters than letters as one gap."""
    table = _letters()
    for at in range(0, len(text), SLICE):
        points = np.frombuffer(text[at : at + SLICE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = table[points]
        if not letter.any():
            continue
        before = np.concatenate(([False], letter[:-1]))
        keep = letter | before  # a gap stands for its run
        codes = np.where(letter, points, 0)[keep].astype(np.uint64)
        codes = np.concatenate((np.zeros(1, np.uint64), codes, np.zeros(1, np.uint64)))
        yield codes[:-2] << np.uint64(42) | codes[1:-1] << np.uint64(21) | codes[2:]


def slots_log2(members: int) -> int:
    """Logarithm of the number of slots in which `members` n-grams of one language keep FALSE_RATE."""
    k = len(MULTIPLIERS)
    wanted = k * members / -np.log1p(-(FALSE_RATE ** (1 / k)))
    return max(SLOTS_LOG2, int(np.ceil(np.log2(max(1.0, wanted)))))


def slots(codes: np.ndarray, log2: int) -> list[np.ndarray]:
    shift = np.uint64(64 - log2)
    with np.errstate(over="ignore"):
        return [((codes * np.uint64(m)) >> shift).astype(np.int64) for m in MULTIPLIERS]


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no model may learn from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


@dataclass
class Model:
    """Learned languages, the most frequent one, and their n-grams as a filter, or as a table if that would be too large."""

    languages: list[str]
    common: str | None
    table: np.ndarray | None
    members: DataFrame | None = None  # (code, bit)


def learn(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """A model from every labelled row.

    The filter has one word of language bits per slot, and so many slots that the false-positive rate stays below FALSE_RATE
    however many n-grams there are. Tasks count n-grams and Spark adds the counts; an n-gram's languages are set in its
    slots, and slots are combined before they are collected. Above 2^MAX_SLOTS_LOG2 slots, the n-grams stay a table.
    """
    known = labelled.select(F.col(lang_col).cast("string").alias("l"), F.col(text_col).cast("string").alias("t"))
    known = known.filter("l is not null and t is not null")
    seen = known.groupBy("l").count().orderBy("l").limit(MAX_LANGUAGES + 1).collect()
    if len(seen) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = [r[0] for r in seen]
    table = np.zeros(1 << SLOTS_LOG2, np.uint64)
    if not languages:
        return Model([], None, table)
    common = max(seen, key=lambda r: (r[1], r[0]))[0]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, texts in b.groupby("l")["t"]:
                total: dict[str, list[np.ndarray]] = {"code": [], "n": []}
                size = 0
                for text in texts:
                    for codes in trigrams(text):
                        code, n = np.unique(codes, return_counts=True)
                        total["code"].append(code)
                        total["n"].append(n)
                        size += len(code)
                        if size > 2_000_000:
                            yield fold(lang, total)
                            total, size = {"code": [], "n": []}, 0
                if size:
                    yield fold(lang, total)

    def fold(lang: str, total: dict[str, list[np.ndarray]]) -> pd.DataFrame:
        code, at = np.unique(np.concatenate(total["code"]), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate(total["n"])).astype(np.int64)
        return pd.DataFrame({"l": lang, "code": code.view(np.int64), "n": n})

    counts = known.mapInPandas(count, "l string, code bigint, n bigint").groupBy("l", "code").agg(F.sum("n").alias("n"))
    counts = stored(counts, "trigrams")
    # At most MAX_LANGUAGES rows.
    totals = counts.groupBy("l").agg(F.sum("n").alias("total")).collect()
    if not totals:
        return Model(languages, common, table)
    rate = F.create_map(*[x for r in totals for x in (F.lit(r[0]), F.lit(1.0 / r[1]))])
    bit = F.create_map(*[x for i, l in enumerate(languages) for x in (F.lit(l), F.lit(i))])
    cell = F.struct((F.col("n") * rate[F.col("l")]).alias("rate"), "n", bit[F.col("l")].alias("bit"))
    cells = counts.groupBy("code").agg(F.collect_list(cell).alias("cells"), F.max(F.col("n") * rate[F.col("l")]).alias("top"))
    member = cells.select("code", "top", F.explode("cells").alias("c")).filter(
        (F.col("c.n") >= MIN_COUNT) & (F.col("c.rate") >= MIN_SHARE * F.col("top"))
    )
    member = stored(member.select("code", F.col("c.bit").alias("bit")), "members")
    log2 = slots_log2(member.groupBy("bit").count().agg(F.max("count")).first()[0] or 0)
    if log2 > MAX_SLOTS_LOG2:
        return Model(languages, common, None, member)
    table = np.zeros(1 << log2, np.uint64)
    masks = member.select("code", F.expr("shiftleft(1L, bit)").alias("mask"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for s in slots(b["code"].to_numpy(np.int64).view(np.uint64), log2):
                yield pd.DataFrame({"slot": s, "mask": b["mask"].to_numpy(np.int64)})

    filled = masks.mapInPandas(place, "slot int, mask bigint").groupBy("slot").agg(F.bit_or("mask").alias("mask"))
    got = filled.toPandas()  # at most a row per slot
    table[got["slot"].to_numpy(np.int64)] = got["mask"].to_numpy(np.int64).view(np.uint64)
    return Model(languages, common, table)


def decide(text: str | None, languages: list[str], table: np.ndarray, false: np.ndarray, common: str | None) -> tuple[str, float]:
    """(language, share of the text's n-grams that are its own).

    The masks of an n-gram's slots are combined by AND, which leaves the languages that hold it. A language's count c of n
    n-grams is corrected to (c - n f) / (1 - f) for its false-positive rate f. Ties go to the first language by name.
    """
    n, hits, letters, log2 = 0, np.zeros(len(languages), np.int64), False, len(table).bit_length() - 1
    for codes in trigrams(text or ""):
        letters = True
        first, *others = slots(codes, log2)
        mask = table[first]
        for s in others:
            mask = mask & table[s]
        n += len(mask)
        for i in range(len(languages)):
            hits[i] += np.count_nonzero(mask & np.uint64(1 << i))
    if not letters or not languages:
        return "und", 0.0
    corrected = np.clip((hits - n * false) / np.maximum(1e-9, 1 - false), 0, n)
    best = int(corrected.argmax())
    if corrected[best] <= 0:
        return common or languages[0], 0.0
    return languages[best], float(corrected[best] / n)


def identify(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    lang_name: str = "lang_pred",
    score_name: str = "score",
) -> DataFrame:
    """All columns of `docs` with the predicted language and its score; only the text takes part.

    Null texts and texts without a letter are `und` with score 0, as is every text if nothing was learned. A text none of
    whose n-grams is known gets the most frequent language with score 0. Columns named like the new ones are replaced.
    """
    if model.table is None:
        return _identify_by_join(docs, model, text_col, lang_name, score_name)
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((model.languages, model.table, model.common))  # 2^MAX_SLOTS_LOG2 slots at most

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        langs, bits, usual = sent.value
        filled = np.array([np.count_nonzero(bits & np.uint64(1 << i)) / len(bits) for i in range(len(langs))])
        false = filled ** len(MULTIPLIERS)
        for b in batches:
            yield pd.DataFrame([decide(t, langs, bits, false, usual) for t in b], columns=["lang", "score"])

    both = fresh(docs, "__both")
    got = docs.withColumn(both, predict(F.col(text_col).cast("string")))
    return got.withColumns({lang_name: F.col(both)["lang"], score_name: F.col(both)["score"]}).drop(both)


def _identify_by_join(docs: DataFrame, model: Model, text_col: str, lang_name: str, score_name: str) -> DataFrame:
    """`identify` with the n-grams of the texts joined to those of the languages: no false positives, nothing is sent."""
    row = fresh(docs, "__row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "texts")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r, text in zip(b["r"], b["t"]):
                for codes in trigrams(text):
                    code, n = np.unique(codes, return_counts=True)
                    yield pd.DataFrame({"r": r, "code": code.view(np.int64), "n": n})

    texts = rows.select(F.col(row).alias("r"), F.col(text_col).cast("string").alias("t")).filter("t is not null")
    cells = stored(texts.mapInPandas(count, "r bigint, code bigint, n bigint"), "text-trigrams")
    total = cells.groupBy("r").agg(F.sum("n").alias("total"))
    hits = cells.join(model.members, "code").groupBy("r", "bit").agg(F.sum("n").alias("n"))
    best = hits.groupBy("r").agg(F.max(F.struct("n", (-F.col("bit")).alias("bit"))).alias("best"))
    both = fresh(docs, "__both")
    names = F.array(*[F.lit(x) for x in model.languages])
    lang = F.when(F.col("best").isNull(), F.lit(model.common)).otherwise(F.element_at(names, 1 - F.col("best.bit")))
    score = F.coalesce(F.col("best.n") / F.col("total"), F.lit(0.0))
    said = total.join(best, "r", "left").select(F.col("r").alias(row), F.struct(lang.alias("lang"), score.alias("score")).alias(both))
    got = rows.join(said, row, "left")
    lang, score = F.coalesce(F.col(both)["lang"], F.lit("und")), F.coalesce(F.col(both)["score"], F.lit(0.0))
    return got.withColumns({lang_name: lang, score_name: score}).drop(both, row)


def keep_identified(
    docs: DataFrame,
    min_score: float,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """`docs` without the rows that are `und` or score below `min_score`: texts in none of the learned languages."""
    lang, score = fresh(docs, "__lang"), fresh(docs, "__score")
    model = learn(docs.filter(~held_out(id_col)), lang_col, text_col)
    marked = identify(docs, model, text_col, lang, score)
    return marked.filter((F.col(lang) != "und") & (F.col(score) >= min_score)).select(*docs.columns)


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: id, held_out, lang_pred, score. Learns from the labelled rows that are not held out, predicts all rows.

    Null labels are not learned from; null ids count as the empty text for the fold. Repeated rows count as often as they
    occur. An empty table gives an empty result; other columns are ignored.
    """
    model = learn(docs.filter(~held_out(id_col)), lang_col, text_col)
    narrow = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    out = identify(narrow, model, "__text")
    return out.select(F.col("__id").alias(id_col), held_out("__id").alias("held_out"), "lang_pred", "score")
