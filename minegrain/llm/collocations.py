"""Phrase collocations from padded longest windows, whose shorter phrases are margins of a ROLLUP."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minegrain.functions.ordering import rank_within
from minegrain.llm.common import stored
from minegrain.runtime import broadcast_if_small

# Language of texts without one.
UNKNOWN = "und"
# Lower case of A-Z, tabs as spaces, and a line feed for every end of a piece.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _ENDS, b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(_ENDS)
)
# Words that a task holds before it hands over their counts, and bytes of text it splits at once.
_CHUNK_WORDS = 700_000
_BLOCK_BYTES = 1_000_000
# Bits of the filter of frequent words, pairs and triples: so many for each, within these bounds (16 MB at most). A rare one
# that shares a bit with a frequent one makes a longer window, and mostly one of its own.
_SLOT_SHARE = 128
_FILTER_BITS = (16, 27)
_SLOT_BITS = 48


class _Ids(dict):
    """Ids of words by first appearance; 0 is the end of a piece and -1 no word."""

    def __init__(self):
        super().__init__({b"": -1, b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) - 1
        return n


def _split(raw: bytes, ids: _Ids) -> Iterator[np.ndarray]:
    """Ids of the words of a folded text and its ends of pieces, block by block; no word is cut."""
    at = 0
    while at < len(raw):
        gap = re.compile(rb"[ \n]").search(raw, at + _BLOCK_BYTES)
        end = gap.start() if gap else len(raw)
        tokens = raw[at:end].replace(b"\n", b" \n ").split(b" ")
        found = np.fromiter(map(ids.__getitem__, tokens), np.int32, len(tokens))
        yield found[found >= 0]
        at = end


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """(language, words by id, ids): texts of one language, each followed by an end of piece; some _CHUNK_WORDS words each."""
    held: dict[str, tuple[_Ids, list[np.ndarray]]] = {}
    words = 0

    def flush():
        for lang, (ids, parts) in held.items():
            yield lang, [w for w, i in ids.items() if i >= 0], np.concatenate(parts)
        held.clear()

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        langs = batch.column("lang").to_pandas()
        for lang, rows in langs.groupby(langs).indices.items():
            waiting: list[bytes] = []
            size = 0
            for last, row in [*((False, r) for r in rows), (True, -1)]:
                if not last:
                    waiting.append(texts[int(row)].as_py().translate(_FOLD))
                    size += len(waiting[-1])
                if waiting and (last or size >= _BLOCK_BYTES):
                    ids, parts = held.setdefault(lang, (_Ids(), []))
                    for part in _split(b"\n".join(waiting) + b"\n", ids):
                        parts.append(part)
                        words += len(part)
                    waiting, size = [], 0
                    if words >= _CHUNK_WORDS:
                        yield from flush()
                        words = 0
    yield from flush()


def _mixed(x: np.ndarray) -> np.ndarray:
    """Slots of _SLOT_BITS bits from 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(64 - _SLOT_BITS)


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def _pair_slots(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mixed(h[a] * np.uint64(0x9E3779B97F4A7C15) + h[b])


def _triple_slots(h: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return _mixed((h[a] * np.uint64(0x9E3779B97F4A7C15) + h[b]) * np.uint64(0xC2B2AE3D27D4EB4F) + h[c])


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, n): how often the words and the runs of two and three neighbouring words of one slot occur."""

    def counted(slots: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int64)), pa.array(n.astype(np.int64))], ["slot", "n"])

    for lang, words, ids in _chunks(batches):
        h = _hashes(lang, words)
        yield counted(_mixed(h[1:]), np.bincount(ids, minlength=len(words))[1:])
        inside = (ids[:-1] > 0) & (ids[1:] > 0)
        codes, slots = pd.factorize(_pair_slots(h, ids[:-1][inside], ids[1:][inside]))
        yield counted(slots, np.bincount(codes, minlength=len(slots)))
        inside = inside[:-1] & inside[1:]
        codes, slots = pd.factorize(_triple_slots(h, ids[:-2][inside], ids[1:-1][inside], ids[2:][inside]))
        yield counted(slots, np.bincount(codes, minlength=len(slots)))


def _frequent_slots(texts: DataFrame, min_count: int) -> np.ndarray:
    """A bit for each slot, folded to the size of the filter, of the words, pairs and triples that occur `min_count` times."""
    found = texts.mapInArrow(_slot_counts, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    found = stored(found.filter(F.col("n") >= min_count).select("slot"), "frequent-slots")
    size = min(max((_SLOT_SHARE * found.count()).bit_length(), _FILTER_BITS[0]), _FILTER_BITS[1])
    at = F.col("slot").bitwiseAND((1 << size) - 1)
    lot = found.groupBy(F.shiftright(at, 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
    rows = lot.toPandas()  # 2^(size - 6) rows at most
    bits = np.zeros(1 << (size - 6), np.uint64)
    bits[rows["at"].to_numpy()] = rows["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return bits


def _holds(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    at = slots & np.uint64(64 * len(bits) - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _lead_windows(sent, longest: int):
    """Windows from each word to the `longest`-th from it: columns w1, w2, ... lead by 0, 1, ... words.

    They are padded with '' from the first word, pair or triple on that the filter lacks and from the end of the piece on;
    equal ones of a chunk are one row with their number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for lang, words, ids in _chunks(batches):
            h = _hashes(lang, words)
            known = _holds(bits, _mixed(h))
            known[0] = False
            starts = np.flatnonzero(ids > 0)
            whole = known[ids]
            linked = np.zeros(len(ids), bool)
            both = np.flatnonzero(whole[:-1] & whole[1:])
            linked[both] = _holds(bits, _pair_slots(h, ids[both], ids[both + 1]))
            tripled = np.zeros(len(ids), bool)
            both = np.flatnonzero(linked[:-1] & linked[1:])
            tripled[both] = _holds(bits, _triple_slots(h, ids[both], ids[both + 1], ids[both + 2]))
            columns = [np.where(whole, ids, 0)[starts]]
            alive = whole[starts]
            for k in range(1, longest):
                before = starts + k - 1
                alive = alive & linked[np.minimum(before, len(ids) - 1)]
                if k > 1:
                    alive = alive & tripled[np.minimum(before - 1, len(ids) - 1)]
                columns.append(np.where(alive, ids[np.minimum(before + 1, len(ids) - 1)], 0))
            code = columns[0].astype(np.int64)
            for c in columns[1:]:
                code = pd.factorize(code)[0].astype(np.int64) << 32 | c
            code, different = pd.factorize(code)
            first = np.zeros(len(different), np.int64)
            first[code[::-1]] = np.arange(len(code))[::-1]
            names = pa.array([b"", *words[1:]], pa.binary()).cast(pa.string())
            out = [pa.array([lang] * len(first), pa.string()), *(names.take(pa.array(c[first])) for c in columns)]
            out.append(pa.array(np.bincount(code, minlength=len(different)).astype(np.int64)))
            yield pa.RecordBatch.from_arrays(out, ["lang", *(f"w{i + 1}" for i in range(longest)), "n"])

    return run


def phrase_counts(docs: DataFrame, text_col: str, lang_col: str, min_count: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """((lang, n), (lang, words, phrase, f)): all words of a language, and its phrases of up to `longest` words that occur
    `min_count` times, single words among them.

    Only the longest windows are counted; ROLLUP adds them up for their shorter beginnings, down to the language. A window
    ends early where the phrase cannot be frequent, as it holds a word, a pair or a triple of words that is not: a filter of
    hashed ones says so, which never lacks a frequent one. What it lets through by mistake is counted like the rest.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang")
    ).filter("text <> ''")
    sent = spark.sparkContext.broadcast(_frequent_slots(texts, min_count))
    columns = [f"w{i + 1}" for i in range(longest)]
    schema = ", ".join(["lang string", *(f"{c} string" for c in columns), "n bigint"])
    windows = texts.mapInArrow(_lead_windows(sent, longest), schema)
    windows = windows.groupBy("lang", *columns).agg(F.sum("n").alias("n"))
    sums = windows.rollup("lang", *columns).agg(F.sum("n").alias("f"), F.grouping_id().alias("rolled"))
    # Columns that are rolled up are the last ones; a phrase of k words leaves longest - k of them.
    words = F.lit(longest) - F.bit_count("rolled").cast("int")
    sums = sums.filter(F.col("rolled") < (1 << (longest + 1)) - 1).withColumn("k", words)
    own = F.slice(F.array(*columns), 1, F.greatest(F.col("k"), F.lit(1)))
    # This filter reads grouping columns alone, so Spark moves it below the sums: beginnings that end in padding never shuffle.
    sums = sums.filter(F.coalesce(F.element_at(own, -1), F.lit("-")) != "")
    sums = sums.filter((F.col("k") == 0) | (F.col("f") >= min_count))
    sums = stored(sums.select("lang", "k", F.when(F.col("k") > 0, own).alias("words"), "f"), "phrases")
    totals = sums.filter("k = 0").select("lang", F.col("f").alias("n"))
    return totals, sums.filter("k > 0").select("lang", "words", F.array_join("words", " ").alias("phrase"), "f")


def with_score(cuts: DataFrame) -> DataFrame:
    """Adds score = floor(1000 * a * n / (l * r)), exact while both products have 38 digits at most; more raise an error."""
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    both = cuts.withColumns({"__up": wide("a") * wide("n") * F.lit(1000).cast("decimal(4,0)"), "__down": wide("l") * wide("r")})
    return both.withColumn("score", F.expr("__up div __down")).drop("__up", "__down")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = 100,
    longest: int = 5,
    top: int = 2000,
    share: int = 100,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): per language the `top` phrases of 2 to `longest` words by score.

    A phrase that occurs a >= min_count times and is cut after a word into parts that occur l and r times has
    floor(1000 * a * n / (l * r)) with n words of its language; its lowest cut counts, the first one on ties. Phrases inside
    a longer one that occurs at least share % as often are left out; equal scores rank by a, then by phrase.

    Words are parted by spaces and tabs, after A-Z are lower-cased; phrases do not cross . , ; : ! ? or line ends. Null
    texts are empty and a null language is `und`. Repeated rows count as often as they are there; other columns, whatever
    their names, are ignored. An empty table gives an empty result. Long texts are read whole, block by block.
    """
    totals, phrases = phrase_counts(docs, text_col, lang_col, min_count, longest)
    long = phrases.filter(F.size("words") > 1)
    cut = F.explode(F.sequence(F.lit(1), F.size("words") - 1))
    cuts = long.select("lang", "words", "phrase", F.col("f").alias("a"), cut.alias("cut"))
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "cut",
        F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("head"),
        F.array_join(F.slice("words", F.col("cut") + 1, F.size("words")), " ").alias("tail"),
    )
    part = lambda name, f: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"])
    cuts = cuts.join(broadcast_if_small(totals), "lang")
    cuts = with_score(cuts)
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("best"))
    # A phrase inside a longer one is inside one of a single word more that occurs as often or more often.
    longer = long.filter(F.size("words") > 2).select(
        "lang",
        "f",
        F.explode(F.array(F.slice("words", F.lit(1), F.size("words") - 1), F.slice("words", F.lit(2), F.size("words")))).alias("inner"),
    )
    longer = longer.groupBy("lang", F.array_join("inner", " ").alias("phrase")).agg(F.max("f").alias("outer"))
    kept = best.select("lang", "phrase", "best.*").join(longer, ["lang", "phrase"], "left")
    kept = kept.filter(F.col("outer").isNull() | (100 * F.col("outer") < share * F.col("a")))
    ranked = rank_within(kept.select("lang", "phrase", "a", "l", "r", "n", "score"), ["lang"], [F.desc("score"), F.desc("a"), F.col("phrase")])
    return ranked.filter(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
