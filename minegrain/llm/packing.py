"""Vector bin packing of tokenised examples under limits on tokens, segments and loss-bearing tokens."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Remainders that are packed together; a pool of this size is full when packing starts.
POOL = 4096


def load_encoder(json_path: str, ranks_path: str | None, pattern: str) -> Callable[[list[str]], list[np.ndarray]]:
    """Texts to ids, as the tokenizer in `json_path` gives them without added special tokens.

    With `ranks_path`, a file of the same vocabulary as ranks, texts are encoded from there, several times faster; texts
    that contain one of the tokenizer's special tokens still go through the tokenizer itself.
    """
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(json_path)
    if ranks_path is None:
        return lambda texts: [np.array(e.ids, np.uint32) for e in tok.encode_batch(texts, add_special_tokens=False)]
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    special = [t.content for t in tok.get_added_tokens_decoder().values()]

    def encode(texts: list[str]) -> list[np.ndarray]:
        return [
            np.array(
                tok.encode(t, add_special_tokens=False).ids if any(s in t for s in special) else fast.encode_ordinary(t),
                np.uint32,
            )
            for t in texts
        ]

    return encode


def pack_pool(
    demand: np.ndarray, limits: np.ndarray, divisible: bool, final: bool
) -> tuple[list[list[tuple[int, int]]], list[tuple[int, int]]]:
    """Bins of (item, amount) and what is left over.

    demand: a row (tokens, segments, loss tokens) for each item; limits: the same of a bin. The next item of an open bin is
    the one whose demand, as shares of the limits, has the largest dot product with the room left; only items that fit all
    limits take part, ties go to the first. With `divisible`, an item that does not fit is cut to fill the bin to its token
    limit; its head must fit the loss limit. Unless `final`, the last bin is left over if it is not full.
    """
    size = demand.astype(np.float64).copy()
    open_ = size[:, 0] > 0
    share = size / limits
    bins: list[list[tuple[int, int]]] = []
    while open_.any():
        room, held = limits.astype(np.float64).copy(), []
        while room[0] > 0 and room[1] > 0:
            score = np.where(open_, share @ (room / limits), -1.0)
            fits = open_ & (size <= room).all(axis=1)
            if fits.any():
                item = int(np.where(fits, score, -1.0).argmax())
                take = size[item].copy()
            elif divisible and open_.any():
                item = int(score.argmax())
                # A cut keeps the item's loss tokens in its head as far as they go.
                tokens = min(size[item, 0], room[0])
                if min(size[item, 2], tokens) > room[2]:
                    tokens = room[2]
                if tokens <= 0:
                    break
                take = np.array([tokens, 1.0, min(size[item, 2], tokens)])
            else:
                break
            held.append((item, int(take[0])))
            room -= take
            size[item, 0] -= take[0]
            size[item, 2] -= take[2]
            if size[item, 0] <= 0:
                open_[item] = False
            share[item] = size[item] / limits
        if not held:
            raise ValueError("an example does not fit an empty sequence")
        if not final and not open_.any() and room[0] > 0:
            return bins, held
        bins.append(held)
    return bins, []


def _powers(pieces: list[tuple], limit: int) -> Iterator[list[tuple]]:
    """A bin as it is when it is full, else cut into bins of powers of two, which need no padding."""
    total = sum(p[2] for p in pieces)
    if total == limit:
        yield pieces
        return
    rest = [list(p) for p in pieces]
    for bit in range(total.bit_length() - 1, -1, -1):
        want = total & (1 << bit)
        if not want:
            continue
        out = []
        while want:
            doc, start, length = rest[0]
            take = min(length, want)
            out.append((doc, start, take))
            want -= take
            rest[0] = [doc, start + take, length - take]
            if take == length:
                rest.pop(0)
        yield out


def pack_documents(
    docs: DataFrame,
    encoder: tuple[str, str | None, str],
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = 2048,
    max_segments: int = 512,
    max_loss: int | None = None,
    separator: int = 1,
    separator_has_loss: bool = True,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents in sequences of at most `max_tokens` ids, `max_segments` pieces and `max_loss` loss tokens.

    Per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids themselves on request. A document
    is its ids and the separator. Runs of a whole sequence are cut off first; remainders go to a pool of up to POOL in the
    task that holds them and are packed by the dot-product rule, so nothing is shuffled. Documents may be cut, so sequences
    are full; the last of a task, and one that reaches the segment or loss limit early, are cut into powers of two.

    Null and empty texts are the separator alone. Null and repeated ids are packed as rows of their own. A text of any
    length is encoded whole. An empty table gives no pieces; other columns are ignored.
    """
    max_loss = max_tokens if max_loss is None else max_loss
    limits = np.array([max_tokens, max_segments, max_loss], np.float64)
    if max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load_encoder(*encoder)
        base = TaskContext.get().partitionId() << 33
        made = 0
        ids: dict[int, tuple[str | None, np.ndarray]] = {}
        waiting: list[tuple[int, int, int]] = []  # (row, start, length)
        out: list[tuple] = []
        row = 0

        def place(pieces: list[tuple]) -> None:
            nonlocal made
            for seq in _powers(pieces, max_tokens):
                at = 0
                for doc, start, length in seq:
                    name, own = ids[doc]
                    part = own[start : start + length]
                    line = (name, start, length, zlib.crc32(part.astype("<u4").tobytes()), len(own), base + made, at)
                    out.append(line + ((part.tolist(),) if with_ids else ()))
                    at += length
                made += 1

        def loss(doc: int, start: int, length: int) -> int:
            own = ids[doc][1]
            return length - (0 if separator_has_loss else int(start + length == len(own)))

        def pack(final: bool) -> None:
            nonlocal waiting
            if not waiting:
                return
            demand = np.array([(n, 1, loss(d, s, n)) for d, s, n in waiting], np.float64)
            bins, rest = pack_pool(demand, limits, True, final)
            used = [0] * len(waiting)

            def cut(held: list[tuple[int, int]]) -> list[tuple]:
                got = []
                for item, n in held:
                    d, s, _ = waiting[item]
                    got.append((d, s + used[item], n))
                    used[item] += n
                return got

            for held in bins:
                place(cut(held))
            waiting = cut(rest)
            keep = {d for d, _, _ in waiting}
            for d in [d for d in ids if d not in keep]:
                del ids[d]

        def flush() -> pd.DataFrame:
            names = ["__id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            lot = pd.DataFrame(out, columns=names + (["ids"] if with_ids else []))
            out.clear()
            return lot

        whole = max_tokens if max_loss >= max_tokens else 0  # runs that fill a sequence alone
        for b in batches:
            names, texts = b["__id"].tolist(), [t or "" for t in b["__text"]]
            for name, text in zip(names, texts):
                own = np.append(encode([text])[0], np.uint32(separator))
                ids[row] = (name, own)
                start = 0
                while whole and len(own) - start >= whole:
                    place([(row, start, whole)])
                    start += whole
                while len(own) - start > max_tokens:
                    waiting.append((row, start, max_tokens))
                    start += max_tokens
                if start < len(own):
                    waiting.append((row, start, len(own) - start))
                else:
                    del ids[row]
                row += 1
                if len(waiting) >= POOL:
                    pack(False)
                if len(out) >= 20_000:
                    yield flush()
        pack(True)
        if out:
            yield flush()

    narrow = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    kind = narrow.schema["__id"].dataType.simpleString()
    schema = "__id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema += ", ids array<int>" if with_ids else ""
    # Ids travel as text, so that a null does not turn a batch of longs into doubles.
    out = narrow.withColumn("__id", F.col("__id").cast("string")).mapInPandas(run, schema)
    return out.select(F.col("__id").cast(kind).alias(id_col), *[c for c in out.columns if c != "__id"])
