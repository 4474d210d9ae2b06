"""WARC archives: writing pages as records, and reading records back by boundary-chain verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from minegrain.llm.common import stored

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
# Payloads below this many bytes are never revisits.
MIN_REVISIT_BYTES = 100
# Rows of (digest, id) that are sent to every task, 40 bytes each; more of them are joined by key.
BROADCAST_ROWS = 200_000


def _broadcast_below(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def write_warc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    compression: str = "gzip",
) -> None:
    """One record per row, in one archive per task; payloads are the UTF-8 bytes of a string column.

    Of rows with equal payloads (SHA-256) of at least MIN_REVISIT_BYTES, those with the smallest id become response records
    and the others revisit records without payload, which carry its digest and length. Null payloads are empty. A null id
    leaves the record id empty and is never referred to; in a group without any id all rows are responses. Null urls leave
    the field out, and line breaks in a url are percent-encoded. An empty table writes archives without records.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"),
    )
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload")})
    copies = (
        rows.filter(F.col("bytes") >= MIN_REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", "first")
    )
    rows = rows.join(_broadcast_below(stored(copies, "copies")), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))

    def line(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit("\r\n"))

    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn("id")),
        line("WARC-Date", date),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
                line("WARC-Refers-To", urn("first")),
                line("X-Payload-Length", F.col("bytes").cast("string")),
            ),
        ).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        line("Content-Type", "text/html"),
        line("Content-Length", F.when(revisit, "0").otherwise(F.col("bytes").cast("string"))),
        F.lit("\r\n"),
    )
    record = F.concat(head, F.when(revisit, "").otherwise(F.col("payload")))
    rows.select(record.alias("value")).write.option("lineSep", END).option("compression", compression).text(path)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """The bytes between magics, with the file and the split they were read in; Spark may split uncompressed archives."""
    return (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("value").cast("binary").alias("chunk"),
        )
    )


def _content_length(head: bytes) -> int | None:
    for row in head.split(b"\r\n"):
        name, _, value = row.partition(b":")
        if name.strip().lower() == b"content-length":
            value = value.strip()
            return int(value) if value.isdigit() else None
    return None


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """A row per chunk: file, offset of its magic (below 0 for what precedes the first one), size, and, if the chunk starts
    like a record, next (the offset its length leads to), head, body (where its payload begins) and the payload's digest if
    the chunk holds all of it. Only these small columns leave the tasks."""
    magic, end = len(MAGIC), len(END)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, where = 0, None
        for b in batches:
            out = []
            for file, block, chunk in zip(b["file"], b["block"], b["chunk"]):
                if (file, block) != where:
                    at, where = 0, (file, block)
                stop = chunk.find(b"\r\n\r\n")
                n = _content_length(chunk[:stop]) if stop >= 0 else None
                row = [file, block, at, len(chunk), None, None, None, None]
                if n is not None:
                    body = stop + end
                    row[4:7] = [magic + body + n + end, chunk[:stop].decode("utf-8", "replace"), magic + body]
                    if body + n <= len(chunk):
                        row[7] = hashlib.sha256(chunk[body : body + n]).hexdigest()
                out.append(row)
                at += len(chunk) + magic
            yield pd.DataFrame(out, columns=["file", "block", "at", "size", "length", "head", "body", "digest"]).astype(
                {"length": "Int64", "body": "Int64"}
            )

    kinds = "file string, block long, at long, size long, length long, head string, body long, digest string"
    found = stored(_chunks(spark, path).mapInPandas(scan, kinds), "candidates")
    # One row per split of a file.
    splits = found.groupBy("file", "block").agg(F.sum(F.col("size") + magic).alias("n"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    offset = F.col("base") + F.col("at") - magic
    return found.join(splits, ["file", "block"]).select(
        "file",
        "block",
        "at",
        offset.alias("offset"),
        "size",
        F.when(offset >= 0, offset + F.col("length")).alias("next"),
        "head",
        "body",
        "digest",
    )


def reachable(found: DataFrame) -> DataFrame:
    """(file, offset) of the candidates that the chain from the start of their file reaches, by pointer jumping.

    Each round doubles the reach: the reached offsets take one jump of the present width, and jumps are joined with
    themselves. The rounds end when no jump stays inside the file, after the logarithm of the longest chain.
    """
    nodes = found.filter("next is not null").select("file", "offset", "next")
    ends = nodes.select("file", F.col("offset").alias("next"))
    # Paths repeat, so these tables are far larger in memory than on disk: Spark must not broadcast them by their file size.
    jump = stored(nodes.join(ends.hint("merge"), ["file", "next"]).select("file", "offset", "next"), "jumps")
    reached = nodes.filter("offset = 0").select("file", "offset")
    while not jump.isEmpty():
        step = jump.join(reached.hint("merge"), ["file", "offset"]).select("file", F.col("next").alias("offset"))
        reached = stored(reached.unionByName(step).distinct(), "reached")
        onward = jump.select("file", F.col("offset").alias("next"), F.col("next").alias("onward"))
        jump = stored(jump.join(onward.hint("merge"), ["file", "next"]).select("file", "offset", F.col("onward").alias("next")), "jumps")
    return reached


def _payloads(spark: SparkSession, path: str, found: DataFrame, records: DataFrame) -> DataFrame:
    """(file, offset, payload): the bytes of the given records, put together from the chunks between their magics.

    A chunk that is no record belongs to the record before it in its file. Only chunks of the given records are grouped.
    """
    known = records.select("file", "offset", "next", "body", F.col("offset").alias("own"))
    order = W.partitionBy("file").orderBy("offset").rowsBetween(W.unboundedPreceding, 0)
    all_of = found.filter("offset >= 0").select("file", "block", "at", "offset")
    every = all_of.join(known.select("file", "offset", "own").hint("merge"), ["file", "offset"], "left")
    owned = every.withColumn("owner", F.last("own", True).over(order)).filter("owner is not null")
    owned = owned.select("file", "block", "at", "owner", F.col("offset").alias("chunk_at"))
    spans = known.select("file", F.col("own").alias("owner"), "next", "body")
    owned = stored(owned.join(spans.hint("merge"), ["file", "owner"]).filter("chunk_at < next"), "owned")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, where = 0, None
        for b in batches:
            places = []
            for file, block, chunk in zip(b["file"], b["block"], b["chunk"]):
                if (file, block) != where:
                    at, where = 0, (file, block)
                places.append(at)
                at += len(chunk) + len(MAGIC)
            yield b.assign(at=places)

    placed = _chunks(spark, path).mapInPandas(place, "file string, block long, chunk binary, at long")
    parts = placed.join(_broadcast_below(owned), ["file", "block", "at"])
    whole = parts.groupBy("file", "owner", "next", "body").agg(
        F.array_sort(F.collect_list(F.struct("chunk_at", F.hex("chunk").alias("chunk")))).alias("chunks")
    )  # the chunks of one record
    joined = F.array_join(F.col("chunks.chunk"), MAGIC.encode().hex())
    magic, end = len(MAGIC), len(END)
    begin, n = F.col("body") - magic, F.col("next") - F.col("owner") - F.col("body") - end
    payload = F.unhex(F.substring(joined, (2 * begin + 1).cast("int"), (2 * n).cast("int")))
    return whole.select("file", F.col("owner").alias("offset"), payload.alias("payload"))


def field(name: str) -> Column:
    """A header field of the record, null if it is not there."""
    got = F.regexp_extract("head", rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(got != "", got)


def read_warc(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """The records of all archives below `path`: file, offset, head, payload_bytes, payload_digest (SHA-256) and payload.

    Every magic is a candidate whose Content-Length leads to the offset of its successor. Only candidates on the chain from
    the start of the file are records, so a magic inside a payload, even before a complete false header, is part of that
    payload. What follows a broken length up to the end of the file is not returned. Without `payload`, contents stay in the
    tasks that read them, except those of records that hold a magic.
    """
    found = stored(candidates(spark, path), "chunks")
    records = found.join(reachable(found).hint("merge"), ["file", "offset"])
    bytes_ = F.col("next") - F.col("offset") - F.col("body") - len(END)
    out = records.select("file", "offset", "next", "body", "head", bytes_.alias("payload_bytes"), F.col("digest").alias("payload_digest"))
    out = stored(out, "records")
    if payload:
        got = _payloads(spark, path, found, out)
    else:
        split = out.filter("payload_digest is null")
        if split.isEmpty():
            return out.drop("next", "body")
        # The window needs all records as owners; only split ones are put together.
        got = _payloads(spark, path, found, out).join(split.select("file", "offset"), ["file", "offset"], "left_semi")
    got = got.withColumn("d", F.sha2("payload", 256))
    out = out.join(got, ["file", "offset"], "left").withColumn("payload_digest", F.coalesce("payload_digest", "d"))
    return out.drop("next", "body", "d", *([] if payload else ["payload"]))


def page_records(records: DataFrame, id_name: str = "page_id") -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to) of records that `write_warc` wrote."""
    number = lambda name: F.regexp_extract(field(name), r"<urn:page:(-?\d+)>", 1)
    revisit = field("WARC-Type") == "revisit"
    long = lambda c: F.when(c != "", c).cast("long")
    return records.select(
        long(number("WARC-Record-ID")).alias(id_name),
        F.when(revisit, field("X-Payload-Length").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace(field("WARC-Payload-Digest"), "^sha256:", ""))
        .otherwise(F.col("payload_digest"))
        .alias("payload_digest"),
        F.lower(field("WARC-Type")).alias("record_type"),
        F.when(revisit, long(number("WARC-Refers-To"))).alias("refers_to"),
    )
