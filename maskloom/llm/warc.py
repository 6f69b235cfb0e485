r"""Web archives: written by Spark's text writer, read back with a verified chain of records.

Writing: one record per page; of equal payloads only one is stored, the others refer to it. Records end
with the archive's own record end (two line ends), which is the writer's line separator.

Reading: files are split at the magic line that opens a record, in parallel and also inside payloads that
happen to hold it. Each piece is a candidate record with the offset of its successor (by its declared
length). From the start of each file, pointer jumping doubles the reach of every candidate until only
the records of the chain are marked; pieces in between are given back to the payload they belong to.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from maskloom.llm.common import arrow_map, need, small_side
from maskloom.session import materialize, shared_folder

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
URN = "urn:maskloom:page:"
#: Records of a file at most; bounds the rounds of pointer jumping.
RECORDS = 10_000


def write_archives(pages: DataFrame, path: str, *, least: int = 100, records: int = RECORDS) -> None:
    """One record per row of ``pages`` (page_id, url, html): the html in UTF-8 is the payload (null: empty).

    Of records with equal payloads of ``least`` bytes or more, those with the smallest page_id are
    responses and the others revisit it; smaller payloads are all responses. Other columns are left out.
    """
    rows = need(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("id"), F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"n": F.octet_length("html"), "digest": F.sha2("html", 256)})
    first = rows.where(F.col("n") >= least).groupBy("digest").agg(
        F.min("id").alias("first"), F.count("*").alias("copies")).where("copies > 1 AND first IS NOT NULL")
    first = materialize(first.select(F.col("digest").alias("same"), "first"))
    rows = rows.join(small_side(first, 120), (F.col("digest") == F.col("same")) & (F.col("n") >= least), "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n").cast("string"), F.lit(END))
    body = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("html")))
    name = lambda c: F.concat(F.lit(f"<{URN}"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    record = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(again, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Record-ID: "), name("id"),
        F.lit("\r\nWARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]+", " "),
        F.when(again, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
                  "\r\nWARC-Refers-To: "), name("first"))).otherwise(F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit(END), body)
    rows.select(record.alias("value")).write.option("lineSep", END).option(
        "maxRecordsPerFile", records).text(path)


# -- reading ----------------------------------------------------------------------------------------

FIELDS = re.compile(rb"(?m)^([!-9;-~]+):[ \t]*([^\r\n]*)\r?$")


def parsed(piece: bytes) -> tuple[dict[bytes, bytes], int, int] | None:
    """Fields, start and length of the block of a candidate; nothing where it is no record."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {k.lower(): v.strip() for k, v in FIELDS.findall(piece[:end])}
    length = fields.get(b"content-length", b"")
    return (fields, end + 4, int(length)) if length.isdigit() and len(length) < 16 else None


def page_of(name: bytes) -> int | None:
    digits = name.strip(b"<>").removeprefix(URN.encode())
    return int(digits) if digits.lstrip(b"-").isdigit() else None


def described(piece: bytes) -> dict:
    """What a whole record says, with length and digest of its payload (a revisit's from its headers)."""
    fields, start, length = parsed(piece)
    block = piece[start : start + length]
    end = block.find(b"\r\n\r\n")
    http = {k.lower(): v for k, v in FIELDS.findall(block[: max(end, 0)])}
    payload = block[end + 4 :] if end >= 0 else block
    kind = fields.get(b"warc-type", b"").decode()
    stated = fields.get(b"warc-payload-digest", b"").removeprefix(b"sha256:").decode()
    digest = hashlib.sha256(payload).hexdigest()
    revisit = kind == "revisit"
    return {
        "page_id": page_of(fields.get(b"warc-record-id", b"")), "record_type": kind,
        "payload_bytes": int(http.get(b"content-length", b"0")) if revisit else len(payload),
        "payload_digest": stated if revisit else digest,
        "refers_to": page_of(fields.get(b"warc-refers-to", b"")) if revisit else None,
        "url": fields.get(b"warc-target-uri", b"").decode("utf-8", "replace"),
        "digest_ok": revisit or stated == digest}


RECORD = ("page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, "
          "url string, digest_ok boolean")
NAMES = [c.split()[0] for c in RECORD.split(", ")]
PIECE = f"file string, block long, number long, rel long, size long, succ long, whole boolean, {RECORD}"


def numbered(batches: Iterator[dict]) -> Iterator[tuple[dict, int, str, int, int, bytes]]:
    """Each piece with its file, block and number within the block; a block's pieces come in order."""
    last, number = None, 0
    for batch in batches:
        files, starts = batch["file"].to_pylist(), batch["block"].to_pylist()
        for i, here in enumerate(zip(files, starts)):
            number = number + 1 if here == last else 0
            last = here
            yield here[0], here[1], number, batch["value"][i].as_py()


def split_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Pieces with their place in the block, their successor's distance, and records that are whole."""

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        names = PIECE.replace(",", "").split()[::2]
        out, here, rel = {c: [] for c in names}, None, 0
        for file, block, number, raw in numbered(batches):
            if (file, block) != here:
                here, rel = (file, block), 0
            found = parsed(raw)
            succ = found[1] + found[2] + 4 if found else None  # from the end of the magic line
            whole = succ is not None and succ == len(raw) and raw.endswith(b"\r\n\r\n")
            row = {"file": file, "block": block, "number": number, "rel": rel, "size": len(raw), "succ": succ,
                   "whole": whole} | (described(raw) if whole else {})
            for c in names:
                out[c].append(row.get(c))
            rel += len(raw) + len(MAGIC)
            if len(out["file"]) >= 1000:
                yield out
                out = {c: [] for c in names}
        yield out

    return arrow_map(split_files(spark, path), work, PIECE)


def reached(nodes: DataFrame) -> DataFrame:
    """Offsets on the chain from each file's start. ``nodes``: file, off, succ (offset).

    In each round every node learns where twice its present distance leads, and what marked nodes point
    at is marked, so the marks reach all of a chain of n records after log2(n) rounds.
    """
    state = materialize(nodes.select("file", "off", F.col("succ").alias("jump"), (F.col("off") == 0).alias("hit")))
    while True:
        ahead = state.select("file", F.col("off").alias("jump"), F.col("jump").alias("next"))
        step = state.join(ahead, ["file", "jump"], "left").select("file", "off", "jump", "next", "hit")
        marks = step.where("hit").select("file", F.col("jump").alias("off")).distinct().withColumn("mark", F.lit(True))
        state = materialize(step.join(marks, ["file", "off"], "left").select(
            "file", "off", F.col("next").alias("jump"), (F.col("hit") | F.coalesce("mark", F.lit(False))).alias("hit")))
        if not state.where("hit AND jump IS NOT NULL").take(1):
            return state.where("hit").select("file", "off")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives below ``path`` that lie on the chain from their file's start.

    Columns: page_id, record_type, payload_bytes, payload_digest (of the payload as read; a revisit's as
    stated), refers_to, url, digest_ok (stated and actual digest agree). Magic lines inside payloads
    start no record. Where a chain breaks (a truncated file), the records before the break are returned.
    No files with records give no rows.
    """
    pieces = materialize(candidates(spark, path))
    spans = pieces.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    base = spans.select("file", "block", F.coalesce(F.sum("bytes").over(
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    # the first piece of a file stands before its first magic line
    placed = materialize(pieces.join(small_side(base, 200), ["file", "block"]).withColumn(
        "off", F.col("base") + F.col("rel") - len(MAGIC)).withColumn(
        "succ", F.col("off") + len(MAGIC) + F.col("succ")).drop("base", "rel").where("off >= 0"))
    chain = reached(placed.select("file", "off", "succ"))
    real = placed.join(chain.withColumn("real", F.lit(True)), ["file", "off"], "left")
    done = real.where("real AND whole").select(*NAMES)
    parts = real.select("file", "block", "number", "off", "size", "whole", "real", "succ").withColumn(
        "own", F.last(F.when(F.col("real"), F.struct("off", "whole", "succ")), True).over(
            Window.partitionBy("file").orderBy("off").rowsBetween(Window.unboundedPreceding, 0)))
    parts = materialize(parts.where("NOT own.whole AND off < own.succ").select(
        "file", "block", "number", "off", F.col("own.off").alias("start")))
    if not parts.take(1):
        return done

    def again(batches: Iterator[dict]) -> Iterator[dict]:
        for file, block, number, raw in numbered(batches):
            yield {"file": [file], "block": [block], "number": [number], "value": [raw]}

    texts = arrow_map(split_files(spark, path), again, "file string, block long, number long, value binary")
    both = texts.join(small_side(parts, 200), ["file", "block", "number"]).groupBy("file", "start").agg(
        F.array_sort(F.collect_list(F.struct("off", "value"))).alias("parts"))

    def glued(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            rows = []
            for parts in batch["parts"]:
                whole = MAGIC.encode().join(x.as_py() for x in parts.values.field("value"))
                if parsed(whole) and len(whole) >= sum(parsed(whole)[1:]):
                    rows.append(described(whole))
            yield {c: [r[c] for r in rows] for c in NAMES}

    return done.unionByName(arrow_map(both.select("parts"), glued, RECORD))


def archive_round_trip(pages: DataFrame, *, least: int = 100, records: int = RECORDS) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read these back; see both functions."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/maskloom-warc-{uuid.uuid4().hex}"
    write_archives(pages, path, least=least, records=records)
    return read_archives(spark, path)
