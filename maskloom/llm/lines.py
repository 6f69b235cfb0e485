"""Line deduplication through a sharded minimal perfect hash.

1. Tasks cut texts into lines and hash each line's key to 128 bits; lines of about a thousand documents
   are packed into one row of arrays (a *pack*), so no later step moves a row per line.
2. Distinct hashes are counted (documents holding them, least document) with a combine before the
   shuffle, and dealt to shards by their bits. Each shard becomes one row: a minimal perfect hash in
   levels of bit arrays, and arrays of fingerprints, counts and least documents in its order.
3. Packs probe: for each shard a pack sends the hashes it holds, each once, as one row of bytes; the shard
   answers with what it holds about the repeated ones; the pack turns answers into the keys to drop per
   document. However often a line occurs, a pack asks for it once, so no line makes a hot shard.
4. Documents are joined with the keys they lose.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm.common import as_array, arrow_map, mix64, need, schema_of, signed
from maskloom.session import materialize
from pyspark.sql.pandas.types import to_arrow_schema

BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Distinct keys of a shard, on average; a shard's arrays take about 20 bytes a key.
SHARD_KEYS = 250_000
#: Lines of a pack; a document's lines may lie in several packs.
PACK_LINES = 50_000
LEVELS = 48
KEY = np.dtype([("a", "<u8"), ("b", "<u8")])


def line_key(line: bytes) -> bytes:
    """The line without blanks at both ends, A-Z in lower case."""
    return line.strip(BLANKS).lower()


def long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def hashed(keys: list[bytes]) -> np.ndarray:
    """128-bit hashes as pairs of 64-bit integers."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), KEY)


# -- minimal perfect hash ---------------------------------------------------------------------------

def slots(key: np.ndarray, level: int, size: int) -> np.ndarray:
    step = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    return (mix64(key + step) % np.uint64(size)).astype(np.int64)


def build_hash(key: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit arrays by level, and each key's place in 0..n-1; ``key`` holds distinct 64-bit integers.

    A level has about two bits a key. A key that is alone in its bit stays there, the others go on; the
    few left after the last level would be placed by ``LEVELS`` more, so none is lost.
    """
    bits, place, left, before = [], np.empty(len(key), np.int64), np.arange(len(key)), 0
    level = 0
    while len(left):
        if level >= 4 * LEVELS:
            raise ValueError("equal keys in one shard")
        size = max(64, -(-2 * len(left) // 64) * 64)
        at = slots(key[left], level, size)
        alone = np.bincount(at, minlength=size) == 1
        stays = alone[at]
        rank = np.cumsum(alone) - 1
        place[left[stays]] = before + rank[at[stays]]
        before += int(stays.sum())
        bits.append(np.packbits(alone, bitorder="little"))
        left = left[~stays]
        level += 1
    return bits, place


def probe_hash(bits: list[np.ndarray], key: np.ndarray) -> np.ndarray:
    """Places of keys; -1 for a key that falls through every level (then it is not a member)."""
    place, left, before = np.full(len(key), -1, np.int64), np.arange(len(key)), 0
    for level, packed in enumerate(bits):
        if not len(left):
            break
        alone = np.unpackbits(packed, bitorder="little").astype(bool)
        at = slots(key[left], level, len(alone))
        hit = alone[at]
        place[left[hit]] = before + (np.cumsum(alone) - 1)[at[hit]]
        before += int(alone.sum())
        left = left[~hit]
    return place


def joined_key(keys: np.ndarray) -> np.ndarray:
    return keys["a"] ^ mix64(keys["b"])


# -- steps ------------------------------------------------------------------------------------------

PACK = "pack string, docs binary, ends binary, lines binary"


def packs_of(docs: DataFrame, least: int) -> DataFrame:
    """Rows of about ``PACK_LINES`` keys: document ids, where each one's lines end, hashes of the keys.

    Only keys of ``least`` code points or more are kept, each once for a document.
    """

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        import uuid

        name, number = uuid.uuid4().hex, 0
        ids, ends, keys, total = [], [], [], 0

        def out():
            return {
                "pack": [f"{name}-{number}"], "docs": [np.array(ids, "<i8").tobytes()],
                "ends": [np.cumsum(np.array(ends, "<i8")).astype("<i8").tobytes()],
                "lines": [b"".join(keys)]}

        for batch in batches:
            texts = batch["t"].cast(pa.binary())
            for i, (doc, has) in enumerate(zip(batch["d"].to_pylist(), batch["t"].is_valid().to_pylist())):
                if not has or doc is None:
                    continue
                own = {k for k in map(line_key, texts[i].as_py().split(b"\n")) if long_enough(k, least)}
                if not own:
                    continue
                ids.append(doc)
                ends.append(len(own))
                keys.append(b"".join(map(xxhash.xxh3_128_digest, own)))
                total += len(own)
                if total >= PACK_LINES:
                    yield out()
                    ids, ends, keys, total, number = [], [], [], 0, number + 1
        if ids:
            yield out()

    return arrow_map(docs, work, PACK)


def unpack(batch: dict, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a pack, and the document of each."""
    keys = np.frombuffer(batch["lines"][i].as_py(), KEY)
    docs = np.frombuffer(batch["docs"][i].as_py(), "<i8")
    ends = np.frombuffer(batch["ends"][i].as_py(), "<i8")
    return keys, np.repeat(docs, np.diff(ends, prepend=0))


def line_counts(packs: DataFrame) -> DataFrame:
    """For each distinct hash the documents that hold it and the least of them."""

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for i in range(len(batch["pack"])):
                keys, docs = unpack(batch, i)
                keys, at, n = distinct(keys, docs)
                yield {"a": signed(keys["a"].copy()), "b": signed(keys["b"].copy()), "n": n, "doc": at}

    rows = arrow_map(packs, work, "a long, b long, n long, doc long")
    return rows.groupBy("a", "b").agg(F.sum("n").alias("n"), F.min("doc").alias("doc"))


def distinct(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with the least document and the number of documents, copies of a row counted once."""
    order = np.lexsort((docs, keys["b"], keys["a"]))
    keys, docs = keys[order], docs[order]
    if len(keys):
        same = (keys[1:] == keys[:-1]) & (docs[1:] == docs[:-1])
        kept = np.concatenate([[True], ~same])
        keys, docs = keys[kept], docs[kept]
    first = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    return keys[starts], docs[starts], np.diff(np.append(starts, len(keys)))


SHARD = "shard int, levels array<binary>, prints binary, counts binary, least binary"


def shards_of(counts: DataFrame, shards: int) -> DataFrame:
    """One row of arrays for each shard."""
    target = to_arrow_schema(schema_of(SHARD))

    def build(rows: pa.Table) -> pa.Table:
        keys = np.empty(rows.num_rows, KEY)
        for c in "ab":
            keys[c] = rows.column(c).to_numpy().view(np.uint64)
        bits, place = build_hash(joined_key(keys))
        order = np.argsort(place)
        columns = {
            "shard": [rows.column("shard")[0].as_py()], "levels": [[x.tobytes() for x in bits]],
            "prints": [(keys["b"][order] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()],
            "counts": [np.minimum(rows.column("n").to_numpy()[order], 255).astype("u1").tobytes()],
            "least": [rows.column("doc").to_numpy()[order].astype("<i8").tobytes()]}
        return pa.table([as_array(columns[f.name], f.type) for f in target], schema=target)

    dealt = counts.withColumn("shard", F.pmod(F.col("a"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(build, SHARD)


def requests_of(packs: DataFrame, shards: int) -> DataFrame:
    """For each pack and shard the pack's distinct hashes that belong to the shard."""

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for i, pack in enumerate(batch["pack"].to_pylist()):
                keys = np.unique(unpack(batch, i)[0])
                shard = signed(keys["a"].copy()) % shards
                order = np.argsort(shard, kind="stable")
                keys, shard = keys[order], shard[order]
                starts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
                stops = np.append(starts[1:], len(keys))
                yield {"shard": shard[starts], "pack": [pack] * len(starts),
                       "keys": [keys[a:b].tobytes() for a, b in zip(starts, stops)]}

    return arrow_map(packs, work, "shard int, pack string, keys binary")


ANSWER = "pack string, keys binary, least binary"


def answers_of(requests: DataFrame, index: DataFrame) -> DataFrame:
    """For each request its hashes held by two documents or more, with the least of these."""
    target = to_arrow_schema(schema_of(ANSWER))

    def answer(asked: pa.Table, shard: pa.Table) -> pa.Table:
        columns = {"pack": [], "keys": [], "least": []}
        if shard.num_rows:
            row = {c: shard.column(c)[0].as_py() for c in shard.column_names}
            bits = [np.frombuffer(x, "u1") for x in row["levels"]]
            prints, counts = np.frombuffer(row["prints"], "<u4"), np.frombuffer(row["counts"], "u1")
            least = np.frombuffer(row["least"], "<i8")
            for pack, blob in zip(asked.column("pack").to_pylist(), asked.column("keys").to_pylist()):
                keys = np.frombuffer(blob, KEY)
                at = probe_hash(bits, joined_key(keys))
                hit = at >= 0
                hit &= (prints[at] == (keys["b"] & np.uint64(0xFFFFFFFF))) & (counts[at] >= 2)
                if hit.any():
                    columns["pack"].append(pack)
                    columns["keys"].append(keys[hit].tobytes())
                    columns["least"].append(least[at[hit]].tobytes())
        return pa.table([as_array(columns[f.name], f.type) for f in target], schema=target)

    return requests.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(answer, ANSWER)


def losses_of(packs: DataFrame, answers: DataFrame) -> DataFrame:
    """For each document and pack the hashes that the document loses."""
    schema = "doc long, keys binary"
    target = to_arrow_schema(schema_of(schema))

    def settle(pack: pa.Table, found: pa.Table) -> pa.Table:
        columns = {"doc": [], "keys": []}
        if pack.num_rows and found.num_rows:
            row = {c: pack.column(c) for c in ("docs", "ends", "lines")}
            keys, docs = unpack(row, 0)
            known = np.concatenate([np.frombuffer(x, KEY) for x in found.column("keys").to_pylist()])
            least = np.concatenate([np.frombuffer(x, "<i8") for x in found.column("least").to_pylist()])
            order = np.argsort(known)
            known, least = known[order], least[order]
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            lost = (known[at] == keys) & (least[at] != docs)
            keys, docs = keys[lost], docs[lost]
            if len(keys):
                order = np.argsort(docs, kind="stable")
                keys, docs = keys[order], docs[order]
                starts = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
                stops = np.append(starts[1:], len(docs))
                columns = {"doc": docs[starts],
                           "keys": [keys[a:b].tobytes() for a, b in zip(starts, stops)]}
        return pa.table([as_array(columns[f.name], f.type) for f in target], schema=target)

    found = packs.groupBy("pack").cogroup(answers.groupBy("pack")).applyInArrow(settle, schema)
    return found.groupBy("doc").agg(F.collect_list("keys").alias("keys"))


OUTPUTS = {"n_lines": "long", "n_dropped": "long", "kept": "string", "kept_sha256": "string"}


def deduped(docs: DataFrame, least: int, keep: tuple[str, ...], outputs: tuple[str, ...]) -> DataFrame:
    """d, o (the columns of ``keep``) and ``outputs`` for each row of ``docs``."""
    plain = need(docs, "doc_id", "text")
    packs = materialize(packs_of(plain.select(F.col("doc_id").cast("long").alias("d"),
                                              F.col("text").alias("t")), least))
    counts = materialize(line_counts(packs))
    shards = max(1, counts.count() // SHARD_KEYS + 1)
    index = materialize(shards_of(counts, shards))
    lost = losses_of(packs, answers_of(requests_of(packs, shards), index))
    left = docs.select(F.col("doc_id").cast("long").alias("__d"), F.col("text").alias("__t"),
                       F.struct(*[F.col(c) for c in keep]).alias("__o") if keep
                       else F.lit(None).cast("string").alias("__o"))
    both = left.join(lost, F.col("__d") == F.col("doc"), "left").select("__d", "__t", "__o", "keys")
    other_type = both.schema["__o"].dataType.simpleString()

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            texts = batch["__t"].cast(pa.binary())
            result = {o: [] for o in outputs}
            for i, blobs in enumerate(batch["keys"].to_pylist()):
                text = texts[i].as_py() or b""
                lines = text.split(b"\n")
                kept = lines
                if blobs:
                    joined = b"".join(blobs)
                    gone = {joined[k : k + 16] for k in range(0, len(joined), 16)}
                    kept = [x for x in lines if xxhash.xxh3_128_digest(line_key(x)) not in gone
                            or not long_enough(line_key(x), least)]
                    text = b"\n".join(kept)
                for o in outputs:
                    result[o].append(
                        len(lines) if o == "n_lines" else len(lines) - len(kept) if o == "n_dropped"
                        else text.decode("utf-8", "replace") if o == "kept"
                        else hashlib.sha256(text).hexdigest())
            yield {"d": batch["__d"], "o": batch["__o"], **result}

    schema = ", ".join(["d long", f"o {other_type}", *(f"{o} {OUTPUTS[o]}" for o in outputs)])
    return arrow_map(both, work, schema)


def line_dedup(
    docs: DataFrame, *, least: int = 10,
    outputs: tuple[str, ...] = ("n_lines", "n_dropped", "kept"),
) -> DataFrame:
    r"""Drop lines that an earlier document holds.

    ``docs`` needs ``doc_id`` and ``text``. A text is split at ``\n`` (null or empty: one empty line). A
    line's key is the line without blanks at both ends, A-Z in lower case. Keys of ``least`` code points or
    more that two documents hold lose all their lines except in the smallest ``doc_id`` holding them;
    the other lines stay, joined by ``\n``.

    One row per input row: ``doc_id`` and ``outputs`` of ``OUTPUTS``; other columns are left out. A null ``doc_id`` neither loses lines nor makes others lose any.
    Repeated rows count as one document and are treated alike. No rows give no rows.
    """
    return deduped(docs, least, (), outputs).select(F.col("d").alias("doc_id"), *outputs)


def without_repeated_lines(docs: DataFrame, *, least: int = 10) -> DataFrame:
    """``docs`` with the kept lines as ``text`` (and their length as ``n_chars``, where that column is there).

    Documents that lose lines and have no word left are gone.
    """
    others = tuple(c for c in docs.columns if c != "text")
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    done = deduped(docs, least, others, ("n_dropped", "kept")).where(
        (F.col("n_dropped") == 0) | F.col("kept").rlike(r"[^\x20\x09-\x0D]"))
    return done.select(*[new.get(c, F.col("o")[c]).alias(c) for c in docs.columns])
