"""Removal of long repeated byte strings by suffix arrays over shards.

Whole texts cannot meet in one suffix array, so equal strings are first brought together. A window of
``length`` bytes is represented by its least ``GRAM``-byte string (by hash, leftmost), its *anchor*;
equal windows have equal anchors at the same place. The windows of one anchor are consecutive and form
a *region*; every window lies in exactly one region.

1. Tasks emit regions: hash of the anchor, fingerprint of the region's bytes, place.
2. Anchors found once cannot hold a repeated window and go. Equal regions are counted, not compared:
   a region found twice is repeated as a whole.
3. Anchors with different regions go on with the bytes of one region of each kind. Where an anchor still
   has very many kinds (a common phrase), its regions are cut in halves named by the longer string that
   all windows of a half share, again and again, so no group outgrows a shard.
4. A shard sorts the suffixes of its regions by induced sorting; permuted common prefixes of ``length`` or
   more mark the windows that occur elsewhere.
5. Marks go back to all places of a kind of region, and texts lose the marked bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm.common import as_array, arrow_map, blocks, mix64, need, signed, text_key
from maskloom.llm.sais import permuted_prefixes, suffix_array
from maskloom.session import materialize

LENGTH, GRAM = 200, 100
#: Bytes of regions that one suffix array holds, on average.
SHARD_BYTES = 1 << 20
#: Kinds of region of one anchor from which its regions are cut.
KINDS = 1000
#: Windows of a text that are anchored at once; more are handled piece by piece.
PIECE = 1 << 20
BASE = 0x9E3779B97F4A7C15
PLACE = np.int64((1 << 24) - 1)


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def gram_hashes(data: np.ndarray, up: np.ndarray, down: np.ndarray, gram: int) -> np.ndarray:
    """Scrambled hash of the ``gram`` bytes from each place on."""
    n = len(data) - gram + 1
    total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
    return mix64((total[gram:] - total[:-gram]) * down[:n])


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive keys, from least values of blocks up to and from each place."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, 1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def regions_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, tables, length: int, gram: int):
    """Regions of the texts in a block: text number, anchor hash, first window, windows, anchor's place."""
    span = length - gram + 1
    hashes = gram_hashes(data, *tables, gram)
    keys = (hashes & ~np.uint64(PLACE)) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (sliding_least(keys, span) & np.uint64(PLACE)).astype(np.int64)
    windows = np.maximum(sizes - length + 1, 0)
    text = np.repeat(np.arange(len(sizes)), windows)
    first = np.cumsum(windows) - windows
    window = np.arange(len(text)) - np.repeat(first, windows) + np.repeat(starts, windows)
    anchor = anchor[window]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))[: len(text)]
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(text)))
    return text[at], hashes[anchor[at]], window[at], count, anchor[at]


def anchored(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """d, th (the text), h (anchor), r (fingerprint), n (windows), a (anchor after the first window), lo."""

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        tables = [np.zeros(0, np.uint64)] * 2
        for batch in batches:
            every = [x or b"" for x in batch["t"].cast(pa.binary()).to_pylist()]
            for a, b in blocks([len(t) for t in every], PIECE):
                for cut in range(0, max(1, max(len(t) for t in every[a:b]) - length + 1), PIECE):
                    texts = [t[cut : cut + PIECE + length - 1] for t in every[a:b]]
                    sizes = np.array([len(t) for t in texts], np.int64)
                    if sizes.max() < length:
                        continue
                    data = b"".join(texts)
                    if len(data) > len(tables[0]):
                        tables = [powers(len(data) * 5 // 4, BASE),
                                  powers(len(data) * 5 // 4, pow(BASE, -1, 1 << 64))]
                    starts = np.cumsum(sizes) - sizes
                    text, h, lo, n, anchor = regions_of(
                        np.frombuffer(data, np.uint8), starts, sizes, tables, length, gram)
                    prints = [xxhash.xxh3_64_intdigest(data[x : x + y + length - 1])
                              for x, y in zip(lo.tolist(), n.tolist())]
                    row = pa.array(text + a, pa.int64())
                    yield {"d": batch["d"].take(row), "th": batch["th"].take(row), "h": signed(h),
                           "r": np.array(prints, np.uint64).view(np.int64), "n": n, "a": anchor - lo,
                           "lo": lo - starts[text] + cut}

    return arrow_map(docs, work, "d long, th long, h long, r long, n int, a int, lo long")


def packed(docs: DataFrame) -> DataFrame:
    """Texts as compressed bytes, as they are shuffled whole."""
    def work(batches: Iterator[dict]) -> Iterator[dict]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            yield {"d": batch["d"], "th": batch["th"],
                   "z": [pack(x or b"") for x in batch["t"].cast(pa.binary()).to_pylist()]}

    return arrow_map(docs, work, "d long, th long, z binary")


REGION = "h long, r long, n int, at int, a int, key long, bytes binary"


def fetch(kinds: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """Bytes of one region of each kind. ``kinds``: h, r, n, a, rep (d, th, lo)."""
    asked = kinds.groupBy(F.col("rep.d").alias("d"), F.col("rep.th").alias("th")).agg(
        F.collect_list(F.struct("h", "r", "n", "a", F.col("rep.lo").alias("lo"))).alias("asked"))
    texts = packed(docs).withColumnsRenamed({"d": "zd", "th": "zth"})
    both = asked.join(texts, F.col("d").eqNullSafe(F.col("zd")) & (F.col("th") == F.col("zth"))).select(
        "asked", "z")

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for i in range(len(batch["z"])):
                text, asked = unpack(batch["z"][i].as_py()), batch["asked"][i].values
                part = {c: asked.field(c).to_numpy() for c in ("h", "r", "n", "a", "lo")}
                yield {**{c: part[c] for c in ("h", "r", "n", "a")}, "at": np.zeros(len(part["h"]), int),
                       "key": part["h"],
                       "bytes": [text[x : x + y + length - 1] for x, y in zip(part["lo"].tolist(), part["n"].tolist())]}

    return arrow_map(both, work, REGION)


def halved(regions: DataFrame, length: int, gram: int, level: int) -> DataFrame:
    """Regions cut at an anchor-relative place of this level, each half named by what its windows share."""
    span = length - gram
    cells = 1 << level

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            out = {c: [] for c in ("h", "r", "n", "at", "a", "key", "bytes")}
            rows = zip(*(batch[c].to_pylist() for c in ("h", "r", "n", "at", "a", "key", "bytes")))
            for h, r, n, at, a, key, raw in rows:
                # the anchor lies a - j bytes into window j; windows of one cell of that distance share bytes
                cell = ((a - np.arange(n)) * cells) // (span + 1)
                edge = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
                for s, e in zip(edge.tolist(), [*edge[1:].tolist(), n]):
                    c = int(cell[s])
                    near, far = -(-c * (span + 1) // cells), ((c + 1) * (span + 1) - 1) // cells
                    shared = raw[max(0, a - near) : a + gram + span - far]
                    name = xxhash.xxh3_64_intdigest(b"%d,%d," % (level, c) + shared)
                    for k, v in zip(out, (h, r, e - s, at + s, a - s, name, raw[s : e + length - 1])):
                        out[k].append(v)
            out["key"] = np.array(out["key"], np.uint64).view(np.int64)
            yield out

    return arrow_map(regions, work, REGION)


SPANS = "h long, r long, first int, last int"


def repeated_windows(shard: pa.Table, length: int) -> pa.Table:
    """Runs of windows of a shard's regions that occur elsewhere in the shard.

    Two suffixes count as alike within one group (``key``) or across groups: either way the windows are
    equal, and no window of a text is in two regions.
    """
    target = pa.schema([("h", pa.int64()), ("r", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])
    raw = shard.column("bytes").to_pylist()
    sizes = np.array([len(x) + 1 for x in raw], np.int64)
    text = np.append(np.frombuffer(b"\x00".join(raw) + b"\x00", np.uint8).astype(np.int64) + 2, 0)
    ends = np.cumsum(sizes)
    text[ends - 1] = 1
    array = suffix_array(text, 258)
    room = np.append(np.repeat(ends - 1, sizes) - np.arange(len(text) - 1), 0)
    shared = permuted_prefixes(text, array, room)
    alike = np.zeros(len(text), bool)
    hit = np.flatnonzero(shared[array] >= length)
    alike[array[hit]] = True
    alike[array[hit - 1]] = True
    starts = ends - sizes
    edge = np.diff(np.concatenate([[0], alike.view(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    row = np.searchsorted(ends, first, side="right")
    base = shard.column("at").to_numpy()[row] - starts[row]
    columns = {"h": shard.column("h").to_numpy()[row], "r": shard.column("r").to_numpy()[row],
               "first": first + base, "last": last + base}
    return pa.table([as_array(columns[f.name], f.type) for f in target], schema=target)


def sorted_spans(regions: DataFrame, length: int, gram: int, shard_bytes: int, kinds: int) -> DataFrame:
    """Runs of repeated windows (h, r, first, last) of regions whose anchors have several kinds."""
    regions, done, alone, level = materialize(regions), [], None, 0
    while True:
        sizes = regions.groupBy("key").agg(F.count("*").alias("c"))
        several = regions.join(sizes.where("c > 1"), "key")
        done.append(several.where(F.col("c") <= kinds).drop("c"))
        large = materialize(several.where(F.col("c") > kinds).drop("c"))
        if not large.take(1):
            break
        if 1 << level > length - gram:  # each is one window, and all of a group are equal
            alone = large.select("h", "r", F.col("at").alias("first"), (F.col("at") + F.col("n")).alias("last"))
            break
        level += 1
        regions = materialize(halved(large, length, gram, level))
    ready = done[0]
    for more in done[1:]:
        ready = ready.unionByName(more)
    ready = materialize(ready)
    total = ready.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = int(total // shard_bytes) + 1
    dealt = ready.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    found = dealt.groupBy("shard").applyInArrow(lambda t: repeated_windows(t, length), SPANS)
    return found.unionByName(alone) if alone is not None else found


OUTPUTS = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string", "kept": "binary"}


def remove_repeats(
    docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES,
    kinds: int = KINDS, outputs: tuple[str, ...] = ("n_bytes", "n_removed", "n_spans", "kept"),
) -> DataFrame:
    """Remove each byte covered by a string of ``length`` bytes that also starts anywhere else.

    ``docs`` needs ``doc_id`` and ``text``; texts are UTF-8 bytes (null: empty), strings do not cross
    texts, overlapping occurrences count, and all is judged on the input. One row per input row: doc_id
    and ``outputs`` of ``OUTPUTS`` (n_spans: maximal removed runs); other columns are left out. A null
    doc_id is an id like any other; a repeated row is another occurrence of its strings. Texts shorter
    than ``length`` lose nothing.
    """
    if not 0 < gram <= length // 2:
        raise ValueError("gram must be at most half of length")
    texts = need(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("d"), text_key("text").alias("th"), F.col("text").alias("t"))
    every = materialize(anchored(texts, length, gram))
    twice = every.groupBy("h").count().where("count > 1").select("h")
    places = materialize(every.join(twice, "h", "left_semi"))
    kind = materialize(places.groupBy("h", "r", "n", "a").agg(
        F.count("*").alias("c"), F.min(F.struct("d", "th", "lo")).alias("rep")))
    # kinds found twice are repeated as a whole: only one found once has something to learn
    several = kind.groupBy("h").agg(F.count("*").alias("kinds"), F.min("c").alias("least")).where(
        "kinds > 1 AND least = 1").select("h")
    found = sorted_spans(fetch(kind.join(several, "h", "left_semi"), texts, length), length, gram, shard_bytes, kinds)
    whole = kind.where("c > 1").select("h", "r", F.lit(0).alias("first"), F.col("n").alias("last"))
    spans = materialize(whole.unionByName(found)).groupBy("h", "r").agg(
        F.collect_set(F.struct("first", "last")).alias("spans"))
    gone = places.join(spans, ["h", "r"]).select("d", "th", "lo", F.explode("spans").alias("s")).select(
        F.col("d").alias("gd"), F.col("th").alias("gth"), F.struct(
            (F.col("lo") + F.col("s.first")).alias("x"), (F.col("lo") + F.col("s.last") + (length - 1)).alias("y")
        ).alias("g")).groupBy("gd", "gth").agg(F.collect_set("g").alias("gone"))
    both = packed(texts).join(gone, F.col("d").eqNullSafe(F.col("gd")) & (F.col("th") == F.col("gth")), "left")

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = {o: [] for o in outputs}
            for z, gone in zip(batch["z"], batch["gone"]):
                text = unpack(z.as_py())
                kept, n_spans = text, 0
                if gone.is_valid:
                    x, y = (gone.values.field(k).to_numpy() for k in ("x", "y"))
                    order = np.lexsort((y, x))
                    x, y = x[order], np.maximum.accumulate(y[order])
                    new = np.append(True, x[1:] > y[:-1])
                    x, y = x[new], y[np.append(np.flatnonzero(new)[1:] - 1, len(y) - 1)]
                    n_spans = len(x)
                    edges = [0, *np.stack([x, y], 1).reshape(-1).tolist(), len(text)]
                    kept = b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2])])
                values = {"n_bytes": len(text), "n_removed": len(text) - len(kept), "n_spans": n_spans, "kept": kept}
                for o in outputs:
                    out[o].append(hashlib.sha256(kept).hexdigest() if o == "kept_sha256" else values[o])
            yield {"doc_id": batch["d"], **out}

    schema = ", ".join(["doc_id long", *(f"{o} {OUTPUTS[o]}" for o in outputs)])
    return arrow_map(both.select("d", "z", "gone"), work, schema)
