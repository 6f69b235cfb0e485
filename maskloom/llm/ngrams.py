"""Modified Kneser-Ney models counted and estimated in Spark, looked up in sorted hash arrays.

An n-gram of ``order`` symbols is one 64-bit code of ``bits`` bits a symbol, the last symbol lowest, and 0
stands for the places before a text. Tasks count codes with a sort of each block, Spark sums them with a
combine before the shuffle. Lower orders count distinct left neighbours. Every distinct code of the
scored texts gets its loss (minus natural logarithm of its probability) by joins of these count
tables, back-off included, so scoring a position is one lookup of its code.
"""

from __future__ import annotations

import json
import mmap
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskloom.llm.common import filesystem, small_side
from maskloom.session import RUN, materialize, shared_folder

#: Discounts where a table is too small to estimate them.
PLAIN = (0.5, 1.0, 1.5)
#: Entries of a file of losses, about 24 bytes each, as one task sorts them.
BLOCK_ENTRIES = 2_000_000
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def codes_of(symbols: np.ndarray, starts: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Code of the n-gram ending at each position; ``starts`` are the texts' first positions.

    ``symbols`` are 1 or more; n-grams do not reach across texts.
    """
    out = symbols.astype(np.uint64)
    n = len(out)
    position = np.arange(n, dtype=np.int64)
    lengths = np.diff(np.append(starts, n))
    offset = position - np.repeat(starts, lengths)
    base = out.copy()
    for k in range(1, min(order, n)):
        shifted = base[:-k] << np.uint64(bits * k)
        shifted[offset[k:] < k] = 0
        out[k:] |= shifted
    return out


def count_codes(codes: np.ndarray, weight: np.ndarray | None = None):
    """Distinct codes with their counts, and the counts of the marked positions."""
    if weight is None:
        return (*np.unique(codes, return_counts=True), None)
    tagged = np.sort((codes << np.uint64(1)) | weight.astype(np.uint64))
    code = tagged >> np.uint64(1)
    starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, int)
    n = np.diff(np.append(starts, len(code)))
    marked = np.add.reduceat((tagged & np.uint64(1)).astype(np.int64), starts) if len(code) else n
    return code[starts], n, marked


def merge_counts(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One table of codes and both counts from several."""
    code = np.concatenate([p[0] for p in parts])
    order = np.argsort(code, kind="stable")
    code = code[order]
    starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    n, m = (np.add.reduceat(np.concatenate([p[k] for p in parts])[order], starts) for k in (1, 2))
    return code[starts], n, m


def suffix(code: Column, k: int, bits: int) -> Column:
    return code.bitwiseAND(F.lit((1 << (bits * k)) - 1))


def context(code: Column, k: int, bits: int) -> Column:
    return F.shiftright(suffix(code, k, bits), bits)


def discounts(grams: dict[int, DataFrame]) -> DataFrame:
    """g, k, d1, d2, d3: the discounts of each group and order, from its counts of counts."""
    every = union_all([df.select("g", "n").withColumn("k", F.lit(k)) for k, df in grams.items()])
    pieces = [F.sum(F.when(F.col("n") == i, 1).otherwise(0)).alias(f"n{i}") for i in (1, 2, 3, 4)]
    few = every.groupBy("g", "k").agg(*pieces)
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

    def rate(i: int) -> Column:
        a, b = F.col(f"n{i}"), F.col(f"n{i + 1}")
        value = i - (i + 1) * y * F.try_divide(b, a)
        good = (F.col("n1") > 0) & (a > 0) & (b > 0) & (value > 0) & (value < i)
        return F.when(good, value).otherwise(PLAIN[i - 1])

    return materialize(few.select("g", "k", *[rate(i).alias(f"d{i}") for i in (1, 2, 3)]))


def losses(counts: DataFrame, order: int, bits: int, weight: str, vocabulary: int | None = None) -> DataFrame:
    """Loss of every (g, code) of ``counts`` under the model of the counts in column ``weight``.

    ``counts`` has ``g`` (group, not null), ``code`` and counts; codes with a zero weight get the loss
    the model gives to unseen n-grams. A group without any weight gives all its codes the same loss.
    Unigrams are interpolated with 1 / ``vocabulary`` (by default the group's own distinct symbols and one
    for all others), seen or not. Returns g, code, loss. All n-grams with one context meet in a task: at most as many as there are
    symbols.
    """
    grams = {order: counts.where(F.col(weight) > 0).select("g", "code", F.col(weight).alias("n"))}
    for k in range(order - 1, 0, -1):
        grams[k] = (grams[k + 1].groupBy("g", suffix(F.col("code"), k, bits).alias("code"))
                    .agg(F.count("*").alias("n")))
    rates = discounts(grams)
    base = F.lit(vocabulary) if vocabulary else F.col("kinds") + 1
    d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    seen: dict[int, DataFrame] = {}
    for k in range(1, order + 1):
        own = Window.partitionBy("g", "c")
        rows = grams[k].join(small_side(rates.where(F.col("k") == k).drop("k"), 48), "g").select(
            "g", "code", "n", d.alias("d"), context(F.col("code"), k, bits).alias("c")).withColumns({
                "total": F.sum("n").over(own), "freed": F.sum("d").over(own), "kinds": F.count("*").over(own)})
        w = F.col("freed") / F.col("total")
        if k == 1:
            lower = 1 / base
        else:
            rows = rows.withColumn("s", suffix(F.col("code"), k - 1, bits)).join(
                seen[k - 1].select("g", F.col("code").alias("s"), F.col("p").alias("lower")), ["g", "s"])
            lower = F.col("lower")
        seen[k] = materialize(rows.select(
            "g", "code", "c", ((F.col("n") - F.col("d")) / F.col("total") + w * lower).alias("p"), w.alias("w"),
            "kinds"))
    top = seen[order].select("g", "code", (-F.log("p")).alias("loss"))
    unseen = counts.where(F.coalesce(F.col(weight), F.lit(0)) <= 0).select("g", "code")
    # what an unseen code needs: its suffixes' probabilities, its contexts' weights, the group's base
    known = [seen[k].select("g", F.lit(k).alias("k"), F.col("code").alias("key"), F.col("p").alias("v")) for k in seen]
    known += [seen[k].select("g", F.lit(-k).alias("k"), F.col("c").alias("key"), F.col("w").alias("v")).distinct()
              for k in seen if k > 1]
    known.append(seen[1].select("g", F.lit(0).alias("k"), F.lit(0).cast("long").alias("key"),
                                (F.col("w") / base).alias("v")).distinct())
    code = F.col("code")
    keys = [(k, suffix(code, k, bits)) for k in range(1, order + 1)]
    keys += [(-k, context(code, k, bits)) for k in range(2, order + 1)] + [(0, F.lit(0).cast("long"))]
    asked = unseen.select("g", "code", F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), key.alias("key")) for k, key in keys])).alias("x")).select(
            "g", "code", "x.k", "x.key")
    found = asked.join(union_all(known), ["g", "k", "key"], "left").groupBy("g", "code").agg(*[
        F.max(F.when(F.col("k") == k, F.col("v"))).alias(f"v{k}") for k, _ in keys])
    q = F.coalesce("v0", F.lit(1 / (vocabulary or 257)))
    for k in range(1, order + 1):
        q = F.coalesce(f"v{k}", F.col(f"v{-k}") * q, q) if k > 1 else F.coalesce("v1", q)
    return top.unionByName(found.select("g", "code", (-F.log(q)).alias("loss")))


class Arrays:
    """Values by hashed key, for each group: sorted hashes, an index of their leading bits, values."""

    def __init__(self, of: dict | None = None) -> None:
        self.of = {} if of is None else of

    def fill(self, groups: np.ndarray, codes: np.ndarray, values: np.ndarray, of: list | None = None) -> Arrays:
        """``groups`` are names, or numbers of the names in ``of``."""
        order = np.argsort(groups, kind="stable")
        groups, codes, values = groups[order], codes[order], values[order]
        names, starts = np.unique(groups, return_index=True) if len(groups) else ([], [])
        for name, a, b in zip(names, starts, [*starts[1:], len(groups)]):
            keys = codes[a:b].astype(np.uint64) * SPREAD
            at = np.argsort(keys)
            keys = keys[at]
            lead = max(1, int(b - a).bit_length())
            index = np.searchsorted(keys >> np.uint64(64 - lead), np.arange(1 << lead, dtype=np.uint64))
            self.of[str(of[name] if of else name)] = (keys, index.astype(np.int32), np.uint64(64 - lead),
                                  values[a:b][at].astype(np.float32))
        return self

    def get(self, group: str, codes: np.ndarray) -> np.ndarray:
        """Values of codes; 0 where a code is not in this block."""
        width = next((v[3].shape[1:] for v in self.of.values()), ())
        out = np.zeros((len(codes), *width), np.float32)
        if group not in self.of:
            return out
        keys, index, shift, values = self.of[group]
        wanted = codes * SPREAD
        at = index[(wanted >> shift).astype(np.int64)]
        at = np.minimum(at, len(keys) - 1)
        found = keys[at] == wanted
        out[found] = values[at[found]]
        left = np.flatnonzero(~found)
        at, wanted = at[left], wanted[left]
        while len(left):
            at = at + 1
            inside = at < len(keys)
            left, at, wanted = left[inside], at[inside], wanted[inside]
            here = keys[at]
            found = here == wanted
            out[left[found]] = values[at[found]]
            more = here < wanted
            left, at, wanted = left[more], at[more], wanted[more]
        return out


def write_arrays(table: DataFrame, *columns: str, entries: int | None = None) -> list[str]:
    """Files of the sorted arrays of a (g, code, values) table, one for each remainder of the codes.

    Tasks build and write them in the shared folder, each holding about ``entries`` entries; only their paths
    come back. ``FileArrays`` looks codes up in all of them.
    """
    spark = table.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/{RUN}/{uuid.uuid4().hex}"
    shards = max(1, -(-table.count() // (entries or BLOCK_ENTRIES)))
    schema = pa.schema([("shard", pa.int64()), ("path", pa.string())])

    def build(rows: pa.Table) -> pa.Table:
        values = np.stack([rows.column(c).to_numpy() for c in columns], 1)
        names = rows.column("g").combine_chunks().dictionary_encode()
        if isinstance(names, pa.ChunkedArray):
            names = names.combine_chunks()
        arrays = Arrays().fill(names.indices.to_numpy(), rows.column("code").to_numpy().view(np.uint64),
                               values[:, 0] if len(columns) == 1 else values, names.dictionary.to_pylist())
        where, base = filesystem(folder)
        where.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.arrays"  # an attempt that is repeated writes another file
        with where.open_output_stream(f"{base}/{name}") as out:
            places, at = {}, 0
            for group, (keys, index, shift, found) in arrays.of.items():
                places[group] = [int(shift), list(found.shape[1:])]
                for part in (keys, index, found):
                    data = np.ascontiguousarray(part).tobytes()
                    out.write(data + bytes(-len(data) % 64))
                    places[group].append([at, part.size])
                    at += len(data) + -len(data) % 64
            tail = json.dumps(places).encode()
            out.write(tail + len(tail).to_bytes(8, "little"))
        return pa.table({"shard": rows.column("shard")[:1], "path": [f"{folder}/{name}"]}, schema=schema)

    dealt = table.select("g", "code", *[F.col(c).cast("float").alias(c) for c in columns],
                         F.pmod("code", F.lit(shards)).alias("shard"))
    made = dealt.groupBy("shard").applyInArrow(build, "shard long, path string")
    found = {r["shard"]: r["path"] for r in materialize(made).collect()}
    return [found.get(i, "") for i in range(shards)]


class FileArrays:
    """Values by group and code in the files of ``write_arrays``; pages of local files are shared by a machine's tasks."""

    def __init__(self, paths: list[str]) -> None:
        self.shards = [self._open(p) if p else Arrays() for p in paths]
        self.width = next((v[3].shape[1:] for s in self.shards for v in s.of.values()), ())

    @staticmethod
    def _open(path: str) -> Arrays:
        where, base = filesystem(path)
        if isinstance(where, arrow_fs.LocalFileSystem):
            with open(base, "rb") as file:
                data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        else:
            with where.open_input_stream(base) as file:
                data = file.read()
        size = int.from_bytes(data[-8:], "little")
        of = {}
        for group, (shift, width, keys, index, values) in json.loads(data[-8 - size : -8]).items():
            read = lambda place, kind: np.frombuffer(data, kind, place[1], place[0])
            of[group] = (read(keys, "<u8"), read(index, "<i4"), np.uint64(shift), read(values, "<f4").reshape(-1, *width))
        return Arrays(of)

    def get(self, group: str, codes: np.ndarray) -> np.ndarray:
        """Values of codes; 0 where a code is not in any file."""
        if len(self.shards) == 1:
            return self.shards[0].get(group, codes)
        out = np.zeros((len(codes), *self.width), np.float32)
        shard = (codes.view(np.int64) % len(self.shards)).astype(np.int64)
        for i, arrays in enumerate(self.shards):
            own = np.flatnonzero(shard == i)
            if len(own):
                out[own] = arrays.get(group, codes[own])
        return out


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
