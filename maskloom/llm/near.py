"""Near-duplicate groups by a chosen-path similarity join over sets of word shingles.

Documents with equal sets are one *class*. In each of several independent trees a class follows the path
that its minwise tokens choose: the token at a coordinate picked for the node names the child. Nodes
small enough are compared exhaustively on full sets. A node that stays large is first compared in
pieces, each with the node's common pivots, which ties a tight group together with few comparisons; where
that leaves more than one group, the node branches again by tokens, and what is still large at the last
level is compared piece by piece. Within a piece, classes that are known to be connected are not compared
again, so a group of copies yields one link per member, not all pairs. Groups are the connected
components of the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskloom.llm.common import as_array, arrow_map, blocks, mix64, need, text_key
from maskloom.llm.ngrams import union_all
from maskloom.llm.repeats import packed
from maskloom.llm.rules import Hashes, window_hashes
from maskloom.session import materialize

#: Minwise tokens of a class, of which trees and levels pick theirs.
COORDINATES = 32
#: Further minwise tokens, kept as one byte each, for the comparison of pairs.
MARKS = 96
TREES = 6
LEVELS = 3
#: Classes that one task compares exhaustively, on average.
LEAF = 3000
#: Shingles that the classes of such a node have together at most.
LEAF_SHINGLES = 2_000_000
#: Equal tokens and marks, of all 128, from which a pair is compared on full sets.
ALIKE = 78
PIVOTS = 4
#: Hashes that are mixed at once.
CACHED = 1 << 16
#: Tokens that name a child at levels below the first, and children that a class enters there.
JOINT, CHILDREN = 2, 2
STEPS = (np.arange(1, COORDINATES + MARKS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def shingle_sets(texts: list[bytes], known: Hashes, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``width`` make one shingle."""
    parts = [t.lower().split() for t in texts]
    sizes = [len(p) for p in parts]
    words = np.fromiter((known[w] for p in parts for w in p), np.uint64, sum(sizes))
    windows = window_hashes(words, width)
    out, at = [], 0
    for n in sizes:
        if n >= width:
            own = np.sort(windows[at : at + n - width + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif n:
            out.append(window_hashes(words[at : at + n], n) ^ np.uint64(n))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def minwise(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Least value of each text's hashes under each of ``STEPS``, in pieces that stay in the processor's cache."""
    low = np.empty((len(starts), len(STEPS)), np.uint64)
    ends = np.append(starts[1:], len(flat))
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + CACHED, "right")))
        own, at = flat[starts[a] : ends[b - 1]], starts[a:b] - starts[a]
        mixed = np.empty_like(own)
        for k, s in enumerate(STEPS):
            np.bitwise_xor(own, s, out=mixed)
            np.multiply(mixed, s, out=mixed)
            low[a:b, k] = np.minimum.reduceat(mixed, at)
        a = b
    return low


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """d, th, n (set size), fp (128-bit fingerprint of the set), tokens and marks (minwise)."""

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        known = Hashes()
        for batch in batches:
            every = [x or b"" for x in batch["t"].cast(pa.binary()).to_pylist()]
            for a, b in blocks([len(t) for t in every]):
                sets = shingle_sets(every[a:b], known, width)
                sizes = np.array([len(s) for s in sets])
                full = np.flatnonzero(sizes)
                prints, tokens, marks = [b""] * len(sets), [[]] * len(sets), [b""] * len(sets)
                if len(full):
                    flat = np.concatenate([sets[i] for i in full])
                    starts = np.cumsum(sizes[full]) - sizes[full]
                    low = (mix64(minwise(flat, starts)) >> np.uint64(32)).astype(np.uint32)
                    few, rest = low[:, :COORDINATES].view(np.int32), low[:, COORDINATES:].astype(np.uint8)
                    one = np.add.reduceat(mix64(flat), starts)
                    two = np.bitwise_xor.reduceat(mix64(flat + np.uint64(1)), starts)
                    both = np.stack([one, two], 1).astype("<u8")
                    for k, i in enumerate(full):
                        prints[i], tokens[i], marks[i] = both[k].tobytes(), few[k], rest[k].tobytes()
                yield {"d": batch["d"].slice(a, b - a), "th": batch["th"].slice(a, b - a),
                       "n": sizes, "fp": prints, "tokens": tokens, "marks": marks}

    return arrow_map(docs, work, "d long, th long, n long, fp binary, tokens array<int>, marks binary")


LINK = "a binary, b binary"
#: Sets from which a set is compared with all at once before it is compared one by one.
FEW = 4


def similar(both: int, a: int, b: int, percent: int) -> bool:
    return 100 * both >= percent * (a + b - both)


def shared_at_most(a: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Bounds from above of the values that ``a`` shares with each other set, close ones: by their lowest bits."""
    mask = np.uint64((1 << (64 * len(a)).bit_length()) - 1)
    held = np.zeros(int(mask) + 1, np.uint8)
    held[a & mask] = 1
    sizes = np.array([len(x) for x in others])
    return np.add.reduceat(held[np.concatenate(others) & mask], np.cumsum(sizes) - sizes, dtype=np.int64)


def compare(rows: pa.Table, width: int, percent: int) -> pa.Table:
    """Links that join the classes of one piece: exhaustive but for pairs already connected.

    Known groups that turn out to be one are returned as links of the least label with each other label.
    Rows: fp, n, tokens, marks, z (packed text), label (known group), pivot (bool). Every pair is compared by
    its 128 minwise values; full sets decide on the pairs that agree in ``ALIKE`` of them (a pair at 80
    per cent agrees in fewer with a probability of about 1e-7, at 85 per cent of 1e-11) and whose sizes
    allow the threshold.
    """
    target = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    seen: dict[bytes, int] = {}
    pivots = rows.column("pivot").to_pylist()
    for i, (fp, pivot) in enumerate(zip(rows.column("fp").to_pylist(), pivots)):
        if fp not in seen or pivot:
            seen[fp] = i
    order = sorted(seen.values(), key=lambda i: not pivots[i])
    rows = rows.select(["label", "n", "tokens", "marks", "z"]).take(pa.array(order, pa.int64()))
    known: dict[bytes, int] = {}
    group = np.array([known.setdefault(x, len(known)) for x in rows.column("label").to_pylist()], np.int64)
    sizes = rows.column("n").to_numpy()
    tokens = rows.column("tokens").combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
    marks = np.frombuffer(b"".join(rows.column("marks").to_pylist()), np.uint8).reshape(-1, MARKS)
    texts, hashes, sets = rows.column("z"), Hashes(), {}
    unpack = zstandard.ZstdDecompressor().decompress

    def full(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingle_sets([unpack(texts[i].as_py())], hashes, width)[0]
        return sets[i]

    now = group.copy()
    for i in range(len(now) - 1):
        low, high = np.minimum(sizes[i + 1 :], sizes[i]), np.maximum(sizes[i + 1 :], sizes[i])
        others = np.flatnonzero((now[i + 1 :] != now[i]) & (100 * low >= percent * high)) + i + 1
        alike = np.count_nonzero(marks[others] == marks[i], 1)
        near = alike >= ALIKE - COORDINATES
        others, alike = others[near], alike[near]
        alike = alike + np.count_nonzero(tokens[others] == tokens[i], 1)
        others = others[alike >= ALIKE].tolist()
        if len(others) > FEW:
            most = shared_at_most(full(i), [full(j) for j in others])
            others = [j for j, n in zip(others, most.tolist()) if similar(n, len(full(i)), len(full(j)), percent)]
        for j in others:
            if now[i] == now[j]:
                continue
            a, b = full(i), full(j)
            both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
            if similar(both, len(a), len(b), percent):
                now[now == now[j]] = now[i]
        sets.pop(i, None)
    ends: dict[int, list[bytes]] = {}
    first = np.unique(group, return_index=True)[1]
    for label, g in zip(known, now[first].tolist()):
        ends.setdefault(g, []).append(label)
    links = [(least, x) for own in ends.values() for least in [min(own)] for x in own if x != least]
    return pa.table([as_array([x[k] for x in links], f.type) for k, f in enumerate(target)], schema=target)


def coordinate(seed: str, *parts: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(COORDINATES)).cast("int")


def roots(classes: DataFrame, trees: int) -> DataFrame:
    """First level: a class enters one child of each tree's root, named by one token."""
    picks = [int(x) for x in np.random.default_rng(7).permutation(COORDINATES)[:trees]]
    children = F.array(*[F.xxhash64(F.lit(c), F.col("tokens")[c]) for c in picks])
    return classes.select("fp", "n", F.explode(children).alias("node"))


def branches(members: DataFrame, classes: DataFrame, level: int) -> DataFrame:
    """Next level of large nodes: a class enters ``CHILDREN`` children, each named by ``JOINT`` tokens."""
    children = []
    for c in range(CHILDREN):
        tokens = [F.element_at("tokens", coordinate(f"{level}-{c}-{j}", F.col("node")) + 1)
                  for j in range(JOINT)]
        children.append(F.xxhash64(F.col("node"), F.lit(level), F.lit(c), *tokens))
    return (members.select("node", "fp").join(classes.select("fp", "n", "tokens"), "fp")
            .select("fp", "n", F.explode(F.array(*children)).alias("node")))


def open_nodes(rows: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Members of nodes that hold two groups or more; of nodes with the same members one is kept.

    ``rows``: node, fp, n. Adds label and ``cut``, the pieces of the size of a leaf that a node makes.
    """
    labelled = rows.join(labels, "fp", "left") if labels else rows.withColumn("label", F.col("fp"))
    labelled = labelled.withColumn("label", F.coalesce("label", "fp"))
    sizes = labelled.groupBy("node").agg(
        F.count("*").alias("m"), F.sum("n").alias("shingles"), F.min("label").alias("low"), F.max("label").alias("high"),
        F.bit_xor(F.xxhash64("fp")).alias("x"), F.sum(F.shiftright(F.xxhash64("fp"), 20)).alias("y"))
    once = sizes.where("low != high").groupBy("m", "x", "y").agg(F.min("node").alias("node"), F.ceil(
        F.greatest(F.col("m") / LEAF, F.first("shingles") / LEAF_SHINGLES)).cast("long").alias("cut"))
    return labelled.drop("n").join(once.select("node", "cut"), "node")


def groups_of(links: DataFrame) -> DataFrame:
    """Connected components: fp, label (the least fp of the component) for all classes with links.

    Least labels travel along links; after each round labels are replaced by their own labels, so long
    chains shrink fast. Rounds end when nothing changes.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = materialize(both.groupBy(F.col("a").alias("fp")).agg(F.min("b").alias("o")).select(
        "fp", F.least("fp", "o").alias("label")))
    while True:
        near = both.join(labels, both["b"] == labels["fp"]).select(
            F.col("a").alias("fp"), "label", F.lit(None).cast("binary").alias("was"))
        own = labels.select("fp", "label", F.col("label").alias("was"))
        step = near.unionByName(own).groupBy("fp").agg(F.min("label").alias("label"), F.max("was").alias("was"))
        jump = labels.select(F.col("fp").alias("label"), F.col("label").alias("next"))
        new = materialize(step.join(jump, "label").select(
            "fp", "was", F.least("label", "next").alias("label")))
        done = not new.where("label != was").take(1)
        labels = new.select("fp", "label")
        if done:
            return labels


def near_groups(
    docs: DataFrame, *, width: int = 5, percent: int = 85, trees: int = TREES,
) -> DataFrame:
    r"""Group documents whose shingle sets have at least ``percent`` per cent of their union in common.

    ``docs`` needs ``doc_id`` and ``text``. Words are ``[^\x20\x09-\x0D]+`` with A-Z in lower case; a set
    holds the distinct runs of ``width`` words, or the whole sequence where there are fewer. Returns one
    row per input row: doc_id, n_shingles, component_id (least doc_id reachable over links), kept
    (doc_id = component_id) and th (a hash of the text). Texts without words, and null texts, have no
    shingles and no links. A null doc_id takes part but names no group: component_id is null where no
    member has an id, and its rows are then kept. Repeated rows are in one group and, where they have its
    least id, all kept.

    A pair that fulfils the threshold meets in the first level of at least one of ``trees`` trees with
    probability 1 - 0.15^trees or more; every reported link is checked on full sets.
    """
    plain = need(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("d"), text_key("text").alias("th"), F.col("text").alias("t"))
    rows = materialize(sketches(plain.select("d", "th", "t"), width))
    classes = materialize(
        rows.where("n > 0").groupBy("fp").agg(
            F.min("d").alias("d"), F.min(F.struct(F.coalesce("d", F.lit(-1)), "th", "d", "n", "tokens", "marks")).alias("r"))
        .select("fp", "d", F.col("r.d").alias("rd"), F.col("r.th").alias("th"), F.col("r.n").alias("n"),
                F.col("r.tokens").alias("tokens"), F.col("r.marks").alias("marks")))
    members = materialize(open_nodes(roots(classes, trees)))
    wanted = members.select("fp").distinct().join(classes, "fp").select("fp", "n", "tokens", "marks", "rd", "th")
    every = packed(plain.select("d", "th", "t"))
    texts = materialize(
        every.join(wanted, every["d"].eqNullSafe(wanted["rd"]) & (every["th"] == wanted["th"]))
        .select("fp", "n", "tokens", "marks", "z").dropDuplicates(["fp"]))
    run = lambda t: compare(t, width, percent)

    def compared(piece: DataFrame) -> DataFrame:
        """``piece``: key, fp, label, pivot."""
        return piece.join(texts, "fp").groupBy("key").applyInArrow(run, LINK)

    def pieces(large: DataFrame) -> DataFrame:
        """Large nodes cut by hash, with the node's pivots in each piece."""
        cut = F.col("cut")
        dealt = large.withColumn("piece", F.pmod(F.xxhash64(F.lit(1), "fp"), cut))
        marks = large.groupBy("node", "cut").agg(*[
            F.min(F.struct(F.xxhash64(F.lit(100 + k), "fp"), "fp", "label")).alias(f"p{k}") for k in range(PIVOTS)])
        pivots = (
            marks.select("node", F.explode(F.sequence(F.lit(0).cast("long"), cut - 1)).alias("piece"), F.array(
                *[F.struct(f"p{k}.fp", f"p{k}.label") for k in range(PIVOTS)]).alias("ps"))
            .select("node", "piece", F.explode("ps").alias("p")).select("node", "piece", "p.fp", "p.label"))
        key = F.concat_ws("-", "node", "piece").alias("key")
        return dealt.select(key, "fp", "label", F.lit(False).alias("pivot")).unionByName(
            pivots.select(key, "fp", "label", F.lit(True).alias("pivot")))

    small = members.where(F.col("cut") == 1)
    links = materialize(compared(small.select(
        F.col("node").cast("string").alias("key"), "fp", "label", F.lit(False).alias("pivot"))))
    large = members.where(F.col("cut") > 1)
    for level in range(1, LEVELS + 1):
        if not large.take(1):
            break
        links = materialize(links.unionByName(compared(pieces(large))))
        labels = groups_of(links)
        left = open_nodes(large.join(classes.select("fp", "n"), "fp").select("node", "fp", "n"), labels)
        children = materialize(open_nodes(branches(left, classes, level), labels))
        small = children.where(F.col("cut") == 1)
        links = materialize(links.unionByName(compared(small.select(
            F.col("node").cast("string").alias("key"), "fp", "label", F.lit(False).alias("pivot")))))
        large = children.where(F.col("cut") > 1)
    if large.take(1):
        labels = groups_of(links)
        large = open_nodes(large.join(classes.select("fp", "n"), "fp").select("node", "fp", "n"), labels)
        cut = F.col("cut")
        own = F.pmod(F.xxhash64(F.lit(1), "fp"), cut)
        pairs = large.withColumn("own", own).withColumn(
            "other", F.explode(F.sequence(F.lit(0).cast("long"), cut - 1)))
        key = F.concat_ws("-", "node", F.least("own", "other"), F.greatest("own", "other"))
        links = materialize(links.unionByName(compared(pairs.select(
            key.alias("key"), "fp", "label", F.lit(False).alias("pivot")))))
    labels = groups_of(links)
    grouped = classes.select("fp", "d").join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = grouped.groupBy("label").agg(F.min("d").alias("component"))
    found = grouped.join(least, "label").select("fp", "component")
    out = rows.select("d", "n", "fp", "th").join(found, "fp", "left").select(
        F.col("d").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("d")).alias("component_id"), "th")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "th")


def one_of_each_group(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that ``near_groups`` keeps, each repeated row once."""
    kept = near_groups(docs, **settings).where("kept").select(
        F.col("doc_id").alias("__d"), F.col("th").alias("__th")).distinct()
    marked = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__key": text_key("text")})
    found = marked.join(
        kept, F.col("__id").eqNullSafe(F.col("__d")) & (F.col("__key") == F.col("__th")), "left_semi")
    return found.dropDuplicates(["__id", "__key"]).select(*docs.columns)
