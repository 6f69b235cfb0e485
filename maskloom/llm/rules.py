"""Quality rules: counts per text, and perplexity bands of a modified Kneser-Ney model per language.

The model is a byte n-gram model of each language. All texts are counted; the probabilities come from
the texts marked as good in ``reference`` (all texts of a language without any mark), as a model of good text makes
unlike text improbable. The bands are robust: the median of all texts that pass the base rules, plus
and minus multiples of the median deviation, wider for short texts. Model and bands count copies of a
text once, so that a text with many copies does not decide them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm.common import arrow_map, blocks, mix64, small_side, text_key
from maskloom.llm.ngrams import FileArrays, codes_of, count_codes, losses, merge_counts, write_arrays
from maskloom.session import materialize

BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
ORDER, BITS = 5, 9
#: Bytes of text whose n-grams are arrays at once, some 100 bytes each.
BLOCK = 1 << 19
#: Codes of a language that a task gathers before it merges and sends them.
WAITING = 2_000_000
WINDOW = 5
#: The lower limit: so many times the spreads of which good texts lie below by this share, and this at least.
LOW_SHARE, LOW_MARGIN, LOW_LEAST = 0.01, 2.5, 5.0


class Hashes(dict):
    """64-bit hash of each word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the window that starts at each word; windows run over the ends of texts."""
    n = max(0, len(words) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * np.uint64(0x9FB21C651E98DF25) + words[k : k + n]
    return mix64(out)


def repeated_words(words: np.ndarray, ends: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window found twice or more in the text."""
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    lengths = ends - starts
    text = np.repeat(np.arange(len(ends)), lengths)
    hashes = window_hashes(words, width)
    n = len(hashes)
    if not n:
        return np.zeros(len(ends), np.int64)
    inside = text[:n] == text[width - 1 :]
    at = np.flatnonzero(inside)
    key = mix64(hashes[at] ^ mix64(text[at].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(words) + 1, np.int64)
    hit = at[twice]
    np.add.at(change, hit, 1)
    np.add.at(change, hit + width, -1)
    covered = np.cumsum(change)[:-1] > 0
    total = np.concatenate([[0], np.cumsum(covered)])
    return total[ends] - total[starts]


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def statistics(texts: list[bytes], known: Hashes) -> dict[str, list[int]]:
    """The base counts of each text."""
    out: dict[str, list[int]] = {s: [] for s in STATS}
    ends, ids = [], []
    for t in texts:
        words = t.split()
        ids.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        ends.append(len(words))
        dense = t.translate(None, BLANKS)
        out["n_words"].append(len(words))
        out["word_chars"].append(len(dense) if dense.isascii() else len(dense.decode("utf-8", "replace")))
        out["n_symbols"].append(len(dense) - len(dense.translate(None, SYMBOLS)))
        lines = [x for x in t.split(b"\n") if x and not x.isspace()]
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
    words = np.concatenate(ids) if ids else np.zeros(0, np.uint64)
    out["n_repeat_words"] = repeated_words(words, np.cumsum(np.array(ends, np.int64)))
    return out


def byte_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all positions, and where each text starts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    symbols = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64) + np.uint64(1)
    return codes_of(symbols, starts[sizes > 0], ORDER, BITS), starts


def count_bytes(rows: DataFrame) -> DataFrame:
    """Counts of byte n-grams per language ``g``: in all texts, and in those with ``good``."""

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        waiting: dict[str, list] = {}

        def merged(group: str) -> dict:
            code, n, m = merge_counts(waiting.pop(group))
            return {"g": [group] * len(code), "code": code.view(np.int64), "n": n, "m": m}

        for batch in batches:
            groups, good = batch["g"].to_pylist(), np.array(batch["good"].to_pylist(), bool)
            for a, b in blocks(pc.binary_length(batch["t"]).to_pylist(), BLOCK):
                texts = dict(zip(range(a, b), batch["t"].slice(a, b - a).cast(pa.binary()).to_pylist()))
                for group in dict.fromkeys(groups[a:b]):
                    rows = [i for i in range(a, b) if groups[i] == group and texts[i]]
                    if not rows:
                        continue
                    part = [texts[i] for i in rows]
                    codes, _ = byte_codes(part)
                    marks = np.repeat(good[rows], [len(t) for t in part])
                    waiting.setdefault(group, []).append(count_codes(codes, marks))
                    if sum(len(p[0]) for p in waiting[group]) > WAITING:
                        yield merged(group)
        for group in list(waiting):
            yield merged(group)

    counted = arrow_map(rows, work, "g string, code long, n long, m long")
    return counted.groupBy("g", "code").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def distinct_texts(marked: DataFrame) -> DataFrame:
    """Each text of a language ``g`` once, ``good`` if one of its copies is; only texts with copies are shuffled."""
    same = ["g", "th"]
    often = materialize(marked.groupBy(*same).count().where("count > 1").select(*same))
    often = small_side(often, 32)
    once = marked.join(often, same, "left_anti")
    copies = marked.join(often, same, "left_semi").groupBy(*same).agg(
        F.first("t").alias("t"), F.max("good").alias("good"))
    return once.unionByName(copies).select("g", "t", "good")


def judge(
    docs: DataFrame, reference: DataFrame | None, keep: tuple[str, ...], least_words: int, most_repeated: int,
    upper: float, lower: float, least_spread: float,
) -> DataFrame:
    """Rows of ``quality_rules``; with ``keep`` also these columns in a struct ``o`` and ``text``.

    A text goes to the Python worker once, and comes back only if it is to be kept.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("d"), F.coalesce(F.col("text"), F.lit("")).alias("t"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("g"),
        F.struct(F.col("text").isNull().alias("__null"), *[F.col(c) for c in keep if c != "text"]).alias("o") if keep
        else F.lit(None).cast("string").alias("o"))
    rows = rows.withColumn("th", text_key("t"))
    good = spark.createDataFrame([], "d long") if reference is None else reference.select(
        F.col("doc_id").cast("long").alias("d")).where("d is not null").distinct()
    good = small_side(good.withColumn("mark", F.lit(True)), 16)
    marked = rows.join(good, "d", "left").withColumn("good", F.coalesce("mark", F.lit(False)))
    counts = materialize(count_bytes(distinct_texts(marked.select("g", "th", "t", "good"))))
    labelled = counts.groupBy("g").agg((F.sum("m") > 0).alias("labelled"))
    counts = counts.join(small_side(labelled, 32), "g").withColumn(
        "m", F.when(F.col("labelled"), F.col("m")).otherwise(F.col("n"))).drop("labelled")
    table = materialize(losses(counts, ORDER, BITS, "m"))
    files = write_arrays(table, "loss")
    other_type = rows.schema["o"].dataType.simpleString()
    stats = ", ".join(f"{s} long" for s in STATS)
    schema = f"d long, g string, th long, o {other_type}, {stats}, n_bytes long, total double" + ", t string" * bool(keep)

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        known, arrays = Hashes(), FileArrays(files)
        for batch in batches:
            groups = batch["g"].to_pylist()
            sizes = pc.binary_length(batch["t"]).to_pylist()
            for a, b in blocks(sizes, BLOCK):
                texts = batch["t"].slice(a, b - a).cast(pa.binary()).to_pylist()
                total = np.zeros(b - a)
                for group in dict.fromkeys(groups[a:b]):
                    own = [i for i in range(b - a) if groups[a + i] == group and texts[i]]
                    if own:
                        codes, starts = byte_codes([texts[i] for i in own])
                        total[own] = np.add.reduceat(arrays.get(group, codes).astype(np.float64), starts)
                part = {c: batch[c].slice(a, b - a) for c in ("d", "g", "th", "o", *["t"] * bool(keep))}
                yield part | statistics(texts, known) | {"n_bytes": sizes[a:b], "total": total}

    whole = arrow_map(rows, work, schema)
    base = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    whole = materialize(whole.withColumn("base_failed", base).withColumn(
        "loss", F.try_divide("total", "n_bytes")).join(good, "d", "left").withColumn(
            "good", F.coalesce("mark", F.lit(False))).drop("mark"))
    sound = materialize(whole.where(~F.col("base_failed")).groupBy("g", "th").agg(
        F.first("loss").alias("loss"), F.first("n_bytes").alias("n_bytes"), F.max("good").alias("good")))
    # a row per language each; joined by broadcast, so that no language meets in one task
    middle = small_side(materialize(sound.groupBy("g").agg(F.percentile_approx("loss", 0.5, 10_000).alias("m"),
        F.percentile_approx("n_bytes", 0.5, 10_000).alias("length"))), 64)
    spread = sound.join(middle, "g").groupBy("g").agg(F.percentile_approx(F.abs(F.col("loss") - F.col("m")), 0.5, 10_000).alias("s"))
    bands = small_side(materialize(middle.join(spread, "g").select(
        "g", "m", "length", F.greatest(1.4826 * F.col("s"), F.lit(least_spread)).alias("s"))), 64)
    wide = F.greatest(F.lit(1.0), F.sqrt(F.try_divide("length", "n_bytes"))) * F.col("s")
    low = F.percentile_approx((F.col("m") - F.col("loss")) / wide, 1 - LOW_SHARE, 10_000)
    good_low = F.percentile_approx(
        F.when(F.col("good"), (F.col("m") - F.col("loss")) / wide), 1 - LOW_SHARE, 10_000)
    below = sound.join(bands, "g").groupBy("g").agg(F.coalesce(good_low, low).alias("low"))
    bands = small_side(materialize(bands.join(below, "g").withColumn(
        "below", F.least(F.lit(lower), F.greatest(F.lit(LOW_LEAST), LOW_MARGIN * F.col("low"))))), 64)
    inside = (F.col("loss") <= F.col("m") + upper * wide) & (F.col("loss") >= F.col("m") - F.col("below") * wide)
    return whole.join(bands, "g", "left").withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))


def quality_rules(
    docs: DataFrame, *, reference: DataFrame | None = None, least_words: int = 10, most_repeated: int = 20, upper: float = 8.0, lower: float = 25.0,
    least_spread: float = 0.01,
) -> DataFrame:
    r"""Judge each whole text by base counts and by its perplexity under the model of its language.

    ``docs`` needs ``doc_id``, ``text`` and ``lang``; ``reference`` has the ``doc_id`` of texts known to be
    good (null or absent ids are ignored); a language in which no text is good takes all its texts as good. Words are ``[^\x20\x09-\x0D]+``. Returns one row per input
    row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, loss (mean
    natural loss of a byte, null without bytes) and kept; other columns are left out.

    ``base_failed``: fewer than ``least_words`` words, or 100 * n_repeat_words > ``most_repeated`` *
    n_words. ``kept`` is false if base_failed or if the loss is more than ``upper`` spreads above or
    ``below`` spreads below the median of its language, a spread being the median deviation (at least
    ``least_spread``) times the square root of median length / own length where that is more than 1.
    ``below`` is measured: 2.5 times the spreads by which the lowest hundredth of the good texts (of all in a
    language without good ones) lies below, between 5 and ``lower``.
    Model, medians and deviations are of the distinct texts of a language (a text is good if one of its
    copies is); every row is scored. A null text counts as empty; a null language is a language of its own.
    """
    judged = judge(docs, reference, (), least_words, most_repeated, upper, lower, least_spread)
    return judged.select(F.col("d").alias("doc_id"), *STATS, "base_failed", "loss", "kept")


def good_documents(docs: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns as they are."""
    judged = judge(docs, reference, tuple(docs.columns), 10, 20, 8.0, 25.0, 0.01)
    text = F.when(~F.col("o.__null"), F.col("t")).alias("text")
    return judged.where("kept").select(*[text if c == "text" else F.col("o")[c].alias(c) for c in docs.columns])
