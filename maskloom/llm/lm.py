"""Cross-entropy difference of matched n-gram models.

Target and background model have the same order, smoothing and vocabulary (the distinct
tokens of all texts); both are counted in one pass over all texts. For every n-gram of the corpus its loss under
either model is looked up once; the mean difference over a text's tokens is its score: the lower, the
more the text is like the target.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm.bpe import bpe_round_trip
from maskloom.llm.common import arrow_map, blocks, small_side
from maskloom.llm.ngrams import FileArrays, codes_of, count_codes, losses, merge_counts, suffix, write_arrays
from maskloom.session import materialize

ORDER, BITS = 2, 20
#: Bytes of token ids whose n-grams are arrays at once, some 25 bytes each.
BLOCK = 4 << 20


def gram_codes(coded: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all positions of the texts that have tokens, and where each of these texts starts."""
    sizes = np.array([len(c) // 4 for c in coded], np.int64)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    symbols = np.frombuffer(b"".join(coded), "<u4").astype(np.uint64) + np.uint64(1)
    return codes_of(symbols, starts, order, BITS), starts


def count_tokens(rows: DataFrame, order: int) -> DataFrame:
    """Counts of token n-grams in all texts (n) and in those with ``good`` (m)."""

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        waiting = []

        def out() -> dict:
            code, n, m = merge_counts(waiting)
            waiting.clear()
            return {"g": [""] * len(code), "code": code.view(np.int64), "n": n, "m": m}

        for batch in batches:
            coded, good = batch["ids"].to_pylist(), np.array(batch["good"].to_pylist(), bool)
            for a, b in blocks([len(c) for c in coded], BLOCK):
                codes, _ = gram_codes(coded[a:b], order)
                if len(codes):
                    waiting.append(count_codes(codes, np.repeat(good[a:b], [len(c) // 4 for c in coded[a:b]])))
                if sum(len(w[0]) for w in waiting) > 4_000_000:
                    yield out()
        if waiting:
            yield out()

    counted = arrow_map(rows, work, "g string, code long, n long, m long")
    return counted.groupBy("g", "code").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def cross_entropy_difference(
    docs: DataFrame, target: DataFrame, *, tokenizer: str, order: int = ORDER,
) -> DataFrame:
    """Score every whole text by its mean loss under the target model minus that under the background.

    ``docs`` needs ``doc_id`` and ``text``; ``target`` has the ``doc_id`` of the texts that make the target
    model; all texts make the background model. Modified Kneser-Ney n-grams of ``order`` (up to 3) tokens
    of ``tokenizer`` (a ``tokenizers`` JSON file of fewer than 2^20 tokens).

    One row per input row: doc_id, n_tokens, target_loss, background_loss and score (natural logarithm, means
    over the tokens; null for texts without tokens; target_loss and score are null for all if no text
    belongs to the target). Null texts count as empty, null ids belong to no target, repeated rows count
    each, other columns are left out.
    """
    if not 1 <= order <= 3:
        raise ValueError("order must be 1, 2 or 3")
    spark = docs.sparkSession
    coded = materialize(bpe_round_trip(docs, tokenizer=tokenizer, outputs=("n_tokens", "ids")).select(
        "doc_id", "n_tokens", "ids"))
    chosen = target.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    marked = coded.join(small_side(chosen.withColumn("good", F.lit(True)), 16), "doc_id", "left").select(
        "ids", F.coalesce("good", F.lit(False)).alias("good"))
    counts = materialize(count_tokens(marked, order))
    known = bool(counts.where("m > 0").take(1))
    vocabulary = counts.select(suffix(F.col("code"), 1, BITS)).distinct().count()
    both = losses(counts, order, BITS, "n", vocabulary).withColumnRenamed("loss", "b").join(
        losses(counts, order, BITS, "m", vocabulary).withColumnRenamed("loss", "a"), ["g", "code"])
    table = materialize(both)
    files = write_arrays(table, "a", "b")

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        arrays = FileArrays(files)
        for batch in batches:
            every = batch["ids"].to_pylist()
            for a, b in blocks([len(c) for c in every], BLOCK):
                codes, starts = gram_codes(every[a:b], order)
                total = np.zeros((b - a, 2))
                if len(codes):
                    full = [i for i in range(b - a) if every[a + i]]
                    total[full] = np.add.reduceat(arrays.get("", codes).astype(np.float64), starts, axis=0)
                yield {"doc_id": batch["doc_id"].slice(a, b - a), "n_tokens": batch["n_tokens"].slice(a, b - a),
                       "a": total[:, 0], "b": total[:, 1]}

    whole = arrow_map(coded.select("doc_id", "n_tokens", "ids"), work,
                      "doc_id long, n_tokens long, a double, b double")
    mean = lambda c: F.try_divide(F.col(c), F.col("n_tokens"))
    first = mean("a") if known else F.lit(None).cast("double")
    return whole.select("doc_id", "n_tokens", first.alias("target_loss"), mean("b").alias("background_loss")).withColumn(
        "score", F.col("target_loss") - F.col("background_loss"))
