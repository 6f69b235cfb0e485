"""Token counts of sections from one encoding of the whole text.

A text is encoded once; byte lengths of its tokens give their character spans, which are joined with the
character spans of its sections (both are sorted, so the join is a pair of binary searches a section).
Only the tokens at a section's two ends can cross its boundary; a rule allocates these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm.bpe import Encoder, Vocabulary, load_vocabulary
from maskloom.llm.common import arrow_map, blocks

RULES = ("start", "most", "share")


def token_spans(text: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last character of each token; a character cut by tokens belongs to each of them."""
    last = np.cumsum(lengths)
    lead = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    return lead[last - lengths] - 1, lead[last - 1]


def line_sections(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r"""Lines, numbered from 0, as character spans without their ``\n``."""
    data = np.frombuffer(text, np.uint8)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    breaks = lead[np.flatnonzero(data == 10)]
    start, end = np.append(0, breaks + 1), np.append(breaks, lead[-1])
    return np.arange(len(start)), start, end


def allocate(first: np.ndarray, last: np.ndarray, start: np.ndarray, end: np.ndarray, rule: str):
    """Tokens credited to each section, and those credited to none.

    ``start``: a token counts for the sections that hold its first character. ``share``: for each section
    by the share of its characters inside. ``most``: for the one section with most of its characters, the
    one that starts first (then the one listed first) where several have as many.
    """
    n = len(first)
    low = np.searchsorted(last, start, "right")
    high = np.maximum(np.searchsorted(first, end, "left"), low)
    some = (end > start) & (high > low)
    low, high = np.where(some, low, 0), np.where(some, high, 0)
    size = high - low
    section = np.repeat(np.arange(len(start)), size)
    token = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
    inside = np.minimum(last[token], end[section]) - np.maximum(first[token], start[section])
    if rule == "start":
        credit = (first[token] >= start[section]).astype(float)
    elif rule == "share":
        credit = inside / (last[token] - first[token])
    else:
        order = np.lexsort((section, start[section], -inside, token))
        best = order[np.append(True, token[order][1:] != token[order][:-1])[: len(order)]]
        credit = np.zeros(len(token))
        credit[best] = 1.0
    credited = np.bincount(section, credit, len(start))
    if rule == "share":
        # what no section covers; overlapping sections can cover a character twice
        outside = max(0.0, n - np.minimum(np.bincount(token, credit, n), 1.0).sum()) if n else 0.0
    else:
        outside = n - len(np.unique(token[credit > 0]))
    return credited, outside


def attribute_tokens(
    docs: DataFrame, *, tokenizer: str, rule: str = "most", sections: str | None = None,
) -> DataFrame:
    r"""Token counts of the sections of every whole text, encoded once.

    ``docs`` needs ``doc_id``, ``text`` and, if ``sections`` names one, a column of
    ``array<struct<section:bigint,start:bigint,end:bigint>>`` with character spans (end exclusive; they may
    overlap and leave gaps; parts outside the text hold nothing). Without it the sections are the lines.
    ``rule`` allocates tokens that cross boundaries, see ``allocate``.

    One row per section: doc_id, section, start, end, n_tokens (double; whole numbers but for ``share``), and one
    row per input row with a null section for the tokens that no section gets. Null texts count as empty
    (one empty line), a null list of sections as an empty one; repeated rows each give their rows; a null
    doc_id stays null; other columns are left out. No shuffle.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {', '.join(RULES)}")
    shipped = docs.sparkSession.sparkContext.broadcast(vars(load_vocabulary(tokenizer)))

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        vocabulary = Vocabulary(**shipped.value)
        encoder, length = Encoder(vocabulary), np.array([len(t) for t in vocabulary.tokens])
        for batch in batches:
            sizes = [x or 0 for x in pa.compute.binary_length(batch["t"].cast(pa.binary())).to_pylist()]
            ids, given = batch["d"].to_pylist(), batch["s"].to_pylist() if sections else None
            for a, b in blocks(sizes):
                texts = [x or "" for x in batch["t"].slice(a, b - a).to_pylist()]
                columns = [[] for _ in range(5)]
                for i, (text, coded) in enumerate(zip(texts, encoder.encode(texts)), a):
                    raw = text.encode()
                    spans = token_spans(raw, length[np.frombuffer(coded, "<u4")])
                    if sections:
                        own = [(s["section"], s["start"], s["end"]) for s in given[i] or () if s]
                        name, start, end = (np.array([s[k] for s in own], np.int64) for k in range(3))
                    else:
                        name, start, end = line_sections(raw)
                    credit, outside = allocate(*spans, start, end, rule)
                    for c, more in zip(columns, (
                            [ids[i]] * (len(name) + 1), [*name.tolist(), None], [*start.tolist(), None],
                            [*end.tolist(), None], [*credit.tolist(), float(outside)])):
                        c += more
                yield dict(zip(("doc_id", "section", "start", "end", "n_tokens"), columns))

    chosen = [F.col("doc_id").cast("long").alias("d"), F.col("text").cast("string").alias("t")]
    if sections:
        chosen.append(F.col(sections).alias("s"))
    return arrow_map(docs.select(*chosen), work, "doc_id long, section long, start long, end long, n_tokens double")
