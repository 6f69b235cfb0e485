"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A pretoken is a row of symbols. Leaf ``i`` of its tree holds ``rank * width + i`` for the pair that
starts at symbol ``i`` (infinity where no merge exists), an inner node the least of its children, so the
root names the leftmost pair of lowest rank. A merge changes three leaves and the paths above them; the
word is done when the root is infinite. Many pretokens of like width go through the loop together, one
row of an array each.

Pretokens come from the published pattern of the vocabulary. A text is first cut where pretokens always
end (before a space that precedes a non-space, and around single line ends), and what a piece encodes to
is remembered within the task, so that each distinct piece is encoded once.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from maskloom.llm.common import arrow_map, blocks

INFINITE = np.iinfo(np.int64).max
#: Pieces that a task remembers before it starts anew; bounds memory, not results.
REMEMBERED = 250_000
#: Bytes of text that are encoded at once.
BLOCK = 1 << 19
#: Single marks that are a pretoken of their own after letters.
MARKS = ".,;:!?"
#: White space of the Unicode property; Python's own notion has four control characters more.
SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|["
    + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+"
)


@dataclass
class Vocabulary:
    """Plain arrays of a tokenizer file: bounded by its size, so they are shipped with tasks."""

    byte_ids: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    tokens: list[bytes]
    special: list[tuple[str, int]]
    byte_pairs: np.ndarray | None = None


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in the file's tokens."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_vocabulary(path: str) -> Vocabulary:
    """Read a ``tokenizers`` JSON file with a byte-level BPE model."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model, symbols = data["model"], byte_symbols()
    vocab = model["vocab"]
    special = [(t["content"], t["id"]) for t in data.get("added_tokens", [])]
    tokens = [b""] * (1 + max([*vocab.values(), *(i for _, i in special)]))
    for token, i in vocab.items():
        tokens[i] = bytes(symbols[c] for c in token)
    for content, i in special:
        tokens[i] = content.encode()
    byte_ids = np.empty(256, np.int64)
    for c, b in symbols.items():
        byte_ids[b] = vocab[c]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    left = np.array([vocab[a] for a, _ in merges], np.int64)
    right = np.array([vocab[b] for _, b in merges], np.int64)
    merged = np.array([vocab[a + b] for a, b in merges], np.int64)
    pairs = (left << 32) | right
    order = np.argsort(pairs, kind="stable")
    v = Vocabulary(byte_ids, pairs[order], order.astype(np.int64), merged, tokens, special)
    v.byte_pairs = pair_ranks(v, np.repeat(byte_ids, 256), np.tile(byte_ids, 256))
    return v


def pair_ranks(v: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rank of each pair, infinite where there is no merge or no right symbol."""
    key = (left << 32) | right
    at = np.minimum(np.searchsorted(v.pairs, key), len(v.pairs) - 1)
    return np.where((v.pairs[at] == key) & (right >= 0) & (left >= 0), v.ranks[at], INFINITE)


def merge_rows(v: Vocabulary, words: list[bytes], width: int) -> list[bytes]:
    """Merge all pairs of words with at most ``width`` bytes, a power of two."""
    n = len(words)
    lengths = np.array([len(w) for w in words])
    inside = np.arange(width) < lengths[:, None]
    symbol = np.full((n, width + 1), -1, np.int64)
    symbol[:, :width][inside] = v.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    after = np.tile(np.arange(1, width + 2), (n, 1))
    before = np.tile(np.arange(-1, width), (n, 1))
    raw = np.zeros((n, width + 1), np.int64)
    raw[:, :width][inside] = np.frombuffer(b"".join(words), np.uint8)
    ranks = np.where(symbol[:, 1:] >= 0, v.byte_pairs[raw[:, :-1] * 256 + raw[:, 1:]], INFINITE)
    tree = np.full((n, 2 * width), INFINITE, np.int64)
    tree[:, width:] = np.where(ranks < INFINITE, ranks * width + np.arange(width), INFINITE)
    k = width
    while k > 1:
        tree[:, k // 2 : k] = np.minimum(tree[:, k : 2 * k : 2], tree[:, k + 1 : 2 * k : 2])
        k //= 2
    flat, sym, aft, bef = tree.reshape(-1), symbol.reshape(-1), after.reshape(-1), before.reshape(-1)
    rows = np.flatnonzero(tree[:, 1] < INFINITE)
    while len(rows):
        root = flat[rows * (2 * width) + 1]
        rank, i = root // width, root % width
        base, leaf = rows * (width + 1), rows * (2 * width)
        j = aft[base + i]
        k = np.minimum(aft[base + j], width)
        sym[base + i] = v.merged[rank]
        sym[base + j] = -1
        aft[base + i] = k
        inner = k < width
        bef[(base + k)[inner]] = i[inner]
        p = bef[base + i]
        touched = [(rows, j)]
        flat[leaf + width + j] = INFINITE
        new = pair_ranks(v, sym[base + i], sym[base + k])
        flat[leaf + width + i] = np.where(new < INFINITE, new * width + i, INFINITE)
        touched.append((rows, i))
        has = p >= 0
        if has.any():
            r, q, x = rows[has], p[has], i[has]
            new = pair_ranks(v, sym[r * (width + 1) + q], sym[r * (width + 1) + x])
            flat[r * (2 * width) + width + q] = np.where(new < INFINITE, new * width + q, INFINITE)
            touched.append((r, q))
        node = np.concatenate([r * (2 * width) + width + x for r, x in touched])
        base = np.concatenate([r * (2 * width) for r, _ in touched])
        node -= base
        while node.size and node[0] > 1:
            node >>= 1
            flat[base + node] = np.minimum(flat[base + 2 * node], flat[base + 2 * node + 1])
        rows = rows[flat[rows * (2 * width) + 1] < INFINITE]
    kept = symbol[:, :width] >= 0
    ids = symbol[:, :width][kept].astype("<u4").tobytes()
    ends = np.cumsum(kept.sum(1)) * 4
    return [ids[e - 4 * c : e] for e, c in zip(ends.tolist(), kept.sum(1).tolist())]


def encode_words(v: Vocabulary, words: list[bytes], cells: int = 1 << 16) -> list[bytes]:
    """Ids of each word, in order, as little-endian 32-bit integers."""
    by_width: dict[int, list[int]] = {}
    for i, n in enumerate(map(len, words)):
        by_width.setdefault(1 << max(1, (n - 1).bit_length()), []).append(i)
    out = [b""] * len(words)
    for width, group in by_width.items():
        step = max(1, cells // width)
        for s in range(0, len(group), step):
            part = group[s : s + step]
            for i, ids in zip(part, merge_rows(v, [words[i] for i in part], width)):
                out[i] = ids
    return out


class Encoder:
    """Encodes texts of one task; holds what it has learnt about pieces."""

    def __init__(self, v: Vocabulary) -> None:
        import regex

        self.v = v
        self.pattern = regex.compile(PATTERN)
        self.special = {content: i for content, i in v.special if content}
        self.cut = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
            if self.special else None)
        self.words: dict[str, bytes] = {}
        self.spaced: dict[str, bytes | None] = {"": None}
        self.bare: dict[str, bytes | None] = {"": None}
        self.line_end, *marks = encode_words(v, [b"\n", *(m.encode() for m in MARKS)])
        self.marks = dict(zip(MARKS, marks))

    def _encode(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, through their pretokens."""
        parts = [self.pattern.findall(p) for p in pieces]
        new = list({w for p in parts for w in p}.difference(self.words))
        self.words.update(zip(new, encode_words(self.v, [w.encode() for w in new])))
        words = self.words
        return [b"".join([words[w] for w in p]) for p in parts]

    def _learn(self, spaced: set[str], bare: set[str]) -> None:
        """Remember pieces; letters, alone or before one mark, are pretokens that need no search."""
        for known, new, lead in ((self.spaced, spaced, " "), (self.bare, bare, "")):
            new = new.difference(known)
            plain = [p for p in new if p.isalpha()]
            known.update(zip(plain, encode_words(self.v, [(lead + p).encode() for p in plain])))
            rest = [p for p in new if p not in known]
            marked = [p for p in rest if p[-1] in self.marks and p[:-1].isalpha()]
            stems = list({p[:-1] for p in marked}.difference(known))
            known.update(zip(stems, encode_words(self.v, [(lead + p).encode() for p in stems])))
            known.update([(p, known[p[:-1]] + self.marks[p[-1]]) for p in marked])
            rest = [p for p in rest if p not in known]
            good = [p for p in rest if not (p[0].isspace() or p[-1].isspace())]
            known.update(zip(good, self._encode([lead + p for p in good])))
            known.update((p, None) for p in set(rest).difference(good))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if len(self.words) + len(self.spaced) + len(self.bare) > REMEMBERED:
            self.words, self.spaced, self.bare = {}, {"": None}, {"": None}
        split = [
            [line.split(" ") for line in t.split("\n")]
            if t and not (self.cut and self.cut.search(t)) else None for t in texts
        ]
        spaced, bare = set(), set()
        for lines in split:
            for pieces in lines or ():
                bare.add(pieces[0])
                spaced.update(pieces[1:])
        self._learn(spaced, bare)
        out = []
        for text, lines in zip(texts, split):
            try:
                out.append(self._joined(lines) if lines else self._whole(text))
            except TypeError:  # white space that the cut does not cover
                out.append(self._whole(text))
        return out

    def _joined(self, lines: list[list[str]]) -> bytes:
        parts = []
        for pieces in lines:
            parts.append(self.bare[pieces[0]])
            parts.extend(map(self.spaced.__getitem__, pieces[1:]))
            parts.append(self.line_end)
        parts.pop()
        return b"".join(parts)

    def _whole(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.cut:
            return self._encode([text])[0]
        parts = self.cut.split(text)
        coded = iter(self._encode(parts[::2]))
        return b"".join(
            np.array([self.special[p]], "<u4").tobytes() if k % 2 else next(coded)
            for k, p in enumerate(parts))

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the text; bytes that form no character become the replacement character."""
        raw = b"".join(map(self.v.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace").encode()


OUTPUTS = {
    "n_tokens": "long", "ids": "binary", "decoded": "string", "ids_sha256": "string",
    "decoded_sha256": "string",
}


def bpe_round_trip(
    df: DataFrame, *, tokenizer: str, key: str = "doc_id", key_type: str = "long", text: str = "text",
    outputs: tuple[str, ...] = ("n_tokens", "ids"),
) -> DataFrame:
    """Encode each whole text and, where an output needs it, decode the ids again.

    ``tokenizer`` is the path of a ``tokenizers`` JSON file; it is read on the driver. One row per row of
    ``df``: ``key`` and the chosen ``outputs`` of ``OUTPUTS`` (ids are little-endian unsigned 32-bit
    integers). A null or empty text has no tokens and decodes to the empty text; a null key stays null;
    repeated rows each give a row; other columns are left out. No shuffle; memory is bounded by a block
    of texts or the longest one.
    """
    shipped = df.sparkSession.sparkContext.broadcast(vars(load_vocabulary(tokenizer)))
    decoding = any(o.startswith("decoded") for o in outputs)

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        encoder = Encoder(Vocabulary(**shipped.value))
        for batch in batches:
            sizes = [x or 0 for x in pa.compute.binary_length(batch["t"].cast(pa.binary())).to_pylist()]
            for a, b in blocks(sizes, BLOCK):
                texts = [x or "" for x in batch["t"].slice(a, b - a).to_pylist()]
                ids = encoder.encode(texts)
                raw = [encoder.decode(x) for x in ids] if decoding else []
                out = {"k": batch["k"].slice(a, b - a)}
                for o in outputs:
                    out[o] = (
                        [len(x) // 4 for x in ids] if o == "n_tokens" else ids if o == "ids"
                        else [x.decode() for x in raw] if o == "decoded"
                        else [hashlib.sha256(x).hexdigest() for x in (ids if o == "ids_sha256" else raw)])
                yield out

    pairs = df.select(df[key].cast(key_type).alias("k"), df[text].cast("string").alias("t"))
    schema = ", ".join([f"k {key_type}", *(f"{o} {OUTPUTS[o]}" for o in outputs)])
    return arrow_map(pairs, work, schema).withColumnRenamed("k", key)
