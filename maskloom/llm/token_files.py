"""Token ids of a corpus as binary files with Elias-Fano document boundaries, written and read in tasks.

A file holds the documents of one range of ids, in ascending order::

    magic | ids, 16 or 32 bits each | ends of documents | document ids | footer | magic

Ends and document ids are Elias-Fano structures (``elias_fano``); document ids are stored as distances from
the file's least. A reader loads these and fetches only the ids of the documents it is asked for. No list of
all documents exists anywhere: a table of the files (``files``) holds their order, sizes and least ids.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from maskloom.llm.common import arrow_map, blocks, filesystem, need, text_key
from maskloom.llm.elias_fano import EliasFano
from maskloom.session import RUN, materialize, shared_folder

MAGIC = b"MLTOKEF1"
FOOTER = "<QQQQqQQB"
#: Ids of a file, and documents of a file, after which the next file is begun (a longer document has its own).
FILE_TOKENS, FILE_DOCUMENTS = 1 << 26, 1 << 20
#: Bytes of text for a writing task.
TASK_BYTES = 64 << 20
#: Words whose ids a worker remembers, from task to task.
WORDS = 1 << 19
FILES = "part int, turn int, path string, documents long, tokens long"


#: Letters and signs that the normaliser leaves alone but for ``lower``, besides ASCII.
LETTERS = "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x130), *range(0x131, 0x180)]))
SIGNS = "¡¿«»§°“”‘’–—…€£"
SMALL = "".join(sorted(set(LETTERS.lower())))


class Words(dict):
    """Ids of words, encoded by the model of the ``tokenizers`` library when first asked for."""

    def __init__(self, model, letters: dict[int, str], code: str):
        super().__init__()
        self.model, self.letters, self.code = model, letters, code

    def __missing__(self, word: str) -> bytes:
        found = self.model.tokenize(word if word.isascii() else word.translate(self.letters))
        ids = array(self.code, [t.id for t in found])
        if sys.byteorder == "big":
            ids.byteswap()
        self[word] = out = ids.tobytes()
        return out


class Tokens:
    """Ids of texts as the ``tokenizers`` library gives them, its merges applied once to each distinct word.

    Plain text (ASCII, Latin letters, a few signs) is lower-cased and cut into words by a pattern; the
    library's model encodes each distinct word. Any other stretch between spaces, and special tokens, go
    through the whole library. Construction compares both ways on every plain character; where they differ,
    as with a file of another kind, the whole library is used for all texts.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_str(model)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        self.special = special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        plain = f"\\t-\\r -~{LETTERS}{SIGNS}"
        self.foreign = re.compile(f"[^{plain}]").search
        self.cut = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{SMALL}]+|[0-9]|[^\sa-z0-9{SMALL}]+").findall
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = {ord(c): level.pre_tokenize_str(c)[0][0] for c in LETTERS + SMALL + SIGNS}
        self.words = Words(self.library.model, letters, "H" if self.kind == "<u2" else "I")
        self.by_words = not any(re.search(r"[ \n]", t) for t in special)
        self.by_words = self.by_words and all(map(self.check, self.probes()))

    def probes(self) -> Iterator[str]:
        yield "it's don't we're I've I'm you'll he'd 'S 'RE ' '' 's's 12a34 a\tb\x0b\x0cc\r\nd"
        for c in map(chr, [*range(9, 14), *range(32, 127), *map(ord, LETTERS + SIGNS)]):
            yield f"{c} a{c}b {c}{c}1{c} '{c} !{c}! {c.upper()}s"

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.cut(text.lower())))

    def __call__(self, text: str) -> bytes:
        if not self.by_words:
            return self.whole(text)
        return self.fast(text)

    def fast(self, text: str) -> bytes:
        if len(self.words) > WORDS:
            self.words.clear()
        if not self.other(text):
            return self.plain(text)
        return b"".join(self.whole(p) if self.other(p) else self.plain(p) for p in re.split("[ \n]", text))

    def other(self, text: str) -> bool:
        return any(t in text for t in self.special) or bool(self.foreign(text))

    def check(self, text: str) -> bool:
        return self.whole(text) == self.fast(text)


class Writer:
    """One file; ids go out as they come, ends and document ids stay until the footer."""

    def __init__(self, folder: str, width: int):
        where, base = filesystem(folder)
        where.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.tokens"  # an attempt that is repeated writes another file
        self.path, self.width = f"{folder}/{name}", width
        self.out = where.open_output_stream(f"{base}/{name}")
        self.out.write(MAGIC)
        self.ids: list[int] = []
        self.ends, self.nulls, self.total = [], 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.total += len(ids) // self.width
        self.ends.append(self.total)
        if doc_id is None:
            self.nulls += 1
        else:
            self.ids.append(doc_id)

    def close(self) -> None:
        least = self.ids[0] if self.ids else 0
        far = np.array([i - least for i in self.ids], np.uint64)
        ends = EliasFano.build(np.array(self.ends, np.uint64), self.total).to_bytes()
        keys = EliasFano.build(far, int(far[-1]) if len(far) else 0).to_bytes()
        self.out.write(ends)
        self.out.write(keys)
        self.out.write(struct.pack(FOOTER, len(self.ends), self.total, len(MAGIC) + self.total * self.width, len(ends),
                                   least, len(keys), self.nulls, self.width))
        self.out.write(MAGIC)
        self.out.close()


class TokenFile:
    """Reads a file by document number, or by document id."""

    def __init__(self, path: str):
        where, base = filesystem(path)
        self.file = where.open_input_file(base)
        size = self.file.size()
        last = struct.calcsize(FOOTER) + len(MAGIC)
        tail = self.file.read_at(last, size - last) if size > last else b""
        if tail[-len(MAGIC):] != MAGIC:
            raise ValueError(f"not a token file: {path}")
        self.documents, self.tokens, at, n_ends, self.least, n_keys, self.nulls, self.width = (
            struct.unpack_from(FOOTER, tail))
        self.ends = EliasFano.from_bytes(self.file.read_at(n_ends, at))
        self.keys = EliasFano.from_bytes(self.file.read_at(n_keys, at + n_ends))

    def start(self, i: int) -> int:
        return self.ends[i - 1] if i else 0

    def ids(self, start: int, end: int) -> np.ndarray:
        data = self.file.read_at((end - start) * self.width, len(MAGIC) + start * self.width)
        return np.frombuffer(data, f"<u{self.width}")

    def document(self, i: int) -> np.ndarray:
        return self.ids(self.start(i), self.ends[i])

    def find(self, doc_id: int) -> list[np.ndarray]:
        """Ids of all documents with this id."""
        i = self.keys.search(max(0, doc_id - self.least)) if doc_id >= self.least else self.keys.n
        found = []
        while i < self.keys.n and self.keys[i] + self.least == doc_id:
            found.append(self.document(self.nulls + i))
            i += 1
        return found

    def doc_ids(self, start: int, end: int) -> list[int | None]:
        known = self.keys.slice(max(0, start - self.nulls), max(0, end - self.nulls)).tolist()
        return [None] * (min(end, self.nulls) - min(start, self.nulls)) + [k + self.least for k in known]

    def runs(self, most: int = 1 << 21) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first, past the last, ends) of documents with about ``most`` ids in all, or of one document."""
        for a in range(0, self.documents, 1 << 15):
            ends = self.ends.slice(a, a + (1 << 15)).astype(np.int64)
            before = np.concatenate([[self.start(a)], ends])
            for i, j in blocks(np.diff(before).tolist(), most):
                yield a + i, a + j, before[i : j + 1]


def write_tokens(
    docs: DataFrame, tokenizer: str, *, folder: str | None = None, end_id: int = 1,
    file_tokens: int = FILE_TOKENS, task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Encode ``docs`` (``doc_id``, ``text``) and write files in ascending ``doc_id`` order; the table of files.

    Rows without ``doc_id`` come first; rows of one ``doc_id`` are ordered by a hash of their texts, so equal
    rows stand together, and any number of them can be dealt over several files. A null text is empty and
    consists of ``end_id`` alone. No rows give no files. Other columns are ignored. Texts are dealt by range
    once, and encoded by the task that writes them.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark).rstrip('/')}/{RUN}/{uuid.uuid4().hex}"
    with open(tokenizer, encoding="utf-8") as file:
        shipped = spark.sparkContext.broadcast({"model": file.read()})
    docs = need(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    parts = max(-(-(size["b"] or 0) // task_bytes), min(spark.sparkContext.defaultParallelism, size["n"]), 1)

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        part, turn, out = TaskContext.get().partitionId(), 0, None
        held = shipped.value  # a worker keeps its copy, and with it the words, for its next task
        if "tokens" not in held:
            held["tokens"] = Tokens(held["model"])
        tokens = held["tokens"]
        width = np.dtype(tokens.kind).itemsize
        end = np.array([end_id], tokens.kind).tobytes()

        def done():
            out.close()
            return {"part": [part], "turn": [turn], "path": [out.path], "documents": [len(out.ends)],
                    "tokens": [out.total]}

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = tokens(text or "") + end
                full = out and (out.total + len(ids) // width > file_tokens or len(out.ends) >= FILE_DOCUMENTS)
                if full:
                    yield done()
                    turn, out = turn + 1, None
                out = out or Writer(folder, width)
                out.add(doc_id, ids)
        if out:
            yield done()

    order = [F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("place")]
    dealt = docs.withColumns({"h": text_key(), "place": F.monotonically_increasing_id()})
    ordered = dealt.repartitionByRange(int(parts), *order).sortWithinPartitions(*order)
    return materialize(arrow_map(ordered.select("doc_id", "text"), work, FILES))


def read_tokens(files: DataFrame) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``.

    A task reads one file. The order of files is a window over the table of files, one row for 64 million ids.
    """
    spark: SparkSession = files.sparkSession
    before = Window.orderBy("part", "turn").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    n = max(1, min(files.count(), 8 * spark.sparkContext.defaultParallelism))

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for path, before in zip(batch["path"].to_pylist(), batch["before"].to_pylist()):
                file = TokenFile(path)
                for a, b, ends in file.runs():
                    data = memoryview(file.ids(int(ends[0]), int(ends[-1])).astype("<u4").tobytes())
                    at = (4 * (ends - ends[0])).tolist()
                    yield {"doc_id": file.doc_ids(a, b), "start": ends[:-1] + before, "n_tokens": np.diff(ends),
                           "ids_crc32": [zlib.crc32(data[i:j]) for i, j in zip(at, at[1:])]}

    return arrow_map(placed.select("path", "before").repartition(n), work,
                     "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the files of ``docs`` and return what ``read_tokens`` finds in them, a row for each row of ``docs``."""
    return read_tokens(write_tokens(docs, tokenizer, **options))
