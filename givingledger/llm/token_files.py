"""Token-ID files: flat unsigned integers with 64-bit document offsets, written by tasks and read back memory-mapped.

Documents are laid out by (doc_id, hash of the text); each range partition writes one shard: `tokens` (all ids, each document
closed by `end_id`), `offsets` (n + 1 64-bit places of its documents, from 0) and `doc_ids` (64-bit). File names are new for each
attempt, and the manifest, a table that Spark commits, names the files of the attempt that counts; so lost or doubled tasks do
no harm. Shard bases are prefix sums over the manifest, which has one row per shard.

Null and empty texts are documents of the end id alone. Repeated rows are written again. Null doc_ids come first and are
read back as null. An empty table gives no shard. Very long texts are encoded in whole, piece by piece.

A byte-level vocabulary splits text at blanks before any merge, so equal pieces have equal ids wherever they stand; the
tokenizer encodes each distinct piece once and texts are put together from them. A text that names a special token is encoded
in one go, as such names are found before the split.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from givingledger.llm.common import slices
from givingledger.sources.scratch import new_folder

PIECES = re.compile(r" ?(?:[^\s]|[\x1c-\x1f])+|[^\S\x1c-\x1f]+(?![^\s]|[\x1c-\x1f])|[^\S\x1c-\x1f]+")
# Blanks that the cut at single blanks and line ends does not cover: other kinds, several together, at an edge of the text.
ODD = ("[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
       "| [ \\n]|\\n |\\n\\n\\n|\\A[ \\n]|[ \\n]\\z")
CACHED = 1_500_000
ENCODED = 20_000
POINTS = ".,;:!?"
MOST_ROWS = 4000
STRETCH = 4 << 20


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints, else one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


LETTERS = byte_letters()
MANIFEST = "shard int, path string, n_docs long, n_tokens long"
NULL_ID = np.iinfo(np.int64).min


class Encoder:
    """Ids of texts as bytes of `dtype`, by a cache of pieces that is emptied when it is full.

    One is kept by each Python worker. A task has one core, so the tokenizer must not start threads of its own.
    """

    def __init__(self, vocabulary: str, dtype: np.dtype, end_id: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.code = {2: "H", 4: "I"}[dtype.itemsize]
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype, self.end = dtype, np.array([end_id], dtype=dtype).tobytes()
        self.known: dict[str, bytes] = {}  # pieces as they stand
        self.after: dict[str, bytes] = {}  # words that follow a blank
        parts = json.loads(self.tokenizer.to_str())
        byte_level = parts["model"]["type"] == "BPE" and not parts.get("normalizer") and (parts.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
        whole = byte_level and not parts["pre_tokenizer"].get("add_prefix_space") and not parts["model"].get("ignore_merges")
        self.merges = self.tokenizer.model.tokenize if whole else None
        # Marks that the vocabulary's cut always parts from a word before them.
        marks = POINTS if whole and parts["pre_tokenizer"].get("use_regex", True) else ""
        self.points = {"": b""} | {m: self.merged(m) for m in marks}

    def encode_all(self, texts: pa.Array) -> tuple[bytes, np.ndarray]:
        """Ids of all texts, each with its end, and the number of each.

        Words are cut, and told apart, by Arrow; only the distinct ones of a stretch become Python objects. Their ids stand one after
        the other in a buffer, from which the texts are gathered. A text with odd blanks or special names is one entry of that buffer.
        """
        texts = texts.fill_null("")
        odd = pc.match_substring_regex(texts, ODD)
        for name in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, name))
        entries = [self.end, *(self.encode_odd(t.as_py()) + self.end for t in texts.filter(odd))]
        odd = odd.to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(pc.replace_substring(pc.if_else(pa.array(odd), "", texts), "\n", " \n "), " ")
        words = cut.flatten().dictionary_encode()
        distinct, place = words.dictionary.to_pylist(), words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        starts = cut.offsets.to_numpy()[:-1].astype(np.int64) - cut.offsets[0].as_py()
        begins = np.zeros(len(place), dtype=bool)  # a text's or a line's first word has no blank before it
        begins[starts] = True
        line_end = distinct.index("\n") if "\n" in distinct else -1
        begins[1:] |= place[:-1] == line_end
        begins |= place == line_end
        codes = np.full(len(place) + len(texts), 0, dtype=np.int64)
        ends = np.append(starts[1:], len(place)) + np.arange(len(texts))
        codes[ends[odd]] = np.arange(1, 1 + odd.sum())
        inside = np.ones(len(codes), dtype=bool)
        inside[ends] = False
        for table, blank, chosen in ((self.known, "", begins), (self.after, " ", ~begins)):
            used = np.flatnonzero(np.bincount(place[chosen], minlength=len(distinct)))
            number = np.zeros(len(distinct), dtype=np.int64)
            number[used] = np.arange(len(used)) + len(entries)
            entries += self.ids_of(table, blank, [distinct[i] for i in used])
            codes[np.flatnonzero(inside)[chosen]] = number[place[chosen]]
        sizes = np.fromiter(map(len, entries), dtype=np.int64, count=len(entries)) // self.dtype.itemsize
        buffer, before = np.frombuffer(b"".join(entries), dtype=self.dtype), np.cumsum(sizes) - sizes
        n = sizes[codes]
        done = np.cumsum(n)
        gathered = buffer[np.repeat(before[codes] - done + n, n) + np.arange(done[-1])]
        return gathered.tobytes(), np.diff(done[ends], prepend=0)

    def merged(self, letters: str) -> bytes:
        """Ids of a piece that needs no cut within, only merges."""
        spelled = letters.replace(" ", LETTERS[32]) if letters.isascii() else letters.encode().decode("latin-1").translate(LETTERS)
        return array(self.code, [t.id for t in self.merges(spelled)]).tobytes()

    def encode_odd(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()
        return b"".join(self.ids_of(self.known, "", PIECES.findall(text)))

    def ids_of(self, table: dict[str, bytes], blank: str, words: list[str]) -> list[bytes]:
        """Ids of the words, each after `blank`; new ones are encoded together, those of letters and a mark at most by merges alone."""
        if len(table) > CACHED:
            table.clear()
        found = list(map(table.get, words))
        if None in found:
            new = list({w for w, ids in zip(words, found, strict=True) if ids is None})
            rest = []
            for word in new:
                bare, point = (word[:-1], word[-1]) if word and word[-1] in self.points else (word, "")
                if not self.merges or not bare.isalpha():
                    rest.append(word)
                    continue
                if bare not in table:
                    table[bare] = self.merged(blank + bare)
                table[word] = table[bare] + self.points[point]
            for start in range(0, len(rest), ENCODED):
                part = rest[start : start + ENCODED]
                coded = self.tokenizer.encode_batch_fast([blank + w if w else "" for w in part], add_special_tokens=False)
                table.update((w, array(self.code, e.ids).tobytes()) for w, e in zip(part, coded, strict=True))
            found = [table[w] for w in words]
        return found


def stretches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Stretches of rows with about STRETCH bytes of text; a longer text comes alone."""
    if batch.num_rows:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64))
        cuts = [0, *(np.flatnonzero(np.diff(ends // STRETCH)) + 1), batch.num_rows]
        yield from (batch.slice(a, b - a) for a, b in itertools.pairwise(cuts))


@lru_cache(maxsize=1)
def worker_encoder(vocabulary: str, dtype: str, end_id: int) -> Encoder:
    return Encoder(vocabulary, np.dtype(dtype), end_id)


def file_type(vocabulary_size: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary_size <= 1 << 16 else "<u4")


def write_shards(docs: DataFrame, folder: str, vocabulary: str, end_id: int, dtype: np.dtype) -> DataFrame:
    """Encodes docs (doc_id, text) into shard files under folder; the manifest, stored there too."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, context = worker_encoder(vocabulary, dtype.str, end_id), TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        path = f"shard-{context.partitionId():06d}-{uuid.uuid4().hex}"
        ids, ends, total = [], [], 0
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{path}.tokens") as out:
            for batch in (part for b in slices(batches, MOST_ROWS) for part in stretches(b)):
                coded, counts = encoder.encode_all(batch.column("text"))
                out.write(coded)
                ids += batch.column("doc_id").fill_null(NULL_ID).to_pylist()
                ends += (total + np.cumsum(counts)).tolist()
                total = ends[-1]
        for name, values in (("offsets", [0, *ends]), ("doc_ids", ids)):
            with store.open_output_stream(f"{root}/{path}.{name}") as out:
                out.write(np.array(values, dtype="<i8").tobytes())
        if ids:
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([context.partitionId()], pa.int32()), "path": [path], "n_docs": [len(ids)], "n_tokens": [total]})

    keyed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("_hash"))
    laid = keyed.repartitionByRange("doc_id", "_hash").sortWithinPartitions("doc_id", "_hash").drop("_hash")
    laid.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def with_bases(manifest: DataFrame) -> DataFrame:
    """The manifest with the number of ids in all shards before each: one row per shard, so one window is enough."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def mapped(folder: str, path: str, kind: str, dtype: np.dtype) -> np.ndarray:
    """A shard's file as an array: memory-mapped from a mounted folder, read in whole from other stores."""
    store, root = fs.FileSystem.from_uri(folder)
    name = f"{root}/{path}.{kind}"
    if store.get_file_info(name).size == 0:
        return np.zeros(0, dtype=dtype)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(name, dtype=dtype, mode="r")
    with store.open_input_file(name) as source:
        return np.frombuffer(source.read(), dtype=dtype)


def read_documents(manifest: DataFrame, folder: str, dtype: np.dtype) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per document, from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens = mapped(folder, row["path"], "tokens", dtype)
                offsets, ids = (mapped(folder, row["path"], kind, np.dtype("<i8")) for kind in ("offsets", "doc_ids"))
                crc = [zlib.crc32(tokens[a:b].astype("<u4").tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.array(ids), mask=np.array(ids) == NULL_ID), pa.array(offsets[:-1] + row["base"]),
                    pa.array(np.diff(offsets)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    shards = with_bases(manifest)
    spread = shards.repartition(shards.sparkSession.sparkContext.defaultParallelism * 4, "shard")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, vocabulary: str, end_id: int = 2, vocabulary_size: int = 50257) -> DataFrame:
    """Writes the files of docs to a new folder in the shared one and returns what they hold per document."""
    folder, dtype = new_folder(docs.sparkSession, "tokens"), file_type(vocabulary_size)
    return read_documents(write_shards(docs, folder, vocabulary, end_id, dtype), folder, dtype)
