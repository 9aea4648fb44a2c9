"""Token ids in files, compressed document by document with a shared dictionary.

A zstandard dictionary is trained on the serialised ids of a bounded sample of
documents. Every document is compressed by itself with it, so one can be read
without its neighbours. A file holds

    magic "TOKS", version, bytes of an id (2 or 4), SHA-256 of the dictionary
    one zstandard frame for each document
    index: for each document its id, whether the id is null, offset and length
        of its frame, number of ids
    footer: place of the index, number of documents, magic

(all little-endian); the dictionary lies beside the files under its hash.
Documents are in ascending id order within a file and over the files.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import sys
import types
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskwin.llm.batches import small_batches
from riskwin.llm.files import open_store
from riskwin.llm.langid import hash_sample
from riskwin.session import checkpoint_root, scratch_path

END_ID = 2
MAGIC, VERSION = b"TOKS", 1
HEADER, FOOTER = "<4sHH32s", "<QQ4s"
INDEX = np.dtype([("doc_id", "<i8"), ("is_null", "u1"), ("offset", "<u8"), ("length", "<u4"), ("n_ids", "<u8")])
#: Documents that the dictionary is trained on, at most about, the bytes taken
#: of each, and the dictionary's size.
SAMPLE_ROWS, SAMPLE_BYTES, DICTIONARY_BYTES = 1_000, 8_192, 32_768
LEVEL = 3
#: Text bytes of a file, on average.
FILE_BYTES = 24 << 20
#: Pieces remembered by an encoder; others are encoded each time they come.
MEMORY = 1_000_000
_WORD = re.compile(r"(\n?)([^\W\d_]+)([^\w\s]*)")
#: Name under which a Python worker keeps its encoders from task to task.
_KEPT = "_token_store_encoders"


class Encoder:
    """Ids of whole texts by a ``tokenizers`` file, as bytes.

    A byte-level tokenizer that splits words at blanks never joins what is on
    both sides of a single blank or line end, so it is asked once for each
    distinct piece between them and its answers are put together. A word of
    letters goes straight to the tokenizer's model. Texts with other white
    space, characters that don't print or a special token's string, and
    tokenizers of another kind, are encoded in one go.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's cores are Spark's
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.format = "H" if self.kind.itemsize == 2 else "I"
        parts = json.loads(self.tokenizer.to_str())
        splits, added = parts.get("pre_tokenizer") or {}, parts.get("added_tokens", [])
        self.special = [t["content"] for t in added]
        line_end = self._ids("\n")
        self.by_piece = (
            splits.get("type") == "ByteLevel" and splits.get("use_regex") and not splits.get("add_prefix_space")
            and not parts.get("normalizer") and len(line_end) == 1
            and not any(any(map(str.isspace, t["content"])) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added))
        self.line_end = line_end.tobytes()
        # ids of " word", under "word", and of a line end and "word", under
        # "\nword"; and of signs
        self.memory: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {}
        # bytes as the byte-level model spells them: printable ones as they are,
        # the rest as the characters from 256 on
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        odd = [b for b in range(256) if b not in plain]
        self.spelling = {b: 256 + i for i, b in enumerate(odd)}
        self.blank = " ".translate(self.spelling)

    @classmethod
    def kept(cls, path: str) -> "Encoder":
        """The worker's encoder for a file; workers live on from task to task."""
        encoders = sys.modules.setdefault(_KEPT, types.ModuleType(_KEPT)).__dict__
        if path not in encoders:
            encoders[path] = cls(path)
        return encoders[path]

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.kind)

    def _new(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces that are not remembered."""
        new: dict[str, bytes] = {}
        others = []
        memory, tokenize, width = self.memory, self.model.tokenize, self.format
        for piece in pieces:
            m = _WORD.fullmatch(piece)
            if m is None or not m[2].isalpha():
                others.append(piece)
                continue
            line, word, signs = m.groups()
            core = memory.get(line + word) or new.get(line + word) if signs or line else None
            if core is None:
                spelled = word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(self.spelling)
                ids = [t.id for t in tokenize(spelled if line else self.blank + spelled)]
                core = struct.pack(f"<{len(ids)}{width}", *ids)
                new[line + word] = core = self.line_end + core if line else core
            if signs:
                if signs not in self.signs:
                    if len(self.signs) > MEMORY // 10:
                        self.signs.clear()
                    self.signs[signs] = self._ids(signs).tobytes()
                new[piece] = core + self.signs[signs]
        if others:
            # a line end before each: it is always an id of its own there
            ids = self._ids("".join(p if p[0] == "\n" else f"\n {p}" for p in others))
            cuts = np.flatnonzero(ids == np.frombuffer(self.line_end, self.kind)[0]).tolist()
            for p, a, b in zip(others, cuts, [*cuts[1:], len(ids)]):
                new[p] = ids[a if p[0] == "\n" else a + 1:b].tobytes()
        if len(memory) + len(new) <= MEMORY:
            memory.update(new)
        return new

    def _whole(self, text: str) -> bytes:
        return self._ids(text).tobytes() if text else b""

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text (null: none), serialised little-endian."""
        out, known, start = [], self.memory.get, len(self.line_end)
        for text in texts:
            text = text or ""
            pieces = ("\n" + text).replace("\n", " \n").split(" ")[1:]
            if (not self.by_piece or "" in pieces or "\n" in pieces or not text.replace("\n", "").isprintable()
                    or any(s in text for s in self.special)):
                out.append(self._whole(text))
                continue
            ids = list(map(known, pieces))
            if None in ids:
                new = self._new(list({p for p, i in zip(pieces, ids) if i is None}))
                ids = [new[p] if i is None else i for p, i in zip(pieces, ids)]
            out.append(b"".join(ids)[start:])
        return out


def default_tokenizer() -> str:
    """Path of the public byte-level BPE with 50 257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def train_dictionary(rows: DataFrame, tokenizer: str, end_id: int) -> bytes:
    """Dictionary from a hash sample of documents; empty if they are too few or
    too small to train one."""
    sample = hash_sample(rows.filter("text is not null"), SAMPLE_ROWS, "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.kept(tokenizer)
        for b in batches:
            end = np.array([end_id], encoder.kind).tobytes()
            parts = [(ids + end)[:SAMPLE_BYTES] for ids in encoder.encode(b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["ids"])

    # few tasks: each loads the tokenizer for a few documents
    few = sample.select("text").repartition(2)
    parts = sorted(bytes(r["ids"]) for r in few.mapInArrow(task, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:
        return b""


def _writer(folder: str, tokenizer: str, dictionary: bytes, end_id: int) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out, index, n_ids, at = None, None, [], 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                encoder = Encoder.kept(tokenizer)
                shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
                squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
                end = np.array([end_id], encoder.kind).tobytes()
                store, base = open_store(folder)
                # a name of its own for each attempt: only files in the result count
                name = f"part-{uuid.uuid4().hex}.toks"
                out = store.open_output_stream(f"{base}/{name}")
                at = out.write(struct.pack(HEADER, MAGIC, VERSION, encoder.kind.itemsize, hashlib.sha256(dictionary).digest()))
                lead = (b.column(0)[0].as_py(), b.column(1)[0].as_py())
            for doc, ids in zip(b.column(0).to_pylist(), encoder.encode(b.column(2).to_pylist())):
                ids += end
                frame = squeeze.compress(ids)
                index.append((doc or 0, doc is None, at, len(frame), len(ids) // encoder.kind.itemsize))
                n_ids += index[-1][-1]
                at += out.write(frame)
        if out is not None:
            out.write(np.array(index, INDEX).tobytes())
            out.write(struct.pack(FOOTER, at, len(index), MAGIC))
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([lead[0]], pa.int64()), pa.array([lead[1]], pa.int64()),
                 pa.array([len(index)], pa.int64()), pa.array([n_ids], pa.int64())],
                ["file", "first_id", "first_hash", "docs", "ids"])

    return task


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID,
                      id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the files; returns their list: file, docs, ids, and ``start``, the
    number of ids in all files before.

    Every document ends with ``end_id``; a null text has that id alone. Null ids
    come first; documents with the same id follow each other by a hash of the
    text. An empty table gives no file.
    """
    spark = docs.sparkSession
    checkpoint_root(spark)
    small_batches(spark)
    tokenizer = tokenizer or default_tokenizer()
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("hash"),
                       F.col(f"`{text_col}`").alias("text"))
    dictionary = train_dictionary(rows, tokenizer, end_id)
    store, base = open_store(folder)
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/{hashlib.sha256(dictionary).hexdigest()}.dict") as f:
        f.write(dictionary)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(-(-total // file_bytes), 2 * spark.sparkContext.defaultParallelism)
    files = (
        rows.repartitionByRange(n, "id", "hash").sortWithinPartitions("id", "hash")
        .mapInArrow(_writer(folder, tokenizer, dictionary, end_id),
                    "file string, first_id long, first_hash long, docs long, ids long").checkpoint()
    )
    order = Window.orderBy("first_id", "first_hash").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", "docs", "ids", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("start")).checkpoint()


class TokenFile:
    """Reader of one file; a document is read by its place in the index."""

    def __init__(self, folder: str, name: str):
        store, base = open_store(folder)
        self.file = store.open_input_file(f"{base}/{name}")
        magic, version, width, digest = struct.unpack(HEADER, self.file.read_at(struct.calcsize(HEADER), 0))
        size = self.file.size()
        foot = struct.calcsize(FOOTER)
        at, n, tail = struct.unpack(FOOTER, self.file.read_at(foot, size - foot))
        if magic != MAGIC or tail != MAGIC or version != VERSION:
            raise ValueError(f"{name} is not a token file")
        self.index = np.frombuffer(self.file.read_at(n * INDEX.itemsize, at), INDEX)
        self.kind = np.dtype(f"<u{width}")
        with store.open_input_stream(f"{base}/{digest.hex()}.dict") as f:
            dictionary = f.read()
        if hashlib.sha256(dictionary).digest() != digest:
            raise ValueError(f"{name}: the dictionary is another one")
        self.unpack = zstandard.ZstdDecompressor(
            dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def ids(self, i: int) -> np.ndarray:
        entry = self.index[i]
        frame = self.file.read_at(int(entry["length"]), int(entry["offset"]))
        return np.frombuffer(self.unpack.decompress(frame), self.kind)

    def of_document(self, doc_id: int) -> list[np.ndarray]:
        """Ids of all documents with an id, found by bisection."""
        known = self.index[self.index["is_null"] == 0]
        nulls = len(self.index) - len(known)
        a, b = np.searchsorted(known["doc_id"], [doc_id, doc_id + 1])
        return [self.ids(nulls + i) for i in range(a, b)]


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """A row for each document: doc_id, ``start`` (ids before it), ``n_tokens``,
    ``ids_crc32`` of its ids as little-endian 32-bit integers, and the file."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                file = TokenFile(folder, name)
                n = file.index["n_ids"].astype(np.int64)
                crc = [zlib.crc32(file.ids(i).astype("<u4").tobytes()) for i in range(len(n))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.index["doc_id"].astype(np.int64), mask=file.index["is_null"].astype(bool)),
                     pa.array(start + np.cumsum(n) - n), pa.array(n), pa.array(crc, pa.int64()),
                     pa.array([name] * len(n), pa.string())],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "file"])

    count = files.count()
    spread = files.select("file", "start").repartition(max(1, count), "file") if count else files.select("file", "start")
    return spread.mapInArrow(task, "doc_id long, start long, n_tokens long, ids_crc32 long, file string")


def op9_token_store(spark, sf_dir: str) -> DataFrame:
    """All documents encoded, written and read back."""
    folder = scratch_path(spark, "tokens")
    files = write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder)
    return read_token_files(files, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
