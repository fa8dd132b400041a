"""Token-id output: flat unsigned integer files with 64-bit document offsets.

The documents are range-partitioned and sorted by id; each task encodes its range
and writes one flat file of little-endian unsigned integers (16 bits if the
vocabulary allows, else 32), one file of 64-bit offsets into it, and the ids of its
documents.  A task returns one manifest row, so the driver sees as many rows
as there are partitions.  The base of a partition is the prefix sum of the token
counts before it.  Readers map the files into memory.

Attempts write files of their own and only the manifest of the successful one is
used, so retried or speculative tasks do no harm.  The folder must be shared by
all executors (the checkpoint folder by default); folders of a remote store are
read by ranges instead of being mapped.

Defined results: null and empty texts are the end id alone.  The string of an added token
in a text becomes that token, as in the tokenizer's plain call.  Rows are ordered by id
(nulls first), then by the hash of the text; repeated rows are all written.  An empty
table gives an empty manifest.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleflow.llm.common import shared_path, ship

# Fixed value: the pre-tokenizer pattern of byte-level tokenizers.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BREAK = re.compile(r"(?<=\S)(?= )")
_UNSAFE = re.compile(r"\s ")
#: Bounds of what a worker keeps, and of the length of a kept piece.
MAX_PARTS, MAX_WORDS, MAX_KEPT_CHARS = 500_000, 100_000, 48
#: Below this code point all versions of Unicode agree on what is a letter or a number.
_SETTLED = "\u0530"


@lru_cache(maxsize=4)
def load_tokenizer(path: str, literal: bool = False):
    """The tokenizer as its file has it: the string of an added token in a text is that token.
    With ``literal`` the strings of special tokens are ordinary text."""
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.encode_special_tokens = literal
    return out


def byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: printable Latin-1
    characters stand for themselves, the others for the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Kept(dict):
    """Values made when first asked for, up to a number of entries."""

    def __init__(self, make, most: int):
        self.make, self.most = make, most

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= MAX_KEPT_CHARS:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class Encoder:
    """Encodes texts to flat integers with a tokenizer of the tokenizers library.

    A byte-level pre-tokenizer never joins a space to what stands before it, so a text may
    be cut before each space that follows a character other than white space.  Such a
    part is cut by the pre-tokenizer's pattern, and the model encodes the pieces; parts and
    pieces that were encoded before are kept, up to a bound.  Other
    tokenizers, and parts of letters on which versions of Unicode differ, go to the tokenizer whole.
    Texts are cut at added tokens first, the longest of those that begin at a place; texts with
    added tokens that take in spaces or stand for whole words only go to the tokenizer whole.
    """

    def __init__(self, path: str, literal: bool = False):
        import regex

        self.tokenizer = load_tokenizer(path, literal)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        spec = json.loads(self.tokenizer.to_str())
        pre = spec["pre_tokenizer"] or {}
        self.by_parts = (spec["model"]["type"], pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex", True),
                         spec["normalizer"]) == ("BPE", "ByteLevel", False, True, None)
        added = [t for t in spec.get("added_tokens", []) if t["content"] and not (literal and t["special"])]
        self._added = {t["content"]: self._pack([t["id"]]) for t in added}
        self._plain = len({t["normalized"] for t in added}) < 2 and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
        self._marks = re.compile("(" + "|".join(map(re.escape, sorted(self._added, key=len, reverse=True))) + ")") if added else None
        self._letters, self._cut = byte_letters(), regex.compile(PIECES).findall
        self._tokenize = self.tokenizer.model.tokenize
        self._words = _Kept(self._model, MAX_WORDS)
        self._parts = _Kept(self._part, MAX_PARTS)

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_parts:
            return [self._pack(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return [self._marked(t) if self._marks and self._marks.search(t) else self._encode(t) for t in texts]

    def _marked(self, text: str) -> bytes:
        """A text in which added tokens stand."""
        if not self._plain:
            return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        parts = self._marks.split(text)
        return b"".join([self._added[p] if i % 2 else self._encode(p) for i, p in enumerate(parts)])

    def _pack(self, ids: list[int]) -> bytes:
        return array("H" if self.dtype.itemsize == 2 else "I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, self.dtype).tobytes()

    def _encode(self, text: str) -> bytes:
        if not text:
            return b""
        if _UNSAFE.search(text):
            first, *rest = _BREAK.split(text)
            return self._whole(first) + b"".join([self._parts[p[1:]] if p[1:2] != " " else self._whole(p) for p in rest])
        first, *rest = text.split(" ")
        return (self._whole(first) if first else b"") + b"".join(map(self._parts.__getitem__, rest))

    def _part(self, part: str) -> bytes:
        """A space and ``part``, which has no space."""
        if part.isalpha() and (part.isascii() or max(part) < _SETTLED):
            return self._model(" " + part)
        return self._whole(" " + part)

    def _whole(self, text: str) -> bytes:
        if not text.isascii() and max(text) >= _SETTLED:
            return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join([self._parts[p[1:]] if p[0] == " " and p[1:].isalpha() else self._words[p] for p in self._cut(text)])

    def _model(self, piece: str) -> bytes:
        letters = piece.encode("utf-8").decode("latin-1").translate(self._letters)
        return self._pack([t.id for t in self._tokenize(letters)])


@lru_cache(maxsize=2)
def worker_encoder(path: str, literal: bool = False) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(path, literal)


def _files(folder: str):
    """(file system, path below it) of a folder given as a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


class FlatFile:
    """Ranges of a flat integer file: mapped into memory, or read from a remote store."""

    def __init__(self, folder: str, name: str, dtype):
        from pyarrow import fs

        store, path = _files(folder)
        self.dtype, self.remote, self.mapped = np.dtype(dtype), None, None
        if isinstance(store, fs.LocalFileSystem):
            empty = store.get_file_info(f"{path}/{name}").size == 0
            self.mapped = np.zeros(0, dtype) if empty else np.memmap(f"{path}/{name}", dtype=dtype, mode="r")
        else:
            self.remote = store.open_input_file(f"{path}/{name}")

    def __getitem__(self, span: slice) -> np.ndarray:
        if self.remote is None:
            return self.mapped[span]
        n = self.dtype.itemsize
        return np.frombuffer(self.remote.read_at((span.stop - span.start) * n, span.start * n), self.dtype)


@dataclass(frozen=True)
class TokenDataset:
    folder: str
    dtype: str
    #: (partition, file stem, documents, tokens, base) in order of id
    parts: tuple


def write(docs: DataFrame, tokenizer_path: str, end_id: int = 0, folder: str | None = None) -> TokenDataset:
    """Encode ``docs`` (doc_id, text), append ``end_id`` to each, write the files."""
    spark = docs.sparkSession
    ship(spark)
    folder = folder or shared_path(spark, "tokens")

    def run(batches):
        import uuid

        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        stem = f"part-{part:06d}-{uuid.uuid4().hex[:8]}"
        encoder = worker_encoder(tokenizer_path)
        end = np.array([end_id], encoder.dtype).tobytes()
        store, path = _files(folder)
        n_docs = n_tokens = 0
        writer = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                store.create_dir(path, recursive=True)
                tokens, offsets = store.open_output_stream(f"{path}/{stem}.tokens"), store.open_output_stream(f"{path}/{stem}.offsets")
                ids = store.open_output_stream(f"{path}/{stem}.ids")
                offsets.write(np.zeros(1, "<i8").tobytes())
                writer = pa.ipc.new_file(ids, pa.schema([("doc_id", batch.column(0).type)]))
            texts = batch.column(1).to_pylist()
            for i in range(0, len(texts), 500):
                encoded = encoder.encode([t or "" for t in texts[i:i + 500]])
                tokens.write(b"".join(x for e in encoded for x in (e, end)))
                sizes = np.fromiter((len(e) // encoder.dtype.itemsize + 1 for e in encoded), np.int64, len(encoded))
                offsets.write((n_tokens + np.cumsum(sizes)).astype("<i8").tobytes())
                n_tokens += int(sizes.sum())
            writer.write_batch(pa.record_batch([batch.column(0)], names=["doc_id"]))
            n_docs += len(texts)
        if writer is not None:
            writer.close()
            for f in (tokens, offsets, ids):
                f.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "stem": [stem], "docs": [n_docs], "tokens": [n_tokens], "dtype": [encoder.dtype.str]})

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).repartitionByRange("doc_id", "h") \
        .sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    manifest = sorted(rows.mapInArrow(run, "part long, stem string, docs long, tokens long, dtype string").collect())
    bases = np.concatenate(([0], np.cumsum([m["tokens"] for m in manifest], dtype=np.int64)))
    return TokenDataset(folder, manifest[0]["dtype"] if manifest else "<u2",
                        tuple((m["part"], m["stem"], m["docs"], m["tokens"], int(b)) for m, b in zip(manifest, bases)))


def read(spark: SparkSession, data: TokenDataset, id_type: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files; with
    ``with_ids`` also ``ids``, as little-endian unsigned 32-bit integers."""
    ship(spark)
    folder, dtype = data.folder, data.dtype

    def run(batches):
        import pyarrow as pa

        store, path = _files(folder)
        for batch in batches:
            for part in batch.to_pylist():
                tokens = FlatFile(folder, part["stem"] + ".tokens", dtype)
                offsets = FlatFile(folder, part["stem"] + ".offsets", "<i8")
                with store.open_input_file(f"{path}/{part['stem']}.ids") as f:
                    at = 0
                    reader = pa.ipc.open_file(f)
                    for k in range(reader.num_record_batches):
                        doc_ids = reader.get_batch(k).column(0)
                        for i in range(0, len(doc_ids), 500):
                            some = doc_ids.slice(i, 500)
                            off = np.asarray(offsets[slice(at, at + len(some) + 1)])
                            begin = int(off[0])
                            flat = memoryview(np.asarray(tokens[slice(begin, int(off[-1]))]).astype("<u4")).cast("B")
                            own = [flat[4 * a:4 * b] for a, b in zip((off[:-1] - begin).tolist(), (off[1:] - begin).tolist())]
                            at += len(some)
                            columns = [some, pa.array(part["base"] + off[:-1]), pa.array(off[1:] - off[:-1]),
                                       pa.array([zlib.crc32(x) for x in own], pa.int64())]
                            names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                            if with_ids:
                                columns, names = [*columns, pa.array([bytes(x) for x in own], pa.binary())], [*names, "ids"]
                            yield pa.RecordBatch.from_arrays(columns, names=names)

    parts = spark.createDataFrame(list(data.parts), "part long, stem string, docs long, tokens long, base long")
    schema = f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return parts.repartition(max(1, len(data.parts))).mapInArrow(run, schema)
