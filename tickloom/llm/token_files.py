"""Token ids in files of independent zstandard frames with a seek table at the end.

A file is a sequence of frames, each of ``FRAME`` ids (the last one of fewer) as little-endian whole numbers of
two or four bytes; a frame can be decompressed on its own and carries its checksum. Behind them come two
skippable frames, so any zstandard tool unpacks the file to its ids:

* the document index: how many bytes an id has, the ids of a frame, each document's doc_id and number of ids;
* the seek table of the public zstandard seekable format: compressed size, size and checksum (the low 32 bits
  of XXH64) of each frame, then the number of frames and a magic number, from which a reader starts.

A document's ids are found from its place in the stream: its frames are read and decompressed, no others.

``TokenFiles`` is a Spark data source. Write tasks write files of their own and report them; only the list
written at the commit (``LIST``) makes them part of the table, with the number of ids before each. So what a
failed or repeated task has left is never read. Files are reached by pyarrow's file systems, on every
executor; the folder has to be one that all share.

Defined cases: a null or empty text has the end id only; null ids come last; documents with equal ids come one
after the other, in any order; repeated rows are written one by one; of an empty table comes a list of no files.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from tokenizers import Tokenizer

from tickloom.llm.tables import parts, private, small_batches
from tickloom.session import scratch

VOCABULARY, END = "word_bpe_49k", 1
#: Ids in a frame, and ids and documents from which on a task starts another file.
FRAME, ROLL_IDS, ROLL_DOCS = 1 << 16, 1 << 26, 1 << 20
#: Ids that a reader hands on at once (one document may have more).
BATCH = 1 << 20
FORMAT, LIST = "token_frames", "_tokens.json"
LEVEL = 3

# The zstandard seekable format.
_SKIP_INDEX, _SKIP_TABLE, _SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_CHECKSUMS = 0x80

_HEAD = struct.Struct("<4sBIQQI")
_NAME = b"TKF1"
#: Both libraries treat these characters alike; other texts go to the reference tokenizer itself.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-ɏ]*")
_LONGEST = 400
#: Words whose ids a task keeps.
WORDS = 300_000


class Encoder(dict):
    """Ids of a ``tokenizers`` vocabulary of words with an end mark, as two bytes an id. It keeps those of words it has seen, up to ``WORDS``.

    Words of plain texts are split off by the vocabulary's own pattern, written out for plain characters, and go
    through ``tiktoken``, with the same ids: a space behind a word serves as its end mark, so that "letter, space" is what the
    vocabulary calls "letter</w>". All other texts, and very long words, go to the reference tokenizer itself.
    """

    def __init__(self, vocabulary: str = VOCABULARY) -> None:
        name = public_tokenizers.path(f"{vocabulary}.json")
        self.exact = Tokenizer.from_file(name)
        with open(name, encoding="utf-8") as file:
            rules = json.load(file)
        letters, numbers = (_class(kind) for kind in "LN")
        pattern = rules["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        pattern = pattern.replace("[\\p{L}]", f"[{letters}]").replace("[\\p{N}]", f"[{numbers}]").replace("\\p{L}\\p{N}", letters + numbers)
        # Only one alternative can start with a letter; it is tried first, as it is the usual one.
        self.words = re.compile("|".join(sorted(pattern.split("|"), key=lambda x: x != f"[{letters}]+")))
        suffix, printed = rules["model"]["end_of_word_suffix"], _printed_bytes()
        ranks = {}
        for token, number in rules["model"]["vocab"].items():
            ends = token.endswith(suffix) and token != suffix
            ranks[bytes(printed[c] for c in token.removesuffix(suffix if ends else "")) + (b" " if ends else b"")] = number
        ranks[b" "] = len(ranks)
        if len(ranks) > 1 << 16:
            raise ValueError("ids don't fit two bytes")
        self.fast = tiktoken.Encoding(vocabulary, pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORDS:
            self.clear()
        ids = self.fast.encode_ordinary(f"{word} ") if len(word) <= _LONGEST else self.exact.encode(word, add_special_tokens=False).ids
        self[word] = array("H", ids).tobytes()
        return self[word]

    def packed(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(self.__getitem__, self.words.findall(text.lower())))
        return array("H", self.exact.encode(text, add_special_tokens=False).ids).tobytes()


def _class(kind: str) -> str:
    """The plain characters of a Unicode category, for a pattern's brackets."""
    return "".join(re.escape(c) for c in map(chr, [*range(0x20, 0x7F), *range(0xA1, 0x250)]) if unicodedata.category(c)[0] == kind)


def _printed_bytes() -> dict[str, int]:
    """Byte-level vocabularies print each byte as a character: itself if it is visible, else one from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it, of a path as Spark writes it."""
    path = re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(path)


class FileWriter:
    """One file: ``add`` documents, then ``close``."""

    def __init__(self, path: str, width: int, frame: int = FRAME) -> None:
        system, name = place(path)
        self.out, self.kind, self.frame = system.open_output_stream(name, compression=None), np.dtype(f"<u{width}"), frame
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.table: list[tuple[int, int, int]] = []
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.doc_ids: list[int | None] = []
        self.sizes: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.sizes.append(len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= self.frame:
            every = np.concatenate(self.held)
            whole = len(every) // self.frame * self.frame
            for at in range(0, whole, self.frame):
                self._put(every[at : at + self.frame])
            self.held, self.n_held = [every[whole:]], len(every) - whole

    def _put(self, ids: np.ndarray) -> None:
        data = ids.astype(self.kind).tobytes()
        packed = self.compressor.compress(data)
        self.out.write(packed)
        self.table.append((len(packed), len(data), xxhash.xxh64(data).intdigest() & 0xFFFFFFFF))

    def _index(self) -> bytes:
        none = np.array([d is None for d in self.doc_ids], dtype=bool)
        columns = [
            np.array([0 if d is None else d for d in self.doc_ids], "<i8").tobytes(),
            np.packbits(none).tobytes(),
            np.array(self.sizes, "<u8").tobytes(),
        ]
        packed = zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(columns))
        return _HEAD.pack(_NAME, self.kind.itemsize, self.frame, len(self.sizes), self.n_ids, zlib.crc32(packed)) + packed

    def close(self) -> None:
        if self.n_held:
            self._put(np.concatenate(self.held))
        index = self._index()
        self.out.write(struct.pack("<II", _SKIP_INDEX, len(index)) + index)
        entries = [*self.table, (8 + len(index), 0, 0)]
        table = b"".join(struct.pack("<III", *e) for e in entries) + struct.pack("<IBI", len(entries), _CHECKSUMS, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIP_TABLE, len(table)) + table)
        self.out.close()


class FileReader:
    """Documents of one file, by their number in it."""

    def __init__(self, path: str) -> None:
        system, name = place(path)
        self.file = system.open_input_file(name)
        size = self.file.size()
        frames, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != _SEEKABLE:
            raise ValueError(f"{path} doesn't end with a seek table")
        length = 12 * frames
        self.table = np.frombuffer(self.file.read_at(length, size - 9 - length), "<u4").reshape(-1, 3)
        ends = np.cumsum(self.table[:, 0], dtype=np.int64)
        self.offsets = ends - self.table[:, 0]
        index = self.file.read_at(int(self.table[-1, 0]) - 8, int(self.offsets[-1]) + 8)
        name, width, self.frame, docs, _, check = _HEAD.unpack_from(index)
        packed = index[_HEAD.size :]
        if name != _NAME or zlib.crc32(packed) != check:
            raise ValueError(f"the document index of {path} is damaged")
        columns = zstandard.ZstdDecompressor().decompress(packed)
        bits = (docs + 7) // 8
        self.kind = np.dtype(f"<u{width}")
        self.doc_ids = np.frombuffer(columns, "<i8", docs)
        self.none = np.unpackbits(np.frombuffer(columns, np.uint8, bits, 8 * docs), count=docs).astype(bool)
        self.bounds = np.concatenate([[0], np.cumsum(np.frombuffer(columns, "<u8", docs, 8 * docs + bits))]).astype(np.int64)
        self.decompressor = zstandard.ZstdDecompressor()
        self.last: tuple[int, np.ndarray] = (-1, np.zeros(0, self.kind))
        #: Frames decompressed so far.
        self.n_read = 0

    def _frame(self, number: int) -> np.ndarray:
        if self.last[0] != number:
            packed = self.file.read_at(int(self.table[number, 0]), int(self.offsets[number]))
            data = self.decompressor.decompress(packed)
            if len(data) != self.table[number, 1] or xxhash.xxh64(data).intdigest() & 0xFFFFFFFF != self.table[number, 2]:
                raise ValueError(f"frame {number} is damaged")
            self.last = number, np.frombuffer(data, self.kind)
            self.n_read += 1
        return self.last[1]

    def ids(self, number: int) -> np.ndarray:
        """The ids of the document with this number."""
        at, to = int(self.bounds[number]), int(self.bounds[number + 1])
        pieces = [np.zeros(0, self.kind)]
        for k in range(at // self.frame, -(-to // self.frame)):
            low = k * self.frame
            pieces.append(self._frame(k)[max(at - low, 0) : to - low])
        return np.concatenate(pieces).astype("<u4")

    def wanted(self, doc_ids: set[int] | None) -> np.ndarray:
        """Numbers of the documents with these ids; of all, if None."""
        if doc_ids is None:
            return np.arange(len(self.doc_ids))
        return np.flatnonzero(np.isin(self.doc_ids, np.array(sorted(doc_ids), dtype=np.int64)) & ~self.none)


def listed(path: str) -> list[dict]:
    """The files of a table: name, docs, ids, first and last (smallest and largest doc_id), start (ids of all files before)."""
    system, name = place(path)
    if system.get_file_info(f"{name}/{LIST}").type == fs.FileType.NotFound:
        return []
    with system.open_input_stream(f"{name}/{LIST}") as file:
        return json.loads(file.read())


@dataclass
class _Files(WriterCommitMessage):
    partition: int
    files: list[dict]


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, width: int, overwrite: bool) -> None:
        self.path, self.width, self.overwrite = path, width, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Files:
        partition, done, file = TaskContext.get().partitionId(), [], None
        system, folder = place(self.path)
        system.create_dir(folder)

        def end() -> None:
            file.close()
            known = [d for d in file.doc_ids if d is not None]
            ends = {"first": min(known, default=None), "last": max(known, default=None)}
            done.append({"name": name, "docs": len(file.sizes), "ids": file.n_ids, **ends})

        for batch in iterator:
            for doc_id, blob in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if file is None:
                    name = f"part-{partition:05d}-{len(done):05d}-{uuid.uuid4().hex}.tokens.zst"
                    file = FileWriter(f"{self.path}/{name}", self.width)
                file.add(doc_id, np.frombuffer(blob, f"<u{self.width}"))
                if file.n_ids >= ROLL_IDS or len(file.sizes) >= ROLL_DOCS:
                    end()
                    file = None
        if file is not None:
            end()
        return _Files(partition, done)

    def commit(self, messages: list[_Files | None]) -> None:
        files = [] if self.overwrite else listed(self.path)
        start = sum(f["ids"] for f in files)
        for message in sorted((m for m in messages if m is not None), key=lambda m: m.partition):
            for f in message.files:
                files.append({**f, "start": start})
                start += f["ids"]
        system, folder = place(self.path)
        system.create_dir(folder)
        aside = f"{folder}/{LIST}.{uuid.uuid4().hex}"
        with system.open_output_stream(aside) as out:
            out.write(json.dumps(files).encode())
        system.move(aside, f"{folder}/{LIST}")

    def abort(self, messages: list[_Files | None]) -> None:
        system, folder = place(self.path)
        for message in messages:
            for f in message.files if message is not None else []:
                system.delete_file(f"{folder}/{f['name']}")


class _File(InputPartition):
    def __init__(self, name: str, start: int) -> None:
        self.name, self.start = name, start


class _Reader(DataSourceReader):
    def __init__(self, path: str, doc_ids: set[int] | None) -> None:
        self.path, self.doc_ids = path, doc_ids

    def partitions(self) -> list[InputPartition]:
        def holds(f: dict) -> bool:
            return self.doc_ids is None or (f["first"] is not None and any(f["first"] <= d <= f["last"] for d in self.doc_ids))

        return [_File(f["name"], f["start"]) for f in listed(self.path) if holds(f)] or [_File("", 0)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        file = FileReader(f"{self.path}/{partition.name}")
        rows, held = [], 0

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.int64(), pa.binary()], strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids"])

        for number in file.wanted(self.doc_ids).tolist():
            ids = file.ids(number)
            doc_id = None if file.none[number] else int(file.doc_ids[number])
            rows.append((doc_id, partition.start + int(file.bounds[number]), len(ids), ids.tobytes()))
            held += len(ids)
            if held >= BATCH:
                yield batch()
                rows, held = [], 0
        if rows:
            yield batch()


class TokenFiles(DataSource):
    """Tables of token ids. Write rows of doc_id and ids (binary, ``width`` bytes an id; default 2), in the order they are to have; read doc_id,
    start (ids before it), n_tokens and ids (binary, four bytes an id). Options: path, width, doc_ids (read these only)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids binary"

    def reader(self, schema) -> DataSourceReader:
        wanted = self.options.get("doc_ids")
        return _Reader(self.options["path"], None if wanted is None else {int(x) for x in wanted.split(",") if x})

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], int(self.options.get("width", 2)), overwrite)


def tokenised(docs: DataFrame, bounds: list[int], vocabulary: str = VOCABULARY, end: int = END) -> DataFrame:
    """doc_id, ids (binary, two bytes an id) and range: between which two ``bounds`` the document belongs. Among equal
    bounds documents are dealt by their ids, so no doc_id is hot."""
    highest = (1 << 63) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, edges, last = encoder(vocabulary), np.array(bounds, dtype=np.int64), array("H", [end]).tobytes()
        for batch in batches:
            doc_ids = batch.column("doc_id").cast(pa.int64())
            blobs = [own.packed(t.as_py() or "") + last for t in batch.column("text")]
            keys = np.array(doc_ids.fill_null(highest))
            low, high = np.searchsorted(edges, keys, "left"), np.searchsorted(edges, keys, "right")
            dealt = np.array([zlib.crc32(b) for b in blobs], dtype=np.int64) % (high - low + 1)
            columns = [doc_ids, pa.array(blobs, pa.binary()), pa.array(low + dealt, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "range"])

    return private(small_batches(docs), doc_id="doc_id", text="text").mapInArrow(run, "doc_id long, ids binary, range int")


def write_tokens(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end: int = END) -> None:
    """Write the ids of all documents to ``path``, in ascending order of doc_id. The vocabulary has at most 65536 ids.

    Ranges of doc_id come from approximate quantiles of that column alone, so texts are tokenised once and only ids are shuffled, once.
    """
    spark = docs.sparkSession
    spark.dataSource.register(TokenFiles)
    n = parts(spark)
    key = F.coalesce(docs["doc_id"].cast("long"), F.lit((1 << 63) - 1))
    bounds = docs.agg(F.percentile_approx(key, [i / n for i in range(1, n)], max(10_000, 100 * n)).alias("b")).first()[0] if n > 1 else []
    rows = tokenised(docs, bounds or [], vocabulary, end).repartitionById(n, F.col("range"))
    ordered = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_last()).select("doc_id", "ids")
    ordered.write.format(FORMAT).option("width", 2).mode("overwrite").save(path)


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids of a table; with ``doc_ids``, of these documents, whose frames alone are decompressed."""
    spark.dataSource.register(TokenFiles)
    reader = spark.read.format(FORMAT)
    if doc_ids is not None:
        reader = reader.option("doc_ids", ",".join(str(int(d)) for d in doc_ids))
    return reader.load(path)


def token_table(docs: DataFrame) -> DataFrame:
    """Documents written as tokens to the shared folder and read back."""
    path = scratch(docs.sparkSession, "tokens")
    write_tokens(docs, path)
    return read_tokens(docs.sparkSession, path)
