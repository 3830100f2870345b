"""Token ids in binary files of independent Zstandard frames with a trailing seek table.

A file holds the documents of one range of ``doc_id``, in ascending order:

    data frame ...   ids of whole documents, 32-bit little-endian; a frame ends once it has FRAME_TOKENS
    skippable frame  which documents: doc_id, number of ids, frame (an Arrow stream)
    skippable frame  seek table: sizes and checksum of every frame before it, then the fixed footer

The seek table follows the public seekable format, so ordinary Zstandard tools read the files too. A reader
fetches the tail, then only the frames of the documents it wants, and holds each against its checksum.

Tasks write under names of their own attempt; what counts is the manifest, a table of the finished files,
so a lost executor leaves no more than an unlisted file.

Defined results: a null or empty text has only the end id. A null ``doc_id`` comes first. Rows with one
``doc_id`` stand in the order of a hash of their text. An empty table gives no files. Other columns are ignored.
"""

from __future__ import annotations

import io
import json
import zlib
from collections.abc import Iterable, Iterator
import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from metricloom.llm.bpe import WordEncoder, rules_of
from metricloom.llm.common import Shared, text_or_empty
from metricloom.session import materialize, scratch_path

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A50
SEEK_TABLE_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80
FOOTER_BYTES = 9
ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("checksum", "<u4")])

FRAME_TOKENS = 1 << 16
LEVEL = 3
ROWS_AT_ONCE = 256


def checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def skippable(magic: int, body: bytes) -> bytes:
    return magic.to_bytes(4, "little") + len(body).to_bytes(4, "little") + body


class LibraryEncoder(WordEncoder):
    """The library's tokenizer, asked once for each word while the tables have room."""

    UNSHIPPED = (*WordEncoder.UNSHIPPED, "model")

    def __init__(self, definition: str, kept: int = 200_000):
        self.definition = definition
        super().__init__(*rules_of(json.loads(definition)), kept)

    def ready(self) -> None:
        super().ready()
        self.model = Tokenizer.from_str(self.definition).model

    def encode_word(self, word: str) -> list[int]:
        return [token.id for token in self.model.tokenize(word)]

    def encode_wide(self, text: str) -> bytes:
        """Ids of a text as 32-bit little-endian numbers."""
        return np.frombuffer(self.encode_bytes(text), np.uint16).astype("<u4").tobytes()


class FileWriter:
    """Writes one file; ``add`` takes a document's ids as bytes."""

    def __init__(self, stream: io.RawIOBase):
        self.stream = stream
        self.compress = zstandard.ZstdCompressor(level=LEVEL).compress
        self.entries: list[tuple[int, int, int]] = []
        self.pending: list[bytes] = []
        self.pending_bytes = 0
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self.frames: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.frames.append(len(self.entries))
        self.pending.append(ids)
        self.pending_bytes += len(ids)
        if self.pending_bytes >= 4 * FRAME_TOKENS:
            self.end_frame()

    def end_frame(self) -> None:
        if self.pending:
            plain = b"".join(self.pending)
            packed = self.compress(plain)
            self.stream.write(packed)
            self.entries.append((len(packed), len(plain), checksum(plain)))
            self.pending, self.pending_bytes = [], 0

    def close(self) -> None:
        self.end_frame()
        documents = pa.record_batch(
            {"doc_id": pa.array(self.doc_ids, pa.int64()), "n_tokens": pa.array(self.lengths, pa.int64()), "frame": pa.array(self.frames, pa.int64())}
        )
        body = io.BytesIO()
        with pa.ipc.new_stream(body, documents.schema) as out:
            out.write_batch(documents)
        index = skippable(SKIPPABLE_MAGIC, self.compress(body.getvalue()))
        self.stream.write(index)
        self.entries.append((len(index), 0, checksum(b"")))
        footer = len(self.entries).to_bytes(4, "little") + bytes([HAS_CHECKSUMS]) + FOOTER_MAGIC.to_bytes(4, "little")
        self.stream.write(skippable(SEEK_TABLE_MAGIC, np.array(self.entries, ENTRY).tobytes() + footer))


class FileReader:
    """Random access to the documents of one file."""

    def __init__(self, file: pa.NativeFile):
        self.file = file
        size = file.size()
        footer = self.read(size - FOOTER_BYTES, FOOTER_BYTES)
        if int.from_bytes(footer[5:], "little") != FOOTER_MAGIC:
            raise ValueError("no seek table at the end of the file")
        count = int.from_bytes(footer[:4], "little")
        self.entries = np.frombuffer(self.read(size - FOOTER_BYTES - count * ENTRY.itemsize, count * ENTRY.itemsize), ENTRY)
        self.offsets = np.concatenate([[0], np.cumsum(self.entries["packed"], dtype=np.int64)])
        packed = self.read(int(self.offsets[count - 1]) + 8, int(self.entries["packed"][-1]) - 8)
        self.documents = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompressobj().decompress(packed)).read_all()
        self.lengths = self.documents["n_tokens"].to_numpy()
        self.frames = self.documents["frame"].to_numpy()

    def read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def frame(self, number: int) -> bytes:
        entry = self.entries[number]
        plain = zstandard.ZstdDecompressor().decompress(
            self.read(int(self.offsets[number]), int(entry["packed"])), max_output_size=int(entry["plain"])
        )
        if checksum(plain) != entry["checksum"]:
            raise ValueError(f"frame {number} does not match its checksum")
        return plain

    def ids(self, places: Iterable[int]) -> Iterator[bytes]:
        """Ids of the documents at the given places of the file, ascending; only their frames are read."""
        open_frame, plain = -1, b""
        starts = np.concatenate([[0], np.cumsum(self.lengths)]) * 4
        firsts = np.searchsorted(self.frames, np.arange(len(self.entries)))
        for place in places:
            number = int(self.frames[place])
            if number != open_frame:
                open_frame, plain = number, self.frame(number)
            begin = int(starts[place] - starts[firsts[number]])
            yield plain[begin : begin + 4 * int(self.lengths[place])]


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int, folder: str) -> DataFrame:
    """Encode and write all documents under ``folder``; the manifest, one row per file in ascending order:
    ``file, shard, n_docs, n_tokens, start`` with ``start`` the number of ids in all files before.

    ``folder`` may be in any store that ``pyarrow.fs`` opens by its address (file, hdfs, s3, gs).
    """
    with open(vocabulary, encoding="utf-8") as file:
        shared = Shared(docs.sparkSession, LibraryEncoder(file.read()))
    end = np.array([end_id], "<u4").tobytes()
    slim = docs.select("doc_id", text_or_empty().alias("text")).withColumn("tie", F.xxhash64("text"))
    order = (F.col("doc_id").asc_nulls_first(), F.col("tie"))
    ranged = slim.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, root = pafs.FileSystem.from_uri(folder)
        writer = stream = None
        name = f"tokens-{task.partitionId():06d}-{task.taskAttemptId()}.zst"
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                if writer is None:
                    store.create_dir(root, recursive=True)
                    stream = store.open_output_stream(f"{root}/{name}", compression=None)
                    writer = FileWriter(stream)
                for doc_id, ids in zip(part["doc_id"].to_pylist(), map(shared.value.encode_wide, part["text"].to_pylist()), strict=True):
                    writer.add(doc_id, ids + end)
        if writer is not None:
            writer.close()
            stream.close()
            row = {"file": [name], "shard": [task.partitionId()], "n_docs": [len(writer.lengths)], "n_tokens": [sum(writer.lengths)]}
            yield pa.record_batch(row)

    files = materialize(ranged.mapInArrow(write, "file string, shard bigint, n_docs bigint, n_tokens bigint"), "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{root}/{row['file']}") as file:
                    reader = FileReader(file)
                    lengths = reader.lengths
                    sums = [zlib.crc32(ids) for ids in reader.ids(range(len(lengths)))]
                starts = row["start"] + np.concatenate([[0], np.cumsum(lengths)])[:-1]
                yield pa.record_batch(
                    {
                        "doc_id": reader.documents["doc_id"].combine_chunks(),
                        "start": pa.array(starts, pa.int64()),
                        "n_tokens": pa.array(lengths, pa.int64()),
                        "ids_crc32": pa.array(sums, pa.int64()),
                    }
                )

    # A fixed number of tasks: by its bytes alone, the planner would read all files in one.
    spread = manifest.repartition(max(1, manifest.count()), "file")
    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_files(docs: DataFrame, vocabulary: str, end_id: int = 1) -> DataFrame:
    """Write ``docs`` to a new folder beside the checkpoints and read it back."""
    folder = scratch_path(docs.sparkSession, "token-files")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    manifest = materialize(write_token_files(docs, vocabulary, end_id, folder), "token-starts")
    return read_token_files(manifest, folder)
