"""Token-id files of independent zstandard frames with a trailing seek table.

A file holds documents in ascending order of ``doc_id``:

* data frames, each an own zstandard frame with its content checksum. Content:
  number of documents (u32), then per document whether it has an id (u8), all
  ids (i64), all numbers of tokens (u32), then the token ids (u32);
* a skippable frame with the document index, an entry per data frame: first
  and last document id (i64), whether the first one is null (u8), documents
  (u32) and tokens (u64);
* a skippable frame in the layout of the public zstandard seekable format: per
  data frame its compressed and plain size and a checksum (u32 each, the low
  half of xxh64 over the content), then the number of frames (u32), a
  descriptor (u8, 0x80: with checksums) and a magic number.

Numbers are little-endian. A reader takes the two tables from the end of the
file and then decompresses only the frames that hold what it looks for.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import sized_batches, stored
from tidemark.llm.tokens import ID_BYTES, packed, word_encoder
from tidemark.sources.scratch import shared_folder

# Fixed values of the public format.
SEEK_TABLE_FRAME = 0x184D2A5E
INDEX_FRAME = 0x184D2A50
SEEKABLE_END = 0x8F92EAB1
WITH_CHECKSUMS = 0x80

SEEK_ENTRY = struct.Struct("<III")
INDEX_ENTRY = struct.Struct("<qqBIQ")
FOOTER = struct.Struct("<IBI")
SKIPPABLE = struct.Struct("<II")

FRAME_TOKENS = 65_536
# A task reads whole files; of small ones those that start within so many tokens.
READ_TOKENS = 1 << 20

Document = tuple[int | None, bytes]


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def frame_content(documents: list[Document]) -> bytes:
    known = np.array([doc_id is not None for doc_id, _ in documents], "u1")
    ids = np.array([doc_id or 0 for doc_id, _ in documents], "<i8")
    sizes = np.array([len(tokens) // ID_BYTES for _, tokens in documents], "<u4")
    head = struct.pack("<I", len(documents)) + known.tobytes() + ids.tobytes() + sizes.tobytes()
    return head + b"".join(tokens for _, tokens in documents)


def frame_documents(content: bytes) -> list[Document]:
    (n,) = struct.unpack_from("<I", content)
    known = np.frombuffer(content, "u1", n, 4)
    ids = np.frombuffer(content, "<i8", n, 4 + n)
    sizes = np.frombuffer(content, "<u4", n, 4 + 9 * n).astype(np.int64)
    ends = 4 + 13 * n + np.cumsum(sizes) * ID_BYTES
    return [
        (int(i) if k else None, content[end - size * ID_BYTES : end])
        for i, k, size, end in zip(ids, known, sizes, ends.tolist(), strict=True)
    ]


class FrameWriter:
    """Writes documents, in the order given, to one open file."""

    def __init__(self, out, frame_tokens: int = FRAME_TOKENS) -> None:
        self._out = out
        self._most = frame_tokens * ID_BYTES
        self._compress = zstandard.ZstdCompressor(level=3, write_checksum=True).compress
        self._open: list[Document] = []
        self._bytes = 0
        self._seek: list[bytes] = []
        self._index: list[bytes] = []
        self.documents = self.tokens = 0

    def add(self, doc_id: int | None, tokens: bytes) -> None:
        self._open.append((doc_id, tokens))
        self._bytes += len(tokens)
        if self._bytes >= self._most:
            self._flush()

    def _flush(self) -> None:
        if not self._open:
            return
        content = frame_content(self._open)
        frame = self._compress(content)
        self._out.write(frame)
        check = xxhash.xxh64_intdigest(content) & 0xFFFFFFFF
        self._seek.append(SEEK_ENTRY.pack(len(frame), len(content), check))
        first, last, n = self._open[0][0], self._open[-1][0], self._bytes // ID_BYTES
        self._index.append(
            INDEX_ENTRY.pack(first or 0, last or 0, first is None, len(self._open), n)
        )
        self.documents += len(self._open)
        self.tokens += n
        self._open, self._bytes = [], 0

    def close(self) -> None:
        self._flush()
        index = b"".join(self._index) + struct.pack("<I", len(self._index))
        self._out.write(SKIPPABLE.pack(INDEX_FRAME, len(index)) + index)
        table = b"".join(self._seek)
        table += FOOTER.pack(len(self._seek), WITH_CHECKSUMS, SEEKABLE_END)
        self._out.write(SKIPPABLE.pack(SEEK_TABLE_FRAME, len(table)) + table)
        self._out.close()


class FrameReader:
    """Reads the tables of an open seekable file, then single frames."""

    def __init__(self, source) -> None:
        self._source = source
        size = source.size()
        n, flags, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE_END or flags != WITH_CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        table = n * SEEK_ENTRY.size + FOOTER.size
        index = n * INDEX_ENTRY.size + 4
        begin = size - table - SKIPPABLE.size - index
        self.seek = list(SEEK_ENTRY.iter_unpack(self._at(size - table, n * SEEK_ENTRY.size)))
        self.index = list(INDEX_ENTRY.iter_unpack(self._at(begin, n * INDEX_ENTRY.size)))
        self._starts = np.concatenate([[0], np.cumsum([s[0] for s in self.seek], dtype=np.int64)])
        self._plain = zstandard.ZstdDecompressor()

    def _at(self, offset: int, n: int) -> bytes:
        self._source.seek(int(offset))
        return self._source.read(n)

    def frame(self, k: int) -> list[Document]:
        packed, plain, check = self.seek[k]
        content = self._plain.decompress(
            self._at(self._starts[k], packed), max_output_size=max(plain, 1)
        )
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} does not match its checksum")
        return frame_documents(content)

    def find(self, wanted: set[int]) -> Iterator[Document]:
        """The wanted documents; frames without any stay compressed."""
        for k, (first, last, unknown, _, _) in enumerate(self.index):
            if any((unknown or first <= w) and w <= last for w in wanted):
                yield from (d for d in self.frame(k) if d[0] in wanted)


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, path: str, frame_tokens: int = FRAME_TOKENS
) -> DataFrame:
    """Encode every text, end it with `end_id`, and write the files below `path`.

    Documents are dealt by ranges of ``doc_id``, so the files in the order of
    ``file_no`` hold them in ascending order; the size of a file is that of a
    shuffle partition. Null ids come first, rows with equal ids in any order, a
    null or empty text is the end id alone. Returns the stored list of files:
    ``file_no, path, documents, tokens, start`` (tokens in the files before).
    A repeated task writes a new file, and only files of tasks that ended well
    are listed. No documents: no files. `path` is a folder that all executors
    reach, of any kind that pyarrow's file systems know. The list has a row for
    each file and is itself written as one file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        end = packed([end_id])
        number = TaskContext.get().partitionId()
        name = f"{path}/{number:06d}-{uuid.uuid4().hex}.ids.zst"
        writer = None
        for batch in sized_batches(batches, "text"):
            doc_ids, coded = batch.column("doc_id"), encoder.encode_all(batch.column("text"))
            for doc_id, ids in zip(doc_ids.to_pylist(), coded, strict=True):
                if writer is None:
                    files, inner = _filesystem(name)
                    files.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                    # The name's ending must not make the stream compress once more.
                    out = files.open_output_stream(inner, compression=None)
                    writer = FrameWriter(out, frame_tokens)
                writer.add(doc_id, ids + end)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "file_no": number,
                        "path": name,
                        "documents": writer.documents,
                        "tokens": writer.tokens,
                    }
                ]
            )

    files = stored(
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(F.asc_nulls_first("doc_id"))
        .sortWithinPartitions(F.asc_nulls_first("doc_id"))
        .mapInArrow(write, "file_no long, path string, documents long, tokens long")
        .repartition(1),
        "token-files",
    )
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_token_files(files: DataFrame, wanted: Iterable[int] | None = None) -> DataFrame:
    """The documents in the files: ``doc_id, start, n_tokens, ids``.

    ``start`` counts the tokens of all documents before it over all files. With
    `wanted`, a short list of ids, only these, and only their frames are read.
    Files that start within the same `READ_TOKENS` tokens are read by one task.
    """
    chosen = None if wanted is None else set(wanted)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"], strict=True):
                system, inner = _filesystem(path)
                with system.open_input_file(inner) as source:
                    reader = FrameReader(source)
                    for k, entry in enumerate(reader.index):
                        first, last, unknown = entry[:3]
                        if chosen is None or any(
                            (unknown or first <= w) and w <= last for w in chosen
                        ):
                            yield _rows(reader.frame(k), start, chosen)
                        start += entry[4]

    dealt = files.select(
        "file_no", "path", "start", F.floor(F.col("start") / READ_TOKENS).alias("part")
    )
    many = max(1, dealt.select("part").distinct().count())
    return (
        dealt.repartitionByRange(many, "part")
        .sortWithinPartitions("file_no")
        .mapInPandas(read, "doc_id long, start long, n_tokens long, ids binary")
    )


def _rows(documents: list[Document], start: int, chosen: set[int] | None) -> pd.DataFrame:
    sizes = np.array([len(tokens) // ID_BYTES for _, tokens in documents], np.int64)
    frame = pd.DataFrame(
        {
            "doc_id": pd.array([doc_id for doc_id, _ in documents], "Int64"),
            "start": start + np.cumsum(sizes) - sizes,
            "n_tokens": sizes,
            "ids": [tokens for _, tokens in documents],
        }
    )
    return frame if chosen is None else frame[frame["doc_id"].isin(chosen)]


def token_folder(spark: SparkSession) -> str:
    return shared_folder(spark, "token-ids")
