"""Token-id files: independent zstandard frames, a trailing seek table, checksums per frame.

Layout of one shard (the public zstandard seekable format): frames of ``FRAME_TOKENS`` ids
each, little-endian unsigned 16 bits (32 where the vocabulary needs them), every frame
compressed on its own; a skippable frame with the documents (ids and lengths); a skippable
frame with the seek table, which holds the compressed size, the plain size and the low 32
bits of the xxh64 of every frame.  A reader opens the tail, finds the frames that cover a
document and decompresses only these.  Documents are in ascending doc_id order within a shard
and over the shards.

Files are written to a folder URI that driver and executors share, under a name of the
attempt, and moved to their final name when whole: a task that runs again, after a lost
executor, replaces the file by the same bytes.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bikelake.llm.common import batch_of, open_folder, shared_uri, written
from bikelake.llm.tokens import default_vocabulary, encoder
from bikelake.session import scratch_path

FRAME_TOKENS = 1 << 16
# Fixed values of the public seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
DOCUMENTS_MAGIC = 0x184D2A50
SEEKABLE_MAGIC = 0x8F92EAB1


class ShardWriter:
    """Streams documents into one shard; holds at most one frame of ids, and the index."""

    def __init__(self, out, dtype: np.dtype, frame_tokens: int = FRAME_TOKENS, level: int = 1):
        import zstandard
        self.out, self.dtype, self.frame_bytes = out, dtype, frame_tokens * dtype.itemsize
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.held = bytearray()
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        # A null id is kept as a length below 0.
        self.docs.append((0, -1 - len(ids)) if doc_id is None else (doc_id, len(ids)))
        self.held += ids.astype(self.dtype, copy=False).tobytes()
        while len(self.held) >= self.frame_bytes:
            self._frame(bytes(self.held[:self.frame_bytes]))
            del self.held[:self.frame_bytes]

    def _frame(self, plain: bytes) -> None:
        import xxhash
        packed = self.zstd.compress(plain)
        self.frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.out.write(packed)

    def close(self) -> None:
        if self.held:
            self._frame(bytes(self.held))
        body = self.zstd.compress(np.array(self.docs, dtype="<i8").reshape(-1, 2).tobytes())
        body += struct.pack("<BIQ", self.dtype.itemsize, len(body), len(self.docs))
        self.out.write(struct.pack("<II", DOCUMENTS_MAGIC, len(body)) + body)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0x80, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)


class ShardReader:
    """Random access to a shard; decompresses and checks only the frames it needs."""

    def __init__(self, file, size: int):
        import zstandard
        self.file, self.zstd = file, zstandard.ZstdDecompressor()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != 0x80:
            raise ValueError("no seek table with checksums at the end of the file")
        start = size - 9 - 12 * n
        self.frames = np.frombuffer(self._at(start, 12 * n), "<u4").reshape(-1, 3).astype(np.int64)
        self.place = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        self.plain = np.concatenate([[0], np.cumsum(self.frames[:, 1])])
        end = start - 8
        width, length, docs = struct.unpack("<BIQ", self._at(end - 13, 13))
        raw = self.zstd.decompress(self._at(end - 13 - length, length)) if docs else b""
        self.dtype = np.dtype(f"<u{width}")
        self.docs = np.frombuffer(raw, "<i8").reshape(-1, 2).copy()
        self.nameless = self.docs[:, 1] < 0
        self.docs[self.nameless, 1] = -1 - self.docs[self.nameless, 1]
        self.first = np.concatenate([[0], np.cumsum(self.docs[:, 1])]) * width
        self.last = (-1, b"")

    def _at(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def _frame(self, k: int) -> bytes:
        import xxhash
        if self.last[0] != k:
            plain = self.zstd.decompress(self._at(int(self.place[k]), int(self.frames[k, 0])))
            if len(plain) != self.frames[k, 1] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.frames[k, 2]:
                raise ValueError(f"frame {k} is damaged")
            self.last = (k, plain)
        return self.last[1]

    def ids(self, row: int) -> np.ndarray:
        """Ids of the row-th document of the shard."""
        a, b = int(self.first[row]), int(self.first[row + 1])
        parts, k = [], int(np.searchsorted(self.plain, a, "right")) - 1
        while a < b:
            end = min(b, int(self.plain[k + 1]))
            parts.append(self._frame(k)[a - int(self.plain[k]):end - int(self.plain[k])])
            a, k = end, k + 1
        return np.frombuffer(b"".join(parts), self.dtype)


def write_token_files(spark: SparkSession, docs: DataFrame, folder: str | None = None, *,
                      id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
                      vocabulary: str | None = None, frame_tokens: int = FRAME_TOKENS,
                      ) -> tuple[str, DataFrame]:
    """Encode whole texts, append ``end_id``, write shards in ascending id order.

    Returns the folder and the index ``(shard, file, doc_id, n_tokens)``, one row per
    document.  A null text counts as empty (its document holds the end id alone); documents with
    a null id come first and keep the null; documents with the same id follow each other,
    ordered by text.  An empty table gives no shard.  One range shuffle of the texts; encoding
    happens after it, once.  The folder is one that all executors share, as Spark resolves it;
    it is returned with its scheme.
    """
    vocabulary = vocabulary or default_vocabulary()
    folder = shared_uri(spark, folder or scratch_path(spark, "token-files"))
    schema = pa.schema([("shard", pa.int32()), ("file", pa.string()), ("doc_id", pa.int64()),
                        ("n_tokens", pa.int64())])

    def write(batches):
        shard = TaskContext.get().partitionId()
        enc, writer, out = encoder(vocabulary), None, None
        end, fs, name, part = None, None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                fs, root = open_folder(folder)
                fs.create_dir(root, recursive=True)
                name = f"{root}/shard-{shard:06d}.tok.zst"
                part = f"{name}.{uuid.uuid4().hex}.part"
                out = fs.open_output_stream(part)
                writer, end = ShardWriter(out, enc.dtype, frame_tokens), np.array([end_id], enc.dtype)
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                writer.add(doc, np.concatenate([enc.encode(text.as_py() or ""), end]))
        if writer is not None:
            writer.close()
            out.close()
            fs.move(part, name)
            docs_, file = np.array(writer.docs, dtype=np.int64), name.rsplit("/", 1)[1]
            nameless = docs_[:, 1] < 0
            docs_[nameless, 1] = -1 - docs_[nameless, 1]
            for k in range(0, len(docs_), 50_000):
                some = docs_[k:k + 50_000]
                yield batch_of(schema, [[shard] * len(some), [file] * len(some),
                                        pa.array(some[:, 0], mask=nameless[k:k + 50_000]), some[:, 1]])

    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    index = written(spark, ordered.mapInArrow(write, "shard int, file string, doc_id long, n_tokens long"),
                    "token-index")
    return folder, index


def read_token_files(folder: str, index: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """Documents of the shards: ``(doc_id, shard, shard_start, ids)``; with ``requested``
    (its first column holds ids) only these, and only the frames that hold them are read."""
    schema = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("shard_start", pa.int64()),
                        ("ids", pa.list_(pa.int64()))])
    out = "doc_id long, shard int, shard_start long, ids array<long>"

    def read(shard, name, some):
        fs, root = open_folder(folder)
        with fs.open_input_file(f"{root}/{name}") as f:
            r = ShardReader(f, f.size())
            rows, held = ([], [], [], []), 0
            for k, (doc, n) in enumerate(r.docs.tolist()):
                doc = None if r.nameless[k] else doc
                if some is None or doc in some:
                    for c, v in zip(rows, (doc, shard, int(r.first[k]) // r.dtype.itemsize, r.ids(k))):
                        c.append(v)
                    held += n
                if held >= 1 << 18:
                    yield batch_of(schema, rows)
                    rows, held = ([], [], [], []), 0
            if rows[0]:
                yield batch_of(schema, rows)

    def every(batches):
        for batch in batches:
            for shard, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from read(shard, name, None)

    def asked(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        found = read(key[0].as_py(), rows.column("file")[0].as_py(), set(rows.column("doc_id").to_pylist()))
        return pa.Table.from_batches(found, schema=schema)

    if requested is None:
        return _shards(index).mapInArrow(every, out)
    wanted = requested.select(F.col(requested.columns[0]).cast("long").alias("doc_id")).distinct()
    return index.join(wanted, "doc_id").select("shard", "file", "doc_id").groupBy("shard").applyInArrow(asked, out)


def _shards(index: DataFrame) -> DataFrame:
    return _dealt(index.groupBy("shard").agg(F.min("file").alias("file")).select("shard", "file"))


def _dealt(shards: DataFrame) -> DataFrame:
    """One row per shard, over a stated number of tasks: the rows are tiny, what they make a task read is not."""
    return shards.repartition(int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def token_digests(folder: str, index: DataFrame) -> DataFrame:
    """Per document, read back from the files: ``doc_id, start, n_tokens, ids_crc32``; ``start``
    counts the ids of all documents before it over all shards."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def digest(batches):
        fs, root = open_folder(folder)
        for batch in batches:
            for name, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(f"{root}/{name}") as f:
                    r = ShardReader(f, f.size())
                    crc = [zlib.crc32(r.ids(k).astype("<u4").tobytes()) for k in range(len(r.docs))]
                    yield batch_of(schema, [pa.array(r.docs[:, 0], mask=r.nameless), before + r.first[:-1] // r.dtype.itemsize, r.docs[:, 1], crc])

    # One row per shard: the running total over all shards is small at any input size.
    shards = index.groupBy("shard").agg(F.min("file").alias("file"), F.sum("n_tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.orderBy("shard")) - F.col("tokens")
    return (_dealt(shards.select("file", before.alias("before")))
            .mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long"))
