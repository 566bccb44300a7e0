"""Token ids as seekable Zstandard files, readable document by document.

File layout, all integers little-endian:

* data frames: independent Zstandard frames with content checksum, each the ids
  of whole documents (at least ``frame_ids`` ids, but for a file's last one), as
  unsigned 16-bit integers when the vocabulary fits, else 32-bit;
* a skippable frame (magic 0x184D2A50) with the document index: width of an id in
  bytes (u8), count (u64), then per document null flags (u8), ids (i64) and
  lengths (u64);
* the seek table of the public seekable format as the trailing skippable frame
  (magic 0x184D2A5E): compressed size, decompressed size and the low half of the
  XXH64 of every frame, the frame count, the descriptor and 0x8F92EAB1.

A reader opens the end of a file, finds the frames that hold the documents asked
for and decompresses only these.  Files lie in the folder given (the shared
folder by default) and are written and read by the tasks through Arrow's file
systems; one file per range partition, in ascending document order.
"""

from __future__ import annotations

import struct
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoda.llm.common import batch, map_batches, slices, strings, worker_state
from recoda.llm.bpe import Encoder
from recoda.session import scratch_path

INDEX_MAGIC, SEEK_MAGIC, SEEK_FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80  # descriptor bit: entries carry checksums


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class Writer:
    """Streams documents into one file; memory holds one frame and the index."""

    def __init__(self, out, width: int, frame_ids: int):
        import zstandard

        self.out, self.width, self.frame_ids = out, width, frame_ids
        self.zstd = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
        self.buffer: list[bytes] = []
        self.size = 0
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(doc_id)
        self.lengths.append(len(ids) // self.width)
        self.buffer.append(ids)
        self.size += len(ids)
        if self.size >= self.frame_ids * self.width:
            self._flush()

    def _flush(self) -> None:
        import xxhash

        if self.buffer:
            plain = b"".join(self.buffer)
            packed = self.zstd.compress(plain)
            self.out.write(packed)
            self.frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
            self.buffer, self.size = [], 0

    def close(self) -> None:
        import numpy as np
        import xxhash

        self._flush()
        nulls = np.array([i is None for i in self.ids], np.uint8)
        ids = np.array([0 if i is None else i for i in self.ids], "<i8")
        index = struct.pack("<BQ", self.width, len(ids)) + nulls.tobytes() + ids.tobytes()
        index += np.array(self.lengths, "<u8").tobytes()
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        # a skippable frame has its entry too, with nothing to decompress
        entries = [*self.frames, (8 + len(index), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)]
        table = b"".join(struct.pack("<III", *e) for e in entries) + struct.pack(
            "<IBI", len(entries), CHECKSUMS, SEEK_FOOTER
        )
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)


class Reader:
    """Random access to one file."""

    def __init__(self, source):
        import numpy as np

        self.source = source
        end = source.seek(0, 2) or source.tell()
        count, descriptor, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEK_FOOTER or descriptor != CHECKSUMS:
            raise ValueError("not a seekable file of this layout")
        table = self._at(end - 9 - 12 * count - 8, 8 + 12 * count)
        if struct.unpack("<II", table[:8]) != (SEEK_MAGIC, 12 * count + 9):
            raise ValueError("damaged seek table")
        entries = np.frombuffer(table[8:], "<u4").reshape(count, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(entries[:, 0])])
        self.frames = entries[:-1]
        index = self._at(int(self.starts[-2]), int(entries[-1, 0]))
        if struct.unpack("<II", index[:8]) != (INDEX_MAGIC, len(index) - 8):
            raise ValueError("damaged document index")
        self.width, n = struct.unpack("<BQ", index[8:17])
        nulls = np.frombuffer(index, np.uint8, n, 17)
        ids = np.frombuffer(index, "<i8", n, 17 + n)
        self.ids = [None if null else i for null, i in zip(nulls.tolist(), ids.tolist(), strict=True)]
        self.lengths = np.frombuffer(index, "<u8", n, 17 + 9 * n).astype(np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)])  # in ids, from the file's start
        self.bounds = np.concatenate([[0], np.cumsum(self.frames[:, 1])]) // self.width
        self.held: tuple[int, bytes] = (-1, b"")
        self.frames_read = 0

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        return self.source.read(size)

    def frame(self, k: int) -> bytes:
        """Ids of frame ``k``, checked against its checksum; the last one is kept."""
        import xxhash
        import zstandard

        if self.held[0] != k:
            packed = self._at(int(self.starts[k]), int(self.frames[k, 0]))
            plain = zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(self.frames[k, 1]))
            if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != int(self.frames[k, 2]):
                raise ValueError(f"checksum of frame {k} does not match")
            self.held = (k, plain)
            self.frames_read += 1
        return self.held[1]

    def document(self, at: int):
        """Ids of the file's document number ``at``, as unsigned 32-bit integers."""
        import numpy as np

        begin, n = int(self.begins[at]), int(self.lengths[at])
        if not n:
            return np.empty(0, "<u4")
        k = int(np.searchsorted(self.bounds, begin, side="right")) - 1
        start = (begin - int(self.bounds[k])) * self.width
        return np.frombuffer(self.frame(k)[start : start + n * self.width], f"<u{self.width}").astype("<u4")


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    path: str | None = None,
    end_id: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    frame_ids: int = 65_536,
) -> DataFrame:
    """Write all documents; returns the manifest: file (URI), start (ids before it), n_docs, n_ids.

    Files follow ascending ids (null ids first); rows of one id follow a hash of
    their texts.  A null text is empty: it has the end id alone.  A task writes
    under a name of its attempt and renames when whole, so a retried or doubled
    task leaves one good file.  The manifest has one row per file.
    """
    spark = docs.sparkSession
    root = path or scratch_path(spark, "token-files")
    thin = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    tie = thin.withColumn("__tie", F.monotonically_increasing_id())  # rows equal in both can still be split
    ranged = tie.repartitionByRange(parts, *order, F.col("__tie")).sortWithinPartitions(*order).drop("__tie")

    def write(batches):
        import numpy as np
        from pyspark import TaskContext

        context = TaskContext.get()
        part, name = context.partitionId(), f"part-{context.partitionId():06d}.zst"
        enc = worker_state(("encoder", tokenizer), lambda: Encoder(tokenizer))
        width = 2 if max(enc.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id) < 2**16 else 4
        end = end_id.to_bytes(4, "little")
        fs, folder = _open(root)
        own = f"{folder}/_{name}.{context.taskAttemptId()}"
        writer = None
        for rows in batches:
            texts, ids = strings(rows.column("text")), rows.column("doc_id").to_pylist()
            if writer is None and texts:
                fs.create_dir(folder, recursive=True)
                writer = Writer(fs.open_output_stream(own), width, frame_ids)
            for a, b in slices(texts):
                for i, flat in zip(ids[a:b], enc.encode(texts[a:b]), strict=True):
                    writer.add(i, np.frombuffer(flat + end, "<u4").astype(f"<u{width}").tobytes())
        if writer is not None:
            writer.close()
            writer.out.close()
            if fs.get_file_info(f"{folder}/{name}").is_file:
                fs.delete_file(f"{folder}/{name}")  # of an earlier attempt, or of an older run into this folder
            fs.move(own, f"{folder}/{name}")
            yield batch(
                part=("int32", [part]),
                file=("string", [f"{root}/{name}"]),
                n_docs=("int64", [len(writer.ids)]),
                n_ids=("int64", [sum(writer.lengths)]),
            )

    files = map_batches(ranged, write, "part int, file string, n_docs long, n_ids long").collect()
    rows, total = [], 0
    for r in sorted(files, key=lambda r: r["part"]):
        rows.append((r["file"], total, r["n_docs"], r["n_ids"]))
        total += r["n_ids"]
    return spark.createDataFrame(rows, "file string, start long, n_docs long, n_ids long")


def read_token_files(spark: SparkSession, manifest: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids (array<int>), ids_crc32 of all documents, or of the ``wanted`` ids.

    One file per task; a task decompresses only frames that hold wanted documents
    and keeps one frame at a time.
    """
    chosen = None if wanted is None else frozenset(wanted)
    return _read(manifest, chosen, True)


def _read(manifest: DataFrame, chosen: frozenset | None, with_ids: bool) -> DataFrame:
    def read(batches):
        for part in batches:
            for uri, start in zip(part.column("file").to_pylist(), part.column("start").to_pylist(), strict=True):
                fs, path = _open(uri)
                with fs.open_input_file(path) as source:
                    reader, rows = Reader(source), []
                    for at, i in enumerate(reader.ids):
                        if chosen is None or i in chosen:
                            ids = reader.document(at)
                            begin = start + int(reader.begins[at])
                            rows.append((i, begin, len(ids), zlib.crc32(ids.tobytes()), ids if with_ids else None))
                        if len(rows) >= 2000:
                            yield to_batch(rows)
                            rows = []
                    if rows:
                        yield to_batch(rows)

    def to_batch(rows):
        import pyarrow as pa

        i, start, n, crc, ids = zip(*rows, strict=True)
        out = {"doc_id": ("int64", i), "start": ("int64", start), "n_tokens": ("int64", n), "ids_crc32": ("int64", crc)}
        if with_ids:
            out["ids"] = pa.array([x.astype("int32") for x in ids], pa.list_(pa.int32()))
        return batch(**out)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    files = max(1, manifest.count())
    return map_batches(manifest.repartition(files, "file"), read, schema)


def token_digests(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = 2) -> DataFrame:
    """Write the files, read them back: doc_id, start, n_tokens, ids_crc32 per document."""
    return _read(write_token_files(docs, tokenizer, path, end_id), None, False)
