"""Token ids as length-delimited binary records with masked checksums and an offset index.

A file is a run of frames::

    uint64 length of the payload | uint32 masked checksum of those 8 bytes
    payload                      | uint32 masked checksum of the payload

(little-endian; checksum: CRC-32, rotated right by 15 bits plus a constant, so that a stored
checksum of checksums does not look like data).  The payload is the key (int64), a flag
whether there is one (uint8), the width of an id in bytes (uint8: 2 if the vocabulary fits,
else 4) and the ids.  ``<file>.index`` holds, per record, the frame's offset in the file and
the number of ids before it in the file (two uint64), so records can be read in any order.

Files are written in ascending key order, one per range partition, by the tasks themselves:
to a name of the attempt, then moved to the final name, so a lost or repeated task leaves
one whole file.  ``manifest`` (Parquet) lists the files with their record and id counts.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerguard.llm.common import binary_column, pieces_by_bytes, shuffle_partitions
from ledgerguard.llm.pretokens import encoder

#: fixed value of the record format
MASK_DELTA = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_KEY = struct.Struct("<qBB")
_SUM = struct.Struct("<I")


def masked_checksum(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = len(payload).to_bytes(8, "little")
    return b"".join((size, _SUM.pack(masked_checksum(size)), payload, _SUM.pack(masked_checksum(payload))))


def read_frame(stream) -> bytes | None:
    """The next payload, None at the end; ValueError if a checksum is wrong."""
    head = stream.read(12)
    if not head:
        return None
    size, check = _HEAD.unpack(head)
    if masked_checksum(head[:8]) != check:
        raise ValueError("length checksum")
    body = stream.read(size + 4)
    if len(body) != size + 4 or masked_checksum(body[:size]) != _SUM.unpack_from(body, size)[0]:
        raise ValueError("payload checksum")
    return body[:size]


def payload_of(key: int | None, ids: np.ndarray, width: int) -> bytes:
    return _KEY.pack(key or 0, key is not None, width) + ids.astype(f"<u{width}").tobytes()


def ids_of(payload: bytes) -> tuple[int | None, np.ndarray]:
    key, known, width = _KEY.unpack_from(payload)
    return key if known else None, np.frombuffer(payload, dtype=f"<u{width}", offset=_KEY.size)


#: Spark's (Hadoop's) names of stores, and pyarrow's
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "gs": "gcs", "viewfs": "hdfs"}


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder named as Spark names it.  Object stores take their
    credentials and region from the workers' environment; ``hdfs`` needs its native client."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    scheme, rest = uri.split("://", 1)
    scheme = SCHEMES.get(scheme, scheme)
    if scheme == "s3":      # no look-up of the bucket's region, which would need the network here
        return fs.S3FileSystem(), rest
    return fs.FileSystem.from_uri(f"{scheme}://{rest}")


def write_token_records(docs: DataFrame, folder: str, vocabulary: str, key: str = "doc_id", text: str = "text",
                        end_id: int | None = 0) -> DataFrame:
    """Encode every whole text and write ``folder``; gives the manifest
    (part, file, records, ids), one row per file.

    Null text counts as empty (its record holds only the end id); rows without a key come
    first; rows with equal keys are in the order of a hash of their text, and copies of a row in
    that of the table, so that neither fills a file alone.  A very long text is one record.  An
    empty table writes no file; other columns are ignored whatever their names.
    """
    spark = docs.sparkSession
    order = [F.col("k").asc_nulls_first(), F.col("h"), F.col("row")]
    ranged = (docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"), F.xxhash64(text).alias("h"),
                          F.monotonically_increasing_id().alias("row"))
              .repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order).select("k", "t"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, path = file_system(folder)
        store.create_dir(path, recursive=True)
        coder = encoder(vocabulary)
        width = 2 if coder.vocabulary <= 1 << 16 else 4
        part = task.partitionId()
        final = f"{path}/part-{part:06d}.records"
        draft = f"{path}/.draft-{part:06d}-{uuid.uuid4().hex}"
        index: list[np.ndarray] = []
        offset = seen = 0
        out = None
        for batch in pieces_by_bytes(batches, 1):
            keys = batch.column(0).to_pylist()
            ids, counts = coder.encode(binary_column(batch, 1))
            out = out or store.open_output_stream(draft)
            cuts = np.r_[0, np.cumsum(counts)].tolist()
            tail = np.array([] if end_id is None else [end_id], dtype=np.uint32)
            places = np.empty((len(keys), 2), dtype="<u8")
            frames = []
            for i, k in enumerate(keys):
                places[i] = offset, seen
                own = np.concatenate([ids[cuts[i]:cuts[i + 1]], tail])
                frames.append(frame(payload_of(k, own, width)))
                offset += len(frames[-1])
                seen += len(own)
            out.write(b"".join(frames))
            index.append(places)
        if out is None:
            return
        out.close()
        with store.open_output_stream(f"{draft}.index") as f:
            f.write(np.concatenate(index).tobytes())
        store.move(f"{draft}.index", f"{final}.index")
        store.move(draft, final)
        records = sum(map(len, index))
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()),
                                          "file": pa.array([f"part-{part:06d}.records"]),
                                          "records": pa.array([records], pa.int64()),
                                          "ids": pa.array([seen], pa.int64())})

    ranged.mapInArrow(write, "part int, file string, records long, ids long").write.parquet(f"{folder}/manifest")
    return spark.read.schema("part int, file string, records long, ids long").parquet(f"{folder}/manifest")


def read_index(folder: str, file: str) -> np.ndarray:
    """(frame offset, ids before) of every record of a file."""
    store, path = file_system(folder)
    with store.open_input_stream(f"{path}/{file}.index") as f:
        return np.frombuffer(f.read(), dtype="<u8").reshape(-1, 2)


def read_records_at(folder: str, file: str, offsets) -> Iterator[tuple[int | None, np.ndarray]]:
    """Records of one file in the order of ``offsets`` (from its index): shuffled reads."""
    store, path = file_system(folder)
    with store.open_input_file(f"{path}/{file}") as f:
        for at in offsets:
            f.seek(int(at))
            yield ids_of(read_frame(f))


def read_token_records(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, from the files; ``start`` counts
    the ids of all records before it in key order."""
    files = spark.read.schema("part int, file string, records long, ids long").parquet(f"{folder}/manifest")
    before, rows = 0, []
    for r in sorted(files.collect()):       # one small row per file
        rows.append((r["file"], before))
        before += r["ids"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = file_system(folder)
        for batch in batches:
            for file, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                starts = read_index(folder, file)[:, 1]
                got: list[tuple] = []
                with store.open_input_stream(f"{path}/{file}", buffer_size=1 << 20) as f:
                    for start in starts.tolist():
                        key, ids = ids_of(read_frame(f))
                        got.append((key, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if f.read(1):
                        raise ValueError("the file is longer than its index")
                cols = list(zip(*got, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])

    listed = spark.createDataFrame(rows, "file string, base long")
    return (listed.repartition(max(1, len(rows)), "file")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))
