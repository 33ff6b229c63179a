"""Token ids in binary record files with an offset index (operator 9).

A data file is a sequence of records; a record is one document::

    length   8 bytes  of the payload, little-endian, unsigned
    check    4 bytes  masked CRC-32 of the length field
    payload           1 byte: 1 if the document has an id; 8 bytes: the id (signed); then the token ids
    check    4 bytes  masked CRC-32 of the payload

Token ids take ``width`` bytes (2 where the vocabulary allows it, else 4), little-endian and unsigned. Beside each data
file, ``<file>.index`` holds the byte offset of each record as 8 bytes, so that records can be read in any order.
"""

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelforge.llm.frames import partitions_for, whole_text
from reelforge.llm.tokens import END_ID, VOCABULARY, tokenizer, with_end
from reelforge.operators.durable import settle, staging_path

LENGTH, CHECK, HEAD = "<Q", "<I", "<Bq"
HEAD_BYTES = struct.calcsize(HEAD)
WRITE_BUFFER = 8 << 20


def masked_crc(data: bytes) -> int:
    """CRC-32 rotated and shifted, so that a checksum of data that holds checksums stays useful."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack(LENGTH, len(payload))
    return b"".join((length, struct.pack(CHECK, masked_crc(length)), payload, struct.pack(CHECK, masked_crc(payload))))


def open_store(path: str):
    """File system and path for a URI or a plain path of the shared folder."""
    return fs.FileSystem.from_uri(path)


def _unframed(read, place: str) -> bytes | None:
    length = read(8)
    if not length:
        return None
    check, = struct.unpack(CHECK, read(4))
    if check != masked_crc(length):
        raise ValueError(f"damaged length in {place}")
    payload = read(struct.unpack(LENGTH, length)[0])
    if struct.unpack(CHECK, read(4))[0] != masked_crc(payload):
        raise ValueError(f"damaged record in {place}")
    return payload


def _parsed(payload: bytes, width: int) -> tuple[int | None, np.ndarray]:
    known, doc_id = struct.unpack_from(HEAD, payload)
    return (doc_id if known else None), np.frombuffer(payload, f"<u{width}", offset=HEAD_BYTES)


def read_records(path: str, width: int):
    """All records of a data file, one at a time: document id and token ids. A damaged file is an error."""
    store, name = open_store(path)
    with store.open_input_stream(name, buffer_size=WRITE_BUFFER) as stream:
        while (payload := _unframed(stream.read, path)) is not None:
            yield _parsed(payload, width)


def read_record(path: str, number: int, width: int) -> tuple[int | None, np.ndarray]:
    """One record, found through the offset index."""
    store, name = open_store(path)
    with store.open_input_file(name + ".index") as index:
        index.seek(8 * number)
        offset, = struct.unpack(LENGTH, index.read(8))
    with store.open_input_file(name) as data:
        data.seek(offset)
        return _parsed(_unframed(data.read, path), width)


def write_token_files(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID,
                      width: int = 2, partitions: int | None = None) -> DataFrame:
    """Tokenize whole texts and write them in ascending order of ``doc_id``; returns one row per file.

    Rows: ``file_no`` (files in this order hold the documents in order), ``file``, ``records``, ``tokens``. The files are
    complete when this returns. A task that is run again writes under another name, and only the files of the
    attempts that counted are listed. Null text is the empty text (its record holds the end id alone); documents with
    null ``doc_id`` come first; documents with equal ids are ordered by a hash of their text. An empty
    table gives no rows. Other columns are not read.
    """
    ordered = docs.select("doc_id", whole_text().alias("text")).withColumn("_tie", F.xxhash64("text"))
    ordered = (
        ordered.repartitionByRange(partitions or partitions_for(docs), F.col("doc_id").asc_nulls_first(), F.col("_tie"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_tie").select("doc_id", "text")
    )

    def write(batches):
        task = TaskContext.get()
        store, base = open_store(folder)
        file, index, waiting, size, records, tokens = None, None, [], 0, 0, 0
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.tokens"
        at = 0
        for batch in batches:
            if file is None:
                store.create_dir(base, recursive=True)
                file = store.open_output_stream(f"{base}/{name}")
                index = store.open_output_stream(f"{base}/{name}.index")
            ids, limits = with_end(*tokenizer(vocabulary).encode(batch.column("text")), end_id)
            if width == 2 and len(ids) and ids.max() > 0xFFFF:
                raise ValueError("the vocabulary needs width=4")
            ids = ids.astype(f"<u{width}")
            offsets = []
            for row, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                head = struct.pack(HEAD, doc_id is not None, doc_id or 0)
                record = frame(head + ids[limits[row] : limits[row + 1]].tobytes())
                offsets.append(at)
                at += len(record)
                waiting.append(record)
                size += len(record)
                if size >= WRITE_BUFFER:
                    file.write(b"".join(waiting))
                    waiting, size = [], 0
            index.write(np.array(offsets, "<u8").tobytes())
            records += len(offsets)
            tokens += len(ids)
        if file is not None:
            file.write(b"".join(waiting))
            file.close()
            index.close()
            yield pa.RecordBatch.from_pydict({
                "file_no": pa.array([task.partitionId()], pa.int32()), "file": [f"{folder}/{name}"],
                "records": pa.array([records], pa.int64()), "tokens": pa.array([tokens], pa.int64()),
            })

    return settle(ordered.mapInArrow(write, "file_no int, file string, records long, tokens long"), "token-index")


def read_token_files(files: DataFrame, width: int = 2) -> DataFrame:
    """One row per record, read from the files: ``doc_id``, ``start`` (ids before it in all files), ``n_tokens``, ``ids_crc32``.

    The starts of files come from their token counts: one small row per file.
    """
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0))).select("file", "start")

    def read(batches):
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                rows = []
                for doc_id, ids in read_records(file, width):
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                    if len(rows) == 10_000:
                        yield _batch(rows)
                        rows = []
                yield _batch(rows)

    def _batch(rows):
        columns = list(zip(*rows)) or [[]] * 4
        names = ("doc_id", "start", "n_tokens", "ids_crc32")
        return pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    return placed.repartition(max(1, files.count())).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_token_files(spark, sf_dir: str) -> DataFrame:
    """Every document's ids, written in the file format and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_token_files(write_token_files(docs, staging_path(spark, "tokens")))
