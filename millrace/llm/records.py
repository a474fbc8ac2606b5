"""Token ids as length-delimited binary records, with an offset index beside them.

A record is an 8-byte length, the masked checksum of these 8 bytes, the payload, and the masked
checksum of the payload; all numbers are little-endian. Checksums are CRC-32, rotated right by
15 bits and raised by a constant, so that data holding checksums does not check out by itself.
The payload is one byte, the 8-byte id, and the tokens. The byte is the sum of 1 if the document
has an id and 2 if the tokens take 2 bytes each, as they do where all are below 65536, else 4.

A task writes one file for its range of ids, under a name of its own attempt, and returns where
each record lies. These rows become the index; files of attempts that failed are in no index.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_folder
from .tokens import kept_encoder, vocabulary

# The layouts of a record's head, of what precedes the ids, and of a checksum.
HEAD, PAYLOAD, CHECK = "<QI", "<Bq", "<I"
HEAD_SIZE, PAYLOAD_SIZE, CHECK_SIZE = 12, 9, 4
# Fixed value: what is added to a rotated checksum.
MASK = 0xA282EAD8
BYTES_PER_BATCH = 16_000_000
BYTES_PER_WRITE = 4_000_000
INDEX = "part int, file string, doc_id bigint, at bigint, size bigint, n_tokens bigint"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + struct.pack(CHECK, masked_crc(length)) + payload + struct.pack(CHECK, masked_crc(payload))


def unframed(stream) -> bytes | None:
    """The next payload, None at the end; raises on bytes that don't check out."""
    head = stream.read(HEAD_SIZE)
    if not head:
        return None
    if len(head) < HEAD_SIZE or struct.unpack(HEAD, head)[1] != masked_crc(head[:8]):
        raise ValueError("a record's length does not match its checksum")
    payload = stream.read(struct.unpack(HEAD, head)[0])
    check = stream.read(CHECK_SIZE)
    if len(check) < CHECK_SIZE or struct.unpack(CHECK, check)[0] != masked_crc(payload):
        raise ValueError("a record does not match its checksum")
    return payload


def serialized(doc_id: int | None, ids: bytes, width: int = 4) -> bytes:
    """A payload; ``ids`` has ``width`` bytes, 2 or 4, for each token."""
    if width == 4:
        numbers = np.frombuffer(ids, "<u4")
        if not len(numbers) or int(numbers.max()) < 1 << 16:
            ids, width = numbers.astype("<u2").tobytes(), 2
    kind = (doc_id is not None) + 2 * (width == 2)
    return struct.pack(PAYLOAD, kind, doc_id or 0) + ids


def parsed(payload: bytes) -> tuple[int | None, bytes]:
    """The document's id, and its tokens with 4 bytes each."""
    kind, doc_id = struct.unpack_from(PAYLOAD, payload)
    ids = payload[PAYLOAD_SIZE:]
    if kind & 2:
        ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
    return (doc_id if kind & 1 else None), ids


def file_system(folder: str):
    """The file system of a folder and the folder's path in it; a task may be on any machine."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write(
    documents: DataFrame,
    folder: str,
    end_id: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
) -> None:
    """Encode every whole text, null as empty, and write the records in ascending order of ``doc_id``.

    Null ids come first. Repeated ids stay repeated records; a hash of the text spreads them, so
    that one id may hold any share of the rows. An empty table gives an index without rows. The
    index and one row per file, with the tokens before it, lie in ``index`` and ``files``.
    """
    spark = documents.sparkSession
    kept = kept_encoder(spark, tokenizer or vocabulary(), narrow=end_id < 1 << 16)
    fields = ("part", "file", "doc_id", "at", "size", "n_tokens")
    kinds = pa.schema(list(zip(fields, (pa.int32(), pa.string(), *[pa.int64()] * 4))))

    def encode(batches):
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.rec"
        encoder, at, stream = kept(), 0, None
        width, end = encoder.width, int(end_id).to_bytes(encoder.width, "little")
        for batch in batches:
            if stream is None:
                stream = system.open_output_stream(f"{base}/{name}")
            rows, waiting, size = [], [], 0
            for number, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = encoder.of(text.as_py()) + end
                record = framed(serialized(number, ids, width))
                rows.append((part, name, number, at, len(record), len(ids) // width))
                at += len(record)
                waiting.append(record)
                size += len(record)
                if size >= BYTES_PER_WRITE:
                    stream.write(b"".join(waiting))
                    waiting, size = [], 0
            stream.write(b"".join(waiting))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.types)], schema=kinds)
        if stream is not None:
            stream.close()

    chosen = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    order = ["doc_id", "_spread"]
    ranged = chosen.withColumn("_spread", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.select("doc_id", "text").mapInArrow(encode, INDEX).write.parquet(f"{folder}/index")
    files = (
        spark.read.schema(INDEX).parquet(f"{folder}/index").groupBy("part", "file")
        .agg(F.count("*").alias("n_records"), F.sum("n_tokens").alias("n_tokens"), F.sum("size").alias("size"))
    )
    # one row for each file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(f"{folder}/files")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of all records, straight through every file.

    ``start`` counts the tokens of all records before. Every checksum is tested.
    """
    files = spark.read.parquet(f"{folder}/files").select("file", "start")

    def decode(batches) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        names = ["doc_id", "start", "n_tokens", "ids"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                rows, size = [], 0
                with system.open_input_stream(f"{base}/{name}", buffer_size=1 << 20) as stream:
                    while (payload := unframed(stream)) is not None:
                        number, ids = parsed(payload)
                        rows.append((number, start, len(ids) // 4, ids))
                        start += len(ids) // 4
                        size += len(ids)
                        if size >= BYTES_PER_BATCH:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    spread = files.repartition(max(1, files.count()), "file")
    return spread.mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def fetch(wanted: DataFrame, folder: str) -> DataFrame:
    """The records at any rows of the index (``file, at, size``), in any order: shuffled reads.

    Returns doc_id and ids. Rows are brought together by file; one that holds most of them is
    spread by place.
    """

    def pick(batches) -> Iterator[pd.DataFrame]:
        system, base = file_system(folder)
        for batch in batches:
            rows = []
            for name, own in batch.groupby("file"):
                with system.open_input_file(f"{base}/{name}") as source:
                    for at in own["at"]:
                        source.seek(int(at))
                        rows.append(parsed(unframed(source)))
            yield pd.DataFrame(rows, columns=["doc_id", "ids"]).astype({"doc_id": "Int64"})

    spread = wanted.select("file", "at", "size").repartition("file", (F.col("at") / (64 << 20)).cast("int"))
    return spread.mapInPandas(pick, "doc_id bigint, ids binary")


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/records-{uuid.uuid4().hex}"
