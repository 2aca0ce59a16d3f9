"""Token ids in binary files of patched frame-of-reference blocks, and reading them back.

File: the ids of consecutive documents, cut into blocks of ``BLOCK`` ids (the last
may be shorter). A block stores its minimum, then every id less that minimum in
as many bits as a chosen percentile of them needs; ids that need more are
exceptions, listed with place and value after the packed bits.

    header   magic "EQTF", version, percentile width parameters   (16 bytes)
    blocks   <u4 minimum, u1 width, u1 0, <u2 exceptions, <u4 ids>, bits, <u2 places, <u4 values
    index    <u8 start of every block
    docs     <i8 doc_id, u1 doc_id is null, <u4 ids, of every document
    footer   <u8 start of the index, <u8 blocks, <u8 documents, <u8 ids, magic

Ids must be below 2**32. Defined results: a null text is empty, so its only
token is the end id; null doc_ids come first; rows with the same doc_id lie next
to each other, in an order that their texts fix; an empty table gives no rows.

The number of partitions follows the bytes of the texts. Files of one partition
of the range-partitioned table hold a range of documents.
A file is written under a name of the attempt and then renamed, and its content
is determined by its rows, so a repeated task writes the same file again.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from equigauge.llm.common import arrow_schema, slices, text_bytes
from equigauge.llm.tokens import encoder
from equigauge.session import materialize, new_path

MAGIC = b"EQTF"
BLOCK = 4096
PERCENTILE = 90
FILE_IDS = 2_000_000
FILE_DOCS = 500_000
PARTITION_BYTES = 1 << 28
MANIFEST = "file string, part int, seq int, n_docs bigint, n_ids bigint, n_bytes bigint"
TOKENS = "doc_id bigint, ids binary, n_tokens bigint"
DECODED = "file string, place int, doc_id bigint, start_in_file bigint, n_tokens bigint, ids_crc32 bigint, ids binary"


def bit_width(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs; 0 needs none."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bits of each value, the lowest bit first, without gaps."""
    n, size = len(values), (len(values) * width + 7) // 8
    if width > 16:
        bits = (values[:, None] >> np.arange(width, dtype=np.uint32)) & 1
        return np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little").tobytes()
    eights = np.zeros((-(-n // 8), 8), np.uint64)
    eights.reshape(-1)[:n] = values & np.uint32((1 << width) - 1)
    fours = np.zeros((len(eights), 2), np.uint64)
    for k in range(4):
        fours[:, 0] |= eights[:, k] << np.uint64(k * width)
        fours[:, 1] |= eights[:, 4 + k] << np.uint64(k * width)
    if 0 < width < 16:  # the second four follows the first without a gap
        high = fours[:, 1] >> np.uint64(64 - 4 * width)
        fours[:, 0] |= fours[:, 1] << np.uint64(4 * width)
        fours[:, 1] = high
    return fours.astype("<u8").view(np.uint8).reshape(-1, 16)[:, :width].tobytes()[:size]


def unpack_bits(raw: memoryview, width: int, n: int) -> np.ndarray:
    if width > 16:
        bits = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * width, bitorder="little").reshape(n, width)
        planes = bits.astype(np.uint32) << np.arange(width, dtype=np.uint32)
        return planes.sum(axis=1, dtype=np.uint32)
    rows = -(-n // 8)
    padded = np.zeros(rows * width, np.uint8)
    padded[: len(raw)] = np.frombuffer(raw, np.uint8)
    words = np.zeros((rows, 16), np.uint8)
    words[:, :width] = padded.reshape(rows, width)
    fours = words.view("<u8").astype(np.uint64)
    if 0 < width < 16:
        fours[:, 1] = (fours[:, 1] << np.uint64(64 - 4 * width)) | (fours[:, 0] >> np.uint64(4 * width))
    out = np.empty((rows, 8), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for k in range(4):
        out[:, k] = (fours[:, 0] >> np.uint64(k * width)) & mask
        out[:, 4 + k] = (fours[:, 1] >> np.uint64(k * width)) & mask
    return out.reshape(-1)[:n]


def encode_block(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    low = ids.min()
    rest = ids - low
    rank = max(0, -(-len(rest) * percentile // 100) - 1)
    width = int(bit_width(np.partition(rest, rank)[rank : rank + 1])[0])
    over = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    return b"".join(
        (
            struct.pack("<IBBHI", low, width, 0, len(over), len(ids)),
            pack_bits(rest, width),
            over.astype("<u2").tobytes(),
            rest[over].astype("<u4").tobytes(),
        )
    )


def decode_block(raw: memoryview, at: int) -> np.ndarray:
    low, width, _, exceptions, n = struct.unpack_from("<IBBHI", raw, at)
    at += 12
    size = (n * width + 7) // 8
    rest = unpack_bits(raw[at : at + size], width, n)
    at += size
    places = np.frombuffer(raw, "<u2", exceptions, at)
    rest[places] = np.frombuffer(raw, "<u4", exceptions, at + 2 * exceptions)
    return rest + np.uint32(low)


def encode_file(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> bytes:
    """The bytes of one file."""
    parts = [MAGIC + struct.pack("<IIHH", 1, block, percentile, 0)]
    at, starts = len(parts[0]), []
    for a in range(0, len(ids), block):
        parts.append(encode_block(ids[a : a + block], percentile))
        starts.append(at)
        at += len(parts[-1])
    parts += [
        np.asarray(starts, "<u8").tobytes(),
        np.asarray([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.asarray([d is None for d in doc_ids], "u1").tobytes(),
        lengths.astype("<u4").tobytes(),
        struct.pack("<QQQQ", at, len(starts), len(doc_ids), len(ids)) + MAGIC,
    ]
    return b"".join(parts)


class TokenFile:
    """Reads one file; any block is found through the index."""

    def __init__(self, raw: bytes):
        self.raw = memoryview(raw)
        if raw[:4] != MAGIC or raw[-4:] != MAGIC:
            raise ValueError("this is no token file, or a part of one")
        self.block = struct.unpack_from("<I", raw, 8)[0]
        at, blocks, docs, self.n_ids = struct.unpack_from("<QQQQ", raw, len(raw) - 36)
        self.starts = np.frombuffer(raw, "<u8", blocks, at)
        at += 8 * blocks
        doc_ids = np.frombuffer(raw, "<i8", docs, at)
        nulls = np.frombuffer(raw, "u1", docs, at + 8 * docs).astype(bool)
        self.doc_ids = pa.array(doc_ids, pa.int64(), mask=nulls)
        self.lengths = np.frombuffer(raw, "<u4", docs, at + 9 * docs).astype(np.int64)

    def ids(self, a: int = 0, b: int | None = None) -> np.ndarray:
        """Ids from a up to b, decoding only the blocks they lie in."""
        b = self.n_ids if b is None else b
        if a >= b:
            return np.empty(0, "<u4")
        first = a // self.block
        found = [decode_block(self.raw, int(s)) for s in self.starts[first : (b - 1) // self.block + 1]]
        return np.concatenate(found)[a - first * self.block : b - first * self.block]


def in_order(docs: DataFrame, partitions: int) -> DataFrame:
    """Whole texts in ascending doc_id order, partition after partition.

    The hash spreads rows that share a doc_id over partitions.
    """
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text"))
    keyed = keyed.withColumn("tie", F.xxhash64("text"))
    return (
        keyed.repartitionByRange(partitions, F.col("doc_id").asc_nulls_first(), "tie")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "text")
        .select("doc_id", "text")
    )


def tokenize(ordered: DataFrame, tokenizer: str, end_id: int = 1, spaced: bool = False) -> DataFrame:
    """Ids of every document with the end id, in the order of the rows. Columns: TOKENS."""
    end = np.asarray([end_id], dtype="<u4").tobytes()
    schema = arrow_schema(TOKENS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                part = batch.slice(at, 250)
                texts = [t.decode("utf-8", "replace") for t in part["text"].to_pylist()]
                ids = [i + end for i in encoder(tokenizer, spaced).encode(texts)]
                columns = [part["doc_id"], pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return ordered.mapInArrow(run, TOKENS)


def write_files(tokens: DataFrame, folder: str, file_ids: int = FILE_IDS, file_docs: int = FILE_DOCS) -> DataFrame:
    """Write the documents in the order of the rows; returns the manifest, one row per file.

    ``folder`` must be reachable from every executor; writing goes through
    pyarrow's file systems (file, hdfs, s3, gs). A document with more than
    ``file_ids`` ids gets a file of its own size.
    """
    schema = arrow_schema(MANIFEST)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        doc_ids: list[int | None] = []
        held: list[bytes] = []
        total = seq = 0

        def flush() -> pa.RecordBatch:
            nonlocal doc_ids, held, total, seq
            ids = np.frombuffer(b"".join(held), "<u4")
            raw = encode_file(doc_ids, np.asarray([len(h) // 4 for h in held]), ids)
            name = f"part-{part:06d}-{seq:06d}.tok"
            with system.open_output_stream(f"{base}/.{name}-{attempt}") as out:
                out.write(raw)
            system.move(f"{base}/.{name}-{attempt}", f"{base}/{name}")
            row = [[name], [part], [seq], [len(doc_ids)], [len(ids)], [len(raw)]]
            doc_ids, held, total, seq = [], [], 0, seq + 1
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        system.create_dir(base, recursive=True)
        for batch in batches:
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if doc_ids and (total + len(ids) // 4 > file_ids or len(doc_ids) >= file_docs):
                    yield flush()
                doc_ids.append(doc_id)
                held.append(ids)
                total += len(ids) // 4
        if doc_ids:
            yield flush()

    return materialize(tokens.mapInArrow(write, MANIFEST), "token-manifest")


def read_files(spark: SparkSession, folder: str, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Documents of the files of the manifest, in DECODED columns plus start.

    ``start`` counts the ids of all documents before. Files without a manifest
    row, left by a lost attempt, are not read.
    """
    schema = arrow_schema(DECODED)
    # one row per file, summed in two steps: within a partition, then over partitions
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("part_start"))
    placed = (
        manifest.withColumn("file_start", F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
        .join(parts, "part")
        .select("file", (F.col("file_start") + F.col("part_start")).alias("file_start"))
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(batch["file"].to_pylist(), batch["content"], strict=True):
                found = TokenFile(raw.as_py())
                cuts = np.concatenate([[0], np.cumsum(found.lengths)])
                for at in range(0, len(found.lengths), 2000):
                    to = min(at + 2000, len(found.lengths))
                    ids = found.ids(int(cuts[at]), int(cuts[to])).astype("<u4").tobytes()
                    here = ((cuts[at : to + 1] - cuts[at]) * 4).tolist()
                    own = [ids[a:b] for a, b in zip(here[:-1], here[1:], strict=True)]
                    columns = [
                        pa.array([name] * (to - at)),
                        pa.array(range(at, to), pa.int32()),
                        found.doc_ids.slice(at, to - at),
                        pa.array(cuts[at:to], pa.int64()),
                        pa.array(found.lengths[at:to], pa.int64()),
                        pa.array([zlib.crc32(i) for i in own], pa.int64()),
                        pa.array(own if with_ids else [None] * len(own), pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.tok").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return files.mapInArrow(decode, DECODED).join(placed, "file").withColumn("start", F.col("file_start") + F.col("start_in_file"))


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Digest of the files: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    folder = new_path(spark, "token-files")
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // PARTITION_BYTES))
    manifest = write_files(tokenize(in_order(docs, partitions), tokenizer, end_id), folder)
    if not manifest.head(1):
        return spark.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return read_files(spark, folder, manifest).select("doc_id", "start", "n_tokens", "ids_crc32")
