"""Best-fit packing of documents into sequences, by hierarchical residual packing.

Partitions place their pieces best-fit on their own. Bins that come out nearly
full are done. The underfull ones go up a tree as items: partitions merge and
place those bins best-fit among each other, round after round, until one
partition is left or a round no longer helps.

Defined results: a null text is empty, so its only token is the end id. A null
doc_id is kept as it is. Rows with the same doc_id are packed each on its own.
An empty table gives no sequences.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.llm.common import arrow_schema, slices, text_bytes, unused
from equigauge.llm.tokens import encoder
from equigauge.session import materialize

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"
PARTITION_PIECES = 50_000
NEARLY_FULL = 0.98


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, spaced: bool = True) -> DataFrame:
    """Tokens of every document with the end id, cut into pieces of at most ``capacity``.

    Only longer documents are cut; then the first piece is the shorter one.
    ``ids`` holds little-endian unsigned 32-bit ids. Columns: PIECES.
    """
    end = np.asarray([end_id], dtype="<u4").tobytes()
    out_schema = arrow_schema(PIECES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True))
            for part in slices(rows, 250):
                found = encoder(tokenizer, spaced).encode([t.decode("utf-8", "replace") for _, t in part])
                columns: list[list] = [[], [], [], [], []]
                for (doc_id, _), ids in zip(part, found, strict=True):
                    ids += end
                    n = len(ids) // 4
                    k = -(-n // capacity)
                    starts = [0, *range(n - (k - 1) * capacity, n, capacity)]
                    for piece, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                        for column, value in zip(columns, (doc_id, piece, a, b - a, ids[4 * a : 4 * b]), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, out_schema, strict=True)], schema=out_schema
                )

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text"))
    return source.mapInArrow(cut, PIECES)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each item, and the fill of each bin.

    ``sizes`` must be in decreasing order. Open bins stand in stacks by the room
    they have left; a bit mask over the stacks finds the tightest that fits.
    """
    bins, offsets, fills = [], [], []
    stacks: dict[int, list[int]] = {}
    mask = 0
    for size in sizes.tolist():
        fitting = mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            stack = stacks[room]
            b = stack.pop()
            if not stack:
                mask ^= 1 << room
        else:
            b, room = len(fills), capacity
            fills.append(0)
        bins.append(b)
        offsets.append(capacity - room)
        room -= size
        fills[b] = capacity - room
        if room:
            stacks.setdefault(room, []).append(b)
            mask |= 1 << room
    return np.asarray(bins, np.int64), np.asarray(offsets, np.int64), np.asarray(fills, np.int64)


def place(items: DataFrame, groups: int, level: int, capacity: int) -> DataFrame:
    """One round: the bins of every group are placed best-fit among each other.

    ``items``: rows of pieces with pack_group, bin_id (their bin so far), fill and offset.
    """
    schema = items.schema
    names = schema.names

    def merge(rows: pa.Table) -> pa.Table:
        rows = rows.select(names)
        doc_id = rows["doc_id"].combine_chunks()
        keys = [
            rows["offset"].to_numpy(),
            rows["bin_id"].to_numpy(),
            rows["fill"].to_numpy(),
        ]
        order = np.lexsort((keys[0], keys[1], -keys[2]))
        offset, bin_id, fill = (k[order] for k in keys)
        first = np.flatnonzero(np.diff(bin_id, prepend=bin_id[0] - 1) != 0)
        item = np.cumsum(np.isin(np.arange(len(bin_id)), first)) - 1
        placed, at, fills = best_fit(fill[first], capacity)
        group = rows["pack_group"][0].as_py()
        new_bin = (level << 56) + (group << 32) + placed[item]
        out = {
            "doc_id": doc_id.take(pa.array(order)),
            "bin_id": pa.array(new_bin, pa.int64()),
            "fill": pa.array(fills[placed[item]], pa.int64()),
            "offset": pa.array(offset + at[item], pa.int64()),
        }
        taken = rows.combine_chunks().take(pa.array(order))
        return pa.table([out.get(n, taken[n]) for n in names], names=names)

    return items.groupBy("pack_group").applyInArrow(merge, schema)


def pack(found: DataFrame, capacity: int = 1024, partition_pieces: int = PARTITION_PIECES, nearly_full: float = NEARLY_FULL) -> DataFrame:
    """Sequence and offset of every piece; adds sequence_id and offset.

    ``found`` needs doc_id and length (1 to ``capacity``) and may carry more
    columns, which stay; it should be a written table, as it is read twice. Full
    pieces are sequences of their own. A group holds about ``partition_pieces``
    pieces, whatever the number of rows. Columns of the table that are named
    sequence_id or offset come back as own_sequence_id and own_offset; bin_id, fill
    and pack_group are names it works with and may not be the table's.
    """
    for name in ("bin_id", "fill", "pack_group"):
        if unused(found, name) != name:
            raise ValueError(f"the table has a column {name} already")
    found = found.withColumnsRenamed({c: unused(found, f"own_{c}") for c in found.columns if c.lower() in ("sequence_id", "offset")})
    columns = found.columns
    numbered = found.withColumn("bin_id", -1 - F.monotonically_increasing_id())
    whole = F.col("length") >= capacity
    done = [numbered.where(whole).select(*columns, F.col("bin_id").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))]
    n = found.where(~whole).count()
    groups = max(1, math.ceil(n / partition_pieces))
    rest = numbered.where(~whole).select(
        *columns,
        "bin_id",
        F.col("length").alias("fill"),
        F.lit(0).cast("bigint").alias("offset"),
        F.pmod(F.xxhash64("bin_id"), F.lit(groups)).cast("bigint").alias("pack_group"),
    )
    level = 0
    while n:
        level += 1
        rest = materialize(place(rest, groups, level, capacity), "packed")
        full = F.col("fill") >= nearly_full * capacity
        left = rest.where(~full).count()
        merged = max(1, math.ceil(left / partition_pieces))
        if groups == 1 or merged >= groups or not left:
            done.append(rest.select(*columns, F.col("bin_id").alias("sequence_id"), "offset"))
            break
        done.append(rest.where(full).select(*columns, F.col("bin_id").alias("sequence_id"), "offset"))
        # neighbours in the tree merge
        parent = F.floor(F.col("pack_group") * merged / groups).cast("bigint")
        rest = rest.where(~full).withColumn("pack_group", parent)
        n, groups = left, merged
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ids in order, and where each piece lies.

    A sequence holds at most as many pieces as tokens, so its row is bounded.
    ``packed`` needs the ids column.
    """
    part = F.struct("offset", "doc_id", "piece", "length", "ids")
    return (
        packed.groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(part)).alias("parts"))
        .select(
            "sequence_id",
            F.aggregate("parts", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"])).alias("ids"),
            F.transform("parts", lambda p: p.dropFields("ids")).alias("parts"),
        )
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Digest of the packing: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    found = materialize(
        pieces(docs, tokenizer, capacity, end_id).select(
            "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
        ),
        "pieces",
    )
    return pack(found, capacity)
