"""Landed responses: one JSON text, an array of arrays of strings, header first."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import islice

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equigauge.session import materialize, ship_package

RANGE_BYTES = 32 << 20
BATCH_ROWS = 10_000
PACKED = r"\.(gz|bz2|zst|lz4)$"
BEGINNING = "path string, start bigint, state int, depth int, row bigint"
#: where a range may begin: outside strings, inside one, or inside one after a backslash
STATES = OUTSIDE, INSIDE, ESCAPED = 0, 1, 2
OPEN, QUOTE = ord("["), ord('"')
REST_OF_STRING = re.compile(rb'(?:[^"\\]+|\\.)*+(")?', re.DOTALL)
TOKEN = re.compile(rb'[\[\]]|"(?:[^"\\]+|\\.)*+(")?', re.DOTALL)


def parse_matrix(
    docs: DataFrame, text: str, columns: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Rows of all matrices as string columns, found by their header name.

    ``row_no`` counts the rows of one matrix from 1. A column that a header
    lacks is NULL.
    """
    rows = docs.select(
        *keep, F.from_json(text, "array<array<string>>").alias("m")
    ).where(F.col("m").isNotNull())
    header = F.element_at("m", 1)
    places = [F.array_position(header, c).cast("int").alias(f"_p_{c}") for c in columns]
    cells = rows.select(*keep, *places, F.posexplode("m").alias("row_no", "r")).where("row_no > 0")
    return cells.select(
        *keep,
        "row_no",
        *[
            F.when(F.col(f"_p_{c}") > 0, F.try_element_at("r", F.col(f"_p_{c}"))).alias(c)
            for c in columns
        ],
    )


def read_json_matrix(spark: SparkSession, path: str, columns: Sequence[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Read landed files; ``person_id`` is the file name and the row in it, from 1.

    A file is cut into byte ranges, each a task's work. Whether a range begins inside a
    string, how deep and after how many rows depends on all bytes before it; so a first
    pass notes for each range what it does to every state it may begin in, these notes
    (a few numbers a range) are chained per file, and the second pass reads the rows that
    begin in its range, the last one beyond its end if need be. Compressed files cannot
    be cut and are one range.

    The text is an array of arrays, the header first. Cells that are no strings come as
    their JSON text, a cell or column that is missing as NULL; a file without a row gives
    none. A row that is not valid JSON or not closed raises, with its file and byte.
    """
    ship_package(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    last = F.when(F.col("path").rlike(PACKED), F.lit(0)).otherwise(F.greatest(F.col("length") - 1, F.lit(0)))
    ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(range_bytes).cast("bigint"))).alias("start"))
    ranges = materialize(ranges, "ranges")
    tasks = max(1, ranges.count())

    def note(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                data = read_bytes(r.path, r.start, range_bytes)
                yield pd.DataFrame({"path": [r.path], "start": [r.start], "note": [json.dumps([effect(data, s) for s in STATES])]})

    notes = ranges.repartition(tasks).mapInPandas(note, "path string, start bigint, note string")
    begun = materialize(notes.groupBy("path").applyInPandas(chain, BEGINNING), "beginnings")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                found = range_rows(r.path, r.start, range_bytes, r.state, r.depth, r.row)
                name = r.path.rsplit("/", 1)[-1]
                while part := list(islice(found, BATCH_ROWS)):
                    header = part[0][2]
                    places = [header.index(c) if c in header else None for c in columns]
                    out = {"person_id": [f"{name}#{n}" for n, _, _ in part]}
                    for c, k in zip(columns, places, strict=True):
                        out[c] = [cells[k] if k is not None and k < len(cells) else None for _, cells, _ in part]
                    yield pd.DataFrame(out, dtype=object)

    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("person_id", *columns)])
    return begun.repartition(tasks).mapInPandas(rows, schema)


def read_bytes(uri: str, start: int, size: int) -> bytes:
    """Up to ``size`` bytes of a file from ``start``; a compressed file as a whole, unpacked."""
    if uri.startswith("file:"):
        system, path = fs.LocalFileSystem(), re.sub("^file:/+", "/", uri)
    else:
        system, path = fs.FileSystem.from_uri(uri)
    if re.search(PACKED, uri):
        with system.open_input_stream(path, compression="detect") as f:
            return f.read()[start:]
    with system.open_input_file(path) as f:
        left = f.size() - start
        return f.read_at(min(size, left), start) if left > 0 else b""


def brackets(data: bytes, state: int, at: int = 0) -> Iterator[tuple[int, int]]:
    """(place, +1 or -1) of every bracket outside strings, then (-1, state at the end)."""
    if state == ESCAPED:
        if at == len(data):
            yield -1, ESCAPED
            return
        at += 1
    if state != OUTSIDE:
        rest = REST_OF_STRING.match(data, at)
        at = rest.end()
        if not rest.group(1):
            yield -1, INSIDE if at == len(data) else ESCAPED
            return
    for token in TOKEN.finditer(data, at):
        first = data[token.start()]
        if first != QUOTE:
            yield token.start(), 1 if first == OPEN else -1
        elif not token.group(1):
            yield -1, INSIDE if token.end() == len(data) else ESCAPED
            return
    yield -1, OUTSIDE


def effect(data: bytes, state: int) -> tuple[int, int, dict[int, int]]:
    """State after ``data``, change of depth, and arrays opened by depth relative to the start."""
    depth, opened = 0, Counter()
    for place, step in brackets(data, state):
        if place < 0:
            return step, depth, dict(opened)
        if step > 0:
            opened[depth] += 1
        depth += step
    raise AssertionError("brackets() ends with a state")


def chain(notes: pd.DataFrame) -> pd.DataFrame:
    """State, depth and number of rows before each range of one file."""
    state, depth, row, out = OUTSIDE, 0, 0, []
    notes = notes.sort_values("start")
    for note in notes["note"]:
        out.append((state, depth, row))
        state, change, opened = json.loads(note)[state]
        row += opened.get(str(1 - depth), 0)
        depth += change
    return pd.DataFrame({"path": notes["path"].to_numpy(), "start": notes["start"].to_numpy()}).assign(
        **{c: [o[i] for o in out] for i, c in enumerate(("state", "depth", "row"))}
    )


def range_rows(uri: str, start: int, size: int, state: int, depth: int, row: int) -> Iterator[tuple[int, list, list]]:
    """(number, cells, header) of the rows that begin in a range; the header itself, number 0, is left out."""
    data, header, opened = read_bytes(uri, start, size), None, -1
    for place, step in brackets(data, state):
        if place >= 0 and step > 0 and depth == 1:
            opened = place
        closes = place >= 0 and step < 0 and depth == 2 and opened >= 0
        if closes or (place < 0 and opened >= 0):
            text = data[opened : place + 1] if closes else whole_row(uri, start + opened, size)
            if row:
                header = header or row_cells(*first_row(uri, size), uri)
                yield row, row_cells(text, start + opened, uri), header
            row, opened = row + 1, -1
        if place >= 0:
            depth += step


def whole_row(uri: str, at: int, size: int) -> bytes:
    """The row that begins at byte ``at``, however long."""
    while True:
        data, depth = read_bytes(uri, at, size), 0
        for place, step in brackets(data, OUTSIDE):
            depth += step if place >= 0 else 0
            if place >= 0 and not depth:
                return data[: place + 1]
        if len(data) < size or re.search(PACKED, uri):
            raise ValueError(f"{uri}: the row at byte {at} is not closed")
        size *= 2


def first_row(uri: str, size: int) -> tuple[bytes, int]:
    """The header's text and where it stands."""
    while True:
        data, depth = read_bytes(uri, 0, size), 0
        for place, step in brackets(data, OUTSIDE):
            if place >= 0 and step > 0 and depth == 1:
                return whole_row(uri, place, size), place
            depth += step if place >= 0 else 0
        size *= 2


def row_cells(text: bytes, at: int, uri: str) -> list[str | None]:
    """The cells of one row as strings."""
    try:
        cells = json.loads(text, strict=False, parse_int=str, parse_float=str, parse_constant=str)
    except ValueError as e:
        raise ValueError(f"{uri}: the row at byte {at} is no JSON: {e}") from e
    for i, v in enumerate(cells):
        if isinstance(v, bool):
            cells[i] = "true" if v else "false"
        elif isinstance(v, list | dict):
            cells[i] = json.dumps(json.loads(text, strict=False)[i], ensure_ascii=False, separators=(",", ":"))
    return cells


def scope(df: DataFrame, state: str, column: str = "state") -> DataFrame:
    """Rows of one state, or all of them for ``*``."""
    return df if state == "*" else df.where(F.col(column) == F.lit(state))
