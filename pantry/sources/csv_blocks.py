"""CSV files cut into blocks anywhere, also inside quoted fields that span lines.

Whether a block of a file begins inside a quoted field depends on all that is before
it.  A first pass tells, for each block, in which state it ends if it begins outside
and if it begins inside; following these pairs through a file gives every block's
true state.  A second pass then reads each block on its own task and hands on whole
records; of a record that crosses blocks only the pieces meet.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .io import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have the package on their path

#: From inside a quoted field: up to its closing quote and the end of the field.
_CLOSE = re.compile(r'(?:[^"]|"")*+"[^,]*+(,|\Z)', re.DOTALL)
#: From the start of a field: whole fields, quoted or not (a quote later in a field is a plain character).
_FIELDS = re.compile(r'(?:"(?:[^"]|"")*+"[^,]*+,|[^",][^,]*+,|,)*+', re.DOTALL)
#: A field that nothing closes.
_OPEN = re.compile(r'"(?:[^"]|"")*+', re.DOTALL)


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open after ``line``."""
    at = 0
    if inside:
        match = _CLOSE.match(line)
        if not match:
            return True
        if not match[1]:
            return False
        at = match.end()
    elif '"' not in line:
        return False
    at = _FIELDS.match(line, at).end()
    return _OPEN.fullmatch(line, at) is not None


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    meta = lines.metadataColumn("_metadata")
    return lines.select(F.xxhash64(meta["file_path"]).alias("file"), meta["file_block_start"].alias("block"), "value")


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[str]]]:
    """(file, block, lines) in the file's order; a block may come in several stretches."""
    for batch in batches:
        file, block = (batch.column(c).to_numpy() for c in (0, 1))
        edges = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
        for at, to in zip([0, *edges], [*edges, len(file)], strict=True):
            if to > at:
                yield int(file[at]), int(block[at]), batch.column(2).slice(at, to - at).to_pylist()


def _blank(lines: list[str]) -> bool:
    return not "".join(lines).strip("\r\ufeff")


_ENDS = ("file long, block long, from_outside boolean, from_inside boolean, header string, lead string, closes boolean, "
         "tail_outside string, tail_inside string")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block: the state at its end for either state at its start, the piece
    up to the first end of a record if it begins inside (``lead``), the piece that is
    open at its end either way, and the header record of a file's first block."""
    def row():
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((
            *key, *state, "\n".join(header) if key[1] == 0 else None, lead if lead is not None else "\n".join(held[1]), lead is not None,
            *("\n".join(h) if s else None for h, s in zip(held, state, strict=True))),
            (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.string(), pa.bool_(), pa.string(), pa.string()), strict=True)],
            names=[c.split()[0] for c in _ENDS.split(", ")])

    key, state, held, lead, header = None, [False, True], [[], []], None, []
    for file, block, lines in _by_block(batches):
        if key != (file, block):
            if key:
                yield row()
            key, state, held, lead, header = (file, block), [False, True], [[], []], None, []
        for line in lines:
            for i in (0, 1):
                held[i].append(line)
                state[i] = ends_inside(line, state[i])
                if not state[i]:
                    if i == 1 and lead is None:
                        lead = "\n".join(held[1])
                    if i == 0 and block == 0 and not header and not _blank(held[0]):
                        header = held[0]
                    held[i] = []
    if key:
        yield row()


def _follow(blocks: pd.DataFrame) -> pd.DataFrame:
    """Of one file: the blocks that begin inside a quoted field (text null), and the
    records that cross blocks (with the block where they begin)."""
    inside, found, open_text, begun = False, [], [], 0
    for r in blocks.sort_values("block").itertuples():
        if inside:
            found.append((r.file, r.block, None))
            open_text.append(r.lead)
            if r.closes:
                found.append((r.file, begun, "\n".join(open_text)))
                open_text = []
        else:
            open_text = []
        begins_inside, inside = inside, r.from_inside if inside else r.from_outside
        if inside and not (begins_inside and not r.closes):
            open_text, begun = [r.tail_inside if begins_inside else r.tail_outside], r.block
    if inside:
        found.append((blocks["file"].iloc[0], begun, "\n".join(open_text)))
    return pd.DataFrame(found, columns=["file", "block", "text"])


def _place(file: np.ndarray, block: np.ndarray) -> np.ndarray:
    """A block's number, for lookups; equal ones need two of 2**64 to collide."""
    return file.astype(np.int64) ^ (block.astype(np.int64) * np.int64(0x9E3779B97F4A7C1 | 1))


def records(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, list[str]]:
    """(header: the number of the file's header, first: the header itself, text of each record; headers).

    Blocks are the scan's (spark.sql.files.maxPartitionBytes); a header lies within
    its file's first.  The driver gets the distinct headers, two numbers for each
    file, and one or two for each block.
    """
    lines = _lines(spark, path)
    ends = materialize(lines.mapInArrow(_ends, _ENDS), "csv-blocks")
    found = materialize(ends.groupBy("file").applyInPandas(_follow, "file long, block long, text string"), "csv-pieces")
    of_file = ends.where("block = 0").select("file", "header").toPandas().sort_values("file")
    headers = sorted(set(of_file["header"]))
    numbers = of_file["header"].map({h: i for i, h in enumerate(headers)}).to_numpy(np.int32)
    inside, known = (np.sort(_place(x["file"].to_numpy(), x["block"].to_numpy())) for x in (
        found.where("text is null").select("file", "block").toPandas(), ends.select("file", "block").toPandas()))
    sent = spark.sparkContext.broadcast((of_file["file"].to_numpy(np.int64), numbers, inside, known))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records that lie in one block."""
        files, numbers, inside_at, known = sent.value
        out: list[tuple[int, bool, str]] = []
        has = lambda places, at: bool(np.searchsorted(places, at, "right") - np.searchsorted(places, at))
        key, inside, held, whole, first, header = None, False, [], True, False, 0
        for file, block, lines in _by_block(batches):
            if key != (file, block):
                at = _place(np.array([file]), np.array([block]))[0]
                if not has(known, at):
                    raise ValueError("the files' blocks have changed between two passes")
                key, inside, held, first = (file, block), has(inside_at, at), [], block == 0
                whole, header = not inside, int(numbers[np.searchsorted(files, file)])
            for line in lines:
                held.append(line)
                inside = ends_inside(line, inside)
                if not inside:
                    if whole and not _blank(held):
                        out.append((header, first, "\n".join(held)))
                        first = False
                    held, whole = [], True
            if len(out) > 5000:
                yield _rows(out)
                out = []
        yield _rows(out)

    whole = lines.mapInArrow(cut, "header int, first boolean, text string")
    names = spark.createDataFrame(pd.DataFrame({"file": of_file["file"], "header": numbers}), "file long, header int")
    crossing = found.where("text is not null").join(names, "file").select("header", F.lit(False).alias("first"), "text")
    return whole.unionByName(crossing), headers


def _rows(out: list[tuple[int, bool, str]]) -> pa.RecordBatch:
    header, first, text = zip(*out, strict=True) if out else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(header, pa.int32()), pa.array(first, pa.bool_()), pa.array(text, pa.string())],
                                      names=["header", "first", "text"])


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType, rename: dict[str, str] | None = None) -> DataFrame:
    """Header-normalising CSV scan: header names are stripped and lower-cased,
    columns are matched by name (any order) and typed with ``try_cast`` so a
    bad cell becomes NULL instead of failing the job.  Every file is read by its own
    header line.  ``rename`` maps header names to schema names (id -> recipe_id,
    say) where the file lacks the latter.

    A field begins with a quote or has none that counts; quotes inside are doubled.
    Fields may hold commas and line ends, and a file is read by as many tasks as it
    has blocks.  Empty lines are left out, missing cells are NULL, cells beyond the
    header are left out.
    """
    rows, headers = records(spark, path)
    if not headers:
        return spark.createDataFrame([], schema)
    text = F.regexp_replace("text", "\r$", "")
    rows = rows.where(~F.col("first") & (text != "")).select("header", text.alias("text"))
    parsed = None
    for i, header in enumerate(headers):
        names = header_names(header)
        names = [(rename or {}).get(c, c) if (rename or {}).get(c, c) not in names else c for c in names]
        cells = F.from_csv("text", ", ".join(f"c{j} string" for j in range(len(names))), {"escape": '"', "mode": "PERMISSIVE"})
        row = F.struct(*[(cells[f"c{names.index(f.name)}"].try_cast(f.dataType) if f.name in names
                          else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
        parsed = F.when(F.col("header") == i, row) if parsed is None else parsed.when(F.col("header") == i, row)
    return rows.select(parsed.alias("row")).select("row.*")


def header_names(header: str) -> list[str]:
    """Column names of a header record, stripped and in small letters."""
    return [c.strip().lower() for c in next(csv.reader([header.strip("\r\n\ufeff")]), [])]
