"""Quoted CSV read by many tasks, however large a file is, with line breaks inside cells.

A reader that lets cells hold line breaks usually takes a file as one task, since a place in the middle
of a file does not tell whether it lies inside a quoted cell.  Here the file is read as lines, block by block,
and every line is a step of a machine with two states, outside and inside a quoted cell:

1. each block tells in which state it ends for either state that it may begin in;
2. per file these steps are put one after the other (one row per block), so every block's first state is known;
3. lines that begin and end outside a quoted cell are records as they are; the others are put together by
   record, which is all that is shuffled.

A quote opens a cell only at the cell's first character, is doubled inside it, and is plain text elsewhere.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.session import materialize

#: A record that is longer is taken for a quote that nothing closes.
MOST_RECORD_BYTES = 64 << 20

_QUOTED = r'"(?:[^"]|"")*+"[^,]*'
_CELL = rf'(?:{_QUOTED}|[^",][^,]*|)'
_CLOSED = re.compile(rf'(?:{_CELL},)*+{_CELL}', re.DOTALL)
_CLOSES = re.compile(r'(?:[^"]|"")*+"[^,]*', re.DOTALL)


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted cell, if it begins inside one or not."""
    if inside:
        m = _CLOSES.match(line)
        if m is None:
            return True
        line = line[m.end() + 1:]  # after the cell's comma, if there is one
        if not line:
            return False
    return _CLOSED.fullmatch(line) is None


class _Walk:
    """A block's lines from one first state: state now, records begun, whether a record has several lines."""

    __slots__ = ("inside", "records", "several")

    def __init__(self, inside: bool):
        self.inside, self.records, self.several = inside, 0, inside

    def step(self, after: bool) -> int:
        """Takes a line; its record's number in the block, and twice two bits: inside before, inside after."""
        before = self.inside
        self.records += not before
        self.inside = after
        self.several |= before or after
        return self.records * 4 + before * 2 + after


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Runs of a batch's rows that come from one block."""
    names, starts = batch.column("file").to_pylist(), batch.column("block").to_pylist()
    a = 0
    for i in range(1, batch.num_rows + 1):
        if i == batch.num_rows or names[i] != names[a] or starts[i] != starts[a]:
            yield names[a], starts[a], batch.slice(a, i - a)
            a = i


def _steps(lines: pa.Array, walks: tuple[_Walk, _Walk]) -> tuple[list[int], list[int]]:
    quoted, texts = pc.match_substring(lines, '"').to_pylist(), lines.to_pylist()
    out: tuple[list[int], list[int]] = ([], [])
    for q, t in zip(quoted, texts):
        for w, o in zip(walks, out):
            o.append(w.step(ends_inside(t, w.inside) if q else w.inside))
    return out


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _blocks(lines: DataFrame) -> DataFrame:
    """Per block and first state (0, 1): last state, records begun, and whether some record has several lines."""
    names = [f"{x}{s}" for s in (0, 1) for x in ("end", "records", "several")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, walks, size = None, None, 0

        def row() -> pa.RecordBatch:
            values = [int(v) for w in walks for v in (w.inside, w.records, w.several)]
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([size], pa.int64()),
                                               *[pa.array([v], pa.int64()) for v in values]],
                                              names=["file", "block", "bytes", *names])

        for batch in batches:
            for name, start, part in _pieces(batch):
                if (name, start) != key:
                    if key is not None:
                        yield row()
                    key, walks, size = (name, start), (_Walk(False), _Walk(True)), 0
                value = part.column("value")
                size += (pc.sum(pc.binary_length(value)).as_py() or 0) + len(value)
                _steps(value, walks)
        if key is not None:
            yield row()

    return lines.mapInArrow(run, "file string, block bigint, bytes bigint, " + ", ".join(f"{n} bigint" for n in names))


def _first_states(blocks: DataFrame) -> DataFrame:
    """Per block: whether it begins inside a cell, and the (block, number) of the record that it begins in."""
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        inside, open_block, open_record, length = 0, 0, 0, 0
        out = {n: [] for n in ("file", "block", "inside", "open_block", "open_record", "several")}
        for r in rows:
            for n, v in (("file", r["file"]), ("block", r["block"]), ("inside", inside), ("open_block", open_block),
                         ("open_record", open_record), ("several", r[f"several{inside}"])):
                out[n].append(v)
            length = length + r["bytes"] if inside and not r[f"records{inside}"] else 0
            if length > MOST_RECORD_BYTES:
                raise ValueError(f"{r['file']}: a quoted cell is not closed within {length} bytes before byte {r['block']}")
            if r[f"records{inside}"]:
                open_block, open_record = r["block"], r[f"records{inside}"]
            inside = r[f"end{inside}"]
        return pa.table({"file": pa.array(out["file"], pa.string()),
                         **{n: pa.array(out[n], pa.int64()) for n in out if n != "file"}})

    return blocks.groupBy("file").applyInArrow(
        run, "file string, block bigint, inside bigint, open_block bigint, open_record bigint, several bigint")


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines with their place in the block and their step for either first state."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, walks, place = None, None, 0
        for batch in batches:
            for name, start, part in _pieces(batch):
                if (name, start) != key:
                    key, walks, place = (name, start), (_Walk(False), _Walk(True)), 0
                s0, s1 = _steps(part.column("value"), walks)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(range(place, place + n), pa.int64()), pa.array(s0, pa.int64()), pa.array(s1, pa.int64())],
                    names=[*part.schema.names, "place", "step0", "step1"])
                place += n

    return lines.mapInArrow(run, "value string, file string, block bigint, place bigint, step0 bigint, step1 bigint")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, is_first) of the CSV files under ``path``: one row per record, with the line breaks inside its
    cells; ``is_first`` marks the first record of each file.  Empty lines between records are left out."""
    lines = _lines(spark, path)
    states = materialize(_first_states(_blocks(lines)), "csv-blocks")
    told = _numbered(lines).join(states, ["file", "block"])
    step = F.when(F.col("inside") == 0, F.col("step0")).otherwise(F.col("step1"))
    told = told.withColumn("step", step).withColumn("number", F.floor(F.col("step") / 4).cast("bigint"))
    alone = F.col("step") % 4 == 0
    records = told.where(alone).select(F.col("value").alias("record"), ((F.col("block") == 0) & (F.col("place") == 0)).alias("is_first"))
    if not states.where("several = 1").isEmpty():
        open_ = F.col("number") == 0  # begun in an earlier block
        parts = told.where(~alone).select(
            "file", F.when(open_, F.col("open_block")).otherwise(F.col("block")).alias("at"),
            F.when(open_, F.col("open_record")).otherwise(F.col("number")).alias("no"),
            F.struct("block", "place", "value").alias("part"))
        whole = parts.groupBy("file", "at", "no").agg(F.sort_array(F.collect_list("part")).alias("parts"))
        records = records.unionAll(whole.select(
            F.array_join(F.col("parts.value"), "\n").alias("record"),
            ((F.col("parts")[0]["block"] == 0) & (F.col("parts")[0]["place"] == 0)).alias("is_first")))
    return records.select(F.regexp_replace("record", "\r$", "").alias("record"), "is_first").where("is_first or trim(record) != ''")


def read_quoted_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The cells of every record but each file's header, as text, under ``columns`` by position; a missing
    or empty cell is null and a surplus one is dropped."""
    schema = ", ".join(f"c{i} string" for i in range(len(columns)))
    rows = csv_records(spark, path).where("not is_first").select(
        F.from_csv("record", schema, {"escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}).alias("r"))
    return rows.select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(columns)])
