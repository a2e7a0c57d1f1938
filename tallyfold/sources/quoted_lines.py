"""CSV records with quoted line breaks, read in parallel.

Whether a line starts inside a quoted field depends on all lines before it. Each block of a file (a
task's input split) is therefore walked under both assumptions, outside and inside, until they agree,
which they do at the first line that ends outside either way. A block so maps the state before it to
the state behind it; chaining these maps over a file's blocks, one row each, gives every block's
state. Records that cross a block's end are put together from their parts, at most one for each end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyfold.sources.tables import staged

# A field is quoted if it starts with a quote; a quote elsewhere in it is a character like others.
_FIELD = r'(?:"(?:[^"]++|"")*+"(?!")[^,]*+|(?!")[^,]*+)'
_REST = rf"(?:,{_FIELD})*+$"
ENDS_OUTSIDE, COMES_OUTSIDE = rf"^{_FIELD}{_REST}", rf'^(?:[^"]++|"")*+"(?!")[^,]*+{_REST}'
#: Characters of a record with line breaks; a longer one is taken for an unclosed quote.
MAX_RECORD = 16 << 20
BATCH = 10_000
EITHER = 2  # beside the states outside (0) and inside (1)


class InvalidInput(ValueError):
    """The input breaks the data contract."""


def ends_outside(line: Column) -> Column:
    """Whether a line that starts a record also ends it: no quoted field goes on in the next one."""
    return ~F.contains(line, F.lit('"')) | line.rlike(ENDS_OUTSIDE)


class _Walk:
    """A block's lines under the assumption that it starts in ``state``."""

    def __init__(self, state: int):
        self.state, self.begun = state, state  # begun: the first record started before the block
        self.held: list[str] = []
        self.size = 0

    def take(self, line: str) -> tuple[str, str | None] | None:
        """(kind, text) of what the line completes: a record, or the end of an earlier block's one."""
        if not self.state and not self.held and not line.strip():
            return None
        pattern = _COMES_OUTSIDE if self.state else _ENDS_OUTSIDE
        if self.size <= MAX_RECORD:
            self.held.append(line)
            self.size += len(line) + 1
        self.state = 0 if pattern.match(line) else 1
        if self.state:
            return None
        done = "lead" if self.begun else "record", self.text(True)
        self.held, self.size, self.begun = [], 0, 0
        return done

    def text(self, ended: bool) -> str | None:
        """The lines held, None if they are too long; a record's own line end is no part of it."""
        if self.size > MAX_RECORD:
            return None
        joined = "\n".join(self.held)
        return joined.removesuffix("\r") if ended else joined

    def rest(self) -> list[tuple[str, str | None]]:
        """What is still open at the block's end."""
        if not self.state:
            return []
        return [("middle" if self.begun else "tail", self.text(False))]


_ENDS_OUTSIDE, _COMES_OUTSIDE = re.compile(ENDS_OUTSIDE), re.compile(COMES_OUTSIDE)
_PARTS = pa.schema([("file", pa.string()), ("block", pa.int64()), ("state", pa.int32()),
                    ("kind", pa.string()), ("text", pa.string()), ("after", pa.int32())])


def _block(file: str, start: int, lines: Iterator[str], header: str):
    """Rows of ``_PARTS``. kind: record; lead, the end of a record from an earlier block; middle, a block
    inside one record; tail, the start of a record that goes on; and end, with the state ``after``."""
    walks = [_Walk(0)] if start == 0 else [_Walk(0), _Walk(1)]
    state = [0, 1]
    if start == 0:
        first = next(lines, header).removeprefix("\ufeff").removesuffix("\r")
        if first != header:
            raise InvalidInput(f"load_data: another header in {file}: {first}")
    for line in lines:
        for at, walk in zip(state, walks):
            if (done := walk.take(line)) is not None:
                yield file, start, at, *done, None
        if len(walks) == 2 and not walks[0].state and not walks[1].state:
            for at in state:
                yield file, start, at, "end", None, EITHER  # decided by the common walk
            walks, state = walks[:1], [EITHER]
    for at, walk in zip(state, walks):
        for kind, text in walk.rest():
            yield file, start, at, kind, text, None
        yield file, start, at, "end", None, walk.state


def _walked(lines: DataFrame, header: str) -> DataFrame:
    """``_PARTS`` rows of lines (file, block, value), which a task has in the order of the file."""
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch[c].to_pylist() for c in ("file", "block", "value")))

        out = []
        for (file, start), some in groupby(rows(), key=lambda r: r[:2]):
            for row in _block(file, start, (value for _, _, value in some), header):
                out.append(row)
                if len(out) == BATCH:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*out), _PARTS)], schema=_PARTS)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out), _PARTS)], schema=_PARTS)

    return lines.mapInArrow(
        walk, "file string, block long, state int, kind string, text string, after int")


def chain_blocks(ends: pa.Table) -> pa.Table:
    """(file, block, before, opened, unclosed) of a file's blocks: the state before each block, the block
    in which the record open at its start began, and whether the file ends inside quotes."""
    after: dict[int, dict[int, int]] = {}
    leads = set()
    for row in ends.to_pylist():
        if row["kind"] == "lead":
            leads.add(row["block"])
        else:
            after.setdefault(row["block"], {})[row["state"]] = row["after"]
    rows, state, opened = [], 0, None
    for block, maps in sorted(after.items()):
        rows.append((block, state, opened))
        then = maps[state]
        then = maps[EITHER] if then == EITHER else then
        if not then:
            opened = None
        elif not state or block in leads:
            opened = block  # the record that is open now began here
        state = then
    blocks, before, began = zip(*rows)
    return pa.table({"file": [ends["file"][0].as_py()] * len(rows), "block": blocks, "before": before,
                     "opened": pa.array(began, pa.int64()), "unclosed": [bool(state)] * len(rows)})


def _chained(ends: DataFrame) -> DataFrame:
    """``chain_blocks`` of every file; one row for each block."""
    return ends.select("file", "block", "state", "kind", "after").groupBy("file").applyInArrow(
        chain_blocks, "file string, block long, before long, opened long, unclosed boolean")


def quoted_records(spark: SparkSession, path: str, header: str) -> DataFrame:
    """(record) of the CSV files at ``path``, without their header line, line breaks inside quotes kept.

    Refuses a file that ends inside quotes or starts with another header, and a record of more than
    MAX_RECORD characters. Blank lines between records are no records.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), "value")
    parts = staged(_walked(lines, header), "parts")
    states = staged(_chained(parts.where("kind = 'end' OR (kind = 'lead' AND state = 1)")), "states")
    unclosed = states.where("unclosed").select("file").first()
    if unclosed is not None:
        raise InvalidInput(f"load_data: a quoted field isn't closed in {unclosed[0]}")
    held = parts.where("kind <> 'end'").join(states, ["file", "block"]).where(
        f"state = {EITHER} OR state = before")
    text = F.when(F.col("text").isNotNull(), F.col("text")).otherwise(F.raise_error(
        F.lit(f"load_data: a record of more than {MAX_RECORD} characters: a quote isn't closed")))
    whole = held.where("kind = 'record'").select(text.alias("record"))
    cut = held.where("kind <> 'record'").withColumn(
        "opened", F.when(F.col("kind") == "tail", F.col("block")).otherwise(F.col("opened")))
    sizes = cut.groupBy("file", "opened").agg(F.sum(F.length("text")).alias("n"))
    if (long := sizes.where(F.col("n") > MAX_RECORD).first()) is not None:
        raise InvalidInput(f"load_data: a record of {long['n']} characters in {long['file']}")
    pieces = cut.groupBy("file", "opened").agg(F.sort_array(F.collect_list(F.struct(
        "block", text.alias("text")))).alias("pieces"))  # MAX_RECORD characters at most
    joined = F.array_join(F.transform("pieces", lambda p: p["text"]), "\n")
    return whole.unionByName(pieces.select(joined.alias("record")))
