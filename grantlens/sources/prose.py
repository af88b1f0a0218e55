"""Delimited files whose quoted fields hold line breaks, read by as many tasks as Spark cuts them into.

Spark splits a text file at line ends, which says nothing of quotes. What a line does to them is a function of two
states: it ends inside a quoted field or not, for a start inside and for a start outside. These functions can be
put together, so one pass gives, for each split, its own function and the unfinished texts at its ends for both
starts. The driver runs through one row for each split, which is what it holds as its task list too, and so knows
the state each split starts in. The second pass gives the records that lie inside one split; those that a cut runs
through are put together from the stored ends.

Lines are read, and records parsed, by Spark's own readers, on any file system. A compressed file is one split.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.sources.storage import written

QUOTE = '"'
ENDS = "file string, block long, out boolean, into boolean, n_out long, lead string, begins boolean, trail_out string, trail_in string"


def _line_functions(sep: str):
    """(ends inside if it starts outside, ends inside if it starts inside) of the column ``value``.

    A quote opens a field only at its start; within it two quotes are one character; after the closing one the field
    goes on to the separator as it is. The patterns cannot go back, so they take time in proportion to the line.
    """
    s = rf"\x{ord(sep):02x}"
    inner = r'(?:[^"]++|"")*+'
    fields = rf'(?:[^"{s}][^{s}]*+{s}|{s}|"{inner}"[^{s}]*+{s})*+'
    opened = rf'{fields}"{inner}$'
    has_quote = F.contains("value", F.lit(QUOTE))
    out = has_quote & F.col("value").rlike(f"^{opened}")
    into = ~has_quote | F.col("value").rlike(f'^{inner}(?:$|"[^{s}]*+{s}{opened})')
    return out.alias("out"), into.alias("into")


def _lines(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(file, block, out, into, value) in the order of the file; ``block`` is where the split starts."""
    lines = spark.read.option("lineSep", "\n").text(path)
    place = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    lines = lines.select(*place, F.regexp_replace("value", "\r$", "").alias("value"))
    return lines.select("file", "block", *_line_functions(sep), "value")


def states_after(out: np.ndarray, into: np.ndarray, start: bool) -> np.ndarray:
    """Whether the text is inside a quoted field after each line, for the lines' two functions and a start."""
    at = np.arange(len(out))
    last = np.maximum.accumulate(np.where(out == into, at, -1))  # the last line after which the start no longer counts
    turns = np.cumsum(out & ~into)
    base = np.where(last >= 0, out[last], start)
    return base ^ ((turns - np.where(last >= 0, turns[last], 0)) % 2).astype(bool)


def _runs(batches) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The batches cut where another split starts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch.column(0).dictionary_encode().indices.to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield (batch.column(0)[a].as_py(), int(blocks[a])), batch.slice(a, b - a)


def _flags(run: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return run.column(2).to_numpy(zero_copy_only=False), run.column(3).to_numpy(zero_copy_only=False)


class _End:
    """What one split is for one start: its unfinished texts at either end."""

    def __init__(self, inside: bool):
        self.inside, self.started, self.n = inside, False, 0
        self.lead: list[str] = []
        self.open: list[str] = []

    def take(self, out, into, value) -> None:
        after = states_after(out, into, self.inside)
        before = np.concatenate([[self.inside], after[:-1]])
        starts = np.flatnonzero(~before)
        self.n += len(starts)
        first = int(starts[0]) if len(starts) else len(out)
        if not self.started:
            self.lead += value.slice(0, first).to_pylist()
        elif self.inside and not len(starts):
            self.open += value.to_pylist()
        if len(starts):
            self.started = True
            self.open = value.slice(int(starts[-1])).to_pylist() if after[-1] else []
        self.inside = bool(after[-1])

    def trail(self) -> str | None:
        return "\n".join(self.open) if self.inside and self.started else None


def _split_ends(batches):
    names = [c.split()[0] for c in ENDS.split(", ")]

    def row(place, ends):
        outside, inside = ends
        lead = "\n".join(inside.lead) if inside.lead else None
        values = [*place, outside.inside, inside.inside, outside.n, lead, inside.started, outside.trail(), inside.trail()]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    place, ends = None, None
    for here, run in _runs(batches):
        if here != place:
            if place:
                yield row(place, ends)
            place, ends = here, (_End(False), _End(True))
        for end in ends:
            end.take(*_flags(run), run.column(4))
    if place:
        yield row(place, ends)


def _starting_states(ends: DataFrame) -> dict[tuple[str, int], tuple[bool, int]]:
    """For each split whether it starts inside a quoted field, and the split in which that record began."""
    found, file, inside, began = {}, None, False, 0
    for r in ends.select("file", "block", "out", "into", "begins").orderBy("file", "block").toLocalIterator():
        if r.file != file:
            file, inside, began = r.file, False, r.block
        found[r.file, r.block] = inside, began
        if not inside or r.begins:
            began = r.block
        inside = r.into if inside else r.out
    return found


def _joined(value, bounds: list[int]):
    """The lines from each bound to the next, joined."""
    if len(bounds) - 1 == len(value):
        return value
    lists = pa.ListArray.from_arrays(pa.array([b - bounds[0] for b in bounds], pa.int32()), value.slice(bounds[0], bounds[-1] - bounds[0]))
    return pc.binary_join(lists, "\n")


def _whole_records(states, header: bool):
    def run(batches):
        place, inside, pending, started, skip = None, False, [], False, False
        for here, part in _runs(batches):
            if here != place:
                place, inside, pending, started = here, states[here][0], [], False
                skip = header and here[1] == 0
            value = part.column(4)
            after = states_after(*_flags(part), inside)
            before = np.concatenate([[inside], after[:-1]])
            starts = np.flatnonzero(~before).tolist()
            first = starts[0] if starts else len(value)
            found = []
            if started and inside:
                pending += value.slice(0, first).to_pylist()
            if pending and (starts or not after[-1]):
                found.append(pa.array(["\n".join(pending)], pa.string()))
                pending = []
            if starts:
                started = True
                bounds = [*starts, len(value)]
                if after[-1]:
                    pending = value.slice(starts[-1]).to_pylist()
                    bounds.pop()
                if len(bounds) > 1:
                    found.append(_joined(value.slice(bounds[0], bounds[-1] - bounds[0]), [b - bounds[0] for b in bounds]))
            inside = bool(after[-1])
            for records in found:
                if skip and len(records):
                    records, skip = records.slice(1), False
                yield pa.RecordBatch.from_arrays([records.cast(pa.string())], ["record"])

    return run


def _cut_pieces(states, header: bool):
    """(file, began, block, place, text): a split's texts of records that a cut runs through."""

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                inside, began = states[r["file"], r["block"]]
                if inside and r["lead"] is not None:
                    rows.append((r["file"], began, r["block"], 0, r["lead"]))
                trail = r["trail_in"] if inside else r["trail_out"]
                is_header = header and r["block"] == 0 and r["n_out"] == 1
                if trail is not None and not is_header:
                    rows.append((r["file"], r["block"], r["block"], 1, trail))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "began", "block", "place", "text"]
            )

    return run


def read_records(spark: SparkSession, path: str, sep: str = "\t", header: bool = True) -> DataFrame:
    """(record): the records of a file or folder of files as they are written, without the first of each file if it is
    a ``header``.

    ``\\r\\n`` counts as ``\\n``; empty lines between records are left out. A quoted field that is never closed
    runs to the end of its file, without a last line break.
    """
    lines = _lines(spark, path, sep)
    ends = written(lines.mapInArrow(_split_ends, ENDS), "split-ends")
    states = _starting_states(ends)
    whole = lines.mapInArrow(_whole_records(states, header), "record string")
    pieces = ends.mapInArrow(_cut_pieces(states, header), "file string, began long, block long, place int, text string")
    # One record each: as many rows as splits it runs through.
    together = pieces.groupBy("file", "began").agg(F.sort_array(F.collect_list(F.struct("block", "place", "text"))).alias("x"))
    # A text that no split begins is the rest of a header.
    together = together.filter(F.element_at("x", 1)["place"] == 1) if header else together
    cut = together.select(F.array_join("x.text", "\n").alias("record"))
    return whole.unionByName(cut).filter("record <> ''")


def read_delimited(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """All columns of a file or folder of files as text, named by the header."""
    options = {"sep": sep, "quote": QUOTE, "escape": QUOTE, "multiLine": True, "maxCharsPerColumn": -1}
    names = spark.read.options(header=True, **options).csv(path).columns
    fields = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    texts = {k: str(v) for k, v in options.items()}
    return read_records(spark, path, sep).select(F.from_csv("record", fields, texts).alias("r")).select("r.*")
