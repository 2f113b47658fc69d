"""Records of delimited text whose quoted fields may hold line feeds, with files still read in splits.

What a line does depends on whether it begins inside a quoted field, and a split can't know that of its first line. But the
effect of a line is a function of two values (outside, inside), and so is that of a split. One pass composes the functions of each
split's lines, a prefix scan over the splits gives every split its starting state, and the second pass cuts records where
a line begins outside. The pieces of a record that crosses the border of splits are put together by a shuffle; nothing else is.

A quote opens a field only at its beginning; others are text, as is what stands between a closing quote and the delimiter. A
record of more than `most` bytes is an error, as an unclosed quote would otherwise take all that follows. What is open
at the end of a file is a record. A file's lines end with a line feed, with or without a carriage return before it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The longest record, in bytes.
MOST = 2_000_000
_LINES = "value string, file string, block long"
#: Fields and quotes up to which a line is looked at by a pattern that recurses on them.
_DEEP = 2000


def _patterns(delimiter: str, own: str = "") -> tuple[str, str]:
    """Whether a line ends inside quotes, if it begins outside, and if inside. `own`: possessive repeats, where they exist."""
    d = re.sub(r"([^A-Za-z0-9])", r"\\\1", delimiter)
    text = f'(?:[^"]{"++" if own else "*"}|"")*{own}'
    behind = f'(?:[^"{d}][^{d}]*{own})?'
    opened = f'(?:(?:"{text}"{behind}|[^"{d}][^{d}]*{own}|){d})*{own}"{text}$'
    return f"^{opened}", f'^{text}(?:"{behind}{d}{opened}|$)'


def opens(line: Column, delimiter: str) -> Column:
    """Whether a line that begins outside may end inside quotes; a line of very many fields or quotes counts as one that does."""
    many = (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit(""))) > _DEEP) | (F.length(line) - F.length(F.replace(line, F.lit(delimiter), F.lit(""))) > _DEEP)
    return line.contains('"') & (many | line.rlike(_patterns(delimiter, "+")[0].removesuffix("$") + r"\z"))


def _effects(lines: pa.Array, delimiter: str) -> tuple[np.ndarray, np.ndarray]:
    """The state behind each line, if it begins outside, and if inside."""
    out, inside = np.zeros(len(lines), bool), np.ones(len(lines), bool)
    quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    if len(quoted):
        some = lines.take(pa.array(quoted))
        for states, pattern in zip((out, inside), _patterns(delimiter), strict=True):
            states[quoted] = pc.match_substring_regex(some, pattern).to_numpy(zero_copy_only=False)
    return out, inside


def _run(begin: bool, out: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """The states behind a run of lines: that of the last line that sets one, turned by the lines since that turn it."""
    sets, turns = out == inside, np.cumsum(out & ~inside)
    last = np.maximum.accumulate(np.where(sets, np.arange(len(out)), -1))
    base = np.where(last >= 0, out[last], begin)
    since = turns - np.where(last >= 0, turns[last], 0)
    return base ^ (since % 2 == 1)


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """Runs of lines of one split each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = pc.run_end_encode(batch.column(1)), batch.column(2).to_numpy()
        ends = np.union1d(files.run_ends.to_numpy(), np.append(np.flatnonzero(np.diff(blocks)) + 1, len(blocks)))
        for low, high in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            yield (batch.column(1)[low].as_py(), int(blocks[low])), batch.column(0).slice(low, high - low)


def _transitions(delimiter: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[bool]] = {}  # state behind the lines so far for either beginning; nothing but one record
        for split, lines in _splits(batches):
            now = found.setdefault(split, [False, True, True])
            out, inside = _effects(lines, delimiter)
            closed, opened = _run(now[0], out, inside), _run(now[1], out, inside)
            now[:] = [bool(closed[-1]), bool(opened[-1]), now[2] and bool(opened.all())]
        rows = [{"file": f, "block": b, "closed": c, "opened": o, "solid": s} for (f, b), (c, o, s) in found.items()]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("file", pa.string()), ("block", pa.int64()), ("closed", pa.bool_()), ("opened", pa.bool_()), ("solid", pa.bool_())]))

    return run


States = dict[str, dict[int, tuple[int | None, int | None]]]


def scan_states(found: list[tuple[str, int, bool, bool, bool]]) -> States:
    """Of each split: where the record began that is open at its beginning, and at its end (block of a split, or None)."""
    states: States = {}
    for file, block, closed, opened, solid in sorted(found):
        splits = states.setdefault(file, {})
        before = splits[max(splits)][1] if splits else None
        ends_open = opened if before is not None else closed
        splits[block] = (before, None if not ends_open else before if before is not None and solid else block)
    return states


def _cut(states: States, delimiter: str, header: bool, most: int, pieces: bool) -> Callable:
    """Whole records of each split, or with `pieces` those parts of records that begin or end in other splits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, size, first, state = None, [], 0, False, False
        opener: int | None = None

        def keep(lines: pa.Array) -> None:
            nonlocal size
            size += sum(len(x) + 1 for x in lines.to_pylist()) if len(lines) else 0
            if size > most:
                raise ValueError(f"{current[0]}: a record of more than {most} bytes near byte {current[1]}; a quote isn't closed")
            held.append(lines)

        def rows(values: pa.Array, begun: int | None) -> pa.RecordBatch:
            n = len(values)
            return pa.RecordBatch.from_arrays([values, pa.array([current[0]] * n, pa.string()), pa.array([current[1]] * n, pa.int64()), pa.array([begun] * n, pa.int64())], names=["value", "file", "block", "begun"])

        def joined() -> pa.Array:
            nonlocal held, size
            text = "\n".join(x for lines in held for x in lines.to_pylist())
            held, size = [], 0
            return pa.array([text])

        def end_of_split() -> Iterator[pa.RecordBatch]:
            if held:
                last = states[current[0]][current[1]][1]
                if last is None and opener is None:  # the file ends within quotes
                    last = current[1]
                if pieces:
                    yield rows(joined(), opener if opener is not None else last)

        for split, lines in _splits(batches):
            if split != current:
                if current is not None:
                    yield from end_of_split()
                if split[1] not in states.get(split[0], {}):
                    raise RuntimeError(f"{split[0]}: splits differ between two reads of one job; start it again")
                current, held, size = split, [], 0
                opener = states[split[0]][split[1]][0]
                state, first = opener is not None, header and split[1] == 0
            after = _run(state, *_effects(lines, delimiter))
            before = np.append(state, after[:-1])
            starts, state = np.flatnonzero(~before), bool(after[-1])
            head = int(starts[0]) if len(starts) else len(lines)
            if head:  # goes on with the open record
                keep(lines.slice(0, head))
            if not len(starts):
                if not state:
                    starts = np.array([len(lines)])
                else:
                    continue
            if held:
                done, began, opener = joined(), opener, None
                if began is not None and pieces:
                    yield rows(done, began)
                elif began is None and not pieces and not first:
                    yield rows(done, None)
                first = first and not done[0].as_py().strip()
            stop = int(starts[-1]) if state else len(lines)
            starts = starts[starts < stop]
            if len(starts) and not pieces:
                offsets = np.append(starts, stop)
                values = lines.slice(int(starts[0]), stop - int(starts[0]))
                if len(starts) < len(values):
                    values = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets - starts[0], pa.int32()), values), "\n")
                if first:
                    solid = np.flatnonzero([bool(x.strip()) for x in values.slice(0, 1000).to_pylist()])
                    if len(solid):
                        values, first = values.slice(int(solid[0]) + 1), False
                yield rows(values, None)
            elif len(starts):
                first = False
            if state:
                keep(lines.slice(stop))
        if current is not None:
            yield from end_of_split()

    return run


def read_records(spark: SparkSession, files: list[str], delimiter: str, header: bool, most: int = MOST) -> DataFrame:
    """(value, _source_file) of every record that isn't blank; with `header`, without the first one of each file."""
    lines = spark.read.option("lineSep", "\n").text(files).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    found = lines.mapInArrow(_transitions(delimiter), "file string, block long, closed boolean, opened boolean, solid boolean").collect()  # a row a split
    states = scan_states([tuple(r) for r in found])
    schema = f"{_LINES}, begun long"
    out = lines.mapInArrow(_cut(states, delimiter, header, most, False), schema).select("value", "file")
    crossing = [(f, b) for f, splits in states.items() for b, (begun, ends) in splits.items() if begun is not None or ends is not None]
    if crossing:  # only the lines of those splits leave the scan a second time
        some = lines.join(F.broadcast(spark.createDataFrame(crossing, "file string, block long")), ["file", "block"]).select("value", "file", "block")
        parts = some.mapInArrow(_cut(states, delimiter, header, most, True), schema).groupBy("file", "begun").agg(F.sort_array(F.collect_list(F.struct("block", "value"))).alias("p"))
        out = out.unionByName(parts.select(F.array_join(F.transform("p", lambda x: x["value"]), "\n").alias("value"), "file"))
    return out.where(F.trim(F.replace("value", F.lit("\r"), F.lit(""))) != "").select(F.regexp_replace("value", r"\r\z", "").alias("value"), F.col("file").alias("_source_file"))
