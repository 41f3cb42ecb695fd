"""Records of large JSON and XML files, whatever their formatting, each file read by many tasks.

A task that starts in the middle of a file cannot know what it is in: a string, a comment, how deep. So files are read twice.

1. Every split computes, for each state it may start in, the state it ends in, how much deeper it ends, and the lowest depth at which
   something closes. Only these few figures per split travel; taken in the order of the file they give every split its state.
2. With its state known, every split finds the borders of its records. A record that spans splits comes in fragments, which are
   numbered by the record ends before them, grouped and joined; all others never leave their task.

The text is cut at a byte that ends every record (``}`` or ``>``) by Spark's own line reader, so a piece belongs to the split it begins in.
Both passes must see the same splits. They depend on the session's settings, so the reading has a session of its own with fixed ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPLIT_BYTES = 128 << 20
#: Files that only one task can read; their size says nothing about their text.
_COMPRESSED = re.compile(r"\.(gz|bz2|lz4|snappy|deflate|zst|zstd)$")
_OPEN, _CLOSE, _OTHER = 1, -1, 0
_NONE = 1 << 40


class Malformed(ValueError):
    """The text is no whole document of its format."""


@dataclass
class Trace:
    """What one stretch of text does to a reader that starts in a given state.

    ``marks`` has a row per bracket or tag: its place (behind it where it closes), its kind, and the depth after it, counted from the start.
    """

    state: int
    depth: int
    marks: np.ndarray


class JsonText:
    """Objects in a top-level array, or one after the other."""

    delimiter = "}"
    outside, inside = states = (0, 1)
    _step = np.zeros(256, np.int64)
    _step[[ord("{"), ord("[")]] = 1
    _step[[ord("}"), ord("]")]] = -1

    def trace(self, data: bytes, state: int) -> Trace:
        text = np.frombuffer(data, np.uint8)
        quotes = np.flatnonzero(text == ord('"'))
        if len(quotes) and b"\\" in data:
            # A quote behind an odd number of backslashes belongs to the string.
            plain = np.maximum.accumulate(np.where(text != ord("\\"), np.arange(len(text)), -1))
            before = np.where(quotes > 0, plain[quotes - 1], quotes - 1)
            quotes = quotes[(quotes - 1 - before) % 2 == 0]
        places = np.flatnonzero(self._step[text])
        places = places[(np.searchsorted(quotes, places) + state) % 2 == self.outside]
        steps = self._step[text[places]]
        curly = (text[places] == ord("{")) | (text[places] == ord("}"))
        marks = np.stack([places + (steps < 0), np.where(curly, steps, _OTHER), np.cumsum(steps)], 1)
        return Trace((state + len(quotes)) % 2, int(steps.sum()), marks)

    def base(self, first: bytes) -> int:
        """The depth that records lie at, by the first character of a file."""
        return 1 if first == b"[" else 0

    def check(self, gaps: list[bytes], state: int, marks: np.ndarray, depth: int, base: int) -> None:
        """Between records there are only commas and the brackets of top-level arrays."""
        if state != self.outside and depth <= base:
            raise Malformed("a text stands where an object should")
        if b"".join(gaps).removeprefix(b"\xef\xbb\xbf").strip(b" \t\r\n[],"):
            raise Malformed(f"not an object: {b''.join(gaps)[:200]!r}")
        levels = marks[marks[:, 1] == _OTHER, 2] + depth
        if base == 0 and len(levels) and levels.min() < 1 or base == 1 and (marks[:, 2] + depth < 0).any():
            raise Malformed("brackets do not fit")


class XmlText:
    """Elements of one tag, in whatever else the document holds."""

    delimiter = ">"
    text, comment, cdata, instruction, subset, double, single, row_double, row_single = states = tuple(range(9))
    outside, pending = text, -1
    _ends = {comment: re.compile(rb"-->"), cdata: re.compile(rb"\]\]>"), instruction: re.compile(rb"\?>"), subset: re.compile(rb"\]\s*>")}
    _special = ((b"<!--", comment), (b"<![CDATA[", cdata), (b"<?", instruction))
    _inside_tag = re.compile(rb"[\"'>]")

    def __init__(self, row_tag: str):
        tag = re.escape(row_tag.encode())
        # Text and tags without quotes that are not those of a record.
        self._skipped = re.compile(rb"(?:[^<]++|<(?!/?" + tag + rb"[\s/>]|[!?])[^\"'>]*+>)*+")
        self._opening = re.compile(rb"<" + tag + rb"(?=[\s/>])")
        self._closing = re.compile(rb"</" + tag + rb"\s*>")

    def _tag_end(self, data: bytes, at: int) -> tuple[int, int]:
        """Where the tag ends that ``at`` lies in, outside of quotes; else the end and what is open there."""
        while True:
            found = self._inside_tag.search(data, at)
            if found is None:
                return len(data), self.pending
            if found[0] == b">":
                return found.end(), self.text
            at = data.find(found[0], found.end()) + 1
            if not at:
                return len(data), self.double if found[0] == b'"' else self.single

    def trace(self, data: bytes, state: int) -> Trace:
        at, depth, marks = 0, 0, []

        def close(place: int) -> None:
            nonlocal depth
            depth -= 1
            marks.append((place, _CLOSE, depth))

        while at < len(data):
            if state in self._ends:
                found = self._ends[state].search(data, at)
                if found is None:
                    break
                at, state = found.end(), self.text
                continue
            row = state in (self.row_double, self.row_single)
            if state != self.text:
                quote = b'"' if state in (self.double, self.row_double) else b"'"
                at = data.find(quote, at) + 1
                if not at:
                    break
            else:
                at = self._skipped.match(data, at).end()
                if at == len(data):
                    break
                special = next(((mark, kind) for mark, kind in self._special if data.startswith(mark, at)), None)
                if special is not None:
                    at, state = at + len(special[0]), special[1]
                    continue
                closing = self._closing.match(data, at)
                if closing is not None:
                    at = closing.end()
                    close(at)
                    continue
                row = self._opening.match(data, at) is not None
                if row:
                    depth += 1
                    marks.append((at, _OPEN, depth))
                elif data.startswith(b"<!DOCTYPE", at):
                    bracket, end = data.find(b"[", at), data.find(b">", at)
                    if 0 <= bracket < end:
                        at, state = bracket, self.subset
                        continue
            at, state = self._tag_end(data, at)
            if state == self.pending:
                break
            if row and state == self.text and data[at - 2 : at - 1] == b"/":
                close(at)
            if row and state != self.text:
                state = self.row_double if state == self.double else self.row_single
        return Trace(state, depth, np.array(marks, np.int64).reshape(-1, 3))

    def base(self, first: bytes) -> int:
        return 0

    def check(self, gaps: list[bytes], state: int, marks: np.ndarray, depth: int, base: int) -> None:
        """Anything may stand between records."""


def _pieces(spark: SparkSession, path: str, delimiter: str) -> DataFrame:
    """The text between delimiters, in order within a split; a split is named by its file and first byte."""
    reading = spark.newSession()
    reading.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))
    reading.conf.set("spark.sql.files.openCostInBytes", str(SPLIT_BYTES))
    reading.conf.set("spark.sql.files.minPartitionNum", "1")
    meta = "_metadata"
    return reading.read.option("lineSep", delimiter).text(path).select(
        F.col(f"{meta}.file_path").alias("file"),
        F.col(f"{meta}.file_block_start").alias("start"),
        F.col(f"{meta}.file_size").alias("size"),
        F.col("value").cast("binary").alias("piece"),
    )


def _stretches(batches: Iterator[pa.RecordBatch], delimiter: bytes) -> Iterator[tuple[tuple, bytes, bytes | None]]:
    """(split, text with all its delimiters, None) as it comes, then (split, b"", last piece without its delimiter) at the end of each."""
    split, held = None, b""
    for batch in batches:
        names = list(zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns - 1))))
        pieces = batch.column(batch.num_columns - 1).to_pylist()
        first = 0
        for k in range(1, len(pieces) + 1):
            if k < len(pieces) and names[k][:2] == names[first][:2]:
                continue
            if split is not None and split[:2] == names[first][:2]:
                arrived = [held, *pieces[first:k]]
            else:
                if split is not None:
                    yield split, b"", held
                split, arrived = names[first], pieces[first:k]
            held = arrived.pop()
            if arrived:
                yield split, delimiter.join([*arrived, b""]), None
            first = k
    if split is not None:
        yield split, b"", held


_SUMMARY = (
    "file string, start bigint, size bigint, state int, end_state int, change bigint, lowest bigint, bytes bigint, first binary, "
    "cut_state int, cut_change bigint"
)


def _summaries(form, delimiter: bytes):
    """Per split and state it may start in: where it ends, with its last delimiter and (``cut_``) without."""

    def lowest(trace: Trace, depth: int) -> int:
        closes = trace.marks[trace.marks[:, 1] == _CLOSE, 2]
        return int(closes.min()) + depth if len(closes) else _NONE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n_bytes, first = {}, 0, b""
        for split, data, last in _stretches(batches, delimiter):
            if not now:
                now = {state: (state, 0, _NONE) for state in (form.states if split[1] else (form.outside,))}
            ended = {}
            if last is not None:
                ended = {state: form.trace(last, state) for state in {one[0] for one in now.values()}}
                data = last + delimiter
            first = first or data.removeprefix(b"\xef\xbb\xbf").lstrip()[:1]
            n_bytes += len(data)
            traces = {state: form.trace(data, state) for state in {one[0] for one in now.values()}}
            before, now = now, {
                begun: (traces[at].state, depth + traces[at].depth, min(low, lowest(traces[at], depth)))
                for begun, (at, depth, low) in now.items()
            }
            if last is not None:
                rows = [
                    (*split, begun, at, depth, low, n_bytes, first, ended[before[begun][0]].state, before[begun][1] + ended[before[begun][0]].depth)
                    for begun, (at, depth, low) in now.items()
                ]
                names = [field.split()[0] for field in _SUMMARY.split(", ")]
                kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
                types = [kinds[field.split()[1]] for field in _SUMMARY.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(one, kind) for one, kind in zip(zip(*rows), types)], names=names)
                now, n_bytes, first = {}, 0, b""

    return run


_STATES = "file string, start bigint, state int, depth bigint, base bigint, ends_before bigint, whole boolean"


def _composed(form):
    """The state that every split of one file really starts in, from its summaries; fails where the file ends in a record."""

    def fold(summaries: pd.DataFrame) -> pd.DataFrame:
        file, size = summaries["file"].iloc[0], int(summaries["size"].iloc[0])
        by_split = {key: rows.set_index("state") for key, rows in summaries.groupby("start")}
        first = next((bytes(by_split[key]["first"].iloc[0]) for key in sorted(by_split) if by_split[key]["first"].iloc[0]), b"")
        base, state, depth, ends, read, out = form.base(first), form.outside, 0, 0, 0, []
        for start in sorted(by_split):
            row = by_split[start].loc[state]
            out.append((file, start, state, depth, base, ends, True))
            if depth < 0:
                raise Malformed(f"{file}: more closes than opens")
            ends += int(depth + row["lowest"] == base)
            before = depth
            state, depth, read = int(row["end_state"]), depth + int(row["change"]), read + int(row["bytes"])
        # The line reader does not tell whether the last piece ended at a delimiter; the size of the file does. It skips a byte order
        # mark of three bytes.
        if out and read - size in (1, -2) and not _COMPRESSED.search(file):
            state, depth = int(row["cut_state"]), before + int(row["cut_change"])
            out[-1] = (*out[-1][:-1], False)
        if out and (state != form.outside or depth):
            raise Malformed(f"{file}: ends inside of a record")
        return pd.DataFrame(out, columns=[field.split()[0] for field in _STATES.split(", ")])

    return fold


_RECORDS = "file string, number bigint, start bigint, text binary"


def _records(form, delimiter: bytes):
    """The records of each split; those that span splits as fragments with the number of the record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, state, depth, parts, head, ended, rows = None, 0, 0, [], False, False, []
        for found, data, last in _stretches(batches, delimiter):
            file, start, began, deep, base, before, whole = found
            if began is None:
                raise Malformed(f"{file}: has changed while it was read")
            if split != (file, start):
                split, state, depth, ended = (file, start), began, deep, False
                head, parts = depth > base, []
            if last is not None:
                data = last + delimiter if whole else last
            trace = form.trace(data, state)
            levels = trace.marks[:, 2] + depth
            begins = trace.marks[(trace.marks[:, 1] == _OPEN) & (levels == base + 1), 0].tolist()
            closes = trace.marks[(trace.marks[:, 1] == _CLOSE) & (levels == base), 0].tolist()
            at, gaps = 0, []
            is_open = depth > base
            while is_open or begins:
                if not is_open:
                    gaps.append(data[at : begins[0]])
                    at, is_open = begins.pop(0), True
                if not closes:
                    parts.append(data[at:])
                    at = len(data)
                    break
                end = closes.pop(0)
                parts.append(data[at:end])
                rows.append((file, before if head else None, start, b"".join(parts)))
                at, is_open, head, ended, parts = end, False, False, True, []
            gaps.append(data[at:])
            form.check(gaps, state, trace.marks, depth, base)
            state, depth = trace.state, depth + trace.depth
            if last is not None and parts:
                rows.append((file, before + int(ended), start, b"".join(parts)))
                parts = []
            if len(rows) > 5_000:
                yield _record_batch(rows)
                rows = []
        yield _record_batch(rows)

    return run


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
    columns = list(zip(*rows)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(one, kind) for one, kind in zip(columns, kinds)], names=["file", "number", "start", "text"])


def read_records(spark: SparkSession, path: str, form: JsonText | XmlText) -> DataFrame:
    """``text``: one row per record of the files at ``path``, as it stands there. Malformed files fail the job."""
    delimiter = form.delimiter.encode()
    pieces = _pieces(spark, path, form.delimiter)
    summaries = pieces.mapInArrow(_summaries(form, delimiter), _SUMMARY)
    states = summaries.groupBy("file").applyInPandas(_composed(form), _STATES).collect()
    known = F.broadcast(spark.createDataFrame(states, _STATES))
    # The states stand on the left, so that the result belongs to the session of the caller.
    named = known.join(pieces, ["file", "start"], "right")
    stated = named.select("file", "start", "state", "depth", "base", "ends_before", "whole", "piece")
    records = stated.mapInArrow(_records(form, delimiter), _RECORDS)
    parts = F.sort_array(F.collect_list(F.struct("start", "text")))
    joined = F.array_join(F.transform(parts, lambda one: one["text"].cast("string")), "")
    spanning = records.where("number is not null").groupBy("file", "number").agg(joined.alias("text"))
    return records.where("number is null").select(F.col("text").cast("string").alias("text")).unionByName(spanning.select("text"))
