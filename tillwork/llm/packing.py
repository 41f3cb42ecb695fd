"""Best-fit packing of tokenized documents into sequences of a fixed length, by sums of squares.

A document is the ids of its text and one id that closes it. Documents longer than a sequence are cut so that only their first
piece is shorter than one; full pieces are sequences of their own. All others are placed one by one, longest first: among a new
sequence and the open ones with room, a piece goes where the sum, over all gaps, of the squared number of open sequences with
that gap becomes smallest. That keeps many different gaps open, so a later piece finds one that it fills exactly.
Between equal sums the smallest gap wins, and an open sequence before a new one.

Texts are read once and tokenized in the tasks, one by one and whole. Pieces are
written before they are placed, so a lost executor tokenizes nothing twice. Pieces are dealt round robin to shards of about ``SHARD``
pieces: no key decides where a piece goes, so no shard is larger than others, and each is placed by one task in bounded memory (a
count per gap and the numbers of the open sequences). What stays open at the end of a shard is a few sequences.

Defined results: a null or empty text is the closing id alone; rows that repeat an id, and rows without an id, are documents each; texts of any
length are cut, never dropped; pieces of equal length are placed by id, then piece, then what they hold; an empty table gives no rows; other
columns are carried, but for those that bear the name of an added one. ``sequence_id`` is a name without order: full pieces have
negative ones.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType
from tokenizers import Tokenizer

from tillwork.llm import tables

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 2_048
CLOSING = 0
#: Pieces that one task places.
SHARD = 8_000
#: Ids of about so many are held before their pieces are handed on.
HELD = 500_000
_ADDED = ("piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset")
#: Longer runs of white space exhaust the stack of the faster library's patterns.
BLANKS = 20_000
_BLANKS = re.compile(rf"\s{{{BLANKS}}}")
# Fixed value: what byte-level tokenizers take for a word.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_codings: dict[str, tiktoken.Encoding] = {}


def coding(path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary of a tokenizer file, read once per process.

    Merges are applied in the order of the ids they make, which is what the file's own order has to be. Then the ids
    are those of the tokenizers library, from a fifth of its time; the strings of added tokens are these tokens.
    """
    if path not in _codings:
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model, before = parts["model"], parts["pre_tokenizer"]
        merges = [one if isinstance(one, list) else one.split(" ") for one in model["merges"]]
        ids = [model["vocab"]["".join(one)] for one in merges]
        if before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"] or parts["normalizer"] or ids != sorted(ids):
            raise ValueError(f"{path} is no byte-level vocabulary whose ids follow its merges")
        added = {one["content"]: one["id"] for one in parts["added_tokens"]}
        byte = {shown: number for number, shown in enumerate(shown_bytes())}
        ranks = {bytes(map(byte.__getitem__, token)): number for token, number in model["vocab"].items() if token not in added}
        _codings[path] = tiktoken.Encoding(path, pat_str=_WORDS, mergeable_ranks=ranks, special_tokens=added)
    return _codings[path]


def shown_bytes() -> list[str]:
    """The character that stands for each byte: itself where it can be seen, else the next one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(number if number in seen else next(others)) for number in range(256)]


_libraries: dict[str, Tokenizer] = {}


def library(path: str) -> Tokenizer:
    """The tokenizers library on the same file, without truncation and padding; read once per process."""
    if path not in _libraries:
        _libraries[path] = Tokenizer.from_file(path)
        _libraries[path].no_truncation()
        _libraries[path].no_padding()
    return _libraries[path]


def encode(texts: list[str | None], path: str) -> Iterator[np.ndarray]:
    """The ids of each text with the closing one."""
    coder = coding(path)
    for text in texts:
        text = text or ""
        if len(text) > BLANKS and _BLANKS.search(text):
            found = np.array(library(path).encode(text, add_special_tokens=False).ids, np.uint32)
        else:
            found = coder.encode_to_numpy(text, allowed_special="all")
        yield np.append(found, np.uint32(CLOSING))


def cuts(n_ids: int, capacity: int) -> list[int]:
    """Where the pieces of a document begin, and its end."""
    return [0, *range(n_ids - (n_ids - 1) // capacity * capacity, n_ids + 1, capacity)]


def pieces(documents: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """One row per piece: the columns of its document but ``text``, its place there, and what it holds."""
    rows = tables.without(documents, _ADDED)
    kept = [name for name in rows.columns if name != "text"]
    added = [("piece", "int"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint")]
    schema = rows.select(*[f"`{name}`" for name in kept], *(F.lit(None).cast(kind).alias(name) for name, kind in added)).schema
    if with_ids:
        schema = schema.add("ids", ArrayType(IntegerType()))
    types = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            others = batch.select(kept)
            found, size, first = [], 0, 0
            for row, ids in enumerate(encode(texts, path)):
                found.append(ids)
                size += len(ids)
                if size >= HELD or row + 1 == len(texts):
                    yield _piece_rows(others.slice(first, len(found)), found, capacity, types, with_ids)
                    found, size, first = [], 0, row + 1

    return rows.mapInArrow(run, schema)


def _piece_rows(others: pa.RecordBatch, found: list[np.ndarray], capacity: int, types: pa.Schema, with_ids: bool) -> pa.RecordBatch:
    places = [(row, number, a, b) for row, ids in enumerate(found) for number, (a, b) in enumerate(_pairs(cuts(len(ids), capacity)))]
    owner, number, begin, end = (np.array(one, np.int64) for one in zip(*places))
    crcs = [zlib.crc32(found[row][a:b].astype("<u4").tobytes()) for row, _, a, b in places]
    columns = [*others.take(pa.array(owner)).columns, number.astype(np.int32), begin, end - begin, np.array(crcs, np.int64)]
    if with_ids:
        offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32)
        columns.append(pa.ListArray.from_arrays(offsets, np.concatenate(found).astype(np.int32)))
    return pa.RecordBatch.from_arrays([one if isinstance(one, pa.Array) else pa.array(one) for one in columns], names=types.names).cast(types)


def _pairs(cuts: list[int]) -> list[tuple[int, int]]:
    return list(zip(cuts, cuts[1:]))


class Sequences:
    """Open sequences of one shard by their gap."""

    def __init__(self, capacity: int):
        self.capacity, self.begun = capacity, 0
        self.count = np.zeros(capacity, np.int64)
        self.open: list[list[int]] = [[] for _ in range(capacity)]

    def place(self, size: int) -> tuple[int, int]:
        """The number of the sequence that takes a piece of ``size`` ids, and its place there."""
        gap = self.choose(size)
        if gap == self.capacity:
            number, self.begun = self.begun, self.begun + 1
        else:
            number = self.open[gap].pop()
            self.count[gap] -= 1
        if gap > size:
            self.open[gap - size].append(number)
            self.count[gap - size] += 1
        return number, self.capacity - gap

    def choose(self, size: int) -> int:
        """The gap to fill; ``capacity`` stands for a new sequence, where no open one has room.

        From gap g to g - size the sum changes by 2 (N(g - size) - N(g)) + 2, by 1 less where nothing stays open.
        """
        here = self.count[size:]
        if not here.any():
            return self.capacity
        change = 2 * (self.count[: self.capacity - size] - here) + 2
        change[0] -= 1
        change[here == 0] = np.iinfo(np.int64).max
        return size + int(np.argmin(change))


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a written table) with ``sequence_id`` and ``offset``."""
    full = pieces.where(F.col("length") == capacity)
    full = full.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("bigint"))
    rest = pieces.where(F.col("length") < capacity)
    shards = rest.count() // SHARD + 1
    order = [F.desc("length"), *(F.col(name) for name in ("doc_id", "piece", "ids_crc32") if name in pieces.columns)]
    dealt = rest.repartition(shards).sortWithinPartitions(*order)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences, shard = Sequences(capacity), TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = batch.column(batch.schema.get_field_index("length")).to_pylist()
            placed = np.array([sequences.place(size) for size in sizes], np.int64).reshape(-1, 2)
            columns = [*batch.columns, pa.array(placed[:, 0] + shard), pa.array(placed[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "sequence_id", "offset"])

    return full.unionByName(dealt.mapInArrow(fill, full.schema))


def pack(documents: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Every piece of every document with its ids, its sequence and its place there."""
    return place(tables.cut(documents.sparkSession, pieces(documents, path, capacity, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ``ids``, the ids of its pieces in order: at most one sequence's worth per row."""
    gathered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(gathered, lambda one: one["ids"])).alias("ids"))


def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of all documents with its place; the ids travel as their checksum."""
    documents = tables.read(spark, folder, "documents").select("doc_id", "text")
    packed = pack(documents, vocabulary_path(), with_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
