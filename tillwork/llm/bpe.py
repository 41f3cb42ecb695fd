"""BPE encoding and decoding with a pair occurrence index.

Texts are normalised (NFC, white space, lower case) and cut into words as the vocabulary file asks. The distinct
words of a batch that no earlier batch of the task has seen are encoded together: all their symbols form one
linked list, and an index maps each adjacent pair that has a merge to all of its positions. The active ranks are
applied in ascending order, each to all positions at once, and only the lists of the changed neighbours are
updated. A merge that gives rise to a pair of lower rank would have to yield to it at once; words where
that happens are encoded again one by one.

The file may name the special tokens' strings in a text; those become their ids. Decoding joins the tokens of the
ids with one space, as the file names no decoder. Encoded words are kept within a task, about ``CACHE`` of them.

Defined results: null is the empty text and gives no token; texts of any length are encoded whole; of equal pairs in a word
the first is merged first; repeated rows are encoded one by one; an empty table
gives no rows; other columns are carried, but for those that bear the name of an added one.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm import tables

VOCABULARY = "word_bpe_49k.json"
CACHE = 40_000
_TEXTS = 400  # at a time
_NONE = np.int64(1) << 40


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(byte) if byte in shown else chr(next(hidden)) for byte in range(256)]


class Vocabulary:
    """A word-end BPE vocabulary with its merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.tokens = dict(zip(ids.values(), ids))
        self.special = {one["content"]: one["id"] for one in content["added_tokens"]}
        self.tokens |= {number: name for name, number in self.special.items()}
        self._special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        split = content["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._word = regex.compile(split)
        self._path, self._library = path, None
        characters = _byte_characters()
        self._bytes = {one: byte for byte, one in enumerate(characters)}
        self._inner = np.array([ids[one] for one in characters], np.int64)
        self._last = np.array([ids[one + self.suffix] for one in characters], np.int64)
        pairs = [(ids[a], ids[b], ids[a + b]) for a, b in model["merges"]]
        self._size = max(ids.values()) + 1
        keys = np.array([a * self._size + b for a, b, _ in pairs], np.int64)
        # A pair that is listed twice has its last rank.
        order = np.argsort(keys, kind="stable")
        last = np.append(keys[order][1:] != keys[order][:-1], True)
        self._keys, self._ranks = keys[order][last], order[last].astype(np.int64)
        self._made = np.array([made for *_, made in pairs], np.int64)
        self._id_names = [f"{k}{end}" for end in " \n" for k in range(self._size)]
        self._token_names = [f"{self.tokens.get(k, '')}{end}" for end in " \n" for k in range(self._size)]
        self._left = np.array([a for a, *_ in pairs], np.int64)
        self._right = np.array([b for _, b, _ in pairs], np.int64)

    # Words.

    def words(self, text: str) -> list[str | int]:
        """The words of a text in order; ids stand for special tokens."""
        if "<|" not in text:
            return self._split(text)
        found: list[str | int] = []
        done = 0
        for match in self._special_pattern.finditer(text):
            found += self._split(text[done : match.start()])
            found.append(self.special[match.group()])
            done = match.end()
        return found + self._split(text[done:])

    def _split(self, text: str) -> list[str]:
        """Letters, digits and marks as Unicode has them; the newest characters as the file's own library has them."""
        if text.isascii() or all(unicodedata.category(one) != "Cn" for one in set(text)):
            return self._word.findall(_normal(text))
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._path)
        pieces = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
        return [bytes(map(self._bytes.__getitem__, piece)).decode() for piece, _ in pieces]

    # The pair occurrence index.

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self._size + right
        places = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[places] == keys, self._ranks[places], _NONE)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in turn, and where each word's begin and the last one's end."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        raw = [word.encode() for word in words]
        sizes = np.array([len(one) for one in raw])
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbol = self._inner[data]
        symbol[ends - 1] = self._last[data[ends - 1]]
        count = len(symbol)
        after, before = np.arange(1, count + 1), np.arange(-1, count - 1)
        after[ends - 1] = -1
        before[ends - sizes] = -1
        rank = np.full(count, _NONE)
        inner = np.flatnonzero(after >= 0)
        rank[inner] = self.rank(symbol[inner], symbol[inner + 1])
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(places: np.ndarray) -> None:
            order = places[np.argsort(rank[places], kind="stable")]
            ranks = rank[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            bounds = [0, *cuts.tolist(), len(order)]
            for a, b in zip(bounds, bounds[1:]):
                number = int(ranks[a])
                if number not in index:
                    index[number] = []
                    heapq.heappush(active, number)
                index[number].append(order[a:b])

        if len(start := inner[rank[inner] < _NONE]):
            enter(start)
        irregular: list[np.ndarray] = []
        while active:
            number = heapq.heappop(active)
            listed = index.pop(number)
            places = listed[0] if len(listed) == 1 else np.unique(np.concatenate(listed))
            places = places[rank[places] == number]
            if not len(places):
                continue
            if self._left[number] == self._right[number]:
                places = _alternate(np.sort(places), after)
            gone = after[places]
            following = after[gone]
            symbol[places] = self._made[number]
            rank[gone] = _NONE
            symbol[gone] = -1
            after[places] = following
            has_next = following >= 0
            before[following[has_next]] = places[has_next]
            rank[places] = _NONE
            previous = before[places]
            changed = np.concatenate([places[has_next], previous[previous >= 0]])
            rank[changed] = self.rank(symbol[changed], symbol[after[changed]])
            found = changed[rank[changed] < _NONE]
            if len(found):
                found = np.unique(found)
                early = rank[found] < number
                if early.any():
                    irregular.append(found[early])
                enter(found)
        alive = symbol >= 0
        ids = symbol[alive]
        bounds = np.concatenate(([0], np.cumsum(alive)))[np.concatenate(([0], ends))]
        if irregular:
            pieces = np.split(ids, bounds[1:-1])
            for k in np.unique(np.searchsorted(ends, np.concatenate(irregular), "right")).tolist():
                pieces[k] = self._encode_one(raw[k])
            ids, bounds = np.concatenate(pieces), np.cumsum([0, *map(len, pieces)])
        return ids, bounds

    def written(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[list[str], list[str], list[bytes]]:
        """Per word: ids and tokens, each joined by a space, and the ids as 32-bit numbers."""
        numbers = ids.astype(np.int32).tobytes()
        cuts = (4 * bounds).tolist()
        last = np.zeros(len(ids), np.int64)
        last[bounds[1:] - 1] = self._size
        places = (ids + last).tolist()
        # No id or token holds a space or a line end, so one string for all can be split again.
        both = ("".join(map(names.__getitem__, places)).split("\n")[:-1] for names in (self._id_names, self._token_names))
        return *both, [numbers[a:b] for a, b in zip(cuts, cuts[1:])]

    def _encode_one(self, raw: bytes) -> np.ndarray:
        """Merge the pair of lowest rank, the leftmost of equals, until none is left."""
        data = np.frombuffer(raw, np.uint8)
        symbols = np.append(self._inner[data[:-1]], self._last[data[-1]])
        while len(symbols) > 1:
            ranks = self.rank(symbols[:-1], symbols[1:])
            at = int(ranks.argmin())
            if ranks[at] == _NONE:
                break
            symbols = np.concatenate([symbols[:at], [self._made[ranks[at]]], symbols[at + 2 :]])
        return symbols


def _alternate(places: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of pairs of one symbol with itself that overlap in a chain: every other one from the left."""
    chained = np.concatenate(([False], places[1:] == after[places[:-1]]))
    numbers = np.arange(len(places))
    first = np.maximum.accumulate(np.where(chained, 0, numbers))
    return places[(numbers - first) % 2 == 0]


def _normal(text: str) -> str:
    """NFC and lower case by character. White space never belongs to a word, so it need not be rewritten."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Coder:
    """Encodes texts, and remembers words."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self._known: dict[str | int, tuple[str, str, bytes]] = {}

    def encode(self, texts: list[str | None]) -> list[list[tuple[str, str, bytes]]]:
        """Per text and word: the ids and the tokens, each joined by a space, and the ids as 32-bit numbers."""
        found = [self.vocabulary.words(text) if text else [] for text in texts]
        if len(self._known) > CACHE:
            self._known.clear()
        new = list({word for words in found for word in words}.difference(self._known))
        fresh = [word for word in new if isinstance(word, str)]
        self._known.update(zip(fresh, zip(*self.vocabulary.written(*self.vocabulary.encode(fresh)))))
        for special in new:
            if not isinstance(special, str):
                self._known[special] = str(special), self.vocabulary.tokens[special], np.array([special], np.int32).tobytes()
        return [list(map(self._known.__getitem__, words)) for words in found]


    def forget(self) -> None:
        """At the end of a task, so that idle Python workers hold the vocabulary only."""
        self._known = {}
        pa.default_memory_pool().release_unused()


@lru_cache(maxsize=1)
def _coder(path: str) -> Coder:
    """One coder per Python worker."""
    return Coder(path)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(documents: DataFrame, path: str) -> DataFrame:
    """``documents`` with ``ids``, the ids of each text in order."""
    documents = tables.without(documents, ("ids",))
    schema = documents.select("*", F.lit(None).cast("array<int>").alias("ids")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for batch, found in _encoded(coder, batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, _id_lists(found)], [*batch.schema.names, "ids"])

    return documents.mapInArrow(run, schema)


def _encoded(coder: Coder, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[tuple[str, str, bytes]]]]]:
    """A few texts at a time, with their words."""
    for batch in batches:
        for first in range(0, batch.num_rows, _TEXTS):
            part = batch.slice(first, _TEXTS)
            yield part, coder.encode(part.column(part.schema.get_field_index("text")).to_pylist())
    coder.forget()


def _id_lists(found: list[list[tuple[str, str, bytes]]]) -> pa.Array:
    joined = [b"".join([word[2] for word in words]) for words in found]
    offsets = np.cumsum([0, *(len(one) // 4 for one in joined)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(joined), np.int32)))


def round_trip(documents: DataFrame, path: str) -> DataFrame:
    """``documents`` with ``ids`` and ``decoded``, as ``encode`` and ``decode`` give them, in one pass."""
    documents = tables.without(documents, ("ids", "decoded"))
    schema = documents.select("*", F.lit(None).cast("array<int>").alias("ids"), F.lit("").alias("decoded")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for batch, found in _encoded(coder, batches):
            decoded = pa.array([" ".join([word[1] for word in words]) for words in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, _id_lists(found), decoded], [*batch.schema.names, "ids", "decoded"])

    return documents.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the tokens of ``ids`` joined by one space; null ids are none."""
    encoded = tables.without(encoded, ("decoded",))
    schema = encoded.select("*", F.lit("").alias("decoded")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _coder(path).vocabulary.tokens
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids")).to_pylist()
            decoded = [" ".join([tokens[one] for one in ids or ()]) for ids in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.string())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)


def digests(documents: DataFrame, path: str) -> DataFrame:
    """``documents`` with the number of tokens and the digests of ids and of decoded text."""
    names = ("n_tokens", "ids_sha256", "decoded_sha256")
    documents = tables.without(documents, names)
    schema = documents.select("*", F.lit(0).cast("bigint").alias(names[0]), *(F.lit("").alias(one) for one in names[1:])).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for batch, found in _encoded(coder, batches):
            counts, ids, decoded = [], [], []
            for words in found:
                written, tokens, numbers = zip(*words) if words else ((), (), ())
                counts.append(sum(map(len, numbers)) // 4)
                ids.append(hashlib.sha256(" ".join(written).encode()).hexdigest())
                decoded.append(hashlib.sha256(" ".join(tokens).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                [*batch.schema.names, *names],
            )

    return documents.mapInArrow(run, schema)


def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts and digests of every document."""
    documents = tables.read(spark, folder, "documents").select("doc_id", "text")
    return digests(documents, vocabulary_path()).drop("text")
