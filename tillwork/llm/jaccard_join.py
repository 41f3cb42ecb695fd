"""N-gram Jaccard join: count-vector R-trees over blocks of documents that share a rare shingle.

A document is the set of 64-bit hashes of its distinct runs of five words (white-space words, A-Z lower-cased;
with fewer words, the whole sequence). Two documents link when ``100 * intersection >= 80 * union``.

1. Equal sets collapse to a class, represented by its smallest id; copies never travel more than
   once per task.
2. Blocks: linked sets must share one of the first ``n - ceil(0.8 n) + 1`` shingles of any common order. The
   order is by mixed hash, with a bounded list of frequent shingles last, so common passages rarely open a
   block. The list decides only where work is done, never a result. Two sets whose first common shingle this is share at most what
   follows it in either, so members whose place in the order leaves too little for any other member leave the block; a passage that is
   not enough of its documents brings none of them together. In a block, sizes that differ
   too much part it; the rest gets a leader, the smallest id, and every member meets that leader.
   Blocks with the same leader form one group: whoever shares a shingle also shares a group.
3. In a group: shingles are hashed into counters, the counters are points of an R-tree, and the sum of the
   coordinate-wise minima bounds the overlap from above. First only count vectors travel, and members whose
   bound with every other member is too low leave the group (groups beyond ``TREE`` members go on whole). Then
   the texts of the rest meet; pairs that survive the tree are verified on the sets, unless earlier links already
   join them. Groups beyond ``SHARD`` members are cut into shards that all hold the leader; members not joined to
   it are then asked against every shard in turn. So no task holds a whole large group, and no pair of it
   is left out. The ids that need texts are broadcast only while a count shows at most ``KEYS`` of them.
4. Spanning links are contracted to components.

Defined results: a null or text without words has an empty set, links with nothing and is its own component;
a null id gets a null component; repeated rows are one document, and an id with differing texts is one that links with whatever any
of them links with; texts of any length are read whole; components are named by their smallest id, so there are no ties; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm import arrays, components, tables
from tillwork.session import new_folder, scratch

SHINGLE = 5
SHARD = 1_000
TREE = 10_000
KEYS = 500_000
FREQUENT = 65_536
_LEAF = 16
_BLOCK_HASHES = 1_500_000


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Per row the sorted distinct shingle hashes."""
    for first, end, data, offsets in arrays.text_chunks(texts):
        data = arrays.LOWER[data]
        starts, ends, rows = arrays.words_of(data, offsets, arrays.NOT_SPACE)
        words = arrays.word_hashes(data, starts, ends)
        shingles = arrays.window_hashes(words, SHINGLE)
        bounds = arrays.row_ranges(rows, end - first).tolist()
        for a, b in zip(bounds, bounds[1:]):
            if b - a >= SHINGLE:
                yield np.unique(shingles[a : b - SHINGLE + 1])
            else:
                yield arrays.window_hashes(words[a:b], b - a) if b > a else shingles[:0]


def linked(first: np.ndarray, second: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity."""
    if 100 * min(len(first), len(second)) < 80 * max(len(first), len(second)):
        return False
    places = np.searchsorted(second, first)
    places[places == len(second)] = 0
    overlap = int(np.count_nonzero(second[places] == first))
    return 180 * overlap >= 80 * (len(first) + len(second))


# The tree.


def counters(size: int) -> int:
    """How many groups the shingles of a set of this size are hashed into: about eight shingles each."""
    return 1 << int(np.clip(np.ceil(np.log2(size / 8 + 1)), 4, 11))


def count_vector(one: np.ndarray) -> np.ndarray:
    groups = counters(len(one))
    return np.bincount((one & np.uint64(groups - 1)).astype(np.int64), minlength=groups).astype(np.uint32)


def folded(vector: np.ndarray, groups: int) -> np.ndarray:
    """The count vector over fewer groups."""
    return vector.reshape(-1, groups).sum(0)


def may_link(first: np.ndarray, first_size: int, second: np.ndarray, second_size: int) -> bool:
    """Whether the bound of two count vectors leaves the similarity possible."""
    if 100 * min(first_size, second_size) < 80 * max(first_size, second_size):
        return False
    groups = min(len(first), len(second))
    overlap = int(np.minimum(folded(first, groups), folded(second, groups)).sum())
    return 180 * overlap >= 80 * (first_size + second_size)


class CountTree:
    """An R-tree over count vectors of one length, packed by size and then by place along one direction.

    A node keeps the largest count per coordinate and the range of set sizes below it. Only upper corners
    are needed, since only upper bounds of overlaps are asked.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        order = np.argsort(sizes, kind="stable")
        slope = points @ np.cos(np.arange(points.shape[1]))
        slabs = np.arange(len(sizes)) // (_LEAF * _LEAF)
        order = order[np.lexsort((slope[order], slabs))]
        self.rows = order
        self.levels = [(points[order], sizes[order], sizes[order])]
        while len(self.levels[-1][0]) > _LEAF:
            upper, low, high = self.levels[-1]
            cuts = np.arange(0, len(upper), _LEAF)
            self.levels.append(
                (np.maximum.reduceat(upper, cuts), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts))
            )

    def near(self, point: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose overlap may suffice, and their bounds."""
        nodes = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            upper, low, high = self.levels[depth]
            nodes = nodes[(100 * high[nodes] >= 80 * size) & (80 * low[nodes] <= 100 * size)]
            bounds = np.minimum(upper[nodes], point).sum(1, dtype=np.int64)
            kept = 180 * bounds >= 80 * (size + low[nodes])
            nodes, bounds = nodes[kept], bounds[kept]
            if depth:
                nodes = (nodes[:, None] * _LEAF + np.arange(_LEAF)).ravel()
                nodes = nodes[nodes < len(self.levels[depth - 1][0])]
        return self.rows[nodes], bounds


class CountForest:
    """A tree per vector length. Sizes that can link differ by a quarter, so their lengths by a factor of two at most."""

    def __init__(self, vectors: list[np.ndarray], sizes: list[int]):
        self.vectors, self.sizes = vectors, np.array(sizes, np.int64)
        lengths = np.array([len(one) for one in vectors])
        self.trees = {}
        for groups in {int(one) for one in lengths} | {int(one) // 2 for one in lengths}:
            rows = np.flatnonzero((lengths == groups) | (lengths == 2 * groups))
            points = np.stack([folded(vectors[k], groups) for k in rows]).astype(np.uint32)
            self.trees[groups] = rows, CountTree(points, self.sizes[rows])

    def near(self, vector: np.ndarray, size: int) -> np.ndarray:
        """Rows that may link, the largest bound first."""
        found, bounds = [], []
        for groups in (len(vector), len(vector) // 2):
            if groups in self.trees:
                rows, tree = self.trees[groups]
                places, bound = tree.near(folded(vector, groups), size)
                found.append(rows[places])
                bounds.append(bound)
        if not found:
            return np.zeros(0, np.int64)
        found = np.concatenate(found)
        found = found[np.argsort(-np.concatenate(bounds), kind="stable")]
        return found[np.sort(np.unique(found, return_index=True)[1])]

    def partnered(self) -> np.ndarray:
        """Which rows may link with any other row; neighbours in the packing are tried before the tree is."""
        known = np.zeros(len(self.vectors), bool)
        for rows, tree in self.trees.values():
            order = rows[tree.rows]
            for first, second in zip(order[:-1].tolist(), order[1:].tolist()):
                if not (known[first] and known[second]) and self._may_link(first, second):
                    known[first] = known[second] = True
        for k in np.flatnonzero(~known).tolist():
            known[k] = (self.near(self.vectors[k], int(self.sizes[k])) != k).any()
        return known

    def _may_link(self, first: int, second: int) -> bool:
        return may_link(self.vectors[first], int(self.sizes[first]), self.vectors[second], int(self.sizes[second]))


def spanning_links(sets: list[np.ndarray]) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links that join every linked pair of ``sets``, and the component number of each set."""
    component = np.arange(len(sets))
    links: list[tuple[int, int]] = []
    if len(sets) == 2:
        if linked(sets[0], sets[1]):
            return [(0, 1)], np.zeros(2, np.int64)
        return links, component
    forest = CountForest([count_vector(one) for one in sets], [len(one) for one in sets])
    for k, one in enumerate(sets):
        if (component == component[0]).all():
            break
        found = forest.near(forest.vectors[k], len(one))
        while len(found := found[component[found] != component[k]]):
            other, found = int(found[0]), found[1:]
            if linked(one, sets[other]):
                links.append((k, other))
                component[component == component[other]] = component[k]
    return links, component


# The distributed steps.


def _sketch(keep_text: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per row: set size and a 128-bit digest of the set; with the text also the count vector."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, first, second, counts = [], [], [], []
            for one in shingle_sets(batch.column(1)):
                size.append(len(one))
                first.append(int(arrays.mix(one).sum(dtype=np.uint64)))
                second.append(int(np.bitwise_xor.reduce(arrays.mix(one + np.uint64(77)))) if len(one) else 0)
                if keep_text:
                    counts.append(_narrow(count_vector(one)) if len(one) else b"")
            columns = [batch.column(0), pa.array(size, pa.int64())]
            columns += [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (first, second)]
            names = ["doc_id", "n", "c1", "c2"]
            if keep_text:
                columns, names = [*columns, pa.array(counts, pa.binary()), batch.column(1)], [*names, "counts", "text"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return sketch


def _narrow(vector: np.ndarray) -> bytes:
    return vector.astype(np.uint16 if vector.max() < 1 << 16 else np.uint32).tobytes()


def _wide(raw: bytes, size: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint16 if len(raw) == 2 * counters(size) else np.uint32).astype(np.uint32)


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that several documents of one stretch of rows share, with their number there."""

    def counted(sets: list[np.ndarray]) -> pa.RecordBatch:
        found, counts = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        chosen = counts >= max(4, len(sets) // 500)
        return pa.RecordBatch.from_arrays(
            [pa.array(found[chosen].view(np.int64)), pa.array(counts[chosen].astype(np.int64))], ["shingle", "rows"]
        )

    sets: list[np.ndarray] = []
    held = 0
    for batch in batches:
        for one in shingle_sets(batch.column(1)):
            sets.append(one)
            held += len(one)
            if held > _BLOCK_HASHES:
                yield counted(sets)
                sets, held = [], 0
    yield counted(sets)


def _prefixes(frequent: np.ndarray, parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The first shingles of each set with the number of shingles from there on, packed per part of the hash space."""

    def packed(tokens: list[np.ndarray], ids: list[int], sizes: list[int]) -> pa.RecordBatch:
        token = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
        lengths = [len(one) for one in tokens]
        row, size = np.repeat(np.array(ids, np.int64), lengths), np.repeat(np.array(sizes, np.int32), lengths)
        places = [np.arange(one, dtype=np.int32) for one in lengths]
        left = size - (np.concatenate(places) if places else np.zeros(0, np.int32))
        part = (token % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        found, cuts = np.unique(part[order], return_index=True)
        ends = [*cuts[1:].tolist(), len(order)]
        pieces = [order[a:b] for a, b in zip(cuts.tolist(), ends)]
        return pa.RecordBatch.from_arrays(
            [pa.array(found.astype(np.int32))]
            + [pa.array([x[p].tobytes() for p in pieces], pa.binary()) for x in (token, row, size, left)],
            ["part", "tokens", "ids", "sizes", "lefts"],
        )

    def prefix(one: np.ndarray) -> np.ndarray:
        count = len(one) - -(-80 * len(one) // 100) + 1
        common = np.isin(one, frequent, assume_unique=True) if len(frequent) else np.zeros(len(one), bool)
        rare = np.sort(arrays.mix(one[~common]))[:count]
        return np.concatenate([rare, np.sort(arrays.mix(one[common]))[: count - len(rare)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens: list[np.ndarray] = []
        ids: list[int] = []
        sizes: list[int] = []
        held = 0
        for batch in batches:
            for doc_id, one in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1))):
                tokens.append(prefix(one))
                ids.append(doc_id)
                sizes.append(len(one))
                held += len(tokens[-1])
                if held > _BLOCK_HASHES // 2:
                    yield packed(tokens, ids, sizes)
                    tokens, ids, sizes, held = [], [], [], 0
        yield packed(tokens, ids, sizes)

    return run


def _partnered(token: np.ndarray, size: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Which rows of blocks, sorted by token and size, may link with another row of their block.

    If a block's shingle is the first that two sets share, they share at most what either has left from there on. So a row may link
    with sizes up to ``180 left / 80 - size`` only, and needs a row of such a size that may link with its own.
    """
    block = np.cumsum(np.concatenate(([True], token[1:] != token[:-1])).astype(np.int64)) - 1
    reach = 180 * left // 80 - size
    wide = int(max(size.max(), reach.max())) + 2
    ordered = block * wide + size
    last = np.searchsorted(ordered, block * wide + np.clip(reach, 0, wide - 1), "right") - 1
    # The two farthest reaches among the rows of the block up to each place.
    far = block * wide + np.maximum(reach, 0)
    first = np.maximum.accumulate(far)
    second = np.concatenate((far[:1] * 0 - 1, np.maximum.accumulate(np.minimum(far[1:], first[:-1]))))
    own = (far == first[last]) & (np.arange(len(far)) <= last)
    best = np.where(own, second[last], first[last])
    return (last >= 0) & (best >= ordered)


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(leader, member) for every block of one or more parts of the hash space."""
    held: dict[int, list[tuple[bytes, ...]]] = {}
    for batch in batches:
        for part, *arrived in zip(*(column.to_pylist() for column in batch.columns)):
            held.setdefault(part, []).append(tuple(arrived))
    for part in sorted(held):
        token, row, size, left = (
            np.concatenate([np.frombuffer(piece[k], kind) for piece in held[part]])
            for k, kind in enumerate((np.uint64, np.int64, np.int32, np.int32))
        )
        held[part] = []
        order = np.lexsort((size, token))
        token, row, size, left = token[order], row[order], size[order].astype(np.int64), left[order].astype(np.int64)
        for _ in range(2):  # whoever leaves may have been the only partner of another
            if len(token):
                kept = _partnered(token, size, left)
                token, row, size, left = token[kept], row[kept], size[kept], left[kept]
        begins = np.ones(len(token), bool)
        begins[1:] = (token[1:] != token[:-1]) | (100 * size[:-1] < 80 * size[1:])
        cuts = np.flatnonzero(begins)
        leader = np.repeat(np.minimum.reduceat(row, cuts), np.diff([*cuts, len(row)])) if len(row) else row
        pairs = np.stack([leader, row], 1)[leader != row]
        pairs = np.unique(pairs, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["leader", "member"])


def _pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each leader's group, the members that may link with another one, and then the leader as well."""

    def kept(leader: int, group: dict[int, tuple[int, bytes]]) -> list[tuple[int, int]]:
        ids = list(group)
        sizes = [group[one][0] for one in ids]
        vectors = [_wide(group[one][1], size) for one, size in zip(ids, sizes)]
        if len(ids) == 2:
            chosen = ids if may_link(vectors[0], sizes[0], vectors[1], sizes[1]) else []
        else:
            chosen = [one for one, partnered in zip(ids, CountForest(vectors, sizes).partnered()) if partnered]
        return [(leader, one) for one in ({*chosen, leader} if chosen else ())]

    key, group, rows = None, {}, []
    for name, batch, first, end in _grouped(batches, (0, 0)):
        if name != key:
            if key is not None:
                rows += kept(key[0], group)
            key, group = name, {}
        part = batch.slice(first, end - first)
        group.update(zip(part.column(1).to_pylist(), zip(part.column(2).to_pylist(), part.column(3).to_pylist())))
        if len(rows) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], ["leader", "member"])
            rows = []
    if key is not None:
        rows += kept(key[0], group)
    columns = list(zip(*rows)) if rows else [[], []]
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["leader", "member"])


_LINK_FIELDS = "a bigint, b bigint, leader bigint, shard int"


def _grouped(batches: Iterator[pa.RecordBatch], keys: tuple[int, int]) -> Iterator[tuple[tuple, pa.RecordBatch, int, int]]:
    """Stretches of rows with equal keys, batch by batch."""
    for batch in batches:
        names = list(zip(batch.column(keys[0]).to_pylist(), batch.column(keys[1]).to_pylist()))
        first = 0
        for k in range(1, len(names) + 1):
            if k == len(names) or names[k] != names[first]:
                yield names[first], batch, first, k
                first = k


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each (leader, shard) group; members not joined to the leader of a cut group come with a null ``b``."""

    def settled(key: tuple[int, int], group: dict[int, np.ndarray], cut: bool) -> Iterator[tuple]:
        ids = sorted(group, key=lambda one: (one != key[0], len(group[one]), one))
        if len(ids) < 2:
            return
        links, component = spanning_links([group[one] for one in ids])
        yield from ((ids[x], ids[y], *key) for x, y in links)
        if cut:
            yield from ((one, None, *key) for one, c in zip(ids, component) if c != component[0])

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], ["a", "b", "leader", "shard"])

    key, group, cut, rows = None, {}, False, []
    for name, batch, first, end in _grouped(batches, (0, 1)):
        if name != key:
            if key is not None:
                rows += settled(key, group, cut)
                if len(rows) > 10_000:
                    yield out(rows)
                    rows = []
            key, group, cut = name, {}, batch.column(2)[first].as_py() > 1
        members = batch.column(3).slice(first, end - first).to_pylist()
        group.update(zip(members, shingle_sets(batch.column(4).slice(first, end - first))))
    if key is not None:
        rows += settled(key, group, cut)
    yield out(rows)


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the members of a shard and the members asked against it, which follow them one by one.

    Members that an earlier question has joined are met once by the next, so the links found stay below
    the number of members and questions.
    """
    key, members, tree, order, component = None, {}, None, [], np.zeros(0, np.int64)
    for name, batch, first, end in _grouped(batches, (0, 1)):
        if name != key:
            key, members, tree = name, {}, None
        asked = batch.column(2).slice(first, end - first).to_pylist()
        ids = batch.column(3).slice(first, end - first).to_pylist()
        links = []
        for is_asked, one, shingles in zip(asked, ids, shingle_sets(batch.column(4).slice(first, end - first))):
            if not is_asked:
                members[one] = shingles
                continue
            if tree is None:
                if not members:
                    continue
                order, component = list(members), np.arange(len(members))
                tree = CountForest([count_vector(x) for x in members.values()], [len(x) for x in members.values()])
            found, joined = tree.near(count_vector(shingles), len(shingles)), -1
            while len(found):
                other, found = int(found[0]), found[1:]
                if order[other] != one and linked(shingles, members[order[other]]):
                    links.append((one, order[other]))
                    if joined < 0:
                        joined = component[other]
                    component[component == component[other]] = joined
                    found = found[component[found] != joined]
        columns = list(zip(*links)) if links else [[], []]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["a", "b"])


def classes(documents: DataFrame) -> DataFrame:
    """One row per distinct non-empty set: digest, smallest id, its text."""
    sketched = documents.mapInArrow(_sketch(True), "doc_id bigint, n bigint, c1 bigint, c2 bigint, counts binary, text string")
    return (
        sketched.where("n > 0 and doc_id is not null")
        .groupBy("c1", "c2")
        .agg(
            F.min("doc_id").alias("representative"),
            F.min("n").alias("n"),
            F.min("counts").alias("counts"),
            F.min_by("text", "doc_id").alias("text"),
        )
    )


def class_links(spark: SparkSession, distinct: DataFrame) -> DataFrame:
    """Spanning links between representatives; ``distinct`` is the result of ``classes``, already written."""
    parts = tables.shuffle_partitions(spark)
    texts = distinct.select("representative", "text")
    frequent = (
        texts.mapInArrow(_frequent, "shingle bigint, rows bigint")
        .groupBy("shingle")
        .agg(F.sum("rows").alias("rows"))
        .orderBy(F.desc("rows"), "shingle")
        .limit(FREQUENT)
        .collect()
    )
    common = np.sort(np.array([row["shingle"] for row in frequent], np.int64).view(np.uint64))
    met = (
        texts.mapInArrow(_prefixes(common, 8 * parts), "part int, tokens binary, ids binary, sizes binary, lefts binary")
        .repartition(parts, "part")
        .mapInArrow(_meetings, "leader bigint, member bigint")
        .distinct()
    )
    met = tables.cut(spark, met, "meetings")
    met = met.unionByName(met.select("leader", F.col("leader").alias("member")).distinct())
    counts = met.groupBy("leader").agg(F.count("*").alias("members"))
    sized = tables.join_one(met, tables.cut(spark, counts, "group-sizes"), "leader")
    vectors = distinct.select(F.col("representative").alias("member"), "n", "counts")
    near = (
        sized.where(F.col("members") <= TREE)
        .join(vectors, "member")
        .select("leader", "member", "n", "counts")
        .repartition(parts, "leader")
        .sortWithinPartitions("leader")
        .mapInArrow(_pruned, "leader bigint, member bigint")
    )
    near = tables.cut(spark, near.unionByName(sized.where(F.col("members") > TREE).select("leader", "member")), "near")
    sizes = near.groupBy("leader").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards"))
    members = (
        near.where("leader <> member")
        .join(sizes, "leader")
        .select("leader", F.pmod(F.xxhash64("member"), F.col("shards")).cast("int").alias("shard"), "shards", "member")
    )
    leaders = sizes.select(
        "leader", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "shards", F.col("leader").alias("member")
    )
    groups = members.unionByName(leaders)
    needed = near.select("member").distinct()
    if needed.count() <= KEYS:
        needed = F.broadcast(needed)
    named = texts.withColumnRenamed("representative", "member").join(needed, "member", "left_semi")
    found = (
        groups.join(named, "member")
        .select("leader", "shard", "shards", "member", "text")
        .repartition(parts, "leader", "shard")
        .sortWithinPartitions("leader", "shard")
        .mapInArrow(_verify, _LINK_FIELDS)
    )
    found = tables.cut(spark, found, "group-links")
    alone = found.where("b is null").select("leader", F.col("shard").alias("home"), F.col("a").alias("member"))
    asked = alone.join(sizes, "leader").select(
        "leader", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.lit(True).alias("asked"), "member"
    )
    present = members.where("shards > 1").join(alone.select("leader").distinct(), "leader", "left_semi")
    again = (
        present.select("leader", "shard", F.lit(False).alias("asked"), "member")
        .unionByName(asked)
        .join(named, "member")
        .select("leader", "shard", "asked", "member", "text")
        .repartition(parts, "leader", "shard")
        .sortWithinPartitions("leader", "shard", "asked")
        .mapInArrow(_ask, "a bigint, b bigint")
    )
    return found.where("b is not null").select("a", "b").unionByName(again)


def _several_texts(spark: SparkSession, documents: DataFrame) -> DataFrame | None:
    """Ids with differing texts: doc_id, digest of the text, and a name of its own for each; all but one lie above all ids."""
    repeated = documents.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1")
    digest = F.coalesce(F.sha2("text", 256), F.lit(""))
    texts = documents.join(repeated.select("doc_id"), "doc_id", "left_semi")
    texts = texts.select("doc_id", digest.alias("digest"), (~_has_word("text")).alias("empty")).distinct()
    several = texts.groupBy("doc_id").agg(F.min(F.struct("empty", "digest")).alias("first"), F.count("*").alias("texts")).where("texts > 1")
    several = tables.cut(spark, texts.join(several, "doc_id"), "several-texts")
    if several.isEmpty():
        return None
    above = documents.agg(F.max("doc_id")).first()[0] + 1
    name = F.when(F.col("digest") == F.col("first.digest"), F.col("doc_id")).otherwise(F.monotonically_increasing_id() + F.lit(above))
    return tables.cut(spark, several.select("doc_id", "digest", name.alias("name")), "names-of-texts")


def _has_word(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def _renamed(documents: DataFrame, several: DataFrame) -> DataFrame:
    """``documents`` with the name of its text as the id of each row."""
    digest = F.coalesce(F.sha2("text", 256), F.lit(""))
    joined = documents.withColumn("digest", digest).join(several, ["doc_id", "digest"], "left")
    return joined.select(F.coalesce("name", "doc_id").alias("doc_id"), "text")


def _classes_of_ids(documents: DataFrame, several: DataFrame, distinct: DataFrame) -> DataFrame:
    """doc_id and class of each of its texts, for ids with several."""
    chosen = documents.join(several.select(F.col("name").alias("doc_id")), "doc_id", "left_semi")
    rows = chosen.mapInArrow(_sketch(False), "doc_id bigint, n bigint, c1 bigint, c2 bigint").where("n > 0")
    rows = rows.join(distinct.select("c1", "c2", "representative"), ["c1", "c2"]).select(F.col("doc_id").alias("name"), "representative")
    return rows.join(several.select("name", "doc_id"), "name").select("doc_id", "representative").distinct()


def join(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Per row of ``documents(doc_id, text)``: set size and component."""
    tables.use_small_batches(spark)
    documents = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    several = _several_texts(spark, documents)
    named = documents if several is None else _renamed(documents, several)
    distinct = tables.cut(spark, classes(named), "shingle-classes")
    of_ids = None if several is None else tables.cut(spark, _classes_of_ids(named, several, distinct), "classes-of-ids")
    folder = new_folder(spark, "components")
    with scratch(spark):  # groups and links go when the components are written
        links = class_links(spark, distinct)
        if of_ids is not None:
            lowest = of_ids.groupBy("doc_id").agg(F.min("representative").alias("b"))
            links = links.unionByName(of_ids.join(lowest, "doc_id").select(F.col("representative").alias("a"), "b"))
        components.connected(spark, links).write.parquet(folder)
    found = spark.read.schema("vertex bigint, component bigint").parquet(folder)
    joined = distinct.join(found, F.col("representative") == F.col("vertex"), "left")
    joined = joined.select("c1", "c2", "representative", F.coalesce("component", "representative").alias("component"))
    rows = documents.mapInArrow(_sketch(False), "doc_id bigint, n bigint, c1 bigint, c2 bigint")
    rows = rows.join(joined.drop("representative"), ["c1", "c2"], "left")
    reached = F.when(F.col("n") > 0, F.col("component"))
    if several is not None:
        ids = of_ids.join(joined, "representative").groupBy("doc_id").agg(F.min("component").alias("id_component"))
        rows, reached = rows.join(ids, "doc_id", "left"), F.coalesce(F.col("id_component"), reached)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(reached, F.col("doc_id")))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Set size and component of every document."""
    return join(spark, tables.read(spark, folder, "documents"))
