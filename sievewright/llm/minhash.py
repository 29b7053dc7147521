"""MinHash near-dedup by a signature-coordinate inverted join.

Every text becomes the set of its distinct word shingles and a signature of
``coordinates`` minima. Texts with one and the same set form a class, of which one
stands in all that follows, so exact copies cost an aggregation however many there
are. Classes are posted under their (coordinate, value) pairs. Two classes that agree
in ``threshold`` coordinates at least must meet in one of their
``coordinates - threshold + 1`` rarest pairs (prefix merging); the frequent pairs, such
as those of a shared passage, are skipped and counted on the signatures only (skip
merging). Collisions at or above the threshold are candidates, and every link is
confirmed on the full sets.

A list of m near copies may have m*m/2 candidates, so they are not listed: a list gives a
spanning forest of its candidates, and the components of all forests are clusters that
no link leaves. Within a cluster, the full sets are compared exactly, all with all, as
products of incidence matrices, and again only a spanning forest of the links comes out.
Long lists and clusters are dealt in blocks, whose pairs are the tasks' groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm import textbytes as tb
from sievewright.llm.components import components
from sievewright.llm.staging import staged

COORDINATES = 64
#: A pair at a similarity of 0.85 agrees in 54.4 of 64 coordinates, with a standard deviation of 2.9.
THRESHOLD = 40
BLOCK = 256
_rng = np.random.default_rng(64)
_MULT = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SETS = "doc_id bigint, n_shingles bigint, key1 bigint, key2 bigint, signature array<int>"


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of a slice of texts and each text's first one; fewer words make one short shingle."""
    _, _, hashes, first = tb.words(data, offsets)
    count = np.diff(first)
    n = len(hashes)
    total = np.zeros(max(0, n - width + 1), np.uint64)
    for k in range(width):
        total += hashes[k : k + len(total)] * _PLACE[k]
    runs = np.maximum(count - width + 1, (count > 0).astype(count.dtype))
    starts = np.concatenate(([0], np.cumsum(runs)))
    out = np.empty(starts[-1], np.uint64)
    full = count >= width
    if full.any():
        at = np.repeat(first[:-1][full] - np.concatenate(([0], np.cumsum(runs[full])[:-1])), runs[full]) + np.arange(runs[full].sum())
        where = np.repeat(starts[:-1][full] - np.concatenate(([0], np.cumsum(runs[full])[:-1])), runs[full]) + np.arange(runs[full].sum())
        out[where] = tb.mix(total[at])
    for d in np.flatnonzero((count > 0) & ~full):
        h = hashes[first[d] : first[d + 1]]
        out[starts[d]] = tb.mix((h * _PLACE[: len(h)]).sum(keepdims=True) + np.uint64(len(h)) * _PLACE[63])[0]
    return out, starts


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64) if a.dtype == np.uint64 else a.view(np.int32)


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tb.buffers(batch.column("text"))
            n = batch.num_rows
            size, keys, sig = np.zeros(n, np.int64), np.zeros((n, 2), np.uint64), np.full((n, COORDINATES), np.uint32(0xFFFFFFFF), np.uint32)
            for i, j in tb.slices(offsets):
                h, starts = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
                if not len(h):
                    continue
                runs = np.diff(starts)
                owner = np.repeat(np.arange(j - i), runs)
                order = np.lexsort((h, owner)) if (runs > 1).any() else np.arange(len(h))
                h = h[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
                h, owner = h[new], owner[new]
                got, at = np.unique(owner, return_index=True)
                size[i + got] = np.diff(np.append(at, len(h)))
                for k in range(2):
                    keys[i + got, k] = np.add.reduceat(tb.mix(h * _PLACE[60 + k]), at)
                for k in range(COORDINATES):
                    sig[i + got, k] = np.minimum.reduceat(h * _MULT[k], at) >> np.uint64(32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size), pa.array(_signed(keys[:, 0].copy())), pa.array(_signed(keys[:, 1].copy())), tb.list_column(_signed(sig), pa.int32())],
                ["doc_id", "n_shingles", "key1", "key2", "signature"],
            )

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tb.buffers(batch.column("text"))
            parts = []
            for i, j in tb.slices(offsets):
                h, starts = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
                parts += [np.unique(h[a:b]).tobytes() for a, b in zip(starts[:-1], starts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), tb.binary_column(parts)], ["doc_id", "hashes"])

    return run


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows regrouped so that no group of ``keys`` is cut; holds one group over a batch at most."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < 2048:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        change = np.zeros(table.num_rows - 1, bool)
        for k in keys:
            v = table.column(k).to_numpy()
            change |= v[1:] != v[:-1]
        cuts = np.flatnonzero(change)
        if len(cuts):
            cut = int(cuts[-1]) + 1
            yield table.slice(0, cut).to_batches()[0]
            held = table.slice(cut).to_batches()
        else:
            held = table.to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _collide(threshold: int, limit: float):
    """A spanning forest of the candidate pairs of every list, from its smallest nodes on, so that lists of the same nodes give the same pairs."""

    def forest(sig: np.ndarray, size: np.ndarray, of: np.ndarray) -> Iterator[tuple[int, int]]:
        """Of a pair of blocks (``of``), only what links them: each block's own forest comes from the part that holds it alone."""
        both = of.min() != of.max()
        left, root = np.arange(len(size)), np.arange(len(size))
        while len(left):
            x, left = int(left[0]), left[1:]
            frontier = [x]
            while frontier and len(left):
                x = frontier.pop()
                same = of[left] == of[x]
                near = (sig[left] == sig[x]).sum(1) >= threshold
                near &= (np.minimum(size[left], size[x]) >= limit * np.maximum(size[left], size[x])) & same
                for y in left[near].tolist():
                    root[y] = root[x]
                    if not both:
                        yield x, y
                    frontier.append(y)
                left = left[~near]
        if not both:
            return
        others = np.flatnonzero(of == of.max())
        for x in np.flatnonzero(of == of.min()).tolist():
            apart = others[root[others] != root[x]]
            near = (sig[apart] == sig[x]).sum(1) >= threshold
            near &= np.minimum(size[apart], size[x]) >= limit * np.maximum(size[apart], size[x])
            for y in apart[near].tolist():
                if root[y] != root[x]:
                    yield x, y
                    root[root == root[y]] = root[x]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, ["token", "part"]):
            token, part, node, size, of = (batch.column(c).to_numpy() for c in ("token", "part", "node", "n_shingles", "mine"))
            sig = batch.column("signature").flatten().to_numpy().reshape(-1, COORDINATES)
            at = np.flatnonzero(np.append(True, (token[1:] != token[:-1]) | (part[1:] != part[:-1])))
            end = np.append(at[1:], len(token))
            two = at[end - at == 2]
            near = (sig[two] == sig[two + 1]).sum(1) >= threshold
            near &= np.minimum(size[two], size[two + 1]) >= limit * np.maximum(size[two], size[two + 1])
            out_a, out_b = [node[two[near]]], [node[two[near] + 1]]
            for s, e in zip(at[end - at > 2], end[end - at > 2]):
                got = list(forest(sig[s:e], size[s:e], of[s:e]))
                if got:
                    i, j = np.array(got).T
                    out_a.append(node[s:e][i])
                    out_b.append(node[s:e][j])
            a, b = np.concatenate(out_a), np.concatenate(out_b)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of the intersections of all pairs of sets, as products of incidence matrices a few thousand elements wide."""
    flat = np.concatenate(sets)
    _, element, often = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    number = np.cumsum(often > 1) - 1
    keep = (often > 1)[element]
    element, owner = number[element[keep]], owner[keep]
    order = np.argsort(element, kind="stable")
    element, owner = element[order], owner[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    step = 4096
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, step):
        s, e = np.searchsorted(element, (low, low + step))
        block = np.zeros((len(sets), step), np.float32)
        block[owner[s:e], element[s:e] - low] = 1
        out += block @ block.T
    return np.rint(out).astype(np.int64)


def _confirm(percent: int):
    """A spanning forest of the links of every group of full sets."""

    def links(node: np.ndarray, sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        size = np.array([len(s) for s in sets])
        both = shared_counts(sets)
        linked = 100 * both >= percent * (size[:, None] + size[None, :] - both)
        left, frontier = np.arange(1, len(size)), [0]
        while len(left):
            if not frontier:
                frontier, left = [int(left[0])], left[1:]
            x = frontier.pop()
            near = linked[x, left]
            for y in left[near].tolist():
                yield node[x], node[y]
                frontier.append(y)
            left = left[~near]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, ["cluster", "part"]):
            cluster, part, node = (batch.column(c).to_numpy() for c in ("cluster", "part", "node"))
            data, offsets = tb.buffers(batch.column("hashes"))
            at = np.flatnonzero(np.append(True, (cluster[1:] != cluster[:-1]) | (part[1:] != part[:-1])))
            out = []
            for s, e in zip(at, np.append(at[1:], len(node))):
                sets = [np.frombuffer(data[offsets[k] : offsets[k + 1]].tobytes(), np.uint64) for k in range(s, e)]
                out += links(node[s:e], sets)
            pairs = np.array(out, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

    return run


def _dealt(members: DataFrame, group: str, block: int) -> DataFrame:
    """``members`` (group, node) with ``part``: one for each pair of blocks of the group that the node is in; groups of one drop out."""
    sizes = members.groupBy(group).agg(F.count("*").alias("m")).where("m > 1").select(group, F.ceil(F.col("m") / block).cast("int").alias("blocks"))
    parts = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.least(F.col("mine"), other).cast("long") * F.col("blocks") + F.greatest(F.col("mine"), other),
    )
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return members.join(sizes, group).withColumn("mine", mine).select(group, "node", "mine", F.explode(parts).alias("part"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 85, threshold: int = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Rows with fewer than ``width`` words have the whole sequence as their one shingle;
    rows with null, empty or blank text have none and are linked with nothing. Rows
    with one doc_id count as one document. Other columns are ignored; an empty table
    gives an empty result. kept marks the smallest doc_id of each component.
    """
    docs = docs.select("doc_id", "text")
    sets = staged(docs.mapInArrow(_signatures(width), SETS), "sets")
    classes = sets.where("n_shingles > 0").groupBy("key1", "key2").agg(F.min("doc_id").alias("node"))
    standing = staged(sets.where("n_shingles > 0").join(classes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"]), "standing")
    coordinates = F.transform("signature", lambda v, k: v.cast("long") * COORDINATES + k)
    tokens = standing.select(F.col("doc_id").alias("node"), F.explode(coordinates).alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    # A class with c shared pairs has COORDINATES - c pairs of its own, the rarest of all; the prefix takes the rest of its length from the shared ones.
    prefix = F.slice(F.array_sort("pairs"), 1, F.size("pairs") - (threshold - 1))
    prefixes = staged(
        tokens.join(shared, "token").groupBy("node").agg(F.collect_list(F.struct("df", "token")).alias("pairs"))
        .where(F.size("pairs") >= threshold).select("node", F.explode(prefix).alias("p")).select("node", "p.token"),
        "prefixes",
    )
    lists = (
        _dealt(prefixes, "token", block).join(standing.select(F.col("doc_id").alias("node"), "n_shingles", "signature"), "node")
        .repartition("token", "part").sortWithinPartitions("token", "part", "node").select("token", "part", "node", "mine", "n_shingles", "signature")
    )
    clusters = components(lists.mapInArrow(_collide(threshold, percent / 100), "a bigint, b bigint").distinct())
    heads = clusters.select(F.col("component").alias("node"), F.col("component").alias("cluster")).distinct()
    clusters = staged(clusters.select("node", F.col("component").alias("cluster")).unionAll(heads), "clusters")
    inside = docs.join(clusters.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    full = inside.mapInArrow(_full_sets(width), "doc_id bigint, hashes binary").withColumnRenamed("doc_id", "node")
    groups = _dealt(clusters, "cluster", block).join(full, "node").repartition("cluster", "part").sortWithinPartitions("cluster", "part", "node")
    links = groups.select("cluster", "part", "node", "hashes").mapInArrow(_confirm(percent), "a bigint, b bigint")
    roots = components(links)
    ids = classes.join(roots, "node", "left").select("key1", "key2", F.coalesce("component", "node").alias("component_id"))
    return (
        sets.join(ids, ["key1", "key2"], "left")
        .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )
