"""Near-duplicate documents by an LSH forest over MinHash signatures, every link confirmed on full shingle sets.

1. Each document gets its set of distinct word shingles, as 64-bit hashes, a 128-bit fingerprint of the set and a signature
   of SIGNATURE minima. Documents with one set are a class; the one with the smallest id stands for it from here on.
2. TREES sorted orders: a class's label in a tree is LAST_DEPTH of its minima, from a place of the signature that differs
   from tree to tree, and each tree sorts all classes by their labels. Classes whose labels begin with the same minima are
   next to each other there; they are a region. Its depth is chosen by its size: SHALLOW minima in common if at most SMALL
   classes have these, else DEPTH, and where more than SMALL have those too, as many as step 4 needs.
3. In an order, range-partitioned by prefixes of the regions' depths, every class is compared with the neighbours whose
   longest common prefix with it is at least the depth of its region. Pairs whose signatures agree in at least
   LEAST_AGREEMENT of the positions and whose sizes allow the similarity are candidates; those of all trees are joined with
   the full sets and confirmed.
4. A region with more than SMALL classes is confirmed as a block in one task: each member against all others on full sets, and only links that
   join two groups of the block are returned. If a block is too large for a task (BLOCK_MEMBERS, BLOCK_COST), it goes
   deeper along its order, region by region, until it fits; what still does not fit at the last depth is dealt out by a
   hash. The parts of such a region are tied together by pivots, the members nearest to its consensus signature: every
   member of the region is compared with all of its pivots.
5. Components of the confirmed links: in each round every node points to its neighbour that is first in a hashed order,
   and the graph is replaced by its image, until no link is left.
6. Regions cut in 4 are then compared in full: the members outside the region's largest component are dealt into parts, all
   its members too, and each part of the ones meets each part of the others in a tile that fits a task. A tile compares on
   full sets all its pairs that are not connected yet and have no region of an earlier tree in common; its links complete 5.

A pair of similarity 0.8 is in one region of at least one tree with probability 1 - (1 - 0.8^3)^20 > 0.999999; in a tree
where its region is shallow, with probability 0.8^2 instead of 0.8^3.

Rows with one doc_id are one document: they are in one component. A null doc_id is compared with nothing: its component is
null and it is kept. Without words (null or empty text) a document is a component of its own. An empty table gives an empty
result. Other columns are not read; the stage keeps them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerloom.llm import text as tx
from ledgerloom.llm.store import durable

SIGNATURE, TREES, SHALLOW, DEPTH, LAST_DEPTH = 128, 20, 2, 3, 19
SMALL, BLOCK_MEMBERS, BLOCK_COST, PIVOTS = 64, 4096, 4_000_000_000, 8
#: Five standard deviations of the agreement of two signatures below a similarity of 0.8.
LEAST_AGREEMENT = 0.62
_seeds = np.random.default_rng(77)
_TIMES = (_seeds.integers(0, 2**32, SIGNATURE, dtype=np.uint32) | np.uint32(1))[None, :]
_PLUS = _seeds.integers(0, 2**32, SIGNATURE, dtype=np.uint32)[None, :]
#: The positions of each tree's label, which is a stretch of the signature: the first DEPTH differ from tree to tree.
_ORDERS = np.arange(TREES)[:, None] * DEPTH + np.arange(LAST_DEPTH)[None, :]
_SHORT, _OTHER, _STEP = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


def shingles(column: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text with fewer words has one shingle of all of them."""
    w = tx.words(column, lower=True)
    h = tx.hashes(w)
    rolled = h[: max(0, len(h) - size + 1)].copy()
    for j in range(1, size):
        rolled = tx.mix(rolled * _STEP + h[j : j + len(rolled)])
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            x = _SHORT * np.uint64(b - a)
            for v in h[a:b]:
                x = tx.mix(x * _STEP + v)
            out.append(np.array([x], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(s: np.ndarray) -> np.ndarray:
    out, low = np.full(SIGNATURE, 2**32 - 1, np.uint32), (s >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(low), 256):
        x = low[at : at + 256, None] * _TIMES + _PLUS
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x ^= x >> np.uint32(13)
        np.minimum(out, x.min(axis=0), out=out)
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    data, _ = tx.text_bytes(column)
    return data.view(np.uint32).reshape(-1, SIGNATURE)


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, f1, f2, sig) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.kept(("shingles",), lambda: None)  # what the worker kept for another operator goes
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in tx.slices(batch, "text"):
                    sets = shingles(part.column("text"), size)
                    f1 = np.array([tx.mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                    f2 = np.array([tx.mix(s ^ _OTHER).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                    sigs = [signature(s).tobytes() if len(s) else None for s in sets]
                    columns = [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(f1), pa.array(f2), pa.array(sigs, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "f1", "f2", "sig"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    return durable(rows.mapInArrow(run, "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, sig binary"))


def _prefixes(sig: np.ndarray, tree: np.ndarray, depth: int) -> np.ndarray:
    """A hash of the first ``depth`` minima of each row in its tree."""
    x = tx.mix(tree.astype(np.uint64) + np.uint64(1))
    rows = np.arange(len(sig))
    for j in range(depth):
        x = tx.mix(x * _STEP + sig[rows, _ORDERS[tree, j]].astype(np.uint64))
    return x.view(np.int64)


def regions(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The regions that have more than one class, as (region, tree, id, depth) of those with at most SMALL classes and
    (region, tree, id) of the others, which have DEPTH minima in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig, ids = _matrix(batch.column("sig")), batch.column("id")
            for number in range(TREES):
                tree = np.full(len(sig), number, np.int32)
                columns = [pa.array(_prefixes(sig, tree, SHALLOW)), pa.array(_prefixes(sig, tree, DEPTH)), pa.array(tree), ids]
                yield pa.RecordBatch.from_arrays(columns, ["shallow", "deep", "tree", "id"])

    rows = classes.select("id", "sig").mapInArrow(run, "shallow bigint, deep bigint, tree int, id bigint")
    some = rows.groupBy("shallow").agg(F.count("*").alias("n")).filter("n > 1")
    rows = durable(rows.join(some, "shallow"))
    crowded = rows.filter(F.col("n") > SMALL).select("deep", "tree", "id")
    many = crowded.groupBy("deep").agg(F.count("*").alias("n")).filter("n > 1")
    crowded = durable(crowded.join(many, "deep").withColumnRenamed("deep", "region"))
    few = crowded.filter(F.col("n") <= SMALL).select("region", "tree", "id", F.lit(DEPTH).alias("depth"))
    shallow = rows.filter(F.col("n") <= SMALL).select(F.col("shallow").alias("region"), "tree", "id", F.lit(SHALLOW).alias("depth"))
    return shallow.unionByName(few), crowded.filter(F.col("n") > SMALL).select("region", "tree", "id")


def _label(minima: str) -> Column:
    """The first ``minima`` of a row's label in its tree, as bytes; their order is that of the tree."""
    return F.expr(f"substring(sig, {4 * DEPTH} * tree + 1, 4 * {minima})")


def _by_region(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one region after another, from rows sorted by region; several whole regions at a time."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        region = table.column("region").to_numpy()
        cut = int(np.flatnonzero(region != region[-1])[-1]) + 1 if len(region) and region[0] != region[-1] else 0
        if cut:
            yield table.slice(0, cut).combine_chunks()
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def common_prefix(sig: np.ndarray, tree: np.ndarray) -> np.ndarray:
    """How many minima the labels of each row and the next one have in common from the start; 0 in different trees."""
    places = _ORDERS[tree[:-1]]
    rows = np.arange(len(places))[:, None]
    same = (sig[rows, places] == sig[rows + 1, places]) & (tree[1:] == tree[:-1])[:, None]
    return np.where(same.all(axis=1), LAST_DEPTH, same.argmin(axis=1))


def neighbour_pairs(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct candidate pairs (a, b), a < b, of the regions with at most SMALL members, from the sorted orders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_region(batches):
            tree, depth, ids, n = (table.column(c).to_numpy() for c in ("tree", "depth", "id", "n_shingles"))
            sig = _matrix(table.column("sig").combine_chunks() if table.column("sig").num_chunks != 1 else table.column("sig").chunk(0))
            next_one = common_prefix(sig, tree)
            common, found = next_one, [np.zeros((0, 2), np.int64)]
            # the prefix that a row has in common with the one 1, 2, ... places on is the least one between them
            for step in range(1, len(ids)):
                i = np.flatnonzero(common >= depth[:-step])
                if not len(i):
                    break
                j = i + step
                near = (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & (ids[i] != ids[j])
                i, j = i[near], j[near]
                for at in range(0, len(i), 20_000):
                    p, q = i[at : at + 20_000], j[at : at + 20_000]
                    ok = (sig[p] == sig[q]).mean(axis=1) >= LEAST_AGREEMENT
                    found.append(np.stack([np.minimum(ids[p[ok]], ids[q[ok]]), np.maximum(ids[p[ok]], ids[q[ok]])], 1))
                common = np.minimum(common[:-1], next_one[step:])
            pairs = np.unique(np.concatenate(found), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    rows = members.join(classes.select("id", "n_shingles", "sig"), "id")
    # a region has one prefix of its depth, so it is in one range whole; ranges and rows follow each tree's order
    ordered = rows.repartitionByRange("tree", _label("depth")).sortWithinPartitions("tree", _label(str(LAST_DEPTH)))
    return ordered.select("region", "tree", "depth", "id", "n_shingles", "sig").mapInArrow(run, "a bigint, b bigint").distinct()


def blocks(large: DataFrame, classes: DataFrame, most: int, cost: int) -> tuple[DataFrame, DataFrame | None]:
    """(block, region, id) of the classes in large regions; and those of them whose region is in several blocks."""

    def keyed(depth: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                key = _prefixes(_matrix(batch.column("sig")), batch.column("tree").to_numpy(), depth)
                names = ["region", "tree", "id", "n_shingles", "sig"]
                yield pa.RecordBatch.from_arrays([pa.array(key), *(batch.column(c) for c in names)], ["block", *names])

        return run

    left = durable(large.join(classes.select("id", "n_shingles", "sig"), "id"))
    done, split = None, None
    for depth in (DEPTH, DEPTH + 2, DEPTH + 5, DEPTH + 9, LAST_DEPTH):
        rows = left.select("region", "tree", "id", "n_shingles", "sig").mapInArrow(keyed(depth), f"block bigint, {_LARGE}")
        sizes = rows.groupBy("block").agg(F.count("*").alias("_n"), F.sum("n_shingles").alias("_s"))
        parts = F.greatest(F.ceil(F.col("_n") / most), F.ceil(F.sqrt(F.col("_n") * F.col("_s") / F.lit(float(cost))))).cast("int")
        rows = durable(rows.join(sizes.withColumn("_parts", parts).drop("_n", "_s"), "block"))
        if depth == LAST_DEPTH:
            rows = rows.withColumn("block", F.xxhash64("block", F.pmod(F.xxhash64("id"), F.col("_parts"))))
            settled, left = rows, rows.limit(0)
        else:
            settled, left = rows.filter("_parts = 1"), rows.filter("_parts > 1")
        settled = settled.select("block", "region", "id", "sig")
        done = settled if done is None else done.unionByName(settled)
        if split is None:
            split = left.select("region").distinct()
        if left.isEmpty():
            break
    if depth == DEPTH:
        return done, None
    return done, done.join(durable(split), "region", "left_semi")


_LARGE = "region bigint, tree int, id bigint, n_shingles bigint, sig binary"


def pivot_pairs(parted: DataFrame) -> DataFrame:
    """Candidate pairs of every member of a region in several blocks with the region's pivots."""

    def consensus(block: pa.Table) -> pa.Table:
        sig = _matrix(block.column("sig").combine_chunks() if block.column("sig").num_chunks != 1 else block.column("sig").chunk(0))
        mode = np.array([v[c.argmax()] for v, c in (np.unique(sig[:, j], return_counts=True) for j in range(SIGNATURE))], np.uint32)
        agree = (sig == mode).mean(axis=1)
        best = np.argsort(-agree, kind="stable")[:2]
        out = block.take(pa.array(best)).select(["region", "id", "sig"])
        return out.append_column("agree", pa.array(agree[best]))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("id").to_numpy(), batch.column("pivot").to_numpy()
            ok = ((_matrix(batch.column("sig")) == _matrix(batch.column("pivot_sig"))).mean(axis=1) >= LEAST_AGREEMENT) & (a != b)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[ok]), pa.array(np.maximum(a, b)[ok])], ["a", "b"])

    found = parted.groupBy("block").applyInArrow(consensus, "region bigint, id bigint, sig binary, agree double")
    rank = F.row_number().over(W.partitionBy("region").orderBy(F.col("agree").desc(), "id"))
    pivots = durable(found.withColumn("nth", rank).filter(F.col("nth") <= PIVOTS).select("region", F.col("id").alias("pivot"), F.col("sig").alias("pivot_sig")))
    return parted.join(pivots, "region").select("id", "sig", "pivot", "pivot_sig").mapInArrow(near, "a bigint, b bigint").distinct()


def _sets_of(block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The members of all sets of a block, numbered, and where each set begins."""
    column = block.column("shingles").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    values = np.unique(column.values.to_numpy()[column.offsets[0].as_py() : column.offsets[-1].as_py()], return_inverse=True)[1]
    return values, column.offsets.to_numpy() - column.offsets[0].as_py()


def block_links(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join the members of each block into their groups, from all pairs of the block on full sets."""

    def confirm(block: pa.Table) -> pa.Table:
        ids = block.column("id").to_numpy()
        values, at = _sets_of(block)
        size, group, mark = np.diff(at), np.arange(len(ids)), np.zeros(len(values) + 1, np.int32)
        links = []
        for i in range(len(ids)):
            mine = values[at[i] : at[i + 1]]
            mark[mine] = 1
            both = np.add.reduceat(mark[values], at[:-1])
            mark[mine] = 0
            linked = np.flatnonzero(100 * both >= percent * (size + size[i] - both))
            other, first = np.unique(group[linked], return_index=True)
            for g, j in zip(other.tolist(), linked[first].tolist()):
                if g != group[i]:
                    links.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                    group[group == g] = group[i]
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return placed.select("block", "id").join(sets, "id").groupBy("block").applyInArrow(confirm, "a bigint, b bigint")


def tiles(parted: DataFrame, classes: DataFrame, groups: DataFrame, most: int, cost: int) -> DataFrame:
    """(region, i, j, late, id, label, sig): the regions in several blocks as tiles of late members and of all members.

    Late is who is not in the region's largest component. A side of a tile has about most / 2 members, and cost / most
    elements, or one member."""
    label = F.coalesce("component", "id").alias("label")
    rows = parted.select("region", "id", "sig").join(classes.select("id", "n_shingles"), "id").join(groups, "id", "left")
    rows = durable(rows.select("region", "id", "sig", "n_shingles", label))
    sizes = rows.groupBy("region", "label").agg(F.count("*").alias("_n"), F.sum("n_shingles").alias("_s"))
    first = F.max(F.struct("_n", "label", "_s")).alias("first")
    sizes = sizes.groupBy("region").agg(first, F.sum("_n").alias("_n"), F.sum("_s").alias("_s")).filter(F.col("_n") > F.col("first._n"))

    def parts(n, s):
        return F.greatest(F.ceil(n / max(1, most // 2)), F.ceil(s * most / F.lit(float(cost))), F.lit(1)).cast("int")

    ours, others = parts(F.col("_n") - F.col("first._n"), F.col("_s") - F.col("first._s")), parts(F.col("_n"), F.col("_s"))
    rows = rows.join(sizes.select("region", F.col("first.label").alias("_first"), ours.alias("_i"), others.alias("_j")), "region")
    part = F.xxhash64("id", F.lit("tile"))
    columns = ["region", "i", "j", "late", "id", "label", "sig"]
    late = rows.filter("label <> _first").withColumns({"late": F.lit(True), "i": F.pmod(part, "_i").cast("int"), "j": F.explode(F.sequence(F.lit(0), F.col("_j") - 1))})
    every = rows.withColumns({"late": F.lit(False), "j": F.pmod(part, "_j").cast("int"), "i": F.explode(F.sequence(F.lit(0), F.col("_i") - 1))})
    return late.select(columns).unionByName(every.select(columns))


def tile_links(tiled: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join late members of each tile with members of other groups, from all such pairs on full sets."""

    def confirm(tile: pa.Table) -> pa.Table:
        ids, late, links = tile.column("id").to_numpy(), tile.column("late").to_numpy(), []
        sig = _matrix(tile.column("sig").combine_chunks() if tile.column("sig").num_chunks != 1 else tile.column("sig").chunk(0))
        keys = np.stack([_prefixes(sig, np.full(len(sig), tree), DEPTH) for tree in range(TREES)])
        tree = int(np.flatnonzero(keys[:, 0] == tile.column("region")[0].as_py())[0])
        values, at = _sets_of(tile)
        group, size, mark = np.unique(tile.column("label").to_numpy(), return_inverse=True)[1], np.diff(at), np.zeros(len(values) + 1, np.int32)
        every = np.flatnonzero(~late)
        for i in np.flatnonzero(late).tolist():
            fits = (group[every] != group[i]) & (100 * np.minimum(size[every], size[i]) >= percent * np.maximum(size[every], size[i]))
            other = every[fits]
            for k in range(tree):
                other = other[keys[k, other] != keys[k, i]]  # compared in that tree
            if not len(other):
                continue
            mine = values[at[i] : at[i + 1]]
            mark[mine] = 1
            ends = np.cumsum(size[other])
            both = np.add.reduceat(mark[values[np.repeat(at[other] - (ends - size[other]), size[other]) + np.arange(ends[-1])]], ends - size[other])
            mark[mine] = 0
            linked = other[100 * both >= percent * (size[other] + size[i] - both)]
            found, first = np.unique(group[linked], return_index=True)
            for g, j in zip(found.tolist(), linked[first].tolist()):
                links.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                group[group == g] = group[i]
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return tiled.join(sets, "id").groupBy("region", "i", "j").applyInArrow(confirm, "a bigint, b bigint")


def full_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(id, shingles) of the documents named by ``ids``, from their whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tx.kept(("shingles",), lambda: None)  # what the worker kept for another operator goes
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in tx.slices(batch, "text"):
                    sets = shingles(part.column("text"), size)
                    at = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                    flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                    yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], ["id", "shingles"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text")).join(ids, "id", "left_semi")
    return durable(rows.mapInArrow(run, "id bigint, shingles array<bigint>"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar."""
    one, two = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(one, "a").join(two, "b").filter(100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over links (a, b), for every id in a link."""
    edges = durable(links.filter("a <> b").distinct())
    place = durable(edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct().withColumn("at", F.col("id")))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        first = F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("v"))).alias("f")
        own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("v"))
        step = durable(both.groupBy("a").agg(first).select(F.col("a").alias("u"), F.least(own, F.col("f")).getField("v").alias("p")))
        image = edges.join(step, edges.a == step.u).select(F.col("p").alias("a"), "b").join(step, F.col("b") == step.u).select("a", F.col("p").alias("b"))
        edges = durable(image.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        place = durable(place.join(step, place.at == step.u, "left").select("id", F.coalesce("p", "at").alias("at")))
    least = place.groupBy("at").agg(F.min("id").alias("component"))
    return place.join(least, "at").select("id", "component")


def near_duplicates(docs: DataFrame, size: int = 4, percent: int = 80, most: int = BLOCK_MEMBERS, cost: int = BLOCK_COST) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    Links are documents with 100 * intersection >= percent * union of their sets of ``size``-word shingles. ``percent``
    below 80 needs a smaller LEAST_AGREEMENT and more trees."""
    rows = sketched(docs, size)
    known = rows.filter("n_shingles > 0 and doc_id is not null")
    classes = durable(
        known.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies"), F.min("sig").alias("sig"))
    )
    members, large = regions(classes)
    pairs = neighbour_pairs(members, classes, percent)
    placed, parted = blocks(large, classes, most, cost)
    if parted is not None:
        pairs = pairs.unionByName(pivot_pairs(parted)).distinct()
    pairs = durable(pairs)
    needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(placed.select("id"))
    sets = full_sets(docs, durable(needed.distinct()), size)
    links = confirmed(pairs, sets, percent).union(block_links(placed, sets, percent))
    if parted is not None:
        links = durable(links)
        more = durable(tile_links(tiles(parted, classes, components(links), most, cost), sets, percent))
        links = links.union(more)
    groups = components(links)
    # only classes with copies or links differ from their documents
    found = classes.join(groups, "id", "left").filter("copies > 1 or component is not null")
    found = durable(found.select("f1", "f2", F.coalesce("component", "id").alias("component")))
    joined = rows.drop("sig").join(found, ["f1", "f2"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("bigint")).otherwise(F.coalesce("component", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that repeat one with a smaller id; columns stay as they are."""
    drop = durable(near_duplicates(docs, size, percent).filter("not kept").select(F.col("doc_id").alias("_drop")).distinct())
    return docs.join(drop, docs["doc_id"] == drop["_drop"], "left_anti")


def op5_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: All pairs with a shingle in common, counted in full.
NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN []::VARCHAR[] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS parts FROM w
), u AS (
  SELECT doc_id, len(parts) AS n, unnest(parts) AS part FROM s
), e AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM u a JOIN u b ON a.part = b.part AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), r AS (
  SELECT doc_id AS id, doc_id AS seen FROM s UNION SELECT r.id, e.y FROM r JOIN e ON r.seen = e.x
)
SELECT s.doc_id, len(parts)::BIGINT AS n_shingles, min(seen) AS component_id, s.doc_id = min(seen) AS kept FROM s JOIN r ON s.doc_id = r.id GROUP BY s.doc_id, parts
"""

QUERIES = {"op5_near_duplicates": op5_near_duplicates}
ORACLE_SQL = {"op5_near_duplicates": NEAR_SQL}
