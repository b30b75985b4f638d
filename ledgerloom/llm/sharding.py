"""Shards chosen in a weighted hash tree: regions hold racks, racks hold shards.

A document descends from the root. At each level every child draws a hash of (child, doc_id); the draw counts as the first
arrival of a process of the child's weight (-ln(u) / weight), and the child that arrives first is taken. A draw depends on
its own child alone, so a change of weights moves documents only from or to the subtrees whose weights change.

Weight is kept by generation. The first layout is generation 0, and each later addition is one more. The children of the
root are (generation, region) pairs, and below the root only what its generation added takes part. So a shard that is added
to a rack, new or old, takes documents for itself and none of its neighbours gets any: a document that the new weight wins
at the root has nowhere else to go. Shrinking or removing a shard moves documents out of its subtree only. The root meets
one more child per addition; a new first layout folds them, at the cost of a larger move.

``standard(n)`` is the tree of n equal shards: BASE of them in the first layout, RACK_SHARDS to a rack and REGION_RACKS racks
to a region, each further one an addition of its own. Shard count and id of a document decide its shard (law ``key``).

Slots number the documents of a shard from 0 without gaps, in the order of id, checksum and size; equal rows follow each
other in any order. They come from a range partitioning of narrow rows over (shard, ..., place of the row), so neither a
large shard nor many equal rows land in one task.

A null id is hashed as the empty text and comes first in its shard. A null text has no bytes and the checksum of the empty
text. Rows with one id are in one shard, each with a slot of its own. An empty table gives an empty result. Only the id and
the text are read; ``write_shards`` keeps all columns, whatever their names."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.sqltext import CRC_TABLE_SQL, crc32_sql
from ledgerloom.llm.store import durable
from ledgerloom.operators.numbering import global_row_number

BASE, RACK_SHARDS, REGION_RACKS = 40, 4, 5
#: What a document counts besides its bytes.
OVERHEAD = 16
_BITS = 52


@dataclass(frozen=True)
class Leaf:
    """Weight that a shard got in one generation."""

    region: int
    rack: int
    shard: int
    weight: float = 1.0
    generation: int = 0


def standard(shards: int, base: int = BASE) -> list[Leaf]:
    """The tree of ``shards`` equal shards; those after the first ``base`` are additions."""
    return [Leaf(i // (RACK_SHARDS * REGION_RACKS), i // RACK_SHARDS, i, 1.0, max(0, i - base + 1)) for i in range(shards)]


def _levels(tree: Sequence[Leaf]) -> list[list[list[tuple[str, float, int]]]]:
    """Per level the children (name, weight, place in the next level) of each node; the root is the one node of the first."""
    leaves = [x for x in tree if x.weight > 0]
    if not leaves:
        raise ValueError("a tree needs a shard with a weight")
    paths = [(x.generation, x.region, x.rack, x.shard) for x in leaves]
    if len(set(paths)) < len(paths):
        raise ValueError("a shard occurs twice in a generation")
    levels, nodes = [], [()]
    for depth in (2, 3, 4):
        below = sorted({p[:depth] for p in paths})
        weight = {n: sum(x.weight for x, p in zip(leaves, paths) if p[:depth] == n) for n in below}
        levels.append([[(":".join(map(str, n)), weight[n], i) for i, n in enumerate(below) if n[: len(node)] == node] for node in nodes])
        nodes = below
    return levels


def _first(children: Column, key: Column) -> Column:
    """Place of the child whose draw for the key arrives first; the earlier of equal draws."""

    def draw(c: Column) -> Column:
        digits = F.substring(F.md5(F.concat(c["name"], F.lit("|"), key).cast("binary")), 1, _BITS // 4)
        u = (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << _BITS))
        return F.struct((-F.log(u) / c["weight"]).alias("draw"), c["place"].alias("place"))

    return F.array_min(F.transform(children, draw))["place"]


def _literal(children: list[tuple[str, float, int]]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight"), F.lit(i).alias("place")) for n, w, i in children])


def shard_of(key: Column, tree: Sequence[Leaf]) -> Column:
    """The shard of a key (as text; null: empty)."""
    key = F.coalesce(key.cast("string"), F.lit(""))
    place = F.lit(0)
    for level in _levels(tree):
        place = _first(F.get(F.array(*[_literal(node) for node in level]), place), key)
    shards = [p[3] for p in sorted((x.generation, x.region, x.rack, x.shard) for x in tree if x.weight > 0)]
    return F.get(F.array(*map(F.lit, shards)), place)


def assigned(docs: DataFrame, tree: Sequence[Leaf], grown: Sequence[Leaf] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot[, grown_shard]) of every row; ``grown`` is a later tree to compare with."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    key = F.col(doc_id)
    rows = docs.select(
        key.alias("doc_id"), (F.octet_length(body) + F.lit(OVERHEAD)).cast("bigint").alias("size"), F.crc32(body).alias("text_crc32"),
        shard_of(key, tree).alias("shard"), (shard_of(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    rows = durable(rows)  # the texts are read once
    # the row's place in the stored table makes the order total, so that equal rows need not go to one task
    rows = rows.withColumn("_at", F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")))
    order = ["shard", F.col("doc_id").asc_nulls_first(), "text_crc32", "size", "_at"]
    numbered = global_row_number(rows, order, out="_n", start=0)
    # one count per shard goes to the driver
    counts = {r["shard"]: r["n"] for r in numbered.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    starts = dict(zip(sorted(counts), accumulate([0, *(counts[s] for s in sorted(counts))])))
    start = F.lit(0).cast("bigint")
    if starts:
        start = F.element_at(F.create_map(*[F.lit(v) for s, n in starts.items() for v in (s, n)]), F.col("shard")).cast("bigint")
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("_n") - start).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, tree: Sequence[Leaf], doc_id: str = "doc_id") -> None:
    """Write all columns of the documents into one folder per shard (``shard=N``). Rows are spread within a shard, so that
    no shard is one task."""
    rows = docs.select(F.struct(*docs.columns).alias("doc"), shard_of(F.col(doc_id), tree).alias("shard"))
    rows.write.partitionBy("shard").parquet(path)


def op12_sharding(spark, sf_dir: str) -> DataFrame:
    rows = assigned(spark.read.parquet(f"{sf_dir}/documents.parquet"), standard(BASE), standard(BASE + 1))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _nodes_sql(shards: int) -> str:
    """All children of the tree as rows (parent, name, weight)."""
    rows = []
    for node, name, weight in {
        (parent, ":".join(map(str, p)), sum(x.weight for x in standard(shards) if (x.generation, x.region, x.rack, x.shard)[: len(p)] == p))
        for x in standard(shards)
        for d in (2, 3, 4)
        for p in [(x.generation, x.region, x.rack, x.shard)[:d]]
        for parent in [":".join(map(str, p[:-1])) if d > 2 else ""]
    }:
        rows.append(f"('{node}', '{name}', {weight}::DOUBLE)")
    return f"(VALUES {', '.join(sorted(rows))}) AS n(parent, name, weight)"


def _descent_sql(shards: int, out: str) -> str:
    steps, before = [], "keys"
    for depth in (1, 2, 3):
        on = "n.parent = ''" if depth == 1 else "n.parent = d.node"
        u = f"((('0x' || substr(md5(n.name || '|' || d.key), 1, {_BITS // 4}))::BIGINT + 0.5) / {1 << _BITS}::DOUBLE)"
        steps.append(f"{out}_{depth} AS (SELECT d.key, arg_min(n.name, -ln({u}) / n.weight) AS node FROM {before} d JOIN {_nodes_sql(shards)} ON {on} GROUP BY d.key)")
        before = f"{out}_{depth}"
    return ", ".join([*steps, f"{out} AS (SELECT key, split_part(node, ':', 4)::INTEGER AS shard FROM {before})"])


SHARDING_SQL = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
rows AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS key, coalesce(text, '') AS body FROM documents),
keys AS (SELECT DISTINCT key FROM rows), {_descent_sql(BASE, 'now')}, {_descent_sql(BASE + 1, 'later')},
full_rows AS (
  SELECT r.doc_id, octet_length(encode(body))::BIGINT + {OVERHEAD} AS size, {crc32_sql('body')} AS text_crc32, now.shard, later.shard AS grown_shard
  FROM rows r JOIN now USING (key) JOIN later USING (key), crc_table
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM full_rows
"""

QUERIES = {"op12_sharding": op12_sharding}
ORACLE_SQL = {"op12_sharding": SHARDING_SQL}
