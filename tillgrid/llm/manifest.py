"""Merkle manifest of a dataset: few stored levels, proofs from recomputed subtrees.

Each row of documents is a leaf, a hash of its columns. The leaves of a language
ascend by doc_id and make a tree of fan-out ``WIDTH``; the tops of these trees,
in order of language (null first, then by bytes), make the tree of the dataset.

Checkpoint and recompute: of each tree only every ``EVERY``-th level is stored,
so that the stored nodes above the leaves are 1 / 512 of them. Proofs go from
the top to the leaves, one stored level at a time: an aligned subtree below a
stored node (at most 512 stored descendants) is one group, in which the levels
between are hashed again, each descendant's siblings are emitted behind those of
the node above, and the levels are forgotten. What a group is handed from above
is one row, however many descendants it has, and no group grows with the data:
a language that holds most rows is many subtrees.

Leaves are numbered by a distributed prefix sum. Rows of one language and
doc_id stand in the order of their leaves; rows that are equal altogether are
leaves of their own, beside each other. Null doc_ids come first. Null columns
count as ``-``, empty texts as ``0:``. A lone leaf is the top of its tree, and a
lone top that of the dataset. An empty table has no leaves and no root. Columns
beyond the five that are hashed are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import ascii_lower, stored
from tillgrid.operators.joins import lookup_join
from tillgrid.operators.ordinal import number_rows

WIDTH, EVERY = 8, 3
BLOCK = WIDTH**EVERY
HASHED = ("doc_id", "source", "lang", "n_chars", "text")

Step = Callable[[list[bytes], pa.Table, list[list[bytes]], list[list[bytes]], dict], dict]


def digest(parts: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def leaf_of(columns: dict[str, Column]) -> Column:
    """The leaf of a row as 64 hex digits; ``columns`` may replace some of the row's own."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[field(columns.get(name, F.col(name))) for name in HASHED]), 256)


def height(total: int) -> int:
    """Levels above ``total`` nodes until one is left."""
    levels = 0
    while total > 1:
        total, levels = -(-total // WIDTH), levels + 1
    return levels


def rebuilt(nodes: list[bytes], total: int) -> list[list[bytes]]:
    """The levels of a subtree from its stored nodes up to the next stored node, both included."""
    levels = [nodes]
    for _ in range(min(EVERY, height(total))):
        below = levels[-1]
        levels.append([digest(below[i : i + WIDTH]) for i in range(0, len(below), WIDTH)])
    return levels


def siblings(levels: list[list[bytes]]) -> tuple[list[list[bytes]], list[list[bytes]]]:
    """Per level and place in it the texts of the siblings before and after."""
    before, after = [], []
    for level in levels[:-1]:
        before.append([b"".join(level[i - i % WIDTH : i]) for i in range(len(level))])
        after.append([b"".join(level[i + 1 : i - i % WIDTH + WIDTH]) for i in range(len(level))])
    return before, after


def folded(leaf: bytes, before: list[bytes], after: list[bytes]) -> bytes:
    """The root that a leaf and its siblings give."""
    for a, b in zip(before, after):
        leaf = digest([a, leaf, b])
    return leaf


NODE = pa.schema([("key", pa.string()), ("pos", pa.int64()), ("total", pa.int64()), ("node", pa.binary())])
NODE_COLUMNS = "key string, pos long, total long, node binary"
PATH = pa.schema([
    ("key", pa.string()), ("block", pa.int64()), ("subroot", pa.binary()), ("root", pa.binary()),
    ("before", pa.list_(pa.binary())), ("after", pa.list_(pa.binary())),
])
PATH_COLUMNS = "key string, block long, subroot binary, root binary, before array<binary>, after array<binary>"


def _blocks(level: DataFrame) -> DataFrame:
    return level.withColumn("block", F.shiftright("pos", 3 * EVERY))


def _above(level: DataFrame) -> DataFrame:
    """The nodes one stored level up of all trees that have more than one node here."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        total, key, pos = (table.column(c)[0].as_py() for c in ("total", "key", "pos"))
        top = rebuilt(table.column("node").to_pylist(), total)[-1]
        return pa.table([[key], [pos // BLOCK], [-(-total // WIDTH ** min(EVERY, height(total)))], top], schema=NODE)

    columns = ["key", "pos", "total", "node"]
    return _blocks(level.where("total > 1").select(*columns)).groupBy("key", "block").applyInArrow(run, NODE_COLUMNS)


def _grown(base: DataFrame, largest: int, folder: str) -> list[DataFrame]:
    """The stored levels of some trees, from their leaves up."""
    levels = [base]
    while largest > 1:
        levels.append(stored(_above(levels[-1]), f"{folder}-{EVERY * len(levels)}"))
        largest = -(-largest // BLOCK)
    return levels


@dataclass(frozen=True)
class Manifest:
    """Stored levels of the trees of languages (0 has the leaves) and of the tree over their tops."""

    levels: list[DataFrame]
    top_levels: list[DataFrame]


def build(docs: DataFrame, other: Column | None = None) -> Manifest:
    """Hash, number and fold; ``other`` is a second leaf to be kept beside each, for checks against changed rows."""
    key = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))  # sorts as the language does, null first
    rows = stored(
        docs.select(
            key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.unhex(leaf_of({})).alias("node"),
            F.unhex(F.lit(None).cast("string") if other is None else other).alias("other"), F.monotonically_increasing_id().alias("row"),
        ),
        "manifest-leaves",
    )
    totals = rows.groupBy("key").agg(F.count("*").alias("total"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("node"), F.col("row")]
    numbered = number_rows(rows, ["key"], order, "pos", kept=True).withColumn("node", F.encode(F.lower(F.hex("node")), "UTF-8"))
    leaves = lookup_join(numbered.drop("row"), totals, "key", "inner")
    levels = _grown(leaves, totals.agg(F.max("total")).first()[0] or 0, "manifest-level")

    tops = [level.where("total = 1").select("key", "node") for level in levels]
    subroots = tops[0]
    for more in tops[1:]:
        subroots = subroots.unionByName(more)
    subroots = stored(subroots, "manifest-tops")
    count = subroots.count()
    base = number_rows(subroots.withColumnRenamed("key", "tree"), [], "tree", "pos", kept=True).select(
        F.lit("").alias("key"), "pos", F.lit(count).cast("long").alias("total"), "node", "tree"
    )
    return Manifest(levels, _grown(base, count, "manifest-top-level"))


def _descend(levels: list[DataFrame], tops: DataFrame, step: Callable[..., pa.Table], columns: str, wanted: DataFrame | None = None) -> DataFrame:
    """Hand the paths of trees' tops down to the leaves.

    ``tops`` has key, subroot, root, before and after of each tree. ``step``
    makes the result from a subtree's leaves and their siblings. ``wanted``
    (key, pos) names the leaves asked for; other subtrees are not visited.
    """

    def visit(emit: Callable[..., pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
        def run(below: pa.Table, above: pa.Table) -> pa.Table:
            if not below.num_rows or not above.num_rows:
                return emit(None, None, None, None)
            below, path = below.sort_by("pos"), above.to_pylist()[0]
            subtree = rebuilt(below.column("node").to_pylist(), below.column("total")[0].as_py())
            before, after = siblings(subtree)
            paths = [
                [[own[i // WIDTH**k] for k, own in enumerate(side)] + rest for i in range(below.num_rows)]
                for side, rest in ((before, path["before"]), (after, path["after"]))
            ]
            return emit(below, *paths, path)

        return run

    def between(below: pa.Table | None, before, after, path) -> pa.Table:
        if below is None:
            return PATH.empty_table()
        n = below.num_rows
        return pa.table([below.column("key"), below.column("pos"), [path["subroot"]] * n, [path["root"]] * n, before, after], schema=PATH)

    needed: list[DataFrame | None] = [None] * len(levels)
    if wanted is not None:
        at = wanted
        for i in range(len(levels)):
            at = _blocks(at).select("key", "block").distinct()
            needed[i] = at
            at = at.withColumnRenamed("block", "pos")
    above = None
    for i, level in reversed(list(enumerate(levels))):
        ended = lookup_join(level.where("total = 1").select("key", F.lit(0).cast("long").alias("block")), tops, "key", "inner")
        above = ended if above is None else above.unionByName(ended)
        rows = _blocks(level) if needed[i] is None else lookup_join(_blocks(level), needed[i], ["key", "block"], "left_semi")
        above = above.select(*[F.col(c).alias(c) for c in above.columns])  # columns of its own, though both sides come from the leaves
        pair = rows.groupBy("key", "block").cogroup(above.groupBy("key", "block"))
        above = pair.applyInArrow(visit(between if i else step), PATH_COLUMNS if i else columns)
    return above


def _tree_paths(manifest: Manifest) -> DataFrame:
    """``key, subroot, root, before, after``: from the top of each language's tree to the root."""
    schema = pa.schema([f for f in PATH if f.name != "block"])

    def step(below: pa.Table | None, before, after, path) -> pa.Table:
        if below is None:
            return schema.empty_table()
        return pa.table([below.column("tree"), below.column("node"), [path["root"]] * below.num_rows, before, after], schema=schema)

    nothing = F.array().cast("array<binary>")
    last = manifest.top_levels[-1]
    top = last.where("total = 1").select("key", F.col("node").alias("subroot"), F.col("node").alias("root"), nothing.alias("before"), nothing.alias("after"))
    return _descend(manifest.top_levels, top, step, PATH_COLUMNS.replace("block long, ", ""))


PROOF = pa.schema([
    ("doc_id", pa.int64()), ("leaf", pa.binary()), ("subroot", pa.binary()), ("root", pa.binary()),
    ("before", pa.list_(pa.binary())), ("after", pa.list_(pa.binary())),
])


def proofs(manifest: Manifest, doc_ids: DataFrame | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, before, after`` of all documents, or of those whose doc_id is listed.

    ``before`` and ``after`` hold, level by level, the digests beside the node
    on the way to the root, as joined hex texts.
    """

    def step(below: pa.Table | None, before, after, path) -> pa.Table:
        if below is None:
            return PROOF.empty_table()
        n = below.num_rows
        return pa.table([below.column("doc_id"), below.column("node"), [path["subroot"]] * n, [path["root"]] * n, before, after], schema=PROOF)

    columns = "doc_id long, leaf binary, subroot binary, root binary, before array<binary>, after array<binary>"
    tops = _tree_paths(manifest)
    if doc_ids is None:
        return _descend(manifest.levels, tops, step, columns)
    listed = lookup_join(manifest.levels[0], doc_ids.select("doc_id").distinct(), "doc_id", "left_semi").select("key", "pos")
    return lookup_join(_descend(manifest.levels, tops, step, columns, listed), doc_ids.select("doc_id").distinct(), "doc_id", "left_semi")


CHECKED = pa.schema([
    ("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()),
    ("folded_root", pa.string()), ("verified", pa.bool_()),
])


def checked(manifest: Manifest) -> DataFrame:
    """Per document the digest of its proof, and the root that its proof gives for its other leaf (where there is one, else its own)."""

    def step(below: pa.Table | None, before, after, path) -> pa.Table:
        if below is None:
            return CHECKED.empty_table()
        root, out = path["root"], []
        for doc_id, node, other, a, b in zip(*(below.column(c).to_pylist() for c in ("doc_id", "node", "other")), before, after):
            found = folded(node if other is None else other.hex().encode(), a, b)
            proof = digest([part for pair in zip(a, b) for part in pair])
            out.append((doc_id, node.decode(), path["subroot"].decode(), root.decode(), proof.decode(), found.decode(), found == root))
        return pa.table(list(map(list, zip(*out))), schema=CHECKED)

    columns = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _descend(manifest.levels, _tree_paths(manifest), step, columns)


def tampered_leaf() -> Column:
    """The leaf of a row whose text was lower-cased (A-Z), for a third of all rows by checksum of doc_id; null for the others."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return F.when(chosen, leaf_of({"text": ascii_lower(F.col("text"))}))
