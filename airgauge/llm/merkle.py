"""A dataset's Merkle manifest: built levels stored as parent-linked node rows, proofs by a recursive query.

Leaves are numbered in order by a range partitioning. A tree grows in blocks of 2^SPAN nodes: one group of
bounded size gives the SPAN levels above it. A stored node row links a node with its ancestor SPAN levels up
and carries the siblings on that way (SPAN = 1 stores plain parents). A recursive query then lets each leaf
ascend, appending siblings to its proof and folding its own, perhaps tampered, hash.

The upper nodes are on the way of very many leaves. Their rows are stored once for every SHARE leaves below
them, and a leaf takes the copy its number falls on, so that no key of the climb's join is hot.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from airgauge.llm.common import stored

SPAN = 10  # levels that one stored row covers
SHARE = 256  # leaves that share one copy of a stored row
TOP, ROOT = -1, -2  # the tree over all subroots, and what stands above its last node

ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


@dataclass(frozen=True)
class Manifest:
    """`leaves`: num, tree, pos, hash and the kept columns; `trees`: tree, group, subroot; `root`.

    `low` and `upper`: the node rows of the leaves and of all nodes above them.
    """

    leaves: DataFrame
    trees: DataFrame
    low: DataFrame
    upper: DataFrame
    root: bytes | None


def field_text(c: Column) -> Column:
    """`-` for NULL, else the number of UTF-8 bytes, `:` and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_hash(values: Sequence[Column]) -> Column:
    """SHA-256 of a row's values in order, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field_text(c) for c in values]), 256))


def _hash(*digests: str) -> str:
    """SQL: the hash of digests, each as lower-case hexadecimal text; a missing one adds nothing."""
    texts = ", ".join(f"coalesce(lower(hex({d})), '')" for d in digests)
    return f"unhex(sha2(concat({texts}), 256))"


def numbered(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """The rows with `num` from 0 on in the given order. Only a count for each partition meets in one task."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(placed.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")), f"{name}-starts")
    at = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("_part", part).join(starts, "_part").withColumn("num", F.col("_start") + at).drop("_part", "_at", "_start")


# Levels of a block from its lowest up, as far as the tree reaches.
_LEVELS = f"""aggregate(array_repeat(0, steps), array(transform(items, x -> x.hash)), (done, _) -> concat(done, array(
    transform(sequence(0, (size(element_at(done, -1)) - 1) div 2), i -> {_hash("element_at(done, -1)[2 * i]", "get(element_at(done, -1), 2 * i + 1)")}))))"""
# What each node of a block is linked with: the siblings on its way, NULL where a run has but one node.
_LINKS = """transform(items, (x, i) -> named_struct('pos', x.pos, 'leaves', x.leaves,
    'path', transform(slice(levels, 1, steps), (level, j) -> get(level, shiftright(i, j) ^ 1))))"""


def _round(items: DataFrame, heights: DataFrame, turn: int, span: int, name: str) -> DataFrame:
    """One row for each block of 2^span nodes: its top and the links of its nodes, stored.

    items: tree, pos, hash, leaves. A block is a group of at most 2^span rows.
    """
    packed = F.struct("pos", "hash", "leaves")
    blocks = items.groupBy("tree", F.shiftright("pos", span).alias("block")).agg(F.sort_array(F.collect_list(packed)).alias("items"))
    blocks = blocks.join(heights, "tree").withColumn("steps", F.least(F.lit(span), F.col("height") - turn * span).cast("int"))
    blocks = blocks.withColumn("levels", F.expr(_LEVELS))
    return stored(
        blocks.select(
            "tree",
            "block",
            F.lit(turn).alias("turn"),
            (F.col("height") <= (turn + 1) * span).alias("whole"),
            F.expr("element_at(levels, -1)[0]").alias("top"),
            F.expr("aggregate(items, 0L, (n, x) -> n + x.leaves)").alias("leaves"),
            F.expr(_LINKS).alias("links"),
        ),
        name,
    )


def _grown(items: DataFrame, heights: DataFrame, span: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """All rounds of blocks up to each tree's last node, and the last nodes: tree, hash, leaves."""
    tallest = heights.agg(F.max("height")).first()[0] or 0
    rounds: list[DataFrame] = []
    for turn in range(max(1, -(-tallest // span))):
        rounds.append(_round(items, heights, turn, span, f"{name}-{turn}"))
        items = rounds[-1].where("not whole").select("tree", F.col("block").alias("pos"), F.col("top").alias("hash"), "leaves")
    return rounds, _stacked([r.where("whole").select("tree", F.col("top").alias("hash"), "leaves") for r in rounds])


def _stacked(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _height(n: str) -> Column:
    """Levels above n leaves."""
    return F.expr(f"case when {n} <= 1 then 0 else length(bin({n} - 1)) end")


def build(rows: DataFrame, group: str, id: str, hash: Column, keep: dict[str, Column], span: int = SPAN) -> Manifest:
    """The manifest of `rows`: one tree for each value of `group` (NULL is a value), one over their subroots.

    Leaves ascend by id (NULL first), equal ids by their hash; repeated rows are leaves of their own. Groups
    are ordered NULL first, text bytewise. `keep` adds columns to the leaves. An empty table has no root.
    """
    values = {"_group": F.col(f"`{group}`"), "_id": F.col(f"`{id}`"), "hash": hash} | keep
    hashed = stored(rows.select(*[c.alias(n) for n, c in values.items()], F.monotonically_increasing_id().alias("_tie")), "merkle-hashes")
    order = [F.asc_nulls_first("_group"), F.asc_nulls_first("_id"), F.asc("hash"), F.asc("_tie")]
    ordered = numbered(hashed, order, "merkle-order")
    spans = ordered.groupBy("_group").agg(F.min("num").alias("first"), F.count(F.lit(1)).alias("n"))
    trees = stored(numbered(spans, [F.asc_nulls_first("_group")], "merkle-groups").withColumnRenamed("num", "tree"), "merkle-trees")
    of = trees.select(F.col("_group").alias("_g"), "tree", "first")
    leaves = ordered.join(of, F.col("_group").eqNullSafe(F.col("_g"))).withColumn("pos", F.col("num") - F.col("first"))
    leaves = stored(leaves.select("num", "tree", "pos", "hash", F.col("_id").alias(id), *keep), "merkle-leaves")

    one = F.lit(1).cast("bigint")
    rounds, subroots = _grown(
        leaves.select("tree", "pos", "hash", one.alias("leaves")), trees.select("tree", _height("n").alias("height")), span, "merkle-tree"
    )
    subroots = stored(subroots, "merkle-subroots")
    n_trees = trees.count()
    if not n_trees:
        none = leaves.sparkSession.createDataFrame([], T.StructType.fromDDL(LINK))
        return Manifest(leaves, trees.select("tree", F.col("_group").alias(group), F.lit(None).cast("binary").alias("subroot")), none, none, None)
    top = F.lit(TOP).cast("bigint")
    height = leaves.sparkSession.range(1).select(top.alias("tree"), _height(f"{n_trees}").alias("height"))
    upper, root = _grown(
        subroots.select(top.alias("tree"), F.col("tree").alias("pos"), "hash", "leaves"), height, span, "merkle-top"
    )
    links = [*[_link_rows(r, TOP) for r in rounds], *[_link_rows(r, ROOT) for r in upper]]
    named = trees.join(subroots, "tree").select("tree", F.col("_group").alias(group), F.col("hash").alias("subroot"))
    return Manifest(leaves, named, links[0], stored(_stacked(links[1:]), "merkle-links"), bytes(root.first()["hash"]))


LINK = "tree bigint, turn int, pos bigint, copy bigint, to_tree bigint, to_turn int, to_pos bigint, to_copies bigint, at int, path array<binary>"


def _link_rows(blocks: DataFrame, above: int) -> DataFrame:
    """The node rows of a round, each once for every SHARE leaves below it.

    A tree's last node is a leaf of the tree above, at the tree's number; above ROOT there is nothing.
    """
    copies = lambda n: F.expr(f"({n} + {SHARE - 1}) div {SHARE}")
    to = F.when(F.col("whole"), F.struct(F.lit(above).cast("bigint").alias("tree"), F.lit(0).alias("turn"), F.when(F.lit(above == ROOT), F.lit(0).cast("bigint")).otherwise(F.col("tree")).alias("pos")))
    to = to.otherwise(F.struct(F.col("tree"), (F.col("turn") + 1).alias("turn"), F.col("block").alias("pos")))
    rows = blocks.select("tree", "turn", to.alias("to"), copies("leaves").alias("to_copies"), F.posexplode("links").alias("at", "link"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), copies("link.leaves") - 1)))
    return rows.select(
        "tree", "turn", F.col("link.pos").alias("pos"), "copy", F.col("to.tree").alias("to_tree"), F.col("to.turn").alias("to_turn"),
        F.col("to.pos").alias("to_pos"), "to_copies", "at", F.col("link.path").alias("path"),
    )


_FOLD = f"""aggregate(transform(n.path, (sibling, j) -> named_struct('s', sibling, 'right', shiftright(n.at, j) % 2 = 1)), c.folded, (own, x) ->
    case when x.s is null then {_hash("own")} when x.right then {_hash("x.s", "own")} else {_hash("own", "x.s")} end)"""

_SIBLINGS = "aggregate(n.path, X'', (all, sibling) -> concat(all, coalesce(sibling, X'')))"

_CLIMB = f"""
WITH RECURSIVE climb(num, hop, tree, turn, pos, copies, folded, siblings) AS (
    SELECT c.num, 0, n.to_tree, n.to_turn, n.to_pos, n.to_copies, {_FOLD}, {_SIBLINGS}
    FROM {{starts}} c JOIN {{low}} n ON c.tree = n.tree AND c.pos = n.pos
    UNION ALL
    SELECT c.num, c.hop + 1, n.to_tree, n.to_turn, n.to_pos, n.to_copies, {_FOLD}, {_SIBLINGS}
    FROM climb c JOIN {{upper}} n ON c.tree = n.tree AND c.turn = n.turn AND c.pos = n.pos AND pmod(c.num, c.copies) = n.copy
)
SELECT num, max(CASE WHEN tree = {ROOT} THEN folded END) AS folded,
       sha2(array_join(transform(sort_array(collect_list(struct(hop, siblings))), x -> lower(hex(x.siblings))), ''), 256) AS proof_sha256
FROM climb GROUP BY num
"""


def climb(manifest: Manifest, starts: DataFrame) -> DataFrame:
    """num, folded and proof_sha256 for each of `starts` (num, tree, pos, folded): its way up to the root.

    `folded` becomes the root that the given hash and the stored siblings of leaf `num` lead to. Each step of a
    leaf appends a row with the siblings on it; the proof is these alone, in order. The result is stored: a
    session's limit on rows of recursive queries is lifted for this one only.
    """
    spark = starts.sparkSession
    limit = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return stored(spark.sql(_CLIMB, starts=starts, low=manifest.low, upper=manifest.upper), "merkle-climb")
    finally:
        if limit is None:
            spark.conf.unset(ROW_LIMIT)
        else:
            spark.conf.set(ROW_LIMIT, limit)


def tamper_audit(docs: DataFrame, id: str = "doc_id", group: str = "lang", fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), bumped: str = "n_chars", every: int = 7, span: int = SPAN) -> DataFrame:
    """For each row: its leaf, subroot, the root, its proof, the root that its hash folds to, and whether that is the root.

    Rows whose id, as decimal text, has a CRC-32 that `every` divides are folded with 1 added to `bumped`;
    a NULL there stays NULL, and a NULL id is never tampered with. Digests are lower-case hexadecimal.
    Repeated rows and ids are leaves of their own; an empty table gives no rows.
    """
    col = lambda c: F.col(f"`{c}`")
    more = (col(bumped).cast("decimal(38,0)") + 1).cast("string")
    chosen = F.coalesce(F.crc32(col(id).cast("string").cast("binary")) % every == 0, F.lit(False))
    changed = F.when(chosen, row_hash([more if f == bumped else col(f) for f in fields]))
    found = build(docs, group, id, row_hash([col(f) for f in fields]), {"changed": changed}, span)
    ways = climb(found, found.leaves.select("num", "tree", "pos", F.coalesce("changed", "hash").alias("folded")))
    text = lambda c: F.lower(F.hex(c))
    root = F.lit(found.root.hex() if found.root else None).cast("string")
    rows = found.leaves.join(ways, "num").join(found.trees.select("tree", "subroot"), "tree")
    return rows.select(
        col(id), text("hash").alias("leaf"), text("subroot").alias("subroot"), root.alias("root"), "proof_sha256",
        text("folded").alias("folded_root"), (text("folded") == root).alias("verified"),
    )
