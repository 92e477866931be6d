"""Near copies among embeddings by navigable small-world graphs, one per shard of a label.

A shard's graph has layers, each over a share of the one below. A query walks down the layers and then
widens a beam in the lowest one. Every vector queries every shard of its label; a pair that either side
finds is a link of both. A query whose whole beam is still similar enough is asked again with a beam twice
as wide, and a shard whose audit (samples of its own vectors, of the same as strangers, and of vectors of
the label's other shards, each against all its vectors) finds too few widens all beams, at last to the
whole shard. What is found is verified in double precision; links become components.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgauge.llm.common import stored
from airgauge.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIMILAR = 0.93
SHARD = 8_192  # vectors of one graph
BLOCK = 2_048  # queries that one graph is asked at once
STEP = 128  # queries that walk at once
LINKS, LOWEST_LINKS = 16, 32  # of a node in an upper and in the lowest layer
BUILD_BEAM, BEAM = 48, 48
AUDITED, RECALL = 64, 0.995
STRANGERS = 1_024  # vectors of a label, about, from which audits take those of other shards
SLACK = 1e-4  # single precision in the walk


class Graph:
    """Layers of links between the rows of `x` (unit vectors, single precision)."""

    def __init__(self, x: np.ndarray, layers: list[np.ndarray], entry: int):
        self.x, self.layers, self.entry = x, layers, entry

    @staticmethod
    def build(x: np.ndarray) -> Graph:
        n = len(x)
        draw = np.random.default_rng(n).random(n)
        level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(LINKS)).astype(int), 6)
        top = int(level.max(initial=0))
        order = np.argsort(-level, kind="stable")  # the upper layers first: every layer is entered from above
        layers = [np.full((n, LINKS if h else LOWEST_LINKS), -1, np.int32) for h in range(top + 1)]
        graph = Graph(x, layers, int(order[0]) if n else -1)
        done = 1
        while done < n:
            new = order[done : done + min(256, max(1, done))]
            graph._insert(new, level)
            done += len(new)
        return graph

    def _insert(self, new: np.ndarray, level: np.ndarray) -> None:
        q = self.x[new]
        mates = q @ q.T
        np.fill_diagonal(mates, -2.0)
        start = np.full((len(new), 1), self.entry, np.int32)
        for h in range(len(self.layers) - 1, -1, -1):
            ids, sims = self.walk(q, start, h, BUILD_BEAM if h == 0 else 8)
            start = ids[:, :4].copy()
            start[start < 0] = self.entry
            mine = np.flatnonzero(level[new] >= h)
            if not len(mine):
                continue
            # the others of this lot are not in the graph yet; the nearest of them are candidates too
            k = min(LINKS, len(mine))
            near = np.argsort(-mates[np.ix_(mine, mine)], axis=1)[:, :k]
            cand = np.concatenate([ids[mine], new[mine][near].astype(np.int32)], axis=1)
            sim = np.concatenate([sims[mine], np.take_along_axis(mates[np.ix_(mine, mine)], near, axis=1)], axis=1)
            sim[cand < 0] = -2.0
            chosen = self._diverse(cand, sim, LINKS)
            self.layers[h][new[mine], : chosen.shape[1]] = chosen
            self._link_back(np.repeat(new[mine], chosen.shape[1]), chosen.reshape(-1), h)

    def _diverse(self, cand: np.ndarray, sim: np.ndarray, most: int) -> np.ndarray:
        """Candidates nearer to the node than to any chosen one; then the nearest of the rest."""
        order = np.argsort(-sim, axis=1, kind="stable")[:, : 2 * most]
        cand, sim = np.take_along_axis(cand, order, axis=1), np.take_along_axis(sim, order, axis=1)
        v = self.x[cand]
        between = v @ v.transpose(0, 2, 1)
        taken = np.zeros(cand.shape, bool)
        for k in range(cand.shape[1]):
            rival = np.where(taken, between[:, k], -2.0).max(axis=1)
            taken[:, k] = (sim[:, k] > -2.0) & (rival < sim[:, k]) & (taken.sum(axis=1) < most)
        rank = np.where(sim <= -2.0, 9.0, np.where(taken, 0.0, 1.0)) - sim * 1e-3
        pick = np.argsort(rank, axis=1, kind="stable")[:, :most]
        out = np.take_along_axis(cand, pick, axis=1)
        out[np.take_along_axis(sim, pick, axis=1) <= -2.0] = -1
        return out

    def _link_back(self, sources: np.ndarray, targets: np.ndarray, h: int) -> None:
        """Adds source to the links of target; a full list keeps a diverse choice."""
        links = self.layers[h]
        sources, targets = sources[targets >= 0], targets[targets >= 0]
        order = np.argsort(targets, kind="stable")
        sources, targets = sources[order], targets[order]
        first = np.flatnonzero(np.diff(targets, prepend=-1))
        counts = np.diff(first, append=len(targets))
        nodes = targets[first]
        new = np.full((len(nodes), int(counts.max(initial=0))), -1, np.int32)
        new[np.repeat(np.arange(len(nodes)), counts), np.arange(len(targets)) - np.repeat(first, counts)] = sources
        for at in range(0, len(nodes), 512):
            some = nodes[at : at + 512]
            cand = np.concatenate([links[some], new[at : at + 512]], axis=1)
            cand = np.sort(cand, axis=1)
            cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
            sim = np.einsum("nd,nkd->nk", self.x[some], self.x[cand])
            sim[(cand < 0) | (cand == some[:, None])] = -2.0
            links[some] = self._diverse_wide(cand, sim, links.shape[1])

    def _diverse_wide(self, cand: np.ndarray, sim: np.ndarray, width: int) -> np.ndarray:
        out = np.full((len(cand), width), -1, np.int32)
        chosen = self._diverse(cand, sim, width)
        out[:, : chosen.shape[1]] = chosen
        return out

    def walk(self, q: np.ndarray, start: np.ndarray, h: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query the `beam` nearest nodes met in layer h from its start nodes, nearest first (-1: none)."""
        m, links = len(q), self.layers[h]
        seen = np.zeros((m, len(self.x)), bool)
        rows = np.arange(m)[:, None]
        ids = np.full((m, beam), -1, np.int32)
        sims = np.full((m, beam), -2.0, np.float32)
        opened = np.ones((m, beam), bool)
        fresh = start
        wide = max(2, beam // 16)
        live = np.arange(m)
        while len(live):
            fresh = np.sort(fresh, axis=1)
            fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = -1
            fresh[seen[live[:, None], np.maximum(fresh, 0)]] = -1
            who, col = np.nonzero(fresh >= 0)
            got = fresh[who, col]
            seen[live[who], got] = True
            s = np.full(fresh.shape, -2.0, np.float32)
            s[who, col] = np.einsum("nd,nd->n", q[live[who]], self.x[got])
            ids2 = np.concatenate([ids[live], fresh], axis=1)
            sims2 = np.concatenate([sims[live], s], axis=1)
            open2 = np.concatenate([opened[live], fresh < 0], axis=1)
            best = np.argsort(-sims2, axis=1, kind="stable")[:, :beam]
            ids[live], sims[live] = np.take_along_axis(ids2, best, axis=1), np.take_along_axis(sims2, best, axis=1)
            open3 = np.take_along_axis(open2, best, axis=1)
            # the best that were not opened yet, a few at a time
            todo = ~open3
            turn = np.cumsum(todo, axis=1)
            now = todo & (turn <= wide)
            opened[live] = open3 | now
            more = now.any(axis=1)
            live, now = live[more], now[more]
            if not len(live):
                break
            at = np.argsort(~now, axis=1, kind="stable")[:, :wide]
            nodes = np.where(np.take_along_axis(now, at, axis=1), np.take_along_axis(ids[live], at, axis=1), -1)
            fresh = np.where(nodes[:, :, None] >= 0, links[np.maximum(nodes, 0)], -1).reshape(len(live), -1)
        del rows
        return ids, sims

    def near(self, q: np.ndarray, own: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) at `least` or more. `own` is a query's own node, where its walk starts, or -1."""
        queries: list[np.ndarray] = []
        nodes: list[np.ndarray] = []
        todo = np.arange(len(q))
        while len(todo):
            if beam >= len(self.x):  # the whole shard
                for at in range(0, len(todo), STEP):
                    i, j = np.nonzero(q[todo[at : at + STEP]] @ self.x.T >= least)
                    queries.append(todo[at + i])
                    nodes.append(j)
                break
            again = []
            for at in range(0, len(todo), STEP):
                some = todo[at : at + STEP]
                start = np.full((len(some), 1), self.entry, np.int32)
                for h in range(len(self.layers) - 1, 0, -1):
                    start = self.walk(q[some], start, h, 4)[0]
                start = np.concatenate([start, own[some][:, None].astype(np.int32)], axis=1)
                ids, sims = self.walk(q[some], start, 0, beam)
                full = (sims >= least).all(axis=1)
                again.append(some[full])
                i, j = np.nonzero((sims >= least) & ~full[:, None])
                queries.append(some[i])
                nodes.append(ids[i, j])
            todo = np.concatenate(again)
            beam *= 2
        return np.concatenate([np.zeros(0, np.int64), *queries]), np.concatenate([np.zeros(0, np.int64), *nodes])

    def audited(self, least: float, others: np.ndarray | None = None, recall: float = RECALL) -> tuple[int, float]:
        """The beam at which all queries of an audit find enough of what comparing with all vectors finds.

        Own vectors that start at their node, own vectors as strangers, and `others` (vectors of other shards)
        pass each by themselves. Nobody's own node counts as found. The share found is that of the links and
        the mean over the queries, whichever is less: a crowd does not hide the pairs that are missed.
        """
        n = len(self.x)
        nodes, true = self._with_neighbours(self.x, np.arange(n), least)
        lots = [(self.x[nodes], nodes, nodes, true), (self.x[nodes], np.full(len(nodes), -1), nodes, true)]
        if others is not None and len(others):
            no = np.full(len(others), -1)
            some, met = self._with_neighbours(others, no, least)
            lots.append((others[some], no[some], no[some], met))
        beam = BEAM
        while True:
            found = min(self._share(*lot, least, beam) for lot in lots)
            if found >= recall or beam >= n:
                return beam, found
            beam *= 2

    def _with_neighbours(self, q: np.ndarray, own: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Some of the queries that have neighbours other than `own` anywhere in the shard, and which these are."""
        linked = [np.zeros(0, np.int64)]
        for at in range(0, len(q), 512):
            linked.append(at + np.flatnonzero(self._alike(q[at : at + 512], own[at : at + 512], least).any(axis=1)))
        linked = np.concatenate(linked)
        linked = linked[:: max(1, len(linked) // AUDITED)]
        return linked, self._alike(q[linked], own[linked], least)

    def _alike(self, q: np.ndarray, own: np.ndarray, least: float) -> np.ndarray:
        alike = q @ self.x.T >= least
        alike[np.flatnonzero(own >= 0), own[own >= 0]] = False
        return alike

    def _share(self, q: np.ndarray, start: np.ndarray, own: np.ndarray, true: np.ndarray, least: float, beam: int) -> float:
        if not len(q):
            return 1.0
        i, j = self.near(q, start, least, beam)
        found = np.zeros_like(true)
        found[i, j] = True
        found &= true
        return float(min(found.sum() / true.sum(), (found.sum(axis=1) / true.sum(axis=1)).mean()))


# --- Spark ------------------------------------------------------------------------


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.compute.list_flatten(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).to_numpy(zero_copy_only=False)
    x = flat.astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


GRAPH = pa.schema([
    ("grp", pa.int64()), ("shard", pa.int32()), ("shards", pa.int32()), ("ids", pa.binary()), ("weights", pa.binary()), ("vectors", pa.binary()),
    ("layers", pa.list_(pa.binary())), ("entry", pa.int64()), ("beam", pa.int64()), ("recall", pa.float64()),
])
LINK = pa.schema([("cid", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def _graph(table: pa.Table, sample: pa.Table) -> pa.Table:
    """The graph of a shard, as one row: its vectors' ids and weights, the vectors, its layers, the audited beam.

    `sample` is of the whole label; its vectors of other shards take part in the audit.
    """
    if not table.num_rows:
        return GRAPH.empty_table()
    table = table.sort_by("cid")
    x, ids = _matrix(table["vector"]), table["cid"].to_numpy()
    graph = Graph.build(x.astype(np.float32))
    sample = sample.sort_by("cid")
    sample = sample.filter(pa.array(~np.isin(sample["cid"].to_numpy(), ids)))
    others = _matrix(sample["vector"]).astype(np.float32) if sample.num_rows else None
    beam, recall = graph.audited(SIMILAR - SLACK, others)
    return pa.table({
        "grp": table["grp"][:1], "shard": table["shard"][:1], "shards": table["shards"][:1],
        "ids": [ids.tobytes()], "weights": [table["weight"].to_numpy().tobytes()], "vectors": [x.tobytes()],
        "layers": [[h.tobytes() for h in graph.layers]], "entry": [graph.entry], "beam": [beam], "recall": [recall],
    }).cast(GRAPH)


class Shard:
    """A stored graph with its vectors in double precision, their ids (ascending) and weights."""

    def __init__(self, row: dict):
        self.ids, self.weights = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["weights"], np.int64)
        self.exact = np.frombuffer(row["vectors"], np.float64).reshape(len(self.ids), -1)
        layers = [np.frombuffer(h, np.int32).reshape(len(self.ids), -1) for h in row["layers"]]
        self.graph, self.beam = Graph(self.exact.astype(np.float32), layers, row["entry"]), row["beam"]

    def __len__(self) -> int:
        return len(self.ids)


def _met(key: tuple, graphs: pa.Table) -> pa.Table:
    """Two shards of a label, or one and itself: links of each vector there, and the smallest it hangs with by them.

    The vectors of each shard ask the graph of the other. A pair counts once, for both, whichever side found it.
    """
    shards = [Shard(g) for g in graphs.sort_by("shard").to_pylist()]
    same = key[1].as_py() == key[2].as_py()
    if len(shards) < (1 if same else 2):
        return LINK.empty_table()
    a, b = shards[0], shards[-1]
    hit = np.zeros((len(a), len(b)), bool)
    for asking, asked, cells in ((a, b, hit),) if same else ((a, b, hit), (b, a, hit.T)):
        for at in range(0, len(asking), BLOCK):
            some = np.arange(at, min(at + BLOCK, len(asking)))
            i, j = asked.graph.near(asking.graph.x[some], some if same else np.full(len(some), -1), SIMILAR - SLACK, asked.beam)
            cells[some[i], j] = True
    if same:
        hit = np.triu(hit | hit.T, 1)
    names = np.unique(np.concatenate([a.ids, b.ids]))
    at_a, at_b = np.searchsorted(names, a.ids), np.searchsorted(names, b.ids)
    links, root = np.zeros(len(names), np.int64), np.arange(len(names))
    for start in range(0, len(a), STEP):
        i, j = np.nonzero(hit[start : start + STEP])
        for at in range(0, len(i), 1 << 16):
            p, r = start + i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            sure = np.einsum("nd,nd->n", a.exact[p], b.exact[r]) >= SIMILAR
            p, r = p[sure], r[sure]
            u, v = at_a[p], at_b[r]
            links += np.bincount(u, weights=b.weights[r], minlength=len(names)).astype(np.int64)
            links += np.bincount(v, weights=a.weights[p], minlength=len(names)).astype(np.int64)
            while (root[u] != root[v]).any():  # the larger of two roots is hung to the smaller
                np.minimum.at(root, np.maximum(root[u], root[v]), np.minimum(root[u], root[v]))
                while (root[root] != root).any():
                    root = root[root]
    return pa.table({"cid": names, "links": links, "root": names[root]})


def near_duplicates(vectors: DataFrame, id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """`id`, n_links, component_id (smallest id reachable by links) and kept (id = component_id) for each row.

    Two rows link when their labels are equal, not NULL, and their cosine is SIMILAR or more in double
    precision. NULL and zero vectors, and those with NULL or non-finite components, link with nothing, as do
    vectors of different lengths. Equal vectors of a label are compared as one. Rows that share an id are
    rows of their own; a NULL id names a component only if it has no other. An empty table gives no rows.
    """
    v = F.col(embedding).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ok = F.coalesce(F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id).alias("vec_id"), v.alias("vector"), F.col(label).alias("label"), F.monotonically_increasing_id().alias("uid"))
    rows = stored(rows.withColumn("ok", ok), "vectors")
    grp = F.xxhash64("label", F.size("vector"))
    good = rows.where("ok").withColumn("grp", grp)
    classes = stored(
        good.groupBy("label", "vector", "grp").agg(F.min("uid").alias("cid"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight")), "vector-classes"
    )
    sizes = classes.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    placed = classes.join(sizes, "grp").withColumn("shards", F.ceil(F.col("n") / SHARD).cast("int"))
    placed = placed.withColumn("shard", F.pmod(F.xxhash64("cid"), F.col("shards")).cast("int"))
    sample = placed.where((F.col("shards") > 1) & (F.pmod(F.xxhash64("cid", F.lit(1)), F.ceil(F.col("n") / STRANGERS)) == 0))
    every = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    sample = sample.select(every.alias("shard"), *[F.col(c).alias(c) for c in ("grp", "cid", "vector")])
    keys = ["grp", "shard"]
    schema = "grp bigint, shard int, shards int, ids binary, weights binary, vectors binary, layers array<binary>, entry bigint, beam bigint, recall double"
    graphs = placed.select(*keys, "shards", "cid", "weight", "vector").groupBy(*keys).cogroup(sample.groupBy(*keys)).applyInArrow(_graph, schema)
    graphs = stored(graphs, "graphs")
    # every two shards of a label meet once, and each meets itself
    other = graphs.select("*", every.alias("other"))
    pairs = other.withColumn("a", F.least("shard", "other")).withColumn("b", F.greatest("shard", "other"))
    found = pairs.groupBy("grp", "a", "b").applyInArrow(_met, "cid bigint, links bigint, root bigint")
    found = stored(found, "vector-links")
    roots = components(found.where("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = classes.join(links, "cid").join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("label", "vector", (F.col("links") + F.col("weight") - 1).alias("n_links"), "component_id")
    out = good.join(named, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    return out.withColumnRenamed("vec_id", id)
