"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Equal vectors are collapsed into one node, which keeps its smallest ids. Nodes are
dealt into shards by a hash. Each shard's task builds one graph: every node has a
random top layer; in each layer, in a random order, it is linked to near and
mutually diverse nodes before it, and back, so early nodes keep long links. The
graph is stored as flat neighbour arrays, one row per shard. Blocks of queries are
joined with the shards, searched from the top layer down, and the shards' results
are merged with scores in double precision.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite
components take no part. Of several rows with one id the least vector counts; null
ids are left out. Vectors of another length are no candidates of a query. Fewer
candidates than k give all of them; ties go to the smaller id. Extra columns are not
read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from castframe.llm.common import bounded_batches
from castframe.session import materialize, ship

LINKS = 16  # of a node in an upper layer; twice as many in the lowest
CONSIDERED = 48
BEAM = 96
SHARD_ROWS = 4096
QUERY_ROWS = 512

INDEX = "dim int, shard int, ids array<array<long>>, vectors array<float>, nodes array<array<int>>, links array<array<int>>"


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _diverse(own: np.ndarray, near: np.ndarray, vectors: np.ndarray, keep: int) -> np.ndarray:
    """Up to ``keep`` of each row of candidates (nearest first, -1 for none): those nearer to
    the row's own vector than to any one chosen before, then the nearest of the rest."""
    there = near >= 0
    cand = vectors[near]
    to_own = np.einsum("bcd,bd->bc", cand, vectors[own])
    among = cand @ cand.transpose(0, 2, 1)
    chosen = np.zeros(near.shape, bool)
    for c in range(near.shape[1]):
        closer = (among[:, c, :] > to_own[:, c : c + 1]) & chosen
        chosen[:, c] = there[:, c] & ~closer.any(axis=1) & (chosen.sum(axis=1) < keep)
    first = np.argsort(np.where(chosen, 0, np.where(there, 1, 2)), axis=1, kind="stable")[:, :keep]
    return np.take_along_axis(near, first, axis=1)


def _layer(vectors: np.ndarray, keep: int) -> np.ndarray:
    """Neighbours (n x (keep + 1), -1 for none) of vectors that are inserted in their order."""
    n = len(vectors)
    out: list[list[int]] = [[] for _ in range(n)]
    for start in range(1, n, 256):
        rows = np.arange(start, min(n, start + 256))
        sims = vectors[rows] @ vectors[: rows[-1]].T
        sims[np.arange(rows[-1])[None, :] >= rows[:, None]] = -np.inf
        width = min(CONSIDERED, sims.shape[1])
        near = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        value = np.take_along_axis(sims, near, axis=1)
        order = np.argsort(-value, axis=1, kind="stable")
        near, value = np.take_along_axis(near, order, axis=1), np.take_along_axis(value, order, axis=1)
        for row, got in zip(rows.tolist(), _diverse(rows, np.where(value > -np.inf, near, -1), vectors, max(keep // 2, 1)).tolist()):
            for other in got:
                if other >= 0:
                    out[row].append(other)
                    out[other].append(row)
    links = np.full((n, keep + 1), -1, np.int32)
    for row, others in enumerate(out):
        if len(others) > keep:
            some = np.array(others)
            some = some[np.argsort(-(vectors[some] @ vectors[row]), kind="stable")][: 4 * keep]
            others = [x for x in _diverse(np.array([row]), some[None, :], vectors, keep)[0].tolist() if x >= 0]
        links[row, : len(others)] = others
    return _bridged(vectors, links)


def _bridged(vectors: np.ndarray, links: np.ndarray) -> np.ndarray:
    """Link what cannot be reached from node 0, using the last column."""
    n = len(links)
    seen = np.zeros(n, bool)
    front = np.zeros(1, np.int64)[:n]
    while True:
        seen[front] = True
        while len(front):
            front = np.unique(links[front])
            front = front[front >= 0]
            front = front[~seen[front]]
            seen[front] = True
        lost = np.flatnonzero(~seen)
        if not len(lost):
            return links
        free = np.flatnonzero(seen & (links[:, -1] < 0))
        nearest = free[np.argmax(vectors[free] @ vectors[lost[0]])]
        links[nearest, -1] = lost[0]
        front = lost[:1]


def build(ids: list, raw: np.ndarray, seed: int) -> dict:
    """One shard's graph: layer 0 holds all nodes, each further one some of them."""
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(raw))
    raw = raw[order]
    unit = (raw / np.linalg.norm(raw.astype(np.float64), axis=1, keepdims=True)).astype(np.float32)
    top = np.floor(-np.log(1 - draw.random(len(raw))) / np.log(LINKS)).astype(int)
    nodes, links = [], []
    for layer in range(top.max() + 1):
        here = np.flatnonzero(top >= layer)
        nodes.append(here.astype(np.int32))
        links.append(_layer(unit[here], LINKS * 2 if layer == 0 else LINKS).ravel())
    return {"ids": [ids[i] for i in order], "vectors": raw.astype(np.float32).ravel(), "nodes": nodes, "links": links}


def search(graph: dict, dim: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes found for each query, nearest first, and how near; -1 for none."""
    raw = np.asarray(graph["vectors"], np.float32).reshape(-1, dim)
    unit = (raw / np.linalg.norm(raw.astype(np.float64), axis=1, keepdims=True)).astype(np.float32)
    asked = (queries / np.linalg.norm(queries.astype(np.float64), axis=1, keepdims=True)).astype(np.float32)
    rows = np.arange(len(asked))
    # Every search starts at the first node of the top layer.
    at = np.full(len(asked), graph["nodes"][-1][0])
    for nodes, flat in zip(graph["nodes"][:0:-1], graph["links"][:0:-1]):
        nodes = np.asarray(nodes)
        links = np.asarray(flat).reshape(len(nodes), -1)
        own = np.searchsorted(nodes, at)
        best = np.einsum("qd,qd->q", unit[nodes[own]], asked)
        moving = rows
        while len(moving):
            near = links[own[moving]]
            sims = np.where(near >= 0, np.einsum("qnd,qd->qn", unit[nodes[near]], asked[moving]), -np.inf)
            pick = sims.argmax(axis=1)
            value = sims[np.arange(len(moving)), pick]
            better = value > best[moving]
            own[moving[better]] = near[np.arange(len(moving)), pick][better]
            best[moving[better]] = value[better]
            moving = moving[better]
        at = nodes[own]
    links = np.asarray(graph["links"][0]).reshape(len(unit), -1)
    beam = min(beam, len(unit))
    seen = np.zeros((len(asked), len(unit)), bool)
    found = np.full((len(asked), beam), -1)
    sims = np.full((len(asked), beam), -np.inf, np.float32)
    done = np.ones((len(asked), beam), bool)
    found[:, 0], sims[:, 0], done[:, 0] = at, np.einsum("qd,qd->q", unit[at], asked), False
    seen[rows, at] = True
    active = rows
    while len(active):
        # The nearest node not yet expanded; a full beam only holds nodes worth expanding.
        todo = np.where(done[active], -np.inf, sims[active])
        pick = todo.argmax(axis=1)
        going = todo[np.arange(len(active)), pick] > -np.inf
        active, pick = active[going], pick[going]
        if not len(active):
            break
        done[active, pick] = True
        near = links[found[active, pick]]
        fresh = (near >= 0) & ~seen[active[:, None], near]
        seen[active[:, None], np.where(near >= 0, near, found[active, pick][:, None])] = True
        value = np.where(fresh, np.einsum("qnd,qd->qn", unit[near], asked[active]), -np.inf).astype(np.float32)
        all_nodes = np.concatenate([found[active], np.where(fresh, near, -1)], axis=1)
        all_sims = np.concatenate([sims[active], value], axis=1)
        all_done = np.concatenate([done[active], ~fresh], axis=1)
        top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
        found[active] = np.take_along_axis(all_nodes, top, axis=1)
        sims[active] = np.take_along_axis(all_sims, top, axis=1)
        done[active] = np.take_along_axis(all_done, top, axis=1)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(found, order, axis=1), np.take_along_axis(sims, order, axis=1)


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def vectors_of(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, vector, dim) of the rows that take part."""
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector")))
    return rows.groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))


def index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The written index: one row per shard of about ``shard_rows`` distinct vectors."""
    first = Window.partitionBy("dim", "vector").orderBy("id")  # its limit is applied before the shuffle
    kept = vectors.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    nodes = materialize(kept.groupBy("dim", "vector").agg(F.sort_array(F.collect_list("id")).alias("ids")), "ann-nodes")
    sizes = nodes.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    dealt = nodes.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("ids"), F.col("shards")).cast("int"))

    def graph(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ids", key=lambda s: s.map(lambda x: x[0]))
        dim, shard = int(rows["dim"].iloc[0]), int(rows["shard"].iloc[0])
        return pd.DataFrame([{"dim": dim, "shard": shard, **build(rows["ids"].tolist(), np.stack(rows["vector"].tolist()), shard)}])

    return materialize(dealt.groupBy("dim", "shard").applyInPandas(graph, INDEX), "ann-index")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, beam: int = BEAM, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of ``vectors`` for each of ``queries``.

    Both have id, vector and dim; a query's own id is no candidate.
    """
    ship(vectors.sparkSession)
    bounded_batches(vectors.sparkSession)
    shards = index(vectors, k, shard_rows)
    blocks = queries.join(
        queries.groupBy("dim").agg(F.ceil(F.count("*") / QUERY_ROWS).alias("parts")), "dim"
    ).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    blocks = blocks.groupBy("dim", "part").agg(F.collect_list(F.struct("id", "vector")).alias("asked"))  # about QUERY_ROWS
    pairs = blocks.join(shards.select("dim", "shard"), "dim").join(shards, ["dim", "shard"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                graph = {c: batch.column(c)[row].as_py() for c in ("ids", "nodes", "links")}
                graph["vectors"] = batch.column("vectors")[row].values.to_numpy(zero_copy_only=False)
                dim = batch.column("dim")[row].as_py()
                asked = batch.column("asked")[row].values
                own = asked.field("id").to_numpy()
                wanted = asked.field("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                found, _ = search(graph, dim, wanted, beam)
                raw = graph["vectors"].reshape(-1, dim)
                out: tuple[list, list, list] = ([], [], [])
                for q, nodes in enumerate(found):
                    nodes = nodes[nodes >= 0][: 4 * (k + 1)]
                    scores = exact_cosine(raw[nodes], np.broadcast_to(wanted[q], (len(nodes), dim)))
                    hits = sorted((-s, i) for n, s in zip(nodes.tolist(), scores.tolist()) for i in graph["ids"][n] if i != own[q])[:k]
                    out[0].extend([own[q]] * len(hits))
                    out[1].extend(i for _, i in hits)
                    out[2].extend(-s for s, _ in hits)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["query_id", "vec_id", "score"])

    hits = pairs.mapInArrow(look, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
