"""Approximate nearest neighbours by cosine on robust-pruned directed graphs.

The vectors are dealt into shards of about ``shard_rows`` by a hash. In each shard a directed
graph is built: a greedy search from the medoid for each new vector proposes neighbours, and
robust pruning with a relaxed distance factor (``alpha``) keeps diverse edges, at most ``degree``
a vector; reverse edges are added and pruned alike. Queries, in blocks, run a beam search in
every shard; the best of all shards are scored exactly, in double precision.

Equal vectors are one node of a graph (else a vector that many rows share would fill every
neighbour list); a node stands for the smallest ``neighbours + 1`` ids of its copies, which is all
that the result can name. All rows are indexed and none is sampled.

Defined cases: NULL vectors, zero vectors and such with a NULL or non-finite component take no
part, nor do rows without a vec_id; a vec_id that repeats counts once, with the smallest of its
vectors; very small and very large vectors count by their direction like others; vectors are compared with those of their own length only; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import mix, written

SHARD_ROWS = 4_096
BLOCK_QUERIES = 512
DEGREE, BUILD_BEAM, BEAM, ALPHA = 24, 48, 64, 1.2


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors, each times the power of two that brings its largest component below 1, so that
    no square overflows or vanishes; a cosine stays the same to the bit."""
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    return np.ldexp(vectors, -np.frexp(largest)[1])


def _units(vectors: np.ndarray) -> np.ndarray:
    vectors = _scaled(vectors)
    return (vectors / np.linalg.norm(vectors.astype(np.float64), axis=1, keepdims=True)).astype(np.float32)


def beam_search(graph: np.ndarray, units: np.ndarray, start: int, queries: np.ndarray, beam: int, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each query the ``beam`` nearest nodes met (ids, -1 where fewer) and their distances.

    All queries advance together, each expanding its nearest unexpanded node a step. Only nodes
    below ``size`` (those inserted so far) are linked."""
    q, n = len(queries), len(units) if size is None else size
    ids = np.full((q, beam), -1, dtype=np.int32)
    dist = np.full((q, beam), np.inf, dtype=np.float32)
    done = np.zeros((q, beam), dtype=bool)
    seen = np.zeros((q, n + 1), dtype=bool)  # the last column swallows missing edges
    seen[:, -1] = True
    ids[:, 0], dist[:, 0], seen[:, start] = start, 1 - queries @ units[start], True
    active = np.arange(q)
    while len(active):
        open_dist = np.where(done[active] | (ids[active] < 0), np.inf, dist[active])
        pick = open_dist.argmin(axis=1)
        live = np.isfinite(open_dist[np.arange(len(active)), pick])
        active, pick = active[live], pick[live]
        if not len(active):
            break
        done[active, pick] = True
        near = graph[ids[active, pick]]
        near = np.where(near < 0, n, near)
        fresh = ~seen[active[:, None], near]
        seen[active[:, None], near] = True
        row, col = np.nonzero(fresh)
        if not len(row):
            continue
        new = np.full(near.shape, np.inf, dtype=np.float32)
        new[row, col] = 1 - np.einsum("ij,ij->i", queries[active[row]], units[near[row, col]])
        all_dist = np.concatenate([dist[active], new], axis=1)
        all_ids = np.concatenate([ids[active], np.where(fresh, near, -1)], axis=1)
        all_done = np.concatenate([done[active], np.zeros(near.shape, dtype=bool)], axis=1)
        order = np.argpartition(all_dist, beam - 1, axis=1)[:, :beam]
        dist[active] = np.take_along_axis(all_dist, order, 1)
        ids[active] = np.take_along_axis(all_ids, order, 1)
        done[active] = np.take_along_axis(all_done, order, 1)
    order = np.argsort(dist, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)


def robust_prune(units: np.ndarray, node: int, pool: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Diverse neighbours of ``node`` out of ``pool``: the nearest stays and drops those that it is
    nearer to, by the factor ``alpha``, than the node is."""
    pool = np.unique(pool[(pool >= 0) & (pool != node)])
    mine = 1 - units[pool] @ units[node]
    order = np.argsort(mine, kind="stable")
    pool, mine = pool[order], mine[order]
    between = 1 - units[pool] @ units[pool].T
    alive = np.ones(len(pool), dtype=bool)
    kept = []
    for i in range(len(pool)):
        if alive[i]:
            kept.append(pool[i])
            if len(kept) == degree:
                break
            alive &= alpha * between[i] > mine
    return np.array(kept, dtype=np.int32)


def build_graph(units: np.ndarray, *, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """(edges padded with -1, start node). Nodes come in batches that double up to 256."""
    n = len(units)
    graph = np.full((n, degree), -1, dtype=np.int32)
    centre = units.mean(axis=0)
    start = int((units @ centre).argmax())
    order = np.arange(n)
    order = np.concatenate([[start], order[order != start]]).astype(np.int32)
    at = 1
    while at < n:
        batch = order[at : at + min(max(1, at), 256)]
        pools, _ = beam_search(graph, units, start, units[batch], beam, n)
        reverse: dict[int, list[int]] = {}
        for node, pool in zip(batch, pools):
            kept = robust_prune(units, node, pool, degree, alpha)
            graph[node, : len(kept)] = kept
            for k in kept:
                reverse.setdefault(int(k), []).append(int(node))
        for k, more in reverse.items():
            has = graph[k][graph[k] >= 0]
            pool = np.concatenate([has, np.array(more, dtype=np.int32)])
            if len(np.unique(pool)) > degree:
                pool = robust_prune(units, k, pool, degree, alpha)
            else:
                pool = np.unique(pool)
            graph[k] = -1
            graph[k, : len(pool)] = pool
        at += len(batch)
    return graph, start


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id (long), vec (array<double>), dim of the rows that take part, one a vec_id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("vec").alias("vec")).withColumn("dim", F.size("vec"))


def _nodes(rows: DataFrame, ids: int) -> DataFrame:
    """One row a distinct vector: vec, dim, node (its smallest id), members (its ``ids`` smallest).

    Copies are ranked in salted groups first, so that a vector a third of all rows share is
    spread over tasks until few ids of it are left."""
    salted = Window.partitionBy("vec", "salt").orderBy("vec_id")
    whole = Window.partitionBy("vec").orderBy("vec_id")
    part = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64))).withColumn("k", F.row_number().over(salted)).where(F.col("k") <= ids)
    part = part.withColumn("k", F.row_number().over(whole)).where(F.col("k") <= ids)
    return part.groupBy("vec", "dim").agg(F.sort_array(F.collect_list("vec_id")).alias("members")).withColumn("node", F.col("members")[0])


def build_index(vectors: DataFrame, *, shard_rows: int = SHARD_ROWS, ids: int = 6, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> DataFrame:
    """One row a shard: dim, shard, start, nodes, members, vectors and edges as packed arrays
    (a few MB, whatever the table). ``vectors`` as made by :func:`usable`."""
    nodes = written(_nodes(vectors, ids), "ann-nodes")
    counts = nodes.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    dealt = nodes.join(F.broadcast(counts.limit(10_000)), "dim") if counts.count() <= 10_000 else nodes.join(counts, "dim")
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "node"), F.col("shards")))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        # Insertion in a scrambled order, the same on every attempt.
        pdf = pdf.iloc[np.argsort(mix(pdf["node"].to_numpy().astype(np.int64).view(np.uint64)), kind="stable")]
        vec = np.array(pdf["vec"].tolist(), dtype=np.float64)
        graph, start = build_graph(_units(vec), degree=degree, beam=beam, alpha=alpha)
        members = np.full((len(pdf), ids), np.iinfo(np.int64).min)
        for i, m in enumerate(pdf["members"]):
            members[i, : len(m)] = m
        return pd.DataFrame({"dim": [vec.shape[1]], "shard": [int(pdf["shard"].iloc[0])], "start": [start], "members": [members.tobytes()], "vectors": [vec.tobytes()], "edges": [graph.tobytes()]})

    schema = "dim int, shard long, start int, members binary, vectors binary, edges binary"
    return written(dealt.groupBy("dim", "shard").applyInPandas(build, schema), "ann-index")


def search(index: DataFrame, queries: DataFrame, *, neighbours: int = 5, beam: int = BEAM, ids: int = 6, degree: int = DEGREE, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found for each row of ``queries`` (vec_id, vec,
    dim), itself excluded; ``index`` holds ``ids`` > ``neighbours`` members a node."""
    counts = queries.groupBy("dim").agg(F.ceil(F.count("*") / block_queries).alias("blocks"))
    # The blocks of a query set meet every shard: rows of packed blocks, not of single queries.
    dealt = queries.join(counts, "dim").withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.col("blocks")))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        return pd.DataFrame({"dim": [int(pdf["dim"].iloc[0])], "block": [int(pdf["block"].iloc[0])], "query_ids": [pdf["vec_id"].to_numpy(dtype=np.int64).tobytes()], "query_vectors": [np.array(pdf["vec"].tolist(), dtype=np.float64).tobytes()]})

    packed = written(dealt.select("vec_id", "vec", "dim", "block").groupBy("dim", "block").applyInPandas(pack, "dim int, block long, query_ids binary, query_vectors binary"), "ann-queries")
    spread = index.join(counts.withColumn("dim", F.col("dim").cast("int")), "dim").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pairs = spread.join(packed, ["dim", "block"]).repartition(max(8, int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                vec = np.frombuffer(r.vectors, dtype=np.float64).reshape(-1, r.dim)
                graph = np.frombuffer(r.edges, dtype=np.int32).reshape(-1, degree)
                members = np.frombuffer(r.members, dtype=np.int64).reshape(len(vec), ids)
                qid = np.frombuffer(r.query_ids, dtype=np.int64)
                qvec = np.frombuffer(r.query_vectors, dtype=np.float64).reshape(-1, r.dim)
                found, _ = beam_search(graph, _units(vec), r.start, _units(qvec), beam)
                row, col = np.nonzero(found >= 0)
                at = found[row, col]
                vec, qvec = _scaled(vec), _scaled(qvec)
                dot = np.einsum("ij,ij->i", qvec[row], vec[at])
                score = dot / (np.sqrt(np.einsum("ij,ij->i", qvec, qvec))[row] * np.sqrt(np.einsum("ij,ij->i", vec, vec))[at])
                out = pd.DataFrame({"query_id": np.repeat(qid[row], ids), "vec_id": members[at].ravel(), "score": np.repeat(score, ids)})
                out = out[(out.vec_id != np.iinfo(np.int64).min) & (out.vec_id != out.query_id)]
                out = out.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).groupby("query_id").head(neighbours)
                yield out

    near = pairs.select("dim", "start", "members", "vectors", "edges", "query_ids", "query_vectors").mapInPandas(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= neighbours).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(vectors: DataFrame, *, every: int = 50, neighbours: int = 5, **build) -> DataFrame:
    """The nearest of all rows for each row whose vec_id is divisible by ``every``."""
    rows = written(usable(vectors), "ann-vectors")
    index = build_index(rows, ids=neighbours + 1, **build)
    return search(index, rows.where(F.col("vec_id") % every == 0), neighbours=neighbours, ids=neighbours + 1)
