"""Embedding near-dedup over a robust-pruned flat graph.

1. Identical vectors are folded to one with a multiplicity.
2. Centroids (spherical k-means) are fitted on at most ``sample`` vectors;
   every vector goes to its ``overlap`` nearest centroids.  A shard of more
   than ``block`` vectors is split into pairs of blocks, so that no task holds
   more than two blocks and no pair of the shard is lost.
3. Each group builds a graph: a pool of near candidates per vector, robust
   pruned (a candidate goes if a kept neighbour is ``alpha`` times nearer to it).
4. The adjacency lists of a vector from all its groups are united.
5. Each group searches its part of the united graph for each of its vectors:
   greedy beam search from the medoid, then range expansion through every
   vector found within reach of the threshold until none is new.
6. Hits are verified by the cosine in double precision.  A pair counts in its
   owner group only (its smallest common shard), so counts are exact sums.
7. The recall of links is audited against brute force for ``audit`` vectors
   against all; below ``target`` the search is run again with more overlap.

Defined cases: null, zero, empty, or non-finite vectors, and vectors with null
components, link with nothing (n_links 0, own component, kept); vectors of
different lengths never link; a row that repeats exactly is one vector, an id
that repeats with another vector is another vector; null ids sort first and
come back as null; other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import group_starts, id_in, id_out, sorted_runs, to_batches, written
from corpusforge.llm.components import connected_components
from corpusforge.operators.skew import hot_keys, join_hot


def unit(rows: list) -> np.ndarray:
    """Rows of any length, padded with zeros, as unit vectors in double."""
    width = max((len(r) for r in rows), default=1)
    x = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        x[i, :len(r)] = r
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


def _fit(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    c = x[np.random.default_rng(7).permutation(len(x))[:k]]
    for _ in range(rounds):
        near = np.concatenate([(x[i:i + 4096] @ c.T).argmax(axis=1) for i in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.sqrt((total * total).sum(axis=1, keepdims=True))
        c = np.where(norm > 1e-9, total / np.maximum(norm, 1e-300), c)
    return c


def robust_prune(x: np.ndarray, pool: int = 64, degree: int = 24, alpha: float = 1.2) -> list[np.ndarray]:
    """Adjacency lists: nearest candidates, without those that a kept
    neighbour is alpha times nearer to; the rest of the degree is filled with
    the nearest left, and every list gets a next neighbour so the graph hangs together."""
    n = len(x)
    pool, out = min(pool, n - 1), []
    for s in range(0, n, 512):
        sim = x[s:s + 512] @ x.T
        me = np.arange(s, min(n, s + 512))
        sim[np.arange(len(me)), me] = -2
        cand = np.argpartition(-sim, pool - 1, axis=1)[:, :pool] if pool else np.zeros((len(me), 0), int)
        near = np.take_along_axis(sim, cand, 1)
        by = np.argsort(-near, axis=1, kind="stable")
        cand, dist = np.take_along_axis(cand, by, 1), np.sqrt(np.maximum(2 - 2 * np.take_along_axis(near, by, 1), 0))
        alive = np.ones(cand.shape, bool)
        kept = np.zeros(cand.shape, bool)
        for _ in range(min(degree, pool)):
            first = np.where(alive.any(axis=1), alive.argmax(axis=1), -1)
            rows = np.flatnonzero(first >= 0)
            if not len(rows):
                break
            kept[rows, first[rows]] = True
            chosen = x[cand[rows, first[rows]]]
            between = np.sqrt(np.maximum(2 - 2 * np.einsum("nd,ncd->nc", chosen, x[cand[rows]]), 0))
            alive[rows] &= alpha * between > dist[rows]
            alive[rows, first[rows]] = False
        for i, row in enumerate(me.tolist()):
            out.append(np.unique(np.concatenate([cand[i][kept[i]], cand[i][:4], [(row + 1) % n]])))
    return out


def range_search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, reach: float, beam: int = 32) -> np.ndarray:
    """Boolean (queries, n): vectors met with cosine >= reach.  ``graph``:
    neighbour rows, -1 for none."""
    n, q = len(x), len(queries)
    xq = x[queries]
    medoid = int((x @ x.mean(axis=0)).argmax())
    seen = np.zeros((q, n), bool)
    seen[:, medoid] = True
    ids = np.full((q, beam), -1)
    val = np.full((q, beam), -2.0)
    done = np.ones((q, beam), bool)
    ids[:, 0], val[:, 0], done[:, 0] = medoid, xq @ x[medoid], False
    hit = np.zeros((q, n), bool)
    hit[:, medoid] = val[:, 0] >= reach
    every = np.arange(q)

    def visit(rows, nodes):
        """Similarities of the unseen neighbours of ``nodes`` (per row)."""
        nb = graph[nodes]
        fresh = (nb >= 0) & ~seen[rows[:, None], nb]
        r, c = np.nonzero(fresh)
        t = nb[r, c]
        _, once = np.unique(rows[r] * n + t, return_index=True)      # two nodes may share a neighbour
        r, c, t = r[once], c[once], t[once]
        s = np.einsum("nd,nd->n", xq[rows[r]], x[t])
        seen[rows[r], t] = True
        ok = s >= reach
        hit[rows[r][ok], t[ok]] = True
        return r, c, t, s, ok, nb.shape[1]

    while True:
        pick = np.where(done, -3.0, val).argmax(axis=1)
        live = np.flatnonzero(~done[every, pick])
        if not len(live):
            break
        done[live, pick[live]] = True
        r, c, t, s, _, width = visit(live, ids[live, pick[live]])
        add_ids, add_val = np.full((len(live), width), -1), np.full((len(live), width), -2.0)
        add_ids[r, c], add_val[r, c] = t, s
        all_ids = np.concatenate([ids[live], add_ids], axis=1)
        all_val = np.concatenate([val[live], add_val], axis=1)
        all_done = np.concatenate([done[live], add_ids < 0], axis=1)
        top = np.argpartition(-all_val, beam - 1, axis=1)[:, :beam]
        ids[live], val[live], done[live] = (np.take_along_axis(a, top, 1) for a in (all_ids, all_val, all_done))
    rows, nodes = np.nonzero(hit)                                    # expand through all in reach
    while len(rows):
        new_r, new_t = [], []
        for i in range(0, len(rows), 8192):
            part = rows[i:i + 8192]
            r, _, t, _, ok, _ = visit(part, nodes[i:i + 8192])
            new_r.append(part[r[ok]])
            new_t.append(t[ok])
        rows, nodes = np.concatenate(new_r), np.concatenate(new_t)
    return hit


def _search_group(uid, vecs, dim, mult, shards, block, shard, bi, bj, lists, threshold, slack):
    """-> (link counts per row, forest edges)."""
    x = unit(vecs)
    n = len(uid)
    counts, edges = np.zeros(n, np.int64), []
    if n < 2:
        return counts, edges
    by = np.argsort(uid)
    width = max(map(len, lists))
    graph = np.full((n, max(width, 1)), -1)
    for i, a in enumerate(lists):
        at = np.searchsorted(uid[by], a)
        ok = (at < n) & (uid[by][np.minimum(at, n - 1)] == a)
        mine = by[at[ok]]
        graph[i, :len(mine)] = mine
    up = list(range(n))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i
    met = np.zeros((n, n), bool)
    for s in range(0, n, 256):
        met[s:s + 256] = range_search(x, graph, np.arange(s, min(n, s + 256)), threshold - slack)
    met |= met.T
    for s in range(0, n, 256):
        i, j = np.nonzero(met[s:s + 256])
        i = i + s
        use = (i != j) & (dim[i] == dim[j])
        i, j = i[use], j[use]
        good = np.zeros(len(i), bool)
        for c in range(0, len(i), 50_000):
            good[c:c + 50_000] = np.einsum("nd,nd->n", x[i[c:c + 50_000]], x[j[c:c + 50_000]]) >= threshold
        i, j = i[good], j[good]
        common = shards[i][:, :, None] == shards[j][:, None, :]
        owner = np.where(common.any(axis=2), shards[i], np.iinfo(np.int64).max).min(axis=1)
        own = (owner == shard) & (np.minimum(block[i], block[j]) == bi) & (np.maximum(block[i], block[j]) == bj)
        counts += np.bincount(i[own], weights=mult[j[own]], minlength=n).astype(np.int64)
        for a, b in zip(i.tolist(), j.tolist()):
            ra, rb = find(a), find(b)
            if ra != rb:
                up[max(ra, rb)] = min(ra, rb)
                edges.append((uid[a], uid[b]))
    return counts, edges


_KEYS = ["shard", "bi", "bj"]


def _grouped(placed: DataFrame, extra: list[str]) -> DataFrame:
    cols = ["uid", "vec", "mult", "shards", "blk", *_KEYS, *extra]
    return placed.select(*cols).repartition(*_KEYS).sortWithinPartitions(*_KEYS, "uid")


def _place(reps: DataFrame, n: int, overlap: int, block: int, sample: int, per_shard: int) -> DataFrame:
    """Rows of every vector in each of its groups (shard, bi, bj)."""
    k = int(max(1, min(n * overlap // per_shard, sample // 8)))
    rows = reps.select("uid", "vec").orderBy(F.xxhash64("uid"), "uid").limit(min(sample, 40 * k)).collect()
    centres = _fit(unit([r.vec for r in rows]), k)
    shared = reps.sparkSession.sparkContext.broadcast(centres)       # at most sample / 8 vectors

    def assign(batches):
        c = shared.value
        top = min(overlap, len(c))
        for b in batches:
            x = unit(b.column(1).to_pylist())
            d = min(x.shape[1], c.shape[1])
            sim = x[:, :d] @ c[:, :d].T
            near = np.argsort(-sim, axis=1, kind="stable")[:, :top]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(list(near.astype(np.int64)), pa.list_(pa.int64()))],
                                             names=["uid", "vec", "mult", "shards"])
    a = written(reps.select("uid", "vec", "mult").mapInArrow(assign, "uid long, vec array<double>, mult long, shards array<long>"), "vec-shards")
    rows = a.withColumn("shard", F.explode("shards"))
    size = rows.groupBy("shard").agg(F.count("*").alias("size")).select("shard", F.ceil(F.col("size") / block).alias("nb"))
    return (rows.join(size, "shard").withColumn("blk", F.pmod(F.xxhash64("uid"), F.col("nb")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
            .withColumn("bi", F.least("blk", "other")).withColumn("bj", F.greatest("blk", "other")).drop("other", "nb"))


def _links(reps: DataFrame, n: int, threshold: float, overlap: int, block: int, sample: int, per_shard: int, slack: float):
    placed = _place(reps, n, overlap, block, sample, per_shard)

    def build(batches):
        schema = pa.schema([("uid", pa.int64()), ("nbrs", pa.list_(pa.int64()))])
        for t in sorted_runs(batches, _KEYS, 2000):
            cuts = np.append(group_starts(t, _KEYS), t.num_rows)
            for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                uid = t.column("uid").to_numpy()[s:e]
                if e - s > 1:
                    lists = robust_prune(unit(t.column("vec").slice(s, e - s).to_pylist()))
                    yield from to_batches(schema, [uid, [uid[a] for a in lists]])
    united = (_grouped(placed, []).mapInArrow(build, "uid long, nbrs array<long>")
              .groupBy("uid").agg(F.array_distinct(F.flatten(F.collect_list("nbrs"))).alias("nbrs")))

    def search(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
        for t in sorted_runs(batches, _KEYS, 2000):
            cuts = np.append(group_starts(t, _KEYS), t.num_rows)
            key = [t.column(c).to_numpy() for c in _KEYS]
            for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                part = t.slice(s, e - s)
                uid, mult, blk = (part.column(c).to_numpy() for c in ("uid", "mult", "blk"))
                vecs = part.column("vec").to_pylist()
                lists = [np.array(a or [], np.int64) for a in part.column("nbrs").to_pylist()]
                counts, edges = _search_group(uid, vecs, np.array([len(v) for v in vecs]), mult,
                                              np.array(part.column("shards").to_pylist()), blk,
                                              key[0][s], key[1][s], key[2][s], lists, threshold, slack)
                some = np.flatnonzero(counts)
                yield from to_batches(schema, [
                    np.concatenate([uid[some], np.array([a for a, _ in edges], np.int64)]),
                    np.concatenate([uid[some], np.array([b for _, b in edges], np.int64)]),
                    np.concatenate([counts[some], np.zeros(len(edges), np.int64)])])
    with_lists = placed.join(united, "uid", "left")
    return written(_grouped(with_lists, ["nbrs"]).mapInArrow(search, "a long, b long, n long"), "vec-links")


def brute_links(reps: DataFrame, queries: list, threshold: float) -> dict[int, int]:
    """True link counts of a bounded list of (uid, vec) against all rows."""
    shared = reps.sparkSession.sparkContext.broadcast((np.array([u for u, _ in queries]), unit([v for _, v in queries]),
                                                       np.array([len(v) for _, v in queries])))

    def run(batches):
        uid, q, dim = shared.value
        total = np.zeros(len(uid), np.int64)
        for b in batches:
            vecs = b.column(1).to_pylist()
            x = unit(vecs)
            d = min(x.shape[1], q.shape[1])
            ok = (x[:, :d] @ q[:, :d].T >= threshold) & (np.array([len(v) for v in vecs])[:, None] == dim[None, :])
            ok &= b.column(0).to_numpy()[:, None] != uid[None, :]
            total += (ok * b.column(2).to_numpy()[:, None]).sum(axis=0)
        yield from to_batches(pa.schema([("uid", pa.int64()), ("n", pa.int64())]), [uid, total])
    rows = reps.select("uid", "vec", "mult").mapInArrow(run, "uid long, n long").groupBy("uid").agg(F.sum("n").alias("n")).collect()
    return {r.uid: r.n for r in rows}


def embedding_dedup(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9,
                    overlap: int = 3, block: int = 1500, sample: int = 20_000, per_shard: int = 1000, slack: float = 0.1,
                    audit: int = 200, target: float = 0.98, report: dict | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per input row.  ``report`` gets the
    audited recall and the overlap used."""
    v = F.col(vec_col).cast("array<double>")
    bad = F.col("vec").isNull() | F.exists("vec", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) | \
        ~F.exists("vec", lambda e: e != 0)
    rows = vectors.select(id_in(id_col).alias("id"), v.alias("vec")).withColumn("ok", ~F.coalesce(bad, F.lit(True)))
    rows = rows.withColumn("uid", F.when(F.col("ok"), F.xxhash64("vec")))
    one = rows.where("ok").select("id", "uid", "vec").dropDuplicates(["id", "uid"])
    reps = written(one.groupBy("uid").agg(F.first("vec").alias("vec"), F.count("*").alias("mult"), F.min("id").alias("rep")), "vec-distinct")
    n = reps.count()
    found = None
    if n:
        asked = [(r.uid, r.vec) for r in reps.select("uid", "vec").orderBy(F.xxhash64("uid", F.lit(1)), "uid").limit(audit).collect()]
        true = brute_links(reps, asked, threshold)
        while True:
            found = _links(reps, n, threshold, overlap, block, sample, per_shard, slack)
            got = {r.a: r.n for r in found.where(F.col("n") > 0).join(
                F.broadcast(reps.sparkSession.createDataFrame([(u,) for u, _ in asked], "a long")), "a").groupBy("a").agg(F.sum("n").alias("n")).collect()}
            want = sum(true.values())
            recall = sum(min(got.get(u, 0), t) for u, t in true.items()) / want if want else 1.0
            if report is not None:
                report.update(recall=recall, overlap=overlap, links=want)
            if recall >= target or overlap >= 24:
                break
            overlap *= 2
        counts = found.where("n > 0").groupBy(F.col("a").alias("uid")).agg(F.sum("n").alias("n"))
        comp = connected_components(found.where("n = 0").select(F.col("a").alias("u"), F.col("b").alias("v")))
        named = comp.select(F.col("node").alias("uid"), "component").join(reps, "uid")
        least = named.groupBy("component").agg(F.min("rep").alias("least"), F.count("*").alias("size"))
        label = join_hot(named, least.select("component", "least"), "component", hot_keys(least, "component", "size"),
                         F.col("uid")).select("uid", "least")
        info = (reps.join(counts, "uid", "left").join(label, "uid", "left")
                .select("uid", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("least", "rep").alias("component")))
    else:
        info = reps.select("uid", F.col("mult").alias("n_links"), F.col("rep").alias("component"))
    # one vector may belong to a third of all rows
    out = join_hot(rows.select("id", "uid"), info, "uid", hot_keys(reps, "uid", "mult"), F.col("id"), "left")
    component = F.coalesce("component", "id")
    return out.select(id_out("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      id_out(component).alias("component_id"), (F.col("id") == component).alias("kept"))
