"""Approximate nearest neighbours by cosine, over one robust-pruned directed graph per shard.

Vectors are dealt to shards by the hash of their id. A shard's graph starts random; then every point is
looked for by greedy search, and of the points met on the way, and its neighbours so far, those are kept that no
nearer kept one is ``alpha`` times closer to (Subramanya and others, 2019). Edges are added backwards too, and a
list that grows too long is pruned in the same way. A first pass prunes with alpha 1, a second one with the relaxed
alpha. Queries go to every shard, where a beam search finds their neighbours; the shards' best are merged.

Searches start from landmarks, half of them dealt by chance and half each the farthest from all before it, and from one
point of every part of the graph that these do not reach; so rows in tight groups without edges between them are found too. How
wide a beam must be hangs on the rows: of every batch of queries some are compared with all points of the shard, and
the batch is searched again with twice the beam while too many of their neighbours are missed.

A task holds one shard at a time, which has a bounded number of rows; its queries pass through in Arrow batches and are
never gathered. Vectors of one direction are one point. Points are searched and pruned many at once, in numpy.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grantlens.llm.vectors import is_usable, unit

SHARD_ROWS = 16_000
DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA = 32, 64, 32, 1.2
WIDTH = 4  # points of a beam that are expanded at once; of wide beams a sixteenth
BATCH = 128
LANDMARKS = 4  # times the root of the number of points
CHECKED, REACHED = 32, 0.98  # queries of a batch that are compared with all points, and the share of neighbours to find
AT_ONCE = 8_000_000  # components in a block of differences


class PrunedGraph:
    """The graph over the rows of ``points``, unit vectors all different."""

    def __init__(self, points: np.ndarray, degree=DEGREE, beam=BUILD_BEAM, alpha=ALPHA, seed=7):
        # Moved to their mean, so that single precision is enough for points that are close to each other.
        self.origin = points.mean(axis=0)
        self.points, self.degree = (points - self.origin).astype(np.float32), degree
        n = len(points)
        random = np.random.default_rng(seed)
        self.visited = 0  # distances that searches computed
        self.entries = self._landmarks(random, min(n, math.ceil(LANDMARKS * math.sqrt(n))))
        self.edges = np.full((n, degree), -1, dtype=np.int32)
        if n > 1:
            start = random.integers(0, n - 1, size=(n, min(degree, n - 1)))
            start += start >= np.arange(n)[:, None]
            self.edges[:, : start.shape[1]] = start
        for stretch in (1.0, alpha):
            order = random.permutation(n)
            for at in range(0, n, BATCH):
                self._insert(order[at : at + BATCH], beam, stretch)
        self._reach_all()

    def _landmarks(self, random, count: int) -> np.ndarray:
        """The point nearest to the mean, some by chance, and then each time the point farthest from all so far."""
        norms = np.einsum("ij,ij->i", self.points, self.points)
        far = np.full(len(self.points), np.inf, dtype=np.float32)
        found = [int(norms.argmin()), *random.permutation(len(self.points))[: count // 2].tolist()]
        for at in range(count):
            if at == len(found):
                found.append(int(far.argmax()))
            far = np.minimum(far, norms - 2 * (self.points @ self.points[found[at]]) + norms[found[at]])
        return np.unique(found).astype(np.int32)

    def _reach_all(self) -> None:
        """Adds an entry for every part of the graph that the entries do not lead to."""
        reached = np.zeros(len(self.points), dtype=bool)
        added, fresh, at = [], self.entries, 0
        while True:
            while len(fresh):
                reached[fresh] = True
                near = np.unique(self.edges[fresh])
                near = near[near >= 0]
                fresh = near[~reached[near]]
            while at < len(reached) and reached[at]:
                at += 1
            if at == len(reached):
                break
            added.append(at)
            fresh = np.array([at], dtype=np.int32)
        self.entries = np.concatenate([self.entries, np.array(added, dtype=np.int32)])

    def _distances(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances of each query to its row of ids; infinite for -1."""
        found = np.empty(ids.shape, dtype=np.float32)
        step = max(1, AT_ONCE // max(1, queries.size))
        for at in range(0, ids.shape[1], step):
            apart = self.points[ids[:, at : at + step]]
            apart -= queries[:, None, :]
            np.einsum("bcd,bcd->bc", apart, apart, out=found[:, at : at + step])
        found[ids < 0] = np.inf
        return found

    def find(self, queries: np.ndarray, beam: int):
        """(ids, distances) of the beams of unit vectors, nearest first."""
        return self.search((queries - self.origin).astype(np.float32), beam)

    def search(self, queries: np.ndarray, beam: int, met: bool = False):
        """(ids, distances) of the beams, nearest first; with ``met`` the ids of all expanded points.

        ``queries`` are moved as the points are.
        """
        count, n = len(queries), len(self.points)
        lanes = np.arange(count)[:, None]
        starts = np.broadcast_to(self.entries, (count, len(self.entries)))
        far = self._distances(queries, starts)
        self.visited += far.size
        if far.shape[1] > beam:
            keep = np.argpartition(far, beam - 1, axis=1)[:, :beam]
            ids, far = np.take_along_axis(starts, keep, axis=1), np.take_along_axis(far, keep, axis=1)
        else:
            blank = ((0, 0), (0, beam - far.shape[1]))
            ids, far = np.pad(starts, blank, constant_values=-1), np.pad(far, blank, constant_values=np.inf)
        done = np.zeros((count, beam), dtype=bool)
        seen = np.zeros((count, n + 1), dtype=bool)  # the last column takes what -1 marks
        seen[:, self.entries] = True
        expanded = []
        while True:
            waiting = np.where(done, np.inf, far)
            width = min(max(WIDTH, beam // 16), beam)
            best = np.argpartition(waiting, width - 1, axis=1)[:, :width]
            open_ = np.isfinite(np.take_along_axis(waiting, best, axis=1))
            if not open_.any():
                break
            chosen = np.where(open_, np.take_along_axis(ids, best, axis=1), -1)
            expanded.append(chosen)
            done[lanes, best] = True
            near = np.where(chosen[:, :, None] >= 0, self.edges[chosen], -1).reshape(count, -1)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[lanes, near]] = -1
            seen[lanes, near] = True
            seen[:, -1] = False
            fresh = self._distances(queries, near)
            self.visited += int((near >= 0).sum())
            ids, far = np.concatenate([ids, near], axis=1), np.concatenate([far, fresh], axis=1)
            done = np.concatenate([done, np.zeros(near.shape, dtype=bool)], axis=1)
            keep = np.argpartition(far, beam - 1, axis=1)[:, :beam]
            ids, far, done = (np.take_along_axis(x, keep, axis=1) for x in (ids, far, done))
        if met:
            return np.concatenate([ids, *expanded], axis=1)
        order = np.argsort(far, axis=1, kind="stable")
        return np.take_along_axis(ids, order, axis=1), np.take_along_axis(far, order, axis=1)

    def _prune(self, rows: np.ndarray, candidates: np.ndarray, stretch: float) -> np.ndarray:
        """Of each row's candidates the kept ones, nearest first, padded with -1."""
        candidates = np.sort(candidates, axis=1)
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        candidates[candidates == rows[:, None]] = -1
        far = self._distances(self.points[rows], candidates)
        order = np.argsort(far, axis=1, kind="stable")
        candidates, far = (np.take_along_axis(x, order, axis=1) for x in (candidates, far))
        width = int(np.isfinite(far).sum(axis=1).max(initial=0))
        candidates, far = candidates[:, :width], far[:, :width]
        spots = self.points[candidates] - self.points[rows][:, None, :]
        between = np.matmul(spots, spots.transpose(0, 2, 1))
        sizes = np.einsum("bcd,bcd->bc", spots, spots)
        between = np.maximum(sizes[:, :, None] + sizes[:, None, :] - 2 * between, 0) * stretch**2
        alive, kept = np.isfinite(far), np.full((len(rows), self.degree), -1, dtype=np.int32)
        counts = np.zeros(len(rows), dtype=np.int64)
        for at in range(width):
            take = np.flatnonzero(alive[:, at] & (counts < self.degree))
            if not len(take):
                continue
            kept[take, counts[take]] = candidates[take, at]
            counts[take] += 1
            alive[take] &= between[take, at] > far[take]
        return kept

    def _insert(self, rows: np.ndarray, beam: int, stretch: float) -> None:
        met = self.search(self.points[rows], beam, met=True)
        kept = self._prune(rows, np.concatenate([met, self.edges[rows]], axis=1), stretch)
        self.edges[rows] = kept
        # Backward edges: the new sources of each target.
        source, target = np.repeat(rows, self.degree), kept.ravel()
        source, target = source[target >= 0].astype(np.int32), target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        targets, first, counts = np.unique(target, return_index=True, return_counts=True)
        for at in range(0, len(targets), 512):
            part = slice(at, at + 512)
            some, most = targets[part], int(counts[part].max(initial=0))
            new = np.full((len(some), most), -1, dtype=np.int32)
            for line, (a, c) in enumerate(zip(first[part], counts[part])):
                new[line, :c] = source[a : a + c]
            have = self.edges[some]
            new[(new[:, :, None] == have[:, None, :]).any(axis=2)] = -1
            both = np.concatenate([have, new], axis=1)
            fits = (both >= 0).sum(axis=1) <= self.degree
            if fits.any():
                packed = -np.sort(-both[fits], axis=1)[:, : self.degree]
                self.edges[some[fits]] = packed
            if (~fits).any():
                self.edges[some[~fits]] = self._prune(some[~fits], both[~fits], stretch)


def runs(batches, width: int):
    """(first ``width`` values, rows) of stretches of batches in which these values are equal."""
    for batch in batches:
        changed = np.zeros(batch.num_rows, dtype=bool)
        changed[:1] = True
        for k in range(width):
            values = batch.column(k).to_numpy(zero_copy_only=False)
            changed[1:] |= values[1:] != values[:-1]
        starts = [*np.flatnonzero(changed).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            yield tuple(batch.column(k)[a].as_py() for k in range(width)), batch.slice(a, b - a)


class Shard:
    """The graph over a shard's directions, and which ids have each of them."""

    def __init__(self, ids: np.ndarray, raw: np.ndarray, most: int):
        units = unit(raw)
        # Multiples of a vector differ in the last bits of their unit vectors.
        _, first, inverse = np.unique(np.round(units, 12) + 0.0, axis=0, return_index=True, return_inverse=True)
        self.units = units[first]
        order = np.lexsort((ids, inverse.ravel()))
        starts = np.searchsorted(inverse.ravel()[order], np.arange(len(first)))
        # Of a direction's ids the lowest ``most`` can ever be among the nearest.
        self.owners = [np.unique(part)[:most].tolist() for part in np.split(ids[order], starts[1:])]
        self.graph = PrunedGraph(self.units)
        self.beam = 0  # that the queries so far needed

    def _beams(self, wanted: np.ndarray, k: int, beam: int) -> np.ndarray:
        """The points found for each query; some queries are looked at in full to see whether the beam is wide enough."""
        n = len(self.units)
        beam = min(max(beam, self.beam), n)
        some = np.linspace(0, len(wanted) - 1, min(CHECKED, len(wanted))).astype(int)
        full = wanted[some] @ self.units.T
        least = np.partition(full, n - min(k, n), axis=1)[:, n - min(k, n)]
        while True:
            found, _ = self.graph.find(wanted, beam)
            near = np.take_along_axis(full, np.maximum(found[some], 0), axis=1)
            hits = ((near >= least[:, None] - 1e-15) & (found[some] >= 0)).sum(axis=1)
            if beam == n or np.minimum(hits, min(k, n)).sum() >= REACHED * min(k, n) * len(some):
                break
            beam = min(2 * beam, n)
        self.beam = beam
        return found

    def ask(self, ids: np.ndarray, wanted: np.ndarray, k: int, beam: int):
        """(query id, id, cosine) of each query's ``k`` nearest in the shard, ties to the lower id."""
        found = self._beams(wanted, k + 1, beam)
        for query, vector, points in zip(ids.tolist(), wanted, found):
            points = points[points >= 0]
            scores = np.einsum("ij,j->i", self.units[points], vector)
            # One place may be the query's own; all that tie with the last one stay.
            near = scores >= np.sort(scores)[::-1][: k + 1][-1]
            pairs = sorted(
                (-s, i) for s, p in zip(scores[near].tolist(), points[near]) for i in self.owners[p] if i != query
            )
            yield from ((query, i, -s) for s, i in pairs[:k])


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    shard_rows: int = SHARD_ROWS,
    beam: int = SEARCH_BEAM,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, ties to the lower vec_id.

    score is the cosine in double precision. A query's own vec_id is no candidate. Vectors that are null, empty, zero, or
    hold null or non-finite components take no part, nor do rows with a null vec_id; vectors of different lengths
    do not meet. Where a vec_id repeats, a query is the lowest of its vectors, and a candidate counts once, by its
    nearest vector. With fewer candidates than ``k`` all are given; empty tables give no rows. Only the two
    named columns are read.
    """
    def usable(frame):
        chosen = frame.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("v"))
        return chosen.filter(F.col("id").isNotNull() & is_usable(F.col("v")))

    base, asked = usable(vectors), usable(queries).groupBy("id").agg(F.min("v").alias("v"))
    shards = max(1, math.ceil(base.count() / shard_rows))
    size = F.size("v")
    placed = base.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), size.alias("size"), F.lit(0).alias("asks"), "id", "v")
    sent = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), size.alias("size"), F.lit(1).alias("asks"), "id", "v")
    together = placed.unionByName(sent).repartition(4 * shards, "shard", "size")

    def run(batches):
        shard, place, held = None, None, []
        for (*now, asks), rows in runs(batches, 3):
            if not asks:
                if now != place:
                    place, held, shard = now, [], None
                held.append(rows)
                continue
            if now != place:
                continue  # a shard without candidates
            if shard is None:
                shard = Shard(*_ids_and_vectors(pa.Table.from_batches(held)), k + 1)
                held = []
            ids, raw = _ids_and_vectors(pa.Table.from_batches([rows]))
            for at in range(0, len(ids), BATCH):
                some = slice(at, at + BATCH)
                found = list(shard.ask(ids[some], unit(raw[some]), k, max(beam, 2 * (k + 1))))
                if found:
                    columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.float64()))]
                    yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    sorted_rows = together.sortWithinPartitions("shard", "size", "asks")
    found = sorted_rows.mapInArrow(run, "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _ids_and_vectors(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = rows.column(3).to_numpy()
    return ids, rows.column(4).combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
