"""Short codes for vectors: equal parts, each named by the nearest entry of its own codebook, in whole numbers.

Components become whole numbers, so distances, means and codes are exact and no order of rows changes them. The
nearest entry is found by pivots: a few points of each part position stay fixed, every part's distances to them
are computed once and stored, and in each round only the entries' distances to them are new. The largest
difference of the two is a lower bound of the distance between part and entry. Entries are taken in the order of
that bound and computed exactly, until the bound of the next one exceeds the best distance found.

Each round is one pass over the stored table. A task adds up its own parts for each entry; Spark adds up
the tasks' sums, and the driver holds no more than the codebooks.
"""

import hashlib
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.sources.storage import written, written_while

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
PIVOTS = 4
ROWS = 4096  # taken at once
#: What a bound is lowered by, as a share of the distances, for their rounding to 32 bits.
MARGIN = 1e-6


def whole_numbers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """(rows, PARTS, length of a part) of floor(scale * x). Zeros fill the last part up.

    Numbers so large that a squared distance would not fit 64 bits count as the largest that fits.
    """
    length = -(-vectors.shape[1] // PARTS)
    most = int(np.sqrt(2.0**61 / length) / 2)
    found = np.zeros((len(vectors), PARTS * length), dtype=np.int64)
    found[:, : vectors.shape[1]] = np.clip(np.floor(vectors.astype(np.float64) * scale), -most, most)
    return found.reshape(len(vectors), PARTS, length)


def choose_pivots(codebooks: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """(PARTS, n, length): of each first codebook the entries that are farthest from the ones before."""
    chosen = []
    for entries in codebooks:
        picked = [0]
        least = ((entries - entries[0]) ** 2).sum(axis=1)
        while len(picked) < n:
            picked.append(int(np.argmax(least)))
            least = np.minimum(least, ((entries - entries[picked[-1]]) ** 2).sum(axis=1))
        chosen.append(entries[picked])
    return np.stack(chosen)


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(..., PARTS, n): of parts (..., PARTS, length) to the pivots (PARTS, n, length)."""
    gaps = points[..., None, :] - pivots
    return np.sqrt((gaps * gaps).sum(axis=-1).astype(np.float64)).astype(np.float32)


def nearest(points: np.ndarray, far: np.ndarray, entries: np.ndarray, entry_far: np.ndarray):
    """(entry, squared distance) of each point, ties to the lower entry, and how many distances were computed."""
    bound = np.zeros((len(points), len(entries)))
    for own, theirs in zip(far.T.astype(np.float64), entry_far.T.astype(np.float64)):
        gap = np.abs(own[:, None] - theirs) - MARGIN * (own[:, None] + theirs)
        np.maximum(bound, gap, out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, axis=1) ** 2
    best = np.full(len(points), np.iinfo(np.int64).max)
    index = np.zeros(len(points), dtype=np.int64)
    left, computed = np.arange(len(points)), 0
    for step in range(len(entries)):
        left = left[bound[left, step] <= best[left]]
        if not len(left):
            break
        computed += len(left)
        entry = order[left, step]
        gap = points[left] - entries[entry]
        squared = np.einsum("ij,ij->i", gap, gap)
        better = (squared < best[left]) | ((squared == best[left]) & (entry < index[left]))
        best[left[better]], index[left[better]] = squared[better], entry[better]
    return index, best, computed


def _matrix(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _prepare(kept: DataFrame, pivots: np.ndarray, scale: int, kind: str) -> DataFrame:
    """(vec_id, label, parts, far): the whole numbers and the distances to the pivots."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                values = some.column(2)
                parts = whole_numbers(_matrix(values, len(values[0])), scale)
                columns = [parts.reshape(len(parts), -1).astype(np.int32), distances(parts, pivots).reshape(len(parts), -1)]
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(c.ravel()), c.shape[1]) for c in columns]
                lists = [x.cast(pa.list_(x.type.value_type)) for x in lists]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), *lists], ["vec_id", "label", "parts", "far"])

    return kept.mapInArrow(run, f"vec_id long, label {kind}, parts array<int>, far array<float>")


def _assigned(batches, codebooks: np.ndarray, entry_far: np.ndarray):
    """(batch, parts, entries, squared distances) of stretches of rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            some = batch.slice(at, ROWS)
            parts = _matrix(some.column(2), PARTS * codebooks.shape[2]).astype(np.int64).reshape(-1, PARTS, codebooks.shape[2])
            far = _matrix(some.column(3), PARTS * entry_far.shape[2]).reshape(-1, PARTS, entry_far.shape[2])
            found = [nearest(parts[:, p], far[:, p], codebooks[p], entry_far[p]) for p in range(PARTS)]
            yield some, parts, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _moved(table: DataFrame, codebooks: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The codebooks after one round: the floor of each entry's mean; entries without parts stay."""
    entry_far = distances(codebooks.transpose(1, 0, 2), pivots).transpose(1, 0, 2)

    def run(batches):
        sums, counts = np.zeros(codebooks.shape, dtype=np.int64), np.zeros(codebooks.shape[:2], dtype=np.int64)
        for _, parts, index, _ in _assigned(batches, codebooks, entry_far):
            for p in range(PARTS):
                np.add.at(sums[p], index[:, p], parts[:, p])
                counts[p] += np.bincount(index[:, p], minlength=len(counts[p]))
        part, entry = np.nonzero(counts)
        names = ["part", "entry", "n", "sums"]
        yield pa.RecordBatch.from_pydict(dict(zip(names, [part, entry, counts[part, entry], sums[part, entry].tolist()])))

    told = table.mapInArrow(run, "part long, entry long, n long, sums array<long>").groupBy("part", "entry")
    exact = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(codebooks.shape[2])]
    moved = codebooks.copy()
    for row in told.agg(F.sum("n").alias("n"), *exact).collect():  # one for each entry
        moved[row["part"], row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(codebooks.shape[2])]
    return moved


def _coded(table: DataFrame, codebooks: np.ndarray, pivots: np.ndarray, kind: str) -> DataFrame:
    entry_far = distances(codebooks.transpose(1, 0, 2), pivots).transpose(1, 0, 2)

    def run(batches):
        for some, _, index, squared in _assigned(batches, codebooks, entry_far):
            digits = index.astype(np.uint8).tobytes().hex()
            codes = [digits[at : at + 2 * PARTS] for at in range(0, len(digits), 2 * PARTS)]
            columns = [some.column(0), some.column(1), pa.array(codes, pa.string()), pa.array(squared.sum(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return table.mapInArrow(run, f"vec_id long, label {kind}, code string, error long")


def codebooks_digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
    vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for every vector that takes part.

    Vectors that are null or empty or hold null or non-finite components take no part, nor do those of another
    length than the vector with the lowest vec_id. Codebooks start as the parts of the ``entries`` (at most 256) lowest
    vec_ids, of equal ids the lower vector first and null last; with fewer vectors they are smaller. A vector whose length
    is no multiple of PARTS is filled up with zeros. Rows that repeat are coded each, and a null vec_id or label stays as
    it is. label_error adds up the errors of a label's rows; null is a label of its own. An empty table gives no rows.
    Only the three named columns are read. Intermediate tables are deleted.
    """
    kind = vectors.select(F.col(label).alias("label")).schema[0].dataType.simpleString()
    values = F.col(embedding).cast("array<double>")
    usable = F.coalesce(
        (F.size(values) > 0) & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)
    )
    kept = vectors.filter(usable).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), values.alias("embedding"))
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding").asc()]
    lowest = kept.orderBy(*order).limit(1).collect()
    if not lowest:
        result = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        return vectors.sparkSession.range(0).selectExpr(
            *[f"CAST(NULL AS {k}) AS {n}" for n, k in (x.split() for x in result.split(", "))]
        )
    kept = kept.filter(F.size("embedding") == len(lowest[0].embedding))
    first = kept.orderBy(*order).limit(entries).select("embedding").collect()
    codebooks = np.ascontiguousarray(whole_numbers(np.array([r.embedding for r in first]), scale).transpose(1, 0, 2))
    pivots = choose_pivots(codebooks)
    with ExitStack() as tables:
        table = tables.enter_context(written_while(_prepare(kept, pivots, scale, kind), "pivot-distances"))
        for _ in range(rounds):
            codebooks = _moved(table, codebooks, pivots)
        coded = tables.enter_context(written_while(_coded(table, codebooks, pivots, kind), "pivot-codes"))
        sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
        joined = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")))
        digest = F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256")
        return written(joined.select("vec_id", "code", "error", "label_error", digest), "pivot-results")
