"""Near-duplicate vectors by randomised-rotation binary codes.

A unit vector is turned by several random rotations, and the signs of the turned components are its code. For
each rotation the inner product of the turned vector with its own code is stored: dividing by it makes the
product of one vector's code with another's turned components an unbiased estimate of their cosine,
and gives the spread of its error (Gao and Long, 2024). The mean over the rotations, plus four and a half
spreads, bounds the cosine from above: a pair whose bound is below the threshold is dropped, any other
is computed again from the vectors in double precision.

Candidates share a band, a stretch of their codes: a stretch has as many bits as bring about 128 vectors to
a value, and there are as many bands as let a pair at the threshold miss all of them once in a million.
Each pair is counted in the first band that its two codes share, so pairs are never put in a table to be
made distinct: a task gives counts for each vector, and for components a tree over the vectors it
found linked. Values shared by very many vectors are cut into blocks, a pair of blocks for a task.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.llm.components import components
from grantlens.llm.minhash import groups
from grantlens.llm.vectors import by_length, is_usable, unit
from grantlens.sources.storage import written

SEED = 20240521
DEVIATIONS = 4.5
PLANES = 4  # bits to which a turned component is rounded when it meets codes
BLOCK = 1024
IN_BAND = 128


def bands_for(count: int, threshold: float, missed: float = 1e-6) -> tuple[int, int]:
    """(bits of a band, number of bands) for so many vectors."""
    bits = min(30, max(8, round(math.log2(max(1, count) / IN_BAND))))
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(missed) / math.log(1 - together))


class Coder:
    """Rotations for vectors of one length, padded with zeros to whole 64-bit words."""

    def __init__(self, length: int, bits: int, bands: int):
        self.width = 64 * -(-length // 64)
        self.rotations = -(-bits * bands // self.width)
        self.bits, self.bands = bits, bands
        random = np.random.default_rng([SEED, length])
        turns = [np.linalg.qr(random.standard_normal((self.width, self.width)))[0] for _ in range(self.rotations)]
        self.turn = np.concatenate(turns, axis=1)[:length]

    def turned(self, units: np.ndarray) -> np.ndarray:
        return units @ self.turn

    def encode(self, units: np.ndarray):
        """(codes as 64-bit words, factor of each rotation, band values)."""
        turned = self.turned(units)
        signs = turned > 0
        codes = np.packbits(signs, axis=1, bitorder="little").view("<u8")
        factors = np.abs(turned).reshape(len(units), self.rotations, -1).sum(axis=2) / math.sqrt(self.width)
        used = signs[:, : self.bits * self.bands].reshape(len(units), self.bands, self.bits)
        values = used @ (1 << np.arange(self.bits, dtype=np.int64))
        return codes, factors, values

    def planes(self, units: np.ndarray):
        """Turned components rounded to PLANES bits, as bit planes; (planes, lowest value, step)."""
        turned = self.turned(units)
        low = turned.min(axis=1, keepdims=True)
        step = np.maximum((turned.max(axis=1, keepdims=True) - low) / (2**PLANES - 1), 1e-12)
        level = np.rint((turned - low) / step).astype(np.uint8)
        bits = [np.packbits((level >> j) & 1, axis=1, bitorder="little").view("<u8") for j in range(PLANES)]
        sums = level.reshape(len(units), self.rotations, -1).sum(axis=2, dtype=np.int64)
        return np.stack(bits, axis=1), low, step, sums

    def upper_bounds(self, codes, factors, query) -> np.ndarray:
        """Upper bounds of the cosines of coded vectors (rows) with the queries (columns)."""
        planes, low, step, sums = query
        words = self.width // 64
        total = np.zeros((len(codes), len(low)))
        spread = np.zeros((len(codes), len(low)))
        for r in range(self.rotations):
            part = slice(r * words, (r + 1) * words)
            ones = np.bitwise_count(codes[:, part]).sum(axis=1, dtype=np.int64)
            chosen = np.zeros(total.shape, dtype=np.int64)
            for j in range(PLANES):
                both = codes[:, None, part] & planes[None, :, j, part]
                chosen += np.bitwise_count(both).sum(axis=2, dtype=np.int64) << j
            # Sum of (+1 or -1) * component over the rotation, from the sum where the code is +1.
            signed = step.T * (2 * chosen - sums[:, r]) + low.T * (2 * ones - self.width)[:, None]
            factor = factors[:, r][:, None]
            total += signed / (math.sqrt(self.width) * factor)
            rounding = (step.T**2) / 12 / factor**2
            spread += (1 - factor**2) / factor**2 / (self.width - 1) + rounding
        return (total + DEVIATIONS * np.sqrt(spread)) / self.rotations


def linked_pairs(coder: Coder, units, codes, factors, left, right, same: bool, threshold: float):
    """(rows, columns) of pairs between two sets of row numbers whose cosine reaches the threshold."""
    query = coder.planes(units[right])
    found = []
    for at in range(0, len(left), 256):
        rows = left[at : at + 256]
        could = coder.upper_bounds(codes[rows], factors[rows], query) >= threshold
        a, b = np.nonzero(could)
        if same:  # each pair once
            keep = at + a < b
            a, b = a[keep], b[keep]
        x, y = rows[a], right[b]
        for part in range(0, len(x), 65_536):
            p, q = x[part : part + 65_536], y[part : part + 65_536]
            exact = np.einsum("ij,ij->i", units[p], units[q]) >= threshold
            found.append((p[exact], q[exact]))
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def first_shared(coder: Coder, codes, a, b, band: int) -> np.ndarray:
    """Whether no band before this one is shared by the pairs."""
    fresh = np.ones(len(a), dtype=bool)
    if not band:
        return fresh
    for at in range(0, len(a), 65_536):
        part = slice(at, at + 65_536)
        differ = np.unpackbits((codes[a[part]] ^ codes[b[part]]).view(np.uint8), axis=1, bitorder="little")
        earlier = differ[:, : coder.bits * band].reshape(-1, band, coder.bits)
        fresh[part] = earlier.any(axis=2).all(axis=1)
    return fresh


def tree_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n rows the lowest row that the pairs reach from it."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def near_vectors(vectors: DataFrame, threshold: float = 0.9, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    n_links counts the other rows whose cosine is ``threshold`` or more; component_id is the lowest vec_id
    that such links reach, and kept says that it is the row's own. Vectors that are null, empty or zero, or hold null
    or non-finite components, and vectors of another length, link with nothing. Rows with equal vectors are linked with each
    other. A row with a null vec_id counts like any other; where no row of a component has an id,
    component_id is null and all are kept. Only the two named columns are read. An empty table gives no rows.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("_v"))
    usable = rows.filter(is_usable(F.col("_v")))
    classes = written(
        usable.groupBy("_v")
        .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vector-classes",
    )
    bits, bands = bands_for(classes.count(), threshold)
    coders: dict[int, Coder] = {}

    def coder_of(length: int) -> Coder:
        if length not in coders:
            coders[length] = Coder(length, bits, bands)
        return coders[length]

    def encode(batches):
        for batch in batches:
            for place, matrix in by_length(batch.column(2)):
                codes, factors, values = coder_of(matrix.shape[1]).encode(unit(matrix))
                part = batch.take(pa.array(place))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        part.column(2),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(list(factors.astype(np.float32)), pa.list_(pa.float32())),
                        pa.array(list(values), pa.list_(pa.int64())),
                    ],
                    ["node", "copies", "_v", "code", "factors", "bands"],
                )

    kind = classes.schema["_v"].dataType.simpleString()
    encoded = classes.select("node", "copies", "_v").mapInArrow(
        encode, f"node long, copies long, _v {kind}, code binary, factors array<float>, bands array<long>"
    )
    encoded = written(encoded, "vector-codes")
    key = ["length", "band", "value"]
    in_bands = encoded.select("*", F.size("_v").alias("length"), F.posexplode("bands").alias("band", "value"))
    counts = in_bands.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    cuts = written(counts.filter(F.col("n") > BLOCK).select(*key, F.ceil(F.col("n") / BLOCK).cast("int").alias("g")), "vector-cuts")
    spread = in_bands.drop("bands").join(cuts, key, "left").withColumn("g", F.coalesce("g", F.lit(1)))
    own = F.pmod(F.xxhash64("node"), F.col("g")).cast("int")
    tasks = F.transform(
        F.sequence(F.lit(0), F.col("g") - 1),
        lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j"), own.alias("own")),
    )
    dealt = spread.withColumn("_t", F.explode(tasks)).select(
        *key, F.col("_t.i").alias("i"), F.col("_t.j").alias("j"), F.col("_t.own").alias("own"), "node", "copies", "_v", "code", "factors"
    )
    dealt = dealt.repartition(*key, "i", "j").sortWithinPartitions(*key, "i", "j")

    def compare(batches):
        links, trees, most = {}, [], 100_000

        def flush():
            nodes = np.fromiter(links.keys(), dtype=np.int64, count=len(links))
            sums = np.fromiter(links.values(), dtype=np.int64, count=len(links))
            links.clear()
            a = np.concatenate([nodes, *[t[0] for t in trees]])
            b = np.concatenate([nodes, *[t[1] for t in trees]])
            n = np.concatenate([sums, *[np.zeros(len(t[0]), dtype=np.int64) for t in trees]])
            trees.clear()
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)], ["a", "b", "n"])

        for group in groups(batches, 5):
            if group.num_rows < 2:
                continue
            group = group.combine_chunks()
            length, band, _, i, j = (group.column(c)[0].as_py() for c in range(5))
            own, node, copies = (group.column(c).to_numpy() for c in (5, 6, 7))
            ((_, matrix),) = by_length(group.column(8).combine_chunks())
            coder, units = coder_of(length), unit(matrix)
            codes = np.frombuffer(b"".join(group.column(9).to_pylist()), dtype="<u8").reshape(len(node), -1)
            factors = group.column(10).combine_chunks().flatten().to_numpy().reshape(len(node), -1)
            left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
            a, b = linked_pairs(coder, units, codes, factors, left, right, i == j, threshold)
            if not len(a):
                continue
            fresh = first_shared(coder, codes, a, b, band)
            sums = np.zeros(len(node), dtype=np.int64)
            np.add.at(sums, a[fresh], copies[b[fresh]])
            np.add.at(sums, b[fresh], copies[a[fresh]])
            for at in np.flatnonzero(sums).tolist():
                links[node[at]] = links.get(node[at], 0) + int(sums[at])
            root = tree_of(len(node), a, b)
            hung = np.flatnonzero(root != np.arange(len(node)))
            trees.append((node[hung], node[root[hung]]))
            if len(links) + sum(len(t[0]) for t in trees) > most:
                yield flush()
        if links or trees:
            yield flush()

    found = written(dealt.mapInArrow(compare, "a long, b long, n long"), "vector-links")
    joined = components(found.filter("a <> b"))
    counted = found.filter("n > 0").groupBy("a").agg(F.sum("n").alias("others"))
    named = classes.join(joined, "node", "left").join(counted, F.col("node") == F.col("a"), "left")
    lowest = joined.join(classes.select("node", "first_id"), "node").groupBy("component").agg(F.min("first_id").alias("lowest"))
    named = named.join(lowest, "component", "left").select(
        F.col("_v").alias("_class"),
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n"),
        F.coalesce("lowest", "first_id").alias("component_id"),
    )
    result = rows.withColumn("_v", F.when(is_usable(F.col("_v")), F.col("_v"))).join(
        named, F.col("_v") == F.col("_class"), "left"
    )
    component = F.when(F.col("_class").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return result.select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull())
    )
