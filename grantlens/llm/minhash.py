"""Near-duplicate documents by b-bit MinHash.

Each document's set of word shingles gets one minimum per hash function. The minima, four by four, are band
keys: documents with a common key are candidates. Of each minimum only the low bits are kept, packed into
64-bit words; how many of these agree between two documents, less the agreement that chance gives,
estimates their similarity with a few bit counts. Candidates whose estimate could reach the threshold
are confirmed on their full sets, which are computed again from the whole texts.

Documents with the same set are one class, found by a digest. Links are only needed as far as they
join components: first every class is compared with the lowest class of each of its bands. Where a band still
holds several components, likely pairs between them name clusters of components, and in a cluster every
likely pair of different components is compared in full, blocks of classes to a task. A task gives only the links
that join something, so a group of copies costs rows in proportion to its size, and no link that would
join two components is left out.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlens.llm.components import components
from grantlens.llm.kept import kept
from grantlens.sources.storage import written

SHINGLE = 5
HASHES, ROWS, BITS = 128, 4, 4
BANDS = HASHES // ROWS
WORDS = HASHES * BITS // 64
WORD_NAMES = [f"s{i}" for i in range(WORDS)]
BLOCK = 512  # classes that one task compares with as many others
ONES = int("0x" + "1" * (64 // BITS), 16)  # the lowest bit of each kept minimum
BROADCAST_ROWS = 500_000
SKETCH = "doc_id long, text_key binary, n_shingles long, digest binary, bands array<long>, " + ", ".join(f"{w} long" for w in WORD_NAMES)


def scrambled(x: np.ndarray) -> np.ndarray:
    """Mixes the bits of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_RANDOM = scrambled(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_TIMES = (_RANDOM[:HASHES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_PLUS = (_RANDOM[HASHES:] >> np.uint64(32)).astype(np.uint32)


def shingles(text: str | None) -> np.ndarray:
    """The distinct hashed shingles, ascending. Fewer words than a shingle are one shingle together."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    together = np.full(n, width, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(width):
            together = together * np.uint64(0x9E3779B97F4A7C15) + hashed[at : at + n]
    return np.unique(scrambled(together))


def digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def minima(found: np.ndarray) -> np.ndarray:
    """The lowest value of each hash function over the set, a stretch of the set at a time."""
    short = (found >> np.uint64(32)).astype(np.uint32)
    lowest = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(short), 2048):
        part = _TIMES[:, None] * short[None, at : at + 2048]
        part += _PLUS[:, None]
        np.minimum(lowest, part.min(axis=1), out=lowest)
    return lowest


def signature(lowest: np.ndarray) -> np.ndarray:
    """The low bits of the mixed minima, packed."""
    low = scrambled(lowest.astype(np.uint64)) & np.uint64((1 << BITS) - 1)
    shifts = np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low.reshape(WORDS, -1) << shifts, axis=1).view(np.int64)


def band_keys(lowest: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for column in lowest.reshape(BANDS, ROWS).T:
            keys = scrambled(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def least_agreeing(threshold: float, deviations: float = 4.5) -> int:
    """How many of the kept minima agree at least, for all but a few in a million pairs at the threshold."""
    chance = threshold + (1 - threshold) / 2**BITS
    return int(np.floor(HASHES * chance - deviations * np.sqrt(HASHES * chance * (1 - chance))))


def text_key(text: Column) -> Column:
    """What tells texts apart, to find a result's row again; null for null."""
    return F.unhex(F.md5(text.cast("binary")))


def sketch(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    names = ["doc_id", "text_key", "n_shingles", "digest", "bands", *WORD_NAMES]

    def run(batches):
        kept("minhash", object)  # gives up the caches of other operators
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                counts, digests, bands, packed = [], [], [], []
                for value in part.column(2):
                    found = shingles(value.as_py())
                    counts.append(len(found))
                    digests.append(digest(found) if len(found) else None)
                    lowest = minima(found) if len(found) else None
                    bands.append(None if lowest is None else band_keys(lowest))
                    packed.append(np.zeros(WORDS, dtype=np.int64) if lowest is None else signature(lowest))
                words = np.stack(packed) if packed else np.zeros((0, WORDS), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(counts, pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                        *[pa.array(np.ascontiguousarray(words[:, i])) for i in range(WORDS)],
                    ],
                    names,
                )

    columns = F.col(doc_id).cast("long").alias("doc_id"), text_key(F.col(text)).alias("text_key"), F.col(text)
    return documents.select(*columns).mapInArrow(run, SKETCH)


def agreeing(left: str, right: str) -> Column:
    """How many minima have equal low bits, from two packed signatures: four bit counts of 64 bits each."""
    differing = F.lit(0)
    for word in WORD_NAMES:
        x = F.col(f"{left}.{word}").bitwiseXOR(F.col(f"{right}.{word}"))
        for step in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
        differing = differing + F.bit_count(x.bitwiseAND(F.lit(ONES)))
    return F.lit(HASHES) - differing


def _could_reach(threshold_percent: int) -> Column:
    """Of two sets whose sizes differ more than this no pair reaches the threshold."""
    a, b = F.col("l.n_shingles"), F.col("r.n_shingles")
    return F.least(a, b) * 100 >= F.greatest(a, b) * threshold_percent


def estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sizes and signatures allow the threshold."""
    facts = classes.select("node", "n_shingles", *WORD_NAMES)
    both = pairs.join(facts.alias("l"), F.col("a") == F.col("l.node")).join(
        facts.alias("r"), F.col("b") == F.col("r.node")
    )
    fits = _could_reach(percent) & (agreeing("l", "r") >= least_agreeing(percent / 100))
    return both.filter(fits).select("a", "b")


def full_sets(nodes: DataFrame, classes: DataFrame, documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, items): the shingle set of each class asked for, from the whole text of one of its documents, stored."""
    wanted = written(
        nodes.join(classes, "node").select("node", F.col("first_id").alias("_first"), F.col("digest").alias("_digest")),
        "minhash-wanted",
    )
    if wanted.count() <= BROADCAST_ROWS:  # 32 bytes each; beyond that Spark decides
        wanted = F.broadcast(wanted)
    texts = documents.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text"))
    asked = texts.join(wanted, F.col("_id").eqNullSafe(F.col("_first"))).select("node", "_digest", "_text")

    def run(batches):
        for batch in batches:
            nodes, sets = [], []
            for node, known, value in zip(*(batch.column(i) for i in range(3))):
                found = shingles(value.as_py())
                if len(found) and digest(found) == known.as_py():
                    nodes.append(node.as_py())
                    sets.append(found.view(np.int64))
                if len(nodes) == 256:
                    yield pa.RecordBatch.from_pydict({"node": nodes, "items": pa.array(sets, pa.list_(pa.int64()))})
                    nodes, sets = [], []
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["node", "items"]
            )

    found = asked.mapInArrow(run, "node long, items array<long>")
    return written(found.dropDuplicates(["node"]), "minhash-sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b"
    )
    common = F.size(F.array_intersect("x", "y"))
    united = F.size("x") + F.size("y") - common
    return both.filter(common * 100 >= united * percent).select("a", "b")


def _dealt(members: DataFrame, group: str) -> DataFrame:
    """Members of a group in which components meet, dealt to tasks (group, i, j) that hold two blocks.

    In each group the component with most classes stands against all others, and these against each other;
    no class meets only its own component. Groups of one component are left out.
    """
    sizes = members.groupBy(group, "component").agg(F.count(F.lit(1)).alias("n"))
    mains = sizes.groupBy(group).agg(
        F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds")
    )
    mains = mains.filter("kinds > 1").select(
        (F.col(group) + F.lit(0)).alias("_group"),
        F.col("main.component").alias("main"),
        F.ceil(F.col("main.n") / BLOCK).cast("int").alias("g"),
        F.ceil((F.col("all") - F.col("main.n")) / BLOCK).cast("int").alias("h"),
    )
    placed = members.join(mains, F.col(group) == F.col("_group")).drop("_group")
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    is_main = F.col("component") == F.col("main")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    # Tasks (i, j): block i of the main component (-1 - i: of the others) against block j of the others.
    own = block("h")
    against_main = F.transform(upto("g"), lambda i: F.struct(i.alias("i"), own.alias("j")))
    among = F.transform(
        upto("h"), lambda j: F.struct((-1 - F.least(own, j)).alias("i"), F.greatest(own, j).alias("j"))
    )
    as_main = F.transform(upto("h"), lambda j: F.struct(block("g").alias("i"), j.alias("j")))
    dealt = placed.withColumn("_task", F.explode(F.when(is_main, as_main).otherwise(F.concat(against_main, among))))
    return dealt.withColumns({"i": F.col("_task.i"), "j": F.col("_task.j")}).drop("_task", "main", "g", "h")


def _sorted_tasks(dealt: DataFrame, group: str, more: list[str]) -> DataFrame:
    task = [group, "i", "j"]
    columns = [*task, "node", "component", "n_shingles", *WORD_NAMES, *more]
    return dealt.select(*columns).repartition(*task).sortWithinPartitions(*task)


class _Members:
    """The classes of one task, and which of them could be linked."""

    def __init__(self, group: pa.Table, percent: int):
        self.node, self.component, self.n = (group.column(k).to_numpy() for k in (3, 4, 5))
        self.packed = np.stack([group.column(6 + k).to_numpy() for k in range(WORDS)], axis=1).view(np.uint64)
        self.percent, self.floor = percent, least_agreeing(percent / 100)
        self.root = np.unique(self.component, return_inverse=True)[1]

    def join(self, a: int, b: int) -> bool:
        """Puts the components of two rows together; whether they were apart."""
        low, high = sorted((self.root[a], self.root[b]))
        if low == high:
            return False
        self.root[self.root == high] = low
        return True

    def likely(self, at: int) -> np.ndarray:
        """Later rows of other components that size and signature allow, the likeliest first."""
        n = self.n[at + 1 :]
        fits = (self.root[at + 1 :] != self.root[at]) & (
            np.minimum(n, self.n[at]) * 100 >= np.maximum(n, self.n[at]) * self.percent
        )
        others = np.flatnonzero(fits) + at + 1
        x = self.packed[others] ^ self.packed[at]
        for step in (1, 2):
            x |= x >> np.uint64(step)
        same = HASHES - np.bitwise_count(x & np.uint64(ONES)).sum(axis=1, dtype=np.int64)
        order = np.argsort(-same, kind="stable")
        return others[order[same[order] >= self.floor]]


def _pairs_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def candidate_trees(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that connect the components that likely pairs connect: for each task at most a tree."""

    def run(batches):
        for group in groups(batches, 3):
            task, rows = _Members(group, percent), []
            for at in range(len(task.node) - 1):
                for other in task.likely(at):
                    if task.join(at, other):
                        rows.append((int(task.node[at]), int(task.node[other])))
            if rows:
                yield _pairs_batch(rows)

    return _sorted_tasks(_dealt(members, "key"), "key", []).mapInArrow(run, "a long, b long")


def exact_trees(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Linked pairs (a, b) between components of a group: every likely pair is compared on its full sets, unless
    links found before it in the task have joined its components."""

    def run(batches):
        for group in groups(batches, 3):
            task, rows = _Members(group, percent), []
            items = group.column(6 + WORDS).combine_chunks()
            starts = np.concatenate([[0], np.cumsum(task.n)[:-1]])
            flat = np.unique(items.flatten().to_numpy(), return_inverse=True)[1].astype(np.int32)
            marked = np.zeros(int(flat.max(initial=0)) + 1, dtype=bool)
            for at in range(len(task.node) - 1):
                likely = task.likely(at)
                if not len(likely):
                    continue
                own = flat[starts[at] : starts[at] + task.n[at]]
                marked[own] = True
                for part in np.array_split(likely, -(-len(likely) // 64)):
                    part = part[task.root[part] != task.root[at]]
                    if not len(part):
                        continue
                    sizes = task.n[part]
                    ends = np.cumsum(sizes)
                    places = np.arange(ends[-1]) + np.repeat(starts[part] - ends + sizes, sizes)
                    common = np.add.reduceat(marked[flat[places]].astype(np.int64), ends - sizes)
                    linked = common * 100 >= (sizes + task.n[at] - common) * percent
                    for other in part[linked]:
                        if task.join(at, other):
                            rows.append((int(task.node[at]), int(task.node[other])))
                marked[own] = False
            if rows:
                yield _pairs_batch(rows)

    dealt = _dealt(members, "cluster").join(sets.select(F.col("node").alias("_of"), "items"), F.col("node") == F.col("_of"))
    return _sorted_tasks(dealt, "cluster", ["items"]).mapInArrow(run, "a long, b long")


def groups(batches, width: int):
    """Consecutive rows with equal first ``width`` columns, as tables, from batches sorted by them."""
    held, name = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows, dtype=bool)
        changed[0] = True
        for k in range(width):
            values = batch.column(k).to_numpy(zero_copy_only=False)
            changed[1:] |= values[1:] != values[:-1]
        starts = [*np.flatnonzero(changed).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            key = tuple(batch.column(k)[a].as_py() for k in range(width))
            if held and key != name:
                yield pa.Table.from_batches(held)
                held = []
            name = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def near_duplicates(documents: DataFrame, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, group_id, text_key) for every row.

    Two documents are linked if 100 * common shingles >= ``percent`` * united shingles. component_id is
    the lowest doc_id that links reach, and kept says that it is the row's own. Null texts and texts
    without a word have no shingles and are linked with nothing. A row with a null doc_id is
    compared like any other; where no row of a component has an id, component_id is null and all are kept. Rows that repeat are copies of each other.
    group_id is one number for each component, null without shingles; it means nothing beyond this result. Only the
    two named columns are read. An empty table gives no rows.
    """
    sketches = written(sketch(documents, doc_id, text), "minhash-sketches")
    alike = sketches.filter("n_shingles > 0").groupBy("digest")
    once = [F.first(c).alias(c) for c in ["n_shingles", "bands", *WORD_NAMES]]
    classes = written(
        alike.agg(F.min("doc_id").alias("first_id"), *once).withColumn("node", F.monotonically_increasing_id()),
        "minhash-classes",
    )
    keys = classes.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("lowest"), F.max("node").alias("highest"))
    shared = shared.filter("lowest < highest").select((F.col("key") + F.lit(0)).alias("_key"), "lowest")
    members = written(keys.join(shared, F.col("key") == F.col("_key")).drop("_key"), "minhash-members")

    stars = members.filter("node <> lowest").select(F.col("node").alias("a"), F.col("lowest").alias("b")).distinct()
    first = written(estimated(stars, classes, percent), "minhash-pairs")
    asked = first.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    links = written(confirmed(first, full_sets(asked, classes, documents, doc_id, text), percent), "minhash-links")
    joined = components(links)

    facts = classes.select(F.col("node").alias("_of"), "n_shingles", *WORD_NAMES)
    now = joined.select((F.col("node") + F.lit(0)).alias("_node"), "component")
    kinds = members.join(now, F.col("node") == F.col("_node"), "left").select(
        "key", "node", F.coalesce("component", "node").alias("component")
    )
    spans = kinds.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    open_keys = spans.filter("x < y").select((F.col("key") + F.lit(0)).alias("_key"))
    kinds = kinds.join(open_keys, F.col("key") == F.col("_key")).drop("_key")
    kinds = kinds.join(facts, F.col("node") == F.col("_of")).drop("_of")
    trees = written(candidate_trees(kinds, percent), "minhash-trees")
    if not trees.isEmpty():
        # Clusters of components that likely pairs connect; within them components are compared in full.
        stars = joined.select(F.col("node").alias("a"), F.col("component").alias("b"))  # join what the links join
        clusters = components(trees.union(stars)).select(F.col("node").alias("_in"), F.col("component").alias("cluster"))
        open_clusters = clusters.join(trees.select("a"), F.col("_in") == F.col("a"), "left_semi").select(
            F.col("cluster").alias("_cluster")
        )
        clusters = clusters.join(open_clusters.distinct(), F.col("cluster") == F.col("_cluster")).drop("_cluster")
        grouped = facts.join(clusters, F.col("_of") == F.col("_in")).withColumnRenamed("_of", "node").drop("_in")
        grouped = grouped.join(now, F.col("node") == F.col("_node"), "left").drop("_node")
        grouped = written(grouped.withColumn("component", F.coalesce("component", "node")), "minhash-clusters")
        sets = full_sets(grouped.select("node"), classes, documents, doc_id, text)
        found = written(exact_trees(grouped, sets, percent), "minhash-links")
        if not found.isEmpty():
            joined = components(found.union(stars))

    named = classes.select("node", "digest", "first_id").join(joined, "node", "left")
    lowest = joined.join(classes.select("node", "first_id"), "node").groupBy("component").agg(
        F.min("first_id").alias("lowest")
    )
    named = named.join(lowest, "component", "left").select(
        F.col("digest").alias("_digest"),
        F.coalesce("lowest", "first_id").alias("component_id"),
        F.coalesce("component", "node").alias("group_id"),
    )
    result = sketches.select("doc_id", "n_shingles", "digest", "text_key").join(named, F.col("digest") == F.col("_digest"), "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    kept = F.coalesce(F.col("doc_id") == component, component.isNull())
    return result.select(
        "doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), "group_id", "text_key"
    )


def one_of_each(documents: DataFrame, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``documents`` without near-duplicates: of each component one row with its lowest doc_id.

    Of several such rows that with the lowest text key stays; rows without a word are in no component and all stay.
    """
    found = near_duplicates(documents, percent, doc_id, text).filter("kept")
    rows = found.groupBy("group_id", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("_rows"))
    grouped, single = rows.filter("group_id IS NOT NULL"), rows.filter("group_id IS NULL")
    lowest = F.min_by(F.struct("doc_id", "text_key", "_rows"), "text_key").alias("row")
    chosen = grouped.groupBy("group_id").agg(lowest).select("group_id", "row.*")
    chosen = chosen.unionByName(single.select("group_id", "doc_id", "text_key", "_rows"))
    chosen = chosen.select(
        F.col("group_id").alias("_group"),
        F.col("doc_id").alias("_of"),
        F.col("text_key").alias("_key"),
        (F.col("group_id").isNotNull() & (F.col("_rows") > 1)).alias("_repeats"),
    )
    same = F.col(doc_id).cast("long").eqNullSafe(F.col("_of")) & text_key(F.col(text)).eqNullSafe(F.col("_key"))
    kept = documents.join(chosen, same)
    repeated = kept.filter("_repeats").dropDuplicates(["_group"])  # rows that repeat as a whole
    return kept.filter("NOT _repeats").unionByName(repeated).select(*[F.col(f"`{c}`") for c in documents.columns])
