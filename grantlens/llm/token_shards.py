"""Token ids as binary shards, with a minimal perfect hash index from document keys to offsets.

A shard is two files. ``*.bin`` holds nothing but ids, 16 bits each where the vocabulary allows it, else
32, of documents in ascending key order. ``*.idx`` holds, after a JSON header line, the keys in file
order, the hash function, and for each of its slots a fingerprint of the key, the offset of the key's first id,
and how many ids and documents it has.

The hash function is a chain of bit sets. A key takes the first set in which its bit is on; a bit is on
if exactly one of the keys that reached this set hashes to it. The number of bits before it, counted by
blocks, is the key's slot: n keys take the slots 0 to n - 1. A key that is not there either meets no set bit or a
slot with another fingerprint (a false hit has chance 2**-32).

Files are written by the tasks themselves, a document at a time, under names that no other attempt has;
the manifest, a Spark table, names the files of the attempts that counted.
"""

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantlens.llm.files import file_system
from grantlens.llm.word_encoder import encoded, encoder_for
from grantlens.sources.storage import shared_folder

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SPREAD = 2  # bits of a level for each key that reaches it
MANIFEST = T.StructType(
    [
        T.StructField("shard", T.LongType()),
        T.StructField("file", T.StringType()),
        T.StructField("n_docs", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("first_key", T.LongType()),
        T.StructField("last_key", T.LongType()),
    ]
)


def mixed_bits(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of 64-bit keys."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64) + np.uint64(seed + 1) * MULTIPLIER
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slots 0 to n - 1 for n different keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # each the packed bits of one set, 64 to a word
        self.before, total = [], 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.before.append(total + np.concatenate([[0], np.cumsum(ones)]))
            total += int(ones.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        levels, left = [], np.asarray(keys, dtype=np.int64)
        while len(left):
            bits = 64 * max(1, -(-len(left) * SPREAD // 64))
            at = (mixed_bits(left, len(levels)) % np.uint64(bits)).astype(np.int64)
            alone = np.bincount(at, minlength=bits) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for a key that meets no set bit."""
        keys = np.asarray(keys, dtype=np.int64)
        found = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for depth, words in enumerate(self.levels):
            if not len(left):
                break
            at = mixed_bits(keys[left], depth) % np.uint64(64 * len(words))
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            lower = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            place = self.before[depth][word] + np.bitwise_count(lower).astype(np.int64)
            found[left[hit]] = place[hit]
            left = left[~hit]
        return found


class ShardIndex:
    """What an ``.idx`` file holds."""

    def __init__(self, header, keys, hashed, prints, offsets, lengths, counts):
        self.header, self.keys, self.hashed = header, keys, hashed
        self.prints, self.offsets, self.lengths, self.counts = prints, offsets, lengths, counts

    @classmethod
    def build(cls, keys: list, lengths: list, item_bytes: int) -> "ShardIndex":
        """``keys`` in file order; null keys come first, are counted, and have no slot."""
        nulls = sum(k is None for k in keys)
        known = np.array(keys[nulls:], dtype=np.int64)
        sizes = np.array(lengths, dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        unique, first, count = np.unique(known, return_index=True, return_counts=True)
        hashed = PerfectHash.build(unique)
        slot = hashed.slots(unique)
        header = {"item_bytes": item_bytes, "nulls": nulls, "docs": len(keys), "keys": len(unique)}
        prints = np.zeros(len(unique), dtype="<u4")
        offsets, spans = np.zeros(len(unique), dtype="<i8"), np.zeros(len(unique), dtype="<i8")
        counts = np.zeros(len(unique), dtype="<i8")
        prints[slot] = cls.fingerprint(unique)
        begin = nulls + first
        offsets[slot], spans[slot] = starts[begin], starts[begin + count] - starts[begin]
        counts[slot] = count
        # Keys in file order with the length of each document, so that a file can be listed.
        listing = np.stack([np.array([0] * nulls + keys[nulls:], dtype="<i8"), sizes.astype("<i8")])
        return cls(header, listing, hashed, prints, offsets, spans, counts)

    @staticmethod
    def fingerprint(keys: np.ndarray) -> np.ndarray:
        return (mixed_bits(keys, 1 << 20) >> np.uint64(32)).astype("<u4")

    def save(self, out) -> None:
        header = self.header | {"levels": [len(w) for w in self.hashed.levels]}
        out.write(json.dumps(header).encode() + b"\n")
        parts = [self.keys, *self.hashed.levels, self.prints, self.offsets, self.lengths, self.counts]
        for part in parts:
            out.write(np.ascontiguousarray(part).tobytes())

    @classmethod
    def load(cls, source) -> "ShardIndex":
        raw = source.read()
        end = raw.index(b"\n") + 1
        header, at = json.loads(raw[:end]), end

        def take(kind, n):
            nonlocal at
            part = np.frombuffer(raw, dtype=kind, count=n, offset=at)
            at += part.nbytes
            return part

        keys = take("<i8", 2 * header["docs"]).reshape(2, -1)
        hashed = PerfectHash([take("<u8", n) for n in header["levels"]])
        n = header["keys"]
        return cls(header, keys, hashed, take("<u4", n), take("<i8", n), take("<i8", n), take("<i8", n))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(offset, ids, documents) of each key; -1, 0 and 0 where it is not in the shard."""
        keys = np.asarray(keys, dtype=np.int64)
        slots = self.hashed.slots(keys)
        here = slots >= 0
        here[here] = self.prints[slots[here]] == self.fingerprint(keys[here])
        slots = np.where(here, slots, 0)
        if not len(self.prints):
            return np.full(len(keys), -1), np.zeros(len(keys), int), np.zeros(len(keys), int)
        return (
            np.where(here, self.offsets[slots], -1),
            np.where(here, self.lengths[slots], 0),
            np.where(here, self.counts[slots], 0),
        )


def write_shards(
    documents: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Writes ids of whole texts, each followed by ``end_id``, below ``folder``; returns the manifest.

    Documents are in ascending doc_id, null first, and rows of equal doc_id in the order of their text's
    hash; they may lie in several neighbouring shards, so a doc_id on a third of all rows is no
    hot task. A null or empty text has ``end_id`` alone. Other columns are not read. An empty table gives an
    empty manifest.
    """
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    by = [F.col(doc_id).asc_nulls_first(), F.xxhash64(text)]
    ordered = (
        documents.select(F.col(doc_id).cast("long").alias(doc_id), text)
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
    )

    def run(batches):
        system, path = file_system(folder)
        item = "<u2" if encoder_for(tokenizer).tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        end = np.array([end_id], dtype=item).tobytes()
        shard = TaskContext.get().partitionId()
        file = f"{shard:06d}-{uuid.uuid4().hex}"
        keys, lengths = [], []
        out = None
        for key, ids in encoded(tokenizer, batches, 0, 1):
            out = out or system.open_output_stream(f"{path}/{file}.bin")
            out.write(np.frombuffer(ids, dtype="<u4").astype(item).tobytes() + end)
            keys.append(key)
            lengths.append(len(ids) // 4 + 1)
        if out is None:
            return
        out.close()
        with system.open_output_stream(f"{path}/{file}.idx") as index:
            ShardIndex.build(keys, lengths, np.dtype(item).itemsize).save(index)
        known = [k for k in keys if k is not None]
        row = [shard, file, len(keys), sum(lengths), known[0] if known else None, known[-1] if known else None]
        schema = pa.schema([(f.name, pa.string() if f.name == "file" else pa.int64()) for f in MANIFEST])
        yield pa.RecordBatch.from_pydict({f.name: [v] for f, v in zip(schema, row)}, schema=schema)

    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(documents.sparkSession, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shard, with ``start``, the ids of all shards before it."""
    rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _ids(payload, item: int, offset: int, count: int) -> np.ndarray:
    payload.seek(offset * item)
    return np.frombuffer(payload.read(count * item), dtype=f"<u{item}").astype("<u4")


def list_shards(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files.

    A document's place is asked of the index by its key; the payload is read a document at a time.
    """
    out = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(batches):
        system, path = file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_stream(f"{path}/{row['file']}.idx") as source:
                    index = ShardIndex.load(source)
                item, nulls = index.header["item_bytes"], index.header["nulls"]
                keys, lengths = index.keys
                places, _, _ = index.find(keys)
                # Documents without a key, and the second and later ones of a key, follow one another.
                follow = np.cumsum(lengths) - lengths
                later = np.zeros(len(keys), dtype=bool)
                later[:nulls] = True
                later[nulls + 1 :] |= keys[nulls + 1 :] == keys[nulls:-1] if len(keys) > nulls else False
                places = np.where(later, follow, places)
                with system.open_input_file(f"{path}/{row['file']}.bin") as payload:
                    sums = [
                        zlib.crc32(_ids(payload, item, int(p), int(n)).tobytes())
                        for p, n in zip(places, lengths)
                    ]
                for at in range(0, len(keys), 10_000):
                    part = slice(at, at + 10_000)
                    numbers = np.arange(len(keys))[part]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys[part], pa.int64(), mask=numbers < nulls),
                            pa.array(row["start"] + places[part], pa.int64()),
                            pa.array(lengths[part], pa.int64()),
                            pa.array(sums[part], pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    shards = read_manifest(spark, folder)
    # A task for each shard: a number of partitions that is given is kept, however short the rows are.
    return shards.repartitionByRange(max(shards.count(), 1), "shard").mapInArrow(run, out)


def lookup(keys: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, start, ids) for the documents with the keys asked for, through the index.

    Keys that are null or unknown give no row; a key of several documents gives their ids in one row for
    each shard they lie in. Keys go to the shards whose range they lie in, and a task has one index open at a time.
    """
    spark = keys.sparkSession
    rows = read_manifest(spark, folder).filter("first_key IS NOT NULL").orderBy("first_key", "shard").collect()
    shards = [r.asDict() for r in rows]
    firsts = np.array([s["first_key"] for s in shards], dtype=np.int64)
    # The highest key up to each shard: shards from the first one that reaches a key may hold it.
    lasts = np.maximum.accumulate(np.array([s["last_key"] for s in shards], dtype=np.int64)) if shards else firsts

    def place(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column(0).drop_null().to_numpy()
            low, high = np.searchsorted(lasts, asked, side="left"), np.searchsorted(firsts, asked, side="right")
            n = np.maximum(high - low, 0)
            numbers = np.arange(int(n.sum())) + np.repeat(low - np.cumsum(n) + n, n)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(asked, n)), pa.array(numbers)], [key, "_shard"])

    def run(batches) -> Iterator[pa.RecordBatch]:
        system, path = file_system(folder)
        at, index = None, None
        for batch in batches:
            asked, numbers = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for number in np.unique(numbers).tolist():
                shard, mine = shards[number], asked[numbers == number]
                if number != at:
                    with system.open_input_stream(f"{path}/{shard['file']}.idx") as source:
                        at, index = number, ShardIndex.load(source)
                places, counts, _ = index.find(mine)
                with system.open_input_file(f"{path}/{shard['file']}.bin") as payload:
                    for k, p, n in zip(mine.tolist(), places.tolist(), counts.tolist()):
                        if p >= 0:
                            ids = _ids(payload, index.header["item_bytes"], p, n)
                            yield pa.RecordBatch.from_pydict(
                                {key: [k], "start": [shard["start"] + p], "ids": pa.array([ids.tolist()], pa.list_(pa.int64()))}
                            )

    asked = keys.select(F.col(key).cast("long").alias(key)).mapInArrow(place, f"{key} long, _shard long")
    dealt = asked.repartition(max(len(shards), 1), "_shard").sortWithinPartitions("_shard")
    return dealt.mapInArrow(run, f"{key} long, start long, ids array<long>")


def new_folder(spark: SparkSession) -> str:
    return shared_folder(spark, "token-shards")
