"""Packing documents into sequences of several lengths.

Every length is a tier. A document gives whole windows of the longest tier first; what is left of it is
routed to the shortest tier that holds it. Tiers are then packed from long to short: each window starts
with a document of its tier, and its gap is filled with the longest fitting documents of this and shorter
tiers. Where none fits, a short document is cut so that the window is full. All lengths are powers of
two and all windows are full; what is left at the end of a task is laid into ever shorter windows, so
no sequence needs padding.

A task packs the documents it reads, in their order, with a bounded buffer: no shuffle, and the same
input partitions give the same sequences. Full windows of one length are dealt to steps of equally many
tokens so that the steps' attention costs (the sum of squared piece lengths) are balanced.
"""

import heapq
import zlib
from bisect import bisect_right, insort

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from grantlens.llm.word_encoder import encoded

TIERS = (256, 512, 1024, 2048)
FIELDS = [
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
    ("window", pa.int32()),
    ("step_id", pa.int64()),
]


class Piece:
    """A stretch of one document's ids."""

    __slots__ = ("key", "start", "ids", "tokens")

    def __init__(self, key, start, ids, tokens):
        self.key, self.start, self.ids, self.tokens = key, start, ids, tokens

    def __len__(self):
        return len(self.ids) // 4

    def cut(self, n):
        return (
            Piece(self.key, self.start, self.ids[: 4 * n], self.tokens),
            Piece(self.key, self.start + n, self.ids[4 * n :], self.tokens),
        )


class Packer:
    """Packs one task's documents. ``buffer`` bounds the ids held back, ``step_tokens`` is a step's size."""

    def __init__(self, first_id=0, tiers=TIERS, buffer=1_000_000, step_tokens=65_536, steps=8):
        if any(t & (t - 1) for t in tiers):
            raise ValueError("tiers must be powers of two")
        self.tiers, self.buffer, self.step_tokens, self.steps = sorted(tiers), buffer, step_tokens, steps
        self.next_sequence = self.next_step = first_id
        # Waiting pieces, as (length, arrival), shortest first.
        self.waiting, self.pieces, self.arrived, self.held = [], {}, 0, 0
        self.closed: dict[int, list] = {}
        self.rows: list[tuple] = []

    def add(self, key, ids: bytes):
        longest, tokens = self.tiers[-1], len(ids) // 4
        rest = Piece(key, 0, ids, tokens)
        while len(rest) >= longest:
            window, rest = rest.cut(longest)
            self._close([window])
        if len(rest):
            self._wait(rest)
        if self.held >= self.buffer:
            self._pack()

    def finish(self):
        self._pack()
        left = [self._take(0) for _ in range(len(self.waiting))]
        size = 1 << max(0, sum(map(len, left)).bit_length())
        while left:
            size >>= 1
            if sum(map(len, left)) >= size:
                window = []
                while size > sum(map(len, window)):
                    piece, gap = left.pop(0), size - sum(map(len, window))
                    if len(piece) > gap:
                        piece, rest = piece.cut(gap)
                        left.insert(0, rest)
                    window.append(piece)
                self._close(window)
        for size in list(self.closed):
            self._deal(size)

    def _wait(self, piece):
        insort(self.waiting, (len(piece), self.arrived))
        self.pieces[self.arrived] = piece
        self.arrived += 1
        self.held += len(piece)

    def _take(self, at):
        piece = self.pieces.pop(self.waiting.pop(at)[1])
        self.held -= len(piece)
        return piece

    def _pack(self):
        for tier in reversed(self.tiers):
            shorter = tier // 2 if tier != self.tiers[0] else 0
            while self.waiting and self.waiting[-1][0] > shorter and self.held >= tier:
                window, gap = [], tier
                while gap:
                    at = bisect_right(self.waiting, (gap, self.arrived)) - 1
                    if at >= 0:
                        piece = self._take(at)
                    else:  # all that wait are longer than the gap: cut the shortest
                        piece, rest = self._take(0).cut(gap)
                        self._wait(rest)
                    window.append(piece)
                    gap -= len(piece)
                self._close(window)

    def _close(self, window):
        size = sum(map(len, window))
        ready = self.closed.setdefault(size, [])
        ready.append(window)
        if len(ready) >= self.steps * max(1, self.step_tokens // size):
            self._deal(size)

    def _deal(self, size):
        """Deals closed windows of one size to steps, the costliest first to the lightest open step."""
        windows = self.closed.pop(size)
        room = max(1, self.step_tokens // size)
        count = -(-len(windows) // room)
        loads = [(0, 0, self.next_step + n) for n in range(count)]
        self.next_step += count
        costs = sorted(((-sum(len(p) ** 2 for p in w), n) for n, w in enumerate(windows)))
        for cost, n in costs:
            load, filled, step = heapq.heappop(loads)
            self._emit(windows[n], size, step)
            if filled + 1 < room:
                heapq.heappush(loads, (load - cost, filled + 1, step))

    def _emit(self, window, size, step):
        offset = 0
        for piece in window:
            n = len(piece)
            self.rows.append(
                (piece.key, piece.start, n, zlib.crc32(piece.ids), piece.tokens, self.next_sequence, offset, size, step)
            )
            offset += n
        self.next_sequence += 1


def pack(
    documents: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    tiers: tuple[int, ...] = TIERS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: the document's id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    and window (the sequence's length) and step_id.

    A document's ids are those of its whole text and ``end_id``; null or empty text gives ``end_id`` alone.
    Rows that repeat, or have a null id, are documents of their own. Only the two named columns are read,
    so other columns, of whatever name, do not matter. An empty table gives no rows.
    """
    found = documents.select(doc_id, text).schema
    key_type = found[0].dataType
    out = T.StructType([T.StructField(doc_id, key_type)])
    for name, kind in FIELDS:
        out = out.add(name, T.IntegerType() if kind == pa.int32() else T.LongType())
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        # Ids of sequences and steps: the task's number, then a count.
        packer = Packer(TaskContext.get().partitionId() << 32, tiers)
        kind = None

        def rows():
            taken, packer.rows = packer.rows, []
            columns = list(zip(*taken))
            arrays = [pa.array(columns[0], kind)] + [pa.array(c, k) for c, (_, k) in zip(columns[1:], FIELDS)]
            return pa.RecordBatch.from_arrays(arrays, [doc_id, *[n for n, _ in FIELDS]])

        def watched():
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                yield batch

        for key, ids in encoded(tokenizer, watched(), 0, 1):
            packer.add(key, ids + end)
            if len(packer.rows) >= 20_000:
                yield rows()
        packer.finish()
        if packer.rows:
            yield rows()

    return documents.select(doc_id, text).mapInArrow(run, out)
