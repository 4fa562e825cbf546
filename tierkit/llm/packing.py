"""Best-fit packing of documents into sequences, improved by a swap-based local search.

Every document becomes the ids of its text and one end id; only documents over
the length of a sequence are cut, into full pieces and one that may be shorter.
Pieces are dealt by a hash to shards of about ``SHARD_PIECES`` pieces (so the
number of shards grows with the input, and one more sequence per shard is the
most that sharding costs), and each shard is packed in one task: best fit in
descending length first, then a local search over the bins that aren't full. A
document may move from a bin to one at least as full, or one or two documents
of a bin may change places with one document of a fuller bin; every such step
makes the sum of the squared fills grow, and a bin whose last document has
moved is gone.

Defined cases: a null text is empty; an empty text is one piece of the end id;
an empty table gives no pieces; repeated rows (equal doc_id too) are packed each;
a null doc_id is kept; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.llm.common import saved, ship_package, whole_text
from tierkit.llm.tokens import crc32_of_ids, vocabulary_path, word_encoder

SHARD_PIECES = 40_000


def cut_pieces(docs: DataFrame, path: str, size: int, end_id: int) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    def cut(batches):
        enc = word_encoder(path)
        for b in batches:
            ids, rows = enc.encode(b.column(1)), []
            keys = b.column(0).to_pylist()
            for key, raw in zip(keys, ids, strict=True):
                a = np.append(np.frombuffer(raw, dtype=enc.dtype).astype("<u4"), np.uint32(end_id))
                rows += [(key, k, s, min(size, len(a) - s), crc32_of_ids(a[s : s + size]))
                         for k, s in enumerate(range(0, len(a), size))]
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                                   *[pa.array(c, pa.int64()) for c in cols[2:]]],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Bins:
    """Bins of pieces, as lists of lengths and of piece numbers."""

    def __init__(self, size: int):
        self.size = size
        self.fill: list[int] = []
        self.held: list[list[tuple[int, int]]] = []  # (length, piece)

    def best_fit(self, lengths: np.ndarray) -> None:
        """Each piece, longest first, into the fullest bin that has room."""
        by_room: dict[int, list[int]] = defaultdict(list)
        rooms = 0  # bit r: a bin with room r
        for p in np.argsort(-lengths, kind="stable").tolist():
            n = int(lengths[p])
            fits = rooms >> n
            if fits:
                room = n + (fits & -fits).bit_length() - 1
                b = by_room[room].pop()
                if not by_room[room]:
                    rooms &= ~(1 << room)
                self.fill[b] += n
                self.held[b].append((n, p))
            else:
                b, room = len(self.fill), self.size
                self.fill.append(n)
                self.held.append([(n, p)])
            if room - n:
                by_room[room - n].append(b)
                rooms |= 1 << (room - n)

    def improve(self) -> None:
        """Move, one-for-one and two-for-one steps until none helps: the sum of squared fills grows with each, so it ends."""
        while self._pass():
            pass

    def _pass(self) -> bool:
        size, fill, held = self.size, self.fill, self.held
        open_bins = sorted((b for b, f in enumerate(fill) if 0 < f < size), key=lambda b: -fill[b])
        rank = {b: k for k, b in enumerate(open_bins)}
        singles: dict[int, list[tuple[int, int]]] = defaultdict(list)  # length: (bin, piece)
        pairs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # sum: (bin, piece, piece)
        for b in open_bins:
            for n, p in held[b]:
                singles[n].append((b, p))
            # one pair for each sum; the lengths that differ in a bin are few, since they add up to its size at most
            own: dict[int, list[int]] = defaultdict(list)
            for n, p in held[b]:
                own[n].append(p)
            sums, lengths = {}, sorted(own)
            for i, n in enumerate(lengths):
                if len(own[n]) > 1:
                    sums[2 * n] = (b, *own[n][:2])
                for m in lengths[i + 1 :]:
                    sums[n + m] = (b, own[n][0], own[m][0])
            for n, entry in sums.items():
                pairs[n].append(entry)
        one = sum(1 << n for n in singles)
        two = sum(1 << n for n in pairs)
        changed = False

        def best(bits: int, low: int, high: int):
            """Lengths above low, up to high, the longest first."""
            bits &= (1 << (high + 1)) - 1
            bits >>= low + 1
            while bits:
                top = bits.bit_length() - 1
                yield top + low + 1
                bits &= ~(1 << top)

        def donor(found: list, k: int, target: int, out: int):
            """An entry of a bin behind place k whose pieces are still there."""
            while found:
                b, *ps = found[-1]
                here = {p for _, p in held[b]}
                if rank[b] <= k or not all(p in here for p in ps):
                    if all(p in here for p in ps):
                        # a fuller bin than the target gives nothing; later targets are less full still
                        found.pop()
                        continue
                    found.pop()
                    continue
                if fill[target] + out <= fill[b]:  # the sum of squares would not grow
                    return None
                return found.pop()
            return None

        for k, a in enumerate(open_bins):
            while 0 < fill[a] < size:  # each step fills it further
                gap, step = size - fill[a], None
                for y, py in [(0, -1), *sorted(set(held[a]), reverse=True)]:
                    for bits, index in ((one, singles), (two, pairs)):
                        for n in best(bits, y, min(size, y + gap)):
                            if step and n - y <= step[0]:
                                break
                            got = donor(index[n], k, a, n - y)
                            if got:
                                if step:  # the entry that isn't used goes back
                                    step[4][step[3]].append(step[2])
                                step = (n - y, (y, py), got, n, index)
                                break
                            if not index[n]:
                                if index is singles:
                                    one &= ~(1 << n)
                                else:
                                    two &= ~(1 << n)
                    if step and step[0] == gap:
                        break
                if not step:
                    break
                delta, (y, py), (b, *ps), _, _ = step
                moved = [x for x in held[b] if x[1] in ps]
                held[b] = [x for x in held[b] if x[1] not in ps]
                held[a] += moved
                if py >= 0:
                    held[a].remove((y, py))
                    held[b].append((y, py))
                    singles[y].append((b, py))
                    one |= 1 << y
                fill[a] += delta
                fill[b] -= delta
                changed = True
        return changed


def pack_lengths(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each piece and its place there."""
    bins = Bins(size)
    bins.best_fit(lengths)
    bins.improve()
    at, offset, number = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for held in bins.held:
        if held:
            place = 0
            for n, p in held:
                at[p], offset[p] = number, place
                place += n
            number += 1
    return at, offset


def pack(docs: DataFrame, path: str | None = None, size: int = 2048, end_id: int = 0,
         shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    ship_package(docs.sparkSession)
    pieces = saved(cut_pieces(docs, path or vocabulary_path(), size, end_id).withColumn("row", F.monotonically_increasing_id()), "pieces")
    shards = max(1, math.ceil(pieces.count() / shard_pieces))

    def fill(t: pa.Table) -> pa.Table:
        t = t.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending"), ("row", "ascending")])
        at, offset = pack_lengths(t["length"].to_numpy(), size)
        first = t["shard"][0].as_py() << 32
        return t.drop_columns(["shard", "row"]).append_column("sequence_id", pa.array(at + first)).append_column(
            "offset", pa.array(offset))

    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "row"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(
        fill, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
