"""Best-fit packing of token sequences by exact complements.

Documents become byte-pair ids with an end id; those longer than a sequence are cut into whole sequences, of which
the first piece takes what is left over. Only the number of pieces of each length decides how they are packed,
and there are at most 1024 lengths: from the longest down, the gap that a length leaves is looked up among single
lengths, sums of two and sums of three, and a combination that fills the gap exactly is used as often as its
pieces last. What finds no complement is packed best fit: into the fullest open sequence that still has room.
The plan is a bounded table of (length, first rank, last rank, sequence, place); pieces take it up by their rank
among the pieces of their length, so the pieces themselves never leave their tasks.

Null texts count as empty and are one piece of one token; a null key stays null; repeated rows are pieces of their own.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerq.llm.common import cut, mapped

CAPACITY, END = 1024, 2
TOKENIZER = "byte_bpe_50k.json"
#: Bytes of chunk ids that a Python worker keeps; fewer cost time only.
ROOM = 120 << 20

#: A space that is not followed by a word: such chunks stay with the one before.
_odd = re.compile(r" (?=\s|\Z)")


class ChunkIds:
    """Ids of text chunks by a byte-level tokenizer that splits before each space.

    A text is cut before every single space that a word follows, where the tokenizer cuts in any case, so that
    the ids of frequent chunks can be kept, first come, in up to ``room`` bytes. Chunks but a text's first are named
    without the space they begin with. New chunks of a batch are encoded in one call and told apart by the
    bytes their ids stand for.
    """

    #: About what a dictionary entry takes beside the characters and ids: two objects and its share of the table.
    ENTRY = 200

    def __init__(self, path: str, room: int = ROOM):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.room = room
        self.kept: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for piece, i in vocabulary.items():
            self.width[i] = len(piece)  # a character stands for a byte

    @staticmethod
    def chunks(text: str) -> list[str]:
        parts = text.split(" ")
        if not _odd.search(text):
            return parts
        out = parts[:1]
        for p in parts[1:]:
            if not p or p[0].isspace():
                out[-1] += " " + p
            else:
                out.append(p)
        return out

    def encode(self, text: str) -> np.ndarray:
        # The batch call leaves out the places of the pieces, which nobody asks for here.
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def whole(self, text: str) -> bytes:
        return self.encode(text).tobytes()

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit numbers."""
        cut_up = [self.chunks(t) for t in texts]
        first = [chunks.pop(0) for chunks in cut_up]
        kept = self.kept
        new = list(set().union(*cut_up).difference(kept))
        extra: dict[str, bytes] = {}
        at = 0
        while at < len(new):
            to, size = at, 0
            while to < len(new) and (to == at or size < 1 << 20):
                size += len(new[to])
                to += 1
            part = new[at:to]
            ids = self.encode(" " + " ".join(part))
            ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum([len(c.encode("utf-8")) + 1 for c in part])) + 1
            raw, start = ids.tobytes(), 0
            for c, end in zip(part, ends.tolist(), strict=True):
                if self.room > 0:
                    self.room -= self.ENTRY + len(c) + 4 * (end - start)
                    kept[c] = raw[4 * start : 4 * end]
                else:
                    extra[c] = raw[4 * start : 4 * end]
                start = end
            at = to
        if extra:
            return [
                self.whole(f) + b"".join([kept[x] if x in kept else extra[x] for x in c])
                for f, c in zip(first, cut_up, strict=True)
            ]
        return [self.whole(f) + b"".join(map(kept.__getitem__, c)) for f, c in zip(first, cut_up, strict=True)]


_by_path: dict[tuple[str, int], ChunkIds] = {}


def chunk_ids(path: str, room: int = ROOM) -> ChunkIds:
    if (path, room) not in _by_path:
        _by_path[path, room] = ChunkIds(path, room)
    return _by_path[path, room]


def _pieces(path: str, room: int):
    end = np.array([END], "<u4").tobytes()

    def rows(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        seen = np.zeros(CAPACITY + 1, np.int64)
        for batch in batches:
            keys = batch["_id"].to_pylist()
            texts = batch["_text"].to_pylist()
            out = defaultdict(list)
            for at in range(0, len(keys), 64):
                for key, ids in zip(keys[at : at + 64], chunk_ids(path, room).of(texts[at : at + 64]), strict=True):
                    ids += end
                    n = len(ids) // 4
                    first = n % CAPACITY or CAPACITY
                    start = 0
                    for piece, stop in enumerate(range(first, n + 1, CAPACITY)):
                        out["doc_id"].append(key)
                        out["piece"].append(piece)
                        out["start"].append(start)
                        out["length"].append(stop - start)
                        out["ids_crc32"].append(zlib.crc32(ids[4 * start : 4 * stop]))
                        out["_task"].append(task)
                        out["_rank"].append(int(seen[stop - start]))
                        seen[stop - start] += 1
                        start = stop
            kinds = {"piece": pa.int32(), "_task": pa.int32()}
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "_task", "_rank")
            yield pa.RecordBatch.from_arrays([pa.array(out[c], kinds.get(c, pa.int64())) for c in names], list(names))

    return rows


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """(number of sequences, lengths in each) that use up ``counts`` of pieces by length."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out: list[tuple[int, tuple[int, ...]]] = []
    if left[capacity]:
        out.append((int(left[capacity]), (capacity,)))
        left[capacity] = 0

    def take(lengths: tuple[int, ...]) -> int:
        """As many sequences of these lengths as their pieces last."""
        need = np.bincount(lengths, minlength=capacity + 1)
        n = int((left[need > 0] // need[need > 0]).min())
        if n:
            left[need > 0] -= n * need[need > 0]
            out.append((n, lengths))
        return n

    def fills(gap: int) -> list[tuple[int, ...]]:
        """The first available single, pair or triple that sums to the gap, larger lengths first."""
        if left[gap]:
            return [(gap,)]
        have = np.flatnonzero(left[1:gap]) + 1
        partner = have[::-1]
        pairs = partner[(partner * 2 >= gap)]
        pairs = pairs[left[gap - pairs] > 0]
        if len(pairs):
            return [(int(x), gap - int(x)) for x in pairs]
        for x in partner[partner * 3 >= gap]:
            rest = gap - int(x)
            y = have[(have * 2 >= rest) & (have <= x) & (have < rest)]
            y = y[left[rest - y] > 0]
            if len(y):
                return [(int(x), int(v), rest - int(v)) for v in y[::-1]]
        return []

    spare: list[tuple[int, int]] = []
    for length in range(capacity - 1, 0, -1):
        while left[length]:
            used = 0
            for rest in fills(capacity - length):
                used += take((length, *rest))
                if not left[length]:
                    break
            if not used:
                # Alone with its last piece, or without a complement.
                spare.append((length, int(left[length])))
                left[length] = 0
    # Best fit of the residuals: sequences that look alike are held as one entry.
    open_: dict[int, list[list]] = defaultdict(list)
    for length, n in spare:
        while n:
            gap = next((g for g in range(length, capacity) if open_.get(g)), None)
            if gap is None:
                each = capacity // length
                if n >= each:
                    entry, used = [n // each, (length,) * each], n // each * each
                else:
                    entry, used = [1, (length,) * n], n
            else:
                entry = open_[gap].pop()
                used = min(n, entry[0])
                if used < entry[0]:
                    open_[gap].append([entry[0] - used, entry[1]])
                entry = [used, (*entry[1], length)]
            n -= used
            open_[capacity - sum(entry[1])].append(entry)
    return out + [(n, lengths) for entries in open_.values() for n, lengths in entries]


def slots(packed: list[tuple[int, tuple[int, ...]]]) -> dict[int, np.ndarray]:
    """By length: rows of (first rank, first sequence, offset), ordered by rank."""
    next_rank: dict[int, int] = defaultdict(int)
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for n, lengths in packed:
        offset = 0
        for length in lengths:
            rows[length].append((next_rank[length], sequence, offset))
            next_rank[length] += n
            offset += length
        sequence += n
    return {length: np.array(r, np.int64) for length, r in rows.items()}


def _place(where: dict[int, np.ndarray]):
    def rows(batches):
        for batch in batches:
            length = batch["length"].to_numpy()
            rank = batch["_base"].to_numpy() + batch["_rank"].to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for value in np.unique(length):
                at = np.flatnonzero(length == value)
                table = where[int(value)]
                row = table[np.searchsorted(table[:, 0], rank[at], side="right") - 1]
                sequence[at] = row[:, 1] + rank[at] - row[:, 0]
                offset[at] = row[:, 2]
            names = ("doc_id", "piece", "start", "length", "ids_crc32")
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
            )

    return rows


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pack(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, room: int = ROOM
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    rows = docs.select(F.col(key).cast("long").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    pieces = cut(mapped(rows, _pieces(path, room), f"{_PIECE}, _task int, _rank long"), "pieces")
    counts = cut(pieces.groupBy("_task", "length").count(), "piece-counts")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    # The ranks before a task's own: a window over one row per task and length.
    before = F.sum("count").over(Window.partitionBy("length").orderBy("_task")) - F.col("count")
    base = counts.select("_task", "length", before.alias("_base"))
    return mapped(
        pieces.join(base, ["_task", "length"]), _place(slots(plan(totals))), f"{_PIECE}, sequence_id long, offset long"
    )
