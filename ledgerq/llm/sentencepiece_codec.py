"""SentencePiece encoding and decoding over an existing vocabulary.

An Aho-Corasick automaton over the pieces reads a text once; at each position its output links name every piece that
ends there, longest first, and each relaxes the best score of the position (unigram segmentation: the largest sum
of piece scores; of equal sums the one whose last piece is longest). Characters no piece covers become byte ids.

Pieces hold the space mark only in front, so segmentations don't cross the start of a run of spaces; what lies
between is encoded once and kept, up to ``limit`` distinct chunks per worker.

Null and empty texts have no ids. A literal space mark in a text reads back as a space, as it does in the library.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerq.llm.common import mapped

VOCABULARY = "piece_bpe_32k.model"
#: Fixed values of the format: the mark that stands for a space, and what an unknown character costs below the lowest score.
MARK, UNKNOWN = "▁", 10.0
_chunk = re.compile(r" +[^ ]*")


class Codec:
    def __init__(self, path: str, limit: int = 300_000):
        import ahocorasick
        import sentencepiece

        source = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: list[str] = []
        self.byte_ids = np.zeros(256, np.uint32)
        self.byte_of: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        self.singles: set[str] = set()
        lowest = 0.0
        for i in range(source.get_piece_size()):
            piece = source.id_to_piece(i)
            if source.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value], self.byte_of[i] = i, value
                self.pieces.append("")
            elif source.is_control(i) or source.is_unknown(i) or source.is_unused(i):
                self.pieces.append("")
            else:
                if re.search(f"[^{MARK}]{MARK}", piece):
                    raise ValueError(f"piece {piece!r} holds a space mark behind its front")
                score = source.get_score(i)
                lowest = min(lowest, score)
                self.automaton.add_word(piece, (len(piece), score, i))
                if len(piece) == 1:
                    self.singles.add(piece)
                self.pieces.append(piece.replace(MARK, " "))
        self.automaton.make_automaton()
        self.unknown = lowest - UNKNOWN
        self.limit = limit
        self.kept: dict[str, bytes] = {}

    def segment(self, chunk: str) -> list[int]:
        """Ids of a chunk with spaces as marks; unknown characters as the ids of their bytes."""
        n = len(chunk)
        best: list[float] = [0.0] + [float("-inf")] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        done = 0

        def unknown(to: int) -> None:
            """Relax the unknown characters behind the positions from done up to ``to``."""
            nonlocal done
            while done < to:
                if chunk[done] not in self.singles and best[done] + self.unknown > best[done + 1]:
                    best[done + 1] = best[done] + self.unknown
                    back[done + 1] = (1, -1)
                done += 1

        for end, (size, score, i) in self.automaton.iter(chunk):
            unknown(end)
            value = best[end + 1 - size] + score
            if value > best[end + 1]:
                best[end + 1] = value
                back[end + 1] = (size, i)
        unknown(n)
        out: list[int] = []
        at = n
        while at:
            size, i = back[at]
            if i < 0:
                out.extend(int(self.byte_ids[b]) for b in reversed(chunk[at - 1].encode("utf-8", "surrogatepass")))
            else:
                out.append(i)
            at -= size
        out.reverse()
        return out

    def encode(self, text: str | None) -> bytes:
        """The ids of a text, as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        kept, out = self.kept, []
        for chunk in _chunk.findall(" " + text.replace(MARK, " ")):
            ids = kept.get(chunk)
            if ids is None:
                ids = np.array(self.segment(chunk.replace(" ", MARK)), "<u4").tobytes()
                if len(kept) < self.limit:
                    kept[chunk] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        out: list[str] = []
        held = bytearray()
        for i in ids.tolist():
            value = self.byte_of.get(i)
            if value is not None:
                held.append(value)
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            out.append(self.pieces[i])
        if held:
            out.append(held.decode("utf-8", "replace"))
        return "".join(out)[1:]


_by_path: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _by_path:
        _by_path[path] = Codec(path)
    return _by_path[path]


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row per row: key and ids."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def rows(batches):
        for batch in batches:
            ids = [np.frombuffer(codec(path).encode(t.as_py()), "<u4").astype(np.int32) for t in batch["_text"]]
            yield pa.RecordBatch.from_arrays([batch["_id"], pa.array(ids, pa.list_(pa.int32()))], ["_id", "_ids"])

    return mapped(docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text")), rows, "_id long, _ids array<int>").toDF(key, "ids")


def decode(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """One row per row: key and text; null ids count as none."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def rows(batches):
        for batch in batches:
            texts = [codec(path).decode(np.array(x.as_py() or [], np.int64)) for x in batch["_ids"]]
            yield pa.RecordBatch.from_arrays([batch["_id"], pa.array(texts, pa.string())], ["_id", "_text"])

    return mapped(encoded.select(F.col(key).cast("long").alias("_id"), F.col(ids).alias("_ids")), rows, "_id long, _text string").toDF(key, "text")


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row per row: key, n_ids, n_byte_ids, ids_crc32 and whether decoding gives the text back."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def rows(batches):
        coder = codec(path)
        is_byte = np.zeros(len(coder.pieces), bool)
        is_byte[list(coder.byte_of)] = True
        for batch in batches:
            out = []
            for value in batch["_text"]:
                t = value.as_py() or ""
                raw = coder.encode(t)
                ids = np.frombuffer(raw, "<u4")
                out.append((len(ids), int(is_byte[ids].sum()), zlib.crc32(raw), coder.decode(ids) == t.replace(MARK, " ")))
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))],
                ["_id", "n_ids", "n_byte_ids", "ids_crc32", "round_trip"],
            )

    return mapped(
        docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text")),
        rows,
        "_id long, n_ids long, n_byte_ids long, ids_crc32 long, round_trip boolean",
    ).withColumnRenamed("_id", key)
