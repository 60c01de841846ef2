"""Fill-in-the-middle texts by a piece table.

A document is never copied while it is rearranged: it is a list of descriptors ``(buffer, start, end)`` over two
immutable buffers, its own bytes and the bytes of the three sentinels. Two cuts split the one descriptor that spans
the text into prefix, middle and suffix, an arrangement permutes these and puts a sentinel's descriptor before each
part, and the output's bytes, or a hash of them, stream from the descriptors. Going back, an output is cut at its
sentinels and the inverse permutation puts the parts in their old order.

Where the cuts fall and which form a text takes depends on its key alone, by a hash, so that any run, partition or
retried task gives the same. All work is row by row; nothing is shuffled.

Defined results: a null text counts as empty; an empty text and one that holds a sentinel stay plain; a null key
counts as the empty string in the hash and stays null; repeated rows are transformed each for itself; any length of
text takes memory of a few times its size; an empty table gives no rows. ``transform`` and ``restore`` keep all
other columns; a column of the input that has the name of a new one is replaced, as ``withColumn`` does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerq.llm.common import mapped

# The sentinels of prefix, suffix and middle, and the shares of plain and suffix-first texts.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM, SPM_BELOW = 90, 20

TEXT, SENTINEL = 0, 1
SENTINELS = PREFIX + SUFFIX + MIDDLE
#: Form: the part that follows each sentinel, in the order of the output. Parts: 0 prefix, 1 middle, 2 suffix.
ARRANGEMENTS = {
    "psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)),
    "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1)),
}

NEW = "_units long, _form string, _prefix_chars long, _middle_chars long, _output string"
NAMES = {
    "_units": "n",
    "_form": "form",
    "_prefix_chars": "prefix_chars",
    "_middle_chars": "middle_chars",
    "_output": "output",
}


class PieceTable:
    """Descriptors over the immutable buffers of one text and of the sentinels."""

    def __init__(self, text: bytes, descriptors: Iterable[tuple[int, int, int]] | None = None):
        self.buffers = (memoryview(text), memoryview(SENTINELS))
        self.descriptors = list(descriptors) if descriptors is not None else [(TEXT, 0, len(text))]

    def cut(self, *places: int) -> PieceTable:
        """Split the descriptors at rising places of the content they spell; a place at an end leaves an empty one."""
        out, at = [], 0
        places = list(places)
        for buffer, start, end in self.descriptors:
            while places and places[0] <= at + end - start:
                place = start + places.pop(0) - at
                out.append((buffer, start, place))
                at, start = at + place - start, place
            out.append((buffer, start, end))
            at += end - start
        return PieceTable(self.buffers[TEXT], out)

    def arranged(self, form: str) -> PieceTable:
        """The three parts in the order of a form, each behind its sentinel."""
        out = []
        for sentinel, part in ARRANGEMENTS[form]:
            at = SENTINELS.index(sentinel)
            out += [(SENTINEL, at, at + len(sentinel)), self.descriptors[part]]
        return PieceTable(self.buffers[TEXT], out)

    def inverse(self, form: str) -> PieceTable:
        """The parts of an arranged table in their old order, without the sentinels."""
        parts = [part for _, part in ARRANGEMENTS[form]]
        return PieceTable(self.buffers[TEXT], [self.descriptors[2 * parts.index(p) + 1] for p in range(3)])

    def stream(self) -> Iterable[memoryview]:
        for buffer, start, end in self.descriptors:
            yield self.buffers[buffer][start:end]

    def bytes(self) -> bytes:
        return b"".join(self.stream())

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.stream():
            digest.update(part)
        return digest.hexdigest()


def parsed(output: bytes, form: str) -> PieceTable:
    """An output as a table over its own bytes: cut before and behind each sentinel of the form."""
    places, at = [], 0
    for sentinel, _ in ARRANGEMENTS[form]:
        at = output.index(sentinel, at)
        places += [at, at + len(sentinel)]
        at += len(sentinel)
    # The first cut leaves an empty descriptor: every output starts with a sentinel.
    return PieceTable(output, PieceTable(output).cut(*places).descriptors[1:])


def unit_starts(text: bytes) -> np.ndarray:
    """Byte places where a unit of ``[A-Za-z]+|[^A-Za-z]`` starts."""
    b = np.frombuffer(text, np.uint8)
    letter = ((b | 32) - np.uint8(97)) < 26
    begins = (b & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(begins)


def code_points(part: memoryview) -> int:
    return int(np.count_nonzero((np.frombuffer(part, np.uint8) & 0xC0) != 0x80))


def _arrange(text: bytes, digest: str) -> tuple:
    starts = unit_starts(text)
    n = len(starts)
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or h[2] % 100 >= PLAIN_FROM or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    parts = PieceTable(text).cut(*(int(starts[i]) if i < n else len(text) for i in (low, high)))
    form = "spm" if h[3] % 100 < SPM_BELOW else "psm"
    prefix, middle, _ = parts.stream()
    return n, form, code_points(prefix), code_points(middle), parts.arranged(form).bytes()


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _with(batch: pa.RecordBatch, inputs: int, **new: pa.Array) -> pa.RecordBatch:
    """The batch with new columns in place of its last ``inputs`` ones."""
    names = batch.schema.names[: len(batch.schema.names) - inputs]
    return pa.RecordBatch.from_arrays([batch[i] for i in range(len(names))] + list(new.values()), names + list(new))


def _string(values: list) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _transformed(batches):
    for batch in batches:
        rows = [_arrange(t, d) for t, d in zip(_texts(batch["_text"]), batch["_digest"].to_pylist(), strict=True)]
        n, form, prefix, middle, output = zip(*rows, strict=True) if rows else ((),) * 5
        yield _with(
            batch,
            2,
            _units=pa.array(n, pa.int64()),
            _form=pa.array(form, pa.string()),
            _prefix_chars=pa.array(prefix, pa.int64()),
            _middle_chars=pa.array(middle, pa.int64()),
            _output=_string(output),
        )


def _tables(batch: pa.RecordBatch) -> Iterable[tuple[PieceTable, PieceTable]]:
    """Of each output its table and that of the text it was made from."""
    for output, form in zip(_texts(batch["_out"]), batch["_how"].to_pylist(), strict=True):
        table = parsed(output, form) if form in ARRANGEMENTS else PieceTable(output)
        yield table, table.inverse(form) if form in ARRANGEMENTS else table


def _restored(batches):
    for batch in batches:
        yield _with(batch, 2, _restored=_string([old.bytes() for _, old in _tables(batch)]))


def _hashed(batches):
    for batch in batches:
        hashes = [(new.sha256(), old.sha256()) for new, old in _tables(batch)]
        of = lambda i: pa.array([h[i] for h in hashes], pa.string())  # noqa: E731, B023
        yield _with(batch, 2, _output_sha256=of(0), _restored_sha256=of(1))


def _appended(df: DataFrame, inputs: dict, rows, new: str, names: dict[str, str]) -> DataFrame:
    """``df`` with new columns that an Arrow function derives from ``inputs``; equal names are replaced."""
    columns = df.columns
    plain = df.toDF(*(f"c{i}" for i in range(len(columns))))
    given = {k: plain[f"c{columns.index(v)}"] if isinstance(v, str) else v(plain, columns) for k, v in inputs.items()}
    schema = T.StructType(plain.schema.fields + T.StructType.fromDDL(new).fields)
    made = mapped(plain.select("*", *(c.alias(k) for k, c in given.items())), rows, schema)
    kept = [(f"c{i}", c) for i, c in enumerate(columns) if c not in names.values()]
    return made.select(*(F.col(a).alias(b) for a, b in kept), *(F.col(a).alias(b) for a, b in names.items()))


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", epoch: int = 1) -> DataFrame:
    """The rows with ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Another ``epoch`` draws other cuts and forms.
    """
    digest = lambda df, cs: F.sha2(
        F.concat(F.lit(f"{epoch}:"), F.coalesce(df[f"c{cs.index(key)}"].cast("string"), F.lit(""))).cast("binary"), 256
    )
    return _appended(docs, {"_text": text, "_digest": digest}, _transformed, NEW, NAMES)


def restore(rows: DataFrame, output: str = "output", form: str = "form", into: str = "restored") -> DataFrame:
    """The rows with the text that an output of ``transform`` was made from."""
    return _appended(rows, {"_out": output, "_how": form}, _restored, "_restored string", {"_restored": into})


def digests(rows: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """The rows with ``output_sha256`` and, of the text rebuilt from output and form, ``restored_sha256``."""
    return _appended(
        rows,
        {"_out": output, "_how": form},
        _hashed,
        "_output_sha256 string, _restored_sha256 string",
        {"_output_sha256": "output_sha256", "_restored_sha256": "restored_sha256"},
    )
