"""Language identification by prediction by partial matching.

For each language a context tree of byte contexts of length 0 to ``DEPTH`` holds how often each byte followed each
context in the training texts. Under these frozen statistics a byte that followed the longest known context
costs -log2 of its share; otherwise the context's escape (method C: d / (n + d) for d distinct followers in n
occurrences) is paid and the next shorter context tried, down to a uniform byte. The code length of a text is exact: no
byte of it is left out. The language with the shortest code wins; the score is its posterior among equally likely languages.

Contexts are learned from a bounded hash sample: about ``SAMPLE`` texts of each language, whole. Of each length, the
``CONTEXTS`` most frequent contexts are held, which bounds what tasks are sent.

A text that is null or has no letter is ``und`` with score 0, and so is any text if there is nothing to learn from.
Ties go to the first language by name. The score compares the languages only with each other. Whether a text is in any of
them, ``keep_identified`` asks the language's own letters: a text that its contexts do not code shorter is in none, or
in several at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerq.llm.common import cut, mapped, remainder

DEPTH, SAMPLE, CONTEXTS = 4, 600, 1 << 16
UNDETERMINED = "und"
LEAST_SCORE = 0.5
#: Bytes of a text worked on at a time.
SPAN = 1 << 19
#: The share of its bits that a code must save to count as shorter; below it is rounding.
ROUNDING = 1e-6


def _grams(batches):
    """Counts of byte strings of length 1 to DEPTH + 1 by language, packed into one number."""
    for batch in batches:
        langs = np.array(batch["_lang"].to_pylist(), object)
        texts = batch["_text"].to_pylist()
        for lang in sorted(set(langs)):
            found: dict[int, list[np.ndarray]] = {k: [] for k in range(1, DEPTH + 2)}
            for i in np.flatnonzero(langs == lang):
                x = np.frombuffer((texts[i] or "").encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64)
                code = x
                for k in range(1, DEPTH + 2):
                    if k > 1:
                        code = code[:-1] * 256 + x[k - 1 :]
                    found[k].append(code)
                    if len(code) <= 1:
                        break
            for k, parts in found.items():
                if parts:
                    codes, counts = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(codes), pa.string()),
                            pa.array([k] * len(codes), pa.int32()),
                            pa.array(codes),
                            pa.array(counts.astype(np.int64)),
                        ],
                        ["lang", "size", "code", "n"],
                    )


def _low(k: int) -> int:
    """A mask of the last k bytes."""
    return (1 << 8 * k) - 1


def _among(code: np.ndarray, strings: np.ndarray) -> np.ndarray:
    at = np.searchsorted(strings, code)
    return (at < len(strings)) & (np.append(strings, -1)[at] == code)


class ContextTrees:
    """The trees of all languages over one numbering of contexts; number 0 is a context nobody knows."""

    def __init__(self, langs: list[str], rows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
        """rows by string length: (language numbers, codes, counts)."""
        self.langs = langs
        n_langs = len(langs)
        seen = np.unique(rows[1][1]) if 1 in rows else np.empty(0, np.int64)
        self.letter = np.zeros(256, np.int32)  # 0: a byte never seen
        self.letter[seen] = np.arange(1, len(seen) + 1)
        width = self.width = len(seen) + 1
        self.steps: list[np.ndarray] = []  # by length - 1: number of the string without its last byte, byte -> number
        self.bits: list[np.ndarray] = []  # by length - 1: bits of the last byte after the others, by language
        self.escapes: list[np.ndarray] = []  # by length: bits of the context's escape, by language
        floor = np.full((1, n_langs), 8.0)
        numbers = np.empty(0, np.int64)  # the strings one shorter, in the order of their numbers
        shorter_bits = floor
        for k in range(1, DEPTH + 2):
            lang, code, n = rows.get(k, (np.empty(0, np.int64),) * 3)
            if k > 1:
                # A string is held only with the two strings one shorter that it contains.
                held = _among(code >> 8, numbers) & _among(code & _low(k - 1), numbers)
                lang, code, n = lang[held], code[held], n[held]
            strings = np.unique(code)
            # The context of length 0 is number 0 of its kind; others count from 1.
            context = np.searchsorted(numbers, code >> 8) + 1 if k > 1 else np.zeros(len(code), np.int64)
            of = np.searchsorted(numbers, strings >> 8) + 1 if k > 1 else np.zeros(len(strings), np.int64)
            total, distinct = np.zeros((len(numbers) + 1, n_langs)), np.zeros((len(numbers) + 1, n_langs))
            np.add.at(total, (context, lang), n)
            np.add.at(distinct, (context, lang), 1)
            escape = np.where(distinct > 0, np.log2(np.maximum(total + distinct, 1) / np.maximum(distinct, 1)), 0.0)
            # A language without the string pays its escape, if it knows the context, and the next shorter one's bits.
            if k > 1:
                shorter = shorter_bits[np.searchsorted(numbers, strings & _low(k - 1)) + 1]
            else:
                shorter = np.repeat(floor, len(strings), axis=0)
            bits = np.zeros((len(strings) + 1, n_langs))
            bits[1:] = escape[of] + shorter
            bits[np.searchsorted(strings, code) + 1, lang] = np.log2((total[context, lang] + distinct[context, lang]) / n)
            step = np.zeros((len(numbers) + 1) * width, np.int32)
            step[of * width + self.letter[strings & 255]] = np.arange(1, len(strings) + 1)
            self.steps.append(step)
            self.bits.append(bits.astype(np.float32))
            self.escapes.append(escape.astype(np.float32))
            numbers, shorter_bits = strings, bits
        #: By byte: bits without a context, by language.
        self.alone = np.where((self.letter > 0)[:, None], self.bits[0][self.letter], self.escapes[0][0] + 8.0).astype(np.float64)

    def letters_length(self, data: bytes) -> np.ndarray:
        """Bits of the whole text by language if each byte is coded without its context."""
        return np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ self.alone

    def code_length(self, data: bytes) -> np.ndarray:
        """Bits of the whole text by language."""
        total = np.zeros(len(self.langs))
        for at in range(0, len(data), SPAN):
            before = max(0, at - DEPTH)
            total += self._span(np.frombuffer(data[before : at + SPAN], np.uint8), at - before)
        return total

    def _span(self, x: np.ndarray, skip: int) -> np.ndarray:
        letters = self.letter[x]
        n = len(x)
        # number[k]: of the string of the last k bytes up to each position; 0 where unknown or cut by the text's start.
        number = [np.zeros(n, np.int32)]
        for k in range(1, DEPTH + 2):
            got = np.zeros(n, np.int32)
            if k == 1:
                got = self.steps[0][letters]
            elif n >= k:
                got[k - 1 :] = self.steps[k - 1][number[k - 1][k - 2 : -1].astype(np.int64) * self.width + letters[k - 1 :]]
                got[letters == 0] = 0
                got[k - 1 :][number[k - 1][k - 2 : -1] == 0] = 0
            number.append(got)
        open_ = np.arange(skip, n)
        total = np.zeros(len(self.langs))
        for k in range(DEPTH + 1, 0, -1):
            known = number[k][open_]
            found = known > 0
            total += np.take(self.bits[k - 1], known[found], axis=0).sum(axis=0, dtype=np.float64)
            open_ = open_[~found]
            if not len(open_):
                return total
            if k > 1:
                context = np.where(open_ > 0, number[k - 1][open_ - 1], 0)
                total += np.take(self.escapes[k - 1], context, axis=0).sum(axis=0, dtype=np.float64)
            else:
                total += len(open_) * (self.escapes[0][0] + 8.0)
        return total


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> ContextTrees | None:
    """Context trees from a sample of rows with a text and a language whose key is not held out."""
    rows = docs.where(
        (remainder(F.col(key), 3) != 1) & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")
    ).select(F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    sizes = {r["_lang"]: r["count"] for r in rows.groupBy("_lang").count().collect()}
    if not sizes:
        return None
    # A share per language such that about `sample` texts remain, spread evenly by a hash of the text.
    share = F.create_map(*[F.lit(x) for kv in sizes.items() for x in (kv[0], min(1.0, sample / kv[1]))])
    chosen = rows.where(F.pmod(F.xxhash64("_text"), 1_000_000) < share[F.col("_lang")] * 1_000_000)
    counted = cut(
        mapped(chosen, _grams, "lang string, size int, code long, n long").groupBy("lang", "size", "code").agg(F.sum("n").alias("n")),
        "grams",
    )
    langs = sorted(sizes)
    out = {}
    for k in range(1, DEPTH + 2):
        rows_k = counted.where(F.col("size") == k)
        top = rows_k.groupBy("code").agg(F.sum("n").alias("_all")).orderBy(F.desc("_all"), "code").limit(CONTEXTS)
        got = rows_k.join(F.broadcast(top.select("code")), "code").select("lang", "code", "n").toArrow()
        names = got["lang"].to_pylist()
        out[k] = (
            np.array([langs.index(x) for x in names], np.int64),
            got["code"].to_numpy().astype(np.int64),
            got["n"].to_numpy().astype(np.int64),
        )
    return ContextTrees(langs, out)


def decide(trees: ContextTrees | None, text: str | None, letters: bool | None) -> tuple[str, float]:
    if trees is None or not letters:
        return UNDETERMINED, 0.0
    return _decided(trees, trees.code_length(text.encode("utf-8", "surrogatepass")))


def _decided(trees: ContextTrees, bits: np.ndarray) -> tuple[str, float]:
    best = int(np.argmin(bits))
    return trees.langs[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())


def identified(trees: ContextTrees | None, text: str | None, letters: bool | None, least: float, by_context: bool) -> bool:
    """Whether a language has at least the given score and, with ``by_context``, codes the text shorter than its letters do."""
    if trees is None or not letters:
        return False
    data = text.encode("utf-8", "surrogatepass")
    bits = trees.code_length(data)
    lang, score = _decided(trees, bits)
    if lang == UNDETERMINED or score < least:
        return False
    best = trees.langs.index(lang)
    return not by_context or bool(bits[best] < trees.letters_length(data)[best] * (1 - ROUNDING))


def _letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, trees: ContextTrees | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: key, held_out, lang_pred, score."""
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def rows(batches):
        for batch in batches:
            found = [
                decide(model.value, t.as_py(), ok)
                for t, ok in zip(batch["_text"], batch["_ok"].to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], batch["_out"], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["_id", "_out", "_lang", "_score"],
            )

    return mapped(
        docs.select(
            F.col(key).cast("long").alias("_id"),
            (remainder(F.col(key), 3) == 1).alias("_out"),
            F.col(text).alias("_text"),
            _letters(F.col(text)).alias("_ok"),
        ),
        rows,
        "_id long, _out boolean, _lang string, _score double",
    ).toDF(key, "held_out", "lang_pred", "score")


def keep_identified(
    docs: DataFrame, trees: ContextTrees | None, text: str = "text", least: float = LEAST_SCORE, by_context: bool = False
) -> DataFrame:
    """The rows whose language is determined with at least the given score, with all their columns.

    With ``by_context`` only those whose language codes them shorter by its contexts than by its letters alone.
    """
    model = docs.sparkSession.sparkContext.broadcast(trees)
    at = docs.columns.index(text)

    def rows(batches):
        for batch in batches:
            keep = [
                identified(model.value, t.as_py(), ok, least, by_context)
                for t, ok in zip(batch.column(at), batch.column(batch.num_columns - 1).to_pylist(), strict=True)
            ]
            yield batch.select(range(batch.num_columns - 1)).filter(pa.array(keep, pa.bool_()))

    return docs.select("*", _letters(F.col(text))).mapInArrow(rows, docs.schema)
