"""Document probability by a subword lattice.

The pieces are those of an existing public vocabulary. A word is written as a space and its bytes; pieces hold a
space only in front, so no piece crosses a word's start and the lattice of a text is a chain of word lattices and the
end mark. In a word's lattice one arc is the whole word, if the training texts have it, and a parallel path enters, by an
escape, all segmentations into pieces, closed by a stop. The probability of a text is the sum over all paths, a
forward recursion in log space, which needs to run only once per distinct word.

A text's own word shares aren't those of the corpus: it repeats its subject and keeps to one language. They are drawn from a
Dirichlet distribution around the corpus shares, with the weight of ``PRIOR`` words, and the score is the marginal over
all of them: after i words, of which j were w, the next is w with probability (PRIOR * p(w) + j) / (PRIOR + i).

A word seen c times weighs c less ``DISCOUNT``; what is taken off is the escape's weight, so that it is as large
as new words are frequent. Piece scores start from the vocabulary's own order (the n-th piece weighs 1/n) and are
estimated by expectation-maximisation, forward and backward, over all distinct training words: ``ROUNDS`` rounds and a last one.
The arcs of each word are found once and written; a round runs over the arcs of many words at a time. Every byte is a piece and keeps a little weight, so any text has
a probability above zero.

Word counts come from all training texts. Words are looked up where the texts are, if they are among the ``FREQUENT`` most
frequent (a bounded table that takes the hot keys out); all others are joined by word, counted per text.

Null texts count as empty: the end mark alone. Rows with a repeated or null key are scored each by itself. Without
training texts the starting scores stay and no word is known.
"""

from __future__ import annotations

import base64
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerq.llm.common import cut, mapped, remainder

VOCABULARY = "byte_bpe_50k.tiktoken"
FREQUENT, ROUNDS, DISCOUNT, LEAST_WEIGHT = 100_000, 4, 0.75, 0.01
PRIOR = 1000.0
#: Distinct words a task holds before it hands its counts on.
HELD = 300_000
#: Words up to this many bytes, space included, are estimated together, about ``BLOCK`` arcs at a time; longer ones one by one.
SHORT, BLOCK = 32, 400_000
#: A weight a byte that keeps the products of a short word's piece weights far from the ends of a double; it cancels out.
BYTE_SCALE = 1000.0


def pieces(path: str) -> list[bytes]:
    """The vocabulary in its own order."""
    with open(path, "rb") as file:
        rows = [line.split() for line in file]
    return [base64.b64decode(p) for p, _ in sorted(rows, key=lambda r: int(r[1]))]


#: A node of the tree of pieces: (number of the piece that ends here or -1, next byte -> node).
_tree: dict[str, tuple[int, dict]] = {}


def tree(path: str) -> tuple[int, dict]:
    """The tree of all pieces, built once per worker."""
    if path not in _tree:
        root: list = [-1, {}]
        for i, piece in enumerate(pieces(path)):
            node = root
            for byte in piece:
                node = node[1].setdefault(byte, [-1, {}])
            node[0] = i
        _tree[path] = root
    return _tree[path]


def forward(root, scores: list[float], text: bytes) -> list[float]:
    """Log weight of all segmentations of each prefix."""
    n, log1p, exp = len(text), math.log1p, math.exp
    a: list[float | None] = [None] * (n + 1)
    a[0] = 0.0
    for i in range(n):
        here, node = a[i], root
        for j in range(i, n):
            node = node[1].get(text[j])
            if node is None:
                break
            k = node[0]
            if k >= 0:
                s, t = here + scores[k], a[j + 1]
                if t is None:
                    a[j + 1] = s
                elif s > t:
                    a[j + 1] = s + log1p(exp(t - s))
                else:
                    a[j + 1] = t + log1p(exp(s - t))
    return a


def expect(root, scores: list[float], text: bytes, counts: list[float]) -> None:
    """Add the expected number of each piece in the segmentations of a word."""
    n, log1p, exp = len(text), math.log1p, math.exp
    a = forward(root, scores, text)
    b: list[float] = [0.0] * (n + 1)
    total = a[n]
    for i in range(n - 1, -1, -1):
        here, sum_, node = a[i] - total, None, root
        for j in range(i, n):
            node = node[1].get(text[j])
            if node is None:
                break
            k = node[0]
            if k >= 0:
                s = scores[k] + b[j + 1]
                counts[k] += exp(here + s)
                if sum_ is None:
                    sum_ = s
                elif s > sum_:
                    sum_ = s + log1p(exp(sum_ - s))
                else:
                    sum_ += log1p(exp(s - sum_))
        b[i] = sum_


def arcs(root, text: bytes) -> list[int]:
    """All pieces in a short word: number of the piece, start and end in one integer."""
    found = []
    for i in range(len(text)):
        node = root
        for j in range(i, len(text)):
            node = node[1].get(text[j])
            if node is None:
                break
            if node[0] >= 0:
                found.append(node[0] << 12 | i << 6 | j + 1)
    return found


def expect_together(codes: np.ndarray, word: np.ndarray, length: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """What ``expect`` adds for short words, summed: ``codes`` are the arcs of ``word``, an index into ``length``.

    ``weights`` are those of the pieces times ``BYTE_SCALE`` for each of their bytes. Arcs of one end and one length belong to
    different words and are followed in one step; ends go up for the weight before a place, and down for that behind it.
    """
    order = np.argsort(((codes & 63) << 6 | (codes & 63) - (codes >> 6 & 63)).astype(np.int16), kind="stable")
    codes, word = codes[order], word[order]
    piece, start, end = codes >> 12, codes >> 6 & 63, codes & 63
    weight = weights[piece]
    steps = np.flatnonzero(np.concatenate([[True], (end[1:] != end[:-1]) | (start[1:] != start[:-1])]))
    steps = [(lo, hi, start[lo], end[lo]) for lo, hi in zip(steps, (*steps[1:], len(codes)), strict=True)]
    before, behind = np.zeros((SHORT + 1, len(length))), np.zeros((SHORT + 1, len(length)))
    before[0] = 1.0
    for lo, hi, i, j in steps:
        at = word[lo:hi]
        before[j, at] += before[i, at] * weight[lo:hi]
    each = np.arange(len(length))
    behind[length, each] = 1 / before[length, each]
    share = np.empty(len(codes))
    for lo, hi, i, j in reversed(steps):
        at = word[lo:hi]
        part = behind[j, at] * weight[lo:hi]
        behind[i, at] += part
        share[lo:hi] = part * before[i, at]
    return np.bincount(piece, share, len(weights))


def words(text: str | None) -> list[bytes]:
    """Runs of anything but the six white-space bytes, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _count(batches):
    kinds = (pa.binary(), pa.int64(), pa.int64())

    def rows(train: Counter, held: Counter):
        all_ = list(train.keys() | held.keys())
        for at in range(0, len(all_), 50_000):
            part = all_[at : at + 50_000]
            columns = (part, [train[w] for w in part], [held[w] for w in part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "train", "held"]
            )

    counts = {False: Counter(), True: Counter()}
    for batch in batches:
        for text, held in zip(batch["_text"], batch["_held"].to_pylist(), strict=True):
            counts[held].update(words(text.as_py()))
            if len(counts[False]) + len(counts[True]) > HELD:
                yield from rows(counts[False], counts[True])
                counts = {False: Counter(), True: Counter()}
    yield from rows(counts[False], counts[True])


def _arcs(path: str):
    def rows(batches):
        root = tree(path)
        for batch in batches:
            short, long = [], []
            for word in batch["word"].to_pylist():
                is_long = len(word) >= SHORT
                short.append([] if is_long else arcs(root, b" " + word))
                long.append(word if is_long else None)
            sizes = pc.add(pc.binary_length(batch["word"]), 1).cast(pa.int32())
            yield pa.RecordBatch.from_arrays([sizes, pa.array(short, pa.list_(pa.int32())), pa.array(long, pa.binary())], ["size", "arcs", "long"])

    return rows


def _expected(path: str, scores):
    def rows(batches):
        counts, alone = np.zeros(len(scores.value)), None
        lengths = np.array([len(p) for p in pieces(path)])
        weights = np.exp(scores.value + lengths * math.log(BYTE_SCALE)) * (lengths < SHORT + 1)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def add() -> None:
            codes, per_word, length = (np.concatenate(c) for c in zip(*held, strict=True))
            counts[:] += expect_together(codes, np.repeat(np.arange(len(length)), per_word), length, weights)
            held.clear()

        for batch in batches:
            short = batch.filter(pc.is_null(batch["long"]))
            if short.num_rows:
                held.append((short["arcs"].flatten().to_numpy(), pc.list_value_length(short["arcs"]).to_numpy(), short["size"].to_numpy()))
                size += len(held[-1][0])
            if size > BLOCK:
                add()
                size = 0
            for word in batch["long"].drop_null().to_pylist():
                if alone is None:
                    root, plain, alone = tree(path), scores.value.tolist(), [0.0] * len(counts)
                expect(root, plain, b" " + word, alone)
        if held:
            add()
        if alone is not None:
            counts += alone
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at])], ["piece", "n"])

    return rows


def _scored(path: str, scores, stop: float, escape: float, total: int):
    """Natural log probability of words: the whole-word arc and all segmentations."""
    fixed = stop + escape

    def rows(batches):
        root, weights = tree(path), scores.value.tolist()
        for batch in batches:
            found = []
            for word, n in zip(batch["word"].to_pylist(), batch["train"].to_pylist(), strict=True):
                s = forward(root, weights, b" " + word)[-1] + fixed
                if n:
                    whole = math.log((n - DISCOUNT) / (total + 2))
                    s = max(s, whole) + math.log1p(math.exp(-abs(s - whole)))
                found.append(s / math.log(10))
            yield pa.RecordBatch.from_arrays(
                [batch["word"], batch["train"], batch["held"], pa.array(found, pa.float64())], ["word", "train", "held", "score"]
            )

    return rows


def repeated(score: float, n: int, prior: float = PRIOR) -> float:
    """log10 of what n occurrences of a word add to a text's numerator, from the log10 of the word's corpus share."""
    once = score + math.log10(prior)
    if n == 1:
        return once
    x = prior * 10.0**score
    return once + (math.lgamma(x + n) - math.lgamma(x + 1)) / math.log(10)


def drawn(n: int, prior: float = PRIOR) -> float:
    """log10 of a text's denominator: n draws, the end included."""
    return (math.lgamma(prior + n) - math.lgamma(prior)) / math.log(10)


def _looked_up(frequent, total: int, distinct: int, ending: tuple[int, float], prior: float):
    scale = math.log10(total + distinct + 1)
    base_end = math.log10(ending[0] + 1) - scale
    unit = math.log10(prior)

    def rows(batches):
        table = frequent.value
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("n", "known", "base", "score", "rest", "count")}
            offsets = [0]
            for text in batch["_text"]:
                found = words(text.as_py())
                known, base, score = int(ending[0] > 0), base_end, repeated(ending[1], 1, prior) - drawn(len(found) + 1, prior)
                for word, n in Counter(found).items():
                    entry = table.get(word)
                    if entry is None:
                        out["rest"].append(word)
                        out["count"].append(n)
                    else:
                        known += n * entry[0]
                        base += n * entry[1]
                        score += entry[2] + unit if n == 1 else repeated(entry[2], n, prior)
                offsets.append(len(out["rest"]))
                for c, v in (("n", len(found) + 1), ("known", known), ("base", base), ("score", score)):
                    out[c].append(v)
            rest = pa.StructArray.from_arrays([pa.array(out["rest"], pa.binary()), pa.array(out["count"], pa.int64())], ["word", "n"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch["_id"],
                    batch["_held"],
                    pa.array(out["n"], pa.int64()),
                    pa.array(out["known"], pa.int64()),
                    pa.array(out["base"], pa.float64()),
                    pa.array(out["score"], pa.float64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rest),
                ],
                ["_id", "_held", "_n", "_known", "_base", "_score", "_rest"],
            )

    return rows


def normal(counts: np.ndarray, words_: float) -> tuple[np.ndarray, float]:
    """Natural log probabilities of the pieces and of the stop after a word's last piece."""
    counts = counts + LEAST_WEIGHT
    total = counts.sum() + words_ + 1
    return np.log(counts / total), math.log((words_ + 1) / total)


def document_scores(
    docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, rounds: int = ROUNDS, prior: float = PRIOR
) -> DataFrame:
    """One row per row: key, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).cast("long").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"), (remainder(F.col(key), 7) == 2).alias("_held")
    )
    counted = cut(
        mapped(rows.select("_text", "_held"), _count, "word binary, train long, held long")
        .groupBy("word")
        .agg(F.sum("train").alias("train"), F.sum("held").alias("held")),
        "words",
    )
    ends = rows.where("not _held").count()
    sums = counted.where("train > 0").agg(F.coalesce(F.sum("train"), F.lit(0)), F.count(F.lit(1))).first()
    total, distinct = sums[0] + ends, sums[1] + (ends > 0)

    size, types = len(pieces(path)), sums[1]
    scores, stop = normal(1.0 / np.arange(1, size + 1) * max(types, 1), types / 4)
    if types:
        train = cut(mapped(counted.where("train > 0").select("word"), _arcs(path), "size int, arcs array<int>, long binary"), "arcs")
        for _ in range(rounds + 1):
            found, sent = np.zeros(size), spark.sparkContext.broadcast(scores)
            # One row per piece of the vocabulary at most.
            expected = mapped(train, _expected(path, sent), "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
            found[expected["piece"].to_numpy()] = expected["n"].to_numpy()
            # Every word stops once.
            scores, stop = normal(found, types)
            sent.destroy()
    end = math.log10((ends + 1) / (total + 2))
    escape = math.log((DISCOUNT * types + 1) / (total + 2))
    sent = spark.sparkContext.broadcast(scores)
    scored = cut(
        mapped(counted, _scored(path, sent, stop, escape, total), "word binary, train long, held long, score double"), "scored-words"
    )
    scale = math.log10(total + distinct + 1)
    top = scored.orderBy((F.col("train") + F.col("held")).desc(), "word").limit(FREQUENT).collect()
    frequent = spark.sparkContext.broadcast(
        {bytes(r["word"]): (int(r["train"] > 0), math.log10(r["train"] + 1) - scale, r["score"]) for r in top}
    )
    looked_up = cut(
        mapped(
            rows,
            _looked_up(frequent, total, distinct, (ends, end), prior),
            "_id long, _held boolean, _n long, _known long, _base double, _score double, _rest array<struct<word:binary,n:long>>",
        ).withColumn("_row", F.monotonically_increasing_id()),
        "looked-up",
    )
    # The same as repeated(), as a plain sum: rare words seldom occur often in a text.
    again = F.when(
        F.col("n") > 1,
        F.aggregate(F.sequence(F.lit(1).cast("long"), F.col("n") - 1), F.lit(0.0), lambda a, j: a + F.log10(prior * F.pow(F.lit(10.0), "score") + j)),
    ).otherwise(0.0)
    rest = (
        looked_up.select("_row", F.explode("_rest").alias("r"))
        .select("_row", "r.word", "r.n")
        .join(scored.select("word", "train", "score"), "word")
        .select(
            "_row",
            F.when(F.col("train") > 0, F.col("n")).otherwise(0).alias("_known"),
            (F.col("n") * (F.log10(F.col("train") + 1) - scale)).alias("_base"),
            (F.col("score") + math.log10(prior) + again).alias("_score"),
        )
    )
    fixed = looked_up.select("_row", "_known", "_base", "_score", "_id", "_held", "_n")
    return (
        fixed.unionByName(rest, allowMissingColumns=True)
        .groupBy("_row")
        .agg(
            F.max("_id").alias(key),
            F.max("_held").alias("held_out"),
            F.max("_n").alias("n_tokens"),
            F.sum("_known").alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            F.sum("_base").alias("base_score"),
            F.sum("_score").alias("score"),
        )
        .drop("_row")
    )
