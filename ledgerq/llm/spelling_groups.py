"""Spelling variants of a corpus' words by search schemes over a bidirectional FM-index.

Words are counted over all texts. Two words are near if one inserted, deleted or replaced code point turns one into
the other. The two halves of a word make two search schemes, of which at least one finds any near word: the left half
matches exactly and the search goes on to the right, allowing one error there, or the right half matches exactly and
the search goes on to the left. The index is a pair of suffix-rank structures over the delimited vocabulary, one read
towards the left and one towards the right; as a search begins at a delimiter, it grows to one side only and carries
the suffix-rank interval of that side. Intervals of all words of a task advance together, one code point a step.

A word and all its near words share their first ``HEAD`` or their last ``TAIL`` code points, as an error lies in one half
only and words have ``SHORTEST`` code points or more. So the vocabulary is dealt by head for the one scheme and by tail
for the other, and each bucket has an index of its own. A bucket of more than ``BLOCK`` words, as one frequent head
makes it, is cut into blocks, and every block of words searches every block's index: no task holds more than two
blocks, and nothing is dropped. Pairs never leave a task, only the number of a word's near words and the best of them.

Defined results: null texts have no words; repeated rows, and rows of one key, count as often as they are there; a
null key counts as the empty string in the hash that decides on deletions; ties of the largest n go to the word that
is smaller in code-point order; words of any length are searched whole; an empty table gives no rows. Other columns
of the input are not read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerq.llm.common import cut, mapped

# Shortest word, fewest occurrences, one form of a run in so many loses a code point, how much
# more frequent a form must be.
SHORTEST, FEWEST, DELETED, RATIO = 7, 2, 31, 10
#: An error right of the first half leaves at least so many code points of the head as they are, and one left of it the tail.
HEAD = SHORTEST // 2
TAIL = SHORTEST - HEAD
BLOCK = 16_384
#: Words counted in a Python worker before they are handed on.
HELD = 100_000

#: Maximal runs that can give a word: shorter ones are passed over.
_run = re.compile(f"[A-Za-zÀ-ÿ]{{{SHORTEST},}}")


def _counted(batches):
    """Words with their counts, added up over as many batches as fit."""
    held = Counter()
    for batch in batches:
        for key, text in zip(batch["_key"].to_pylist(), batch["_text"].to_pylist(), strict=True):
            if not text:
                continue
            # Of bytes, lower() changes A-Z alone.
            runs = Counter(_run.findall(text.encode().lower().decode()))
            start = zlib.crc32(f"{key or ''}:".encode())
            for run, n in runs.items():
                h = zlib.crc32(run.encode(), start)
                if h % DELETED == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < SHORTEST:
                        continue
                held[run] += n
            if len(held) >= HELD:
                yield _counts(held)
                held = Counter()
    yield _counts(held)


def _counts(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: the words that occur ``FEWEST`` times or more in all texts."""
    rows = docs.select(F.col(key).cast("string").alias("_key"), F.col(text).cast("string").alias("_text"))
    return mapped(rows, _counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= FEWEST)


class SuffixRanks:
    """One direction of the index: suffix ranks of words of symbols 1 to ``top``, each closed by a delimiter 0.

    ``grow`` puts a symbol before what an interval of suffix ranks spells. The rank of a symbol up to a place is
    the place where ``symbol, place`` would stand among the sorted (symbol, place) of the transform, so that one
    binary search gives the new end of an interval.
    """

    def __init__(self, flat: np.ndarray, top: int):
        n = len(flat)
        closes = flat == 0
        self.words, self.top, self.width = int(closes.sum()), top, n + 1
        # Delimiters differ from each other by their place; suffixes then differ at their delimiter at the latest.
        rank = np.where(closes, np.cumsum(closes) - 1, self.words + flat.astype(np.int64))
        span = 1
        while True:
            key = rank * (self.words + top + n + 2)
            key[: n - span] += rank[span:] + 1
            order = np.argsort(key)
            new = np.empty(n, np.int64)
            new[order] = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0]))
            rank, span = new, 2 * span
            if n == 0 or rank[order[-1]] == n - 1 or span >= n:
                break
        self.before = flat[order - 1]
        by_symbol = np.argsort(self.before, kind="stable")
        self.sorted = self.before[by_symbol] * self.width + by_symbol
        # The words in the order of their first suffix.
        self.word = (np.cumsum(closes) - closes)[order[self.before == 0]]

    def grow(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = symbol * self.width
        return np.searchsorted(self.sorted, at + low), np.searchsorted(self.sorted, at + high)

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """Every growth of the intervals by a symbol that occurs: interval's number, symbol, new interval."""
        size = high - low
        few = np.flatnonzero(size <= self.top)
        of = np.repeat(few, size[few])
        at = np.arange(len(of)) - np.repeat(np.cumsum(size[few]) - size[few], size[few]) + low[of]
        pairs = np.unique(of * (self.top + 1) + self.before[at])
        many = np.flatnonzero(size > self.top)
        of = np.concatenate([pairs // (self.top + 1), np.repeat(many, self.top)])
        symbol = np.concatenate([pairs % (self.top + 1), np.tile(np.arange(1, self.top + 1), len(many))])
        of, symbol = of[symbol > 0], symbol[symbol > 0]
        new_low, new_high = self.grow(symbol, low[of], high[of])
        live = new_high > new_low
        return of[live], symbol[live], new_low[live], new_high[live]

    def whole(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which intervals spell a whole word, and that word's number."""
        first, last = self.grow(np.zeros(len(low), np.int64), low, high)
        hit = np.flatnonzero(last > first)
        return hit, self.word[first[hit]]


def one_error(index: SuffixRanks, symbols: np.ndarray, start: np.ndarray, length: np.ndarray, exact: np.ndarray):
    """Pairs (query, word) at exactly one error, which lies behind the first ``exact`` symbols of the query.

    Queries are given in the order in which the search reads them. An error stands at the first place where query
    and word differ, so that each word is met once: an inserted symbol differs from the one it stands before, and
    of a run of equal symbols the last is the one deleted.
    """
    q = np.arange(len(start))
    low, high = np.zeros(len(q), np.int64), np.full(len(q), index.words, np.int64)
    wrong = tuple(np.empty(0, np.int64) for _ in range(4))  # query, place, interval: searches that had their error
    found = []
    p = 0
    while len(q) or len(wrong[0]):
        # Searches that had their error read on, exactly.
        wq, wp, wl, wh = wrong
        ends = wp == length[wq]
        hit, word = index.whole(wl[ends], wh[ends])
        found.append((wq[ends][hit], word))
        wq, wp, wl, wh = (a[~ends] for a in (wq, wp, wl, wh))
        wl, wh = index.grow(symbols[start[wq] + wp], wl, wh)
        on = wh > wl
        parts = [(wq[on], wp[on] + 1, wl[on], wh[on])]
        # Searches without an error may have it here.
        may = exact[q] <= p
        mq, ml, mh = q[may], low[may], high[may]
        at_end = length[mq] == p
        here = np.where(at_end, 0, symbols[np.minimum(start[mq] + p, len(symbols) - 1)])
        last = length[mq] == p + 1
        following = np.where(at_end | last, 0, symbols[np.minimum(start[mq] + p + 1, len(symbols) - 1)])
        gone = ~at_end & (here != following)
        parts.append((mq[gone], np.full(int(gone.sum()), p + 1), ml[gone], mh[gone]))
        of, symbol, bl, bh = index.branches(ml, mh)
        other = symbol != here[of]
        of, bl, bh = of[other], bl[other], bh[other]
        replaced = ~at_end[of]
        parts.append((mq[of][replaced], np.full(int(replaced.sum()), p + 1), bl[replaced], bh[replaced]))
        parts.append((mq[of], np.full(len(of), p), bl, bh))
        wrong = tuple(np.concatenate(a) for a in zip(*parts, strict=True))
        # And go on without.
        more = length[q] > p
        q, low, high = q[more], low[more], high[more]
        low, high = index.grow(symbols[start[q] + p], low, high)
        live = high > low
        q, low, high = q[live], low[live], high[live]
        p += 1
    return tuple(np.concatenate(a) for a in zip(*found, strict=True)) if found else (q, q)


def _flat(words: list[str], closed: bool) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words in a row, with a delimiter behind each or without one, and the words' lengths."""
    text = ("\0".join(words) + "\0") if closed and words else "".join(words)
    return np.frombuffer(text.encode("utf-32-le"), "<u4"), np.fromiter(map(len, words), np.int64, len(words))


def _search(key, group):
    """One block of words against the index of one block: each word's near words there."""
    right = key[0].as_py()  # the scheme: left half exact, on to the right; or right half exact, on to the left
    words, n = group["word"].to_pylist(), group["n"].to_numpy()
    indexed, asks = np.flatnonzero(group["_indexed"]), np.flatnonzero(group["_asks"])
    # A search reads a word from its exact half on; the index spells words in the opposite direction, as growing goes
    # backwards.
    read = words if right else [w[::-1] for w in words]
    flat, _ = _flat([read[i][::-1] for i in indexed], True)
    symbols, length = _flat([read[i] for i in asks], False)
    letters = np.unique(np.concatenate([flat, symbols, np.zeros(1, flat.dtype)]))
    index = SuffixRanks(np.searchsorted(letters, flat), len(letters) - 1)
    exact = length // 2 if right else length - length // 2
    q, w = one_error(index, np.searchsorted(letters, symbols), np.cumsum(length) - length, length, exact)
    q, w = asks[q], indexed[w]
    if not right:
        # An error inside a run of equal letters around the middle is found from both halves: it counts for the left one.
        own = [words[a][: len(words[a]) // 2] != words[b][: len(words[a]) // 2] for a, b in zip(q.tolist(), w.tolist(), strict=True)]
        q, w = q[np.array(own, bool)], w[np.array(own, bool)]
    place = np.empty(len(words), np.int64)
    place[np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)] = np.arange(len(words))
    order = np.lexsort((place[w], -n[w], q))
    q, w = q[order], w[order]
    near = np.bincount(q, minlength=len(words))[asks]
    first, at = np.unique(q, return_index=True)
    best = np.full(len(words), -1)
    best[first] = w[at]
    best = best[asks]
    form = [words[b] if b >= 0 else None for b in best.tolist()]
    return pa.table(
        {
            "word": group["word"].take(pa.array(asks)),
            "n": group["n"].take(pa.array(asks)),
            "near": pa.array(near, pa.int64()),
            "form": pa.array(form, pa.string()),
            "form_n": pa.array(np.where(best >= 0, n[best], 0), pa.int64(), mask=best < 0),
        }
    )


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, n, n_near, best, best_n`` of distinct words with their counts: how many are near, and the most frequent one.

    ``best`` and ``best_n`` are null where no word is near.
    """
    # Twice as many buckets as blocks are needed: most buckets are one block.
    buckets = 2 * max(1, -(-words.count() // block))
    dealt = words.select(
        "word",
        "n",
        F.explode(
            F.array(
                F.struct(F.lit(True).alias("right"), F.substring("word", 1, HEAD).alias("part")),
                F.struct(F.lit(False).alias("right"), F.substring("word", -TAIL, TAIL).alias("part")),
            )
        ).alias("_at"),
    ).select("word", "n", F.col("_at.right").alias("_right"), F.pmod(F.xxhash64("_at.part"), F.lit(buckets)).alias("_bucket"))
    sizes = dealt.groupBy("_right", "_bucket").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_blocks"))
    # At most 4 * words / block rows, so one for some thousands of words: small, and its size is known when it is joined.
    sizes = cut(sizes, "spelling-buckets")
    own = F.pmod(F.xxhash64(F.lit(1), "word"), F.col("_blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("_blocks") - 1)
    placed = (
        dealt.join(sizes, ["_right", "_bucket"])
        .withColumn("_own", own)
        .withColumn(
            "_to",
            F.explode(
                F.concat(
                    F.transform(every, lambda i: F.struct(F.col("_own").alias("x"), i.alias("y"))),
                    F.transform(F.filter(every, lambda i: i != F.col("_own")), lambda i: F.struct(i.alias("x"), F.col("_own").alias("y"))),
                )
            ),
        )
        # Block x asks the index of block y.
        .select(
            "_right",
            "_bucket",
            F.col("_to.x").alias("_x"),
            F.col("_to.y").alias("_y"),
            "word",
            "n",
            (F.col("_to.x") == F.col("_own")).alias("_asks"),
            (F.col("_to.y") == F.col("_own")).alias("_indexed"),
        )
    )
    met = placed.groupBy("_right", "_bucket", "_x", "_y").applyInArrow(_search, "word string, n long, near long, form string, form_n long")
    return (
        met.groupBy("word")
        .agg(
            F.first("n").alias("n"),
            F.sum("near").alias("n_near"),
            F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("m"), F.col("form").alias("w")))).alias("_best"),
        )
        .select("word", "n", "n_near", F.col("_best.w").alias("best"), (-F.col("_best.m")).alias("best_n"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form: the last of the forms that follow each other.

    A form is at least ``RATIO`` times as frequent as its word, so no chain is longer than the digits of the
    largest count; each round follows one more form, of the words whose chain goes on.
    """
    step = forms.select(F.col("word").alias("_from"), F.col("form").alias("_next"))
    going = forms.select("word", F.col("form").alias("root"))
    ended = None
    while True:
        met = cut(going.join(step, F.col("root") == F.col("_from"), "left").select("word", "root", "_next"), "spelling-roots")
        done = met.where("_next is null").select("word", "root")
        ended = done if ended is None else ended.unionByName(done)
        going = met.where("_next is not null").select("word", F.col("_next").alias("root"))
        if going.isEmpty():
            return ended


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``."""
    words = cut(vocabulary(docs, key, text), "spelling-words")
    near = near_words(words, block)
    is_form = F.col("best_n") >= RATIO * F.col("n")
    near = cut(
        near.select(
            "word", "n", "n_near", F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")
        ),
        "spelling-near",
    )
    ends = roots(near.where("form is not null"))
    return near.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
