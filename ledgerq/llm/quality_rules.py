"""Quality rules as weak supervision.

Each rule looks at a whole text and votes good, bad, or abstains. Expectation-maximisation over all texts estimates, without
labels, how often each rule's vote is right for good and for bad texts (the two accuracies of a rule) and the
share of bad texts; a text's posterior probability of being good then decides, instead of "all rules must pass".
There are at most 3 ** rules vote patterns, so the estimation runs over a small table of pattern counts. It counts
the texts that don't fail outright, as those that do (too few words, mostly repeated) are decided already.

Rules overlap (symbols, words that hold some and few letters, say), so that the estimation can tell a rule that others bear
out from one that stands alone. It starts from "the more rules say bad, the likelier bad". The prior of each estimate weighs as
much as ``PRIOR`` texts, whatever their number.

Null texts count as empty: no word, failed. Rows with repeated or null keys are judged each by itself, texts of any length
as a whole; a posterior of exactly one half is good. An empty table gives no rows. Columns other than key and text aren't looked at.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerq.llm.common import cut, mapped

LEAST_WORDS, MOST_REPEATED_PCT = 50, 50
ROUNDS, PRIOR = 300, 2.0
_spaces = {i: None for i in (0x20, *range(0x09, 0x0E))}
_symbols = re.compile(r"[#*$%&|<>]+")
_word = re.compile(r"[^\x20\x09-\x0D]+")
_letter = re.compile(r"[^\W\d_]")
_letters = re.compile(r"[^\W\d_]+")

#: (name, measure, good up to, bad from): between the two a rule abstains.
RULES = (
    ("odd_word_length", "odd_length", 0.0, 0.5),
    ("symbols", "symbol_rate", 0.02, 0.1),
    ("repeated_lines", "line_rate", 0.2, 0.5),
    ("repeated_words", "repeat_rate", 0.2, 0.4),
    ("no_letters", "letterless_rate", 0.1, 0.3),
    ("capitals", "capital_rate", 0.1, 0.4),
    ("exclamations", "exclaim_rate", 0.05, 0.25),
    ("words_with_symbols", "symbol_word_rate", 0.02, 0.1),
    ("few_letters", "other_rate", 0.1, 0.2),
)
NAMES = [r[0] for r in RULES]


def repeated(words: list[str]) -> int:
    """Words inside three-word windows that occur at least twice, the first included."""
    if len(words) < 4:
        return 0
    numbers: dict[str, int] = {}
    a = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
    n = len(numbers)
    _, pair = np.unique(a[:-1] * n + a[1:], return_inverse=True)
    _, which, times = np.unique(pair[:-1] * n + a[2:], return_inverse=True, return_counts=True)
    again = times[which] > 1
    marked = np.zeros(len(words), bool)
    for shift in range(3):
        marked[shift : shift + len(again)] |= again
    return int(marked.sum())


def measures(text: str) -> tuple[list[int], dict[str, float]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and what the rules look at."""
    words = _word.findall(text)
    n = len(words)
    lines = [x for x in text.split("\n") if x.translate(_spaces)]
    base = [
        n,
        len(text) - sum(text.count(c) for c in " \t\n\v\f\r"),
        sum(map(len, _symbols.findall(text))),
        len(lines) - len(set(lines)),
        repeated(words),
    ]
    rate = 1 / max(n, 1)
    mean = base[1] * rate
    return base, {
        "odd_length": float(not 2 <= mean <= 15) if n else 1.0,
        "symbol_rate": base[2] * rate,
        "line_rate": base[3] / max(len(lines), 1),
        "repeat_rate": base[4] * rate,
        "letterless_rate": sum(not _letter.search(w) for w in words) * rate,
        "capital_rate": sum(len(w) > 1 and w.isupper() for w in words) * rate,
        "exclaim_rate": text.count("!") * rate,
        "symbol_word_rate": sum(_symbols.search(w) is not None for w in words) * rate if base[2] else 0.0,
        "other_rate": 1 - sum(map(len, _letters.findall(text))) / max(base[1], 1) if n else 0.0,
    }


def votes(found: dict[str, float]) -> int:
    """The votes as digits to base 3, first rule last: 0 abstains, 1 good, 2 bad."""
    code = 0
    for _, measure, good, bad in reversed(RULES):
        v = found[measure]
        code = code * 3 + (1 if v <= good else 2 if v >= bad else 0)
    return code


def _measured(batches):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for batch in batches:
        base, codes = [], []
        for text in batch["_text"]:
            b, found = measures(text.as_py())
            base.append(b)
            codes.append(votes(found))
        columns = np.array(base, np.int64).reshape(-1, 5).T
        yield pa.RecordBatch.from_arrays(
            [batch["_id"], *(pa.array(c) for c in columns), pa.array(codes, pa.int32())], ["_id", *names, "votes"]
        )


def digits(codes: np.ndarray) -> np.ndarray:
    return (codes[:, None] // 3 ** np.arange(len(RULES))) % 3


def estimate(codes: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of good by pattern, accuracies: a row per rule of P(good | good), P(bad | bad))."""
    v = digits(codes)
    good, bad = v == 1, v == 2
    post = np.where(bad.any(axis=1), 0.3 ** bad.sum(axis=1), 0.95)
    accuracy = np.zeros((len(RULES), 2))
    for _ in range(rounds):
        w, u = counts * post, counts * (1 - post)
        accuracy[:, 0] = (w @ good + 0.9 * PRIOR) / (w @ (good | bad) + PRIOR)
        accuracy[:, 1] = (u @ bad + 0.5 * PRIOR) / (u @ (good | bad) + PRIOR)
        share = (w.sum() + 0.9 * PRIOR) / (counts.sum() + PRIOR)
        odds = np.log(share / (1 - share)) + good @ np.log(accuracy[:, 0] / (1 - accuracy[:, 1]))
        odds += bad @ np.log((1 - accuracy[:, 0]) / accuracy[:, 1])
        post = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
    return post, accuracy


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: key, the base measures, base_failed, kept, posterior and votes."""
    rows = docs.select(F.col(key).cast("long").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    measured = cut(
        mapped(
            rows,
            _measured,
            "_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, votes int",
        ),
        "measured",
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PCT * F.col("n_words"))
    patterns = measured.groupBy("votes").agg(F.count(F.when(~failed, 1)).alias("n")).collect()  # at most 3 ** rules rows
    codes = np.array([r["votes"] for r in patterns], np.int64)
    post, _ = estimate(codes, np.array([r["n"] for r in patterns], float)) if len(codes) else (codes, None)
    posterior = measured.sparkSession.createDataFrame(
        [(int(c), float(p)) for c, p in zip(codes, post, strict=True)], "votes int, posterior double"
    )
    return measured.join(F.broadcast(posterior), "votes").select(
        F.col("_id").alias(key),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("posterior") >= 0.5)).alias("kept"),
        "posterior",
        "votes",
    )
