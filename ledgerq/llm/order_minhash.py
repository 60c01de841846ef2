"""Near-duplicate texts by Order MinHash.

A text is the sequence of its overlapping five-word shingles (words between white space, A-Z lower-cased;
a text of one to four words is one shingle). Equal shingles are told apart by their occurrence number. Each
of ``ENTRIES`` hash functions samples the ``KEPT`` smallest labelled shingles and keeps them in text order,
so that an entry is sensitive to order as well as to content. Texts that share an entry are candidates.

Two texts are linked when, of all labelled shingles of both, at least ``SIMILARITY`` are matched in order:
``m / (n1 + n2 - m)``, where m is the length of the best in-order alignment. It is found by a banded alignment over
the places of equal shingles that lie on the diagonals the threshold allows, and is exact. Entries agree with probability of about
0.8 ** 3 at the threshold, so a pair just above it is missed in all 14 with probability 5e-5 (8e-4 for 4 against 5 shingles).
Texts of at most ``FEW`` shingles also meet by exact keys, the hashes of their sequence and of it without each one shingle, so
that none of their pairs is missed.

Copies of one text are one node. In each bucket the members are aligned with its most connected one; those out of the
pivot's reach are compared among themselves, in blocks of bounded size, and those in between also with the
members the pivot has (by the triangle inequality of the alignment distance no other pair can be linked).
So a group of n near copies costs about n alignments per entry, not n squared, and no bucket is cut off.

Null texts count as empty; texts without a word are equal to each other only and form one group.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerq.llm.common import WordHashes, cut, mapped, mix64
from ledgerq.llm.graph import components

SHINGLE, KEPT, ENTRIES, SIMILARITY = 5, 3, 14, 0.8
#: Rows and shingles of one side of a comparison block, about.
BLOCK, BLOCK_SHINGLES = 1024, 1_000_000
#: Texts of at most this many shingles also share a key if they are equal but for one shingle. Two of them that
#: reach 0.8 differ in no more.
FEW = 8
#: A long text's shingles are hashed for this many shingle positions at a time.
SPAN = 1 << 18

#: For rolling and mixing.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mix64(np.arange(1, ENTRIES + 1, dtype=np.uint64) * _BASE)
_hashes = WordHashes()


def shingles(text: str | None) -> np.ndarray:
    """The 64-bit hashes of a text's shingles, in text order."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = mix64(_hashes.of(words))
    if len(h) < SHINGLE:
        h = np.concatenate([h, np.full(SHINGLE - len(h), len(h), np.uint64)])
    out = h[: len(h) - SHINGLE + 1].copy()
    for i in range(1, SHINGLE):
        out = out * _BASE + h[i : len(h) - SHINGLE + 1 + i]
    return mix64(out)


def labelled(s: np.ndarray) -> np.ndarray:
    """Shingle hashes in which the second, third, ... occurrence of a shingle differs from the first."""
    order = np.argsort(s, kind="stable")
    ranked = s[order]
    same = np.concatenate([[False], ranked[1:] == ranked[:-1]])
    if not same.any():
        return s
    index = np.arange(len(s))
    first = np.maximum.accumulate(np.where(same, 0, index))
    out = np.empty_like(s)
    out[order] = mix64(ranked + (index - first).astype(np.uint64) * _BASE)
    return np.where(np.isin(index, order[~same]), s, out)


def sequence_keys(x: np.ndarray) -> np.ndarray:
    """Hashes of a few labelled shingles in their order, and of what is left without each of them."""
    n = len(x)
    less = np.array([[c for c in range(n) if c != r] for r in range(n)], np.intp).reshape(n, n - 1)
    found = []
    for rows in (x[None, :], x[less])[: 1 + (n > 1)]:
        keys = np.full(len(rows), rows.shape[1], np.uint64)
        for column in rows.T:
            keys = mix64(keys * _BASE + column)
        found.append(keys)
    return np.concatenate(found)


def sketch(s: np.ndarray) -> np.ndarray:
    """One entry per hash function, then the exact keys of a text of few shingles; empty for no shingles."""
    if not len(s):
        return np.empty(0, np.int64)
    x = labelled(s)
    k = min(KEPT, len(x))
    picks = []
    for seed in _SEEDS:
        low: np.ndarray | None = None
        for at in range(0, len(x), SPAN):
            v = mix64(x[at : at + SPAN] ^ seed)
            part = np.argpartition(v, k - 1)[:k] if len(v) > k else np.arange(len(v))
            if low is None:
                low, values = part + at, v[part]
            else:
                low, values = np.concatenate([low, part + at]), np.concatenate([values, v[part]])
                keep = np.argsort(values)[:k]
                low, values = low[keep], values[keep]
        picks.append(np.sort(low))
    chosen = x[np.array(picks)]
    out = _SEEDS.copy()
    for i in range(k):
        out = mix64(out * _BASE + chosen[:, i])
    if len(x) <= FEW:
        out = np.concatenate([out, sequence_keys(x)])
    return out.view(np.int64)


class Shingled:
    """A text's labelled shingles in text order, and sorted with their places."""

    __slots__ = ("n", "order", "ranked")

    @classmethod
    def of(cls, labels: np.ndarray) -> Shingled:
        self = cls()
        self.n = len(labels)
        self.order = np.argsort(labels)
        self.ranked = labels[self.order]
        return self


def compare(a: Shingled, b: Shingled) -> tuple[bool, bool]:
    """(linked, near): near if a text that the first one links may still link the second.

    The alignment is sparse: only places of equal labelled shingles inside the band count, and the longest chain of them that
    rises in both texts is the best alignment.
    """
    n, m = a.n, b.n
    at = np.searchsorted(b.ranked, a.ranked)
    at[at == m] = 0
    same = b.ranked[at] == a.ranked if m else np.zeros(n, bool)
    common = int(same.sum())
    near = n + m - 2 * common <= (m + 3.5 * n) / 9
    need = int(np.ceil(round(SIMILARITY / (1 + SIMILARITY) * (n + m), 9)))
    if common < need or not common:
        return False, near
    left, right = a.order[same], b.order[at[same]]
    by_place = np.argsort(left)
    left, right = left[by_place], right[by_place]
    # An alignment that leaves at most n + m - 2 * need shingles unmatched strays no further than that from the diagonal.
    right = right[np.abs(left - right) <= n + m - 2 * need]
    return rising(right) >= need, near


def rising(x: np.ndarray) -> int:
    """Length of the longest rising subsequence."""
    if len(x) < 2 or (x[1:] > x[:-1]).all():
        return len(x)
    ends: list[int] = []
    for v in x.tolist():
        if not ends or v > ends[-1]:
            ends.append(v)
        else:
            ends[bisect_left(ends, v)] = v
    return len(ends)


def _sketches(batches):
    for batch in batches:
        out = [shingles(t) for t in batch["_text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch["_id"],
                batch["_node"],
                pa.array([len(s) for s in out], pa.int64()),
                pa.array([sketch(s) for s in out], pa.list_(pa.int64())),
            ],
            ["_id", "_node", "_n", "_s"],
        )


def _verify(batches):
    kept: dict[bytes, Shingled] = {}
    held = 0

    def known(node: bytes, text: str) -> Shingled:
        nonlocal held
        found = kept.get(node)
        if found is None:
            if held > 1_000_000:  # shingles, 16 bytes each
                kept.clear()
                held = 0
            found = kept[node] = Shingled.of(labelled(shingles(text)))
            held += found.n
        return found

    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("a", "b", "_ta", "_tb"))
        rows = [compare(known(a, ta), known(b, tb)) for a, b, ta, tb in zip(*columns, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch["a"], batch["b"], pa.array([r[0] for r in rows], pa.bool_()), pa.array([r[1] for r in rows], pa.bool_())],
            ["a", "b", "linked", "near"],
        )


def _digests(batches):
    for batch in batches:
        found = [labelled(shingles(t)).view(np.int64) for t in batch["_text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["_node"], pa.array(found, pa.list_(pa.int64()))], ["_node", "_x"])


def _strays(key, group):
    """Links of a comparison block between texts of which at least one is a stray, as few as connect the same texts.

    A pair is looked at only in the bucket where it first agrees: a bucket in which it isn't to be compared proves
    that it needn't be. The shingles a text shares with each other one are counted in one step; only pairs that share
    as many as a link takes are aligned.
    """
    entry, _, i, j = (k.as_py() for k in key)
    group = group.combine_chunks()
    part = np.array(group["_part"])
    kind = np.array(group["_kind"])  # 0: the pivot's, 1: out of reach, 2: in between
    s = np.stack([x[:ENTRIES] for x in group["_s"].to_numpy(zero_copy_only=False)])
    arrays = group["_x"].combine_chunks()
    size = np.diff(arrays.offsets.to_numpy())
    starts = np.concatenate([[0], np.cumsum(size)])
    labels = arrays.flatten().to_numpy().view(np.uint64)
    distinct, code = np.unique(labels, return_inverse=True)
    mine = np.zeros(len(distinct), np.int32)
    made: dict[int, Shingled] = {}
    root = np.arange(len(part))
    left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
    a, b = [], []
    for x in left:
        others = right[right > x] if i == j else right
        others = others[(kind[others] > 0) & (kind[x] > 0) | (kind[others] + kind[x] == 2)]
        others = others[(root[others] != root[x]) & (np.minimum(size[others], size[x]) >= SIMILARITY * np.maximum(size[others], size[x]) - 1e-9)]
        if not len(others):
            continue
        agree = s[others] == s[x]
        others = others[np.where(agree.any(axis=1), agree.argmax(axis=1), ENTRIES) == entry]
        if not len(others):
            continue
        mine[code[starts[x] : starts[x + 1]]] = 1
        places = np.concatenate([code[starts[y] : starts[y + 1]] for y in others])
        shared = np.add.reduceat(mine[places], np.concatenate([[0], np.cumsum(size[others])[:-1]]))
        mine[code[starts[x] : starts[x + 1]]] = 0
        for y in others[shared >= SIMILARITY / (1 + SIMILARITY) * (size[others] + size[x]) - 1e-6]:
            if root[x] == root[y]:
                continue
            for v in (x, y):
                if v not in made:
                    made[v] = Shingled.of(labels[starts[v] : starts[v + 1]])
            if compare(made[x], made[y])[0]:
                a.append(x)
                b.append(y)
                root[root == root[y]] = root[x]
    nodes = group["_node"]
    return pa.table({"a": nodes.take(pa.array(a, pa.int64())), "b": nodes.take(pa.array(b, pa.int64()))})


def _aligned(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    return mapped(
        pairs.join(texts.select(F.col("_node").alias("a"), F.col("_text").alias("_ta")), "a").join(
            texts.select(F.col("_node").alias("b"), F.col("_text").alias("_tb")), "b"
        ),
        _verify,
        "a binary, b binary, linked boolean, near boolean",
    )


def _node(text: Column) -> Column:
    """The digest of a text; that of the empty text if it has no word."""
    return F.unhex(F.md5(F.when(text.rlike(r"[^ \t\n\x0B\f\r]"), text).otherwise("")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(nodes, groups) of a table of texts.

    nodes: ``_id, _node`` for each row, in no order: its key and the digest of its text. groups: ``_node, _root``
    for each text that is linked with another one; texts that aren't listed are alone with their copies.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("_id"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
        _node(F.col(text)).alias("_node"),
    )
    sketched = cut(mapped(rows, _sketches, "_id long, _node binary, _n long, _s array<long>"), "sketches")
    texts = cut(
        sketched.groupBy("_node").agg(F.min("_id").alias("_id"), F.first("_n").alias("_n"), F.first("_s").alias("_s")),
        "texts",
    )
    entries = texts.select("_node", F.posexplode("_s").alias("_j", "_e")).withColumn("_j", F.least("_j", F.lit(ENTRIES)))
    sizes = entries.groupBy("_j", "_e").agg(F.count(F.lit(1)).alias("_size")).where("_size > 1")
    members = cut(entries.join(sizes, ["_j", "_e"]), "members")
    # The pivot of a bucket is the text with the most company in all its buckets: what copies were made from has more
    # entries in common with each of them than they have with each other.
    company = members.groupBy("_node").agg(F.sum("_size").alias("_company"))
    pivots = (
        members.join(company, "_node")
        .groupBy("_j", "_e")
        .agg(F.max(F.struct("_company", "_node")).alias("_p"))
        .select("_j", "_e", F.col("_p._node").alias("_pivot"))
    )
    members = cut(members.join(pivots, ["_j", "_e"]), "pivots")
    stars = members.where("_node != _pivot").select(F.col("_pivot").alias("a"), F.col("_node").alias("b")).distinct()
    touched = members.select("_node").distinct()
    whole = cut(
        rows.join(texts.join(touched, "_node", "left_semi").select("_node", F.col("_id").alias("_first")), "_node")
        .where(F.col("_id").eqNullSafe(F.col("_first")))
        .select("_node", "_text")
        .dropDuplicates(["_node"]),
        "whole",
    )
    checked = cut(_aligned(stars, whole), "aligned")
    links = checked.where("linked").select("a", "b")

    stray = (
        members.where("_size > 2")
        .join(
            checked.select(
                F.col("a").alias("_pivot"),
                F.col("b").alias("_node"),
                F.when(F.col("linked"), 0).when(F.col("near"), 2).otherwise(1).alias("_kind"),
            ),
            ["_pivot", "_node"],
        )
        .select("_j", "_e", "_node", "_kind")
    )
    counts = stray.groupBy("_j", "_e").agg(
        F.count(F.when(F.col("_kind") > 0, 1)).alias("_strays"),
        F.count(F.when(F.col("_kind") == 2, 1)).alias("_between"),
        F.count(F.lit(1)).alias("_all"),
    )
    open_ = counts.where("_strays > 1 or (_between > 0 and _all > 1)").select("_j", "_e", "_between")
    placed = cut(
        stray.join(open_, ["_j", "_e"]).where("_kind > 0 or _between > 0").join(texts.select("_node", "_n"), "_node"), "placed"
    )
    blocks = placed.groupBy("_j", "_e").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("_n") / BLOCK_SHINGLES)).cast("int").alias("_blocks")
    )
    digests = mapped(
        whole.join(placed.select("_node").distinct(), "_node", "left_semi").select("_node", "_text"),
        _digests,
        "_node binary, _x array<long>",
    ).join(texts.select("_node", "_s"), "_node")
    more = (
        placed.join(blocks, ["_j", "_e"])
        .withColumn("_part", F.pmod(F.xxhash64("_node", "_j"), F.col("_blocks")).cast("int"))
        .select("_j", "_e", "_node", "_kind", "_part", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other"))
        .select("_j", "_e", "_node", "_kind", "_part", F.least("_part", "_other").alias("_u"), F.greatest("_part", "_other").alias("_v"))
        .join(digests, "_node")
        .groupBy("_j", "_e", "_u", "_v")
        .applyInArrow(_strays, "a binary, b binary")
    )
    links = links.unionByName(cut(more, "strays"))
    groups = components(links).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return sketched.select("_id", "_node"), groups


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: its key, ``class_id`` (the smallest key of its group) and ``kept`` (key = class_id).

    Rows with a null key get the smallest key of their group, if there is one, and are kept only without one.
    """
    nodes, groups = near_duplicates(docs, key, text)
    named = nodes.groupBy("_node").agg(F.min("_id").alias("_first")).join(groups, "_node", "left")
    named = cut(named.select("_node", "_first", F.coalesce("_root", "_node").alias("_root")), "named")
    least = named.groupBy("_root").agg(F.min("_first").alias("class_id"))
    by_node = named.join(least, "_root").select("_node", "class_id")
    return nodes.join(by_node, "_node").select(
        F.col("_id").alias(key), "class_id", F.col("_id").eqNullSafe(F.col("class_id")).alias("kept")
    )


def distinct_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of the table without near duplicates: of each group the row with the smallest key stays whole.

    Of rows equal in key and text one stays.
    """
    number = "_row_number_"
    while number.lower() in (c.lower() for c in docs.columns):
        number += "_"
    numbered = cut(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    _, groups = near_duplicates(numbered.select(key, text), key, text)
    named = (
        numbered.select(
            _node(F.col(text)).alias("_node"), F.col(key).cast("long").alias("_id"), F.col(number).alias("_number")
        )
        .join(groups, "_node", "left")
        .select(F.coalesce("_root", "_node").alias("_root"), F.struct(F.col("_id").isNull().alias("n"), "_id", "_number").alias("_k"))
    )
    stay = named.groupBy("_root").agg(F.min("_k").alias("_k")).select(F.col("_k._number").alias(number))
    return numbered.join(stay, number, "left_semi").select(*docs.columns)
