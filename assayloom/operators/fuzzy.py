"""Fuzzy names: a weighted similarity of texts, leader clustering within blocks, and the nearest word of a vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.operators.order import number
from assayloom.session import cut

#: Score from which two names are one; distinct names a block may hold before it is cut by a second word.
SAME, CROWD = 92.0, 5_000
#: Least distinct names in a block of the exact comparison, which compares all pairs of blocks, and most blocks.
BLOCK, BLOCKS = 500, 150


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    s = (1 << len(a)) - 1
    full = s
    for c in b:
        u = s & masks.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


def ratio(a: str, b: str) -> float:
    """Share of characters two texts have in common in order, 0 to 100."""
    return 200.0 * _lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def _tokens(a: str, b: str) -> float:
    """The best of sorted-token and token-set similarity."""
    x, y = sorted(a.split()), sorted(b.split())
    both = sorted(set(x) & set(y))
    only_x, only_y = " ".join(sorted(set(x) - set(y))), " ".join(sorted(set(y) - set(x)))
    common = " ".join(both)
    joined = lambda rest: f"{common} {rest}".strip()
    best = max(ratio(" ".join(x), " ".join(y)), ratio(joined(only_x), joined(only_y)))
    if common:
        best = 100.0 if not only_x or not only_y else max(best, ratio(common, joined(only_x)), ratio(common, joined(only_y)))
    return best


def _partial(a: str, b: str) -> float:
    """The best similarity of the shorter text to a stretch of the longer of its length."""
    if len(a) > len(b):
        a, b = b, a
    return max((ratio(a, b[i : i + len(a)]) for i in range(len(b) - len(a) + 1)), default=0.0) if a else 0.0


def weighted_ratio(a: str, b: str) -> float:
    """0 to 100: whole texts, token orders (0.95), and for very unequal lengths stretches (0.9, beyond eightfold 0.6)."""
    if not a or not b:
        return 0.0
    longer = max(len(a), len(b)) / min(len(a), len(b))
    if longer < 1.5:
        return max(ratio(a, b), 0.95 * _tokens(a, b))
    scale = 0.9 if longer < 8 else 0.6
    return max(ratio(a, b), scale * _partial(a, b), scale * 0.95 * _partial(" ".join(sorted(a.split())), " ".join(sorted(b.split()))))


def leaders(names: list[str], same: float = SAME) -> list[int]:
    """Index of the leader of each name: the first earlier leader that is similar enough, else itself. The order matters."""
    heads: list[int] = []
    out = []
    for i, n in enumerate(names):
        hit = next((h for h in heads if weighted_ratio(n, names[h]) >= same), None)
        if hit is None:
            heads.append(i)
            hit = i
        out.append(hit)
    return out


def _block(name: Column, place: int) -> Column:
    words = F.array_sort(F.array_distinct(F.regexp_extract_all(name, F.lit(r"([a-z]{3,})"), F.lit(1))), lambda x, y: F.when(F.length(x) != F.length(y), F.length(y) - F.length(x)).when(x < y, -1).when(x > y, 1).otherwise(0))
    return F.coalesce(F.get(words, F.lit(place)), F.lit(""))


def _letters(names: list[str]) -> np.ndarray:
    """Characters of each name by class; classes hold several characters, so what two names share is never counted too low."""
    out = np.zeros((len(names), 96), dtype=np.int16)
    for i, n in enumerate(names):
        for c in n:
            out[i, 32 if c.isspace() else ord(c) % 96] += 1
    return out


class Shapes:
    """Bounds of `weighted_ratio`: what names share of characters, whole and as sets of words."""

    def __init__(self, names: list[str]):
        words = [n.split() for n in names]
        sets = [" ".join(sorted(set(w))) for w in words]
        self.whole, self.distinct = _letters(names), _letters(sets)
        self.n = np.array([len(n) for n in names])
        self.sorted = np.array([len(" ".join(w)) for w in words])
        self.set = np.array([len(s) for s in sets])

    def may(self, other: Shapes, i: int, same: float) -> np.ndarray:
        """Indices of `other` that may reach `same`, at least 91, with name `i`: none that does is missing.

        Names of lengths 1.5 apart reach 90 at most. Others reach it as they are, with sorted words, or as sets of words of which one
        is nearly contained in the other.
        """
        share, words = same / 200, same / 0.95 / 200
        n = other.n
        near = np.flatnonzero((np.maximum(n, self.n[i]) < 1.5 * np.minimum(n, self.n[i])))
        if not len(near):
            return near
        whole = np.minimum(other.whole[near], self.whole[i]).sum(1) + 1e-6
        held = np.minimum(other.distinct[near], self.distinct[i]).sum(1) + 1e-6
        alike = whole >= np.minimum(share * (n[near] + self.n[i]), words * (other.sorted[near] + self.sorted[i]))
        # a ratio r of the common words to a whole set of n characters leaves them at least n * r / (200 - r)
        least = words / (1 - words) * np.minimum(other.set[near], self.set[i])
        return near[alike | (held >= least)]


def similar(names: DataFrame, same: float = SAME, block: int | None = None) -> DataFrame:
    """(a, b), a before b: all pairs of (first, n) that are similar enough; every pair of blocks is one task's work."""
    blocks = min(BLOCKS, max(1, -(-names.count() // (block or BLOCK))))
    placed = names.withColumn("own", F.pmod(F.xxhash64("n"), F.lit(blocks)).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("first", "n", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))

    def compare(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        low, high = key
        left, right = (df[df["own"] == k] for k in (low, high))
        a, b, x, y = left["first"].tolist(), right["first"].tolist(), left["n"].tolist(), right["n"].tolist()
        p, q = Shapes(x), Shapes(y)
        out = [(min(a[i], b[j]), max(a[i], b[j])) for i in range(len(x)) for j in p.may(q, i, same) if (low != high or a[i] < b[j]) and weighted_ratio(x[i], y[j]) >= same]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    spread = met.repartition(max(1, min(blocks * (blocks + 1) // 2, 500)), "low", "high")
    return spread.groupBy("low", "high").applyInPandas(compare, "a long, b long")


def cluster_names(records: DataFrame, key: str, name: str, exact: bool = False) -> DataFrame:
    """(`name`, leader): the cluster leader of every distinct name, names taken in order of first appearance.

    Leader clustering is sequential. Blocked, names meet only if they share their longest word (and the second longest in
    crowded blocks), so pairs that differ in that word are missed. `exact` finds all similar pairs, in parallel and without loss,
    and then goes through names that have any in order; what is sequential holds no texts and compares none.
    """
    lower = records.filter(F.col(name).isNotNull()).groupBy(F.lower(name).alias("n")).agg(F.min(key).alias("first"))
    schema = T.StructType().add(name, T.StringType()).add("leader", T.StringType())
    if exact:
        # `first` need not be unique; places are, and keep the order
        order = cut(number(lower.withColumn("at", F.struct("first", "n")), "at", "place").select("n", F.col("place").cast("long").alias("place")))
        pairs = similar(order.select(F.col("place").alias("first"), "n"))

        def lead(df: pd.DataFrame) -> pd.DataFrame:
            of: dict[int, int] = {}
            df = df.sort_values(["b", "a"])
            for a, b in zip(df["a"], df["b"]):
                if b not in of and a not in of:
                    of[b] = a  # the first earlier leader
            return pd.DataFrame({"place": list(of), "head": list(of.values())}, dtype="int64")

        led = pairs.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(lead, "place long, head long")
        heads = order.select(F.col("place").alias("head"), F.col("n").alias("leader"))
        return order.join(led, "place", "left").withColumn("head", F.coalesce("head", "place")).join(heads, "head").select(F.col("n").alias(name), "leader")
    placed = lower.withColumn("b1", _block(F.col("n"), 0))
    sizes = placed.groupBy("b1").agg(F.count("*").alias("size"))
    placed = placed.join(sizes, "b1").withColumn("block", F.when(F.col("size") > CROWD, F.concat_ws("|", "b1", _block(F.col("n"), 1))).otherwise(F.col("b1"))).drop("b1", "size")

    def run(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("first", ignore_index=True)
        names = list(df["n"])
        return pd.DataFrame({name: names, "leader": [names[i] for i in leaders(names)]})

    return placed.groupBy("block").applyInPandas(run, schema)


def nearest_word(column: Column, vocabulary: list[str], least: float = 88.0) -> Column:
    """The most similar word of a short vocabulary, null below `least`; ties go to the first."""

    def pick(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        seen: dict[str, str | None] = {}

        def best(t):
            if t is None:
                return None
            if t not in seen:
                scored = [(-weighted_ratio(t.lower().strip(), v), i) for i, v in enumerate(vocabulary)]
                s, i = min(scored, default=(0.0, 0))
                seen[t] = vocabulary[i] if -s >= least else None
            return seen[t]

        for texts in parts:
            yield pd.Series([best(t) for t in texts], dtype=object)

    return F.pandas_udf(pick, T.StringType())(column)
