"""Documents drawn from several sources so that each source holds its target share of all tokens.

Token weights of (source, language, topic) cells are raked to the marginals of source, language and topic by iterative
proportional fitting, with every weight at most the source's number of repeats. Languages and topics are to keep the shares they
have in all documents, or get given ones, so that drawing more from a source does not shift them. A document is then drawn as often as its cell's
weight says: the whole part always, the rest with calibrated probability, by systematic sampling within blocks of a source.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.llm.subjects import assign_subjects
from assayloom.llm.tokens import RANKS, token_count
from assayloom.session import cut

#: Documents that one task samples at a time.
BLOCK = 50_000
#: Rows of weights that every task may hold; beyond, they are joined by a shuffle.
KNOWN_CELLS = 100_000
#: Share of the largest possible size that is drawn; less leaves the other margins more choice.
ROOM = 1.0
_DRAW = T.StructType().add("mix_id", T.IntegerType()).add("source", T.StringType()).add("doc_id", T.LongType()).add("tokens", T.LongType()).add("copies", T.LongType())


def rake(tokens: np.ndarray, margins: list[tuple[np.ndarray, np.ndarray]], cap: np.ndarray, source: np.ndarray, share: np.ndarray, rounds: int = 200, room: float = 1.0) -> tuple[np.ndarray, float]:
    """(weight of each cell, total size): source shares exact, other margins as near as caps allow.

    `margins` are (group of each cell, target share of each group) in the order they are fitted; `source` and `share` are fitted
    last in every round. The size is `room` times the largest at which no source needs more than its cap; at 1 the scarcest source
    is used up and its cells have no choice.
    """
    held = np.bincount(source, weights=tokens, minlength=len(share))
    most = np.bincount(source, weights=tokens * cap, minlength=len(share))
    wanted = (share > 0) & (held > 0)
    if not wanted.any():
        return np.zeros(len(tokens)), 0.0
    share = np.where(wanted, share, 0) / share[wanted].sum()
    size = room * float((most[wanted] / share[wanted]).min())
    target = share * size
    w = np.where(share[source] > 0, 1.0, 0.0)

    def to_sources(w: np.ndarray) -> np.ndarray:
        for _ in range(50):  # what a capped cell cannot take goes to the others of its source
            now = np.bincount(source, weights=w * tokens, minlength=len(share))
            w = np.minimum(w * (target / np.maximum(now, 1e-9))[source], cap)
            if np.abs(np.bincount(source, weights=w * tokens, minlength=len(share)) - target).max() < 1e-9 * size:
                break
        return w

    w = to_sources(w)
    for _ in range(rounds):
        before = w
        for group, goal in margins:
            now = np.bincount(group, weights=w * tokens, minlength=len(goal))
            factor = np.where(now > 0, goal * now.sum() / np.maximum(now, 1e-9), 1.0)
            w = np.minimum(w * factor[group], cap)
        w = to_sources(np.maximum(w, 1e-6 * (share[source] > 0)))
        if np.abs(w - before).max() < 1e-6:
            break
    return w, size


def _draw(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
    """Systematic sampling: cumulated wanted tokens decide how often a document is taken, so errors never add up."""
    df = df.sort_values(["order", "doc_id"], ignore_index=True)
    w, t = df["weight"].to_numpy(float), df["tokens"].to_numpy(float)
    whole = np.floor(w + 1e-9)
    rest = np.maximum(w - whole, 0) * t
    debt, extra = 0.0, np.zeros(len(df), dtype=np.int64)
    for i in range(len(df)):
        debt += rest[i]
        if rest[i] > 0 and debt * 2 >= t[i]:
            extra[i] = 1
            debt -= t[i]
    df["copies"] = whole.astype(np.int64) + extra
    df = df[df["copies"] > 0]
    return pd.DataFrame({"mix_id": df["mix_id"].astype("int32"), "source": df["source"], "doc_id": df["doc_id"], "tokens": df["tokens"], "copies": df["copies"]})


def mix_sources(documents: DataFrame, targets: DataFrame, topics: DataFrame | None = None, text: str = "text", tokenizer: str = RANKS, block: int = BLOCK, langs: dict[str, float] | None = None, subjects: dict[int, float] | None = None, room: float = ROOM) -> DataFrame:
    """(mix_id, source, doc_id, tokens, copies): the documents drawn for each mix, copies at least 1 and at most max_repeats.

    The size of a mix is `room` of the largest that its sources can supply without passing max_repeats. `langs` and `subjects` give
    target shares of languages and topics (scaled to 1, what is not named gets none); without them both keep the shares they have
    in all documents of the targets' sources. Source shares are met exactly, the others as near as sources and repeats allow.
    Documents without a language or topic form a group of their own ("" and 0), a document of several topics counts under the first.
    Documents without tokens or of no source are never drawn; a source of a mix without documents leaves its share to the others.
    Sources are sampled in blocks of bounded size, so no task holds a source.
    """
    goals = [r.asDict() for r in targets.select("mix_id", "source", "target_share", "max_repeats").collect()]
    docs = documents.select("doc_id", "source", F.coalesce("lang", F.lit("")).alias("lang"), F.col(text).alias("text")).filter(F.col("source").isin(sorted({g["source"] for g in goals if g["source"] is not None})))
    sized = docs.select("doc_id", "source", "lang", token_count(F.col("text"), tokenizer).alias("tokens")).filter("tokens > 0")
    if topics is not None:
        main = topics.groupBy("doc_id").agg(F.min("subject_id").cast("int").alias("topic"))
        sized = sized.join(main, "doc_id", "left").withColumn("topic", F.coalesce("topic", F.lit(0)))
    else:
        sized = sized.withColumn("topic", F.lit(0))
    sized = cut(sized)
    # as many rows as sources of the targets x languages x topics, whatever the number of documents
    cells = sized.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")).toPandas()
    rows, counts = [], {}
    for mix in sorted({g["mix_id"] for g in goals}):
        mine = {g["source"]: g for g in goals if g["mix_id"] == mix}
        c = cells[cells["source"].isin(list(mine))].reset_index(drop=True)
        if not len(c):
            continue
        names = sorted(mine)
        source = c["source"].map(names.index).to_numpy()
        share = np.array([float(mine[s]["target_share"] or 0) for s in names])
        cap = np.array([float(mine[s]["max_repeats"] or 0) for s in names])[source]
        tokens = c["tokens"].to_numpy(float)
        margins = []
        for column, given in (("lang", langs), ("topic", subjects)):
            group, values = pd.factorize(c[column])
            whole = cells.groupby(column)["tokens"].sum()
            goal = np.array([float((given or {}).get(v, 0)) if given is not None else float(whole[v]) for v in values])
            if goal.sum() > 0:
                margins.append((group, goal / goal.sum()))
        w, _ = rake(tokens, margins, cap, source, share, room=room)
        rows += [(int(mix), s, g, int(t), float(x)) for s, g, t, x in zip(c["source"], c["lang"], c["topic"], w) if x > 0]
        for s, n in c.groupby("source")["n"].sum().items():
            counts[s] = int(n)
    spark = documents.sparkSession
    weights = spark.createDataFrame(rows, "mix_id int, source string, lang string, topic int, weight double")
    blocks = spark.createDataFrame([(s, -(-n // block)) for s, n in counts.items()] or [("", 1)], "source string, blocks long")
    # one row per cell or source of the targets: sent to every task only while there are few
    few = lambda df, n: F.broadcast(df) if n <= KNOWN_CELLS else df
    drawn = sized.join(few(weights, len(rows)), ["source", "lang", "topic"]).join(few(blocks, len(counts)), "source")
    drawn = drawn.withColumn("order", F.xxhash64("doc_id", "mix_id")).withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    return drawn.groupBy("mix_id", "source", "block").applyInPandas(_draw, _DRAW)


def shares(drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """Per mix and source: target and reached share of tokens, documents, draws, tokens, most copies of a document."""
    got = drawn.groupBy("mix_id", "source").agg(F.count("*").alias("n_docs"), F.sum("copies").alias("n_draws"), F.sum(F.col("copies") * F.col("tokens")).alias("tokens"), F.max("copies").alias("most_copies"))
    every = got.groupBy("mix_id").agg(F.sum("tokens").alias("all_tokens"))
    out = targets.join(got, ["mix_id", "source"], "left").join(every, "mix_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return out.select("mix_id", "source", "target_share", "max_repeats", zero("n_docs"), zero("n_draws"), zero("tokens"), zero("most_copies"), F.round(F.coalesce(F.col("tokens") / F.col("all_tokens"), F.lit(0.0)), 6).alias("reached_share"))


def mixed(documents: DataFrame, targets: DataFrame, labels: DataFrame, subjects: DataFrame) -> DataFrame:
    """The draws of every mix, raked to source, language and subject."""
    return mix_sources(documents, targets, assign_subjects(documents, labels, subjects))


def report(documents: DataFrame, targets: DataFrame, labels: DataFrame, subjects: DataFrame) -> DataFrame:
    return shares(mixed(documents, targets, labels, subjects), targets)
