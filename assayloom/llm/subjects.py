"""Subject areas of documents: a sentence model over hashed terms, and classifier chains over term, source and structure features.

1. Term counts by subject come from labelled documents (at most `max_labelled`, all of them up to there).
2. One pass over all documents recounts terms with each sentence shared out by its own evidence and its document's other
   sentences, and counts for every recurring sentence how often the rest of its document agrees with it. Sentences that recur
   in documents of any subject are notices and asides.
3. A classifier chain (one logistic model per subject, seeing the labels decided before it) is fitted to the labelled documents.
4. Every document is decoded by beam search over label combinations. That a quarter of the subject-bearing sentences are about a
   subject is a feature; the chain may strike out a subject beyond it and add one that falls short of it by little.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.session import cut

#: Hashed term space: the model is this many rows, whatever the corpus.
BITS = 18
#: Smoothing of term counts, least concentration of a telling term, least evidence and lead of a sentence's subject.
SMOOTH, TELLING, EVIDENCE, LEAD = 5.0, 0.45, 1.0, 1.0
#: A sentence that recurs this often, with less than this agreement, is an aside.
RECURS, AGREES = 8, 0.3
#: Asides that may be known to every task; beyond, documents are told theirs by a join.
ASIDES = 200_000
#: A subject is decided from `SHARE` of the sentences on; the chain may add one from `NEAR` on, where features and other subjects speak for it.
SHARE, NEAR = 0.25, 0.2
#: Terms (words and pairs of words) up to which a sentence counts as a heading.
HEADING = 9

#: A word's term is its stem of so many letters; a longer word is a term as a whole, too.
STEM = 12
_HYPHEN = re.compile(r"(\w)-[ \t]*\n[ \t]*(\w)")
_WRAP = re.compile(r"(?<!\n)\n(?!\s*\n)")
_SENTENCE = re.compile(r"(?<=[.!?])(?<!\(no\.)\s+(?=\S)|\n\s*\n")
_WORD = re.compile(r"[^\W\d_]{3,}")
_NUMBER = re.compile(r"\d+(?:[.,]\d+)?")
_MASK = np.uint32((1 << BITS) - 1)


def sentences(text: str) -> list[str]:
    """Sentences of a text; words broken over lines are joined, blank lines end a sentence."""
    text = _WRAP.sub(" ", _HYPHEN.sub(r"\1\2", text))
    return [s for s in _SENTENCE.split(text) if len(s) > 8]


class Reader:
    """Turns texts into sentence-term arrays; remembers word hashes."""

    def __init__(self):
        self.words: dict[str, int] = {}

    def word(self, w: str) -> int:
        h = self.words.get(w)
        if h is None:
            if len(self.words) > 1 << 18:
                self.words.clear()
            h = self.words[w] = xxhash.xxh32_intdigest(w.lower()[:STEM])
        return h

    def read(self, texts: list[str], keys: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(term buckets of stems, of pairs of stems and of long words, sentence of each term, document of each sentence, key of each sentence)."""
        word, ids, sent_len, doc_of, sent_keys = self.word, [], [], [], []
        whole, whole_of = [], []
        for d, text in enumerate(texts):
            for s in sentences(text or ""):
                words = _WORD.findall(s)
                ids.extend(map(word, words))
                for w in words:
                    if len(w) > STEM:
                        whole.append(xxhash.xxh32_intdigest(w.lower()))
                        whole_of.append(len(sent_len))
                sent_len.append(len(words))
                doc_of.append(d)
                if keys:
                    sent_keys.append(xxhash.xxh64_intdigest(_NUMBER.sub("0", s)) - (1 << 63))
        w = np.array(ids, dtype=np.uint32)
        n = np.array(sent_len, dtype=np.int64)
        sent = np.repeat(np.arange(len(n)), n)
        pair = (w[:-1] * np.uint32(0x9E3779B1)) ^ w[1:] if len(w) > 1 else np.zeros(0, np.uint32)
        within = sent[:-1] == sent[1:] if len(w) > 1 else np.zeros(0, bool)
        terms = np.concatenate([w, pair[within], np.array(whole, dtype=np.uint32)]) & _MASK
        return terms.astype(np.int64), np.concatenate([sent, sent[:-1][within] if len(w) > 1 else sent[:0], np.array(whole_of, dtype=np.int64)]), np.array(doc_of, dtype=np.int64), np.array(sent_keys, dtype=np.int64)


def term_model(counts: np.ndarray) -> np.ndarray:
    """Log odds of every subject given a term, zero for terms that tell nothing."""
    prior = counts.sum(0) / max(counts.sum(), 1e-9)
    p = (counts + SMOOTH * prior) / (counts.sum(1, keepdims=True) + SMOOTH)
    with np.errstate(divide="ignore", invalid="ignore"):
        odds = np.clip(np.log(np.maximum(p, 1e-9) / np.maximum(prior, 1e-12)), -4, 4)
    odds[p.max(1) < TELLING] = 0
    return odds.astype(np.float32)


def score(model: np.ndarray, terms: np.ndarray, sent: np.ndarray, n: int) -> np.ndarray:
    """Evidence of each sentence for each subject."""
    z = np.zeros((n, model.shape[1]), dtype=np.float32)
    if len(terms):
        order = np.argsort(sent, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(sent[order]) > 0])
        z[sent[order][starts]] = np.add.reduceat(model[terms[order]], starts, axis=0)
    return z


def decide(z: np.ndarray) -> np.ndarray:
    """Subject index of each sentence, -1 for none."""
    if not len(z):
        return np.zeros(0, dtype=np.int64)
    two = np.partition(z, -2, axis=1)[:, -2:]
    return np.where((two[:, 1] > EVIDENCE) & (two[:, 1] - two[:, 0] > LEAD), z.argmax(1), -1)


def gather(table: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> None:
    """Adds the weights of each term's sentence to the term's row."""
    for j in range(table.shape[1]):
        table[:, j] += np.bincount(terms, weights=weights[:, j], minlength=len(table))


def tally(subject: np.ndarray, doc_of: np.ndarray, docs: int, k: int) -> np.ndarray:
    """Sentences by document and subject."""
    on = subject >= 0
    return np.bincount(doc_of[on] * k + subject[on], minlength=docs * k).reshape(docs, k).astype(np.float32)


# ---- classifier chain --------------------------------------------------------------------------------------------------
def features(counts: np.ndarray, evidence: np.ndarray, source_odds: np.ndarray, structure: np.ndarray) -> np.ndarray:
    """(documents, subjects, features): share, its side of a quarter alone and among others, evidence, length, rank, source, and
    the document's structure (`structure`: sentences, words, headings) beside the side of a quarter."""
    n = counts.sum(1, keepdims=True)
    share = counts / np.maximum(n, 1)
    over = (share >= SHARE).astype(np.float32)
    rank = (counts[:, None, :] > counts[:, :, None]).sum(2)
    return np.stack([np.ones_like(share), over, np.clip((share - SHARE) * 8, -2, 2), np.log1p(counts), over * np.log1p(n), over * over.sum(1, keepdims=True), over * (over.sum(1, keepdims=True) >= 3), np.tanh(evidence / 20), (rank == 0) * 1.0, source_odds, *_structure(structure, n, over)], axis=2).astype(np.float32)


def _structure(structure: np.ndarray, bearing: np.ndarray, over: np.ndarray) -> list[np.ndarray]:
    """Share of sentences that bear a subject, words a sentence, and headings a sentence, each where a subject is over a quarter and where not."""
    total = np.maximum(structure[:, :1], 1)
    told = [bearing / total, np.log1p(structure[:, 1:2] / total) / 4, structure[:, 2:3] / total]
    return [x * side for x in told for side in (over, 1 - over)]


def _fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method with a ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return w


def fit_chain(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """One model per subject in chain order; its inputs are the subject's features and the labels before it."""
    return [_fit_logistic(np.concatenate([x[:, k], y[:, :k]], axis=1).astype(np.float64), y[:, k].astype(np.float64)) for k in range(y.shape[1])]


def beam(chain: list[np.ndarray], x: np.ndarray, allowed: np.ndarray, width: int = 6) -> np.ndarray:
    """The likeliest label combination of each document, by beam search along the chain."""
    docs, k, f = x.shape
    labels = np.zeros((docs, 1, k), dtype=np.float32)
    logp = np.zeros((docs, 1))
    for j, w in enumerate(chain):
        z = (x[:, j] @ w[:f])[:, None] + labels[:, :, :j] @ w[f:]
        on = np.where(allowed[:, j][:, None], -np.logaddexp(0, -z), -np.inf)
        off = -np.logaddexp(0, z)
        with_j = labels.copy()
        with_j[:, :, j] = 1
        labels = np.concatenate([labels, with_j], axis=1)
        logp = np.concatenate([logp + off, logp + on], axis=1)
        if logp.shape[1] > width:
            top = np.argsort(-logp, axis=1, kind="stable")[:, :width]
            logp = np.take_along_axis(logp, top, 1)
            labels = np.take_along_axis(labels, top[:, :, None], 1)
    return labels[np.arange(docs), logp.argmax(1)] > 0.5


# ---- Spark passes ------------------------------------------------------------------------------------------------------
_COUNT = T.StructType().add("kind", T.IntegerType()).add("key", T.LongType()).add("n", T.DoubleType()).add("v", T.ArrayType(T.DoubleType()))


def _summed(df: DataFrame, k: int) -> DataFrame:
    """Sums of (kind, key) over partitions; each partition has combined its own before."""
    out = df.groupBy("kind", "key").agg(F.sum("n").alias("n"), *[F.sum(F.get("v", F.lit(i))).alias(f"v{i}") for i in range(k)])
    return out


def _matrix(rows: list, k: int) -> np.ndarray:
    m = np.zeros((1 << BITS, k))
    for r in rows:
        m[r["key"]] = [r[f"v{i}"] or 0.0 for i in range(k)]
    return m


def _emit(table: dict | np.ndarray, k: int) -> pd.DataFrame:
    at = np.flatnonzero(table.sum(1))
    return pd.DataFrame({"kind": np.zeros(len(at), np.int32), "key": at.astype(np.int64), "n": table[at].sum(1), "v": pd.Series(list(table[at]), dtype=object)})


def _with_asides(docs: DataFrame, recurring: DataFrame) -> DataFrame:
    """Adds the asides that a document holds, null for none: its sentence keys joined to those that recur."""

    def keys(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader()
        for df in parts:
            _, _, doc_of, of = reader.read(list(df["text"]), True)
            yield pd.DataFrame({"of": df["id"].to_numpy()[doc_of], "aside": of}).drop_duplicates()

    said = docs.select("id", "text").mapInPandas(keys, T.StructType([T.StructField("of", docs.schema["id"].dataType), T.StructField("aside", T.LongType())]))
    held = cut(said.join(recurring, "aside", "left_semi").groupBy("of").agg(F.collect_set("aside").alias("asides")))
    return docs.join(held, docs["id"].eqNullSafe(held["of"]), "left").drop("of")


def assign_subjects(documents: DataFrame, labels: DataFrame, subjects: DataFrame, text: str = "text", key: str = "doc_id", max_labelled: int = 20_000, seed: int = 7) -> DataFrame:
    """(`key`, subject_id): the subjects of each document; documents without any have no row.

    `subjects` is the list of subject ids (bounded by its own nature); of several label rows of a document all subjects count.
    Null and empty texts get no row, repeated documents equal rows, texts of any length are read whole. The model is 2^18
    rows however large the corpus, and every pass combines its counts per partition before the shuffle.
    """
    spark = documents.sparkSession
    ids = sorted(r[0] for r in subjects.select("subject_id").distinct().collect())
    at, k = {s: i for i, s in enumerate(ids)}, len(ids)
    docs = documents.select(F.col(key).alias("id"), F.col(text).alias("text"), F.coalesce("source", F.lit("")).alias("source")).filter("text is not null and text <> ''")
    marks = labels.filter(F.col("subject_id").isin(ids)).groupBy(F.col("doc_id").alias("id")).agg(F.collect_set("subject_id").alias("ys"))
    marks = marks.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(max_labelled)
    taught = docs.join(marks, "id")

    def teach(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, table = Reader(), np.zeros((1 << BITS, k))
        for df in parts:
            y = np.zeros((len(df), k))
            for i, ys in enumerate(df["ys"]):
                y[i, [at[s] for s in ys]] = 1 / len(ys)
            terms, sent, doc_of, _ = reader.read(list(df["text"]), False)
            gather(table, terms, y[doc_of[sent]])
        yield _emit(table, k)

    first = _matrix(_summed(taught.mapInPandas(teach, _COUNT), k).collect(), k)
    start = spark.sparkContext.broadcast(term_model(first))

    def recount(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, table = Reader(), np.zeros((1 << BITS, k))
        for df in parts:
            terms, sent, doc_of, keys = reader.read(list(df["text"]), True)
            n = len(doc_of)
            if not n:
                continue
            z = score(start.value, terms, sent, n)
            subject = decide(z)
            own = np.zeros((n, k), np.float32)
            on = subject >= 0
            own[np.flatnonzero(on), subject[on]] = 1
            others = tally(subject, doc_of, len(df), k)[doc_of] - own
            known = others.sum(1) > 0
            mix = (others + 0.03) / (others + 0.03).sum(1, keepdims=True)
            w = np.log(mix) + np.clip(z, -3, 3)
            w = np.exp(w - w.max(1, keepdims=True))
            w /= w.sum(1, keepdims=True)
            told = (known | on)[sent]
            gather(table, terms[told], w[sent[told]])
            seen = on & known
            agree = (others.argmax(1) == subject) * 1.0
            part = pd.DataFrame({"key": keys[seen], "n": 1.0, "a": agree[seen]}).groupby("key", as_index=False).sum()
            yield pd.DataFrame({"kind": np.ones(len(part), np.int32), "key": part["key"], "n": part["n"], "v": pd.Series([[a] for a in part["a"]], dtype=object)})
        yield _emit(table, k)

    counted = cut(_summed(docs.mapInPandas(recount, _COUNT), k))
    recurring = counted.filter((F.col("kind") == 1) & (F.col("n") >= RECURS) & (F.col("v0") < AGREES * F.col("n"))).select(F.col("key").alias("aside"))
    known = recurring.limit(ASIDES + 1).collect()
    told = len(known) > ASIDES
    asides = np.sort(np.array([] if told else [r[0] for r in known], dtype=np.int64))
    if told:
        docs = _with_asides(docs, recurring)
        taught = docs.join(marks, "id")
    second = _matrix(counted.filter("kind = 0").collect(), k)
    model = spark.sparkContext.broadcast((term_model(first + second), asides))

    def measure(reader: Reader, df: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sentences, evidence) by document and subject, and the structure of each document."""
        terms, sent, doc_of, keys = reader.read(list(df["text"]), True)
        odds, aside = model.value
        if told:
            aside = np.unique(np.concatenate([np.zeros(0, np.int64), *(np.asarray(a, np.int64) for a in df["asides"] if a is not None)]))
        z = score(odds, terms, sent, len(doc_of))
        subject = decide(z)
        if len(aside) and len(keys):
            hit = np.searchsorted(aside, keys)
            subject[(hit < len(aside)) & (aside[np.minimum(hit, len(aside) - 1)] == keys)] = -1
        counts = tally(subject, doc_of, len(df), k)
        on = subject >= 0
        evidence = np.zeros((len(df), k), np.float32)
        np.add.at(evidence, (doc_of[on], subject[on]), z[np.flatnonzero(on), subject[on]])
        words = np.bincount(sent, minlength=len(doc_of))
        one = lambda w=None: np.bincount(doc_of, weights=w, minlength=len(df))
        return counts, evidence, np.stack([one(), one(words), one(words <= HEADING)], axis=1).astype(np.float32)

    flat = T.StructType().add("source", T.StringType()).add("ys", T.ArrayType(T.IntegerType())).add("c", T.ArrayType(T.FloatType())).add("e", T.ArrayType(T.FloatType())).add("s", T.ArrayType(T.FloatType()))

    def sample(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader()
        for df in parts:
            counts, evidence, structure = measure(reader, df)
            yield pd.DataFrame({"source": df["source"], "ys": df["ys"], **{n: pd.Series(list(x), dtype=object) for n, x in zip("ces", (counts, evidence, structure))}})

    rows = taught.mapInPandas(sample, flat).collect()
    y = np.array([[1.0 if s in set(r["ys"]) else 0.0 for s in ids] for r in rows]).reshape(len(rows), k)
    base = y.mean(0) if len(rows) else np.zeros(k)
    by: dict[str, list[int]] = {}
    for i, r in enumerate(rows):
        by.setdefault(r["source"], []).append(i)
    odds_of = {s: np.log(((y[i].sum(0) + 20 * base + 0.1) / (len(i) + 20)) / (base + 0.005)) for s, i in by.items()}
    if rows:
        x = features(np.array([r["c"] for r in rows]), np.array([r["e"] for r in rows]), np.array([odds_of[r["source"]] for r in rows]), np.array([r["s"] for r in rows]))
        chain = fit_chain(x, y)
    else:
        chain = []

    def decode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, none = Reader(), np.zeros(k)
        for df in parts:
            counts, evidence, structure = measure(reader, df)
            odds = np.array([odds_of.get(s, none) for s in df["source"]]).reshape(len(df), k)
            near = counts >= np.maximum(NEAR * counts.sum(1, keepdims=True), 1)
            d, s = np.nonzero(beam(chain, features(counts, evidence, odds, structure), near)) if chain else (np.zeros(0, int), np.zeros(0, int))
            yield pd.DataFrame({"id": df["id"].to_numpy()[d], "subject_id": np.array(ids, dtype=np.int32)[s]})

    return docs.mapInPandas(decode, T.StructType([T.StructField("id", documents.schema[key].dataType), T.StructField("subject_id", T.IntegerType())])).select(F.col("id").alias(key), "subject_id")


def composition(documents: DataFrame, labels: DataFrame, subjects: DataFrame) -> DataFrame:
    """Documents and characters of the corpus by subject: subject_id, subject_name, n_docs, n_chars."""
    got = assign_subjects(documents, labels, subjects)
    return got.join(documents.select("doc_id", "n_chars"), "doc_id").groupBy("subject_id").agg(F.count("*").alias("n_docs"), F.sum("n_chars").alias("n_chars")).join(subjects.select("subject_id", "subject_name"), "subject_id")
