"""Entities of several sources matched without a common key, each match with a confidence.

Random walks over the graph record - attribute - token train skip-gram vectors (`walks`). Vectors of several views of a record
are hashed by hyperplanes, one table or more per view. Pairs that share a bucket are compared exactly, and cosine and exact score
are calibrated to a confidence on records whose DOIs tell the truth.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.llm.bibkeys import surnames, title_key
from assayloom.llm.compare import Record, compare
from assayloom.llm.survivor import doi_key
from assayloom.llm.walks import DIM, SEED, VIEWS, Embedder, graph, skipgram, walks
from assayloom.session import cut

#: Words in at least this share of records are the vocabulary; their number is bounded by words per record over this share.
COMMON = 0.0005
#: Records that walks and vectors are fitted on (all of them up to there), and pairs of them that confidence is calibrated on.
SAMPLE, CALIBRATED = 8_000, 4_000
#: The greatest distance of 32-bit signatures that is reranked, and records in a block of a crowded bucket.
REACH, CROWD = 12, 400
#: Bits of a bucket up to which every view has one table; beyond, there is one table more per bit, since a pair shares a longer key less often.
BITS = 13
#: Crowded buckets that may be known to every task; beyond, they are told by a join.
KNOWN_CROWDS = 100_000
#: Registrants of preprint DOIs that may be known to every task.
KNOWN_SERVERS = 10_000

_RECORD = (
    T.StructType()
    .add("id", T.LongType())
    .add("source", T.StringType())
    .add("doi", T.StringType())
    .add("named", T.BooleanType())
    .add("kind", T.StringType())
    .add("main", T.StringType())
    .add("sub", T.StringType())
    .add("cut", T.BooleanType())
    .add("who", T.StringType())
    .add("year", T.IntegerType())
)
#: Stands between authors of a list that travels as one text.
_BETWEEN = "\u0001"


def _normalise(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in parts:
        keys = [title_key(t) for t in df["title"]]
        yield pd.DataFrame(
            {
                "id": df["id"],
                "source": df["source"],
                "doi": df["doi"],
                "named": df["named"],
                "kind": [k[0] for k in keys],
                "main": [k[1] for k in keys],
                "sub": [k[2] for k in keys],
                "cut": [k[3] for k in keys],
                "who": ["|".join(surnames(a.split(_BETWEEN))) if a else "" for a in df["authors"]],
                "year": df["year"],
            }
        )


def is_preprint(rows: DataFrame):
    """A column: whether `doi` is of a registrant that is a server, whose rows name no journal (`named`).

    Of a registrant's rows (five at least) one in twenty at most may name a journal. Rows without a DOI are no preprints here.
    Registrants are told by a list of bounded size; where there were more servers than `KNOWN_SERVERS`, this fails.
    """
    by = F.regexp_extract("doi", "^10[.][0-9]+", 0)
    servers = rows.filter("doi is not null").groupBy(by.alias("by")).agg(F.count("*").alias("n"), F.count_if("named").alias("named")).filter("n >= 5 and named * 20 <= n").select("by")
    known = [r[0] for r in servers.limit(KNOWN_SERVERS + 1).collect()]
    if len(known) > KNOWN_SERVERS:
        raise ValueError(f"more than {KNOWN_SERVERS} registrants of preprints")
    return F.coalesce(by.isin(known), F.lit(False)) if known else F.lit(False)


def _names(who: str) -> tuple[str, ...]:
    return tuple(who.split("|")) if who else ()


def _record(row) -> Record:
    year = row["year"]
    return Record(row["kind"] or "", row["main"] or "", row["sub"] or "", bool(row["cut"]), _names(row["who"]), None if year is None or year != year else int(year), row["doi"], bool(row["preprint"]))


def fit(sample: list[Record], vocabulary: dict[str, int], total: int) -> tuple[Embedder, np.ndarray]:
    """(embedder, calibration) from a bounded sample of records and the word counts of all records."""
    rng = np.random.default_rng(SEED)
    g = graph(sample)
    vectors = skipgram(walks(g, rng), g.tokens)
    weight = {w: float(np.log1p(total / n)) for w, n in vocabulary.items()}
    # a word outside the vocabulary is mostly a slip of one inside: it weighs what an average word does
    rare = sum(n * weight[w] for w, n in vocabulary.items()) / max(sum(vocabulary.values()), 1) or 1.0
    embedder = Embedder(vectors, weight, rare)
    embedder.centre(sample)
    return embedder, calibrate(sample, embedder, vocabulary)


def calibrate(sample: list[Record], embedder: Embedder, vocabulary: dict[str, int]) -> np.ndarray:
    """Logistic weights (bias, cosine, exact score): records of one DOI against neighbours of different DOIs.

    Neighbours are records of one first author or one beginning of the title; of the pairs, each beside the next in its
    neighbourhood, at most `CALIBRATED` of either kind are used.
    """
    near: dict[tuple, list[Record]] = {}
    for r in sample:
        if r.doi:
            for key in (("d", r.doi), ("w", *r.main.split()[:4]), *(("a", a) for a in r.authors[:1])):
                near.setdefault(key, []).append(r)
    pairs: tuple[list, list] = ([], [])
    for key, group in near.items():
        for a, b in zip(group, group[1:]):
            same = a.doi == b.doi
            if same == (key[0] == "d") and (same or (a.preprint == b.preprint and len(a.doi) == len(b.doi))) and len(pairs[same]) < CALIBRATED:
                pairs[same].append((a._replace(doi=None), b._replace(doi=None)))
    prior = np.array([-4.0, 2.0, 6.0])
    if len(pairs[1]) < 5 or not pairs[0]:
        return prior
    both = pairs[0] + pairs[1]
    x = np.stack([np.ones(len(both)), embedder.cosines([a.main for a, _ in both], [b.main for _, b in both]), [compare(a, b, vocabulary)[0] for a, b in both]], axis=1)
    y = np.r_[np.zeros(len(pairs[0])), np.ones(len(pairs[1]))]
    w = prior
    for _ in range(15):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 0.5 * np.eye(3), x.T @ (y - p) - 0.5 * (w - prior))
    return w


# ---- Spark -------------------------------------------------------------------------------------------------------------
_BUCKET = T.StructType().add("key", T.LongType()).add("sign", T.IntegerType()).add("c", T.LongType()).add("doi", T.LongType()).add("about", T.IntegerType())
_MASKS = ("who0", "who1", "ends")
for _m in _MASKS:
    _BUCKET = _BUCKET.add(_m, T.LongType())


def tables(bits: int) -> list[str]:
    """The view of each hash table."""
    views = list(VIEWS)
    return [views[k % len(views)] for k in range(len(views) + max(0, bits - BITS))]


@lru_cache(maxsize=1 << 16)
def _name_bits(name: str) -> tuple[int, int, int]:
    """A bit of 128 for a name, and bits of 32 each for its first two and its last three letters."""
    k = xxhash.xxh64_intdigest(name, seed=1) % 128
    ends = 1 << xxhash.xxh64_intdigest(name[:2], seed=2) % 32 | 1 << 32 + xxhash.xxh64_intdigest(name[-3:], seed=3) % 32
    return (1 << k, 0, ends) if k < 64 else (0, 1 << k - 64, ends)


def _masks(names: tuple[str, ...]) -> tuple[int, int, int]:
    w0 = w1 = ends = 0
    for n in names:
        x, y, z = _name_bits(n)
        w0, w1, ends = w0 | x, w1 | y, ends | z
    return w0, w1, ends


def buckets(classes: DataFrame, embedder, bits: int) -> DataFrame:
    """One row per record and table: bucket, 32-bit signature of the view, and what a pair must agree in.

    `about` packs the number of authors (two for more), year (0 for none), length of the DOI (0 for none) and preprint; the masks
    hold hashed names of all authors and their ends.
    """
    rng = np.random.default_rng(SEED + 1)
    signers = {view: rng.standard_normal((DIM, 32)).astype(np.float32) for view in VIEWS}
    planes = [(k, view, rng.standard_normal((DIM, bits)).astype(np.float32)) for k, view in enumerate(tables(bits))]
    powers = 2.0 ** np.arange(bits)  # at most 40 bits, exact in doubles

    def hash_rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e: Embedder = embedder.value
        for df in parts:
            ids = df["c"].to_numpy()
            names = [_names(w) for w in df["who"]]
            dois = np.array([xxhash.xxh64_intdigest(d) - (1 << 63) if d else 0 for d in df["doi"]], dtype=np.int64)
            size = np.array([min(len(d), 255) if d else 0 for d in df["doi"]], dtype=np.int64)
            few = np.array([min(len(n), 2) for n in names], dtype=np.int64)
            about = few << 22 | (df["year"].fillna(0).to_numpy().astype(np.int64) & 0xFFF) << 9 | size << 1 | ((size > 0) & df["preprint"].to_numpy(bool))
            masks = np.array([_masks(n) for n in names], dtype=np.uint64).reshape(-1, 3).view(np.int64)
            seen = e.views(df["main"].tolist(), names)
            signs = {view: np.packbits(m @ signers[view] > 0, axis=1).view(np.int32).ravel() for view, (_, m) in seen.items()}
            told = [(k, view, h) for k, view, h in planes if view in seen]
            if not told:
                continue
            rows = np.concatenate([seen[view][0] for _, view, _ in told])
            key = np.concatenate([((seen[view][1] @ h > 0).astype(np.float64) @ powers).astype(np.int64) * 64 + k for k, view, h in told])
            sign = np.concatenate([signs[view] for _, view, _ in told])
            yield pd.DataFrame({"key": key, "sign": sign, "c": ids[rows], "doi": dois[rows], "about": about[rows].astype(np.int32), **{name: masks[rows, j] for j, name in enumerate(_MASKS)}})

    return classes.mapInPandas(hash_rows, _BUCKET)


def candidates(rows: DataFrame) -> DataFrame:
    """Pairs of records (a, b) that share a bucket in some table and whose signatures are near, without pairs DOIs rule out.

    A crowded bucket is split into salted blocks of about `CROWD` records, and every pair of blocks is compared by a task's key of
    its own: no key brings more than two blocks together and no pair of the bucket is lost. Exact repeats are one record here.
    """
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD).select("key", F.ceil(F.col("n") / CROWD).cast("int").alias("blocks"))
    known = sizes.limit(KNOWN_CROWDS + 1).collect()
    content = ("sign", "c", "doi", "about", *_MASKS)
    if not known:
        keyed = rows.select("key", F.lit(0).alias("own"), F.lit(0).alias("other"), *content)
    else:
        told = sizes if len(known) > KNOWN_CROWDS else F.broadcast(rows.sparkSession.createDataFrame(known, "key long, blocks int"))
        blocked = rows.join(told, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
        met = blocked.withColumn("other", F.explode(F.when(F.col("blocks") > 1, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(0)))))
        low, high = F.least("own", "other"), F.greatest("own", "other")
        keyed = met.select(F.when(F.col("blocks") > 1, F.xxhash64("key", low, high)).otherwise(F.col("key")).alias("key"), "own", "other", *content)
    # one exchange serves both sides of the join
    spread = keyed.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key")
    side = lambda x: spread.select("key", F.col("c").alias(x), *[F.col(n).alias(f"{n}_{x}") for n in ("own", "other", "sign", "doi", "about", *_MASKS)])
    # records of one block meet under the block's pair with itself, of two blocks under the pair of both
    pairs = side("a").join(side("b"), "key").filter("a < b and own_a - other_b = 0 and other_a - own_b = 0")  # as equalities of columns they would be keys of the exchange
    years = "((about_a >> 9 & 4095) = 0 or (about_b >> 9 & 4095) = 0 or abs((about_a >> 9 & 4095) - (about_b >> 9 & 4095)) <= 2)"
    # DOIs of one length and kind that differ are two works; others are left to the exact comparison
    dois = "(doi_a = 0 or doi_b = 0 or (doi_a <> doi_b and (about_a & 511) <> (about_b & 511)))"
    # as in the exact comparison: lists of two or more share an author, a single author has at least an end of its name in common
    fewer = "least(about_a >> 22, about_b >> 22)"
    authors = f"({fewer} = 0 or (who0_a & who0_b) <> 0 or (who1_a & who1_b) <> 0 or ({fewer} = 1 and (ends_a & ends_b) <> 0))"
    near = f"bit_count(sign_a ^ sign_b) <= {REACH}"
    return pairs.filter(" and ".join((years, dois, authors, near))).select("a", "b").distinct()


_FIELDS = ("doi", "kind", "main", "sub", "cut", "who", "year")


def matched(papers: DataFrame, least: float = 0.5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, links, works) of a table of papers.

    `rows` has id, source, doi, c (the row's record: rows equal in every compared field are one), work and weakest (its weakest
    link, 1 where none); `links` the matches of records a, b with their confidence; `works` the linked records c with work and
    weakest. Rows without a title are left out.
    """
    spark = papers.sparkSession
    columns = [F.col("paper_row").alias("id"), "source", doi_key(F.col("doi")).alias("doi"), "title", F.array_join("authors", _BETWEEN).alias("authors"), "year", (F.col("journal").isNotNull() if "journal" in papers.columns else F.lit(True)).alias("named")]
    raw = papers.select(*columns).filter("title is not null")
    # two independent digests of all compared fields tell records apart; only they travel with a row
    digests = [F.xxhash64(*_FIELDS).alias("h"), F.xxhash64(F.lit(SEED), *reversed(_FIELDS)).alias("g")]
    members = cut(raw.mapInPandas(_normalise, _RECORD).filter("main <> ''").select("id", "source", "named", *digests, *_FIELDS))
    classes = cut(members.groupBy("h", "g", *_FIELDS).agg(F.min("id").alias("c")).withColumn("preprint", is_preprint(members)))
    total = classes.count()
    words = classes.select(F.explode(F.array_distinct(F.split(F.concat_ws(" ", "main", "sub"), " "))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    vocabulary = {r["w"]: int(r["n"]) for r in words.filter(F.col("n") >= max(4.0, COMMON * total)).collect() if r["w"]}
    # whole DOIs are sampled by hash; the threshold keeps what every task sends to its share of the sample
    dice = F.pmod(F.xxhash64(F.coalesce("doi", F.col("c").cast("string"))), F.lit(1 << 30))
    likely = classes.filter(dice < int(min(1.0, 1.2 * SAMPLE / max(total, 1)) * (1 << 30)))
    sample = [_record(r.asDict()) for r in likely.orderBy(dice, "c").limit(SAMPLE).collect()]
    model, weights = fit(sample, vocabulary, max(total, 1))
    embedder = spark.sparkContext.broadcast(model)
    bits = min(40, max(10, int(np.ceil(np.log2(max(total, 2)))) - 2))
    pairs = candidates(cut(buckets(classes.select("c", "doi", "preprint", "main", "who", "year"), embedder, bits)))
    fields = ("kind", "main", "sub", "cut", "who", "year", "doi", "preprint")
    payload = lambda x: classes.select(F.col("c").alias(x), "kind", "main", "sub", "cut", "who", F.coalesce("year", F.lit(0)).alias("year"), "doi", "preprint").toDF(x, *[f"{f}_{x}" for f in fields])
    loaded = pairs.join(payload("a"), "a").join(payload("b"), "b")

    def rerank(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e: Embedder = embedder.value
        for df in parts:
            out = []
            left, right = (list(zip(*[df[f"{f}_{x}"].tolist() for f in fields])) for x in "ab")
            for i, (x, y) in enumerate(zip(left, right)):
                a = Record(x[0], x[1], x[2], x[3], _names(x[4]), x[5] or None, x[6], x[7])
                b = Record(y[0], y[1], y[2], y[3], _names(y[4]), y[5] or None, y[6], y[7])
                if score := compare(a, b, vocabulary)[0]:
                    out.append((i, score))
            at = [i for i, _ in out]
            cosine = e.cosines([left[i][1] for i in at], [right[i][1] for i in at])
            z = weights[0] + weights[1] * cosine + weights[2] * np.array([s for _, s in out], dtype=float)
            yield pd.DataFrame({"a": df["a"].to_numpy()[at], "b": df["b"].to_numpy()[at], "confidence": 1 / (1 + np.exp(-z))})

    found = cut(loaded.mapInPandas(rerank, "a long, b long, confidence double").filter(F.col("confidence") >= least))
    named = classes.filter("doi is not null").groupBy("doi").agg(F.min("c").alias("b"))
    carried = classes.filter("doi is not null").select("doi", "c").join(named, "doi").filter("c <> b").select(F.col("c").alias("a"), "b", F.lit(1.0).alias("confidence"))
    works = parted(found, carried, classes)
    rows = members.select("id", "source", "doi", "h", "g").join(classes.select("h", "g", "c"), ["h", "g"]).drop("h", "g")
    rows = cut(rows.join(works, "c", "left").select("id", "source", "doi", "c", F.coalesce("work", "c").alias("work"), F.coalesce("weakest", F.lit(1.0)).alias("weakest")))
    return rows, found, works


def match_works(papers: DataFrame, least: float = 0.5) -> DataFrame:
    """(paper_row, work_row, confidence, n_rows): the work of each row by its smallest row, the confidence of the work's weakest
    link and its number of rows; a row that matches none is a work of its own. Rows without a title have null in all but the first."""
    rows = matched(papers, least)[0]
    works = rows.groupBy("work").agg(F.min("id").alias("work_row"), F.count("*").alias("n_rows"))
    known = rows.join(works, "work").select("id", "work_row", F.col("weakest").alias("confidence"), "n_rows")
    return papers.select(F.col("paper_row").alias("id")).join(known, "id", "left").select(F.col("id").alias("paper_row"), "work_row", "confidence", "n_rows")


def match_papers(papers: DataFrame, least: float = 0.5, confidence: bool = True) -> DataFrame:
    """(paper_row_a, paper_row_b, confidence): pairs of rows of different sources that are one work and do not carry one DOI.

    Rows without a title match nothing; missing authors, years and DOIs are legal; rows equal in every compared field are one
    record while matching and are expanded at the end. Matches and shared DOIs link records to works; rows of a work that were not
    matched directly pair with the confidence of its weakest link. Where links join several journal DOIs, the weakest are cut.
    Vectors are fitted on at most `SAMPLE` records, all rows are indexed.
    """
    rows, found, works = matched(papers, least)
    one = lambda x: rows.select("work", F.col("c").alias(f"c{x}"), F.col("id").alias(f"i{x}"), F.col("source").alias(f"s{x}"), F.col("doi").alias(f"d{x}"), F.col("weakest").alias(f"w{x}"))
    pair = "not (sa <=> sb) and not coalesce(da = db, false)"
    pairs = one("a").join(one("b"), "work").filter(f"ia < ib and {pair}").withColumn("a", F.least("ca", "cb")).withColumn("b", F.greatest("ca", "cb"))
    if confidence:
        closed = pairs.join(found, ["a", "b"], "left").select("ia", "ib", F.coalesce("confidence", F.when(F.col("a") == F.col("b"), 1.0), F.col("wa")).alias("confidence"))
    else:
        closed = pairs.select("ia", "ib", F.col("wa").alias("confidence"))
    # matches between two parts of a component count for themselves
    label = lambda x: works.select(F.col("c").alias(x), F.col("work").alias(f"p{x}"))
    across = found.join(label("a"), "a").join(label("b"), "b").filter("pa <> pb").select(F.col("a").alias("ca"), F.col("b").alias("cb"), "confidence")
    across = across.join(one("a").drop("work"), "ca").join(one("b").drop("work"), "cb").filter(pair).select(F.least("ia", "ib").alias("ia"), F.greatest("ia", "ib").alias("ib"), "confidence")
    return closed.unionByName(across).toDF("paper_row_a", "paper_row_b", "confidence")


_PART = T.StructType().add("c", T.LongType()).add("work", T.LongType()).add("weakest", T.DoubleType())


def split_work(edges: list[tuple]) -> list[tuple[int, int, float]]:
    """(c, work, weakest) of the parts of a component with links (a, b, confidence, carried, journal DOI of a, of b).

    Links join records from the strongest on, shared DOIs before all; a link that would bring together two journal DOIs, neither
    of them the other one cut short, is left out.
    """
    edges = sorted(edges, key=lambda e: (not e[3], -e[2], e[0], e[1]))
    up: dict[int, int] = {}
    doi: dict[int, str] = {}
    for a, b, _, _, x, y in edges:
        up[a], up[b] = a, b
        doi[a], doi[b] = x or "", y or ""

    def top(c: int) -> int:
        while up[c] != c:
            up[c] = c = up[up[c]]
        return c

    for a, b, *_ in edges:
        x, y = sorted((top(a), top(b)))
        short, long = sorted((doi[x], doi[y]), key=len)
        if x != y and long.startswith(short):
            up[y], doi[x] = x, long  # the DOIs of a part are beginnings of its longest
    weakest: dict[int, float] = {}
    for a, b, w, *_ in edges:
        if top(a) == top(b):
            weakest[top(a)] = min(w, weakest.get(top(a), 1.0))
    return [(c, top(c), weakest.get(top(c), 1.0)) for c in up]


def _split_works(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """`split_work` of each run of rows of one component."""
    whole, held, out = None, [], []
    for df in parts:
        for row in zip(*[df[c].tolist() for c in ("whole", "a", "b", "confidence", "carried", "ja", "jb")]):
            if row[0] != whole:
                out += split_work(held)
                whole, held = row[0], []
            held.append(row[1:])
        yield pd.DataFrame(out, columns=_PART.names)
        out = []
    yield pd.DataFrame(split_work(held), columns=_PART.names)


def parted(found: DataFrame, carried: DataFrame, classes: DataFrame) -> DataFrame:
    """(c, work, weakest): components of matches and shared DOIs, those with several journal DOIs cut at their weakest links.

    A task holds the links of one such component.
    """
    edges = found.select("a", "b", "confidence", F.lit(False).alias("carried")).unionByName(carried.select("a", "b", "confidence", F.lit(True).alias("carried")))
    journal = classes.select("c", F.when(~F.col("preprint"), F.col("doi")).alias("journal"))
    known = cut(components(edges).join(journal, "c"))
    mixed = known.groupBy("work").agg(F.min("journal").alias("x"), F.max("journal").alias("y")).filter("x <> y").select("work")
    members = cut(known.join(mixed, "work", "left_semi").select("c", "work", "journal"))
    links = edges.join(members.toDF("a", "whole", "ja"), "a").join(members.select(F.col("c").alias("b"), F.col("journal").alias("jb")), "b")
    parts = links.repartition("whole").sortWithinPartitions("whole").mapInPandas(_split_works, _PART)
    return cut(known.join(members, "c", "left_anti").select("c", "work", "weakest").unionByName(parts))


def components(edges: DataFrame) -> DataFrame:
    """(c, work, weakest): the smallest node each node is linked to over any number of links, and the weakest link of its work.

    Every node hooks on to the first of its neighbours and itself in a random order, edges are drawn between the hooks, and what is
    left of them is treated alike until none is. An order by hash leaves a fraction of the nodes of any graph, so the rounds grow
    with the logarithm of its size, and all but the first are short; every round is cut from its lineage in the shared folder.
    """
    first = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("c"))
    rest, hooks = edges.select("a", "b"), []
    while True:
        near = rest.select("a", first("b").alias("x")).unionByName(rest.select(F.col("b").alias("a"), first("a").alias("x")))
        step = near.groupBy("a").agg(F.min("x").alias("x")).select(F.col("a").alias("c"), F.least("x", first("a"))["c"].alias("p"))
        hooked = cut(step)
        up = lambda x: hooked.select(F.col("c").alias(x), F.col("p").alias(f"p{x}"))  # noqa: B023, E731
        hooks.append(hooked)
        rest = cut(rest.join(up("a"), "a").join(up("b"), "b").filter("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
        if rest.limit(1).count() == 0:
            break
    root = hooks[-1]
    for hooked in reversed(hooks[:-1]):
        later = root.select(F.col("c").alias("p"), F.col("p").alias("q"))
        root = hooked.join(later, "p", "left").select("c", F.coalesce("q", "p").alias("p"))
    root = cut(root)
    told = edges.join(root.select(F.col("c").alias("a"), "p"), "a").groupBy("p").agg(F.min(F.least("a", "b")).alias("work"), F.min("confidence").alias("weakest"))
    return root.join(told, "p").select("c", "work", "weakest")


def found(papers: DataFrame) -> DataFrame:
    """Pairs that are one work: paper_row_a, paper_row_b."""
    return match_papers(papers, confidence=False).select("paper_row_a", "paper_row_b")
