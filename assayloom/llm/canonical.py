"""Free-entered values mapped to the closest entry of a reference list.

The entries and their spellings sit in a BK-tree under Levenshtein distance. A list within `broadcast_entries` is one tree in
every worker; a longer one is cut into shards, every distinct value searches all shards, and the shard winners are merged.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.functions.bktree import BKTree
from assayloom.functions.glyphs import consistent
from assayloom.session import cut

UNMATCHED = -1
#: Distinct values that one task searches in one shard.
BLOCK = 50_000
Entry = tuple[str, int]  # spelling, id

# Words that begin a strain designation, and words that name no species.
_STRAIN_WORDS = {"strain", "strains", "isolate", "isolates", "clinical", "wild", "type", "resistant", "sensitive", "susceptible", "mutant", "culture", "serotype", "serovar", "subsp", "ssp", "var", "biovar", "atcc"}
_NO_SPECIES = {"sp", "spp", "species"}
_LEAD = re.compile(r"^(?:(?:clinical\s+)?(?:strains?|isolates?|cultures?|cells?)\s+of\s+)+", re.I)
_CODE = re.compile(r"^[A-Za-z]{2,5}$")


def organism_key(text: str | None) -> str:
    """Genus and species as lower-case words: strain designations, brackets, marks, doubled initials and inverted order resolved."""
    s = consistent(text) or ""
    s = _LEAD.sub("", s.replace("_", " "))
    m = re.match(r"^([A-Za-z]+),\s*([A-Z][a-z]+)$", s)
    if m:
        s = f"{m[2]} {m[1]}"
    s = re.sub(r"[^\w\s'’-]", " ", s)
    raw = re.sub(r"(?<=\w)-(?=\w)", "\x00", s).replace("-", " ").replace("\x00", "-").split()
    words: list[str] = []
    for i, w in enumerate(raw):
        low = w.lower()
        if words and (low in _STRAIN_WORDS or any(c.isdigit() for c in w)):
            break
        if words and _CODE.match(w) and i + 1 < len(raw) and raw[i + 1].isdigit() and (w.isupper() or len(words) > 1):
            break
        words.append(low)
    if len(words) >= 3 and len(words[0]) <= 5 and words[1].startswith(words[0]):
        words = words[1:]  # "S. Staphylococcus aureus"
    return " ".join(words)


def organism_spellings(name: str, canonical: bool = True) -> list[str]:
    """The forms under which a name is listed: itself and, for a binomial, its abbreviation and (canonical names) its initials."""
    key = organism_key(name)
    words = key.split()
    out = [key]
    if len(words) == 2 and "'" not in key and name[:1].isupper() and words[1] not in _GENERIC:
        out.append(f"{words[0][0]} {words[1]}")
        if canonical:
            out.append(words[0][0] + words[1][0])
    return out


# Second words that end a common name, not a binomial; irregular plurals.
_GENERIC = {"bacillus", "vibrio", "rat", "coccus", "staph", "yeast", "mould"}
_PLURALS = {"mice": "mouse", "men": "man"}


def default_limit(key: str) -> int:
    """The edit threshold of a key: none up to 3 signs, then about a quarter of its length, 5 at most."""
    n = len(key)
    return 0 if n < 5 else 1 if n < 9 else 2 if n < 11 else 3 if n < 14 else 4 if n < 20 else 5


def _alike(a: str, b: str) -> int:
    """Signs that two texts share at their beginning and end."""
    n = min(len(a), len(b))
    head = next((k for k in range(n) if a[k] != b[k]), n)
    return head + next((k for k in range(n - head) if a[-1 - k] != b[-1 - k]), n - head)


class Matcher:
    """The closest entry of a list of spellings.

    A hit is (stage, distance, -signs alike, id): smaller is better, so hits of several shards merge by their minimum.
    """

    def __init__(self, entries: Iterable[Entry], limit: Callable[[str], int] = default_limit):
        self.ids: dict[str, set[int]] = {}
        for spelling, entry in entries:
            self.ids.setdefault(spelling, set()).add(entry)
        self.tree = BKTree(sorted(self.ids))
        self.limit = limit
        self.first = sorted({w.split()[0] for w in self.ids if " " in w})

    def near(self, key: str, stage: int, keep: Callable[[str], bool] = lambda word: True) -> Hit | None:
        """The nearest kept spelling; ties go to the one sharing most of its ends, then the smallest id.

        A key that is spelled like several entries names none of them.
        """
        if (ids := self.ids.get(key)) is not None and keep(key):
            return (stage, 0, 0, next(iter(ids)) if len(ids) == 1 else UNMATCHED)
        found = [(stage, d, -_alike(key, w), min(self.ids[w])) for d, w in self.tree.search(key, self.limit(key)) if len(self.ids[w]) == 1 and keep(w)]
        return min(found, default=None)

    def best(self, key: str, stage: int = 0) -> Hit | None:
        """The entry meant by a key: as written; with its genus cut short; in inverted order; by its leading words; by a common name."""
        words = key.split()
        if not words or words[-1] in _NO_SPECIES:
            return None
        if hit := self.near(key, stage):
            return hit
        if len(words) == 2 and 1 < len(words[0]) < 7:
            starts = {g for g in self.first if g.startswith(words[0])}
            ids = {i for w in self.ids if starts and w.split()[0] in starts for i in self.ids[w]}
            if ids and (hit := self.near(f"{words[0][0]} {words[1]}", stage + 1, lambda w: w[1:2] == " " and bool(self.ids[w] & ids))):
                return hit
        if len(words) == 2 and (hit := self.near(f"{words[1]} {words[0]}", stage + 2)):
            return hit
        if len(words) > 2 and (hit := self.best(" ".join(words[:2]), stage + 3)):
            return hit
        for w in words:
            w = _PLURALS.get(w, w[:-1] if w.endswith("s") and w[:-1] in self.ids else w)
            if len(w) > 2 and len(ids := self.ids.get(w, ())) == 1:
                return (stage + 6, 0, 0, next(iter(ids)))
        return None


Hit = tuple[int, int, int, int]
_HIT = T.StructType().add("stage", T.IntegerType()).add("distance", T.IntegerType()).add("alike", T.IntegerType()).add("entry", T.LongType())


def map_to_list(
    df: DataFrame,
    value: str,
    entries: DataFrame,
    into: str = "entry_id",
    key: Callable[[str], str] = organism_key,
    limit: Callable[[str], int] = default_limit,
    broadcast_entries: int = 100_000,
    shards: int = 8,
) -> DataFrame:
    """Adds the long column `into`: the id of the entry that `value` means, -1 where none is within the threshold, null for null.

    `entries` has `spelling` (already a key) and `entry`. Up to `broadcast_entries` spellings are one tree per worker and the
    pass is narrow; beyond, entries are hashed into shards, each distinct value visits all shards, and the shard winners merge.
    Empty texts and texts without a word get -1; ties follow `Matcher`; repeated rows get equal results; very long texts are
    searched whole (their threshold is 5 edits). Extra columns pass through, a column named `into` is replaced.
    """
    spark = df.sparkSession
    listed = entries.select(F.col("spelling"), F.col("entry").cast("long")).filter("spelling is not null and entry is not null").distinct()
    head = listed.limit(broadcast_entries + 1).collect()
    if len(head) <= broadcast_entries:
        rows = [(r[0], r[1]) for r in head]

        def narrow(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            matcher = Matcher(rows, limit)

            @lru_cache(maxsize=1 << 17)
            def of(k: str) -> int:
                hit = matcher.best(k)
                return hit[3] if hit else UNMATCHED

            for values in parts:
                codes, seen = pd.factorize(values)
                ids = pd.array([of(key(v)) for v in seen] + [None], dtype="Int64")
                yield pd.Series(ids.take(codes))

        return df.withColumn(into, F.pandas_udf(narrow, T.LongType())(F.col(value)))

    distinct = cut(df.select(F.col(value).alias("v")).filter("v is not null").distinct())
    blocks = max(1, -(-distinct.count() // BLOCK))
    asked = distinct.withColumn("block", F.pmod(F.xxhash64("v"), F.lit(blocks))).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    # an entry keeps its spellings together; a spelling of several entries is marked as such in every shard that holds it
    double = listed.groupBy("spelling").agg(F.min("entry").alias("x"), F.max("entry").alias("y")).filter("x <> y").select("spelling")
    own = F.pmod(F.xxhash64("entry"), F.lit(shards)).cast("int")
    sharded = listed.withColumn("shard", own)
    sharded = sharded.unionByName(sharded.join(double, "spelling", "left_semi").withColumn("entry", F.lit(UNMATCHED).cast("long")))
    held = sharded.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def search(values: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        matcher = Matcher(zip(part["spelling"], part["entry"]), limit)
        hits = [(v, h) for v in values["v"] if (h := matcher.best(key(v)))]
        return pd.DataFrame({"v": pd.Series([v for v, _ in hits], dtype=object), **{n: pd.Series([h[k] for _, h in hits], dtype="int64") for k, n in enumerate(_HIT.names)}})

    schema = T.StructType([T.StructField("v", T.StringType()), *_HIT.fields])
    hits = asked.groupBy("shard", "block").cogroup(held.groupBy("shard", "block")).applyInPandas(search, schema)
    won = hits.groupBy(F.col("v").alias("__v")).agg(F.min(F.struct(*_HIT.names)).alias("hit")).select("__v", F.col("hit.entry").alias("__entry"))
    joined = df.join(won, F.col(value) == F.col("__v"), "left")
    return joined.withColumn(into, F.when(F.col(value).isNotNull(), F.coalesce("__entry", F.lit(UNMATCHED).cast("long")))).drop("__v", "__entry")


_SPELL = T.ArrayType(T.StringType())


def organism_entries(reference: DataFrame) -> DataFrame:
    """(spelling, entry) of a table organism_id, canonical_name, other_names."""

    def spell(names: pd.Series, canonical: pd.Series) -> pd.Series:
        return pd.Series([organism_spellings(n, bool(c)) if n else [] for n, c in zip(names, canonical)])

    names = reference.select("organism_id", F.col("canonical_name").alias("name"), F.lit(True).alias("canonical")).unionByName(
        reference.select("organism_id", F.explode("other_names").alias("name"), F.lit(False).alias("canonical"))
    )
    return names.select(F.col("organism_id").alias("entry"), F.explode(F.pandas_udf(spell, _SPELL)("name", "canonical")).alias("spelling")).filter("spelling <> ''")


def found(assay: DataFrame, curated: DataFrame, reference: DataFrame) -> DataFrame:
    """Rows whose organism is typed but not unified, with the entry meant or -1: tbl, row_id, organism_id."""
    a = assay.filter("bacteria is not null and bacteria_unified is null").select(F.lit("assay_rows").alias("tbl"), "row_id", F.col("bacteria").alias("v"))
    c = curated.filter("organism_raw is not null and organism_std is null").select(F.lit("curated_records").alias("tbl"), F.col("rec_no").alias("row_id"), F.col("organism_raw").alias("v"))
    return map_to_list(a.unionByName(c), "v", organism_entries(reference), "organism_id").drop("v")
