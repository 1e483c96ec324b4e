"""Joins: references by key or name, as-of, overlap and nearest in time, membership, cyclic assignment, grounding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayloom.functions import text
from assayloom.operators.order import running_number


def resolve_references(rows: DataFrame, value: str, entities: DataFrame, key: str, name: str, others: str) -> DataFrame:
    """Rows with the id of the entity their value names: by its main name, else by the first entity listing it; case is ignored."""
    main = entities.groupBy(F.lower(F.col(name)).alias("k")).agg(F.min(key).alias("by_name"))
    listed = entities.select(key, F.explode(others).alias("o")).groupBy(F.lower("o").alias("k")).agg(F.min(key).alias("by_other"))
    keyed = rows.withColumn("k", text.strip_lower(F.col(value)))
    return keyed.join(main, "k", "left").join(listed, "k", "left").withColumn(key, F.coalesce("by_name", "by_other")).drop("k", "by_name", "by_other")


def last_before(events: DataFrame, left: str, right: str, within_s: int) -> DataFrame:
    """As-of join: for every `right` event the last `left` event of its user not later and at most `within_s` seconds before.

    One sort per user, no pairs: the latest left event is carried forward. event_id, left_id.
    """
    w = Window.partitionBy("user_id").orderBy("ts", F.when(F.col("event_type") == left, 0).otherwise(1), "event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = F.last(F.when(F.col("event_type") == left, F.struct("ts", "event_id")), ignorenulls=True).over(w)
    rows = events.filter(F.col("event_type").isin(left, right)).withColumn("prev", carried).filter(F.col("event_type") == right)
    near = F.col("ts").cast("timestamp").cast("long") - F.col("prev.ts").cast("timestamp").cast("long") <= within_s
    return rows.filter(near).select("event_id", F.col("prev.event_id").alias("left_id"))


def overlapping(events: DataFrame, a: str, b: str, half_s: int) -> DataFrame:
    """Range join: pairs of events of one user and two types at most `half_s` seconds apart, counted per user.

    Time is cut into cells of that width, so the join is an equi-join on user and cell and its neighbours.
    """
    timed = events.select("user_id", "event_id", "event_type", F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast(ts as timestamp_ntz))").alias("s"))
    left = timed.filter(F.col("event_type") == a).select("user_id", "event_id", F.col("s").alias("sa"), F.explode(F.array(*[F.floor(F.col("s") / half_s) + d for d in (-1, 0, 1)])).alias("cell"))
    right = timed.filter(F.col("event_type") == b).select("user_id", F.col("event_id").alias("other"), F.col("s").alias("sb"), F.floor(F.col("s") / half_s).alias("cell"))
    return left.join(right, ["user_id", "cell"]).filter(F.abs(F.col("sa") - F.col("sb")) <= half_s).groupBy("user_id").agg(F.count("*").alias("pairs"))


def nearest_in_time(events: DataFrame, of: str, to: str) -> DataFrame:
    """For every event of type `of` the nearest of type `to` of its user, before or after: event_id, other_id, gap_s; ties go to the earlier."""
    rows = events.filter(F.col("event_type").isin(of, to)).withColumn("s", F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast(ts as timestamp_ntz))"))
    mark = F.when(F.col("event_type") == to, F.struct("s", "event_id"))
    order = Window.partitionBy("user_id").orderBy("s", "event_id")
    both = rows.withColumn("p", F.last(mark, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("n", F.first(mark, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing)))
    gap = lambda c: F.abs(F.col(f"{c}.s") - F.col("s"))
    take_p = F.col("n").isNull() | (gap("p") <= gap("n"))
    picked = both.filter((F.col("event_type") == of) & (F.col("p").isNotNull() | F.col("n").isNotNull())).withColumn("best", F.when(F.col("p").isNotNull() & take_p, F.col("p")).otherwise(F.col("n")))
    return picked.select("event_id", F.abs(F.col("best.s") - F.col("s")).alias("gap_s"))


def ground_quotes(rows: DataFrame, key: str, body: str, quote: str) -> DataFrame:
    """Rows whose quote stands verbatim in the text, with its zero-based place: key, char_start, char_end."""
    at = F.position(F.col(quote), F.col(body))
    return rows.filter(F.col(quote) != "").select(key, (at - 1).cast("long").alias("char_start"), (at - 1 + F.length(quote)).cast("long").alias("char_end")).filter("char_start >= 0")


def cycle_pool(rows: DataFrame, pool: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Unassigned rows take their group's pool in turn: the j-th row gets element j mod n. Adds `value`."""
    w = Window.partitionBy(*keys).orderBy(value)
    numbered = pool.select(*keys, value).distinct().withColumn("slot", F.row_number().over(w) - 1)
    sizes = numbered.groupBy(*keys).agg(F.count("*").alias("n"))
    turns = running_number(rows, keys, order, "turn").join(sizes, keys).withColumn("slot", (F.col("turn") % F.col("n")).cast("int"))
    return turns.join(numbered, [*keys, "slot"]).drop("slot", "n", "turn")


def match_files(rows: DataFrame, files: DataFrame, left: str, right: str) -> DataFrame:
    """Rows with a flag whether a file of the same name exists; names are compared as letters and digits."""
    names = files.select(text.file_key(F.col(right)).alias("k")).filter("k is not null").distinct().withColumn("matched", F.lit(1))
    return rows.withColumn("k", text.file_key(F.col(left))).join(names, "k", "left").withColumn("matched", F.coalesce("matched", F.lit(0))).drop("k")
