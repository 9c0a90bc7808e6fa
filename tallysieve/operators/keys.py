"""Duplicate marks, first occurrences and key look-ups that hold up under hot keys.

One key may carry a third of all rows. Nothing here gathers the rows of one key in one task:

* duplicates are counted with partial aggregation, so a hot key costs one row per map task;
* the first row per key is cut on the map side before anything is shuffled;
* a look-up join sends the rows of hot keys (and NULL keys) past the shuffle. Their few matches are
  broadcast - the list of hot keys has a fixed upper length - and the rows are spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv

SOURCE_ORDER = (fv.SOURCE_FILE, fv.SOURCE_LINE)
# At most this many keys are tracked as hot: the proven bound of every hot-key broadcast below.
MAX_HOT_KEYS = 1000
# A key counts as hot from this share of the rows on; MAX_HOT_KEYS such keys fit by arithmetic.
HOT_SHARE = 0.001
# Spreads the rows of hot and missing keys where it is there.
SALT = "__spread"


def source_order() -> list[Column]:
    """Order of the consolidated source: file name without case, then exact name, then line."""
    return [F.lower(fv.SOURCE_FILE), F.col(fv.SOURCE_FILE), F.col(fv.SOURCE_LINE)]


def order_value() -> Column:
    """The source order as one comparable value."""
    return F.struct(
        F.lower(fv.SOURCE_FILE).alias("a"), F.col(fv.SOURCE_FILE).alias("b"), F.col(fv.SOURCE_LINE).alias("c")
    )


def first_per_key(df: DataFrame, key: str) -> DataFrame:
    """First row of every key in source order; NULL is one key.

    The filter on row_number becomes a group limit that already runs before the shuffle, so each map
    task sends at most one row per key.
    """
    w = Window.partitionBy(key).orderBy(*source_order())
    return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") == 1).drop("__rank")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows; NULL is one key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def repeated_row_count(df: DataFrame, key: str) -> DataFrame:
    """One row: how many rows carry a key that occurs more than once."""
    return repeated_keys(df, key).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failed_rows"))


def first_occurrences(df: DataFrame, key: str, hot: DataFrame | None = None) -> DataFrame:
    """For each repeated non-NULL key, the source order of its first row.

    Keys are counted on their own by hash; only rows of repeated keys carry their order any further, those of hot keys past
    the shuffle.
    """
    known = df.where(F.col(key).isNotNull()).select(key, *SOURCE_ORDER)
    repeats = repeated_keys(known, key).select(key, F.lit(True).alias("__repeated"))
    met = lookup_join(known, repeats, key, hot).where("__repeated")
    return met.groupBy(key).agg(F.min(order_value()).alias("first_order"))


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(key_name, key): keys likely to hold at least HOT_SHARE of the rows, in one pass for all columns.

    NULL is listed too where it is that frequent. A sketch of fixed size per column; no shuffle beyond one row per task. Whether a key is listed only
    decides how its rows travel, never which rows match.
    """
    tops = [F.expr(f"approx_top_k(cast({k} as string), {MAX_HOT_KEYS})").alias(k) for k in keys]
    # One row, exploded to at most MAX_HOT_KEYS rows per column.
    wide = df.agg(F.count(F.lit(1)).alias("total"), *tops)
    listed = wide.select(
        "total",
        F.explode(
            F.array(*[F.struct(F.lit(k).alias("key_name"), F.col(k).alias("top")) for k in keys])
        ).alias("x"),
    ).select("total", "x.key_name", F.explode("x.top").alias("t"))
    return listed.where(F.col("t.count") >= F.col("total") * HOT_SHARE).select(
        "key_name", F.col("t.item").alias("key")
    )


def lookup_join(
    left: DataFrame,
    right: DataFrame | Sequence[DataFrame],
    key: str,
    hot: DataFrame | None = None,
    null_matches: bool = False,
    repeated: str | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join to a table with at most one row per key; `right` must carry the key under the same name.

    Several tables of one key are joined behind one shuffle of `left`; `null_matches` takes one table. `repeated` names a
    boolean that says whether the row's non-NULL key occurs more than once in `left`, counted behind that shuffle too;
    `counted` has the keys of the same rows and is read for those of hot keys where `left` costs more to make again.

    Without `hot` this is a plain left join: Spark broadcasts `right` when its size is known to be small
    and AQE splits skewed partitions otherwise. With `hot`, a table of at most MAX_HOT_KEYS key texts,
    rows of those keys meet a broadcast of their matches, and on the shuffled side they, like NULL keys,
    get a spread-out key that matches nothing.
    """
    tables = [right] if isinstance(right, DataFrame) else list(right)
    payloads = [[c for c in t.columns if c != key] for t in tables]
    payload = [c for names in payloads for c in names]
    if hot is None and not null_matches and repeated is None:
        return reduce(lambda a, b: a.join(b, key, "left"), tables, left)

    near_tables, marks = list(tables), []
    if repeated is not None:
        marks = [repeated]
        if hot is not None:
            of_hot = (left if counted is None else counted).select(key).join(F.broadcast(hot), F.col(key).cast("string") == F.col("hot_key"), "left_semi")
            near_tables.append(repeated_keys(of_hot, key).select(key, F.lit(True).alias(repeated)))
    parts = []
    if hot is not None:
        hot = hot.where(F.col("hot_key").isNotNull())
        # Both sides hold at most MAX_HOT_KEYS rows here. Hot keys without a match stay listed: their
        # rows must not meet in one shuffle partition either.
        found = hot
        for t in near_tables:
            met_hot = t.join(F.broadcast(hot), F.col(key).cast("string") == F.col("hot_key"), "left_semi")
            found = found.join(F.broadcast(met_hot), F.col("hot_key") == F.col(key).cast("string"), "left").drop(key)
        parts.append(found.select(F.col("hot_key").cast(left.schema[key].dataType).alias("__near_key"), *payload, *marks))
    if null_matches:
        # At most one row per key, so at most one NULL row.
        (only,) = tables
        none = [F.lit(False).alias(c) for c in marks]
        parts.append(only.where(F.col(key).isNull()).select(F.col(key).alias("__near_key"), *payload, *none))
    met, away = left, F.col(key).isNull()
    if parts:
        near = reduce(DataFrame.unionByName, parts).select(
            "__near_key", F.lit(True).alias("__near"), *[F.col(c).alias(f"__near_{c}") for c in (*payload, *marks)]
        )
        same = F.col(key).eqNullSafe(F.col("__near_key")) if null_matches else F.col(key) == F.col("__near_key")
        met = left.join(F.broadcast(near), same, "left")
        away = F.col("__near").isNotNull() | away

    joined = met.withColumn("__far_key", F.when(away, _spread(left)).otherwise(F.col(key).cast("string")))
    if repeated is not None:
        others = F.count(F.when(~away, F.lit(1))).over(Window.partitionBy("__far_key"))
        joined = joined.withColumn("__far_count", others)
    for t, names in zip(tables, payloads):
        far = t.select(F.col(key).cast("string").alias("__far_key"), *[F.col(c).alias(f"__far_{c}") for c in names])
        joined = joined.join(far, "__far_key", "left")

    def either(c: str) -> Column:
        return F.coalesce(F.col(f"__near_{c}"), F.col(f"__far_{c}")) if parts else F.col(f"__far_{c}")

    met_marks = []
    for c in marks:
        far_mark = ~away & (F.col("__far_count") > 1)
        met_marks.append((F.coalesce(F.col(f"__near_{c}"), far_mark) if parts else far_mark).alias(c))
    return joined.select(*[F.col(c) for c in left.columns], *[either(c).alias(c) for c in payload], *met_marks)


def _spread(left: DataFrame) -> Column:
    """A key that spreads rows over all tasks and matches nothing."""
    salt = F.col(SALT) if SALT in left.columns else _small_salt()
    return F.concat(F.lit("\u0000"), salt.cast("string"))


def salted(df: DataFrame) -> DataFrame:
    """With a small salt by source place, so that the place itself need not go through every shuffle."""
    return df.withColumn(SALT, _small_salt())


def _small_salt() -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in SOURCE_ORDER]), F.lit(65536)).cast("int")


def rank_later(df: DataFrame, key: str, flag: str, hot: DataFrame | None = None) -> DataFrame:
    """Flag every row whose non-NULL key already occurred earlier in source order, behind one shuffle of the rows.

    Rows of a key are ranked where they meet. Those of hot keys stay away and are compared with the first order of their key,
    which partial aggregates find.
    """
    met, away, near_later = df, F.col(key).isNull(), F.lit(False)
    if hot is not None:
        listed = hot.where(F.col("hot_key").isNotNull())
        of_hot = df.select(key, *SOURCE_ORDER).join(F.broadcast(listed), F.col(key).cast("string") == F.col("hot_key"), "left_semi")
        firsts = of_hot.groupBy(F.col(key).alias("__near_key")).agg(F.min(order_value()).alias("__first_order"))
        met = df.join(F.broadcast(firsts), F.col(key) == F.col("__near_key"), "left")
        away = F.col("__near_key").isNotNull() | away
        near_later = F.coalesce(order_value() > F.col("__first_order"), F.lit(False))
    # Rows that stay away are alone with a salt; a NULL salt keeps the others of a key together.
    met = met.withColumn("__salt", F.when(away, F.xxhash64(*[F.col(c) for c in SOURCE_ORDER])))
    rank = F.rank().over(Window.partitionBy(key, "__salt").orderBy(*source_order()))
    ranked = met.withColumn("__rank", rank)
    later = F.when(F.col("__salt").isNotNull(), near_later).otherwise(F.col("__rank") > 1)
    return ranked.select(*df.columns, later.alias(flag))


def mark_repeated(
    df: DataFrame, key: str, flag: str, hot: DataFrame | None = None, stage: Callable[[str, DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Flag every row whose non-NULL key occurs more than once. With `stage`, the repeated keys are counted once."""
    repeats = repeated_keys(df.where(F.col(key).isNotNull()), key).select(key, F.lit(True).alias(flag))
    repeats = stage(f"repeated_{key}", repeats) if stage else repeats
    return lookup_join(df, repeats, key, hot).withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def mark_later(
    df: DataFrame, key: str, flag: str, hot: DataFrame | None = None, stage: Callable[[str, DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Flag every row whose non-NULL key already occurred earlier in source order. With `stage`, firsts are found once."""
    firsts = first_occurrences(df, key, hot)
    firsts = stage(f"first_{key}", firsts) if stage else firsts
    joined = lookup_join(df, firsts, key, hot)
    later = F.coalesce(order_value() > F.col("first_order"), F.lit(False))
    return joined.withColumn(flag, later).drop("first_order")


def assert_unique(df: DataFrame, key: str) -> DataFrame:
    """One row (key, rows) when `key` is unique; running it fails when a key occurs twice."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    worst = counts.agg(F.max("n").alias("most"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    return worst.select(
        F.lit(key).alias("key"),
        F.when(F.col("most") > 1, F.raise_error(F.lit(f"key is not unique: {key}")).cast("bigint"))
        .otherwise(F.col("rows"))
        .alias("rows"),
    )
