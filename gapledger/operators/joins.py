"""Joins against lookups and earlier snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keys that a sketch may report as hot, and keys it follows to find them.
HOT_KEYS, TRACKED_KEYS = 100, 10_000


def lookup_left(
    facts: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str, spread_by: str, salts: int = 0
) -> DataFrame:
    """Left equi join of facts to a lookup of unknown size.

    No broadcast is forced: Spark broadcasts a lookup that measures small and
    otherwise shuffles, with adaptive execution splitting hot fact keys.

    The join also compares a hash of the key. For facts without key, which can
    never match yet would all land in one partition, that hash is taken from
    ``spread_by`` (any well-spread fact column) and scatters them. As a second
    key it moreover gives both sides a shuffle of their own whatever came before,
    which adaptive splitting needs.

    With ``salts``, hot keys are split without adaptive execution, whose thresholds are in
    bytes: facts of a key that has more than its fair share of them are dealt to so many
    salts by ``spread_by``, and its lookup rows are copied to each. See ``hot_keys``.
    """
    types = facts.schema[fact_key].dataType, lookup.schema[lookup_key].dataType
    if types[0] != types[1]:
        raise TypeError(f"{fact_key} and {lookup_key} hash differently: {types[0]} and {types[1]}")
    key, scattered = F.col(fact_key), F.xxhash64(spread_by)
    if salts:
        hot = hot_keys(facts, fact_key, salts)
        salt = F.when(F.array_contains(hot, key), F.pmod(scattered, F.lit(salts))).otherwise(F.lit(0).cast("long"))
        spread = F.when(key.isNull(), scattered).otherwise(F.xxhash64(key, salt))
        copies = F.when(F.array_contains(hot, F.col(lookup_key)), F.sequence(F.lit(0), F.lit(salts - 1)))
        copied = lookup.withColumn("_salt", F.explode(F.coalesce(copies, F.array(F.lit(0)))))
        right = copied.withColumn("_lookup_spread", F.xxhash64(lookup_key, F.col("_salt").cast("long"))).drop("_salt")
    else:
        spread = F.when(key.isNull(), scattered).otherwise(F.xxhash64(key))
        right = lookup.withColumn("_lookup_spread", F.xxhash64(lookup_key))
    left = facts.withColumn("_spread", spread)
    on = (F.col(fact_key) == F.col(lookup_key)) & (F.col("_spread") == F.col("_lookup_spread"))
    return left.join(right, on, "left").drop("_spread", "_lookup_spread")


def hot_keys(facts: DataFrame, key: str, salts: int) -> Column:
    """Keys with more than one in ``HOT_KEYS`` of all facts' keys, as one array; at most ``HOT_KEYS``.

    The counts are a sketch's, of bounded size however many keys there are. It follows
    ``TRACKED_KEYS`` of them; which of the frequent ones it finds only decides how facts are
    spread, never what they are joined to. The array is a scalar subquery: nothing runs until
    the join does, and it reads the facts' key once more.
    """
    if salts < 2:
        raise ValueError(f"{salts} salts do not split a key")
    counted = facts.filter(F.col(key).isNotNull()).agg(
        F.call_function("approx_top_k", F.col(key), F.lit(HOT_KEYS), F.lit(TRACKED_KEYS)).alias("top"),
        F.count(F.lit(1)).alias("n"),
    )
    often = F.filter("top", lambda t: t["count"] * HOT_KEYS > F.col("n"))
    return counted.select(F.transform(often, lambda t: t["item"]).alias("hot")).scalar()


def first_per_key(df: DataFrame, key: str, position: str) -> DataFrame:
    """The row with the lowest position of every key; rows without key dropped.

    Written as a rank filter: Spark then keeps one row per key in each task
    before the shuffle, so a hot key costs no more than any other.
    """
    ranked = F.row_number().over(Window.partitionBy(key).orderBy(position))
    return df.filter(F.col(key).isNotNull()).withColumn("_rank", ranked).filter("_rank = 1").drop("_rank")


def carry_over(joined: DataFrame, matched: Column, pairs: dict[str, str]) -> DataFrame:
    """Overwrite columns with the earlier snapshot's wherever a row matched.

    ``pairs`` maps a column to its earlier counterpart. An earlier null
    overwrites too. Counterparts are dropped.
    """
    updated = {
        column: F.when(matched, F.col(earlier)).otherwise(F.col(column)) for column, earlier in pairs.items()
    }
    return joined.withColumns(updated).drop(*pairs.values())


def outer_merge(frames: dict[str, DataFrame], keys: list[str], spread: str | None = None) -> DataFrame:
    """Full outer join of frames that were worked out independently, each with a row per key at most.

    A key is found whichever frames have it; columns of the others are null there. ``in_<name>``
    says which frame has the row. A null in the keys is a value like any other and matches a
    null, as rows of one group do; with ``spread``, a column of every frame, rows that have a null
    key match nothing and are kept once for each frame, scattered by that column.

    A column that several frames have comes as ``<name>_<column>`` from each. All frames are
    grouped by key in one shuffle instead of one join after the other, so no null keys
    made by one join are dealt out by the next.
    """
    columns = [c for df in frames.values() for c in df.columns if c not in keys]
    own = {name: [c for c in df.columns if c not in keys] for name, df in frames.items()}
    shown = {name: {c: f"{name}_{c}" if columns.count(c) > 1 else c for c in own[name]} for name in frames}
    parts = []
    for name, df in frames.items():
        apart = F.lit(None).cast("string")
        if spread is not None:
            keyless = F.lit(False)
            for k in keys:
                keyless = keyless | F.col(k).isNull()
            # Equal rows without key stay apart by the frame and the place they have in it.
            unique = F.concat_ws("-", F.lit(name), F.xxhash64(spread), F.monotonically_increasing_id())
            apart = F.when(keyless, unique)
        row = F.struct(*[F.col(c) for c in own[name]], F.lit(True).alias("_here"))
        parts.append(df.select(*keys, apart.alias("_apart"), row.alias(f"_row_{name}")))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    rows = merged.groupBy(*keys, "_apart").agg(
        *[F.first(f"_row_{name}", ignorenulls=True).alias(f"_row_{name}") for name in frames]
    )
    return rows.select(
        *keys,
        *[F.col(f"_row_{name}")[c].alias(shown[name][c]) for name in frames for c in own[name]],
        *[F.col(f"_row_{name}").isNotNull().alias(f"in_{name}") for name in frames],
    )
