"""Join helpers: null-safe key joins, broadcasts behind a checked size, and a salted
shuffle join for per-key tables too large to broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from orebridge.session import reliable_checkpoint

# Largest lookup side (rows and bytes) that may be broadcast; beyond it the join shuffles.
DEFAULT_MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20


def all_of(conditions):
    conditions = list(conditions)
    return reduce(lambda a, b: a & b, conditions) if conditions else F.lit(True)


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
            null_safe: bool = False) -> DataFrame:
    """Equi-join on same-named keys; with `null_safe`, NULL keys match each other.

    The right side's keys are renamed first, so the join stays unambiguous even when
    both sides come from the same scan; the output keeps the left side's keys.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("join_on needs at least one key")
    if not null_safe:
        return left.join(right, keys, how)
    tmp = {k: f"__right_{k}" for k in keys}
    renamed = right.withColumnsRenamed(tmp)
    lhs = left.alias("__left")
    cond = all_of(F.col(f"__left.{k}").eqNullSafe(F.col(tmp[k])) for k in keys)
    return lhs.join(renamed, cond, how).drop(*tmp.values())


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS):
    """Hint a broadcast of `df` only when it has at most `max_rows` rows and
    MAX_BROADCAST_BYTES bytes as text; else leave it to a shuffle join. Returns
    (frame, bounded?); the frame is a reliable checkpoint either way, measured by an
    aggregation, so nothing is computed twice and no row passes through the driver.
    """
    staged = reliable_checkpoint(df)
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in staged.columns), F.lit(0))
    size = staged.agg(F.count(F.lit(1)).alias("rows"),
                      F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("bytes")).first()
    bounded = size["rows"] <= max_rows and size["bytes"] <= MAX_BROADCAST_BYTES
    return (F.broadcast(staged) if bounded else staged), bounded


# Salt buckets for shuffle joins against a per-key table too large to broadcast.
DEFAULT_SALT_BUCKETS = 32


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "left",
                buckets: int = DEFAULT_SALT_BUCKETS, null_safe: bool = False) -> DataFrame:
    """Join `big` to `small` (at most one row per key) when `small` is too large to
    broadcast and a key of `big` may be hot.

    Rows of `big` get a salt from a hash of all their columns (stable across reruns);
    `small` is repeated once per salt value, so one hot key is spread over `buckets`
    tasks. `small` grows by the factor `buckets`, not with the skew. With `null_safe`,
    NULL keys match each other.
    """
    if how not in ("left", "inner"):
        raise ValueError("salted_join supports left and inner joins")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(buckets))
    salted_small = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return join_on(big.withColumn("__salt", salt.cast("int")), salted_small, [*keys, "__salt"], how,
                   null_safe).drop("__salt")


def attach(big: DataFrame, small: DataFrame, keys: list[str], how: str = "left", null_safe: bool = False,
           max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Join `big` to `small` (at most one row per key) without moving `big` where `small` is
    small enough to broadcast (checked), else by a salted shuffle join."""
    table, bounded = broadcast_if_bounded(small, max_rows)
    return (join_on(big, table, keys, how, null_safe) if bounded
            else salted_join(big, table, keys, how, null_safe=null_safe))


# Bits of the membership bitmap (8 MB) and the share of set bits beyond which it is not used.
DEFAULT_FILTER_BITS = 1 << 26
MAX_FILTER_FILL = 0.5
_WORD_BITS = 1 << 15                       # bits of one bitmap row, as bitmap_construct_agg makes them


def semi_reduce(big: DataFrame, keys: DataFrame, key: str, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                filter_bits: int = DEFAULT_FILTER_BITS) -> DataFrame:
    """Drop rows of `big` whose `key` cannot be in `keys`, before they are shuffled.

    Up to `max_rows` distinct keys (checked): an exact broadcast semi-join. Beyond that a
    bitmap of hashed keys, of a fixed size whatever the data, is broadcast and tested: rows
    with a key stay, some without one stay too, so a join on `key` must follow. A bitmap
    more than half full would let most rows pass; then `big` is returned as it is.
    """
    wanted = keys.select(key).where(F.col(key).isNotNull()).distinct()
    table, bounded = broadcast_if_bounded(wanted, max_rows)
    if bounded:
        return big.join(table, key, "left_semi")

    def place(col):
        return F.pmod(F.xxhash64(col.cast("string")), F.lit(filter_bits))
    spot = place(F.col(key))
    words = reliable_checkpoint(
        table.select(spot.alias("spot"))
        .groupBy(F.shiftright("spot", 15).alias("__word"))
        .agg(F.bitmap_construct_agg(F.col("spot") % _WORD_BITS).alias("__bits")))
    filled = words.agg(F.coalesce(F.sum(F.bitmap_count("__bits")), F.lit(0))).first()[0]
    if filled > MAX_FILTER_FILL * filter_bits:
        return big
    bit = spot % _WORD_BITS
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.shiftright(bit, 3) + 1).cast("int"), 1)), 16, 10).cast("int")
    seen = F.getbit(byte, (bit % 8).cast("int")) == 1
    # at most filter_bits / 32768 rows of 4 KB: bounded by construction
    return (big.withColumn("__word", F.shiftright(spot, 15)).join(F.broadcast(words), "__word", "inner")
            .where(seen).select(*big.columns))
