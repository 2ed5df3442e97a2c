"""Helpers shared by the operators: shipping the code to executors, row keys, the
hold-out rule and connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orebridge.session import reliable_checkpoint

# White space that separates words: space and the controls 0x09-0x0D.
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"


def ship_code(spark: SparkSession) -> None:
    """Give Python workers this package, wherever the driver imported it from. The zip is
    served by Spark's own file distribution, once per SparkContext."""
    import orebridge
    sc = spark.sparkContext
    if getattr(sc, "_orebridge_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(orebridge.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="orebridge-code-"), "orebridge.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("orebridge", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._orebridge_shipped = True


def whole_text(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def text_hash(text: str = "text") -> Column:
    """Tells rows with the same doc_id apart; equal rows share every result anyway."""
    return F.xxhash64(whole_text(text))


def same_row(left: str, right: str, keys: tuple[str, ...]) -> Column:
    """Null-safe equality of the row key between two aliased frames."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


def held_out(id_col: str = "doc_id") -> Column:
    """True where crc32(doc_id as text) mod 4 is 2; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def learnable(id_col: str = "doc_id") -> Column:
    """Rows labels may be learned from: the remainder is known and not 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 != 2, F.lit(False))


def bounded_sample(df: DataFrame, max_rows: int, *hash_cols: str) -> DataFrame:
    """About `max_rows` rows chosen by a stable hash (all rows when there are fewer)."""
    total = df.count()
    if total <= max_rows:
        return df
    cut = int(max_rows / total * (1 << 32))
    return df.where(F.pmod(F.xxhash64(*[F.col(c) for c in hash_cols]), F.lit(1 << 32)) < cut)


def hint_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint for an already materialised frame of narrow rows, behind a count of
    all its rows; a larger one is left to a shuffle join."""
    return F.broadcast(df) if df.count() <= max_rows else df


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of `edges` (columns u, v of one orderable type), root =
    the smallest node reachable. Alternating large-star and small-star rounds: each joins
    edges with per-node minima (partial aggregation), so no neighbour list is collected;
    each round is checkpointed to the shared folder."""
    def star(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")) \
                .where("u <> v").distinct()

    cur, seen = reliable_checkpoint(star(edges)), None
    for _ in range(max_rounds):
        sign = cur.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen is not None and tuple(sign) == tuple(seen):
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = sign
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = star(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        cur = reliable_checkpoint(star(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
