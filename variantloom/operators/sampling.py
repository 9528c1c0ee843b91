"""Seeded sampling and splits. A row's draw is md5(seed|key), so a draw depends on the row alone and reruns agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.naming import BARCODE, LABEL, col
from ..functions.variant import classify_variant


def draw(seed: int, *keys: str | Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.coalesce((col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys)).cast("binary"))


def _ids(ids) -> list[str]:
    return [ids] if isinstance(ids, str) else list(ids)


def placed(df: DataFrame, by: str | list[str], own: Column, ids, place: str = "_place", size: str = "_size") -> DataFrame:
    """Each row's place in its group by draw and ids, and the group's size (null is a group of its own).

    A group may hold a third of all rows, so rows are numbered within parts of a group by the first digits of their draw; a
    part's place is the number of rows in the parts before it, of which a group has at most 4096."""
    keys, by = _ids(ids), _ids(by)
    group, part = F.struct(*(col(b).alias(f"g{i}") for i, b in enumerate(by))), F.substring(own, 1, 3)
    sizes = df.select(group.alias("_g"), part.alias("_p")).groupBy("_g", "_p").agg(F.count("*").alias("_n"))
    sizes = sizes.select("_g", "_p", (F.sum("_n").over(W.partitionBy("_g").orderBy("_p")) - F.col("_n")).alias("_before"), F.sum("_n").over(W.partitionBy("_g")).alias(size))
    rows = df.withColumns({"_g": group, "_p": part})
    rows = rows.withColumn("_in", F.row_number().over(W.partitionBy("_g", "_p").orderBy(own, *map(col, keys))))
    return rows.join(sizes, ["_g", "_p"]).withColumn(place, F.col("_before") + F.col("_in")).select(*map(col, df.columns), place, size)


def top_groups(counts: DataFrame, key: str, n: int, mode: str = "top", seed: int = 0, size: str = "n") -> DataFrame:
    """n keys: the largest (ties by key) or at random."""
    if mode not in ("top", "random"):
        raise ValueError(f"Unknown mode: {mode!r}; use 'top' or 'random'")
    order = [F.desc(size), F.asc(key)] if mode == "top" else [draw(seed, key).asc(), F.asc(key)]
    return counts.orderBy(*order).limit(n).select(key)


def select_variants(df: DataFrame, n: int | None, classes: list[str], mode: str = "top", seed: int = 0, label: str = LABEL) -> DataFrame:
    """n variants of the given classes; all of the other classes pass. Rows without a label are dropped."""
    if n is None:
        return df
    eligible = classify_variant(F.col(label)).isin(classes)
    chosen = top_groups(df.where(eligible).groupBy(label).agg(F.count("*").alias("n")), label, n, mode, seed)
    return df.where(~eligible).unionByName(df.where(eligible).join(chosen, label, "left_semi"))


def cap_groups(df: DataFrame, by: str, most: int | None, ids, seed: int = 0) -> DataFrame:
    """At most so many rows of each group."""
    if most is None:
        return df
    return placed(df, by, draw(seed, *_ids(ids)), ids).where(F.col("_place") <= most).drop("_place", "_size")


def pseudo_variants(df: DataFrame, amount: float | int, classes: list[str], ids, seed: int = 0, label: str = LABEL) -> DataFrame:
    """Part of each variant of these classes as a variant of its own, `:downsample-{amount}`. A fraction takes that share of a
    variant, rounded down; a whole number takes so many cells and skips smaller variants."""
    share = isinstance(amount, float)
    if isinstance(amount, bool) or (share and not 0 < amount <= 1) or (not share and amount < 1):
        raise ValueError(f"Bad amount: {amount!r}; use a fraction in (0, 1] or a positive whole number")
    rows = placed(df.where(classify_variant(F.col(label)).isin(classes)), label, draw(seed, *_ids(ids)), ids)
    rows = rows.where(F.col("_place") <= F.floor(F.col("_size") * amount)) if share else rows.where((F.col("_size") >= amount) & (F.col("_place") <= amount))
    return rows.withColumn(label, F.concat(label, F.lit(f":downsample-{amount}"))).drop("_size", "_place")


def with_pseudo_variants(df: DataFrame, amounts: list, classes: list[str], ids, seed: int = 0, label: str = LABEL) -> DataFrame:
    for extra in [pseudo_variants(df, a, classes, ids, seed, label) for a in amounts or []]:
        df = df.unionByName(extra)
    return df


def downsample(df: DataFrame, chosen: Column, target: float | int | None, ids, seed: int = 0) -> DataFrame:
    """Only some of the chosen rows (a share, rounded down, or at most so many); all others stay."""
    if target is None:
        return df
    if isinstance(target, bool) or target <= 0 or (isinstance(target, float) and target > 1):
        raise ValueError(f"Bad target: {target!r}; use a fraction in (0, 1] or a positive whole number")
    keys = _ids(ids)
    rows = df.where(chosen)
    n = int(rows.count() * target) if isinstance(target, float) else target
    kept = rows.select(*keys, draw(seed, *keys).alias("_draw")).orderBy("_draw", *keys).limit(n)
    return df.where(~F.coalesce(chosen, F.lit(False))).unionByName(rows.join(kept.select(*keys), keys, "left_semi"))


def to_largest_other(df: DataFrame, label: str, group: str, target: int | str | None, ids, seed: int = 0) -> DataFrame:
    """One group down to a number of rows, or to the size of the largest other group ('largest')."""
    if target == "largest":
        target = df.where(F.col(label) != group).groupBy(label).count().agg(F.max("count")).first()[0]
    return downsample(df, F.col(label) == group, target, ids, seed)


def drop_small_groups(df: DataFrame, by: str, least: int, exempt: str | None = None) -> DataFrame:
    """Rows of groups with enough rows. Null groups go."""
    keep = df.groupBy(by).agg(F.count("*").alias("_n")).where((F.col("_n") >= least) | F.col(by).eqNullSafe(F.lit(exempt)) if exempt is not None else F.col("_n") >= least)
    return df.join(keep.where(F.col(by).isNotNull()).select(by), by, "left_semi")


def stratified_split(df: DataFrame, by: str, shares: dict[str, float], ids, seed: int = 0, name: str = "split") -> DataFrame:
    """Each row's part: every stratum is dealt by these shares, up to rounding."""
    at = (F.col("_place") - 0.5) / F.col("_size")
    edge, expr = 0.0, None
    for part, share in list(shares.items())[:-1]:
        edge += share
        expr = F.when(F.col("_at") < edge, part) if expr is None else expr.when(F.col("_at") < edge, part)
    last = list(shares)[-1]
    return placed(df, by, draw(seed, *_ids(ids)), ids).withColumn("_at", at).withColumn(name, F.lit(last) if expr is None else expr.otherwise(last)).drop("_at", "_place", "_size")


def replicate_halves(df: DataFrame, seeds: list[int], ids, label: str = LABEL) -> DataFrame:
    """Every row once for each seed, with its half (1 or 2) of each label: all bootstrap replicates in one table."""
    keys = _ids(ids)
    rows = df.withColumn("seed", F.explode(F.array(*map(F.lit, seeds))))
    own = F.md5(F.concat_ws("|", F.col("seed").cast("string"), *(F.coalesce(col(k).cast("string"), F.lit("")) for k in keys)).cast("binary"))
    half = F.when((F.col("_place") - 0.5) / F.col("_size") < 0.5, 1).otherwise(2)
    return placed(rows, ["seed", label], own, keys).withColumn("half", half).drop("_place", "_size")


def exclude_barcodes(df: DataFrame, blocked: DataFrame, barcode: str = BARCODE) -> DataFrame:
    """Without the barcodes that aren't ok. As with SQL's NOT IN, rows without a barcode go too if the list has any."""
    bad = blocked.where(~F.col("barcode_ok")).select(F.col("barcode").alias(barcode)).where(F.col(barcode).isNotNull()).distinct()
    if bad.isEmpty():
        return df
    return df.where(F.col(barcode).isNotNull()).join(bad, barcode, "left_anti")
