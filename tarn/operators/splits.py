"""Leak-checked train, validation and test splits by hash of a group key: row-local, so stable under appends and valid in streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.functions.geometry import cell
from tarn.functions.hashing import FRACTIONS
from tarn.model import SplitConfig
from tarn.operators.labels import raise_if_any


def group_key(config: SplitConfig) -> Column:
    """The key that must not straddle splits; cross_source assigns (and is verified) by scene."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    if config.strategy == "spatial":
        return cell(F.col("lon"), F.col("lat"), config.cell_degrees)
    if config.strategy == "random":
        return F.col("tile_id")
    return F.concat_ws("|", text("source"), text("sample_id"))


def fraction(config: SplitConfig, hash_mode: str = "md5") -> Column:
    return FRACTIONS[hash_mode](F.concat_ws(":", F.lit(str(config.seed)), group_key(config)))


def violations(manifest: DataFrame, config: SplitConfig) -> DataFrame:
    """(problem): what makes the strategy impossible on this manifest."""
    if config.strategy == "spatial":
        facts = manifest.agg(F.count("*").alias("n"), F.count("lon").alias("known"))
        return facts.filter("known < n").select(F.when(F.col("known") == 0, "no tile has a position").otherwise("some tiles have no lon").alias("problem"))
    if config.strategy == "cross_source":
        asked = manifest.sparkSession.createDataFrame([(s,) for s in config.test_sources], "source string")
        return asked.join(manifest.select("source").distinct(), "source", "left_anti").select(F.concat(F.lit("unknown test source "), "source").alias("problem"))
    return manifest.sparkSession.createDataFrame([], "problem string")


def assign(manifest: DataFrame, config: SplitConfig, hash_mode: str = "md5", check: bool = False) -> DataFrame:
    """manifest with `split` filled. Shares are right-closed; cross_source compares strictly and sends held-out sources to test."""
    if check:
        raise_if_any(violations(manifest, config), "this split is impossible")
    f = fraction(config, hash_mode)
    if config.strategy == "cross_source":
        inner = F.when(f < config.train / (config.train + config.val), "train").otherwise("val")
        out = F.when(F.col("source").isin(*config.test_sources), "test").otherwise(inner)
    else:
        out = F.when(f <= config.train, "train").when(f <= config.train + config.val, "val").otherwise("test")
    return manifest.withColumn("split", out)


def leaked_groups(manifest: DataFrame, config: SplitConfig, limit: int = 20) -> DataFrame:
    """The first groups, in order, that have tiles in several splits; for cross_source also held-out sources outside test."""
    groups = manifest.groupBy(group_key(config).alias("group_key")).agg(F.countDistinct("split").alias("n_splits"))
    found = groups.filter("n_splits > 1")
    if config.strategy == "cross_source":
        stray = manifest.filter(F.col("source").isin(*config.test_sources) & (F.col("split") != "test")).select(F.concat(F.lit("held-out "), "source").alias("group_key"), F.lit(0).cast("long").alias("n_splits")).distinct()
        found = found.unionByName(stray)
    return found.orderBy("group_key").limit(limit)


def split_sizes(manifest: DataFrame) -> DataFrame:
    """Per split: tiles, scenes and oil pixels, and a warning where it has no oil."""
    sizes = manifest.groupBy("split").agg(F.count("*").alias("n_tiles"), F.countDistinct("sample_id").alias("n_scenes"), F.coalesce(F.sum("n_px_oil"), F.lit(0)).alias("n_px_oil"))
    return sizes.withColumn("no_oil", F.col("n_px_oil") == 0)
