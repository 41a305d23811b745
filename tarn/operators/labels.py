"""Label unification: native values to unified ids, failing loudly on what no table declares.

Guards are separate frames of violations (`unmapped`, ...), raised on by `raise_if_any`; hot projections carry no raise that the optimiser could prune or reorder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.model import CLASS_ID, CLASSES, IGNORE, IGNORE_COLOUR, SchemaError


def raise_if_any(violations: DataFrame, message: str, show: int = 20) -> None:
    """Raise if the frame has a row; the message lists a few."""
    found = violations.limit(show).collect()
    if found:
        raise SchemaError(f"{message}: {[r.asDict() for r in found]}")


def pack_rgb(red: Column, green: Column, blue: Column) -> Column:
    return F.shiftleft(red.cast("int"), 16) + F.shiftleft(green.cast("int"), 8) + blue.cast("int")


def index_key(value: Column) -> Column:
    """A native index as its key in the label map; fractional and non-finite values get none and so are unmapped."""
    whole = value.cast("double")
    return F.when(~F.isnan(whole) & (F.floor(whole) == whole), whole.cast("long").cast("string"))


def normalise_object_label(label: Column) -> Column:
    return F.translate(F.lower(F.trim(label)), " -", "__")


def remap(df: DataFrame, kind: str, native: Column, mapping: DataFrame, source: str = "source") -> DataFrame:
    """df with `unified` (null where the source declares no such value). The map has a row for each declared value of a few sources: it is broadcast."""
    table = F.broadcast(mapping.filter(F.col("kind") == kind).select(F.col("source").alias("_of"), F.col("native").alias("_native"), "unified"))
    return df.join(table, (F.col(source) == F.col("_of")) & (native == F.col("_native")), "left").drop("_of", "_native")


def unmapped(df: DataFrame, kind: str, native: Column, mapping: DataFrame, source: str = "source") -> DataFrame:
    """Histogram of undeclared values: (source, value, n), commonest first when shown; keys read `index:v`, `rgb:r,g,b` or `object:label`."""
    key = F.concat_ws(",", F.shiftright(native.cast("int"), 16), F.shiftright(native.cast("int"), 8).bitwiseAND(255), native.cast("int").bitwiseAND(255)) if kind == "rgb" else native
    missed = remap(df.withColumn("_key", key), kind, native, mapping, source).filter("unified is null")
    return missed.groupBy(F.col(source).alias("source"), F.concat(F.lit(f"{kind}:"), F.coalesce("_key", F.lit("null"))).alias("value")).agg(F.count("*").alias("n"))


def clamp_expressible(label: Column, expressible: Column) -> Column:
    """Labels that the source can't express become IGNORE."""
    return F.when(F.array_contains(expressible, label.cast("int")) | (label == IGNORE), label).otherwise(F.lit(IGNORE)).cast("smallint")


def background(policy: Column) -> Column:
    return F.when(policy == "ignore", IGNORE).otherwise(0).cast("smallint")


def normalise_255(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Binary masks whose positives are stored as 255: a mask with values in {0, 255} and a 255 becomes {0, 1}."""
    facts = df.groupBy(*keys).agg(F.size(F.array_except(F.collect_set(value), F.array(F.lit(0), F.lit(IGNORE)).cast("array<int>"))).alias("_others"), F.max(value).alias("_top"))
    joined = df.join(facts, keys)
    scaled = F.when((F.col("_others") == 0) & (F.col("_top") == IGNORE), (F.col(value) > 0).cast("int")).otherwise(F.col(value))
    return joined.withColumn(value, scaled).drop("_others", "_top")


def class_counts(label: Column) -> list[Column]:
    """One aggregate for each class and for ignore, zeros included, and one for ids outside the vocabulary."""
    known = [*((n, k) for n, k in CLASS_ID.items()), ("ignore", IGNORE)]
    return [F.count_if(label == k).alias(f"n_px_{n}") for n, k in known] + [F.count_if(label.isNull() | ~label.isin([k for _, k in known])).alias("n_px_unknown")]


def uncertain_label(annotated: Column) -> Column:
    """A label that may be missing: not annotated is IGNORE, not negative."""
    return F.coalesce(annotated.cast("int"), F.lit(IGNORE))


def colourise(label: Column) -> Column:
    """The colour of a label; ids outside the vocabulary have none."""
    out = F.when(label == IGNORE, F.array(*map(F.lit, IGNORE_COLOUR)))
    for k, _, colour, _ in CLASSES:
        out = out.when(label == k, F.array(*map(F.lit, colour)))
    return out
