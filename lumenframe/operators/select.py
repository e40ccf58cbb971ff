"""Declarative selection, weighting, splitting and normalization."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.operators.ranking import ranked

#: Names of the spec and the values of the records that they stand for.
ALIASES = {"mouse": "Mus musculus", "human": "Homo sapiens", "zebrafish": "Danio rerio", "drosophila": "Drosophila melanogaster", "SEM": "SBF-SEM", "lightsheet": "light-sheet"}


def compiled(where: Mapping[str, Any], fields: Mapping[str, str], aliases: Mapping[str, str] = ALIASES) -> Column:
    """One condition from filter objects: ``{"in": [...]}``, ``{"contains": x}``, ``{"range": [lo, hi]}``,
    ``{"min": x}`` or ``"any"``; an omitted field is any.

    ``fields`` maps each name of the spec to a column; an array column passes if one of its entries does.
    An unknown name or operator is an error. Plain comparisons reach the Parquet scan as pushed filters.
    """
    out = F.lit(True)
    for name, rule in where.items():
        if rule == "any" or rule is None:
            continue
        if name not in fields:
            raise ValueError(f"unknown field in where: {name}")
        column, _, kind = fields[name].partition(":")
        c = F.col(column)
        for key, value in rule.items():
            if key == "in":
                names = [aliases.get(v, v) if isinstance(v, str) else v for v in value]
                out = out & (F.arrays_overlap(c, F.array(*[F.lit(v) for v in names])) if kind == "array" else c.isin(names))
            elif key == "contains":
                v = aliases.get(value, value) if isinstance(value, str) else value
                out = out & (F.array_contains(c, v) if kind == "array" else F.contains(c, F.lit(v)))
            elif key == "range":
                out = out & c.between(value[0], value[1])
            elif key == "min":
                out = out & (c >= value)
            elif key == "allow_unknown":
                if not value:
                    out = out & c.isNotNull() & (c != "unknown")
            elif key == "required":
                if value:
                    out = out & (F.size(c) > 0 if kind == "array" else c.isNotNull())
            else:
                raise ValueError(f"unknown filter in where.{name}: {key}")
    return out


def glob_any(path: Column, globs: Sequence[str]) -> Column:
    """The path fits one of the globs; ``**`` crosses slashes, ``*`` and ``?`` don't; ``**/`` may stand for no folder."""
    import re

    out = F.lit(False)
    for g in globs:
        body = re.sub(r"(^|/)\\\*\\\*/", r"\1(?:.*/)?", re.escape(g))
        body = body.replace(r"\*\*", ".*").replace(r"\*", "[^/]*").replace(r"\?", "[^/]")
        out = out | path.rlike(f"^{body}$")
    return out


def keep_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """For each key in turn, the first row by ``order`` of each value stays; null keys match nothing.

    The first of a value is a grouped minimum; rows are kept by a semi join on it.
    """
    for key in keys:
        first = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias(order))
        named = df.where(F.col(key).isNotNull()).join(first, [key, order], "left_semi")
        df = named.unionByName(df.where(F.col(key).isNull()))
    return df


def weights(df: DataFrame, levels: Sequence[str], size: str, temperature: float) -> DataFrame:
    """(levels..., weight): at each level the share of n^T among its siblings, multiplied down the levels.

    T = 1 is in proportion to size, T = 0 uniform. Sizes are summed to one row for each combination first.
    """
    base = df.groupBy(*levels).agg(F.sum(size).alias("_n"))
    out, weight = base, F.lit(1.0)
    for k in range(len(levels)):
        here = list(levels[: k + 1])
        n = base.groupBy(*here).agg(F.sum("_n").alias(f"_n{k}")).withColumn(f"_p{k}", F.pow(F.col(f"_n{k}"), F.lit(float(temperature))))
        if k:
            total = n.groupBy(*here[:-1]).agg(F.sum(f"_p{k}").alias(f"_t{k}"))
            n = n.join(total, here[:-1])
        else:
            one = n.agg(F.sum("_p0").alias("_t0")).withColumn("_one", F.lit(1))
            n = n.withColumn("_one", F.lit(1)).join(F.broadcast(one), "_one").drop("_one")
        out = out.join(n.select(*here, f"_p{k}", f"_t{k}"), here)
        weight = weight * F.col(f"_p{k}") / F.col(f"_t{k}")
    return out.select(*levels, weight.alias("weight"))


def split(df: DataFrame, id_col: str, strata: Sequence[str], order: Column, fractions: Mapping[str, float], holdout: Column | None = None) -> DataFrame:
    """Adds ``split``: within each stratum the rows in a fixed pseudo-random order, cut by the fractions.

    ``order`` should be a number, a hash of the id and a seed; equal values are ordered by id.
    """
    share = F.col("rank") / F.col("total")
    out, reach = None, 0.0
    names = list(fractions)
    for name in names[:-1]:
        reach += fractions[name]
        hit = share < F.lit(round(reach, 9))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    split_name = out.otherwise(names[-1]) if out is not None else F.lit(names[-1])
    placed = lambda rows: ranked(rows, order, id_col, strata).withColumn("split", split_name).drop("rank", "total")
    if holdout is not None:
        held = F.coalesce(holdout, F.lit(False))
        return placed(df.where(~held)).unionByName(df.where(held).withColumn("split", F.lit("holdout")))
    return placed(df)


def normalized(vox: DataFrame, scope: str, method: str, low: float = 1, high: float = 99, clip: bool = True) -> DataFrame:
    """``v`` by percentile, zscore or minmax over each value of ``scope``; the statistics are one aggregate."""
    if method == "percentile":
        s = vox.groupBy(scope).agg(F.percentile("v", F.array(F.lit(low / 100), F.lit(high / 100))).alias("p")).select(scope, F.col("p")[0].alias("_a"), (F.col("p")[1] - F.col("p")[0]).alias("_b"))
    elif method == "zscore":
        s = vox.groupBy(scope).agg(F.avg("v").alias("_a"), F.stddev_pop("v").alias("_b"))
    elif method == "minmax":
        s = vox.groupBy(scope).agg(F.min("v").alias("_a"), (F.max("v") - F.min("v")).alias("_b"))
    elif method == "none":
        return vox
    else:
        raise ValueError(f"unknown method: {method}")
    out = F.coalesce(F.try_divide(F.col("v") - F.col("_a"), F.col("_b")), F.lit(0.0))
    if clip and method != "zscore":
        out = F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0))
    return vox.join(s, scope).withColumn("v", out).drop("_a", "_b")


def patches(df: DataFrame, id_col: str, shape: Mapping[str, Column], patch: Mapping[str, int]) -> DataFrame:
    """(id, axis starts): a grid of patches of each volume; an axis shorter than the patch has one at 0."""
    out = df
    for axis, size in patch.items():
        last = F.greatest(F.ceil(shape[axis] / F.lit(size)).cast("int") - 1, F.lit(0))
        out = out.withColumn(f"{axis}0", F.explode(F.transform(F.sequence(F.lit(0), last), lambda k: k * size)))  # noqa: B023
    return out.select(id_col, *[f"{a}0" for a in patch])
