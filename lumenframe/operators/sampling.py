"""Resampling of voxel tables and seeded draws of patches, as expressions and one grouped sum.

``resampled`` pushes: a voxel knows by arithmetic which places of the new grid it bears on and by how much, so
there is no join with its neighbours and one shuffle, combined before it. ``patch_samples`` draws by
hashes of seed, epoch, array and number, so the rows are the same whatever the partitioning, and any task can draw any of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.operators.arrays import ZYX


def resampled_shape(shape: Sequence[int], voxel: Sequence[float], target: Sequence[float]) -> list[int]:
    """Lengths of the axes at another voxel size: rounded half up, at least 1."""
    return [max(1, int(n * e / t + 0.5)) for n, e, t in zip(shape, voxel, target, strict=True)]


def _targets(axis: Column, n: int, m: int, step: float, interp: str) -> Column:
    """array<struct<i, w>>: the places of the new axis on which a voxel bears, with its weight.

    Place i has its centre at (i + 1/2) step - 1/2 old voxels, kept inside the axis.
    """
    k = axis.cast("double")
    low = F.when(axis == 0, 0).otherwise(F.greatest(F.lit(0), F.floor((k - 0.5) / step - 0.5)))
    high = F.when(axis == n - 1, m - 1).otherwise(F.least(F.lit(m - 1), F.ceil((k + 1.5) / step - 0.5)))

    def weight(i: Column) -> Column:
        centre = F.least(F.greatest((i.cast("double") + 0.5) * step - 0.5, F.lit(0.0)), F.lit(float(n - 1)))
        if interp == "nearest":  # of two equally near voxels the later one
            return F.when(F.floor(centre + 0.5) == axis, 1.0).otherwise(0.0)
        return F.greatest(1.0 - F.abs(centre - k), F.lit(0.0))

    places = F.when(low <= high, F.sequence(low.cast("int"), high.cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.filter(F.transform(places, lambda i: F.struct(i.alias("i"), weight(i).alias("w"))), lambda e: e["w"] > 0)


def resampled(vox: DataFrame, shape: Sequence[int], voxel: Sequence[float], target: Sequence[float], kind: str = "image") -> DataFrame:
    """(crop, z, y, x, v) at the voxel size ``target``: images linear in each axis, labels by the nearest voxel.

    Defined results: beyond the outer voxels' centres their values hold on; a null value leaves the places that it bears
    on null; an axis whose size stays is copied.
    """
    interp = {"image": "linear", "label": "nearest"}[kind]
    out = vox.select("crop", *ZYX, "v")
    for axis, n, m, e, t in zip(ZYX, shape, resampled_shape(shape, voxel, target), voxel, target, strict=True):
        out = out.withColumn(f"_{axis}", F.explode(_targets(F.col(axis), n, m, t / e, interp)))
    place = [F.col(f"_{a}.i").alias(a) for a in ZYX]
    weight = F.col("_z.w") * F.col("_y.w") * F.col("_x.w")
    whole = out.groupBy("crop", *place).agg(F.sum(F.col("v") * weight).alias("_sum"), F.count_if(F.col("v").isNull()).alias("_null"), F.max("v").alias("_one"))
    value = F.col("_sum") if interp == "linear" else F.col("_one")
    return whole.select("crop", *ZYX, F.when(F.col("_null") == 0, value).alias("v"))


def unit_draw(*parts: Column) -> Column:
    """A number in [0, 1) from texts and numbers: 52 bits of a digest."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def patch_samples(arrays: DataFrame, samples: int, patch: int, factors: Sequence[int], seed: int, epoch: int = 0) -> DataFrame:
    """(id, sample, factor, level, x0, y0, z0, low, high): nested patches around one random place of each array.

    arrays: id, levels (array of struct<scale: x, y, z; translation: x, y, z; shape: x, y, z>, the finest
    first). The level of a factor is the one whose x scale is that many times the finest one's, rounded. The place is
    drawn so that the patch of the coarsest factor fits; patches of all factors have it in their middle, up to
    the edge. ``low`` and ``high`` are the centres of a patch's first and last voxel in nanometres (x, y).

    Defined results: an array that lacks a factor, or is smaller than the coarsest patch, has no rows; equal (seed, epoch, id)
    give equal rows.
    """
    finest = F.get("levels", F.lit(0))
    ratio = lambda lv: F.round(lv["scale"]["x"] / finest["scale"]["x"]).cast("int")
    chosen = F.transform(F.array(*[F.lit(f) for f in factors]), lambda f: F.get(F.filter(F.transform("levels", lambda lv, k: F.struct(ratio(lv).alias("f"), k.alias("k"))), lambda e: e["f"] == f), F.lit(0)))
    half = patch * max(factors) / 2
    fit = arrays.select("id", "levels", chosen.alias("chosen")).where(F.forall("chosen", lambda c: c.isNotNull()))
    fit = fit.where(F.least(finest["shape"]["x"], finest["shape"]["y"]) >= patch * max(factors))
    drawn = fit.withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))))
    u = lambda axis: unit_draw(F.lit(seed), F.lit(epoch), F.col("id"), F.col("sample"), F.lit(axis))
    centre = {a: F.lit(half) + u(a) * (finest["shape"][a] - 2 * half) for a in "xy"}
    depth = F.floor(u("z") * finest["shape"]["z"])
    drawn = drawn.select("id", "levels", "chosen", "sample", centre["x"].alias("cx"), centre["y"].alias("cy"), depth.alias("cz"), finest["scale"]["z"].alias("sz"))
    each = drawn.withColumn("c", F.explode("chosen")).withColumn("lv", F.get("levels", F.col("c.k")))
    first = lambda a: F.greatest(F.lit(0), F.least(F.bround(F.col(f"c{a}") / F.col("c.f") - patch / 2, 0).cast("int"), F.col(f"lv.shape.{a}") - patch)).cast("int")
    z0 = F.least(F.floor(F.col("cz") / (F.col("lv.scale.z") / F.col("sz"))), F.col("lv.shape.z") - 1).cast("int")
    out = each.select("id", "sample", F.col("c.f").alias("factor"), F.col("c.k").alias("level"), first("x").alias("x0"), first("y").alias("y0"), z0.alias("z0"), "lv")
    corner = lambda shift: F.array(*[(F.col(f"{a}0") + shift) * F.col(f"lv.scale.{a}") + F.col(f"lv.translation.{a}") for a in "xy"])
    return out.select("id", "sample", "factor", "level", "x0", "y0", "z0", corner(0).alias("low"), corner(patch - 1).alias("high"))
