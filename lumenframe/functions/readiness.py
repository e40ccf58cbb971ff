"""Whether a record can be downloaded and cut into crops, and why not: expressions over its fields.

Each ``*_reasons`` gives an array of texts, empty if nothing is in the way; all are plain column
expressions, so a catalog is judged in one scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenframe.functions.rules import blocking, reasons
from lumenframe.functions.text import host_in

#: The families of imaging modalities and their members.
FAMILIES = {
    "em": ("FIB-SEM", "SBF-SEM", "ssTEM", "ssSEM", "TEM", "cryo-EM", "cryo-ET"),
    "lm": (
        "confocal", "spinning-disk", "widefield", "light-sheet", "two-photon", "super-resolution", "brightfield",
        "histology-WSI", "phase-contrast", "DIC", "fluorescence-other",
    ),
    "xray": ("X-ray",),
    "exm": ("expansion",),
}
#: Formats with native readers, alignments that take labels off the grid, trusted sources of a size.
NATIVE_FORMATS = ("tiff", "ome-tiff", "hdf5", "mrc", "nifti")
OFF_GRID = ("offset", "cropped", "scaled", "transform-provided")
CONFIRMED_SIZES = ("file-listing",)
WHOLE_DOWNLOAD_LIMIT = 50 * 10**9


def modality_family(modalities: Column) -> Column:
    """The family of the first modality, else the only one of all of them; null if that is unclear."""
    of = F.create_map(*[F.lit(x) for family, members in FAMILIES.items() for m in members for x in (m, family)])

    def only(names: Column) -> Column:
        found = F.array_distinct(F.filter(F.transform(names, lambda m: F.try_element_at(of, m)), lambda f: f.isNotNull()))
        return F.when(F.size(found) == 1, F.get(found, F.lit(0)))

    return F.coalesce(only(F.slice(modalities, 1, 1)), only(modalities))


def voxel_size_found(voxel: Column, dimensionality: Column | None = None) -> Column:
    """The voxel size (struct x, y, z) has x, y and, unless the data are flat, z; zero is not stated."""
    some = lambda c: F.coalesce(c != 0, F.lit(False))
    flat = F.lit(False) if dimensionality is None else F.coalesce(F.startswith(dimensionality, F.lit("2D")), F.lit(False))
    return some(voxel["x"]) & some(voxel["y"]) & (some(voxel["z"]) | flat)


def whole_download_ok(size: Column, source: Column, confirmed: Sequence[str] = CONFIRMED_SIZES, limit: int = WHOLE_DOWNLOAD_LIMIT) -> Column:
    """The size is known from a complete listing and under the limit."""
    return F.coalesce((size < limit) & source.isin(*confirmed), F.lit(False))


def _listed(values: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(values)), ", ", "unknown")


def _labels(arrays: Column) -> Column:
    return F.filter(arrays, lambda a: a["role"] == "label")


def _common(record: Column) -> tuple[list[tuple[Column, Column | str]], list[tuple[Column, Column | str]]]:
    """The reasons that both ways of download share, of a struct ``record``: access, dimensionality, voxel,
    organisms, modalities, arrays (role, format, alignment), urls, annotated. First those of the record, then those of its arrays."""
    organisms = F.coalesce(F.size(record["organisms"]), F.lit(0))
    roles = F.filter(F.transform(record["arrays"], lambda a: a["role"]), lambda x: ~F.coalesce(x.isin("raw", "label"), F.lit(False)))
    off = F.filter(F.transform(_labels(record["arrays"]), lambda a: a["alignment"]), lambda x: x.isin(*OFF_GRID))
    text = lambda c: F.coalesce(c, F.lit("unknown"))
    return [
        (~record["access"].eqNullSafe(F.lit("open")), F.concat(F.lit("access "), text(record["access"]), F.lit(": only open data"))),
        (~record["dimensionality"].eqNullSafe(F.lit("3D")), F.concat(F.lit("dimensionality "), text(record["dimensionality"]), F.lit(": only 3D"))),
        (~voxel_size_found(record["voxel"]), "voxel size needs x, y and z"),
        (organisms != 1, F.concat(organisms.cast("string"), F.lit(" organisms: one for each dataset"))),
        (modality_family(record["modalities"]).isNull(), F.concat(F.lit("modality family unclear: "), F.array_join(record["modalities"], ", "))),
    ], [
        (F.size(roles) > 0, F.concat(F.lit("array roles "), _listed(roles), F.lit(": only raw and label"))),
        (F.size(off) > 0, F.concat(F.lit("label alignment "), _listed(off), F.lit(": not on the raw grid"))),
    ]


def readiness_reasons(record: Column, hosts: Sequence[str]) -> Column:
    """Why a record is not ready: what is against the record, each sample URL whose host isn't allowed, and what is against its arrays."""
    host = lambda u: F.lower(F.regexp_extract(u, r"^[A-Za-z0-9]+://(?:[^@/?#]*@)?([^:/?#]*)", 1))
    barred = F.filter(record["urls"], lambda u: ~(u.rlike("^(?i)s3://") | (u.rlike("^(?i)(https?|ftp)://") & host_in(host(u), list(hosts)))))
    urls = F.transform(F.coalesce(barred, F.array().cast("array<string>")), lambda u: F.concat(F.lit("host not allowed: "), u))
    first, last = _common(record)
    return F.concat(reasons(*first), urls, reasons(*last))


def readiness(record: Column, found: Column, planned: Column) -> tuple[Column, Column]:
    """(status, reasons). ``found``: ``readiness_reasons``; ``planned``: the planner's reasons, null if there is no planner.

    Flat data are not ready whatever the planner says; without a planner a record is unknown at best. The planner's
    notes ("note:") are told and bar nothing.
    """
    volume = F.coalesce(record["dimensionality"].isin("3D", "3D+t"), F.lit(False))
    every = F.when(~volume, found).when(planned.isNull(), F.concat(found, F.array(F.lit("planner not available")))).otherwise(F.concat(found, planned))
    status = (
        F.when(~volume | (F.size(found) > 0), "not-ready").when(planned.isNull(), "unknown").when(F.size(blocking(planned)) > 0, "not-ready").otherwise("ready")
    )
    return status, every


def native_reasons(record: Column) -> Column:
    """Why the native readers can't take a record: the common reasons, and what they need besides."""
    taken = F.filter(record["arrays"], lambda a: a["role"].isin("raw", "label"))
    formats = F.filter(F.transform(taken, lambda a: a["format"]), lambda f: ~F.coalesce(f.isin(*NATIVE_FORMATS), F.lit(False)))
    odd = F.coalesce(F.filter(record["urls"], lambda u: ~u.rlike("^(https?|ftp|s3)://")), F.array().cast("array<string>"))
    first, (roles, alignment) = _common(record)
    found = reasons(
        *first,
        (~F.coalesce(record["annotated"], F.lit(False)), "no annotations"),
        (F.coalesce(F.size(record["urls"]), F.lit(0)) == 0, "no sample URLs"),
        (F.coalesce(F.size(_labels(record["arrays"])), F.lit(0)) == 0, "no label array"),
        roles,
        (F.size(formats) > 0, F.concat(F.lit("formats "), _listed(formats), F.lit(": no native reader"))),
        alignment,
    )
    return F.concat(found, F.transform(odd, lambda u: F.concat(F.lit("not http(s), ftp or s3: "), u)))


def crop_status(overall: Column, unverified: Column, review: Column, same_images: Column) -> tuple[Column, Column]:
    """(ok, reason) of a crop from its verification and its visual review, both null where there is none.

    Verified, or unverified on its alignment alone, and passed by a review of the images as they are now.
    """
    other = F.size(F.filter(unverified, lambda x: ~F.startswith(x, F.lit("alignment:")))) > 0
    reason = (
        F.when(overall.isNull(), "not checked yet")
        .when(overall == "fail", "a check failed")
        .when((overall == "unverified") & other, "checks are still open")
        .when(review.isNull(), "nobody has looked at the images")
        .when(review != "pass", F.concat(F.lit("review of the images: "), review))
        .when(~F.coalesce(same_images, F.lit(False)), "images are newer than their review")
    )
    fine = F.when(overall == "pass", "pass").otherwise("only the alignment is open, the images were passed")
    return reason.isNull(), F.coalesce(reason, fine)
