"""Readiness of records for download, over records made from ``part``."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions import readiness as rd
from lumenframe.plans import query, table

_HOSTS = ["example.com", "other.org"]
_SOME = "list_filter([{}], lambda x: x IS NOT NULL)"


def _family(of: str) -> str:
    known = " ".join(f"WHEN m IN ({', '.join(repr(x) for x in names)}) THEN '{f}'" for f, names in rd.FAMILIES.items())
    found = f"list_distinct(list_filter(list_transform({of}, lambda m: CASE {known} END), lambda f: f IS NOT NULL))"
    return f"CASE WHEN len({found}) = 1 THEN {found}[1] END"


_RECORDS = f"""r AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN 'registration' ELSE 'open' END AS access,
 CASE WHEN p_partkey % 7 = 0 THEN '2D' WHEN p_partkey % 7 = 1 THEN '3D+t' WHEN p_partkey % 13 > 0 THEN '3D' END AS dim, p_size % 4 AS vx, CASE WHEN p_partkey % 6 > 0 THEN 2 END AS vz,
 CASE WHEN p_partkey % 17 = 0 THEN 0 WHEN p_partkey % 9 = 0 THEN 0 WHEN p_partkey % 4 = 0 THEN 2 ELSE 1 END AS organisms,
 CASE p_partkey % 8 WHEN 0 THEN ['FIB-SEM'] WHEN 1 THEN ['confocal', 'TEM'] WHEN 2 THEN ['X-ray'] WHEN 3 THEN ['odd', 'expansion'] WHEN 4 THEN ['odd'] WHEN 5 THEN ['odd', 'TEM', 'confocal'] ELSE []::VARCHAR[] END AS ms,
 p_partkey % 3 AS arrays, CASE WHEN p_partkey % 10 = 0 THEN [] WHEN p_partkey % 10 = 1 THEN ['HTTPS://www.example.com/a', 'gopher://x/y'] WHEN p_partkey % 10 = 2 THEN ['S3://bucket/k'] ELSE ['http://u@' || lower(p_type) || '.org:80/z', 'ftp://other.org/q'] END AS urls,
 p_partkey % 2 = 1 AS annotated, CASE WHEN p_partkey % 12 > 0 THEN CASE WHEN p_partkey % 12 < 4 THEN ['no raw array'] WHEN p_partkey % 12 = 5 THEN ['note: few slices'] ELSE []::VARCHAR[] END END AS planned,
 CASE WHEN p_partkey % 16 > 0 THEN p_size::BIGINT * 2000000000 END AS size, p_partkey % 3 = 0 AS listed FROM part),
f AS (SELECT *, coalesce({_family('ms[1:1]')}, {_family('ms')}) AS family, vx > 0 AND vz IS NOT NULL AS voxel FROM r),
c AS (SELECT *, {_SOME.format("CASE WHEN access IS DISTINCT FROM 'open' THEN 'access ' || coalesce(access, 'unknown') || ': only open data' END, CASE WHEN dim IS DISTINCT FROM '3D' THEN 'dimensionality ' || coalesce(dim, 'unknown') || ': only 3D' END, CASE WHEN NOT voxel THEN 'voxel size needs x, y and z' END, CASE WHEN organisms <> 1 THEN organisms || ' organisms: one for each dataset' END, CASE WHEN family IS NULL THEN 'modality family unclear: ' || array_to_string(ms, ', ') END")} AS common, {_SOME.format("CASE WHEN arrays = 2 THEN 'array roles mesh: only raw and label' END, CASE WHEN arrays = 1 THEN 'label alignment offset: not on the raw grid' END")} AS of_arrays FROM f)"""


def _records(spark, sf):
    k = F.col("p_partkey")
    texts = lambda *x: F.array(*[F.lit(v) for v in x]).cast("array<string>")
    array = lambda role, form, place: F.struct(F.lit(role).alias("role"), F.lit(form).alias("format"), F.lit(place).cast("string").alias("alignment"))
    modality = F.when(k % 8 == 0, texts("FIB-SEM"))
    for rest, names in ((1, ("confocal", "TEM")), (2, ("X-ray",)), (3, ("odd", "expansion")), (4, ("odd",)), (5, ("odd", "TEM", "confocal"))):
        modality = modality.when(k % 8 == rest, texts(*names))
    arrays = F.when(k % 3 == 0, F.array(array("raw", "tiff", None))).when(k % 3 == 1, F.array(array("raw", "zarr", None), array("label", "hdf5", "offset")))
    urls = F.when(k % 10 == 1, texts("HTTPS://www.example.com/a", "gopher://x/y")).when(k % 10 == 2, texts("S3://bucket/k"))
    other = F.array(F.concat(F.lit("http://u@"), F.lower("p_type"), F.lit(".org:80/z")), F.lit("ftp://other.org/q"))
    record = F.struct(
        F.when(k % 11 == 0, None).when(k % 5 == 0, "registration").otherwise("open").alias("access"),
        F.when(k % 7 == 0, "2D").when(k % 7 == 1, "3D+t").when(k % 13 > 0, "3D").alias("dimensionality"),
        F.struct((F.col("p_size") % 4).alias("x"), F.lit(1).alias("y"), F.when(k % 6 > 0, 2).alias("z")).alias("voxel"),
        F.when(k % 17 == 0, None).when(k % 9 == 0, texts()).when(k % 4 == 0, texts("a", "b")).otherwise(texts("a")).alias("organisms"),
        modality.otherwise(texts()).alias("modalities"),
        arrays.otherwise(F.array(array("raw", "ome-tiff", None), array("label", "nifti", "aligned"), array("mesh", "obj", None))).alias("arrays"),
        urls.when(k % 10 == 0, None).otherwise(other).alias("urls"),
        (k % 2 == 1).alias("annotated"),
    )
    planned = F.when(k % 12 == 0, None).when(k % 12 < 4, texts("no raw array")).when(k % 12 == 5, texts("note: few slices")).otherwise(texts())
    size = F.when(k % 16 > 0, F.col("p_size").cast("long") * 2_000_000_000)
    source = F.when(k % 3 == 0, "file-listing").otherwise("page")
    return table(spark, sf, "part").select(k, record.alias("r"), planned.alias("planned"), size.alias("size"), source.alias("source"))


@query(f"""WITH {_RECORDS}, n AS (SELECT *, list_concat(list_concat(common, list_transform(list_filter(urls, lambda u: NOT (starts_with(lower(u), 's3://') OR (regexp_matches(lower(u), '^(https?|ftp)://') AND regexp_matches(lower(regexp_extract(u, '^[A-Za-z0-9]+://([^@/?#]*@)?([^:/?#]*)', 2)), '^(.*[.])?(example[.]com|other[.]org)$')))), lambda u: 'host not allowed: ' || u)), of_arrays) AS found FROM c)
SELECT k AS p_partkey, family, CASE WHEN coalesce(dim NOT IN ('3D', '3D+t'), true) OR len(found) > 0 THEN 'not-ready' WHEN planned IS NULL THEN 'unknown' WHEN len(planned) > 0 AND NOT starts_with(planned[1], 'note:') THEN 'not-ready' ELSE 'ready' END AS status,
 array_to_string(CASE WHEN coalesce(dim NOT IN ('3D', '3D+t'), true) THEN found WHEN planned IS NULL THEN list_concat(found, ['planner not available']) ELSE list_concat(found, planned) END, '; ') AS reasons,
 coalesce(size < 50000000000 AND listed, false) AS whole FROM n""")
def readiness(spark, sf):
    """Status and all reasons of a record, its modality family, and whether it may be downloaded whole."""
    r = _records(spark, sf).withColumn("found", rd.readiness_reasons(F.col("r"), _HOSTS))
    status, every = rd.readiness(F.col("r"), F.col("found"), F.col("planned"))
    return r.select(
        "p_partkey",
        rd.modality_family(F.col("r.modalities")).alias("family"),
        status.alias("status"),
        F.array_join(every, "; ").alias("reasons"),
        rd.whole_download_ok(F.col("size"), F.col("source")).alias("whole"),
    )


@query(f"""WITH {_RECORDS} SELECT k AS p_partkey, array_to_string(list_concat(list_concat(common, {_SOME.format("CASE WHEN NOT annotated THEN 'no annotations' END, CASE WHEN len(urls) = 0 THEN 'no sample URLs' END, CASE WHEN arrays = 0 THEN 'no label array' END, CASE WHEN arrays = 2 THEN of_arrays[1] END, CASE WHEN arrays = 1 THEN 'formats zarr: no native reader' END, CASE WHEN arrays = 1 THEN of_arrays[1] END")}),
 list_transform(list_filter(urls, lambda u: NOT regexp_matches(u, '^(https?|ftp|s3)://')), lambda u: 'not http(s), ftp or s3: ' || u)), '; ') AS reasons FROM c""")
def native_reasons(spark, sf):
    """Why the native readers can't take a record."""
    return _records(spark, sf).select("p_partkey", F.array_join(rd.native_reasons(F.col("r")), "; ").alias("reasons"))


@query("""WITH s AS (SELECT event_id, CASE event_type WHEN 'view' THEN NULL WHEN 'error' THEN 'fail' WHEN 'click' THEN 'unverified' ELSE 'pass' END AS overall,
 CASE WHEN event_id % 2 = 0 THEN ['alignment: flat', 'range: open'] ELSE ['alignment: flat'] END AS open, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'fail' ELSE 'pass' END AS review, CASE WHEN event_id % 7 > 0 THEN event_id % 3 > 0 END AS same FROM events),
r AS (SELECT *, CASE WHEN overall IS NULL THEN 'not checked yet' WHEN overall = 'fail' THEN 'a check failed' WHEN overall = 'unverified' AND len(open) = 2 THEN 'checks are still open'
 WHEN review IS NULL THEN 'nobody has looked at the images' WHEN review <> 'pass' THEN 'review of the images: ' || review WHEN NOT coalesce(same, false) THEN 'images are newer than their review' END AS reason FROM s)
SELECT event_id, reason IS NULL AS ok, coalesce(reason, CASE WHEN overall = 'pass' THEN 'pass' ELSE 'only the alignment is open, the images were passed' END) AS reason FROM r""")
def crop_status(spark, sf):
    """Crops (an event each) by verification and visual review."""
    k, t = F.col("event_id"), F.col("event_type")
    overall = F.when(t == "view", None).when(t == "error", "fail").when(t == "click", "unverified").otherwise("pass")
    open_ = F.when(k % 2 == 0, F.array(F.lit("alignment: flat"), F.lit("range: open"))).otherwise(F.array(F.lit("alignment: flat")))
    review = F.when(k % 5 == 0, None).when(k % 5 == 1, "fail").otherwise("pass")
    ok, reason = rd.crop_status(overall, open_, review, F.when(k % 7 > 0, k % 3 > 0))
    return table(spark, sf, "events").select("event_id", ok.alias("ok"), reason.alias("reason"))
