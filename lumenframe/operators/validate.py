"""Catalog validation: the rules of one record, and those between records.

Records are JSON texts with their paths. ``record_faults`` gives what is wrong with one record, an expression
over its text; ``catalog_faults`` adds what only the whole catalog, the rejected keys or a run log can tell,
as one table of (path, severity, message). Rules between records are joins on identity keys; similar records
are the pairs of ``similar_records``.

Defined results: fields of another type than a rule needs count as missing (the schema tells of the type);
text that is no JSON has the schema's fault and no other; messages of a path are distinct.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.rules import reasons
from lumenframe.functions.schema import faults
from lumenframe.functions.text import url_normalize
from lumenframe.operators.keys import identity_keys, similar_records
from lumenframe.sources import storage

#: The fields that rules read.
FIELDS = (
    "id string, doi string, repository string, accession string, landing_url string, title string, "
    "publications array<struct<doi: string, url: string>>, imaging struct<dimensionality: string, modality: array<string>>, "
    "data struct<formats: array<string>, size_bytes: bigint, download_url: string>, "
    "provenance struct<evidence_urls: array<string>, confidence: double>, "
    "verification struct<url_ok: boolean, license_found: boolean, annotations_verified: boolean>, "
    "technical struct<method: string, size_source: string, layout: struct<listing_complete: boolean>, "
    "arrays: array<struct<path_pattern: string, value_range: array<double>>>>"
)
#: Hosts that count as the paper itself.
PAPER_HOSTS = (
    "doi.org", "europepmc.org", "ebi.ac.uk/europepmc", "ncbi.nlm.nih.gov", "biorxiv.org",
    "api.biorxiv.org", "medrxiv.org", "arxiv.org", "nature.com", "cell.com", "sciencedirect.com",
    "springer.com", "wiley.com", "elifesciences.org", "rupress.org", "plos.org", "frontiersin.org",
    "biomedcentral.com", "oup.com", "science.org", "pnas.org", "openreview.net", "thecvf.com",
    "mlr.press", "neurips.cc", "ieee.org", "acm.org", "embopress.org", "journals.biologists.com",
)
#: The most confidence a record may claim where a check has failed.
CONFIDENCE_CAPS = (("url_ok", 0.5), ("license_found", 0.7), ("annotations_verified", 0.85))
CONFIRMED_SIZES = ("file-listing",)


def _list(c: Column, kind: str = "array<string>") -> Column:
    return F.coalesce(c, F.array().cast(kind))


def canonical_path(r: Column, dimensionalities: list[str], modalities: list[str], root: str = "datasets") -> Column:
    """Where a record belongs: root / dimensionality / first modality / id; null while one of them is not known."""
    first = F.get(r["imaging"]["modality"], F.lit(0))
    known = r["imaging"]["dimensionality"].isin(dimensionalities) & first.isin(modalities) & (r["id"] != "")
    return F.when(known, F.concat_ws("/", F.lit(root), r["imaging"]["dimensionality"], first, F.concat(r["id"], F.lit(".yaml"))))


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1)


def record_rules(r: Column, path: Column, hosts=PAPER_HOSTS) -> Column:
    """What is wrong with a record (a struct of FIELDS) beyond its schema, in order."""
    links = F.filter(F.transform(_list(r["publications"], "array<struct<doi: string, url: string>>"), lambda p: F.coalesce(F.nullif(p["doi"], F.lit("")), p["url"])), lambda u: F.coalesce(u != "", F.lit(False)))
    wanted = F.concat(F.array(*[F.lit(h) for h in hosts]), F.transform(links, F.lower))
    read = F.exists(_list(r["provenance"]["evidence_urls"]), lambda u: F.coalesce(F.exists(wanted, lambda w: F.contains(F.lower(u), w)), F.lit(False)))
    formats = _list(r["data"]["formats"])
    t = r["technical"]
    arrays = _list(t["arrays"], "array<struct<path_pattern: string, value_range: array<double>>>")
    confirmed = F.coalesce(t["size_source"].isin(*CONFIRMED_SIZES), F.lit(False))
    ranged = F.filter(arrays, lambda a: a["value_range"].isNotNull())
    shown = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    fixed = reasons(
        (~F.coalesce(r["id"] == stem(path), F.lit(False)), F.concat(F.lit("id "), shown(r["id"]), F.lit(" is not the name of the file"))),
        ((F.size(links) > 0) & ~read, "a paper is named, but none of evidence_urls leads to one"),
        (F.array_contains(formats, "other") & (F.size(formats) > 1), "the format other stands alone or not at all"),
        (F.coalesce(t["method"].isin("header", "sample"), F.lit(False)) & (F.size(arrays) == 0), F.concat(F.lit("technical.method "), t["method"], F.lit(" needs arrays"))),
        (confirmed & r["data"]["size_bytes"].isNull(), "a size from the file listing is missing"),
        (confirmed & ~F.coalesce(t["layout"]["listing_complete"], F.lit(False)), "a size from the file listing needs a complete listing"),
    )
    values = F.transform(ranged, lambda a: F.concat(F.lit("value_range of "), shown(a["path_pattern"]), F.lit(" needs the method sample")))
    sampled = F.coalesce(t["method"] == "sample", F.lit(False)) | t.isNull()
    return F.concat(fixed, F.when(sampled, F.array().cast("array<string>")).otherwise(values))


def confidence_faults(r: Column, least: float | None = None, caps=CONFIDENCE_CAPS) -> Column:
    """Confidence over what failed checks leave, or under the least asked for."""
    value = r["provenance"]["confidence"]
    rules = [
        (F.coalesce(~r["verification"][flag] & (value > cap), F.lit(False)), F.concat(F.lit("confidence "), value.cast("string"), F.lit(f" is over {cap}: {flag} is false")))
        for flag, cap in caps
    ]
    if least is not None:
        rules.append((F.coalesce(value < least, F.lit(False)), F.concat(F.lit("confidence "), value.cast("string"), F.lit(f" is under {least}"))))
    return reasons(*rules)


def record_faults(json: str, path: Column, schema: dict[str, Any]) -> Column:
    """array<string>: the faults of a record by its schema ("path: message"), then by the rules."""
    by_schema = F.transform(faults(json, schema), lambda f: F.concat(f["path"], F.lit(": "), f["message"]))
    r = F.from_json(F.col(json), FIELDS)
    return F.concat(by_schema, F.when(_is_object(json), record_rules(r, path)).otherwise(F.array().cast("array<string>")))


def _is_object(json: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(json)).startswith("OBJECT"), F.lit(False))


def catalog_faults(
    records: DataFrame,
    schema: dict[str, Any],
    rejected: DataFrame | None = None,
    fetched: DataFrame | None = None,
    least: float | None = None,
    targets: DataFrame | None = None,
    root: str = "datasets",
    similar: bool = True,
) -> DataFrame:
    """(path, severity, message) of a catalog.

    records: (path, json), every record that counts for uniqueness; targets: (path) of those to be told of, all by
    default; rejected: (key), ids and identity keys; fetched: (url), what a run has read: then evidence must be there.
    """
    # parsed once: every rule between records reads what is kept
    parsed = storage.kept(records.select("path", "json", _is_object("json").alias("object"), F.from_json("json", FIELDS).alias("r")), "records")
    told = parsed if targets is None else parsed.join(targets.select("path").distinct(), "path", "left_semi")
    r = F.col("r")
    enums = schema["properties"]["imaging"]["properties"]
    want = canonical_path(r, enums["dimensionality"]["enum"], enums["modality"]["items"]["enum"], root)
    place = F.when(F.col("path").startswith(root + "/") & (F.col("path") != want), F.array(F.concat(F.lit("belongs at "), want)))
    none = F.array().cast("array<string>")
    own = F.concat(record_faults("json", F.col("path"), schema), F.when(F.col("object"), F.concat(F.coalesce(place, none), confidence_faults(r, least))).otherwise(none))
    out = told.select("path", F.explode(own).alias("message"))

    keys = identity_keys(r["doi"], r["repository"], r["accession"], r["landing_url"])
    keyed = parsed.where("object").select("path", keys.alias("keys"), r["id"].alias("id"))
    names = lambda df: df if targets is None else df.join(targets.select("path").distinct(), "path", "left_semi")
    if rejected is not None:
        claims = keyed.select("path", F.explode(F.concat(F.filter(F.array("id"), lambda i: i.isNotNull()), "keys")).alias("key")).distinct()
        barred = names(claims.join(rejected.select("key").distinct(), "key", "left_semi"))
        out = out.unionByName(barred.select("path", F.concat("key", F.lit(" was rejected")).alias("message")))
    if fetched is not None:
        cited = told.where("object").select("path", F.explode(r["provenance"]["evidence_urls"]).alias("url")).where("url IS NOT NULL").withColumn("page", url_normalize(F.col("url")))
        read = fetched.select(url_normalize(F.col("url")).alias("page")).distinct()
        unread = cited.join(read, "page", "left_anti")
        out = out.unionByName(unread.select("path", F.concat(F.lit("evidence was not read in this run: "), "url").alias("message")))
    # landing pages are shared by many datasets and prove nothing
    strong = keyed.select("path", F.explode(F.filter("keys", lambda k: ~k.startswith("url:"))).alias("key"))
    held = strong.groupBy("key").agg(F.min("path").alias("first"), F.max("path").alias("last"), F.count_distinct("path").alias("n")).where("n > 1")
    # each record is told of the first one with its key, the first of the last
    twice = names(strong.join(held, "key")).withColumn("other", F.when(F.col("path") == F.col("first"), F.col("last")).otherwise(F.col("first")))
    out = out.unionByName(twice.select("path", F.concat("key", F.lit(" is also in "), "other").alias("message")))
    out = out.distinct().select("path", F.lit("error").alias("severity"), "message")
    if similar:
        flat = parsed.where("object").select(
            F.col("path").alias("id"), r["data"]["download_url"].alias("download_url"), r["title"].alias("title"), r["repository"].alias("repository"),
            F.filter(keys, lambda k: ~k.startswith("url:")).alias("ids"),
            F.filter(F.transform(_list(r["publications"], "array<struct<doi: string, url: string>>"), lambda p: p["doi"]), lambda d: F.coalesce(d != "", F.lit(False))).alias("dois"),
        )
        pairs = similar_records(flat)
        text = F.concat(F.lit("may be the same as "), "other", F.lit(" ("), F.array_join("reasons", ", "), F.lit(")"))
        if targets is None:
            alike = pairs.select(F.col("a").alias("path"), F.col("b").alias("other"), "reasons")
        else:
            first = names(pairs.select(F.col("a").alias("path"), F.col("b").alias("other"), "reasons"))
            rest = pairs.join(targets.select(F.col("path").alias("a")).distinct(), "a", "left_anti")
            alike = first.unionByName(names(rest.select(F.col("b").alias("path"), F.col("a").alias("other"), "reasons")))
        out = out.unionByName(alike.select("path", F.lit("warning").alias("severity"), text.alias("message")).distinct())
    return out
