"""Catalog validation over records (JSON texts) made from ``part``."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions import schema as js
from lumenframe.operators import validate
from lumenframe.plans import query, table
from lumenframe.sources import storage

_ARRAY = {
    "type": "object",
    "required": ["role", "shape"],
    "properties": {"role": {"enum": ["raw", "label"]}, "shape": {"type": "array", "minItems": 1, "items": {"type": "integer", "minimum": 1}}},
}
SCHEMA = {
    "type": "object",
    "additionalProperties": False,
    "required": ["id", "title"],
    "properties": {
        "id": {"type": "string", "pattern": "^[a-z0-9]+(-[a-z0-9]+)*$"},
        "title": {"type": "string", "maxLength": 32},
        "imaging": {
            "type": "object",
            "properties": {
                "dimensionality": {"enum": ["2D", "3D"]},
                "modality": {"type": "array", "minItems": 1, "items": {"enum": ["em", "lm"]}},
                "voxel": {"type": ["object", "null"], "additionalProperties": {"type": ["number", "null"], "exclusiveMinimum": 0}},
            },
        },
        "size": {"type": ["integer", "null"], "minimum": 0},
        "url": {"type": "string", "format": "uri"},
        "day": {"type": "string", "format": "date"},
        "at": {"type": "string", "format": "date-time"},
        "annotated": {"type": "boolean"},
        "tasks": {"type": "array", "items": {"type": "string"}},
        "arrays": {"type": "array", "items": {"$ref": "#/$defs/array"}},
    },
    "allOf": [{"if": {"properties": {"annotated": {"const": False}}}, "then": {"properties": {"tasks": {"items": {"enum": ["denoising"]}}}}}],
    "$defs": {"array": _ARRAY},
}


def _quoted(*fields: str) -> str:
    """SQL of a JSON object, from the SQL of its texts ("name": value), nulls left out."""
    return f"concat('{{', concat_ws(', ', {', '.join(fields)}), '}}')"


_JSON = _quoted(
    """concat('"id": "', if(k % 11 = 0, 'Part ', 'part-'), k, '"')""",
    """if(k % 13 = 0, NULL, concat('"title": "', p_name, '"'))""",
    """concat('"imaging": {"dimensionality": "', if(k % 17 = 0, '4D', '3D'), '", "modality": ', CASE k % 7 WHEN 0 THEN '[]' WHEN 1 THEN '["em", 5]' ELSE '["lm"]' END,
       ', "voxel": ', if(k % 19 = 0, 'null', concat('{"x": ', p_size, ', "y": ', if(k % 9 = 0, '-1', '1.5'), ', "z": ', if(k % 10 = 0, '"two"', 'null'), '}')), '}')""",
    """concat('"size": ', CASE WHEN k % 8 = 0 THEN '1.5' WHEN k % 8 = 1 THEN 'null' WHEN k % 8 = 2 THEN '3.0' ELSE string(p_size) END)""",
    """concat('"url": "', if(k % 6 = 0, 'x.org/a', 'https://x.org/a'), '"')""",
    """concat('"day": "2024-02-', if(k % 12 = 0, '30', '28'), '"')""",
    """concat('"at": "2024-01-01T10:00:00', if(k % 15 = 0, '', 'Z'), '"')""",
    """concat('"annotated": ', k % 2 = 0, ', "tasks": ["', if(k % 3 = 0, 'denoising', 'tracking'), '"]')""",
    """concat('"arrays": [{"role": "raw", "shape": [4, 5]}, {"role": "', if(k % 5 = 0, 'mesh', 'label'), '", "shape": [3, ', if(k % 4 = 0, 0, 2), ']}', if(k % 16 = 0, ', {"shape": []}', ''), ']')""",
    """if(k % 14 = 0, '"extra": [1]', NULL)""",
)
_FAULTS = (
    ("k % 11 = 0", "'id'", "'''Part ' || k || ''' does not match ^[a-z0-9]+(-[a-z0-9]+)*$'"),
    ("k % 13 = 0", "'<root>'", "'''title'' is missing'"),
    ("k % 13 > 0 AND length(p_name) > 32", "'title'", "'is longer than 32 characters'"),
    ("k % 17 = 0", "'imaging/dimensionality'", """'''4D'' is not one of the values "2D", "3D"'"""),
    ("k % 7 = 0", "'imaging/modality'", "'has fewer than 1 items'"),
    ("k % 7 = 1", "'imaging/modality/1'", """'5 is not one of the values "em", "lm"'"""),
    ("k % 19 > 0 AND k % 9 = 0", "'imaging/voxel/y'", "'-1 is not greater than 0'"),
    ("k % 19 > 0 AND k % 10 = 0", "'imaging/voxel/z'", "'''two'' is not of type number, null'"),
    ("k % 8 = 0", "'size'", "'1.5 is not of type integer, null'"),
    ("k % 6 = 0", "'url'", "'''x.org/a'' is not a uri'"),
    ("k % 12 = 0", "'day'", "'''2024-02-30'' is not a date'"),
    ("k % 15 = 0", "'at'", "'''2024-01-01T10:00:00'' is not a date-time'"),
    ("k % 2 = 1 AND k % 3 > 0", "'tasks/0'", """'''tracking'' is not one of the values "denoising"'"""),
    ("k % 5 = 0", "'arrays/1/role'", """'''mesh'' is not one of the values "raw", "label"'"""),
    ("k % 4 = 0", "'arrays/1/shape/1'", "'0 is less than 1'"),
    ("k % 16 = 0", "'arrays/2'", "'''role'' is missing'"),
    ("k % 16 = 0", "'arrays/2/shape'", "'has fewer than 1 items'"),
    ("k % 14 = 0", "'<root>'", "'''extra'' is not known'"),
)
_PART = "SELECT p_partkey AS k, * FROM part"


@query(" UNION ALL ".join(f"SELECT k AS p_partkey, {path} AS path, {message} AS message FROM ({_PART}) WHERE {when}" for when, path, message in _FAULTS))
def schema_faults(spark, sf):
    """Every fault of every record by a nested schema."""
    part = storage.spread(table(spark, sf, "part").select("p_partkey", "p_name", "p_size"), "p_partkey")
    records = part.withColumn("k", F.col("p_partkey")).select("p_partkey", F.expr(_JSON).alias("json"))
    found = records.select("p_partkey", F.explode(js.faults("json", SCHEMA)).alias("f"))
    return found.select("p_partkey", "f.path", "f.message")


_RECORD = _quoted(
    """concat('"id": "part-', if(k % 23 = 0, k + 1, k), '", "title": "', p_name, '", "repository": "Zenodo"')""",
    """if(k % 4 = 0, NULL, concat('"doi": "10.5/', if(k % 10 = 0, string(k div 50), concat('X', k)), '"'))""",
    """if(k % 3 = 0, concat('"publications": [{"doi": "10.7/', k, '", "url": null}]'), NULL)""",
    """concat('"imaging": {"dimensionality": "3D", "modality": ["', if(k % 9 = 0, 'lm', 'em'), '"]}')""",
    """concat('"data": {"formats": ["tiff"', if(k % 21 = 0, ', "other"', ''), '], "size_bytes": ', if(k % 8 = 0, 'null', string(p_size)), '}')""",
    """concat('"provenance": {"confidence": ', k % 100 / 100, ', "evidence_urls": ["https://', if(k % 6 = 0, 'host.org/', 'arxiv.org/'), k % 200, '"]}')""",
    """concat('"verification": {"url_ok": ', k % 5 > 0, ', "license_found": ', k % 7 > 0, '}')""",
    """if(k % 2 = 0, concat('"technical": {"method": "', if(k % 12 = 0, 'header', 'sample'), '", "size_source": "', if(k % 16 = 0, 'file-listing', 'paper'), '", "layout": {"listing_complete": ', k % 32 = 0,
       '}, "arrays": [', if(k % 24 = 0, '', '{"path_pattern": "a", "value_range": [0, 1]}'), ']}'), NULL)""",
)
_CATALOG_SCHEMA = {
    "type": "object",
    "properties": {
        "imaging": {"properties": {"dimensionality": {"enum": ["2D", "3D"]}, "modality": {"items": {"enum": ["em", "lm"]}}}},
        "provenance": {"properties": {"confidence": {"maximum": 0.98}}},
    },
}
_ID = "CASE WHEN k % 23 = 0 THEN k + 1 ELSE k END"
_CONF = "(k % 100 / 100.0)"
_DOI = "CASE WHEN k % 4 > 0 AND k % 10 = 0 THEN 'doi:10.5/' || (k // 50) WHEN k % 4 > 0 THEN 'doi:10.5/x' || k END"
_SHOW = f"CAST({_CONF} AS DOUBLE)::VARCHAR"
_RULES = (
    (f"{_CONF} > 0.98", "'provenance/confidence: 0.99 is greater than 0.98'"),
    ("k % 23 = 0", "'id part-' || (k + 1) || ' is not the name of the file'"),
    ("k % 6 = 0", "'a paper is named, but none of evidence_urls leads to one'"),
    ("k % 21 = 0", "'the format other stands alone or not at all'"),
    ("k % 24 = 0", "'technical.method header needs arrays'"),
    ("k % 16 = 0", "'a size from the file listing is missing'"),
    ("k % 16 = 0 AND k % 32 > 0", "'a size from the file listing needs a complete listing'"),
    ("k % 12 = 0 AND k % 24 > 0", "'value_range of a needs the method sample'"),
    ("k % 9 = 0", f"'belongs at datasets/3D/lm/part-' || ({_ID}) || '.yaml'"),
    ("k % 23 = 0 AND k % 9 > 0", f"'belongs at datasets/3D/em/part-' || ({_ID}) || '.yaml'"),
    (f"k % 5 = 0 AND {_CONF} > 0.5", f"'confidence ' || {_SHOW} || ' is over 0.5: url_ok is false'"),
    (f"k % 7 = 0 AND {_CONF} > 0.7", f"'confidence ' || {_SHOW} || ' is over 0.7: license_found is false'"),
    (f"{_CONF} < 0.05", f"'confidence ' || {_SHOW} || ' is under 0.05'"),
    (f"({_ID}) IN (SELECT s_suppkey * 3 FROM supplier)", f"'part-' || ({_ID}) || ' was rejected'"),
    (f"({_DOI}) IN (SELECT 'doi:10.5/x' || s_suppkey FROM supplier)", f"({_DOI}) || ' was rejected'"),
    (
        "k % 200 NOT IN (SELECT n_nationkey * 8 FROM nation)",
        "'evidence was not read in this run: https://' || CASE WHEN k % 6 = 0 THEN 'host.org/' ELSE 'arxiv.org/' END || (k % 200)",
    ),
)


@query(
    f"WITH r AS (SELECT *, p_partkey AS k, 'datasets/3D/em/part-' || p_partkey || '.yaml' AS path FROM part), d AS (SELECT path, {_DOI} AS key FROM r), "
    "g AS (SELECT key, min(path) AS first, max(path) AS last FROM d WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1) "
    + " UNION ALL ".join(f"SELECT path, 'error' AS severity, {message} AS message FROM r WHERE {when}" for when, message in _RULES)
    + " UNION ALL SELECT path, 'error', d.key || ' is also in ' || CASE WHEN path = first THEN last ELSE first END FROM d JOIN g ON d.key = g.key"
)
def catalog_faults(spark, sf):
    """Every fault of a catalog: schema, rules, place, confidence, rejected keys, unread evidence, shared keys."""
    records = storage.spread(table(spark, sf, "part").select("p_partkey", "p_name", "p_size"), "p_partkey").withColumn("k", F.col("p_partkey"))
    records = records.select(F.format_string("datasets/3D/em/part-%d.yaml", "k").alias("path"), F.expr(_RECORD).alias("json"))
    s = table(spark, sf, "supplier")
    rejected = s.select(F.concat(F.lit("part-"), F.col("s_suppkey") * 3).alias("key"))
    rejected = rejected.unionByName(s.select(F.concat(F.lit("doi:10.5/x"), "s_suppkey").alias("key")))
    page = lambda host: F.concat(F.lit(f"http://www.{host}/"), F.col("n_nationkey") * 8, F.lit("/"))
    pages = table(spark, sf, "nation").select(F.explode(F.array(page("host.org"), page("arxiv.org"))).alias("url"))
    return validate.catalog_faults(records, _CATALOG_SCHEMA, rejected, pages, least=0.05, similar=False)
