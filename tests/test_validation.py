"""The schema compiler against a plain validator, and the catalog rules on small catalogs."""

from __future__ import annotations

import datetime
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from lumenframe.catalog_queries import QUERIES
from lumenframe.functions import schema as js
from lumenframe.operators import validate
from lumenframe.sources import storage

SCHEMA = {
    "type": "object",
    "required": ["id", "we'ird key"],
    "additionalProperties": {"type": ["integer", "null"]},
    "properties": {
        "id": {"type": "string", "pattern": r"^[a-z]\d+\.x'$", "minLength": 3, "maxLength": 6},
        "we'ird key": {"enum": ["a", 1, None, True]},
        "list": {"type": "array", "minItems": 1, "maxItems": 3, "uniqueItems": True, "items": {"$ref": "#/$defs/item"}},
        "url": {"format": "uri"},
        "day": {"format": "date"},
        "at": {"format": "date-time"},
        "never": False,
        "deep": {"anyOf": [{"type": "string"}, {"properties": {"n": {"exclusiveMinimum": 0, "maximum": 5}}, "required": ["n"], "type": "object"}]},
        "one": {"oneOf": [{"type": "integer"}, {"minimum": 2}]},
        "not": {"not": {"const": 0}},
    },
    "if": {"properties": {"id": {"const": "a1.x'"}}},
    "then": {"required": ["list"]},
    "else": {"properties": {"list": {"maxItems": 2}}},
    "$defs": {"item": {"type": ["object", "number"], "additionalProperties": False, "properties": {"k": {"type": "boolean"}, "sub": {"items": {"type": "string"}}}}},
}


def kinds(v):
    if v is None or isinstance(v, bool):
        return {"null"} if v is None else {"boolean"}
    if isinstance(v, (int, float)):
        return {"number", "integer"} if float(v).is_integer() else {"number"}
    return {{str: "string", list: "array", dict: "object"}[type(v)]}


def same(a, b):
    return a == b and isinstance(a, bool) == isinstance(b, bool)


def is_format(name, text):
    try:
        if name == "uri":
            return re.match("(https?|ftp|s3)://[^/?#]", text, re.I) is not None
        if name == "date":
            return len(text) == 10 and bool(datetime.date.fromisoformat(text))
        return "T" in text and datetime.datetime.fromisoformat(text).tzinfo is not None
    except ValueError:
        return False


def where(schema, v, path=(), root=SCHEMA):
    """The paths of all faults, by plain recursion."""
    if schema is True:
        return []
    if schema is False:
        return [path]
    out, k = [], kinds(v)
    go = lambda s, x, p=path: where(s, x, p, root)
    bad = lambda condition: out.append(path) if condition else None
    for word, arg in schema.items():
        if word == "type":
            bad(not k & set([arg] if isinstance(arg, str) else arg))
        elif word == "enum":
            bad(not any(same(v, x) for x in arg))
        elif word == "const":
            bad(not same(v, arg))
        elif word == "pattern" and "string" in k:
            bad(not re.search(arg, v))
        elif word in ("minLength", "maxLength") and "string" in k:
            bad(len(v) < arg if word[1] == "i" else len(v) > arg)
        elif word in ("minItems", "maxItems") and "array" in k:
            bad(len(v) < arg if word[1] == "i" else len(v) > arg)
        elif word == "uniqueItems" and "array" in k:
            bad(len({json.dumps(x) for x in v}) < len(v))
        elif word == "minimum" and "number" in k:
            bad(v < arg)
        elif word == "maximum" and "number" in k:
            bad(v > arg)
        elif word == "exclusiveMinimum" and "number" in k:
            bad(v <= arg)
        elif word == "format" and "string" in k:
            bad(not is_format(arg, v))
        elif word == "required" and "object" in k:
            out += [path] * len([n for n in arg if n not in v])
        elif word == "properties" and "object" in k:
            out += [f for n, s in arg.items() if n in v for f in go(s, v[n], (*path, n))]
        elif word == "additionalProperties" and "object" in k:
            rest = [n for n in v if n not in schema.get("properties", {})]
            out += [path] * len(rest) if arg is False else [f for n in rest for f in go(arg, v[n], (*path, n))]
        elif word == "items" and "array" in k:
            out += [f for i, x in enumerate(v) for f in go(arg, x, (*path, str(i)))]
        elif word == "$ref":
            out += go(root["$defs"][arg.rsplit("/", 1)[1]], v)
        elif word == "anyOf":
            bad(all(go(s, v) for s in arg))
        elif word == "oneOf":
            bad(sum(not go(s, v) for s in arg) != 1)
        elif word == "not":
            bad(not go(arg, v))
        elif word == "if":
            out += go(schema.get("else", True) if go(arg, v) else schema.get("then", True), v)
    return out


def values(rng, depth=0):
    plain = [None, True, False, 0, 1, 3, -2, 2.5, 5.0, 1e300, "", "a", "a1.x'", "b22.x'", "https://x.org", "ftp:///a", "2024-02-29", "2023-02-29", "2024-01-01T10:00:00Z", "2024-01-01T10:00", "é"]
    roll = rng.random()
    if depth > 2 or roll < 0.6:
        return rng.choice(plain)
    if roll < 0.75:
        return [values(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    return {k: values(rng, depth + 1) for k in rng.sample(["k", "sub", "n", "id", "zz"], rng.randint(0, 4))}


def documents():
    rng = random.Random(6)
    names = [*SCHEMA["properties"], "more", "k"]
    out = [{n: values(rng) for n in rng.sample(names, rng.randint(0, 8))} for _ in range(300)]
    for d in out[::2]:
        d |= {"id": "a1.x'", "we'ird key": rng.choice(["a", 1, None, True, False, 1.0])}
    return out + [[], 5, "text", None, {"id": None}, {"list": [{"k": True, "sub": ["a", 1, None]}, {"z": {"y": 1}}]}]


def test_faults_stand_where_a_plain_validator_finds_them(spark):
    docs = documents()
    rows = spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(docs)], "k int, j string").repartition(3)
    got = {r["k"]: [f["path"] for f in r["f"]] for r in rows.select("k", js.faults("j", SCHEMA).alias("f")).collect()}
    for k, d in enumerate(docs):
        want = sorted("/".join(p) or "<root>" for p in where(SCHEMA, d))
        # equal faults of a value are told once, so paths are compared as sets
        assert set(got[k]) == set(want), (d, got[k], want)


def test_unreadable_texts(spark):
    rows = spark.createDataFrame([(None,), ("",), ("{",), ("[1,",)], "j string")
    assert {tuple(map(tuple, r["f"])) for r in rows.select(js.faults("j", {"type": "object"}).alias("f")).collect()} == {(("<root>", "is not JSON"),)}


@pytest.mark.parametrize("bad", [{"patternProperties": {}}, {"type": "text"}, {"$ref": "other.json"}, {"$ref": "#"}, {"format": "ipv4"}])
def test_what_is_not_understood_is_an_error(bad):
    with pytest.raises(ValueError):
        js.faults_sql("j", bad)


CATALOG = {"type": "object", "properties": {"imaging": {"properties": {"dimensionality": {"enum": ["2D+t", "3D"]}, "modality": {"items": {"enum": ["em"]}}}}}}


def messages(df):
    return {(r["path"], r["severity"], r["message"]) for r in df.collect()}


def record(**fields):
    return json.dumps({"id": "a", "imaging": {"dimensionality": "2D+t", "modality": ["em"]}} | fields)


def test_a_sound_record_has_no_fault(spark):
    good = record(
        publications=[{"doi": "10.1/A", "url": None}], provenance={"evidence_urls": ["https://x.org/10.1/a"], "confidence": 0.9},
        technical={"method": "sample", "size_source": "file-listing", "layout": {"listing_complete": True}, "arrays": [{"value_range": [0, 1]}]}, data={"size_bytes": 1, "formats": ["other"]},
    )
    rows = spark.createDataFrame([("datasets/2D+t/em/a.yaml", good)], "path string, json string")
    assert messages(validate.catalog_faults(rows, CATALOG)) == set()


def test_catalog_rules(spark):
    rows = [
        ("datasets/3D/em/a.yaml", record(doi="10.1/X", landing_url="https://same.org")),
        ("datasets/2D+t/em/b.yaml", record(id="b", doi="10.1/x", provenance={"confidence": 0.6, "evidence_urls": ["http://www.read.org/p/", "https://not.org"]}, verification={"url_ok": False})),
        ("datasets/2D+t/em/c.yaml", record(id="c", landing_url="https://same.org")),
        ("drafts/d.yaml", record(id="d", landing_url="https://same.org", provenance="odd", technical={"method": "header", "arrays": []})),
        ("datasets/2D+t/em/e.yaml", "no json"),
        ("datasets/2D+t/em/f.yaml", None),
        ("datasets/2D+t/em/g.yaml", "[1]"),
    ]
    records = spark.createDataFrame(rows, "path string, json string")
    rejected = spark.createDataFrame([("c",), ("doi:10.1/x",), (None,)], "key string")
    fetched = spark.createDataFrame([("https://read.org/p",), (None,)], "url string")
    a, b, c = (p for p, _ in rows[:3])
    want = {
        (a, "belongs at datasets/2D+t/em/a.yaml"), (a, "doi:10.1/x was rejected"), (b, "doi:10.1/x was rejected"), (c, "c was rejected"),
        (a, f"doi:10.1/x is also in {b}"), (b, f"doi:10.1/x is also in {a}"), (b, "confidence 0.6 is over 0.5: url_ok is false"),
        (b, "evidence was not read in this run: https://not.org"), (b, "confidence 0.6 is under 0.7"), ("drafts/d.yaml", "technical.method header needs arrays"),
        ("datasets/2D+t/em/e.yaml", "<root>: is not JSON"), ("datasets/2D+t/em/f.yaml", "<root>: is not JSON"), ("datasets/2D+t/em/g.yaml", "<root>: [1] is not of type object"),
    }
    # b lies behind a in the order of paths, so each of the two is told of the other
    got = messages(validate.catalog_faults(records, CATALOG, rejected, fetched, least=0.7, similar=False))
    assert got == {(p, "error", m) for p, m in want}
    only = spark.createDataFrame([(b,)], "path string")
    assert messages(validate.catalog_faults(records, CATALOG, rejected, fetched, least=0.7, targets=only, similar=False)) == {(p, "error", m) for p, m in want if p == b}


def test_similar_records_are_warnings(spark):
    rows = [(f"datasets/2D+t/em/{k}.yaml", record(id=k, title=t, doi=d)) for k, t, d in (("a", "Synapses of the fly", None), ("b", "Synapses of the fly!", "10.1/b"), ("c", "Bones", None))]
    records = spark.createDataFrame(rows, "path string, json string")
    got = messages(validate.catalog_faults(records, CATALOG))
    assert got == {(rows[0][0], "warning", f"may be the same as {rows[1][0]} (title 100% similar)")}
    only = spark.createDataFrame([(rows[1][0],)], "path string")
    assert messages(validate.catalog_faults(records, CATALOG, targets=only)) == {(rows[1][0], "warning", f"may be the same as {rows[0][0]} (title 100% similar)")}


def test_no_records(spark):
    empty = spark.createDataFrame([], "path string, json string, message string, key string")
    assert validate.catalog_faults(empty, CATALOG).count() == 0
    assert empty.select(validate.record_faults("json", F.col("path"), CATALOG)).count() == 0


def parts_in_one_file(spark, folder):
    shapes = {"part": ["k AS p_partkey", "concat('part ', k) AS p_name", "cast(k % 50 AS int) AS p_size"], "supplier": ["k AS s_suppkey"], "nation": ["k AS n_nationkey"]}
    for table, columns in shapes.items():
        spark.range(1, 400, 1, 1).toDF("k").selectExpr(*columns).write.parquet(f"{folder}/{table}.parquet")
    return str(folder)


def tasks(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_records_of_one_file_are_work_for_many_tasks(spark, tmp_path):
    assert tasks(QUERIES["schema_faults"](spark, parts_in_one_file(spark, tmp_path))) >= spark.sparkContext.defaultParallelism


def test_a_catalog_is_parsed_once_by_many_tasks(spark, tmp_path, monkeypatch):
    seen, kept = {}, storage.kept
    monkeypatch.setattr(storage, "kept", lambda df, name: seen.update({name: tasks(df)}) or kept(df, name))
    QUERIES["catalog_faults"](spark, parts_in_one_file(spark, tmp_path))
    assert seen["records"] >= spark.sparkContext.defaultParallelism
