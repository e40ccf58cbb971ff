"""Plans, runs, versions, places, voxels, crawls and directory trees on small and odd rows."""

from __future__ import annotations

import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.functions import text
from lumenframe.operators import planning, rollup, sampling
from lumenframe.sources import crawl, headers, storage, versions, voxels

# ---------------------------------------------------------------- plans


def test_patterns_of_rows_are_those_of_the_library(spark):
    patterns = ["raw_NNN.{tif,tiff}", "<s>/mask_<s>.tif", "a/*.h5", "x?.tif", "z.zip::in/<a>_<b>_<a>.raw", "we(ird)+[1].tif", "{a.b,c}/é NNN", ""]
    paths = ["raw_12.tiff", "d/raw_1.tif", "raw_.tif", "q/mask_q.tif", "q/mask_r.tif", "a/b.h5", "a/b/c.h5", "xy.tif", "in/1_2_1.raw", "in/1_2_2.raw", "we(ird)+[1].tif", "weird1.tif", "c/é 5", "aXb/é 5", ""]
    rows = spark.createDataFrame([(p, q) for p in patterns for q in paths], "p string, q string")
    got = {(r["p"], r["q"]): r["fits"] for r in rows.select("p", "q", F.rlike("q", planning.pattern_regex(F.col("p"))).alias("fits")).collect()}
    for p in patterns:
        rx = re.compile(text.path_pattern(p).replace("(?<p", "(?P<p").replace(r"\k<p0>", "(?P=p0)"))
        assert {q for q in paths if got[p, q]} == {q for q in paths if rx.search(q)}, p


def test_classes_fill_the_gaps(spark):
    cases = [([1, 3, 4], ["a", "3=x", "b"], {1: "a", 3: "x", 4: "b"}, 2, 2), ([], ["a"], {}, 0, 1), ([2], ["9=z", "2=", "2=y=1"], {9: "z", 2: "y=1"}, 0, 0), ([0, 1], [], {}, 2, 0), ([5], ["k\n1"], {5: "k\n1"}, 1, 1)]
    rows = spark.createDataFrame([(u, g) for u, g, *_ in cases], "u array<int>, g array<string>")
    for r, (_, _, classes, free, plain) in zip(rows.select(planning.assigned_classes(F.col("u"), F.col("g")).alias("c")).collect(), cases, strict=True):
        assert (r["c"]["classes"], r["c"]["free"], r["c"]["plain"]) == (classes, free, plain)


RECORDS = "id long, ord long, dataset string, stop array<string>, arrays array<struct<role: string, path_pattern: string>>, file_sets array<array<string>>, given array<string>, name string"
KNOWN = "dataset string, id long, files array<string>, name string"


def test_plans_of_odd_records(spark):
    arrays = [("raw", "r*.tif"), ("label", "l*.tif"), (None, None)]
    rows = [
        (1, 1, "d", None, arrays, [["r1.tif", "l1.tif"], ["r2.tif", "r3.tif", "odd"]], ["cell"], "n"),
        (2, 2, "d", ["no"], arrays, [["r1.tif"]], None, "n"),
        (3, 3, "d", [], None, None, None, "n"),
        (4, 4, None, [], arrays, [["l9.tif"], ["l9.tif"]], [], "n"),
        (5, 5, "e", [], arrays, [["r1.tif", "l1.tif"]], ["a", "b"], "n"),
    ]
    known = spark.createDataFrame([("d", 1, ["l1.tif", "r1.tif"], "crop-007"), ("d", 9, ["q"], "crop-004")], KNOWN)
    got = {r["id"]: r for r in planning.plans(spark.createDataFrame(rows, RECORDS), known).collect()}
    assert [c["crop"] for c in got[1]["crops"]] == ["crop-007", "crop-008"] and got[1]["classes"] == {1: "cell"}
    assert got[1]["notes"] == ["crop-008: odd fits no single array", "crop-008: several raw files"]
    assert [(e["role"], e["label_class"]) for e in got[1]["crops"][0]["entries"]] == [("raw", None), ("label", "cell")]
    assert got[2]["stop"] == ["no"] and got[2]["crops"] == [] and got[3]["crops"] == []
    assert [c["crop"] for c in got[4]["crops"]] == ["crop-001", "crop-002"] and len(got[4]["notes"]) == 2
    assert got[5]["stop"] == ["2 classes without a number for 1 label arrays that need one"] and got[5]["crops"] == []
    assert planning.plans(spark.createDataFrame([], RECORDS), known).count() == 0


def test_a_run_goes_on_where_it_was_lost(spark):
    steps = spark.createDataFrame([(c, s, f) for c, f in (("a", 0), ("b", 2), ("c", 3)) for s in (1, 2, 3)], "crop string, step int, fails int")
    runner = planning.Runner(spark, storage.new_folder(spark, "run"))
    asked = []

    def do(due, broken=True):
        asked.append({(r["crop"], r["step"]) for r in due.collect()})
        if any(s == 3 for _, s in asked[-1]) and broken:
            raise OSError("lost")
        bad = F.col("step") == F.col("fails")
        return due.select("crop", "step", F.when(bad, "error").otherwise("success").alias("status"), F.when(bad, "bad").alias("message"))

    with pytest.raises(OSError):
        runner.run(steps, do)
    assert {r["crop"]: r["status"] for r in runner.summary(steps).collect()} == {"a": "open", "b": "failed", "c": "open"}
    assert runner.run(steps, lambda due: do(due, False)) == 2
    assert asked[-1] == {("a", 3), ("c", 3)}
    table = {tuple(r) for r in runner.summary(steps).collect()}
    assert table == {("a", "done", 3, None, None), ("b", "failed", 1, 2, "bad"), ("c", "failed", 2, 3, "bad")}
    assert runner.run(steps, do) == 0 and {tuple(r) for r in runner.summary(steps).collect()} == table
    mended = steps.withColumn("fails", F.lit(0))
    assert runner.run(mended, lambda due: do(due, False), retry=True) == 3
    assert {r["status"] for r in runner.summary(mended).collect()} == {"done"}
    assert runner.run(steps.limit(0), do) == 0


def test_done_crops(spark):
    crops = spark.createDataFrame([("a", ["x", "y"]), ("b", ["x"]), ("c", ["x"]), ("d", None)], "crop string, files array<string>")
    manifest = spark.createDataFrame([("a", ["y", "x"]), ("b", ["x", "z"]), ("c", ["x"])], "crop string, files array<string>")
    verdicts = spark.createDataFrame([("a", "pass"), ("b", "pass"), ("c", "fail"), ("d", "pass")], "crop string, verdict string")
    assert {r["crop"] for r in planning.already_done(crops, manifest, verdicts).where("done").collect()} == {"a"}


# ---------------------------------------------------------------- versions and places


def rows_of(df):
    return {tuple(r) for r in df.collect()}


def test_two_writers_from_one_version(spark):
    t = versions.VersionedTable(spark, storage.new_folder(spark, "v"), "k string, v int", "k")
    make = lambda *rows: spark.createDataFrame(rows, "k string, v int")
    assert t.read().count() == 0 and t.latest() == 0
    one = t.commit(make(("a", 1), ("b", 1), (None, 1)), 0)
    assert t.tag("first", one) and not t.tag("first", 9)
    two = t.commit(make(("a", 2)), one)
    with pytest.raises(versions.Conflict) as told:
        t.commit(make(("a", 3), ("c", 3)), one)
    assert rows_of(told.value.rows) == {("a", 2, False)} and t.latest() == two
    three = t.commit(make(("c", 3)), one)  # meets nobody's rows
    assert rows_of(t.read(three)) == {("a", 2), ("b", 1), (None, 1), ("c", 3)}
    gone = make(("b", 0), (None, 0)).withColumn("_deleted", F.lit(True))
    four = t.commit(gone, three)
    assert rows_of(t.read()) == {("a", 2), ("c", 3)} and rows_of(t.read("first")) == {("a", 1), ("b", 1), (None, 1)}
    assert rows_of(t.changes(three)) == {("b", 0, True), (None, 0, True)}
    five = t.compact()
    assert rows_of(t.read(five)) == rows_of(t.read(four))
    with pytest.raises(versions.Conflict):
        t.commit(make(("b", 9)), three)  # also across the compaction
    assert rows_of(t.read(t.commit(make(("a", 5)), five))) == {("a", 5), ("c", 3)}
    with pytest.raises(ValueError):
        t.commit(make(("x", 1), ("x", 2)), 0)


def test_a_lost_race_is_tried_again(spark, monkeypatch):
    t = versions.VersionedTable(spark, storage.new_folder(spark, "v"), "k string, v int", "k")
    make = lambda *rows: spark.createDataFrame(rows, "k string, v int")
    base = t.commit(make(("a", 1)), 0)
    create, other = storage.create_once, []

    def slow(session, path, body):
        if not other:  # another writer is faster, just before the file is made
            other.append(1)
            t.commit(make(("b", 2)), base)
        return create(session, path, body)

    monkeypatch.setattr(storage, "create_once", slow)
    t.commit(make(("c", 3)), base)
    assert rows_of(t.read()) == {("a", 1), ("b", 2), ("c", 3)}


def test_only_partitions_that_rows_leave_or_enter_are_written(spark):
    path = storage.new_folder(spark, "places")
    rows = spark.createDataFrame([(1, "2D+t", "x"), (2, "2D+t", "x"), (3, "3D", "a/b"), (4, "3D", "y"), (5, None, "y")], "k long, dim string, mod string")
    rows.write.partitionBy("dim", "mod").parquet(path)
    names = lambda: {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}
    before = names()
    moved = spark.createDataFrame([(3, "3D", "y"), (1, "2D+t", "x"), (5, "4D", "y"), (77, "q", "q")], "k long, dim string, mod string")
    written = versions.move_partitions(spark, path, moved, "k", ["dim", "mod"])
    assert written == sorted(["dim=3D/mod=a%2Fb", "dim=3D/mod=y", "dim=4D/mod=y", "dim=__HIVE_DEFAULT_PARTITION__/mod=y"])
    assert rows_of(spark.read.parquet(path).select("k", "dim", "mod")) == {(1, "2D+t", "x"), (2, "2D+t", "x"), (3, "3D", "y"), (4, "3D", "y"), (5, "4D", "y")}
    assert {n for n in before if "2D" in n} == {n for n in names() if "2D" in n}
    assert versions.move_partitions(spark, path, moved.limit(0), "k", ["dim", "mod"]) == []


# ---------------------------------------------------------------- voxels


def cube(spark, a):
    rows = [(*map(int, p), int(a[tuple(p)])) for p in np.argwhere(np.ones_like(a))]
    return spark.createDataFrame(rows, ", ".join(f"{c} int" for c in "czyx"[-a.ndim :]) + ", v int").repartition(3)


def as_array(df, shape, axes="zyx"):
    out = np.full(shape, -1, np.int64)
    for r in df.collect():
        assert out[tuple(r[a] for a in axes)] == -1
        out[tuple(r[a] for a in axes)] = r["v"]
    return out


@pytest.mark.parametrize("dtype", ["uint8", "int32", "float64"])
def test_voxels_come_back(spark, dtype):
    a = np.random.default_rng(1).integers(0, 99, (2, 5, 7, 3))
    a[:, :4, :4] = 0  # chunks of nothing
    path = storage.new_folder(spark, "vox")
    voxels.write(cube(spark, a), path, a.shape, dtype, "czyx", [1, 2, 4, 2])
    assert (as_array(voxels.read(spark, path), a.shape, "czyx") == a).all()
    meta = voxels.metadata(path)
    assert meta["dimension_names"] == list("czyx") and meta["codecs"][1]["name"] == "zstd"


def test_a_crop_reads_only_the_chunks_it_cuts(spark):
    a = np.arange(8 * 8 * 8).reshape(8, 8, 8)
    path = storage.new_folder(spark, "vox")
    voxels.write(cube(spark, a), path, a.shape, "uint16", chunk=[2, 2, 2])
    whole = voxels.read(spark, path)
    crop = whole.where("z >= 2 AND z < 5 AND y = 7 AND x IN (1, 2)")
    assert (whole.rdd.getNumPartitions(), crop.rdd.getNumPartitions()) == (64, 2 * 1 * 2)
    assert sorted(r["v"] for r in crop.collect()) == sorted(a[2:5, 7, 1:3].ravel().tolist())
    assert whole.where("z > 90").count() == 0 and whole.where("x IS NULL").count() == 0
    assert whole.where("v = 300 AND z <= 100").count() == 1


def test_an_array_that_was_not_finished_is_none(spark):
    path = storage.new_folder(spark, "vox")
    rows = spark.createDataFrame([(9, 0, 0, 1)], "z int, y int, x int, v int")
    with pytest.raises(Exception, match="outside the shape"):
        voxels.write(rows, path, (2, 2, 2), "uint8")
    with pytest.raises(Exception, match="no zarr.json"):
        voxels.read(spark, path).count()


@pytest.mark.parametrize("kind", ["image", "label"])
def test_a_changed_voxel_is_named_by_level_and_chunk(spark, kind):
    a = np.random.default_rng(3).integers(0, 5, (4, 9, 6))
    path = storage.new_folder(spark, "pyramid")
    assert voxels.write_multiscale(cube(spark, a), path, a.shape, "uint8", (40, 10, 10), [(1, 2, 2), (2, 2, 2)], kind, (2, 4, 4)) == ["s0", "s1", "s2"]
    assert voxels.pyramid_faults(spark, path, kind).count() == 0
    told = voxels.metadata(path)["attributes"]["ome"]["multiscales"][0]["datasets"]
    assert told[2]["coordinateTransformations"] == [{"type": "scale", "scale": [80.0, 40.0, 40.0]}, {"type": "translation", "translation": [20.0, 15.0, 15.0]}]
    s1 = as_array(voxels.read(spark, f"{path}/s1"), (4, 5, 3))
    s1[3, 4, 2] += 1
    voxels.write(cube(spark, s1), f"{path}/s1", s1.shape, "uint8", chunk=(2, 4, 4))
    found = rows_of(voxels.pyramid_faults(spark, path, kind))
    assert ("s1", "1/1/0", 1) in found and {f[0] for f in found} <= {"s1", "s2"}
    voxels.write(cube(spark, s1[:3]), f"{path}/s1", (3, 5, 3), "uint8", chunk=(2, 4, 4))
    assert ("s1", None, None) in rows_of(voxels.pyramid_faults(spark, path, kind))


# ---------------------------------------------------------------- crawls and trees


def plain_crawl(root, answers, max_dirs, max_files, max_depth):
    """One root, folder by folder."""
    level, seen, files, n_dirs, problems = [(root, root, True)], {root}, {}, 0, set()
    for depth in range(max_depth + 1):
        coming, base = [], len(files)
        counted = sum_before = base
        del sum_before
        done = 0
        for url, folder, is_dir in sorted(level):
            if base >= max_files or counted >= max_files or (is_dir and n_dirs + 1 > max_dirs):
                problems.add("budget of folders or files")
                continue
            n_dirs += is_dir
            done += 1
            if url not in answers:
                problems.add("no answer from a folder")
                continue
            entries, after = answers[url]
            for name, size, is_folder in entries:
                if re.match(r"^(/|\.{1,2}(/|$)|[a-z][a-z0-9+.-]*:)", name) or not name:
                    counted += not is_folder
                    continue
                target = folder + name
                if is_folder and target not in seen:
                    seen.add(target)
                    coming.append((target, target, True))
                elif not is_folder:
                    files[target] = size
                    counted += 1
            if after and after not in seen:
                seen.add(after)
                coming.append((after, folder, False))
        level = coming
        if not level:
            break
    else:
        problems.add("budget of depth")
    return n_dirs, set(files), problems


@pytest.mark.parametrize("budget", [(200, 50_000, 64), (5, 50_000, 64), (200, 6, 64), (200, 50_000, 1)])
def test_a_crawl_is_that_of_a_plain_walk(spark, budget):
    rng = random.Random(budget[0] + budget[2])
    answers = {}
    for r in "abc":
        urls = [f"http://{r}/"]
        for url in urls:
            if len(urls) < 18:
                kids = [f"d{k}/" for k in range(rng.randint(0, 3))]
                urls += [url + k for k in kids]
            else:
                kids = []
            entries = [(k, None, True) for k in kids] + [(f"f{k}", k, False) for k in range(rng.randint(0, 2))] + [("../", None, True)]
            if rng.random() < 0.9:
                after = f"{url}?page=2" if rng.random() < 0.3 else None
                answers[url] = (entries, after)
                if after:
                    answers[after] = ([("g", 1, False)], None)
    df = spark.createDataFrame([(u, e, n) for u, (e, n) in answers.items()], crawl.ANSWERS)
    roots = spark.createDataFrame([("http://a/",), ("http://b/",), ("http://c/",), ("http://none/",), (None,), ("http://a/",)], "root string")
    files, summary = crawl.crawl(roots, df, *budget)
    found, told = rows_of(files.select("root", "url")), {r["root"]: r for r in summary.collect()}
    assert set(told) == {"http://a/", "http://b/", "http://c/", "http://none/"}
    for root, r in told.items():
        n_dirs, urls, problems = plain_crawl(root, answers, *budget)
        assert (r["n_dirs"], set(r["problems"]), r["complete"]) == (n_dirs, problems, not problems), root
        assert {u for o, u in found if o == root} == urls and r["n_files"] == len(urls)


def test_directory_trees(spark):
    rows = [("a", f"top/in/s{k}/x.TIF", 1) for k in range(3)] + [("a", "top/in/z.zarr/c/0", 5), ("a", "top/in/z.zarr/c/1", None), ("a", "top/.git/x", 9), ("a", None, 1)]
    rows += [("b", "only.txt", 2), ("c", "__MACOSX/y", 1), (None, "q/w.nii.gz", 3), (None, "q/e.nii.gz", 4)]
    got = rows_of(rollup.directory_tree(spark.createDataFrame(rows, "k string, path string, size long"), "k"))
    assert got == {
        ("a", "top/in", "s#", 3, 3, False, 3, ".tif 3", 1), ("a", "top/in", "z.zarr", 2, 5, True, 1, ".zarr 2", 1), ("b", "", "", 1, 2, False, 1, ".txt 1", 0),
        ("c", None, None, None, None, None, None, None, 1), (None, "q", "", 2, 7, False, 1, ".nii.gz 2", 0),
    }
    assert rollup.directory_tree(spark.createDataFrame([], "k string, path string, size long"), "k").count() == 0


def test_json_is_what_zarr_readers_expect(spark):
    layout = voxels.Layout("zyx", (3, 3, 3), (2, 2, 2), "uint16")
    assert voxels.Layout.of(json.loads(json.dumps(layout.meta()))) == layout
    with pytest.raises(ValueError):
        voxels.Layout.of(layout.meta() | {"data_type": "complex64"})


# ---------------------------------------------------------------- sampling


def plain_resample(a, voxel, target, kind):
    shape = sampling.resampled_shape(a.shape, voxel, target)
    out = np.zeros(shape)
    for place in np.ndindex(*shape):
        total, centres = 0.0, [min(max((i + 0.5) * t / e - 0.5, 0), n - 1) for i, t, e, n in zip(place, target, voxel, a.shape, strict=True)]
        if kind == "label":
            out[place] = a[tuple(int(np.floor(c + 0.5)) for c in centres)]
            continue
        for corner in np.ndindex(2, 2, 2):
            at = [min(int(c) + d, n - 1) for c, d, n in zip(centres, corner, a.shape, strict=True)]
            w = [c - int(c) if d else 1 - (c - int(c)) for c, d in zip(centres, corner, strict=True)]
            total += a[tuple(at)] * np.prod(w)
        out[place] = total
    return out


@pytest.mark.parametrize("kind", ["image", "label"])
@pytest.mark.parametrize("target", [(10, 5, 5), (20, 8, 3), (7, 5, 90), (10, 11, 4.5)])
def test_resampling_is_that_of_a_plain_loop(spark, kind, target):
    a = np.random.default_rng(4).integers(0, 9, (3, 6, 5))
    got = sampling.resampled(cube(spark, a).withColumn("crop", F.lit("k")), a.shape, (10, 5, 5), target, kind)
    want = plain_resample(a, (10, 5, 5), target, kind)
    found = {(r["z"], r["y"], r["x"]): r["v"] for r in got.collect()}
    assert set(found) == set(np.ndindex(*want.shape))
    assert all(found[p] == pytest.approx(want[p]) for p in found)


LEVELS = "id string, levels array<struct<scale: struct<x: double, y: double, z: double>, translation: struct<x: double, y: double, z: double>, shape: struct<x: int, y: int, z: int>>>"


def test_patches_nest_and_do_not_depend_on_partitions(spark):
    level = lambda f, n: ((4.0 * f, 4.0 * f, 30.0), (2.0 * (f - 1), 2.0 * (f - 1), 0.0), (n // f, n // f, 9))
    rows = [("a", [level(f, 400) for f in (1, 2, 8)]), ("b", [level(f, 400) for f in (1, 8)]), ("c", [level(f, 120) for f in (1, 2, 8)]), (None, [level(f, 160) for f in (1, 2, 8)]), ("d", None)]
    arrays = spark.createDataFrame(rows, LEVELS)
    draw = lambda df, **k: {tuple(map(str, r)) for r in sampling.patch_samples(df, 20, 16, (1, 2, 8), **k).collect()}
    first = draw(arrays, seed=1)
    assert first == draw(arrays.repartition(5), seed=1) and first != draw(arrays, seed=1, epoch=1) and first != draw(arrays, seed=2)
    found = sampling.patch_samples(arrays, 20, 16, (1, 2, 8), seed=1).collect()
    assert {r["id"] for r in found} == {"a", None} and len(found) == 2 * 20 * 3
    by = {(r["id"], r["sample"], r["factor"]): r for r in found}
    for (i, s, f), r in by.items():
        assert 0 <= r["x0"] and r["x0"] + 16 <= (400 if i else 160) // f and 0 <= r["z0"] < 9
        if f < 8:  # the box of a finer patch lies in that of the coarsest, to half a coarse voxel
            outer = by[i, s, 8]
            assert all(o - 16 <= a and b <= p + 16 for o, a, b, p in zip(outer["low"], r["low"], r["high"], outer["high"], strict=True))


ENTRIES = "id long, crop string, index int, key string, role string, label_class string, axes string, reader string, dataset string, dtype string, orientation string, transforms array<string>"


def test_edits_of_a_plan(spark):
    entry = lambda k, role, key=None, crop="c": (1, crop, k, key, role, None, "zyx", None, None, None, "apply", None)
    entries = spark.createDataFrame([entry(0, "raw"), entry(1, "label", "cells"), entry(2, "label", "2"), entry(0, None, crop="d")], ENTRIES)
    rows = [
        ("raw", "axes", "czyx", None), ("0", "reader", None, None), ("cells", "label_class", "cell", "title"), ("1", "transform", "flip:y", "header"), ("1", "transform", "select:c:2", "header"),
        ("1", "clear", "transforms", None), ("1", "transform", "crop:z", "doc"), ("label", "axes", "x", None), ("2", "label_class", "x", None), ("raw", "label_class", "x", "y"), ("0", "role", "label", None),
        ("0", "label_class", "late", "y"), ("0", "orientation", "ignore", ""), ("0", "orientation", "turn", "y"), ("0", "orientation", "ignore", "seen"), ("1", "colour", "red", "y"), ("9", "axes", "x", None), (None, "axes", "x", None),
    ]
    edits = spark.createDataFrame([(k, 1, "c", *r) for k, r in enumerate(rows)] + [(99, 1, "e", "0", "axes", "x", None)], "ord long, id long, crop string, target string, setting string, value string, reason string")
    after, log = planning.edited(entries, edits)
    refused = {r["ord"]: r["refusal"] for r in log.collect()}
    assert refused == dict.fromkeys(range(len(rows))) | {
        7: "the target means 2 entries", 8: "a class needs a reason", 9: "only labels have a class", 12: "to ignore an orientation needs a reason", 13: "orientation is apply or ignore",
        15: "unknown setting", 16: "the target means 0 entries", 17: "the target means 0 entries", 99: "the target means 0 entries",
    }
    got = {(r["crop"], r["index"]): r for r in after.collect()}
    assert len(got) == 4 and (got["c", 0]["axes"], got["c", 0]["role"], got["c", 0]["label_class"], got["c", 0]["orientation"]) == ("czyx", "label", "late", "ignore")
    assert (got["c", 1]["label_class"], got["c", 1]["transforms"]) == ("cell", ["crop:z"]) and got["d", 0]["axes"] == "zyx"
    assert planning.edited(entries, edits.limit(0))[0].count() == 4


def test_edits_meet_entries_without_broadcast_and_by_more_tasks_with_more_rows(spark):
    text = F.lit(None).cast("string")
    entries = spark.range(900).select("id", F.lit("c").alias("crop"), F.lit(1).alias("index"), F.lit("k").alias("key"), F.lit("label").alias("role"), *[text.alias(c) for c in ("label_class", "axes", "reader", "dataset", "dtype", "orientation")], F.array().cast("array<string>").alias("transforms"))
    # the same number may order edits of two records
    edits = spark.range(900).select(F.lit(1).cast("long").alias("ord"), "id", F.lit("c").alias("crop"), F.lit("k").alias("target"), F.lit("axes").alias("setting"), F.col("id").cast("string").alias("value"), text.alias("reason"))
    after, log = planning.edited(entries, edits)
    assert "BroadcastHashJoin" not in log._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["id"], r["value"], r["refusal"]) for r in log.collect()) == [(k, str(k), None) for k in range(900)]
    assert all(r["axes"] == str(r["id"]) for r in after.collect())
    assert [storage.dealt(edits, n, "id").rdd.getNumPartitions() for n in (0, 1_500_000, 3_000_000)] == [1, 11, 21]



def tiff_file(order, big, at, bits=(16, 16, 16)):
    """A TIFF whose directory begins at ``at``, its bits per sample behind it."""
    import struct

    e = "<" if order == "II" else ">"
    size = 20 if big else 12
    head = order.encode() + (struct.pack(e + "HHHQ", 43, 8, 0, at) if big else struct.pack(e + "HI", 42, at))
    tags = [(256, 4, 1, 640), (257, 4, 1, 480), (258, 3, 3, at + (8 if big else 2) + 5 * size + 8), (277, 3, 1, 3), (339, 3, 1, 1)]
    rows = b""
    for tag, kind, count, value in tags:
        inline = struct.pack(e + ("Q" if big else "I"), value) if count > 1 or kind == 4 else struct.pack(e + "H", value).ljust(8 if big else 4, b"\0")
        if count > 1 and big:  # six bytes fit into the entry
            inline = struct.pack(e + "3H", *bits).ljust(8, b"\0")
        if kind == 4 and big:
            inline = struct.pack(e + "I", value).ljust(8, b"\0")
        rows += struct.pack(e + ("HHQ" if big else "HHI"), tag, kind, count) + inline
    directory = struct.pack(e + ("Q" if big else "H"), 5) + rows + bytes(8) + struct.pack(e + "3H", *bits)
    return head.ljust(at, b"\0") + directory


def test_a_directory_at_the_end_of_a_tiff_is_read(spark):
    places = [16, 300, 256 * 1024 - 30, 256 * 1024, 700_000]
    files = [(f"{order}{big}{at}", tiff_file(order, big, at)) for order in ("II", "MM") for big in (False, True) for at in places]
    files += [("cut", tiff_file("II", False, 700_000)[:500_000]), ("short.tif", b"II*\0"), ("none", None)]
    got = {r["path"]: r for r in headers.probe(spark.createDataFrame(files, "path string, content binary")).collect()}
    for name, _ in files[:-3]:
        h = got[name]["header"]
        assert got[name]["format"] == "tiff" and h["problem"] is None and (h["shape"], h["dtype"], h["axes"]) == ([480, 640, 3], "uint16", "yxs"), (name, h)
    assert all(got[n]["header"]["problem"] for n in ("cut", "short.tif", "none"))


def test_small_chunks_are_read_many_a_partition(spark, tmp_path):
    vox = spark.range(4096).selectExpr("cast(id div 64 AS int) AS z", "cast(id div 8 % 8 AS int) AS y", "cast(id % 8 AS int) AS x", "id % 50 AS v")
    voxels.write(vox, str(tmp_path / "a"), (64, 8, 8), "uint16", chunk=(1, 2, 2))
    found = voxels.read(spark, str(tmp_path / "a"))
    assert found.rdd.getNumPartitions() <= 5 * spark.sparkContext.defaultParallelism
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, vox.collect()))


def test_a_run_reads_its_state_once_whatever_the_number_of_steps(spark, monkeypatch):
    calls, state = [], planning.Runner.state
    monkeypatch.setattr(planning.Runner, "state", lambda self: calls.append(1) or state(self))
    steps = spark.createDataFrame([(c, k) for c in "ab" for k in (1, 2, 4, 5)], "crop string, step int")
    runner = planning.Runner(spark, storage.new_folder(spark, "run"))
    bad = (F.col("crop") == "b") & (F.col("step") == 4)
    do = lambda due: due.select("crop", "step", F.when(bad, "error").otherwise("success").alias("status"), F.lit(None).cast("string").alias("message"))
    assert runner.run(steps, do) == 7
    assert len(calls) == 1
    assert runner.run(steps, do) == 0
    good = lambda due: due.select("crop", "step", F.lit("success").alias("status"), F.lit(None).cast("string").alias("message"))
    assert runner.run(steps, good, retry=True) == 2
    assert {r["status"] for r in runner.summary(steps).collect()} == {"done"}
