"""Small cases of the catalog operators, against brute force where there is no SQL."""

from __future__ import annotations

import difflib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.functions import text
from lumenframe.operators import arrays, keys, monitor, ranking, select


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize(
    ("url", "norm"),
    [
        ("https://www.Example.com/A/b/?Q=1#frag", "example.com/a/b?q=1"),
        ("http://example.com/", "example.com"),
        (" ftp://h/x// ", "h/x"),
        ("", None),
        (None, None),
    ],
)
def test_url_normalize(spark, url, norm):
    assert one(spark, url, text.url_normalize) == norm


@pytest.mark.parametrize(("raw", "out"), [("A – B  (c)!", "a b c"), ("", ""), (None, "")])
def test_title_normalize(spark, raw, out):
    assert one(spark, raw, text.title_normalize) == out


@pytest.mark.parametrize(
    ("n", "human", "bucket"),
    [(0, "0 B", "<1GB"), (999, "999 B", "<1GB"), (1500, "1.5 KB", "<1GB"), (10**9, "1.0 GB", "1-10GB"),
     (10**10, "10.0 GB", "10-50GB"), (5 * 10**11, "500.0 GB", ">500GB"), (2 * 10**12, "2.0 TB", ">500GB"), (None, "unknown", "unknown")],
)
def test_sizes(spark, n, human, bucket):
    row = spark.createDataFrame([(n,)], "n bigint").select(text.human_size(F.col("n")), text.size_bucket(F.col("n"))).first()
    assert tuple(row) == (human, bucket)


@pytest.mark.parametrize(
    ("path", "ext"), [("a/b.ome.tiff", "ome.tiff"), ("a.b/c", "(none)"), ("x.TIF", "tif"), ("s.nii.gz", "nii.gz"), ("d/.hidden", "hidden")]
)
def test_extension(spark, path, ext):
    assert one(spark, path, text.extension) == ext


@pytest.mark.parametrize(
    ("pattern", "path", "hit"),
    [("raw/NNN.tif", "a/raw/012.tif", True), ("raw/NNN.tif", "raw/x.tif", False), ("{a,b}/*.png", "b/q.png", True),
     ("*.png", "d/e.png", True), ("<s>/<s>.tif", "q/q.tif", True), ("<s>/<s>.tif", "q/r.tif", False)],
)
def test_path_pattern(spark, pattern, path, hit):
    assert one(spark, path, lambda c: c.rlike(text.path_pattern(pattern))) is hit


def test_fuzzy_titles_lose_no_pair(spark):
    rng = random.Random(4)
    words = ["cell", "nuclei", "dataset", "mouse", "brain", "electron", "microscopy", "segmentation", "volume", "images"]
    titles = []
    for _ in range(40):
        t = " ".join(rng.choice(words) for _ in range(rng.randint(1, 12)))
        titles.append(t)
        for _ in range(2):
            s = list(t)
            for _ in range(rng.randint(0, 4)):
                k = rng.randrange(len(s) + 1)
                s[k : k + rng.randint(0, 1)] = rng.choice(["", "x", "s"])
            titles.append("".join(s))
    titles += ["", None, "!!!", titles[0]]
    rows = spark.createDataFrame(list(enumerate(titles)), "id long, title string")
    norm = {r["id"]: r["t"] for r in rows.select("id", text.title_normalize(F.col("title")).alias("t")).collect() if r["t"]}
    first = {}
    for k in sorted(norm):
        first.setdefault(norm[k], k)
    want = set()
    for (ta, a), (tb, b) in itertools.combinations(sorted(first.items(), key=lambda x: x[1]), 2):
        if difflib.SequenceMatcher(None, ta, tb).ratio() >= 0.92:
            want.add((a, b))
    got = {(r["a"], r["b"]) for r in keys.fuzzy_titles(rows, "id", "title").collect()}
    assert got == want
    assert want


def test_shared_keys_with_nulls_and_ties(spark):
    rows = spark.createDataFrame([("k", 1), ("k", 3), ("k", 3), (None, 1), (None, 2), ("z", 9)], "key string, ord long")
    got = sorted(tuple(r) for r in keys.shared_keys(rows).collect())
    assert got == [("k", 1, 3), ("k", 1, 3)]


def test_identity_keys(spark):
    rows = spark.createDataFrame(
        [("10.1/AB", "Zen", "7", "https://x/"), (None, "Zen", "7", "https://x/"), (None, "Zen", "", "https://WWW.x/a/"), (None, None, None, None)],
        "doi string, repo string, acc string, url string",
    )
    got = [r[0] for r in rows.select(keys.identity_keys(F.col("doi"), F.col("repo"), F.col("acc"), F.col("url"))).collect()]
    assert got == [["doi:10.1/ab", "acc:zen:7"], ["acc:zen:7"], ["url:x/a"], []]


@pytest.mark.parametrize(
    ("voxel", "shape", "plan"),
    [((1, 1, 1), (512, 512, 512), [(2, 2, 2)]), ((4, 1, 1), (100, 1024, 1024), [(1, 2, 2), (1, 2, 2)]), ((1, 1, 1), (1, 256, 256), []),
     ((1, 1, 1), (1, 600, 600), [(1, 2, 2), (1, 2, 2)])],
)
def test_level_plan(spark, voxel, shape, plan):
    got = spark.range(1).select(arrays.level_plan(F.array(*map(F.lit, voxel)), F.array(*map(F.lit, shape)))).first()[0]
    assert got == [list(f) for f in plan]


def test_central_crop_fits_and_snaps(spark):
    of = lambda *n: F.array(*map(F.lit, n))
    crop = spark.range(1).select(arrays.central_crop(of(100, 1000, 1000), 2, of(32, 64, 64), 4_000_000)).first()[0]
    assert 2 * np.prod([b - a for a, b in crop]) <= 4_000_000
    assert all(a % c == 0 for (a, _), c in zip(crop, [32, 64, 64], strict=True))


def _volume(spark, a):
    rows = [(0, *(int(i) for i in at), float(v)) for at, v in np.ndenumerate(a)]
    return spark.createDataFrame(rows, "crop long, z int, y int, x int, v double")


def _array(df, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r["z"], r["y"], r["x"]] = r["v"]
    return out


def test_downsampling_matches_numpy(spark):
    a = np.random.default_rng(1).integers(0, 3, (3, 5, 4)).astype(float)
    padded = np.pad(a, ((0, 1), (0, 1), (0, 0)), mode="edge")
    blocks = padded.reshape(2, 2, 3, 2, 2, 2).transpose(0, 2, 4, 1, 3, 5).reshape(2, 3, 2, 8)
    mean = _array(arrays.down_mean(_volume(spark, a), a.shape, (2, 2, 2)), (2, 3, 2))
    assert np.allclose(mean, blocks.mean(-1))
    mode = _array(arrays.down_mode(_volume(spark, a), a.shape, (2, 2, 2)), (2, 3, 2))
    for at in np.ndindex(2, 3, 2):
        n = {v: (blocks[at] == v).sum() - (0.5 if v == 0 else 0) for v in np.unique(blocks[at])}
        assert mode[at] == min(n, key=lambda v: (-n[v], v))


@pytest.mark.parametrize("name", ["flip z", "flip y", "flip x", "rotate 180", "transpose"])
def test_remap_matches_numpy(spark, name):
    a = np.arange(2 * 3 * 3.0).reshape(2, 3, 3)
    want = {"flip z": a[::-1], "flip y": a[:, ::-1], "flip x": a[:, :, ::-1], "rotate 180": a[:, ::-1, ::-1], "transpose": a.transpose(0, 2, 1)}[name]
    assert np.array_equal(_array(arrays.remap(_volume(spark, a), a.shape, name), a.shape), want)


def test_best_shift_finds_a_known_one(spark):
    rng = np.random.default_rng(2)
    lab = np.zeros((1, 20, 20), int)
    lab[0, 6:12, 7:13] = 1
    image = np.roll(lab, (1, -2), (1, 2)) + rng.normal(0, 0.05, lab.shape)
    df = spark.createDataFrame([(5, image.ravel().tolist(), lab.ravel().tolist())], "crop long, v array<double>, lab array<int>")
    assert tuple(arrays.best_shift(df, (1, 20, 20)).first()) == (5, 0, 1, -2)


def test_upsert_keeps_the_newest_row(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 1, "c"), (1, 7, "d")], "id long, at long, v string")
    got = {r["id"]: r["v"] for r in monitor.upsert(rows, "id", F.col("at"), F.col("v")).collect()}
    assert got == {1: "d", 2: "c"}


def test_split_shares_and_empty_table(spark):
    d = spark.range(100).withColumn("g", (F.col("id") % 2).cast("string"))
    out = select.split(d, "id", ["g"], F.xxhash64("id"), {"train": 0.8, "val": 0.1, "test": 0.1}, F.lit(False))
    n = {(r["g"], r["split"]): r["count"] for r in out.groupBy("g", "split").count().collect()}
    assert n == {(g, s): c for g in "01" for s, c in (("train", 40), ("val", 5), ("test", 5))}
    assert select.split(d.limit(0), "id", ["g"], F.xxhash64("id"), {"train": 1.0}, F.lit(False)).count() == 0


def test_human_size_is_the_binary_quotient(spark):
    rng = np.random.default_rng(1)
    n = [k * 50 for k in range(1, 20_000)] + [k * 50_000 for k in range(1, 4000)] + rng.integers(1000, 10**15, 2000).tolist()
    rows = spark.createDataFrame([(int(k),) for k in n], "n bigint").select("n", text.human_size(F.col("n")).alias("t")).collect()

    def plain(k):
        for power, unit in ((0, "B"), (1, "KB"), (2, "MB"), (3, "GB")):
            if k / 1000**power < 1000:
                return f"{k / 1000**power:.{min(power, 1)}f} {unit}"
        return f"{k / 1000**4:.1f} TB"

    assert not [(r["n"], r["t"], plain(r["n"])) for r in rows if r["t"] != plain(r["n"])]


@pytest.mark.parametrize(
    ("pattern", "fits", "misses"),
    [
        ("a/*.tif", ["a/x.tif", "z/a/b/x.tif", "x.tif"], ["a/x.tiff", "b.tif/c"]),
        ("img_NNN.{tif,png}", ["img_7.tif", "q/img_12.png"], ["img_7.jpg"]),
        ("zip::raw/<id>/##.h5 (volume)", ["raw/1/02.h5", "x/raw/a/b/3.h5"], ["raw.h5x"]),
        ("a.tif, b.tif", ["a.tif", "x/b.tif"], ["c.tif"]),
        ("s?c.x", ["sec.x", "s.c.x"], ["sc.x"]),
    ],
)
def test_listing_patterns(spark, pattern, fits, misses):
    df = spark.createDataFrame([(p,) for p in fits + misses], "p string")
    got = {r["p"] for r in df.where(F.col("p").rlike(text.listing_pattern(pattern))).collect()}
    assert got == set(fits)


def test_entities_of_any_kind(spark):
    df = spark.createDataFrame([("<p>caf&eacute; &#8217;n&#x27; &amp;lt; a&nbsp;b</p>",), ("x &lt; y &amp; z",), (None,)], "t string")
    assert [r[0] for r in df.select(text.strip_html(F.col("t"))).collect()] == ["caf\u00e9 \u2019n' &lt; a b", "x < y & z", None]


def test_ranks_in_strata(spark):
    rng = np.random.default_rng(2)
    rows = [(k, "ab"[k % 2] if k % 7 else None, None if k % 50 == 0 else float(rng.integers(0, 90))) for k in range(600)]
    got = ranking.ranked(spark.createDataFrame(rows, "id long, g string, v double").repartition(5), F.col("v"), "id", ["g"], 16).collect()
    for g in ("a", "b", None):
        want = sorted((v is not None, v or 0, k) for k, s, v in rows if s == g)
        mine = sorted((r["rank"], r["id"]) for r in got if r["g"] == g)
        assert [i for _, i in mine] == [k for _, _, k in want]
        assert {r["total"] for r in got if r["g"] == g} == {len(want)}
        assert [k for k, _ in mine] == list(range(len(want)))


def test_globs_over_folders(spark):
    df = spark.createDataFrame([("a/b",), ("a/x/b",), ("a/x/y/b",), ("ab",)], "p string")
    assert [r[0] for r in df.where(select.glob_any(F.col("p"), ["a/**/b"])).collect()] == ["a/b", "a/x/b", "a/x/y/b"]


def test_similar_records_against_all_pairs(spark):
    rng = random.Random(8)
    base = ["fly brain electron volume", "mouse cortex light sheet atlas of cells", "zebrafish larva heart beat stack", "cell tracking challenge set one"]
    rows = []
    for k in range(40):
        t = rng.choice(base) + rng.choice(["", " v2", " part b of many", "!"])
        ids = rng.choice([None, [], [f"doi:10/{k % 6}"], [f"acc:z:{k}"]])
        rows.append((k, rng.choice([None, "", f"https://www.x.org/{k % 9}/", f"http://x.org/{k % 9}"]), rng.choice([t, t.upper(), None]),
                     rng.choice(["Zenodo", "Other", None]), ids, rng.choice([None, [], ["10/P"], ["10/p", "10/Q"]])))
    schema = "id long, download_url string, title string, repository string, ids array<string>, dois array<string>"
    got = {(r["a"], r["b"]): r["reasons"] for r in keys.similar_records(spark.createDataFrame(rows, schema)).collect()}
    norm = lambda t: " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in (t or "").lower()).split())

    def overlap(x, y):
        x, y = x.split(), y.split()
        n = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
        return len(set(x[n:]) & set(y[n:])) / len(set(x[n:]) | set(y[n:])) if set(x[n:]) | set(y[n:]) else 1.0

    want = {}
    for i, j in itertools.combinations(range(len(rows)), 2):
        (_, ua, ta, ra, ia, pa), (_, ub, tb, rb, ib, pb) = rows[i], rows[j]
        found, ta, tb = [], norm(ta), norm(tb)
        if ua and ub and ua.split("x.org")[1].strip("/") == ub.split("x.org")[1].strip("/"):
            found.append("same download URL")
        if ia and ib and not set(ia) & set(ib):
            if ta and ta == tb and ra == rb == "Zenodo":
                found.append("same title on Zenodo (another version?)")
        elif ta and tb:
            r = difflib.SequenceMatcher(None, ta, tb).ratio()
            both = sorted({p.lower() for p in pa or []} & {p.lower() for p in pb or []})
            if r >= 0.92:
                found.append(f"title {r:.0%} similar")
            elif both and overlap(ta, tb) >= 0.5:
                found.append(f"same paper ({', '.join(both)}) and similar title")
        if found:
            want[(i, j)] = found
    assert got == want


def test_folders_in_globs_may_be_none(spark):
    rows = spark.createDataFrame([("a.tif",), ("x/a.tif",), ("x/y/a.tif",), ("x/b.tif",)], "p string")
    fits = lambda *globs: {r["p"] for r in rows.where(select.glob_any(F.col("p"), globs)).collect()}
    assert fits("**/a.tif") == {"a.tif", "x/a.tif", "x/y/a.tif"} and fits("x/**/a.tif") == {"x/a.tif", "x/y/a.tif"} and fits("*.tif") == {"a.tif"}


def test_notes_of_the_planner_bar_nothing(spark):
    from lumenframe.functions import readiness as rd

    record = "struct<dimensionality: string>"
    rows = spark.createDataFrame([(("3D",), [], ["note: few"]), (("3D",), [], ["note: few", "no raw"]), (("3D",), [], None), (("2D",), [], ["note: few"])], f"r {record}, found array<string>, planned array<string>")
    status, every = rd.readiness(F.col("r"), F.col("found"), F.col("planned"))
    got = [tuple(r) for r in rows.select(status.alias("s"), F.array_join(every, "; ").alias("e")).collect()]
    assert got == [("ready", "note: few"), ("not-ready", "note: few; no raw"), ("unknown", "planner not available"), ("not-ready", "")]


def test_alignment_moves_labels_once_for_all_transforms(spark):
    from lumenframe.operators import arrays as op

    vox = op.voxels(spark.createDataFrame([(k, [float((k * i * i) % 7) for i in range(15 + k % 2)]) for k in range(4)], "crop long, v array<double>"), "crop", "v", (1, 4, 4))
    lab = vox.select("crop", *op.ZYX, (F.col("v") > 3).cast("int").alias("lab"))
    found = op.alignment(vox, lab, (1, 4, 4))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 4  # two lines, each before and after
    # the same scores as one transform at a time, also where voxels are missing
    turned = op.scores(vox, op.remap(lab.withColumnRenamed("lab", "v"), (1, 4, 4), "rotate 180").withColumnRenamed("v", "lab"))
    both = op._scores(vox.join(op._ringed(lab).select("crop", F.lit("rotate 180").alias("name"), *op._moved((1, 4, 4), "rotate 180"), "lab", "ring"), ["crop", *op.ZYX]), "name").drop("name")
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, turned.collect()))
    assert found.count() == 4
