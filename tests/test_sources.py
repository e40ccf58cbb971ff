"""Readers and sinks on small files written by the tests themselves."""

from __future__ import annotations

import io
import json
import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from lumenframe.sources import archives, headers, listings, papers, records


def test_yaml_keeps_dates_and_paths(spark, tmp_path):
    pytest.importorskip("yaml")
    folder = tmp_path / "2D+t"
    folder.mkdir()
    (folder / "a.yaml").write_text("id: a\ndate_published: 2024-01-02\nauthors: [x, y]\n")
    (folder / "b.yaml").write_text("id: [unclosed\n")
    rows = {r["path"].rsplit("/", 1)[1]: r for r in records.read_yaml(spark, str(tmp_path), "id string, date_published string, authors array<string>").collect()}
    assert rows["a.yaml"]["date_published"] == "2024-01-02" and rows["a.yaml"]["authors"] == ["x", "y"]
    assert not rows["b.yaml"]["readable"] and rows["b.yaml"]["id"] is None and "2D+t" in rows["b.yaml"]["path"]


def test_run_logs_local_wins(spark, tmp_path):
    for folder, name, log in (("l", "1", {"routine": "a", "started_at": "1"}), ("s", "1", {"routine": "b", "started_at": "9"}),
                              ("s", "2", {"routine": "c", "started_at": "2"}), ("l", "3", {"routine": "d", "dry_run": True})):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / f"{name}.json").write_text(json.dumps(log))
    (tmp_path / "s" / "bad.json").write_text("{nothing")
    got = records.read_run_logs(spark, str(tmp_path / "l"), str(tmp_path / "s"))
    assert [r["routine"] for r in got.collect()] == ["c", "a"]
    assert records.read_run_logs(spark, str(tmp_path / "l"), dry_runs=True).count() == 2


def test_rejected_keys(spark):
    listed = spark.createDataFrame([(0, "k0"), (1, "k0")], "ord int, key string")
    closed = spark.createDataFrame([(0, "p", 1, ["doi:1", "doi:2"]), (1, "q", 2, ["doi:3"]), (2, "r", 1, ["doi:4"])], "ord int, id string, n int, keys array<string>")
    kept = spark.createDataFrame([("r", ["doi:2"])], "id string, keys array<string>")
    assert [r["key"] for r in records.rejected_keys(listed, closed, kept).collect()] == ["k0", "p", "doi:1"]


def test_upsert_and_sinks(spark, tmp_path):
    state = spark.createDataFrame([("a", "1", "old"), ("b", "5", "old")], "id string, at string, v string")
    new = spark.createDataFrame([("a", "1", "new"), ("b", "2", "new"), ("c", None, "new")], "id string, at string, v string")
    assert {(r["id"], r["v"]) for r in records.upsert(state, new).collect()} == {("a", "new"), ("b", "old"), ("c", "new")}
    recs = spark.createDataFrame([("x", "2D+t", ["confocal"], "</script>"), ("y", "3D", [], "t")], "id string, dimensionality string, modality array<string>, title string")
    records.write_records(recs, str(tmp_path / "r"))
    back = spark.read.parquet(str(tmp_path / "r"))
    assert back.filter("dim_part = '2D+t'").count() == 1 and back.filter("modality_part = 'other'").first()["id"] == "y"
    records.write_site(recs, spark.createDataFrame([("1",), ("2",)], "started_at string"), str(tmp_path / "site"), max_runs=1)
    lines = spark.read.text(str(tmp_path / "site/records")).collect()
    assert not any("</" in r["value"] for r in lines) and any(json.loads(r["value"])["title"] == "</script>" for r in lines)
    assert spark.read.json(str(tmp_path / "site/runs")).first()["started_at"] == "2"


@pytest.mark.parametrize(("text", "want"), [("14K", (14336, False)), (" 1.5 mb ", (1572864, False)), ("20", (20, True)), ("-", (None, False)), ("1.2.3", (None, False)), (None, (None, False))])
def test_parse_size(spark, text, want):
    row = spark.createDataFrame([(text,)], "t string").select(listings.parse_size(F.col("t")).alias("s")).first()["s"]
    assert tuple(row) == want


def test_index_and_ftp_entries(spark):
    table = '<tr><td><a href="../">Parent</a></td></tr><tr><td><a href="a%20b.tif">x</a></td><td>2024</td><td>14K</td></tr><tr><td><a href="d+e/">d</a></td><td>-</td></tr><tr><td><a href="?C=N">n</a></td></tr>'
    pre = '<pre>\n<a href="c.zip">c</a>  01-Jan-2024 10:00   123\n<a href="https://x/y">o</a> 1 2 3\n</pre>'
    df = spark.createDataFrame([(1, table), (2, pre), (3, None), (4, "")], "id int, html string")
    got = {tuple(r) for r in listings.index_entries(df, "html", "id").collect()}
    # The date cell comes before the size cell, so the last cell that is a size counts.
    assert got == {(1, "a b.tif", 14336, False, False), (1, "d+e/", None, False, True), (2, "c.zip", 123, True, False)}
    ftp = spark.createDataFrame([("drwxr-xr-x 2 u g 4096 Jan 1 10:00 sub dir\n-rw-r--r-- 1 u g 12 Jan 1 2024 f.tif\ntotal 3",)], "text string")
    assert {tuple(r) for r in listings.ftp_entries(ftp).collect()} == {("sub dir", None, False, True), ("f.tif", 12, True, False)}


def test_repository_entries(spark):
    df = spark.createDataFrame([('[{"path":"a","type":"file","size":1,"lfs":{"size":99}},{"path":"d","type":"directory"}]',), (None,), ("x",)], "j string")
    assert [tuple(r) for r in listings.repository_entries(df, "j", "tree").collect()] == [("a", 99, True)]


def test_zip(spark):
    def made(*members):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, data, kind in members:
                z.writestr(name, data, kind)
        return out.getvalue()

    data = made(("a/b.txt", b"hello" * 50, zipfile.ZIP_DEFLATED), ("__MACOSX/x", b"1", zipfile.ZIP_STORED), ("d/", b"", zipfile.ZIP_STORED))
    files = spark.createDataFrame([("z.zip", data), ("bad.zip", b"no"), ("null.zip", None)], "path string, content binary")
    rows = {(r["archive"], r["name"]): r for r in archives.zip_members(files).collect()}
    assert set(rows) == {("z.zip", "a/b.txt"), ("bad.zip", None), ("null.zip", None)}
    assert rows["z.zip", "a/b.txt"]["size"] == 250 and rows["z.zip", "a/b.txt"]["method"] == 8 and rows["bad.zip", None]["problem"]
    wanted = spark.createDataFrame([("z.zip", "a/b.txt"), ("z.zip", "none"), ("bad.zip", "q")], "archive string, name string")
    got = {(r["archive"], r["name"]): r for r in archives.read_members(files, wanted, 7).collect()}
    assert bytes(got["z.zip", "a/b.txt"]["data"]) == b"hellohe" and not got["z.zip", "a/b.txt"]["complete"]
    assert got["z.zip", "none"]["problem"] and got["bad.zip", "q"]["problem"]
    listing = spark.createDataFrame([("z.zip", 9), ("o.tif", 1)], "path string, size bigint")
    assert {r["path"] for r in archives.expand_zips(listing, files).filter("in_zip").collect()} == {"z.zip/a/b.txt"}


def test_headers(spark):
    mrc = bytearray(1024)
    struct.pack_into("<4i", mrc, 0, 4, 5, 6, 2)
    struct.pack_into("<3i", mrc, 28, 4, 5, 6)
    struct.pack_into("<3f", mrc, 40, 40, 50, 120)
    nii = bytearray(352)
    struct.pack_into("<i", nii, 0, 348)
    struct.pack_into("<8h", nii, 40, 3, 7, 8, 9, 1, 1, 1, 1)
    struct.pack_into("<h", nii, 70, 4)
    struct.pack_into("<8f", nii, 76, 1, 2, 2, 3, 0, 0, 0, 0)
    nii[123] = 2
    packed = zlib.compressobj(wbits=31)
    gz = packed.compress(bytes(nii)) + packed.flush()
    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sIIBB", 13, b"IHDR", 3, 2, 16, 2)
    jpg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08\x00\x05\x00\x06\x03" + bytes(20)
    tags = [(256, 4, 1, 11), (257, 4, 1, 12), (258, 3, 1, 16), (259, 3, 1, 5), (274, 3, 1, 3)]
    tif = b"II*\0" + struct.pack("<IH", 8, len(tags)) + b"".join(struct.pack("<HHII", *t) for t in tags)
    files = [("a.mrc", bytes(mrc)), ("b.nii", bytes(nii)), ("c.nii.gz", gz), ("d", png), ("e", jpg), ("f", tif), ("g.mrc", b""), ("h", None), ("i", b"<HTML>")]
    got = {r["path"]: r for r in headers.probe(spark.createDataFrame(files, "path string, content binary")).collect()}
    assert got["a.mrc"]["header"]["shape"] == [6, 5, 4] and tuple(got["a.mrc"]["header"]["voxel_size_nm"]) == (1.0, 1.0, 2.0)
    for name in ("b.nii", "c.nii.gz"):
        assert got[name]["header"]["shape"] == [9, 8, 7] and got[name]["header"]["voxel_size_nm"]["z"] == 3e6
    assert got["d"]["header"]["shape"] == [2, 3, 3] and got["d"]["header"]["dtype"] == "uint16"
    assert got["e"]["format"] == "jpeg" and got["e"]["header"]["shape"] == [5, 6, 3]
    assert got["f"]["header"]["shape"] == [12, 11] and got["f"]["header"]["compression"] == "lzw" and got["f"]["header"]["orientation"] == 3
    assert got["g.mrc"]["header"]["problem"] and got["h"]["format"] is None and got["i"]["format"] == "html"


def test_json_formats(spark):
    n5 = '{"dimensions":[1,2,3],"blockSize":[4,5,6],"dataType":"uint8","compression":{"type":"gzip"}}'
    pre = '{"type":"image","data_type":"uint8","num_channels":2,"scales":[{"size":[1,2,3],"resolution":[4,5,6],"encoding":"raw"}]}'
    row = spark.createDataFrame([(n5, pre)], "n string, p string").select(headers.n5_array(F.col("n")).alias("n"), headers.precomputed(F.col("p")).alias("p")).first()
    assert row["n"]["shape"] == [3, 2, 1] and row["n"]["compression"] == "gzip"
    assert row["p"]["shape"] == [3, 2, 1, 2] and row["p"]["voxel_size_nm"]["z"] == 6.0 and row["p"]["levels"] == 1


def test_paper(spark):
    xml = '<article xmlns:xlink="urn:l"><abstract><p>Short  one</p></abstract><sec><title>T</title><p>Body\n text</p></sec><fig><caption><p>Cap</p></caption></fig><ext-link xlink:href="http://x"/></article>'
    df = spark.createDataFrame([(1, xml), (2, None)], "id int, xml string")
    assert {(r["kind"], r["text"]) for r in papers.paper_parts(df, "xml", "id").collect()} == {("abstract", "Short one"), ("title", "T"), ("paragraph", "Body text"), ("caption", "Cap")}
    assert [r["href"] for r in papers.paper_links(df, "xml", "id").collect()] == ["http://x"]
