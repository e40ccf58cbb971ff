"""Headers of image and volume files: format, shape, type and voxel size in nanometres.

``sniff`` and the JSON formats (zarr, N5, precomputed) are column expressions; binary headers are
decoded from the file's first bytes in Arrow batches (``HEAD`` bytes, and those around a TIFF's directory, reach the workers, never the
whole file).
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructType

HEAD, TAIL = 256 * 1024, 64 * 1024
VOXEL = StructType().add("x", DoubleType()).add("y", DoubleType()).add("z", DoubleType())
HEADER = (
    StructType()
    .add("shape", ArrayType(LongType()))
    .add("axes", StringType())
    .add("dtype", StringType())
    .add("compression", StringType())
    .add("orientation", IntegerType())
    .add("voxel_size_nm", VOXEL)
    .add("problem", StringType())
)

# Fixed values of the file formats.
MRC_MODES = {0: "int8", 1: "int16", 2: "float32", 3: "complex32", 4: "complex64", 6: "uint16", 12: "float16", 101: "uint4"}
NIFTI_TYPES = {2: "uint8", 4: "int16", 8: "int32", 16: "float32", 64: "float64", 256: "int8", 512: "uint16", 768: "uint32"}
NIFTI_UNITS = {1: 1e9, 2: 1e6, 3: 1e3}
PNG_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
TIFF_COMPRESSION = {1: "none", 5: "lzw", 7: "jpeg", 8: "deflate", 32773: "packbits", 32946: "deflate", 50000: "zstd"}
TIFF_KINDS = {1: "uint", 2: "int", 3: "float"}
UNIT_NM = {"nanometer": 1.0, "nm": 1.0, "micrometer": 1e3, "um": 1e3, "µm": 1e3, "millimeter": 1e6, "mm": 1e6, "angstrom": 0.1, "meter": 1e9, "m": 1e9}
#: Fixed beginnings of files (hexadecimal, from a byte counted from 1) and name endings, in order.
MAGIC = (
    ("tiff", ((1, "49492A00"), (1, "4D4D002A"), (1, "49492B00"), (1, "4D4D002B")), ()),
    ("png", ((1, "89504E470D0A1A0A"),), ()),
    ("jpeg", ((1, "FFD8"),), ()),
    ("hdf5", ((1, "894844460D0A1A0A"),), (".h5", ".hdf5", ".hdf")),
    ("mrc", ((209, "4D415020"),), (".mrc", ".rec", ".st", ".map", ".mrcs", ".ali", ".preali")),
    ("nifti-gz", (), (".nii.gz",)),
    ("nifti", ((345, "6E2B3100"), (345, "6E693100")), (".nii",)),
    ("zip", ((1, "504B0304"),), ()),
)


def sniff(name: Column, content: Column) -> Column:
    """Format by first bytes or name ending; ``html`` for pages served in a file's place, else null."""
    low = F.lower(F.coalesce(name, F.lit("")))
    out = F.when(F.lower(F.ltrim(F.decode(F.substring(content, 1, 64), "ISO-8859-1"))).rlike("^(<!doctype html|<html)"), "html")
    for kind, magics, endings in MAGIC:
        hit = F.lit(False)
        for at, code in magics:
            hit = hit | (F.hex(F.substring(content, at, len(code) // 2)) == code)
        for ending in endings:
            hit = hit | low.endswith(ending)
        out = out.when(F.coalesce(hit, F.lit(False)), kind)
    return out


def png_size(content: Column) -> Column:
    """``struct<width, height>`` out of a PNG's first chunk; nulls where there is none."""
    number = lambda at: F.conv(F.hex(F.substring(content, at, 4)), 16, 10).cast("long")
    there = F.hex(F.substring(content, 1, 8)) == "89504E470D0A1A0A"
    return F.struct(F.when(there, number(17)).alias("width"), F.when(there, number(21)).alias("height"))


def _voxel(x: float, y: float, z: float | None) -> dict | None:
    return {"x": round(float(x), 4), "y": round(float(y), 4), "z": None if z is None else round(float(z), 4)}


def _field(head: bytes, at: int, kind: str, n: int = 1) -> np.ndarray:
    return np.frombuffer(head, kind, n, at)


def mrc(head: bytes) -> dict:
    e = ">" if head[212:213] == b"\x11" else "<"
    nx, ny, nz, mode = (int(v) for v in _field(head, 0, e + "i4", 4))
    grid, cell = _field(head, 28, e + "i4", 3), _field(head, 40, e + "f4", 3)
    deep, known = nz > 1, bool((grid[:2] > 0).all() and (cell[:2] > 0).all())
    with np.errstate(all="ignore"):
        nm = cell / grid / 10
    z = nm[2] if deep and grid[2] > 0 and cell[2] > 0 else None
    return {
        "shape": [nz, ny, nx] if deep else [ny, nx], "axes": "zyx" if deep else "yx", "dtype": MRC_MODES.get(mode, f"mode{mode}"),
        "compression": "none", "voxel_size_nm": _voxel(nm[0], nm[1], z) if known else None,
    }


def nifti(head: bytes) -> dict:
    packed = head[:2] == b"\x1f\x8b"
    if packed:
        head = zlib.decompressobj(31).decompress(head, 352)
    e = "<" if _field(head, 0, "<i4")[0] == 348 else ">"
    dims, sizes = _field(head, 40, e + "i2", 8), _field(head, 76, e + "f4", 8)
    n, code, unit = int(dims[0]), int(_field(head, 70, e + "i2")[0]), NIFTI_UNITS.get(head[123] & 7)
    return {
        "shape": [int(v) for v in dims[n:0:-1]], "axes": "tzyx"[-n:] if 0 < n <= 4 else None, "dtype": NIFTI_TYPES.get(code, f"code{code}"),
        "compression": "gzip" if packed else "none",
        "voxel_size_nm": _voxel(sizes[1] * unit, sizes[2] * unit, sizes[3] * unit if n >= 3 else None) if unit else None,
    }


def png(head: bytes) -> dict:
    w, h = (int(v) for v in _field(head, 16, ">u4", 2))
    depth, c = head[24], PNG_CHANNELS.get(head[25], 1)
    more = c > 1
    return {"shape": [h, w] + [c] * more, "axes": "yx" + "s" * more, "dtype": {16: "uint16", 1: "bool"}.get(depth, "uint8"), "compression": "deflate"}


def jpeg(head: bytes) -> dict:
    """The first frame header (start-of-frame marker 0 to 3), found by the segments' lengths."""
    at = 2
    while at + 10 <= len(head):
        if head[at] != 0xFF or head[at + 1] in (0xFF, 0x00):
            at += 1
        elif head[at + 1] in range(0xC0, 0xC4):
            h, w = (int(v) for v in _field(head, at + 5, ">u2", 2))
            bits, c = head[at + 4], head[at + 9]
            return {"shape": [h, w] + [c] * (c > 1), "axes": "yx" + "s" * (c > 1), "dtype": f"uint{bits}", "compression": "jpeg"}
        else:
            at += 2 + int(_field(head, at + 2, ">u2")[0])
    return {"problem": "no frame header in the first bytes"}


def tiff(head: bytes, tail: bytes = b"", start: int = 0) -> dict:
    """The first page's tags, of classic and big files. ``tail``: the bytes from ``start`` on, where the
    directory lies if not among the first ones."""

    def get(place: int, size: int) -> bytes:
        for block, first in ((head, 0), (tail, start)):
            if first <= place and place + size <= first + len(block):
                return block[place - first : place - first + size]
        raise ValueError("outside what was read")

    e = "<" if head[:2] == b"II" else ">"
    number = lambda place, kind: int(np.frombuffer(get(place, np.dtype(kind).itemsize), e + kind)[0])
    big = number(2, "u2") == 43
    at = number(8, "u8") if big else number(4, "u4")
    n = number(at, "u8" if big else "u2")
    width = "u8" if big else "u4"
    entry = np.dtype([("tag", e + "u2"), ("kind", e + "u2"), ("count", e + width), ("value", "V8" if big else "V4")])
    tags: dict[int, int] = {}
    for row in np.frombuffer(get(at + (8 if big else 2), n * entry.itemsize), entry):
        raw, kind, count = row["value"].tobytes(), int(row["kind"]), int(row["count"])
        unit = {1: "u1", 3: "u2", 4: "u4", 16: "u8"}.get(kind)
        if unit is None or not count:
            continue
        if np.dtype(unit).itemsize * count > len(raw):  # the values lie elsewhere; the first one is enough
            try:
                raw = get(int(np.frombuffer(raw, e + width)[0]), np.dtype(unit).itemsize)
            except ValueError:
                if int(row["tag"]) in (258, 339):  # the type depends on it
                    raise
                continue
        tags[int(row["tag"])] = int(np.frombuffer(raw, e + unit, 1)[0])
    c, bits = tags.get(277, 1), tags.get(258, 1)
    kind = TIFF_KINDS.get(tags.get(339, 1), "uint")
    return {
        "shape": [tags[257], tags[256]] + [c] * (c > 1), "axes": "yx" + "s" * (c > 1), "dtype": "bool" if bits == 1 else f"{kind}{bits}",
        "compression": TIFF_COMPRESSION.get(tags.get(259, 1), f"code{tags.get(259)}"), "orientation": tags.get(274, 1),
    }


def tiff_directory(content: Column) -> Column:
    """Where the first directory of a TIFF begins, from 0; null if the file is no TIFF or too short to say."""
    first = F.hex(F.substring(content, 1, 16))
    little, big = F.startswith(first, F.lit("4949")), F.substring(first, 5, 4).isin("2B00", "002B")
    digits = F.when(big, F.substring(first, 17, 16)).otherwise(F.substring(first, 9, 8))
    pairs = F.regexp_extract_all(digits, F.lit("(..)"), F.lit(1))
    place = F.conv(F.array_join(F.when(little, F.reverse(pairs)).otherwise(pairs), ""), 16, 10).try_cast("long")
    return F.when(F.substring(first, 1, 8).isin("49492A00", "4D4D002A", "49492B00", "4D4D002B") & (digits != ""), place)


READERS = {"mrc": mrc, "nifti": nifti, "nifti-gz": nifti, "png": png, "jpeg": jpeg, "tiff": tiff}


@F.pandas_udf(HEADER)
def _decode(kinds: pd.Series, heads: pd.Series, tails: pd.Series, starts: pd.Series) -> pd.DataFrame:
    columns = HEADER.fieldNames()
    rows = []
    for kind, head, tail, start in zip(kinds, heads, tails, starts, strict=True):
        try:
            if kind == "tiff" and tail is not None:
                found = tiff(head, tail, int(start))
            else:
                found = READERS[kind](head) if kind in READERS and head is not None else {"problem": "no reader"}
        except (ValueError, IndexError, KeyError, zlib.error) as e:
            found = {"problem": f"unreadable header: {type(e).__name__}"}
        rows.append([found.get(c) for c in columns])
    out = pd.DataFrame(rows, columns=columns, dtype="object")
    return out.assign(orientation=out["orientation"].astype("Int32"))


def probe(files: DataFrame, name: str = "path", content: str = "content") -> DataFrame:
    """``files`` with ``format`` and the struct ``header``; a short, null, empty or unknown file has
    ``header.problem`` instead of values. ``content`` itself is dropped. Of a TIFF whose directory lies further on, the
    bytes around it are read as well."""
    whole = F.col(content)
    head = F.substring(whole, 1, HEAD)
    kind = sniff(F.col(name), head)
    place = tiff_directory(whole)
    far = (place + TAIL > HEAD) & (place < F.octet_length(whole))
    start = F.greatest(place - TAIL, F.lit(0))
    tail = F.when(far, F.substring(whole, (start + 1).cast("int"), 2 * TAIL))
    return files.withColumns({"format": kind, "header": _decode(kind, head, tail, F.coalesce(start, F.lit(0)))}).drop(content)


ZARR = (
    "zarr_format int, shape array<bigint>, chunks array<bigint>, dtype string, data_type string, dimension_names array<string>, "
    "chunk_grid struct<configuration:struct<chunk_shape:array<bigint>>>"
)
OME = (
    "multiscales array<struct<axes:array<struct<name:string,unit:string>>,datasets:array<struct<path:string,"
    "coordinateTransformations:array<struct<type:string,scale:array<double>,translation:array<double>>>>>>>"
)


def zarr_array(json: Column) -> Column:
    """Shape, chunks and type of an array's metadata, versions 2 and 3."""
    a = F.from_json(json, ZARR)
    chunks = F.coalesce(a["chunks"], a["chunk_grid"]["configuration"]["chunk_shape"])
    return F.struct(a["zarr_format"].alias("version"), a["shape"].alias("shape"), chunks.alias("chunks"), F.coalesce(a["data_type"], a["dtype"]).alias("dtype"))


def ome_scale(json: Column) -> Column:
    """Axes, levels, first scale and translation, and voxel size in nm of a multiscale group; the
    attributes may lie at the top, under ``attributes`` or under ``ome`` in either."""
    at = OME.replace(" ", ":", 1)
    parsed = F.from_json(json, f"{OME}, ome struct<{at}>, attributes struct<{at},ome:struct<{at}>>")
    units = F.create_map(*[F.lit(v) for pair in UNIT_NM.items() for v in pair])

    def described(o: Column) -> Column:
        groups = F.coalesce(o["multiscales"], o["ome"]["multiscales"], o["attributes"]["multiscales"], o["attributes"]["ome"]["multiscales"])
        m = F.try_element_at(groups, F.lit(1))
        level = F.try_element_at(m["datasets"], F.lit(1))
        first = lambda kind: F.try_element_at(F.filter(level["coordinateTransformations"], lambda t: t["type"] == kind), F.lit(1))[kind]
        scale = first("scale")
        sizes = F.zip_with(m["axes"], scale, lambda a, s: F.struct(a["name"].alias("name"), F.round(s * F.try_element_at(units, F.lower(a["unit"])), 4).alias("nm")))
        along = lambda axis: F.try_element_at(F.filter(sizes, lambda p: p["name"] == axis), F.lit(1))["nm"]
        return F.struct(
            F.array_join(F.transform(m["axes"], lambda a: F.substring(a["name"], 1, 1)), "").alias("axes"),
            F.size(m["datasets"]).alias("levels"), scale.alias("scale"), first("translation").alias("translation"),
            F.struct(*[along(a).alias(a) for a in "xyz"]).alias("voxel_size_nm"),
        )

    # an element of an array, so that the text is parsed once for all that is read out of it
    return F.get(F.transform(F.array(parsed), described), F.lit(0))


def n5_array(json: Column) -> Column:
    """Shape and chunks (slowest axis first), type and compression of an N5 array."""
    a = F.from_json(json, "dimensions array<bigint>, blockSize array<bigint>, dataType string, compression struct<type:string>")
    return F.struct(
        F.reverse(a["dimensions"]).alias("shape"), F.reverse(a["blockSize"]).alias("chunks"), a["dataType"].alias("dtype"),
        F.coalesce(a["compression"]["type"], F.lit("none")).alias("compression"),
    )


def precomputed(json: Column) -> Column:
    """Shape (channels last if several), type, voxel size and levels of a precomputed volume."""
    a = F.from_json(json, "type string, data_type string, num_channels bigint, scales array<struct<size:array<bigint>,resolution:array<double>,encoding:string>>")
    s = F.try_element_at(a["scales"], F.lit(1))
    many = F.coalesce(a["num_channels"], F.lit(1)) > 1
    shape = F.when(many, F.concat(F.reverse(s["size"]), F.array(a["num_channels"]))).otherwise(F.reverse(s["size"]))
    return F.struct(
        a["type"].alias("layer"), a["data_type"].alias("dtype"), shape.alias("shape"), F.when(many, "zyxc").otherwise("zyx").alias("axes"),
        s["encoding"].alias("compression"), F.struct(*[F.get(s["resolution"], F.lit(i)).alias(a_) for i, a_ in enumerate("xyz")]).alias("voxel_size_nm"),
        F.size(a["scales"]).alias("levels"),
    )
