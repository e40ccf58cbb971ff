"""Arrays in chunks as tables of voxels: a Python data source and sink for zarr (version 3, no shards), and pyramids.

A row is a voxel: a column for each axis and ``v``. Reading makes one partition of some chunks each and drops chunks
that the filters on the axes rule out, so a crop reads only the chunks it cuts. Writing lets each task
put together the chunks whose rows it holds, one at a time; the tasks' messages say how many, and the metadata
is written last, so an array without it was not finished. ``write_multiscale`` writes levels of a pyramid, each
from the stored one before, and ``pyramid_faults`` computes each level again and names what differs by level and chunk.

Files are reached through pyarrow's file systems (local or shared folders, hdfs, s3, gs).
Defined results: a chunk without rows, and a voxel without a row, has the fill value 0; a voxel with several rows
has the last one of its task; rows outside the shape are an error.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from lumenframe.operators.arrays import ZYX, down_mean, down_mode

#: Data types of version 3 with numpy's names, and the Spark types that hold them.
TYPES = {
    "uint8": ("u1", "int"), "uint16": ("<u2", "int"), "uint32": ("<u4", "long"), "int8": ("i1", "int"), "int16": ("<i2", "int"),
    "int32": ("<i4", "int"), "int64": ("<i8", "long"), "float32": ("<f4", "float"), "float64": ("<f8", "double"),
}
CHUNK = 128
#: How many voxels a partition reads, unless the caller says how many chunks.
VOXELS = 1 << 20


def _files(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _read(path: str) -> bytes | None:
    files, at = _files(path)
    try:
        with files.open_input_stream(at) as f:
            return f.read()
    except FileNotFoundError:
        return None


def _write(path: str, data: bytes) -> None:
    files, at = _files(path)
    files.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with files.open_output_stream(at) as f:
        f.write(data)


def metadata(path: str) -> dict:
    found = _read(f"{path}/zarr.json")
    if found is None:
        raise FileNotFoundError(f"{path} has no zarr.json: no array, or one that was not finished")
    return json.loads(found)


@dataclass(frozen=True)
class Layout:
    """Shape, chunk lengths, axes and type of an array."""

    axes: str
    shape: tuple[int, ...]
    chunk: tuple[int, ...]
    dtype: str
    codec: str | None = "zstd"

    @classmethod
    def of(cls, meta: dict) -> Layout:
        codecs = [c["name"] for c in meta["codecs"]]
        encoding = meta["chunk_key_encoding"]
        plain = encoding["name"] == "default" and encoding.get("configuration", {}).get("separator", "/") == "/"
        if not plain or meta["data_type"] not in TYPES or codecs[0] != "bytes" or codecs[1:] not in ([], ["zstd"], ["gzip"]):
            raise ValueError("only plain chunks of numbers, as they are or by zstd or gzip")
        names = meta.get("dimension_names") or list("tczyx"[-len(meta["shape"]) :])
        chunk = meta["chunk_grid"]["configuration"]["chunk_shape"]
        return cls("".join(names), tuple(meta["shape"]), tuple(chunk), meta["data_type"], codecs[1] if len(codecs) > 1 else None)

    @property
    def schema(self) -> str:
        return ", ".join(f"{a} int" for a in self.axes) + f", v {TYPES[self.dtype][1]}"

    @property
    def grid(self) -> tuple[int, ...]:
        return tuple(-(-n // c) for n, c in zip(self.shape, self.chunk, strict=True))

    def meta(self) -> dict:
        codecs: list[dict] = [{"name": "bytes", "configuration": {"endian": "little"}}]
        if self.codec:
            codecs.append({"name": "zstd", "configuration": {"level": 5, "checksum": False}})
        return {
            "zarr_format": 3, "node_type": "array", "shape": list(self.shape), "data_type": self.dtype,
            "chunk_grid": {"name": "regular", "configuration": {"chunk_shape": list(self.chunk)}},
            "chunk_key_encoding": {"name": "default", "configuration": {"separator": "/"}},
            "fill_value": 0, "codecs": codecs, "dimension_names": list(self.axes),
        }

    def file(self, key: Sequence[int]) -> str:
        return "c/" + "/".join(map(str, key))


class ChunkPartition(InputPartition):
    def __init__(self, keys: list[tuple[int, ...]]):
        super().__init__(keys)
        self.keys = keys


class VoxelReader(DataSourceReader):
    """Chunks as partitions; bounds on the axes rule chunks out."""

    def __init__(self, path: str, layout: Layout, each: int):
        self.path, self.layout, self.each = path, layout, each
        self.low = [0] * len(layout.shape)
        self.high = [n - 1 for n in layout.shape]

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = ".".join(getattr(f, "attribute", ()))
            if len(name) == 1 and name in self.layout.axes:
                k = self.layout.axes.index(name)
                value = getattr(f, "value", None)
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.low[k] = max(self.low[k], math.floor(value) + isinstance(f, GreaterThan))
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    self.high[k] = min(self.high[k], math.ceil(value) - isinstance(f, LessThan))
                if isinstance(f, In) and f.value:
                    known = [x for x in f.value if x is not None]
                    self.low[k], self.high[k] = max(self.low[k], min(known, default=0)), min(self.high[k], max(known, default=-1))
            yield f  # Spark still applies it to the voxels

    def partitions(self) -> list[ChunkPartition]:
        spans = [range(lo // c, hi // c + 1) if lo <= hi else range(0) for lo, hi, c in zip(self.low, self.high, self.layout.chunk, strict=True)]
        keys = list(itertools.product(*spans))
        return [ChunkPartition(keys[k : k + self.each]) for k in range(0, len(keys), self.each)] or [ChunkPartition([])]

    def read(self, partition: ChunkPartition) -> Iterator[pa.RecordBatch]:
        layout = self.layout
        numpy_type, spark_type = TYPES[layout.dtype]
        wide = {"int": np.int32, "long": np.int64, "float": np.float32, "double": np.float64}[spark_type]
        size = math.prod(layout.chunk) * np.dtype(numpy_type).itemsize
        for key in partition.keys:
            data = _read(f"{self.path}/{layout.file(key)}")
            if data is None:
                cube = np.zeros(layout.chunk, numpy_type)
            else:
                raw = pa.decompress(data, size, codec=layout.codec) if layout.codec else data
                cube = np.frombuffer(raw, numpy_type).reshape(layout.chunk)
            start = [k * c for k, c in zip(key, layout.chunk, strict=True)]
            # only what lies inside both the shape and the bounds
            low = [max(lo - s, 0) for lo, s in zip(self.low, start, strict=True)]
            high = [min(hi + 1 - s, c) for hi, s, c in zip(self.high, start, layout.chunk, strict=True)]
            cube = cube[tuple(slice(a, b) for a, b in zip(low, high, strict=True))]
            places = np.indices(cube.shape, np.int32).reshape(len(layout.axes), -1)
            columns = [pa.array(p + np.int32(s + a)) for p, s, a in zip(places, start, low, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cube.astype(wide).ravel())], [*layout.axes, "v"])


@dataclass
class Written(WriterCommitMessage):
    chunks: int


class VoxelWriter(DataSourceArrowWriter):
    """Puts chunks together from rows that come sorted by chunk; see ``write``."""

    def __init__(self, path: str, layout: Layout, overwrite: bool):
        self.path, self.layout = path, layout
        if _read(f"{path}/zarr.json") is not None:
            if not overwrite:
                raise FileExistsError(path)
            files, at = _files(path)
            files.delete_dir(at)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        layout, count = self.layout, 0
        current, cube = -1, None
        numpy_type = TYPES[layout.dtype][0]

        def flush() -> None:
            if cube is not None and cube.any():
                raw = cube.tobytes()
                key = np.unravel_index(current, layout.grid)
                _write(f"{self.path}/{layout.file([int(k) for k in key])}", pa.compress(raw, codec=layout.codec, asbytes=True) if layout.codec else raw)

        for batch in iterator:
            if not batch.num_rows:
                continue
            place = np.stack([batch.column(a).to_numpy(zero_copy_only=False) for a in layout.axes])
            limit = np.array(layout.shape)[:, None]
            if ((place < 0) | (place >= limit)).any():
                raise ValueError("a voxel outside the shape")
            chunk = np.array(layout.chunk)[:, None]
            number = np.ravel_multi_index(tuple(place // chunk), layout.grid)
            inside = place % chunk
            value = batch.column("v").to_numpy(zero_copy_only=False).astype(numpy_type)
            edges = np.flatnonzero(np.diff(number)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(number)], strict=True):
                if number[lo] != current:
                    flush()
                    current, cube, count = int(number[lo]), np.zeros(layout.chunk, numpy_type), count + 1
                cube[tuple(inside[:, lo:hi])] = value[lo:hi]
        flush()
        return Written(count)

    def commit(self, messages: list[Written | None]) -> None:
        _write(f"{self.path}/zarr.json", json.dumps(self.layout.meta() | {"attributes": {"chunks_written": sum(m.chunks for m in messages if m)}}, indent=1).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """What was written stays without metadata, so nobody reads it as an array."""


class VoxelSource(DataSource):
    """``format("voxels")``. Options: path; to read, ``chunks`` (how many a partition); to write, axes, shape, chunk, dtype."""

    @classmethod
    def name(cls) -> str:
        return "voxels"

    def schema(self) -> str:
        return Layout.of(metadata(self.options["path"])).schema

    def reader(self, schema: StructType) -> VoxelReader:
        path = self.options["path"].rstrip("/")
        return VoxelReader(path, Layout.of(metadata(path)), int(self.options.get("chunks", 1)))

    def writer(self, schema: StructType, overwrite: bool) -> VoxelWriter:
        numbers = lambda name: tuple(int(x) for x in self.options[name].split(","))
        layout = Layout(self.options["axes"], numbers("shape"), numbers("chunk"), self.options["dtype"])
        return VoxelWriter(self.options["path"].rstrip("/"), layout, overwrite)


def register(spark: SparkSession) -> None:
    """Make ``format("voxels")`` known to a session, with filters pushed down to it."""
    spark.dataSource.register(VoxelSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, path: str, chunks: int | None = None) -> DataFrame:
    """An array as voxels. ``chunks``: how many a partition; by default four partitions a core, of some million voxels at most."""
    register(spark)
    if chunks is None:
        layout = Layout.of(metadata(path))
        even = math.prod(layout.grid) // (4 * spark.sparkContext.defaultParallelism)
        chunks = max(1, min(even, VOXELS // math.prod(layout.chunk)))
    return spark.read.format("voxels").option("chunks", chunks).load(path)


def write(vox: DataFrame, path: str, shape: Sequence[int], dtype: str, axes: str = "zyx", chunk: Sequence[int] | None = None) -> None:
    """Voxels as an array: dealt to tasks by chunk and sorted, so that a task holds one chunk at a time."""
    register(vox.sparkSession)
    chunk = list(chunk) if chunk else [1 if a == "c" else CHUNK for a in axes]
    keys = [F.floor(F.col(a) / c) for a, c in zip(axes, chunk, strict=True)]
    rows = vox.select(*[F.col(a).cast("int").alias(a) for a in axes], F.col("v").cast(TYPES[dtype][1]).alias("v"))
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    texts = {"axes": axes, "shape": ",".join(map(str, shape)), "chunk": ",".join(map(str, chunk)), "dtype": dtype}
    dealt.write.format("voxels").mode("overwrite").options(**texts).save(path)


# ---------------------------------------------------------------- pyramids


def _smaller(shape: Sequence[int], factors: Sequence[int]) -> list[int]:
    return [-(-n // f) for n, f in zip(shape, factors, strict=True)]


def _downsampled(vox: DataFrame, shape: Sequence[int], factors: Sequence[int], kind: str, whole: bool) -> DataFrame:
    rows = vox.select(F.lit(0).alias("crop"), *ZYX, "v")
    out = down_mode(rows, tuple(shape), tuple(factors)) if kind == "label" else down_mean(rows, tuple(shape), tuple(factors), whole)
    return out.select(*ZYX, "v")


def write_multiscale(
    vox: DataFrame, path: str, shape: Sequence[int], dtype: str, voxel: Sequence[float], plan: Sequence[Sequence[int]], kind: str = "image", chunk: Sequence[int] | None = None
) -> list[str]:
    """Levels s0, s1, ... of an image (mean) or of labels (mode) below ``path``; the names of the levels.

    ``voxel``: the edge of a voxel in nanometres along z, y, x; ``plan``: the factors of each further level, as
    ``arrays.level_plan`` finds them. Each level is made from the stored one before. The group's metadata say each
    level's scale and where the centre of its first voxel lies.
    """
    spark = vox.sparkSession
    write(vox, f"{path}/s0", shape, dtype, chunk=chunk)
    edges, sizes = [list(map(float, voxel))], [list(shape)]
    for k, factors in enumerate(plan, 1):
        below = read(spark, f"{path}/s{k - 1}")
        write(_downsampled(below, sizes[-1], factors, kind, not dtype.startswith("float")), f"{path}/s{k}", _smaller(sizes[-1], factors), dtype, chunk=chunk)
        edges.append([e * f for e, f in zip(edges[-1], factors, strict=True)])
        sizes.append(_smaller(sizes[-1], factors))
    datasets = []
    for k, edge in enumerate(edges):
        steps: list[dict] = [{"type": "scale", "scale": edge}]
        if k:
            steps.append({"type": "translation", "translation": [(e - e0) / 2 for e, e0 in zip(edge, edges[0], strict=True)]})
        datasets.append({"path": f"s{k}", "coordinateTransformations": steps})
    axes = [{"name": a, "type": "space", "unit": "nanometer"} for a in ZYX]
    scales = {"axes": axes, "datasets": datasets, "coordinateTransformations": [{"type": "scale", "scale": [1.0, 1.0, 1.0]}]}
    ome = {"version": "0.5", "multiscales": [scales | ({"type": "image"} if kind == "image" else {})]}
    if kind == "label":
        ome["image-label"] = {"version": "0.5"}
    _write(f"{path}/zarr.json", json.dumps({"zarr_format": 3, "node_type": "group", "attributes": {"ome": ome}}, indent=1).encode())
    return [d["path"] for d in datasets]


def pyramid_faults(spark: SparkSession, path: str, kind: str = "image") -> DataFrame:
    """(level, chunk, differing): chunks of a level that differ from what the level before gives, and how many voxels do.

    A level of another shape or type than expected has one row without a chunk.
    """
    datasets = metadata(path)["attributes"]["ome"]["multiscales"][0]["datasets"]
    out = spark.createDataFrame([], "level string, chunk string, differing long")
    for before, after in itertools.pairwise(datasets):
        old, new = (Layout.of(metadata(f"{path}/{d['path']}")) for d in (before, after))
        scale = [d["coordinateTransformations"][0]["scale"] for d in (before, after)]
        factors = [round(b / a) for a, b in zip(*scale, strict=True)]
        if list(new.shape) != _smaller(old.shape, factors) or new.dtype != old.dtype:
            out = out.union(spark.createDataFrame([(after["path"], None, None)], out.schema))
            continue
        want = _downsampled(read(spark, f"{path}/{before['path']}"), old.shape, factors, kind, not old.dtype.startswith("float"))
        want = want.select(*ZYX, F.col("v").cast(TYPES[new.dtype][1]).alias("want"))
        both = read(spark, f"{path}/{after['path']}").join(want, list(ZYX), "full")
        key = F.concat_ws("/", *[F.floor(F.col(a) / c).cast("string") for a, c in zip(ZYX, new.chunk, strict=True)])
        wrong = both.where(~F.col("v").eqNullSafe(F.col("want"))).groupBy(key.alias("chunk")).agg(F.count(F.lit(1)).alias("differing"))
        out = out.union(wrong.select(F.lit(after["path"]).alias("level"), "chunk", "differing"))
    return out
