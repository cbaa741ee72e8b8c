"""Point clouds and meshes: a `ply` data source, OBJ text, and writers."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# PLY scalar types and their little-endian formats
TYPES = {"char": "b", "int8": "b", "uchar": "B", "uint8": "B", "short": "h", "int16": "h", "ushort": "H", "uint16": "H", "int": "i", "int32": "i", "uint": "I", "uint32": "I", "float": "f", "float32": "f", "double": "d", "float64": "d"}
COLORS = {"red": "r", "green": "g", "blue": "b"}


def parse_ply(data: bytes) -> dict[str, list[dict]]:
    """Elements of a PLY file, ASCII or binary little endian: name -> rows."""
    end = data.index(b"end_header\n") + len(b"end_header\n")
    lines = data[:end].decode("ascii").splitlines()
    if lines[0] != "ply":
        raise ValueError("no PLY file")
    kind, elements = None, []
    for line in lines[1:]:
        word = line.split()
        if word[:1] == ["format"]:
            kind = word[1]
        elif word[:1] == ["element"]:
            elements.append((word[1], int(word[2]), []))
        elif word[:1] == ["property"]:
            elements[-1][2].append((word[-1], word[1:-1]))
    out: dict[str, list[dict]] = {}
    if kind == "ascii":
        tokens = iter(data[end:].split())
        number = lambda t: float(next(tokens)) if TYPES[t] in "fd" else int(next(tokens))
    elif kind == "binary_little_endian":
        at = end

        def number(t):
            nonlocal at
            f = "<" + TYPES[t]
            at += struct.calcsize(f)
            return struct.unpack_from(f, data, at - struct.calcsize(f))[0]
    else:
        raise ValueError(f"unsupported format {kind}")
    for name, n, properties in elements:
        rows = out.setdefault(name, [])
        for _ in range(n):
            rows.append({p: [number(t[2]) for _ in range(int(number(t[1])))] if t[0] == "list" else number(t[0]) for p, t in properties})
    return out


POINTS = "file string, pid bigint, x double, y double, z double, r double, g double, b double, nx double, ny double, nz double"
FACES = "file string, tid bigint, v0 bigint, v1 bigint, v2 bigint"


def parse_pcd(data: bytes) -> list[dict]:
    """Points of a PCD file, ASCII or uncompressed binary; a packed `rgb` field becomes three colours."""
    head, at = {}, 0
    while "DATA" not in head:
        end = data.index(b"\n", at)
        word = data[at:end].decode("ascii").split()
        if word and word[0] != "#":
            head[word[0]] = word[1:]
        at = end + 1
    names, n = head["FIELDS"], int(head["POINTS"][0])
    kinds = [{"F4": "f", "F8": "d", "U1": "B", "U2": "H", "U4": "I", "I1": "b", "I2": "h", "I4": "i"}[t + s] for t, s in zip(head["TYPE"], head["SIZE"])]
    if any(c != "1" for c in head.get("COUNT", [])):
        raise ValueError("fields of several numbers aren't read")
    if head["DATA"] == ["ascii"]:
        rows = [[float(v) if k in "fd" else int(v) for v, k in zip(line.split(), kinds)] for line in data[at:].splitlines()[:n]]
    elif head["DATA"] == ["binary"]:
        rows = [list(r) for r in struct.iter_unpack("<" + "".join(kinds), data[at : at + n * struct.calcsize("<" + "".join(kinds))])]
    else:
        raise ValueError(f"unsupported data {head['DATA']}")
    out = []
    for row in rows:
        point = dict(zip(names, row))
        if "rgb" in point:
            packed = point.pop("rgb")
            packed = struct.unpack("<I", struct.pack("<f", packed))[0] if isinstance(packed, float) else packed
            point |= {"red": packed >> 16 & 255, "green": packed >> 8 & 255, "blue": packed & 255}
        out.append(point | {n: point[f"normal_{n[1]}"] for n in ("nx", "ny", "nz") if f"normal_{n[1]}" in point})
    return out


class PlySource(DataSource):
    """`spark.read.format("ply").load(path)`: points of one or more comma-separated PLY or PCD files, colours scaled to 0..1.

    With the option element=face, the triangles of PLY meshes; faces of more corners are fanned.
    """

    @classmethod
    def name(cls) -> str:
        return "ply"

    def schema(self) -> str:
        return FACES if self.options.get("element") == "face" else POINTS

    def reader(self, schema) -> DataSourceReader:
        return PlyReader(self.options["path"].split(","), self.options.get("element") == "face")


class PlyReader(DataSourceReader):
    def __init__(self, paths: list[str], faces: bool):
        self.paths, self.faces = paths, faces

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        from pyarrow import fs

        files, at = fs.FileSystem.from_uri(partition.value if "://" in partition.value else f"file://{partition.value}")
        with files.open_input_stream(at) as f:
            data = f.read()
        if self.faces:
            faces = [next(v for v in row.values() if isinstance(v, list)) for row in parse_ply(data).get("face", [])]
            fans = [(c[0], c[k], c[k + 1]) for c in faces for k in range(1, len(c) - 1)]
            yield from ((partition.value, i, *map(int, t)) for i, t in enumerate(fans))
            return
        rows = parse_ply(data).get("vertex", []) if data.startswith(b"ply") else parse_pcd(data)
        for i, row in enumerate(rows):
            color = [None if c not in row else row[c] / 255.0 if isinstance(row[c], int) else float(row[c]) for c in COLORS]
            yield (partition.value, i, float(row["x"]), float(row["y"]), float(row["z"]), *color, *[None if n not in row else float(row[n]) for n in ("nx", "ny", "nz")])


def ply_bytes(points: list[tuple], colors: list[tuple] | None = None, ascii_: bool = False) -> bytes:
    """A PLY file of points and 8-bit colours, from the driver."""
    head = ["ply", f"format {'ascii' if ascii_ else 'binary_little_endian'} 1.0", f"element vertex {len(points)}", *[f"property double {a}" for a in "xyz"], *[f"property uchar {c}" for c in COLORS if colors], "end_header"]
    body = b""
    for i, p in enumerate(points):
        c = colors[i] if colors else ()
        body += " ".join(map(repr, (*p, *c))).encode() + b"\n" if ascii_ else struct.pack("<3d", *p) + bytes(c)
    return "\n".join(head).encode() + b"\n" + body


def read_obj(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Vertices and triangles of an OBJ file, or of a folder of its parts in order of their names; ids count from 0 in the file's order.

    Faces of more corners are fanned, texture and normal indexes are dropped, negative indexes count back from the vertices so far, and faces of fewer than three corners are none.
    A large file is read in splits: a split's lines are numbered by a task, and how many vertices and triangles the splits before hold is a row for each split.
    A coordinate that is no number is null, and so is one that isn't there; other lines, empty ones included, are skipped.
    """
    words = F.split(F.trim("value", F.lit(" \t")), r"\s+")
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), words.alias("w"))
    is_v, n_t = (F.col("w")[0] == "v").cast("bigint"), F.when(F.col("w")[0] == "f", F.greatest(F.size("w") - 3, F.lit(0))).otherwise(0).cast("bigint")
    lines = lines.where(F.col("w")[0].isin("v", "f")).withColumns({"v": is_v, "t": n_t})
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "block").agg(F.sum("v").alias("v"), F.sum("t").alias("t"))
    splits = splits.select("file", "block", F.coalesce(F.sum("v").over(before), F.lit(0)).alias("v0"), F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"))
    here = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumns({"seen": F.sum("v").over(here), "made": F.sum("t").over(here)}).join(splits, ["file", "block"])
    lines = lines.withColumns({"seen": F.col("seen") + F.col("v0"), "made": F.col("made") + F.col("t0")})
    v = lines.where(F.col("v") == 1).select((F.col("seen") - 1).alias("vid"), *[F.get("w", F.lit(k)).try_cast("double").alias(a) for k, a in enumerate("xyz", 1)])

    def corner(word: Column) -> Column:
        i = F.split(word, "/")[0].try_cast("bigint")
        return F.when(i < 0, F.col("seen") + i).otherwise(i - 1)

    f = lines.where(F.col("t") > 0).select((F.col("made") - F.col("t")).alias("first"), F.transform(F.slice("w", 2, F.size("w")), corner).alias("c"))
    fan = f.select("first", "c", F.explode(F.sequence(F.lit(1), F.size("c") - 2)).alias("k"))
    return v, fan.select((F.col("first") + F.col("k") - 1).alias("tid"), F.col("c")[0].alias("v0"), F.get("c", F.col("k")).alias("v1"), F.get("c", F.col("k") + 1).alias("v2"))


def obj_lines(vertices: DataFrame, triangles: DataFrame) -> DataFrame:
    """The lines of an OBJ file as (part, no, line), to be written in that order; vertex ids are 0, 1, ..."""
    v = vertices.select(F.lit(0).alias("part"), F.col("vid").alias("no"), F.concat_ws(" ", F.lit("v"), "x", "y", "z").alias("line"))
    t = triangles.select(F.lit(1).alias("part"), F.col("tid").alias("no"), F.concat_ws(" ", F.lit("f"), *[(F.col(c) + 1).cast("string") for c in ("v0", "v1", "v2")]).alias("line"))
    return v.unionByName(t)


def write_obj(vertices: DataFrame, triangles: DataFrame, path: str) -> None:
    """One text file below `path`; folders are made."""
    obj_lines(vertices, triangles).repartitionByRange(1, "part", "no").sortWithinPartitions("part", "no").select("line").write.mode("overwrite").text(path)


def load_cloud(spark: SparkSession, path: str) -> DataFrame:
    """Points of a PLY or PCD file; an empty cloud is an error."""
    points = spark.read.format("ply").load(path)
    if points.isEmpty():
        raise ValueError(f"{path} has no points")
    return points


STL_FACE = struct.Struct("<12fH")


def parse_stl(data: bytes) -> list[tuple[float, ...]]:
    """The three corners of each facet, nine numbers in a row, of a binary or text STL file."""
    count = struct.unpack_from("<I", data, 80)[0] if len(data) >= 84 else -1
    if len(data) == 84 + STL_FACE.size * count:
        return [f[3:12] for f in STL_FACE.iter_unpack(data[84:])]
    corners = [tuple(map(float, line.split()[1:4])) for line in data.decode("ascii", "replace").splitlines() if line.split()[:1] == ["vertex"]]
    return [sum(corners[k : k + 3], ()) for k in range(0, len(corners) - 2, 3)]


def read_stl(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Vertices and triangles of an STL mesh.  Facets repeat their corners; corners in one place are one vertex.  The file is read by one task."""
    schema = "tid bigint, corner int, x double, y double, z double"

    def run(batches):
        for b in batches:
            for data in b.column(0).to_pylist():
                rows = [(t, k, *map(float, f[3 * k : 3 * k + 3])) for t, f in enumerate(parse_stl(data)) for k in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, (pa.int64(), pa.int32(), *[pa.float64()] * 3))], ["tid", "corner", "x", "y", "z"])

    corners = spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)
    places = corners.groupBy("x", "y", "z").agg(F.min(F.col("tid") * 3 + F.col("corner")).alias("vid"))
    each = corners.join(places, ["x", "y", "z"])
    triangles = each.groupBy("tid").agg(*[F.max(F.when(F.col("corner") == k, F.col("vid"))).alias(f"v{k}") for k in range(3)])
    return places.select("vid", "x", "y", "z"), triangles


def read_mesh(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Vertices and triangles of a mesh, read as its suffix says: .ply, .stl, else OBJ."""
    suffix = path.lower().rsplit(".", 1)[-1]
    if suffix == "stl":
        return read_stl(spark, path)
    if suffix != "ply":
        return read_obj(spark, path)
    spark.dataSource.register(PlySource)
    points = spark.read.format("ply").load(path).withColumnRenamed("pid", "vid")
    return points, spark.read.format("ply").option("element", "face").load(path)


def write_stl(vertices: DataFrame, triangles: DataFrame, path: str) -> None:
    """Text STL below `path`, one facet a row; normals are left to the reader."""
    out = triangles
    for k in range(3):
        out = out.join(vertices.select(F.col("vid").alias(f"v{k}"), F.concat_ws(" ", F.lit("vertex"), "x", "y", "z").alias(f"p{k}")), f"v{k}")
    facet = F.concat_ws("\n", F.lit("facet normal 0 0 0\nouter loop"), "p0", "p1", "p2", F.lit("endloop\nendfacet"))
    out.select("tid", facet.alias("value")).repartitionByRange(1, "tid").sortWithinPartitions("tid").select("value").write.mode("overwrite").text(path)
