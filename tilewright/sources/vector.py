"""Vector files read through Spark's own file readers, so that any store that Spark reads will do.

Shapefiles and GeoPackages come in as binary files, one task for each file, and their layouts (both public)
are parsed from the bytes. Rows: input_path, layer, fid, geom_type, geometry (well-known binary, null where
a record has none), srid and attributes (a map of strings). A file that can't be read gives one row with its error.
"""

from __future__ import annotations

import re
import sqlite3
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import polygons as polygons_
from ..functions import rings as rings_

SCHEMA = "input_path string, layer string, fid long, geom_type string, geometry binary, srid int, attributes map<string,string>, error string"


def listed(files: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Files (path) none of whose folders is in ``skip``."""
    return files.where(~F.arrays_overlap(F.split("path", "/"), F.array(*map(F.lit, skip)))) if skip else files


def list_files(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """(path, length) of all files below ``path`` that end with ``suffix``; contents aren't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(path)
    return found.select("path", "length")


def at_level(files: DataFrame, tile_of: Column, z: int) -> DataFrame:
    """Files whose path's tile (see ``TilePaths.tile_of``) is of level ``z``."""
    return files.where(tile_of["z"] == z)


def existing(paths: DataFrame, files: DataFrame) -> DataFrame:
    return paths.join(files.select("path"), "path", "left_semi")


def dbf_rows(raw: bytes) -> list[dict[str, str | None]]:
    """Records of a dBASE table; deleted ones are None."""
    n, head, size = struct.unpack_from("<IHH", raw, 4)
    columns, at = [], 32
    while raw[at] != 0x0D:
        columns.append((raw[at : at + 11].split(b"\0")[0].decode("latin-1"), raw[at + 16]))
        at += 32
    out = []
    for k in range(n):
        place = head + k * size + 1
        row = {}
        for name, width in columns:
            text = raw[place : place + width].decode("utf-8", "replace").strip()
            row[name] = text or None
            place += width
        out.append(row)
    return out


def _inside(point: np.ndarray, ring: np.ndarray) -> bool:
    x, y = ring[:, 0], ring[:, 1]
    x2, y2 = np.roll(x, -1), np.roll(y, -1)
    crosses = (y > point[1]) != (y2 > point[1])
    at = x + (point[1] - y) / np.where(y2 == y, 1, y2 - y) * (x2 - x)
    return bool(np.count_nonzero(crosses & (point[0] < at)) % 2)


def _polygons(parts: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Rings of a shapefile's record: clockwise ones are shells, each other one is a hole of the shell around it."""
    shells = [[p] for p in parts if rings_.signed_area(p) <= 0] or [[p] for p in parts[:1]]
    for p in parts:
        if not any(p is s[0] for s in shells):
            next((s for s in shells if _inside(p[0], s[0])), shells[-1]).append(p)
    return shells


def shp_records(raw: bytes) -> Iterator[tuple[str | None, bytes | None]]:
    """Type and well-known binary of each record: points, polygons, nulls; other types raise."""
    at = 100
    while at + 8 <= len(raw):
        words = struct.unpack_from(">i", raw, at + 4)[0]
        body = raw[at + 8 : at + 8 + 2 * words]
        at += 8 + 2 * words
        kind = struct.unpack_from("<i", body)[0]
        if kind == 0:
            yield None, None
        elif kind in (1, 11, 21):
            yield "Point", struct.pack("<BI", 1, 1) + body[4:20]
        elif kind in (5, 15, 25):
            n_parts, n = struct.unpack_from("<ii", body, 36)
            first = [*struct.unpack_from(f"<{n_parts}i", body, 44), n]
            points = np.frombuffer(body, "<f8", 2 * n, 44 + 4 * n_parts).reshape(n, 2)
            yield rings_.as_wkb(_polygons([points[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]))
        else:
            raise ValueError(f"shape type {kind} isn't supported")


def gpkg_rows(raw: bytes) -> Iterator[tuple[str, int, bytes | None, int, dict[str, str | None]]]:
    """Layer, id, well-known binary, srid and attributes of each feature of a GeoPackage."""
    db = sqlite3.connect(":memory:")
    db.deserialize(raw)
    quoted = lambda name: '"' + name.replace('"', '""') + '"'
    for layer, column, srid in db.execute("select table_name, column_name, srs_id from gpkg_geometry_columns").fetchall():
        names = [r[1] for r in db.execute(f"pragma table_info({quoted(layer)})")]
        key = next((r[1] for r in db.execute(f"pragma table_info({quoted(layer)})") if r[5]), names[0])
        for row in db.execute(f"select * from {quoted(layer)}"):
            row = dict(zip(names, row, strict=True))
            blob, fid = row.pop(column), row.pop(key)
            wkb = None
            if blob is not None and not blob[3] & 0x10:  # not empty
                wkb = blob[8 + (0, 32, 48, 48, 64)[blob[3] >> 1 & 7] :]
            yield layer, fid, wkb, srid, {k: None if v is None else str(v) for k, v in row.items()}
    db.close()


_TYPES = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}


def _type_of(wkb: bytes | None) -> str | None:
    return None if wkb is None else _TYPES.get(int.from_bytes(wkb[1:5], "little" if wkb[0] else "big") % 1000)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["input_path", "layer", "fid", "geom_type", "geometry", "srid", "attributes", "error"])
    return out.astype({"srid": "Int32", "fid": "Int64"})


def read_gpkg(spark: SparkSession, path: str) -> DataFrame:
    """All features of the GeoPackages below ``path``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for name, raw in zip(files.path, files.content, strict=True):
                try:
                    yield _frame([(name, layer, fid, _type_of(g), g, srid, a, None) for layer, fid, g, srid, a in gpkg_rows(bytes(raw))])
                except Exception as e:  # noqa: BLE001 - the file's row says why it failed
                    yield _frame([(name, None, None, None, None, None, None, repr(e))])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gpkg").load(path)
    return files.select("path", "content").mapInPandas(run, SCHEMA)


#: Names of the supported CRSs in .prj files, without spaces, underscores and case; fixed values.
PRJ_NAMES = {
    "wgs84/pseudomercator": 3857, "wgs1984webmercatorauxiliarysphere": 3857, "wgs84/worldmercator": 3395, "wgs1984worldmercator": 3395,
    "wgs84/nsidcease-grid2.0global": 6933, "wgs1984nsidcease-grid2.0global": 6933, "wgs84/nsidcseaicepolarstereographicnorth": 3413,
    "wgs1984nsidcseaicepolarstereographicnorth": 3413, "wgs84/arcticpolarstereographic": 3995, "wgs1984arcticpolarstereographic": 3995,
    "wgs84/antarcticpolarstereographic": 3031, "wgs1984antarcticpolarstereographic": 3031, "gcswgs1984": 4326, "wgs84": 4326,
}


def srid_of_prj(text: str) -> int | None:
    """The EPSG code of a .prj file: that of the whole definition's authority, or the one that its name stands for; None if neither tells."""
    own = re.search(r'(?:AUTHORITY|ID)\s*\[\s*"EPSG"\s*,\s*"?(\d+)"?\s*\]\s*\]\s*$', text, re.I)
    if own:
        return int(own[1])
    name = re.match(r'\s*\w+\s*\[\s*"([^"]*)"', text)
    plain = re.sub(r"[\s_]", "", name[1]).lower() if name else ""
    if utm := re.fullmatch(r"wgs(?:84/|1984)utmzone(\d{1,2})([ns])", plain):
        return 32600 + 100 * (utm[2] == "s") + int(utm[1])
    return PRJ_NAMES.get(plain)


def read_shp(spark: SparkSession, path: str, srid: int | None = None) -> DataFrame:
    """All records of the shapefiles below ``path``, with the attributes of the .dbf and the CRS of the .prj of the same name.

    ``srid``: the CRS of files without a .prj, or whose .prj isn't known.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        default = srid
        for files in batches:
            for name, shp, dbf, prj in zip(files.path, files.shp, files.dbf, files.prj, strict=True):
                try:
                    rows = dbf_rows(bytes(dbf)) if dbf is not None else []
                    known = srid_of_prj(bytes(prj).decode("utf-8", "replace")) if prj is not None else None
                    srid_ = known or default
                    yield _frame([(name, None, k, kind, g, srid_, rows[k] if k < len(rows) else {}, None) for k, (kind, g) in enumerate(shp_records(bytes(shp)))])
                except Exception as e:  # noqa: BLE001
                    yield _frame([(name, None, None, None, None, None, None, repr(e))])

    def files(suffix: str, content: str) -> DataFrame:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{suffix}").load(path)
        return found.select("path", F.regexp_replace("path", r"\.[^.]*$", "").alias("base"), F.col("content").alias(content))

    both = files("shp", "shp").join(files("dbf", "dbf").drop("path"), "base", "left").join(files("prj", "prj").drop("path"), "base", "left")
    return both.select("path", "shp", "dbf", "prj").mapInPandas(run, SCHEMA)


def as_polygons(features: DataFrame) -> DataFrame:
    """Polygons and MultiPolygons, one row each, with their ``polygons`` and bounds (x0, y0, x1, y1) instead of ``geometry``.

    Null and empty geometries, and other types, are left out.
    """
    out = features.where(F.col("geom_type").isin("Polygon", "MultiPolygon")).withColumn(polygons_.COLUMN, polygons_.from_wkb(F.col("geometry")))
    out = out.where(F.col(polygons_.COLUMN).isNotNull()).drop("geometry")
    return out.withColumns(polygons_.bounds(F.col(polygons_.COLUMN)))


def as_boxes(features: DataFrame) -> DataFrame:
    """Bounding boxes (x0, y0, x1, y1), one row for each polygon of a MultiPolygon."""
    out = features.where(F.col("geom_type").isin("Polygon", "MultiPolygon")).withColumn("rings", F.explode(rings_.wkb_rings(F.col("geometry"))))
    return out.withColumns(rings_.bounds(F.col("rings")))


def gpkg_bytes(layer: str, rows: pd.DataFrame, geometry: str, srid: int) -> bytes:
    """A GeoPackage that holds one layer; columns besides ``geometry`` (well-known binary) become attributes."""
    db = sqlite3.connect(":memory:")
    names = [c for c in rows.columns if c != geometry]
    kinds = {"i": "INTEGER", "u": "INTEGER", "b": "INTEGER", "f": "REAL"}
    db.executescript(
        "pragma application_id = 1196444487;"
        "create table gpkg_contents (table_name text primary key, data_type text, identifier text, srs_id integer);"
        "create table gpkg_geometry_columns (table_name text, column_name text, geometry_type_name text, srs_id integer, z tinyint, m tinyint);"
        "create table gpkg_spatial_ref_sys (srs_name text, srs_id integer primary key, organization text, organization_coordsys_id integer, definition text);"
    )
    columns = "".join(f', "{c}" {kinds.get(rows[c].dtype.kind, "TEXT")}' for c in names)
    db.execute(f'create table "{layer}" (fid integer primary key, geom blob{columns})')
    db.execute("insert into gpkg_contents values (?, 'features', ?, ?)", (layer, layer, srid))
    db.execute("insert into gpkg_geometry_columns values (?, 'geom', 'GEOMETRY', ?, 0, 0)", (layer, srid))
    db.execute("insert into gpkg_spatial_ref_sys values (?, ?, 'EPSG', ?, 'undefined')", (f"EPSG:{srid}", srid, srid))
    head = b"GP\0\1" + struct.pack("<i", srid)
    plain = lambda v: None if v is None or (isinstance(v, float) and v != v) else v.item() if isinstance(v, np.generic) else v
    body = [(None if g is None else head + bytes(g), *map(plain, row)) for g, *row in rows[[geometry, *names]].itertuples(index=False)]
    db.executemany(f'insert into "{layer}" (geom{"".join(f", \"{c}\"" for c in names)}) values ({", ".join("?" * (len(names) + 1))})', body)
    db.commit()
    return db.serialize()


def write_gpkg(features: DataFrame, out_dir: str, by: str, geometry: str = "geometry", srid: int = 4326) -> DataFrame:
    """One GeoPackage for each value of ``by`` (a tile, say), named by its hash; returns (by, file, n). A group must fit a task's memory, as the format is one file.

    ``out_dir`` is a URI that all executors reach. A file appears under its name when it is complete.
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        from hashlib import md5

        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(out_dir)
        files.create_dir(root, recursive=True)
        name = f"{md5(str(key[0]).encode()).hexdigest()}.gpkg"
        from pyspark import TaskContext

        draft = f"{root}/.{name}-{TaskContext.get().taskAttemptId()}"
        with files.open_output_stream(draft) as f:
            f.write(gpkg_bytes("features", rows, geometry, srid))
        if files.get_file_info(f"{root}/{name}").is_file:
            files.delete_file(f"{root}/{name}")
        files.move(draft, f"{root}/{name}")
        return pd.DataFrame({by: [key[0]], "file": [name], "n": [len(rows)]})

    return features.groupBy(by).applyInPandas(run, f"{by} string, file string, n long")
