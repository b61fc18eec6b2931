"""Tiles as text and as paths: column expressions and the validated settings behind them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.grid import TILE_MATRIX_SETS, children, parent

PARTS = ("style", "tms", "z", "x", "y")


def tile_text(x: Column, y: Column, z: Column) -> Column:
    """``Tile(x=6, y=10, z=4)``; null where a part is null."""
    return F.when(x.isNotNull() & y.isNotNull() & z.isNotNull(), F.format_string("Tile(x=%d, y=%d, z=%d)", x, y, z))


def tile_struct(x: Column, y: Column, z: Column) -> Column:
    """Null where x or y is null."""
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), z.cast("int").alias("z")))


def tile_from_text(text: Column) -> Column:
    """The tile of ``tile_text``; null where the text has none."""
    part = lambda k: F.regexp_extract(text, f"{k}=(\\d+)", 1)
    whole = text.rlike(r"x=\d+") & text.rlike(r"y=\d+") & text.rlike(r"z=\d+")
    return F.when(whole, F.struct(part("x").cast("long").alias("x"), part("y").cast("long").alias("y"), part("z").cast("int").alias("z")))


def validate_tms_id(tms_id) -> tuple[bool, str, type | None]:
    if not isinstance(tms_id, str):
        return False, "tms_id must be a string", TypeError
    if tms_id not in TILE_MATRIX_SETS:
        return False, f"{tms_id} isn't a known tile matrix set; known: {sorted(TILE_MATRIX_SETS)}", ValueError
    return True, "", None


def validate_path_structure(structure) -> tuple[bool, str, type | None]:
    if not isinstance(structure, (tuple, list)) or not all(isinstance(p, str) for p in structure):
        return False, "path_structure must be a tuple of strings", TypeError
    if not set(structure) <= set(PARTS):
        return False, f"path_structure may hold {PARTS} only", ValueError
    if len(set(structure)) != len(structure):
        return False, "path_structure repeats a part", ValueError
    if len(structure) < 3 or set(structure[-3:]) != {"x", "y", "z"}:
        return False, "path_structure must end with x, y and z in any order", ValueError
    return True, "", None


@dataclass
class TilePaths:
    """Where tiles of a tile matrix set lie: base directories, and the order of a path's parts."""

    tms_id: str = "WGS1984Quad"
    path_structure: tuple[str, ...] = PARTS
    base_dirs: dict[str, dict[str, str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for ok, message, kind in (validate_tms_id(self.tms_id), validate_path_structure(self.path_structure)):
            if not ok:
                raise kind(message)
        self.path_structure = tuple(self.path_structure)

    def add_base_dir(self, name: str, path: str, ext: str) -> None:
        if not all(isinstance(v, str) for v in (name, path, ext)):
            raise TypeError("name, path and ext must be strings")
        if name in self.base_dirs:
            raise ValueError(f"there is a base directory {name} already")
        self.base_dirs[name] = {"path": path, "ext": ext}

    def get_base_dir(self, name: str) -> dict[str, str] | None:
        return self.base_dirs.get(name)

    def path(self, x: Column, y: Column, z: Column, base_dir: Column | str = "", style: Column | str = "", ext: Column | str = "", tms: Column | str | None = None) -> Column:
        """base_dir/parts in order + ext; an empty style or base_dir leaves no gap."""
        lit = lambda v: v if isinstance(v, Column) else F.lit(v)
        of = {"x": x, "y": y, "z": z, "style": F.nullif(lit(style), F.lit("")), "tms": lit(self.tms_id if tms is None else tms)}
        base = F.nullif(F.regexp_replace(lit(base_dir), "/+$", ""), F.lit(""))
        parts = [of[p].cast("string") for p in self.path_structure]
        whole = F.concat(F.concat_ws("/", base, *parts), lit(ext))
        return F.when(x.isNotNull() & y.isNotNull() & z.isNotNull(), whole)

    def parse(self, path: Column) -> dict[str, Column]:
        """base_dir, style, tms, z, x, y and ext of a path. With one part before the tile it is the tms;
        with more, the last two are style and tms in order, and the rest is the base directory."""
        ext = F.regexp_extract(path, r"(\.[^./]*)$", 1)
        items = F.split(F.regexp_replace(path, r"\.[^./]*$", ""), "/")
        n = F.size(items)
        tile = {p: F.element_at(items, k - 3).cast("long" if p != "z" else "int") for k, p in enumerate(self.path_structure[-3:])}
        order = [p for p in self.path_structure if p in ("style", "tms")] or ["style", "tms"]
        head = {p: F.element_at(items, -3 - len(order) + k) for k, p in enumerate(order)}
        one = n - 3 <= 1
        out = {"base_dir": F.when(one, F.lit("")).otherwise(F.array_join(F.slice(items, 1, F.greatest(n - 3 - len(order), F.lit(0))), "/"))}
        out["style"] = F.when(one, F.lit("")).otherwise(head["style"]) if "style" in head else F.lit("")
        out["tms"] = F.when(n == 4, F.element_at(items, 1)).when(n > 4, head["tms"]) if "tms" in head else F.lit(None).cast("string")
        return out | {p: tile[p] for p in ("z", "x", "y")} | {"ext": ext}

    def parent_path(self, path: Column) -> Column:
        """The path of the parent tile in the same place; null at level 0."""
        p = self.parse(path)
        return self._again(p, *parent(p["x"], p["y"], p["z"]))

    def child_paths(self, path: Column) -> Column:
        """The paths of the four tiles one level down, in the order of ``children``."""
        p = self.parse(path)
        return F.transform(children(p["x"], p["y"], p["z"]), lambda c: self._again(p, c["x"], c["y"], c["z"]))

    def _again(self, p: dict[str, Column], x: Column, y: Column, z: Column) -> Column:
        return self.path(x, y, z, p["base_dir"], p["style"], p["ext"], F.coalesce(p["tms"], F.lit(self.tms_id)))

    def tile_of(self, text: Column) -> Column:
        """The tile of a tile's text or of a path."""
        p = self.parse(text)
        return F.when(text.startswith("Tile(") & text.endswith(")"), tile_from_text(text)).otherwise(tile_struct(p["x"], p["y"], p["z"]))
