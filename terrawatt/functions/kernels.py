"""Arrow-batched kernels for what expressions cannot say: WKB decoding and iterated geodesics."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrawatt.functions.geo import WGS84_A, WGS84_F
from terrawatt.functions.shapes import GEOMETRY

#: Geometry codes of WKB.
_CODES = {"POINT": 1, "LINESTRING": 2, "POLYGON": 3, "MULTIPOINT": 4, "MULTILINESTRING": 5, "MULTIPOLYGON": 6}
_NAMES = {code: name for name, code in _CODES.items()}
#: Flag bits of EWKB for Z, M and a reference system.
_HAS_Z, _HAS_M, _HAS_SRID = 0x80000000, 0x40000000, 0x20000000


class _Rows:
    """Geometries as flat coordinates with the sizes of rings, parts and rows."""

    def __init__(self) -> None:
        self.types: list[str | None] = []
        self.flat: list[np.ndarray] = []
        self.rings: list[int] = []
        self.parts: list[int] = []
        self.rows: list[int] = []

    def array(self) -> pa.StructArray:
        xy = np.concatenate(self.flat) if self.flat else np.zeros((0, 2))
        level = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(xy[:, k])) for k in (0, 1)], ["x", "y"])
        for sizes in (self.rings, self.parts, self.rows):
            level = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), level)
        bad = pa.array([t is None for t in self.types], pa.bool_())
        return pa.StructArray.from_arrays([pa.array(self.types, pa.string()), level], ["type", "parts"], mask=bad)


def _read(buf: bytes, at: int, flat: list[np.ndarray], rings: list[int], parts: list[int]) -> tuple[int, int]:
    """Adds one geometry of a WKB or EWKB buffer: (code, next offset). ISO thousands and EWKB flags tell Z and M."""
    order = "<" if buf[at] == 1 else ">"
    (raw,) = struct.unpack_from(order + "I", buf, at + 1)
    at += 9 if raw & _HAS_SRID else 5
    thousands, code = divmod(raw & 0x0FFFFFFF, 1000)
    wide = 2 + bool(raw & _HAS_Z or thousands in (1, 3)) + bool(raw & _HAS_M or thousands in (2, 3))
    if code not in _NAMES or thousands > 3:
        raise ValueError(f"geometry code {raw}")

    def count() -> int:
        nonlocal at
        at += 4
        return struct.unpack_from(order + "I", buf, at - 4)[0]

    def ring(n: int) -> None:
        nonlocal at
        flat.append(np.frombuffer(buf, order + "f8", n * wide, at).reshape(n, wide)[:, :2].astype(float))
        rings.append(n)
        at += 8 * n * wide

    if code == 1:
        ring(1)
        if np.isnan(flat[-1]).all():  # how WKB writes an empty point
            flat.pop(), rings.pop()
        else:
            parts.append(1)
    elif code == 2:
        n = count()
        if n:
            ring(n)
            parts.append(1)
    elif code == 3:
        n = count()
        for _ in range(n):
            ring(count())
        if n:
            parts.append(n)
    else:
        for _ in range(count()):
            inner, at = _read(buf, at, flat, rings, parts)
            if inner != code - 3:
                raise ValueError(f"geometry {inner} within {code}")
    return code, at


@F.arrow_udf(GEOMETRY)
def st_geom_from_wkb(wkb: pa.Array) -> pa.Array:
    """WKB or EWKB bytes to a geometry; NULL, truncated or unknown bytes give NULL. Z and M are left out."""
    out = _Rows()
    for value in wkb:
        flat, rings, parts = [], [], []
        try:
            code, _ = _read(value.as_py() or b"", 0, flat, rings, parts)
            kind = _NAMES[code]
        except (ValueError, IndexError, struct.error):
            kind, flat, rings, parts = None, [], [], []
        out.types.append(kind)
        out.flat += flat
        out.rings += rings
        out.parts += parts
        out.rows.append(len(parts))
    return out.array()


@F.arrow_udf(T.BinaryType())
def st_as_wkb(geom: pa.Array) -> pa.Array:
    """A geometry as little-endian WKB."""
    out = []
    xy = lambda ring: np.array([(p["x"], p["y"]) for p in ring], "<f8").reshape(-1, 2)

    def body(code: int, part: list) -> bytes:
        if code == 1:
            return xy(part[0]).tobytes()
        rings = [struct.pack("<I", len(r)) + xy(r).tobytes() for r in part]
        return rings[0] if code == 2 else struct.pack("<I", len(rings)) + b"".join(rings)

    for value in geom:
        g = value.as_py()
        if g is None or g["type"] is None:
            out.append(None)
            continue
        code, parts = _CODES[g["type"]], g["parts"]
        head = struct.pack("<BI", 1, code)
        if code > 3:
            single = struct.pack("<BI", 1, code - 3)
            out.append(head + struct.pack("<I", len(parts)) + b"".join(single + body(code - 3, p) for p in parts))
        elif parts:
            out.append(head + body(code, parts[0]))
        else:
            out.append(head + (np.full(2, np.nan).tobytes() if code == 1 else struct.pack("<I", 0)))
    return pa.array(out, pa.binary())


def vincenty_m(lon1, lat1, lon2, lat2, rounds: int = 30) -> np.ndarray:
    """Vincenty's inverse solution on arrays; near-antipodal pairs that do not settle give NaN."""
    lon1, lat1, lon2, lat2 = (np.radians(np.asarray(v, dtype="float64")) for v in (lon1, lat1, lon2, lat2))
    f, a = WGS84_F, WGS84_A
    b = a * (1 - f)
    u1, u2 = np.arctan((1 - f) * np.tan(lat1)), np.arctan((1 - f) * np.tan(lat2))
    su1, cu1, su2, cu2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    delta = lon2 - lon1
    lam = delta.copy()
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(rounds):
            sl, cl = np.sin(lam), np.cos(lam)
            ss = np.hypot(cu2 * sl, cu1 * su2 - su1 * cu2 * cl)
            cs = su1 * su2 + cu1 * cu2 * cl
            sigma = np.arctan2(ss, cs)
            sa = np.where(ss == 0, 0.0, cu1 * cu2 * sl / ss)
            ca2 = 1 - sa * sa
            c2m = np.where(ca2 == 0, 0.0, cs - 2 * su1 * su2 / ca2)
            c = f / 16 * ca2 * (4 + f * (4 - 3 * ca2))
            nxt = delta + (1 - c) * f * sa * (sigma + c * ss * (c2m + c * cs * (2 * c2m**2 - 1)))
            settled = np.abs(nxt - lam) < 1e-12
            lam = nxt
        k = ca2 * (a * a - b * b) / (b * b)
        big_a = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
        big_b = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
        ds = big_b * ss * (
            c2m + big_b / 4 * (cs * (2 * c2m**2 - 1) - big_b / 6 * c2m * (4 * ss**2 - 3) * (4 * c2m**2 - 3))
        )
        return np.where(settled, b * big_a * (sigma - ds), np.nan)


@F.pandas_udf(T.DoubleType())
def st_distance_vincenty(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
    return pd.Series(vincenty_m(lon1, lat1, lon2, lat2))
