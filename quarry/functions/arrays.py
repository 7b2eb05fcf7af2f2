"""Fixed-length array / image functions (I1-I7) as SQL higher-order functions.

Images are row-major ``array<double>`` of H x W; element (r, c) is at
i = r * W + c.  Everything is a JVM expression (no Python per row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- I5
def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0),
                       lambda acc, x: acc + x)


def sq_norm(a) -> Column:
    return F.aggregate(F.transform(_c(a), lambda x: x * x), F.lit(0.0), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(sq_norm(a))


def sq_dist(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                       lambda acc, x: acc + x)


def euclidean(a, b) -> Column:
    return F.sqrt(sq_dist(a, b))


def lit_vector(v: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in v])


def lit_matrix(m: Sequence[Sequence[float]]) -> Column:
    return F.array(*[lit_vector(r) for r in m])


# ---------------------------------------------------------------- I1
def shift_image(a, dx: int, dy: int, h: int = 8, w: int = 8, fill: float = 0.0) -> Column:
    """Shift right by dx and down by dy (scipy.ndimage.shift, order 0)."""
    arr = _c(a)

    def px(_, i):
        r = F.floor(i / w).cast("int") - dy
        c = F.pmod(i, F.lit(w)) - dx
        inside = (r >= 0) & (r < h) & (c >= 0) & (c < w)
        return F.when(inside, F.element_at(arr, r * w + c + 1)).otherwise(F.lit(fill))
    return F.transform(arr, px)


# ---------------------------------------------------------------- I2
UNIT_SHIFTS = [(0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)]


def augment_shifts(df, col: str, shifts=UNIT_SHIFTS, h: int = 8, w: int = 8):
    """Original plus unit shifts as extra rows; other columns are kept."""
    opts = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                     for dx, dy in shifts])
    d = df.withColumn("_s", F.explode(opts)).withColumn("dx", F.col("_s.dx")) \
          .withColumn("dy", F.col("_s.dy")).drop("_s")
    expr = None
    for dx, dy in shifts:
        cond = (F.col("dx") == dx) & (F.col("dy") == dy)
        img = shift_image(col, dx, dy, h, w)
        expr = F.when(cond, img) if expr is None else expr.when(cond, img)
    return d.withColumn(col, expr)


# ---------------------------------------------------------------- I3
def add_noise(a, id_col: str, lo: int, hi: int, seed: int = 42) -> Column:
    """Uniform integer noise in [lo, hi) per (row id, element), repeatable."""
    from quarry.functions.hashing import md5_u32, key_text
    span = hi - lo

    def f(x, i):
        u = md5_u32(key_text(F.lit(seed), F.col(id_col), i))
        return x + (F.pmod(u, F.lit(span)) + lo).cast("double")
    return F.transform(_c(a), f)


# ---------------------------------------------------------------- I4
def index_map(a, src_index) -> Column:
    """Generic gather: out[i] = a[src_index(i)] (src_index is a Column fn)."""
    arr = _c(a)
    return F.transform(arr, lambda _, i: F.element_at(arr, src_index(i) + 1))


def transpose_image(a, h: int = 8, w: int = 8) -> Column:
    """Transpose an h x w image (result is w x h)."""
    return index_map(a, lambda i: F.pmod(i, F.lit(h)) * w + F.floor(i / h).cast("int"))


def flip_image(a, h: int = 8, w: int = 8, axis: int = 1) -> Column:
    """axis=1: left-right mirror; axis=0: up-down."""
    if axis == 1:
        return index_map(a, lambda i: F.floor(i / w).cast("int") * w + (w - 1 - F.pmod(i, F.lit(w))))
    return index_map(a, lambda i: (h - 1 - F.floor(i / w).cast("int")) * w + F.pmod(i, F.lit(w)))


def darken_rows(a, rows_from: int, rows_to: int, factor: float, w: int = 8) -> Column:
    """Multiply rows [rows_from, rows_to) by factor (zip_with with a mask)."""
    arr = _c(a)
    mask = F.transform(arr, lambda _, i: F.when(
        (F.floor(i / w) >= rows_from) & (F.floor(i / w) < rows_to), F.lit(factor))
        .otherwise(F.lit(1.0)))
    return F.zip_with(arr, mask, lambda x, m: x * m)


# ---------------------------------------------------------------- I6
def argmax(a) -> Column:
    """0-based index of the first maximum."""
    return (F.array_position(_c(a), F.array_max(_c(a))) - 1).cast("int")


def argmin(a) -> Column:
    return (F.array_position(_c(a), F.array_min(_c(a))) - 1).cast("int")


# ---------------------------------------------------------------- I7
def explode_vector(df, id_cols: Sequence[str], col: str, pos: str = "pos", val: str = "value"):
    return df.select(*id_cols, F.posexplode(col).alias(pos, val))


def implode_vector(df, id_cols: Sequence[str], pos: str = "pos", val: str = "value",
                   out: str = "vec"):
    """Long form back to an array ordered by position (per-row groups are small)."""
    return df.groupBy(*id_cols).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(pos, val))), lambda s: s[val])
        .alias(out))
