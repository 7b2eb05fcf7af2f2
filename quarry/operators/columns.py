"""Projection, filters and column predicates.

All of these are plain Catalyst expressions: they fuse into the scan's
whole-stage-codegen span and let filters / column pruning reach Parquet.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """F1."""
    return df.select(*names)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """F2."""
    return df.drop(*names)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def select_numeric(df: DataFrame) -> DataFrame:
    """keep numeric columns (schema-driven, no data read)."""
    return df.select(*numeric_columns(df))


def any_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def rows_with_any_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """F4."""
    return df.filter(any_null(list(cols or df.columns)))


def dropna(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """F5."""
    return df.dropna(subset=list(subset) if subset else None)


def mask_filter(df: DataFrame, cond: Column) -> DataFrame:
    """boolean mask / compound predicate (pushed to the scan when it can)."""
    return df.filter(cond)


def ratio(num: str, den: str) -> Column:
    """Null instead of inf / an ANSI error when the denominator is 0."""
    return F.try_divide(F.col(num).cast("double"), F.col(den).cast("double"))


class RatioFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ratio columns; the optional third ratio is a Param."""

    ratios = Param(Params._dummy(), "ratios", "list of 'out,numerator,denominator'",
                   typeConverter=TypeConverters.toListString)
    addOptional = Param(Params._dummy(), "addOptional", "also add the optional ratio",
                        typeConverter=TypeConverters.toBoolean)
    optional = Param(Params._dummy(), "optional", "[out, numerator, denominator]",
                     typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, ratios=None, addOptional=True, optional=None):
        super().__init__()
        self._setDefault(ratios=[], addOptional=True, optional=[])
        kw = dict(self._input_kwargs)
        if kw.get("ratios"):
            kw["ratios"] = [r if isinstance(r, str) else ",".join(r) for r in kw["ratios"]]
        self._set(**kw)

    def _transform(self, df: DataFrame) -> DataFrame:
        items = [tuple(r.split(",")) for r in self.getOrDefault(self.ratios)]
        opt = self.getOrDefault(self.optional)
        if self.getOrDefault(self.addOptional) and opt:
            items.append(tuple(opt))
        return df.withColumns({out: ratio(n, d) for out, n, d in items})


def ratio_features(df: DataFrame, ratios: Mapping[str, tuple[str, str]]) -> DataFrame:
    """several ratio columns at once."""
    return df.withColumns({o: ratio(n, d) for o, (n, d) in ratios.items()})


def derived_key(a: str, b: str, scale: float = 1000.0) -> Column:
    """F8: a * scale + b (e.g. lon*1000+lat)."""
    return F.col(a) * F.lit(scale) + F.col(b)


def class_targets(label: str, k: int) -> dict[str, Column]:
    """binary / derived targets from a class label."""
    y = F.col(label)
    return {f"is_{k}": y == k, f"ge_{k}": y >= k, "is_odd": F.pmod(y, F.lit(2)) == 1}


def bucket(col: str, edges: Sequence[float], labels: Sequence) -> Column:
    """pd.cut-style intervals (a, b]; outside all intervals -> NULL."""
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (F.col(col) > F.lit(lo)) & (F.col(col) <= F.lit(hi)) if not math.isinf(hi) \
            else F.col(col) > F.lit(lo)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def floor_bucket(col: str, w: float) -> Column:
    """x // w * w."""
    return F.floor(F.col(col) / F.lit(w)) * F.lit(w)


def row_sum(cols: Sequence[str]) -> Column:
    """F13."""
    return reduce(lambda a, b: a + b, [F.col(c) for c in cols])


def remap(col: str, mapping: Mapping) -> Column:
    """relabel through a literal map (no join; unknown -> NULL)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.element_at(m, F.col(col))


def threshold(score: str, t: float, inclusive: bool = True) -> Column:
    """decision at a custom threshold."""
    return F.col(score) >= F.lit(t) if inclusive else F.col(score) > F.lit(t)
