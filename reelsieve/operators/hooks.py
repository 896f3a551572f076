"""Slots for models and codecs: named functions from batches to scores, absent ones giving null.

The engine has no models of its own. A hook is registered as a function over pandas series and applied to pair, chunk or
clip tables; metrics without a hook stay null, so that rules see a missing score and not an invented one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HOOKS: dict[str, tuple[Callable, str]] = {}


def register(name: str, function: Callable, returns: str = "double") -> None:
    """function: pandas series in, pandas series out; it is loaded where it runs."""
    _HOOKS[name] = (function, returns)


def unregister(name: str) -> None:
    _HOOKS.pop(name, None)


def hook(name: str, *columns: Column | str, returns: str = "double") -> Column:
    """The registered function's value for the columns, null where none is registered."""
    if name not in _HOOKS:
        return F.lit(None).cast(returns)
    function, kind = _HOOKS[name]
    return F.pandas_udf(function, kind)(*columns)


def scored(df: DataFrame, key: str, name: str, *columns: str) -> DataFrame:
    """Mean of a hook's values per key; nulls are skipped, NaN where there are none."""
    rows = df.select(key, hook(name, *columns).alias("__s"))
    return rows.groupBy(key).agg(F.coalesce(F.avg("__s"), F.lit(float("nan"))).alias(name))


def only_where(df: DataFrame, needed: Column, name: str, out: str, *columns: str) -> DataFrame:
    """The hook's value where it is needed, null elsewhere; rows that don't need it never reach the function."""
    yes = df.where(needed).withColumn(out, hook(name, *columns))
    kind = yes.schema[out].dataType
    no = df.where(~F.coalesce(needed, F.lit(False))).withColumn(out, F.lit(None).cast(kind))
    return yes.unionByName(no)
