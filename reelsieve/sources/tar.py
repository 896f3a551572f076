"""Members of tar shards put together by sample, and their arrays."""

from __future__ import annotations

import io

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def samples(rows: DataFrame, known: tuple[str, ...]) -> DataFrame:
    """shard, sample, members (map of extension to data): members of a sample together; samples may have dots in their names."""
    from ..functions.columns import member_parts

    sample, ext = member_parts(F.col("name"), known)
    return rows.where("error IS NULL").select("shard", sample.alias("sample"), ext.alias("ext"), "data").groupBy("shard", "sample").agg(F.map_from_entries(F.collect_list(F.struct("ext", "data"))).alias("members"))


def npy_values(data_col: str):
    """Column: the numbers of a .npy member, flattened (array of double); null where it can't be read."""
    @F.pandas_udf("array<double>")
    def load(data: pd.Series) -> pd.Series:
        import numpy as np

        def one(x):
            try:
                return np.load(io.BytesIO(x), allow_pickle=False).astype(float).ravel().tolist()
            except (ValueError, TypeError, OSError, EOFError):
                return None

        return data.map(one)

    return load(F.col(data_col))


def npz_values(data_col: str):
    """Column: (data array<double>, shape array<int>, inds array<long>) of a .npz member with arrays data and inds; null where it can't be read."""
    @F.pandas_udf("data array<double>, shape array<int>, inds array<long>")
    def load(data: pd.Series) -> pd.DataFrame:
        import zipfile

        import numpy as np

        def one(x):
            try:
                with np.load(io.BytesIO(x), allow_pickle=False) as z:
                    return z["data"].astype(float).ravel().tolist(), list(z["data"].shape), z["inds"].astype(np.int64).ravel().tolist()
            except (ValueError, TypeError, OSError, EOFError, KeyError, zipfile.BadZipFile):
                return None, None, None

        return pd.DataFrame([one(x) for x in data], columns=["data", "shape", "inds"])

    loaded = load(F.col(data_col))
    return F.when(loaded["data"].isNotNull(), loaded)
