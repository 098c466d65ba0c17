"""Shared helpers: reading tables, scratch tables in the shared folder, shipping the package to executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import corpusloom
from corpusloom.session import checkpoint_root

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, so that functions run by ``mapInArrow`` can be imported there."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(corpusloom.__file__)
    out = os.path.join(tempfile.mkdtemp(prefix="corpusloom-zip-"), "corpusloom_pkg.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("corpusloom", os.path.relpath(path, top)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, the folder that the driver and all executors share."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column's values, null as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def concatenated(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All values in one uint8 array, and the offsets (one more than values) at which they begin."""
    offsets = np.zeros(len(values) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, values), np.int64, len(values)), out=offsets[1:])
    return np.frombuffer(b"".join(values), np.uint8), offsets


_STORE = "_corpusloom_worker_cache"


def forget_worker_caches() -> None:
    """Called by tasks of operators that need no cache: a worker that has turned to them frees what it kept."""
    import sys

    sys.modules.pop(_STORE, None)


def worker_cache(name: str, make):
    """A value kept by a Python worker across tasks (made anew in a new worker)."""
    import sys
    import types

    store = sys.modules.setdefault(_STORE, types.ModuleType(_STORE))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)
