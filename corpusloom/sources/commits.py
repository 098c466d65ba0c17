"""S8 as a transaction log: built data and the record of it become visible together.

A build has two writes.  First the rows, into a folder of their own (``<data>/build=<id>``); nothing reads them yet.
Then one numbered commit (``<log>/commit=<n>/build=<id>``): a row for every source file it adds and for every one it
removes, and a head row that holds their number.  A commit is complete when all its rows are there, so a stop between
or inside the writes leaves the earlier state, and the files concerned are simply built again.

The state after any set of commits is a plain aggregate: for every source file the row of its highest complete
commit; ``remove`` rows are tombstones.  A file that became empty is added with a build that has no rows for it, a
file that is gone is removed: both lose their earlier rows.

One writer at a time is expected.  When two took the same number, the commit is the one with the smallest build id,
and the other's ``commit`` raises ``CommitConflict``; its files are not recorded and are built again.

Nothing is overwritten or deleted here: ``unused_builds`` names the folders that hold no live rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.joins import bounded_broadcast
from corpusloom.session import checkpoint_root

ADD, REMOVE, HEAD = "add", "remove", "head"
STATE = ["file", "mtime", "length", "config_hash"]
LOG_SCHEMA = ("action string, file string, mtime timestamp, length bigint, config_hash string, n_rows bigint, "
              "commit bigint, build string")


class CommitConflict(RuntimeError):
    """Another build took the same commit number."""


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``; no rows where nothing was written yet.  Any other failure is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def complete_commits(log: DataFrame) -> DataFrame:
    """(commit, build) of the commits whose rows are all there; one build a number, the smallest id."""
    whole = log.groupBy("commit", "build").agg(
        F.max(F.when(F.col("action") == HEAD, F.col("n_rows"))).alias("_want"),
        F.count_if(F.col("action") != HEAD).alias("_have")).filter(F.col("_want") == F.col("_have"))
    return whole.groupBy("commit").agg(F.min("build").alias("build"))


def live_files(spark: SparkSession, log_path: str, as_of: int | None = None) -> DataFrame:
    """The recorded source files (file, mtime, length, config_hash, commit, build), now or after commit ``as_of``."""
    log = _read(spark, log_path, LOG_SCHEMA)
    done = complete_commits(log)
    if as_of is not None:
        done = done.filter(F.col("commit") <= as_of)
    rows = log.filter(F.col("action") != HEAD).join(bounded_broadcast(done), ["commit", "build"])
    last = rows.groupBy("file").agg(F.max_by(F.struct("action", "mtime", "length", "config_hash", "commit", "build"),
                                             "commit").alias("_s"))
    return last.select("file", "_s.*").filter(F.col("action") == ADD).drop("action")


def plan_build(spark: SparkSession, folder: str, log_path: str, config_hash: str, glob: str = "*") -> DataFrame:
    """What a build has to do: (action, file, mtime, length, config_hash, path), written once so that all its readers
    see one listing.  ``file`` is the name that ``_metadata.file_path`` gives a file's rows, ``path`` the one to read by.

    ``add``: files of ``folder`` that are not recorded in their present state; ``remove``: recorded files that the
    listing lacks.  A folder that cannot be listed raises, so it removes nothing.
    """
    checkpoint_root(spark)
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col("modificationTime").alias("mtime"), "length",
        F.lit(config_hash).alias("config_hash"), "path").checkpoint(eager=True)
    live = live_files(spark, log_path).select(*STATE)
    added = found.join(live, STATE, "left_anti").select(F.lit(ADD).alias("action"), *STATE, "path")
    gone = live.join(found.select("file"), "file", "left_anti").select(
        F.lit(REMOVE).alias("action"), *STATE, F.lit(None).cast("string").alias("path"))
    return added.unionByName(gone).checkpoint(eager=True)


def stage(rows: DataFrame, path_col: str, data_path: str, build: str | None = None) -> str:
    """Write the rows of a build, ``path_col`` naming each row's source file as ``file`` of the plan does;
    -> its id.  No reader sees them yet."""
    build = build or f"b-{uuid.uuid4().hex}"
    rows.withColumn("_file", F.col(path_col)).write.mode("errorifexists").parquet(f"{data_path}/build={build}")
    return build


def commit(plan: DataFrame, log_path: str, build: str) -> int:
    """Record ``plan`` under the next number; -> the number.  Raises ``CommitConflict`` when another build took it."""
    spark = plan.sparkSession
    # numbers of incomplete commits stay taken: what is written once is never written over
    taken = _read(spark, log_path, LOG_SCHEMA).agg(F.max("commit")).first()[0]
    n = 0 if taken is None else taken + 1
    rows = plan.select("action", *STATE, F.lit(None).cast("bigint").alias("n_rows"))
    head = plan.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(HEAD).alias("action"), F.lit(None).cast("string").alias("file"), F.lit(None).cast("timestamp").alias("mtime"),
        F.lit(None).cast("bigint").alias("length"), F.lit(None).cast("string").alias("config_hash"), "n_rows")
    rows.unionByName(head).write.mode("errorifexists").parquet(f"{log_path}/commit={n}/build={build}")
    won = complete_commits(_read(spark, log_path, LOG_SCHEMA)).filter(F.col("commit") == n).first()
    if won is None or won["build"] != build:
        raise CommitConflict(f"commit {n} belongs to another build; run the build again")
    return n


def build_changed(spark: SparkSession, folder: str, data_path: str, log_path: str, config_hash: str,
                  make: Callable[[DataFrame], DataFrame], path_col: str, glob: str = "*") -> int | None:
    """Build the changed files of ``folder`` by ``make(files to build) -> rows`` and record them with the removals.

    ``make`` is not called when only files went away.  -> the commit's number, None when nothing changed.
    """
    plan = plan_build(spark, folder, log_path, config_hash, glob)
    todo = plan.filter(F.col("action") == ADD).drop("action")
    if todo.isEmpty():
        if plan.isEmpty():
            return None
        return commit(plan, log_path, f"b-{uuid.uuid4().hex}")
    return commit(plan, log_path, stage(make(todo), path_col, data_path))


def read_live(spark: SparkSession, data_path: str, log_path: str, schema: str, as_of: int | None = None) -> DataFrame:
    """The built rows of the recorded files.  ``build`` is a folder name, so builds without live files are not read.

    ``schema``: the columns of the built rows.  Rows whose source file a later commit replaced or removed are left out.
    """
    live = live_files(spark, log_path, as_of).select(F.col("file").alias("_file"), "build")
    rows = _read(spark, data_path, f"{schema}, _file string, build string")
    return rows.join(bounded_broadcast(live), ["_file", "build"], "left_semi").drop("_file", "build")


def unused_builds(spark: SparkSession, data_path: str, log_path: str) -> DataFrame:
    """(build): folders of ``data_path`` that hold no live rows, those of stopped builds among them."""
    return _read(spark, data_path, "_file string, build string").select("build").distinct().join(
        live_files(spark, log_path).select("build").distinct(), "build", "left_anti")
