"""Helpers shared by the training-data operators: tables, the shared folder, word splitting.

Intermediate tables go to the folder in ``spark.checkpoint.dir``, which the driver and all
executors share, so a lost executor never loses them.  Only where that setting is absent and the
session is local (tests) a temporary folder is used instead.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of every contract that splits texts into words (ASCII only).
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder shared by driver and executors, from the session's configuration."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="llm-shared-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_run(spark: SparkSession, label: str) -> str:
    """A fresh folder for the intermediate tables of one call, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)  # noqa: SLF001
    return path


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: later steps start from the files, not from the lineage."""
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def quoted(name: str):
    """A column by its whole name, dots and back quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that the table does not have (ignoring case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def digest_hex(text_col):
    """Lowercase hex SHA-256 of a string column's UTF-8 bytes."""
    return F.sha2(text_col.cast("binary"), 256)


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors once for each Spark context, wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_llm_code_sent", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), f"llm-code-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._llm_code_sent = True


_HOLDERS: dict[str, Callable[[], None]] = {}


def hold(owner: str, drop: Callable[[], None]) -> None:
    """Called in a worker before an operator fills its tables: those of other operators go.

    Workers live on from stage to stage, so without this the tables of all stages would add up.
    """
    for name in [n for n in _HOLDERS if n != owner]:
        _HOLDERS.pop(name)()
    _HOLDERS[owner] = drop


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package's code on the executors."""
    ship_code(df.sparkSession)
    return df.mapInArrow(function, schema)
