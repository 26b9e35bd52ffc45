"""Small helpers that the operators share."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import panelkit
from panelkit.session import durable  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_ready(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application.

    The archive goes through Spark's own file distribution, so executors need no shared
    folder and no installed copy.
    """
    sc = spark.sparkContext
    if getattr(sc, "_panelkit_sent", False):
        return
    root = os.path.dirname(os.path.abspath(panelkit.__file__))
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="panelkit-")), "panelkit.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("panelkit", os.path.relpath(path, root)))
    sc.addPyFile(target)
    sc._panelkit_sent = True


def fold_of(doc_id) -> F.Column:
    """The fold of a row: crc32 of its id as text, modulo 3; fold 1 is held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def own(name: str, columns: list[str]) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> F.Column:
    return F.col("`" + re.sub("`", "``", name) + "`")
