"""Written tables in the folder that the whole cluster shares, and names that clash with nothing."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``; without that setting, in local mode, a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table down and read it back: what follows never recomputes it, also after lost executors."""
    place = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.option("compression", "zstd").parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


class Scratch:
    """Tables that only the way to a result needs: ``written`` as above, and deleted once that is written itself."""

    def __init__(self) -> None:
        self.places: list[tuple[SparkSession, str]] = []

    def written(self, df: DataFrame) -> DataFrame:
        place = shared_folder(df.sparkSession)
        self.places.append((df.sparkSession, place))
        df.write.option("compression", "zstd").parquet(place)
        return df.sparkSession.read.schema(df.schema).parquet(place)

    def drop(self) -> None:
        for spark, place in self.places:
            path = spark._jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        self.places = []


def free_name(df: DataFrame, wanted: str) -> str:
    """The wanted column name, longer if the table has such a column already."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"the table has no column {', '.join(missing)}")
