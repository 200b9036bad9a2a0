"""What several operators share: tables of a run, working tables, checked columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.session import shared_dir

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, conf: dict[str, str] | None = None) -> DataFrame:
    """The rows of ``df`` written once to the shared folder and read from there.

    Cuts the lineage; a lost executor costs no recomputation of what came before.
    ``conf`` holds while they are written.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    before = {key: spark.conf.get(key, None) for key in conf or {}}
    try:
        for key, value in (conf or {}).items():
            spark.conf.set(key, value)
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
