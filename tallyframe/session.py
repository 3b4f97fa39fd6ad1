"""Session settings for local runs; a cluster brings its own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


_HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"


def tune(spark: SparkSession) -> None:
    """Keep very wide projections compiled.

    HotSpot never compiles a method above 8000 bytes of bytecode, yet by default Spark generates methods of up to
    65535. Above this limit Spark falls back to split, compilable projections, several times faster for wide tables.
    `local_session` sets it; a cluster's session is left as it is, so set it there too. A limit somebody has set stays.
    """
    if spark.conf.get(_HUGE_METHOD, "65535") == "65535":
        spark.conf.set(_HUGE_METHOD, "8000")


def local_session(cores: int = 8, app: str = "tallyframe", memory: str = "16g") -> SparkSession:
    """A local session with the settings tests and the bench share."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark
