"""Session helpers for tests and the benchmark; library code takes a session as given."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, name: str = "lockweir", memory: str = "12g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The reliable folder all executors can reach.

    A cluster names it in ``spark.checkpoint.dir``. Where that is unset, a session on one machine
    gets a fresh temporary folder that is kept for the session; any other master is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("lockweir.shared.dir", None)
    if not path:
        if not _on_one_machine(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="lockweir-")
        spark.conf.set("lockweir.shared.dir", path)
    return path.rstrip("/")


def _on_one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and go on from there.

    Survives the loss of executors, and gives the optimizer true sizes for what follows. The
    files stay until the folder's owner removes them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    # Without a given schema, a folder the driver cannot see is an error instead of no rows.
    return spark.read.parquet(path)


def cut_in_buckets(df: DataFrame, by: str, n: int) -> DataFrame:
    """Like ``cut``, with the rows in ``n`` buckets of ``by``: a grouping or join on it reads them where they lie.

    Buckets need a table's entry in the catalog, which goes again at once; the files stay.
    """
    spark = df.sparkSession
    name = f"cut_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    df.write.format("parquet").bucketBy(n, by).option("path", path).option("compression", "zstd").saveAsTable(name)
    held = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return held
