"""Tables that later steps start from, in one folder of the application below what the cluster shares.

The folder is ``spark.checkpoint.dir``. Only a session that runs in one JVM (``local[*]``) may leave it unset; its tables
then go to a temporary folder that is removed when the driver ends. On a cluster an application's tables stay until
``clean_up(spark)`` removes them, as DataFrames that start from them are read lazily; ``scratch(spark)`` removes what is
staged inside it.
"""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The share of the driver's heap that may be in use by its JVM before a staged table is followed by a collection.
HEAP_SHARE = 0.4
_own: dict[str, str] = {}  # temporary folders by application
_scratch: list[str] = []


def _temporary(application: str) -> str:
    if application not in _own:
        _own[application] = tempfile.mkdtemp(prefix="rosterlens-")
        atexit.register(shutil.rmtree, _own[application], ignore_errors=True)
    return "file://" + _own[application]


def application_folder(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = _temporary(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/rosterlens-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, tag: str = "stage") -> str:
    """A path of its own, in the innermost scratch folder if there is one."""
    return f"{_scratch[-1] if _scratch else application_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of any file system that Spark reads."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def clean_up(spark: SparkSession) -> None:
    """Remove every table that this application has staged."""
    remove(spark, application_folder(spark))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """What is staged inside goes when the block ends; yields the folder outside, for what is to stay."""
    outer = _scratch[-1] if _scratch else application_folder(spark)
    _scratch.append(new_folder(spark, "scratch"))
    try:
        yield outer
    finally:
        remove(spark, _scratch.pop())


def _collect_garbage(spark: SparkSession) -> None:
    """Give back what the plan of a staged table left on the driver, if its JVM has taken much of its heap by now.

    The JVM would rather take all of it first, and Spark removes broadcasts only when their handles are collected.
    """
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    if runtime.totalMemory() > HEAP_SHARE * runtime.maxMemory():
        gc.collect()  # plans that only Python's cycles still hold
        runtime.gc()
        _trim(spark)


def _trim(spark: SparkSession) -> bool:
    """Give back to the system what the driver's JVM has freed outside its heap: its compiler's arenas, buffers and
    the like. The C library keeps them otherwise, 176 MB after the scores of sf0.01. False where the JVM has no command for it."""
    jvm, array = spark._jvm, spark.sparkContext._gateway.new_array
    kinds = ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")
    values = (jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap", array(jvm.Object, 0), array(jvm.String, 0))
    classes, arguments = array(jvm.Class, 4), array(jvm.Object, 4)
    for i, (kind, value) in enumerate(zip(kinds, values)):
        classes[i], arguments[i] = jvm.Class.forName(kind), value
    invoke = jvm.Class.forName("javax.management.MBeanServer").getMethod("invoke", classes)  # of the interface: Py4J cannot see the class
    try:
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), arguments)
    except Py4JJavaError:
        return False
    return True


def stage(df: DataFrame, tag: str = "stage", folder: str | None = None) -> DataFrame:
    """Write ``df`` and read it back: later steps start from files, not from lineage. Its shuffle files go at once."""
    return stage_union([df], tag, folder)


def stage_union(parts: list[DataFrame], tag: str = "stage", folder: str | None = None) -> DataFrame:
    """All rows of the parts as one staged table. They are written one after the other, so that the driver plans, compiles and
    broadcasts for one of them at a time."""
    spark = parts[0].sparkSession
    schema = reduce(DataFrame.unionByName, parts).schema  # with the types that hold every part's values
    path = f"{folder}/{tag}-{uuid.uuid4().hex}" if folder else new_folder(spark, tag)
    before = spark.conf.get(_SHUFFLES, "false")
    spark.conf.set(_SHUFFLES, "true")
    try:
        for part in parts:
            own = part if len(parts) == 1 else part.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
            own.write.mode("append").parquet(path)
            _collect_garbage(spark)
    finally:
        spark.conf.set(_SHUFFLES, before)
    return spark.read.schema(schema).parquet(path)
