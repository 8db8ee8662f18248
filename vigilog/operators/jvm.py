"""Tasks in Java: ``Trees.java``, compiled by the compiler that Spark has with it, and sent to the executors as a jar."""

from __future__ import annotations

import pkgutil
import tempfile
import zipfile
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession

_LOADERS: dict[str, object] = {}


def _loader(spark: SparkSession):
    """The class loader of the compiled tasks; made once for an application."""
    app = spark.sparkContext.applicationId
    if app not in _LOADERS:
        _LOADERS.clear()
        compiler = spark._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(spark._jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader())
        compiler.cook(pkgutil.get_data("vigilog.operators", "Trees.java").decode())
        path = f"{tempfile.mkdtemp(prefix='vigilog-jar-')}/vigilog-{app}.jar"
        with zipfile.ZipFile(path, "w") as jar:
            for name, code in dict(compiler.getBytecodes()).items():
                jar.writestr(f"{name.replace('.', '/')}.class", bytes(code))
        spark.sparkContext._jsc.addJar(path)
        _LOADERS[app] = compiler.getClassLoader()
    return _LOADERS[app]


def spec(*arrays: Iterable) -> bytes:
    """Arrays for a task, whole numbers as ints and others as doubles, each with its length before it."""
    arrays = [np.asarray(a) for a in arrays]
    typed = [a.astype("<f8" if a.dtype.kind == "f" else "<i4") for a in arrays]
    return b"".join(np.array([a.size], "<i4").tobytes() + a.tobytes() for a in typed)


def map_partitions(frame: DataFrame, task: str, about: bytes, schema: str) -> DataFrame:
    """The rows that a task makes of each partition."""
    spark, jvm = frame.sparkSession, frame.sparkSession._jvm
    loaded = jvm.java.lang.Class.forName(f"vigilog.Trees${task}", True, _loader(spark))
    arguments = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 1)
    arguments[0] = about
    made = loaded.getConstructors()[0].newInstance(arguments)
    encoder = jvm.org.apache.spark.sql.Encoders.row(jvm.org.apache.spark.sql.types.StructType.fromDDL(schema))
    return DataFrame(frame._jdf.mapPartitions(made, encoder), spark)
