"""Ordered task lists and news lists."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hubbub.schemas import TASK

_TASKS = T.StructType([T.StructField("seq", T.LongType())] + TASK.fields)


def path_exists(spark, path):
    """Whether a path exists on its own file system, whichever that is."""
    try:
        spark.read.format("binaryFile").load(path).schema
        return True
    except Exception as problem:
        if "PATH_NOT_FOUND" in str(problem):
            return False
        raise


def read_tasks(spark, path):
    """Read task files (one JSON array each) with the array position as ``seq``.

    Returns (tasks, audit). A missing file is reported in ``audit`` and gives no tasks. A task
    file is one run's list and is read whole, as its order only exists inside the file.
    """
    if not path_exists(spark, path):
        note = spark.createDataFrame([(path, "task file not found")], "input string, problem string")
        return spark.createDataFrame([], _TASKS), note
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.from_json("value", T.ArrayType(TASK)).alias("tasks"), F.col("_metadata.file_name").alias("input"))
    bad = rows.where(F.col("tasks").isNull()).select("input", F.lit("not a task list").alias("problem"))
    tasks = rows.select(F.posexplode("tasks").alias("seq", "task")).select(F.col("seq").cast("long"), "task.*")
    return tasks, bad


def write_tasks(tasks, path, run):
    """Write tasks below a folder named after the run, keeping ``seq`` so order survives."""
    tasks.write.mode("overwrite").json(f"{path}/run_ts={run}")
