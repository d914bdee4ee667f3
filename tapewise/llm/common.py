"""Table access, shared scratch storage and worker-side state for the text operators."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import types
import uuid

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A private folder is made only for a local session that names none (tests);
    on a cluster a missing setting is an error, as executors could not see it.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tapewise-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back (cuts lineage, survives lost executors)."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def by_value(module_name: str) -> None:
    """Ship the module's functions inside the task, so that executors need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def worker_state(owner: str) -> types.ModuleType:
    """Read-only things that ``owner``'s tasks keep in a Python worker; those that another owner left are dropped."""
    name = "_tapewise_worker_state"
    if name not in sys.modules or sys.modules[name].owner != owner:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].owner = owner
    return sys.modules[name]


#: Texts in one Arrow batch, and the size from which the C library maps memory that it gives back at once.
BATCH_TEXTS = 2000
MAPPED_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on the session sends at most ``BATCH_TEXTS`` rows to a Python worker at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_TEXTS:
        spark.conf.set(name, str(BATCH_TEXTS))


def freed(result):
    """``result``; the worker's unused memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.mallopt(-3, MAPPED_BYTES)  # -3: M_MMAP_THRESHOLD
        libc.malloc_trim(0)
    return result


def tidied(batches):
    """The batches of a task; unused memory goes back to the system between them and at the end."""
    freed(None)
    for batch in batches:
        yield batch
        pa.default_memory_pool().release_unused()
    freed(None)


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, or a longer one that no column of ``frames`` has (whatever its case)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(col="text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


by_value(__name__)
