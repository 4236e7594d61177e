"""Small helpers of the operators in this subpackage."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeferry.session import fresh_dir

#: White space of the word rules: space and the bytes 9 to 13.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per application.

    Functions that run in tasks are found by module name there, whether or not the
    executors have the package installed. Spark itself serves the file.
    """
    context, package = spark.sparkContext, Path(__file__).resolve().parent.parent
    if getattr(context, "_lakeferry_shipped", False):
        return
    folder = Path(tempfile.mkdtemp(prefix="code-")).resolve()
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = folder / f"{package.name}-code.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for file in sorted(package.rglob("*.py")):
            target.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._lakeferry_shipped = True


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    What follows no longer depends on the plan above, so neither a lost executor
    nor a second use computes it again.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_of_id(id_col: str) -> Column:
    """CRC-32 of the id written as decimal text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))


def uniform(*parts: Column | int) -> Column:
    """A number in [0, 1) that depends on nothing but ``parts``."""
    cells = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.pmod(F.xxhash64(*cells), F.lit(1 << 53)) / F.lit(float(1 << 53))


def give_back() -> None:
    """Return freed memory to the system, as the driver lives on after work in numpy and Arrow.

    The C library keeps what it freed between small blocks; where it is not glibc, it decides itself.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def ceil_div(a: int, b: int) -> int:
    return -(-a // b)
