"""What several operators share: reading tables, running Python on executors, words and hashes."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a function of ``map_batches`` sees at a time, of the 10,000 that Spark sends.
ROWS = 1_000

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()

#: Odd multipliers of the rolling hashes over word hashes.
ROLL_A = np.uint64(0x9E3779B97F4A7C15)
ROLL_B = np.uint64(0xC2B2AE3D27D4EB4F)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once for each application.

    The archive is made where the driver runs and executors fetch it there, as with ``--py-files``.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        folder = tempfile.mkdtemp(prefix="tidemark-code-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        path = Path(folder) / f"{PACKAGE.name}-code.zip"
        with zipfile.ZipFile(path, "w") as archive:
            for source in sorted(PACKAGE.rglob("*.py")):
                archive.write(source, source.relative_to(PACKAGE.parent))
        sc.addPyFile(str(path))
        _shipped.add(sc.applicationId)


def map_batches(df: DataFrame, function, schema: str, after=None) -> DataFrame:
    """``function`` takes a dict of Python lists (one batch) and returns a dict of columns.

    For row-wise work: batches are independent of each other, so the result does not depend
    on how rows are cut into them. ``after`` is called when a task is through, to free what the
    worker, which goes on to other tasks, would keep.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ship(df.sparkSession)
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    out = function(batch.slice(at, ROWS).to_pydict())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], f.type) for f in arrow], schema=arrow
                    )
        finally:
            if after is not None:
                after()

    return df.mapInArrow(run, schema)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` in UTF-8: ``bytes.split`` cuts at just these characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words_of(text: str | None) -> list[bytes]:
    """The same with A-Z in lower case; ``bytes.lower`` changes no other character."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word, the same on every machine."""
    if not words:
        return np.empty(0, np.uint64)
    # One object array of bytes; assignment by slice keeps numpy from reading them as characters.
    array = np.empty(len(words), object)
    array[:] = words
    return pd.util.hash_array(array, categorize=False)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit hash over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def rolled(hashes: np.ndarray, size: int, multiplier: np.uint64 = ROLL_A) -> np.ndarray:
    """A hash of every run of ``size`` consecutive words; none if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * multiplier + hashes[k : n + k]
    return mixed(out)


def sha256_or_empty(column) -> F.Column:
    return F.sha2(F.coalesce(column, F.lit("")), 256)
