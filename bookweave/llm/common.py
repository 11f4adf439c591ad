"""What the training-data operators share: table access, word splitting, scratch tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import Scratch, bounded, remove, shared_folder  # noqa: F401 - what the operators share
from ..session import release, ship  # noqa: F401

#: A word is a run of characters other than space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"
#: The same six separators, for translate() and for bytes.split(), which splits on exactly these.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def byte_words(text: str | None) -> list[bytes]:
    """Python form of words(): bytes.split() splits on the six ASCII blanks alone."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def parallel(spark: SparkSession, df: DataFrame, *, per_core: int = 2) -> DataFrame:
    """Deal rows out when the input has fewer files than the cluster has cores, as a small table has."""
    cores = spark.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores else df.repartition(cores * per_core)


def free(name: str, df: DataFrame) -> str:
    """A column name that df does not have, whatever its columns are called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def pieces(spark: SparkSession, df: DataFrame, per_piece: int) -> int:
    """In how many pieces to cut what is made from df, by the size Spark knows of it."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return least if size > 1 << 55 else max(least, -(-size // per_piece))


def map_rows(df: DataFrame, compute: Callable[[pa.RecordBatch], dict], fields: str, *, drop: tuple[str, ...] = (), step: int = 512) -> DataFrame:
    """df with new columns that compute() makes of ``step`` rows at a time, without those in ``drop``.

    The other columns pass through as Arrow arrays, so nulls and large integers stay what they are. Instead of a new
    column, compute() may return "keep", a list of booleans: the rows to keep.
    """
    new = T._parse_datatype_string(fields).fields if fields else []
    rest = [f for f in df.schema if f.name not in {*drop, *(n.name for n in new)}]
    names = [f.name for f in rest]
    kinds = {n.name: _arrow(n.dataType) for n in new}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, step):
                part = b.slice(k, step)
                made = compute(part)
                arrays = [part.column(n) for n in names] + [pa.array(made[n], t) for n, t in kinds.items()]
                out = pa.RecordBatch.from_arrays(arrays, names=[*names, *kinds])
                yield out.filter(pa.array(made["keep"], pa.bool_())) if "keep" in made else out
        release()

    return df.mapInArrow(run, T.StructType([*rest, *new]))


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow(f.dataType)) for f in kind])
    return {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}[kind.simpleString()]
