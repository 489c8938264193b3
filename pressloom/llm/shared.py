"""What several operators need: inputs as Arrow batches, tables in the shared folder, size checks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.lineage import shared_dir


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores behind it a name that ``df`` has no column of."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(column: str) -> Column:
    """A text as bytes, so that workers need not decode it; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


#: Most of a batch that goes to a Python worker, so that JVM and worker hold little outside of the heap.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of the session are cut by bytes; a smaller bound of its own stays."""
    name, most = BATCH_BYTES
    if int(spark.conf.get(name).rstrip("b")) > most:
        spark.conf.set(name, str(most))


def map_arrow(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterable[dict]], schema: str
) -> DataFrame:
    """``mapInArrow`` for functions that yield dicts of columns; empty ones are left out."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    small_batches(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function(batches):
            arrays = [pa.array(columns[f.name], f.type) for f in arrow]
            if len(arrays[0]):
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def without(df: DataFrame, ids: DataFrame, key: str, most: int = 1_000_000) -> DataFrame:
    """Rows of ``df`` whose key is not among ``ids``: by a broadcast of up to ``most`` ids, else a join."""
    ids = stored(ids.select(key).distinct())
    return df.join(F.broadcast(ids) if ids.count() <= most else ids, key, "left_anti").select(*df.columns)


def send(spark: SparkSession, value: object) -> Broadcast:
    """Broadcast objects of this package's classes to workers that cannot import it."""
    small_batches(spark)
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(sent: Broadcast):
    return cloudpickle.loads(sent.value)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back from there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more."""
    spark = df.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
