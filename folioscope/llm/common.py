"""Shared helpers: scratch tables in the cluster's shared folder, Arrow row streams, components."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters that separate words.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of this session; only a local master may fall back to a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="folioscope-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files; else they stay until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, own) if own is not None else spark.conf.unset(name)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage is cut, executors may be lost."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def materialize_bucketed(df: DataFrame, label: str, key: str) -> DataFrame:
    """:func:`materialize` in buckets by ``key``, as many as shuffles have partitions: joins on ``key`` leave the rows where they are.

    Spark writes buckets for tables of its catalogue only, so there is one for a
    moment; its files stay in the shared folder.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    path, table = f"{scratch_root(spark)}/{name}", f"spark_catalog.default.{name}"
    df.write.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("path", path).saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the files are not the catalogue's and stay
    out._scratch_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`materialize` that no later plan reads."""
    path = getattr(df, "_scratch_path", None)
    if path:
        jvm = df.sparkSession.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


#: Tables of at most so many bytes in the shared folder (compressed) are broadcast; larger ones are joined by shuffle.
BROADCAST_BYTES = 4 << 20


def is_small(df: DataFrame) -> bool:
    """Whether the files of a table made by :func:`materialize` are small enough for a broadcast."""
    spark = df.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
    size = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getContentSummary(p).getLength()
    return size <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df``, a table made by :func:`materialize`, marked for broadcast if its files are small."""
    return F.broadcast(df) if is_small(df) else df


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with so many underscores before it that no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def every(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


#: Keys with more than this part of a table's rows are hot; there are fewer than its inverse.
HOT_SHARE = 0.001


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """Inner join with ``right``, which holds each key once and in ``weight`` the number of its rows in ``left``.

    Hot keys (fewer than ``1 / HOT_SHARE``, as ``left`` has ``total`` rows) are
    broadcast, so that their rows stay where they are; all others are shuffled.
    ``weight`` is dropped.  Both tables are read twice.
    """
    hot = right.where(F.col(weight) > HOT_SHARE * total).drop(weight)
    rest = right.where(F.col(weight) <= HOT_SHARE * total).drop(weight)
    cold = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return left.join(F.broadcast(hot), keys).unionByName(cold.join(rest, keys))


def utf8(column: str) -> Column:
    """A text column as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def releasing(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``; after each task the worker, which Spark keeps, gives its free memory back."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # not every C library can
            ctypes.CDLL(None).malloc_trim(0)

    return task


def map_rows(
    df: DataFrame,
    schema: str,
    make: Callable[[], Callable[[dict[str, list]], dict[str, list]]],
    chunk: int = 512,
) -> DataFrame:
    """``mapInArrow`` over column lists: ``make()`` runs once a task and returns the function for a chunk of rows."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for start in range(0, batch.num_rows, chunk):
                out = step(batch.slice(start, chunk).to_pydict())
                if len(out[arrow.names[0]]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow
                    )

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``size`` bytes in ``column``; a longer value stands in a run of its own."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = int(ends[start - 1]) if start else 0
        stop = max(int(np.searchsorted(ends, before + size, "right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def connected_components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an undirected edge list; the component is its smallest node.

    Alternates large-star and small-star steps; each step is one or two
    aggregations, its edges are written to the shared folder, a hub's
    neighbours are only ever reduced to their minimum, and they are not
    gathered to learn it.
    """
    def distinct_edges(df: DataFrame) -> DataFrame:
        return df.where("a <> b").distinct()

    current = materialize(
        distinct_edges(edges.select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b"))), "cc"
    )
    state = None
    while True:
        # large star: every node hands its larger neighbours to its smallest neighbour (itself included)
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = F.least(F.min("b"), F.first("a")).alias("m")
        low = materialize(both.groupBy("a").agg(lowest, F.count_if(F.expr("b > a")).alias("times")).where("times > 0"), "cc")
        upper = join_hot(both.where("b > a"), low, ["a"], "times", current.count())
        large = materialize(distinct_edges(upper.select(F.col("b").alias("a"), F.col("m").alias("b"))), "cc")
        discard(low)
        # small star: every node and its smaller neighbours point to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = materialize(
            distinct_edges(
                large.join(low, "a")
                .select(F.col("b").alias("a"), F.col("m").alias("b"))
                .union(low.select("a", F.col("m").alias("b")))
            ),
            "cc",
        )
        mark = small.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        changed, state = mark != state, mark
        discard(current)
        discard(large)
        current = small
        if not changed:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
