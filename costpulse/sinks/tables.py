"""K1-K3, K5, K9: Parquet table writers used by the batch jobs and by ``foreachBatch``.

* ``upsert`` (K1, K2): keyed upsert into a partitioned Parquet table. Only the partitions
  touched by the batch are read, merged with the batch and rewritten (dynamic partition
  overwrite). The merge is an aggregate, ``max_by(row, (source rank, order...))`` per key,
  so duplicates of a hot key are combined map-side before the shuffle.
* ``append_batch`` (K3): append that survives replay: rows go to a ``batch_id`` partition
  which a re-run of the same micro-batch overwrites.
* ``write_all`` (K5): one computation, several sinks: persist once, write each, release.

Layout (K9): partitioned by event date and sorted by (model, time) within files, so date
ranges prune directories and model/time predicates skip row groups by min/max statistics.

Limits, stated because no table format with MERGE is installed: the partition rewrite is
not atomic for concurrent readers, and an event re-sent with a different date leaves its
old row in the old date partition (``latest_by_key`` resolves that at read time; for reads
of a range the key index, ``keyindex``, tells what lies outside it).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costpulse.sinks import keyindex

SOURCE_RANK = "_source_rank"


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds data: a visible file or partition directory. (Dynamic
    partition overwrite leaves no ``_SUCCESS`` marker at the table root.)"""
    Path, fs = filesystem(spark, path)
    hpath = Path(path)
    if not fs.exists(hpath):
        return False
    return any(not s.getPath().getName().startswith(("_", "."))
               for s in fs.listStatus(hpath))


def latest_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the greatest by ``order`` (ties: greatest 64-bit row hash, so the
    choice does not depend on arrival order inside Spark).

    An aggregate, not a window: partial aggregation keeps one candidate per key per input
    partition, so a key with millions of duplicates never lands whole in one task.
    """
    cols = [F.col(c) for c in df.columns]
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    best = F.max_by(F.struct(*cols), F.struct(*order_cols, F.xxhash64(*cols)))
    return df.groupBy(*key).agg(best.alias("_row")).select("_row.*")


def upsert(spark: SparkSession, batch: DataFrame, path: str, key: Sequence[str],
           order: Sequence[str], partition_cols: Sequence[str] = ("dt",),
           sort_cols: Sequence[str] = (), drop: Sequence[str] = ()) -> None:
    """Keyed upsert: for each key the batch row wins over the stored row, and among batch
    rows the greatest by ``order`` wins. ``drop`` names batch-only columns (e.g. arrival
    metadata used in ``order``) that are not stored."""
    # Two actions read the batch (touched partitions, then the merge): compute it once, which
    # also keeps a streaming micro-batch from being executed twice.
    owned = not batch.is_cached
    if owned:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _upsert(spark, batch, path, key, order, partition_cols, sort_cols, drop)
    finally:
        if owned:
            batch.unpersist()


def _upsert(spark, batch, path, key, order, partition_cols, sort_cols, drop) -> None:
    if batch.isEmpty():
        return
    incoming = batch.withColumn(SOURCE_RANK, F.lit(1))
    if table_exists(spark, path):
        # Only the touched partitions: a semi-join on their values, which prunes the other
        # directories at run time, however many there are.
        touched = batch.select(*[F.col(c).alias(f"_t_{c}") for c in partition_cols]).distinct()
        stored = spark.read.parquet(path)
        same = [stored[c].eqNullSafe(touched[f"_t_{c}"]) for c in partition_cols]
        stored = stored.join(touched, same, "left_semi").withColumn(SOURCE_RANK, F.lit(0))
        combined = stored.unionByName(incoming, allowMissingColumns=True)
    else:
        combined = incoming
    merged = latest_by_key(combined, key, [SOURCE_RANK, *order]).drop(SOURCE_RANK, *drop)
    write_partitioned(merged, path, partition_cols, sort_cols)


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str],
                      sort_cols: Sequence[str] = ()) -> None:
    """Dynamic partition overwrite: only partitions present in ``df`` are replaced.

    ``rebalance`` clusters rows by partition value so each task writes few files, and lets
    AQE split a partition value that holds a large share of the rows (a hot date) across
    several tasks instead of one.
    """
    out = df.hint("rebalance", *partition_cols)
    if sort_cols:
        out = out.sortWithinPartitions(*partition_cols, *sort_cols)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols).parquet(path))


RUN_FILE = "_costpulse_run"
BATCHES_PER_RUN = 1_000_000


def new_run() -> int:
    """First batch number of a run that starts now. Numbers of different runs never meet, and
    those of a later run are larger, so "the last batch wins" holds across runs."""
    return time.time_ns() // 1_000_000 * BATCHES_PER_RUN


def run_of(spark: SparkSession, checkpoint: str) -> int:
    """First batch number of the stream with this checkpoint folder. It is kept in the folder:
    a restarted stream goes on with its numbers, a new checkpoint is a new run."""
    Path, fs = filesystem(spark, checkpoint)
    name = Path(f"{checkpoint.rstrip('/')}/{RUN_FILE}")
    if fs.exists(name):
        stream = fs.open(name)
        try:
            return int(stream.readLong())
        finally:
            stream.close()
    first = new_run()
    out = fs.create(name, False)
    try:
        out.writeLong(first)
    finally:
        out.close()
    return first


def append_batch(df: DataFrame, batch_id: int, path: str,
                 partition_cols: Sequence[str] = (), sort_cols: Sequence[str] = (),
                 index: keyindex.KeyIndex | None = None) -> None:
    """K3: append-only table, idempotent per micro-batch (replay overwrites the batch). With
    ``index`` the batch is entered in the table's key index once it is stored.

    A date that receives rows after it was compacted loses its compaction marker, so
    readers deduplicate it again (late events are rare, the check reads metadata only).
    """
    rows = df.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
    if tuple(partition_cols) == ("dt",):
        # A replay may put rows under another date (processing time past midnight): what an
        # earlier attempt of this batch wrote goes first.
        Path, fs = filesystem(df.sparkSession, path)
        for st in fs.globStatus(Path(f"{path.rstrip('/')}/dt=*/batch_id={int(batch_id)}")) or []:
            fs.delete(st.getPath(), True)
    write_partitioned(rows, path, [*partition_cols, "batch_id"], sort_cols)
    if tuple(partition_cols) == ("dt",):
        spark = df.sparkSession
        Path, fs = filesystem(spark, path)
        # Dates this batch wrote, from the directory layout (no recomputation of the batch).
        written = fs.globStatus(Path(f"{path.rstrip('/')}/dt=*/batch_id={int(batch_id)}"))
        for st in written or []:
            marker = Path(st.getPath().getParent(), COMPACTED_MARKER)
            if fs.exists(marker):
                fs.delete(marker, False)
        if index is not None:
            keyindex.write(spark, path, int(batch_id), index)


def filesystem(spark: SparkSession, path: str):
    """(Path class, Hadoop FileSystem) for ``path``: metadata operations on the driver."""
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    return Path, Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_all(df: DataFrame, writers: Sequence[Callable[[DataFrame], None]],
              keep: bool = True) -> None:
    """K5: feed several sinks from one computation (``keep``: held until all have it)."""
    if not keep:
        for write in writers:
            write(df)
        return
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for write in writers:
            write(df)
    finally:
        df.unpersist()


# Folder number of compacted rows; their own batch numbers are a column of the files.
COMPACTED_BATCH = -1
OWN_BATCH = "own_batch_id"


def read_deliveries(spark: SparkSession, path: str,
                    extra: Sequence[T.StructField] = (),
                    folders: Sequence[str] = ()) -> DataFrame:
    """The stored rows as delivered: ``batch_id`` is the batch that brought the row, whether
    its date was compacted since or not. (An upserted table has no batches.) ``extra`` columns
    are null in files written without them; ``folders`` limits the read to some partitions."""
    parts = list(folders) or [path]

    def reader():
        return spark.read.option("basePath", path)

    found = reader().parquet(*parts)
    more = [f for f in extra if f.name not in found.columns]
    if "batch_id" not in found.columns:
        return reader().schema(T.StructType([*more, *found.schema.fields])).parquet(*parts) \
            if more else found
    fields = [*more, *(T.StructField(f.name, T.LongType()) if f.name == "batch_id" else f
                       for f in found.schema.fields if f.name != OWN_BATCH)]
    schema = T.StructType([T.StructField(OWN_BATCH, T.LongType()), *fields])
    return (reader().schema(schema).parquet(*parts)
            .withColumn("batch_id", F.coalesce(F.col(OWN_BATCH), F.col("batch_id")))
            .drop(OWN_BATCH))


def compact(spark: SparkSession, path: str, dates: Sequence, key: Sequence[str],
            order: Sequence[str], partition_col: str = "dt",
            sort_cols: Sequence[str] = (), index: keyindex.KeyIndex | None = None,
            merge: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Rewrite the given date partitions of an append-only (merge-on-read) table with one
    row per key (the latest, or what ``merge`` makes of the rows), as few files per date: all batches of a date share one folder, and each
    surviving row keeps its batch number as a column (``read_deliveries``).

    The rows are written to a hidden staging folder in one job, the inputs untouched, then
    each date directory is swapped in by rename. Run it on dates the landing no longer
    writes to (older than the watermark plus a margin): a batch appended to a date between
    the read and the swap would be replaced with the rest of that date.
    """
    dates = list(dates)
    if not dates or not table_exists(spark, path):
        return
    rows = read_deliveries(spark, path).where(F.col(partition_col).isin(dates))
    one = merge(rows) if merge else latest_by_key(rows, key, order)
    latest = (one.withColumnRenamed("batch_id", OWN_BATCH)
              .withColumn("batch_id", F.lit(COMPACTED_BATCH).cast("long")))
    staging = f"{path.rstrip('/')}/_compact_{uuid.uuid4().hex}"
    write_partitioned(latest, staging, [partition_col, "batch_id"], sort_cols)
    Path, fs = filesystem(spark, path)
    swapped = []
    for d in dates:
        name = f"{partition_col}={d}"
        target, fresh = Path(f"{path.rstrip('/')}/{name}"), Path(f"{staging}/{name}")
        if not fs.exists(fresh):
            continue
        old = Path(f"{staging}/_old_{name}")
        if fs.exists(target) and not fs.rename(target, old):
            raise OSError(f"cannot move {target} aside")
        if not fs.rename(fresh, target):
            fs.rename(old, target)
            raise OSError(f"cannot move {fresh} into place")
        fs.delete(old, True)
        fs.create(Path(f"{path.rstrip('/')}/{name}/{COMPACTED_MARKER}"), True).close()
        swapped.append(str(d))
    if index is not None:
        keyindex.merge(spark, path, swapped, index)
    fs.delete(Path(staging), True)


COMPACTED_MARKER = "_COMPACTED"


def partition_dates(spark: SparkSession, path: str, partition_col: str = "dt") -> list[str]:
    """Values of the date partitions present (directory metadata only)."""
    Path, fs = filesystem(spark, path)
    found = fs.globStatus(Path(f"{path.rstrip('/')}/{partition_col}=*"))
    return sorted(str(st.getPath().getName()).split("=", 1)[1] for st in (found or []))


def compacted_dates(spark: SparkSession, path: str, partition_col: str = "dt") -> list[str]:
    """Dates whose partition holds one row per key (marker written by ``compact``, removed
    by ``append_batch`` when a later batch lands in the date). Directory metadata only."""
    Path, fs = filesystem(spark, path)
    found = fs.globStatus(Path(f"{path.rstrip('/')}/{partition_col}=*/{COMPACTED_MARKER}"))
    return sorted(str(st.getPath().getParent().getName()).split("=", 1)[1]
                  for st in (found or []))


def with_date(df: DataFrame, time_col: str, name: str = "dt") -> DataFrame:
    return df.withColumn(name, F.to_date(F.col(time_col)))
