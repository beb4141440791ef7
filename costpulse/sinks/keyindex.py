"""Where a key lies: an index of stored deliveries beside a merge-on-read table.

A key of the event table may be re-sent under another date, so a read of a date range has to know
which of its rows a delivery outside the range has replaced. Beside the table, in a folder that
table reads skip (``_keys``), every batch leaves one small row per stored row: a 128-bit hash of
the key, the row's time, its arrival and its batch, sorted by hash. Folders are named by date
and by the first and last batch inside (``dt=/first=/last=``).

A ranged read (``replaced``) opens index folders of dates and times outside its range only, and of
those only the ones whose last batch is not older than every batch in its range: an older one
can't have replaced anything. With deliveries in time order these are none; data files outside
the range are never opened for an indexed batch. Batches stored without an index (older tables,
a crash between data and index) are found by comparing folder names, and their key columns
are read from the data instead, so the answer is exact in every state.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costpulse.functions import timefn

FOLDER = "_keys"
MERGED = "_MERGED"             # marks a date whose compacted rows are in its index
ARRIVAL = "arrival_key"
_SCHEMA = T.StructType([
    T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()),
    T.StructField("at", T.TimestampNTZType()), T.StructField("arrival", T.StringType()),
    T.StructField("batch", T.LongType())])


@dataclass(frozen=True)
class KeyIndex:
    """What a table's index is built from."""
    key: tuple[str, ...]
    time: str


@dataclass(frozen=True)
class Folder:
    date: str
    first: int
    last: int
    path: str


def _filesystem(spark: SparkSession, path: str):
    from costpulse.sinks.tables import filesystem
    return filesystem(spark, path)


def _glob(spark: SparkSession, path: str, pattern: str) -> list[str]:
    Path, fs = _filesystem(spark, path)
    return [st.getPath().toString() for st in fs.globStatus(Path(f"{path.rstrip('/')}/{pattern}")) or []]


def folders(spark: SparkSession, path: str) -> list[Folder]:
    """The index folders of a table (names only)."""
    found = []
    for f in _glob(spark, path, f"{FOLDER}/dt=*/first=*/last=*"):
        date, first, last = re.search(r"dt=([^/]+)/first=(-?\d+)/last=(-?\d+)/?$", f).groups()
        found.append(Folder(date, int(first), int(last), f))
    return found


def data_folders(spark: SparkSession, path: str) -> list[Folder]:
    """The data folders of a table (names only); compacted rows have batch -1."""
    found = []
    for f in _glob(spark, path, "dt=*/batch_id=*"):
        date, batch = re.search(r"dt=([^/]+)/batch_id=(-?\d+)/?$", f).groups()
        found.append(Folder(date, int(batch), int(batch), f))
    return found


def _places(rows: DataFrame, index: KeyIndex, *more: str) -> DataFrame:
    arrival = F.col(ARRIVAL) if ARRIVAL in rows.columns else F.lit(None)
    return rows.select(*_hashes(index), F.col(index.time).cast("timestamp_ntz").alias("at"),
                       arrival.cast("string").alias("arrival"), F.col("batch_id").alias("batch"), *more)


def _hashes(index: KeyIndex):
    return [F.xxhash64(F.lit(seed), *index.key).alias(name) for seed, name in ((1, "h1"), (2, "h2"))]


def _rows_of(spark: SparkSession, path: str, parts: Sequence[Folder], index: KeyIndex,
             *more: str) -> DataFrame:
    """Index rows read from data folders themselves (key, time and arrival columns only)."""
    from costpulse.sinks.tables import read_deliveries
    return _places(read_deliveries(spark, path, folders=[p.path for p in parts]), index, *more)


def write(spark: SparkSession, path: str, batch_id: int, index: KeyIndex) -> None:
    """Index what batch ``batch_id`` has just stored, from its own files. A replay replaces what
    an earlier attempt of the batch left."""
    Path, fs = _filesystem(spark, path)
    for old in _glob(spark, path, f"{FOLDER}/dt=*/first={batch_id}/last={batch_id}"):
        fs.delete(Path(old), True)
    parts = [Folder(re.search(r"dt=([^/]+)/", f).group(1), batch_id, batch_id, f)
             for f in _glob(spark, path, f"dt=*/batch_id={batch_id}")]
    if not parts:
        return
    rows = _rows_of(spark, path, parts, index)
    target = f"{path.rstrip('/')}/{FOLDER}"
    (rows.withColumn("dt", F.to_date("at"))
         .withColumn("first", F.lit(batch_id)).withColumn("last", F.lit(batch_id))
         .hint("rebalance", "dt").sortWithinPartitions("dt", "h1")
         .write.mode("append").partitionBy("dt", "first", "last").parquet(target))


def merge(spark: SparkSession, path: str, dates: Sequence[str], index: KeyIndex) -> None:
    """Index compacted dates by their surviving rows, one folder a date, all dates in one job.
    Older folders of a date hold at most superfluous rows, so they go last and a crash in between
    does no harm."""
    Path, fs = _filesystem(spark, path)
    wanted = set(dates)
    parts = [f for f in data_folders(spark, path) if f.date in wanted]
    if not parts:
        return
    before = [f for f in folders(spark, path) if f.date in wanted]
    rows = _rows_of(spark, path, parts, index, "dt").withColumn("dt", F.col("dt").cast("string"))
    ends = {r["dt"]: (r["first"], r["last"]) for r in
            rows.groupBy("dt").agg(F.min("batch").alias("first"), F.max("batch").alias("last")).collect()
            if r["first"] is not None}
    if not ends:
        return
    named = spark.createDataFrame([(d, *e) for d, e in ends.items()], "dt string, first long, last long")
    target = f"{path.rstrip('/')}/{FOLDER}"
    (rows.join(F.broadcast(named), "dt")
         .hint("rebalance", "dt").sortWithinPartitions("dt", "h1")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("dt", "first", "last").parquet(target))
    for date in ends:
        fs.create(Path(f"{target}/dt={date}/{MERGED}"), True).close()
    for f in before:
        first, last = ends.get(f.date, (f.first, f.last))
        if (f.first, f.last) != (first, last) and f.last <= last:
            fs.delete(Path(f.path), True)
            _drop_if_empty(fs, Path(f.path).getParent())


def _drop_if_empty(fs, folder) -> None:
    if not fs.listStatus(folder):
        fs.delete(folder, True)


def outside(spark: SparkSession, path: str, since: dt.datetime, index: KeyIndex
            ) -> tuple[list[Folder], list[Folder]]:
    """(index folders, data folders without an index) that may hold a delivery from before
    ``since`` that replaces a row of the range; by folder names alone."""
    day = since.date().isoformat()
    indexed, data = folders(spark, path), data_folders(spark, path)
    merged = {re.search(r"dt=([^/]+)/", f).group(1) for f in _glob(spark, path, f"{FOLDER}/dt=*/{MERGED}")}
    spans: dict[str, list[Folder]] = {}
    for f in indexed:
        spans.setdefault(f.date, []).append(f)

    def covered(d: Folder) -> bool:
        if d.last < 0:
            return d.date in merged
        return any(f.first <= d.last <= f.last for f in spans.get(d.date, ()))

    bare = [d for d in data if not covered(d)]
    inside = [f.first for f in indexed if f.date >= day] + [d.first for d in bare if d.date >= day]
    if not inside:
        return [], []
    oldest = min(inside)
    return ([f for f in indexed if f.date <= day and f.last >= oldest],
            [d for d in bare if d.date <= day and (d.last < 0 or d.last >= oldest)])


def current(spark: SparkSession, path: str, rows: DataFrame, since: dt.datetime,
            index: KeyIndex) -> DataFrame:
    """``rows`` (one per key, with ``batch_id`` and, if stored, the arrival key) of a range that
    starts at ``since``, without those that a later delivery from before it replaces."""
    indexed, bare = outside(spark, path, since, index)
    places = None
    if indexed:
        places = spark.read.schema(_SCHEMA).parquet(*[f.path for f in indexed])
    if bare:
        found = _rows_of(spark, path, bare, index)
        places = found if places is None else places.unionByName(found)
    if places is None:
        return rows
    places = places.where(F.col("at") < timefn.ntz_lit(since))
    arrival = F.col(ARRIVAL) if ARRIVAL in rows.columns else F.lit(None).cast("string")
    tagged = rows.withColumns({"_h1": _hashes(index)[0], "_h2": _hashes(index)[1]})
    newer = F.struct(F.col("batch"), F.col("arrival")) > F.struct(F.col("batch_id"), arrival)
    # few keys of the range lie outside it: the semi-join keeps those alone, before the rows meet
    found = places.join(tagged.select("_h1", "_h2"),
                        (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left_semi")
    return tagged.join(found, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")) & newer,
                       "left_anti").drop("_h1", "_h2")
