"""Small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from costpulse.session import ensure_checkpoint_dir

NULL_FOLD = -1
LEAST = 4        # texts a label keeps in a bounded sample, if need be as leading parts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared checkpoint folder (``spark.checkpoint.dir``); a
    lost executor then costs a re-read, never a recomputation of the whole lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def fresh(taken, *names: str) -> list[str]:
    """``names``, each with underscores before it until no column in ``taken`` is called so."""
    used, out = set(map(str.lower, taken)), []
    for name in names:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def fold(key: str, n: int):
    """crc32 of the id's decimal text modulo ``n``; ``NULL_FOLD`` where the id is null."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % F.lit(n), F.lit(NULL_FOLD)).cast("int")


def _share_out(lengths: dict, max_bytes: int) -> list:
    """(label, place, bytes) of the texts that each label takes from its ``lengths`` by rank.
    Labels that ask for little come first and leave the rest of their share (the bytes left over
    the labels left) to the others, so a share is at least ``max_bytes`` / labels. A text that
    doesn't fit what is left of the share is skipped; a label that so keeps fewer than
    ``LEAST`` texts takes the leading parts of its first ones."""
    left, taken = max_bytes, []
    order = sorted(lengths, key=lambda y: (sum(lengths[y]), str(y)))
    for n, y in enumerate(order):
        share = left // (len(order) - n)
        room, own = share, []
        for i, size in enumerate(lengths[y]):
            if size <= room:
                own.append((i, size))
                room -= size
        if len(own) < min(LEAST, len(lengths[y])):
            parts = max(1, min(LEAST, len(lengths[y]), share))
            own = [(i, min(size, share // parts)) for i, size in enumerate(lengths[y][:parts])]
        left -= sum(size for _, size in own)
        taken += [(y, i, size) for i, size in own]
    return taken


def bounded_sample(rows: DataFrame, label: str, text: str, per_label: int, max_bytes: int,
                   marks: DataFrame | None = None, key: str | None = None, salt: int = 7) -> list:
    """(label, hash, text) of at most ``per_label`` rows of each label and ``max_bytes`` of text
    in all, picked by a hash of the text (so copies of one text count once), collected to
    the driver. ``label`` is a column of ``rows``, or of ``marks``, then joined by ``key``.

    Only hashes and lengths are joined and ranked, and Spark keeps ``per_label`` rows of each
    partition before it shuffles them (window group limit); texts are fetched by a broadcast
    of the chosen hashes. Every label has its share of the bytes (``_share_out``); texts above
    ``max_bytes`` rank last."""
    keyed = rows.withColumn("_h", F.xxhash64(F.lit(salt), F.col(text)))
    slim = keyed.select(*([label] if marks is None else [key]), "_h",
                        F.octet_length(text).alias("_bytes"))
    slim = slim if marks is None else slim.join(marks, key)
    slim = slim.groupBy(label, "_h").agg(F.min("_bytes").alias("_bytes"))
    ranked = (slim.withColumn("_rank", F.row_number().over(
        Window.partitionBy(label).orderBy(F.col("_bytes") > max_bytes, "_h")))
        .filter(F.col("_rank") <= per_label))
    picks: dict = {}
    for r in sorted(ranked.collect(), key=lambda r: r["_rank"]):
        picks.setdefault(r[label], []).append((r["_h"], r["_bytes"]))
    chosen = [(y, *picks[y][i], n) for y, i, n in
              _share_out({y: [n for _, n in own] for y, own in picks.items()}, max_bytes)]
    if not chosen:
        return []
    most: dict = {}
    for _, h, _, n in chosen:
        most[h] = max(n, most.get(h, 0))
    wanted = rows.sparkSession.createDataFrame(list(most.items()), "_h long, _most int")
    part = F.substring(F.col(text).cast("binary"), F.lit(1), F.col("_most"))
    texts = {r["_h"]: bytes(r["_t"]) for r in
             keyed.join(F.broadcast(wanted), "_h").select("_h", part.alias("_t"))
             .groupBy("_h").agg(F.min("_t").alias("_t")).collect()}   # at most labels x per_label
    # a leading part may end within a character
    return sorted(((y, h, texts[h][:n].decode("utf-8", "replace" if n == size else "ignore"))
                   for y, h, size, n in chosen), key=lambda r: (str(r[0]), r[1]))


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds of texts at once: rows and bytes of an Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
