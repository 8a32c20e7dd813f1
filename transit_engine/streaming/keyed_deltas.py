"""A table with one row per key, kept as small deltas over compacted slots.

Every micro-batch adds a delta, the new rows of the keys it touches, so what a batch writes grows
with the batch and not with the table. Keys are dealt to slots by hash. Batch N also compacts slot
``N mod slots``: the slot's rows so far, newest per key, become its base, and deltas that all slots
have compacted are dropped. A slot is so read as its newest base and the deltas after it, fewer than
twice the number of slots; a key's newest row wins.

    deltas/batch=N/slot=S/until=T/...     bases/upto=N/slot=S/until=T/...

``until`` is a time (seconds) that all rows below it were written before. With a life time, rows are
laid out by parts of it, and a reader passes over whole folders of expired rows.

A batch that runs again overwrites its delta and its base and gives the same table. A marker written
last makes a batch count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLOTS = 64
# What may run again or still be read: the state before the last batches.
KEPT_VERSIONS = 3
TIME_PARTS = 3  # folders per life time
NEVER = 1 << 40
COMPLETE = "_complete"
_PLACE = "slot int, until long"


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _numbered(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """The numbers behind ``prefix`` in the names of the sub-folders, in order."""
    files, path = _files(spark, folder)
    if not files.exists(path):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(path)]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


def complete(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Those of the numbered sub-folders that carry the marker."""
    files, _ = _files(spark, folder)
    path = spark._jvm.org.apache.hadoop.fs.Path
    return [n for n in _numbered(spark, folder, f"{name}=") if files.exists(path(f"{folder}/{name}={n}/{COMPLETE}"))]


def mark_complete(spark: SparkSession, folder: str) -> None:
    files, path = _files(spark, f"{folder}/{COMPLETE}")
    files.create(path, True).close()


def drop_folder(spark: SparkSession, folder: str) -> None:
    files, path = _files(spark, folder)
    files.delete(path, True)


def _bases(spark: SparkSession, folder: str, version: int) -> dict[int, int]:
    """The newest base of each slot that has one, up to a version."""
    newest: dict[int, int] = {}
    for upto in complete(spark, f"{folder}/bases", "upto"):
        if upto <= version:
            newest |= {slot: upto for slot in _numbered(spark, f"{folder}/bases/upto={upto}", "_slot-")}
    return newest


def _check_slots(spark: SparkSession, folder: str, slots: int) -> None:
    """A table keeps the number of slots it was begun with."""
    known = _numbered(spark, folder, "_slots-")
    if known and known != [slots]:
        raise ValueError(f"{folder} has {known[0]} slots, not {slots}")
    if not known:
        files, path = _files(spark, f"{folder}/_slots-{slots}")
        files.mkdirs(path)


def _until(written: Column, ttl_seconds: int | None) -> Column:
    """The end of the part of a life time that a row was written in."""
    if ttl_seconds is None:
        return F.lit(NEVER).cast("long")
    width = max(1, ttl_seconds // TIME_PARTS)
    return ((F.floor(F.unix_micros(written) / (width * 1_000_000)) + 1) * width).cast("long")


def read_rows(
    spark: SparkSession,
    folder: str,
    schema: str,
    keys: Sequence[str],
    before: int | None = None,
    alive_after: int | None = None,
    slots: Sequence[int] | None = None,
) -> DataFrame:
    """The newest row of each key, after all batches or after those ``before`` one.

    ``alive_after`` (seconds) passes over folders that were written before it as a whole; rows that
    are too old may still be among the others. ``slots`` reads only some.
    """
    names = StructType.fromDDL(schema).names
    batches = [b for b in complete(spark, f"{folder}/deltas", "batch") if before is None or b < before]
    if not batches:
        return spark.createDataFrame([], schema)
    bases = _bases(spark, folder, batches[-1])
    oldest = min(bases.values()) if len(bases) == _slots(spark, folder) else -1
    deltas = [f"{folder}/deltas/batch={b}" for b in batches if b > oldest or b == batches[-1]]
    reader = spark.read.schema(f"{schema}, {_PLACE}, batch long").option("basePath", f"{folder}/deltas")
    # Which deltas a slot still needs is decided on folder names.
    newer = F.lit(True)
    if bases:
        pairs = [x for slot, n in bases.items() for x in (F.lit(slot), F.lit(n).cast("long"))]
        upto = F.create_map(*pairs)
        newer = F.col("batch") > F.coalesce(F.try_element_at(upto, F.col("slot")), F.lit(-1).cast("long"))
    rows = reader.parquet(*deltas).where(newer).select(*names, "slot", "until", "batch")
    paths = sorted({f"{folder}/bases/upto={upto}" for upto in bases.values()})
    if paths:
        held = spark.read.schema(f"{schema}, {_PLACE}, upto long").option("basePath", f"{folder}/bases").parquet(*paths)
        newest = F.try_element_at(upto, F.col("slot")) == F.col("upto")
        rows = rows.unionByName(held.where(newest).select(*names, "slot", "until", F.lit(-1).cast("long").alias("batch")))
    if alive_after is not None:
        rows = rows.where(F.col("until") > alive_after)
    if slots is not None:
        rows = rows.where(F.col("slot").isin(*slots))
    last = F.max_by(F.struct(*names), "batch")
    return rows.groupBy(*keys).agg(last.alias("row")).select("row.*")


def alive_since(spark: SparkSession, folder: str, before: int | None = None) -> int | None:
    """The time (microseconds) that rows must be written after to be alive as of the last batch."""
    batches = [b for b in complete(spark, f"{folder}/deltas", "batch") if before is None or b < before]
    marks = _numbered(spark, f"{folder}/deltas/batch={batches[-1]}", "_alive-") if batches else []
    return marks[-1] if marks else None


def _slots(spark: SparkSession, folder: str) -> int:
    return next(iter(_numbered(spark, folder, "_slots-")), 0)


def _placed(rows: DataFrame, keys: Sequence[str], written: str, ttl_seconds: int | None, slots: int) -> DataFrame:
    slot = F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")
    return rows.withColumn("slot", slot).withColumn("until", _until(F.col(written), ttl_seconds))


def _write(rows: DataFrame, target: str) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("slot", "until").parquet(target)


def write_delta(
    rows: DataFrame,
    folder: str,
    batch: int,
    keys: Sequence[str],
    written: str,
    ttl_seconds: int | None = None,
    slots: int = SLOTS,
) -> DataFrame:
    """Write the batch's rows, one per key, and give them back as written.

    ``written`` is the column with the time a row was written. The rows count once ``compact`` has
    run for the batch.
    """
    spark, target = rows.sparkSession, f"{folder}/deltas/batch={batch}"
    _check_slots(spark, folder, slots)
    drop_folder(spark, f"{target}/{COMPLETE}")
    _write(_placed(rows, keys, written, ttl_seconds, slots).repartition("slot"), target)
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return spark.read.schema(f"{names}, {_PLACE}").parquet(target).select(*rows.columns)


def compact(
    spark: SparkSession,
    folder: str,
    batch: int,
    schema: str,
    keys: Sequence[str],
    written: str,
    ttl_seconds: int | None = None,
    now: Column | None = None,
    slots: int = SLOTS,
) -> None:
    """Compact one slot and let the batch count; of that slot, rows over at ``now`` go.

    The first ``slots`` batches are few enough to be read as they are.
    """
    delta = f"{folder}/deltas/batch={batch}"
    if batch >= slots:
        _write_base(spark, folder, batch, schema, keys, written, ttl_seconds, now, slots)
    if ttl_seconds is not None:
        since = spark.range(1).select(F.unix_micros(now)).first()[0] - ttl_seconds * 1_000_000
        files, path = _files(spark, f"{delta}/_alive-{since}")
        files.mkdirs(path)
    mark_complete(spark, delta)
    _drop_old(spark, folder, batch - KEPT_VERSIONS, slots)


def _write_base(
    spark: SparkSession,
    folder: str,
    batch: int,
    schema: str,
    keys: Sequence[str],
    written: str,
    ttl_seconds: int | None,
    now: Column | None,
    slots: int,
) -> None:
    slot, names = batch % slots, StructType.fromDDL(schema).names
    delta, target = f"{folder}/deltas/batch={batch}", f"{folder}/bases/upto={batch}"
    held = read_rows(spark, folder, schema, keys, before=batch, slots=[slot])
    added = spark.read.schema(f"{schema}, {_PLACE}").parquet(delta).where(F.col("slot") == slot).select(*names)
    stacked = held.withColumn("_new", F.lit(0)).unionByName(added.withColumn("_new", F.lit(1)))
    base = stacked.groupBy(*keys).agg(F.max_by(F.struct(*names), "_new").alias("row")).select("row.*")
    if ttl_seconds is not None:
        age_us = F.unix_micros(now) - F.unix_micros(written)
        base = base.where(age_us < ttl_seconds * 1_000_000)
    _write(_placed(base, keys, written, ttl_seconds, slots), target)
    # A base of no rows has no folder for its slot.
    files, path = _files(spark, f"{target}/_slot-{slot}")
    files.mkdirs(path)
    mark_complete(spark, target)


def _drop_old(spark: SparkSession, folder: str, version: int, slots: int) -> None:
    """Removes what neither the state after ``version`` nor a later one needs."""
    bases = _bases(spark, folder, version)
    for upto in complete(spark, f"{folder}/bases", "upto"):
        if upto <= version and upto not in bases.values():
            drop_folder(spark, f"{folder}/bases/upto={upto}")
    if len(bases) == slots:
        oldest = min(bases.values())
        for batch in complete(spark, f"{folder}/deltas", "batch"):
            if batch <= oldest and batch < version:
                drop_folder(spark, f"{folder}/deltas/batch={batch}")
