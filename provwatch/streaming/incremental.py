"""Incremental tables: load only new rows, and replace rows by key.

A table is plain Parquet, partitioned by a hash bucket of its key. A merge writes the batch beside the table in the same
buckets and compares both by narrow rows: hashes of key and content, the load time, and where the row is written. What
comes of it are bitmaps of the positions that enter and leave, by which whole rows are filtered where they are read; only
the narrow rows are shuffled. The buckets that change and no others are written: first beside the table, where they are
complete before anything is replaced, then over it by Spark's dynamic partition overwrite, a copy without a shuffle. If
the writer is lost in between, readers take those buckets from where they were prepared, and the next merge finishes the
copy. A table has one writer at a time, as for any overwrite.

The load time of each row is kept with it. For one key the newer load wins whatever the order of arrival, and of
equal load times the later arrival; a row without load time counts as the newest, as it does in a full build. Rows
that change nothing are left out, so a repeated batch is a no-op.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provwatch.operators.joins import anti_join
from provwatch.operators.windows import LARGE, keep_first, keep_first_of_repeated, keep_latest_of_repeated, rank_in_group
from provwatch.sources.schemas import LOAD_TIMESTAMP
from provwatch.sources.sinks import is_written, remove_folder, write_table

_AT, _CONTENT, _BUCKET, _OLD = "row_load_time", "row_content", "table_bucket", "row_is_old"
_HASH, _CHECK, _FILE, _ROW, _CHUNK, _BITS = "key_hash", "key_check", "row_file", "row_number", "row_chunk", "row_bits"
_TIE, _TIED = "row_tie", "is_tied"
# Types whose values are hashed as they are; values of others are hashed as text.
_HASHED = (T.StringType, T.BooleanType, T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)
_CHUNK_ROWS = 2048  # positions in a bitmap
_SENT_CHUNKS = 1_000_000  # bitmaps of 256 bytes up to which they are broadcast: two billion rows
_MARK = T.StructType([T.StructField("high_water", T.TimestampNTZType())])


def _wall_clock(column: str) -> Column:
    return F.col(column).cast("timestamp_ntz")


def _moment(value: datetime) -> Column:
    """A time without zone as a literal; a plain ``F.lit`` would shift it between Python and session zones."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def since_watermark(source: DataFrame, high_water, column: str = LOAD_TIMESTAMP) -> DataFrame:
    """Source rows that may be new: loaded at or after the high-water mark, or without a load time.

    Rows of the mark itself come again, since more of them may have arrived; the merge ignores repeats.
    """
    if high_water is None:
        return source
    return source.filter(F.col(column).isNull() | (_wall_clock(column) >= _moment(high_water)))


def append_new_columns(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Union by name. New columns of the batch are added; columns it lacks are NULL in its rows."""
    return target.unionByName(batch, allowMissingColumns=True)


def upsert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Target with the batch's rows inserted or replaced by key; the batch must be unique by key.

    Only keys of the batch take part in the join, so for a small batch Spark broadcasts them and the
    target is not shuffled.
    """
    return append_new_columns(anti_join(target, batch, key), batch)


def latest_part_d_rows(part_d: DataFrame) -> DataFrame:
    """One landed row per prescriber, drug and load time: of rows with one load time that of the smallest columns.

    Which load time wins is left to the table that the rows are merged into.
    """
    keys = ["PRSCRBR_NPI", "BRND_NAME", "GNRC_NAME", LOAD_TIMESTAMP]
    return keep_latest_of_repeated(part_d, keys, F.col(LOAD_TIMESTAMP).desc_nulls_first())


def _content(df: DataFrame, names: Sequence[str]) -> Column:
    """A hash of the columns by name; NULLs count as absent.

    Each value is followed by a number for its column, so equal values of different columns tell apart. Values are not
    turned into text: for wide rows that takes longer than the model whose rows they are.
    """
    parts: list[Column] = []
    for name in names:
        column = F.col(name)
        plain = isinstance(df.schema[name].dataType, _HASHED)
        parts += [column if plain else column.cast("string"), F.when(column.isNotNull(), F.xxhash64(F.lit(name)))]
    return F.xxhash64(*parts)


def _tie(names: Sequence[str]) -> Column:
    """Decides between different rows of one key and load time: the hash of all values as text."""
    return F.xxhash64(*[F.concat(F.lit(f"{name}="), F.col(name).cast("string")) for name in names])


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with the file and the position in it that they are read from."""
    return rows.select("*", F.xxhash64("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_ROW))


def _chunk() -> Column:
    return F.floor(F.col(_ROW) / _CHUNK_ROWS)


def _marked(rows: DataFrame, marks: DataFrame, sent: int) -> DataFrame:
    """Placed rows with a column that tells whether their position is marked; up to ``sent`` bitmaps go to the rows."""
    found = marks.select(_FILE, _CHUNK, _BITS)
    found = F.broadcast(found) if found.count() <= sent else found
    bit = (F.col(_ROW) % _CHUNK_ROWS).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(_BITS), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.expr("shiftright({}, {}) & 1 = 1".format("__byte", f"cast({_ROW} % 8 as int)"))
    joined = rows.withColumn(_CHUNK, _chunk()).join(found, [_FILE, _CHUNK], "left").withColumn("__byte", byte)
    return joined.withColumn("is_marked", F.coalesce(is_set, F.lit(False))).drop("__byte", _CHUNK, _BITS, _FILE, _ROW)


def _write_buckets(rows: DataFrame, path: str, **options: str) -> None:
    rows.write.mode("overwrite").options(compression="zstd", **options).partitionBy(_BUCKET).parquet(path)


class MergedTable:
    """A table with one row per ``key``, in ``buckets`` partitions; choose about one bucket per few GB.

    Batches carry their load time in ``load_time``; the column is not part of what is read.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        buckets: int = 32,
        load_time: str = LOAD_TIMESTAMP,
        large: int = LARGE,
        sent: int = _SENT_CHUNKS,
    ) -> None:
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.buckets, self.load_time, self.large, self.sent = buckets, load_time, large, sent
        self._rows, self._prepared, self._marks = (f"{self.path}/{n}" for n in ("rows", "prepared", "marks"))

    def exists(self) -> bool:
        return is_written(self.spark, self._rows)

    def high_water(self) -> datetime | None:
        """The newest load time that has been merged."""
        if not is_written(self.spark, self._marks):  # the writer was lost after the very first load
            return self._load(self._rows).agg(F.max(_AT)).first()[0] if self.exists() else None
        return self.spark.read.schema(_MARK).parquet(self._marks).agg(F.max("high_water")).first()[0]

    def _load(self, path: str) -> DataFrame:
        # files written before a column appeared lack it
        return self.spark.read.option("mergeSchema", True).option("basePath", path).parquet(path)

    def _table(self) -> DataFrame:
        """All rows; what has been prepared but not copied yet counts as copied."""
        rows = self._load(self._rows)
        if not is_written(self.spark, self._prepared):
            return rows
        prepared = self._load(self._prepared)
        return append_new_columns(rows.filter(~F.col(_BUCKET).isin(self._buckets_of(prepared))), prepared)

    def _buckets_of(self, df: DataFrame) -> list[int]:
        return sorted(r[0] for r in df.select(_BUCKET).distinct().collect())  # at most ``buckets`` numbers

    def read(self) -> DataFrame:
        if not self.exists():
            raise ValueError(f"{self.path} has not been written")
        return self._table().drop(_AT, _CONTENT, _BUCKET)

    def recover(self) -> None:
        """Finish a copy that was broken off."""
        if is_written(self.spark, self._prepared):
            self._apply()

    def _apply(self) -> None:
        prepared = self._load(self._prepared)
        _write_buckets(prepared, self._rows, partitionOverwriteMode="dynamic")
        self._add_mark(prepared)
        remove_folder(self.spark, self._prepared)

    def _add_mark(self, rows: DataFrame) -> None:
        rows.agg(F.max(_AT).alias("high_water")).write.mode("append").parquet(self._marks)

    def _names(self, rows: DataFrame) -> list[str]:
        """The columns that are a row's content, in order."""
        added = (self.load_time, "_loaded_at", _AT, _CONTENT, _BUCKET, _FILE, _ROW)
        return sorted(c for c in rows.columns if c not in added)

    def _incoming(self, batch: DataFrame) -> DataFrame:
        """The batch with each row's load time, bucket and a hash of its columns by name.

        The time at which the model ran is not part of a row's content; NULLs count as absent.
        """
        at = _wall_clock(self.load_time) if self.load_time in batch.columns else F.lit(None).cast("timestamp_ntz")
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        return batch.withColumns({_AT: at, _CONTENT: _content(batch, self._names(batch)), _BUCKET: bucket}).drop(self.load_time)

    def _first(self, rows: DataFrame, *order: Column) -> DataFrame:
        """One row per key. Rows are dealt by bucket once: that serves the window and the write, too."""
        return keep_first(rows.repartition(_BUCKET), [_BUCKET, self.key], order)

    def _narrow(self, rows: DataFrame, old: bool, ties: bool) -> DataFrame:
        """What rows are compared by, in few bytes. Keys are told apart by 96 bits of two hashes.

        Positions of known rows are counted down from -1. What repeats from row to row stands side by side.
        """
        hashes = [F.xxhash64(self.key).alias(_HASH), _CONTENT, F.hash(self.key).alias(_CHECK)]
        if ties:
            hashes.append((F.lit(0) if old else _tie(self._names(rows))).cast("long").alias(_TIE))
        return rows.select(_FILE, _AT, *hashes, (-F.col(_ROW) - 1 if old else F.col(_ROW)).alias(_ROW))

    def _changes(self, incoming: DataFrame, known: DataFrame, ties: bool) -> DataFrame:
        """Bitmaps of the positions of incoming rows that enter and of known rows that leave for them.

        A row of the batch enters if its key is new, or if it wins over the row that is there and differs from it. Without
        ``ties`` bitmaps tell whether a row in them is one of several different ones of its key and load time.
        """
        rows = self._narrow(incoming, False, ties).unionByName(self._narrow(known, True, ties))
        rows = rows.repartition(_HASH, _CHECK).withColumn(_OLD, F.col(_ROW) < 0)
        # the batch's best row, ..., the known one
        order = [F.col(_OLD), F.col(_AT).desc_nulls_first(), F.col(_TIE if ties else _CONTENT), F.col(_FILE), F.col(_ROW)]
        # the batch's rows of the best one's load time
        alike = Window.partitionBy(_HASH, _CHECK).orderBy(*order[:2])
        tied = (F.min(_CONTENT).over(alike) != F.max(_CONTENT).over(alike)).alias(_TIED)
        whole = Window.partitionBy(_HASH, _CHECK).orderBy(*order)
        whole = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        last = F.last(F.struct(_OLD, _AT, _CONTENT, _FILE, _ROW)).over(whole).alias("last")
        rows = rank_in_group(rows.select("*", last).select("*", tied), [_HASH, _CHECK], order, 1, "place")
        new_at, old_at = F.col(_AT), F.col(f"last.{_AT}")
        wins = new_at.isNull() | (old_at.isNotNull() & (new_at >= old_at))
        differs = (F.col(_CONTENT) != F.col(f"last.{_CONTENT}")) | ~new_at.eqNullSafe(old_at)
        differs = differs if ties else differs | F.col(_TIED)
        fresh = rows.filter(~F.col(_OLD) & (~F.col(f"last.{_OLD}") | (wins & differs)))
        bucket = F.pmod(F.col(_HASH), F.lit(self.buckets)).cast("int").alias(_BUCKET)
        enters = F.struct(_FILE, bucket, _ROW, _TIED)
        leaves = F.struct(F.col(f"last.{_FILE}").alias(_FILE), bucket, F.col(f"last.{_ROW}").alias(_ROW), _TIED)
        marked = fresh.select(F.inline(F.when(F.col(f"last.{_OLD}"), F.array(enters, leaves)).otherwise(F.array(enters))))
        real = F.when(F.col(_ROW) < 0, -F.col(_ROW) - 1).otherwise(F.col(_ROW))
        chunk = F.floor(F.col(_ROW) / _CHUNK_ROWS)  # those of known rows count down, too
        marked = marked.select(_FILE, chunk.alias(_CHUNK), _BUCKET, (real % _CHUNK_ROWS).alias("bit"), _TIED)
        # dealt by what a bitmap covers before there are bitmaps, not after
        bits = F.bitmap_construct_agg("bit").alias(_BITS)
        marked = marked.repartition(_FILE, _CHUNK).groupBy(_FILE, _CHUNK, _BUCKET).agg(bits, F.max(_TIED).alias(_TIED))
        old = F.col(_CHUNK) < 0
        return marked.select(
            old.alias(_OLD), _BUCKET, _FILE, F.when(old, -F.col(_CHUNK) - 1).otherwise(F.col(_CHUNK)).alias(_CHUNK),
            F.substring(_BITS, 1, _CHUNK_ROWS // 8).alias(_BITS), _TIED,
        )

    def replace(self, rows: DataFrame) -> None:
        """The whole table anew. It is missing until the write is done.

        From ``large`` rows on, rows whose key is there once are written by the tasks that read them: no shuffle, and as
        many files in a bucket as there are tasks.
        """
        remove_folder(self.spark, self._prepared)
        incoming = self._incoming(rows)
        newest = [F.col(_AT).desc_nulls_first(), _tie(self._names(incoming))]
        found = keep_first_of_repeated(incoming, [_BUCKET, self.key], newest, self.large)
        _write_buckets(self._first(incoming, *newest) if found is None else found, self._rows)
        self._add_mark(self._load(self._rows))

    def merge(self, batch: DataFrame) -> bool:
        """Merge a batch; False if it changes nothing."""
        self.recover()
        if not self.exists():
            self.replace(batch)
            return True
        plan, beside = self._incoming(batch), f"{self.path}/incoming"
        plan.write.mode("overwrite").option("compression", "zstd").partitionBy(_BUCKET).parquet(beside)
        incoming = _placed(self.spark.read.schema(plan.schema).parquet(beside))  # an empty batch leaves no files
        known = _placed(self._load(self._rows))
        changes = write_table(self._changes(incoming, known, False), f"{self.path}/changes")
        if not changes.filter(_TIED).isEmpty():
            changes = write_table(self._changes(incoming, known, True), f"{self.path}/changes")
        touched = self._buckets_of(changes)
        if touched:
            here = F.col(_BUCKET).isin(touched)
            stay = _marked(_placed(self._load(self._rows)).filter(here), changes.filter(_OLD), self.sent).filter("not is_marked")
            enter = _marked(incoming.filter(here), changes.filter(~F.col(_OLD)), self.sent).filter("is_marked")
            _write_buckets(append_new_columns(stay, enter).drop("is_marked"), self._prepared)
            self._apply()
        remove_folder(self.spark, beside)
        return bool(touched)

    def refresh(
        self,
        sources: DataFrame | Sequence[DataFrame],
        build: Callable[..., DataFrame],
        column: str = LOAD_TIMESTAMP,
    ) -> bool:
        """Run the model over source rows that may be new, under one mark for all sources, and merge the result.

        The model's result carries the load time of its rows. Returns whether anything changed.
        """
        self.recover()
        mark = self.high_water()
        several = [sources] if isinstance(sources, DataFrame) else list(sources)
        return self.merge(build(*[since_watermark(s, mark, column) for s in several]))


def stream_upserts(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    table: MergedTable,
    build: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> None:
    """Process all files not yet seen in a folder, one merge per micro-batch, then stop.

    The stream's checkpoint tracks files. A micro-batch that is repeated after a failure, or a stream that begins
    again with an empty checkpoint, merges rows that change nothing.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    query = (
        reader.parquet(folder)
        .writeStream.foreachBatch(lambda batch, _: table.merge(build(batch)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
