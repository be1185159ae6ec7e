"""Parquet tables of the layers, addressed as `layer.name` under one root folder."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.operators.keys import latest_per_key, past_newest, upsert_frame
from wattloom.operators.slices import Day
from wattloom.sources.snapshots import ISO, NULL_FOLDER, WRITE, Days, Manifest, Snapshots

# Tables that are read as file streams are plain folders.
STREAMED = "bronze."


class Tables:
    """Named tables: read, overwrite, append and upsert.

    A table's schema is kept beside it, so a table without rows can be read and a read needs no
    inference job. Tables with a partition column are written through a rebalance, which gives a
    partition one writer while it is small and several once it is large. Those partitioned by a date
    have versions (see `snapshots`), but for bronze.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._schemas: dict[str, T.StructType] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def _schema_path(self, name: str) -> str:
        return f"{self.root}/schemas/{name}"

    def _text(self, path: str) -> str | None:
        """A small text kept beside the tables, or None where it was never written."""
        # Asked of the file system: a read that fails would show up in every query listener.
        sc = self.spark.sparkContext
        marker = sc._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if not marker.getFileSystem(sc._jsc.hadoopConfiguration()).exists(marker):
            return None
        row = self.spark.read.text(path, wholetext=True).first()
        return None if row is None else row[0].strip()

    def _put_text(self, path: str, text: str) -> None:
        row = self.spark.range(1, numPartitions=1).select(F.lit(text).alias("text"))
        row.write.mode("overwrite").text(path)

    def _delete(self, folder: str) -> None:
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)

    def exists(self, name: str) -> bool:
        """Whether a write of the table has ever been completed, its schema included."""
        if name not in self._schemas:
            text = self._text(self._schema_path(name))
            if text is None:
                return False
            self._schemas[name] = T.StructType.fromJson(json.loads(text))
        return True

    def schema(self, name: str) -> T.StructType:
        if not self.exists(name):
            raise LookupError(f"no table {name}")
        return self._schemas[name]

    def _keep_schema(self, name: str, schema: T.StructType) -> None:
        if self._schemas.get(name) != schema:
            self._put_text(self._schema_path(name), schema.json())
            self._schemas[name] = schema

    def _widened(self, name: str, schema: T.StructType) -> T.StructType:
        """The stored schema with the columns it does not have yet. A column must keep its type:
        files of two types under one name could not be read any more."""
        if not self.exists(name):
            return schema
        stored = self.schema(name)
        for field in schema.fields:
            if field.name in stored.names:
                was, now = (x.dataType.simpleString() for x in (stored[field.name], field))
                if was != now:
                    raise ValueError(f"{name}.{field.name} is {was}, not {now}")
        return T.StructType(stored.fields + [f for f in schema.fields if f.name not in stored.names])

    def snapshots(self, name: str) -> Snapshots:
        return Snapshots(self.spark, self.path(name))

    def _snapshot(self, name: str) -> Manifest | None:
        """The current version of a table that has versions."""
        return None if name.startswith(STREAMED) else self.snapshots(name).current()

    def read(self, name: str, days: Days | None = None) -> DataFrame:
        """The table, or only the partitions of `days`: no others are listed. Of a table with versions, the
        version that is current now, whatever is written while the frame is in use."""
        schema, now = self.schema(name), self._snapshot(name)
        if now is None:
            return self.spark.read.schema(schema).parquet(self.path(name))
        folders = now.folders(self.path(name), days)
        if not folders:
            return self.spark.createDataFrame([], schema)
        whole = T.StructType([*schema.fields, T.StructField(WRITE, T.StringType())])
        found = self.spark.read.schema(whole).option("basePath", self.path(name)).parquet(*folders)
        return found.select(schema.names)

    def day(self, name: str, column: str) -> Day:
        """The table's date partition column with its newest day, from the table's manifest: no file is
        opened."""
        now = self._snapshot(name)
        return Day(column, None if now is None else now.newest())

    def register_views(self, names: list[str]) -> None:
        """Temp views `layer_name`, for SQL and for the catalog's listings."""
        for name in names:
            self.read(name).createOrReplaceTempView(name.replace(".", "_"))

    def _writer(
        self, df: DataFrame, mode: str, partition_by: str | list[str] | None, sort_by: list[str] | None = None,
        clustered: bool = False,
    ) -> DataFrameWriter:
        """`clustered` rows, whose tasks hold few partitions each (see `slices.clustered`), are written where
        they are: what would be shuffled is the finished rows, many times as wide as what they are made of."""
        if partition_by is None:
            return df.write.mode(mode)
        by = [partition_by] if isinstance(partition_by, str) else partition_by
        if clustered:
            return df.write.mode(mode).partitionBy(*by)
        # A partitioned write sorts by its partition column anyway; sorting on by the key as well
        # makes row groups skippable for filters on entity and time.
        spread = df.hint("rebalance", *by).sortWithinPartitions(*by, *(sort_by or []))
        return spread.write.mode(mode).partitionBy(*by)

    def _versioned(self, name: str, df: DataFrame, partition_by: str | list[str] | None) -> bool:
        return (
            isinstance(partition_by, str)
            and not name.startswith(STREAMED)
            and isinstance(df.schema[partition_by].dataType, T.DateType)
        )

    def _commit(
        self, name: str, df: DataFrame, day: str, sort_by: list[str] | None, replaced: Days | None, base: Manifest | None,
        add: bool = False,
    ) -> None:
        """Writes `df` to a folder of its own and makes it the partitions of its days, and of `replaced`
        (None: of the whole table); with `add`, besides what those partitions hold already."""
        versions = self.snapshots(name)
        write = versions.new_write()
        self._writer(df, "errorifexists", day, sort_by).parquet(versions.folder(write))
        new = dict.fromkeys(versions.partitions_of(write, day), [write])
        gone = None if replaced is None else set(replaced)

        def change(parts: dict[str, list[str]]) -> dict[str, list[str]]:
            if add:
                return parts | {n: parts.get(n, []) + w for n, w in new.items()}
            return {n: w for n, w in parts.items() if gone is not None and n not in gone} | new

        # What is added can't be in anyone's way.
        versions.commit(base, day, change, [] if add else None if gone is None else sorted(gone | set(new)))

    def overwrite(
        self,
        name: str,
        df: DataFrame,
        partition_by: str | None = None,
        sort_by: list[str] | None = None,
        clustered: bool = False,
    ) -> None:
        """Replaces the table, schema included. `clustered`: see `_writer`; of tables without versions."""
        if self._versioned(name, df, partition_by):
            # Whatever others do meanwhile is replaced as well.
            self._commit(name, df, partition_by, sort_by, None, self._snapshot(name))
        else:
            writer = self._writer(df, "overwrite", partition_by, sort_by, clustered)
            writer.option("partitionOverwriteMode", "static").parquet(self.path(name))
        self._keep_schema(name, df.schema)

    def append(self, name: str, df: DataFrame, partition_by: str | list[str] | None = None) -> None:
        """Appends rows; columns the table lacks are added to it."""
        schema = self._widened(name, df.schema)
        if self._versioned(name, df, partition_by):
            self._commit(name, df, partition_by, None, [], self._snapshot(name), add=True)
        else:
            self._writer(df, "append", partition_by).parquet(self.path(name))
        self._keep_schema(name, schema)

    def replace_partitions(
        self, name: str, df: DataFrame, partition_by: str | list[str], sort_by: list[str] | None = None, days: Days = (),
        clustered: bool = False,
    ) -> None:
        """Replaces only the partitions that occur in `df`, and those of `days`, whether `df` has rows for
        them or not; running it again changes nothing.

        Of a table without versions a crash may leave a partition deleted and not yet replaced, so `df` must
        be there for the next run to replace it again.
        """
        schema = self._widened(name, df.schema)
        if self._versioned(name, df, partition_by):
            self._commit(name, df, partition_by, sort_by, days, self._snapshot(name))
        else:
            writer = self._writer(df, "overwrite", partition_by, sort_by, clustered)
            writer.option("partitionOverwriteMode", "dynamic").parquet(self.path(name))
        self._keep_schema(name, schema)

    def upsert(
        self,
        name: str,
        source: DataFrame,
        keys: list[str],
        partition_by: str,
        order_by: list[str] | None = None,
        days: DataFrame | None = None,
    ) -> None:
        """Ordered upsert, rewriting only the partitions the source touches.

        `partition_by` must be a date that follows from the key, so that a correction lands in
        the partition of the row it corrects; rows without a date are a partition like others. `days` is a
        frame with that column that covers the source's dates and is cheaper to read, such as the table the
        source is computed from; without it the source's latest rows are staged, so that it is computed once.

        Readers see the table before or after the upsert. A run that dies leaves it as it was.
        """
        if not isinstance(source.schema[partition_by].dataType, T.DateType):
            raise ValueError(f"{partition_by} must be a date")
        if not self.exists(name):
            self.overwrite(name, latest_per_key(source, keys, order_by), partition_by, keys)
            return
        schema, base = self._widened(name, source.schema), self._snapshot(name)
        staged = None
        if days is None:
            staged = f"{self.root}/staging/upserts/{uuid.uuid4().hex}"
            latest_per_key(source, keys, order_by).write.parquet(staged)
            days = source = self.spark.read.schema(source.schema).parquet(staged)
        touched = self.touched_days(days, partition_by)
        merged = upsert_frame(self.read(name, touched), source, keys, order_by)
        self._commit(name, merged, partition_by, keys, touched, base)
        self._keep_schema(name, schema)
        if staged:
            self._delete(staged)

    @staticmethod
    def touched_days(df: DataFrame, day: str) -> list[str]:
        """The dates that occur, by the names of their folders: a calendar's worth at most."""
        name = F.coalesce(F.col(day).cast("string"), F.lit(NULL_FOLDER))
        return [n for (n,) in df.select(name).distinct().collect()]

    def days_from(self, name: str, first: str) -> list[str]:
        """The table's days from one on, and the rows without a date."""
        now = self._snapshot(name) if self.exists(name) else None
        return [n for n in now.parts if n == NULL_FOLDER or ISO.fullmatch(n) and n >= first] if now else []

    def changed_days(self, name: str, since: int = 0) -> tuple[int, list[str]]:
        """The current version, and the days whose rows have been replaced after version `since`."""
        now = self._snapshot(name)
        if now is None:
            raise ValueError(f"{name} has no versions")
        return now.version, self.snapshots(name).changes(since)

    def digest(self, name: str) -> str:
        """Of the rows of a small table, in whatever order."""
        df = self.read(name)
        mark = F.sum(F.xxhash64(*[F.to_json(F.struct(c)) for c in df.columns]).cast("decimal(38,0)"))
        return str(tuple(df.agg(F.count(F.lit(1)), mark).first()))

    def mark(self, job: str) -> dict:
        """What a job has taken in, as it noted with `set_mark`."""
        text = self._text(f"{self.root}/marks/{job}")
        return json.loads(text) if text else {}

    def set_mark(self, job: str, seen: dict) -> None:
        self._put_text(f"{self.root}/marks/{job}", json.dumps(seen))

    def append_newer(
        self, name: str, df: DataFrame, ts: str, entity: str, partition_by: str | None = None
    ) -> None:
        """Appends each entity's rows past its own newest `ts`, so that an entity that lags behind
        the others loses nothing; an entity that the table lacks is appended whole."""
        if not self.exists(name):
            self.overwrite(name, df, partition_by)
            return
        self.append(name, past_newest(df, self.read(name), ts, entity), partition_by)
