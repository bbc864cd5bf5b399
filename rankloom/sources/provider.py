"""Providers as a data source: ``spark.read`` and ``spark.readStream.format("rankloom_provider")``.

A provider publishes what happened on a day under ``<root>/day=YYYY-MM-DD``, once the day is complete. The batch reader has one
partition per file and takes filters on ``day`` itself, so days that are not asked for are not opened. The stream reader's
offset is the ``since`` date: the first day that has not been read. A batch is all days from one ``since`` to the next, so a
batch that failed is read again with the same days.

Files are opened through Arrow's file systems, by the address that ``root`` has.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DateType, StructField, StructType

FORMAT, DAY = "rankloom_provider", "day"
ONE = dt.timedelta(days=1)


def published(root: str) -> list[tuple[dt.date, str]]:
    """(day, file) of everything under ``root``, in order."""
    system, path = pafs.FileSystem.from_uri(root)
    found = []
    for info in system.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True)):
        folder, _, name = info.path.rpartition("/")
        if info.type == pafs.FileType.File and name.endswith(".parquet") and f"/{DAY}=" in folder:
            found.append((dt.date.fromisoformat(folder.rpartition(f"/{DAY}=")[2]), info.path))
    return sorted(found)


def read_file(root: str, schema: StructType, day: dt.date, path: str) -> Iterator[pa.RecordBatch]:
    """The wanted columns of a file and its day; a column that the file lacks is null."""
    kinds = to_arrow_schema(schema)
    system, _ = pafs.FileSystem.from_uri(root)
    with system.open_input_file(path) as opened:
        held = pq.ParquetFile(opened)
        there = [f.name for f in kinds if f.name in held.schema_arrow.names]
        for batch in held.iter_batches(columns=there):
            columns = []
            for f in kinds:
                if f.name == DAY:
                    columns.append(pa.array([day] * batch.num_rows, pa.date32()))
                else:
                    columns.append(batch.column(f.name).cast(f.type) if f.name in there else pa.nulls(batch.num_rows, f.type))
            yield pa.RecordBatch.from_arrays(columns, schema=kinds)


class DayFile(InputPartition):
    """One file of one day."""

    def __init__(self, day: dt.date, path: str) -> None:
        self.day, self.path = day, path


class ProviderReader(DataSourceReader):
    """Batch reader: one partition per file, days outside the filters left out."""

    def __init__(self, root: str, schema: StructType, since: dt.date | None) -> None:
        self.root, self.schema = root, schema
        self.first, self.end = since or dt.date.min, dt.date.max  # end: the last day that counts

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) != (DAY,) or not isinstance(getattr(f, "value", None), dt.date):
                yield f
            elif isinstance(f, GreaterThanOrEqual):
                self.first = max(self.first, f.value)
            elif isinstance(f, GreaterThan):
                self.first = max(self.first, f.value + ONE)
            elif isinstance(f, LessThanOrEqual):
                self.end = min(self.end, f.value)
            elif isinstance(f, LessThan):
                self.end = min(self.end, f.value - ONE)
            elif isinstance(f, EqualTo):
                self.first, self.end = max(self.first, f.value), min(self.end, f.value)
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        return [DayFile(day, path) for day, path in published(self.root) if self.first <= day <= self.end]

    def read(self, partition: DayFile | None) -> Iterator[pa.RecordBatch]:
        if partition is not None:  # no partitions at all: one call without any
            yield from read_file(self.root, self.schema, partition.day, partition.path)


class ProviderStream(DataSourceStreamReader):
    """Stream reader: offsets are the first day that has not been read."""

    def __init__(self, root: str, schema: StructType, since: dt.date | None) -> None:
        self.root, self.schema, self.since = root, schema, since or dt.date(1, 1, 1)

    def initialOffset(self) -> dict:
        return {"since": self.since.isoformat()}

    def latestOffset(self) -> dict:
        days = [day for day, _ in published(self.root)]
        return {"since": max([self.since, *[d + ONE for d in days]]).isoformat()}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        first, stop = (dt.date.fromisoformat(o["since"]) for o in (start, end))
        return [DayFile(day, path) for day, path in published(self.root) if first <= day < stop]

    def read(self, partition: DayFile) -> Iterator[pa.RecordBatch]:
        yield from read_file(self.root, self.schema, partition.day, partition.path)


class ProviderSource(DataSource):
    """Options: ``root``, and ``since`` as a date, the first day to read."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _arguments(self, schema: StructType) -> tuple:
        since = self.options.get("since")
        return self.options["root"], schema, dt.date.fromisoformat(since) if since else None

    def reader(self, schema: StructType) -> ProviderReader:
        return ProviderReader(*self._arguments(schema))

    def streamReader(self, schema: StructType) -> ProviderStream:
        return ProviderStream(*self._arguments(schema))


def _reader(spark: SparkSession, reader, root: str, schema: StructType, since: str | None) -> DataFrame:
    spark.dataSource.register(ProviderSource)
    if DAY not in schema.names:
        schema = StructType([*schema.fields, StructField(DAY, DateType())])
    reader = reader.format(FORMAT).schema(schema).option("root", root)
    return (reader.option("since", since) if since else reader).load()


def read_provider(spark: SparkSession, root: str, schema: StructType, since: str | None = None) -> DataFrame:
    """What a provider published on or after ``since``, with ``day``. Filters on ``day`` go to the source."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return _reader(spark, spark.read, root, schema, since)


def stream_provider(spark: SparkSession, root: str, schema: StructType, since: str | None = None) -> DataFrame:
    """The same as a stream, day after day."""
    return _reader(spark, spark.readStream, root, schema, since)
