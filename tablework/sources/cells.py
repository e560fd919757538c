"""Wide-column cells (row, family, column, value) as a Spark data source in Python.

A store is a folder on shared storage.  A write is a job of its own: each task puts its cells,
sorted by row, into one Parquet file at a time for each family, and reports the files with
their first and last row.  The driver lists them in a new manifest when all tasks have
succeeded; until then, and if the job fails, no reader sees them, and an aborted job
deletes its folder.  A scan plans one partition for each file that the wanted
rows and families can be in, and reads it as Arrow batches, row group by row group.

Rows and families are narrowed by the options of ``scan`` and by the filters on ``row`` and ``family``
that Spark pushes down.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual,
                                    In, InputPartition, LessThan, LessThanOrEqual, StringStartsWith, WriterCommitMessage)

from ..session import side_session

NAME = "cells"
SCHEMA = "row string, family string, column string, value string, version long"

#: Cells in a file at most: the unit of a scan's partitions.
FILE_CELLS = 1_000_000

_FILE = pa.schema([("row", pa.string()), ("column", pa.string()), ("value", pa.string())])
_OUT = pa.schema([("row", pa.string()), ("family", pa.string()), ("column", pa.string()), ("value", pa.string()), ("version", pa.int64())])


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def _manifests(files: fs.FileSystem, root: str) -> list[str]:
    found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(f.path for f in found if f.base_name.startswith("manifest-"))


def _listed(files: fs.FileSystem, root: str) -> tuple[int, list[dict]]:
    """Number and files of the newest manifest."""
    known = _manifests(files, root)
    if not known:
        return 0, []
    with files.open_input_stream(known[-1]) as f:
        return len(known), json.loads(f.read())


@dataclass
class FilePartition(InputPartition):
    path: str
    family: str
    version: int


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


class CellReader(DataSourceReader):
    """``low`` and ``high`` bound the row (high exclusive), ``families`` the family; None leaves it open."""

    def __init__(self, options):
        self.path = options["path"]
        self.low, self.high = options.get("from_row"), options.get("to_row")
        self.families = json.loads(options["families"]) if "families" in options else None

    def pushFilters(self, filters):
        for f in filters:
            if not self._narrow(f):
                yield f

    def _narrow(self, f) -> bool:
        at = getattr(f, "attribute", None)
        if at == ("family",) and isinstance(f, (EqualTo, In)):
            wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.families = sorted(wanted if self.families is None else wanted & set(self.families))
            return True
        if at != ("row",):
            return False
        # the next greater text is the text with a zero character behind it
        bounds = {EqualTo: lambda v: (v, v + "\0"), GreaterThan: lambda v: (v + "\0", None), GreaterThanOrEqual: lambda v: (v, None),
                  LessThan: lambda v: (None, v), LessThanOrEqual: lambda v: (None, v + "\0"), StringStartsWith: lambda v: (v, None)}
        if type(f) not in bounds:
            return False
        low, high = bounds[type(f)](f.value)
        self.low = low if self.low is None or (low is not None and low > self.low) else self.low
        self.high = high if self.high is None or (high is not None and high < self.high) else self.high
        return not isinstance(f, StringStartsWith)

    def partitions(self):
        files, root = _open(self.path)
        wanted = [f for f in _listed(files, root)[1]
                  if (self.families is None or f["family"] in self.families)
                  and (self.low is None or f["last"] >= self.low) and (self.high is None or f["first"] < self.high)]
        return [FilePartition(f["path"], f["family"], f["version"]) for f in wanted] or [FilePartition("", "", 0)]

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        files, root = _open(self.path)
        keep = None
        for bound in ([ds.field("row") >= self.low] if self.low is not None else []) + ([ds.field("row") < self.high] if self.high is not None else []):
            keep = bound if keep is None else keep & bound
        data = ds.dataset(f"{root}/{partition.path}", filesystem=files, format="parquet", schema=_FILE)
        for b in data.to_batches(filter=keep, batch_size=10_000, batch_readahead=2, use_threads=False):
            if b.num_rows:
                same = [pa.repeat(partition.family, b.num_rows), pa.repeat(pa.scalar(partition.version, pa.int64()), b.num_rows)]
                yield pa.RecordBatch.from_arrays([b.column(0), same[0], b.column(1), b.column(2), same[1]], schema=_OUT)


class _Open:
    """The file that a task is writing for one family."""

    def __init__(self, files: fs.FileSystem, root: str, job: str, family: str):
        self.path = f"{job}/{uuid.uuid4().hex}.parquet"
        self.family, self.first, self.last, self.n = family, None, None, 0
        self.stream = files.open_output_stream(f"{root}/{self.path}")
        self.writer = pq.ParquetWriter(self.stream, _FILE)

    def add(self, cells: pa.Table) -> None:
        rows = cells.column("row")
        self.first = rows[0].as_py() if self.first is None else min(self.first, rows[0].as_py())
        self.last = rows[-1].as_py() if self.last is None else max(self.last, rows[-1].as_py())
        self.n += cells.num_rows
        self.writer.write_table(cells, row_group_size=65_536)

    def close(self) -> dict:
        self.writer.close()
        self.stream.close()
        return {"path": self.path, "family": self.family, "first": self.first, "last": self.last, "cells": self.n}


class CellWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite, self.job = options["path"], overwrite, f"job-{uuid.uuid4().hex}"
        files, root = _open(self.path)
        files.create_dir(f"{root}/{self.job}", recursive=True)

    def write(self, iterator) -> Written:
        files, root = _open(self.path)
        open_, done = {}, []
        try:
            for batch in iterator:
                cells = pa.Table.from_batches([batch])
                for family in cells.column("family").unique().to_pylist():
                    own = cells.filter(pc.equal(cells.column("family"), family)).select(_FILE.names).cast(_FILE)
                    if family not in open_:
                        open_[family] = _Open(files, root, self.job, family)
                    open_[family].add(own.sort_by([("row", "ascending"), ("column", "ascending")]))
                    if open_[family].n >= FILE_CELLS:
                        done.append(open_.pop(family).close())
            done += [open_.pop(f).close() for f in list(open_)]
            return Written(done)
        except BaseException:
            for f in open_.values():
                f.close()
            for f in [*done, *({"path": f.path} for f in open_.values())]:
                files.delete_file(f"{root}/{f['path']}")
            raise

    def commit(self, messages) -> None:
        files, root = _open(self.path)
        number, before = _listed(files, root)
        new = [dict(f, version=number + 1) for m in messages if m is not None for f in m.files]
        name = f"{root}/manifest-{number + 1:010d}"
        if files.get_file_info(name).type != fs.FileType.NotFound:
            raise RuntimeError(f"another job has written {name}")
        with files.open_output_stream(f"{name}.tmp") as f:
            f.write(json.dumps(new if self.overwrite else before + new).encode())
        files.move(f"{name}.tmp", name)

    def abort(self, messages) -> None:
        files, root = _open(self.path)
        files.delete_dir(f"{root}/{self.job}")


class CellSource(DataSource):
    """``spark.read.format("cells")`` with the option ``path``; ``from_row``, ``to_row`` and ``families`` (JSON) narrow a scan."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> CellReader:
        return CellReader(self.options)

    def writer(self, schema, overwrite: bool) -> CellWriter:
        return CellWriter(self.options, overwrite)


def _registered(spark: SparkSession) -> str:
    """The name under which ``spark`` knows the source.

    Spark looks for a name that is taken in the active session, which may be another one; so each session has a
    name of its own.
    """
    own = f"{NAME}_{spark._jsparkSession.sessionUUID().replace('-', '')}"
    try:
        spark.dataSource.register(type("SessionCells", (CellSource,), {"name": classmethod(lambda cls: own)}))
    except AnalysisException as e:
        if e.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
            raise
    return own


def put(cells: DataFrame, path: str, mode: str = "append") -> None:
    """Write cells (row, family, column, value); ``append`` adds a newer version, ``overwrite`` starts afresh.

    Cells without a row, family or column are refused, as no scan could name them.
    """
    names = ["row", "family", "column"]
    whole = [F.when(F.col(c).isNull(), F.raise_error(F.lit(f"a cell without a {c}"))).otherwise(F.col(c).cast("string")).alias(c) for c in names]
    (cells.select(*whole, F.col("value").cast("string")).repartitionByRange("row").sortWithinPartitions("row", "column")
     .write.format(_registered(cells.sparkSession)).mode(mode).option("path", path).save())


def scan(spark: SparkSession, path: str, from_row: str | None = None, to_row: str | None = None,
         families: list[str] | None = None) -> DataFrame:
    """All versions of the cells of a range of rows (``to_row`` exclusive) and of some families.

    Spark plans a reader with pushed filters only where a setting allows it, so the result belongs to a session of
    its own that has the setting.
    """
    spark = side_session(spark, {"spark.sql.python.filterPushdown.enabled": "true"})
    options = {"from_row": from_row, "to_row": to_row, "families": None if families is None else json.dumps(families)}
    return spark.read.format(_registered(spark)).option("path", path).options(**{k: v for k, v in options.items() if v is not None}).load()


def latest(cells: DataFrame) -> DataFrame:
    """The newest version of each cell."""
    return cells.groupBy("row", "family", "column").agg(F.max_by("value", "version").alias("value"))
