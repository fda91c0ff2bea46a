"""A streaming source of polled feeds: every country has a folder of snapshots, one folder each.

An offset names the last snapshot read of each country, so a stream that stops goes on between snapshots,
country by country, and a country that is added later starts from its first one. Snapshots are read in
the order of their names, and only once they are complete (marked by ``_SUCCESS``, as Spark's writers do).
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .. import schemas as S

FORMAT = "rail_snapshots"
#: Lines of a snapshot in one batch.
LINES = 1_000


@dataclass
class SnapshotFile(InputPartition):
    pays: str
    snapshot: str
    path: str


class SnapshotReader(DataSourceStreamReader):
    """Offsets are the last snapshot's name by country; a partition is one file of a snapshot."""

    def __init__(self, options: dict):
        self.folders: dict[str, str] = json.loads(options["folders"])

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        found = {pays: self._complete(pays) for pays in sorted(self.folders)}
        return {pays: names[-1] for pays, names in found.items() if names}

    def partitions(self, start: dict, end: dict) -> list[SnapshotFile]:
        out = []
        for pays, last in end.items():
            files, root = self._root(pays)
            for name in self._complete(pays):
                if start.get(pays, "") < name <= last:
                    listed = files.get_file_info(fs.FileSelector(f"{root}/{name}"))
                    paths = sorted(f.path for f in listed if f.is_file and not f.base_name.startswith(("_", ".")))
                    out += [SnapshotFile(pays, name, path) for path in paths]
        return out

    def read(self, partition: SnapshotFile) -> Iterator[pa.RecordBatch]:
        files, _ = self._root(partition.pays)
        # A file is taken apart as it is read, compressed or not (its name says so), and never held as a whole.
        with files.open_input_stream(partition.path) as stream, io.TextIOWrapper(stream, "utf-8") as text:
            lines = (line.rstrip("\n") for line in text if line.strip())
            while part := list(islice(lines, LINES)):
                named = [[partition.pays] * len(part), [partition.snapshot] * len(part), part]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in named], ["pays", "snapshot", "value"])

    def commit(self, end: dict) -> None:
        pass

    def _root(self, pays: str) -> tuple[fs.FileSystem, str]:
        path = self.folders[pays]
        if "://" in path or path.startswith("file:"):
            return fs.FileSystem.from_uri(path)
        return fs.LocalFileSystem(), path

    def _complete(self, pays: str) -> list[str]:
        files, root = self._root(pays)
        listed = files.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
        return sorted(f.path.split("/")[-2] for f in listed if f.base_name == "_SUCCESS")


class SnapshotSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "pays string, snapshot string, value string"

    def streamReader(self, schema) -> SnapshotReader:
        return SnapshotReader(self.options)


def snapshot_feeds(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """A stream of feed rows of several countries, with ``pays`` and the ``snapshot`` each came in.

    ``folders`` are paths that the driver and all executors reach, with or without a scheme that pyarrow
    knows. A line that is no feed becomes a row of NULLs, which has no entities.
    """
    spark.dataSource.register(SnapshotSource)
    raw = spark.readStream.format(FORMAT).option("folders", json.dumps(folders)).load()
    return raw.select("pays", "snapshot", F.from_json("value", S.FEED).alias("_feed")).select("pays", "snapshot", "_feed.*")
