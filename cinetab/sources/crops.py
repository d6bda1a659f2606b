"""Crop files as a data source: tasks write the files of a manifest by name, and listings show every file, markers included."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Folders of videos that one task lists.
FOLDERS = 64
LISTED = pa.schema([("video_id", pa.int64()), ("path", pa.string()), ("length", pa.int64())])


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``root`` and the path in it; a path without a scheme is local to each machine."""
    if root.startswith("file:") and not root.startswith("file://"):
        root = f"file://{root[5:]}"
    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)


def _inside(path: str) -> str:
    if path.startswith("/") or ".." in path.split("/") or not path:
        raise ValueError(f"not a path below a video's folder: {path!r}")
    return path


@dataclass
class Written(WriterCommitMessage):
    files: int


@dataclass
class Folders(InputPartition):
    names: list[str]


class CropWriter(DataSourceArrowWriter):
    """Writes ``content`` (null: an empty file) to <root>/video_<id>/<path>. A task that runs again writes the same files again."""

    def __init__(self, root: str):
        self.root = root

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, base = opened(self.root)
        known, files = set(), 0
        for batch in iterator:
            for video, path, content in zip(*(batch.column(c).to_pylist() for c in ("video_id", "path", "content")), strict=True):
                at = f"{base}/video_{video}/{_inside(path)}"
                folder = at.rsplit("/", 1)[0]
                if folder not in known:
                    store.create_dir(folder, recursive=True)
                    known.add(folder)
                with store.open_output_stream(at) as out:
                    out.write(content or b"")
                files += 1
        return Written(files)


class CropReader(DataSourceReader):
    """Lists the files of each video's folder; a task takes FOLDERS videos, and no file is opened."""

    def __init__(self, root: str):
        self.root = root

    def partitions(self) -> list[Folders]:
        store, base = opened(self.root)
        names = sorted(x.base_name for x in store.get_file_info(fs.FileSelector(base, allow_not_found=True)) if x.type == fs.FileType.Directory and x.base_name.startswith("video_"))
        return [Folders(names[i : i + FOLDERS]) for i in range(0, len(names), FOLDERS)]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        store, base = opened(self.root)
        for name in partition.names if partition is not None else []:
            found = [x for x in store.get_file_info(fs.FileSelector(f"{base}/{name}", recursive=True)) if x.type == fs.FileType.File]
            rows = [[int(name.removeprefix("video_"))] * len(found), [x.path.split(f"/{name}/", 1)[1] for x in found], [x.size for x in found]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, LISTED, strict=True)], schema=LISTED)


class CropFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "crop_files"

    def schema(self) -> str:
        return "video_id long, path string, length long"

    def reader(self, schema) -> CropReader:  # noqa: ANN001
        return CropReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> CropWriter:  # noqa: ANN001
        return CropWriter(self.options["path"])


def write_crops(crops: DataFrame, root: str) -> None:
    """Write ``crops(video_id, path, content)`` below ``root``, which driver and executors share; files of the same name are replaced."""
    crops.sparkSession.dataSource.register(CropFiles)
    crops.select("video_id", "path", F.col("content").cast("binary").alias("content")).write.format("crop_files").mode("append").save(root)


def list_crops(spark: SparkSession, root: str) -> DataFrame:
    """(video_id, path, length, scene_id, group, ts) of every file that ``write_crops`` wrote; markers of faceless scenes have no group and time."""
    spark.dataSource.register(CropFiles)
    part = lambda pattern: F.regexp_extract("path", pattern, 1)
    return spark.read.format("crop_files").load(root).select(
        "video_id", "path", "length", part(r"scene_(\d+)/").try_cast("int").alias("scene_id"), part(r"group(\d+)/").try_cast("int").alias("group"),
        part(r"/t([\d.]+)\.jpg$").try_cast("double").alias("ts"),
    )
