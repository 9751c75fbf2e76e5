"""Folders of very many files: listed and read by tasks, so that the driver holds no list of the files.

Folders are opened through ``pyarrow.fs``, as archives are (see ``zipped``). A local folder is listed as a stream, one of
another store is held by the task that lists it.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from vitrine.sources.zipped import HELD_BYTES, opened

HELD_FILES = 1_000
LISTED = 10_000
_NO_ADDRESS = re.compile(r"[^A-Za-z0-9/\-_.!~*'():@&=+$,;\u0080-\U0010ffff]|[\s\x80-\x9f]")


def is_folder(address: str) -> bool:
    """Is the address that of a folder, no pattern, in a store that ``pyarrow.fs`` opens?"""
    if any(c in address for c in "*?[]{}\\"):
        return False
    try:
        system, path = opened(address)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return system.get_file_info(path).type == fs.FileType.Directory


def list_folder(address: str) -> Iterator[tuple[str, bool]]:
    """(address, is it a folder) of all that lies right in a folder, without what Spark's readers take for hidden."""
    system, inner = opened(address)
    local = isinstance(system, fs.LocalFileSystem)
    root = "file://" if local else address[:len(address) - len(inner)] if address.endswith(inner) else ""
    if local:
        with os.scandir(inner) as entries:
            found = ((e.name, e.is_dir()) for e in entries)
            yield from ((f"{root}{inner.rstrip('/')}/{name}", folder) for name, folder in found if not is_hidden(name))
    else:
        for info in system.get_file_info(fs.FileSelector(inner)):
            if not is_hidden(info.base_name):
                yield root + info.path, info.type == fs.FileType.Directory


def is_hidden(name: str) -> bool:
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def have_partitions(spark: SparkSession, folders: list[str]) -> bool:
    """Does one of the folders hold folders named key=value?"""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = any(folder and "=" in path.rsplit("/", 1)[-1] for address in batch.column(0).to_pylist()
                        for path, folder in list_folder(address))
            yield pa.RecordBatch.from_pydict({"found": [found]})

    return not _addresses(spark, folders).mapInArrow(look, "found boolean").where("found").isEmpty()


def read_folders(spark: SparkSession, folders: list[str]) -> DataFrame:
    """``origin, content`` of the files right in the folders; empty files are left out, as Spark's readers do.

    Tasks list the folders, a folder each; the files are dealt over tasks, which read them in batches of bounded size.
    """
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address in batch.column(0).to_pylist():
                held: list[str] = []
                for path, folder in list_folder(address):
                    if not folder:
                        held.append(path)
                    if len(held) == LISTED:
                        yield pa.RecordBatch.from_pydict({"path": held})
                        held = []
                yield pa.RecordBatch.from_pydict({"path": pa.array(held, pa.string())})

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, read, size = [], [], 0
            for path in batch.column(0).to_pylist():
                content = read_file(path)
                if not content:
                    continue
                paths.append(escaped(path))
                read.append(content)
                size += len(content)
                if size >= HELD_BYTES or len(paths) == HELD_FILES:
                    yield _files(paths, read)
                    paths, read, size = [], [], 0
            yield _files(paths, read)

    tasks = max(len(folders), 4 * spark.sparkContext.defaultParallelism)
    paths = _addresses(spark, folders).mapInArrow(listed, "path string").repartition(tasks)
    return paths.mapInArrow(contents, "origin string, content binary")


def escaped(address: str) -> str:
    """An address as Java writes it: ASCII signs and blanks that it can't hold as %XX."""
    return _NO_ADDRESS.sub(lambda found: quote(found[0], safe=""), address)


def read_file(address: str) -> bytes:
    # The address of a listed file, whose local path is taken as it is.
    if address.startswith("file://"):
        with open(address.removeprefix("file://"), "rb") as file:
            return file.read()
    system, inner = opened(address)
    with system.open_input_stream(inner) as file:
        return file.read()


def _files(origins: list[str], contents: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(origins, pa.string()), pa.array(contents, pa.binary())], ["origin", "content"])


def _addresses(spark: SparkSession, folders: list[str]) -> DataFrame:
    return spark.createDataFrame([(f,) for f in folders], "address string")
