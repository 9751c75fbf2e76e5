from __future__ import annotations

import struct
import zlib

import pytest
from pictures import png
from pyspark.sql.utils import AnalysisException

from vitrine.sources import images
from vitrine.sources.folders import escaped, is_folder, list_folder, read_folders


def pixels(kind: int, channels: int, depth: int = 8) -> bytes:
    """A PNG of any colour type without a palette."""
    def chunk(name: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    line = b"\0" + bytes((37 * i + 11) % 256 for i in range(3 * channels * depth // 8))
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 3, 2, depth, kind, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(line * 2)) + chunk(b"IEND", b""))


FILES = {
    "rgb.png": png((1, 2, 3)), "grey.png": pixels(0, 1), "alpha.png": pixels(6, 4), "grey alpha.png": pixels(4, 2),
    "deep.png": pixels(2, 3, 16), "bad.jpg": b"no picture", "bad2.jpg": b"\0\1 no picture", "empty.png": b"",
    "_hidden.png": png((1, 1, 1)), ".dot.png": png((1, 1, 1)), "_k=v": png((4, 4, 4)), "é%20 #?[1]+&　.png": png((5, 6, 7)),
}


def fill(folder, files=FILES):
    folder.mkdir(parents=True)
    for name, content in files.items():
        (folder / name).write_bytes(content)
    return str(folder)


def found(table):
    return sorted(((r.image.origin, *r.image[1:5], bytes(r.image.data)) for r in table.collect()))


def by_spark(spark, *paths):
    return spark.read.format("image").option("dropInvalid", False).load([*paths])


def test_pictures_are_those_of_the_image_source_without_a_list_in_the_driver(spark, tmp_path):
    folder = fill(tmp_path / "a b%20")
    fill(tmp_path / "a b%20" / "below", {"x.png": png((1, 1, 1))})
    got = images.read_images(spark, folder)
    assert got.schema.simpleString() == by_spark(spark, folder).schema.simpleString()
    assert len(found(got)) == 9 and found(got) == found(by_spark(spark, folder))
    assert not got.inputFiles() and "FileScan" not in got._jdf.queryExecution().toString()


def test_pictures_of_many_folders(spark, tmp_path):
    folders = [fill(tmp_path / str(i), {f"{i}_{j}.png": png((i, j, 0)) for j in range(i)}) for i in range(5)]
    got = found(images.read_images(spark, *folders))
    assert len(got) == 10 and got == found(by_spark(spark, *folders[1:]))
    assert images.read_images(spark).count() == 0 and images.read_images(spark).columns == ["image"]


def test_patterns_files_and_partitions_go_the_old_way(spark, tmp_path):
    folder = fill(tmp_path / "plain", {"a.png": png((1, 2, 3)), "b.png": png((3, 2, 1))})
    for path, rows in ((f"{folder}/a.png", 1), (f"{folder}/*.png", 2)):
        assert not is_folder(path) and images.read_images(spark, path).count() == rows
    fill(tmp_path / "parts" / "day=1", {"a.png": png((1, 2, 3))})
    fill(tmp_path / "parts" / "day=2", {"b.png": png((1, 2, 3))})
    assert {r.day for r in images.read_images(spark, str(tmp_path / "parts")).collect()} == {1, 2}
    assert not is_folder("viewfs://store/pictures")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        images.read_images(spark, str(tmp_path / "none"))


def test_folders_are_read_in_bounded_batches(spark, tmp_path):
    folder = fill(tmp_path / "many", {f"{i}.bin": b"x" * (i % 3) for i in range(2500)})
    assert sum(1 for _ in list_folder(folder)) == 2500
    rows = read_folders(spark, [f"file:{folder}"]).collect()
    assert sorted(int(r.origin.rsplit("/", 1)[-1][:-4]) for r in rows) == [i for i in range(2500) if i % 3]
    assert all(len(r.content) == int(r.origin.rsplit("/", 1)[-1][:-4]) % 3 and r.origin.startswith("file:///") for r in rows)


def test_addresses_are_escaped_as_java_does(spark):
    for address in ("/a b/ü%20#?[1]{x}^`|\"<>\\.png", "/plain-_.!~*'():@&=+$,;", "/nbsp\xa0　 \x85\t"):
        assert escaped(address) == spark._jvm.java.net.URI(None, None, address, None).toString()
