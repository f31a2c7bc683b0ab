"""Dealing a table to the files of a stream."""

from credere.plans import catalog_models as C
from credere.sources.tables import path_bytes


def test_stream_files_grow_with_the_table():
    assert [C.stream_files(n) for n in (0, C.STREAM_FILE, 3 * C.STREAM_FILE, 3 * C.STREAM_FILE + 1, 100 * C.STREAM_FILE)] == [3, 3, 3, 4, 100]


def test_path_bytes_of_a_file_and_of_a_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_bytes(b"12345")
    (tmp_path / "in" / "b").write_bytes(b"123")
    assert path_bytes(spark, str(tmp_path / "in" / "a")) == 5 and path_bytes(spark, str(tmp_path / "in")) == 8
