"""Exact round trips through archives, and recovery from damaged reads."""

import hashlib
import zlib

import pytest

from corpusmill.llm import media as M
from corpusmill.llm.common import scratch, table

ODD = [None, "", "a", "x" * 192, "x" * 193, "🙂é" * 400, "\x00\n" * 10, "long " * 60_000]


def expected(doc_id, text):
    data = (text or "").encode()
    padded = data + b" " * (-len(data) % 192) if data else b" " * 192
    image = M.to_image(data)
    return (doc_id, len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-16:]), len(image), hashlib.sha256(image).hexdigest(), M.feature(padded))


def test_all_documents_come_back(spark, sf_dir):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(9, "same"), (9, "same"), (None, "no id")]
    rows += [(100 + r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as feature").repartition(5)
    got = [tuple(r) for r in M.store_and_describe(df).collect()]
    assert sorted(got, key=str) == sorted((expected(*r) for r in rows), key=str)
    assert M.store_and_describe(df.limit(0)).count() == 0


def test_byte_ranges_share_the_members_out(spark, tmp_path):
    folder = f"file://{tmp_path}/a"
    df = spark.createDataFrame([(i, f"text {i} " * (i % 50)) for i in range(300)], "doc_id long, text string").coalesce(2)
    assert M.write_archives(df, folder) == 300
    for split in (2_000, 10**9):
        got = M.read_archives(spark, folder, splitBytes=split)
        assert sorted(r.member.split("/")[0] for r in got.collect()) == sorted(str(i) for i in range(300))
    import zipfile

    for path in sorted((tmp_path / "a").glob("*.zip")):
        assert zipfile.ZipFile(path).testzip() is None


def test_members_are_tried_again_alone(tmp_path):
    store, root = M.filesystem(f"file://{tmp_path}")
    w = M.ArchiveWriter(store, f"{root}/x.zip")
    for i in range(3):
        w.add(f"{i}/0.png", M.to_image(b"abc" * (i + 1)))
    w.close()
    reader = M.ArchiveReader({"path": f"file://{tmp_path}", "tries": "3", "errors": "column"})
    (part,) = reader.partitions()
    whole = (tmp_path / "x.zip").read_bytes()
    offset, size, crc, _ = M._directory(open(tmp_path / "x.zip", "rb"), len(whole))[1]
    broken = bytearray(whole)
    broken[offset + 30 + 7 + 20] ^= 255
    (tmp_path / "x.zip").write_bytes(bytes(broken))
    (batch,) = reader.read(part)
    assert [e is None for e in batch.column("error").to_pylist()] == [True, False, True]
    with pytest.raises(ValueError, match="damaged"):
        list(M.ArchiveReader({"path": f"file://{tmp_path}", "tries": "1"}).read(part))

    class Flaky:
        """Fails the first two opens after the one that reads the directory."""

        def __init__(self):
            self.opens = 0

        def open_input_file(self, path):
            self.opens += 1
            if self.opens < 3:
                raise OSError("lost")
            (tmp_path / "x.zip").write_bytes(whole)
            return store.open_input_file(path)

    assert reader._fetch(Flaky(), part.archive, offset, size, crc) == M.to_image(b"abcabc")


def test_two_attempts_of_a_task_do_not_mix(tmp_path):
    store, root = M.filesystem(f"file://{tmp_path}")
    a, b = (M.ArchiveWriter(store, f"{root}/x.zip", k) for k in (1, 2))
    for w in (a, b):
        w.add("1/0.png", M.to_image(b"same"))
    a.close()
    b.close()
    assert [p.name for p in tmp_path.iterdir()] == ["x.zip"]
    import zipfile

    assert zipfile.ZipFile(tmp_path / "x.zip").testzip() is None


def test_scratch_is_shared(spark):
    assert scratch(spark, "media") != scratch(spark, "media")
