"""Dumps read in ranges against the dump unpacked whole."""

import bz2
import random
import re

import pytest

from corpusmill.sources import dumps as D


def dump(n, seed=0, size=400):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyzäé", k=rng.randint(2, 9)))
    pages = [f"<page><title>T{i}</title><ns>{i % 3}</ns><revision><text>{' '.join(word() for _ in range(rng.randint(1, size)))}</text></revision></page>" for i in range(n)]
    return "<mediawiki>\n" + "\n".join(pages) + "\n</mediawiki>", pages


def read(data, tmp_path, size, **options):
    (tmp_path / "d.xml.bz2").write_bytes(data)
    reader = D.Reader({"path": str(tmp_path / "d.xml.bz2"), "rangeBytes": str(size)} | options)
    return [[tuple(r) for r in reader.read(p)] for p in reader.partitions()]


def test_marks_under_all_shifts():
    rng = random.Random(1)
    for shift in range(8):
        bits = "".join(rng.choice("01") for _ in range(40 + shift)) + f"{D.BLOCK:048b}" + "".join(rng.choice("01") for _ in range(83)) + f"{D.END:048b}" + "1" * 32
        bits += "0" * (-len(bits) % 8)
        assert D.marks(int(bits, 2).to_bytes(len(bits) // 8, "big")) == [(40 + shift, True), (40 + shift + 48 + 83, False)]


@pytest.mark.parametrize("level, size", [(1, 20_000), (1, 70_000), (1, 333), (9, 100_000), (1, 10_000_000)])
def test_ranges_give_each_page_once(tmp_path, level, size):
    text, pages = dump(700 if size > 1000 else 120)
    got = read(bz2.compress(text.encode(), level), tmp_path, size)
    assert [r[3] for part in got for r in part if r[3]] == []
    assert [r[2] for part in got for r in part] == pages
    if (level, size) == (1, 20_000):
        assert sum(bool(p) for p in got) > 5


def test_several_streams_and_long_pages(tmp_path):
    (a, first), (b, second) = dump(150, 2), dump(3, 3, size=120_000)
    data = bz2.compress(a.encode(), 1) + bz2.compress(b"", 1) + bz2.compress(b.encode(), 1)
    assert [r[2] for part in read(data, tmp_path, 15_000) for r in part] == first + second


def test_a_broken_block_and_a_cut_off_file_are_reported(tmp_path):
    text, pages = dump(700)
    data = bytearray(bz2.compress(text.encode(), 1))
    blocks = [b for b, is_block in D.marks(bytes(data)) if is_block]
    data[blocks[3] // 8 + 60] ^= 0xFF
    rows = [r for part in read(bytes(data), tmp_path, 40_000) for r in part]
    errors = [r for r in rows if r[3]]
    found = [r[2] for r in rows if r[2]]
    assert len(errors) >= 1 and all(f"bit {blocks[3]}" in r[3] for r in errors) and found == [p for p in pages if p in set(found)]
    assert len(found) >= len(pages) - 3 * -(-700 // len(blocks))
    whole = bz2.compress(text.encode(), 1)
    rows = [r for part in read(whole[: len(whole) // 2], tmp_path, 40_000) for r in part]
    assert any(r[3] and "cut off" in r[3] for r in rows) and [r[2] for r in rows if r[2]] == pages[: sum(r[2] is not None for r in rows)]


def test_spark_reads_articles(spark, tmp_path):
    text, pages = dump(300)
    (tmp_path / "a.xml.bz2").write_bytes(bz2.compress(text.encode(), 1))
    (tmp_path / "b.xml.bz2").write_bytes(bz2.compress(dump(5, 9)[0].encode(), 9))
    df = D.read_pages(spark, str(tmp_path), 20_000)
    assert df.rdd.getNumPartitions() > 3
    rows = D.articles(df).collect()
    assert len(rows) == 305
    want = {re.search("<text>(.*)</text>", p)[1] for p in pages}
    assert want <= {r.text for r in rows} and {r.ns for r in rows} == {0, 1, 2}
