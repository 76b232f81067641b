"""Embedded images and their references."""

import base64

from quirework.sources import images


def test_extracted_and_resolved(spark):
    png = base64.b64encode(b"\x89PNG").decode()
    img = spark.createDataFrame([("j", 0, "img/a.PNG", png), ("j", 1, "img\\b.jpg", "data:image/jpeg;base64," + png), ("j", 2, "c.tiff", png), ("j", 3, "d.png", "***"), ("j", 4, "e.png", None), ("k", 0, "img/a.PNG", png)], "journal_id string, ordinal int, name string, data string")
    refs = spark.createDataFrame([("j", "img/a.PNG", 0, 2), ("j", "img/b.jpg", 1, 2), ("j", "img/a.PNG", 2, 9), ("j", "other/c.tiff", 3, 4)], "journal_id string, ref string, ordinal int, page_index int")
    got = {(r.journal_id, r.name): (r.page_index, r.file_name, bytes(r.content)) for r in images.extracted(img, refs).collect()}
    assert got == {
        ("j", "img/a.PNG"): (2, "p002_img001.png", b"\x89PNG"), ("j", "img\\b.jpg"): (2, "p002_img002.jpg", b"\x89PNG"), ("j", "c.tiff"): (4, "p004_img001.png", b"\x89PNG"), ("k", "img/a.PNG"): (None, "punknown_img001.png", b"\x89PNG"),
    }
    assert images.extracted(img.limit(0), refs).count() == 0


def test_missing_files(spark):
    s = spark.createDataFrame([(1, ["a.png", "b.png"]), (2, None), (3, [])], "ordinal int, images array<string>")
    f = spark.createDataFrame([("a.png",), ("a.png",)], "path string")
    assert [tuple(r) for r in images.missing_files(s, f).collect()] == [(1, "b.png")]
