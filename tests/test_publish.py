"""Publishing file by file: states, statuses, and copies byte for byte."""

import os

import pytest

from placeframe.sinks import assert_files_published, content_manifest, diff_manifests, file_counts, publish, publish_files

FILES = {
    "year=2024/month=01/a.json": b'{"id":1}\n{"id":2}\n',
    "year=2024/month=01/b.json": b'{"id":3}',  # no line feed at its end
    "year=2024/month=02/odd name [1]{x},*.json": "é\r\n漢".encode(),
    "other/bytes.txt": b"\x00\xff\xfe\n\n\n",
    "c.json": b"x" * 300_000 + b"\n",
}


def make(root, files):
    for key, raw in files.items():
        os.makedirs(os.path.dirname(f"{root}/{key}"), exist_ok=True)
        with open(f"{root}/{key}", "wb") as f:
            f.write(raw)


def read(root):
    out = {}
    for folder, _, names in os.walk(root):
        for name in names:
            if not name.startswith("."):
                with open(f"{folder}/{name}", "rb") as f:
                    out[os.path.relpath(f"{folder}/{name}", root)] = f.read()
    return out


def test_first_run_copies_all_and_second_none(spark, local_dir):
    src, dst = f"{local_dir}/src", f"{local_dir}/dst"
    make(src, FILES | {"skip.csv": b"not asked for", "empty.json": b""})  # no record in either
    first = publish_files(spark, src, dst)
    assert file_counts(first) == {"uploaded": len(FILES), "unchanged": 0, "failed": 0}
    assert {r.key: (r.size, r.state) for r in first.collect()} == {k: (len(v), "absent") for k, v in FILES.items()}
    assert read(dst) == FILES  # byte for byte, and no scratch is left
    before = {k: os.stat(f"{dst}/{k}").st_mtime_ns for k in FILES}
    assert file_counts(publish_files(spark, src, dst)) == {"uploaded": 0, "unchanged": len(FILES), "failed": 0}
    assert {k: os.stat(f"{dst}/{k}").st_mtime_ns for k in FILES} == before


def test_planted_changes_are_found_and_mended(spark, local_dir):
    src, dst = f"{local_dir}/src", f"{local_dir}/dst"
    make(src, FILES)
    publish_files(spark, src, dst)
    make(dst, {"c.json": b"y" + FILES["c.json"][1:], "year=2024/month=01/a.json": b"", "year=2024/month=01/b.json": b'{"id":3}\n', "extra.json": b"stays\n"})  # the first one keeps its size
    os.remove(f"{dst}/other/bytes.txt")
    diff = {r.key: r.state for r in diff_manifests(content_manifest(spark, src), content_manifest(spark, dst)).collect()}
    assert diff == {k: "same" for k in FILES} | {"c.json": "changed", "year=2024/month=01/a.json": "absent", "year=2024/month=01/b.json": "changed", "other/bytes.txt": "absent", "extra.json": "extra"}
    report = assert_files_published(publish_files(spark, src, dst))
    assert file_counts(report) == {"uploaded": 4, "unchanged": 1, "failed": 0}
    assert read(dst) == FILES | {"extra.json": b"stays\n"}


def test_a_file_that_cannot_be_placed_fails_alone(spark, local_dir):
    src, dst = f"{local_dir}/src", f"{local_dir}/dst"
    make(src, FILES)
    make(dst, {"c.json/in the way.bin": b"a folder of that name"})
    report = publish_files(spark, src, dst)
    assert {r.key: r.status for r in report.collect()} == {k: "uploaded" for k in FILES} | {"c.json": "failed"}
    with pytest.raises(RuntimeError, match="c.json"):
        assert_files_published(report)


def test_a_file_that_is_lost_on_the_way_fails_alone(spark, local_dir, monkeypatch):
    src, dst = f"{local_dir}/src", f"{local_dir}/dst"
    make(src, FILES)
    stage = publish._stage

    def losing(spark, files, folder):
        os.remove(f"{src}/year=2024/month=01/a.json")
        return stage(spark, files, folder)

    monkeypatch.setattr(publish, "_stage", losing)
    got = {r.key: r.status for r in publish_files(spark, src, dst).collect()}
    assert got == {k: "uploaded" for k in FILES} | {"year=2024/month=01/a.json": "failed"}


def test_an_unreadable_source_file_fails_alone(spark, local_dir):
    src, dst = f"{local_dir}/src", f"{local_dir}/dst"
    make(src, FILES | {".c.json.crc": b"crc\x00\x00\x00\x02\x00" + bytes(5_000)})  # a checksum that doesn't fit
    assert {r.key: (r.state, r.status) for r in publish_files(spark, src, dst).collect()} == {k: ("absent", "uploaded") for k in FILES} | {"c.json": ("unreadable", "failed")}


def test_empty_source(spark, local_dir):
    report = publish_files(spark, f"{local_dir}/none", f"{local_dir}/dst")
    assert report.collect() == [] and file_counts(report) == {"uploaded": 0, "unchanged": 0, "failed": 0}
    assert assert_files_published(report) is report


def test_many_files_cost_few_calls_each(spark, local_dir, monkeypatch):
    src, dst = f"{local_dir}/src", f"{local_dir}/dst"
    monkeypatch.setattr(publish, "SINGLE", 3)
    files = FILES | {f"year=2024/month={i % 3 + 1:02d}/f{i}.json": b'{"id":%d}\n' % (i % 20) for i in range(60)}  # equal ones, too
    make(src, files)
    asked = []
    whether = publish.path_exists
    monkeypatch.setattr(publish, "path_exists", lambda s, path: asked.append(path) or whether(s, path))
    assert file_counts(publish_files(spark, src, dst)) == {"uploaded": len(files), "unchanged": 0, "failed": 0}
    assert read(dst) == files and len(asked) < 20  # folders, not files
    make(dst, {"year=2024/month=02/f1.json": b"[]\n"})
    os.remove(f"{dst}/c.json")
    assert file_counts(publish_files(spark, src, dst)) == {"uploaded": 2, "unchanged": len(files) - 2, "failed": 0}
    assert read(dst) == files
