"""The manifest of document files: what has not changed is not opened."""

import hashlib
import os

import pytest

from lendscope.sources.documents import Manifest, contents_of

LIMIT = "spark.sql.sources.binaryFile.maxLength"


@pytest.fixture
def place(spark, tmp_path):
    (tmp_path / "docs/policies/sub").mkdir(parents=True)
    yield tmp_path / "docs/policies"
    spark.conf.unset(LIMIT)


def found(manifest):
    return {row["file_name"]: (row["file_size"], row["file_hash"]) for row in manifest.read().collect()}


def put(place, name, text, age=0):
    (place / name).write_text(text)
    os.utime(place / name, (1_700_000_000 - age, 1_700_000_000 - age))
    return {f"policies/{name}": (len(text), hashlib.md5(text.encode()).hexdigest())}


def test_only_changed_files_are_opened(spark, place, tmp_path):
    manifest = Manifest(spark, f"file://{tmp_path}/manifest", f"file://{place.parent}")
    assert manifest.refresh() == 0 and found(manifest) == {} if manifest.read() else True
    there = put(place, "a.pdf", "long " * 100, 50) | put(place, "sub/b.pdf", "also long " * 100, 40) | put(place, "c.pdf", "c", 30)
    put(place, "note.txt", "no document")
    assert manifest.refresh() == 3 and found(manifest) == there
    # From now on, reading the content of a long file fails.
    spark.conf.set(LIMIT, 20)
    assert manifest.refresh() == 0 and manifest.versions.published() is not None
    published = manifest.versions.published()
    there |= put(place, "c.pdf", "other", 10) | put(place, "d.pdf", "new", 5)
    assert manifest.refresh() == 2 and found(manifest) == there and manifest.versions.published() == published + 1
    (place / "d.pdf").unlink()
    del there["policies/d.pdf"]
    assert manifest.refresh() == 0 and found(manifest) == there
    # A file that is written again with another time is opened, whatever it holds.
    put(place, "c.pdf", "other", 1)
    assert manifest.refresh() == 1 and found(manifest) == there


def test_contents_of_wanted_files(spark, place, tmp_path):
    manifest = Manifest(spark, f"file://{tmp_path}/manifest", f"file://{place.parent}")
    for number in range(6):
        put(place, f"{number}.pdf", f"text {number}", 100 - number)
    manifest.refresh()
    wanted = manifest.read().where("file_name IN ('policies/2.pdf', 'policies/5.pdf')")
    read = contents_of(wanted, f"file://{place.parent}").collect()
    assert sorted(bytes(row["content"]).decode() for row in read) == ["text 2", "text 5"]
    assert contents_of(wanted.limit(0), f"file://{place.parent}").collect() == []
