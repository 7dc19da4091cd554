"""The archive source on zips made here: frames follow manifest.jsonl, not the zip."""

from __future__ import annotations

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from granary import schemas
from granary.operators.review import exhaustiveness_sample
from granary.sources.archive import read_archives, read_members


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("zips")
    with zipfile.ZipFile(root / "Set B.ZIP", "w") as z:
        z.writestr("task_0/task.json", json.dumps({"name": "first", "status": "completed"}))
        lines = ['{"version":"1.1"}', "not json", json.dumps({"name": "a", "extension": ".jpg", "width": 10, "height": 20}), "{broken",
                 json.dumps({"name": "b.jpg", "extension": ".jpg", "width": 30, "height": 40}), json.dumps({"name": "a", "extension": ".jpg", "width": 11, "height": 21})]
        z.writestr("task_0/data/b.jpg", b"bytes of b")
        z.writestr("task_0/data/c.jpg", b"bytes of a")
        z.writestr("task_0/data/a.jpg", b"bytes of a")
        z.writestr("task_0/data/manifest.jsonl", "\n".join(lines))
        shapes = [{"frame": 1, "type": "points", "label": "x", "points": [1, 2, 3, 4]}, {"frame": 1, "type": "ellipse", "label": "x", "points": [1, 2]},
                  {"type": "points", "points": [1, 2]}, {"frame": 1, "type": "rectangle", "label": "y", "points": [5, 5, 1, 1]}]
        tracks = [{"label": "t", "shapes": [{"frame": 0, "type": "points", "points": [7, 8]}, {"frame": 2, "type": "points", "label": "own", "points": [9, 9]}]}]
        z.writestr("task_0/annotations.json", json.dumps([{"shapes": shapes, "tracks": tracks}, {"shapes": None, "tracks": None}]))
    with zipfile.ZipFile(root / "a.zip", "w") as z:
        z.writestr("task_3/annotations.json", json.dumps({"shapes": [{"frame": 0, "type": "points", "label": "z", "points": [1, 1]}]}))
        z.writestr("task_3/task.json", "{oops")
        z.writestr("task_3/data/DJI_20250602104520_0007_D.JPG", b"bytes of b")
    (root / "broken.zip").write_bytes(b"no zip")
    (root / "note.txt").write_text("x")
    return str(root)


def test_catalogue(spark, folder):
    manifest, instances = read_archives(spark, folder)
    schemas.require(manifest, schemas.MANIFEST, types=True, allow_extra=False)
    schemas.require(instances, schemas.INSTANCES, types=True, allow_extra=False)
    rows = {r.image_name: r for r in manifest.collect()}
    assert {n: r.frame_index for n, r in rows.items()} == {"a.jpg": 0, "b.jpg": 1, "c.jpg": 2, "DJI_20250602104520_0007_D.JPG": 0}
    assert (rows["a.jpg"].width, rows["a.jpg"].height, rows["c.jpg"].width) == (11, 21, -1)
    assert rows["a.jpg"].content_hash == rows["c.jpg"].content_hash and rows["a.jpg"].task_status == "completed" and rows["a.jpg"].dataset == "Set B"
    drone = rows["DJI_20250602104520_0007_D.JPG"]
    assert (drone.sensor, drone.task_name, drone.extension, drone.n_annotations, drone.source_mosaic) == ("DJI", "", "jpg", 1, "DJI_20250602104520_0007")
    assert (rows["b.jpg"].n_annotations, rows["a.jpg"].n_annotations, rows["c.jpg"].n_annotations) == (3, 1, 1)
    uid = {r.image_uid: r.image_name for r in rows.values()}
    got = sorted((uid[r.image_uid], r.instance_id.split("-", 1)[1], r.label_raw, r.shape_type, r.x, r.y) for r in instances.collect())
    assert got == [
        ("DJI_20250602104520_0007_D.JPG", "0-0", "z", "points", 1.0, 1.0), ("a.jpg", "0-0", "t", "points", 7.0, 8.0), ("b.jpg", "0-0", "x", "points", 1.0, 2.0),
        ("b.jpg", "0-1", "x", "points", 3.0, 4.0), ("b.jpg", "2-0", "y", "rectangle", 3.0, 3.0), ("c.jpg", "0-0", "own", "points", 9.0, 9.0),
    ]
    sheet = exhaustiveness_sample(manifest, instances, 10, 0, "set")
    assert {r.image: r.marked for r in sheet.collect()} == {"a.jpg": 1, "b.jpg": 2 + 1, "c.jpg": 1}


def test_members(spark, folder):
    members = read_members(spark, folder, include_bytes=False)
    assert members.where("member like '%.jpg' and content is not null").count() == 0
    assert members.where(F.col("error").isNotNull()).select("archive").first().archive == "broken.zip"
    assert read_members(spark, folder, limit=1).select("archive").distinct().count() == 1
