"""Operators against plain code and on hand-made cases."""

from __future__ import annotations

import json
import random
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary import schemas, session, sinks
from granary.functions.geometry import mapped_point
from granary.operators import components, dedup, episodes, images, labels, lineage, sampling, splits, tiling, validate
from granary.sources import sheets
from granary.streaming import resume


def partition(pairs):
    """Groups as a set of frozen sets, from (node, group) pairs."""
    by = defaultdict(set)
    for node, group in pairs:
        by[group].add(node)
    return {frozenset(v) for v in by.values()}


def union_find(nodes, edges):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    chain = [(i, i + 1) for i in range(1000, 1040)]
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + chain + [(5, 5)]
    got = components.connected_components(spark.createDataFrame([*edges, (None, 3)], "a long, b long"))
    want = union_find({x for e in edges for x in e}, edges)
    assert {(r.node, r.component) for r in got.collect()} == set(want.items())
    none = components.connected_components(spark.createDataFrame([], "a long, b long"))
    assert none.count() == 0


@pytest.mark.parametrize("most", [0, 6, 7, 12])
def test_hamming_pairs(spark, most):
    rng = random.Random(most)
    base = [rng.getrandbits(64) for _ in range(12)]
    values = base + [b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(1, 14))) for b in base for _ in range(4)]
    signed = [v - (1 << 64) if v >> 63 else v for v in values] + [None]
    got = {(r.a, r.b, r.distance) for r in dedup.hamming_pairs(spark.createDataFrame([(v,) for v in signed], "bits long"), most).collect()}
    known = sorted({v for v in signed if v is not None})
    apart = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    assert got == {(a, b, apart(a, b)) for i, a in enumerate(known) for b in known[i + 1 :] if apart(a, b) <= most}


def test_hamming_blocks_and_many_hashes(spark, monkeypatch):
    rng = random.Random(5)
    values = [rng.getrandbits(64) - (1 << 63) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "bits long")
    apart = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    monkeypatch.setattr(dedup, "BLOCK", 64)
    want = {(min(a, b), max(a, b), apart(a, b)) for i, a in enumerate(values) for b in values[i + 1 :] if apart(a, b) <= 24}
    assert {tuple(r) for r in dedup.hamming_pairs(df, 24).collect()} == want and want
    assert dedup.hamming_pairs(df.limit(0), 24).count() == 0
    assert dedup._bands(6)[:2] == (4, 1) and dedup._bands(18)[2] > dedup.SELECTIVE
    base = [rng.getrandbits(63) for _ in range(25_000)]
    many = spark.createDataFrame([(v,) for v in base + [b ^ sum(1 << k for k in rng.sample(range(63), 6)) for b in base]], "bits long")
    began = time.perf_counter()
    assert dedup.hamming_pairs(many, 6).count() >= 25_000
    assert time.perf_counter() - began < 60


def test_blocks_skipped_by_size(spark):
    rows = [(k, "d", 1000 + k, str(k)) for k in range(5)] + [(9, None, 10, "a"), (10, None, 10, "b")]
    df = spark.createDataFrame(rows, "image_uid long, dataset string, size_bytes long, content_key string")
    near = lambda most: dedup.near_sizes(df, ["dataset"], "size_bytes", "image_uid", "content_key", most=most).count()
    assert (near(4), near(5), near(None)) == (1, 5, 5)
    assert [tuple(r) for r in dedup.skipped_blocks(df, ["dataset"], 4).collect()] == [("d", 5)]


def test_components_in_one_task_and_in_rounds(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 360)] + [(7, None), (500, 500)]
    for kind, cast in (("long", int), ("string", lambda x: f"é{x}")):
        df = spark.createDataFrame([(None if a is None else cast(a), None if b is None else cast(b)) for a, b in pairs], f"a {kind}, b {kind}")
        one, many = (sorted(map(tuple, components.connected_components(df, one_task=n).collect())) for n in (1000, 0))
        assert one == many and len({c for _, c in one}) < len(one)
        assert components.connected_components(df.limit(0), one_task=5).count() == 0


def test_overlaps(spark):
    rows = [(k, "m", x, 0, 512, 512) for k, x in enumerate((0, 256, 512, 2000))] + [(9, "", 0, 0, 512, 512), (10, "n", -1, 0, 512, 512)]
    df = spark.createDataFrame(rows, "image_uid long, source_mosaic string, tile_x long, tile_y long, width long, height long")
    assert sorted(r.image_uid for r in dedup.overlaps(df).collect()) == [0, 1, 2]


def test_overlaps_sends_no_tiles_to_all(spark):
    """Tiles of few bytes a row were broadcast by way of the driver, whose memory they filled."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        tiles = spark.range(200).selectExpr("id AS image_uid", "'m' || id % 2 AS source_mosaic", "id * 7 AS tile_x", "0L AS tile_y", "20L AS width", "20L AS height")
        found = dedup.overlaps(tiles)
        assert found.count() == 200
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_overlaps_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(k % 390 if k % 50 else None, f"m{k % 4}", *(rng.randrange(-1, (60, 300, 900, 3000)[k % 4]) for _ in "xy"), rng.choice((19, 20, 21)), rng.choice((30, 31))) for k in range(400)]
    df = spark.createDataFrame(rows, "image_uid long, source_mosaic string, tile_x long, tile_y long, width long, height long")
    size = {r.source_mosaic: (r.w, r.h) for r in dedup.tile_sizes(df).collect()}
    known = [r for r in rows if r[0] is not None and r[2] >= 0 and r[3] >= 0]
    near = lambda a, b: a[0] != b[0] and a[1] == b[1] and abs(a[2] - b[2]) < size[a[1]][0] and abs(a[3] - b[3]) < size[a[1]][1]
    want = {(a[1], a[0]) for a in known if any(near(a, b) for b in known)}
    got = [tuple(r) for r in dedup.overlaps(df).select("group_key", "image_uid").collect()]
    assert len(got) == len(set(got)) and set(got) == want and 50 < len(want) < len(known)


def test_near_sizes(spark):
    rows = [(1, "d", 1000, "a"), (2, "d", 1015, "b"), (3, "d", 1100, "c"), (4, "e", 5, "a"), (5, "d", 1015, "b")]
    df = spark.createDataFrame(rows, "image_uid long, dataset string, size_bytes long, content_key string")
    got = dedup.near_sizes(df, ["dataset"], "size_bytes", "image_uid", "content_key")
    assert [(r.a, r.b) for r in got.collect()] == [(1, 2)]


def test_lineage_case_and_random(spark):
    rows = [("a", "h1", "", "s"), ("b", "h1", "m1", "s"), ("c", "h2", "m1", "t"), ("d", "h3", "", "u"), ("e", "h4", "", "u"), ("f", "h5", "", "t")]
    df = spark.createDataFrame(rows, "image_uid string, h string, m string, site string")
    got = lineage.families(df, {1: F.col("h"), 2: F.col("m")}, F.col("site")).collect()
    assert partition((r.uid, r.family) for r in got) == {frozenset("abc"), frozenset("de"), frozenset("f")}
    assert {r.uid: r.evidence_rank for r in got} == {"a": 1, "b": 1, "c": 2, "d": 6, "e": 6, "f": 6}
    rng = random.Random(5)
    rows = [(f"p{i:03d}", str(rng.randrange(60)), str(rng.randrange(70)), str(rng.randrange(3))) for i in range(80)]
    df = spark.createDataFrame(rows, "image_uid string, h string, m string, site string")
    edges = [(a[0], b[0]) for a in rows for b in rows if a < b and (a[1] == b[1] or a[2] == b[2])]
    top = union_find([r[0] for r in rows], edges)
    size = defaultdict(int)
    for t in top.values():
        size[t] += 1
    want = {u: t if size[t] > 1 else "site" + next(r[3] for r in rows if r[0] == u) for u, t in top.items()}
    got = lineage.families(df, {1: F.col("h"), 2: F.col("m")}, F.col("site")).collect()
    assert partition((r.uid, r.family) for r in got) == partition(want.items())
    named = {r.family: r.leakage_group_id for r in lineage.family_names(spark.createDataFrame(got)).collect()}
    assert named == {f: f"g{i:06d}" for i, f in enumerate(sorted({r.family for r in got}))}


def test_greedy_split(spark):
    sizes = spark.createDataFrame([("a", 5), ("b", 2), ("c", 2), ("d", 1)], "family string, n long")
    got = {r.family: r.split for r in splits.assign(sizes).collect()}
    assert got == {"a": "train", "b": "train", "c": "dev_cal", "d": "dev_select"}
    many = spark.range(400).select(F.col("id").alias("family"), (F.col("id") % 7 + 1).alias("n"))
    shares = {r.split: r.share for r in splits.summary(splits.assign(many)).collect()}
    assert all(abs(shares[s] - t) < 0.01 for s, t in zip(schemas.SPLITS, schemas.SHARES))
    assert splits.assign(sizes.limit(0)).count() == 0


def test_labels_round(spark):
    raw = spark.createDataFrame([(x,) for x in ["Garlic"] * 3 + ["garlic_2", "Ripe", "z11", None]], "label_raw string")
    rows = {r.label_raw: r for r in labels.propose(raw).collect()}
    assert rows["garlic_2"].suggested_canon == "Garlic" and rows["Garlic"].spellings == 2 and rows["Ripe"].note.startswith("modifier")
    sheet = labels.review_sheet(labels.propose(raw))
    with pytest.raises(sinks.DataQualityError):
        labels.check_review(sheet)
    done = spark.createDataFrame([("Garlic", " garlic ", "keep", "", "me"), ("Ripe", "", "drop", "", "me")], "label_raw string, label_canon string, decision string, domain string, approved_by string")
    got = labels.apply(raw, labels.ontology(labels.check_review(done), "now"))
    assert sorted((r.label_raw or "", r.label_canon) for r in got.collect()) == [("", ""), *[("Garlic", "garlic")] * 3, ("garlic_2", ""), ("z11", "")]


def test_gate(spark):
    photos = spark.createDataFrame([("a", 10, 10, "completed"), ("b", -1, -1, "x"), ("b", 5, 5, "x")], "image_uid string, width long, height long, task_status string")
    marks = spark.createDataFrame(
        [("a", "points", 10.0, 0.0, 0.0, 0.0, 0.0, "l"), ("a", "points", 11.0, 0.0, 0.0, 0.0, 0.0, "l"), ("z", "rectangle", 1.0, 1.0, 0.0, 1.0, 5.0, "l")],
        "image_uid string, shape_type string, x double, y double, w double, h double, area_px double, label_raw string",
    )
    got = {r.check: (r.bad, r.total) for r in validate.run_gate(photos, marks).collect()}
    assert got["image_uid unique"] == (1, 3) and got["instance has photo"] == (1, 3) and got["centre inside photo"] == (1, 2)
    assert got["box has size"] == (1, 1) and got["area within box"] == (1, 1) and got["ontology table"][0] == 1
    with pytest.raises(sinks.DataQualityError):
        sinks.enforce(validate.run_gate(photos, marks))
    with pytest.raises(schemas.SchemaError):
        schemas.require(photos, schemas.MANIFEST, "manifest")
    assert schemas.require(schemas.empty(spark, schemas.INSTANCES), schemas.INSTANCES, types=True, allow_extra=False).count() == 0


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 9).alias("s"))
    few, many = ({r.k for r in sampling.stratified_sample(df.repartition(n), 40, 3, "k", "s").collect()} for n in (1, 13))
    assert few == many and len(few) == 36
    assert sampling.fixed_sample(df, 17, 1, "k").count() == 17


def test_episodes(spark):
    photos = spark.createDataFrame([(f"p{i}", "train" if i < 8 else "dev_cal", f"g{i % 3}", f"h{i % 7}", "") for i in range(12)], "image_uid string, split string, leakage_group_id string, content_hash string, content_key string")
    marks = spark.createDataFrame([(f"p{i}", f"i{i}-{j}", f"l{i % 2}", "", float(j), float(i)) for i in range(12) for j in range(5)], "image_uid string, instance_id string, label_raw string, label_canon string, x double, y double")
    counts = {"train": 30, "dev_cal": 10, "sealed_test": 5}
    got = episodes.build_episodes(photos, marks, counts, k_support=3, k_query=9, seed=4)
    rows = got.collect()
    assert len(rows) == 40 and all(r.support_uid != r.query_uid and r.n_support == 3 and r.n_query == 5 for r in rows)
    assert "p7" not in {u for r in rows for u in (r.support_uid, r.query_uid)}  # a copy of p0
    assert sorted(rows) == sorted(episodes.build_episodes(photos.repartition(5), marks.repartition(7), counts, k_support=3, k_query=9, seed=4).collect())
    audit = episodes.leakage_audit(got, photos)
    episodes.enforce_audit(audit)
    assert audit.first().episodes == 40
    with pytest.raises(sinks.DataQualityError):
        episodes.enforce_audit(episodes.leakage_audit(got, photos.withColumn("split", F.lit("other"))))


@pytest.mark.parametrize("h,w,core,halo,stride", [(200, 300, 128, 32, 16), (64, 64, 64, 0, 32), (65, 31, 32, 16, 16), (15, 200, 16, 16, 16), (100, 100, 32, 64, 32)])
def test_tiles_cover_once(spark, h, w, core, halo, stride):
    maps = spark.createDataFrame([(1, w, h)], "k int, w int, h int")
    tiles = tiling.plan(maps, F.col("w"), F.col("h"), core, halo, stride)
    counts = tiling.write_counts(tiling.kept_spans(tiles, ["k"], F.col("w"), F.col("h"), core, stride), maps, "k", F.col("w"), F.col("h"), stride)
    r = counts.first()
    assert (r.cells, r.holes, r.doubles) == ((h // stride) * (w // stride), 0, 0)
    tiling.enforce_written_once(counts)

    def cells(x0, y0, x1, y1):
        rows, cols = np.arange(y0 // stride, -(-y1 // stride)), np.arange(x0 // stride, -(-x1 // stride))
        return np.stack(np.meshgrid(rows, cols, indexing="ij"), -1)

    got = tiling.stitch(tiles, "k", "w", "h", core, stride, cells).collect()
    assert len(got) == r.cells and all(g["values"] == [g["row"], g["col"]] for g in got)


def test_write_counts_see_holes_and_doubles(spark):
    spans = spark.createDataFrame([(1, 0, 0, 3), (1, 0, 1, 2), (1, 0, 1, 4), (1, 1, 2, 4), (1, 1, 0, 1)], "k int, row int, first int, end int")
    maps = spark.createDataFrame([(1, 4, 2), (2, 4, 1)], "k int, w int, h int")
    got = {r.k: (r.cells, r.holes, r.doubles) for r in tiling.write_counts(spans, maps, "k", F.col("w"), F.col("h"), 1).collect()}
    assert got == {1: (8, 1, 2), 2: (4, 4, 0)}
    with pytest.raises(sinks.DataQualityError):
        tiling.enforce_written_once(tiling.write_counts(spans, maps, "k", F.col("w"), F.col("h"), 1))


def test_tile_plan_case(spark):
    tiles = tiling.plan(spark.createDataFrame([(300, 200)], "w int, h int"), F.col("w"), F.col("h"), 128, 32, 16).collect()
    second = next(t for t in tiles if t.keep_col0 == 8 and t.keep_row0 == 0)
    assert len(tiles) == 6 and (second.read_x0, second.read_x1, second.trim_left) == (96, 288, 2)


def test_points_follow_pixels(spark):
    h, w = 5, 8
    plain = np.arange(h * w).reshape(h, w)
    cases, want = [], {}
    for fx in (False, True):
        for fy in (False, True):
            for k in range(4):
                turned = np.rot90(plain[:: -1 if fy else 1, :: -1 if fx else 1], k)
                for y in range(h):
                    for x in range(w):
                        px, py = images.Pose(fx, fy, k).points(np.array([x]), np.array([y]), w, h)
                        assert turned[py[0], px[0]] == plain[y, x]
                        cases.append((x, y, fx, fy, k))
                        want[cases[-1]] = (int(px[0]), int(py[0]))
    df = spark.createDataFrame(cases, "x int, y int, fx boolean, fy boolean, k int")
    nx, ny = mapped_point(F.col("x"), F.col("y"), F.lit(w), F.lit(h), F.col("fx"), F.col("fy"), F.col("k"))
    got = df.select("*", nx.alias("nx"), ny.alias("ny")).collect()
    assert {(r.x, r.y, r.fx, r.fy, r.k): (r.nx, r.ny) for r in got} == want


def test_episode_items(spark):
    rgb = np.random.default_rng(0).integers(0, 255, (6, 4, 3)).astype(np.uint8)
    df = spark.createDataFrame([("e1", "support", rgb.tobytes(), 6, 4, [1.0], [2.0]), ("e1", "query", rgb.tobytes(), 6, 4, [0.0], [0.0])], "episode_id string, side string, data binary, height int, width int, x array<double>, y array<double>")
    plain = images.episode_items(df, augmented=False).where("side = 'support'").first()
    assert np.allclose(np.array(plain.image).reshape(3, 6, 4), images.normalise(rgb), atol=1e-6) and plain.x == [1.0]
    a, b = (sorted(images.episode_items(df.repartition(n), seed=3).select("side", "x", "y", "rot90").collect()) for n in (1, 2))
    assert a == b
    same = images.photometric(rgb, np.random.default_rng(1), 0, 0, 0, 0)
    assert np.abs(same.astype(int) - rgb).max() <= 1


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "train", 1), ("b", "dev_cal", 2)], "k string, split string, v int")
    sinks.write_by_split(df, str(tmp_path / "s"))
    sinks.write_by_split(df.where("split = 'train'"), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 1
    assert sinks.next_version(spark, df, str(tmp_path / "m")).endswith("v=1") and sinks.next_version(spark, df, str(tmp_path / "m")).endswith("v=2")
    sinks.write_sheet(df, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 2
    side = spark.createDataFrame([("a", 7)], "k string, v int")
    assert {r.k: r.v for r in sinks.with_side_table(df, side, "k", ["v"], {"v": -1}).collect()} == {"a": 7, "b": -1}


def test_streams(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in "sot")
    rows = lambda a, b: spark.range(a, b).write.mode("append").parquet(source)
    rows(0, 5)
    stage = lambda df: df.withColumn("double", F.col("id") * 2)
    assert resume.resume_stage(spark, source, "id long", out, state, stage) == 5
    rows(5, 8)
    assert resume.resume_stage(spark, source, "id long", out, state, stage) == 8
    assert resume.resume_stage(spark, source, "id long", out, state, stage) == 8
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    assert resume.windowed_counts(events).agg(F.sum("n")).first()[0] == events.count()


# -- sinks, gates, sheets, decoding -----------------------------------------------------------------------------------------


def test_table_and_report(spark, tmp_path):
    sinks.write_table(spark.range(3), f"{tmp_path}/t")
    sinks.write_table(spark.range(2), f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2
    sizes = spark.createDataFrame([("a", 6), ("b", 1), ("c", 1)], "family string, n long")
    assigned = splits.assign(sizes)
    found = sinks.split_document(splits.summary(assigned), assigned, 7)
    assert found["seed"] == 7 and found["photographs"] == 8 and found["families"] == 3 and found["splits"]["train"]["photographs"] == 6
    sinks.write_report(spark, found, f"{tmp_path}/report.json")
    assert json.loads((tmp_path / "report.json").read_text()) == found


def test_gates_that_raise(spark):
    photos = spark.createDataFrame([(1, "f", "train"), (2, "f", "dev_cal"), (3, "g", "train")], "image_uid long, fam string, split string")
    with pytest.raises(sinks.DataQualityError, match="f"):
        splits.enforce_whole_families(photos, "fam")
    assert splits.enforce_whole_families(photos.where("fam = 'g'"), "fam").count() == 1
    assert episodes.enforce_splits(photos) is photos and episodes.enforce_splits(photos.limit(0)).count() == 0
    for bad in (photos.drop("split"), photos.withColumn("split", F.lit(""))):
        with pytest.raises(sinks.DataQualityError, match="no splits"):
            episodes.enforce_splits(bad)


def test_gate_with_ontology_and_lineage(spark):
    def table(schema, *rows):
        return spark.createDataFrame([{f.name: r.get(f.name) for f in schema} for r in rows], schema)

    manifest = table(schemas.MANIFEST, *[{"image_uid": u, "task_status": "completed", "width": 9, "height": 9} for u in "ab"])
    own = {"shape_type": "points", "x": 1.0, "y": 1.0, "w": 0.0, "h": 0.0, "area_px": 0.0}
    instances = table(schemas.INSTANCES, {"image_uid": "a", "label_raw": "known", "label_canon": "k", **own}, {"image_uid": "b", "label_raw": "new", "label_canon": "", **own})
    ontology = table(schemas.ONTOLOGY, {"label_raw": "known", "label_canon": "k"})
    families = table(schemas.LINEAGE, {"image_uid": "a", "leakage_group_id": "g1"})
    bad = {r["check"]: r.bad for r in validate.run_gate(manifest, instances, ontology, families).collect()}
    assert bad["label approved"] == 1 and bad["canon filled"] == 1 and bad["photo has family"] == 1 and bad["enough families"] == 29
    assert "ontology table" not in bad and "lineage table" not in bad


def test_audit_counts_what_leaks(spark):
    manifest = spark.createDataFrame([("a", "train", "A.zip", "m1"), ("b", "dev_cal", "B.zip", "m2")], "image_uid string, split string, archive string, member string")
    made = spark.createDataFrame([("e1", "train", "x", "a", "a", 1), ("e2", "train", "x", "a", "b", 0), ("e3", "dev_cal", "y", "b", "gone", 0)], "episode_id string, split string, label string, support_uid string, query_uid string, same_family long")
    audit = episodes.leakage_audit(made, manifest)
    r = audit.first()
    assert (r.episodes, r.labels, r.same_photo, r.cross_split) == (3, 2, 1, 2)
    with pytest.raises(sinks.DataQualityError):
        episodes.enforce_audit(audit)
    found = {r.episode_id: (r.support_archive, r.query_member) for r in episodes.with_members(made, manifest).collect()}
    assert found == {"e1": ("A.zip", "m1"), "e2": ("A.zip", "m2")}


def test_sheets_and_reports(spark, tmp_path):
    (tmp_path / "sites.csv").write_text('dataset,farm,note\nd1,F one,"a, ""b""\nc"\nd2,,\n')
    sheet = sheets.read_sheet(spark, f"{tmp_path}/sites.csv", ["dataset", "farm"])
    assert [tuple(r) for r in sheet.orderBy("dataset").collect()] == [("d1", "F one", 'a, "b"\nc'), ("d2", "", "")]
    with pytest.raises(schemas.SchemaError):
        sheets.read_sheet(spark, f"{tmp_path}/sites.csv", ["site_id"])
    (tmp_path / "r.json").write_text(json.dumps({"n": 2, "near": {"g": ["a", "b", "gone"], "h": ["c", "stale"], "i": []}}, indent=1))
    report = sheets.read_groups(spark, f"{tmp_path}/r.json", "near")
    assert sorted(map(tuple, report.collect())) == [("g", "a"), ("g", "b"), ("g", "gone"), ("h", "c"), ("h", "stale")]
    photos = spark.createDataFrame([("a",), ("b",), ("c",)], "image_uid string")
    assert sorted(map(tuple, lineage.reported_keys(report, photos).collect())) == [("a", "g"), ("b", "g")]
    assert sheets.read_groups(spark, f"{tmp_path}/r.json", "missing").count() == 0


def test_decoded_photographs(spark):
    def ppm(data):
        head, size, top, body = data.split(b"\n", 3)
        w, h = map(int, size.split())
        return np.frombuffer(body, np.uint8).reshape(h, w, 3)

    pixels = bytes(range(18))
    rows = [("a", b"P6\n3 2\n255\n" + pixels), ("b", b"broken"), ("c", None)]
    got = images.decoded(spark.createDataFrame(rows, "image_uid string, content binary"), ppm).orderBy("image_uid").collect()
    assert [tuple(r)[1:] for r in got] == [(pixels, 2, 3), (None, None, None), (None, None, None)]


def test_only_one_machine_makes_its_own_shared_folder():
    class Context:
        master = "spark://elsewhere:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: type("O", (), {"isDefined": lambda self: False})()})()})()

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": lambda self, key, default: default})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())
