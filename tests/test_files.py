"""File sources, sinks and whole campaigns over the small data set."""

import json
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trackset.config import Gate, Merge, Roots, Settings, Stamps, code_commit
from trackset.functions import blur, rle
from trackset.operators import audit, correspondence, gate, prompts, units
from trackset.plans.campaign import Campaign
from trackset.sources import files, sinks
from trackset.sources.masks import MASKS, PluginSource, TableSource, blur_scores, frame_stats, payload_rows, propagation, video_checks

from . import dataset


@pytest.fixture(scope="module")
def roots(tmp_path_factory):
    relations, annotations = dataset.write(tmp_path_factory.mktemp("data"))
    return Roots(relations=relations, annotations=annotations)


@pytest.fixture(scope="module")
def campaign(spark, roots, tmp_path_factory):
    return Campaign(spark, roots, Settings(max_gap=0), str(tmp_path_factory.mktemp("out")))


def test_roots_fall_back_one_by_one():
    found = Roots.of({"relations": "given"}, {"TRACKSET_VIDEOS": "from env", "TRACKSET_RELATIONS": "not this"})
    assert found == Roots(relations="given", videos="from env")


def test_scans(spark, roots):
    rows = files.relations(spark, roots.relations)
    assert {(r.split, r.n) for r in rows.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()} == {("train", 2), ("val", 2), ("test", 17)}
    assert files.annotation_index(spark, roots.annotations).count() == 5
    boxes = files.boxes(files.annotations(spark, roots.annotations))
    twice = sum(r[:2] == (1, 1) for rows in dataset.boxes().values() for r in rows)
    assert boxes.count() == sum(map(len, dataset.boxes().values())) + twice
    with pytest.raises(FileNotFoundError):
        files.relations(spark, roots.relations, ("other",))


def test_worklist_is_written_checked_and_versioned(spark, campaign):
    found = {r.scope: (r.records, r.videos, r.pairs) for r in units.known_counts(campaign.relations).collect()}
    assert found == {"all": (21, 4, 25), "train": (2, 1, 3), "val": (2, 2, 4), "test": (17, 1, 18)}
    assert all(r.ok for r in campaign.doctor().collect())
    with pytest.raises(ValueError, match="differ"):
        campaign.build_worklist({"records": 20})
    assert not os.path.exists(f"{campaign.out}/worklist.json")
    assert campaign.build_worklist({"records": 21, "videos": 4}, limit=1).count() == 1
    campaign.build_worklist({"records": 21, "videos": 4})
    rows = {r.vid: r for r in campaign.worklist().collect()}
    walk = rows[dataset.WALK]
    # categories may name more objects than take part, and the frames are the video's
    assert (walk.n_tids, len(walk.cats), walk.n_frames, walk.seg_begin, walk.seg_end) == (3, 4, 15, 0, 14)
    assert [tuple(r) for r in walk.relations] == [(0, "lead", 1), (0, "walk-by,near", 5)]
    assert [(r.s, r.p, r.o) for r in units.relation_rows(campaign.worklist()).where("vid = '501'").orderBy("nth").collect()] == [(0, "lead", 1), (0, "walk-by,near", 5)]
    facts = json.load(open(f"{campaign.out}/worklist.json"))
    assert facts["counts"]["too_many_objects"] == 1 and facts["counts"]["prop_frame_objects"] == 15 * 3 + 10 * 2 + 6 * 18 + 6 * 2
    sinks.manifest(spark, f"{campaign.out}/worklist.json", facts | {"version": "older"})
    with pytest.raises(ValueError, match="version"):
        campaign.worklist()
    sinks.manifest(spark, f"{campaign.out}/worklist.json", facts)


def test_videos_without_an_annotation_are_an_error(spark, roots, tmp_path):
    c = Campaign(spark, roots, Settings(), str(tmp_path))
    c.videos = c.videos.where("vid <> '502'")
    with pytest.raises(ValueError, match="502"):
        c.build_worklist()
    assert not os.listdir(tmp_path)


def test_plans_follow_each_video(campaign):
    plan = campaign.plan
    of = lambda df, vid=dataset.WALK: df.where(F.col("vid") == vid)
    assert {(r.tid, r.lo, r.hi) for r in of(plan.spans).collect()} == {(0, 0, 14), (1, 3, 14), (5, 0, 14)}
    anchors = of(campaign.anchors()).collect()
    assert {(r.tid, r.fid) for r in anchors} == {(0, 0), (0, 5), (0, 10), (1, 4), (1, 9), (1, 14)}
    assert {(r.tid, r.fid) for r in anchors if r.is_ref} == {(0, 10), (1, 4)}
    assert [(r.tid, r.reason) for r in of(plan.refused).collect()] == [(5, "no_human_keyframe")]
    sent = prompts.prompts(campaign.anchors(), plan.boxes)
    assert of(sent).where("tid = 1").orderBy("seq").first().box == [50 / 96, 20 / 60, 80 / 96, 50 / 60]
    assert of(sent, dataset.CARRY).where("tid = 1").orderBy("seq").first().box == [10 / 64, 10 / 80, 20 / 64, 20 / 80]
    (click,) = prompts.negative_clicks(of(campaign.anchors(), dataset.CARRY).where("tid = 0 AND fid = 2"), plan.boxes).collect()
    assert (click.inner, click.x, click.y) == (1, 15 / 64, 15 / 80)
    edges = {r.vid: r.edge for r in gate.metrics(plan.boxes, campaign.settings).where("tid = 0 AND fid = 0").collect()}
    assert edges[dataset.WALK] == 0 and edges[dataset.CROWD] == 2
    lines = {(r.vid, r.tid): r.line for r in campaign.plan_lines().collect()}
    assert lines[dataset.WALK, 0] == "tid 0 (kind0/sub): frames 0 to 14; 3 anchors, reference 10"
    assert lines[dataset.WALK, 5].endswith("refused, no_human_keyframe")


def _counts(vid, box):
    width, height, _ = dataset.SIZES[vid]
    x0, y0, x1, y1 = box
    return rle.pack(rle.runs_of([(x * height + y0, x * height + y1 + 1) for x in range(x0, x1 + 1)], width * height))


def _masks(spark, fids):
    rows = [
        (vid, f, t, _counts(vid, (34, 20, 55, 40) if t else (0, 0, 20, 15)), 0.9375)
        for vid in (dataset.WALK, dataset.CARRY)
        for f in fids
        for t in (0, 1, 5)
    ]
    return spark.createDataFrame(rows, MASKS)


@pytest.fixture(scope="module")
def source(spark):
    return TableSource(forward=_masks(spark, range(0, 14)), backward=_masks(spark, range(1, 15)))


@pytest.fixture(scope="module")
def clips(campaign):
    vid = F.col("vid")
    why = F.when(vid == dataset.CROWD, "too_many_objects").when(vid == dataset.BEHIND, "video_missing")
    return campaign.relations.select("vid").distinct().select("vid", why.alias("clip_reason"))


def test_process_write_export_and_status(spark, campaign, source, clips):
    campaign.build_worklist()
    done = campaign.process(source, clips).checkpoint()
    why = {r.reason: r["count"] for r in done.groupBy("reason").count().collect()}
    assert why == {None: 47, "no_human_keyframe": 15, "too_many_objects": 108, "video_missing": 12}
    walk = done.where((F.col("vid") == dataset.WALK) & F.col("reason").isNull())
    assert {(r.source, r["count"]) for r in walk.groupBy("source").count().collect()} == {("forward", 25), ("backward", 2)}
    assert campaign.write(done, Stamps("a" * 64, "c0de", "2020-01-01T00:00:00Z")) == 182
    assert campaign.write(done.where("vid = '502'"), Stamps("b" * 64, "c0de", "2020-01-02T00:00:00Z")) == 20
    flat = campaign.records()
    assert flat.count() == 182 and flat.where(audit.violation().isNotNull()).count() == 0
    row = flat.where("vid = '501' AND tid = 0 AND fid = 5").first()
    assert json.loads(row.payload) == {
        "anchor_fids": [0, 5, 10], "anchor_policy": "human_gap", "direction": "bidirectional", "ref_anchor_fid": 10,
        "gap": {"max_gap": 0, "gap_fill": "human", "n_fills": 0}, "merge": {"decision": "forward", "reason": None},
    }
    assert rle.unpack(row.counts) == rle.unpack(_counts("501", (0, 0, 20, 15))) and (row.rle_h, row.rle_w) == (60, 96)
    runs = spark.createDataFrame([("501", 100.04, 7.123), ("502", 260.0, 9.0)], "vid string, wall_s double, vram_gb double")
    state = campaign.status(clips, runs=runs)
    ledger = {r.vid: r for r in state["ledger"].collect()}
    assert (ledger["501"].masks, ledger["501"].refusals, ledger["501"].wall_s, ledger["501"].vram_gb) == (27, 15, 100.0, 7.12)
    assert {r.status: (r.clips, r.masks) for r in state["status"].collect()} == {"done": (4, 47)}
    assert state["costs"].first().hours == 0.1
    facts = campaign.export(flat, state["ledger"])
    assert facts["ok"] and facts["by_split"]["val"]["checkpoint_hashs"] == f"{'a' * 64},{'b' * 64}" and facts["vram_gb"] == 9.0
    assert json.load(open(f"{campaign.out}/export/manifest.json"))["refusals"] == facts["refusals"]
    assert spark.read.parquet(f"{campaign.out}/export/masks").count() == 47
    rest = campaign.process(source, clips, done=done.where("vid <> '502'"))
    assert {r.vid for r in rest.select("vid").distinct().collect()} == {"502"}
    one = campaign.process_one(source, "502", clips)
    assert {(r.vid, r["count"]) for r in one.groupBy("vid").count().collect()} == {("502", 20)}


def test_export_leaves_invalid_records_out_and_reports_the_rest(spark, campaign, source, clips):
    done = campaign.process(source, clips)
    campaign.write(done, Stamps("a" * 64, "c0de", "2020-01-01T00:00:00Z"))
    flat = campaign.records()
    at = lambda t, f: (F.col("vid") == "502") & (F.col("tid") == t) & (F.col("fid") == f)
    bad = flat.where(~at(0, 1)).unionByName(flat.where(at(0, 2)))  # one missing, one twice
    bad = bad.withColumn("counts", F.when(at(0, 3), F.lit("xyz~")).otherwise(F.col("counts")))  # cannot be read
    bad = bad.withColumn("rle_h", F.when(at(0, 4), 64).otherwise(F.col("rle_h"))).withColumn("rle_w", F.when(at(0, 4), 80).otherwise(F.col("rle_w")))
    bad = bad.withColumn("model", F.when(at(0, 5), "other").otherwise(F.col("model")))  # invalid
    bad = bad.withColumn("fid", F.when(at(0, 6), 99).otherwise(F.col("fid")))
    facts = campaign.export(bad)
    assert not facts["ok"]
    # the invalid one and the two that are not there count as missing
    assert facts["problems"] == {"invalid": 1, "repeated": 1, "undecodable": 1, "size": 1, "missing": 3, "extra": 1}
    assert {x["detail"] for x in facts["listed"] if x["kind"] == "invalid"} == {"model is not the expected one"}
    kept = spark.read.parquet(f"{campaign.out}/export/masks").where("vid = '502' AND tid = 0")
    assert 5 not in {r.fid for r in kept.collect()} and kept.where("fid = 3").count() == 1


def test_single_passes(spark, roots, source, clips, tmp_path):
    c = Campaign(spark, roots, Settings(max_gap=0, direction="forward"), str(tmp_path))
    rows = c.process(source, clips).checkpoint()
    why = {(r.vid, r.reason): r["count"] for r in rows.where("vid < '503'").groupBy("vid", "reason").count().collect()}
    # the pass ends before the last frame
    assert why == {("501", None): 25, ("501", "not_tracked"): 2, ("501", "no_human_keyframe"): 15, ("502", None): 20}
    assert {r.source for r in rows.where("reason IS NULL").collect()} == {"forward"}
    c.write(rows, Stamps("a" * 64, "c0de", "now"))
    flat = c.records()
    assert flat.where(audit.violation().isNotNull()).count() == 0
    assert "direction" not in json.loads(flat.where("reason IS NULL").first().payload)


def test_the_gate_as_a_policy(spark, roots, tmp_path):
    strict = Gate(motion_most=-1.0)  # whatever moves, or not, is flagged
    c = Campaign(spark, roots, Settings(max_gap=0, policy="hq", fallback="refuse", gate=strict), str(tmp_path))
    why = {(r.vid, r.tid): r.reason for r in c.refused().where("vid = '501'").collect()}
    assert why == {("501", 0): "no_hq_anchor", ("501", 1): "no_hq_anchor", ("501", 5): "no_human_keyframe"}
    assert c.anchors().where("vid = '501'").count() == 0
    c = Campaign(spark, roots, Settings(max_gap=0, policy="hq"), str(tmp_path))
    assert {r.reason for r in c.refused().collect()} == {"no_human_keyframe"}
    assert c.anchors().where("vid = '501' AND tid = 1").count() >= 1


def test_correspondence_is_written(spark, campaign, source, clips):
    lines = [
        {"vid": "501", "subject_tid": 0, "predicate": "lead", "object_tid": 1, "text": "old", "spans": {}},
        {"vid": "501", "subject_tid": 0, "predicate": "lead", "object_tid": 1, "text": "the guide leads a dog", "spans": {"0": [[0, 9]], "1": [[16, 21]]}},
        {"vid": "501", "subject_tid": 0, "predicate": "walk-by,near", "object_tid": 5, "text": "the guide passes", "spans": {"0": [[0, 9]]}},
        {"vid": "503", "subject_tid": 0, "predicate": "beside", "object_tid": 1, "text": "x", "spans": {}},
        {"vid": "502", "subject_tid": 0, "predicate": "carry", "object_tid": 1, "text": "", "spans": {}},
    ]
    path = f"{campaign.out}/captions.jsonl"
    with open(path, "w") as f:
        f.write("\n\n".join(map(json.dumps, lines)))
    captions = files.captions(spark, path)
    processed = campaign.process(source, clips).checkpoint()
    facts = campaign.correspondence(processed, captions)
    to = f"{campaign.out}/correspondence"
    assert json.load(open(f"{to}/manifest.json")) == facts
    assert facts["problems"] == ["set:val:502:0-carry-1: text is empty"] and not facts["ok"]
    assert (facts["relations"], facts["relations_with_caption"], facts["records_written"]) == (21, 4, 3)
    assert facts["dispositions"] == {"complete_bcc": 1, "incomplete_context": 1, "missing_main_referent": 1}
    table = lambda name: spark.read.parquet(f"{to}/{name}")
    links = {(r.sample_id, r.span_start, r.span_end, r.span_text, r.tracklet_ids_json) for r in table("links").collect()}
    lead, near = "set:train:501:0-lead-1", "set:train:501:0-walk-by,near-5"
    assert links == {(lead, 0, 9, "the guide", '["vidor-0"]'), (lead, 16, 21, "a dog", '["vidor-1"]'), (near, 0, 9, "the guide", '["vidor-0"]')}
    assert {(r.sample_id, r.tracklet_count, r.frame_count) for r in table("samples").collect()} == {(lead, 2, 15), (near, 1, 15), ("set:test:503:0-beside-1", 0, 6)}
    assert table("verification").count() == 3 and table("tracklets").count() == facts["tracklet_rows"] == 2 * 21
    tracks = table("tracklets").where("p = 'lead'").orderBy("tid").collect()
    assert [(r.tid, r.role, r.present, r.mean_confidence) for r in tracks] == [(0, "main_referent", 15, 0.9375), (1, "context_entity", 12, 0.9375)]
    record = spark.read.json(f"{to}/records").where("p = 'lead'").first()
    first = record.tracklets[1]
    assert [m is not None for m in first.masks] == [f >= 3 for f in range(15)] and sum(first.masks[3].counts) == 60 * 96
    assert record.frame_files[0] == "501/000000.jpg" and record.span_links[1].tracklet_ids == ["vidor-1"]
    samples = correspondence.samples(units.triples(campaign.relations).drop("ord"), correspondence.tracklets(processed, campaign.plan.segments), captions)
    assert {(r.vid, r.p): r.valid for r in samples.where("disposition <> ''").collect()} == {
        ("501", "lead"): True, ("501", "walk-by,near"): True, ("503", "beside"): True, ("502", "carry"): False,
    }


def test_requeue(spark, campaign, source, clips):
    campaign.build_worklist()
    vid = F.col("vid")
    dark = clips.select("vid", F.when(vid == "502", "decode_black").otherwise(F.col("clip_reason")).alias("clip_reason"))
    campaign.write(campaign.process(source, dark), Stamps("a" * 64, "c0de", "now"))
    ledger = campaign.status(dark)["ledger"]
    copies = spark.createDataFrame([("501", "copy/501"), ("502", "copy/502")], "vid string, path string")
    assert [tuple(r) for r in campaign.requeue(ledger, copies).collect()] == [("502", "copy/502")]
    assert campaign.records().where("vid = '502'").count() == 0
    assert {r.vid: r.status for r in campaign.status(dark)["ledger"].collect()}["502"] == "pending"
    assert spark.read.json(f"{campaign.out}/superseded").count() == 20


def _each(direction, batches):
    for batch in batches:
        n = batch.num_rows
        if "503" in batch.column("vid").to_pylist():
            raise MemoryError("CUDA out of memory on this video")
        yield pa.RecordBatch.from_arrays(
            [batch.column("vid"), batch.column("fid"), batch.column("tid"), pa.array([direction] * n), pa.array([1.0] * n)],
            ["vid", "fid", "tid", "counts", "conf"],
        )


def test_plugin_sources_see_each_video_and_fail_alone(spark, campaign):
    schedule = campaign.schedule()
    masks = PluginSource(_each).masks(schedule, "backward")
    assert masks.count() == schedule.where("vid <> '503'").count() and masks.first().counts == "backward"
    (failed,) = PluginSource(_each).errors(schedule, "backward").collect()
    assert (failed.vid, failed.error_type, failed.cuda_oom) == ("503", "MemoryError", True)
    spans = spark.createDataFrame([("v", 3, 9)], "vid string, lo long, hi long")
    assert [tuple(r) for d in ("forward", "backward") for r in propagation(spans, d).collect()] == [("v", 3, 7), ("v", 9, 7)]


def test_payloads_and_decoded_frames(spark):
    mask = np.zeros((1, 4, 3), bool)
    mask[0, 1:3, 1] = True
    rows = payload_rows({"out_obj_ids": [7, 9], "out_binary_masks": [mask, mask[0]], "out_probs": [0.5]})
    assert [(t, rle.unpack(c)) for t, c, _ in rows] == [(7, [5, 2, 5]), (9, [5, 2, 5])] and rows[0][2] == 0.5 and rows[1][2] != rows[1][2]
    assert payload_rows(None) == [] and payload_rows({"other": 1}) == []
    rng = np.random.default_rng(1)
    image = rng.integers(0, 255, (6, 7)).astype("u1")

    def plain(crop):
        h, w = crop.shape
        at = lambda y, x: float(crop[min(max(-y if y < 0 else 2 * h - 2 - y if y >= h else y, 0), h - 1), min(max(-x if x < 0 else 2 * w - 2 - x if x >= w else x, 0), w - 1)])
        values = [at(y - 1, x) + at(y + 1, x) + at(y, x - 1) + at(y, x + 1) - 4 * at(y, x) for y in range(h) for x in range(w)]
        mean = sum(values) / len(values)
        return sum((v - mean) ** 2 for v in values) / len(values)

    assert blur.sharpness(image, 1, 1, 4, 5) == pytest.approx(plain(image[1:6, 1:5]))
    assert blur.sharpness(image, -3, 4, 2, 99) == pytest.approx(plain(image[4:, :3])) and blur.sharpness(image, 0, 0, 0, 9) == pytest.approx(plain(image[:, :1]))
    assert blur.sharpness(image, 0, 0, 1, 0) == 0.0 and blur.sharpness(image, 50, 50, 60, 60) == 0.0
    frames = spark.createDataFrame([("v", f, 6, 7, bytearray(image.tobytes() if f else bytes(42))) for f in range(3)], "vid string, fid long, height long, width long, grey binary")
    box = spark.createDataFrame([("v", 1, 0, 1, 1, 4, 5)], "vid string, fid long, tid long, xmin long, ymin long, xmax long, ymax long")
    assert blur_scores(frames, box).first().blur == pytest.approx(plain(image[1:6, 1:5]))
    videos = spark.createDataFrame([("v", 3, 7, 6), ("w", 3, 7, 6), ("x", 3, 7, 6)], "vid string, frame_count long, width long, height long")
    more = frames.unionByName(spark.createDataFrame([("x", 0, 6, 8, bytearray(48))], frames.schema))
    found = {r.vid: (r.has_video, r.count_ok, r.size_ok, r.black) for r in video_checks(frame_stats(more), videos).collect()}
    assert found == {"v": (True, True, True, False), "w": (False, None, None, False), "x": (True, False, False, True)}


def test_a_swap_that_fails_keeps_the_old(spark, tmp_path, monkeypatch):
    df = spark.range(3)
    sinks.parquet(df, str(tmp_path / "t"))

    class Broken:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            return False if "part-" in a.toString() else self.fs.rename(a, b)

    plain = sinks._fs
    monkeypatch.setattr(sinks, "_fs", lambda s, p: (plain(s, p)[0], Broken(plain(s, p)[1])))
    with pytest.raises(OSError):
        sinks.parquet(spark.range(5), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    (staged,) = [p for p in os.listdir(tmp_path) if "part-" in p]  # and the new is not lost either
    assert spark.read.parquet(str(tmp_path / staged)).count() == 5


def test_stamps():
    now = Stamps.now("d" * 64)
    assert now.checkpoint_hash == "d" * 64 and now.code_commit and now.created_at.endswith("+00:00")
    assert code_commit("/") == "no-checkout"


def test_lists_errors_and_paths(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("# all of them\n\n12 first\n  34\n")
    assert [r.vid for r in files.id_list(spark, str(tmp_path / "ids.txt")).collect()] == ["12", "34"]
    (tmp_path / "errors").mkdir()
    (tmp_path / "errors" / "7.json").write_text('{"vid": "7", "attempt": 2, "error_type": "OOM", "cuda_oom": true}')
    (tmp_path / "errors" / "8.json").write_text("not json")
    found = {r.vid: (r.attempt, r.error_type, r.cuda_oom) for r in files.errors(spark, str(tmp_path / "errors")).collect()}
    assert found == {"7": (2, "OOM", True), "8": (1, "unreadable", False)}
    df = spark.createDataFrame([("/old/a/b.mp4",)], "path string")
    assert df.select(files.rebased(F.col("path"), "/old", "/new/").alias("p")).first().p == "/new/a/b.mp4"
    with pytest.raises(Exception, match="not below"):
        df.select(files.rebased(F.col("path"), "/other", "/new").alias("p")).collect()
    notes = spark.createDataFrame([("v", "00/v.mp4"), ("w", "00/w.mp4"), ("x", "00/x.mp4")], "vid string, video_path string")
    listing = lambda rows: spark.createDataFrame(rows, "video_path string, path string")
    found = files.videos(notes, listing([("00/v.mp4", "T/v")]), listing([("00/v.mp4", "R/v"), ("00/w.mp4", "R/w")]))
    assert {r.vid: r.path for r in found.collect()} == {"v": "T/v", "w": "R/w", "x": None}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, None), ("b", None, "x")], "vid string, n long, note string")
    for _ in range(2):
        sinks.parquet(df, str(tmp_path / "t"))
        sinks.csv(df, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    assert not [p for p in os.listdir(tmp_path) if "part" in p]
    assert (next((tmp_path / "c").glob("*.csv"))).read_text().splitlines() == ["vid,n,note", "a,1,", "b,,x"]
    assert sinks.json_lines(df, str(tmp_path / "j")) == 2
    # only the videos that are written are replaced
    assert sinks.json_lines(df.where("vid = 'b'"), str(tmp_path / "j")) == 1 and sinks.json_lines(df.where("false"), str(tmp_path / "j")) == 0
    assert json.loads(next((tmp_path / "j" / "vid=a").glob("*.json")).read_text()) == {"n": 1, "note": None}
    sinks.manifest(spark, str(tmp_path / "m.json"), {"b": 1, "a": [1]})
    assert (tmp_path / "m.json").read_text() == '{\n "a": [\n  1\n ],\n "b": 1\n}'
    rows = spark.createDataFrame([([1, 2], "forward"), ([3], "bidirectional")], "anchors array<long>, d string")
    text = sinks.payload(F.col("anchors"), F.lit(None).cast("long"), F.lit("human"), F.col("d")).alias("p")
    assert [r.p for r in rows.select(text).collect()] == [
        '{"anchor_fids":[1,2],"anchor_policy":"human","ref_anchor_fid":null}',
        '{"anchor_fids":[3],"anchor_policy":"human","direction":"bidirectional","ref_anchor_fid":null}',
    ]


def test_black_videos(spark):
    rows = [("dark", f, 1.0) for f in range(40)] + [("lit", f, 1.0 if f else 9.0) for f in range(40)]
    df = spark.createDataFrame(rows, "vid string, fid long, mean double")
    assert {r.vid: r.black for r in files.black(df, F.lit(40)).collect()} == {"dark": True, "lit": False}


def test_settings_are_checked():
    for bad in ({"rule": "refuse"}, {"score": None}, {"rule": "other"}, {"winner": "none"}):
        with pytest.raises(ValueError):
            Merge(**bad)
    assert Merge(rule="refuse", score=None).winner == "strong"
    for bad in ({"max_anchors": 1}, {"gap_fill": "none"}, {"policy": "x"}, {"direction": "up"}):
        with pytest.raises(ValueError):
            Settings(**bad)
