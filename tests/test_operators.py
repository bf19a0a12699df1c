"""Golden values and invariants of planning, coverage, merge, records, audit and the mask codec."""

import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trackset.config import MODEL, MODEL_VERSION, Gate, Merge, Settings
from trackset.functions import geometry, rle
from trackset.operators import audit, combine, coverage, gate, planning, prompts, records, units
from trackset.streaming import tail

W, H = 64, 48
BOX = "vid string, fid long, tid long, xmin long, ymin long, xmax long, ymax long, generated long"


def one(spark, **columns):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in columns.items()))


def pair(spark, a, b):
    names = ("xmin", "ymin", "xmax", "ymax")
    schema = ", ".join(f"{p} struct<xmin:bigint,ymin:bigint,xmax:bigint,ymax:bigint>" for p in "ab")
    return spark.createDataFrame([(dict(zip(names, a)), dict(zip(names, b)))], schema)


def test_geometry(spark):
    df = pair(spark, (0, 0, 9, 9), (5, 0, 14, 9))
    row = df.select(geometry.iou("a.", "b.").alias("iou"), geometry.covered("a.", "b.").alias("c"), geometry.area("a.").alias("n")).first()
    assert (row.iou, row.c, row.n) == (50 / 150, 0.5, 100)
    inside = lambda a, b: pair(spark, a, b).select(geometry.contains("a.", "b.").alias("x")).first().x
    assert inside((0, 0, 59, 59), (10, 10, 19, 19)) and not inside((0, 0, 59, 59), (10, 10, 49, 49))
    assert not inside((0, 0, 59, 59), (58, 10, 65, 19)) and not inside((10, 10, 19, 19), (0, 0, 59, 59))
    touched = pair(spark, (0, 0, 63, 20), (5, 5, 10, 10)).select(geometry.edge_touches(W, H, 2, "a.").alias("n"), geometry.edge_touches(W, H, 2, "b.").alias("m")).first()
    assert (touched.n, touched.m) == (3, 0)


@given(st.lists(st.integers(0, 900), min_size=1, max_size=30))
def test_codec_round_trip(runs):
    assert rle.unpack(rle.pack(runs)) == runs


def test_codec_values():
    assert rle.pack([6, 3, 6, 3, 6]) == "6360" + "0" and rle.unpack("63600") == [6, 3, 6, 3, 6]
    rng = random.Random(1)
    for _ in range(200):
        bits = rng.getrandbits(300) & rng.getrandbits(300)
        spans = rle.intervals_of_bits(bits)
        assert rle.bits_of(spans) == bits and rle.intervals_of(rle.runs_of(spans, 300)) == spans
        assert sum(rle.runs_of(spans, 300)) == 300
    with pytest.raises(ValueError):
        rle.checked(rle.pack([3, 4]), 2, 2)


def thin(spark, fids, most):
    rows = spark.createDataFrame([("v", f, 1, 0.5 if f else 0.1) for f in fids], "vid string, fid long, tid long, max_iou double")
    found = planning.thinned(rows, most).orderBy("fid").collect()
    return [r.fid for r in found], [r.fid for r in found if r.is_ref]


def test_thinning(spark):
    assert thin(spark, [0, 3, 6, 9], 2) == ([0, 9], [0])
    assert thin(spark, [0, 3, 6, 9], 0) == ([0, 3, 6, 9], [0])
    # halves go to the even index
    assert thin(spark, range(0, 60, 10), 3) == ([0, 20, 50], [0])


def test_gap_fills():
    human = lambda fids: dict.fromkeys(fids, 0)
    fill = coverage.fill_object
    found = fill(0, 11, [0, 9], human([0, 3, 6, 9]), 4, False)
    assert sorted(found) == [(3, "human", 0, 0, 9), (6, "human", 0, 3, 9)]
    flagged = {0: 0, 30: 1, 60: 2, 90: 0}
    assert sorted(fill(0, 90, [0, 90], flagged, 40, False)) == [(30, "human", 1, 0, 90), (60, "human", 2, 30, 90)]
    lone = {f: None for f in range(100)} | {50: 0}
    assert fill(0, 99, [50], lone, 20, False) == []
    anchors = sorted([50, *(x[0] for x in fill(0, 99, [50], lone, 20, True))])
    assert max(b - a for a, b in zip([0, *anchors], [*anchors, 99])) <= 20
    assert fill(0, 9, [], lone, 2, True) == [] and fill(0, 9, [1], lone, 0, True) == []


def test_gap_fills_do_not_depend_on_order():
    """Largest gap first, as a loop over all gaps, gives the same anchors."""
    rng = random.Random(5)
    for _ in range(300):
        boxed = {f: rng.choice([None, 0, 1, 2]) for f in sorted(rng.sample(range(60), rng.randint(2, 50)))}
        lo, hi = min(boxed), max(boxed)
        kept = rng.sample(sorted(boxed), rng.randint(1, min(4, len(boxed))))
        most, any_box = rng.randint(1, 15), rng.random() < 0.5
        anchors, dead = set(kept), set()
        while True:
            points = [lo, *sorted(anchors), hi]
            open_ = sorted({(a, b) for a, b in zip(points, points[1:]) if b - a > most} - dead, key=lambda g: (g[0] - g[1], g))
            if not open_:
                break
            a, b = open_[0]
            pool = [f for f in boxed if (a < f or (f == a == lo and a not in anchors)) and (f < b or (f == b == hi and b not in anchors))]
            people = [f for f in pool if boxed[f] is not None]
            if not people and not (any_box and pool):
                dead.add((a, b))
                continue
            anchors.add(min(people or pool, key=lambda f: (boxed[f] or 0, abs(f - (a + b) / 2), f)))
        found = coverage.fill_object(lo, hi, kept, boxed, most, any_box)
        assert anchors == {*kept, *(x[0] for x in found)}


def tracked(spark, rows, width=W, height=H, extra=""):
    """Tracks of all boxes of rows (as BOX), over one segment of all frames."""
    raw = spark.createDataFrame(rows, BOX + extra).withColumn("ord", F.monotonically_increasing_id())
    of = raw.groupBy("vid").agg(F.min("fid").alias("seg_begin"), F.max("fid").alias("seg_end"), F.collect_set("tid").alias("tids"))
    return planning.tracks(raw, of.withColumn("width", F.lit(width).cast("long")).withColumn("height", F.lit(height).cast("long")), planning.MEASURES)


def test_tracks(spark):
    rows = [("v", 0, 1, 0, 0, 9, 9, 0), ("v", 0, 1, 5, 5, 6, 6, 0), ("v", 0, 2, 5, 0, 14, 9, 1), ("v", 3, 2, 0, 0, 3, 3, 0), ("w", 1, 1, 0, 0, 5, 5, 0)]
    raw = spark.createDataFrame(rows, BOX).coalesce(1).withColumn("ord", F.monotonically_increasing_id())
    clips = spark.createDataFrame([("v", 0, 2, [1, 2], W, H), ("w", 0, 5, [3], W, H)], "vid string, seg_begin long, seg_end long, tids array<long>, width long, height long")
    found = {(r.fid, r.tid): r for r in planning.tracks(raw, clips, planning.MEASURES).collect()}
    # the first box of an object in a frame counts, objects outside relations do not, spans are cut by the segment
    assert {k: (r.xmin, r.lo, r.hi) for k, r in found.items()} == {(0, 1): (0, 0, 0), (0, 2): (5, 0, 2), (3, 2): (0, 0, 2)}
    assert found[0, 1].max_iou == 50 / 150 and found[0, 1].overlap == 0.5 and found[3, 2].max_iou == 0.0 and found[0, 2].inners == []
    assert {r.tid for r in planning.in_span(planning.tracks(raw, clips)).collect()} == {1, 2}


def test_gate_flags_and_fallback(spark):
    rows = [("v", f, 1, 20, 10, 39, 29, 0) for f in range(0, 40, 10)]
    rows += [("v", 40, 1, 0, 10, 5, 20, 0), ("v", 10, 2, 20, 10, 39, 29, 1), ("v", 50, 1, 20, 10, 39, 29, 0)]
    boxes = tracked(spark, rows).withColumn("blur", F.when(F.col("fid") == 30, 5.0).otherwise(90.0))
    loose = Settings(gate=Gate(motion_most=9.0))
    flagged = gate.metrics(boxes, loose)
    found = {(r.tid, r.fid): r.flags for r in flagged.collect()}
    assert found == {(1, 0): [], (1, 10): ["overlap"], (1, 20): [], (1, 30): ["blur"], (1, 40): ["edge", "small"], (1, 50): [], (2, 10): None}
    all_bad = flagged.where("fid IN (10, 40) AND tid = 1")
    pick = lambda f: {r.fid for r in all_bad.withColumn("c", gate.candidate(f)).where("c").collect()}
    assert pick("least-flagged") == {10} and pick("refuse") == set()
    # a wider frame has its edge elsewhere
    right = [("v", 0, 1, 40, 10, 62, 20, 0)]
    edge = lambda w: gate.metrics(tracked(spark, right, width=w), loose).first().edge
    assert (edge(64), edge(96)) == (1, 0)


def test_container_prompts(spark):
    rows = [("v", f, 0, 0, 0, 59, 40, int(f not in (0, 5))) for f in (0, 2, 5, 8)]
    rows += [("v", f, 1, 10, 10, 19, 19, 0) for f in (0, 2, 5, 8)]
    boxes = tracked(spark, rows)
    schema = "vid string, fid long, tid long, is_ref boolean"
    anchors = spark.createDataFrame([("v", 0, 0, True), ("v", 5, 0, False), ("v", 2, 1, True), ("v", 8, 1, False), ("v", 5, 1, False)], schema)
    co = prompts.co_prompts(anchors, boxes)
    assert {(r.tid, r.fid, r.generated) for r in co.collect()} == {(0, 2, 1), (0, 8, 1)}
    every = anchors.select("vid", "fid", "tid").unionByName(co.select("vid", "fid", "tid"))
    clicks = prompts.negative_clicks(every, boxes)
    assert {(r.tid, r.fid, r.inner, r.x) for r in clicks.collect()} == {(0, f, 1, 14.5 / 64) for f in (0, 2, 5, 8)}
    order = prompts.schedule(anchors, co, clicks).orderBy("seq").collect()
    assert prompts.over_cap(prompts.schedule(anchors, co, clicks), most=2).count() == 4
    assert prompts.checked(prompts.schedule(anchors, co, clicks)).count() == 7
    with pytest.raises(Exception, match="too many points"):
        prompts.checked(prompts.schedule(anchors, co, clicks), most=2).collect()
    with pytest.raises(Exception, match="two references"):
        prompts.checked(prompts.schedule(anchors.withColumn("is_ref", F.lit(True)), co, clicks)).collect()
    totals = prompts.negatives_totals(co, clicks).first()
    assert (totals.negative_clicks, totals.co_prompts, totals.co_prompts_at_tracker_boxes) == (4, 2, 2)
    assert [(r.tid, r.fid, r.n_points) for r in order] == [(0, 0, 3), (1, 2, 2), (0, 2, 3), (0, 5, 3), (1, 5, 2), (0, 8, 3), (1, 8, 2)]


def test_co_prompts_pass_on_in_ascending_order_only(spark):
    sizes = {1: (10, 10, 13, 13), 2: (8, 8, 20, 20), 3: (0, 0, 40, 40)}
    for order, added in (((1, 2, 3), {2, 3}), ((2, 1, 3), {1, 3}), ((3, 2, 1), {2, 1})):
        boxes = tracked(spark, [("v", 0, t, *sizes[k], 0) for t, k in zip(order, (1, 2, 3))])
        everyone = [("v", 0, order[0], True)] + [("v", 9, t, True) for t in order[1:]]
        anchors = spark.createDataFrame(everyone, "vid string, fid long, tid long, is_ref boolean")
        found = {r.tid for r in prompts.co_prompts(anchors, boxes).collect()}
        assert found == added
    # a container that is added after its own turn does not pass the prompt on
    boxes = tracked(spark, [("v", 0, 3, *sizes[1], 0), ("v", 0, 1, *sizes[2], 0), ("v", 0, 2, 0, 0, 26, 26, 0)])
    anchors = spark.createDataFrame([("v", 0, 3, True), ("v", 9, 1, True), ("v", 9, 2, True)], "vid string, fid long, tid long, is_ref boolean")
    assert {r.tid for r in prompts.co_prompts(anchors, boxes).collect()} == {1, 2}


@pytest.mark.parametrize(
    "fa,ba,shared,reading,pref",
    [
        (0, 0, 0, "both_empty", None), (5, 0, 0, "forward_speck_only", None), (0, 5, 0, "backward_speck_only", None),
        (5, 7, 0, "both_speck", None), (400, 19, 0, "backward_speck", "forward"), (19, 400, 0, "forward_speck", "backward"),
        (400, 39, 0, "backward_speck", "forward"), (39, 400, 0, "forward_speck", "backward"), (400, 40, 40, "dispute", "dispute"),
        (400, 400, 185, "agree", "either"), (400, 400, 184, "dispute", "dispute"), (400, 0, 0, "forward_only", "forward"),
        (0, 400, 0, "backward_only", "backward"),
    ],
)
def test_readings(spark, fa, ba, shared, reading, pref):
    span = lambda n, at: [{"s": at, "e": at + n}] if n else None
    schema = "fwd array<struct<s:bigint,e:bigint>>, bwd array<struct<s:bigint,e:bigint>>"
    df = spark.createDataFrame([(span(fa, 0), span(ba, fa - shared))], schema)
    row = combine.readings(df, Merge()).first()
    assert (row.fa, row.ba, row.shared, row.reading, row.pref) == (fa, ba, shared, reading, pref)


NAN = float("nan")


@pytest.mark.parametrize(
    "rule,score,cf,cb,pick",
    [
        ("higher_score", 0.907, 0.95, 0.99, "backward"), ("higher_score", 0.907, 0.99, 0.95, "forward"),
        ("higher_score", 0.907, 0.93, 0.93, "forward"), ("higher_score", 0.907, 0.81, 0.86, None),
        ("higher_score", 0.907, None, 0.95, "backward"), ("higher_score", 0.907, NAN, 0.5, "backward"),
        ("higher_score", 0.907, 0.5, NAN, None), ("higher_score", 0.907, 0.95, NAN, "backward"),
        ("higher_score", 0.907, NAN, NAN, "backward"), ("forward_score", 0.9, 0.95, 0.1, "forward"),
        ("forward_score", 0.9, 0.85, 0.99, None), ("forward_score", 0.9, NAN, 0.99, None), ("refuse", None, 0.99, 0.99, None),
    ],
)
def test_tiebreaks(spark, rule, score, cf, cb, pick):
    df = spark.createDataFrame([("dispute", "dispute", cf, cb)], "reading string, pref string, fconf double, bconf double")
    strong = combine.tiebreaks(df, Merge(rule=rule, score=score)).first()
    weak = combine.tiebreaks(df, Merge(rule=rule, score=score, winner="weak")).first()
    assert strong.pick == weak.pick == pick and strong.pref == (pick or "dispute")
    assert weak.pref == {None: "dispute", "forward": "either", "backward": "weak_backward"}[pick]


def rect(y0, y1, x0, x1):
    return rle.bits_of((x * H + y0, x * H + y1) for x in range(x0, x1))


def obj(tid, pref, fwd=0, bwd=0, taken=False):
    return {"tid": tid, "pref": pref, "fwd": fwd, "bwd": bwd, "taken": taken}


def test_handover_conflict_and_fallback():
    body, arm = rect(0, 32, 0, 32), rect(0, 16, 32, 64)
    out = combine.decide_frame([obj(0, "either", body | arm, body | arm), obj(1, "backward", rect(0, 3, 0, 3), arm)], 20)
    assert (out[0]["before"], out[0]["after"], out[0]["to"]) == (1536, 1024, [1])
    assert out[1]["decision"] == "backward" and out[1]["mask"].bit_count() == 512 and not out[0]["mask"] & out[1]["mask"]
    out = combine.decide_frame([obj(0, "forward", body), obj(1, "backward", 0, rect(10, 20, 10, 20))], 20)
    assert all(o == {"decision": "refused", "reason": "passes_conflict"} for o in out.values())
    weak = obj(0, "either", rect(0, 20, 0, 10), rect(0, 4, 40, 45))
    out = combine.decide_frame([weak, obj(1, "forward", rect(0, 20, 0, 10) & ~rect(0, 19, 0, 1))], 20)
    assert out[0]["after"] == 19 and out[0]["decision"] == "backward" and out[0]["fallback"] and out[0]["mask"].bit_count() == 20
    blocked = obj(2, "forward", rect(0, 4, 44, 60))
    out = combine.decide_frame([weak, obj(1, "forward", rect(0, 20, 0, 10)), blocked], 20)
    assert out[0]["reason"] == "handed_over_speck" and out[0]["after"] == 0
    out = combine.decide_frame([weak | {"taken": True}, obj(1, "forward", rect(0, 20, 0, 10))], 20)
    assert out[0]["reason"] == "handed_over_speck"
    out = combine.decide_frame([obj(0, "weak_backward", 0, rect(0, 20, 0, 20), True), obj(1, "either", rect(0, 20, 0, 10))], 20)
    assert (out[0]["after"], out[0]["to"], out[1]["mask"].bit_count()) == (200, [1], 200)


def pair_by_pair(objects, floor):
    """The same decisions by looking at all pairs of objects in order, and taking shared pixels from one of the two."""
    out, live = {}, {}
    for o in objects:
        if o["pref"] == "dispute":
            out[o["tid"]] = ("refused", None, None)
        else:
            back = "backward" in o["pref"]
            live[o["tid"]] = [o["bwd"] if back else o["fwd"], o["pref"] in ("forward", "backward"), back, o]
    left, takers = {t: x[0] for t, x in live.items()}, {t: [] for t in live}
    clash = {t for t in live for u in live if t != u and live[t][1] and live[u][1] and live[t][0] & live[u][0]}
    for t in sorted(live):
        for u in sorted(live):
            if t < u and not (live[t][1] and live[u][1]):
                if live[t][1] != live[u][1]:
                    loser = u if live[t][1] else t
                elif live[t][2] != live[u][2]:
                    loser = t if live[t][2] else u
                else:
                    continue
                other = t + u - loser
                if left[loser] & left[other]:
                    left[loser] &= ~left[other]
                    takers[loser].append(other)
    for t, (_, _, back, o) in live.items():
        if t in clash:
            out[t] = ("refused", None, None)
        elif takers[t] and left[t].bit_count() < floor:
            free = not any(o["bwd"] & left[u] for u in live if u != t and u not in clash)
            out[t] = ("backward", o["bwd"], takers[t]) if o["bwd"] and free and not o["taken"] else ("refused", None, takers[t])
        else:
            out[t] = ("backward" if back else "forward", left[t], takers[t])
    return out


def test_frames_are_decided_as_pair_by_pair():
    rng = random.Random(3)
    prefs = ["forward", "backward", "either", "weak_backward", "either", "weak_backward", "dispute"]
    for n in range(2500):
        size = rng.choice((12, 60, 200))
        bits = lambda: rng.getrandbits(size) & (rng.getrandbits(size) if n % 3 else -1)
        objects = [obj(t, rng.choice(prefs), bits(), bits() if rng.random() < 0.8 else 0, rng.random() < 0.3) for t in rng.sample(range(9), rng.randint(0, 6))]
        found = combine.decide_frame(objects, 20)
        expected = pair_by_pair(objects, 20)
        assert {t: (d["decision"], d.get("mask"), d.get("to")) for t, d in found.items()} == expected


def test_unit_status_and_attempts(spark):
    rows = [("a", 1, False, True), ("b", 2, False, True), ("c", 1, False, False), ("d", 4, True, False), ("e", 5, True, False), ("f", 9, False, False)]
    errors = spark.createDataFrame(rows, "vid string, attempt long, interrupted boolean, cuda_oom boolean")
    every = spark.createDataFrame([(v,) for v in "abcdefg"], "vid string")
    found = {r.vid: (r.status, r.attempts) for r in records.unit_status(every, every.where("vid = 'f'"), errors, Settings()).collect()}
    assert found == {"a": ("pending", 1), "b": ("failed", 2), "c": ("failed", 1), "d": ("pending", 4), "e": ("failed", 5), "f": ("done", 0), "g": ("pending", 0)}
    events = spark.createDataFrame([("a", 1, "oom"), ("a", 2, "killed"), ("a", 3, "ok"), ("b", 1, "ok")], "vid string, nth long, event string")
    found = {r.vid: (r.attempts, r.oom, r.finished) for r in records.attempts(events).collect()}
    assert found == {"a": (2, True, True), "b": (0, False, True)}
    leases = spark.createDataFrame([(None, 0), ("me", 99), ("you", 31), ("you", 30)], "owner string, age long")
    assert [r.s for r in leases.select(records.lease_state(F.col("owner"), F.lit("me"), F.col("age")).alias("s")).collect()] == ["free", "mine", "stale", "held"]
    logits = spark.createDataFrame([(1.0,), (0.0,), (None,)], "x double").select(records.confidence(F.col("x")).alias("c")).collect()
    assert logits[0].c == 1.0 and logits[1].c == 0.5 and logits[2].c != logits[2].c


@pytest.mark.parametrize("n,k", [(10, 3), (7, 7), (5, 8), (1, 1)])
def test_shards_cover_every_unit(spark, n, k):
    rows = units.shard_order(spark.range(n).select(F.col("id").alias("vid")), k).collect()
    for shard in range(k):
        own = sorted((r.place, r.vid) for r in rows if r.shard == shard)
        assert [p for p, _ in own] == list(range(n)) and {v for _, v in own} == set(range(n))
        assert own[0][1] == (shard * -(-n // k)) % n  # one digit each, so text order is number order


def test_violations_come_in_order(spark):
    good = dict(
        vid="1", tid=0, fid=0, model=MODEL, checkpoint_hash="a" * 64, version=MODEL_VERSION, code_commit="c", created_at="t", tracker="none", prompt_mode="pvs_box_multianchor",
        policy="human", anchors=[2, 5], has_gap=False, negatives_ok=None, direction=None, has_merge=False, generated=0, split="val", reason=None, rle_h=4, rle_w=4, counts="x", confidence=0.5,
    )
    schema = (
        "vid string, tid long, fid long, model string, checkpoint_hash string, version string, code_commit string, created_at string, tracker string, "
        "prompt_mode string, policy string, anchors array<long>, has_gap boolean, negatives_ok boolean, direction string, has_merge boolean, generated long, split string, "
        "reason string, rle_h long, rle_w long, counts string, confidence double"
    )
    cases = [
        ({}, None), ({"confidence": NAN}, None), ({"vid": ""}, "vid is empty"), ({"tid": None, "model": ""}, "tid is not a number from 0"),
        ({"checkpoint_hash": "A" * 64}, "checkpoint_hash is no sha256"), ({"policy": "human_gap"}, "gap is missing"),
        ({"direction": "bidirectional"}, "merge is missing"), ({"direction": "bidirectional", "anchors": []}, None), ({"anchors": None}, "anchors are missing"), ({"anchors": [1, None]}, "anchors are missing"),
        ({"model": "x", "version": "y"}, "model is not the expected one"), ({"version": "y"}, "version is not the expected one"),
        ({"negatives_ok": False}, "contained negatives are malformed"),
        ({"counts": None, "confidence": None, "reason": "empty_mask"}, None), ({"counts": None, "confidence": None}, "reason is unknown"),
        ({"counts": None, "reason": "empty_mask"}, "a refusal has a confidence"), ({"confidence": 1.5}, "confidence is not in 0 to 1"),
        ({"confidence": None}, "a mask has no confidence"), ({"split": "train+val"}, "split is unknown"),
    ]
    df = spark.createDataFrame([tuple((good | c).values()) for c, _ in cases], schema)
    assert [r.v for r in df.select(audit.violation().alias("v")).collect()] == [v for _, v in cases]
    masks, refused = audit.split_tables(df)
    assert (masks.count(), refused.count()) == (3, 1)


def test_streaming_export(spark, tmp_path):
    schema = "vid string, tid long, fid long, reason string, arrived timestamp"
    rows = [("a", 1, f, None if f % 3 else "empty_mask") for f in range(9)]
    for part in (rows[:6], rows[3:]):
        spark.createDataFrame(part, "vid string, tid long, fid long, reason string").withColumn("arrived", F.current_timestamp()).coalesce(1).write.mode(
            "append"
        ).parquet(str(tmp_path / "in"))
        tail.export(tail.new_records(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/masks")).count() == 6 and spark.read.parquet(str(tmp_path / "out/refusals")).count() == 3
    totals = tail.progress(spark.read.parquet(str(tmp_path / "in"))).first()
    assert (totals.masks, totals.refusals) == (8, 4)


def test_large_masks_and_overlaps(spark):
    rng = random.Random(21)

    def mask(size):
        edges = sorted(rng.sample(range(size), 2 * rng.randint(0, 30)))
        return list(zip(edges[::2], edges[1::2]))

    rows = []
    for size in (100, 40_000, 900_000):
        for _ in range(15):
            a, b = mask(size), mask(size)
            bits = [sum(((1 << (e - s)) - 1) << s for s, e in m) for m in (a, b)]
            assert [rle.bits_of(a), rle.bits_of(b)] == bits and rle.intervals_of_bits(bits[0]) == a
            rows.append((a, b, (bits[0] & bits[1]).bit_count()))
    rows += [(None, rows[0][0], 0), (rows[0][0], None, 0), ([], [], 0)]
    kind = "array<struct<s:long,e:long>>"
    df = spark.createDataFrame(rows, f"a {kind}, b {kind}, shared long")
    found = df.select("shared", rle.overlap(F.col("a"), F.col("b")).alias("got")).collect()
    assert len(found) == len(rows) and all(r.shared == r.got for r in found)
