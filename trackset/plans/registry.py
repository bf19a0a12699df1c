"""Every query by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackset import config, scratch
from trackset.functions import geometry, rle
from trackset.operators import audit, combine, correspondence, coverage, gate, planning, prompts, records, units
from trackset.plans.oracle import sql
from trackset.sources import proxy

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
S = proxy.SETTINGS


class Tables:
    """The proxy tables of one folder and what is planned from them, each put together when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.raw = proxy.raw_boxes(spark, sf_dir)
        self.relations = proxy.relations(spark, sf_dir)
        self.videos = proxy.videos(spark, sf_dir)
        self.plan = planning.Plan(self.raw, self.relations, self.videos, S)

    @cached_property
    def units(self) -> DataFrame:
        return units.units(self.relations, self.videos)

    @cached_property
    def known(self) -> DataFrame:
        """The units, written, for what reads them more than once."""
        return scratch.written(self.units, "units")

    @cached_property
    def anchors(self) -> DataFrame:
        """Anchors, written, over shared tracks."""
        return scratch.written(self.plan.shared().human, "anchors")

    @property
    def refused(self) -> DataFrame:
        return self.plan.refused

    def passes(self, *also: str) -> DataFrame:
        """Both passes' masks of the planned objects' frames, and the seeds named in `also`."""
        plan = self.plan.shared()
        planned = plan.records.join(plan.refused, ["vid", "tid"], "left_anti")
        # dealt out by video before the masks are made, which are much larger than what they are made from
        return proxy.mask_passes(combine.paired(planned, proxy.mask_seeds(plan.boxes)).repartition("vid"), also)

    @property
    def paired(self) -> DataFrame:
        return self.passes()

    @property
    def readings(self) -> DataFrame:
        return combine.readings(self.paired, S.merge)

    @property
    def settled(self) -> DataFrame:
        return combine.tiebreaks(self.readings, S.merge)

    @property
    def decided(self) -> DataFrame:
        return combine.decisions(self.settled, S.merge, want_masks=False)

    @property
    def clips(self) -> DataFrame:
        vid = F.col("vid")
        seen = self.known.select(
            "vid",
            "n_tids",
            (vid % 10 != 0).alias("has_video"),
            (vid % 13 != 1).alias("count_ok"),
            (vid % 17 != 2).alias("size_ok"),
            (vid % 19 == 3).alias("black"),
        )
        return records.clip_reasons(seen, S)

    @property
    def records(self) -> DataFrame:
        return records.merged_records(self.plan.shared().records, self.refused, self.decided, self.clips)

    @property
    def status(self) -> DataFrame:
        vid = F.col("vid")
        errors = self.known.where("vid % 7 IN (4, 5)").select(
            "vid", (vid % 6).alias("attempt"), (vid % 5 == 0).alias("interrupted"), (vid % 3 == 0).alias("cuda_oom")
        )
        return records.unit_status(self.known, self.known.where("vid % 7 < 4"), errors, S)

    @property
    def ledger(self) -> DataFrame:
        return records.ledger(self.known, self.status, records.run_totals(self.records), self.clips)

    @property
    def written(self) -> DataFrame:
        """Records with faults: some lost, some twice, some of frames that don't exist."""
        k, fid = F.expr("vid + tid + fid"), F.col("fid")
        kept = k % 101 != 0
        fids = F.array(F.when(kept, fid), F.when(kept & (k % 103 == 0), fid), F.when(k % 107 == 0, fid + 200))
        return self.records.select("vid", "tid", F.explode(F.array_compact(fids)).alias("fid"))

    @property
    def tracklets(self) -> DataFrame:
        return correspondence.tracklets(self.records, self.plan.segments)

    @property
    def captions(self) -> DataFrame:
        key = F.expr("vid + 3 * s + 5 * o") % 4
        s, o = F.concat(F.lit("obj"), F.col("s").cast("string")), F.concat(F.lit("obj"), F.col("o").cast("string"))
        text = F.concat(s, F.lit(" "), "p", F.lit(" "), o)
        span = lambda test, a, b: F.when(test, F.array(F.struct(a.alias("start"), b.alias("end"))))
        at = F.length(text) - F.length(o)
        return units.triples(self.relations).where(key != 0).select(
            "vid",
            "s",
            "p",
            "o",
            F.when(key != 1, text).alias("text"),
            span(F.expr("(vid + s + o) % 3 <> 0"), F.lit(0), F.length(s)).alias("s_spans"),
            span(F.expr("(vid + 2 * s + o) % 3 <> 1"), at, F.length(text)).alias("o_spans"),
        )

    @property
    def samples(self) -> DataFrame:
        return correspondence.samples(units.triples(self.relations).drop("ord"), self.tracklets, self.captions)


def query(oracle: str | None = None, *needs: str, recursive: str = ""):
    """Register a function of Tables under its name, with its SQL."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if oracle is not None:
            ORACLE_SQL[f.__name__] = sql(oracle, *needs, recursive=recursive)
        return f

    return register


BOX = "vid, fid, tid, xmin, ymin, xmax, ymax, generated, tracker"


@query(f"SELECT {BOX} FROM all_boxes", "all_boxes")
def q_boxes_dedup(t):
    return units.first_boxes(t.raw).select(*BOX.split(", "))


@query("SELECT * FROM units", "units")
def q_units(t):
    return units.as_text(t.units)


@query(
    """SELECT count(*) AS units, count(*) FILTER (vid % 10 = 0) AS video_missing, count(*) FILTER (n_tids > 6) AS
too_many_objects, CAST(sum(n_tids) AS BIGINT) AS relation_tids, CAST(sum(n_frames) AS BIGINT) AS frames,
CAST(sum((seg_end - seg_begin + 1) * n_tids) AS BIGINT) AS prop_frame_objects FROM units""",
    "units",
)
def q_unit_counts(t):
    return units.unit_counts(t.known, t.known.where("vid % 10 = 0"), S)


@query("SELECT split, count(*) AS units FROM units GROUP BY split", "units")
def q_units_by_split(t):
    return units.by_split(t.units)


@query(
    """SELECT coalesce(split, 'all') AS scope, count(*) // 2 AS records, count(DISTINCT vid) AS videos,
count(DISTINCT (vid, tid)) AS pairs
FROM (SELECT split, vid, s AS tid FROM rel UNION ALL SELECT split, vid, o FROM rel) GROUP BY ROLLUP (split)""",
    "rel",
)
def q_known_counts(t):
    return units.known_counts(t.relations)


@query("SELECT vid, tid, category FROM cats", "cats")
def q_categories(t):
    return units.categories(t.relations)


@query("SELECT vid, s, p, o FROM triples", "triples")
def q_relation_triples(t):
    return units.triples(t.relations).drop("ord")


@query(
    """SELECT vid, row_number() OVER (PARTITION BY vid ORDER BY ord) - 1 AS nth, s, p, o FROM triples""",
    "triples",
)
def q_relation_rows(t):
    return units.relation_rows(t.units)


@query(
    """SELECT shard, (nth - 1 - (shard * ((n + 7) // 8)) % n + n) % n AS place, vid FROM (
  SELECT vid, row_number() OVER (ORDER BY CAST(vid AS VARCHAR)) AS nth, count(*) OVER () AS n FROM units),
  (SELECT unnest(range(8)) AS shard)""",
    "units",
)
def q_shard_order(t):
    return units.shard_order(t.units, 8)


@query(
    """SELECT nth, w.vid, u.vid IS NOT NULL AS known FROM (
  SELECT nth, (nth * 7919) % 1500 + 1 AS vid FROM (SELECT unnest(range(200)) AS nth)) w LEFT JOIN units u USING (vid)""",
    "units",
)
def q_selected_units(t):
    wanted = t.raw.sparkSession.range(200).select(F.col("id").alias("nth"), (F.col("id") * 7919 % 1500 + 1).alias("vid"))
    return units.selected(t.units, wanted)


@query("SELECT min(nth) AS nth, (nth * 7919) % 150 + 1 AS vid FROM (SELECT unnest(range(200)) AS nth) GROUP BY 2")
def q_requested_once(t):
    """Requests without repeats, each at its first place."""
    return units.once(t.raw.sparkSession.range(200).select(F.col("id").alias("nth"), (F.col("id") * 7919 % 150 + 1).alias("vid")))


@query(
    """SELECT vid, (9000 + n_frames * 2 * (24 + 6 * n_tids)) * 18 AS milliseconds,
n_frames > 1500 OR n_frames * n_tids > 2500 AS offload FROM units""",
    "units",
)
def q_unit_cost(t):
    return units.unit_cost(t.units, 2)


@query("SELECT * FROM tids WHERE (vid, tid) NOT IN (SELECT (vid, tid) FROM all_boxes)", "tids", "all_boxes")
def q_unboxed(t):
    return planning.unboxed(t.plan.tids, t.raw)


@query("SELECT * FROM spans", "spans")
def q_spans(t):
    return t.plan.spans


@query("SELECT vid, fid, tid FROM kf", "kf")
def q_keyframes(t):
    return t.plan.keyframes.select("vid", "fid", "tid")


@query("SELECT vid, fid, tid, max_iou FROM measured", "measured")
def q_max_iou(t):
    return t.plan.measured.select("vid", "fid", "tid", "max_iou")


@query("SELECT * FROM refs", "refs")
def q_reference_anchor(t):
    return t.plan.references


@query("SELECT * FROM anchors", "anchors")
def q_thinned_anchors(t):
    return t.plan.human


@query("SELECT * FROM noanchor", "noanchor")
def q_plan_refusals(t):
    return t.refused


@query("SELECT vid, min(lo) AS lo, max(hi) AS hi, max(hi) - min(lo) + 1 AS n_frames FROM spans GROUP BY vid", "spans")
def q_prop_span(t):
    return planning.prop_spans(t.plan.spans)


@query("SELECT vid, fid, tid, generated FROM inspan", "inspan")
def q_in_span_frames(t):
    return t.plan.records.select("vid", "fid", "tid", "generated")


def _fills_sql(anchors: str, pool: str, rank: str) -> str:
    """Gap by gap, level by level: the fill of each open gap and the two gaps on its sides."""
    pick = f"arg_min(c.fid, {rank} * 1000000 + abs(2 * c.fid - a - b) * 1000 + c.fid) AS f, min({rank}) AS gen"
    inside = "c.vid = s.vid AND c.tid = s.tid AND (c.fid > a OR (wa AND c.fid = a)) AND (c.fid < b OR (wb AND c.fid = b))"
    level = f"JOIN {pool} c ON {inside} WHERE b - a > 8 GROUP BY s.vid, s.tid, a, b, wa, wb"
    return f"""start AS (
  SELECT vid, tid, a, b, wa, wb FROM (
    SELECT vid, tid, fid AS a, lead(fid) OVER (PARTITION BY vid, tid ORDER BY fid) AS b, false AS wa, false AS wb
    FROM {anchors}) WHERE b IS NOT NULL
  UNION ALL SELECT vid, tid, lo, min(fid), true, false FROM {anchors} JOIN spans USING (vid, tid) GROUP BY vid, tid, lo
  UNION ALL SELECT vid, tid, max(fid), hi, false, true FROM {anchors} JOIN spans USING (vid, tid) GROUP BY vid, tid, hi),
g AS (
  SELECT s.vid, s.tid, a, b, wa, wb, {pick} FROM start s {level}
  UNION ALL
  SELECT s.vid, s.tid, a, b, wa, wb, {pick}
  FROM (SELECT vid, tid, a, f AS b, wa, false AS wb FROM g UNION ALL SELECT vid, tid, f, b, false, wb FROM g) s {level})"""


FILLS = """SELECT vid, tid, f AS fid, CASE WHEN gen = 0 THEN 'human' ELSE 'tracker' END AS source,
CAST(0 AS BIGINT) AS n_flags, a AS gap_lo, b AS gap_hi FROM g"""


def _fills(anchors):
    return anchors.where("fill IS NOT NULL").select("vid", "tid", "fid", F.col("fill").alias("source"), "n_flags", "gap_lo", "gap_hi")


@query(FILLS, "anchors", "spans", "kf", recursive=_fills_sql("anchors", "kf", "c.generated"))
def q_gap_fills(t):
    return _fills(coverage.human_gap(t.plan))


@query(FILLS, "anchors", "spans", "inspan", recursive=_fills_sql("anchors", "inspan", "c.generated"))
def q_gap_fills_any(t):
    return _fills(coverage.human_gap(t.plan, any_box=True))


@query('SELECT vid, fid, "outer", "inner" FROM cont', "cont")
def q_contained_pairs(t):
    return prompts.contained_pairs(t.plan.tracks("inners")).drop("generated")


@query(
    """SELECT a.vid, a.fid, a.tid, "inner", (xmin + xmax) / 2.0 / (64 + 8 * (a.vid % 3)) AS x,
(ymin + ymax) / 2.0 / (48 + 4 * (a.vid % 2)) AS y
FROM anchors a JOIN cont c ON a.vid = c.vid AND a.fid = c.fid AND a.tid = c."outer"
JOIN boxes b ON b.vid = a.vid AND b.fid = a.fid AND b.tid = "inner" """,
    "anchors",
    "cont",
)
def q_negative_clicks(t):
    return prompts.negative_clicks(t.anchors, t.plan.boxes)


CO_SQL = """able AS (SELECT * FROM cont WHERE (vid, "outer") IN (SELECT (vid, tid) FROM anchors)),
ok AS (SELECT vid, fid, tid FROM anchors
  UNION SELECT a.vid, a.fid, a."outer" FROM able a JOIN ok ON a.vid = ok.vid AND a.fid = ok.fid AND a."inner" = ok.tid
        WHERE a."inner" < a."outer"),
co AS (SELECT DISTINCT b.vid, b.fid, b.tid, b.generated FROM able a
  JOIN ok ON a.vid = ok.vid AND a.fid = ok.fid AND a."inner" = ok.tid
  JOIN boxes b ON b.vid = a.vid AND b.fid = a.fid AND b.tid = a."outer"
  WHERE (a.vid, a.fid, a."outer") NOT IN (SELECT (vid, fid, tid) FROM anchors))"""


@query("SELECT * FROM co", "anchors", "cont", recursive=CO_SQL)
def q_co_prompts(t):
    return prompts.co_prompts(t.anchors, t.plan.boxes)


@query(
    """SELECT vid, row_number() OVER (PARTITION BY vid ORDER BY CASE WHEN is_ref THEN -1 ELSE fid END, tid) AS seq, tid, fid,
is_ref, 2 + (SELECT count(*) FROM cont c WHERE c.vid = e.vid AND c.fid = e.fid AND c."outer" = e.tid) AS n_points
FROM (SELECT vid, fid, tid, is_ref FROM anchors UNION ALL SELECT vid, fid, tid, false FROM co) e""",
    "anchors",
    "cont",
    recursive=CO_SQL,
)
def q_prompt_schedule(t):
    co, clicks = _sent(t)
    return prompts.checked(prompts.schedule(t.anchors, co, clicks), most=64)


def _sent(t):
    """Co-prompts and the clicks of all that is prompted."""
    co = scratch.written(prompts.co_prompts(t.anchors, t.plan.shared().boxes), "co-prompts")
    prompted = t.anchors.select("vid", "fid", "tid").unionByName(co.select("vid", "fid", "tid"))
    return co, prompts.negative_clicks(prompted, t.plan.boxes)


CLICKS_SQL = CO_SQL + """,
clicks AS (SELECT e.vid, e.fid, e.tid, "inner" FROM (
    SELECT vid, fid, tid FROM anchors UNION ALL SELECT vid, fid, tid FROM co) e
  JOIN cont c ON c.vid = e.vid AND c.fid = e.fid AND c."outer" = e.tid)"""


@query(
    """SELECT vid, coalesce(n, 0) AS negative_clicks, coalesce(m, 0) AS co_prompts, coalesce(k, 0) AS co_prompts_at_tracker_boxes
FROM (SELECT vid, count(*) AS n FROM clicks GROUP BY vid)
FULL JOIN (SELECT vid, count(*) AS m, count(*) FILTER (generated <> 0) AS k FROM co GROUP BY vid) USING (vid)""",
    "anchors",
    "cont",
    recursive=CLICKS_SQL,
)
def q_negatives_totals(t):
    return prompts.negatives_totals(*_sent(t))


@query(
    """SELECT vid, fid, tid, 2 + count(*) AS n_points FROM clicks GROUP BY vid, fid, tid HAVING count(*) > 1""",
    "anchors",
    "cont",
    recursive=CLICKS_SQL,
)
def q_prompts_over_cap(t):
    """Prompts of more than three points, for a session that takes no more."""
    co, clicks = _sent(t)
    return prompts.over_cap(prompts.schedule(t.anchors, co, clicks), most=3)


@query(
    """SELECT vid, tid, row_number() OVER (PARTITION BY vid, tid ORDER BY is_ref DESC, fid) AS seq, fid,
xmin / (64.0 + 8 * (vid % 3)) AS x0, ymin / (48.0 + 4 * (vid % 2)) AS y0, xmax / (64.0 + 8 * (vid % 3)) AS x1,
ymax / (48.0 + 4 * (vid % 2)) AS y1 FROM anchors JOIN boxes USING (vid, fid, tid)""",
    "anchors",
    "boxes",
)
def q_prompts(t):
    rows = prompts.prompts(t.anchors, t.plan.boxes)
    return rows.select("vid", "tid", "seq", "fid", *(F.col("box")[i].alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))))


@query("SELECT vid, tid, fid, edge, array_to_string(flags, ',') AS flags, len(flags) AS n_flags FROM flags", "flags")
def q_gate_flags(t):
    rows = gate.metrics(t.plan.tracks("max_iou", "overlap"), S).where("human")
    return rows.select("vid", "tid", "fid", "edge", F.concat_ws(",", "flags").alias("flags"), "n_flags")


GATED_FILLS = _fills_sql("gatedheld", "gated", "c.nf")


@query(
    "SELECT * FROM gatedheld UNION ALL SELECT vid, tid, f AS fid, false AS is_ref FROM g",
    "gatedheld",
    "spans",
    recursive=GATED_FILLS,
)
def q_hq_anchors(t):
    return gate.anchors(t.plan).select("vid", "tid", "fid", "is_ref")


@query(
    """SELECT vid, tid, n_candidates, n_clean, n_kept, n_clean = 0 AS fallback, coalesce(flags_ignored, '') AS flags_ignored,
  coalesce(dropped, '') AS dropped FROM (
  SELECT vid, tid, count(*) AS n_candidates, count(*) FILTER (nf = 0) AS n_clean FROM gated GROUP BY vid, tid)
LEFT JOIN (SELECT vid, tid, string_agg(DISTINCT flag, ',' ORDER BY flag) AS flags_ignored FROM (
    SELECT vid, tid, unnest(flags) AS flag FROM gated WHERE candidate) GROUP BY vid, tid) USING (vid, tid)
JOIN (SELECT vid, tid, count(*) AS n_kept FROM final GROUP BY vid, tid) USING (vid, tid)
LEFT JOIN (SELECT vid, tid, string_agg(reason || ':' || n, ',' ORDER BY reason || ':' || n) AS dropped FROM (
    SELECT vid, tid, reason, count(*) AS n FROM (
      SELECT vid, tid, unnest(CASE WHEN nf = 0 THEN ['thinned'] ELSE flags END) AS reason FROM gated
      WHERE (vid, tid, fid) NOT IN (SELECT (vid, tid, fid) FROM final)) GROUP BY vid, tid, reason) GROUP BY vid, tid)
  USING (vid, tid)""",
    "gatedheld",
    "spans",
    recursive=GATED_FILLS + ",\nfinal AS (SELECT vid, tid, fid FROM gatedheld UNION ALL SELECT vid, tid, f FROM g)",
)
def q_gate_summary(t):
    plan = t.plan.shared()
    return gate.summary(gate.flagged(plan), gate.anchors(plan))


@query(
    """SELECT * FROM noanchor UNION ALL SELECT vid, tid, 'no_hq_anchor' AS reason FROM flags GROUP BY vid, tid
HAVING min(len(flags)) > 0""",
    "flags",
    "noanchor",
)
def q_hq_refusals(t):
    """Refusals of the gate where a flagged keyframe is no fallback."""
    return gate.refusals(planning.Plan(t.raw, t.relations, t.videos, replace(S, policy="hq", fallback="refuse")).shared())


@query("SELECT vid, fid, tid, fa, ba, shared FROM areas", "areas")
def q_mask_iou(t):
    shared = rle.overlap(F.col("fwd"), F.col("bwd")).alias("shared")
    return t.paired.select("vid", "fid", "tid", rle.area(F.col("fwd")).alias("fa"), rle.area(F.col("bwd")).alias("ba"), shared)


@query("SELECT vid, fid, tid, reading FROM readings", "readings")
def q_readings(t):
    return t.readings.select("vid", "fid", "tid", "reading")


@query("SELECT vid, fid, tid, pick FROM settled WHERE reading = 'dispute'", "settled")
def q_tiebreaks(t):
    return t.settled.where("reading = 'dispute'").select("vid", "fid", "tid", "pick")


@query(
    """SELECT x.vid, x.fid, x.tid AS a, y.tid AS b, (least(x.f[3], y.f[3]) - greatest(x.f[1], y.f[1]) + 1)
* (least(x.f[4], y.f[4]) - greatest(x.f[2], y.f[2]) + 1) AS shared
FROM areas x JOIN areas y ON x.vid = y.vid AND x.fid = y.fid AND x.tid < y.tid
WHERE x.f IS NOT NULL AND y.f IS NOT NULL AND least(x.f[3], y.f[3]) >= greatest(x.f[1], y.f[1]) AND least(x.f[4], y.f[4]) >= greatest(x.f[2], y.f[2])""",
    "areas",
)
def q_pair_overlap(t):
    return combine.pair_overlaps(t.paired.select("vid", "fid", "tid", F.col("fwd").alias("mask")))


DECIDED = "vid, fid, tid, reading, pick, decision, reason, area, removed_px, fallback"


@query(f"SELECT {DECIDED} FROM decided", "decided")
def q_decisions(t):
    return t.decided.select(*DECIDED.split(", "))


@query(
    """SELECT vid, fid, tid, decision, removed_px, handed_to FROM decided JOIN (
  SELECT vid, fid, tid, string_agg(DISTINCT taker, ',' ORDER BY taker) AS handed_to FROM (
    SELECT w.vid, w.fid, w.tid, w.p, min(s.tid) AS taker FROM px w JOIN px s ON w.vid = s.vid AND w.fid = s.fid AND w.p = s.p
    WHERE s.strong AND NOT w.strong GROUP BY w.vid, w.fid, w.tid, w.p) GROUP BY vid, fid, tid) USING (vid, fid, tid)""",
    "decided",
    "px",
)
def q_handovers(t):
    return t.decided.where("handed_to IS NOT NULL").select("vid", "fid", "tid", "decision", "removed_px", "handed_to")


@query(
    """SELECT name, count(*) AS n FROM (
  SELECT reading AS name FROM decided UNION ALL SELECT 'decision:' || decision FROM decided
  UNION ALL SELECT 'tiebreak:' || decision FROM decided WHERE pick IS NOT NULL
  UNION ALL SELECT reason FROM decided WHERE reason IS NOT NULL) GROUP BY name""",
    "decided",
)
def q_merge_counters(t):
    return combine.counters(t.decided)


RECORD = "vid, tid, fid, reason, source, area, confidence, generated, tracker"


@query(f"SELECT {RECORD} FROM records", "records")
def q_records(t):
    return t.records.select(*RECORD.split(", "))


@query("SELECT reason, count(*) AS n FROM records WHERE reason IS NOT NULL GROUP BY reason", "records")
def q_refusals_by_reason(t):
    return records.by_reason(t.records)


@query(
    """SELECT i.vid, i.tid, i.fid, CASE WHEN n.reason IS NOT NULL THEN n.reason
  WHEN (i.vid, i.fid) NOT IN (SELECT (vid, fid) FROM seen) THEN 'not_tracked' WHEN m.f IS NULL THEN 'empty_mask' END AS reason
FROM inspan i LEFT JOIN noanchor n USING (vid, tid) LEFT JOIN (SELECT * FROM mask WHERE fid % 11 <> 3) m USING (vid, fid, tid)""",
    "inspan",
    "noanchor",
    "mask",
    recursive="seen AS (SELECT DISTINCT vid, fid FROM mask JOIN boxes USING (vid, fid, tid) WHERE f IS NOT NULL AND fid % 11 <> 3)",
)
def q_records_forward(t):
    plan = t.plan.shared()
    masks = proxy.mask_passes(proxy.mask_seeds(plan.boxes)).where("fwd IS NOT NULL AND fid % 11 <> 3")
    rows = records.single_pass_records(plan.records, plan.refused, masks.withColumnRenamed("fwd", "mask"))
    return rows.select("vid", "tid", "fid", "reason")


@query("SELECT * FROM clips", "clips")
def q_clip_reasons(t):
    return t.clips


@query("SELECT * FROM status", "status")
def q_unit_status(t):
    return t.status


@query("SELECT * FROM ledger", "ledger")
def q_ledger(t):
    return t.ledger


@query(
    """SELECT status, count(*) AS clips, CAST(coalesce(sum(masks), 0) AS BIGINT) AS masks,
CAST(coalesce(sum(refusals), 0) AS BIGINT) AS refusals, count(*) FILTER (attempts > 0) AS retried FROM ledger GROUP BY status""",
    "ledger",
)
def q_campaign_status(t):
    return records.campaign_status(t.ledger)


@query(
    """SELECT vid, clip_reason FROM ledger WHERE status = 'done'
AND clip_reason IN ('decode_black', 'frame_count_mismatch', 'frame_size_mismatch')""",
    "ledger",
)
def q_to_transcode(t):
    return records.to_transcode(t.ledger)


@query("SELECT vid, tid, fid FROM inspan EXCEPT SELECT vid, tid, fid FROM written", "inspan", "written")
def q_integrity_missing(t):
    return audit.missing(t.plan.records.select("vid", "tid", "fid"), t.written)


@query(
    "SELECT vid, tid, fid FROM written WHERE (vid, tid, fid) NOT IN (SELECT (vid, tid, fid) FROM inspan)", "inspan", "written"
)
def q_integrity_extra(t):
    return audit.extra(t.plan.records.select("vid", "tid", "fid"), t.written)


@query("SELECT vid, tid, fid, count(*) AS n FROM written GROUP BY vid, tid, fid HAVING count(*) > 1", "written")
def q_integrity_dups(t):
    return audit.repeated(t.written)


def _flat(t):
    """Flat records, each broken in one way that its numbers choose."""
    k = F.expr("(vid * 31 + tid * 7 + fid) % 29")
    broken = lambda n, bad, good: F.when(k == n, bad).otherwise(good)
    mask = F.col("reason").isNull()
    null = F.lit(None)
    return t.records.select(
        F.col("vid").cast("string").alias("vid"),
        broken(0, F.lit(-1).cast("long"), F.col("tid")).alias("tid"),
        "fid",
        F.when(k == 1, "").when(k == 17, "other").otherwise(config.MODEL).alias("model"),
        broken(2, F.lit("xyz"), F.sha2(F.lit("x"), 256)).alias("checkpoint_hash"),
        F.when(k == 18, "0").when(k == 19, "").otherwise(config.MODEL_VERSION).alias("version"),
        broken(3, null, F.lit("c0ffee")).alias("code_commit"),
        F.lit("2020-01-01T00:00:00Z").alias("created_at"),
        broken(4, null, F.col("tracker")).alias("tracker"),
        broken(5, F.lit("text"), F.lit("pvs_box_multianchor")).alias("prompt_mode"),
        broken(6, F.lit("none"), F.lit("human_gap")).alias("policy"),
        broken(20, null, F.array(F.lit(1).cast("long"), F.lit(5).cast("long"))).alias("anchors"),
        broken(21, F.lit(False), null.cast("boolean")).alias("negatives_ok"),
        broken(7, F.lit(False), F.lit(True)).alias("has_gap"),
        broken(8, F.lit("sideways"), F.lit("bidirectional")).alias("direction"),
        broken(9, F.lit(False), F.lit(True)).alias("has_merge"),
        broken(10, F.lit(2).cast("long"), F.col("generated")).alias("generated"),
        broken(11, F.lit("train+val"), F.lit("train")).alias("split"),
        broken(12, F.lit("other"), F.col("reason")).alias("reason"),
        broken(13, F.lit(0).cast("long"), proxy.height_of(F.col("vid"))).alias("rle_h"),
        proxy.width_of(F.col("vid")).alias("rle_w"),
        F.when(mask, broken(14, F.lit(""), F.lit("counts"))).alias("counts"),
        F.when(mask, broken(15, F.lit(1.5), F.col("confidence"))).otherwise(broken(16, F.lit(0.5), null)).alias("confidence"),
    )


@query(
    """SELECT * FROM (SELECT CAST(vid AS VARCHAR) AS vid, CASE WHEN k = 0 THEN -1 ELSE tid END AS tid, fid, CASE k
    WHEN 0 THEN 'tid is not a number from 0' WHEN 1 THEN 'model is empty' WHEN 2 THEN 'checkpoint_hash is no sha256'
    WHEN 3 THEN 'code_commit is empty' WHEN 4 THEN 'tracker is empty' WHEN 5 THEN 'prompt_mode is unknown'
    WHEN 6 THEN 'policy is unknown' WHEN 7 THEN 'gap is missing' WHEN 8 THEN 'direction is unknown'
    WHEN 17 THEN 'model is not the expected one' WHEN 18 THEN 'version is not the expected one' WHEN 19 THEN 'version is empty'
    WHEN 20 THEN 'anchors are missing' WHEN 21 THEN 'contained negatives are malformed' WHEN 9 THEN 'merge is missing' WHEN 10 THEN 'generated is not 0 or 1' WHEN 11 THEN 'split is unknown'
    WHEN 12 THEN CASE WHEN reason IS NULL THEN 'a mask has a reason' ELSE 'reason is unknown' END
    WHEN 13 THEN CASE WHEN reason IS NULL THEN 'mask is malformed' END
    WHEN 14 THEN CASE WHEN reason IS NULL THEN 'mask is malformed' END
    WHEN 15 THEN CASE WHEN reason IS NULL THEN 'confidence is not in 0 to 1' END
    WHEN 16 THEN CASE WHEN reason IS NOT NULL THEN 'a refusal has a confidence' END END AS violation
  FROM (SELECT *, (vid * 31 + tid * 7 + fid) % 29 AS k FROM records)) WHERE violation IS NOT NULL""",
    "records",
)
def q_record_violations(t):
    return audit.violations(_flat(t))


@query("SELECT * FROM tracklets", "tracklets")
def q_tracklets(t):
    return t.tracklets


@query("SELECT * FROM samples", "samples")
def q_samples(t):
    return t.samples


@query(
    "SELECT disposition, count(*) AS n, count(*) FILTER (coalesce(valid, false)) AS n_valid FROM samples GROUP BY disposition",
    "samples",
)
def q_dispositions(t):
    return correspondence.dispositions(t.samples)


@query(
    """SELECT vid, s, p, o, "start", "end", txt[CAST("start" AS BIGINT) + 1:CAST("end" AS BIGINT)] AS "text",
string_agg(DISTINCT 'vidor-' || tid, ',' ORDER BY 'vidor-' || tid) AS tracklets
FROM (SELECT vid, s, p, o, txt, s AS tid, CAST(0 AS INTEGER) AS "start", CAST(length('obj' || s) AS INTEGER) AS "end" FROM captions WHERE s_named
  UNION ALL SELECT vid, s, p, o, txt, o, CAST(length(txt) - length('obj' || o) AS INTEGER), CAST(length(txt) AS INTEGER) FROM captions
  WHERE o_named AND s <> o)
JOIN (SELECT vid, tid FROM tracklets) USING (vid, tid) WHERE txt IS NOT NULL GROUP BY vid, s, p, o, "start", "end", txt""",
    "captions",
    "tracklets",
)
def q_span_links(t):
    return correspondence.span_links(units.triples(t.relations).drop("ord"), t.tracklets, t.captions)


@query(
    "SELECT vid, s, p, o, 'set:' || split || ':' || vid || ':' || s || '-' || p || '-' || o AS sample_id, s || '-' || p || '-' || o AS expression_id FROM triples JOIN (SELECT DISTINCT vid, split FROM rel) USING (vid)",
    "triples",
)
def q_sample_ids(t):
    rows = units.triples(t.relations).join(t.relations.select("vid", "split").distinct(), "vid")
    return correspondence.sample_ids(rows, "set")


@query(
    """SELECT vid, fid, tid, colour, tid || ':' || split_part(category, '/', 1)
  || CASE WHEN reason IS NOT NULL THEN ' (no mask)' ELSE '' END AS label, xmin, ymin, xmax, ymax
FROM records JOIN (SELECT vid, fid, tid, xmin, ymin, xmax, ymax FROM boxes) USING (vid, fid, tid)
JOIN (SELECT *, (row_number() OVER (PARTITION BY vid ORDER BY tid) - 1) % 8 AS colour FROM cats) USING (vid, tid)""",
    "records",
    "boxes",
    "cats",
)
def q_overlay_labels(t):
    return correspondence.overlay(t.records, t.plan.boxes, units.categories(t.relations))


@query(
    """SELECT vid, fid, tid, list_aggregate(list_transform(range(1, len(runs) + 1), lambda i: list_aggregate(list_transform(
    range(0, CASE WHEN d[i] BETWEEN -16 AND 15 THEN 1 WHEN d[i] BETWEEN -512 AND 511 THEN 2 WHEN d[i] BETWEEN -16384 AND 16383 THEN 3 ELSE 4 END),
    lambda k: chr(CAST(48 + ((d[i] + 1073741824) // CAST(pow(32, k) AS BIGINT)) % 32 + CASE WHEN k + 1 < CASE WHEN d[i] BETWEEN -16 AND 15 THEN 1
      WHEN d[i] BETWEEN -512 AND 511 THEN 2 WHEN d[i] BETWEEN -16384 AND 16383 THEN 3 ELSE 4 END THEN 32 ELSE 0 END AS INTEGER))),
  'string_agg', '')), 'string_agg', '') AS counts, true AS same
FROM (SELECT *, list_transform(range(1, len(runs) + 1), lambda i: runs[i] - CASE WHEN i > 3 THEN runs[i - 2] ELSE 0 END) AS d FROM (
  SELECT vid, fid, tid, list_concat([f[1] * h + f[2], f[4] - f[2] + 1], list_concat(
    flatten([[h - (f[4] - f[2] + 1), f[4] - f[2] + 1] FOR j IN range(f[3] - f[1])]), [w * h - (f[3] * h + f[4] + 1)])) AS runs
  FROM (SELECT *, 64 + 8 * (vid % 3) AS w, 48 + 4 * (vid % 2) AS h FROM areas) WHERE f IS NOT NULL))""",
    "areas",
)
def q_rle_counts(t):
    """Compressed counts of the forward masks, and whether they read back as the same pixels."""
    size = proxy.width_of(F.col("vid")) * proxy.height_of(F.col("vid"))
    rows = t.paired.where("fwd IS NOT NULL").withColumn("counts", rle.counts_text("fwd", size))
    back = rle.area(rle.counts_intervals("counts"))
    return rows.select("vid", "fid", "tid", "counts", (back == rle.area(F.col("fwd"))).alias("same"))


@query(
    """SELECT vid, fid, tid, CASE WHEN f IS NOT NULL THEN greatest(0, least(f[3], xmax) - greatest(f[1], xmin) + 1)
  * greatest(0, least(f[4], ymax) - greatest(f[2], ymin) + 1) END AS inside_px, fa AS area
FROM areas JOIN (SELECT vid, fid, tid, xmin, ymin, xmax, ymax FROM boxes) USING (vid, fid, tid)""",
    "areas",
    "boxes",
)
def q_inside_px(t):
    # a row's box comes along as four numbers and becomes intervals here: joined as intervals, Spark took it for small
    sides = (*geometry.SIDES, "height")
    box = proxy.columns_of(*(F.col(c) for c in sides))
    inside = F.when(F.col("fwd").isNotNull(), rle.overlap(F.col("fwd"), box))
    rows = combine.readings(t.passes(*sides), S.merge)
    return rows.select("vid", "fid", "tid", inside.alias("inside_px"), F.col("fa").alias("area"))


@query(
    """SELECT d.vid, d.tid, seg_end - seg_begin + 1 AS n_frames, count(*) FILTER (fid IS NOT NULL) AS present,
string_agg(CASE WHEN fid IS NULL THEN '0' ELSE '1' END, '' ORDER BY f) AS shape, CAST(coalesce(sum(area), 0) AS BIGINT) AS area
FROM (SELECT vid, tid, seg_begin, seg_end, unnest(range(seg_begin, seg_end + 1)) AS f FROM tracklets JOIN seg USING (vid)) d
LEFT JOIN (SELECT vid, tid, fid, area FROM records WHERE reason IS NULL) r ON d.vid = r.vid AND d.tid = r.tid AND d.f = r.fid
GROUP BY d.vid, d.tid, seg_begin, seg_end""",
    "tracklets",
    "records",
    "seg",
)
def q_aligned_masks(t):
    rows = correspondence.aligned(t.records, t.plan.segments, "area")
    shape = F.concat_ws("", F.transform("values", lambda v: F.when(v.isNull(), "0").otherwise("1")))
    area = F.aggregate("values", F.lit(0).cast("long"), lambda a, v: a + F.coalesce(v, F.lit(0)))
    return rows.select("vid", "tid", "n_frames", "present", shape.alias("shape"), area.alias("area"))


def _nested(t):
    """Nested records of captioned relations, whose masks are as large as their frames; each broken in one way that its
    numbers choose."""
    size = F.array(F.lit(1).cast("long"), F.lit(4096).cast("long"))
    rows = correspondence.aligned(t.records, t.plan.segments, "area")
    mask = lambda v: F.when(v.isNotNull(), F.struct(size.alias("size"), F.array(F.lit(4096) - v, v).alias("counts")))
    tracks = rows.select("vid", "tid", F.transform("values", mask).alias("masks"), "present")
    triples = units.triples(t.relations).drop("ord").withColumn("split", proxy.split_of(F.col("vid")))
    nested = correspondence.relation_records(triples, tracks, t.captions, t.plan.segments, "tracks-v1", config.SOURCES[1])
    k = F.expr("vid + 3 * s + 5 * o") % 13
    broken = lambda n, name, bad: F.when(k == n, bad).otherwise(F.col(name)).alias(name)
    kept = [c for c in nested.columns if c not in ("schema_version", "frame_ids", "frame_files", "disposition", "negative", "span_links")]
    return nested.select(
        *kept,
        broken(2, "schema_version", F.lit("v0")),
        broken(3, "frame_ids", F.array().cast("array<string>")),
        broken(4, "frame_files", F.slice("frame_files", 1, 3)),
        broken(7, "disposition", F.lit("unheard of")),
        broken(8, "negative", F.lit(True)),
        broken(9, "span_links", F.slice("span_links", 2, 9)),
    )


@query(
    """SELECT vid, s, p, o, problem FROM (SELECT *, CASE
  WHEN k = 2 THEN 'schema_version is not the expected one' WHEN txt IS NULL THEN 'text is empty' WHEN k = 3 THEN 'no frames'
  WHEN k = 4 AND seg_end - seg_begin + 1 <> 3 THEN 'frame_files do not match frame_ids'
  WHEN n_groups > 0 AND n_tracklets = 0 THEN 'a group names a missing tracklet'
  WHEN k = 9 AND n_links > 0 THEN 'span_links are not the inverse of groups' WHEN k = 7 THEN 'disposition is unknown'
  WHEN k = 8 AND (n_tracklets > 0 OR n_groups > 0) THEN 'a negative record has tracklets'
  WHEN k = 8 THEN 'a negative record''s disposition is another'
  WHEN n_tracklets > 0 AND NOT main THEN 'no group is the main referent' END AS problem
  FROM (SELECT m.*, (m.vid + 3 * m.s + 5 * m.o) % 13 AS k, txt, seg_begin, seg_end, n_groups AS n_links, n_groups > 0 AND s_named AND m.s <> m.o
      AND (m.vid, m.s) IN (SELECT (vid, tid) FROM tracklets) AS main
    FROM samples m JOIN captions c ON m.vid = c.vid AND m.s = c.s AND m.p = c.p AND m.o = c.o JOIN seg ON seg.vid = m.vid)) WHERE problem IS NOT NULL""",
    "samples",
    "captions",
    "seg",
    "tracklets",
)
def q_correspondence_violations(t):
    return _nested(t).withColumn("problem", correspondence.record_problem("tracks-v1")).where("problem IS NOT NULL").select("vid", "s", "p", "o", "problem")


@query(
    """SELECT CASE WHEN vid % 10 < 8 THEN 'train' WHEN vid % 10 = 8 THEN 'val' ELSE 'test' END AS split,
count(*) FILTER (reason IS NULL) AS masks, count(*) FILTER (reason IS NOT NULL) AS refusals, count(DISTINCT vid) AS clips,
string_agg(DISTINCT CASE WHEN vid % 3 = 0 THEN 'b2' ELSE 'a1' END, ',' ORDER BY CASE WHEN vid % 3 = 0 THEN 'b2' ELSE 'a1' END) AS code_commits,
'c' AS checkpoint_hashs FROM records GROUP BY 1""",
    "records",
)
def q_export_totals(t):
    commit = F.when(F.col("vid") % 3 == 0, "b2").otherwise("a1")
    rows = t.records.select("vid", "reason", proxy.split_of(F.col("vid")).alias("split"), commit.alias("code_commit"), F.lit("c").alias("checkpoint_hash"))
    return records.export_totals(rows)


@query(
    """SELECT vid, 'copies/' || vid AS video_path FROM ledger WHERE status = 'done'
AND clip_reason IN ('decode_black', 'frame_size_mismatch') AND vid % 2 = 0""",
    "ledger",
)
def q_requeued(t):
    copies = t.known.where("vid % 2 = 0").select("vid", F.concat(F.lit("copies/"), F.col("vid").cast("string")).alias("path"))
    return records.requeued(t.ledger, copies)


@query(
    """SELECT vid, tid, 'tid ' || tid || ' (' || coalesce(category, '?') || '): frames ' || lo || ' to ' || hi || '; ' ||
CASE WHEN reason IS NOT NULL THEN 'refused, ' || reason ELSE n || ' anchors, reference ' || ref END AS line
FROM spans LEFT JOIN cats USING (vid, tid) LEFT JOIN noanchor USING (vid, tid)
LEFT JOIN (SELECT vid, tid, count(*) AS n, min(fid) FILTER (is_ref) AS ref FROM anchors GROUP BY vid, tid) USING (vid, tid)""",
    "spans",
    "cats",
    "noanchor",
    "anchors",
)
def q_plan_lines(t):
    plan = t.plan.shared()
    return records.plan_lines(plan.clips, plan.spans, t.anchors, plan.refused, units.categories(t.relations))
