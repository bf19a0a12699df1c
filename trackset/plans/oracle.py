"""DuckDB SQL that gives the same rows as the queries, put together from named common table expressions."""

from __future__ import annotations

#: name -> (names it needs, body). They restate the proxy tables and the operators in plain SQL.
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "lines": (
        (),
        """SELECT l_suppkey AS vid, date_diff('day', TIMESTAMP '1995-01-01', l_shipdate) // 20 AS fid,
    CAST(l_linenumber AS BIGINT) AS tid, l_orderkey, l_partkey, l_extendedprice, CAST(l_quantity AS BIGINT) AS qty,
    l_returnflag, l_linestatus, CAST(round(l_tax * 100) AS BIGINT) AS tax,
    CAST(round(l_discount * 100) AS BIGINT) AS discount FROM lineitem""",
    ),
    "all_boxes": (
        ("lines",),
        """SELECT vid, fid, tid, l_partkey % 24 AS xmin, l_orderkey % 18 AS ymin, l_partkey % 24 + 8 + qty % 24 AS xmax,
    l_orderkey % 18 + 6 + (l_partkey // 7) % 18 AS ymax, CAST(l_returnflag <> 'R' AS BIGINT) AS generated,
    CASE WHEN l_returnflag = 'R' THEN 'none' ELSE l_linestatus END AS tracker,
    (l_orderkey * 7 + l_partkey * 3 + fid) % 20 AS h, 90 + l_partkey % 10 AS fscore, 90 + l_orderkey % 10 AS bscore,
    (l_partkey * 13 + l_orderkey) % 100 AS blur
  FROM (SELECT *, row_number() OVER (PARTITION BY vid, fid, tid ORDER BY l_orderkey, l_partkey, l_extendedprice) AS rn
        FROM lines) WHERE rn = 1""",
    ),
    "rel": (
        ("lines",),
        """SELECT vid, CASE WHEN vid % 10 < 8 THEN 'train' WHEN vid % 10 = 8 THEN 'val' ELSE 'test' END AS split,
    tid AS s, l_returnflag || l_linestatus AS p, (tid - 1 + l_partkey % 3) % 7 + 1 AS o, tax AS b, 124 - discount AS e,
    l_orderkey, row_number() OVER (ORDER BY l_orderkey, l_partkey, l_extendedprice) AS ord FROM lines WHERE qty <= 1""",
    ),
    "tids": (("rel",), "SELECT vid, s AS tid FROM rel UNION SELECT vid, o FROM rel"),
    "seg": (("rel",), "SELECT vid, min(b) AS seg_begin, max(e) AS seg_end FROM rel GROUP BY vid"),
    "triples": (("rel",), "SELECT vid, s, p, o, min(ord) AS ord FROM rel GROUP BY vid, s, p, o"),
    "cats": (
        ("rel",),
        """SELECT vid, tid, arg_max('cat' || ((tid + l_orderkey) % 4) || '/sub', ord * 3 + pos) AS category
  FROM (SELECT vid, s AS tid, l_orderkey, ord, 0 AS pos FROM rel UNION ALL SELECT vid, o, l_orderkey, ord, 1 FROM rel
        UNION ALL SELECT vid, 8 + s % 3, l_orderkey, ord, 2 FROM rel) GROUP BY vid, tid""",
    ),
    "units": (
        ("rel", "triples", "cats", "tids", "all_boxes"),
        """SELECT r.vid, split, n_tids, 125 + r.vid % 7 AS n_frames, n_records, seg_begin, seg_end, relations, cats
  FROM (SELECT vid, string_agg(DISTINCT split, '+' ORDER BY split) AS split, count(*) AS n_records,
               min(b) AS seg_begin, max(e) AS seg_end FROM rel GROUP BY vid) r
  JOIN (SELECT vid, string_agg(s || '-' || p || '-' || o, ',' ORDER BY ord) AS relations FROM triples GROUP BY vid) t
    USING (vid)
  JOIN (SELECT vid, string_agg(tid || ':' || category, ',' ORDER BY tid) AS cats FROM cats GROUP BY vid) c USING (vid)
  JOIN (SELECT vid, count(*) AS n_tids FROM tids GROUP BY vid) n USING (vid)
  WHERE vid IN (SELECT vid FROM all_boxes)""",
    ),
    "boxes": (("all_boxes", "tids"), "SELECT b.* FROM all_boxes b JOIN tids USING (vid, tid)"),
    "spans": (
        ("boxes", "seg"),
        """SELECT vid, tid, greatest(seg_begin, min(fid)) AS lo, least(seg_end, max(fid)) AS hi
  FROM boxes JOIN seg USING (vid) GROUP BY vid, tid, seg_begin, seg_end""",
    ),
    "inspan": (("boxes", "spans"), "SELECT b.*, lo, hi FROM boxes b JOIN spans USING (vid, tid) WHERE fid BETWEEN lo AND hi"),
    "kf": (("inspan",), "SELECT * FROM inspan WHERE generated = 0"),
    "pairs2": (
        ("boxes",),
        """SELECT a.vid, a.fid, a.tid, b.tid AS other,
    greatest(0, least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin) + 1)
      * greatest(0, least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin) + 1) AS shared,
    (a.xmax - a.xmin + 1) * (a.ymax - a.ymin + 1) AS area, (b.xmax - b.xmin + 1) * (b.ymax - b.ymin + 1) AS other_area
  FROM boxes a JOIN boxes b ON a.vid = b.vid AND a.fid = b.fid AND a.tid <> b.tid""",
    ),
    "over": (
        ("pairs2",),
        """SELECT vid, fid, tid, max(CAST(shared AS DOUBLE) / (area + other_area - shared)) AS max_iou,
    max(CAST(shared AS DOUBLE) / area) AS covered FROM pairs2 GROUP BY vid, fid, tid""",
    ),
    "measured": (
        ("kf", "over"),
        """SELECT k.*, coalesce(max_iou, 0.0) AS max_iou, coalesce(covered, 0.0) AS overlap
  FROM kf k LEFT JOIN over USING (vid, fid, tid)""",
    ),
    "refs": (
        ("measured",),
        """SELECT vid, tid, fid AS ref, max_iou AS ref_max_iou, n_human FROM (
    SELECT *, row_number() OVER (PARTITION BY vid, tid ORDER BY max_iou, fid) AS rn,
           count(*) OVER (PARTITION BY vid, tid) AS n_human FROM measured) WHERE rn = 1""",
    ),
    "anchors": (
        ("kf", "refs"),
        """SELECT vid, tid, fid, fid = ref AS is_ref FROM (
    SELECT vid, tid, fid, ref, row_number() OVER (PARTITION BY vid, tid ORDER BY fid) - 1 AS nth,
           count(*) OVER (PARTITION BY vid, tid) AS n FROM kf JOIN refs USING (vid, tid))
  WHERE n <= 8 OR fid = ref
     OR nth IN (SELECT unnest([CAST(round_even(i * ((n - 1) / 7.0), 0) AS BIGINT) FOR i IN range(8)]))""",
    ),
    "noanchor": (
        ("spans", "kf"),
        """SELECT vid, tid, 'no_human_keyframe' AS reason FROM spans
  WHERE (vid, tid) NOT IN (SELECT (vid, tid) FROM kf)""",
    ),
    "cont": (
        ("pairs2",),
        """SELECT vid, fid, tid AS "outer", other AS "inner" FROM pairs2
  WHERE CAST(shared AS DOUBLE) / other_area >= 0.9 AND other_area <= 0.25 * area""",
    ),
    "flags": (
        ("measured", "boxes"),
        """SELECT *, list_filter([
      CASE WHEN edge > 2 OR (edge > 0 AND rel_size < 0.8) THEN 'edge' END,
      CASE WHEN overlap > 0.6 OR overlap > mid_overlap + 0.2 THEN 'overlap' END,
      CASE WHEN motion > 0.05 THEN 'motion' END, CASE WHEN rel_size < 0.6 THEN 'small' END,
      CASE WHEN blur < 20 OR blur < 0.4 * mid_blur THEN 'blur' END], lambda x: x IS NOT NULL) AS flags
  FROM (SELECT m.*, motion, area / median(area) OVER w AS rel_size, median(overlap) OVER w AS mid_overlap,
               median(CAST(blur AS DOUBLE)) OVER w AS mid_blur,
               CAST(xmin <= 2 AS BIGINT) + CAST(ymin <= 2 AS BIGINT) + CAST(xmax >= 64 + 8 * (vid % 3) - 3 AS BIGINT)
                 + CAST(ymax >= 48 + 4 * (vid % 2) - 3 AS BIGINT) AS edge
        FROM (SELECT *, CAST((xmax - xmin + 1) * (ymax - ymin + 1) AS DOUBLE) AS area FROM measured) m
        JOIN (SELECT vid, tid, fid, coalesce((before + after) / 2, before, after) AS motion FROM (
          SELECT vid, tid, fid,
            sqrt(pow(x - lag(x) OVER o, 2) + pow(y - lag(y) OVER o, 2)) / ((fid - lag(fid) OVER o) * d) AS before,
            sqrt(pow(x - lead(x) OVER o, 2) + pow(y - lead(y) OVER o, 2)) / ((lead(fid) OVER o - fid) * d) AS after
          FROM (SELECT vid, tid, fid, (xmin + xmax) / 2.0 AS x, (ymin + ymax) / 2.0 AS y,
                       sqrt(pow(xmax - xmin + 1, 2) + pow(ymax - ymin + 1, 2)) AS d FROM boxes)
          WINDOW o AS (PARTITION BY vid, tid ORDER BY fid))) USING (vid, tid, fid)
        WINDOW w AS (PARTITION BY vid, tid))""",
    ),
    "gated": (
        ("flags",),
        """SELECT vid, tid, fid, flags, nf, candidate, candidate AND fid = ref AS is_ref,
    candidate AND (n <= 8 OR fid = ref
      OR nth IN (SELECT unnest([CAST(round_even(i * ((n - 1) / 7.0), 0) AS BIGINT) FOR i IN range(8)])))
    OR fid = low OR fid = high AS held
  FROM (SELECT *, min(fid) OVER o AS low, max(fid) OVER o AS high, count(*) FILTER (candidate) OVER o AS n,
               count(*) FILTER (candidate) OVER (PARTITION BY vid, tid ORDER BY fid) - 1 AS nth,
               first_value(fid) OVER (PARTITION BY vid, tid ORDER BY NOT candidate, max_iou, fid) AS ref
        FROM (SELECT *, len(flags) AS nf, len(flags) = min(len(flags)) OVER (PARTITION BY vid, tid) AS candidate FROM flags)
        WINDOW o AS (PARTITION BY vid, tid))""",
    ),
    "gatedheld": (("gated",), "SELECT vid, tid, fid, is_ref FROM gated WHERE held"),
    "mask": (
        ("all_boxes",),
        """SELECT vid, fid, tid,
    CASE WHEN h IN (0, 4, 9) THEN NULL WHEN h IN (2, 5, 8) THEN [xmin, ymin, xmin + 1, ymin + 2]
         WHEN h = 7 THEN [xmin, ymin, xmin, ymax] ELSE [xmin, ymin, xmax, ymax] END AS f,
    CASE WHEN h IN (1, 4, 8) THEN NULL WHEN h IN (3, 5, 9) THEN [xmin, ymin, xmin + 1, ymin + 2]
         WHEN h = 6 THEN [(xmin + 25) % 32, ymin, (xmin + 25) % 32 + xmax - xmin, ymax]
         ELSE [xmin + 1, ymin, xmax + 1, ymax] END AS b, fscore / 100.0 AS fconf, bscore / 100.0 AS bconf
  FROM all_boxes""",
    ),
    "areas": (
        ("mask", "inspan", "noanchor"),
        """SELECT vid, fid, tid, f, b, CASE WHEN f IS NOT NULL THEN CAST(fconf AS DOUBLE) END AS fconf,
    CASE WHEN b IS NOT NULL THEN CAST(bconf AS DOUBLE) END AS bconf,
    coalesce((f[3] - f[1] + 1) * (f[4] - f[2] + 1), 0) AS fa, coalesce((b[3] - b[1] + 1) * (b[4] - b[2] + 1), 0) AS ba,
    coalesce(greatest(0, least(f[3], b[3]) - greatest(f[1], b[1]) + 1)
      * greatest(0, least(f[4], b[4]) - greatest(f[2], b[2]) + 1), 0)
      * CASE WHEN f IS NULL OR b IS NULL THEN 0 ELSE 1 END AS shared
  FROM mask JOIN (SELECT vid, fid, tid FROM inspan) USING (vid, fid, tid)
  WHERE (vid, tid) NOT IN (SELECT (vid, tid) FROM noanchor)""",
    ),
    "readings": (
        ("areas",),
        """SELECT *, CASE
      WHEN fa = 0 AND ba = 0 THEN 'both_empty' WHEN fa < 20 AND ba < 20 AND fa > 0 AND ba > 0 THEN 'both_speck'
      WHEN fa < 20 AND ba < 20 AND fa > 0 THEN 'forward_speck_only' WHEN fa < 20 AND ba < 20 THEN 'backward_speck_only'
      WHEN fa >= 20 AND ba >= 20 AND fa < 0.1 * ba THEN 'forward_speck'
      WHEN fa >= 20 AND ba >= 20 AND ba < 0.1 * fa THEN 'backward_speck'
      WHEN fa >= 20 AND ba >= 20 AND 20000 * shared > 5999 * (fa + ba - shared) THEN 'agree'
      WHEN fa >= 20 AND ba >= 20 THEN 'dispute'
      WHEN fa >= 20 THEN CASE WHEN ba = 0 THEN 'forward_only' ELSE 'backward_speck' END
      ELSE CASE WHEN fa = 0 THEN 'backward_only' ELSE 'forward_speck' END END AS reading FROM areas""",
    ),
    "settled": (
        ("readings",),
        """SELECT *, CASE WHEN reading = 'dispute' AND greatest(coalesce(fconf, -1), coalesce(bconf, -1)) >= 0.95
      THEN CASE WHEN coalesce(fconf, -1) >= coalesce(bconf, -1) THEN 'forward' ELSE 'backward' END END AS pick,
    CASE WHEN reading IN ('forward_speck', 'backward_only') THEN 'backward'
         WHEN reading IN ('backward_speck', 'forward_only') THEN 'forward' WHEN reading = 'agree' THEN 'either'
         WHEN reading = 'dispute' THEN coalesce(pick, 'dispute') END AS pref FROM readings""",
    ),
    "chosen": (
        ("settled",),
        """SELECT vid, fid, tid, pref, pick IS NOT NULL AS taken, CASE WHEN pref = 'backward' THEN b ELSE f END AS r, b,
    CASE WHEN pref = 'backward' THEN ba ELSE fa END AS before, pref <> 'either' AS strong
  FROM settled WHERE pref IS NOT NULL AND pref <> 'dispute'""",
    ),
    "px": (
        ("chosen",),
        """SELECT vid, fid, tid, strong, x * 48 + y AS p FROM (
    SELECT vid, fid, tid, strong, x, unnest(range(r[2], r[4] + 1)) AS y
    FROM (SELECT vid, fid, tid, strong, r, unnest(range(r[1], r[3] + 1)) AS x FROM chosen))""",
    ),
    "strongpx": (("px",), "SELECT vid, fid, p, count(*) AS n FROM px WHERE strong GROUP BY vid, fid, p"),
    "conflict": (
        ("px", "strongpx"),
        "SELECT DISTINCT vid, fid, tid FROM px JOIN strongpx USING (vid, fid, p) WHERE strong AND n > 1",
    ),
    "leftpx": (
        ("px", "strongpx"),
        """SELECT px.vid, px.fid, px.tid, px.p FROM px LEFT JOIN strongpx s USING (vid, fid, p)
  WHERE strong OR s.n IS NULL""",
    ),
    "after": (
        ("chosen", "leftpx", "conflict"),
        """SELECT c.*, coalesce(n, 0) AS after, k.tid IS NOT NULL AS conflicted FROM chosen c
  LEFT JOIN (SELECT vid, fid, tid, count(*) AS n FROM leftpx GROUP BY vid, fid, tid) USING (vid, fid, tid)
  LEFT JOIN conflict k USING (vid, fid, tid)""",
    ),
    "second": (
        ("after", "leftpx", "conflict"),
        """SELECT vid, fid, tid, x * 48 + y AS p FROM (
    SELECT vid, fid, tid, x, unnest(range(b[2], b[4] + 1)) AS y
    FROM (SELECT vid, fid, tid, b, unnest(range(b[1], b[3] + 1)) AS x FROM after
          WHERE NOT conflicted AND after < before AND after < 20 AND NOT taken AND b IS NOT NULL))""",
    ),
    "blocked": (
        ("second", "leftpx", "conflict"),
        """SELECT DISTINCT s.vid, s.fid, s.tid FROM second s
  JOIN leftpx l ON s.vid = l.vid AND s.fid = l.fid AND s.p = l.p AND s.tid <> l.tid
  WHERE (l.vid, l.fid, l.tid) NOT IN (SELECT (vid, fid, tid) FROM conflict)""",
    ),
    "decided": (
        ("settled", "after", "second", "blocked"),
        """SELECT s.vid, s.fid, s.tid, s.reading, s.pick, CASE
      WHEN s.pref IS NULL THEN 'none' WHEN s.pref = 'dispute' OR conflicted THEN 'refused'
      WHEN after < before AND after < 20 THEN CASE WHEN fell THEN 'backward' ELSE 'refused' END
      WHEN s.pref = 'backward' THEN 'backward' ELSE 'forward' END AS decision, CASE
      WHEN s.pref = 'dispute' THEN 'disputed_mask' WHEN conflicted THEN 'passes_conflict'
      WHEN after < before AND after < 20 AND NOT fell THEN 'handed_over_speck' END AS reason, CASE
      WHEN s.pref IS NULL OR s.pref = 'dispute' OR conflicted THEN NULL
      WHEN after < before AND after < 20 THEN CASE WHEN fell THEN s.ba END ELSE after END AS area,
    CASE WHEN NOT conflicted AND after < before THEN before - after END AS removed_px,
    coalesce(NOT conflicted AND after < before AND after < 20 AND fell, false) AS fallback, s.fconf, s.bconf
  FROM settled s LEFT JOIN (
    SELECT a.*, (a.vid, a.fid, a.tid) IN (SELECT (vid, fid, tid) FROM second)
                AND (a.vid, a.fid, a.tid) NOT IN (SELECT (vid, fid, tid) FROM blocked) AS fell FROM after a) a
    USING (vid, fid, tid)""",
    ),
    "clips": (
        ("units",),
        """SELECT vid, CASE WHEN n_tids > 6 THEN 'too_many_objects' WHEN vid % 10 = 0 THEN 'video_missing'
      WHEN vid % 13 = 1 THEN 'frame_count_mismatch' WHEN vid % 17 = 2 THEN 'frame_size_mismatch'
      WHEN vid % 19 = 3 THEN 'decode_black' END AS clip_reason FROM units""",
    ),
    "records": (
        ("inspan", "clips", "noanchor", "decided"),
        """SELECT vid, tid, fid, why AS reason, CASE WHEN why IS NULL THEN decision END AS source,
    CASE WHEN why IS NULL THEN area END AS area,
    CASE WHEN why IS NULL THEN CASE decision WHEN 'forward' THEN fconf ELSE bconf END END AS confidence,
    generated, tracker
  FROM (SELECT i.*, d.decision, d.area, d.fconf, d.bconf, coalesce(c.clip_reason, n.reason, CASE
            WHEN d.decision = 'refused' THEN d.reason
            WHEN d.decision = 'none' THEN CASE WHEN d.reading = 'both_empty' THEN 'empty_mask' ELSE 'speck_mask' END
            WHEN d.decision IS NULL THEN 'empty_mask' END) AS why
        FROM inspan i LEFT JOIN clips c USING (vid) LEFT JOIN noanchor n USING (vid, tid)
        LEFT JOIN decided d USING (vid, fid, tid))""",
    ),
    "status": (
        ("units",),
        """SELECT vid, CASE WHEN vid % 7 < 4 THEN 'done' WHEN vid % 7 < 6 AND over THEN 'failed' ELSE 'pending' END AS status,
    CASE WHEN vid % 7 < 4 OR vid % 7 = 6 THEN 0 ELSE vid % 6 END AS attempts
  FROM (SELECT vid, CASE WHEN vid % 5 = 0 THEN vid % 6 >= 5
                         ELSE vid % 6 >= 2 OR (vid % 6 >= 1 AND vid % 3 <> 0) END AS over FROM units)""",
    ),
    "ledger": (
        ("units", "status", "records", "clips"),
        """SELECT vid, split, n_tids, n_frames, status, attempts, CASE WHEN status = 'done' THEN masks END AS masks,
    CASE WHEN status = 'done' THEN refusals END AS refusals, CASE WHEN status = 'done' THEN clip_reason END AS clip_reason
  FROM units JOIN status USING (vid) LEFT JOIN (
    SELECT vid, count(*) FILTER (reason IS NULL) AS masks, count(*) FILTER (reason IS NOT NULL) AS refusals
    FROM records GROUP BY vid) USING (vid) LEFT JOIN clips USING (vid)""",
    ),
    "written": (
        ("records",),
        """SELECT vid, tid, fid FROM records WHERE (vid + tid + fid) % 101 <> 0
  UNION ALL SELECT vid, tid, fid FROM records WHERE (vid + tid + fid) % 103 = 0 AND (vid + tid + fid) % 101 <> 0
  UNION ALL SELECT vid, tid, fid + 200 FROM records WHERE (vid + tid + fid) % 107 = 0""",
    ),
    "tracklets": (
        ("records", "seg"),
        """SELECT r.vid, r.tid, present, n_records, (coalesce(CAST(h AS DOUBLE) / nullif(n, 0), 1e9)) / 1e9 AS mean_confidence,
    coalesce(top, 1.0) AS max_confidence, first_fid, coalesce(w.refusals, '') AS refusals
  FROM (SELECT vid, tid, count(*) FILTER (reason IS NULL) AS present, count(*) AS n_records,
               CAST(sum(CAST(round(confidence * 1e9) AS BIGINT)) AS BIGINT) AS h, count(confidence) AS n, max(confidence) AS top,
               min(fid) FILTER (reason IS NULL) AS first_fid
        FROM records JOIN seg USING (vid) WHERE fid BETWEEN seg_begin AND seg_end GROUP BY vid, tid) r
  LEFT JOIN (SELECT vid, tid, string_agg(reason || ':' || k, ',' ORDER BY reason || ':' || k) AS refusals FROM (
      SELECT vid, tid, reason, count(*) AS k FROM records JOIN seg USING (vid)
      WHERE reason IS NOT NULL AND fid BETWEEN seg_begin AND seg_end GROUP BY vid, tid, reason) GROUP BY vid, tid) w
    USING (vid, tid) WHERE present > 0""",
    ),
    "captions": (
        ("triples",),
        """SELECT vid, s, p, o, CASE WHEN (vid + 3 * s + 5 * o) % 4 <> 1 THEN 'obj' || s || ' ' || p || ' obj' || o END AS txt,
    (vid + s + o) % 3 <> 0 AS s_named, (vid + 2 * s + o) % 3 <> 1 AS o_named
  FROM triples WHERE (vid + 3 * s + 5 * o) % 4 <> 0""",
    ),
    "samples": (
        ("triples", "captions", "tracklets"),
        """SELECT vid, s, p, o, disposition, n_tracklets, n_groups, CASE WHEN disposition <> '' THEN txt IS NOT NULL AND
      ((n_tracklets = 0 AND n_groups = 0 AND disposition = 'missing_main_referent')
      OR (n_tracklets > 0 AND n_tracklets = n_groups AND main)) END AS valid
  FROM (SELECT vid, s, p, o, txt, main, n_groups, CASE WHEN NOT given THEN '' WHEN NOT sm THEN 'missing_main_referent'
          WHEN complete THEN 'complete_bcc' WHEN main THEN 'incomplete_context' ELSE 'missing_main_referent' END
          AS disposition, CASE WHEN NOT given OR complete THEN n_all WHEN NOT sm OR main THEN n_groups ELSE 0 END
          AS n_tracklets
    FROM (SELECT *, CAST(sg AS BIGINT) + CAST(og AS BIGINT) AS n_groups, sg AND s <> o AS main,
            CAST(sm AS BIGINT) + CAST(s <> o AND om AS BIGINT) AS n_all,
            sm AND txt IS NOT NULL AND om AND (NOT sm OR sg) AND (NOT (s <> o AND om) OR og) AS complete
      FROM (SELECT t.vid, t.s, t.p, t.o, txt, c.vid IS NOT NULL AS given, a.tid IS NOT NULL AS sm, b.tid IS NOT NULL AS om,
              a.tid IS NOT NULL AND coalesce(txt IS NOT NULL AND s_named, false) AS sg,
              t.s <> t.o AND b.tid IS NOT NULL AND coalesce(txt IS NOT NULL AND o_named, false) AS og
        FROM triples t LEFT JOIN captions c ON t.vid = c.vid AND t.s = c.s AND t.p = c.p AND t.o = c.o
        LEFT JOIN tracklets a ON a.vid = t.vid AND a.tid = t.s LEFT JOIN tracklets b ON b.vid = t.vid AND b.tid = t.o)))""",
    ),
}


def sql(final: str, *needs: str, recursive: str = "") -> str:
    """`final` under the parts it needs, each once and in order."""
    order: list[str] = []

    def add(name: str) -> None:
        for other in PARTS[name][0]:
            add(other)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    parts = [f"{n} AS (\n  {PARTS[n][1]})" for n in order] + ([recursive] if recursive else [])
    if not parts:
        return final
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + final
