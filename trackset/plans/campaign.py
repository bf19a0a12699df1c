"""The commands over annotation files: doctor, worklist, plan, process, status, export, correspondence, requeue.

Below `out`: worklist (with worklist.json), records, errors, runs, export and correspondence.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackset import scratch
from trackset.config import SOURCES, Roots, Settings, Stamps
from trackset.functions import rle
from trackset.operators import audit, combine, correspondence, coverage, gate, planning, prompts, records, units
from trackset.sources import files, sinks
from trackset.sources.masks import MaskSource

WORKLIST_VERSION = "tracks-worklist-v1"
RECORD_VERSION = "tracks-record-v1"
KEY = ["vid", "fid", "tid"]


@dataclass
class Campaign:
    spark: SparkSession
    roots: Roots
    settings: Settings
    out: str
    dataset: str = "set"

    def __post_init__(self):
        self.relations = files.relations(self.spark, self.roots.relations)
        self.annotations = files.annotations(self.spark, self.roots.annotations)
        self.raw = files.boxes(self.annotations)
        self.videos = self.annotations.select("vid", "frame_count", "width", "height", "video_path")

    @cached_property
    def plan(self) -> planning.Plan:
        """The plan over tracks that are written once. Objects without any box are an error."""
        plan = planning.Plan(self.raw, self.relations, self.videos, self.settings)
        bare = planning.unboxed(plan.tids.join(self.videos, "vid", "left_semi"), self.raw).limit(5).collect()
        if bare:
            raise ValueError(f"relation objects without a box: {[tuple(r) for r in bare]}")
        return plan.shared()

    def doctor(self) -> DataFrame:
        """check, ok, detail."""
        lost = units.unannotated(self.relations, self.videos).agg(F.count(F.lit(1)).alias("n"))
        tids = units.relation_tids(self.relations)
        bare = planning.unboxed(tids.join(self.videos, "vid", "left_semi"), self.raw).agg(F.count(F.lit(1)).alias("n"))
        counts = units.known_counts(self.relations).where("scope = 'all'")
        twice = self.annotations.groupBy("vid").count().where("count > 1").agg(F.count(F.lit(1)).alias("n"))
        none = lambda df, check: df.select(F.lit(check).alias("check"), (F.col("n") == 0).alias("ok"), F.col("n").cast("string").alias("detail"))
        text = F.concat_ws(" ", *(F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in ("records", "videos", "pairs")))
        out = none(lost, "every video has an annotation").unionByName(none(bare, "every object has a box"))
        out = out.unionByName(none(twice, "every video has one annotation"))
        return out.unionByName(counts.select(F.lit("records found").alias("check"), (F.col("records") > 0).alias("ok"), text.alias("detail")))

    # worklist

    def build_worklist(self, expected: dict[str, int] | None = None, vids: DataFrame | None = None, limit: int = 0) -> DataFrame:
        """Write the units and their counts. Counts that are not as expected, and videos without an annotation, are errors
        before anything is written. `vids` (nth, vid) selects units, `limit` takes the first."""
        if expected:
            found = units.known_counts(self.relations).where("scope = 'all'").first().asDict()
            wrong = {k: (found[k], n) for k, n in expected.items() if found[k] != n}
            if wrong:
                raise ValueError(f"counts differ from what is known: {wrong}")
        wanted = self.relations if vids is None else self.relations.join(vids.select("vid").distinct(), "vid", "left_semi")
        lost = [r["vid"] for r in units.unannotated(wanted, self.videos).limit(10).collect()]
        if lost:
            raise ValueError(f"videos without an annotation: {lost}")
        rows = units.first_units(units.units(wanted, self.videos), limit)
        sinks.parquet(rows, f"{self.out}/worklist")
        written = self.spark.read.parquet(f"{self.out}/worklist")
        counts = units.unit_counts(written, written.limit(0), self.settings).first().asDict()
        split = {r["split"]: r["units"] for r in units.by_split(written).collect()}  # a row for each set of splits
        facts = {"version": WORKLIST_VERSION, "counts": counts | {"by_split": split}, "settings": self.settings.echo()}
        sinks.manifest(self.spark, f"{self.out}/worklist.json", facts)
        return written

    def worklist(self) -> DataFrame:
        """The written units; another version is an error."""
        version = sinks.read_manifest(self.spark, f"{self.out}/worklist.json").get("version")
        if version != WORKLIST_VERSION:
            raise ValueError(f"worklist of version {version}, not {WORKLIST_VERSION}")
        return self.spark.read.parquet(f"{self.out}/worklist")

    # planning

    def anchors(self) -> DataFrame:
        """vid, tid, fid, is_ref, fill under the settings' policy; `hq` needs blur scores only for the blur flag."""
        if self.settings.policy == "human":
            return self.plan.human.withColumn("fill", F.lit(None).cast("string"))
        every = coverage.human_gap(self.plan) if self.settings.policy == "human_gap" else gate.anchors(self.plan)
        return every.select("vid", "tid", "fid", "is_ref", "fill")

    def refused(self) -> DataFrame:
        return gate.refusals(self.plan) if self.settings.policy == "hq" else self.plan.refused

    def schedule(self) -> DataFrame:
        """The prompts in the order they are sent; prompts that a session would not take are an error when it is read."""
        anchors = scratch.written(self.anchors(), "anchors")
        co = scratch.written(prompts.co_prompts(anchors, self.plan.boxes), "co-prompts")
        prompted = anchors.select(*KEY).unionByName(co.select(*KEY))
        return prompts.checked(prompts.schedule(anchors, co, prompts.negative_clicks(prompted, self.plan.boxes)))

    def plan_lines(self) -> DataFrame:
        return records.plan_lines(self.plan.clips, self.plan.spans, self.anchors(), self.refused(), units.categories(self.relations))

    # processing

    def process(self, source: MaskSource, clips: DataFrame, done: DataFrame | None = None) -> DataFrame:
        """Records of the units that are not done: prompts, the passes of the settings' direction, and their merge."""
        pending = lambda df: df if done is None else df.join(done.select("vid").distinct(), "vid", "left_anti")
        refused = self.refused()
        frames, schedule = pending(self.plan.records), pending(self.schedule())
        one = lambda d, m, c: source.masks(schedule, d).select(*KEY, rle.counts_intervals("counts").alias(m), F.col("conf").alias(c))
        if self.settings.direction != "both":
            masks = one(self.settings.direction, "mask", "confidence")
            rows = records.single_pass_records(frames, refused, masks, clips, want_boxes=True)
            way = F.when(F.col("reason").isNull(), F.lit(self.settings.direction))
            return rows.withColumn("source", way).withColumn("area", F.when(F.col("reason").isNull(), rle.area(F.col("mask"))))
        planned = frames.join(refused, ["vid", "tid"], "left_anti").select(*KEY)
        pairs = planned.join(one("forward", "fwd", "fconf"), KEY, "left").join(one("backward", "bwd", "bconf"), KEY, "left")
        merge = self.settings.merge
        decided = combine.decisions(combine.tiebreaks(combine.readings(pairs, merge), merge), merge)
        return records.merged_records(frames, refused, decided, clips)

    def process_one(self, source: MaskSource, vid: str, clips: DataFrame) -> DataFrame:
        """Records of one video."""
        others = self.relations.where(F.col("vid") != vid).select("vid").distinct()
        return self.process(source, clips, others)

    def write(self, processed: DataFrame, stamps: Stamps | None = None) -> int:
        """Keep flat records below `out`, each video in its own folder; the number of records."""
        splits = self.relations.groupBy("vid").agg(F.min("split").alias("split"))
        flat = records.stamped(processed, self.anchors(), splits, self.videos, self.settings, stamps or Stamps.now())
        return sinks.json_lines(flat, f"{self.out}/records")

    def records(self) -> DataFrame:
        """What has been written, all videos."""
        kinds = self.spark.read.option("ignoreNullFields", "false")
        schema = (
            "tid long, fid long, model string, checkpoint_hash string, version string, code_commit string, created_at string, tracker string, prompt_mode string, "
            "policy string, anchors array<long>, has_gap boolean, negatives_ok boolean, direction string, has_merge boolean, generated long, split string, "
            "reason string, rle_h long, rle_w long, counts string, confidence double, payload string, vid string"
        )
        return kinds.schema(schema).option("allowNonNumericNumbers", "true").json(f"{self.out}/records")

    def status(self, clips: DataFrame, errors: DataFrame | None = None, runs: DataFrame | None = None) -> dict[str, DataFrame]:
        """The ledger, a row for each unit, and the totals by status."""
        known, written = self.worklist(), self.records()
        none = "vid string, attempt long, interrupted boolean, cuda_oom boolean, error_type string"
        errors = self.spark.createDataFrame([], none) if errors is None else errors
        runs = self.spark.createDataFrame([], "vid string, wall_s double, vram_gb double") if runs is None else runs
        state = records.unit_status(known, written, errors.select("vid", "attempt", "interrupted", "cuda_oom"), self.settings)
        paths = self.videos.select("vid", F.col("video_path").alias("path"))
        ledger = records.ledger(known, state, records.run_totals(written), clips)
        ledger = scratch.written(records.with_costs(ledger, runs, errors, paths), "ledger")
        return {"ledger": ledger, "status": records.campaign_status(ledger), "costs": records.run_costs(ledger)}

    def requeue(self, ledger: DataFrame, copies: DataFrame) -> DataFrame:
        """Move the records of units that a transcoded copy (vid, path) repairs to `superseded`, so that they are pending
        again; vid and video_path of these units."""
        moved = scratch.written(records.requeued(ledger, copies), "requeued")
        rows = self.records()
        sinks.json_lines(rows.join(moved, "vid", "left_semi"), f"{self.out}/superseded")
        for r in moved.select("vid").toLocalIterator():  # refused units are few, and each is a folder
            where, fs = sinks._fs(self.spark, f"{self.out}/records/vid={r['vid']}")
            fs.delete(where, True)
        return moved

    # export

    def export(self, written: DataFrame, ledger: DataFrame | None = None) -> dict:
        """Masks and refusals tables of valid flat records, the ledger, and a manifest with all that is wrong."""
        written = scratch.written(written, "export")
        expected = self.plan.records.select("vid", "tid", "fid")
        found = scratch.written(audit.problems(written, expected, self.videos), "problems")
        masks, refusals = audit.split_tables(written)
        to = f"{self.out}/export"
        sinks.parquet(masks, f"{to}/masks")
        sinks.parquet(refusals, f"{to}/refusals")
        kinds = {r["kind"]: r["count"] for r in found.groupBy("kind").count().collect()}  # a row for each kind of problem
        valid = masks.select("vid", "split", "reason", "code_commit", "checkpoint_hash").unionByName(refusals.select("vid", "split", "reason", "code_commit", "checkpoint_hash"))
        totals = {r["split"]: r.asDict() for r in records.export_totals(valid).collect()}  # a row for each split
        why = {r["reason"]: r["n"] for r in records.by_reason(valid).collect()}  # one row for each reason code
        listed = [r.asDict() for r in audit.first_problems(found).orderBy("vid", "nth").limit(200).collect()]
        facts = {"problems": kinds, "listed": listed, "refusals": why, "by_split": totals, "ok": not kinds, "settings": self.settings.echo()}
        if ledger is not None:
            sinks.csv(ledger.drop("relations", "cats"), f"{to}/ledger")
            costs = records.run_costs(ledger).first()
            facts |= {"hours": costs["hours"], "vram_gb": costs["vram_gb"], "clips": {r["status"]: r["clips"] for r in records.campaign_status(ledger).collect()}}
        sinks.manifest(self.spark, f"{to}/manifest.json", facts)
        return facts

    def correspondence(self, processed: DataFrame, captions: DataFrame, schema_version: str = RECORD_VERSION) -> dict:
        """Write tracklets (of all relations), samples, links and verification tables, a JSON record for each relation that
        keeps the record contract, and a manifest with what is wrong with the others."""
        processed = scratch.written(processed, "processed")
        splits = self.relations.groupBy("vid").agg(F.concat_ws("+", F.sort_array(F.collect_set("split"))).alias("split"))
        triples = units.triples(self.relations).drop("ord").join(splits, "vid")
        segments = self.plan.segments
        tracks = scratch.written(correspondence.tracklets(processed, segments), "tracklets")
        sized = processed.join(self.videos.select("vid", "width", "height"), "vid")
        shape = F.array("height", "width").alias("size")
        mask = F.struct(shape, rle.runs("mask", F.col("height") * F.col("width")).alias("counts"))
        dense = correspondence.aligned(sized.withColumn("value", mask), segments, "value")
        dense = scratch.written(dense.select("vid", "tid", F.col("values").alias("masks"), "present"), "aligned")
        more = tracks.select("vid", "tid", F.col("mean_confidence").alias("confidence"), "max_confidence", "first_fid", "refusals")
        nested = correspondence.relation_records(triples, dense.join(more, ["vid", "tid"]), captions, segments, schema_version, SOURCES[1])
        names = correspondence.sample_ids(triples, self.dataset).select(*correspondence.RELATION, "sample_id")
        nested = scratch.written(nested.join(names, correspondence.RELATION).withColumn("problem", correspondence.record_problem(schema_version)), "relations")
        good, to = nested.where("problem IS NULL").drop("problem"), f"{self.out}/correspondence"
        sides = triples.select(*correspondence.RELATION, "split", F.explode(F.array_distinct(F.array("s", "o"))).alias("tid"))
        role = F.when((F.col("tid") == F.col("s")) & (F.col("s") != F.col("o")), "main_referent").otherwise("context_entity")
        every = sides.join(tracks, ["vid", "tid"], "left").withColumn("role", role).join(names, correspondence.RELATION)
        text = lambda *cs: [F.to_json(c, {"ignoreNullFields": "false"}).alias(f"{c}_json") for c in cs]
        common = ["sample_id", *correspondence.RELATION, "split", "expression_id", "text", "negative", "disposition"]
        tables = {
            "tracklets": every,
            "samples": good.select(*common, F.size("frame_ids").alias("frame_count"), F.size("tracklets").alias("tracklet_count"), *text("frame_ids", "frame_files", "span_links")),
            "verification": good.select(*common, *text("tracklets", "groups", "span_links")),
            "links": good.select("sample_id", "text", F.explode("span_links").alias("l")).select(
                "sample_id", "text", F.col("l.start").alias("span_start"), F.col("l.end").alias("span_end"), F.col("l.text").alias("span_text"), F.to_json("l.tracklet_ids").alias("tracklet_ids_json")
            ),
        }
        for name, table in tables.items():
            sinks.parquet(table, f"{to}/{name}")
        lines = good.withColumn("vid", F.col("vid").cast("string"))
        n_records = sinks.json_lines(lines, f"{to}/records")
        given = {r["disposition"]: r["count"] for r in good.groupBy("disposition").count().collect()}  # a row for each
        wrong = nested.where("problem IS NOT NULL")
        listed = [f"{r['sample_id']}: {r['problem']}" for r in wrong.orderBy("sample_id").limit(200).collect()]
        n_relations, n_captioned = triples.count(), nested.count()
        facts = {
            "schema_version": schema_version,
            "relations": n_relations,
            "relations_with_caption": n_captioned,
            "relations_without_caption": n_relations - n_captioned,
            "records_written": n_records,
            "tracklet_rows": every.count(),
            "dispositions": given,
            "problems": listed,
            "ok": not listed,
            "tables": sorted(tables),
        }
        sinks.manifest(self.spark, f"{to}/manifest.json", facts)
        return facts
