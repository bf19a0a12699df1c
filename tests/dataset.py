"""A small annotated data set, written as files: four videos of different sizes with relations, and one without."""

import json

#: Video: width, height, frames.
SIZES = {"501": (96, 60, 15), "502": (64, 80, 10), "503": (40, 40, 6), "504": (48, 48, 8), "505": (32, 32, 4)}
WALK, CARRY, CROWD, BEHIND = "501", "502", "503", "504"


def boxes():
    """Of each video (object, frame, box, drawn by a person)."""
    walk = [(0, f, (4 + f, 8, 30 + f, 40), f % 5 == 0) for f in range(15)]
    walk += [(1, f, (50, 20, 80, 50), f in (4, 9, 14)) for f in range(3, 15)]
    walk += [(5, f, (0, 0, 12, 12), False) for f in range(15)]
    carry = [(0, f, (5, 5, 40, 70), f % 2 == 0) for f in range(10)] + [(1, f, (10, 10, 20, 20), f % 3 == 0) for f in range(10)]
    crowd = [(t, f, (t, 2 * t % 30, t + 8, 2 * t % 30 + 6), True) for t in range(18) for f in range(6)]
    behind = [(2, f, (1, 1, 20, 20), f in (0, 7)) for f in range(8)] + [(3, f, (25, 25, 40, 40), f == 3) for f in range(8)]
    return {"501": walk, "502": carry, "503": crowd, "504": behind, "505": [(0, 0, (0, 0, 9, 9), True)]}


#: Split: video, subject, predicate, object, first and last frame.
RELATIONS = {
    "train": [("501", 0, "lead", 1, 0, 14), ("501", 0, "walk-by,near", 5, 1, 10)],
    "val": [("502", 0, "carry", 1, 0, 9), ("504", 2, "behind", 3, 1, 6)],
    "test": [("503", t, "beside", t + 1, 0, 5) for t in range(17)],
}


def annotation(vid, rows):
    width, height, n = SIZES[vid]
    frames = [[] for _ in range(n)]
    for tid, fid, box, human in rows:
        side = dict(zip(("xmin", "ymin", "xmax", "ymax"), box))
        frames[fid].append({"tid": tid, "bbox": side, "generated": int(not human), "tracker": "none" if human else "auto"})
        if fid == 1 and tid == 1:  # a second box of the same object in the frame, which does not count
            frames[fid].append({"tid": tid, "bbox": dict.fromkeys(side, 0), "generated": 0, "tracker": "none"})
    named = sorted({r[0] for r in rows})
    return {
        "video_id": vid, "video_path": f"a/{vid}.mp4", "frame_count": n, "fps": 25.0, "width": width, "height": height,
        "subject/objects": [{"tid": t, "category": f"kind{t}"} for t in named], "trajectories": frames,
    }


def relation(vid, s, p, o, first, last):
    """Its category list also names an object that takes no part."""
    width, height, n = SIZES[vid]
    return {
        "vid": vid, "fps": 25.0, "frame_count": n, "width": width, "height": height,
        "used_segment": {"begin_fid": first, "end_fid": last},
        "used_relation": {"subject_tid": s, "object_tid": o, "predicate": p, "begin_fid": first, "end_fid": last},
        "subject/objects": [{"tid": t, "category": f"kind{t}/sub"} for t in (*sorted({s, o}), 90)],
    }


def write(root):
    """Write everything below root; returns the relation and annotation folders."""
    (root / "relations" / "annotations").mkdir(parents=True)
    for split, rows in RELATIONS.items():
        # one of the splits lies beside the folder
        where = root / "relations" / ("" if split == "val" else "annotations") / f"{split}.json"
        where.write_text(json.dumps([relation(*r) for r in rows]))
    for k, (vid, rows) in enumerate(boxes().items()):
        folder = root / "annotations" / ("here" if k % 2 else "far/below")
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{vid}.json").write_text(json.dumps(annotation(vid, rows)))
    (root / "annotations" / "notes.json").write_text("[]")
    return str(root / "relations"), str(root / "annotations")
