"""Settings of planning, merging and campaigns, checked against each other."""

from __future__ import annotations

import os
import datetime
import subprocess
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path

# What settings may say.
POLICIES = ("human", "human_gap", "hq")
GAP_FILLS = ("human", "any")
FALLBACKS = ("least-flagged", "refuse")
DISPUTE_RULES = ("refuse", "forward_score", "higher_score")
WINNERS = ("strong", "weak")
DIRECTIONS = ("forward", "backward", "both")
SPLITS = ("train", "val", "test")


@dataclass(frozen=True)
class Gate:
    """Thresholds of the keyframe quality gate."""

    edge_tol: int = 2
    edge_touches: int = 2
    edge_size: float = 0.8
    overlap_most: float = 0.6
    overlap_over_median: float = 0.2
    motion_most: float = 0.05
    size_least: float = 0.6
    blur_of_median: float = 0.4
    blur_least: float = 20.0
    keep_span_edges: bool = True


@dataclass(frozen=True)
class Merge:
    """How a forward and a backward mask of one object become one."""

    agree_iou: float = 0.3
    floor: int = 20
    ratio: float = 0.1
    rule: str = "higher_score"
    score: float | None = 0.907
    winner: str = "strong"

    def __post_init__(self):
        if self.rule not in DISPUTE_RULES:
            raise ValueError(f"rule is one of {DISPUTE_RULES}")
        if self.winner not in WINNERS:
            raise ValueError(f"winner is one of {WINNERS}")
        if (self.rule == "refuse") != (self.score is None):
            raise ValueError("a score rule needs a threshold, and `refuse` takes none")


@dataclass(frozen=True)
class Settings:
    max_objects: int = 16
    max_anchors: int = 16
    max_gap: int = 60
    gap_fill: str = "human"
    policy: str = "human_gap"
    fallback: str = "least-flagged"
    direction: str = "both"
    max_attempts: int = 2
    max_interruptions: int = 5
    gate: Gate = field(default_factory=Gate)
    merge: Merge = field(default_factory=Merge)

    def __post_init__(self):
        if self.max_anchors == 1:
            raise ValueError("max_anchors is 0 (no cap) or at least 2")
        for name, allowed in (("gap_fill", GAP_FILLS), ("policy", POLICIES), ("fallback", FALLBACKS), ("direction", DIRECTIONS)):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} is one of {allowed}")

    def echo(self) -> dict:
        """What every run records of its settings."""
        return asdict(self)


#: The model that records name, where a tracklet's masks may come from, and what a relation's record may be.
MODEL, MODEL_VERSION = "sam3.1-object-multiplex", "3.1"
SOURCES = ("ground_truth", "sam3.1_main_referent", "sam3.1_context")
DISPOSITIONS = ("complete_bcc", "incomplete_context", "missing_main_referent", "negative_unsegmentable")


@dataclass(frozen=True)
class Stamps:
    """What is the same for all records of a run; worked out once, on the driver, and kept out of hashes."""

    checkpoint_hash: str = "0" * 64
    code_commit: str = ""
    created_at: str = ""
    model: str = MODEL
    version: str = MODEL_VERSION

    @classmethod
    def now(cls, checkpoint_hash: str = "0" * 64) -> Stamps:
        at = datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="seconds")
        return cls(checkpoint_hash=checkpoint_hash, code_commit=code_commit(), created_at=at)


def code_commit(folder: Path | None = None) -> str:
    """The commit of the code's checkout, marked if it has been changed; never empty."""
    git = ["git", "-C", str(folder or Path(__file__).parent)]
    try:
        head = subprocess.run([*git, "rev-parse", "--short", "HEAD"], capture_output=True, text=True, check=True, timeout=20)
        changed = subprocess.run([*git, "status", "--porcelain", "."], capture_output=True, text=True, timeout=20)
    except (OSError, subprocess.SubprocessError):
        return "no-checkout"
    return head.stdout.strip() + ("-dirty" if changed.stdout.strip() else "")


@dataclass(frozen=True)
class Roots:
    """Where a data set's files lie; each root falls back on its own: argument, environment, default."""

    relations: str = "relations"
    annotations: str = "annotations"
    videos: str = "videos"
    transcoded: str = "transcoded"

    @classmethod
    def of(cls, given: dict | None = None, env: dict | None = None) -> Roots:
        given, env = given or {}, os.environ if env is None else env
        names = [f.name for f in fields(cls)]
        return cls(**{n: given.get(n) or env.get(f"TRACKSET_{n.upper()}") or getattr(cls, n) for n in names})
