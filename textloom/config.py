"""Every knob of the curation pipeline, from defaults or TOML."""

from __future__ import annotations

import dataclasses
import tomllib
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Clean:
    document_min_words: int = 25
    sentence_min_words: int = 5
    ufffd_reject_ratio: float = 0.005
    max_repeated_run: int = 3
    symbol_ratio_review: float = 0.5


@dataclass(frozen=True)
class Lid:
    backend: str = "ngram_bayes"
    target: str = "so"
    min_confidence: float = 0.5
    detect_clip_bytes: int = 2000


@dataclass(frozen=True)
class NearDedup:
    shingle_k: int = 3
    k_hashes: int = 64
    bands: int = 16
    rows: int = 4
    tau: float = 0.8
    seed: int = 0
    empty_sets_match: bool = False

    def __post_init__(self):
        if self.bands * self.rows != self.k_hashes:
            raise ValueError("bands times rows must be k_hashes")
        if not 0 <= self.tau <= 1:
            raise ValueError("tau must lie in [0, 1]")
        if self.shingle_k < 1:
            raise ValueError("shingle_k must be at least 1")


@dataclass(frozen=True)
class DeepClean:
    unescape_sources: tuple[str, ...] = ("madlad",)
    strip_fragment_sources: tuple[str, ...] = ("opus",)
    mojibake_max_passes: int = 5
    strip_stray_ufffd: bool = True
    strip_benign_html: bool = True
    reject_script_html: bool = True
    mask_urls: bool = True
    mask_emails: bool = True
    boilerplate_line_drop: bool = True
    boilerplate_reject_ratio: float = 0.4
    symbol_ratio_reject: float = 0.45
    symbol_ratio_review: float = 0.35
    max_document_words: int = 10_000
    paragraph_dedup: bool = True
    paragraph_separator: str = "\n\n"
    paragraph_jaccard_tau: float = 0.95
    segment_lid: bool = True
    min_target_char_frac: float = 0.6
    segment_min_confidence: float = 0.5
    segment_clip_bytes: int = 1024
    function_words: tuple[str, ...] = ("iyo", "oo", "waa", "waxaa", "waxa", "uu", "ay", "aan", "la", "ku", "ka", "in")


@dataclass(frozen=True)
class Config:
    merge_source_order: tuple[str, ...] = ("quran", "mt560", "opus", "cc100", "mc4", "madlad", "wikipedia", "hplt")
    clean: Clean = field(default_factory=Clean)
    lid: Lid = field(default_factory=Lid)
    near_dedup: NearDedup = field(default_factory=NearDedup)
    deep_clean: DeepClean = field(default_factory=DeepClean)

    def __post_init__(self):
        if not self.merge_source_order:
            raise ValueError("merge_source_order is empty")


def from_toml(text: str) -> Config:
    """Config from TOML; unknown keys are errors, missing ones take their defaults."""
    data = tomllib.loads(text)
    data.pop("version", None)
    parts = {"clean": Clean, "lid": Lid, "near_dedup": NearDedup, "deep_clean": DeepClean}
    made = {}
    for k, v in data.items():
        if k in parts:
            made[k] = parts[k](**{n: tuple(x) if isinstance(x, list) else x for n, x in v.items()})
        elif k == "merge_source_order":
            made[k] = tuple(v)
        else:
            raise ValueError(f"unknown key {k}")
    return Config(**made)


def to_toml(cfg: Config) -> str:
    def show(v) -> str:
        if isinstance(v, bool):
            return str(v).lower()
        if isinstance(v, (list, tuple)):
            return "[" + ", ".join(map(show, v)) + "]"
        return '"' + v.replace("\\", "\\\\").replace("\n", "\\n").replace('"', '\\"') + '"' if isinstance(v, str) else repr(v)

    out = [f"merge_source_order = {show(cfg.merge_source_order)}"]
    for name in ("clean", "lid", "near_dedup", "deep_clean"):
        out += ["", f"[{name}]", *(f"{k} = {show(v)}" for k, v in dataclasses.asdict(getattr(cfg, name)).items())]
    return "\n".join(out) + "\n"
