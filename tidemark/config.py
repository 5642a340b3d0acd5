"""Tunable constants of the pipeline; each can be replaced by dataclasses.replace."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class Config:
    # fixed values: defaults of the pipeline
    command_chars: int = 4000
    sample_sessions: int = 50
    top_siblings: int = 8
    occurrence_base: float = 1e5
    ips_base: float = 1e4
    session_commands_base: float = 1e3
    ip_sessions_base: float = 1e5
    ip_duration_base: float = 3600.0
    pool_documents: float = 1e5
    scalar_weight: float = 0.05
    merge_similarity: float = 0.96
    merge_slack: float = 0.03
    credential_bins: int = 16
    credential_cap: int = 200
    itemset_support: int = 5
    itemset_least: int = 2
    itemset_most: int = 6
    infra_sessions: int = 3
    infra_ips: int = 2
    fingerprint_artifacts: int = 10
    low_confidence: int = 4
    novel_at: float = 0.5
    novel_confidence: int = 4
    base64_run: int = 200
    sample_rate: float = 0.0
    suspicious_tlds: tuple[str, ...] = ("xyz", "top", "tk", "ml", "ga", "cf", "gq", "club", "icu", "buzz", "monster", "rest", "bar", "fit", "online", "site", "stream", "cam")
    priority_weights: tuple[float, float, float, float] = (0.50, 0.20, 0.15, 0.15)
    half_life_hours: float = 168.0
    centrality_base: float = 1000.0
    cluster_samples: int = 5


DEFAULT = Config()


def load(*files: str, environment: dict[str, str] | None = None, prefix: str = "TIDEMARK_") -> Config:
    """The defaults, overlaid by JSON files in order and then by the environment (PREFIX_NAME, values in JSON).

    A file that is missing is skipped; a name that is no setting is an error.
    """
    known = {f.name: f.type for f in fields(Config)}
    found: dict = {}
    for file in files:
        if Path(file).is_file():
            found |= json.loads(Path(file).read_text())
    for name, value in (os.environ if environment is None else environment).items():
        if name.startswith(prefix) and name[len(prefix) :].lower() in known:
            found[name[len(prefix) :].lower()] = json.loads(value)
    if unknown := sorted(set(found) - set(known)):
        raise ValueError(f"no such settings: {unknown}")
    return replace(DEFAULT, **{k: tuple(v) if isinstance(v, list) else v for k, v in found.items()})
