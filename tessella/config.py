"""Settings of the linkage engine."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Prune:
    """Adaptive pruning: floors are shares of the best score, caps are candidates kept."""

    confident: float = 0.85
    usable: float = 0.15
    floor_confident: float = 0.28
    floor: float = 0.17
    cap_confident: int = 30
    cap: int = 45
    fallback: int = 3


@dataclass(frozen=True)
class Rule:
    """Set selection: no match below ``single``; keep p >= max(match, share * best), ``cap`` at most."""

    single: float = 0.70
    match: float = 0.60
    share: float = 0.70
    cap: int = 12


@dataclass(frozen=True)
class Config:
    """``df_frac``: features in more than this share of a block's records are dropped (see README on small blocks)."""

    k: int = 50
    df_frac: float = 0.001
    buckets: int = 1 << 22
    hashed: bool = True
    score_digits: int | None = None
    prune: Prune = field(default_factory=Prune)
    rule: Rule = field(default_factory=Rule)
