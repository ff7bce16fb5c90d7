"""Parameters of the recommendation job (the six positional arguments of
the original batch job, plus the choices our contract makes explicit)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RecConfig:
    # similarity
    sample_rate: float = 1.0        # P7: keep users when 0 < rate < 1
    sample_seed: str = ""           # P7: prefix of the hashed user id
    sample_exact: bool = False      # P10: exactly floor(users x rate) users
    top_n: int = 10                 # T1: similar items kept per item
    normalize: bool = True          # T5: divide by the row maximum
    dedup: bool = True              # Q4: count each (user, item) once
    lenient: bool = False           # Q8: drop bad tokens instead of failing
    min_items: int = 2              # P5: history must hold more than one item
    block_size: int = 4096          # J1: items per block when a history is split
    # recommendation
    top_k: int = 10                 # T3: recommendations kept per user
    scoring: str = "candidate"      # "candidate" (J5) or "source" (J6)
    reverse_limit: int = 100        # J5: items in more lists are scored from the candidate side
    label: str = "code"             # S2: dictionary label column, "code" or "name"
    missing_label: str = "drop"     # J7 "drop", J8 "empty", J9 "error"
    score_decimals: int = 6         # ranking and output precision of scores
    # sink (K1-K6)
    layout: str = "source_recom"    # "source_recom" (K6), "user_watched" (K5), "scored_list" (K7)
    trailing_separator: bool = False  # Q14: old layouts end every item with the separator

    def __post_init__(self):
        if self.top_n < 1 or self.top_k < 1:
            raise ValueError("top_n and top_k must be at least 1")
        if self.scoring not in ("candidate", "source"):
            raise ValueError(f"unknown scoring mode {self.scoring!r}")
        if self.missing_label not in ("drop", "empty", "error"):
            raise ValueError(f"unknown missing_label {self.missing_label!r}")
        if self.block_size < 1:
            raise ValueError("block_size must be positive")
