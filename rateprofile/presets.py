"""Ready configurations of the command line (``--preset``)."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: four tournaments, their names, what is fitted and what is held out ---
COHORTS = (
    (43, 106, "FIFA World Cup 2022"),
    (55, 282, "UEFA Euro 2024"),
    (72, 107, "Women's World Cup 2023"),
    (53, 106, "UEFA Women's Euro 2022"),
)
TRAIN = ((43, 106), (55, 282))
TEST = ((72, 107), (53, 106))
K_OVERRIDE = 5
# --- end of fixed values ------------------------------------------------------------------


@dataclass(frozen=True)
class Preset:
    """(competition, season, name) of the cohorts, which are fitted on and held out, and the k of the global fit."""

    cohorts: tuple[tuple[int, int, str], ...]
    train: tuple[tuple[int, int], ...]
    test: tuple[tuple[int, int], ...]
    k: int | None


PRESETS = {"tournaments": Preset(COHORTS, TRAIN, TEST, K_OVERRIDE)}
