"""Run settings, and how a trajectory table is keyed and ordered."""

from __future__ import annotations

from dataclasses import dataclass, replace

from skyload.constants import KEY, METRE_IN_FT


@dataclass(frozen=True)
class Settings:
    """Switches of a run; the defaults give the tabular pipeline."""

    use_trajectory: bool = False
    manual_phases: bool = False
    refine_phases: bool = False
    use_external_data: bool = True
    use_all_features: bool = False
    num_features: int = 15
    contamination: float = 0.01
    n_trials: int = 50
    timeout: float | None = None
    learner: str = "gbt"
    wind_factor: float = METRE_IN_FT
    altitude_factor: float = 1.0


@dataclass(frozen=True)
class Course:
    """How points of one flight are told apart and put in order.

    ``ties`` are columns that break ties in ``time``, so that the order is
    total; without any, all other columns do. Flights with more than ``long_rows`` points are worked on in row
    ranges of that length instead of in one task.
    """

    key: str = KEY
    time: str = "timestamp"
    ties: tuple[str, ...] = ()
    long_rows: int = 250_000

    def over(self, columns: list[str]) -> Course:
        """The same with ties: all other columns of a table in the order of their names, unless some are given."""
        others = tuple(sorted(c for c in columns if c not in (self.key, self.time)))
        return self if self.ties else replace(self, ties=others)

    @property
    def order(self) -> list[str]:
        return [self.time, *self.ties]
