"""Options of the stages with their usual values, limits on rounds, and a readable form of nested settings."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Batch:
    """What part of the work is done."""

    index_part: int = 0
    num_parts: int = 1
    redo: bool = False


@dataclass(frozen=True)
class Retrieval(Batch):
    """How references are looked for."""

    engine: str = "integrate"
    score_limit: float = 0.5
    accept: float = 0.95
    keep: int = 3
    wide: int = 5
    check_notes: bool = True


@dataclass(frozen=True)
class Quality(Batch):
    """How results are graded."""

    upper: float = 0.95
    lower: float = 0.5


@dataclass(frozen=True)
class Conversion(Batch):
    """How strictly papers are read: what raises, and what is only reported in the status (C14)."""

    raise_on_unknown_text: bool = True
    raise_on_many_notes: bool = False
    pass_notes: bool = False


class TooManyRounds(RuntimeError):
    """A loop that should have ended has not."""


@dataclass
class Rounds:
    """A guard of loops (C9): counts rounds and raises at the most that are allowed."""

    most: int = 100
    n: int = 0

    def next(self) -> int:
        self.n += 1
        if self.n >= self.most:
            raise TooManyRounds(f"{self.most} rounds")
        return self.n


def pretty(value: object, indent: int = 0) -> str:
    """Nested settings, one on a line as ``key ---> value``."""
    if not isinstance(value, dict):
        return f"{' ' * indent}{value}"
    lines = []
    for k, v in value.items():
        lines.append(f"{' ' * indent}{k} ---> {v}" if not isinstance(v, dict) else f"{' ' * indent}{k} --->\n{pretty(v, indent + 4)}")
    return "\n".join(lines)
