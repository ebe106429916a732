"""Row counts of one step."""

from __future__ import annotations

from typing import NamedTuple


class Counts(NamedTuple):
    read: int = 0
    valid: int = 0
    rejected: int = 0
