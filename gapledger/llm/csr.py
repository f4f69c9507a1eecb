"""Sparse matrices in compressed rows, with Gustavson's row product."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Products of entries that one step of a row product holds at a time.
_STEP = 2_000_000


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers ``starts[i] ... starts[i] + lengths[i] - 1``, one range after the other."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)


@dataclass
class Csr:
    """Row i holds ``data[k]`` in column ``indices[k]``, for k from ``indptr[i]`` up to ``indptr[i + 1]``."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    @property
    def row_of(self) -> np.ndarray:
        """Row of each entry."""
        return np.repeat(np.arange(self.rows), np.diff(self.indptr))

    @classmethod
    def of_cells(cls, row: np.ndarray, column: np.ndarray, data: np.ndarray, rows: int, columns: int) -> Csr:
        """From entries in any order; those of one cell are added up."""
        cell = row * max(columns, 1) + column
        cells, at = np.unique(cell, return_inverse=True)
        added = np.bincount(at, data, len(cells)).astype(np.int64) if len(cells) else np.zeros(0, np.int64)
        held = cells // max(columns, 1)
        return cls(np.searchsorted(held, np.arange(rows + 1)), cells % max(columns, 1), added, columns)

    @classmethod
    def of_lengths(cls, lengths: np.ndarray) -> Csr:
        """Incidence of consecutive strings and their bytes: row i has ones for its ``lengths[i]`` bytes."""
        ends = np.r_[0, np.cumsum(lengths)].astype(np.int64)
        return cls(ends, np.arange(ends[-1]), np.ones(ends[-1], np.int64), int(ends[-1]))

    @classmethod
    def of_members(cls, group: np.ndarray, groups: int) -> Csr:
        """Incidence of members and groups: row i has a one in column ``group[i]``."""
        return cls(np.arange(len(group) + 1), group, np.ones(len(group), np.int64), groups)

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        starts = np.r_[0, np.cumsum(np.bincount(self.indices, minlength=self.columns))].astype(np.int64)
        return Csr(starts, self.row_of[order], self.data[order], self.rows)

    def _steps(self, other: Csr) -> Iterator[tuple[int, int]]:
        """Runs of rows whose products are about ``_STEP``, or one row with more."""
        work = np.r_[0, np.cumsum(np.diff(other.indptr)[self.indices])][self.indptr]
        first = 0
        while first < self.rows:
            last = int(np.searchsorted(work, work[first] + _STEP, "right")) - 1
            last = min(max(last, first + 1), self.rows)
            yield first, last
            first = last

    def times(self, other: Csr) -> Csr:
        """Gustavson's product: row i is the sum of the rows of ``other`` that row i names, each times its entry.

        The rows of a step are worked out together: their products are laid out row by row
        and those that meet in one cell are added up.
        """
        if self.columns != other.rows:
            raise ValueError(f"{self.columns} columns against {other.rows} rows")
        parts: list[Csr] = []
        for first, last in self._steps(other):
            inner = self.indices[self.indptr[first] : self.indptr[last]]
            width = other.indptr[inner + 1] - other.indptr[inner]
            at = ranges(other.indptr[inner], width)
            row = np.repeat(np.arange(last - first), np.diff(self.indptr[first : last + 1]))
            values = np.repeat(self.data[self.indptr[first] : self.indptr[last]], width) * other.data[at]
            parts.append(
                Csr.of_cells(np.repeat(row, width), other.indices[at], values, last - first, other.columns)
            )
        filled = np.cumsum([0, *[len(p.indices) for p in parts]])
        ends = [p.indptr[1:] + before for p, before in zip(parts, filled, strict=False)]
        joined = lambda arrays: np.concatenate([np.zeros(0, np.int64), *arrays])
        return Csr(
            np.r_[0, joined(ends)].astype(np.int64), joined([p.indices for p in parts]), joined([p.data for p in parts]),
            other.columns,
        )
