"""Errors raised by the value-set check before any data is compared."""

from __future__ import annotations

from .models import COL_MISSING, DF_EMPTY, SIDE_FLAGS, BOTH, LEFT_NOT_RIGHT, RIGHT_NOT_LEFT, ColumnDomainResult


def _require(result: ColumnDomainResult, modifier, name: str, what: str) -> None:
    if modifier not in result.rel:
        raise ValueError(
            f"invalid construction of {name} exception. {modifier.name} flag should be in column domain result")
    if not any(f in result.rel for f in SIDE_FLAGS):
        raise ValueError(
            f"invalid construction of {name} exception. should have flag indicating which is {what} "
            "(LEFT_NOT_RIGHT (right side), RIGHT_NOT_LEFT (left side), or BOTH)")


class ColCheckOnEmptyDF(ValueError):
    """A side of the check has no rows; ``result.rel`` = DF_EMPTY | side."""

    def __init__(self, result: ColumnDomainResult) -> None:
        _require(result, DF_EMPTY, "ColCheckOnEmptyDF", "empty")
        self.result = result
        if LEFT_NOT_RIGHT in result.rel:
            why = "Right dataframe is empty"
        elif RIGHT_NOT_LEFT in result.rel:
            why = "Left dataframe is empty"
        else:
            why = "Both dataframes are empty"
        super().__init__(f"Column value check is invalid. {why}")


class ColCheckOnMissingCol(KeyError):
    """A side lacks a checked column; ``result.rel`` = COL_MISSING | side."""

    def __init__(self, result: ColumnDomainResult) -> None:
        _require(result, COL_MISSING, "ColCheckOnMissingCol", "missing")
        self.result = result
        if BOTH in result.rel:
            why = (f"Right dataframe is missing column(s) {result.lnotr}, "
                   f"Left dataframe is missing column(s) {result.rnotl}")
        elif RIGHT_NOT_LEFT in result.rel:
            why = f"Left dataframe is missing column(s) {result.rnotl}"
        else:
            why = f"Right dataframe is missing column(s) {result.lnotr}"
        self.message = f"Column value check is invalid. {why}"
        super().__init__(self.message)

    def __str__(self) -> str:  # KeyError would quote the text
        return self.message


class UncoveredAssessmentError(Exception):
    """IDs present in one file of a pair and absent from the other."""

    def __init__(self, file_with: str, file_without: str, missing_ids, *args):
        super().__init__(*args)
        self.file_with = file_with
        self.file_without = file_without
        self.missing_ids = missing_ids
