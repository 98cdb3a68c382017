"""Telling faults of the data or of a predicate from faults of the cluster."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.errors.exceptions.captured import convert_exception

Item, Result = TypeVar("Item"), TypeVar("Result")

# Classes of SQLSTATE for data exceptions and for statements that cannot be analysed.
DATA_STATES = ("22", "42")


def _data_error(error: BaseException) -> PySparkException | None:
    """The data error that ``error`` is, or the one that caused it: stages that fail at the same time are raised
    as one error whose cause is the first of theirs, and a failed write has what its rows raised as its cause."""
    if isinstance(error, PySparkException):
        return error if (error.getSqlState() or "").startswith(DATA_STATES) else None
    cause = error.java_exception.getCause() if isinstance(error, Py4JJavaError) else None
    while cause is not None:
        found = _data_error(convert_exception(cause))
        if found is not None:
            return found
        cause = cause.getCause()
    return None


def is_data_error(error: BaseException) -> bool:
    """Whether rows or predicates are at fault. A lost executor, a full disk or too little memory is not:
    recording those as bad variables would make an incomplete result look complete."""
    return _data_error(error) is not None


def first_line(error: BaseException) -> str:
    error = _data_error(error) or error
    return next((x.strip() for x in str(error).splitlines() if x.strip()), type(error).__name__)


def isolated(items: Sequence[Item], run: Callable[[Sequence[Item]], Result]
             ) -> tuple[list[Result], list[tuple[Item, str]]]:
    """Run all items at once; only where rows or predicates fail, their halves, down to the items at fault.

    ``run`` must compute its result, not only plan it. Sound items cost one run; an item at fault costs a
    run per halving. Returns the results, one per run that went through, and (item, reason) of the rest."""
    if not items:
        return [], []
    try:
        return [run(items)], []
    except Exception as e:
        if not is_data_error(e):
            raise
        if len(items) == 1:
            return [], [(items[0], first_line(e))]
    middle = len(items) // 2
    results, faults = [], []
    for half in (items[:middle], items[middle:]):
        found, failed = isolated(half, run)
        results += found
        faults += failed
    return results, faults
