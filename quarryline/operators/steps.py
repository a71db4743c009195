"""User functions as steps of a feature pipeline that can be saved.

A saved step holds the name of its function and the columns it reads, never code: the program that
loads a model registers the functions under the same names, as it would import them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class TableFunction:
    """What a step does with a table and the columns it reads, and the columns it adds for them."""

    apply: Callable[[DataFrame, list[str]], DataFrame]
    names: Callable[[list[str]], list[str]]


_FUNCTIONS: dict[str, TableFunction] = {}


def table_function(name: str, names: Callable[[list[str]], list[str]]):
    """Registers the function below as ``name``; ``names`` gives the columns it adds, from its inputs.

    A name stands for one function in a program. Registering the same code again, as a reloaded
    module does, replaces it; other code under the name is an error.
    """

    def register(function: Callable[[DataFrame, list[str]], DataFrame]):
        known = _FUNCTIONS.get(name)
        if known and _place(known.apply) != _place(function):
            raise ValueError(f"another function is registered as {name!r}")
        _FUNCTIONS[name] = TableFunction(function, names)
        return function

    return register


def _place(function: Callable) -> tuple[str, str]:
    return function.__module__, function.__qualname__


class NamedStep(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Applies the function registered as ``function`` to the columns ``inputs``; rows and other columns stay."""

    function = Param(Params._dummy(), "function", "name of a registered function", TypeConverters.toString)
    inputs = Param(Params._dummy(), "inputs", "columns the function reads", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, function: str | None = None, inputs: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _known(self) -> TableFunction:
        name = self.getOrDefault(self.function)
        if name not in _FUNCTIONS:
            raise LookupError(f"no function is registered as {name!r}; known: {sorted(_FUNCTIONS)}")
        return _FUNCTIONS[name]

    def reads(self) -> list[str]:
        return list(self.getOrDefault(self.inputs))

    def outputs(self) -> list[str]:
        """The columns that the step adds."""
        return list(self._known().names(self.reads()))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        done = self._known().apply(dataset, self.reads())
        if missing := [c for c in (*dataset.columns, *self.outputs()) if c not in done.columns]:
            raise ValueError(f"{self.getOrDefault(self.function)!r} left out the columns {missing}")
        return done
