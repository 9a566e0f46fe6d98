"""Ordered steps over named tables, each complete before the next one starts.

A step reads the tables as the steps before it left them and returns new contents for some.
Its tables are written next to the current ones; then one small version says
which folder each table has and which steps of the run are done.  A run that
stopped goes on at the first step that is not done.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.sources import tables as store

PLACES = T.StructType([T.StructField(n, T.StringType()) for n in ("Name", "Folder", "Columns")])
DONE = T.StructType([T.StructField(n, T.StringType()) for n in ("Run", "Step")])


@dataclass(frozen=True)
class Step:
    name: str
    run: Callable[[Mapping[str, DataFrame]], Mapping[str, DataFrame]]


@dataclass(frozen=True)
class _State:
    number: int
    places: dict[str, tuple[str, str]]
    done: list[tuple[str, str]]


def _state(spark: SparkSession, root: str, number: int | None = None) -> _State:
    complete = store.versions(spark, f"{root}/state")
    if number is None:
        number = complete[-1] if complete else 0
    if number not in complete:
        return _State(number, {}, [])
    folder = f"{root}/state/version={number}"
    # one row for each table and for each step
    places = {r.Name: (r.Folder, r.Columns) for r in store.by_path(spark, f"{folder}/places", PLACES).collect()}
    return _State(number, places, [tuple(r) for r in store.by_path(spark, f"{folder}/done", DONE).collect()])


def _read(spark: SparkSession, root: str, state: _State) -> dict[str, DataFrame]:
    return {name: store.by_path(spark, f"{root}/{folder}", T.StructType.fromJson(json.loads(columns))) for name, (folder, columns) in state.places.items()}


def current(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables after the last complete step."""
    return _read(spark, root, _state(spark, root))


def run_steps(spark: SparkSession, root: str, run: str, steps: Sequence[Step], start: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Carry out the steps of a run that are not done yet, in order, and return the tables.

    ``start`` gives tables the folder does not have yet; it counts as the first step.
    A run is told by its name: steps done by another run are done again.
    """
    todo = ([Step("start", lambda have: {n: df for n, df in start.items() if n not in have})] if start else []) + list(steps)
    if len({s.name for s in todo}) < len(todo):
        raise ValueError("steps need different names")
    for step in todo:
        state = _state(spark, root)
        if (run, step.name) not in state.done:
            _carry_out(spark, root, run, step, state)
    return current(spark, root)


def _carry_out(spark: SparkSession, root: str, run: str, step: Step, state: _State) -> None:
    number = state.number + 1
    places = dict(state.places)
    for name, df in step.run(_read(spark, root, state)).items():
        folder = f"{name}/{number}"
        store.write(df, f"{root}/{folder}", "overwrite")
        places[name] = (folder, json.dumps(df.schema.jsonValue()))
    older = _state(spark, root, number - 2)
    done = [d for d in state.done if d[0] == run] + [(run, step.name)]
    store.write_together(spark, f"{root}/state", number, {
        "places": (spark.createDataFrame([(n, *p) for n, p in places.items()], PLACES), ()), "done": (spark.createDataFrame(done, DONE), ())})
    store.commit_version(spark, f"{root}/state", number)
    # folders that neither this version nor the one before names
    for folder in {p[0] for p in older.places.values()} - {p[0] for p in [*places.values(), *state.places.values()]}:
        store.drop_folder(spark, f"{root}/{folder}")
