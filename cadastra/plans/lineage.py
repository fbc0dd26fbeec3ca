"""Order of jobs, what has to run again, and what columns steps read and write."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAGES = ("ingest", "harmonize", "enrich", "curate")


@dataclass(frozen=True, order=True)
class Job:
    """One stage of one recipe for one unit."""

    stage: str
    recipe: str
    unit: str


@dataclass
class Graph:
    """Jobs with what each is made of."""

    inputs: dict[Job, set[Job]] = field(default_factory=dict)

    def add(self, job: Job, made_of: Iterable[Job] = ()) -> None:
        self.inputs.setdefault(job, set()).update(made_of)
        for j in made_of:
            self.inputs.setdefault(j, set())

    def order(self) -> list[Job]:
        """Inputs before what is made of them, else by stage, recipe and unit; a circle is an error that names it."""
        sorter = TopologicalSorter({j: sorted(i) for j, i in sorted(self.inputs.items())})
        try:
            sorter.prepare()
        except CycleError as e:
            raise ValueError("jobs that need each other: " + " > ".join(f"{j.stage} {j.recipe} {j.unit}" for j in e.args[1])) from e
        out: list[Job] = []
        while sorter.is_active():
            ready = sorted(sorter.get_ready(), key=lambda j: (STAGES.index(j.stage) if j.stage in STAGES else len(STAGES), j.recipe, j.unit))
            out += ready
            sorter.done(*ready)
        return out

    def after(self, changed: Iterable[Job]) -> set[Job]:
        """The changed jobs and all that is made of them, directly or not."""
        made: dict[Job, set[Job]] = {}
        for j, inputs in self.inputs.items():
            for i in inputs:
                made.setdefault(i, set()).add(j)
        out, todo = set(), list(changed)
        while todo:
            j = todo.pop()
            if j not in out:
                out.add(j)
                todo += made.get(j, ())
        return out

    def before(self, job: Job) -> set[Job]:
        """All that a job is made of, directly or not."""
        out: set[Job] = set()
        todo = list(self.inputs.get(job, ()))
        while todo:
            j = todo.pop()
            if j not in out:
                out.add(j)
                todo += self.inputs.get(j, ())
        return out


def needs_rerun(outputs: dict[str, float | None], inputs: dict[str, float | None]) -> bool:
    """By times of writing (None: missing): an output is missing, or older than an input; an input that is missing is an error."""
    gone = sorted(k for k, t in inputs.items() if t is None)
    if gone:
        raise FileNotFoundError(f"inputs are missing: {gone}")
    made = list(outputs.values())
    return not made or any(t is None for t in made) or max(inputs.values(), default=float("-inf")) > min(made)


def record(job: Job, code: str, inputs: dict[str, dict[str, str]]) -> dict:
    """What a job ran with: a digest of its code, and the digests of the columns that it read, by table."""
    return {"job": [job.stage, job.recipe, job.unit], "code": hashlib.sha256(code.encode()).hexdigest(), "inputs": json.loads(json.dumps(inputs, sort_keys=True))}


def can_skip(old: dict | None, new: dict) -> bool:
    """Whether a job would give what it gave: same code, and the columns it read then have the same digests now; others may differ."""
    if old is None or old["code"] != new["code"] or old["job"] != new["job"]:
        return False
    return all(new["inputs"].get(t, {}).get(c) == d for t, columns in old["inputs"].items() for c, d in columns.items())


def decided_twice(steps: DataFrame) -> DataFrame:
    """(column, steps): columns that more than one step (step, column) decides, with these in order."""
    return steps.groupBy("column").agg(F.array_join(F.array_sort(F.collect_set("step")), ",").alias("steps"), F.count_distinct("step").alias("n")).where("n > 1").drop("n")


def attribute_of(column: str, suffixes: tuple[str, ...] = ("_source", "_new", "_per_area", "_real")) -> str:
    """A column's attribute: its name without what says where it comes from."""
    for s in suffixes:
        if column.endswith(s) and column != s:
            return column[: -len(s)]
    return column


def best_recipe(recipes: list[dict], entity: str, unit: str, stage: str) -> str | None:
    """Id of the recipe of an entity and stage whose scope is nearest to the unit; among equals the latest by id."""
    scopes = [unit.rsplit("-", k)[0] if k else unit for k in range(unit.count("-") + 1)]
    fits = [r for r in recipes if r["entity"] == entity and r["stage"] == stage and r["scope"] in scopes]
    return max(fits, key=lambda r: (-scopes.index(r["scope"]), r["id"]))["id"] if fits else None


def output_path(root: str, recipe: dict, unit: str, layer: str = "", partition: str = "") -> str:
    """Where a recipe's table of a unit lies: root, units from the top down, entity, stage, id, and layer and partition where given."""
    parts = [root, *unit.split("-"), recipe["entity"], recipe["stage"], recipe["id"], *([layer] if layer else []), *([partition] if partition else [])]
    return "/".join(p.strip("/") if i else p.rstrip("/") for i, p in enumerate(parts))


def envelope(observed: DataFrame, size: str, peak: str) -> tuple[float, float]:
    """(floor, slope) of a line on or above all observed peaks: least squares slope, not below 0, raised until it holds."""
    s = observed.agg(F.coalesce(F.regr_slope(peak, size), F.lit(0.0))).first()[0]
    slope = max(0.0, float(s))
    floor = observed.agg(F.max(F.col(peak) - F.lit(slope) * F.col(size))).first()[0]
    return float(floor or 0.0), slope
