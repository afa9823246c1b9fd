"""Running a user processor over units, one row per unit, with failures captured."""

from __future__ import annotations

import hashlib
import inspect
import json
import os
import pkgutil
import traceback
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from pathlib import PurePath
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..violations import violation_rows
from .state import ERROR_CHARACTERS

OUTCOME_COLUMNS = (
    "unit_id STRING, status STRING, error STRING, outputs MAP<STRING, STRING>,"
    " metrics STRING, tool_versions MAP<STRING, STRING>, message STRING"
)


@dataclass(frozen=True)
class ProcessingResult:
    """What a processor returns for one unit."""

    success: bool
    outputs: dict[str, str] = field(default_factory=dict)
    metrics: dict[str, Any] = field(default_factory=dict)
    tool_versions: dict[str, str] = field(default_factory=dict)
    message: str | None = None


Processor = Callable[[dict, dict, dict], ProcessingResult]


def load_processor(reference: str) -> Processor:
    """The callable that ``package.module:callable`` names."""
    if ":" not in reference:
        raise ValueError(f"{reference!r} does not name a callable as 'package.module:callable'")
    found = pkgutil.resolve_name(reference)
    if callable(found):
        return found
    raise TypeError(f"{reference!r} names no callable")


class Output(NamedTuple):
    """A declared output with its absolute path."""

    role: str
    path: PurePath
    root: PurePath

    def has_content(self) -> bool:
        return os.path.isfile(self.path) and os.path.getsize(self.path) > 0


#: What is wrong with one output, and how to tell.
OUTPUT_FAULTS: dict[str, Callable[[Output], bool]] = {
    "has a blank role": lambda o: not o.role.strip(),
    "is outside its directory": lambda o: o.root not in o.path.parents,
}
FILE_FAULTS = OUTPUT_FAULTS | {"is missing or empty": lambda o: not o.has_content()}


def output_faults(outputs: dict[str, str], output_dir: str, *, need_files: bool) -> Iterator[str]:
    """Everything that is wrong with declared outputs, as texts."""
    root = PurePath(os.path.normpath(output_dir))
    declared = [Output(str(role), PurePath(os.path.normpath(root / str(path))), root) for role, path in outputs.items()]
    for output in declared:
        for fault, found in (FILE_FAULTS if need_files else OUTPUT_FAULTS).items():
            if found(output):
                yield f"output {output.role!r} {fault}: {output.path}"
    shared = [path for path, n in Counter(o.path for o in declared).items() if n > 1]
    if shared or not declared:
        yield f"outputs share {shared[0]}" if shared else "success without outputs"


def checked_outputs(result: ProcessingResult, output_dir: str, *, need_files: bool) -> dict[str, str]:
    """Absolute output paths of a result, or an error that names all that is wrong with it."""
    if not isinstance(result, ProcessingResult):
        raise TypeError(f"a processor gives a ProcessingResult, not {type(result).__name__}")
    faults = list(output_faults(result.outputs, output_dir, need_files=need_files)) if result.success else [result.message or "the processor failed"]
    if faults:
        raise ValueError("; ".join(faults))
    return {role: os.path.normpath(os.path.join(output_dir, str(path))) for role, path in result.outputs.items()}


def run_units(
    units: DataFrame, processor: Processor | str, *, need_files: bool = True
) -> DataFrame:
    """Outcome row per unit row.

    ``units`` is ``unit_id`` plus the struct columns ``fastq``, ``genome`` and
    ``context`` (with ``output_dir``). A row carries paths and facts, not reads, so
    units stay independent rows that Spark spreads over tasks; an exception fails its
    own unit only. A reference in text form is imported on the executor.
    """
    schema = to_arrow_schema(StructType.fromDDL(OUTCOME_COLUMNS))

    def outcome(call: Processor, unit: dict) -> dict:
        try:
            context = unit["context"] or {}
            result = call(unit["fastq"], unit["genome"], context)
            outputs = checked_outputs(result, context.get("output_dir") or "/", need_files=need_files)
            return {
                "unit_id": unit["unit_id"],
                "status": "succeeded",
                "outputs": list(outputs.items()),
                "metrics": json.dumps(result.metrics, sort_keys=True),
                "tool_versions": list(result.tool_versions.items()),
                "message": result.message,
            }
        except Exception:  # noqa: BLE001 - a unit's failure is data
            return {
                "unit_id": unit["unit_id"],
                "status": "failed",
                "error": traceback.format_exc()[-ERROR_CHARACTERS:],
            }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = load_processor(processor) if isinstance(processor, str) else processor
        for batch in batches:
            rows = [outcome(call, unit) for unit in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    columns = ["unit_id", *[c for c in ("fastq", "genome", "context") if c in units.columns]]
    return units.select(*columns).mapInArrow(run, OUTCOME_COLUMNS)


def with_descriptions(units: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Add the description JSON of a unit's only experiment to its context.

    ``units`` needs ``experiment_accessions`` and ``context``; ``descriptions`` is
    ``(experiment, description)``.
    """
    keyed = units.withColumn("experiment", F.try_element_at("experiment_accessions", F.lit(1)))
    joined = keyed.join(descriptions.select("experiment", "description"), "experiment", "left")
    return joined.withColumn(
        "context", F.col("context").withField("description", F.col("description"))
    ).drop("experiment", "description")


def description_problems(units: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Units without exactly one experiment, or whose experiment has no description."""
    many = units.filter(F.size("experiment_accessions") != 1)
    single = units.filter(F.size("experiment_accessions") == 1).withColumn(
        "experiment", F.element_at("experiment_accessions", 1)
    )
    lost = single.join(descriptions.select("experiment"), "experiment", "left_anti")
    name = "processor_description"
    return violation_rows(
        many, name, F.col("unit_id"), F.lit("requires exactly one experiment per unit")
    ).unionByName(violation_rows(lost, name, F.col("unit_id"), F.lit("no description is available")))


def _code_digest(processor: Processor) -> str | None:
    """SHA-256 of the file that holds a processor's code, where there is one."""
    try:
        file = inspect.getsourcefile(inspect.unwrap(processor) if inspect.isroutine(processor) else type(processor))
    except TypeError:
        return None
    if file is None or not os.path.isfile(file):
        return None
    with open(file, "rb") as code:
        return hashlib.file_digest(code, "sha256").hexdigest()


def processor_identity(processor: Processor | str, processor_id: str | None = None) -> str:
    """What of a processor decides its results: where it is defined, its configuration and code.

    Two processors are the same work only if all three agree, so changed code is not
    reused. A given ``processor_id``, or a reference by name, stands for itself: there the
    caller says what counts as the same.
    """
    if processor_id or isinstance(processor, str):
        return processor_id or processor
    owner = processor if inspect.isroutine(processor) or inspect.isclass(processor) else type(processor)
    facts = {"defined": [owner.__module__, owner.__qualname__], "config": repr(getattr(processor, "config", None)), "code": _code_digest(processor)}
    digest = hashlib.sha256(json.dumps(facts, sort_keys=True).encode()).hexdigest()
    return f"{owner.__qualname__}@{digest}"
