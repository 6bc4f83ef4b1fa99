"""Forward-only versions of the tables: steps that make tables or add columns, each applied once and never undone.

A step that is applied leaves a numbered file in ``_versions`` of the base folder, made in one step that only one can do, with what
the step says. Later runs apply the steps that have none yet. A step that was changed after it was applied, one that is
missing from the list, or a number that is skipped is an error, and nothing is applied then.

No data file is ever rewritten: a column that is added may be null, and is null in rows that were written before (``schema_at``
names it, and Parquet gives nulls for columns that a file lacks). Two that migrate at once do the same, so who writes the
number first doesn't matter; one that dies between making a table and its number finds the table there the next time.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from evidora.errors import EvidenceError
from evidora.operators.commits import Files


class MigrationError(EvidenceError):
    code = "MIGRATION"


@dataclass(frozen=True)
class Step:
    """``creates``: new tables by name. ``adds``: by table the columns that it gains, as name and type."""

    name: str
    creates: dict[str, StructType] = field(default_factory=dict)
    adds: dict[str, dict[str, str]] = field(default_factory=dict)

    def told(self) -> str:
        return json.dumps({"name": self.name, "creates": {t: s.jsonValue() for t, s in self.creates.items()}, "adds": self.adds}, sort_keys=True)


def _file(number: int) -> str:
    return f"_versions/{number:06d}.json"


def version(spark: SparkSession, base: str) -> int:
    """The number of steps that are applied; 0 for a new base."""
    numbers = sorted(int(n[:6]) for n in Files(spark, base).names("_versions") if n.endswith(".json") and n[:6].isdigit())
    if numbers != list(range(1, len(numbers) + 1)):
        raise MigrationError("a version is missing", found=numbers)
    return len(numbers)


def schema_at(steps: list[Step], table: str, number: int | None = None) -> StructType:
    """The schema of ``table`` after so many steps, all unless given."""
    made: StructType | None = None
    for step in steps[:number]:
        if table in step.creates:
            if made is not None:
                raise MigrationError("a table is made twice", table=table, step=step.name)
            made = step.creates[table]
        for name, kind in step.adds.get(table, {}).items():
            if made is None or name in made.names:
                raise MigrationError("no such table, or a column that is there", table=table, column=name, step=step.name)
            made = StructType([*made.fields, StructField(name, StructType.fromDDL(f"c {kind}")[0].dataType, True)])
    if made is None:
        raise MigrationError("no such table", table=table)
    return made


def migrate(spark: SparkSession, base: str, steps: list[Step]) -> list[str]:
    """Applies the steps that are not applied yet and returns their names."""
    files, done = Files(spark, base), version(spark, base)
    if done > len(steps):
        raise MigrationError("the tables are newer than the steps", applied=done, steps=len(steps))
    for number, step in enumerate(steps[:done], 1):
        if files.read(_file(number)) != step.told():
            raise MigrationError("an applied step was changed", number=number, step=step.name)
    for table in sorted({t for s in steps for t in [*s.creates, *s.adds]}):
        schema_at(steps, table)  # all steps are sound before any is applied
    for number, step in enumerate(steps[done:], done + 1):
        for table, schema in step.creates.items():
            if not files.exists(f"{table}/_SUCCESS"):
                spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{base}/{table}")
        if not files.create_once(_file(number), step.told()) and files.read(_file(number)) != step.told():
            raise MigrationError("another has applied another step", number=number, step=step.name)
    return [s.name for s in steps[done:]]


def read(spark: SparkSession, base: str, table: str, steps: list[Step]) -> DataFrame:
    """``table`` with the columns of the version that is applied."""
    return spark.read.schema(schema_at(steps, table, version(spark, base))).parquet(f"{base}/{table}")
