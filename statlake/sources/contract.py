"""The stored contract of a table: its schema and partition columns, kept beside the data.

A table written by :mod:`statlake.sources.tables` carries a small ``_contract.json``. Readers take
the schema from there, so nothing is inferred from file footers or folder names (a code
``001`` stays text, a partition date stays a date), and a reader or writer that expects other columns
is told which ones differ, before any data is touched.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from statlake.sources.files import Files

#: name of the file; the underscore hides it from Spark's listing
CONTRACT_FILE = "_contract.json"
ADDED, MISSING, RETYPED = "added", "missing", "retyped"


class ContractError(ValueError):
    """Columns differ from the stored contract."""


@dataclass(frozen=True)
class Contract:
    schema: StructType
    partition_by: tuple[str, ...] = ()

    def to_json(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "partition_by": list(self.partition_by)}, indent=1)

    @staticmethod
    def from_json(text: str) -> Contract:
        d = json.loads(text)
        return Contract(StructType.fromJson(d["schema"]), tuple(d["partition_by"]))


@dataclass(frozen=True)
class Drift:
    """One column that differs: ``added`` (the table lacks it), ``missing`` (only the table has it)
    or ``retyped``; types as SQL text."""

    column: str
    change: str
    stored: str | None
    given: str | None

    def __str__(self) -> str:
        return f"{self.column} {self.change} ({self.stored or '-'} -> {self.given or '-'})"


def as_schema(spark: SparkSession, schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def compare(stored: StructType, given: StructType) -> list[Drift]:
    """The columns in which ``given`` differs from ``stored``, by name (letter case does not count,
    as in Spark's resolution); order and nullability do not count either."""
    have = {f.name.lower(): f for f in stored}
    want = {f.name.lower(): f for f in given}
    out = []
    for key in sorted(have.keys() | want.keys()):
        old, new = have.get(key), want.get(key)
        types = tuple(None if f is None else f.dataType.simpleString() for f in (old, new))
        if types[0] != types[1]:
            change = ADDED if old is None else MISSING if new is None else RETYPED
            out.append(Drift((old or new).name, change, *types))
    return out


def require(drifts: Sequence[Drift], what: str, allowed: Sequence[str]) -> None:
    wrong = [d for d in drifts if d.change not in allowed]
    if wrong:
        raise ContractError(f"{what}: " + "; ".join(map(str, wrong)))


def stored_contract(spark: SparkSession, path: str) -> Contract | None:
    """The contract kept in a table's folder; None if there is none (a table written elsewhere)."""
    text = Files(spark, path).read(f"{path.rstrip('/')}/{CONTRACT_FILE}")
    return None if text is None else Contract.from_json(text)


def keep_contract(spark: SparkSession, path: str, contract: Contract) -> None:
    Files(spark, path).write(f"{path.rstrip('/')}/{CONTRACT_FILE}", contract.to_json())


def contract_drift(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """``column, change, stored, given``: how a declared schema differs from the stored contract."""
    contract = stored_contract(spark, path)
    if contract is None:
        raise ContractError(f"{path} keeps no contract")
    rows = [(d.column, d.change, d.stored, d.given) for d in compare(contract.schema, as_schema(spark, schema))]
    return spark.createDataFrame(rows, "column string, change string, stored string, given string")
