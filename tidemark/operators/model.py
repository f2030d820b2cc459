"""The target model: tables, columns, types and keys as metadata rows, and what follows from them."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import metadata_rows

LINEAGE = ["_source_system", "_source_table", "_source_record_key", "_source_batch_id", "_dq_run_id"]
LINEAGE_KEY = ["_source_system", "_source_batch_id", "_source_record_key"]


def same_name(column: str, value: str):
    """Case- and space-insensitive equality with a metadata column."""
    return F.upper(F.trim(F.col(column))) == value.strip().upper()


def spark_type(data_type: str) -> str:
    """Spark type of a target type text; unknown types are an error."""
    text = "".join(data_type.upper().split())
    if text == "TEXT" or re.match(r"(VAR)?CHAR", text):
        return "string"
    simple = {"TIMESTAMP": "timestamp", "DATE": "date", "INTEGER": "int"}
    if text in simple:
        return simple[text]
    if text.startswith("DECIMAL"):
        return text.lower()
    raise ValueError(f"unsupported target type {data_type}")


@dataclass(frozen=True)
class TargetColumn:
    name: str
    data_type: str
    keys: tuple[str, ...] = ()
    nullable: bool = True
    description: str = ""
    position: int = 0

    @property
    def max_length(self) -> int | None:
        sized = re.match(r"(?:VAR)?CHAR\((\d+)\)", self.data_type.upper())
        return int(sized.group(1)) if sized else None

    @property
    def domain(self) -> list[str] | None:
        """Allowed values when the description is a plain list such as `NEW/OPEN/DONE`."""
        listed = re.fullmatch(r"[A-Z]+(?:/[A-Z]+)+", self.description.strip())
        return listed.group(0).split("/") if listed else None

    @property
    def reference(self) -> tuple[str, str] | None:
        """Parent table and column of a foreign key, from `→ TABLE.COLUMN` in the description."""
        found = re.search(r"→\s*(\w+)\.(\w+)", self.description, re.ASCII)
        return (found.group(1).upper(), found.group(2).upper()) if found else None


class TargetModel:
    """Model rows (TABLE_NAME, COLUMN_NAME, DATA_TYPE, KEY, NULLABLE, DESCRIPTION, ORDINAL) ready for planning."""

    def __init__(self, rows: list[dict]):
        self.tables: dict[str, list[TargetColumn]] = {}
        ordered = sorted(rows, key=lambda r: int(r.get("ORDINAL") or 0))
        for row in ordered:
            columns = self.tables.setdefault(row["TABLE_NAME"].strip().upper(), [])
            columns.append(
                TargetColumn(
                    name=row["COLUMN_NAME"].strip(),
                    data_type=row["DATA_TYPE"],
                    keys=tuple(k.strip().upper() for k in (row.get("KEY") or "").split(",") if k.strip()),
                    nullable=row.get("NULLABLE") != "N",
                    description=row.get("DESCRIPTION") or "",
                    position=len(columns) + 1,
                )
            )

    @classmethod
    def from_frame(cls, df: DataFrame) -> TargetModel:
        return cls(metadata_rows(df))

    def columns(self, table: str) -> list[TargetColumn]:
        found = self.tables.get(table.upper())
        if not found:
            raise ValueError(f"the target model has no table {table}")
        return found

    def key_column(self, table: str, kind: str) -> str | None:
        """The one PK or UK column of a table; None when there is none or more than one."""
        found = {c.name for c in self.tables.get(table.upper(), []) if kind in c.keys}
        return found.pop() if len(found) == 1 else None

    def require_key(self, table: str, kind: str) -> str:
        found = self.key_column(table, kind)
        if not found:
            raise ValueError(f"{table}: the target model needs exactly one {kind} column")
        return found

    def parent_of(self, fk_column: str) -> str | None:
        """The one table whose primary key has the name of this foreign key column."""
        found = [
            t for t, cols in self.tables.items() if any(c.name == fk_column and "PK" in c.keys for c in cols)
        ]
        return found[0] if len(found) == 1 else None

    def parents(self, table: str) -> list[str]:
        """Tables that the foreign keys of a table point to, in column order; the table itself is left out."""
        found = []
        for column in self.columns(table):
            if "FK" in column.keys:
                parent = column.reference[0] if column.reference else self.parent_of(column.name)
                if parent and parent != table.upper() and parent not in found:
                    found.append(parent)
        return found

    def load_order(self, wanted: list[str]) -> list[str]:
        """The wanted tables with parents before children, otherwise in the given order.

        Parents that are not wanted do not matter. Tables that wait for each other are refused with their cycle.
        """
        names = [t.upper() for t in dict.fromkeys(wanted)]
        order, path = [], []

        def place(table: str) -> None:
            if table in order:
                return
            if table in path:
                raise ValueError(f"foreign keys form a cycle: {' -> '.join([*path[path.index(table) :], table])}")
            path.append(table)
            for parent in self.parents(table):
                if parent in names:
                    place(parent)
            path.pop()
            order.append(table)

        for name in names:
            place(name)
        return order


def id_prefix(id_column: str) -> str:
    return id_column[:-3] if id_column.upper().endswith("_ID") else id_column
