"""Names of the tables a pipeline works on."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """Databases per stage. One prefix keeps several pipelines apart in one catalog."""

    prefix: str = "tidemark"

    def table(self, stage: str, name: str) -> str:
        return f"{self.database(stage)}.{name.lower()}"

    def database(self, stage: str) -> str:
        return f"{self.prefix}_{stage}"

    STAGES = (
        "bronze", "meta", "silver_candidate", "dq_quarantine", "gold_candidate", "gold_mapping_error",
        "gold_entity_lineage", "gold_entity_record", "gold_entity_state", "gold", "gold_quarantine",
    )
