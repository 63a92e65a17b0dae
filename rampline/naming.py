"""Where things live: table names, landing paths and streaming state paths."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed value: the directory under a landing volume that is watched for payloads.
INCOMING = "incoming"


@dataclass(frozen=True)
class Layout:
    """One deployment.

    ``root`` holds the volumes, ``table_root`` (optional) the table files. With
    ``table_root`` unset tables are managed by the catalog; with it set they are
    external, which also lets the stages run as separate processes on a catalog
    that forgets its tables when a session ends.
    """

    catalog: str = "spark_catalog"
    root: str = "/Volumes"
    table_root: str | None = None

    def table(self, schema: str, name: str) -> str:
        return f"{self.catalog}.{schema}.{name}"

    def table_path(self, schema: str, name: str) -> str | None:
        return None if self.table_root is None else f"{self.table_root}/{self.catalog}/{schema}/{name}"

    def volume(self, schema: str, volume: str) -> str:
        return f"{self.root}/{self.catalog}/{schema}/{volume}"

    def landing(self, schema: str, volume: str) -> str:
        return f"{self.volume(schema, volume)}/{INCOMING}"


@dataclass(frozen=True)
class StatePaths:
    """Per-table checkpoint and schema directories under an operations volume."""

    volume: str

    def _of(self, table: str, kind: str) -> str:
        return f"{self.volume}/_pipeline_state/{table}/{kind}"

    def checkpoint(self, table: str) -> str:
        return self._of(table, "checkpoint")

    def schema(self, table: str) -> str:
        return self._of(table, "schema")
