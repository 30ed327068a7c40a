"""What a synchronised table is, and the checks of settings and schemas."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql.types import StructType

BACKENDS = ("pgvector", "qdrant")
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


@dataclass(frozen=True)
class TableSpec:
    """fields: text of the document, in order. children: (table, foreign key, text column) whose
    rows are added to the document. parent: (table, foreign key) of a child table, which has no
    document of its own; its changes make the parent's be built anew."""

    name: str
    fields: tuple[str, ...] = ()
    key: str = "id"
    title_field: str | None = None
    children: tuple[str, str, str] | None = None
    parent: tuple[str, str] | None = None

    @property
    def title(self) -> str | None:
        return self.title_field or (self.fields[0] if self.fields else None)


TABLES = {
    "article": TableSpec("article", ("title", "body"), title_field="title", children=("comment", "article_id", "body")),
    "product": TableSpec("product", ("name", "description"), title_field="name"),
    "comment": TableSpec("comment", parent=("article", "article_id")),
}


@dataclass(frozen=True)
class Settings:
    chunk_size: int = 400
    chunk_overlap: int = 50
    dim: int = 512
    max_doc_chars: int = 200_000
    backend: str = "pgvector"
    production: bool = False
    egress_allowed: bool = False
    remote_model: bool = False
    secrets: dict = field(default_factory=dict)
    placeholders: tuple[str, ...] = ()

    def problems(self, tables: dict[str, TableSpec] | None = None) -> list[str]:
        """Everything that is wrong, at once."""
        out = []
        if not 0 <= self.chunk_overlap < self.chunk_size:
            out.append("chunk_overlap must be less than chunk_size")
        if self.dim <= 0 or self.max_doc_chars <= 0:
            out.append("dim and max_doc_chars must be positive")
        if self.backend not in BACKENDS:
            out.append(f"backend must be one of {BACKENDS}")
        for t in (tables or TABLES).values():
            if not _IDENTIFIER.fullmatch(t.name):
                out.append(f"{t.name!r} is no table name")
            if not t.parent and not t.fields:
                out.append(f"{t.name}: fields must not be empty")
        if self.production:
            if any(_weak(str(v), self.placeholders) for v in self.secrets.values()):
                out.append("production needs secrets of its own")
            if self.remote_model and not self.egress_allowed:
                out.append("texts may leave the system only with egress_allowed")
        return out

    def check(self, tables: dict[str, TableSpec] | None = None) -> None:
        if p := self.problems(tables):
            raise ValueError("; ".join(p))


def _weak(secret: str, placeholders: tuple[str, ...]) -> bool:
    """Empty, one of the values that a deployment must replace, or an address whose password is its user's name."""
    login = re.search(r"://([^:/@]+):([^@/]+)@", secret)
    return not secret or any(p in secret for p in placeholders) or bool(login and login[1] == login[2])


def schema_problems(spec: TableSpec, schema: StructType) -> list[str]:
    """Columns that a table spec names and the schema lacks."""
    need = {spec.key, "tenant_id", *spec.fields} | ({spec.title} if spec.title else set()) | ({spec.parent[1]} if spec.parent else set())
    return [f"{spec.name}: no column {c}" for c in sorted(need - set(schema.names))]


INDEX_KEYS = ("model", "dim", "distance", "chunk_size", "chunk_overlap")


def index_problems(stored: dict, wanted: dict) -> list[str]:
    """Why an index with the stored settings can't serve the wanted ones."""
    out = [f"{k} is not stored" for k in INDEX_KEYS if stored.get(k) is None]
    return out + [f"{k} is {stored[k]!r}, wanted {wanted[k]!r}" for k in INDEX_KEYS if stored.get(k) is not None and k in wanted and stored[k] != wanted[k]]
