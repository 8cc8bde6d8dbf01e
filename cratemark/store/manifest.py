"""Manifests: which folders the tables of a version consist of."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Part:
    """What one run wrote of a table: a folder below the store's, and the column by
    which it is partitioned, if it is."""

    run: str
    folder: str
    by: str | None = None


@dataclass(frozen=True)
class Entry:
    """A table: its columns as Spark's JSON, its format, its parts in the order they
    came."""

    schema: str
    format: str
    parts: tuple[Part, ...]


@dataclass(frozen=True)
class Manifest:
    """A version of all tables. ``based_on`` is the version it was made from, ``runs``
    are the runs that it or an earlier one took in, with the tables they wrote."""

    version: int = 0
    based_on: int = 0
    tables: Mapping[str, Entry] = field(default_factory=dict)
    runs: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def has(self, run: str, table: str) -> bool:
        """Whether ``run`` has already written ``table``."""
        return table in self.runs.get(run, ())

    def replaced(self, run: str, name: str, entry: Entry) -> Manifest:
        return self._with(run, name, entry)

    def appended(self, run: str, name: str, entry: Entry) -> Manifest:
        """``entry`` behind what the table has; its columns must be the same."""
        old = self.tables.get(name)
        if old is None:
            return self._with(run, name, entry)
        if (old.schema, old.format) != (entry.schema, entry.format):
            raise ValueError(f"{name} has other columns or another format than what is to be appended")
        return self._with(run, name, replace(old, parts=old.parts + entry.parts))

    def _with(self, run: str, name: str, entry: Entry) -> Manifest:
        return replace(
            self,
            tables={**self.tables, name: entry},
            runs={**self.runs, run: tuple(sorted({*self.runs.get(run, ()), name}))},
        )

    def folders(self) -> set[str]:
        return {part.folder for entry in self.tables.values() for part in entry.parts}


def to_text(manifest: Manifest) -> str:
    """One JSON document; its last key tells a whole file from one cut off."""
    tables = {
        name: {
            "schema": entry.schema,
            "format": entry.format,
            "parts": [[part.run, part.folder, part.by] for part in entry.parts],
        }
        for name, entry in manifest.tables.items()
    }
    runs = {run: list(names) for run, names in manifest.runs.items()}
    body = {"version": manifest.version, "based_on": manifest.based_on, "tables": tables, "runs": runs}
    return json.dumps({**body, "whole": True})


def from_text(text: str) -> Manifest | None:
    """The manifest, or None if the file is not whole."""
    try:
        body = json.loads(text)
    except ValueError:
        return None
    if not isinstance(body, dict) or body.get("whole") is not True:
        return None
    tables = {
        name: Entry(table["schema"], table["format"], tuple(Part(*part) for part in table["parts"]))
        for name, table in body["tables"].items()
    }
    runs = {run: tuple(names) for run, names in body["runs"].items()}
    return Manifest(body["version"], body["based_on"], tables, runs)
