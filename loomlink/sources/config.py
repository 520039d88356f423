"""Paths from a small configuration file."""

from __future__ import annotations

import warnings
from pathlib import Path


def load_paths(folder: str | Path) -> dict[str, str]:
    """Key-value lines `key: value` of paths.yaml, or of paths.example.yaml with a warning."""
    own, example = Path(folder, "paths.yaml"), Path(folder, "paths.example.yaml")
    if not own.exists():
        warnings.warn(f"{own} is missing; using {example}", stacklevel=2)
    out = {}
    for line in (own if own.exists() else example).read_text().splitlines():
        key, _, value = line.partition("#")[0].partition(":")
        if value.strip():
            out[key.strip()] = value.strip().strip("'\"")
    return out


def dataset_dir(paths: dict[str, str], key: str, root: str | Path) -> Path:
    """The folder under a key; a relative one counts from root."""
    if not paths.get(key):
        raise KeyError(f"no path for {key}")
    found = Path(paths[key])
    return found if found.is_absolute() else Path(root, found)


def source_files(base: str | Path, pattern: str = "*source*.tsv") -> list[Path]:
    found = sorted(Path(base).glob(pattern))
    if not found:
        raise FileNotFoundError(f"{base}/{pattern}")
    return found
