"""The chain of batches: each is sealed with the hashes of its relations and of the batches it was made from.

A stage follows the chain of what it is given back to the first scan. A batch
that was exchanged, changed or made anew since is refused, wherever it stands.
"""

from __future__ import annotations

import functools
import inspect
import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

from ledgerloom.plans import parts
from ledgerloom.plans import plan as P


class Broken(ValueError):
    """What a batch was made from is not there as it was."""


def _files(folder: Path) -> dict[str, list[tuple[str, int]]]:
    """The data files, with their sizes, of each relation of a batch: a few for each partition that was written."""
    found: dict[str, list[tuple[str, int]]] = {}
    for path in sorted(folder.glob("*/part-*")):
        if path.suffix in (".parquet", ".json"):
            found.setdefault(path.parent.name, []).append((path.name, path.stat().st_size))
    return found


def _hashes(spark: SparkSession, folder: Path, names: list[str]) -> dict[str, str | None]:
    """SHA-256 of files below ``folder``, in tasks."""
    if not names:
        return {}
    rows = spark.createDataFrame([(n, "") for n in names], "name string, sha256 string").repartition(min(len(names), 1000))
    return {r.name: r.actual for r in rows.mapInArrow(parts.hashed(str(folder)), "name string, sha256 string, actual string").collect()}


def seal(spark: SparkSession, folder: Path, upstream: dict[str, Path]) -> None:
    """Note in the batch's summary what its relations are, and what it was made from."""
    path = folder / "summary.json"
    files = _files(folder)
    hashes = _hashes(spark, folder, [f"{r}/{n}" for r, own in files.items() for n, _ in own])
    relations = {r: [{"name": n, "bytes": size, "sha256": hashes[f"{r}/{n}"]} for n, size in own] for r, own in files.items()}
    bound = {role: {"batch": str(p), "summary_sha256": P.file_hash(p / "summary.json")} for role, p in upstream.items()}
    P.write_json(path, json.loads(path.read_text(encoding="utf-8")) | {"upstream": bound, "relations": relations})


def verify(spark: SparkSession, folder: Path, deep: bool = False) -> list[Path]:
    """The batches from ``folder`` back, each found as it was sealed; else Broken. Names and sizes of their files are compared, and, if ``deep``, their bytes."""
    seen: list[Path] = []
    waiting = [folder]
    while waiting:
        batch = waiting.pop()
        if batch in seen:
            continue
        seen.append(batch)
        try:
            summary = json.loads((batch / "summary.json").read_text(encoding="utf-8"))
        except FileNotFoundError:
            raise Broken(f"{batch} is not there") from None
        said = {r: [(x["name"], x["bytes"]) for x in own] for r, own in summary.get("relations", {}).items()}
        if said != {r: own for r, own in _files(batch).items() if r in said}:
            raise Broken(f"the relations of {batch} have changed")
        if deep:
            wanted = {f"{r}/{x['name']}": x["sha256"] for r, own in summary.get("relations", {}).items() for x in own}
            if _hashes(spark, batch, list(wanted)) != wanted:
                raise Broken(f"the bytes of {batch} have changed")
        for role, bound in summary.get("upstream", {}).items():
            path = Path(bound["batch"])
            if not (path / "summary.json").is_file() or P.file_hash(path / "summary.json") != bound["summary_sha256"]:
                raise Broken(f"{path} is not the {role} batch that {batch} was made from")
            waiting.append(path)
    return seen


def chained(*roles: str) -> Callable[[Callable[..., Path]], Callable[..., Path]]:
    """A stage whose arguments ``roles`` are batches: their chains are followed first, and the batch that comes out is sealed."""

    def chain(stage: Callable[..., Path]) -> Callable[..., Path]:
        signature = inspect.signature(stage)

        @functools.wraps(stage)
        def run(*args: object, **more: object) -> Path:
            given = signature.bind(*args, **more).arguments
            upstream = {r: Path(given[r]) for r in roles if given.get(r) is not None}
            for path in upstream.values():
                verify(given["spark"], path)
            folder = stage(*args, **more)
            seal(given["spark"], folder, upstream)
            return folder

        return run

    return chain
