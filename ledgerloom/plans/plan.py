"""Batches, approvals and the evidence of executions; plans themselves are parts with hashes (plans/parts.py), executed in tasks (plans/effects.py)."""

from __future__ import annotations

import hashlib
import json
import os
import posixpath
import secrets
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import SparkSession

from ledgerloom.plans import parts


def utc_now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"


def new_batch(root: str | Path) -> Path:
    """A folder of its own: UTC time and eight random hex digits; never one that exists."""
    while True:
        folder = Path(root) / f"{datetime.now(UTC):%Y%m%dT%H%M%SZ}-{secrets.token_hex(4)}"
        folder.parent.mkdir(parents=True, exist_ok=True)
        try:
            folder.mkdir()
            return folder
        except FileExistsError:
            continue


def file_hash(path: str | Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def write_json(path: Path, value: object) -> None:
    """Whole or not at all."""
    temporary = path.with_name(f"{path.name}.{secrets.token_hex(4)}.tmp")
    temporary.write_text(json.dumps(value, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    os.replace(temporary, path)


def csv_line(values: list) -> str:
    """Every field quoted; null is empty, lists are joined."""
    cell = lambda v: "" if v is None else " | ".join(map(str, v)) if isinstance(v, list | tuple) else str(v).lower() if isinstance(v, bool) else str(v)
    return ",".join('"' + cell(v).replace('"', '""') + '"' for v in values) + "\n"


def write_approval(folder: Path, **bound: object) -> Path:
    """An approval that a person must turn true; it names the hashes that it holds for."""
    path = folder / "approval.json"
    write_json(path, {"approved": False, "instruction": "Check the plan; set approved to true to allow its execution. Change nothing else."} | bound)
    return path


def normal_path(path: str) -> str:
    return posixpath.normpath(path).lower()


def is_inside(path: str, folder: str, strictly: bool = False) -> bool:
    p, f = normal_path(path), normal_path(folder)
    return p.startswith(f.rstrip("/") + "/") or p == f and not strictly


def require_empty(folder: str | Path) -> None:
    folder = Path(folder)
    if folder.exists() and (not folder.is_dir() or any(folder.iterdir())):
        raise ValueError(f"{folder} is not an empty folder")


class NotApproved(Exception):
    pass


def check_approval(spark: SparkSession, folder: Path, approval: dict, operations: tuple[str, ...], name: str = "plan", **bound: object) -> None:
    """The approval is given, for every byte of this plan's parts as they are now, for an allowed operation, and for every bound value."""
    if approval.get("approved") is not True:
        raise NotApproved("the plan is not approved")
    if approval.get("plan_sha256") != parts.root_as_found(spark, folder, name):
        raise NotApproved("the plan is not the one that was approved")
    if approval.get("operation") not in operations:
        raise NotApproved(f"operation {approval.get('operation')} is not allowed here")
    for k, v in bound.items():
        if approval.get(k) != v:
            raise NotApproved(f"{k} differs from the approval's")


def execution_evidence(folder: Path, plan_sha256: str, rows: int, only: str | None = None) -> dict:
    """The newest execution summary below ``folder`` for this plan that accounts for all its rows."""
    for path in sorted(folder.rglob("execution-summary.json"), reverse=True):
        summary = json.loads(path.read_text(encoding="utf-8"))
        results = summary.get("results", {})
        if summary.get("plan_sha256") == plan_sha256 and sum(results.values()) == rows and not results.get("failed") and (only is None or set(results) == {only}):
            return summary
    raise FileNotFoundError("the plan has no complete execution")
