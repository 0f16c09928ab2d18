"""The feature registry: a JSON document with atomic replacement, a view as a DataFrame, and a command line."""

from __future__ import annotations

import argparse
import csv
import json
import os
from datetime import datetime, timezone

from orebody.sources import io

STATUSES = ("proposed", "implemented", "validated", "selected", "rejected")
FIELDS = ("name", "theme", "hypothesis", "expected_direction", "calculation_logic", "status", "created_at", "updated_at")


def validate_status(status: str) -> str:
    if status not in STATUSES:
        raise ValueError(f"unknown status {status!r}: one of {', '.join(STATUSES)}")
    return status


def _now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


def load(path: str) -> dict:
    if not os.path.exists(path):
        return {"features": [], "created_at": _now(), "updated_at": _now()}
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def save(path: str, document: dict) -> None:
    io.write_json(document | {"updated_at": _now()}, path)


def list_features(path: str, theme: str | None = None, status: str | None = None) -> list[dict]:
    return [f for f in load(path)["features"] if (theme is None or f["theme"] == theme) and (status is None or f["status"] == status)]


def register(path: str, name: str, theme: str, hypothesis: str, expected_direction: str = "unknown", calculation_logic: str | None = None, status: str = "proposed") -> bool:
    """False, and nothing changed, if the name is there already."""
    document = load(path)
    if any(f["name"] == name for f in document["features"]):
        return False
    now = _now()
    document["features"].append(dict(zip(FIELDS, (name, theme, hypothesis, expected_direction, calculation_logic, validate_status(status), now, now))))
    save(path, document)
    return True


def update(path: str, name: str, **changes) -> dict:
    """Changes the given fields; KeyError for an unknown name, ValueError for an unknown status or field."""
    if unknown := set(changes) - set(FIELDS[1:6]):
        raise ValueError(f"unknown fields: {', '.join(sorted(unknown))}")
    if changes.get("status"):
        validate_status(changes["status"])
    document = load(path)
    found = next((f for f in document["features"] if f["name"] == name), None)
    if found is None:
        raise KeyError(name)
    found.update({k: v for k, v in changes.items() if v is not None}, updated_at=_now())
    save(path, document)
    return found


def export(path: str, target: str) -> int:
    """CSV or JSON, by the target's suffix; the number of features."""
    features = load(path)["features"]
    if target.endswith(".csv"):
        with open(target, "w", newline="", encoding="utf-8") as f:
            writer = csv.DictWriter(f, FIELDS, extrasaction="ignore")
            writer.writeheader()
            writer.writerows(features)
    else:
        io.write_json({"features": features}, target)
    return len(features)


def as_frame(spark, path: str):
    return spark.createDataFrame([tuple(f.get(k) for k in FIELDS) for f in load(path)["features"]], ", ".join(f"{k} string" for k in FIELDS))


def show(features: list[dict]) -> str:
    return "\n".join(f"{f['name']:40} {f['theme']:16} {f['status']:12} {f['hypothesis']}" for f in features) or "no features"


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="orebody.registry", description="Feature registry")
    parser.add_argument("--path", default="feature_registry.json")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("list")
    p.add_argument("--theme")
    p.add_argument("--status")
    p = sub.add_parser("register")
    for k in FIELDS[:3]:
        p.add_argument(f"--{k}", required=True)
    p.add_argument("--expected-direction", default="unknown")
    p.add_argument("--calculation-logic")
    p.add_argument("--status", default="proposed")
    p = sub.add_parser("update")
    p.add_argument("--name", required=True)
    for k in FIELDS[1:6]:
        p.add_argument(f"--{k.replace('_', '-')}")
    p = sub.add_parser("export")
    p.add_argument("--output", required=True)
    a = parser.parse_args(argv)
    try:
        if a.command == "list":
            print(show(list_features(a.path, a.theme, a.status)))
        elif a.command == "register":
            done = register(a.path, a.name, a.theme, a.hypothesis, a.expected_direction, a.calculation_logic, a.status)
            print(f"registered {a.name}" if done else f"warning: {a.name} is registered already")
        elif a.command == "update":
            update(a.path, a.name, **{k: getattr(a, k) for k in FIELDS[1:6]})
            print(f"updated {a.name}")
        else:
            print(f"exported {export(a.path, a.output)} features")
    except (KeyError, ValueError) as e:
        print(f"error: {e}")
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
