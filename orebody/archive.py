"""Archiving a run: outputs/ moves to archives/analysis_run/<time>_<slug>/project, with a summary; a fresh workspace stays."""

from __future__ import annotations

import argparse
import json
import re
import shutil
from datetime import datetime
from pathlib import Path

from orebody.sources import io

WORKSPACE = ("reports", "data", "proposed_features")
SUMMARIES = {"candidate": "candidate_pool/candidate_pool_summary.json", "selection": "selection/feature_selection_report.json"}


def slug(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", "-", text.lower()).strip("-") or "run"


def read_json(path: Path) -> dict:
    return json.loads(path.read_text(encoding="utf-8")) if path.exists() else {}


def targets(root: Path) -> list[Path]:
    """What is moved: outputs/ and nothing else."""
    return [p for p in (root / "outputs",) if p.exists()]


def reset_workspace(root: Path) -> None:
    for name in WORKSPACE:
        (root / "outputs" / name).mkdir(parents=True, exist_ok=True)


def archive(root: str | Path, title: str = "run", now: datetime | None = None) -> Path:
    root = Path(root)
    found = targets(root)
    if not found:
        raise FileNotFoundError(f"no outputs in {root}")
    facts = {k: read_json(root / "outputs" / p) for k, p in SUMMARIES.items()}
    files = [str(p.relative_to(root)) for t in found for p in sorted(t.rglob("*")) if p.is_file()]
    folder = root / "archives" / "analysis_run" / f"{(now or datetime.now()):%Y%m%d_%H%M%S}_{slug(title)}"
    (folder / "project").mkdir(parents=True)
    for t in found:
        shutil.move(str(t), str(folder / "project" / t.name))
    lines = [f"# {title}", "", f"Files: {len(files)}", *[f"{k} {name}: {v}" for k, d in facts.items() for name, v in d.items()], ""]
    io.write_text("\n".join(lines), folder / "summary.md")
    io.write_json({"title": title, "files": files, **facts}, folder / "artifacts.json")
    reset_workspace(root)
    return folder


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="orebody.archive", description="Archive a run")
    parser.add_argument("--root", default=".")
    parser.add_argument("--title", default="run")
    parser.add_argument("--yes", action="store_true", help="do not ask")
    a = parser.parse_args(argv)
    if not a.yes and input(f"Move {a.root}/outputs to the archive? [y/N] ").strip().lower() != "y":
        print("nothing moved")
        return 1
    print(archive(a.root, a.title))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
