"""Jobs and print profiles from JSON, and small sinks: driver-side, as these are single small files.

A path inside a manifest counts from the manifest's folder.  Checks give messages, never half a job.
"""

from __future__ import annotations

import json
import math
import os
import re
import tempfile
import zipfile
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

# Domains of a job, and states that a stage may need.
SOURCE_TYPES, BOUNDARIES, STYLE_POLICIES = ("docx", "pdf"), ("saved_rendered", "explicit"), ("source_authority", "content_only")
LANGUAGES = ("hindi", "latin", "math")
PATHS = ("source", "template", "normalized_source", "content_manifest", "review_queue", "layout_reference", "approved_reference", "preview_output", "final_output")
PROTECTED, OUTPUTS = ("source", "template", "layout_reference", "approved_reference"), ("preview_output", "final_output")


@dataclass(frozen=True)
class Job:
    """A job as its manifest has it; paths are absolute."""

    root: Path
    values: dict[str, Any]
    paths: dict[str, Path | None] = field(default_factory=dict)

    @property
    def source_type(self) -> str:
        return self.values.get("source_type", "docx")

    @property
    def boundary(self) -> str:
        return self.values.get("boundary_strategy", "explicit" if self.source_type == "pdf" else "saved_rendered")

    @property
    def ranges(self) -> list[tuple[int, int]]:
        return [(int(a), int(b)) for a, b in self.values.get("content_page_ranges", [])]

    def content_pages(self) -> list[int]:
        """Every page of the ranges in order."""
        return [p for a, b in self.ranges for p in range(a, b + 1)]

    def expected_pages(self, stage: str) -> list[int]:
        return list(self.values.get("preview_source_page_numbers", [])) if stage == "preview" else self.content_pages()

    def document(self, stage: str) -> Path | None:
        return self.paths.get({"source": "source", "preview": "preview_output", "final": "final_output"}[stage])


def load_job(path: str | Path) -> Job:
    path = Path(path).resolve()
    values = json.loads(path.read_text(encoding="utf-8"))
    if not isinstance(values, dict):
        raise ValueError(f"{path} is no job manifest")
    return Job(path.parent, values, {k: (path.parent / values[k]).resolve() if values.get(k) else None for k in PATHS})


def range_errors(ranges: list[tuple[int, int]], what: str) -> list[str]:
    """Each range must be one, and begin after the one before it ends."""
    out, last = [], 0
    for a, b in ranges:
        if not 1 <= a <= b:
            out.append(f"{what}: {a} to {b} is no range of pages")
        if a <= last:
            out.append(f"{what}: {a} to {b} doesn't come after page {last}")
        last = max(last, b)
    return out


def job_errors(job: Job) -> list[str]:
    """Everything that is wrong with a job."""
    v, out = job.values, []
    for name, domain, value in (
        ("source_type", SOURCE_TYPES, job.source_type), ("boundary_strategy", BOUNDARIES, job.boundary),
        ("source_style_policy", STYLE_POLICIES, v.get("source_style_policy", STYLE_POLICIES[0])),
    ):
        if value not in domain:
            out.append(f"{name} is {value}, not one of {', '.join(domain)}")
    out += [f"{name} is missing" for name in ("book_name", "source", "template") if not v.get(name)]
    out += range_errors(job.ranges, "content_page_ranges")
    pages = job.content_pages()
    preview = v.get("preview_source_page_numbers", [])
    if len(set(preview)) != len(preview):
        out.append("preview_source_page_numbers has a page twice")
    if lost := sorted(set(preview) - set(pages)) if pages else []:
        out.append(f"preview pages {lost} are no content pages")
    if "content_page_count" in v and v["content_page_count"] != len(pages):
        out.append(f"content_page_count is {v['content_page_count']}, the ranges have {len(pages)} pages")
    if job.source_type == "pdf" and job.boundary != "explicit":
        out.append("a pdf has explicit boundaries only")
    if lost := [x for x in LANGUAGES if x not in v.get("fonts", {})] if "fonts" in v else []:
        out.append(f"fonts has none for {', '.join(lost)}")
    taken = {job.paths[k]: k for k in PROTECTED if job.paths.get(k)}
    made = [(k, job.paths[k]) for k in OUTPUTS if job.paths.get(k)]
    out += [f"{k} would overwrite {taken[p]}" for k, p in made if p in taken]
    if len({p for _, p in made}) != len(made):
        out.append("two outputs have one path")
    return out


def manifest_scope(path: str | Path) -> str | None:
    return json.loads(Path(path).read_text(encoding="utf-8")).get("scope")


_PROFILE_NAME = re.compile(r"[a-z0-9][a-z0-9_-]*")


def load_profile(folder: str | Path, name: str, fallback: dict[str, Any]) -> dict[str, Any]:
    """The print layout of a named profile, ``fallback`` where it has none; a name is never a path."""
    if not _PROFILE_NAME.fullmatch(name):
        raise ValueError(f"{name!r} is no profile name")
    layout = json.loads((Path(folder) / f"{name}.json").read_text(encoding="utf-8")).get("print_layout", fallback)
    if errors := profile_errors(layout):
        raise ValueError("; ".join(errors))
    return layout


def profile_errors(layout: dict[str, Any]) -> list[str]:
    """Tokens that aren't positive, and sums that don't agree."""
    page, options, out = layout.get("page", {}), layout.get("options", {}), []
    for group in (page, options):
        out += [f"{k} must be a positive number" for k, v in group.items() if isinstance(v, (int, float)) and not isinstance(v, bool) and not (math.isfinite(v) and v > 0)]
    need = ("width_mm", "inside_margin_mm", "outside_margin_mm", "text_width_mm")
    if all(k in page for k in need) and abs(page["inside_margin_mm"] + page["outside_margin_mm"] + page["text_width_mm"] - page["width_mm"]) > 0.2:
        out.append("margins and text don't fill the page")
    for name, grid in options.get("grids", {}).items():
        if "table_width" in options and sum(grid) != options["table_width"]:
            out.append(f"grid {name} is {sum(grid)} wide, the table {options['table_width']}")
    return out


# --- sinks --------------------------------------------------------------------------------------


def write_text(path: str | Path, text: str) -> None:
    """Whole or not at all: written beside, then renamed."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, beside = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(handle, "w", encoding="utf-8", newline="\n") as f:
            f.write(text)
        os.replace(beside, path)
    except BaseException:
        Path(beside).unlink(missing_ok=True)
        raise


def write_json(path: str | Path, value: Any) -> None:
    write_text(path, json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n")


def write_package(path: str | Path, parts: dict[str, bytes]) -> None:
    """A new zip package with its parts in order, tested before it gets its name; never over another file."""
    path = Path(path)
    if path.exists():
        raise FileExistsError(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, beside = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    os.close(handle)
    try:
        with zipfile.ZipFile(beside, "w", zipfile.ZIP_DEFLATED) as z:
            for name in sorted(parts):
                z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), parts[name], zipfile.ZIP_DEFLATED)
        with zipfile.ZipFile(beside) as z:
            if bad := z.testzip():
                raise ValueError(f"{bad} can't be read back")
        os.link(beside, path)  # fails where the name is taken
    finally:
        Path(beside).unlink(missing_ok=True)


def write_report(path: str | Path, title: str, errors: list[str], warnings: list[str], facts: dict[str, Any]) -> None:
    """A report of fixed form: verdict, facts in order, then errors and warnings."""
    lines = [title, "=" * len(title), f"Result: {'FAIL' if errors else 'PASS'}", *[f"{k}: {facts[k]}" for k in sorted(facts)]]
    for head, found in (("Errors", errors), ("Warnings", warnings)):
        lines += ["", f"{head} ({len(found)})", *[f"- {x}" for x in found]]
    write_text(path, "\n".join(lines) + "\n")


def draft_manifest(path: str | Path) -> Path:
    path = Path(path)
    return path.with_name(f"{path.stem}.draft{path.suffix}")


def draft_review(root: str | Path) -> Path:
    return Path(root) / "Review" / "review_queue.draft.json"


def draft_errors(job: Job, drafts: dict[str, Path]) -> list[str]:
    """Drafts may not stand where a source, a template, a reviewed file or another draft stands."""
    taken = {p: k for k in (*PROTECTED, "content_manifest", "review_queue") if (p := job.paths.get(k))}
    out, seen = [], {}
    for name, path in drafts.items():
        path = Path(path).resolve()
        if path in taken:
            out.append(f"{name} would overwrite {taken[path]}")
        if path in seen:
            out.append(f"{name} and {seen[path]} have one path")
        seen[path] = name
    return out
