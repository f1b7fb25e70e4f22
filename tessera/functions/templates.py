"""Prompt templates: markdown with front matter, variables, versions."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

# Section headings of a template document.
SECTIONS = ("System Prompt", "User Prompt", "User Prompt Template")
LONG_VALUE = 1000


@dataclass(frozen=True)
class Template:
    meta: dict[str, str] = field(default_factory=dict)
    sections: dict[str, str] = field(default_factory=dict)


def parse(text: str) -> Template:
    """Front matter between ``---`` lines, then a section per ``##`` heading."""
    meta: dict[str, str] = {}
    if front := re.match(r"\s*---\n(.*?)\n---\n", text, re.DOTALL):
        meta = {k.strip(): v.strip().strip("\"'") for k, sep, v in (x.partition(":") for x in front[1].splitlines()) if sep}
        text = text[front.end() :]
    parts = re.split(r"(?m)^##\s+(.+?)\s*$", text)
    return Template(meta, {h: body.strip() for h, body in zip(parts[1::2], parts[2::2])})


def fill(text: str, **values: object) -> tuple[str, str]:
    """(filled text, the same for the log): ``{name}`` becomes its value; the log
    has a note instead of values over 1000 characters. Unknown names stay."""
    full = re.sub(r"\{(\w+)\}", lambda m: str(values.get(m[1], m[0])), text)
    short = {k: v if len(str(v)) <= LONG_VALUE else f"[{k}: {len(str(v))} characters]" for k, v in values.items()}
    return full, re.sub(r"\{(\w+)\}", lambda m: str(short.get(m[1], m[0])), text)


def version_order(version: str) -> tuple[int, ...]:
    return tuple(int(x) for x in re.findall(r"\d+", version))


class Registry:
    """{type: {version: {created_at, ..., is_current}}}, kept as JSON text."""

    def __init__(self, text: str = "{}"):
        self.types: dict[str, dict[str, dict]] = json.loads(text)

    def dumps(self) -> str:
        return json.dumps(self.types, indent=2, sort_keys=True)

    def put(self, kind: str, version: str, current: bool = False, **meta: object) -> None:
        self.types.setdefault(kind, {})[version] = {**meta, "is_current": False}
        if current:
            self.set_current(kind, version)

    def set_current(self, kind: str, version: str) -> None:
        if version not in self.types.get(kind, {}):
            raise KeyError(f"{kind} has no version {version}")
        for v, meta in self.types[kind].items():
            meta["is_current"] = v == version

    def current(self, kind: str) -> str | None:
        """The current version, else the latest by number."""
        versions = self.types.get(kind, {})
        marked = [v for v, m in versions.items() if m.get("is_current")]
        return marked[0] if marked else max(versions, key=version_order, default=None)

    def versions(self, kind: str) -> list[str]:
        return sorted(self.types.get(kind, {}), key=lambda v: str(self.types[kind][v].get("created_at", "")), reverse=True)
