"""
their docstrings) and to the registered queries that exercise it (writes docs/COVERAGE.md)."""

from __future__ import annotations

import ast
import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

GROUPS = {
    "S": 10, "K": 9, "J": 1, "P": 11, "C": 4, "A": 9, "D": 2, "G": 1, "W": 19, "F": 2, "T": 6, "M": 18,
    "O": 5, "X": 1, "E": 7, "U": 4, "N": 3,
}
ID_RE = re.compile(r"\b([SKJPCADGWFTMOXEUN])(\d{1,2})\b")


def ids_in(text: str) -> set[str]:
    found = set()
    for m in re.finditer(r"\b([SKJPCADGWFTMOXEUN])(\d{1,2})(?:\s*-\s*[SKJPCADGWFTMOXEUN]?(\d{1,2}))?\b", text):
        letter, a, b = m.group(1), int(m.group(2)), m.group(3)
        for i in range(a, (int(b) if b else a) + 1):
            if i <= GROUPS.get(letter, 0):
                found.add(f"{letter}{i}")
    return found


def main() -> None:
    funcs: dict[str, list[str]] = {}
    for path in sorted((ROOT / "tickforge").rglob("*.py")):
        if "plans" in path.parts:
            continue
        tree = ast.parse(path.read_text())
        mod = ".".join(path.relative_to(ROOT).with_suffix("").parts)
        for node in ast.walk(tree):
            if isinstance(node, (ast.FunctionDef, ast.ClassDef)) and not node.name.startswith("_"):
                for i in ids_in(ast.get_docstring(node) or ""):
                    funcs.setdefault(i, []).append(f"`{mod}.{node.name}`")
    from tickforge.plans.catalog import REGISTRY

    qs: dict[str, list[str]] = {}
    for name, q in REGISTRY.items():
        for i in ids_in(q.ops):
            qs.setdefault(i, []).append(f"`{name}`" + ("" if q.sql else " (rows)"))
    lines = ["# Operator coverage", "", "Generated by `tools/coverage_report.py` from docstrings and the query registry.",
             "`(rows)` marks a query without SQL oracle (rows-only check).", "",
             "| ID | Functions | Queries |", "|---|---|---|"]
    missing = []
    for letter, n in GROUPS.items():
        for i in range(1, n + 1):
            key = f"{letter}{i}"
            f, q = funcs.get(key, []), qs.get(key, [])
            if not f and not q:
                missing.append(key)
            lines.append(f"| {key} | {', '.join(sorted(set(f))) or '-'} | {', '.join(sorted(set(q))) or '-'} |")
    lines += ["", f"IDs without function or query: {', '.join(missing) or 'none'}"]
    (ROOT / "docs" / "COVERAGE.md").write_text("\n".join(lines) + "\n")
    print("\n".join(lines[-3:]))
    print("no function:", [k for letter, n in GROUPS.items() for k in [f"{letter}{i}" for i in range(1, n + 1)] if k not in funcs])
    print("no query:", [k for letter, n in GROUPS.items() for k in [f"{letter}{i}" for i in range(1, n + 1)] if k not in qs])


if __name__ == "__main__":
    main()
