"""Write COVERAGE.md: SURVEY §2 ids -> functions, registered query keys and tests.

usage: python tools/coverage.py > COVERAGE.md
Ids are read from the docstrings of package functions, registered queries and
tests (e.g. "W9:", "A1/A2/A3", "(X-8)").
"""

from __future__ import annotations

import ast
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ID = re.compile(r"\b(ST[1-5]|AL[1-5]|S1[0-5]|S[1-9]|P2[0-5]|P1[0-9]|P[1-9]|T1[0-2]|T[1-9]|A2[0-2]|A1[0-9]|A[1-9]"
                r"|J[1-5]|W1[01]|W[1-9]|O[1-7]|U[12]|R[1-3]|M[1-5]|X-1[0-6]|X-[1-9])\b")
ORDER = ["S", "P", "T", "A", "J", "W", "O", "U", "R", "ST", "AL", "M", "X-"]


def scan(path: str, kind: str, found: dict) -> None:
    tree = ast.parse(open(path).read())
    rel = os.path.relpath(path, ROOT)
    for node in ast.walk(tree):
        if isinstance(node, (ast.FunctionDef, ast.ClassDef)):
            doc = ast.get_docstring(node) or ""
            key = None
            for d in node.decorator_list:
                if isinstance(d, ast.Call) and getattr(d.func, "id", "") == "query" and d.args:
                    key = d.args[0].value
            label = f"`{key}`" if key else f"`{rel}:{node.name}`"
            for m in set(ID.findall(doc.split("\n\n")[0] if kind != "test" else doc)):
                found.setdefault(m, {"code": set(), "query": set(), "test": set()})
                bucket = "query" if key else kind
                found[m][bucket].add(label)


def sort_key(i: str):
    m = re.match(r"([A-Z]+-?)(\d+)", i)
    return (ORDER.index(m.group(1)) if m.group(1) in ORDER else 99, int(m.group(2)))


def main() -> None:
    found: dict = {}
    for base, kind in (("fleetspark", "code"), ("tests", "test")):
        for dp, dirs, fs in os.walk(os.path.join(ROOT, base)):
            dirs[:] = [d for d in dirs if d != "llm"]  # operators of their own list
            for f in fs:
                if f.endswith(".py"):
                    scan(os.path.join(dp, f), kind, found)
    print("# Coverage of SURVEY §2\n")
    print("Generated by `python tools/coverage.py` from docstrings. Query keys are registered in")
    print("`__spark_entry__.queries()` with a DuckDB oracle in `oracle_sql()`; every registered query is also")
    print("compared with its oracle by `tests/test_queries.py` (sf0.001) and `tools/check_oracle.py` (sf0.01).\n")
    print("| ID | functions | registered queries | tests |\n|---|---|---|---|")
    for i in sorted(found, key=sort_key):
        f = found[i]
        print(f"| {i} | {', '.join(sorted(f['code'])) or '-'} | {', '.join(sorted(f['query'])) or '-'} | "
              f"{', '.join(sorted(t.split(':')[-1].rstrip('`') for t in f['test'])) or '-'} |")


if __name__ == "__main__":
    sys.exit(main())
