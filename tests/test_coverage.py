"""COVERAGE.md names queries and tests that exist."""

from __future__ import annotations

import os
import re

import catalog

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def cells():
    with open(os.path.join(ROOT, "COVERAGE.md"), encoding="utf-8") as lines:
        for line in lines:
            parts = [p.strip() for p in line.strip().strip("|").split("|")]
            if len(parts) == 4 and parts[0] not in ("ID", "---"):
                yield parts


def test_queries_exist():
    named = {q for c in cells() for q in re.findall(r"`([^`*]+)`", c[2])}
    assert named == catalog.QUERIES.keys()


def test_tests_exist():
    source = ""
    for name in os.listdir(os.path.join(ROOT, "tests")):
        if name.startswith("test_") and name.endswith(".py"):
            with open(os.path.join(ROOT, "tests", name), encoding="utf-8") as text:
                source += text.read()
    for c in cells():
        for test in re.findall(r"`(test_\w+)`", c[3]):
            assert f"def {test}(" in source, test
