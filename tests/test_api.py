"""The names the README shows are importable (public API guard)."""

import ast
import importlib
from pathlib import Path


def test_readme_imports_resolve():
    text = Path(__file__).resolve().parents[1].joinpath("README.md").read_text()
    block = text.split("## Using the library", 1)[1].split("```python", 1)[1].split("```", 1)[0]
    imports = [n for n in ast.parse(block).body if isinstance(n, ast.ImportFrom)]
    assert len(imports) >= 4
    for node in imports:
        module = importlib.import_module(node.module)
        for alias in node.names:
            assert hasattr(module, alias.name), f"{node.module}.{alias.name}"
