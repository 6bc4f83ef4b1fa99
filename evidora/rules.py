"""Static rules of this library, checked on its source: who may call out, read the environment, or raise what."""

from __future__ import annotations

import ast
from pathlib import Path

#: Modules that open connections; none is imported here, as senders are given by the caller.
NETWORK = {"http", "urllib", "socket", "requests", "httpx", "aiohttp"}
#: Errors that are not raised bare, so that every error has a code; ValueError and OSError are for wrong arguments and files.
BARE = {"Exception", "RuntimeError", "BaseException"}


def violations(root: str | Path) -> list[str]:
    """``file:line rule`` for each breach in the Python files below ``root``."""
    found = []
    for file in sorted(Path(root).rglob("*.py")):
        where = file.relative_to(root).as_posix()
        for node in ast.walk(ast.parse(file.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            for name in names:
                if name.split(".")[0] in NETWORK and name != "urllib.parse":
                    found.append(f"{where}:{node.lineno} network")
                if name.startswith("evidora.llm") and not where.startswith("llm/"):
                    found.append(f"{where}:{node.lineno} imports evidora.llm")
                if name.startswith("evidora.plans") and where.startswith(("operators/", "functions/", "sources/")):
                    found.append(f"{where}:{node.lineno} imports plans")
            if isinstance(node, ast.Attribute) and node.attr in {"environ", "getenv"} and where != "config.py":
                found.append(f"{where}:{node.lineno} environment")
            if isinstance(node, ast.Raise) and node.exc is not None:
                raised = node.exc.func if isinstance(node.exc, ast.Call) else node.exc
                if isinstance(raised, ast.Name) and raised.id in BARE:
                    found.append(f"{where}:{node.lineno} bare error")
            if isinstance(node, ast.Call) and isinstance(node.func, ast.Name) and node.func.id == "print":
                found.append(f"{where}:{node.lineno} print")
    return found
