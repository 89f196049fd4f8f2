"""Tool servers behind a JSON-RPC client: compile server, analyzer-fix server, language server.

They are what an injected check, analyzer or fix of the operators calls; results
of any shape become plain codes, severities and ranges.
"""

from __future__ import annotations

import json
from pathlib import Path
from urllib.parse import unquote, urlparse

from .calls import ProcessClient

# Severities of the language-server protocol.
SEVERITIES = {1: "error", 2: "warning", 3: "info", 4: "hidden"}


def code_of(d: dict) -> str:
    """A diagnostic's code, whether it is a text, a number or an object with a value; '' without one."""
    code = d.get("code", d.get("id", ""))
    if isinstance(code, dict):
        code = code.get("value", "")
    return "" if code is None else str(code)


def severity_of(d: dict) -> str:
    """error, warning, info or hidden, from a number or a word; errors where nothing is said."""
    given = d.get("severity", 1)
    if isinstance(given, str) and given.isdigit():
        given = int(given)
    return SEVERITIES.get(given, "error") if isinstance(given, int) else str(given or "error").lower()


def range_of(d: dict) -> tuple[int, int]:
    """(line, column) from 1, of a protocol range (from 0) or of plain numbers."""
    start = (d.get("range") or {}).get("start")
    if start:
        return int(start.get("line", 0)) + 1, int(start.get("character", 0)) + 1
    return int(d.get("line", d.get("startLine", 1)) or 1), int(d.get("column", d.get("startColumn", 1)) or 1)


def file_of(d: dict) -> str:
    """The path of a diagnostic, from a path or a file URI."""
    at = d.get("uri") or d.get("file") or d.get("filePath") or ""
    return unquote(urlparse(at).path) if at.startswith("file:") else at.replace("\\", "/")


class ToolServer:
    """A server of named tools: results are the JSON in their text parts, else the text, else the result itself."""

    def __init__(self, client: ProcessClient):
        self.client = client
        client.request("initialize", {"protocolVersion": "2024-11-05", "capabilities": {}, "clientInfo": {"name": "sedimenta", "version": "1"}})
        client.notify("notifications/initialized")

    def call(self, tool: str, **arguments) -> object:
        result = self.client.request("tools/call", {"name": tool, "arguments": arguments})
        if not isinstance(result, dict) or "content" not in result:
            return result
        text = "\n".join(part.get("text", "") for part in result["content"] if part.get("type") == "text")
        if result.get("isError"):
            raise RuntimeError(text or f"{tool} failed")
        try:
            return json.loads(text)
        except ValueError:
            return text

    def diagnostics(self, tool: str, **arguments) -> list[dict]:
        """(file, line, column, severity, code, message) of a tool that answers with a list of them, bare or under diagnostics."""
        found = self.call(tool, **arguments)
        found = found.get("diagnostics", []) if isinstance(found, dict) else found
        return [{"file": file_of(d), "line": range_of(d)[0], "column": range_of(d)[1], "severity": severity_of(d), "code": code_of(d), "message": str(d.get("message", ""))} for d in found or [] if isinstance(d, dict)]


class CompileServer(ToolServer):
    """A resident compiler."""

    def compile(self, project: str) -> list[dict]:
        return self.diagnostics("al_compile", projectPath=project)

    def build(self, project: str) -> object:
        return self.call("al_build", projectPath=project)

    def get_diagnostics(self, project: str) -> list[dict]:
        return self.diagnostics("al_get_diagnostics", projectPath=project)

    def run_tests(self, project: str) -> object:
        return self.call("al_run_tests", projectPath=project)


class FixServer(ToolServer):
    """Analyzers with their own fixes."""

    def analyze(self, project: str) -> list[dict]:
        return self.diagnostics("analyze", projectPath=project)

    def list_rules(self) -> object:
        return self.call("list_rules")

    def get_fixes(self, project: str, file: str, code: str, line: int, column: int) -> object:
        return self.call("get_fixes", projectPath=project, filePath=file, diagnosticId=code, line=line, column=column)

    def apply_fix(self, project: str, file: str, code: str, line: int, column: int, key: str) -> object:
        return self.call("apply_fix", projectPath=project, filePath=file, diagnosticId=code, line=line, column=column, equivalenceKey=key)

    def apply_fix_all(self, project: str, code: str) -> object:
        return self.call("apply_fix_all", projectPath=project, diagnosticId=code)


class LanguageServer:
    """Navigation and diagnostics of open documents."""

    def __init__(self, client: ProcessClient, project: str):
        self.client, self.open = client, {}
        client.request("initialize", {"processId": None, "rootUri": Path(project).absolute().as_uri(), "capabilities": {}})
        client.notify("initialized")

    def _document(self, path: str, text: str | None = None) -> dict:
        uri = Path(path).absolute().as_uri()
        if uri not in self.open or text is not None and self.open[uri] != text:
            new = text if text is not None else Path(path).read_text("utf8", "replace")
            method = "textDocument/didChange" if uri in self.open else "textDocument/didOpen"
            self.client.notes = [n for n in self.client.notes if n.get("params", {}).get("uri") != uri]
            version = 1 + len(self.client.notes)
            self.client.notify(method, {"textDocument": {"uri": uri, "languageId": "al", "version": version, "text": new}, "contentChanges": [{"text": new}]})
            self.open[uri] = new
        return {"uri": uri}

    def diagnostics(self, path: str, text: str | None = None, timeout: float = 30.0) -> list[dict]:
        document = self._document(path, text)
        got = self.client.wait("textDocument/publishDiagnostics", lambda p: p.get("uri") == document["uri"], timeout)
        return [{"line": range_of(d)[0], "column": range_of(d)[1], "severity": severity_of(d), "code": code_of(d), "message": str(d.get("message", ""))} for d in (got or {}).get("diagnostics", [])]

    def error_codes(self, path: str, text: str | None = None) -> list[str]:
        return sorted({d["code"] for d in self.diagnostics(path, text) if d["severity"] == "error"})

    def is_error_clean(self, path: str, text: str | None = None) -> bool:
        return not self.error_codes(path, text)

    def document_symbols(self, path: str) -> object:
        return self.client.request("textDocument/documentSymbol", {"textDocument": self._document(path)})

    def _at(self, method: str, path: str, line: int, column: int) -> object:
        return self.client.request(f"textDocument/{method}", {"textDocument": self._document(path), "position": {"line": line - 1, "character": column - 1}})

    def hover(self, path: str, line: int, column: int) -> object:
        return self._at("hover", path, line, column)

    def definition(self, path: str, line: int, column: int) -> object:
        return self._at("definition", path, line, column)

    def completion(self, path: str, line: int, column: int) -> list[str]:
        """Labels of what may stand there."""
        got = self._at("completion", path, line, column)
        items = got.get("items", []) if isinstance(got, dict) else got or []
        return [i.get("label", "") for i in items]
