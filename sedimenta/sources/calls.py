"""Connectors to tools outside the engine: child processes spoken to in JSON, and slow calls in batches.

All are plain callables, so validators and models are injected, and kept once per Python worker.
"""

from __future__ import annotations

import json
import queue
import subprocess
import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

_CLIENTS: dict[tuple, "ProcessClient"] = {}


class ProcessClient:
    """JSON-RPC 2.0 over a child's pipes; one message per line, or with Content-Length headers.

    ``framing`` "auto" asks in lines and, if the child gives no answer in
    ``patience`` seconds or ends, starts it anew and asks with headers.
    Notifications that come in between are kept in ``notes``.
    """

    def __init__(self, command: list[str], *, framing: str = "lines", patience: float = 2.0):
        self.command, self.framing, self.patience = command, framing, patience
        self.notes: list[dict] = []
        self._id, self._lock = 0, threading.Lock()
        self._start("lines" if framing == "auto" else framing)

    def _start(self, framing: str) -> None:
        self._sent_as = framing
        self._child = subprocess.Popen(self.command, stdin=subprocess.PIPE, stdout=subprocess.PIPE)
        self._inbox: queue.Queue[dict | None] = queue.Queue()
        threading.Thread(target=self._listen, args=(self._child, self._inbox), daemon=True).start()

    def _listen(self, child: subprocess.Popen, inbox: queue.Queue) -> None:
        """Messages in either framing, told apart by their first bytes; null at the end."""
        try:
            while line := child.stdout.readline():
                if line.lower().startswith(b"content-"):
                    length = 0
                    while line.strip():
                        name, _, value = line.partition(b":")
                        length = int(value) if name.strip().lower() == b"content-length" else length
                        line = child.stdout.readline()
                    inbox.put(json.loads(child.stdout.read(length)))
                elif line.strip().startswith(b"{"):
                    inbox.put(json.loads(line))
        except (OSError, ValueError):
            pass
        inbox.put(None)

    def _send(self, message: dict) -> None:
        body = json.dumps({"jsonrpc": "2.0", **message}).encode()
        try:
            self._child.stdin.write(body + b"\n" if self._sent_as == "lines" else b"Content-Length: %d\r\n\r\n" % len(body) + body)
            self._child.stdin.flush()
        except BrokenPipeError:
            if self.framing != "auto":
                raise EOFError("the tool closed its input") from None

    def request(self, method: str, params: dict | None = None) -> object:
        with self._lock:
            self._id += 1
            message = {"id": self._id, "method": method, "params": params or {}}
            self._send(message)
            while True:
                try:
                    got = self._inbox.get(timeout=self.patience if self.framing == "auto" else None)
                except queue.Empty:
                    got = None
                if got is None and self.framing == "auto" and self._sent_as == "lines":
                    self._child.kill()
                    self._start("headers")
                    self.framing = "headers"
                    self._send(message)
                elif got is None:
                    raise EOFError("the tool closed its output")
                elif got.get("id") == self._id and "method" not in got:
                    self.framing = self._sent_as
                    if "error" in got:
                        raise RuntimeError(got["error"].get("message", "error"))
                    return got.get("result")
                else:
                    self.notes.append(got)

    def notify(self, method: str, params: dict | None = None) -> None:
        with self._lock:
            self._send({"method": method, "params": params or {}})

    def wait(self, method: str, ok: Callable[[dict], bool] = lambda params: True, timeout: float = 30.0) -> dict | None:
        """Parameters of the newest notification of a method that fits; null if none comes in time."""
        until = time.monotonic() + timeout
        with self._lock:
            while True:
                fit = [n.get("params", {}) for n in self.notes if n.get("method") == method and ok(n.get("params", {}))]
                if fit:
                    return fit[-1]
                try:
                    got = self._inbox.get(timeout=max(0.0, until - time.monotonic()))
                except queue.Empty:
                    return None
                if got is None:
                    return None
                self.notes.append(got)

    def close(self) -> None:
        self._child.stdin.close()
        self._child.wait(timeout=10)


def client(command: list[str], framing: str = "lines") -> ProcessClient:
    """The worker's one client of a command; a dead one is replaced."""
    key = (*command, framing)
    have = _CLIENTS.get(key)
    if have is None or have._child.poll() is not None:
        have = _CLIENTS[key] = ProcessClient(command, framing=framing)
    return have


def transient(error: Exception) -> bool:
    """Is it worth another try: a timeout, or a server's own failure (5xx)?"""
    status = getattr(error, "status", None) or getattr(error, "code", None)
    return isinstance(error, TimeoutError) or isinstance(status, int) and 500 <= status < 600


def in_order(call: Callable, inputs: list, *, workers: int = 3, retries: int = 1, again: Callable[[Exception], bool] = transient) -> list[tuple[object, str | None]]:
    """(result, error) per input, in order; what fails for a passing reason is tried again, all else reported; it costs no other."""

    def one(x):
        for attempt in range(retries + 1):
            try:
                return call(x), None
            except Exception as e:
                if attempt == retries or not again(e):
                    return None, f"{type(e).__name__}: {e}"

    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(one, inputs))
