"""Text generation behind one interface. Models are external; a failure is ''."""

from __future__ import annotations

import contextlib
import hashlib
import json
import threading
import time
import urllib.request
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol, TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame

T = TypeVar("T")


class Provider(Protocol):
    def generate(self, prompt: str, system: str, temperature: float) -> str: ...


@dataclass(frozen=True)
class Stub:
    """Answers that depend on the prompt alone, for tests."""

    answer: str = ""

    def generate(self, prompt: str, system: str, temperature: float) -> str:
        return self.answer or hashlib.md5(f"{system}|{prompt}".encode()).hexdigest()


def _post(url: str, body: dict, timeout: float) -> dict:
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"})
    with urllib.request.urlopen(request, timeout=timeout) as reply:  # noqa: S310
        return json.load(reply)


@dataclass(frozen=True)
class CompletionServer:
    """A server with a plain ``generate`` endpoint."""

    url: str
    model: str
    timeout: float = 120

    def generate(self, prompt: str, system: str, temperature: float) -> str:
        try:
            body = {"model": self.model, "prompt": prompt, "system": system, "stream": False, "options": {"temperature": temperature}}
            return _post(self.url, body, self.timeout).get("response", "")
        except (OSError, ValueError):
            return ""


@dataclass(frozen=True)
class ChatServer:
    """A server with a ``chat/completions`` endpoint."""

    url: str
    model: str
    timeout: float = 300

    def generate(self, prompt: str, system: str, temperature: float) -> str:
        try:
            messages = [{"role": "system", "content": system}, {"role": "user", "content": prompt}]
            reply = _post(self.url, {"model": self.model, "messages": messages, "temperature": temperature}, self.timeout)
            return reply["choices"][0]["message"]["content"] or ""
        except (OSError, ValueError, KeyError, IndexError, TypeError):
            return ""


REGISTRY: dict[str, Callable[..., Provider]] = {"stub": Stub, "completion": CompletionServer, "chat": ChatServer}


def provider(name: str, **options) -> Provider:
    if name not in REGISTRY:
        raise ValueError(f"no provider {name}; there are {', '.join(sorted(REGISTRY))}")
    return REGISTRY[name](**options)


@dataclass(frozen=True)
class Pool:
    """How a task calls its provider: calls at once, calls begun per worker
    before the oldest has answered, tries of a call that gives nothing, and the
    seconds before the second try (twice as many before the next)."""

    workers: int = 8
    window: int = 4
    tries: int = 3
    wait: float = 0.5


def answer(using: Provider, prompt: str, system: str, temperature: float, pool: Pool) -> str:
    """The first answer that is not empty; '' when no try gives one."""
    for n in range(pool.tries):
        if n:
            time.sleep(pool.wait * 2 ** (n - 1))
        with contextlib.suppress(Exception):  # a provider that fails has no answer
            if reply := using.generate(prompt, system, temperature):
                return reply
    return ""


def answers(batches: Iterator[tuple[T, list[str | None]]], using: Provider, system: str, temperature: float, pool: Pool) -> Iterator[tuple[T, list[str]]]:
    """Each batch with the answers to its prompts, in order.

    Calls go on over the ends of batches: whenever one ends the next prompt is
    sent, and never more than ``workers * window`` are begun and not answered.
    """
    free = threading.Semaphore(pool.workers * pool.window)

    def call(prompt: str) -> str:
        try:
            return answer(using, prompt, system, temperature, pool)
        finally:
            free.release()

    waiting: deque[tuple[T, list[Future]]] = deque()
    with ThreadPoolExecutor(pool.workers) as threads:
        for batch, prompts in batches:
            sent = []
            for prompt in prompts:
                free.acquire()
                sent.append(threads.submit(call, prompt or ""))
            waiting.append((batch, sent))
            while waiting and all(f.done() for f in waiting[0][1]):
                done, replies = waiting.popleft()
                yield done, [f.result() for f in replies]
        while waiting:
            done, replies = waiting.popleft()
            yield done, [f.result() for f in replies]


def generate(prompts: DataFrame, using: Provider, prompt: str = "prompt", system: str = "", temperature: float = 0.7, to: str = "reply", pool: Pool = Pool()) -> DataFrame:
    """``prompts`` with a reply each, '' where the provider failed. A task has
    ``pool.workers`` calls in flight and keeps the order of its rows; filters and
    anti-joins belong before this step."""
    schema = ", ".join(f"`{n}` {t}" for n, t in prompts.dtypes) + f", `{to}` string"
    at = prompts.columns.index(prompt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # small pieces, so that what has been answered goes on
        pieces = (b.slice(i, 64) for b in batches for i in range(0, b.num_rows, 64))
        for piece, replies in answers(((p, p.column(at).to_pylist()) for p in pieces), using, system, temperature, pool):
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(replies, pa.string())], names=[*piece.schema.names, to])

    return prompts.mapInArrow(run, schema)
