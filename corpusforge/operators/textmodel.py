"""Calls to a text model as a dependent map over prompts, and what is read from the answers.

A call is expensive and not repeatable: distinct prompts are called once, answers are written
under the prompt's hash before anything else reads them, and a later run asks only for prompts
that have no answer yet. Put filters before the call; the optimizer does not move them across it.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import json_in_prose, strip
from corpusforge.operators.mocks import label_model as mock_model  # noqa: F401
from corpusforge.operators.mocks import list_model as mock_list_model  # noqa: F401
from corpusforge.session import materialize

Model = Callable[[str], str]


class KeyRing:
    """Access keys taken in turn; at most `at_once` calls and a least interval between two calls of one key; after a failure another key, after linear waiting.

    A ring can be sent to workers: locks are made where it is used. Give each worker its own keys
    (`answered(..., rings=...)`), else the bounds hold per worker only.
    """

    def __init__(self, keys: list[str], interval: float = 0.0, retries: int = 3, backoff: float = 0.0, at_once: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.keys, self.interval, self.retries, self.backoff, self.at_once, self.clock, self.sleep = keys or [""], interval, retries, backoff, at_once, clock, sleep
        self._start()

    def _start(self) -> None:
        self.next, self.last, self.lock = 0, dict.fromkeys(self.keys, float("-inf")), threading.Lock()
        self.free = {k: threading.Semaphore(self.at_once) for k in self.keys}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("next", "last", "lock", "free")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._start()

    def _take(self, avoid: str | None) -> str:
        with self.lock:
            turn = [self.keys[(self.next + i) % len(self.keys)] for i in range(len(self.keys))]
            key = next((k for k in turn if k != avoid), turn[0])
            self.next = (self.keys.index(key) + 1) % len(self.keys)
        self.free[key].acquire()
        with self.lock:
            begin = max(self.clock(), self.last[key] + self.interval)
            self.last[key] = begin
            wait = begin - self.clock()
        if wait > 0:
            self.sleep(wait)
        return key

    def call(self, ask: Callable[[str], str]) -> str:
        failed, key = None, None
        for turn in range(1, self.retries + 1):
            key = self._take(key if failed else None)
            try:
                return ask(key)
            except Exception as error:  # noqa: BLE001
                failed = error
            finally:
                self.free[key].release()
            if self.backoff and turn < self.retries:
                self.sleep(self.backoff * turn)
        raise failed  # type: ignore[misc]


class Keyed:
    """A model that takes (prompt, key), called through a ring of keys."""

    def __init__(self, model: Callable[[str, str], str], ring: KeyRing):
        self.model, self.ring = model, ring

    def __call__(self, prompt: str) -> str:
        return self.ring.call(lambda key: self.model(prompt, key))


class ChatModel:
    """A model behind an HTTP service of the usual chat form, as model(prompt, key). `send(url, headers, body)` gives the answer's JSON text; the default asks the network.

    Small enough to be sent to workers. An answer without a text is an error, so that a ring of keys tries again.
    """

    def __init__(self, base_url: str, model: str, max_tokens: int = 4096, temperature: float = 0.0, seed: int | None = None, timeout: float = 120.0, send: Callable[[str, dict, str], str] | None = None):
        self.url, self.model, self.max_tokens, self.temperature, self.seed, self.timeout, self.send = base_url.rstrip("/") + "/chat/completions", model, max_tokens, temperature, seed, timeout, send

    def _post(self, url: str, headers: dict, body: str) -> str:
        from urllib.request import Request, urlopen

        with urlopen(Request(url, body.encode(), headers), timeout=self.timeout) as answer:  # noqa: S310
            return answer.read().decode()

    def __call__(self, prompt: str, key: str = "") -> str:
        body = {"model": self.model, "messages": [{"role": "user", "content": prompt}], "max_tokens": self.max_tokens, "temperature": self.temperature}
        if self.seed is not None:
            body["seed"] = self.seed
        told = json.loads((self.send or self._post)(self.url, {"Content-Type": "application/json", "Authorization": f"Bearer {key}"}, json.dumps(body)))
        text = told["choices"][0]["message"]["content"]
        if not isinstance(text, str):
            raise ValueError("an answer without text")
        return text


def rendered(template: str, fields: dict[str, Column]) -> Column:
    """The template with every {{name}} replaced; null values as empty text."""
    out = F.lit(template)
    for name, value in fields.items():
        out = F.replace(out, F.lit("{{" + name + "}}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def answered(df: DataFrame, prompt: str, model: Model, known: DataFrame | None = None, rings: list[KeyRing] | None = None) -> DataFrame:
    """df with `answer`. known: (prompt_hash, answer) of earlier runs.

    rings: the prompts are dealt to one partition for each ring; the model is then called as model(prompt, key)
    with the keys of that partition's ring alone, so a key is never used in two places.
    """
    hashed = df.withColumn("prompt_hash", F.sha2(F.col(prompt), 256))
    wanted = hashed.where(F.col(prompt).isNotNull()).groupBy("prompt_hash").agg(F.min(prompt).alias("prompt"))
    if known is not None:
        wanted = wanted.join(known.select("prompt_hash"), "prompt_hash", "left_anti")
    if rings:
        wanted = wanted.repartition(len(rings), "prompt_hash")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = Keyed(model, rings[TaskContext.get().partitionId() % len(rings)]) if rings else model
        for b in batches:
            yield pd.DataFrame({"prompt_hash": b["prompt_hash"], "answer": [call(p) for p in b["prompt"]]})

    fresh = materialize(wanted.mapInPandas(ask, "prompt_hash string, answer string"), "answers")
    answers = fresh if known is None else fresh.unionByName(known.select("prompt_hash", "answer"))
    return hashed.join(answers, "prompt_hash", "left")


def in_answer(answer: Column, path: str, kind: str = "string") -> Column:
    """A field of the JSON in an answer; null if there is none."""
    return F.try_variant_get(json_in_prose(answer), path, kind)


def listed_in_answer(df: DataFrame, answer: str, path: str, pos: str, value: str) -> DataFrame:
    """df with a row for every element of the list at path in the JSON of an answer, or of the list that the JSON is: its place from 0 and its value (variant)."""
    found = json_in_prose(F.col(answer))
    listed = F.coalesce(F.try_variant_get(found, path, "array<variant>"), F.try_variant_get(found, "$", "array<variant>"))
    return df.select("*", F.posexplode(listed).alias(pos, value))


def verdict(answer: Column) -> Column:
    """'PASS' in any case with outer blanks, else 'FAIL', null included."""
    return F.when(F.upper(strip(answer)) == "PASS", "PASS").otherwise("FAIL")


def relied_on(answer: Column) -> Column:
    """'Keep' for a verdict of PASS, else 'Hard Reject'."""
    return F.when(verdict(answer) == "PASS", "Keep").otherwise("Hard Reject")


def zipped(left: DataFrame, right: DataFrame, by: list[str], pos: str, defaults: dict[str, object]) -> DataFrame:
    """left with the columns of right at the same place of its group; defaults where right is shorter, what is longer is left out."""
    out = left.join(right, [*by, pos], "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
