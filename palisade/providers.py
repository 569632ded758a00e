"""Model services: what each is sent and where its answer is. The transport is a callable, so tests need no network."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade import constants as C
from palisade.functions.responses import REPLY_PATHS
from palisade.functions.text import estimated_tokens
from palisade.operators.throttle import Pace

#: url, headers, JSON payload, seconds -> status, body
Transport = Callable[[str, dict[str, str], dict, float], tuple[int, str]]


@dataclass(frozen=True)
class Service:
    name: str
    label: str
    endpoint: str
    model: str
    key_variable: str | None = None
    min_interval: float = 0.0


#: Services, their addresses and default models.
SERVICES = {
    s.name: s
    for s in (
        Service("lmstudio", "LM Studio", "http://127.0.0.1:1234/v1/chat/completions", "qwen2.5-coder-32b-instruct"),
        Service("ollama", "Ollama", "http://127.0.0.1:11434/api/chat", "qwen2.5-coder:32b"),
        Service("openai", "OpenAI", "https://api.openai.com/v1/chat/completions", "gpt-4o", "OPENAI_API_KEY"),
        Service("claude", "Claude", "https://api.anthropic.com/v1/messages", "claude-sonnet-4-6", "ANTHROPIC_API_KEY"),
        Service("gemini", "Gemini", "https://generativelanguage.googleapis.com/v1beta/models/{model}:generateContent", "gemini-2.0-flash-exp", "GOOGLE_API_KEY", C.MODEL_DELAY),
    )
}


def requests_transport(url: str, headers: dict[str, str], payload: dict, timeout: float) -> tuple[int, str]:
    import requests

    r = requests.post(url, headers=headers, json=payload, timeout=timeout)
    return r.status_code, r.text


@dataclass
class Provider:
    """generate(system, user) -> text. Failures raise RuntimeError; missing keys and bad arguments ValueError."""

    service: Service
    model: str
    endpoint: str
    key: str | None = None
    transport: Transport = requests_transport
    last: float = float("-inf")

    def request(self, system: str, user: str, temperature: float, max_tokens: int) -> tuple[str, dict[str, str], dict]:
        headers = {"Content-Type": "application/json"}
        turns = [{"role": "system", "content": system}, {"role": "user", "content": user}]
        kind = self.service.name
        url = self.endpoint.format(model=self.model)
        if kind == "ollama":
            return url, headers, {"model": self.model, "messages": turns, "stream": False, "options": {"temperature": temperature, "num_predict": max_tokens}}
        if kind == "claude":
            headers |= {"x-api-key": self.key or "", "anthropic-version": "2023-06-01"}
            return url, headers, {"model": self.model, "system": system, "messages": turns[1:], "temperature": temperature, "max_tokens": max_tokens}
        if kind == "gemini":
            return f"{url}?key={self.key}", headers, {"contents": [{"parts": [{"text": f"{system}\n\n{user}"}]}], "generationConfig": {"temperature": temperature, "maxOutputTokens": max_tokens}}
        if self.key:
            headers["Authorization"] = f"Bearer {self.key}"
        return url, headers, {"model": self.model, "messages": turns, "temperature": temperature, "max_tokens": max_tokens}

    def reply(self, status: int, body: str) -> str:
        if status == 429 and self.service.name == "gemini":
            raise RuntimeError(f"{self.service.label} rate limit exceeded")
        try:
            data = json.loads(body)
        except ValueError:
            data = {}
        if status != 200:
            error = data.get("error") if isinstance(data, dict) else None
            said = error.get("message", body) if isinstance(error, dict) else body
            raise RuntimeError(f"{self.service.label} error ({status}): {said}")
        try:
            for step in REPLY_PATHS[self.service.name][2:].replace("]", "").replace("[", ".").split("."):
                data = data[int(step) if step.isdigit() else step]
        except (KeyError, IndexError, TypeError):
            raise RuntimeError(f"{self.service.label}: unexpected response") from None
        return data

    def generate(self, system: str, user: str, temperature: float = C.TEMPERATURE, max_tokens: int = C.MAX_OUTPUT_TOKENS) -> str:
        if not isinstance(system, str) or not isinstance(user, str):
            raise ValueError("prompts must be strings")
        time.sleep(max(0.0, self.service.min_interval - (time.monotonic() - self.last)))
        self.last = time.monotonic()
        try:
            status, body = self.transport(*self.request(system, user, temperature, max_tokens), C.MODEL_TIMEOUT)
        except Exception as e:
            raise RuntimeError(f"{self.service.label} request failed: {e}") from e
        return self.reply(status, body)


def create(name: str, model: str | None = None, endpoint: str | None = None, api_key: str | None = None, transport: Transport = requests_transport) -> Provider:
    if name not in SERVICES:
        raise ValueError(f"unknown provider {name!r}; there are {', '.join(SERVICES)}")
    s = SERVICES[name]
    if s.key_variable and endpoint:
        raise ValueError(f"{s.label} has a fixed endpoint")
    key = api_key or (os.environ.get(s.key_variable) if s.key_variable else None)
    if s.key_variable and not key:
        raise ValueError(f"{s.label} needs an API key: set {s.key_variable} or pass api_key")
    return Provider(s, model or s.model, endpoint or s.endpoint, key, transport)


SYSTEM_PROMPT = "You extract what defenders can detect from security reports."


TEMPLATE = """Read the report below and answer with one YAML mapping and nothing else. Copy values as they stand in the
report; leave a field empty where the report says nothing. The fields are those of this empty record:

{RECORD}

Report:
{REPORT_TEXT}
"""


def default_template() -> str:
    """TEMPLATE with the canonical record filled in."""
    from palisade.operators.records import schema_json

    return TEMPLATE.replace("{RECORD}", schema_json())


def render(template: str, chunk) -> F.Column:
    return F.replace(F.lit(template), F.lit("{REPORT_TEXT}"), chunk)


def answers(
    chunks: DataFrame, provider: Callable[[], Provider], template: str, keys: tuple[str, ...] = ("url", "chunk_idx"),
    parallel: int = 1, pause: float = C.RETRY_PAUSE, interval: float = 0.0,
) -> DataFrame:
    """keys, raw, error: the model's answer to each chunk that isn't too long; transient failures are tried once more.

    `parallel` tasks call at the same time, all of them together once each `interval` seconds (0: as fast as they can).
    Calls cost money and differ each time: write the result.
    """
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in chunks.select(*keys).schema] + ["raw string, error string"])
    began = time.time()
    asked = chunks.where(estimated_tokens(F.col("chunk")) <= C.MAX_INPUT_TOKENS).select(*keys, render(template, F.col("chunk")).alias("prompt"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        service, pace = provider(), Pace(interval, TaskContext.get().partitionId(), parallel, began)
        for batch in batches:
            out = []
            for prompt in batch["prompt"]:
                for attempt in (0, 1):
                    pace.wait()
                    try:
                        out.append((service.generate(SYSTEM_PROMPT, prompt), None))
                        break
                    except RuntimeError as e:
                        if attempt or not any(x in str(e).lower() for x in C.TRANSIENT_ERRORS):
                            out.append((None, str(e)))
                            break
                        time.sleep(pause)
            yield batch[list(keys)].assign(raw=[r for r, _ in out], error=[e for _, e in out])

    return asked.repartition(parallel).mapInPandas(run, schema)


def recorded(chunks: DataFrame, recordings: DataFrame, template: str, keys: tuple[str, ...] = ("url", "chunk_idx")) -> DataFrame:
    """keys, raw from recorded answers (prompt_hash, raw): the offline form of answers()."""
    return chunks.select(*keys, F.sha2(render(template, F.col("chunk")).cast("binary"), 256).alias("prompt_hash")).join(recordings, "prompt_hash", "left").drop("prompt_hash")
