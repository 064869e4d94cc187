"""Client of a local text-generation service, and its use on a few prompts as a DataFrame."""

from __future__ import annotations

import json
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

# Address, model, time-out and temperature; one corrective JSON retry.
BASE_URL = "http://localhost:11434"
MODEL = "qwen2.5:7b-instruct"
TIMEOUT_SECONDS = 120
TEMPERATURE = 0.1


class TextServiceError(Exception):
    """The service answered with an error or something unreadable."""


class TextServiceUnavailable(TextServiceError):
    """The service cannot be reached or lacks the model."""


class TextServiceParseError(TextServiceError):
    """No valid JSON after the corrective retry."""


def http_call(url: str, payload: dict | None, timeout: float) -> dict:
    body = json.dumps(payload).encode() if payload is not None else None
    request = urllib.request.Request(url, body, {"Content-Type": "application/json"})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as response:
            return json.loads(response.read())
    except urllib.error.HTTPError as error:
        raise TextServiceError(f"{url}: HTTP {error.code}") from error
    except OSError as error:
        raise TextServiceUnavailable(f"{url}: {error}") from error
    except ValueError as error:
        raise TextServiceError(f"{url}: answer is not JSON") from error


@dataclass
class TextService:
    base_url: str = BASE_URL
    model: str = MODEL
    timeout: float = TIMEOUT_SECONDS
    call: Callable[[str, dict | None, float], dict] = http_call

    def list_models(self) -> list[str]:
        answer = self.call(f"{self.base_url.rstrip('/')}/api/tags", None, self.timeout)
        return [m["name"] for m in answer.get("models", []) if "name" in m]

    def is_available(self) -> bool:
        """True when a model of the configured family is there; never raises."""
        family = self.model.split(":")[0]
        try:
            return any(name.startswith(family) for name in self.list_models())
        except TextServiceError:
            return False

    def generate(
        self,
        prompt: str,
        system_prompt: str = "",
        as_json: bool = False,
        temperature: float = TEMPERATURE,
        check: bool = True,
    ) -> str:
        if check and not self.is_available():
            raise TextServiceUnavailable(f"no model '{self.model}' at {self.base_url}")
        payload: dict = {
            "model": self.model,
            "prompt": prompt,
            "stream": False,
            "options": {"temperature": temperature},
        }
        if system_prompt:
            payload["system"] = system_prompt
        if as_json:
            payload["format"] = "json"
        answer = self.call(f"{self.base_url.rstrip('/')}/api/generate", payload, self.timeout)
        return str(answer.get("response", "")).strip()

    def generate_json(self, prompt: str, system_prompt: str = "") -> dict:
        """Parsed JSON; an unreadable first answer is sent back once for correction."""
        first = self.generate(prompt, system_prompt, as_json=True)
        try:
            return json.loads(first)
        except ValueError:
            again = (
                "This answer was not valid JSON. Send it again as valid JSON only, without any "
                f"other text: {first}"
            )
        try:
            return json.loads(self.generate(again, system_prompt, as_json=True))
        except ValueError as error:
            raise TextServiceParseError("no valid JSON after one retry") from error


def generator(
    make_service: Callable[[], TextService],
    system_prompt: str = "",
    key: str = "change_id",
    output: str = "generated",
    tasks: int = 1,
) -> Callable[[DataFrame], DataFrame]:
    """A function from ``key, prompt`` rows to ``key, output`` rows.

    Prompts the service cannot answer are left out, so that the caller falls back to its
    template. Meant for the few hundred prompts of a report.
    """

    def answer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        service = make_service()
        available = service.is_available()  # asked once per task
        for frame in frames:
            rows = []
            if not available:
                yield pd.DataFrame(rows, columns=[key, output])
                continue
            for name, prompt in zip(frame[key], frame["prompt"]):
                try:
                    text = service.generate(prompt, system_prompt, check=False)
                except TextServiceError:
                    continue
                if text:
                    rows.append((name, text))
            yield pd.DataFrame(rows, columns=[key, output])

    def run(prompts: DataFrame) -> DataFrame:
        kind = prompts.schema[key].dataType.simpleString()
        slim = prompts.select(key, "prompt").repartition(tasks, key)
        return slim.mapInPandas(answer, f"{key} {kind}, {output} string")

    return run
