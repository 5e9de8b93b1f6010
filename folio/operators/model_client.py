"""A chat model behind HTTP, as the settings name it."""

from __future__ import annotations

import json
import urllib.request
from dataclasses import dataclass, field

from folio.sources.settings import ModelSettings

PATH = "/chat/completions"


@dataclass(frozen=True)
class HttpModel:
    """Messages to a response. It holds nothing but plain values, so tasks can take it along; each call is a request of
    its own, and whatever goes wrong is raised for the exchange to try again."""

    url: str
    key: str = field(repr=False)
    model: str
    max_tokens: int
    temperature: float
    timeout: float

    def __call__(self, messages: list[dict[str, str]]) -> dict:
        asked = {"model": self.model, "messages": messages, "max_tokens": self.max_tokens, "temperature": self.temperature, "response_format": {"type": "json_object"}}
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        request = urllib.request.Request(self.url, json.dumps(asked, ensure_ascii=False).encode(), headers)
        with urllib.request.urlopen(request, timeout=self.timeout) as response:
            return json.loads(response.read())


def client_of(settings: ModelSettings) -> HttpModel | None:
    """None where no model is to be asked."""
    if not settings.enabled:
        return None
    if not settings.base_url or not settings.model:
        raise ValueError("llm.enabled needs llm.base_url and llm.model")
    base = settings.base_url.rstrip("/")
    return HttpModel(base if base.endswith(PATH) else base + PATH, settings.api_key, settings.model, settings.max_tokens, settings.temperature, settings.timeout_seconds)
