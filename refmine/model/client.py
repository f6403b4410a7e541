"""Clients of a language model. A client is made within each partition and closed there."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol


@dataclass(frozen=True)
class ModelSettings:
    """Settings of a served model; the defaults are those of the extraction stage."""

    base_url: str = "http://localhost:8000/v1"
    model: str = "Qwen/Qwen3-VL-235B-A22B-Instruct-FP8"
    api_key: str = "EMPTY"
    temperature: float = 0.1
    max_tokens: int = 1024
    timeout_s: float = 360.0
    max_concurrency: int = 500


class LLMClient(Protocol):
    async def complete(self, system: str, user: str) -> str: ...

    async def close(self) -> None: ...


class ServedClient:
    """A chat endpoint in the usual protocol; its library is imported where it is used."""

    def __init__(self, settings: ModelSettings):
        from openai import AsyncOpenAI  # optional dependency

        self.settings = settings
        self.client = AsyncOpenAI(base_url=settings.base_url, api_key=settings.api_key, timeout=settings.timeout_s)

    async def complete(self, system: str, user: str) -> str:
        s = self.settings
        answer = await self.client.chat.completions.create(
            model=s.model, temperature=s.temperature, max_tokens=s.max_tokens, messages=[{"role": "system", "content": system}, {"role": "user", "content": user}]
        )
        return answer.choices[0].message.content or ""

    async def close(self) -> None:
        await self.client.close()


class RuleClient:
    """A deterministic stand-in: a function of the user prompt."""

    def __init__(self, rule: Callable[[str], str]):
        self.rule = rule

    async def complete(self, system: str, user: str) -> str:
        return self.rule(user)

    async def close(self) -> None:
        return None


def served(settings: ModelSettings | None = None) -> Callable[[], LLMClient]:
    return lambda: ServedClient(settings or ModelSettings())


#: Marks of the parts of a prompt.
CONTEXT_MARK = "Citation context: "
TITLE_MARK = "Title: "
