"""Model providers: embeddings and completions over an OpenAI-compatible API.

A provider is a preset, overridden by TURNSTONE_* settings of the environment,
or "hashing", the deterministic embedder that needs no model.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from turnstone.sources.http import Client, StatusError, TransportError

from .enrich import Embedder, hashing_embedder

Completer = Callable[[str], str]


class ProviderError(RuntimeError):
    """A provider that is not set up, or one that gave no usable answer."""


@dataclass(frozen=True)
class Provider:
    name: str
    base_url: str | None = None
    embed_model: str | None = None
    chat_model: str | None = None
    api_key: str | None = None


#: Public endpoints and the models they are used with.
PRESETS = {
    p.name: p
    for p in (
        Provider("ollama", "http://localhost:11434/v1", "nomic-embed-text", "llama3.2"),
        Provider("lmstudio", "http://localhost:1234/v1"),
        Provider("openai", "https://api.openai.com/v1", "text-embedding-3-small", "gpt-4o-mini"),
        Provider("openrouter", "https://openrouter.ai/api/v1"),
        Provider("jina", "https://api.jina.ai/v1", "jina-embeddings-v5-text-small"),
        Provider("hashing", None, "hashing-64"),
    )
}
_SETTINGS = {"base_url": "TURNSTONE_BASE_URL", "embed_model": "TURNSTONE_EMBED_MODEL", "chat_model": "TURNSTONE_CHAT_MODEL", "api_key": "TURNSTONE_API_KEY"}


def resolve(name: str | None = None, environment: Mapping[str, str] = os.environ) -> Provider:
    """The provider *name*, or TURNSTONE_PROVIDER, or "custom" where only an address is set."""
    given = {field: environment[key] for field, key in _SETTINGS.items() if environment.get(key)}
    name = name or environment.get("TURNSTONE_PROVIDER") or ("custom" if "base_url" in given else None)
    if name is None:
        raise ProviderError(f"no provider: name one of {', '.join(PRESETS)} or set {_SETTINGS['base_url']}")
    if name not in PRESETS and (name != "custom" or "base_url" not in given):
        raise ProviderError(f"unknown provider {name!r}, or no {_SETTINGS['base_url']} for it")
    return replace(PRESETS.get(name, Provider("custom")), **given)


def _post(provider: Provider, client: Client, path: str, body: dict) -> dict:
    headers = {"Authorization": f"Bearer {provider.api_key}"} if provider.api_key else {}
    try:
        return client.must("POST", f"{provider.base_url}{path}", body, headers=headers)
    except (StatusError, TransportError) as error:
        raise ProviderError(str(error)) from error


def embedder(provider: Provider, client: Callable[[], Client] = Client) -> Embedder:
    """Texts to vectors, in the order of the texts; the client is made where it is used."""
    if provider.name == "hashing":
        return hashing_embedder(int(provider.embed_model.rpartition("-")[2]))
    if not provider.embed_model:
        raise ProviderError(f"{provider.name} needs {_SETTINGS['embed_model']}")

    def embed(texts: Sequence[str]) -> list[list[float]]:
        found = _post(provider, client(), "/embeddings", {"model": provider.embed_model, "input": list(texts)})["data"]
        vectors = {item["index"]: item["embedding"] for item in found}
        if len(vectors) != len(texts):
            raise ProviderError(f"{len(vectors)} vectors for {len(texts)} texts")
        return [vectors[i] for i in range(len(texts))]

    return embed


def completer(provider: Provider, client: Callable[[], Client] = Client) -> Completer:
    """A prompt to a model's answer, at temperature zero."""
    if not provider.chat_model or not provider.base_url:
        raise ProviderError(f"{provider.name} has no chat model")

    def complete(prompt: str) -> str:
        body = {"model": provider.chat_model, "messages": [{"role": "user", "content": prompt}], "temperature": 0}
        return _post(provider, client(), "/chat/completions", body)["choices"][0]["message"]["content"]

    return complete
