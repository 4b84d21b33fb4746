"""Settings of a run, from the environment, with defaults that need no service."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Providers, folders and limits. Nothing is created when it is read; sinks make the folders they write to."""

    provider: str = "clod"
    openrouter_model: str = "anthropic/claude-haiku-4.5"
    clod_model: str = "google/gemma-3n-E4B-it"
    fallback_model: str = "openai/gpt-4o-mini"
    server_url: str = ""
    token: str = ""
    retries: int = 3
    timeout_s: int = 120
    output_dir: str = "output"
    logs_dir: str = "logs"
    reports_dir: str = "reports"
    truth_dir: str = "ground_truth"
    ocr_cache_dir: str = "ocr_cache"

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, root: str = "") -> Settings:
        """LLM_PROVIDER, OR_DEFAULT_MODEL, CLOD_DEFAULT_MODEL, UPLOAD_SERVER_URL, UPLOAD_TOKEN, CLOD_RETRIES, CLOD_TIMEOUT; folders lie below root."""
        env = os.environ if env is None else env
        names = {
            "provider": "LLM_PROVIDER", "openrouter_model": "OR_DEFAULT_MODEL", "clod_model": "CLOD_DEFAULT_MODEL", "server_url": "UPLOAD_SERVER_URL",
            "token": "UPLOAD_TOKEN", "retries": "CLOD_RETRIES", "timeout_s": "CLOD_TIMEOUT",
        }
        given = {field: env[name] for field, name in names.items() if name in env}
        made = cls(**{k: int(v) if k in ("retries", "timeout_s") else v.lower() if k == "provider" else v for k, v in given.items()})
        if not root:
            return made
        folders = {f: f"{root.rstrip('/')}/{getattr(made, f)}" for f in ("output_dir", "logs_dir", "reports_dir", "truth_dir", "ocr_cache_dir")}
        return cls(**{**made.__dict__, **folders})

    def model(self, asked: str | None = None, provider: str | None = None) -> str:
        """The model of a run: the one asked for, else the provider's default."""
        return asked or (self.clod_model if (provider or self.provider) == "clod" else self.openrouter_model)
