"""Settings from the environment and the command line."""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass

from palisade import constants as C
from palisade.providers import SERVICES


@dataclass(frozen=True)
class Config:
    verbose: bool = False
    request_delay: float = C.REQUEST_DELAY
    max_articles: int = C.MAX_ARTICLES_PER_SOURCE
    provider: str = "lmstudio"
    model: str | None = None
    endpoint: str | None = None
    api_key: str | None = None


def from_environment(env: dict[str, str] | None = None, args: list[str] | None = None) -> Config:
    env = os.environ if env is None else env
    parser = argparse.ArgumentParser(prog="palisade", description="Extract behaviours and indicators from security reports.")
    which = parser.add_mutually_exclusive_group()
    for s in SERVICES.values():
        which.add_argument(f"--{s.name}", dest="provider", action="store_const", const=s.name, help=s.label)
    parser.add_argument("--model")
    parser.add_argument("--endpoint")
    parser.add_argument("--api-key")
    a = parser.parse_args([] if args is None else args)
    return Config(
        env.get("VERBOSE", "").lower() in ("1", "true", "yes"), float(env.get("REQUEST_DELAY", C.REQUEST_DELAY)), int(env.get("MAX_ARTICLES_PER_SOURCE", C.MAX_ARTICLES_PER_SOURCE)),
        a.provider or "lmstudio", a.model, a.endpoint, a.api_key,
    )
