"""Parameters, with defaults that the environment can override."""

from __future__ import annotations

import os
import warnings
from dataclasses import dataclass, field

#: Texts that mean false.
_FALSY = {"false", "0", "no", "f"}
#: How a text is read, where that is not what the type itself does.
_PARSERS = {bool: lambda text: text.strip().lower() not in _FALSY}


def env(name: str, default, cast=str):
    """The environment variable as a value of type cast; the default if it is unset, and with a warning if it can't be read."""
    if name not in os.environ:
        return default
    try:
        return _PARSERS.get(cast, cast)(os.environ[name])
    except (TypeError, ValueError) as why:
        warnings.warn(f"{name} can't be read as {cast.__name__} ({why}); {default!r} is used", stacklevel=2)
    return default


def env_stopwords() -> tuple[str, ...]:
    return tuple(w.strip() for w in env("ER_STOPWORDS", "").split(",") if w.strip())


@dataclass(frozen=True)
class BlockingParams:
    """Adaptive blocking. ``fallbacks`` adds the older keys for companies without a token."""

    max_block_size: int = 200
    use_domain: bool = True
    use_name3_country: bool = True
    use_compact5_city: bool = True
    refine_domain_with_country: bool = True
    enable_stage3_token: bool = True
    enable_stage3_name6: bool = True
    stage3_min_token_len: int = 3
    stage3_stopwords: tuple[str, ...] = field(default_factory=env_stopwords)
    fallbacks: bool = False

    def __post_init__(self):
        if not (self.use_domain or self.use_name3_country or self.use_compact5_city):
            raise ValueError("enable at least one stage-1 key")
        if self.max_block_size < 2:
            raise ValueError("max_block_size must be 2 or more")


@dataclass(frozen=True)
class Settings:
    blocking: BlockingParams = field(default_factory=BlockingParams)
    cap_per_a: int = 200
    hi: float = field(default_factory=lambda: env("ER_HI", 0.90, float))
    lo: float = field(default_factory=lambda: env("ER_LO", 0.10, float))
    empty_domain_is_null: bool = False
    include_singletons: bool = False
    model_path: str | None = field(default_factory=lambda: env("ER_MODEL_PATH", None))
    company_file: str = field(default_factory=lambda: env("COMPANY_FILE", "/opt/test-data/companies.zip"))
