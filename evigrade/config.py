"""Settings of a run, from the environment with a common prefix."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

PREFIX = "PCA_"


@dataclass(frozen=True)
class Settings:
    """What grading needs of the environment; capture and model settings belong to the tools that make the input tables."""

    scrape_profile_sequence: str = "standard,load_wait,full_page_scroll,expand_common_sections,extract_gallery_sources,shadow_iframe,retry_relaxed"
    scrape_profile_max_profiles: int = 7
    scrape_early_stop_score: int = 82
    max_images: int = 30
    vision_max: int = 12
    max_agent_iterations: int = 2
    geo_proxy_enabled: bool = True
    geo_retry_on_access_block: bool = True

    @classmethod
    def from_environment(cls, env: Mapping[str, str] | None = None) -> Settings:
        """Defaults, replaced by PREFIX + NAME where the environment has it and it can be read."""
        env = os.environ if env is None else env
        given = {}
        for f in fields(cls):
            text = env.get(f"{PREFIX}{f.name.upper()}", "").strip()
            if not text:
                continue
            if isinstance(f.default, bool):
                given[f.name] = text.lower() in ("1", "true", "yes", "y", "on")
            elif isinstance(f.default, int):
                try:
                    given[f.name] = int(float(text))
                except ValueError:
                    continue
            else:
                given[f.name] = text
        return cls(**given)


def by_country(name: str, country_code: str, env: Mapping[str, str] | None = None) -> str:
    """A setting of a country, else the general one, else empty; so proxies and languages are looked up."""
    env = os.environ if env is None else env
    country = (country_code or "").strip().upper()
    own = env.get(f"{PREFIX}{name}_{country}", "").strip() if country else ""
    return own or env.get(f"{PREFIX}{name}", "").strip()


def proxy_url(country_code: str = "", env: Mapping[str, str] | None = None) -> str:
    return by_country("PROXY_URL", country_code, env)


def accept_language(country_code: str = "", env: Mapping[str, str] | None = None) -> str:
    return by_country("ACCEPT_LANGUAGE", country_code, env)
