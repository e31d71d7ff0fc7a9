"""Production parameters that queries and the pipeline share."""

from __future__ import annotations

from dataclasses import replace

from .mixing import Mix

_DOMAINS = {"crawl": 30, "books": 40, "forums": 30}
_LANGUAGES = {"en": 60, "de": 15, "fr": 15, "es": 10}

MIX = Mix(
    weights={(d,): w for d, w in _DOMAINS.items()} | {(d, x): w for d in _DOMAINS for x, w in _LANGUAGES.items()},
    budget_percent=70,
    max_epochs=3,
)

#: The pipeline repeats nothing that it has just deduplicated.
PIPELINE_MIX = replace(MIX, budget_percent=80, max_epochs=1)
