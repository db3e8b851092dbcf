"""Provider, model and setting reconciliation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c

# --- fixed values -------------------------------------------------------------------
PROVIDERS = ("anthropic", "openai")
MODEL_PREFIXES = {"anthropic": ("claude",), "openai": ("gpt", "o1", "o3", "o4")}
DEFAULT_MODEL = {"anthropic": "claude-sonnet-4-20250514", "openai": "gpt-4o"}
MAX_OUTPUT_TOKENS = 8192
# the request field that carries the output cap, per provider
TOKEN_CAP_FIELD = {"anthropic": "max_tokens", "openai": "max_completion_tokens"}
# ------------------------------------------------------------------------------------


def check_provider(provider: str) -> str:
    """Only the two known providers are accepted."""
    if provider not in PROVIDERS:
        raise ValueError(f"Unknown provider: {provider!r} (expected one of {PROVIDERS})")
    return provider


def _starts_with_any(col: Column, prefixes) -> Column:
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | col.startswith(p)
    return cond


def resolve_model(provider, model) -> Column:
    """Swap in the provider's default when the model name clearly belongs to the
    other provider; unknown names pass unchanged."""
    p, m = _c(provider), _c(model)
    out = m
    for name, default in DEFAULT_MODEL.items():
        foreign = [x for other, prefixes in MODEL_PREFIXES.items() if other != name for x in prefixes]
        out = F.when((p == name) & _starts_with_any(m, foreign), F.lit(default)).otherwise(out)
    return out


def first_set(*cols) -> Column:
    """First setting that is truthy in Python terms (NULL, '' and 0 fall through)."""
    parts = []
    for c in cols:
        c = _c(c)
        parts.append(F.when(c.cast("string").isin("", "0"), F.lit(None)).otherwise(c))
    return F.coalesce(*parts)


def first_set_value(*values):
    """Driver-side form of :func:`first_set` (CLI value, config value, environment)."""
    for v in values:
        if v:
            return v
    return values[-1] if values else None


# fixed values: (least, most) per setting; None has no bound
SETTING_BOUNDS = {"batch_size": (1, None), "workers": (1, 64)}


def validate_settings(batch_size: int, workers: int | None = None) -> None:
    """Every given setting lies within SETTING_BOUNDS; the batch size is required."""
    given = {"batch_size": batch_size if batch_size is not None else 0}
    if workers is not None:
        given["workers"] = workers
    outside = {k: v for k, v in given.items()
               if v < SETTING_BOUNDS[k][0] or v > (SETTING_BOUNDS[k][1] or v)}
    if outside:
        raise ValueError(f"settings out of bounds {SETTING_BOUNDS}: {outside}")
