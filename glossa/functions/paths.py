"""Path and locale predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c


def path_parts(path) -> Column:
    """Components of a path, '/' or '\\' separated (the sort key of O1).

    Python compares ``Path`` objects by component, so ``a/x`` sorts before ``a-b/x``
    although plain string order says otherwise; sorting on this array does the same.
    """
    return F.split(_c(path), r"[/\\]")


def is_locale_path(path, locale: str) -> Column:
    """Some component equals the locale, or the locale with '-' -> '_' (any case)."""
    loc = locale.lower()
    return F.arrays_overlap(F.split(F.lower(_c(path)), r"[/\\]"),
                            F.array(F.lit(loc), F.lit(loc.replace("-", "_"))))


def not_voice(name) -> Column:
    """Archive names that mention 'voice' (any case) are not text archives."""
    return ~F.lower(_c(name)).contains("voice")


def locale_code(locale) -> Column:
    """Text before the first '-' ("tr-tr" -> "tr")."""
    return F.split_part(_c(locale), F.lit("-"), F.lit(1))


def relative_to(path, root: str) -> Column:
    """Store paths relative to the scan root with '/' separators, so that moving the
    work folder does not void the log."""
    root = root.rstrip("/") + "/"
    p = F.regexp_replace(_c(path), r"^file:(//)?", "")
    p = F.regexp_replace(p, r"\\", "/")
    r = root[len("file:"):] if root.startswith("file:") else root
    return F.when(p.startswith(r), F.substr(p, F.lit(len(r) + 1))).otherwise(p)


def glob_to_like(glob: str) -> str:
    """Translate a shell glob with '*' and '?' into a LIKE pattern (escaping '_' and '%')."""
    out = []
    for ch in glob:
        if ch == "*":
            out.append("%")
        elif ch == "?":
            out.append("_")
        elif ch in "_%\\":
            out.append("\\" + ch)
        else:
            out.append(ch)
    return "".join(out)
