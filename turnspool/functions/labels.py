"""Loss labels as array expressions. Positions that do not count hold ``IGNORE``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the label a loss function skips.
IGNORE = -100


def ignored(count: Column) -> Column:
    return F.array_repeat(F.lit(IGNORE), count)


def attention_mask(ids: Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(ids))


def capped_prompt_length(prompt_length: Column, ids: Column) -> Column:
    return F.least(prompt_length, F.size(ids))


def _keep_after(ids: Column, opened: Column, eos_id: int | None) -> Column:
    """Ignore the first ``opened`` positions, and one eos at the very end if it is still open."""
    size = F.size(ids)
    if eos_id is None:
        return F.concat(ignored(opened), F.slice(ids, opened + 1, size - opened))
    closing = F.when(
        (opened < size) & (F.get(ids, size - 1) == F.lit(eos_id)), F.lit(1)
    ).otherwise(F.lit(0))
    return F.concat(
        ignored(opened), F.slice(ids, opened + 1, size - opened - closing), ignored(closing)
    )


def labels_by_length(ids: Column, prompt_length: Column, eos_id: int | None) -> Column:
    """Only what lies behind the first ``prompt_length`` ids counts."""
    return _keep_after(ids, capped_prompt_length(prompt_length, ids), eos_id)


def marker_end(ids: Column, marker: Column) -> Column:
    """How many ids lead up to the end of the last occurrence of ``marker``; null without one."""
    width = F.size(marker)
    starts = F.when(
        (width > 0) & (F.size(ids) >= width), F.sequence(F.lit(1), F.size(ids) - width + 1)
    )
    hits = F.filter(
        starts,
        lambda i: (F.get(ids, i - 1) == F.get(marker, F.lit(0)))
        & (F.slice(ids, i, width) == marker),
    )
    return F.array_max(hits) + width - 1


def labels_by_marker(ids: Column, marker: Column, eos_id: int | None) -> Column:
    """Only what follows the last occurrence of ``marker`` counts; without one, nothing does."""
    opened = F.coalesce(marker_end(ids, marker), F.size(ids))
    return _keep_after(ids, opened, eos_id)


def active_labels(labels: Column) -> Column:
    return F.size(F.filter(labels, lambda x: x != IGNORE))
