"""Predicates over label sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from marketlens.functions.columns import as_column

# Tags that force an age affirmation, and the wider list of tags
# that only disclose mature content. The second contains the first.
AGE_GATED_TAGS = ["Hentai", "NSFW"]
MATURE_TAGS = [
    "Hentai", "NSFW",
    "Nudity", "Sexual Content",
    "Gore", "Violent", "Blood",
    "Mature", "Horror", "Survival Horror", "Psychological Horror",
    "Zombies", "Crime", "War", "World War I", "World War II", "Cold War",
    "Dark", "Dark Fantasy", "Dark Humor", "Dark Comedy", "Demons", "Psychological",
    "Gambling", "Assassin", "Villain Protagonist", "Heist",
]


def has_any_label(labels: Column | str, wanted: Sequence[str]) -> Column:
    """True when the array shares a label with ``wanted``; a NULL array counts as sharing none.

    For a map pass ``F.map_keys(column)``.
    """
    overlap = F.arrays_overlap(as_column(labels), F.array(*[F.lit(label) for label in wanted]))
    return F.coalesce(overlap, F.lit(False))
