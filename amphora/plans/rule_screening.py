"""Q1: sequences x enzymes -> digest -> rule score -> summary -> rank."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from amphora import fixed
from amphora.fixed import EnzymeRule
from amphora.operators.digest import digest
from amphora.operators.ranking import rank_screening
from amphora.operators.screening import screen


def screen_combinations(
    sequences: DataFrame,
    enzymes: Iterable[EnzymeRule | str] | None = None,
    min_length: int = fixed.DEFAULT_MIN_LENGTH,
    max_length: int = fixed.DEFAULT_MAX_LENGTH,
    keys: Sequence[str] = ("protein", "accession_id"),
) -> DataFrame:
    """A1 end to end: one summary row per (protein, enzyme) pair that yields
    at least one peptide. ``sequences`` has ``keys`` and ``sequence``.

    Plan: scan -> Generate (enzymes x fragments) -> Filter
    (length) -> partial aggregate -> exchange on the pair -> final aggregate.
    """
    seqs = sequences.select(*keys, "sequence")
    peptides = digest(seqs, "sequence", enzymes, min_length, max_length, keep=list(keys))
    return screen(peptides, keys, "enzyme", min_length, max_length)


def ranked_screening(sequences: DataFrame, **kw) -> DataFrame:
    """A1 + T1: summary with a global ``rank`` column (1 = best)."""
    return rank_screening(screen_combinations(sequences, **kw))
