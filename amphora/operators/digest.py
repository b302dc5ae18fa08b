"""In-silico digestion: sequences -> peptide rows.

Enzyme rules and combinations are plan-time configuration (like a query's
literals), so each rule becomes a literal ``split`` expression and the
sequence x enzyme pairing is a ``Generate`` over a literal array, not a join:
no shuffle, no broadcast, and the work per task is one input row at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amphora import fixed
from amphora.fixed import Combo, EnzymeRule
from amphora.functions.cleavage import nonempty_fragments, resolve_enzyme, sequential_fragments
from amphora.functions.residues import length_between


def _rules(enzymes: Iterable[EnzymeRule | str] | None) -> list[EnzymeRule]:
    if enzymes is None:
        return list(fixed.ENZYMES)
    return [resolve_enzyme(e) if isinstance(e, str) else e for e in enzymes]


def resolve_combos(combos: Iterable[Combo | Sequence[str]] | None) -> list[Combo]:
    if combos is None:
        return list(fixed.COMBOS)
    out = []
    for i, c in enumerate(combos):
        if isinstance(c, Combo):
            out.append(c)
        else:
            names = tuple(resolve_enzyme(n).name for n in c)
            out.append(Combo(i, names, " → ".join(names)))
    return out


def _keep(df: DataFrame, seq_col: str, keep: Sequence[str] | None) -> list[str]:
    return [c for c in df.columns if c != seq_col] if keep is None else list(keep)


def explode_peptides(
    df: DataFrame,
    frags_col: str,
    keep: Sequence[str],
    min_length: int,
    max_length: int,
) -> DataFrame:
    """G4 + P7: one row per fragment with its 0-based position among the
    non-empty fragments, length filtered. Positions order peptides as in the
    sequence (ties in rankings go to the lowest position)."""
    if min_length < 1:
        raise ValueError("min_length must be >= 1")
    return df.select(*keep, F.posexplode(frags_col).alias("pos", "peptide")).where(
        length_between("peptide", min_length, max_length)
    )


def peptide_bounds(
    df: DataFrame,
    seq_col: str = "sequence",
    enzymes: Iterable[EnzymeRule | str] | None = None,
    min_length: int = fixed.DEFAULT_MIN_LENGTH,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """``(*keys, enzyme, n)``: no more than ``n`` peptides come from the key's
    sequences. Peptides do not overlap, so their lengths tell, and nothing is
    cut; ``running`` finds hot keys by it without a second digest."""
    keys = _keep(df, seq_col, keys)
    most = df.groupBy(*keys).agg(F.sum(F.floor(F.length(seq_col) / min_length)).alias("n"))
    return most.select(*keys, F.explode(F.array(*[F.lit(r.name) for r in _rules(enzymes)])).alias("enzyme"), "n")


def digest(
    df: DataFrame,
    seq_col: str = "sequence",
    enzymes: Iterable[EnzymeRule | str] | None = None,
    min_length: int = fixed.DEFAULT_MIN_LENGTH,
    max_length: int = fixed.DEFAULT_MAX_LENGTH,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Every row x every enzyme -> rows ``(*keep, enzyme, pos, peptide)``.

    The sequence is upper-cased (P1) before cutting. Pairs that yield no
    peptide in range produce no row (inner semantics)."""
    keep = _keep(df, seq_col, keep)
    seq = F.upper(F.col(seq_col))
    per_enzyme = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("enzyme"),
                nonempty_fragments(seq, r).alias("frags"),
            )
            for r in _rules(enzymes)
        ]
    )
    pairs = df.select(*keep, F.inline(per_enzyme))
    return explode_peptides(pairs, "frags", [*keep, "enzyme"], min_length, max_length)


def digest_sequential(
    df: DataFrame,
    seq_col: str = "sequence",
    combos: Iterable[Combo | Sequence[str]] | None = None,
    min_length: int = fixed.DEFAULT_MIN_LENGTH,
    max_length: int = fixed.DEFAULT_MAX_LENGTH,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """G3 (+J3): every row x every combination -> rows
    ``(*keep, action_id, label, pos, peptide)``. Enzymes of a combination are
    applied in order, each to every fragment of the previous one; the length
    filter applies only after the last enzyme."""
    keep = _keep(df, seq_col, keep)
    seq = F.upper(F.col(seq_col))
    per_combo = F.array(
        *[
            F.struct(
                F.lit(c.action_id).alias("action_id"),
                F.lit(c.label).alias("label"),
                sequential_fragments(seq, [resolve_enzyme(e) for e in c.enzymes]).alias(
                    "frags"
                ),
            )
            for c in resolve_combos(combos)
        ]
    )
    pairs = df.select(*keep, F.inline(per_combo))
    return explode_peptides(
        pairs, "frags", [*keep, "action_id", "label"], min_length, max_length
    )


def peptide_array(seq: Column, enzyme: EnzymeRule | str) -> Column:
    """Digest as an ARRAY<STRING> column of non-empty fragments (no explode)."""
    rule = resolve_enzyme(enzyme) if isinstance(enzyme, str) else enzyme
    return nonempty_fragments(F.upper(seq), rule)
