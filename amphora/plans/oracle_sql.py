"""DuckDB SQL twins of the registered queries (correctness oracle).

DuckDB's regex engine has no look-around, so a digest is written with the
marker trick: put a bar at each cut with ``regexp_replace`` and split on it.
An after-rule with a blocking residue removes the bar in front of it; a
before-rule removes the bar in front of the last residue.
"""

from __future__ import annotations

from amphora import fixed
from amphora.fixed import EnzymeRule

RESIDUE_KEEP = f"[^{fixed.STANDARD_RESIDUES}{fixed.STANDARD_RESIDUES.lower()}]"


def _cls(letters: str) -> str:
    return "[" + "".join(sorted(set(letters))) + "]"


def marker_sql(expr: str, rule: EnzymeRule) -> str:
    """SQL expression putting '|' at every cut of ``rule`` in ``expr``.
    Only one-sided rules (all shipped enzymes) are expressed."""
    if rule.cleaves_after and rule.cleaves_before:
        raise NotImplementedError("two-sided rule in oracle")
    if rule.cleaves_after:
        out = f"regexp_replace({expr}, '({_cls(rule.cleaves_after)})', '\\1|', 'g')"
        if rule.not_before:
            out = f"regexp_replace({out}, '\\|({_cls(rule.not_before)})', '\\1', 'g')"
        return out
    if rule.cleaves_before:
        out = f"regexp_replace({expr}, '({_cls(rule.cleaves_before)})', '|\\1', 'g')"
        return f"regexp_replace({out}, '\\|(.)$', '\\1')"
    return expr


def doc_sequences_sql() -> str:
    return f"""
    SELECT 'doc_' || CAST(doc_id AS VARCHAR) AS protein,
           CAST(doc_id AS VARCHAR) AS accession_id,
           upper(regexp_replace(text, '{RESIDUE_KEEP}', '', 'g')) AS sequence
    FROM documents
    WHERE length(regexp_replace(text, '{RESIDUE_KEEP}', '', 'g')) > 0"""


def digest_sql(seq_table: str, keys: str = "protein, accession_id",
               lo: int = fixed.DEFAULT_MIN_LENGTH, hi: int = fixed.DEFAULT_MAX_LENGTH) -> str:
    """(keys, enzyme, pos, peptide) for the six enzymes."""
    parts = []
    for r in fixed.ENZYMES:
        parts.append(
            f"SELECT {keys}, '{r.name}' AS enzyme, "
            f"list_filter(string_split({marker_sql('sequence', r)}, '|'), lambda f: length(f) > 0) "
            f"AS frags FROM {seq_table}"
        )
    union = "\n      UNION ALL ".join(parts)
    return f"""
    SELECT * FROM (
      SELECT {keys}, enzyme, unnest(frags) AS peptide,
             unnest(range(len(frags)))::INTEGER AS pos
      FROM ({union}) m
    ) x WHERE length(peptide) BETWEEN {lo} AND {hi}"""


def sequential_digest_sql(seq_table: str, keys: str = "protein, accession_id",
                          lo: int = fixed.DEFAULT_MIN_LENGTH,
                          hi: int = fixed.DEFAULT_MAX_LENGTH) -> str:
    """(keys, action_id, label, pos, peptide) for the eight combinations:
    each enzyme marks and splits every fragment of the previous one."""
    parts = []
    for c in fixed.COMBOS:
        rules = [fixed.ENZYME_BY_NAME[e] for e in c.enzymes]
        frags = f"string_split({marker_sql('sequence', rules[0])}, '|')"
        for r in rules[1:]:
            frags = (
                f"flatten(list_transform(list_filter({frags}, lambda f: length(f) > 0), "
                f"lambda f: string_split({marker_sql('f', r)}, '|')))"
            )
        parts.append(
            f"SELECT {keys}, {c.action_id} AS action_id, '{c.label}' AS label, "
            f"list_filter({frags}, lambda f: length(f) > 0) AS frags FROM {seq_table}"
        )
    union = "\n      UNION ALL ".join(parts)
    return f"""
    SELECT * FROM (
      SELECT {keys}, action_id, label, unnest(frags) AS peptide,
             unnest(range(len(frags)))::INTEGER AS pos
      FROM ({union}) m
    ) x WHERE length(peptide) BETWEEN {lo} AND {hi}"""


def count_sql(col: str, letters: str) -> str:
    return f"(length({col}) - length(translate({col}, '{letters}', '')))"


def features_sql(col: str = "peptide") -> dict[str, str]:
    n = f"length({col})"
    charge = f"({count_sql(col, fixed.POSITIVE_RESIDUES)} - {count_sql(col, fixed.NEGATIVE_RESIDUES)})"
    hyd = f"(CASE WHEN {n} = 0 THEN 0.0 ELSE {count_sql(col, fixed.HYDROPHOBIC_RESIDUES)}::DOUBLE / {n} END)"
    aro = f"(CASE WHEN {n} = 0 THEN 0.0 ELSE {count_sql(col, fixed.AROMATIC_RESIDUES)}::DOUBLE / {n} END)"
    score = (
        f"(({n} BETWEEN 8 AND 30)::INTEGER + ({charge} >= 1)::INTEGER + ({charge} >= 2)::INTEGER"
        f" + ({hyd} BETWEEN 0.3 AND 0.7)::INTEGER + ({aro} > 0)::INTEGER)"
    )
    return {"length": f"{n}::INTEGER", "net_charge": f"{charge}::INTEGER",
            "hydrophobic_fraction": hyd, "aromatic_fraction": aro, "score": score}


def fraction_sql(col: str, letters: str) -> str:
    return f"(CASE WHEN length({col}) = 0 THEN 0.0 ELSE {count_sql(col, letters)}::DOUBLE / length({col}) END)"


def linear_logit_sql(col: str, weights, bias: float) -> str:
    """bias + (sum over weight classes of w * count) / length, classes in
    order of first appearance in the alphabet (the scorer's arithmetic)."""
    classes: dict[float, str] = {}
    for a, w in zip(fixed.STANDARD_RESIDUES, weights):
        if w != 0.0:
            classes[float(w)] = classes.get(float(w), "") + a
    num = "0.0"
    for w, letters in classes.items():
        num = f"({num} + {w!r} * {count_sql(col, letters)}::DOUBLE)"
    return f"({float(bias)!r} + (CASE WHEN length({col}) = 0 THEN 0.0 ELSE {num} / length({col}) END))"


def linear_prob_sql(col: str, weights, bias: float) -> str:
    """sigmoid of ``linear_logit_sql``."""
    return f"(1.0 / (1.0 + exp(-{linear_logit_sql(col, weights, bias)})))"


def dot_sql(vec: str, weights, bias: float) -> str:
    z = f"{float(bias)!r}::DOUBLE"
    for i, w in enumerate(weights):
        z = f"({z} + {vec}[{i + 1}]::DOUBLE * {float(w)!r}::DOUBLE)"
    return z


def dot_prob_sql(vec: str, weights, bias: float) -> str:
    return f"(1.0 / (1.0 + exp(-{dot_sql(vec, weights, bias)})))"
