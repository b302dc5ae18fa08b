"""Column -> Column functions over amino-acid strings.

All are built from JVM string expressions (``translate``, ``replace``,
``length``, ``rlike``) so they stay inside whole-stage codegen, but for the
counts of residue classes: those are taken from the bytes of a whole Arrow
batch at once, which costs a fraction of a ``translate`` per peptide.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from amphora import fixed

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_sequence(c: ColumnOrName) -> Column:
    """Upper-case."""
    return F.upper(_c(c))


def count_residues(c: ColumnOrName, letters: str) -> Column:
    """Number of characters of ``c`` that are in ``letters``."""
    c = _c(c)
    return F.length(c) - F.length(F.translate(c, letters, ""))


def _members(classes: list[str]):
    """For each class, which of the 256 byte values are letters of it."""
    import numpy as np

    member = np.zeros((len(classes), 256), dtype=np.int32)
    for i, letters in enumerate(classes):
        member[i, [ord(a) for a in letters]] = 1
    return member


def _count_members(strings, member):
    """Array (strings, classes): how many of a string's characters each class
    has, from one pass over the bytes of all strings and a class."""
    import numpy as np
    import pyarrow as pa

    wide = pa.types.is_large_string(strings.type)
    ends = np.frombuffer(strings.buffers()[1], dtype=np.int64 if wide else np.int32)[strings.offset:strings.offset + len(strings) + 1]
    held = strings.buffers()[2]
    # Letters are ASCII, so no byte of a longer character is taken for one.
    raw = (np.frombuffer(held, dtype=np.uint8) if held else np.zeros(0, dtype=np.uint8))[ends[0]:ends[-1]]
    ends = ends - ends[0]
    out = np.empty((len(strings), len(member)), dtype=np.int32)
    for i, of_class in enumerate(member):
        so_far = np.zeros(len(raw) + 1, dtype=np.int32)
        np.cumsum(of_class[raw], out=so_far[1:])
        out[:, i] = np.diff(so_far[ends])
    return out


def _count_classes(classes: list[str]):
    """Arrow function: per string, how many of its characters each class has
    (null for null)."""
    import numpy as np
    import pyarrow as pa

    from amphora.operators.classifier import _ship_package_code

    _ship_package_code()
    member, width = _members(classes), len(classes)

    def counts(strings):
        out = _count_members(strings, member)
        starts = pa.array(np.arange(0, (len(strings) + 1) * width, width, dtype=np.int32))
        return pa.ListArray.from_arrays(starts, pa.array(out.ravel()), mask=strings.is_null() if strings.null_count else None)

    # Real (not postponed) annotations: arrow_udf reads them to pick the kind.
    counts.__annotations__ = {"strings": pa.Array, "return": pa.Array}
    return F.arrow_udf(counts, "array<int>")


def class_counts(c: ColumnOrName, classes: list[str]) -> list[Column]:
    """Counts of disjoint residue classes, letters of ASCII, in one pass over
    the strings of an Arrow batch, instead of one ``translate`` per class."""
    c = _c(c)
    src = "".join(classes)
    if len(set(src)) != len(src):
        raise ValueError("residue classes must be disjoint")
    if not src.isascii():
        return [count_residues(c, letters) for letters in classes]
    if not classes:
        return []
    found = _count_classes(classes)(c)
    return [found[i] for i in range(len(classes))]


# Disjoint atoms of the score's residue classes: positive, negative,
# hydrophobic-but-not-aromatic, aromatic (hydrophobic = the last two).
_ATOMS = [
    fixed.POSITIVE_RESIDUES,
    fixed.NEGATIVE_RESIDUES,
    "".join(a for a in fixed.HYDROPHOBIC_RESIDUES if a not in fixed.AROMATIC_RESIDUES),
    fixed.AROMATIC_RESIDUES,
]
assert set(fixed.AROMATIC_RESIDUES) <= set(fixed.HYDROPHOBIC_RESIDUES)


def _atom_counts(c: Column) -> dict[str, Column]:
    krh, de, avilm, fwy = class_counts(c, _ATOMS)
    return {"pos": krh, "neg": de, "hyd": avilm + fwy, "aro": fwy}


def net_charge(c: ColumnOrName) -> Column:
    """#{K,R,H} - #{D,E} in either case; 0 for the empty string."""
    c = F.upper(_c(c))
    return count_residues(c, fixed.POSITIVE_RESIDUES) - count_residues(
        c, fixed.NEGATIVE_RESIDUES
    )


def _fraction(c: Column, letters: str) -> Column:
    # try_divide: ANSI mode raises on x/0; the empty peptide has fraction 0.
    return F.coalesce(
        F.try_divide(count_residues(c, letters).cast("double"), F.length(c)),
        F.lit(0.0),
    )


def hydrophobic_fraction(c: ColumnOrName) -> Column:
    """Share of AVILMFWY in either case; 0 for the empty string."""
    return _fraction(F.upper(_c(c)), fixed.HYDROPHOBIC_RESIDUES)


def aromatic_fraction(c: ColumnOrName) -> Column:
    """Share of FWY in either case; 0 for the empty string."""
    return _fraction(F.upper(_c(c)), fixed.AROMATIC_RESIDUES)


def _score_from(n: Column, counts: dict[str, Column]) -> tuple[Column, ...]:
    lo, hi = fixed.SCORE_LENGTH_RANGE
    c1, c2 = fixed.SCORE_CHARGE_STEPS
    h_lo, h_hi = fixed.SCORE_HYDROPHOBIC_RANGE
    charge = counts["pos"] - counts["neg"]
    hyd = F.coalesce(F.try_divide(counts["hyd"].cast("double"), n), F.lit(0.0))
    aro = F.coalesce(F.try_divide(counts["aro"].cast("double"), n), F.lit(0.0))
    parts = [n.between(lo, hi), charge >= c1, charge >= c2, hyd.between(h_lo, h_hi), aro > 0]
    total = parts[0].cast("int")
    for p in parts[1:]:
        total = total + p.cast("int")
    return charge, hyd, aro, total


def simple_amp_score(c: ColumnOrName) -> Column:
    """P5: rule score 0-5 (length, charge twice, hydrophobicity, aromatic),
    residues in either case."""
    return upper_amp_score(F.upper(_c(c)))


def upper_amp_score(c: ColumnOrName) -> Column:
    """P5 of a string known to be upper-case (digest output)."""
    c = _c(c)
    return _score_from(F.length(c), _atom_counts(c))[3]


def amp_scores(strings, lengths):
    """``upper_amp_score`` of the strings of an Arrow array, whose lengths are
    at least 1, as a NumPy array."""
    import numpy as np

    pos, neg, other, aromatic = _count_members(strings, _members(_ATOMS)).T
    (lo, hi), (c1, c2), (h_lo, h_hi) = fixed.SCORE_LENGTH_RANGE, fixed.SCORE_CHARGE_STEPS, fixed.SCORE_HYDROPHOBIC_RANGE
    charge, hyd = pos - neg, (other + aromatic) / lengths
    parts = [(lengths >= lo) & (lengths <= hi), charge >= c1, charge >= c2, (hyd >= h_lo) & (hyd <= h_hi), aromatic > 0]
    return np.sum(parts, axis=0, dtype=np.int32)


def peptide_features(c: ColumnOrName) -> list[Column]:
    """Upper-cased sequence plus the five features, as named columns
    (all from one class-count pass)."""
    seq = normalise_sequence(c)
    n = F.length(seq)
    charge, hyd, aro, score = _score_from(n, _atom_counts(seq))
    return [
        seq.alias("sequence"),
        n.alias("length"),
        charge.alias("net_charge"),
        hyd.alias("hydrophobic_fraction"),
        aro.alias("aromatic_fraction"),
        score.alias("simple_amp_score"),
    ]


def peptide_features_struct(c: ColumnOrName) -> Column:
    """P6 as one STRUCT column."""
    return F.struct(*peptide_features(c))


def length_between(c: ColumnOrName, lo: int, hi: int) -> Column:
    """Inclusive length filter."""
    return F.length(_c(c)).between(lo, hi)


def valid_alphabet(c: ColumnOrName) -> Column:
    """Whole string in the 20 standard residues (non-empty)."""
    return _c(c).rlike(f"^[{fixed.STANDARD_RESIDUES}]+\\z")


def min_length(c: ColumnOrName, n: int = fixed.CORPUS_MIN_LENGTH) -> Column:
    """Corpus length floor."""
    return F.length(_c(c)) >= n


def drop_missing(c: ColumnOrName) -> Column:
    """P10: predicate keeping non-null, non-empty strings."""
    c = _c(c)
    return c.isNotNull() & (c != "")


def reward(avg_p: ColumnOrName, max_p: ColumnOrName) -> Column:
    """0.4 avg + 0.6 max; 0.0 when there was no peptide (nulls)."""
    return F.coalesce(
        F.lit(fixed.REWARD_AVG_WEIGHT) * _c(avg_p)
        + F.lit(fixed.REWARD_MAX_WEIGHT) * _c(max_p),
        F.lit(0.0),
    )


def predict_label(prob: ColumnOrName, threshold: float = fixed.PREDICT_THRESHOLD) -> Column:
    """1 iff probability > threshold."""
    return (_c(prob) > F.lit(threshold)).cast("int")


def relabel(c: ColumnOrName, mapping: dict[str, str]) -> Column:
    """Display-name map; unmapped values become null."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), _c(c))


def capitalise(c: ColumnOrName) -> Column:
    """First character upper, the rest lower ("BSA" -> "Bsa")."""
    c = _c(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def round_for_display(c: ColumnOrName, digits: int) -> Column:
    """HALF_UP rounding for reports (compare unrounded values)."""
    return F.round(_c(c), digits)


def _letters_only():
    """Arrow function: the standard residue letters of each string, upper-cased."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    from amphora.functions.cleavage import slices_of, string_offsets
    from amphora.operators.classifier import _ship_package_code

    _ship_package_code()
    upper = np.zeros(256, dtype=np.uint8)  # 0: no residue letter
    for a in fixed.STANDARD_RESIDUES:
        upper[[ord(a), ord(a.lower())]] = ord(a)

    def letters(strings):
        ends, held = string_offsets(strings), strings.buffers()[2]
        parts = []
        for a, b in slices_of(ends):
            found = upper[np.frombuffer(held, dtype=np.uint8)[ends[a]:ends[b]]] if held else upper[:0]
            kept = found != 0
            offsets = np.append(0, np.cumsum(kept))[ends[a:b + 1] - ends[a]].astype(np.int32)
            parts.append(pa.StringArray.from_buffers(b - a, pa.py_buffer(offsets), pa.py_buffer(found[kept])))
        out = pa.concat_arrays(parts) if parts else pa.array([], pa.string())
        return pc.if_else(strings.is_valid(), out, None) if strings.null_count else out

    letters.__annotations__ = {"strings": pa.Array, "return": pa.Array}
    return F.arrow_udf(letters, "string")


def protein_like(text: ColumnOrName) -> Column:
    """Stand-in sequence from free text: keep the 20 residue letters (either
    case) and upper-case them, on the bytes of an Arrow batch (letters are
    ASCII, so no byte of a longer character is taken for one)."""
    return _letters_only()(_c(text))
