"""Enzyme cleavage rules as zero-width Java regular expressions.

A rule cuts a sequence at position p (between residues p-1 and p, 0-based)

* after a residue of ``cleaves_after`` unless the next residue is in
  ``not_before``;
* otherwise before a residue of ``cleaves_before``, but never in front of the
  last residue.

Both conditions only look at two neighbouring residues, so the whole rule is a
single zero-width pattern and ``split`` yields the fragments in order. The
last residue never starts a before-cut, which is what the "any residue but
the marker" class after the before-class encodes. A residue listed in both
lists is cut before only when its after-cut was blocked.

Sequential digestion marks the cuts of every earlier enzyme with a control
character (``regexp_replace`` with a literal, cached pattern) and splits once
on "marker or last rule". Because the marker is not a residue, each rule sees
fragment ends exactly as if it ran on every fragment separately. All of it is
built-in, code-generated expressions; no higher-order function per fragment.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from amphora.fixed import ENZYME_BY_NAME, EnzymeRule

_LETTERS = re.compile(r"^[A-Z]*$")
MARK = "\x01"  # cut marker: never a residue
_ANY = f"[^{MARK}]"


def _cls(letters) -> str:
    return "[" + "".join(sorted(set(letters))) + "]"


def cleavage_regex(rule: EnzymeRule) -> str | None:
    """Zero-width pattern for ``rule``; ``None`` when the rule never cuts."""
    after, block, before = (
        set(rule.cleaves_after.upper()),
        set(rule.not_before.upper()),
        set(rule.cleaves_before.upper()),
    )
    for part in (rule.cleaves_after, rule.not_before, rule.cleaves_before):
        if not _LETTERS.match(part.upper()):
            raise ValueError(f"rule {rule.name!r}: residues must be letters, got {part!r}")
    alternatives = []
    if after:
        alternatives.append(f"(?<={_cls(after)})" + (f"(?!{_cls(block)})" if block else ""))
    if before - after:
        alternatives.append(f"(?={_cls(before - after)}{_ANY})")
    if (before & after) and block:
        alternatives.append(f"(?={_cls(before & after)}{_cls(block)})")
    return "|".join(alternatives) or None


def resolve_enzyme(name: str) -> EnzymeRule:
    """P11 (plan-time form): case-insensitive lookup, unknown name -> error."""
    rule = ENZYME_BY_NAME.get(name.lower())
    if rule is None:
        raise ValueError(f"Unknown enzyme: {name}")
    return rule


def fragments(seq: Column, rule: EnzymeRule) -> Column:
    """All pieces between consecutive cut sites, in order, ARRAY<STRING>.

    Empty pieces appear where two cuts coincide or at a terminal cut; callers
    drop them with the length filter (minimum length >= 1)."""
    rx = cleavage_regex(rule)
    return F.split(seq, rx) if rx else F.array(seq)


def nonempty_fragments(seq: Column, rule: EnzymeRule) -> Column:
    """``fragments`` without empty pieces (``array_remove``, code-generated)."""
    return F.array_remove(fragments(seq, rule), F.lit(""))


def sequential_fragments(seq: Column, rules: list[EnzymeRule]) -> Column:
    """G3 as one expression: every rule is applied to every non-empty
    fragment of the previous one; order of fragments is kept. The terminal
    rule of each rule therefore applies per fragment, as in a real sequential
    hydrolysis."""
    patterns = [rx for rx in (cleavage_regex(r) for r in rules) if rx]
    if not patterns:
        return F.array_remove(F.array(seq), F.lit(""))
    marked = seq
    for rx in patterns[:-1]:
        marked = F.regexp_replace(marked, rx, MARK)
    last = patterns[-1] if len(patterns) == 1 else f"{MARK}|{patterns[-1]}"
    return F.array_remove(F.split(marked, last), F.lit(""))


def cutter(rules: list[EnzymeRule]):
    """``sequential_fragments`` on the bytes of many sequences at once: a
    function of the bytes (``raw``) and the sequences' offsets (``rows``) to
    the starts and ends of all non-empty fragments, in order. What a rule
    cuts at is looked up per byte; a fragment end of an earlier rule is a cut,
    so the next rule sees it as the end of a sequence."""
    import numpy as np

    def letters(chosen):
        table = np.zeros(256, dtype=bool)
        table[[ord(a) for a in chosen]] = True
        return table

    tables, marked = [], sum(cleavage_regex(r) is not None for r in rules) > 1
    for r in rules:
        after, block, before = set(r.cleaves_after.upper()), set(r.not_before.upper()), set(r.cleaves_before.upper())
        tables.append([letters(x) if x else None for x in (after, block, before - after, (before & after) if block else set())])

    def cut(raw, rows):
        n = len(raw)
        ends = np.zeros(n + 1, dtype=bool)
        ends[rows] = ends[n] = True
        mark = raw == ord(MARK)
        if marked:  # a marker in the sequence itself is a cut and no residue
            ends[:-1] |= mark
            ends[1:] |= mark
        for after, block, before, blocked in tables:
            now = ends.copy()
            if after is not None:
                now[1:-1] |= after[raw[:-1]] & ~block[raw[1:]] if block is not None else after[raw[:-1]]
            inside = ~ends[1:-1]  # the next residue is of the same fragment
            if before is not None:
                now[:-2] |= before[raw[:-1]] & inside & ~mark[1:]
            if blocked is not None:
                now[:-2] |= blocked[raw[:-1]] & inside & block[raw[1:]]
            ends = now
        places = np.flatnonzero(ends)
        starts, stops = places[:-1], places[1:]
        if marked and mark.any():
            residues = ~mark[starts]
            starts, stops = starts[residues], stops[residues]
        return starts, stops

    return cut


#: Residues cut at once, so that what is made of them stays small.
CUT_CHARS = 1 << 18


def slices_of(ends):
    """Starts and stops of slices of rows of about ``CUT_CHARS`` bytes each,
    one row at least, by the rows' offsets."""
    import numpy as np

    start = 0
    while start < len(ends) - 1:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + CUT_CHARS, side="right")) - 1)
        yield start, stop
        start = stop


def string_offsets(strings):
    """Offsets of an Arrow string array's values in its buffer."""
    import numpy as np
    import pyarrow as pa

    wide = pa.types.is_large_string(strings.type)
    return np.frombuffer(strings.buffers()[1], dtype=np.int64 if wide else np.int32)[strings.offset:strings.offset + len(strings) + 1].astype(np.int64)


def peptide_cutter(rules: list[EnzymeRule], min_length: int, max_length: int):
    """G2 and G4 of an Arrow array of upper-case sequences without nulls, cut
    on its bytes: a function to, for each rule in turn, the row, the position
    among the row's non-empty fragments, the length and the string of every
    fragment in the length range."""
    import numpy as np
    import pyarrow as pa

    cutters = [cutter([r]) for r in rules]

    def cut(strings):
        ends, held = string_offsets(strings), strings.buffers()[2]
        raw = (np.frombuffer(held, dtype=np.uint8) if held else np.zeros(0, dtype=np.uint8))[ends[0]:ends[-1]]
        rows = ends - ends[0]
        chars = np.append(0, np.cumsum((raw & 0xC0) != 0x80)) if (raw > 127).any() else None
        for one in cutters:
            starts, stops = one(raw, rows)
            lengths = stops - starts if chars is None else chars[stops] - chars[starts]
            firsts = np.searchsorted(starts, rows)
            row = np.repeat(np.arange(len(strings)), np.diff(firsts))
            kept = np.flatnonzero((lengths >= min_length) & (lengths <= max_length))
            # Fragments of one rule leave nothing out, so their starts are the strings' offsets.
            offsets = np.append(starts, len(raw)).astype(np.int32)
            frags = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw))
            yield row[kept], (kept - firsts[row[kept]]).astype(np.int32), lengths[kept], frags.take(pa.array(kept))

    return cut


def _prefix_sums():
    """Prefix sums of int arrays, the one step Spark's built-ins cannot do in
    linear time: one ``cumsum`` over all values of an Arrow batch, less what
    came before each row."""
    import numpy as np
    import pyarrow as pa

    from amphora.operators.classifier import _ship_package_code

    _ship_package_code()

    def prefix_sums(lengths):
        ends = lengths.offsets.to_numpy().astype(np.int64)
        ends -= ends[0]
        values = lengths.flatten().to_numpy(zero_copy_only=False)
        sums = np.append(0, np.cumsum(values, dtype=np.int64))
        out = sums[1:] - np.repeat(sums[ends[:-1]], np.diff(ends))
        nulls = lengths.is_null() if lengths.null_count else None
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(out.astype(np.int32)), mask=nulls)

    # Real (not postponed) annotations: arrow_udf reads them to pick the kind.
    prefix_sums.__annotations__ = {"lengths": pa.Array, "return": pa.Array}
    return F.arrow_udf(prefix_sums, "array<int>")


def cut_sites(seq: Column, rule: EnzymeRule) -> Column:
    """G1: 0-based cut positions including both ends, sorted and distinct.

    The pieces come from the code-generated ``split`` (empty pieces kept, so
    every cut is a boundary); their lengths' prefix sums are the cut sites,
    the last one being the sequence length."""
    lengths = F.transform(fragments(seq, rule), lambda f: F.length(f))
    return F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0)), _prefix_sums()(lengths))))
