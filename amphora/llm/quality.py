"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is a test on a text that rejects it. On a sample of the table each rule
is timed and its share of rejections taken; the rules are then tried in the
order of rejections per cost, and a text that one has rejected is not looked at
by the later ones. The order changes the work and which rule is named first,
never which texts are kept.

Nulls and edges: a null text has no words and is rejected like an empty one;
every row is judged by itself, so repeated rows are kept or rejected together;
columns are kept, but for one named ``rejected_by``, which is replaced; an
empty table gives no rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amphora.session import pin_table

#: Rows of the sample on which rules are timed, at most about this many.
SAMPLE_ROWS = 2000

SPACE, SPACES = r"[\x20\x09-\x0D]", " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"

#: Positions in a text up to 2**POSITION_BITS words share a long with a hash.
POSITION_BITS = 20


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space, in order; none of null."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE + "+"))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def word_chars(text: Column) -> Column:
    """Code points in words."""
    out = F.coalesce(text, F.lit(""))
    for space in SPACES:
        out = F.replace(out, F.lit(space), F.lit(""))
    return F.length(out).cast("long")


def n_symbols(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0)).cast("long")


def n_upper(text: Column) -> Column:
    """Letters A-Z."""
    return F.coalesce(F.regexp_count(text, F.lit("[A-Z]")), F.lit(0)).cast("long")


def n_marks(text: Column) -> Column:
    """Exclamation marks."""
    shown = F.coalesce(text, F.lit(""))
    return (F.length(shown) - F.length(F.replace(shown, F.lit("!"), F.lit("")))).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))


def n_lines(text: Column) -> Column:
    """Lines with a word."""
    return F.size(_lines(text)).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier one."""
    return let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(text: Column, width: int = 3) -> Column:
    """Words in windows of ``width`` words that occur twice or more in the text.

    Windows are hashed to 64 bits, hash and position are sorted as one long (as
    a struct for texts too long for that), equal neighbours tell the repeated
    positions, and the words that these cover are added up from the gaps.
    """
    mask = (1 << POSITION_BITS) - 1

    def covered(places: Column) -> Column:
        gaps = lambda p: F.transform(p, lambda x, i: F.least(F.lit(width).cast("long"), F.coalesce(F.get(p, i + 1) - x, F.lit(width).cast("long"))))
        return let(F.sort_array(places), lambda p: F.aggregate(gaps(p), F.lit(0).cast("long"), lambda total, gap: total + gap))

    def packed(h: Column) -> Column:
        place = lambda x: x.bitwiseAND(F.lit(mask))
        full = lambda x: F.get(h, place(x).cast("int"))
        same = lambda x, y: F.coalesce((F.shiftright(x, POSITION_BITS) == F.shiftright(y, POSITION_BITS)) & (full(x) == full(y)), F.lit(False))
        keyed = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long"))))
        again = lambda s: F.filter(s, lambda x, k: same(x, F.get(s, k + 1)) | same(x, F.get(s, k - 1)))
        return let(keyed, lambda s: covered(F.transform(again(s), place)))

    def paired(h: Column) -> Column:
        same = lambda x, y: F.coalesce(x.getField("h") == y.getField("h"), F.lit(False))
        keyed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.cast("long").alias("i"))))
        again = lambda s: F.filter(s, lambda x, k: same(x, F.get(s, k + 1)) | same(x, F.get(s, k - 1)))
        return let(keyed, lambda s: covered(F.transform(again(s), lambda x: x.getField("i"))))

    def count(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(width))))
        found = let(hashes, lambda h: F.when(F.size(h) <= mask, packed(h)).otherwise(paired(h)))
        return F.when(F.size(w) < width, F.lit(0).cast("long")).otherwise(found)

    return let(words(text), count)


#: Measures of a text by name.
MEASURES: dict[str, Callable[[Column], Column]] = {
    f.__name__: f for f in (n_words, word_chars, n_symbols, n_upper, n_marks, n_lines, n_dup_lines, n_repeat_words)
}


@dataclass(frozen=True)
class Rule:
    """``rejects`` takes a function from a measure's name to its column."""

    name: str
    rejects: Callable[[Callable[[str], Column]], Column]


#: The first two are the base rules; the others are wide enough for prose in any of
#: the corpus's languages. None rejects a text for being long, which says nothing about its quality.
BASE_RULES = (
    Rule("few_words", lambda m: m("n_words") < 50),
    Rule("repeated_words", lambda m: 100 * m("n_repeat_words") > 50 * m("n_words")),
)
RULES = (
    *BASE_RULES,
    Rule("word_length", lambda m: (m("word_chars") < 3 * m("n_words")) | (m("word_chars") > 12 * m("n_words"))),
    Rule("symbols", lambda m: 10 * m("n_symbols") > m("n_words")),
    Rule("capitals", lambda m: 2 * m("n_upper") > m("word_chars")),
    Rule("exclamations", lambda m: 2 * m("n_marks") > m("n_words")),
    Rule("repeated_lines", lambda m: 2 * m("n_dup_lines") > m("n_lines")),
)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    cost: float
    rejected: float


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Seconds and share of rejections of each rule over a sample of about
    ``sample_rows`` rows, drawn by a hash of the text, in the order of
    rejections per second."""
    rows = docs.count()
    every = max(1, rows // sample_rows)
    own = docs.select(F.col(text_col).alias("text"))
    sample = pin_table(own.where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).limit(2 * sample_rows), "rule-sample")
    measured = lambda name: MEASURES[name](F.col("text"))

    def timed(column: Column) -> tuple[float, float]:
        seconds, share = [], 0.0
        for _ in range(2):  # the first run compiles
            began = time.monotonic()
            share = sample.agg(F.avg(column.cast("double"))).first()[0] or 0.0
            seconds.append(time.monotonic() - began)
        return min(seconds), share

    scan, _ = timed(F.col("text").isNull())
    found = [Estimate(rule, max(seconds - scan, 1e-3), share) for rule in rules for seconds, share in [timed(rule.rejects(measured))]]
    return sorted(found, key=lambda e: -e.rejected / e.cost)


def cascade(order: Sequence[Rule], measure: Callable[[str], Column]) -> Column:
    """Name of the first rule of ``order`` that rejects, null if none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(order):
        out = F.when(rule.rejects(measure), F.lit(rule.name)).otherwise(out)
    return out


#: Measures that several rules read: taken once a text, before the cascade.
SHARED = ("n_words", "word_chars")


def screen(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", measured: Sequence[str] = ()) -> DataFrame:
    """``docs`` with ``rejected_by``: the rule that rejects the text, null where
    it is kept. ``measured`` adds these measures as columns and lets the rules
    read them."""
    order = [e.rule for e in estimate(docs, rules, text_col)]
    text = F.col(text_col)
    own = docs.drop("rejected_by", *measured).withColumns({name: MEASURES[name](text) for name in measured})
    shared = [name for name in SHARED if name not in measured]

    def verdict(once: Column | None) -> Column:
        def measure(name: str) -> Column:
            if name in measured:
                return F.col(name)
            return once.getField(name) if name in shared else MEASURES[name](text)

        return cascade(order, measure)

    if not shared:
        return own.withColumn("rejected_by", verdict(None))
    return own.withColumn("rejected_by", let(F.struct(*(MEASURES[name](text).alias(name) for name in shared)), verdict))
