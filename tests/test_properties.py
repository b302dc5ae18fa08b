"""Hypothesis: the regex digest equals the per-character definition for any
rule (one- or two-sided) and any sequence, single and sequential."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from amphora.fixed import EnzymeRule
from amphora.functions.cleavage import nonempty_fragments, sequential_fragments
from test_digest import naive_digest, naive_sequential

LETTERS = "ACDEFGHIKLMNPQRSTVWY"
residues = st.text(alphabet="AFKLPRWYDE", min_size=0, max_size=30)
letter_sets = st.sets(st.sampled_from("AFKLPRWYDE"), max_size=4).map(lambda s: "".join(sorted(s)))
rules = st.builds(lambda a, n, b: EnzymeRule("r", a, n, b), letter_sets, letter_sets, letter_sets)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rule=rules, seqs=st.lists(residues, min_size=1, max_size=20))
def test_digest_property(spark, rule, seqs):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "i int, s string")
    got = {r.i: r.f for r in df.select("i", nonempty_fragments(F.col("s"), rule).alias("f")).collect()}
    for i, s in enumerate(seqs):
        assert got[i] == naive_digest(s, rule, 1, 10**6)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rs=st.lists(rules, min_size=1, max_size=3), seqs=st.lists(residues, min_size=1, max_size=20))
def test_sequential_property(spark, rs, seqs):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "i int, s string")
    got = {r.i: r.f for r in df.select("i", sequential_fragments(F.col("s"), rs).alias("f")).collect()}
    for i, s in enumerate(seqs):
        assert got[i] == naive_sequential(s, rs, 1, 10**6)
    assert LETTERS
