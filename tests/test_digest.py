import random

import pytest
from pyspark.sql import functions as F

from amphora.fixed import ENZYMES, EnzymeRule
from amphora.functions.cleavage import cleavage_regex, cut_sites, fragments, sequential_fragments
from amphora.operators.digest import digest, digest_sequential


def naive_digest(seq, rule, lo, hi):
    """Per-character oracle written from the rule semantics."""
    seq = seq.upper()
    sites = []
    for i in range(len(seq) - 1):
        if seq[i] in rule.cleaves_after and seq[i + 1] not in rule.not_before:
            sites.append(i + 1)
        elif seq[i] in rule.cleaves_before:
            sites.append(i)
    sites = [0] + sites + [len(seq)]
    out = []
    for a, b in zip(sites, sites[1:]):
        p = seq[a:b]
        if lo <= len(p) <= hi:
            out.append(p)
    return out


def naive_sequential(seq, rules, lo, hi):
    frags = [seq.upper()]
    for r in rules:
        nxt = []
        for f in frags:
            nxt.extend(naive_digest(f, r, 1, max(len(seq), 1)))
        frags = nxt
    return [p for p in frags if lo <= len(p) <= hi]


def naive_sites(seq, rule):
    sites = []
    for i in range(len(seq) - 1):
        if seq[i] in rule.cleaves_after and seq[i + 1] not in rule.not_before:
            sites.append(i + 1)
        elif seq[i] in rule.cleaves_before:
            sites.append(i)
    return sorted(set([0] + sites + [len(seq)]))


def _split_all(spark, seqs, rule):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "id int, s string")
    rows = df.select("id", F.filter(fragments(F.col("s"), rule), lambda x: F.length(x) > 0)
                     .alias("f")).collect()
    return {r.id: r.f for r in rows}


def test_golden_counts(spark, proteins):
    peps = digest(proteins, "sequence", keep=["protein"])
    counts = {(r.protein, r.enzyme): r["count"] for r in peps.groupBy("protein", "enzyme").count().collect()}
    assert counts[("lactoferrin", "trypsin")] == 58
    assert counts[("lactoferrin", "chymotrypsin")] == 67
    assert counts[("lactoferrin", "pepsin")] == 67
    assert counts[("BSA", "trypsin")] == 62


def test_sequential_golden_counts(spark, proteins):
    peps = digest_sequential(proteins, "sequence", keep=["protein"])
    counts = {(r.protein, r.action_id): r["count"]
              for r in peps.groupBy("protein", "action_id").count().collect()}
    assert [counts[(p, 6)] for p in ("beta-lactoglobulin", "alpha-lactalbumin", "lactoferrin", "BSA")] == [19, 14, 68, 69]
    assert [counts[(p, 7)] for p in ("beta-lactoglobulin", "alpha-lactalbumin", "lactoferrin", "BSA")] == [14, 11, 41, 34]


def test_sequential_order_matters(spark, proteins):
    lf = proteins.where("protein = 'lactoferrin'")
    a = digest_sequential(lf, "sequence", [["chymotrypsin", "pepsin"]]).count()
    b = digest_sequential(lf, "sequence", [["pepsin", "chymotrypsin"]]).count()
    assert (a, b) == (68, 57)


def test_edge_cases(spark):
    df = spark.createDataFrame(
        [("LIVTQTMKGLDIQKVAGTWYR",), ("AAAAKAAAAF",), ("FAAAALAAAA",), ("AAAAFRAAAA",), ("aaaak",)], "s string")
    rows = df.select(
        "s",
        sequential_fragments(F.upper("s"), [ENZYMES[0], ENZYMES[1]]).alias("tc"),
        sequential_fragments(F.upper("s"), [ENZYMES[5]]).alias("pep"),
        sequential_fragments(F.upper("s"), [ENZYMES[1], ENZYMES[5]]).alias("cp"),
        sequential_fragments(F.upper("s"), [ENZYMES[5], ENZYMES[1]]).alias("pc"),
    ).collect()
    by = {r.s: r for r in rows}
    tc = [p for p in by["LIVTQTMKGLDIQKVAGTWYR"].tc if 4 <= len(p) <= 50]
    assert tc == ["IVTQTMK", "DIQK", "VAGTW"]
    assert by["AAAAKAAAAF"].pep == ["AAAAKAAAAF"]
    assert by["FAAAALAAAA"].pep == ["FAAAA", "LAAAA"]
    assert by["AAAAFRAAAA"].cp == ["AAAAF", "RAAAA"]
    assert by["AAAAFRAAAA"].pc == ["AAAA", "F", "RAAAA"]
    assert by["aaaak"].pep == ["AAAAK"]


def _random_rule(rng):
    letters = "ACDEFGHIKLMNPQRSTVWY"
    pick = lambda k: "".join(sorted(rng.sample(letters, k)))
    return EnzymeRule("r", pick(rng.randint(0, 4)), pick(rng.randint(0, 2)), pick(rng.randint(0, 3)))


def test_regex_equals_naive_on_random_rules(spark):
    rng = random.Random(7)
    seqs = ["".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(rng.randint(0, 40)))
            for _ in range(200)]
    for _ in range(25):
        rule = _random_rule(rng)
        got = _split_all(spark, seqs, rule)
        for i, s in enumerate(seqs):
            assert got[i] == naive_digest(s, rule, 1, 10**6), (rule, s, cleavage_regex(rule))


def test_sequential_equals_naive(spark):
    rng = random.Random(11)
    seqs = ["".join(rng.choice("AFKLPRWY") for _ in range(rng.randint(1, 30))) for _ in range(100)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "id int, sequence string")
    for _ in range(6):
        rules = [_random_rule(rng) for _ in range(rng.randint(1, 3))]
        got = {r.id: r.f for r in df.select("id", sequential_fragments(F.col("sequence"), rules).alias("f")).collect()}
        for i, s in enumerate(seqs):
            assert [p for p in got[i] if 1 <= len(p)] == naive_sequential(s, rules, 1, 10**6)


def test_cut_sites(spark):
    rng = random.Random(3)
    seqs = ["".join(rng.choice("AFKLPRWY") for _ in range(rng.randint(0, 25))) for _ in range(60)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "id int, s string")
    for rule in ENZYMES:
        got = {r.id: r.c for r in df.select("id", cut_sites(F.col("s"), rule).alias("c")).collect()}
        for i, s in enumerate(seqs):
            assert got[i] == naive_sites(s, rule), (rule.name, s)


def test_min_length_guard(spark, proteins):
    with pytest.raises(ValueError):
        digest(proteins, "sequence", min_length=0)


def test_peptide_bounds(spark, proteins):
    from amphora.operators.digest import digest, peptide_bounds

    seqs = proteins.select("protein", "sequence")
    found = {(r["protein"], r["enzyme"]): r["c"] for r in digest(seqs, min_length=2, max_length=50).groupBy("protein", "enzyme").agg(F.count("*").alias("c")).collect()}
    bounds = {(r["protein"], r["enzyme"]): r["n"] for r in peptide_bounds(seqs, min_length=2).collect()}
    assert len(bounds) == 24 and all(n <= bounds[k] for k, n in found.items())
