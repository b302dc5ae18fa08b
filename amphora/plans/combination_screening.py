"""Q2/Q3: classifier screening of single enzymes and reward of every enzyme
combination for every protein, candidates of the best combination and the
discovery report - the answer the bandit loop converges to, computed for
all proteins in one job instead of 2 400 sequential steps per protein."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amphora import fixed
from amphora.fixed import Combo
from amphora.functions.residues import reward
from amphora.operators.classifier import LinearScorer, Scorer, best_fragments, fragment_summaries, prior_scorer, score_peptides
from amphora.functions.cleavage import resolve_enzyme, sequential_fragments
from amphora.operators.bandit import discovery_report
from amphora.operators.digest import resolve_combos, digest, explode_peptides
from amphora.operators.ranking import rank_screening_ml, rank_within
from amphora.operators.screening import screen_ml
from amphora.session import pin_table

KEYS = ("protein", "accession_id")


def screen_combinations_ml(sequences: DataFrame, scorer: Scorer | None = None,
                           enzymes=None, keys: Sequence[str] = KEYS,
                           min_length: int = fixed.DEFAULT_MIN_LENGTH,
                           max_length: int = fixed.DEFAULT_MAX_LENGTH,
                           ranked: bool = True) -> DataFrame:
    """A2 (+C4, T2): classifier summary per (protein, enzyme)."""
    scorer = scorer or prior_scorer()
    seqs = sequences.select(*keys, "sequence")
    peps = digest(seqs, "sequence", enzymes, min_length, max_length, keep=list(keys))
    scored = score_peptides(peps, scorer, keep_logit=True, upper=True)
    out = screen_ml(scored, keys, "enzyme", "amp_probability", min_length, max_length,
                    order_col="_z")
    return rank_screening_ml(out) if ranked else out


def _in_arrays(scorer: Scorer) -> bool:
    """Whether the scorer can score the fragments of an array where it is."""
    return isinstance(scorer, LinearScorer) and all(letters.isascii() for _, letters in scorer.weight_classes())


def combo_rewards(sequences: DataFrame, scorer: Scorer | None = None,
                  combos: Sequence[Combo] | None = None, keys: Sequence[str] = KEYS,
                  min_length: int = fixed.DEFAULT_MIN_LENGTH,
                  max_length: int = fixed.DEFAULT_MAX_LENGTH) -> DataFrame:
    """A6 (+J3, G3, P13): per (protein, combination) the number of peptides,
    mean and max probability and the reward 0.4 avg + 0.6 max. A
    combination without peptides is kept with reward 0.0.

    One pass, one shuffle, no second scan of the sequences and no join to a
    protein x combination grid. For a linear scorer the sequences are cut
    and summed up where they are (``fragment_summaries``), so what is grouped
    is a row per sequence and combination. For any other scorer the fragments are exploded
    behind a null placeholder, so each (protein, combination) group exists
    even when no peptide survives the length filter; ``count(peptide)``
    ignores it.
    """
    scorer = scorer or prior_scorer()
    combos = resolve_combos(combos)
    seq, rules = F.upper(F.col("sequence")), [[resolve_enzyme(e) for e in c.enzymes] for c in combos]
    if _in_arrays(scorer):
        found = sequences.where(F.col("sequence").isNotNull()).select(*keys, fragment_summaries(seq, rules, scorer, min_length, max_length).alias("_s"))
        each = F.array(*[F.struct(F.lit(c.action_id).alias("action_id"), F.get("_s", F.lit(i)).alias("_s")) for i, c in enumerate(combos)])
        sums = found.select(*keys, F.inline(each))
        n, total = F.sum("_s.n"), F.sum("_s.total")
        agg = sums.groupBy(*keys, "action_id").agg(
            F.coalesce(n, F.lit(0)).alias("num_peptides"), F.try_divide(total, n).alias("avg_probability"),
            F.max("_s.most").alias("max_probability"))
    else:
        per_combo = F.array(*[
            F.struct(F.lit(c.action_id).alias("action_id"), sequential_fragments(seq, r).alias("frags"))
            for c, r in zip(combos, rules)])
        rows = sequences.select(*keys, F.inline(per_combo))
        peps = rows.select(*keys, "action_id", F.explode(
            F.concat(F.array(F.lit(None).cast("string")), F.col("frags"))).alias("peptide"))
        peps = peps.where(F.col("peptide").isNull()
                          | F.length("peptide").between(min_length, max_length))
        p = F.col("amp_probability")
        agg = score_peptides(peps, scorer, upper=True).groupBy(*keys, "action_id").agg(
            F.count("peptide").alias("num_peptides"), F.avg(p).alias("avg_probability"),
            F.max(p).alias("max_probability"))
    labels = F.create_map(*[x for c in combos for x in (F.lit(c.action_id), F.lit(c.label))])
    return agg.select(
        *keys, "action_id", labels[F.col("action_id")].alias("label"), "num_peptides",
        "avg_probability", "max_probability",
        reward("avg_probability", "max_probability").alias("reward"))


def best_combination(rewards: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """A12 on the reward table: highest reward, lowest action id on ties."""
    return rewards.groupBy(*keys).agg(
        F.max_by("action_id", F.struct(F.col("reward"), -F.col("action_id"))).alias("best_action"),
        F.max("reward").alias("best_reward"))


def candidate_order() -> list[Column]:
    """T4's order: the logit orders as the probability does, but is free of
    the last-bit differences of exp() between math libraries."""
    return [F.col("_z").desc(), F.col("pos").asc(), F.col("sequence").asc()]


def candidates(sequences: DataFrame, rewards: DataFrame, scorer: Scorer | None = None,
               combos: Sequence[Combo] | None = None, keys: Sequence[str] = KEYS,
               min_length: int = fixed.DEFAULT_MIN_LENGTH,
               max_length: int = fixed.DEFAULT_MAX_LENGTH, k: int | None = None) -> DataFrame:
    """The peptides of each protein's best combination with their probability
    and logit ``_z``, in no order. Who wants a protein's ``k`` best only (by
    ``candidate_order``) says so: a linear scorer then makes rows of the
    ``k`` best of each sequence.

    Only the best combination is digested again: the sequence row is joined
    to its best action (one row per protein) and a lazy ``CASE`` evaluates
    just that combination's cut expression. Pin ``rewards`` where it is used
    more than once."""
    scorer = scorer or prior_scorer()
    combos = resolve_combos(combos)
    seqs = sequences.select(*keys, "sequence")
    best = best_combination(rewards, keys).select(*keys, F.col("best_action").alias("action_id"))
    seq = F.upper(F.col("sequence"))
    frags = F.lit(None).cast("array<string>")
    for c in combos:
        frags = F.when(F.col("action_id") == c.action_id,
                       sequential_fragments(seq, [resolve_enzyme(e) for e in c.enzymes])
                       ).otherwise(frags)
    # A one-row ``inline`` keeps the cut expression in one place: Spark would
    # otherwise also put it into a filter (no empty arrays) below the explode.
    picked = seqs.join(best, list(keys), "inner").select(
        *keys, "action_id", F.inline(F.array(F.struct(frags.alias("frags")))))
    if k is not None and _in_arrays(scorer):
        best_of = best_fragments("frags", scorer, k, min_length, max_length)
        scored = picked.select(*keys, "action_id", best_of.alias("_best")).select(*keys, "action_id", F.inline("_best"))
    else:
        peps = explode_peptides(picked, "frags", [*keys, "action_id"], min_length, max_length)
        scored = score_peptides(peps, scorer, keep_logit=True, upper=True)
    return scored.select(
        *keys, "action_id", "pos", F.col("peptide").alias("sequence"), "_z",
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_z")))).alias("probability"))


def rank_candidates(sequences: DataFrame, rewards: DataFrame, scorer: Scorer | None = None,
                    combos: Sequence[Combo] | None = None, keys: Sequence[str] = KEYS,
                    min_length: int = fixed.DEFAULT_MIN_LENGTH,
                    max_length: int = fixed.DEFAULT_MAX_LENGTH) -> DataFrame:
    """T4: ``candidates`` ranked by probability (ties: position). The rank is
    a running count, so a hot protein is never one task's; how many peptides
    a protein can have at most, the rewards tell."""
    rewards = pin_table(rewards, "rewards")
    found = candidates(sequences, rewards, scorer, combos, keys, min_length, max_length)
    key_rows = rewards.groupBy(*keys).agg(F.max("num_peptides").alias("n"))
    return rank_within(found.drop("probability"), list(keys), candidate_order(), key_rows=key_rows).select(
        *keys, "action_id", "pos", "sequence",
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_z")))).alias("probability"), "rank")


def discover(sequences: DataFrame, actions: DataFrame, scorer: Scorer | None = None,
             combos: Sequence[Combo] | None = None, k: int = 5, keys: Sequence[str] = KEYS) -> DataFrame:
    """A6, T4 and B3 in one: the rewards of every combination are computed
    once and pinned (a row per protein and combination), and the report and
    the candidates read that table. Of the candidates only the ``k`` best of
    a protein are wanted, so ``k`` of a sequence become rows, each task keeps
    ``k`` of a protein before the shuffle and nothing is ranked in full. ``actions``: action_id, label, ph,
    temp."""
    rewards = pin_table(combo_rewards(sequences, scorer, combos, keys), "rewards")
    values = rewards.select(*keys, "action_id", F.col("reward").alias("value"))
    found = candidates(sequences, rewards, scorer, combos, keys, k=k)
    return discovery_report(values, actions, found, k, keys=keys, order=candidate_order())
