"""Registered queries over the driver tables, each with its DuckDB twin.

Stand-ins (the driver tables hold no proteins): ``documents.text`` reduced
to its residue letters is a pseudo-protein keyed by ``doc_id``. Every query
reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amphora import fixed
from amphora.operators.digest import digest
from amphora.operators.ranking import rank_screening
from amphora.operators.screening import score_peptides, screen
from amphora.plans import oracle_sql as O
from amphora.session import pin_table, scratch_path, spread
from amphora.sources.sequences import document_sequences

KEYS = ["protein", "accession_id"]


@dataclass(frozen=True)
class Registered:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Registered] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = Registered(fn, sql)
        return fn

    return deco


def _doc_seqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_sequences(spark, sf_dir)


def _round_shares(df: DataFrame, cols: list[str]) -> DataFrame:
    """Shares and probabilities (0 to 1) to 9 digits, by arithmetic as the SQL
    does: ``round`` goes through a decimal string for every value."""
    return df.withColumns({c: F.floor(F.col(c) * F.lit(1e9) + F.lit(0.5)) / F.lit(1e9) for c in cols})


def _doc_peptides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(_doc_seqs(spark, sf_dir), "sequence", keep=KEYS)


# ---------------------------------------------------------------- G2 / G4
_DOC = f"(SELECT * FROM ({O.doc_sequences_sql()}))"


@register("digest_peptides", O.digest_sql(_DOC))
def q_digest_peptides(spark, sf_dir):
    return _doc_peptides(spark, sf_dir)


# ---------------------------------------------------------------- P1-P7
_F = O.features_sql("peptide")


@register(
    "peptide_features",
    f"""
    SELECT protein, accession_id, enzyme, pos, peptide,
           {_F['length']} AS length, {_F['net_charge']} AS net_charge,
           round({_F['hydrophobic_fraction']}, 9) AS hydrophobic_fraction,
           round({_F['aromatic_fraction']}, 9) AS aromatic_fraction,
           {_F['score']} AS simple_amp_score
    FROM ({O.digest_sql(_DOC)})""",
)
def q_peptide_features(spark, sf_dir):
    out = score_peptides(_doc_peptides(spark, sf_dir))
    return _round_shares(out, ["hydrophobic_fraction", "aromatic_fraction"])


# ---------------------------------------------------------------- A1 + T1
_SCREEN_SQL = f"""
    SELECT protein, accession_id, enzyme,
           {fixed.DEFAULT_MIN_LENGTH} AS min_length, {fixed.DEFAULT_MAX_LENGTH} AS max_length,
           count(*) AS num_peptides, max(score) AS max_score,
           arg_max(peptide, score::BIGINT * 1000000000 - pos) AS top_peptide,
           count_if(score >= 3)::BIGINT AS num_score_ge_3,
           count_if(score >= 4)::BIGINT AS num_score_ge_4,
           avg(score) AS avg_score
    FROM (SELECT *, {_F['score']} AS score FROM ({O.digest_sql(_DOC)}))
    GROUP BY protein, accession_id, enzyme"""


@register(
    "rule_screening",
    f"""
    SELECT *, row_number() OVER (ORDER BY num_score_ge_4 DESC, num_score_ge_3 DESC,
               max_score DESC, avg_score DESC, protein, enzyme) AS rank
    FROM ({_SCREEN_SQL})""",
)
def q_rule_screening(spark, sf_dir):
    return rank_screening(screen(_doc_peptides(spark, sf_dir), KEYS))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v.run for k, v in REGISTRY.items()}


def oracle() -> dict[str, str]:
    return {k: v.sql for k, v in REGISTRY.items() if v.sql is not None}


# ================================================================ reward logs
from amphora.operators import bandit as B  # noqa: E402
from amphora.sources.reward_log import REWARD_LOG_SQL, reward_log_from_events  # noqa: E402
from amphora.sources.sequences import load_table  # noqa: E402
from amphora.streaming.action_values import stream_action_values  # noqa: E402

_LOG = f"({REWARD_LOG_SQL})"


def _log(spark, sf_dir):
    return reward_log_from_events(load_table(spark, sf_dir, "events"))


_VALUES_SQL = f"""
    SELECT run_id, action_id, count(*) AS n, avg(reward) AS value
    FROM {_LOG} GROUP BY run_id, action_id"""


@register("action_values", f"SELECT run_id, action_id, n, round(value, 9) AS value FROM ({_VALUES_SQL})")
def q_action_values(spark, sf_dir):
    return B.action_values(_log(spark, sf_dir)).withColumn("value", F.round("value", 9))


@register("episode_rewards", f"""
    SELECT run_id, episode, round(sum(reward), 9) AS total_reward, count(*) AS steps
    FROM {_LOG} GROUP BY run_id, episode""")
def q_episode_rewards(spark, sf_dir):
    return B.episode_rewards(_log(spark, sf_dir)).withColumn("total_reward", F.round("total_reward", 9))


_BEST_SQL = f"""
    SELECT v.run_id, m.best_value, min(v.action_id) AS best_action
    FROM ({_VALUES_SQL}) v JOIN (SELECT run_id, max(value) AS best_value FROM ({_VALUES_SQL}) GROUP BY run_id) m
      ON v.run_id = m.run_id AND v.value = m.best_value
    GROUP BY v.run_id, m.best_value"""


@register("best_action", f"SELECT run_id, round(best_value, 9) AS best_value, best_action FROM ({_BEST_SQL})")
def q_best_action(spark, sf_dir):
    out = B.best_action(B.action_values(_log(spark, sf_dir)))
    return out.withColumn("best_value", F.round("best_value", 9))


@register("moving_average", f"""
    SELECT run_id, episode, total_reward, moving_avg FROM (
      SELECT run_id, episode, round(total_reward, 9) AS total_reward,
             round(avg(total_reward) OVER w, 9) AS moving_avg, count(*) OVER w AS n
      FROM (SELECT run_id, episode, sum(reward) AS total_reward FROM {_LOG} GROUP BY run_id, episode)
      WINDOW w AS (PARTITION BY run_id ORDER BY episode ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
    ) WHERE n = 10""")
def q_moving_average(spark, sf_dir):
    out = B.moving_average(B.episode_rewards(_log(spark, sf_dir)), 10)
    return out.withColumns({c: F.round(c, 9) for c in ("total_reward", "moving_avg")})


@register("value_trajectory", f"""
    SELECT run_id, episode, step, action_id, round(reward, 9) AS reward, event_id, count(*) OVER w AS n,
           round(avg(reward) OVER w, 9) AS value
    FROM {_LOG}
    WINDOW w AS (PARTITION BY run_id, action_id ORDER BY episode, step, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_value_trajectory(spark, sf_dir):
    out = B.value_trajectory(_log(spark, sf_dir))
    return out.withColumns({"value": F.round("value", 9), "reward": F.round("reward", 9)})


@register("epsilon_schedule", f"""
    SELECT run_id, episode, step, action_id, reward, event_id, n_updates,
           round(greatest(0.1, 1.0 * pow(0.995, n_updates)), 12) AS epsilon
    FROM (SELECT *, count(*) OVER (PARTITION BY run_id ORDER BY episode, step, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_updates FROM {_LOG})""")
def q_epsilon_schedule(spark, sf_dir):
    return B.epsilon_schedule(_log(spark, sf_dir)).withColumn("epsilon", F.round("epsilon", 12))


@register("best_so_far", f"""
    SELECT *, max(reward) OVER (PARTITION BY run_id, episode ORDER BY step, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_so_far FROM {_LOG}""")
def q_best_so_far(spark, sf_dir):
    return B.best_so_far(_log(spark, sf_dir))


@register("rank_actions", f"""
    SELECT run_id, action_id, n, round(value, 9) AS value,
           row_number() OVER (PARTITION BY run_id ORDER BY value DESC, action_id)::INTEGER AS rank,
           row_number() OVER (PARTITION BY run_id ORDER BY value DESC, action_id) = 1 AS is_best
    FROM ({_VALUES_SQL})""")
def q_rank_actions(spark, sf_dir):
    out = B.rank_actions(B.action_values(_log(spark, sf_dir)))
    return out.withColumn("value", F.round("value", 9))


@register("reward_history", f"""
    SELECT *, count(*) OVER (PARTITION BY run_id, episode ORDER BY step, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS step_index FROM {_LOG}""")
def q_reward_history(spark, sf_dir):
    return B.reward_history(_log(spark, sf_dir))


@register("label_actions", f"""
    SELECT v.run_id, v.action_id, v.n, round(v.value, 9) AS value, a.label
    FROM ({_VALUES_SQL}) v LEFT JOIN (
      SELECT DISTINCT event_type AS action_id,
             upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) AS label FROM events) a
    ON v.action_id = a.action_id""")
def q_label_actions(spark, sf_dir):
    from amphora.functions.residues import capitalise

    actions = load_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("action_id")).distinct().withColumn("label", capitalise("action_id"))
    out = B.label_actions(B.action_values(_log(spark, sf_dir)), actions)
    return out.withColumn("value", F.round("value", 9))


@register("assign_actions", f"""
    WITH v AS ({_VALUES_SQL}),
    best AS ({_BEST_SQL}),
    pool AS (SELECT run_id, list_sort(list(DISTINCT action_id)) AS actions FROM v GROUP BY run_id),
    req AS (SELECT event_id AS request_id, user_id AS run_id FROM events)
    SELECT r.request_id, r.run_id, explore,
           CASE WHEN explore THEN p.actions[
               (('0x' || substr(md5(CAST(r.request_id AS VARCHAR) || '|42|action'), 1, 8))::BIGINT
                % len(p.actions))::INTEGER + 1]
                ELSE b.best_action END AS action_id
    FROM (SELECT r.*, (('0x' || substr(md5(CAST(r.request_id AS VARCHAR) || '|42|explore'), 1, 8))::BIGINT
                       / 4294967296.0) < 0.2 AS explore FROM req r) r
    JOIN best b ON r.run_id = b.run_id JOIN pool p ON r.run_id = p.run_id""")
def q_assign_actions(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events")
    requests = ev.select(F.col("event_id").alias("request_id"), F.col("user_id").alias("run_id"))
    return B.assign_actions(requests, B.action_values(_log(spark, sf_dir)), 0.2, seed=42)


@register("training_summary", f"""
    WITH eps AS (SELECT run_id, episode, sum(reward) AS total_reward, count(*) AS steps
                 FROM {_LOG} GROUP BY run_id, episode),
    agg AS (SELECT run_id, count(*) AS num_episodes, sum(total_reward) AS total_reward,
                   avg(total_reward) AS mean_episode_reward, sum(steps) AS num_updates
            FROM eps GROUP BY run_id),
    known AS (SELECT run_id, list(action_id ORDER BY action_id) AS actions, list(n ORDER BY action_id) AS action_n,
                     list(round(value, 9) ORDER BY action_id) AS action_values FROM ({_VALUES_SQL}) GROUP BY run_id)
    SELECT a.run_id, a.num_episodes, round(a.total_reward, 9) AS total_reward,
           round(a.mean_episode_reward, 9) AS mean_episode_reward, a.num_updates::BIGINT AS num_updates,
           round(b.best_value, 9) AS best_value, b.best_action,
           upper(substr(b.best_action, 1, 1)) || lower(substr(b.best_action, 2)) AS best_label,
           k.actions, k.action_n, k.action_values,
           round(greatest(0.1, pow(0.995, a.num_updates)), 12) AS final_epsilon
    FROM agg a JOIN ({_BEST_SQL}) b ON a.run_id = b.run_id JOIN known k ON a.run_id = k.run_id""")
def q_training_summary(spark, sf_dir):
    from amphora.functions.residues import capitalise

    labels = load_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("action_id")).distinct().withColumn("label", capitalise("action_id"))
    out = B.training_summary(_log(spark, sf_dir), labels)
    return out.withColumns({
        "action_values": F.transform("action_values", lambda x: F.round(x, 9)),
        "total_reward": F.round("total_reward", 9),
        "mean_episode_reward": F.round("mean_episode_reward", 9),
        "best_value": F.round("best_value", 9),
        "final_epsilon": F.round("final_epsilon", 12),
        "num_updates": F.col("num_updates").cast("bigint"),
    })


@register("stream_action_values", f"""
    SELECT action_id, count(*) AS n, round(sum(reward), 9) AS reward_sum, round(avg(reward), 9) AS value
    FROM {_LOG} GROUP BY action_id""")
def q_stream_action_values(spark, sf_dir):
    schema = load_table(spark, sf_dir, "events").schema
    out = stream_action_values(spark, sf_dir, schema, reward_log_from_events, glob="events.parquet")
    return out.withColumns({c: F.round(c, 9) for c in ("reward_sum", "value")})


# ================================================================ combinations
from amphora.functions.cleavage import cut_sites  # noqa: E402
from amphora.operators import classifier as C  # noqa: E402
from amphora.operators import corpus as U  # noqa: E402
from amphora.operators.digest import digest_sequential  # noqa: E402
from amphora.operators.ranking import pivot_matrix, top_k  # noqa: E402
from amphora.operators.screening import peptide_counts, rank_peptides  # noqa: E402
from amphora.plans import combination_screening as Q  # noqa: E402
from amphora.sources.sequences import attach_sequences, missing_sequences  # noqa: E402

PRIOR = C.prior_scorer()
_PRIOR_P = O.linear_prob_sql("peptide", PRIOR.weights, PRIOR.bias)


@register("sequential_digest", O.sequential_digest_sql(_DOC))
def q_sequential_digest(spark, sf_dir):
    return digest_sequential(_doc_seqs(spark, sf_dir), "sequence", keep=KEYS)


_COMBO_LABELS = " ".join(f"WHEN {c.action_id} THEN '{c.label}'" for c in fixed.COMBOS)
_REWARDS_SQL = f"""
    WITH agg AS (
      SELECT protein, accession_id, action_id, count(*) AS num_peptides,
             avg({_PRIOR_P}) AS avg_probability, max({_PRIOR_P}) AS max_probability
      FROM ({O.sequential_digest_sql(_DOC)}) GROUP BY protein, accession_id, action_id),
    grid AS (SELECT protein, accession_id, unnest({[c.action_id for c in fixed.COMBOS]}) AS action_id
             FROM {_DOC})
    SELECT g.protein, g.accession_id, g.action_id,
           CASE g.action_id {_COMBO_LABELS} END AS label,
           coalesce(a.num_peptides, 0) AS num_peptides,
           a.avg_probability, a.max_probability,
           coalesce(0.4 * a.avg_probability + 0.6 * a.max_probability, 0.0) AS reward
    FROM grid g LEFT JOIN agg a
      ON g.protein = a.protein AND g.accession_id = a.accession_id AND g.action_id = a.action_id"""


def _round_cols(df, cols, digits=9):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@register("combo_rewards", f"""
    SELECT protein, accession_id, action_id, label, num_peptides,
           round(avg_probability, 9) AS avg_probability, round(max_probability, 9) AS max_probability,
           round(reward, 9) AS reward FROM ({_REWARDS_SQL})""")
def q_combo_rewards(spark, sf_dir):
    out = Q.combo_rewards(_doc_seqs(spark, sf_dir), PRIOR)
    return _round_cols(out, ["avg_probability", "max_probability", "reward"])


_RL_CAND_SQL = f"""
    WITH r AS ({_REWARDS_SQL}),
    best AS (SELECT protein, accession_id, action_id FROM (
               SELECT protein, accession_id, action_id, row_number() OVER (
                 PARTITION BY protein, accession_id ORDER BY reward DESC, action_id) AS k FROM r)
             WHERE k = 1),
    c AS (SELECT d.protein, d.accession_id, d.action_id, d.pos, d.peptide AS sequence,
                 {_PRIOR_P} AS probability, {O.linear_logit_sql("peptide", PRIOR.weights, PRIOR.bias)} AS z
          FROM ({O.sequential_digest_sql(_DOC)}) d JOIN best b
          ON d.protein = b.protein AND d.accession_id = b.accession_id AND d.action_id = b.action_id)
    SELECT protein, accession_id, action_id, pos, sequence, round(probability, 9) AS probability, rank
    FROM (SELECT *, row_number() OVER (PARTITION BY protein, accession_id
                                       ORDER BY z DESC, pos) AS rank FROM c)"""


@register("rl_candidates", _RL_CAND_SQL)
def q_rl_candidates(spark, sf_dir):
    seqs = _doc_seqs(spark, sf_dir)
    out = Q.rank_candidates(seqs, Q.combo_rewards(seqs, PRIOR), PRIOR)
    return _round_shares(out, ["probability"])


def _combo_values_sql() -> str:
    rows = []
    for c in fixed.COMBOS:
        rules = [fixed.ENZYME_BY_NAME[e] for e in c.enzymes]
        ph = ", ".join(repr(float(r.ph_optimum)) for r in rules)
        temp = ", ".join(str(int(r.temp_optimum_celsius)) for r in rules)
        rows.append(f"({c.action_id}, '{c.label}', [{ph}]::DOUBLE[], [{temp}]::INTEGER[])")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") t(action_id, label, ph, temp)"


@register("discovery_report", f"""
    WITH r AS ({_REWARDS_SQL}),
    c AS ({_combo_values_sql()}),
    ranked AS (SELECT protein, accession_id, action_id, reward AS value,
                      row_number() OVER (PARTITION BY protein, accession_id
                                         ORDER BY reward DESC, action_id) AS rank FROM r),
    rc AS (SELECT ranked.protein, ranked.accession_id, ranked.rank, ranked.value,
                  c.label, c.ph, c.temp FROM ranked LEFT JOIN c ON ranked.action_id = c.action_id),
    cand AS ({_RL_CAND_SQL})
    SELECT protein, accession_id, 'recommended' AS section, rank::BIGINT AS rank, label,
           round(value, 9) AS value, ph, temp FROM rc WHERE rank = 1
    UNION ALL
    SELECT protein, accession_id, 'ranked', rank::BIGINT, label, round(value, 9), ph, temp FROM rc
    UNION ALL
    SELECT protein, accession_id, 'candidate', rank::BIGINT, sequence, probability,
           NULL::DOUBLE[], NULL::INTEGER[] FROM cand WHERE rank <= 5""")
def q_discovery_report(spark, sf_dir):
    from amphora.sources import catalog

    out = Q.discover(_doc_seqs(spark, sf_dir), catalog.combos(spark).drop("enzymes"), PRIOR, k=5, keys=KEYS)
    return _round_cols(out.withColumn("rank", F.col("rank").cast("bigint")), ["value"])


# ================================================================ A5 / A9 / G1 / T3 / T5
_ENZ = [e.name for e in fixed.ENZYMES]


@register("peptide_counts", f"""
    SELECT protein, {', '.join(f"count_if(enzyme = '{e}')::BIGINT AS {e}" for e in _ENZ)}
    FROM ({O.digest_sql(_DOC)}) GROUP BY protein""")
def q_peptide_counts(spark, sf_dir):
    return peptide_counts(_doc_peptides(spark, sf_dir), "protein", "enzyme", _ENZ)


@register("screening_matrix", f"""
    SELECT protein, {', '.join(f"round(max(CASE WHEN enzyme = '{e}' THEN avg_score END), 9) AS {e}" for e in _ENZ)}
    FROM ({_SCREEN_SQL}) GROUP BY protein""")
def q_screening_matrix(spark, sf_dir):
    res = screen(_doc_peptides(spark, sf_dir), KEYS)
    out = pivot_matrix(res, "protein", "enzyme", "avg_score", _ENZ)
    return _round_cols(out, _ENZ)


def _cut_sites_sql() -> str:
    parts = [f"SELECT accession_id, '{r.name}' AS enzyme, string_split({O.marker_sql('sequence', r)}, '|') AS frags "
             f"FROM {_DOC}" for r in fixed.ENZYMES]
    return f"""
    WITH m AS ({' UNION ALL '.join(parts)}),
    u AS (SELECT accession_id, enzyme, unnest(frags) AS f, unnest(range(len(frags))) AS i FROM m),
    c AS (SELECT accession_id, enzyme,
                 sum(length(f)) OVER (PARTITION BY accession_id, enzyme ORDER BY i) AS site FROM u)
    SELECT accession_id, enzyme, list_sort(list_distinct(list_concat([0], list(site::INTEGER)))) AS cut_sites
    FROM c GROUP BY accession_id, enzyme"""


@register("cut_sites", _cut_sites_sql())
def q_cut_sites(spark, sf_dir):
    seqs = _doc_seqs(spark, sf_dir)
    per = F.array(*[F.struct(F.lit(r.name).alias("enzyme"), cut_sites(F.col("sequence"), r).alias("cut_sites"))
                    for r in fixed.ENZYMES])
    return seqs.select("accession_id", F.inline(per))


@register("rank_peptides", f"""
    SELECT protein, enzyme, pos, peptide, {_F['score']} AS simple_amp_score,
           row_number() OVER (PARTITION BY protein, enzyme ORDER BY {_F['score']} DESC, pos) AS rank
    FROM ({O.digest_sql(_DOC)})""")
def q_rank_peptides(spark, sf_dir):
    return rank_peptides(_doc_seqs(spark, sf_dir), "protein")


@register("top_peptides", f"""
    SELECT protein, enzyme, pos, peptide, {_F['score']} AS simple_amp_score
    FROM ({O.digest_sql(_DOC)})
    ORDER BY simple_amp_score DESC, length(peptide) DESC, protein, enzyme, pos LIMIT 10""")
def q_top_peptides(spark, sf_dir):
    from amphora.functions.residues import simple_amp_score

    peps = _doc_peptides(spark, sf_dir).select("protein", "enzyme", "pos", "peptide",
                                               simple_amp_score("peptide").alias("simple_amp_score"))
    return top_k(peps, 10, [F.col("simple_amp_score").desc(), F.length("peptide").desc(),
                            F.col("protein"), F.col("enzyme"), F.col("pos")])


# ================================================================ S2 / J2
_LABEL_CAT = "(SELECT 'doc_' || CAST(doc_id AS VARCHAR) AS protein, CAST(doc_id AS VARCHAR) AS accession_id FROM labels)"


def _label_catalogue(spark, sf_dir):
    return load_table(spark, sf_dir, "labels").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("protein"),
        F.col("doc_id").cast("string").alias("accession_id"))


@register("missing_sequences", f"""
    SELECT * FROM (SELECT 'doc_' || c_custkey AS protein, c_custkey::VARCHAR AS accession_id FROM customer) c WHERE NOT EXISTS (
      SELECT 1 FROM {_DOC} d WHERE d.accession_id = c.accession_id)""")
def q_missing_sequences(spark, sf_dir):
    """S2 on a catalogue with gaps: customer keys beyond the documents' ids."""
    key = F.col("c_custkey").cast("string")
    catalogue = load_table(spark, sf_dir, "customer").select(F.concat(F.lit("doc_"), key).alias("protein"), key.alias("accession_id"))
    seqs = document_sequences(spark, sf_dir).select("accession_id", "sequence")
    return missing_sequences(catalogue, seqs)


@register("attach_sequences", f"""
    SELECT c.protein, c.accession_id, d.sequence
    FROM {_LABEL_CAT} c JOIN {_DOC} d ON c.accession_id = d.accession_id""")
def q_attach_sequences(spark, sf_dir):
    seqs = document_sequences(spark, sf_dir).select("accession_id", "sequence")
    return attach_sequences(_label_catalogue(spark, sf_dir), seqs)


# ================================================================ corpus
_TOK_SQL = """(SELECT lang, source, unnest(regexp_split_to_array(text, '\\s+')) AS sequence FROM documents)"""
_AMP_DB_SQL = f"""
    SELECT sequence, arg_min(source, (prio::VARCHAR || '|' || source)) AS source FROM (
      SELECT upper(replace(sequence, 'ß', 'ss')) AS sequence, source,
             CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS prio
      FROM {_TOK_SQL} WHERE length(sequence) > 0)
    WHERE regexp_matches(sequence, '^[{fixed.STANDARD_RESIDUES}]+$') AND length(sequence) >= 4
    GROUP BY sequence"""


def _amp_db(spark, sf_dir):
    # One scan: English documents are the preferred corpus (precedence 0).
    docs = spread(load_table(spark, sf_dir, "documents").select("text", "lang", "source"))
    tok = docs.select(
        F.explode(F.split("text", r"\s+")).alias("sequence"), "source",
        F.when(F.col("lang") == "en", 0).otherwise(1).alias("source_priority"))
    return U.build_amp_database_tagged(tok.where(F.length("sequence") > 0))


@register("amp_database", _AMP_DB_SQL)
def q_amp_database(spark, sf_dir):
    return _amp_db(spark, sf_dir)


@register("source_breakdown", f"SELECT source, count(*) AS count FROM ({_AMP_DB_SQL}) GROUP BY source")
def q_source_breakdown(spark, sf_dir):
    return U.source_breakdown(_amp_db(spark, sf_dir))


@register("length_stats", f"""
    SELECT count(*) AS n, min(length(sequence))::INTEGER AS min_length,
           max(length(sequence))::INTEGER AS max_length,
           round(avg(length(sequence)), 9) AS mean_length, median(length(sequence))::DOUBLE AS median_length,
           round(stddev_samp(length(sequence)), 9) AS std_length
    FROM ({_AMP_DB_SQL})""")
def q_length_stats(spark, sf_dir):
    out = U.length_stats(_amp_db(spark, sf_dir))
    return _round_cols(out, ["mean_length", "std_length"])


# ================================================================ classifier
# Fixed-rule linear weights over the 64-wide driver embeddings (a stand-in
# model, so both engines can replay the scores exactly).
EMB_DIM = 64
EMB_W = [((i % 7) - 3) / 10.0 for i in range(EMB_DIM)]
EMB_B = 0.05
_EMB_P = O.dot_prob_sql("embedding", EMB_W, EMB_B)


def _emb_pred(spark, sf_dir):
    emb = load_table(spark, sf_dir, "embeddings")
    return emb.select(
        "vec_id", "label", (F.col("label") >= 5).cast("int").alias("y"),
        C.dot_probability("embedding", EMB_W, EMB_B).alias("probability"),
    ).withColumn("prediction", (F.col("probability") > 0.5).cast("int"))


_EMB_PRED_SQL = f"""(SELECT vec_id, label, (label >= 5)::INTEGER AS y, {_EMB_P} AS probability,
                     ({_EMB_P} > 0.5)::INTEGER AS prediction FROM embeddings)"""


@register("dataset_split", """
    SELECT vec_id, label, CASE WHEN (('0x' || substr(md5(CAST(vec_id AS VARCHAR) || '|42|split'), 1, 8))::BIGINT
                                    % 100) < 20 THEN 'test' ELSE 'train' END AS split
    FROM embeddings""")
def q_dataset_split(spark, sf_dir):
    emb = load_table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return C.split_dataset(emb, "vec_id", 20, 42)


@register("predict_fixed", f"""
    SELECT vec_id, label, y, round(probability, 9) AS probability, prediction FROM {_EMB_PRED_SQL}""")
def q_predict_fixed(spark, sf_dir):
    return _round_cols(_emb_pred(spark, sf_dir), ["probability"])


_REPORT_SQL = f"""
    WITH p AS (SELECT y, prediction AS pr FROM {_EMB_PRED_SQL}),
    c AS (SELECT count_if(y = 0 AND pr = 0)::BIGINT AS tp0, count_if(y = 1 AND pr = 1)::BIGINT AS tp1,
                 count_if(pr = 0)::BIGINT AS pp0, count_if(pr = 1)::BIGINT AS pp1,
                 count_if(y = 0)::BIGINT AS s0, count_if(y = 1)::BIGINT AS s1, count(*) AS n FROM p),
    k AS (SELECT '0' AS metric, CASE WHEN pp0 = 0 THEN 0.0 ELSE tp0::DOUBLE / pp0 END AS precision,
                 CASE WHEN s0 = 0 THEN 0.0 ELSE tp0::DOUBLE / s0 END AS recall, s0 AS support,
                 n, (tp0 + tp1)::DOUBLE / n AS acc FROM c
          UNION ALL
          SELECT '1', CASE WHEN pp1 = 0 THEN 0.0 ELSE tp1::DOUBLE / pp1 END,
                 CASE WHEN s1 = 0 THEN 0.0 ELSE tp1::DOUBLE / s1 END, s1, n, (tp0 + tp1)::DOUBLE / n FROM c),
    f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                         ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM k)
    SELECT metric, precision, recall, f1, support FROM f
    UNION ALL SELECT 'accuracy', max(acc), max(acc), max(acc), max(n) FROM f
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), max(n) FROM f
    UNION ALL SELECT 'weighted avg', sum(precision * support) / max(n), sum(recall * support) / max(n),
                     sum(f1 * support) / max(n), max(n) FROM f"""


@register("classification_report", f"""
    SELECT metric, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
           support::BIGINT AS support FROM ({_REPORT_SQL})""")
def q_classification_report(spark, sf_dir):
    pred = _emb_pred(spark, sf_dir)
    out = C.classification_report(pred, "y", "prediction")
    return _round_cols(out, ["precision", "recall", "f1"])


# The unrounded logit: the order and ties of the probability, without the last
# bits of exp().
_SCORES_SQL = f"""(SELECT (label >= 5)::INTEGER AS label, {O.dot_sql("embedding", EMB_W, EMB_B)} AS score FROM embeddings)"""


def _scores(spark, sf_dir):
    emb = load_table(spark, sf_dir, "embeddings")
    return emb.select((F.col("label") >= 5).cast("int").alias("label"), C.dot_logit("embedding", EMB_W, EMB_B).alias("score"))


@register("roc_auc", f"""
    WITH c AS (SELECT score, count_if(label = 1)::BIGINT AS pos, count_if(label <> 1)::BIGINT AS neg FROM {_SCORES_SQL} GROUP BY score),
    r AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_le FROM c)
    SELECT round(sum(pos * (neg_le - neg * 0.5)) / (sum(pos)::DOUBLE * sum(neg)), 9) AS auc,
           sum(pos)::BIGINT AS positives, sum(neg)::BIGINT AS negatives FROM r""")
def q_roc_auc(spark, sf_dir):
    return _round_cols(C.roc_auc(_scores(spark, sf_dir)), ["auc"])


@register("roc_curve", f"""
    WITH c AS (SELECT score, count_if(label = 1)::BIGINT AS pos, count_if(label <> 1)::BIGINT AS neg FROM {_SCORES_SQL} GROUP BY score),
    t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM c),
    r AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM c
          WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT round(score, 9) AS threshold, round(fp::DOUBLE / N, 9) AS fpr, round(tp::DOUBLE / P, 9) AS tpr FROM r, t""")
def q_roc_curve(spark, sf_dir):
    return _round_cols(C.roc_curve(_scores(spark, sf_dir)), ["threshold", "fpr", "tpr"])


@register("mean_pool", """
    SELECT label, list_transform(list(m ORDER BY i), lambda x: round(x, 9)) AS pooled FROM (
      SELECT label, i, avg(x::DOUBLE) AS m FROM (
        SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings)
      GROUP BY label, i)
    GROUP BY label""")
def q_mean_pool(spark, sf_dir):
    emb = load_table(spark, sf_dir, "embeddings")
    out = C.mean_pool(emb, ["label"], "embedding", "pooled")
    return out.withColumn("pooled", F.transform("pooled", lambda x: F.round(x, 9)))


_COMP_SQL = "[" + ", ".join(O.fraction_sql("sequence", a) for a in fixed.STANDARD_RESIDUES) + "]"


@register("embed_arrow", f"""
    SELECT accession_id, list_transform({_COMP_SQL}, lambda x: round(x, 9)) AS embedding FROM {_DOC}""")
def q_embed_arrow(spark, sf_dir):
    seqs = _doc_seqs(spark, sf_dir).select("accession_id", "sequence")
    out = C.embed_with(seqs, "sequence", C.numpy_composition_embedder, len(fixed.STANDARD_RESIDUES))
    return out.select("accession_id", F.transform("embedding", lambda x: F.round(x, 9)).alias("embedding"))


_ML_SCREEN_SQL = f"""
    SELECT protein, accession_id, enzyme, {fixed.DEFAULT_MIN_LENGTH} AS min_length,
           {fixed.DEFAULT_MAX_LENGTH} AS max_length, count(*) AS num_peptides,
           count_if(z > 0.0)::BIGINT AS num_predicted_amp, avg(p) AS avg_probability, max(p) AS top_probability,
           min(CASE WHEN k = 1 THEN peptide END) AS top_peptide, max(z) AS top_z
    FROM (SELECT *, row_number() OVER (PARTITION BY protein, accession_id, enzyme ORDER BY z DESC, pos) AS k
          FROM (SELECT *, {_PRIOR_P} AS p, {O.linear_logit_sql("peptide", PRIOR.weights, PRIOR.bias)} AS z
                FROM ({O.digest_sql(_DOC)})))
    GROUP BY protein, accession_id, enzyme"""


@register("ml_screening", f"""
    SELECT protein, accession_id, enzyme, min_length, max_length, num_peptides, num_predicted_amp,
           round(avg_probability, 9) AS avg_probability, round(top_probability, 9) AS top_probability,
           top_peptide, rank
    FROM (SELECT *, row_number() OVER (ORDER BY top_z DESC, protein, enzyme) AS rank
          FROM ({_ML_SCREEN_SQL}))""")
def q_ml_screening(spark, sf_dir):
    out = Q.screen_combinations_ml(_doc_seqs(spark, sf_dir), PRIOR)
    return _round_cols(out, ["avg_probability", "top_probability"])


@register("score_distinct", f"""
    SELECT protein, accession_id, enzyme, pos, peptide, round({_PRIOR_P}, 9) AS amp_probability
    FROM ({O.digest_sql(_DOC)})""")
def q_score_distinct(spark, sf_dir):
    scorer = C.embedding_scorer(C.numpy_composition_embedder, len(fixed.STANDARD_RESIDUES), PRIOR.weights, PRIOR.bias)
    out = C.score_distinct(_doc_peptides(spark, sf_dir), scorer)
    return _round_shares(out, ["amp_probability"])


def _amp_positives(spark, sf_dir):
    # Read twice (length bounds, then the anti join): build once and cut the
    # lineage with a reliable checkpoint in the session's checkpoint folder.
    from amphora.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return _amp_db(spark, sf_dir).checkpoint(eager=True)


_NEG_SQL = f"""
    WITH pos AS ({_AMP_DB_SQL}),
    b AS (SELECT min(length(sequence)) AS lo, max(length(sequence)) AS hi, count(*) AS n FROM pos),
    ids AS (SELECT unnest(range(2 * n)) AS id, lo, hi FROM b),
    cand AS (SELECT id, array_to_string(list_transform(
                 range(1, lo + (('0x' || substr(md5(CAST(id AS VARCHAR) || '|42|len'), 1, 8))::BIGINT
                                % (hi - lo + 1)) + 1),
                 lambda k: substr('{fixed.STANDARD_RESIDUES}',
                     ((('0x' || substr(md5(CAST(id AS VARCHAR) || '|42|' || CAST(k AS VARCHAR)), 1, 8))::BIGINT
                       % 20) + 1)::INTEGER, 1)), '') AS sequence FROM ids),
    fresh AS (SELECT * FROM cand WHERE sequence NOT IN (SELECT sequence FROM pos)),
    firsts AS (SELECT sequence, min(id) AS id FROM fresh GROUP BY sequence)
    SELECT sequence, 'negative' AS source, 0 AS label
    FROM (SELECT *, row_number() OVER (ORDER BY id) AS r FROM firsts)
    WHERE r <= (SELECT n FROM b)"""


@register("negatives", _NEG_SQL)
def q_negatives(spark, sf_dir):
    pos = _amp_positives(spark, sf_dir)
    n, lo, hi = C.positive_bounds(pos)
    return C.generate_negatives(spark, pos, n, seed=42, bounds=(lo, hi))


_SPLIT_SQL = """CASE WHEN (('0x' || substr(md5(CAST(vec_id AS VARCHAR) || '|42|split'), 1, 8))::BIGINT % 100) < 20
                 THEN 'test' ELSE 'train' END"""


# The fit is checked by a property of its objective: the intercept is not
# penalised, so the mean fitted probability of the training rows is their base rate.
@register("classifier_fit", f"""
    SELECT count(*) AS n, sum((label >= 5)::INTEGER)::BIGINT AS positives,
           round(avg((label >= 5)::INTEGER), 4) AS mean_probability
    FROM embeddings WHERE {_SPLIT_SQL} = 'train'""")
def q_classifier_fit(spark, sf_dir):
    emb = load_table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"),
        (F.col("label") >= 5).cast("int").alias("label"))
    data = C.split_dataset(emb, "vec_id", 20, 42)
    train = data.where("split = 'train'")
    model = C.fit_logistic(train, "embedding", "label")
    return C.predict(model, train, "embedding").agg(
        F.count("*").alias("n"), F.sum("label").alias("positives"), F.round(F.avg("probability_1"), 4).alias("mean_probability"))


@register("classifier_predict", f"""
    SELECT vec_id, (label >= 5)::INTEGER AS label FROM embeddings WHERE {_SPLIT_SQL} = 'test'""")
def q_classifier_predict(spark, sf_dir):
    """C2 + C3 on the test rows; a row is returned if its probability is one
    and its prediction follows from it."""
    emb = load_table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"),
        (F.col("label") >= 5).cast("int").alias("label"))
    data = C.split_dataset(emb, "vec_id", 20, 42)
    model = C.fit_logistic(data.where("split = 'train'"), "embedding", "label")
    out = C.predict(model, data.where("split = 'test'"), "embedding")
    return out.where("probability_1 BETWEEN 0 AND 1 AND (probability_1 > 0.5) = (prediction = 1)").select("vec_id", "label")


# ================================================================ P15/P16/P18/P19
from amphora.functions.residues import capitalise, relabel, round_for_display  # noqa: E402
from amphora.operators.ranking import candidate_columns  # noqa: E402

ENZYME_DISPLAY = {e.name: e.name.capitalize() for e in fixed.ENZYMES}
_ENZ_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ENZYME_DISPLAY.items())


@register("screening_display", f"""
    SELECT upper(substr(protein, 1, 1)) || lower(substr(protein, 2)) AS protein,
           CASE enzyme {_ENZ_CASE} END AS enzyme, top_peptide,
           round(top_probability, 4) AS top_probability, num_predicted_amp,
           round(avg_probability, 4) AS avg_probability, rank
    FROM (SELECT *, row_number() OVER (ORDER BY top_z DESC, protein, enzyme) AS rank
          FROM ({_ML_SCREEN_SQL}))""")
def q_screening_display(spark, sf_dir):
    ranked = candidate_columns(Q.screen_combinations_ml(_doc_seqs(spark, sf_dir), PRIOR))
    return ranked.select(
        capitalise("protein").alias("protein"), relabel("enzyme", ENZYME_DISPLAY).alias("enzyme"),
        "top_peptide", round_for_display("top_probability", 4).alias("top_probability"),
        "num_predicted_amp", round_for_display("avg_probability", 4).alias("avg_probability"), "rank")


@register("prepare_dataset", f"""
    WITH pos AS ({_AMP_DB_SQL}), neg AS ({_NEG_SQL}),
    lab AS (SELECT sequence, source, 1 AS label FROM pos
            UNION ALL SELECT sequence, source, label FROM neg)
    SELECT sequence, source, label,
           CASE WHEN (('0x' || substr(md5(sequence || '|42|split'), 1, 8))::BIGINT % 100) < 20
                THEN 'test' ELSE 'train' END AS split
    FROM lab""")
def q_prepare_dataset(spark, sf_dir):
    """C5 (+U4, G5, C1): positives with label 1, as many generated
    negatives with label 0, and the hash split on the sequence."""
    pos = _amp_positives(spark, sf_dir)
    return C.prepare_dataset(spark, pos, C.positive_bounds(pos)[0], seed=42)


_EVAL_SPLIT = "CASE WHEN (('0x' || substr(md5(sequence || '|42|split'), 1, 8))::BIGINT % 100) < 20 THEN 'test' ELSE 'train' END"


# Checked by what does not depend on the optimiser: the supports of the report,
# and the mean fitted probability of the training rows, which is their base rate.
@register("classifier_eval", f"""
    WITH pos AS ({_AMP_DB_SQL}), neg AS ({_NEG_SQL}),
    lab AS (SELECT sequence, 1 AS label FROM pos UNION ALL SELECT sequence, label FROM neg),
    s AS (SELECT label, {_EVAL_SPLIT} AS split FROM lab),
    c AS (SELECT count_if(split = 'test' AND label = 0)::BIGINT AS s0, count_if(split = 'test' AND label = 1)::BIGINT AS s1,
                 round(avg(label) FILTER (split = 'train'), 3) AS base FROM s)
    SELECT '0' AS metric, s0 AS support, base AS mean_probability FROM c
    UNION ALL SELECT '1', s1, base FROM c
    UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), s0 + s1, base FROM c""")
def q_classifier_eval(spark, sf_dir):
    """The corpus-to-classifier flow on driver data: AMP corpus positives,
    generated negatives, hash split, composition features, MLlib logistic
    regression, report on the test split."""
    report, fitted = classifier_flow(spark, sf_dir)
    mean = fitted.where("split = 'train'").agg(F.round(F.avg("probability_1"), 3).alias("mean_probability"))
    return report.select("metric", "support", mean.scalar().alias("mean_probability"))


def classifier_flow(spark, sf_dir):
    """(report on the test split, all rows with split, label and probability_1)."""
    pos = _amp_positives(spark, sf_dir).withColumn("source", F.lit("corpus"))
    data = C.prepare_dataset(spark, pos, C.positive_bounds(pos)[0], seed=42)
    feats = pin_table(data.withColumn("features", C.composition("sequence")), "dataset")
    model = C.fit_logistic(feats.where("split = 'train'"), "features", "label")
    fitted = pin_table(C.predict(model, feats, "features").select("sequence", "split", "label", F.col("prediction").cast("int").alias("prediction"), "probability_1"), "fitted")
    return C.classification_report(fitted.where("split = 'test'"), "label", "prediction"), fitted


# ================================================================ checks of wider inputs
_MIXED = "(SELECT DISTINCT unnest(string_split_regex(text, '\\s+')) AS peptide FROM documents)"
_MIXED_F = O.features_sql("upper(peptide)")


@register("features_lowercase", f"""
    SELECT peptide, {_MIXED_F['net_charge']} AS net_charge, round({_MIXED_F['hydrophobic_fraction']}, 9) AS hydrophobic_fraction,
           round({_MIXED_F['aromatic_fraction']}, 9) AS aromatic_fraction, {_MIXED_F['score']} AS simple_amp_score
    FROM {_MIXED} WHERE regexp_matches(peptide, '^[A-Za-z]+$')""")
def q_features_lowercase(spark, sf_dir):
    """P2-P5 on words in either case."""
    from amphora.functions import residues as R

    docs = spread(load_table(spark, sf_dir, "documents").select("text"))
    words = docs.select(F.explode(F.split("text", r"\s+")).alias("peptide")).where(F.col("peptide").rlike("^[A-Za-z]+$")).distinct()
    return words.select(
        "peptide", R.net_charge("peptide").alias("net_charge"), F.round(R.hydrophobic_fraction("peptide"), 9).alias("hydrophobic_fraction"),
        F.round(R.aromatic_fraction("peptide"), 9).alias("aromatic_fraction"), R.simple_amp_score("peptide").alias("simple_amp_score"))


EVENT_ACTIONS = ["click", "error", "purchase", "signup", "view"]


@register("assign_actions_all", f"""
    WITH best AS ({_BEST_SQL}), req AS (SELECT c_custkey AS request_id, c_custkey AS run_id FROM customer)
    SELECT r.request_id, r.run_id, explore,
           CASE WHEN explore THEN {EVENT_ACTIONS}[(('0x' || substr(md5(CAST(r.request_id AS VARCHAR) || '|42|action'), 1, 8))::BIGINT % 5)::INTEGER + 1]
                ELSE coalesce(b.best_action, '{EVENT_ACTIONS[0]}') END AS action_id
    FROM (SELECT r.*, (('0x' || substr(md5(CAST(r.request_id AS VARCHAR) || '|42|explore'), 1, 8))::BIGINT
                       / 4294967296.0) < 0.2 AS explore FROM req r) r
    LEFT JOIN best b ON r.run_id = b.run_id""")
def q_assign_actions_all(spark, sf_dir):
    """B1 with the whole action space and runs that have no history."""
    key = F.col("c_custkey")
    requests = load_table(spark, sf_dir, "customer").select(key.alias("request_id"), key.alias("run_id"))
    return B.assign_actions(requests, B.action_values(_log(spark, sf_dir)), 0.2, seed=42, action_ids=EVENT_ACTIONS)


_GAPS = "(SELECT *, CASE WHEN epoch_us(ts) % 3 = 0 THEN NULL ELSE value END AS own FROM events)"


@register("value_trajectory_nulls", f"""
    SELECT user_id % 7 AS run_id, event_id, sum(own) OVER w AS total, max(own) OVER w AS best, min(own) OVER w AS least, count(*) OVER w AS n
    FROM {_GAPS} WINDOW w AS (PARTITION BY user_id % 7 ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""".replace(
        "sum(own) OVER w", "round(sum(own) OVER w, 6)"))
def q_value_trajectory_nulls(spark, sf_dir):
    """The running aggregates over few hot keys and values with gaps."""
    from amphora.operators.running import running

    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    log = load_table(spark, sf_dir, "events").select(
        (F.col("user_id") % 7).alias("run_id"), "event_id", F.when(micros % 3 != 0, F.col("value")).alias("own"))
    out = running(log, [F.col("event_id").asc()], {
        "total": ("sum", F.col("own")), "best": ("max", F.col("own")), "least": ("min", F.col("own")), "n": ("sum", F.lit(1).cast("bigint"))}, keys=["run_id"])
    return out.withColumn("total", F.round("total", 6)).drop("own")


@register("value_trajectory_gaps", f"""
    SELECT user_id % 7 AS run_id, event_type AS action_id, event_id, own AS reward, count(*) OVER w AS n, round(avg(own) OVER w, 9) AS value
    FROM {_GAPS} WINDOW w AS (PARTITION BY user_id % 7, event_type ORDER BY event_id // 1000, event_id % 3, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_value_trajectory_gaps(spark, sf_dir):
    """W2 on steps without a reward and with equal step numbers."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    log = load_table(spark, sf_dir, "events").select(
        (F.col("user_id") % 7).alias("run_id"), F.floor(F.col("event_id") / 1000).alias("episode"), (F.col("event_id") % 3).alias("step"),
        F.col("event_type").alias("action_id"), F.when(micros % 3 != 0, F.col("value")).alias("reward"), "event_id")
    return B.value_trajectory(log).drop("episode", "step").withColumn("value", F.round("value", 9))


_FEATS_ML = O.features_sql("peptide")


@register("peptide_features_ml", f"""
    SELECT protein, accession_id, enzyme, pos, peptide, {_FEATS_ML['length']} AS length, {_FEATS_ML['net_charge']} AS net_charge,
           round({_FEATS_ML['hydrophobic_fraction']}, 9) AS hydrophobic_fraction, round({_FEATS_ML['aromatic_fraction']}, 9) AS aromatic_fraction,
           {_FEATS_ML['score']} AS simple_amp_score, round({_PRIOR_P}, 9) AS amp_probability,
           ({O.linear_logit_sql("peptide", PRIOR.weights, PRIOR.bias)} > 0)::INTEGER AS amp_prediction
    FROM ({O.digest_sql(_DOC)})""")
def q_peptide_features_ml(spark, sf_dir):
    out = C.peptide_features_ml(_doc_peptides(spark, sf_dir), PRIOR)
    return _round_shares(out, ["hydrophobic_fraction", "aromatic_fraction", "amp_probability"])


# The embedder's fractions are added in another order than the SQL's counts, so
# what is compared is rounded and ranks nothing.
@register("combo_rewards_embedder", REGISTRY["combo_rewards"].sql)
def q_combo_rewards_embedder(spark, sf_dir):
    """A6 through an embedder and a fitted model's coefficients (E1 + C3)."""
    scorer = C.embedding_scorer(C.numpy_composition_embedder, len(fixed.STANDARD_RESIDUES), list(PRIOR.weights), PRIOR.bias)
    out = Q.combo_rewards(_doc_seqs(spark, sf_dir), scorer)
    return _round_cols(out, ["avg_probability", "max_probability", "reward"])


@register("dataset_split_exact", """
    SELECT vec_id, CASE WHEN row_number() OVER (ORDER BY h, vec_id::VARCHAR) <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split
    FROM (SELECT vec_id, ('0x' || substr(md5(CAST(vec_id AS VARCHAR) || '|42|split'), 1, 8))::BIGINT AS h, count(*) OVER () AS n FROM embeddings)""")
def q_dataset_split_exact(spark, sf_dir):
    """C1 with exactly the fifth of the rows that a ceiling of the share gives."""
    return C.split_dataset(load_table(spark, sf_dir, "embeddings").select("vec_id"), "vec_id", 20, 42, exact=True)


@register("mean_pool_tokens", """
    SELECT vec_id, [round(list_avg([embedding[4 * i + d]::DOUBLE for i in range(1, 15)]), 9) for d in range(1, 5)] AS pooled FROM embeddings""")
def q_mean_pool_tokens(spark, sf_dir):
    """E2 per sequence: a vector of 64 read as start token, 14 residues and end token of width 4."""
    emb = load_table(spark, sf_dir, "embeddings")
    tokens = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.slice("embedding", i * 4 + 1, F.lit(4)))
    out = C.mean_pool_tokens(emb.select("vec_id", tokens.alias("tokens"), F.lit(14).alias("n")), "tokens", "n")
    return out.select("vec_id", F.transform("pooled", lambda x: F.round(x, 9)).alias("pooled"))


# ================================================================ C2 certified, S3-S9 round trips, P11, P12
def _labelled_vectors(spark, sf_dir):
    emb = load_table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"), (F.col("label") >= 5).cast("int").alias("label"))
    return C.split_dataset(emb, "vec_id", 20, 42)


def _certificate(model, train):
    out = C.penalised_gradient(train, "embedding", "label", [float(w) for w in model.coefficients], float(model.intercept))
    return out.select("feature", (F.round("gradient", 5) + 0.0).alias("gradient"))


_ZERO_GRADIENT = "SELECT feature::INTEGER AS feature, 0.0::DOUBLE AS gradient FROM (SELECT unnest(range(-1, (SELECT max(len(embedding)) FROM embeddings))) AS feature)"


@register("classifier_gradient", _ZERO_GRADIENT)
def q_classifier_gradient(spark, sf_dir):
    """At the fitted coefficients the penalised loss has no slope in any direction."""
    train = _labelled_vectors(spark, sf_dir).where("split = 'train'")
    return _certificate(C.fit_logistic(train, "embedding", "label"), train)


@register("model_roundtrip", _ZERO_GRADIENT)
def q_model_roundtrip(spark, sf_dir):
    """Trained and saved, then found and loaded: the loaded model is the optimum too."""
    from amphora.sources.models import load_or_train

    train = _labelled_vectors(spark, sf_dir).where("split = 'train'")
    path = scratch_path(spark, "model")
    load_or_train(path, lambda: C.fit_logistic(train, "embedding", "label"))

    def again():
        raise RuntimeError("the saved model was not found")

    return _certificate(load_or_train(path, again), train)


# One feature and an intercept: small enough for Newton's method in SQL, which
# gives the coefficients themselves.
_NEWTON_SQL = f"""
    WITH RECURSIVE own AS (SELECT vec_id, embedding[1]::DOUBLE AS x, (label >= 5)::INTEGER AS y, {_SPLIT_SQL} AS split FROM embeddings),
    steps AS (
      SELECT 0 AS k, 0.0::DOUBLE AS w, 0.0::DOUBLE AS b
      UNION ALL
      SELECT k + 1, w - (gw * hbb - gb * hwb) / (hww * hbb - hwb * hwb), b - (gb * hww - gw * hwb) / (hww * hbb - hwb * hwb)
      FROM (SELECT k, w, b, sum((p - y) * x) + w AS gw, sum(p - y) AS gb, sum(p * (1 - p) * x * x) + 1 AS hww, sum(p * (1 - p) * x) AS hwb, sum(p * (1 - p)) AS hbb
            FROM (SELECT k, w, b, x, y, 1 / (1 + exp(-(w * x + b))) AS p FROM steps, own WHERE k < 20 AND split = 'train') GROUP BY k, w, b)
    ), fitted AS (SELECT w, b FROM steps WHERE k = 20)
    SELECT vec_id, label, (w * x + b > 0)::INTEGER AS prediction, 1 / (1 + exp(-(w * x + b))) AS probability
    FROM (SELECT own.*, y AS label FROM own WHERE split = 'test'), fitted"""


def _newton_predictions(spark, sf_dir):
    data = _labelled_vectors(spark, sf_dir).withColumn("features", F.slice("embedding", 1, 1)).drop("embedding")
    model = C.fit_logistic(data.where("split = 'train'"), "features", "label")
    out = C.predict(model, data.where("split = 'test'"), "features")
    return out.select("vec_id", "label", F.col("prediction").cast("int").alias("prediction"), F.col("probability_1").alias("probability"))


@register("classifier_newton", f"SELECT vec_id, label, prediction, round(probability, 2) AS probability FROM ({_NEWTON_SQL})")
def q_classifier_newton(spark, sf_dir):
    """Fitted on one feature, predictions of the test rows."""
    return _newton_predictions(spark, sf_dir).withColumn("probability", F.round("probability", 2))


@register("classifier_metrics", f"""
    WITH r AS ({_REPORT_SQL.replace(_EMB_PRED_SQL, "(SELECT label AS y, prediction FROM newton)").replace("WITH p AS", f"WITH RECURSIVE newton AS ({_NEWTON_SQL}), p AS", 1)}),
    ranked AS (SELECT label, rank() OVER (ORDER BY probability) + (count(*) OVER (PARTITION BY probability) - 1) / 2.0 AS place FROM ({_NEWTON_SQL})),
    area AS (SELECT (sum(place) FILTER (label = 1) - count_if(label = 1) * (count_if(label = 1) + 1) / 2.0) / (count_if(label = 1) * count_if(label = 0)) AS auc FROM ranked)
    SELECT metric, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support, round(auc, 6) AS auc FROM r, area""")
def q_classifier_metrics(spark, sf_dir):
    """A13 and A14 of a fitted model on its test rows."""
    found = pin_table(_newton_predictions(spark, sf_dir), "predictions")
    auc = C.roc_auc(found, "label", "probability").select(F.round("auc", 6)).scalar()
    report = C.classification_report(found, "label", "prediction")
    return report.select("metric", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support", auc.alias("auc"))


@register("results_roundtrip", REGISTRY["rule_screening"].sql)
def q_results_roundtrip(spark, sf_dir):
    """The ranked screening table, published and read by its manifest."""
    from amphora.sources.fasta import publish_results, read_published

    path = scratch_path(spark, "results")
    publish_results(REGISTRY["rule_screening"].run(spark, sf_dir), path)
    return read_published(spark, path)


@register("embeddings_roundtrip", f"""
    SELECT vec_id, label, round(list_sum(embedding::DOUBLE[]), 6) AS total, len(embedding)::INTEGER AS width FROM embeddings WHERE {_SPLIT_SQL} = 'test'""")
def q_embeddings_roundtrip(spark, sf_dir):
    """Vectors saved by split; only the folder of one split is read."""
    from amphora.sources.fasta import load_embeddings, save_embeddings

    path = scratch_path(spark, "embeddings")
    save_embeddings(C.split_dataset(load_table(spark, sf_dir, "embeddings"), "vec_id", 20, 42), path)
    total = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return load_embeddings(spark, path, "test").select("vec_id", "label", F.round(total, 6).alias("total"), F.size("embedding").alias("width"))


@register("fasta_roundtrip", f"SELECT protein AS header, upper(sequence) AS sequence FROM {_DOC} WHERE length(sequence) > 0")
def q_fasta_roundtrip(spark, sf_dir):
    """S3: sequences written as FASTA in lines of 60 letters, and read."""
    from amphora.sources.fasta import read_fasta

    path = scratch_path(spark, "fasta")
    body = F.regexp_replace(F.upper("sequence"), "(.{60})", "$1\n")
    _doc_seqs(spark, sf_dir).select(F.concat(F.lit(">"), "protein", F.lit("\n"), body)).write.text(path)
    return read_fasta(spark, path).select("header", "sequence")


@register("peptide_csvs_roundtrip", """
    SELECT trim(regexp_replace(text, '[\\r\\n]+', ' ', 'g')) AS sequence, 'csv' AS source FROM documents
    WHERE trim(regexp_replace(text, '[\\r\\n]+', ' ', 'g')) <> ''""")
def q_peptide_csvs_roundtrip(spark, sf_dir):
    """One export with the column first, one with it last, read as one."""
    from amphora.sources.fasta import read_peptide_csvs

    path = scratch_path(spark, "csvs")
    docs = load_table(spark, sf_dir, "documents").withColumn("SEQUENCE", F.trim(F.regexp_replace("text", r"[\r\n]+", " ")))
    plain = {"header": True, "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    docs.where("doc_id % 2 = 0 OR doc_id IS NULL").select("SEQUENCE", "doc_id").write.options(**plain).csv(f"{path}/a")
    docs.where("doc_id % 2 <> 0").select("lang", "source", "SEQUENCE").write.options(**plain).csv(f"{path}/b")
    return read_peptide_csvs(spark, f"{path}/*/*.csv", source="csv")


_GIVEN_NAMES = [*_ENZ[:3], *[e.upper() for e in _ENZ[3:]], "Subtilisin"]


@register("enzyme_names", f"""
    WITH own AS (SELECT doc_id, [lang, names[(doc_id % 7 + 1)::INTEGER], names[(doc_id // 7 % 7 + 1)::INTEGER]] AS given FROM documents, (SELECT {_GIVEN_NAMES} AS names))
    SELECT doc_id, list_filter(list_transform(given, lambda e: lower(e)), lambda e: e IN {tuple(_ENZ)}) AS enzymes,
           list_filter(given, lambda e: lower(e) NOT IN {tuple(_ENZ)}) AS unknown,
           list_transform(list_filter(list_transform(given, lambda e: lower(e)), lambda e: e IN {tuple(_ENZ)}),
                          lambda e: CASE e {' '.join(f"WHEN '{e.name}' THEN {float(e.ph_optimum)}::DOUBLE" for e in fixed.ENZYMES)} END) AS ph,
           list_transform(list_filter(list_transform(given, lambda e: lower(e)), lambda e: e IN {tuple(_ENZ)}),
                          lambda e: CASE e {' '.join(f"WHEN '{e.name}' THEN {int(e.temp_optimum_celsius)}" for e in fixed.ENZYMES)} END) AS temp
    FROM own""")
def q_enzyme_names(spark, sf_dir):
    """P11 and P12 on a table's combinations: known names, unknown ones, conditions."""
    from amphora.functions.enzymes import conditions, resolve_combos

    names = F.array(*[F.lit(n) for n in _GIVEN_NAMES])
    pick = lambda i: F.get(names, (i % 7).cast("int"))
    given = F.array("lang", pick(F.col("doc_id")), pick(F.floor(F.col("doc_id") / 7)))
    docs = load_table(spark, sf_dir, "documents").select("doc_id", given.alias("given"))
    return resolve_combos(docs, "given").select("doc_id", "enzymes", "unknown", *conditions("enzymes"))
