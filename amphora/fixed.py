"""Fixed values. These must equal the screening method's published values for
results to match: the residue classes of the score, the six food-grade
protease rules with their optimum conditions, the eight enzyme combinations
(action ids 0-7 in this order), the protein catalogue, the rule-score
thresholds, the reward weights and the bandit schedule defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: residue alphabet and classes -----------------------------
STANDARD_RESIDUES = "ACDEFGHIKLMNPQRSTVWY"
POSITIVE_RESIDUES = "KRH"
NEGATIVE_RESIDUES = "DE"
HYDROPHOBIC_RESIDUES = "AVILMFWY"
AROMATIC_RESIDUES = "FWY"

# --- fixed values: rule score thresholds ------------------------------------
SCORE_LENGTH_RANGE = (8, 30)  # inclusive
SCORE_CHARGE_STEPS = (1, 2)  # +1 at charge >= 1, +1 more at charge >= 2
SCORE_HYDROPHOBIC_RANGE = (0.3, 0.7)  # inclusive
DEFAULT_MIN_LENGTH = 4
DEFAULT_MAX_LENGTH = 50
CORPUS_MIN_LENGTH = 4

# --- fixed values: reward and bandit ----------------------------------------
REWARD_AVG_WEIGHT = 0.4
REWARD_MAX_WEIGHT = 0.6
PREDICT_THRESHOLD = 0.5
EPSILON_START = 1.0
EPSILON_MIN = 0.1
EPSILON_DECAY = 0.995
STEPS_PER_EPISODE_FACTOR = 3  # steps per episode = 3 x number of actions


@dataclass(frozen=True)
class EnzymeRule:
    name: str
    cleaves_after: str = ""
    not_before: str = ""
    cleaves_before: str = ""
    ph_optimum: float = 7.0
    temp_optimum_celsius: int = 37
    source: str = ""
    food_grade: bool = True


# --- fixed values: protease rules (name, cleaves after, not before, cleaves
# before, pH optimum, temperature optimum in Celsius, source) -----------------
ENZYMES: tuple[EnzymeRule, ...] = (
    EnzymeRule("trypsin", "KR", "P", "", 7.8, 37, "porcine/bovine pancreas"),
    EnzymeRule("chymotrypsin", "FYWL", "P", "", 8.0, 37, "bovine pancreas"),
    EnzymeRule("alcalase", "FLYAVIM", "", "", 8.0, 55, "bacillus licheniformis"),
    EnzymeRule("papain", "RKFYLVA", "", "", 6.5, 60, "carica papaya"),
    EnzymeRule("bromelain", "RKAYGV", "", "", 7.0, 50, "ananas comosus"),
    EnzymeRule("pepsin", "", "", "FLWY", 2.0, 37, "porcine stomach"),
)
ENZYME_BY_NAME = {e.name: e for e in ENZYMES}


@dataclass(frozen=True)
class Combo:
    action_id: int
    enzymes: tuple[str, ...]
    label: str = field(default="")


# --- fixed values: enzyme combinations, action ids 0-7 ----------------------
COMBOS: tuple[Combo, ...] = (
    Combo(0, ("trypsin",), "trypsin"),
    Combo(1, ("chymotrypsin",), "chymotrypsin"),
    Combo(2, ("alcalase",), "alcalase"),
    Combo(3, ("papain",), "papain"),
    Combo(4, ("bromelain",), "bromelain"),
    Combo(5, ("pepsin",), "pepsin"),
    Combo(6, ("pepsin", "trypsin"), "pepsin → trypsin"),
    Combo(7, ("alcalase", "papain"), "alcalase → papain"),
)

# --- fixed values: protein catalogue (name, UniProt accession) --------------
PROTEINS: tuple[tuple[str, str], ...] = (
    ("beta-lactoglobulin", "P02754"),
    ("alpha-lactalbumin", "P00711"),
    ("lactoferrin", "P24627"),
    ("BSA", "P02769"),
)

# Corpus source tags and their precedence when a sequence occurs in both.
SOURCE_PRIORITY = (("DBAASP", 0), ("APD6", 1))

# --- fixed values: display names of the catalogue proteins ------------------
PROTEIN_DISPLAY = {
    "beta-lactoglobulin": "β-lactoglobulin",
    "alpha-lactalbumin": "α-lactalbumin",
    "lactoferrin": "Lactoferrin",
    "BSA": "BSA",
}
