"""Embeddings, the logistic-regression scorer and its evaluation
(E1-E3, C1-C5, G5, J4, J6, A13-A15, P14).

The built-in embedder is residue composition (20 fractions), a JVM
expression; a scorer is a linear model over it, so scoring a peptide is one
codegen'd projection. ``embed_with`` is the hook for a Python embedder
(a protein language model, say): it runs as ``mapInArrow`` over Arrow
batches with the model loaded once per task, and is the case where scoring
distinct peptides once (J6) can pay for its shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amphora import fixed
from amphora.fixed import EnzymeRule
from amphora.functions.cleavage import CUT_CHARS, cutter
from amphora.functions.hashing import hash32, uniform_int
from amphora.functions.packed_rows import pack_rows, unpack_keys, unpack_rows
from amphora.functions.residues import _count_members, _members, class_counts, count_residues, peptide_features, predict_label
from amphora.operators.ranking import global_rank
from amphora.session import pin_table
from amphora.sources.files import list_folders, path_exists

ALPHABET = fixed.STANDARD_RESIDUES


def composition_terms(c: Column) -> list[Column]:
    """Fraction of each of the 20 residues (0 for the empty string)."""
    n = F.length(c)
    return [F.coalesce(F.try_divide(count_residues(c, a).cast("double"), n), F.lit(0.0))
            for a in ALPHABET]


def composition(c: str | Column) -> Column:
    """E3 as ARRAY<DOUBLE> (20)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.array(*composition_terms(F.upper(c)))


def _sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


@dataclass(frozen=True)
class LinearScorer:
    """Logistic model over residue composition: p = sigmoid(b + w . x).

    Since every composition term shares the denominator, the logit is
    computed as ``b + (sum_w w * count(residues with weight w)) / length``:
    residues with equal weight form one class, and ``class_counts`` counts
    all classes in one pass over an Arrow batch (the prior has 4 classes
    instead of 20 terms). Residues count in either case;
    ``upper_logit`` is for strings known to be upper-case (digest output)."""

    weights: tuple[float, ...]
    bias: float

    def weight_classes(self) -> list[tuple[float, str]]:
        """(weight, residues) for every distinct non-zero weight, in order
        of first appearance in the alphabet."""
        classes: dict[float, str] = {}
        for a, w in zip(ALPHABET, self.weights):
            if w != 0.0:
                classes[float(w)] = classes.get(float(w), "") + a
        return list(classes.items())

    def logit(self, seq: str | Column) -> Column:
        return self.upper_logit(F.upper(F.col(seq) if isinstance(seq, str) else seq))

    def upper_logit(self, seq: str | Column) -> Column:
        seq = F.col(seq) if isinstance(seq, str) else seq
        classes = self.weight_classes()
        counts = class_counts(seq, [letters for _, letters in classes])
        num = F.lit(0.0)
        for (w, _), cnt in zip(classes, counts):
            num = num + F.lit(w) * cnt.cast("double")
        n = F.length(seq)
        # 0 for the empty string, null for a null sequence.
        frac = F.coalesce(F.try_divide(num, n), F.when(n.isNotNull(), F.lit(0.0)))
        return F.lit(float(self.bias)) + frac

    def probability(self, seq: str | Column) -> Column:
        return _sigmoid(self.logit(seq))


#: Fragments whose residues are counted at once.
SCORE_FRAGMENTS = 1 << 16


def _fragment_logits(scorer: LinearScorer, min_length: int, max_length: int):
    """Function of a list array of upper-case fragments: their number in each
    list, which of all fragments are in the length range (a null one is not),
    and the logits of those, as ``upper_logit`` gives them."""
    classes = scorer.weight_classes()
    weights, member, bias = [w for w, _ in classes], _members([letters for _, letters in classes]), float(scorer.bias)

    def logits(lists: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        frags = lists.flatten()
        lengths = pc.fill_null(pc.utf8_length(frags), -1).to_numpy(zero_copy_only=False)
        kept = (lengths >= min_length) & (lengths <= max_length)
        z = np.empty(len(frags))
        for start in range(0, len(frags), SCORE_FRAGMENTS):
            part = slice(start, start + SCORE_FRAGMENTS)
            counts = _count_members(frags.slice(start, SCORE_FRAGMENTS), member)
            num = np.zeros(len(counts))
            for i, w in enumerate(weights):
                num = num + w * counts[:, i]
            z[part] = bias + num / np.maximum(lengths[part], 1)
        return sizes, frags, kept, z[kept]

    return logits


def fragment_summaries(seq: Column, protocols: Sequence[list[EnzymeRule]], scorer: LinearScorer, min_length: int, max_length: int) -> Column:
    """G3 and C3 of an upper-case sequence: for each protocol (rules in order)
    a struct of the number ``n`` of its fragments in the length range, the
    ``total`` of their probabilities and the highest, ``most`` (null where
    there are none). The sequences of an Arrow batch are cut and scored on
    their bytes, so no fragment becomes a string or a row."""
    _ship_package_code()
    classes, bias = scorer.weight_classes(), float(scorer.bias)
    weights, member, cutters = [w for w, _ in classes], _members([letters for _, letters in classes]), [cutter(rules) for rules in protocols]

    def summed(raw, rows):
        """n, total and most, each (sequences, protocols)."""
        so_far = [np.append(np.int32(0), np.cumsum(of_class[raw], dtype=np.int32)) for of_class in member]
        chars = np.append(0, np.cumsum((raw & 0xC0) != 0x80)) if (raw > 127).any() else None
        out = [np.zeros((len(rows) - 1, len(cutters)), dtype=t) for t in (np.int64, float, float)]
        for i, cut in enumerate(cutters):
            starts, stops = cut(raw, rows)
            lengths = stops - starts if chars is None else chars[stops] - chars[starts]
            kept = (lengths >= min_length) & (lengths <= max_length)
            starts, stops, lengths = starts[kept], stops[kept], lengths[kept]
            num = np.zeros(len(starts))
            for w, held in zip(weights, so_far):
                num = num + w * (held[stops] - held[starts])
            p = 1.0 / (1.0 + np.exp(-(bias + num / np.maximum(lengths, 1))))
            firsts = np.searchsorted(starts, rows)
            n = np.diff(firsts)
            out[0][:, i] = n
            out[1][:, i] = np.bincount(np.repeat(np.arange(len(n)), n), weights=p, minlength=len(n))
            if len(p):
                out[2][n > 0, i] = np.maximum.reduceat(p, firsts[:-1][n > 0])
        return out

    def summaries(strings):
        wide = pa.types.is_large_string(strings.type)
        ends = np.frombuffer(strings.buffers()[1], dtype=np.int64 if wide else np.int32)[strings.offset:strings.offset + len(strings) + 1].astype(np.int64)
        held = strings.buffers()[2]
        raw = np.frombuffer(held, dtype=np.uint8) if held else np.zeros(0, dtype=np.uint8)
        parts, start = [], 0
        while start < len(strings):  # about CUT_CHARS residues at once
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + CUT_CHARS, side="right")) - 1)
            parts.append(summed(raw[ends[start]:ends[stop]], ends[start:stop + 1] - ends[start]))
            start = stop
        n, total, most = (np.concatenate(x).ravel() for x in zip(*parts)) if parts else (np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0))
        none = n == 0
        structs = pa.StructArray.from_arrays([pa.array(n), pa.array(total, mask=none), pa.array(most, mask=none)], names=["n", "total", "most"])
        places = pa.array(np.arange(len(strings) + 1, dtype=np.int32) * np.int32(len(cutters)))
        return pa.ListArray.from_arrays(places, structs, mask=strings.is_null() if strings.null_count else None)

    summaries.__annotations__ = {"strings": pa.Array, "return": pa.Array}
    return F.arrow_udf(summaries, "array<struct<n: bigint, total: double, most: double>>")(seq)


def best_fragments(frags: str | Column, scorer: LinearScorer, k: int, min_length: int, max_length: int) -> Column:
    """T5 over an array of upper-case fragments: array of ``(pos, peptide,
    _z)`` of the ``k`` fragments in the length range with the highest logits,
    the first ones among equals."""
    _ship_package_code()
    logits = _fragment_logits(scorer, min_length, max_length)

    def best(lists):
        sizes, frags, kept, z = logits(lists)
        starts = np.cumsum(sizes) - sizes
        owner, rows = np.repeat(np.arange(len(sizes)), sizes)[kept], np.flatnonzero(kept)
        order = np.lexsort((rows, -z, owner))
        n = np.bincount(owner, minlength=len(sizes))
        place = np.arange(len(order)) - np.repeat(np.cumsum(n) - n, n)  # among its list's, best first
        order = order[place < k]
        ends = np.append(0, np.cumsum(np.minimum(n, k))).astype(np.int32)
        pos = (rows[order] - starts[owner[order]]).astype(np.int32)
        found = pa.StructArray.from_arrays([pa.array(pos), frags.take(pa.array(rows[order])), pa.array(z[order])], names=["pos", "peptide", "_z"])
        return pa.ListArray.from_arrays(pa.array(ends), found)

    best.__annotations__ = {"lists": pa.Array, "return": pa.Array}
    return F.arrow_udf(best, "array<struct<pos: int, peptide: string, _z: double>>")(frags)


def prior_scorer() -> LinearScorer:
    """Transparent default before a model is trained: positive residues up,
    acidic residues down, hydrophobic and aromatic residues up (the same
    properties the rule score rewards)."""
    w = []
    for a in ALPHABET:
        v = 0.0
        v += 4.0 if a in fixed.POSITIVE_RESIDUES else 0.0
        v -= 4.0 if a in fixed.NEGATIVE_RESIDUES else 0.0
        v += 2.0 if a in fixed.HYDROPHOBIC_RESIDUES else 0.0
        v += 1.0 if a in fixed.AROMATIC_RESIDUES else 0.0
        w.append(v)
    return LinearScorer(tuple(w), -2.0)


#: What scores peptides: a linear model over composition, or any function
#: from a table of distinct peptides (one column) to that column and
#: ``amp_probability`` (an embedder with a fitted classifier, say).
Scorer = LinearScorer | Callable[[DataFrame], DataFrame]


def score_peptides(peptides: DataFrame, scorer: Scorer, peptide_col: str = "peptide",
                   threshold: float = fixed.PREDICT_THRESHOLD, keep_logit: bool = False,
                   upper: bool = False) -> DataFrame:
    """``amp_probability`` and ``amp_prediction`` per peptide row; a
    null peptide has null scores. A linear scorer is one projection: the logit
    comes first and is reused (Spark does not collapse a projection whose
    expensive column is referenced twice); ``upper`` says that the peptides
    are upper-case already. An ``EmbeddingScorer`` scores the rows where they
    are; any other scorer sees each distinct peptide once."""
    if isinstance(scorer, LinearScorer):
        logit = scorer.upper_logit(peptide_col) if upper else scorer.logit(peptide_col)
        z = peptides.select("*", logit.alias("_z"))
        out = z.select("*", _sigmoid(F.col("_z")).alias("amp_probability"))
    else:
        p = F.col("amp_probability")
        known = scorer.on_rows(peptides, peptide_col) if isinstance(scorer, EmbeddingScorer) else score_distinct(peptides, scorer, peptide_col, "left")
        out = known.select(
            *peptides.columns,
            F.when(p >= 1, F.lit(float("inf"))).when(p <= 0, F.lit(float("-inf")))
            .otherwise(F.log(p / (1 - p))).alias("_z"), "amp_probability")
    out = out.withColumn("amp_prediction", predict_label("amp_probability", threshold))
    return out if keep_logit else out.drop("_z")


def score_distinct(peptides: DataFrame, score: Callable[[DataFrame], DataFrame],
                   peptide_col: str = "peptide", how: str = "left") -> DataFrame:
    """Score each distinct peptide once and join the scores back; a null
    peptide has a null score (``how`` "inner" drops it). Worth its two shuffles
    only for an expensive scorer (a Python embedder); the distinct has partial
    aggregation, so hot peptides collapse map-side.

    An ``EmbeddingScorer`` needs one shuffle and no join: the rows of a peptide
    are brought together, packed (``on_distinct``), and each peptide is embedded
    once for all. ``peptides`` is computed once."""
    if isinstance(score, EmbeddingScorer) and how in ("left", "inner"):
        rows = peptides if how == "left" else peptides.where(F.col(peptide_col).isNotNull())
        return score.on_distinct(rows, peptide_col)
    distinct = peptides.select(peptide_col).where(F.col(peptide_col).isNotNull()).distinct()
    scored = score(distinct)
    return peptides.join(scored, peptide_col, how)


def stored_scorer(score: Callable[[DataFrame], DataFrame], path: str, model: str,
                  peptide_col: str = "peptide") -> Callable[[DataFrame], DataFrame]:
    """A scorer that keeps its scores: a Parquet table at ``path`` holds
    ``amp_probability`` by peptide, one folder for each ``model``, and only
    peptides that are not in it are given to ``score`` and added. A run's new
    scores are one committed folder of their own, named by what it read, so a
    run that fails leaves nothing behind and the store holds every peptide
    once for a single writer (two runs at a time may both add a peptide;
    readers keep one)."""
    columns = f"{peptide_col} string, amp_probability double"

    def run(distinct: DataFrame) -> DataFrame:
        spark, own = distinct.sparkSession, f"{path}/model={model}"
        held = [f for f in list_folders(spark, own) if path_exists(spark, f"{f}/_SUCCESS")]
        # The store's folders are read as they are, never by a partition's name.
        before = spark.read.schema(columns).parquet(*held) if held else spark.createDataFrame([], columns)
        unseen = distinct.join(before, peptide_col, "left_anti")
        target = f"{own}/run-{uuid.uuid4().hex}"
        score(unseen).select(peptide_col, "amp_probability").write.parquet(target)
        known = spark.read.schema(columns).parquet(*held, target).groupBy(peptide_col).agg(
            F.max("amp_probability").alias("amp_probability"))
        return distinct.join(known, peptide_col)

    return run


@dataclass(frozen=True)
class EmbeddingScorer:
    """A scorer from an embedder (E1) and the coefficients of a fitted
    classifier over its vectors. Called on a table of peptides it gives their
    scores (J6); ``on_rows`` adds the scores to peptide rows where they are,
    each Arrow batch's distinct peptides embedded once: no peptide is
    shuffled, sorted or joined, and a digest is computed once. ``on_distinct``
    brings equal peptides together first, so that each is embedded once in all."""

    make_embedder: Callable[[], Callable]
    dim: int
    weights: tuple[float, ...]
    bias: float
    peptide_col: str = "peptide"

    def __call__(self, distinct: DataFrame) -> DataFrame:
        return self.on_rows(distinct.select(self.peptide_col), self.peptide_col)

    def probability(self, vectors: np.ndarray) -> np.ndarray:
        # C3 as ``dot_probability``, added in the order of the weights.
        z = np.full(len(vectors), float(self.bias))
        for i, w in enumerate(self.weights):
            z = z + vectors[:, i] * float(w)
        with np.errstate(over="ignore"):
            return 1.0 / (1.0 + np.exp(-z))

    def on_rows(self, peptides: DataFrame, peptide_col: str) -> DataFrame:
        return embed_with(peptides, peptide_col, self.make_embedder, self.dim, "amp_probability", self.probability)

    def on_distinct(self, peptides: DataFrame, peptide_col: str) -> DataFrame:
        """``peptide_col``, the other columns of ``peptides`` and the scores.

        A task's rows are dealt to buckets by a hash of the peptide and packed,
        about ``PACKED_BYTES`` at a time, so few bytes a row are shuffled. A
        bucket's peptides are then embedded once each, and its rows unpacked one
        chunk after the other. Rows without a peptide go to any bucket."""
        conf = peptides.sparkSession.conf
        buckets, at = max(LEAST_BUCKETS, 4 * int(conf.get("spark.sql.shuffle.partitions"))), "bucket"
        while at.lower() in [c.lower() for c in peptides.columns]:
            at = f"_{at}"
        others = [c for c in peptides.columns if c != peptide_col]
        schema = T.StructType([*(peptides.schema[c] for c in (peptide_col, *others)), T.StructField("amp_probability", T.DoubleType())])
        make_embedder, dim, probability = self.make_embedder, self.dim, self.probability
        _ship_package_code()

        def pack(batches):
            held, size = [], 0
            for batch in batches:
                held.append(batch)
                size += batch.nbytes
                if size >= PACKED_BYTES:
                    yield from packed(held)
                    held, size = [], 0
            yield from packed(held)

        def packed(held):
            held = pa.Table.from_batches(held).combine_chunks().to_batches() if held else []
            for rows in held:
                known, bucket = rows.column(peptide_col).is_valid().to_numpy(zero_copy_only=False), rows.column(at).to_numpy(zero_copy_only=False)
                bucket = np.where(known, bucket, np.arange(len(bucket)) % buckets)
                for number, value in pack_rows(rows.select([peptide_col, *others]), peptide_col, bucket):
                    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([value], pa.binary())], names=["bucket", "held"])

        def run(batches):
            embed, number, parts = make_embedder(), None, []
            for batch in batches:
                for now, value in zip(batch.column("bucket").to_pylist(), batch.column("held")):
                    if now != number:
                        yield from scored(embed, parts)
                        number, parts = now, []
                    parts.append(value.as_py())
            yield from scored(embed, parts)

        def scored(embed, parts):
            if not parts:
                return
            keys = [unpack_keys(x) for x in parts]
            distinct = pa.concat_arrays(keys).dictionary_encode()
            place, numbers = distinct.indices.to_numpy(zero_copy_only=False), [np.zeros(0)]
            for seqs in _slices(distinct.dictionary):
                numbers.append(probability(_vectors(embed, seqs, dim)))
            numbers, first = np.append(np.concatenate(numbers), np.nan), 0  # NaN stands in for the nulls, which are masked
            for own, value in zip(keys, parts):
                codes, columns = unpack_rows(value)
                null, mine = codes < 0, np.append(place[first:first + len(own)], len(numbers) - 1)
                first += len(own)
                out = [own.take(pa.array(codes, mask=null)), *columns, pa.array(numbers[mine[codes]], mask=null, from_pandas=False)]
                yield pa.RecordBatch.from_arrays(out, names=schema.names)

        dealt = peptides.select(peptide_col, *others, F.pmod(F.xxhash64(peptide_col), F.lit(buckets)).cast("int").alias(at))
        together = dealt.mapInArrow(pack, "bucket int, held binary").repartition("bucket").sortWithinPartitions("bucket")
        return together.mapInArrow(run, schema)


def embedding_scorer(make_embedder: Callable[[], Callable], dim: int, weights: Sequence[float], bias: float,
                     peptide_col: str = "peptide") -> EmbeddingScorer:
    """``EmbeddingScorer`` of these parts."""
    return EmbeddingScorer(make_embedder, dim, tuple(weights), bias, peptide_col)


def peptide_features_ml(peptides: DataFrame, scorer: Scorer, peptide_col: str = "peptide",
                        threshold: float = fixed.PREDICT_THRESHOLD) -> DataFrame:
    """C4: the columns of ``peptides``, the five P6 features, and the scorer's
    ``amp_probability`` and ``amp_prediction``."""
    scored = score_peptides(peptides, scorer, peptide_col, threshold)
    return scored.select(*peptides.columns, *peptide_features(peptide_col)[1:], "amp_probability", "amp_prediction")


# ------------------------------------------------------------------ E1 / E2
#: Residues handed to a Python embedder at once.
EMBED_CHARS = 1 << 20

#: Bytes of rows that a task deals to buckets at once, and the least number of buckets.
PACKED_BYTES, LEAST_BUCKETS = 48 << 20, 256


def _slices(strings: pa.Array) -> Iterator[list[str]]:
    """The strings, about ``EMBED_CHARS`` residues at a time."""
    ends, start = np.cumsum(pc.utf8_length(strings).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while start < len(strings):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + EMBED_CHARS, side="right")))
        yield strings.slice(start, stop - start).to_pylist()
        start = stop


def _vectors(embed: Callable, seqs: list[str], dim: int) -> np.ndarray:
    return np.asarray(embed(seqs), dtype="float64").reshape(len(seqs), dim)


def _ship_package_code() -> None:
    """Pickle this package's functions by value, so Python workers run them
    without the package being installed on the executors."""
    try:
        import amphora
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(amphora)
    except (ImportError, AttributeError, ValueError):  # older cloudpickle
        pass


def embed_with(df: DataFrame, seq_col: str, make_embedder: Callable[[], Callable],
               dim: int, out_col: str = "embedding", readout: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """``make_embedder()`` is called once per task and returns a function
    ``list[str] -> np.ndarray (n, dim)``; a call gets at most about
    ``EMBED_CHARS`` residues, and equal sequences of an Arrow batch once. A
    null sequence has a null vector. With ``readout``, a function from
    vectors to one number each, the column holds that number and no vector
    leaves the Python worker."""
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.DoubleType() if readout else T.ArrayType(T.DoubleType()))])
    _ship_package_code()

    def run(batches):
        embed = make_embedder()
        for batch in batches:
            held = batch.column(seq_col).dictionary_encode()  # equal sequences of a batch are embedded once
            known = held.is_valid().to_numpy(zero_copy_only=False)
            place = held.indices.fill_null(0).to_numpy(zero_copy_only=False)
            values = np.concatenate([np.zeros((0, dim)), *(_vectors(embed, seqs, dim) for seqs in _slices(held.dictionary))])
            if readout:
                numbers = np.append(readout(values), np.nan)  # NaN stands in for the nulls, which are masked
                out = pa.array(numbers[np.where(known, place, -1)], mask=~known, from_pandas=False)
                yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, out_col])
                continue
            values = values[place[known]]
            ends = np.append(0, np.cumsum(known, dtype=np.int32) * np.int32(dim)).astype(np.int32)
            vecs = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()), mask=pa.array(~known) if not known.all() else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, vecs], names=[*batch.schema.names, out_col])

    return df.mapInArrow(run, schema)


def numpy_composition_embedder() -> Callable[[list[str]], np.ndarray]:
    """A Python embedder for ``embed_with``: residue composition computed
    for a whole Arrow batch at once (one byte buffer, one ``bincount``)."""
    lookup = np.full(256, -1, dtype=np.int64)
    for j, a in enumerate(ALPHABET):
        lookup[ord(a)] = j
        lookup[ord(a.lower())] = j
    k = len(ALPHABET)

    def embed(seqs: list[str]) -> np.ndarray:
        n = len(seqs)
        lens = np.fromiter((len(s) for s in seqs), dtype=np.int64, count=n)
        # 'replace' keeps one byte per character, so offsets stay aligned.
        buf = np.frombuffer("".join(seqs).encode("ascii", "replace"), dtype=np.uint8)
        idx = lookup[buf]
        row = np.repeat(np.arange(n), lens)
        ok = idx >= 0
        counts = np.bincount(row[ok] * k + idx[ok], minlength=n * k).reshape(n, k)
        with np.errstate(invalid="ignore", divide="ignore"):
            out = counts / lens[:, None]
        return np.nan_to_num(out, nan=0.0)

    return embed


def mean_pool(tokens: DataFrame, keys: Sequence[str], vec_col: str = "embedding",
              out_col: str = "pooled") -> DataFrame:
    """Per-dimension mean of the vectors of each group. Dimensions are
    exploded and averaged with partial aggregation (a hot group costs one
    buffer per task and dimension), then reassembled in index order; the
    reassembled array is bounded by the vector width."""
    exploded = tokens.select(*keys, F.posexplode(vec_col).alias("_i", "_x"))
    per_dim = exploded.groupBy(*keys, "_i").agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    return per_dim.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))), lambda s: s["_m"])
        .alias(out_col))


def mean_pool_tokens(df: DataFrame, tokens_col: str, length_col: str,
                     out_col: str = "pooled") -> DataFrame:
    """E2 per sequence: mean over the L residue tokens of an
    ARRAY<ARRAY<FLOAT>> of per-token vectors, skipping the start token (and
    with it the end token, which follows the L residues). Per-row arrays are
    bounded by the sequence length times the vector width."""
    toks = F.slice(F.col(tokens_col), 2, F.col(length_col))
    dim = F.coalesce(F.size(F.get(F.col(tokens_col), F.lit(0))), F.lit(0))
    summed = F.aggregate(
        toks, F.array_repeat(F.lit(0.0), dim),
        lambda acc, v: F.zip_with(acc, v, lambda a, b: a + b.cast("double")))
    # A sequence without residues has no mean: zeros, as for the empty composition.
    return df.withColumn(out_col, F.transform(summed, lambda x: x / F.greatest(F.size(toks), F.lit(1))))


# ------------------------------------------------------------------ C1 / G5
def split_dataset(df: DataFrame, key: str | Column, test_percent: int = 20,
                  seed: int = 42, exact: bool = False) -> DataFrame:
    """``split`` = 'test' for about ``test_percent`` % of rows, chosen by
    a hash of (key, seed): stable under repartitioning and retries. With
    ``exact`` the test split has exactly ceil(n * test_percent / 100) rows:
    rows are ranked by (hash, key) with the distributed global rank and the
    lowest ranks go to test (35 897 rows -> 7 180 at 20 %)."""
    if not exact:
        bucket = uniform_int(100, key, F.lit(seed), F.lit("split"))
        return df.withColumn("split", F.when(bucket < test_percent, "test").otherwise("train"))
    key_col = F.col(key) if isinstance(key, str) else key
    h = hash32(key_col, F.lit(seed), F.lit("split"))
    ranked = global_rank(df.withColumn("_h", h).withColumn("_k", key_col.cast("string")),
                         [F.col("_h").asc(), F.col("_k").asc()], "_r")
    n_test = -(-ranked.count() * test_percent // 100)
    return ranked.withColumn("split", F.when(F.col("_r") <= n_test, "test").otherwise("train")).drop(
        "_h", "_k", "_r")


def positive_bounds(positives: DataFrame, seq_col: str = "sequence"):
    """(count, shortest, longest) of the positives in one aggregate: three
    scalars for the driver, used as literals by ``generate_negatives``."""
    b = positives.agg(F.count(F.lit(1)).alias("n"), F.min(F.length(seq_col)).alias("lo"),
                      F.max(F.length(seq_col)).alias("hi")).first()
    return int(b.n), b.lo, b.hi


def nth_smallest(df: DataFrame, column: str, n: int, below: int) -> int:
    """The n-th smallest value of a column of distinct whole numbers from 0 to
    ``below`` - 1: counts in 4 096 ranges, then in the ranges of the one that
    holds it, and so on (two passes up to 2**24, no sort). ``df`` is read
    again in each; pin it."""
    low = 0
    while below - low > 1:
        width = -(-(below - low) // 4096)
        place = F.floor((F.col(column) - low) / width)
        counts = df.where(F.col(column).between(low, below - 1)).groupBy(place.alias("p")).agg(F.count(F.lit(1)).alias("c")).collect()
        for row in sorted(counts, key=lambda r: r["p"]):
            if n <= row["c"]:
                low, below = low + row["p"] * width, min(below, low + (row["p"] + 1) * width)
                break
            n -= row["c"]
        else:
            raise ValueError("fewer values than asked for")
    return low


def _random_sequences(spark: SparkSession, first: int, last: int, lo: int, hi: int, seed: int, seq_col: str) -> DataFrame:
    """Ids ``first`` to ``last`` - 1, each with a sequence that is a pure function of (id, seed)."""
    width = len(ALPHABET)
    length = F.lit(lo) + uniform_int(hi - lo + 1, F.col("id"), F.lit(seed), F.lit("len"))
    letters = F.transform(
        F.sequence(F.lit(1), length.cast("int")),
        lambda k: F.substr(F.lit(ALPHABET),
                           (uniform_int(width, F.col("id"), F.lit(seed), k) + 1).cast("int"),
                           F.lit(1)))
    return spark.range(first, last).select("id", F.array_join(letters, "").alias(seq_col))


def generate_negatives(spark: SparkSession, positives: DataFrame, n: int, seed: int = 42,
                       oversample: int = 2, seq_col: str = "sequence",
                       bounds: tuple[int, int] | None = None) -> DataFrame:
    """G5 + J4: ``n`` random sequences not among the positives, lengths
    uniform between the positives' shortest and longest, residues uniform.
    Candidates are a range of ids; each is a pure function of (id, seed).
    Known sequences are removed with an anti join, repeats keep the lowest
    id, and the ``n`` lowest ids are kept: a cut-off that is found by counting
    (``nth_smallest``), not by a sort. The range starts at ``oversample * n``
    and doubles until ``n`` are found, only the new ids being drawn; it is an
    error only if fewer than ``n`` such sequences exist."""
    # Two scalars (the length range) come back to the driver as literals.
    if bounds is None:
        _, lo, hi = positive_bounds(positives, seq_col)
    else:
        lo, hi = bounds
    if lo is None:
        raise ValueError("no positives")
    known = positives.select(seq_col).distinct()
    width = len(ALPHABET)
    # All sequences of these lengths, less the known ones among them; only
    # short ranges can be too few.
    exist = sum(width**k for k in range(lo, min(hi, lo + 20) + 1))
    if exist < 16 * n + 16 * width**4:
        exist -= known.where(F.length(seq_col).between(lo, hi) & F.col(seq_col).rlike(f"^[{ALPHABET}]*$")).count()
        if exist < n:
            raise ValueError(f"only {exist} sequences are free, {n} were asked for")
    first, ids, firsts = 0, max(1, oversample * n), None
    while True:
        fresh = _random_sequences(spark, first, ids, lo, hi, seed, seq_col).join(known, seq_col, "left_anti")
        if firsts is not None:  # earlier ids win
            fresh = fresh.join(firsts.select(seq_col), seq_col, "left_anti")
        new = pin_table(fresh.groupBy(seq_col).agg(F.min("id").alias("id")), "negatives")
        firsts = new if firsts is None else firsts.unionByName(new)
        if firsts.count() >= n:
            break
        first, ids = ids, ids * 2
    kept = firsts.where(F.col("id") <= nth_smallest(firsts, "id", n, ids)) if n else firsts.limit(0)
    return kept.select(seq_col, F.lit("negative").alias("source"), F.lit(0).alias("label"))


def union_labelled(positives: DataFrame, negatives: DataFrame, seq_col: str = "sequence") -> DataFrame:
    """U4: positives (label 1) + negatives (label 0)."""
    pos = positives.select(seq_col, "source", F.lit(1).alias("label"))
    return pos.unionByName(negatives.select(seq_col, "source", "label"))


def prepare_dataset(spark: SparkSession, positives: DataFrame, n_negatives: int,
                    seed: int = 42, test_percent: int = 20) -> DataFrame:
    """Positives + generated negatives, with a train/test split column."""
    _, lo, hi = positive_bounds(positives)
    labelled = union_labelled(
        positives, generate_negatives(spark, positives, n_negatives, seed, bounds=(lo, hi)))
    return split_dataset(labelled, "sequence", test_percent, seed)


# ------------------------------------------------------------------ C2
def fit_logistic(train: DataFrame, features: str | Column, label: str = "label",
                 max_iter: int = 1000, reg: float | None = None):
    """L2 logistic regression with the objective of the usual
    ``C=1`` formulation: regParam = 1/n, no standardisation, intercept not
    penalised. Returns the fitted MLlib model (``features`` is ARRAY<DOUBLE>
    or a vector column)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    feats = F.col(features) if isinstance(features, str) else features
    data = train.select(array_to_vector(feats).alias("features"), F.col(label).cast("double").alias("label"))
    if reg is None:
        reg = 1.0 / max(data.count(), 1)
    lr = LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=0.0,
                            standardization=False, tol=1e-8, fitIntercept=True)
    return lr.fit(data)


def scorer_from_model(model) -> LinearScorer:
    """A fitted 20-feature composition model as a JVM-side scorer."""
    return LinearScorer(tuple(float(x) for x in model.coefficients.toArray()), float(model.intercept))


def predict(model, df: DataFrame, features: str) -> DataFrame:
    """C3 through MLlib: probability of class 1 and the 0/1 prediction."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    # Columns of the caller keep their names: the model's go by names of their own.
    own = model.copy()
    own.setFeaturesCol("_features").setProbabilityCol("_probability").setRawPredictionCol("_raw")
    out = own.transform(df.withColumn("_features", array_to_vector(features)))
    return out.withColumn("probability_1", vector_to_array("_probability")[1]).drop("_features", "_raw", "_probability")


def penalised_gradient(df: DataFrame, features: str, label: str, weights: Sequence[float], bias: float,
                       reg: float | None = None) -> DataFrame:
    """Certificate of C2: the gradient of mean log loss + reg / 2 * |w|^2
    (``reg`` None: 1 / n) at the given coefficients, ``(feature, gradient)``
    with feature -1 for the intercept, which is not penalised. The objective
    is strictly convex in the weights, so a gradient of zero is the optimum
    and no other is. One pass, one row of sums a task."""
    residual = dot_probability(features, weights, bias) - F.col(label).cast("double")
    rows = df.select(residual.alias("_r"), F.col(features).alias("_x"))
    sums = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("_r").alias("s"),
                    *[F.sum(F.col("_r") * F.col("_x")[i].cast("double")).alias(f"s{i}") for i in range(len(weights))])
    n = F.col("n")
    strength = F.lit(1.0) / n if reg is None else F.lit(float(reg))
    parts = [F.struct(F.lit(-1).alias("feature"), (F.col("s") / n).alias("gradient"))]
    parts += [F.struct(F.lit(i).alias("feature"), (F.col(f"s{i}") / n + strength * F.lit(float(w))).alias("gradient")) for i, w in enumerate(weights)]
    return sums.select(F.inline(F.array(*parts)))


def dot_logit(vec: str | Column, weights: Sequence[float], bias: float = 0.0) -> Column:
    """bias + sum_i w_i x_i, added in the order of the weights."""
    vec = F.col(vec) if isinstance(vec, str) else vec
    z = F.lit(float(bias))
    for i, w in enumerate(weights):
        z = z + vec.getItem(i).cast("double") * F.lit(float(w))
    return z


def dot_probability(vec: str | Column, weights: Sequence[float], bias: float = 0.0) -> Column:
    """C3 pure-SQL twin: sigmoid(bias + sum_i w_i x_i) for ARRAY<FLOAT|DOUBLE>."""
    return _sigmoid(dot_logit(vec, weights, bias))


# ------------------------------------------------------------------ A13-A15
def classification_report(pred: DataFrame, label: str = "label",
                          prediction: str = "prediction") -> DataFrame:
    """Rows per class (0, 1) plus accuracy, macro and weighted
    averages: ``(metric, precision, recall, f1, support)``. 0/0 -> 0."""
    conf = pred.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(
        F.count(F.lit(1)).alias("c"))
    per_class = conf.groupBy().agg(
        *[F.sum(F.when((F.col("y") == k) & (F.col("p") == k), F.col("c")).otherwise(0)).alias(f"tp{k}")
          for k in (0, 1)],
        *[F.sum(F.when(F.col("p") == k, F.col("c")).otherwise(0)).alias(f"pp{k}") for k in (0, 1)],
        *[F.sum(F.when(F.col("y") == k, F.col("c")).otherwise(0)).alias(f"s{k}") for k in (0, 1)],
        F.sum("c").alias("n"),
    )

    def safe(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))

    # Every metric is a function of the one-row count table: build the five
    # report rows from it in one projection (no second pass over the input).
    m = {}
    for k in (0, 1):
        prec = safe(F.col(f"tp{k}"), F.col(f"pp{k}"))
        rec = safe(F.col(f"tp{k}"), F.col(f"s{k}"))
        m[k] = (prec, rec, safe(2 * prec * rec, prec + rec), F.col(f"s{k}"))
    n = F.col("n")
    acc = safe(F.col("tp0") + F.col("tp1"), n)

    def row(name, p, r, f, sup):
        return F.struct(F.lit(name).alias("metric"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), sup.cast("bigint").alias("support"))

    def weighted(i):
        return safe(m[0][i] * m[0][3] + m[1][i] * m[1][3], n)

    rows = [
        row("0", *m[0]), row("1", *m[1]),
        row("accuracy", acc, acc, acc, n),
        row("macro avg", (m[0][0] + m[1][0]) / 2, (m[0][1] + m[1][1]) / 2,
            (m[0][2] + m[1][2]) / 2, n),
        row("weighted avg", weighted(0), weighted(1), weighted(2), n),
    ]
    return per_class.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _score_counts(pred: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score (partial aggregation)."""
    return pred.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))


def roc_curve(pred: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, thresholds descending:
    cumulative counts over the per-score table, computed with the
    distributed running sum (no single-partition window)."""
    from amphora.operators.running import running

    counts = pin_table(_score_counts(pred, label, score), "score-counts")  # read twice
    cum = running(counts, [F.col("score").desc()],
                  {"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))})
    # Class totals are two scalars, used as literals (no join needed).
    t = counts.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    P, N = float(t.P or 0), float(t.N or 0)
    return cum.select(
        F.col("score").alias("threshold"),
        (F.col("fp") / F.lit(N) if N else F.lit(0.0)).alias("fpr"),
        (F.col("tp") / F.lit(P) if P else F.lit(0.0)).alias("tpr"))


def roc_auc(pred: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve, ties count one half:
    sum over scores of pos * (negatives below + neg / 2) / (P * N)."""
    from amphora.operators.running import running

    counts = _score_counts(pred, label, score)
    cum = running(counts, [F.col("score").asc()], {"neg_le": ("sum", F.col("neg"))})
    part = cum.select((F.col("pos") * (F.col("neg_le") - F.col("neg") * 0.5)).alias("a"), "pos", "neg")
    return part.agg(
        F.try_divide(F.sum("a"), F.sum("pos").cast("double") * F.sum("neg")).alias("auc"),
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
