"""Deduplication operators against plain Python versions."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from amphora.llm import components, line_dedup, pivots, simhash, substring

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def groups_of(n, links):
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, j in links:
        label[root(i)] = root(j)
    return [root(i) for i in range(n)]


# ------------------------------------------------------------ substring dedup


def passages_removed(rows, window):
    """(id, text) -> n_words, n_removed, kept words: first in order of id and text keeps."""
    seen, out = {}, defaultdict(list)
    for known, doc, text in sorted({(d is not None, d or 0, t or "") for d, t in rows}):
        words, gone = WORDS.findall(text), set()
        for i in range(len(words) - window + 1):
            if seen.setdefault(tuple(words[i : i + window]), (known, doc, text, i)) != (known, doc, text, i):
                gone.update(range(i, i + window))
        out[doc if known else None].append((len(words), len(gone), [w for i, w in enumerate(words) if i not in gone]))
    return out


@pytest.mark.parametrize("table, window", [("documents", 20), ("documents", 3), ("edge", 3), ("edge", 20)])
def test_substring(request, table, window):
    df = request.getfixturevalue(table)
    expected = passages_removed(rows_of(df), window)
    got = substring.remove_repeated(df, window=window)
    assert got.columns == [*df.columns, "n_words", "n_removed", "begins", "ends"]
    got = got.collect()
    assert len(got) == df.count()
    for r in got:
        found = (r["n_words"], r["n_removed"], WORDS.findall(r["text"] or ""))
        # Rows of one id with other texts are in the order of a hash of their texts.
        assert found in expected[r["doc_id"]] or r["doc_id"] == 9
        assert sum(b - a for a, b in zip(r["begins"] or (), r["ends"] or ())) == r["n_removed"]


def test_substring_same_id_other_texts(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, passage), (1, "x " + passage), (1, passage), (2, "y " + passage)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in substring.remove_repeated(df).collect())
    # The two equal rows are judged alike; of the two texts of id 1, one is first.
    assert got in ([(1, 30, 0), (1, 30, 0), (1, 31, 30), (2, 31, 30)], [(1, 30, 30), (1, 30, 30), (1, 31, 0), (2, 31, 30)])


def test_substring_hot_passage(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    df = spark.range(3000).selectExpr("id AS doc_id", f"concat('own', id, ' ', CASE WHEN id % 3 = 0 THEN '{passage}' ELSE '' END) AS text").repartition(7)
    got = Counter((r["n_words"], r["n_removed"]) for r in substring.remove_repeated(df).collect())
    assert got == {(41, 0): 1, (41, 40): 999, (1, 0): 2000}


def test_empty_tables(spark, edge):
    none = edge.limit(0)
    assert substring.remove_repeated(none).collect() == []
    assert simhash.simhash_components(none).collect() == []
    assert line_dedup.line_classes(none).collect() == []
    assert line_dedup.drop_repeated_lines(none).collect() == []
    assert pivots.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


# ------------------------------------------------------------ SimHash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), seed=42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("table", ["documents", "edge"])
def test_simhash(request, spark, table):
    df = request.getfixturevalue(table)
    if table == "documents":  # near copies, too
        df = df.select("doc_id", "text").union(df.selectExpr("doc_id + 100000", "concat(text, ' tail words')"))
    rows = rows_of(df)
    prints = [plain_fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    roots = groups_of(len(rows), links)
    least = defaultdict(lambda: None)
    for (doc, _), root in zip(rows, roots):
        if doc is not None:
            least[root] = doc if least[root] is None else min(least[root], doc)
    expected = Counter((doc, f"{p:016x}", least[root]) for (doc, _), p, root in zip(rows, prints, roots))
    assert Counter(tuple(r) for r in simhash.simhash_components(df).collect()) == expected


@pytest.mark.parametrize("distance, held", [(2, 1 << 21), (4, 1 << 21), (4, 1 << 12)])
def test_ball_links(spark, monkeypatch, distance, held):
    """Clusters, and more variants than a task may hold at once."""
    monkeypatch.setattr(simhash, "HELD", held)
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 20).astype(np.uint64)
    prints = {int(c) for c in centres}
    for c in centres:
        for _ in range(15):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            prints.add(int(c) ^ sum(1 << int(b) for b in flips))
    prints = sorted(prints)
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fingerprint long")
    found = components.components(simhash.ball_links(df, distance))
    got = defaultdict(set)
    for r in found.collect():
        got[r["component"]].add(r["node"] % (1 << 64))
    roots = groups_of(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= distance])
    expected = defaultdict(set)
    for p, root in zip(prints, roots):
        expected[root].add(p)
    assert sorted(map(sorted, got.values())) == sorted(sorted(x) for x in expected.values() if len(x) > 1)


def test_components_long_path_and_star(spark):
    edges = [(i, i + 1) for i in range(1000, 1300)] + [(5, i) for i in range(6, 400)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    got = {r["node"]: r["component"] for r in components.components(df).collect()}
    assert got == {i: 1000 for i in range(1000, 1301)} | {i: 5 for i in range(5, 400)}


# ------------------------------------------------------------ line dedup


def plain_classes(rows, edits, near, exact):
    lines = sorted((d is not None, d or 0, n, x) for d, t in rows for n, x in line_dedup.lines_of((t or "").encode(), exact))
    texts = sorted({x[3] for x in lines})
    long_ = [i for i, t in enumerate(texts) if len(t) >= near]
    pairs = [(i, j) for i in long_ for j in long_ if i < j and abs(len(texts[i]) - len(texts[j])) <= edits]
    # A cheap test that holds for every pair within reach comes before the plain distance.
    bags = {i: Counter(texts[i]) for i in long_}
    links = [(i, j) for i, j in pairs if sum(((bags[i] - bags[j]) | (bags[j] - bags[i])).values()) <= 2 * edits and line_dedup._plain_distance(texts[i], texts[j]) <= edits]
    roots, degree, number, first = groups_of(len(texts), links), Counter(i for x in links for i in x), {t: i for i, t in enumerate(texts)}, {}
    for x in lines:
        first.setdefault(roots[number[x[3]]], x[:3])
    out = Counter()
    for known, doc, n, text in lines:
        f = first[roots[number[text]]]
        out[doc if known else None, n, degree[number[text]], f[1] if f[0] else None, f[2], f == (known, doc, n)] += 1
    return out


@pytest.mark.parametrize("table", ["documents", "edge"])
def test_line_classes(request, spark, table):
    df = request.getfixturevalue(table).select("doc_id", "text")
    if table == "documents":
        df = df.where("doc_id < 60")
        changed = "transform(split(text, '\\n'), x -> if(length(x) > 60, concat(substr(x, 1, 40), '#', substr(x, 42)), x))"
        df = df.union(df.selectExpr("doc_id + 1000", f"array_join({changed}, '\\n')")).union(spark.createDataFrame([(-1, "a line of its own that is long enough 1\na line of its own that is long enough 23")], df.schema))
    got = line_dedup.line_classes(df).collect()
    found = Counter((r["doc_id"], r["line_no"], r["n_links"], r["first_id"], r["first_line_no"], r["kept"]) for r in got)
    assert found == plain_classes(rows_of(df), 2, 32, 8)
    if table == "documents":
        assert sum(r["n_links"] > 0 for r in got) > 100


def test_drop_repeated_lines(spark):
    same, near = "the same line of more than thirty-two bytes", "the same line of more than thirty-two bytes!"
    rows = [(1, f"{same}\nshort\nown line number one", 0), (2, f"{near}\nshort\n\nown line number two", 0), (3, same, 0), (None, None, 0), (4, "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_left_lines int")
    got = {r["doc_id"]: (r["text"], r["n_removed_lines"], r["n_left_lines"]) for r in line_dedup.drop_repeated_lines(df).collect()}
    assert got == {
        1: (rows[0][1], 0, 3), 2: ("short\n\nown line number two", 1, 2), 3: ("", 1, 0), None: (None, 0, 0), 4: ("", 0, 0),
    }


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 4), st.lists(st.tuples(st.binary(max_size=40), st.binary(max_size=40)) | st.text("ab", max_size=30).flatmap(
    lambda s: st.tuples(st.just(s.encode()), st.lists(st.integers(0, 30), max_size=4).map(lambda cut: bytes(c for i, c in enumerate(s.encode()) if i not in cut)))), max_size=20))
def test_banded_distance(edits, pairs):
    got = line_dedup.edits_within([a for a, _ in pairs], [b for _, b in pairs], edits)
    assert got.tolist() == [line_dedup._plain_distance(a, b) <= edits for a, b in pairs]


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 3), st.binary(min_size=12, max_size=60), st.lists(st.tuples(st.sampled_from("ids"), st.integers(0, 60), st.integers(0, 255)), max_size=3))
def test_candidates_are_complete(edits, line, changes):
    other = bytearray(line)
    for kind, at, value in changes[:edits]:
        at = min(at, len(other) - (kind != "i"))
        if kind == "i":
            other.insert(at, value)
        elif kind == "d" and len(other) > 10:
            del other[at]
        else:
            other[at] = value
    lines = list({line, bytes(other)})
    if len(lines) == 2:
        keys, number, probe = line_dedup._key_rows(lines, edits)
        pairs = line_dedup.candidate_pairs(keys, number.astype(np.uint64), line_dedup.histograms(lines)[number], probe, edits)
        assert pairs.tolist() == [[0, 1]]


def grown_classes(rows):
    """Every line with a word; two lines are linked within the edits that the shorter one allows."""
    lines = sorted((d is not None, d or 0, n, x) for d, t in rows for n, x in line_dedup.lines_of((t or "").encode(), 1))
    texts = sorted({x[3] for x in lines}, key=lambda t: (len(t), t))
    bags, links = np.array([np.bincount(np.frombuffer(t, np.uint8), minlength=256) for t in texts]), []
    for i, text in enumerate(texts):
        most = line_dedup.reach(len(text))
        stop = next((j for j in range(i + 1, len(texts)) if len(texts[j]) > len(text) + most), len(texts))
        close = i + 1 + np.flatnonzero(np.abs(bags[i + 1 : stop] - bags[i]).sum(axis=1) <= 2 * most)
        links += [(i, int(j)) for j in close if line_dedup._plain_distance(text, texts[j]) <= most]
    roots, degree, number, first = groups_of(len(texts), links), Counter(i for x in links for i in x), {t: i for i, t in enumerate(texts)}, {}
    for x in lines:
        first.setdefault(roots[number[x[3]]], x[:3])
    out = Counter()
    for known, doc, n, text in lines:
        f = first[roots[number[text]]]
        out[doc if known else None, n, degree[number[text]], f[1] if f[0] else None, f[2], f == (known, doc, n)] += 1
    return out


def test_edits_grow_with_the_line():
    assert [line_dedup.reach(n) for n in (1, 7, 8, 15, 16, 32, 42, 43, 330, 331, 5000)] == [0, 0, 1, 1, 2, 2, 2, 3, 29, 30, 30]
    for n in range(8, 2000):  # pieces fit side by side, one more than the edits
        places, edits = sorted(set(line_dedup._pieces(n)[0][:, 0].tolist())), line_dedup.reach(n)
        size = int(line_dedup.SIZES[line_dedup._size(n)])
        assert len(places) == edits + 1 and all(b - a >= size for a, b in zip(places, [*places[1:], n]))


@pytest.mark.parametrize("table", ["documents", "edge"])
def test_classes_of_every_line(request, spark, table):
    df = request.getfixturevalue(table).select("doc_id", "text")
    if table == "documents":
        df = df.where("doc_id < 20")
        words = "transform(split(text, '\\n'), x -> if(length(x) > 60, concat(substr(x, 1, 40), '#other#', substr(x, 45)), concat(x, ',')))"
        df = df.union(df.selectExpr("doc_id + 1000", f"array_join({words}, '\\n')"))
    planted = ["Les.", "Heti eror anesti.\nLes.", "Heti, eror anesti.", "un été passé à la mer près de là-bas, côté forêt, sans arrêt", "un ete passe a la mer pres de la-bas, cote foret, sans arret"]
    df = df.union(spark.createDataFrame(list(enumerate(planted, 7000)), df.schema))
    edits, near, exact = line_dedup.EVERY_LINE
    got = line_dedup.line_classes(df, edits=edits, near_bytes=near, exact_bytes=exact).collect()
    found = Counter((r["doc_id"], r["line_no"], r["n_links"], r["first_id"], r["first_line_no"], r["kept"]) for r in got)
    assert found == grown_classes(rows_of(df))
    assert (7001, 1, 0, 7000, 0, False) in found and (7002, 0, 1, 7001, 0, False) in found
    if table == "documents":
        assert sum(r["n_links"] > 0 for r in got) > 50


def test_op5_takes_every_line(spark, tmp_path):
    from amphora.llm import queries

    spark.createDataFrame([(1, "Les.\nHeti eror anesti."), (2, "Les.\nHeti, eror anesti.")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r["doc_id"], r["line_no"], r["kept"]) for r in queries.op5_line_dedup(spark, str(tmp_path)).collect())
    assert got == [(1, 0, True), (1, 1, True), (2, 0, False), (2, 1, False)]


def test_lines_are_not_named_more_often_in_more_turns():
    """What tells a line's keys in a further turn is a fraction of a byte of text; its histograms came again for every bucket that more text brought."""
    rng = random.Random(7)
    lines = list({" ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(rng.randint(2, 120))).encode() for _ in range(1500)})
    bytes_of, named = {}, {}
    for turns in (1, 16):
        rows = list(line_dedup._window_parts(lines, 12, turns))
        bytes_of[turns] = sum(len(x) for _, _, parts in rows for x in parts)
        named[turns] = sorted((bucket, parts[0]) for bucket, turn, parts in rows if turn == line_dedup.NAMES)
        keys = Counter((bucket, turn) for bucket, turn, _ in rows if turn != line_dedup.NAMES)
        assert set(keys.values()) == {1} and {turn for _, turn in keys} == set(range(turns))
    assert named[1] == named[16] and sum(len(ids) // 8 for _, ids in named[1]) < 3 * len(lines)
    assert bytes_of[16] < 1.25 * bytes_of[1] < 2.5 * sum(map(len, lines))


@pytest.mark.parametrize("held", [1 << 20, 64])
def test_turns_give_the_same_pairs(monkeypatch, held):
    rng = random.Random(11)
    lines = [" ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(rng.randint(2, 90))).encode() for _ in range(60)]
    lines += [x[:5] + b"#" + x[5:] for x in lines]
    lines += [b"a" * n for n in range(8, 300, 7)]  # many equal keys
    expected = {tuple(sorted((line_dedup.line_key(a)[:8], line_dedup.line_key(b)[:8]))) for a, b in zip(lines, lines[60:120])}
    monkeypatch.setattr(line_dedup, "HELD_KEYS", held)
    found = {}
    for turns in (1, 2, 16):
        by, names, out = {}, None, set()
        for piece in (lines, lines[:100], lines):  # two tasks with the same lines, one with some of them
            for bucket, turn, parts in line_dedup._window_parts(piece, 12, turns):
                by.setdefault((bucket, turn), []).append(parts)
        for bucket, turn in sorted(by):
            if turn == line_dedup.NAMES:
                names = line_dedup._named_lines(by[bucket, turn])
            else:
                out |= set(map(tuple, line_dedup._turn_pairs(names, by[bucket, turn]).tolist()))
        found[turns] = out
    assert found[1] >= {tuple(sorted(int.from_bytes(x, "little") for x in pair)) for pair in expected}
    assert found[1] == found[2] == found[16]


def test_classes_in_many_turns(spark, monkeypatch):
    words = ["heti", "eror", "anesti", "lavo", "demu", "sirta", "okel", "pranu"]
    rng = random.Random(5)
    lines = [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(150)]
    rows = [(i, "\n".join([*rng.sample(lines, 4), rng.choice(lines)[1:]])) for i in range(60)]
    df = spark.createDataFrame([*rows, (None, lines[0]), (70, None)], "doc_id long, text string").repartition(4)
    edits, near, exact = line_dedup.EVERY_LINE
    monkeypatch.setattr(line_dedup, "TURN_BYTES", 1 << 10)
    got = line_dedup.line_classes(df, edits=edits, near_bytes=near, exact_bytes=exact).collect()
    assert Counter((r["doc_id"], r["line_no"], r["n_links"], r["first_id"], r["first_line_no"], r["kept"]) for r in got) == grown_classes(rows_of(df))


@settings(max_examples=100, deadline=None)
@given(st.integers(8, 900), st.randoms(use_true_random=False))
def test_windows_are_complete(length, random):
    line = bytes(random.choices(b"abcdefgh ", k=length))
    other = bytearray(line)
    for _ in range(random.randint(1, line_dedup.reach(length))):
        at, kind = random.randrange(len(other)), random.choice("ids")
        other[at : at + (kind != "i")] = b"" if kind == "d" else b"#"
    pair = [line, bytes(other)]
    if line != pair[1] and min(map(len, pair)) >= 8 and line_dedup._plain_distance(*pair) <= line_dedup.reach(min(map(len, pair))):
        keys, owner, probe, _ = line_dedup.window_rows(pair)
        lengths = np.array(list(map(len, pair)))
        found = line_dedup.window_pairs(keys.astype(np.uint32), owner, probe, np.arange(2, dtype=np.uint64), line_dedup.histograms(pair), lengths)
        assert found.tolist() == [[0, 1]] and line_dedup.within_reach(pair[:1], pair[1:]).tolist() == [True]


def test_few_keys_a_byte_and_bounded_histograms():
    rng = random.Random(3)
    lines = list({" ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(n)).encode() for n in range(5, 260)})
    keys, owner, role, _ = line_dedup.window_rows(lines)
    # Every window of a line was a key: more than one a byte.
    assert len(keys) < 0.5 * sum(map(len, lines))
    assert set(owner.tolist()) == set(range(len(lines))) and (np.bincount(owner[role != line_dedup.INDEXED]) > 0).all()
    changed = []
    for line in lines:
        other = bytearray(line)
        for _ in range(line_dedup.reach(len(line))):
            at, kind = rng.randrange(len(other)), rng.choice("ids")
            other[at : at + (kind != "i")] = b"" if kind == "d" else b"#"
        changed.append(bytes(other))
    a, b = line_dedup.bigram_histograms(lines), line_dedup.bigram_histograms(changed)
    most = np.array([line_dedup.reach(len(x)) for x in lines])
    assert (line_dedup.bigram_distance(a, b) <= 4 * most).all()
    assert (line_dedup.bigram_distance(a, a[::-1]) > 4 * most).mean() > 0.9
    assert (line_dedup.bigram_distance(line_dedup.bigram_histograms([b"", b"x", b"xy"]), line_dedup.bigram_histograms([b"", b"y", b"xz"])) == [0, 0, 2]).all()


# ------------------------------------------------------------ vectors


def test_near_vectors(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(600, 16))
    near = base[:150] + rng.normal(size=(150, 16)) * 0.05
    cluster = base[7] + rng.normal(size=(250, 16)) * 0.04  # a quarter of all
    x = np.concatenate([base, near, cluster, base[:20] * 3, base[5:8]]).astype(np.float32)
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    odd = [(5000, None), (5001, []), (5002, [0.0] * 16), (5003, [None] + [1.0] * 15), (5004, [float("nan")] * 16), (5005, [float("inf")] + [1.0] * 15),
           (5006, [1.0, 2.0]), (5007, [2.0, 4.0]), (5008, [1.0, -2.0]), (3, rows[3][1]), (None, rows[4][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + odd], "vec_id long, embedding array<float>, n_links string")
    got = pivots.near_vectors(df, block=64)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    found = Counter(tuple(r) for r in got.collect())
    good = rows + odd[6:]
    unit = [np.array(v) / np.linalg.norm(v) for _, v in good]
    links = [(i, j) for i in range(len(good)) for j in range(i) if len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95]
    roots, degree = groups_of(len(good), links), Counter(k for x in links for k in x)
    least = {}
    for (i, _), r in zip(good, roots):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    expected = Counter((i, degree[k], least[r], i == least[r]) for k, ((i, _), r) in enumerate(zip(good, roots)))
    expected += Counter((i, 0, i, True) for i, _ in odd[:6])
    missed = sum((expected - found).values())
    assert missed <= 0.02 * len(rows), missed
    degrees = {i: degree[k] for k, (i, _) in enumerate(good)}
    assert all(n <= degrees.get(i, 0) for i, n, _, _ in found)
    assert pivots.recall(got.where("vec_id < 5000"), df.where("vec_id < 5000"), every=10) >= 0.98
    # An index that asks for a single pivot in common finds every link.
    exact = Counter(tuple(r) for r in pivots.near_vectors(df, nearest=16, shared=1, block=64).collect())
    assert exact == expected


def test_recall_leaves_out_equal_vectors(spark):
    """Fifty copies of a vector are linked without the index; of its one other link none is found."""
    df = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(50)] + [(50, [1.0, 0.01]), (51, [0.0, 1.0])], "vec_id long, embedding array<float>")
    counts = lambda missed: spark.createDataFrame([(i, 50 - missed) for i in range(50)] + [(50, 50 - 50 * missed), (51, 0)], "vec_id long, n_links long")
    assert pivots.recall(counts(0), df, every=1) == 1.0
    assert pivots.recall(counts(1), df, every=1) == 0.0


def test_recall_on_table(spark):
    """The given vectors have no links; each gets three planted ones at cosine 0.951 to 0.99."""
    import numpy as np

    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    assert pivots.recall(pivots.near_vectors(df), df, every=1) is None
    rng, rows = np.random.default_rng(5), []
    for r in df.collect():
        v = np.array(r["embedding"], dtype=np.float64)
        for k, cosine in enumerate((0.951, 0.96, 0.99)):
            side = rng.normal(size=len(v))
            side -= side @ v / (v @ v) * v
            rows.append((10_000 * (k + 1) + r["vec_id"], (v + side / np.linalg.norm(side) * np.linalg.norm(v) * np.sqrt(1 / cosine**2 - 1)).tolist()))
    both = df.withColumn("embedding", F.col("embedding").cast("array<double>")).unionAll(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = pivots.near_vectors(both)
    share = pivots.recall(found, both, every=50)
    print("recall of planted links:", share, "of all:", pivots.recall(found, both, every=1))
    assert share >= 0.9
