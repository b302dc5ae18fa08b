"""DuckDB SQL of the queries that SQL can express.

Not here, as SQL has no such functions: token ids (op1, op3, op4, op8), XXH64
fingerprints (op6), hashed samples (op7). Tests hold those against plain
Python versions.
"""

WORDS = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"

OP2 = """
WITH RECURSIVE own AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM own a JOIN own b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON least.a = vec_id
"""

OP9 = f"""
WITH own AS (
  SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), spots AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM own
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS often FROM spots
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE often > 1 GROUP BY doc_id
), measured AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, len(lines) AS n_lines,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(text, '[^!]', '', 'g')) AS n_marks
  FROM own LEFT JOIN covered USING (doc_id)
), judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 3 * n_words OR word_chars > 12 * n_words OR 10 * n_symbols > n_words
            OR 2 * n_upper > word_chars OR 2 * n_marks > n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM judged
"""

OP10 = f"""
WITH own AS (SELECT doc_id, {WORDS} AS w FROM documents),
spots AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM own),
windows AS (SELECT doc_id, i, row_number() OVER (PARTITION BY list_slice(w, i, i + 19) ORDER BY doc_id, i) AS nth FROM spots),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM windows, (SELECT unnest(range(0, 20)) AS k) WHERE nth > 1),
left_over AS (
  SELECT doc_id, p.i, w[p.i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM own) p ANTI JOIN gone USING (doc_id, i)
), kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS words FROM left_over GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM own LEFT JOIN kept USING (doc_id)
"""

SQL: dict[str, str] = {"op2_pivot_index": OP2, "op9_quality": OP9, "op10_substring": OP10}
