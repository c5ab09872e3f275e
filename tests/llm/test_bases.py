"""The contracts' bases of quality and secrets in SQL, and the posterior computed document by document."""

import math

import pytest

from tests.compare import connection
from ticketloom.llm import quality, queries

COUNTS_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t
), w AS (
  SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM t WHERE len(words) >= 3
), windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w FROM w
), again AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(length(array_to_string(words, '')), 0) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(words) < 50 OR 100 * coalesce(c.n, 0) > 50 * len(words) AS base_failed
FROM t JOIN lines USING (doc_id) LEFT JOIN covered c USING (doc_id)
"""

SECRETS_SQL = r"""
SELECT doc_id,
  len(list_filter(regexp_extract_all(text, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1), lambda x: length(x) >= 6)) AS n_assign,
  len(list_filter(regexp_extract_all(text, 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 20)) AS n_access,
  len(list_filter(regexp_extract_all(text, '[0-9a-f]+'), lambda x: length(x) >= 24)) AS n_hex
FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
"""


@pytest.mark.parametrize(("query", "sql"), [("op2_weak_supervision", COUNTS_SQL), ("op10_secret_scan", SECRETS_SQL)])
def test_base_in_sql(spark, sf, query, sql):
    cur = connection(sf).execute(sql)
    names = [d[0] for d in cur.description]
    want = sorted(tuple(map(int, r)) for r in cur.fetchall())
    assert sorted(tuple(int(r[c]) for c in names) for r in queries.QUERIES[query](spark, sf).collect()) == want


def test_posterior_document_by_document(spark, sf):
    """Expectation-maximisation over documents, with products of rates instead of patterns and logarithms."""
    rows = queries.QUERIES["op2_weak_supervision"](spark, sf).collect()
    names = [f"vote_{n}" for n in quality.RULES]
    cast = {r["doc_id"]: [r[n] for n in names] for r in rows}
    learned_from = [cast[r["doc_id"]] for r in rows if not r["base_failed"]]
    prior, good, bad = 0.85, [0.002] * len(names), [0.15] * len(names)  # rates of bad votes among votes

    def posterior(vote):
        a, b = prior, 1 - prior
        for v, g, x in zip(vote, good, bad, strict=True):
            a, b = a * {1: 1 - g, -1: g, 0: 1}[v], b * {1: 1 - x, -1: x, 0: 1}[v]
        return a / (a + b)

    for _ in range(200):
        p = [posterior(v) for v in learned_from]
        new_good, new_bad = [], []
        for k in range(len(names)):
            votes = [(v[k], q) for v, q in zip(learned_from, p, strict=True) if v[k]]
            new_good.append(min((sum(q for v, q in votes if v < 0) + 0.002) / (sum(q for _, q in votes) + 1), 0.02))
            new_bad.append(min(max((sum(1 - q for v, q in votes if v < 0) + 0.15) / (sum(1 - q for _, q in votes) + 1), new_good[-1]), 0.98))
        prior, good, bad = (1 + sum(p)) / (2 + len(p)), new_good, new_bad
    for r in rows:
        assert math.isclose(r["p_good"], posterior(cast[r["doc_id"]]), abs_tol=1e-5)
        assert r["kept"] == (not r["base_failed"] and r["p_good"] >= 0.5)
