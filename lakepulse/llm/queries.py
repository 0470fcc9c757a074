"""Registered queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from .conversation_trie import op12_conversation_trie
from .fill_middle import op13_fill_in_middle
from .fingerprints import op8_document_fingerprints
from .lm_scoring import op10_lm_scoring
from .media import op6_media_columns
from .minmax import op11_minmax_near_dedup
from .mixing import op9_mix_sources
from .ngram_join import op7_ngram_jaccard_join
from .packing import op4_best_fit_packing
from .quality import op5_quality_classifier
from .substring_dedup import op2_substring_dedup
from .url_filters import op3_url_filters
from .warc import op1_warc


def queries() -> dict:
    every = (op1_warc, op2_substring_dedup, op3_url_filters, op4_best_fit_packing, op5_quality_classifier, op6_media_columns, op7_ngram_jaccard_join, op8_document_fingerprints, op9_mix_sources, op10_lm_scoring, op11_minmax_near_dedup, op12_conversation_trie, op13_fill_in_middle)
    return {f.__name__: f for f in every}


#: DuckDB takes the WARC plan from the table: what a round trip must give back.
WARC = """
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, url, octet_length(body) AS n, sha1(body) AS digest FROM p),
k AS (SELECT digest, n, max(page_id) AS kept FROM d WHERE n >= 1000 GROUP BY ALL)
SELECT page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN kept IS NOT NULL AND page_id IS DISTINCT FROM kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN kept IS NOT NULL AND page_id IS DISTINCT FROM kept THEN kept END AS refers_to, url
FROM d LEFT JOIN k ON d.digest = k.digest AND d.n = k.n
"""

SUBSTRINGS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (SELECT doc_id, s, array_to_string(ws[s:s + 19], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM d)),
late AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM windows) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, i FROM (SELECT doc_id, unnest(range(s, s + 20)) AS i FROM late)),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

#: Links of sets of {n} words, all pairs that share one.
LINKS = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[s:s + {n} - 1], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {n} + 2, 2))) AS s FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r(doc_id, m) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.m)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.m) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY ALL
"""

#: DuckDB cuts whole texts by a regular expression; rebuilt texts must equal the given ones.
FILL_MIDDLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS ws, [CAST('0x' || substr(h, k, 8) AS UBIGINT) FOR k IN [1, 9, 17, 25]] AS r FROM d),
c AS (SELECT *, least(r[1] % (len(ws) + 1), r[2] % (len(ws) + 1)) AS a, greatest(r[1] % (len(ws) + 1), r[2] % (len(ws) + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 90 THEN 'plain' WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM w),
p AS (SELECT *, coalesce(array_to_string(ws[1:a], ''), '') AS prefix, coalesce(array_to_string(ws[a + 1:b], ''), '') AS middle, coalesce(array_to_string(ws[b + 1:], ''), '') AS suffix FROM c)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

#: DuckDB groups whole lists of turns; CRC-32 is reduced bit by bit.
TRIE = """
WITH t AS (SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ts FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
bits AS (SELECT *, list_prepend(4294967295::UBIGINT, flatten([[ascii(c)::UBIGINT, 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split(CAST(conv_id AS VARCHAR), '')])) AS l FROM t),
own AS (SELECT conv_id, ts, xor(list_reduce(l, lambda a, x: xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384::UBIGINT)), 4294967295::UBIGINT) % 6 AS h FROM bits),
r AS (SELECT o.conv_id, list_concat(coalesce(b.ts[1:h], []), o.ts[h + 1:]) AS s FROM own o LEFT JOIN t b ON b.conv_id = o.conv_id - o.conv_id % 100),
p AS (SELECT conv_id, d, s[1:d] AS k, len(s) AS n FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM r)),
n AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) AS longest, (count(*) - 1) * coalesce(length(k[d].t), 0) AS own, string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE n = d) AS ends FROM p GROUP BY k, d),
sub AS (SELECT k[1:e] AS k, e AS d, sum(own) AS saved, count(*) FILTER (WHERE d = longest) AS leaves FROM (SELECT *, unnest(range(d + 1)) AS e FROM n) GROUP BY ALL),
up AS (SELECT k[1:d - 1] AS k, d - 1 AS d, count(*) AS children FROM n WHERE d > 0 GROUP BY ALL)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(children, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM n JOIN sub USING (k, d) LEFT JOIN up USING (k, d) LEFT JOIN n parent ON parent.d = n.d - 1 AND parent.k = n.k[1:n.d - 1]
"""


def links(n: int) -> str:
    return LINKS.replace("{n}", str(n))


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": WARC, "op2_substring_dedup": SUBSTRINGS, "op7_ngram_jaccard_join": links(4), "op11_minmax_near_dedup": f"SELECT *, doc_id = component_id AS kept FROM ({links(3)})", "op12_conversation_trie": TRIE, "op13_fill_in_middle": FILL_MIDDLE}
