"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from .ann import op1_nn_descent
from .bpe import op3_byte_bpe
from .langid import op12_string_kernel
from .lexical import TERM, op11_shared_search
from .minhash import op7_minhash
from .packing import op2_best_fit_packing
from .pagetext import op8_html_blocks
from .prefix_trie import op13_prefix_trie
from .quality import op6_quality_rules
from .secrets import op4_secrets
from .slots import op10_virtual_slots
from .toxicity import op5_toxicity
from .urlgraph import op9_url_graph

QUERIES = {
    f.__name__: f
    for f in (
        op1_nn_descent,
        op2_best_fit_packing,
        op3_byte_bpe,
        op4_secrets,
        op5_toxicity,
        op6_quality_rules,
        op7_minhash,
        op8_html_blocks,
        op9_url_graph,
        op10_virtual_slots,
        op11_shared_search,
        op12_string_kernel,
        op13_prefix_trie,
    )
}
_OP7 = """WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))) END AS s
  FROM w),
g AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, l.v FROM reach r JOIN links l ON r.c = l.u)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.c) AS component_id, s.doc_id = min(r.c) AS kept
FROM s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.s"""


_OP11 = f"""WITH q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS t
  FROM benchmark),
d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS t
  FROM documents),
f AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY doc_id, t),
n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM f GROUP BY doc_id),
g AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM n),
w AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, g GROUP BY t, nn),
s AS (
  SELECT item_id, doc_id, CAST(sum(w.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll)))) AS BIGINT) AS score
  FROM q JOIN f USING (t) JOIN w USING (t) JOIN n USING (doc_id), g GROUP BY item_id, doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50"""

_OP13 = r"""WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({'role': role, 'text': text} ORDER BY i) AS turns FROM t GROUP BY c),
crc AS (
  SELECT c, turns, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS BIGINT)) ELSE v >> 1 END))) % 4 AS h
  FROM own),
built AS (
  SELECT crc.c, list_concat(coalesce(base.turns, [])[1 : crc.h], crc.turns[crc.h + 1 :]) AS s
  FROM crc LEFT JOIN own base ON base.c = crc.c - crc.c % 20),
m AS (SELECT c, d, s[1 : d] AS p, d = len(s) AS ends FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM built)),
nodes AS (
  SELECT d, p, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256,
         CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(list_filter(string_split_regex(p[d].text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) END AS saved
  FROM m GROUP BY d, p),
kids AS (SELECT d - 1 AS d, p[1 : d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
full_nodes AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.d = nodes.d AND kids.p = nodes.p),
paths AS (SELECT d AS below, p, saved, n_children, unnest(range(0, d + 1)) AS d FROM full_nodes),
trees AS (SELECT d, p[1 : d] AS p, sum(saved) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves FROM paths GROUP BY 1, 2)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, trees.leaves AS n_leaves,
       CAST(trees.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN trees ON trees.d = f.d AND trees.p = f.p
LEFT JOIN nodes up ON up.d = f.d - 1 AND up.p = f.p[1 : f.d - 1]"""

#: The others fit models, search graphs, tokenise or hash with functions that DuckDB lacks.
ORACLE: dict[str, str] = {"op7_minhash": _OP7, "op11_shared_search": _OP11, "op13_prefix_trie": _OP13}
