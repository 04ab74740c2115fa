"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import uuid

import public_tokenizers

from affinity.llm.bpe_backtrack import encode_documents
from affinity.llm.common import table
from affinity.llm.exact_dedup import exact_dedup
from affinity.llm.html_mincut import extract_main_text
from affinity.llm.merkle_manifest import tampered_proofs
from affinity.llm.mixing_ipf import mixture
from affinity.llm.phrase_automata import remove_phrases
from affinity.llm.quality_qda import quality_scores
from affinity.llm.quality_rules import quality_rules
from affinity.llm.simhash_ball import simhash_components
from affinity.llm.spelling_fm import spelling_forms
from affinity.llm.token_cache import token_counts
from affinity.llm.url_markov import judge_urls
from affinity.llm.winnowing import compare_with_edits
from affinity.session import checkpoint_dir


def op1_phrase_automata(spark, sf_dir):
    return remove_phrases(table(spark, sf_dir, "documents"), with_text=False)


def op2_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"))


def op3_quality_qda(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_simhash_ball(spark, sf_dir):
    return simhash_components(table(spark, sf_dir, "documents"))


def op5_exact_heavy_split(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents")).drop("copies")


def op6_url_markov(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"))


def op7_token_cache(spark, sf_dir):
    # a cache of its own, so that every call shows the whole work
    cache = f"{checkpoint_dir(spark)}/token-cache-{uuid.uuid4().hex}"
    return token_counts(table(spark, sf_dir, "documents"), cache, public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op8_html_mincut(spark, sf_dir):
    return extract_main_text(table(spark, sf_dir, "pages"), with_blocks=False)


def op9_bpe_backtrack(spark, sf_dir):
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                            ids=False, decoded=False)


def op10_mixing_ipf(spark, sf_dir):
    return mixture(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark, sf_dir):
    return tampered_proofs(table(spark, sf_dir, "documents"))


def op12_winnowing(spark, sf_dir):
    return compare_with_edits(table(spark, sf_dir, "documents"))


def op13_spelling_fm(spark, sf_dir):
    return spelling_forms(table(spark, sf_dir, "documents"))


def queries():
    return {f.__name__: f for f in (op1_phrase_automata, op2_quality_rules, op3_quality_qda, op4_simhash_ball,
                                    op5_exact_heavy_split, op6_url_markov, op7_token_cache, op8_html_mincut,
                                    op9_bpe_backtrack, op10_mixing_ipf, op11_merkle_manifest,
                                    op12_winnowing, op13_spelling_fm)}


def oracle_sql():
    return {"op1_phrase_automata": OP1, "op2_quality_rules": _op2(), "op5_exact_heavy_split": OP5,
            "op11_merkle_manifest": OP11, "op13_spelling_fm": OP13}


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes, bit by bit."""
    return f"""xor(list_reduce([4294967295] || list_transform(range(1, CAST(octet_length(encode({text})) AS BIGINT) + 1),
      lambda i: CAST(('0x' || substr(hex(encode({text})), 2 * i - 1, 2)) AS BIGINT)),
      lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""


OP1 = r"""
WITH d AS (
  SELECT doc_id, [x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
g AS (SELECT s.doc_id, s.i, md5(array_to_string(d.w[s.i:s.i + 34], ' ')) AS h FROM s JOIN d ON s.doc_id = d.doc_id),
r AS (SELECT doc_id, i FROM g WHERE h IN (SELECT h FROM g GROUP BY h HAVING count(*) > 1)),
c AS (SELECT doc_id, list(DISTINCT p) AS cut FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM r) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(len(c.cut), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.kept, CASE WHEN c.cut IS NULL THEN array_to_string(d.w, ' ') END, '')) AS kept_sha256
FROM d LEFT JOIN c ON d.doc_id = c.doc_id
LEFT JOIN (SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS kept
  FROM (SELECT d.doc_id, unnest(d.w) AS word, unnest(range(1, len(d.w) + 1)) AS i FROM d JOIN c ON d.doc_id = c.doc_id) AS p
  LEFT JOIN (SELECT doc_id, unnest(cut) AS i FROM c) AS x ON p.doc_id = x.doc_id AND p.i = x.i
  WHERE x.i IS NULL GROUP BY p.doc_id) AS k ON d.doc_id = k.doc_id
"""

OP5 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""

OP11 = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, n_chars, source, text,
    doc_id IS NOT NULL AND {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 AS hit FROM documents),
f AS (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') AS head, coalesce(strlen(text) || ':' || text, '-') AS tail FROM d),
l AS (SELECT r, doc_id, coalesce('=' || lang, '') AS tree,
    sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen(CAST(n_chars + hit::INT AS VARCHAR)) || ':' || (n_chars + hit::INT), '-') || tail) AS changed FROM f),
t AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM l),
up AS (
  SELECT tree, 0 AS level, pos, leaf AS digest, n FROM t
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM up WHERE n > 1
  GROUP BY tree, level, pos // 2, n),
s AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
high AS (
  SELECT 0 AS level, pos, subroot AS digest, n FROM s
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM high WHERE n > 1 GROUP BY level, pos // 2, n),
steps AS (
  SELECT t.r, a.level, (t.pos >> a.level) % 2 AS side, b.digest FROM t JOIN up AS a ON a.tree = t.tree AND a.pos = t.pos >> a.level AND a.n > 1
  LEFT JOIN up AS b ON b.tree = a.tree AND b.level = a.level AND b.pos = xor(a.pos, 1)
  UNION ALL
  SELECT t.r, 1000 + a.level, (s.pos >> a.level) % 2, b.digest FROM t JOIN s ON s.tree = t.tree JOIN high AS a ON a.pos = s.pos >> a.level AND a.n > 1
  LEFT JOIN high AS b ON b.level = a.level AND b.pos = xor(a.pos, 1)),
p AS (SELECT r, list({{'side': side, 'digest': digest}} ORDER BY level) AS path, coalesce(string_agg(digest, '' ORDER BY level), '') AS beside
  FROM steps GROUP BY r),
fold AS (
  SELECT t.r, t.changed AS digest, p.path FROM t LEFT JOIN p ON t.r = p.r
  UNION ALL
  SELECT r, sha256(CASE WHEN path[1].digest IS NULL THEN digest WHEN path[1].side = 1 THEN path[1].digest || digest
    ELSE digest || path[1].digest END), path[2:] FROM fold WHERE len(path) > 0)
SELECT t.doc_id, t.leaf, s.subroot, high.digest AS root, sha256(coalesce(p.beside, '')) AS proof_sha256,
  fold.digest AS folded_root, fold.digest = high.digest AS verified
FROM t JOIN s ON t.tree = s.tree JOIN high ON high.n = 1 JOIN fold ON fold.r = t.r AND coalesce(len(fold.path), 0) = 0 LEFT JOIN p ON p.r = t.r
"""

OP13 = f"""
WITH RECURSIVE r AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
c AS (SELECT id || ':' || run AS said, run, length(run) AS size, count(*) AS n FROM r WHERE length(run) >= 7 GROUP BY id, run),
h AS (SELECT run, size, n, {_crc32("said")} AS h FROM c),
w AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % size) || substr(run, h % size + 2) ELSE run END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
x AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (
  SELECT a.word, b.word AS near FROM x AS a JOIN x AS b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT x.word, v.word FROM x JOIN v ON x.cut = v.word
  UNION SELECT v.word, x.word FROM x JOIN v ON x.cut = v.word),
b AS (SELECT p.word, count(*) AS n_near, max(v.n) AS form_n FROM p JOIN v ON p.near = v.word GROUP BY p.word),
f AS (
  SELECT v.word, v.n, coalesce(any_value(b.n_near), 0) AS n_near, CASE WHEN any_value(b.form_n) >= 10 * v.n THEN any_value(b.form_n) END AS form_n,
    CASE WHEN any_value(b.form_n) >= 10 * v.n THEN min(o.word) END AS form
  FROM v LEFT JOIN b ON v.word = b.word LEFT JOIN p ON p.word = v.word LEFT JOIN v AS o ON o.word = p.near AND o.n = b.form_n
  GROUP BY v.word, v.n),
t AS (
  SELECT word, word AS root, form AS onward FROM f
  UNION ALL
  SELECT t.word, f.word, f.form FROM t JOIN f ON t.onward = f.word)
SELECT f.word, f.form, t.root, f.n, f.n_near, f.form_n FROM f JOIN t ON t.word = f.word AND t.onward IS NULL
"""


def _op2() -> str:
    """Base counts in one pass, bins and quartiles per group, language and whole, then the fences."""
    names = ("symbols", "capitals", "shouts", "dup_lines", "word_len")
    level = lambda keys, name: f"""
{name} AS (
  SELECT {keys} metric, CAST(any_value(total) AS DOUBLE) AS n, CAST(min(CASE WHEN so_far * 4 >= total THEN top END) AS DOUBLE) AS q1,
    CAST(min(CASE WHEN so_far * 4 >= total * 3 THEN top END) AS DOUBLE) AS q3,
    CAST(sum(c * abs(top - middle)) AS DOUBLE) / CAST(any_value(total) AS DOUBLE) AS away
  FROM (SELECT *, min(CASE WHEN so_far * 2 >= total THEN top END) OVER (PARTITION BY {keys} metric) AS middle
    FROM (SELECT {keys} metric, top, count(*) AS c, sum(count(*)) OVER (PARTITION BY {keys} metric ORDER BY top) AS so_far,
            sum(count(*)) OVER (PARTITION BY {keys} metric) AS total
          FROM tall GROUP BY {keys} metric, top) AS x) AS y
  GROUP BY {keys} metric),"""  # noqa: E731
    blend = lambda x: (f"(own.n * own.{x} + 10::DOUBLE * ((tongue.n * tongue.{x} + 10::DOUBLE * whole.{x}) / (tongue.n + 10::DOUBLE)))"  # noqa: E731
                       f" / (own.n + 10::DOUBLE) AS {x}")
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, chr(1)) AS lang, coalesce(source, chr(1)) AS source, coalesce(text, '') AS t,
    [x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] AS w,
    [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
  FROM documents),
grams AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5),
g AS (SELECT grams.doc_id, i, array_to_string(w[i:i + 4], ' ') AS h FROM grams JOIN d ON grams.doc_id = d.doc_id),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, h) AS c FROM g)
    WHERE c > 1) GROUP BY doc_id),
base AS (
  SELECT d.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals,
    length(t) - length(replace(t, '!', '')) AS n_shouts, len(l) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN r ON d.doc_id = r.doc_id),
m AS (
  SELECT *, n_symbols * 1000 // greatest(word_chars, 1) AS symbols, n_capitals * 1000 // greatest(word_chars, 1) AS capitals,
    n_shouts * 1000 // greatest(word_chars, 1) AS shouts, greatest(n_dup_lines - 1, 0) * 1000 // greatest(n_lines, 1) AS dup_lines,
    word_chars * 10 // greatest(n_words, 1) AS word_len,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM base),
pairs AS (SELECT doc_id, lang, source, unnest([{", ".join(f"{{'metric': '{k}', 'v': CAST({k} AS BIGINT)}}" for k in names)}]) AS e FROM m),
tall AS (
  SELECT doc_id, lang, source, e.metric AS metric, e.v AS v, CASE WHEN e.v < 32 THEN e.v
    ELSE ((((e.v >> (length(bin(e.v)) - 5)) + 1) << (length(bin(e.v)) - 5)) - 1) END AS top
  FROM pairs),{level("lang, source,", "own")}{level("lang,", "tongue")}{level("", "whole")}
q AS (
  SELECT own.lang, own.source, own.metric, {blend("q1")}, {blend("q3")}, {blend("away")}
  FROM own JOIN tongue ON own.lang = tongue.lang AND own.metric = tongue.metric JOIN whole ON own.metric = whole.metric),
ok AS (
  SELECT doc_id, bool_and(v <= q3 + 3::DOUBLE * (q3 - q1 + away) + (1::DOUBLE + q3 / 16::DOUBLE)
    AND (tall.metric <> 'word_len' OR top >= q1 - 3::DOUBLE * (q3 - q1 + away) - (1::DOUBLE + q1 / 16::DOUBLE))) AS fits
  FROM tall JOIN q ON tall.lang = q.lang AND tall.source = q.source AND tall.metric = q.metric GROUP BY doc_id)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  {", ".join(f"CAST({k} AS BIGINT) AS {k}" for k in names)}, base_failed, NOT base_failed AND fits AS kept
FROM m JOIN ok ON m.doc_id = ok.doc_id
"""
