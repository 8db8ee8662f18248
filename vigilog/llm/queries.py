"""The registered queries of this subpackage, each on its whole table, and the same as SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vigilog.llm.byte_bpe import round_trip
from vigilog.llm.decontamination import contained_items
from vigilog.llm.kd_shards import shard_digests
from vigilog.llm.kneser_ney import language_scores
from vigilog.llm.main_text import extracted
from vigilog.llm.near_duplicates import near_duplicates
from vigilog.llm.phrases import collocations
from vigilog.llm.quality_classifier import quality_scores
from vigilog.llm.quality_rules import quality_verdicts
from vigilog.llm.ranked_search import ranked
from vigilog.llm.shared import table
from vigilog.llm.source_mix import mixed_sizes
from vigilog.llm.token_files import token_digests
from vigilog.llm.url_rules import url_verdicts


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"), order=3)


def kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_digests(table(spark, sf_dir, "documents"), shards=40)


def rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents")).drop("rejected_by")


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


def minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_sizes(table(spark, sf_dir, "documents"))


def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": quality_classifier,
    "op2_kneser_ney": language_model,
    "op3_kd_tree_shards": kd_tree_shards,
    "op4_rans_token_files": rans_token_files,
    "op5_quality_rules": quality_rules,
    "op6_url_rules": url_rules,
    "op7_main_text": main_text,
    "op8_near_duplicates": minhash_near_duplicates,
    "op9_byte_bpe": byte_level_bpe,
    "op10_benchmark_decontamination": benchmark_decontamination,
    "op11_source_mix": source_mix,
    "op12_ranked_search": ranked_search,
    "op13_phrase_collocations": phrase_collocations,
}

#: The words, lines and thresholds are those of ``quality_rules``.
_RULES_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x : x <> '') AS words,
        list_filter(string_split(t, chr(10)), lambda x : regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT r, i, array_to_string(words[i:i + 4], ' ') AS gram FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
h AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT r, sum(least(5, coalesce(lead_i - i, 5))) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS lead_i FROM h)
        GROUP BY r),
s AS (SELECT doc_id, t, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines FROM w LEFT JOIN c USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed
    OR n_symbols > 0.25 * n_words OR length(regexp_replace(t, '[^!]', '', 'g')) > 0.25 * n_words
    OR length(regexp_replace(t, '[^A-Z]', '', 'g')) > length(regexp_replace(t, '[^a-z]', '', 'g'))
    OR word_chars > 25 * n_words OR word_chars < 2 * n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM b
"""

_SHINGLES_SQL = r"""
SELECT id, CASE WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i : array_to_string(words[i:i + 4], ' '))) END AS grams
FROM (SELECT id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x : x <> '') AS words FROM ({source})) WHERE len(words) > 0
"""

_NEAR_SQL = f"""
WITH RECURSIVE s AS ({_SHINGLES_SQL.format(source="SELECT doc_id AS id, text FROM documents")}),
k AS (SELECT md5(array_to_string(list_sort(grams), chr(10))) AS k, min(id) AS id, any_value(grams) AS grams FROM s GROUP BY 1),
g AS (SELECT id, len(grams) AS n, unnest(grams) AS gram FROM k),
p AS (SELECT a.id AS a, b.id AS b FROM g a JOIN g b ON a.gram = b.gram AND a.id < b.id
    GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
reach AS (SELECT id AS a, id AS b FROM k UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
comp AS (SELECT a, min(b) AS component FROM reach GROUP BY a),
m AS (SELECT s.id, len(s.grams) AS n, comp.component FROM s JOIN k ON md5(array_to_string(list_sort(s.grams), chr(10))) = k.k
    JOIN comp ON comp.a = k.id)
SELECT d.doc_id, coalesce(m.n, 0)::BIGINT AS n_shingles, coalesce(m.component, d.doc_id) AS component_id,
    d.doc_id = coalesce(m.component, d.doc_id) AS kept FROM documents d LEFT JOIN m ON m.id = d.doc_id
"""

_CONTAINED_SQL = f"""
WITH d AS ({_SHINGLES_SQL.format(source="SELECT doc_id AS id, text FROM documents")}),
i AS ({_SHINGLES_SQL.format(source="SELECT item_id AS id, text FROM benchmark")}),
dg AS (SELECT id, unnest(grams) AS gram FROM d), ig AS (SELECT id, len(grams) AS n, unnest(grams) AS gram FROM i)
SELECT dg.id AS doc_id, ig.id AS item_id, count(*)::BIGINT AS n_shared, ig.n::BIGINT AS n_item
FROM dg JOIN ig USING (gram) GROUP BY dg.id, ig.id, ig.n HAVING 100 * count(*) >= 75 * ig.n
"""

_MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(concat_ws(' ', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))), 1, 15))::BIGINT AS key FROM documents),
s AS (SELECT source, sum(size) AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][i % 3 + 1] AS w, sum(n) OVER () AS total FROM s),
o AS (SELECT *, sum(w) OVER () AS ws, coalesce(sum(3 * n) OVER a, 0) AS used, coalesce(sum(w) OVER a, 0) AS gone FROM w
    WINDOW a AS (ORDER BY n::DOUBLE / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, 3 * n * (ws - gone) <= w * (total - used) AS capped FROM o),
t AS (SELECT *, CASE WHEN capped THEN (3 * n)::DOUBLE ELSE w::DOUBLE * (total - coalesce(sum(3 * n) FILTER (capped) OVER (), 0))::DOUBLE
    / (sum(w) FILTER (NOT capped) OVER ())::DOUBLE END AS target FROM c),
r AS (SELECT source, n, target, CASE WHEN n > 0 THEN floor(target / n)::BIGINT ELSE 0 END AS copies FROM t),
x AS (SELECT doc_id, size, n, target, copies, target - copies * n AS rest,
    sum(size) OVER (PARTITION BY d.source ORDER BY key ROWS UNBOUNDED PRECEDING) - size AS before
    FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, n::BIGINT AS source_size, target, size * (copies + CASE WHEN before < rest AND size < 2 * (rest - before) THEN 1 ELSE 0 END) AS taken FROM x
"""

_SEARCH_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
i AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark),
k AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_words FROM d WHERE len(t) > 0),
q AS (SELECT i, term, count(*) AS qtf FROM (SELECT i, unnest(t) AS term FROM i) GROUP BY ALL),
p AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, k GROUP BY term, n_docs),
m AS (SELECT r, doc_id, 75 + (25 * len(t) * n_docs) // n_words AS m FROM d, k),
s AS (SELECT i, r, m.doc_id, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT i.item_id, rank::INT AS rank, o.doc_id, score FROM o JOIN i USING (i) WHERE rank <= 20
"""

_PHRASES_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i : array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM p, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS a, string_split(phrase, ' ') AS w FROM g GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, phrase, w, k, a, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
s AS (SELECT c.lang, c.phrase, c.k, c.a, cut, x.a AS l, y.a AS r, (1000000 * c.a * c.a) // (x.a * y.a) AS score FROM c
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:c.k], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
h AS (SELECT lang, phrase, max(a) AS a FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM f WHERE k = 3)
    GROUP BY ALL),
o AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank FROM b
    LEFT JOIN h ON h.lang = b.lang AND h.phrase = b.phrase WHERE h.a IS NULL OR 100 * h.a < 50 * b.a)
SELECT lang, rank, phrase, o.a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM o JOIN n USING (lang) WHERE rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op5_quality_rules": _RULES_SQL,
    "op8_near_duplicates": _NEAR_SQL,
    "op10_benchmark_decontamination": _CONTAINED_SQL,
    "op11_source_mix": _MIX_SQL,
    "op12_ranked_search": _SEARCH_SQL,
    "op13_phrase_collocations": _PHRASES_SQL,
}
