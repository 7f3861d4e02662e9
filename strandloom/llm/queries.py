"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import ann, bpe, decontam, filter_audit, lang_id, lm, ngram_jaccard, packing, quality, secrets, token_count, token_store, whitening
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "byte_bpe_50k.json"


def op1_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.join(table(spark, sf_dir, "documents"), n=3, part=90, whole=100)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.held_out(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.round_trip(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.held_out(spark, table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.checksums(packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), window=1024, end_id=0))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    found = {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}
    return dict(sorted(found.items(), key=lambda kv: int(kv[0][2:].split("_")[0])))


_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format('text')}, '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) END AS grams FROM d),
s AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM g),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
reached AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x)
SELECT doc_id, len(grams) AS n_shingles, least(doc_id, coalesce((SELECT min(y) FROM reached WHERE x = doc_id), doc_id)) AS component_id, (SELECT count(*) FROM links WHERE x = doc_id) AS n_links FROM g"""

_OP10_WORDS = rf"regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP10 = f"""WITH d AS (SELECT doc_id, {_OP10_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_OP10_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[j : j + n - 1], ' ') AS k FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS j FROM sized)),
places AS (SELECT doc_id, n, j, array_to_string(w[j : j + n - 1], ' ') AS k FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS j FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS (SELECT doc_id, n, j, item_id FROM places JOIN windows USING (n, k)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + n)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""


# every order of the filters is applied to each kind of document, and the first filter that it fails takes it
OP12 = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false)::INT AS good, coalesce(toxic, false)::INT AS toxic,
 [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text), regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > first, false)] AS fails
 FROM w LEFT JOIN marks USING (doc_id)),
kinds AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
met AS (SELECT *, [fails[ascii(substr(filter_order, i, 1)) - 64] for i in range(1, 6)] AS seen FROM kinds, orders),
steps AS (SELECT *, coalesce(list_position(seen, true), 6) AS out, unnest([1, 2, 3, 4, 5]) AS step FROM met),
counted AS (SELECT part, filter_order, step, sum(n) FILTER (out > step) AS kept, sum(n) FILTER (out = step) AS removed, sum(n) FILTER (seen[step] AND out < step) AS redundant,
 sum(n) FILTER (seen[step] AND len([x for x in seen if x]) = 1) AS unique_fails, sum(n * good) FILTER (out = step) AS good_lost, sum(n * toxic) FILTER (out = step) AS toxic_lost FROM steps GROUP BY part, filter_order, step)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
 coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, (sum(coalesce(removed, 0)) OVER (PARTITION BY part, substr(filter_order, step, 1)))::BIGINT AS shapley FROM counted"""


def oracle_sql() -> dict[str, str]:
    """Of the others, merges, learned models and digests over code-point spans are beyond SQL, and approximate
    neighbours differ from exact ones: tests/llm holds them against brute force."""
    return {"op2_ngram_jaccard": OP2, "op10_decontamination": OP10, "op12_filter_audit": OP12}
