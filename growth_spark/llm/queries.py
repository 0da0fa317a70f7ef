"""Registered queries of the corpus operators: each applies its operator to its whole table.

The operators give texts, spans and lists; the queries derive the digest columns from them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bit_clusters, conversation_repair, decontaminate, html_text, language, near_dedup, personal_data, quality, scaled_sketch, sentencepiece_wfst, substring_dedup, suffix_dedup, token_counts


def tokenizer(name: str) -> str:
    """Where a public tokenizer file lies on this machine (and on every executor)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.predict(docs, language.learn(docs.filter(~language.held_out())))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", sha256(F.col("text")).alias("kept_sha256"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.size("hits").cast("bigint")
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        sha256(ids).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def op6_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judge(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("rate", 6).alias("rate"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.cluster(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_wfst.round_trip(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", sha256(F.col("kept")).alias("kept_sha256"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = personal_data.find(docs, personal_data.train(docs))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    # Base spans come in the listed order; the others are put in it.
    kinds = F.array(*map(F.lit, (*personal_data.KINDS, *personal_data.EXTRA)))
    keyed = F.transform(F.concat("base", "more"), lambda s: F.struct(F.array_position(kinds, s["kind"]).alias("at"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    found_kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.filter(found_kinds, lambda x: x == F.lit(k))).cast("bigint").alias(f"n_{k}") for k in personal_data.KINDS]  # noqa: B023
    return found.select("doc_id", *counts, sha256(joined(F.col("base"))).alias("base_sha256"), joined(F.array_sort(keyed)).alias("spans"))


def op11_bit_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_clusters.cluster(table(spark, sf_dir, "embeddings")).drop("centroid")


def op12_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled_sketch.edited(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_text,
        op2_token_counts,
        op3_language,
        op4_substring_dedup,
        op5_decontaminate,
        op6_host_quality,
        op7_near_dedup,
        op8_sentencepiece,
        op9_suffix_dedup,
        op10_personal_data,
        op11_bit_clusters,
        op12_scaled_sketch,
        op13_conversation_repair,
    )
}

def clusters_sql(rounds: int = bit_clusters.ROUNDS) -> str:
    """Each round's vectors by centroid and its new centroids, written out; floor(sum / n) by the remainder."""
    nearest = "SELECT r, c, d FROM (SELECT r, c, d, row_number() OVER (PARTITION BY r ORDER BY d, c) AS k FROM (SELECT e.r, k.c, (list_dot_product(e.v, e.v) - 2 * list_dot_product(e.v, k.v) + list_dot_product(k.v, k.v))::BIGINT AS d FROM e, {centroids} AS k)) WHERE k = 1"
    steps = ""
    for i in range(rounds):
        steps += f"""a{i} AS ({nearest.format(centroids=f"c{i}")}),
s{i} AS (SELECT c, list(m ORDER BY i) AS v FROM (SELECT c, i, ((s - ((s % n) + n) % n) // n)::DOUBLE AS m FROM (SELECT c, i, sum(e.v[i])::BIGINT AS s, count(*) AS n FROM a{i} JOIN e USING (r), range(1, 65) AS t(i) GROUP BY c, i)) GROUP BY c),
c{i + 1} AS (SELECT c, coalesce(s{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN s{i} USING (c)),
"""
    return f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v FROM e QUALIFY c < {bit_clusters.K}),
{steps}z AS ({nearest.format(centroids=f"c{rounds}")})
SELECT vec_id, c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(list_transform(k.v, lambda x: x::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM z JOIN e USING (r) JOIN c{rounds} AS k USING (c)
"""


ORACLE_SQL: dict[str, str] = {
    "op11_bit_clusters": clusters_sql(),
    "op4_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50)),
f AS (SELECT g, min(doc_id) AS first FROM x GROUP BY g),
r AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM x JOIN f USING (g) WHERE first < doc_id),
a AS (SELECT doc_id, p, w[p] AS word FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS p FROM d WHERE len(w) > 0)),
k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept FROM a ANTI JOIN r USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
""",
    "op9_suffix_dedup": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, ''))::BIGINT AS n FROM documents),
x AS (SELECT doc_id, i, substring(h, 2 * i + 1, 200) AS g FROM (SELECT doc_id, h, unnest(generate_series(0, n - 100)) AS i FROM d WHERE n >= 100)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM x) WHERE k > 1),
e AS (SELECT doc_id, i, coalesce(i > max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 100, true) AS new FROM r),
s AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM e) GROUP BY doc_id, island),
c AS (SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS free, b FROM s),
k AS (SELECT doc_id, string_agg(substring(h, 2 * free + 1, 2 * (a - free)), '' ORDER BY a) AS kept, max(b) AS last, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM c JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, '') || substring(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
""",
    "op6_host_quality": r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, sum(c - 1) AS dup FROM (SELECT doc_id, line, count(*) AS c FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL) GROUP BY doc_id),
g AS (SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5)),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 4)) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1) GROUP BY doc_id),
b AS (SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
c AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b),
h AS (SELECT source, count(*) AS k, count(*) FILTER (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 5 * n_dup_lines > n_words) AS x FROM c GROUP BY source),
p AS (SELECT m, least(greatest(coalesce(m * (1 - m) / nullif(v, 0) - 1, 1000), 1), 1000) AS a FROM (SELECT avg(x / k) AS m, var_pop(x / k) AS v FROM h)),
v AS (SELECT source, m, k + a AS t, (x + m * a) / (k + a) AS rate FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (rate - 2.326 * sqrt(rate * (1 - rate) / (t + 1)) > 2 * m / (1 + m)) AS kept, round(rate, 6) AS rate FROM c JOIN v ON c.source IS NOT DISTINCT FROM v.source
""",
    "op5_decontaminate": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS gram
      FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 13) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM g),
dw AS (SELECT doc_id, s.n, i, array_to_string(w[i : i + s.n - 1], ' ') AS gram
       FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n) AS x JOIN sizes AS s ON x.n = s.n),
hit AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN g ON dw.n = g.n AND dw.gram = g.gram),
spots AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN spots USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op7_near_dedup": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - least(len(w), 5) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n AS x ON a = x.doc_id JOIN n AS y ON b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS root FROM d UNION SELECT e.b, r.root FROM r JOIN e ON r.doc_id = e.a WHERE r.root < e.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(min(r.root), d.doc_id) AS component_id, least(min(r.root), d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY d.doc_id, n.n
""",
    # crc32 bit by bit over the key's ASCII bytes; the cheapest audits by a recursion over rows; states 0 none, 1 system, 2 user, 3 assistant.
    "op13_conversation_repair": r"""
WITH RECURSIVE keys AS (SELECT DISTINCT coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
crc AS (SELECT key, 0 AS i, 4294967295::BIGINT AS h FROM keys
        UNION ALL SELECT key, i + 1, list_reduce(list_prepend(xor(h, ascii(substring(key, i + 1, 1))::BIGINT), range(8)), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) FROM crc WHERE i < length(key)),
d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(h, 4294967295) % 20 AS rule FROM conversations JOIN crc ON key = coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AND i = length(key)),
m AS (SELECT conv_id, turn, CASE WHEN rule = 4 THEN 'user' ELSE role END AS role, CASE rule WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN rule = 3 THEN 2 ELSE 1 END)) AS copy FROM d WHERE rule <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p FROM m),
f AS (SELECT *, left(role, 1) AS ini, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'duplicate' WHEN regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN '' ELSE 'truncated' END AS fault,
             lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY p) AS before FROM o),
moves AS (SELECT * FROM (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)) AS t(ini, q, r)),
gap AS (SELECT * FROM (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 5, 'I'), (1, 2, 5, 'I'), (3, 2, 5, 'I'), (2, 3, 5, 'I'), (0, 3, 10, 'II'), (1, 3, 10, 'II')) AS t(q, r, price, add)),
edit AS (SELECT conv_id, p, q, r, 'K' AS letter, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS price FROM f JOIN moves USING (ini) WHERE fault NOT IN ('blank', 'duplicate')
         UNION ALL SELECT conv_id, p, q, r, 'R', CASE fault WHEN 'truncated' THEN 6 ELSE 1 END FROM f, moves WHERE fault NOT IN ('blank', 'duplicate') AND moves.ini <> 's'
         UNION ALL SELECT conv_id, p, q, q, 'D', 2 FROM f, range(4) AS t(q)),
step AS (SELECT conv_id, p, gap.q, edit.r, gap.price + edit.price AS price, add || letter AS add FROM gap JOIN edit ON gap.r = edit.q),
dp AS (SELECT DISTINCT conv_id, 0::BIGINT AS p, 0 AS q, lpad('0', 12, '0') AS best FROM o
       UNION ALL SELECT dp.conv_id, step.p, step.r, min(lpad((left(best, 12)::BIGINT + price)::VARCHAR, 12, '0') || substring(best, 13) || add) FROM dp JOIN step ON dp.conv_id IS NOT DISTINCT FROM step.conv_id AND step.p = dp.p + 1 AND step.q = dp.q GROUP BY dp.conv_id, step.p, step.r),
n AS (SELECT conv_id, max(p) AS n FROM o GROUP BY conv_id),
e AS (SELECT dp.conv_id, min(lpad((left(best, 12)::BIGINT + price)::VARCHAR, 12, '0') || substring(best, 13) || add) AS best FROM dp JOIN n ON dp.conv_id IS NOT DISTINCT FROM n.conv_id AND p = n JOIN gap USING (q) WHERE gap.r IN (0, 3) GROUP BY dp.conv_id),
l AS (SELECT conv_id, k, substring(best, 12 + k, 1) AS letter FROM (SELECT conv_id, best, unnest(range(1, length(best) - 11)) AS k FROM e)),
w AS (SELECT *, sum((letter <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY k) AS p FROM l),
y AS (SELECT w.conv_id, k, letter, f.role, CASE letter WHEN 'I' THEN '' ELSE text END AS text, letter = 'K' AND ini = 's' AS system FROM w LEFT JOIN f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.p = f.p WHERE letter <> 'D'),
z AS (SELECT *, sum((NOT system)::INT) OVER (PARTITION BY conv_id ORDER BY k) AS spot FROM y),
g AS (SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN spot % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY k)) AS digest FROM z GROUP BY conv_id),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (p > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(left(best, 12)::BIGINT, 0) AS cost, coalesce(substring(best, 13), '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS i LEFT JOIN c ON i.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN e ON i.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN g ON i.conv_id IS NOT DISTINCT FROM g.conv_id
""",
}
