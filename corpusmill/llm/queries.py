"""The queries of the training-data operators, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, collocations, decontam, langid, licenses, mixing, neardup, pii, quality, tokens, toxicity, urls, whitening

#: Public vocabulary for token counts.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = langid.learn(docs.filter(~langid.held_out(F.col("doc_id"))))
    return langid.predict(docs, model)


def op2_fair_queueing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents")).drop("first_finish")


def op3_trie_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    return tokens.count_tokens(_read(spark, sf_dir, "documents"), tokens.load_pieces(vocabulary))


def op4_host_reputation(spark: SparkSession, sf_dir: str, suffixes: list[str] | None = None) -> DataFrame:
    """``suffixes``: rules of a public suffix list, if one is at hand."""
    labels = _read(spark, sf_dir, "labels").select(F.col("doc_id").alias("key"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return urls.judge(_read(spark, sf_dir, "pages"), labels, suffixes=suffixes).drop("bad_share")


def op5_minhash_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "documents"), width=3, threshold=85)


def op6_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.judge(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op7_information_sanitiser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_read(spark, sf_dir, "documents"))


def op8_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    # severity: 0 not toxic, 1 toxic, 2 toxic and of low quality
    grade = F.col("toxic") * (2 - F.coalesce(F.col("quality"), F.lit(1)))
    return toxicity.score(docs, toxicity.learn(docs, _read(spark, sf_dir, "labels").select("doc_id", grade.alias("grade"))))


def op9_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(_read(spark, sf_dir, "conversations"))


def op10_mcd_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_read(spark, sf_dir, "documents"))


def op11_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.judge(_read(spark, sf_dir, "documents"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_read(spark, sf_dir, "documents"), longest=4, least=30, contained=80, most=2000)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(_read(spark, sf_dir, "embeddings"), most=32)
    return white.withColumn("deviation", F.col("deviation").cast("long"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_language_mixture, op2_fair_queueing, op3_trie_token_counts, op4_host_reputation, op5_minhash_hamming, op6_prefix_decontamination, op7_information_sanitiser, op8_ordinal_toxicity, op9_perspective_rotation, op10_mcd_outliers, op11_license_diagonals, op12_phrase_collocations, op13_embedding_whitening, pipeline)}

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce('=' || source, '-') AS src, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(CAST(doc_id AS VARCHAR) || ':42') AS h
  FROM documents
), s0 AS (
  SELECT source, src, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source, src
), s1 AS (
  SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS INTEGER)] AS weight, source_size * 2 AS most FROM s0
), s2 AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 - coalesce(sum(most) OVER (ORDER BY most / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
    sum(weight) OVER (ORDER BY most / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wts FROM s1
), s3 AS (
  SELECT *, most * wts <= lft * weight AS full_ FROM s2
), lv AS (
  SELECT lft, wts FROM s3 WHERE NOT full_ ORDER BY most / weight, src LIMIT 1
), dims AS (
  SELECT src, source_size, weight, CASE WHEN full_ OR NOT EXISTS (SELECT 1 FROM lv) THEN CAST(most AS DOUBLE) ELSE CAST((SELECT lft FROM lv) AS DOUBLE) * weight / (SELECT wts FROM lv) END AS target FROM s3
), c AS (
  SELECT d.doc_id, d.src, d.size, d.h, source_size, weight, target, sum(size) OVER (PARTITION BY d.src ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS cum FROM d JOIN dims USING (src)
), sent AS (
  SELECT *, epoch, CAST((epoch - 1) * source_size + cum AS DOUBLE) / weight AS finish FROM c, (SELECT unnest([1, 2]) AS epoch) WHERE size > 0
), placed AS (
  SELECT *, sum(size) OVER (ORDER BY finish, src, epoch, h, doc_id, size ROWS UNBOUNDED PRECEDING) <= (SELECT sum(source_size) * 1.5 FROM s0) AS fits FROM sent
), taken AS (
  SELECT doc_id, src, size, CAST(sum(CASE WHEN fits THEN size ELSE 0 END) AS BIGINT) AS taken FROM placed GROUP BY doc_id, src, size
)
SELECT c.doc_id, c.size, c.source_size, c.target, coalesce(taken.taken, 0) AS taken FROM c LEFT JOIN taken ON c.doc_id = taken.doc_id AND c.src = taken.src AND c.size = taken.size
"""

OP4_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1), AZ), '') AS host, coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id
), h AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS x, CASE WHEN ip THEN site ELSE array_to_string(string_split(site, '.')[-(1 + long):], '.') END AS suffix, CASE WHEN ip THEN site ELSE array_to_string(string_split(site, '.')[-(2 + long):], '.') END AS domain
  FROM (SELECT *, CASE WHEN regexp_matches(site, '(^|\.)(SECOND)\.[a-z][a-z]$') THEN 1 ELSE 0 END AS long, regexp_matches(site, '^[0-9]+(\.[0-9]+){3}$') OR starts_with(site, '[') AS ip
    FROM (SELECT *, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '\.+$', '') AS site FROM p)) LEFT JOIN l ON l.doc_id = TRY_CAST(regexp_extract(path, '([0-9]+)', 1) AS BIGINT) GROUP BY host, site, long, ip
), o AS (SELECT (coalesce(sum(x), 0) + 1.0) / (coalesce(sum(n), 0) + 2.0) AS m FROM h),
s AS (SELECT suffix, sum(n) AS n, sum(x) AS x, (SELECT m FROM o) AS m FROM h GROUP BY suffix),
sr AS (SELECT least(greatest(coalesce(sum(power(x - n * m, 2) / (n * m * (1 - m)) - 1) / nullif(sum(n - 1), 0), 0.5), 0.001), 0.999) AS rho FROM s WHERE n > 0),
sp AS (SELECT suffix, ((1 - rho) / rho * m + x) / ((1 - rho) / rho + n) AS mean FROM s, sr),
g AS (SELECT h.suffix, domain, sum(n) AS n, sum(x) AS x, any_value(sp.mean) AS m FROM h JOIN sp USING (suffix) GROUP BY h.suffix, domain),
gr AS (SELECT least(greatest(coalesce(sum(power(x - n * m, 2) / (n * m * (1 - m)) - 1) / nullif(sum(n - 1), 0), 0.5), 0.001), 0.999) AS rho FROM g WHERE n > 0),
gp AS (SELECT domain, ((1 - rho) / rho * m + x) / ((1 - rho) / rho + n) AS mean FROM g, gr),
f AS (SELECT host, n, x, gp.mean AS m FROM h JOIN gp USING (domain)),
fr AS (SELECT least(greatest(coalesce(sum(power(x - n * m, 2) / (n * m * (1 - m)) - 1) / nullif(sum(n - 1), 0), 0.5), 0.001), 0.999) AS rho FROM f WHERE n > 0),
fp AS (SELECT host, (1 - rho) / rho * m + x AS a, (1 - rho) / rho * (1 - m) + n - x AS b FROM f, fr),
rules AS (SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) AS r(v, top, rest)),
best AS (
  SELECT page_id, host, path, max_by(struct_pack(v := v, rule := top || rest), length(top || rest)) AS r
  FROM p JOIN rules ON (host = top OR ends_with(host, '.' || top)) AND starts_with(path, rest) GROUP BY page_id, host, path
)
SELECT p.page_id, p.host, p.path, best.r.rule AS rule,
  coalesce(best.r.v, CASE WHEN a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > (SELECT m FROM o) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fp ON p.host = fp.host LEFT JOIN best ON p.page_id = best.page_id AND p.host = best.host AND p.path = best.path
""".replace("AZ", _AZ).replace("SECOND", "|".join(urls.SECOND))

OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), AZ), '[^\x20\x09-\x0D]+') AS w FROM documents
), sh AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w
), sized AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n, s FROM sh),
u AS (SELECT doc_id, n, hash(unnest(s)) AS x FROM sized),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS node, a AS seen FROM both_ways UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.seen = e.a),
comp AS (SELECT node, min(seen) AS c FROM reach GROUP BY node)
SELECT doc_id, n AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept FROM sized LEFT JOIN comp ON node = doc_id
""".replace("AZ", _AZ)

OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), AZ), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex(translate(coalesce(text, ''), AZ), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[s : s + least(len(w), 13) - 1], ' ') AS win FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS win FROM (SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS s FROM d, sizes WHERE len(w) >= n)
), hits AS (SELECT doc_id, s, dw.n, item FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM hits)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND coalesce(n_hit, 0) * 20 >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
""".replace("AZ", _AZ)

OP9_SQL = r"""
WITH t AS (
  SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS raw,
    replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;') || chr(10) || '</turn>' || chr(10) AS body,
    replace(replace(replace(replace(coalesce(role, 'unknown'), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS name FROM conversations
), sp AS (SELECT DISTINCT conv_id, alone, role AS speaker FROM t WHERE role <> 'system'),
laid AS (
  SELECT t.conv_id, t.alone, speaker, turn, role, raw, role = speaker AS own, body,
    CASE WHEN role = speaker THEN '<assistant>' || chr(10) WHEN role = 'system' THEN '<system>' || chr(10) ELSE '<user name="' || name || '">' || chr(10) END AS head
  FROM t JOIN sp ON t.conv_id IS NOT DISTINCT FROM sp.conv_id AND t.alone IS NOT DISTINCT FROM sp.alone
), placed AS (
  SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, alone, speaker ORDER BY turn NULLS FIRST, role, raw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS start FROM laid
)
SELECT conv_id, speaker, count(*) AS n_turns, count(*) FILTER (own) AS n_own, string_agg(head || body, '' ORDER BY turn NULLS FIRST, role, raw) AS text,
  coalesce(string_agg(CAST(start AS BIGINT) || ':' || CAST(start + length(body) AS BIGINT), ',' ORDER BY turn NULLS FIRST, role, raw, start) FILTER (own), '') AS mask
FROM placed GROUP BY conv_id, alone, speaker
"""

_TEMPLATES = ", ".join(f"({k}, '{t.label}', {t.base}, {len(t.words)}, {t.slack}, {t.percent}, '{t.text}')" for k, t in enumerate(licenses.PHRASES + licenses.NOTICES))

OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), AZ), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), t AS (
  SELECT template, label, base, len, slack, percent, string_split(text, ' ') AS w FROM (VALUES TEMPLATES) AS v(template, label, base, len, slack, percent, text)
), tg AS (SELECT template, off - 1 AS off, w[off] || ' ' || w[off + 1] || ' ' || w[off + 2] AS g FROM (SELECT *, unnest(range(1, len - 1)) AS off FROM t)),
dg AS (SELECT rid, pos - 1 AS pos, w[pos] || ' ' || w[pos + 1] || ' ' || w[pos + 2] AS g FROM (SELECT rid, w, unnest(range(1, CAST(len(w) AS BIGINT) - 1)) AS pos FROM d)),
hits AS (SELECT rid, template, off, pos, pos - off AS diagonal FROM dg JOIN tg USING (g)),
near AS (
  SELECT a.rid, a.template, a.diagonal, b.pos, unnest(range(b.off, b.off + 3)) AS word
  FROM (SELECT DISTINCT rid, template, diagonal FROM hits) a JOIN t USING (template) JOIN hits b ON a.rid = b.rid AND a.template = b.template AND abs(a.diagonal - b.diagonal) <= slack
), merged AS (SELECT rid, template, diagonal, min(pos) AS start, count(DISTINCT word) AS n_found FROM near GROUP BY rid, template, diagonal),
held AS (SELECT rid, label, base, start, CAST(n_found AS DOUBLE) / len AS coverage FROM merged JOIN t USING (template) WHERE n_found * 100 >= percent * len),
found AS (
  SELECT rid, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word, max(coverage) AS score,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM held GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN found USING (rid)
""".replace("AZ", _AZ).replace("TEMPLATES", _TEMPLATES)

OP12_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), AZ), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), g AS (
  SELECT lang, size, array_to_string(w[s : s + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(1, CAST(len(w) - size + 2 AS BIGINT))) AS s FROM p, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size)
), f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY lang, size, phrase),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size >= 2 AND f >= 30),
cut AS (SELECT *, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 : size], ' ') AS rest FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
s AS (
  SELECT cut.lang, cut.size, cut.phrase, a, k, h.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (CAST(h.f AS HUGEINT) + r.f) AS BIGINT) AS score
  FROM cut JOIN f h ON h.lang = cut.lang AND h.phrase = cut.head JOIN f r ON r.lang = cut.lang AND r.phrase = cut.rest
), low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT DISTINCT c.lang, array_to_string(w[s : s + m - 1], ' ') AS phrase, a AS longer
  FROM (SELECT *, unnest(range(1, CAST(size - m + 2 AS BIGINT))) AS s FROM (SELECT *, unnest(range(2, size)) AS m FROM c)) c
), gone AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN inner_ i ON c.lang = i.lang AND c.phrase = i.phrase AND 100 * i.longer >= 80 * c.a),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM low WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.lang = low.lang AND gone.phrase = low.phrase)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
""".replace("AZ", _AZ)

ORACLE_SQL = {"op11_license_diagonals": OP11_SQL, "op12_phrase_collocations": OP12_SQL, "op2_fair_queueing": OP2_SQL, "op4_host_reputation": OP4_SQL, "op5_minhash_hamming": OP5_SQL, "op6_prefix_decontamination": OP6_SQL, "op9_perspective_rotation": OP9_SQL}
