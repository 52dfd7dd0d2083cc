"""The thirteen operators as registered queries over whole tables, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, table
from .decontaminate import decontaminate
from .fm_dedup import remove_repeated_passages
from .jaccard import near_duplicates
from .mixing import mix
from .packing import pack
from .periodic_runs import periodic_runs
from .quality import judge_quality
from .sharding import shard
from .structure_repair import repair_report
from .suffix_dedup import remove_repeated_bytes
from .token_counts import count_tokens
from .topk import top_inner_products
from .url_filter import TWO_PART_SUFFIXES, judge_urls


def op1_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 4096 tokens, every window in the proportions of the whole table."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_fm_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_passages(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op5_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages against the rules and their hosts' reputation. A page's outcome is the label of the
    document with its id: bad where its quality is 0 or it is toxic, none where it says neither."""
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), bad.cast("int")).alias("bad"))
    return judge_urls(table(spark, sf_dir, "pages"), labels)


def op9_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's faults, planted by crc32 of ``conv_id:turn``, with ``times`` (0: dropped, 2: repeated)."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(known("text"), ".!?", "")).otherwise(known("text"))
    return rows.select("conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(known("role")).alias("role"), text.alias("text"),
                       F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(damaged(table(spark, sf_dir, "conversations")), times="times")


def with_periods(docs: DataFrame) -> DataFrame:
    """The contract's texts: in one of ten documents (by crc32 of the id; without one, none) the words from some place on repeat
    a stretch of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    cut = docs.select("doc_id", "text", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"))).alias("words"), F.floor(h / 10).alias("g"))
    cut = cut.withColumn("a", (F.col("g") % F.size("words")).cast("int"))
    cut = cut.withColumn("rest", F.size("words") - F.col("a"))
    cut = cut.withColumn("p", F.floor(F.col("rest") / (3 + F.col("g") % 8)).cast("int") + 1)
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(period, F.ceil(F.col("rest") / F.col("p")).cast("int"))), F.lit(1), F.col("rest"))
    text = F.when(F.size("words") > 0, F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")).otherwise(F.col("text"))
    return cut.select("doc_id", text.alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periods(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("size"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.size").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.size div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hit.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_mixture_packing, op2_token_counts, op3_entropy_mix, op4_fm_index_dedup, op5_top_inner_products,
                            op6_quality_rules, op7_jaccard_components, op8_host_reputation, op9_interleaved_shards, op10_suffix_dedup,
                            op11_structure_repair, op12_periodic_runs, op13_benchmark_decontamination)
}

# ------------------------------------------------------------------------------------------------
# DuckDB SQL. The others hold a classifier, a tokenizer, a checksum or a rounding that SQL does not
# express; tests/llm compares them with brute force, round trips or held-out accuracy.
# ------------------------------------------------------------------------------------------------
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

OP4_SQL = f"""WITH w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS body FROM places),
earliest AS (SELECT body, min(doc_id) AS doc_id FROM windows GROUP BY body),
hits AS (SELECT v.doc_id, v.i FROM windows v JOIN earliest e USING (body) WHERE e.doc_id < v.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM hits),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS body, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

OP5_SQL = """WITH v AS (
  SELECT row_number() OVER () AS uid, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT q.vec_id AS query_id, CAST(row_number() OVER best AS INTEGER) AS rank, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.uid <> q.uid AND len(q.e) = len(c.e)
WINDOW best AS (PARTITION BY q.uid ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id)
QUALIFY row_number() OVER best <= 10"""

OP7_SQL = f"""WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS words
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles
  FROM w),
one AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM one a JOIN one b USING (shingle) WHERE a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, least(doc_id, coalesce(least_id, doc_id)) AS component_id
FROM s LEFT JOIN (SELECT x, min(y) AS least_id FROM reach GROUP BY x) ON x = doc_id"""

_FIT = """SELECT CASE WHEN over > 0 AND sq > bin THEN least(greatest(over / (sq - bin) - 1, 2.0), 200.0) ELSE 200.0 END AS k
  FROM (SELECT sum((bad - n * prior) * (bad - n * prior)) AS sq, sum(n * prior * (1 - prior)) AS bin,
    sum(n * (n - 1) * prior * (1 - prior)) AS over FROM {table} WHERE n > 0)"""
_TWO = "('" + "', '".join(TWO_PART_SUFFIXES) + "')"
OP8_SQL = f"""WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
known AS (
  SELECT doc_id AS page_id, max(CAST(coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 AS BIGINT)) AS bad
  FROM labels WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY doc_id),
hosts AS (
  SELECT host, CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad,
    regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name, string_split(name, '.') AS l,
    len(l) - CASE WHEN len(l) > 1 AND array_to_string(l[-2:], '.') IN {_TWO} THEN 2 ELSE 1 END AS cut
  FROM p LEFT JOIN known USING (page_id) WHERE host <> '' GROUP BY host),
named AS (
  SELECT host, n, bad, CASE WHEN lone THEN name ELSE array_to_string(l[greatest(cut, 1):], '.') END AS domain,
    CASE WHEN lone THEN name ELSE array_to_string(l[cut + 1:], '.') END AS suffix
  FROM (SELECT *, regexp_matches(name, '^\\[.*\\]$|^[0-9]+(\\.[0-9]+){{3}}$') AS lone FROM hosts)),
overall AS (SELECT CASE WHEN sum(n) > 0 THEN sum(bad) / sum(n) ELSE 0.0 END AS rate FROM named),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(rate) AS prior FROM named, overall GROUP BY suffix),
s1 AS (SELECT suffix, (bad + k * prior) / (n + k) AS prior FROM s0, ({_FIT.format(table='s0')})),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad, any_value(prior) AS prior FROM named JOIN s1 USING (suffix) GROUP BY domain, suffix),
d1 AS (SELECT domain, suffix, (bad + k * prior) / (n + k) AS prior FROM d0, ({_FIT.format(table='d0')})),
h0 AS (SELECT host, n, bad, prior FROM named JOIN d1 USING (domain, suffix)),
h1 AS (SELECT host, (bad + k * prior) / (n + k) AS mean, n + k AS total FROM h0, ({_FIT.format(table='h0')})),
judged AS (SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (total + 1)) > 0.3 AS blocked FROM h1),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, r.host, path, rule, CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN blocked THEN 'block' ELSE 'allow' END AS verdict
FROM ruled r LEFT JOIN judged j ON j.host = r.host"""

# every period and place: an equality of words i and i + q; islands of them are the stretches of period q
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)),
    lambda acc, b: list_reduce(list_concat([xor(acc, b)], range(8)), lambda r, k: xor(r >> 1, 3988292384 * (r & 1)))), 4294967295)"""
OP12_SQL = f"""WITH h AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS words, {_CRC.format(text="doc_id::VARCHAR")} AS h FROM documents),
g AS (SELECT *, CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a FROM h),
w AS (SELECT doc_id, CASE WHEN a IS NULL THEN words ELSE list_transform(range(len(words)),
    lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(words) - a) // (3 + (h // 10) % 8)) END]) END AS words FROM g),
coded AS (SELECT doc_id, list_transform(words, lambda x: hash(x)) AS words FROM w),
q AS (SELECT doc_id, words, unnest(range(1, len(words) // 4 + 1)) AS q FROM coded),
e AS (SELECT doc_id, q, unnest(list_filter(range(len(words) - q), lambda i: words[i + 1] = words[i + q + 1])) AS i FROM q),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
found AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM found GROUP BY doc_id, start, length),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS body FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
told AS (SELECT doc_id, count(*) AS n_runs, arg_max((start, length, period), (length, -start, -period)) AS best,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best[1] AS start, best[2] AS length, best[3] AS period, 1000 * best[2] // best[3] AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM w LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)"""

_FOLDED = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
OP13_SQL = f"""WITH d AS (SELECT doc_id, {_FOLDED} AS words FROM documents),
b AS (SELECT item_id, {_FOLDED} AS words FROM benchmark),
p AS (SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS body FROM (
  SELECT *, least(len(words), 10) AS n, unnest(range(1, greatest(len(words) - 8, 2))) AS i FROM b WHERE len(words) > 0)),
places AS (SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS body FROM (
  SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM p) WHERE len(words) >= n)),
hits AS (SELECT doc_id, item_id, n, i FROM places JOIN p USING (n, body)),
covered AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS body FROM (
  SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(body, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""

# states: 0 nothing, 1 system, 2 user, 3 assistant last; a best is the cost in nine digits and the audit, so the least is the least text
OP11_SQL = r"""WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, """ + _CRC.format(text="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')") + r""" % 20 AS fault
  FROM conversations),
r AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM c WHERE fault <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos, left(role, 1) AS initial FROM r),
f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM n),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pos > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
ways(p, initial, q, cost, letter) AS (VALUES (0, 's', 1, 0, 'K'), (0, 'u', 2, 0, 'K'), (1, 'u', 2, 0, 'K'), (3, 'u', 2, 0, 'K'), (2, 'a', 3, 0, 'K'),
  (0, '', 2, 3, 'R'), (1, '', 2, 3, 'R'), (3, '', 2, 3, 'R'), (2, '', 3, 3, 'R')),
fill(p, q, cost, letters) AS (VALUES (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 1, 0, ''), (1, 2, 3, 'I'), (1, 3, 6, 'II'),
  (2, 2, 0, ''), (2, 3, 3, 'I'), (3, 3, 0, ''), (3, 2, 3, 'I')),
best AS (
  SELECT x.conv_id, 0::BIGINT AS pos, q AS state, cost::BIGINT AS cost, letters AS audit FROM (SELECT DISTINCT conv_id FROM conversations) x, fill WHERE p = 0
  UNION ALL
  SELECT conv_id, pos, state, least_one[1]::BIGINT, least_one[2] FROM (
    SELECT conv_id, pos, state, min([lpad(cost::VARCHAR, 9, '0'), audit]) AS least_one FROM (
      SELECT b.conv_id, f.pos, i.q AS state, b.cost + e.cost + i.cost AS cost, b.audit || e.letter || i.letters AS audit
      FROM best b JOIN f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.pos = b.pos + 1,
        LATERAL (SELECT w.q, w.cost + CASE WHEN f.fault = 'truncated' THEN 3 ELSE 0 END AS cost, w.letter FROM ways w
                 WHERE w.p = b.state AND w.initial IN ('', f.initial) AND (f.fault IS NULL OR f.fault = 'truncated')
                 UNION ALL SELECT b.state, 4, 'D') e, fill i WHERE i.p = e.q) GROUP BY conv_id, pos, state)),
chosen AS (
  SELECT b.conv_id, arg_min(b.cost, (b.cost, audit)) AS cost, arg_min(audit, (b.cost, audit)) AS audit
  FROM best b LEFT JOIN (SELECT conv_id, max(pos) AS n FROM f GROUP BY conv_id) m ON m.conv_id IS NOT DISTINCT FROM b.conv_id
  WHERE b.pos = coalesce(n, 0) AND state IN (0, 3) GROUP BY b.conv_id),
letters AS (
  SELECT conv_id, k, audit[k] AS letter, length(replace(audit[1:k], 'I', '')) AS pos, length(replace(audit[1:k], 'D', '')) AS place
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM chosen)),
outs AS (
  SELECT l.conv_id, place, letter, f.role, CASE WHEN letter = 'I' THEN '' ELSE f.text END AS text,
    max(CASE WHEN place = 1 AND letter = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS headed
  FROM letters l LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.pos = l.pos WHERE letter <> 'D'),
whole AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - headed) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
    chr(10) ORDER BY place) AS body FROM outs GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM chosen c LEFT JOIN facts x ON x.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN whole w ON w.conv_id IS NOT DISTINCT FROM c.conv_id"""

ORACLES: dict[str, str] = {"op4_fm_index_dedup": OP4_SQL, "op5_top_inner_products": OP5_SQL, "op7_jaccard_components": OP7_SQL,
                           "op8_host_reputation": OP8_SQL, "op11_structure_repair": OP11_SQL,
                           "op12_periodic_runs": OP12_SQL,
                           "op13_benchmark_decontamination": OP13_SQL}
