"""The registered queries of this package and, where SQL can say it, their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import alignment, centroids, merge_replay
from tillstar.llm.common import stored
from tillstar.llm.decision_list import filter_quality, learn_rules, text_statistics
from tillstar.llm.minhash import compare_with_next
from tillstar.llm.mixing import PER_SPLIT, plan_copies
from tillstar.llm.nbsvm import THRESHOLD, fit, fold, score
from tillstar.llm.packing import pack, tokenize
from tillstar.llm.secret_scan import RULES, scan_secrets, span_digests
from tillstar.llm.sharding import shard
from tillstar.llm.simhash import near_duplicates
from tillstar.llm.url_reputation import (
    _RHO,
    _RHO_RANGE,
    LEAST_SHARE,
    RULES as URL_RULES,
    TWO_LABEL_SUFFIXES,
    Z,
    judge,
)
from tillstar.llm.warc_index import write_and_read


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return span_digests(scan_secrets(docs))


def op2_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome of a page is the quality that its id is labelled with."""
    labels = _table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    judged = judge(_table(spark, sf_dir, "pages"), outcomes)
    return judged.withColumns({c: F.round(c, 6) for c in ("good_rate", "upper")})


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(_table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def tokenizer_path() -> str:
    """The word tokenizer of the installed vocabulary files."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def packed(docs: DataFrame) -> DataFrame:
    """A row per piece with its place and its token ids. Pieces are placed by length alone;
    the ids join their places afterwards, and only the places are held for that."""
    pieces = stored(tokenize(docs, tokenizer_path()), "pieces")
    places = pack(pieces.select("lot", "start", "length")).drop("length")
    return pieces.join(places.hint("shuffle_hash"), ["lot", "start"]).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        "sequence_id",
        "offset",
        "ids",
    )


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_systematic_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    taken = (F.col("copies") * F.col("size")).alias("taken")
    planned = plan_copies(docs, keep=["doc_id"])
    return planned.select("doc_id", "size", "source_size", "target", taken)


def op8_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    statistics = stored(text_statistics(_table(spark, sf_dir, "documents")), "statistics")
    rules = learn_rules(statistics, _table(spark, sf_dir, "labels"))
    return filter_quality(statistics, rules).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op9_nb_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, _table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id",
        (fold() == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op10_differencing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_and_read(_table(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = alignment.align(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    aligned = stored(aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return alignment.count_links(aligned).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = merge_replay.encode(docs, ranks, public_tokenizers.PATTERN).drop("text")
    return merge_replay.decode(coded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_url_reputation": op2_url_reputation,
        "op3_simhash": op3_simhash,
        "op4_best_fit_packing": op4_best_fit_packing,
        "op5_warc_index": op5_warc_index,
        "op6_minhash": op6_minhash,
        "op7_systematic_mixing": op7_systematic_mixing,
        "op8_decision_list": op8_decision_list,
        "op9_nb_svm": op9_nb_svm,
        "op10_differencing_shards": op10_differencing_shards,
        "op11_token_alignment": op11_token_alignment,
        "op12_centroids": op12_centroids,
        "op13_byte_bpe": op13_byte_bpe,
    }


def _secret_sql() -> str:
    """Matches and the text between them give every span's place."""

    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    def spans(k: int, rule) -> str:
        plain = re.sub(r"(?<=[*+?}])\+", "", rule.pattern)  # only saves time
        lead, group = "0", rule.group
        if rule.not_after:  # the character before is matched, too
            plain, group = f"(^|[^{rule.not_after}]){plain}", group + 1 if group else 0
            lead = f"length(regexp_extract(m[i], {quoted(plain)}, 1))"
        pattern = quoted(plain)
        value = f"regexp_extract(m[i], {pattern}, {group})" if group else "m[i]"
        before = (
            "coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)"
            " + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)"
        )
        return f"""
SELECT doc_id, row_no, {k} AS place, '{rule.kind}' AS kind, start + {lead} AS start,
       start + length(m[i]) AS stop
FROM (SELECT *, CAST({before} AS BIGINT) AS start
      FROM (SELECT doc_id, row_no, m, gaps, unnest(range(1, len(m) + 1)) AS i
            FROM (SELECT doc_id, row_no, regexp_extract_all(body, {pattern}) AS m,
                         string_split_regex(body, {pattern}) AS gaps
                  FROM docs)))
WHERE length({value}) >= {rule.least}"""

    every = "\nUNION ALL".join(spans(k, r) for k, r in enumerate(RULES))
    base = len([r for r in RULES if r.kind in ("assign", "access", "hex")])

    def joined(where: str) -> str:
        return (
            "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place)"
            f"{where}, '')"
        )

    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS body, row_number() OVER () AS row_no
              FROM documents),
spans AS ({every})
SELECT d.doc_id,
       count(*) FILTER (kind = 'assign') AS n_assign,
       count(*) FILTER (kind = 'access') AS n_access,
       count(*) FILTER (kind = 'hex') AS n_hex,
       sha256({joined(f" FILTER (place < {base})")}) AS base_sha256,
       {joined(" FILTER (place IS NOT NULL)")} AS spans
FROM docs d LEFT JOIN spans s USING (row_no)
GROUP BY d.row_no, d.doc_id"""


def _reputation_sql() -> str:
    rules = sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))

    def case(value) -> str:
        whens = " ".join(
            f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
            f" THEN '{value(v, h, p)}'"
            for v, h, p in rules
        )
        return f"CASE {whens} END"

    def level(name: str, children: str, parent: str, key: str) -> str:
        """The strength of a level, then its posterior means."""
        low, high = _RHO_RANGE
        return f"""
{name}_in AS (
  SELECT c.*, p.n AS pn, p.k AS pk, p.mean AS prior, p.{key} AS parent
  FROM {children} c JOIN {parent} p ON c.{key} = p.{key}
), {name}_sums AS (
  SELECT count(*) AS g, count(DISTINCT parent) AS p, sum(n) AS n,
         sum(n * (k / n - pk / pn) ** 2) AS b, sum(k * (1 - k / n)) AS w, sum(n * n / pn) AS s
  FROM {name}_in WHERE n > 0
), {name}_rho AS (
  SELECT CASE WHEN g > p AND n > g AND b / (g - p) + ((n - s) / (g - p) - 1) * w / (n - g) > 0
              THEN least(greatest((b / (g - p) - w / (n - g))
                                  / (b / (g - p) + ((n - s) / (g - p) - 1) * w / (n - g)),
                                  {low}), {high})
              ELSE {_RHO} END::DOUBLE AS rho
  FROM {name}_sums
), {name} AS (
  SELECT i.*, (1 - rho) / rho AS strength,
         ((1 - rho) / rho * prior + k) / ((1 - rho) / rho + n) AS mean
  FROM {name}_in i, {name}_rho
)"""

    two = "', '".join(TWO_LABEL_SUFFIXES)
    parts = "string_split(host, '.')"
    pair = f"array_to_string(list_slice({parts}, -2, -1), '.')"
    return f"""
WITH split AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), outcomes AS (
  SELECT doc_id AS page_id, min(quality) AS good FROM labels
  WHERE quality IS NOT NULL GROUP BY doc_id
), by_host AS (
  SELECT host, count(good) AS n, coalesce(sum(good), 0) AS k
  FROM split LEFT JOIN outcomes USING (page_id) GROUP BY host
), hosts AS (
  SELECT *, '' AS whole,
         CASE WHEN {pair} IN ('{two}') THEN {pair} ELSE list_extract({parts}, -1) END AS suffix,
         CASE WHEN {pair} IN ('{two}') THEN array_to_string(list_slice({parts}, -3, -1), '.')
              ELSE {pair} END AS domain
  FROM by_host
), domains AS (
  SELECT domain, suffix, '' AS whole, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY domain, suffix
), suffixes AS (
  SELECT suffix, '' AS whole, sum(n) AS n, sum(k) AS k FROM domains GROUP BY suffix
), everything AS (
  SELECT '' AS whole, sum(n) AS n, sum(k) AS k, (sum(k) + 1) / (sum(n) + 2) AS mean FROM suffixes
), {level("suffix_level", "suffixes", "everything", "whole")},
{level("domain_level", "domains", "suffix_level", "suffix")},
{level("host_level", "hosts", "domain_level", "domain")},
reputation AS (
  SELECT host, h.mean AS good_rate, e.mean AS all_pages,
         strength * prior + h.k AS a, strength * (1 - prior) + h.n - h.k AS b,
         1 / (1 + exp(-(ln(a / b) + {Z} * sqrt(1 / a + 1 / b)))) AS upper
  FROM host_level h, everything e
)
SELECT page_id, host, path, {case(lambda v, h, p: h + p)} AS rule,
       coalesce({case(lambda v, h, p: v)},
                CASE WHEN upper < {LEAST_SHARE} * all_pages THEN 'block' ELSE 'allow' END) AS verdict,
       round(good_rate, 6) AS good_rate, round(upper, 6) AS upper
FROM split JOIN reputation USING (host)"""


def _warc_sql() -> str:
    bits = "CAST(CAST(unhex(sha1(body)) AS BIT) AS VARCHAR)"
    letter = (
        "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',"
        " list_sum([(2 ** (5 - j))::INT * substr(bits, 5 * i + j, 1)::INT"
        " for j in [1, 2, 3, 4, 5]])::INT + 1, 1)"
    )
    return f"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS n,
         {bits} AS bits
  FROM pages
), digests AS (
  SELECT page_id, n, array_to_string([{letter} for i in range(0, 32)], '') AS digest FROM payloads
), firsts AS (
  SELECT digest, n, min(page_id) AS first FROM digests GROUP BY digest, n
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM digests JOIN firsts USING (digest, n)"""


def _mixing_sql() -> str:
    def drawn(text: str) -> str:
        return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"

    crossed = "floor(shift + share * ({}))"
    return f"""
WITH docs AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
         {drawn("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(text), '')")} AS spot
  FROM documents
), classed AS (
  SELECT *, greatest(length(bin(size)) - 6, 0) AS shift FROM docs
), blocked AS (
  SELECT *, spot % CAST(ceil(count(*) OVER (PARTITION BY source, shift, size >> shift)
                             / {PER_SPLIT}) AS BIGINT) AS split
  FROM classed
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), weighted AS (
  SELECT *, 3 * source_size AS cap,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sources
), sums AS (
  SELECT *, row_number() OVER o AS place,
         CAST(sum(source_size) OVER () - sum(cap) OVER o + cap AS BIGINT) AS rest,
         CAST(sum(weight) OVER () - sum(weight) OVER o + weight AS BIGINT) AS rest_weight
  FROM weighted
  WINDOW o AS (ORDER BY cap * (10 / weight), source NULLS LAST ROWS UNBOUNDED PRECEDING)
), level AS (
  SELECT * FROM sums WHERE rest * weight <= cap * rest_weight ORDER BY place LIMIT 1
), shares AS (
  SELECT s.source, s.source_size,
         CASE WHEN s.place < l.place THEN CAST(s.cap AS DOUBLE)
              ELSE CAST(l.rest AS DOUBLE) * s.weight / l.rest_weight END AS target
  FROM sums s, level l
), ranked AS (
  SELECT d.doc_id, d.size, s.source_size, s.target,
         CASE WHEN s.source_size > 0 THEN s.target / s.source_size ELSE 0 END AS share,
         {drawn("'7:' || coalesce(d.source, '')")} / 4294967296.0::DOUBLE AS shift,
         row_number() OVER (PARTITION BY d.source ORDER BY shift * 32 + (size >> shift), split, size, spot, doc_id) AS rank
  FROM blocked d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, size, source_size, target,
       CAST({crossed.format("rank")} - {crossed.format("rank - 1")} AS BIGINT) * size AS taken
FROM ranked"""


def _centroids_sql() -> str:
    """Every round is two tables: the nearest centroid of each vector, the moved centroids.
    Vectors and centroids are cells, one row per component."""
    k, width, scale = centroids.CENTROIDS, centroids.WIDTH, centroids.SCALE

    def assigned(n: int) -> str:
        return f"""
near{n} AS MATERIALIZED (
  SELECT r, min({{'d': d, 'c': c}}) AS best
  FROM (SELECT x.r, m.c, CAST(sum((x.v - m.v) * (x.v - m.v)) AS BIGINT) AS d
        FROM cells x JOIN centre{n} m ON x.i = m.i GROUP BY x.r, m.c)
  GROUP BY r
)"""

    def moved(n: int) -> str:
        return f"""
centre{n + 1} AS MATERIALIZED (
  SELECT m.c, m.i, CAST(coalesce((s - ((s % n) + n) % n) // n, m.v) AS BIGINT) AS v
  FROM centre{n} m LEFT JOIN (
    SELECT best.c AS c, i, sum(v) AS s, count(*) AS n
    FROM near{n} JOIN cells USING (r) GROUP BY 1, 2) t ON m.c = t.c AND m.i = t.i
)"""

    rounds = ",".join(assigned(n) + "," + moved(n) for n in range(centroids.ROUNDS))
    last = centroids.ROUNDS
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width}
    AND len(embedding) = {width}
), cells AS MATERIALIZED (
  SELECT r, unnest(range({width})) AS i, unnest(v) AS v FROM kept
), first AS (
  SELECT r, row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id) NULLS LAST, v) - 1 AS c
  FROM kept
), centre0 AS MATERIALIZED (
  SELECT c, i, v FROM first JOIN cells USING (r) WHERE c < {k}
),{rounds},{assigned(last)},
digests AS (
  SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256
  FROM centre{last} GROUP BY c
)
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.d AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near{last} JOIN kept USING (r) JOIN digests ON best.c = digests.c"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_secret_scan": _secret_sql(),
        "op2_url_reputation": _reputation_sql(),
        "op5_warc_index": _warc_sql(),
        "op7_systematic_mixing": _mixing_sql(),
        "op12_centroids": _centroids_sql(),
    }
