"""The operators on the driver's test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquarry.llm import (
    byte_bpe, centroids, decontaminate, language_id, licenses, neighbours, period_runs, pii, secrets, simhash, suffix_dedup,
    token_files, warc,
)
from fleetquarry.llm.common import load


def vocabulary(name: str) -> str:
    """Where a public vocabulary file is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(load(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(load(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(load(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(load(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(load(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(load(spark, sf_dir, "pages"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return byte_bpe.encode_decode(docs, vocabulary("byte_bpe_multi_50k.tiktoken"), pattern())


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(load(spark, sf_dir, "embeddings"), k=20, every=20)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of phrases and templates. The score grows with the words that the longest accepted template fixes; a
    phrase alone counts one half."""
    found = licenses.scan(load(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m["phrase"])
    starts = F.transform(base, lambda m: m["start"])

    def names(matches: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    weights = F.transform("matches", lambda m: F.when(m["phrase"], 0.5).otherwise(m["mandatory"] / (m["mandatory"] + 1)))
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(weights), F.lit(0.0)).alias("score"),
    )


def repeated_tails(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with the tails of about a tenth of the texts made periodic, as the contract of operator 12 says."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    n = F.size("w")
    rows = rows.withColumn("a", F.when(n > 0, F.pmod(F.col("g"), n)))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.pmod(F.col("g"), F.lit(8)))))
    tail = F.transform(F.sequence(F.col("a"), n - 1), lambda i: F.get("w", (F.col("a") + F.pmod(i - F.col("a"), F.col("p"))).cast("int")))
    text = F.concat_ws(" ", F.slice("w", F.lit(1), F.col("a").cast("int")), tail)
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def op12_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = repeated_tails(load(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    found = period_runs.periodic_runs(docs)
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("q"), r.alias("run")))
    )["run"]
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        longest["start"].alias("start"),
        longest["length"].alias("length"),
        longest["period"].alias("period"),
        F.floor(1000 * longest["length"] / longest["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(load(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_language_id": op2_language_id,
    "op3_pii": op3_pii,
    "op4_token_files": op4_token_files,
    "op5_secrets": op5_secrets,
    "op6_warc": op6_warc,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_simhash": op8_simhash,
    "op9_neighbours": op9_neighbours,
    "op10_decontaminate": op10_decontaminate,
    "op11_license_scan": op11_license_scan,
    "op12_period_runs": op12_period_runs,
    "op13_centroids": op13_centroids,
}



def _license_sql() -> str:
    """Templates as regular expressions over the words of a text, each followed by a blank."""
    automaton = licenses.compiled(licenses.TEMPLATES, {})
    spans = [(label, licenses.as_pattern(t)) for label in sorted(licenses.TEMPLATES) for t in licenses.TEMPLATES[label]]
    weights = [fixed for _, fixed, _ in automaton.entries]
    hits = ", ".join(f"regexp_matches(t, ' {pattern}')" for _, pattern in spans)
    labels = ", ".join(f"CASE WHEN hit[{k + 1}] THEN '{label}' END" for k, (label, _) in enumerate(spans))
    scores = ", ".join(f"CASE WHEN hit[{k + 1}] THEN {n} / {n + 1} END" for k, n in enumerate(weights))
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS t,
             list_filter(range(1, len(w) + 1), lambda i: w[i] = 'apache' AND w[i + 1] = 'license') AS a,
             list_filter(range(1, len(w) + 1), lambda i: w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license') AS g,
             list_filter(range(1, len(w) + 1), lambda i: w[i] = 'mit' AND w[i + 1] = 'license') AS m FROM d),
h AS (SELECT *, [{hits}] AS hit, list_concat(list_concat(a, g), m) AS places,
             list_filter([CASE WHEN len(a) > 0 THEN 'apache' END, CASE WHEN len(g) > 0 THEN 'gpl' END, CASE WHEN len(m) > 0 THEN 'mit' END],
                         lambda x: x IS NOT NULL) AS base FROM p)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, list_min(places) - 1 AS first_word,
       list_max(places) - 1 AS last_word, array_to_string(base, ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(base, list_filter([{labels}], lambda x: x IS NOT NULL)))), ',') AS labels,
       coalesce(list_max([{scores}, CASE WHEN len(places) > 0 THEN 0.5 END]), 0.0)::DOUBLE AS score
FROM h
"""


_RUNS_SQL = r"""
WITH RECURSIVE c AS (SELECT doc_id, [4294967295] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
         lambda x: [ord(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0])) AS bits, list_filter(regexp_split_to_array(coalesce(text, ''), '[ 	-]+'), lambda x: x <> '') AS w
       FROM documents),
h AS (SELECT doc_id, w, len(w) AS n, xor(4294967295, list_reduce(bits::BIGINT[], lambda s, x: xor(xor(s, x) >> 1, 3988292384 * (xor(s, x) & 1)))) AS h FROM c),
a AS (SELECT *, h % 10 = 0 AND n > 0 AS planted, CASE WHEN n > 0 THEN (h // 10) % n END AS a, (h // 10) % 8 AS e FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + e) AS p FROM a),
t AS (SELECT doc_id, n, CASE WHEN planted THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM p),
x AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM t),
pairs AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM x JOIN x y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
isles AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS isle FROM pairs),
long AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS n FROM isles GROUP BY doc_id, q, isle HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, s, n, min(q) AS q FROM long GROUP BY doc_id, s, n),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + n)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM x ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
facts AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
                 first(s ORDER BY n DESC, s, q) AS s, first(n ORDER BY n DESC, s, q) AS n, first(q ORDER BY n DESC, s, q) AS q FROM runs GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, f.n AS length, q AS period, 1000 * f.n // q AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM t LEFT JOIN facts f USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _centroid_sql() -> str:
    """The rounds one after the other; a vector is a list, a centroid a row for each of its components."""
    rounds = []
    for k in range(centroids.ROUNDS + 1):
        rounds.append(f"""
d{k} AS MATERIALIZED (SELECT r, k, list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT AS far FROM v, c{k}),
a{k} AS MATERIALIZED (SELECT r, arg_min(k, (far, k)) AS k, min(far) AS far FROM d{k} GROUP BY r)""")
        if k < centroids.ROUNDS:
            rounds.append(f"""
s{k} AS (SELECT k, i, floor(sum(x) / count(*))::BIGINT AS c FROM (SELECT a{k}.k, unnest(range(1, 65)) AS i, unnest(v) AS x FROM a{k} JOIN v USING (r)) GROUP BY k, i),
c{k + 1} AS MATERIALIZED (SELECT k, coalesce(n.c, o.c) AS c FROM c{k} o LEFT JOIN (SELECT k, list(c ORDER BY i) AS c FROM s{k} GROUP BY k) n USING (k))""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS k, v AS c FROM v ORDER BY k LIMIT 40),
{",".join(rounds)},
t AS (SELECT k, sum(far)::BIGINT AS cluster_inertia, (SELECT sum(far)::BIGINT FROM a5) AS inertia FROM a5 GROUP BY k)
SELECT vec_id, k::INTEGER AS cluster, far AS distance, cluster_inertia, inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a5 JOIN v USING (r) JOIN t USING (k) JOIN c5 USING (k)
"""


# The other operators hang on a trained model, a tokeniser or a hash that SQL does not have.
ORACLES: dict[str, str] = {
    "op1_suffix_dedup": """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, p, b[p + 1 : p + 50] AS s FROM (SELECT *, unnest(range(n - 49)) AS p FROM d WHERE n >= 50)),
dup AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS least FROM w) WHERE doc_id > least),
marked AS (SELECT *, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50, true) AS new FROM dup),
runs AS (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
spans AS (SELECT doc_id, run, min(p) AS s, max(p) + 50 AS e FROM runs GROUP BY 1, 2),
gaps AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS from_ FROM spans),
kept AS (SELECT doc_id, count(*) AS n_spans, sum(e - s) AS n_removed, max(e) AS last,
                string_agg(hex(b[from_ + 1 : s]), '' ORDER BY s) AS head
         FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || hex(b[coalesce(last, 0) + 1 : n]))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op6_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages),
bits AS (SELECT *, list_aggregate(list_transform(range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111',
                   1 + 4 * CAST(strpos('0123456789abcdef', substr(h, i, 1)) - 1 AS BIGINT), 4)), 'string_agg', '') AS b FROM p)
SELECT page_id, n AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + 16 * CAST(substr(b, 5 * i + 1, 1) AS INT)
         + 8 * CAST(substr(b, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(b, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(b, 5 * i + 4, 1) AS INT)
         + CAST(substr(b, 5 * i + 5, 1) AS INT) AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM bits
""",
    "op10_decontaminate": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
ds AS (SELECT doc_id, len(w) AS n, p, array_to_string(w[p + 1 : p + 5], ' ') AS g FROM (SELECT *, unnest(range(len(w) - 4)) AS p FROM d WHERE len(w) >= 5)),
bs AS (SELECT item_id, n, g, count(*) AS c FROM (SELECT item_id, len(w) AS n, array_to_string(w[p + 1 : p + 5], ' ') AS g
         FROM (SELECT *, unnest(range(len(w) - 4)) AS p FROM b WHERE len(w) >= 5)) GROUP BY ALL),
hits AS (SELECT doc_id, item_id, ds.n AS n_doc, bs.n AS n_item, least(ds.n, bs.n) - 4 AS width, p, g, c FROM ds JOIN bs USING (g)),
wins AS (SELECT *, unnest(range(greatest(0, p - width + 1), least(p, n_doc - 4 - width) + 1)) AS s FROM hits),
parts AS (SELECT doc_id, item_id, s, width, n_item, g, least(count(*), max(c)) AS shared FROM wins GROUP BY ALL),
scores AS (SELECT doc_id, item_id, s, width, sum(shared) / (width + n_item - 4 - sum(shared)) AS similarity FROM parts GROUP BY doc_id, item_id, s, width, n_item),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, s) AS rn FROM scores WHERE similarity >= 0.8)
SELECT doc_id, item_id, CAST(similarity AS DOUBLE) AS similarity, s AS first_word, width + 4 AS n_words FROM best WHERE rn = 1
""",
    "op11_license_scan": _license_sql(),
    "op12_period_runs": _RUNS_SQL,
    "op13_centroids": _centroid_sql(),
}
