"""The registered queries of the operators on training data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskflow.llm import (
    contamination,
    fingerprints,
    graphs,
    language,
    manifest,
    middle,
    mixing,
    personal,
    quality,
    sharding,
    templates,
    urls,
    warc,
)
from maskflow.llm.common import load, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# The production thresholds and sizes.
QUALITY_AT_LEAST = 0.7
SHARDS = 40


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@query
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    model = language.train(docs.where(~language.held_out("doc_id")))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id",
        language.held_out("doc_id").alias("held_out"),
        F.col("language.nearest").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.col("language.rejected").alias("rejected"),
    )


@query
def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(load(spark, folder, "pages"))


SQL["op2_warc"] = """
WITH digests AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest,
    octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes
  FROM pages),
firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM digests
  WHERE payload_bytes >= 100 GROUP BY payload_digest HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response'
    ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM digests LEFT JOIN firsts USING (payload_digest)
"""


@query
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text")
    clean = templates.drop_recurring_lines(docs)
    return clean.select(
        "doc_id",
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.octet_length("text").cast("bigint").alias("clean_bytes"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("clean_sha256"),
    )


SQL["op3_line_dedup"] = r"""
WITH rows AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
lines AS (
  SELECT row, coalesce(doc_id, 9223372036854775807) AS doc,
    unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS place
  FROM rows WHERE text IS NOT NULL),
tokens AS (
  SELECT *, list_transform(string_split(line, ' '),
    lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS tokens
  FROM lines WHERE trim(line, ' ') <> ''),
leaves AS (
  SELECT *, len(tokens) AS n, array_to_string(tokens, ' ') AS form, array_to_string(tokens[1:3], ' ') AS lead
  FROM tokens),
shared AS (
  SELECT n, lead FROM leaves GROUP BY n, lead HAVING min(doc) <> max(doc)),
forms AS (
  SELECT n, lead, form, tokens, min(doc) AS first FROM leaves JOIN shared USING (n, lead) GROUP BY n, lead, form, tokens),
templates AS (
  SELECT n, lead, list_reduce(list([{'first': first, 'tokens': tokens}] ORDER BY first, form),
    lambda found, e: CASE WHEN len(list_filter(found,
        lambda f: len(list_filter(range(1, n + 1),
          lambda i: f.tokens[i] = e[1].tokens[i] AND f.tokens[i] <> '<*>'))
        / greatest(1, len(list_filter(range(1, n + 1),
          lambda i: f.tokens[i] <> '<*>' OR e[1].tokens[i] <> '<*>'))) >= 0.8)) > 0
      THEN found ELSE list_concat(found, e) END) AS founders
  FROM forms GROUP BY n, lead),
keepers AS (
  SELECT form, list_filter(founders, lambda f: f.tokens = tokens OR len(list_filter(range(1, n + 1),
        lambda i: f.tokens[i] = tokens[i] AND tokens[i] <> '<*>'))
      / greatest(1, len(list_filter(range(1, n + 1),
        lambda i: f.tokens[i] <> '<*>' OR tokens[i] <> '<*>'))) >= 0.8)[1].first AS keeper
  FROM forms JOIN templates USING (n, lead)),
gone AS (
  SELECT row, count(*) AS n_dropped, list(place) AS dropped
  FROM leaves JOIN keepers USING (form) WHERE doc <> keeper GROUP BY row),
kept AS (
  SELECT lines.row, string_agg(line, chr(10) ORDER BY place) AS text
  FROM lines JOIN gone ON lines.row = gone.row AND NOT list_contains(dropped, place)
  GROUP BY lines.row),
clean AS (
  SELECT doc_id, coalesce(n_dropped, 0)::BIGINT AS n_dropped,
    CASE WHEN n_dropped IS NULL THEN rows.text ELSE coalesce(kept.text, '') END AS text
  FROM rows LEFT JOIN gone ON rows.row = gone.row LEFT JOIN kept ON rows.row = kept.row)
SELECT doc_id, n_dropped, octet_length(encode(text))::BIGINT AS clean_bytes,
  sha256(text) AS clean_sha256
FROM clean
"""


@query
def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    found = personal.find_personal_data(docs.select("doc_id", "text"), personal.train(docs))
    base, spans = F.col("personal.base"), F.col("personal.spans")

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def written(column):
        parts = F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.concat_ws(",", parts)

    return found.select("doc_id", "personal").select(
        "doc_id",
        *map(count, personal.KINDS),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(spans).alias("spans"),
    )


@query
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    return contamination.find_leaks(docs, load(spark, folder, "benchmark"))


@query
def op6_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return graphs.near_vectors(load(spark, folder, "embeddings"))


SQL["op6_embedding_dedup"] = """
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS row, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
usable AS (
  SELECT * FROM rows
  WHERE label IS NOT NULL AND len(list_filter(v, lambda x: x <> 0)) > 0
    AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
links AS (
  SELECT a.row AS a, b.row AS b FROM usable a JOIN usable b ON a.label = b.label AND a.row <> b.row
  WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) >= 0.93 ELSE false END),
counts AS (SELECT a AS row, count(*) AS n FROM links GROUP BY a),
reach AS (
  SELECT row AS origin, row AS reached FROM rows
  UNION SELECT origin, b FROM reach JOIN links ON reached = a),
lows AS (
  SELECT origin AS row, min(vec_id) AS component_id FROM reach JOIN rows ON reached = rows.row
  GROUP BY origin)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id,
  coalesce(vec_id = component_id, false) AS kept
FROM rows JOIN lows USING (row) LEFT JOIN counts USING (row)
"""


@query
def op7_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    prints = stored(docs.select("doc_id", fingerprints.fingerprint_of("text").alias("fp")), "prints")
    return fingerprints.with_components(prints).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    features = stored(docs.select("doc_id", quality.features_of("text").alias("features")), "features")
    scored = quality.score_documents(features, load(spark, folder, "labels"))
    return scored.select(
        "doc_id",
        quality.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_AT_LEAST).cast("int").alias("predicted"),
    )


@query
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_digests(load(spark, folder, "documents"))


@query
def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    return sharding.shard_digests(docs, sharding.Tree(SHARDS), SHARDS + 1)


# The rules (host, path, verdict) of the url filter.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query
def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    found = urls.judged(load(spark, folder, "pages").select("page_id", "url"), urls.UrlFilter.build(rules))
    return found.select("page_id", "host", "path", "rule", "verdict")


SQL["op11_url_filter"] = f"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
rows AS (
  SELECT row_number() OVER () AS row, page_id,
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT row, page_id,
    translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM rows),
fits AS (
  SELECT row, r_host || r_path AS rule, r_verdict
  FROM parts JOIN rules ON starts_with(path, r_path) AND (host = r_host OR ends_with(host, '.' || r_host))
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY length(r_host || r_path) DESC, length(r_host) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (row)
"""


@query
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text")
    cut = middle.fill_in_middle(docs).select("doc_id", "middle.*")
    restored = middle.restore("output", "form")
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"),
    )


SQL["op12_fill_in_middle"] = r"""
WITH draws AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
numbers AS (
  SELECT *, len(tokens) AS n, ('0x' || substr(h, 1, 8))::UBIGINT::BIGINT AS h1,
    ('0x' || substr(h, 9, 8))::UBIGINT::BIGINT AS h2, ('0x' || substr(h, 17, 8))::UBIGINT::BIGINT AS h3,
    ('0x' || substr(h, 25, 8))::UBIGINT::BIGINT AS h4
  FROM draws),
forms AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
    least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b
  FROM numbers),
parts AS (
  SELECT *, coalesce(array_to_string(tokens[1:a], ''), '') AS prefix,
    coalesce(array_to_string(tokens[a + 1:b], ''), '') AS middle,
    coalesce(array_to_string(tokens[b + 1:n], ''), '') AS suffix
  FROM forms)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.verify_documents(load(spark, folder, "documents"))


def _merkle_sql(levels: int = 7) -> str:
    """The same by levels written out, for up to 8 ** levels leaves a lang and as many langs."""

    def field(value: str) -> str:
        text = f"CAST({value} AS VARCHAR)"
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode({text})) || ':' || {text} END"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(map(field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"

    def build(first: str, name: str) -> str:
        """Levels of the trees that ``first`` (tree, place, digest) has the leaves of: a tree of
        one node stays as it is."""
        steps = [f"{name}0 AS (SELECT tree, place, digest, count(*) OVER (PARTITION BY tree) AS n FROM {first})"]
        for k in range(levels):
            steps.append(f"""{name}{k + 1} AS (
  SELECT tree, place // 8 AS place,
    CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY place)) END AS digest,
    count(*) OVER (PARTITION BY tree) AS n
  FROM {name}{k} GROUP BY tree, place // 8)""")
        return ",\n".join(steps)

    def climb(name: str, first: str, out: str) -> str:
        """Every row of ``first`` (row, tree, place, folded, proof) led through all levels."""
        steps, before = [], first
        for k in range(levels):
            steps.append(f"""{out}{k + 1} AS (
  SELECT c.row, c.tree, c.place // 8 AS place,
    CASE WHEN any_value(n) = 1 THEN any_value(c.folded) ELSE
      sha256(string_agg(CASE WHEN l.place = c.place THEN c.folded ELSE l.digest END, '' ORDER BY l.place)) END AS folded,
    any_value(c.proof) || coalesce(string_agg(l.digest, '' ORDER BY l.place) FILTER (l.place <> c.place), '') AS proof
  FROM {before} c JOIN {name}{k} l ON l.tree = c.tree AND l.place // 8 = c.place // 8
  GROUP BY c.row, c.tree, c.place)""")
            before = f"{out}{k + 1}"
        return ",\n".join(steps)

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH crc_table AS (
  SELECT list(c ORDER BY n) AS crcs FROM (
    SELECT n, list_reduce(list_prepend(n::BIGINT, range(8)),
      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM range(256) AS t(n))),
checks AS (
  SELECT doc_id AS checked, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      string_split(CAST(doc_id AS VARCHAR), ''), lambda s: ord(s)::BIGINT)),
    lambda c, x: xor(crcs[(xor(c, x) & 255) + 1], c >> 8))) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents), crc_table),
leaves AS (
  SELECT doc_id, coalesce('+' || lang, '-') AS tree, {leaf("text")} AS digest,
    CASE WHEN crc % 3 = 0 THEN {leaf(lowered)} ELSE {leaf("text")} END AS changed
  FROM documents LEFT JOIN checks ON doc_id = checked),
placed AS (
  SELECT *, row_number() OVER () AS row,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest, changed) - 1 AS place
  FROM leaves),
{build("placed", "l")},
subroots AS (
  SELECT tree AS lang_tree, digest, '' AS tree,
    row_number() OVER (ORDER BY tree <> '-', encode(tree)) - 1 AS place
  FROM l{levels}),
{build("subroots", "s")},
starts AS (SELECT row, tree, place, changed AS folded, '' AS proof FROM placed),
{climb("l", "starts", "c")},
above AS (
  SELECT row, subroots.tree, subroots.place, folded, proof FROM c{levels} JOIN subroots ON lang_tree = c{levels}.tree),
{climb("s", "above", "t")}
SELECT doc_id, placed.digest AS leaf, subroots.digest AS subroot, s{levels}.digest AS root,
  sha256(proof) AS proof_sha256, folded AS folded_root, folded = s{levels}.digest AS verified
FROM placed JOIN subroots ON lang_tree = placed.tree JOIN t{levels} ON t{levels}.row = placed.row, s{levels}
"""


SQL["op13_merkle_manifest"] = _merkle_sql()
