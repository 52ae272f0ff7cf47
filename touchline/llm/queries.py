"""The registered queries of this package, each over its whole tables."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.batches import Scratch, fold
from touchline.llm.bpe import encode_and_decode
from touchline.llm.imatch import fingerprints
from touchline.llm.language import fit_language_model, predict_language
from touchline.llm.lines import dedup_lines
from touchline.llm.merkle import build_manifest, proof_digest
from touchline.llm.mixing import mix
from touchline.llm.neardup import near_duplicates
from touchline.llm.quality import fit_quality_model, score_quality
from touchline.llm.rules import apply_rules
from touchline.llm.secrets import scan_secrets
from touchline.llm.topk import integer_vector, top_k
from touchline.llm.trie import build_trie, rebuilt
from touchline.llm.urls import Rule, judge_urls
from touchline.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

VOCABULARY = "byte_bpe_50k.json"
URL_RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
#: Shares of tokens by the domains of ``domains``.
MIX_TARGETS = {"clean": 0.92, "low": 0.03, "toxic": 0.05}
#: Rows that Spark hands to Python at once.
ARROW_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """The library's session settings, and small batches for Python workers."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def query(function: Query) -> Query:
    """Register a query under the name of its function."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepare(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def domains(labels: DataFrame) -> DataFrame:
    """doc_id and domain of labelled documents: toxic, else low or clean by quality."""
    domain = (
        F.when(F.col("toxic") == 1, "toxic")
        .when(F.col("quality") == 0, "low")
        .when(F.col("quality") == 1, "clean")
    )
    return labels.select("doc_id", domain.alias("domain"))


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = fold("doc_id", 4)
    seen = docs.filter((part >= 0) & (part != 2) & F.col("lang").isNotNull())
    predicted = predict_language(docs, fit_language_model(seen))
    return predicted.select(
        "doc_id", (part == 2).alias("held_out"), "lang_pred", "score"
    )


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, Scratch(spark), within=True)


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES, Scratch(spark))


@query
def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), integer_vector(F.col("embedding")).alias("vector")
    )
    return top_k(rows.filter("id % 50 = 0"), rows, 5)


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"), Scratch(spark))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = fold("doc_id", 3)
    seen = (part >= 0) & (part != 1)
    labels = table(spark, sf_dir, "labels")
    model = fit_quality_model(docs.filter(seen), labels.filter(seen))
    return score_quality(docs, model).select(
        "doc_id", (part == 1).alias("held_out"), "score", "predicted"
    )


@query
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark))
    return found.select("doc_id", "class_id", "kept")


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marks = domains(table(spark, sf_dir, "labels"))
    return mix(docs, marks, MIX_TARGETS, Scratch(spark)).drop("text")


def span_digest(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of the spans, joined by commas."""
    if kinds:
        spans = F.filter(spans, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


@query
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"), Scratch(spark))
    spans = F.col("spans")
    base = ("assign", "access", "hex")

    def count(kind: str) -> Column:
        number = F.size(F.filter(spans, lambda x: x["kind"] == kind))
        return number.cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, base),
        F.sha2(span_digest(spans, base), 256).alias("base_sha256"),
        span_digest(spans).alias("spans"),
    )


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path(VOCABULARY)
    return encode_and_decode(docs, path, {"doc_id": "long"}).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(fold("doc_id", 3) == 0, lowered).otherwise(F.col("text"))
    docs = table(spark, sf_dir, "documents")
    return build_manifest(docs, Scratch(spark), claimed={"text": tampered}).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


@query
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.col("conv_id") - F.col("conv_id") % 20
    turns = table(spark, sf_dir, "conversations")
    scratch = Scratch(spark)
    whole = rebuilt(turns, head, fold("conv_id", 4).cast("int"))
    return build_trie(scratch.write(whole), scratch)


@query
def op13_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"), Scratch(spark))


ORACLE: dict[str, str] = {
    "op3_url_filter": """
        WITH parts AS (
            SELECT page_id,
                   CASE WHEN strpos(url, '://') > 0
                        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), named AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1),
                                  '^[^?#]*') AS path
            FROM parts
        ), rules (action, rule_host, rule_path) AS (
            VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                   ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
        ), fits AS (
            SELECT page_id, action, rule_host || rule_path AS rule,
                   row_number() OVER (PARTITION BY page_id
                                      ORDER BY length(rule_host || rule_path) DESC) AS place
            FROM named
            JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
                      AND starts_with(path, rule_path)
        )
        SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
        FROM named LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (page_id)
    """,
    "op4_top_k": """
        WITH rows AS (
            SELECT vec_id,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_inner_product(q.vector, c.vector)::BIGINT AS score
            FROM rows q JOIN rows c ON q.vec_id <> c.vec_id AND len(q.vector) = len(c.vector)
            WHERE q.vec_id % 50 = 0
        )
        SELECT query_id,
               row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER
                   AS rank,
               vec_id, score
        FROM scored
        QUALIFY rank <= 5
    """,
    "op11_merkle": """
        WITH RECURSIVE crc_table AS (
            SELECT list_transform(range(256), lambda i: list_reduce(
                       list_concat([i], range(8)),
                       lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
                   )) AS t
        ), hashed AS (
            SELECT doc_id, lang, source, n_chars, text,
                   xor(4294967295, list_reduce(
                       list_concat([4294967295],
                                   list_transform(string_split(doc_id::VARCHAR, ''),
                                                  lambda x: ascii(x)::BIGINT)),
                       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])
                   )) % 3 = 0 AS tampered
            FROM documents, crc_table
        ), fields AS (
            SELECT *,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
                   || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-')
                   || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS others,
                   CASE WHEN tampered
                        THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                       'abcdefghijklmnopqrstuvwxyz')
                        ELSE text END AS claimed
            FROM hashed
        ), hashes AS (
            SELECT doc_id, coalesce('+' || lang, '') AS tree,
                   sha256(others || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   sha256(others || coalesce(strlen(claimed) || ':' || claimed, '-')) AS other
            FROM fields
        ), leaves AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1
                      AS place
            FROM hashes
        ), nodes AS (
            SELECT tree, 0 AS level, place, leaf AS node, count(*) OVER (PARTITION BY tree) AS total
            FROM leaves
            UNION ALL
            SELECT tree, level + 1, place // 8, sha256(string_agg(node, '' ORDER BY place)),
                   any_value((total + 7) // 8)
            FROM nodes WHERE total > 1 GROUP BY tree, level, place // 8
        ), subroots AS (
            SELECT tree, node AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS place
            FROM nodes WHERE total = 1
        ), over_nodes AS (
            SELECT 0 AS level, place, subroot AS node, count(*) OVER () AS total FROM subroots
            UNION ALL
            SELECT level + 1, place // 8, sha256(string_agg(node, '' ORDER BY place)),
                   any_value((total + 7) // 8)
            FROM over_nodes WHERE total > 1 GROUP BY level, place // 8
        ), steps AS (
            SELECT tree, level, place,
                   coalesce(string_agg(node, '') OVER (PARTITION BY tree, level, place // 8 ORDER BY place
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
                   coalesce(string_agg(node, '') OVER (PARTITION BY tree, level, place // 8 ORDER BY place
                       ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
            FROM (SELECT * FROM nodes
                  UNION ALL SELECT NULL, * FROM over_nodes) WHERE total > 1
        ), climbs AS (
            SELECT row_number() OVER () AS id, doc_id, leaf, l.tree, l.tree AS inside, 0 AS level,
                   l.place, other AS folded, '' AS proof
            FROM leaves l
            UNION ALL
            SELECT c.id, c.doc_id, c.leaf, c.tree,
                   CASE WHEN s.level IS NULL THEN NULL ELSE c.inside END,
                   CASE WHEN s.level IS NULL THEN 0 ELSE c.level + 1 END,
                   CASE WHEN s.level IS NULL THEN r.place ELSE c.place // 8 END,
                   CASE WHEN s.level IS NULL THEN c.folded
                        ELSE sha256(s.before || c.folded || s.after) END,
                   c.proof || coalesce(s.before || s.after, '')
            FROM climbs c
            JOIN subroots r ON r.tree = c.tree
            LEFT JOIN steps s ON s.tree IS NOT DISTINCT FROM c.inside AND s.level = c.level
                                 AND s.place = c.place
            WHERE s.level IS NOT NULL OR c.inside IS NOT NULL
        ), ends AS (
            SELECT * FROM climbs c
            WHERE inside IS NULL AND level = (SELECT max(level) FROM over_nodes)
        )
        SELECT doc_id, leaf, subroot, o.node AS root, sha256(proof) AS proof_sha256,
               folded AS folded_root, folded = o.node AS verified
        FROM ends JOIN subroots USING (tree), over_nodes o
        WHERE o.total = 1
    """,
    "op12_trie": """
        WITH crc_table AS (
            SELECT list_transform(range(256), lambda i: list_reduce(
                       list_concat([i], range(8)),
                       lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
                   )) AS t
        ), own AS (
            SELECT conv_id,
                   list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                        ORDER BY turn NULLS FIRST, role, text) AS turns,
                   xor(4294967295, list_reduce(
                       list_concat([4294967295],
                                   list_transform(string_split(conv_id::VARCHAR, ''),
                                                  lambda x: ascii(x)::BIGINT)),
                       lambda c, b: xor(c >> 8, any_value(t)[(xor(c, b) & 255) + 1])
                   )) % 4 AS h
            FROM conversations, crc_table WHERE conv_id IS NOT NULL GROUP BY conv_id
        ), rebuilt AS (
            SELECT o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns
            FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
        ), prefixes AS (
            SELECT conv_id, d AS depth, len(turns) AS total, turns[1:d] AS prefix
            FROM rebuilt, unnest(range(len(turns) + 1)) AS u(d)
        ), through AS (
            SELECT conv_id, depth, total, prefix[depth].text AS last,
                   min(conv_id) OVER (PARTITION BY depth, prefix) AS node
            FROM prefixes
        ), nodes AS (
            SELECT node, depth, count(*) AS n_convs,
                   string_agg(conv_id, ',' ORDER BY conv_id) FILTER (depth = total) AS ends,
                   CASE WHEN depth = 0 THEN 0
                        ELSE len(regexp_extract_all(any_value(last), '[^\\x20\\x09-\\x0D]+')) END AS words
            FROM through GROUP BY node, depth
        ), linked AS (
            SELECT n.*, p.node AS parent, (n.n_convs - 1) * n.words AS own_saved
            FROM nodes n LEFT JOIN through p ON p.conv_id = n.node AND p.depth = n.depth - 1
        ), counted AS (
            SELECT l.*, (SELECT count(*) FROM linked c
                         WHERE c.parent = l.node AND c.depth = l.depth + 1) AS n_children
            FROM linked l
        ), sums AS (
            SELECT a.node, a.depth, count(*) FILTER (c.n_children = 0) AS n_leaves,
                   sum(c.own_saved) AS saved_tokens
            FROM counted c JOIN through a ON a.conv_id = c.node AND a.depth <= c.depth
            GROUP BY a.node, a.depth
        )
        SELECT node AS conv_id, depth::BIGINT AS depth, parent AS parent_conv_id, n_convs,
               n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens,
               sha256(coalesce(ends, '')) AS ends_sha256
        FROM counted JOIN sums USING (node, depth)
    """,
}
