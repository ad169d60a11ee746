"""The registered queries of this subpackage and, where SQL can state it, their DuckDB SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from kandela.llm import chat_format, collocations, decontaminate, exact_dedup, line_dedup, mixing, prefix_trie, quality, secrets, simhash, token_counts, url_filter, warc
from kandela.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file; KANDELA_TOKENIZERS names another folder with the same file names."""
    folder = os.environ.get("KANDELA_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_token_counts")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"), limit=2048)


@query("op2_line_dedup", """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT keyed.*, common.key IS NOT NULL AND doc_id <> owner AS gone FROM keyed LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, min_chars=40, min_docs=5))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op3_exact_dedup", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"), prefer="largest")


@query("op4_simhash")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, radius=2)
    return found.select("doc_id", "fingerprint", "component_id")


@query("op5_quality")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels").where(~quality.held_out()))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op6_secrets")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """The first scan of a new ledger; the method adds no spans beside the base ones."""
    found = secrets.scan(table(spark, folder, "documents"), scratch_path(spark, "secret-ledger"))
    count = lambda rule: F.size(F.filter("findings", lambda f: f["rule"] == rule)).cast("long").alias(f"n_{rule}")
    spans = F.array_join(F.transform("findings", lambda f: F.concat_ws(":", f["rule"], f["start"], f["end"])), ",")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


@query("op7_decontaminate")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.benchmark_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op8_mixing")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), weights=(5, 2, 1))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op9_warc")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Digest columns of all three records of every page, and the text of conversions."""
    records = warc.derived_records(table(spark, folder, "pages"))
    head = F.instr(F.col("record").cast("string"), "\r\n\r\n")
    text = F.when(F.col("warc_type") == "conversion", F.substring(
        F.col("record").cast("string"), head + 4, F.length(F.col("record").cast("string")) - head - 7))
    return records.select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "block_digest", "payload_digest",
                          "content_length", F.sha2("record", 256).alias("record_sha256"), text.alias("text"))


# Fixed values of the contract.
URL_RULES = """('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')"""


@query("op10_url_filter", f"""
WITH parts AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
split AS (SELECT page_id, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM parts),
rules(rule_host, rule_path, verdict) AS (VALUES {URL_RULES}),
fits AS (SELECT page_id, rule_host || rule_path AS rule, verdict FROM split JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
won AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM fits GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM split LEFT JOIN won USING (page_id)""")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {URL_RULES} AS rules(host, path, verdict)")
    return url_filter.judge_urls(table(spark, folder, "pages"), rules, default="allow")


_OPENINGS_SQL = """
turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM conversations),
plan AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
    list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
    lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))),
  4294967295) % 6 AS h FROM (SELECT DISTINCT conv_id FROM conversations)),
held AS (SELECT conv_id AS base, count(*) AS n FROM turns GROUP BY conv_id),
rebuilt AS (SELECT plan.conv_id, pos AS depth, role, text FROM plan JOIN turns ON turns.conv_id = base AND pos <= h
  UNION ALL SELECT conv_id, pos - h + least(h, coalesce(n, 0)), role, text FROM plan JOIN turns USING (conv_id) LEFT JOIN held USING (base) WHERE pos > h)"""


@query("op11_prefix_trie", f"""
WITH {_OPENINGS_SQL},
steps AS (SELECT conv_id, depth, length(text) AS chars,
    string_agg(sha256(length(role) || ':' || role || text) || '/', '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM plan),
nodes AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM steps GROUP BY ALL),
parents AS (SELECT depth + 1 AS depth, path AS parent, conv_id AS parent_conv_id FROM nodes),
linked AS (SELECT nodes.*, parent, parent_conv_id FROM nodes LEFT JOIN parents
  ON parents.depth = nodes.depth AND parent = substr(path, 1, 65 * (nodes.depth - 1)::BIGINT)),
families AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY ALL),
full_nodes AS (SELECT linked.*, coalesce(n_children, 0) AS n_children FROM linked LEFT JOIN families
  ON families.depth = linked.depth AND families.parent = linked.path),
below AS (SELECT top.depth, top.path, count(*) FILTER (d.n_children = 0) AS n_leaves, sum((d.n_convs - 1) * d.chars)::BIGINT AS saved_tokens
  FROM full_nodes AS top JOIN full_nodes AS d ON starts_with(d.path, top.path) GROUP BY ALL),
whole AS (SELECT conv_id, max(depth) AS depth, max(path) AS path FROM steps GROUP BY conv_id),
ends AS (SELECT depth, path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM whole GROUP BY ALL)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM full_nodes JOIN below USING (depth, path) LEFT JOIN ends USING (depth, path)""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation c opens with the first crc32(c) % 6 turns of the conversation at the head of its hundred."""
    turns = table(spark, folder, "conversations")
    ids = turns.select(F.col("conv_id").cast("long")).distinct()
    paths = prefix_trie.with_shared_openings(
        prefix_trie.in_order(turns), ids, F.col("conv_id") - F.col("conv_id") % 100, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6)
    return prefix_trie.trie(paths, ids)


# Fixed value of the contract: the conversation added to the table, whose texts hold the template's control strings.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


@query("op12_chat_format", rf"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '{CONTROL_TEXT}'),
written AS (SELECT *, 14 + length(regexp_replace(role, '(\\|###|</turn>|:)', '\\\1', 'g'))
  + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')) AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars FROM written GROUP BY conv_id""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    path = vocabulary("byte_bpe_50k.json")
    found = chat_format.read_back(chat_format.format_turns(turns.unionByName(added), path), path)
    return found.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


@query("op13_collocations", r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, (SELECT unnest(range(1, 6)) AS m)),
counts AS (SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang),
frequent AS (SELECT * FROM counts WHERE f >= 100),
candidates AS (SELECT * FROM frequent WHERE m > 1),
kept AS (SELECT * FROM candidates AS c WHERE NOT EXISTS (SELECT 1 FROM candidates AS y WHERE y.lang = c.lang AND y.m > c.m
  AND y.f >= c.f AND contains(' ' || y.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM kept),
scored AS (SELECT cuts.lang, cuts.phrase, cuts.f AS a, k, x.f AS l, y.f AS r, n,
  ((1000::HUGEINT * cuts.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS score FROM cuts
  JOIN frequent AS x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[:k], ' ')
  JOIN frequent AS y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
  JOIN totals ON totals.lang = cuts.lang
  QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM scored QUALIFY rank <= 2000""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"), least=100, top=2000)
