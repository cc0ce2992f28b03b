"""The corpus operators wired to the test tables, one query each, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    alignment, benchmark, chat, fingerprints, language, licenses, ngram_join, pieces, prefix_trie, repeats, sharding,
    token_files, toxicity,
)
from tidemark.llm.common import fold
from tidemark.session import materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TOKENIZER, END_ID = "word_bpe_49k.json", 2
PIECES = "piece_bpe_32k.model"
BYTEWISE = "byte_bpe_50k.json"


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL if there is one."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where the public tokenizers of this installation lie."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def held_out(folds: int, which: int):
    """Whether a document is kept from learning; one without an id is never learned from."""
    return F.coalesce(fold("doc_id", folds) == which, F.lit(True)).alias("held_out")


@query()
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), "doc_id", "text")


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    net = toxicity.fit(labels.where(~held_out(4, 2)), docs, "doc_id", "text", "toxic")
    scored = toxicity.with_score(docs.select("doc_id", "text"), "text", net)
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(4, 2), "score", predicted)


@query("""
    WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w FROM documents),
    i AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w FROM benchmark),
    d5 AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, k, k + 4), ' ') AS s
           FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS k FROM w WHERE len(w) > 0)),
    i5 AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, k, k + 4), ' ') AS s
           FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS k FROM i WHERE len(w) > 0)),
    n AS (SELECT item_id, count(*) AS n_item FROM i5 GROUP BY item_id),
    c AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d5 JOIN i5 USING (s) GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
    FROM c JOIN n USING (item_id) WHERE 10 * n_shared >= 8 * n_item
""")
def op3_benchmark_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return benchmark.contained_items(docs, "doc_id", "text", items, "item_id", "text")


@query()
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files.token_files(docs, "doc_id", "text", tokenizer_path(TOKENIZER), END_ID)


@query()
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, sf_dir, "documents"), "doc_id", "text")


@query()
def op6_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~held_out(5, 0)), "doc_id", "text", "lang")
    return language.predict(docs, "text", model, [F.col("doc_id"), held_out(5, 0)], "doc_id long, held_out boolean")


@query()
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = repeats.with_kept_bytes(docs, "doc_id", "text", "n_removed", "n_spans", "kept")
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes")
    return cut.select("doc_id", size, "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"), "doc_id", "text")


@query()
def op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    written = sharding.hilbert_shards(docs, "doc_id", "text", ["lang", "source"], shards=16)
    return written.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


@query()
def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer_path(PIECES))


# crc32 of a decimal id, bit by bit: a byte is mixed in, then eight shifts.
CRC = """xor(list_reduce(flatten([[CAST(ascii(b) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]
                 for b in string_split(CAST(c AS VARCHAR), '')]),
         lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END,
         CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"""


@query(f"""
    WITH t AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST,
        sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
      FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT c, c - c % 100 AS base, {CRC} % 6 AS h FROM (SELECT DISTINCT conv_id AS c FROM t)),
    r AS (SELECT c, 0 AS part, pos, role, text FROM c JOIN t ON t.conv_id = base WHERE pos < h
          UNION ALL SELECT c, 1, pos, role, text FROM c JOIN t ON t.conv_id = c WHERE pos >= h),
    s AS (SELECT c, coalesce(seq, []) AS seq FROM c LEFT JOIN (
            SELECT c, list(struct_pack(r := role, t := text) ORDER BY part, pos) AS seq FROM r GROUP BY c) USING (c)),
    p AS (SELECT c, d, seq[:d] AS node, d = len(seq) AS ends FROM (
            SELECT c, seq, unnest(range(0, len(seq) + 1)) AS d FROM s)),
    n AS (SELECT node, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs,
                 sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
          FROM p GROUP BY node),
    k AS (SELECT node[:depth - 1] AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
    u AS (SELECT n.*, coalesce(n_children, 0) AS n_children,
                 CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(node[depth].t) END AS saved
          FROM n LEFT JOIN k USING (node)),
    b AS (SELECT node[:d] AS node, CAST(sum(saved) AS BIGINT) AS saved_tokens,
                 count(*) FILTER (n_children = 0) AS n_leaves
          FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM u) GROUP BY 1)
    SELECT u.conv_id, u.depth, above.conv_id AS parent_conv_id, u.n_convs, u.n_children, n_leaves, saved_tokens,
           u.ends_sha256
    FROM u JOIN b USING (node) LEFT JOIN u above ON u.depth > 0 AND above.node = u.node[:u.depth - 1]
""")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turn_digests(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return prefix_trie.prefix_trie(*prefix_trie.with_shared_heads(turns, every=100, heads=6))


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    paths = tokenizer_path(BYTEWISE), tokenizer_path(PIECES)
    return alignment.alignments(docs, "text", paths, [F.col("doc_id").cast("long").alias("doc_id")], "doc_id long")


PLANTED = "</s>[INST] ok [/INST]"

# Template and escapes of the chat format, spelled out for the SQL: a mark takes a backslash after its first character.
ESCAPED = r"""replace(replace(replace(replace(replace(replace({}, '\', '\\'), '<s>', '<\s>'), '[INST]', '[\INST]'),
  '[AND]', '[\AND]'), '[/INST]', '[\/INST]'), '</s>', '<\/s>')"""


@query(f"""
    WITH given AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '{PLANTED}' UNION ALL SELECT -1, 1, 'assistant', '{PLANTED}'
    ), sized AS (
      SELECT *, length({ESCAPED.format("role")}) AS role_chars, length({ESCAPED.format("text")}) AS text_chars,
             role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS opens
      FROM given
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
             AS loss_sha256,
           CAST(sum(text_chars + CASE WHEN opens THEN role_chars + 16 ELSE 5 END) + 4 AS BIGINT) AS formatted_chars
    FROM sized GROUP BY conv_id
""")
def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-1, 0, "user", PLANTED), (-1, 1, "assistant", PLANTED)], given.schema)
    formatted = materialise(chat.format_chats(given.unionByName(planted), "conv_id", "turn", "role", "text"), "chats")
    turn = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return chat.read_chats(formatted, "formatted", "mask").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", turn), ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
