"""The registered queries of the training-data operators.

Each query applies one operator, with its production parameters, to its whole
table and derives the digest columns the contract asks for. ``ORACLE`` holds
DuckDB statements where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.chat import format_conversations, read_back
from salesmart.llm.decontaminate import contaminated
from salesmart.llm.exact_dedup import exact_groups
from salesmart.llm.html_text import extract_text
from salesmart.llm.language_id import predict_languages
from salesmart.llm.licenses import scan_licenses
from salesmart.llm.merkle import verify_manifest
from salesmart.llm.mixing import mixed
from salesmart.llm.ngram_join import near_duplicates
from salesmart.llm.shared import read_table, stored
from salesmart.llm.token_files import read_documents, write_token_files
from salesmart.llm.toxicity import fit_model, held_out, score_documents
from salesmart.llm.warc import assemble, page_captures, read_records, write_archives
from salesmart.llm.whitening import whitened
from salesmart.session import new_run_dir


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_run_dir(spark, "llm/warc")
    write_archives(read_table(spark, sf_dir, "pages"), path)
    captures = assemble(read_records(spark, path))
    captures = stored(captures.withColumn("response", F.col("response").dropFields("payload")), "warc-captures")
    return page_captures(captures).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as a source tree: a document is a file of its source,
    in a directory for its 512 ids under one for its 4096 ids."""
    group = F.floor(F.col("doc_id") / 4096).cast("string"), F.floor(F.col("doc_id") / 512).cast("string")
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), *group, F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    files = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), path.alias("path"), "text")
    found = scan_licenses(files).withColumnRenamed("id", "doc_id")
    return found.withColumn("own_licenses", F.array_join("own_licenses", ","))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(read_table(spark, sf_dir, "documents"))


CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], rows.schema)
    written = stored(format_conversations(rows.unionAll(extra)), "chat")
    return read_back(written).drop("rewrites_history")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(read_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit_model(docs, read_table(spark, sf_dir, "labels"))
    return score_documents(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify_manifest(read_table(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path as tokenizer_path
    path = new_run_dir(spark, "llm/token-files")
    write_token_files(read_table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"))
    return read_documents(spark, path)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_decontaminate": op2_decontaminate,
    "op3_license_scan": op3_license_scan,
    "op4_language_id": op4_language_id,
    "op5_chat_format": op5_chat_format,
    "op6_mix_sources": op6_mix_sources,
    "op7_toxicity": op7_toxicity,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_html_text": op9_html_text,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_token_files": op12_token_files,
    "op13_whitening": op13_whitening,
}

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_ESCAPED = "length({0}) + length({0}) - length(translate({0}, '\\#<{1}', ''))"

_CRC_STEP = "CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(s, i // 8 + 1, 1))) ELSE c END"


def _merkle_sql(group_levels: int = 6, top_levels: int = 4) -> str:
    """The manifest level by level; 16 to the power of the levels bounds the
    rows of a group and the groups."""
    def build(name: str, levels: int) -> str:
        return ",".join(f"""
        {name}r{k} AS (SELECT tree, idx // 16 AS run, any_value(size) AS size, string_agg(h, '' ORDER BY idx) AS txt
                       FROM {name}{k} GROUP BY tree, idx // 16),
        {name}{k + 1} AS (SELECT tree, run AS idx, (size + 15) // 16 AS size,
                          CASE WHEN size = 1 THEN txt ELSE sha256(txt) END AS h FROM {name}r{k})""" for k in range(levels))

    def climb(name: str, levels: int, first: str) -> str:
        out, last = [], first
        for k in range(levels):
            mine = f"x.{name}_idx // {16 ** k}"
            left, right = f"substr(r.txt, 1, 64 * (({mine}) % 16))", f"substr(r.txt, 64 * (({mine}) % 16) + 65)"
            out.append(f"""
        {name}p{k} AS (SELECT x.* REPLACE (
                CASE WHEN r.size = 1 THEN x.proof ELSE x.proof || {left} || {right} END AS proof,
                CASE WHEN r.size = 1 THEN x.acc ELSE sha256({left} || x.acc || {right}) END AS acc)
            FROM {last} x JOIN {name}r{k} r ON r.tree = x.{name}_tree AND r.run = x.{name}_idx // {16 ** (k + 1)})""")
            last = f"{name}p{k}"
        return ",".join(out)

    def part(column: str) -> str:
        text = f"CAST({column} AS VARCHAR)"
        return f"coalesce(strlen({text}) || ':' || {text}, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(part(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    return f"""
        WITH crc AS (SELECT *, CAST(doc_id AS VARCHAR) AS s FROM documents),
        leaves AS (SELECT doc_id, coalesce('=' || source, '') AS tree, {leaf('text')} AS leaf,
                CASE WHEN xor(list_reduce(range(8 * strlen(s)), lambda c, i:
                        xor(({_CRC_STEP}) >> 1, (({_CRC_STEP}) & 1) * 3988292384), 4294967295), 4294967295) % 5 = 0
                     THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other
            FROM crc),
        placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS g_idx,
                          count(*) OVER (PARTITION BY tree) AS size FROM leaves),
        g0 AS (SELECT tree, g_idx AS idx, size, leaf AS h FROM placed),{build('g', group_levels)},
        t0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS size, h
               FROM g{group_levels}),{build('t', top_levels)},
        start AS (SELECT doc_id, leaf, tree AS g_tree, g_idx, '' AS t_tree, dense_rank() OVER (ORDER BY tree) - 1 AS t_idx,
                         '' AS proof, coalesce(other, leaf) AS acc FROM placed),{climb('g', group_levels, 'start')},
        {climb('t', top_levels, f'gp{group_levels - 1}')}
        SELECT doc_id, leaf, g.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = t.h AS verified
        FROM tp{top_levels - 1} x JOIN g{group_levels} g ON g.tree = x.g_tree, t{top_levels} t"""


ORACLE: dict[str, str] = {
    "op1_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to
        FROM f""",
    "op5_chat_format": f"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{CONTROL_TEXT}')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(14 + {_ESCAPED.format('role', ':')} + {_ESCAPED.format('text', '')}) AS BIGINT) AS formatted_chars
        FROM turns GROUP BY conv_id""",
    "op8_ngram_jaccard": """
        WITH RECURSIVE lowered AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(words) > 0 THEN list_distinct(list_transform(
                range(1, greatest(len(words) - 4, 1) + 1), lambda i: array_to_string(words[i:i + 4], ' '))) ELSE [] END AS shingles
            FROM lowered),
        flat AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
        links AS (
            SELECT x.doc_id AS a, y.doc_id AS b FROM flat x JOIN flat y USING (shingle) WHERE x.doc_id <> y.doc_id
            GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
        reach AS (
            SELECT doc_id, doc_id AS seen FROM sets
            UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.seen)
        SELECT doc_id, CAST(any_value(len(shingles)) AS BIGINT) AS n_shingles, min(seen) AS component_id
        FROM sets JOIN reach USING (doc_id) GROUP BY doc_id""",
    "op11_merkle_manifest": _merkle_sql(),
    "op10_exact_dedup": f"""
        WITH norm AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   translate(coalesce(text, ''), {_WHITE}, '') AS k FROM documents),
        grouped AS (
            SELECT k, count(*) AS group_size,
                   arg_min(doc_id, (-length(t), doc_id)) AS keep_id FROM norm GROUP BY k)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(k) AS text_sha256
        FROM norm JOIN grouped USING (k)""",
}
