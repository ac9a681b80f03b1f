"""The registered queries of these operators, and SQL for those that SQL can express."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from arrivals_engine.llm import (
    bpe,
    chat,
    decontaminate,
    html,
    langid,
    lines,
    phrases,
    pii,
    quality,
    runs,
    shingles,
    urls,
    warc,
)
from arrivals_engine.llm.common import Scratch, table, with_small_batches
from arrivals_engine.sources.scratch import scratch_path

#: Where the vocabulary files are; a path of the machine, the same on all executors.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

Query = Callable[[SparkSession, str], DataFrame]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), VOCABULARY, RANKS)


RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), RULES)


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingles.components(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-7, 0, "user", text), (-7, 1, "assistant", text)],
        "conv_id long, turn long, role string, text string",
    )
    turns = table(spark, sf_dir, "conversations").select(planted.columns).unionByName(planted)
    return chat.digests(Scratch(spark, "chat").put(chat.examples(turns), "examples"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digests(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(table(spark, sf_dir, "documents"))


def op9_warc_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "archives")
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder, with_payload=False).drop("payload", "url")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(runs.planted(table(spark, sf_dir, "documents")))


OP7_SQL = f"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split
), keyed AS (
    SELECT *, translate(trim(line, {SPACES}), '{UPPER}', '{UPPER.lower()}') AS key FROM line
), frequent AS (
    SELECT key FROM keyed WHERE length(key) >= 1
    GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
    SELECT k.doc_id, k.line, k.pos, f.key IS NOT NULL AS gone
    FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
        AS kept_sha256
FROM marked GROUP BY doc_id
"""


#: The parts of a turn that are no text, and what gets an escape character.
TURN_CHARS = len(chat.START + chat.SEP + chat.END)
CONTROL = r"\\|<\||</?s>|<</?SYS>>|\[/?INST\]"

OP6_SQL = f"""
WITH turn AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *, {TURN_CHARS} + length(role || text)
        + len(regexp_extract_all(role, '{CONTROL}')) + len(regexp_extract_all(text, '{CONTROL}')) AS chars
    FROM turn
), placed AS (
    SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS upto,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS back
    FROM sized
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
        AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
        FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(upto) FILTER (WHERE role = 'assistant' OR back = 1) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""


LEVELS = " UNION ALL ".join(
    f"SELECT lang, {k} AS size, list_slice(ws, i, i + {k - 1}) AS phrase, count(*) AS f FROM place"
    f" WHERE i + {k - 1} <= len(ws) GROUP BY lang, list_slice(ws, i, i + {k - 1})"
    for k in range(1, 6)
)

OP11_SQL = f"""
WITH piece AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\n-\r]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM piece
), place AS (
    SELECT lang, ws, unnest(generate_series(1, len(ws))) AS i FROM words WHERE len(ws) > 0
), phrase AS (
    {LEVELS}
), total AS (
    SELECT lang, sum(f) AS n FROM phrase WHERE size = 1 GROUP BY lang
), candidate AS (
    SELECT * FROM phrase WHERE size > 1 AND f >= 100
), part AS (
    SELECT lang, f, phrase, size, unnest(generate_series(2, size - 1)) AS k
    FROM candidate WHERE size > 2
), inside AS (
    SELECT lang, f, phrase, k, unnest(generate_series(1, size - k + 1)) AS i FROM part
), covered AS (
    SELECT lang, list_slice(phrase, i, i + k - 1) AS phrase, max(f) AS cover
    FROM inside GROUP BY ALL
), kept AS (
    SELECT c.* FROM candidate c LEFT JOIN covered USING (lang, phrase)
    WHERE cover IS NULL OR 100 * cover < 100 * c.f
), cut AS (
    SELECT *, unnest(generate_series(1, size - 1)) AS k FROM kept
), scored AS (
    SELECT cut.lang, cut.phrase, cut.f AS a, k, l.f AS l, r.f AS r, n,
        (1000::HUGEINT * cut.f * n) // (l.f::HUGEINT * r.f) AS score
    FROM cut JOIN total USING (lang)
    JOIN phrase l ON l.lang = cut.lang AND l.phrase = list_slice(cut.phrase, 1, k)
    JOIN phrase r ON r.lang = cut.lang AND r.phrase = list_slice(cut.phrase, k + 1, cut.size)
), weakest AS (
    SELECT * FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
    SELECT lang, row_number() OVER (
        PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) AS rank,
        array_to_string(phrase, ' ') AS phrase, a, l, r, n, score
    FROM weakest
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
    CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""


def queries() -> dict[str, Query]:
    return {name: _bounded(f) for name, f in globals().items() if re.match(r"op\d+_", name)}


def _bounded(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with_small_batches(spark)
        return query(spark, sf_dir)

    return run


def oracle_sql() -> dict[str, str]:
    return {"op6_chat_format": OP6_SQL, "op7_line_dedup": OP7_SQL, "op11_phrase_mining": OP11_SQL}
