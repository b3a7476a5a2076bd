"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perilgrid.llm.chat_snapshots import format_chats
from perilgrid.llm.chosen_path import path_groups
from perilgrid.llm.count_automata import collocations
from perilgrid.llm.decontaminate import find_benchmark
from perilgrid.llm.line_dedup import line_dedup
from perilgrid.llm.packing import pack
from perilgrid.llm.pseudonyms import pseudonymize
from perilgrid.llm.quality_rules import quality_rules
from perilgrid.llm.ranked_search import ranked_search
from perilgrid.llm.secret_scan import secret_scan
from perilgrid.llm.simhash import simhash_groups
from perilgrid.llm.suffix_dedup import suffix_dedup
from perilgrid.llm.token_frames import token_files
from perilgrid.session import new_dir


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup(_documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_benchmark(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op5_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return token_files(_documents(spark, sf_dir), tokenizer, new_dir(spark, "token-files"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(_documents(spark, sf_dir))


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymize(_documents(spark, sf_dir), spark.conf.get("perilgrid.pseudonym.key", "pseudonym key"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_documents(spark, sf_dir))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(_documents(spark, sf_dir))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


def op11_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return path_groups(_documents(spark, sf_dir))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_chat_snapshots": op2_chat_snapshots,
    "op3_decontaminate": op3_decontaminate,
    "op4_packing": op4_packing,
    "op5_token_frames": op5_token_frames,
    "op6_secret_scan": op6_secret_scan,
    "op7_pseudonyms": op7_pseudonyms,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_simhash": op10_simhash,
    "op11_chosen_path": op11_chosen_path,
    "op12_ranked_search": op12_ranked_search,
    "op13_collocations": op13_collocations,
}

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"unnest(regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"

ORACLES: dict[str, str] = {
    "op12_ranked_search": f"""
WITH t AS (SELECT doc_id, {_TERMS} AS term FROM documents),
post AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
len AS (SELECT doc_id, count(*) AS n FROM t GROUP BY ALL),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM len),
norm AS (SELECT doc_id, 75 + (25 * n * docs) // terms AS m FROM len, total),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM post, total GROUP BY term, docs
),
query AS (SELECT item_id, {_TERMS} AS term FROM benchmark),
wanted AS (SELECT item_id, term, count(*) AS c FROM query GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN post USING (term) JOIN norm USING (doc_id) GROUP BY ALL
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
""",
    "op13_collocations": rf"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
         regexp_extract_all(unnest(regexp_split_to_array({_LOWER.format('text')}, '[.,;:!?

]')), '[^ 	]+') AS w
  FROM documents
),
word AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM piece),
counts AS (
  SELECT lang, array_to_string(w[i:i+k-1], ' ') AS phrase, k, count(*) AS f
  FROM (SELECT *, unnest([1, 2, 3]) AS k FROM word) WHERE i + k - 1 <= len(w) GROUP BY ALL
),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 10),
parts AS (
  SELECT *, array_to_string(w[1:cut], ' ') AS before, array_to_string(w[cut+1:], ' ') AS after
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand)
),
cuts AS (
  SELECT p.*, l.f AS l, r.f AS r, ((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM parts p JOIN counts l ON l.lang = p.lang AND l.phrase = before JOIN counts r ON r.lang = p.lang AND r.phrase = after
),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, array_to_string(w[j:j+1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest([1, 2]) AS j FROM cand WHERE k = 3) GROUP BY ALL
),
ranked AS (
  SELECT x.lang, row_number() OVER (PARTITION BY x.lang ORDER BY score DESC, a DESC, x.phrase) AS rank,
         x.phrase, a, l, r, n, score
  FROM lowest x JOIN total USING (lang) LEFT JOIN inside i ON i.lang = x.lang AND i.phrase = x.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * a
)
SELECT * FROM ranked WHERE rank <= 2000
""",
    "op2_chat_snapshots": """
WITH t AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
  SELECT *, coalesce(turn - min(turn) OVER (PARTITION BY conv_id), -1) AS place FROM t
), whole AS (
  SELECT conv_id, count(*) AS n, list({'p': place, 'r': role, 't': text} ORDER BY place, role, text) AS turns
  FROM placed GROUP BY conv_id
), dropped AS (
  SELECT a.conv_id FROM whole a JOIN whole b
    ON a.conv_id <> b.conv_id AND a.turns[1] = b.turns[1] AND a.n <= b.n AND a.turns = b.turns[1:a.n]
   AND (a.n < b.n OR b.conv_id < a.conv_id)
)
SELECT t.conv_id, w.n AS n_turns, t.turn, t.role, coalesce(t.role = 'assistant', false) AS trained,
       '<|im_start|>' || coalesce(t.role, '') || chr(10) || coalesce(t.text, '') || '<|im_end|>' || chr(10) AS piece
FROM t JOIN whole w USING (conv_id)
WHERE t.conv_id NOT IN (SELECT conv_id FROM dropped)
""",
    "op8_line_dedup": """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(0, len(string_split(text, chr(10))))) AS line_no
  FROM documents
), filled AS (
  SELECT * FROM lines WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''
), classes AS (
  SELECT line, min({'d': doc_id, 'l': line_no}) AS first FROM filled GROUP BY line
), gone AS (
  SELECT DISTINCT a.line FROM classes a JOIN classes b
    ON length(a.line) >= 40 AND length(b.line) >= 40 AND length(b.line) BETWEEN length(a.line) - 2 AND length(a.line) + 2 AND b.first < a.first
   AND levenshtein(a.line, b.line) <= 2
), out AS (
  SELECT g.doc_id, g.line_no FROM filled g JOIN classes c USING (line)
  WHERE {'d': g.doc_id, 'l': g.line_no} <> c.first OR g.line IN (SELECT line FROM gone)
)
SELECT l.doc_id, count(*) AS n_lines, count(o.line_no) AS n_removed,
       coalesce(string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (o.line_no IS NULL), '') AS text
FROM lines l LEFT JOIN out o USING (doc_id, line_no) GROUP BY l.doc_id
""",
}
