"""The registered queries of this subpackage, thin over its operators, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import decontaminate, jaccard, lexical, licenses, packing, quality, secrets, sharding, topk, toxicity, turns, urls, warc
from .words import hashed_fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_structural_secrets")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.KINDS[:3]))
    return found.select(
        "doc_id", *[count(k) for k in secrets.KINDS[:3]], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


# The rules of the contract, (action, host/path).
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@query("op2_markov_url_filter")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query("op4_mixture_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents")).drop("ids")


@query("op5_minimax_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_documents(table(spark, sf_dir, "documents"), 24)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


OP7 = r"""
WITH doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents),
item AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM benchmark),
sized AS (SELECT *, least(13, len(words)) AS size FROM item WHERE len(words) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS gram
            FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS pos FROM sized)),
sizes AS (SELECT DISTINCT size FROM windows),
grams AS (SELECT doc_id, size, pos, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS gram
          FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos FROM doc, sizes WHERE len(words) >= size)),
hits AS (SELECT doc_id, item_id, pos, g.size FROM grams g JOIN windows w ON g.size = w.size AND g.gram = w.gram),
words_hit AS (SELECT doc_id, count(DISTINCT word) AS n_hit
              FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM (SELECT DISTINCT doc_id, pos, size FROM hits)) GROUP BY doc_id),
items_hit AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS listed
              FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM doc d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)"""


@query("op7_benchmark_overlap", OP7)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"),
    )


OP8 = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, pos, pos + least(4, len(words)) - 1), ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - least(4, len(words)) + 2)) AS pos FROM doc WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.gram = y.gram AND x.doc_id <> y.doc_id
           GROUP BY x.doc_id, y.doc_id),
links AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM doc UNION SELECT doc_id, b FROM reach JOIN links ON other = a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n"""


@query("op8_prefix_orders_join", OP8)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_copies(table(spark, sf_dir, "documents"), jaccard.Rule(4, 85))


OP9 = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20"""


@query("op9_ball_tree_search", OP9)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def judged(scores: DataFrame, folds: int, held_out: int) -> DataFrame:
    return scores.select(
        "doc_id", (hashed_fold("doc_id", folds) == held_out).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query("op10_indexed_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged(scores, quality.FOLDS, quality.HELD_OUT)


@query("op3_license_diagonals")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query("op6_toxicity_grammar")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged(scores, toxicity.FOLDS, toxicity.HELD_OUT)


OP11 = r"""
WITH doc AS (
  SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents),
item AS (
  SELECT row_number() OVER () AS item_no, item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM benchmark),
size AS (SELECT count(*) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_terms FROM doc WHERE len(words) > 0),
asked AS (SELECT item_no, item_id, term, count(*) AS times FROM (SELECT item_no, item_id, unnest(words) AS term FROM item) GROUP BY ALL),
held AS (SELECT row, doc_id, n, term, count(*) AS tf
         FROM (SELECT row, doc_id, len(words) AS n, unnest(words) AS term FROM doc) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weighed AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM held, size GROUP BY term, n_docs),
scored AS (
  SELECT item_no, item_id, row, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weighed USING (term), size GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0) WHERE rank <= 10"""


@query("op11_length_strata_search", OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The least of (cost, audit, repaired text) from each state on, row by row from the last; states: 0 start, 1 system, 2 user, 3 assistant.
_NEXT = (2, 2, 3, 2)


def _repair_sql() -> str:
    def made(to: int) -> str:
        return "'user'" if to == 2 else "'assistant'"

    def led(cost: str, initial: str, text: str, rest: str) -> str:
        joined = f"CASE WHEN {rest}.r = '' THEN {text} ELSE {text} || chr(10) || {rest}.r END" if text else f"{rest}.r"
        return f"{{'c': {rest}.c + {cost}, 'a': '{initial}' || {rest}.a, 'r': {joined}}}"

    def least(*ways: str) -> str:
        return f"list_sort([{', '.join(ways)}])[1]"

    def kept(state: int) -> list[tuple[str, int]]:
        return [("s", 1)] * (state == 0) + [({2: "u", 3: "a"}[_NEXT[state]], _NEXT[state])]

    def row(state: int) -> str:
        """From a state over a row: delete, keep or rerole; dear ways stand in for those that can't be."""
        ways = [led("2", "D", "", f"b{state}")]
        for initial, to in kept(state):
            ways.append(led(f"(CASE WHEN gone OR initial <> '{initial}' THEN 1000000 ELSE 5 * cut END)", "K", "(role || ':' || text)", f"b{to}"))
        ways.append(led("(CASE WHEN gone THEN 1000000 ELSE 1 + 5 * cut END)", "R", f"({made(_NEXT[state])} || ':' || text)", f"b{_NEXT[state]}"))
        return least(*ways)

    def inserting(state: int, name: str) -> str:
        once = led("5", "I", made(_NEXT[state]) + " || ':'", f"{name}{_NEXT[state]}")
        return least(f"{name}{state}", once)

    end = ["{'c': 0, 'a': '', 'r': ''}", "{'c': 10, 'a': 'II', 'r': 'user:' || chr(10) || 'assistant:'}", "{'c': 5, 'a': 'I', 'r': 'assistant:'}", "{'c': 0, 'a': '', 'r': ''}"]
    four = range(4)
    each = lambda make: ", ".join(f"{make(s)} AS b{s}" for s in four)
    return f"""
WITH RECURSIVE hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
           lambda x: ord(x)::BIGINT)), lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
           lambda bits, i: xor(bits >> 1, CASE WHEN bits & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295::BIGINT) % 20 AS kind FROM conversations),
hurt AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS words
  FROM hurt),
judged AS (
  SELECT conv_id, turn, role, text, pos, left(role, 1) AS initial, words = '' AS blank, words <> '' AND again > 1 AS twice,
         words <> '' AND again = 1 AND right(words, 1) NOT IN ('.', '!', '?') AS truncated,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal FROM placed),
rows_of AS (SELECT *, blank OR twice AS gone, truncated::INTEGER AS cut FROM judged),
best AS (
  SELECT conv_id, count(*) AS pos, {each(lambda s: end[s])} FROM rows_of GROUP BY conv_id
  UNION ALL
  SELECT conv_id, pos, {each(lambda s: inserting(s, 'b'))} FROM (SELECT conv_id, pos, {each(lambda s: inserting(s, 'b'))} FROM (
    SELECT best.conv_id, best.pos - 1 AS pos, {each(row)}
    FROM best JOIN rows_of r ON best.conv_id IS NOT DISTINCT FROM r.conv_id AND best.pos = r.pos))),
counted AS (
  SELECT conv_id, CASE WHEN max(turn) IS NULL THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps, sum(blank::INTEGER) AS blank,
         sum(twice::INTEGER) AS duplicate, sum(cut) AS truncated, sum(coalesce(illegal, FALSE)::INTEGER) AS illegal FROM rows_of GROUP BY conv_id),
convs AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(b0.c, 0) AS BIGINT) AS cost,
       coalesce(b0.a, '') AS audit, sha256(coalesce(b0.r, '')) AS repaired_sha256
FROM convs c LEFT JOIN counted n ON c.conv_id IS NOT DISTINCT FROM n.conv_id
LEFT JOIN (SELECT * FROM best WHERE pos = 0) b ON c.conv_id IS NOT DISTINCT FROM b.conv_id"""


OP12 = _repair_sql()


@query("op12_run_length_repair", OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair(turns.damaged(table(spark, sf_dir, "conversations")))


OP13 = """
WITH page AS (SELECT page_id, coalesce(html, '') AS html, row_number() OVER () AS row FROM pages),
ordered AS (
  SELECT page_id, html, strlen(html) AS size, row_number() OVER (PARTITION BY html ORDER BY page_id NULLS LAST, row) AS nth,
         first_value(page_id) OVER (PARTITION BY html ORDER BY page_id NULLS LAST, row) AS original FROM page)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN size >= 100 AND nth > 1 THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN size >= 100 AND nth > 1 THEN original END AS refers_to
FROM ordered"""


@query("op13_content_addressed_warc", OP13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
