"""The operators over their whole tables, one query each, with the SQL that DuckDB can check them by."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sellthrough.llm.chat import format_chats, read_back, text_content
from sellthrough.llm.decontaminate import contamination
from sellthrough.llm.langid import held_out, identify, train
from sellthrough.llm.line_dedup import drop_recurring_lines
from sellthrough.llm.merkle import proofs
from sellthrough.llm.mixing import mix
from sellthrough.llm.near_dedup import NearDupes, near_duplicates
from sellthrough.llm.neighbours import nearest, usable
from sellthrough.llm.ngram_join import similar_documents
from sellthrough.llm.periodic import periodic_runs
from sellthrough.llm.substring_dedup import repeated_passages
from sellthrough.llm.token_count import count_with_edits, redactions
from sellthrough.llm.warc import captures, read_archives, write_archives
from sellthrough.session import materialise, work_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op2_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "archives")
    write_archives(_table(spark, sf_dir, "pages"), path)
    return captures(read_archives(spark, path, blocks=False)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), NearDupes(width=4))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    found = identify(documents.select("doc_id", "text"), train(documents))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_edit_aware_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents, before and after personal data is masked."""
    return count_with_edits(redactions(_table(spark, sf_dir, "documents").select("doc_id", "text"))).select(
        "doc_id", "n_tokens", F.size("leaf_tokens").cast("long").alias("n_segments"), "n_edits", "edited_tokens", "encoded_chars")


def op6_content_defined_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "first_doc_id", "start", "stop", "n_words")


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table and one conversation that speaks the template's language; formatted, written, and read back."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = turns.unionByName(own).withColumn("content", text_content(F.col("text")))
    return read_back(materialise(format_chats(turns), "chats"))


def op8_log_template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_recurring_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(_table(spark, sf_dir, "embeddings"))
    return nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def quality_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled good documents are drawn twice as eagerly."""
    return _table(spark, sf_dir, "labels").select("doc_id", (1 + F.coalesce("quality", F.lit(0))).cast("double").alias("weight"))


def op10_mixing_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(_table(spark, sf_dir, "documents"), quality=quality_weights(spark, sf_dir))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all rows, checked against a copy in which documents of even crc32 have lost their line breaks."""
    text = F.col("text")
    lost = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate(text, "\n", "")).otherwise(text)
    return proofs(_table(spark, sf_dir, "documents"), lost).drop("proof")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(_table(spark, sf_dir, "documents"), plant=True, texts=False)


def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_warc_transactions": op2_warc_transactions,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_language_id": op4_language_id,
    "op5_edit_aware_tokens": op5_edit_aware_tokens,
    "op6_content_defined_chunks": op6_content_defined_chunks,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_log_template_lines": op8_log_template_lines,
    "op9_inverted_multi_index": op9_inverted_multi_index,
    "op10_mixing_to_weights": op10_mixing_to_weights,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_ngram_jaccard_join": op13_ngram_jaccard_join,
}

OP1_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
i AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
n AS (SELECT item, w, least(len(w), 13) AS m FROM i WHERE len(w) > 0),
item_windows AS (
    SELECT DISTINCT item, m, array_to_string(w[s:s + m - 1], ' ') AS x FROM (SELECT item, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM n)),
lengths AS (SELECT DISTINCT m FROM n),
doc_windows AS (
    SELECT doc_id, s, m, array_to_string(w[s:s + m - 1], ' ') AS x
    FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, lengths WHERE len(w) >= m)),
hits AS (SELECT doc_id, s, doc_windows.m, item FROM doc_windows JOIN item_windows USING (m, x)),
places AS (SELECT DISTINCT doc_id, unnest(range(s, s + m)) AS place FROM hits),
per_doc AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
per_item AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN per_doc USING (doc_id) LEFT JOIN per_item USING (doc_id)
"""

# formatted_chars: each turn has 16 characters of template, and a character more for each `<` and `\\`.
OP7_SQL = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(16 + length(regexp_replace(role, '[\\<>\n]', 'xx', 'g')) + length(regexp_replace(text, '[\\<]', 'xx', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

OP8_SQL = r"""
WITH t AS (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL),
l AS (SELECT text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM t),
w AS (
    SELECT text, place, line, regexp_extract_all(regexp_replace(line, '[0-9]+', '<*>', 'g'), '[^\x20\x09-\x0D]+') AS w FROM l),
seen AS (SELECT DISTINCT text, w FROM w WHERE len(w) > 0),
lines AS (SELECT len(w) AS size, w[1:3] AS head, w, count(*) AS n FROM seen GROUP BY w),
each AS (SELECT size, head, w, n, unnest(w) AS token, generate_subscripts(w, 1) AS place FROM lines),
counted AS (SELECT *, sum(n) OVER (PARTITION BY size, head, place, token) AS times FROM each),
-- All but a fifth of a line's tokens, without its rarest ones.
fixed AS (SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY w ORDER BY times, place) > size // 5),
named AS (SELECT w, {'size': any_value(size), 'head': any_value(head), 'fixed': list({'p': place, 't': token} ORDER BY place)} AS template FROM fixed GROUP BY w),
often AS (SELECT template FROM seen JOIN named USING (w) GROUP BY template HAVING count(*) >= 10),
first_bad AS (SELECT w FROM lines WHERE n >= 10 UNION SELECT w FROM named JOIN often USING (template)),
speaking AS (
    SELECT text FROM seen LEFT JOIN (SELECT w, true AS bad FROM first_bad) USING (w) GROUP BY text
    HAVING 100 * coalesce(sum(len(w)) FILTER (bad IS NULL), 0) >= 20 * sum(len(w))),
heard AS (SELECT seen.* FROM seen JOIN speaking USING (text)),
often2 AS (SELECT template FROM heard JOIN named USING (w) GROUP BY template HAVING count(*) >= 10),
bad AS (SELECT w FROM heard GROUP BY w HAVING count(*) >= 10 UNION SELECT w FROM named JOIN often2 USING (template)),
marked AS (SELECT w.*, bad.w IS NOT NULL AS bad FROM w LEFT JOIN bad ON w.w = bad.w),
judged AS (
    SELECT text, count(*) FILTER (len(w) > 0) AS n_lines, count(*) FILTER (bad) AS n_dropped, string_agg(line, chr(10) ORDER BY place) FILTER (NOT bad) AS kept
    FROM marked GROUP BY text)
SELECT doc_id, CASE WHEN n_dropped > 0 THEN coalesce(kept, '') ELSE documents.text END AS text, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
       CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped
FROM documents LEFT JOIN judged ON documents.text = judged.text
"""

OP10_SQL = r"""
WITH d AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM d GROUP BY source),
r AS (  -- in the order in which sources reach three times their size
    SELECT *, (SELECT sum(source_size) FROM s) AS budget,
           sum(weight) OVER w - weight AS before_weight, sum(3 * source_size) OVER w - 3 * source_size AS before_cap,
           (SELECT sum(weight) FROM s) AS all_weight
    FROM s WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
c AS (SELECT *, CAST(budget - before_cap AS DOUBLE) * weight / CAST(all_weight - before_weight AS DOUBLE) > 3 * source_size AS capped FROM r),
f AS (SELECT max(budget) - coalesce(sum(3 * source_size) FILTER (capped), 0) AS left_budget, sum(weight) FILTER (NOT capped) AS left_weight FROM c),
t AS (
    SELECT source, source_size, CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE) ELSE CAST(left_budget AS DOUBLE) * weight / CAST(left_weight AS DOUBLE) END AS target
    FROM c, f),
e AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(3, CAST(floor(target / source_size) AS BIGINT)) END AS epochs FROM t),
q AS (SELECT doc_id, max(1 + coalesce(quality, 0)) AS weight FROM labels GROUP BY doc_id),
k AS (
    SELECT doc_id, source, size, -ln((CAST('0x' || substr(md5('10:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || size), 1, 12) AS BIGINT) + 0.5)
                                     / 281474976710656.0) / coalesce(weight, 1) AS key
    FROM d LEFT JOIN q USING (doc_id)),
u AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS until FROM k),
m AS (
    SELECT doc_id, u.source, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE
           epochs + CASE WHEN target - epochs * source_size > 0 AND until - size / 2 <= target - epochs * source_size THEN 1 ELSE 0 END END AS copies
    FROM u JOIN e ON u.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, source, CAST(copies AS BIGINT) AS copies FROM m
"""

_CRC = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(1, length({0}) + 1), lambda i: CAST(ord({0}[i]) AS BIGINT))),
        lambda c, b: list_reduce(list_concat([xor(c, b)], [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
_DOC_CRC = _CRC.format("CAST(doc_id AS VARCHAR)")


def _hashed(text: str) -> str:
    """SHA-256 over a row's fields, its text given."""
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in fields) + ")"


# idx: place in a level of n nodes.
OP11_SQL = rf"""
WITH RECURSIVE d AS (
    SELECT *, row_number() OVER () AS row_no, {_hashed('text')} AS leaf,
           {_hashed(f"CASE WHEN {_DOC_CRC} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS leaf_now FROM documents),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM d),
nodes AS (
    SELECT source, 0 AS level, r AS idx, leaf AS digest, n FROM leaves
    UNION ALL
    SELECT source, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM nodes WHERE n > 1 GROUP BY source, level, idx // 3, n),
roots AS (
    SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM nodes WHERE n = 1),
top AS (
    SELECT 0 AS level, r AS idx, subroot AS digest, n FROM roots
    UNION ALL
    SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY level, idx // 3, n),
families AS (
    SELECT row_no, level AS step, idx, digest, leaves.r // CAST(power(3, level) AS BIGINT) AS own
    FROM leaves JOIN nodes ON leaves.source IS NOT DISTINCT FROM nodes.source AND nodes.n > 1
                          AND idx // 3 = leaves.r // CAST(power(3, level + 1) AS BIGINT)
    UNION ALL
    SELECT row_no, 1000 + level, idx, digest, roots.r // CAST(power(3, level) AS BIGINT)
    FROM leaves JOIN roots ON leaves.source IS NOT DISTINCT FROM roots.source JOIN top ON top.n > 1 AND idx // 3 = roots.r // CAST(power(3, level + 1) AS BIGINT)),
paths AS (
    SELECT row_no, row_number() OVER (PARTITION BY row_no ORDER BY step) AS step, coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx < own), '') AS lefts,
           coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx > own), '') AS rights
    FROM families GROUP BY row_no, step),
folds AS (
    SELECT row_no, 0 AS step, leaf_now AS digest FROM leaves
    UNION ALL
    SELECT folds.row_no, paths.step, sha256(lefts || digest || rights) FROM folds JOIN paths ON folds.row_no = paths.row_no AND paths.step = folds.step + 1),
folded AS (SELECT row_no, arg_max(digest, step) AS folded_root FROM folds GROUP BY row_no),
proofs AS (SELECT row_no, string_agg(lefts || rights, '' ORDER BY step) AS proof FROM paths GROUP BY row_no)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN roots ON leaves.source IS NOT DISTINCT FROM roots.source JOIN folded USING (row_no) LEFT JOIN proofs USING (row_no)
     CROSS JOIN (SELECT digest AS root FROM top WHERE n = 1)
"""

# Every lag of a word to an earlier place of it; lags that hold for consecutive words are a match.
OP12_SQL = rf"""
WITH d AS (
    SELECT row_number() OVER () AS row_no, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w, {_DOC_CRC} AS h FROM documents),
g AS (SELECT row_no, doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 % 8 AS e FROM d),
words AS (
    SELECT row_no, n, i, CASE WHEN planted AND i >= a THEN w[a + (i - a) % (1 + (n - a) // (3 + e)) + 1] ELSE w[i + 1] END AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM g)),
cells AS (
    SELECT x.row_no, x.i, x.i - y.i AS lag FROM words x JOIN words y ON x.row_no = y.row_no AND x.word = y.word AND x.i > y.i AND 4 * (x.i - y.i) <= x.n),
matches AS (
    SELECT row_no, lag, min(i) - lag AS start, count(*) + lag AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY row_no, lag ORDER BY i) AS island FROM cells)
    GROUP BY row_no, lag, island HAVING count(*) + lag >= greatest(6, 4 * lag)),
runs AS (SELECT row_no, start, length, min(lag) AS period FROM matches GROUP BY row_no, start, length),
summed AS (
    SELECT row_no, count(*) AS n_runs, arg_min({{'s': start, 'm': length, 'q': period}}, {{'m': -length, 's': start, 'q': period}}) AS best,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM runs GROUP BY row_no),
kept AS (
    SELECT row_no, string_agg(word, ' ' ORDER BY i) AS collapsed
    FROM words WHERE NOT EXISTS (SELECT 1 FROM runs WHERE runs.row_no = words.row_no AND i >= start + period AND i < start + length) GROUP BY row_no)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.m AS length, best.q AS period, 1000 * best.m // best.q AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM g LEFT JOIN summed USING (row_no) LEFT JOIN kept USING (row_no)
"""


def _linked_sql(width: int, percent: int, kept: str = "") -> str:
    """Components of documents whose sets of word shingles are similar, from the counts of common shingles of all pairs that have one."""
    return rf"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS row_no, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingles AS (
    SELECT DISTINCT row_no, array_to_string(w[s:s + least({width}, len(w)) - 1], ' ') AS x
    FROM (SELECT *, unnest(range(1, len(w) - least({width}, len(w)) + 2)) AS s FROM d WHERE len(w) > 0)),
sizes AS (SELECT row_no, count(*) AS n, bit_xor(hash(x)) AS set_hash FROM shingles GROUP BY row_no),
-- Equal sets are one class, which its first row stands for.
classes AS (SELECT n, set_hash, min(row_no) AS row_no FROM sizes GROUP BY n, set_hash),
common AS (
    SELECT a.row_no AS a, b.row_no AS b, count(*) AS shared FROM (SELECT * FROM shingles SEMI JOIN classes USING (row_no)) a
    JOIN (SELECT * FROM shingles SEMI JOIN classes USING (row_no)) b ON a.x = b.x AND a.row_no < b.row_no GROUP BY a.row_no, b.row_no),
links AS (
    SELECT a, b FROM common JOIN sizes p ON p.row_no = a JOIN sizes q ON q.row_no = b WHERE 100 * shared >= {percent} * (p.n + q.n - shared)),
edges AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
    UNION SELECT row_no, row_no FROM classes),
-- Documents of a class, whose ids name it.
reach AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
ids AS (SELECT classes.row_no AS class, sizes.row_no, d.doc_id FROM classes JOIN sizes USING (n, set_hash) JOIN d ON d.row_no = sizes.row_no),
least_id AS (SELECT a AS class, min(doc_id) AS component_id FROM reach JOIN ids ON ids.class = reach.b GROUP BY a)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, coalesce(least_id.component_id, d.doc_id) AS component_id{kept}
FROM d LEFT JOIN sizes USING (row_no) LEFT JOIN ids USING (row_no) LEFT JOIN least_id USING (class)
"""


OP3_SQL = _linked_sql(4, 80, ", coalesce(least_id.component_id, d.doc_id) = d.doc_id AS kept")
OP13_SQL = _linked_sql(3, 90)

ORACLES: dict[str, str] = {
    "op1_benchmark_decontamination": OP1_SQL,
    "op3_minhash_near_dedup": OP3_SQL,
    "op7_chat_formatting": OP7_SQL,
    "op8_log_template_lines": OP8_SQL,
    "op10_mixing_to_weights": OP10_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op12_periodic_runs": OP12_SQL,
    "op13_ngram_jaccard_join": OP13_SQL,
}
