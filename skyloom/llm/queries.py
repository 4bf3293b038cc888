"""One query per operator over its whole table, and the SQL that states the result where SQL can."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm.ann_forest import nearest
from skyloom.llm.centroids import cluster
from skyloom.llm.common import documents
from skyloom.llm.conversations import damaged, repair, turns_of
from skyloom.llm.exact_dedup import exact_dedup
from skyloom.llm.language_id import identify
from skyloom.llm.license_scan import license_spans
from skyloom.llm.line_dedup import dedup_lines
from skyloom.llm.mixing import mix
from skyloom.llm.ngram_join import near_duplicates
from skyloom.llm.piece_bpe import encode_documents
from skyloom.llm.secret_scan import KINDS, secret_spans
from skyloom.llm.sharding import shard_documents
from skyloom.llm.suffix_dedup import remove_repeats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


def _labels(spans):
    return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")


@query("op1_license_scan")
def op1(spark, sf_dir):
    found = license_spans(documents(spark, sf_dir)).withColumn("base", F.filter("spans", lambda s: s["base"]))
    first = F.transform("base", lambda s: s["first"])
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(first).alias("first_word"), F.array_max(first).alias("last_word"),
        _labels(F.col("base")).alias("base_labels"), _labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["similarity"])), F.lit(0.0)).alias("score"),
        F.array_join(
            F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["first"], s["end"], s["edits"])), ","
        ).alias("spans"),
    )


@query("op2_mix_sources")
def op2(spark, sf_dir):
    return mix(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


@query("op3_shard")
def op3(spark, sf_dir):
    return shard_documents(documents(spark, sf_dir), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op4_ngram_join")
def op4(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "class_id", "class_size", "n_links")


OP5_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, trim(line, ' ') AS line, line AS raw, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS i FROM documents)
), windows AS (
  SELECT doc_id, i, 3 AS n, line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS content,
         words + lead(words, 1) OVER w + lead(words, 2) OVER w AS words
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)
  UNION ALL
  SELECT * FROM (SELECT doc_id, i, 2, line || chr(10) || lead(line, 1) OVER w, words + lead(words, 1) OVER w AS words
    FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)) WHERE words >= 50
  UNION ALL
  SELECT doc_id, i, 1, line, words FROM lines WHERE words >= 8
), first AS (
  SELECT doc_id, i, n,
         first_value(doc_id) OVER f AS first_doc, first_value(i) OVER f AS first_i
  FROM windows WHERE content IS NOT NULL AND words > 0
  WINDOW f AS (PARTITION BY content, n ORDER BY doc_id, i)
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i
  FROM first, range(0, 3) AS r(k)
  WHERE k < n AND (doc_id <> first_doc OR i >= first_i + n)
), marked AS (
  SELECT l.doc_id, l.i, l.raw, g.i IS NOT NULL AS gone
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_deleted,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS text_sha256
FROM marked GROUP BY doc_id
"""


@query("op5_line_dedup", OP5_SQL)
def op5(spark, sf_dir):
    return dedup_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_deleted", F.sha2("text", 256).alias("text_sha256")
    )


def _places(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _either_case(words: str) -> str:
    return re.sub("[a-z]", lambda c: f"[{c[0].upper()}{c[0]}]", words)


def _secret_matches(kind, number: int) -> str:
    pattern = kind.pattern
    if pattern.startswith("(?i)"):  # only A-Z fold there; the other engine would fold more
        names, rest = pattern[5:].split(")", 1)
        pattern = f"({_either_case(names)}){rest}"
    pattern = "'" + pattern.replace("'", "''") + "'"
    also = " AND ".join([f"length(value) >= {kind.least}", *[f"regexp_matches(value, '{p}')" for p in kind.also]])
    return f"""SELECT row, {number} AS number, '{kind.name}' AS kind, {kind.base} AS base, i, length(found[i]) AS chars,
    length(gaps[i]) AS gap, found_value[i] AS value, {also.replace("value", "found_value[i]")} AS good
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM (
    SELECT row, regexp_extract_all(text, {pattern}, 0) AS found, regexp_extract_all(text, {pattern}, {kind.group}) AS found_value,
      string_split_regex(text, {pattern}) AS gaps FROM docs WHERE regexp_matches(text, {pattern})))"""


OP6_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents),
matches AS ({" UNION ALL ".join(_secret_matches(kind, i) for i, kind in enumerate(KINDS))}),
placed AS (SELECT *, cast(sum(gap + chars) OVER (PARTITION BY row, number ORDER BY i) AS BIGINT) AS stop FROM matches),
matched AS (SELECT row, number, kind, base, stop - chars AS start, stop, value FROM placed WHERE good),
candidates AS (SELECT * FROM matched m WHERE base OR NOT EXISTS (
  SELECT 1 FROM matched b WHERE b.base AND b.row = m.row AND b.start < m.stop AND b.stop > m.start)),
owned AS (SELECT value, count(DISTINCT coalesce('=' || source, '~')) AS owners
  FROM candidates JOIN docs USING (row) GROUP BY value),
spans AS (SELECT candidates.*, owners, kind || ':' || start || ':' || stop AS span
  FROM candidates JOIN owned USING (value) WHERE base OR owners <= 2)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY start, number) FILTER (base), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY start, number), '') AS spans,
  count(*) FILTER (owners <= 2) AS n_live, count(*) FILTER (owners > 2) AS n_example, max(owners) AS most_owners
FROM docs d LEFT JOIN spans s ON d.row = s.row GROUP BY d.row, d.doc_id
"""


@query("op6_secret_scan", OP6_SQL)
def op6(spark, sf_dir):
    found = secret_spans(documents(spark, sf_dir)).withColumn("base", F.filter("spans", lambda s: s["base"]))

    def of_kind(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", of_kind("assign").alias("n_assign"), of_kind("access").alias("n_access"),
        of_kind("hex").alias("n_hex"), F.sha2(_places(F.col("base")), 256).alias("base_sha256"),
        _places(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("long").alias("n_example"),
        F.array_max(F.transform("spans", lambda s: s["owners"])).alias("most_owners"),
    )


OP7_SQL = r"""
WITH bare AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM bare
)
"""


@query("op7_exact_dedup", OP7_SQL)
def op7(spark, sf_dir):
    return exact_dedup(documents(spark, sf_dir))


@query("op8_nearest_neighbours")
def op8(spark, sf_dir):
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op9_language_id")
def op9(spark, sf_dir):
    return identify(documents(spark, sf_dir))


@query("op10_sentencepiece")
def op10(spark, sf_dir, model: str | None = None):
    import public_tokenizers

    model = model or public_tokenizers.path("piece_bpe_32k.model")
    return encode_documents(documents(spark, sf_dir), model, digests=True)


def _clusters_sql(k: int = 16, rounds: int = 3, dims: int = 64) -> str:
    """Each round as two stored steps: every vector to its nearest centroid, then the means."""
    square = "list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dims}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('1:' || vec_id) AS h, v FROM kept ORDER BY h, v LIMIT {k})
)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT * FROM (
    SELECT r, vec_id, c, d, k.v, row_number() OVER (PARTITION BY r ORDER BY d, c) AS place
    FROM (SELECT k.r, k.vec_id, k.v, c.c, {square.format(a="k.v", b="c.v")} AS d FROM kept k, c{i} c) k
  ) WHERE place = 1
)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(m.v, o.v) AS v
  FROM c{i} o LEFT JOIN (
    SELECT c, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY j) AS v
    FROM (SELECT c, j, sum(v[j]) AS s, count(*) AS n FROM (SELECT c, v, unnest(range(1, {dims + 1})) AS j FROM a{i}) GROUP BY c, j)
    GROUP BY c) m ON m.c = o.c
)""")
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, CAST(a.c AS INT) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.c
"""


@query("op11_centroid_clusters", _clusters_sql())
def op11(spark, sf_dir):
    found = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"),
    )


OP12_SQL = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (
  SELECT r, p, md5(substr(h, CAST(2 * p + 1 AS BIGINT), 800)) AS w
  FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 399)) AS p FROM docs)
), found AS (
  SELECT r, p, coalesce(p > lag(p) OVER (PARTITION BY r ORDER BY p) + 400, true) AS fresh
  FROM (SELECT r, p, count(*) OVER (PARTITION BY w) AS n FROM strings) WHERE n > 1
), spans AS (
  SELECT r, min(p) AS low, max(p) + 400 AS high
  FROM (SELECT r, p, sum(CAST(fresh AS INT)) OVER (PARTITION BY r ORDER BY p) AS k FROM found) GROUP BY r, k
), pieces AS (
  SELECT r, high, low, coalesce(lag(high) OVER (PARTITION BY r ORDER BY low), 0) AS since FROM spans
), cut AS (
  SELECT p.r, count(*) AS n_spans, sum(p.high - p.low) AS n_removed, max(p.high) AS stop,
         string_agg(substr(d.h, CAST(2 * since + 1 AS BIGINT), CAST(2 * (low - since) AS BIGINT)), '' ORDER BY low) AS kept
  FROM pieces p JOIN docs d ON d.r = p.r GROUP BY p.r
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN stop IS NULL THEN h ELSE kept || substr(h, CAST(2 * stop + 1 AS BIGINT)) END)) AS kept_sha256
FROM docs d LEFT JOIN cut c ON c.r = d.r
"""


@query("op12_suffix_dedup", OP12_SQL)
def op12(spark, sf_dir):
    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


OP13_SQL = r"""
WITH RECURSIVE bytes AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), harmed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role0, coalesce(text, ' ') AS text0,
         xor(list_reduce([4294967295] || list_transform(
               string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
               lambda x: CAST(ascii(x) AS BIGINT)),
             lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS harm
  FROM conversations, bytes
), copies AS (
  SELECT conv_id, turn, role0, text0, CASE WHEN harm = 4 THEN 'user' ELSE role0 END AS role,
         CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text0, '[.!?]', '', 'g') ELSE text0 END AS text,
         unnest(CASE WHEN harm = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM harmed WHERE harm <> 0
), turns AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role0, text0, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, role0, text0, copy) AS again
  FROM copies
), faults AS (
  SELECT *, left(role, 1) AS initial,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault
  FROM turns
), judged AS (
  SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS gone, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS broken,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM faults
), inserts(state, after, price, letters, lines) AS (  -- 0 start, 1 after s, 2 after u, 3 after a
  VALUES (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
         (0, 2, 5, 'I', ['user:']), (1, 2, 5, 'I', ['user:']), (2, 3, 5, 'I', ['assistant:']), (3, 2, 5, 'I', ['user:']),
         (0, 3, 10, 'II', ['user:', 'assistant:']), (1, 3, 10, 'II', ['user:', 'assistant:']),
         (2, 2, 10, 'II', ['assistant:', 'user:']), (3, 3, 10, 'II', ['user:', 'assistant:'])
), edits(state, letter, after, price, initial, role) AS (
  SELECT state, 'D', state, 2, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM (VALUES (0), (1), (2), (3)) AS s(state)
  UNION ALL VALUES (0, 'K', 1, 0, 's', NULL), (0, 'K', 2, 0, 'u', NULL), (1, 'K', 2, 0, 'u', NULL), (2, 'K', 3, 0, 'a', NULL),
         (3, 'K', 2, 0, 'u', NULL), (0, 'R', 2, 1, NULL, 'user'), (1, 'R', 2, 1, NULL, 'user'),
         (2, 'R', 3, 1, NULL, 'assistant'), (3, 'R', 2, 1, NULL, 'user')
), ways AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines
  FROM conversations
  UNION ALL
  SELECT conv_id, i, state, min(cost), arg_min(audit, lpad(CAST(cost AS VARCHAR), 12, '0') || audit),
         arg_min(lines, lpad(CAST(cost AS VARCHAR), 12, '0') || audit)
  FROM (
    SELECT w.conv_id, t.i, e.after AS state, w.cost + n.price + e.price + CASE WHEN e.letter = 'D' THEN 0 ELSE t.broken END AS cost,
           w.audit || n.letters || e.letter AS audit,
           w.lines || n.lines || CASE WHEN e.letter = 'D' THEN [] ELSE [coalesce(e.role, t.role) || ':' || t.text] END AS lines
    FROM ways w JOIN inserts n ON n.state = w.state JOIN edits e ON e.state = n.after
    JOIN judged t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1
    WHERE (e.letter = 'D' OR NOT t.gone) AND (e.initial IS NULL OR e.initial = t.initial)
  ) GROUP BY conv_id, i, state
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), ends AS (
  SELECT w.conv_id, w.cost + n.price AS cost, w.audit || n.letters AS audit, w.lines || n.lines AS lines
  FROM ways w JOIN inserts n ON n.state = w.state LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
  WHERE w.i = coalesce(c.n, 0) AND n.after IN (0, 3)
), best AS (
  SELECT conv_id, min(cost) AS cost, arg_min(audit, lpad(CAST(cost AS VARCHAR), 12, '0') || audit) AS audit,
         arg_min(lines, lpad(CAST(cost AS VARCHAR), 12, '0') || audit) AS lines
  FROM ends GROUP BY conv_id
)
SELECT b.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(cost AS BIGINT) AS cost, audit,
       sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM best b LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id
"""


@query("op13_conversation_repair", OP13_SQL)
def op13(spark, sf_dir):
    return repair(damaged(turns_of(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))
