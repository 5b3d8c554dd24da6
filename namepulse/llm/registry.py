"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    decontamination,
    html_text,
    licenses,
    packing,
    preferences,
    quality,
    repair,
    secrets,
    simhash,
    token_files,
    url_filters,
    warc,
    whitening,
)
from .shared import scratch_dir, table
from .tokens import public_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; rules learned from `labels`."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.fit(docs, table(spark, sf_dir, "labels"))
    s = quality.STATS
    return quality.judged(docs, rules).select(
        "doc_id",
        F.col(f"{s}.n_words").alias("n_words"),
        F.col(f"{s}.n_word_chars").alias("word_chars"),
        F.col(f"{s}.n_symbols").alias("n_symbols"),
        F.col(f"{s}.n_dup_lines").alias("n_dup_lines"),
        F.col(f"{s}.n_repeat_words").alias("n_repeat_words"),
        "base_failed",
        "kept",
        "rule",
    )


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as ORC and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scratch_dir(spark, "token-files")
    token_files.write(docs, out, public_path("byte_bpe_50k.json"))
    return token_files.digests(token_files.read(spark, out))


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License wording in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scanned(docs).select("doc_id", "license.*")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every overlap of a document with a benchmark item; clean documents have no row."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.overlaps(docs, table(spark, sf_dir, "benchmark"))


def op5_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with its neighbour's last reply."""
    found = preferences.conversations(table(spark, sf_dir, "conversations"))
    return preferences.formatted(preferences.swapped_replies(found)).withColumn(
        "prompt_turns", F.col("prompt_turns").cast("bigint")
    )


OP5_SQL = """
WITH given AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM given
), last AS (
  SELECT conv_id, max(k) AS k, arg_max(text, k) AS reply FROM t WHERE role = 'assistant' GROUP BY conv_id
), pair AS (
  SELECT c.conv_id, c.n, l.k AS last, l.reply AS own, coalesce(o.reply, '') AS other
  FROM (SELECT conv_id, max(k) AS n FROM t GROUP BY conv_id) c
  LEFT JOIN last l USING (conv_id) LEFT JOIN last o ON o.conv_id = xor(c.conv_id, 1)
), cut AS (
  SELECT *, CASE WHEN last IS NULL OR own = other THEN n ELSE last - 1 END AS prompt_turns FROM pair
), turns AS (
  SELECT c.conv_id, c.prompt_turns, t.k, t.role, '<|' || t.role || '|>' || chr(10) AS head, t.text AS a,
    CASE WHEN t.k = c.last THEN c.other ELSE t.text END AS b, '<|end|>' || chr(10) AS tail
  FROM cut c JOIN t USING (conv_id)
), placed AS (
  SELECT *, sum(length(head || a || tail)) OVER w AS a_end, sum(length(head || b || tail)) OVER w AS b_end
  FROM turns WHERE k > prompt_turns WINDOW w AS (PARTITION BY conv_id ORDER BY k)
), prompts AS (
  SELECT conv_id, any_value(prompt_turns) AS prompt_turns,
    coalesce(string_agg(head || a || tail, '' ORDER BY k) FILTER (k <= prompt_turns), '') AS prompt
  FROM turns GROUP BY conv_id
), completions AS (
  SELECT conv_id,
    string_agg(head || a || tail, '' ORDER BY k) AS chosen,
    string_agg(head || b || tail, '' ORDER BY k) AS rejected,
    string_agg((a_end - length(a || tail)) || ':' || a_end, ',' ORDER BY k) FILTER (role = 'assistant') AS chosen_spans,
    string_agg((b_end - length(b || tail)) || ':' || b_end, ',' ORDER BY k) FILTER (role = 'assistant') AS rejected_spans
  FROM placed GROUP BY conv_id
)
SELECT conv_id, prompt_turns, prompt, coalesce(chosen, '') AS chosen, coalesce(rejected, '') AS rejected,
  coalesce(chosen_spans, '') AS chosen_spans, coalesce(rejected_spans, '') AS rejected_spans
FROM prompts LEFT JOIN completions USING (conv_id)
"""


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 2048 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_path("word_bpe_49k.json"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_text.with_text(pages)
    return found.select(
        "page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("bigint").alias("n_chars")
    )


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document; models trained on what the fixed patterns find."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scanned(docs, secrets.fit(docs))
    by_kind = [F.col("secrets")[k] for k in secrets.KINDS]
    base = secrets.span_list(F.concat(*by_kind[:3]))
    counts = [F.size(c).cast("bigint").alias(f"n_{k}") for k, c in zip(secrets.KINDS, by_kind)]
    return found.select(
        "doc_id",
        *counts[:3],
        F.sha2(base, 256).alias("base_sha256"),
        secrets.span_list(F.concat(*by_kind)).alias("spans"),
        *counts[3:],
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived as a WARC record and read back."""
    out = scratch_dir(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), out)
    return warc.digests(warc.read(spark, out))


OP9_SQL = """
WITH rows AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM rows
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM firsts
"""


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every embedding, one row per component."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model, error = whitening.fit(vectors)
    found, name = whitening.whitened(vectors, model)
    explained = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    return found.select(
        "vec_id", F.col(name)["deviation"].alias("deviation"), F.posexplode(F.col(name)["components"])
    ).select(
        "vec_id",
        (F.col("pos") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        F.col("col").alias("whitened"),
        F.get(explained, F.col("pos")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after damage."""
    return repair.audited(repair.damaged(table(spark, sf_dir, "conversations")), "times")


def _op12_sql() -> str:
    """The best (cost and letters, repaired lines) of each state, row after row."""

    def more(state: str, cost: str, letter: str, line: str) -> str:
        total = f"lpad(CAST(CAST(substr({state}.k, 1, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0')"
        made = f"{{'k': {total} || substr({state}.k, 10) || '{letter}', 't': {state}.t || {line}}}"
        return f"CASE WHEN {state} IS NOT NULL THEN {made} END"

    def kept_as(initial: str, state: str) -> str:
        line = "role || ':' || text || chr(10)"
        return f"CASE WHEN NOT gone AND initial = '{initial}' THEN {more(state, 'late', 'K', line)} END"

    def reroled(role: str, state: str) -> str:
        return f"CASE WHEN NOT gone THEN {more(state, '3 + late', 'R', f"'{role}:' || text || chr(10)")} END"

    gone = [more(f"s{q}", "4", "D", "''") for q in range(4)]
    to_user = [f(w, q) for q in ("s0", "s1", "s3") for f, w in ((kept_as, "u"), (reroled, "user"))]
    into_user = [more(q, "3", "I", "'user:' || chr(10)") for q in ("n0", "n1", "n3")]
    return f"""
WITH RECURSIVE bits AS (
  SELECT conv_id, turn, role, text, flatten(list_transform(
      string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1])) AS b
  FROM conversations
), summed AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda c, x:
      CASE WHEN x >= 0 THEN xor(c, CAST(x AS BIGINT))
        ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END)) % 20 AS f
  FROM bits
), damaged AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN translate(coalesce(text, ' '), '.!?', '') ELSE coalesce(text, ' ') END AS text,
    unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM summed
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k,
    substr(role, 1, 1) AS initial,
    NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS is_blank,
    regexp_matches(text, '[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*$') AS is_cut
  FROM damaged
), seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS again,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY k) || initial AS pair
  FROM placed
), rows_in AS (
  SELECT conv_id, k, turn, role, text, initial, pair, is_blank, NOT is_blank AND again AS is_again,
    is_blank OR again AS gone, CASE WHEN is_cut AND NOT again THEN 3 ELSE 0 END AS late,
    max(k) OVER (PARTITION BY conv_id) AS n
  FROM seen
), facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_again) AS duplicate,
    count(*) FILTER (late > 0) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_in GROUP BY conv_id
), walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS k, {{'k': '000000000', 't': ''}} AS s0,
    CAST(NULL AS STRUCT(k VARCHAR, t VARCHAR)) AS s1, {{'k': '000000003I', 't': 'user:' || chr(10)}} AS s2,
    {{'k': '000000006II', 't': 'user:' || chr(10) || 'assistant:' || chr(10)}} AS s3
  FROM facts
  UNION ALL
  SELECT conv_id, k, n0, n1, m2, list_min([n3, {more("m2", "3", "I", "'assistant:' || chr(10)")}])
  FROM (
    SELECT *, list_min([n2, {", ".join(into_user)}]) AS m2 FROM (
      SELECT r.conv_id, r.k, {gone[0]} AS n0, list_min([{gone[1]}, {kept_as("s", "s0")}]) AS n1,
        list_min([{gone[2]}, {", ".join(to_user)}]) AS n2,
        list_min([{gone[3]}, {kept_as("a", "s2")}, {reroled("assistant", "s2")}]) AS n3
      FROM walk w JOIN rows_in r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.k = w.k + 1
    )
  )
), best AS (
  SELECT w.conv_id, list_min([s0, s3]) AS s FROM walk w
  JOIN (SELECT conv_id, max(k) AS n FROM rows_in GROUP BY conv_id) l
    ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.n = w.k
), given AS (SELECT DISTINCT conv_id FROM conversations)
SELECT g.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(CAST(substr(s.k, 1, 9) AS BIGINT), 0) AS cost, coalesce(substr(s.k, 10), '') AS audit,
  sha256(coalesce(substr(s.t, 1, greatest(length(s.t) - 1, 0)), '')) AS repaired_sha256
FROM given g LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM g.conv_id
  LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM g.conv_id
"""


URL_RULES = (
    url_filters.Rule("net", "/", True),
    url_filters.Rule("example.net", "/en/", False),
    url_filters.Rule("example.com", "/de/", True),
    url_filters.Rule("org", "/fr/", False),
)


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page; the rules' verdicts are the labels of the templates."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found, name = url_filters.judged(pages, URL_RULES)
    return found.select("page_id", f"{name}.*")


def _op13_sql() -> str:
    """Level by level, as many as the tree has at most."""
    bound = f"CAST({url_filters.BOUND!r} AS DOUBLE)"

    def near(a: str, of_a: str, b: str, of_b: str) -> str:
        return f"""CASE WHEN {of_a} > 0 AND {of_b} > 0 THEN abs(({a}) / ({of_a}) - ({b}) / ({of_b}))
          < {bound} / sqrt({of_a}) + {bound} / sqrt({of_b}) ELSE false END"""

    similar = near("c.x", "(c.x + c.y)", "o.x", "(o.x + o.y)") + " AND " + near("c.z", "c.n", "o.z", "o.n")
    d = url_filters.MAX_DEPTH
    levels = "".join(
        f"""
), child{k} AS (
  SELECT host, t, s[{k + 1}] AS seg, sum(n) AS n, sum(x) AS x, sum(y) AS y,
    sum(CASE WHEN len(s) > {k + 1} THEN n ELSE 0 END) AS z
  FROM p{k} WHERE len(s) > {k} GROUP BY ALL
), node{k} AS (
  SELECT host, t, sum(n) AS n FROM child{k} GROUP BY ALL
), literal{k} AS (
  SELECT c.*, row_number() OVER (PARTITION BY host, t ORDER BY c.n DESC, seg) AS r
  FROM child{k} c JOIN node{k} n USING (host, t)
  WHERE c.n >= {url_filters.MIN_PAGES} AND c.n * {url_filters.SHARE} >= n.n AND seg NOT IN ('*', '**')
), other{k} AS (
  SELECT host, t, seg, n, x, y, z, r FROM literal{k}
  UNION ALL
  SELECT host, t, '*', sum(n), sum(x), sum(y), sum(z), 0 FROM child{k}
  WHERE (host, t, seg) NOT IN (SELECT (host, t, seg) FROM literal{k}) GROUP BY host, t
), branch{k} AS (
  SELECT c.host, c.t, c.seg, coalesce(arg_min(o.seg, o.r), c.seg) AS branch
  FROM literal{k} c LEFT JOIN other{k} o ON o.host = c.host AND o.t = c.t AND o.r < c.r AND {similar}
  GROUP BY c.host, c.t, c.seg
), p{k + 1} AS (
  SELECT p.host, p.path, s, n, x, y,
    p.t || CASE WHEN len(s) > {k} THEN '/' || coalesce(l.branch, '*') ELSE '' END AS t
  FROM p{k} p LEFT JOIN branch{k} l ON l.host = p.host AND l.t = p.t AND l.seg = p.s[{k + 1}]"""
        for k in range(d)
    )
    smooth = f"{url_filters.WEIGHT * url_filters.PRIOR}) / (sum(x) + sum(y) + {url_filters.WEIGHT})"
    return f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
      '{url_filters.UPPER}', '{url_filters.LOWER}') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), ruled AS (
  SELECT *, '.' || host AS dotted, CASE
    WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts
), counted AS (
  SELECT host, path, list_filter(string_split(path, '/'), lambda g: g <> '') AS g, count(*) AS n,
    count(*) FILTER (rule IN ('net/', 'example.com/de/')) AS x,
    count(*) FILTER (rule IN ('example.net/en/', 'org/fr/')) AS y
  FROM ruled GROUP BY ALL
), p0 AS (
  SELECT host, path, CASE WHEN len(g) > {d} THEN list_append(g[1:{d}], '**') ELSE g END AS s, n, x, y, '' AS t
  FROM counted{levels}
), placed AS (
  SELECT host, path, x, y, t || CASE WHEN len(s) > {d} THEN '/**' ELSE '' END AS t FROM p{d}
), verdicts AS (
  SELECT host, t, (sum(x) + {smooth} > {url_filters.REJECTED} AS rejected FROM placed GROUP BY ALL
)
SELECT page_id, r.host, r.path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN rejected THEN 'block' ELSE 'allow' END AS verdict
FROM ruled r JOIN placed p ON p.host = r.host AND p.path = r.path
  JOIN verdicts v ON v.host = p.host AND v.t = p.t
"""


QUERIES: list[Query] = [
    op1_quality_rules,
    op2_token_files,
    op3_license_scans,
    op4_benchmark_decontamination,
    op5_preference_formatting,
    op6_best_fit_packing,
    op7_html_extraction,
    op8_secret_scans,
    op9_warc,
    op10_simhash_near_dedup,
    op11_embedding_whitening,
    op12_conversation_repair,
    op13_url_filters,
]

ORACLE: dict[str, str] = {
    "op5_preference_formatting": OP5_SQL,
    "op9_warc": OP9_SQL,
    "op12_conversation_repair": _op12_sql(),
    "op13_url_filters": _op13_sql(),
}
