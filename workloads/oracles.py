"""The registered queries once more, as SQL for DuckDB.

Common table expressions are named below and pulled in with what they need.
"""

from __future__ import annotations

import re

from loquent.functions import urls as U
from loquent.operators.abstractive import INSTRUCTION
from workloads.data import GAZETTEER_TYPES, LETTERS, LONG_WORD, PAIRED_WORD

# --- expressions ------------------------------------------------------------


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def words(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> '')"


def word_count(x: str) -> str:
    return f"CAST(len({words(x)}) AS BIGINT)"


def tokens(x: str) -> str:
    return rf"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}]+')"


def terms(x: str) -> str:
    return rf"regexp_extract_all(lower({x}), '\p{{L}}{{3,}}')"


def surface(x: str) -> str:
    return rf"regexp_extract_all({x}, '[\p{{L}}\p{{N}}]+(?:[-''][\p{{L}}\p{{N}}]+)*')"


def sentences(x: str) -> str:
    marked = rf"regexp_replace({strip(x)}, '([.!?])\s+', '\1' || chr(1), 'g')"
    return f"list_filter(string_split({marked}, chr(1)), lambda s: s <> '')"


def first_sentence(x: str) -> str:
    return f"coalesce({sentences(x)}[1], '')"


def lead(x: str, n: int = 6) -> str:
    return f"array_to_string(({words(x)})[1:{n}], ' ')"


def r(x: str, digits: int = 6) -> str:
    return f"round({x}, {digits})"


def host(x: str) -> str:
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?([^/?#:@]+)"
    return f"lower(regexp_extract({x}, '{pattern}', 1))"


def host_allowed(x: str, hosts: tuple[str, ...]) -> str:
    bare = rf"regexp_replace({host(x)}, '^www\.', '')"
    tests = [f"{bare} = '{h}' OR ends_with({bare}, '.{h}')" for h in hosts]
    return "(" + " OR ".join(tests) + ")"


def page_id(x: str) -> str:
    """Id by short link on example.org, by ``page`` parameter elsewhere."""
    path = (
        rf"regexp_replace(regexp_extract({x}, '^[a-z]+://[^/?#]*([^?#]*)', 1), "
        rf"'^/+|;[^/]*$', '', 'g')"
    )
    query = rf"regexp_extract({x}, '^[^?#]*\?([^#]*)', 1)"
    value = f"url_decode(regexp_extract({query}, '(?:^|&)page=([^&]+)', 1))"
    short = f"({host(x)} = 'example.org' OR ends_with({host(x)}, '.example.org'))"
    return f"nullif(CASE WHEN {short} THEN {path} ELSE {value} END, '')"


def letter_vector(x: str) -> str:
    counts = [f"(length({x}) - length(replace({x}, '{c}', '')))::DOUBLE" for c in LETTERS]
    return "[" + ", ".join(counts) + "]"


def dense_similarity(x: str, y: str) -> str:
    """Cosine of two vectors, 0 if one has no length."""
    scale = f"(sqrt(list_dot_product({x}, {x})) * sqrt(list_dot_product({y}, {y})))"
    return f"CASE WHEN {scale} > 0 THEN list_dot_product({x}, {y}) / {scale} ELSE 0.0 END"


def text_similarity(x: str, y: str) -> str:
    return (
        f"CASE WHEN {x} = '' AND {y} = '' THEN 1.0 WHEN {x} = '' OR {y} = '' THEN 0.0 "
        f"ELSE {dense_similarity(letter_vector(x), letter_vector(y))} END"
    )


def fmt_time(x: str) -> str:
    whole = f"CAST(trunc({x}) AS BIGINT)"
    return f"({whole} // 60) || ':' || lpad(CAST({whole} % 60 AS VARCHAR), 2, '0')"


# --- common table expressions -----------------------------------------------

CTES: dict[str, str] = {}

CTES["doc_seg"] = f"""
  SELECT CAST(doc_id AS VARCHAR) AS video_id, doc_id AS position,
         i - 1 AS segment_id, {strip('lines[i]')} AS text
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
       unnest(range(1, len(lines) + 1)) AS t(i)"""

CTES["talk_seg"] = f"""
  SELECT CAST(conv_id AS VARCHAR) AS video_id, conv_id AS position,
         turn AS segment_id, {strip('text')} AS text
  FROM conversations"""

CTES["talk_video"] = r"""
  SELECT CAST(conv_id AS VARCHAR) AS video_id, conv_id AS position,
         'https://www.youtube.com/watch?v=' || conv_id AS url,
         regexp_extract(min_by(text, turn), '^([^.!?,]*)[.!?]', 1) AS title,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(conv_id AS INTEGER))
           AS processed_at
  FROM conversations GROUP BY conv_id"""

CTES["star"] = """
  SELECT l_orderkey AS segment_id, CAST(o_custkey AS VARCHAR) AS video_id,
         p_brand AS entity_text, p_type AS entity_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey"""

CTES["mention"] = """
  SELECT DISTINCT segment_id, video_id, entity_text FROM star"""

CTES["pair"] = """
  SELECT a.entity_text AS entity_a, b.entity_text AS entity_b,
         a.video_id, a.segment_id
  FROM mention a JOIN mention b
    ON a.segment_id = b.segment_id AND a.entity_text < b.entity_text"""

CTES["pairs"] = """
  SELECT entity_a, entity_b, count(DISTINCT video_id) AS video_count,
         count(segment_id) AS segment_count
  FROM pair GROUP BY entity_a, entity_b"""

CTES["stored_node"] = """
  SELECT p_brand AS entity_text,
         CASE WHEN p_brand LIKE '%1' THEN upper(substr(p_brand, 1, 6))
              ELSE min(p_type) END AS entity_type
  FROM part WHERE p_brand NOT LIKE '%5' GROUP BY p_brand"""

_types = "[" + ", ".join(f"'{t}'" for t in GAZETTEER_TYPES) + "]"
CTES["gaz"] = f"""
  SELECT DISTINCT phrase,
         {_types}[length(phrase) % {len(GAZETTEER_TYPES)} + 1] AS entity_type
  FROM (
    SELECT unnest(w) AS phrase FROM (
      SELECT {surface('lower(text)')} AS w FROM benchmark)
    UNION ALL
    SELECT w[i] || ' ' || w[i + 1] FROM (
      SELECT {surface('lower(text)')} AS w FROM benchmark),
      unnest(range(1, len(w))) AS t(i)
    WHERE length(w[i]) >= {PAIRED_WORD} AND length(w[i + 1]) >= {PAIRED_WORD}
    UNION ALL
    SELECT array_to_string(w[i:i + 3], ' ') FROM (
      SELECT {surface('lower(text)')} AS w FROM benchmark),
      unnest(range(1, len(w) - 2)) AS t(i)
    WHERE length(w[i]) >= {PAIRED_WORD} AND length(w[i + 3]) >= {PAIRED_WORD})
  WHERE contains(phrase, ' ') OR length(phrase) >= {LONG_WORD}"""

_months = (
    "January|February|March|April|May|June|July|August|September|October"
    "|November|December"
)
_date = (
    rf"^(?:19|20)\d{{2}}$|^\d{{4}}-\d{{2}}-\d{{2}}$"
    rf"|^(?:{_months}) \d{{1,2}}(?: (?:19|20)\d{{2}})?$"
)


def _mention_ctes(prefix: str) -> None:
    """Typed phrases of ``<prefix>_seg`` without those inside longer ones."""
    CTES[f"{prefix}_phrase"] = f"""
  SELECT video_id, segment_id, i - 1 AS position, n AS length,
         array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT video_id, segment_id, {surface('text')} AS w FROM {prefix}_seg),
       unnest(range(1, len(w) + 1)) AS t(i), unnest(range(1, 1 + (SELECT greatest(3, max(len(string_split(phrase, ' ')))) FROM gaz))) AS u(n)
  WHERE i + n - 1 <= len(w)"""
    CTES[f"{prefix}_typed"] = f"""
  SELECT p.*, g.entity_type
  FROM {prefix}_phrase p JOIN gaz g ON lower(p.phrase) = g.phrase
  UNION
  SELECT *, 'DATE' FROM {prefix}_phrase WHERE regexp_matches(phrase, '{_date}')"""
    CTES[f"{prefix}_mention"] = f"""
  SELECT video_id, segment_id, position, phrase AS entity_text, entity_type
  FROM {prefix}_typed m
  WHERE NOT EXISTS (
    SELECT 1 FROM {prefix}_typed o
    WHERE o.video_id = m.video_id AND o.segment_id = m.segment_id
      AND o.length > m.length AND o.position <= m.position
      AND o.position + o.length >= m.position + m.length)"""
    CTES[f"{prefix}_first"] = f"""
  SELECT video_id, segment_id, entity_text, entity_type,
         min(position) AS position
  FROM {prefix}_mention GROUP BY ALL"""
    CTES[f"{prefix}_entity"] = f"""
  SELECT * FROM {prefix}_first
  WHERE entity_type IN ('PERSON', 'ORG', 'GPE', 'DATE', 'PRODUCT')"""


def _topic_ctes(prefix: str) -> None:
    """Lexical distances and topics of ``<prefix>_seg``."""
    CTES[f"{prefix}_timed"] = f"""
  SELECT *, (so_far - n_words) * 0.4::DOUBLE AS start_time,
         so_far * 0.4::DOUBLE AS end_time
  FROM (SELECT *, sum(n_words) OVER (PARTITION BY video_id ORDER BY segment_id)
               AS so_far
        FROM (SELECT *, {word_count('text')} AS n_words FROM {prefix}_seg))"""
    CTES[f"{prefix}_tf"] = f"""
  SELECT video_id, segment_id, term, count(*) AS tf
  FROM (SELECT video_id, segment_id, unnest({tokens('text')}) AS term
        FROM {prefix}_seg)
  GROUP BY ALL"""
    CTES[f"{prefix}_sq"] = f"""
  SELECT video_id, segment_id, CAST(sum(tf * tf) AS DOUBLE) AS sq
  FROM {prefix}_tf GROUP BY ALL"""
    CTES[f"{prefix}_order"] = f"""
  SELECT video_id, segment_id,
         lag(segment_id) OVER (PARTITION BY video_id ORDER BY segment_id)
           AS before_id
  FROM {prefix}_seg"""
    CTES[f"{prefix}_dot"] = f"""
  SELECT o.video_id, o.segment_id, CAST(sum(a.tf * b.tf) AS DOUBLE) AS ab
  FROM {prefix}_order o
  JOIN {prefix}_tf a ON a.video_id = o.video_id AND a.segment_id = o.segment_id
  JOIN {prefix}_tf b ON b.video_id = o.video_id AND b.segment_id = o.before_id
    AND b.term = a.term
  GROUP BY ALL"""
    CTES[f"{prefix}_distance"] = f"""
  SELECT o.video_id, o.segment_id,
         CASE WHEN o.before_id IS NULL THEN NULL
              WHEN a.sq IS NULL AND b.sq IS NULL THEN 0.0
              WHEN a.sq IS NULL OR b.sq IS NULL THEN 1.0
              ELSE 1 - coalesce(d.ab, 0) / sqrt(a.sq * b.sq) END AS distance
  FROM {prefix}_order o
  LEFT JOIN {prefix}_sq a ON a.video_id = o.video_id AND a.segment_id = o.segment_id
  LEFT JOIN {prefix}_sq b ON b.video_id = o.video_id AND b.segment_id = o.before_id
  LEFT JOIN {prefix}_dot d ON d.video_id = o.video_id AND d.segment_id = o.segment_id"""
    _label_ctes(prefix, "", 1.0)
    _label_ctes(prefix, "_k0", 0.0)


def _label_ctes(prefix: str, suffix: str, k: float) -> None:
    CTES[f"{prefix}_limit{suffix}"] = f"""
  SELECT video_id, count(distance) AS n_distances,
         avg(distance) AS mean_distance, stddev_samp(distance) AS stdev_distance,
         CASE WHEN count(distance) >= 2
              THEN avg(distance) + {k}::DOUBLE * stddev_samp(distance)
              ELSE 'Infinity'::DOUBLE END AS threshold
  FROM {prefix}_distance GROUP BY video_id"""
    CTES[f"{prefix}_topic{suffix}"] = f"""
  SELECT d.video_id, d.segment_id,
         'topic_' || sum(CASE WHEN distance > threshold + 1e-9 THEN 1 ELSE 0 END)
           OVER (PARTITION BY d.video_id ORDER BY d.segment_id) AS topic_label
  FROM {prefix}_distance d JOIN {prefix}_limit{suffix} USING (video_id)"""


def _summary_ctes(prefix: str, suffix: str = "") -> None:
    """Topic texts and the sentence with most of a topic's main terms."""
    CTES[f"{prefix}_text{suffix}"] = f"""
  SELECT video_id, topic_label AS topic_key,
         string_agg(text, chr(10) ORDER BY segment_id) AS topic_text
  FROM {prefix}_seg JOIN {prefix}_topic{suffix} USING (video_id, segment_id)
  WHERE text <> '' GROUP BY ALL"""
    CTES[f"{prefix}_key{suffix}"] = f"""
  SELECT DISTINCT video_id, topic_label AS topic_key FROM {prefix}_topic{suffix}"""
    CTES[f"{prefix}_main{suffix}"] = f"""
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY video_id, topic_key
                                 ORDER BY n DESC, term) AS rn
    FROM (SELECT video_id, topic_label AS topic_key, term, count(*) AS n
          FROM (SELECT video_id, topic_label, unnest({terms('text')}) AS term
                FROM {prefix}_seg JOIN {prefix}_topic{suffix}
                  USING (video_id, segment_id))
          GROUP BY ALL))
  WHERE rn <= 10"""
    CTES[f"{prefix}_said{suffix}"] = f"""
  SELECT video_id, segment_id, topic_label AS topic_key, unnest(s) AS sentence,
         generate_subscripts(s, 1) AS place
  FROM (SELECT video_id, segment_id, topic_label, {sentences('text')} AS s
        FROM {prefix}_seg JOIN {prefix}_topic{suffix} USING (video_id, segment_id))"""
    CTES[f"{prefix}_rated{suffix}"] = f"""
  SELECT video_id, topic_key, segment_id, place, sentence,
         coalesce(sum(CASE WHEN list_contains(own, term) THEN n END), 0) AS score
  FROM (SELECT *, {terms('sentence')} AS own FROM {prefix}_said{suffix})
  LEFT JOIN {prefix}_main{suffix} USING (video_id, topic_key)
  GROUP BY video_id, topic_key, segment_id, place, sentence"""
    CTES[f"{prefix}_central{suffix}"] = f"""
  SELECT k.video_id, k.topic_key, coalesce(sentence, '') AS summary,
         coalesce({word_count('topic_text')}, 0) AS original_words
  FROM {prefix}_key{suffix} k
  LEFT JOIN {prefix}_text{suffix} USING (video_id, topic_key)
  LEFT JOIN (
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY video_id, topic_key
               ORDER BY score DESC, segment_id, place) AS best
      FROM {prefix}_rated{suffix})
    WHERE best = 1) USING (video_id, topic_key)"""


def _bag_similarity(source: str, left: str, right: str) -> str:
    """Lexical similarity of two text columns of ``source``, per segment."""
    side = "SELECT video_id, segment_id, unnest({t}) AS term, {a} AS a, {b} AS b FROM {s}"
    return f"""
  SELECT s.video_id, s.segment_id,
         CASE WHEN coalesce(aa, 0) = 0 AND coalesce(bb, 0) = 0 THEN 1.0
              WHEN coalesce(aa, 0) = 0 OR coalesce(bb, 0) = 0 THEN 0.0
              ELSE ab / sqrt(aa * bb) END AS semantic_similarity
  FROM {source} s LEFT JOIN (
    SELECT video_id, segment_id, CAST(sum(a * b) AS DOUBLE) AS ab,
           CAST(sum(a * a) AS DOUBLE) AS aa, CAST(sum(b * b) AS DOUBLE) AS bb
    FROM (SELECT video_id, segment_id, term, sum(a) AS a, sum(b) AS b
          FROM ({side.format(t=tokens(left), a=1, b=0, s=source)}
                UNION ALL {side.format(t=tokens(right), a=0, b=1, s=source)})
          GROUP BY ALL)
    GROUP BY ALL) n USING (video_id, segment_id)"""


def _score_ctes(prefix: str, suffix: str = "") -> None:
    """Segments with first-sentence and central summaries and metrics."""
    base = f"{prefix}_base{suffix}"
    CTES[base] = f"""
  SELECT t.*, l.topic_label, {first_sentence('t.text')} AS ext_summary,
         s.summary AS abs_summary, s.original_words
  FROM {prefix}_timed t JOIN {prefix}_topic{suffix} l USING (video_id, segment_id)
  JOIN {prefix}_central{suffix} s
    ON s.video_id = t.video_id AND s.topic_key = l.topic_label"""
    CTES[f"{prefix}_sim{suffix}"] = _bag_similarity(base, "ext_summary", "abs_summary")
    # The last of equal sentences counts, so look the place up from the end.
    place = f"list_position(list_reverse({sentences('text')}), ext_summary)"
    CTES[f"{prefix}_scored{suffix}"] = f"""
  SELECT b.*, semantic_similarity,
         CASE WHEN ext_summary <> '' THEN
           0.0 - CAST(len({sentences('text')}) - {place} AS DOUBLE) END
           AS textrank_score,
         CASE WHEN original_words > 0 THEN
           {word_count('abs_summary')} / original_words::DOUBLE END
           AS compression_ratio
  FROM {base} b JOIN {prefix}_sim{suffix} USING (video_id, segment_id)"""


def _rank_ctes(prefix: str) -> None:
    """TextRank of ``<prefix>_seg``, one expression per round."""
    keys = "video_id, segment_id"
    CTES[f"{prefix}_term"] = f"""
  SELECT {keys}, unnest(w) AS term, generate_subscripts(w, 1) AS pos
  FROM (SELECT {keys}, {terms('text')} AS w FROM {prefix}_seg)"""
    CTES[f"{prefix}_link"] = f"""
  SELECT {keys}, a, b, CAST(count(*) AS DOUBLE) AS w FROM (
    SELECT x.video_id, x.segment_id, unnest([x.term, y.term]) AS a,
           unnest([y.term, x.term]) AS b
    FROM {prefix}_term x JOIN {prefix}_term y
      ON x.video_id = y.video_id AND x.segment_id = y.segment_id
     AND y.pos BETWEEN x.pos + 1 AND x.pos + 3 AND x.term <> y.term)
  GROUP BY ALL"""
    CTES[f"{prefix}_share"] = f"""
  SELECT *, w / sum(w) OVER (PARTITION BY {keys}, b) AS share FROM {prefix}_link"""
    CTES[f"{prefix}_r0"] = f"""
  SELECT *, 1.0::DOUBLE / n AS rank FROM (
    SELECT *, count(*) OVER (PARTITION BY {keys}) AS n
    FROM (SELECT DISTINCT {keys}, term FROM {prefix}_term))"""
    for i in range(10):
        CTES[f"{prefix}_r{i + 1}"] = f"""
  SELECT t.video_id, t.segment_id, t.term, t.n,
         0.15::DOUBLE / t.n + 0.85::DOUBLE * coalesce(s.incoming, 0) AS rank
  FROM {prefix}_r0 t LEFT JOIN (
    SELECT l.video_id, l.segment_id, l.a, sum(l.share * f.rank) AS incoming
    FROM {prefix}_share l JOIN {prefix}_r{i} f
      ON f.video_id = l.video_id AND f.segment_id = l.segment_id AND f.term = l.b
    GROUP BY ALL) s
    ON s.video_id = t.video_id AND s.segment_id = t.segment_id AND s.a = t.term"""
    CTES[f"{prefix}_top"] = f"""
  SELECT {keys}, term, rank / sum(rank) OVER (PARTITION BY {keys}) AS rank FROM (
    SELECT *, row_number() OVER (
      PARTITION BY {keys} ORDER BY round(rank, 9) DESC, term) AS rn
    FROM {prefix}_r10) WHERE rn <= 10"""
    CTES[f"{prefix}_sentence"] = f"""
  SELECT {keys}, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS position
  FROM (SELECT {keys}, {sentences('text')} AS s FROM {prefix}_seg)"""
    CTES[f"{prefix}_sscore"] = f"""
  SELECT {keys}, position, sentence,
         0.0 - round(sqrt(coalesce(sum(
           CASE WHEN NOT list_contains(w, term) THEN rank * rank END), 0)), 9)
           AS score
  FROM (SELECT *, {terms('sentence')} AS w FROM {prefix}_sentence)
  LEFT JOIN {prefix}_top USING ({keys})
  GROUP BY {keys}, position, sentence"""
    CTES[f"{prefix}_best"] = f"""
  SELECT {keys}, coalesce(sentence, '') AS summary, best_score,
         coalesce(n_sentences, 0) AS n_sentences
  FROM {prefix}_seg LEFT JOIN (
    SELECT {keys}, count(*) AS n_sentences, max(score) AS best_score,
           arg_max(sentence, struct_pack(s := score, p := -position)) AS sentence
    FROM {prefix}_sscore GROUP BY ALL) USING ({keys})"""
    full = f"{prefix}_fbase"
    CTES[full] = f"""
  SELECT t.*, l.topic_label, b.summary AS ext_summary, b.best_score,
         s.summary AS abs_summary, s.original_words
  FROM {prefix}_timed t JOIN {prefix}_topic l USING ({keys})
  JOIN {prefix}_best b USING ({keys})
  JOIN {prefix}_central s ON s.video_id = t.video_id AND s.topic_key = l.topic_label"""
    CTES[f"{prefix}_fsim"] = _bag_similarity(full, "ext_summary", "abs_summary")
    # Equal sentences have equal scores, so the lookup finds the best score.
    CTES[f"{prefix}_full"] = f"""
  SELECT b.*, best_score AS textrank_score, semantic_similarity,
         CASE WHEN original_words > 0 THEN
           {word_count('abs_summary')} / original_words::DOUBLE END
           AS compression_ratio
  FROM {full} b JOIN {prefix}_fsim USING ({keys})"""


for _prefix in ("doc", "talk"):
    _topic_ctes(_prefix)
    _summary_ctes(_prefix)
    _mention_ctes(_prefix)
    _rank_ctes(_prefix)
_summary_ctes("doc", "_k0")
_score_ctes("doc")
_score_ctes("doc", "_k0")

# The same segments, with topics and similarity by letter counts.
CTES["let_seg"] = "SELECT * FROM doc_seg"
CTES["let_timed"] = "SELECT * FROM doc_timed"
CTES["let_distance"] = f"""
  SELECT video_id, segment_id,
         CASE WHEN before IS NOT NULL THEN 1 - {dense_similarity('v', 'before')} END
           AS distance
  FROM (SELECT *, lag(v) OVER (PARTITION BY video_id ORDER BY segment_id) AS before
        FROM (SELECT video_id, segment_id, {letter_vector('text')} AS v FROM let_seg))"""
_label_ctes("let", "", 1.0)
_summary_ctes("let")
_score_ctes("let")
CTES["let_sim"] = f"""
  SELECT video_id, segment_id,
         {text_similarity('ext_summary', 'abs_summary')} AS semantic_similarity
  FROM let_base"""

CTES["vec_distance"] = """
  SELECT CAST(label AS VARCHAR) AS video_id, vec_id AS segment_id,
         1 - list_dot_product(e, before)
           / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(before, before)))
           AS distance
  FROM (SELECT *, lag(e) OVER (PARTITION BY label ORDER BY vec_id) AS before
        FROM (SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS e
              FROM embeddings))"""
_label_ctes("vec", "", 1.0)

CTES["doc_global"] = """
  SELECT video_id, text,
         row_number() OVER (ORDER BY position, segment_id) - 1 AS segment_id
  FROM doc_seg"""
CTES["talk_id"] = """
  SELECT video_id, segment_id AS local_id,
         row_number() OVER (ORDER BY position, segment_id) - 1 AS segment_id
  FROM talk_seg"""
CTES["talk_global"] = """
  SELECT t.* EXCLUDE (segment_id), i.segment_id
  FROM talk_timed t JOIN talk_id i
    ON i.video_id = t.video_id AND i.local_id = t.segment_id"""
CTES["star_first"] = """
  SELECT segment_id, video_id, entity_text, entity_type FROM star GROUP BY ALL"""
CTES["page_list"] = f"""
  SELECT *, row_number() OVER (PARTITION BY list_id ORDER BY page_id) AS position,
         count(*) OVER (PARTITION BY list_id) AS total
  FROM (SELECT {host('url')} AS list_id, page_id, url FROM pages)"""
CTES["outcome"] = f"""
  SELECT position, url, video_id, NULL AS error FROM talk_video
  UNION ALL
  SELECT -page_id - 1, url,
         nullif(url_decode(regexp_extract(url, '[?&]v=([^&#]+)', 1)), ''),
         '{U.WRONG_HOST_MESSAGE}' || url
  FROM pages"""
CTES["star_node"] = """
  SELECT p_brand AS entity_text, min(p_type) AS entity_type
  FROM part WHERE p_brand NOT LIKE '%5' GROUP BY ALL"""
CTES["star_edge"] = """
  SELECT * FROM pairs
  WHERE entity_a IN (SELECT entity_text FROM star_node)
    AND entity_b IN (SELECT entity_text FROM star_node)"""
CTES["label_video"] = """
  SELECT CAST(doc_id AS VARCHAR) AS video_id, quality, toxic FROM labels"""


def _needed(sql: str, found: dict[str, None]) -> None:
    """Names of the expressions ``sql`` uses, each after those it needs."""
    for name in re.findall(r"[a-z]\w*", sql):
        if name in CTES and name not in found:
            _needed(CTES[name], found)
            found.setdefault(name)


def _sql(final: str) -> str:
    names: dict[str, None] = {}
    _needed(final, names)
    if not names:
        return final.strip()
    parts = ",\n".join(f"{name} AS ({CTES[name]})" for name in names)
    return f"WITH {parts}\n{final.strip()}"


# --- one statement per query ------------------------------------------------

_pages = ("example.com", "blog.ththan.example.net")
_metrics = (
    "textrank_score, "
    "round(compression_ratio, 6) AS compression_ratio, "
    "round(semantic_similarity, 6) AS semantic_similarity"
)
_times = "round(start_time, 6) AS start_time, round(end_time, 6) AS end_time"
_averages = (
    "round(avg(compression_ratio), 6) AS avg_compression_ratio, "
    "round(avg(semantic_similarity), 6) AS avg_semantic_similarity"
)
_pair_cols = "entity_a, entity_b, video_count, segment_count"
_valid_shape = (
    r"(regexp_matches(u, '^https://(www\.)?youtube\.com/watch\?.*v=[\w-]+') OR "
    r"regexp_matches(u, '^https://youtu\.be/[\w-]+') OR "
    r"regexp_matches(u, '^https://(www\.)?youtube\.com/playlist\?.*list=[\w-]+'))"
)
_divergent = (
    "substr(ext_summary, 1, 70) AS extractive, "
    "substr(abs_summary, 1, 70) AS abstractive"
)
_star_numbered = """
    SELECT row_number() OVER (ORDER BY segment_id, {place} entity_text, entity_type)
             - 1 + {start} AS entity_id, segment_id, video_id, entity_text, entity_type
           {extra}
    FROM star_first"""

FINALS: dict[str, str] = {
    "segment_source": f"SELECT video_id, segment_id, {_times}, text FROM doc_timed",
    "url_list_source": f"SELECT {strip('url')} AS url FROM pages",
    "json_segments": "SELECT conv_id * 1000 + turn AS segment_id, text FROM conversations",
    "append_segments": f"""
        SELECT segment_id, video_id, {_times}, text, NULL::VARCHAR AS topic_label
        FROM talk_global""",
    "append_entities": _star_numbered.format(place="", start=0, extra=""),
    "append_videos": "SELECT video_id, url, title, processed_at FROM talk_video",
    "table_bootstrap": """
        SELECT 'videos' AS table_name, 4::BIGINT AS n_columns, count(*) AS n_rows
        FROM talk_video
        UNION ALL SELECT 'segments', 11, count(*) FROM talk_seg
        UNION ALL SELECT 'entities', 5, 0 UNION ALL SELECT 'co_occurrences', 4, 0""",
    "replace_pairs": f"SELECT {_pair_cols} FROM pairs WHERE video_count >= 300",
    "scan_segments": "SELECT segment_id, video_id, text FROM talk_global",
    "scan_video": """
        SELECT segment_id, video_id, text FROM talk_global WHERE video_id = '7'""",
    "scan_entities": """
        SELECT segment_id, video_id, entity_text, entity_type FROM talk_entity""",
    "scan_pairs": f"SELECT {_pair_cols} FROM pairs",
    "delete_video": """
        SELECT video_id, count(*) AS segments FROM doc_seg
        WHERE video_id NOT IN (SELECT video_id FROM label_video WHERE toxic = 1)
        GROUP BY ALL""",
    "compact_segments": """
        SELECT video_id, segment_id, text FROM doc_seg
        WHERE video_id NOT IN (SELECT video_id FROM label_video WHERE toxic = 1)""",
    "graph_nodes": """
        SELECT coalesce(f.entity_text, o.p_name) AS entity_text,
               coalesce(f.entity_type, o.p_type) AS entity_type
        FROM (SELECT entity_text, min(entity_type) AS entity_type
              FROM star GROUP BY ALL) f
        FULL JOIN (SELECT p_name, min(p_type) AS p_type FROM part GROUP BY ALL) o
          ON f.entity_text = o.p_name""",
    "graph_edges": f"""
        SELECT {_pair_cols} FROM star_edge
        UNION ALL
        SELECT entity_a, entity_b, video_count, 0 FROM pairs
        WHERE segment_count >= 20 AND NOT EXISTS (
          SELECT 1 FROM star_edge e
          WHERE e.entity_a = pairs.entity_a AND e.entity_b = pairs.entity_b)""",
    "stored_graph_nodes": """
        SELECT entity_text, entity_type FROM stored_node""",
    "stored_graph_triples": """
        SELECT p.entity_a, a.entity_type AS type_a, p.entity_b,
               b.entity_type AS type_b, video_count,
               CASE WHEN segment_count >= 20 THEN segment_count ELSE 0 END
                 AS segment_count
        FROM pairs p JOIN stored_node a ON a.entity_text = p.entity_a
        JOIN stored_node b ON b.entity_text = p.entity_b""",
    "graph_triples": """
        SELECT entity_a, a.entity_type AS type_a, entity_b, b.entity_type AS type_b,
               video_count, segment_count
        FROM star_edge JOIN star_node a ON a.entity_text = entity_a
        JOIN star_node b ON b.entity_text = entity_b""",
    "video_exists": """
        SELECT CAST(doc_id AS VARCHAR) AS video_id,
               doc_id IN (SELECT conv_id FROM conversations) AS stored
        FROM documents""",
    "skip_processed": """
        SELECT CAST(doc_id AS VARCHAR) AS video_id,
               'https://www.youtube.com/watch?v=' || doc_id AS url
        FROM documents WHERE doc_id NOT IN (SELECT conv_id FROM conversations)""",
    "filter_isin": """
        SELECT video_id, segment_id, text FROM doc_seg
        WHERE video_id IN (SELECT video_id FROM label_video WHERE quality = 1)""",
    "entity_allowlist": """
        SELECT video_id, segment_id, entity_text, entity_type,
               entity_type IN ('PERSON', 'ORG', 'GPE', 'DATE', 'PRODUCT') AS allowed
        FROM doc_mention""",
    "url_host": f"SELECT page_id, {host('url')} AS host FROM pages",
    "url_host_allowed": f"""
        SELECT page_id, {host_allowed('url', _pages)} AS allowed FROM pages""",
    "url_is_list": """
        SELECT page_id, contains(url, 'list=') OR NOT contains(url, '?') AS is_list
        FROM pages""",
    "url_validate": f"""
        SELECT page_id, form, {_valid_shape} AS ok,
               CASE WHEN u = '' THEN '{U.EMPTY_URL_MESSAGE}'
                    WHEN NOT {_valid_shape} THEN '{U.WRONG_URL_MESSAGE}'
                    WHEN contains(u, 'list=') THEN 'playlist' ELSE 'video' END AS kind
        FROM (SELECT page_id, form, {strip('raw')} AS u FROM (
          SELECT page_id, unnest(range(6)) AS form, unnest([
            url, '  https://www.youtube.com/watch?v=' || page_id || ' ',
            'https://youtu.be/' || page_id,
            'https://youtube.com/playlist?list=' || page_id,
            'http://www.youtube.com/watch?v=' || page_id, '  ']) AS raw
          FROM pages))""",
    "url_video_id": f"SELECT page_id, {page_id('url')} AS video_id FROM pages",
    "expand_list": """
        SELECT list_id, entry_index, 'https://www.youtube.com/watch?v=' || id AS url
        FROM (SELECT CAST(doc_id AS VARCHAR) AS list_id, i - 1 AS entry_index,
                     regexp_extract(lines[i], '([0-9]+)', 1) AS id
              FROM (SELECT doc_id, string_split(text, chr(10)) AS lines
                    FROM documents), unnest(range(1, len(lines) + 1)) AS t(i))
        WHERE id <> ''""",
    "list_position": """
        SELECT list_id, page_id AS entry_index, position, total FROM page_list""",
    "parse_outcomes": f"""
        SELECT position, total, coalesce({page_id('url')}, 'unknown') AS video_id,
               {host_allowed('url', _pages)} AS ok
        FROM page_list""",
    "entity_mentions": "SELECT segment_id, video_id, entity_text FROM mention",
    "entity_pairs": "SELECT entity_a, entity_b, video_id, segment_id FROM pair",
    "co_occurrences": f"SELECT {_pair_cols} FROM pairs",
    "pairs_min_videos": f"SELECT {_pair_cols} FROM pairs WHERE video_count >= 300",
    "top_pairs": f"""
        SELECT {_pair_cols} FROM pairs
        ORDER BY segment_count DESC, entity_a, entity_b LIMIT 30""",
    "pair_lines": """
        SELECT entity_a || ' <-> ' || entity_b || ': ' || video_count || ' videos, '
               || segment_count || ' segments' AS line
        FROM pairs""",
    "co_occurrence_job": f"""
        SELECT {_pair_cols} FROM pairs WHERE video_count >= 300
        ORDER BY segment_count DESC, entity_a, entity_b LIMIT 30""",
    "entity_dedup": """
        SELECT video_id, segment_id, entity_text, entity_type, position
        FROM doc_first""",
    "extract_entities": """
        SELECT video_id, segment_id, entity_text, entity_type, position
        FROM doc_entity""",
    "top_entities": """
        SELECT *, entity_text || ' (' || entity_type || '): ' || mentions AS line
        FROM (SELECT video_id, entity_text, entity_type, count(*) AS mentions,
                     row_number() OVER (PARTITION BY video_id
                       ORDER BY count(*) DESC, entity_text, entity_type) AS place
              FROM star GROUP BY video_id, entity_text, entity_type)
        WHERE place <= 10""",
    "entity_frequency": """
        SELECT video_id, entity_text, entity_type, count(*) AS mentions
        FROM star GROUP BY ALL""",
    "unique_entities": """
        SELECT count(DISTINCT entity_text) AS unique_entities FROM star""",
    "term_counts": "SELECT video_id, segment_id, term, tf FROM doc_tf",
    "term_norms": """
        SELECT s.video_id, s.segment_id, round(coalesce(sqrt(sq), 0), 6) AS norm
        FROM doc_seg s LEFT JOIN doc_sq USING (video_id, segment_id)""",
    "dense_cosine": """
        SELECT CAST(label AS VARCHAR) AS video_id, vec_id AS segment_id,
               round(list_dot_product(e, mean) / (sqrt(list_dot_product(e, e))
                     * sqrt(list_dot_product(mean, mean))), 6) AS cosine
        FROM (SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
        JOIN (SELECT label, list(m ORDER BY i) AS mean
              FROM (SELECT label, i, avg(x) AS m
                    FROM (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x,
                                 generate_subscripts(embedding, 1) AS i
                          FROM embeddings) GROUP BY ALL) GROUP BY label)
          USING (label)""",
    "adjacent_distance": """
        SELECT video_id, segment_id, round(distance, 6) AS distance
        FROM vec_distance""",
    "adjacent_distance_lexical": """
        SELECT video_id, segment_id, round(distance, 6) AS distance
        FROM doc_distance""",
    "topic_threshold": """
        SELECT video_id, n_distances, round(mean_distance, 6) AS mean_distance,
               round(stdev_distance, 6) AS stdev_distance,
               round(threshold, 6) AS threshold
        FROM doc_limit""",
    "topic_segments": "SELECT video_id, segment_id, topic_label FROM doc_topic",
    "topic_segments_k0": "SELECT video_id, segment_id, topic_label FROM doc_topic_k0",
    "topic_segments_dense": "SELECT video_id, segment_id, topic_label FROM vec_topic",
    "attach_topic": """
        SELECT video_id, segment_id, text, topic_label
        FROM doc_seg JOIN doc_topic USING (video_id, segment_id)""",
    "topic_text": "SELECT video_id, topic_key, topic_text FROM doc_text",
    "summary_prompt": f"""
        SELECT video_id, topic_key,
               '{INSTRUCTION}' || chr(10) || chr(10) || coalesce(topic_text, '')
                 AS prompt
        FROM doc_key LEFT JOIN doc_text USING (video_id, topic_key)""",
    "topic_summary": """
        SELECT t.video_id, t.segment_id, summary
        FROM doc_topic t JOIN doc_central l
          ON l.video_id = t.video_id AND l.topic_key = t.topic_label""",
    "sentence_split": """
        SELECT video_id, segment_id, position, sentence FROM doc_sentence""",
    "key_terms": """
        SELECT video_id, segment_id, term, round(rank, 6) AS rank FROM doc_top""",
    "extractive_summary": """
        SELECT video_id, segment_id, summary, n_sentences FROM doc_best""",
    "sentence_scores": """
        SELECT video_id, segment_id, position, sentence, score
        FROM doc_sscore""",
    "word_count": f"""
        SELECT video_id, segment_id, {word_count('text')} AS words FROM doc_seg""",
    "compression_ratio": f"""
        SELECT video_id, segment_id,
               CASE WHEN {word_count('text')} > 0 THEN
                 round({word_count(first_sentence('text'))}
                       / CAST({word_count('text')} AS DOUBLE), 6) END
                 AS compression_ratio
        FROM doc_seg""",
    "semantic_similarity": f"""
        SELECT video_id, segment_id, round(semantic_similarity, 6)
                 AS semantic_similarity
        FROM ({_bag_similarity('doc_seg', 'text', first_sentence('text'))})""",
    "textrank_lookup": f"""
        SELECT video_id, segment_id,
               CASE WHEN len(s) > 0 THEN
                 CAST(len(s) - list_position(list_reverse(s), s[1]) AS DOUBLE) END
                 AS score
        FROM (SELECT video_id, segment_id, {sentences('text')} AS s FROM talk_seg)""",
    "compute_all": f"""
        SELECT video_id, segment_id,
               CASE WHEN {word_count('text')} > 0 THEN
                 round(least({word_count('text')}, 6)
                       / CAST({word_count('text')} AS DOUBLE), 6) END
                 AS compression_ratio,
               CASE WHEN len(s) > 0 THEN
                 0.0 - CAST(len(s) - list_position(list_reverse(s), s[1]) AS DOUBLE)
               END AS textrank_score,
               round(semantic_similarity, 6) AS semantic_similarity
        FROM (SELECT *, {sentences('text')} AS s FROM talk_seg)
        JOIN ({_bag_similarity('talk_seg', first_sentence('text'), lead('text'))})
          USING (video_id, segment_id)""",
    "fmt_time": f"SELECT event_id, {fmt_time('value * 10')} AS shown FROM events",
    "max_id": "SELECT max(segment_id) AS max_id FROM doc_global",
    "global_segment_ids": """
        SELECT video_id, segment_id + 100 AS segment_id, text FROM doc_global""",
    "global_segment_ids_hashed": """
        SELECT video_id, row_number() OVER (
                 ORDER BY substr(md5(video_id), 1, 8), video_id, segment_id) - 1
                 AS segment_id, text
        FROM doc_seg""",
    "global_entity_ids": _star_numbered.format(
        place="length(entity_text),",
        start=50,
        extra=", length(entity_text) AS position",
    ),
    "merge_nlp": f"""
        SELECT video_id, segment_id, {_times}, text, topic_label, ext_summary,
               abs_summary, {_metrics}
        FROM doc_scored""",
    "video_stats": f"""
        SELECT video_id, count(*) AS segments,
               count(DISTINCT topic_label) AS topics, {_averages},
               coalesce(printf('Avg compression ratio: %.2f · Avg semantic similarity: %.2f',
                 round(avg(compression_ratio), 6), round(avg(semantic_similarity), 6)), '') AS averages
        FROM doc_scored GROUP BY video_id""",
    "corpus_stats": f"""
        SELECT count(*) AS segments,
               count(DISTINCT video_id || '/' || topic_label) AS topics, {_averages}
        FROM doc_scored""",
    "topic_timeline": """
        SELECT video_id, topic_label, round(min(start_time), 6) AS start_time,
               round(max(end_time), 6) AS end_time, count(*) AS segments,
               min(abs_summary) AS summary, min(segment_id) AS first_segment
        FROM doc_scored GROUP BY video_id, topic_label""",
    "topic_timeline_capped": f"""
        SELECT video_id, place, {fmt_time('start_time')} AS start,
               {fmt_time('end_time')} AS end, segments,
               substr(summary, 1, 160) AS summary, greatest(topics - 30, 0) AS hidden
        FROM (SELECT *, row_number() OVER (PARTITION BY video_id
                          ORDER BY start_time, first_segment) AS place,
                     count(*) OVER (PARTITION BY video_id) AS topics
              FROM (SELECT video_id, topic_label, min(start_time) AS start_time,
                           max(end_time) AS end_time, count(*) AS segments,
                           min(abs_summary) AS summary,
                           min(segment_id) AS first_segment
                    FROM doc_scored_k0 GROUP BY video_id, topic_label))
        WHERE place <= 30""",
    "most_divergent": f"""
        SELECT video_id, segment_id,
               round(semantic_similarity, 6) AS semantic_similarity, {_divergent}
        FROM doc_scored WHERE semantic_similarity IS NOT NULL
        ORDER BY doc_scored.semantic_similarity, video_id, segment_id LIMIT 1""",
    "most_divergent_per_video": f"""
        SELECT video_id, segment_id,
               round(semantic_similarity, 6) AS semantic_similarity, {_divergent}
        FROM (SELECT *, row_number() OVER (PARTITION BY video_id
                ORDER BY semantic_similarity, segment_id) AS rn FROM doc_scored
              WHERE semantic_similarity IS NOT NULL)
        WHERE rn = 1""",
    "history": """
        SELECT coalesce(nullif(title, ''), '(untitled)') AS title, processed_at,
               video_id
        FROM talk_video ORDER BY processed_at DESC, video_id""",
    "enrich_segments_dense": f"""
        SELECT video_id, segment_id, {_times}, text, topic_label, ext_summary,
               abs_summary, {_metrics}
        FROM let_scored""",
    "enrich_segments": f"""
        SELECT video_id, segment_id, {_times}, text, topic_label, ext_summary,
               abs_summary, {_metrics}
        FROM doc_full""",
    "run_all": """
        SELECT 'extractive_summary' AS processor, video_id, segment_id,
               summary AS value
        FROM talk_best
        UNION ALL SELECT 'entities', video_id, segment_id,
                         entity_type || '/' || entity_text FROM talk_entity
        UNION ALL SELECT 'topic_segmenter', video_id, segment_id, topic_label
                  FROM talk_topic
        UNION ALL SELECT 'abstractive_summary', t.video_id, t.segment_id, summary
                  FROM talk_topic t JOIN talk_central l
                    ON l.video_id = t.video_id AND l.topic_key = t.topic_label""",
    "process_batch": f"""
        SELECT i.segment_id, f.video_id, {_times}, text, topic_label, ext_summary,
               abs_summary, {_metrics}
        FROM talk_full f JOIN talk_id i
          ON i.video_id = f.video_id AND i.local_id = f.segment_id""",
    "process_batch_entities": """
        SELECT row_number() OVER (ORDER BY i.segment_id, e.position, entity_text,
                                  entity_type) - 1 AS entity_id,
               i.segment_id, e.video_id, entity_text, entity_type
        FROM talk_entity e JOIN talk_id i
          ON i.video_id = e.video_id AND i.local_id = e.segment_id""",
    "process_lists": """
        SELECT conv_id // 10 AS list_id,
               row_number() OVER (PARTITION BY conv_id // 10 ORDER BY conv_id) AS position,
               count(*) OVER (PARTITION BY conv_id // 10) AS total,
               'https://www.youtube.com/watch?v=' || id AS url, id AS video_id,
               CASE WHEN id LIKE 'x%' THEN 'No transcript for video: ' || id END AS error
        FROM (SELECT DISTINCT conv_id, CASE WHEN conv_id % 7 = 0 THEN 'x' ELSE '' END
                || CAST(conv_id AS VARCHAR) AS id FROM conversations)""",
    "process_batch_failures": """
        SELECT conv_id AS position, CAST(conv_id AS VARCHAR) AS video_id,
               CASE WHEN refused THEN 'ValueError: refused' END AS error,
               NOT refused AS stored,
               CASE WHEN refused THEN 'ValueError: refused' END AS noted
        FROM (SELECT conv_id, bool_or(contains(text, 'ing ing')) AS refused
              FROM conversations GROUP BY conv_id)""",
    "batch_outcomes": "SELECT position, url, video_id, error FROM outcome",
    "batch_summary": """
        SELECT count(*) AS total, count(*) FILTER (error IS NULL) AS succeeded,
               count(error) AS failed
        FROM outcome""",
    "incremental_ingest": """
        SELECT video_id, count(*) AS segments, count(*) AS segment_ids
        FROM doc_seg GROUP BY video_id""",
}
FINALS["semantic_similarity_dense"] = f"""
    SELECT video_id, segment_id,
           round({text_similarity('text', 'lead')}, 6) AS semantic_similarity
    FROM (SELECT *, {first_sentence('text')} AS lead FROM doc_seg)"""
FINALS["topic_summary_hook"] = f"""
    SELECT t.video_id, t.segment_id, coalesce({lead('topic_text')}, '') AS summary,
           CAST(NULL AS VARCHAR) AS error
    FROM doc_topic t LEFT JOIN doc_text x
      ON x.video_id = t.video_id AND x.topic_key = t.topic_label"""

ORACLES: dict[str, str] = {name: _sql(final) for name, final in FINALS.items()}
