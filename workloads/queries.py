"""One Spark query per operator. Each takes (spark, folder of parquet tables)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loquent.functions import metrics as M
from loquent.functions import text as X
from loquent.functions import urls as U
from loquent.functions.reporting import averages_line, parse_outcome
from loquent.functions.vectors import dense_cosine
from loquent.operators import abstractive, batch, cooccurrence, embed, entities, extractive
from loquent.operators import graph, ids, registry, reports, topics
from loquent.operators.enrich import VECTOR, enrich_segments
from loquent.plans.located import write_by_segment
from loquent.plans.ordered import attach
from loquent.plans.skew import salted_join
from loquent.session import scratch_path, write_out
from loquent.sources import transcripts
from loquent.sources.graph_store import GraphStore
from loquent.streaming.ingest import incremental_ingest
from workloads import data as D

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    for name in columns:
        df = df.withColumn(name, F.round(name, digits))
    return df


# Sentence scores come rounded to nine digits and are compared as they are.
_METRICS = ("compression_ratio", "semantic_similarity")
_TIMES = ("start_time", "end_time")

# About the middle of what pairs of the sf0.01 tables have, so it drops some.
PAIR_SUPPORT = 300


# --- sources and sinks ------------------------------------------------------


@query("segment_source")
def segment_source(spark, folder):
    segments = transcripts.with_times(D.doc_segments(spark, folder))
    return _rounded(segments, *_TIMES).select(
        "video_id", "segment_id", *_TIMES, "text"
    )


@query("url_list_source")
def url_list_source(spark, folder):
    lines = D.table(spark, folder, "pages").select(
        F.explode(F.array(F.concat(F.lit("  "), "url", F.lit(" ")), F.lit("")))
    )
    path = scratch_path(spark, "urls")
    lines.write.text(path)
    return transcripts.read_url_list(spark, path).select("url")


@query("json_segments")
def json_segments(spark, folder):
    # Lines of JSON arrays, each with up to 256 turns, read back as rows.
    turn = F.struct(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("segment_id"), "text"
    )
    arrays = (
        D.table(spark, folder, "conversations")
        .groupBy("conv_id", F.expr("turn div 256").alias("part"))
        .agg(F.to_json(F.sort_array(F.collect_list(turn))).alias("value"))
    )
    path = scratch_path(spark, "json")
    arrays.select("value").write.text(path)
    return transcripts.read_segments_json(spark, path, multi_line=False)


def _stored_talks(spark, folder):
    """A warehouse with timed, globally numbered conversation segments."""
    warehouse = D.new_warehouse(spark)
    turns = D.talk_segments(spark, folder)
    videos = D.talk_videos(spark, folder)
    placed = ids.global_segment_ids(
        transcripts.with_times(
            salted_join(
                turns,
                videos.select("video_id", "position"),
                ["video_id"],
                ["segment_id"],
            )
        ),
        position="position",
    )
    warehouse.append_segments(placed)
    return warehouse, videos


@query("append_segments")
def append_segments(spark, folder):
    warehouse, _ = _stored_talks(spark, folder)
    return _rounded(warehouse.read_segments(), *_TIMES).select(
        "segment_id", "video_id", *_TIMES, "text", "topic_label"
    )


@query("append_entities")
def append_entities(spark, folder):
    warehouse = D.new_warehouse(spark)
    mentions = D.star_entities(spark, folder).withColumn(
        "position", F.lit(0).cast("bigint")
    )
    warehouse.append_entities(ids.global_entity_ids(entities.first_mentions(mentions)))
    # Appending nothing is fine.
    warehouse.append_entities(warehouse.read_entities("no such video"))
    return warehouse.read_entities()


@query("append_videos")
def append_videos(spark, folder):
    warehouse = D.new_warehouse(spark)
    warehouse.append_videos(D.talk_videos(spark, folder))
    return warehouse.read_videos()


@query("table_bootstrap")
def table_bootstrap(spark, folder):
    warehouse, videos = _stored_talks(spark, folder)
    warehouse.append_videos(videos)
    # Creating tables again leaves the stored ones as they are.
    warehouse.create_tables()
    counts = None
    for name in ("videos", "segments", "entities", "co_occurrences"):
        rows = warehouse.read(name)
        one = rows.agg(
            F.lit(name).alias("table_name"),
            F.lit(len(rows.columns)).cast("bigint").alias("n_columns"),
            F.count("*").alias("n_rows"),
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query("replace_pairs")
def replace_pairs(spark, folder):
    warehouse = D.new_warehouse(spark)
    pairs = cooccurrence.co_occurrences(D.star_entities(spark, folder))
    warehouse.replace_co_occurrences(pairs)
    warehouse.replace_co_occurrences(
        cooccurrence.with_support(pairs, min_videos=PAIR_SUPPORT)
    )
    return warehouse.read_co_occurrences()


@query("scan_segments")
def scan_segments(spark, folder):
    warehouse, _ = _stored_talks(spark, folder)
    return warehouse.read_segments().select("segment_id", "video_id", "text")


@query("scan_video")
def scan_video(spark, folder):
    warehouse, _ = _stored_talks(spark, folder)
    return warehouse.read_segments("7").select("segment_id", "video_id", "text")


@query("scan_entities")
def scan_entities(spark, folder):
    warehouse = D.new_warehouse(spark)
    found = entities.extract_entities(
        D.talk_segments(spark, folder), D.gazetteer(spark, folder)
    )
    warehouse.append_entities(ids.global_entity_ids(found))
    return warehouse.read_entities().select(
        "segment_id", "video_id", "entity_text", "entity_type"
    )


@query("scan_pairs")
def scan_pairs(spark, folder):
    warehouse = D.new_warehouse(spark)
    warehouse.replace_co_occurrences(
        cooccurrence.co_occurrences(D.star_entities(spark, folder))
    )
    return warehouse.read_co_occurrences()


@query("delete_video")
def delete_video(spark, folder):
    warehouse = D.new_warehouse(spark)
    warehouse.append_segments(transcripts.with_times(D.doc_segments(spark, folder)))
    warehouse.append_videos(D.doc_transcripts(spark, folder).drop("text"))
    toxic = D.table(spark, folder, "labels").filter("toxic = 1")
    warehouse.delete_videos(
        toxic.select(F.col("doc_id").cast("string").alias("video_id"))
    )
    remaining = warehouse.read_segments().groupBy("video_id").agg(
        F.count("*").alias("segments")
    )
    return warehouse.read_videos().select("video_id").join(
        remaining, "video_id", "full_outer"
    )


@query("compact_segments")
def compact_segments(spark, folder):
    """Rows that stay after a delete, read from the table written anew."""
    warehouse = D.new_warehouse(spark)
    warehouse.append_segments(transcripts.with_times(D.doc_segments(spark, folder)))
    toxic = D.table(spark, folder, "labels").filter("toxic = 1")
    warehouse.delete_videos(toxic.select(F.col("doc_id").cast("string").alias("video_id")))
    warehouse.compact("segments")
    return warehouse.read_segments().select("video_id", "segment_id", "text")


@query("graph_nodes")
def graph_nodes(spark, folder):
    # Part names are the nodes of an earlier load.
    earlier = graph.graph_nodes(
        D.table(spark, folder, "part").select(
            F.col("p_name").alias("entity_text"), F.col("p_type").alias("entity_type")
        )
    )
    return graph.graph_nodes(D.star_entities(spark, folder), earlier)


def _star_graph(spark, folder):
    """All pairs; brands that end in 5 are no nodes."""
    star = D.star_entities(spark, folder)
    pairs = write_out(cooccurrence.co_occurrences(star), "pairs")
    known = D.table(spark, folder, "part").filter("p_brand NOT LIKE '%5'")
    nodes = graph.graph_nodes(
        known.select(
            F.col("p_brand").alias("entity_text"), F.col("p_type").alias("entity_type")
        )
    )
    return pairs, nodes


@query("graph_edges")
def graph_edges(spark, folder):
    pairs, nodes = _star_graph(spark, folder)
    # The earlier load had only well supported pairs, with other counts.
    earlier = pairs.filter("segment_count >= 20").withColumn(
        "segment_count", F.lit(0).cast("bigint")
    )
    return graph.graph_edges(pairs, nodes, earlier)


@query("graph_triples")
def graph_triples(spark, folder):
    pairs, nodes = _star_graph(spark, folder)
    return graph.graph_triples(nodes, graph.graph_edges(pairs, nodes))


def _loaded_graph(spark, folder):
    """All pairs without counts, then once more the well supported ones."""
    pairs, nodes = _star_graph(spark, folder)
    store = GraphStore(spark, scratch_path(spark, "graph"), buckets=8)
    store.load(nodes, pairs.withColumn("segment_count", F.lit(0).cast("bigint")))
    typed = nodes.withColumn("entity_type", F.upper(F.substring("entity_text", 1, 6)))
    again = typed.filter("entity_text LIKE '%1'")
    store.load(again, pairs.filter("segment_count >= 20"))
    return store


@query("stored_graph_nodes")
def stored_graph_nodes(spark, folder):
    return _loaded_graph(spark, folder).nodes()


@query("stored_graph_triples")
def stored_graph_triples(spark, folder):
    return _loaded_graph(spark, folder).triples()


# --- filters and URLs -------------------------------------------------------


@query("video_exists")
def video_exists(spark, folder):
    warehouse = D.new_warehouse(spark)
    warehouse.append_videos(D.talk_videos(spark, folder))
    wanted = D.doc_transcripts(spark, folder).select("video_id")
    missing = warehouse.skip_processed(wanted).select(
        "video_id", F.lit(False).alias("stored")
    )
    present = reports.in_videos(wanted, warehouse.read_videos()).select(
        "video_id", F.lit(True).alias("stored")
    )
    return present.unionByName(missing)


@query("skip_processed")
def skip_processed(spark, folder):
    warehouse = D.new_warehouse(spark)
    warehouse.append_videos(D.talk_videos(spark, folder))
    return warehouse.skip_processed(
        D.doc_transcripts(spark, folder).select("video_id", "url")
    )


@query("filter_isin")
def filter_isin(spark, folder):
    good = D.table(spark, folder, "labels").filter("quality = 1")
    chosen = good.select(F.col("doc_id").cast("string").alias("video_id"))
    return reports.in_videos(D.doc_segments(spark, folder), chosen)


@query("entity_allowlist")
def entity_allowlist(spark, folder):
    mentions = entities.find_mentions(
        D.doc_segments(spark, folder), D.gazetteer(spark, folder)
    )
    return mentions.withColumn(
        "allowed", entities.allowed(F.col("entity_type"))
    ).select("video_id", "segment_id", "entity_text", "entity_type", "allowed")


# Hosts of the page table that stand in for the video site.
_PAGE_HOSTS = ("example.com", "blog.ththan.example.net")
_PAGE_SHORT_HOSTS = ("example.org",)


@query("url_host")
def url_host(spark, folder):
    pages = D.table(spark, folder, "pages")
    return pages.select("page_id", U.host(F.col("url")).alias("host"))


@query("url_host_allowed")
def url_host_allowed(spark, folder):
    pages = D.table(spark, folder, "pages")
    return pages.select(
        "page_id", U.host_allowed(F.col("url"), _PAGE_HOSTS).alias("allowed")
    )


@query("url_is_list")
def url_is_list(spark, folder):
    # A page address behind a list parameter where it has none of its own.
    pages = D.table(spark, folder, "pages")
    url = F.when(F.col("url").contains("?"), F.col("url")).otherwise(
        F.concat("url", F.lit("?list="), F.col("page_id").cast("string"))
    )
    return pages.select("page_id", U.is_list_url(url).alias("is_list"))


@query("url_validate")
def url_validate(spark, folder):
    # Page addresses, video links, list links and blank lines.
    page = F.col("page_id").cast("string")
    pages = D.table(spark, folder, "pages").select(
        "page_id",
        F.posexplode(
            F.array(
                F.col("url"),
                F.concat(F.lit("  "), U.canonical_url(page), F.lit(" ")),
                F.concat(F.lit("https://youtu.be/"), page),
                F.concat(F.lit("https://youtube.com/playlist?list="), page),
                F.concat(F.lit("http://www.youtube.com/watch?v="), page),
                F.lit("  "),
            )
        ).alias("form", "url"),
    )
    return pages.select(
        "page_id", F.col("form").cast("bigint").alias("form"), U.validate(F.col("url")).alias("v")
    ).select("page_id", "form", "v.ok", "v.kind")


@query("url_video_id")
def url_video_id(spark, folder):
    pages = D.table(spark, folder, "pages")
    found = U.video_id(F.col("url"), _PAGE_SHORT_HOSTS, "page")
    return pages.select("page_id", found.alias("video_id"))


@query("expand_list")
def expand_list(spark, folder):
    # A document's lines as list entries; the first number in a line is its id.
    entries = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(F.regexp_extract(line, r"([0-9]+)", 1).alias("id")),
    )
    lists = D.doc_transcripts(spark, folder).select(
        "video_id", entries.alias("entries")
    )
    return transcripts.expand_list(lists, list_id="video_id", entries="entries")


def _page_lists(spark, folder):
    """Pages as lists by host."""
    pages = D.table(spark, folder, "pages").select(
        U.host(F.col("url")).alias("list_id"), F.col("page_id").alias("entry_index"), "url"
    )
    return ids.list_position(pages)


@query("list_position")
def list_position(spark, folder):
    return _page_lists(spark, folder).select(
        "list_id", "entry_index", "position", "total"
    )


@query("parse_outcomes")
def parse_outcomes(spark, folder):
    # Outcome lines of the page lists, among other output lines.
    outcomes = _page_lists(spark, folder).withColumns(
        {
            "video_id": U.video_id(F.col("url"), _PAGE_SHORT_HOSTS, "page"),
            "error": F.when(~U.host_allowed(F.col("url"), _PAGE_HOSTS), F.col("url")),
        }
    )
    other = outcomes.select(F.concat(F.lit("Fetching "), "url").alias("line"))
    lines = batch.outcome_lines(outcomes).unionByName(other)
    return (
        lines.select(parse_outcome(F.col("line")).alias("o"))
        .filter(F.col("o").isNotNull())
        .select("o.*")
    )


# --- entities, pairs and joins ----------------------------------------------


@query("entity_mentions")
def entity_mentions(spark, folder):
    return cooccurrence.entity_mentions(D.star_entities(spark, folder))


@query("entity_pairs")
def entity_pairs(spark, folder):
    return cooccurrence.entity_pairs(D.star_entities(spark, folder))


@query("co_occurrences")
def co_occurrences(spark, folder):
    return cooccurrence.co_occurrences(D.star_entities(spark, folder))


@query("pairs_min_videos")
def pairs_min_videos(spark, folder):
    pairs = cooccurrence.co_occurrences(D.star_entities(spark, folder))
    return cooccurrence.with_support(pairs, PAIR_SUPPORT)


@query("top_pairs")
def top_pairs(spark, folder):
    pairs = cooccurrence.co_occurrences(D.star_entities(spark, folder))
    return cooccurrence.top_pairs(pairs)


@query("pair_lines")
def pair_lines(spark, folder):
    pairs = cooccurrence.co_occurrences(D.star_entities(spark, folder))
    return cooccurrence.pair_lines(pairs)


@query("co_occurrence_job")
def co_occurrence_job(spark, folder):
    warehouse = D.new_warehouse(spark)
    mentions = D.star_entities(spark, folder).withColumn(
        "position", F.lit(0).cast("bigint")
    )
    warehouse.append_entities(ids.global_entity_ids(entities.first_mentions(mentions)))
    # The customers are the videos that are done.
    customers = D.table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("video_id"),
        U.canonical_url(F.col("c_custkey").cast("string")).alias("url"),
        F.col("c_name").alias("title"),
    )
    warehouse.append_videos(customers)
    return batch.co_occurrence_job(warehouse, min_videos=PAIR_SUPPORT)


@query("entity_dedup")
def entity_dedup(spark, folder):
    mentions = entities.find_mentions(
        D.doc_segments(spark, folder), D.gazetteer(spark, folder)
    )
    return entities.first_mentions(mentions)


@query("extract_entities")
def extract_entities(spark, folder):
    return entities.extract_entities(
        D.doc_segments(spark, folder), D.gazetteer(spark, folder)
    )


@query("top_entities")
def top_entities(spark, folder):
    return reports.top_entities(D.star_entities(spark, folder))


@query("entity_frequency")
def entity_frequency(spark, folder):
    return reports.entity_frequency(D.star_entities(spark, folder))


@query("unique_entities")
def unique_entities(spark, folder):
    return reports.unique_entities(D.star_entities(spark, folder))


# --- topics -----------------------------------------------------------------


@query("term_counts")
def term_counts(spark, folder):
    return topics.term_counts(D.doc_segments(spark, folder))


@query("term_norms")
def term_norms(spark, folder):
    return _rounded(topics.term_norms(D.doc_segments(spark, folder)), "norm")


@query("dense_cosine")
def dense_cosine_to_mean(spark, folder):
    # Every vector against its label's mean vector.
    vectors = D.vector_segments(spark, folder)
    means = (
        vectors.select("video_id", F.posexplode("embedding").alias("i", "x"))
        .groupBy("video_id", "i")
        .agg(F.avg(F.col("x").cast("double")).alias("m"))
        .groupBy("video_id")
        .agg(F.sort_array(F.collect_list(F.struct("i", "m"))).alias("parts"))
        .select("video_id", F.transform("parts", lambda p: p["m"]).alias("mean"))
    )
    scored = attach(vectors, means, ["video_id"], "segment_id").select(
        "video_id",
        "segment_id",
        dense_cosine(F.col("embedding"), F.col("mean")).alias("cosine"),
    )
    return _rounded(scored, "cosine")


@query("adjacent_distance")
def adjacent_distance(spark, folder):
    distances = topics.adjacent_distance(
        D.vector_segments(spark, folder), embedding="embedding"
    )
    return _rounded(distances, "distance")


@query("adjacent_distance_lexical")
def adjacent_distance_lexical(spark, folder):
    distances = topics.adjacent_distance(D.doc_segments(spark, folder))
    return _rounded(distances, "distance")


@query("topic_threshold")
def topic_threshold(spark, folder):
    distances = topics.adjacent_distance(D.doc_segments(spark, folder))
    return _rounded(
        topics.topic_threshold(distances),
        "mean_distance",
        "stdev_distance",
        "threshold",
    )


@query("topic_segments")
def topic_segments(spark, folder):
    return topics.segment_topics(D.doc_segments(spark, folder))


@query("topic_segments_k0")
def topic_segments_k0(spark, folder):
    return topics.segment_topics(D.doc_segments(spark, folder), k=0.0)


@query("topic_segments_dense")
def topic_segments_dense(spark, folder):
    return topics.segment_topics(
        D.vector_segments(spark, folder), embedding="embedding"
    )


@query("attach_topic")
def attach_topic(spark, folder):
    segments = D.doc_segments(spark, folder)
    return registry.attach_topic(segments, topics.segment_topics(segments))


# --- summaries --------------------------------------------------------------


def _labelled(spark, folder):
    # Laid out by segment: the text is split once, and labels come to it in place.
    segments = write_by_segment(D.doc_segments(spark, folder), "segments")
    return registry.attach_topic(segments, topics.segment_topics(segments))


@query("topic_text")
def topic_text(spark, folder):
    return abstractive.topic_text(_labelled(spark, folder))


@query("summary_prompt")
def summary_prompt(spark, folder):
    return abstractive.summary_prompt(_labelled(spark, folder))


@query("topic_summary")
def topic_summary(spark, folder):
    return abstractive.topic_summary(_labelled(spark, folder))


def _first_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A stand-in for a model client: the first six words after the prompt."""
    for prompts in batches:
        body = prompts["prompt"].str.split("\n\n", n=1).str[1]
        first = body.str.split().str[:6].str.join(" ")
        yield prompts[["video_id", "topic_key"]].assign(summary=first)


@query("topic_summary_hook")
def topic_summary_hook(spark, folder):
    return abstractive.topic_summary(_labelled(spark, folder), summarise=_first_words)


@query("sentence_split")
def sentence_split(spark, folder):
    return extractive.sentence_split(D.doc_segments(spark, folder))


@query("key_terms")
def key_terms(spark, folder):
    return _rounded(extractive.key_terms(D.doc_segments(spark, folder)), "rank")


@query("extractive_summary")
def extractive_summary(spark, folder):
    return extractive.extractive_summary(D.doc_segments(spark, folder)).select(
        "video_id",
        "segment_id",
        "summary",
        F.size("sentence_scores").cast("bigint").alias("n_sentences"),
    )


@query("sentence_scores")
def sentence_scores(spark, folder):
    return extractive.sentence_scores(D.doc_segments(spark, folder))


# --- metrics and scalars ----------------------------------------------------


@query("word_count")
def word_count(spark, folder):
    return D.doc_segments(spark, folder).select(
        "video_id", "segment_id", X.word_count(F.col("text")).alias("words")
    )


@query("compression_ratio")
def compression_ratio(spark, folder):
    text = F.col("text")
    first = F.get(X.sentences(text), F.lit(0))
    return D.doc_segments(spark, folder).select(
        "video_id",
        "segment_id",
        F.round(M.compression_ratio(text, first), 6).alias("compression_ratio"),
    )


@query("semantic_similarity")
def semantic_similarity(spark, folder):
    text = F.col("text")
    first = F.coalesce(F.get(X.sentences(text), F.lit(0)), F.lit(""))
    return D.doc_segments(spark, folder).select(
        "video_id",
        "segment_id",
        F.round(M.semantic_similarity(text, first), 6).alias("semantic_similarity"),
    )


@query("semantic_similarity_dense")
def semantic_similarity_dense(spark, folder):
    first = F.coalesce(F.get(X.sentences(F.col("text")), F.lit(0)), F.lit(""))
    pairs = D.doc_segments(spark, folder).withColumn("first", first)
    vectors = {"text": "text_vector", "first": "first_vector"}
    similarity = embed.vector_similarity(*[F.col(c) for c in ("text", "first", *vectors.values())])
    return embed.embed(pairs, vectors, D.LetterCounts()).select(
        "video_id", "segment_id", F.round(similarity, 6).alias("semantic_similarity")
    )


@query("textrank_lookup")
def textrank_lookup(spark, folder):
    parts = X.sentences(F.col("text"))
    scores = F.transform(
        parts,
        lambda s, i: F.struct(s.alias("sentence"), i.cast("double").alias("score")),
    )
    first = F.concat(F.lit("  "), F.coalesce(F.get(parts, F.lit(0)), F.lit("")), F.lit(" "))
    return D.talk_segments(spark, folder).select(
        "video_id", "segment_id", M.textrank_lookup(scores, first).alias("score")
    )


@query("compute_all")
def compute_all(spark, folder):
    text = F.col("text")
    scored = D.LeadSentence().transform(D.talk_segments(spark, folder))
    joined = D.talk_segments(spark, folder).join(scored, ["video_id", "segment_id"])
    computed = M.compute_all(
        text, F.col("summary"), D.lead_of(text, 6), F.col("sentence_scores")
    )
    return _rounded(
        joined.select(
            "video_id", "segment_id", *[c.alias(n) for n, c in computed.items()]
        ),
        *_METRICS,
    )


@query("fmt_time")
def fmt_time(spark, folder):
    events = D.table(spark, folder, "events")
    return events.select(
        "event_id", X.format_time(F.col("value") * 10).alias("shown")
    )


# --- ids --------------------------------------------------------------------


@query("max_id")
def max_id(spark, folder):
    segments = ids.global_segment_ids(
        D.placed_doc_segments(spark, folder), position="position"
    )
    return ids.max_id(segments, "segment_id")


@query("global_segment_ids")
def global_segment_ids(spark, folder):
    placed = ids.global_segment_ids(
        D.placed_doc_segments(spark, folder), position="position", start=100
    )
    return placed.select("video_id", "segment_id", "text")


@query("global_segment_ids_hashed")
def global_segment_ids_hashed(spark, folder):
    placed = ids.global_segment_ids(D.doc_segments(spark, folder))
    return placed.select("video_id", "segment_id", "text")


@query("global_entity_ids")
def global_entity_ids(spark, folder):
    mentions = D.star_entities(spark, folder).withColumn(
        "position", F.length("entity_text").cast("bigint")
    )
    return ids.global_entity_ids(entities.first_mentions(mentions), start=50)


# --- reports ----------------------------------------------------------------


def _scored(spark, folder, k=1.0):
    segments = transcripts.with_times(D.doc_segments(spark, folder))
    return enrich_segments(segments, D.light_processors(k))


_AVERAGES = ("avg_compression_ratio", "avg_semantic_similarity")


@query("merge_nlp")
def merge_nlp(spark, folder):
    return _rounded(_scored(spark, folder), *_METRICS, *_TIMES)


@query("video_stats")
def video_stats(spark, folder):
    stats = _rounded(reports.video_stats(_scored(spark, folder)), *_AVERAGES)
    # The last bits of averages follow the order of sums, and with them halves of
    # hundredths: the line is compared for the rounded averages.
    line = averages_line(*[F.col(c) for c in _AVERAGES])
    return stats.withColumn("averages", line)


@query("corpus_stats")
def corpus_stats(spark, folder):
    return _rounded(reports.corpus_stats(_scored(spark, folder)), *_AVERAGES)


@query("topic_timeline")
def topic_timeline(spark, folder):
    return _rounded(reports.topic_timeline(_scored(spark, folder)), *_TIMES)


@query("topic_timeline_capped")
def topic_timeline_capped(spark, folder):
    return reports.topic_timeline_capped(_scored(spark, folder, k=0.0))


@query("most_divergent")
def most_divergent(spark, folder):
    return _rounded(
        reports.most_divergent(_scored(spark, folder)), "semantic_similarity"
    )


@query("most_divergent_per_video")
def most_divergent_per_video(spark, folder):
    return _rounded(
        reports.most_divergent_per_video(_scored(spark, folder)),
        "semantic_similarity",
    )


@query("history")
def history(spark, folder):
    return reports.history(D.talk_videos(spark, folder))


# --- whole jobs -------------------------------------------------------------


@query("enrich_segments")
def enrich(spark, folder):
    segments = transcripts.with_times(D.doc_segments(spark, folder))
    chosen = [p for p in D.full_processors(spark, folder) if p.name != "entities"]
    enriched = enrich_segments(segments, chosen)
    return _rounded(enriched, *_METRICS, *_TIMES)


@query("enrich_segments_dense")
def enrich_dense(spark, folder):
    """Topics and similarity by the vectors of a caller's encoder."""
    segments = transcripts.with_times(D.doc_segments(spark, folder))
    chosen = [D.LeadSentence(), registry.TopicSegmenter(embedding=VECTOR), registry.AbstractiveSummarizer()]
    enriched = enrich_segments(segments, chosen, open_encoder=D.LetterCounts())
    return _rounded(enriched, *_METRICS, *_TIMES)


@query("run_all")
def run_all(spark, folder):
    segments = D.talk_segments(spark, folder)
    results = registry.run_all(segments, D.full_processors(spark, folder))
    columns = {
        registry.EXTRACTIVE: F.col("summary"),
        registry.ENTITIES: F.concat_ws("/", "entity_type", "entity_text"),
        registry.TOPICS: F.col("topic_label"),
        registry.ABSTRACTIVE: F.col("summary"),
    }
    parts = [
        results[name].select(
            F.lit(name).alias("processor"), "video_id", "segment_id", value.alias("value")
        )
        for name, value in columns.items()
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _batch(spark, folder):
    """Conversations by their canonical URL, and page URLs that must fail."""
    videos = D.talk_videos(spark, folder)
    pages = D.table(spark, folder, "pages").select(
        (-F.col("page_id") - 1).alias("position"), "url"
    )
    urls = videos.select("position", "url").unionByName(pages)
    warehouse = D.new_warehouse(spark)
    outcomes = batch.process_batch(
        warehouse,
        urls,
        videos.select("video_id", "title"),
        D.talk_segments(spark, folder),
        D.full_processors(spark, folder),
    )
    return warehouse, outcomes


@query("process_batch")
def process_batch(spark, folder):
    warehouse, _ = _batch(spark, folder)
    return _rounded(warehouse.read_segments(), *_METRICS, *_TIMES)


@query("process_batch_entities")
def process_batch_entities(spark, folder):
    warehouse, _ = _batch(spark, folder)
    return warehouse.read_entities()


@query("process_batch_failures")
def process_batch_failures(spark, folder):
    """Outcomes of a batch whose summariser refuses some talks; what is stored."""

    def summarise(frames):
        for frame in frames:
            if frame["prompt"].str.contains("ing ing", regex=False).any():
                raise ValueError("refused")
            yield frame[["video_id", "topic_key"]].assign(summary="fine")

    videos = D.talk_videos(spark, folder)
    warehouse = D.new_warehouse(spark)
    outcomes = batch.process_batch(
        warehouse,
        videos.select("position", "url"),
        videos.select("video_id", "title"),
        D.talk_segments(spark, folder),
        [
            D.LeadSentence(),
            registry.TopicSegmenter(),
            registry.AbstractiveSummarizer(summarise=summarise),
            registry.EntityExtractor(),
        ],
    )
    stored = warehouse.read_videos().select("video_id", F.lit(True).alias("stored"))
    failed = warehouse.read_failures().select("video_id", F.col("error").alias("noted"))
    return outcomes.join(stored, "video_id", "left").join(failed, "video_id", "left").select(
        "position", "video_id", "error", F.coalesce("stored", F.lit(False)).alias("stored"), "noted"
    )


@query("process_lists")
def process_lists(spark, folder):
    # Lists of up to ten talks; one talk in seven is listed under an unknown id.
    talks = D.table(spark, folder, "conversations").select("conv_id").distinct()
    unknown = F.when(F.col("conv_id") % 7 == 0, F.lit("x")).otherwise(F.lit(""))
    entry = F.struct("conv_id", F.concat(unknown, F.col("conv_id").cast("string")).alias("id"))
    lists = talks.groupBy(F.expr("conv_id div 10").alias("list_id")).agg(
        F.sort_array(F.collect_list(entry)).alias("entries")
    )
    warehouse = D.new_warehouse(spark)
    titles = D.talk_videos(spark, folder).select("video_id", "title")
    segments = D.talk_segments(spark, folder)
    return batch.process_lists(warehouse, lists, titles, segments, D.light_entity_processors())


@query("batch_outcomes")
def batch_outcomes(spark, folder):
    _, outcomes = _batch(spark, folder)
    return outcomes


@query("batch_summary")
def batch_summary(spark, folder):
    _, outcomes = _batch(spark, folder)
    return reports.batch_summary(outcomes)


@query("incremental_ingest")
def incremental(spark, folder):
    warehouse = D.new_warehouse(spark)
    source = scratch_path(spark, "arriving")
    checkpoint = scratch_path(spark, "progress")
    documents = D.doc_transcripts(spark, folder).drop("position")
    labelled = D.table(spark, folder, "labels").select(
        F.col("doc_id").cast("string").alias("video_id")
    )
    # Labelled documents come first, then all of them, the first ones again.
    for arriving in (documents.join(labelled, "video_id", "left_semi"), documents):
        arriving.write.mode("append").parquet(source)
        incremental_ingest(
            spark, warehouse, source, checkpoint, D.light_entity_processors()
        ).awaitTermination()
    counted = warehouse.read_segments().groupBy("video_id").agg(
        F.count("*").alias("segments"),
        F.countDistinct("segment_id").alias("segment_ids"),
    )
    return warehouse.read_videos().select("video_id").join(
        counted, "video_id", "full_outer"
    )

