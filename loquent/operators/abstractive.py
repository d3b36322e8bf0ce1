"""One summary per topic.

The default summary is the sentence that says most of the topic's main terms; all
of the topic's text counts. A caller's own summariser gets prompts through
``mapInPandas``: one per topic, or one per block of a topic and then, as in a tree,
one per group of partial summaries.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from heapq import nsmallest
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loquent.functions.binding import let
from loquent.functions.text import sentences, terms, word_count
from loquent.plans.located import SEGMENT, write_by_segment
from loquent.plans.ordered import CHUNK, CHUNK_SIZE, attach, with_chunk
from loquent.plans.skew import SHORT
from loquent.session import write_out

#: Batches of (video_id, topic_key, prompt) in, (video_id, topic_key, summary)
#: out; called once per partition, so a client is opened once per partition.
BatchSummariser = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]

INSTRUCTION = "Sum up this part of a transcript in one or two sentences."
#: Terms of a topic that its summary is chosen by.
MAIN_TERMS = 10
#: Partial summaries that are summed up together.
FAN_IN = 16

_TOPIC = ["video_id", "topic_key"]
#: Parts the key of a topic from the number of a block.
_PART = "\u0001"
_LEADING = pa.schema(
    {
        "video_id": pa.string(),
        "topic_key": pa.string(),
        "main_terms": pa.list_(pa.struct({"_rank": pa.int32(), "term": pa.string(), "n": pa.int64()})),
    }
)
_LEADING_TYPE = (
    "video_id STRING, topic_key STRING, main_terms ARRAY<STRUCT<_rank: INT, term: STRING, n: BIGINT>>"
)
_SUMMARY_SCHEMA = "video_id STRING, topic_key STRING, summary STRING"
_SEGMENT_SUMMARY = "video_id STRING, segment_id BIGINT, summary STRING"


def topic_key(label: Column, segment: Column) -> Column:
    """Group key of a segment: its topic, or itself if it has no topic."""
    alone = F.concat(F.lit("\u0000"), segment.cast("string"))
    return F.coalesce(label, alone)


def with_topic_key(segments: DataFrame) -> DataFrame:
    if "topic_label" in segments.columns:
        label = F.col("topic_label")
    else:
        label = F.lit(None).cast("string")
    return segments.withColumn("topic_key", topic_key(label, F.col("segment_id")))


def _in_order(entry: Column, separator: str) -> Column:
    texts = F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["text"])
    return F.array_join(texts, separator)


def topic_text(
    segments: DataFrame, *, keep_empty: bool = False, size: int = CHUNK_SIZE
) -> DataFrame:
    """(video_id, topic_key, topic_text): non-empty texts joined by newlines.

    Texts are first joined inside chunks of the topic, then the chunks. A topic
    without any text is left out unless ``keep_empty``.
    """
    filled = F.coalesce("text", F.lit("")) != ""
    keyed = with_topic_key(segments)
    if not keep_empty:
        keyed = keyed.filter(filled)
    entry = F.when(filled, F.struct("segment_id", "text"))
    parts = (
        with_chunk(keyed, "segment_id", size)
        .groupBy(*_TOPIC, CHUNK)
        .agg(_in_order(entry, "\n").alias("text"))
    )
    part = F.when(F.col("text") != "", F.struct(CHUNK, "text"))
    return parts.groupBy(*_TOPIC).agg(_in_order(part, "\n").alias("topic_text"))


def topic_words(segments: DataFrame) -> DataFrame:
    """(video_id, topic_key, original_words): words of the topic text.

    Joining by newlines never merges words, so the counts add up.
    """
    return (
        with_topic_key(segments)
        .groupBy(*_TOPIC)
        .agg(F.sum(word_count(F.col("text"))).alias("original_words"))
    )


def summary_prompt(
    segments: DataFrame,
    *,
    instruction: str = INSTRUCTION,
    size: int = CHUNK_SIZE,
) -> DataFrame:
    """(video_id, topic_key, prompt) for every topic, also an empty one."""
    prompt = F.concat(F.lit(instruction + "\n\n"), F.col("topic_text"))
    return topic_text(segments, keep_empty=True, size=size).select(
        *_TOPIC, prompt.alias("prompt")
    )


def _counted(keyed: DataFrame, by: Sequence[str], n_terms: int) -> DataFrame:
    """(*by, main_terms) of the rows' texts."""
    order = Window.partitionBy(*by).orderBy(F.desc("n"), "term")
    entry = F.struct(F.col("_rank"), F.col("term"), F.col("n"))
    return (
        keyed.select(*by, F.explode(terms(F.col("text"))).alias("term"))
        .groupBy(*by, "term")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= n_terms)
        .groupBy(*by)
        .agg(F.sort_array(F.collect_list(entry)).alias("main_terms"))
    )


def _leading(n_terms: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The most frequent terms of topics whose rows follow each other.

    Batches of (video_id, topic_key, chunk, words) in, (video_id, topic_key, terms)
    out. Terms of a batch are counted together by sorting numbers for them. Of the
    topic that a batch ends in, the counts are kept until it is over.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = None, Counter()

        def told(keys: list[tuple], lists: list) -> pa.RecordBatch:
            columns = [[k[0] for k in keys], [k[1] for k in keys], lists]
            arrays = [pa.array(c, t) for c, t in zip(columns, _LEADING.types)]
            return pa.RecordBatch.from_arrays(arrays, names=_LEADING.names)

        def over() -> list:
            best = nsmallest(n_terms, counts.items(), lambda c: (-c[1], c[0].encode()))
            return [{"_rank": i + 1, "term": t, "n": n} for i, (t, n) in enumerate(best)]

        for batch in batches:
            if not batch.num_rows:
                continue
            codes = [c.dictionary_encode().indices.fill_null(-1).to_numpy() for c in batch.columns[:3]]
            new = np.any([c[1:] != c[:-1] for c in codes], axis=0)
            starts = np.concatenate([[0], np.flatnonzero(new) + 1])
            group = np.concatenate([[0], np.cumsum(new)])
            keys = list(zip(*[c.take(pa.array(starts)).to_pylist() for c in batch.columns[:3]]))
            words = batch.column(3)
            coded = words.flatten().dictionary_encode()
            in_order = pc.sort_indices(coded.dictionary)
            listed = coded.dictionary.take(in_order).to_pylist()
            place = np.empty(len(listed), np.int64)
            place[in_order.to_numpy()] = np.arange(len(listed))
            rows = np.repeat(group, pc.list_value_length(words).to_numpy())
            many = max(len(listed), 1)
            found, n = np.unique(rows * many + place[coded.indices.to_numpy()], return_counts=True)
            owner, term = np.divmod(found, many)

            def own(g: int) -> dict[str, int]:
                a, b = np.searchsorted(owner, [g, g + 1])
                return {listed[t]: int(c) for t, c in zip(term[a:b], n[a:b])}

            first, last = 0, len(keys) - 1
            if held is not None:
                if held == keys[0]:
                    counts.update(own(0))
                    first = 1
                if (held != keys[0] or last > 0) and counts:
                    yield told([held], [over()])
            if first <= last:
                held, counts = keys[last], Counter(own(last))
            inside = (owner >= first) & (owner < last)
            owner, term, n = owner[inside], term[inside], n[inside]
            best = np.lexsort((term, -n, owner))
            ends = np.searchsorted(owner, owner)
            rank = np.arange(len(best)) - ends
            best, rank = best[rank < n_terms], rank[rank < n_terms]
            lists: dict[int, list] = {}
            for g, r, t, c in zip(owner[best].tolist(), rank.tolist(), term[best].tolist(), n[best].tolist()):
                lists.setdefault(g, []).append({"_rank": r + 1, "term": listed[t], "n": c})
            if lists:
                yield told([keys[g] for g in lists], list(lists.values()))
        if held is not None and counts:
            yield told([held], [over()])

    return run


def _long_topics(keyed: DataFrame, order: str, span: int) -> DataFrame:
    """(_video_id, _topic_key) of topics over ``span`` or more of ``order``, written out."""
    long = (
        keyed.groupBy(*_TOPIC)
        .agg(F.min(order).alias("_first"), F.max(order).alias("_last"))
        .filter(F.col("_last") - F.col("_first") >= span)
        .select(*[F.col(c).alias(f"_{c}") for c in _TOPIC])
    )
    long = write_out(long, "long_topics")
    return long if long.count() > SHORT else F.broadcast(long)


def _among(long: DataFrame) -> Column:
    return reduce(and_, [F.col(c).eqNullSafe(long[f"_{c}"]) for c in _TOPIC])


def main_terms(
    segments: DataFrame, *, n_terms: int = MAIN_TERMS, size: int = CHUNK_SIZE
) -> DataFrame:
    """(video_id, topic_key, main_terms): a topic's most frequent terms.

    Occurrences are counted over the whole topic; equal counts go by term. Texts are
    far smaller than their term counts, so they are what moves: the texts of a topic
    in one chunk of its video meet in one task, which counts and ranks them with NumPy,
    batch by batch. Topics that
    reach over several chunks, a few, are counted term by term: their counts are
    summed map side and each task passes on its own best only, so a topic that fills
    much of the corpus is one task's work nowhere.
    """
    keyed = with_chunk(with_topic_key(segments), "segment_id", size).select(*_TOPIC, CHUNK, "text")
    long = _long_topics(keyed, CHUNK, 1)
    among = _among(long)
    several = None
    if not long.isEmpty():
        several = _counted(keyed.join(long, among, "left_semi"), _TOPIC, n_terms)
        keyed = keyed.join(long, among, "left_anti")
    group = [*_TOPIC, CHUNK]
    met = keyed.repartition(*group).sortWithinPartitions(*group)
    found = met.select(*group, terms(F.col("text"))).mapInArrow(_leading(n_terms), _LEADING_TYPE)
    return found if several is None else found.unionByName(several)


def _central_sentence(text: Column, main: Column) -> Column:
    """STRUCT<score, place, sentence> of a text's best sentence; null if none.

    The score adds up the counts of the main terms that a sentence has.
    """

    def rated(sentence: Column, i: Column) -> Column:
        # Bound, or the sentence would be searched for its terms once per main term.
        score = let(
            terms(sentence),
            lambda own: F.aggregate(
                main,
                F.lit(0).cast("bigint"),
                lambda total, t: total + F.when(F.array_contains(own, t["term"]), t["n"]).otherwise(0),
            ),
        )
        return F.struct(
            F.coalesce(score, F.lit(0)).alias("score"),
            (-i).alias("place"),
            sentence.alias("sentence"),
        )

    return F.array_max(F.transform(sentences(text), rated))


def _central(
    n_terms: int, every: bool = False
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The sentence with most of the main terms, of topics whose rows follow each other.

    Batches of (video_id, topic_key, segment_id, said) in, where ``said`` lists
    the sentences with their terms; (video_id, topic_key, summary) out, or with
    ``every`` (video_id, segment_id, summary) of each row. The rows of the
    topic that a batch ends in are kept until it is over.
    """

    def told(pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.concat_batches(pieces)
        group = np.concatenate([[0], np.cumsum(_new_group(rows))])
        sentence, lists = rows.column(-1).flatten().flatten()
        owner = np.repeat(np.arange(len(group)), _sizes(rows.column(-1)))
        words = lists.flatten().dictionary_encode()
        in_order = pc.sort_indices(words.dictionary).to_numpy()
        many = max(len(in_order), 1)
        place = np.empty(len(in_order), np.int64)
        place[in_order] = np.arange(len(in_order))
        inside = np.repeat(np.arange(len(owner)), _sizes(lists))
        keys = group[owner[inside]] * many + place[words.indices.to_numpy()]
        found, at, n = np.unique(keys, return_inverse=True, return_counts=True)
        topic, term = np.divmod(found, many)
        best = np.lexsort((term, -n, topic))
        main = np.zeros(len(found), bool)
        main[best[np.arange(len(best)) - np.searchsorted(topic, topic) < n_terms]] = True
        # A main term counts once for a sentence.
        hit = main[at]
        once = np.unique(inside[hit] * max(len(found), 1) + at[hit])
        said, which = np.divmod(once, max(len(found), 1))
        score = np.bincount(said, n[which], minlength=len(owner))
        # Every row's best sentence, the first of equals; then every topic's best row.
        first = np.lexsort((-score, owner))
        first = first[np.unique(owner[first], return_index=True)[1]]
        keyed = rows.column(0).is_valid().to_numpy(zero_copy_only=False)
        keyed &= rows.column(2).is_valid().to_numpy(zero_copy_only=False)
        first = first[keyed[owner[first]]]
        segment = rows.column(2).fill_null(0).to_numpy()[owner[first]]
        chosen: dict[int, tuple] = {}
        # Rows of one segment, of which there may be several, go by the sentence.
        order = np.lexsort((segment, -score[first], group[owner[first]]))
        first, segment = first[order], segment[order]
        owned, rated = group[owner[first]], score[first]
        twin = np.zeros(len(first), bool)
        twin[1:] = np.all([x[1:] == x[:-1] for x in (owned, rated, segment)], axis=0)
        for i in np.unique(owned, return_index=True)[1].tolist():
            text, j = sentence[first[i]].as_py(), i + 1
            while j < len(first) and twin[j]:
                text, j = max(text, sentence[first[j]].as_py(), key=str.encode), j + 1
            chosen[int(owned[i])] = text
        if every:
            own = [chosen.get(g, "") if k else None for g, k in zip(group.tolist(), keyed.tolist())]
            columns = [rows.column(0), rows.column(2), pa.array(own, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=[*SEGMENT, "summary"])
        kept, at = np.unique(group[keyed], return_index=True)
        at = pa.array(np.flatnonzero(keyed)[at])
        summaries = pa.array([chosen.get(g, "") for g in kept.tolist()], pa.string())
        columns = [rows.column(0).take(at), rows.column(1).take(at), summaries]
        return pa.RecordBatch.from_arrays(columns, names=[*_TOPIC, "summary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            ends = np.flatnonzero(_new_group(batch)) + 1
            joint = held and pa.concat_batches([held[-1].slice(held[-1].num_rows - 1), batch.slice(0, 1)])
            if held and _new_group(joint)[0]:
                yield told(held)
                held = []
            if len(ends):
                yield told([*held, batch.slice(0, ends[-1])])
                held, batch = [], batch.slice(ends[-1])
            held.append(batch)
        if held:
            yield told(held)

    return run


def _new_group(rows: pa.RecordBatch) -> np.ndarray:
    """Whether rows but the first differ from the one before in the first two columns."""
    codes = [c.dictionary_encode().indices.fill_null(-1).to_numpy() for c in rows.columns[:2]]
    return np.any([c[1:] != c[:-1] for c in codes], axis=0)


def _sizes(lists: pa.ListArray) -> np.ndarray:
    return pc.list_value_length(lists).fill_null(0).to_numpy()


def _central_by_terms(keyed: DataFrame, main: DataFrame, size: int) -> DataFrame:
    """(video_id, topic_key, summary) of topics by their main terms, which are brought
    to the segments: each puts forward a sentence, and topics keep the best of these."""
    wanted = attach(
        keyed.select(*_TOPIC, "segment_id"),
        write_out(main, "main_terms"),
        _TOPIC,
        "segment_id",
        size=size,
    )
    rated = keyed.select(*SEGMENT, "text").join(wanted, SEGMENT)
    best = _central_sentence(F.col("text"), F.col("main_terms"))
    entry = F.struct(
        F.col("_best.score"), -F.col("segment_id"), F.col("_best.sentence").alias("sentence")
    )
    return (
        rated.select(*_TOPIC, "segment_id", best.alias("_best"))
        .groupBy(*_TOPIC)
        .agg(F.max(F.when(F.col("_best").isNotNull(), entry)).alias("_best"))
        .select(*_TOPIC, F.coalesce("_best.sentence", F.lit("")).alias("summary"))
    )


def central_summary(
    segments: DataFrame, *, n_terms: int = MAIN_TERMS, size: int = CHUNK_SIZE
) -> DataFrame:
    """(video_id, topic_key, summary): the sentence with most of the main terms.

    Of equal sentences the earliest. The texts of a topic that spans less than ``size``
    ids meet in one task, which counts their terms and rates their sentences with NumPy,
    topic by topic. Topics that span more, a few, are not gathered: their terms are
    summed map side, and their main terms are brought to the segments. A topic without
    text has the summary ''. The summaries are written out.
    """
    near, far, _ = _central_found(segments, n_terms, size)
    near = write_out(near, "summaries")
    return near if far is None else near.unionByName(far)


def _central_found(
    segments: DataFrame, n_terms: int, size: int, *, every: bool = False
) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """Summaries of the topics that span less than ``size`` ids (of their segments with
    ``every``), of the others if there are any, and the segments of these."""
    keyed = with_topic_key(segments).select(*SEGMENT, "topic_key", "text")
    long = _long_topics(keyed, "segment_id", size)
    some = keyed.join(long, _among(long), "left_semi")
    far = None
    if not long.isEmpty():
        far = _central_by_terms(some, _counted(some, _TOPIC, n_terms), size)
        far = write_out(far, "long_summaries")
        keyed = keyed.join(long, _among(long), "left_anti")
    met = keyed.repartition(*_TOPIC).sortWithinPartitions(*_TOPIC)
    said = F.transform(
        sentences(F.col("text")), lambda s: F.struct(s.alias("sentence"), terms(s).alias("terms"))
    )
    near = met.select(*_TOPIC, "segment_id", said.alias("said"))
    schema = _SEGMENT_SUMMARY if every else _SUMMARY_SCHEMA
    return near.mapInArrow(_central(n_terms, every), schema), far, some


def guarded(summarise: BatchSummariser) -> BatchSummariser:
    """``summarise`` with a column ``error`` instead of an exception.

    It is called once per partition as long as it raises nothing. After an
    exception, the prompts it had taken and not answered are tried again in
    halves, down to single prompts, which get the message; then it is called
    anew for the rest. An answer is never asked for twice.
    """

    def answered(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.assign(error=None)

    def halved(prompts: pd.DataFrame, error: Exception) -> Iterator[pd.DataFrame]:
        if len(prompts) == 1:
            message = f"{type(error).__name__}: {error}"
            yield prompts[_TOPIC].assign(summary=None, error=message)
            return
        middle = len(prompts) // 2
        for half in (prompts.iloc[:middle], prompts.iloc[middle:]):
            yield from tried(half.reset_index(drop=True))

    def tried(prompts: pd.DataFrame) -> Iterator[pd.DataFrame]:
        open_ = {key: i for i, key in enumerate(zip(*(prompts[c] for c in _TOPIC)))}
        try:
            for out in summarise(iter([prompts])):
                for key in zip(*(out[c] for c in _TOPIC)):
                    open_.pop(key, None)
                yield answered(out)
        except Exception as error:
            if open_:
                left = prompts.iloc[sorted(open_.values())].reset_index(drop=True)
                yield from halved(left, error)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source = iter(frames)
        while True:
            asked: dict[tuple, str] = {}
            ended = False

            def feed() -> Iterator[pd.DataFrame]:
                nonlocal ended
                for frame in source:
                    asked.update(zip(zip(*(frame[c] for c in _TOPIC)), frame["prompt"]))
                    yield frame
                ended = True

            try:
                for out in summarise(feed()):
                    for key in zip(*(out[c] for c in _TOPIC)):
                        asked.pop(key, None)
                    yield answered(out)
                return
            except Exception as error:
                if not asked and not ended:
                    # It failed before it took a prompt; the next ones are tried alone.
                    frame = next(source, None)
                    if frame is None:
                        return
                    yield from tried(frame)
                elif asked:
                    left = pd.DataFrame([(*k, p) for k, p in asked.items()], columns=[*_TOPIC, "prompt"])
                    yield from halved(left, error)
                if ended:
                    return

    return run


def hook_summary(
    segments: DataFrame,
    summarise: BatchSummariser,
    *,
    instruction: str = INSTRUCTION,
    partitions: int | None = None,
    size: int = CHUNK_SIZE,
) -> DataFrame:
    """(video_id, topic_key, summary, error) from a caller's batch function.

    Where it raises for a topic, that topic has the message and no summary.

    ``partitions`` sets how many partitions, and so how many clients, share the
    prompts. Prompts are few bytes for much work, so Spark would choose too few.
    The answers are written out: they are costly and used more than once.
    """
    prompts = summary_prompt(segments, instruction=instruction, size=size)
    if partitions is not None:
        prompts = prompts.repartition(partitions, *_TOPIC)
    answers = prompts.mapInPandas(guarded(summarise), f"{_SUMMARY_SCHEMA}, error STRING")
    return write_out(answers, "summaries")


def _prompted(
    parts: DataFrame, summarise: BatchSummariser, instruction: str, partitions: int | None
) -> DataFrame:
    """(video_id, topic_key, part, text, error): the answer to every part's text.

    The hook sees a part as a topic of its own, with the part in its key.
    """
    key = F.concat("topic_key", F.lit(_PART), F.col("part").cast("string"))
    prompts = parts.select(
        "video_id",
        key.alias("topic_key"),
        F.concat(F.lit(instruction + "\n\n"), F.col("text")).alias("prompt"),
    )
    if partitions is not None:
        prompts = prompts.repartition(partitions, *_TOPIC)
    answers = prompts.mapInPandas(guarded(summarise), f"{_SUMMARY_SCHEMA}, error STRING")
    split = rf"(?s)^(.*){_PART}(-?\d+)$"
    told = write_out(answers, "partial").select(
        "video_id",
        F.regexp_extract("topic_key", split, 1).alias("topic_key"),
        F.regexp_extract("topic_key", split, 2).cast("bigint").alias("part"),
        F.col("summary").alias("text"),
        "error",
    )
    # A part without an answer stays, so that its topic is not taken for complete.
    return parts.select(*_TOPIC, "part").join(told, [*_TOPIC, "part"], "left")


def tree_summary(
    segments: DataFrame,
    summarise: BatchSummariser,
    *,
    block: int,
    fan_in: int = FAN_IN,
    instruction: str = INSTRUCTION,
    partitions: int | None = None,
) -> DataFrame:
    """(video_id, topic_key, summary, error) without gathering any topic.

    A prompt holds the segments of ``block`` consecutive ids of a topic. The
    partial summaries are summed up ``fan_in`` at a time until a topic has one, so
    no row holds more than a block or ``fan_in`` answers. A topic that fits into
    one block is asked for once. Where the hook raises for a part, its topic has
    the message and no summary, and is not asked for again. A part without an
    answer adds nothing.
    """
    if block < 1 or fan_in < 2:
        raise ValueError("block must be at least 1 and fan_in at least 2")
    entry = F.when(F.coalesce("text", F.lit("")) != "", F.struct("segment_id", "text"))
    parts = (
        with_chunk(with_topic_key(segments), "segment_id", block)
        .groupBy(*_TOPIC, F.col(CHUNK).alias("part"))
        .agg(_in_order(entry, "\n").alias("text"))
    )
    done = None
    while True:
        answers = _prompted(parts, summarise, instruction, partitions)
        known = answers.groupBy(*_TOPIC).agg(
            F.count(F.lit(1)).alias("_parts"), F.max("error").alias("_error")
        )
        known = write_out(known, "parts")
        ended = (F.col("_parts") == 1) | F.col("_error").isNotNull()
        finished = known.filter(ended).select(*_TOPIC, F.col("_error").alias("error"))
        single = answers.join(known.filter("_parts = 1").select(*_TOPIC), _TOPIC, "left_semi")
        summaries = single.select(*_TOPIC, F.col("text").alias("summary"))
        closed = finished.join(summaries, _TOPIC, "left").select(
            *_TOPIC, F.when(F.col("error").isNull(), F.col("summary")).alias("summary"), "error"
        )
        done = closed if done is None else done.unionByName(closed)
        rest = known.filter(~ended).select(*_TOPIC)
        if rest.isEmpty():
            return done
        # Parts are numbered anew, so gaps between blocks cost no further level.
        order = Window.partitionBy(*_TOPIC).orderBy("part")
        numbered = answers.join(rest, _TOPIC, "left_semi").withColumn(
            "_place", (F.row_number().over(order) - 1).cast("bigint")
        )
        piece = F.struct(F.col("_place").alias("segment_id"), F.col("text"))
        parts = numbered.groupBy(*_TOPIC, F.expr(f"_place div {fan_in}").alias("part")).agg(
            _in_order(piece, "\n").alias("text")
        )


def topic_summary(
    segments: DataFrame,
    *,
    summarise: BatchSummariser | None = None,
    instruction: str = INSTRUCTION,
    partitions: int | None = None,
    n_terms: int = MAIN_TERMS,
    block: int | None = None,
    size: int = CHUNK_SIZE,
) -> DataFrame:
    """(video_id, segment_id, summary): every segment gets its topic's summary.

    With ``summarise`` a column ``error`` holds the message where it raised. It is
    given whole topics or, with ``block``, blocks of that many segments first (see
    ``tree_summary``).
    """
    if summarise is None:
        near, far, some = _central_found(segments, n_terms, size, every=True)
        if far is not None:
            spread = attach(some.select(*_TOPIC, "segment_id"), far, _TOPIC, "segment_id", size=size)
            near = near.unionByName(spread.select(*SEGMENT, "summary"))
        return write_by_segment(near, "summaries")
    if block is not None:
        per_topic = tree_summary(
            segments, summarise, block=block, instruction=instruction, partitions=partitions
        )
    else:
        per_topic = hook_summary(
            segments,
            summarise,
            instruction=instruction,
            partitions=partitions,
            size=size,
        )
    keyed = with_topic_key(segments).select(*_TOPIC, "segment_id")
    spread = attach(keyed, per_topic, _TOPIC, "segment_id", size=size)
    added = [c for c in per_topic.columns if c not in _TOPIC]
    return spread.select("video_id", "segment_id", *added)
