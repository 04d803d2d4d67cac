"""Resolving overlapping entity spans: gates, islands, greedy keep, evidence.

A candidate has file_id, chunk_id, chunk_index, entity_type, raw_entity_type,
source, span_text, start_pos, end_pos, score, normalized_value. Spans of one
chunk are few (a chunk's length is bounded), so the greedy part folds over an
array of small structs of the chunk; everything else is joins and windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cernido.functions import textnorm as tn
from cernido.functions import validators as v
from cernido.tables import written

# Thresholds and the order of detectors.
MODEL_SCORE = 0.90
MODEL_GATE, CONFIDENT_AT, PROBABLE_AT = 0.50, 0.85, 0.50
TOP_K = 5
SOURCE_ORDER = {"presidio": 1, "regex": 2, "deny_list": 2, "gliner2": 3, "medical_model": 4, "humadex": 4}
UNKNOWN_SOURCE = 9
FAR = 10**9

Scorer = Callable[[DataFrame], DataFrame]


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Length that two spans share, 0 if none."""
    return F.greatest(F.lit(0), F.least(a_end, b_end) - F.greatest(a_start, b_start))


def source_rank(source: Column) -> Column:
    order = F.create_map(*[F.lit(x) for pair in SOURCE_ORDER.items() for x in pair])
    return F.coalesce(F.try_element_at(order, source), F.lit(UNKNOWN_SOURCE))


def level_rank(level: Column) -> Column:
    return F.when(level == "VERY_CONFIDENT", 3).when(level == "CONFIDENT", 2).when(level == "PROBABLE", 1).otherwise(0)


def _place(*more: str) -> list[Column]:
    return [F.coalesce("chunk_index", F.lit(FAR)), F.col("start_pos"), F.col("end_pos"), F.col("entity_type"), F.col("raw_entity_type"), *map(F.col, more)]


def decision_order() -> list[Column]:
    """Best first: confidence, decision score, score, length, source, place."""
    return [
        level_rank(F.col("confidence_level")).desc(), F.coalesce("decision_score", F.lit(0.0)).desc(), F.col("score").desc(),
        (F.col("end_pos") - F.col("start_pos")).desc(), source_rank(F.col("source")), *_place("__id"),
    ]


def prefilter_order() -> list[Column]:
    return [F.col("score").desc(), (F.col("end_pos") - F.col("start_pos")).desc(), source_rank(F.col("source")), *_place("span_text", "__id")]


def candidates(spans: DataFrame) -> DataFrame:
    """Spans with canonical type, normalized value and key. Spans without
    length and base values that aren't valid are dropped. Null texts count as
    empty, null scores as 0."""
    text = F.coalesce("span_text", F.lit(""))
    kind = tn.canonical_type(F.coalesce("entity_type", "raw_entity_type"), F.col("raw_entity_type"))
    rows = (
        spans.filter("end_pos > start_pos")
        .withColumn("raw_entity_type", F.coalesce("raw_entity_type", "entity_type"))
        .withColumn("entity_type", kind)
        .withColumn("span_text", text)
        .withColumn("score", F.coalesce("score", F.lit(0.0)))
        .withColumn("source", F.coalesce("source", F.lit("unknown")))
        .withColumn("is_base", F.col("entity_type").isin(*tn.BASE_TYPES))
    )
    other = F.coalesce(F.nullif("normalized_value", F.lit("")), F.lit(None))
    kept_key = F.col("entity_type").isin("CARD_EXPIRY", "CARD_CVV", "BANK_ACCOUNT", "ACCOUNT_ID")
    value = F.when(F.col("is_base"), v.normalized_base(F.col("entity_type"), F.col("span_text"))).when(
        kept_key, tn.text_key(F.coalesce(other, F.col("span_text")))
    ).otherwise(F.coalesce(other, tn.text_key(F.col("span_text"))))
    rows = rows.withColumn("normalized_value", value).filter("NOT is_base OR normalized_value IS NOT NULL")
    digest = F.xxhash64("chunk_id", "start_pos", "end_pos", "entity_type", "raw_entity_type", "source", "span_text", "score", "normalized_value")
    return (
        rows.withColumn("value_key", tn.value_key(F.coalesce(F.nullif("normalized_value", F.lit("")), "span_text")))
        .withColumn("confidence_level", F.when(F.col("is_base"), "VERY_CONFIDENT"))
        .withColumn("decision_score", F.when(F.col("is_base"), 1.0))
        .withColumn("decision_method", F.when(F.col("is_base"), "base_validation"))
        .withColumn("__id", digest)
        .dropDuplicates(["file_id", "chunk_id", "__id"])
    )


_STEP = """
aggregate(cands,
  named_struct('kept', slice(cands, 1, 0), 'links', cast(array() as array<struct<loser:int,winner:int>>)),
  (acc, x) -> CASE
    WHEN exists(acc.kept, k -> {deny_k} AND {ctx_x} AND {over})
      THEN named_struct('kept', acc.kept, 'links', array_append(acc.links, named_struct('loser', x.rank, 'winner',
             array_min(transform(filter(acc.kept, k -> {deny_k} AND {ctx_x} AND {over}), k -> k.rank)))))
    ELSE {rest}
  END)
"""
_OVER = "greatest(k.s, x.s) < least(k.e, x.e)"
_DENY, _CTX = "{v}.raw = 'GENDER_IDENTITY_DENY_LIST'", "{v}.raw = 'GENDER_IDENTITY_CONTEXT_REGEX'"


def _fold() -> Column:
    """Greedy keep in decision order over ``cands`` array<struct<rank,s,e,raw>>:
    {kept, links}. A dictionary hit for gender takes the place of kept hits of
    the context pattern that it overlaps, with their evidence."""
    lost = f"filter(acc.kept, k -> {_DENY.format(v='x')} AND {_CTX.format(v='k')} AND {_OVER})"
    stay = f"filter(acc.kept, k -> NOT ({_DENY.format(v='x')} AND {_CTX.format(v='k')} AND {_OVER}))"
    moved = (
        f"concat(transform(acc.links, l -> named_struct('loser', l.loser, 'winner', "
        f"if(array_contains(transform({lost}, k -> k.rank), l.winner), x.rank, l.winner))), "
        f"transform({lost}, k -> named_struct('loser', k.rank, 'winner', x.rank)))"
    )
    target = f"array_min(transform(filter({stay}, k -> {_OVER}), k -> named_struct('o', -(least(k.e, x.e) - greatest(k.s, x.s)), 'r', k.rank))).r"
    rest = f"""
      if(exists({stay}, k -> {_OVER}),
         named_struct('kept', {stay}, 'links', array_append(transform({moved}, l -> named_struct('loser', l.loser, 'winner',
             if(l.winner = x.rank, {target}, l.winner))), named_struct('loser', x.rank, 'winner', {target}))),
         named_struct('kept', array_append({stay}, x), 'links', {moved}))"""
    return F.expr(_STEP.format(deny_k=_DENY.format(v="k"), ctx_x=_CTX.format(v="x"), over=_OVER, rest=rest))


def greedy(rows: DataFrame) -> DataFrame:
    """(chunk columns, rank, owner): the rank of each candidate of a chunk in
    decision order and the rank of the one that keeps its evidence, its own if
    it is kept. ``rows`` need a ``rank`` column."""
    item = F.struct(F.col("rank"), F.col("start_pos").alias("s"), F.col("end_pos").alias("e"), F.col("raw_entity_type").alias("raw"))
    folded = rows.groupBy("file_id", "chunk_id").agg(F.array_sort(F.collect_list(item)).alias("cands")).withColumn("f", _fold())
    owners = F.concat(
        F.transform("f.kept", lambda k: F.struct(k["rank"].alias("rank"), k["rank"].alias("owner"))),
        F.transform("f.links", lambda link: F.struct(link["loser"].alias("rank"), link["winner"].alias("owner"))),
    )
    return folded.select("file_id", "chunk_id", F.inline(owners))


def ranked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("file_id", "chunk_id").orderBy(*decision_order())))


def overlap_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Interval join within a chunk: all pairs of a left and a right span that
    overlap, with the length they share. The equality on the chunk is hashed;
    the pairs of a chunk are bounded by its length."""
    a, b = left.alias("a"), right.alias("b")
    both = a.join(b, (F.col("a.file_id") == F.col("b.file_id")) & (F.col("a.chunk_id") == F.col("b.chunk_id"))
                  & (F.greatest("a.start_pos", "b.start_pos") < F.least("a.end_pos", "b.end_pos")))
    shared = overlap(F.col("a.start_pos"), F.col("a.end_pos"), F.col("b.start_pos"), F.col("b.end_pos"))
    return both.withColumn("shared", shared)


def islands(rows: DataFrame) -> DataFrame:
    """``rows`` with ``island``: connected groups of overlapping spans of a chunk, from 1."""
    order = Window.partitionBy("file_id", "chunk_id").orderBy("start_pos", "end_pos", "entity_type", "raw_entity_type", "__id")
    reach = F.max("end_pos").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (reach <= F.col("start_pos")), 1).otherwise(0)
    return rows.withColumn("__open", opens).withColumn("island", F.sum("__open").over(order)).drop("__open")


def island_choice(rows: DataFrame) -> DataFrame:
    """The best TOP_K spans of each island, and the best of each type in it."""
    within = Window.partitionBy("file_id", "chunk_id", "island").orderBy(*prefilter_order())
    typed = Window.partitionBy("file_id", "chunk_id", "island", "entity_type").orderBy(*prefilter_order())
    return (
        islands(rows).withColumn("__n", F.row_number().over(within)).withColumn("__t", F.row_number().over(typed))
        .filter((F.col("__n") <= TOP_K) | (F.col("__t") == 1)).drop("__n", "__t")
    )


def gated(rows: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """Candidates of no base type that their route accepts: a local check, a
    score above MODEL_SCORE, or the scorer's score. Without a scorer, types
    that need one are dropped. Other types are dropped."""
    local = v.normalized_local(F.col("entity_type"), F.col("span_text"))
    strict = ~F.col("entity_type").isin("IP_ADDRESS", "MAC_ADDRESS", "URL") | (F.col("score") > MODEL_SCORE)
    checked = rows.filter(F.col("entity_type").isin(*tn.LOCAL_TYPES)).withColumn("__v", local).filter(F.col("__v").isNotNull() & strict)
    checked = checked.withColumn("normalized_value", F.col("__v")).withColumn("value_key", tn.value_key(F.col("__v"))).drop("__v")
    scored = rows.filter(F.col("entity_type").isin(*tn.SCORE_TYPES) & (F.col("score") > MODEL_SCORE))
    out = _decided(checked, "PROBABLE", "score", "local_validation").unionByName(_decided(scored, "PROBABLE", "score", "model_score_threshold"))
    if scorer is not None:
        asked = island_choice(rows.filter(F.col("entity_type").isin(*tn.MODEL_TYPES) & (F.col("score") >= MODEL_GATE))).drop("island")
        answered = scorer(asked).filter(F.col("model_score") >= PROBABLE_AT)
        level = F.when(F.col("model_score") >= CONFIDENT_AT, "CONFIDENT").otherwise("PROBABLE")
        out = out.unionByName(
            answered.withColumn("confidence_level", level).withColumn("decision_score", F.col("model_score"))
            .withColumn("decision_method", F.lit("zero_shot")).drop("model_score")
        )
    return out


def _decided(rows: DataFrame, level: str, score: str, method: str) -> DataFrame:
    return (
        rows.withColumn("confidence_level", F.lit(level)).withColumn("decision_score", F.col(score)).withColumn("decision_method", F.lit(method))
    )


CHUNK = ["file_id", "chunk_id"]


def entity_identity() -> Column:
    """The id of an entity: 16 hex digits of the hash of what it is and where."""
    identity = F.concat_ws("|", "entity_type", "value_key", "chunk_id", "start_pos", "end_pos", "source", "raw_entity_type")
    return F.left(F.sha2(identity, 256), F.lit(16))


def resolve(spans: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """Accepted entities of each file, by the order that decides:

    1. base candidates greedily in decision order, within a chunk;
    2. other candidates that overlap a kept base one give it their evidence;
    3. the rest pass their gates, then the same greedy order within a chunk;
    4. one entity per (type, value key) of a file, with the evidence of all.

    Columns: file_id, entity_index (from 0 by place), entity_id, entity_type,
    text, normalized_value, value_key, source, raw_entity_type, score, is_base,
    confidence_level, decision_score, decision_method, chunk_id, start_pos,
    end_pos, evidence (array by place). Empty input gives no rows.
    """
    rows = written(ranked(candidates(spans)), "candidates")
    base = rows.filter("is_base")
    base_owner = greedy(base)
    kept = base.join(base_owner.filter("rank = owner").select(*CHUNK, "rank"), [*CHUNK, "rank"], "left_semi")
    other = rows.filter("NOT is_base")
    pairs = overlap_pairs(other, kept).select(
        F.col("a.file_id"), F.col("a.chunk_id"), F.col("a.__id"), F.struct((-F.col("shared")).alias("o"), F.col("b.rank").alias("r")).alias("best")
    )
    absorbed = pairs.groupBy(*CHUNK, "__id").agg(F.min("best").alias("best")).select(*CHUNK, "__id", F.col("best.r").alias("owner"))
    free = gated(other.join(absorbed, [*CHUNK, "__id"], "left_anti"), scorer).drop("rank")
    free = written(ranked(free), "gated")
    free_owner = greedy(free)
    # every candidate with the one that owns its evidence
    ids = rows.select(*CHUNK, F.col("rank").alias("owner"), F.col("__id").alias("owner_id"))
    of_base = base.join(base_owner, [*CHUNK, "rank"]).join(ids, [*CHUNK, "owner"]).drop("owner")
    of_other = other.join(absorbed, [*CHUNK, "__id"]).join(ids, [*CHUNK, "owner"]).drop("owner")
    free_ids = free.select(*CHUNK, F.col("rank").alias("owner"), F.col("__id").alias("owner_id"))
    of_free = free.join(free_owner, [*CHUNK, "rank"]).join(free_ids, [*CHUNK, "owner"]).drop("owner")
    evidence = of_base.unionByName(of_other, allowMissingColumns=True).unionByName(of_free)
    survivors = (
        kept.unionByName(free.join(free_owner.filter("rank = owner").select(*CHUNK, "rank"), [*CHUNK, "rank"], "left_semi"))
        .withColumn("dedupe_key", F.coalesce(F.nullif("value_key", F.lit("")), F.concat_ws("|", "chunk_id", "start_pos", "end_pos", "entity_type")))
    )
    best = Window.partitionBy("file_id", "entity_type", "dedupe_key").orderBy(*decision_order(), "chunk_id")
    placed = survivors.withColumn("__n", F.row_number().over(best))
    item = F.struct(
        F.coalesce("e.chunk_index", F.lit(FAR)).alias("chunk_index"), F.col("e.start_pos"), F.col("e.end_pos"), F.col("e.entity_type"),
        F.col("e.raw_entity_type"), F.col("e.source"), F.col("e.span_text").alias("text"), F.col("e.score"), F.col("e.chunk_id"),
    )
    owned = placed.select(*CHUNK, F.col("__id").alias("owner_id"), F.col("entity_type").alias("own_type"), "dedupe_key")
    merged = (
        evidence.alias("e").join(owned.alias("o"), (F.col("e.file_id") == F.col("o.file_id")) & (F.col("e.chunk_id") == F.col("o.chunk_id")) & (F.col("e.owner_id") == F.col("o.owner_id")))
        .groupBy(F.col("o.file_id"), F.col("o.own_type").alias("entity_type"), F.col("o.dedupe_key"))
        .agg(F.array_sort(F.collect_set(item)).alias("evidence"))
    )
    accepted = placed.filter("__n = 1").join(merged, ["file_id", "entity_type", "dedupe_key"])
    index = F.row_number().over(Window.partitionBy("file_id").orderBy(*_place("chunk_id", "__id"))) - 1
    return accepted.select(
        "file_id", index.alias("entity_index"), entity_identity().alias("entity_id"), "entity_type",
        F.col("span_text").alias("text"), "normalized_value", "value_key", "source", "raw_entity_type", F.round("score", 6).alias("score"),
        "is_base", "confidence_level", F.round("decision_score", 6).alias("decision_score"), "decision_method", "chunk_id", "start_pos",
        "end_pos", "evidence",
    )
