"""Analytics on top of the store: similarity, prefilter, clusters, scores, ranking quality, citations.

Only criteria are given for these; the formulas are this engine's own choice and are written where they are used.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidora.errors import ConfigError
from evidora.operators.vectors import directed, near_edges, nearest, placed, spanning_forest, unit_rows
from evidora.shared import stored, written

#: Weights of the composite score and the days in which recency halves.
WEIGHTS = {"frequency": "0.30", "intensity": "0.25", "recency": "0.20", "source_diversity": "0.15", "solution_gap": "0.10"}
HALF_LIFE_DAYS = 180
#: Seeds that a lexical prefilter compares with, at most; vectors and seeds of a part where vectors are compared.
SEEDS, SEED_PART = 1000, 8192
#: Quoted spans of one document that are looked for together.
SPANS = 10_000
#: What a cluster's solution gap is worth: criticised tools are the best chance.
GAP = {"none": "0.6", "criticized": "1.0", "approved": "0.2"}


def top_similar(queries: DataFrame, vectors: DataFrame, k: int, block: str) -> DataFrame:
    """The ``k`` vectors most like each query among those of its ``block``: exact, in blocks of matrices, ties by id."""
    return nearest(queries, vectors, k, block)


def prefilter(similarity: Column, text: Column, threshold: float, signals: str) -> Column:
    """candidate if the text is like the seeds or has one of the words that signal a complaint, else noise."""
    return F.when((similarity >= threshold) | F.lower(text).rlike(signals), "candidate").otherwise("noise")


def seed_similarity(vectors: DataFrame, seeds: DataFrame, part: int = SEED_PART) -> DataFrame:
    """``vectors`` (id, vector) with ``similarity``: the largest cosine with any of ``seeds`` (vector), null without a direction.

    Seeds may be many, as a share of all vectors is: both sides are dealt in parts of about ``part``, each pair of parts is one task's product of
    matrices, and a vector's best is the greatest of its parts. Seeds of different length are an error.
    """
    fine = seeds.select("vector").filter(directed(F.col("vector").cast("array<double>"))).distinct()
    widths = [r[0] for r in fine.select(F.size("vector")).distinct().limit(2).collect()]
    if len(widths) > 1:
        raise ConfigError("seeds are of different length")
    held = written(vectors.select("id", "vector").withColumn("_row", F.monotonically_increasing_id()))  # ids may repeat
    own, other = (max(1, -(-rows.count() // part)) for rows in (held, fine))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    wide = directed(F.col("vector").cast("array<double>")) & (F.size("vector") == (widths[0] if widths else -1))
    asked = held.filter(wide).select("_row", F.col("vector").alias("asked"), F.pmod(F.xxhash64("_row"), F.lit(own)).cast("int").alias("_a"), every(other).alias("_b"))
    dealt = fine.select("vector", every(own).alias("_x"), F.pmod(F.xxhash64("vector"), F.lit(other)).cast("int").alias("_y"))

    def compare(v, s):
        import pyarrow as pa

        rows, best = np.zeros(0, np.int64), np.zeros(0)
        if v.num_rows and s.num_rows:
            like, rows, best = unit_rows(s.column("vector")).T, v.column("_row").to_numpy(), np.empty(v.num_rows)
            for start in range(0, v.num_rows, 512):
                best[start : start + 512] = (unit_rows(v.column("asked").slice(start, 512)) @ like).max(1)
        return pa.table({"_row": pa.array(rows), "similarity": pa.array(best)})

    found = asked.groupBy("_a", "_b").cogroup(dealt.groupBy("_x", "_y")).applyInArrow(compare, "_row long, similarity double")
    return held.select("id", "_row").join(found.groupBy("_row").agg(F.max("similarity").alias("similarity")), "_row", "left").select("id", "similarity")


def lexical_scores(documents: DataFrame, seeds: DataFrame, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """id and ``score``: the largest BM25 score of a document (id, body) for any of ``seeds`` (id, body), 0 where none of their words is in it.

    Words are runs of letters and digits in lower case; a seed's distinct words are its terms. The inverse frequency of a
    term in n of N documents is ln(1 + (N - n + 0.5) / (n + 0.5)). Two passes, one for frequencies and lengths and one for scores;
    no document or posting is shuffled. The terms of the seeds are broadcast, so more than ``SEEDS`` seeds are an error.
    """
    if seeds.limit(SEEDS + 1).count() > SEEDS:
        raise ConfigError("seeds are too many", most=SEEDS)
    words = lambda body: F.regexp_extract_all(F.lower(F.coalesce(body, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    said = documents.select("id", words(F.col("body")).alias("w"))
    asked = seeds.select(F.col("id").alias("seed"), F.explode(words(F.col("body"))).alias("term")).distinct().collect()  # of ``SEEDS`` texts at most
    terms, own = sorted({r.term for r in asked}), dict.fromkeys(r.seed for r in asked)
    at, row = {t: k for k, t in enumerate(terms)}, {s: k for k, s in enumerate(own)}
    context = documents.sparkSession.sparkContext
    shared = context.broadcast((terms, np.asarray([(at[r.term], row[r.seed]) for r in asked], np.int64).reshape(-1, 2), len(own)))

    def postings(texts):
        """Document, term and count of every term that a document has, ordered, and the documents' numbers of words."""
        import pyarrow as pa
        import pyarrow.compute as pc

        lengths, flat = pc.list_value_length(texts).to_numpy(zero_copy_only=False).astype(np.int64), texts.flatten()
        known = pc.fill_null(pc.index_in(flat, value_set=pa.array(shared.value[0], flat.type)), -1).to_numpy().astype(np.int64)
        there, most = known >= 0, max(1, len(shared.value[0]))
        found, tf = np.unique((np.repeat(np.arange(len(lengths)), lengths) * most + known)[there], return_counts=True)
        return found // most, found % most, tf, lengths

    def count(batches):
        import pyarrow as pa

        seen, total = np.zeros(len(shared.value[0]) + 2, np.int64), len(shared.value[0])
        for batch in batches:
            _, term, _, lengths = postings(batch.column(0))
            seen += np.bincount(term, minlength=total + 2)
            seen[total:] += len(lengths), lengths.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total + 2)), pa.array(seen)], ["term", "n"])

    sums = np.zeros(len(terms) + 2)
    for r in said.select("w").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():  # a row a term
        sums[r.term] = r.n
    df, total = sums[:-2], sums[-2]
    idf, mean = np.log1p((total - df + 0.5) / (df + 0.5)), sums[-1] / max(1.0, total) or 1.0

    def score(batches):
        import pyarrow as pa

        names, pairs, n = shared.value
        has = np.zeros((len(names), n))
        has[pairs[:, 0], pairs[:, 1]] = 1
        step = max(1, min(512, (1 << 21) // max(1, len(names), n)))  # documents of a product: 16 MB
        for batch in batches:
            best = np.zeros(batch.num_rows)
            doc, term, tf, lengths = postings(batch.column(1))
            weight = idf[term] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * lengths[doc] / mean))
            for start in range(0, batch.num_rows if pairs.size else 0, step):
                a, z = np.searchsorted(doc, (start, start + step))
                some = np.zeros((min(step, batch.num_rows - start), len(names)))
                some[doc[a:z] - start, term[a:z]] = weight[a:z]
                best[start : start + step] = (some @ has).max(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best)], ["id", "score"])

    return said.mapInArrow(score, f"id {documents.schema['id'].dataType.simpleString()}, score double")


def sweep(scored: DataFrame, thresholds: list[float], score: str = "score", label: str = "label") -> DataFrame:
    """Recall and noise rejection at each threshold; one pass, as the thresholds are exploded as a short array."""
    rows = scored.select(F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold"), score, label)
    hit, good = F.col(score) >= F.col("threshold"), F.col(label) == 1
    return rows.groupBy("threshold").agg(
        F.round(F.try_divide(F.count_if(hit & good), F.count_if(good)), 6).alias("recall"),
        F.round(F.try_divide(F.count_if(~hit & ~good), F.count_if(~good)), 6).alias("noise_rejection"))


def quarantine(answers: DataFrame, body: str = "body", required: tuple[str, ...] = ("problem_statement",)) -> DataFrame:
    """``answers`` with ``quarantined``: not a JSON object, or one that lacks a required text; the raw answer is kept."""
    v = F.try_parse_json(F.col(body))
    ok = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    for name in required:
        ok = ok & F.coalesce(F.schema_of_variant(F.variant_get(v, f"$.{name}", "variant")) == "STRING", F.lit(False))
    return answers.withColumn("quarantined", ~ok)


def smallest_reachable(edges: DataFrame, checkpoint) -> DataFrame:
    """node and label (the smallest node reachable) by min-label steps with pointer jumping; ``checkpoint`` writes a frame.

    ``edges``: a, b. Both directions are made here; rounds grow with the logarithm of the longest chain. No label passes through the driver.
    """
    pair = checkpoint(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    least = lambda rows: stored(rows.groupBy("node").agg(F.min("label").alias("label")))
    state = lambda rows: tuple(rows.agg(F.count("*"), F.sum(F.col("label").cast("decimal(38,0)"))).first())  # noqa: E731  labels only fall
    labels = least(pair.toDF("node", "label").union(pair.select("a", "a")))
    now = state(labels)
    while True:
        near = pair.join(labels.hint("merge"), F.col("b") == F.col("node")).select(F.col("a").alias("node"), "label")
        step = least(labels.union(near))
        above = step.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        labels = least(step.union(step.join(above.hint("merge"), F.col("label") == F.col("_n")).select("node", F.col("_l").alias("label"))))
        before, now = now, state(labels)
        if now == before:
            return labels


def clusters(vectors: DataFrame, threshold: float, block: str, checkpoint, count: int | None = None) -> DataFrame:
    """Single-linkage clusters: id and cluster (its smallest id), linked by a cosine of ``threshold`` within a block.

    With ``count`` there are exactly so many, whatever the threshold: the spanning forest of greatest similarities is cut at
    its weakest links, ties in the order of ids. Fewer than blocks (a vector without a direction is one of its own), or
    more than vectors, is an error.
    """
    if count is None:
        kept = near_edges(vectors, threshold, block)
    else:
        forest = checkpoint(spanning_forest(vectors, block))
        total, links = vectors.count(), forest.count()
        if not total - links <= count <= total:
            raise ConfigError("no such number of clusters", count=count, least=total - links, most=total)
        kept = placed(forest, [F.desc("similarity"), F.asc("a"), F.asc("b")]).filter(F.col("place") <= total - count)
    labels = smallest_reachable(checkpoint(kept.select("a", "b")), checkpoint)
    return vectors.select("id").join(labels.hint("merge"), F.col("id") == F.col("node"), "left").select("id", F.coalesce("label", "id").alias("cluster"))


def merged_evidence(members: DataFrame, cluster: str = "cluster", evidence: str = "source_document_ids") -> DataFrame:
    """Per cluster the union of its members' evidence, sorted."""
    each = members.select(cluster, F.explode(evidence).alias("_one")).distinct()
    return each.groupBy(cluster).agg(F.sort_array(F.collect_list("_one")).alias(evidence))


def source_diversity(evidence: DataFrame, cluster: str = "cluster", source: str = "source") -> DataFrame:
    return evidence.groupBy(cluster).agg(F.count_distinct(source).alias("sources"), F.count("*").alias("mentions"))


def decay(age_days: Column, half_life: float = HALF_LIFE_DAYS) -> Column:
    return F.pow(F.lit(0.5), age_days / half_life)


def composite(terms: DataFrame, weights: dict[str, str] = WEIGHTS) -> DataFrame:
    """``terms`` with ``composite``: the weighted sum of its terms, in decimals, so that it is exact."""
    total = None
    for name, weight in weights.items():
        part = F.col(name).cast("decimal(10,6)") * F.lit(weight).cast("decimal(4,2)")
        total = part if total is None else total + part
    return terms.withColumn("composite", total.cast("decimal(20,8)"))


def solution_gap(existing: Column, criticized: Column) -> Column:
    """none, criticized or approved, from how many tools are named and how many of them are criticised."""
    return F.when(existing == 0, "none").when(criticized * 2 >= existing, "criticized").otherwise("approved")


def precision_at(ranked: DataFrame, k: int, group: str, rank: str = "rank", relevant: str = "relevant") -> DataFrame:
    return ranked.filter(F.col(rank) <= k).groupBy(group).agg(F.round(F.sum(F.col(relevant).cast("double")) / k, 6).alias("precision"))


def ndcg(ranked: DataFrame, group: str, rank: str = "rank", gain: str = "gain") -> DataFrame:
    """Normalised discounted cumulative gain per group."""
    ideal = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(gain), rank))
    part = lambda place: F.col(gain) / F.log2(place + 1)
    sums = ranked.withColumn("_ideal", ideal).groupBy(group).agg(F.sum(part(F.col(rank))).alias("dcg"), F.sum(part(F.col("_ideal"))).alias("idcg"))
    return sums.select(group, F.round(F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg")).otherwise(0.0), 6).alias("ndcg"))


def quoted(spans: DataFrame, documents: DataFrame) -> DataFrame:
    """Which distinct ``spans`` (document_id, span) stand word for word in their document: document_id and span, those found.

    All spans of a document are looked for in one pass over its body, by an automaton of them, so time doesn't grow with
    their number. More than ``SPANS`` of one document are dealt to several rows. An empty span stands in any body; a null one,
    or one of an unknown document, in none.
    """
    each = spans.select("document_id", "span").filter("span IS NOT NULL AND document_id IS NOT NULL").distinct()
    sizes = each.groupBy("document_id").agg(F.ceil(F.count("*") / SPANS).alias("_parts"))
    dealt = each.join(sizes, "document_id").groupBy("document_id", F.pmod(F.xxhash64("span"), F.col("_parts")).alias("_part")).agg(F.collect_list("span").alias("spans"))
    bodies = dealt.join(documents.select(F.col("id").alias("document_id"), "body").filter("body IS NOT NULL"), "document_id")
    kind = spans.schema["document_id"].dataType.simpleString()

    def run(batches):
        import ahocorasick
        import pyarrow as pa

        for batch in batches:
            rows, found = [], []
            for k in range(batch.num_rows):
                wanted, body = batch.column(1)[k].as_py(), batch.column(2)[k].as_py()
                automaton = ahocorasick.Automaton()
                for span in filter(None, wanted):
                    automaton.add_word(span, span)
                there = {""} & set(wanted)
                if len(automaton):
                    automaton.make_automaton()
                    there |= {span for _, span in automaton.iter(body)}
                rows += [k] * len(there)
                found += sorted(there)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(found, pa.string())], ["document_id", "span"])

    return bodies.select("document_id", "spans", "body").mapInArrow(run, f"document_id {kind}, span string").distinct()


def citations(spans: DataFrame, documents: DataFrame) -> DataFrame:
    """Per brief whether every quoted span stands word for word in its document; ``spans``: brief, document_id, span."""
    found = quoted(spans, documents).select(F.col("document_id").alias("_document"), F.col("span").alias("_span"), F.lit(True).alias("_found"))
    joined = spans.join(found, (F.col("document_id") == F.col("_document")) & (F.col("span") == F.col("_span")), "left")
    there = F.coalesce("_found", F.lit(False))
    return joined.groupBy("brief").agg(F.bool_and(there).alias("intact"), F.count_if(~there).alias("missing"))


def latest(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row that supersedes the others of its key; all of them stay in the store."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order]))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def traced(members: DataFrame, points: DataFrame, documents: DataFrame) -> DataFrame:
    """cluster, point and document of every piece of evidence, along the whole chain."""
    each = members.join(points, "point").select("cluster", "point", F.explode("source_document_ids").alias("document"))
    return each.join(documents.select(F.col("id").alias("document"), "source"), "document")


def ranked(scores: DataFrame, by: str = "composite", descending: bool = True, least_mentions: int = 0, sources: list[str] | None = None, limit: int | None = None,
           domains: list[str] | None = None, gaps: list[str] | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
    """The table of opportunities: clusters that pass the filters, with ``place`` by one of the score's terms; ties by cluster.

    ``scores``: cluster, mentions, sources (array) and the terms; where they are asked for, also domain, gap (none,
    criticized, approved), first_seen and last_seen. A cluster is within dates if it was seen between them (both included). ``limit``
    is a report's number of rows; a whole table is put in places by ranges, not in one task.
    """
    kept = scores.filter(F.col("mentions") >= least_mentions)
    if sources is not None:
        kept = kept.filter(F.arrays_overlap("sources", F.array(*[F.lit(x) for x in sources])))
    for column, wanted in (("domain", domains), ("gap", gaps)):
        if wanted is not None:
            kept = kept.filter(F.col(column).isin(wanted))
    if since is not None:
        kept = kept.filter(F.col("last_seen") >= F.lit(since).cast("timestamp"))
    if until is not None:
        kept = kept.filter(F.col("first_seen") <= F.lit(until).cast("timestamp"))
    order = [F.desc(by) if descending else F.asc(by), F.asc("cluster")]
    if limit is None:
        return placed(kept, order)
    return kept.orderBy(*order).limit(limit).withColumn("place", F.row_number().over(Window.orderBy(*order)))


def drill_down(table: DataFrame, members: DataFrame, points: DataFrame, documents: DataFrame) -> DataFrame:
    """The evidence behind the rows of a ranked table: place, cluster, point and document."""
    own = table.select("cluster", "place")
    return traced(members.join(own.select("cluster"), "cluster", "left_semi"), points, documents).join(own, "cluster").select("place", "cluster", "point", "document")


def gate(before: DataFrame, after: DataFrame, group: str, metric: str, tolerance: float) -> DataFrame:
    """Per group a metric before and after a change, its difference and ``regressed``: lower by more than ``tolerance``, or gone."""
    both = before.select(group, F.col(metric).alias("before")).join(after.select(group, F.col(metric).alias("after")), group, "full")
    change = F.round(F.col("after") - F.col("before"), 6)
    return both.select(group, "before", "after", change.alias("change"), (F.col("before").isNotNull() & F.coalesce(change < -tolerance, F.lit(True))).alias("regressed"))


def briefs(scores: DataFrame, checked: DataFrame, threshold: float) -> DataFrame:
    """The briefs that are due, one for each cluster whose composite reaches ``threshold``, with ``state``.

    ``checked`` has what ``citations`` gives, by cluster as ``brief``. A brief with a span that is not in its document is
    withheld, as is one without any citation; it stays in the table with the reason.
    """
    due = scores.filter(F.col("composite") >= threshold).join(checked.withColumnRenamed("brief", "cluster"), "cluster", "left")
    state = F.when(F.col("intact").isNull(), "withheld: no citation").when(~F.col("intact"), "withheld: citation not found").otherwise("published")
    return due.select("cluster", "composite", F.coalesce("missing", F.lit(0)).cast("long").alias("missing"), state.alias("state"))


def embedded(documents: DataFrame, embed, model: str, at: str, text: str = "body") -> DataFrame:
    """Rows for the embeddings table: ``embed`` (a list of texts to a list of vectors) is a model that runs in the task itself, in Arrow batches.

    It is no client of a service: a task that is tried again would call, and pay, twice. Services go through ``cost.extract``.

    It is to be given the documents that have no vector yet (store.missing_embeddings), so a second run adds none.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            vectors = embed([x or "" for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([[float(v) for v in x] for x in vectors], pa.list_(pa.float32()))], ["document_id", "vector"])

    made = documents.select(F.col("id").alias("document_id"), text).mapInArrow(run, "document_id string, vector array<float>")
    return made.select(F.sha2(F.concat_ws("\u001f", "document_id", F.lit(model)), 256).alias("id"), "document_id", F.lit(model).alias("model"), "vector", F.lit(at).cast("timestamp").alias("created_at"))


def cost_projection(usage: DataFrame, per_month: int, rate: str) -> DataFrame:
    """Dollars a month for ``per_month`` documents, from the tokens that documents so far have taken; 0 without any."""
    return usage.agg(F.round(F.coalesce(F.avg("tokens"), F.lit(0.0)) * per_month * float(rate) / 1e6, 4).alias("projected_usd"))


def last_known(rows: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """Per group the latest value that is there."""
    return rows.groupBy(group).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias(value))


def export(rows: DataFrame, path: str) -> None:
    """Scalar columns as CSV with a header."""
    rows.write.mode("overwrite").option("header", True).csv(path)


def markdown(rows: DataFrame, limit: int = 500) -> str:
    """The first ``limit`` rows, ordered by all columns, as a table for reading; a last line says so if there are more."""
    found = rows.orderBy(*rows.columns).limit(limit + 1).collect()
    shown = found[:limit]
    cell = lambda x: "" if x is None else str(x).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
    more = [f"The first {limit} rows; there are more."] if len(found) > limit else []
    return "\n".join(lines + ["| " + " | ".join(map(cell, r)) + " |" for r in shown] + more)
