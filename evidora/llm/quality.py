"""Rule-based document quality with host verdicts.

Every document gets counts over its whole text, a verdict by each rule, and a base verdict by the first two of them.
Failures are then summed by host (a column of the documents) for each rule, each host's failure rate is shrunk towards
the corpus by a beta prior fitted to the hosts by moments, and the verdict on the host is joined back: a host loses all
its documents if, for any rule, its rate is beyond the limit by ``HOST_DOUBT`` standard deviations of its posterior. The
limit is relative to the corpus: ``HOST_TIMES`` its rate, but ``HOST_LEAST`` at least and ``HOST_MOST`` at most.

Defined cases: a null text has no words and so fails; a null host is a host of its own; repeated rows are judged
separately and alike; an empty table gives an empty result; other columns of the input are not looked at, so their
names can't clash. A host's verdict needs evidence: with few rows the prior holds it near the corpus's rate, and its
posterior is wide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidora.llm.common import SPACE, cut, fresh, let, words_of

#: Production parameters.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
HOST_TIMES, HOST_LEAST, HOST_MOST, HOST_DOUBT = 3.0, 0.3, 0.8, 2.0
BROADCAST_HOSTS = 10_000


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window of ``window`` words that occurs twice or more in ``words``, first one included.

    Windows are compared by 64-bit hashes. Only documents in which a hash recurs pay for the sort by hash and place.
    """
    none = F.lit(0).cast("long")

    def covered(starts: Column) -> Column:
        """Words covered by windows at these ascending starts."""
        step = F.transform(starts, lambda s, k: F.when(k + 1 < F.size(starts), F.least(F.lit(window), F.get(starts, k + 1) - s)).otherwise(window))
        return F.aggregate(step, none, lambda a, x: a + x)

    def recurring(pairs: Column) -> Column:
        same = lambda k, s: F.coalesce(F.get(pairs, k)["h"] == s["h"], F.lit(False))
        kept = F.filter(F.transform(pairs, lambda s, k: F.struct(s["i"].alias("i"), (same(k - 1, s) | same(k + 1, s)).alias("hit"))), lambda x: x["hit"])
        return F.array_sort(F.transform(kept, lambda x: x["i"]))

    def counted(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), none).otherwise(let(pairs, lambda p: let(recurring(p), covered)))

    places = F.sequence(F.lit(0), F.size(words) - window)
    hashes = F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(window)]))
    return F.when(F.size(words) < window, none).otherwise(let(hashes, counted))


def measures(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """``keys`` and the counts of each row: one pass over the text, no shuffle."""
    body = docs.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    counts = let(words_of(F.col("_text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words")))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    counted = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return body.withColumn("_w", counts).withColumn("_l", counted).select(
        *keys, "_w.n_words", "_w.word_chars",
        (F.length("_text") - F.length(F.regexp_replace("_text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        "_l.n_lines", "_l.n_dup_lines", "_w.n_repeat_words")


def rules() -> dict[str, Column]:
    """The rules, over the columns of ``measures``; a document that fails one of the first two fails itself."""
    return {
        "few_words": F.col("n_words") < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"),
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"),
    }


def base_failed() -> Column:
    few, repeats, *_ = rules().values()
    return few | repeats


def failed(measured: DataFrame, *keys: str) -> DataFrame:
    """``keys``, a column for each rule and ``base_failed``."""
    return measured.select(*keys, *[rule.alias(name) for name, rule in rules().items()], base_failed().alias("base_failed"))


def host_verdicts(judged: DataFrame, host: str = "source") -> DataFrame:
    """One row a host: rows, ``host_rate`` (the largest share of the limit that a rule's rate reaches) and ``host_failed``.

    ``judged`` has ``host`` and a column for each rule. A rule's prior has the corpus's failure rate m as its mean. Its
    weight is fitted by moments to the variance v of the hosts' rates: m(1-m)/v - 1, held between 1 and 1000; it is 1000
    where the hosts don't differ.
    """
    names = list(rules())
    hosts = judged.groupBy(host).agg(F.count("*").alias("n"), *[F.count_if(name).alias(name) for name in names])
    total = hosts.agg(F.sum("n"), *[x for name in names for x in (F.sum(name), F.var_pop(F.col(name) / F.col("n")))]).first()  # nine numbers
    lower, failing = [], []
    for k, name in enumerate(names):
        m, v = (total[1 + 2 * k] or 0) / (total[0] or 1), total[2 + 2 * k]
        weight = max(1.0, min(1000.0, m * (1 - m) / v - 1)) if v else 1000.0
        limit = min(HOST_MOST, max(HOST_LEAST, HOST_TIMES * m))
        rate = (F.col(name) + m * weight) / (F.col("n") + weight)
        low = rate - HOST_DOUBT * F.sqrt(rate * (1 - rate) / (F.col("n") + weight + 1))
        lower.append(rate / limit)
        failing.append(low >= limit)
    any_ = failing[0]
    for f in failing[1:]:
        any_ = any_ | f
    return hosts.select(host, "n", F.greatest(*lower).alias("host_rate"), any_.alias("host_failed"))


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """Measures, ``base_failed``, ``host_rate`` and ``kept`` for every row of ``docs`` (doc_id, text and ``host`` are read).

    The measures hold no text, so they are cut to a written table once, then summed by host and joined. The join is an
    ordinary one: small host tables are broadcast by size, and a hot host is split by the adaptive skew join.
    """
    measured = cut(measures(docs, keys=tuple(dict.fromkeys(("doc_id", host)))).withColumn("base_failed", base_failed()))
    hosts = cut(host_verdicts(failed(measured, host), host)).withColumnRenamed(host, "_host").drop("n")
    joined = measured.join(hosts, F.col(host).eqNullSafe(F.col("_host")), "left")
    return joined.select(*measured.columns, "host_rate", (~F.col("base_failed") & ~F.coalesce(F.col("host_failed"), F.lit(False))).alias("kept"))


def keep(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns.

    The words are counted once for the hosts' rates, of which only the host and the rules' verdicts are written, and once
    more where the rows are filtered. Rejected hosts are broadcast while they are ``BROADCAST_HOSTS`` or fewer; only
    beyond that are texts shuffled to meet them.
    """
    other = fresh(docs, "_host")
    judged = cut(failed(measures(docs, keys=(host,)), host))
    hosts = cut(host_verdicts(judged, host).filter("host_failed").select(F.col(host).alias(other)))
    if hosts.count() <= BROADCAST_HOSTS:
        hosts = F.broadcast(hosts)
    counts = let(words_of(F.col("text")), lambda w: F.struct(F.size(w).alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    verdict = let(counts, lambda c: (c["n_words"] >= MIN_WORDS) & (100 * c["n_repeat_words"] <= MAX_REPEAT_PERCENT * c["n_words"]))
    return docs.filter(verdict).join(hosts, F.col(host).eqNullSafe(F.col(other)), "left_anti")
