"""Secret scan: three base patterns, and two character Markov models compared by log-likelihood ratio.

The base spans are ``assign`` (a credential name, a colon or equals sign, a value of six characters or more),
``access`` (an access key id) and ``hex`` (a long hexadecimal run). The method adds spans of kind ``markov``: runs of
key characters, ``MIN_RUN`` or longer and outside the base spans, that a first-order Markov model of random strings
explains better than one of ordinary identifiers, by ``MIN_RATIO`` nats a character pair or more.

The models are character-pair counts with add-``SMOOTHING`` smoothing, trained on labelled samples: random are seeded
pseudo-random base64, base62-like and hexadecimal strings in either case; ordinary are identifiers cut from the words of about
``SAMPLE_DOCS`` documents (picked by hash; all if there are fewer), joined as snake case and camel case, and runs of one
character. Runs of letters as long as ``MIN_RUN`` are what is scanned, so they are not taken for ordinary words. Sample
and models are bounded; scoring covers every run of every text. tests/llm/test_secret_scan.py measures recall and
precision on random keys planted in the test documents.

Everything is a column expression. Defined cases: a null text counts as empty; an empty table gives an empty result
(the ordinary model then knows the runs alone); repeated rows are scanned alike; texts of any length are scanned whole;
offsets are code points, end exclusive; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidora.llm.common import before, let, sampled

#: The patterns of the base spans. A match is found first and dropped afterwards where it is too short.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # the runs of [0-9a-f]+ of 24 or more characters
MIN_VALUE, MIN_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "markov")

#: Production parameters of the models.
RUN = "A-Za-z0-9+/_=-"
MIN_RUN = 20
MIN_RATIO = 0.7
SMOOTHING = 0.5
SAMPLE_DOCS = 2000
RANDOM_STRINGS = 2000


def _matches(text: Column, pattern: str, group: int, least: int, kind: int) -> Column:
    """Spans (start, end, kind) of the leftmost matches that don't overlap and whose ``group`` has ``least`` characters."""
    wholes, values = F.regexp_extract_all(text, F.lit(pattern), 0), F.regexp_extract_all(text, F.lit(pattern), group)
    parts = F.arrays_zip(F.split(text, pattern).alias("gap"), wholes.alias("whole"), values.alias("value"))  # one gap more

    def spans(found: Column) -> Column:
        lengths = F.transform(found, lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["whole"]), F.lit(0)))
        placed = let(before(lengths), lambda start: F.transform(found, lambda x, i: F.struct(
            (F.get(start, i) + F.length(x["gap"])).alias("start"),
            (F.get(start, i) + F.length(x["gap"]) + F.length(x["whole"])).alias("end"),
            F.lit(kind).alias("kind"), F.coalesce(F.length(x["value"]) >= least, F.lit(False)).alias("ok"))))
        return F.transform(F.filter(placed, lambda x: x["ok"]), lambda x: F.struct(x["start"], x["end"], x["kind"]))

    none = F.array().cast("array<struct<start:int,end:int,kind:int>>")
    return F.when(text.rlike(pattern), let(parts, spans)).otherwise(none)


def base_spans(text: Column) -> Column:
    """All base spans of ``text`` (never null), by start and then by kind as listed."""
    found = F.concat(_matches(text, ASSIGN, 2, MIN_VALUE, 0), _matches(text, ACCESS, 0, MIN_ACCESS, 1), _matches(text, HEX, 0, 1, 2))
    return _sorted(found)


def _sorted(spans: Column) -> Column:
    keyed = F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    return F.transform(F.array_sort(keyed), lambda x: F.struct(x["start"], x["end"], x["kind"]))


def written(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(name, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """The labelled training samples: rows (sample string, random boolean), bounded by the parameters above."""
    spark = docs.sparkSession
    digest = F.sha2(F.col("id").cast("string"), 512)
    encoded = F.base64(F.unhex(digest))
    made = spark.range(RANDOM_STRINGS).select(F.explode(F.array(
        encoded, F.substring(digest, 1, 40), F.upper(F.substring(digest, 41, 40)), F.regexp_replace(encoded, "[+/=]", ""), F.upper(F.substring(F.regexp_replace(encoded, "[+/=]", ""), 1, 40)),
    )).alias("sample"), F.lit(True).alias("random"))
    picked = sampled(docs.select("doc_id", F.col(text).alias("_text")), SAMPLE_DOCS, "doc_id", "_text")
    words = F.filter(F.regexp_extract_all(F.coalesce("_text", F.lit("")), F.lit("[A-Za-z]+"), 0), lambda w: F.length(w) < MIN_RUN)
    named = picked.select(F.explode(F.array(
        F.array_join(words, "_"), F.array_join(F.transform(words, lambda w: F.initcap(w)), ""), F.array_join(F.transform(words, lambda w: F.lower(w)), "-"),
        F.upper(F.array_join(words, "_")),
    )).alias("sample"), F.lit(False).alias("random"))
    same = spark.range(128).select(F.repeat(F.chr("id"), 400).alias("sample"), F.lit(False).alias("random")).filter(F.col("sample").rlike(f"^[{RUN}]+$"))
    return made.unionByName(named).unionByName(same)


def train(docs: DataFrame, text: str = "text") -> list[float]:
    """log P(b|a, random) - log P(b|a, ordinary) at place 128 a + b; 0 for pairs outside the key characters."""
    chars = F.split("sample", "")
    pairs = samples(docs, text).select("random", F.explode(let(chars, lambda c: F.transform(
        F.sequence(F.lit(1), F.size(c) - 1), lambda i: F.ascii(F.get(c, i - 1)) * 128 + F.ascii(F.get(c, i))))).alias("pair"))
    counts = {True: {}, False: {}}
    for r in pairs.filter(F.col("pair").between(0, 16383)).groupBy("random", "pair").count().collect():  # 2 * 16384 rows at most
        counts[r.random][r.pair] = r["count"]
    inside = [c for c in range(128) if chr(c).isalnum() or chr(c) in "+/_=-"]
    model = [0.0] * 16384
    for a in inside:
        total = {k: sum(counts[k].get(128 * a + b, 0) for b in inside) + SMOOTHING * len(inside) for k in counts}
        for b in inside:
            p = {k: (counts[k].get(128 * a + b, 0) + SMOOTHING) / total[k] for k in counts}
            model[128 * a + b] = math.log(p[True] / p[False])
    return model


def _table(model: list[float]) -> Column:
    """The model as one constant array: a short text that the optimiser folds."""
    return F.split(F.lit(",".join(f"{x:.3f}" for x in model)), ",").cast("array<double>")


def markov_spans(text: Column, base: Column, model: list[float], min_ratio: float = MIN_RATIO) -> Column:
    """Spans of runs outside ``base`` whose mean log-likelihood ratio reaches ``min_ratio``."""
    pattern = f"[{RUN}]{{{MIN_RUN},}}"
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    pairs = _table(model)

    def ratio(run: Column) -> Column:
        score = let(F.split(run, ""), lambda c: F.aggregate(F.sequence(F.lit(1), F.size(c) - 1), F.lit(0.0), lambda a, i: a + F.get(
            pairs, F.ascii(F.get(c, i - 1)) * 128 + F.ascii(F.get(c, i)))))
        return score / (F.length(run) - 1)

    def likely(spans: Column) -> Column:
        both = F.arrays_zip(spans.alias("span"), found.alias("run"))
        free = F.filter(both, lambda x: (ratio(x["run"]) >= min_ratio) & ~F.exists(base, lambda b: (b["start"] < x["span"]["end"]) & (x["span"]["start"] < b["end"])))
        return F.transform(free, lambda x: x["span"])

    none = F.array().cast("array<struct<start:int,end:int,kind:int>>")
    return F.when(text.rlike(pattern), let(_matches(text, pattern, 0, 1, 3), likely)).otherwise(none)


def scan(docs: DataFrame, text: str = "text", model: list[float] | None = None, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys``, ``base`` and ``spans`` (arrays of start, end, kind) for every row; no shuffle."""
    model = train(docs, text) if model is None else model
    rows = docs.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.withColumn("base", let(F.array(F.lit(0)), lambda _: base_spans(F.col("_text"))))
    added = let(F.struct("base", "_text"), lambda x: markov_spans(x["_text"], x["base"], model))
    return rows.select(*keys, "_text", "base", added.alias("_added")).select(*keys, "base", _sorted(F.concat("base", "_added")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of every text replaced by ``mark``; rows, columns and texts without spans stay as they are."""
    model = train(docs, text)
    whole = F.col(text)

    def cleaned(spans: Column) -> Column:
        """Overlapping spans are joined; the text between them is kept."""
        ends = F.transform(spans, lambda x: x["end"])
        between = lambda s, at: F.when(s["start"] >= at, F.concat(F.substring(whole, at + 1, s["start"] - at), F.lit(mark))).otherwise("")
        parts = let(before(ends, lambda a, x: F.greatest(a, x)), lambda reach: F.transform(spans, lambda s, i: between(s, F.get(reach, i))))
        return F.concat(F.array_join(parts, ""), F.substring(whole, F.array_max(ends) + 1, F.length(whole)))

    body = F.coalesce(whole, F.lit(""))
    spans = let(F.struct(base_spans(body).alias("b"), body.alias("t")), lambda x: _sorted(F.concat(x["b"], markov_spans(x["t"], x["b"], model))))
    fixed = let(spans, lambda s: F.when(F.size(s) > 0, cleaned(s)).otherwise(whole))
    return docs.withColumn(text, fixed)
