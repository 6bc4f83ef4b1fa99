"""Personal data: four base patterns, and the terms that give a protected entity away, by information content.

Base spans are ``email``, ``ip``, ``card`` (16 to 19 digits that pass Luhn's check) and ``phone``; each value found is a
protected entity. A term is a word of three characters or more, one of them a letter, in lower case. Over all distinct texts
of the corpus, N of them, an entity e in df(e) texts has the information content IC = ln(N / df(e)), and a term t, in
df(t) texts, that stands within ``CONTEXT`` characters of e in c of them has the pointwise mutual information
PMI = ln(N c / (df(e) df(t))). PMI / IC is the share of what identifies e that t discloses: 1 where t occurs beside e only.
Terms that disclose ``GENERALISE`` or more become spans of kind ``term``, wherever they occur; ``sanitise`` replaces them
by a class, or removes them from ``REMOVE`` on. A pair needs ``MIN_CONTEXTS`` different contexts and as many texts, so that
copies of one passage, or one text that repeats it, are no evidence.

Everything is a column expression or a join. Contexts are gathered for entities only that have enough of them, and terms are
counted over all texts only where some entity has them beside it and they could disclose enough, by the texts in which
they stand beside any entity; the candidates are broadcast while they are
``BROADCAST_TERMS`` or fewer and joined beyond that. Nothing is sampled or cut.

Defined cases: a null text counts as empty; equal texts count once in the statistics and get the same spans; an entity in
all texts discloses nothing more; terms inside base spans are no spans; an empty table gives an empty result; texts of any
length are scanned whole, in time in proportion to their length; offsets are code points, end exclusive; other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidora.llm.common import before, cut, fresh, let

#: The patterns, written so that no text takes more than linear time; kinds in their order.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "term")
TERM = r"[\p{L}\p{M}\p{N}]{3,}"

#: Production parameters.
CONTEXT = 80
MIN_CONTEXTS = 3
GENERALISE, REMOVE = 0.9, 0.97
BROADCAST_TERMS = 200_000

_SPANS = "array<struct<kind:int,start:int,end:int>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether Luhn's sum is a multiple of ten: every second digit from the right is doubled and its digits are added."""
    def worth(i: Column) -> Column:
        d = F.ascii(F.substring(digits, F.length(digits) - i, F.lit(1))) - 48
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + worth(i)) % 10 == 0


def _is_ip(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda p: let(F.ltrim(p, F.lit("0")), lambda x: (F.length(x) < 3) | ((F.length(x) == 3) & (x <= "255"))))


def _is_card(value: Column) -> Column:
    return let(_digits(value), lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(False))


def _is_phone(value: Column) -> Column:
    return F.length(_digits(value)).between(8, 15)


#: By kind: pattern, a test that says whether a text may have any, a test of a match, and the entity that a match names.
_RULES: list[tuple[str, Callable, Callable, Callable]] = [
    (EMAIL, lambda t: t.contains("@"), lambda v: F.lit(True), F.lower),
    (IP, lambda t: t.rlike(IP), _is_ip, lambda v: v),
    (CARD, lambda t: t.rlike(r"(?:[0-9][\x20-]?){15}[0-9]"), _is_card, _digits),
    (PHONE, lambda t: t.contains("+"), _is_phone, _digits),
]


def _split(text: Column, pattern: str) -> Column:
    """The text in order as gaps and the matches that follow them; the last match is null."""
    return F.arrays_zip(F.split(text, pattern).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"))


def _placed(parts: Column, span: Callable[[Column, Column, Column, Column], Column]) -> Column:
    """``span(part, index, start, end)`` of every match of ``parts``; the last part, without a match, gives nothing."""
    lengths = F.transform(parts, lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["whole"]), F.lit(0)))
    return let(before(lengths), lambda at: F.transform(F.filter(F.transform(parts, lambda x, i: F.struct(
        x.alias("x"), i.alias("i"), (F.get(at, i) + F.length(x["gap"])).alias("s"))), lambda m: m["x"]["whole"].isNotNull()),
        lambda m: span(m["x"], m["i"], m["s"], m["s"] + F.length(m["x"]["whole"]))))


def _of_kind(text: Column, kind: int) -> Column:
    pattern, there, good, _ = _RULES[kind]
    span = lambda x, i, s, e: F.struct(F.lit(kind).alias("kind"), s.alias("start"), e.alias("end"), good(x["whole"]).alias("ok"))
    found = F.filter(let(_split(text, pattern), lambda p: _placed(p, span)), lambda x: x["ok"])
    return F.when(there(text), F.transform(found, lambda x: F.struct(x["kind"], x["start"], x["end"]))).otherwise(F.array().cast(_SPANS))


def base_spans(text: Column) -> Column:
    """All base spans of ``text`` (never null) as kind, start and end, by kind as listed and then by start."""
    return F.concat(*[_of_kind(text, k) for k in range(len(_RULES))])


def written(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(name, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _mentions(text: Column, kind: int) -> Column:
    """Each base match of a kind as its entity and what stands around it, whole words up to the next match of its pattern."""
    pattern, there, good, entity = _RULES[kind]

    def around(parts: Column) -> Column:
        def span(x: Column, i: Column, _s: Column, _e: Column) -> Column:
            after = F.get(parts, i + 1)["gap"]
            left = F.when(F.length(x["gap"]) > CONTEXT, F.regexp_replace(F.right(x["gap"], F.lit(CONTEXT)), r"^[\p{L}\p{M}\p{N}]+", "")).otherwise(x["gap"])
            right = F.when(F.length(after) > CONTEXT, F.regexp_replace(F.left(after, F.lit(CONTEXT)), r"[\p{L}\p{M}\p{N}]+$", "")).otherwise(after)
            return F.struct(F.concat(F.lit(f"{kind}:"), entity(x["whole"])).alias("entity"), F.concat(left, F.lit(" | "), right).alias("context"), good(x["whole"]).alias("ok"))

        return F.filter(_placed(parts, span), lambda m: m["ok"])

    none = F.array().cast("array<struct<entity:string,context:string,ok:boolean>>")
    return F.when(there(text), let(_split(text, pattern), around)).otherwise(none)


def terms_of(text: Column) -> Column:
    """The distinct terms of a text; addresses give none."""
    plain = F.when(text.contains("@"), F.regexp_replace(text, EMAIL, " ")).otherwise(text)
    return F.filter(F.array_distinct(F.regexp_extract_all(F.lower(plain), F.lit(TERM), F.lit(0))), lambda w: w.rlike(r"\p{L}"))


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """Texts with their 128-bit name."""
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return rows.select("_text", F.struct(F.xxhash64("_text").alias("a"), F.xxhash64(F.lit(1), "_text").alias("b")).alias("key"))


def disclosures(docs: DataFrame, text: str = "text", least: float = GENERALISE) -> DataFrame:
    """entity, term, texts (of both side by side), contexts, df_entity, df_term and share (PMI / IC, ``least`` or more)."""
    keyed = _keyed(docs, text)
    found = F.explode(F.concat(*[_mentions(F.col("_text"), k) for k in range(len(_RULES))])).alias("m")
    said = cut(keyed.select("key", found).select("key", F.col("m.entity").alias("entity"), F.col("m.context").alias("context")).distinct())
    known = said.groupBy("entity").agg(F.count_distinct("key").alias("df_entity"), F.count_distinct("context").alias("contexts"))
    enough = lambda c: F.least(c, "contexts") >= MIN_CONTEXTS
    known = cut(known.filter(enough("df_entity")).drop("contexts"))
    beside = said.join(known.select("entity"), "entity", "left_semi").select("entity", "key", F.xxhash64("context").alias("context"), F.explode(terms_of(F.col("context"))).alias("term"))
    pairs = beside.groupBy("entity", "term").agg(F.count_distinct("key").alias("texts"), F.count_distinct("context").alias("contexts"))
    pairs = cut(pairs.filter(enough("texts")))
    total, = (keyed.select("key").distinct().agg(F.count("*")).first() if not pairs.isEmpty() else (0,))

    def share(df_term: str) -> Column:
        content = F.log(F.lit(float(max(1, total))) / F.col("df_entity"))
        return F.when(content > 0, (content + F.log(F.col("texts") / F.col(df_term))) / content)

    # The texts in which a term stands beside any entity are some of all its texts, so they bound the share from above.
    seen = said.select("key", F.explode(terms_of(F.col("context"))).alias("term")).distinct().groupBy("term").agg(F.count("*").alias("seen"))
    pairs = cut(pairs.join(known, "entity").join(seen, "term").filter(share("seen") >= least - 1e-12).drop("seen"))
    wanted = cut(pairs.select("term").distinct())
    count = wanted.count()
    words = keyed.select("key", F.explode(terms_of(F.col("_text"))).alias("term"))
    if count <= BROADCAST_TERMS:
        words = words.join(F.broadcast(wanted), "term", "left_semi")
    df = words.distinct().groupBy("term").agg(F.count("*").alias("df_term")) if count else wanted.select("term", F.lit(0).cast("long").alias("df_term"))
    return pairs.join(df, "term").select("entity", "term", "texts", "contexts", "df_entity", "df_term", share("df_term").alias("share")).filter(F.col("share") >= least - 1e-12)


def disclosing(docs: DataFrame, text: str = "text") -> DataFrame:
    """``key`` of each distinct text with such terms, its ``general`` terms and those to be ``removed``."""
    levels = cut(disclosures(docs, text).groupBy("term").agg((F.max("share") >= REMOVE - 1e-12).alias("gone")))
    count = levels.count()
    if not count:
        return docs.sparkSession.createDataFrame([], "key struct<a: long, b: long>, general array<string>, removed array<string>")
    held = _keyed(docs, text).select("key", F.explode(terms_of(F.col("_text"))).alias("term")).join(F.broadcast(levels) if count <= BROADCAST_TERMS else levels, "term").distinct()
    pick = lambda c: F.collect_list(F.when(c, F.col("term")))  # noqa: E731  within one text: its own distinct words at most
    return held.groupBy("key").agg(pick(~F.col("gone")).alias("general"), pick(F.col("gone")).alias("removed"))


def _masked(text: Column) -> Column:
    """``text`` with everything that a base pattern matches as spaces, in its length."""
    for pattern, there, *_ in _RULES:
        blank = lambda p: F.array_join(F.transform(p, lambda x: F.concat(x["gap"], F.repeat(F.lit(" "), F.coalesce(F.length(x["whole"]), F.lit(0))))), "")
        text = let(text, lambda t: F.when(there(t), let(_split(t, pattern), blank)).otherwise(t))  # noqa: B023  called at once
    return text


def term_spans(text: Column, terms: Column) -> Column:
    """Spans of ``terms`` in ``text`` outside the base patterns; null or no terms give none."""
    span = lambda x, i, s, e: F.struct(F.lit(4).alias("kind"), s.alias("start"), e.alias("end"), F.array_contains(terms, F.lower(x["whole"])).alias("ok"))
    found = F.filter(let(_split(_masked(text), TERM), lambda p: _placed(p, span)), lambda x: x["ok"])
    return F.when(F.size(terms) > 0, F.transform(found, lambda x: F.struct(x["kind"], x["start"], x["end"]))).otherwise(F.array().cast(_SPANS))


def _known(rows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """``rows`` (with ``_text``) and the terms ``_general`` and ``_removed`` of each text."""
    found = cut(disclosing(docs, text)).select(F.col("key.a").alias("_a"), F.col("key.b").alias("_b"), F.col("general").alias("_general"), F.col("removed").alias("_removed"))
    if found.isEmpty():
        none = F.array().cast("array<string>")
        return rows.withColumn("_general", none).withColumn("_removed", none)
    return rows.join(found, (F.xxhash64("_text") == F.col("_a")) & (F.xxhash64(F.lit(1), "_text") == F.col("_b")), "left").drop("_a", "_b")


def scan(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys``, ``base`` and ``spans`` (arrays of kind, start and end, by kind and start) for every row."""
    rows = _known(docs.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("_text")), docs, text)
    terms = F.concat(F.coalesce("_general", F.array().cast("array<string>")), F.coalesce("_removed", F.array().cast("array<string>")))
    both = let(F.struct(F.col("_text").alias("t"), terms.alias("w")), lambda x: F.struct(base_spans(x["t"]).alias("base"), term_spans(x["t"], x["w"]).alias("terms")))
    return rows.select(*keys, both.alias("_found")).select(*keys, F.col("_found.base").alias("base"), F.concat("_found.base", "_found.terms").alias("spans"))


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with base spans replaced by their kind, disclosing terms by ``[NAME]`` (capitalised) or ``[TERM]``, and strongly disclosing ones removed.

    Rows and columns stay; a text without any span stays as it is. Overlapping spans become one, named by its first.
    """
    body = fresh(docs, "_text")
    none = F.array().cast("array<string>")
    wide = _known(docs.select(F.struct(*docs.columns).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text")), docs, text)
    both = let(F.struct(F.col("_text").alias("t"), F.coalesce("_general", none).alias("g"), F.coalesce("_removed", none).alias("r")), lambda x: F.concat(
        base_spans(x["t"]), term_spans(x["t"], x["g"]), F.transform(term_spans(x["t"], x["r"]), lambda s: F.struct((s["kind"] + 1).alias("kind"), s["start"], s["end"]))))

    def cleaned(spans: Column, chars: Column) -> Column:
        ends = F.transform(spans, lambda s: s["end"])
        part = lambda a, b: F.array_join(F.slice(chars, a + 1, b - a), "")
        first = lambda s: F.get(chars, s["start"])
        mark = lambda s: F.when(s["kind"] == 5, "").when((s["kind"] == 4) & (first(s) != F.lower(first(s))), "[NAME]").otherwise(F.get(F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS]), s["kind"]))
        pieces = let(before(ends, lambda a, x: F.greatest(a, x)), lambda reach: F.transform(spans, lambda s, i: F.when(s["start"] >= F.get(reach, i), F.concat(part(F.get(reach, i), s["start"]), mark(s))).otherwise("")))
        return F.concat(F.array_join(pieces, ""), let(F.array_max(ends), lambda last: part(last, F.size(chars))))

    ordered = F.transform(F.array_sort(F.transform(both, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))), lambda s: F.struct(s["kind"], s["start"], s["end"]))
    chars = F.filter(F.split("_text", ""), lambda c: c != "")
    fixed = let(ordered, lambda s: F.when(F.size(s) > 0, let(chars, lambda c: cleaned(s, c))))
    done = wide.select("_row", fixed.alias(body))
    return done.select(*[F.coalesce(F.col(body), F.col(f"_row.`{c}`")).alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
