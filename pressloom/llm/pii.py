"""Personal data, and terms that reveal it, by information-theoretic sanitisation.

Patterns find the protected entities: e-mail addresses, IP addresses, payment cards and phone
numbers. What they share is protected too: the owner and the domain of an address, the network of an IP
address, the first digits of a phone number. A term is a word of letters outside of e-mail addresses.

Over the whole corpus, co-occurrence estimates what a term tells of an entity: its disclosure is the
share of the term's texts that have the entity, bounded from below after Wilson by the number of
different texts that prove it (two are the least). Minus its logarithm is the surprise that is left once
the term is known. A term discloses only what it makes likelier by ``BITS`` bits at least (the pointwise
mutual information). Terms whose disclosure is ``GENERALISE`` or more are generalised to their class
(name, acronym, word); from ``REMOVE`` on they are removed. The demands are the same in a corpus of any
size: more texts without term and entity change no verdict, once the entity is rare enough. All of it is
DataFrame functions.

Terms and entities meet in whole texts. Terms that lie in the same texts are one class there, and so
are entities; those in too few different texts to prove anything, and pairs whose counts cannot reach the
threshold, are never made. Copies count towards frequencies, but not towards the different texts. Null
texts are empty and have no spans. A text of any length is searched whole. In scripts without spaces a run
of letters is one term. Where spans overlap each is reported, and sanitised texts replace their union by
the kind of the first, or the longest of those that start together. Repeated rows are judged each; an
empty table gives no rows. Other columns of a table stay as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.quality_rules import let
from pressloom.llm.shared import fresh, stored

#: Kinds and what they match. The possessive forms match what the plain ones do, in linear time: a
#: run of characters that cannot be part of a match is left after one attempt.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERALISE, REMOVE, BITS = 0.5, 0.8, 3
#: The square of the 90 % quantile: n texts of n bound their share by n / (n + DOUBT), after Wilson.
DOUBT = 1.64
#: Up to so many rows, spans or terms in all are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
TERM = r"(?<![\p{L}\p{N}])\p{L}{3,}+(?![\p{L}\p{N}])"

_SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"
_BLOCK = 256


def matches(text: Column, pattern: Column, kind: str) -> Column:
    """Leftmost matches that do not overlap: kind, start, end (code points), value.

    Splitting gives the text between matches, so places are sums of lengths. They are summed in
    blocks, to stay linear in the number of matches.
    """

    def places(s: Column) -> Column:
        def block(done: Column, b: Column) -> Column:
            def one(state: Column, i: Column) -> Column:
                value = s["values"][i]
                start = state["at"] + F.length(s["between"][i])
                end = start + F.length(value)
                span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), value.alias("value"))
                return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

            last = F.least((b + 1) * _BLOCK, F.size(s["values"])) - 1
            own = F.aggregate(
                F.sequence(b * _BLOCK, last), F.struct(done["at"].alias("at"), F.array().cast(_SPAN).alias("spans")), one
            )
            return let(own, lambda o: F.struct(o["at"].alias("at"), F.concat(done["blocks"], F.array(o["spans"])).alias("blocks")))

        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("blocks"))
        blocks = F.sequence(F.lit(0), F.floor((F.size(s["values"]) - 1) / _BLOCK).cast("int"))
        return F.flatten(F.aggregate(blocks, start, block)["blocks"])

    values = F.regexp_extract_all(text, pattern, F.lit(0))
    both = let(
        values,
        lambda v: F.when(F.size(v) > 0, F.struct(v.alias("values"), F.split(text, pattern, -1).alias("between"))),
    )
    return F.coalesce(let(both, lambda s: F.when(s.isNotNull(), places(s))), F.array().cast(_SPAN))


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    count = F.length(_digits(value))
    if kind == "card":
        return F.when(count.between(13, 19), _luhn(_digits(value))).otherwise(F.lit(False))
    return count.between(9, 15) if kind == "phone" else F.lit(True)


def found(text: Column) -> Column:
    """All valid spans of the base kinds, by kind as listed, then start."""

    def valid(kind: str) -> Column:
        return F.filter(matches(text, F.lit(PATTERNS[kind]), kind), lambda s: _valid(kind, s["value"]))

    return F.concat(*map(valid, PATTERNS))


def _terms(text: Column) -> Column:
    """The different terms outside of e-mail addresses; other kinds hold no letters."""
    outside = F.regexp_replace(text, F.lit(PATTERNS["email"]), F.lit("0"))
    return F.array_distinct(F.transform(F.regexp_extract_all(outside, F.lit(TERM), F.lit(0)), lambda w: F.lower(w)))


def _key(text: Column) -> Column:
    """Of a text; 128 bits."""
    return F.md5(text)


def _small(df: DataFrame, weight: Column | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` to be broadcast if it holds up to ``most`` rows, or so much of what ``weight`` counts in a row."""
    total = df.agg(F.sum(F.lit(1) if weight is None else weight + 1)).first()[0] or 0
    return F.broadcast(df) if total <= most else df


def based(docs: DataFrame) -> DataFrame:
    """doc_id, text key, base spans and the terms of texts with spans; stored, so texts are searched once."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), _key(text).alias("key"), let(text, found).alias("spans"))
    return stored(rows.select("doc_id", "key", "spans", F.when(F.size("spans") > 0, _terms(F.col("text"))).alias("terms")))


#: What texts a term or an entity lies in: their number, and two sums of hashes.
_TEXTS = ("texts", "sum", "xor")


def _texts() -> list[Column]:
    key = F.xxhash64("key")
    return [F.count("*").alias("texts"), F.sum(F.shiftright(key, 32)).alias("sum"), F.bit_xor(key).alias("xor")]


def _entities(spans: Column) -> Column:
    """Hashes of what is protected in a text: each entity, and what it has in common with others."""

    def of(s: Column) -> Column:
        value, kind = F.lower(s["value"]), s["kind"]
        digits = _digits(value)
        own = F.xxhash64(F.lit("value"), kind, value)
        mail = F.array(own, F.xxhash64(F.lit("owner"), F.substring_index(value, "@", 1)), F.xxhash64(F.lit("domain"), F.substring_index(value, "@", -1)))
        network = F.array(own, F.xxhash64(F.lit("network"), F.substring_index(value, ".", 3)))
        office = F.array(own, F.xxhash64(F.lit("prefix"), F.substring(digits, 1, 6)))
        return F.when(kind == "email", mail).when(kind == "ip", network).when(kind == "phone", office).otherwise(F.array(own))

    return F.array_distinct(F.flatten(F.transform(spans, of)))


def revealing(docs: DataFrame, base: DataFrame, doubt: float = DOUBT, least: float = GENERALISE, bits: float = BITS) -> DataFrame:
    """term, disclosure for the terms whose disclosure of some entity is ``least`` or more."""
    found_ = base.filter(F.size("spans") > 0).select("key", _entities(F.col("spans")).alias("entities"), "terms")
    one = [F.first(c).alias(c) for c in ("entities", "terms")]
    found_ = stored(found_.groupBy("key").agg(F.count("*").alias("copies"), *one))
    rows = float(base.count())
    proves = F.col("texts") / (F.col("texts") + doubt) * (1 + 1e-9) >= least

    own = found_.select("key", "copies", F.explode("entities").alias("entity"))
    of_entity = own.groupBy("entity").agg(F.sum("copies").alias("with_entity"), *_texts())
    of_entity = stored(of_entity.filter(proves).filter(F.log2(rows / F.col("with_entity")) >= bits))
    reach = of_entity.agg(F.max("with_entity")).first()[0]
    if reach is None:
        return found_.select(F.lit("").alias("term"), F.lit(1.0).alias("disclosure")).limit(0)
    of_entity = of_entity.groupBy("with_entity", *_TEXTS).agg(F.min("entity").alias("entity"))
    of_entity = stored(of_entity.select("entity", "with_entity"))
    own = own.select("key", "entity").join(_small(of_entity), "entity")

    # Of a term in more texts than ``reach / least``, too few can have any one entity.
    beside = found_.select("key", "copies", F.explode("terms").alias("term"))
    of_term = beside.groupBy("term").agg(*_texts()).filter(proves)
    counts = docs.select(F.explode(_terms(F.coalesce("text", F.lit("")))).alias("term"))
    counts = counts.groupBy("term").agg(F.count("*").alias("with_term")).filter(F.col("with_term") * least <= reach * (1 + 1e-9))
    of_term = stored(of_term.join(counts, "term"))
    classes = stored(of_term.groupBy("with_term", *_TEXTS).agg(F.min("term").alias("class")))
    met = beside.join(_small(classes.select(F.col("class").alias("term"), "with_term")), "term")

    possible = F.col("with_term") * least <= F.col("with_entity") * (1 + 1e-9)
    both = met.join(own, "key").filter(possible).groupBy("term", "with_term", "entity", "with_entity")
    both = both.agg(F.sum("copies").alias("both"), F.count("*").alias("texts"))
    share = F.col("both") / F.col("with_term")
    disclosure = share * F.col("texts") / (F.col("texts") + doubt)
    gained = F.log2(share * rows / F.col("with_entity"))
    told = both.filter((gained >= bits) & (disclosure * (1 + 1e-9) >= least))
    told = told.groupBy(F.col("term").alias("class")).agg(F.max(disclosure).alias("disclosure")).join(classes, "class")
    return of_term.join(told.drop("class"), ["with_term", *_TEXTS]).select("term", "disclosure")


def _term_spans(docs: DataFrame, terms: DataFrame, remove: float) -> DataFrame:
    """key and spans of revealing terms for the texts that have some."""
    text = F.coalesce("text", F.lit(""))
    words = docs.select(_key(text).alias("key"), F.explode(_terms(text)).alias("term"))
    met = words.join(_small(terms), "term").distinct()
    by_text = met.groupBy("key").agg(
        F.array_join(F.collect_list("term"), "|").alias("any"),
        F.collect_list(F.when(F.col("disclosure") >= remove, F.col("term"))).alias("removed"),
    )
    by_text = stored(by_text)
    # Terms of a text are at most its length; a long one weighs more.
    small = _small(by_text, F.floor(F.length("any") / 16))
    texts = docs.select(_key(text).alias("key"), text.alias("text")).join(small, "key").dropDuplicates(["key"])
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.col("any"), F.lit(r")(?![\p{L}\p{N}])"))
    spans = matches(F.col("text"), pattern, "term")

    def named(s: Column) -> Column:
        kind = F.when(F.array_contains("removed", F.lower(s["value"])), "removed").otherwise("term")
        return F.struct(kind.alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))

    return stored(texts.select("key", F.transform(spans, named).alias("more")))


def spans(docs: DataFrame, doubt: float = DOUBT, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """doc_id, key and spans per row: base ones by kind and start, then terms outside of those by start."""
    base = based(docs)
    terms = stored(revealing(docs, base, doubt, generalise))
    if terms.isEmpty():
        return base.select("doc_id", "key", "spans")
    more = _term_spans(docs, terms, remove)
    more = _small(more, F.size("more"))
    joined = base.join(more, "key", "left")
    free = F.filter(
        F.coalesce("more", F.array().cast(_SPAN)),
        lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])),
    )
    return joined.select("doc_id", "key", F.concat("spans", free).alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    """Counts per kind, a digest of the base spans, and all spans as text."""
    rows = spans(docs)

    def joined(chosen: Column) -> Column:
        return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*PATTERNS))
    counts = map(count, PATTERNS)
    return rows.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def sanitised(text: Column, found_spans: Column) -> Column:
    """``text`` with spans replaced by their kinds, terms by their classes; removed ones leave nothing.

    Of spans that overlap the union is replaced.
    """
    ordered = F.array_sort(F.transform(found_spans, lambda s: F.struct(s["start"].alias("a"), (-s["end"]).alias("b"), s["kind"].alias("kind"), s["value"].alias("value"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def put(done: Column, s: Column) -> Column:
        before = F.substring(text, done["at"] + 1, s["a"] - done["at"])
        term = F.when(s["value"].rlike(r"^\p{Lu}+$"), "<ACRONYM>").when(s["value"].rlike(r"^\p{Lu}"), "<NAME>").otherwise("<WORD>")
        kind = F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        mark = F.when(s["kind"] == "removed", "").when(s["kind"] == "term", term).otherwise(kind)
        moved = F.struct((-s["b"]).alias("at"), F.concat(done["parts"], F.array(before, mark)).alias("parts"))
        longer = F.struct(F.greatest(done["at"], -s["b"]).alias("at"), done["parts"].alias("parts"))
        return F.when(s["a"] >= done["at"], moved).otherwise(longer)

    rest = let(
        F.aggregate(ordered, start, put),
        lambda d: F.concat(F.array_join(d["parts"], ""), F.substring(text, d["at"] + 1, F.length(text) - d["at"])),
    )
    return F.when(F.size(found_spans) > 0, rest).otherwise(text)


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with sanitised texts; other columns stay, null texts too."""
    key, found_ = fresh(docs, "text_key"), fresh(docs, "found_spans")
    own = spans(docs).filter(F.size("spans") > 0).select(F.col("key").alias(key), F.col("spans").alias(found_)).dropDuplicates([key])
    own = _small(stored(own), F.size(found_))
    joined = docs.withColumn(key, _key(F.col("text"))).join(own, key, "left")
    text = F.when(F.col(found_).isNull(), F.col("text")).otherwise(sanitised(F.col("text"), F.col(found_)))
    return joined.withColumn("text", text).select(*docs.columns)
