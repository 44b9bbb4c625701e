"""Personal data: found by pattern, and information-theoretic sanitisation of what gives it away.

Addresses, phone and card numbers found by pattern are the protected entities. A word that stands near an entity
in several different texts is a candidate; what it discloses is the mutual information of word and
entity against the information content of the entity itself, both from counts over all documents:

    disclosure = log2(p(word, entity) / (p(word) p(entity))) / -log2 p(entity)

It is 1 for a word that only ever comes with the entity and 0 for one that is independent of it. Words from
DISCLOSURE on are hidden too, in the documents that hold the entity. All of it is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.llm.tables import written

CONTEXT_WORDS = 5
MIN_CONTEXTS = 3
DISCLOSURE = 0.8
TERM = "term"
_STEP = 256


@dataclass(frozen=True)
class _Kind:
    """A pattern, a quick test that every match passes, and what makes a match valid.

    Patterns are possessive and start where no earlier start could have matched, so that time is linear
    in the text and the stack is bounded; they match the same as the plain ones.
    """

    name: str
    pattern: str
    hint: str

    def valid(self, match: Column) -> Column:
        digits = F.regexp_replace(match, "[^0-9]", "")
        if self.name == "ip":
            return match.rlike(r"^(0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.|$)){4}$")
        if self.name == "card":
            return F.length(digits).between(12, 19) & (_luhn(digits) % 10 == 0)
        if self.name == "phone":
            return F.length(digits).between(9, 15)
        return F.lit(True)


KINDS = (
    _Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
    ),
    _Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    _Kind("card", r"[0-9](?:[ \-]?[0-9])++", ""),
    _Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+"),
)


def _luhn(digits: Column) -> Column:
    """The Luhn sum: every second digit from the right is doubled and its digits added."""
    places = F.sequence(F.lit(1), F.length(digits))
    digit = lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
    return F.aggregate(
        places,
        F.lit(0),
        lambda total, i: total
        + F.when(i % 2 == 1, digit(i)).otherwise((digit(i) * 2) % 10 + F.floor(digit(i) / 5).cast("int")),
    )


def _running(lengths: str) -> Column:
    """Sums of the elements before each element, in blocks so that no long array is copied often."""
    inner = """aggregate(block, named_struct('at', total.at, 'out', cast(array() as array<bigint>)),
        (x, n) -> named_struct('at', x.at + n, 'out', concat(x.out, array(x.at)))).out"""
    return F.expr(f"""
        flatten(aggregate(
            if(size({lengths}) = 0, cast(array() as array<array<bigint>>),
               transform(sequence(1, size({lengths}), {_STEP}), i -> slice({lengths}, i, {_STEP}))),
            named_struct('at', 0L, 'out', cast(array() as array<array<bigint>>)),
            (total, block) -> named_struct(
                'at', total.at + aggregate(block, 0L, (a, n) -> a + n),
                'out', concat(total.out, array({inner})))
        ).out)
    """)  # fmt: skip


def _entity(kind: _Kind, match: Column) -> Column:
    """One name for all spellings of an entity."""
    plain = F.lower(match) if kind.name in ("email", "ip") else F.regexp_replace(match, "[^0-9]", "")
    return F.concat(F.lit(kind.name + ":"), plain)


#: The first words of a text with all that stands before and between them. Possessive, so that time is linear.
_FIRST_WORDS = rf"^(?:[^\p{{L}}\p{{N}}@]*+[\p{{L}}\p{{N}}@]++){{0,{CONTEXT_WORDS}}}"


def _words_near(piece: Column, last: bool) -> Column:
    """The CONTEXT_WORDS words of a piece of text next to a match, whatever their length and what lies between."""
    from_match = F.reverse(piece) if last else piece
    near = F.regexp_extract(from_match, _FIRST_WORDS, 0)
    words = F.split(F.lower(F.reverse(near) if last else near), r"[^\p{L}\p{N}@]+")
    words = F.filter(words, lambda w: F.length(w) > 0)
    first = F.greatest(F.size(words) - CONTEXT_WORDS, F.lit(0)) + 1 if last else F.lit(1)
    return F.slice(words, first, F.lit(CONTEXT_WORDS))


def _spans(number: int, kind: _Kind) -> Column:
    """The valid matches of one kind, from what stands between matches; null without matches."""
    m, p, before = F.col(f"_m_{kind.name}"), F.col(f"_p_{kind.name}"), _running(f"_l_{kind.name}")
    each = F.arrays_zip(
        before.alias("before"), m.alias("match"),
        F.slice(p, F.lit(1), F.size(m)).alias("left"), F.slice(p, F.lit(2), F.size(m)).alias("right"),
    )

    def made(x: Column) -> Column:
        start = x["before"] + F.length(x["left"])
        near = F.concat(_words_near(x["left"], True), F.array(F.lit("@")), _words_near(x["right"], False))
        return F.struct(
            start.alias("start"), F.lit(number).alias("kind_no"), F.lit(kind.name).alias("kind"),
            (start + F.length(x["match"])).alias("end"), _entity(kind, x["match"]).alias("entity"),
            near.alias("context"),
        )

    return F.when(F.size(m) > 0, F.transform(F.filter(each, lambda x: kind.valid(x["match"])), made))


def base_spans(docs: DataFrame) -> DataFrame:
    """`docs` with `base`: array<struct<start, kind_no, kind, end, entity, context>> in order.

    Positions count code points, the end is exclusive.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.withColumn("_text", text)
    found = found.withColumns({
        f"_m_{k.name}": F.when(
            F.contains("_text", F.lit(k.hint)), F.regexp_extract_all("_text", F.lit(k.pattern), F.lit(0))
        ).otherwise(F.array().cast("array<string>"))
        for k in KINDS
    })
    none = F.array().cast("array<string>")
    found = found.withColumns({
        f"_p_{k.name}": F.when(
            F.size(f"_m_{k.name}") > 0, F.split("_text", k.pattern, -1)
        ).otherwise(none)
        for k in KINDS
    })
    gaps = {
        f"_l_{k.name}": F.zip_with(
            F.slice(f"_p_{k.name}", F.lit(1), F.size(f"_m_{k.name}")),
            f"_m_{k.name}",
            lambda p, m: (F.length(p) + F.length(m)).cast("bigint"),
        )
        for k in KINDS
    }
    found = found.withColumns(gaps)
    spans = [_spans(number, k) for number, k in enumerate(KINDS)]
    kind = (
        "array<struct<start: bigint, kind_no: int, kind: string, end: bigint, entity: string, "
        "context: array<string>>>"
    )
    spans = [F.coalesce(s, F.array().cast(kind)) for s in spans]
    helpers = ["_text", *(f"_{x}_{k.name}" for k in KINDS for x in "mpl")]
    return found.withColumn("base", F.array_sort(F.concat(*spans))).drop(*helpers)


_WORD_GAPS = r"[^\p{L}\p{N}@]+"


def _disclosure(n: int) -> Column:
    """Of `with_both`, `with_term` and `with_entity` texts among `n`; null for an entity of every text."""
    mutual = F.log2(F.col("with_both") * n / (F.col("with_term") * F.col("with_entity")))
    return mutual / F.nullif(F.log2(n / F.col("with_entity")), F.lit(0.0))


def disclosing_terms(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(entity, term, disclosure) of the words that reveal an entity of `found` (text, base) in `docs`.

    A word is a candidate if it is among the five words on either side of an entity in MIN_CONTEXTS
    distinct texts; copies of a text count once. Words with digits and words of fewer than three letters
    are no candidates. Frequencies of entities, of words and of both together, wherever in a text they
    stand, count distinct texts of the whole table.
    """
    near = found.where(F.size("base") > 0).select(
        F.xxhash64("text").alias("of"), F.explode("base").alias("span")
    )
    near = written(near.select("of", "span.entity", "span.context").distinct(), "contexts")
    words = near.select("of", "entity", F.explode(F.array_distinct("context")).alias("term"))
    words = words.where(r"length(term) > 2 and not term rlike '[0-9@]'")
    often = (
        words.distinct().groupBy("entity", "term")
        .agg(F.count("*").alias("contexts")).where(F.col("contexts") >= MIN_CONTEXTS)
    )
    hashed = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = hashed.select(F.xxhash64("text")).distinct().count()
    holders = near.select("entity", "of").distinct()
    of_entity = holders.groupBy("entity").agg(F.count("*").alias("with_entity"))
    # The texts that have a word near any entity are some of those that have it, and those that have both are
    # no more than have either: disclosure is never smaller, which leaves out all common words at once.
    at_least = words.select("term", "of").distinct().groupBy("term").agg(F.count("*").alias("with_term"))
    joined = often.join(of_entity, "entity").join(at_least, "term")
    joined = joined.withColumn("with_both", F.least("with_entity", "with_term"))
    likely = written(
        joined.where(_disclosure(n) >= DISCLOSURE).select("entity", "term", "with_entity"), "likely_terms"
    )
    if likely.isEmpty():
        return likely.select("entity", "term", F.lit(0.0).alias("disclosure"))
    # With all texts that hold an entity, which are all that have both.
    held = written(_held(found.where(F.size("base") > 0), likely.select("term").distinct()), "held")
    of_both = (
        held.join(holders.join(likely.select("entity").distinct(), "entity", "left_semi"), "of")
        .groupBy("entity", "term").agg(F.count("*").alias("with_both"))
    )
    counted = likely.join(of_both, ["entity", "term"]).join(_frequencies(held), "term")
    possible = written(counted.where(_disclosure(n) >= DISCLOSURE).drop("with_term"), "possible_terms")
    if possible.isEmpty():
        return possible.select("entity", "term", F.lit(0.0).alias("disclosure"))
    # Last with all texts.
    of_term = _frequencies(_held(docs, possible.select("term").distinct()))
    telling = possible.join(of_term, "term").withColumn("disclosure", _disclosure(n))
    return written(telling.where(F.col("disclosure") >= DISCLOSURE).select("entity", "term", "disclosure"), "disclosing")


def _held(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(of, term): which distinct texts of `texts` (text) have which of `terms`."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    each = F.explode(F.array_distinct(F.split(F.lower(text), _WORD_GAPS))).alias("term")
    return texts.select(F.xxhash64(text).alias("of"), each).join(terms, "term", "left_semi").distinct()


def _frequencies(held: DataFrame) -> DataFrame:
    """(term, with_term): how many texts of `held` (of, term) have each term."""
    return held.groupBy("term").agg(F.count("*").alias("with_term"))


def _with_term_spans(found: DataFrame, flagged: DataFrame) -> DataFrame:
    """`found` (row, text, base, ...) with `spans`: base spans and those of words that give them away."""
    as_span = "array<struct<start: bigint, kind_no: int, kind: string, end: bigint>>"
    base = F.transform("base", lambda s: F.struct(s["start"], s["kind_no"], s["kind"], s["end"])).cast(as_span)
    found = found.withColumn("spans", base)
    if flagged.isEmpty():
        return found
    entities = found.select("row", F.explode(F.array_distinct("base.entity")).alias("entity"))
    of_row = entities.join(flagged, "entity").groupBy("row").agg(F.collect_set("term").alias("_terms"))
    joined = found.join(of_row, "row", "left")
    pattern = F.concat(
        F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join("_terms", "|"), F.lit(r")(?![\p{L}\p{N}])")
    )
    cut = joined.withColumn("_m", F.when(F.col("_terms").isNotNull(), F.regexp_extract_all("text", pattern, F.lit(0))))
    cut = cut.withColumn("_p", F.when(F.size("_m") > 0, F.split("text", pattern, -1)))
    cut = cut.withColumn("_l", F.zip_with(
        F.slice("_p", F.lit(1), F.size("_m")), "_m", lambda p, m: (F.length(p) + F.length(m)).cast("bigint")
    ))
    each = F.arrays_zip(_running("_l").alias("before"), F.col("_m").alias("match"), F.col("_p").alias("left"))
    made = F.transform(
        F.slice(each, F.lit(1), F.size("_m")),
        lambda x: F.struct(
            (x["before"] + F.length(x["left"])).alias("start"), F.lit(len(KINDS)).alias("kind_no"),
            F.lit(TERM).alias("kind"),
            (x["before"] + F.length(x["left"]) + F.length(x["match"])).alias("end"),
        ),
    )
    apart = F.filter(
        made,
        lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])),
    )
    more = F.when(F.size("_p") > 0, apart).otherwise(F.array().cast(as_span))
    every = F.array_sort(F.concat("spans", F.coalesce(more, F.array().cast(as_span))))
    return cut.withColumn("spans", every).drop("_terms", "_m", "_p", "_l")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) of every row of `docs` (doc_id, text).

    `base` are the spans found by pattern, `spans` those and the ones of words that disclose an entity of
    the document; both arrays of structs with start, kind and end, in order of start and kind. Positions
    count code points and the end is exclusive. Patterns are matched leftmost and without overlap within a
    kind; an address with a part over 255, a card number that fails Luhn's test or has not 12 to 19
    digits and a phone number that has not 9 to 15 digits are dropped. Kinds may overlap. A null text is
    empty; rows that repeat an id are documents of their own; other columns are ignored; an empty table
    gives no rows.
    """
    texts = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    some = F.when(F.size("base") > 0, F.col("text")).alias("text")
    rows = base_spans(texts).select(F.monotonically_increasing_id().alias("row"), "doc_id", some, "base")
    found = written(rows, "entities")
    return _with_term_spans(found, disclosing_terms(docs, found)).select("doc_id", "base", "spans")


def sanitise(docs: DataFrame) -> DataFrame:
    """`docs` with personal data in `text` replaced by the name of its kind in brackets.

    Overlapping spans become one, named after the first. Texts without any are unchanged; a null text
    stays null; all columns keep their names, other columns their values.
    """
    keep = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = base_spans(docs.select(keep, text))
    # Only rows with personal data are written and joined; the others pass from the table to the result.
    without = rows.where(F.size("base") == 0).select("kept.*")
    some = rows.where(F.size("base") > 0).withColumn("row", F.monotonically_increasing_id())
    found = written(some, "entities")
    spans = written(_with_term_spans(found, disclosing_terms(docs, found)), "spans")
    merged = F.expr("""
        aggregate(spans, cast(array() as array<struct<start: bigint, end: bigint, kind: string>>), (a, s) ->
            if(size(a) > 0 and element_at(a, -1).end > s.start,
               concat(slice(a, 1, size(a) - 1),
                      array(struct(element_at(a, -1).start as start,
                                   greatest(element_at(a, -1).end, s.end) as end, element_at(a, -1).kind as kind))),
               concat(a, array(struct(s.start as start, s.end as end, s.kind as kind)))))
    """)  # fmt: skip
    hidden = F.expr("""
        array_join(flatten(array(
            transform(merged, (m, i) -> concat(
                substring(text, int(if(i = 0, 0L, merged[i - 1].end)) + 1,
                          int(m.start - if(i = 0, 0L, merged[i - 1].end))),
                '[', upper(m.kind), ']')),
            array(substring(text, int(element_at(merged, -1).end) + 1))
        )), '')
    """)  # fmt: skip
    clean = written(spans.select("kept", "text", merged.alias("merged")), "merged").select(
        "kept", hidden.alias("hidden")
    )
    columns = [
        F.col("hidden").alias("text") if c == "text" else F.col(f"kept.`{c}`").alias(c)
        for c in docs.columns
    ]
    return without.union(clean.select(columns))
