"""Personal data: patterns, and terms that reveal it.

Emails, IP addresses, card and phone numbers are found by pattern; they are the
protected entities. Terms near an entity are weighed by what they tell about it: their
pointwise mutual information with the entity, estimated from co-occurrence in
the whole corpus. A term that tells more about an entity than its kind would (the
information of "some email") is a span as well. Sanitising generalises entities
to their kinds and removes such terms.

All of it is DataFrame functions, without Python in tasks.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_cut, told_apart, unused

KINDS = ("email", "ip", "card", "phone", "term")

# The patterns, written so that they take time in proportion to the text: a match begins
# where a run of its first characters does, or where the last match ended, and runs give nothing back.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
_CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_TERM = r"\p{L}{2,}+"
# Where one of these is not found, the pattern is not tried.
_MAY_HOLD = {"ip": r"[0-9]\.[0-9]++\.[0-9]", "card": _CARD, "phone": r"\+[0-9]"}

#: Characters on either side of an entity in which terms count as being near it.
NEAR = 64
#: Contexts, worded differently, in which a term must stand near an entity to tell anything.
MIN_CONTEXTS = 3
#: Two windows are copies if one whole side is the same, and on the other side this many words
#: next to the entity, or more where the whole side is short, so that so many are the same in all.
SAME_BESIDE = 4
SAME_WORDS = 10

_SPAN = "struct<start: int, kind_no: int, end: int, kind: string>"


def found_at(text: Column, pattern: str) -> Column:
    """array<struct<value, start, end>> of the leftmost matches that do not overlap, in code points."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda gap: F.length(gap))
    none = F.array().cast("array<struct<value: string, start: int, end: int>>")

    def step(done: Column, match: Column) -> Column:
        start = done["at"] + match["gap"]
        end = start + F.length(match["value"])
        span = F.struct(match["value"].alias("value"), start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.array_append(done["spans"], span).alias("spans"))

    # The last gap follows the last match.
    matches = F.zip_with(values, F.slice(gaps, 1, F.size(values)), lambda v, g: F.struct(v.alias("value"), g.alias("gap")))
    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    spans = F.aggregate(matches, begin, step)["spans"]
    return F.when(F.size(values) > 0, spans).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _is_ip(value: Column) -> Column:
    def small(part: Column) -> Column:
        number = F.regexp_replace(part, "^0+", "")
        return (F.length(number) <= 3) & (F.coalesce(number.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(value, r"\."), small)


def _passes_luhn(value: Column) -> Column:
    digits = F.transform(F.split(F.reverse(_digits(value)), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))

    def counted(digit: Column, place: Column) -> Column:
        doubled = digit * 2
        return F.when(place % 2 == 0, digit).when(doubled > 9, doubled - 9).otherwise(doubled)

    total = F.aggregate(F.transform(digits, counted), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _spans_of(text: Column, kind: str) -> Column:
    pattern = {"email": _EMAIL, "ip": _IP, "card": _CARD, "phone": _PHONE}[kind]
    may_hold = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(_MAY_HOLD[kind])
    found = found_at(text, pattern)
    if kind == "ip":
        found = F.filter(found, lambda m: _is_ip(m["value"]))
    elif kind == "card":
        found = F.filter(found, lambda m: _passes_luhn(m["value"]))
    elif kind == "phone":
        found = F.filter(found, lambda m: F.length(_digits(m["value"])).between(10, 15))
    number = KINDS.index(kind)

    def span(match: Column) -> Column:
        return F.struct(
            match["start"].alias("start"), F.lit(number).alias("kind_no"), match["end"].alias("end"), F.lit(kind).alias("kind")
        )

    return F.when(may_hold, F.transform(found, span)).otherwise(F.array().cast(f"array<{_SPAN}>"))


def base_spans(text: Column) -> Column:
    """All spans found by pattern, by start, then kind."""
    return F.sort_array(F.concat(*[_spans_of(text, kind) for kind in KINDS[:4]]))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _contexts(text: Column, base: Column) -> Column:
    """For each span: its kind, its entity, two hashes of the words near it, and all terms near it with places.

    Windows of which either hash is the same are copies: `by_left` is of all words
    before the entity and the next ones after it, `by_right` is the reverse.
    """

    def terms(part: Column, offset: Column) -> Column:
        return F.transform(
            found_at(part, _TERM),
            lambda m: F.struct(
                F.lower(m["value"]).alias("term"), (m["start"] + offset).alias("start"), (m["end"] + offset).alias("end")
            ),
        )

    def context(span: Column) -> Column:
        value = F.substring(text, span["start"] + 1, span["end"] - span["start"])
        entity = F.when(span["kind"] == "email", F.lower(value)).otherwise(_digits(value))
        # A word that the window cuts is not a term: the window begins, and ends, with a whole one.
        from_ = F.greatest(span["start"] - NEAR, F.lit(0))
        before = F.substring(text, from_ + 1, span["start"] - from_)
        whole = F.when(from_ > 0, F.regexp_replace(before, r"^[^\x20\x09-\x0D]+", "")).otherwise(before)
        after = F.substring(text, span["end"] + 1, F.lit(NEAR))
        until = F.when(F.length(after) == NEAR, F.regexp_replace(after, r"[^\x20\x09-\x0D]+$", "")).otherwise(after)
        left, right = terms(whole, span["start"] - F.length(whole)), terms(until, span["end"])
        # Words in the order in which they leave the entity.
        outward = F.reverse(F.transform(left, lambda t: t["term"])), F.transform(right, lambda t: t["term"])

        def hashed(whole_side: Column, other: Column) -> Column:
            beside = F.slice(other, F.lit(1), F.greatest(F.lit(SAME_BESIDE), SAME_WORDS - F.size(whole_side)))
            return F.xxhash64(F.size(whole_side), whole_side, beside)

        free = F.filter(
            F.concat(left, right), lambda t: ~F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
        )
        return F.struct(
            span["kind"].alias("kind"),
            entity.alias("entity"),
            hashed(outward[0], outward[1]).alias("by_left"),
            hashed(outward[1], outward[0]).alias("by_right"),
            free.alias("terms"),
        )

    return F.transform(base, context)


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, contexts) of every row of `docs`, as a table."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("base", base_spans(F.col("text")))
    contexts = _contexts(F.col("text"), F.col("base")).alias("contexts")
    return cut(rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "base", contexts), "personal")


def disclosing_terms(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(kind, entity, term) whose mutual information exceeds the information of the kind.

    A window is the words near one entity. p(term) is the chance that a window
    anywhere holds it, from the counts of all documents; p(term | entity) is the
    share of an entity's windows that do. Windows count as often as they differ as
    a whole (see `_contexts`): copies of a passage, also where the text around it
    differs at one end, are one, and a rare word of theirs discloses nothing. A
    word or phrase that always stands beside the entity, or at the edge of the text, makes no copies.
    """
    near = found.select(F.explode("contexts").alias("c")).select("c.*")
    worded = F.least(F.count_distinct("by_left"), F.count_distinct("by_right"))
    windows = near.groupBy("kind", "entity").agg(worded.alias("n_windows")).filter(F.col("n_windows") >= MIN_CONTEXTS)
    pairs = (
        near.select("kind", "entity", "by_left", "by_right", F.explode("terms").alias("t"))
        .groupBy("kind", "entity", "t.term")
        .agg(worded.alias("n_both"))
        .filter(F.col("n_both") >= MIN_CONTEXTS)
    )
    # The words of one task are counted there before any of them is sent.
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(_TERM), F.lit(0))).alias("term"))
    counts = cut(words.groupBy("term").agg(F.count("*").alias("n_term")), "terms")
    totals = counts.agg(F.sum("n_term").alias("n_words")).withColumn("one", F.lit(1))
    kinds = near.groupBy("kind").agg(F.count("*").alias("n_kind"), F.avg(F.size("terms")).alias("window_words"))
    weighed = (
        pairs.join(windows, ["kind", "entity"]).join(counts, "term").join(kinds, "kind").withColumn("one", F.lit(1)).join(totals, "one")
    )
    all_windows = F.col("n_words") / F.col("window_words")
    p_term = F.least(F.col("n_term") * F.col("window_words") / F.col("n_words"), F.lit(1.0))
    information = F.log2(F.least(F.col("n_both") / F.col("n_windows"), F.lit(1.0)) / p_term)
    of_kind = F.log2(all_windows / F.col("n_kind"))
    disclosing = cut(weighed.filter(information > F.greatest(of_kind, F.lit(0.0))).select("kind", "entity", "term"), "disclosing")
    drop_cut(counts)
    return disclosing


def term_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, terms): where disclosing terms stand near their entities."""
    flagged = disclosing_terms(docs, found)
    near = found.select("doc_id", "text_hash", F.explode("contexts").alias("c")).select(
        "doc_id", "text_hash", "c.kind", "c.entity", F.explode("c.terms").alias("t")
    )
    places = near.select("doc_id", "text_hash", "kind", "entity", "t.term", "t.start", "t.end").join(
        flagged, ["kind", "entity", "term"], "left_semi"
    )
    number = KINDS.index("term")
    span = F.struct("start", F.lit(number).alias("kind_no"), "end", F.lit("term").alias("kind"))
    return places.groupBy("doc_id", "text_hash").agg(F.collect_set(span).alias("terms"))


def all_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) of every row of `docs`; spans are those of `base` and the disclosing terms.

    Null texts are empty and hold none. Rows that repeat get the same spans each;
    null ids stay. No rows give none; other columns are ignored.
    """
    found = find(docs)
    terms = term_spans(docs, found).select(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_hash"), "terms")
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_hash") == F.col("of_hash"))
    spans = F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "terms")))
    return found.select("doc_id", "text_hash", "base").join(terms, same, "left").select("doc_id", "base", spans.alias("spans"))


def sanitised(docs: DataFrame) -> DataFrame:
    """`docs` with its columns, entities in texts generalised to [KIND], disclosing terms removed. Null texts stay null."""
    # Columns of `docs` may have any name, so these get names of their own.
    names = ("personal_hash", "personal_doc", "personal_text", "personal_terms", "personal_spans")
    own, doc, hashed, terms_of, spans_of = (unused(docs.columns, name) for name in names)
    terms = cut(term_spans(docs, find(docs)), "term-spans").toDF(doc, hashed, terms_of)
    text = F.col("text")
    # Few documents hold such terms, and only those are joined with them.
    some, others = told_apart(docs.withColumn(own, F.xxhash64(F.coalesce(text, F.lit("")))), ["doc_id", own], terms.select(doc, hashed))
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(hashed))
    found = some.join(terms, same, "left").select(*docs.columns, terms_of)
    none = F.array().cast(f"array<{_SPAN}>")
    joined = found.unionByName(others.select(*docs.columns, F.lit(None).cast(found.schema[terms_of].dataType).alias(terms_of)))
    spans = F.sort_array(F.concat(base_spans(F.coalesce(text, F.lit(""))), F.coalesce(terms_of, none)))

    def step(done: Column, span: Column) -> Column:
        """Text up to the span, and what stands for it; a span within one already replaced adds nothing."""
        label = F.when(span["kind"] == "term", F.lit("")).otherwise(F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
        kept = F.substring(text, done["at"] + 1, span["start"] - done["at"])
        out = F.when(span["start"] >= done["at"], F.concat(done["out"], kept, label)).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), out.alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    replaced = F.aggregate(spans_of, begin, step, lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, F.length(text))))
    clean = F.when(F.size(spans_of) == 0, text).otherwise(replaced)
    return joined.select(*docs.columns, spans.alias(spans_of)).withColumn("text", clean).select(*docs.columns)
