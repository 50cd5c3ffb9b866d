"""Personal data: fixed patterns, and terms that reveal a protected entity by co-occurrence.

A protected entity is a value that the patterns find (an address, a number). How much a term reveals of
it is their pointwise mutual information over all distinct texts, against the entity's own information
content (Sanchez and Batet 2016). A term discloses an entity if most of that content is revealed and only a few bits of it
stay hidden; with fewer hidden bits the term is removed, else generalised. The bits that stay hidden are those
of the probability of the entity given the term, so the decision does not change as a corpus grows by other texts.
Everything is Spark expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquarry.llm.common import stored
from fleetquarry.llm.spans import SPAN, digest, joined, masked, matches, whole_text

# fixed values of the base kinds; possessive, and behind a look-back that reads each run once
# (\G: right after a match, where a run may go on)
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "term"]

#: A term is a lower-cased run of at least four letters.
TERM = r"(?<!\p{L})\p{L}{4,}+"
#: Taken off each joint count: absolute discounting, so that few texts are weaker evidence than many.
DISCOUNT = 0.6
#: Share of an entity's information content that a disclosing term reveals at least. For entities in under 9 % of the texts it
#: follows from the bits below, so only those decide.
DISCLOSED = 0.5
#: Bits of it that stay hidden at most where a term is generalised, and where it is removed.
GENERALISE = 1.75
REMOVE = 0.25


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _ip(match: Column) -> Column:
    """Every part at most 255, however many zeros lead."""
    value = lambda p: F.ltrim(p, F.lit("0"))
    return F.forall(
        F.split(match, r"\."),
        lambda p: F.when(F.char_length(value(p)) <= 3, F.coalesce(F.nullif(value(p), F.lit("")).cast("int"), F.lit(0)) <= 255).otherwise(False),
    )


def _luhn(digits: Column) -> Column:
    """Whether every second digit from the right, doubled, and the others sum to a multiple of ten."""
    total = F.aggregate(
        F.split(F.reverse(digits), ""),
        F.struct(F.lit(0).alias("sum"), F.lit(False).alias("double")),
        lambda s, d: F.struct(
            (s["sum"] + F.when(s["double"], d.cast("int") * 2 % 10 + F.floor(d.cast("int") / 5).cast("int")).otherwise(d.cast("int"))).alias("sum"),
            (~s["double"]).alias("double"),
        ),
        lambda s: s["sum"],
    )
    return total % 10 == 0


def base_spans(text: Column) -> Column:
    """Base spans of a text that is not null, by kind as listed, then start."""
    size = lambda m: F.char_length(_digits(m))
    card = lambda m: F.when(size(m).between(16, 19), _luhn(_digits(m))).otherwise(False)
    return F.concat(
        matches(text, "email", EMAIL, lambda m: F.lit(True), F.contains(text, F.lit("@"))),
        matches(text, "ip", IP, _ip, text.rlike(IP)),
        # shorter runs of digits are no match that counts
        matches(text, "card", CARD, card, text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}")),
        matches(text, "phone", PHONE, lambda m: size(m).between(8, 15), F.contains(text, F.lit("+"))),
    )


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), 1))


def personal(docs: DataFrame) -> DataFrame:
    """(doc_id, hash, base, text) for every row of ``docs(doc_id, text)``, text only where it holds an entity."""
    text = whole_text(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    rows = rows.select("doc_id", _hash(F.col("text")).alias("hash"), base_spans(F.col("text")).alias("base"), "text")
    return rows.withColumn("text", F.when(F.size("base") > 0, F.col("text")))


def _hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _entities(base: DataFrame) -> DataFrame:
    """(hash, entity): the entities of each distinct text."""
    entity = F.concat_ws(":", F.col("s.kind"), F.lower("s.value"))
    held = base.where("text is not null").select("hash", F.explode("base").alias("s"))
    return held.select("hash", entity.alias("entity")).distinct()


def term_counts(docs: DataFrame, twice: DataFrame) -> DataFrame:
    """(term, n_term): in how many distinct texts of ``docs(text)`` a term stands.

    ``twice(hash, copies)`` are the texts that more than one row has. Each of those rows counts as a fraction, so no text is
    moved to settle which copy counts; the fractions of one text sum to one, up to rounding.
    """
    rows = docs.select(whole_text(F.col("text")).alias("text")).withColumn("hash", _hash(F.col("text")))
    rows = rows.join(twice, "hash", "left").select(_terms(F.col("text")).alias("terms"), (1 / F.coalesce("copies", F.lit(1))).alias("part"))
    parts = rows.select(F.explode("terms").alias("term"), "part")
    return parts.groupBy("term").agg(F.round(F.sum("part")).cast("long").alias("n_term"))


def disclosures(docs: DataFrame, base: DataFrame) -> DataFrame:
    """(hash, term, hidden): terms of a text that disclose one of its entities, and the bits that they leave hidden of it (the
    fewest of all its entities).

    Counts are over the distinct texts of all ``docs``; ``base`` is :func:`personal` of them. Copies of a text count
    once: they are no independent evidence. Every entity takes part, from one text on; DISCOUNT shrinks
    the estimate the more, the fewer texts hold it.
    """
    copies = base.groupBy("hash").agg(F.count("*").alias("copies"))
    twice = stored(copies.where("copies > 1"), "copies")
    spare = twice.agg(F.sum(F.col("copies") - 1)).first()[0] or 0
    size = F.lit(float(max(2, base.count() - spare)))
    held = _entities(base)
    held = stored(held.join(held.groupBy("entity").agg(F.count("*").alias("n_entity")), "entity"), "entities")
    # n_both is n_entity at most, so a term that more texts have than this cannot disclose the entity
    n = F.col("n_entity")
    reach = (n - DISCOUNT) * F.least(F.pow(size / n, F.lit(1 - DISCLOSED)), F.lit(2.0**GENERALISE)) * (1 + 1e-9)
    bounds = held.groupBy("hash").agg(F.max(reach).alias("bound"))
    texts = base.where("text is not null").select("hash", "text").dropDuplicates(["hash"])
    near = texts.join(bounds, "hash").select("hash", "bound", F.explode(_terms(F.col("text"))).alias("term"))
    rare = near.join(term_counts(docs, twice), "term").where("n_term <= bound").drop("bound")
    pairs = stored(rare.join(held, "hash").where(F.col("n_term") <= reach), "pairs")
    both = pairs.groupBy("entity", "n_entity", "term", "n_term").agg(F.count("*").alias("n_both"))
    information = F.log2(size / F.col("n_entity"))
    hidden = F.log2(F.greatest("n_term", "n_both") / (F.col("n_both") - DISCOUNT))
    found = both.select("entity", "term", hidden.alias("hidden"), (information - hidden).alias("revealed"), information.alias("all"))
    found = found.where((F.col("revealed") >= DISCLOSED * F.col("all")) & (F.col("all") > 0) & (F.col("hidden") <= GENERALISE))
    own = pairs.select("hash", "entity", "term").join(found.select("entity", "term", "hidden"), ["entity", "term"])
    return own.groupBy("hash", "term").agg(F.min("hidden").alias("hidden"))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) for every row of ``docs(doc_id, text)``; spans hold the base ones, by kind
    as listed, and then those of kind ``term``, whose value tells what is done: 'generalise' or 'remove'.

    Null counts as empty; positions are code points, end exclusive. Rows that share a text get
    the same spans; repeated rows and rows without doc_id stay; other columns are dropped. Without any entity there are no terms.
    Texts are only mapped: what moves are the texts that hold an entity, hashes, and terms with their counts.
    """
    base = stored(personal(docs), "personal")
    # the terms of one text are bounded by the text
    terms = disclosures(docs, base).groupBy("hash").agg(
        F.collect_list(F.when(F.col("hidden") > REMOVE, F.col("term"))).alias("general"),
        F.collect_list(F.when(F.col("hidden") <= REMOVE, F.col("term"))).alias("removed"),
    )
    words = matches(
        F.col("text"), "term", TERM,
        lambda w: F.array_contains("general", F.lower(w)) | F.array_contains("removed", F.lower(w)), F.lit(True),
    )
    told = F.transform(words, lambda s: F.struct(
        s["start"], s["kind"], s["end"],
        F.when(F.array_contains("removed", F.lower(s["value"])), F.lit("remove")).otherwise(F.lit("generalise")).alias("value"),
    ))
    texts = base.where("text is not null").select("hash", "text").dropDuplicates(["hash"])
    revealing = texts.join(terms, "hash").select("hash", told.alias("told"))
    none = F.array().cast(SPAN)
    held = base.where("text is not null").join(revealing, "hash", "left")
    return held.select("doc_id", "base", F.concat("base", F.coalesce("told", none)).alias("spans")).unionByName(
        base.where("text is null").select("doc_id", "base", F.col("base").alias("spans"))
    )


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, n_term, base_sha256, spans, n_generalised, n_removed) for every row of
    ``docs``; the last two tell what is done to the spans of terms."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return scan(docs).select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in KINDS),
        digest(F.col("base")).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        *(
            F.size(F.filter("spans", lambda s: (s["kind"] == "term") & (s["value"] == done))).cast("long").alias(name)
            for name, done in (("n_generalised", "generalise"), ("n_removed", "remove"))
        ),
    )


def sanitised(text: Column, spans: Column) -> Column:
    """``text`` (not null) with base spans and generalised terms replaced by their kind in brackets,
    and removed terms left out."""
    label = lambda s: F.when(s["value"] == "remove", F.lit("")).otherwise(F.concat(F.lit("["), s["kind"], F.lit("]")))
    return masked(text, spans, label)
