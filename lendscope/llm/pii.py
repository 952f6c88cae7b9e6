"""Information-theoretic removal of personal data, with DataFrame functions only.

Base spans are found by pattern. Each value found (an address, a number) is a protected entity. Terms of the
documents that hold an entity may give it away even when the entity itself is masked: the corpus tells how strongly.
With c(e, t) the documents that hold both entity e and term t, n(t) those that hold t and n(e) those that hold e, of N,
a term discloses of the entity's information -log(n(e) / N) the part

    disclosure(e, t) = log(p(e | t) * N / n(e)) / log(N / n(e)),    p(e | t) = c(e, t) / n(t),

its pointwise mutual information with the entity against the entity's own information. A pair that fewer than `SUPPORT`
documents hold is judged too, by a smoothed p: the missing documents are added to the term's as ones that hold
the entity at the rate of the corpus. From `GENERALISE` on the term is replaced by a general word, from `REMOVE`
on it is taken out, wherever it stands in a document that holds the entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lendscope.llm.common import texts
from lendscope.session import materialize

KINDS = ("email", "ip", "card", "phone")
# The base patterns. Possessive repeats and the look-behinds change no match: they
# only keep a long run of one kind of character from being tried again at each of its places.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be worth a look.
HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
#: No limit of the method, which judges whole documents: the window in which tests count by hand.
NEAR = 80
#: A term is a word of letters of at least this length; the pattern's own words.
TERM = r"\p{L}{4,}"
#: Documents that must hold an entity and a term before their estimate counts as it is; below it is smoothed.
SUPPORT = 3
GENERALISE = 0.6
REMOVE = 0.9


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    places = F.sequence(F.lit(1), F.length(digits))
    total = F.aggregate(
        places,
        F.lit(0),
        lambda total, place: total
        + F.element_at(
            F.when((F.length(digits) - place) % 2 == 1, F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)))).otherwise(
                F.array(*map(F.lit, range(10)))
            ),
            F.substring(digits, place, F.lit(1)).cast("int") + 1,
        ),
    )
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":  # a part may have any number of leading zeros
        part = lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "")
        return F.forall(F.split(value, r"\."), lambda x: (F.length(part(x)) <= 3) & (F.substring(part(x), 1, 3).cast("int") <= 255))
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _spans(text: Column, kind: str) -> Column:
    """All matches of a kind: array of (start, end, value), end exclusive, in code points.

    The text between matches and the matches themselves take turns, so a match starts behind
    all that came before. Matches that fail their check are dropped, not retried.
    """
    pattern = PATTERNS[kind]
    type_ = "array<struct<start:int,end:int,value:string>>"
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    steps = F.zip_with(gaps, values, lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(type_).alias("found"))
    found = F.aggregate(
        F.filter(steps, lambda x: x["value"].isNotNull()),
        empty,
        lambda so_far, x: F.struct(
            (so_far["at"] + x["gap"] + F.length(x["value"])).alias("at"),
            F.when(
                _valid(kind, x["value"]),
                F.array_append(
                    so_far["found"],
                    F.struct(
                        (so_far["at"] + x["gap"]).alias("start"),
                        (so_far["at"] + x["gap"] + F.length(x["value"])).alias("end"),
                        x["value"].alias("value"),
                    ),
                ),
            )
            .otherwise(so_far["found"])
            .alias("found"),
        ),
        lambda so_far: so_far["found"],
    )
    worth = F.contains(text, F.lit(HINTS[kind])) if HINTS[kind] else F.lit(True)
    if kind != "email":
        worth = worth & text.rlike("[0-9]")
    return F.when(worth & text.rlike(pattern), found).otherwise(F.array().cast(type_))


def base_spans(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: place (of the row), doc_id, text, one array of spans per kind."""
    rows = texts(docs).withColumn("place", F.monotonically_increasing_id())
    return rows.select("place", "doc_id", "text", *(_spans(F.col("text"), kind).alias(kind) for kind in KINDS))


def _entity(kind: str, value: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.lower(value) if kind == "email" else _digits(value) if kind != "ip" else value)


def _terms(text: Column) -> Column:
    """The terms of a text in order, in lower case."""
    return F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower)


def holders(found: DataFrame) -> DataFrame:
    """One row per row that holds an entity: place, its distinct entities and its distinct terms."""

    def named(kind):
        return F.transform(kind, lambda x: _entity(kind, x["value"]))

    return found.where(" OR ".join(f"size({kind}) > 0" for kind in KINDS)).select(
        "place", F.array_distinct(F.concat(*map(named, KINDS))).alias("entities"), F.array_distinct(_terms(F.col("text"))).alias("words")
    )


def meetings(spark: SparkSession, held: DataFrame) -> DataFrame:
    """place, entity, term: what meets in each document. Entities of the very same documents meet the same terms and are one.

    ``entity`` is (n: the documents that hold it, and two hashes that stand for them).
    """
    mentions = held.select("place", F.explode("entities").alias("named"))
    # Every sum is taken in the tasks first, so an entity of very many documents sends a few rows.
    where = F.struct(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("place")).alias("a"),
        F.bit_xor(F.xxhash64("place", F.lit("b"))).alias("b"),
    )
    known = materialize(spark, mentions.groupBy(F.col("named").alias("name")).agg(where.alias("entity")), "pii-entities")
    alike = mentions.join(known, F.col("named") == F.col("name")).groupBy("place").agg(F.collect_set("entity").alias("alike"))
    held = held.select(F.col("place").alias("holder"), "words")
    return (
        alike.join(held, F.col("place") == F.col("holder"))
        .select("place", "words", F.explode("alike").alias("entity"))
        .select("place", "entity", F.explode("words").alias("term"))
    )


def disclosures(docs: DataFrame, met: DataFrame, support: int = SUPPORT) -> DataFrame:
    """entity, term, disclosure: how much of the entity's information the term gives away, over all documents.

    Every count is of documents and is summed in each task before it moves. The words' counts are written, so
    that a word of very many pairs is a side of a plain join, which can be split.
    """
    spark = docs.sparkSession
    together = met.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("c"))
    words = docs.select(F.explode(F.array_distinct(_terms(F.col("text")))).alias("word"))
    totals = materialize(spark, words.groupBy("word").agg(F.count(F.lit(1)).alias("n_t")), "pii-words")
    n = docs.agg(F.greatest(F.count(F.lit(1)), F.lit(2)).cast("double").alias("n"))
    rate = F.col("entity.n") / F.col("n")
    missing = F.greatest(F.lit(support) - F.col("c"), F.lit(0))
    given = (F.col("c") + missing * rate) / (F.col("n_t") + missing)
    return (
        together.join(totals, F.col("term") == F.col("word"))
        .withColumn("n", n.scalar())
        .where("entity.n < n")
        .select("entity", "term", (F.log(given / rate) / -F.log(rate)).alias("disclosure"))
    )


def _marked(text: Column, strong: Column) -> Column:
    """All occurrences of the terms in ``strong``, a map of term to disclosure: array of (start, end, term, disclosure)."""
    values = F.regexp_extract_all(text, F.lit(TERM), F.lit(0))
    gaps = F.transform(F.split(text, TERM, -1), lambda x: F.length(x))
    steps = F.zip_with(
        gaps,
        values,
        lambda gap, value: F.struct(
            gap.alias("gap"), F.length(value).alias("size"), F.lower(value).alias("term"), F.try_element_at(strong, F.lower(value)).alias("part")
        ),
    )
    type_ = "array<struct<start:int,end:int,term:string,disclosure:double>>"
    found = F.aggregate(
        F.filter(steps, lambda x: x["term"].isNotNull()),
        F.struct(F.lit(0).alias("at"), F.array().cast(type_).alias("found")),
        lambda so_far, x: F.struct(
            (so_far["at"] + x["gap"] + x["size"]).alias("at"),
            F.when(
                x["part"].isNotNull(),
                F.array_append(
                    so_far["found"],
                    F.struct(
                        (so_far["at"] + x["gap"]).alias("start"),
                        (so_far["at"] + x["gap"] + x["size"]).alias("end"),
                        x["term"].alias("term"),
                        x["part"].alias("disclosure"),
                    ),
                ),
            )
            .otherwise(so_far["found"])
            .alias("found"),
        ),
        lambda so_far: so_far["found"],
    )
    return F.when(strong.isNotNull(), found).otherwise(F.array().cast(type_))


def personal_data(docs: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """One row per row of ``docs``: doc_id, text, one array of (start, end, value) per base kind, and ``terms``, an array
    of (start, end, term, disclosure, removed) of the words that give away an entity of the document.

    A null text is the empty one and holds nothing; ids may be null or repeat, each row is its own document. An empty table
    gives an empty result. Offsets are code points, ends exclusive.
    """
    spark = docs.sparkSession
    found = base_spans(docs)
    met = meetings(spark, materialize(spark, holders(found), "pii-holders"))
    strong = materialize(spark, disclosures(texts(docs), met, support).where(F.col("disclosure") >= generalise), "pii-strong")
    marks = (
        met.join(strong, ["entity", "term"])
        .groupBy("place", "term")
        .agg(F.max("disclosure").alias("disclosure"))
        .groupBy(F.col("place").alias("marked"))
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("strong"))
    )
    every = found.join(marks, F.col("place") == F.col("marked"), "left")
    # A term inside a base span is part of it.
    outside = F.filter(
        _marked(F.col("text"), F.col("strong")),
        lambda t: ~F.exists(F.concat(*KINDS), lambda s: (t["start"] < s["end"]) & (s["start"] < t["end"])),
    )
    terms = F.transform(
        outside,
        lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), t["term"].alias("term"), t["disclosure"].alias("disclosure"), (t["disclosure"] >= remove).alias("removed")),
    )
    return every.select("doc_id", "text", *KINDS, terms.alias("terms"))


def _listed(*groups: tuple[str, Column]) -> Column:
    """Spans as kind:start:end, by start and then by kind as given, joined by commas."""

    def shown(rank, kind, spans):
        return F.transform(
            spans,
            lambda x: F.struct(
                x["start"].alias("start"),
                F.lit(rank).alias("rank"),
                F.concat_ws(":", F.lit(kind), x["start"].cast("string"), x["end"].cast("string")).alias("shown"),
            ),
        )

    parts = [shown(rank, kind, spans) for rank, (kind, spans) in enumerate(groups)]
    return F.array_join(F.transform(F.array_sort(F.concat(*parts)), lambda x: x["shown"]), ",")


def sanitised(found: DataFrame) -> Column:
    """The text with base spans replaced by their kind, strong terms by a general word, the strongest taken out.

    ``found`` has the columns of `personal_data`. Spans are taken by start; one that overlaps an earlier one only
    extends what is replaced.
    """

    def masked(spans, by):
        return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), by(x).alias("by")))

    def word(kind):
        return lambda x: F.lit(f"[{kind}]")

    parts = [masked(kind, word(kind)) for kind in KINDS]
    parts.append(masked("terms", lambda x: F.when(x["removed"], "").otherwise("[term]")))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = found["text"]
    return F.aggregate(
        F.array_sort(F.concat(*parts)),
        start,
        lambda so_far, x: F.struct(
            F.greatest(so_far["at"], x["end"]).alias("at"),
            F.when(
                x["start"] >= so_far["at"],
                F.concat(so_far["out"], F.substring(text, so_far["at"] + 1, x["start"] - so_far["at"]), x["by"]),
            )
            .otherwise(so_far["out"])
            .alias("out"),
        ),
        lambda so_far: F.concat(so_far["out"], F.substring(text, so_far["at"] + 1, F.length(text))),
    )


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts and lists of the spans of `personal_data`."""
    base = [(kind, F.col(kind)) for kind in KINDS]
    return found.select(
        "doc_id",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(_listed(*base).cast("binary"), 256).alias("base_sha256"),
        _listed(*base, ("term", F.col("terms"))).alias("spans"),
    )
